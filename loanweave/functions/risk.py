"""Rates and money columns of a loan.

Rule-based rates are DECIMAL and money is DECIMAL(18,4): amount x PD x LGD has exactly
four decimals, so sums are exact and do not depend on the order of rows, and 18 digits
are stored as one machine word. A PD that comes
from a model is DOUBLE and keeps its precision; the money derived from it is DOUBLE too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed_values as V

RATE = "decimal(4,2)"
MONEY = "decimal(18,4)"


def _rate(text: str) -> Column:
    return F.lit(text).cast(RATE)


def _first_bound(value: Column, bounds: list[tuple[str, Column]], above: Column, inclusive: bool) -> Column:
    """The result beside the first bound that ``value`` stays below."""
    label = above
    for bound, result in reversed(bounds):
        below = value <= _rate(bound) if inclusive else value < _rate(bound)
        label = F.when(below, result).otherwise(label)
    return label


def _lookup(key: Column, table: dict[str, str], other: str) -> Column:
    rates = F.create_map(*[cell for k, v in table.items() for cell in (F.lit(k), _rate(v))])
    return F.coalesce(F.try_element_at(rates, key), _rate(other))


def pd_history(history: str = "credit_history") -> Column:
    """PD by credit history; any other text gets the fallback rate."""
    return _lookup(F.col(history), V.PD_BY_HISTORY, V.PD_OTHER_HISTORY)


def pd_final(history_pd: str = "PD_history", target: str = V.TARGET, bad_label: int = 1) -> Column:
    """PD of a bad loan is fixed; others keep the PD of their history."""
    return F.when(F.col(target) == bad_label, _rate(V.PD_BAD)).otherwise(F.col(history_pd))


def lgd_by_purpose(purpose: str = "purpose") -> Column:
    return _lookup(F.col(purpose), V.LGD_BY_PURPOSE, V.LGD_OTHER_PURPOSE)


def profit_margin(pd: str = "PD") -> Column:
    bounds = [(bound, _rate(rate)) for bound, rate in V.MARGIN_BY_PD]
    return _first_bound(F.col(pd), bounds, _rate(V.MARGIN_ABOVE), inclusive=True)


def pd_category(pd: str = "PD") -> Column:
    bounds = [(bound, F.lit(text)) for bound, text in V.CATEGORY_BY_PD]
    return _first_bound(F.col(pd), bounds, F.lit(V.CATEGORY_ABOVE), inclusive=False)


def risk_segment(pd: str = "PD") -> Column:
    bounds = [(bound, F.lit(text)) for bound, text in V.SEGMENT_BY_PD]
    return _first_bound(F.col(pd), bounds, F.lit(V.SEGMENT_ABOVE), inclusive=True)


def risk_columns(
    df: DataFrame,
    amount: str = "amount",
    target: str = V.TARGET,
    bad_label: int = 1,
) -> DataFrame:
    """Add PD_history, PD, LGD, profit_margin and the five money columns."""
    rates = df.withColumns({"PD_history": pd_history(), "LGD": lgd_by_purpose()})
    rates = rates.withColumn("PD", pd_final(target=target, bad_label=bad_label))
    return money_columns(rates.withColumn("profit_margin", profit_margin()), amount)


def money_columns(df: DataFrame, amount: str = "amount") -> DataFrame:
    """credit_amount, expected_profit, expected_loss, expected_value, exposure_at_risk."""
    exact = df.schema["PD"].dataType.typeName() == "decimal"
    kind = MONEY if exact else "double"
    size, pd, lgd, margin = F.col(amount), F.col("PD"), F.col("LGD"), F.col("profit_margin")
    profit = (size * margin).cast(kind)
    loss = (size * pd * lgd).cast(kind)
    return df.withColumns(
        {
            "credit_amount": size,
            "expected_profit": profit,
            "expected_loss": loss,
            "expected_value": (profit - loss).cast(kind),
            "exposure_at_risk": (size * pd).cast(kind),
        }
    )
