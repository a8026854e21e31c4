"""Measures of a loan table and of an optimised portfolio.

Every measure is a column of one grouped aggregation: a report visual is one call with
the columns it groups by. "Baseline" means all loans here; the ``portfolio_type`` column
uses the same word for the loans that were not selected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import TARGET
from ..sources.tables import steps_table
from .cutoff import FINE_AMOUNT


def baseline_measures(
    df: DataFrame, group_cols: list[str] | None = None, target: str = TARGET, bad_label: int = 1
) -> DataFrame:
    """The ten measures of a plain loan table, per group."""
    group_cols = group_cols or []
    bad = F.col(target) == bad_label
    grouped = df.groupBy(*group_cols).agg(
        F.count("*").alias("total_credits"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("average_amount"),
        F.coalesce(F.sum(F.when(bad, F.col("amount"))), F.lit(0)).alias("bad_amount"),
        F.count_if(bad).alias("nb_true"),
        F.count_if(~bad).alias("nb_false"),
    )
    credits, amount = F.col("total_credits"), F.col("total_amount")
    # One row per group: all loans are the sum of the groups, so the table is read once.
    everything = F.sum("total_credits").over(Window.partitionBy()) if group_cols else credits
    return grouped.withColumns(
        {
            "default_rate": F.try_divide(F.col("nb_true"), credits),
            "pct_of_all_credits": F.try_divide(credits, everything),
            "risk_density": F.try_divide(F.col("bad_amount"), amount),
            "true_greater_than_false": F.when(F.col("nb_true") > F.col("nb_false"), 1).otherwise(0),
        }
    )


# Columns that are added up, and the name of their sum.
SUMMED = {
    "credit_amount": "amount",
    "expected_profit": "expected_profit",
    "expected_loss": "expected_loss",
    "expected_value": "expected_value",
    "exposure_at_risk": "exposure_at_risk",
    "PD": "pd",
    "LGD": "lgd",
}


def _exact(df: DataFrame, name: str) -> Column:
    """Doubles are added as decimals, so a sum does not depend on the order of rows."""
    return F.col(name).cast(FINE_AMOUNT) if df.schema[name].dataType.typeName() in ("double", "float") else F.col(name)


def _portfolio_sums(df: DataFrame, group_cols: list[str]) -> DataFrame:
    """Sums over all loans (``<name>``) and over the selected ones (``<name>_sel``).

    Rows are added up once per group and choice; the few sums that remain are then
    combined, instead of adding every row to both the baseline and the selection.
    """
    flag = F.coalesce(F.col("optim_choice").cast("int"), F.lit(0)).alias("_choice")
    once = (
        df.select(*group_cols, flag, *[c for c in SUMMED if c not in group_cols])
        .groupBy(*group_cols, "_choice")
        .agg(F.count("*").alias("credits"), *[F.sum(_exact(df, c)).alias(name) for c, name in SUMMED.items()])
    )
    selected = F.col("_choice") == 1
    nothing = F.lit(0)
    return once.groupBy(*group_cols).agg(
        F.max("_choice").alias("test_optim"),
        F.coalesce(F.sum("credits"), nothing).alias("credits"),
        F.coalesce(F.sum(F.when(selected, F.col("credits"))), nothing).alias("credits_sel"),
        *[F.sum(name).alias(name) for name in SUMMED.values()],
        *[F.sum(F.when(selected, F.col(name))).alias(f"{name}_sel") for name in SUMMED.values()],
        F.sum(F.when(~selected, F.col("expected_loss"))).alias("expected_loss_removed"),
    )


def portfolio_measures(df: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """All numeric measures of a portfolio with ``optim_choice``, per group."""
    group_cols = group_cols or []
    sums = _portfolio_sums(df, group_cols)

    def number(name: str) -> Column:
        return F.col(name).cast("double")

    def whole_and_selected(measure: str, name: str) -> dict[str, Column]:
        return {f"{measure}_baseline": number(name), f"{measure}_optimized": number(f"{name}_sel")}

    def mean(name: str, suffix: str = "") -> Column:
        return F.try_divide(number(f"{name}{suffix}"), F.col(f"credits{suffix}"))

    measures = {
        "total_credits": F.col("credits"),
        "total_amount": F.col("amount"),
        "total_expected_profit": number("expected_profit"),
        "total_expected_loss": number("expected_loss"),
        "total_expected_value": number("expected_value"),
        "total_exposure_at_risk": number("exposure_at_risk"),
        "average_pd": mean("pd"),
        "average_lgd": mean("lgd"),
        "total_credits_baseline": F.col("credits"),
        "total_credits_optimized": F.col("credits_sel"),
        "total_amount_baseline": F.col("amount"),
        "total_amount_optimized": F.col("amount_sel"),
        **whole_and_selected("expected_profit", "expected_profit"),
        **whole_and_selected("expected_loss", "expected_loss"),
        **whole_and_selected("expected_value", "expected_value"),
        **whole_and_selected("exposure_at_risk", "exposure_at_risk"),
        "average_pd_baseline": mean("pd"),
        "average_pd_optimized": mean("pd", "_sel"),
        "average_lgd_baseline": mean("lgd"),
        "average_lgd_optimized": mean("lgd", "_sel"),
        "avg_ev_baseline": mean("expected_value"),
        "avg_ev_optimized": mean("expected_value", "_sel"),
        "expected_loss_kept": number("expected_loss_sel"),
        "expected_loss_removed": number("expected_loss_removed"),
        "test_optim": F.col("test_optim"),
    }
    table = sums.select(*group_cols, *[column.alias(name) for name, column in measures.items()])

    # A missing side counts as zero in a difference.
    def difference(name: str) -> Column:
        return F.coalesce(f"{name}_optimized", F.lit(0.0)) - F.coalesce(f"{name}_baseline", F.lit(0.0))

    table = table.withColumns(
        {
            "delta_expected_profit": difference("expected_profit"),
            "delta_expected_loss": difference("expected_loss"),
            "delta_expected_value": difference("expected_value"),
            "delta_exposure_at_risk": difference("exposure_at_risk"),
            "expected_loss_baseline_k": F.col("expected_loss_baseline") / 1000,
            "expected_loss_optimized_k": F.col("expected_loss_optimized") / 1000,
            **{
                f"value_per_risk_unit_{side}": F.try_divide(
                    F.col(f"expected_value_{side}"), F.col(f"expected_loss_{side}")
                )
                for side in ("baseline", "optimized")
            },
        }
    )
    return table.withColumn("delta_value_per_risk_unit", difference("value_per_risk_unit"))


def _card(optimized: Column, baseline: Column) -> Column:
    """Both sides of a card; a side without value shows nothing behind its label."""
    empty = F.lit("")
    return F.concat(
        F.lit("Optimized: "), F.coalesce(optimized, empty), F.lit("  |  Baseline: "), F.coalesce(baseline, empty)
    )


def card_texts(measures: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """Formatted card texts from the result of ``portfolio_measures``.

    K means thousands and M millions in every card.
    """
    def sides(name: str, digits: int, unit: int = 1, suffix: str = "") -> Column:
        return _card(
            *[
                F.concat(F.format_number(F.col(f"{name}_{side}") / unit, digits), F.lit(suffix))
                for side in ("optimized", "baseline")
            ]
        )

    def plain(column: Column, digits: int) -> Column:
        """A number without thousands separators."""
        return F.replace(F.format_number(column, digits), F.lit(","), F.lit(""))

    exposure = _card(
        F.concat(plain(F.col("exposure_at_risk_optimized") / 1_000, 0), F.lit("K")),
        F.concat(plain(F.col("exposure_at_risk_baseline") / 1_000_000, 2), F.lit("M")),
    )
    efficiency = _card(plain(F.col("value_per_risk_unit_optimized"), 2), plain(F.col("value_per_risk_unit_baseline"), 2))
    return measures.select(
        *(group_cols or []),
        sides("total_credits", 0).alias("card_title_total_credits"),
        F.concat(F.lit("Versus Baseline: "), F.format_number("total_credits_baseline", 0)).alias(
            "card_subtitle_total_credits"
        ),
        sides("total_amount", 2, 1_000_000, "M").alias("card_title_total_amount"),
        sides("expected_loss", 2, 1_000, "K").alias("card_title_expected_loss"),
        sides("expected_value", 0).alias("card_title_expected_value"),
        efficiency.alias("card_title_risk_efficiency"),
        exposure.alias("card_title_exposure_at_risk"),
        _card(plain(F.col("avg_ev_optimized"), 0), plain(F.col("avg_ev_baseline"), 0)).alias(
            "card_title_avg_expected_value"
        ),
    )


def waterfall_expected_loss(df: DataFrame) -> DataFrame:
    """Expected loss from baseline to optimised, one row per step.

    The step between removal and result is kept - optimized: the same sum twice, so it is
    always 0 and Baseline - Removed = Optimized.
    """
    sums = portfolio_measures(df)
    baseline, removed, kept, optimized = (
        F.coalesce(F.col(c), F.lit(0.0))
        for c in ("expected_loss_baseline", "expected_loss_removed", "expected_loss_kept", "expected_loss_optimized")
    )
    amounts = sums.select(
        baseline.alias("Baseline"),
        (-removed).alias("Removed Credits"),
        (kept - optimized).alias("Exposure Reduction"),
        optimized.alias("Optimized"),
    )
    amounts = amounts.unpivot([], amounts.columns, "Step", "expected_loss")
    # Four fixed rows on either side.
    steps = F.broadcast(steps_table(df.sparkSession))
    return amounts.join(steps, "Step").select("Step", "Order", "expected_loss").orderBy("Order")
