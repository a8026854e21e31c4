"""From a loan table to the optimised portfolio table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.decisions import credit_risk_level, portfolio_type
from ..functions.fixed_values import AS_DOUBLE, BUDGET_FRACTION, OPTIMISED_TABLE
from ..functions.risk import risk_columns
from ..operators.identity import loan_id
from ..operators.portfolio import select_portfolio
from ..session import stage
from ..sources.tables import DEFAULT_FORMAT, publish_gold, table_path

def optimise_portfolio(
    loans: DataFrame, budget_fraction: str | float = BUDGET_FRACTION, id: str = "id"
) -> DataFrame:
    """Risk columns, the selection, and the texts reports filter by. Money stays decimal.

    Loans with their risk columns are stored once: the ranking and all that follows read these columns, so the
    source is scanned once and no amount is computed anew wherever the rule names it.
    """
    if id not in loans.columns:
        loans = loan_id(loans, out=id)
    rated = stage(risk_columns(loans), "rated-loans")
    chosen = select_portfolio(rated, budget_fraction=budget_fraction, id=id)
    return chosen.withColumns({"portfolio_type": portfolio_type(), "credit_risk_niveau": credit_risk_level()})


def build_optimised(
    reporting: DataFrame,
    root: str,
    budget_fraction: str | float = BUDGET_FRACTION,
    fmt: str = DEFAULT_FORMAT,
    catalog: bool = False,
) -> DataFrame:
    """Write the optimised table with rates and money as DOUBLE, and name it for reports."""
    table = optimise_portfolio(reporting, budget_fraction)
    table = table.withColumns({c: table[c].cast("double") for c in AS_DOUBLE})
    path = table_path(root, "gold", OPTIMISED_TABLE)
    return publish_gold(table, path, OPTIMISED_TABLE, fmt, catalog, evolve=True)
