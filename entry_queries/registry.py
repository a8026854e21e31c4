"""Query registry and the SQL text that several checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanweave.sources.order_loans import DIRTY_EXPRESSIONS, LOAN_EXPRESSIONS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it has no SQL form."""
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def _columns(expressions: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in expressions.items())


LOANS = f"loans AS (SELECT {_columns(LOAN_EXPRESSIONS)} FROM orders JOIN customer ON o_custkey = c_custkey)"

DIRTY = (
    "dirty AS (SELECT "
    + ", ".join(
        f"{DIRTY_EXPRESSIONS.get(name, name)} AS {name}" for name in (*LOAN_EXPRESSIONS, "score")
    )
    + " FROM loans)"
)

BINNED = """binned AS (SELECT *,
  CASE WHEN duration <= 12 THEN '<=12' WHEN duration <= 24 THEN '13-24' WHEN duration <= 36 THEN '25-36'
       WHEN duration <= 48 THEN '37-48' ELSE '>48' END AS duration_cat,
  CASE WHEN amount <= 1000 THEN '<=1000' WHEN amount <= 2000 THEN '1001-2000' WHEN amount <= 5000 THEN '2001-5000'
       WHEN amount <= 10000 THEN '5001-10000' ELSE '>10000' END AS amount_cat,
  CASE WHEN present_residence <= 1 THEN '<=1' WHEN present_residence <= 3 THEN '2-3' ELSE '>=4' END AS present_residence_cat,
  CASE WHEN age < 25 THEN '<25' WHEN age <= 35 THEN '25-35' WHEN age <= 45 THEN '36-45' WHEN age <= 60 THEN '46-60'
       ELSE '>60' END AS age_cat,
  CASE WHEN number_credits <= 1 THEN '0-1' WHEN number_credits = 2 THEN '2' ELSE '>=3' END AS number_credits_cat,
  CASE people_liable WHEN 0 THEN '0' WHEN 1 THEN '1' ELSE '>=2' END AS people_liable_cat
  FROM loans)"""

RATED = """rated AS (SELECT *, CASE WHEN pd <= 0.05 THEN 0.08 WHEN pd <= 0.10 THEN 0.10 WHEN pd <= 0.25 THEN 0.12
       WHEN pd <= 0.45 THEN 0.18 ELSE 0.25 END::DECIMAL(4,2) AS profit_margin FROM
  (SELECT *, CASE WHEN credit_risk = 1 THEN 0.60 ELSE pd_history END::DECIMAL(4,2) AS pd FROM
  (SELECT *,
  CASE credit_history WHEN 'no credits taken/ all credits paid back duly' THEN 0.03
       WHEN 'all credits at this bank paid back duly' THEN 0.05
       WHEN 'existing credits paid back duly till now' THEN 0.10
       WHEN 'delay in paying off in the past' THEN 0.25
       WHEN 'critical account/ other credits existing (not at this bank)' THEN 0.45
       ELSE 0.20 END::DECIMAL(4,2) AS pd_history,
  CASE purpose WHEN 'car (new)' THEN 0.25 WHEN 'car (used)' THEN 0.30 WHEN 'furniture/equipment' THEN 0.35
       WHEN 'retraining' THEN 0.35 WHEN 'radio/television' THEN 0.40 WHEN 'repairs' THEN 0.40
       WHEN 'education' THEN 0.30 WHEN 'domestic appliances' THEN 0.45 WHEN 'business' THEN 0.60
       ELSE 0.45 END::DECIMAL(4,2) AS lgd
  FROM binned)))"""

RISK = """risk AS (SELECT *, expected_profit - expected_loss AS expected_value FROM (SELECT *, amount AS credit_amount,
  CAST(amount * profit_margin AS DECIMAL(20,4)) AS expected_profit,
  CAST(amount * pd * lgd AS DECIMAL(20,4)) AS expected_loss,
  CAST(amount * pd AS DECIMAL(20,4)) AS exposure_at_risk
  FROM rated))"""

# Ranking by value per risk; the longest part of it that the budget covers; then, behind the
# first loan that does not fit, one loan after the other that still fits.
SELECTION = """ranked AS (SELECT id, expected_value AS v, exposure_at_risk AS w,
    CAST(floor(log10(d)) AS BIGINT) * 10000000000000 + CAST(round(d / pow(10, floor(log10(d))) * 1e11) AS BIGINT) AS k
    FROM (SELECT *, CASE WHEN exposure_at_risk > 0 THEN CAST(expected_value AS DOUBLE) / CAST(exposure_at_risk AS DOUBLE) END AS d
    FROM risk) WHERE expected_value > 0),
  running AS (SELECT *, row_number() OVER (ORDER BY k DESC, id) AS rn,
    sum(w) OVER (ORDER BY k DESC, id ROWS UNBOUNDED PRECEDING) AS used FROM ranked),
  budget AS (SELECT 0.30 * sum(exposure_at_risk) AS allowed FROM risk),
  prefix AS (SELECT id, v, w, rn FROM running WHERE used <= (SELECT allowed FROM budget)),
  later AS (SELECT * FROM running WHERE rn > (SELECT count(*) + 1 FROM prefix)),
  fill(rn, remaining) AS (
    SELECT (SELECT count(*) + 1 FROM prefix),
      CAST((SELECT allowed FROM budget) - (SELECT sum(w) FROM prefix) AS DECIMAL(24,6))
    UNION ALL
    SELECT n.rn, CAST(f.remaining - n.w AS DECIMAL(24,6)) FROM fill f, LATERAL (
      SELECT min(l.rn) AS rn, arg_min(l.w, l.rn) AS w FROM later l WHERE l.rn > f.rn AND l.w <= f.remaining) n
    WHERE n.rn IS NOT NULL),
  chosen AS (SELECT id FROM prefix UNION ALL
    SELECT id FROM later WHERE rn IN (SELECT rn FROM fill)),
  opt AS (SELECT risk.*, CASE WHEN chosen.id IS NULL THEN 0 ELSE 1 END AS optim_choice
    FROM risk LEFT JOIN chosen ON risk.id = chosen.id)"""

PREDICTIONS = """predictions AS (SELECT id, CAST(credit_risk AS DOUBLE) AS label, p1,
  CASE WHEN p1 > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM (SELECT id, credit_risk, ((id * 7919) % 1000) / 1000.0::DOUBLE AS p1 FROM loans))"""


def with_loans(select: str) -> str:
    return f"WITH {LOANS} {select}"


def with_dirty(select: str) -> str:
    return f"WITH {LOANS}, {DIRTY} {select}"


def with_bins(select: str) -> str:
    return f"WITH {LOANS}, {BINNED} {select}"


def with_risk(select: str) -> str:
    return f"WITH {LOANS}, {BINNED}, {RATED}, {RISK} {select}"


def with_selection(select: str, more: str = "") -> str:
    return f"WITH RECURSIVE {LOANS}, {BINNED}, {RATED}, {RISK}, {SELECTION} {more} {select}"


def with_predictions(select: str, more: str = "") -> str:
    return f"WITH {LOANS}, {PREDICTIONS} {more} {select}"
