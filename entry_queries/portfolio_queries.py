"""Selection, portfolio aggregates, measures and report visuals."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanweave.functions.decisions import portfolio_type
from loanweave.operators import measures as M
from loanweave.operators import portfolio as P
from loanweave.operators.model import top_k
from loanweave.operators.profiling import describe_selected
from loanweave.plans import reports as R
from loanweave.session import stage

from . import inputs
from .registry import query, with_bins, with_loans, with_risk, with_selection

MEAN = "round(CAST(sum({0}) AS DOUBLE) / count({0}), 6)"


@query("select_portfolio", with_selection("SELECT id, optim_choice FROM opt"))
def q_select_portfolio(spark, sf_dir):
    return inputs.selected(spark, sf_dir).select("id", "optim_choice")


@query(
    "select_portfolio_prefix",
    with_selection("SELECT id, CASE WHEN id IN (SELECT id FROM prefix) THEN 1 ELSE 0 END AS optim_choice FROM risk"),
)
def q_select_portfolio_prefix(spark, sf_dir):
    """The covered part of the ranking alone, without filling up."""
    return P.select_portfolio(inputs.risk(spark, sf_dir), fill=False).select("id", "optim_choice")


@query(
    "select_portfolio_exact",
    with_selection(
        """SELECT count(*) AS loans, round(CAST(0.30 * sum(exposure_at_risk) AS DOUBLE), 4) AS allowed, true AS within_budget,
        round(CAST(sum(expected_value) FILTER (optim_choice = 1) AS DOUBLE), 2) AS value_by_rule, true AS not_below_rule,
        true AS not_above_bound FROM opt"""
    ),
)
def q_select_portfolio_exact(spark, sf_dir):
    """The best choice beside the ranked one: within the budget, worth as much at least, not above the bound."""
    risk = stage(inputs.risk(spark, sf_dir).select("id", "expected_value", "exposure_at_risk"), "rated-loans")
    rule, best = P.plan_portfolio(risk), P.plan_portfolio(risk, exact=True)
    value, weight = F.col("expected_value"), F.col("exposure_at_risk")
    sums = risk.agg(
        F.count("*").alias("loans"),
        (F.sum(weight) * F.lit("0.30").cast("decimal(9,6)")).alias("allowed"),
        F.sum(F.when(rule.chosen(), value)).alias("rule"),
        F.sum(F.when(best.chosen(), value)).alias("best"),
        F.sum(F.when(best.chosen(), weight)).alias("used"),
    )
    bound = P.portfolio_bound(risk, best).first()["upper_bound"]
    return sums.select(
        "loans",
        F.round(F.col("allowed").cast("double"), 4).alias("allowed"),
        (F.col("used") <= F.col("allowed")).alias("within_budget"),
        F.round(F.col("rule").cast("double"), 2).alias("value_by_rule"),
        (F.col("best") >= F.col("rule")).alias("not_below_rule"),
        (F.col("best").cast("double") <= bound * (1 + 1e-12)).alias("not_above_bound"),
    )


@query("optim_choice", with_selection("SELECT optim_choice, count(*) AS loans FROM opt GROUP BY optim_choice"))
def q_optim_choice(spark, sf_dir):
    return inputs.selected(spark, sf_dir).groupBy("optim_choice").agg(F.count("*").alias("loans"))


@query(
    "portfolio_type",
    with_selection(
        """SELECT id, CASE WHEN optim_choice = 1 THEN 'Optimized' ELSE 'Baseline' END AS portfolio_type,
        CASE WHEN credit_risk = 1 THEN 'Risque élevé' ELSE 'Risque faible' END AS credit_risk_niveau FROM opt"""
    ),
)
def q_portfolio_type(spark, sf_dir):
    return inputs.optimised(spark, sf_dir).select("id", "portfolio_type", "credit_risk_niveau")


@query("filter_selected", with_selection("SELECT id, CAST(expected_value AS DOUBLE) AS expected_value FROM opt WHERE optim_choice = 1"))
def q_filter_selected(spark, sf_dir):
    kept = P.filter_selected(inputs.selected(spark, sf_dir))
    return kept.select("id", *inputs.doubles(kept, "expected_value"))


@query(
    "portfolio_bound",
    with_selection(
        """SELECT round(selected, 2) AS selected_value, round(bound, 2) AS upper_bound, round((bound - selected) / bound, 9) AS gap FROM (
        SELECT CAST((SELECT sum(expected_value) FROM opt WHERE optim_choice = 1) AS DOUBLE) AS selected,
        sum(greatest(CAST(expected_value AS DOUBLE) - price * CAST(exposure_at_risk AS DOUBLE), 0.0))
          + max(allowed) * max(price) AS bound
        FROM risk, (SELECT CAST(allowed AS DOUBLE) AS allowed FROM budget),
        (SELECT CAST(v AS DOUBLE) / CAST(w AS DOUBLE) AS price FROM running
         WHERE rn = (SELECT count(*) + 1 FROM prefix)))"""
    ),
)
def q_portfolio_bound(spark, sf_dir):
    risk = inputs.risk(spark, sf_dir)
    bound = P.portfolio_bound(risk, P.plan_portfolio(risk))
    return bound.select(*inputs.doubles(bound, "selected_value", "upper_bound", digits=2), F.round("gap", 9).alias("gap"))


@query(
    "check_budget",
    with_selection(
        """SELECT round(CAST(sum(exposure_at_risk) FILTER (optim_choice = 1) AS DOUBLE), 4) AS used,
        round(CAST(0.30 * sum(exposure_at_risk) AS DOUBLE), 4) AS allowed, true AS within_budget FROM opt"""
    ),
)
def q_check_budget(spark, sf_dir):
    check = P.check_budget(inputs.selected(spark, sf_dir))
    return check.select(*inputs.doubles(check, "used", "allowed", digits=4), "within_budget")


@query("risk_budget", with_risk("SELECT round(CAST(0.30 * sum(exposure_at_risk) AS DOUBLE), 4) AS risk_budget FROM risk"))
def q_risk_budget(spark, sf_dir):
    return P.risk_budget(inputs.risk(spark, sf_dir)).select(F.round("risk_budget", 4).alias("risk_budget"))


@query(
    "attach_optim_choice",
    with_selection(
        """SELECT id, amount, CASE WHEN optim_choice = 1 AND amount > 2000 THEN 1 ELSE 0 END AS optim_choice FROM opt"""
    ),
)
def q_attach_optim_choice(spark, sf_dir):
    """Flags exist for loans above 2000 only; the others get 0 from the join."""
    flags = inputs.selected(spark, sf_dir, "amount").filter("amount > 2000").select("id", "optim_choice")
    return P.attach_optim_choice(inputs.loans(spark, sf_dir), flags).select("id", "amount", "optim_choice")


@query("selected_semi", with_selection("SELECT id, amount FROM opt WHERE optim_choice = 1"))
def q_selected_semi(spark, sf_dir):
    kept = P.filter_selected(inputs.selected(spark, sf_dir))
    return P.selected_semi(inputs.loans(spark, sf_dir), kept).select("id", "amount")


@query("removed_anti", with_selection("SELECT id, amount FROM opt WHERE optim_choice = 0"))
def q_removed_anti(spark, sf_dir):
    kept = P.filter_selected(inputs.selected(spark, sf_dir))
    return P.removed_anti(inputs.loans(spark, sf_dir), kept).select("id", "amount")


@query(
    "portfolio_totals",
    with_selection(
        """SELECT CAST(sum(expected_value) AS DOUBLE) AS total_expected_value, CAST(sum(exposure_at_risk) AS DOUBLE) AS total_risk,
        CAST(sum(amount) AS BIGINT) AS total_amount FROM opt WHERE optim_choice = 1"""
    ),
)
def q_portfolio_totals(spark, sf_dir):
    return P.portfolio_totals(inputs.selected(spark, sf_dir, "credit_amount"))


@query(
    "portfolio_means",
    with_selection(
        f"""SELECT {MEAN.format('pd')} AS pd_mean, {MEAN.format('lgd')} AS lgd_mean,
        {MEAN.format('expected_value')} AS ev_mean FROM opt WHERE optim_choice = 1"""
    ),
)
def q_portfolio_means(spark, sf_dir):
    means = P.portfolio_means(inputs.selected(spark, sf_dir, "PD", "LGD"))
    return means.select(*inputs.doubles(means, "pd_mean", "lgd_mean", "ev_mean", digits=6))


@query(
    "portfolio_comparison",
    with_selection(
        " UNION ALL ".join(
            f"SELECT '{short}_{when}' AS metric, {MEAN.format(name)} AS value FROM opt{where}"
            for short, name in (("PD", "pd"), ("LGD", "lgd"), ("EV", "expected_value"))
            for when, where in (("initial", ""), ("optim", " WHERE optim_choice = 1"))
        )
    ),
)
def q_portfolio_comparison(spark, sf_dir):
    comparison = P.portfolio_comparison(inputs.selected(spark, sf_dir, "PD", "LGD"))
    return comparison.select("metric", *inputs.doubles(comparison, "value", digits=6))


DESCRIBED = ["credit_amount", "expected_profit", "expected_loss", "expected_value", "exposure_at_risk", "PD", "LGD", "profit_margin"]


@query(
    "describe_selected",
    with_selection(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS variable, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 6) AS mean,
            round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max
            FROM opt WHERE optim_choice = 1"""
            for c in DESCRIBED
        )
    ),
)
def q_describe_selected(spark, sf_dir):
    described = describe_selected(P.filter_selected(inputs.selected(spark, sf_dir, *DESCRIBED)), DESCRIBED)
    return described.select(
        "variable", "count", *inputs.doubles(described, "mean", "std", "p25", "p50", "p75", digits=6), "min", "max"
    )


@query(
    "top_k",
    with_risk(
        """SELECT id, purpose, CAST(expected_value AS DOUBLE) AS expected_value FROM risk
        ORDER BY expected_value DESC, id LIMIT 15"""
    ),
)
def q_top_k(spark, sf_dir):
    best = top_k(inputs.risk(spark, sf_dir), "expected_value", 15, "id")
    return best.select("id", "purpose", *inputs.doubles(best, "expected_value"))


BASELINE = """count(*) AS total_credits, CAST(sum(amount) AS BIGINT) AS total_amount, round(avg(amount), 6) AS average_amount,
    CAST(sum(CASE WHEN credit_risk = 1 THEN amount ELSE 0 END) AS BIGINT) AS bad_amount,
    count(*) FILTER (credit_risk = 1) AS nb_true, count(*) FILTER (credit_risk = 0) AS nb_false,
    round(count(*) FILTER (credit_risk = 1) / count(*), 9) AS default_rate,
    round(count(*) / (SELECT count(*) FROM loans), 9) AS pct_of_all_credits,
    round(sum(CASE WHEN credit_risk = 1 THEN amount ELSE 0 END) / sum(amount), 9) AS risk_density,
    CASE WHEN count(*) FILTER (credit_risk = 1) > count(*) FILTER (credit_risk = 0) THEN 1 ELSE 0 END AS true_greater_than_false"""


def rounded_baseline(df, group_cols):
    table = M.baseline_measures(df, group_cols)
    digits = {"average_amount": 6, "default_rate": 9, "pct_of_all_credits": 9, "risk_density": 9}
    return table.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("baseline_measures", with_bins(f"SELECT {BASELINE} FROM binned"))
def q_baseline_measures(spark, sf_dir):
    return rounded_baseline(inputs.binned(spark, sf_dir), [])


@query("baseline_measures_by_age", with_bins(f"SELECT age_cat, {BASELINE} FROM binned GROUP BY age_cat"))
def q_baseline_measures_by_age(spark, sf_dir):
    return rounded_baseline(inputs.binned(spark, sf_dir), ["age_cat"])


SIDES = {"baseline": "", "optimized": " FILTER (optim_choice = 1)"}
SUMS = ["expected_profit", "expected_loss", "expected_value", "exposure_at_risk"]


def double_sum(name: str, side: str) -> str:
    return f"CAST(sum({name}){SIDES[side]} AS DOUBLE)"


def portfolio_sql(group: str | None) -> str:
    """All measures, each written out as its own aggregate."""
    parts = [
        "count(*) AS total_credits",
        "CAST(sum(amount) AS BIGINT) AS total_amount",
        "max(optim_choice) AS test_optim",
        "CAST(sum(expected_loss) FILTER (optim_choice = 0) AS DOUBLE) AS expected_loss_removed",
        "CAST(sum(expected_loss) FILTER (optim_choice = 1) AS DOUBLE) AS expected_loss_kept",
    ]
    parts += [f"{double_sum(c, 'baseline')} AS total_{c}" for c in SUMS]
    parts += [f"round(CAST(sum({c}) AS DOUBLE) / count(*), 6) AS average_{c}" for c in ("pd", "lgd")]
    for side, where in SIDES.items():
        parts += [
            f"count(*){where} AS total_credits_{side}",
            f"CAST(sum(amount){where} AS BIGINT) AS total_amount_{side}",
            *[f"{double_sum(c, side)} AS {c}_{side}" for c in SUMS],
            *[
                f"round(CAST(sum({c}){where} AS DOUBLE) / nullif(count(*){where}, 0), 6) AS {alias}_{side}"
                for c, alias in (("pd", "average_pd"), ("lgd", "average_lgd"), ("expected_value", "avg_ev"))
            ],
            f"round({double_sum('expected_value', side)} / nullif({double_sum('expected_loss', side)}, 0), 6) "
            f"AS value_per_risk_unit_{side}",
            f"round({double_sum('expected_loss', side)} / 1000, 6) AS expected_loss_{side}_k",
        ]
    parts += [
        f"round(coalesce({double_sum(c, 'optimized')}, 0) - {double_sum(c, 'baseline')}, 4) AS delta_{c}" for c in SUMS
    ]
    ratio = "coalesce({} / nullif({}, 0), 0)"
    parts.append(
        "round("
        + " - ".join(
            ratio.format(double_sum("expected_value", s), double_sum("expected_loss", s)) for s in ("optimized", "baseline")
        )
        + ", 6) AS delta_value_per_risk_unit"
    )
    grouped = f"SELECT {group}, " if group else "SELECT "
    return with_selection(grouped + ", ".join(parts) + " FROM opt" + (f" GROUP BY {group}" if group else ""))


ROUNDED = {
    **{
        f"{name}{side}": 6
        for name in ("average_pd", "average_lgd")
        for side in ("", "_baseline", "_optimized")
    },
    **{f"avg_ev_{side}": 6 for side in SIDES},
    **{f"value_per_risk_unit_{side}": 6 for side in SIDES},
    **{f"expected_loss_{side}_k": 6 for side in SIDES},
    **{f"delta_{c}": 4 for c in SUMS},
    "delta_value_per_risk_unit": 6,
}


def rounded_portfolio(df, group_cols):
    return M.portfolio_measures(df, group_cols).withColumns({c: F.round(c, d) for c, d in ROUNDED.items()})


@query("portfolio_measures", portfolio_sql(None))
def q_portfolio_measures(spark, sf_dir):
    return rounded_portfolio(inputs.optimised(spark, sf_dir), [])


@query("portfolio_measures_by_age", portfolio_sql("age_cat"))
def q_portfolio_measures_by_age(spark, sf_dir):
    return rounded_portfolio(inputs.optimised(spark, sf_dir), ["age_cat"])


TEXT = """SELECT concat('Optimized: ', {opt}, '  |  Baseline: ', {base}) AS {name}"""
CARD_SUMS = """, sums AS (SELECT count(*) AS n_b, count(*) FILTER (optim_choice = 1) AS n_o,
    CAST(sum(amount) AS DOUBLE) AS a_b, CAST(sum(amount) FILTER (optim_choice = 1) AS DOUBLE) AS a_o,
    CAST(sum(expected_loss) AS DOUBLE) AS l_b, CAST(sum(expected_loss) FILTER (optim_choice = 1) AS DOUBLE) AS l_o,
    CAST(sum(expected_value) AS DOUBLE) AS v_b, CAST(sum(expected_value) FILTER (optim_choice = 1) AS DOUBLE) AS v_o,
    CAST(sum(exposure_at_risk) AS DOUBLE) AS x_b, CAST(sum(exposure_at_risk) FILTER (optim_choice = 1) AS DOUBLE) AS x_o
    FROM opt)"""


def card_sql(optimized: str, baseline: str, name: str) -> str:
    return f"concat('Optimized: ', {optimized}, '  |  Baseline: ', {baseline}) AS {name}"


@query(
    "card_texts",
    with_selection(
        "SELECT "
        + ", ".join(
            [
                card_sql("format('{:,}', n_o)", "format('{:,}', n_b)", "card_title_total_credits"),
                "concat('Versus Baseline: ', format('{:,}', n_b)) AS card_subtitle_total_credits",
                card_sql(
                    "format('{:,.2f}', a_o / 1000000), 'M'", "format('{:,.2f}', a_b / 1000000), 'M'", "card_title_total_amount"
                ),
                card_sql("format('{:,.2f}', l_o / 1000), 'K'", "format('{:,.2f}', l_b / 1000), 'K'", "card_title_expected_loss"),
                card_sql("format('{:,.0f}', v_o)", "format('{:,.0f}', v_b)", "card_title_expected_value"),
                card_sql("format('{:.2f}', v_o / l_o)", "format('{:.2f}', v_b / l_b)", "card_title_risk_efficiency"),
                card_sql(
                    "format('{:.0f}', x_o / 1000), 'K'", "format('{:.2f}', x_b / 1000000), 'M'", "card_title_exposure_at_risk"
                ),
                card_sql("format('{:.0f}', v_o / n_o)", "format('{:.0f}', v_b / n_b)", "card_title_avg_expected_value"),
            ]
        )
        + " FROM sums",
        CARD_SUMS,
    ),
)
def q_card_texts(spark, sf_dir):
    return M.card_texts(M.portfolio_measures(inputs.optimised(spark, sf_dir)))


WATERFALL = """SELECT 'Baseline' AS "Step", 1 AS "Order", CAST(sum(expected_loss) AS DOUBLE) AS expected_loss FROM opt
    UNION ALL SELECT 'Removed Credits', 2, CAST(-sum(expected_loss) AS DOUBLE) FROM opt WHERE optim_choice = 0
    UNION ALL SELECT 'Exposure Reduction', 3, 0.0::DOUBLE
    UNION ALL SELECT 'Optimized', 4, CAST(sum(expected_loss) AS DOUBLE) FROM opt WHERE optim_choice = 1"""


@query("waterfall_expected_loss", with_selection(WATERFALL))
def q_waterfall_expected_loss(spark, sf_dir):
    return M.waterfall_expected_loss(inputs.optimised(spark, sf_dir))


@query(
    "waterfall_join",
    with_selection(f'SELECT "Order", "Step", round(expected_loss / 1000, 6) AS expected_loss_k FROM ({WATERFALL})'),
)
def q_waterfall_join(spark, sf_dir):
    steps = M.waterfall_expected_loss(inputs.optimised(spark, sf_dir))
    return steps.select("Order", "Step", F.round(F.col("expected_loss") / 1000, 6).alias("expected_loss_k"))


@query("report_treemap_age", with_bins("SELECT age_cat, count(*) AS total_credits FROM binned GROUP BY age_cat"))
def q_report_treemap_age(spark, sf_dir):
    return R.treemap_age(inputs.binned(spark, sf_dir))


@query(
    "report_default_rate_by_age",
    with_bins("SELECT age_cat, round(avg(credit_risk), 9) AS default_rate FROM binned GROUP BY age_cat"),
)
def q_report_default_rate_by_age(spark, sf_dir):
    return R.default_rate_by_age(inputs.binned(spark, sf_dir)).withColumn("default_rate", F.round("default_rate", 9))


PIVOT = """SELECT coalesce(purpose, 'Total') AS purpose, CAST(sum(amount) AS BIGINT) AS amount,
    CAST(coalesce(sum(amount) FILTER (credit_risk = 0), 0) AS BIGINT) AS amount_0,
    CAST(coalesce(sum(amount) FILTER (credit_risk = 1), 0) AS BIGINT) AS amount_1,
    round(coalesce(sum(amount) FILTER (credit_risk = 0), 0) / sum(amount), 9) AS share_0,
    round(coalesce(sum(amount) FILTER (credit_risk = 1), 0) / sum(amount), 9) AS share_1,
    CAST(coalesce(sum(amount) FILTER (credit_risk IS NULL), 0) AS BIGINT) AS amount_none,
    round(coalesce(sum(amount) FILTER (credit_risk IS NULL), 0) / sum(amount), 9) AS share_none,
    round(coalesce(sum(amount) FILTER (credit_risk IS NULL), 0) / (SELECT sum(amount) FROM loans WHERE credit_risk IS NULL), 9)
      AS column_share_none,
    round(coalesce(sum(amount) FILTER (credit_risk = 0), 0) / (SELECT sum(amount) FROM loans WHERE credit_risk = 0), 9)
      AS column_share_0,
    round(coalesce(sum(amount) FILTER (credit_risk = 1), 0) / (SELECT sum(amount) FROM loans WHERE credit_risk = 1), 9)
      AS column_share_1
    FROM loans GROUP BY ROLLUP (purpose)"""


@query("report_purpose_risk_pivot", with_loans(PIVOT))
def q_report_purpose_risk_pivot(spark, sf_dir):
    pivot = R.purpose_risk_pivot(inputs.loans(spark, sf_dir))
    shares = [c for c in pivot.columns if "share" in c]
    return pivot.withColumns({c: F.round(c, 9) for c in shares})


@query(
    "report_amount_by_risk",
    with_loans("SELECT credit_risk, CAST(sum(amount) AS BIGINT) AS total_amount FROM loans GROUP BY credit_risk"),
)
def q_report_amount_by_risk(spark, sf_dir):
    return R.amount_by_risk(inputs.loans(spark, sf_dir))


@query("report_credits_by_risk", with_loans("SELECT credit_risk, count(*) AS total_credits FROM loans GROUP BY credit_risk"))
def q_report_credits_by_risk(spark, sf_dir):
    return R.credits_by_risk(inputs.loans(spark, sf_dir))


@query(
    "report_history_risk_share",
    with_loans(
        """SELECT credit_history, credit_risk, count(*) AS total_credits,
        round(count(*) / sum(count(*)) OVER (PARTITION BY credit_history), 9) AS share
        FROM loans GROUP BY credit_history, credit_risk"""
    ),
)
def q_report_history_risk_share(spark, sf_dir):
    return R.history_risk_share(inputs.loans(spark, sf_dir)).withColumn("share", F.round("share", 9))


@query(
    "report_cards",
    with_loans(
        """SELECT count(*) AS total_credits, CAST(sum(amount) FILTER (credit_risk = 1) AS BIGINT) AS bad_amount,
        round(avg(credit_risk), 9) AS default_rate, CAST(sum(amount) AS BIGINT) AS total_amount,
        round(sum(amount) FILTER (credit_risk = 1) / sum(amount), 9) AS risk_density FROM loans"""
    ),
)
def q_report_cards(spark, sf_dir):
    cards = R.cards(inputs.loans(spark, sf_dir))
    return cards.withColumns({c: F.round(c, 9) for c in ("default_rate", "risk_density")})


@query(
    "report_risk_distribution",
    with_selection(
        """SELECT CASE WHEN credit_risk = 1 THEN 'Risque élevé' ELSE 'Risque faible' END AS credit_risk_niveau,
        count(*) AS total_credits_baseline, count(*) FILTER (optim_choice = 1) AS total_credits_optimized,
        CAST(sum(exposure_at_risk) AS DOUBLE) AS exposure_at_risk_baseline,
        CAST(sum(exposure_at_risk) FILTER (optim_choice = 1) AS DOUBLE) AS exposure_at_risk_optimized FROM opt GROUP BY ALL"""
    ),
)
def q_report_risk_distribution(spark, sf_dir):
    return R.risk_distribution(inputs.optimised(spark, sf_dir))


@query(
    "report_loss_heatmap",
    with_selection(
        """SELECT purpose, age_cat, CAST(sum(expected_loss) AS DOUBLE) AS expected_loss_baseline,
        CAST(sum(expected_loss) FILTER (optim_choice = 1) AS DOUBLE) AS expected_loss_optimized
        FROM opt GROUP BY purpose, age_cat"""
    ),
)
def q_report_loss_heatmap(spark, sf_dir):
    return R.loss_heatmap(inputs.optimised(spark, sf_dir))


@query(
    "report_portfolio_kpis",
    with_selection(
        """SELECT count(*) AS total_credits_baseline, count(*) FILTER (optim_choice = 1) AS total_credits_optimized,
        CAST(sum(expected_loss) AS DOUBLE) AS expected_loss_baseline,
        CAST(sum(expected_loss) FILTER (optim_choice = 1) AS DOUBLE) AS expected_loss_optimized,
        CAST(sum(exposure_at_risk) AS DOUBLE) AS exposure_at_risk_baseline,
        CAST(sum(exposure_at_risk) FILTER (optim_choice = 1) AS DOUBLE) AS exposure_at_risk_optimized,
        CAST(sum(expected_value) AS DOUBLE) AS expected_value_baseline,
        CAST(sum(expected_value) FILTER (optim_choice = 1) AS DOUBLE) AS expected_value_optimized,
        round(CAST(sum(expected_value) AS DOUBLE) / CAST(sum(expected_loss) AS DOUBLE), 6) AS value_per_risk_unit_baseline,
        round(CAST(sum(expected_value) FILTER (optim_choice = 1) AS DOUBLE)
          / CAST(sum(expected_loss) FILTER (optim_choice = 1) AS DOUBLE), 6) AS value_per_risk_unit_optimized FROM opt"""
    ),
)
def q_report_portfolio_kpis(spark, sf_dir):
    kpis = R.portfolio_kpis(inputs.optimised(spark, sf_dir))
    ratios = ("value_per_risk_unit_baseline", "value_per_risk_unit_optimized")
    return kpis.withColumns({c: F.round(c, 6) for c in ratios})
