"""Selection, measures and reports against brute force."""

from __future__ import annotations

import itertools
import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanweave.operators import cutoff
from loanweave.operators import measures as M
from loanweave.operators import portfolio as P
from loanweave.operators.knapsack_core import solve_core
from loanweave.operators.sampling import oversample_minority, scale_features

COLUMNS = "id bigint, expected_value decimal(20,4), exposure_at_risk decimal(20,4)"


def portfolio(spark, rows):
    return spark.createDataFrame([(i, Decimal(v), Decimal(w)) for i, v, w in rows], COLUMNS)


def density(row):
    """Exponent and leading digits of value per weight."""
    d = float(row[1]) / float(row[2])
    exponent = math.floor(math.log10(d))
    return exponent * 10**13 + round(d / 10.0**exponent * 1e11)


def greedy(rows, fraction, fill=True):
    """Ranking order, taking every loan that fits (or stopping at the first that does not)."""
    left = sum(Decimal(w) for _, _, w in rows) * Decimal(fraction)
    chosen = {i for i, v, w in rows if Decimal(v) > 0 and Decimal(w) == 0}
    ranked = sorted(
        (r for r in rows if Decimal(r[1]) > 0 and Decimal(r[2]) > 0),
        key=lambda r: (-density(r), r[0]),
    )
    for i, _, w in ranked:
        if Decimal(w) <= left:
            chosen.add(i)
            left -= Decimal(w)
        elif not fill:
            break
    return chosen


def random_rows(seed, n=400, densities=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        weight = rng.randrange(1, 50_000) / 100
        density = rng.choice(densities) if densities else rng.uniform(-0.2, 2)
        rows.append((i * 13 - 2000, f"{weight * density:.4f}", f"{weight:.4f}"))
    return rows


def chosen_ids(df, **options):
    return {r.id for r in P.select_portfolio(df, **options).filter("optim_choice = 1").collect()}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("fraction", ["0.05", "0.30", "0.77"])
def test_selection_is_the_greedy_choice(spark, seed, fraction):
    rows = random_rows(seed, densities=[0.5, 1.0, 0.25] if seed % 2 else None)
    assert chosen_ids(portfolio(spark, rows), budget_fraction=fraction) == greedy(rows, fraction)


@pytest.mark.parametrize("slices,portion", [(2, 1), (16, 3)])
def test_small_slices_and_portions_change_nothing(spark, monkeypatch, slices, portion):
    monkeypatch.setattr(cutoff, "SLICES", slices)
    monkeypatch.setattr(P, "FILL_ROWS", portion)
    rows = random_rows(9, n=120, densities=[0.5, 1.0])
    assert chosen_ids(portfolio(spark, rows)) == greedy(rows, "0.30")


@pytest.mark.parametrize("scale", ["0.0001", "1", "100000000"])
def test_densities_of_any_size_are_ranked(spark, scale):
    """Weights from a million down and values from thousandths up: within one loan's value of the bound."""
    rows = [(i, str(Decimal(i) * Decimal(scale)), "100") for i in range(1, 301)]
    df = portfolio(spark, rows)
    plan = P.plan_portfolio(df)
    assert chosen_ids(df) == greedy(rows, "0.30") == set(range(211, 301))
    bound = P.portfolio_bound(df, plan).first()
    assert bound.upper_bound - bound.selected_value <= 300 * float(scale) * (1 + 1e-9)


def test_mixed_densities(spark):
    rng = random.Random(7)
    rows = [(i, f"{10 ** rng.uniform(-3, 9):.4f}", f"{10 ** rng.uniform(-3, 6):.4f}") for i in range(300)]
    assert chosen_ids(portfolio(spark, rows)) == greedy(rows, "0.30")


@pytest.mark.parametrize("bad", [1e-9, 1e13])
def test_amounts_that_would_be_lost_are_refused(spark, bad):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, bad)], "id bigint, expected_value double, exposure_at_risk double")
    with pytest.raises(Exception, match="cannot be kept"):
        P.plan_portfolio(df)


def test_number_of_jobs_does_not_follow_the_blocks(spark, monkeypatch):
    """Blocks of one small loan and nine that just do not fit."""
    monkeypatch.setattr(P, "FILL_ROWS", 10)

    def jobs(blocks):
        rows = [(0, "1000000", "1000"), (1, "2000000", "2000")]
        rows += [
            (2 + b * 10 + k, f"{(1000 - b) * w / 10000:.4f}", f"{w:.4f}")
            for b in range(blocks)
            for k, w in enumerate([1] + [1900] * 9)
        ]
        total = sum(float(w) for _, _, w in rows)
        group = f"blocks-{blocks}"
        spark.sparkContext.setJobGroup(group, group)
        df = portfolio(spark, rows)
        fraction = f"{2500 / total:.9f}"
        chosen = chosen_ids(df, budget_fraction=fraction)
        assert chosen == greedy(rows, fraction)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few, many = jobs(10), jobs(80)
    assert many <= few + 60


def test_small_loans_behind_a_large_one_are_taken_as_stretches(spark, monkeypatch):
    monkeypatch.setattr(P, "FILL_ROWS", 5)
    rng = random.Random(2)
    rows = [(0, "90000", "10000")] + [(i, str(rng.randrange(1, 9)), str(rng.randrange(1, 9))) for i in range(1, 900)]
    rows += [(i, str(rng.randrange(100, 900)), "1000") for i in range(900, 903)]
    df = portfolio(spark, rows)
    plan = P.plan_portfolio(df)
    # Every round looks at FILL_ROWS loans and halves what is left, from below 10,000 to the millionth.
    assert plan.stretches and len(plan.filled) <= 6 * 34
    chosen = {r.id for r in df.filter(plan.chosen()).collect()}
    assert chosen == greedy(rows, "0.30")
    assert plan.used == sum(Decimal(w) for i, _, w in rows if i in chosen)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_selection_does_not_depend_on_partitioning(spark, parts):
    rows = random_rows(5, densities=[1.0])
    assert chosen_ids(portfolio(spark, rows).repartition(parts)) == greedy(rows, "0.30")


def test_selection_without_filling_up(spark):
    rows = random_rows(6)
    assert chosen_ids(portfolio(spark, rows), fill=False) == greedy(rows, "0.30", fill=False)


def test_doubles_and_decimals_select_the_same(spark):
    rows = random_rows(7)
    df = portfolio(spark, rows)
    as_double = df.withColumns({c: df[c].cast("double") for c in ("expected_value", "exposure_at_risk")})
    assert chosen_ids(as_double) == chosen_ids(df)


def test_edges_of_the_budget(spark):
    rows = [(1, "5", "10"), (2, "0", "10"), (3, "-1", "10"), (4, "2", "0"), (5, "0", "0"), (6, "4", "10")]
    df = portfolio(spark, rows)
    assert chosen_ids(df, budget_fraction="0") == {4}
    assert chosen_ids(df, budget_fraction="1") == {1, 4, 6}
    assert chosen_ids(df, budget_fraction="0.25") == {1, 4}
    assert chosen_ids(df, budget_fraction="0.2499") == {4}
    assert chosen_ids(df.limit(0)) == set()
    assert chosen_ids(df.filter("expected_value <= 0")) == set()


@pytest.mark.parametrize("fraction,expected", [("1", {1, 2}), ("0.5", {1})])
def test_loans_without_value_or_weight_are_never_chosen(spark, fraction, expected):
    rows = [(9, None, None), (8, Decimal(3), None), (7, None, Decimal(10)), (1, Decimal(5), Decimal(10)), (2, Decimal(4), Decimal(10))]
    assert chosen_ids(spark.createDataFrame(rows, COLUMNS).filter("id != 7"), budget_fraction=fraction) == expected


def test_bound_holds_for_the_best_possible_choice(spark):
    for seed in range(3):
        rows = random_rows(seed, n=12)
        df = portfolio(spark, rows)
        plan = P.plan_portfolio(df)
        bound = P.portfolio_bound(df, plan).first()
        best = max(
            sum(Decimal(v) for _, v, _ in some)
            for size in range(13)
            for some in itertools.combinations(rows, size)
            if sum(Decimal(w) for _, _, w in some) <= plan.budget
        )
        assert bound.selected_value <= float(best) + 1e-9 <= bound.upper_bound + 1e-6
        assert plan.used <= plan.budget


def flagged(spark):
    rows = [
        (1, "a", 100, 10.0, 4.0, 6.0, 20.0, 0.2, 0.2, 1),
        (2, "a", 200, 30.0, 8.0, 22.0, 40.0, 0.2, 0.4, 0),
        (3, "b", 300, 10.0, 16.0, -6.0, 90.0, 0.6, 0.5, None),
    ]
    return spark.createDataFrame(
        rows,
        "id bigint, purpose string, credit_amount bigint, expected_profit double, expected_loss double, "
        "expected_value double, exposure_at_risk double, PD double, LGD double, optim_choice int",
    )


def test_portfolio_measures_by_hand(spark):
    row = M.portfolio_measures(flagged(spark)).first()
    assert (row.total_credits_baseline, row.total_credits_optimized, row.test_optim) == (3, 1, 1)
    assert (row.expected_loss_baseline, row.expected_loss_optimized, row.expected_loss_removed) == (28.0, 4.0, 24.0)
    assert row.delta_expected_value == 6.0 - 22.0 and row.value_per_risk_unit_optimized == 1.5
    assert row.average_pd_baseline == pytest.approx(1 / 3) and row.average_pd_optimized == pytest.approx(0.2)
    by_purpose = {r.purpose: r for r in M.portfolio_measures(flagged(spark), ["purpose"]).collect()}
    assert by_purpose["b"].total_credits_optimized == 0 and by_purpose["b"].average_pd_optimized is None
    assert by_purpose["b"].delta_expected_loss == -16.0


def test_zero_loss_gives_no_ratio(spark):
    df = flagged(spark).withColumn("expected_loss", F.lit(0.0))
    row = M.portfolio_measures(df).first()
    assert row.value_per_risk_unit_baseline is None and row.delta_value_per_risk_unit == 0.0


def test_waterfall_adds_up(spark):
    steps = [tuple(r) for r in M.waterfall_expected_loss(flagged(spark)).collect()]
    assert steps == [("Baseline", 1, 28.0), ("Removed Credits", 2, -24.0), ("Exposure Reduction", 3, 0.0), ("Optimized", 4, 4.0)]
    assert sum(s[2] for s in steps[:3]) == steps[3][2]


def test_cards(spark):
    card = M.card_texts(M.portfolio_measures(flagged(spark))).first()
    assert card.card_title_total_credits == "Optimized: 1  |  Baseline: 3"
    assert card.card_title_expected_loss == "Optimized: 0.00K  |  Baseline: 0.03K"
    assert card.card_title_risk_efficiency == "Optimized: 1.50  |  Baseline: 0.79"
    nothing = M.card_texts(M.portfolio_measures(flagged(spark).withColumn("optim_choice", F.lit(0)))).first()
    assert nothing.card_title_risk_efficiency == "Optimized:   |  Baseline: 0.79"


def test_baseline_measures_share_and_density(spark):
    df = spark.createDataFrame([("x", 100, 1), ("x", 300, 0), ("y", 0, 0)], "g string, amount bigint, credit_risk int")
    rows = {r.g: r for r in M.baseline_measures(df, ["g"]).collect()}
    assert rows["x"].risk_density == 0.25 and rows["x"].pct_of_all_credits == pytest.approx(2 / 3)
    assert rows["y"].risk_density is None and rows["y"].true_greater_than_false == 0
    whole = M.baseline_measures(df).first()
    assert whole.pct_of_all_credits == 1.0 and whole.default_rate == pytest.approx(1 / 3)


def test_attach_keeps_loans_without_a_flag(spark):
    loans = spark.range(4)
    flags = spark.createDataFrame([(1, 1), (2, 0)], "id bigint, optim_choice int")
    rows = {r.id: r.optim_choice for r in P.attach_optim_choice(loans, flags).collect()}
    assert rows == {0: 0, 1: 1, 2: 0, 3: 0}


@pytest.mark.parametrize("sizes", [{0: 50, 1: 7}, {0: 20, 1: 20}, {0: 31, 1: 15}])
def test_oversampling_balances_exactly(spark, sizes):
    rows = [(i, label) for label, n in sizes.items() for i in range(label * 1000, label * 1000 + n)]
    df = spark.createDataFrame(rows, "id bigint, label int")
    out = oversample_minority(df).collect()
    counts = {label: sum(r.label == label for r in out) for label in sizes}
    assert set(counts.values()) == {max(sizes.values())}
    assert {(r.id, r.label) for r in out} == set(rows)
    per_row = [sum(o.id == i for o in out) for i, label in rows if label == 1]
    assert max(per_row) - min(per_row) <= 1
    again = oversample_minority(df.repartition(7)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


@pytest.mark.parametrize("chunk", [7, 10_000])
def test_a_class_of_one_row_is_repeated_in_chunks(spark, chunk):
    df = spark.createDataFrame([(i, int(i > 0)) for i in range(101)], "id bigint, label int")
    out = oversample_minority(df, chunk=chunk)
    assert dict(out.dtypes)["copy"] == "bigint"
    assert sorted(r.copy for r in out.filter("id = 0").collect()) == list(range(1, 101))
    assert out.count() == 200


@pytest.mark.parametrize("last_rows", [5, 100_000])
def test_one_search_draws_for_all_classes(spark, monkeypatch, last_rows):
    monkeypatch.setattr("loanweave.operators.sampling.LAST_ROWS", last_rows)
    monkeypatch.setattr("loanweave.operators.sampling.SLICES", 8)

    def jobs(classes):
        group = f"classes-{classes}-{last_rows}"
        rows = [(k * 1000 + i, str(k) if k else None) for k in range(classes) for i in range(40 + 7 * k)]
        spark.sparkContext.setJobGroup(group, group)
        out = oversample_minority(spark.createDataFrame(rows, "id bigint, label string")).groupBy("label").count().collect()
        assert {r["count"] for r in out} == {40 + 7 * (classes - 1)} and len(out) == classes
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(12) <= jobs(3) + 12


def test_a_label_with_very_many_values_is_refused(spark, monkeypatch):
    monkeypatch.setattr("loanweave.operators.sampling.MOST_CLASSES", 3)
    with pytest.raises(ValueError, match="more than 3 values"):
        oversample_minority(spark.range(10).withColumn("label", F.col("id")))


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 10), (2.0, 10), (3.0, 13)], "a double, b int")
    rows = scale_features(df, ["a", "b"]).collect()
    assert [r.a_scaled for r in rows] == pytest.approx([-1.0, 0.0, 1.0])
    assert sum(r.b_scaled for r in rows) == pytest.approx(0.0)


def best_value(rows, budget):
    """Dynamic programming over whole weights."""
    best = np.zeros(budget + 1, np.int64)
    for _, v, w in rows:
        if int(v) > 0 and 0 < int(w) <= budget:
            best[int(w) :] = np.maximum(best[int(w) :], best[: len(best) - int(w)] + int(v))
    return int(best[-1])


def whole_rows(rng, n, kind):
    def row(i):
        w = rng.randrange(1, 200 if kind == "classes" else 900)
        if kind == "classes":
            return i, str(w * rng.choice((2, 3, 5))), str(w)
        if kind == "close":
            return i, str(w + 50 + rng.randrange(20)), str(w)
        return i, str(rng.randrange(-90, 900)), str(w)

    return [row(i) for i in range(n)]


@pytest.mark.parametrize("seed", range(200))
def test_core_is_solved_as_by_dynamic_programming(seed):
    rng = random.Random(seed)
    kind = ("any", "close", "classes")[seed % 3]
    rows = whole_rows(rng, 1_500 if seed % 10 == 0 else rng.choice((1, 5, 40, 300)), kind)
    wanted = sorted((r for r in rows if int(r[1]) > 0), key=lambda r: (-int(r[1]) / int(r[2]), r[0]))
    budget = sum(int(r[2]) for r in rows) * 3 // 10
    left, taken, blocked = budget, 0, None
    for _, v, w in wanted:
        if int(w) <= left:
            left, taken = left - int(w), taken + int(v)
        else:
            blocked = blocked or (int(v), int(w))
    if blocked is None:
        return
    price = blocked[0] / blocked[1]
    found = solve_core([int(r[1]) for r in wanted], [int(r[2]) for r in wanted], price, budget, taken)
    assert found.value == best_value(rows, budget) and found.proven, kind
    if found.chosen:
        assert sum(int(wanted[k][1]) for k in found.chosen) == found.value
        assert sum(int(wanted[k][2]) for k in found.chosen) <= budget


@pytest.mark.parametrize("kind", ["any", "close", "classes"])
@pytest.mark.parametrize("core_rows", [2_000, 25])
def test_exact_selection_is_the_best_one(spark, monkeypatch, kind, core_rows):
    monkeypatch.setattr(P, "CORE_ROWS", core_rows)
    rows = whole_rows(random.Random(11), 1_500, kind) + [(5_000, "7", "0"), (5_001, "0", "5"), (5_002, "9", "-3")]
    df = portfolio(spark, rows).repartition(5)
    budget = sum(int(w) for _, _, w in rows) * 3 // 10
    plan, rule = P.plan_portfolio(df, exact=True), P.plan_portfolio(df)
    ids, by_rule = ({x.id for x in df.filter(p.chosen()).collect()} for p in (plan, rule))
    chosen = [r for r in rows if r[0] in ids]
    reached = sum(int(v) for _, v, _ in chosen)
    assert plan.used == sum(int(w) for _, _, w in chosen) <= budget
    assert (5_000 in {r[0] for r in chosen}) and not {5_001, 5_002} & {r[0] for r in chosen}
    best = best_value(rows, budget) + 7
    assert reached >= sum(int(v) for i, v, _ in rows if i in by_rule)
    assert reached == best or not plan.optimal
    if core_rows == 2_000:
        assert plan.optimal and reached == best
    bound = P.portfolio_bound(df, plan).first()
    assert bound.selected_value == reached and 0 <= bound.gap <= P.portfolio_bound(df, rule).first().gap


def test_exact_selection_where_everything_fits(spark):
    plan = P.plan_portfolio(portfolio(spark, [(1, "5", "1"), (2, "-1", "9")]), exact=True)
    assert plan.optimal and plan.used == 1
    assert P.plan_portfolio(portfolio(spark, []), exact=True).optimal
