"""Running totals, quantiles, profiles and metrics against brute force."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanweave.operators import evaluation as E
from loanweave.operators import profiling as P
from loanweave.operators.identity import loan_id, train_test_split, with_split
from loanweave.operators import running_totals as running_totals_module
from loanweave.operators.running_totals import running_totals


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_running_totals(spark, parts):
    rng = random.Random(parts)
    rows = [(i, rng.choice([0, 0, 0, rng.randrange(10**9)]), rng.randrange(100)) for i in range(700)]
    df = spark.createDataFrame(rows, "id bigint, key bigint, n bigint").repartition(parts)
    got = running_totals(df, [F.col("key").desc(), F.col("id")], ["n"]).collect()
    total, expected = 0, {}
    for i, _, n in sorted(rows, key=lambda r: (-r[1], r[0])):
        total += n
        expected[i] = total
    assert {r.id: r.cum_n for r in got} == expected
    assert {r.total_n for r in got} == {total}


def test_running_totals_per_group(spark):
    rng = random.Random(8)
    rows = [(rng.choice("aaab"), i, rng.randrange(9)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, key bigint, n bigint").repartition(5)
    got = running_totals(df, [F.col("key")], ["n"], group_by=["g"]).collect()
    for group in "ab":
        own = sorted(r for r in rows if r[0] == group)
        sums = list(itertools.accumulate(r[2] for r in own))
        ours = sorted((r.key, r.cum_n, r.total_n) for r in got if r.g == group)
        assert ours == [(r[1], total, sums[-1]) for r, total in zip(own, sums)]


def test_ranges_follow_the_rows(spark, monkeypatch):
    assert [running_totals_module.range_count(n) for n in (0, 1, 100_000, 100_001, 10**6, 10**12)] == [1, 1, 1, 2, 10, 20_000]
    monkeypatch.setattr(running_totals_module, "RANGE_ROWS", 10)
    monkeypatch.setattr(running_totals_module, "BLOCK", 4)
    df = spark.range(1, 501).select("id", (F.col("id") % 3).alias("g"), F.lit(1).alias("one"))
    ranged = running_totals(df, [F.col("id")], ["id"])
    assert {r.id: (r.cum_id, r.total_id) for r in ranged.collect()} == {k: (k * (k + 1) // 2, 125_250) for k in range(1, 501)}
    grouped = running_totals(df, [F.col("id")], ["one"], group_by=["g"]).collect()
    assert all(r.cum_one == sum(k % 3 == r.g for k in range(1, r.id + 1)) for r in grouped)


def test_running_totals_of_nothing(spark):
    df = spark.createDataFrame([], "key bigint, n bigint")
    assert running_totals(df, [F.col("key")], ["n"]).count() == 0


def predictions(spark, rows):
    return spark.createDataFrame([(float(l), float(p), float(p > 0.5)) for l, p in rows], "label double, p1 double, prediction double")


def brute_auc(rows):
    pos, neg = [p for l, p in rows if l == 1], [p for l, p in rows if l == 0]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def brute_ks(rows):
    pos, neg = sum(l for l, _ in rows), sum(1 - l for l, _ in rows)
    cuts = {p for _, p in rows}
    return max(abs(sum(l for l, p in rows if p >= c) / pos - sum(1 - l for l, p in rows if p >= c) / neg) for c in cuts)


@pytest.mark.parametrize("levels", [1, 7, 1000])
def test_auc_and_ks_with_equal_scores(spark, levels):
    rng = random.Random(levels)
    rows = [(int(rng.random() < 0.4), rng.randrange(levels) / levels) for _ in range(300)]
    df = predictions(spark, rows)
    assert E.auc(df).first().auc == pytest.approx(brute_auc(rows), abs=1e-12)
    assert E.ks_statistic(df).first().ks == pytest.approx(brute_ks(rows), abs=1e-12)


def test_auc_of_perfect_inverted_and_constant_scores(spark):
    perfect = [(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)]
    assert E.auc(predictions(spark, perfect)).first().auc == 1.0
    assert E.auc(predictions(spark, [(1 - l, p) for l, p in perfect])).first().auc == 0.0
    assert E.auc(predictions(spark, [(l, 0.5) for l, _ in perfect])).first().auc == 0.5


def test_metrics_with_one_class_only(spark):
    df = predictions(spark, [(1, 0.2), (1, 0.7)])
    assert E.auc(df).first().auc is None and E.ks_statistic(df).first().ks is None


def test_roc_curve_runs_from_corner_to_corner(spark):
    points = sorted((r.fpr, r.tpr) for r in E.roc_curve(predictions(spark, [(1, 0.9), (0, 0.4), (1, 0.4)])).collect())
    assert points == [(0.0, 0.0), (0.0, 0.5), (1.0, 1.0)]


def test_classification_report(spark):
    rows = [(1, 0.9)] * 3 + [(1, 0.1)] + [(0, 0.9)] * 2 + [(0, 0.1)] * 4
    report = {r["class"]: r for r in E.classification_report(predictions(spark, rows)).collect()}
    assert report["1.0"].precision == pytest.approx(3 / 5) and report["1.0"].recall == pytest.approx(3 / 4)
    assert report["0.0"].f1_score == pytest.approx(2 * (4 / 5) * (4 / 6) / (4 / 5 + 4 / 6))
    assert report["accuracy"].f1_score == pytest.approx(0.7) and report["weighted avg"].support == 10
    counts = E.confusion_counts(predictions(spark, rows)).first()
    assert tuple(counts) == (3, 4, 2, 1)


def test_class_that_is_never_predicted_scores_zero(spark):
    report = {r["class"]: r for r in E.classification_report(predictions(spark, [(1, 0.1), (0, 0.1)])).collect()}
    assert report["1.0"].precision == 0.0 and report["1.0"].f1_score == 0.0


def test_quantiles_match_numpy(spark):
    rng = random.Random(3)
    skewed = [rng.choice([5.0, 5.0, rng.expovariate(0.001)]) for _ in range(501)]
    few = [float(rng.randrange(3)) for _ in range(501)]
    df = spark.createDataFrame(list(zip(skewed, few)), "skewed double, few double")
    got = {(r.variable, r.probability): r.quantile for r in P.exact_quantiles(df, ["skewed", "few"], [0.0, 0.1, 0.5, 0.999, 1.0]).collect()}
    assert len(got) == 10
    for (name, p), value in got.items():
        assert value == pytest.approx(np.quantile(skewed if name == "skewed" else few, p), rel=1e-12)


def test_describe_matches_pandas_and_skips_missing_values(spark):
    values = [1.0, None, 4.0, 10.0, 10.0]
    df = spark.createDataFrame([(v, 7) for v in values], "a double, b int")
    got = {r.variable: r for r in P.describe_selected(df, ["a", "b"]).collect()}
    expected = pd.Series(values, dtype="float").describe()
    for ours, theirs in zip(("count", "mean", "std", "min", "p25", "p50", "p75", "max"), expected):
        assert got["a"][ours] == pytest.approx(theirs)
    assert got["b"]["std"] == 0.0 and got["b"]["p50"] == 7.0
    empty = P.describe_selected(df.limit(0), ["a"]).first()
    assert (empty["count"], empty["mean"], empty["p50"]) == (0, None, None)


def test_missing_counts_treats_nan_as_missing_in_numbers_only(spark):
    df = spark.createDataFrame([("NaN", float("nan"), True), (None, None, None)], "t string, x double, b boolean")
    assert {r.column_name: r.missing_count for r in P.missing_counts(df).collect()} == {"t": 1, "x": 2, "b": 1}


def test_distribution_order_and_percent_text(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), (None,), ("c",), ("c",)], "t string")
    rows = [(r.value, r["count"], r.percentage) for r in P.category_distribution(df).collect()]
    assert rows == [("a", 2, "33.3%"), ("c", 2, "33.3%"), (None, 1, "16.7%"), ("b", 1, "16.7%")]


def test_crosstab_without_target_has_no_share(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("a", 1), ("b", None)], "t string, credit_risk int")
    rows = {r.value: tuple(r)[2:] for r in P.target_crosstab(df).collect()}
    assert rows == {"a": (1, 2, "33.3%", "66.7%"), "b": (0, 0, None, None)}


def test_duplicate_audit(spark):
    df = spark.createDataFrame([(1, "a")] * 50 + [(2, None)] * 2 + [(3, "b")], "n int, t string")
    assert tuple(P.duplicate_audit(df).first()) == (53, 3)
    assert tuple(P.duplicate_audit(df.limit(0)).first()) == (0, 0)


def test_duplicate_audit_tells_null_and_empty_apart(spark):
    rows = [(None, ""), ("", None), ("", ""), (None, None), ("a", None), (None, "a"), ("a", ""), ("ab", "c"), ("a", "bc")]
    df = spark.createDataFrame(rows * 2, "a string, `b.c` string")
    assert tuple(P.duplicate_audit(df).first()) == (18, 9)


def test_profile_is_the_three_profiles_from_one_reading(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = [(i, ("a", "b", None)[i % 3], "", float("nan") if i % 5 == 0 else 1.0, (0, 1, None)[i % 7 % 3]) for i in range(90)]
    df = spark.createDataFrame(rows, "id bigint, t string, uv string, x double, credit_risk int")
    found = P.profile(df.mapInArrow(counted, df.schema))
    wanted = (P.missing_counts(df), P.category_distribution(df), P.target_crosstab(df))
    for name, other in zip(("missing_counts", "category_distribution", "target_crosstab"), wanted):
        got = [tuple(r) for r in found[name].collect()]
        assert sorted(got, key=str) == sorted(map(tuple, other.collect()), key=str)
    assert reads.value == 90


def test_describing_reads_the_source_once(spark, tmp_path):
    spark.range(1000).selectExpr("id % 7 AS a", "double(id) AS b").write.parquet(str(tmp_path / "t"))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = spark.read.parquet(str(tmp_path / "t"))
    found = P.describe_selected(df.mapInArrow(counted, df.schema), ["a", "b"]).collect()
    assert reads.value == 1000
    assert [(r.variable, r["count"], r["min"], r.p25, r.p50, r.p75, r["max"]) for r in found] == [
        ("a", 1000, 0, 1, 3, 5, 6),
        ("b", 1000, 0, 249.75, 499.5, 749.25, 999),
    ]


@pytest.mark.parametrize("most_files", [0, 100])
def test_ids_are_dense_fixed_and_keep_copies_apart(spark, monkeypatch, most_files):
    monkeypatch.setattr("loanweave.operators.identity.MOST_FILES", most_files)
    rows = [("hot", 1)] * 200 + [(f"r{i}", i) for i in range(100)] + [(None, None)] * 3
    numbered = loan_id(spark.createDataFrame(rows, "t string, n int").repartition(16))
    first, second = numbered.collect(), numbered.orderBy("t").collect()
    assert sorted(r.id for r in first) == list(range(1, 304))
    assert sorted(map(tuple, first), key=str) == sorted(map(tuple, second), key=str)
    assert sum(r.t == "hot" for r in first) == 200


def test_ids_move_no_rows(spark):
    numbered = loan_id(spark.createDataFrame([("a", 1)], "t string, n int"))
    assert "Exchange hashpartitioning" not in numbered._jdf.queryExecution().executedPlan().toString()


def test_quantiles_of_odd_numbers(spark):
    values = [1e308, -1e308, float("nan"), None, 5e-324, 0.0, 1.0, 1.0, float("inf"), 2.0]
    df = spark.createDataFrame([(v, 7.0, None) for v in values], "a double, b double, c double")
    found = {(r.variable, r.probability): r["quantile"] for r in P.exact_quantiles(df, ["a", "b", "c"], [0.0, 0.5, 1.0]).collect()}
    assert found == {("a", 0.0): -1e308, ("a", 0.5): 1.0, ("a", 1.0): float("inf"), ("b", 0.0): 7.0, ("b", 0.5): 7.0, ("b", 1.0): 7.0}
    assert P.exact_quantiles(df.limit(0), ["a"], [0.5]).count() == 0


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(4000)
    one = {r.id for r in with_split(df.repartition(1)).filter("split = 'train'").collect()}
    many = {r.id for r in with_split(df.repartition(16)).filter("split = 'train'").collect()}
    assert one == many and 0.66 < len(one) / 4000 < 0.74
    train, test = train_test_split(df)
    assert train.count() + test.count() == 4000 and train.intersect(test).count() == 0
    assert {r.id for r in train_test_split(df, seed=7)[0].collect()} != one
