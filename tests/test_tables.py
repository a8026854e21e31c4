"""Reading and writing of raw files and layer tables."""

from __future__ import annotations

import os

import pytest

from loanweave.functions.fixed_values import CATEGORICAL, OPTIMISED_TABLE, RAW_NUMERIC
from loanweave.plans.layers import build_bronze, build_gold
from loanweave.plans.optimisation import build_optimised
from loanweave.plans.reports import history_risk_share, purpose_risk_pivot
from loanweave.session import scratch, scratch_path, shared_dir, stage
from loanweave.sources.loans_csv import CORRUPT, LOAN_SCHEMA, read_loans_csv, split_bad
from loanweave.sources.order_loans import loans_from_orders
from loanweave.sources.tables import publish_gold, read_table, steps_table, write_table, write_table_evolve

SMALL = "/root/testdata/sf0.001"


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    loans = loans_from_orders(spark, SMALL).select(*LOAN_SCHEMA.fieldNames())
    loans.select(*reversed(loans.columns)).coalesce(1).write.option("header", True).csv(str(tmp_path / "csv"))
    with pytest.raises(Exception, match="header"):
        read_loans_csv(spark, str(tmp_path / "csv")).collect()


@pytest.mark.parametrize("line", [",".join(["x"] * 4 + ["125k"] + ["x"] * 2 + ["1"] + ["x"] * 13), "a,1,b,c"])
def test_bad_lines_are_refused_or_kept_whole(spark, tmp_path, line):
    good = ",".join("7" if f.dataType.typeName() in ("long", "integer") else "x" for f in LOAN_SCHEMA)
    (tmp_path / "loans.csv").write_text("\n".join([",".join(LOAN_SCHEMA.fieldNames()), good, line, good]) + "\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_loans_csv(spark, str(tmp_path)).collect()
    loans, bad = split_bad(read_loans_csv(spark, str(tmp_path), keep_bad=True).persist())
    assert [tuple(r) for r in bad.collect()] == [(line,)] and bad.columns == [CORRUPT]
    assert loans.count() == 2 and loans.filter("amount IS NULL").count() == 0


def test_layers_end_to_end(spark, tmp_path):
    root, raw = str(tmp_path), str(tmp_path / "raw")
    loans = loans_from_orders(spark, SMALL)
    loans.select(*LOAN_SCHEMA.fieldNames()).write.option("header", True).csv(raw)
    reporting, training = build_gold(build_bronze(spark, raw, root), root)
    cats = [f"{c}_cat" for c in RAW_NUMERIC]
    assert reporting.columns == [*cats, "amount", *[c for c in LOAN_SCHEMA.fieldNames() if c in CATEGORICAL], "credit_risk"]
    assert not set(RAW_NUMERIC) & set(training.columns) and set(cats) < set(training.columns)
    optimised = build_optimised(reporting, root)
    assert optimised.count() == loans.count() == optimised.select("id").distinct().count()
    kinds = dict(optimised.dtypes)
    assert kinds["PD"] == kinds["expected_value"] == "double" and kinds["optim_choice"] == "int"
    by_name = spark.sql(f"SELECT sum(exposure_at_risk) FILTER (WHERE optim_choice = 1) / sum(exposure_at_risk) FROM {OPTIMISED_TABLE}")
    assert 0.29 < by_name.first()[0] <= 0.30 + 1e-9


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_overwrite_replaces_the_table(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    write_table(spark.range(10), path, fmt)
    write_table(spark.range(3), path, fmt)
    assert read_table(spark, path, fmt).count() == 3


def test_schemas_are_merged(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table_evolve(spark.range(2).selectExpr("id", "'x' AS old"), path)
    write_table_evolve(spark.range(3).selectExpr("id", "id * 2 AS new"), path)
    rows = read_table(spark, path).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(0, None, 0), (1, None, 2), (2, None, 4)] and rows[0].asDict().keys() == {"id", "old", "new"}
    write_table_evolve(read_table(spark, path).filter("id > 0"), path)
    assert read_table(spark, path).count() == 2
    with pytest.raises(ValueError, match="new is bigint"):
        write_table_evolve(spark.range(1).selectExpr("id", "'text' AS new"), path)
    assert read_table(spark, path).count() == 2


def test_gold_in_the_catalog_is_seen_by_other_sessions(spark, tmp_path):
    for rows in (4, 2):
        publish_gold(spark.range(rows), str(tmp_path / "gold"), "gold_numbers", catalog=True)
        assert spark.newSession().table("gold_numbers").count() == rows
    spark.sql("DROP TABLE gold_numbers")


def test_loans_without_a_target_have_their_own_share(spark):
    rows = [("a", "p", 0, 10), ("a", "p", 1, 20), ("a", "q", None, 30), ("b", "q", None, 5)]
    loans = spark.createDataFrame(rows, "credit_history string, purpose string, credit_risk int, amount bigint")
    shares = {(r.credit_history, r.credit_risk): r.share for r in history_risk_share(loans).collect()}
    assert shares[("a", None)] == pytest.approx(1 / 3) and shares[("b", None)] == 1.0
    pivot = {r.purpose: r for r in purpose_risk_pivot(loans).collect()}
    for row in pivot.values():
        assert row.share_0 + row.share_1 + row.share_none == pytest.approx(1.0)
    assert pivot["Total"].amount_none == 35 and pivot["q"].column_share_none == 1.0


def test_scratch_removes_what_was_staged(spark):
    with scratch(spark):
        staged = stage(spark.range(5), "gone")
        path = staged.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_steps(spark):
    assert [tuple(r) for r in steps_table(spark).collect()] == [
        ("Baseline", 1),
        ("Removed Credits", 2),
        ("Exposure Reduction", 3),
        ("Optimized", 4),
    ]


def test_scratch_lies_in_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(shared_dir(spark))
