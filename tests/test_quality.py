from datetime import date

import pytest
from pyspark.sql import functions as F

from climora.operators import quality as q


@pytest.fixture
def models(spark):
    rows = [("a", 1, 5), ("a", 2, -1), ("b", None, None), (None, 2, 3), (None, 2, 3), ("c", 9, 0)]
    parents = [("a",), ("b",), (None,)]
    return {
        "t": spark.createDataFrame(rows, "k string, v int, w int"),
        "p": spark.createDataFrame(parents, "id string"),
    }


@pytest.mark.parametrize(
    "make, rows, failures",
    [
        (lambda: q.not_null("t", "k"), 2, 2),
        (lambda: q.not_null("t", "v"), 1, 1),
        (lambda: q.unique("t", "k"), 1, 1),
        (lambda: q.unique("t", "v"), 1, 1),
        (lambda: q.accepted_values("t", "v", (1, 2)), 1, 1),
        (lambda: q.accepted_values("t", "k", ("a", "b", "c")), 0, 0),
        (lambda: q.relationships("t", "k", "p", "id"), 1, 1),
        (lambda: q.relationships("t", "k", "t", "k"), 0, 0),
        (lambda: q.expression("t", "w", "w >= 0"), 1, 1),
        (lambda: q.unique_combination("t", "k", "v"), 1, 1),
        (lambda: q.unique_combination("t", "k", "w"), 1, 1),
    ],
)
def test_each_check(spark, models, make, rows, failures):
    check = make()
    assert q.failing_rows(check, models).count() == rows
    result = q.run_checks([check], models).first()
    assert (result.model, result.column, result.test) == (check.model, check.column, check.test)
    assert (result.failures, result.passed) == (failures, failures == 0)


def test_orphans_are_counted_by_row(spark, models):
    many = {**models, "t": models["t"].union(models["t"])}
    assert q.run_checks([q.relationships("t", "k", "p", "id")], many).first().failures == 2


def test_row_wise_checks_share_one_pass(spark, models):
    checks = [q.not_null("t", "k"), q.not_null("t", "v"), q.expression("t", "w", "w >= 0")]
    results = q.run_checks(checks, models)
    assert sorted(r.failures for r in results.collect()) == [1, 1, 2]
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def test_the_declared_checks(spark):
    kinds = [c.test for c in q.declared_checks()]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 29, "unique": 8, "accepted_values": 4, "relationships": 4,
        "expression_is_true": 3, "unique_combination_of_columns": 2,
    }


def test_results_are_kept_per_day(spark, models, tmp_path):
    results = q.run_checks([q.not_null("t", "k"), q.unique("t", "k")], models)
    for day in (date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 2)):
        q.store_results(results, str(tmp_path / "r"), day)
    kept = spark.read.parquet(str(tmp_path / "r"))
    assert sorted((str(r.run_date), r.test, r.failures) for r in kept.collect()) == [
        ("2024-01-01", "not_null", 2), ("2024-01-01", "unique", 1),
        ("2024-01-02", "not_null", 2), ("2024-01-02", "unique", 1),
    ]


def test_all_checks_of_a_model_share_one_pass(spark, models):
    checks = [
        q.not_null("t", "k"), q.unique("t", "k"), q.unique("t", "v"), q.accepted_values("t", "v", (1, 2)), q.accepted_values("t", "w", (5,)),
        q.relationships("t", "k", "p", "id"), q.relationships("t", "w", "t", "v"), q.expression("t", "w", "w >= 0"),
        q.unique_combination("t", "v", "k"), q.unique_combination("t", "w", "k"),
    ]
    results = q.run_checks(checks, models)
    got = {(r.column, r.test): r.failures for r in results.collect()}
    one_by_one = {(c.column, c.test): q.run_checks([c], models).first().failures for c in checks}
    by_rows = {(c.column, c.test): q.failing_rows(c, models) for c in checks}
    assert got == one_by_one and len(got) == len(checks)
    assert got == {
        k: (f.agg(F.coalesce(F.sum("n_records"), F.lit(0))).first()[0] if k[1] == "relationships" else f.count()) for k, f in by_rows.items()
    }
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 0 and plan.count("Expand") == 1


def test_each_model_is_scanned_once(spark, models, tmp_path):
    models["t"].write.parquet(str(tmp_path / "t"))
    stored = {**models, "t": spark.read.parquet(str(tmp_path / "t"))}
    checks = [q.not_null("t", "k"), q.unique("t", "k"), q.accepted_values("t", "v", (1, 2)), q.relationships("t", "k", "p", "id"), q.unique_combination("t", "v", "k")]
    plan = q.run_checks(checks, stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_empty_models_pass(spark, models):
    empty = {name: rows.limit(0) for name, rows in models.items()}
    checks = [q.not_null("t", "k"), q.unique("t", "k"), q.accepted_values("t", "v", (1, 2)), q.relationships("t", "k", "p", "id"), q.unique_combination("t", "v", "k")]
    assert [r.failures for r in q.run_checks(checks, empty).collect()] == [0] * 5
    orphans = q.run_checks([q.relationships("t", "k", "p", "id")], {**models, "p": empty["p"]}).first()
    assert orphans.failures == 4
