import pytest
from pyspark.sql import functions as F

from strata.functions import cast_columns, explode_items, flatten_struct, misfits, stamp, surrogate_key
from strata.operators import (
    expect_all_or_drop,
    get_rules,
    quarantine,
    rule_metrics,
    rules_by_tag,
    rules_frame,
)

RULES = {"valid_id": "id IS NOT NULL", "valid_email": "email LIKE '%@%.%'"}
ROWS = [(1, "a@b.c"), (None, "a@b.c"), (2, None), (3, "nope"), (None, None)]


def people(spark):
    return spark.createDataFrame(ROWS, "id int, email string")


def test_null_counts_as_broken(spark):
    assert [tuple(r) for r in expect_all_or_drop(people(spark), RULES).collect()] == [(1, "a@b.c")]
    assert expect_all_or_drop(people(spark), {}).count() == 5
    aside = quarantine(people(spark), RULES).collect()
    assert sorted((r.quarantine_reason for r in aside)) == [
        "valid_email",
        "valid_email",
        "valid_id",
        "valid_id,valid_email",
    ]
    assert quarantine(people(spark), {}).count() == 0


def test_metrics(spark):
    got = {r.rule_name: (r.passed, r.failed) for r in rule_metrics(people(spark), RULES).collect()}
    assert got == {"valid_id": (3, 2), "valid_email": (2, 3)}


def test_catalogue(spark):
    rules = rules_frame(
        spark,
        [
            ("p", "d", "r", "a > 0", ["x"]),
            ("p", "d", "r", "a > 1", ["x", "y"]),
            ("p", "e", "s", "b > 0", ["y"]),
        ],
    )
    assert get_rules(rules, "p", "d") == {"r": "a > 1"}
    assert get_rules(rules, "p", "none") == {}
    assert rules_by_tag(rules, "y").count() == 2


def test_casts_and_misfits(spark):
    df = spark.createDataFrame([("1", "2020-01-31"), ("x", "2020-02-31"), (None, None)], "n string, d string")
    types = {"n": "int", "d": "date", "absent": "int"}
    out = cast_columns(df.withColumn("lost", misfits(df, types)), types).collect()
    assert [r.lost for r in out] == [None, '{"n":"x","d":"2020-02-31"}', None]
    assert (out[0].n, str(out[0].d), out[1].n, out[1].d) == (1, "2020-01-31", None, None)


def test_strict_cast_fails(spark):
    import pytest

    df = spark.createDataFrame([("x",)], "n string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_columns(df, {"n": "int"}, strict=True).collect()


def test_shapes(spark):
    df = spark.createDataFrame(
        [(1, {"b": 2, "c": 3}, [{"x": 1, "y": 2}, {"x": 3, "y": 4}]), (2, None, []), (3, None, None)],
        "a int, s struct<b:int,c:int>, items array<struct<x:int,y:int>>",
    )
    assert flatten_struct(df, "s").columns == ["a", "b", "c", "items"]
    assert [tuple(r) for r in explode_items(df, "items", ["a"]).collect()] == [(1, 1, 2), (1, 3, 4)]
    assert explode_items(df, "items", ["a"], ["y"]).columns == ["a", "y"]
    assert stamp(df, "now").where("now IS NULL").count() == 0


def test_surrogate_key_skips_null(spark):
    df = spark.createDataFrame([("a", None, 1)], "x string, y string, z int")
    import hashlib

    assert df.select(surrogate_key("x", "y", F.col("z"))).first()[0] == hashlib.sha256(b"a||1").hexdigest()


def test_rules_reach_the_scan(spark, tmp_path):
    people(spark).write.parquet(str(tmp_path / "p"))
    kept = expect_all_or_drop(spark.read.parquet(str(tmp_path / "p")), {"a": "id IS NOT NULL", "b": "id > 1"})
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,1)]" in plan


def test_same_rule_twice_needs_an_order(spark):
    rules = rules_frame(spark, [("p", "d", "r", "a > 0", ["x"]), ("p", "d", "r", "a > 1", ["x"])])
    assert get_rules(rules.orderBy(F.desc("ordinal")), "p", "d") == {"r": "a > 1"}
    with pytest.raises(ValueError):
        get_rules(rules.drop("ordinal"), "p", "d")
    assert get_rules(rules.drop("ordinal").limit(1).union(rules.drop("ordinal").limit(1)), "p", "d") == {"r": "a > 0"}
