import pathlib
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import scd1, scd2
from strata.streaming import ChangeSpec, KeyedTarget, cdc_flow
from tests.test_scd import SCHEMA, as_tuples, events, history

DELETE = "op = 'DELETE'"


def spec(**more):
    return ChangeSpec(keys=("k",), sequence_by="seq", tie_break=("src",), buckets=4, **more)


@pytest.mark.parametrize(("scd_type", "batches"), [(1, 3), (2, 1), (2, 3), (2, 7)])
def test_batches_and_replays_do_not_show(spark, tmp_path, scd_type, batches):
    data = events(140, seed=batches)
    target = KeyedTarget(spark, str(tmp_path), spec(scd_type=scd_type, apply_as_deletes=DELETE, rows_per_slice=15))
    parts = [data[i::batches] for i in range(batches)]
    for part in [*parts, parts[0]]:
        target.upsert(spark.createDataFrame(part, SCHEMA))
    whole = spark.createDataFrame(data, SCHEMA)
    batch = scd1 if scd_type == 1 else scd2
    assert as_tuples(target.read()) == as_tuples(batch(whole, ["k"], "seq", ["src"], DELETE))
    if scd_type == 2:
        assert as_tuples(target.read()) == history(data)


def test_tracked_columns_survive_late_events(spark, tmp_path):
    data = events(90, seed=11)
    target = KeyedTarget(spark, str(tmp_path), spec(scd_type=2, track_columns=("a",)))
    for part in (data[60:], data[:30], data[30:60]):
        target.upsert(spark.createDataFrame(part, SCHEMA))
    assert as_tuples(target.read()) == history(data, track=True, deletes=False)


def test_delete_then_late_update_then_insert(spark, tmp_path):
    target = KeyedTarget(spark, str(tmp_path), spec(apply_as_deletes=DELETE, except_columns=("op",)))
    put = lambda *rows: target.upsert(spark.createDataFrame(list(rows), SCHEMA))
    put(("a", 5, "DELETE", 0, "f"), ("b", 1, "PUT", 1, "f"))
    put(("a", 3, "PUT", 1, "g"))
    assert as_tuples(target.read()) == [("b", 1, 1, "f")]
    put(("a", 6, "PUT", 2, "h"))
    assert as_tuples(target.read()) == [("a", 6, 2, "h"), ("b", 1, 1, "f")]


def test_writer_that_died_is_finished_by_the_next(spark, tmp_path):
    target = KeyedTarget(spark, str(tmp_path), spec())
    put = lambda *rows: target.upsert(spark.createDataFrame(list(rows), SCHEMA))
    put(*[(f"k{i}", 1, "PUT", 1, "f") for i in range(20)])
    before = as_tuples(target.read())
    # A copy without its end mark is ignored; one with it takes the place of its buckets, even if some of them are gone.
    spark.createDataFrame([("zz", 9, "PUT", 9, "f", 0)], f"{SCHEMA}, __bucket int").write.partitionBy("__bucket").parquet(f"{tmp_path}/copy")
    pathlib.Path(f"{tmp_path}/copy/_SUCCESS").unlink()
    target.table.finish()
    assert as_tuples(target.read()) == before
    whole = target.table.read().withColumn("__bucket", target.bucket())
    whole.write.mode("overwrite").partitionBy("__bucket").parquet(f"{tmp_path}/copy")
    gone = next(pathlib.Path(f"{tmp_path}/data").glob("__bucket=*"))
    for file in gone.iterdir():
        file.unlink()
    assert as_tuples(target.read()) != before
    put(("k0", 2, "PUT", 2, "f"))
    assert as_tuples(target.read()) == sorted([r for r in before if r[0] != "k0"] + [("k0", 2, "PUT", 2, "f")], key=repr)
    assert not pathlib.Path(f"{tmp_path}/copy").exists()


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    target = KeyedTarget(spark, str(tmp_path), spec(scd_type=2))
    files = lambda: {f: f.stat().st_mtime_ns for f in pathlib.Path(f"{tmp_path}/data").rglob("*.parquet")}
    target.upsert(spark.createDataFrame([(f"k{i}", 1, "PUT", 1, "f") for i in range(40)], SCHEMA))
    first = files()
    assert len({f.parent for f in first}) == 4
    target.upsert(spark.createDataFrame([("k0", 2, "PUT", 1, "f")], SCHEMA))
    kept = [f for f, t in files().items() if first.get(f) == t]
    assert len({f.parent for f in kept}) == 3
    assert target.read().count() == 41
    touched = {r[0] for r in spark.createDataFrame([("k0",)], "k string").select(target.bucket()).collect()}
    assert 0 < target.read(touched).count() < 41


def test_named_target_is_read_by_another_session(spark, tmp_path):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS named LOCATION '{tmp_path}/db'")
    for scd_type, want in ((1, [("b", 1, 1, "f")]), (2, [("a", 1, 1, "f", 1, 2), ("b", 1, 1, "f", 1, None)])):
        target = KeyedTarget(spark, f"{tmp_path}/t{scd_type}", spec(scd_type=scd_type, apply_as_deletes=DELETE, except_columns=("op",)))
        first = spark.createDataFrame([("a", 1, "PUT", 1, "f"), ("b", 1, "PUT", 1, "f")], SCHEMA)
        target.upsert(first)
        target.declare(f"named.t{scd_type}", "it's a table", {"quality": "silver"})
        target.upsert(spark.createDataFrame([("a", 2, "DELETE", 0, "f")], SCHEMA))
        target.upsert(first)  # a repeated batch changes nothing
        target.declare(f"named.t{scd_type}", "it's a table", {"quality": "silver"})
        other = spark.newSession()
        assert as_tuples(other.table(f"named.t{scd_type}")) == sorted(want, key=repr) == as_tuples(target.read())
        about = {r.col_name: r.data_type for r in other.sql(f"DESCRIBE TABLE EXTENDED named.t{scd_type}").collect()}
        assert about["Comment"] == "it's a table" and "quality=silver" in about["Table Properties"]


def test_new_columns_and_composite_bucket(spark, tmp_path):
    target = KeyedTarget(
        spark, str(tmp_path), ChangeSpec(keys=("k", "src"), sequence_by="seq", bucket_keys=("k",), buckets=3)
    )
    target.upsert(spark.createDataFrame([("a", 1, "PUT", 1, "x"), ("b", 1, "PUT", 1, "x")], SCHEMA))
    wide = spark.createDataFrame([("a", 2, "PUT", 5, "y")], SCHEMA).withColumn("more", F.lit("new"))
    target.upsert(wide)
    assert as_tuples(target.read().select("k", "src", "a", "more")) == sorted(
        [("a", "x", 1, None), ("a", "y", 5, "new"), ("b", "x", 1, None)], key=repr
    )


def test_flow_with_rules_and_quarantine(spark, tmp_path):
    data = [("a", 1, "PUT", 1, "f"), (None, 1, "PUT", 1, "f"), ("b", None, "PUT", 1, "f")]
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
    target = KeyedTarget(spark, f"{tmp_path}/t", spec())
    cdc_flow(stream, target, f"{tmp_path}/cp", rules={"valid_id": "k IS NOT NULL"}, quarantine_path=f"{tmp_path}/q")
    assert as_tuples(target.read().select("k")) == [("a",)]
    reasons = spark.read.parquet(f"{tmp_path}/q")
    assert sorted(r[0] for r in reasons.select("quarantine_reason").collect()) == ["sequence is NULL", "valid_id"]


def test_bad_type_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        KeyedTarget(spark, str(tmp_path), spec(scd_type=3))
