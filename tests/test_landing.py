import datetime as dt
import gzip
import json
import os

import pytest

from strata.sources import Landing, SchemaStore, bronze_frame, ingest, landing_stream, merge_schemas
from pyspark.sql import types as T


class Site:
    def __init__(self, spark, root, **kind):
        self.spark, self.root = spark, root
        self.landing = Landing(path=f"{root}/in", **kind)
        os.makedirs(f"{root}/in", exist_ok=True)
        self.store = SchemaStore(spark, f"{root}/schemas")

    def drop(self, name, text):
        path = self.root / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)

    def run(self):
        ingest(self.spark, self.landing, f"{self.root}/bronze", f"{self.root}/cp", self.store)
        return bronze_frame(self.spark, f"{self.root}/bronze", self.store)


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_csv_strings_files_read_once(spark, tmp_path):
    site = Site(spark, tmp_path, format="csv", max_files=1)
    site.drop("a 1.csv", "id,name\n01,x\n")
    site.drop("b.csv", "id,name\n02,\"y, z\"\n")
    assert values(site.run(), "id", "name") == [("01", "x"), ("02", "y, z")]
    site.drop("c.csv", "id,name\n03,w\n")
    out = site.run()
    assert values(out, "id") == [("01",), ("02",), ("03",)]
    assert out.where("file_name LIKE '%c.csv' AND ingestion_ts IS NOT NULL AND ingest_batch = 2").count() == 1


def test_csv_headers_of_compressed_blank_led_and_marked_files(spark, tmp_path):
    site = Site(spark, tmp_path, format="csv")
    site.drop("a.csv", "\n  \nid,name\n1,x\n")
    site.drop("b.csv", "\ufeffid,name\r\n2,y\r\n")
    site.drop("blank.csv", "\n \n")
    (tmp_path / "in" / "c.csv.gz").write_bytes(gzip.compress(b"name,id\nz,3\n"))
    assert values(site.run(), "id", "name") == [("1", "x"), ("2", "y"), ("3", "z")]


def test_csv_new_column_in_the_middle_and_missing_column(spark, tmp_path):
    site = Site(spark, tmp_path, format="csv")
    site.drop("a.csv", "id,name\n1,x\n")
    site.run()
    site.drop("b.csv", "id,extra,name\n2,zz,y\n")
    site.drop("c.csv", "name\nonly\n")
    site.drop("empty.csv", "")
    assert values(site.run(), "id", "name", "extra") == sorted(
        [("1", "x", None), ("2", "y", "zz"), (None, "only", None)], key=repr
    )
    assert site.store.load().names == ["id", "name", "extra"]


def test_csv_typed_inference_and_rescue(spark, tmp_path):
    site = Site(spark, tmp_path, format="csv", infer_types=True)
    site.drop("a.csv", "id,pay,day\n1,2.5,2020-01-31\n")
    site.run()
    site.drop("b.csv", "id,pay,day\nabc,3,2020-02-31\n")
    site.drop("c.csv", "id,pay,day\n4,1,2020-02-01,surplus\n")
    out = site.run()
    assert [f.dataType.simpleString() for f in site.store.load().fields] == ["int", "double", "date"]
    assert values(out, "id", "pay", "day", "_rescued_data") == sorted(
        [
            (1, 2.5, dt.date(2020, 1, 31), None),
            (None, 3.0, None, '{"id":"abc","day":"2020-02-31"}'),
            (4, 1.0, dt.date(2020, 2, 1), '{"_corrupt_record":"4,1,2020-02-01,surplus"}'),
        ],
        key=repr,
    )


def test_partition_folders_become_columns(spark, tmp_path):
    site = Site(spark, tmp_path, format="csv", infer_types=True)
    site.drop("year=2024/month=5/a.csv", "id\n1\n")
    site.drop("year=2025/month=1/a.csv", "id\n2\n")
    assert values(site.run(), "id", "year", "month") == [(1, 2024, 5), (2, 2025, 1)]


def test_json_documents_nested_evolution_and_rescue(spark, tmp_path):
    site = Site(spark, tmp_path, format="json", infer_types=True)
    site.drop("a.json", json.dumps([{"id": 1, "ad": {"city": "A"}, "items": [{"q": 1}]}], indent=1))
    site.run()
    site.drop(
        "b.json",
        json.dumps(
            [
                {"id": "x7", "ad": {"city": "B", "zip": "9"}, "items": [{"q": 2, "p": 1.5}], "new": True},
                {"id": 8, "ad": None, "items": []},
            ],
            indent=1,
        ),
    )
    site.drop("c.json", '{"id": 3, ')
    out = site.run()
    assert values(out, "id", "ad.city", "ad.zip", "new", "items.q", "items.p") == sorted(
        [
            (1, "A", None, None, [1], [None]),
            (None, "B", "9", True, [2], [1.5]),
            (8, None, None, None, [], []),
            (None, None, None, None, None, None),
        ],
        key=repr,
    )
    rescued = sorted(r[0] for r in values(out.where("_rescued_data IS NOT NULL"), "_rescued_data"))
    assert json.loads(rescued[0]) == {"_corrupt_record": '{"id": 3, '}
    assert json.loads(rescued[1]) == {"id": "x7"}


def test_json_nested_type_conflict_keeps_the_text(spark, tmp_path):
    site = Site(spark, tmp_path, format="json", infer_types=True)
    site.drop("a.json", '[{"id": 1, "ad": {"n": 1}}]')
    site.run()
    site.drop("b.json", '[{"id": 2, "ad": {"n": "two"}}, {"id": 3, "ad": null}]')
    out = site.run()
    assert values(out, "id", "ad.n") == [(1, 1), (2, None), (3, None)]
    assert json.loads(out.where("id = 2").first()._rescued_data) == {"ad": '{"n": "two"}'}
    assert out.where("id = 3").first()._rescued_data is None


def test_files_before_since_are_passed_over(spark, tmp_path):
    site = Site(spark, tmp_path, format="csv", since=dt.datetime(2020, 1, 1))
    site.drop("old.csv", "id\n1\n")
    os.utime(tmp_path / "in" / "old.csv", (1e9, 1e9))
    site.drop("new.csv", "id\n2\n")
    assert values(site.run(), "id") == [("2",)]


def test_rerun_of_a_batch_does_not_duplicate(spark, tmp_path):
    site = Site(spark, tmp_path, format="csv")
    site.drop("a.csv", "id\n1\n")
    site.run()
    commit = tmp_path / "cp" / "commits" / "0"
    commit.unlink()
    crc = tmp_path / "cp" / "commits" / ".0.crc"
    if crc.exists():
        crc.unlink()
    assert values(site.run(), "id") == [("1",)]


def test_plain_stream_refuses_another_header(spark, tmp_path):
    site = Site(spark, tmp_path, format="csv", infer_types=True)
    site.drop("a.csv", "id,name\n1,x\n")

    def run():
        stream = landing_stream(spark, site.landing, site.store)
        query = stream.writeStream.option("checkpointLocation", f"{tmp_path}/cp2").trigger(availableNow=True)
        query.format("parquet").start(f"{tmp_path}/out").awaitTermination()

    run()
    assert values(spark.read.parquet(f"{tmp_path}/out"), "id", "name") == [(1, "x")]
    site.drop("b.csv", "id,extra,name\n2,zz,y\n")
    with pytest.raises(Exception):
        run()


def test_merge_keeps_types_and_appends(spark):
    a = T.StructType().add("x", "integer").add("s", T.StructType().add("p", "integer"))
    b = T.StructType().add("n", "string").add("s", T.StructType().add("q", "integer").add("p", "string"))
    assert merge_schemas(a, b).simpleString() == "struct<x:int,s:struct<p:int,q:int>,n:string>"


AWKWARD = ("a[1]", "{x,y}", "b*", "q?", "w\\v")


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_names_that_look_like_patterns_and_their_siblings(spark, tmp_path, kind):
    site = Site(spark, tmp_path, format=kind)
    names = [*AWKWARD, "a1", "x", "bb", "qq"]
    for i, name in enumerate(names):
        site.drop(f"{name}.{kind}", f"id\n{i}\n" if kind == "csv" else json.dumps({"id": i}))
    assert values(site.run(), "id") == sorted((str(i),) for i in range(len(names)))


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_files_older_than_those_already_read(spark, tmp_path, kind):
    site = Site(spark, tmp_path, format=kind)
    text = {"csv": "id\n{}\n", "json": '{{"id": {}}}'}[kind]
    site.drop(f"new.{kind}", text.format(1))
    site.run()
    site.drop(f"old.{kind}", text.format(2))
    ten_days = os.stat(tmp_path / "in" / f"new.{kind}").st_mtime - 10 * 86400
    os.utime(tmp_path / "in" / f"old.{kind}", (ten_days, ten_days))
    assert values(site.run(), "id") == [("1",), ("2",)]


def test_header_in_another_case_and_twice_in_one_header(spark, tmp_path):
    site = Site(spark, tmp_path, format="csv")
    site.drop("a.csv", "id,name\n1,x\n")
    site.run()
    site.drop("b.csv", "ID,Name\n2,y\n")
    assert values(site.run(), "id", "name") == [("1", "x"), ("2", "y")]
    site.drop("c.csv", "z,Z,id\np,q,3\n")
    out = site.run()
    assert values(out.where("id = '3'"), "z0", "Z1") == [("p", "q")]


def test_json_keys_in_another_case(spark, tmp_path):
    site = Site(spark, tmp_path, format="json", infer_types=True)
    site.drop("a.json", '{"id": 1, "pay": 1}')
    site.run()
    site.drop("b.json", '{"ID": 2, "Pay": 2}')
    assert values(site.run(), "id", "pay") == [(1, 1), (2, 2)]


def test_layouts_of_one_batch_widen_each_other(spark, tmp_path):
    site = Site(spark, tmp_path, format="csv", infer_types=True)
    site.drop("a.csv", "id,pay,day\n1,10,2020-01-01\n")
    site.drop("b.csv", "id,pay,day,x\n2,10.5,2020-01-01 10:00:00,t\n")
    assert values(site.run(), "id", "pay", "_rescued_data") == [(1, 10.0, None), (2, 10.5, None)]


def test_hints_hold_whatever_comes_first(spark, tmp_path):
    site = Site(spark, tmp_path, format="json", infer_types=True, hints={"pay": "double", "items": "array<struct<q:bigint>>"})
    site.drop("a.json", '{"id": 1, "pay": 10, "items": []}')
    out = site.run()
    assert dict(out.dtypes)["items"] == "array<struct<q:bigint>>"
    site.drop("b.json", '{"id": 2, "pay": 10.5, "items": [{"q": 7}]}')
    assert values(site.run(), "id", "pay", "items.q") == [(1, 10.0, []), (2, 10.5, [7])]


def test_empty_arrays_have_no_type_yet(spark, tmp_path):
    site = Site(spark, tmp_path, format="json", infer_types=True)
    site.drop("a.json", '{"id": 1, "items": []}')
    site.run()
    site.drop("b.json", '{"id": 2, "items": [{"q": 7}]}')
    assert values(site.run(), "id", "items.q") == sorted([(1, None), (2, [7])], key=repr)


def test_a_batch_that_fails_leaves_the_schema_alone(spark, tmp_path):
    site = Site(spark, tmp_path, format="csv", infer_types=True)
    site.drop("a.csv", "id\n1\n")
    site.run()
    before = site.store.load()
    site.drop("bad.csv", "id,ingestion_ts,_rescued_data\n1,x,y\n")
    with pytest.raises(Exception):
        site.run()
    assert site.store.load() == before
    (tmp_path / "in" / "bad.csv").unlink()
