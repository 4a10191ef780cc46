import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import observe_rules, observed_metrics, rule_metrics
from strata.plans import MaintainedSummary, sales_summary
from strata.session import settings
from strata.streaming import Bounds, append_flow, given_up, join_header_stream, run_join

BOUNDS = Bounds("at", "1 day", "2 days")
LINES, HEADS = "t int, line int, at timestamp", "t int, name string, at timestamp"


def day(n, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=hour)


class Feed:
    """Two folders that streams read one file per batch from."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def add(self, lines, heads):
        for name, rows, schema in (("lines", lines, LINES), ("heads", heads, HEADS)):
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def stream(self, name, schema):
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{self.root}/{name}")

    def run(self):
        joined = join_header_stream(self.stream("lines", LINES), self.stream("heads", HEADS), ["t"], ["name"], BOUNDS)
        return run_join(joined, f"{self.root}/out", f"{self.root}/checkpoint")

    def rows(self):
        return sorted(tuple(r) for r in self.spark.read.parquet(f"{self.root}/out").select("t", "line", "name").collect())


def test_state_of_the_stream_join_stops_growing(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for n in range(12):
        ids = range(20 * n, 20 * n + 20)
        feed.add([(t, k, day(n)) for t in ids for k in (1, 2)], [(t, f"h{t}", day(n, 3)) for t in ids])
    run = feed.run()
    assert feed.rows() == [(t, k, f"h{t}") for t in range(240) for k in (1, 2)]
    assert run.dropped == 0
    # Sixty rows come a day; those of five days are the most that can wait.
    assert max(run.state_rows) <= 5 * 60 and run.state_rows[-1] <= run.state_rows[5]


def test_state_of_an_append_flow_lies_on_disk_and_settings_stay(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark.sql("DROP TABLE IF EXISTS joined_on_disk")
    feed = Feed(spark, tmp_path)
    feed.add([(1, 1, day(0)), (2, 1, day(0))], [(2, "b", day(0))])
    feed.add([(3, 1, day(0))], [(1, "a", day(9))])
    joined = feed.stream("lines", LINES).select("t", "line").join(feed.stream("heads", HEADS).select("t", "name"), "t")
    out = append_flow(joined, "joined_on_disk", f"{tmp_path}/checkpoint", f"{tmp_path}/joined")
    assert sorted(map(tuple, out.collect())) == [(1, 1, "a"), (2, 1, "b")]
    stored = [f.suffix for f in (tmp_path / "checkpoint" / "state").rglob("[0-9]*.*") if not f.name.startswith(".")]
    assert ".zip" in stored and ".delta" not in stored
    assert spark.conf.get(provider, None) is None
    spark.conf.set(provider, "chosen")
    try:
        with settings(spark, {provider: "other"}):
            assert spark.conf.get(provider) == "chosen"
        assert spark.conf.get(provider) == "chosen"
    finally:
        spark.conf.unset(provider)


def test_late_rows_and_rows_without_header_are_set_aside(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([(1, 1, day(0)), (2, 1, day(0))], [(1, "a", day(0))])
    feed.add([(3, 1, day(9))], [(3, "c", day(9))])
    feed.add([(8, 1, day(9))], [(8, "h", day(9))])  # a watermark judges rows from the second batch after it
    feed.add([(4, 1, day(0)), (5, 1, day(9))], [(4, "d", day(0)), (2, "b", day(0)), (6, "f", day(9))])
    feed.add([(7, 1, day(10))], [(7, "g", day(10))])
    run = feed.run()
    assert feed.rows() == [(1, 1, "a"), (3, 1, "c"), (7, 1, "g"), (8, 1, "h")]
    assert run.dropped == 3  # line 4 and headers 4 and 2
    lines, out = spark.read.parquet(f"{tmp_path}/lines"), spark.read.parquet(f"{tmp_path}/out")
    aside = given_up(lines, out, ["t", "line"], BOUNDS, run.watermark)
    assert sorted((r.t, r.quarantine_reason) for r in aside.collect()) == [(2, "no header in time"), (4, "no header in time")]


def test_headers_too_far_from_their_details_do_not_match(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([(1, 1, day(0)), (2, 1, day(0))], [(1, "near", day(1)), (2, "far", day(1, 1))])
    feed.run()
    assert feed.rows() == [(1, 1, "near")]


FACTS = "g string, line_total double, quantity bigint"


@pytest.fixture
def summary(spark, tmp_path):
    return MaintainedSummary(spark, f"{tmp_path}/summary", keys=["g"], buckets=3)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_summary_follows_corrections_and_deletes(spark, summary):
    frame = lambda *rows: spark.createDataFrame(list(rows), FACTS)
    none = frame().limit(0)
    with pytest.raises(ValueError):
        summary.read()
    summary.update(none, none, ("f", 0))
    first = [("a", 0.1, 1), ("a", 0.2, 2), ("b", 5.0, 1), (None, 1.0, 1), ("c", None, 3)]
    summary.update(none, frame(*first), ("f", 1))
    assert as_rows(summary.read()) == as_rows(sales_summary(frame(("a", 0.3, 3), *first[2:]), ["g"]).withColumn("line_item_count", F.expr("if(g = 'a', 2L, line_item_count)")).withColumn("total_amount", F.coalesce("total_amount", F.lit(None))))
    summary.update(frame(("a", 0.1, 1), ("b", 5.0, 1)), frame(("a", 7.5, 1), ("d", 1.0, 1)), ("f", 2))
    want = [("a", 7.7, 3, 2), ("c", None, 3, 1), ("d", 1.0, 1, 1), (None, 1.0, 1, 1)]
    assert as_rows(summary.read()) == sorted(want, key=repr)
    # The same batch again, and one of another flow.
    summary.update(frame(("a", 0.1, 1), ("b", 5.0, 1)), frame(("a", 7.5, 1), ("d", 1.0, 1)), ("f", 2))
    assert as_rows(summary.read()) == sorted(want, key=repr)
    summary.update(frame(("d", 1.0, 1)), none, ("other", 0))
    summary.update(frame(("a", 0.1, 1)), none, ("f", 1))
    assert as_rows(summary.read()) == sorted([w for w in want if w[0] != "d"], key=repr)
    spark.sql("CREATE SCHEMA IF NOT EXISTS kept")
    summary.declare("kept.per_group", "sums", {"quality": "gold"})
    assert as_rows(spark.newSession().table("kept.per_group")) == as_rows(summary.read())


def test_rules_are_counted_while_rows_are_written(spark, tmp_path):
    rules = {"some": "g IS NOT NULL", "large": "quantity > 1"}
    rows = spark.createDataFrame([("a", 1.0, 1), (None, 1.0, 2), ("b", 1.0, None)], FACTS)
    kept, seen = observe_rules(rows, rules)
    kept.where("quantity = 1").write.parquet(f"{tmp_path}/kept")
    assert as_rows(observed_metrics(spark, seen, rules)) == as_rows(rule_metrics(rows, rules)) == [("large", 1, 2), ("some", 2, 1)]


def test_summary_in_rounds_and_one_shuffle_for_its_buckets(spark, tmp_path, rows, monkeypatch):
    facts = spark.sql("SELECT id % 40 AS t, sha2(CAST(id % 40 AS STRING), 256) AS k, IF(id % 3 = 0, NULL, 'x') AS p, CAST(id AS DOUBLE) AS line_total, 1 AS quantity FROM range(120)")
    monkeypatch.setattr("strata.plans.facts.GROUPS_AT_ONCE", 1)
    summary = MaintainedSummary(spark, str(tmp_path / "s"), ["t", "k", "p"], buckets=3)
    written = []
    replace = summary.table.replace
    monkeypatch.setattr(summary.table, "replace", lambda df: (written.append(df), replace(df)))
    summary.update(facts.limit(0), facts.where("t < 30"), ("f", 0))
    for _ in range(2):
        summary.update(facts.where("t < 10"), facts.where("t >= 30"), ("f", 1))
    want = sales_summary(facts.where("t >= 10"), ["t", "k", "p"])
    assert rows(summary.read()) == rows(want)
    assert len(written) == 6  # three buckets twice, and none when the batch came again
    for df in written:
        whole = df._jdf.queryExecution().optimizedPlan().toString()
        assert whole.count("RepartitionByExpression") == 1 and "RebalancePartitions" not in whole
