"""Every registered query against its SQL text in DuckDB."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = {k: v for k, v in entry_point.oracle_sql().items() if k not in entry_point.LLM_QUERIES}
QUERIES = {k: v for k, v in entry_point.queries().items() if k not in entry_point.LLM_QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def compiled(spark):
    """These run as they would in production."""
    settings = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    frame = frame.astype(object).where(frame.notna(), None)
    return sorted(map(tuple, frame.itertuples(index=False)), key=lambda r: tuple(str(v) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, duck):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert {c: got[c].dtype.kind for c in got.columns} == {c: want[c].dtype.kind for c in got.columns}
    assert len(want) > 0
    assert canonical(got) == canonical(want)


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).limit(5).count() == 5
