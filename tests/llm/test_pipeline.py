"""The registered text queries and the pipeline on the small tables."""

import collections
import os

import duckdb
import pytest
from xxhash import xxh64_intdigest

import corpus_pipeline
from strata.llm import queries, toxicity
from tests.llm.test_text_operators import check_packing, normal, plain_components, plain_fingerprint

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = duck.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF_DIR).select(*columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_pipeline_stages_against_brute_force(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "best_fit_packing"]
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")

    clean = stages["toxicity"](spark, docs, SF_DIR).cache()
    rejected = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    assert {r.doc_id: r for r in clean.collect()} == {i: r for i, r in rows.items() if i not in rejected}

    exact = stages["exact_dedup"](spark, clean, SF_DIR).cache()
    groups = collections.defaultdict(list)
    for r in clean.collect():
        groups[normal(r.text)].append(r)
    kept = {min(g, key=lambda r: (-len(r.text), r.doc_id)).doc_id for g in groups.values()}
    assert {r.doc_id: r for r in exact.collect()} == {i: rows[i] for i in kept} and exact.columns == docs.columns

    near = stages["simhash_near_dedup"](spark, exact, SF_DIR).cache()
    prints = {i: plain_fingerprint(rows[i].text) for i in kept}
    root = plain_components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    first = {}
    for i, p in prints.items():
        first[root[p]] = min(i, first.get(root[p], i))
    assert {r.doc_id: r for r in near.collect()} == {i: rows[i] for i in first.values()} and near.columns == docs.columns

    packed = stages["best_fit_packing"](spark, near, SF_DIR).collect()
    assert {r.doc_id for r in packed} == set(first.values())
    lengths = collections.Counter()
    for r in packed:
        lengths[r.doc_id] += r.length
    assert all(r.start == 2048 * r.piece for r in packed) and check_packing(packed, 2048) >= -(-sum(lengths.values()) // 2048)
    assert sorted((r.doc_id, r.piece, r.length) for r in corpus_pipeline.run(spark, SF_DIR).collect()) == sorted((r.doc_id, r.piece, r.length) for r in packed)


def test_shingle_hash_is_the_library_of_the_contract():
    assert plain_fingerprint("One two three") == xxh64_intdigest(b"one two three", 42)
