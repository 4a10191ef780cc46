import json

import pytest

from strata.sources import Landing
from tests.test_landing import Site, values
from tests.test_workload import compiled  # noqa: F401  Spark reads VARIANT fields from Parquet by compiled code only.


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path, format="json", infer_types=True, one_pass=True)


def kinds(site):
    return {f.name: f.dataType.simpleString() for f in site.store.load().fields}


def test_documents_and_arrays_give_the_same_as_two_passes(spark, tmp_path, rows):
    sites = [Site(spark, tmp_path / folder, format="json", infer_types=True, one_pass=once) for folder, once in (("two", False), ("one", True))]
    results = []
    for one in sites:
        one.drop("a.json", '[{"id":1,"n":{"x":2.5,"l":[1,2]},"none":null,"odd name":"x"},\n {"id":2,"n":{"x":3},"empty":[],"big":1e5}]')
        one.drop("b.json", '\ufeff{"id":3,"n":{"x":-1.0,"l":[]},"odd name":"y","flag":true,"big":7}')
        one.drop("blank.json", " \n")
        one.drop("nothing.json", "[]")
        one.run()
        one.drop("c.json", '[{"id":"four","n":{"x":"text"},"new":"n"},{"id":5,"big":0.5}]')
        results.append((one.run(), one.store.load()))
    (two, known), (once, schema) = results
    assert {f.name: f.dataType for f in schema.fields} == {f.name: f.dataType for f in known.fields}
    data = sorted(schema.names)
    compare = lambda df: rows(df.selectExpr(*[f"`{c}`" for c in data], "_rescued_data"))
    assert compare(once) == compare(two)


def test_misfits_are_kept_and_types_stay(site):
    site.drop("a.json", '[{"id":1,"pay":2.5},{"id":2,"pay":3}]')
    site.run()
    site.drop("b.json", '[{"id":"x","pay":"much"},{"id":"7","pay":"8.5"},{"id":2.5,"pay":1}]')
    out = site.run()
    assert kinds(site) == {"id": "bigint", "pay": "double"}
    assert values(out, "id", "pay", "_rescued_data") == sorted(
        [(1, 2.5, None), (2, 3.0, None), (None, None, '{"id":"x","pay":"much"}'), (7, 8.5, None), (None, 1.0, '{"id":"2.5"}')], key=repr
    )


def test_what_is_no_object_is_kept_as_text(site):
    site.drop("good.json", '[{"id":1}, 5, null, [2], "t"]')
    site.drop("cut.json", '[{"id":2},{"id"')
    site.drop("twice.json", '{"id":3,"id":4}')
    lost = {json.loads(r)["_corrupt_record"] for (r,) in values(site.run(), "_rescued_data") if r}
    assert lost == {"5", "null", "[2]", '"t"', '[{"id":2},{"id"', '{"id":3,"id":4}'}
    assert values(site.run().where("id IS NOT NULL"), "id") == [(1,)]


def test_names_with_quotes_points_and_other_case(site):
    names = ["a.b", "it's", 'say "x"', "it's \"y\"", "back`tick"]
    site.drop("a.json", json.dumps({n: i for i, n in enumerate(names)} | {"Id": 1, "n": {"in ner": 1, "p.q": [{"r s": 2}]}}))
    site.drop("b.json", '{"ID":2,"iD":null}')
    out = site.run()
    assert values(out.where("id = 1"), *[f"`{n.replace('`', '``')}`" for n in names]) == [tuple(range(len(names)))]
    assert values(out, "id") == [(1,), (2,)]
    assert out.where("id = 1").first().n.asDict(True) == {"in ner": 1, "p.q": [{"r s": 2}]}


def test_lines_folders_text_and_hints(spark, tmp_path):
    site = Site(spark, tmp_path, format="json", multi_line=False, one_pass=True, hints={"code": "decimal(38,0)", "later": "date"})
    site.drop("year=2024/a.json", '{"id":1,"code":12345678901234567890123}\n\n{"id":2.5,"year":9}\nbroken\n')
    out = site.run()
    assert kinds(site) == {"year": "int", "id": "string", "code": "decimal(38,0)", "later": "date"}
    assert values(out.selectExpr("year", "id", "CAST(code AS string) AS code", "_rescued_data"), "year", "id", "code", "_rescued_data") == sorted(
        [(2024, "1", "12345678901234567890123", None), (2024, "2.5", None, None), (2024, None, None, '{"_corrupt_record":"broken"}')], key=repr
    )


def test_landing_files_are_scanned_once(spark, tmp_path, site):
    from strata.sources.landing import read_files

    site.drop("a.json", '{"id":1}')
    rows = read_files(spark, site.landing, [f"file://{tmp_path}/in/a.json"], site.store)
    assert all("/in/" not in f for f in rows.inputFiles())
    assert values(rows, "id") == [(1,)]


def test_one_pass_is_for_json_without_options():
    for kind in ({"format": "csv"}, {"format": "json", "options": {"encoding": "UTF-16"}}):
        with pytest.raises(ValueError, match="one pass"):
            Landing("/in", one_pass=True, **kind)
