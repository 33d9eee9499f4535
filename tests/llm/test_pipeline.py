"""The stages against plain versions on their own inputs."""

import hashlib

import pytest

import __spark_entry__ as E
import corpus_pipeline as CP
from covstar.llm.common import stored, table
from covstar.llm.lang_id import UNKNOWN

from .test_simhash_gray import components, plain_print
from .test_suffix_dedup import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [table(spark, SF, "documents")]
    for name, stage in CP.STAGES:
        docs.append(stored(stage(spark, docs[-1], SF), f"test-{name}"))
    return docs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_and_columns(steps):
    assert [n for n, _ in CP.STAGES] == ["language", "quality", "near_duplicates", "repeated_passages", "packing"]
    assert all(d.columns == steps[0].columns and d.dtypes == steps[0].dtypes for d in steps[:-1])
    for before, after in zip(steps[:3], steps[1:4]):
        assert after.count() > 0 and set(rows(after)) <= set(rows(before))


def test_language_and_quality_keep_the_good(spark, steps):
    good = {r.doc_id for r in table(spark, SF, "labels").filter("quality = 1").collect()}
    lettered = {r.doc_id for r in steps[0].collect() if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in steps[1].collect()} >= good & lettered
    assert len(good - {r.doc_id for r in steps[2].collect()}) <= 0.03 * len(good)
    assert UNKNOWN == "und"


def test_near_duplicates(steps):
    docs = sorted(steps[2].collect(), key=lambda r: r.doc_id)
    root = components([plain_print(r.text) for r in docs])
    assert sorted(r.doc_id for r in steps[3].collect()) == sorted({docs[i].doc_id for i in root})


def test_repeated_passages(steps):
    before = {r.doc_id: r for r in steps[3].collect()}
    want = plain((i, before[i].text.encode()) for i in sorted(before))
    after = steps[4].collect()
    assert len(after) == len(before)
    for r in after:
        assert r.n_chars == len(r.text)
        if want[r.doc_id][1] == 0:
            assert r.text == before[r.doc_id].text
        elif r.text.isascii() and before[r.doc_id].text.isascii():
            assert hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id][3]


def test_packing_and_run(spark, steps):
    packed = steps[5].collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in steps[4].collect()}
    assert max(r.offset + r.length for r in packed) <= 2048
    again = E.queries()["pipeline"](spark, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows(again.select(*key)) == rows(steps[5].select(*key))


def test_odd_rows_and_empty_tables_go_through(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in CP.STAGES[:-1]:
            out = stored(stage(spark, docs, SF), "odd")
            assert out.columns == docs.columns
        assert stage(spark, docs, SF).count() == docs.count()
    kept = CP.near_duplicates(spark, odd_docs, SF).collect()
    prints = {plain_print(r.text) for r in odd_docs.collect()}
    assert len({plain_print(r.text) for r in kept}) == len(kept) <= len(prints)


def test_registered_only_where_installed(monkeypatch):
    import builtins
    real = builtins.__import__

    def gone(name, *a, **k):
        if name.startswith(("corpus_pipeline", "covstar.llm")):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)     # as for deleted files
        return real(name, *a, **k)

    def broken(name, *a, **k):
        if name.startswith("corpus_pipeline"):
            raise ModuleNotFoundError("No module named 'tokenizers'", name="tokenizers")
        return real(name, *a, **k)

    assert "pipeline" in E.queries() and "op9_url_filter" in E.oracle_sql()
    monkeypatch.setattr(builtins, "__import__", gone)
    assert "pipeline" not in E.queries() and set(E.queries()) == set(E.QUERIES)
    # files that are there but lack a library are a fault, not an absence
    monkeypatch.setattr(builtins, "__import__", broken)
    with pytest.raises(ModuleNotFoundError):
        E.queries()


def test_url_query_equals_its_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    got = E.queries()["op9_url_filter"](spark, SF)
    want = con.execute(E.oracle_sql()["op9_url_filter"])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert rows(got.select(*names)) == sorted(want.fetchall(), key=str)


def test_survivors_do_not_depend_on_an_unrelated_repeated_id(spark, steps):
    docs = steps[2]
    plainly = {r.doc_id for r in CP.near_duplicates(spark, docs, SF).collect()}
    lone = next(i for i in sorted(plainly))
    again = docs.union(docs.filter(docs.doc_id == lone)).union(docs.filter(docs.doc_id == lone).selectExpr("null", *[f"`{c}`" for c in docs.columns[1:]]))
    got = [r.doc_id for r in CP.near_duplicates(spark, again.repartition(5), SF).collect()]
    assert sorted(got) == sorted(plainly)
