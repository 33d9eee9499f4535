import hashlib
import random

from pyspark.sql import functions as F

from covstar.llm import exact_dedup as X
from covstar.llm.queries import ORACLE_SQL, QUERIES


def plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    last = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return groups, last


def check(got, rows):
    groups, last = plain(rows)
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    stays = {}
    for r in got:
        t = by_sha[r.text_sha256]
        assert r.doc_id in groups[t] and r.group_size == len(groups[t]) and r.keep_id == last[t]
        if r.kept:
            assert r.doc_id == last[t]
            stays[t] = stays.get(t, 0) + 1
    assert stays == {t: 1 for t in groups}


def test_odd_rows_and_empty_table(odd_docs, odd_rows, no_docs):
    check(X.marked(odd_docs).collect(), [(r[0], r[1]) for r in odd_rows])
    assert X.marked(odd_docs).columns == [*odd_docs.columns, *X.RESULTS]
    assert X.marked(no_docs).count() == 0 and X.distinct(no_docs).columns == no_docs.columns


def test_clashing_columns_are_replaced_and_come_back(spark):
    docs = spark.createDataFrame([(1, "a", "mine", 7), (2, "a", "yours", 8), (3, "b", None, 9)], "doc_id long, text string, kept string, keep_id int")
    assert sorted((r.doc_id, r.kept, r.keep_id) for r in X.marked(docs).collect()) == [(1, False, 2), (2, True, 2), (3, True, 3)]
    assert sorted(map(tuple, X.distinct(docs).collect())) == [(2, "a", "yours", 8), (3, "b", None, 9)]


def test_folded_filter_gives_the_same_rows(spark):
    r = random.Random(3)
    rows = [(i, f"text {r.randrange(9000)}" if i % 3 else "hot") for i in range(12_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    check(X.marked(docs).collect(), rows)
    check(X.marked(docs, filter_bytes=X.BITMAP_BYTES).collect(), rows)
    normal = X.distinct(docs, normal=lambda c: F.translate(c, "0123456789", "")).collect()
    assert sorted(x.text for x in normal)[0] == "hot" and len(normal) == 2


def test_only_possibly_repeated_rows_go_to_the_exact_step(spark):
    rows = [(i, f"single {i}") for i in range(20_000)] + [(i, f"pair {i // 2}") for i in range(20_000, 20_400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bitmaps, n = X.repeated_slots(docs, F.col("text"))
    again = {x.doc_id for x in X.possibly_repeated(docs, F.col("text"), bitmaps, n).filter("xd_again").collect()}
    assert again >= set(range(20_000, 20_400))
    assert len(again) < 400 + 20_000 * 0.03
    assert X.possibly_repeated(docs, F.col("text"), bitmaps, n).count() == len(rows)


def test_plan_is_native_and_single_rows_meet_no_shuffle(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = X.marked(docs, carry=["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    single = plan.split("Union")[1].split("text_sha256")[0]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in single
    bitmaps, n = X.repeated_slots(docs, F.col("text"))
    probed = X.possibly_repeated(docs, F.col("text"), bitmaps, n).filter("not xd_again")
    plan = probed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_query_has_its_sql(spark):
    assert "op11_exact_dedup" in QUERIES and "op11_exact_dedup" in ORACLE_SQL
