"""Language ID and line-chain quality: odd rows, held-out accuracy, brute force."""

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import __spark_entry__ as E
from covstar.llm import crf_quality as C
from covstar.llm import lang_id as L
from covstar.llm.common import table

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    got = E.queries()["op7_language"](spark, SF).toPandas().merge(pd.read_parquet(f"{SF}/documents.parquet"), on="doc_id")
    held = got[got.held_out & got.lang.notna()]
    assert len(got) == 1000 and len(held) > 150
    assert (held.lang_pred == held.lang).mean() >= 0.98
    assert got.score.between(0, 1).all()


def test_language_odd_rows(odd_docs, no_docs):
    rows = L.identify(odd_docs, F.lit(True)).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows if r.doc_id not in (17, 18, None)}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (4, 5, 6, 8))
    assert {r.lang_pred for r in rows} <= {"en", "xx", "und"} and by[1].lang_pred != "und"
    assert L.identify(no_docs, F.lit(True)).count() == 0
    assert {r.lang_pred for r in L.identify(odd_docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True)).collect()} == {"und"}
    one = L.identify(odd_docs.withColumn("lang", F.lit("aa")), F.lit(True)).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("aa", 1.0), ("und", 0.0)}


def test_every_language_is_learnt_however_many(spark):
    """300 languages, each with letters of its own: all are known, and held-out texts find theirs."""
    import random

    from covstar.llm.common import on_workers
    on_workers(spark)
    r = random.Random(4)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 900)]
    own = [letters[3 * k:3 * k + 3] for k in range(300)]
    text = lambda k: " ".join("".join(r.choice(own[k]) for _ in range(4)) for _ in range(12))
    docs = spark.createDataFrame([(k * 10 + j, text(k), f"l{k:03d}") for k in range(300) for j in range(4)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in L.identify(docs, F.col("doc_id") % 10 != 3).collect()}
    held = [r for i, r in got.items() if i % 10 == 3]
    assert len(held) == 300 and len({r.lang_pred for r in got.values()}) >= 295
    assert sum(r.lang_pred == f"l{r.doc_id // 10:03d}" for r in held) >= 285


def test_families_join_the_nearest_profiles():
    v = {"a": np.array([1, 0.0]), "b": np.array([.9, .1]), "c": np.array([0, 1.0]), "d": np.array([.1, .9])}
    assert L.families(v) == [["a", "b"], ["c", "d"]]


def test_quality_held_out(spark):
    got = E.queries()["op10_quality"](spark, SF).toPandas().merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() >= 0.95


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 1), (12, 0), (17, 0), (None, 1), (3, None)], "doc_id long, quality int")
    rows = C.score(odd_docs, labels, F.lit(True)).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 for r in rows if r.doc_id in (4, 5, 6))
    assert C.score(no_docs, labels, F.lit(True)).count() == 0
    assert {r.score for r in C.score(odd_docs, labels.filter("quality = 1"), F.lit(True)).collect()} == {0.0, 1.0}
    assert {r.score for r in C.score(odd_docs, labels.filter("false"), F.lit(True)).collect()} == {0.0}


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    sizes = np.array([3, 1, 5, 2])
    score, t = rng.normal(size=sizes.sum()) * 2, rng.normal(size=(2, 2))
    a, b = C.marginals(score, sizes, t)
    at = 0
    for n in sizes:
        s, total, good = score[at:at + n], 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(s[i] * y[i] for i in range(n)) + sum(t[y[i], y[i + 1]] for i in range(n - 1)))
            total += w
            good += w * np.array(y)
        assert np.allclose(C.sigmoid(a[at:at + n] + b[at:at + n]), good / total)
        at += n


def test_line_figures_and_neighbours():
    doc, n, x = C.lines(["One two two o.\n\n  \n%%% ab### 12", None, "", "A"])
    assert doc.tolist() == [0, 0, 3] and n.tolist() == [14.0, 12.0, 1.0]
    assert np.isclose(x[0, 7], 1 / 4) and x[1, 7] == 0                  # a word that repeats the one before
    assert x[0, 10] == 1 and x[0, 11] == 1 and x[1, 8] > 0
    assert (x[1, C.BASE:2 * C.BASE] == x[0, :C.BASE]).all() and (x[0, 2 * C.BASE:3 * C.BASE] == x[1, :C.BASE]).all()
    assert (x[2, C.BASE:3 * C.BASE] == 0).all()


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(1)
    m = C.Model(0, 1, rng.normal(size=C.WIDTH) / 5, rng.normal(size=(2, 2)))
    texts = ["One two.\nthree three\n%%% x", "A", "b\nc\nd\ne", None, "x" * 500]
    assert np.allclose(m.scores(texts), [m.scores([t])[0] for t in texts])


def test_tables_read_whole(spark):
    assert table(spark, SF, "documents").count() == E.queries()["op8_token_counts"](spark, SF).count()


def test_quality_learns_from_all_lines_of_a_long_document(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(C, "fit", lambda x, sizes, label: taken.append((len(x), sizes.tolist(), label.tolist())))
    docs = spark.createDataFrame([(1, "a clean line\n" * 600 + "!!! 111\n" * 300), (2, "one line")], "doc_id long, text string")
    C.train(docs, spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int"), F.lit(True))
    assert taken == [(901, [900, 1], [0, 1])]
