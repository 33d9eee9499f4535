import hashlib
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from covstar.llm import periodic_runs as P
from covstar.llm.queries import QUERIES


def brute(w, least=12):
    """Runs by their meaning: every period, every maximal stretch, the smallest period of each."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j
    # a stretch may also be listed by multiples of its period: the least was set first
    return sorted([(s, n, q) for (s, n), q in found.items()], key=lambda x: (x[0], x[2]))


def digest(doc_id, text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4), st.sampled_from([2, 4, 12]))
def test_runs_of_small_alphabets(texts, least):
    words = [[b"%d" % x for x in t] for t in texts]
    assert P.runs_of(words, least) == [brute(w, least) for w in words]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 8)), max_size=8))
def test_runs_of_repeated_blocks(blocks):
    w = [b"%d" % x for block, times in blocks for x in block * times]
    assert P.runs_of([w]) == [brute(w)]


def test_equal_and_very_long_texts_of_a_batch():
    r = random.Random(1)
    one = [b"a"] * 3000
    two = [b"%d" % r.randrange(50) for _ in range(400)] * 5 + [b"x"] + [b"y", b"z"] * 700
    got = P.runs_of([one, two, one, [], [b"q"]])
    assert got[0] == got[2] == [(0, 3000, 1)] and got[3] == got[4] == []
    assert got[1] == brute(two) and (0, 2000, 400) in got[1] and (2001, 1400, 2) in got[1]
    text = [b"%d" % r.randrange(10 ** 9) for _ in range(150_000)]
    assert P.runs_of([text + text[-7:] * 5]) == [[(150_000 - 7, 42, 7)]]


def test_line_between_many_neighbours():
    """One line among many different words: many left words in one interval."""
    line = [b"one", b"two", b"three", b"four", b"five", b"six", b"seven"]
    w = [x for i in range(400) for x in [*line, b"n%d" % (i * 7 % 397)]] + line * 3
    assert P.runs_of([w]) == [brute(w)]


def test_query_matches_brute_force_on_odd_rows_and_documents(spark, odd_docs, odd_rows, no_docs, tmp_root):
    """The odd rows, some with planted periods, and the first table of documents through the registered query."""
    more = [(i, "".join(f"w{(i * k) % 17} " for k in range(60)), None, None, None, None, None) for i in range(100, 400)]
    spark.createDataFrame(odd_rows + more, odd_docs.schema).write.parquet(f"{tmp_root}/a/documents.parquet")
    got = sorted(map(tuple, QUERIES["op13_periodic_runs"](spark, f"{tmp_root}/a").collect()), key=str)
    assert got == sorted([digest(r[0], r[1]) for r in odd_rows + more], key=str)
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet").filter(F.length("text") < 6000).select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, small).collect()}
    assert all(got[d.doc_id] == digest(d.doc_id, d.text) for d in docs)
    no_docs.write.parquet(f"{tmp_root}/b/documents.parquet")
    assert QUERIES["op13_periodic_runs"](spark, f"{tmp_root}/b").count() == 0


def test_general_form_returns_spans_and_text(spark):
    docs = spark.createDataFrame([(1, "intro " + "a b c " * 6 + "end"), (2, None), (None, " x y\n")], "doc_id int, text string")
    got = {r.doc_id: r for r in P.runs(docs).collect()}
    assert [tuple(x) for x in got[1].runs] == [(1, 18, 3)] and got[1].collapsed == "intro a b c end"
    assert got[2].n_words == 0 and got[2].runs == [] and got[2].collapsed == ""
    assert got[None].n_words == 1 and got[None].collapsed == "x y"

