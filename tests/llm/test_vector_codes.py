import math
import random

import numpy as np
import pytest

from covstar.llm import vector_codes as V
from covstar.llm.common import on_workers


@pytest.fixture(scope="module")
def rows(spark):
    on_workers(spark)
    r = random.Random(5)
    out = [(i, [round(r.choice([-1, 0, 1]) + r.gauss(0, .02), 3) for _ in range(16)], i % 3 or None) for i in range(300, 0, -1)]
    out += [(400 + i, [0.25] * 16, 7) for i in range(200)]
    out += [(700, None, 1), (701, [None] + [1.0] * 15, 1), (702, [math.nan] * 16, 1), (703, [1.0] * 15 + [-math.inf], 1),
            (None, [0.5] * 16, 2), (5, [0.1] * 16, None), (5, [0.1] * 16, None), (704, [1.0, 2.0], 2), (705, [], 3), (706, [1e30, -1e30] + [0.0] * 14, 9)]
    return spark.createDataFrame([(i, v, n, "x") for i, v, n in out], "vec_id long, embedding array<double>, label int, code string")


def brute(pairs, parts, entries, rounds, scale):
    """Plain k-means on integers, part by part; (vec_id, code, error) rows and the codebooks."""
    good = [(i, v) for i, v in pairs if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not good:
        return [], []
    dim = max(1, -(-max(len(v) for _, v in good) // parts)) * parts
    bound = math.isqrt((1 << 60) // dim)
    good = [(i, [math.floor(max(-bound, min(bound, x * scale))) for x in v] + [0] * (dim - len(v))) for i, v in good]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w, books, codes = dim // parts, [], []
    for p in range(parts):
        own = [tuple(v[p * w:(p + 1) * w]) for _, v in good]
        book = [list(x) for x in own[:entries]]

        def near(x):
            return min(range(len(book)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(x, book[e])), e))
        for _ in range(rounds):
            held = {}
            for x in own:
                held.setdefault(near(x), []).append(x)
            for e, xs in held.items():
                book[e] = [sum(c) // len(xs) for c in zip(*xs)]
        books.append(book)
        codes.append([(e := near(x), sum((a - b) ** 2 for a, b in zip(x, book[e]))) for x in own])
    return [(i, "".join(f"{c[k][0]:02x}" for c in codes), sum(c[k][1] for c in codes)) for k, (i, _) in enumerate(good)], books


@pytest.mark.parametrize("parts,entries,rounds", [(8, 16, 6), (4, 5, 2), (3, 16, 1)])
def test_codes_errors_and_codebooks_match_plain_rounds(rows, parts, entries, rounds):
    pairs = [(r.vec_id, r.embedding) for r in rows.collect()]
    want, books = brute(pairs, parts, entries, rounds, 4096)
    got, found = V.compressed(rows, parts=parts, entries=entries, rounds=rounds)
    assert found.tolist() == books
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([(r.vec_id, r.vc_code.hex(), r.vc_error) for r in got.collect()], key=key) == sorted(want, key=key)
    assert got.columns == ["vec_id", "label", "code", "vc_code", "vc_error"]


def test_few_rows_and_empty_table(rows):
    few = rows.filter("vec_id in (1, 2)")
    got, books = V.compressed(few)
    assert books.shape == (8, 2, 2) and sorted(r.vc_error for r in got.collect()) == [0, 0]
    got, books = V.compressed(rows.filter("false"))
    assert got.count() == 0 and books.size == 0
    assert V.compressed(rows.filter("vec_id = 700"))[0].count() == 0


def test_trie_distances_are_those_of_every_part_at_any_leaf_size(monkeypatch):
    rng = np.random.default_rng(4)
    rows = rng.integers(-3, 4, (3000, 5))
    rows = rows[np.lexsort(rows.T[::-1])].astype(np.int64)
    entries = rng.integers(-5, 6, (7, 5)).astype(np.int64)
    want = ((rows[:, None, :] - entries[None]) ** 2).sum(2)
    for leaves in (1, 3, 50, 2048, 10_000):
        monkeypatch.setattr(V, "LEAVES", leaves)
        assert (V.distances(rows, entries) == want).all()
    same = np.repeat(rows[:1], 900, 0)
    monkeypatch.setattr(V, "LEAVES", 4)
    assert (V.distances(same, entries) == want[0]).all()
    assert V.distances(rows[:0], entries).shape == (0, 7)


def test_a_shared_prefix_is_accumulated_once(monkeypatch):
    seen = []
    real = V._subtree
    monkeypatch.setattr(V, "_subtree", lambda rows, depth, above, entries: seen.append((len(rows), depth)) or real(rows, depth, above, entries))
    monkeypatch.setattr(V, "LEAVES", 10)
    rows = np.array([[1, 2, x] for x in range(40)] + [[2, x, 0] for x in range(5)], np.int64)
    V.distances(rows, np.zeros((2, 3), np.int64))
    assert sum(n for n, _ in seen) == 45 and any(depth >= 2 for _, depth in seen)
