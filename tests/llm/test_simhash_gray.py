import random

import numpy as np
import xxhash

from covstar.llm import simhash_gray as S
from covstar.llm.common import on_workers


def plain_print(text):
    import re
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0D]+", low)
    sh = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components(codes):
    parent = list(range(len(codes)))
    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 3:
                a, b = i, j
                while parent[a] != a:
                    a = parent[a]
                while parent[b] != b:
                    b = parent[b]
                parent[max(a, b)] = min(a, b)
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    return [root(i) for i in range(len(codes))]


def test_fingerprints(odd_rows):
    got = S.fingerprint_many([r[1] for r in odd_rows])
    assert got.tolist() == [plain_print(r[1]) for r in odd_rows]


def test_odd_rows(odd_docs, odd_rows, no_docs):
    rows = S.near_duplicates(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    order = sorted((r for r in odd_rows if r[0] is not None), key=lambda r: r[0])
    codes = [plain_print(r[1]) for r in order]
    root = components(codes)
    want = sorted((order[i][0], order[root[i]][0]) for i in range(len(order)))
    assert sorted((r.doc_id, r.component_id) for r in rows if r.doc_id is not None) == want
    empty = {r.component_id for r in rows if r.fp == 0}
    assert empty == {4}                                   # null and empty texts link, the row without id among them
    assert S.near_duplicates(no_docs).count() == 0


def test_index_links_all_pairs_of_a_dense_group(spark, monkeypatch):
    r = random.Random(4)
    centre = r.getrandbits(64)
    codes = {centre}
    while len(codes) < 300:
        c = r.choice(list(codes)) if r.random() < .8 else r.getrandbits(64)
        for _ in range(r.randint(0, 4)):
            c ^= 1 << r.randrange(64)
        codes.add(c)
    codes = sorted(codes)
    df = spark.createDataFrame([(int(np.uint64(c).view(np.int64)), i) for i, c in enumerate(codes)], "fp long, rep long")
    root = components(codes)
    for block in (16, 2048):
        monkeypatch.setattr(S, "BLOCK", block)
        found = {x.node: x.component for x in S.components(S.links(df), "u", "v").collect()}
        assert [found.get(i, i) for i in range(len(codes))] == root


def test_gray_rank_orders_neighbours_one_bit_apart():
    codes = np.arange(256, dtype=np.uint64)
    ordered = codes[np.argsort(S.gray_rank(codes))]
    assert (np.bitwise_count(ordered[1:] ^ ordered[:-1]) == 1).all()


def test_components_of_a_hub_a_path_and_odd_edges(spark):
    from covstar.llm.components import components as connected
    on_workers(spark)
    edges = [(500, i) for i in range(100, 400)] + [(1000, i) for i in range(700, 790)] + [(i, i + 1) for i in range(600, 640)] + [(7, 7), (None, 3), (3, None), (900, 800), (800, 900)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "u long, v long"), "u", "v").collect()}
    want = {i: 100 for i in [*range(100, 400), 500]} | {i: 600 for i in range(600, 641)} | {i: 700 for i in [*range(700, 790), 1000]} | {800: 800, 900: 800}
    assert got == want
