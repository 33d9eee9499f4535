import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from covstar.llm import packing as K
from covstar.llm.queries import byte_pieces


def test_every_piece_placed_once_without_gaps(odd_docs, odd_rows):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = K.pack(byte_pieces(odd_docs)).collect()
    want = []
    for r in odd_rows:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [0]
        for i, (s, n) in enumerate(K.cut(len(ids), 2048)):
            want.append((r[0], i, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())))
    key = lambda t: tuple(-1 if x is None else x for x in t)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 2048
    assert len(by) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_empty_table(no_docs):
    assert K.pack(byte_pieces(no_docs)).count() == 0


def test_cut_only_first_piece_short():
    assert K.cut(1, 4) == [(0, 1)] and K.cut(4, 4) == [(0, 4)]
    assert K.cut(9, 4) == [(0, 1), (1, 4), (5, 4)] and K.cut(8, 4) == [(0, 4), (4, 4)]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(0, 60))
def test_fullest_is_the_best_subset(available, room):
    got = K.fullest(sorted(available.items(), reverse=True), room)
    assert all(available[n] >= k for n, k in got.items())
    sums = {0}
    for n, c in available.items():
        sums |= {s + n * k for s in sums for k in range(1, c + 1)}
    assert sum(n * k for n, k in got.items()) == max(s for s in sums if s <= room)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50), max_size=12))
def test_plan_uses_every_piece_once(counts):
    plan = K.plan(counts, 40)
    for n, g in plan.groupby("length"):
        at = 0
        for r in g.itertuples():
            assert r.rank == at
            at += r.each * r.times
        assert at == counts[n]
    fills = {}
    for r in plan.itertuples():
        fills[r.sequence] = fills.get(r.sequence, 0) + r.length * r.each
    assert all(v <= 40 for v in fills.values())


def test_words_give_the_ids_of_whole_texts():
    enc = K.Encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    for t in ["", "a", " a", "a b", "it's we'll x", "a  b", "a \n b", "line\nnext line", "tab\t x", "ünï ñ 日本 語", "  x", "a　 b", "1,234 5.6", "<|endoftext|> z", "end "]:
        assert enc.encode(t) == enc._whole(t), t
