import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from covstar.llm import queries as Q
from covstar.llm import sp_dropout as S
from covstar.llm import token_counts as C
from covstar.llm.piece_words import Pieces, words

PATH = P.path("piece_bpe_32k.model")
ODD = ["Hello  world", "  lead", " a", "tab\there", "new\nline", "ﬁ é ½ x", "日本語 　x", "a\xa0b", "", "trail  ", "\n\n", "a \n b",
       "x" * 300 + " yy" * 20, "a▁b ▁", "é́🎉🎉 ok", "nul\x00 x"]


def ids(b):
    return np.frombuffer(b, "<u4").tolist()


@pytest.mark.parametrize("text", ODD)
def test_rate_zero_is_the_model_and_any_rate_is_lossless(text):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    plain = ids(S.encode_many([1], [text], PATH, 1, 0)[0])
    if "▁" not in text and "\x00" not in text:
        assert plain == model.encode(text)
    for rate in (0, 0.3, 1.0):
        for doc in (1, 2, None):
            assert Pieces.of(PATH).text(ids(S.encode_many([doc], [text], PATH, 7, rate)[0])) == text


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab tehinró\n ▁日", max_size=60), st.integers(0, 50))
def test_lossless_on_any_text(text, doc):
    assert "".join(words(text)) == (" " + text if text else "")
    assert Pieces.of(PATH).text(ids(S.encode_many([doc], [text], PATH, 3, 0.2)[0])) == text


def test_together_equals_the_agenda():
    r = random.Random(1)
    m = S.Merger(Pieces.of(PATH), 5, 1, 0.25)
    many = list({" " * r.randint(0, 2) + "".join(r.choice("thereationsqué") for _ in range(r.randint(1, 14))) for _ in range(400)})
    assert m._together(many) == [m._agenda(w) for w in many]


def test_seeds_and_places_vary_the_cut():
    text = "international organisations " * 40
    cuts = {S.encode_many([d], [text], PATH, s, 0.3)[0] for d in range(6) for s in (1, 2)}
    assert len(cuts) > 3
    assert S.encode_many([1], [text], PATH, 1, 0.3) == S.encode_many([1], [text], PATH, 1, 0.3)


def test_every_document_and_place_has_a_cut_of_its_own():
    word, far = "international organisations", "x" * 60 + "national" * 6
    cuts = S.encode_many(list(range(300)), [word] * 300, PATH, 1, 0.3)
    assert len(set(cuts)) > 60
    assert S.encode_many([7, 3], [word, word], PATH, 1, 0.3) == [cuts[7], cuts[3]]
    assert len(set(S.encode_many(list(range(40)), [far] * 40, PATH, 1, 0.3))) > 30
    m = S.Merger(Pieces.of(PATH), 1, 0, 0.3)
    many = [" " + w for w in "antidisestablishmentarianism the of naturalisation the the internationalisations".split()] * 90 + [far] * 9
    keys = np.random.default_rng(1).integers(0, 1 << 63, len(many)).astype(np.uint64)
    assert m.cut(many, keys) == m.cut(many, keys) == [m._agenda(w, k) for w, k in zip(many, keys.tolist())]
    assert len({c for w, c in zip(many, m.cut(many, keys)) if w == many[0]}) > 40


def plain_agenda(word, pieces, skip):
    """By the definition alone: again and again the best-scored neighbours, leftmost
    if equal, whose join is a piece that is not skipped."""
    parts = [(i, i + 1) for i in range(len(word))]
    while True:
        best = None
        for (a, m), (_, e) in zip(parts, parts[1:]):
            i = pieces.ids.get(word[a:e])
            if i is None or pieces.ids.get(word[a:m]) is None or pieces.ids.get(word[m:e]) is None or skip(a, m, e):
                continue
            if best is None or pieces.scores[i] > best[0]:
                best = (pieces.scores[i], a, m, e)
        if best is None:
            return [i for a, e in parts for i in ([pieces.ids[word[a:e]]] if word[a:e] in pieces.ids else pieces.char_ids(word[a:e]))]
        _, a, m, e = best
        parts = [p for p in parts if p not in ((a, m), (m, e))] + [(a, e)]
        parts.sort()


@pytest.mark.parametrize("rate", [0.1, 0.5])
def test_the_trie_of_decisions_equals_a_plain_agenda(rate):
    pieces, r = Pieces.of(PATH), random.Random(8)
    m = S.Merger(pieces, 3, 0, rate)
    many = [" " * r.randint(0, 2) + "".join(r.choice("thereationsqué") for _ in range(r.randint(1, 12))) for _ in range(60)] * 8
    many += [" internationalisation"] * 100 + ["日本 x", "▁▁"]
    keys = np.random.default_rng(2).integers(0, 1 << 63, len(many)).astype(np.uint64)

    def skips(key):
        full = (1 << 64) - 1

        def skip(a, mid, e):
            h = key + a * 0x9E3779B97F4A7C15 + mid * 0xBF58476D1CE4E5B9 + e * 0x94D049BB133111EB & full
            h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & full
            h = (h ^ h >> 27) * 0x94D049BB133111EB & full
            return ((h ^ h >> 31) & 0xFFFFFFFF) < int(rate * (1 << 32))
        return skip
    want = [plain_agenda(w, pieces, skips(k)) for w, k in zip(many, keys.tolist())]
    grown = []
    for _ in range(6):   # first under keys, then from ever more nodes
        assert [ids(b) for b in m.cut(many, keys)] == want
        grown.append(len(m.word))
    assert grown[0] < grown[-1] and max(map(len, m.skips)) > (rate > 0.1)


def test_rare_words_take_no_nodes_and_are_cut_in_slabs_of_like_length(monkeypatch):
    """Words that come now and then are cut under their keys and leave nothing behind; lengths,
    unknown characters and the edges of slabs change no cut."""
    monkeypatch.setattr(S, "TOGETHER", 64)
    r = random.Random(4)
    many = list({" " * r.randint(0, 2) + "".join(r.choice("thereationsqué日▁🎉") for _ in range(r.randint(1, 46))) for _ in range(500)}) * 2
    many += ["x", " ", "日", "🎉🎉", "x" * S.SHORT, "national" * 6, "national" * 9]
    keys = np.random.default_rng(3).integers(0, 1 << 63, len(many)).astype(np.uint64)
    m = S.Merger(Pieces.of(PATH), 5, 0, 0.2)
    assert m.cut(many, keys) == [m._agenda(w, k) for w, k in zip(many, keys.tolist())]
    assert not m.word
    for _ in range(12):   # often met, they are remembered
        got = m.cut(many, keys)
    assert got == [m._agenda(w, k) for w, k in zip(many, keys.tolist())] and len(m.word) > 500


def test_forgetting_nodes_changes_nothing(monkeypatch):
    text = "international organisations and naturalisation of the thing " * 30
    want = S.encode_many([1, 2], [text, text], PATH, 9, 0.4)
    monkeypatch.setattr(S, "NODES_KEPT", 5)
    assert S.encode_many([1, 2], [text, text], PATH, 9, 0.4) == want
    assert S.encode_many([2], [text], PATH, 9, 0.4) == want[1:]


def test_encoding_odd_rows_round_trip(odd_docs, odd_rows, no_docs):
    got = S.encoded(odd_docs, PATH)
    rows = S.decoded(got, PATH).collect()
    key = lambda t: (t[0] or -1, t[1])
    assert sorted(((r.doc_id, r.text) for r in rows), key=key) == sorted(((r[0], r[1] or "") for r in odd_rows), key=key)
    assert all(r.lossless for r in rows)
    assert S.encoded(no_docs, PATH).count() == 0


def test_the_query_gives_the_ids_and_the_text_decoded_from_them(odd_docs, monkeypatch):
    monkeypatch.setattr(Q, "table", lambda spark, d, name: odd_docs)
    rows = Q.op3_sentencepiece(None, "").collect()
    assert len(rows) == odd_docs.count() and sum(r.n_tokens for r in rows)
    assert all(len(r.ids) == 4 * r.n_tokens and zlib.crc32(r.ids) == r.ids_crc32 and r.lossless for r in rows)
    assert sorted(r.text for r in rows) == sorted(r.text or "" for r in odd_docs.collect())


def test_trie_counts_equal_a_program_for_each_word(odd_docs, odd_rows, no_docs):
    u = C.model(PATH)
    rows = C.counts(odd_docs, PATH).collect()
    want = sorted((r[0] or -1, len(words(r[1] or "")), sum(u.count(w) for w in words(r[1] or ""))) for r in odd_rows)
    assert sorted((r.doc_id or -1, r.n_words, r.n_tokens) for r in rows) == want
    assert C.counts(no_docs, PATH).count() == 0


def test_counts_are_least_over_best_segmentations():
    u = C.model(PATH)

    def every(word):
        if not word:
            yield 0.0, 0
        for n in range(1, min(len(word), u.longest) + 1):
            s = u.score.get(word[-n:])
            if s is not None:
                for t, k in every(word[:-n]):
                    yield t + s, k + 1

    for w in (" the", " thing", "abab", " within", "rationed"):
        best = max(s for s, _ in every(w))
        assert u.count(w) == min(k for s, k in every(w) if s == best)


def test_decoding_hands_on_parts_of_a_batch(spark, monkeypatch):
    """A batch leaves in parts of few ids, every row once and with its other columns; one long text makes a part of its own."""
    texts = [(i, f"word {i} and more") for i in range(40)] + [(99, "long " * 400), (100, None)]
    got = S.encoded(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), PATH).collect()
    monkeypatch.setattr(S, "IDS_HELD", 20)
    frame = pa.table({"doc_id": [r.doc_id for r in got], "ids": [bytes(r.ids) for r in got]})

    class Rows:                               # what mapInArrow calls, on one batch of all rows
        def drop(self, *_):
            return self
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.BinaryType())])

        def mapInArrow(self, back, schema):
            assert schema.names == ["doc_id", "ids", "text"]
            return list(back(iter(frame.to_batches())))
    parts = S.decoded(Rows(), PATH)
    sizes = [p.num_rows for p in parts]
    assert len(sizes) > 5 and max(sizes) < 10
    assert sorted((d, t) for p in parts for d, t in zip(p["doc_id"].to_pylist(), p["text"].to_pylist())) == sorted((i, t or "") for i, t in texts)
