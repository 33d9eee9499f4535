import hashlib

import numpy as np
import pandas as pd
import pytest

from covstar.llm import suffix_dedup as D

from .conftest import PASSAGE, SCHEMA, prose


def plain(docs):
    """Removal by the definition, over (key, bytes) in corpus order."""
    seen, out = set(), {}
    for key, data in docs:
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - D.MATCH + 1):
            w = data[i:i + D.MATCH]
            if w in seen:
                gone[i:i + D.MATCH] = True
            else:
                seen.add(w)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[key] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def digests(found):
    return [tuple(r) for r in found.select("doc_id", "text", D.digest(found).alias("d")).select("doc_id", "text", "d.*").collect()]


@pytest.mark.parametrize("variants", [1, 512])
def test_against_brute_force(spark, odd_docs, odd_rows, variants):
    rows = [r for r in odd_rows if r[0] is not None and r[0] != 18]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = plain({(r[0]): (r[1] or "").encode() for r in sorted(rows, key=lambda r: r[0])}.items())
    got = digests(D.repeated(df, variants))
    assert len(got) == len(rows)
    assert {r[0]: r[2:] for r in got} == want
    assert want[2][1] == want[2][0] and want[17][1] > 0


def test_odd_rows_keep_rows_and_columns(odd_docs, odd_rows, no_docs):
    found = D.repeated(odd_docs)
    assert found.columns == [*odd_docs.columns, "dd_spans"]
    got = digests(found)
    assert sorted((r[0] or 0, r[1] or "") for r in got) == sorted((r[0] or 0, r[1] or "") for r in odd_rows)
    assert len({r for r in got if r[0] == 17}) == 1                      # rows that repeat are one document
    assert D.repeated(no_docs).count() == 0


def test_a_repeated_row_with_a_passage_shared_in_part_counts_once(spark):
    shared = PASSAGE + prose(12, 21)
    rows = [(1, prose(40, 22) + " " + shared + " " + prose(40, 23)), (2, prose(40, 24) + " " + shared + " " + prose(40, 25)),
            (3, prose(40, 26) + " " + shared[20:] + " " + prose(40, 27))]
    want = plain((i, t.encode()) for i, t in rows)
    df = spark.createDataFrame([rows[0], rows[1], rows[1], rows[1], rows[2], rows[2]], "doc_id long, text string").repartition(3)
    got = digests(D.repeated(df))
    assert len(got) == 6 and 0 < want[2][1] < want[2][0] / 2
    assert {(r[0], r[2:]) for r in got} == set(want.items())


def test_texts_stay_readable(spark):
    text = "".join(chr(0x100 + i) for i in range(110))
    df = spark.createDataFrame([(1, "a" + text), (2, "bä" + text + "cö")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in D.deduplicated(df).collect()}
    assert got[1] == "a" + text and got[2] == "bäcö"


def test_levels_merge_geometrically_and_find_what_came_before():
    rng = np.random.default_rng(3)
    family, seen = D.IndexFamily(), set()
    for _ in range(40):
        texts = [bytes(rng.integers(97, 99, 103).astype(np.uint8)) if rng.random() < .7 else b"q" * 120 for _ in range(20)]
        strings, text, place = D.suffixes(texts)
        plain_ = [texts[t][p:p + D.MATCH] for t, p in zip(text, place)]
        want = []
        for w in plain_:
            want.append(w in seen)
            seen.add(w)
        assert family.add(strings).tolist() == want
    sizes = [len(x) for x in family.levels]
    assert sum(sizes) == len(seen) and all(a > 2 * b for a, b in zip(sizes, sizes[1:]))


def test_slices_of_long_texts_hold_each_start_once(monkeypatch):
    import pandas as pd
    monkeypatch.setattr(D, "CHUNK", 500)
    text = "".join(chr(97 + i % 23) for i in range(3333))
    starts = []
    for part in D._chunks([pd.DataFrame({"doc": [1], "tie": [0], "text": [text]})]):
        for _, _, off, piece in part:
            assert piece == text[off:off + len(piece)].encode()
            starts += range(off, off + len(piece) - D.MATCH + 1)
    assert starts == list(range(len(text) - D.MATCH + 1))


def test_anchors_stream_in_slots_whatever_the_batches():
    rng = np.random.default_rng(0)
    key, cells = ["gram", "whole", "doc", "tie", "lo"], lambda d, c: sorted(map(tuple, d[c].to_numpy(np.int64).tolist()))
    for _ in range(60):
        n, most, size = rng.integers(1, 200), int(rng.integers(1, 8)), int(rng.integers(1, 40))
        rows = pd.DataFrame({"gram": rng.integers(0, 4, n), "whole": rng.integers(0, rng.integers(1, 30), n), "doc": rng.integers(0, 9, n),
                             "tie": 0, "lo": rng.integers(0, 6, n)})
        rows = rows.assign(hi=rows["lo"] + rows["whole"], end=np.where(rng.random(n) < 0.1, 5, -1)).sort_values(key, ignore_index=True)
        got = pd.concat(list(D._whole_runs(iter([rows[i:i + size] for i in range(0, n, size)]), most)))
        runs = rows[rows["end"] < 0].drop_duplicates()
        again = runs.duplicated(["gram", "whole"])
        first = runs[~again]
        first = first[first.groupby("gram")["gram"].transform("size") > 1]
        taken, closed = got[got["slot"] >= 0], got[got["slot"] < 0]
        assert cells(taken, ["gram", "doc", "start", "end"]) == cells(first.assign(end=first["hi"] + D.MATCH), ["gram", "doc", "lo", "end"])
        later = runs.assign(end=runs["hi"] + D.MATCH)[again]        # an empty frame would take the rows of a column assigned to it
        assert cells(closed, ["doc", "start", "end"]) == sorted(cells(later, ["doc", "lo", "end"]) + cells(rows[rows["end"] >= 0], ["doc", "lo", "end"]))
        for _, part in taken.groupby("gram"):
            assert sorted(part["slot"].tolist()) == [i // most for i in range(len(part))] and (part["dealt"] == (len(part) > most)).all()


def test_a_task_of_many_anchors_holds_a_few_of_them_at_a_time(monkeypatch):
    """Spans as from one index of all, whatever the batches; each index takes whole slots of about FAMILY texts."""
    monkeypatch.setattr(D, "FAMILY", 40, raising=False)
    monkeypatch.setattr(D, "BATCH", 16)
    sizes, real = [], D.IndexFamily.add

    def add(self, strings):
        out = real(self, strings)
        sizes.append(sum(map(len, self.levels)))
        return out

    monkeypatch.setattr(D.IndexFamily, "add", add)
    rng = np.random.default_rng(5)
    rows = []
    for gram in range(120):
        base = rng.integers(97, 123, 130).astype(np.uint8).tobytes()
        for doc in rng.permutation(50)[:rng.integers(2, 12)].tolist():
            a, b = int(rng.integers(0, 20)), int(rng.integers(120, 131))
            rows.append((gram, 0, False, doc, 0, 1000 * gram + a, base[a:b], base))
    rows = pd.DataFrame(rows, columns=["gram", "slot", "dealt", "doc", "tie", "start", "bytes", "base"])
    want, seen = set(), set()
    for r in rows.sort_values(["doc", "start"]).itertuples():
        for i in range(len(r.bytes) - D.MATCH + 1):
            w = r.bytes[i:i + D.MATCH]
            want |= {(r.doc, r.start + i)} if w in seen else set()
            seen.add(w)
    rows = rows.drop(columns="base")
    for size in (7, 100, len(rows)):
        sizes.clear()
        got = pd.concat(list(D._scan(iter([rows[i:i + size] for i in range(0, len(rows), size)]))))
        assert not got["open"].any()
        assert {(r.doc, x) for r in got.itertuples() for x in range(r.start, r.end - D.MATCH + 1)} == want
        assert max(sizes) <= (40 + 12) * 31 < len(seen)


def test_runs_leave_a_task_in_small_parts(monkeypatch):
    monkeypatch.setattr(D, "SENT", 50, raising=False)
    texts = [prose(400, 31), prose(300, 32)]
    docs = pd.DataFrame({"doc": [1, 2, 3], "tie": 0, "text": [*texts, texts[0]]})
    out = list(D._runs_of(iter([docs])))
    assert len(out) > 1 and max(map(len, out)) <= 50
    rows = pd.concat(out)
    first, later = rows[rows["end"] < 0], rows[rows["end"] >= 0]
    assert not first.duplicated(["gram", "whole"]).any() and set(first["doc"]) == {1, 2}
    assert set(later["doc"]) == {3} and (later["end"] - later["lo"]).sum() == len(texts[0].encode())
