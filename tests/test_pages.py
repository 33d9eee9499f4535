"""The feed as pages: a data source with a partition for each page file, pages
of other days skipped, and the same pages as a stream (S1)."""

import json
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, LessThanOrEqual

from covstar import raw_from_dir
from covstar.operators.clean import normalize
from covstar.sources import pages as P
from covstar.sources.raw import RAW_COLUMNS, RAW_TEXT_SCHEMA, read_measurements, since, stream_pages

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def feed(spark):
    """Two whole batches, one that never ended, rows without a day, odd fields."""
    base = tempfile.mkdtemp(prefix="covstar-pages-")
    text = raw_from_dir(spark, SF).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    i = F.col("id").cast("long")
    text = text.withColumn("timestamp", F.when(i % 31 == 0, None).when(i % 29 == 0, "soon").otherwise(F.col("timestamp"))).cache()
    P.export_pages(text.filter(i % 2 == 0), base, 1, rows_per_file=50)
    P.export_pages(text.filter(i % 2 == 1), base, 2)
    broken = Path(f"{base}/batch={3:09d}/page=2024-01-10")
    broken.mkdir(parents=True)
    (broken / "part-0.json").write_text(json.dumps({"id": "x", "timestamp": "2024-01-10T00:00:00"}) + "\n")
    return base, text


def rows(df):
    return sorted(map(tuple, df.select(*RAW_COLUMNS).collect()), key=repr)


def test_pages_hold_the_feed(spark, feed):
    base, text = feed
    got = read_measurements(spark, base, P.FORMAT)
    assert got.schema == RAW_TEXT_SCHEMA
    assert rows(got) == rows(text)
    assert P.whole_batches(base) == [1, 2]
    assert got.rdd.getNumPartitions() == len(P.page_files(base, [1, 2]))
    assert normalize(got).count() == normalize(text).count()


def test_comparisons_skip_pages_of_other_days(spark, feed):
    base, text = feed
    got = since(read_measurements(spark, base, P.FORMAT), "2024-01-20T12:00:00")
    assert rows(got) == rows(since(text, "2024-01-20T12:00:00"))
    kept = P.page_files(base, [1, 2], low="2024-01-20T12:00:00")
    assert 0 < len(kept) < len(P.page_files(base, [1, 2]))
    assert got.rdd.getNumPartitions() == len(kept)
    assert any("page=other" in f for f in kept)
    reader = P.PageReader(base, RAW_TEXT_SCHEMA)
    asked = [GreaterThan(("timestamp",), "2024-01-05"), LessThanOrEqual(("timestamp",), "2024-01-07T10"), EqualTo(("id",), "1")]
    assert list(reader.pushFilters(asked)) == asked and (reader.low, reader.high) == ("2024-01-05", "2024-01-07T10")
    days = {p.path.split("page=")[1].split("/")[0] for p in reader.partitions()}
    assert days == {"2024-01-05", "2024-01-06", "2024-01-07", "other"}


def test_unknown_fields_are_ignored_and_absent_ones_null(spark):
    base = tempfile.mkdtemp(prefix="covstar-pages-")
    folder = Path(f"{base}/batch={1:09d}/page=other")
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text('{"id": "1", "extra": {"a": 1}}\n{"id": null, "signal": -70}\n')
    (folder / "part-1.json").write_text("")
    (folder.parent / "_SUCCESS").write_text("")
    got = {(r.id, r.signal, r.timestamp) for r in read_measurements(spark, base, P.FORMAT).collect()}
    assert got == {("1", None, None), (None, -70.0, None)}
    assert read_measurements(spark, tempfile.mkdtemp(prefix="covstar-pages-"), P.FORMAT).count() == 0


def test_stream_takes_each_whole_batch_once(spark, feed):
    base, text = feed
    out, ck = (tempfile.mkdtemp(prefix=f"covstar-pages-{n}-") for n in ("out", "ck"))
    path = tempfile.mkdtemp(prefix="covstar-pages-")

    def run():
        q = (stream_pages(spark, path).writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination(300)
        assert q.exception() is None
        return rows(spark.read.schema(RAW_TEXT_SCHEMA).parquet(out))

    i = F.col("id").cast("long")
    P.export_pages(text.filter(i % 3 == 0), path, 1)
    assert run() == rows(text.filter(i % 3 == 0))
    P.export_pages(text.filter(i % 3 == 1), path, 2)
    P.export_pages(text.filter(i % 3 == 2), path, 3)
    assert run() == rows(text)
    assert run() == rows(text)
