"""The raw feed as pages of JSON text (S1): an export job and a data source.

Layout: ``<path>/batch=<n>/page=<day>/part-*.json``. A batch is one export of the
feed and counts once its ``_SUCCESS`` file stands; a page holds the rows of one
day of the timestamp text, those without such a day are in page ``other``. A page
with many rows has many files, and every file is a partition of the source.

The source reads a scan or a stream. A comparison of ``timestamp`` with a text
skips the pages of other days (the page ``other`` is always read; Spark still
applies the filter to the rows). A stream's offset is the last whole batch, so a
replayed micro-batch reads the same files.

The readers open the files from Python workers, through Arrow's file systems: the
path must be one that Arrow opens (a shared mount, an object store, HDFS with its
native client). For other stores ``read_measurements(fmt="json")`` reads the same
files by Spark's own reader. Rows must be whole JSON objects, one in a line; fields
outside the declared schema are ignored, absent ones are null. A batch that is
written again replaces itself; an empty batch has no pages.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan,
                                    GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual)

FORMAT, OTHER = "measurement_pages", "other"
DAY = r"^(\d{4}-\d{2}-\d{2})"
BLOCK = 1 << 20

# workers get the classes of this module with the job, wherever it is installed
register_pickle_by_value(sys.modules[__name__])


def export_pages(raw: DataFrame, path: str, batch: int, rows_per_file: int = 100_000) -> None:
    """Write ``raw`` (raw columns) as the pages of one batch. Range partitions
    on time and id split a day that holds most rows over many writers."""
    text = raw if dict(raw.dtypes)["timestamp"] == "string" else raw.withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    day = F.regexp_extract("timestamp", DAY, 1)
    paged = text.withColumn("page", F.when(day != "", day).otherwise(F.lit(OTHER)))
    (paged.repartitionByRange("page", "timestamp", "id").write.mode("overwrite").partitionBy("page")
     .option("maxRecordsPerFile", rows_per_file).json(f"{path.rstrip('/')}/batch={int(batch):09d}"))


def register_pages(spark: SparkSession) -> None:
    """Make ``spark.read.format("measurement_pages")`` known to the session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MeasurementPages)


class MeasurementPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        raise ValueError(f"{FORMAT} needs a declared schema")

    def reader(self, schema):
        return PageReader(self.options["path"], schema)

    def streamReader(self, schema):
        return PageStream(self.options["path"], schema)


@dataclass
class PageFile(InputPartition):
    path: str


def _opened(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def _names(system, folder: str) -> list:
    from pyarrow import fs
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted((f for f in found if f.base_name[0] not in "_."), key=lambda f: f.base_name)


def whole_batches(path: str) -> list[int]:
    """Numbers of the batches whose export has ended."""
    system, root = _opened(path)
    named = [f.base_name for f in _names(system, root) if f.base_name.startswith("batch=")]
    done = system.get_file_info([f"{root}/{n}/_SUCCESS" for n in named])
    return [int(n.partition("=")[2]) for n, mark in zip(named, done) if mark.is_file]


def page_files(path: str, batches, low: str | None = None, high: str | None = None) -> list[str]:
    """Files of the pages that may hold timestamps between ``low`` and ``high``."""
    system, root = _opened(path)
    out = []
    for batch in batches:
        for page in _names(system, f"{root}/batch={batch:09d}"):
            day = page.base_name.partition("=")[2]
            if day == OTHER or not (low and day < low[:10] or high and day > high[:10]):
                out += [f.path for f in _names(system, page.path) if f.size]
    return out


class _Pages:
    def __init__(self, path: str, schema):
        self.path, self.schema = path, schema

    def read(self, part: PageFile | None):
        import pyarrow as pa
        from pyarrow import json
        from pyspark.sql.pandas.types import to_arrow_schema

        if part is None:                      # a scan without files has one task
            return
        fields = to_arrow_schema(self.schema)
        options = json.ParseOptions(explicit_schema=fields, unexpected_field_behavior="ignore")
        with _opened(self.path)[0].open_input_stream(part.path) as stream:
            for batch in json.open_json(stream, json.ReadOptions(block_size=BLOCK), options):
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in fields], schema=fields)


class PageReader(_Pages, DataSourceReader):
    low = high = None

    def pushFilters(self, filters):
        """Note the days that comparisons of the timestamp leave; all filters stay with Spark."""
        for f in filters:
            if getattr(f, "attribute", None) == ("timestamp",) and isinstance(getattr(f, "value", None), str):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.low = max(self.low or f.value, f.value)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.high = min(self.high or f.value, f.value)
            yield f

    def partitions(self):
        return [PageFile(p) for p in page_files(self.path, whole_batches(self.path), self.low, self.high)]


class PageStream(_Pages, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"batch": 0}

    def latestOffset(self) -> dict:
        return {"batch": max(whole_batches(self.path), default=0)}

    def partitions(self, start: dict, end: dict):
        new = [b for b in whole_batches(self.path) if start["batch"] < b <= end["batch"]]
        return [PageFile(p) for p in page_files(self.path, new)]

    def commit(self, end: dict) -> None:
        """Nothing is held for a batch."""
