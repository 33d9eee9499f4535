"""Steps whose work must grow no faster than the rows."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from covstar import session
from covstar.operators.dimensions import _bounds_upto, dense_number
from covstar.operators.pyramid import zoom_pyramid

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_row_finds_its_bucket_by_halving(spark):
    bounds = [F.struct(F.lit(v).cast("int").alias("k")) for v in (None, 2, 2, 5, 8, 9, 12)]
    df = spark.createDataFrame([(v,) for v in (None, 0, 2, 5, 7, 12, 13)], "v int").withColumn("key", F.struct(F.col("v").alias("k")))
    got = {r.v: r.b for r in df.select("v", F.transform(F.array("key"), lambda k: _bounds_upto(bounds, k))[0].alias("b")).collect()}
    assert got == {None: 1, 0: 1, 2: 3, 5: 4, 7: 4, 12: 7, 13: 7}
    rows = spark.range(4000).select((F.col("id") * 7919 % 4001).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("s"))
    got = dense_number(rows, ["s", "k"], "n", per_bucket=20)
    assert "filter(" not in plan_of(got)
    key = lambda r: (r.s is not None, r.s or 0, r.k)
    assert [r.n for r in sorted(got.collect(), key=key)] == list(range(1, 4001))


def test_every_zoom_comes_from_one_scan_of_the_points(spark):
    pts = spark.range(600).select((F.col("id") % 37 - 18.5).alias("latitude"), (F.col("id") % 53 * 3.25 - 80).alias("longitude"),
                                  F.when(F.col("id") % 7 > 0, -(F.col("id") % 60).cast("double")).alias("medida_senal"))
    got = zoom_pyramid(pts, finest=6, coarsest=2)
    assert plan_of(got).count("Range (") == 1 and "Union" not in plan_of(got)
    for zoom in range(2, 7):
        one = zoom_pyramid(pts, finest=zoom, coarsest=zoom)
        key = lambda r: r.quadkey
        assert sorted(got.filter(F.col("zoom") == zoom).collect(), key=key) == sorted(one.collect(), key=key)


def test_dimension_sizes_are_counts(spark):
    w = E._wh(spark, SF)
    assert w.sizes == {n: d.count() for n, d in w.dims.items()}


def test_early_facts_read_the_accepted_rows_once(spark):
    got = E.q_early_facts(spark, SF)
    assert session.checkpoint_dir(spark) and "parquet" not in got._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    before, after = got.filter("dispositivo_antes = 0").count(), got.filter("dispositivo_despues = 0").count()
    assert before > after == 0


def test_plans_the_jvm_would_interpret_are_not_fused(spark):
    conf, held = session.HUGE_METHOD_CONF, spark.conf.get(session.HUGE_METHOD_CONF)
    try:
        for given, kept in (("65535", session.HUGE_METHOD_BYTES), ("4000", "4000")):
            spark.conf.set(conf, given)
            E._raw(spark, SF)
            assert spark.conf.get(conf) == kept
    finally:
        spark.conf.set(conf, held)
