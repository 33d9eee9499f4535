import pytest
from pyspark.sql import types as T

from covstar.llm.common import on_workers

PASSAGE = "over the hills and far away the old river runs past a quiet mill where nobody has worked for many long years now "
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n, seed):
    import random
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "s", "ed", "ing"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and long texts, repeated rows, near copies, a
    passage in many texts, more columns with clashing names."""
    base = prose(120, 1)
    texts = [(1, base), (2, base), (3, base.replace("alpha", "ALPHA", 1)), (4, None), (5, ""), (6, "   \n\t "), (7, "a"),
             (8, "12345 !!! ???"), (9, PASSAGE + prose(30, 2)), (10, prose(30, 3) + " " + PASSAGE + prose(5, 4)),
             (11, PASSAGE), (12, "x" * 3000), (13, prose(20000, 5)), (14, "é̄ 日本語 🎉 ñandú\x00nul " * 12), (15, "one\n\ntwo  three \n four▁five"),
             (None, prose(60, 6)), (None, None), (17, PASSAGE + PASSAGE), (17, PASSAGE + PASSAGE), (18, prose(40, 7)), (18, prose(40, 8)),
             (2**60 + 1, prose(25, 9) + " <|endoftext|> " + prose(5, 1))]
    return [(i, t, None if k % 5 == 0 else "en" if k % 2 else "xx", None if k % 7 == 0 else "s", None, "clash", 1) for k, (i, t) in enumerate(texts)]


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
                       T.StructField("doc", T.IntegerType())])


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    on_workers(spark)
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    on_workers(spark)
    return spark.createDataFrame([], SCHEMA)
