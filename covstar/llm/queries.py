"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from covstar.llm import (crf_quality, dual_tree, exact_dedup, hilbert_ann, lang_id, packing, periodic_runs, simhash_gray, sp_dropout,
                         suffix_dedup, token_counts, url_filter, vector_codes)
from covstar.llm.common import crc_mod, table
from covstar.llm.grouping import with_totals
from covstar.llm.vectors import usable

# The least score of a good document; the rules of the URL filter (host, path, verdict).
QUALITY_FROM = 0.3
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


def op1_suffix_dedup(spark, d):
    found = suffix_dedup.repeated(table(spark, d, "documents"))
    return found.select("doc_id", suffix_dedup.digest(found).alias("d")).select("doc_id", "d.*")


def op2_packing(spark, d):
    return packing.pack(byte_pieces(table(spark, d, "documents")))


def op3_sentencepiece(spark, d):
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = sp_dropout.decoded(sp_dropout.encoded(table(spark, d, "documents"), model, check=False), model)
    return rows.select("doc_id", "n_tokens", "ids_crc32", (F.xxhash64("text") == F.col("source_hash")).alias("lossless"), "ids", "text")


def op4_exact_topk(spark, d):
    got = dual_tree.top_products(dual_tree.scaled(table(spark, d, "embeddings")), F.col("vec_id") % 20 == 0, 20)
    return got.withColumn("score", F.col("score").cast("long"))


def op5_hilbert_ann(spark, d):
    return hilbert_ann.nearest(usable(table(spark, d, "embeddings"), zero=False), F.col("vec_id") % 20 == 0, 20)


def op6_simhash(spark, d):
    got = simhash_gray.near_duplicates(table(spark, d, "documents"))
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_language(spark, d):
    docs = table(spark, d, "documents")
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    got = lang_id.predictor(lang_id.train(docs, ~held))(F.col("text"))
    return docs.select("doc_id", held.alias("held_out"), got.alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")


def op8_token_counts(spark, d):
    return token_counts.counts(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_url_filter(spark, d):
    rules = spark.sql(f"SELECT * FROM VALUES {_RULES_SQL} AS r(host, path, verdict)")
    return url_filter.judge(table(spark, d, "pages"), rules)


def op10_quality(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    scored = crf_quality.scorer(crf_quality.train(docs, labels, ~held))(F.col("text"))
    return (docs.select("doc_id", held.alias("held_out"), scored.alias("score"))
            .withColumn("predicted", (F.col("score") >= QUALITY_FROM).cast("int")))


def op11_exact_dedup(spark, d):
    return exact_dedup.marked(table(spark, d, "documents"), carry=["doc_id"])


def op12_vector_codes(spark, d):
    got, books = vector_codes.compressed(table(spark, d, "embeddings"), carry=["vec_id", "label"])
    got = got.select("vec_id", "label", F.lower(F.hex("vc_code")).alias("code"), F.col("vc_error").alias("error"))
    # distances of one label may exceed 64 bits in sum only where components are huge: null there
    got = with_totals(got.withColumn("row", F.xxhash64("vec_id", "code")), "label", "row",
                      {"part": F.sum(F.col("error").cast("decimal(38,0)"))}, {"label_error": F.sum("part")})
    return got.select("vec_id", "code", "error", F.col("label_error").try_cast("long").alias("label_error"),
                      F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


def op13_periodic_runs(spark, d):
    docs = table(spark, d, "documents")
    got = periodic_runs.runs(docs.select("doc_id", with_period(F.col("doc_id"), F.col("text")).alias("text")))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("back"), r["start"].alias("start"), r["period"].alias("period"))))
    return (got.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", (-F.col("best.back")).alias("length"), "best.period",
        F.floor(-F.col("best.back") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


def with_period(doc_id, text):
    """The text, from some word on repeating its first words there in every tenth document."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        at = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, at(i))), " "))

    # the words are bound once as the element of an array, not cut anew for each word
    words = F.array(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    return F.when(F.pmod(h, F.lit(10)) == 0, F.element_at(F.transform(words, repeated), 1)).otherwise(text)


def byte_pieces(docs):
    p = public_tokenizers
    return packing.pieces(docs, p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN)


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_packing, op3_sentencepiece, op4_exact_topk, op5_hilbert_ann,
                                   op6_simhash, op7_language, op8_token_counts, op9_url_filter, op10_quality,
                                   op11_exact_dedup, op12_vector_codes, op13_periodic_runs)}


def _codes_sql() -> str:
    """Rounds of the codebooks as a chain of tables: near0 assigns parts to book0, book1 holds their means, and so on."""
    rounds, entries, parts, scale = vector_codes.ROUNDS, vector_codes.ENTRIES, vector_codes.PARTS, vector_codes.SCALE
    chain = [f"""
whole AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS cells
  FROM whole, range({parts}) AS positions(p)),
book0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, cells AS c
  FROM part WHERE vec_id IN (SELECT vec_id FROM whole ORDER BY vec_id LIMIT {entries}))"""]
    for k in range(rounds + 1):
        chain.append(f"""
near{k} AS MATERIALIZED (SELECT vec_id, p, any_value(cells) AS cells, min(far * {entries} + e) AS best
  FROM (SELECT vec_id, p, cells, e, list_sum(list_transform(list_zip(cells, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS far
        FROM part JOIN book{k} USING (p)) GROUP BY vec_id, p)""")
        if k < rounds:
            chain.append(f"""
sums{k} AS (SELECT p, best % {entries} AS e, i, sum(cells[i]) AS s, count(*) AS n
  FROM near{k}, range(1, (SELECT max(len(cells)) FROM part) + 1) AS places(i) GROUP BY ALL),
mean{k} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM sums{k} GROUP BY p, e),
book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(mean{k}.c, book{k}.c) AS c FROM book{k} LEFT JOIN mean{k} USING (p, e))""")
    return "WITH " + ",".join(chain) + f""",
coded AS (SELECT vec_id, string_agg(lower(printf('%02x', CAST(best % {entries} AS BIGINT))), '' ORDER BY p) AS code,
                 CAST(sum(best // {entries}) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN whole USING (vec_id), digest"""


ORACLE_SQL = {
    "op9_url_filter": f"""
WITH rules(r_host, r_path, r_verdict) AS (VALUES {_RULES_SQL}),
cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (SELECT page_id, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS authority, coalesce(rest, '') AS rest FROM cut),
parts AS (SELECT page_id, translate(authority, '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
                 regexp_extract(substr(rest, length(authority) + 1), '^[^?#]*') AS path FROM named)
SELECT page_id, host, path,
  (SELECT arg_max(r_host || r_path, length(r_host) + length(r_path)) FROM rules
   WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)) AS rule,
  coalesce((SELECT arg_max(r_verdict, length(r_host) + length(r_path)) FROM rules
   WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)), 'allow') AS verdict
FROM parts""",
    "op11_exact_dedup": """
WITH named AS (SELECT doc_id, coalesce(text, '') AS body, row_number() OVER () AS row FROM documents),
ranked AS (SELECT doc_id, body, count(*) OVER same AS n, row_number() OVER (same ORDER BY doc_id DESC NULLS LAST, row) AS place,
                  max(doc_id) OVER same AS last FROM named WINDOW same AS (PARTITION BY body))
SELECT doc_id, last AS keep_id, n AS group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM ranked""",
    "op12_vector_codes": _codes_sql(),
}
