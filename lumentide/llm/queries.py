"""The operators as queries over the given tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lumentide.llm.codes import compress_vectors, with_total_error
from lumentide.llm.common import table, written
from lumentide.llm.decontaminate import decontaminate
from lumentide.llm.licences import known_licences, license_scan
from lumentide.llm.lines import line_dedup
from lumentide.llm.pieces import encode_pieces
from lumentide.llm.pii import BASE_KINDS, scan_pii, span_digest
from lumentide.llm.quality import adaptive_bounds, judged, with_base_measures
from lumentide.llm.simhash import simhash_dedup
from lumentide.llm.spans import sentence_span_dedup
from lumentide.llm.suffixes import substring_dedup
from lumentide.llm.tokens import read_tokens, write_tokens
from lumentide.llm.toxicity import fit, held_out, toxicity
from lumentide.llm.whitening import fit_whitening, whiten
from lumentide.session import configure, shared_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def decorate(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: build(configure(spark), sf_dir)
        if sql:
            ORACLES[name] = sql
        return build
    return decorate


@register("op2_line_dedup", """
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split),
hot AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT keyed.*, coalesce(doc_id <> last, false) AS dropped
  FROM keyed LEFT JOIN hot USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id""")
def _(spark, sf_dir):
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


_OP5_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')")


@register("op5_decontaminate", f"""
WITH items AS (SELECT item_id, {_OP5_WORDS} AS words FROM benchmark),
docs AS (SELECT doc_id, {_OP5_WORDS} AS words FROM documents),
item_at AS (
  SELECT item_id, words, least(len(words), 10) AS n,
    unnest(range(1, len(words) - least(len(words), 10) + 2)) AS pos
  FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(words[pos : pos + n - 1], ' ') AS gram FROM item_at),
sizes AS (SELECT DISTINCT n FROM windows),
doc_at AS (
  SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS pos
  FROM docs, sizes WHERE len(words) >= n),
hits AS (
  SELECT doc_id, pos, doc_at.n, item_id
  FROM doc_at JOIN windows
    ON doc_at.n = windows.n AND gram = array_to_string(words[pos : pos + doc_at.n - 1], ' ')),
hit_words AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS pos FROM hits),
hit_items AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs
LEFT JOIN (SELECT doc_id, count(*) AS n_hit FROM hit_words GROUP BY 1) USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
           FROM hit_items GROUP BY 1) USING (doc_id)""")
def _(spark, sf_dir):
    found = decontaminate(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@register("op1_simhash")
def _(spark, sf_dir):
    return simhash_dedup(table(spark, sf_dir, "documents"))


@register("op9_token_planes")
def _(spark, sf_dir):
    path = shared_dir(spark, "tokens")
    write_tokens(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


_OP8_WORDS = (
    "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), "
    "lambda w: w <> '')")
_OP8_BUCKET = "(x >> greatest(length(bin(x)) - 8, 0)) << greatest(length(bin(x)) - 8, 0)"


@register("op8_quality_rules", f"""
WITH texts AS (
  SELECT doc_id, lang, source, {_OP8_WORDS} AS words, coalesce(text, '') AS body,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
grams AS (
  SELECT doc_id, pos, array_to_string(words[pos : pos + 4], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS pos FROM texts
        WHERE len(words) >= 5)),
doubles AS (SELECT doc_id, pos FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
repeats AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, unnest(range(pos, pos + 5)) AS pos FROM doubles) GROUP BY 1),
base AS (
  SELECT doc_id, lang, source, len(words) AS n_words,
    length(array_to_string(words, '')) AS word_chars,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM texts LEFT JOIN repeats USING (doc_id)),
measured AS (
  SELECT doc_id, lang, source, measure, x, {_OP8_BUCKET} AS bucket, least_spread, both_sides
  FROM (
    SELECT doc_id, lang, source, 'word_length' AS measure, 1000 * word_chars // n_words AS x,
      250 AS least_spread, true AS both_sides FROM base WHERE n_words > 0
    UNION ALL SELECT doc_id, lang, source, 'symbols', 1000 * n_symbols // n_words, 50, false
      FROM base WHERE n_words > 0
    UNION ALL SELECT doc_id, lang, source, 'dup_lines', 1000 * n_dup_lines // n_lines, 100, false
      FROM base WHERE n_lines > 0
    UNION ALL SELECT doc_id, lang, source, 'repeats', 1000 * n_repeat_words // n_words, 50, false
      FROM base WHERE n_words > 0)),
levels AS (
  SELECT lang, source, measure, 0 AS level, bucket FROM measured
  UNION ALL SELECT lang, NULL, measure, 1, bucket FROM measured
  UNION ALL SELECT NULL, NULL, measure, 2, bucket FROM measured),
quartiles AS (
  SELECT lang, source, measure, level, count(*) AS total,
    quantile_disc(bucket, 0.25) AS q25, quantile_disc(bucket, 0.75) AS q75
  FROM levels GROUP BY ALL),
picked AS (
  SELECT m.*, CASE WHEN a.total >= 200 THEN a.q25 WHEN b.total >= 200 THEN b.q25 ELSE c.q25 END AS q25,
    CASE WHEN a.total >= 200 THEN a.q75 WHEN b.total >= 200 THEN b.q75 ELSE c.q75 END AS q75
  FROM measured m
  JOIN quartiles a ON a.level = 0 AND a.measure = m.measure
    AND a.lang IS NOT DISTINCT FROM m.lang AND a.source IS NOT DISTINCT FROM m.source
  JOIN quartiles b ON b.level = 1 AND b.measure = m.measure AND b.lang IS NOT DISTINCT FROM m.lang
  JOIN quartiles c ON c.level = 2 AND c.measure = m.measure),
outside AS (
  SELECT DISTINCT doc_id FROM picked
  WHERE x > q75 + 3 * greatest(q75 - q25, least_spread)
    OR both_sides AND x < q25 - 3 * greatest(q75 - q25, least_spread))
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND doc_id NOT IN (SELECT doc_id FROM outside) AS kept
FROM base""")
def _(spark, sf_dir):
    # Stored once: the texts are scanned a single time, for the sketches and the verdict.
    measured = written(
        with_base_measures(table(spark, sf_dir, "documents").select(
            "doc_id", "text", "lang", "source")).drop("text"), "measures")
    return judged(measured, adaptive_bounds(measured)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@register("op10_suffix_dedup")
def _(spark, sf_dir):
    return substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op4_toxicity")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return toxicity(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
        F.size("passages").cast("bigint").alias("n_passages"))


@register("op7_sentencepiece")
def _(spark, sf_dir):
    model = public_tokenizers.path("piece_bpe_32k.model")
    return encode_pieces(
        table(spark, sf_dir, "documents").select("doc_id", "text"), model, verify=True
    ).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.crc32(F.array_join("ids", ",").cast("binary")).alias("ids_crc32"),
        F.col("n_best.score").alias("scores"), "round_trip")


@register("op3_sentence_spans")
def _(spark, sf_dir):
    return sentence_span_dedup(
        table(spark, sf_dir, "documents").select("doc_id", "text"), passage=48
    ).select(
        "doc_id", "n_sentences", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op6_license_scan")
def _(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"), known_licences(spark))


@register("op11_pii")
def _(spark, sf_dir):
    found = scan_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        own = F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))
        return F.size(own).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, BASE_KINDS),
        F.sha2(span_digest("spans", base_only=True), 256).alias("base_sha256"),
        span_digest("spans").alias("spans"))


@register("op12_vector_codes")
def _(spark, sf_dir):
    coded, books = compress_vectors(
        table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    digits = F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return with_total_error(coded, "label").select(
        "vec_id", F.array_join(digits, "").alias("code"), "error",
        F.col("total_error").alias("label_error"),
        F.lit(books.digest()).alias("codebooks_sha256"))


@register("op13_whitening")
def _(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit_whitening(vectors)
    explained = F.array(*map(F.lit, model.explained)) if model else F.array()
    return (
        whiten(vectors, model)
        .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            "vec_id", (F.col("at") + 1).alias("component"),
            F.lit(model.n if model else 0).cast("bigint").alias("n"), "deviation", "whitened",
            F.get(explained, F.col("at")).cast("double").alias("explained"),
            F.lit(model.identity_error if model else None).cast("double").alias("identity_error")))
