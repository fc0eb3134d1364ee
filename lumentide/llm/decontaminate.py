"""Benchmark decontamination by word n-grams, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lumentide.llm.common import ascii_lower, on_own_columns, written
from lumentide.llm.windows import with_windows

#: Words are runs of digits, letters and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What stands between words; a piece is a word with what precedes it, or the tail.
PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*" + WORD + r"|(?<=.)[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+\z"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, n: int, item_col: str, text_col: str) -> DataFrame:
    """Distinct windows of `n` words: `_hash`, `_window` (the words), `_items`, `_n`.

    An item of fewer words, but not none, is one window of all its words.
    """
    items = benchmark.select(
        F.col(item_col).cast("string").alias("_item"),
        F.transform(_words(F.col(text_col)), ascii_lower).alias("_words"))
    size = F.size("_words")
    return (
        items.filter(size > 0).withColumn("_n", F.least(size, F.lit(n)))
        .select("_item", "_n", "_words",
                F.explode(F.sequence(F.lit(1), size - F.col("_n") + 1)).alias("_at"))
        .select("_item", "_n", F.slice("_words", F.col("_at"), F.col("_n")).alias("_window"))
        .groupBy("_n", "_window").agg(F.collect_set("_item").alias("_items")))


def hit_positions(spans: Column) -> Column:
    """The places inside any of the spans (`at`, `end` exclusive), ascending, each once."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(
        spans, lambda s: F.sequence(s["at"], s["end"] - 1)))))


def as_runs(places: str) -> Column:
    """A column of ascending places as disjoint runs (`at`, `end` exclusive), in linear time:
    a run begins where the place before is missing, and ends where the next one is."""
    ends_before = lambda p, i: (i == 0) | (F.get(places, i - 1) != p - 1)
    ends_after = lambda p, i: (i == F.size(places) - 1) | (F.get(places, i + 1) != p + 1)
    return F.zip_with(
        F.filter(places, ends_before), F.filter(places, ends_after),
        lambda a, b: F.struct(a.alias("at"), (b + 1).alias("end")))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id", benchmark_text_col: str = "text",
    broadcast_bytes: int = 32 << 20,
) -> DataFrame:
    """Find the words of each document that lie in a benchmark window of `n` words.

    Adds `n_words`, `n_hit` (words in any occurrence of a window), `items` (ids of the
    items with occurring windows as strings, sorted), `hit_runs` (array of word ranges
    `at`..`end`) and `contaminated`; an input column of one of these names is replaced.
    `without_spans` or a filter on `contaminated` removes what was found.

    The hash set of benchmark windows is broadcast if it takes at most `broadcast_bytes`
    (the windows are stored and measured first); a larger one is joined by shuffling. Training windows are scanned as arrays of 64-bit hashes of lower-cased words
    (Unicode's lower case, which tells no words apart that A-Z alone makes equal), and every
    hit is verified word by word, so hash collisions change nothing. Only hits are shuffled, by
    document, besides the texts on their way to the result.

    NULL and empty texts have no words and no hits; a benchmark without words hits
    nothing. Rows of the same id and text share one result, rows of the same id and
    other texts have their own. NULL ids are ids like any other. Repeated benchmark
    rows count once; a NULL item id is an item without a name and is not listed.
    """
    return on_own_columns(
        docs, lambda own: _with_hits(own, benchmark, n, id_col, text_col, item_col,
                                     benchmark_text_col, broadcast_bytes),
        keep=(id_col, text_col), add=("n_words", "n_hit", "items", "hit_runs", "contaminated"))


def _with_hits(
    docs: DataFrame, benchmark: DataFrame, n: int, id_col: str, text_col: str, item_col: str,
    benchmark_text_col: str, broadcast_bytes: int,
) -> DataFrame:
    source = docs.select(
        F.col(id_col).alias("_doc"), F.xxhash64(text_col).alias("_text_hash"),
        _words(F.col(text_col)).alias("_words"))
    windows = written(benchmark_windows(benchmark, n, item_col, benchmark_text_col), "windows")
    # What a row takes in the broadcast relation: its words, its items, and some 100 bytes.
    bytes_of = (F.octet_length(F.array_join("_window", " ")) + 100 + F.aggregate(
        "_items", F.lit(0), lambda total, item: total + F.octet_length(item) + 16)).cast("bigint")
    sizes = dict(windows.groupBy("_n").agg(F.sum(bytes_of)).collect())  # n rows at most
    lengths, size = list(sizes), sum(sizes.values())
    found = None
    # The outer generator: an inner one gets a filter on its array's size, which would be
    # pushed down to the scan with a copy of the hashing for each mention of the array.
    # Hits are verified in a projection, where a false one becomes NULL and is not collected:
    # a filter would become the join's condition and take the join out of compiled code,
    # which then writes the whole array of words for each window.
    for k in sorted(lengths):
        known = with_windows(
            windows.filter(F.col("_n") == k).drop("_n"), "_window", k, "_all", F.lower
        ).select(F.element_at("_all", 1).alias("_hash"), "_items",
                 F.array_join("_window", " ").alias("_window"))
        if size <= broadcast_bytes:
            known = F.broadcast(known)
        same = ascii_lower(F.array_join(
            F.slice("_words", F.col("_at") + 1, F.lit(k)), " ")) == F.col("_window")
        hits = (
            with_windows(source, "_words", k, "_all", F.lower)
            .select("_doc", "_text_hash", "_words", F.posexplode_outer("_all").alias("_at", "_hash"))
            .join(known, "_hash")
            .select("_doc", "_text_hash", F.when(same, F.col("_items")).alias("_items"), F.when(
                same, F.struct(F.col("_at").alias("at"), (F.col("_at") + k).alias("end"))
            ).alias("_span")))
        found = hits if found is None else found.unionByName(hits)
    base = docs.withColumn("_text_hash", F.xxhash64(text_col)).withColumn(
        "n_words", F.regexp_count(F.coalesce(text_col, F.lit("")), F.lit(WORD)).cast("bigint"))
    if found is None:
        met = base.withColumns({
            "_runs": F.lit(None).cast("array<struct<at:int,end:int>>"),
            "_items": F.lit(None).cast("array<string>")}).drop("_text_hash")
    else:
        of_doc = (
            found.groupBy("_doc", F.col("_text_hash").alias("_hit_hash"))
            .agg(F.collect_set("_span").alias("_spans"), F.collect_set("_items").alias("_lists"))
            .select("_doc", "_hit_hash", hit_positions(F.col("_spans")).alias("_places"),
                    F.array_sort(F.array_distinct(F.flatten("_lists"))).alias("_items"))
            .select("_doc", "_hit_hash", as_runs("_places").alias("_runs"), "_items"))
        met = base.join(
            of_doc, base[id_col].eqNullSafe(of_doc["_doc"])
            & (base["_text_hash"] == of_doc["_hit_hash"]), "left",
        ).drop("_doc", "_hit_hash", "_text_hash")
    runs = F.coalesce("_runs", F.array().cast("array<struct<at:int,end:int>>"))
    return met.withColumns({
        "n_hit": F.aggregate(runs, F.lit(0).cast("bigint"), lambda s, r: s + r["end"] - r["at"]),
        "items": F.coalesce("_items", F.array().cast("array<string>")),
        "hit_runs": runs,
        "contaminated": F.size(runs) > 0,
    }).drop("_runs", "_items")


def without_spans(found: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace the text by what is left without the hit words and what precedes each of them."""
    pieces = F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(PIECE), F.lit(0))
    kept = F.filter(pieces, lambda p, i: ~F.exists(
        F.col("hit_runs"), lambda r: (i >= r["at"]) & (i < r["end"])))
    return found.withColumn(
        text_col, F.when(F.col("contaminated"), F.array_join(kept, "")).otherwise(F.col(text_col)))
