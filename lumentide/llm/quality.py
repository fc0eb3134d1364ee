"""Quality rules with thresholds adapted to each language and source; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from lumentide.llm.common import SPACE
from lumentide.llm.windows import with_windows, without_head

SYMBOL = r"[#*$%&|<>]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
#: Measures in thousandths, as numerator and denominator, with the least spread (in
#: thousandths) that a group is taken to have and whether low values are outliers too.
MEASURES: Mapping[str, tuple[str, str, int, bool]] = {
    "word_length": ("word_chars", "n_words", 250, True),
    "symbols": ("n_symbols", "n_words", 50, False),
    "dup_lines": ("n_dup_lines", "n_lines", 100, False),
    "repeats": ("n_repeat_words", "n_words", 50, False),
}


def with_base_measures(docs: DataFrame, text_col: str = "text", window: int = 5) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed.

    `n_lines` counts lines with a word. Repeated words are the positions covered by windows
    found more than once in the text: window hashes are sorted with their positions, for the
    texts that have any double at all, and the gaps between repeated positions added up.
    NULL is a text without words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumns({
        "_words": F.array_remove(F.split(text, SPACE + "+"), ""),
        "_lines": F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(NOT_SPACE))),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOL)).cast("bigint"),
    })
    df = with_windows(df, "_words", window, "_hashes")
    df = df.withColumn("_doubles", F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
        F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.filter("_doubles", lambda x, i: (
        F.coalesce(F.get(F.col("_doubles"), i + 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(F.col("_doubles"), i - 1)["h"] == x["h"], F.lit(False))))
    df = df.withColumn("_at", F.sort_array(F.transform(again, lambda x: x["i"])))
    covered = F.zip_with(
        "_at", without_head(F.col("_at"), 1),
        lambda a, b: F.least(F.lit(window), F.coalesce(b - a, F.lit(window))))
    df = df.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
        "n_lines": F.size("_lines").cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_repeat_words": F.coalesce(F.aggregate(
            covered, F.lit(0).cast("bigint"), lambda s, x: s + x), F.lit(0)),
    })
    return df.withColumn("base_failed", (F.col("n_words") < 10) | (
        100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).drop(
        "_words", "_lines", "_hashes", "_doubles", "_at")


def measure(name: str) -> Column:
    """A measure in whole thousandths; NULL where there is nothing to measure."""
    above, below = MEASURES[name][:2]
    return F.when(F.col(below) > 0, F.expr(f"1000 * {above} div {below}"))


def bucket(value: Column) -> Column:
    """Lower end of the value's bucket: exact below 256, else 128 buckets for each power of two."""
    shift = F.greatest(F.length(F.bin(value)) - 8, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(measured: DataFrame, groups: list[str]) -> DataFrame:
    """Quantile sketches: number of documents by group, measure and bucket.

    Counts of buckets are the whole state, so sketches merge by adding, and do so map-side:
    a group with a third of all rows sends a few hundred rows from each task.
    """
    each = F.explode(F.array(*[
        F.struct(F.lit(n).alias("measure"), bucket(measure(n)).alias("bucket"))
        for n in MEASURES])).alias("_m")
    return (
        measured.select(*groups, each).select(*groups, "_m.*").filter(F.col("bucket").isNotNull())
        .groupBy(*groups, "measure", "bucket").agg(F.count("*").alias("n")))


def quartiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """`q25`, `q75` and the number of documents of each group and measure."""
    merged = sketch.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))
    own = Window.partitionBy(*groups, "measure")
    up_to = own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return (
        merged.withColumns({"_total": F.sum("n").over(own), "_sum": F.sum("n").over(up_to)})
        .groupBy(*groups, "measure").agg(
            F.max("_total").alias("total"),
            F.min(F.when(4 * F.col("_sum") >= F.col("_total"), F.col("bucket"))).alias("q25"),
            F.min(F.when(4 * F.col("_sum") >= 3 * F.col("_total"), F.col("bucket"))).alias("q75")))


def adaptive_bounds(
    measured: DataFrame, groups: tuple[str, str] = ("lang", "source"), min_group: int = 200,
    reach: int = 3,
) -> DataFrame:
    """`low` and `high` of each measure for every language and source.

    A value is an outlier beyond `reach` spreads outside the middle half of its group. A
    group with fewer than `min_group` documents takes the bounds of its language, and that
    of all documents where the language is small as well.
    """
    first, second = groups
    own = sketches(measured, [first, second])
    levels = [quartiles(own, [first, second]), quartiles(own, [first]), quartiles(own, [])]
    names = ["total", "q25", "q75"]
    levels = [
        q.select(*[F.col(c).alias(f"{c}{i}" if c in names or i and c != "measure" else c)
                   for c in q.columns]) for i, q in enumerate(levels)]
    met = (
        levels[0].join(levels[1], (levels[0]["measure"] == levels[1]["measure"])
                       & levels[0][first].eqNullSafe(levels[1][f"{first}1"]))
        .drop(levels[1]["measure"]).join(levels[2], "measure"))
    pick = lambda c: (
        F.when(F.col("total0") >= min_group, F.col(f"{c}0"))
        .when(F.col("total1") >= min_group, F.col(f"{c}1")).otherwise(F.col(f"{c}2")))
    floor, both = F.lit(0), F.lit(False)
    for name, (_, _, least, low) in MEASURES.items():
        floor = F.when(F.col("measure") == name, F.lit(least)).otherwise(floor)
        both = F.when(F.col("measure") == name, F.lit(low)).otherwise(both)
    spread = F.greatest(pick("q75") - pick("q25"), floor)
    return met.select(
        first, second, "measure",
        F.when(both, pick("q25") - reach * spread).alias("low"),
        (pick("q75") + reach * spread).alias("high"))


def judged(
    measured: DataFrame, bounds: DataFrame, groups: tuple[str, str] = ("lang", "source"),
) -> DataFrame:
    """Add `kept` and `outliers` (names of the measures out of bounds) to measured documents."""
    first, second = groups
    wide = bounds.groupBy(F.col(first).alias("_g1"), F.col(second).alias("_g2")).agg(*[
        F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"_{side}_{m}")
        for m in MEASURES for side in ("low", "high")])
    met = measured.join(
        wide, measured[first].eqNullSafe(wide["_g1"]) & measured[second].eqNullSafe(wide["_g2"]),
        "left")
    outliers = F.array_compact(F.array(*[
        F.when((measure(m) < F.col(f"_low_{m}")) | (measure(m) > F.col(f"_high_{m}")), F.lit(m))
        for m in MEASURES]))
    return met.withColumn("outliers", outliers).withColumn(
        "kept", ~F.col("base_failed") & (F.size("outliers") == 0)
    ).drop(*wide.columns)


def quality_rules(
    docs: DataFrame, text_col: str = "text", groups: tuple[str, str] = ("lang", "source"),
    min_group: int = 200, reach: int = 3,
) -> DataFrame:
    """Measure every document, learn the bounds of its language and source, and judge it.

    Adds the base measures, `outliers` and `kept`; an input column of one of these names is
    replaced. Texts are scanned twice, for the sketches and for the result, and shuffled
    never: the bounds have one row per group and measure and are joined by their size.
    Callers that want no texts in the result can store `with_base_measures` instead and
    use it for both.

    NULL and empty texts have no words and fail the base rules; they have no measures and do
    not enter the sketches. A NULL language or source is a group of its own. Rows without
    bounds, in a table without any words, are judged by the base rules alone. Repeated rows
    count as often as they come. An empty table gives an empty table.
    """
    measured = with_base_measures(docs, text_col)
    return judged(measured, adaptive_bounds(measured, groups, min_group, reach), groups)
