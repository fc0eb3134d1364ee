"""Line deduplication: lines that occur in many documents stay in one of them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from lumentide.llm.common import on_own_columns, utf8, with_arrow_columns, written


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit digest of the stripped, lower-cased line; None if it is too short to count."""
    key = line.strip(b" \t\n\x0b\x0c\r").lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def _line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per document and distinct line key in it."""
    source = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    schema = T.StructType([
        T.StructField("_doc", source.schema["_doc"].dataType),
        T.StructField("_key", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys = [], []
            for row, text in enumerate(utf8(batch.column(1))):
                if len(text) >= min_chars:
                    own = {line_key(line, min_chars) for line in text.split(b"\n")} - {None}
                    rows += [row] * len(own)
                    keys += own
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(keys, pa.binary())],
                names=["_doc", "_key"])

    return source.mapInArrow(run, schema)


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_chars: int = 40, min_docs: int = 5,
) -> DataFrame:
    """Drop every line found in at least `min_docs` documents but in the largest one holding it.

    Adds `n_lines` (before dropping), `n_dropped` and `kept_text`; an input column of
    one of these names is replaced. A line is compared by its key, stripped of white
    space at both ends and with A-Z lower-cased; keys under `min_chars` code points stay.

    Only 16-byte digests of the lines are shuffled for counting. A document counts once
    for a key whatever the number of copies in it, and counting is in two levels (key and
    document, then key) with partial sums before each shuffle, so a line in a third of all
    documents is spread over all tasks. The texts move once, to meet the keys they lose.

    NULL and empty texts are one empty line. Rows of the same id are one document:
    they count once, and all of them keep a line whose largest document they are. A
    NULL id is one document and the smallest. An empty table gives an empty table.
    """
    return on_own_columns(
        docs, lambda own: _without_lines(own, id_col, text_col, min_chars, min_docs),
        keep=(id_col, text_col), add=("n_lines", "n_dropped", "kept_text"))


def _without_lines(
    docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int,
) -> DataFrame:
    keys = _line_keys(docs, id_col, text_col, min_chars)
    # Stored before it meets the keys: Spark then knows its size, broadcasts it if it is
    # small and else splits a hot line over tasks. A join with an aggregate on its own key
    # would not be split.
    hot = written(
        keys.groupBy("_key", "_doc").agg(F.lit(1).alias("_one"))
        .groupBy("_key").agg(F.count("*").alias("_docs"), F.max("_doc").alias("_last"))
        .filter(F.col("_docs") >= min_docs).drop("_docs"), "hot-lines")
    lost = (
        keys.join(hot, "_key").filter(~F.col("_doc").eqNullSafe(F.col("_last")))
        .groupBy("_doc").agg(F.collect_set("_key").alias("_lost")))
    met = docs.join(lost, docs[id_col].eqNullSafe(lost["_doc"]), "left").drop("_doc")

    def rebuilt(texts: pa.Array, drops: pa.Array) -> list[pa.Array]:
        n_lines, n_dropped, kept_texts = [], [], []
        for text, drop in zip(utf8(texts), drops.to_pylist()):
            lines = text.split(b"\n")
            n_lines.append(len(lines))
            if drop:
                drop = set(drop)
                lines = [x for x in lines if line_key(x, min_chars) not in drop]
                text = b"\n".join(lines)
            n_dropped.append(n_lines[-1] - len(lines))
            kept_texts.append(text)
        return [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                pa.array(kept_texts, pa.binary()).cast(pa.string())]

    return with_arrow_columns(
        met, rebuilt, [text_col, "_lost"],
        [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
         T.StructField("kept_text", T.StringType())], drop=["_lost"])
