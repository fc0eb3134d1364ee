"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lumentide.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Characters between words: space and the controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def with_arrow_columns(
    df: DataFrame, compute: Callable[..., Sequence[pa.Array]], inputs: Sequence[str],
    outputs: Sequence[T.StructField], drop: Sequence[str] = (),
) -> DataFrame:
    """Add columns computed batch by batch in Python; narrow, no shuffle.

    `compute` gets one Arrow array per name in `inputs` and returns one per field in
    `outputs`. An input column of an output's name is replaced, all others are kept.
    """
    at = [df.columns.index(c) for c in inputs]
    gone = {*drop, *(f.name for f in outputs)}
    keep = [i for i, c in enumerate(df.columns) if c not in gone]
    schema = T.StructType([*(df.schema[i] for i in keep), *outputs])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = compute(*(batch.column(i) for i in at))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in keep), *made], names=names)

    return df.mapInArrow(run, schema)


def on_own_columns(
    docs: DataFrame, apply: Callable[[DataFrame], DataFrame], keep: Sequence[str] = ("doc_id", "text"),
    add: Sequence[str] = (),
) -> DataFrame:
    """Apply an operator that adds columns, and return the columns of `docs` and those in `add`.

    Columns other than `keep` are renamed meanwhile, so that none is replaced by what the
    operator adds, whatever their names, but by those in `add`.
    """
    own = [c if c in keep else f"_column_{i}" for i, c in enumerate(docs.columns)]
    made = apply(docs.toDF(*own))
    return made.select(
        *[F.col(o).alias(c) for o, c in zip(own, docs.columns) if c not in add], *add)


def cut_batches(
    batches: Iterator[pa.RecordBatch], text_at: int, size: int = 4 << 20,
) -> Iterator[pa.RecordBatch]:
    """The batches cut to about `size` bytes of text, one text at least, to bound memory."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(text_at)).fill_null(0).to_numpy(zero_copy_only=False)
        at, held = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if i > at and held + n > size:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += n
        if at < batch.num_rows:
            yield batch.slice(at)


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts' bytes; NULL is the empty text."""
    return [b if b is not None else b"" for b in texts.cast(pa.binary()).to_pylist()]


#: Lets a job's shuffle files go when it ends, rather than when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, purpose: str = "stored", path: str | None = None) -> DataFrame:
    """Write `df` to the cluster's shared folder and read it back: cuts the lineage.

    Nothing reads the job's shuffle files again, so they go with it. Whoever gives a `path`
    (see `shared_dir`) can remove it when done.
    """
    spark = df.sparkSession
    path, before = path or shared_dir(spark, purpose), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
