"""Schemas that grow: merging, finding and recording them.

A table's folder holds `_schema`, with a file `<number>` (the schema as JSON) for each time it
grew. Columns are added and types widened, never dropped or narrowed, so any file of the
table can be read with the latest schema.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession, types as T

from lumentide.sources.files import Storage

RECORDS = "_schema"

# What Spark's Parquet reader turns into what when it reads with a wider type.
_WIDER = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.DateType: (T.TimestampNTZType,),
}


class IncompatibleSchemas(ValueError):
    """A column has types of which neither can be read as the other."""


def widened(a: T.DataType, b: T.DataType, name: str = "") -> T.DataType:
    """The type both can be read as."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b, f"{name}.")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType, f"{name}[]"))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widened(a.keyType, b.keyType, f"{name}.key"),
                         widened(a.valueType, b.valueType, f"{name}.value"))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    for narrow, wide in ((a, b), (b, a)):
        if type(wide) in _WIDER.get(type(narrow), ()):
            return wide
    both = [w for w in _WIDER.get(type(a), ()) if w in _WIDER.get(type(b), ())]
    if both:  # such as a 32-bit integer and a float: both are read as double
        return both[0]()
    raise IncompatibleSchemas(
        f"column {name or '?'} is {a.simpleString()} and {b.simpleString()}")


def merged(a: T.StructType, b: T.StructType, prefix: str = "") -> T.StructType:
    """The columns of `a` in their order, then those only `b` has, with types widened."""
    theirs = {f.name: f for f in b}
    out = [T.StructField(f.name, widened(f.dataType, theirs[f.name].dataType, prefix + f.name)
                         if f.name in theirs else f.dataType) for f in a]
    known = set(a.fieldNames())
    return T.StructType(out + [T.StructField(f.name, f.dataType) for f in b if f.name not in known])


def found_schema(spark: SparkSession, base: str, paths: Sequence[str]) -> T.StructType:
    """The merged schema of all files below these folders, from their footers.

    Spark merges the footers in a job but refuses columns of different types. Where it
    does, the folders (at last the files of one) are halved until it doesn't, and the halves'
    schemas are widened here: a table whose types changed k times takes some k log n jobs.
    """
    if not paths:
        return T.StructType()
    try:
        return spark.read.option("mergeSchema", True).option("basePath", base).parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
        parts = list(paths) if len(paths) > 1 else list(
            spark.read.option("basePath", base).parquet(*paths).inputFiles())
        if len(parts) == 1:
            raise
        half = len(parts) // 2
        return merged(found_schema(spark, base, parts[:half]),
                      found_schema(spark, base, parts[half:]))


def recorded_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The table's schema as last recorded."""
    storage, folder = Storage(spark, path), f"{path.rstrip('/')}/{RECORDS}"
    records = [e.name for e in storage.entries(folder) if not e.name.startswith(".")]
    if not records:
        return None
    return T.StructType.fromJson(json.loads(storage.read(f"{folder}/{records[-1]}")))


def record_schema(
    spark: SparkSession, path: str, schema: T.StructType, attempts: int = 5,
) -> T.StructType:
    """Add a schema's columns to the table's and return all; a record only if it grew.

    Records are numbered and never replaced: of two writers that grow the table at once one
    finds its number taken and merges again.
    """
    storage, folder = Storage(spark, path), f"{path.rstrip('/')}/{RECORDS}"
    for attempt in range(attempts):
        records = [e.name for e in storage.entries(folder) if not e.name.startswith(".")]
        known = (T.StructType.fromJson(json.loads(storage.read(f"{folder}/{records[-1]}")))
                 if records else T.StructType())
        grown = merged(known, schema)
        if records and grown == known:
            return known
        number = int(records[-1]) + 1 if records else 1
        try:
            storage.write(f"{folder}/{number:08d}", json.dumps(grown.jsonValue()))
            return grown
        except OSError:
            if attempt == attempts - 1:
                raise
    raise AssertionError("unreachable")
