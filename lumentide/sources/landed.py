"""Readers of landed raw files, each with a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lumentide.schemas import ARXIV_ENTRY, LAKE_EVENTS, PAGEVIEW, WIKI_CHANGE

#: File streams leave out files a week older than the newest they have seen, unless told
#: otherwise: after a move that keeps times that would lose rows without a word.
ALL_AGES = "36500d"


def _reader(spark: SparkSession, stream: bool, max_files: int | None = None):
    """Reader of files as a table, or as a stream of files of any age."""
    if not stream:
        return spark.read
    reader = spark.readStream.option("maxFileAge", ALL_AGES)
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def read_wiki_changes(
    spark: SparkSession, path: str, stream: bool = False, max_files: int | None = None,
) -> DataFrame:
    """Change records, one JSON object per line, with the line itself as `record`.

    A line that is no JSON object has no namespace and is dropped downstream. With
    `stream`, here and below, the files that land are read as a stream, at most
    `max_files` in a micro-batch.
    """
    lines = _reader(spark, stream, max_files).text(path)
    return (
        lines.withColumn("_change", F.from_json("value", WIKI_CHANGE))
        .select("_change.*", F.col("value").alias("record"))
    )


def read_wiki_pageviews(
    spark: SparkSession, path: str, stream: bool = False, max_files: int | None = None,
) -> DataFrame:
    """Most-read lists, one JSON object per article and hour; `rank` is the list position."""
    return _reader(spark, stream, max_files).schema(PAGEVIEW).option(
        "mode", "DROPMALFORMED").json(path)


def read_gdelt_exports(
    spark: SparkSession, path: str, stream: bool = False, max_files: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Export records, tab separated.

    A record is a line. With `multi_line` a quoted field may hold line breaks; a file is
    then read by one task, since only from its beginning can be told which breaks end a
    record. Exports come in files of a quarter of an hour, so files are the unit of work.
    Records are the same text as in the file, quotes included.
    """
    reader = _reader(spark, stream, max_files)
    if not multi_line:
        return reader.text(path).withColumnRenamed("value", "line")
    whole = reader.text(path, wholetext=True)
    return whole.select(F.explode(_records(F.col("value"))).alias("line"))


def _records(text: Column) -> Column:
    """Records of a tab-separated text, by the breaks that are outside of quotes.

    A field is quoted if its first character is a quote; a quote inside is doubled. What
    follows a closing quote up to the next tab or break belongs to the field, as does a quote
    inside a field that doesn't begin with one. A quote that is never closed opens nothing.
    """
    field = r'(?:"[^"]*+(?:""[^"]*+)*+"[^\t\r\n]*+|[^\t\r\n]*+)'
    record = rf"(?:^|(?<=\n)|(?<=\r)(?!\n))({field}(?:\t{field})*+)(?=\r|\n|\z)"
    return F.filter(F.regexp_extract_all(text, F.lit(record), 1), lambda line: line != "")


def read_arxiv_entries(
    spark: SparkSession, path: str, stream: bool = False, max_files: int | None = None,
) -> DataFrame:
    """Feed entries, one JSON object per line."""
    return _reader(spark, stream, max_files).schema(ARXIV_ENTRY).option(
        "mode", "DROPMALFORMED").json(path)


def read_lake(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Lake files of the stream.

    By default the known schema is imposed, so that no file footers are read for
    planning and columns older files lack are NULL. `merge_schema` instead finds
    columns nobody declared, at the price of reading all footers.
    """
    if merge_schema:
        return spark.read.option("mergeSchema", True).parquet(path)
    return spark.read.schema(LAKE_EVENTS).parquet(path).select(*LAKE_EVENTS.fieldNames())
