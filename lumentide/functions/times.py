"""Timestamps of the feeds. All functions assume a UTC session and give NULL for bad text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lumentide.functions.common import map_lookup, strip_ws

# Zone names in feed dates and their offsets.
ZONE_OFFSETS = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000", "AST": "-0400", "ADT": "-0300",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700",
    "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}

# year, month, day, hour, minute, second without separators; one-digit fields are
# taken where two digits would be out of range or missing.
COMPACT = (
    r"^([0-9]{4})(1[0-2]|0[1-9]|[1-9])(3[01]|[12][0-9]|0[1-9]|[1-9])"
    r"(2[0-3]|[01][0-9]|[0-9])([0-5][0-9]|[0-9])([0-5][0-9]|[0-9])"
)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text with offset; microseconds only where there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    fine = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(fine)


def parse_compact(text: Column) -> Column:
    """`yyyyMMddHHmmss`; shorter digit runs are split leniently, see COMPACT."""
    def field(i: int) -> Column:
        return F.regexp_extract(text, COMPACT, i).try_cast("int")

    taken = F.length(F.regexp_extract(text, COMPACT, 0))
    lenient = F.try_make_timestamp(
        years=field(1), months=field(2), days=field(3),
        hours=field(4), mins=field(5), secs=field(6))
    full = text.rlike(r"^[0-9]{14}$")
    return (
        F.when(full, F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))
        .when(taken == F.length(text), lenient)
    )


def parse_rfc822(text: Column) -> Column:
    """Feed dates such as `Tue, 02 Jan 2024 00:00:00 -0500`; the weekday is optional."""
    bare = F.regexp_replace(strip_ws(text), r"^[A-Za-z]+,?\s+", "")
    zone = F.upper(F.substring_index(bare, " ", -1))
    offset = map_lookup(zone, ZONE_OFFSETS, None)
    numeric = F.when(
        offset.isNotNull(), F.concat(F.regexp_replace(bare, r"\S+$", ""), offset)
    ).otherwise(bare)
    return F.try_to_timestamp(
        F.regexp_replace(numeric, r"\s+", " "), F.lit("d MMM yyyy HH:mm:ss Z"))


def parse_iso(text: Column) -> Column:
    """ISO-8601 text that carries at least a full date."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))
