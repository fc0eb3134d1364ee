"""Small helpers shared by all operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Unicode White_Space characters. The built-in trim() knows the plain space only.
WHITE_SPACE = "".join(map(chr, [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
    0x205F, 0x3000,
]))


def strip_ws(text: Column) -> Column:
    """`text` without leading and trailing white space of any kind."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def strip_text(text: Column) -> Column:
    """The same as `strip_ws`, faster on longer texts but more generated code.

    btrim() with a character set is an order of magnitude slower than trim(). Here it
    only sees texts that, without their spaces, begin or end with something else than
    printable ASCII.
    """
    bare = F.trim(text)
    last = F.substring(bare, -1, 1)
    # Strings compare by code point.
    plain = (bare >= "!") & (bare < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(plain, bare).otherwise(strip_ws(text))


def is_blank(text: Column) -> Column:
    """NULL and the empty string count the same."""
    return text.isNull() | (text == "")


def map_lookup(key: Column, mapping: Mapping, default) -> Column:
    """Value of `key` in a small fixed map, as a CASE over its distinct values."""
    keys_of: dict = {}
    for k, value in mapping.items():
        keys_of.setdefault(value, []).append(k)
    arms = [(key.isin(keys), F.lit(value)) for value, keys in keys_of.items()]
    first, *rest = arms
    case = reduce(lambda acc, arm: acc.when(*arm), rest, F.when(*first))
    return case.otherwise(F.lit(default))


def bands(value: Column, floors: Sequence[tuple[float, str]], below: str) -> Column:
    """Label of the first floor, highest first, that `value` reaches."""
    first, *rest = floors
    case = reduce(
        lambda acc, floor: acc.when(value >= floor[0], floor[1]),
        rest,
        F.when(value >= first[0], first[1]),
    )
    return case.otherwise(below)


def null_greatest(*columns: Column) -> Column:
    """Greatest of the columns, NULL as soon as one of them is (greatest() skips NULLs)."""
    complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
    return F.when(complete, F.greatest(*columns))


def clamp_signal(value: Column) -> Column:
    """At most 1. NaN stays NaN, whereas least() would prefer the 1."""
    return F.when(F.isnan(value), value).otherwise(F.least(value, F.lit(1.0)))


def make_event_id(*parts: Column | str) -> Column:
    """First 32 hex digits of the SHA-256 of the parts, colon separated.

    Missing parts count as empty, so that they keep their place.
    """
    columns = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit(""))
               for p in parts]
    return F.left(F.sha2(F.concat_ws(":", *columns), 256), F.lit(32))


def as_date(as_of: dt.date | str | None) -> Column:
    """The day a run is for, as a foldable column; today when not given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)
