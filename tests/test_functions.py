"""Column functions on their edges, and against plain statements of the rules."""

import datetime as dt
import email.utils
import hashlib
import itertools
import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from lumentide import functions as L
from lumentide.operators.metrics import synchronicity_band
from lumentide.schemas import SOURCES, TOPIC_CATEGORIES


def column(spark, values, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


@pytest.mark.parametrize("strip", [L.strip_ws, L.strip_text])
def test_stripping(spark, strip):
    texts = {
        " a b ": "a b", "\t\n x\r": "x", "\u2003y\u3000": "y", "\xa0": "", "": "", " ": "",
        " \t z \n ": "z", "é ": "é", "~": "~", "!\x85": "!", "\u2028a": "a", "a\u200b": "a\u200b",
    }
    assert column(spark, [*texts, None], "string", strip) == [*texts.values(), None]


def test_classify_topic(spark):
    titles = {
        "Quantum Physics": "science",
        "Software update": "conflict",          # "war"
        "Spain": "science",                     # "ai"
        "Mental arithmetic": "health",
        "Clean ENERGY market": "environment",   # declared before economics
        "Party": "culture",                     # "art"
        "Inflation": "economics",
        "Nothing to see": "uncategorised",
        "": "uncategorised",
    }
    assert column(spark, list(titles), "string", L.classify_topic) == list(titles.values())


def test_cameo_to_category(spark):
    codes = {"14": "conflict", "1411": "conflict", "20": "conflict", "010": "culture",
             "08": "economics", "10": "health", "05": "science", "04": "uncategorised",
             "1": "uncategorised", "": "uncategorised"}
    assert column(spark, list(codes), "string", L.cameo_to_category) == list(codes.values())


def test_arxiv_to_category(spark):
    names = {"cs.AI": "science", "CS.lg": "science", "q-bio": "health", "q-fin.ST": "economics",
             "econ.GN": "economics", "hep-th": "science", "": "science", "astro-ph.CO": "science"}
    assert column(spark, list(names), "string", L.arxiv_to_category) == list(names.values())


def test_make_event_id(spark):
    got = spark.range(1).select(
        L.make_event_id("gdelt", F.lit(12)), L.make_event_id("w", F.lit(None), F.lit("t"))).first()
    assert got[0] == hashlib.sha256(b"gdelt:12").hexdigest()[:32]
    assert got[1] == hashlib.sha256(b"w::t").hexdigest()[:32]


def level_by_rule(category, source):
    order = ["egocentric", "ethnocentric", "worldcentric", "integral"]
    if not category:
        return order[0]
    ethno, world = {"conflict", "culture"}, {"economics", "health", "environment"}
    height = 1 if category in ethno else 2 if category in world else 3 * (category == "science")
    height += (source == "arxiv") - (source == "gdelt")
    return order[min(max(height, 0), 3)]


def test_consciousness_level_on_all_pairs(spark):
    pairs = list(itertools.product(
        [*TOPIC_CATEGORIES, "Science", "", None], [*SOURCES, "other", "", None]))
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, c string, s string")
    got = df.orderBy("i").select(L.consciousness_level(F.col("c"), F.col("s"))).collect()
    assert [r[0] for r in got] == [level_by_rule(*p) for p in pairs]


def float32(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def test_adjusted_signal_on_all_pairs(spark):
    weight = {"wiki_pageviews": 0.85, "wiki_changes": 1.0, "gdelt": 0.75, "arxiv": 1.1}
    cases = list(itertools.product(
        [0.0, 0.25, 0.6, 1.0, -0.5, None], [*SOURCES, "other", None],
        [*TOPIC_CATEGORIES, "", None]))
    df = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(cases)], "i int, r float, s string, c string")
    got = df.orderBy("i").select(L.adjusted_signal(F.col("r"), F.col("s"), F.col("c"))).collect()
    for (raw, source, category), row in zip(cases, got):
        w = weight.get(source, 1.0)
        w = w * 1.15 if category in ("environment", "health") else w
        assert row[0] == float32(min(float32(raw or 0.0) * w, 1.0)), (raw, source, category)


def test_adjusted_signal_keeps_nan(spark):
    got = spark.range(1).select(L.adjusted_signal(
        F.lit(float("nan")).cast("float"), F.lit("arxiv"), F.lit("science"))).first()[0]
    assert math.isnan(got)


def test_medium_dominance(spark):
    cases = [
        ("institutional_media", 0.6, "media_led"),       # as 32-bit float above 0.6
        ("institutional_media", 0.5, "ambient"),
        ("institutional_media", None, "ambient"),
        ("institutional_media", float("nan"), "ambient"),
        ("formal_knowledge", 0.4, "knowledge_led"),
        ("formal_knowledge", 0.25, "ambient"),
        ("collective_memory", 0.0, "memory_led"),
        ("collective_memory", None, "memory_led"),
        ("billboard", 1.0, "ambient"),
        ("", 1.0, "unknown"),
        (None, 1.0, "unknown"),
    ]
    df = spark.createDataFrame(
        [(i, m, s) for i, (m, s, _) in enumerate(cases)], "i int, m string, s float")
    got = df.orderBy("i").select(L.medium_dominance(F.col("m"), F.col("s"))).collect()
    assert [r[0] for r in got] == [c[2] for c in cases]


def test_synchronicity_band(spark):
    scores = [0.0, 0.1999, 0.2, 0.4999, 0.5, 0.7999, 0.8, 1.0, None]
    assert column(spark, scores, "double", synchronicity_band) == [
        "Fragmented", "Fragmented", "Coherent", "Coherent", "Convergent", "Convergent",
        "Synchronic", "Synchronic", None]


def test_null_greatest(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (1.0, None)], "a double, b double")
    got = df.select(L.null_greatest(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [2.0, None, None]


def strptime_or_none(text):
    try:
        return dt.datetime.strptime(text, "%Y%m%d%H%M%S")
    except ValueError:
        return None


def test_parse_compact_like_strptime(spark):
    rng = random.Random(7)
    texts = ["20240102030405", "20240102", "2024111112", "20241301000000", "20240231000000",
             "202401010000001", "", "soon", "20240101 00000", "20240229235959"]
    texts += ["2024" + "".join(rng.choice("0123") for _ in range(rng.randint(4, 11)))
              for _ in range(400)]
    got = column(spark, texts, "string", L.parse_compact)
    for text, ts in zip(texts, got):
        assert ts == strptime_or_none(text), text


@pytest.mark.parametrize("text", [
    "Tue, 02 Jan 2024 00:00:00 -0500", "Tue, 2 Jan 2024 10:20:30 +0000",
    "02 Jan 2024 10:20:30 GMT", "Wed,  03 Jan 2024 23:59:59 EST",
])
def test_parse_rfc822(spark, text):
    expected = email.utils.parsedate_to_datetime(text).astimezone(dt.timezone.utc)
    assert column(spark, [text], "string", L.parse_rfc822) == [expected.replace(tzinfo=None)]


def test_unreadable_dates_are_null(spark):
    assert column(spark, ["", "yesterday", None, "Tue, 35 Jan 2024 00:00:00 GMT"], "string",
                  L.parse_rfc822) == [None] * 4
    assert column(spark, ["2024", "", None, "2024-13-01"], "string", L.parse_iso) == [None] * 4


def test_parse_iso(spark):
    assert column(spark, ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "2024-01-02"],
                  "string", L.parse_iso) == [
        dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 1, 4, 5),
        dt.datetime(2024, 1, 2)]


def test_iso_utc(spark):
    moments = [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 60)]
    assert column(spark, moments, "timestamp", L.iso_utc) == [
        m.replace(tzinfo=dt.timezone.utc).isoformat() for m in moments]
