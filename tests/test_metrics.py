"""Staging, fact and metrics on hand-computed tables."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from checks import columns, inputs
from lumentide.operators import aggregate, dashboard, fact, metrics, quality, staging
from lumentide.schemas import SOURCES

DAY = dt.date(2024, 1, 10)


def raw(spark, rows):
    """Rows of (source, topic, category, signal, date)."""
    return spark.createDataFrame(
        [(str(i), s, t, c, None if v is None else float(v), d, "m") for i, (s, t, c, v, d)
         in enumerate(rows)],
        "event_id string, source string, topic string, topic_category string, "
        "signal_strength double, event_date date, medium_type string",
    ).withColumns({
        "event_timestamp": F.col("event_date").cast("timestamp"),
        "ingested_at": F.col("event_date").cast("timestamp"),
        "language": F.lit("EN"), "country_code": F.lit(" de "),
    })


def test_staging_bounds(spark):
    rows = [
        ("gdelt", "ab", "x", 0.0, DAY), ("gdelt", " a ", "x", 0.5, DAY),
        ("wiki_changes", "ab", "x", 0.5, DAY), ("wiki_changes", "abc", "x", 1.0, DAY),
        ("arxiv", "abcde", "x", 0.5, DAY), ("arxiv", "abcdef", "x", 0.5, DAY),
        ("arxiv", "[WITHDRAWN] gone", "x", 0.5, DAY), ("arxiv", "[withdrawn] kept", "x", 0.5, DAY),
        ("gdelt", "above", "x", 1.0001, DAY), ("gdelt", "below", "x", -0.0001, DAY),
        ("gdelt", "unknown", "x", None, DAY), ("gdelt", "nan", "x", math.nan, DAY),
        ("gdelt", "tomorrow", "x", 0.5, DAY + dt.timedelta(days=1)),
        ("gdelt", "oldest", "x", 0.5, dt.date(2019, 1, 10)),
        ("gdelt", "too old", "x", 0.5, dt.date(2019, 1, 9)),
        ("gdelt", None, "x", 0.5, DAY), ("other", "long enough", "x", 0.5, DAY),
    ]
    df = raw(spark, rows)
    expected = {"ab", "abc", "abcdef", "[withdrawn] kept", "oldest"}
    assert {r["topic"] for r in staging.stage_all(df, DAY).collect()} == expected
    parts = [f(df, DAY) for f in (staging.stg_wikipedia, staging.stg_gdelt, staging.stg_arxiv)]
    assert {r["topic"] for p in parts for r in p.collect()} == expected


def test_intensity_labels(spark):
    edges = [0.0, 0.3, 0.4, 0.7, 0.8]
    rows = [(s, "a topic", "x", v, DAY) for s in
            ("wiki_changes", "wiki_pageviews", "gdelt", "arxiv") for v in edges]
    got = {(r["source"], r["signal_strength"]): r["attention_intensity"]
           for r in staging.stage_all(raw(spark, rows), DAY).collect()}
    expected = {
        "wiki_changes": ["minor_edit", "moderate_edit", "moderate_edit", "moderate_edit",
                         "major_edit"],
        "wiki_pageviews": ["baseline", "trending", "trending", "viral", "viral"],
        "gdelt": ["low_intensity", "low_intensity", "medium_intensity", "high_intensity",
                  "high_intensity"],
        "arxiv": ["solo_or_small_team", "solo_or_small_team", "standard", "standard",
                  "high_collaboration"],
    }
    assert got == {(s, v): x for s, xs in expected.items() for v, x in zip(edges, xs)}


def test_single_pass_equals_union_of_layers(spark, sf_dir):
    events = inputs.raw_events(spark, sf_dir)
    union = fact.fact_attention_events(*[
        f(events, inputs.AS_OF) for f in
        (staging.stg_wikipedia, staging.stg_gdelt, staging.stg_arxiv)])
    once = fact.fact_from_raw(events, inputs.AS_OF)
    assert union.schema == once.schema
    assert union.exceptAll(once).isEmpty() and once.exceptAll(union).isEmpty()


def test_rollup_serves_all_aggregates(spark, sf_dir):
    events = fact.fact_from_raw(inputs.raw_events(spark, sf_dir), inputs.AS_OF)
    rollup = aggregate.daily_rollup(events)
    for operator in (aggregate.agg_daily_attention, metrics.consciousness_level_daily,
                     lambda d: dashboard.dashboard_tile1(d, inputs.AS_OF)):
        direct, derived = operator(events), operator(rollup)
        assert direct.schema.names == derived.schema.names
        assert direct.exceptAll(derived).isEmpty() and derived.exceptAll(direct).isEmpty()


def test_row_order_does_not_matter(spark, sf_dir):
    events = fact.fact_from_raw(inputs.raw_events(spark, sf_dir), inputs.AS_OF)
    mixed = events.repartition(13, F.hash("event_id")).sortWithinPartitions(F.hash("topic"))
    # Densities have four decimals, their sums differ in the last bits: compare rounded.
    a, b = (columns.present(
        metrics.synchronicity_score(aggregate.agg_daily_attention(e)), columns.SYNC)
        for e in (events, mixed))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def daily(spark, rows):
    """Aggregate rows of (day, category, source, dominance, signal, density)."""
    return spark.createDataFrame(
        [(DAY + dt.timedelta(days=d), c, s, m, 1, float(x), float(n)) for d, c, s, m, x, n in rows],
        "event_date date, topic_category string, source string, medium_dominance string, "
        "event_count bigint, avg_signal_strength double, noospheric_density double")


def test_synchronicity(spark):
    agg = daily(spark, [
        *[(0, "full", s, "m", 1.0, 1) for s in SOURCES],
        (0, "lone", "arxiv", "m", 0.8, 2),
        (0, "max", "gdelt", "ambient", 0.1, 1), (0, "max", "gdelt", "media_led", 0.4, 1),
        *[(0, "edge", s, "m", 0.2, 1) for s in SOURCES],
    ])
    got = {r["topic_category"]: r for r in metrics.synchronicity_score(agg).collect()}
    assert (got["full"]["synchronicity_score"], got["full"]["is_kairos_event"]) == (1.0, True)
    lone = got["lone"]
    assert (lone["active_source_count"], lone["mean_signal"]) == (1, 0.2)
    assert lone["signal_variance"] == pytest.approx(0.12)
    assert lone["synchronicity_score"] == 0.038 and not lone["is_kairos_event"]
    assert got["max"]["gdelt_signal"] == 0.4
    assert got["max"]["total_noospheric_density"] == 2.0
    assert got["edge"]["active_source_count"] == 0 and got["edge"]["synchronicity_score"] == 0.0


def test_shadow(spark):
    agg = daily(spark, [
        (0, "a", "wiki_pageviews", "m", 0.5, 1), (0, "a", "gdelt", "m", 0.2, 1),
        (0, "a", "arxiv", "m", 0.1, 1),
        (0, "b", "wiki_pageviews", "m", 0.4, 1),
        (0, "c", "gdelt", "m", 0.3, 1),
        (0, "d", "wiki_pageviews", "m", 0.0, 1), (0, "d", "gdelt", "m", 0.0, 1),
        (0, "e", "wiki_changes", "m", 0.9, 1),
    ])
    got = {r["topic_category"]: r for r in metrics.shadow_index(agg).collect()}
    assert (got["a"]["shadow_index_raw"], got["a"]["shadow_index_normalised"]) == (0.3, 0.6)
    assert got["a"]["expert_public_gap"] == -0.1
    assert got["a"]["shadow_classification"] == "mildly_repressed"
    assert got["b"]["shadow_index_normalised"] is None
    assert got["b"]["shadow_classification"] == "strongly_repressed"
    assert got["c"]["shadow_classification"] == "strongly_manufactured"
    assert (got["d"]["shadow_index_normalised"], got["d"]["shadow_classification"]) == (
        0.0, "aligned")
    assert got["e"]["shadow_index_raw"] == 0.0 and got["e"]["memory_signal"] == 0.9


@pytest.mark.parametrize("raw_index,name", [
    (0.3001, "strongly_repressed"), (0.3, "mildly_repressed"), (0.1, "aligned"),
    (-0.0999, "aligned"), (-0.1, "mildly_manufactured"), (-0.2999, "mildly_manufactured"),
    (-0.3, "strongly_manufactured"),
])
def test_shadow_classes_cover_the_line(spark, raw_index, name):
    private, public = max(raw_index, 0.0), max(-raw_index, 0.0)
    agg = daily(spark, [(0, "a", "wiki_pageviews", "m", private, 1),
                        (0, "a", "gdelt", "m", public, 1)])
    assert metrics.shadow_index(agg).first()["shadow_classification"] == name


def level_rows(spark, rows):
    return spark.createDataFrame(
        [(DAY + dt.timedelta(days=d), lv, float(s), None) for d, lv, s in rows],
        "event_date date, consciousness_level string, signal_strength double, "
        "attention_intensity string")


def test_levels(spark):
    got = {r["event_date"]: r for r in metrics.consciousness_level_daily(level_rows(spark, [
        (0, "integral", 0.5), (0, "ethnocentric", 0.25), (0, None, 1.0),
        (1, "worldcentric", 0.0), (1, "worldcentric", 0.0), (1, "egocentric", 0.0),
    ])).collect()}
    first, second = got[DAY], got[DAY + dt.timedelta(days=1)]
    assert (first["total_events"], first["dominant_level"]) == (2, "ethnocentric")
    assert (first["pct_integral"], first["signal_pct_integral"]) == (0.5, 0.6667)
    assert first["composite_consciousness_score"] == 3.0
    assert (second["dominant_level"], second["pct_egocentric"]) == ("worldcentric", 0.3333)
    assert second["signal_pct_worldcentric"] is None
    assert second["composite_consciousness_score"] == 2.3333
    assert second["rolling_7d_consciousness_score"] == pytest.approx((3 + 7 / 3) / 2)


def test_shares_and_scores_stay_in_range(spark, sf_dir):
    events = fact.fact_from_raw(inputs.raw_events(spark, sf_dir), inputs.AS_OF)
    for r in metrics.consciousness_level_daily(events).collect():
        for kind in ("pct", "signal_pct"):
            total = sum(r[f"{kind}_{x}"] for x in
                        ("egocentric", "ethnocentric", "worldcentric", "integral"))
            assert total == pytest.approx(1, abs=2e-4)
    scores = metrics.synchronicity_score(aggregate.agg_daily_attention(events))
    assert scores.filter("synchronicity_score < 0 or synchronicity_score > 1").isEmpty()
    shares = dashboard.dashboard_tile1(events, inputs.AS_OF).groupBy("event_date").agg(
        F.sum("pct_of_daily_total").alias("s"), F.count("*").alias("n"))
    assert shares.filter("abs(s - 1) > n * 1e-4").isEmpty()


def test_rolling_windows_count_rows(spark):
    rows = [("gdelt", "a topic", "x", v, DAY - dt.timedelta(days=9 - i)) for i in range(10)
            for v in (0.25, 0.75)]
    agg = aggregate.agg_daily_attention(
        fact.fact_from_raw(raw(spark, rows), DAY)).orderBy("event_date", "medium_dominance")
    got = agg.collect()
    assert len(got) == 20
    assert got[7]["event_count_7d_ago"] == 1 and got[6]["event_count_7d_ago"] is None
    assert got[7]["wow_growth_rate"] == 0.0
    assert got[6]["rolling_7d_signal_strength"] == pytest.approx((4 * 0.25 + 3 * 0.75) / 7)
    assert got[0]["noospheric_density"] == round(0.25 * math.log(2), 4)


def test_null_category_joins_nothing(spark):
    rows = [("gdelt", "a topic", None, 0.5, DAY), ("wiki_pageviews", "a topic", None, 0.5, DAY)]
    events = fact.fact_from_raw(raw(spark, rows), DAY)
    agg = aggregate.agg_daily_attention(events)
    tile = dashboard.dashboard_tile2(
        metrics.synchronicity_score(agg), metrics.shadow_index(agg),
        metrics.consciousness_level_daily(events), agg, DAY).collect()
    assert len(tile) == 1
    assert (tile[0]["event_count"], tile[0]["shadow_index"]) == (0, None)
    assert tile[0]["consciousness_level"] == "worldcentric"


def test_mart_is_sorted(spark, sf_dir):
    events = fact.fact_from_raw(inputs.raw_events(spark, sf_dir), inputs.AS_OF)
    agg = aggregate.agg_daily_attention(events)
    mart = dashboard.mart_dashboard(
        dashboard.dashboard_tile1(events, inputs.AS_OF),
        dashboard.dashboard_tile2(
            metrics.synchronicity_score(agg), metrics.shadow_index(agg),
            metrics.consciousness_level_daily(events), agg, inputs.AS_OF))
    keys = [(-r["event_date"].toordinal(), r["topic_category"] or "") for r in mart.collect()]
    assert keys == sorted(keys) and mart.schema.names == dashboard.MART.names


def test_failed_checks_are_raised(spark):
    found = spark.createDataFrame(
        [(5, 0, 3)], "yesterday_rows int, invalid_sync_scores int, active_categories int")
    with pytest.raises(quality.QualityError, match="active_categories = 3"):
        quality.raise_on_failure(quality.assert_quality(found))
    enough = found.withColumn("active_categories", F.lit(4))
    quality.raise_on_failure(quality.assert_quality(enough))
