"""The registered queries as DuckDB SQL over the given tables.

Views are common table expressions; `_query` strings together those a result needs.
"""

from __future__ import annotations

import re

from checks import columns
from checks.inputs import AS_OF, INGEST_TIME, QUALITY_DAY
from lumentide.schemas import ARXIV_CATEGORY, CAMEO_CATEGORY, TOPIC_KEYWORDS

BLANKS = "E' \\t\\n\\r'"
INGESTED = f"TIMESTAMP '{INGEST_TIME:%Y-%m-%d %H:%M:%S}'"


def _topic_of(title: str) -> str:
    arms = " ".join(
        f"WHEN regexp_matches(lower({title}), '{'|'.join(words)}') THEN '{category}'"
        for category, words in TOPIC_KEYWORDS.items())
    return f"CASE {arms} ELSE 'uncategorised' END"


def _mapped(key: str, mapping: dict[str, str], default: str) -> str:
    pairs = ", ".join(f"'{k}': '{v}'" for k, v in mapping.items())
    return f"coalesce(map_extract_value(MAP {{{pairs}}}, {key}), '{default}')"


VIEWS = {}

# --- inputs -----------------------------------------------------------------

VIEWS["raw_events"] = """
SELECT CAST(event_id AS VARCHAR) AS event_id,
  CASE event_type WHEN 'view' THEN 'wiki_pageviews' WHEN 'click' THEN 'wiki_changes'
    WHEN 'error' THEN 'gdelt' WHEN 'purchase' THEN 'arxiv' ELSE 'other' END AS source,
  ts AS event_timestamp, CAST(ts AS DATE) AS event_date,
  CASE event_id % 50 WHEN 0 THEN NULL WHEN 1 THEN E'\\t ab\\n'
    WHEN 2 THEN '[WITHDRAWN] paper ' || event_id ELSE ' Topic ' || event_id || ' ' END AS topic,
  CASE user_id % 8 WHEN 0 THEN 'science' WHEN 1 THEN 'conflict' WHEN 2 THEN ' Health '
    WHEN 3 THEN 'environment' WHEN 4 THEN 'CULTURE' WHEN 5 THEN 'economics'
    WHEN 6 THEN 'uncategorised' END AS topic_category,
  ' EN ' AS language,
  CASE user_id % 3 WHEN 0 THEN E' us\\t' WHEN 1 THEN 'fr' END AS country_code,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 1 + value
    ELSE floor(least(value / 50, 1) * 1024) / 1024 END AS signal_strength,
  CASE event_type WHEN 'view' THEN ' Collective_Memory ' WHEN 'click' THEN 'collective_memory'
    WHEN 'error' THEN 'institutional_media' WHEN 'purchase' THEN 'formal_knowledge'
    END AS medium_type,
  ts + INTERVAL 60 SECOND AS ingested_at
FROM events
"""

VIEWS["message_fields"] = """
SELECT CASE WHEN NOT broken THEN event_id END AS event_id,
  CASE WHEN NOT broken AND NOT (odd AND flaw = 1) THEN source END AS source,
  CASE WHEN NOT broken AND NOT (odd AND flaw = 2) THEN event_timestamp END AS event_timestamp,
  CASE WHEN NOT broken THEN topic END AS topic,
  CASE WHEN odd AND flaw = 3 THEN '' WHEN NOT broken THEN topic_category END AS topic_category,
  CASE WHEN NOT broken THEN language END AS language,
  CASE WHEN NOT broken THEN country_code END AS country_code,
  CASE WHEN NOT broken THEN CAST(CAST(signal_strength AS FLOAT) AS DOUBLE) END AS signal_strength,
  CASE WHEN odd AND flaw = 4 THEN '' WHEN NOT broken THEN medium_type END AS medium_type,
  CASE source WHEN 'gdelt' THEN 'gdelt_events' WHEN 'arxiv' THEN 'arxiv_papers'
    ELSE source END AS kafka_topic,
  odd, flaw, broken
FROM (SELECT *, source = 'other' AS odd, CAST(event_id AS BIGINT) % 5 AS flaw,
        source = 'other' AND CAST(event_id AS BIGINT) % 5 = 0 AS broken FROM raw_events)
"""

VIEWS["delivered_once"] = """
SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 101 <> 0 THEN event_id END AS event_id)
FROM raw_events
UNION ALL
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS event_id, ingested_at + INTERVAL 1 HOUR AS ingested_at)
FROM raw_events WHERE source = 'wiki_pageviews' AND CAST(event_id AS BIGINT) % 101 = 0
"""

# --- stream enrichment ------------------------------------------------------

VIEWS["leveled"] = """
SELECT *, CAST(event_timestamp AS DATE) AS event_date,
  CASE WHEN coalesce(topic_category, '') = '' THEN 'egocentric' ELSE
    list_extract(['egocentric', 'ethnocentric', 'worldcentric', 'integral'], 1 + CAST(
      list_max([0, list_min([3,
        CASE WHEN topic_category IN ('conflict', 'culture') THEN 1
             WHEN topic_category IN ('economics', 'environment', 'health') THEN 2
             WHEN topic_category = 'science' THEN 3 ELSE 0 END
        + CASE WHEN source = 'arxiv' THEN 1 WHEN source = 'gdelt' THEN -1 ELSE 0 END])])
      AS INTEGER)) END AS consciousness_level
FROM message_fields
"""

VIEWS["dominated"] = """
SELECT *, CASE
    WHEN coalesce(medium_type, '') = '' THEN 'unknown'
    WHEN medium_type = 'collective_memory' THEN 'memory_led'
    WHEN medium_type = 'institutional_media' AND signal_strength > 0.6 THEN 'media_led'
    WHEN medium_type = 'formal_knowledge' AND signal_strength > 0.4 THEN 'knowledge_led'
    ELSE 'ambient' END AS medium_dominance
FROM leveled
"""

VIEWS["enriched"] = """
SELECT * REPLACE (CAST(CAST(least(coalesce(signal_strength, 0) * weight, 1) AS FLOAT) AS DOUBLE)
                  AS signal_strength)
FROM (SELECT *, CASE source WHEN 'wiki_pageviews' THEN CAST(0.85 AS DOUBLE)
          WHEN 'gdelt' THEN CAST(0.75 AS DOUBLE) WHEN 'arxiv' THEN CAST(1.1 AS DOUBLE)
          ELSE CAST(1 AS DOUBLE) END
        * CASE WHEN topic_category IN ('environment', 'health') THEN CAST(1.15 AS DOUBLE)
          ELSE CAST(1 AS DOUBLE) END AS weight
      FROM dominated)
"""

# --- staging, fact, aggregate -----------------------------------------------

VIEWS["valid"] = f"""
SELECT event_id, source, event_timestamp, event_date, trim(topic, {BLANKS}) AS topic,
  lower(trim(topic_category, {BLANKS})) AS topic_category,
  lower(trim(language, {BLANKS})) AS language,
  upper(trim(country_code, {BLANKS})) AS country_code,
  signal_strength, medium_type, ingested_at
FROM raw_events
WHERE signal_strength >= 0 AND signal_strength <= 1
  AND event_date >= DATE '{AS_OF}' - INTERVAL 5 YEAR AND event_date <= DATE '{AS_OF}'
"""

VIEWS["staged_wikipedia"] = f"""
SELECT * REPLACE (lower(trim(medium_type, {BLANKS})) AS medium_type),
  CASE source || CASE WHEN signal_strength >= 0.8 THEN ' 8' WHEN signal_strength >= 0.7 THEN ' 7'
                      WHEN signal_strength >= 0.3 THEN ' 3' ELSE ' 0' END
    WHEN 'wiki_changes 8' THEN 'major_edit' WHEN 'wiki_changes 7' THEN 'moderate_edit'
    WHEN 'wiki_changes 3' THEN 'moderate_edit' WHEN 'wiki_changes 0' THEN 'minor_edit'
    WHEN 'wiki_pageviews 8' THEN 'viral' WHEN 'wiki_pageviews 7' THEN 'viral'
    WHEN 'wiki_pageviews 3' THEN 'trending' ELSE 'baseline' END AS attention_intensity
FROM valid WHERE source LIKE 'wiki%' AND length(topic) > 2
"""

VIEWS["staged_gdelt"] = """
SELECT * REPLACE ('en' AS language),
  CASE WHEN signal_strength < 0.4 THEN 'low_intensity' WHEN signal_strength < 0.7
    THEN 'medium_intensity' ELSE 'high_intensity' END AS attention_intensity
FROM valid WHERE source = 'gdelt' AND length(topic) > 1
"""

VIEWS["staged_arxiv"] = """
SELECT * REPLACE ('en' AS language, CAST(NULL AS VARCHAR) AS country_code),
  CASE WHEN signal_strength < 0.4 THEN 'solo_or_small_team' WHEN signal_strength < 0.8
    THEN 'standard' ELSE 'high_collaboration' END AS attention_intensity
FROM valid
WHERE source = 'arxiv' AND length(topic) > 5 AND NOT starts_with(topic, '[WITHDRAWN]')
"""

VIEWS["fact"] = """
SELECT *, 'worldcentric' AS consciousness_level,
  if(signal_strength < 0.5, 'ambient', 'memory_led') AS medium_dominance FROM staged_wikipedia
UNION ALL
SELECT *, if(coalesce(topic_category, '') = 'conflict', 'ethnocentric', 'worldcentric'),
  if(signal_strength < 0.6, 'ambient', 'media_led') FROM staged_gdelt
UNION ALL
SELECT *, 'integral', 'knowledge_led' FROM staged_arxiv
"""

VIEWS["rollup"] = """
SELECT event_date, topic_category, source, medium_dominance, consciousness_level,
  count(*) AS event_count, count(signal_strength) AS signal_count,
  sum(signal_strength) AS total_signal_mass, max(signal_strength) AS peak_signal_strength,
  count(*) FILTER (WHERE attention_intensity IN
    ('high_collaboration', 'high_intensity', 'major_edit', 'viral')) AS high_intensity_count
FROM fact GROUP BY ALL
"""

VIEWS["groups"] = """
SELECT event_date, topic_category, source, medium_dominance, count(*) AS event_count,
  avg(signal_strength) AS avg_signal_strength, max(signal_strength) AS peak_signal_strength,
  sum(signal_strength) AS total_signal_mass,
  count(*) FILTER (WHERE attention_intensity IN
    ('high_collaboration', 'high_intensity', 'major_edit', 'viral')) AS high_intensity_count
FROM fact GROUP BY ALL
"""

VIEWS["agg"] = """
SELECT *, (event_count - event_count_7d_ago) / nullif(event_count_7d_ago, 0) AS wow_growth_rate,
  round(total_signal_mass * ln(1 + event_count), 4) AS noospheric_density
FROM (
  SELECT *, avg(event_count) OVER week AS rolling_7d_event_count,
    avg(avg_signal_strength) OVER week AS rolling_7d_signal_strength,
    CAST(lag(event_count, 7) OVER line AS DOUBLE) AS event_count_7d_ago
  FROM groups
  WINDOW line AS (PARTITION BY topic_category, source ORDER BY event_date, medium_dominance),
    week AS (PARTITION BY topic_category, source ORDER BY event_date, medium_dominance
             ROWS 6 PRECEDING))
"""

# --- metrics ----------------------------------------------------------------

VIEWS["signals"] = """
SELECT event_date, topic_category,
  max(avg_signal_strength) FILTER (WHERE source = 'wiki_pageviews') AS wiki_pv_signal,
  max(avg_signal_strength) FILTER (WHERE source = 'wiki_changes') AS wiki_ch_signal,
  max(avg_signal_strength) FILTER (WHERE source = 'gdelt') AS gdelt_signal,
  max(avg_signal_strength) FILTER (WHERE source = 'arxiv') AS arxiv_signal,
  sum(noospheric_density) AS total_noospheric_density
FROM agg GROUP BY event_date, topic_category
"""

VIEWS["sync"] = """
SELECT *, synchronicity_score >= 0.8 AS is_kairos_event,
  avg(synchronicity_score) OVER (PARTITION BY topic_category ORDER BY event_date
                                 ROWS 6 PRECEDING) AS rolling_7d_synchronicity
FROM (
  SELECT *, round(least(mean_signal * active_source_count / 4.0
                        * (1 - least(2 * signal_variance, 1)), 1), 4) AS synchronicity_score
  FROM (
    SELECT *, ((a - mean_signal) * (a - mean_signal) + (b - mean_signal) * (b - mean_signal)
      + (c - mean_signal) * (c - mean_signal) + (d - mean_signal) * (d - mean_signal)) / 4
      AS signal_variance
    FROM (
      SELECT *, (a + b + c + d) / 4 AS mean_signal,
        len(list_filter([a, b, c, d], lambda x: x > 0.2)) AS active_source_count
      FROM (SELECT *, coalesce(wiki_pv_signal, 0) AS a, coalesce(wiki_ch_signal, 0) AS b,
              coalesce(gdelt_signal, 0) AS c, coalesce(arxiv_signal, 0) AS d FROM signals))))
"""

VIEWS["shadow"] = """
SELECT *,
  round(shadow_index_raw / CASE WHEN private_signal IS NOT NULL AND public_signal IS NOT NULL
    THEN greatest(private_signal, public_signal, 0.001) END, 4) AS shadow_index_normalised,
  CASE WHEN shadow_index_raw <= -0.3 THEN 'strongly_manufactured'
    WHEN shadow_index_raw <= -0.1 THEN 'mildly_manufactured'
    WHEN shadow_index_raw <= 0.1 THEN 'aligned'
    WHEN shadow_index_raw <= 0.3 THEN 'mildly_repressed' ELSE 'strongly_repressed'
    END AS shadow_classification,
  avg(shadow_index_raw) OVER (PARTITION BY topic_category ORDER BY event_date
                              ROWS 29 PRECEDING) AS rolling_30d_shadow_index
FROM (
  SELECT event_date, topic_category, wiki_pv_signal AS private_signal,
    gdelt_signal AS public_signal, arxiv_signal AS expert_signal,
    wiki_ch_signal AS memory_signal,
    round(coalesce(wiki_pv_signal, 0) - coalesce(gdelt_signal, 0), 4) AS shadow_index_raw,
    round(coalesce(arxiv_signal, 0) - coalesce(gdelt_signal, 0), 4) AS expert_public_gap
  FROM signals)
"""

VIEWS["level"] = """
SELECT event_date, total_events, total_signal_mass,
  round(n1 / total_events, 4) AS pct_egocentric, round(n2 / total_events, 4) AS pct_ethnocentric,
  round(n3 / total_events, 4) AS pct_worldcentric, round(n4 / total_events, 4) AS pct_integral,
  round(coalesce(s1, 0) / nullif(total_signal_mass, 0), 4) AS signal_pct_egocentric,
  round(coalesce(s2, 0) / nullif(total_signal_mass, 0), 4) AS signal_pct_ethnocentric,
  round(coalesce(s3, 0) / nullif(total_signal_mass, 0), 4) AS signal_pct_worldcentric,
  round(coalesce(s4, 0) / nullif(total_signal_mass, 0), 4) AS signal_pct_integral,
  round(altitude, 4) AS composite_consciousness_score,
  list_extract(['egocentric', 'ethnocentric', 'worldcentric', 'integral'],
    list_position([n1, n2, n3, n4], list_max([n1, n2, n3, n4]))) AS dominant_level,
  avg(altitude) OVER (ORDER BY event_date ROWS 6 PRECEDING) AS rolling_7d_consciousness_score
FROM (
  SELECT *, (n1 + 2 * n2 + 3 * n3 + 4 * n4) / total_events AS altitude
  FROM (
    SELECT event_date, count(*) AS total_events, sum(signal_strength) AS total_signal_mass,
      count_if(consciousness_level = 'egocentric') AS n1,
      count_if(consciousness_level = 'ethnocentric') AS n2,
      count_if(consciousness_level = 'worldcentric') AS n3,
      count_if(consciousness_level = 'integral') AS n4,
      sum(signal_strength) FILTER (WHERE consciousness_level = 'egocentric') AS s1,
      sum(signal_strength) FILTER (WHERE consciousness_level = 'ethnocentric') AS s2,
      sum(signal_strength) FILTER (WHERE consciousness_level = 'worldcentric') AS s3,
      sum(signal_strength) FILTER (WHERE consciousness_level = 'integral') AS s4
    FROM fact WHERE consciousness_level IS NOT NULL GROUP BY event_date))
"""

# --- dashboard --------------------------------------------------------------


def _dashboard(day: str, suffix: str) -> None:
    VIEWS[f"tile1{suffix}"] = f"""
SELECT event_date, topic_category, medium_dominance, consciousness_level,
  count(*) AS event_count, sum(signal_strength) AS total_signal,
  avg(signal_strength) AS avg_signal,
  round(count(*) / sum(count(*)) OVER (PARTITION BY event_date), 4) AS pct_of_daily_total,
  'categorical' AS tile_type
FROM fact WHERE event_date >= DATE '{day}' - INTERVAL 30 DAY
GROUP BY event_date, topic_category, medium_dominance, consciousness_level
"""
    VIEWS[f"tile2{suffix}"] = f"""
WITH volume AS (
  SELECT event_date AS on_day, topic_category AS about, sum(event_count) AS events
  FROM agg WHERE topic_category IS NOT NULL GROUP BY ALL),
gap AS (
  SELECT event_date AS on_day, topic_category AS about, shadow_index_raw, shadow_classification
  FROM shadow WHERE topic_category IS NOT NULL),
mood AS (SELECT event_date AS on_day, dominant_level FROM level)
SELECT event_date, topic_category, CAST(NULL AS VARCHAR) AS medium_dominance,
  dominant_level AS consciousness_level, coalesce(events, 0) AS event_count,
  synchronicity_score AS total_signal, rolling_7d_synchronicity AS avg_signal,
  shadow_index_raw AS shadow_index, shadow_classification, is_kairos_event,
  CASE WHEN is_kairos_event THEN '⚡ Kairos: ' || nullif(topic_category, '') END
    AS kairos_label,
  CAST(NULL AS DOUBLE) AS pct_of_daily_total, 'temporal' AS tile_type
FROM (FROM sync WHERE event_date >= DATE '{day}' - INTERVAL 90 DAY) AS recent
LEFT JOIN volume ON (volume.on_day, volume.about) = (event_date, topic_category)
LEFT JOIN gap ON (gap.on_day, gap.about) = (event_date, topic_category)
LEFT JOIN mood ON mood.on_day = event_date
"""
    VIEWS[f"mart{suffix}"] = f"""
SELECT event_date, topic_category, medium_dominance, consciousness_level, event_count,
  total_signal, avg_signal, CAST(NULL AS DOUBLE) AS shadow_index,
  CAST(NULL AS VARCHAR) AS shadow_classification, FALSE AS is_kairos_event,
  CAST(NULL AS VARCHAR) AS kairos_label, pct_of_daily_total, tile_type FROM tile1{suffix}
UNION ALL
SELECT event_date, topic_category, medium_dominance, consciousness_level, event_count,
  total_signal, avg_signal, shadow_index, shadow_classification, is_kairos_event, kairos_label,
  pct_of_daily_total, tile_type FROM tile2{suffix}
"""
    VIEWS[f"quality{suffix}"] = f"""
SELECT count(*) FILTER (WHERE event_date = DATE '{day}' - INTERVAL 1 DAY) AS yesterday_rows,
  count(*) FILTER (WHERE total_signal > 1 AND tile_type = 'temporal') AS invalid_sync_scores,
  count(DISTINCT topic_category) AS active_categories
FROM mart{suffix} WHERE event_date >= DATE '{day}' - INTERVAL 7 DAY
"""


_dashboard(AS_OF, "")
_dashboard(QUALITY_DAY, "_early")

# --- normalisers ------------------------------------------------------------

VIEWS["edits"] = f"""
SELECT left(sha256('wiki_changes:' || revision || ':' || strftime(moment, '%Y-%m-%dT%H:%M:%S')
                   || '+00:00'), 32) AS event_id,
  'wiki_changes' AS source, moment AS event_timestamp, CAST(moment AS DATE) AS event_date,
  title AS topic, {_topic_of('title')} AS topic_category,
  CASE WHEN lang IN ('en', 'fr') THEN lang ELSE 'en' END AS language,
  CAST(NULL AS VARCHAR) AS country_code,
  least(abs(CASE source WHEN 'src13' THEN 0 ELSE n_chars END
            - CASE source WHEN 'src12' THEN 0 ELSE doc_id % 7 * 1000 END) / 10000, 1)
    AS signal_strength,
  'collective_memory' AS medium_type, {INGESTED} AS ingested_at,
  title AS sent_title, nullif(revision, '') AS sent_revision,
  CASE source WHEN 'src13' THEN NULL ELSE n_chars END AS sent_length,
  CASE source WHEN 'src15' THEN NULL ELSE 1704067200 + doc_id * 60 END AS sent_timestamp
FROM (
  SELECT *, ['science', 'WAR of', 'Health', 'climate', 'history', 'trade', 'software', 'Spain',
             'mental', 'energy', 'quiet', 'Election'][doc_id % 12 + 1]
            || ' ' || lang || ' ' || doc_id AS title,
    TIMESTAMP '1970-01-01' + to_seconds(CASE source WHEN 'src15' THEN 0
                                        ELSE 1704067200 + doc_id * 60 END) AS moment,
    CASE source WHEN 'src14' THEN '' ELSE CAST(doc_id * 7 + 1 AS VARCHAR) END AS revision
  FROM documents WHERE source NOT IN ('src17', 'src18', 'src19'))
"""

_VIEWS = f"""
SELECT left(sha256('wiki_pageviews:' || title || ':' || strftime(hour, '%Y-%m-%dT%H:%M:%S')
                   || '+00:00'), 32) AS event_id,
  'wiki_pageviews' AS source, hour AS event_timestamp, CAST(hour AS DATE) AS event_date,
  title AS topic, {_topic_of('title')} AS topic_category, 'en' AS language,
  CAST(NULL AS VARCHAR) AS country_code,
  least(length(html) * (page_id % 500) / 1000000, 1) AS signal_strength,
  'collective_memory' AS medium_type, {INGESTED} AS ingested_at,
  to_json({{'article': replace(regexp_extract(html, '<title>([^<]*)</title>', 1), ' ', '_'),
           'views': length(html) * (page_id % 500), 'rank': 240 - page_id % 240}}) AS raw_payload
FROM (
  SELECT page_id, html,
    replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '_', ' ') AS title,
    TIMESTAMP '2024-01-01' + to_hours(CAST(page_id // 240 AS INTEGER)) AS hour
  FROM pages
"""
VIEWS["views"] = _VIEWS + ")"
VIEWS["views_top"] = _VIEWS + """
  QUALIFY row_number() OVER (PARTITION BY page_id // 240 ORDER BY page_id DESC) <= 200)
"""

VIEWS["export_fields"] = """
SELECT CAST(event_id AS VARCHAR) AS id,
  CASE user_id % 10 WHEN 0 THEN strftime(ts, '%Y%m%d') WHEN 1 THEN 'soon'
    ELSE strftime(ts, '%Y%m%d%H%M%S') END AS date,
  CASE WHEN user_id % 10 > 1 THEN date_trunc('second', ts) END AS moment,
  CASE event_type WHEN 'view' THEN '' ELSE 'ACTOR ' || user_id END AS actor1,
  CASE WHEN event_type = 'view' AND user_id % 2 = 1 THEN '' ELSE 'PARTNER ' || user_id END
    AS actor2,
  ['14', '180', '0190', '20', '010', '02', '036', '07', '08', '10', '051', '04', '1',
   ''][user_id % 14 + 1] AS code,
  CAST(event_id % 40 AS VARCHAR) AS articles,
  CASE WHEN value < 1 THEN 'n/a' ELSE CAST(CAST(100 - value AS DECIMAL(9, 2)) AS VARCHAR) END
    AS tone,
  ['USA', 'FR', 'D', ''][user_id % 4 + 1] AS country
FROM events WHERE NOT (event_type = 'signup' AND value > 100)
"""

_GDELT = f"""
  {_mapped("left(code, 2)", CAMEO_CATEGORY, 'uncategorised')} AS topic_category,
  'en' AS language, nullif(left(country, 2), '') AS country_code,
  least(abs(coalesce(TRY_CAST(tone AS DOUBLE), 0)) / 100, 1) AS signal_strength,
  'institutional_media' AS medium_type, {INGESTED} AS ingested_at
"""

VIEWS["news_live"] = f"""
SELECT left(sha256('gdelt:' || id), 32) AS event_id, 'gdelt' AS source,
  coalesce(moment, {INGESTED}) AS event_timestamp,
  CAST(coalesce(moment, {INGESTED}) AS DATE) AS event_date,
  coalesce(nullif(actor1, ''), nullif(actor2, ''), 'Unknown') AS topic, {_GDELT},
  to_json({{'id': id, 'date': date, 'code': code, 'actor1': actor1, 'actor2': actor2,
           'country': country, 'tone': tone, 'articles': articles}}) AS raw_payload
FROM export_fields
"""

VIEWS["news_backfill"] = f"""
SELECT left(sha256('gdelt:' || id || ':' || strftime(moment, '%Y-%m-%dT%H:%M:%S') || '+00:00'),
            32) AS event_id, 'gdelt' AS source,
  moment AS event_timestamp, CAST(moment AS DATE) AS event_date,
  coalesce(nullif(actor1, ''), 'Unknown') AS topic, {_GDELT},
  to_json({{'raw_id': id, 'code': code}}) AS raw_payload
FROM export_fields WHERE moment IS NOT NULL
"""

VIEWS["entries"] = """
SELECT *, TIMESTAMP '2024-01-01' + to_seconds(doc_id * 3600) AS moment,
  CASE WHEN source IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6') THEN 'cs.AI'
    WHEN source IN ('src7', 'src8') THEN 'physics' WHEN source IN ('src9', 'src10') THEN 'q-bio.NC'
    WHEN source IN ('src11', 'src12') THEN 'q-fin.ST' WHEN source = 'src13' THEN 'econ.GN'
    WHEN source = 'src14' THEN 'Stat.ML' ELSE 'hep-th' END AS category,
  CAST([('Author ' || i) FOR i IN range(1, doc_id % 25 + 1)] AS VARCHAR[]) AS authors
FROM documents
"""

_ARXIV = f"""
  {_mapped("lower(split_part(category, '.', 1))", ARXIV_CATEGORY, 'science')} AS topic_category,
  'en' AS language, CAST(NULL AS VARCHAR) AS country_code,
  least(greatest(doc_id % 25, 1) / 20, 1) AS signal_strength,
  'formal_knowledge' AS medium_type, {INGESTED} AS ingested_at
"""

def _papers_feed(authors: str, summary: str, chosen: str) -> str:
    return f"""
SELECT left(sha256('arxiv:' || paper), 32) AS event_id, 'arxiv' AS source,
  published AS event_timestamp, CAST(published AS DATE) AS event_date,
  'On ' || lang || chr(10) || source || ' ' || doc_id AS topic, {_ARXIV},
  to_json({{'arxiv_id': paper, 'category': category, 'authors': {authors},
           'summary': {summary}}}) AS raw_payload
FROM (
  SELECT *, 'http://arxiv.org/abs/' || doc_id || 'v1' AS paper,
    CASE WHEN source IN ('src15', 'src16') THEN {INGESTED} ELSE moment + INTERVAL 5 HOUR END
      AS published
  FROM entries {chosen})
WHERE source NOT IN ('src17', 'src18', 'src19')
"""


VIEWS["papers_feed"] = _papers_feed("authors", "text", "")
VIEWS["papers_feed_top"] = _papers_feed(
    "authors[1:10]", "left(text, 500)",
    "QUALIFY row_number() OVER (PARTITION BY category, doc_id // 700 ORDER BY doc_id) <= 200")

VIEWS["papers_backfill"] = f"""
SELECT left(sha256('arxiv:' || doc_id || 'v1'), 32) AS event_id, 'arxiv' AS source,
  published AS event_timestamp, CAST(published AS DATE) AS event_date,
  'On ' || lang || ' ' || source || ' ' || doc_id AS topic, {_ARXIV},
  to_json({{'arxiv_id': doc_id || 'v1', 'category': category, 'authors': authors}})
    AS raw_payload
FROM (SELECT *, CASE WHEN source IN ('src15', 'src16') THEN {INGESTED} ELSE moment END
        AS published FROM entries)
WHERE source NOT IN ('src17', 'src18', 'src19')
"""

VIEWS["validated"] = """
SELECT *, CASE
    WHEN broken THEN 'malformed'
    WHEN event_id IS NULL OR source IS NULL OR event_timestamp_text IS NULL OR topic IS NULL
      OR topic_category IS NULL OR language IS NULL OR country_code IS NULL
      OR signal_strength IS NULL OR medium_type IS NULL THEN 'missing_field'
    WHEN source NOT IN ('wiki_pageviews', 'wiki_changes', 'gdelt', 'arxiv') THEN 'unknown_source'
    WHEN topic_category NOT IN ('science', 'conflict', 'health', 'environment', 'culture',
      'economics', 'uncategorised') THEN 'unknown_topic_category'
    WHEN medium_type NOT IN ('formal_knowledge', 'collective_memory', 'institutional_media')
      THEN 'unknown_medium_type' END AS reject_reason
FROM (SELECT *, CASE WHEN odd AND flaw = 2 THEN 'yesterday'
                ELSE CAST(event_timestamp AS VARCHAR) END AS event_timestamp_text
      FROM message_fields)
"""


def _needs(text: str) -> list[str]:
    """Views a text mentions as a relation, with the views those need, in order."""
    found: list[str] = []
    for name in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", text):
        if name in VIEWS and name not in found:
            found += [n for n in _needs(VIEWS[name]) if n not in found]
            found.append(name)
    return found


def query(body: str) -> str:
    """`body` with the views it needs in front."""
    needed = _needs(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    return f"WITH {ctes}\n{body}"


def shown(layout: str, relation: str, where: str = "") -> str:
    """The layout's columns of a view or table."""
    tail = f" WHERE {where}" if where else ""
    return query(f"SELECT {columns.select_list(layout)} FROM {relation}{tail}")
