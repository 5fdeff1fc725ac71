"""SQL that computes the same results from the same tables, written for DuckDB."""

from __future__ import annotations

from pairpulse import schema
from pairpulse.catalogue.fixtures import GOLD_COLUMNS, SILVER_COLUMNS

# Fixed values, spelled out here so that the engine's own lists are checked against them:
# the focus countries with their names, the unrest root codes, the order in which copies
# are compared.
_COUNTRY_NAMES = """('USA', 'United States'), ('CHN', 'China'), ('RUS', 'Russia'), ('GBR', 'United Kingdom'),
  ('FRA', 'France'), ('DEU', 'Germany'), ('UKR', 'Ukraine'), ('ISR', 'Israel'), ('PSE', 'Palestine'),
  ('IRN', 'Iran'), ('SYR', 'Syria'), ('IND', 'India'), ('BRA', 'Brazil'), ('MEX', 'Mexico'), ('TUR', 'Turkey'),
  ('COD', 'Democratic Republic of the Congo'), ('RWA', 'Rwanda'), ('ETH', 'Ethiopia'), ('ERI', 'Eritrea'),
  ('PAK', 'Pakistan'), ('EGY', 'Egypt'), ('VEN', 'Venezuela'), ('ARG', 'Argentina'), ('PRK', 'North Korea'),
  ('TWN', 'Taiwan'), ('KOR', 'South Korea')"""
_FOCUS = """'ARG', 'BRA', 'CHN', 'COD', 'DEU', 'EGY', 'ERI', 'ETH', 'FRA', 'GBR', 'IND', 'IRN', 'ISR', 'KOR',
  'MEX', 'PAK', 'PRK', 'PSE', 'RUS', 'RWA', 'SYR', 'TUR', 'TWN', 'UKR', 'USA', 'VEN'"""
_UNREST = "'10', '13', '14'"
_COMPARED = """input_file_date, event_date, Actor1CountryCode, Actor2CountryCode, Actor1Type1Code, Actor2Type1Code,
  EventRootCode, GoldsteinScale, NumMentions, NumSources, NumArticles, AvgTone, GlobalEventID, Actor1Code,
  Actor1Name, Actor1KnownGroupCode, Actor1Type2Code, Actor1Type3Code, Actor2Code, Actor2Name,
  Actor2KnownGroupCode, Actor2Type2Code, Actor2Type3Code, EventCode, EventBaseCode, QuadClass"""
_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


def _country(key: str) -> str:
    return f"""CASE WHEN {key} BETWEEN 0 AND 19
        THEN (['USA', 'CHN', 'RUS', 'GBR', 'UKR', 'ISR', 'IRN', 'TWN'])[{key} % 8 + 1]
        WHEN {key} IN (20, 22, 24) THEN 'JPN' WHEN {key} = 21 THEN 'AUS' END"""


def _bronze() -> str:
    """The event view over the star schema."""
    known = {
        "GlobalEventID": "l_orderkey * 8 + l_linenumber",
        "Day": "year(ship) * 10000 + month(ship) * 100 + day(ship)",
        "MonthYear": "year(ship) * 100 + month(ship)",
        "Year": "year(ship)",
        "FractionDate": "year(ship) + 0.5::DOUBLE",
        "Actor1Code": "country1 || type1",
        "Actor1Name": "c_name",
        "Actor1CountryCode": "country1",
        "Actor1Type1Code": "type1",
        "Actor2Code": "country2 || type2",
        "Actor2Name": "s_name",
        "Actor2CountryCode": "country2",
        "Actor2Type1Code": "type2",
        "IsRootEvent": "l_linenumber % 2",
        "EventCode": "root || '0'",
        "EventBaseCode": "root || '0'",
        "EventRootCode": "root",
        "QuadClass": "l_partkey % 4 + 1",
        "GoldsteinScale": "(l_partkey % 41 - 20) / 2.0::DOUBLE",
        "NumMentions": "l_quantity",
        "NumSources": "l_linenumber",
        "NumArticles": "floor(l_quantity / 2)",
        "AvgTone": "(l_quantity - 25) / 4.0::DOUBLE",
        "DATEADDED": "strftime(file_date, '%Y%m%d')",
        "SOURCEURL": "'src/' || CAST(l_orderkey * 8 + l_linenumber AS VARCHAR)",
        "input_file_date": "file_date",
    }
    for place in ("Actor1", "Actor2", "Action"):
        known[f"{place}Geo_Type"] = "1"
        known[f"{place}Geo_Lat"] = "(l_suppkey % 361 - 180) * 0.25::DOUBLE"
        known[f"{place}Geo_Long"] = "(l_suppkey % 721 - 360) * 0.25::DOUBLE"
    columns = ",\n    ".join(
        f"CAST({known.get(f.name, 'NULL')} AS {_DUCK[f.dataType.simpleString()]}) AS {f.name}"
        for f in schema.BRONZE if f.name != "ingested_at")
    return f"""star AS (
  SELECT *, CAST(l_shipdate AS DATE) AS ship,
    CAST(l_shipdate AS DATE)
      + CAST(CASE l_partkey % 10 WHEN 0 THEN 7 WHEN 1 THEN 30 ELSE 0 END AS INTEGER) AS file_date,
    {_country('c_nationkey')} AS country1,
    {_country('s_nationkey')} AS country2,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'GOV' WHEN 'AUTOMOBILE' THEN 'REB'
      WHEN 'MACHINERY' THEN 'COP' WHEN 'FURNITURE' THEN 'CVL' END AS type1,
    CASE p_type WHEN 'ECONOMY' THEN 'GOV' WHEN 'LARGE' THEN 'GOV' WHEN 'STANDARD' THEN 'OPP'
      WHEN 'SMALL' THEN 'EDU' WHEN 'MEDIUM' THEN 'CVL' END AS type2,
    lpad(CAST(l_partkey % 20 + 1 AS VARCHAR), 2, '0') AS root
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN part ON l_partkey = p_partkey
),
bronze AS (
  SELECT {columns}
  FROM star
)"""


_EVENT_DATE = "CAST(try_strptime(CAST(Day AS VARCHAR), '%Y%m%d') AS DATE)"


def _clean(bronze: str) -> str:
    return f"""{bronze},
dated AS (SELECT *, {_EVENT_DATE} AS event_date FROM bronze),
clean AS (
  SELECT * FROM dated
  WHERE Actor1CountryCode IN ({_FOCUS}) AND Actor2CountryCode IN ({_FOCUS})
    AND event_date IS NOT NULL AND EventRootCode IS NOT NULL
)"""


_CLEAN = _clean(_bronze())
_LIST = ", ".join(SILVER_COLUMNS)


def _dedup(key: list[str], clean: str = _CLEAN) -> str:
    compared = [c.strip() for c in _COMPARED.split(",")]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in compared if c not in key)
    return f"""{clean},
silver AS (
  SELECT {_LIST} FROM clean
  QUALIFY row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {order}) = 1
)"""


_SILVER = _dedup(["input_file_date", "GlobalEventID"])
_SILVER_GLOBAL = _dedup(["GlobalEventID"])

_COUNTS = {
    "total_events": "count(*)",
    "geo_unrest_score": f"count(*) FILTER (WHERE EventRootCode IN ({_UNREST}))",
    "total_gov_gov_events":
        "count(*) FILTER (WHERE Actor1Type1Code = 'GOV' AND Actor2Type1Code = 'GOV')",
    "total_ngov_gov_events":
        "count(*) FILTER (WHERE Actor1Type1Code <> 'GOV' AND Actor2Type1Code = 'GOV')",
    "total_gov_ngov_events":
        "count(*) FILTER (WHERE Actor1Type1Code = 'GOV' AND Actor2Type1Code <> 'GOV')",
    "total_mentions": "sum(NumMentions)",
    "total_sources": "sum(NumSources)",
    "total_articles": "sum(NumArticles)",
}
_NULL_COUNTS = _COUNTS | {
    "total_ngov_gov_events":
        "count(*) FILTER (WHERE coalesce(Actor1Type1Code, '') <> 'GOV' AND Actor2Type1Code = 'GOV')",
    "total_gov_ngov_events":
        "count(*) FILTER (WHERE Actor1Type1Code = 'GOV' AND coalesce(Actor2Type1Code, '') <> 'GOV')",
}
_MEANS = {"avg_goldstein": "avg(GoldsteinScale)", "avg_tone": "avg(AvgTone)"}
_MONTH = "CAST(date_trunc('month', event_date) AS DATE)"


def _pairs(*names: str, source: str = "silver", counts: dict[str, str] = _COUNTS) -> str:
    exprs = [f"CAST({counts[n]} AS INTEGER) AS {n}" if n in counts else f"{_MEANS[n]} AS {n}"
             for n in names or (*counts, *_MEANS)]
    return (f"SELECT {_MONTH} AS year_month, Actor1CountryCode, Actor2CountryCode,\n    "
            + ",\n    ".join(exprs) + f"\n  FROM {source} GROUP BY ALL")


_SHARE = """(total_gov_gov_events + total_ngov_gov_events + total_gov_ngov_events)
    / CAST(total_events AS DOUBLE)"""


def _gold_cte(source: str = "silver", counts: dict[str, str] = _COUNTS) -> str:
    return f"""pairs AS ({_pairs(source=source, counts=counts)}),
gold AS (
  SELECT *, geo_unrest_score * pol_involve_score AS suri_score
  FROM (SELECT *, {_SHARE} AS pol_involve_score FROM pairs)
)"""


_GOLD = f"{_SILVER},\n{_gold_cte()}"
_GOLD_LIST = ", ".join(GOLD_COLUMNS)
_MONTHS = f"""{_SILVER},
months AS (
  SELECT {_MONTH} AS year_month, count(DISTINCT event_date) AS days_present
  FROM silver GROUP BY ALL
)"""
_DAYS = "CAST(day(last_day(year_month)) AS INTEGER)"

_FILE_DAYS = """file_days AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS file_date
  FROM (SELECT CAST(min(input_file_date) AS TIMESTAMP) AS lo,
               CAST(max(input_file_date) AS TIMESTAMP) AS hi FROM bronze)
)"""
_PLAN = f"""{_FILE_DAYS},
marked AS (
  SELECT file_date, file_date NOT IN (SELECT input_file_date FROM bronze) AS is_skipped
  FROM file_days
),
plan AS (
  SELECT file_date, is_skipped, NOT is_skipped AS ingest,
    NOT bool_or(is_skipped) OVER (PARTITION BY date_trunc('month', file_date) ORDER BY file_date
                                  ROWS UNBOUNDED PRECEDING) AS require_full_month,
    file_date = last_day(file_date) AS run_gold
  FROM marked
)"""
_SLOTS = f"""{_FILE_DAYS},
expected AS (
  SELECT file_date, strftime(file_date + INTERVAL (q * 15) MINUTE, '%Y%m%d%H%M%S')
    || '.export.CSV.zip' AS slot
  FROM file_days, range(96) AS quarter(q)
),
arrived AS (
  SELECT DISTINCT strftime(input_file_date + INTERVAL (GlobalEventID % 96 * 15) MINUTE,
    '%Y%m%d%H%M%S') || '.export.CSV.zip' AS slot
  FROM bronze
)"""


def _report(checks: dict[str, str], source: str) -> str:
    """Long form of one row of counts."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS check_name, CAST(coalesce({expr}, 0) AS BIGINT) AS violations FROM {source}"
        for name, expr in checks.items())


_GOLD_CHECKS = {
    "empty": "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END",
    "extra_months": "greatest(count(DISTINCT year_month) - 1, 0)",
    "no_events": "count(*) FILTER (WHERE total_events <= 0)",
    "negative_unrest": "count(*) FILTER (WHERE geo_unrest_score < 0)",
    "involvement_out_of_range": "count(*) FILTER (WHERE pol_involve_score < 0 OR pol_involve_score > 1)",
    "negative_index": "count(*) FILTER (WHERE suri_score < 0)",
    "index_mismatch":
        "count(*) FILTER (WHERE abs(suri_score - geo_unrest_score * pol_involve_score) > 0.01)",
    "null_scores": "count(*) FILTER (WHERE pol_involve_score IS NULL OR suri_score IS NULL)",
    "count_overflow": "count(*) FILTER (WHERE greatest(total_events, geo_unrest_score, "
                      "total_gov_gov_events, total_ngov_gov_events, total_gov_ngov_events, "
                      "total_mentions, total_sources, total_articles) > 2147483647)",
}
_PLANTED_GOLD = f"""{_GOLD},
planted AS (
  SELECT * REPLACE (
    CASE WHEN total_events % 7 = 1 THEN -1 ELSE geo_unrest_score END AS geo_unrest_score,
    CASE WHEN total_events % 7 = 2 THEN pol_involve_score + 1
         WHEN total_events % 7 = 3 THEN NULL ELSE pol_involve_score END AS pol_involve_score,
    CASE WHEN total_events % 7 = 4 THEN suri_score + 0.5
         WHEN total_events % 7 = 5 THEN -2.0 ELSE suri_score END AS suri_score,
    CASE WHEN total_events % 7 = 6 THEN 0 ELSE total_events END AS total_events)
  FROM gold
)"""

_PLANTED_BRONZE = f"""{_bronze()},
planted AS (
  SELECT * REPLACE (
    CASE WHEN GlobalEventID % 40 = 1 THEN NULL ELSE GlobalEventID END AS GlobalEventID,
    CASE WHEN GlobalEventID % 40 IN (2, 3) THEN NULL ELSE Day END AS Day,
    CASE WHEN GlobalEventID % 40 = 4 THEN NULL WHEN GlobalEventID % 40 = 5 THEN 12
         ELSE NumMentions END AS NumMentions,
    CASE WHEN GlobalEventID % 40 = 6 THEN NULL WHEN GlobalEventID % 40 = 7 THEN -0.5::DOUBLE
         ELSE GoldsteinScale END AS GoldsteinScale,
    CASE WHEN GlobalEventID % 40 = 8 THEN NULL ELSE AvgTone END AS AvgTone,
    CASE WHEN GlobalEventID % 40 = 9 THEN NULL ELSE Actor1Geo_Lat END AS Actor1Geo_Lat)
  FROM bronze
)"""

_PLANTED_LINES = f"""WITH {_bronze()}
SELECT GlobalEventID, Day, FractionDate,
  CASE WHEN GlobalEventID % 50 = 3 THEN '"' || Actor1Name ELSE Actor1Name END AS Actor1Name,
  Actor1CountryCode, Actor2CountryCode, Actor2Type1Code, GoldsteinScale, AvgTone, ActionGeo_Long,
  CASE WHEN GlobalEventID % 50 <> 1 THEN DATEADDED END AS DATEADDED,
  CASE WHEN GlobalEventID % 50 <> 1 THEN SOURCEURL END AS SOURCEURL,
  input_file_date, GlobalEventID % 50 IN (1, 2) AS malformed_line
FROM bronze"""

_NAMES = f"names(code, name) AS (VALUES {_COUNTRY_NAMES})"
_NAMED = f"""{_GOLD},
{_NAMES},
named AS (
  SELECT gold.*, s.name AS source_country, t.name AS target_country
  FROM gold LEFT JOIN names s ON Actor1CountryCode = s.code
            LEFT JOIN names t ON Actor2CountryCode = t.code
)"""
_ONE_PAIR = "FROM named WHERE source_country = 'United States' AND target_country = 'China'"

_BITS = " + ".join(f"(((a >> {i}) & 1) << {2 * i}) + (((b >> {i}) & 1) << {2 * i + 1})"
                   for i in range(5))
_SORTED = _FOCUS  # spelled in alphabetical order

_ALL_SILVER = f"WITH {_SILVER} SELECT * FROM silver"
_ALL_GOLD = f"WITH {_GOLD} SELECT {_GOLD_LIST} FROM gold"


# Ten days before the month of the last file date: where daily runs begin.
_TAIL = "(SELECT date_trunc('month', max(input_file_date)) - INTERVAL 10 DAY FROM bronze)"


def _backfill_gold(landed: str, as_of: bool = True, lifted: str = "TRUE") -> str:
    """``landed``: the rows whose file dates have been loaded; ``lifted``: where a skipped day
    lifts the need for a complete month."""
    return f"""WITH {_SILVER},
{_PLAN.replace("FROM bronze", f"FROM {landed}")},
seen AS (SELECT * FROM silver WHERE {"input_file_date <= last_day(event_date)" if as_of else "TRUE"}),
seen_months AS (
  SELECT {_MONTH} AS year_month, count(DISTINCT event_date) AS days_present FROM seen GROUP BY ALL
),
full_months AS (SELECT year_month FROM seen_months WHERE days_present = {_DAYS}),
eligible AS (
  SELECT CAST(date_trunc('month', file_date) AS DATE) AS m FROM plan
  WHERE run_gold AND ((NOT require_full_month AND {lifted})
    OR CAST(date_trunc('month', file_date) AS DATE) IN (SELECT year_month FROM full_months))
),
wanted AS (SELECT * FROM seen WHERE {_MONTH} IN (SELECT m FROM eligible)),
{_gold_cte("wanted")}
SELECT {_GOLD_LIST} FROM gold"""


ORACLES: dict[str, str] = {
    "monthly_index": _ALL_GOLD,
    "silver_events": _ALL_SILVER,
    "event_date_parse": f"""WITH {_bronze()},
moved AS (
  SELECT GlobalEventID, CAST(Day // 100 * 100 + GoldsteinScale * 2 + 20 AS INTEGER) AS Day FROM bronze
)
SELECT GlobalEventID, Day, {_EVENT_DATE} AS event_date FROM moved""",
    "focus_filter": f"""WITH {_bronze()}
SELECT GlobalEventID, input_file_date, Actor1CountryCode, Actor2CountryCode FROM bronze
WHERE Actor1CountryCode IN ({_FOCUS}) AND Actor2CountryCode IN ({_FOCUS})""",
    "essential_not_null": f"""WITH {_bronze()}
SELECT * FROM (
  SELECT GlobalEventID, Day, input_file_date, EventRootCode, Actor1CountryCode, Actor2CountryCode,
    {_EVENT_DATE} AS event_date FROM bronze)
WHERE event_date IS NOT NULL AND Actor1CountryCode IS NOT NULL AND Actor2CountryCode IS NOT NULL
  AND EventRootCode IS NOT NULL""",
    "dedup_events": f"WITH {_SILVER_GLOBAL} SELECT * FROM silver",
    "duplicate_ids": f"""WITH {_CLEAN}
SELECT input_file_date, GlobalEventID, count(*) AS copies FROM clean GROUP BY ALL
HAVING count(*) > 1""",
    "duplicates_exist": f"""WITH {_SILVER},
folded AS (SELECT count(*) AS n FROM clean GROUP BY input_file_date, GlobalEventID)
SELECT 'before' AS stage, coalesce(bool_or(n > 1), FALSE) AS has_duplicates FROM folded
UNION ALL SELECT 'after', count(*) < 0 FROM folded""",
    "unrest_counts": f"WITH {_SILVER} {_pairs('total_events', 'geo_unrest_score')}",
    "gov_flow_counts": f"WITH {_SILVER} " + _pairs(
        "total_gov_gov_events", "total_ngov_gov_events", "total_gov_ngov_events"),
    "gov_flow_counts_null_nongov": f"WITH {_SILVER} " + _pairs(
        "total_gov_gov_events", "total_ngov_gov_events", "total_gov_ngov_events", counts=_NULL_COUNTS),
    "coverage_totals": f"WITH {_SILVER} "
                       + _pairs("total_mentions", "total_sources", "total_articles"),
    "tone_goldstein_avg": f"WITH {_SILVER} {_pairs('avg_goldstein', 'avg_tone')}",
    "political_involvement": f"""WITH {_GOLD}
SELECT year_month, Actor1CountryCode, Actor2CountryCode, total_events, total_gov_gov_events,
  total_ngov_gov_events, total_gov_ngov_events, pol_involve_score FROM gold""",
    "suri_score": f"""WITH {_GOLD}
SELECT year_month, Actor1CountryCode, Actor2CountryCode, geo_unrest_score, pol_involve_score,
  suri_score FROM gold""",
    "monthly_index_null_nongov":
        f"WITH {_SILVER}, {_gold_cte(counts=_NULL_COUNTS)} SELECT {_GOLD_LIST} FROM gold",
    "month_event_dates": f"WITH {_SILVER} SELECT DISTINCT {_MONTH} AS year_month, event_date FROM silver",
    "month_missing_days": f"""WITH {_SILVER},
span AS (SELECT date_trunc('month', min(event_date)) AS lo, last_day(max(event_date)) AS hi FROM silver),
days AS (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY))
    AS DATE) AS missing_date FROM span
)
SELECT CAST(date_trunc('month', missing_date) AS DATE) AS year_month, missing_date FROM days
WHERE missing_date NOT IN (SELECT event_date FROM silver)""",
    "month_completeness": f"""WITH {_MONTHS}
SELECT year_month, days_present, {_DAYS} AS days_in_month, days_present = {_DAYS} AS is_complete
FROM months""",
    "monthly_index_gated": f"""WITH {_MONTHS},
{_gold_cte()}
SELECT {_GOLD_LIST} FROM gold
WHERE year_month IN (SELECT year_month FROM months WHERE days_present = {_DAYS})""",
    "file_slots": f"WITH {_bronze()}, {_SLOTS} SELECT file_date, slot FROM expected",
    "missing_slots": f"""WITH {_bronze()}, {_SLOTS}
SELECT file_date, slot FROM expected ANTI JOIN arrived USING (slot)""",
    "slot_arrivals": f"""WITH {_bronze()}, {_SLOTS}
SELECT file_date, count(*) AS expected_slots, count(arrived.slot) AS arrived_slots,
  count(*) - count(arrived.slot) AS missing_slots
FROM expected LEFT JOIN arrived ON expected.slot = arrived.slot GROUP BY file_date""",
    "tsv_roundtrip": _PLANTED_LINES,
    "zip_roundtrip": _PLANTED_LINES,
    "damaged_archives": f"{_PLANTED_LINES} WHERE day(input_file_date) <> 13",
    "archive_files": f"""WITH lines AS ({_PLANTED_LINES}),
days AS (
  SELECT DISTINCT input_file_date, CASE WHEN day(input_file_date) = 19 THEN 'no .CSV member'
    WHEN day(input_file_date) IN (13, 17) THEN 'damaged'
    WHEN day(input_file_date) = 23 AND month(input_file_date) = 1 THEN 'larger than 4194304 bytes' END AS read_error
  FROM lines WHERE day(input_file_date) <> 1
)
SELECT lines.*, read_error FROM lines JOIN days USING (input_file_date) WHERE read_error IS NULL
UNION ALL BY NAME
SELECT input_file_date, read_error FROM days WHERE read_error IS NOT NULL""",
    "landing_strays": f"""WITH {_bronze()}
SELECT 'stray' AS kind, count(DISTINCT input_file_date) AS names FROM bronze WHERE day(input_file_date) IN (5, 6)
UNION ALL
SELECT 'slot', count(DISTINCT input_file_date) FROM bronze WHERE day(input_file_date) NOT IN (5, 6)""",
    "bronze_cast": f"""WITH {_PLANTED_BRONZE}
SELECT GlobalEventID, Day, NumMentions, NumSources, GoldsteinScale, AvgTone, Actor1Geo_Lat,
  FractionDate, QuadClass, SOURCEURL, input_file_date FROM planted""",
    "bronze_replay": f"WITH {_bronze()} SELECT * FROM bronze",
    "silver_latest_file_wins": f"""WITH {_SILVER}
SELECT * FROM silver
QUALIFY input_file_date = max(input_file_date) OVER (PARTITION BY event_date)""",
    "silver_replay": f"WITH {_SILVER} SELECT * FROM silver",
    "gold_replay": _ALL_GOLD,
    "z_key": f"""WITH {_SILVER},
ids AS (
  SELECT Actor1CountryCode, Actor2CountryCode,
    CAST(list_position([{_SORTED}], Actor1CountryCode) - 1 AS INTEGER) AS a,
    CAST(list_position([{_SORTED}], Actor2CountryCode) - 1 AS INTEGER) AS b, count(*) AS events
  FROM silver GROUP BY ALL
)
SELECT Actor1CountryCode, Actor2CountryCode, CAST({_BITS} AS INTEGER) AS z_key, events FROM ids""",
    "quality_bronze": f"WITH {_PLANTED_BRONZE}, faults AS ("
                      "SELECT *, CAST(substr(SOURCEURL, 5) AS BIGINT) % 40 AS c FROM planted) " + _report({
        "empty": "CASE WHEN count(*) FILTER (WHERE c <> 13) = 0 THEN 1 ELSE 0 END",
        "extra_file_dates": "greatest(count(DISTINCT input_file_date) FILTER (WHERE c <> 13) - 1, 0)",
        "null_file_dates": "count(*) FILTER (WHERE c <> 13 AND input_file_date IS NULL)",
        "null_ids": "count(*) FILTER (WHERE c <> 13 AND GlobalEventID IS NULL)",
        "malformed_lines": "count(*) FILTER (WHERE c IN (11, 12))",
        "read_errors": "count(*) FILTER (WHERE c = 13)",
    }, "faults"),
    "quality_silver": f"""WITH {_CLEAN},
folded AS (SELECT input_file_date, GlobalEventID, count(*) AS copies FROM clean GROUP BY ALL)
""" + _report({
        "empty": "CASE WHEN coalesce(sum(copies), 0) = 0 THEN 1 ELSE 0 END",
        "extra_file_dates": "greatest(count(DISTINCT input_file_date) - 1, 0)",
        "duplicate_ids": "count(*) FILTER (WHERE copies > 1)",
        "null_ids": "sum(copies) FILTER (WHERE GlobalEventID IS NULL)",
    }, "folded"),
    "quality_gold": f"WITH {_GOLD} " + _report(_GOLD_CHECKS, "gold"),
    "quality_gold_planted": f"WITH {_PLANTED_GOLD} " + _report(_GOLD_CHECKS, "planted"),
    "backfill_plan": f"WITH {_bronze()}, {_PLAN} SELECT * FROM plan",
    "backfill_gold": _backfill_gold("bronze"),
    "backfill_tables": _backfill_gold("silver"),
    # Daily runs always want a complete month.
    "daily_run": _backfill_gold("silver", lifted=f"file_date < {_TAIL}"),
    "gold_pruned": f"""WITH {_GOLD},
opened AS (SELECT {_MONTH} AS year_month, count(DISTINCT input_file_date) AS file_dates FROM silver GROUP BY ALL)
SELECT {_GOLD_LIST}, file_dates FROM gold JOIN opened USING (year_month)""",
    "layout_skipping": f"""WITH {_SILVER},
ids AS (
  SELECT Actor1CountryCode AS source, Actor2CountryCode AS target, count(*) AS n,
    list_position([{_SORTED}], Actor1CountryCode) - 1 AS a, list_position([{_SORTED}], Actor2CountryCode) - 1 AS b
  FROM silver GROUP BY ALL
),
placed AS (SELECT *, row_number() OVER (ORDER BY {_BITS}) AS place FROM ids),
sided AS (
  SELECT 'source' AS side, source AS country, n, place FROM placed
  UNION ALL SELECT 'target', target, n, place FROM placed
),
runs AS (SELECT *, place - row_number() OVER (PARTITION BY side, country ORDER BY place) AS run FROM sided)
SELECT side, country, CAST(sum(n) AS BIGINT) AS events, count(DISTINCT run) AS z_runs, TRUE AS within_bound
FROM runs GROUP BY side, country""",
    "stream_gold": _backfill_gold("bronze", as_of=False),
    "stream_silver": f"WITH {_SILVER} SELECT * FROM silver",
    "affected_months": f"WITH {_SILVER} SELECT DISTINCT input_file_date, {_MONTH} AS year_month FROM silver",
    "country_names": f"""WITH {_GOLD},
{_NAMES}
SELECT year_month, Actor1CountryCode, Actor2CountryCode, s.name AS source_country,
  t.name AS target_country, suri_score
FROM gold LEFT JOIN names s ON Actor1CountryCode = s.code AND s.code <> 'TWN'
          LEFT JOIN names t ON Actor2CountryCode = t.code AND t.code <> 'TWN'""",
    "country_pickers": f"""WITH {_NAMED}
SELECT DISTINCT source_country AS country, 'source' AS side FROM named
UNION ALL SELECT DISTINCT target_country AS country, 'target' AS side FROM named""",
    "pair_series": f"WITH {_NAMED} SELECT year_month, suri_score {_ONE_PAIR}",
    "pair_detail": f"""WITH {_NAMED}
SELECT year_month, suri_score, geo_unrest_score, pol_involve_score, total_events {_ONE_PAIR}""",
    "gold_csv_roundtrip": _ALL_GOLD,
}
