"""DuckDB SQL that states each registered query independently of Spark."""

from __future__ import annotations

import re

_TOTALS = """
    SELECT provnum, count(month_key) AS reporting_days, CAST(sum(mdscensus) AS DOUBLE) / count(mdscensus) AS avg_census,
           CAST(sum(mdscensus) AS BIGINT) AS sum_census, sum(total_direct_care_hours) AS sum_hours,
           sum(contract_direct_care_hours) AS sum_ctr_hours
    FROM {days} GROUP BY ALL"""
_RATIOS = """
    SELECT provnum, provider_name, state, ownership_type, provider_type, certified_beds, reporting_days, avg_census,
           sum_ctr_hours AS contract_hours_total,
           sum_hours::DOUBLE / nullif(greatest(sum_census, 0), 0) AS hprd,
           sum_ctr_hours::DOUBLE / nullif(greatest(sum_hours, 0), 0)::DOUBLE AS contract_mix,
           sum_ctr_hours::DOUBLE / nullif(greatest(certified_beds, 0), 0) AS contract_reliance
    FROM {totals} LEFT JOIN v_newest USING (provnum)"""
_BY_MONTH = """
    SELECT month_key, state, ownership_type, CAST(sum(census) AS BIGINT) AS sum_census, sum(hours) AS sum_hours,
           sum(ctr_hours) AS sum_ctr_hours
    FROM (SELECT provnum, month_key, sum(mdscensus) AS census, sum(total_direct_care_hours) AS hours,
                 sum(contract_direct_care_hours) AS ctr_hours FROM {days} GROUP BY ALL)
    LEFT JOIN v_newest USING (provnum) GROUP BY ALL"""

_VIEWS = {
    "v_raw": """
        SELECT CAST(l_suppkey AS VARCHAR) AS provnum,
               CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER) AS workdate,
               CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(l_orderkey % 120 AS SMALLINT) END AS mdscensus,
               CAST(l_quantity AS DECIMAL(5,2)) AS hrs_rn,
               CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE CAST(l_partkey % 60 AS DECIMAL(7,2)) END AS hrs_lpn,
               CAST(l_orderkey % 260 AS DECIMAL(6,2)) AS hrs_cna,
               CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(5,2)) ELSE 0 END AS hrs_rn_ctr,
               CASE WHEN l_returnflag = 'R' THEN CAST(l_partkey % 60 AS DECIMAL(7,2)) END AS hrs_lpn_ctr,
               CASE WHEN l_linestatus = 'F' THEN CAST(l_orderkey % 260 AS DECIMAL(5,2)) ELSE 0 END AS hrs_cna_ctr,
               l_orderkey, l_linenumber, l_partkey
        FROM lineitem""",
    "v_staffing": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY provnum, workdate
                ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, hrs_rn DESC) AS rn
            FROM v_raw WHERE provnum IS NOT NULL AND workdate IS NOT NULL) WHERE rn = 1""",
    "v_snapshot": """
        SELECT CAST(l_suppkey AS VARCHAR) AS provnum, CAST(mk * 100 + 1 AS INTEGER) AS snapshot_date_key,
               max(s_name) AS provider_name,
               CASE WHEN max(l_returnflag) = 'R' THEN 'addr' END AS provider_address,
               max(n_name) AS state, max(l_returnflag) AS ownership_type, min(l_linestatus) AS provider_type,
               CAST(CASE WHEN count(*) > 9 THEN 120 WHEN count(*) > 8 THEN NULL ELSE 60 END AS SMALLINT) AS certified_beds
        FROM (SELECT * REPLACE (CASE WHEN (l_suppkey * 31 + mk) % 13 = 0
                     THEN CASE WHEN mk % 100 = 12 THEN mk + 89 ELSE mk + 1 END ELSE mk END AS mk)
              FROM (SELECT *, year(l_shipdate) * 100 + month(l_shipdate) AS mk FROM lineitem)) l
        JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
        GROUP BY l_suppkey, mk""",
    "v_quality": """
        SELECT *, CAST((CAST(provnum AS BIGINT) * 7 + snapshot_date_key // 100) % 5 + 1 AS SMALLINT) AS overall_rating,
               CASE WHEN CAST(provnum AS BIGINT) % 4 = 0 THEN NULL ELSE CAST(provnum AS BIGINT) % 12 END AS cycle1,
               (snapshot_date_key // 100) % 7 AS cycle2,
               CASE WHEN (snapshot_date_key // 100) % 3 = 0 THEN NULL ELSE 2 END AS cycle3
        FROM v_snapshot""",
    "v_target": """
        SELECT provnum, workdate, CAST(hrs_rn AS DECIMAL(6,2)) AS hrs_rn,
               CASE WHEN l_orderkey % 11 = 0 THEN NULL
                    ELSE '2024-01-0' || CAST(l_orderkey % 5 + 1 AS VARCHAR) END AS stamp,
               md5(CAST(l_orderkey AS VARCHAR)) AS md5hash
        FROM v_staffing WHERE l_orderkey % 3 <> 0""",
    "v_incoming": """
        SELECT provnum, workdate, CAST(hrs_rn + 1 AS DECIMAL(6,2)) AS hrs_rn, '2024-01-03' AS stamp,
               md5('incoming') AS md5hash
        FROM v_staffing WHERE l_partkey % 2 = 0 OR l_orderkey % 3 = 0""",
    "v_candidates": """
        SELECT s.* FROM v_incoming s
        LEFT JOIN v_target t ON t.provnum = s.provnum AND t.workdate = s.workdate
        WHERE t.provnum IS NULL OR s.stamp > t.stamp OR (s.stamp = t.stamp AND s.md5hash > t.md5hash)""",
    "v_files": """
        SELECT doc_id, CAST(doc_id AS VARCHAR) AS file_id,
               CASE doc_id % 4
                   WHEN 0 THEN 'NH_ProviderInfo_' || mon || yr || '.csv'
                   WHEN 1 THEN 'nh_providerinfo_' || mon || yr || ' (1).CSV'
                   WHEN 2 THEN 'PBJ_Daily_Nurse_Staffing_Q2_' || yr || '.csv'
                   ELSE source || '_' || lang || '.csv' END AS file_name,
               CASE WHEN doc_id % 17 = 0 THEN ''
                    ELSE strftime(DATE '2024-01-01' + CAST(doc_id % 366 AS INTEGER), '%Y-%m-%d') || 'T10:'
                         || lpad(CAST(doc_id % 60 AS VARCHAR), 2, '0') || ':00.000Z' END AS modified_at,
               md5(text) AS md5hash
        FROM (SELECT *, CAST(doc_id % 20 + 2005 AS VARCHAR) AS yr,
                     ['Jan','FEB','mar','Apr','May','Jun','JUL','Aug','Sep','Oct','Nov','dec','Xyz'][doc_id % 13 + 1] AS mon
              FROM documents)""",
    "v_named": """
        SELECT *, CASE WHEN doc_id % 4 < 2 THEN 'NH_PROVIDER_INFO' WHEN doc_id % 4 = 2 THEN 'PBJ_STAFFING' END AS file_type,
               CASE WHEN doc_id % 4 < 2 AND doc_id % 13 < 12
                    THEN CAST((doc_id % 20 + 2005) * 10000 + (doc_id % 13 + 1) * 100 + 1 AS INTEGER) END AS snapshot_date_key,
               (doc_id % 4 = 3 OR (doc_id % 4 < 2 AND doc_id % 13 = 12)) AS rejected,
               CASE WHEN modified_at <> '' THEN
                    regexp_replace(regexp_replace(file_name, '\\.csv$', ''), '\\.CSV$', '') || '_'
                    || replace(substr(modified_at, 1, 10), '-', '') || '_'
                    || replace(substr(modified_at, 12, 8), ':', '') || '.csv' END AS s3_key
        FROM v_files""",
    "v_ledger": """
        SELECT file_id, file_name,
               CASE WHEN doc_id % 7 = 0 THEN md5('older') ELSE md5hash END AS md5hash,
               'old/' || file_name AS s3_key, modified_at AS drive_modified_at,
               CASE WHEN doc_id % 3 = 0 THEN 'FAILED' WHEN doc_id % 11 = 0 THEN 'PENDING' ELSE 'SUCCESS' END AS merge_status
        FROM v_files WHERE doc_id % 5 <> 0""",
    "v_planned": """
        SELECT f.*, c.change,
               CASE WHEN f.rejected OR (c.change <> 'SKIP' AND f.s3_key IS NULL) THEN 'errors'
                    WHEN c.change = 'SKIP' THEN 'skipped' ELSE 'processed' END AS outcome
        FROM v_named f JOIN (
            SELECT m.file_id, CASE WHEN l.file_id IS NULL THEN 'NEW'
                                   WHEN l.md5hash = m.md5hash AND l.merge_status = 'SUCCESS' THEN 'SKIP'
                                   WHEN l.md5hash = m.md5hash THEN 'RETRY' ELSE 'CHANGED' END AS change
            FROM v_files m LEFT JOIN v_ledger l ON l.file_id = m.file_id) c ON c.file_id = f.file_id""",
    "v_texts": """
        SELECT CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS provnum,
               CASE WHEN l_orderkey % 500 = 7 THEN '70000' ELSE CAST(l_orderkey % 30000 AS VARCHAR) END AS county_fips,
               l_returnflag || l_linestatus || CASE WHEN l_orderkey % 20 = 1 AND l_linenumber > 2 THEN '!' ELSE '' END AS state,
               CASE WHEN l_orderkey % 500 = 11 THEN '123456.78'
                    ELSE CAST(CAST(l_extendedprice % 90000 AS DECIMAL(7,2)) AS VARCHAR) END AS hrs_rn,
               CASE WHEN l_orderkey % 25 = 3 AND l_linenumber > 2 THEN 'n/a' ELSE CAST(l_partkey AS VARCHAR) END AS workdate,
               'file_' || CAST(l_orderkey % 500 AS VARCHAR) AS file
        FROM lineitem""",
    "v_errors": """
        SELECT doc_id, source, CASE lang WHEN 'en' THEN 'Invalid digit: ' WHEN 'de' THEN 'VALUE OUT OF RANGE '
                                         WHEN 'fr' THEN 'violates not-null: ' ELSE 'connection reset, ' END || text AS text
        FROM documents""",
    "v_broken": """
        SELECT *, provnum IS NULL AS no_key, TRY_CAST(county_fips AS SMALLINT) IS NULL AS bad_fips,
               strlen(state) > 2 AS long_state, TRY_CAST(hrs_rn AS DECIMAL(7,2)) IS NULL AS bad_hours,
               TRY_CAST(workdate AS INTEGER) IS NULL AS bad_date
        FROM v_texts""",
    "v_jobs": """
        SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'FINISHED' WHEN event_id % 5 = 1 THEN 'ABORTED'
                              WHEN event_id % 5 <= 3 THEN 'FAILED' ELSE 'STARTED' END AS status,
               CASE WHEN event_id % 3 = 0 THEN 'DATA_ERROR | ' || event_type
                    ELSE 'timeout in ' || event_type END AS error,
               event_id % 2 + 1 AS attempt
        FROM events""",
    "v_routed": """
        SELECT *, CASE WHEN status = 'FINISHED' THEN 'NEXT' WHEN status = 'ABORTED' THEN 'REJECT'
                       WHEN status = 'FAILED' AND contains(error, 'DATA_ERROR') THEN 'REJECT'
                       WHEN status = 'FAILED' AND attempt < 2 THEN 'RETRY'
                       WHEN status = 'FAILED' THEN 'REJECT' ELSE 'WAIT' END AS action
        FROM v_jobs""",
    "v_changed": """
        SELECT *, CAST(snapshot_date_key // 100 AS INTEGER) AS month_key,
               CASE WHEN provider_name IS DISTINCT FROM lag(provider_name) OVER w
                      OR provider_address IS DISTINCT FROM lag(provider_address) OVER w
                      OR state IS DISTINCT FROM lag(state) OVER w
                      OR ownership_type IS DISTINCT FROM lag(ownership_type) OVER w
                      OR provider_type IS DISTINCT FROM lag(provider_type) OVER w
                      OR certified_beds IS DISTINCT FROM lag(certified_beds) OVER w
                    THEN 1 ELSE 0 END AS changed
        FROM v_snapshot WINDOW w AS (PARTITION BY provnum ORDER BY snapshot_date_key)""",
    "v_versions": """
        SELECT *, sum(changed) OVER (PARTITION BY provnum ORDER BY snapshot_date_key
                                     ROWS UNBOUNDED PRECEDING) AS grp
        FROM v_changed""",
    "v_bounds": """
        SELECT *, min(month_key) OVER (PARTITION BY provnum, grp) AS effective_from,
               max(month_key) OVER (PARTITION BY provnum, grp) AS last_month,
               grp = max(grp) OVER (PARTITION BY provnum) AS is_last
        FROM v_versions""",
    "v_keys": """
        SELECT provnum, CAST(snapshot_date_key // 100 AS INTEGER) AS month_key,
               CAST('0x' || substr(md5(provnum || '_' || CAST(snapshot_date_key // 100 AS VARCHAR)), 1, 15) AS BIGINT)
                   AS provider_key
        FROM v_snapshot""",
    "v_dim": """
        SELECT k.provider_key, b.provnum, b.month_key, b.effective_from,
               CASE WHEN is_last THEN NULL ELSE last_month END AS effective_to, is_last AS is_current,
               provider_name, provider_address, state, ownership_type, provider_type, certified_beds
        FROM v_bounds b JOIN v_keys k ON k.provnum = b.provnum AND k.month_key = b.month_key""",
    "v_fact": """
        SELECT provnum, workdate AS date_key, CAST(workdate // 100 AS INTEGER) AS month_key, mdscensus,
               CAST(coalesce(hrs_rn, 0) + coalesce(hrs_lpn, 0) + coalesce(hrs_cna, 0) AS DECIMAL(9,2))
                   AS total_direct_care_hours,
               CAST(coalesce(hrs_rn_ctr, 0) + coalesce(hrs_lpn_ctr, 0) + coalesce(hrs_cna_ctr, 0) AS DECIMAL(9,2))
                   AS contract_direct_care_hours
        FROM v_staffing""",
    "v_fact_quality": """
        SELECT provnum, CAST(snapshot_date_key // 100 AS INTEGER) AS month_key, overall_rating,
               CAST(coalesce(cycle1, 0) + coalesce(cycle2, 0) + coalesce(cycle3, 0) AS SMALLINT) AS total_deficiencies_3yr,
               certified_beds, ownership_type
        FROM v_quality""",
    "v_newest": """
        SELECT provnum, unnest(max({'at': snapshot_date_key, 'is': {'provider_name': provider_name, 'state': state,
               'ownership_type': ownership_type, 'provider_type': provider_type, 'certified_beds': certified_beds}})['is'])
        FROM v_snapshot GROUP BY provnum""",
    "v_range": "SELECT * FROM v_fact WHERE month_key BETWEEN 199601 AND 199612",
    "v_totals": _TOTALS.format(days="v_fact"),
    "v_range_totals": _TOTALS.format(days="v_range"),
    "v_facilities": _RATIOS.format(totals="v_totals"),
    "v_range_facilities": _RATIOS.format(totals="v_range_totals"),
    "v_shown": "SELECT * FROM v_facilities WHERE reporting_days >= 30 AND hprd IS NOT NULL",
    "v_trend": _BY_MONTH.format(days="v_fact"),
    "v_range_trend": _BY_MONTH.format(days="v_range"),
    "v_clipped": """
        SELECT *, least(contract_reliance, (SELECT quantile_cont(contract_reliance, 0.99) FROM v_shown)) AS reliance_disp
        FROM v_shown WHERE contract_reliance IS NOT NULL""",
}

_RANKED = """provnum AS "CCN", provider_name AS "Facility", state AS "State", ownership_type AS "Ownership",
    certified_beds AS "Beds", avg_census AS "Avg census", hprd AS "HPRD", contract_mix AS "Contract mix",
    contract_reliance AS "Contract hrs/bed", reporting_days AS "Days" """

_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
_INVENTORY = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _TABLES)

# The columns of each test table.
_COLUMNS = """
region r_regionkey r_name
nation n_nationkey n_name n_regionkey
customer c_custkey c_name c_nationkey c_acctbal c_mktsegment
supplier s_suppkey s_name s_nationkey s_acctbal
part p_partkey p_name p_brand p_type p_size p_retailprice
orders o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority
lineitem l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate
events event_id ts user_id event_type value props
documents doc_id text lang source n_chars
embeddings vec_id embedding label
pages page_id url html
benchmark item_id text
labels doc_id quality toxic
conversations conv_id turn role text
"""
_NON_NULL = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{column}' AS column_name, count({column}) AS non_null FROM {table}"
    for table, *columns in map(str.split, _COLUMNS.strip().splitlines())
    for column in columns
)


def _histogram(view: str, column: str) -> str:
    return f"""
        SELECT bin, round(low + bin * width, 6) AS bin_low, count(*) AS facilities FROM (
            SELECT CASE WHEN width > 0 THEN CAST(least(floor(({column} - low) / width), 39) AS INTEGER) ELSE 0 END AS bin,
                   low, width
            FROM {view}, (SELECT min({column}) AS low, (max({column}) - min({column})) / 40 AS width FROM {view})
            WHERE {column} IS NOT NULL)
        GROUP BY bin, low, width"""


def _profile(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count({c}) AS non_null,
               count(*) - count({c}) AS nulls, round(100.0 * (count(*) - count({c})) / count(*), 2) AS null_pct,
               count(DISTINCT {c}) AS distinct_values, round(100.0 * count(DISTINCT {c}) / count(*), 2) AS distinct_pct
           FROM v_raw"""
        for c in columns
    )


_CALENDAR = """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
           CAST(strftime(d, '%Y%m') AS INTEGER) AS month_key, CAST(day(d) AS SMALLINT) AS day_of_month,
           CAST(dayofweek(d) AS SMALLINT) AS day_of_week, dayname(d) AS day_name,
           dayofweek(d) IN (0, 6) AS is_weekend, CAST(weekofyear(d) AS SMALLINT) AS week_of_year,
           CAST(month(d) AS SMALLINT) AS month_number, monthname(d) AS month_name,
           CAST(quarter(d) AS SMALLINT) AS quarter, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name,
           CAST(year(d) AS SMALLINT) AS year,
           year(d) % 400 = 0 OR (year(d) % 4 = 0 AND year(d) % 100 <> 0) AS is_leap_year
    FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS d)"""
_ORDER_DAYS = _CALENDAR.format(
    first="(SELECT min(CAST(o_orderdate AS DATE)) FROM orders)",
    last="(SELECT max(CAST(o_orderdate AS DATE)) FROM orders)",
)
_DAY = "strptime(CAST({edge}({key}) AS VARCHAR), '%Y%m%d')"
for _view, _facts, _key in (
    ("v_calendar", "v_fact", "date_key"), ("v_month_calendar", "v_fact_quality", "month_key * 100 + 1"),
):
    _VIEWS[_view] = _CALENDAR.format(
        first=f"(SELECT {_DAY.format(edge='min', key=_key)} FROM {_facts})",
        last=f"(SELECT {_DAY.format(edge='max', key=_key)} FROM {_facts})",
    )

_FRAGMENTS = ("invalid", "out of range", "type mismatch", "conversion", "constraint", "violat", "numeric")
_IS_DATA_ERROR = " OR ".join(f"text ILIKE '%{f}%'" for f in _FRAGMENTS)

_BODIES = {
    "classify_names": "SELECT file_id, file_name, file_type, rejected FROM v_named",
    "period_key": "SELECT file_id, snapshot_date_key FROM v_named",
    "manifest_scan": """
        SELECT doc_id // 50 AS part, 1 AS files, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents GROUP BY ALL""",
    "content_md5": """
        SELECT doc_id // 50 AS part, md5(string_agg(text, chr(10) ORDER BY doc_id) || chr(10)) AS md5hash
        FROM documents GROUP BY ALL""",
    "encodings": "SELECT DISTINCT source, length(source) % 2 = 0 AS is_utf8 FROM documents",
    "change_detect": "SELECT file_id, change FROM v_planned",
    "landing_key": "SELECT file_id, s3_key FROM v_named",
    "ledger_upsert": """
        SELECT file_id, file_name, md5hash, s3_key, modified_at AS drive_modified_at, 'PENDING' AS merge_status
        FROM v_planned WHERE outcome = 'processed'
        UNION ALL
        SELECT * FROM v_ledger WHERE file_id NOT IN (SELECT file_id FROM v_planned WHERE outcome = 'processed')""",
    "ledger_status": """
        SELECT file_id, file_name, md5hash, s3_key, drive_modified_at,
               CASE WHEN length(file_name) % 2 = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS merge_status
        FROM v_ledger""",
    "run_summary": "SELECT outcome, count(*) AS files FROM v_planned GROUP BY outcome",
    "typed_load": """
        SELECT provnum, workdate, mdscensus, hrs_rn, hrs_lpn, hrs_cna, l_orderkey, l_linenumber, DATE '2024-05-01' AS seen,
               CASE WHEN l_orderkey % 10 < 5 THEN 'first line' || chr(10) || 'of order ' || CAST(l_orderkey AS VARCHAR)
                    ELSE 'plain' END AS note
        FROM v_raw WHERE l_orderkey % 20 <> 3""",
    "blank_as_null": """
        SELECT doc_id, CASE WHEN n_chars % 3 < 2 THEN NULL ELSE nullif(lang, '') END AS lang, ' ' || source AS source
        FROM documents""",
    "undecodable_text": """
        SELECT doc_id, md5(regexp_replace(nullif(trim(translate(text, chr(13) || chr(10) || '"', '   ')), ''), '[^\x01-\x7f]', '?', 'g'))
               AS md5hash FROM documents""",
    "full_refresh": """
        SELECT * REPLACE (CAST(coalesce(certified_beds, 0) + 1 AS SMALLINT) AS certified_beds) FROM v_snapshot""",
    "versioned_table": """
        SELECT * REPLACE (CAST(CASE WHEN snapshot_date_key % 10000 <= 601 AND provnum <> '1' THEN coalesce(certified_beds, 0) + 1
                               ELSE certified_beds END AS SMALLINT) AS certified_beds) FROM v_snapshot""",
    "changed_files": "SELECT provnum, workdate, mdscensus, hrs_rn, hrs_lpn, hrs_cna FROM v_staffing",
    "gold_refresh": """
        SELECT coalesce(provider_key, -1) AS provider_key, f.*, 'failed' AS first_dimension, 'skipped' AS first_fact,
               'refreshed' AS then_fact, 1::BIGINT AS dimension_rejects
        FROM v_fact f LEFT JOIN v_keys d ON d.provnum = f.provnum AND d.month_key = f.month_key""",
    "touched_dimension": """
        SELECT * REPLACE (left(state, 2) AS state) FROM v_dim UNION ALL
        SELECT -1, 'UNKNOWN', 0, 0, NULL, true, 'Unknown', NULL, NULL, NULL, NULL, NULL""",
    "interrupted_refresh": "SELECT file_id, file_name, modified_at, md5hash FROM v_files",
    "replayed_merge": """
        SELECT *, CAST(workdate // 100 AS INTEGER) AS month_key FROM (
            SELECT t.* FROM v_target t ANTI JOIN v_candidates c ON c.provnum = t.provnum AND c.workdate = t.workdate
            UNION ALL SELECT * FROM v_candidates)""",
    "report_reuse": """
        SELECT 'hprd_p10' AS measure, round(quantile_cont(hprd, 0.10), 6) AS value FROM v_shown
        UNION ALL SELECT 'mix_p90', round(quantile_cont(contract_mix, 0.90), 6) FROM v_shown
        UNION ALL SELECT 'facilities', count(*)::DOUBLE FROM v_shown
        UNION ALL SELECT 'state_rows', count(DISTINCT state)::DOUBLE FROM v_shown""",
    "inferred_load": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, count({c}) AS non_null, "
        f"count(DISTINCT {c}) AS distinct_values FROM {t}"
        for t, *columns in map(str.split, _COLUMNS.strip().splitlines()) if t in ("supplier", "orders", "part")
        for c in columns
    ),
    "reject_files": """
        SELECT file, count(*) AS rows_loaded FROM v_texts WHERE file NOT IN (
            SELECT file FROM v_broken WHERE no_key OR bad_fips OR long_state OR bad_hours OR bad_date)
        GROUP BY file""",
    "table_names": r"""
        SELECT page_id, upper(CASE WHEN regexp_matches(base, '^[0-9]') THEN 'T_' || base ELSE base END) AS table_name
        FROM (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(
                  split_part(url, '/', -1), '\.csv(\.gz)?$', '', 'i'), '[^0-9a-zA-Z_]', '_', 'g'), '_+', '_', 'g'), '_') AS base
              FROM pages)""",
    "name_collisions": r"""
        SELECT page_id, path, table_name, min(path) OVER (PARTITION BY table_name) AS first_path,
               CASE WHEN path = min(path) OVER (PARTITION BY table_name) THEN 'LOAD' ELSE 'SKIP' END AS outcome
        FROM (SELECT page_id, path, upper(CASE WHEN regexp_matches(base, '^[0-9]') THEN 'T_' || base ELSE base END) AS table_name
              FROM (SELECT page_id, url || '.csv' AS path, trim(regexp_replace(regexp_replace(regexp_replace(
                        split_part(url || '.csv', '/', -1), '\.csv(\.gz)?$', '', 'i'), '[^0-9a-zA-Z_]', '_', 'g'), '_+', '_', 'g'), '_') AS base
                    FROM pages))""",
    "lineage": """
        SELECT provnum, workdate, l_orderkey, l_linenumber,
               'staffing_' || CAST(workdate // 100 AS VARCHAR) || '.csv' AS _source_s3_key,
               CAST(workdate // 100 AS VARCHAR) || '-01' AS _drive_modified_at,
               md5('staffing_' || CAST(workdate // 100 AS VARCHAR) || '.csv') AS _md5hash
        FROM v_raw""",
    "dup_keys": """
        SELECT provnum, workdate, count(*) AS cnt FROM v_raw
        WHERE provnum IS NOT NULL AND workdate IS NOT NULL
        GROUP BY provnum, workdate HAVING count(*) > 1""",
    "drop_null_keys": "SELECT provnum, county_fips, workdate, file FROM v_texts WHERE provnum IS NOT NULL",
    "type_violations": """
        SELECT * FROM (
            SELECT 'provnum' AS "column", 'not_null' AS rule, count(*) AS violations FROM v_broken WHERE no_key
            UNION ALL SELECT 'county_fips', 'type', count(*) FROM v_broken WHERE bad_fips
            UNION ALL SELECT 'state', 'length', count(*) FROM v_broken WHERE long_state
            UNION ALL SELECT 'hrs_rn', 'type', count(*) FROM v_broken WHERE bad_hours
            UNION ALL SELECT 'workdate', 'type', count(*) FROM v_broken WHERE bad_date)
        WHERE violations > 0""",
    "dedup_latest": "SELECT * FROM v_staffing",
    "error_class": f"""
        SELECT doc_id, CASE WHEN {_IS_DATA_ERROR} THEN 'DATA_ERROR' ELSE 'TRANSIENT' END AS error_class FROM v_errors""",
    "error_message": f"""
        SELECT doc_id, md5(CASE WHEN {_IS_DATA_ERROR} THEN 'DATA_ERROR | ' || text || ' | source: ' || source
                                ELSE text END) AS message_md5 FROM v_errors""",
    "route_outcome": "SELECT event_id, action FROM v_routed",
    "quarantine_counts": """
        SELECT * FROM (
            SELECT 'UNKNOWN_FILE_TYPE' AS error_type, count(*) AS rejects FROM v_named WHERE rejected
            UNION ALL SELECT 'COPY_FAILED', count(DISTINCT file) FROM v_broken
                      WHERE no_key OR bad_fips OR long_state OR bad_hours OR bad_date
            UNION ALL SELECT 'PBJ_DUPLICATE_KEY', count(*) FROM (
                      SELECT provnum FROM v_raw GROUP BY provnum, workdate HAVING count(*) > 1)
            UNION ALL SELECT 'MERGE_FAILED', count(*) FROM v_routed WHERE action = 'REJECT')
        WHERE rejects > 0""",
    "merge_candidates": "SELECT * FROM v_candidates",
    "lww_upsert": """
        SELECT t.* FROM v_target t LEFT JOIN v_candidates c ON c.provnum = t.provnum AND c.workdate = t.workdate
        WHERE c.provnum IS NULL
        UNION ALL SELECT * FROM v_candidates""",
    "snapshot_replace": """
        SELECT * REPLACE (CASE WHEN CAST(provnum AS BIGINT) % 2 = 0 AND (snapshot_date_key // 100) % 100 <= 6
                               THEN CAST(coalesce(certified_beds, 0) + 1 AS SMALLINT)
                               ELSE certified_beds END AS certified_beds)
        FROM v_snapshot""",
    "date_spine": f"SELECT full_date FROM ({_ORDER_DAYS})",
    "dim_date": _ORDER_DAYS,
    "change_flags": "SELECT provnum, snapshot_date_key, changed FROM v_changed",
    "scd2": "SELECT * FROM v_dim",
    "scd2_global": """
        SELECT provnum, month_key, effective_from,
               CASE WHEN is_last AND last_month = top THEN NULL ELSE last_month END AS effective_to,
               is_last AND last_month = top AS is_current
        FROM v_bounds, (SELECT max(month_key) AS top FROM v_bounds)""",
    "surrogate_key": "SELECT * FROM v_keys",
    "dim_with_unknown": """
        SELECT * FROM v_dim UNION ALL
        SELECT -1, 'UNKNOWN', 0, 0, NULL, true, 'Unknown', NULL, NULL, NULL, NULL, NULL""",
    "dim_lookup": """
        SELECT f.provnum, date_key, coalesce(provider_key, -1) AS provider_key
        FROM v_fact f LEFT JOIN v_keys d ON d.provnum = f.provnum AND d.month_key = f.month_key""",
    "fact_daily": """
        SELECT coalesce(provider_key, -1) AS provider_key, f.*
        FROM v_fact f LEFT JOIN v_keys d ON d.provnum = f.provnum AND d.month_key = f.month_key""",
    "fact_quality": "SELECT * FROM v_fact_quality",
    "staffing_vs_quality": """
        SELECT m.provnum, m.month_key, sum_census, sum_hours,
               CASE WHEN sum_census > 0 THEN CAST(sum_hours AS DOUBLE) / CAST(sum_census AS DOUBLE) END AS hprd,
               overall_rating, total_deficiencies_3yr
        FROM (SELECT provnum, month_key, CAST(sum(mdscensus) AS BIGINT) AS sum_census,
                     sum(total_direct_care_hours) AS sum_hours FROM v_fact GROUP BY provnum, month_key) m
        JOIN v_fact_quality q ON q.provnum = m.provnum AND q.month_key = m.month_key""",
    "calendar_join": """
        SELECT year, day_name, is_weekend, count(*) AS days, CAST(sum(mdscensus) AS BIGINT) AS sum_census
        FROM v_fact f LEFT JOIN v_calendar c ON c.date_key = f.date_key GROUP BY year, day_name, is_weekend""",
    "month_calendar_join": """
        SELECT provnum, q.month_key, overall_rating, full_date, quarter_name, year
        FROM v_fact_quality q LEFT JOIN v_month_calendar c ON c.date_key = q.month_key * 100 + 1""",
    "month_bounds": """
        SELECT coalesce(min(month_key), 0) AS min_month, coalesce(max(month_key), 0) AS max_month FROM v_fact""",
    "month_list": """
        SELECT CAST(m AS INTEGER) AS month_key, CAST(m // 100 AS VARCHAR) || '-' || lpad(CAST(m % 100 AS VARCHAR), 2, '0') AS month
        FROM (SELECT unnest(range((SELECT min(month_key) FROM v_fact), (SELECT max(month_key) + 1 FROM v_fact))) AS m)
        WHERE m % 100 BETWEEN 1 AND 12""",
    "latest_attrs": "SELECT * FROM v_newest",
    "range_filter": "SELECT * FROM v_range",
    "facility_agg": "SELECT * FROM v_range_totals",
    "facility_metrics": "SELECT * FROM v_range_facilities",
    "range_from_sums": "SELECT * FROM v_range_facilities",
    "stored_report": "SELECT * FROM v_range_facilities",
    "monthly_trend": "SELECT * FROM v_range_trend",
    "filter_options": """
        SELECT DISTINCT 'state' AS filter, state AS option FROM v_facilities WHERE state IS NOT NULL
        UNION ALL SELECT DISTINCT 'ownership_type', ownership_type FROM v_facilities WHERE ownership_type IS NOT NULL
        UNION ALL SELECT DISTINCT 'provider_type', provider_type FROM v_facilities WHERE provider_type IS NOT NULL""",
    "facility_filter": """
        SELECT * FROM v_facilities
        WHERE reporting_days >= 40 AND hprd IS NOT NULL AND ownership_type IN ('N', 'R')
          AND regexp_matches(state, '^NATION_([02468]|1[02468]|2[024])$')""",
    "kpis": """
        SELECT count(*) AS facilities, count(DISTINCT state) AS states,
               round(sum(hprd * avg_census) / sum(avg_census), 6) AS avg_hprd,
               round(sum(contract_mix * avg_census) / sum(avg_census), 6) AS avg_mix,
               round(CAST(sum(contract_hours_total) FILTER (contract_reliance IS NOT NULL) AS DOUBLE)
                     / sum(certified_beds) FILTER (contract_reliance IS NOT NULL), 6) AS avg_reliance,
               count(*) FILTER (hprd < 3.48) AS below_target,
               round(count(*) FILTER (hprd < 3.48) * 100.0 / count(*), 6) AS below_target_pct
        FROM v_shown""",
    "hist_hprd": _histogram("v_shown", "hprd"),
    "hist_reliance": _histogram("v_clipped", "reliance_disp"),
    "scatter_mix": "SELECT hprd, contract_mix, avg_census, ownership_type, provider_name, state FROM v_shown",
    "scatter_reliance": """
        SELECT round(reliance_disp, 6) AS reliance_disp, contract_mix, avg_census, ownership_type, provider_name, state,
               contract_reliance FROM v_clipped""",
    "by_state": """
        SELECT state, count(*) AS facilities, round(sum(avg_census), 6) AS census,
               round(sum(hprd * avg_census) / sum(avg_census), 6) AS hprd,
               round(sum(contract_mix * avg_census) / sum(avg_census), 6) AS contract_mix
        FROM v_shown WHERE state IS NOT NULL GROUP BY state""",
    "low_hprd": f"SELECT {_RANKED} FROM v_shown ORDER BY hprd, provnum LIMIT 25",
    "high_mix": f"SELECT {_RANKED} FROM v_shown WHERE contract_mix IS NOT NULL ORDER BY contract_mix DESC, provnum LIMIT 25",
    "high_reliance": f"""
        SELECT {_RANKED} FROM v_shown WHERE contract_reliance IS NOT NULL
        ORDER BY contract_reliance DESC, provnum LIMIT 25""",
    "system_trend": """
        SELECT month_key, CAST(month_key // 100 AS VARCHAR) || '-' || lpad(CAST(month_key % 100 AS VARCHAR), 2, '0') AS month,
               sum_hours, sum_census, sum_ctr, CAST(sum_hours AS DOUBLE) / sum_census AS hprd,
               CAST(sum_ctr AS DOUBLE) / CAST(sum_hours AS DOUBLE) AS contract_mix
        FROM (SELECT month_key, sum(sum_hours) AS sum_hours, CAST(sum(sum_census) AS BIGINT) AS sum_census,
                     sum(sum_ctr_hours) AS sum_ctr FROM v_trend GROUP BY month_key)""",
    "thresholds": """
        SELECT round(quantile_cont(hprd, 0.10), 6) AS hprd_p10, round(quantile_cont(contract_mix, 0.90), 6) AS mix_p90
        FROM v_shown""",
    "outliers": """
        SELECT CASE WHEN hprd < 3.0 THEN '🔴 Critical' ELSE '🟠 Serious' END AS "Flag", provnum AS "CCN",
               provider_name AS "Facility", state AS "State", ownership_type AS "Ownership", hprd AS "HPRD",
               contract_mix AS "Contract mix", contract_reliance AS "Contract hrs/bed", avg_census AS "Avg census"
        FROM v_shown
        WHERE hprd < 3.48 OR contract_mix > (SELECT quantile_cont(contract_mix, 0.90) FROM v_shown)""",
    "table_inventory": _INVENTORY,
    "column_dictionary": f"""
        SELECT i.table_name, c.ordinal_position, c.column_name,
               CASE c.data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'FLOAT[]' THEN 'array<float>'
                   WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(c.data_type) END AS data_type,
               c.is_nullable = 'YES' AS is_nullable, n.non_null, i.row_count
        FROM ({_INVENTORY}) i
        JOIN information_schema.columns c ON c.table_name = i.table_name
        JOIN ({_NON_NULL}) n ON n.table_name = c.table_name AND n.column_name = c.column_name""",
    "sample_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100",
    "column_profile": _profile([
        "provnum", "workdate", "mdscensus", "hrs_rn", "hrs_lpn", "hrs_cna", "hrs_rn_ctr", "hrs_lpn_ctr",
        "hrs_cna_ctr", "l_orderkey", "l_linenumber", "l_partkey",
    ]),
    "full_dups": """
        SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS full_dup_rows FROM (
            SELECT count(*) AS n FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)
            GROUP BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
                     l_returnflag, l_linestatus, l_shipdate)""",
    "key_multiplicity": "SELECT provnum, count(*) AS cnt FROM v_raw GROUP BY provnum HAVING count(*) > 1",
    "day_span": """
        SELECT datediff('day', min(strptime(CAST(workdate AS VARCHAR), '%Y%m%d')),
                        max(strptime(CAST(workdate AS VARCHAR), '%Y%m%d'))) AS days FROM v_raw""",
    "grain_test": """
        SELECT candidate, count(n) AS duplicate_keys, count(n) = 0 AS is_grain FROM (
            SELECT 'provnum' AS candidate, NULL AS n
            UNION ALL SELECT 'workdate', NULL UNION ALL SELECT 'provnum+workdate', NULL
            UNION ALL SELECT 'provnum', count(*) FROM v_staffing GROUP BY provnum HAVING count(*) > 1
            UNION ALL SELECT 'workdate', count(*) FROM v_staffing GROUP BY workdate HAVING count(*) > 1
            UNION ALL SELECT 'provnum+workdate', count(*) FROM v_staffing GROUP BY provnum, workdate HAVING count(*) > 1)
        GROUP BY candidate""",
    "incremental_upsert": """
        SELECT *, CAST(workdate // 100 AS INTEGER) AS month_key FROM (
            SELECT t.* FROM v_target t ANTI JOIN v_candidates c ON c.provnum = t.provnum AND c.workdate = t.workdate
            UNION ALL SELECT * FROM v_candidates)""",
}


def _with_views(body: str) -> str:
    """Prefix a query with the views it uses, in dependency order."""
    used: list[str] = []

    def need(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\bv_\w+", text)):
            if name not in used:
                need(_VIEWS[name])
                used.append(name)

    need(body)
    views = ",\n".join(f"{name} AS ({_VIEWS[name]})" for name in used)
    return f"WITH {views}\n{body}" if views else body


ORACLES = {name: _with_views(body) for name, body in _BODIES.items()}
