"""SQL (DuckDB) over the given tables that has to give the same rows as the query of that name."""

from __future__ import annotations

from probelake import fixed

CHECKED_EVENTS = """
checked AS (
  SELECT event_id, user_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS error_value,
         strftime(ts, '%Y-%m-%d') AS day
  FROM events)
"""

LABELLED = "labelled AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"

LABEL_KEYS = f"""
WITH {LABELLED},
keyed AS (SELECT doc_id, md5(lang || quality::VARCHAR || source) AS row_id FROM labelled)
"""

FILES = """
objects AS (
  SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS source_date,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'BR' WHEN '2-HIGH' THEN 'DE' WHEN '3-MEDIUM' THEN 'RU'
              WHEN '4-NOT SPECIFIED' THEN 'US' WHEN '5-LOW' THEN 'FR' END AS country,
         CASE WHEN o_orderstatus = 'P' THEN 'dash' ELSE 'web_connectivity' END AS test_type,
         strftime(o_orderdate, '%Y%m%d') AS stamp, o_custkey, o_orderkey,
         CAST(round(o_totalprice * 100) AS BIGINT) / 1048576.0::DOUBLE AS size_mb
  FROM orders),
files AS (
  SELECT source_date, country, test_type, size_mb,
         stamp || '-' || country || '-AS' || o_custkey || '-' || test_type || '-' || o_orderkey || '.json' AS name
  FROM objects)
"""

COUNTRY_OF_EVENT = """
CASE event_type WHEN 'click' THEN 'BR' WHEN 'view' THEN 'RU' WHEN 'purchase' THEN 'US'
     WHEN 'signup' THEN 'DE' WHEN 'error' THEN 'FR' END
"""

TRUSTED_COLUMNS = """
'm' || event_id AS id, input, CASE WHEN event_type <> 'signup' THEN 'AS' || user_id END AS probe_asn,
country AS probe_cc, user_id || '.' || k || '.0.1' AS probe_ip, 'r' || user_id AS report_id,
'web_connectivity' AS test_name, value AS test_runtime,
CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END AS blocking, event_type AS platform,
md5('m' || event_id || ts::VARCHAR || input) AS row_id, CAST(ts AS DATE) AS bucket_date
"""

TIMES = """
ts::VARCHAR AS measurement_start_time, date_trunc('second', ts)::VARCHAR AS test_start_time
"""

MEASUREMENTS = f"""
measured AS (
  SELECT e.*, json_extract_string(props, '$.k') AS k, html, {COUNTRY_OF_EVENT} AS country,
         coalesce(url, 'https://' || event_type || '.example.org/' || user_id) AS input
  FROM events e LEFT JOIN pages ON event_id = page_id),
trusted AS (
  SELECT {TRUSTED_COLUMNS}, {TIMES}, k, user_id, html,
         regexp_matches(user_id || '.' || k || '.0.1', '{fixed.IPV4_PATTERN}') AS ip_matches,
         regexp_matches(input, '{fixed.URL_PATTERN}') AS url_matches
  FROM measured)
"""



def _netloc(url: str) -> str:
    return f"regexp_extract({url}, '{fixed.NETLOC_PATTERN}', 1)"


def _title(body: str) -> str:
    return f"regexp_extract(coalesce({body}, ''), '{fixed.TITLE_PATTERN}', 1, 'is')"


NETLOC = _netloc("input")
TITLE = _title("html")
META_TITLE = "regexp_extract(coalesce({}, ''), '" + fixed.META_TITLE_PATTERN + "', 1, 'is')"

SCALARS = """
id, input, probe_asn, probe_cc, probe_ip, report_id, test_name, test_runtime, blocking, platform, row_id,
bucket_date, measurement_start_time, test_start_time
"""

DELIVERY = f"""
{SCALARS}, '10.' || user_id || '.' || k || '.1,-,172.16.0.' || k AS dns_resolved_ips_full,
'10.' || user_id || '.' || k || '.1,172.16.0.' || k AS dns_resolved_ips,
{TITLE} AS http_title, {META_TITLE.format('html')} AS http_meta_title, {NETLOC} AS domain
"""

# Rows that stay after the checks of their landing folder (the day).
REPAIRED_BY_DAY = """
shares AS (
  SELECT *, avg(CASE WHEN probe_asn IS NULL THEN 0.0 ELSE 1.0 END) OVER (PARTITION BY bucket_date) AS asn_share,
         min(CASE WHEN probe_cc IN ('BR', 'RU', 'US', 'DE') THEN 1 ELSE 0 END)
           OVER (PARTITION BY bucket_date) AS all_contained
  FROM trusted),
repaired AS (
  SELECT * FROM shares
  WHERE (asn_share >= 0.9 OR probe_asn IS NOT NULL)
    AND (all_contained = 1 OR probe_cc IN ('BR', 'RU', 'US', 'DE')))
"""

WORDS = "string_split(text, ' ')"
FULL = f"list_transform({WORDS}, lambda w: CASE WHEN length(w) > 4 THEN w END)"
IPS = f"list_filter({FULL}, lambda w: w IS NOT NULL)"


def _event_report(by: str) -> str:
    """Constraint rows of the event checks, over all events or per group."""
    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    per_value = f"{key}event_id"
    metrics = [
        ("Completeness(user_id)", "count(user_id) / count(*)::DOUBLE >= 0.9", "checked"),
        ("Completeness(error_value)", "count(error_value) / count(*)::DOUBLE >= 0.9", "checked"),
        (
            "Containment(event_type in [click,view,purchase,signup])",
            "avg(CASE WHEN event_type IS NULL OR event_type IN ('click', 'view', 'purchase', 'signup')"
            " THEN 1.0 ELSE 0.0 END) >= 1",
            "checked",
        ),
        ("Size()", "count(*) > 0", "checked"),
        (
            "Uniqueness(event_id)",
            "sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) = sum(n)",
            f"(SELECT {per_value}, count(*) AS n FROM checked WHERE event_id IS NOT NULL GROUP BY {per_value})",
        ),
    ]
    rows = " UNION ALL ".join(
        f"SELECT {key}'{text}' AS \"constraint\", {holds} AS holds FROM {source} {group}"
        for text, holds, source in metrics
    )
    whole = f"OVER (PARTITION BY {by})" if by else "OVER ()"
    return f"""
    WITH {CHECKED_EVENTS}, judged AS ({rows})
    SELECT {key}'Review Check' AS "check", 'Warning' AS check_level,
           CASE WHEN bool_and(holds) {whole} THEN 'Success' ELSE 'Warning' END AS check_status,
           "constraint", CASE WHEN holds THEN 'Success' ELSE 'Failure' END AS constraint_status
    FROM judged"""


def _share(condition: str) -> str:
    return f"avg(CASE WHEN {condition} THEN 1.0 ELSE 0.0 END)"


def _complete(column: str, table: str) -> str:
    return (
        f"SELECT 'Completeness({column})' AS \"constraint\", count({column}) / count(*)::DOUBLE AS metric"
        f" FROM {table}"
    )


def _unique(column: str) -> str:
    return (
        f"SELECT 'Uniqueness({column})' AS \"constraint\","
        f" sum(CASE WHEN n = 1 THEN 1 ELSE 0 END)::DOUBLE / sum(n)::DOUBLE AS metric"
        f" FROM (SELECT {column}, count(*) AS n FROM events GROUP BY 1)"
    )


def _contained(allowed: list[str]) -> str:
    listed = ", ".join(f"'{a}'" for a in allowed)
    return (
        f"SELECT 'Containment(event_type in [{','.join(allowed)}])' AS \"constraint\","
        f" avg(CASE WHEN event_type IS NULL OR event_type IN ({listed}) THEN 1.0 ELSE 0.0 END) AS metric FROM events"
    )


QUALITY_LOG_TEXTS = [
    ("Uniqueness(row_id)", "n_keys = n_rows"),
    ("Completeness(id)", "id_share >= 0.9"),
    ("Completeness(probe_asn)", "asn_share >= 0.9"),
    ("Completeness(probe_cc)", "cc_share >= 0.98"),
    ("Completeness(probe_ip)", "ip_share >= 0.9"),
    ("Completeness(test_start_time)", "test_share >= 0.9"),
    ("Completeness(test_name)", "name_share >= 0.9"),
    ("Completeness(bucket_date)", "date_share >= 0.98"),
    ("Completeness(measurement_start_time)", "start_share >= 0.9"),
    ("Containment(probe_cc in [BR,RU,US,DE])", "all_contained = 1"),
    ("Size()", "n_rows > 0"),
]


# Columns of the trusted table that are text in the document, at its top or below.
PLAIN_PROJECTED = (
    "id", "input", "probe_asn", "probe_cc", "probe_ip", "report_id", "software_name", "software_version",
    "test_name", "test_version",
)
NESTED_PROJECTED = ("control_failure", "blocking", "http_experiment_failure", "dns_experiment_failure")


def _scanned(limit: float, numbered: str) -> str:
    """CTEs that take the files of ``numbered`` (n from 1 in each group) one after the other, up to ``limit``."""
    return f"""
        {numbered},
        scan AS (
          SELECT source_date, country, name, size_mb, n, size_mb <= {limit} AS taken,
                 CASE WHEN size_mb <= {limit} THEN size_mb ELSE 0 END AS used
          FROM numbered WHERE n = 1
          UNION ALL
          SELECT f.source_date, f.country, f.name, f.size_mb, f.n, s.used + f.size_mb <= {limit},
                 CASE WHEN s.used + f.size_mb <= {limit} THEN s.used + f.size_mb ELSE s.used END
          FROM scan s JOIN numbered f
            ON f.source_date = s.source_date AND f.country = s.country AND f.n = s.n + 1)"""


def _first_fit(limit: float, least: float) -> str:
    """The files that fit one after the other, up to ``limit`` in each group."""
    numbered = f"""numbered AS (
          SELECT *, row_number() OVER (PARTITION BY source_date, country ORDER BY name) AS n FROM files
          WHERE test_type = 'web_connectivity' AND country IN ('BR', 'DE', 'RU', 'US') AND size_mb >= {least})"""
    return f"""
        WITH RECURSIVE {FILES}, {_scanned(limit, numbered)}
        SELECT source_date, country, 'archive/jsonl/' || source_date || '/' || name AS key, size_mb
        FROM scan WHERE taken"""


_MISSES = """placed AS (
          SELECT year(o_orderdate)::VARCHAR AS source_date, o_orderpriority AS country,
                 row_number() OVER (PARTITION BY year(o_orderdate), o_orderpriority ORDER BY o_orderkey) AS n
          FROM orders),
        numbered AS (
          SELECT source_date, country, n, lpad((n - 1)::VARCHAR, 9, '0') AS name,
                 CASE WHEN (n - 1) % 51 = 0 THEN 0.25::DOUBLE
                      ELSE greatest(8 - 0.25::DOUBLE * ((n - 1) // 51 + 1), 0.25) + (1 + (n - 1) % 3) / 1024.0::DOUBLE
                 END AS size_mb
          FROM placed)"""


def _quality_log() -> str:
    """The log of a run over all measurements, as it is after the checks."""
    return f"""
        WITH {MEASUREMENTS}, {REPAIRED_BY_DAY},
        days AS (
          SELECT bucket_date, count(*) AS n_rows, count(DISTINCT row_id) AS n_keys,
                 min(asn_share) AS asn_share, min(all_contained) AS all_contained,
                 count(id) / n_rows::DOUBLE AS id_share, count(probe_cc) / n_rows::DOUBLE AS cc_share,
                 count(probe_ip) / n_rows::DOUBLE AS ip_share, count(test_name) / n_rows::DOUBLE AS name_share,
                 count(test_start_time) / n_rows::DOUBLE AS test_share,
                 count(bucket_date) / n_rows::DOUBLE AS date_share,
                 count(measurement_start_time) / n_rows::DOUBLE AS start_share
          FROM shares GROUP BY bucket_date),
        judged AS ({' UNION ALL '.join(
            f"SELECT bucket_date, '{text}' AS \"constraint\", {holds} AS holds FROM days"
            for text, holds in QUALITY_LOG_TEXTS)})
        SELECT 'Review Check' AS "check", 'Warning' AS check_level,
               CASE WHEN bool_and(holds) OVER (PARTITION BY bucket_date) THEN 'Success' ELSE 'Warning' END
                 AS check_status, "constraint",
               CASE WHEN holds THEN 'Success' ELSE 'Failure' END AS constraint_status,
               strftime(bucket_date, '%Y-%m-%d') AS bucket_date, 'run' AS run_id
        FROM judged"""


ORACLES: dict[str, str] = {
    "project_nested": """
        SELECT event_id AS id, event_type AS blocking,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS platform
        FROM events""",
    "first_element": """
        SELECT doc_id, CASE WHEN lang <> 'fr' THEN string_split(text, chr(10))[1] END AS first_line,
               CASE WHEN lang <> 'fr' THEN string_split(text, chr(10))[1] ELSE '' END AS body
        FROM documents""",
    "cast_dates": """
        WITH texts AS (
          SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending'
                                  WHEN o_orderpriority <> '5-LOW' THEN o_orderdate::VARCHAR END AS text
          FROM orders)
        SELECT o_orderkey, try_cast(text AS DATE) AS order_date,
               try_cast(text AS TIMESTAMP)::VARCHAR AS order_time
        FROM texts""",
    "row_id": "SELECT event_id, md5(event_id::VARCHAR || ts::VARCHAR || event_type) AS row_id FROM events",
    "drop_rename": """
        SELECT c_custkey AS id, c_name, c_nationkey, c_mktsegment AS segment, '2020-01-01' AS bucket_date
        FROM customer""",
    "dedup_first": """
        SELECT doc_id, lang, source, md5(text) AS row_id FROM documents
        QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1""",
    "dedup_null_collapse": f"""{LABEL_KEYS}
        SELECT doc_id, row_id FROM keyed
        QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY doc_id) = 1""",
    "dedup_null_keep": f"""{LABEL_KEYS}
        SELECT doc_id, row_id FROM keyed
        QUALIFY row_id IS NULL OR row_number() OVER (PARTITION BY row_id ORDER BY doc_id) = 1""",
    "dedup_arbitrary": f"{LABEL_KEYS} SELECT DISTINCT row_id FROM keyed",
    "completeness": f"""
        WITH {LABELLED}
        SELECT 'Size()' AS "constraint", count(*)::DOUBLE AS metric FROM labelled
        UNION ALL {_complete('doc_id', 'labelled')}
        UNION ALL {_complete('quality', 'labelled')}
        UNION ALL {_complete('toxic', 'labelled')}
        UNION ALL {_complete('lang', 'labelled')}""",
    "uniqueness": " UNION ALL ".join(_unique(c) for c in ("event_id", "user_id", "ts")),
    "containment": " UNION ALL ".join(
        _contained(allowed)
        for allowed in (
            ["click", "view", "purchase"],
            ["click", "view", "purchase", "signup", "error"],
        )
    ),
    "quality_report": f"SELECT *, '2024-01' AS bucket_date FROM ({_event_report('')})",
    "quality_failures": f"""
        SELECT "constraint", constraint_status FROM ({_event_report('')})
        WHERE constraint_status <> 'Success'""",
    "quality_report_by_day": f"""
        SELECT day, check_status, "constraint", constraint_status FROM ({_event_report('day')})""",
    "remediate": f"""
        WITH {LABELLED},
        failed AS (SELECT count(quality) / count(*)::DOUBLE < 0.9 AS no_quality,
                          {_share("lang IN ('en', 'de')")} < 1 AS bad_lang FROM labelled)
        SELECT doc_id, lang, quality, toxic FROM labelled, failed
        WHERE (NOT no_quality OR quality IS NOT NULL)
          AND (NOT bad_lang OR lang IN ('en', 'de'))""",
    "remediate_substring": f"""
        WITH {LABELLED},
        flagged AS (SELECT CASE WHEN lang <> 'es' THEN doc_id END AS id,
                           CASE WHEN quality = 1 THEN true END AS is_valid, lang FROM labelled),
        failed AS (SELECT count(id) / count(*)::DOUBLE < 0.5 AS no_id,
                          count(is_valid) / count(*)::DOUBLE < 0.9 AS no_valid FROM flagged)
        SELECT id, is_valid, lang FROM flagged, failed
        WHERE (NOT (no_id OR no_valid) OR id IS NOT NULL) AND (NOT no_valid OR is_valid IS NOT NULL)""",
    "remediate_by_day": f"""
        WITH {CHECKED_EVENTS},
        judged AS (
          SELECT *, {_share("error_value IS NOT NULL")} OVER (PARTITION BY day) < 0.8 AS no_value,
                 {_share("event_type IN ('click', 'error')")} OVER (PARTITION BY day) < 1 AS bad_type
          FROM checked)
        SELECT event_id, user_id, event_type, error_value, day FROM judged
        WHERE (NOT no_value OR error_value IS NOT NULL)
          AND (NOT bad_type OR event_type IN ('click', 'error'))""",
    "remediate_passthrough": "SELECT event_id, event_type, value FROM events",
    "whitelist": "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')",
    "ip_valid": f"""
        WITH addressed AS (
          SELECT event_id, user_id || '.' || json_extract_string(props, '$.k') || '.' ||
                 (extract(second FROM ts) * 5)::BIGINT || '.' || extract(minute FROM ts) AS probe_ip
          FROM events)
        SELECT event_id, probe_ip,
               CASE WHEN regexp_matches(probe_ip, '{fixed.IPV4_PATTERN}') THEN true END AS is_ip_valid
        FROM addressed""",
    "url_valid": f"""
        SELECT page_id,
               CASE WHEN regexp_matches(url, '{fixed.URL_PATTERN}') THEN true END AS is_url_valid
        FROM pages""",
    "netloc": f"""
        SELECT page_id, {_netloc('url')} AS domain,
               {_netloc("replace(url, '://', '://me:secret@')")} AS with_user,
               {_netloc('url')} || ':8080' AS with_port, {_netloc('url')} AS without_scheme,
               '' AS path_only, '' AS bracket, {_netloc('url')} AS blanks
        FROM pages""",
    "http_title": f"""
        SELECT page_id, {_title('html')} AS http_title, {_title('html')} AS in_capitals,
               {_title("replace(html, '</title>', '<title>')")} AS unclosed,
               {_title("html || html")} AS two_titles
        FROM pages""",
    "meta_title": f"""
        WITH tagged AS (
          SELECT page_id, html, replace(html, '</title>', '</title><meta charset="x"><META property="og:title"'
                 || chr(10) || ' content="' || url || '">') AS tagged FROM pages)
        SELECT page_id, {META_TITLE.format('tagged')} AS http_meta_title,
               {META_TITLE.format('html')} AS without_tag FROM tagged""",
    "dns_ips": f"""
        SELECT doc_id, len({FULL}) AS n_full, len({IPS}) AS n_ips,
               md5(coalesce(array_to_string({IPS}, ','), '')) AS ips FROM documents""",
    "dns_ips_nested": f"""
        WITH words AS (SELECT doc_id, lang, {FULL} AS full_list FROM documents),
        shown AS (SELECT *, array_to_string(list_transform(full_list, lambda w: coalesce(w, '-')), ',') AS ips
                  FROM words)
        SELECT doc_id, 2::BIGINT AS n_full, CASE WHEN lang = 'fr' THEN 1 ELSE 2 END::BIGINT AS n_ips,
               md5(CASE WHEN lang = 'fr' THEN ips ELSE ips || ',' || ips END) AS ips FROM shown""",
    "manifest_parse": f"""
        WITH {FILES}
        SELECT 'archive/jsonl/' || source_date || '/' || name AS key, source_date, country, test_type, size_mb,
               source_date || '/' || name AS dest_key
        FROM files
        WHERE test_type = 'web_connectivity' AND country IN ('BR', 'DE', 'RU', 'US') AND size_mb >= 1.5""",
    "date_prefixes": f"WITH {FILES} SELECT DISTINCT source_date FROM files",
    "anti_landed": """
        SELECT 'd/' || doc_id AS dest_key, lang FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "budget_select": _first_fit(100, 0.3),
    "budget_rounds": _first_fit(4, 0.01),
    "budget_misses": f"""
        WITH RECURSIVE {_scanned(8, _MISSES)}
        SELECT source_date, country, name AS key, size_mb FROM scan WHERE taken""",
    "landing": """
        SELECT strftime(ts, '%Y-%m-%d') AS source_date,
               '{"event_id":' || event_id || ',"event_type":"' || event_type || '","value":' || value || '}' AS line,
               1::BIGINT AS copies
        FROM events WHERE event_type <> 'error'""",
    "partition_roundtrip": """
        SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus
        FROM orders""",
    "dynamic_overwrite": """
        SELECT event_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN -value ELSE value END AS value,
               CAST(ts AS DATE) AS bucket_date
        FROM events WHERE ts < TIMESTAMP '2024-01-16' OR event_type = 'purchase'""",
    "static_overwrite": """
        SELECT event_id, event_type, value, CAST(ts AS DATE) AS bucket_date
        FROM events WHERE event_type = 'error'""",
    "append_log": f"""
        WITH report AS ({_event_report('')})
        SELECT *, 'first' AS run_id FROM report UNION ALL SELECT *, 'second' AS run_id FROM report""",
    "catalog_repair": """
        SELECT event_id, event_type, value, CAST(ts AS DATE) AS bucket_date, 0::BIGINT AS rows_before_repair
        FROM events""",
    "json_scan": """
        SELECT CASE WHEN ok THEN event_id::VARCHAR END AS id,
               CASE WHEN ok THEN CASE WHEN error THEN 'true' ELSE 'false' END END AS accessible,
               CASE WHEN ok THEN '{"k":' || json_extract_string(props, '$.k') || '}' END AS blocking,
               CASE WHEN ok THEN value END AS body_proportion,
               CASE WHEN ok THEN CASE WHEN error THEN 'many' ELSE user_id::VARCHAR END END AS title_match,
               NULL::BIGINT AS retries,
               CASE WHEN ok THEN event_type || ',y' END AS options
        FROM (SELECT *, event_type <> 'view' AS ok, event_type = 'error' AS error FROM events)""",
    "trusted_table": f"""
        WITH {MEASUREMENTS}
        SELECT {SCALARS}, 'A,CNAME,A' AS answer_types, md5(coalesce(html, '')) AS body, user_id AS port
        FROM trusted""",
    "trusted_table_gen1": f"""
        WITH {MEASUREMENTS}
        SELECT {SCALARS}, 1::BIGINT AS n_queries, CASE WHEN ip_matches THEN true END AS is_ip_valid,
               CASE WHEN url_matches THEN true END AS is_url_valid
        FROM trusted""",
    "delivery_table": f"WITH {MEASUREMENTS} SELECT {DELIVERY} FROM trusted",
    "lake_run": f"WITH {MEASUREMENTS}, {REPAIRED_BY_DAY} SELECT {DELIVERY} FROM repaired",
    "lake_run_gen1": f"""
        WITH {MEASUREMENTS},
        failed AS (
          SELECT {_share("probe_asn IS NOT NULL")} < 0.9 AS no_asn, {_share("ip_matches")} < 0.9 AS no_ip,
                 {_share("url_matches")} < 0.9 AS no_url,
                 {_share("probe_cc IN ('BR', 'CN', 'FR', 'RU', 'GB', 'US', 'DE', 'IN', 'AR')")} < 1 AS bad_cc
          FROM trusted)
        SELECT {SCALARS}, CASE WHEN ip_matches THEN true END AS is_ip_valid,
               CASE WHEN url_matches THEN true END AS is_url_valid, {NETLOC} AS domain,
               '10.' || user_id || '.' || k || '.1,-,172.16.0.' || k AS dns_resolved_ips_full
        FROM trusted, failed
        WHERE (NOT no_asn OR probe_asn IS NOT NULL) AND (NOT no_ip OR ip_matches)
          AND (NOT no_url OR url_matches)
          AND (NOT bad_cc OR probe_cc IN ('BR', 'CN', 'FR', 'RU', 'GB', 'US', 'DE', 'IN', 'AR'))""",
    "serving_table": f"""
        WITH {MEASUREMENTS}, {REPAIRED_BY_DAY}
        SELECT id, probe_cc, probe_asn, test_name, platform, {NETLOC} AS domain, {TITLE} AS http_title,
               bucket_date
        FROM repaired""",
    "quality_log": _quality_log(),
    "empty_folders": f"""
        SELECT "constraint", constraint_status, bucket_date, run_id FROM ({_quality_log()})
        UNION ALL
        SELECT unnest([{", ".join(f"'{text}'" for text, _ in QUALITY_LOG_TEXTS)}]), 'Failure', '1999-01-01', 'run'""",
    "stream_unique": """
        WITH timed AS (
          SELECT 'm' || event_id AS id, event_type AS platform, CAST(ts AS DATE) AS bucket_date,
                 date_trunc('second', ts) AS t FROM events),
        mark AS (
          SELECT max(t) - INTERVAL 5 DAYS AS w FROM timed
          WHERE bucket_date >= DATE '2024-01-11' AND bucket_date < DATE '2024-01-21'),
        found AS (
          SELECT id, platform, bucket_date, t FROM timed
          UNION ALL
          SELECT id, platform, bucket_date, t + INTERVAL 12 DAYS FROM timed, mark
          WHERE bucket_date < DATE '2024-01-11' AND platform = 'purchase'
            AND t + INTERVAL 12 DAYS >= w AND t + INTERVAL 5 DAYS <= w)
        SELECT id, platform, bucket_date, strftime(t, '%Y-%m-%d %H:%M:%S') AS test_start_time FROM found""",
    "all_projected": f"""
        SELECT {", ".join(f"'{c}-' || event_id AS {c}" for c in PLAIN_PROJECTED)},
               event_id AS status_code, value AS test_runtime, event_type AS platform,
               {", ".join(f"'{c}/' || event_id AS {c}" for c in NESTED_PROJECTED)}
        FROM events""",
    "quality_messages": f"""
        WITH {LABELLED},
        named AS (SELECT quality, CASE WHEN lang <> 'es' THEN lang END AS lang FROM labelled),
        counts AS (SELECT quality, count(*) AS n FROM named WHERE quality IS NOT NULL GROUP BY quality),
        metrics AS (
          SELECT 'Completeness(quality)' AS "constraint", count(quality) / count(*)::DOUBLE AS metric FROM named
          UNION ALL SELECT 'Uniqueness(quality)', sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) / sum(n)::DOUBLE FROM counts
          UNION ALL SELECT 'Containment(lang in [en,de,fr])',
                           avg(CASE WHEN lang IS NULL OR lang IN ('en', 'de', 'fr') THEN 1.0 ELSE 0.0 END) FROM named
          UNION ALL SELECT 'Containment(lang in [en])',
                           avg(CASE WHEN lang IS NULL OR lang = 'en' THEN 1.0 ELSE 0.0 END) FROM named)
        SELECT "constraint", CASE WHEN metric >= 0.9 AND ("constraint" NOT LIKE 'Con%' OR metric >= 1) THEN 'Success'
                                  ELSE 'Failure' END AS constraint_status,
               CASE WHEN constraint_status = 'Success' THEN ''
                    ELSE 'Value: # does not meet the constraint requirement!' END AS words,
               CASE WHEN constraint_status = 'Failure' THEN metric END AS metric
        FROM metrics""",
    "dedup_broken_copy": f"WITH {MEASUREMENTS} SELECT {SCALARS} FROM trusted",
    "run_ids": """
        SELECT strftime(ts, '%Y-%m-%d') AS bucket_date, true AS is_time, 22::BIGINT AS n_rows, 2::BIGINT AS n_runs
        FROM events GROUP BY 1""",
    "rerun_same_id": f"""
        WITH {MEASUREMENTS}, {REPAIRED_BY_DAY} SELECT id, bucket_date, 11::BIGINT AS n_log FROM repaired""",
    "stale_dates": f"""
        WITH {MEASUREMENTS}, {REPAIRED_BY_DAY}
        SELECT place, id, bucket_date FROM repaired, (VALUES ('trusted'), ('delivery')) AS places(place)
        WHERE bucket_date > (SELECT min(bucket_date) FROM trusted)""",
    "incremental_by_folder": f"""
        WITH {MEASUREMENTS},
        foldered AS (SELECT *, bucket_date <= DATE '2024-01-15' AS first_half FROM trusted),
        shares AS (
          SELECT *, {_share("probe_asn IS NOT NULL")} OVER (PARTITION BY first_half) AS asn_share,
                 min(CASE WHEN probe_cc IN ('BR', 'RU', 'US', 'DE') THEN 1 ELSE 0 END)
                   OVER (PARTITION BY first_half) AS all_contained
          FROM foldered)
        SELECT {SCALARS.replace(', measurement_start_time, test_start_time', '')}, files_per_batch
        FROM shares, (VALUES (1::BIGINT), (1000::BIGINT)) AS batches(files_per_batch)
        WHERE (asn_share >= 0.9 OR probe_asn IS NOT NULL)
          AND (all_contained = 1 OR probe_cc IN ('BR', 'RU', 'US', 'DE'))""",
    # Every delivery fails the check on the network (no sign-up has one) and on the country (errors).
    "incremental_stream": f"""
        WITH {MEASUREMENTS}
        SELECT {SCALARS.replace(', measurement_start_time, test_start_time', '')} FROM trusted
        WHERE probe_asn IS NOT NULL AND probe_cc IN ('BR', 'RU', 'US', 'DE')""",
}
