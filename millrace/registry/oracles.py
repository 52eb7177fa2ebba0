"""What each query must return, as SQL over the same tables.

Written from the meaning of each operator, not from the Spark code. Engine used for
the check: DuckDB; regexes are limited to syntax both engines share.
"""

from __future__ import annotations

DIRTY = """dirty AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
         CASE WHEN o_orderkey % 89 = 0 THEN NULL
              WHEN o_orderkey % 53 = 0 THEN 'bad' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate,
         CASE WHEN o_orderkey % 61 = 0 THEN NULL
              WHEN o_orderkey % 41 = 0 THEN 'BAD' ELSE o_orderpriority END AS o_orderpriority,
         CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'NULL'
              WHEN 3 THEN 'none' WHEN 4 THEN 'us' ELSE 'EU' END AS domicile
  FROM orders)"""

REPAIRED = DIRTY + """, repaired AS (
  SELECT * REPLACE (CASE WHEN domicile IS NULL OR lower(domicile) IN ('', 'null', 'none')
                         THEN 'global' ELSE domicile END AS domicile) FROM dirty)"""

FLAGGED = DIRTY + """, flagged AS (
  SELECT *, o_custkey IS NULL AS f1,
         coalesce(NOT regexp_matches(o_orderstatus, '^[FOP]$'), false) AS f2,
         coalesce(NOT regexp_matches(o_orderpriority, '^[1-5]-'), false) AS f3 FROM dirty)"""

CASCADED = DIRTY + """, step1 AS (SELECT * FROM dirty WHERE o_custkey IS NOT NULL),
step2 AS (SELECT * FROM step1 WHERE regexp_matches(o_orderstatus, '^[FOP]$')),
step3 AS (SELECT * FROM step2 WHERE regexp_matches(o_orderpriority, '^[1-5]-')),
bad1 AS (SELECT * FROM dirty WHERE o_custkey IS NULL),
bad2 AS (SELECT * FROM step1 WHERE NOT regexp_matches(o_orderstatus, '^[FOP]$')),
bad3 AS (SELECT * FROM step2 WHERE NOT regexp_matches(o_orderpriority, '^[1-5]-'))"""

ORDER_COLUMNS = (
    "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, domicile"
)
REASONS = """concat_ws(',', CASE WHEN f1 THEN 'o_custkey:null' END,
         CASE WHEN f2 THEN 'o_orderstatus:regex' END,
         CASE WHEN f3 THEN 'o_orderpriority:regex' END) AS dq_reasons"""
FLAG_REJECT = f"SELECT {ORDER_COLUMNS} FROM flagged WHERE f1 OR f2 OR f3"
FLAG_REASONED = f"SELECT {ORDER_COLUMNS}, {REASONS} FROM flagged WHERE f1 OR f2 OR f3"
TWO_HOURS = f"""WITH {FLAGGED}
SELECT *, '2024-03-05' AS dt, '07' AS hr FROM ({FLAG_REASONED})
UNION ALL SELECT *, '2024-03-05' AS dt, '08' AS hr FROM ({FLAG_REASONED})"""


def _merge(key: str) -> str:
    """Upsert of the order batch into the order history, keyed by ``key`` and tag."""
    return f"""WITH tagged AS (
  SELECT {key} AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         o_orderpriority, CASE o_orderstatus WHEN 'F' THEN 'eu' WHEN 'O' THEN 'us'
         ELSE 'apac' END AS domicile FROM orders),
history AS (SELECT * FROM tagged
            WHERE o_orderdate < TIMESTAMP '1999-01-01' OR o_orderstatus = 'F'),
batch AS (SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM tagged
          WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus <> 'F')
SELECT * FROM history t WHERE NOT EXISTS (
  SELECT 1 FROM batch s WHERE s.o_orderkey = t.o_orderkey AND s.domicile = t.domicile)
UNION ALL SELECT * FROM batch"""


def _latest(rows: str, keys: str, order: str) -> str:
    return f"""SELECT * EXCLUDE (rank_in_key) FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rank_in_key
  FROM {rows}) WHERE rank_in_key = 1"""


LINE_ORDER = (
    "l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST"
)
LATEST_LINES = _latest("lineitem", "l_orderkey, l_linenumber", LINE_ORDER)

LOADED = f"""WITH loaded AS (
  SELECT l_orderkey AS order_key, l_partkey, l_suppkey, l_linenumber AS line_number,
         l_quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, l_discount, l_tax,
         l_returnflag AS return_flag, l_linestatus, l_shipdate, 'global' AS domicile
  FROM ({_latest("(SELECT * FROM lineitem WHERE l_quantity >= 10)",
                 "l_orderkey, l_linenumber", LINE_ORDER)}))"""

APPENDED = (
    "SELECT *, 'global' AS domicile FROM ("
    + _latest(
        "lineitem",
        "l_orderkey, l_linenumber, l_shipdate < TIMESTAMP '2000-01-01'",
        LINE_ORDER,
    )
    + ")"
)

STAGED = "SELECT *, '2024-03-05' AS load_dt, {hour} AS load_hr FROM orders"

ORACLES = {
    "scan_parquet": "SELECT * FROM orders",
    "scan_csv": "SELECT * FROM customer",
    "scan_csv_inferred": "SELECT * REPLACE (CAST(c_custkey AS INTEGER) AS c_custkey) FROM customer",
    "scan_csv_partly_declared": """SELECT * REPLACE (
        lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS c_nationkey) FROM customer""",
    "scan_json": "SELECT * REPLACE (CAST(c_nationkey AS BIGINT) AS c_nationkey) FROM customer",
    "scan_orc": "SELECT * FROM customer",
    "scan_csv_two_headers": """SELECT * REPLACE (
        CASE WHEN c_custkey % 2 = 1 THEN c_nationkey END AS c_nationkey) FROM customer""",
    "scan_parquet_mixed": """SELECT * REPLACE (CAST(o_custkey AS VARCHAR) AS o_custkey,
        CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority) FROM orders""",
    "schema_report_files": """SELECT * FROM (
        SELECT 'o_orderpriority' AS "column", 'missing' AS issue, CAST(NULL AS VARCHAR) AS found,
            'string' AS expected, count(*) AS rows FROM orders WHERE o_orderkey % 2 = 0
        UNION ALL SELECT 'o_custkey', 'type', 'bigint', 'string', count(*)
            FROM orders WHERE o_orderkey % 2 = 0) WHERE rows > 0""",
    "source_count": "SELECT count(*) AS rows FROM orders",
    "filter_sql": "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000",
    "rename": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        o_orderstatus AS o_orderpriority, o_totalprice, o_orderdate,
        o_orderpriority AS o_orderstatus FROM orders""",
    "cast_types": """SELECT l_orderkey, l_partkey, l_suppkey,
        CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity,
        CAST(l_extendedprice AS DECIMAL(10,2)) AS price, l_discount, l_tax,
        TRY_CAST(l_returnflag AS INTEGER) AS flag_number, l_linestatus,
        CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM lineitem""",
    "domicile_add": "SELECT *, 'emea' AS domicile FROM orders",
    "domicile_repair": f"WITH {REPAIRED} SELECT * FROM repaired",
    "domicile_normalize": f"""WITH {DIRTY}
        SELECT * REPLACE (CASE WHEN domicile IS NULL
            OR lower(trim(domicile)) IN ('', 'null', 'none')
            THEN 'global' ELSE lower(trim(domicile)) END AS domicile) FROM dirty""",
    "mask_sensitive": """SELECT c_custkey, '********' AS c_name, c_nationkey,
        '#####' AS c_acctbal, 'XXX-CONFIDENTIAL-XXX' AS c_mktsegment FROM customer""",
    "dedupe_latest": LATEST_LINES,
    "dedupe_null_key": f"WITH {DIRTY} "
    + _latest("dirty", "o_custkey", "o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST"),
    "dedupe_noop": "SELECT * FROM lineitem",
    "dq_notnull": f"WITH {DIRTY} SELECT * FROM dirty WHERE o_custkey IS NOT NULL",
    "dq_regex": f"""WITH {DIRTY} SELECT * FROM dirty
        WHERE regexp_matches(o_orderstatus, '^[FOP]$')""",
    "dq_cascade_valid": f"WITH {CASCADED} SELECT * FROM step3",
    "dq_cascade_reject": f"""WITH {CASCADED} SELECT * FROM bad1
        UNION ALL SELECT * FROM bad2 UNION ALL SELECT * FROM bad3""",
    "dq_flag_valid": f"""WITH {FLAGGED} SELECT {ORDER_COLUMNS} FROM flagged
        WHERE NOT f1 AND NOT f2 AND NOT f3""",
    "dq_flag_reject": f"WITH {FLAGGED} {FLAG_REJECT}",
    "dq_reject_reasons": f"WITH {FLAGGED} {FLAG_REASONED}",
    "dq_rule_counts": f"""WITH {CASCADED}, counted AS (
        SELECT 'o_custkey:null' AS rule, (SELECT count(*) FROM bad1) AS rows
        UNION ALL SELECT 'o_orderstatus:regex', (SELECT count(*) FROM bad2)
        UNION ALL SELECT 'o_orderpriority:regex', (SELECT count(*) FROM bad3)
        UNION ALL SELECT 'lost', (SELECT count(*) FROM dirty) - (SELECT count(*) FROM step3)
            - (SELECT count(*) FROM bad1) - (SELECT count(*) FROM bad2)
            - (SELECT count(*) FROM bad3))
        SELECT * FROM counted WHERE rows > 0""",
    "dq_rule_counts_flag": f"""WITH {FLAGGED}, counted AS (
        SELECT 'o_custkey:null' AS rule, count(*) FILTER (f1) AS rows FROM flagged
        UNION ALL SELECT 'o_orderstatus:regex', count(*) FILTER (f2) FROM flagged
        UNION ALL SELECT 'o_orderpriority:regex', count(*) FILTER (f3) FROM flagged)
        SELECT * FROM counted WHERE rows > 0""",
    "dq_summary": f"""WITH {FLAGGED} SELECT count(*) FILTER (NOT (f1 OR f2 OR f3)) AS valid,
        count(*) FILTER (f1 OR f2 OR f3) AS reject, CAST(0 AS BIGINT) AS lost FROM flagged""",
    "dq_summary_cascade": f"""WITH {CASCADED}, sums AS (
        SELECT (SELECT count(*) FROM step3) AS valid, (SELECT count(*) FROM bad1)
            + (SELECT count(*) FROM bad2) + (SELECT count(*) FROM bad3) AS reject)
        SELECT valid, reject, (SELECT count(*) FROM dirty) - valid - reject AS lost FROM sums""",
    "reject_union": f"WITH {CASCADED} SELECT * FROM bad1 UNION ALL SELECT * FROM bad2",
    "schema_report": f"""WITH {DIRTY}
        SELECT 'o_orderkey' AS "column", 'ok' AS issue, 'info' AS severity,
            count(*) FILTER (o_orderkey IS NULL) AS nulls, CAST(0 AS BIGINT) AS bad_casts FROM dirty
        UNION ALL SELECT 'o_custkey', 'ok', 'info', count(*) FILTER (o_custkey IS NULL),
            count(*) FILTER (o_custkey IS NOT NULL AND TRY_CAST(o_custkey AS INTEGER) IS NULL)
            FROM dirty
        UNION ALL SELECT 'o_orderstatus', 'ok', 'info', count(*) FILTER (o_orderstatus IS NULL),
            count(*) FILTER (o_orderstatus IS NOT NULL
                             AND TRY_CAST(o_orderstatus AS INTEGER) IS NULL) FROM dirty
        UNION ALL SELECT 'o_totalprice', 'ok', 'info', count(*) FILTER (o_totalprice IS NULL),
            count(*) FILTER (o_totalprice IS NOT NULL
                             AND TRY_CAST(o_totalprice AS DECIMAL(12,2)) IS NULL) FROM dirty
        UNION ALL SELECT 'o_clerk', 'missing', 'error', NULL, NULL
        UNION ALL SELECT 'o_orderdate', 'extra', 'info', NULL, NULL
        UNION ALL SELECT 'o_orderpriority', 'extra', 'info', NULL, NULL
        UNION ALL SELECT 'domicile', 'extra', 'info', NULL, NULL""",
    "rowcount_reconcile": f"""WITH {FLAGGED}, sums AS (SELECT count(*) AS src,
            count(*) FILTER (NOT (f1 OR f2 OR f3)) AS curated FROM flagged)
        SELECT src, curated, src - curated AS rejected,
            round((src - curated) / src * 100, 2) AS loss_pct, src = curated AS matched FROM sums""",
    "staging_write": STAGED.format(hour=8),
    "staging_append": STAGED.format(hour=7) + " UNION ALL " + STAGED.format(hour=8),
    "curated_overwrite": f"WITH {REPAIRED} SELECT * FROM repaired",
    "curated_append": f"""WITH {REPAIRED}
        SELECT * FROM repaired UNION ALL SELECT * FROM repaired""",
    "curated_merge": _merge("o_orderkey"),
    "merge_null_key": _merge("CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderkey END"),
    "merge_whole_table": _merge("o_orderkey"),
    "upsert_frames": _merge("o_orderkey"),
    "table_create": "SELECT * FROM customer",
    "table_evolve": """SELECT *, 'global' AS domicile,
        CASE WHEN c_custkey % 2 = 0 THEN c_acctbal > 5000 END AS c_rich FROM customer""",
    "table_replace": "SELECT * REPLACE (CAST(0 AS DOUBLE) AS c_acctbal) FROM customer",
    "rejects_write": f"WITH {FLAGGED} {FLAG_REASONED}",
    "rejects_table": f"WITH {FLAGGED} {FLAG_REASONED}",
    "rejects_partitioned": TWO_HOURS,
    "rejects_table_partition": TWO_HOURS,
    "audit_append": f"""WITH {CASCADED}, flagged AS (
            SELECT coalesce(o_custkey IS NULL
                OR NOT regexp_matches(o_orderstatus, '^[FOP]$')
                OR NOT regexp_matches(o_orderpriority, '^[1-5]-'), false) AS failed FROM dirty)
        SELECT 'orders' AS dataset, 'flag' AS sys_level, '2024-03-05T07:30:00' AS timestamp_utc,
            count(*) AS src_count, count(*) FILTER (NOT failed) AS curated_count,
            count(*) FILTER (failed) AS rejected_count, 'SUCCESS' AS status FROM flagged
        UNION ALL SELECT 'orders', 'cascade', '2024-03-05T08:30:00',
            (SELECT count(*) FROM dirty), (SELECT count(*) FROM step3),
            (SELECT count(*) FROM bad1) + (SELECT count(*) FROM bad2)
            + (SELECT count(*) FROM bad3), 'SUCCESS'""",
    "full_load": f"{LOADED} SELECT * FROM loaded WHERE regexp_matches(return_flag, '^[AR]$')",
    "full_load_rejects": f"""{LOADED} SELECT *, 'return_flag:regex' AS dq_reasons FROM loaded
        WHERE NOT regexp_matches(return_flag, '^[AR]$')""",
    "full_load_audit": f"""{LOADED} SELECT 'lineitem' AS dataset, 'dev' AS sys_level,
        '2024-03-05T07:30:00' AS timestamp_utc,
        (SELECT count(*) FROM lineitem WHERE l_quantity >= 10) AS src_count,
        count(*) FILTER (regexp_matches(return_flag, '^[AR]$')) AS curated_count,
        count(*) FILTER (NOT regexp_matches(return_flag, '^[AR]$')) AS rejected_count,
        'SUCCESS' AS status FROM loaded""",
    "full_load_masked": f"""SELECT page_id, url, 'XXX-CONFIDENTIAL-XXX' AS html,
        'web' AS domicile FROM ({_latest("pages", "url", "page_id DESC NULLS LAST")})
        WHERE regexp_matches(url, '^https://') AND regexp_matches(html, '<[a-zA-Z!]')""",
    "full_load_cascade": f"""WITH {CASCADED} SELECT * REPLACE (CASE
        WHEN domicile IS NULL OR lower(domicile) IN ('', 'null', 'none') THEN 'global'
        ELSE domicile END AS domicile) FROM step3""",
    "full_load_cascade_rejects": f"""WITH {CASCADED} SELECT * REPLACE (CASE
        WHEN domicile IS NULL OR lower(domicile) IN ('', 'null', 'none') THEN 'global'
        ELSE domicile END AS domicile) FROM (SELECT * FROM bad1
        UNION ALL SELECT * FROM bad2 UNION ALL SELECT * FROM bad3)""",
    "full_load_cascade_audit": f"""WITH {CASCADED} SELECT 'orders' AS dataset,
        'dev' AS sys_level, '2024-03-05T07:30:00' AS timestamp_utc,
        (SELECT count(*) FROM dirty) AS src_count, (SELECT count(*) FROM step3) AS curated_count,
        (SELECT count(*) FROM bad1) + (SELECT count(*) FROM bad2) + (SELECT count(*) FROM bad3)
            AS rejected_count, 'SUCCESS' AS status""",
    "full_load_own_stamp": """SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS load_dt,
        o_orderkey % 24 AS load_hr, 'global' AS domicile FROM orders""",
    "full_load_rejects_by_hour": f"""WITH {FLAGGED} SELECT * REPLACE (CASE
        WHEN domicile IS NULL OR lower(domicile) IN ('', 'null', 'none') THEN 'global'
        ELSE domicile END AS domicile), '2024-03-05' AS dt, '07' AS hr
        FROM ({FLAG_REASONED}) WHERE o_custkey IS NULL""",
    "incremental_load": f"SELECT *, 'global' AS domicile FROM ({LATEST_LINES})",
    "incremental_append": APPENDED,
    "incremental_replay": f"""SELECT * FROM ({APPENDED}) JOIN (
        SELECT l_orderkey, l_linenumber, count(*) AS staged FROM lineitem GROUP BY 1, 2)
        USING (l_orderkey, l_linenumber)""",
}
