"""The SQL each registered query must equal, for DuckDB over the same Parquet tables."""

from __future__ import annotations

from workload.ingest import ACCOUNT, CONTAINER, ONE_DATE
from workload.landing import ORDERS_PER_FILE, YEAR_STEP

KEY = f"(year(o_orderdate) * {YEAR_STEP} + o_orderkey // {ORDERS_PER_FILE})::BIGINT"
PREFIX = f"abfss://{CONTAINER}@{ACCOUNT}.dfs.core.windows.net/"
BLOB = f"https://{ACCOUNT}.blob.core.windows.net/"
TAIL = ".dfs.core.windows.net/"
ADDRESSES = f"""
    SELECT page_id, url, CASE page_id % 8
        WHEN 0 THEN '{PREFIX}' || url
        WHEN 1 THEN '{PREFIX}abfss/' || url || '/{PREFIX}in.csv'
        WHEN 2 THEN 'abfss://other@{ACCOUNT}{TAIL}' || url
        WHEN 3 THEN 'abfss://{CONTAINER}@acct2{TAIL}' || url
        WHEN 4 THEN 'abfs://{CONTAINER}@{ACCOUNT}{TAIL}' || url
        WHEN 5 THEN 'abfss://{CONTAINER}@{ACCOUNT}Xdfs.core.windows.net/' || url
        WHEN 6 THEN 'ABFSS://{CONTAINER}@{ACCOUNT}{TAIL}' || url
        ELSE url END AS uri
    FROM pages
"""
DAY_FILES = f"""
    SELECT '{PREFIX}landing/' || user_id || '.csv' AS source_file
    FROM events WHERE event_type = 'view' AND strftime(ts, '%Y-%m-%d') = '{ONE_DATE}'
    INTERSECT
    SELECT '{PREFIX}landing/' || user_id || '.csv'
    FROM events WHERE event_type <> 'view' AND strftime(ts, '%Y-%m-%d') = '{ONE_DATE}'
"""
AUDIT = f"""
    SELECT {KEY} AS landing_key, count(*) AS record_count,
           arg_min(o_custkey, o_orderkey) AS first_value
    FROM orders GROUP BY 1
"""
FILE_COUNT = f"""
    SELECT count(DISTINCT {KEY}) AS n, count(*) AS n_rows,
           greatest(1, ceil(count(DISTINCT {KEY}) / 4.0))::BIGINT AS per_batch
    FROM orders
"""

ORACLE_SQL = {
    "csv_stream_ingest": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
               {KEY} AS landing_key
        FROM orders
    """,
    "csv_permissive_nulls": """
        SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_nationkey END AS age,
               c_acctbal
        FROM customer
    """,
    "ingest_rate_limited": f"""
        SELECT ceil(n / per_batch::DOUBLE)::BIGINT AS n_batches, n AS n_files, n_rows
        FROM ({FILE_COUNT})
    """,
    "stamp_provenance": f"""
        SELECT {KEY} AS landing_key, count(*) AS n_rows, 1::BIGINT AS n_times,
               0::BIGINT AS n_date_mismatch
        FROM orders GROUP BY 1
    """,
    "processed_date_from_time": """
        SELECT event_id, strftime(ts, '%Y-%m-%d') AS processed_date FROM events
    """,
    "partitioned_sink_prune": f"""
        SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS processed_date
        FROM events WHERE strftime(ts, '%Y-%m-%d') = '{ONE_DATE}'
    """,
    "clean_source_archive": f"""
        SELECT n AS n_files,
               (n - per_batch * (ceil(n / per_batch::DOUBLE) - 1))::BIGINT AS n_swept,
               0::BIGINT AS n_left, n AS n_archived,
               n_rows, n AS n_audited, n_rows AS n_audited_rows
        FROM ({FILE_COUNT})
    """,
    "storage_uri_to_blob_url": f"""
        SELECT page_id, CASE page_id % 8
            WHEN 0 THEN '{BLOB}{CONTAINER}/' || url
            WHEN 1 THEN '{BLOB}{CONTAINER}/abfss/' || url || '/{PREFIX}in.csv'
            WHEN 2 THEN '{BLOB}other/' || url
            WHEN 3 THEN 'https://acct2.blob.core.windows.net/{CONTAINER}/' || url
            ELSE uri END AS url
        FROM ({ADDRESSES})
    """,
    "strip_container_prefix": f"""
        SELECT page_id, CASE page_id % 8
            WHEN 0 THEN url WHEN 1 THEN 'abfss/' || url || '/{PREFIX}in.csv'
            ELSE uri END AS file_path
        FROM ({ADDRESSES})
    """,
    "file_metadata_audit": AUDIT,
    "audit_join_form": AUDIT,
    "replay_idempotent_audit": f"SELECT *, record_count AS loaded FROM ({AUDIT})",
    "record_count_per_file": """
        SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS processing_time,
               strftime(ts, '%Y-%m-%d') AS processed_date, count(*) AS record_count
        FROM events GROUP BY ALL
    """,
    "latest_row_per_file": """
        SELECT user_id, event_id, ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1
    """,
    "file_inventory": f"""
        SELECT DISTINCT {KEY} AS landing_key, true AS has_size, true AS size_agrees FROM orders
        UNION ALL SELECT 0, false, false
    """,
    "archive_candidates": DAY_FILES,
    "archive_report": f"SELECT source_file, DATE '{ONE_DATE}' AS processed_date FROM ({DAY_FILES})",
    "archive_manifest": f"""
        SELECT replace(source_file, '{PREFIX}', '') AS file_path FROM ({DAY_FILES})
    """,
    "archive_manifest_capped": f"""
        SELECT replace(source_file, '{PREFIX}', '') AS file_path,
               CAST((row_number() OVER (ORDER BY source_file) - 1)
                    // ((count(*) OVER () + 2) // 3) AS INTEGER) AS run
        FROM ({DAY_FILES})
    """,
    "archive_move_status": f"""
        SELECT DISTINCT {KEY} AS landing_key, 'success' AS status, false AS has_exception,
               1::BIGINT AS n_archived, 0::BIGINT AS n_landed
        FROM orders
        UNION ALL SELECT 0, 'failed', true, 0, 0
    """,
}
