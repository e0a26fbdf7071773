"""Independent SQL (DuckDB dialect) for every registered query.

Each statement recomputes the query's result from the base tables with plain
SQL (window ``row_number``, ``NOT EXISTS``, ``CASE``), not with this library.
"""

from __future__ import annotations

CHANGES = """changes AS (
  SELECT 'cdc.test.events' AS ih_topic, CAST(user_id % 6 AS INTEGER) AS ih_partition, event_id AS ih_offset,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS ih_op,
         ts AS ih_datetime, user_id AS id, event_type AS type, value, props
  FROM events)"""

SEED = """seed AS (
  SELECT c_custkey AS id, c_mktsegment AS type, c_acctbal AS value, CAST(NULL AS VARCHAR) AS props
  FROM customer)"""

# Every fifth user's key lies past all customers.
SHIFTED = CHANGES.replace("user_id AS id", "CASE WHEN user_id % 5 = 0 THEN user_id + 1000000000000 ELSE user_id END AS id")

BLOCK = """block AS (
  SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY id ORDER BY ih_offset DESC) = 1)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def time_text(n: str) -> str:
    """Nanos of day -> ISO local-time text, as SQL over expression ``n``."""
    sec = f"(({n}) // 1000000000) % 60"
    frac = f"(({n}) % 1000000000)"
    return f"""(CASE WHEN ({n}) >= 0 AND ({n}) < 86400000000000 THEN
  lpad(CAST(({n}) // 3600000000000 AS VARCHAR), 2, '0') || ':' ||
  lpad(CAST((({n}) // 60000000000) % 60 AS VARCHAR), 2, '0') ||
  CASE WHEN {sec} = 0 AND {frac} = 0 THEN '' ELSE ':' || lpad(CAST({sec} AS VARCHAR), 2, '0') ||
    CASE WHEN {frac} = 0 THEN ''
         WHEN {frac} % 1000000 = 0 THEN '.' || lpad(CAST({frac} // 1000000 AS VARCHAR), 3, '0')
         WHEN {frac} % 1000 = 0 THEN '.' || lpad(CAST({frac} // 1000 AS VARCHAR), 6, '0')
         ELSE '.' || lpad(CAST({frac} AS VARCHAR), 9, '0') END END
END)"""


def datetime_text(ts: str) -> str:
    return f"(strftime({ts}, '%Y-%m-%d') || 'T' || {time_text(f'(epoch_us({ts}) % 86400000000) * 1000')})"


def _q(expr: str) -> str:
    return f"""coalesce('"' || replace(CAST({expr} AS VARCHAR), '"', '""') || '"', '')"""


APPLY = _with(SHIFTED, SEED, BLOCK) + """
SELECT id, type, value, props FROM seed s
WHERE NOT EXISTS (SELECT 1 FROM block b WHERE b.id = s.id AND b.ih_op IN ('c', 'r', 'u', 'd'))
UNION ALL
SELECT id, type, value, props FROM block WHERE ih_op IN ('c', 'r', 'u')"""


CHANGELOG = _with(CHANGES) + """SELECT ih_topic, ih_partition, CAST(ih_offset AS VARCHAR) AS ih_offset, ih_op,
       id, type, value, props
FROM changes"""


SQL = {
    "decode_envelope": _with(CHANGES) + "SELECT ih_topic, ih_partition, ih_offset, ih_op, id, type, value, props FROM changes",
    "decode_schemaless": _with(CHANGES)
    + "SELECT CAST(ih_offset AS VARCHAR) AS ih_offset, ih_op, id, type, value, props ->> '$.k' AS k FROM changes",
    "route_image": _with(CHANGES)
    + "SELECT ih_offset, ih_op, id, CASE WHEN ih_op = 'd' THEN 'old-' || type ELSE type END AS type, value FROM changes",
    "plain_records": """
SELECT 'cdc.test.events' AS ih_topic, CAST(user_id % 6 AS INTEGER) AS ih_partition,
       CAST(event_id AS VARCHAR) AS ih_offset, 'c' AS ih_op,
       event_id, ts, user_id, event_type, value, props
FROM events""",
    "add_provenance": _with(CHANGES)
    + """SELECT ih_topic, ih_partition, ih_offset, ih_op, TIMESTAMP '2024-02-01 00:00:00' AS ih_datetime,
       'add_provenance-000000000000' AS ih_blockid, id, type, value, props FROM changes""",
    "align_to_target": _with(CHANGES)
    + """SELECT id AS "ID", type AS "TYPE", value AS "Value", CAST(NULL AS VARCHAR) AS note,
       make_timestamp((epoch_us(ih_datetime) // 1000) * 1000) AS event_time,
       CAST(ih_datetime AS DATE) AS event_day, ih_op, ih_offset FROM changes""",
    "validate_changes": _with(CHANGES)
    + """SELECT ih_offset,
       concat_ws(',',
         CASE WHEN r = 6 THEN 'value_not_struct' END,
         CASE WHEN r = 0 THEN 'topic_null' END,
         CASE WHEN r = 1 OR ih_offset % 89 = 1 THEN 'partition_null' END,
         CASE WHEN r = 3 THEN 'key_not_struct' END,
         CASE WHEN r = 4 THEN 'pk_null:id' END,
         CASE WHEN r = 2 THEN 'op_null' END,
         CASE WHEN r = 5 THEN 'image_null' END) AS error_list,
       CAST((r = 6)::INTEGER + (r = 0)::INTEGER + (r = 1 OR ih_offset % 89 = 1)::INTEGER + (r = 3)::INTEGER
            + (r = 4)::INTEGER + (r = 2)::INTEGER + (r = 5)::INTEGER AS INTEGER) AS n_errors
FROM (SELECT *, ih_offset % 97 AS r FROM changes) t""",
    "convert_timestamp": """
SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts_local
FROM events""",
    "convert_date": """
SELECT o_orderkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days,
       CAST(o_orderdate AS DATE) AS d
FROM orders""",
    "convert_time": f"""
SELECT event_id, (epoch_us(ts) % 86400000000) * 1000 AS nanos,
       {time_text('(epoch_us(ts) % 86400000000) * 1000')} AS time_text
FROM events""",
    "csv_lines": _with(CHANGES)
    + f"""SELECT ih_offset, concat_ws(',', {_q('id')}, {_q('type')}, {_q('value')}, {_q('props')}, {_q('ih_topic')},
       {_q('ih_offset')}, {_q('ih_partition')}, {_q('ih_op')}, {_q(datetime_text('ih_datetime'))},
       {_q("'csv-000000000000'")}) AS line
FROM changes""",
    "stage_and_load": _with(CHANGES)
    + """SELECT id, type, value, props, ih_topic, ih_offset, ih_partition, ih_op, ih_datetime,
       'stage-000000000000' AS ih_blockid,
       CASE ih_offset % 4 WHEN 0 THEN NULL WHEN 1 THEN chr(1) WHEN 2 THEN 'a' || chr(13) || chr(10) || 'b' ELSE '' END AS note
FROM changes""",
    "stage_purge": _with(CHANGES)
    + """SELECT id, type, value, props, ih_topic, ih_offset, ih_partition, ih_op, ih_datetime,
       'purge-000000000000' AS ih_blockid, false AS stage_left FROM changes""",
    "conflate_arrival": _with(CHANGES, """moved AS (
  SELECT id, ih_op, type, value, CAST(ih_offset % 3 AS INTEGER) AS ih_partition,
         (ih_offset // 3) % 500 AS ih_offset, ih_datetime AS ih_record_time FROM changes)""")
    + """SELECT * FROM moved
QUALIFY row_number() OVER (PARTITION BY id ORDER BY ih_record_time DESC, ih_partition DESC, ih_offset DESC) = 1""",
    "conflate_latest": _with(CHANGES, BLOCK) + "SELECT * FROM block",
    "conflate_composite": """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    "block_flags": _with(CHANGES, BLOCK)
    + """SELECT coalesce(bool_or(ih_op IN ('c', 'r')), false) AS has_inserts,
       coalesce(bool_or(ih_op = 'u'), false) AS has_updates,
       coalesce(bool_or(ih_op = 'd'), false) AS has_deletes FROM block""",
    "block_metrics": _with(CHANGES, BLOCK)
    + """SELECT ih_op, CAST(sum(n_in) AS BIGINT) AS n_in, CAST(sum(n_out) AS BIGINT) AS n_out FROM (
  SELECT ih_op, 1 AS n_in, 0 AS n_out FROM changes
  UNION ALL SELECT ih_op, 0 AS n_in, 1 AS n_out FROM block) t
GROUP BY ih_op""",
    "merge_upsert": _with(SHIFTED, SEED, BLOCK)
    + """SELECT id, type, value, props FROM seed s
WHERE NOT EXISTS (SELECT 1 FROM block b WHERE b.id = s.id AND b.ih_op IN ('c', 'r', 'u'))
UNION ALL
SELECT id, type, value, props FROM block WHERE ih_op IN ('c', 'r', 'u')""",
    "delete_by_key": _with(SHIFTED, SEED, BLOCK)
    + """SELECT id, type, value, props FROM seed s
WHERE NOT EXISTS (SELECT 1 FROM block b WHERE b.id = s.id AND b.ih_op = 'd')""",
    "apply_block": APPLY,
    "replay_blocks": APPLY,
    "stream_apply": APPLY,
    "stream_restart": APPLY,
    "stream_flush": APPLY,
    "flush_counters": _with(SHIFTED, """bounds AS (SELECT min(ih_offset) AS lo, max(ih_offset) AS hi FROM changes)""", """numbered AS (
  SELECT c.*, CAST(((ih_offset - lo) * 5) // (hi - lo + 1) AS INTEGER) AS block FROM changes c, bounds)""", """last AS (
  SELECT * FROM numbered QUALIFY row_number() OVER (PARTITION BY block, id ORDER BY ih_offset DESC) = 1)""")
    + """SELECT n.block, n.records, l.rows, l.has_inserts, l.has_updates, l.has_deletes
FROM (SELECT block, count(*) AS records FROM numbered GROUP BY block) n
JOIN (SELECT block, count(*) AS rows, bool_or(ih_op IN ('c', 'r')) AS has_inserts, bool_or(ih_op = 'u') AS has_updates,
             bool_or(ih_op = 'd') AS has_deletes FROM last GROUP BY block) l ON n.block = l.block""",
    "schemaless_timestamp": _with(CHANGES)
    + """SELECT id, make_timestamp((epoch_us(ih_datetime) // 1000) * 1000) AS timestamp, type AS topic, ih_topic,
       CAST(ih_offset AS VARCHAR) AS ih_offset FROM changes""",
    "discover_columns": _with(CHANGES) + "SELECT id, value, type, ih_offset FROM changes",
    "truncate_changelog": _with(CHANGES, """bounds AS (SELECT min(ih_offset) AS lo, max(ih_offset) AS hi FROM changes)""")
    + """SELECT ih_topic, ih_partition, CAST(ih_offset AS VARCHAR) AS ih_offset, ih_op, id, type, value, props
FROM changes, bounds WHERE (ih_offset - lo) * 2 >= hi - lo + 1""",
    "land_block_copy_only": _with(CHANGES, BLOCK)
    + """SELECT id, type, value, props, ih_topic, ih_offset, ih_partition, ih_op,
       TIMESTAMP '2024-02-01 00:00:00' AS ih_datetime, 'land-000000000000' AS ih_blockid FROM block""",
    "append_changelog": CHANGELOG,
    "stream_changelog": CHANGELOG,
    "stream_file_sink": CHANGELOG,
    "stream_progress": _with(CHANGES, """bounds AS (SELECT min(ih_offset) AS lo, max(ih_offset) AS hi FROM changes)""")
    + """SELECT CAST((ih_offset - lo) * 5 // (hi - lo + 1) AS INTEGER) AS batch, count(*) AS records, count(*) AS rows,
       count(*) FILTER (ih_op <> 'd') AS upserts, count(*) FILTER (ih_op = 'd') AS deletes,
       CAST((ih_offset - lo) * 5 // (hi - lo + 1) >= 2 AS INTEGER) AS failures
FROM changes, bounds GROUP BY ALL""",
    "catalog_copy_into": _with(CHANGES)
    + """SELECT CAST(NULL AS VARCHAR) AS note, ih_topic, ih_offset, ih_partition, ih_op, ih_datetime, id, type, value, props,
       'catalog-000000000000' AS ih_blockid, false AS stage_left FROM changes""",
    "catalog_truncate": _with(CHANGES, """bounds AS (SELECT min(ih_offset) AS lo, max(ih_offset) AS hi FROM changes)""")
    + """SELECT ih_topic, ih_partition, ih_offset, ih_op, id, type, value, props
FROM changes, bounds WHERE (ih_offset - lo) * 2 >= hi - lo + 1 AND ih_op <> 'd'""",
    "metadata_columns": _with(CHANGES) + 'SELECT type AS "TYPE", id AS "ID", ih_offset AS "IH_OFFSET" FROM changes',
    "stamp_now": _with(CHANGES) + "SELECT ih_offset, 'now-000000000000' AS ih_blockid, true AS within, 1 AS times FROM changes",
    "wide_schemaless": _with(CHANGES)
    + """SELECT CAST(ih_offset AS VARCHAR) AS ih_offset, CAST(id AS VARCHAR) AS field_1, CAST(id * 100 AS VARCHAR) AS field_100,
       'last-' || type AS field_200, CAST(id * 299 AS VARCHAR) AS field_299, CAST(NULL AS VARCHAR) AS missing FROM changes""",
    "stream_limited": f"SELECT *, CAST(ceil((SELECT count(*) FROM events) / 1000.0) AS INTEGER) AS batches FROM ({CHANGELOG})",
    "stream_gap_reload": _with(CHANGES, """bounds AS (SELECT min(ih_offset) AS lo, max(ih_offset) AS hi FROM changes)""")
    + """SELECT id, type, CAST(ih_offset AS VARCHAR) AS ih_offset FROM changes, bounds WHERE (ih_offset - lo) * 5 >= (hi - lo + 1) * 2""",
    "expire_landing": _with(CHANGES)
    + """SELECT * FROM changes
WHERE NOT (ih_datetime + INTERVAL 4 HOUR < TIMESTAMP '2024-01-15 00:00:00') OR ih_datetime IS NULL""",
    "compact_latest": _with(CHANGES)
    + """SELECT c.* FROM changes c
LEFT JOIN (SELECT id, max(ih_offset) AS m FROM changes GROUP BY id) x ON c.id = x.id
WHERE NOT coalesce(c.ih_offset < x.m, false)""",
    "reload_on_gap": """
WITH g AS (
  SELECT *, CASE WHEN (epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts, event_id))) // 60000000 > 30
                 THEN 1 ELSE 0 END AS reload
  FROM events),
s AS (SELECT *, sum(reload) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sess FROM g)
SELECT event_id, ts, user_id, event_type, value, props FROM s WHERE sess = (SELECT max(sess) FROM s)""",
    "reload_on_gap_days": """
WITH e AS (SELECT event_id, user_id, ts - to_days(CAST((30 - day(ts)) * (30 - day(ts)) AS INTEGER)) AS moved_ts FROM events),
g AS (
  SELECT *, CASE WHEN (epoch_us(moved_ts) - epoch_us(lag(moved_ts) OVER (ORDER BY moved_ts, event_id))) // 60000000 > 20 * 1440
                 THEN 1 ELSE 0 END AS reload
  FROM e),
s AS (SELECT *, sum(reload) OVER (ORDER BY moved_ts, event_id ROWS UNBOUNDED PRECEDING) AS sess FROM g)
SELECT event_id, user_id, moved_ts FROM s WHERE sess = (SELECT max(sess) FROM s)""",
}
SQL["expire_table"] = SQL["expire_landing"]
SQL["compact_table"] = SQL["compact_latest"]
