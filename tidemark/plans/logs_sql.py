"""The derived logs of ``derive`` as SQL common table expressions, with flat columns."""

O_LOG = """
o_log AS (
  SELECT o.*, phase,
    phase * 1000000000000 + o_orderkey AS tx_seq,
    (phase * 1000000000000 + o_orderkey) * 1000 AS scn,
    CAST(1 AS BIGINT) AS seq,
    phase * 1000000000000 + o_orderkey AS lsn,
    CAST(o_orderkey % 4 AS SMALLINT) AS dn,
    phase * 1000000000000 + o_orderkey - 1 AS last_commit,
    (phase * 1000000000000 + o_orderkey)::VARCHAR || '-1-' || ((phase * 1000000000000 + o_orderkey) * 1000)::VARCHAR AS check_point,
    CASE WHEN phase IN (1, 5) THEN 'I' WHEN phase = 4 THEN 'D' ELSE 'U' END AS op_type,
    epoch_us(o_orderdate) + phase * 86400000000 + (o_orderkey * 7919) % 1000000 AS immediate_us,
    epoch_us(o_orderdate) + phase * 86400000000 + (o_orderkey * 7919) % 1000000
      - CASE WHEN o_orderkey % 2 = 0 THEN 2000000 ELSE 0 END AS original_us
  FROM orders o, (VALUES (CAST(1 AS BIGINT)), (2), (3), (4), (5), (6)) AS phases(phase)
  WHERE phase = 1 OR (phase = 2 AND o_orderkey % 3 = 0) OR (phase = 3 AND o_orderkey % 6 = 0)
     OR (phase = 4 AND o_orderkey % 7 = 0) OR (phase = 5 AND o_orderkey % 21 = 0)
     OR (phase = 6 AND o_orderkey % 35 = 0)
)"""

L_LOG = """
l_log AS (
  SELECT l.*,
    10000000000000 + l_orderkey AS tx_seq,
    (10000000000000 + l_orderkey) * 1000 AS scn,
    CAST(l_linenumber AS BIGINT) AS seq,
    l_partkey * 10000000 + l_suppkey * 100 + CAST(l_quantity AS BIGINT) AS lsn,
    CAST(l_suppkey % 4 AS SMALLINT) AS dn,
    10000000000000 + l_orderkey - 1 AS last_commit,
    (10000000000000 + l_orderkey)::VARCHAR || '-' || l_linenumber::VARCHAR || '-' || ((10000000000000 + l_orderkey) * 1000)::VARCHAR AS check_point,
    'I' AS op_type,
    epoch_us(l_shipdate) AS immediate_us,
    epoch_us(l_shipdate) - CASE WHEN l_orderkey % 2 = 0 THEN 2000000 ELSE 0 END AS original_us
  FROM lineitem l
)"""

E_LOG = """
e_log AS (
  SELECT e.*,
    20000000000000 + event_id + 1 AS tx_seq,
    (20000000000000 + event_id + 1) * 1000 AS scn,
    CAST(1 AS BIGINT) AS seq,
    20000000000000 + event_id + 1 AS lsn,
    CAST(user_id % 4 AS SMALLINT) AS dn,
    20000000000000 + event_id - event_id % 4 AS last_commit,
    (20000000000000 + event_id + 1)::VARCHAR || '-1-' || ((20000000000000 + event_id + 1) * 1000)::VARCHAR AS check_point,
    CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op_type,
    epoch_us(ts) AS immediate_us,
    epoch_us(ts) - CASE WHEN event_id % 2 = 0 THEN 2000000 ELSE 0 END AS original_us
  FROM events e
)"""

D_LOG = """
d_steps AS (
  SELECT c_custkey AS k, c_mktsegment, step,
    CASE WHEN step = 5 THEN c_custkey % 6 + 1 ELSE step END * 1000000000000 + c_custkey * 10 AS tx_seq,
    'shop_' || (c_custkey // 5)::VARCHAR AS shop, 'cust_' || c_custkey::VARCHAR AS own
  FROM customer, (VALUES (CAST(1 AS BIGINT)), (2), (3), (4), (5)) AS steps(step)
  WHERE step IN (2, 5) OR (step = 1 AND c_custkey % 5 = 0) OR (step = 3 AND c_custkey % 3 = 0)
     OR (step = 4 AND c_custkey % 10 = 0)
),
d_log AS (
  SELECT k, step, tx_seq, tx_seq * 1000 AS scn, CAST(CASE WHEN step = 5 THEN 2 ELSE 0 END AS BIGINT) AS seq, tx_seq AS lsn,
    CAST(NULL AS SMALLINT) AS dn, tx_seq - 1 AS last_commit, 'DDL' AS op_type,
    1722493959000068 + tx_seq % 1000000000000 * 1000 AS immediate_us,
    1722493959000068 + tx_seq % 1000000000000 * 1000 - CASE WHEN k % 2 = 0 THEN 2000000 ELSE 0 END AS original_us,
    CASE WHEN step IN (2, 3) THEN shop WHEN step = 5 THEN 'tpch' END AS db_name,
    CASE WHEN step IN (2, 3) THEN own WHEN step = 5 THEN 'orders' END AS table_,
    CASE step WHEN 1 THEN 'create database ' || shop
      WHEN 2 THEN 'create table ' || own || ' (id int primary key, seg enum(''' || c_mktsegment || ''',''bb'',''cc''), flags set(''dd'',''ee'',''ff''))'
      WHEN 3 THEN 'drop table ' || own
      WHEN 4 THEN 'drop database ' || shop
      ELSE 'alter table orders comment ''v' || k::VARCHAR || '''' END AS ddl_sql,
    CASE WHEN step IN (1, 2) THEN 'CREATE TABLE' WHEN step = 3 THEN 'DROP TABLE' WHEN step = 5 THEN 'ALTER TABLE' END AS ddl_type
  FROM d_steps
)"""

_COMMON = "tx_seq, scn, seq, lsn, dn, last_commit, op_type, immediate_us, original_us"

ALL_LOG = f"""{O_LOG},{L_LOG},{E_LOG},{D_LOG},
all_log AS (
  SELECT {_COMMON}, 'tpch' AS db_name, 'orders' AS table_, NULL AS ddl_sql FROM o_log
  UNION ALL SELECT {_COMMON}, 'tpch', 'lineitem', NULL FROM l_log
  UNION ALL SELECT {_COMMON}, 'tpch', 'user_state', NULL FROM e_log
  UNION ALL SELECT {_COMMON}, db_name, table_, ddl_sql FROM d_log
)"""

OD_LOG = f"""{O_LOG},{D_LOG},
od_log AS (
  SELECT {_COMMON}, 'tpch' AS db_name, 'orders' AS table_, NULL AS ddl_sql, NULL AS ddl_type FROM o_log
  UNION ALL SELECT {_COMMON}, db_name, table_, ddl_sql, ddl_type FROM d_log
)"""

ORDERED = "scn, tx_seq, seq, lsn, coalesce(dn, -1)"
"""Commit order."""
