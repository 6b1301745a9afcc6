"""The engine's input relations, as views over star-schema tables, in SQL that Spark and DuckDB both take."""

REVISIONS = """
SELECT CAST(l_shipdate AS STRING) AS event_timestamp,
  CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_custkey END AS event_user_id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'bot' WHEN o_orderpriority = '2-HIGH' THEN 'anonymous'
       WHEN o_orderpriority LIKE '3-MEDIUM%' THEN 'temporary' ELSE 'registered' END AS user_type,
  l_partkey % 50 AS page_id, concat('Page_', CAST(l_partkey % 50 AS STRING)) AS page_title,
  CAST(l_partkey % 4 AS INT) AS page_namespace, l_orderkey * 10 + l_linenumber AS revision_id,
  CAST(floor(l_extendedprice) AS BIGINT) - 30000 AS diff, l_returnflag = 'R' AS reverted, l_linestatus = 'F' AS minor
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

PATROL_REVISIONS = """
SELECT o_orderkey AS revision_id, CAST(o_orderdate AS STRING) AS event_timestamp, CAST(o_custkey AS STRING) AS event_user_text,
  CAST(o_orderkey % 3 AS INT) AS page_namespace,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'bot' WHEN o_orderpriority = '2-HIGH' THEN 'anonymous'
       WHEN o_orderpriority LIKE '3-MEDIUM%' THEN 'temporary' ELSE 'registered' END AS user_type
FROM orders"""

PATROL_EVENTS = """
SELECT l_orderkey * 10 + l_linenumber AS log_id, CAST(l_shipdate AS STRING) AS event_timestamp, CAST(l_suppkey AS STRING) AS patroller,
  CASE WHEN l_linestatus = 'F' AND l_linenumber = 2 THEN l_orderkey + 1000000000 ELSE l_orderkey END AS current_revision_id,
  CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END AS prev_revision_id
FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber <= 2"""

RIGHTS_EVENTS = """
SELECT CAST(o_orderdate AS STRING) AS event_timestamp, CAST(o_custkey AS STRING) AS target_user,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'autopatrolled' ELSE '' END AS old_groups,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'autopatrolled,sysop' ELSE '' END AS new_groups
FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')"""

VIEWS = {"revisions": REVISIONS, "patrol_revisions": PATROL_REVISIONS, "patrol_events": PATROL_EVENTS, "rights_events": RIGHTS_EVENTS}
