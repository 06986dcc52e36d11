"""Patent-shaped views of the tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "publications": (
        "orders",
        """
SELECT CAST(o_orderkey AS STRING) AS pub_doc_id,
       CASE o_orderkey % 12 WHEN 0 THEN 'US' WHEN 1 THEN 'EP' WHEN 2 THEN 'WO' WHEN 3 THEN 'CN'
            WHEN 4 THEN 'JP' WHEN 5 THEN 'KR' WHEN 6 THEN 'DE' WHEN 7 THEN 'GB' WHEN 8 THEN 'FR'
            WHEN 9 THEN 'AU' WHEN 10 THEN 'CA' ELSE 'AM' END AS country,
       CAST(CAST(FLOOR(o_orderkey / 24) AS BIGINT) AS STRING) AS doc_number,
       CASE o_orderstatus WHEN 'F' THEN 'B1' WHEN 'O' THEN 'A1' ELSE 'A' END AS kind_code,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date_publ,
       CONCAT('AP', CAST(o_custkey AS STRING)) AS app_doc_id,
       CAST(o_custkey % 500 AS STRING) AS family_id,
       CASE SUBSTRING(o_orderpriority, 1, 1) WHEN '1' THEN 'C' WHEN '2' THEN 'A' WHEN '3' THEN 'D'
            WHEN '4' THEN 'CV' ELSE 'C' END AS source_status
FROM orders""",
    ),
    "changes": (
        "events",
        """
SELECT CASE user_id % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'EP' ELSE 'AM' END AS country,
       CAST(user_id AS STRING) AS pub_doc_id, event_id, ts,
       CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'C' ELSE 'A' END AS source_status,
       value, ts < TIMESTAMP '2024-01-16 00:00:00' AS is_before_cut
FROM events""",
    ),
    "files": (
        "customer",
        """
SELECT c_custkey AS file_id, CAST(c_nationkey % 3 AS BIGINT) AS delivery_id,
       CONCAT('PKG-', CASE c_custkey % 4 WHEN 0 THEN 'Amend' WHEN 1 THEN 'CreateDelete'
              WHEN 2 THEN 'DeleteRekey' ELSE 'Other' END, '-', CAST(c_custkey AS STRING), '.zip') AS filename,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'PENDING' WHEN 'MACHINERY' THEN 'COMPLETED'
            WHEN 'AUTOMOBILE' THEN 'FAILED' WHEN 'FURNITURE' THEN 'PARSING' ELSE 'DOWNLOADED' END AS status
FROM customer""",
    ),
    "children": (
        "lineitem",
        """
SELECT CAST(l_orderkey AS STRING) AS pub_doc_id,
       CASE l_linestatus WHEN 'F' THEN 'APPLICANT' ELSE 'INVENTOR' END AS party_type,
       CASE l_returnflag WHEN 'N' THEN 'docdb' WHEN 'A' THEN 'docdba' ELSE 'original' END AS format_type,
       CAST(l_linenumber AS INT) AS sequence,
       CONCAT('Name ', CAST(l_suppkey AS STRING)) AS party_name,
       CASE WHEN l_suppkey % 4 = 0 THEN NULL WHEN l_suppkey % 4 = 1 THEN 'US' WHEN l_suppkey % 4 = 2 THEN 'EP' ELSE 'JP' END AS residence,
       CASE WHEN l_partkey % 3 = 0 THEN 'CPC' ELSE 'IPC' END AS scheme_name,
       CONCAT(CASE WHEN l_partkey % 5 = 0 THEN 'A61K' ELSE 'H04L' END, ' ', CAST(l_partkey AS STRING)) AS symbol,
       CASE l_returnflag WHEN 'N' THEN 'PATENT' ELSE 'NPL' END AS citation_type,
       CAST(l_partkey AS STRING) AS cited_doc_id,
       CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INT) AS pos
FROM lineitem""",
    ),
    "texts": (
        "documents",
        """
SELECT CONCAT(source, '.zip') AS filename, doc_id AS doc_seq,
       CAST(CAST(FLOOR(doc_id / 4) AS BIGINT) AS STRING) AS pub_doc_id,
       CASE doc_id % 2 WHEN 0 THEN 'TITLE' ELSE 'ABSTRACT' END AS text_type, lang, text AS content
FROM documents""",
    ),
    "payloads": (
        "events",
        """
SELECT event_id, CONCAT('src', CAST(user_id % 10 AS STRING), '.zip') AS filename,
       CONCAT('{"country":"US","status":"C","ext_', event_type, '":"', CAST(user_id AS STRING), '"}') AS payload
FROM events""",
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, sql = VIEWS[name]
    head, _, tail = sql.rpartition(f"FROM {source}")
    return spark.sql(f"{head.replace('{', '{{').replace('}', '}}')}FROM {{{source}}}{tail}", **{source: table(spark, sf_dir, source)})


def with_views(sql: str) -> str:
    """SQL for DuckDB with the views that it names as common table expressions."""
    used = [n for n in VIEWS if f" {n}" in sql or f"({n}" in sql]
    heads = [f"{n} AS ({VIEWS[n][1]})" for n in used]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(heads)}, {body[5:]}" if heads else body
    return f"WITH {', '.join(heads)} {body}" if heads else body
