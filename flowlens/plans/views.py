"""Stand-in input views over the driver tables.

Each view only reshapes rows of the given tables into the schema an
operator expects (flow records, prediction log, scored rows).  The same
SQL text is registered as a Spark temp view and used as a CTE by the DuckDB
oracle, so both engines see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

VIEW_SQL: dict[str, str] = {
    # Argus-like raw 5G flows
    "flows_5g": """
SELECT l.l_orderkey*10+l.l_linenumber AS UniqueID, l.l_linenumber AS Seq,
 CASE WHEN l.l_tax=0 THEN CAST(NULL AS DOUBLE) ELSE l.l_tax END AS Dur,
 l.l_quantity AS TotPkts, least(CAST(l.l_linenumber AS DOUBLE),l.l_quantity) AS SrcPkts,
 l.l_extendedprice AS TotBytes, l.l_extendedprice*(1-l.l_discount) AS SrcBytes,
 l.l_extendedprice*(1-l.l_discount)/least(CAST(l.l_linenumber AS DOUBLE),l.l_quantity) AS sMeanPktSz,
 l.l_extendedprice*l.l_discount/greatest(l.l_quantity-l.l_linenumber,1.0) AS dMeanPktSz,
 CASE WHEN l.l_tax=0 THEN CAST(0 AS DOUBLE) ELSE 8*l.l_extendedprice/l.l_tax END AS Load,
 CASE WHEN l.l_tax=0 THEN CAST(0 AS DOUBLE) ELSE l.l_quantity/l.l_tax END AS Rate,
 CAST(CASE WHEN l.l_returnflag='R' THEN l.l_linenumber ELSE 0 END AS DOUBLE) AS Loss,
 CASE WHEN l.l_orderkey%5=0 THEN CAST(NULL AS DOUBLE) ELSE CAST(l.l_partkey%64 AS DOUBLE) END AS dTtl,
 CASE WHEN l.l_orderkey%10<9 THEN CAST(NULL AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS sVid,
 CASE WHEN l.l_partkey%10<6 THEN 'tcp' WHEN l.l_partkey%10<9 THEN 'udp' ELSE 'icmp' END AS Proto,
 CASE l.l_returnflag WHEN 'R' THEN 'RST' WHEN 'A' THEN 'FIN' ELSE 'CON' END AS State,
 CASE WHEN l.l_suppkey%50=0 THEN '?' WHEN l.l_suppkey%50=1 THEN 'ef' ELSE 'cs0' END AS sDSb,
 CASE WHEN l.l_partkey%4=0 THEN '?' ELSE 'cs0' END AS dDSb,
 CASE o.o_custkey%3 WHEN 0 THEN '1:eMBB' WHEN 1 THEN '2:mMTC' ELSE '3:URLLC' END AS predicted,
 CASE WHEN l.l_returnflag='R' OR l.l_discount>=0.09 THEN 'Malicious' ELSE 'Benign' END AS Label
FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey""",
    # CICFlowMeter-like raw 6G flows (lower-case names)
    "flows_6g": """
SELECT event_id AS flow_id, user_id AS src, ts,
 CASE event_type WHEN 'view' THEN 443 WHEN 'click' THEN 80 WHEN 'signup' THEN 22 WHEN 'error' THEN 3389 ELSE 1024+CAST(event_id%4000 AS INT) END AS dst_port,
 CASE WHEN event_id%10<6 THEN 6 WHEN event_id%10<9 THEN 17 ELSE 0 END AS protocol,
 value*1000 AS flow_duration, CAST(1+user_id%40 AS DOUBLE) AS fwd_pkts, CAST(event_id%25 AS DOUBLE) AS bwd_pkts,
 40+value AS fwd_len_mean, value*2 AS bwd_len_mean,
 CASE WHEN event_id%97=0 THEN CAST(NULL AS DOUBLE) WHEN event_id%101=0 THEN CAST('Infinity' AS DOUBLE) ELSE value*(1+event_id%13) END AS flow_bytes_s,
 CASE WHEN event_id%97=0 THEN CAST(NULL AS DOUBLE) ELSE (1+user_id%40+event_id%25)/(value+1) END AS flow_packets_s,
 CASE WHEN event_type='signup' THEN 1 ELSE 0 END AS syn, CASE WHEN event_type='purchase' THEN 1 ELSE 0 END AS fin,
 CASE WHEN event_type='error' THEN 1 ELSE 0 END AS rst, CASE WHEN event_type='click' THEN 1 ELSE 0 END AS psh, 0 AS urg,
 CASE WHEN event_id%997=0 THEN CAST(NULL AS STRING) ELSE 'Benign' END AS Label
FROM events""",
    # 6G flows of which some files were delivered twice
    "flows_6g_replayed": "SELECT * FROM flows_6g UNION ALL SELECT * FROM flows_6g WHERE flow_id % 97 = 0 UNION ALL SELECT * FROM flows_6g WHERE flow_id % 9409 = 0",
    # one scored batch per row
    "prediction_log": """
SELECT event_id AS request_id, ts, CASE WHEN event_type IN ('view','click') THEN 'argus' ELSE 'cic' END AS schema_name,
 1+user_id%100 AS n_rows, least(value/400,1.0) AS mean_probability, least(value/200,1.0) AS attack_rate,
 CASE WHEN event_type='error' THEN 'error' ELSE 'ok' END AS status, 0.01+value/100 AS latency_s FROM events""",
    # label and score with heavy ties
    "scored": """
SELECT l_orderkey*10+l_linenumber AS id, CASE WHEN l_returnflag='R' OR l_discount>=0.09 THEN 1 ELSE 0 END AS y,
 l_discount*10 AS score, l_linestatus AS domain FROM lineitem""",
    # scored rows with their ship date (evaluation runs by month)
    "scored_ts": """
SELECT l_orderkey*10+l_linenumber AS id, CASE WHEN l_returnflag='R' OR l_discount>=0.09 THEN 1 ELSE 0 END AS y,
 l_discount*10 AS score, l_linestatus AS domain, l_shipdate AS ts FROM lineitem""",
}

# Fixed clock for every "now" operator (events end 2024-01-30 23:57:12).
FIXED_NOW = "2024-01-31 00:00:00"

# Lower-case stand-in names -> CICFlowMeter column names (fixed values).
CIC_NAMES = {
    "flow_id": "Flow ID", "src": "Source IP", "ts": "Timestamp",
    "dst_port": "Destination Port", "protocol": "Protocol",
    "flow_duration": "Flow Duration", "fwd_pkts": "Total Fwd Packets",
    "bwd_pkts": "Total Backward Packets", "fwd_len_mean": "Fwd Packet Length Mean",
    "bwd_len_mean": "Bwd Packet Length Mean", "flow_bytes_s": "Flow Bytes/s",
    "flow_packets_s": "Flow Packets/s", "syn": "SYN Flag Count",
    "fin": "FIN Flag Count", "rst": "RST Flag Count", "psh": "PSH Flag Count",
    "urg": "URG Flag Count",
}


def register_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for t in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet").createOrReplaceTempView(t)


VIEW_TABLES = {"flows_5g": ("lineitem", "orders"), "flows_6g": ("events",), "flows_6g_replayed": ("events",), "prediction_log": ("events",),
               "scored": ("lineitem",), "scored_ts": ("lineitem",)}

#: Views that a view reads.
VIEW_VIEWS = {"flows_6g_replayed": ("flows_6g",)}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Register the tables a view reads and return the named stand-in view (or table)."""
    register_tables(spark, sf_dir, VIEW_TABLES.get(name, (name,)))
    if name in VIEW_SQL:
        for needed in VIEW_VIEWS.get(name, ()):
            view(spark, sf_dir, needed)
        df = spark.sql(VIEW_SQL[name])
        df.createOrReplaceTempView(name)
        return df
    return spark.table(name)


def oracle_with(sql: str, views: tuple[str, ...] | list[str]) -> str:
    """Prefix an oracle query with the CTEs of the views it reads."""
    if not views:
        return sql
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v].strip()})" for v in views)
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
