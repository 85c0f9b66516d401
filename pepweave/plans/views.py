"""Match tables derived from the sample star schema, for queries and benchmarks; the same SQL text serves both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Every fifth order is a scan that the other side has not seen, and the other way round: its number is moved by so much.
ELSEWHERE = 1_000_000_000
FEATURES = ["f_discount", "f_tax", "f_price", "f_quantity"]


def peptide(key: str) -> str:
    return f"translate(lpad(CAST({key} * 7919 % 100000000 AS STRING), 8, '0'), '0123456789', 'PEGNTIKLAV') || 'K'"


DATABASE = f"""
SELECT 'run_' || CAST(l_orderkey % 8 AS STRING) AS RAW_FILE, l_orderkey AS SCAN_NUMBER,
       replace({peptide("l_partkey")}, 'GG', CASE WHEN l_linenumber % 2 = 0 THEN 'GG[UNIMOD:4]' ELSE 'GG' END) AS MODIFIED_SEQUENCE,
       2 + l_linenumber % 3 AS PRECURSOR_CHARGE, l_extendedprice / 100 AS MASS, l_quantity * 2 AS SCORE, {peptide("l_partkey")} AS SEQUENCE,
       l_linenumber AS num_missed_cleavages, l_returnflag = 'R' AS REVERSE, CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS Label,
       l_quantity - 15 AS percolator_score, l_discount AS f_discount, l_tax AS f_tax, l_extendedprice AS f_price, l_quantity AS f_quantity,
       l_discount * 5 + l_tax * 3 + l_quantity / 100 AS ISO_scores
FROM lineitem"""

DENOVO = f"""
SELECT 'run_' || CAST(o_orderkey % 8 AS STRING) AS RAW_FILE, o_orderkey + CASE WHEN o_orderkey % 5 = 0 THEN {ELSEWHERE} ELSE 0 END AS SCAN_NUMBER, q.s AS MODIFIED_SEQUENCE, 2 + CAST(o_orderkey % 3 AS INT) AS PRECURSOR_CHARGE,
       o_totalprice / 500 AS MASS, o_totalprice / 500000 AS SCORE, o_orderstatus = 'F' AS REVERSE, q.s AS SEQUENCE,
       CAST(o_orderkey % 10 AS STRING) || '|' || CAST(o_custkey % 10 AS STRING) AS AA_SCORE, o_totalprice / 400000 AS percolator_score,
       CAST(o_custkey % 11 AS DOUBLE) / 100 AS f_discount, CAST(o_custkey % 9 AS DOUBLE) / 100 AS f_tax, o_totalprice AS f_price, CAST(o_custkey % 50 AS DOUBLE) AS f_quantity,
       CAST(o_orderkey % 1000 AS DOUBLE) / 1000 AS ISO_scores
FROM (SELECT o.*, CASE WHEN o_orderkey % 5 = 1 OR p IS NULL THEN {peptide("coalesce(p, o_custkey)")}
                       WHEN o_orderkey % 5 = 2 THEN substr({peptide("p")}, 1, 2) || substr({peptide("p")}, 4, 1) || substr({peptide("p")}, 3, 1) || substr({peptide("p")}, 5)
                       WHEN o_orderkey % 5 = 3 THEN translate({peptide("p")}, 'LN', 'IG')
                       ELSE {peptide("o_custkey")} END AS s
      FROM orders o LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS p FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey) q"""


def register(spark: SparkSession, sf_dir: str) -> None:
    for t in ("lineitem", "orders"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def branch(spark: SparkSession, sf_dir: str, side: str, drop: tuple[str, ...] = ()) -> DataFrame:
    register(spark, sf_dir)
    return spark.sql(DATABASE if side == "database" else DENOVO).drop(*drop)
