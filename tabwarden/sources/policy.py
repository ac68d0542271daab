"""The policy table: the domain's columns bound to the star-schema tables, with nulls, sentinel zeros and junk by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Column and expression, in SQL that Spark and DuckDB read alike.
EXPRESSIONS = {
    "ORDER_KEY": "l_orderkey", "LINE": "l_linenumber", "SEX": "CAST(l_linenumber % 3 AS VARCHAR(9))", "INSR_BEGIN": "l_shipdate", "INSR_TYPE": "concat('120', CAST(l_suppkey % 3 AS VARCHAR(9)))",
    "INSURED_VALUE": "CASE WHEN l_linenumber % 2 = 0 THEN 0.0 ELSE l_extendedprice END",
    "PREMIUM": "CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_extendedprice * l_tax END",
    "PROD_YEAR": "1960 + p_size", "SEATS_NUM": "CAST(l_quantity AS INT) % 9",
    "CARRYING_CAPACITY": "CASE l_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0.0 ELSE l_quantity * 100 END",
    "EFFECTIVE_YR": "CASE WHEN l_orderkey % 97 = 0 THEN '4D' WHEN l_orderkey % 89 = 0 THEN '1C' ELSE CAST(1960 + p_size AS VARCHAR(9)) END",
    "TYPE_VEHICLE": "p_type", "MAKE": "CASE WHEN p_brand = 'Brand#11' AND l_linenumber % 2 = 0 THEN 'brand#11' ELSE p_brand END", "USAGE": "l_linestatus",
    "CLAIM_PAID": "CASE WHEN l_discount >= 0.09 THEN l_discount END", "HAS_CLAIM": "CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END",
    "SCORE": "(l_orderkey * 31 + l_linenumber * 17) % 1000 / 1000.0",
}
#: The end of a policy; the engines add days to a time differently.
END_SQL = "l_shipdate + to_days(CAST(365 - l_linenumber AS INT))"

POLICY_SQL = "policy AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in EXPRESSIONS.items()) + f", {END_SQL} AS INSR_END FROM lineitem JOIN part ON l_partkey = p_partkey)"

NUMERIC = ["INSURED_VALUE", "PREMIUM", "PROD_YEAR", "SEATS_NUM", "CARRYING_CAPACITY"]
CATEGORICAL = ["SEX", "INSR_TYPE", "TYPE_VEHICLE", "MAKE", "USAGE"]
FEATURES = [*NUMERIC, *CATEGORICAL]


def policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalyst reads only the columns that a query uses; the small part table is broadcast if its size allows."""
    lineitem, part = spark.read.parquet(f"{sf_dir}/lineitem.parquet"), spark.read.parquet(f"{sf_dir}/part.parquet")
    both = lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"])
    end = F.expr("l_shipdate + make_dt_interval(365 - l_linenumber)")
    return both.select(*[F.expr(e.replace("VARCHAR(9)", "STRING")).alias(c) for c, e in EXPRESSIONS.items()], end.alias("INSR_END"))
