"""Column clean-up, missing values, quantiles and derived features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from engage.functions import haversine_miles, rounded
from engage.operators import audit, enrich, prep
from engage.plans.fixtures import GEO, MEMBER_SNAPSHOTS, WITH_NULLS, derive, table, with_ctes
from engage.sources import sinks

WIDE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PROBS = [0.01, 0.25, 0.5, 0.95]


def _rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: rounded(c, digits) for c in cols})


def sanitize_columns(spark: SparkSession, folder: str) -> DataFrame:
    odd = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer key"),
        F.col("c_name").alias("name=(full)"),
        F.col("c_acctbal").alias("bal,ance"),
        F.col("c_mktsegment").alias("bal;ance"),
        F.col("c_nationkey").alias("bal{ance"),
    )
    return sinks.sanitize_columns(odd)


def align_schema(spark: SparkSession, folder: str) -> DataFrame:
    target = T.StructType(
        [
            T.StructField("c_nationkey", T.LongType()),
            T.StructField("c_custkey", T.StringType()),
            T.StructField("c_mktsegment", T.IntegerType()),
            T.StructField("c_phone", T.StringType()),
            T.StructField("c_since", T.DateType()),
            T.StructField("c_acctbal", T.DoubleType()),
        ]
    )
    return sinks.align_to_schema(table(spark, folder, "customer"), target)


def ensure_columns(spark: SparkSession, folder: str) -> DataFrame:
    wanted = {"n_name": "string", "llm_start_time": "string", "n_seen": "bigint"}
    return sinks.ensure_columns(table(spark, folder, "nation"), wanted)


def _repeated(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").selectExpr("c_custkey id", "c_name name", "c_nationkey key", "c_acctbal bal")
    nation = table(spark, folder, "nation").selectExpr("n_nationkey nk", "n_name name", "n_regionkey key")
    return enrich.join_lookup(customer.withColumn("nk", F.col("key")), nation, "nk")


def drop_duplicate_columns(spark: SparkSession, folder: str) -> DataFrame:
    return prep.drop_duplicate_columns(_repeated(spark, folder))


def drop_all_duplicate_columns(spark: SparkSession, folder: str) -> DataFrame:
    return prep.drop_duplicate_columns(_repeated(spark, folder), keep="none")


def drop_matching(spark: SparkSession, folder: str) -> DataFrame:
    upper = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS ORDER_ID", "l_shipdate AS SHIP_DT", "l_quantity AS QUANTITY", "l_returnflag AS HOME_FLAG",
        "l_discount AS DISCOUNT", "l_linestatus AS Status", "l_tax AS TAX", "l_linenumber AS LINE",
    )
    return prep.drop_matching(upper, also=["TAX"])


def join_dims_large(spark: SparkSession, folder: str) -> DataFrame:
    """An int key against a bigint dimension beyond the bound for broadcasts."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").cast("int").alias("c_custkey"))
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    return enrich.join_dim(orders, customer, "c_custkey", matched="known", max_rows=10).withColumn(
        "c_custkey", F.col("c_custkey").cast("long")
    )


def quantiles_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Sketched quantiles with rank error 0.01: whether the share of values up to each lies that near."""
    rows = table(spark, folder, "orders").select("o_totalprice")
    found = prep.approx_quantile(rows, ["o_totalprice"], [0.05, 0.25, 0.5, 0.95])
    value = F.col("o_totalprice")
    near = [
        F.struct(
            F.lit(r["column"]).alias("column"),
            F.lit(r["prob"]).alias("prob"),
            (
                (F.avg((value <= r["value"]).cast("int")) >= r["prob"] - 0.01)
                & (F.avg((value < r["value"]).cast("int")) <= r["prob"] + 0.01)
            ).alias("near"),
        )
        for r in found.collect()  # one row per probability
    ]
    return rows.agg(F.array(*near).alias("n")).select(F.inline("n"))


def join_dims(spark: SparkSession, folder: str) -> DataFrame:
    """Area dims by shared and differing keys; the provider side repeats its keys, so rows fan out."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, folder, "region")
    with_nation = enrich.join_dim(customer, nation, "c_nationkey", "n_nationkey")
    with_region = enrich.join_dim(with_nation, region, "n_regionkey", "r_regionkey")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    return enrich.join_dim(with_region, supplier, "c_nationkey", "s_nationkey", matched="has_supplier").select(
        "c_custkey", "n_name", "r_name", "s_suppkey", "has_supplier"
    )


def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    first = table(spark, folder, "supplier").selectExpr("s_suppkey key", "s_name name", "s_acctbal bal")
    second = table(spark, folder, "customer").selectExpr("c_acctbal bal", "c_custkey key", "c_name name")
    return enrich.union_tables(first, second, first)


def fill_constant(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(prep.fill_constant(derive(spark, folder, WITH_NULLS)), 4, "spent")


def fill_blank(spark: SparkSession, folder: str) -> DataFrame:
    filled = prep.fill_blank(derive(spark, folder, WITH_NULLS), {"segment": "Unknown", "n_orders": 0})
    return filled.select("id", "segment", "n_orders")


def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    imputed = prep.impute_median(derive(spark, folder, WITH_NULLS), ["balance", "spent", "n_orders"])
    return _rounded(imputed.select("id", "balance", "spent", "n_orders"), 4, "balance", "spent")


def non_null_columns(spark: SparkSession, folder: str) -> DataFrame:
    return prep.non_null_columns(derive(spark, folder, WITH_NULLS))


def drop_empty_columns(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(prep.drop_empty_columns(derive(spark, folder, WITH_NULLS)), 4, "spent")


def quantiles(spark: SparkSession, folder: str) -> DataFrame:
    return prep.quantile(table(spark, folder, "lineitem"), WIDE, PROBS)


def describe(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(prep.describe(table(spark, folder, "lineitem"), WIDE), 4, "mean", "stddev")


def trim_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return prep.trim_quantiles(orders, "o_totalprice")


def tenure(spark: SparkSession, folder: str) -> DataFrame:
    snapshots = derive(spark, folder, MEMBER_SNAPSHOTS)
    return prep.tenure(snapshots).select("member_id", "study_end_dt", "tenure")


def haversine(spark: SparkSession, folder: str) -> DataFrame:
    miles = haversine_miles(*[F.col(c) for c in ("lat1", "lon1", "lat2", "lon2")])
    return derive(spark, folder, GEO).select("id", rounded(miles, 6).alias("miles"))


def distance_feature(spark: SparkSession, folder: str) -> DataFrame:
    out = prep.distance_feature(derive(spark, folder, GEO), "fl", ("lat1", "lon1", "lat2", "lon2"))
    return out.select("id", "fl", rounded("pcp_distance", 6).alias("pcp_distance"))


def optional_enrich(spark: SparkSession, folder: str) -> DataFrame:
    """One source switched on, one off."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    totals = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_orderpriority").alias("plan")
    )
    on = enrich.optional(customer, totals, "c_custkey", {"n_orders": 0, "plan": "Not Available"})
    return enrich.optional(on, None, "c_custkey", {"csat": "Not Available", "nps": -1})


def flatten_json(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "props")
    return enrich.flatten_json(events, "props", "k long, absent struct<x: string>")


def flatten_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines holding an array of structs, flattened to rows; a line with an empty array keeps one."""

    def fact(name: str, column: str) -> Column:
        return F.struct(F.lit(name).alias("name"), F.struct(F.col(column).alias("value")).alias("of"))

    facts = F.array(fact("quantity", "l_quantity"), fact("discount", "l_discount"))
    empty = F.slice(facts, 1, 0)
    return enrich.flatten(
        table(spark, folder, "lineitem").select(
            "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", empty).otherwise(facts).alias("facts")
        )
    )


def shape(spark: SparkSession, folder: str) -> DataFrame:
    return audit.shape(table(spark, folder, "lineitem"))


def partition_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per partition of a range-partitioned read, summed to one total row per run."""
    sizes = audit.partition_sizes(table(spark, folder, "orders").repartition(16, "o_orderkey"))
    return sizes.agg(F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("n"))


def column_types(spark: SparkSession, folder: str) -> DataFrame:
    """Numeric columns of a table summed, text columns counted, by the type split."""
    lineitem = table(spark, folder, "lineitem")
    numeric, text = prep.column_types(lineitem)
    return lineitem.agg(
        *[rounded(F.sum(F.col(c).cast("double")), 2).alias(c) for c in numeric], *[F.count(c).alias(c) for c in text]
    )


def _stack(expressions: dict[str, str], source: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS column, {sql} FROM {source}".replace("$c", name) for name, sql in expressions.items()
    )


MILES = """2 * atan2(sqrt(least(h, 1)), sqrt(1 - least(h, 1))) * 3958.8"""
GEO_H = """
SELECT *, pow(sin((radians(lat2) - radians(lat1)) / 2), 2)
       + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin((radians(lon2) - radians(lon1)) / 2), 2) AS h FROM geo
"""

QUERIES = {
    "sanitize_columns": sanitize_columns,
    "align_schema": align_schema,
    "ensure_columns": ensure_columns,
    "drop_duplicate_columns": drop_duplicate_columns,
    "drop_all_duplicate_columns": drop_all_duplicate_columns,
    "drop_matching": drop_matching,
    "join_dims": join_dims,
    "join_dims_large": join_dims_large,
    "quantiles_sketch": quantiles_sketch,
    "union_by_name": union_by_name,
    "fill_constant": fill_constant,
    "fill_blank": fill_blank,
    "impute_median": impute_median,
    "non_null_columns": non_null_columns,
    "drop_empty_columns": drop_empty_columns,
    "column_types": column_types,
    "quantiles": quantiles,
    "describe": describe,
    "trim_quantiles": trim_quantiles,
    "tenure": tenure,
    "haversine_miles": haversine,
    "distance_feature": distance_feature,
    "optional_enrich": optional_enrich,
    "flatten_json": flatten_json,
    "flatten_arrays": flatten_arrays,
    "shape": shape,
    "partition_sizes": partition_sizes,
}

ORACLE = {
    "sanitize_columns": """SELECT c_custkey AS customer_key, c_name AS "name__full_", c_acctbal AS bal_ance,
       c_mktsegment AS bal_ance_dup, c_nationkey AS bal_ance_dup2 FROM customer""",
    "align_schema": """SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(c_custkey AS VARCHAR) AS c_custkey,
       TRY_CAST(c_mktsegment AS INT) AS c_mktsegment, CAST(NULL AS VARCHAR) AS c_phone, CAST(NULL AS DATE) AS c_since,
       c_acctbal FROM customer""",
    "ensure_columns": """SELECT *, CAST(NULL AS VARCHAR) AS llm_start_time, CAST(NULL AS BIGINT) AS n_seen FROM nation""",
    "drop_duplicate_columns": """SELECT c_custkey AS id, c_name AS name, c_nationkey AS key, c_acctbal AS bal,
       c_nationkey AS nk FROM customer""",
    "drop_all_duplicate_columns": "SELECT c_custkey AS id, c_acctbal AS bal, c_nationkey AS nk FROM customer",
    "drop_matching": """SELECT l_quantity AS "QUANTITY", l_discount AS "DISCOUNT", l_linestatus AS "Status", l_linenumber AS "LINE" FROM lineitem""",
    "join_dims": """SELECT c_custkey, n_name, r_name, s_suppkey, CASE WHEN s_suppkey IS NULL THEN 0 ELSE 1 END AS has_supplier
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
LEFT JOIN supplier ON s_nationkey = c_nationkey""",
    "join_dims_large": """SELECT o_orderkey, o_custkey AS c_custkey, c_name, CASE WHEN c_name IS NULL THEN 0 ELSE 1 END AS known
FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
    "quantiles_sketch": "SELECT 'o_totalprice' AS \"column\", p AS prob, TRUE AS near FROM (VALUES (0.05::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.95::DOUBLE)) v(p)",
    "union_by_name": """SELECT s_suppkey AS key, s_name AS name, s_acctbal AS bal FROM supplier
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""",
    "fill_constant": with_ctes(
        """SELECT id, coalesce(segment, 'missing') AS segment, coalesce(balance, -1) AS balance,
       round(coalesce(spent, -1), 4) AS spent, coalesce(n_orders, -1) AS n_orders, coalesce(nothing, -1) AS nothing FROM n""",
        n=WITH_NULLS,
    ),
    "fill_blank": with_ctes(
        """SELECT id, CASE WHEN coalesce(trim(segment), '') = '' THEN 'Unknown' ELSE segment END AS segment,
       coalesce(n_orders, 0) AS n_orders FROM n""",
        n=WITH_NULLS,
    ),
    "impute_median": with_ctes(
        """SELECT id, round(coalesce(balance, (SELECT quantile_disc(balance, 0.5) FROM n)), 4) AS balance,
       round(coalesce(spent, (SELECT quantile_disc(spent, 0.5) FROM n)), 4) AS spent,
       coalesce(n_orders, (SELECT quantile_disc(n_orders, 0.5) FROM n)) AS n_orders FROM n""",
        n=WITH_NULLS,
    ),
    "non_null_columns": with_ctes(
        _stack({c: 'count("$c") AS n' for c in ("id", "balance", "spent", "n_orders", "nothing")}, "n"), n=WITH_NULLS
    ),
    "drop_empty_columns": with_ctes("SELECT id, segment, balance, round(spent, 4) AS spent, n_orders FROM n", n=WITH_NULLS),
    "column_types": """SELECT round(sum(l_orderkey::DOUBLE), 2) AS l_orderkey, round(sum(l_partkey::DOUBLE), 2) AS l_partkey,
       round(sum(l_suppkey::DOUBLE), 2) AS l_suppkey, round(sum(l_linenumber::DOUBLE), 2) AS l_linenumber,
       round(sum(l_quantity), 2) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice,
       round(sum(l_discount), 2) AS l_discount, round(sum(l_tax), 2) AS l_tax, count(l_returnflag) AS l_returnflag,
       count(l_linestatus) AS l_linestatus FROM lineitem""",
    "quantiles": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column, CAST({p} AS DOUBLE) AS prob, quantile_disc({c}, {p}) AS value FROM lineitem"
        for c in WIDE
        for p in PROBS
    ),
    "describe": _stack(
        {
            c: """count($c) AS n, round(avg($c), 4) AS mean, round(stddev_samp($c), 4) AS stddev, min($c) AS min,
       quantile_disc($c, 0.25) AS p25, quantile_disc($c, 0.5) AS p50, quantile_disc($c, 0.75) AS p75, max($c) AS max"""
            for c in WIDE
        },
        "lineitem",
    ),
    "trim_quantiles": """SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice BETWEEN (SELECT quantile_disc(o_totalprice, 0.01) FROM orders) AND (SELECT quantile_disc(o_totalprice, 0.95) FROM orders)""",
    "tenure": with_ctes(
        """SELECT member_id, study_end_dt,
       CAST(date_diff('day', first_elig_month_start_dt, last_elig_month_end_dt) AS INT) AS tenure FROM m""",
        m=MEMBER_SNAPSHOTS,
    ),
    "haversine_miles": with_ctes(f"SELECT id, round({MILES}, 6) AS miles FROM hs", geo=GEO, hs=GEO_H),
    "distance_feature": with_ctes(
        """SELECT id, fl, round(CASE WHEN fl = 1 THEN d ELSE (SELECT quantile_disc(d, 0.5) FROM ds WHERE fl = 1) END, 6) AS pcp_distance FROM ds""",
        geo=GEO,
        hs=GEO_H,
        ds=f"SELECT *, {MILES} AS d FROM hs",
    ),
    "optional_enrich": """SELECT c_custkey, c_mktsegment, coalesce(t.n, 0) AS n_orders, coalesce(t.plan, 'Not Available') AS plan,
       'Not Available' AS csat, -1 AS nps
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_orderpriority) AS plan FROM orders GROUP BY 1) t ON t.o_custkey = c_custkey""",
    "flatten_json": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k, CAST(NULL AS VARCHAR) AS props_absent_x FROM events""",
    "flatten_arrays": """SELECT l_orderkey, l_linenumber, 'quantity' AS facts_name, l_quantity AS facts_of_value FROM lineitem WHERE l_returnflag <> 'R'
UNION ALL SELECT l_orderkey, l_linenumber, 'discount', l_discount FROM lineitem WHERE l_returnflag <> 'R'
UNION ALL SELECT l_orderkey, l_linenumber, NULL, NULL FROM lineitem WHERE l_returnflag = 'R'""",
    "shape": "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem",
    "partition_sizes": "SELECT CAST(16 AS BIGINT) AS partitions, count(*) AS n FROM orders",
}
