"""The tables the queries run on, and the rules bound to their column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.plans.policy import Policy
from plumbline.queries.registry import table

# Column, type and kind (n numeric, s string, o other) of the given tables.
SCHEMAS: dict[str, list[tuple[str, str, str]]] = {
    "region": [("r_regionkey", "int", "n"), ("r_name", "string", "s")],
    "nation": [
        ("n_nationkey", "int", "n"),
        ("n_name", "string", "s"),
        ("n_regionkey", "int", "n"),
    ],
    "customer": [
        ("c_custkey", "bigint", "n"),
        ("c_name", "string", "s"),
        ("c_nationkey", "int", "n"),
        ("c_acctbal", "double", "n"),
        ("c_mktsegment", "string", "s"),
    ],
    "supplier": [
        ("s_suppkey", "bigint", "n"),
        ("s_name", "string", "s"),
        ("s_nationkey", "int", "n"),
        ("s_acctbal", "double", "n"),
    ],
    "part": [
        ("p_partkey", "bigint", "n"),
        ("p_name", "string", "s"),
        ("p_brand", "string", "s"),
        ("p_type", "string", "s"),
        ("p_size", "int", "n"),
        ("p_retailprice", "double", "n"),
    ],
    "orders": [
        ("o_orderkey", "bigint", "n"),
        ("o_custkey", "bigint", "n"),
        ("o_orderstatus", "string", "s"),
        ("o_totalprice", "double", "n"),
        ("o_orderdate", "timestamp_ntz", "o"),
        ("o_orderpriority", "string", "s"),
    ],
    "lineitem": [
        ("l_orderkey", "bigint", "n"),
        ("l_partkey", "bigint", "n"),
        ("l_suppkey", "bigint", "n"),
        ("l_linenumber", "int", "n"),
        ("l_quantity", "double", "n"),
        ("l_extendedprice", "double", "n"),
        ("l_discount", "double", "n"),
        ("l_tax", "double", "n"),
        ("l_returnflag", "string", "s"),
        ("l_linestatus", "string", "s"),
        ("l_shipdate", "timestamp_ntz", "o"),
    ],
    "events": [
        ("event_id", "bigint", "n"),
        ("ts", "timestamp_ntz", "o"),
        ("user_id", "bigint", "n"),
        ("event_type", "string", "s"),
        ("value", "double", "n"),
        ("props", "string", "s"),
    ],
    "documents": [
        ("doc_id", "bigint", "n"),
        ("text", "string", "s"),
        ("lang", "string", "s"),
        ("source", "string", "s"),
        ("n_chars", "bigint", "n"),
    ],
    "embeddings": [
        ("vec_id", "bigint", "n"),
        ("embedding", "array<float>", "o"),
        ("label", "int", "n"),
    ],
    "pages": [("page_id", "bigint", "n"), ("url", "string", "s"), ("html", "string", "s")],
    "benchmark": [("item_id", "bigint", "n"), ("text", "string", "s")],
    "labels": [("doc_id", "bigint", "n"), ("quality", "int", "n"), ("toxic", "int", "n")],
    "conversations": [
        ("conv_id", "bigint", "n"),
        ("turn", "bigint", "n"),
        ("role", "string", "s"),
        ("text", "string", "s"),
    ],
}

TABLES = list(SCHEMAS)

# Orders with the defects that the rules look for: null shares in every band, blanks, a constant.
# The text is read by both engines.
PATCHY_ORDERS = """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
           nullif(o_orderstatus, 'F') AS o_open_status,
           CASE WHEN o_totalprice > 300000 THEN o_totalprice END AS o_large_price,
           CASE WHEN o_totalprice > 490000 THEN o_custkey END AS o_top_custkey,
           nullif(o_orderstatus, o_orderstatus) AS o_comment,
           CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '4-NOT SPECIFIED' THEN ' '
                ELSE o_orderpriority END AS o_note,
           0 AS o_shippriority
    FROM orders
"""
LABELLED_DOCUMENTS = """
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""
# No order has a negative price.
NO_ORDERS = "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice < 0"

FUNDED_CUSTOMERS = "SELECT * FROM customer WHERE c_acctbal > 0"

DERIVED = {
    "patchy_orders": PATCHY_ORDERS,
    "labelled_documents": LABELLED_DOCUMENTS,
    "no_orders": NO_ORDERS,
    "funded_customers": FUNDED_CUSTOMERS,
}
SCHEMAS |= {
    "patchy_orders": [
        ("o_orderkey", "bigint", "n"),
        ("o_custkey", "bigint", "n"),
        ("o_totalprice", "double", "n"),
        ("o_orderdate", "timestamp_ntz", "o"),
        ("o_open_status", "string", "s"),
        ("o_large_price", "double", "n"),
        ("o_top_custkey", "bigint", "n"),
        ("o_comment", "string", "s"),
        ("o_note", "string", "s"),
        ("o_shippriority", "int", "n"),
    ],
    "labelled_documents": [*SCHEMAS["documents"], ("quality", "int", "n"), ("toxic", "int", "n")],
    "no_orders": [("o_orderkey", "bigint", "n"), ("o_orderstatus", "string", "s")],
    "funded_customers": SCHEMAS["customer"],
}
_NEEDS = {
    "patchy_orders": ["orders"],
    "labelled_documents": ["documents", "labels"],
    "no_orders": ["orders"],
    "funded_customers": ["customer"],
}

# What the profile and check queries look at.
PROFILED = [
    "patchy_orders",
    "lineitem",
    "customer",
    "supplier",
    "part",
    "events",
    "labelled_documents",
    "embeddings",
    "pages",
    "conversations",
]
ASSESSED = ["patchy_orders", "lineitem", "customer", "part", "labelled_documents", "embeddings", "no_orders"]

# The column rules, bound to the names of the given tables.
POLICY = Policy(
    id_pattern=r"(key|_id)$",
    binary_pattern=r"^(quality|toxic|label)$",
    non_positive_pattern=r"(discount|tax)$",
    non_negative_pattern=r"(acctbal|price|value)$",
    amount_pattern=r"(acctbal|price|quantity|size)$",
    long_string=1000,
)


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or one of the tables derived above."""
    if name not in DERIVED:
        return table(spark, sf_dir, name)
    text = DERIVED[name]
    frames = {needed: table(spark, sf_dir, needed) for needed in _NEEDS[name]}
    for needed in frames:
        text = text.replace(f"FROM {needed}", f"FROM {{{needed}}}").replace(
            f"JOIN {needed}", f"JOIN {{{needed}}}"
        )
    return spark.sql(text, **frames)


def sources(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: source(spark, sf_dir, name) for name in names}


def event_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their day as the run they arrived in."""
    events = table(spark, sf_dir, "events")
    return events.withColumn("run_id", F.to_date("ts").cast("string"))


def yearly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their year as the run they arrived in."""
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn("run_id", F.year("o_orderdate").cast("string"))
