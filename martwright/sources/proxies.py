"""Adapter for the generated test tables, the only module that knows what they lack.

The models expect the full raw schemas. The generated tables miss some columns and the whole
``partsupp`` table; fixed formulas stand in for those the models use, typed NULLs for the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.schemas import RAW
from martwright.sources.scans import conform

# Accepted codes the proxies choose from.
SHIP_MODES = ("AIR", "FOB", "MAIL", "RAIL", "REG AIR", "SHIP", "TRUCK")
SHIP_INSTRUCTIONS = ("COLLECT COD", "DELIVER IN PERSON", "NONE", "TAKE BACK RETURN")


def _pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast(({index}) % {len(values)} as int) + 1)"


def _shipped_plus(days: str) -> str:
    return f"date_add(cast(l_shipdate as date), cast({days} as int))"


# Per table: the columns a formula stands in for, as SQL expressions.
PROXIES: dict[str, dict[str, str]] = {
    "lineitem": {
        "l_commitdate": _shipped_plus("l_partkey % 61 - 30"),
        "l_receiptdate": _shipped_plus("l_suppkey % 30 + 1"),
        "l_shipinstruct": _pick(SHIP_INSTRUCTIONS, "l_orderkey"),
        "l_shipmode": _pick(SHIP_MODES, "l_partkey + l_suppkey"),
    },
    "orders": {
        "o_clerk": "concat('Clerk#', cast(o_custkey % 1000 as string))",
        "o_shippriority": "0",
    },
    "part": {"p_mfgr": "concat('Manufacturer#', cast(p_partkey % 5 + 1 as string))"},
}

# Columns with no stand-in: NULL in the models, skipped by the checks.
ABSENT: dict[str, tuple[str, ...]] = {
    "customer": ("c_address", "c_phone", "c_comment"),
    "lineitem": ("l_comment",),
    "nation": ("n_comment",),
    "orders": ("o_comment",),
    "part": ("p_container", "p_comment"),
    "partsupp": ("ps_comment",),
    "region": ("r_comment",),
    "supplier": ("s_address", "s_phone", "s_comment"),
}


def _partsupp(spark: SparkSession, folder: str) -> DataFrame:
    pairs = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_partkey", "l_suppkey")
    return pairs.distinct().selectExpr(
        "l_partkey as ps_partkey",
        "l_suppkey as ps_suppkey",
        "1 + (l_partkey + l_suppkey) % 9999 as ps_availqty",
        "(100 + (l_partkey * 7 + l_suppkey * 13) % 99901) / 100.0 as ps_supplycost",
    )


def generated_source(
    spark: SparkSession, folder: str, name: str
) -> DataFrame:
    """One generated table in its full declared schema."""
    if name == "partsupp":
        df = _partsupp(spark, folder)
    else:
        df = spark.read.parquet(f"{folder}/{name}.parquet")
    stand_ins = [f"{formula} as {c}" for c, formula in PROXIES.get(name, {}).items()]
    nulls = [f"cast(null as string) as {c}" for c in ABSENT[name]]
    return conform(df.selectExpr("*", *stand_ins, *nulls), RAW[name])


def generated_catalog(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Catalog metadata derived from the generated tables, so that it grows with them.

    Regions, nations, customers and orders form the model graph (region -> nation -> customer ->
    order). Orders are the columns of their customer's model, fulfilled orders its tests, documents
    its description and, where labelled, its source; suppliers are sources of their nation's model.
    """

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    def ident(kind: str, key: str) -> F.Column:
        return F.concat(F.lit(f"{kind}."), F.col(key).cast("string"))

    def link(df: DataFrame, parent: F.Column, child: F.Column) -> DataFrame:
        return df.select(
            parent.alias("parent_id"), child.alias("child_id"), F.lit("model").alias("child_type")
        )

    region, nation, customer = read("region"), read("nation"), read("customer")
    orders, supplier, documents = read("orders"), read("supplier"), read("documents")
    text = documents.select(F.col("doc_id").alias("c_custkey"), F.col("text").alias("description"))
    order_model = ident("model.customer", "o_custkey")
    models = (
        region.select(
            ident("model.region", "r_regionkey").alias("model_id"),
            F.col("r_name").alias("name"),
            F.lit("platform").alias("project"),
            F.lit("staging").alias("layer"),
            F.lit("public").alias("access"),
            F.lit(None).cast("string").alias("description"),
            F.lit(False).alias("enforced"),
        )
        .unionByName(
            nation.select(
                ident("model.nation", "n_nationkey").alias("model_id"),
                F.col("n_name").alias("name"),
                F.lit("platform").alias("project"),
                F.lit("intermediate").alias("layer"),
                F.lit("protected").alias("access"),
                F.col("n_name").alias("description"),
                F.lit(False).alias("enforced"),
            )
        )
        .unionByName(
            customer.join(text, "c_custkey", "left").select(
                ident("model.customer", "c_custkey").alias("model_id"),
                F.col("c_name").alias("name"),
                F.lower("c_mktsegment").alias("project"),
                F.lit("marts").alias("layer"),
                F.when(F.col("c_acctbal") >= 0, "public").otherwise("protected").alias("access"),
                "description",
                F.coalesce(F.col("c_acctbal") >= 5000, F.lit(False)).alias("enforced"),
            )
        )
    )
    columns = orders.select(
        order_model.alias("model_id"),
        ident("order", "o_orderkey").alias("name"),
        F.col("o_orderpriority").alias("description"),
        F.when(F.col("o_orderstatus") == "F", "number")
        .when(F.col("o_orderstatus") == "O", "varchar")
        .alias("data_type"),
    )
    tests = orders.filter("o_orderstatus = 'F'").select(
        ident("test", "o_orderkey").alias("test_id"), order_model.alias("model_id")
    )
    sources = supplier.select(
        ident("source.supplier", "s_suppkey").alias("source_id"),
        (F.col("s_acctbal") >= 0).alias("has_freshness"),
    ).unionByName(
        documents.select(
            ident("source.document", "doc_id").alias("source_id"),
            (F.col("lang") == "en").alias("has_freshness"),
        )
    )
    edges = (
        link(nation, ident("model.region", "n_regionkey"), ident("model.nation", "n_nationkey"))
        .unionByName(
            link(
                customer, ident("model.nation", "c_nationkey"), ident("model.customer", "c_custkey")
            )
        )
        .unionByName(link(orders, order_model, ident("model.order", "o_orderkey")))
        .unionByName(
            link(
                supplier,
                ident("source.supplier", "s_suppkey"),
                ident("model.nation", "s_nationkey"),
            )
        )
        .unionByName(
            link(
                read("labels"),
                ident("source.document", "doc_id"),
                ident("model.customer", "doc_id"),
            )
        )
    )
    return {
        "models": models,
        "columns": columns,
        "tests": tests,
        "sources": sources,
        "edges": edges,
    }
