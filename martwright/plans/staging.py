"""Platform staging: rename, cast dates, add the surrogate key. No joins, no aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions import strip_prefix, surrogate_key


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _renamed(df: DataFrame, dates: bool) -> list[Column]:
    """Every column without its source prefix; with ``dates``, timestamps as dates."""
    columns = []
    for name, kind in df.dtypes:
        value = F.col(_quoted(name))
        if dates and kind.startswith("timestamp"):
            value = value.cast("date")
        columns.append(value.alias(strip_prefix(name)))
    return columns


def _key(name: str, columns: tuple[str, ...]) -> Column:
    return surrogate_key(*map(_quoted, columns)).alias(name)


def stage(df: DataFrame, key_name: str, key_columns: tuple[str, str]) -> DataFrame:
    """Surrogate key first, then every column without its source prefix; timestamps become dates."""
    return df.select(_key(key_name, key_columns), *_renamed(df, dates=True))


def stg_tpch__customer(customer: DataFrame) -> DataFrame:
    return stage(customer, "customer_key", ("c_custkey", "c_name"))


def stg_tpch__lineitem(lineitem: DataFrame) -> DataFrame:
    """Keyed by order and part here; the commercial and product keys use the line number."""
    return stage(lineitem, "lineitem_key", ("l_orderkey", "l_partkey"))


def stg_tpch__nation(nation: DataFrame) -> DataFrame:
    return stage(nation, "nation_key", ("n_nationkey", "n_name"))


def stg_tpch__orders(orders: DataFrame) -> DataFrame:
    return stage(orders, "orders_key", ("o_orderkey", "o_custkey"))


def stg_tpch__part(part: DataFrame) -> DataFrame:
    return stage(part, "part_key", ("p_partkey", "p_name"))


def stg_tpch__partsupp(partsupp: DataFrame) -> DataFrame:
    return stage(partsupp, "partsupp_key", ("ps_partkey", "ps_suppkey"))


def stg_tpch__region(region: DataFrame) -> DataFrame:
    return stage(region, "region_key", ("r_regionkey", "r_name"))


def stg_tpch__supplier(supplier: DataFrame) -> DataFrame:
    return stage(supplier, "supplier_key", ("s_suppkey", "s_name"))


STAGING = {
    "customer": stg_tpch__customer,
    "lineitem": stg_tpch__lineitem,
    "nation": stg_tpch__nation,
    "orders": stg_tpch__orders,
    "part": stg_tpch__part,
    "partsupp": stg_tpch__partsupp,
    "region": stg_tpch__region,
    "supplier": stg_tpch__supplier,
}


def auto_stage(
    df: DataFrame, table: str, key_columns: tuple[str, str] | None = None
) -> DataFrame:
    """A staging model for any table: its first two columns make the surrogate key, and every column
    keeps its type, so a timestamp keeps its time of day.

    A first column named ``...key``, in any case, is a key of its own, so none is added then unless
    the key columns are given.
    """
    columns = _renamed(df, dates=False)
    if key_columns is None and df.columns[0].lower().endswith("key"):
        return df.select(*columns)
    return df.select(_key(f"{table}_key", key_columns or tuple(df.columns[:2])), *columns)
