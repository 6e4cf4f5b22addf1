"""Profiles and suggested checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from martwright.functions import strip_prefix
from martwright.operators.checks import run_checks
from martwright.operators.contracts import type_names
from martwright.operators.profiling import (
    TYPE_BY_NAME,
    key_index,
    null_counts,
    profile,
    profile_tables,
    row_counts,
    sample_tables,
    schema_columns,
    static_checks,
    suggest_checks,
    to_checks,
    type_inference_diff,
)
from martwright.plans.staging import auto_stage
from martwright.registry.base import Domain, case
from martwright.registry.sqltext import part, sql

# The generated tables as they lie on disk: column names and contract types.
STORED = {
    "customer": "c_custkey:number c_name:varchar c_nationkey:number c_acctbal:float"
    " c_mktsegment:varchar",
    "lineitem": "l_orderkey:number l_partkey:number l_suppkey:number l_linenumber:number"
    " l_quantity:float l_extendedprice:float l_discount:float l_tax:float l_returnflag:varchar"
    " l_linestatus:varchar l_shipdate:timestamp_ntz",
    "nation": "n_nationkey:number n_name:varchar n_regionkey:number",
    "orders": "o_orderkey:number o_custkey:number o_orderstatus:varchar o_totalprice:float"
    " o_orderdate:timestamp_ntz o_orderpriority:varchar",
    "part": "p_partkey:number p_name:varchar p_brand:varchar p_type:varchar p_size:number"
    " p_retailprice:float",
    "region": "r_regionkey:number r_name:varchar",
    "supplier": "s_suppkey:number s_name:varchar s_nationkey:number s_acctbal:float",
}
COLUMNS = {t: [c.split(":") for c in text.split()] for t, text in STORED.items()}
LIMIT = 10


def _profile_sql(table: str, rename=lambda c: c) -> str:
    rows = []
    for ordinal, (column, kind) in enumerate(COLUMNS[table], start=1):
        rows.append(
            f"select '{table}' as table_name, '{rename(column)}' as column_name,"
            f" {ordinal} as ordinal, '{kind}' as data_type, n as row_count,"
            f" n - filled as null_count, d as distinct_count,"
            f" case when n > 0 then cast(n - filled as double) / n else 0.0 end as null_rate,"
            f" d = n and filled = n as is_unique"
            f" from (select count(*) as n, count({column}) as filled,"
            f" count(distinct {column}) as d from {table})"
        )
    return "\nunion all ".join(rows)


def _samples_sql(table: str, rename=lambda c: c) -> str:
    return "\nunion all ".join(
        f"select '{table}' as table_name, '{rename(column)}' as column_name, vals"
        f" from (select list_sort(list(distinct {column})) as raw,"
        f" list_transform(list_sort(list(distinct {column})), lambda v: cast(v as varchar)) as vals"
        f" from {table} having count(distinct {column}) between 1 and {LIMIT})"
        for column, _ in COLUMNS[table]
    )


part("profiled", "\nunion all ".join(_profile_sql(t, strip_prefix) for t in COLUMNS))
part("samples", "\nunion all ".join(_samples_sql(t, strip_prefix) for t in COLUMNS))
part(
    "owners",
    """
    select column_name, min(table_name) as owner
    from (select table_name, arg_min(column_name, ordinal) as column_name
          from profiled where is_unique and row_count > 0 group by 1)
    group by 1""",
)
part(
    "facts",
    """
    select p.*, owner, vals, ends_with(p.column_name, 'key') as is_key,
           regexp_matches(p.column_name, 'comment|note|remark|description') as is_text,
           count(*) filter (ends_with(p.column_name, 'key')) over (partition by p.table_name)
             as keys
    from profiled p left join owners o on o.column_name = p.column_name
    left join samples s on s.table_name = p.table_name and s.column_name = p.column_name""",
)
part(
    "suggested",
    """
    select table_name, column_name, 'not_null' as check_kind, 'error' as severity,
           cast(null as varchar) as argument
    from facts where null_count = 0 and not is_text
    union all
    select table_name, column_name, 'unique', 'error', null
    from facts where is_unique and is_key and ordinal = 1 and keys = 1
    union all
    select table_name, column_name, 'relationships', 'warn', owner
    from facts where is_key and owner is not null
      and not (is_unique and ordinal = 1 and keys = 1)
    union all
    select table_name, column_name, 'accepted_values', 'warn', list_aggregate(vals, 'string_agg', '|')
    from facts where vals is not null and not is_key and not is_text
      and distinct_count between 2 and 10""",
)


def _renamed(d: Domain, table: str):
    df = d.table(table)
    return df.toDF(*[strip_prefix(c) for c in df.columns])


def _profiles(d: Domain):
    """Profiles of all stored tables, held for the several rules that read them."""
    tables = {t: _renamed(d, t) for t in COLUMNS}
    result = profile_tables(tables)
    # one row per column: small enough to come back as a literal table, so it is computed once
    profiled = d.spark.createDataFrame(result.collect(), result.schema)
    samples = sample_tables(tables, profiled, LIMIT)
    return tables, profiled, samples


case("profile_orders", _profile_sql("orders"))(lambda d: profile(d.table("orders"), "orders"))
case("profile_lineitem", _profile_sql("lineitem"))(
    lambda d: profile(d.table("lineitem"), "lineitem")
)
case("profile_customer", _profile_sql("customer"))(
    lambda d: profile(d.table("customer"), "customer")
)


@case(
    "profile_samples",
    f"""
    select table_name, column_name, list_aggregate(vals, 'string_agg', '|') as sample_values
    from ({_samples_sql('lineitem')} union all {_samples_sql('orders')})""",
)
def profile_samples(d):
    tables = {t: d.table(t) for t in ("lineitem", "orders")}
    result = sample_tables(tables, profile_tables(tables), LIMIT)
    return result.withColumn("sample_values", F.concat_ws("|", "sample_values"))


def _with_text_argument(suggested):
    text = F.when(F.col("argument").isNotNull(), F.concat_ws("|", "argument"))
    return suggested.withColumn("argument", text)


@case("suggest_checks", sql("select * from suggested"))
def suggested(d):
    _, profiled, samples = _profiles(d)
    return _with_text_argument(suggest_checks(profiled, samples, LIMIT))


@case(
    "suggest_relationships",
    sql("""
        select table_name, column_name, argument as owner from suggested
        where check_kind = 'relationships'"""),
)
def suggested_relationships(d):
    _, profiled, samples = _profiles(d)
    wanted = suggest_checks(profiled, samples, LIMIT).filter("check_kind = 'relationships'")
    return wanted.select("table_name", "column_name", F.element_at("argument", 1).alias("owner"))


@case("suggest_key_index", sql("select * from owners"))
def suggested_key_index(d):
    return key_index(_profiles(d)[1])


@case(
    "suggested_checks_run",
    sql("""
        select check_kind || '_' || table_name || '_' || column_name as check_name, table_name,
               column_name, severity, cast(0 as bigint) as failures, 'pass' as status
        from suggested"""),
)
def suggested_checks_run(d):
    """Checks derived from the data hold on that data, when run over all of it."""
    tables, profiled, samples = _profiles(d)
    return run_checks(tables, to_checks(suggest_checks(profiled, samples, LIMIT)))


# -- schema rules, each next to what the data says --

part(
    "stored_columns",
    "\nunion all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, {i} as ordinal, '{k}' as data_type,"
        f" true as nullable"
        for t, columns in COLUMNS.items()
        for i, (c, k) in enumerate(columns, start=1)
    ),
)
part(
    "stored_rows",
    "\nunion all ".join(
        f"select '{t}' as table_name, count(*) as row_count from {t}" for t in COLUMNS
    ),
)


def _stored(d: Domain):
    return {t: d.table(t) for t in COLUMNS}


@case(
    "schema_columns",
    sql("select c.*, row_count from stored_columns c join stored_rows using (table_name)"),
)
def columns_with_counts(d):
    tables = _stored(d)
    return schema_columns(d.spark, tables).join(row_counts(tables), "table_name")


_GUESS = "case " + " ".join(
    f"when {' or '.join(f'''contains(column_name, '{p}')''' for p in parts)} then '{kind}'"
    for kind, parts in TYPE_BY_NAME
) + " else 'varchar' end"


@case(
    "type_inference_diff",
    sql(f"""
        select c.*, {_GUESS} as guessed_type, row_count
        from stored_columns c join stored_rows using (table_name)
        where {_GUESS} <> data_type"""),
)
def type_guesses(d):
    tables = _stored(d)
    wrong = type_inference_diff(schema_columns(d.spark, tables))
    return wrong.join(row_counts(tables), "table_name")


def _static_sql() -> str:
    rows = []
    for table, columns in COLUMNS.items():
        early = [c for c, _ in columns[:3] if c.endswith("key")]
        for ordinal, (column, _) in enumerate(columns, start=1):
            if not column.endswith("key"):
                continue
            checks = {"not_null": f"count(*) - count({column})"}
            if ordinal == 1 and len(early) == 1:
                checks["unique"] = (
                    f"count(*) filter (n > 1) from (select {column}, count(*) as n from {table}"
                    f" where {column} is not null group by 1)"
                )
            for kind, count in checks.items():
                source = "" if " from " in count else f" from {table}"
                rows.append(
                    f"select '{kind}_{table}_{column}' as check_name, '{table}' as table_name,"
                    f" '{column}' as column_name, 'error' as severity, failures,"
                    f" case when failures = 0 then 'pass' else 'fail' end as status"
                    f" from (select {count} as failures{source})"
                    if source
                    else f"select '{kind}_{table}_{column}', '{table}', '{column}', 'error',"
                    f" failures, case when failures = 0 then 'pass' else 'fail' end"
                    f" from (select {count.replace(' from ', ' as failures from ', 1)})"
                )
    return "\nunion all ".join(rows)


@case("static_check_inference", _static_sql())
def static_inference(d):
    """Checks that follow from names, positions and nullability, run over the tables."""
    tables = _stored(d)
    return run_checks(tables, to_checks(static_checks(schema_columns(d.spark, tables))))


case(
    "auto_stage_supplier",
    """
    select s_suppkey as suppkey, s_name as name,
           s_nationkey as nationkey, s_acctbal as acctbal
    from supplier""",
)(lambda d: auto_stage(d.table("supplier"), "supplier"))

case(
    "auto_stage_orders",
    """
    select o_orderkey as orderkey,
           o_custkey as custkey, o_orderstatus as orderstatus, o_totalprice as totalprice,
           o_orderdate as orderdate, o_orderpriority as orderpriority
    from orders""",
)(lambda d: auto_stage(d.table("orders"), "orders"))

case(
    "auto_stage_events",
    """
    select md5(event_id || '-' || ts) as events_key, event_id, ts, user_id, event_type, value, props
    from events""",
)(lambda d: auto_stage(d.table("events"), "events"))

_RAW = "case kind when 'VARCHAR' then 'string' when 'INTEGER' then 'int' when 'TIMESTAMP' then 'timestamp_ntz' else lower(kind) end"
_CONTRACT = "case kind when 'VARCHAR' then 'varchar' when 'DOUBLE' then 'float' when 'TIMESTAMP' then 'timestamp_ntz' else 'number' end"
_CAST = "case kind when 'VARCHAR' then 'varchar' when 'DOUBLE' then 'float' when 'TIMESTAMP' then 'timestamp_ntz' else lower(kind) end"
_TYPES_SQL = "\nunion all ".join(
    f"select '{table}' as table_name, '{column}' as column_name, {ordinal} as ordinal, {_RAW} as raw_type,"
    f" {_CONTRACT} as contract_type, {_CAST} as cast_name, {_RAW} as spark_type, row_count"
    f" from (select any_value(typeof({column})) as kind, count(*) as row_count from {table})"
    for table, columns in COLUMNS.items()
    for ordinal, (column, _) in enumerate(columns, start=1)
)


@case("type_names", _TYPES_SQL)
def typed(d):
    """The names of every stored column's type, beside the rows they hold for."""
    tables = {t: d.table(t) for t in COLUMNS}
    return type_names(d.spark, tables).join(row_counts(tables), "table_name")


_ALL_TABLES = [
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
    "lineitem", "nation", "orders", "pages", "part", "region", "supplier",
]
case(
    "row_counts",
    "\nunion all ".join(
        f"select '{t}' as table_name, count(*) as row_count from {t}" for t in _ALL_TABLES
    ),
)(lambda d: row_counts({t: d.footers(t) for t in _ALL_TABLES}))

case(
    "null_counts",
    "\nunion all ".join(
        f"select '{table}' as table_name, '{column}' as column_name, count(*) as row_count,"
        f" count(*) - count({column}) as null_count from {table}"
        for table, columns in COLUMNS.items()
        for column, _ in columns
    ),
)(lambda d: null_counts({t: d.footers(t) for t in COLUMNS}))
