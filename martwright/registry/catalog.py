"""Catalog health over metadata derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from martwright.functions.scalar import WHITESPACE_CLASS
from martwright.operators import catalog
from martwright.registry.base import case
from martwright.registry.sqltext import half_up, part, sql
from martwright.sources.proxies import generated_catalog

_WORDS = f"coalesce(len(regexp_extract_all(description, '[^{WHITESPACE_CLASS}]+')), 0)"


def _length(column: str) -> str:
    trimmed = f"regexp_replace({column}, '^[{WHITESPACE_CLASS}]+|[{WHITESPACE_CLASS}]+$', '', 'g')"
    return f"coalesce(length({trimmed}), 0)"


part(
    "cat_models",
    """
    select 'model.region.' || r_regionkey as model_id, r_name as name, 'platform' as project,
           'staging' as layer, 'public' as access, cast(null as varchar) as description,
           false as enforced from region
    union all
    select 'model.nation.' || n_nationkey, n_name, 'platform', 'intermediate', 'protected',
           n_name, false from nation
    union all
    select 'model.customer.' || c_custkey, c_name, lower(c_mktsegment), 'marts',
           case when c_acctbal >= 0 then 'public' else 'protected' end, text,
           coalesce(c_acctbal >= 5000, false)
    from customer left join documents on doc_id = c_custkey""",
)
part(
    "cat_columns",
    """
    select 'model.customer.' || o_custkey as model_id, o_orderpriority as description,
           case o_orderstatus when 'F' then 'number' when 'O' then 'varchar' end as data_type
    from orders""",
)
part(
    "cat_tests",
    "select 'model.customer.' || o_custkey as model_id from orders where o_orderstatus = 'F'",
)
part(
    "cat_sources",
    """
    select 'source.supplier.' || s_suppkey as source_id, s_acctbal >= 0 as has_freshness
    from supplier
    union all
    select 'source.document.' || doc_id, lang = 'en' from documents""",
)
part(
    "cat_edges",
    """
    select 'model.region.' || n_regionkey as parent_id, 'model.nation.' || n_nationkey as child_id
    from nation
    union
    select 'model.nation.' || c_nationkey, 'model.customer.' || c_custkey from customer
    union
    select 'model.customer.' || o_custkey, 'model.order.' || o_orderkey from orders
    union
    select 'source.supplier.' || s_suppkey, 'model.nation.' || s_nationkey from supplier
    union
    select 'source.document.' || doc_id, 'model.customer.' || doc_id from labels""",
)
part(
    "cat_orphans",
    "select * from cat_sources where source_id not in (select parent_id from cat_edges)",
)
part(
    "cat_untested",
    "select * from cat_models where model_id not in (select model_id from cat_tests)",
)
part(
    "cat_wide",
    """
    select parent_id, count(*) as direct_children from cat_edges
    group by 1 having count(*) >= 3""",
)
part(
    "cat_thin",
    f"select * from (select *, {_WORDS} as word_count from cat_models) where word_count < 10",
)
part(
    "cat_facts",
    f"""
    select m.*, {_length('m.description')} as n_text,
           coalesce(c.n, 0) as cols, coalesce(c.described, 0) as described,
           coalesce(c.typed, 0) as typed, coalesce(t.n, 0) as tests,
           coalesce(s.n, 0) as srcs, coalesce(s.fresh, 0) as fresh,
           coalesce(p.n, 0) + coalesce(t.n, 0) as deps
    from cat_models m
    left join (select model_id, count(*) as n, count(data_type) as typed,
                      count(*) filter ({_length('description')} > 5) as described
               from cat_columns group by 1) c on c.model_id = m.model_id
    left join (select model_id, count(*) as n from cat_tests group by 1) t
      on t.model_id = m.model_id
    left join (select child_id, count(*) as n, count(*) filter (has_freshness) as fresh
               from cat_edges join cat_sources on source_id = parent_id group by 1) s
      on s.child_id = m.model_id
    left join (select parent_id, count(*) as n from cat_edges group by 1) p
      on p.parent_id = m.model_id""",
)
part(
    "cat_points",
    """
    select *,
           case when n_text > 20 then 10 else 0 end + case when cols > 0
             then cast(round_even(10 * described / cast(cols as double), 0) as bigint) else 0 end
             as documentation,
           cast(round_even(20 * least(tests / cast(greatest(cols, 1) as double), 1.0), 0)
             as bigint) as test_coverage,
           case when not coalesce(enforced, false) and layer in ('marts', 'mart') and access = 'public' then 0 else 10 end
             + case when cols > 0
               then cast(round_even(10 * typed / cast(cols as double), 0) as bigint) else 5 end
             as contracts,
           case when srcs = 0 then 20
             else cast(round_even(20 * fresh / cast(srcs as double), 0) as bigint) end as freshness,
           cast(greatest(20 - 2 * greatest(deps - 5, 0), 0) as bigint) as blast_radius
    from cat_facts""",
)
part(
    "cat_scores",
    """
    select model_id, name, project, layer, access, documentation, test_coverage, contracts,
           freshness, blast_radius, total as total_score,
           case when total >= 80 then 'A' when total >= 60 then 'B' when total >= 40 then 'C'
             else 'D' end as grade,
           concat_ws('; ',
             case when n_text <= 20 then 'missing or thin model description' end,
             case when cols = 0 then 'no columns defined in YAML'
               when documentation - case when n_text > 20 then 10 else 0 end < 10
               then (cols - described) || ' column(s) missing descriptions' end,
             case when tests = 0 then 'no data tests found'
               when tests / cast(greatest(cols, 1) as double) < 0.5
               then 'low test coverage: ' || tests || ' tests for ' || greatest(cols, 1)
                    || ' columns' end,
             case when not coalesce(enforced, false) and layer in ('marts', 'mart') and access = 'public'
               then 'public mart missing contract: enforced: true' end,
             case when cols > 0 and round_even(10 * typed / cast(cols as double), 0) < 10
               then (cols - typed) || ' column(s) missing data_type' end,
             case when freshness < 20 then 'only ' || fresh || '/' || srcs
               || ' upstream sources have freshness configured' end,
             case when deps > 5 then 'high blast radius: ' || deps
               || ' downstream models (threshold: 5)' end) as issues
    from (select *, documentation + test_coverage + contracts + freshness + blast_radius as total
          from cat_points)""",
)


def _tables(d):
    return generated_catalog(d.spark, d.folder)


def _scores(d):
    return catalog.scorecard(**_tables(d))


@case("catalog_orphans", sql("select * from cat_orphans"))
def orphans(d):
    t = _tables(d)
    return catalog.orphaned_sources(t["sources"], t["edges"])


@case("catalog_untested", sql("select model_id, name, project from cat_untested"))
def untested(d):
    t = _tables(d)
    return catalog.untested_models(t["models"], t["tests"]).select("model_id", "name", "project")


@case("catalog_thin_descriptions", sql("select model_id, name, word_count from cat_thin"))
def thin(d):
    rows = catalog.thin_descriptions(_tables(d)["models"])
    return rows.select("model_id", "name", "word_count")


_REACH_PAIRS = """
    pairs as (
      select parent_id as start_id, child_id as node_id from cat_edges
      union
      select start_id, child_id from pairs join cat_edges on parent_id = node_id)"""


@case(
    "catalog_reach",
    sql("select * from cat_wide").replace("with ", "with recursive ", 1).replace(
        "\nselect * from cat_wide",
        f""",{_REACH_PAIRS}
    select parent_id as model_id, any_value(direct_children) as direct_children,
           count(*) as transitive_count
    from cat_wide join pairs on start_id = parent_id group by 1""",
    ),
)
def reach(d):
    return catalog.blast_radius(_tables(d)["edges"])


@case(
    "catalog_wide_children",
    sql("""
        select parent_id as model_id, child_id from cat_edges
        where parent_id in (select parent_id from cat_wide) and not starts_with(parent_id, 'source.')"""),
)
def wide_children(d):
    return catalog.wide_children(_tables(d)["edges"])


@case("catalog_scorecard", sql("select * from cat_scores"))
def scores(d):
    return catalog.ranked(_scores(d)).withColumn("issues", F.concat_ws("; ", "issues"))


@case(
    "catalog_summary",
    sql(f"""
        select count(*) as total_models,
               {half_up("sum(total_score)", "count(*)", 1, 0, "decimal(5,1)")} as avg_score,
               count(*) filter (grade = 'A') as grade_a, count(*) filter (grade = 'B') as grade_b,
               count(*) filter (grade = 'C') as grade_c, count(*) filter (grade = 'D') as grade_d
        from cat_scores"""),
)
def score_summary(d):
    return catalog.summary(_scores(d))


@case(
    "catalog_health",
    sql("""
        select errors as error_count, orphans + wide + thin as warn_count,
               case when errors > 0 then 'AT RISK' when orphans + wide + thin > 0
                 then 'NEEDS ATTENTION' else 'HEALTHY' end as status
        from (select (select count(*) from cat_untested) as errors,
                     (select count(*) from cat_orphans) as orphans,
                     (select count(*) from cat_wide
                      where parent_id in (select model_id from cat_models)) as wide,
                     (select count(*) from cat_thin) as thin)"""),
)
def health(d):
    t = _tables(d)
    return catalog.health(t["models"], t["tests"], t["sources"], t["edges"])


@case(
    "catalog_coverage",
    sql(f"""
        select total_models, tested_models, total_tests,
               {half_up("tested_models * 100", "total_models", 1, 0, "decimal(4,1)")}
                 as tested_percent
        from (select count(*) as total_models, count(n) as tested_models,
                     cast(sum(n) as bigint) as total_tests
              from cat_models m left join (select model_id, count(*) as n from cat_tests group by 1)
                using (model_id))"""),
)
def test_coverage(d):
    t = _tables(d)
    return catalog.coverage(t["models"], t["tests"])
