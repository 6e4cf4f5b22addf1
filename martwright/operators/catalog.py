"""Catalog health over metadata tables: lineage risks, and a scorecard of five dimensions.

Inputs, all DataFrames:

* models  (model_id, name, project, layer, access, description, enforced)
* columns (model_id, name, description, data_type)
* tests   (test_id, model_id), a row for each model a test refers to
* sources (source_id, has_freshness)
* edges   (parent_id, child_id, child_type); ids of sources start with ``source.``
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions import has_words, round_ratio, text_length, word_count
from martwright.operators.distinct import number_rows
from martwright.session import shared_folder

# Thresholds, points and report texts of the scorecard and the lineage report.
FANOUT_THRESHOLD = 3  # direct model children from which a model's reach is reported
MIN_WORDS = 10  # fewer words make a description thin
MIN_MODEL_TEXT = 20  # a longer model description scores
MIN_COLUMN_TEXT = 5  # a longer column description counts
FREE_DEPENDENTS = 5  # dependents that cost nothing
POINTS_PER_DEPENDENT = 2
GRADES = [(80, "A"), (60, "B"), (40, "C")]
LOWEST_GRADE = "D"
NO_DESCRIPTION = "missing or thin model description"
NO_COLUMNS = "no columns defined in YAML"
NO_TESTS = "no data tests found"
NO_CONTRACT = "public mart missing contract: enforced: true"
UNDESCRIBED = "%d column(s) missing descriptions"
UNTYPED = "%d column(s) missing data_type"
FEW_TESTS = "low test coverage: %d tests for %d columns"
FEW_FRESH = "only %d/%d upstream sources have freshness configured"
MANY_DEPENDENTS = "high blast radius: %d downstream models (threshold: 5)"

SOURCE_PREFIX = "source."
MART_LAYERS = ("marts", "mart")
DIMENSIONS = ["documentation", "test_coverage", "contracts", "freshness", "blast_radius"]


# -- lineage risks --


def orphaned_sources(sources: DataFrame, edges: DataFrame) -> DataFrame:
    """Sources no model reads. Parents are made distinct before the join, so a source read by very
    many models is one row there."""
    used = edges.filter("child_type = 'model'").select(F.col("parent_id").alias("source_id"))
    return sources.join(used.distinct(), "source_id", "left_anti")


def untested_models(models: DataFrame, tests: DataFrame) -> DataFrame:
    return models.join(tests.select("model_id").distinct(), "model_id", "left_anti")


def thin_descriptions(models: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Models whose description has fewer words than asked for, with the count."""
    thin = models.filter(~has_words("description", min_words))
    return thin.withColumn("word_count", word_count("description"))


def _model_links(edges: DataFrame) -> DataFrame:
    return edges.filter("child_type = 'model'").select("parent_id", "child_id").distinct()


def _wide(links: DataFrame, threshold: int) -> DataFrame:
    """Models with many direct children; sources are none, however many read them."""
    models = links.filter(~F.col("parent_id").startswith(SOURCE_PREFIX))
    counts = models.groupBy("parent_id").agg(F.count(F.lit(1)).alias("direct_children"))
    return counts.filter(F.col("direct_children") >= threshold)


def fanout(edges: DataFrame, threshold: int = FANOUT_THRESHOLD) -> DataFrame:
    """Models with at least ``threshold`` direct model children."""
    return _wide(_model_links(edges), threshold)


WORD = 64  # starts whose reach one number holds, a bit each


def _bit(number: str) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col(number), F.lit(WORD)).cast("int"))


def reached(links: DataFrame, starts: DataFrame, folder: str) -> DataFrame:
    """(node_id, word, bits): for every node, which of the ``starts`` (parent_id, number) reach it.

    The starts that reach a node are a set of bits, 64 starts to a row, so a node below very many starts
    costs a row per 64 of them and no (start, node) pair is ever written. One join per level of the graph:
    the bits that are new to a node are carried on to its children, merged per child by OR, and cleared
    of what the child has already. That ends the loop on cycles and keeps diamonds from being walked
    twice. Every level is a table below ``folder``, so the plan does not grow with the depth and a lost
    executor costs no earlier level; the merged bits of a level are stored first, so the join with
    the links has plain shuffles on both sides, which adaptive execution can split at a hub.
    """
    spark = links.sparkSession
    schema = "node_id string, word long, bits long"
    merged = F.bit_or("bits").alias("bits")
    first = starts.select("parent_id", F.floor(F.col("number") / WORD).alias("word"), _bit("number").alias("bits"))
    step = links.join(first, "parent_id")
    level = 0
    while True:
        step = step.select(F.col("child_id").alias("node_id"), F.col("word").cast("long").alias("word"), "bits")
        step = step.groupBy("node_id", "word").agg(merged)
        if level:
            known = spark.read.schema(schema).parquet(*[f"{folder}/level={i}" for i in range(level)])
            known = known.groupBy("node_id", "word").agg(F.bit_or("bits").alias("had"))
            new = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("had", F.lit(0).cast("long"))))
            step = step.join(known, ["node_id", "word"], "left").select("node_id", "word", new.alias("bits"))
            step = step.where("bits <> 0")
        step.write.parquet(f"{folder}/level={level}")
        newest = spark.read.schema(schema).parquet(f"{folder}/level={level}")
        if newest.isEmpty():
            return spark.read.schema(schema).parquet(*[f"{folder}/level={i}" for i in range(level + 1)])
        step = newest.join(links, F.col("node_id") == F.col("parent_id")).drop("node_id")
        level += 1


def reach_counts(found: DataFrame) -> DataFrame:
    """(number, transitive_count): nodes per start, from rows that hold each of a node's bits once.

    A sum per bit within a word, all in one aggregate, so no row is made per start and node.
    """
    ones = [F.sum(F.shiftright("bits", k).bitwiseAND(F.lit(1))) for k in range(WORD)]
    words = found.groupBy("word").agg(F.array(*ones).alias("ones"))
    each = words.select("word", F.posexplode("ones").alias("bit", "transitive_count"))
    number = F.col("word") * WORD + F.col("bit")
    return each.where("transitive_count <> 0").select(number.alias("number"), "transitive_count")


def blast_radius(edges: DataFrame, threshold: int = FANOUT_THRESHOLD) -> DataFrame:
    """Direct and transitive dependents of the models with many direct ones, widest first.

    The distinct links are stored once and read by every level.
    """
    spark = edges.sparkSession
    folder = f"{shared_folder(spark)}/reach-{uuid.uuid4().hex}"
    _model_links(edges).write.parquet(f"{folder}/links")
    links = spark.read.parquet(f"{folder}/links")
    starts = number_rows(_wide(links, threshold), "parent_id")
    counts = reach_counts(reached(links, starts, f"{folder}/reached"))
    return (
        starts.join(counts, "number")
        .select(F.col("parent_id").alias("model_id"), "direct_children", "transitive_count")
        .orderBy(F.desc("transitive_count"), "model_id")
    )


def wide_children(edges: DataFrame, threshold: int = FANOUT_THRESHOLD) -> DataFrame:
    """(model_id, child_id): the direct children of the models with many of them, a row each."""
    links = _model_links(edges)
    wide = _wide(links, threshold).select("parent_id")
    return links.join(wide, "parent_id", "left_semi").select(F.col("parent_id").alias("model_id"), "child_id")


def coverage(models: DataFrame, tests: DataFrame) -> DataFrame:
    """One row: models, tested models, their share in percent, and tests on them."""
    per_model = tests.groupBy("model_id").agg(F.count(F.lit(1)).alias("tests"))
    counts = models.join(per_model, "model_id", "left").agg(
        F.count(F.lit(1)).alias("total_models"),
        F.count("tests").alias("tested_models"),
        F.coalesce(F.sum("tests"), F.lit(0)).alias("total_tests"),
    )
    share = round_ratio(F.col("tested_models") * 100, "total_models", 1).cast("decimal(4,1)")
    return counts.withColumn("tested_percent", F.coalesce(share, F.lit(0).cast("decimal(4,1)")))


def health(
    models: DataFrame,
    tests: DataFrame,
    sources: DataFrame,
    edges: DataFrame,
    threshold: int = FANOUT_THRESHOLD,
) -> DataFrame:
    """One row: error and warning counts and the overall status."""
    risks = {
        "untested": untested_models(models, tests),
        "orphaned": orphaned_sources(sources, edges),
        "wide": fanout(edges, threshold).join(
            models.select(F.col("model_id").alias("parent_id")), "parent_id", "left_semi"
        ),
        "thin": thin_descriptions(models),
    }
    counts = None
    for risk, rows in risks.items():
        n = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(risk).alias("risk"), "n")
        counts = n if counts is None else counts.unionByName(n)
    is_error = F.col("risk") == "untested"
    totals = counts.agg(
        F.sum(F.when(is_error, F.col("n")).otherwise(0)).alias("error_count"),
        F.sum(F.when(~is_error, F.col("n")).otherwise(0)).alias("warn_count"),
    )
    return totals.withColumn(
        "status",
        F.when(F.col("error_count") > 0, "AT RISK")
        .when(F.col("warn_count") > 0, "NEEDS ATTENTION")
        .otherwise("HEALTHY"),
    )


# -- scorecard --


def _share(points: int, part: Column, whole: Column) -> Column:
    """Points for a share, rounded half to even."""
    return F.bround(F.lit(points) * part / whole.cast("double")).cast("long")


def _facts(
    models: DataFrame,
    columns: DataFrame,
    tests: DataFrame,
    sources: DataFrame,
    edges: DataFrame,
) -> DataFrame:
    """Per model: the counts the five scores rest on. Each input is reduced to one row per model
    before it is joined."""
    # edges to tests are left out, as the tests are counted from their own table
    others = edges.filter(~F.col("child_type").eqNullSafe("test"))
    links = others.select("parent_id", "child_id").distinct()
    per_columns = columns.groupBy("model_id").agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.count_if(text_length("description") > MIN_COLUMN_TEXT).alias("n_described"),
        F.count_if(F.length("data_type") > 0).alias("n_typed"),
    )
    per_tests = tests.groupBy("model_id").agg(F.count(F.lit(1)).alias("n_tests"))
    read = links.filter(F.col("parent_id").startswith(SOURCE_PREFIX))
    per_sources = (
        read.join(sources, F.col("parent_id") == F.col("source_id"), "left")
        .groupBy(F.col("child_id").alias("model_id"))
        .agg(
            F.count(F.lit(1)).alias("n_sources"),
            F.count_if(F.col("has_freshness")).alias("n_fresh"),
        )
    )
    per_parent = links.groupBy(F.col("parent_id").alias("model_id")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    joined = models
    for counts in (per_columns, per_tests, per_sources, per_parent):
        joined = joined.join(counts, "model_id", "left")
    names = ["n_columns", "n_described", "n_typed", "n_tests", "n_sources", "n_fresh", "n_children"]
    zeroes = {n: F.coalesce(F.col(n), F.lit(0)) for n in names}
    return joined.withColumns(zeroes).withColumn(
        "n_dependents", F.col("n_children") + F.col("n_tests")
    )


def scorecard(
    models: DataFrame,
    columns: DataFrame,
    tests: DataFrame,
    sources: DataFrame,
    edges: DataFrame,
) -> DataFrame:
    """Per model: five scores of up to 20 points, their total, a grade and the issues found."""
    n = {c: F.col(f"n_{c}") for c in
         ("columns", "described", "typed", "tests", "sources", "fresh", "dependents")}
    has_columns = n["columns"] > 0
    whole = F.greatest(n["columns"], F.lit(1))
    described_model = text_length("description") > MIN_MODEL_TEXT
    column_text = F.when(has_columns, _share(10, n["described"], whole)).otherwise(0)
    typed = _share(10, n["typed"], whole)
    test_ratio = F.least(n["tests"] / whole.cast("double"), F.lit(1.0))
    needs_contract = (
        ~F.coalesce("enforced", F.lit(False))
        & F.col("layer").isin(*MART_LAYERS)
        & (F.col("access") == "public")
    )
    no_sources = n["sources"] == 0
    fresh = F.when(no_sources, 20).otherwise(
        _share(20, n["fresh"], F.greatest(n["sources"], F.lit(1)))
    )
    excess = F.greatest(n["dependents"] - FREE_DEPENDENTS, F.lit(0))

    scores = {
        "documentation": F.when(described_model, 10).otherwise(0) + column_text,
        "test_coverage": F.bround(F.lit(20) * test_ratio),
        "contracts": F.when(needs_contract, 0).otherwise(10)
        + F.when(has_columns, typed).otherwise(5),
        "freshness": fresh,
        "blast_radius": F.greatest(F.lit(20) - POINTS_PER_DEPENDENT * excess, F.lit(0)),
    }
    issues = [
        F.when(~described_model, NO_DESCRIPTION),
        F.when(
            has_columns & (column_text < 10),
            F.format_string(UNDESCRIBED, n["columns"] - n["described"]),
        ),
        F.when(~has_columns, NO_COLUMNS),
        F.when(n["tests"] == 0, NO_TESTS).when(
            test_ratio < 0.5, F.format_string(FEW_TESTS, n["tests"], whole)
        ),
        F.when(needs_contract, NO_CONTRACT),
        F.when(
            has_columns & (typed < 10), F.format_string(UNTYPED, n["columns"] - n["typed"])
        ),
        F.when(fresh < 20, F.format_string(FEW_FRESH, n["fresh"], n["sources"])),
        F.when(excess > 0, F.format_string(MANY_DEPENDENTS, n["dependents"])),
    ]
    total = sum((F.col(d) for d in DIMENSIONS[1:]), F.col(DIMENSIONS[0]))
    grade = F.when(F.col("total_score") >= GRADES[0][0], GRADES[0][1])
    for bound, letter in GRADES[1:]:
        grade = grade.when(F.col("total_score") >= bound, letter)
    return (
        _facts(models, columns, tests, sources, edges)
        .select(
            "model_id",
            "name",
            "project",
            "layer",
            "access",
            *[scores[d].cast("long").alias(d) for d in DIMENSIONS],
            F.array_compact(F.array(*issues)).alias("issues"),
        )
        .withColumn("total_score", total)
        .withColumn("grade", grade.otherwise(LOWEST_GRADE))
    )


def ranked(scores: DataFrame) -> DataFrame:
    """Report order: best score first."""
    return scores.orderBy(F.desc("total_score"), "name")


def summary(scores: DataFrame) -> DataFrame:
    """One row: number of models, mean score to one decimal, models per grade."""
    letters = [letter for _, letter in GRADES] + [LOWEST_GRADE]
    return scores.agg(
        F.count(F.lit(1)).alias("total_models"),
        round_ratio(F.sum("total_score"), F.count("total_score"), 1)
        .cast("decimal(5,1)")
        .alias("avg_score"),
        *[F.count_if(F.col("grade") == g).alias(f"grade_{g.lower()}") for g in letters],
    )
