from decimal import Decimal

import pytest
from helpers import as_dicts

from martwright.operators import catalog as cat

EDGES = "parent_id string, child_id string, child_type string"
MODELS = (
    "model_id string, name string, project string, layer string, access string,"
    " description string, enforced boolean"
)
COLUMNS = "model_id string, name string, description string, data_type string"
TESTS = "test_id string, model_id string"
SOURCES = "source_id string, has_freshness boolean"

# A mesh of 24 models with known scores. Per model: project, layer, access, enforced,
# columns (all described), typed columns, tests, sources read, children other than tests, and the
# expected documentation, test, contract, freshness and blast radius scores and grade.
MESH = [
    ("stg_tpch__customer", "platform", "staging", "public", False, 8, 8, 10, 1, 0, 20, 20, 20, 20, 10, "A"),
    ("stg_tpch__lineitem", "platform", "staging", "public", False, 16, 16, 23, 1, 0, 20, 20, 20, 20, 0, "A"),
    ("stg_tpch__nation", "platform", "staging", "public", False, 4, 4, 4, 1, 0, 20, 20, 20, 20, 20, "A"),
    ("stg_tpch__orders", "platform", "staging", "public", False, 9, 9, 11, 1, 0, 20, 20, 20, 20, 8, "A"),
    ("stg_tpch__part", "platform", "staging", "public", False, 9, 9, 12, 1, 0, 20, 20, 20, 20, 6, "A"),
    ("stg_tpch__partsupp", "platform", "staging", "public", False, 5, 5, 6, 1, 0, 20, 20, 20, 20, 18, "A"),
    ("stg_tpch__region", "platform", "staging", "public", False, 3, 3, 5, 1, 0, 20, 20, 20, 20, 20, "A"),
    ("stg_tpch__supplier", "platform", "staging", "public", False, 7, 7, 9, 1, 0, 20, 20, 20, 20, 12, "A"),
    ("stg_commercial__orders", "commercial", "staging", "protected", False, 8, 8, 11, 1, 2, 20, 20, 20, 20, 4, "A"),
    ("stg_commercial__customers", "commercial", "staging", "protected", False, 9, 9, 8, 1, 1, 20, 18, 20, 20, 12, "A"),
    ("stg_commercial__lineitems", "commercial", "staging", "protected", False, 10, 10, 12, 1, 1, 20, 20, 20, 20, 4, "A"),
    ("int_order_items", "commercial", "intermediate", "protected", False, 0, 0, 0, 0, 3, 0, 0, 15, 20, 20, "C"),
    ("int_customer_orders", "commercial", "intermediate", "protected", False, 0, 0, 0, 0, 1, 0, 0, 15, 20, 20, "C"),
    ("fct_orders", "commercial", "marts", "public", True, 17, 17, 7, 0, 1, 20, 8, 20, 20, 14, "A"),
    ("fct_orders_v2", "commercial", "marts", "public", True, 0, 0, 0, 0, 0, 0, 0, 15, 20, 20, "C"),
    ("dim_customers", "commercial", "marts", "public", True, 15, 15, 9, 0, 1, 20, 12, 20, 20, 10, "A"),
    ("stg_finance__orders", "finance", "staging", "protected", False, 6, 6, 4, 1, 1, 20, 13, 20, 20, 20, "A"),
    ("fct_revenue", "finance", "marts", "public", True, 11, 11, 2, 0, 0, 20, 4, 20, 20, 20, "A"),
    ("stg_marketing__customers", "marketing", "staging", "protected", False, 0, 0, 0, 1, 1, 0, 0, 15, 20, 20, "C"),
    ("fct_attribution", "marketing", "marts", "public", True, 14, 14, 3, 0, 0, 20, 4, 20, 20, 20, "A"),
    ("stg_product__usage", "product", "staging", "protected", False, 0, 0, 0, 1, 1, 0, 0, 15, 20, 20, "C"),
    ("fct_usage", "product", "marts", "public", True, 9, 9, 2, 0, 0, 20, 4, 20, 20, 20, "A"),
    ("fct_orders_enriched", "analytics", "marts", "public", False, 19, 19, 6, 2, 0, 20, 6, 10, 20, 18, "B"),
    ("metricflow_time_spine", "analytics", "marts", "public", False, 1, 0, 2, 0, 0, 20, 20, 0, 20, 20, "A"),
]
# The issues reported for some of them.
ISSUES = {
    "stg_tpch__nation": [],
    "fct_revenue": ["low test coverage: 2 tests for 11 columns"],
    "dim_customers": ["high blast radius: 10 downstream models (threshold: 5)"],
    "metricflow_time_spine": [
        "public mart missing contract: enforced: true",
        "1 column(s) missing data_type",
    ],
    "fct_orders_enriched": [
        "low test coverage: 6 tests for 19 columns",
        "public mart missing contract: enforced: true",
        "high blast radius: 6 downstream models (threshold: 5)",
    ],
    "int_order_items": [
        "missing or thin model description",
        "no columns defined in YAML",
        "no data tests found",
    ],
}


def mesh_tables(frame):
    models, columns, tests, sources, edges = [], [], [], [], []
    for name, project, layer, access, enforced, n_columns, n_typed, n_tests, n_sources, n_kids, *_ in MESH:
        about = "A description that is long enough." if n_columns else None
        models.append((name, name, project, layer, access, about, enforced))
        columns += [
            (name, f"c{i}", "described", "number" if i < n_typed else None)
            for i in range(n_columns)
        ]
        tests += [(f"{name}.t{i}", name) for i in range(n_tests)]
        for i in range(n_sources):
            sources.append((f"source.{name}.{i}", True))
            edges.append((f"source.{name}.{i}", name, "model"))
        edges += [(name, f"{name}.kid{i}", "analysis") for i in range(n_kids)]
    return {
        "models": frame(models, MODELS),
        "columns": frame(columns, COLUMNS),
        "tests": frame(tests, TESTS),
        "sources": frame(sources, SOURCES),
        "edges": frame(edges, EDGES),
    }


def test_known_scores(frame):
    scores = cat.scorecard(**mesh_tables(frame))
    got = {r["name"]: r for r in as_dicts(scores)}
    assert len(got) == 24
    for row in MESH:
        name, points, grade = row[0], list(row[10:15]), row[15]
        assert [got[name][d] for d in cat.DIMENSIONS] == points, name
        assert (got[name]["total_score"], got[name]["grade"]) == (sum(points), grade), name
    for name, issues in ISSUES.items():
        assert got[name]["issues"] == issues
    total = as_dicts(cat.summary(scores))[0]
    assert total == {
        "total_models": 24, "avg_score": Decimal("80.4"),
        "grade_a": 18, "grade_b": 1, "grade_c": 5, "grade_d": 0,
    }
    order = [r["total_score"] for r in cat.ranked(scores).collect()]
    assert order == sorted(order, reverse=True)


def test_known_lineage_summary(frame):
    t = mesh_tables(frame)
    models = t["models"].filter("project = 'platform'")
    row = as_dicts(cat.coverage(models, t["tests"]))[0]
    assert (row["total_models"], row["tested_models"], row["total_tests"]) == (8, 8, 80)
    assert row["tested_percent"] == Decimal("100.0")


@pytest.fixture
def one(frame):
    """Scores of one model described by its parts."""

    def score(description="x" * 21, columns=(), tests=0, sources=(), children=0, layer="staging",
              access="protected", enforced=False):
        model = [("m", "m", "p", layer, access, description, enforced)]
        edges = [(s, "m", "model") for s, _ in sources] + [("m", f"k{i}", "model") for i in range(children)]
        result = cat.scorecard(
            frame(model, MODELS),
            frame([("m", f"c{i}", *c) for i, c in enumerate(columns)], COLUMNS),
            frame([(f"t{i}", "m") for i in range(tests)], TESTS),
            frame([s for s in sources if s[1] is not None], SOURCES),
            frame(edges, EDGES),
        )
        return as_dicts(result)[0]

    return score


def test_score_edges(one):
    half = [("long enough", "number"), ("short", None)]
    row = one(columns=half, description=" " * 30 + "x" * 20)
    assert row["documentation"] == 5 and row["contracts"] == 15 and row["test_coverage"] == 0
    assert "1 column(s) missing descriptions" in row["issues"]
    # 10 * 1 / 4 = 2.5 goes to the even 2
    quarter = [("long enough", "number")] + [(None, "")] * 3
    row = one(columns=quarter, tests=1)
    assert row["documentation"] == 12 and row["contracts"] == 12 and row["test_coverage"] == 5
    # a source that is not in the table has no freshness
    row = one(sources=[("source.a", True), ("source.b", None), ("source.c", False)])
    assert row["freshness"] == 7
    assert "only 1/3 upstream sources have freshness configured" in row["issues"]
    assert one(children=5)["blast_radius"] == 20
    assert one(children=6)["blast_radius"] == 18
    assert one(children=6, tests=20)["blast_radius"] == 0
    assert one(layer="marts", access="public")["contracts"] == 5
    assert one(layer="marts", access="public", enforced=True)["contracts"] == 15
    assert one(layer="mart", access="public", enforced=None)["contracts"] == 5
    assert one(enforced=None)["contracts"] == 15
    assert one(description=None, layer="marts", access="public", children=40)["grade"] == "D"


def test_edges_to_tests_and_wide_sources(frame):
    """Tests count once, from their own table; a source is no model, however many models read it."""
    model = frame([("m", "m", "p", "staging", "protected", None, None)], MODELS)
    edges = frame([("m", f"k{i}", "model") for i in range(3)] + [("m", f"t{i}", "test") for i in range(4)]
                  + [("source.s", f"k{i}", "model") for i in range(5)], EDGES)
    tests = frame([(f"t{i}", "m") for i in range(4)], TESTS)
    none = [frame([], COLUMNS), tests, frame([], SOURCES)]
    row = as_dicts(cat.scorecard(model, *none, edges))[0]
    assert row["blast_radius"] == 20 - cat.POINTS_PER_DEPENDENT * max(0, 7 - cat.FREE_DEPENDENTS)
    assert [r["parent_id"] for r in as_dicts(cat.fanout(edges, 3))] == ["m"]
    assert [r["model_id"] for r in as_dicts(cat.blast_radius(edges, 3))] == ["m"]


def brute_reach(edges, start):
    seen, queue = set(), [c for p, c, _ in edges if p == start]
    while queue:
        node = queue.pop()
        if node not in seen:
            seen.add(node)
            queue += [c for p, c, _ in edges if p == node]
    return len(seen)


def test_reach_on_diamonds_chains_and_cycles(frame):
    edges = [
        ("a", "b", "model"), ("a", "c", "model"), ("a", "d", "model"),  # fan
        ("b", "e", "model"), ("c", "e", "model"),  # diamond
        ("e", "f", "model"), ("f", "g", "model"), ("g", "h", "model"),  # chain
        ("h", "e", "model"),  # cycle behind the diamond
        ("z", "z1", "model"), ("z", "z2", "model"), ("z", "z3", "model"), ("z3", "z", "model"),
        ("a", "b", "model"),  # repeated edge
        ("e", "t", "test"), ("q", "x", "model"), ("q", "y", "model"),
    ]
    got = {r["model_id"]: (r["direct_children"], r["transitive_count"])
           for r in cat.blast_radius(frame(edges, EDGES)).collect()}
    links = [e for e in edges if e[2] == "model"]
    assert got == {"a": (3, brute_reach(links, "a")), "z": (3, brute_reach(links, "z"))}
    assert got["a"][1] == 7 and got["z"][1] == 4  # z reaches itself
    two = cat.blast_radius(frame(edges, EDGES), threshold=2)
    assert [r["transitive_count"] for r in two.collect()] == [7, 4, 2]


def test_reach_without_wide_models(frame):
    assert cat.blast_radius(frame([("a", "b", "model")], EDGES)).isEmpty()
    assert cat.blast_radius(frame([], EDGES)).isEmpty()


def test_risks(frame):
    models = frame(
        [("m1", "m1", "p", "staging", "public", "one two three", False),
         ("m2", "m2", "p", "staging", "public", "a b c d e f g h i j", False),
         ("m3", "m3", "p", "staging", "public", None, False)],
        MODELS,
    )
    tests = frame([("t", "m1"), ("t", "m2"), ("u", "m1")], TESTS)
    sources = frame([("source.a", True), ("source.b", True)], SOURCES)
    edges = frame([("source.a", "m1", "model"), ("source.b", "x", "test")], EDGES)
    assert [r["source_id"] for r in cat.orphaned_sources(sources, edges).collect()] == ["source.b"]
    assert [r["model_id"] for r in cat.untested_models(models, tests).collect()] == ["m3"]
    thin = as_dicts(cat.thin_descriptions(models), "model_id")
    assert [(r["model_id"], r["word_count"]) for r in thin] == [("m1", 3), ("m3", 0)]
    row = as_dicts(cat.health(models, tests, sources, edges))[0]
    assert row == {"error_count": 1, "warn_count": 3, "status": "AT RISK"}
    tested = models.filter("model_id <> 'm3'")
    assert as_dicts(cat.health(tested, tests, sources, edges))[0]["status"] == "NEEDS ATTENTION"
    fine, used = models.filter("model_id = 'm2'"), sources.filter("source_id = 'source.a'")
    assert as_dicts(cat.health(fine, tests, used, edges))[0]["status"] == "HEALTHY"
    row = as_dicts(cat.coverage(models, tests))[0]
    assert (row["tested_models"], row["total_tests"], row["tested_percent"]) == (
        2, 3, Decimal("66.7"),
    )
    assert as_dicts(cat.coverage(models.limit(0), tests))[0]["tested_percent"] == 0
