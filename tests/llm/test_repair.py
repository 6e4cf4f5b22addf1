"""Conversation repair against a suffix-by-suffix search over whole edit scripts."""

import random

import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martwright.llm import repair

DDL = "conv_id long, turn long, role string, text string"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def expected(rows):
    by = {}
    for conv, *row in rows:
        by.setdefault(conv, []).extend(brute.damage(conv, *row))
    return {conv: brute.repair(found) for conv, found in by.items()}


def got(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def test_conversations_with_every_kind_of_row(spark):
    rng = random.Random(5)
    texts = [None, "", " \t", "Yes.", "No!", "Cut off", "Same.", "Same.", "é…", "Ends with space. \n", "a" * 50_000 + "?"]
    rows = []
    for conv in range(220):
        for turn in range(rng.choice([0, 1, 2, 3, 5, 8, 40])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "admin"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), role, rng.choice(texts)))
    rows += [(None, t, r, "Sound.") for t, r in enumerate(["system", "user", "assistant", "assistant"])]
    rows += [(900, 3, "user", "Twice."), (900, 3, "user", "Twice."), (900, 9, "user", "Twice.")]
    df = spark.createDataFrame(rows, DDL)
    want = expected(rows)
    assert got(repair.repair(repair.damaged(df))) == want
    clash = ["kind", "plan", "audit", "gone", "copy", "digest", "blank", "again", "of_conv", "sequence", "harm"]
    extra = df.withColumns({c: F.lit("clash") for c in clash})
    assert got(repair.repair(repair.damaged(extra.repartition(5)))) == want


def test_dropped_conversations_and_empty_tables(spark):
    gone = next(c for c in range(1000) if not brute.damage(c, 0, "user", "Hello."))
    df = spark.createDataFrame([(gone, 0, "user", "Hello.")], DDL)
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert got(repair.repair(repair.damaged(df))) == {gone: (0, 0, 0, 0, 0, 0, "", empty)}
    assert repair.repair(repair.damaged(df.where("false"))).isEmpty()


def test_a_long_conversation_in_one_row_of_edits(spark):
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"Text {rng.randrange(3000)}{rng.choice('.?x')}") for t in range(900)]
    df = spark.createDataFrame(rows, DDL)
    import sys

    sys.setrecursionlimit(100_000)
    assert got(repair.repair(repair.damaged(df))) == expected(rows)


SYMBOL = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}


@settings(max_examples=300, deadline=None)
@given(st.text(repair.TERMINALS, max_size=14), st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=6))
def test_any_grammar_gives_the_same_edits(symbols, picks):
    alphabet, rules = list(repair.TERMINALS), []
    for a, b in picks:
        rules.append(alphabet[a % len(alphabet)] + alphabet[b % len(alphabet)])
        alphabet.append(chr(repair.FIRST_RULE + len(rules) - 1))
    rows = []
    for i, s in enumerate(symbols):
        role, text = SYMBOL.get(s.lower(), "user"), "" if s == "d" else f"{i}" if s.isupper() else f"{i}."
        rows.append((i, role, text))
    want = brute.repair(rows)
    assert repair.cheapest(symbols, tuple(rules), repair.matrices(tuple(rules))) == want[5:7]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("DIKR", max_size=3), max_size=8), st.lists(st.text("DIKR", max_size=3), max_size=8), st.randoms())
def test_ropes_compare_as_their_text(left, right, rng):
    def rope(parts):
        ropes = [repair.Rope(p) for p in parts] or [repair.Rope("")]
        while len(ropes) > 1:
            k = rng.randrange(len(ropes) - 1)
            ropes[k : k + 2] = [ropes[k] + ropes[k + 1]]
        return ropes[0]

    a, b = rope(left), rope(right)
    assert str(a) == "".join(left) and (a < b) == ("".join(left) < "".join(right))


def test_rules_come_from_all_sequences_and_halve_them(spark):
    shapes = spark.createDataFrame([("suauauaua", 50), ("uauauaua", 30), ("uUau", 1), ("", 9)], "sequence string, n long")
    rules = repair.grammar(shapes)
    assert rules[0] == "ua" and len(repair.compressed("ua" * 64, rules)) <= 32
    assert repair.grammar(shapes.where("n = 9")) == ()


@pytest.mark.parametrize("name", ["sf0.001"])
def test_registered_query(spark, name):
    from martwright.llm.queries import QUERIES

    folder = f"/root/testdata/{name}"
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert got(QUERIES["op12_conversation_repair"](spark, folder)) == expected([tuple(r) for r in rows])
