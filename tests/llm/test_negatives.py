"""Hard-negative mining against plain integer products of all rows."""

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martwright.llm import negatives

DDL = "vec_id long, embedding array<double>, label int"


def test_small_blocks_hold_every_pair_once(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=12) * 0.4 + 0.2).tolist(), int(rng.integers(4))) for i in range(700)]
    rows += [(1000 + i, rows[3][1], i % 2) for i in range(40)]  # copies: ties by vec_id
    rows += [(50, rows[5][1], 1), (50, rows[5][1], 1)]  # repeated rows
    odd = [None, [], [1.0, None], [float("nan")] * 12, [float("inf")] + [0.0] * 11, [1e300] * 12, [0.0] * 12, [0.5] * 30]
    rows += [(2000 + 50 * i, v, 1) for i, v in enumerate(odd)] + [(2999, [0.5] * 30, 1), (2998, [0.4] * 30, 2)]
    rows += [(3000, rows[0][1], None), (None, rows[0][1], 1), (3050, [1e5 + i for i in range(12)], 1), (3051, [8e4] * 12, 2), (3052, [2e5] * 12, 1)]
    df = spark.createDataFrame(rows, DDL)
    want = brute.hard_negatives([r for r in rows if not r[1] or r[1][0] != 1e300])
    assert brute.multiset(negatives.hard_negatives(df, candidates=90, anchors=7).collect()) == want
    clash = ["row", "dim", "packed", "whole", "score", "anchor", "a_block", "c_block", "targets", "rank"]
    extra = df.withColumns({c: F.lit("clash") for c in clash}).repartition(3)
    assert brute.multiset(negatives.hard_negatives(extra).collect()) == want
    assert negatives.hard_negatives(df.where("false")).isEmpty()
    assert negatives.hard_negatives(df.where("vec_id % 50 <> 0")).isEmpty()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 21), st.integers(1, 9), st.integers(1, 5), st.integers(0, 26), st.randoms())
def test_lookups_give_exact_products(dim, candidates, anchors, bits, rng):
    draw = lambda n: np.array([[rng.randint(-(1 << bits), 1 << bits) for _ in range(dim)] for _ in range(n)], np.int64)
    whole, mine = draw(candidates).reshape(candidates, dim), draw(anchors).reshape(anchors, dim)
    planes, packed = negatives.pack(whole)
    wide = np.zeros((anchors, -(-dim // 8) * 8), np.int64)
    wide[:, :dim] = mine
    got = negatives.scores(np.ascontiguousarray(packed.transpose(1, 2, 0)), wide)
    assert (got == whole @ mine.T).all()
    assert all((-(1 << p - 1) <= w).all() and (w < 1 << p - 1).all() for p, w in zip(planes.tolist(), whole))


@pytest.mark.parametrize("name", ["sf0.001"])
def test_registered_query_and_its_sql(spark, name):
    import duckdb

    from martwright.llm.queries import QUERIES, SQL

    folder = f"/root/testdata/{name}"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    found = brute.multiset(QUERIES["op13_hard_negatives"](spark, folder).collect())
    assert found == brute.hard_negatives([tuple(r) for r in rows])
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet'")
    assert brute.multiset(db.execute(SQL["op13_hard_negatives"]).fetchall()) == found
