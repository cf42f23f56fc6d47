"""Residue-number products and hard negatives against exact integers."""

import math
import random

import numpy as np
import pytest
from frames import duck, spark_rows
from pyspark.sql import functions as F

from txnguard.llm import hard_negatives, residues
from txnguard.llm.hard_negatives import mine_negatives, negatives_sql, relabelled

VECTORS = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("columns, size", [(64, 256), (3, 10), (1, 4000), (768, 300), (2500, 1000), (16, 1 << 40), (5, 1 << 130), (7, 0)])
def test_products_are_exact(columns, size):
    rng = np.random.default_rng(columns)
    left, right = (np.floor(rng.uniform(-1, 1, (rows, columns)) * size) for rows in (9, 14))
    left[0], right[0], right[1] = size, size, -size
    primes = residues.choose_primes(columns, residues.score_bound(left, right))
    found = residues.scores(residues.residues(left, primes), residues.residues(right, primes), primes)
    whole = [[[int(x) for x in row] for row in side] for side in (left, right)]
    assert [[int(x) for x in row] for row in found] == [[sum(x * y for x, y in zip(a, b)) for b in whole[1]] for a in whole[0]]


def brute_force(rows, anchor, positives=5, negatives=3):
    kept = []
    for vec, values, label in rows:
        if vec is None or label is None or values is None or any(x is None or not math.isfinite(x) for x in values):
            continue
        kept.append((vec, [math.floor(256 * x) for x in values], label))
    out = []
    for k, (vec, own, label) in enumerate(kept):
        if not anchor(vec):
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(own, other)), i, other_label)
            for j, (i, other, other_label) in enumerate(kept)
            if j != k
        )
        for score, positive, _ in [s for s in scored if s[2] == label][:positives]:
            hits = [(i, -s) for s, i, g in scored if g != label and 50 * -score <= 100 * -s <= 95 * -score]
            out += [(vec, positive, rank, i, -score, s) for rank, (i, s) in enumerate(hits[:negatives], 1)]
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(count, width, labels, rng):
    return [(i, [rng.gauss(0.3, 0.4) for _ in range(width)], rng.randrange(labels)) for i in range(count)]


def test_equals_brute_force_over_many_blocks(spark, monkeypatch):
    rng = random.Random(1)
    rows = vectors(400, 12, 3, rng)
    rows += [(400 + k, rows[k % 3][1], k % 2) for k in range(90)]  # ties between many copies
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 400)
    monkeypatch.setattr(hard_negatives, "FIRST_TILE", 4)
    monkeypatch.setattr(hard_negatives, "ANCHOR_TILE", 3)
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = mine_negatives(frame, F.col("vec_id") % 10 == 0)
    assert found(got) == brute_force(rows, lambda i: i % 10 == 0)
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]


def test_awkward_rows(spark):
    rng = random.Random(3)
    rows = vectors(60, 4, 2, rng)
    rows += [rows[0], rows[0], rows[10]]  # repeated rows, an anchor among them
    rows += [(None, [1.0] * 4, 1), (70, None, 1), (71, [1.0] * 4, None), (72, [1.0, None, 1.0, 1.0], 0), (73, [], 1), (80, [0.5], 1)]
    rows += [(74, [float("nan")] * 4, 0), (75, [1.0, float("inf"), 0.0, 0.0], 1), (76, [-0.0, 0.0, 0.0, 0.0], 0), (90, [0.1], 7)]
    frame = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("clash") for c in ("row", "n", "data", "anchor", "cell", "rank")})
    assert found(mine_negatives(frame, F.col("vec_id") % 10 == 0)) == brute_force(rows, lambda i: i % 10 == 0)
    assert mine_negatives(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert mine_negatives(frame, F.lit(None).cast("boolean")).count() == 0


def test_large_components(spark):
    rng = random.Random(5)
    for scale in (1e3, 3e6):
        rows = [(i, [x * scale for x in v], g) for i, v, g in vectors(80, 3, 2, rng)]
        frame = spark.createDataFrame(rows, VECTORS)
        assert found(mine_negatives(frame, F.col("vec_id") % 9 == 0)) == brute_force(rows, lambda i: i % 9 == 0)
    # Scores beyond 64 bits take no part, the others do.
    rows = [(0, [1e-3, 1e17], 0), (1, [4.0, 0.0], 0), (2, [3.0, 0.0], 1), (3, [1e18, 1e18], 0), (4, [1e80, 0.0], 1), (5, [1e308, 0.0], 0)]
    rows += [(6, [5e3, 0.0], 0), (7, [4e3, 0.0], 1)]
    got = found(mine_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 6))
    assert got == [(6, 1, 1, 2, 1310720000, 983040000)]


def test_sql_agrees(spark):
    rng = random.Random(9)
    rows = vectors(260, 8, 10, rng) + [(300, None, 1), (350, [0.1] * 8, None), (400, [float("nan")] * 8, 2)]
    rows += [(500 + k, rows[50][1], 4) for k in range(20)] + [rows[100]]
    frame = spark.createDataFrame(rows, VECTORS)
    got = mine_negatives(relabelled(frame), F.col("vec_id") % 50 == 0)
    assert spark_rows(got) == duck(negatives_sql(), embeddings=frame)
    assert got.count() > 20
