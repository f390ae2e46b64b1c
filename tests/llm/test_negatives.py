import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import negatives
from riskloom.llm.negatives import exact_scores, from_residues, hard_negatives, moduli, primes_below, residue_product
from riskloom.llm.queries import op11_residue_negatives

SMALL = "/root/testdata/sf0.001"
LIMIT = (1 << 63) - 1


def clamp(score):
    return max(-LIMIT - 1, min(LIMIT, score))


def brute(data, asks, positives=5, taken=10):
    """Rows of data: id, label, vector. Without repeated ids the order is settled by id."""
    top = np.finfo(np.float64).max / 256
    fine = []
    for i, label, v in data:
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v):
            fine.append((i, label, [math.floor(256 * max(-top, min(top, x))) for x in v]))
    out, asked = [], set()
    for at, (a, label, v) in enumerate(fine):
        if not asks(a) or (a, label, tuple(v)) in asked:
            continue
        asked.add((a, label, tuple(v)))
        others = [
            (-clamp(sum(x * y for x, y in zip(v, w, strict=True))), i, other)
            for n, (i, other, w) in enumerate(fine)
            if n != at and len(w) == len(v)
        ]
        others.sort()
        near = [o for o in others if o[2] == label][:positives]
        for score, i, _ in near:
            inside = [o for o in others if o[2] != label and 30 * -score <= 100 * -o[0] <= 90 * -score]
            out += [(a, i, n + 1, o[1], -score, -o[0]) for n, o in enumerate(inside[:taken])]
    return sorted(out)


def rows_of(frame):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[n] for n in names) for r in frame.collect())


def test_query_matches_all_pairs(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    data = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding) for r in rows if r.label is not None]
    found = rows_of(op11_residue_negatives(spark, SMALL))
    assert found == brute(data, lambda i: i % 100 == 0)
    assert found


def test_small_blocks_ties_nulls_lengths_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CANDIDATES", 16)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    rng = np.random.default_rng(8)
    data = [(i, i % 3, [1.0, 0.5, -0.25]) for i in range(60)]  # one very common vector
    data += [(i, i % 40, (rng.normal(size=3) + 0.7).astype(np.float32).tolist()) for i in range(60, 300)]
    data += [(400, None, [1.0, 1.0, 1.0]), (401, 1, None), (402, 1, [1.0, None, 1.0]), (403, 1, [float("nan"), 1.0, 1.0])]
    data += [(404, 1, [float("-inf"), 1.0, 1.0]), (None, 1, [1.0, 1.0, 1.0]), (500, 1, [2.0]), (501, 1, [2.0]), (502, 2, [1.0])]
    data += [(510, 1, []), (520, 1, []), (530, 2, [])]
    data += [data[70]] * 7 + [data[100]] * 30 + [data[150]]
    frame = spark.createDataFrame([(*r, 1, 2) for r in data], "vec_id long, label int, embedding array<float>, rank int, part int")
    got = rows_of(hard_negatives(frame.repartition(5), F.col("vec_id") % 10 == 0))
    exact = [(r.vec_id, r.label, r.embedding) for r in frame.collect()]
    assert got == brute(exact, lambda i: i % 10 == 0)
    assert {a for a, *_ in got} >= {0, 70, 100, 150, 500, 510}


def test_large_and_negative_components(spark):
    data = [(i, i % 2, [(-1.0) ** i * 3.0e15 / (i + 1), 1.5e9 * i]) for i in range(12)] + [(20, 0, [1e300, 1e308]), (21, 1, [1e308, 9.0])]
    frame = spark.createDataFrame(data, "vec_id long, label long, embedding array<double>")
    assert rows_of(hard_negatives(frame, F.col("vec_id") < 30)) == brute(data, lambda i: True)


def test_no_rows_one_row_and_no_anchor(spark):
    schema = "vec_id long, label int, embedding array<float>"
    for data in ([], [(0, 1, [1.0])], [(1, 1, [1.0]), (2, 2, [0.5])]):
        assert hard_negatives(spark.createDataFrame(data, schema), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("size", [1.0, 300.0, 2.0**24, 2.0**40, 1e160])
@pytest.mark.parametrize("width", [1, 7, 64, 2500])
def test_scores_are_exact(size, width):
    rng = np.random.default_rng(width)
    a, b = np.floor(rng.normal(size=(4, width)) * size), np.floor(rng.normal(size=(3, width)) * size)
    expected = [[clamp(sum(int(x) * int(y) for x, y in zip(q, c, strict=True))) for c in b] for q in a]
    assert exact_scores(a, b).tolist() == expected


def test_products_stay_exact_in_single_precision():
    """The extremes: every residue as large as it gets, throughout the deepest piece."""
    for width in (1, 64, 1024, 5000):
        primes, depth = moduli(10**9, width)
        assert math.prod(primes) > 2 * 10**9 and depth * (max(primes) // 2) ** 2 < 1 << 24
        p = primes[0]
        a = np.full((1, width), float(p // 2))
        assert residue_product(a, -a, p, depth)[0, 0] % p == -width * (p // 2) ** 2 % p


def test_digits_cover_the_whole_range():
    primes = primes_below(12)
    assert primes == [11, 7, 5, 3]
    n = np.arange(-(1155 // 2), 1155 // 2 + 1)
    assert from_residues([negatives.symmetric(n, p) for p in primes], primes).tolist() == n.tolist()
