import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import topk
from riskloom.llm.queries import op2_histogram_topk
from riskloom.llm.topk import scores, top_k

SMALL = "/root/testdata/sf0.001"


def brute(data, k, asks):
    fine = []
    for i, v in data:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fine.append((i, [math.floor(1024 * x) for x in v]))
    out = []
    for q in sorted({i for i, _ in fine if asks(i)}):
        own = min(v for i, v in fine if i == q)
        found = []
        for i, v in fine:
            if i != q and len(v) == len(own):
                score = sum(a * b for a, b in zip(own, v, strict=True))
                found.append((-max(-(1 << 63), min((1 << 63) - 1, score)), i))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(found)[:k])]
    return out


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("query_id", "rank", "vec_id", "score").collect())


def test_query_matches_all_pairs(spark):
    data = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert rows_of(op2_histogram_topk(spark, SMALL)) == brute(data, 10, lambda i: i % 100 == 0)


def test_ties_nulls_lengths_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rng = np.random.default_rng(2)
    data = [(i, [1.0, 0.5, -0.25]) for i in range(0, 400, 2)]  # one very common vector
    data += [(i, rng.normal(size=3).astype(np.float32).tolist()) for i in range(1, 200, 2)]
    data += [(701, None), (703, [1.0, None, 2.0]), (705, [float("nan"), 1.0, 1.0]), (707, [float("inf"), 0.0, 0.0])]
    data += [(None, [9.0, 9.0, 9.0]), (800, [1.0]), (801, [2.0]), (900, []), (902, [])]
    data += [(5, data[205][1]), (5, data[205][1])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in data], "vec_id long, embedding array<float>, rank int, score int")
    got = rows_of(top_k(frame, F.col("vec_id") % 50 == 0, k=7))
    assert got == brute([(r.vec_id, r.embedding) for r in frame.collect()], 7, lambda i: i % 50 == 0)
    assert {q for q, *_ in got} >= {0, 50, 800, 900}


def test_large_and_negative_components(spark):
    data = [(i, [(-1.0) ** i * 3.0e18 / (i + 1), 1.5e9 * i]) for i in range(12)] + [(20, [1e300, 1e300])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert rows_of(top_k(frame, F.col("vec_id") < 30, k=3)) == brute(data, 3, lambda i: True)


def test_no_rows_and_one_row(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(empty, F.col("vec_id") == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert top_k(alone, F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("size", [3.0, 2.0**40])
def test_scores_are_exact(size):
    rng = np.random.default_rng(4)
    a, b = np.floor(rng.normal(size=(5, 6)) * size), np.floor(rng.normal(size=(4, 6)) * size)
    limit = (1 << 63) - 1
    expected = [[max(-limit - 1, min(limit, sum(int(x) * int(y) for x, y in zip(q, c, strict=True)))) for c in b] for q in a]
    assert scores(a, b).tolist() == expected


def test_no_pass_broadcasts_what_goes_to_every_block(spark, monkeypatch):
    """The driver would hold the queries once for each block of candidates."""
    monkeypatch.setattr(topk, "CANDIDATES", 8)
    plans = []

    def noted(self, state, *args, real=topk.Search.over_pairs):
        frame = real(self, state, *args)
        plans.append(frame._jdf.queryExecution().executedPlan().toString().splitlines())
        return frame

    monkeypatch.setattr(topk.Search, "over_pairs", noted)
    rng = np.random.default_rng(6)
    data = [(i, rng.normal(size=4).tolist()) for i in range(200)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(2)
    assert rows_of(top_k(frame, F.col("vec_id") % 20 == 0, k=5)) == brute(data, 5, lambda i: i % 20 == 0)
    assert len(plans) > 2
    for lines in plans:
        depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
        copies = [i for i, line in enumerate(lines) if "Generate explode(" in line and "explode(ids" not in line]
        assert copies
        for i in copies:
            above, at = [], depth[i]
            for j in range(i, -1, -1):
                if depth[j] < at:
                    above.append(lines[j])
                    at = depth[j]
            assert not any("Broadcast" in line for line in above)


@pytest.mark.parametrize("blocks, looked_at", [(2, 1), (5, 300), (1, 1 << 19)])
def test_larger_blocks_and_parts_of_them_give_the_same(spark, monkeypatch, blocks, looked_at):
    monkeypatch.setattr(topk, "CANDIDATES", 10)
    monkeypatch.setattr(topk, "QUERIES", 6)
    monkeypatch.setattr(topk, "BLOCKS", blocks)
    monkeypatch.setattr(topk, "SCORES", looked_at)
    rng = np.random.default_rng(blocks)
    data = [(int(i), rng.integers(-2, 3, 2).astype(float).tolist()) for i in rng.permutation(240) - 120]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    assert rows_of(top_k(frame, F.col("vec_id") % 10 == 0, k=6)) == brute(data, 6, lambda i: i % 10 == 0)
