import hashlib
import random
import re

import numpy as np
import pytest

from riskloom.llm import substrings
from riskloom.llm.queries import op7_block_anchors
from riskloom.llm.substrings import rolling, without_repeats

SMALL = "/root/testdata/sf0.001"


def brute(docs, size=50):
    """Kept words per row, from the set of windows of each document."""
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in docs]
    least = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - size + 1):
                key = tuple(w[i : i + size])
                least[key] = min(least.get(key, d), d)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        if d is not None:
            for i in range(len(w) - size + 1):
                if least[tuple(w[i : i + size])] < d:
                    gone[i : i + size] = [True] * size
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def same(frame, docs):
    key = lambda r: (r[0] is not None, r[0] or 0, r[3])
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in frame.collect()]
    assert sorted(got, key=key) == sorted(brute(docs), key=key)


@pytest.mark.parametrize("size", [1, 2, 3, 25, 50])
def test_rolling_is_the_sum_of_powers(size):
    values = np.random.default_rng(1).integers(0, 1 << 63, 120).astype(np.uint64)
    base = substrings.BASES[0]
    expected = [sum(int(values[i + j]) * pow(base, size - 1 - j) for j in range(size)) % (1 << 64) for i in range(121 - size)]
    assert rolling(values, size, base).tolist() == expected
    assert len(rolling(values[: size - 1], size, base)) == 0


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = {d: (n, r, hashlib.sha256(k.encode()).hexdigest()) for d, n, r, k in brute(docs)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in op7_block_anchors(spark, SMALL).collect()}
    assert got == expected
    assert sum(r for _, r, _ in got.values()) > 0


@pytest.mark.parametrize("seed", range(3))
def test_planted_passages_of_any_length_and_place(rows, monkeypatch, seed):
    monkeypatch.setattr(substrings, "CHUNK_CHARS", 5_000)
    rng = random.Random(seed)
    passages = [[f"p{n}w{i}" for i in range(length)] for n, length in enumerate((49, 50, 51, 73, 74, 75, 99, 150, 400))]
    docs = []
    for d in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [f"d{d}r{rng.random()}" for _ in range(rng.randint(0, 60))]
            p = rng.choice(passages)
            low = rng.randint(0, len(p) - 49)
            words += p[low : low + rng.randint(45, 300)]
        docs.append((d, rng.choice([" ", "\n", " \t"]).join(words)))
    same(without_repeats(rows(docs, "doc_id long, text string")), docs)


def test_nulls_repeats_hot_and_clashing_columns(rows):
    hot = " ".join(f"hot{i}" for i in range(130))
    repeated = "again and " * 60
    docs = [(i, hot) for i in range(40)] + [(100, None), (101, ""), (102, "short one"), (None, hot), (7, hot), (200, repeated), (201, repeated + hot), (300, "x " * 30_000)]
    frame = rows([(d, t, "x", d) for d, t in docs], "doc_id long, text string, kept string, _more long")
    got = without_repeats(frame)
    assert got.columns == ["doc_id", "text", "_more", "n_words", "n_removed", "kept"]
    same(got, docs)


def test_no_documents(rows):
    assert without_repeats(rows([], "doc_id long, text string")).count() == 0
