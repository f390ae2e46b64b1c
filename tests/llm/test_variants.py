import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import variants
from riskloom.llm.variants import Words, filters, spelling_variants, with_keys

SCHEMA = "doc_id bigint, text string, word string, n int, key string"


def brute(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    less = {w: {w[:i] + w[i + 1 :] for i in range(len(w))} for w in words}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return a in less[b] if len(a) < len(b) else b in less[a]

    out, forms = {}, {}
    for w, n in words.items():
        around = [o for o in words if abs(len(o) - len(w)) <= 1 and near(w, o)]
        best = min(around, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best and words[best] >= 10 * n else None
        out[w] = (n, len(around), words[best] if forms[w] else None)
    rows = set()
    for w, (n, n_near, form_n) in out.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.add((w, forms[w], root, n, n_near, form_n))
    return rows


def check(spark, docs):
    frame = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in docs], SCHEMA).repartition(5)
    found = spelling_variants(frame).select("word", "form", "root", "n", "n_near", "form_n").collect()
    rows = {tuple(r) for r in found}
    assert len(rows) == len(found)
    assert rows == brute(docs)
    return rows


def misspelt(rng, word):
    at, kind = rng.randrange(len(word)), rng.randrange(3)
    letter = rng.choice("abcxyzéÿßÉ÷")
    return word[:at] + ["", letter, letter + word[at]][kind] + word[at + 1 :]


def texts(rng, words, many):
    docs = []
    for i in range(many):
        line = [misspelt(rng, w) if rng.random() < 0.05 else w for w in rng.choices(words, k=60)]
        docs.append((i, rng.choice([" ", ", ", "\n", "1"]).join(w.title() if rng.random() < 0.1 else w for w in line)))
    return docs


def test_matches_all_pairs(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdé", k=rng.randrange(6, 12))) for _ in range(30)]
    words += [misspelt(rng, w) for w in words for _ in range(4)] + words * 40
    rows = check(spark, texts(rng, words, 300))
    assert sum(r[1] is not None for r in rows) > 20


def test_chain_of_forms(spark):
    """Each form occurs ten times as often as the one before."""
    chain = ["abcdefgx", "abcdefxx", "abcdexxx", "abcdxxxx"]
    docs = [(1000 * i + k, w) for i, w in enumerate(chain) for k in range(2 * 12**i)]
    rows = {r[0]: r for r in check(spark, docs)}
    assert rows[chain[0]][2] == chain[3]


def test_segments_and_full_filters_change_nothing(spark, monkeypatch):
    rng = random.Random(2)
    words = ["".join(rng.choices("abc", k=rng.randrange(7, 11))) for _ in range(200)]
    docs = texts(rng, words, 100)
    monkeypatch.setattr(variants, "FILTER_BYTES", 300)
    check(spark, docs)
    monkeypatch.setattr(variants, "FILTER_BYTES", 1 << 20)
    monkeypatch.setattr(variants, "BITS", 1)
    check(spark, docs)


def test_nulls_repeats_ties_and_long_words(spark):
    long = "ab" * 20_000
    docs = [(1, None), (2, ""), (None, "letters letters"), (None, None), (3, "123 !?")] + [(4, "letters, LETTERS; lettérs")] * 5
    docs += [(5, f"{long} {long[:-1]}"), (6, f"{long} {long[:-1]}"), (7, "x" + long), (8, "lettersx lettersy " * 30)]
    rows = check(spark, docs)
    assert any(len(r[0]) == 40_000 and r[4] == 1 for r in rows)


def test_no_words(spark):
    assert check(spark, []) == set()
    assert check(spark, [(1, None), (2, "short words only")]) == set()


@pytest.mark.parametrize("size", [2, 7, 30])
def test_keys_of_edits(size):
    rng = np.random.default_rng(size)
    codes = np.frombuffer(b"abc\xe9", np.uint8)
    words = [bytes(w) for w in rng.choice(codes, (5, size))]
    block = Words(words)

    def keys_of(edited):
        return [tuple(int(k[0]) for k in Words([w]).keys) for w in edited]

    (who, key), *_ = block.deletions()
    found = sorted(zip(who.tolist(), *[key(i, slice(None)).tolist() for i in (0, 1)], strict=True))
    expected = [(n, *k) for n, w in enumerate(words) for k in keys_of({w[:i] + w[i + 1 :] for i in range(size)})]
    assert found == sorted(expected)
    found = [(w, *k) for who, key in block.replacements(codes) for w, *k in zip(who.tolist(), *[key(i, slice(None)).tolist() for i in (0, 1)], strict=True)]
    later = [(n, w[:i] + bytes([c]) + w[i + 1 :]) for n, w in enumerate(words) for i in range(size) for c in codes if c > w[i]]
    assert sorted(found) == sorted((n, *keys_of([w])[0]) for n, w in later)


def test_filters_lose_no_word(spark):
    words = [("word" + "abcdefghij"[i % 10] * (i % 60) + str(i), 2) for i in range(2000)]
    vocabulary = with_keys(spark.createDataFrame(words, "word string, n long"))
    (known,) = filters(vocabulary)
    rows = vocabulary.collect()
    for size in {r["size"] for r in rows}:
        keys = np.array([r.key for r in rows if r["size"] == size]).view(np.uint64)
        assert len(known.likely(keys, size)) == len(keys)
    stray = np.random.default_rng(0).integers(0, 1 << 63, 100_000, np.uint64)
    assert len(known.likely(stray, 50)) < 1000
