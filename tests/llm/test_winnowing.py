import hashlib

import numpy as np
import pytest

from riskloom.llm import winnowing
from riskloom.llm.queries import op9_winnowing
from riskloom.llm.winnowing import compared_with_next, edited, fingerprints, gram_hashes, likeness, winnow

SMALL = "/root/testdata/sf0.001"


def slow_winnow(text, gram, window):
    """Window by window, on the same gram hashes taken one by one."""
    gram = min(gram, len(text))
    hashes = [int(gram_hashes(np.array([ord(c) for c in text[i : i + gram]]), gram)[0]) for i in range(len(text) - gram + 1)]
    window, found = min(window, len(hashes)), []
    for start in range(len(hashes) - window + 1):
        best = min(range(start, start + window), key=lambda i: (hashes[i], -i))
        if not found or found[-1] != (hashes[best], best):
            found.append((hashes[best], best))
    return found


@pytest.mark.parametrize("text", ["", "a", "ab" * 60, "a" * 300, "über die Brücke, " * 9 + "x", "The quick brown fox " * 13])
@pytest.mark.parametrize("gram,window", [(1, 1), (4, 7), (5, 8), (16, 85)])
def test_winnow_is_the_window_by_window_rule(text, gram, window):
    hashes, places = winnow(text, gram, window)
    expected = slow_winnow(text, gram, window) if text else []
    assert list(zip(hashes.tolist(), places.tolist(), strict=True)) == expected


def test_shared_run_shares_a_hash():
    run = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(winnowing.GRAM + winnowing.WINDOW - 1))
    one, _ = winnow("0123456789" * 30 + run + "!?" * 80)
    other, _ = winnow("zyxw" * 50 + run)
    assert set(one.tolist()) & set(other.tolist())


def test_next_wraps_and_ties_nulls_and_repeats(spark, rows):
    data = [(5, None), (1, "abcdefgh" * 30), (None, "first of all"), (1, "abcdefgh" * 30), (9, ""), (7, "x" * 50_000)]
    got = compared_with_next(rows(data, "doc_id long, text string")).collect()
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [t or "" for _, t in order]
    expected = []
    for i, (k, _) in enumerate(order):
        t, n = texts[i], texts[(i + 1) % len(texts)]
        half = len(t) // 2
        e = t[: len(t) - half] + n[:half]
        expected.append(
            (k, len(t), hashlib.sha256(e.encode()).hexdigest(), likeness(winnow(t)[0], winnow(e)[0]), likeness(winnow(t)[0], winnow(n)[0]))
        )
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted([(r[0], r[1], r[2], r[5], r[6]) for r in got], key=key) == sorted(expected, key=key)


def test_one_row_and_none(rows):
    one = compared_with_next(rows([(3, "abcd" * 40)], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert compared_with_next(rows([], "doc_id long, text string")).count() == 0


def test_fingerprints_keep_other_columns(rows):
    frame = rows([(1, "abc" * 50, "x", 3), (2, None, None, None)], "doc_id long, text string, hashes string, n_chars int")
    got = fingerprints(frame).orderBy("doc_id").collect()
    assert got[0].n_chars == 3 and got[0].hashes and got[1].hashes == [] == got[1].positions


def test_query_matches_brute_force(spark):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in op9_winnowing(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for i, (k, t) in enumerate(docs):
        n = docs[(i + 1) % len(docs)][1] or ""
        t = t or ""
        half = len(t) // 2
        e = t[: len(t) - half] + n[:half]
        assert got[k].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert got[k].fingerprint == "".join(f"{h:08x}" for h in winnow(t)[0])
        assert got[k].near_next == likeness(winnow(t)[0], winnow(n)[0])


@pytest.mark.parametrize("size", [46, 60, 75, 100, 150, 300])
def test_half_edited_texts_are_nearer_than_the_next(spark, size):
    texts = [r.text[-size:] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect() if r.text and len(r.text) >= size]
    texts = sorted(set(texts))
    for text, other in zip(texts, texts[1:], strict=False):
        own = winnow(text)[0]
        assert likeness(own, winnow(edited(text, other))[0]) > 0
