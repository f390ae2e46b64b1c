import numpy as np
import pytest
import xxhash

from riskloom.llm import simhash as module
from riskloom.llm.components import components
from riskloom.llm.queries import op10_simhash_pivots
from riskloom.llm.simhash import bucket_keys, linked_pairs, links, near_duplicates, one_of_each, simhash, spanning_edges

SMALL = "/root/testdata/sf0.001"


def plain(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def least_reachable(prints):
    """Component of each fingerprint's index by comparing all pairs."""
    values = np.array(prints, np.uint64)
    near = np.bitwise_count(values[:, None] ^ values) <= 2
    label = np.arange(len(values))
    while True:
        least = np.array([label[near[i]].min() for i in range(len(values))])
        if (least == label).all():
            return label
        label = least


@pytest.mark.parametrize("text", ["", " \t\n", "One", "one TWO", "a b c", "A b\x0bc  D É ÉÉ", "x y " * 900, "a b c"])
def test_fingerprint_rule(text):
    assert simhash(text) == plain(text)


def test_linked_prints_always_share_a_bucket():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2)
    one, two = rng.integers(0, 64, (2, 3000)).astype(np.uint64)
    other = base ^ (np.uint64(1) << one) ^ (np.uint64(1) << two)
    assert (bucket_keys(base) == bucket_keys(other)).any(axis=1).all()


def test_pairs_and_spanning_edges():
    rng = np.random.default_rng(5)
    prints = np.unique((rng.integers(0, 4, 300) << 40 | rng.integers(0, 1 << 9, 300)).astype(np.uint64))
    left, right = linked_pairs(prints)
    near = np.bitwise_count(prints[:, None] ^ prints) <= 2
    assert len(left) == np.triu(near, 1).sum() and near[left, right].all()
    u, v = spanning_edges(prints)
    label = least_reachable(prints)
    assert len(u) == (label != np.arange(len(prints))).sum()
    assert dict(zip(u.tolist(), v.tolist(), strict=True)) == {int(p): int(prints[c]) for p, c in zip(prints, label, strict=True) if p != prints[c]}


@pytest.mark.parametrize("most", [512, 4])
def test_links_connect_as_all_pairs_do(spark, monkeypatch, most):
    monkeypatch.setattr(module, "MOST_IN_BUCKET", most)
    rng = np.random.default_rng(11)
    prints = np.unique(np.concatenate([rng.integers(0, 1 << 62, 200), rng.integers(0, 1 << 8, 60), (1 << 50) + rng.integers(0, 1 << 12, 300)]))
    frame = spark.createDataFrame([(int(p),) for p in prints], "fingerprint bigint")
    got = {r.u: r.v for r in components(links(frame)).collect()}
    label = least_reachable(prints)
    assert got == {int(p): int(prints[c]) for p, c in zip(prints, label, strict=True) if p != prints[c]}


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(501, 900)] + [(7, 7)]
    got = {r.u: r.v for r in components(spark.createDataFrame(chain, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(1, 101)} | {i: 500 for i in range(501, 900)}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_query_matches_all_pairs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    docs = sorted(docs)
    prints = [plain(t or "") for _, t in docs]
    label = least_reachable(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op10_simhash_pivots(spark, SMALL).collect()}
    assert got == {d: (f"{p:016x}", docs[c][0]) for (d, _), p, c in zip(docs, prints, label, strict=True)}


def test_nulls_copies_and_clashing_columns(rows):
    text = "some words that are here to be copied over and over again " * 3
    data = [(5, text, 1, "x"), (2, text.upper(), 2, "y"), (2, text.upper(), 2, "y"), (None, text, 3, "z"), (7, None, 4, None), (8, "", 5, None), (9, "quite other words in this one " * 4, 6, "q")]
    frame = rows(data, "doc_id long, text string, fingerprint long, component_id string")
    got = sorted((r.doc_id or -1, r.component_id) for r in near_duplicates(frame).collect())
    assert got == [(-1, 2), (2, 2), (2, 2), (5, 2), (7, 7), (8, 7), (9, 9)]
    kept = one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 2, 7, 9]


def test_no_documents(rows):
    assert near_duplicates(rows([], "doc_id long, text string")).count() == 0


def test_components_named_by_the_same_id_keep_a_document_each(rows):
    one, two, three = (f"{a} words that say {b} and nothing else at all " * 4 for a, b in (("some", "this"), ("quite", "other things"), ("last", "a third matter")))
    data = [(5, one, "a"), (5, two, "b"), (6, two, "c"), (5, three, "d"), (2, three, "e"), (5, one, "a"), (9, one, "f")]
    kept = one_of_each(rows(data, "doc_id long, text string, digest string"))
    assert kept.columns == ["doc_id", "text", "digest"]
    assert sorted(map(tuple, kept.collect())) == sorted([(5, one, "a"), (5, two, "b"), (2, three, "e")])
