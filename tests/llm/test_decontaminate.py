import random
import re

import pytest

from riskloom.llm.decontaminate import contaminated

DOCS = "doc_id bigint, text string, n_words int, items string, digest string, span int"
ITEMS = "item_id bigint, text string, start int, class string"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        span = min(10, len(w))
        for s in range(len(w) - span + 1) if span else ():
            windows.setdefault(tuple(w[s : s + span]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for span in {len(g) for g in windows}:
            for s in range(len(w) - span + 1):
                if tuple(w[s : s + span]) in windows:
                    hit.update(range(s, s + span))
                    found |= windows[tuple(w[s : s + span])]
        out.append((doc, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return out


def check(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x", "y", 2) for i, t in docs], DOCS).repartition(4)
    i = spark.createDataFrame([(k, t, 1, "z") for k, t in items], ITEMS).repartition(3)
    rows = contaminated(d, i).collect()
    key = repr
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows), key=key) == sorted(brute(docs, items), key=key)
    for r in rows:
        assert len({p for s in r.spans for p in range(s.start, s.to)}) == r.n_hit
    return rows


def text_of(rng, n, vocabulary):
    return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", " - "]) for _ in range(n))


@pytest.mark.parametrize("vocabulary", [["a", "b"], ["a", "B", "é", "É"], [f"w{i}" for i in range(300)]])
def test_passages_of_any_length_are_found(spark, vocabulary):
    """Few words make many ties, repeats and windows that several items share."""
    rng = random.Random(len(vocabulary))
    items = [(i, text_of(rng, n, vocabulary)) for i, n in enumerate([3, 7, 9, 10, 10, 11, 12, 25, 40, 60])]
    docs = [(i, text_of(rng, rng.randrange(60), vocabulary)) for i in range(40)]
    for i in range(60):
        passage = words(rng.choice(items)[1])
        low = rng.randrange(len(passage))
        inside = " ".join(passage[low : low + rng.randrange(1, 30)])
        docs.append((100 + i, text_of(rng, rng.randrange(9), vocabulary) + inside + " " + text_of(rng, 5, vocabulary)))
    check(spark, docs, items)


def test_nulls_repeats_ties_and_long_texts(spark):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(50)]
    passage = text_of(rng, 80, vocabulary)
    items = [(1, passage), (1, passage), (2, passage), (None, text_of(rng, 12, vocabulary)), (3, None), (4, ""), (5, " .,! ")]
    items += [(6, "one"), (7, "ONE"), (8, "x" * 100_000)]
    docs = [(1, passage), (1, passage), (1, "one of two"), (None, passage), (None, items[3][1]), (2, None), (3, ""), (4, "...")]
    docs += [(5, text_of(rng, 30_000, vocabulary) + passage), (6, "x" * 100_000), (7, "one " * 3000), (8, "word " * 9)]
    rows = check(spark, docs, items)
    assert {r.n_hit > 0 for r in rows} == {True, False}


def test_empty_tables(spark):
    docs = [(1, "one two three"), (2, None)]
    assert [r.n_hit for r in check(spark, docs, [])] == [0, 0]
    assert [r.n_hit for r in check(spark, docs, [(1, None)])] == [0, 0]
    assert check(spark, [], [(1, "one two")]) == []


def test_common_passage_and_no_python_in_the_plan(spark):
    """A passage in every document and every item, and joins that shuffle."""
    rng = random.Random(5)
    vocabulary = [f"u{i}" for i in range(1000)]
    common = text_of(rng, 15, vocabulary)
    items = [(i, common + text_of(rng, 12, vocabulary)) for i in range(50)]
    docs = [(i, text_of(rng, 20, vocabulary) + common) for i in range(300)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        rows = check(spark, docs, items)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert all(len(r["items"]) == 50 for r in rows)
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    plan = contaminated(d, i)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)
