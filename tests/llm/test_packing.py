import heapq
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskloom.llm import packing
from riskloom.llm.packing import WINDOW, Mixture, pack
from riskloom.llm.queries import op6_mixture_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"
plain = Tokenizer.from_file(PATH)
plain.encode_special_tokens = True


def sequential(lengths, shares, edges):
    """Serve slot by slot the queue whose next token is due first."""
    due = [(0.5 / s, i) for i, (s, n) in enumerate(zip(shares, lengths, strict=True)) if n]
    heapq.heapify(due)
    sent, out, total = [0] * len(lengths), [], 0
    for edge in edges:
        while total < edge:
            _, i = heapq.heappop(due)
            sent[i] += 1
            total += 1
            if sent[i] < lengths[i]:
                heapq.heappush(due, ((sent[i] + 0.5) / shares[i], i))
        out.append(list(sent))
    return out


@pytest.mark.parametrize(
    "lengths,shares",
    [
        ([5000], [1]),
        ([4000, 4000], [1, 1]),
        ([10_000, 3, 777, 1], None),
        ([3000, 3000, 3000], [0.7, 0.2, 0.1]),
        ([1] * 50 + [9000], None),
        ([100, 5000, 2048], [1e-9, 1, 1]),
    ],
)
def test_any_window_is_as_a_sequential_run_left_it(lengths, shares):
    mixture = Mixture(np.array(lengths), np.array(shares or lengths, float), window=64)
    windows = np.arange(mixture.windows + 1)
    assert mixture.sent(windows).tolist() == sequential(lengths, shares or lengths, mixture.edge(windows))
    assert mixture.sent(windows[-1:]).tolist() == [lengths]


def check_whole(pieces, docs, end):
    """Every id in one piece, sequences gapless and full but for powers of two."""
    ids = {d: np.array([*plain.encode(t or "", add_special_tokens=False).ids, end], "<u4") for d, t in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    assert set(by_doc) == set(ids)
    for d, parts in by_doc.items():
        place = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == place
            place += r.length
        assert place == len(ids[d])
    short = 0
    for parts in by_sequence.values():
        place = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place == WINDOW or place & (place - 1) == 0
        short += place != WINDOW
    assert short <= 11
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return by_sequence


def test_query_packs_everything_in_proportion(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    pieces = op6_mixture_packing(spark, SMALL).collect()
    sequences = check_whole(pieces, [(r.doc_id, r.text) for r in table], 1)
    source = {r.doc_id: r.source for r in table}
    total = Counter()
    for r in pieces:
        total[source[r.doc_id]] += r.length
    everything = sum(total.values())
    for parts in sequences.values():
        have = Counter()
        for r in parts:
            have[source[r.doc_id]] += r.length
        size = sum(have.values())
        if size == WINDOW:
            assert all(abs(have[s] - size * total[s] / everything) <= 2 for s in total)


def test_nulls_long_and_hot(rows):
    data = [(i, "word " * (i % 7), "hot" if i % 3 else None, 1) for i in range(200)] + [(900, "long words " * 20_000, "b", 2), (901, None, "c", 3)]
    frame = rows(data, "doc_id long, text string, source string, offset int")
    from pyspark.sql import functions as F

    got = pack(frame, PATH, 1).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_whole(got, [(d, t) for d, t, _, _ in data], 1)


def test_targets_and_repeated_rows(rows):
    data = [(1, "a b c d " * 500, "x")] * 2 + [(2, "e f g h " * 1000, "y")]
    got = pack(rows(data, "doc_id long, text string, source string"), PATH, 1, targets={"x": 0.75, "y": 0.25}).collect()
    first = Counter()
    for r in got:
        if r.sequence_id == 0:
            first[r.source] += r.length
    assert abs(first["x"] - 0.75 * WINDOW) <= 1
    assert sum(r.length for r in got) == sum(len(plain.encode(t, add_special_tokens=False).ids) + 1 for _, t, _ in data)


def test_no_documents(rows):
    assert pack(rows([], "doc_id long, text string, source string"), PATH, 1).count() == 0


def by_window(pieces):
    out = defaultdict(Counter)
    for r in pieces:
        out[r.sequence_id][r.source] += r.length
    return out


def test_sources_beyond_the_largest_keep_their_share(rows, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(packing, "MOST_QUEUES", 2)
    sizes = {"a": 900, "b": 800, "c": 300, "d": 290, "e": 200, "f": 7, "": 150}
    data = [(i, "some words of it " * (n // 10), s) for i, (s, n) in enumerate((s, n) for s, n in sizes.items() for _ in range(20))]
    data += data[-3:]
    frame = rows(data, "doc_id long, text string, source string").repartition(5)
    got = pack(frame, PATH, 1).withColumn("ids_crc32", F.crc32("ids")).collect()
    unique = [r for r in got if r.doc_id < data[-3][0]]
    total = Counter()
    for r in got:
        total[r.source] += r.length
    everything, places = sum(total.values()), defaultdict(int)
    assert everything == sum(len(plain.encode(t, add_special_tokens=False).ids) + 1 for _, t, _ in data)
    for r in unique:
        ids = np.array([*plain.encode(data[r.doc_id][1], add_special_tokens=False).ids, 1], "<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == places[r.sequence_id]
        places[r.sequence_id] += r.length
    for have in by_window(got).values():
        if sum(have.values()) == WINDOW:
            assert all(abs(have[s] - WINDOW * total[s] / everything) <= 3 for s in total)


def test_small_sources_have_their_targets(rows, monkeypatch):
    monkeypatch.setattr(packing, "MOST_QUEUES", 1)
    data = [(1, "a b c d " * 4000, "x"), (2, "e f g h " * 1000, "y"), (3, "i j k l " * 900, "z"), (4, "m n o p " * 800, "w"), (5, "q " * 500, "v")]
    targets = {"x": 0.5, "y": 0.3, "z": 0.2}
    got = pack(rows(data, "doc_id long, text string, source string"), PATH, 1, targets=targets).collect()
    first = by_window(got)[0]
    assert all(abs(first[s] - targets.get(s, 0) * WINDOW) <= 2 for s in "xyzwv")
    last = {s: max(r.sequence_id for r in got if r.source == s) for s in "xyz"}
    assert min(r.sequence_id for r in got if r.source in "wv") >= max(last.values())
    assert sum(r.length for r in got) == sum(len(plain.encode(t, add_special_tokens=False).ids) + 1 for _, t, _ in data)
