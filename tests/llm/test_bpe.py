import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import bpe, common, tokens
from riskloom.llm.bpe import Encoder, decoded, encoded
from riskloom.llm.queries import op3_bpe_tree
from riskloom.llm.tokens import ranks

SMALL = "/root/testdata/sf0.001"
PATHS = [public_tokenizers.path(f"{name}.tiktoken") for name in ("byte_bpe_multi_50k", "byte_bpe_50k")]
LIBRARY = {p: tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(p), special_tokens={}) for p in PATHS}
OURS = {p: Encoder(p, public_tokenizers.PATTERN) for p in PATHS}
ALPHABET = list("ab'srevl.1 \n\t \x1c-é漢")


@pytest.fixture(autouse=True)
def small_leaves(monkeypatch):
    monkeypatch.setattr(bpe, "LEAF", 8)
    monkeypatch.setattr(bpe, "NEAR", 12)


def same(text):
    for path, ours in OURS.items():
        ids = ours.encode(text).tolist()
        assert ids == LIBRARY[path].encode_ordinary(text), (path, text)
        assert ours.decode(ids) == text.encode()


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.sampled_from(ALPHABET), max_size=80))
def test_any_text(text):
    same(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_characters(text):
    same(text)


@pytest.mark.parametrize("seed", range(4))
def test_long_runs(seed):
    rng = random.Random(seed)
    for letters in ("a", "ab", "e1", "漢字かな", " ", "=-", "\n ", "the", "aeiou"):
        same("".join(rng.choice(letters) for _ in range(rng.randint(200, 900))))


def test_long_pieces_match_the_plain_merge():
    ours = OURS[PATHS[0]]
    rng = random.Random(9)
    for letters in (b"a", b"ab", b"eta", bytes(range(128, 200))):
        run = bytes(rng.choice(letters) for _ in range(500))
        plain = [bytes([b]) for b in run]
        while True:
            found = [(ours.ranks[a + b], i) for i, (a, b) in enumerate(zip(plain, plain[1:], strict=False)) if a + b in ours.ranks]
            if not found:
                break
            _, i = min(found)
            plain[i : i + 2] = [plain[i] + plain[i + 1]]
        assert ours.merge(run) == [ours.ranks[p] for p in plain] == ours._halves(run)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abcdeinorst éß漢'"), min_size=1, max_size=25), max_size=12))
def test_pieces_side_by_side_are_the_pieces_alone(words):
    pieces = [w.encode() for w in words]
    for ours in OURS.values():
        assert [np.frombuffer(ids, ours.words.kind).tolist() for ids in ours.merge_many(pieces)] == [ours.merge(p) for p in pieces]


def test_learnt_words_have_the_ids_of_words_met():
    text = "Einführung, unforgettably zzzqqqxxyy! a  b\nnew line. " + "x" * 70 + " 12 don't naïve. the the,"
    for path in PATHS:
        ours = Encoder(path, public_tokenizers.PATTERN)
        ours.words.learn([text, ""])
        assert ours.words.later.knows("unforgettably") and ours.words.later.knows("naïve") and not ours.words.later.knows("x" * 70)
        assert ours.encode(text).tolist() == LIBRARY[path].encode_ordinary(text)


def test_learning_keeps_memory_bounded(monkeypatch):
    monkeypatch.setattr(common, "MOST_REMEMBERED", 100)
    ours = Encoder(PATHS[0], public_tokenizers.PATTERN)
    monkeypatch.setattr(tokens, "TOGETHER", 40)
    letters = "abcdefghij"
    text = " ".join(a + b + c for a in letters for b in letters for c in letters)
    ours.words.learn([text])
    assert len(ours.words.later) <= 100 and len(ours.words.later.old) <= 100
    assert ours.encode(text).tolist() == LIBRARY[PATHS[0]].encode_ordinary(text)


def test_joins_of_any_two_parts():
    ours, library = OURS[PATHS[0]], LIBRARY[PATHS[0]]
    text = "It's 'll 're   here, x'r e 12ab3\n\n  end.'s''s  \t'v e  word, " + "aaab" * 20
    for at in range(len(text) + 1):
        left, right = text[:at], text[at:]
        joined = ours.join(left, ours.encode(left), right, ours.encode(right))
        assert joined.tolist() == library.encode_ordinary(text), at


def test_query_matches_the_library(spark, monkeypatch):
    monkeypatch.undo()
    docs = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    got = op3_bpe_tree(spark, SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        text = docs[r.doc_id] or ""
        ids = LIBRARY[PATHS[0]].encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_nulls_repeats_and_clashing_columns(rows, monkeypatch):
    monkeypatch.undo()
    long = "A rather long text, and then some; 1234 " * 3000
    data = [(1, None, "x", 5), (2, "", "y", None), (3, long, None, 7), (3, long, None, 7)]
    frame = rows(data, "doc_id long, text string, ids string, decoded int")
    ids = encoded(frame.drop("decoded"), PATHS[0], public_tokenizers.PATTERN)
    assert ids.columns == ["doc_id", "ids"]
    got = decoded(ids, PATHS[0], public_tokenizers.PATTERN).orderBy("doc_id").collect()
    assert [bytes(r.decoded) for r in got] == [b"", b"", long.encode(), long.encode()]
    some = rows([(1, None), (2, []), (3, [65, 66])], "doc_id long, ids array<int>")
    got = decoded(some.coalesce(1), PATHS[0], public_tokenizers.PATTERN).orderBy("doc_id").collect()
    assert [r.decoded and bytes(r.decoded) for r in got] == [None, b"", OURS[PATHS[0]].bytes[65] + OURS[PATHS[0]].bytes[66]]
    assert encoded(rows([], "doc_id long, text string"), PATHS[0], public_tokenizers.PATTERN).count() == 0
