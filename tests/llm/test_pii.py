import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.functions import array_to_vector

from riskloom.llm import pii
from riskloom.llm.pii import ADDED_KINDS, BASE_KINDS, Trees, base_spans, calibrated, candidates, examples, fitted, listed, redact, with_spans
from riskloom.llm.queries import op8_pii_boosting

MIDDLE = "/root/testdata/sf0.01"
#: The patterns as given.
GIVEN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for rank, (kind, pattern) in enumerate(GIVEN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab.@-1259+ ()%é\n")), max_size=60))
def test_base_spans_follow_the_patterns(text):
    assert listed(base_spans(text)) == plain(text)


@pytest.mark.parametrize("seed", range(3))
def test_base_spans_in_mixed_text(seed):
    rng = random.Random(seed)
    bits = ["a.b@c.de", "x@y@z.com", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "000255.0.0.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (974) 555-3436", "+12 ", "@", "@.a", "a@b-.c-", "7" * 30, " ", "é", "..", "-"]
    for _ in range(400):
        text = "".join(rng.choice(bits) + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(1, 8)))
        assert listed(base_spans(text)) == plain(text), text


def test_long_runs_take_linear_time():
    start = time.time()
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1 " + " " * 300_000, "a@" * 100_000, "1 " * 150_000, "ab=" * 90_000, "(" * 200_000 + "1", "key=" * 75_000, "key: '" * 50_000, "a1b2c3d4e5f6g7h8." * 18_000, "key=\"" + "\\" * 300_000):
        base_spans(text)
        candidates(text)
    assert time.time() - start < 20


@pytest.mark.parametrize(
    ("text", "secret"),
    [
        ("password=Tr0ub4dor&3xyz!long, then", "Tr0ub4dor&3xyz!long"),
        ("my token: hunter2abc.", "hunter2abc"),
        ('api_key="sk-abc.def.ghi12345678" here', "sk-abc.def.ghi12345678"),
        ("passwd='p@ss w0rd'", "p@ss w0rd"),
        ('{"secret": "abc\\"def123", "x": 1}', 'abc\\"def123'),
        ("see eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.short_1 there", "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.short_1"),
        ("a.b1.0123456789abcdef0123 x", "a.b1.0123456789abcdef0123"),
        ("token='abcdefgh12 and no end", "abcdefgh12"),
        ("password=" + "aB3$" * 1250, "aB3$" * 1250),
    ],
)
def test_secrets_are_proposed_whole(text, secret):
    assert [text[s:e] for s, e, k in candidates(text) if k == "secret"] == [secret]


@pytest.mark.parametrize("text", ["The key: understanding people.", "Authors: Miller2019x", "key: 2024-05-01", 'The key: "we had 5 reasons"', "pass://host1234", "password=", "token:", "token: !", "key==12345678"])
def test_prose_behind_a_colon_is_no_secret(text):
    assert not [c for c in pii.keyed_secrets(text)]


def test_a_secret_is_chosen_whole_over_what_it_holds(trees):
    for text in ("the password = x!Ab3jane.doe@mail3.com today", "token=ab12cd34ef56gh78!555-343-6789-12 x"):
        secret = text.split("=")[1].split()[0]
        base = base_spans(text)
        assert redact(text, base + trees.chosen(text, base)) == text.replace(secret, "[secret]")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["key", "token=", "pass:", "'", '"', " ", ".", "a1b2c3d4e5f6g7h8", "=", "\\", "\n", "x@y.z", "é"]), max_size=14).map("".join))
def test_secrets_lie_in_no_other(text):
    own = [c for c in candidates(text) if c[2] == "secret"]
    assert all(0 <= s < e <= len(text) for s, e, _ in own)
    assert not [1 for a in own for b in own if a != b and a[0] <= b[0] and b[1] <= a[1]]


def test_query_matches_the_patterns_everywhere(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op8_pii_boosting(spark, MIDDLE).collect()}
    assert len(got) == len(docs)
    added = 0
    for k, text in docs:
        base = plain(text or "")
        counts = Counter(s.split(":")[0] for s in base.split(",") if s)
        r = got[k]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind in BASE_KINDS] == [counts[kind] for kind in BASE_KINDS]
        spans = [s for s in r.spans.split(",") if s]
        assert [s for s in spans if s.split(":")[0] in BASE_KINDS] == [s for s in base.split(",") if s]
        added += sum(s.split(":")[0] in ADDED_KINDS for s in spans)
        for kind, start, end in (s.split(":") for s in spans if s.split(":")[0] in ADDED_KINDS):
            assert re.search(r"[0-9@]|at", text[int(start) : int(end)]), kind
    assert added > 0


@pytest.fixture(scope="module")
def trees(spark):
    return fitted(spark.read.parquet(f"{MIDDLE}/documents.parquet"))


def test_trees_generalise_to_other_ways_of_writing(trees):
    text = 'write to jane.doe (at) mail3 (dot) com or call (974) 555-3436, the token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" is old.'
    kinds = {k: text[s:e] for s, e, k in trees.chosen(text, base_spans(text))}
    assert kinds["secret"] == "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    assert trees.chosen("version 3.0 of chapter 12, page 1024, at the end.", []) == []


def test_task_trees_are_spark_trees(spark, trees, tmp_path, monkeypatch):
    """The numpy walk gives the probabilities of the saved model."""
    from pyspark.ml.classification import GBTClassificationModel

    folders = []
    keep = pii._saved_trees
    monkeypatch.setattr(pii, "_saved_trees", lambda model, s, folder: folders.append(folder) or keep(model, s, folder))
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    ours = fitted(docs)
    model = GBTClassificationModel.load(folders[0])
    rows = examples(docs).withColumn("features", array_to_vector("features"))
    expected = model.transform(rows).select("features", "probability").collect()
    found = ours.probabilities(np.array([r.features.toArray() for r in expected]))
    assert np.allclose(found, [r.probability[1] for r in expected])


def test_calibration():
    scores, labels = np.array([0.9, 0.8, 0.8, 0.7, 0.6]), np.array([1, 1, 0, 1, 1])
    assert calibrated(scores, labels, 0.99) == 0.9
    assert calibrated(scores, labels, 0.8) == 0.6
    assert calibrated(np.array([0.3, 0.2]), np.array([1, 1]), 0.9) == 0.5
    assert calibrated(scores, labels * 0, 0.9) > 1 and calibrated(np.array([]), np.array([]), 0.9) > 1


def test_redaction_joins_overlaps():
    assert redact("call +1 234 567 890 now", [(5, 19, "phone"), (8, 19, "card")]) == "call [phone] now"
    assert redact("ab", []) == "ab" and redact("a@b.c d", [(0, 5, "email")]) == "[email] d"


def test_nulls_repeats_and_nothing_to_learn(rows):
    frame = rows([(1, None, "x"), (1, "a@b.cd", "y"), (1, "a@b.cd", "y"), (None, "plain " * 40_000, None)], "doc_id long, text string, spans string")
    assert fitted(frame.filter("text is null")) is None
    got = with_spans(frame, None).collect()
    assert sorted((r.base, r.redacted is None) for r in got) == [("", False), ("", True), ("email:0:6", False), ("email:0:6", False)]
    assert with_spans(rows([], "doc_id long, text string"), None).count() == 0


def test_a_rare_kind_is_learnt_and_calibrated_beside_a_common_one(rows):
    """Each kind and label has its own draw, and every candidate of the third counts for the thresholds."""
    rng = random.Random(5)
    hexed = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    data = [(i, " ".join(f"number {rng.randint(10**7, 10**9)} of" for _ in range(50))) for i in range(200)]
    data += [(1000 + i, f"file {hexed(40)} has token={hexed(40)} in it") for i in range(60)]
    docs = rows(data, "doc_id long, text string")
    drawn = Counter((r.kind, r.label) for r in examples(docs, 25).collect())
    assert drawn["secret", 1] == drawn["secret", 0] == drawn["number", 0] == 25
    trees = fitted(docs, 25)
    assert trees.thresholds["secret"] <= 1
    text = f"now token={hexed(40)} ends"
    assert [(s, e, k) for s, e, k in trees.chosen(text, [])] == [(10, 50, "secret")]
    held = sum(pii.draw_of(d, t, c) % 3 == 0 for d, t in data for c in candidates(t) if c[2] == "secret" and t[c[0] - 1] == "=")
    assert sum(r.positive for r in pii.score_sums(docs, trees).collect() if r.kind == "secret") == held


@pytest.mark.parametrize("size", [128, 129, 5000])
def test_long_secrets_are_proposed_whole(size):
    value = ("k3Y" * size)[:size]
    assert candidates(f"token={value} rest") == [(6, 6 + size, "secret")]
    assert candidates(f"see {value}== rest") == [(4, 6 + size, "secret")]
    assert redact(f"token={value}", candidates(f"token={value}")) == "token=[secret]"
    start = time.time()
    for text in ("a1" * 300_000 + "===", "token=" + "a1" * 300_000, "ab=" + "a" * 300_000 + "=" * 5, "token=a1b2c3d4" * 30_000):
        candidates(text)
    assert time.time() - start < 20


def test_many_spans_take_linear_time():
    rng = random.Random(2)
    text = " ".join(f"+49 30 {rng.randrange(10**7, 10**8)}" for _ in range(50_000))
    start = time.time()
    base = pii.base_spans(text)
    known = pii.Placed(base)
    assert sum(pii.certain(text, c, known) for c in candidates(text)) == 50_000
    assert len(pii.likeliest([(rng.random(), c) for c in candidates(text)])) == 50_000
    assert time.time() - start < 10


def test_touching_and_likeliest_are_those_of_all_pairs():
    rng = random.Random(7)
    for _ in range(200):
        spans = [(s, s + rng.randrange(1, 12), "number") for s in (rng.randrange(40) for _ in range(rng.randrange(12)))]
        known = pii.Placed(spans)
        for start in range(40):
            end = start + rng.randrange(1, 6)
            assert sorted(known.touching(start, end)) == sorted(x for x in spans if start < x[1] and x[0] < end)
        scored = [(rng.choice([0.5, 0.7, 0.9]), x) for x in spans]
        kept = []
        for _, x in sorted(scored, key=lambda y: (-y[0], y[1])):
            if not any(x[0] < e and s < x[1] for s, e, _ in kept):
                kept.append(x)
        assert sorted(pii.likeliest(scored)) == sorted(kept)
