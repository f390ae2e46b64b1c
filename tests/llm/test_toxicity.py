import math
import re
import time
import zlib

import numpy as np
import pytest

from riskloom.llm.queries import op1_toxicity_channel
from riskloom.llm.toxicity import (
    CLASSES,
    Restorer,
    Scorer,
    _class_of,
    disguised,
    character_model,
    evidence,
    labelled_sample,
    restored,
    scored,
    trigram_counts,
)

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return character_model(spark.read.parquet(f"{MIDDLE}/documents.parquet"))


def test_model_counts_every_text(spark, model):
    texts = [r.text for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").select("text").collect()]
    counts = np.zeros(CLASSES**3)
    for t in texts:
        classes = [_class_of(c) for c in f" {(t or '').lower()} "]
        for a, b, c in zip(classes, classes[1:], classes[2:], strict=False):
            counts[(a * CLASSES + b) * CLASSES + c] += 1
    ours = sum(trigram_counts(t) for t in texts if t)
    # Letters outside Latin-1 are edges to the counting and letters to the search; there are none here.
    assert (ours == counts).all()
    assert np.allclose(np.exp(model).sum(axis=2), 1)


@pytest.mark.parametrize(
    "written,meant",
    [("1d10t", "idiot"), ("m0r0n", "moron"), ("i.d.i.o.t", "idiot"), ("idiiiiot", "idiot"), ("p@thet1c!!", "pathetic"),
     ("$cum", "scum"), ("tr@sh$$$", "trash"), ("l000ser", "loser"), ("the***", "the"), ("is", "is"), ("555-1234", "555-1234")],
)
def test_disguised_words(model, written, meant):
    assert Restorer(model).word(written) == meant


def test_single_letters_in_a_row(model):
    assert Restorer(model).words("You are an I D I O T and\na fool")[:4] == ["you", "are", "an", "idiot"]
    assert Restorer(model).words("") == []


def test_viterbi_finds_the_best_path(model):
    """Against every path of the lattice."""
    restorer = Restorer(model)

    def paths(region):
        runs = []
        for char in region:
            if runs and runs[-1][0] == char:
                runs[-1][1] += 1
            else:
                runs.append([char, 1])
        found = [("", 0.0)]
        for place, (char, length) in enumerate(runs):
            options = restorer._readings(char, length, 0 < place < len(runs) - 1)
            found = [(t + r, s + c) for t, s in found for r, c in options]
        return found

    def score(text):
        classes, total = [0, 0, *map(_class_of, text), 0], 0.0
        for a, b, c in zip(classes, classes[1:], classes[2:], strict=False):
            total += restorer.model[a][b][c]
        return total

    for region in ("1d10t", "m000r0n", "a.b.1", "$$cum", "loooser+", "w.0.w"):
        best = max(s + score(t) for t, s in paths(region))
        text = restorer.decode(region)
        assert math.isclose(max(s + score(t) for t, s in paths(region) if t == text), best)


def test_restored_keeps_rows_and_columns(rows, model):
    got = restored(rows([(1, "An 1d10t", "x"), (2, None, None)], "doc_id long, text string, restored string"), model)
    assert got.orderBy("doc_id").select("doc_id", "text", "restored").collect() == [(1, "An 1d10t", "an idiot"), (2, None, "")]


def test_query_scores_held_out_rows(spark):
    got = {r.doc_id: r for r in op1_toxicity_channel(spark, MIDDLE).collect()}
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    for k, r in got.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in labels if got[r.doc_id].held_out]
    right = sum(got[r.doc_id].predicted == r.toxic for r in held)
    assert right >= 0.9 * len(held)


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    from pyspark.sql import functions as F

    from riskloom.llm.toxicity import held_out

    turned = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    keep = lambda frame: {r.doc_id: round(r.score, 9) for r in frame.select("doc_id", "score").collect()}
    assert keep(scored(docs, labels)) == keep(scored(docs, turned))


def test_disguised_copies_score_like_plain_ones(spark, model):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    weights = evidence(labelled_sample(docs, labels), model)
    scorer = Scorer(model, weights)
    plain = scorer.features("and then the idiot of them was a clown")
    assert plain[0] > 2
    assert scorer.features("and then the 1d10t of them was a c l o w n") == pytest.approx(plain, abs=0.05)
    assert scorer.features("") == [0.0, 0.0, 0.0, 0.0]


def test_no_labels_nulls_and_clashing_columns(rows, spark):
    docs = rows([(1, "a text", "x"), (2, None, None), (None, "", "z")], "doc_id long, text string, score string")
    none = rows([(1, None), (2, 0), (None, 1)], "doc_id long, toxic int")
    assert sorted(r.score for r in scored(docs, none).collect()) == [0.0, 0.0, 0.0]
    empty = rows([], "doc_id long, text string")
    assert scored(empty, rows([(1, 1)], "doc_id long, toxic int")).count() == 0
    many = [(i, f"{'bad ' * (i % 2)} word{i} " * 5 + "x" * (i * 500)) for i in range(60)]
    got = scored(rows([*many, (None, "bad")], "doc_id long, text string"), rows([(i, i % 2) for i in range(60)], "doc_id long, toxic int"))
    assert all((r.score >= 0.5) == bool(r.doc_id % 2) for r in got.collect() if r.doc_id is not None)


@pytest.mark.parametrize(
    "written,meant",
    [("stuupid", "stupid"), ("idiiot", "idiot"), ("stu.pid", "stupid"), ("id-iot", "idiot"), ("i..d..i..o..t", "idiot"), ("555-1234", "555-1234"),
     ("worthless", "worthless"), ("beer", "beer")],
)
def test_doubles_and_separated_groups(model, written, meant):
    assert Restorer(model).word(written) == meant


def test_letters_beyond_latin_1_are_counted_as_letters():
    text = "Дом ab ЖжЖ łódź"
    classes = [_class_of(c) for c in f" {text.lower()} "]
    counts = np.zeros(CLASSES**3)
    for a, b, c in zip(classes, classes[1:], classes[2:], strict=False):
        counts[(a * CLASSES + b) * CLASSES + c] += 1
    assert (trigram_counts(text) == counts).all()


def test_long_words_take_linear_time():
    restorer = Restorer(np.log(np.full((CLASSES, CLASSES, CLASSES), 1 / CLASSES)))
    start = time.time()
    assert restorer.words("abcdefghij" * 100_000) == ["abcdefghij" * 100_000]
    restorer.words("漢字かな" * 250_000)
    restorer.words("ab.cd." * 20_000 + "!")
    restorer.words("a1b2c3d0" * 10_000)
    restorer.words("a b c d " * 10_000)
    assert time.time() - start < 20


def test_what_gets_a_lattice():
    old = re.compile(r"(?=.*[^\W\d_])(?=.*[01345789@\$!|+])|([^\W\d_])\1|^(?=.*[^\W\d_])(?:[^\W_]+[.\-_*]+)+[^\W_]+$")
    words = ["idiot", "1d1ot", "f.u.c.k", "f..k", "a.", ".a.b", "1.2", "1.b", "aab", "a_b", "a!", "123", "漢字", "a-b-c!", "é1", "__", ""]
    assert [disguised(w) for w in words] == [bool(old.search(w)) for w in words]
