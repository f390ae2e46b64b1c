"""Toxicity of whole texts: noisy-channel restoration of disguised words, then a score of the restored text.

Restoration. A word may be disguised if it mixes letters with look-alike symbols, repeats a letter, has
separators between letters, or if single letters stand alone in a row. Such a region is a lattice: a symbol is
itself or a letter it looks like, a run is one or two letters, separators stay or go. Blanks between groups of
letters always stay. Viterbi decoding picks the path that is likeliest under the channel and a character trigram model,
whose counts come from every text of the table. All other words have one path, themselves.

Score. Evidence is whole restored words and word beginnings. Their document counts by label come from
at most ``TRAIN_ROWS`` labelled rows, drawn by a hash of the id; of near copies (same least shingle hash) one
counts. Kept are those that ``LEAST_SHARE`` of the toxic rows have and that clearly lean to them, the
``MOST_EVIDENCE`` strongest. A logistic regression turns a document's evidence (strongest, how many kinds,
how many words, what share of its words) into a probability.

Defined results: null texts are empty. Texts without evidence, empty ones among them, get the low score that
goes with none. Labels that contradict each other count as toxic, null labels not at all. Without a label of
either kind every score is 0. Rows with equal ids are scored each. Sizes of the alphabet, sample and evidence bound
all that leaves the tasks.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Recent, slices, with_fields
from riskloom.session import stored, use_checkpoint_dir

TRAIN_ROWS = 20_000
LEAST_SHARE = 0.01
MOST_EVIDENCE = 20_000
#: A word's beginnings of these lengths are evidence beside the word.
BEGINNINGS = (4, 5, 6, 7)
#: The letters that a symbol may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t",
}
SEPARATORS = " .-_*"
#: Log probabilities of the channel: a symbol meant as such, a separator that stays, one that was put in.
AS_IS, STAYS, PUT_IN = math.log(0.01), math.log(0.5), math.log(0.5)
#: Of a letter written twice: meant so, meant once. Rare, so that plain words of the corpus keep their double letters.
TWICE, ONCE = math.log(0.997), math.log(0.003)
#: Classes of the model: 0 for the edge of a word, then a to z, then every other letter.
CLASSES = 28
_CLASS = np.zeros(256, np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[0xC0:] = 27

_EDGES = "\"'.,;:?()[]{}<>%&*#~`"
_SYMBOLS = re.escape("".join(LOOKALIKES))
_LETTER, _SYMBOL = re.compile(r"[^\W\d_]"), re.compile(f"[{_SYMBOLS}]")
_TWICE = re.compile(r"([^\W\d_])\1")
#: Groups of letters and digits with separators between them; possessive, so linear.
_PARTED = re.compile(r"(?:[^\W_]++[.\-_*]++)++[^\W_]++$")
#: Marks at the end of a word that stand for nothing.
_TRAILING = re.compile(r"!+$|([$+|@])\1\1+$")


def disguised(word: str) -> bool:
    """Whether a word gets a lattice: it has a letter, and symbols, a letter twice in a row, or separators inside."""
    return bool(_TWICE.search(word) or _LETTER.search(word) and (_SYMBOL.search(word) or _PARTED.match(word)))


def _class_of(char: str) -> int:
    code = ord(char)
    return int(_CLASS[code]) if code < 256 else (27 if char.isalpha() else 0)


# Character model


def trigram_counts(text: str) -> np.ndarray:
    """Counts of class trigrams of the lower-cased text; the places of the alphabet are digits to base 28."""
    lowered = f" {text.lower()} "
    try:
        classes = _CLASS[np.frombuffer(lowered.encode("latin-1"), np.uint8)]
    except UnicodeEncodeError:
        found, place = np.unique(np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), "<u4"), return_inverse=True)
        classes = np.array([_class_of(chr(c)) for c in found.tolist()], np.int64)[place]
    codes = (classes[:-2] * CLASSES + classes[1:-1]) * CLASSES + classes[2:]
    return np.bincount(codes, minlength=CLASSES**3)


def character_model(df: DataFrame, text: str = "text") -> np.ndarray:
    """Log probabilities of a class after two others, from all texts: at most 28**3 sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for batch in slices(batches):
            for t in batch.column(0).to_pylist():
                if t:
                    total += trigram_counts(t)
        seen = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["code", "n"])

    each = df.select(F.col(text).cast("string")).mapInArrow(run, "code bigint, n bigint")
    counts = np.zeros(CLASSES**3)
    for code, n in each.groupBy("code").agg(F.sum("n")).collect():
        counts[code] = n
    counts = counts.reshape(CLASSES, CLASSES, CLASSES)
    pairs = counts.sum(axis=0) + 1.0
    pairs /= pairs.sum(axis=1, keepdims=True)
    return np.log((counts + 20 * pairs[None]) / (counts.sum(axis=2, keepdims=True) + 20))


# Restoration


class Restorer:
    """Restored words of texts under a character model."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self._known = Recent(self._restored)

    def decode(self, region: str) -> str:
        """The likeliest reading of a region: a Viterbi search whose states are the last two classes.

        A state keeps its last reading and the state before, so a region of any length takes linear time and space.
        """
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        runs = [(char, len(list(same))) for char, same in groupby(region)]
        for place, (char, length) in enumerate([*runs, ("", 1)]):
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for reading, cost in self._readings(char, length, inside=0 < place < len(runs) - 1):
                classes = tuple(map(_class_of, reading)) if char else (0,)
                for (a, b), (score, path) in best.items():
                    score += cost
                    # An empty reading leaves the state, and the end of the region is an edge.
                    for c in classes:
                        score += self.model[a][b][c]
                        a, b = b, c
                    state = (a, b)
                    if state not in after or score > after[state][0]:
                        after[state] = (score, (reading, path))
            best = after
        path, readings = max(best.values(), key=lambda found: found[0])[1], []
        while path:
            reading, path = path
            readings.append(reading)
        return "".join(reversed(readings))

    @staticmethod
    def _readings(char: str, length: int, inside: bool) -> list[tuple[str, float]]:
        if not char:
            return [("", 0.0)]
        if char in LOOKALIKES:
            letters = LOOKALIKES[char]
            meant = math.log((1 - math.exp(AS_IS)) / len(letters))
            return [(char * length, AS_IS)] + [(c * n, meant) for c in letters for n in {length if length < 3 else 1, min(length, 2)}]
        if char in SEPARATORS and inside:
            return [(char * length, STAYS), ("", PUT_IN)]
        if length == 2 and char.isalpha():
            return [(char * 2, TWICE), (char, ONCE)]
        if length >= 3 and char.isalpha():
            return [(char, math.log(0.5)), (char * 2, math.log(0.5))]
        return [(char * length, 0.0)]

    def word(self, word: str) -> str:
        """A lower-cased word without the marks around it, restored if it is disguised."""
        return self._known[word]

    def _restored(self, word: str) -> str:
        known = word.strip(_EDGES)
        if not known.isalpha():
            known = _TRAILING.sub("", known).rstrip(_EDGES)
        return self.decode(known).strip(_EDGES) if disguised(known) else known

    def words(self, text: str) -> list[str]:
        """The text's words, restored; single letters that stand in a row are read together."""
        found = text.lower().split()
        restored = list(map(self._known.__getitem__, found))
        alone = np.fromiter(map(len, found), np.int64, len(found)) == 1
        if (alone[:-2] & alone[1:-1] & alone[2:]).any():
            out, at = [], 0
            for single, run in groupby(alone.tolist()):
                length = len(list(run))
                if single and length >= 3:
                    out += self.decode(" ".join(found[at : at + length])).split()
                else:
                    out += restored[at : at + length]
                at += length
            return out
        return restored


def restored(df: DataFrame, model: np.ndarray, text: str = "text") -> DataFrame:
    """Add ``restored``: the restored words of each text, joined by blanks. Other columns stay."""
    others = [c for c in df.columns if c not in (text, "restored")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in slices(batches):
            found = [" ".join(restorer.words(t or "")) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string())], names=[text, *others, "restored"]
            )

    rows = df.select(F.col(text).cast("string"), *others)
    return rows.mapInArrow(run, with_fields(rows, "restored string"))


# Evidence and score


def evidence_of(word: str) -> list[str]:
    """The word, and its beginnings with a mark that no word starts with."""
    return [word] + [f" {word[:n]}" for n in BEGINNINGS if n <= len(word)]


class Scorer:
    """What of a text counts, given the weight of each piece of evidence."""

    def __init__(self, model: np.ndarray, weights: dict[str, float]):
        self.restorer, self.weights = Restorer(model), weights
        self._known = Recent(self._found)

    def _found(self, word: str) -> tuple[str, ...]:
        return tuple(e for e in evidence_of(word) if e in self.weights)

    def features(self, text: str) -> list[float]:
        words = self.restorer.words(text)
        found, hits = set(), 0
        for known in map(self._known.__getitem__, set(words)):
            if known:
                found.update(known)
                hits += 1
        strongest = max((self.weights[e] for e in found), default=0.0)
        return [strongest, math.log1p(len(found)), math.log1p(hits), hits / max(1, len(words))]


def held_out(doc_id: Column) -> Column:
    """Whether a row's label is never learnt from."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Stored ``doc_id, text, toxic`` of at most ``rows`` labelled documents that may be learnt from, near copies once."""
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    one = usable.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    drawn = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # At most ``rows`` pairs of numbers, so the texts need no shuffle.
    joined = texts.join(F.broadcast(drawn), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for text in batch.column(1).to_pylist():
                words = text.encode().lower().split()
                shingles = zip(words, words[1:], words[2:], strict=False) if len(words) > 2 else [tuple(words)]
                keys.append(min(map(xxhash.xxh3_64_intdigest, map(b" ".join, shingles), repeat(7))) >> 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=["doc_id", "text", "toxic", "key"])

    keyed = stored(joined.select("doc_id", "text", "toxic").mapInArrow(run, "doc_id bigint, text string, toxic int, key bigint"))
    first = keyed.groupBy("toxic", "key").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    return stored(keyed.join(F.broadcast(first), "doc_id", "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "text", "toxic"))


def evidence(sample: DataFrame, model: np.ndarray) -> dict[str, float]:
    """Weights (log odds) of the evidence kept; at most ``MOST_EVIDENCE`` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, counts = Restorer(model), ({}, {})
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = counts[toxic]
                for e in {e for word in set(restorer.words(text)) if word for e in evidence_of(word)}:
                    own[e] = own.get(e, 0) + 1
        names = list(counts[1])
        values = [[c.get(e, 0) for e in names] for c in counts]
        yield pa.RecordBatch.from_pydict({"e": pa.array(names, pa.string()), "c": pa.array(values[0], pa.int64()), "t": pa.array(values[1], pa.int64())})
        rest = [e for e in counts[0] if e not in counts[1]]
        yield pa.RecordBatch.from_pydict({"e": pa.array(rest, pa.string()), "c": pa.array([counts[0][e] for e in rest], pa.int64()), "t": pa.array([0] * len(rest), pa.int64())})

    clean, toxic = sample.agg(F.sum(1 - F.col("toxic")), F.sum("toxic")).head()
    if not clean or not toxic:
        return {}
    sums = sample.select("text", "toxic").mapInArrow(run, "e string, c bigint, t bigint").groupBy("e").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))
    weight = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    kept = sums.withColumn("w", weight).filter((F.col("t") >= max(3, LEAST_SHARE * toxic)) & (F.col("w") > 2))
    strongest = kept.orderBy(F.desc(F.col("t") * F.col("w")), "e").limit(MOST_EVIDENCE)
    return {r["e"]: r["w"] for r in strongest.select("e", "w").collect()}



def features_of(df: DataFrame, model: np.ndarray, weights: dict[str, float], *keep: str) -> DataFrame:
    """``features`` of each text, beside the columns to keep, which the text may be among."""
    rows = df.select(*keep) if "text" in keep else df.select(*keep, "text")
    place = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model, weights)
        for batch in slices(batches):
            found = [scorer.features(t or "") for t in batch.column(place).to_pylist()]
            values = pa.array(found, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], values], names=[*keep, "features"])

    return rows.mapInArrow(run, with_fields(df.select(*keep), "features array<double>"))


def scored(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, keep_text: bool = False) -> DataFrame:
    """All columns of ``docs``, the text only if it is to be kept, with ``score`` (0 to 1, in place of a column of
    that name)."""
    model = character_model(docs)
    sample = labelled_sample(docs, labels, rows)
    weights = evidence(sample, model)
    keep = [c for c in docs.columns if c not in ("score", "features") and (keep_text or c != "text")]
    if not weights:
        return docs.select(*keep, F.lit(0.0).alias("score"))
    use_checkpoint_dir(docs.sparkSession)
    learnt = stored(features_of(sample, model, weights, "toxic"))
    train = learnt.select("toxic", array_to_vector("features").alias("features"))
    fitted = LogisticRegression(labelCol="toxic", regParam=1e-3, maxIter=50, standardization=True).fit(train)
    margin = F.lit(float(fitted.intercept))
    for i, c in enumerate(fitted.coefficients.toArray().tolist()):
        margin = margin + F.lit(c) * F.col("features")[i]
    found = features_of(docs, model, weights, *keep)
    return found.select(*keep, (1 / (1 + F.exp(-margin))).alias("score"))
