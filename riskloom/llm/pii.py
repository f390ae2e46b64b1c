"""Personal data in whole texts: exact base patterns, and further spans chosen by boosted trees.

Base spans follow four fixed patterns with their checks, leftmost and non-overlapping per kind. They are found in
time linear in the text, also where it has very long runs of digits or letters.

Three generators propose more, widely and overlapping: addresses (also spelled with "at" and "dot"), runs of
digits with any marks between, and long tokens of mixed characters. Trees boosted by Spark ML score each candidate
by its format (counts, runs, check digits, entropy) and context (what stands around it, words before it).
There are no labelled spans, so the trees learn from what is certain: candidates that hold a base span, or a
key behind a word that announces one, are positive, as are copies of them written otherwise (without the
plus sign, with "(at)"); the rest is negative. A third of the candidates, by hash, only serves to calibrate: for each
generator, the threshold is the lowest with a precision of ``PRECISION``. Candidates over it that touch no base span are added,
and so are secrets that hold one whole. Secrets are proposed whole, up to the closing quote or white space behind a key word
and with all parts that dots join, and never inside one another, so no redaction ends inside one that is found.

The trees learn from at most ``TRAIN_CANDIDATES`` candidates of each kind and label, drawn by hash from those of all
texts, so a rare kind is learnt beside millions of others. The thresholds come from the scores of every candidate
of the third, summed in ``BINS`` steps by kind and label. Defined results: null texts are empty and have no spans; no candidates, or of one class only, add nothing; rows
with equal ids are handled each. Offsets are code points.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import SLICE_ROWS, slices, with_fields
from riskloom.llm.files import fresh_folder
from riskloom.session import stored, use_checkpoint_dir

TRAIN_CANDIDATES = 20_000
PRECISION = 0.97
#: Steps of the scores that thresholds are taken from.
BINS = 1 << 16
ROUNDS, DEPTH = 20, 4
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("address", "number", "secret")
ORDER = {kind: i for i, kind in enumerate((*BASE_KINDS, *ADDED_KINDS))}

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def emails(text: str) -> list[Span]:
    """One a sign at most: all starts before a sign share what follows it, so it is tried once."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end(), "email"))
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return found


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then kind as listed."""
    found = emails(text)
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(map(_byte, m[0].split("."))):
            found.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            digits = _digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], ORDER[s[2]], s[1]))


# Candidates

_AT, _DOT = r"\s?[(\[{]\s?at\s?[)\]}]\s?", r"\s?[(\[{]\s?dot\s?[)\]}]\s?|\sdot\s"
#: Each generator's pattern; possessive or bounded repetition keeps them linear.
GENERATORS = {
    "address": re.compile(
        rf"(?<![\w.%+-])[\w.%+-]{{1,64}}+(?:(?:@|{_AT})[\w-]{{1,63}}+(?:(?:\.|{_DOT})[\w-]{{2,63}}+){{1,4}}"
        rf"|\sat\s[\w-]{{1,63}}+(?:(?:{_DOT})[\w-]{{2,63}}+){{1,4}})",
        re.I,
    ),
    "number": re.compile(r"(?<![\w.])[+(]?[0-9](?:[ ().\-/]{0,3}[0-9]){6,24}+(?!\w)"),
    "secret": re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/-]{16,}+={0,2}(?![A-Za-z0-9_+/=-])"),
}
_DIGIT = re.compile(r"[0-9]")
_SPELLED = re.compile(rf"{_AT}|\sdot\s", re.I)
_KEY_WORD = r"(?:pass|pwd|secret|token|key|auth(?!or))[A-Za-z0-9_-]*[\"']?\s{0,2}"
_KEY = re.compile(rf"{_KEY_WORD}\Z", re.I)
_AFTER_KEY = re.compile(rf"{_KEY_WORD}[=:]\s{{0,2}}[\"']?\Z", re.I)
_SEPARATOR = re.compile(r"[=:](?!=|//)\s{0,2}")
_QUOTED = {'"': re.compile(r'(?:[^"\\\n]|\\.)++(?=")'), "'": re.compile(r"(?:[^'\\\n]|\\.)++(?=')")}
_BARE = re.compile(r"\S++")
_SYMBOL = re.compile(r"[0-9!@#$%^&*+=]")
_LETTER = re.compile(r"[A-Za-z]")
_DOTTED = re.compile(r"(?:\.[A-Za-z0-9_+/-]++={0,2})*+")
_TOKEN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+/-=.")
_KEY_VALUE = re.compile(r"([A-Za-z_-]{2,20})=([A-Za-z0-9_+/-]{8,}+)")
_CUES = (
    re.compile(r"mail|contact|write|e-mail", re.I),
    re.compile(r"phone|call|tel|mobile|fax", re.I),
    re.compile(r"card|visa|account|iban|ssn|id\b", re.I),
    re.compile(r"pass|pwd|secret|token|key|auth", re.I),
)


def keyed_secrets(text: str) -> list[Span]:
    """Values behind a word that announces a secret, whole: up to the closing quote, or else up to white space.

    Marks that end a clause do not belong to a value without quotes. Values have at least 8 characters; behind a colon, where
    prose may follow, and with blanks in them (in quotes behind an equals sign only) they hold letters and a digit or symbol too.
    """
    found, at = [], 0
    while m := _SEPARATOR.search(text, at):
        start = at = m.end()
        if not _KEY.search(text, max(0, m.start() - 40), m.start()):
            continue
        quote = _QUOTED.get(text[start : start + 1])
        start += quote is not None
        closed = quote.match(text, start) if quote else None
        value = closed or _BARE.match(text, start)
        if not value:
            continue
        word = value[0] if closed else value[0].rstrip(".,;")
        prose, blanks = text[m.start()] == ":", any(map(str.isspace, word))
        if len(word) < 8 or (blanks and prose):
            continue
        if not (prose or blanks) or (_LETTER.search(word) and _SYMBOL.search(word, 0, len(word) - prose)):
            found.append((start, start + len(word), "secret"))
            at = value.end()
    return found


def tokens(text: str) -> list[Span]:
    """Long tokens of letters and digits, each with the parts that dots join to it."""
    found, at = [], 0
    while m := GENERATORS["secret"].search(text, at):
        start, end = m.span()
        if any(map(str.isdigit, m[0])) and any(map(str.isalpha, m[0])):
            # Back to the last span at most, so that a text is walked through once.
            while start > at and text[start - 1] in _TOKEN_CHARS:
                start -= 1
            while text[start] in ".=":
                start += 1
            end = _DOTTED.match(text, end).end()
            found.append((start, end, "secret"))
        at = end
    return found


def widest(spans: list[Span]) -> list[Span]:
    """Spans that lie in no other one, so that nothing is taken in part."""
    kept, reach = [], -1
    for span in sorted(spans, key=lambda s: (s[0], -s[1])):
        if span[1] > reach:
            kept.append(span)
            reach = span[1]
    return kept


def candidates(text: str) -> list[Span]:
    """All that the generators propose, by place. What a text surely lacks is not looked for."""
    found: set[Span] = set()
    has_digit = bool(_DIGIT.search(text))
    if "@" in text or _SPELLED.search(text):
        found.update((*m.span(), "address") for m in GENERATORS["address"].finditer(text))
    if has_digit:
        found.update((*m.span(), "number") for m in GENERATORS["number"].finditer(text))
    secrets = tokens(text) if has_digit else []
    if "=" in text:
        secrets += [(*m.span(2), "secret") for m in _KEY_VALUE.finditer(text)]
    if "=" in text or ":" in text:
        secrets += keyed_secrets(text)
    found.update(widest(secrets))
    return sorted(found)


def entropy(text: str) -> float:
    counts = Counter(text).values()
    return -sum(n / len(text) * math.log2(n / len(text)) for n in counts)


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format and context of a candidate."""
    word, before, after = text[start:end], text[max(0, start - 24) : start], text[end : end + 1]
    digits = _digits(word)
    groups = re.findall(r"[0-9]+", word)
    letters = [c for c in word if c.isalpha()]
    parts = word.split(".")
    return [
        float(ADDED_KINDS.index(kind)),
        float(len(word)),
        float(len(digits)),
        float(len(letters)),
        float(sum(c.isupper() for c in letters)),
        float(sum(not c.isalnum() for c in word)),
        float(len(groups)),
        float(max(map(len, groups), default=0)),
        float(len(groups[0])) if groups else 0.0,
        float(word.count(".")),
        float("@" in word),
        float(word.startswith("+")),
        float("(" in word),
        float(12 <= len(digits) <= 19 and luhn(digits)),
        float(len(parts) == 4 and all(p.isdigit() and _byte(p) for p in parts)),
        entropy(word),
        sum(c in "0123456789abcdef" for c in word) / len(word),
        float(sum(a.isdigit() != b.isdigit() for a, b in zip(word, word[1:], strict=False))),
        float(before[-1:] in ("=", ":", '"', "'")),
        float(after in ('"', "'")),
        *[float(bool(cue.search(before))) for cue in _CUES],
    ]


FEATURES = 20 + len(_CUES)


class Placed:
    """Spans by place, for finding those that touch a stretch without looking at all of them."""

    def __init__(self, spans: list[Span]):
        self.spans = sorted(spans)
        self.starts = [s for s, _, _ in self.spans]
        self.furthest = list(accumulate((e for _, e, _ in self.spans), max))

    def touching(self, start: int, end: int) -> Iterator[Span]:
        at = bisect_left(self.starts, end) - 1
        # No span up to here ends behind the furthest end.
        while at >= 0 and self.furthest[at] > start:
            if self.spans[at][1] > start:
                yield self.spans[at]
            at -= 1


def certain(text: str, span: Span, base: Placed) -> bool:
    """Whether a candidate surely is what it looks like: it holds most of a base span, or a key says so."""
    start, end, kind = span
    if kind == "secret":
        return bool(_AFTER_KEY.search(text, max(0, start - 40), start))
    fits = ("email",) if kind == "address" else ("ip", "card", "phone")
    found = base.touching(start, end)
    return any(k in fits and min(e, end) - max(s, start) >= 0.8 * (end - start) for s, e, k in found)


def rewritten(text: str, span: Span) -> list[tuple[str, int, int]]:
    """Other ways to write a certain candidate, in its place."""
    start, end, kind = span
    word, out = text[start:end], []
    if kind == "address" and word.count("@") == 1:
        out.append(word.replace("@", " (at) "))
        out.append(word.replace("@", " at ").replace(".", " dot "))
    if kind == "number" and word.startswith("+"):
        bare = word.lstrip("+")
        out.append(bare)
        head, _, rest = bare.partition(" ")
        if len(_digits(rest)) >= 7:
            out.append(rest)
    left, right = text[max(0, start - 24) : start], text[end : end + 1]
    return [(left + w + right, len(left), len(left) + len(w)) for w in out]


def likeliest(scored: list[tuple[float, Span]]) -> list[Span]:
    """Of spans that touch each other the one of the highest score, then the first; best first within a stretch."""
    kept: list[Span] = []
    stretch: list[tuple[float, Span]] = []
    reach = -1
    for score, span in sorted(scored, key=lambda x: x[1]):
        if span[0] >= reach:
            kept += _greedy(stretch)
            stretch = []
        stretch.append((score, span))
        reach = max(reach, span[1])
    return kept + _greedy(stretch)


def _greedy(stretch: list[tuple[float, Span]]) -> list[Span]:
    """Spans kept are apart, so the one before and the one behind a place are all that may touch."""
    kept: list[Span] = []
    for _, span in sorted(stretch, key=lambda x: (-x[0], x[1])):
        at = bisect_left(kept, span)
        if (at == 0 or kept[at - 1][1] <= span[0]) and (at == len(kept) or kept[at][0] >= span[1]):
            kept.insert(at, span)
    return kept


# Trees


class Trees:
    """A fitted ensemble as arrays, for scoring many candidates at once inside a task."""

    def __init__(self, trees: list[list[tuple]], weights: list[float], thresholds: dict[str, float]):
        self.trees = [tuple(np.array(c) for c in zip(*t, strict=True)) for t in trees]
        self.weights, self.thresholds = weights, thresholds

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(rows))
        for (feature, threshold, left, right, value), weight in zip(self.trees, self.weights, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                inner = left[node] >= 0
                goes_left = rows[np.arange(len(rows)), np.maximum(feature[node], 0)] <= threshold[node]
                node = np.where(inner, np.where(goes_left, left[node], right[node]), node)
            margin += weight * value[node]
        return 1 / (1 + np.exp(-2 * margin))

    def chosen(self, text: str, base: list[Span]) -> list[Span]:
        """Candidates over the threshold; of overlapping ones the likeliest, but values behind a key before others.
        Only secrets may touch base spans, namely those that they hold and are wider than."""
        known = Placed(base)
        proposed = [
            c
            for c in candidates(text)
            if all(c[2] == "secret" and c[0] <= s and e <= c[1] and (s, e) != c[:2] for s, e, _ in known.touching(c[0], c[1]))
        ]
        if not proposed:
            return []
        scores = self.probabilities(np.array([features(text, *c) for c in proposed]))
        keyed = set(keyed_secrets(text))
        fine = [(score + (c in keyed), c) for score, c in zip(scores.tolist(), proposed, strict=True) if score >= self.thresholds[c[2]]]
        return likeliest(fine)


def _saved_trees(model, spark, folder: str) -> list[list[tuple]]:
    """Nodes of a fitted ensemble from its saved form; (2 ** DEPTH) * 2 rows a tree at most."""
    model.write().save(folder)
    nodes = spark.read.parquet(f"{folder}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    trees: dict[int, list[tuple]] = {}
    for n in nodes:
        split = n["split"]
        inner = n["leftChild"] >= 0
        trees.setdefault(n["treeID"], []).append(
            (
                split["featureIndex"] if inner else -1,
                split["leftCategoriesOrThreshold"][0] if inner else 0.0,
                n["leftChild"],
                n["rightChild"],
                n["prediction"],
            )
        )
    return [trees[i] for i in sorted(trees)]


def draw_of(doc_id: int | None, text: str, span: Span) -> int:
    """The place of a candidate in the hash order, from 0 to 2**63."""
    start, end, kind = span
    return xxhash.xxh3_64_intdigest(f"{doc_id}:{start}:{kind}:{text[start:end]}") >> 1


def labelled(batch: pa.RecordBatch, held: bool) -> Iterator[tuple[str, int, int, str, Span]]:
    """``kind, label, draw, text, span`` of the candidates of a batch, of the calibration third or of the others."""
    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        base = None
        for span in candidates(text or ""):
            draw = draw_of(doc, text, span)
            if (draw % 3 == 0) == held:
                base = Placed(base_spans(text)) if base is None else base
                yield span[2], int(certain(text, span, base)), draw, text, span


def example_rows(text: str, span: Span, label: int) -> list[list[float]]:
    """Features of a candidate and of its rewritings."""
    rows = [features(text, *span)]
    if label:
        rows += [features(t, s, e, span[2]) for t, s, e in rewritten(text, span)]
    return rows


def _read(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def examples(df: DataFrame, most: int = TRAIN_CANDIDATES) -> DataFrame:
    """Stored ``kind, label, draw, features`` of at most ``most`` candidates of each kind and label (each with its
    rewritings), none of them of the calibration third."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of each kind and label, the ``most`` least draws of the task.
        kept: dict[tuple[str, int], list] = {}
        number = 0
        for batch in slices(batches):
            for kind, label, draw, text, span in labelled(batch, held=False):
                own = kept.setdefault((kind, label), [])
                number += 1
                if len(own) < most:
                    heapq.heappush(own, (-draw, number, np.array(example_rows(text, span, label))))
                elif -draw > own[0][0]:
                    heapq.heapreplace(own, (-draw, number, np.array(example_rows(text, span, label))))
        for (kind, label), own in kept.items():
            for at in range(0, len(own), SLICE_ROWS):
                part = own[at : at + SLICE_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([kind] * len(part), pa.string()),
                        pa.array([label] * len(part), pa.int32()),
                        pa.array([-draw for draw, _, _ in part], pa.int64()),
                        pa.array([rows.tolist() for _, _, rows in part], pa.list_(pa.list_(pa.float64()))),
                    ],
                    names=["kind", "label", "draw", "rows"],
                )

    found = stored(_read(df).mapInArrow(run, "kind string, label int, draw bigint, rows array<array<double>>"))
    drawn = [found.limit(0)]
    # At most two rows a kind.
    for kind, label, count in found.groupBy("kind", "label").count().collect():
        # Draws are uniform: few more than ``most`` are below this one, and only those are sorted.
        below = min(2**63 - 1, int((most + 8 * math.sqrt(most) + 64) / count * 2**63))
        own = found.filter((F.col("kind") == kind) & (F.col("label") == label) & (F.col("draw") <= below))
        drawn.append(own.orderBy("draw", "rows").limit(most))
    return stored(reduce(DataFrame.union, drawn).select("kind", "label", "draw", F.explode("rows").alias("features")))


def score_sums(df: DataFrame, trees: Trees) -> DataFrame:
    """``kind, bin, n, positive``: how many candidates of the calibration third, with rewritings, have a score of
    ``bin / BINS`` or up to a step more; from a score of 0.5 on, as no threshold is lower."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(ADDED_KINDS), BINS + 1), np.int64)
        for batch in slices(batches):
            rows, kinds, labels = [], [], []
            for kind, label, _, text, span in labelled(batch, held=True):
                own = example_rows(text, span, label)
                rows += own
                kinds += [ADDED_KINDS.index(kind)] * len(own)
                labels += [label] * len(own)
            if rows:
                bins = (trees.probabilities(np.array(rows)) * BINS).astype(np.int64)
                np.add.at(sums[0], (kinds, bins), 1)
                np.add.at(sums[1], (kinds, bins), labels)
        kinds, bins = np.nonzero(sums[0][:, BINS // 2 :])
        bins += BINS // 2
        arrays = [pa.array([ADDED_KINDS[k] for k in kinds], pa.string()), *(pa.array(c) for c in (bins, sums[0][kinds, bins], sums[1][kinds, bins]))]
        yield pa.RecordBatch.from_arrays(arrays, names=["kind", "bin", "n", "positive"])

    each = _read(df).mapInArrow(run, "kind string, bin bigint, n bigint, positive bigint")
    return each.groupBy("kind", "bin").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive"))


def fitted(df: DataFrame, most: int = TRAIN_CANDIDATES) -> Trees | None:
    """The trees and calibrated thresholds for the texts of a table; None where nothing can be learnt."""
    spark = df.sparkSession
    train = examples(df, most).select("label", array_to_vector("features").alias("features"))
    if train.select("label").distinct().count() < 2:
        return None
    use_checkpoint_dir(spark)
    classifier = GBTClassifier(labelCol="label", maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=64)
    model = classifier.fit(train)
    trees = Trees(_saved_trees(model, spark, fresh_folder(spark, "trees")), model.treeWeights, {})
    # At most BINS / 2 + 1 rows a kind.
    sums = score_sums(df, trees).collect()
    for kind in ADDED_KINDS:
        own = [r for r in sums if r["kind"] == kind]
        scores, counts, positive = (np.array([r[c] for r in own], float) for c in ("bin", "n", "positive"))
        trees.thresholds[kind] = calibrated(scores / BINS, positive, counts=counts)
    return trees


def calibrated(scores: np.ndarray, labels: np.ndarray, precision: float = PRECISION, counts: np.ndarray | None = None) -> float:
    """The lowest score, of 0.5 or more, from which on up the share of positives is at least the precision;
    over 1 if there is none. With ``counts``, each score stands for so many and ``labels`` says how many are positive."""
    order = np.argsort(-scores, kind="stable")
    ordered = scores[order]
    share = np.cumsum(labels[order]) / (np.arange(1, len(order) + 1) if counts is None else np.cumsum(counts[order]))
    last = np.r_[ordered[1:] != ordered[:-1], True][: len(ordered)]
    good = np.nonzero((share >= precision) & last)[0]
    return max(0.5, float(ordered[good[-1]])) if len(good) else 1.1


def listed(spans: list[Span]) -> str:
    """``kind:start:end`` by start, then kind as listed."""
    ordered = sorted(spans, key=lambda s: (s[0], ORDER[s[2]], s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of its first."""
    out, done, held = [], 0, None
    for start, end, kind in sorted(spans, key=lambda s: (s[0], ORDER[s[2]], s[1])):
        if held and start < held[1]:
            held = (held[0], max(held[1], end), held[2])
            continue
        if held:
            out += [text[done : held[0]], f"[{held[2]}]"]
            done = held[1]
        held = (start, end, kind)
    if held:
        out += [text[done : held[0]], f"[{held[2]}]"]
        done = held[1]
    return "".join(out) + text[done:]


def with_spans(df: DataFrame, trees: Trees | None) -> DataFrame:
    """Every row with ``base`` and ``spans`` (listed) and ``redacted``; columns of these names are replaced."""
    others = [c for c in df.columns if c not in ("text", "base", "spans", "redacted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            base_out, all_out, redacted = [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                base = base_spans(text or "")
                more = trees.chosen(text, base) if text and trees else []
                base_out.append(listed(base))
                all_out.append(listed(base + more))
                redacted.append(redact(text, base + more) if base or more else text)
            arrays = [pa.array(c, pa.string()) for c in (base_out, all_out, redacted)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*others, "text", "base", "spans", "redacted"])

    rows = df.select(*others, F.col("text").cast("string"))
    return rows.mapInArrow(run, with_fields(rows, "base string, spans string, redacted string"))
