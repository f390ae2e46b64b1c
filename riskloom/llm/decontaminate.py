"""Benchmark decontamination by winnowing: which words of a document stand inside a passage of a benchmark item.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words is one window. For a window of L words,
hashes of k = ceil(L / 2) consecutive words are taken, and of the L - k + 1 of them inside a window the least is its
fingerprint. It depends on the window's words alone, so a window and each of its occurrences have the same one: every
shared passage of L words is found. Neighbouring windows mostly share a fingerprint, so a text is a row of runs:

1. Documents give one row a run: ``print, start, windows``, the hashes of its windows. A semi-join keeps the runs whose
   fingerprint an item has.
2. Those that are left are extended: each window's own hash must be one that goes with the fingerprint in an item.
   Both hashes are of 64 bits, and a window must agree in both.
3. Word positions under such windows are merged to intervals, per document.

Items never meet documents in pairs. Windows with the same set of items are of one class, documents with the same set of
classes have the same items, and these are looked up once a set. Spark sends the items' tables to all tasks where the
stored files are below its own broadcast limit and shuffles them otherwise; each of their keys stands there once, so a
fingerprint that a third of the documents share is a skewed side that adaptive execution may split.

Only SQL functions are used. ``_bound`` gives a computed array a name inside an expression, so that it is computed once.

Defined results: null texts have no words. Words of documents are hit by items without an id too, but these are not
counted or listed; a repeated item id counts once. A window that an item repeats, or that several items share, is one.
Rows of documents are answered one by one, equal ones (and those without an id) alike. Items without words have no
window. No items: nothing is hit. No documents: no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import stored

WINDOW = 10
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before lower-casing, which changes no word's place.
BETWEEN_RAW_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RUN = "struct<span:int,print:bigint,start:int,windows:array<bigint>>"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased and no other letter."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.array_remove(F.split(lowered, BETWEEN_WORDS, -1), "")


def word_count(text: Column) -> Column:
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), BETWEEN_RAW_WORDS, -1)
    return F.size(F.array_remove(parts, ""))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value computed once however often it is used, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def runs_of(words: Column, span: int) -> Column:
    """Runs of windows of ``span`` words with the same fingerprint, as an array of ``RUN``."""
    size = -(-span // 2)
    choice = span - size + 1

    def of_hashes(hashes: Column) -> Column:
        def gram(i: Column) -> Column:
            return F.xxhash64(F.lit(span), *[F.get(hashes, i + j) for j in range(size)])

        return _bound(F.transform(F.sequence(F.lit(0), F.size(hashes) - size), gram), of_grams)

    def of_grams(grams: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(grams) - choice)

        def least(s: Column) -> Column:
            return F.least(*[F.get(grams, s + j) for j in range(choice)]) if choice > 1 else F.get(grams, s)

        def window(s: Column) -> Column:
            # The first and the last hash cover all words, as each is of half of them or more.
            return F.xxhash64(F.get(grams, s), F.get(grams, s + (choice - 1)))

        return _bound(
            F.transform(starts, least),
            lambda prints: _bound(F.transform(starts, window), lambda windows: of_windows(prints, windows)),
        )

    def of_windows(prints: Column, windows: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(prints) - 1)
        firsts = F.filter(places, lambda s: (s == 0) | (F.get(prints, s) != F.get(prints, s - 1)))

        def run(firsts: Column, s: Column, i: Column) -> Column:
            end = F.coalesce(F.get(firsts, i + 1), F.size(prints))
            return F.struct(
                F.lit(span).alias("span"),
                F.get(prints, s).alias("print"),
                s.alias("start"),
                F.slice(windows, s + 1, end - s).alias("windows"),
            )

        return _bound(firsts, lambda found: F.transform(found, lambda s, i: run(found, s, i)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    found = _bound(hashes, lambda h: F.when(F.size(h) >= span, of_hashes(h)))
    return F.coalesce(found, F.array().cast(f"array<{RUN}>"))


def _runs(df: DataFrame, keys: Sequence[str], spans: Sequence[int], own_span: bool) -> DataFrame:
    """One row a run; with ``own_span`` a text has windows of the one length that its word count gives."""

    def each(words: Column) -> Column:
        def of(span: int) -> Column:
            if not own_span:
                return runs_of(words, span)
            fits = F.least(F.size(words), F.lit(WINDOW)) == span
            return F.when(fits, runs_of(words, span)).otherwise(F.array().cast(f"array<{RUN}>"))

        return reduce(lambda a, b: F.concat(a, b), [of(span) for span in spans])

    return df.select(*keys, F.inline(_bound(words_of(F.col("text")), each)))


def _windows(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a window of the runs."""
    spread = runs.select(*keys, "span", "print", "start", F.posexplode("windows").alias("place", "window"))
    return spread.select(*keys, "span", "print", (F.col("start") + F.col("place")).alias("start"), "window")


class Items:
    """What is stored of the benchmark: ``marks`` (a row a window), ``members`` (a row an item of a class)."""

    def __init__(self, items: DataFrame):
        rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
        lengths = rows.select(F.least(word_count(F.col("text")), F.lit(WINDOW)).alias("span"))
        #: Lengths of windows, WINDOW of them at most.
        self.spans = sorted(r.span for r in lengths.filter("span > 0").distinct().collect())
        if not self.spans:
            return
        windows = _windows(_runs(rows, ["item_id"], self.spans, True), ["item_id"])
        per_item = stored(windows.select("span", "print", "window", "item_id").distinct())
        one, other = F.xxhash64("item_id"), F.xxhash64("item_id", F.lit(WINDOW))
        found = per_item.groupBy("span", "print", "window").agg(
            F.xxhash64(F.bit_xor(one), F.bit_xor(other), F.count("item_id")).alias("class")
        )
        self.marks = stored(found)
        # Each class has the items of any of its windows; one of them is read.
        least = F.min(F.struct("span", "print", "window")).alias("of")
        named = self.marks.groupBy("class").agg(least).select("class", "of.*")
        self.members = stored(named.join(per_item, ["span", "print", "window"]).select("class", "item_id"))


def _covered(spans: Column) -> Column:
    """How many places the half-open intervals cover."""
    none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("to"))

    def add(done: Column, next_: Column) -> Column:
        more = F.greatest(F.lit(0), next_["to"] - F.greatest(done["to"], next_["start"]))
        return F.struct((done["n"] + more).alias("n"), F.greatest(done["to"], next_["to"]).alias("to"))

    return F.aggregate(F.array_sort(spans), none, add, lambda done: done["n"])


def contaminated(df: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` (sorted ids as strings) of each row, and ``spans``: the hit windows' words,
    as intervals that may overlap."""
    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # An id may repeat or be missing, so the text's hash stands beside it.
    rows = rows.withColumn("digest", F.xxhash64("text"))
    counted = rows.select("doc_id", "digest", word_count(F.col("text")).cast("bigint").alias("n_words"))
    known = Items(items)
    keys = ["doc_id", "digest"]
    none = F.array().cast("array<string>")
    no_spans = F.array().cast("array<struct<start:int,to:int>>")
    if not known.spans:
        return counted.select("doc_id", "n_words", F.lit(0).cast("bigint").alias("n_hit"), none.alias("items"), no_spans.alias("spans"))
    runs = _runs(rows, keys, known.spans, False)
    likely = runs.join(known.marks.select("print").distinct(), "print", "left_semi")
    hits = _windows(likely, keys).join(known.marks, ["span", "print", "window"])
    interval = F.struct("start", (F.col("start") + F.col("span")).alias("to"))
    per_document = hits.groupBy(*keys).agg(
        F.collect_set(interval).alias("spans"), F.array_sort(F.collect_set("class")).alias("classes")
    )
    found = stored(per_document.withColumn("set", F.xxhash64("classes")))
    sets = found.groupBy("set").agg(F.min("classes").alias("classes")).select("set", F.explode("classes").alias("class"))
    listed = sets.join(known.members, "class").groupBy("set").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    named = found.join(listed, "set").withColumnsRenamed({"doc_id": "hit_id", "digest": "hit_digest"})
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & F.col("digest").eqNullSafe(F.col("hit_digest"))
    return counted.join(named, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.coalesce(F.array_sort("spans"), no_spans).alias("spans"),
    )
