"""From raw documents to packed training sequences: five stages, each one operator over all that is left.

Every stage but the last returns documents with the columns it was given, and its decisions take effect:

1. ``toxicity`` drops documents whose restored text scores 0.5 or more, learnt from the labels of its folder
   (only the rows that are not held out). Rows without text are clean.
2. ``simhash`` keeps the document that names each component: 3-word shingles, at most 2 differing bits. Rows
   without an id cannot name one and stay; of rows with the same id one a component stays.
3. ``substrings`` takes out words under a 50-word window that a document with a smaller id also has; the words that
   stay are joined by blanks. Texts that lose nothing stay as they are, also their white space.
4. ``pii`` puts the kind in brackets in place of each span of personal data.
5. ``packing`` returns the pieces of all documents in sequences of 2048 tokens, each source by its share.

``n_chars`` follows the text where a stage changes it. Further columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import small_batches, table
from riskloom.llm.pii import fitted, with_spans
from riskloom.llm.queries import packed
from riskloom.llm.simhash import one_of_each
from riskloom.llm.substrings import without_repeats
from riskloom.llm.toxicity import scored
from riskloom.session import stored

TOXIC = 0.5


def _apart(docs: DataFrame) -> DataFrame:
    """The documents with other names for the columns that the operators do not read."""
    return docs.withColumnsRenamed({c: f"column {i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")})


def _back(found: DataFrame, docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The columns of ``docs`` from a result over ``_apart(docs)``, with a new text and its length if there is one."""
    names = {f"column {i}": c for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    if text is not None:
        found = found.withColumn("text", text)
    out = found.select("doc_id", "text", *names).withColumnsRenamed(names)
    if text is not None and "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = scored(_apart(docs), table(spark, sf_dir, "labels"), keep_text=True)
    return _back(found.filter(F.col("score") < TOXIC), docs)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return _back(without_repeats(_apart(docs)), docs, text)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return _back(with_spans(_apart(docs), fitted(docs)), docs, F.col("redacted"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packed(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("simhash", simhash),
    ("substrings", substrings),
    ("pii", pii),
    ("packing", packing),
]
#: Decoding, fitted models and fingerprints have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each but the last written as Parquet and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
