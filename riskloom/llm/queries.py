"""The operators of this package as queries over whole tables, and SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.bpe import decoded, encoded
from riskloom.llm.codes import read_coded, write_coded
from riskloom.llm.common import table
from riskloom.llm.decontaminate import contaminated
from riskloom.llm.negatives import hard_negatives
from riskloom.llm.packing import pack
from riskloom.llm.pii import BASE_KINDS, fitted, with_spans
from riskloom.llm.simhash import near_duplicates
from riskloom.llm.substrings import without_repeats
from riskloom.llm.topk import top_k
from riskloom.llm.toxicity import held_out, scored
from riskloom.llm.variants import spelling_variants
from riskloom.llm.warc import read_archives, write_archives
from riskloom.llm.winnowing import compared_with_next

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


@registered
def op1_toxicity_channel(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = scored(docs, table(spark, folder, "labels"))
    return found.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@registered
def op2_histogram_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


SQL["op2_histogram_topk"] = """
    WITH v AS (
        SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum([p[1] * p[2] for p in list_zip(q.e, c.e)]) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id
        WHERE q.vec_id % 100 = 0
    ), r AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@registered
def op3_bpe_tree(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ids = encoded(table(spark, folder, "documents").select("doc_id", "text"), vocabulary, pattern)
    back = decoded(ids, vocabulary, pattern)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@registered
def op4_warc_packages(spark: SparkSession, folder: str) -> DataFrame:
    back = read_archives(write_archives(table(spark, folder, "pages")))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op4_warc_packages"] = """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
    ), d AS (
        SELECT *, sha256(html) AS digest,
               CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first
        FROM p
    )
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
           CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first <> page_id THEN first END AS refers_to
    FROM d
"""


@registered
def op5_token_codes(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    files = write_coded(table(spark, folder, "documents"), vocabulary, end_id=2)
    return read_coded(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@registered
def op6_mixture_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)
    digest = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", digest, "doc_tokens", "sequence_id", "offset")


@registered
def op7_block_anchors(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", digest)


SQL["op7_block_anchors"] = r"""
    WITH w AS (
        SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p, len(words) AS n
        FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents)
    ), win AS (
        SELECT doc_id, p, n, sha256(string_agg(word, ' ') OVER (
                   PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS h
        FROM w
    ), least AS (
        SELECT h, min(doc_id) AS first FROM win WHERE p + 49 <= n GROUP BY h
    ), gone AS (
        SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p
        FROM win JOIN least USING (h) WHERE p + 49 <= n AND first < doc_id
    ), kept AS (
        SELECT w.doc_id, count(*) AS n_words, count(gone.p) AS n_removed,
               string_agg(word, ' ' ORDER BY w.p) FILTER (gone.p IS NULL) AS text
        FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.p = gone.p GROUP BY w.doc_id
    )
    SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM documents d LEFT JOIN kept USING (doc_id)
"""


@registered
def op8_pii_boosting(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = with_spans(docs, fitted(docs))
    counts = [F.regexp_count("base", F.lit(f"{k}:")).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


@registered
def op9_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return compared_with_next(table(spark, folder, "documents"))


@registered
def op10_simhash_pivots(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    hex_digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", hex_digits, "component_id")


@registered
def op11_residue_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, moved)


SQL["op11_residue_negatives"] = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    ), s AS (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
               CAST(list_sum([p[1] * p[2] for p in list_zip(a.e, c.e)]) AS BIGINT) AS score
        FROM v a JOIN v c ON a.vec_id <> c.vec_id
        WHERE a.vec_id % 100 = 0
    ), p AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same
        ) WHERE place <= 5
    ), n AS (
        SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score,
               s.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
         AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
    )
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM n WHERE rank <= 10
"""


@registered
def op12_bloom_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))


SQL["op12_bloom_variants"] = r"""
    WITH RECURSIVE crc AS (
        SELECT list(c ORDER BY i) AS t FROM (
            SELECT i, list_reduce([i] || range(8), lambda c, k:
                       CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
            FROM (SELECT unnest(range(256)) AS i)
        )
    ), runs AS (
        SELECT doc_id, run, count(*) AS n FROM (
            SELECT doc_id, unnest(regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[a-z\x{C0}-\x{FF}]+')) AS run
            FROM documents
        ) WHERE length(run) >= 7 GROUP BY ALL
    ), bytes AS (
        SELECT doc_id, run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs
    ), hashed AS (
        SELECT run, n, xor(4294967295, list_reduce(
                   [4294967295] || [CAST('0x' || h[2 * k - 1:2 * k] AS BIGINT) for k in range(1, len(h) // 2 + 1)],
                   lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]))) AS h
        FROM bytes, crc
    ), vocabulary AS (
        SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
            SELECT n, CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word
            FROM hashed
        ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
    ), less AS (
        SELECT word, n, p, word[:p - 1] || word[p + 1:] AS part
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM vocabulary)
    ), near AS (
        SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.p = b.p AND a.part = b.part AND a.word <> b.word
        UNION SELECT a.word, b.word, b.n FROM less a JOIN vocabulary b ON a.part = b.word
        UNION SELECT b.word, a.word, a.n FROM less a JOIN vocabulary b ON a.part = b.word
    ), best AS (
        SELECT word, count(*) AS n_near, max(n) AS most, min(other) FILTER (n = m) AS first
        FROM (SELECT *, max(n) OVER (PARTITION BY word) AS m FROM near) GROUP BY word
    ), formed AS (
        SELECT v.word, CASE WHEN most >= 10 * v.n THEN first END AS form, v.n, coalesce(n_near, 0) AS n_near,
               CASE WHEN most >= 10 * v.n THEN most END AS form_n
        FROM vocabulary v LEFT JOIN best USING (word)
    ), walk AS (
        SELECT word, word AS stop FROM formed
        UNION ALL SELECT walk.word, form FROM walk JOIN formed ON walk.stop = formed.word WHERE form IS NOT NULL
    )
    SELECT formed.word, formed.form, ends.stop AS root, formed.n, formed.n_near, formed.form_n
    FROM formed JOIN (SELECT walk.word, stop FROM walk JOIN formed f ON walk.stop = f.word WHERE f.form IS NULL) ends
      ON formed.word = ends.word
"""


@registered
def op13_winnowed_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL["op13_winnowed_decontamination"] = r"""
    WITH d AS (
        SELECT doc_id, row_number() OVER () AS r, translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents
    ), dw AS (
        SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS p, len(words) AS n
        FROM (SELECT r, regexp_extract_all(low, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM d)
    ), i AS (
        SELECT item_id, row_number() OVER () AS r, translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM benchmark
    ), iw AS (
        SELECT item_id, r, unnest(words) AS word, generate_subscripts(words, 1) AS p, len(words) AS n,
               least(len(words), 10) AS span
        FROM (SELECT item_id, r, regexp_extract_all(low, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM i)
    ), ig AS (
        SELECT item_id, p, n, span, string_agg(word, ' ') OVER (
                   PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS g
        FROM iw
    ), marks AS (
        SELECT DISTINCT span, g, item_id FROM ig WHERE p + span - 1 <= n
    ), dg AS (
        SELECT r, p, n, span, string_agg(word, ' ') OVER (
                   PARTITION BY r, span ORDER BY p ROWS BETWEEN CURRENT ROW AND span - 1 FOLLOWING) AS g
        FROM dw CROSS JOIN (SELECT DISTINCT span FROM marks)
    ), hits AS (
        SELECT r, p, span, item_id FROM dg JOIN marks USING (span, g) WHERE p + span - 1 <= n
    ), words AS (
        SELECT r, count(*) AS n_words FROM dw GROUP BY r
    ), cover AS (
        SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + span)) AS q FROM hits) GROUP BY r
    ), listed AS (
        SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
    )
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (r) LEFT JOIN cover USING (r) LEFT JOIN listed USING (r)
"""
