"""Benchmark decontamination: a prefix-filtered join of item windows against documents.

An item's windows are its runs of 13 consecutive words (a shorter item is one
window). A window occurs in a document where all its words stand in order, so
a containment of 1 is asked for, and the necessary prefix of a window, its
words ordered by rarity in the corpus, is its rarest word alone. Only places
in documents that hold the rarest word of some window are looked at:

1. one scan counts the benchmark's words over all documents (map-side
   combined, one row a word); a window with a word that no document has is
   dropped, as it occurs nowhere;
2. one scan joins document words with the index (rarest word -> window and the
   word's offset in it). The offset fixes where the window would start; the
   start and the end must lie inside the document (positional and length
   bounds), and the words there must be the window's, exactly.

The index is broadcast in blocks of at most ``BROADCAST_BYTES``; a benchmark
of any size takes more blocks. Document words are exploded inside one
generated-code stage and leave it only where a window is verified, so no
document word is ever shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import BROADCAST_BYTES, fold, keys_to_join, read, same, written

WINDOW = 13
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def framed_words(text: Column) -> Column:
    """The words of ``text`` between two empty strings (a null text has no words)."""
    framed = F.concat(F.lit(" "), fold(F.coalesce(text, F.lit(""))), F.lit(" "))
    return F.split(framed, NOT_A_WORD)


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, words of one window) for every window of every item."""
    words = benchmark.select(F.col("item_id").cast("string").alias("item_id"),
                             framed_words(F.col("text")).alias("w"),
                             ).select("item_id", "w", (F.size("w") - 2).alias("n"))
    n = F.least("n", F.lit(window))
    return (words.where("n > 0")
            .select("item_id", "w", n.alias("n"), F.explode(F.sequence(F.lit(2), F.col("n") - n + 2))
                    .alias("at"))
            .select("item_id", F.slice("w", F.col("at"), F.col("n")).alias("window")))


def _word_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """How often the words of ``vocabulary`` (hashes, h) stand in all documents."""
    tokens = docs.select(F.explode(framed_words(F.col("text"))).alias("t")).select(
        F.xxhash64("t").alias("h"))
    return tokens.join(vocabulary, "h").groupBy("h").agg(F.count(F.lit(1)).alias("freq"))


def _blocks(index: DataFrame, bytes_col: str, key: str) -> int:
    total = index.agg(F.sum(bytes_col)).first()[0] or 0
    return max(1, math.ceil(total / BROADCAST_BYTES))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, text_hash, n_words, n_hit, items (sorted item ids as strings).

    Defined cases: a null or empty text has no words and no hits, a null or
    empty item no windows; an item without an id marks words but is not
    listed; an empty benchmark hits nothing; documents are told apart by
    (doc_id, hash of the text), so repeated rows each get their (equal) row
    and rows that share an id but not a text are judged alone. Null ids are
    compared null-safe. Other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    pairs = written(item_windows(benchmark, window).distinct(), "bench-pairs")
    windows = written(pairs.select("window").distinct().select(
        F.monotonically_increasing_id().alias("win"), "window",
        F.size("window").alias("n"),
        (F.octet_length(F.array_join("window", " ")) + 64).alias("bytes")), "bench-windows")

    vocabulary = written(windows.select(F.explode("window").alias("t"))
                         .select(F.xxhash64("t").alias("h")).distinct(), "bench-words")
    n_words = max(1, vocabulary.count())
    parts = max(1, math.ceil(n_words * 16 / BROADCAST_BYTES))
    counts = None
    for p in range(parts):
        part = vocabulary.where(F.pmod("h", F.lit(parts)) == p)
        c = _word_counts(docs, F.broadcast(part))
        counts = c if counts is None else counts.unionByName(c)
    counts = written(counts, "bench-freq")

    # the rarest word of each window; a window with an unseen word occurs nowhere
    ranked = (windows.select("win", "n", F.posexplode("window").alias("offset", "t"))
              .select("win", "n", "offset", F.xxhash64("t").alias("h"))
              .join(counts, "h")
              .groupBy("win").agg(F.min(F.struct("freq", "h", "offset")).alias("rarest"),
                                  F.count(F.lit(1)).alias("seen")))
    index = written(windows.join(ranked, "win").where("seen = n").select(
        F.col("rarest.h").alias("h"), F.col("rarest.offset").alias("offset"), "win", "n", "window",
        "bytes"), "bench-index")

    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        framed_words(F.col("text")).alias("w"))
    tokens = words.select("doc_id", "text_hash", "w", F.posexplode("w").alias("pos", "t")).select(
        "doc_id", "text_hash", "w", "pos", F.xxhash64("t").alias("h"))
    # every document starts with an empty string, which is no word: that place gives its own row
    spark = docs.sparkSession
    itself = spark.range(1).select(F.xxhash64(F.lit("")).alias("h"), *[
        F.lit(None).cast(index.schema[c].dataType).alias(c) for c in ("offset", "win", "n", "window")])
    start = F.col("pos") - F.col("offset")  # the place in w of the window's first word
    occurs = ((start >= 1) & (start + F.col("n") <= F.size("w") - 1)
              & (F.slice("w", start + 1, F.col("n")) == F.col("window")))
    blocks = _blocks(index, "bytes", "win")
    found = None
    for b in range(blocks):
        block = index.where(F.pmod("win", F.lit(blocks)) == b).drop("bytes")
        block = block.unionByName(itself) if b == 0 else block
        part = (tokens.join(F.broadcast(block), "h")
                .where(F.when(F.col("win").isNull(), F.col("pos") == 0).otherwise(occurs))
                .select("doc_id", "text_hash", "win", start.alias("start"),
                        (start + F.col("n")).alias("end"),
                        F.when(F.col("win").isNull(), (F.size("w") - 2).cast("bigint")).alias("n_words")))
        found = part if found is None else found.unionByName(part)
    found = written(found, "bench-found")

    rows = found.where(F.col("win").isNull()).select("doc_id", "text_hash", "n_words")
    keys = ["doc_id", "text_hash"]
    hits = found.where(F.col("win").isNotNull())
    # covered words of a document's occurrences: a sweep over at most n_words starts
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "end"))),
        F.struct(F.lit(0).alias("reach"), F.lit(0).cast("bigint").alias("n")),
        lambda a, x: F.struct(
            F.greatest(a["reach"], x["end"]).alias("reach"),
            (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["reach"], x["start"]))).alias("n")),
        lambda a: a["n"])
    per_doc = hits.groupBy(*keys).agg(covered.alias("n_hit"))
    by_window = pairs.join(windows.select("win", "window"), "window").select("win", "item_id")
    items = (hits.select(*keys, "win").distinct().join(by_window, "win")
             .groupBy(*keys).agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    out = rows.join(per_doc, same(rows, per_doc, keys), "left").select(
        rows["*"], per_doc["n_hit"])
    return out.join(items, same(out, items, keys), "left").select(
        out["doc_id"], out["text_hash"], "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        is_contaminated().alias("contaminated"))


def decontaminate_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    found = contamination(docs, read(spark, sf_dir, "benchmark"))
    bad = written(found.where(is_contaminated()).select("doc_id", "text_hash").distinct(), "bench-bad")
    bad = keys_to_join(bad)  # else Spark, which can't tell how few they are, shuffles all texts
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["doc_id"])
                     & (F.xxhash64(docs["text"]) == bad["text_hash"]), "left_anti")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

SQL = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 13) AS n FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g
        FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS s FROM sized)),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
place AS (SELECT doc_id, w, n, s
          FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
                FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, s, place.n, item_id
        FROM place JOIN win ON win.n = place.n
         AND win.g = array_to_string(list_slice(w, s, s + place.n - 1), ' ')),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
