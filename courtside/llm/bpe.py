"""Byte-level BPE: ranked merges folded by Spark's higher-order functions, once for each distinct word.

A word (a match of the pattern that splits texts) is a string with one
character for each piece: the character's code point is the piece's rank plus
`BASE`, so the order of characters is the order of ranks. What two neighbours merge
into is looked up in a literal rank map; one step of the fold takes the least of
these (`array_min`), lays it over the leftmost pair that gives it (`overlay`) and looks
up the pairs that it made. The map's keys are all pairs of pieces whose concatenation is a piece.

Words over `BLOCK` bytes are folded block by block, not step by step over the
whole word: a block is merged along with the last few pieces before it, and the
result is taken over if the two pieces at the seam, merged from their bytes,
stay the same two pieces. A sequence of pieces in which this holds for every two
neighbours is the encoding of their concatenation: the first merge across a seam
would also be made with the two pieces alone. Where a seam does not hold, the
word is merged from its start.

Texts. Tasks split texts and keep, for each chunk of texts, the distinct
words and each text's words as places among them. Distinct words of all chunks
are grouped and folded, their ids go back to the chunks as a dictionary each, and
a narrow pass puts the ids of texts together. Only distinct words of chunks are
shuffled, so a frequent word is sent once a chunk; one that is in very
many chunks is folded once for the chunks of each `SALT` tasks, in a group of its own.

Decoding concatenates the pieces of ids (`decode`).
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import read, shared_folder
from courtside.llm.files import filesystem

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Code point of the piece of rank 0; ranks stay below the end of Unicode.
BASE = 0x20000
BUCKETS = 1 << 16
#: Bytes that are folded at once, and the pieces before them that are merged anew.
BLOCK, AGAIN = 64, 8
#: Characters of text in a chunk; a longer text is a chunk of its own.
CHUNK_CHARS = 32_000_000
#: Chunks a task may have (64 billion characters) and words a chunk may have: both and the task's
#: number share 64 bits.
CHUNKS, PLACES = 1 << 11, 1 << 30
#: Tasks whose chunks' occurrences of a word are one group.
SALT = 4096
#: Words whose bytes are put together at once for the digests.
WORDS = 1 << 20


def load(name: str = VOCABULARY) -> tuple[dict[bytes, int], str]:
    """Ranks by piece and the pattern that splits texts."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, public_tokenizers.PATTERN


class Ranks:
    """Literals of a vocabulary, which must have all single bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        piece = {k: chr(BASE + r) for k, r in ranks.items()}
        buckets: list[dict[str, str]] = [{} for _ in range(BUCKETS)]
        for k, merged in piece.items():
            for i in range(1, len(k)):
                if (a := piece.get(k[:i])) and (b := piece.get(k[i:])):
                    buckets[zlib.crc32((a + b).encode()) % BUCKETS][a + b] = merged
        text = [""] * (max(ranks.values()) + 1)
        for k, r in ranks.items():
            text[r] = k.hex()
        # from_json of a literal is itself evaluated once, when the plan is made
        self.maps = F.from_json(F.lit(json.dumps(buckets, ensure_ascii=False)), "array<map<string,string>>")
        self.hexes = F.from_json(F.lit(json.dumps(text)), "array<string>")
        self.byte_pieces = "".join(piece[bytes([i])] for i in range(256))


def _let(value: Column, body) -> Column:
    """``body`` of a variable that stands for ``value`` (so that its expression is there once)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _merged(maps: Column, s: Column) -> Column:
    """Pieces ``s`` merged by rank, leftmost first, until no two merge.

    The state holds the pieces and what each two neighbours merge into (null: nothing); a step
    looks up only the two pairs that it changes.
    """
    def pair(s: Column, i: Column) -> Column:
        p = F.substring(s, i, F.lit(2))
        return F.element_at(F.get(maps, (F.crc32(p) % BUCKETS).cast("int")), p)

    def state(s: Column, found: Column) -> Column:
        return F.named_struct(F.lit("s"), s, F.lit("found"), found)

    def step(now: Column, _) -> Column:
        s, found = now["s"], now["found"]

        def put(i: Column) -> Column:
            new = F.overlay(s, F.get(found, i - 1), i, F.lit(2))
            left = F.when(i > 1, F.array(pair(new, i - 1))).otherwise(none)
            right = F.when(i < F.length(new), F.array(pair(new, i))).otherwise(none)
            return F.when(i.isNull(), now).otherwise(state(new, F.concat(
                F.slice(found, F.lit(1), F.greatest(i - 2, F.lit(0))), left, right,
                F.slice(found, i + 2, F.size(found)))))

        return _let(F.array_position(found, F.array_min(found)).cast("int"), put)

    none = F.array().cast("array<string>")
    steps = F.when(F.length(s) > 1, F.sequence(F.lit(1), F.length(s) - 1)).otherwise(F.array().cast("array<int>"))
    pairs = state(s, F.transform(steps, lambda i: pair(s, i)))
    return F.aggregate(steps, pairs, step, lambda now: now["s"])


def _rank(piece: Column) -> Column:
    return F.ascii(piece) - BASE


def _characters(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.substring(s, i, F.lit(1)))
                  ).otherwise(F.array().cast("array<string>"))


def encode_word(ranks: Ranks, word: Column) -> Column:
    """Pieces of ``word`` (binary), one character each."""
    # byte_pieces as the translation of the 256 characters that stand for bytes in ISO 8859-1
    units = F.translate(F.decode(word, "ISO-8859-1"), "".join(map(chr, range(256))), ranks.byte_pieces)

    def bound(maps: Column, hexes: Column) -> Column:

        def size(s: Column) -> Column:
            """Bytes of pieces."""
            return F.aggregate(_characters(s), F.lit(0), lambda n, c: n + F.shiftright(F.length(F.get(hexes, _rank(c))), 1))

        def longer(s: Column) -> Column:
            def add(done: Column, k: Column) -> Column:
                start = k * BLOCK                                  # bytes merged so far
                keep = F.greatest(F.length(done) - AGAIN, F.lit(0))
                before = F.substring(done, F.lit(1), keep)
                from_ = start - size(F.substring(done, keep + 1, F.lit(AGAIN)))
                window = F.substring(s, from_ + 1, start - from_ + BLOCK)

                def join(new: Column) -> Column:
                    last = F.substring(before, F.lit(-1), F.lit(1))
                    first = F.substring(new, F.lit(1), F.lit(1))
                    seam = F.substring(s, from_ - size(last) + 1, size(last) + size(first))
                    return F.when((keep == 0) | (_merged(maps, seam) == F.concat(last, first)),
                                  F.concat(before, new)).otherwise(
                        _merged(maps, F.substring(s, F.lit(1), start + BLOCK)))

                return _let(_merged(maps, window), join)

            blocks = F.sequence(F.lit(0), F.floor((F.length(s) - 1) / BLOCK).cast("int"))
            return F.aggregate(blocks, F.lit(""), add)

        return _let(units, lambda s: F.when(F.length(s) <= BLOCK, _merged(maps, s)).otherwise(longer(s)))

    return _let(ranks.maps, lambda maps: _let(ranks.hexes, lambda hexes: bound(maps, hexes)))


def decode(ranks: Ranks, ids: Column) -> Column:
    """The bytes of an array of ids: their pieces, one after the other."""
    return _let(ranks.hexes, lambda hexes: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(hexes, i)), "")))


CHUNK = "docs array<bigint>, sizes array<int>, codes binary, words array<string>"


def _planes(codes: np.ndarray) -> bytes:
    """The first bytes of all codes, then the second ones, ...: they pack better than whole codes."""
    return np.ascontiguousarray(codes.view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def _places() -> defaultdict[str, int]:
    """Places of words in the order in which they come."""
    places: defaultdict[str, int] = defaultdict()
    places.default_factory = places.__len__
    return places


def _written(df: DataFrame, name: str, by: str | None = None) -> str:
    """``df`` written as zstd Parquet below the shared folder; its shuffle files go once it is there."""
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    folder, before = shared_folder(spark, name), spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(folder)
    finally:
        spark.conf.set(key, before)
    return folder


def chunks(docs: DataFrame, pattern: str) -> DataFrame:
    """Chunks of texts: row numbers, words of each, and all their words as places among the distinct ones.

    ``docs``: a row number and a text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern).findall
        places, numbers, codes, held = _places(), [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal places, held
            sizes = [len(c) for c in codes]
            packed = zstandard.ZstdCompressor(level=3).compress(_planes(np.concatenate(codes)))
            words = pa.array(list(places), pa.string())
            row = pa.RecordBatch.from_arrays(
                [pa.array([numbers], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
                 pa.array([packed], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)],
                names=["docs", "sizes", "codes", "words"])
            places, held = _places(), 0
            numbers.clear()
            codes.clear()
            return row

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for number, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    text = text or ""
                    if held and held + len(text) > CHUNK_CHARS:
                        yield flush()
                    words = split(text)
                    numbers.append(number)
                    codes.append(np.fromiter(map(places.__getitem__, words), np.uint32, len(words)))
                    held += len(text)
        if numbers:
            yield flush()

    number = F.monotonically_increasing_id()  # the task's number above 33 bits of the chunk's place in it
    place = number.bitwiseAND(F.lit((1 << 33) - 1))
    known = F.when(place < CHUNKS, F.shiftright(number, 33) * CHUNKS + place).otherwise(
        F.raise_error(F.lit(f"a task has over {CHUNKS} chunks of text")).cast("bigint"))
    return docs.mapInArrow(run, CHUNK).withColumn("chunk", known)


def encoded_words(chunked: DataFrame, ranks: Ranks) -> DataFrame:
    """pieces, at: words, encoded, and where they are; each of ``at`` holds a chunk and the word's place in it."""
    words = chunked.select(F.posexplode("words").alias("pos", "word"), "chunk")
    words = words.select("word", (F.col("chunk") * PLACES + F.col("pos")).alias("at"),
                         F.floor(F.col("chunk") / (CHUNKS * SALT)).alias("_salt"))
    found = words.groupBy("word", "_salt").agg(F.collect_list("at").alias("at"))
    return found.select(encode_word(ranks, F.encode("word", "UTF-8")).alias("pieces"), "at")


ENCODED = {
    "ids": "n bigint, n_tokens bigint, ids array<int>",
    "digests": "n bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
}


def _joined(tokens: pa.LargeBinaryArray, ids: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """For each word, whose ids end at ``ends`` in ``ids``, the values of its ids in ``tokens``, one after the other."""
    flat = tokens.take(pa.array(ids))
    cuts = np.frombuffer(flat.buffers()[1], np.int64)[ends]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(cuts), flat.buffers()[2]])


def _hashed(parts: pa.LargeBinaryArray, codes: np.ndarray, ends: np.ndarray, skip: int) -> list[str]:
    """SHA-256 of each text: the parts that its codes name, joined, without the first ``skip`` bytes."""
    hashes = [hashlib.sha256() for _ in ends[1:]]
    for low in range(int(ends[0]), int(ends[-1]), WORDS):
        high = min(low + WORDS, int(ends[-1]))
        taken = parts.take(pa.array(codes[low:high]))
        cuts, data = np.frombuffer(taken.buffers()[1], np.int64), memoryview(taken.buffers()[2])
        first, last = np.searchsorted(ends, low, "right") - 1, np.searchsorted(ends, high, "left")
        for i in range(first, last):
            begins = ends[i] >= low
            begin, end = cuts[max(ends[i], low) - low], cuts[min(ends[i + 1], high) - low]
            if end > begin:
                hashes[i].update(data[begin + skip * begins:end])
    return [h.hexdigest() for h in hashes]


def _assemble(chunked: DataFrame, folder: str, pieces: list[bytes], out: str) -> DataFrame:
    """Ids of the texts of each chunk, whose dictionary lies below ``folder``."""
    shared = chunked.sparkSession.sparkContext.broadcast(pieces)  # a vocabulary: a fixed size

    def dictionary(chunk: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a chunk's words, one word after the other, and where each word begins and the last one ends."""
        import pyarrow.parquet as pq

        if not n_words:
            return np.empty(0, np.int32), np.zeros(1, np.int64)
        store, path = filesystem(folder)
        t = pq.read_table(f"{path}/chunk={chunk}", filesystem=store, columns=["pos", "pieces"], partitioning=None)
        pos = t.column("pos").to_numpy()
        order = np.argsort(pos, kind="stable")
        if not np.array_equal(pos[order], np.arange(n_words)) or t.column("pieces").null_count:
            raise RuntimeError(f"chunk {chunk}: its dictionary is not whole")
        strings = t.column("pieces").cast(pa.large_string()).combine_chunks().take(pa.array(order))
        cuts = np.frombuffer(strings.buffers()[1], np.int64)
        flat = str(memoryview(strings.buffers()[2])[cuts[0]:cuts[n_words]], "utf-8")
        ids = (np.frombuffer(flat.encode("utf-32-le"), np.uint32) - np.uint32(BASE)).astype(np.int32)
        return ids, np.concatenate([[0], np.cumsum(pc.utf8_length(strings).to_numpy(), dtype=np.int64)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if out == "digests":
            decimals = pa.array([b",%d" % i for i in range(len(shared.value))], pa.large_binary())
            decoded = pa.array(shared.value, pa.large_binary())
        for batch in batches:
            for row in batch.to_pylist():
                ids, words = dictionary(row["chunk"], row["n_words"])
                codes = _unplanes(zstandard.ZstdDecompressor().decompress(row["codes"]))
                numbers, ends = row["docs"], np.concatenate([[0], np.cumsum(row["sizes"], dtype=np.int64)])
                if out == "digests":
                    written = [(_joined(decimals, ids, words), 1), (_joined(decoded, ids, words), 0)]
                else:
                    lists = pa.LargeListArray.from_arrays(pa.array(words), pa.array(ids))
                count = np.diff(words)
                for at in range(0, len(numbers), 500):
                    of = ends[at:at + 501]
                    tokens = np.concatenate([[0], np.cumsum(count[codes[of[0]:of[-1]]])])[of - of[0]]
                    columns = [pa.array(numbers[at:at + 500], pa.int64()), pa.array(np.diff(tokens), pa.int64())]
                    if out == "digests":
                        columns += [pa.array(_hashed(parts, codes, of, skip), pa.string()) for parts, skip in written]
                        names = ["n", "n_tokens", "ids_sha256", "decoded_sha256"]
                    else:
                        taken = lists.take(pa.array(codes[of[0]:of[-1]])).flatten()
                        columns.append(pa.ListArray.from_arrays(pa.array(tokens, pa.int32()), taken))
                        names = ["n", "n_tokens", "ids"]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return chunked.select("chunk", "docs", "sizes", "codes", F.size("words").alias("n_words")) \
        .mapInArrow(run, ENCODED[out])


def encode_documents(docs: DataFrame, vocabulary: tuple[dict[bytes, int], str] | None = None,
                     key: str = "doc_id", out: str = "ids") -> DataFrame:
    """``key`` (a long), n_tokens and ids (or, with ``out="digests"``, ids_sha256 and decoded_sha256) of each row.

    Texts are split by the pattern and encoded as the rank file's own library
    would, without special tokens. Defined cases: a null or empty text has no
    ids; repeated rows and null keys are encoded row by row; a word of any
    length is encoded whole; an empty table gives no rows; other columns are not read.
    """
    table, pattern = vocabulary or load()
    ranks = Ranks(table)
    spark = docs.sparkSession
    texts = docs.select(F.col(key).cast("bigint").alias("n"), "text")
    chunked = chunks(texts, pattern)
    chunked = spark.read.schema(chunked.schema).parquet(_written(chunked, "bpe-chunks"))
    words = encoded_words(chunked, ranks)
    words = spark.read.schema(words.schema).parquet(_written(words, "bpe-words"))
    words = words.select("pieces", F.explode("at").alias("at")).repartition(F.shiftright("at", 30)).select(
        F.shiftright("at", 30).alias("chunk"), (F.col("at") % PLACES).cast("int").alias("pos"), "pieces")
    folder = _written(words.sortWithinPartitions("chunk", "pos"), "bpe-dictionaries", by="chunk")
    pieces = [b""] * (max(table.values()) + 1)
    for k, r in table.items():
        pieces[r] = k
    return _assemble(chunked, folder, pieces, out).withColumnRenamed("n", key)


def op13_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_documents(read(spark, sf_dir, "documents"), out="digests")
