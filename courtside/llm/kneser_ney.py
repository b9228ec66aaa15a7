"""Interpolated modified Kneser-Ney language model of any order from 2, counted in Spark.

Vocabulary. Each task sends the distinct word hashes of its training texts and
their counts to the shards, ranges of hashes. A shard ranks its words by falling count
and writes them as a sorted array; a word's id is its rank times the number of
shards plus its shard, so frequent words have small ids and pack well.

Counting. Each task packs the n-grams of its training texts (each text after
order - 1 start tokens) as ids into blocks, one for each shard of the key space: a
bigram's 64-bit key is a mix of its words' ids, a longer one's of its
prefix's key and its last word. Bigrams are dealt by their own key, so a
hot word's are spread over all shards, longer ones by their prefix, so all that
follows one context meets. A shard's blocks are merged and written as a sorted
array of keys and counts below spark.checkpoint.dir; from it follow the blocks
of the next shorter n-grams, down to single words: in how many n-grams each is the
suffix (its continuation count, which takes the place of its count below the highest
order), and as a context the sum of the counts that follow and how many are 1,
2, 3 and more. Of contexts followed by one n-gram of count 1, all but those of
a start token, nothing is kept: every known n-gram is such a context unless
other figures are stored, but for those that end a text, which no token follows.

Disk. Blocks of shorter n-grams are written before they are merged, and the shuffle
files of each write go once it is there. They are shuffled and merged in `PASSES` parts
of the shards, so the shuffle files of one part only lie beside them at a time.

Model. With the discounts D1, D2, D3+ of the count-of-counts n1..n4 of each
order, h the words before w and h' those without the first,

    p(w | h) = max(c(hw) - D(c(hw)), 0) / c(h.) + gamma(h) p(w | h')
    gamma(h) = (D1 N1(h.) + D2 N2(h.) + D3 N3+(h.)) / c(h.)
    p1(w)    = max(N1+(.w) - E(N1+(.w)), 0) / N1+(..) + g0 / (V + 1)

with p(w | h) = p(w | h') for an unknown h, where E and g0 are the discounts
and their mass for the words' continuation counts and V + 1 counts the distinct
training tokens and one unknown token.

Scoring. Workers memory-map the sorted arrays and look the tokens of whole
texts up by binary search; nothing but the documents is shuffled or sent.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import read, shared_folder, written_alone
from courtside.llm.files import filesystem, memory_map
from courtside.llm.setsketch import scramble

START, END = b"\x20s", b"\x20e"   # no word holds a blank
#: Tokens a task gathers before it packs them (bounds a worker's memory).
GATHER = 3_000_000
#: Characters of texts that are split at once.
SPLIT = 3_000_000
#: Bytes of texts for each shard of n-grams.
SHARD_BYTES = 24 << 20
#: Parts in which blocks of shorter n-grams are shuffled and merged.
PASSES = 3
#: Words of the registered model's longest n-grams.
ORDER = 3
#: Stands for every word that the training texts don't have; far from any id, as are its multiples.
UNKNOWN = np.uint64(0x9FB21C651E98DF25)

P, Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd, so that products lose nothing
S32 = np.uint64(32)


def pair_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    k = (v * P + w) * Q
    return (k ^ (k >> S32)) * Q


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z only), split at ASCII white space, and the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


HASHES = np.array([xxhash.xxh3_64_intdigest(x) for x in (START, END)], np.uint64)


def coded(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`tokens` of all texts after order - 1 start tokens each: hashes, the run of places among them, tokens of each.

    START is at place 0, END at 1.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    real = np.concatenate([[0], np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False) > 0)])
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    sizes = np.diff(real[ends], prepend=0)  # blanks at either end of a text leave empty pieces
    words = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
    distinct = words.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    place = words.indices.to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes + order) - sizes - 1  # a text's first token
    run = np.zeros(len(place) + order * len(sizes), np.int32)
    run[starts + sizes] = 1
    run[np.arange(len(place)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)] = place + 2
    return np.concatenate([HASHES, hashes]), run, sizes + 1


def slices(texts: pa.Array, bound: int = SPLIT) -> Iterator[pa.Array]:
    """Consecutive texts of about ``bound`` bytes, a longer text by itself."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes) - sizes) // bound
    cut = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for a, b in zip(cut, cut[1:]):
        if b > a:
            yield texts.slice(a, b - a)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of keys."""
    return ((keys >> S32) * np.uint64(shards) >> S32).astype(np.int64)


def gram_keys(words: list[np.ndarray]) -> np.ndarray:
    """Keys of n-grams given as a column of ids for each place; of single words their ids."""
    key = words[0].astype(np.uint64)
    for w in words[1:]:
        key = pair_keys(key, w.astype(np.uint64))
    return key


def gram_shards(prefix: np.ndarray | None, keys: np.ndarray, level: int, shards: int) -> np.ndarray:
    if level == 1:
        return (keys % np.uint64(shards)).astype(np.int64)
    return shard_of(keys if level == 2 else prefix, shards)


def _starts(key: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))


def _sums(key: np.ndarray, *values: np.ndarray):
    """Where each distinct key is and the sums of each of ``values`` by key."""
    order = np.argsort(key)
    first = _starts(key[order])
    return order[first], [np.add.reduceat(v[order], first, dtype=np.int64) if len(first) else v for v in values]


def _planes(x: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones, ...: they pack better than whole values."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplanes(raw: bytes, kind: str, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel()


def _pack(columns: list[np.ndarray]) -> tuple[int, str, bytes]:
    """Rows, types and packed columns of a block; the first column rises and is kept as its steps."""
    columns = [c.astype(np.min_scalar_type(int(c.max()))) for c in columns]
    columns[0] = np.diff(columns[0], prepend=columns[0].dtype.type(0))
    return (len(columns[0]), "".join(c.dtype.char for c in columns),
            zstandard.ZstdCompressor(level=1).compress(b"".join(map(_planes, columns))))


def _unpack(n: int, kinds: str, data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    columns, at = [], 0
    for kind in kinds:
        columns.append(_unplanes(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return [np.cumsum(columns[0], dtype=columns[0].dtype), *columns[1:]]


BLOCK = "shard int, n bigint, kinds string, data binary, file string, level int, sizes array<bigint>"


def _rows(n: int, /, **columns) -> pa.RecordBatch:
    """A batch of the columns of `BLOCK`; those not given are null."""
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(),
             "array<bigint>": pa.list_(pa.int64())}
    fields = [f.split() for f in BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f], kinds[k]) if f in columns else pa.nulls(n, kinds[k]) for f, k in fields],
        names=[f for f, _ in fields])


def _blocks(shard: np.ndarray, columns: list[np.ndarray], shards: int) -> Iterator[pa.RecordBatch]:
    """A block for each shard of the rows of ``columns``, whose first column rises."""
    order = np.argsort(shard.astype(np.min_scalar_type(shards)), kind="stable")
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    found = []
    for s in np.flatnonzero(np.diff(cut)).tolist():
        own = order[cut[s]:cut[s + 1]]
        found.append((s, *_pack([c[own] for c in columns])))
    if found:
        yield _rows(len(found), **{c: [f[i] for f in found] for i, c in enumerate(("shard", "n", "kinds", "data"))})


def _gathered(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct hashes and the run of places among them, for about `GATHER` tokens at a time."""
    held, n = [], 0

    def whole():
        known, place = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        at = np.cumsum([0, *[len(h) for h, _ in held]])
        return known, np.concatenate([place[a + run] for a, (_, run) in zip(at, held)])

    for batch in batches:
        for texts in slices(batch.column(0)):
            hashes, run, _ = coded(texts, order)
            held.append((hashes, run))
            n += len(run)
            if n >= GATHER:
                yield whole()
                held, n = [], 0
    if held:
        yield whole()


def word_blocks(texts: DataFrame, shards: int) -> DataFrame:
    """Hashes and counts of distinct tokens; the start token has count 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for known, places in _gathered(batches, 2):
            counts = np.bincount(places, minlength=len(known))
            counts[known == HASHES[0]] = 0
            yield from _blocks(shard_of(known, shards), [known, counts], shards)

    return texts.mapInArrow(run, BLOCK)


def _narrow(x: np.ndarray) -> list[np.ndarray]:
    """Values below 255 as bytes, the places of others and these apart."""
    large = np.flatnonzero(x >= 255)
    return [np.minimum(x, 255).astype(np.uint8), large, x[large].astype(np.int64)]


def _flags(at: np.ndarray, n: int) -> list[np.ndarray]:
    """A bit for each of ``n`` places, and how many are set before each 64 of them."""
    bits = np.zeros((n >> 6) + 1 << 6, bool)
    bits[at] = True
    words = np.packbits(bits, bitorder="little").view(np.uint64)
    return [words, np.cumsum(np.bitwise_count(words), dtype=np.uint32) - np.bitwise_count(words)]


def _write(folder: str, name: str, parts: list[np.ndarray]) -> list[int]:
    """Write arrays one after the other, each from a multiple of 8 bytes; their lengths."""
    store, path = filesystem(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{name}") as out:
        for x in parts:
            for at in range(0, len(x), 1 << 20):
                out.write(x[at:at + (1 << 20)].tobytes())
            out.write(bytes(-x.nbytes % 8))
    return [len(x) for x in parts]


class Parts:
    """A memory-mapped file of `_write`."""

    def __init__(self, folder: str, name: str, sizes: list[int]):
        self.raw, self.at, self.sizes = memory_map(folder, name, np.uint8), 0, list(sizes)

    def take(self, kind) -> np.ndarray:
        size = np.dtype(kind).itemsize * self.sizes.pop(0)
        part = self.raw[self.at:self.at + size].view(kind)
        self.at += size + -size % 8
        return part


class Narrow:
    def __init__(self, parts: Parts):
        self.small, self.large, self.values = parts.take(np.uint8), parts.take(np.int64), parts.take(np.int64)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        out = self.small[at].astype(np.int64)
        large = np.flatnonzero(out == 255)
        if len(large):
            out[large] = self.values[np.searchsorted(self.large, at[large])]
        return out


class Flags:
    def __init__(self, parts: Parts):
        self.words, self.before = parts.take(np.uint64), parts.take(np.uint32)

    def places(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``at`` are set, and their places among all that are."""
        word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
        own = np.flatnonzero(word >> bit & np.uint64(1))
        low = np.bitwise_count(word[own] & ((np.uint64(1) << bit[own]) - np.uint64(1)))
        return own, self.before[at[own] >> 6].astype(np.int64) + low


def _file(kind: str, shard: int, level: int, folder: str, parts: list[np.ndarray], figures: list[int]) -> pa.RecordBatch:
    name = f"{kind}-{shard}-{uuid.uuid4().hex}"
    sizes = _write(folder, name, parts)
    return _rows(1, shard=[shard], file=[name], level=[level], sizes=[[*figures, *sizes]])


def _merged(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    """The columns of all blocks, one after the other."""
    blocks = [_unpack(r["n"], r["kinds"], r["data"]) for b in batches
              for r in b.select(["n", "kinds", "data"]).to_pylist()]
    return [np.concatenate([b[i] for b in blocks]) for i in range(len(blocks[0]))]


def write_vocabulary(blocks: DataFrame, folder: str) -> DataFrame:
    """Write each shard's words: sorted hashes, their ranks by falling count, counts by rank.

    Figures: the start token's rank (-1 elsewhere), tokens, distinct tokens.
    """
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = _merged(batches)
        at, (counts,) = _sums(hashes, counts)
        hashes = hashes[at].astype(np.uint64)
        by = np.argsort(-counts, kind="stable")
        ranks = np.empty(len(by), np.uint32)
        ranks[by] = np.arange(len(by))
        start = ranks[hashes == HASHES[0]].tolist()
        yield _file("words", key[0].as_py(), 0, folder, [hashes, ranks, *_narrow(counts[by])],
                    [*(start or [-1]), int(counts.sum()), int((counts > 0).sum())])

    return blocks.groupBy("shard").applyInArrow(run, BLOCK)


class Words:
    """Memory-mapped shards of the vocabulary."""

    def __init__(self, folder: str, files: list[tuple[str, int, list[int]]], shards: int):
        self.shards, self.files = shards, {}
        for name, shard, sizes in files:
            parts = Parts(folder, name, sizes[3:])
            self.files[shard] = parts.take(np.uint64), parts.take(np.uint32), Narrow(parts)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of sorted distinct hashes."""
        ids, counts = np.full(len(hashes), UNKNOWN), np.zeros(len(hashes), np.int64)
        cut = np.searchsorted(shard_of(hashes, self.shards), np.arange(self.shards + 1))
        for s, (keys, ranks, count) in self.files.items():
            wanted = hashes[cut[s]:cut[s + 1]]
            if len(wanted):
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                own = np.flatnonzero(keys[at] == wanted)
                rank = ranks[at[own]].astype(np.int64)
                ids[cut[s] + own] = rank * self.shards + s
                counts[cut[s] + own] = count[rank]
        return ids, counts


def _distinct(columns: list[np.ndarray], bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of ``columns`` of ``bits`` bits in rising order, and how often each is there."""
    code, width, tables = columns[0].astype(np.uint64), bits, []
    for c in columns[1:]:
        if width + bits > 64:  # places among the distinct prefixes take fewer bits
            table, code = np.unique(code, return_inverse=True)
            code, width = code.astype(np.uint64), len(table).bit_length()
        else:
            table = None
        tables.append(table)
        code = code << np.uint64(bits) | c.astype(np.uint64)
        width += bits
    code = np.sort(code)
    first = _starts(code)
    counts = np.diff(first, append=len(code))
    code, out = code[first], []
    for table in reversed(tables):
        out.append((code & np.uint64((1 << bits) - 1)).astype(np.int64))
        code = code >> np.uint64(bits)
        if table is not None:
            code = table[code]
    return [code.astype(np.int64), *reversed(out)], counts


def gram_blocks(texts: DataFrame, vocabulary: tuple, shards: int, order: int) -> DataFrame:
    """The distinct n-grams of the texts, as ids, and their counts."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)  # names and sizes of the files only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Words(*shared.value)
        for known, places in _gathered(batches, order):
            ids = vocabulary.find(known)[0]
            by = np.argsort(ids)
            place = np.empty(len(by), np.int64)
            place[by] = np.arange(len(by))
            ids, start, places = ids[by], place[np.searchsorted(known, HASHES[0])], place[places]
            whole = np.flatnonzero(places[order - 1:] != start)
            words, counts = _distinct([places[whole + i] for i in range(order)], len(ids).bit_length())
            words = [ids[w] for w in words]
            prefix = gram_keys(words[:-1])
            shard = gram_shards(prefix, pair_keys(prefix, words[-1]), order, shards)
            del prefix, places
            yield from _blocks(shard, [*words, counts], shards)

    return texts.mapInArrow(run, BLOCK)


def _write_grams(folder: str, shard: int, level: int, keys: np.ndarray, counts: np.ndarray,
                 contexts: list[np.ndarray]) -> pa.RecordBatch:
    """Write a shard as `Grams` reads it: sorted mixed keys without the bits that their bucket tells,
    counts other than 1 and contexts' figures apart from the rest.

    Figures: bits of a bucket, most keys of one, then how many counts are 1, 2, 3, 4.
    """
    mixed = scramble(keys)
    order = np.argsort(mixed)
    mixed, counts, contexts = mixed[order], counts[order], [c[order] for c in contexts]
    n, bits = len(mixed), max(0, (len(mixed) >> 3).bit_length() - 1)
    ends = np.searchsorted(mixed, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
    ends = np.concatenate([[0], ends, [n]]).astype(np.uint64)
    rest = mixed & np.uint64((1 << 64 - bits) - 1)
    other = np.flatnonzero(counts != 1)
    stored = np.flatnonzero(contexts[0] > 0) if contexts else np.empty(0, np.int64)
    parts = [ends.astype(np.uint32) if n >> 32 == 0 else ends, rest.astype(np.uint32),
             (rest >> S32).astype(np.uint16 if bits >= 16 else np.uint32), *_flags(other, n), *_narrow(counts[other]),
             *_flags(stored, n)]
    for c in contexts or [stored] * 4:
        parts += _narrow(c[stored])
    return _file("grams", shard, level, folder, parts,
                 [bits, int(np.diff(ends).max()), *[int((counts == i).sum()) for i in (1, 2, 3, 4)]])


class Grams:
    """A memory-mapped shard of n-grams."""

    def __init__(self, folder: str, name: str, sizes: list[int]):
        self.bits, self.most = sizes[:2]
        parts = Parts(folder, name, sizes[6:])
        self.ends = parts.take(np.uint32 if sizes[7] >> 32 == 0 else np.uint64)
        self.low, self.high = parts.take(np.uint32), parts.take(np.uint16 if self.bits >= 16 else np.uint32)
        self.other, self.counts = Flags(parts), Narrow(parts)
        self.stored, self.figures = Flags(parts), [Narrow(parts) for _ in range(4)]

    def _rest(self, at: np.ndarray) -> np.ndarray:
        return self.high[at].astype(np.uint64) << S32 | self.low[at]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of keys, and as contexts their sum and numbers of counts 1, 2, 3 and more."""
        wanted = scramble(keys)
        bucket = (wanted >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)
        wanted &= np.uint64((1 << 64 - self.bits) - 1)
        low, high = self.ends[bucket].astype(np.int64), self.ends[bucket + 1].astype(np.int64)
        last = high - 1
        for _ in range(self.most.bit_length()):
            half = low + high >> 1
            less = (low < high) & (self._rest(np.minimum(half, len(self.low) - 1)) < wanted)
            low, high = np.where(less, half + 1, low), np.where(less, high, half)
        hit = np.flatnonzero(low <= last)
        hit = hit[self._rest(low[hit]) == wanted[hit]]
        at = low[hit]
        found, figures = np.ones(len(hit), np.int64), np.tile([1, 1, 0, 0], (len(hit), 1))
        own, place = self.other.places(at)
        found[own] = self.counts[place]
        own, place = self.stored.places(at)
        for i, f in enumerate(self.figures):
            figures[own, i] = f[place]
        counts, contexts = np.zeros(len(keys), np.int64), np.zeros((len(keys), 4), np.int64)
        counts[hit], contexts[hit] = found, figures
        return counts, contexts


def merge_shards(blocks: DataFrame, folder: str, level: int, order: int, shards: int, start: int) -> DataFrame:
    """Write each shard's sorted n-grams of ``level`` words; their files' rows and blocks of those one word shorter.

    Of single words, the figures by rank: in how many bigrams each is the last, and as contexts.
    """
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, columns = key[0].as_py(), _merged(batches)
        words, values = columns[:level], columns[level:]
        del columns
        keys = gram_keys(words)
        at, values = _sums(keys, *values)
        keys, words = keys[at], [w[at] for w in words]
        del at
        c, contexts = values[0], values[1:]  # the highest order has counts only
        if level == 1:
            place = (keys // np.uint64(shards)).astype(np.int64)
            figures = [np.zeros(int(place.max()) + 1, np.int64) for _ in values]
            for f, v in zip(figures, values):
                f[place] = v
            yield _file("figures", shard, 1, folder, [x for f in figures for x in _narrow(f)],
                        [int(c.sum()), int((c >= 3).sum()), *[int((c == i).sum()) for i in (1, 2, 3, 4)]])
            return
        yield _write_grams(folder, shard, level, keys, c, contexts)
        del keys, values, contexts
        seen = np.flatnonzero(c)  # the others are contexts only, of start tokens
        words, c = [w[seen] for w in words], c[seen]
        before, figures = _sums(gram_keys(words[:-1]), c, *[x.astype(np.uint8) for x in (c == 1, c == 2, c >= 3)])
        if level > 2:
            told = (figures[0] > 1) | (words[0][before] == start)
            before, figures = before[told], [f[told] for f in figures]
        contexts = [w[before] for w in words[:-1]]
        last, (count,) = _sums(gram_keys(words[1:]), np.ones(len(c), np.uint8))
        words = [np.concatenate([w[last], x]) for w, x in zip(words[1:], contexts)]
        values = [np.concatenate([count, np.zeros(len(before), np.int64)]),
                  *[np.concatenate([np.zeros(len(last), np.int64), f]) for f in figures]]
        by = np.lexsort(words[::-1])
        words, values = [w[by] for w in words], [v[by] for v in values]
        prefix = gram_keys(words[:-1]) if level > 2 else None
        yield from _blocks(gram_shards(prefix, gram_keys(words), level - 1, shards), [*words, *values], shards)

    return blocks.groupBy("shard").applyInArrow(run, BLOCK)


def discounts(n: list[int]) -> np.ndarray:
    """D0..D3+ of modified Kneser-Ney from n1..n4; plain values where counts are too few."""
    n1, n2, n3, n4 = n
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([0.0, *[min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]])


File = tuple[str, int, list[int]]   # name, shard, sizes


@dataclass
class Model:
    folder: str
    order: int
    words: list[File]
    grams: dict[int, list[File]]        # by level, from 1
    shards: int
    gram_discounts: dict[int, np.ndarray]  # by level
    word_discount: np.ndarray
    train_tokens: int
    distinct: int
    follow_total: int
    word_mass: float                    # g0, before division


def train(texts: DataFrame, shards: int, order: int = 2) -> Model:
    """Count ``texts`` (one column) and write the model; the sizes and discounts come back."""
    if order < 2:
        raise ValueError(f"order {order}: the shortest n-grams are bigrams")
    folder = shared_folder(texts.sparkSession, "ngrams")

    def files(rows: DataFrame) -> list[File]:
        return [(r["file"], r["shard"], r["sizes"])
                for r in rows.where(F.col("file").isNotNull()).select("file", "shard", "sizes").collect()]

    words = files(written_alone(write_vocabulary(word_blocks(texts, shards), folder), "ngram-words"))
    start = max([sizes[0] * shards + s for _, s, sizes in words if sizes[0] >= 0], default=-1)
    blocks, grams = gram_blocks(texts, (folder, words, shards), shards, order), {}
    for level in range(order, 0, -1):
        # blocks of the longest n-grams come from the texts, which are read once; others are written
        passes = min(shards, PASSES) if 1 < level < order else 1
        merged = None
        for p in range(passes):
            own = blocks if passes == 1 else blocks.where(F.col("shard") % passes == p)
            part = written_alone(merge_shards(own, folder, level, order, shards, start), f"ngrams-{level}")
            merged = part if merged is None else merged.union(part)
        grams[level] = files(merged)
        blocks = merged.where(F.col("file").isNull())
    totals = {k: np.sum([[0] * 6, *[sizes[:6] for _, _, sizes in f]], axis=0).tolist() for k, f in grams.items()}
    follows, more, *coc = totals[1]
    word_d = discounts(coc)
    mass = word_d[1] * coc[0] + word_d[2] * coc[1] + word_d[3] * more
    return Model(folder, order, words, grams, shards, {k: discounts(totals[k][2:]) for k in range(2, order + 1)},
                 word_d, sum(sizes[1] for _, _, sizes in words), sum(sizes[2] for _, _, sizes in words), follows,
                 float(mass))


class Lookup:
    """Memory-mapped arrays of a model."""

    def __init__(self, model: Model):
        self.m = model
        self.words = Words(model.folder, model.words, model.shards)
        self.figures = {}
        for name, s, sizes in model.grams[1]:
            parts = Parts(model.folder, name, sizes[6:])
            self.figures[s] = [Narrow(parts) for _ in range(5)]
        self.grams = {(k, s): Grams(model.folder, name, sizes)
                      for k in range(2, model.order + 1) for name, s, sizes in model.grams[k]}

    def gram_counts(self, level: int, prefix: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of n-grams and their figures as contexts, as `Grams.find` gives them."""
        shard = gram_shards(prefix, keys, level, self.m.shards)
        order = np.argsort(shard.astype(np.min_scalar_type(self.m.shards)), kind="stable")
        cut = np.searchsorted(shard[order], np.arange(self.m.shards + 1))
        counts, contexts = np.zeros(len(keys), np.int64), np.zeros((len(keys), 4), np.int64)
        for s in np.flatnonzero(np.diff(cut)).tolist():
            if grams := self.grams.get((level, s)):
                own = order[cut[s]:cut[s + 1]]
                counts[own], contexts[own] = grams.find(keys[own])
        return counts, contexts

    def word_figures(self, ids: np.ndarray) -> np.ndarray:
        """In how many bigrams each id is the last, and its figures as a context."""
        out = np.zeros((len(ids), 5), np.int64)
        shard = np.where(ids == UNKNOWN, self.m.shards, ids % np.uint64(self.m.shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(self.m.shards + 1))
        for s in np.flatnonzero(np.diff(cut)).tolist():
            if figures := self.figures.get(s):
                own = order[cut[s]:cut[s + 1]]
                place = (ids[own] // np.uint64(self.m.shards)).astype(np.int64)
                for i, f in enumerate(figures):
                    out[own, i] = f[place]
        return out

    def score(self, texts: pa.Array):
        """n_tokens, n_known, base_score and score of each text."""
        m = self.m
        hashes, run, sizes = coded(texts, m.order)
        by = np.argsort(hashes)
        ids, counts = np.empty(len(hashes), np.uint64), np.empty(len(hashes), np.int64)
        ids[by], counts[by] = self.words.find(hashes[by])
        figures = self.word_figures(ids)
        first = np.cumsum(sizes) - sizes
        at = np.arange(len(run) - (m.order - 1) * len(sizes)) + np.repeat(
            (m.order - 1) * np.arange(1, len(sizes) + 1), sizes)  # tokens' places in the run
        w = run[at]
        back = [ids[run[at - i]] for i in range(m.order)]  # the words 0, 1, ... before each token
        vocabulary = m.distinct + 1
        follow = figures[:, 0]
        p = ((np.maximum(follow - m.word_discount[np.minimum(follow, 3)], 0) / max(1, m.follow_total)
              + (m.word_mass / m.follow_total if m.follow_total else 1.0) / vocabulary))[w]
        contexts = figures[run[at - 1], 1:]
        for level in range(2, m.order + 1):
            prefix = gram_keys(back[level - 1:0:-1])
            c, figures_of = self.gram_counts(level, prefix, pair_keys(prefix, back[0]))
            d, total = m.gram_discounts[level], np.maximum(contexts[:, 0], 1)
            p = np.where(contexts[:, 0] > 0, np.maximum(c - d[np.minimum(c, 3)], 0) / total
                         + contexts[:, 1:] @ d[1:] / total * p, p)
            if level < m.order:  # the n-gram that ends before a token is its next longer context
                start = [ids[:1]] * level
                contexts = np.roll(figures_of, 1, axis=0)
                contexts[first] = self.gram_counts(level, gram_keys(start[1:]), gram_keys(start))[1]
        base = np.log10((counts + 1) / (m.train_tokens + vocabulary))
        return (sizes, np.add.reduceat((counts > 0).astype(np.int64)[w], first),
                np.add.reduceat(base[w], first), np.add.reduceat(np.log10(p), first))


SCORES = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score for each row.

    Defined cases: a null or empty text is the end token alone; a model of no
    training text gives every token the share of one unknown token; repeated
    rows are scored alike; an empty table gives no rows. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # names and sizes of the files only

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(shared.value)
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                n, known, base, score = lookup.score(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(n.astype(np.int64)), pa.array(known),
                     pa.array(base), pa.array(score)],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"])
                at += len(texts)

    return docs.select("doc_id", "text").mapInArrow(run, SCORES)


def held_out(doc_id):
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 7 == 2, F.lit(False))


def shard_count(docs: DataFrame) -> int:
    """Shards in proportion to the texts' bytes, so that one shard's n-grams fit a task."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(4, -(-size // SHARD_BYTES))


def op8_kneser_ney(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(F.col("doc_id"))).select("text"), shard_count(docs), ORDER)
    return score_documents(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
        (10 ** (-F.col("score") / F.col("n_tokens"))).alias("perplexity"))
