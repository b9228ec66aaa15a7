"""Edit-aware token counts: a segment tree of pre-tokens per document.

A byte-level BPE tokenizer first splits a text into pre-tokens by a pattern and
then encodes each alone, so a document's token count is the sum over its
pre-tokens. These sums are kept in a segment tree: its leaves hold short runs of
pre-tokens (characters and tokens of each), inner nodes the sums of their
subtrees. An edit re-splits the text from a little before the edit (the pattern
looks no further ahead than ``CONTEXT`` characters) until a split falls on an old
one behind the edit; from there on the splits are the old ones, as the pattern
never looks back. Only these pre-tokens are re-encoded, and only the sums above
the touched leaves change.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import read

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the vocabulary's pre-token pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPLIT = regex.compile(PATTERN)
CONTEXT, LEAF = 8, 32


def load_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Counter(dict):
    """Tokens of each pre-token, remembered up to a bound."""

    LIMIT = 400_000

    def __init__(self, ranks: dict[bytes, int]):
        self.encoding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[piece] = n = len(self.encoding.encode_ordinary(piece))
        return n


class SegmentTree:
    """Characters and tokens of a text's pre-tokens; ``tokens`` is the total."""

    def __init__(self, text: str, count: Counter):
        self.count, self.text, self.reencoded = count, text, 0
        pieces = SPLIT.findall(text)
        self._build([len(p) for p in pieces], [count[p] for p in pieces])

    @classmethod
    def restored(cls, text: str, chars: list[int], tokens: list[int], count: Counter) -> SegmentTree:
        """A tree from the leaves of one that was kept: nothing is split or encoded."""
        tree = cls.__new__(cls)
        tree.count, tree.text, tree.reencoded = count, text, 0
        tree._build(chars, tokens)
        return tree

    def runs(self) -> tuple[list[int], list[int]]:
        """Characters and tokens of all pre-tokens in their order."""
        return [c for x, _ in self.leaves for c in x], [t for _, x in self.leaves for t in x]

    def _build(self, chars: list[int], tokens: list[int]) -> None:
        self.leaves = [(chars[i:i + LEAF], tokens[i:i + LEAF]) for i in range(0, max(1, len(chars)), LEAF)]
        n = 1
        while n < len(self.leaves):
            n *= 2
        self.size = n
        self.sum_chars, self.sum_tokens = [0] * (2 * n), [0] * (2 * n)
        for i, (c, t) in enumerate(self.leaves):
            self.sum_chars[n + i], self.sum_tokens[n + i] = sum(c), sum(t)
        for i in range(n - 1, 0, -1):
            self._add(i)

    def _add(self, i: int) -> None:
        self.sum_chars[i] = self.sum_chars[2 * i] + self.sum_chars[2 * i + 1]
        self.sum_tokens[i] = self.sum_tokens[2 * i] + self.sum_tokens[2 * i + 1]

    @property
    def tokens(self) -> int:
        return self.sum_tokens[1]

    @property
    def segments(self) -> int:
        return sum(len(c) for c, _ in self.leaves)

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds character ``place`` (the last one for the end), and where it begins."""
        i, begin = 1, 0
        while i < self.size:
            i *= 2
            if place >= begin + self.sum_chars[i] and self.sum_chars[i + 1]:
                begin += self.sum_chars[i]
                i += 1
        return min(i - self.size, len(self.leaves) - 1), begin

    def edit(self, at: int, drop: int, put: str) -> None:
        """Replace ``drop`` characters from ``at`` on by ``put`` (both clamped to the text)."""
        old = self.text
        at = min(max(at, 0), len(old))
        drop = min(max(drop, 0), len(old) - at)
        new = self.text = old[:at] + put + old[at + drop:]
        shift = len(put) - drop
        # restart two pre-tokens before the one CONTEXT characters ahead of the edit
        leaf, begin = self._leaf_at(max(0, at - CONTEXT))
        starts = list(accumulate(self.leaves[leaf][0], initial=begin))[:-1]
        k = bisect_right(starts, max(0, at - CONTEXT)) - 1 - 2
        while k < 0 and leaf > 0:
            leaf -= 1
            begin -= sum(self.leaves[leaf][0])
            k += len(self.leaves[leaf][0])
        k = max(k, 0)
        starts = list(accumulate(self.leaves[leaf][0], initial=begin))
        place = starts[k] if k < len(starts) else begin
        # old splits from there on, leaf by leaf
        first, old_place, last, at_old = leaf, place, leaf, k
        pieces, done = [], False
        new_place = place
        while new_place < len(new) and not done:
            piece = SPLIT.match(new, new_place).group()
            pieces.append(piece)
            new_place += len(piece)
            if new_place < at + len(put):
                continue
            while old_place < new_place - shift and last < len(self.leaves):
                if at_old < len(self.leaves[last][0]):
                    old_place += self.leaves[last][0][at_old]
                    at_old += 1
                else:
                    last, at_old = last + 1, 0
            done = old_place == new_place - shift
        if not done:  # the text's end: all old pre-tokens from the restart on go
            last, at_old = len(self.leaves), 0
        self.reencoded += len(pieces)
        chars, tokens = [len(p) for p in pieces], [self.count[p] for p in pieces]
        head = self.leaves[first]
        tail = ([], []) if last >= len(self.leaves) else tuple(x[at_old:] for x in self.leaves[last])
        merged = (head[0][:k] + chars + tail[0], head[1][:k] + tokens + tail[1])
        touched = range(first, min(last, len(self.leaves) - 1) + 1)
        if len(merged[0]) > 4 * LEAF:
            before, after = self.leaves[:first], self.leaves[touched.stop:]
            whole = before + [merged] + after
            self._build([c for x, _ in whole for c in x], [t for _, x in whole for t in x])
            return
        for i in touched:
            self.leaves[i] = merged if i == first else ([], [])
            self.sum_chars[self.size + i], self.sum_tokens[self.size + i] = (
                sum(self.leaves[i][0]), sum(self.leaves[i][1]))
        for i in sorted({(self.size + i) >> up for i in touched
                         for up in range(1, self.size.bit_length())}, reverse=True):
            self._add(i)


COUNTS = ("doc_id bigint, n_tokens_before bigint, n_tokens bigint, n_segments bigint, "
          "n_reencoded bigint, n_edits int, n_chars bigint")


def count_edited(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Token counts of ``docs`` (doc_id, text, edits: array<struct<at, drop, put>>) before and after.

    Edits apply one after another, each to the text the last one left. Defined
    cases: a null text counts as empty and null edits as none; null or negative
    numbers count as 0, places beyond the end as the end, a null ``put`` as
    empty; a document without edits keeps its count; repeated rows are counted
    each; an empty table gives no rows. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(shared.value)
        names = [x.split()[0] for x in COUNTS.split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out: list[list] = [[] for _ in names[1:]]
                for text, edits in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    tree = SegmentTree(text or "", count)
                    before = tree.tokens
                    for e in edits or []:
                        tree.edit(e["at"] or 0, e["drop"] or 0, e["put"] or "")
                    for column, x in zip(out, (before, tree.tokens, tree.segments, tree.reencoded,
                                               len(edits or []), len(tree.text))):
                        column.append(x)
                types = [pa.int64()] * 4 + [pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(x, t) for x, t in zip(out, types)]], names=names)

    return docs.select("doc_id", "text", "edits").mapInArrow(run, COUNTS)


TREES = ("doc_id bigint, text string, chars array<int>, tokens array<int>, n_tokens bigint, n_reencoded bigint")


def _trees(rows: DataFrame, ranks: dict[bytes, int], make) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Counter(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                out = []
                for r in batch.slice(at, 500).to_pylist():
                    tree = make(r, count)
                    chars, tokens = tree.runs()
                    out.append((r["doc_id"], tree.text, chars, tokens, tree.tokens, tree.reencoded))
                types = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)],
                                                 names=[x.split()[0] for x in TREES.split(", ")])

    return rows.mapInArrow(run, TREES)


def planted(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """A tree's leaves for each row of ``docs`` (doc_id, text), to be kept as a table and edited later.

    A null text counts as empty; an empty table gives no rows; other columns are not read.
    """
    return _trees(docs.select("doc_id", "text"), ranks, lambda r, count: SegmentTree(r["text"] or "", count))


def edited(trees: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """The kept ``trees`` after their ``edits`` (as of :func:`count_edited`), in the same columns.

    Trees are built from their leaves: only regions that edits touch are split and encoded
    again, however many batches came before. A row without edits stays as it is.
    """
    def make(r: dict, count: Counter) -> SegmentTree:
        tree = SegmentTree.restored(r["text"] or "", r["chars"] or [], r["tokens"] or [], count)
        for e in r["edits"] or []:
            tree.edit(e["at"] or 0, e["drop"] or 0, e["put"] or "")
        return tree

    return _trees(trees.select("doc_id", "text", "chars", "tokens", "edits"), ranks, make)


def derived_edits(docs: DataFrame) -> DataFrame:
    """``docs`` with three edits each, derived from the row: its beginning inserted at a place
    that its checksum gives, a stretch dropped at another, and its end replaced."""
    text = F.coalesce("text", F.lit(""))
    n = F.length(text)
    mark = F.crc32(F.encode(text, "UTF-8"))
    edit = lambda at, drop, put: F.struct(at.cast("int").alias("at"), drop.cast("int").alias("drop"),
                                          put.alias("put"))
    return docs.select("doc_id", "text", F.array(
        edit(mark % (n + 1), F.lit(0), F.left(text, F.lit(24))),
        edit(F.floor(mark / 7) % (n + 1), F.lit(17), F.lit("")),
        edit(n - 5, F.lit(5), F.concat(F.lit(" "), F.left(text, F.lit(9))))).alias("edits"))


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_edited(derived_edits(read(spark, sf_dir, "documents")), load_ranks())
