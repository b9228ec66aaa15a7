"""Near duplicates by SetSketch: banded registers, a joint likelihood estimate, exact checks.

A document's set is its distinct 5-word shingles (64-bit hashes). Its sketch
has ``REGISTERS`` registers; register i is

    K_i = clamp(floor(1 - log_b(min over the set of x_i(s))), 0, q + 1)

with x_i(s) exponential of rate ``a``: minima on an exponentially spaced
scale, truncated at both ends. Registers of a union are the maxima of the
registers (:func:`merge`), and equal registers get likelier with the Jaccard
similarity J, so they can be banded.

1. One Arrow pass makes the sketches; documents of equal sets become one
   class (map-side combined), so copies of any number cost one row from here.
2. Every ``ROWS`` registers form a band. With 40 bands of 4, a pair at J = 0.75
   shares no band with probability (1 - 0.75^4)^40 = 2.5e-7, less above that.
3. Shingles that no other class in any bucket has bound a class's similarity
   to all others exactly; classes and pairs that cannot reach 0.75 go, with no
   pair made. Within a bucket only components count, so pairs are made as
   stars: all classes of a bucket against one hub, not all pairs. Links found
   merge components; buckets that still hold several components get further
   hubs, and what is left between different components in one bucket is then
   compared pair by pair. No pair of one bucket is left out that could join two
   components, so the components equal those of all candidate pairs.
4. A candidate pair is dropped by its sketches when a similarity of 0.75 or
   more is e^-16 times less likely than the best one, by the joint likelihood
   of the registers that are greater, smaller and equal, given the set sizes.
   Every other pair is confirmed on the full sets of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import in_arrow, keys_to_join, read, same, written
from courtside.llm.components import components

SHINGLE, NUM, DEN = 5, 75, 100
REGISTERS, ROWS = 160, 4
BASE, RATE, TOP = 1.001, 20.0, 65534
#: Pairs are made bucket by bucket once this many a bucket member, or fewer, are open; until then,
#: and for so many rounds at most, as stars. Neither changes which components are found.
PAIRS_A_MEMBER, STAR_ROUNDS = 256, 6
#: A pair is dropped by its sketches below this log likelihood ratio.
MARGIN = 16.0
#: Bits of a set's parity map (bit i: whether an odd number of shingles hash to i).
BITS = 1024
#: Shingles handled at once (bounds a worker's memory).
CHUNK = 1 << 15

_FACTORS = np.random.Generator(np.random.PCG64(20240229)).integers(
    1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hashes of words, short ones remembered up to a bound."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def scramble(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: str | None, hashes: WordHashes, k: int = SHINGLE) -> np.ndarray:
    """The sorted distinct k-word shingles of ``text``, hashed; fewer words make one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z only; ASCII space
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(k, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = (h + w[i:len(w) - k + 1 + i]) * _MIX
        h ^= h >> np.uint64(29)
    return np.unique(scramble(h))


def registers(minima: np.ndarray) -> np.ndarray:
    """SetSketch registers from the minima of uniform 64-bit hashes."""
    u = (minima.astype(np.float64) + 0.5) / 2.0 ** 64
    x = -np.log1p(-np.minimum(u, 1 - 2.0 ** -53)) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def sketch_sets(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers for each non-empty set."""
    out = np.full((len(sets), REGISTERS), np.iinfo(np.uint64).max, np.uint64)
    at = 0
    while at < len(sets):
        n, end = len(sets[at]), at + 1
        while end < len(sets) and n + len(sets[end]) <= CHUNK:
            n, end = n + len(sets[end]), end + 1
        part = sets[at:end]
        for piece in range(0, max(n, 1), CHUNK) if len(part) == 1 else [0]:
            h = part[0][piece:piece + CHUNK] if len(part) == 1 else np.concatenate(part)
            starts = np.cumsum([0, *map(len, part[:-1])]) if len(part) > 1 else [0]
            buf = np.empty_like(h)
            for j, f in enumerate(_FACTORS):
                np.multiply(h, f, out=buf)
                least = np.minimum.reduceat(buf, starts)
                np.minimum(out[at:end, j], least, out=out[at:end, j])
        at = end
    return registers(out)


SKETCH = "doc_id bigint, text_hash bigint, n bigint, set_key binary, regs binary"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        step = 2000
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            sets = [shingle_hashes(t, hashes) for t in part.column(2).to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            regs = iter(sketch_sets([sets[i] for i in full]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                          pa.binary()),
                 pa.array([next(regs).astype("<u2").tobytes() if len(s) else None for s in sets],
                          pa.binary())],
                names=["doc_id", "text_hash", "n", "set_key", "regs"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            sets = [shingle_hashes(t, hashes).view(np.int64) for t in part.column(1).to_pylist()]
            odd = [np.bincount(s & (BITS - 1), minlength=BITS) & 1 for s in sets]
            bits = [np.packbits(x.astype(np.uint8)).view(np.int64) for x in odd]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sets, pa.list_(pa.int64())),
                 pa.array(bits, pa.list_(pa.int64()))], names=["node", "shingles", "bits"])


def joint_log_likelihood(greater, smaller, equal, n_a, n_b, grid: np.ndarray) -> np.ndarray:
    """Log likelihood of Jaccard similarities ``grid`` for pairs of sketches (pairs x grid).

    ``greater``, ``smaller``, ``equal`` count the registers of a against b. With
    u, v the sizes relative to their sum, a register of a is the greater one
    with probability p(u - v J), p(x) = -log_b(1 - x (b - 1) / b).
    """
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = np.minimum(grid[None, :], np.minimum(u / v, v / u))

    def p(x):
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    return (greater[:, None] * np.log(np.maximum(up, tiny))
            + smaller[:, None] * np.log(np.maximum(down, tiny))
            + equal[:, None] * np.log(np.maximum(1 - up - down, tiny)))


_GRID = np.linspace(0, 1, 101)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b, n_a, n_b, regs_a, regs_b) that 0.75 or more is not ruled out for."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            a, b = (np.frombuffer(b"".join(part.column(k).to_pylist()), "<u2")
                    .reshape(-1, REGISTERS) for k in (4, 5))
            n_a, n_b = (part.column(k).to_numpy().astype(np.float64) for k in (2, 3))
            ll = joint_log_likelihood((a > b).sum(1), (a < b).sum(1), (a == b).sum(1), n_a, n_b,
                                      _GRID)
            keep = ll[:, _GRID >= NUM / DEN - 1e-9].max(1) >= ll.max(1) - MARGIN
            out = part.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [out.column(0), out.column(1), out.column(2), out.column(3),
                 pa.array(_GRID[ll.argmax(1)][keep])], names=["a", "b", "n_a", "n_b", "estimate"])


class _Linker:
    """Candidate pairs of classes to confirmed links."""

    def __init__(self, docs: DataFrame, classes: DataFrame, wanted: DataFrame):
        """``wanted``: the classes that share a band bucket with another one."""
        rows = docs.select(F.col("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
        keys = classes.join(wanted, "node", "left_semi").select("node", "doc_id", "text_hash")
        keys = written(keys, "near-wanted")
        n = keys.count()
        keys = keys_to_join(keys)
        texts = rows.join(keys, same(rows, keys, ["doc_id", "text_hash"])).select("node", "text")
        # repeated rows give a class's text more than once: any one will do
        self.sets = written(in_arrow(texts, _sets, "node bigint, shingles array<bigint>, bits array<bigint>"),
                            "near-sets")
        if self.sets.count() > n:
            self.sets = written(self.sets.dropDuplicates(["node"]), "near-sets")
        self.regs = classes.select("node", "n", "regs")

    def shareable(self) -> DataFrame:
        """(node, k, bits): how many shingles each wanted class has that another one has too.

        No class shares more with any other, so k bounds the similarity of
        every pair exactly, before any pair is made. So do the parity maps
        ``bits``: two sets differ in as many shingles as their maps in bits, or more.
        """
        alone = (self.sets.select("node", F.explode("shingles").alias("s")).groupBy("s")
                 .agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node")).where("c = 1")
                 .groupBy("node").agg(F.count(F.lit(1)).alias("own")))
        return written(self.sets.select("node", "bits", F.size("shingles").cast("bigint").alias("size"))
                       .join(alone, "node", "left").select(
            "node", "bits", (F.col("size") - F.coalesce("own", F.lit(0))).alias("k")),
            "near-shareable")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets are similar enough; each pair once."""
        a = self.regs.toDF("a", "n_a", "regs_a")
        b = self.regs.toDF("b", "n_b", "regs_b")
        sized = pairs.join(a, "a").join(b, "b").where(
            F.least("n_a", "n_b") * DEN >= F.greatest("n_a", "n_b") * NUM)
        likely = written(
            in_arrow(sized.select("a", "b", "n_a", "n_b", "regs_a", "regs_b"), _likely,
                     "a bigint, b bigint, n_a bigint, n_b bigint, estimate double"),
            "near-likely")
        sets = self.sets.select("node", "shingles")
        sa, sb = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
        both = F.size(F.array_intersect("set_a", "set_b")).cast("bigint")
        return (likely.join(sb, "b").join(sa, "a").withColumn("both", both)
                .where(F.col("both") * DEN >= (F.col("n_a") + F.col("n_b") - F.col("both")) * NUM)
                .select("a", "b"))


def _bands(classes: DataFrame) -> DataFrame:
    width = 2 * ROWS
    keys = [F.xxhash64(F.lit(i), F.substring("regs", width * i + 1, width))
            for i in range(REGISTERS // ROWS)]
    return classes.select("node", "n", F.explode(F.array(*keys)).alias("key"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_hash, n_shingles, component_id, row, root.

    ``row`` numbers the rows, ``root`` is a number of the component (null without shingles).

    Defined cases: a null, empty or blank text has no shingles and is linked
    with nothing; a text of fewer than five words is one shingle; repeated
    rows are documents of equal sets; component_id is the smallest id
    reachable (null ids are skipped, and it is null only if all ids of the
    component are); an empty table gives no rows; other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    sketches = written(in_arrow(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"),
                                _sketch, SKETCH)
                       .withColumn("row", F.monotonically_increasing_id()), "near-sketches")
    full = sketches.where(F.col("set_key").isNotNull())
    classes = written(full.groupBy("set_key").agg(
        F.min(F.struct("row", "doc_id", "text_hash", "n", "regs")).alias("first"),
        F.min("doc_id").alias("least_id")).select(
        "set_key", "least_id", F.col("first.row").alias("node"), "first.doc_id", "first.text_hash",
        "first.n", "first.regs"), "near-classes")

    bands = _bands(classes)
    # group tables are written: AQE splits a hot key only if a join reads both sides from a
    # shuffle, not from an aggregate
    shared = written(bands.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
                     .where("members > 1").select("key"), "near-shared")
    together = written(bands.join(shared, "key").select("key", "node", "n"), "near-together")
    linker = _Linker(docs, classes, together.select("node").distinct())
    buckets = written(together.join(linker.shareable(), "node").where(
        F.col("k") * DEN >= F.col("n") * NUM).select("key", "node", "n", "k", "bits"), "near-buckets")

    label, tested = None, None
    budget = PAIRS_A_MEMBER * max(1, buckets.count())
    for turn in range(STAR_ROUNDS + 1):
        placed = buckets.withColumn("comp", F.col("node")) if label is None else buckets.join(
            label, "node", "left").select(*buckets.columns, F.coalesce("root", "node").alias("comp"))
        placed = _open_buckets(written(placed, "near-placed"))
        inside = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("key").agg(
            F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("s"))
        left = inside.agg(F.sum((F.col("m") * F.col("m") - F.col("s")) / 2)).first()[0] or 0
        rest = turn > 0 and (left <= budget or turn == STAR_ROUNDS)
        pairs = _all_crossing(placed) if rest else _star(placed, turn)
        pairs = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "near-pairs")
        links = linker.links(pairs)
        label = components(links, "near-0") if label is None else _merged(label, links, f"near-{turn}")
        if rest or left == 0:
            break
        tested = pairs if tested is None else tested.union(pairs)

    member = classes.join(label, "node", "left").select(
        "set_key", "least_id", F.coalesce("root", "node").alias("root"))
    member = written(member, "near-members")
    least = written(member.groupBy("root").agg(F.min("least_id").alias("component_id")), "near-least")
    found = member.join(least, "root").select("set_key", "component_id", "root")
    return sketches.join(found, "set_key", "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), "row", "root",
        F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"))


def _open_buckets(placed: DataFrame) -> DataFrame:
    """The rows of the buckets that hold more than one component."""
    mixed = written(placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                    .where("lo <> hi").select("key"), "near-mixed")
    return written(placed.join(mixed, "key", "left_semi"), "near-open")


def _merged(label: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """The components of ``label`` joined by further links."""
    def root(c: str) -> DataFrame:
        return label.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    between = links.join(root("a"), "a", "left").join(root("b"), "b", "left").select(
        F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).distinct()
    more = components(between, name).toDF("node", "to")
    old = label.toDF("old", "root").join(more, F.col("root") == F.col("node"), "left").select(
        F.col("old").alias("node"), F.coalesce("to", "root").alias("root"))
    new = more.join(label.select("node"), "node", "left_anti").toDF("node", "root")
    return written(old.unionByName(new), name)


def _may_link(a: str, b: str):
    """Whether the similarity can reach 0.75 by the bounds of :meth:`_Linker.shareable`.

    The sides' columns are n, k, bits with the endings ``a`` and ``b``.
    """
    n = F.col(f"n{a}") + F.col(f"n{b}")
    differ = F.lit(0)
    for i in range(BITS // 64):
        differ = differ + F.bit_count(F.col(f"bits{a}")[i].bitwiseXOR(F.col(f"bits{b}")[i]))
    most = F.least(f"k{a}", f"k{b}")
    # the cheap bound first; with d differing shingles the similarity is (n - d) / (n + d)
    return (most * DEN >= (n - most) * NUM) & ((n - differ) * DEN >= (n + differ) * NUM)


def _star(placed: DataFrame, turn: int) -> DataFrame:
    """Every class of an open bucket against one hub: first the class with the smallest share of
    shingles of its own (the likeliest to be what others were copied from), then any."""
    first = (F.lit(1.0) - F.col("k") / F.col("n")) if turn == 0 else F.xxhash64(F.lit(turn), "node")
    hubs = written(placed.groupBy("key").agg(F.min(F.struct(
        first.alias("first"), "node", "n", "k", "bits", "comp")).alias("h")).select(
        "key", F.col("h.node").alias("hub"), F.col("h.n").alias("n_h"), F.col("h.k").alias("k_h"),
        F.col("h.bits").alias("bits_h"), F.col("h.comp").alias("comp_h")), "near-hubs")
    return placed.join(hubs, "key").where(
        (F.col("comp") != F.col("comp_h")) & _may_link("", "_h")).select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _all_crossing(placed: DataFrame) -> DataFrame:
    """Every pair of classes of one bucket that lie in different components and may be similar."""
    x = placed.toDF("key", "a", "n_a", "k_a", "bits_a", "comp_a")
    y = placed.toDF("key", "b", "n_b", "k_b", "bits_b", "comp_b")
    return x.join(y, "key").where(
        (F.col("a") < F.col("b")) & (F.col("comp_a") != F.col("comp_b"))
        & _may_link("_a", "_b")).select("a", "b").distinct()


def op9_minhash_neardup(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of ``docs``, with all its columns; rows without words stay.

    Of a group the row with the smallest id stays (null ids last); of its rows with that id
    and that text, which only other columns can tell apart, any one.
    """
    found = written(near_duplicates(docs).where("n_shingles > 0").select("doc_id", "text_hash", "row", "root"),
                    "near-groups")
    first = written(found.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("f")).select("f.row"), "near-first")
    told = found.join(first.withColumn("stays", F.lit(True)), "row", "left").groupBy("doc_id", "text_hash").agg(
        F.count("stays").alias("stay"), F.count(F.lit(1)).alias("rows"))
    # texts of which not all rows stay
    told = keys_to_join(written(told.where("stay < rows"), "near-told"))
    text = F.xxhash64(docs["text"])
    key = lambda t: docs["doc_id"].eqNullSafe(t["doc_id"]) & (text == t["text_hash"])
    some = told.where("stay > 0").select("doc_id", "text_hash")
    one = docs.join(some, key(some), "left_semi").select(
        "doc_id", F.xxhash64("text").alias("h"), F.struct(*[docs[c] for c in docs.columns]).alias("doc")).groupBy(
        F.col("doc_id").alias("i"), "h").agg(F.first("doc").alias("doc")).select("doc.*")
    return docs.join(told, key(told), "left_anti").unionAll(one)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
      FROM (SELECT doc_id, w, least(len(w), 5) AS k,
                   unnest(generate_series(1, len(w) - least(len(w), 5) + 1)) AS i
            FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
overlap AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
         FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM overlap JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
         WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach(doc_id, other) AS (
  SELECT a, b FROM link UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other),
low AS (SELECT doc_id, least(doc_id, min(other)) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       coalesce(low.component_id, d.doc_id) AS component_id,
       coalesce(low.component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""
