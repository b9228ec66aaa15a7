"""Toxic spans by a linear-chain conditional random field over words.

Labels say which documents are toxic, not which words. Word labels are taken
from them: word and prefix features that stand in toxic documents far more
often than in others mark a word of a toxic document as toxic. The field (two tags, transitions, hashed word and
prefix features) is fitted to these tags by maximum conditional likelihood;
forward-backward marginals give each word's probability, runs of likely words
are the offending spans. A logistic regression of the largest marginal and the
expected number of toxic words gives the score; it is fitted on documents whose
marginals come from a field fitted on the other half of the sample, and shifted
to the share of toxic documents among all labelled training rows.

The field is fitted on the driver on a bounded sample (``SAMPLE`` labelled rows
of each class); scoring is one Arrow pass over all documents, whole texts.

A chain of two tags needs only the ratio of its two messages, which each word
maps by a linear-fractional function. A batch of documents is one long chain
(a document's first word forgets what came before) cut into blocks: block maps
are composed for all blocks at once, then chained, then applied.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import in_arrow, read

#: At most this many labelled training rows of each class are fitted on.
SAMPLE = 700
THRESHOLD = 0.3
FEATURES = 1 << 18
BLOCK = 128
WORD = re.compile(r"[^\W\d_]+")
#: A feature marks toxic words if it is in this many toxic documents and is this much likelier there.
MIN_DOCS, MIN_RATIO = 4, 20.0


def features(word: str) -> list[int]:
    """Hashed features of a word: itself and its prefixes of 3 to 7 letters."""
    w = word.lower()
    names = ["w" + w] + [f"p{k}{w[:k]}" for k in range(3, 8) if len(w) > k]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % FEATURES for x in names]


@dataclass
class Field:
    emission: np.ndarray      # weight of the toxic tag for each feature
    bias: float
    transition: np.ndarray    # 2 x 2 log weights
    start: np.ndarray         # 2 log weights
    doc: np.ndarray           # logistic weights: 1, logit of largest marginal, log(1 + sum)
    center: np.ndarray
    scale: np.ndarray


def _ratios(e, reset, t, s):
    """Forward and backward message ratios of a chain of words.

    ``e``: weight of the toxic tag at each word; ``reset``: whether a document
    starts there; ``t``, ``s``: transition and start weights.
    """
    n = len(e)
    blocks = -(-n // BLOCK)
    pad = blocks * BLOCK - n
    e = np.concatenate([e, np.ones(pad)]).reshape(blocks, BLOCK).T.copy()
    r = np.concatenate([reset, np.ones(pad, bool)]).reshape(blocks, BLOCK).T
    t00, t01 = np.where(r, s[0], t[0, 0]), np.where(r, s[1], t[0, 1])
    t10, t11 = np.where(r, s[0], t[1, 0]), np.where(r, s[1], t[1, 1])

    def chain(step, order, forward):
        a, b, c, d = (np.full(blocks, x) for x in (0.0, 1.0, 1.0, 0.0))
        for k in order:  # x -> (a + b x) / (c + d x), composed over each block
            a, b, c, d = step(k, a, b, c, d)
            z = a + b + c + d
            a, b, c, d = a / z, b / z, c / z, d / z
        into, x = np.empty(blocks), 1.0
        for i in range(blocks) if forward else range(blocks - 1, -1, -1):
            into[i] = x
            x = (a[i] + b[i] * x) / (c[i] + d[i] * x)
        return into

    def fstep(k, a, b, c, d):
        return (e[k] * (t01[k] * c + t11[k] * a), e[k] * (t01[k] * d + t11[k] * b),
                t00[k] * c + t10[k] * a, t00[k] * d + t10[k] * b)

    def bstep(k, a, b, c, d):
        return (t10[k] * c + t11[k] * e[k] * a, t10[k] * d + t11[k] * e[k] * b,
                t00[k] * c + t01[k] * e[k] * a, t00[k] * d + t01[k] * e[k] * b)

    alpha, beta = np.empty_like(e), np.empty_like(e)
    x = chain(fstep, range(BLOCK), True)
    for k in range(BLOCK):
        x = e[k] * (t01[k] + t11[k] * x) / (t00[k] + t10[k] * x)
        alpha[k] = x
    x = chain(bstep, range(BLOCK - 1, -1, -1), False)
    for k in range(BLOCK - 1, -1, -1):
        beta[k] = x
        x = (t10[k] + t11[k] * e[k] * x) / (t00[k] + t01[k] * e[k] * x)
    return alpha.T.ravel()[:n], beta.T.ravel()[:n]


def marginals(field: Field, log_e: np.ndarray, reset: np.ndarray) -> np.ndarray:
    """Probability of the toxic tag at each word."""
    e = np.exp(np.clip(log_e, -30, 30))
    alpha, beta = _ratios(e, reset, np.exp(field.transition), np.exp(field.start))
    return alpha * beta / (1 + alpha * beta)


def _without_copies(texts: list[str]) -> list[int]:
    """Places of the texts that are no near copy of an earlier one (any of 4 minimum hashes equal).

    Copies of one toxic text would make all its words look toxic.
    """
    seen: set[tuple[int, int]] = set()
    kept = []
    for i, t in enumerate(texts):
        words = t.lower().split()
        crc = [zlib.crc32(" ".join(words[j:j + 5]).encode("utf-8", "surrogatepass"))
               for j in range(max(1, len(words) - 4))]
        h = np.array(crc, np.uint64)
        marks = {(k, int(((h * np.uint64(2 * k + 0x9E3779B1)) & np.uint64(0xFFFFFFFF)).min()))
                 for k in range(4)}
        if not marks & seen:
            kept.append(i)
        seen |= marks
    return kept


def _lexicon(texts: list[str], toxic: list[int]) -> set[int]:
    """Features that are far likelier in toxic documents."""
    seen = (Counter(), Counter())
    for t, y in zip(texts, toxic):
        seen[y].update({f for w in set(WORD.findall(t)) for f in features(w)})
    n = [max(1, toxic.count(0)), max(1, toxic.count(1))]
    return {f for f, c in seen[1].items()
            if c >= MIN_DOCS and (c / n[1]) / ((seen[0][f] + 0.5) / n[0]) >= MIN_RATIO}


def _chain(texts: list[str]):
    words = [WORD.findall(t) for t in texts]
    reset = np.zeros(sum(map(len, words)), bool)
    at = np.cumsum([0, *map(len, words)])
    reset[[a for a, w in zip(at, words) if w]] = True
    return words, reset, at


def fit(texts: list[str], toxic: list[int], share: float | None = None) -> Field:
    """Fit on labelled texts; ``share``: of toxic texts where scores are to hold (default: here).

    With one class or none, every text gets that share.
    """
    kept = _without_copies(texts)
    texts, toxic = [texts[i] for i in kept], [toxic[i] for i in kept]
    here = float(np.clip(np.mean(toxic) if toxic else 0.0, 1e-4, 1 - 1e-4))
    share = here if share is None else float(np.clip(share, 1e-4, 1 - 1e-4))
    logit = lambda x: np.log(x / (1 - x))
    by_class = [[i for i, y in enumerate(toxic) if y == c] for c in (0, 1)]
    halves = [sorted(by_class[0][k::2] + by_class[1][k::2]) for k in (0, 1)]
    if any(len({toxic[i] for i in h}) < 2 for h in halves):
        field = _fit_words([], [])
        field.doc[0] = logit(share)
        return field
    x, target = [], []
    for fitted, scored in (halves, halves[::-1]):
        part = _fit_words([texts[i] for i in fitted], [toxic[i] for i in fitted])
        x += [_doc_features(p) for p in _word_marginals(part, [texts[i] for i in scored])]
        target += [toxic[i] for i in scored]
    field = _fit_words(texts, toxic)
    x, target = np.stack(x), np.array(target, float)
    field.center, field.scale = x.mean(0), x.std(0) + 1e-6
    design = np.column_stack([np.ones(len(x)), (x - field.center) / field.scale])
    w = np.zeros(3)
    for _ in range(30):  # Newton steps of a ridge-penalised logistic regression
        q = 1 / (1 + np.exp(-design @ w))
        h = (design * (q * (1 - q))[:, None]).T @ design + 0.1 * np.eye(3)
        w = w + np.linalg.solve(h, design.T @ (target - q) - 0.1 * w)
    field.doc = w + np.array([logit(share) - logit(here), 0.0, 0.0])
    return field


def _fit_words(texts: list[str], toxic: list[int], steps: int = 25) -> Field:
    """A field fitted to the word tags that the labels give; its scores are not set yet."""
    field = Field(np.zeros(FEATURES), -4.0, np.zeros((2, 2)), np.zeros(2), np.zeros(3), np.zeros(2),
                  np.ones(2))
    if not texts:
        return field
    marks = _lexicon(texts, toxic)
    cache: dict[str, list[int]] = {}
    feats = lambda w: cache.get(w) or cache.setdefault(w, features(w))
    kept_texts, tags = [], []
    for text, label in zip(texts, toxic):
        y = [label and any(f in marks for f in feats(w)) for w in WORD.findall(text)]
        if not label or any(y):  # a toxic text without a marked word says nothing of its words
            kept_texts.append(text)
            tags += y
    words, reset, _ = _chain(kept_texts)
    flat = [feats(w) for ws in words for w in ws]
    y = np.array(tags, float)
    row = np.repeat(np.arange(len(flat)), [len(f) for f in flat])
    col = np.fromiter((f for fs in flat for f in fs), np.int64, len(row))
    used, col = np.unique(col, return_inverse=True)
    theta = np.concatenate([np.zeros(len(used)), [-4.0], np.zeros(6)])  # emission, bias, transition, start
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    prev = np.concatenate([[0.0], y[:-1]])
    inner = ~reset
    for step in range(1, steps + 1):
        w, bias, tr, st = theta[:-7], theta[-7], theta[-6:-2].reshape(2, 2), theta[-2:]
        e = np.exp(np.clip(np.bincount(row, w[col], len(y)) + bias, -30, 30))
        t, s = np.exp(tr), np.exp(st)
        alpha, beta = _ratios(e, reset, t, s)
        p = alpha * beta / (1 + alpha * beta)
        before = np.concatenate([[1.0], alpha[:-1]])
        pair = np.stack([np.full(len(e), t[0, 0]), t[0, 1] * e * beta,
                         before * t[1, 0], before * t[1, 1] * e * beta])
        pair /= pair.sum(0)
        gold = np.stack([(1 - prev) * (1 - y), (1 - prev) * y, prev * (1 - y), prev * y])
        d = y - p
        grad = np.concatenate([np.bincount(col, d[row], len(used)), [d.sum()],
                               (gold - pair)[:, inner].sum(1), [-d[reset].sum(), d[reset].sum()]])
        grad -= 0.01 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta + 0.3 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    field.emission[used] = theta[:-7]
    field.bias, field.transition, field.start = theta[-7], theta[-6:-2].reshape(2, 2), theta[-2:]
    return field


class _Scores(dict):
    """Emission scores of words, remembered up to a bound."""

    def __init__(self, field: Field):
        self.field = field

    def __missing__(self, word: str) -> float:
        if len(self) > 300_000:
            self.clear()
        x = float(self.field.bias + self.field.emission[features(word)].sum())
        if len(word) <= 64:
            self[word] = x
        return x


def _word_marginals(field: Field, texts: list[str], scores: _Scores | None = None) -> list[np.ndarray]:
    scores = _Scores(field) if scores is None else scores
    words, reset, at = _chain(texts)
    log_e = np.fromiter((scores[w] for ws in words for w in ws), float, len(reset))
    p = marginals(field, log_e, reset) if len(log_e) else log_e
    return [p[a:b] for a, b in zip(at[:-1], at[1:])]


def _doc_features(p: np.ndarray) -> np.ndarray:
    if not len(p):
        return np.array([-12.0, 0.0])
    top = min(max(p.max(), 1e-6), 1 - 1e-6)
    return np.array([np.log(top / (1 - top)), np.log1p(p.sum())])


def doc_scores(field: Field, marginal: list[np.ndarray]) -> np.ndarray:
    x = np.stack([_doc_features(p) for p in marginal]) if marginal else np.empty((0, 2))
    z = field.doc[0] + ((x - field.center) / field.scale) @ field.doc[1:]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def spans(text: str, p: np.ndarray, least: float = 0.5) -> list[dict]:
    """Runs of words with a marginal of at least ``least``: character offsets and largest marginal."""
    if not (p >= least).any():
        return []
    out: list[dict] = []
    last = -2
    for i, m in enumerate(WORD.finditer(text)):
        if p[i] >= least:
            if last == i - 1:
                out[-1]["end"], out[-1]["prob"] = m.end(), max(out[-1]["prob"], float(p[i]))
            else:
                out.append({"start": m.start(), "end": m.end(), "prob": float(p[i])})
            last = i
    return out


SPANS = "array<struct<start: int, end: int, prob: double>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("prob", pa.float64())]))


def sample(docs: DataFrame, labels: DataFrame,
           bound: int = SAMPLE) -> tuple[list[str], list[int], float]:
    """At most ``bound`` labelled training rows of each class, chosen by a hash of the id (which is no input of a score),
    and the share of toxic ones among all labelled training rows. Rows without an id or a label are not
    learned from; a document labelled both ways counts once in either class, and once in the share for each label."""
    rows = labels.select("doc_id", "toxic").where(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    texts, toxic = [], []
    for y in (0, 1):
        # ids first, so that no text is sorted or shuffled
        ids = (rows.where(F.col("toxic") == y).select("doc_id", F.xxhash64("doc_id").alias("h"))
               .orderBy("h", "doc_id").limit(bound).select("doc_id").distinct())
        part = docs.join(F.broadcast(ids), "doc_id").select(
            "doc_id", F.coalesce("text", F.lit("")).alias("text")).limit(2 * bound).collect()
        part.sort(key=lambda r: (r[0], r[1]))
        texts += [r[1] for r in part]
        toxic += [y] * len(part)
    order = np.random.Generator(np.random.PCG64(7)).permutation(len(texts))
    share = rows.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    return [texts[i] for i in order], [toxic[i] for i in order], share


def held_out(doc_id):
    """Whether a document's label is not learned from; a null id has no remainder and is not held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def score(docs: DataFrame, field: Field, extra: list[str] | None = None) -> DataFrame:
    """``docs`` columns ``extra`` (default doc_id) with toxic_score and toxic_spans.

    Defined cases: a null or empty text has no words, no spans and the score of
    such a text; ties and repeated rows are scored alike; an empty table gives
    no rows. Other columns are carried or not read.
    """
    extra = ["doc_id"] if extra is None else extra
    fields = [docs.schema[c] for c in extra]
    shared = docs.sparkSession.sparkContext.broadcast(field)  # FEATURES weights: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scores = _Scores(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [t or "" for t in part.column(0).to_pylist()]
                p = _word_marginals(model, texts, scores)
                found = [spans(t, x) for t, x in zip(texts, p)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(1).field(i) for i in range(len(extra))],
                     pa.array(doc_scores(model, p)), pa.array(found, _SPAN_TYPE)],
                    names=[*[f"c{i}" for i in range(len(extra))], "toxic_score", "toxic_spans"])

    given = docs.select(F.col("text").alias("t"),
                        F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(extra)]).alias("c"))
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(fields))
    out = in_arrow(given, run, f"{schema}, toxic_score double, toxic_spans {SPANS}")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(extra)], "toxic_score",
                      "toxic_spans")


def model(spark, docs: DataFrame, sf_dir: str) -> Field:
    return fit(*sample(docs, read(spark, sf_dir, "labels")))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = score(docs, model(spark, docs, sf_dir))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                      F.col("toxic_score").alias("score"),
                      (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"),
                      F.col("toxic_spans").alias("spans"))


def toxicity_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns.

    The field learns from the whole documents' labelled training rows.
    """
    field = model(spark, docs, sf_dir)
    work = docs.select("text", F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    return score(work, field, ["doc"]).where(F.col("toxic_score") < THRESHOLD).select("doc.*")
