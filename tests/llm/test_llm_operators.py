"""The corpus operators against brute force, on hand rows with every awkward case."""

import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from courtside.llm import (decontaminate, exact_dedup, kneser_ney, licences, setsketch, sharding,
                           token_counts, toxicity, unigram, warc)
from courtside.llm.components import components
from courtside.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
# columns whose names clash with those the operators use inside
SCHEMA = ("doc_id bigint, text string, source string, kept boolean, h bigint, w string, key bigint, "
          "node string, row int, n int, comp int, start int, win int, size int, doc string, c0 int")
EXTRA = (True, 1, "w", 2, "n", 3, 4, 5, 6, 7, 8, "d", 9)


def rng_text(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice("abcdefghij") + r.choice("xyz") + str(r.randint(0, 60)) for _ in range(n))


LONG = rng_text(5, 20_000)
BASE = rng_text(1, 200)
ITEM = rng_text(9, 20)
TEXTS = [
    (1, None, "a"), (2, "", "a"), (3, "  \t\n", None), (4, "One two", "b"), (5, "one TWO", "b"),
    (6, "one two", "a"), (6, "one two", "a"), (None, "one two", "a"), (7, BASE, "a"),
    (8, BASE.upper(), "a"), (9, BASE + " tail of five more words", "a"),
    (10, BASE.replace("a", "q", 400), "a"), (11, LONG, "b"), (12, LONG + " end", "a"),
    (13, "Ünïcode ÀÉ text with Ünïcode", "a"), (14, "start " + ITEM + " end", "a"),
    (15, ITEM, "c"), (16, "x" * 5000, "c"), (17, "▁ marker  two blanks ", "c"), (18, "😀 \x00 odd", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*t, *EXTRA) for t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("1 = 0")


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def test_exact_dedup(docs, none):
    rows = exact_dedup.exact_dedup(docs).collect()
    groups = {}
    for i, t, _ in TEXTS:
        groups.setdefault(low(t), []).append(i)
    assert len(rows) == len(TEXTS)
    want = sorted((i if i is not None else -1, max(x for x in groups[low(t)] if x is not None),
                   len(groups[low(t)])) for i, t, _ in TEXTS)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.keep_id, r.group_size) for r in rows) == want
    assert sum(r.kept for r in rows) == len(groups)  # repeated rows: one is kept
    assert exact_dedup.exact_dedup(none).count() == 0
    stage = exact_dedup.exact_dedup_stage(None, docs, SF)
    assert stage.columns == docs.columns and stage.count() == len(groups)


def brute_contamination(texts, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    for i, t in texts:
        w, hit, found = words(t), set(), set()
        for item, it in items:
            iw = words(it)
            n = min(13, len(iw))
            for s in range(len(iw) - n + 1 if iw else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == iw[s:s + n]:
                        hit |= set(range(p, p + n))
                        if item is not None:
                            found.add(str(item))
        yield (-1 if i is None else i, len(w), len(hit), sorted(found))


def test_contamination(spark, docs, none):
    items = [(1, ITEM), (2, ITEM), (10, None), (11, ""), (12, "ONE, two!"), (None, "Ünïcode ÀÉ"), (13, "never seen")]
    bench = spark.createDataFrame([(a, b, "x") for a, b in items], "item_id int, text string, win string")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_hit, r["items"])
                 for r in decontaminate.contamination(docs, bench).collect())
    assert got == sorted(brute_contamination([(i, t) for i, t, _ in TEXTS], items))
    assert decontaminate.contamination(none, bench).count() == 0
    clean = decontaminate.contamination(docs, bench.where("1 = 0")).collect()
    assert len(clean) == len(TEXTS) and not any(r.n_hit for r in clean)


def test_contamination_in_blocks(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(k, rng_text(9, 20 + k)) for k in range(6)], "item_id int, text string")
    whole = sorted(map(str, decontaminate.contamination(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 400)
    assert sorted(map(str, decontaminate.contamination(docs, bench).collect())) == whole


def brute_components(texts):
    sets = []
    for _, t in texts:
        w = low(t).encode("utf-8", "surrogatepass").split()
        k = min(5, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    ids = {}
    for x, (i, _) in enumerate(texts):
        if i is not None:
            ids.setdefault(find(x), []).append(i)
    return [(-1 if i is None else i, len(sets[x]), min(ids[find(x)])) for x, (i, _) in enumerate(texts)]


def key(rows):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id) for r in rows)


def test_near_duplicates(docs, none):
    assert key(setsketch.near_duplicates(docs).collect()) == sorted(
        brute_components([(i, t) for i, t, _ in TEXTS]))
    assert setsketch.near_duplicates(none).count() == 0
    stage = setsketch.near_dedup_stage(None, docs, SF)
    assert stage.columns == docs.columns


def mutants(n):
    """Copies of one text with ever more edits, and of parts of it: many cross 0.75 only by chains."""
    r = random.Random(3)
    out = []
    for k in range(n):
        w = BASE.split()
        for _ in range(k % 12):
            w[r.randrange(len(w))] = f"edit{r.randrange(10 ** 6)}"
        cut = r.randrange(60) if k % 3 == 0 else 0
        out.append((k, " ".join(w[cut:])))
    return out


@pytest.mark.parametrize("a_member", [256, 0])
def test_near_duplicates_in_one_bucket(spark, monkeypatch, a_member):
    monkeypatch.setattr(setsketch, "PAIRS_A_MEMBER", a_member)  # 0: as stars for as long as can be
    texts = mutants(120)
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert key(setsketch.near_duplicates(df).collect()) == sorted(brute_components(texts))


def test_sketch_estimates_and_merges():
    r = np.random.default_rng(0)
    a = setsketch.scramble(r.integers(0, 1 << 62, 3000).astype(np.uint64))
    b = np.concatenate([a[:2400], setsketch.scramble(r.integers(0, 1 << 62, 600).astype(np.uint64))])
    sa, sb, union = setsketch.sketch_sets([np.unique(a), np.unique(b), np.union1d(a, b)])
    assert (setsketch.merge(sa, sb) == union).all()
    grid = np.linspace(0, 1, 101)
    ll = setsketch.joint_log_likelihood(np.array([(sa > sb).sum()]), np.array([(sa < sb).sum()]),
                                        np.array([(sa == sb).sum()]), np.array([3000.0]), np.array([3000.0]), grid)
    assert abs(grid[ll.argmax()] - 2400 / 3600) < 0.12


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a bigint, b bigint")
    got = {}
    for r in components(links, "t").collect():
        got.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == [list(range(61)), [100, 101]]
    assert components(links.where("a < 0"), "t").count() == 0


def test_shards(docs, none):
    rows = sharding.stratified_shards(docs, n_shards=4).collect()
    assert len(rows) == len(TEXTS)
    per = [[r for r in rows if r.shard == s] for s in range(4)]
    assert {len(p) for p in per} == {len(TEXTS) // 4}
    assert all(sorted(r.slot for r in p) == list(range(len(p))) for p in per)
    for s in {t[2] for t in TEXTS}:  # every shard has its share of every source
        n = sum(t[2] == s for t in TEXTS)
        assert all(abs(sum(r.stratum == s for r in p) - n / 4) <= 1.5 for p in per)
    crc = {(i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t, _ in TEXTS}
    assert {(r.doc_id, r.text_crc32, r["size"]) for r in rows} == crc
    again = sharding.stratified_shards(docs.repartition(5), n_shards=4).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert sharding.stratified_shards(none).count() == 0


def test_field_messages():
    r = np.random.default_rng(0)
    n = 300
    e, reset = np.exp(r.normal(size=n)), np.zeros(n, bool)
    reset[[0, 5, 140, 260]] = True
    t, s = np.exp(r.normal(size=(2, 2))), np.exp(r.normal(size=2))
    alpha, beta = toxicity._ratios(e, reset, t, s)
    x = np.ones(2)
    for i in range(n):
        m = np.array([s, s]) if reset[i] else t
        x = (x / x.sum()) @ m * np.array([1, e[i]])
        assert math.isclose(alpha[i], x[1] / x[0], rel_tol=1e-9)
    x = np.ones(2)
    for i in range(n - 1, -1, -1):
        assert math.isclose(beta[i], x[1] / x[0], rel_tol=1e-9)
        m = np.array([s, s]) if reset[i] else t
        x = m @ (np.array([1, e[i]]) * x)
        x /= x.sum()


def test_toxicity_held_out(spark, docs, none):
    r = random.Random(1)
    plain = [f"w{i}q" for i in range(400)]
    texts, toxic = [], []
    for i in range(400):
        w = [r.choice(plain) for _ in range(r.randint(5, 60))]
        y = int(i % 4 == 0)
        if y:
            w[r.randrange(len(w))] = r.choice(["Idiotx", "scumly", "loserish"])
        texts.append(" ".join(w))
        toxic.append(y)
    texts = [re.sub(r"\d", lambda m: "abcdefghij"[int(m.group())], t) for t in texts]
    field = toxicity.fit(texts[:300], toxic[:300])
    p = toxicity._word_marginals(field, texts[300:])
    s = toxicity.doc_scores(field, p)
    assert ((s >= 0.3) == np.array(toxic[300:])).mean() > 0.95
    hit = next(i for i in range(100) if toxic[300 + i])
    found = [texts[300 + hit][x["start"]:x["end"]] for x in toxicity.spans(texts[300 + hit], p[hit])]
    assert any(w in x for x in found for w in ("Idiotx", "scumly", "loserish"))
    rows = toxicity.score(docs, field).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.toxic_score <= 1 for r in rows)
    assert toxicity.score(none, field).count() == 0
    one = toxicity.fit(["a"], [1])
    assert toxicity.score(docs, one).count() == len(TEXTS)
    empty = toxicity.fit([], [])
    assert toxicity.score(docs, empty).count() == len(TEXTS)


TINY = {c: (i + 256, -2.0 - i / 10) for i, c in enumerate(
    ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "é", "▁▁"])}


def test_viterbi_is_best():
    model = unigram.make(TINY, {i: i for i in range(256)}, 256 + len(TINY))
    score = {p.encode(): s for p, (_, s) in TINY.items()}

    def best(raw):  # by all ways to the end
        n, top = len(raw), {0: 0.0}
        for i in range(n):
            if i not in top or raw[i] & 0xC0 == 0x80:
                continue
            size = 1 if raw[i] < 0x80 else 2 if raw[i] < 0xE0 else 3 if raw[i] < 0xF0 else 4
            ways = [(i + size, model.unknown)] + [
                (i + len(p), s) for p, s in score.items() if raw.startswith(p, i)]
            for to, s in ways:
                top[to] = max(top.get(to, -1e9), top[i] + s)
        return top[n]

    def cost(ids, raw):
        total, at = 0.0, 0
        for i in ids:
            if i >= 256:
                total, at = total + model.score[i], at + len(model.text[i])
            else:
                total += model.unknown if raw[at] & 0xC0 != 0x80 else 0
                at += 1
        return total
    r = random.Random(2)
    texts = ["".join(r.choice("abcé d😀") for _ in range(r.randint(0, 70))) for _ in range(150)]
    for t, ids in zip(texts, unigram.Encoder(model).encode(texts)):
        raw = (" " + t).replace(" ", "▁").encode() if t else b""
        assert math.isclose(cost(ids.tolist(), raw), best(raw) if raw else 0.0, abs_tol=1e-9)
        assert unigram.decode(model, ids.tolist()) == t
    with pytest.raises(ValueError):
        unigram.make({"a▁": (256, -1.0)}, {i: i for i in range(256)}, 257)


def test_encode_documents(docs, none):
    model = unigram.load()
    rows = unigram.encode_documents(docs, model).collect()
    assert len(rows) == len(TEXTS)
    assert all(r.round_trip for r in rows if r.doc_id != 17) and not any(
        r.round_trip for r in rows if r.doc_id == 17)
    assert all(r.n_ids == 0 for r in rows if r.doc_id in (1, 2))
    assert unigram.encode_documents(none, model).count() == 0


def test_warc_round_trip(spark):
    big = "<p>" + "x" * 200
    pages = [(1, "http://a", big), (2, "http://b\r\nX: y", big), (3, None, None), (4, "u", ""), (None, "u", big),
             (5, "u", "short"), (6, "u", "short"), (7, "u", LONG), (7, "u", LONG), (8, "é", "\r\n\r\né" * 90)]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id bigint, url string, html string, digest int")
    manifest, folder = warc.archive_pages(df.repartition(2))
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0)
                 for r in warc.read_archives(manifest, folder).collect())
    want = sorted((i or 0, len((h or "").encode()), "revisit" if h == big and i != 1 else "response",
                   1 if h == big and i != 1 else 0) for i, _, h in pages)
    assert got == want
    assert warc.archive_pages(df.where("1 = 0"))[0].count() == 0


def test_kneser_ney(spark, docs, none):
    texts = [("a b a b c",), ("a b b",), (None,), ("",), ("c a B",), ("a b",)]
    model = kneser_ney.train(spark.createDataFrame(texts, "text string"), 4)
    seen = [kneser_ney.tokens(t) for (t,) in texts]
    words = sorted({w for s in seen for w in s})
    assert model.train_tokens == sum(map(len, seen)) and model.distinct == len(words)
    bigrams, ctx, cont, follows = {}, {}, {}, {}
    for s in seen:
        for v, w in zip([kneser_ney.START, *s], s):
            bigrams[v, w] = bigrams.get((v, w), 0) + 1
    for (v, w), c in bigrams.items():
        ctx[v] = ctx.get(v, 0) + c
        cont.setdefault(v, []).append(c)
        follows[w] = follows.get(w, 0) + 1
    d = kneser_ney.discounts([sum(c == i for c in bigrams.values()) for i in (1, 2, 3, 4)])
    e = kneser_ney.discounts([sum(c == i for c in follows.values()) for i in (1, 2, 3, 4)])
    total = sum(follows.values())
    mass = sum(e[min(c, 3)] for c in follows.values()) / total

    def p(v, w):
        f = follows.get(w, 0)
        one = max(f - e[min(f, 3)], 0) / total + mass / (len(words) + 1)
        if v not in ctx:
            return one
        c = bigrams.get((v, w), 0)
        return max(c - d[min(c, 3)], 0) / ctx[v] + sum(d[min(x, 3)] for x in cont[v]) / ctx[v] * one
    for v in (kneser_ney.START, b"a", b"b", b"zz"):
        assert math.isclose(sum(p(v, w) for w in words) + p(v, b"unseen"), 1.0, abs_tol=1e-9)
    rows = kneser_ney.score_documents(docs, model).collect()
    by = {i: t for i, t, _ in TEXTS}
    for r in rows:
        s = kneser_ney.tokens(by[r.doc_id] if r.doc_id is not None else "one two")
        assert r.n_tokens == len(s)
        assert math.isclose(r.score, sum(math.log10(p(v, w)) for v, w in zip([kneser_ney.START, *s], s)),
                            rel_tol=1e-9)
    assert kneser_ney.score_documents(none, model).count() == 0
    untrained = kneser_ney.train(none.select("text"), 4)
    assert kneser_ney.score_documents(docs, untrained).count() == len(TEXTS)


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("texts", [
    ["a b a b c", "a b b", None, "", "c a B", "a b", "b a b a b c a b a", "a b c a b b"] + ["the end"] * 300,
    ["a"], [""], ["a b c"]])
def test_kneser_ney_order(spark, docs, none, order, texts):
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), 4, order)
    start = (kneser_ney.START,) * (order - 1)
    seen = [kneser_ney.tokens(t) for t in texts]
    vocabulary = sorted({w for s in seen for w in s})
    counts = {order: {}}
    for s in seen:
        for i in range(len(s)):
            gram = (*start, *s)[i:i + order]
            counts[order][gram] = counts[order].get(gram, 0) + 1
    for k in range(order - 1, 0, -1):  # in how many different n-grams each is the suffix
        counts[k] = {}
        for gram in counts[k + 1]:
            counts[k][gram[1:]] = counts[k].get(gram[1:], 0) + 1
    discounts, after = {}, {}
    for k, found in counts.items():
        discounts[k] = kneser_ney.discounts([sum(c == i for c in found.values()) for i in (1, 2, 3, 4)])
        for gram, c in found.items():
            after.setdefault(gram[:-1], []).append(c)

    def p(h, w):
        k = len(h) + 1
        if h not in after:
            return p(h[1:], w)
        c, d, total = counts[k].get((*h, w), 0), discounts[k], sum(after[h])
        below = p(h[1:], w) if h else 1 / (len(vocabulary) + 1)
        return max(c - d[min(c, 3)], 0) / total + sum(d[min(x, 3)] for x in after[h]) / total * below

    def histories(s):
        return [(*start, *s)[i:i + order - 1] for i in range(len(s))]
    for h in {h for s in seen for h in histories(s)} | {(b"zz",) * (order - 1)}:
        assert math.isclose(sum(p(h, w) for w in vocabulary) + p(h, b"unseen"), 1.0, abs_tol=1e-9)
    asked = [*texts, "a b zz a b c a b", "b b b a", "zz zz", "the the end end"]
    rows = kneser_ney.score_documents(spark.createDataFrame(list(enumerate(asked)), "doc_id bigint, text string"),
                                      model).collect()
    assert len(rows) == len(asked)
    for r in rows:
        s = kneser_ney.tokens(asked[r.doc_id])
        assert math.isclose(r.score, sum(math.log10(p(h, w)) for h, w in zip(histories(s), s)), rel_tol=1e-9)
    assert kneser_ney.score_documents(docs, kneser_ney.train(none.select("text"), 4, order)).count() == len(TEXTS)


def test_kneser_ney_coded():
    r = random.Random(3)
    parts = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0", "a", "B", "É", "İ", "z9", "\x00"]
    texts = [None, "", " "] + ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(500)]
    for column in (pa.array(texts), pa.array(["x", *texts]).slice(1)):
        hashes, run, sizes = kneser_ney.coded(column, 3)
        words = [w for t in texts for w in [kneser_ney.START] * 2 + kneser_ney.tokens(t)]
        assert hashes[run].tolist() == [xxhash.xxh3_64_intdigest(w) for w in words]
        assert sizes.tolist() == [len(kneser_ney.tokens(t)) for t in texts]
        assert [t for part in kneser_ney.slices(column, 7) for t in part.to_pylist()] == texts


def test_kneser_ney_disk(spark):
    """A model's files take less than a 64-bit key for each n-gram; no shuffle files stay behind."""
    r = random.Random(5)
    ids = [r.randrange(2000) for _ in range(700_000)]
    texts = [" ".join(map(str, ids[i:i + 1000])) for i in range(0, len(ids), 1000)]
    start = [kneser_ney.START] * 2
    run = [[*start, *kneser_ney.tokens(t)] for t in texts]
    known = [{tuple(s[i:i + k]) for s in run for i in range(3 - k, len(s) - k + 1)} for k in (1, 2, 3)]

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        sizes = 0
        while files.hasNext():
            f = files.next()
            sizes += f.length() if f.getName().startswith("shuffle_") else 0
        return sizes
    before = shuffled()
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2), 1, 3)
    assert shuffled() <= before
    folder = model.folder.removeprefix("file:")
    size = sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder))
    assert size < 8 * (len(known[2]) + len(known[1])) + 24 * len(known[0])


def test_kneser_ney_registered_order(spark):
    got = {r.doc_id: r.score for r in QUERIES["op8_kneser_ney"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    train = docs.where(~kneser_ney.held_out(docs.doc_id)).select("text")
    assert kneser_ney.ORDER >= 3
    want = kneser_ney.score_documents(docs, kneser_ney.train(train, 5, kneser_ney.ORDER)).collect()
    assert len(got) == len(want) and all(math.isclose(got[r.doc_id], r.score, rel_tol=1e-9) for r in want)


def test_token_counts(docs, none):
    count = token_counts.Counter(token_counts.load_ranks())
    r = random.Random(1)
    parts = ["a", " ", "'", "re", "  ", "\n", "9", "é", "!!", " the", "ll", "\n\n "]
    for _ in range(300):
        tree = token_counts.SegmentTree("".join(r.choice(parts) for _ in range(r.randint(0, 300))), count)
        for _ in range(6):
            tree.edit(r.randint(-2, len(tree.text) + 3), r.randint(0, 12),
                      "".join(r.choice(parts) for _ in range(r.randint(0, 6))))
            assert tree.tokens == len(count.encoding.encode_ordinary(tree.text))
    edited = token_counts.derived_edits(docs)
    got = token_counts.count_edited(edited, token_counts.load_ranks()).collect()
    assert len(got) == len(TEXTS)
    for row in edited.collect():
        text = row.text or ""
        for e in row.edits:
            at = min(max(e["at"] or 0, 0), len(text))
            text = text[:at] + (e["put"] or "") + text[at + (e["drop"] or 0):]
        want = len(count.encoding.encode_ordinary(text))
        assert any(g.doc_id == row.doc_id and g.n_tokens == want and g.n_chars == len(text) for g in got)
    long = next(g for g in got if g.doc_id == 11)
    assert long.n_reencoded < 100 < long.n_segments
    assert token_counts.count_edited(token_counts.derived_edits(none), token_counts.load_ranks()).count() == 0


def test_licences(spark, docs, none):
    mit = licences.KNOWN["MIT"]
    texts = [(1, mit), (2, mit.upper().replace("LICENSE", "licence").replace(" ", "\n")),
             (3, "Copyright (c) 2001 Somebody\n" + mit), (4, mit + " and more"), (5, None), (6, "")]
    df = spark.createDataFrame([(*t, "x") for t in texts], "doc_id bigint, text string, licence string")
    known = licences.known_licences(spark)
    got = {r.doc_id: r.licence for r in licences.scan(df, known).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: "MIT", 4: None, 5: None, 6: None}
    assert licences.scan(docs, known).count() == len(TEXTS)
    assert licences.scan(none, known).count() == 0
    assert licences.scan(df, known.where("1 = 0")).where("licence IS NOT NULL").count() == 0


def test_licence_notices(spark, none):
    mit, known = licences.KNOWN["MIT"], licences.known_licences(spark)
    with open(f"{licences.TEXTS_DIR}/Apache-2.0.txt", encoding="utf-8") as f:
        apache = f.read()
    want = {
        1: ("Some prose.\nReleased under the MIT License.", None, ["notice:MIT"]),
        2: ("// Licensed under the\r\n// Apache License, Version 2.0\r\n//\r\n// prose", None, ["notice:Apache-2.0"]),
        3: ("one\nThis work is licensed under the GNU General Public License, version 3.\n\nLicence: CC-BY-NC 4.0\ntwo",
            None, ["notice:CC-BY-NC-4.0", "notice:GPL-3.0"]),
        4: ("prose before\n\n" + mit + "\n\nprose after", None, ["part:MIT"]),
        5: (apache, "Apache-2.0", ["part:Apache-2.0"]), 6: (mit.partition("\n\n")[2], "MIT", ["part:MIT"]),
        7: ("the permission to speak of a license", None, []), 8: (None, None, []), 9: ("", None, []),
        10: ("Not released under the MIT License.", None, []),
    }
    rows = [(i, t) for i, (t, _, _) in want.items()] + [(1, want[1][0])]
    got = licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), known).collect()
    assert len(got) == len(rows)
    assert all((r.licence, r.notices) == want[r.doc_id][1:] for r in got)
    own = spark.createDataFrame([("mine", "Free for all."), ("mine", "Other\n\nFree for all, says the permission " + "x" * 60)],
                                "licence string, text string")
    found = licences.scan(spark.createDataFrame([(1, "a\nfree for all\nb")], "doc_id bigint, text string"), own)
    assert [r.notices for r in found.collect()] == [["mine"]]
    given = {r.doc_id: r.notices for r in QUERIES["op7_licence_scan"](spark, SF).collect()}
    lines = {"Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.",
             "Released under the MIT License.",
             "This work is licensed under the GNU General Public License, version 3."}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    has = {r.doc_id for r in docs if lines & set((r.text or "").split("\n"))}
    assert has and {i for i, n in given.items() if n} == has


def test_licence_copyright_lines(spark):
    import textwrap

    isc = licences.KNOWN["ISC"]
    lines = ["Copyright (c) 2001 Somebody", "Copyright Jane Doe 2020", "Copyright Jane Doe", "Copyright The X Authors",
             "Portions Copyright (c) 1999 Somebody", "portions copyright Jane Doe", "COPYRIGHT 2020, JANE DOE",
             " * Copyright: Jane Doe", "(c) 2020 Jane Doe", "© Jane Doe", "Copyright <year> <owner>"]
    copies = {("ISC", line): line + "\n\n" + isc for line in lines}
    for name in ("Apache-2.0", "MPL-2.0", "CC0-1.0"):
        with open(f"{licences.TEXTS_DIR}/{name}.txt", encoding="utf-8") as f:
            text = f.read()
        for width in (*range(30, 90, 7), 10 ** 6):
            copies[name, width] = "\n\n".join(
                p if p.lstrip().startswith("Copyright [")
                else textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in text.split("\n\n"))
    copies["MIT", 0] = licences.KNOWN["MIT"].replace("the above copyright", "the above\ncopyright").replace(
        "OR COPYRIGHT HOLDERS", "OR\nCOPYRIGHT HOLDERS")
    names = list(copies)
    known = spark.createDataFrame(
        [(n, t) for n, several in licences.known_texts().items() for t in several], "licence string, text string")
    df = spark.createDataFrame([(i, copies[k]) for i, k in enumerate(names)], "doc_id bigint, text string")
    got = {names[r.doc_id]: r.licence for r in licences.scan(df, known).collect()}
    assert {k for k in names if got[k] != k[0]} == set()
    items = "the following:\n(c) You must keep all notices\nand more"
    kept = spark.createDataFrame([(items,)], "text string").select(licences.canonical(licences.F.col("text"))).first()[0]
    assert kept == "the following c you must keep all notices and more"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rel = con.sql(SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    want = sorted((tuple(dict(zip(rel.columns, r))[c] for c in cols) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == want


def test_pipeline(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "decontaminate", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SF)
        assert left.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in left.collect()]
    assert len({low(t) for _, t in texts}) == len(texts)
    assert all(a == b for a, _, b in brute_components(texts))
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(h and 20 * h >= n for _, n, h, _ in brute_contamination(texts, bench))
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in texts) and all(r.round_trip for r in got)
