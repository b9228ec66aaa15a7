"""Conversation repair, whitening and byte-level BPE against brute force."""

import hashlib
import itertools
import math
import random
import time
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import regex
import tiktoken

from courtside.llm import bpe, licences, repair, setsketch, token_counts, toxicity, unigram, warc, whitening
from courtside.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


# conversation repair

def dynamic(codes, start="N", ends="NA"):
    """Cheapest, then least, audit by going over the rows with the best of each state."""
    def inserted(now):
        for _ in range(4):
            for q, (c, a) in list(now.items()):
                for i in "ua":
                    to = repair.AFTER[i].get(q)
                    if to and (to not in now or (c + 3, a + "I") < now[to]):
                        now[to] = (c + 3, a + "I")
        return now

    now = inserted({start: (0, "")})
    for code in codes:
        new, late = {}, 3 if code.isupper() else 0
        for q, (c, a) in now.items():
            options = [(q, (c + 4, a + "D"))]
            if code != "d":
                if to := repair.AFTER.get(code.lower(), {}).get(q):
                    options.append((to, (c + late, a + "K")))
                options += [(repair.AFTER[i][q], (c + 3 + late, a + "R")) for i in "ua" if q in repair.AFTER[i]]
            for to, v in options:
                new[to] = min(v, new.get(to, v))
        now = inserted(new)
    return min((now[q] for q in ends if q in now), default=None)


def test_search_is_cheapest_and_least():
    for n in range(3):
        for codes in map("".join, itertools.product("suaxSUAXd", repeat=n)):
            assert repair.cheapest(codes) == dynamic(codes)
    r = random.Random(1)
    for _ in range(60):
        codes = "".join(r.choice("suaxSUAXduuaa") for _ in range(r.randint(5, 14)))
        for p, q in itertools.product(repair.STATES, repeat=2):
            assert repair.cheapest(codes, p, q) == dynamic(codes, p, q)


def brute_repair(rows):
    """The contract's rows from (conv_id, turn, role, text)."""
    left = {}
    for conv, turn, role, text in rows:
        mine = left.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        mine += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    for conv, mine in left.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, codes, faults = set(), "", []
        for turn, role, text in mine:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not end else "duplicate" if (role, text) in seen
                     else "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
            faults.append(fault)
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "d" if fault in ("blank", "duplicate") else code.upper() if fault else code
        cost, audit = dynamic(codes)
        lines, i, place, odd = [], 0, 0, (len(audit) - audit.count("D")) % 2
        for letter in audit:
            name = ("user", "assistant")[(place - odd) % 2]
            if letter != "D":
                lines.append(f"{name}:" if letter == "I" else (mine[i][1] if letter == "K" else name) + ":" + mine[i][2])
                place += 1
            i += letter != "I"
        turns = {t for t, _, _ in mine if t is not None}
        yield (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"),
               faults.count("duplicate"), faults.count("truncated"),
               sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])),
               cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def repaired_rows(df):
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_repair_of_awkward_rows(spark):
    r = random.Random(4)
    said = ["Yes.", "No!", "well", "", " \t\n", "A long one. With more", "x" * 50_000, "Äö?", None, "Yes.  \n", "a\nb."]
    rows = [(conv, turn, r.choice(["user", "assistant", "system", "tool", "", None, "User"]), r.choice(said))
            for conv in [None, *range(40)] for turn in [None, *range(r.randint(0, 12))]]
    rows += [(100, t, ("user", "assistant")[t % 2], f"Turn {t % 300}.") for t in range(1500)]  # many blocks
    rows += [(101, None, "user", "same.")] * 700 + [(102, 5, "user", "again.")] * 40           # one key, many rows
    cols = "conv_id bigint, turn bigint, role string, text string, at int, start int, block int, code string"
    df = spark.createDataFrame([(*x, 1, 2, 3, "c") for x in rows], cols).repartition(5)
    got = repaired_rows(repair.repair(df, repair.damaged(df)))
    assert got == sorted(brute_repair(rows), key=repr)
    none = df.where("1 = 0")
    assert repair.repair(none, repair.damaged(none)).count() == 0


def test_repair_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{SF}/conversations.parquet'")
    con.sql(f"create table found as {SQL['op11_conversation_repair']}")
    names = "conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256"
    assert repaired_rows(QUERIES["op11_conversation_repair"](spark, SF)) == sorted(
        con.sql(f"select {names} from found").fetchall(), key=repr)


# whitening

@pytest.mark.parametrize("dims,rank", [(1, 1), (2, 2), (7, 7), (40, 40), (30, 11)])
def test_eigenvectors(dims, rank):
    r = np.random.default_rng(dims)
    m = r.standard_normal((dims, rank)) * np.linspace(0.01, 3, rank)
    a = m @ m.T
    values, axes = whitening.eigenvectors(a)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=0, atol=1e-13 * values[0])
    assert np.abs(axes.T @ axes - np.eye(dims)).max() < 1e-13
    assert np.abs(a @ axes - axes * values).max() < 1e-13 * values[0]


@pytest.mark.parametrize("a", [np.diag([0., 1, 2]), np.diag([1., 1, 1, 5]), np.eye(4) * 3, np.zeros((3, 3)),
                               np.ones((6, 6)), np.diag([2., 2, 1, 1, 0, 0])])
def test_repeated_eigenvalues(a):
    values, axes = whitening.eigenvectors(a)
    assert np.abs(a @ axes - axes * values).max() < 1e-13 and np.abs(axes.T @ axes - np.eye(len(a))).max() < 1e-13


def brute_whitening(rows, got, components=32):
    """Check rows of `whiten` against whole-number statistics and numpy's eigenvectors."""
    whole = [(i, v) for i, v in rows if v is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * Fraction(c)) + 1_000_000 for c in v] for _, v in whole]
    n, dims = len(x), len(x[0])
    sums = [sum(c) for c in zip(*x)]
    far = [[n * c - s for c, s in zip(v, sums)] for v in x]
    centred = np.array([[float(Fraction(c, n)) for c in v] for v in far])
    covariance = np.array([[float(Fraction(sum(v[i] * v[j] for v in far), n ** 3)) for j in range(dims)] for i in range(dims)])
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > values[0] * 1e-12).sum()))
    assert len(got) == n * k and all(r.n == n for r in got)
    deviations = {}
    for (i, _), v in zip(whole, far):
        deviations.setdefault(i, []).append(sum(c * c for c in v))
    for c in range(k):
        mine = [r for r in got if r.component == c + 1]
        want = centred @ axes[:, c] / math.sqrt(values[c])
        sign = np.sign(axes[:, c] @ (centred.T @ want))
        key = lambda p: (p[0] is not None, p[0] or 0, p[1])
        pairs = [sorted(((i, round(s * w, 7)) for (i, _), w in zip(whole, want * sign)), key=key) for s in (1, -1)]
        mine_rounded = sorted(((r.vec_id, r.whitened) for r in mine), key=key)
        assert any(all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-6 for a, b in zip(p, mine_rounded)) for p in pairs)
        assert all(r.deviation in deviations[r.vec_id] for r in mine)
        assert all(abs(r.explained / (values[c] / values.sum()) - 1) < 1e-9 for r in mine)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_whitening(spark):
    r = np.random.default_rng(2)
    rows = [(i, (r.standard_normal(6) * [5, 4, 3, 2, 1, 0.5]).tolist()) for i in range(60)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (70, None), (71, []), (72, [1.0, None, 2.0, 3.0, 4.0, 5.0]),
             (73, [float("nan")] * 6), (74, [float("inf"), *[1.0] * 5]), (75, [30.5, -20.0, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*x, 1, 2, "n") for x in rows],
                               "vec_id bigint, embedding array<double>, component int, n int, i string").repartition(3)
    got = whitening.whiten(df).collect()
    brute_whitening(rows, got)
    brute_whitening(rows, whitening.whiten(df, 2).collect(), 2)
    mixed = df.unionAll(spark.createDataFrame([(80, [1.0, 2.0], 1, 2, "n")], df.schema))  # another length: left out
    assert whitening.whiten(mixed).count() == len(got)


def test_whitening_without_variance(spark):
    cols = "vec_id bigint, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], cols)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, cols)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0])], cols)).collect()
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9)) for r in one) == [(1, 1, 1.0), (2, 1, 1.0)]
    with pytest.raises(Exception, match="or more"):
        whitening.whiten(spark.createDataFrame([(1, [1e30]), (2, [2.0])], cols)).collect()


def test_whitening_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    brute_whitening(rows, QUERIES["op12_whitening"](spark, SF).collect())


# byte-level BPE

@pytest.fixture(scope="module")
def library():
    table, pattern = bpe.load()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def test_bpe_of_awkward_texts(spark, library):
    r = random.Random(3)
    texts = [None, "", " ", "hello world  it's 12345 \n\n x", "é" * 300, "a" * 1000, "日本語のテキスト" * 60, "<|endoftext|>",
             " x y\x85z\x1c　  q", "😀" * 40, "one two one two " * 3000, "hello world  it's 12345 \n\n x",
             *["".join(r.choice(letters) for _ in range(n)) for letters in ("abcdefghijklmnop", "theandig", "é日a")
               for n in (63, 64, 65, 128, 129, 2000)], "\x00\x01\x7f", "ab" * 10_000]
    df = spark.createDataFrame([(None if i == 3 else i % 30, t, 1, "w", 2) for i, t in enumerate(texts)],
                               "doc_id bigint, text string, n int, word string, chunk int").repartition(3)
    rows = bpe.encode_documents(df).collect()
    key = lambda p: (p[0] is not None, p[0] or 0, p[1])
    assert sorted(((r.doc_id, r.ids) for r in rows), key=key) == sorted(
        ((None if i == 3 else i % 30, library.encode_ordinary(t or "")) for i, t in enumerate(texts)), key=key)
    assert all(r.n_tokens == len(r.ids) for r in rows)
    ranks = bpe.Ranks(bpe.load()[0])
    back = spark.createDataFrame([(r.ids,) for r in rows], "ids array<int>").select(bpe.decode(ranks, "ids").alias("t")).collect()
    assert sorted(bytes(r.t).decode() for r in back) == sorted(t or "" for t in texts)
    assert bpe.encode_documents(df.where("1 = 0")).count() == 0


def test_bpe_query(spark, library):
    got = {r.doc_id: r for r in QUERIES["op13_byte_bpe"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, r = library.encode_ordinary(d.text or ""), got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((d.text or "").encode()).hexdigest())


def test_bpe_digests_are_joined_in_blocks(library, monkeypatch):
    """Digests by word of texts with empty ones among them, whatever block a word is in, for less than splitting costs."""
    r = random.Random(5)
    some = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(1, 9))) for _ in range(20_000)]
    texts = ["", "", *["  ".join(r.choice(some) for _ in range(n)) for n in [1, 0, 700] * 300], "x", "", ""]
    table, pattern = bpe.load()
    pieces = [b""] * (max(table.values()) + 1)
    for k, i in table.items():
        pieces[i] = k
    split = regex.compile(pattern).findall
    began = time.process_time()
    words = [split(t) for t in texts]
    splitting = time.process_time() - began
    places = bpe._places()
    codes = np.array([places[w] for t in words for w in t], np.uint32)
    encoded = [library.encode_ordinary(w) for w in places]
    ids, cuts = np.array([i for w in encoded for i in w], np.int32), np.cumsum([0, *map(len, encoded)])
    ends = np.cumsum([0, *map(len, words)])
    decimals = pa.array([b",%d" % i for i in range(len(pieces))], pa.large_binary())
    began = time.process_time()
    parts = [(bpe._joined(decimals, ids, cuts), 1), (bpe._joined(pa.array(pieces, pa.large_binary()), ids, cuts), 0)]
    got = [bpe._hashed(p, codes, ends, skip) for p, skip in parts]
    assert time.process_time() - began < splitting
    assert got == [[hashlib.sha256(x).hexdigest() for x in column] for column in (
        [",".join(map(str, library.encode_ordinary(t))).encode() for t in texts], [t.encode() for t in texts])]
    monkeypatch.setattr(bpe, "WORDS", 97)
    assert got == [bpe._hashed(p, codes, ends, skip) for p, skip in parts]
    low = np.searchsorted(ends, 5000)  # some texts of a chunk
    assert got[0][low:] == bpe._hashed(parts[0][0], codes, ends[low:], 1)


def test_bpe_dictionary_with_a_gap_is_refused(spark):
    ranks, pattern = bpe.load()
    docs = spark.createDataFrame([(1, "one two three")], "n bigint, text string")
    chunked = bpe.chunks(docs, pattern)
    words = bpe.encoded_words(chunked, bpe.Ranks(ranks)).selectExpr("explode(at) at", "pieces").selectExpr(
        "shiftright(at, 30) chunk", f"cast(at % {bpe.PLACES} as int) pos", "pieces")
    twice = words.selectExpr("chunk", "least(pos, 1) pos", "pieces")  # as many rows, but one place twice
    folder = bpe._written(twice, "bpe-gap", by="chunk")
    with pytest.raises(Exception, match="not whole"):
        bpe._assemble(chunked, folder, [b""] * (max(ranks.values()) + 1), "digests").collect()


# what earlier operators promise

def test_near_dedup_keeps_one_row_of_a_group_whatever_its_ids(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight nine",
               "some other words that stand alone here and there")
    rows = [(1, a, 1), (1, a, 2), (1, a.upper(), 3), (None, b, 4), (None, b, 5), (None, b + " ", 6), (2, c, 7), (2, c, 7),
            (None, None, 8), (None, None, 9), (5, "", 10), (3, c, 11), (None, c, 12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, row int").repartition(3)
    kept = sorted(((r.doc_id, r.text, r.row) for r in setsketch.near_dedup_stage(None, df, SF).collect()), key=repr)
    groups = {a: [r for r in kept if r[1] and r[1].lower() == a], b: [r for r in kept if r[1] and r[1].strip() == b],
              c: [r for r in kept if r[1] == c]}
    assert [len(g) for g in groups.values()] == [1, 1, 1] and groups[c][0][0] == 2 and groups[a][0][0] == 1
    assert [r[2] for r in kept if not r[1]] == [10, 8, 9]
    assert setsketch.near_dedup_stage(None, df.where("1 = 0"), SF).count() == 0


def test_held_out_labels_have_no_influence(spark, tmp_path):
    """op4's query: scores and flags stay when the labels of held-out rows are turned over."""
    import os
    import shutil

    from pyspark.sql import functions as F
    folders = [str(tmp_path / x) for x in "ab"]
    for f in folders:
        os.makedirs(f)
        shutil.copy(f"{SF}/documents.parquet", f)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(
        F.col("toxic")).cast(labels.schema["toxic"].dataType))
    for f, t in zip(folders, (labels, turned)):
        t.toPandas().to_parquet(f"{f}/labels.parquet")
    rows = [{r.doc_id: r for r in QUERIES["op4_toxicity"](spark, f).collect()} for f in folders]
    assert rows[0].keys() == rows[1].keys() and len(rows[0]) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for i, r in rows[0].items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert r.score == rows[1][i].score and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1
    one = spark.createDataFrame([(None,), (3,)], "doc_id bigint").select(toxicity.held_out(F.col("doc_id")).alias("h"))
    assert [r.h for r in one.collect()][0] is False


def test_dictionary_sample_reaches_every_part_of_pages(spark):
    html = "".join(f"<p>{i:07d}</p>" for i in range(5000))
    df = spark.createDataFrame([(i, "u", html) for i in range(60)] + [(99, None, None)], "page_id bigint, url string, html string")
    pieces = [warc.parse(r)["payload"] for r in warc.sample_records(df)]
    at = [html.encode().find(p) for p in pieces if p]
    assert all(len(p) <= warc.SAMPLE_BYTES // warc.SAMPLE_ROWS for p in pieces)
    assert min(at) >= 0 and max(at) > len(html) // 2 and len(set(at)) > 30


def test_caches_of_texts_without_blanks_are_bounded():
    model = unigram.load()
    encoder = unigram.Encoder(model)
    encoder.CHARS = 10_000
    for i in range(40):
        encoder.encode([f"{i}" + "x" * 3000])
        assert sum(map(len, encoder.seen)) <= 10_000 + 3 * 3003
    hashes = setsketch.WordHashes()
    hashes[b"x" * 1000]
    assert not hashes and hashes[b"x"] and len(hashes) == 1


def test_kept_trees_take_batch_after_batch(spark, library):
    r = random.Random(8)
    texts = [None, "", "one two three " * 400, "a\n\nb  c" * 50, "é日 x" * 200]
    trees = token_counts.planted(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), token_counts.load_ranks())
    now = [t or "" for t in texts]
    for _ in range(2):
        edits = [[(r.randint(0, 900), r.randint(0, 30), r.choice(["", " new words", "x", "  "])) for _ in range(3)] for _ in texts]
        batch = spark.createDataFrame(list(enumerate(edits)), "doc_id bigint, edits array<struct<at: int, drop: int, put: string>>")
        trees = token_counts.edited(trees.join(batch, "doc_id"), token_counts.load_ranks())
        rows = {x.doc_id: x for x in trees.collect()}
        for i, (text, es) in enumerate(zip(now, edits)):
            for at, drop, put in es:
                at = min(at, len(text))
                text = text[:at] + put + text[at + drop:]
            now[i] = text
            assert rows[i].text == text and sum(rows[i].tokens) == rows[i].n_tokens == len(library_of_counts(text))
            assert "".join(text[a:b] for a, b in zip(np.cumsum([0, *rows[i].chars]), np.cumsum(rows[i].chars))) == text
        assert rows[2].n_reencoded < 60 < len(rows[2].chars)  # of 1200 words only those around edits


def library_of_counts(text):
    table = token_counts.load_ranks()
    if "counts" not in _ENCODINGS:
        _ENCODINGS["counts"] = tiktoken.Encoding("c", pat_str=token_counts.PATTERN, mergeable_ranks=table, special_tokens={})
    return _ENCODINGS["counts"].encode_ordinary(text)


_ENCODINGS = {}


# licence scan: plain Python over whole documents

def plain_canonical(text):
    import regex
    t = regex.sub(licences.COPYRIGHT_LINE, " ", (text or "").lower(), flags=regex.A)
    some = "|".join(sorted({v.replace(" ", r"\s+") for v, _ in licences.SPELLINGS}))
    if regex.search(some, t, flags=regex.A):
        t = regex.sub(r"\s+", " ", t, flags=regex.A)
        for variant, usual in licences.SPELLINGS:
            t = t.replace(variant, usual)
    return regex.sub(r"[^\p{L}\p{N}]+", " ", t).strip(" ")


def plain_parts(text):
    import regex
    return regex.split(r"\n(?:[^\p{L}\p{N}\n]*\n)+", regex.sub(r"\r\n?", "\n", text))


def plain_digest(canonical):
    import regex
    return regex.sub(licences.NOTICE, "notice: ", canonical)


def test_licence_scan_equals_plain_digests(spark, tmp_path):
    import regex
    known = [(r.licence, r.text) for r in licences.known_licences(spark).collect()]
    whole, single, several = {}, {}, {}
    for name, text in known:
        c = plain_canonical(text)
        whole[c] = min(name, whole.get(c, name))
        parts = plain_parts(text)
        for p in parts:
            c = plain_canonical(p)
            if len(parts) == 1:
                single.setdefault(plain_digest(c), set()).add(name)
            elif any(a in c for a in licences.ANCHORS) and len(c) >= licences.PART_CHARS:
                several.setdefault(c, set()).add(name)
    looked = {d: set(names) for d, names in single.items() if d}
    for c, names in several.items():
        if len(names) == 1:
            looked.setdefault(plain_digest(c), set()).update(f"part:{n}" for n in names)
    looked = {d: min(names) for d, names in looked.items()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = [(d.doc_id, d.text) for d in docs] + [(-1, licences.KNOWN["MIT"].upper()), (-2, "Head.\n\n" + known[0][1] + "\n\nTail")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in licences.scan(df, licences.known_licences(spark)).collect()}
    assert len(got) == len(rows) and got[-1].licence == "MIT" and got[-2].notices
    seen = 0
    for i, text in rows:
        c = plain_canonical(text)
        assert got[i].canonical_sha256 == hashlib.sha256(c.encode()).hexdigest()
        assert got[i].licence == (whole.get(c) if c else None)
        units = regex.split(r"\r\n?|\n", text or "") + plain_parts(text or "")
        names = {looked.get(plain_digest(plain_canonical(u))) for u in units} - {None}
        assert got[i].notices == sorted(names)
        seen += bool(names)
    assert seen > 2


def test_remembered_chunks_take_little_memory():
    import tracemalloc

    model = unigram.load()
    texts = [" ".join(f"w{i * 100 + k:06d}" for k in range(100)) for i in range(200)] + ["", "é" * 60, ""]
    encoder, short = unigram.Encoder(model), unigram.Encoder(model)
    tracemalloc.start()
    got = encoder.encode(texts)
    want = [x.tolist() for x in got]
    del got
    before = tracemalloc.get_traced_memory()[0]
    encoder.seen = encoder.ids = encoder.starts = None
    held = before - tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 240 * 20_000
    short.LIMIT = 50
    assert [short.encode([t])[0].tolist() for t in texts] == want
    assert short.encode([]) == [] and len(short.seen) <= 150


def test_texts_go_to_python_in_small_batches(spark):
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "bytes"])

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    texts = spark.range(0, 64, 1, 1).selectExpr("id AS doc_id", "repeat('ab ', 100000) AS text")
    empty = toxicity.fit([], [])
    for call in (lambda: unigram.encode_documents(texts, unigram.load()), lambda: toxicity.score(texts, empty)):
        call()
        seen = texts.mapInArrow(sizes, "rows bigint, bytes bigint").collect()
        assert sum(r.rows for r in seen) == 64 and max(r.bytes for r in seen) < 5 << 20
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def test_few_rows_to_drop_move_no_texts(spark):
    from courtside.llm import decontaminate

    docs, key = spark.read.parquet(f"{SF}/documents.parquet"), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, -1)
        for stage in (decontaminate.decontaminate_stage, setsketch.near_dedup_stage):
            left = stage(spark, docs, SF)
            plan = left._jdf.queryExecution().executedPlan().toString()
            assert "LeftAnti" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set(key, before)
