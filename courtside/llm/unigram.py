"""SentencePiece encoding by unigram Viterbi over a double-array trie, and decoding.

Pieces with log scores are held in a double-array trie over UTF-8 bytes. A text
gets a leading blank, blanks become the marker U+2581, and the segmentation of
greatest total score is found by Viterbi. A character that is no piece costs
``UNKNOWN`` below the least score and is written as its UTF-8 bytes (byte
pieces), so nothing is lost. Decoding joins pieces, turns bytes and markers back
and drops the leading blank.

No piece holds a marker after another character (checked when the model is
read), so no piece crosses the start of a run of markers: runs of blanks with
the word after them are segmented alone, once for each distinct such chunk.
Chunks up to ``SHORT`` bytes go through the trie together, as numpy columns;
longer ones one at a time. Texts are handled whole, in one Arrow pass.

The public model file is a BPE model, whose scores are minus the merge rank.
Such ranks are no log probabilities; they are read as those of Zipf's law over
the ranks, log(1 / (rank + 1)), up to a constant. Scores of a unigram model
are used as they are.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import in_arrow, read

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN = 10.0
SHORT = 40
#: So many chunks go through the trie together (bounds a worker's memory).
TOGETHER = 8000
CHUNKS = re.compile(" *[^ ]+| +$")


@dataclass
class Pieces:
    """A double-array trie of pieces: ``base``, ``check``, and the piece that ends at each state."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray
    score: np.ndarray      # by id
    text: list[bytes]      # by id: what the piece stands for
    byte_id: np.ndarray    # id of each byte piece
    unknown: float
    longest: int


def build_trie(keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check, piece of a double-array trie; state 0 is the root, bytes are codes 1 to 256."""
    children: list[dict[int, int]] = [{}]
    ends: list[int] = [-1]
    for key, value in keys:
        node = 0
        for c in key:
            nxt = children[node].get(c)
            if nxt is None:
                nxt = children[node][c] = len(children)
                children.append({})
                ends.append(-1)
            node = nxt
        ends[node] = value
    size = 8 * len(children) + 8192
    base, check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
    piece = np.full(size, -1, np.int32)
    free = np.ones(size, bool)
    free[0] = False
    state = {0: 0}
    lowest, hint = 1, 0
    for node in range(len(children)):  # nodes are numbered after their parents
        s = state[node]
        piece[s] = ends[node]
        codes = np.fromiter((c + 1 for c in sorted(children[node])), np.int64, len(children[node]))
        if not len(codes):
            continue
        if max(hint, lowest) + 4096 > len(free):
            more = len(free)
            base, check = np.pad(base, (0, more)), np.pad(check, (0, more), constant_values=-1)
            piece = np.pad(piece, (0, more), constant_values=-1)
            free = np.pad(free, (0, more), constant_values=True)
        if len(codes) == 1:  # single children fill the holes
            while not free[lowest] or lowest < codes[0]:
                lowest += 1
            b = lowest - int(codes[0])
        else:  # others look on from where the last one found room
            while True:
                fits = free[hint + np.arange(1024)[:, None] + codes].all(1)
                if fits.any():
                    b = hint = hint + int(fits.argmax())
                    break
                hint += 1024
        base[s] = b
        for c in codes:
            free[b + c], check[b + c] = False, s
            state[children[node][int(c) - 1]] = b + int(c)
    top = int(np.flatnonzero(~free)[-1]) + 258
    return base[:top], check[:top], piece[:top]


def load(path: str = MODEL) -> Pieces:
    """The pieces of a SentencePiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    names = [sp.id_to_piece(i) for i in range(n)]
    scores = np.array([sp.get_score(i) for i in range(n)])
    plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    ranked = bool(len(plain)) and np.all(np.diff(scores[plain]) == -1)
    if ranked:  # a BPE model: minus the rank
        scores = -np.log1p(np.maximum(0, scores[plain[0]] - scores))
    pieces = {names[i]: (i, float(scores[i])) for i in plain}
    byte_ids = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
    return make(pieces, byte_ids, n)


def make(pieces: dict[str, tuple[int, float]], byte_ids: dict[int, int], n: int) -> Pieces:
    """``pieces``: (id, log score) by piece; ``byte_ids``: the byte pieces' ids; ``n``: ids in all."""
    if any(re.search(f"[^{MARKER}]{MARKER}", p) for p in pieces):
        raise ValueError("a piece crosses the start of a word")
    if len(byte_ids) != 256:
        raise ValueError("byte fallback needs a piece for each byte")
    text, score = [b""] * n, np.zeros(n)
    for p, (i, s) in pieces.items():
        text[i], score[i] = p.encode(), s
    for b, i in byte_ids.items():
        text[i] = bytes([b])
    base, check, piece = build_trie([(p.encode(), i) for p, (i, _) in pieces.items() if p])
    low = min((s for _, s in pieces.values()), default=0.0)
    return Pieces(base, check, piece, score, text, np.array([byte_ids[b] for b in range(256)]),
                  low - UNKNOWN, max((len(p.encode()) for p in pieces), default=1))


def _char_lengths(raw: np.ndarray) -> np.ndarray:
    """Bytes of the UTF-8 character that starts with each byte."""
    return np.where(raw < 0x80, 1, np.where(raw < 0xE0, 2, np.where(raw < 0xF0, 3, 4)))


def encode_together(model: Pieces, chunks: list[bytes]) -> list[np.ndarray]:
    """The best segmentation of each chunk (ids), all chunks at once, place by place."""
    n = len(chunks)
    lengths = np.fromiter(map(len, chunks), np.int64, n)
    width = int(lengths.max(initial=0))
    raw = np.zeros((width, n), np.int64)  # a row is a place
    flat = np.frombuffer(b"".join(chunks), np.uint8)
    at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    raw.T[np.arange(width)[None, :] < lengths[:, None]] = flat
    start = (raw & 0xC0) != 0x80
    best = np.full((width + 1, n), -np.inf)
    best[0] = 0
    back = np.zeros((width + 1, n), np.int32)   # length of the last piece
    used = np.full((width + 1, n), -1, np.int32)  # its id, -1: unknown character
    for i in range(width):
        live = np.flatnonzero((lengths > i) & start[i])
        if not len(live):
            continue
        size = _char_lengths(raw[i, live])
        _offer(best, back, used, i, i + size, live, best[i, live] + model.unknown, -1, size)
        state = np.zeros(len(live), np.int64)
        for j in range(i, min(width, i + model.longest)):
            on = lengths[live] > j
            live, state = live[on], state[on]
            to = model.base[state] + raw[j, live] + 1
            on = model.check[to] == state
            live, state = live[on], to[on]
            if not len(live):
                break
            ids = model.piece[state]
            hit = ids >= 0
            if hit.any():
                who, got = live[hit], ids[hit]
                _offer(best, back, used, i, j + 1, who, best[i, who] + model.score[got], got,
                       j + 1 - i)
    # walk back, all chunks together; pieces come out last first
    place, steps = lengths.copy(), []
    while True:
        live = np.flatnonzero(place > 0)
        if not len(live):
            break
        p = place[live]
        steps.append((live, used[p, live], p - back[p, live], back[p, live]))
        place[live] = p - back[p, live]
    out: list[list] = [[] for _ in range(n)]
    for live, ids, frm, size in reversed(steps):
        for c, i, f, s in zip(live.tolist(), ids.tolist(), frm.tolist(), size.tolist()):
            if i >= 0:
                out[c].append(i)
            else:
                out[c].extend(model.byte_id[list(chunks[c][f:f + s])].tolist())
    return [np.array(x, np.int32) for x in out]


def _offer(best, back, used, frm, to, who, score, ids, size) -> None:
    """Keep the better way to place ``to``; of equal scores the longer last piece stays."""
    better = score > best[to, who]
    if np.ndim(to):
        to = to[better]
    who = who[better]
    best[to, who] = score[better]
    back[to, who] = size[better] if np.ndim(size) else size
    used[to, who] = ids[better] if np.ndim(ids) else ids


def encode_alone(model: Pieces, chunk: bytes) -> np.ndarray:
    """The best segmentation of one chunk, place by place (for long chunks)."""
    base, check, piece, score = map(memoryview, (model.base, model.check, model.piece, model.score))
    n = len(chunk)
    best, back, used = (array(kind, [x]) * (n + 1) for kind, x in (("d", -np.inf), ("i", 0), ("i", -1)))
    best[0] = 0.0
    for i in range(n):
        c = chunk[i]
        if c & 0xC0 == 0x80:
            continue
        size = 1 if c < 0x80 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4
        here = best[i]
        if here + model.unknown > best[i + size]:
            best[i + size], back[i + size], used[i + size] = here + model.unknown, size, -1
        s = 0
        for j in range(i, min(n, i + model.longest)):
            t = base[s] + chunk[j] + 1
            if check[t] != s:
                break
            s = t
            if piece[s] >= 0 and here + score[piece[s]] > best[j + 1]:
                best[j + 1], back[j + 1], used[j + 1] = here + score[piece[s]], j + 1 - i, piece[s]
    ids: list[int] = []
    at = n
    while at:
        if used[at] >= 0:
            ids.append(used[at])
        else:
            ids.extend(model.byte_id[list(chunk[at - back[at]:at])][::-1].tolist())
        at -= back[at]
    return np.array(ids[::-1], np.int32)


class _Places(dict):
    """Numbers of chunks in the order they were first met; ``new``: those not yet encoded."""

    def __init__(self):
        self.new = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = k = len(self)
        self.new.append(chunk)
        return k


class Encoder:
    """Segments texts; remembers chunks up to a bound of their number and characters.

    The ids of remembered chunks lie end to end in one array: an array object
    for each chunk would take many times the bytes of its few ids.
    """

    LIMIT, CHARS = 300_000, 8_000_000

    def __init__(self, model: Pieces):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.seen, self.held = _Places(), 0
        self.ids, self.starts = array("i"), array("q", [0])  # chunk k: ids[starts[k]:starts[k + 1]]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; an empty text has none."""
        if len(self.seen) > self.LIMIT or self.held > self.CHARS:
            self._forget()
        row, ends = array("q"), []  # the chunks of all texts, and where each text's end
        for t in texts:
            if t:
                row.extend(map(self.seen.__getitem__, CHUNKS.findall(" " + t)))
            ends.append(len(row))
        self._remember(self.seen.new)
        self.seen.new = []
        k = np.frombuffer(row, np.int64)
        starts, ids = np.frombuffer(self.starts, np.int64), np.frombuffer(self.ids, np.int32)
        at = np.concatenate([[0], np.cumsum(starts[k + 1] - starts[k])])
        # the ids of chunk k from its start on, at the place where its turn comes
        flat = ids[np.arange(at[-1]) + np.repeat(starts[k] - at[:-1], np.diff(at))]
        return np.split(flat, at[ends[:-1]]) if texts else []

    def _remember(self, new: list[str]) -> None:
        """Add the ids of the chunks ``new``."""
        self.held += sum(map(len, new))
        raw = [c.replace(" ", MARKER).encode("utf-8", "replace") for c in new]
        short = [i for i, r in enumerate(raw) if len(r) <= SHORT]
        done: list = [None] * len(raw)
        for at in range(0, len(short), TOGETHER):
            part = sorted(short[at:at + TOGETHER], key=lambda i: len(raw[i]))
            for ids, i in zip(encode_together(self.model, [raw[i] for i in part]), part):
                done[i] = ids
        for i, r in enumerate(raw):
            if done[i] is None:
                done[i] = encode_alone(self.model, r)
            self.ids.frombytes(done[i].tobytes())
            self.starts.append(len(self.ids))


def decode(model: Pieces, ids) -> str:
    """The text of a sequence of ids."""
    raw = b"".join([model.text[i] for i in ids]).decode("utf-8", "replace").replace(MARKER, " ")
    return raw[1:] if raw.startswith(" ") else raw


def encode_documents(docs: DataFrame, model: Pieces) -> DataFrame:
    """doc_id, ids, n_ids, n_bytes (byte pieces among them), round_trip for each row.

    ``round_trip``: the ids decode to the text. Defined cases: a null or empty
    text has no ids (and round-trips to the empty text); a text that holds the
    marker character itself decodes to one with blanks in its place, and does not
    round-trip; repeated rows and ties are encoded alike (of segmentations
    with equal scores the one whose pieces start earliest is taken); an empty
    table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a vocabulary: a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        encoder = Encoder(m)
        is_byte = np.zeros(len(m.text), bool)
        is_byte[m.byte_id] = True
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = encoder.encode(texts)
                sizes = np.fromiter(map(len, ids), np.int32, len(ids))
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                in_bytes = np.concatenate([[0], np.cumsum(is_byte[flat])])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     pa.array(sizes.astype(np.int64)),
                     pa.array((in_bytes[offsets[1:]] - in_bytes[offsets[:-1]]).astype(np.int64)),
                     pa.array([decode(m, i.tolist()) == t for i, t in zip(ids, texts)])],
                    names=["doc_id", "ids", "n_ids", "n_bytes", "round_trip"])

    return in_arrow(
        docs.select("doc_id", "text"), run, "doc_id bigint, ids array<int>, n_ids bigint, n_bytes bigint, round_trip boolean")


def op2_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode_documents(read(spark, sf_dir, "documents"), load())


def sentencepiece_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of ``docs`` (the pipeline's result)."""
    return encode_documents(docs, load())
