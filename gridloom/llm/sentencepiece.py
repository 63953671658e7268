"""SentencePiece encoding and decoding with seeded merge-dropout.

Texts are segmented by the merges of a given BPE vocabulary (a parameter; never
trained here).  Each candidate merge, that is a pair of neighbouring parts at
its place, is skipped with probability ``dropout`` by a hash of seed, document
and place when the agenda would process it, so a document gets another
segmentation under another seed and the same one on every run.  Whatever is
skipped, the parts still spell the text: decoding gives it back byte for byte.

Parts never span the border from a non-space to a space, so text falls into
short chunks.  The agendas of all chunks of a slice advance in lock-step in
numpy: per round every chunk performs its best candidate.  Chunks of over LONG
characters use a heap instead, in n log n; before that they are cut between
neighbouring characters that stand together in no piece, which no merge can
join, so a long run without spaces becomes chunks, too.  Both follow the same order (score,
then leftmost) and draw the same hashes.

The text is not normalised; U+2581, which stands for a space in pieces, is
spelled in bytes where it occurs in a text, as are characters without a piece.

Edge cases: a null text gives null pieces, an empty one none; null ids are
hashed as such; repeated rows get equal results; other columns pass through,
whatever they are called.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridloom.llm.text import fresh

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
LONG = 256
#: Characters that are segmented at once.
SLICE = 1_000_000
NONE = np.int64(1) << np.int64(40)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@dataclass
class Vocabulary:
    """What encoding needs of a model, as plain values that can be shipped."""

    pieces: list[str]
    ranks: list[int]  # the place by falling score; equal scores share one
    bytes_from: int  # id of <0x00>
    special: set[int]
    dummy_prefix: bool = True
    _tables: dict = field(default_factory=dict, repr=False)

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        scores = [model.get_score(i) for i in range(n)]
        place = {s: r for r, s in enumerate(sorted(set(scores), reverse=True))}
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        return cls([model.id_to_piece(i) for i in range(n)], [place[s] for s in scores], model.piece_to_id("<0x00>"), special)

    def __getstate__(self):
        return self.__dict__ | {"_tables": {}}

    def tables(self) -> dict:
        """Character ids, and an open hash table from pairs of ids to merges."""
        if self._tables:
            return self._tables
        ids = {p: i for i, p in enumerate(self.pieces) if i not in self.special}
        chars = np.full(0x110000, -1, np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                chars[ord(p)] = i
        chars[ord(" ")] = chars[ord(SPACE)]
        chars[ord(SPACE)] = -1
        left, right, made = [], [], []
        for p, i in ids.items():
            for k in range(1, len(p)):
                a, b = ids.get(p[:k]), ids.get(p[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), made.append(i)
        keys = np.array(left, np.int64) << 20 | np.array(right, np.int64)
        made = np.array(made, np.int64)
        bits = max(4, int(len(keys) * 8).bit_length())
        slots, values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        at, todo, most = self._slot(keys, bits), np.arange(len(keys)), 0
        while len(todo):  # linear probing, all at once
            most += 1
            free = slots[at] == -1
            _, first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            put = first[free[first]]
            slots[at[put]], values[at[put]] = keys[todo[put]], made[todo[put]]
            rest = np.ones(len(todo), bool)
            rest[put] = False
            todo, at = todo[rest], (at[rest] + 1) & ((1 << bits) - 1)
        rank = np.array(self.ranks, np.int64)
        spelled = [p.replace(SPACE, " ") for p in ids]
        together = np.unique(np.array([ord(a) << 21 | ord(b) for p in spelled for a, b in zip(p, p[1:])], np.int64))
        self._tables.update(together=together, chars=chars, slots=slots, values=values, bits=bits, probes=most, rank=rank, merges=dict(zip(keys.tolist(), made.tolist())))
        return self._tables

    @staticmethod
    def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair of ids makes, or -1."""
        t = self.tables()
        out = np.full(len(a), -1, np.int64)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        keys = a[todo].astype(np.int64) << 20 | b[todo]
        at = self._slot(keys, t["bits"])
        for _ in range(t["probes"]):
            slot = t["slots"][at]
            hit = slot == keys
            out[todo[hit]] = t["values"][at[hit]]
            more = ~hit & (slot != -1)
            if not more.any():
                break
            todo, keys, at = todo[more], keys[more], (at[more] + 1) & ((1 << t["bits"]) - 1)
        return out


def skipped(key: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the candidate that joins [start, mid) and [mid, end) is skipped."""
    if dropout <= 0:
        return np.zeros(len(start), bool)
    u = np.uint64
    h = _mix(key + start.astype(u) * u(0x9E3779B97F4A7C15) + mid.astype(u) * u(0xC2B2AE3D27D4EB4F) + end.astype(u) * u(0x165667B19E3779F9))
    return h < u(min(int(dropout * 2.0**64), 2**64 - 1))


def _heap(v: Vocabulary, ids: list[int], first: int, key: np.uint64, dropout: float) -> dict[int, int]:
    """One long chunk by agenda: start place -> piece."""
    t = v.tables()
    n = len(ids)
    after, before, end, alive, agenda = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n, []

    def push(i: int) -> None:
        j = after[i] if i >= 0 else n
        if i < 0 or j >= n or ids[i] < 0 or ids[j] < 0:
            return
        made = t["merges"].get(ids[i] << 20 | ids[j])
        if made is not None:
            one = lambda x: np.array([first + x])
            if not skipped(np.array([key]), one(i), one(j), one(end[j]), dropout)[0]:
                heapq.heappush(agenda, (v.ranks[made], i, j, end[j], made))

    for i in range(n - 1):
        push(i)
    while agenda:
        _, i, j, stop, made = heapq.heappop(agenda)
        if not (alive[i] and j < n and alive[j]) or after[i] != j or end[j] != stop:
            continue
        ids[i], alive[j], end[i], after[i] = made, False, stop, after[j]
        if after[j] < n:
            before[after[j]] = i
        push(before[i])
        push(i)
    return {i: ids[i] for i in range(n) if alive[i]}


def segment(v: Vocabulary, code: np.ndarray, chunk: np.ndarray, key: np.ndarray, place: np.ndarray, dropout: float) -> np.ndarray:
    """Piece ids by character place: -2 where a piece goes on, -1 for a
    character without a piece.  ``chunk`` numbers the chunks (ascending),
    ``key`` is the document's hash and ``place`` the place in it."""
    t = v.tables()
    ids = t["chars"][code].astype(np.int64)
    out = np.full(len(code), -2, np.int64)
    sizes = np.bincount(chunk)
    long = np.flatnonzero(sizes > LONG)
    for c in long:
        a, b = np.searchsorted(chunk, [c, c + 1])
        for i, piece in _heap(v, ids[a:b].tolist(), int(place[a]), key[a], dropout).items():
            out[a + i] = piece
    at = np.flatnonzero(sizes[chunk] <= LONG)
    # parts: place in the slice, piece, chunk; end: where the part stops
    ids, chunk = ids[at], chunk[at]
    end = at + 1

    def candidates(i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of joining part i with part i + 1."""
        made = v.lookup(ids[i], ids[i + 1])
        made[chunk[i] != chunk[i + 1]] = -1
        some = np.flatnonzero(made >= 0)
        if dropout > 0 and len(some):
            x = i[some]
            base = place[at[x]]
            made[some[skipped(key[at[x]], base, base + (at[x + 1] - at[x]), base + (end[x + 1] - at[x]), dropout)]] = -1
        return np.where(made >= 0, t["rank"][made], NONE), made

    rank, made = np.full(len(at), NONE), np.full(len(at), -1, np.int64)
    if len(at) > 1:
        rank[:-1], made[:-1] = candidates(np.arange(len(at) - 1))
    while len(at):
        heads = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1])))
        best = np.minimum.reduceat(rank << 22 | np.arange(len(at)), heads)
        going = (best >> 22) < NONE
        done = np.repeat(~going, np.diff(np.append(heads, len(at))))
        out[at[done]] = ids[done]
        i = best[going] & ((1 << 22) - 1)
        ids[i], end[i] = made[i], end[i + 1]
        keep = ~done
        keep[i + 1] = False
        # parts whose candidates change: the joined one and the one before it
        touched = np.zeros(len(at), bool)
        touched[i] = True
        prior = i[i > 0] - 1
        touched[prior[chunk[prior] == chunk[prior + 1]]] = True
        ids, end, chunk, at, rank, made, touched = (x[keep] for x in (ids, end, chunk, at, rank, made, touched))
        again = np.flatnonzero(touched)
        rank[again], made[again] = NONE, -1
        again = again[again < len(at) - 1]
        if len(again):
            rank[again], made[again] = candidates(again)
    return out


def encode(v: Vocabulary, texts: list[str], keys: np.ndarray, dropout: float = 0.0) -> list[np.ndarray]:
    """Piece ids of each text; ``keys`` are 64-bit document hashes."""
    results: list = [None] * len(texts)
    i = 0
    while i < len(texts):
        j, total = i, 0
        while j < len(texts) and (j == i or total + len(texts[j]) < SLICE):
            total += len(texts[j]) + 1
            j += 1
        for n, ids in enumerate(_encode(v, texts[i:j], keys[i:j], dropout)):
            results[i + n] = ids
        i = j
    return results


def _encode(v: Vocabulary, texts: list[str], keys: np.ndarray, dropout: float) -> list[np.ndarray]:
    texts = [(" " + t) if v.dummy_prefix and t else t for t in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ends = np.cumsum(sizes)
    if not len(code):
        return [np.empty(0, np.int32) for _ in texts]
    if len(code) >= 1 << 22:  # one very long text: in spans that end at chunk borders
        return [x for t, k in zip(texts, keys) for x in [_spans(v, t, k, dropout)]]
    doc = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(code)) - np.repeat(ends - sizes, sizes)
    out = _pieces(v, code, doc, place, keys, dropout)
    ids, owner = _spell(v, out, code, doc)
    cuts = np.searchsorted(owner, np.arange(1, len(texts)))
    return [x.astype(np.int32) for x in np.split(ids, cuts)]


def _pieces(v: Vocabulary, code: np.ndarray, doc: np.ndarray, place: np.ndarray, keys: np.ndarray, dropout: float) -> np.ndarray:
    space = code == 32
    new = np.ones(len(code), bool)
    new[1:] = (space[1:] & ~space[:-1]) | (doc[1:] != doc[:-1])
    chunk = np.cumsum(new) - 1
    within = np.flatnonzero((np.bincount(chunk) > LONG)[chunk] & ~new)
    if len(within):
        pair, known = code[within - 1] << 21 | code[within], v.tables()["together"]
        at = np.minimum(np.searchsorted(known, pair), len(known) - 1)
        new[within[known[at] != pair]] = True
        chunk = np.cumsum(new) - 1
    return segment(v, code, chunk, keys.astype(np.uint64)[doc], place, dropout)


def _spans(v: Vocabulary, text: str, key, dropout: float) -> np.ndarray:
    """A text (with its prefix) of any length, in spans of some SLICE.

    Spans end where words begin, so no merge crosses them; a stretch without such
    a place is one span whatever its length."""
    parts, a = [], 0
    while a < len(text):
        b = min(len(text), a + SLICE)
        while b < len(text) and not (text[b] == " " and text[b - 1] != " "):
            b += 1
        code = np.frombuffer(text[a:b].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        doc = np.zeros(len(code), np.int64)
        out = _pieces(v, code, doc, np.arange(a, b), np.array([key]), dropout)
        parts.append(_spell(v, out, code, doc)[0])
        a = b
    return np.concatenate(parts).astype(np.int32)


def _spell(v: Vocabulary, out: np.ndarray, code: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Drops continuations and spells characters without a piece in bytes."""
    at = np.flatnonzero(out != -2)
    ids, owner = out[at], doc[at]
    odd = np.flatnonzero(ids == -1)
    if len(odd):
        spelled = [chr(c).encode("utf-8", "surrogatepass") for c in code[at[odd]]]
        width = np.ones(len(ids), np.int64)
        width[odd] = [len(s) for s in spelled]
        first = np.cumsum(width) - width
        ids, owner = np.repeat(ids, width), np.repeat(owner, width)
        flat = np.frombuffer(b"".join(spelled), np.uint8).astype(np.int64) + v.bytes_from
        ids[np.flatnonzero(ids == -1)] = flat
        assert len(first) == len(at)
    return ids, owner


def decode(v: Vocabulary, ids: np.ndarray) -> str:
    """The text whose pieces these are."""
    t = v.tables()
    if "spelling" not in t:
        t["spelling"] = [
            bytes([i - v.bytes_from]) if v.bytes_from <= i < v.bytes_from + 256 else (b"" if i in v.special else p.replace(SPACE, " ").encode())
            for i, p in enumerate(v.pieces)
        ]
    spelling = t["spelling"]
    text = b"".join([spelling[i] for i in ids.tolist()]).decode("utf-8", "surrogatepass")
    return text[1:] if v.dummy_prefix and text[:1] == " " else text


def _run(v: Vocabulary, names: list[str], new: list[str], text: str, key: str, seed: int, dropout: float, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            keys = _mix(batch.column(key).to_numpy(zero_copy_only=False).view(np.uint64) + np.uint64(seed))
            found = encode(v, [t or "" for t in texts], keys, dropout)
            ok = np.array([t is not None for t in texts], bool)
            sizes = np.array([len(x) for x in found], np.int64)
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), mask=np.append(~ok, False))
            flat = np.concatenate(found) if found else np.empty(0, np.int32)
            cols = [batch.column(n) for n in names] + [pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))]
            if check:
                cols.append(pa.array([decode(v, x) == (t or "") for x, t in zip(found, texts)]))
            yield pa.RecordBatch.from_arrays(cols, names=[*names, *new])

    return run


def encode_documents(docs: DataFrame, model: str = MODEL, seed: int = 13, dropout: float = 0.1, id_col: str = "doc_id", text: str = "text", keep_text: bool = False, check: bool = True) -> DataFrame:
    """Rows of ``docs`` with ``pieces`` and, on request, ``lossless``: whether
    decoding them gives the text.  The text itself stays only if asked for.  Where
    ``docs`` has columns of those names, the new ones get an underscore in front."""
    key, *new = fresh(docs, "_key", "pieces", *["lossless"] * check)
    names = [c for c in docs.columns if keep_text or c != text]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in names]
    keyed = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*names, text])], F.xxhash64(F.col(f"`{id_col}`")).alias(key))
    schema = ", ".join([*kinds, f"`{new[0]}` array<int>", *[f"`{new[-1]}` boolean"] * check])
    return keyed.mapInArrow(_run(Vocabulary.load(model), names, new, text, key, seed, dropout, check), schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_documents(docs).select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces", "lossless")
