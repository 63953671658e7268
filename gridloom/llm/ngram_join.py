"""N-gram Jaccard join with PartEnum signatures.

A text's set is its distinct word shingles.  Two sets whose Jaccard similarity
is at least t differ in at most H = (1-t)/(1+t) * (|A|+|B|) elements.  Sets are
put into bands of similar size.  In a band, the domain of elements is dealt by
hash to n1 partitions, more than the band's largest H, so two similar sets agree
*wholly* on at least n1 - H of them; the content of a partition, hashed, is a
signature, and agreeing sets share one.  (Of the subsets that PartEnum
enumerates, these are the ones that leave out all but one partition.)

Contents of fewer than two elements say little, and their signatures would
gather unrelated sets.  They are left out soundly: only if a set has n1 - H or
more such weak partitions could all its agreements be weak; then it enters a
further round under another hash, and both sets of a missed pair must have done
so.  After the last round such a set also emits its weak signatures.  Sets too
small to differ in anything are joined by equality.

Signatures travel as packed arrays, and a task sends equal texts once.  Similar
sets share many signatures, at least n1 - H less the weak ones: a set that
shares fewer with all others together is dropped, and of the others the most
frequent signatures are left out (candidates), so a passage that many texts quote
makes no pairs.  Where sets share a signature, they are held against the group's
hub (the member in the largest company), never against all others: first each
text against the one hub it meets most often; then, only where a group's texts
are neither connected by then nor in one star, against that group's hub.
Members of one hub's star that are still in different components are held
against each other by their differences to the hub (residual_links), so siblings
that are merely near each other make no pairs.
Every link is verified on whole sets.  Components come from alternating
large-star and small-star steps, on pairs only.

Edge cases: null texts and texts without words have an empty set and stand
alone; equal texts are one set throughout; a null id never names a component
unless all of the component's ids are null; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridloom.plans.components import connected_components
from gridloom.plans.staging import discard, materialize

#: Ratio of a band's largest to its smallest size.
BAND = 1.25
#: Texts of so many bytes are worked on at once.
SLICE_BYTES = 2_000_000
#: Signatures that a task holds before it combines and sends them.
FLUSH = 2_000_000
#: Rounds in which sets with many weak partitions are hashed anew.
ROUNDS = 8
#: Contents of fewer elements are weak.
WEAK = 2

_M = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODE = mix64(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_CODE[65:91] = _CODE[97:123]  # A-Z as a-z
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the words in a byte array, A-Z lowered.

    A word's hash is a polynomial in a fixed odd base over 64-bit codes of its
    bytes, by running sums: no loop over words."""
    if not len(data):
        return np.empty(0, np.uint64)
    inside = ~_SPACE[data]
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.empty(0, np.uint64)
    n = len(data)
    power = np.full(n + 1, _BASE, np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_CODE[data] * power[:n], dtype=np.uint64)))
    # bring a word to place 0: multiply by base^(n - start), equal for all words
    value = (run[end] - run[start]) * power[n - start]
    value *= np.uint64(pow(_INVERSE, n, 1 << 64))
    return mix64(value)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Yields (first row, sorted distinct shingle hashes per row) in slices of
    some SLICE_BYTES.  Null: empty set.  Fewer words than ``width``: one."""
    texts = texts.cast(pa.large_binary())
    size = np.zeros(len(texts), np.int64)
    ok = np.asarray(texts.is_valid())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    size[:] = np.diff(offsets)
    size[~ok] = 0
    raw = texts.buffers()[2]
    blob = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    i = 0
    while i < len(texts):
        j = i + 1
        total = size[i]
        while j < len(texts) and total + size[j] <= SLICE_BYTES:
            total += size[j]
            j += 1
        out = []
        for r in range(i, j):
            out.append(_shingles(blob[offsets[r] : offsets[r + 1]] if ok[r] else blob[:0], width))
        yield i, out
        i = j


def _shingles(data: np.ndarray, width: int) -> np.ndarray:
    w = word_hashes(data)
    if not len(w):
        return np.empty(0, np.uint64)
    k = min(width, len(w))
    s = np.full(len(w) - k + 1, k, np.uint64)
    for j in range(k):
        s = mix64(s * np.uint64(0x100000001B3) + w[j : len(w) - k + 1 + j])
    return np.unique(s)


def most_differences(a: int, b: int, num: int, den: int) -> int:
    """Largest symmetric difference of sets of a and b elements whose Jaccard
    similarity is at least num / den."""
    return (a + b) * (den - num) // (den + num)


def bands(size: int, num: int, den: int) -> list[int]:
    """The bands of a set: its own, and the next if a larger partner can be
    there.  Band i holds sizes from edge(i) to edge(i + 1) - 1."""
    i = int(math.log(size) / math.log(BAND) + 1e-9)
    while edge(i + 1) <= size:
        i += 1
    while edge(i) > size:
        i -= 1
    return [i] + ([i + 1] if size * den >= num * edge(i + 1) else [])


def edge(i: int) -> int:
    return math.ceil(BAND**i - 1e-9)


def scheme(band: int, num: int, den: int) -> tuple[int, int]:
    """(partitions, largest difference) of a band."""
    top = edge(band + 1) - 1
    h = most_differences(top, top, num, den)
    return h + max(1, (2 * h + 4) // 5) if h else 1, h


def signatures(s: np.ndarray, num: int, den: int) -> tuple[np.ndarray, int]:
    """All signatures of a set of (sorted) 64-bit elements, and how many of
    them any similar set must share at least."""
    out, need, n = [], len(s), len(s)
    for band in bands(n, num, den):
        n1, h = scheme(band, num, den)
        if h == 0:
            out.append(mix64(np.array([np.bitwise_xor.reduce(mix64(s)) + np.uint64(band)], np.uint64)))
            need = 1
            continue
        largest = min(n * den // num, edge(band + 1) - 1)
        own = most_differences(n, max(n, largest), num, den)  # with any partner in this band
        for turn in range(ROUNDS):
            salt = np.uint64(((band * 64 + turn + 1) * 0xD6E8FEB86659FD93) & _M)
            e = mix64(s + salt)
            part = ((e >> np.uint64(32)) * np.uint64(n1) >> np.uint64(32)).astype(np.int64)
            count = np.bincount(part, minlength=n1)
            order = np.argsort(part, kind="stable")
            run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(e)[order], dtype=np.uint64)))
            at = np.concatenate(([0], np.cumsum(count)))
            sig = mix64(run[at[1:]] - run[at[:-1]] + mix64(np.arange(n1, dtype=np.uint64) + salt))
            weak = count < WEAK
            lucky = int(weak.sum()) < n1 - own
            out.append(sig if turn == ROUNDS - 1 and not lucky else sig[~weak])
            if turn == 0:
                need = min(need, n1 - own - int(weak.sum())) if lucky else 1
            if lucky:
                break
    return np.concatenate(out), max(1, need)


def _emit(width: int, num: int, den: int, fan: int):
    """Map side: signatures packed by bin ``p``, five bytes each, in runs by
    document: (key, least number shared, length of the run).

    A text that a task has seen is not sent again.  Shortened signatures can
    only add candidates, all of which are verified; bins grow with the cluster,
    and equal short forms of different bins are different signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, keys, needs, counts, seen, held = [], [], [], [], set(), 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            sig, owner = np.concatenate(sigs), np.repeat(np.arange(len(keys)), counts)
            key, need = np.array(keys, np.int64), np.minimum(np.array(needs), 65_535).astype(np.uint16)
            for x in (sigs, keys, needs, counts):
                x.clear()
            held = 0
            p = (mix64(sig) % np.uint64(fan)).astype(np.uint32)
            order = np.argsort(p, kind="stable")
            p, sig, owner = p[order], sig[order], owner[order]
            at = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
            rows = []
            for a, b in zip(at, np.append(at[1:], len(p))):
                first = np.flatnonzero(np.concatenate(([True], owner[a + 1 : b] != owner[a : b - 1])))
                mine, length = owner[a:b][first], np.diff(np.append(first, b - a)).astype(np.uint32)
                short = sig[a:b].view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
                rows.append((int(p[a]), short, key[mine].tobytes(), need[mine].tobytes(), length.tobytes()))
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64())] + [pa.array(c, pa.binary()) for c in cols[1:]], names=["p", "sig", "key", "need", "length"])

        for batch in batches:
            ids = batch.column("k").to_numpy(zero_copy_only=False)
            fresh = np.array([x not in seen and not seen.add(x) for x in ids.tolist()], bool)
            if not fresh.any():
                continue
            chosen = batch.column("text").filter(pa.array(fresh))
            ids = ids[fresh]
            for start, sets in shingle_sets(chosen, width):
                for i, s in enumerate(sets):
                    if len(s):
                        g, need = signatures(s, num, den)
                        sigs.append(g)
                        keys.append(int(ids[start + i]))
                        needs.append(need)
                        counts.append(len(g))
                        held += len(g)
                        if held >= FLUSH:
                            yield flush()
        if keys:
            yield flush()

    return run


_MEMBER = pa.schema([("sig", pa.int64()), ("key", pa.int64()), ("need", pa.int64()), ("m", pa.int64())])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side: (sig, key, need, m) of signatures that m > 1 keys have, each
    row once.  Bins arrive sorted, so one bin is held at a time."""

    def close(p: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        sig, key, need = [], [], []
        for short, own, least, length in parts:
            five = np.frombuffer(short, np.uint8).reshape(-1, 5)
            full = np.zeros((len(five), 8), np.uint8)
            full[:, :5] = five
            sig.append(full.view(np.uint64).ravel())
            length = np.frombuffer(length, np.uint32)
            key.append(np.repeat(np.frombuffer(own, np.int64), length))
            need.append(np.repeat(np.frombuffer(least, np.uint16), length))
        sig, key, need = np.concatenate(sig), np.concatenate(key), np.concatenate(need)
        order = np.argsort(sig, kind="stable")
        alike = np.concatenate(([False], np.diff(sig[order]) == 0))
        order = order[alike | np.append(alike[1:], False)]  # without signatures of one row
        order = order[np.lexsort((key[order], sig[order]))]
        sig, key, need = sig[order], key[order], need[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        sig, key, need = sig[new], key[new], need[new]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(sig)), bool), sig[1:] != sig[:-1])))
        length = np.diff(np.append(first, len(sig)))
        m = np.repeat(length, length)
        several = m > 1
        sig, key, need, m = sig[several], key[several], need[several], m[several]
        sig = mix64(sig + mix64(np.array([p], np.uint64)))
        for a in range(0, len(sig), 100_000):
            x = slice(a, a + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(sig[x].view(np.int64)), pa.array(key[x]), pa.array(need[x].astype(np.int64)), pa.array(m[x].astype(np.int64))], schema=_MEMBER)

    at, parts = None, []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("p", "sig", "key", "need", "length")]):
            if row[0] != at and parts:
                yield from close(at, parts)
                parts = []
            at = row[0]
            parts.append(row[1:])
    if parts:
        yield from close(at, parts)


#: One pair of texts: sizes of the sets, what the key gained and lost against
#: the hub (a, b elements, of which the smallest few are listed).
_PAIR = "hub long, key long, nh long, nk long, a long, b long, gained array<long>, lost array<long>"


def _compare(width: int, num: int, den: int):
    """Compares the sets of two texts.  Of the differences, as many elements are
    listed as the set's most differences from any linked one, and one more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hub = None, np.empty(0, np.uint64)
        for batch in batches:
            keys, hubs = batch.column("key"), batch.column("hub").to_pylist()
            sizes, gained, lost = [], [], []
            for start, sets in shingle_sets(batch.column("tk"), width):
                for i, s in enumerate(sets):
                    if hubs[start + i] != at:  # rows come sorted by hub
                        at = hubs[start + i]
                        ((_, (hub,)),) = shingle_sets(batch.column("th").slice(start + i, 1), width)
                    x, y = np.setdiff1d(s, hub, assume_unique=True), np.setdiff1d(hub, s, assume_unique=True)
                    most = most_differences(len(s), len(s) * den // num, num, den) + 1
                    sizes.append((len(hub), len(s), len(x), len(y)))
                    gained.append(x[:most].view(np.int64))
                    lost.append(y[:most].view(np.int64))
            cols = [pa.array(c, pa.int64()) for c in (zip(*sizes) if sizes else ((),) * 4)]
            lists = [pa.array(c, pa.list_(pa.int64())) for c in (gained, lost)]
            yield pa.RecordBatch.from_arrays([batch.column("hub"), keys, *cols, *lists], names=["hub", "key", "nh", "nk", "a", "b", "gained", "lost"])

    return run


def compare(pairs: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Pairs (hub, key) with sizes and differences of their sets.  The key's
    text travels to the hub's: once per pair."""
    keys = texts.select(F.col("k").alias("key"), F.col("text").alias("tk"))
    hubs = texts.select(F.col("k").alias("hub"), F.col("text").alias("th"))
    met = pairs.join(keys, "key").join(hubs, "hub").select("hub", "key", "th", "tk").sortWithinPartitions("hub")
    return met.mapInArrow(_compare(width, num, den), _PAIR)


def _limit(a, b, num: int, den: int):
    """Most differences of linked sets of a and b elements, as a column."""
    return F.floor((a + b) * (den - num) / (den + num))


#: Up to this many keys (some 16 bytes each) are broadcast.
BROADCAST_ROWS = 2_000_000


def _near(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def candidates(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(sig, key, fame): the signatures on which a text can be linked.

    Signatures are ordered by the number of texts that have them.  Two linked
    texts share ``need`` of them at least, so they share one that is, in either,
    not among the need - 1 most frequent it has; those are left out, and with
    them whole texts that share fewer than ``need`` with all others together.
    Fame is the number of texts met on all signatures."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.mapInArrow(_emit(width, num, den, 2 * parts), "p long, sig binary, key binary, need binary, length binary")
    met = packed.repartition(parts, "p").sortWithinPartitions("p").mapInArrow(_meet, "sig long, key long, need long, m long")
    members = materialize(met, "jaccard-members")
    own = members.groupBy("key").agg(F.max("need").cast("int").alias("need"), F.sum("m").alias("fame"), F.sort_array(F.collect_list(F.struct("m", "sig"))).alias("all"))
    rare = own.where(F.size("all") >= F.col("need")).select("key", "fame", F.explode(F.slice("all", F.lit(1), F.size("all") - F.col("need") + 1)).alias("s"))
    out = materialize(rare.select("s.sig", "key", "fame"), "jaccard-rare")
    discard(members)
    return out


def class_links(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """Verified links (a, b) for rows (k, text), equal k meaning equal text.

    They connect exactly the texts that all links would connect."""
    rare = candidates(docs, width, num, den)
    # of a signature's texts, the one in the largest company over all is the hub
    hubs = rare.groupBy("sig").agg(F.max(F.struct("fame", "key")).alias("best"), F.count("*").alias("m")).where("m > 1")
    hubs = hubs.select("sig", F.col("best.key").alias("hub"), F.col("best.fame").alias("fame"))
    starred = materialize(rare.select("sig", "key").join(hubs, "sig"), "jaccard-starred")
    discard(rare)
    involved = materialize(starred.select(F.col("key").alias("k")).distinct(), "jaccard-involved")
    texts = materialize(docs.join(_near(involved), "k", "left_semi").groupBy("k").agg(F.first("text").alias("text")), "jaccard-texts")
    # first each text against the one hub that it meets most often
    often = starred.where("hub <> key").groupBy("key", "hub").agg(F.count("*").alias("n"), F.max("fame").alias("fame"))
    best = materialize(often.groupBy("key").agg(F.max(F.struct("n", "fame", "hub")).alias("best")).select("best.hub", "key"), "jaccard-first")
    first = materialize(compare(best, texts, width, num, den), "jaccard-stars-1")
    linked = F.col("a") + F.col("b") <= _limit(F.col("nh"), F.col("nk"), num, den)
    comp = connected_components(first.where(linked).select(F.col("hub").alias("a"), F.col("key").alias("b")))
    # then, where texts of a signature are neither of one component nor in one
    # star, those outside of its hub's star against that hub
    own = comp.select(F.col("node").alias("key"), F.col("component"))
    placed = starred.join(_near(best.select("key", F.col("hub").alias("met"))), "key", "left").join(_near(own), "key", "left").select(
        "sig", "key", "hub", F.coalesce("component", "key").alias("c"), (F.col("hub").eqNullSafe(F.col("met")) | (F.col("key") == F.col("hub"))).alias("inside")
    )
    placed = materialize(placed, "jaccard-met")
    open_ = placed.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("inside").alias("all")).where("lo < hi and not all").select("sig")
    pairs = materialize(placed.where("not inside").join(open_, "sig", "left_semi").select("hub", "key").distinct(), "jaccard-second")
    discard(starred, involved, placed)
    again = materialize(compare(pairs, texts, width, num, den), "jaccard-stars-2")
    stars = first.unionByName(again).withColumn("linked", linked)
    links = materialize(stars.where("linked").select(F.col("hub").alias("a"), F.col("key").alias("b")), "jaccard-links")
    rest = materialize(residual_links(stars, links, texts, width, num, den), "jaccard-rest")
    discard(first, again, texts, best, pairs)
    return links.unionByName(rest)


#: Members of a star that meet in one task; of larger ones, blocks meet in pairs.
STAR = 1_024

#: What a member of a star brings along: sizes of its set and of its differences to
#: the hub, their smallest elements, whether it is open, and its component.
_MEMBERS = ("key", "n", "a", "b", "gained", "lost", "open", "own")


class _Index:
    """The rows that list an element, of lists of (sorted) elements."""

    def __init__(self, lists: list[np.ndarray]):
        flat = np.concatenate(lists) if lists else np.empty(0, np.uint64)
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        order = np.argsort(flat, kind="stable")
        self.flat, self.row, self.rows = flat[order], row[order], len(lists)

    def common(self, some: np.ndarray) -> np.ndarray:
        """How many of ``some`` each row lists."""
        first, last = np.searchsorted(self.flat, some, "left"), np.searchsorted(self.flat, some, "right")
        n = last - first
        at = np.arange(n.sum()) + np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n)
        return np.bincount(self.row[at], minlength=self.rows)


def least_apart(x: np.ndarray, nx: int, y: np.ndarray, ny: int) -> int:
    """Least symmetric difference of sets of nx and ny elements of which x and y are
    the smallest ones, sorted.  Up to the smaller end of the lists that are not
    whole all is known; beyond it, at best, one's rest is part of the other's."""
    end = min(1 << 64 if len(s) == n else int(s[-1]) if len(s) else -1 for s, n in ((x, nx), (y, ny)))
    x_in, y_in = (len(s) if end >> 64 == 1 else int(np.searchsorted(s, np.uint64(end), "right")) if end >= 0 else 0 for s in (x, y))
    shared = len(np.intersect1d(x[:x_in], y[:y_in], assume_unique=True))
    return x_in + y_in - 2 * shared + abs((nx - x_in) - (ny - y_in))


def _siblings(num: int, den: int, sparse: bool):
    """Pairs (hub, key, sure) of a star's members in different components, one of
    them open at least, that are linked (sure) or may be.  Members found to be
    linked are of one component from then on, so a group of m members that are
    all linked gives m - 1 pairs; if sparse, so are members that may be linked."""

    def run(table: pa.Table) -> pa.Table:
        pair = (table.column("i")[0].as_py(), table.column("j")[0].as_py())
        table = table.sort_by("key")
        key, n, a, b, own = (table.column(c).to_numpy() for c in ("key", "n", "a", "b", "own"))
        open_, block = table.column("open").to_numpy(), table.column("block").to_numpy()
        own = np.unique(own, return_inverse=True)[1]

        def lists(name: str) -> list[np.ndarray]:
            column = table.column(name).combine_chunks()
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            flat, at = column.flatten().to_numpy().view(np.uint64), np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
            return [flat[u:v] for u, v in zip(at, at[1:])]

        gained, lost = lists("gained"), lists("lost")
        more_a, more_b = a - np.array([len(x) for x in gained]), b - np.array([len(x) for x in lost])
        met_a, met_b = _Index(gained), _Index(lost)
        rows, out = np.arange(len(key)), []
        for x in np.flatnonzero(block == pair[0] if pair[0] != pair[1] else open_):
            other = (block == pair[1]) & (open_[x] | open_) if pair[0] != pair[1] else ~open_ | (rows > x)
            limit = (n[x] + n) * (den - num) // (den + num)
            other &= (own != own[x]) & (np.abs(n[x] - n) <= limit)
            if not other.any():
                continue
            sure = more_a[x] + more_b[x] + more_a + more_b == 0
            common_a = np.minimum(met_a.common(gained[x]) + more_a[x] + more_a, np.minimum(a[x], a))
            common_b = np.minimum(met_b.common(lost[x]) + more_b[x] + more_b, np.minimum(b[x], b))
            near = np.flatnonzero(other & (a[x] + a - 2 * common_a + b[x] + b - 2 * common_b <= limit))
            for y in near[np.argsort(~sure[near], kind="stable")]:
                if own[y] == own[x]:
                    continue
                if not sure[y] and least_apart(gained[x], a[x], gained[y], a[y]) + least_apart(lost[x], b[x], lost[y], b[y]) > limit[y]:
                    continue
                if sure[y] or sparse:
                    own[own == own[y]] = own[x]
                out.append((int(key[x]), int(key[y]), bool(sure[y])))
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table({"hub": pa.array(cols[0], pa.int64()), "key": pa.array(cols[1], pa.int64()), "sure": pa.array(cols[2], pa.bool_())})

    return run


def residual_links(stars: DataFrame, links: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Links that the pairs with hubs have not led to.

    Such a link lies between two members x, y of one hub's star, in different
    components; at least one is not linked with the hub (it is open).  Let Ax be
    what x has and the hub lacks, Bx what the hub has and x lacks.  x and y differ
    in the symmetric differences of Ax, Ay and of Bx, By.  Where all four are
    listed whole, that settles the pair; else, what is listed gives the least
    they can differ in (least_apart), and only pairs within the limit are compared
    whole.  A star's members travel as lists; stars of over STAR members are cut
    into blocks that meet each other.  If pairs have to be compared whole, the
    first round takes as many as connect those that may be linked, and a second
    one those that are still apart.
    """
    found, unsure = _residual_round(stars, links, texts, width, num, den, True)
    if not unsure:
        return found
    again, _ = _residual_round(stars, links.unionByName(found), texts, width, num, den, False)
    return found.unionByName(again)


def _residual_round(stars: DataFrame, links: DataFrame, texts: DataFrame, width: int, num: int, den: int, sparse: bool) -> tuple[DataFrame, bool]:
    """Links of one round, and whether pairs were compared whole for it."""
    comp = materialize(connected_components(links), "jaccard-comp")
    small = comp.count() <= BROADCAST_ROWS
    near = lambda df: F.broadcast(df) if small else df
    own = near(comp.select(F.col("node").alias("key"), F.col("component").alias("own")))
    main = near(comp.select(F.col("node").alias("hub"), F.col("component").alias("main")))
    slim = stars.select("hub", "key", "linked").join(own, "key", "left").join(main, "hub", "left")
    slim = slim.select("hub", "key", F.coalesce("own", "key").alias("own"), (~F.col("linked") & (F.coalesce("own", "key") != F.coalesce("main", "hub"))).alias("open"))
    sizes = slim.groupBy("hub").agg(F.count("*").alias("m"), F.max("open").alias("any")).where("any and m > 1")
    sizes = materialize(sizes.select("hub", F.ceil(F.col("m") / STAR).alias("blocks")), "jaccard-open")
    placed = stars.drop("linked").withColumnRenamed("nk", "n").join(_near(sizes), "hub")
    linked = F.col("a") + F.col("b") <= _limit(F.col("nh"), F.col("n"), num, den)
    placed = placed.join(own, "key", "left").join(main, "hub", "left").withColumns({"own": F.coalesce("own", "key"), "main": F.coalesce("main", "hub")})
    placed = placed.withColumns({"open": ~linked & (F.col("own") != F.col("main")), "block": F.pmod(F.xxhash64("key"), "blocks")})
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    placed = placed.select("hub", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", *_MEMBERS)
    found = placed.groupBy("hub", "i", "j").applyInArrow(_siblings(num, den, sparse), "hub long, key long, sure boolean")
    found = materialize(found.groupBy(F.least("hub", "key").alias("hub"), F.greatest("hub", "key").alias("key")).agg(F.max("sure").alias("sure")), "jaccard-siblings")
    sure = found.where("sure").select(F.col("hub").alias("a"), F.col("key").alias("b"))
    if found.where("not sure").isEmpty():
        return sure, False
    whole = compare(found.where("not sure").select("hub", "key"), texts, width, num, den)
    whole = whole.where(F.col("a") + F.col("b") <= _limit(F.col("nh"), F.col("nk"), num, den)).select(F.col("hub").alias("a"), F.col("key").alias("b"))
    return materialize(sure.unionByName(whole), "jaccard-siblings"), True


def text_keys(text: str = "text"):
    return F.xxhash64(F.lit("jaccard"), F.coalesce(F.col(text), F.lit("")))


def classes_of(docs: DataFrame, width: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """From rows (doc_id, text): slim rows (doc_id, k, n), and the class c of
    every k whose text has words."""
    keyed = docs.withColumn("k", text_keys())
    links = class_links(keyed.select("k", "text"), width, num, den)
    slim = keyed.select("doc_id", "k", "text").mapInArrow(_slim(width), f"doc_id {dict(docs.dtypes)['doc_id']}, k long, n long")
    slim = materialize(slim, "jaccard-slim")
    comp = connected_components(links).withColumnRenamed("node", "k")
    first = slim.where("n > 0").groupBy("k").agg(F.min("doc_id").alias("least"))
    classes = first.join(comp, "k", "left").select("k", "least", F.coalesce("component", "k").alias("c"))
    return slim, materialize(classes, "jaccard-classes")


def join_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    slim, classes = classes_of(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), width, num, den)
    least = classes.groupBy("c").agg(F.min("least").alias("component_id"))
    named = materialize(classes.join(least, "c").select("k", "component_id"), "jaccard-named")
    return slim.join(named, "k", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id (nulls
    last), of the smallest text key among equals.  Rows without words stay."""
    slim, classes = classes_of(docs.select("doc_id", "text"), width, num, den)
    placed = slim.where("n > 0").join(classes.select("k", "c"), "k")
    entry = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")
    best = placed.groupBy("c").agg(F.min(entry).alias("best"))
    kept = best.select(F.col("best.doc_id").alias("best_id"), F.col("best.k").alias("best_k"), "c")
    judged = placed.join(kept, "c")
    out = materialize(
        judged.where((F.col("k") != F.col("best_k")) | ~F.col("doc_id").eqNullSafe(F.col("best_id"))).select(F.col("doc_id").alias("_id"), F.col("k").alias("_k")).distinct(), "near-dropped"
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    whole = docs.select(row, F.col("doc_id").alias("_doc"), text_keys().alias("_key"))
    left = whole.join(_near(out), F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")), "left_anti")
    # rows that recur whole: one stays, if they have words
    recurring = materialize(placed.groupBy("doc_id", "k").agg(F.count("*").alias("m")).where("m > 1").select(F.col("doc_id").alias("_id"), F.col("k").alias("_k")), "near-recurring")
    if recurring.isEmpty():
        return left.select("_row.*")
    again = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k"))
    several = left.join(_near(recurring), again, "left_semi").groupBy("_doc", "_key").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return left.join(_near(recurring), again, "left_anti").select("_row.*").unionByName(several.select("_row.*"))


def _slim(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            for start, sets in shingle_sets(batch.column("text"), width):
                n[start : start + len(sets)] = [len(s) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("k"), pa.array(n)], names=["doc_id", "k", "n"])

    return run


def query(spark, sf_dir: str) -> DataFrame:
    return join_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
