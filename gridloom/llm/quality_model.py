"""Quality classifier: histogram gradient-boosted trees on document statistics.

The statistics are ratios and counts that DataFrame functions compute in one
pass over the whole text.  Training takes a bounded sample of labelled rows (at
most ``max_rows``, those with the smallest hash of their id), bins each
statistic by quantiles and grows trees level by level on gradient and hessian
histograms for logistic loss.  The trees are flattened into arrays (feature,
threshold, children, leaf value) that numpy walks for a whole Arrow batch at
once, one level of all trees per step.

Scores never see labels, language, source or id.  Edge cases: null and empty
texts have statistics of 0 and are scored like any other; repeated rows score
equally; repeated or null labels: the smallest label of an id counts, nulls do
not; without labels of both kinds every score is the share of label 1 (1/2
without any); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridloom.llm.text import WORD

FEATURES = (
    "log_words", "mean_word", "symbol_share", "upper_share", "digit_share", "marks_per_word", "stops_per_word", "bar_share",
    "distinct_share", "distinct_pairs", "line_words", "distinct_lines", "wide_share", "other_share", "adjacent_same",
)
MAX_ROWS = 50_000


def statistics(text: Column, keep: list[Column], docs: DataFrame) -> DataFrame:
    """``keep`` and one double column per feature."""
    t = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    x = docs.select(*keep, t.alias("_t"), words.alias("_w"))
    n, chars = F.greatest(F.size("_w"), F.lit(1)), F.greatest(F.length("_t"), F.lit(1))
    count = lambda pattern: F.regexp_count("_t", F.lit(pattern))
    hashes = F.transform("_w", lambda w: F.xxhash64(w))
    x = x.select(*[F.col(c) for c in x.columns if c not in ("_w",)], F.size("_w").alias("_n"), F.length(F.array_join("_w", "")).alias("_c"), hashes.alias("_h"), n.alias("_n1"), chars.alias("_len"))
    last = F.greatest(F.size("_h") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("_h", 1, last), F.slice("_h", 2, last), lambda a, b: F.xxhash64(a, b))
    same = F.zip_with(F.slice("_h", 1, last), F.slice("_h", 2, last), lambda a, b: (a == b).cast("int"))
    lines = F.filter(F.split("_t", "\n", -1), lambda s: s != "")
    n, chars = F.col("_n1"), F.col("_len")
    values = {
        "log_words": F.log1p(F.col("_n").cast("double")),
        "mean_word": F.col("_c") / n,
        "symbol_share": count(r"[#*$%&<>~^_{}\\]") / chars,
        "upper_share": count(r"\p{Lu}") / chars,
        "digit_share": count(r"[0-9]") / chars,
        "marks_per_word": count(r"[!?]") / n,
        "stops_per_word": count(r"[.,;:]") / n,
        "bar_share": count(r"[|=]") / n,
        "distinct_share": F.size(F.array_distinct("_h")) / n,
        "distinct_pairs": F.size(F.array_distinct(pairs)) / n,
        "line_words": F.col("_n") / F.greatest(F.size(lines), F.lit(1)),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "wide_share": F.size(F.filter(F.split("_t", WORD), lambda s: F.length(s) > 1)) / n,
        "other_share": count(r"[^\p{L}\p{N}\p{P}\s]") / chars,
        "adjacent_same": F.aggregate(same, F.lit(0), lambda a, b: a + b) / n,
    }
    return x.select(*[F.col(c) for c in x.columns if not c.startswith("_")], *[values[f].cast("double").alias(f) for f in FEATURES])


@dataclass
class Forest:
    """Trees as arrays over nodes; a leaf is its own child."""

    feature: np.ndarray  # trees x nodes
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1 for the rows of ``x``."""
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            go = x[rows, self.feature[trees, node]] <= self.threshold[trees, node]
            node = np.where(go, self.left[trees, node], self.right[trees, node])
        total = self.base + self.value[trees, node].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, least: int = 20, l2: float = 1.0) -> Forest:
    """Boosts ``trees`` trees of ``depth`` levels on logistic loss."""
    n, f = x.shape if x.ndim == 2 else (0, len(FEATURES))
    share = float(y.mean()) if n else 0.5
    size = 2 ** (depth + 1) - 1
    kids = np.arange(size)
    shape = (max(trees, 1), size)
    empty = Forest(np.zeros(shape, np.int64), np.zeros(shape), np.tile(kids, (shape[0], 1)), np.tile(kids, (shape[0], 1)), np.zeros(shape), 0.0, depth)
    if n == 0 or share in (0.0, 1.0):
        empty.base = {0.0: -40.0, 1.0: 40.0}.get(share, 0.0)
        return empty
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)]
    code = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(f)], axis=1)  # x <= cut k  <=>  code <= k
    forest = empty
    forest.base = float(np.log(share / (1 - share)))
    raw = np.full(n, forest.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        live = [0]
        for _ in range(depth):
            following = []
            for m in live:
                at = np.flatnonzero(node == m)
                gs, hs, best = g[at].sum(), h[at].sum(), (1e-6, None, None)
                for j in range(f):
                    if not len(cuts[j]) or len(at) < 2 * least:
                        continue
                    k = len(cuts[j]) + 1
                    c = code[at, j]
                    gl, hl, nl = (np.bincount(c, w, k)[:-1].cumsum() for w in (g[at], h[at], None))
                    gain = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
                    gain[(nl < least) | (len(at) - nl < least)] = -1
                    b = int(gain.argmax())
                    if gain[b] > best[0]:
                        best = (gain[b], j, b)
                if best[1] is None:
                    continue
                _, j, b = best
                forest.feature[t, m], forest.threshold[t, m] = j, cuts[j][b]
                forest.left[t, m], forest.right[t, m] = 2 * m + 1, 2 * m + 2
                go = code[at, j] <= b
                node[at[go]], node[at[~go]] = 2 * m + 1, 2 * m + 2
                following += [2 * m + 1, 2 * m + 2]
            live = following
        sums, weight = np.bincount(node, g, size), np.bincount(node, h, size)
        forest.value[t] = -rate * sums / (weight + l2)
        raw += forest.value[t][node]
    return forest


def _scorer(forest: Forest, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES], axis=1)
            score = np.concatenate([forest.score(x[a : a + 4096]) for a in range(0, len(x), 4096)]) if len(x) else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(score)], names=names + ["score"])

    return run


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """At most ``max_rows`` labelled, not held out documents with statistics.

    The bound is applied to ids before any text is read; ``limit`` after an
    order is a top-k that every task prunes."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    own = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # max_rows ids and labels
    return statistics(F.col("text"), [F.col("doc_id"), F.col("quality")], own)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, **options) -> Forest:
    # of an id that recurs with other texts, the text of the smallest statistics
    one = labelled_sample(docs, labels, max_rows).groupBy("doc_id").agg(F.min(F.struct(*FEATURES, "quality")).alias("row"))
    rows = one.select("doc_id", "row.*").orderBy("doc_id").toPandas()
    return train(rows[list(FEATURES)].to_numpy(np.float64), rows["quality"].to_numpy(np.float64), **options)


def score_documents(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    x = statistics(F.col("text"), [F.col("doc_id")], docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    kind = dict(x.dtypes)["doc_id"]
    return x.mapInArrow(_scorer(forest, ["doc_id"]), f"doc_id {kind}, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    forest = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_documents(docs, forest)
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )
