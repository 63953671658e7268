"""Quality rules with cross-document line frequency (DataFrame functions only).

Each document gets its in-text statistics in one pass over the text.  Lines are
normalised and hashed; per host, the number of *different texts* holding a line
is counted, lines above the limits are struck out, and a document that loses
more than a given part of its words is rejected as depleted.  ``filter_documents``
gives the other documents back with the struck lines cut out of their texts.

Only hashes, counts and ids are shuffled, never text.  Exact copies are one
document to the line counts, so a page copied a thousand times does not turn
its own lines into boilerplate; the copies share one verdict.

Edge cases: a null or empty text has no words, no lines and fails the base
rules; a null host is the empty host; repeated rows get equal verdicts; other
columns pass through whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.llm.text import WORD, fresh
from gridloom.plans.staging import materialize

SYMBOLS = r"[#*$%&|<>]"


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """Words that stand in a window of ``width`` words found at least twice.

    Windows are 64-bit hashes.  A text without a repeated window is settled by
    one hash-set pass; else windows are sorted with their positions, and the
    union of the repeated ones is measured in order of position.
    """
    one = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)  # noqa: E731  binds once

    def windows(h: Column) -> Column:
        n = F.size(h) - (width - 1)
        acc = F.slice(h, 1, n)
        for k in range(1, width):
            acc = F.zip_with(acc, F.slice(h, 1 + k, n), lambda a, b: F.xxhash64(a, b))
        return acc

    def covered(w: Column) -> Column:
        pairs = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def positions(s: Column) -> Column:
            n = F.size(s) - 1
            both = F.zip_with(
                F.slice(s, 1, n), F.slice(s, 2, n),
                lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])).otherwise(F.array().cast("array<int>")),
            )
            return F.array_sort(F.array_distinct(F.flatten(both)))

        start = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last"))
        step = lambda acc, p: F.struct(
            (acc["n"] + F.least(F.lit(width), p - acc["last"])).alias("n"), p.alias("last")
        )
        return F.aggregate(one(pairs, positions), start, step, lambda acc: acc["n"]).cast("long")

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= width, F.lit(0).cast("long")).otherwise(
        one(hashes, lambda h: one(windows(h), count))
    )


def normal_line(line: Column) -> Column:
    """The form in which lines are compared: lower case, white space collapsed."""
    return F.trim(F.lower(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")))


def base_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, the base statistics, a content key (``_k1``, ``_k2``)
    and ``_lines``: hash and word count of each line that has a word."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    staged = docs.select(
        *(keep or []),
        t.alias("_t"),
        words.alias("_w"),
        F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)).alias("_l"),
    )
    return staged.select(
        *(keep or []),
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("_w")).alias("n_repeat_words"),
        F.xxhash64("_t").alias("_k1"),
        F.xxhash64(F.lit("second"), F.col("_t")).alias("_k2"),
        F.transform(
            "_l", lambda x: F.struct(F.xxhash64(normal_line(x)).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w"))
        ).alias("_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def frequent_lines(stats: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """(_host, h): lines that stand in at least ``min_docs`` different texts of
    a host and in more than ``max_share`` of its different texts."""
    texts = stats.groupBy("_host", "_k1", "_k2").agg(F.first("_lines").alias("_lines"))
    per_text = texts.select("_host", F.explode(F.array_distinct(F.transform("_lines", lambda x: x["h"]))).alias("h"))
    n_docs = per_text.groupBy("_host", "h").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    n_host = texts.groupBy("_host").agg(F.count("*").alias("n_host"))
    return n_docs.join(n_host, "_host").where(F.col("n") > max_share * F.col("n_host")).select("_host", "h")


def removed_words(stats: DataFrame, frequent: DataFrame) -> DataFrame:
    """(_host, _k1, _k2, removed_words, _struck) of the texts that lose a line;
    ``_struck`` are the hashes of the lost lines."""
    lines = (
        stats.groupBy("_host", "_k1", "_k2")
        .agg(F.first("_lines").alias("_lines"))
        .select("_host", "_k1", "_k2", F.explode("_lines").alias("_x"))
        .select("_host", "_k1", "_k2", F.col("_x.h").alias("h"), F.col("_x.w").alias("w"))
    )
    return (
        lines.join(frequent, ["_host", "h"])
        .groupBy("_host", "_k1", "_k2")
        .agg(F.sum("w").cast("long").alias("removed_words"), F.collect_set("h").alias("_struck"))
    )


def strike(text: Column, hashes: Column) -> Column:
    """The text without the lines whose normal form has one of the hashes."""
    lost = lambda x: x.rlike(WORD) & F.array_contains(hashes, F.xxhash64(normal_line(x)))
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~lost(x)), "\n")


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source",
    min_docs: int = 20, max_share: float = 0.1, max_removed: float = 0.7,
) -> DataFrame:
    """One row per document: id, base statistics, ``base_failed``,
    ``removed_words`` and ``kept``."""
    stats = base_statistics(
        docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"), F.col(text).alias("text")),
        "text", ["doc_id", "_host"],
    )
    stats = materialize(stats, "quality-stats")
    gone = materialize(removed_words(stats, frequent_lines(stats, min_docs, max_share)), "quality-removed")
    depleted = F.col("removed_words") > max_removed * F.col("n_words")
    return (
        stats.drop("_lines")
        .join(gone, ["_host", "_k1", "_k2"], "left")
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            base_failed().alias("base_failed"),
            F.coalesce("removed_words", F.lit(0)).cast("long").alias("removed_words"),
            "_host", "_k1", "_k2", "_struck",
        )
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(depleted, F.lit(False)))
    )


def filter_documents(
    docs: DataFrame, text: str = "text", host: str = "source",
    min_docs: int = 20, max_share: float = 0.1, max_removed: float = 0.7,
) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns; the frequent lines
    are cut out of their texts, and ``n_chars``, if there, is counted anew.

    Verdict and struck lines depend on host and text alone, so they come back by
    their key; only the texts that are rejected or lose a line stand on the other
    side of the join.
    """
    h, k1, k2, kept, struck = fresh(docs, "_host", "_k1", "_k2", "_kept", "_struck")
    verdicts = score_documents(docs.select(F.lit(0).alias("_id"), F.col(host).alias("_src"), F.col(text).alias("_txt")), "_id", "_txt", "_src", min_docs, max_share, max_removed)
    marks = materialize(
        verdicts.where(~F.col("kept") | F.col("_struck").isNotNull())
        .select(F.col("_host").alias(h), F.col("_k1").alias(k1), F.col("_k2").alias(k2), F.col("kept").alias(kept), F.col("_struck").alias(struck)).distinct(),
        "quality-marks",
    )
    t = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.withColumns({
        h: F.coalesce(F.col(host).cast("string"), F.lit("")), k1: F.xxhash64(t), k2: F.xxhash64(F.lit("second"), t),
    })
    passed = keyed.join(marks, [h, k1, k2], "left").where(F.coalesce(F.col(kept), F.lit(True)))
    cut = F.when(F.col(struck).isNull(), F.col(text)).otherwise(strike(F.col(text), F.col(struck)))
    new = {text.lower(): cut}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(struck).isNull(), F.col("n_chars")).otherwise(F.length(cut).cast("long"))
    return passed.select(*[new.get(c.lower(), F.col(f"`{c}`")).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_words", "kept"
    )


def sql(docs: str = "documents", min_docs: int = 20, max_share: float = 0.1, max_removed: float = 0.7) -> str:
    """The same in DuckDB's SQL, by windows over whole tables."""
    w = r"[^\x20\x09-\x0D]+"
    return rf"""
WITH q7_d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM {docs}),
q7_w AS (SELECT rid, u.w AS w, u.p AS p FROM (SELECT rid, regexp_extract_all(t, '{w}') AS ws FROM q7_d) x, LATERAL (SELECT unnest(ws) AS w, unnest(range(len(ws))) AS p) u),
q7_g AS (SELECT rid, p, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS g FROM q7_w WINDOW o AS (PARTITION BY rid ORDER BY p)),
q7_r AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS n FROM q7_g WHERE g IS NOT NULL) WHERE n >= 2),
q7_c AS (SELECT rid, count(DISTINCT p + k) AS n_repeat_words FROM q7_r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY 1),
q7_b AS (SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars FROM q7_w GROUP BY 1),
q7_l AS (SELECT rid, host, t, line FROM (SELECT rid, host, t, unnest(string_split(t, chr(10))) AS line FROM q7_d) WHERE regexp_matches(line, '{w}')),
q7_n AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM q7_l GROUP BY 1),
q7_x AS (SELECT rid, host, t, trim(lower(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS line, len(regexp_extract_all(line, '{w}')) AS w FROM q7_l),
q7_f AS (SELECT x.host, x.line FROM (SELECT host, line, count(DISTINCT t) AS n FROM q7_x GROUP BY 1, 2) x
         JOIN (SELECT host, count(DISTINCT t) AS n_host FROM q7_d GROUP BY 1) h ON x.host = h.host WHERE n >= {min_docs} AND n > {max_share}::double * n_host),
q7_m AS (SELECT rid, sum(w) AS removed_words FROM q7_x JOIN q7_f USING (host, line) GROUP BY 1),
q7_s AS (SELECT d.doc_id, coalesce(n_words, 0)::bigint AS n_words, coalesce(word_chars, 0)::bigint AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint AS n_symbols, coalesce(n_dup_lines, 0)::bigint AS n_dup_lines,
  coalesce(n_repeat_words, 0)::bigint AS n_repeat_words, coalesce(removed_words, 0)::bigint AS removed_words
  FROM q7_d d LEFT JOIN q7_b USING (rid) LEFT JOIN q7_n USING (rid) LEFT JOIN q7_c USING (rid) LEFT JOIN q7_m USING (rid))
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (removed_words > {max_removed}::double * n_words) AS kept FROM q7_s"""
