"""License scans by an exact set-similarity join (DataFrame functions only).

Base labels come from phrases whose words stand consecutively.  Besides, every
line of every text is a block, and so is every run of words, across line ends,
that is no longer than the template's words divided by ``threshold``.  Each
(template, block) pair whose block holds at least ``threshold`` of the
template's distinct words is found, none missed:

* words are ordered by how many texts hold them, rarest first, counted over
  all texts for the templates' vocabulary (no other word can add to an overlap);
* a template needs ``c = ceil(threshold * size)`` common words, so a block must
  share one of the template's first ``size - c + 1`` words (prefix filter) at a
  place that leaves enough words on both sides (positional filter), and must
  have at least c words of the vocabulary (length filter);
* the survivors' overlaps are counted exactly;
* a window lies in its text, so the words of whole texts go through the same
  filters first.  Of the (text, template) pairs that remain, those whose lines
  hold all that the text has of the template are settled; only the texts of the
  others are read again, and their windows counted.

One pass over the text keeps, per document, the counts and the blocks that pass
the least length; equal blocks are verified once.  The template side is a
parameter; it is broadcast in parts of at most MAX_TEMPLATES, one after another.

Edge cases: a null text is empty; a text without words has no label and score
0; repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.llm.text import ascii_lower
from gridloom.plans.staging import materialize

#: Words here: anything but ASCII that is neither digit nor lower-case letter.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same without the line feed.
IN_LINE = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Opening statements of public licenses.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
MAX_TEMPLATES = 5_000


def template_rows(templates=None, threshold: float = 0.9) -> list[tuple]:
    """(id, label, distinct words, least overlap, longest window) of each template."""
    rows = []
    for label, text in templates or TEMPLATES:
        words = sorted(set(text.split()))
        rows.append((len(rows), label, words, math.ceil(threshold * len(words) - 1e-9), math.ceil(len(text.split()) / threshold - 1e-9)))
    return rows


def _literal(words: list[str]):
    return F.split(F.lit(" ".join(words)), " ")


def scan_texts(docs: DataFrame, templates: list[tuple], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_words, places of the phrases, ``_blocks`` (vocabulary
    words of each line that has enough of them), ``_vocab`` (vocabulary words of
    the text), ``_wrapped`` (words on more than one line) and the content key."""
    least = min(r[3] for r in templates)
    vocab = _literal(sorted({w for r in templates for w in r[2]}))
    t = F.coalesce(F.col(text), F.lit(""))
    staged = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(t).alias("_k1"), F.xxhash64(F.lit("second"), t).alias("_k2"),
        F.regexp_replace(ascii_lower(t), IN_LINE, " ").alias("_n"),
    )
    staged = staged.withColumns({
        "n_words": F.regexp_count("_n", F.lit(r"[^ \n]+")).cast("long"),
        "_blocks": F.filter(F.transform(F.split("_n", "\n", -1), lambda line: F.array_intersect(F.split(line, " "), vocab)), lambda b: F.size(b) >= least),
        "_vocab": F.array_intersect(F.split("_n", "[ \n]+"), vocab),
        "_flat": F.when(
            F.col("_n").rlike("|".join(p.replace(" ", r"[ \n]+") for p in PHRASES)),
            F.concat(F.lit(" "), F.trim(F.regexp_replace("_n", r"[ \n]+", " ")), F.lit(" ")),
        ),
    })
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        gaps = F.split("_flat", f" {phrase}(?= )", -1)
        n = F.coalesce(F.size(gaps) - 1, F.lit(0))
        n = F.when(F.col("_flat").isNull(), 0).otherwise(n)
        counts.append(n)
        firsts.append(F.when(n > 0, spaces(F.element_at(gaps, 1))))
        lasts.append(F.when(n > 0, F.col("n_words") - (spaces(F.element_at(gaps, -1)) - 1) - len(phrase.split())))
        labels.append(F.when(n > 0, F.lit(label)))
    return staged.select(
        "doc_id", "n_words", sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"), F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("_base"), "_blocks", "_vocab", "_k1", "_k2",
        F.col("_n").rlike(r"[^ \n] *\n[ \n]*[^ \n]").alias("_wrapped"),
    )


def containment_join(blocks: DataFrame, order: list[str], templates: list[tuple], keys: list[str], words: str) -> DataFrame:
    """(keys, tid, label, t_size, overlap) of every row of ``blocks``, a set of
    vocabulary words, that holds enough of a template; ``order`` is the
    vocabulary, rarest word first."""
    rank = {w: i for i, w in enumerate(order)}
    ranked = _literal(order)
    prefix = [
        (w, i, tid, label, members, len(members), c)
        for tid, label, members, c, _ in templates
        for i, w in enumerate(sorted(members, key=rank.get)[: len(members) - c + 1])
    ]
    prefixes = F.broadcast(blocks.sparkSession.createDataFrame(prefix, "word string, i int, tid int, label string, words array<string>, t_size int, c int"))
    by_rank = F.transform(F.array_sort(F.transform(words, lambda w: F.struct(F.array_position(ranked, w), w.alias("w")))), lambda s: s["w"])
    probes = blocks.select(*keys, F.col(words).alias("_b"), F.size(words).alias("b_size"), F.posexplode(by_rank).alias("j", "word"))
    enough = (
        (F.col("b_size") >= F.col("c"))
        & (F.col("j") <= F.col("b_size") - F.col("c"))
        & (1 + F.least(F.col("t_size") - F.col("i") - 1, F.col("b_size") - F.col("j") - 1) >= F.col("c"))
    )
    overlap = F.size(F.array_intersect("_b", "words"))
    return probes.join(prefixes, "word").where(enough).select(*keys, "tid", "label", "t_size", "c", overlap.alias("overlap")).where("overlap >= c").drop("c").distinct()


def window_hits(docs: DataFrame, open_pairs: DataFrame, templates: list[tuple], text: str) -> DataFrame:
    """(_k1, _k2, tid, label, t_size, overlap) of the pairs of ``open_pairs``
    (_k1, _k2, tid) of which a window of the text holds enough."""
    t = F.coalesce(F.col(text), F.lit(""))
    sides = docs.sparkSession.createDataFrame(templates, "tid int, label string, words array<string>, c int, span int")
    spread = F.array_remove(F.split(F.regexp_replace(ascii_lower(t), SEPARATORS, " "), " "), "")
    keyed = docs.select(F.xxhash64(t).alias("_k1"), F.xxhash64(F.lit("second"), t).alias("_k2"), F.col(text))
    texts = keyed.join(open_pairs.groupBy("_k1", "_k2").agg(F.collect_set("tid").alias("_tids")), ["_k1", "_k2"])
    asked = texts.select("_k1", "_k2", F.explode("_tids").alias("tid"), spread.alias("_s")).join(F.broadcast(sides), "tid")
    places = F.filter(F.transform("_s", lambda w, i: F.struct(i.alias("p"), w.alias("w"))), lambda x: F.array_contains("words", x["w"]))

    def held(hit: Column, i: Column) -> Column:
        near = F.filter(F.slice(F.col("_at"), i + 1, F.col("span")), lambda y: y["p"] < hit["p"] + F.col("span"))
        return F.size(F.array_distinct(F.transform(near, lambda y: y["w"])))

    asked = asked.select("_k1", "_k2", "tid", "label", "c", "span", F.size("words").alias("t_size"), places.alias("_at"))
    overlap = F.array_max(F.transform("_at", held))
    return asked.select("_k1", "_k2", "tid", "label", "t_size", "c", overlap.alias("overlap")).where("overlap >= c").drop("c").distinct()


def containments(docs: DataFrame, rows: list[tuple], id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The scan of the texts, and (_k1, _k2, tid, label, t_size, overlap) of every
    template that a line or window of a text holds enough of."""
    scanned = materialize(scan_texts(docs, rows, id_col, text), "license-scan")
    seen = dict(scanned.select(F.explode("_vocab").alias("w")).groupBy("w").agg(F.count("*")).collect())  # at most the vocabulary
    order = sorted({w for r in rows for w in r[2]}, key=lambda w: (seen.get(w, 0), w))
    keys = ["_k1", "_k2"]
    holders = scanned.where(F.size("_blocks") > 0).select(*keys, F.explode("_blocks").alias("b")).select(*keys, F.array_sort("b").alias("block")).distinct()
    hits = containment_join(holders.select("block").distinct(), order, rows, ["block"], "block")
    in_lines = materialize(holders.join(hits, "block").select(*keys, "tid", "label", "t_size", "overlap"), "license-lines")
    # what no line holds as much of as the text does
    whole = containment_join(scanned.where("_wrapped"), order, rows, keys, "_vocab")
    open_pairs = materialize(whole.join(in_lines.select(*keys, "tid", "overlap"), [*keys, "tid", "overlap"], "left_anti").select(*keys, "tid"), "license-open")
    return scanned, in_lines.union(window_hits(docs, open_pairs, rows, text))


def label_documents(docs: DataFrame, templates=None, threshold: float = 0.9, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, counts and places of the phrases, their
    labels, all labels, and the best containment (1 for a phrase)."""
    rows = template_rows(templates, threshold)
    keys = ["_k1", "_k2"]
    scanned = found = None
    for i in range(0, len(rows), MAX_TEMPLATES):
        one, hits = containments(docs, rows[i : i + MAX_TEMPLATES], id_col, text)
        scanned, found = scanned or one, hits if found is None else found.union(hits)
    found = found.groupBy(*keys).agg(F.collect_set("label").alias("_more"), F.max(F.col("overlap") / F.col("t_size")).alias("_score"))
    out = scanned.drop("_blocks", "_vocab", "_wrapped").join(materialize(found, "license-labels"), keys, "left")
    none = F.array().cast("array<string>")
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("_base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", F.coalesce("_more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_score", F.lit(0.0))).alias("score"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return label_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def sql(docs: str = "documents", threshold: float = 0.9) -> str:
    """DuckDB's SQL: phrases over positioned words, and all (template, line)
    overlaps without filters."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    values = ", ".join(f"({tid}, '{label}', {words!r}, {c})" for tid, label, words, c, _ in template_rows(threshold=threshold))
    phrases = " UNION ALL ".join(
        f"SELECT rid, p, '{label}' AS label FROM q10_w WHERE " + " AND ".join(f"w{k} = '{w}'" for k, w in enumerate(phrase.split()))
        for phrase, label in PHRASES.items()
    )
    return rf"""
WITH q10_d AS (SELECT row_number() OVER () AS rid, doc_id, {lower} AS t FROM {docs}),
q10_a AS (SELECT rid, regexp_extract_all(t, '{word}') AS ws FROM q10_d),
q10_u AS (SELECT rid, unnest(ws) AS w0, unnest(range(len(ws))) AS p FROM q10_a),
q10_w AS (SELECT rid, p, w0, lead(w0, 1) OVER o AS w1, lead(w0, 2) OVER o AS w2, lead(w0, 3) OVER o AS w3 FROM q10_u WINDOW o AS (PARTITION BY rid ORDER BY p)),
q10_p AS ({phrases}),
q10_b AS (SELECT rid, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM q10_p GROUP BY 1),
q10_l AS (SELECT rid, list_distinct(regexp_extract_all(line, '{word}')) AS b FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM q10_d)),
q10_t(tid, label, words, c) AS (VALUES {values}),
q10_h AS (SELECT rid, label, len(list_intersect(b, words)) / len(words) AS score FROM q10_l, q10_t WHERE len(list_intersect(b, words)) >= c),
q10_x AS (SELECT rid, label FROM q10_h UNION SELECT rid, label FROM q10_p),
q10_g AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels FROM q10_x GROUP BY 1),
q10_s AS (SELECT rid, max(score) AS score FROM q10_h GROUP BY 1)
SELECT doc_id, len(ws)::bigint AS n_words, coalesce(n_base, 0)::bigint AS n_base, first_word::bigint AS first_word, last_word::bigint AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0) END::double AS score
FROM q10_d JOIN q10_a USING (rid) LEFT JOIN q10_b USING (rid) LEFT JOIN q10_g USING (rid) LEFT JOIN q10_s USING (rid)"""
