"""What the methods themselves decide, on planted and labelled cases."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_contracts import WORD, brute, edge, empty, same_as_sql, texts  # noqa: F401

from gridloom.llm import ann, licenses, ngram_join, pii, quality_rules, secrets, sentencepiece, sharding
from conftest import SF


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randrange(3, 9))) for _ in range(n))


# ---------------------------------------------------------------- quality rules


def test_frequent_lines_reject_as_the_sql_does(spark, tmp_path):
    rng = random.Random(2)
    menu, footer = words(rng, 60), words(rng, 45)
    rows = []
    for i in range(120):
        host = "hot" if i % 3 else "cold"
        own = words(rng, 12 if i % 4 == 0 else 90)
        shown = [menu.title(), own, footer] if host == "hot" else [own, footer if i % 9 == 0 else words(rng, 50)]
        rows.append((i, "\n".join(shown), host))
    rows += [(500, None, "hot"), (501, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality_rules.score_documents(df).collect()}
    depleted = {i for i, r in got.items() if not r.base_failed and not r.kept}
    # hot documents of 12 own words lose 105 of 117; those of 90 words lose 105 of 195
    assert depleted == {i for i in range(120) if i % 3 and i % 4 == 0}
    path = str(tmp_path / "documents.parquet")
    df.write.parquet(path)
    import duckdb

    want = {r[0]: r for r in duckdb.sql(f"select doc_id, kept, removed_words from ({quality_rules.sql(docs=repr(path + '/*.parquet').replace(chr(34), chr(39)))})").fetchall()}
    assert {i: (r.kept, r.removed_words) for i, r in got.items()} == {i: (k, n) for i, k, n in want.values()}
    kept = {r.doc_id: r.text for r in quality_rules.filter_documents(df).collect()}
    assert not depleted & set(kept) and all(menu.title() not in t for i, t in kept.items() if i % 3)


# ---------------------------------------------------------------------- secrets


def test_markov_models_on_held_out_tokens(spark):
    rng = random.Random(77)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secret = ["".join(rng.choice(alphabet) for _ in range(n)) for n in (16, 18, 20, 24, 32, 40) for _ in range(60)]
    secret = [s for s in secret if re.search("[0-9]", s) and re.search("[A-Za-z]", s)]
    styles = [lambda p: "_".join(p) + "_2024", lambda p: p[0] + "".join(x.title() for x in p[1:]) + "V2", lambda p: "-".join(p) + "-01", lambda p: "/".join(p) + "/2023"]
    plain = [rng.choice(styles)([rng.choice(secrets.PARTS) for _ in range(rng.randrange(3, 6))]) for _ in range(400)]
    plain = [p for p in plain if len(p) >= 16]
    rows = [(i, f"see {t} here") for i, t in enumerate(secret + plain)]
    got = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", F.size("found.random").alias("n")).collect()
    hit = {r.doc_id for r in got if r.n}
    recall = sum(i in hit for i in range(len(secret))) / len(secret)
    alarms = sum(i in hit for i in range(len(secret), len(rows))) / len(plain)
    assert recall >= 0.95 and alarms <= 0.01, (recall, alarms)
    assert all(i in hit for i in range(len(secret)) if len(secret[i]) >= 24)


def test_scan_and_redact_keep_clashing_columns(spark):
    df = spark.createDataFrame([(1, "token = abcdef123456", 20, "a", "b")], "doc_id long, text string, N_chars int, found string, _assign string")
    row = secrets.scan(df).first()
    assert row.found == "a" and row._assign == "b" and len(row["_found"].assign) == 1
    out = secrets.redact(df)
    assert out.columns == df.columns and out.first().text == "[SECRET]" and out.first().N_chars == 8


# -------------------------------------------------------------------- licenses


@pytest.mark.parametrize("part", [3, 14])
def test_templates_in_parts(spark, texts, monkeypatch, part):  # noqa: F811
    df = spark.createDataFrame(texts[:120], "doc_id long, text string")
    whole = sorted(map(tuple, licenses.label_documents(df).collect()))
    monkeypatch.setattr(licenses, "MAX_TEMPLATES", part)
    assert sorted(map(tuple, licenses.label_documents(df).collect())) == whole


# --------------------------------------------------------------------- sharding


def test_rows_alike_in_all_columns_are_numbered_without_gaps(spark):
    df = spark.createDataFrame([(7, "same")] * 9000 + [(i, f"t{i}") for i in range(50)], "doc_id long, text string")
    rows = sharding.shard_documents(df, 3).collect()
    assert len(rows) == 9050
    for shard in range(3):
        mine = sorted(r.slot for r in rows if r.shard == shard)
        assert mine == list(range(len(mine)))


# ------------------------------------------------------------------ neighbours


def exact(x, q):
    s = x @ x[q]
    return [i for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:20]


@pytest.mark.parametrize("case", ["unit", "norms", "turns"])
def test_hashing_reaches_its_recall(spark, monkeypatch, case):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if case == "norms":
        x *= np.exp(rng.standard_normal((1500, 1)) * 0.7)
    monkeypatch.setattr(ann, "EXACT", 0)
    monkeypatch.setattr(ann, "BUCKET", 8 if case == "turns" else 4096)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 30 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & set(exact(x, q))) for q in got) / (20 * len(got)) >= 0.9


def test_passes_file_vectors_once_and_miss_no_table(monkeypatch):
    monkeypatch.setattr(ann, "PASS", 1000)
    for vectors, asked, turns, reach in ((100, 5, 1, 8), (600, 30, 1, 20), (50_000, 2_500, 2, 9), (50_000, 2_500, 2, 0)):
        probes = math.comb(reach + turns, turns)
        found = ann.passes({16: [(0, 1.0, 2.0, turns, reach), (3, 8.0, 9.0, 0, 0)]}, vectors, asked, 10)
        assert found[0] == ([ann.WHOLE], 0, 1)
        assert sorted((t, part, parts) for some, part, parts in found[1:] for t in some) == [(t, part, found[1][2]) for t in range(10) for part in range(found[1][2])]
        for some, _, parts in found[1:]:
            assert len(some) * vectors <= max(1000, vectors) and 4 * asked * probes * len(some) / parts <= max(1000, vectors)
    x = np.random.default_rng(5).standard_normal((600, 16)).astype(np.float32)
    batch = pa.RecordBatch.from_pydict({"cls": range(600), "first": range(600), "v": pa.array(list(x), pa.list_(pa.float32())), "band": [0] * 600})
    filed = pa.Table.from_batches(ann._file([1], 11, {16: [(0, 0.5, 9.0, 1, 8)]}, False)(iter([batch])))
    assert filed.column("cls").to_pylist() == list(range(600)) and set(filed.column("tbl").to_pylist()) == {ann.table_of(16, 0, 1)}
    assert [np.frombuffer(v, "<f4").tolist() for v in filed.column("v").to_pylist()] == x.tolist()


def test_queries_go_to_the_vectors_once(spark, monkeypatch):
    """However many passes the tables take, vectors are read once for each part of the queries."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((1200, 16))
    written, asked = [], []
    keep = ann.materialize
    monkeypatch.setattr(ann, "materialize", lambda df, label: (written.append(label), keep(df, label))[1])
    monkeypatch.setattr(ann, "EXACT", 0)
    monkeypatch.setattr(ann, "PASS", 1200)
    monkeypatch.setattr(ann, "ASKING", 30, raising=False)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in ann.nearest(df, F.col("vec_id") % 24 == 0).collect():
        got[r.query_id].add(r.vec_id)
        asked.append(r.query_id)
    assert written.count("ann-best") <= 3 and "ann-blocks" not in written  # 50 queries, 27 at a time, and those left short
    assert set(collections.Counter(asked).values()) == {20} and len(got) == 50
    assert sum(len(got[q] & set(exact(x, q))) for q in got) / 1000 >= 0.9


@pytest.mark.parametrize("grid", [False, True])
def test_search_of_a_task_is_exact_in_small_pieces(monkeypatch, grid):
    """Whole comparison, with few products, vectors and candidates at a time, and ties."""
    for name, n in (("CHUNK", 150), ("TILE", 500), ("KEPT", 300)):
        monkeypatch.setattr(ann, name, n)
    x = np.random.default_rng(6).standard_normal((700, 8))
    x = np.round(x) if grid else x * 10.0 ** np.random.default_rng(7).integers(-150, 150, (700, 1))
    x[:, 0] += grid * 0.5  # none is zero
    batch = lambda at: pa.RecordBatch.from_pydict({"cls": at + 5, "first": at, "v": pa.array(list(x[at]), pa.list_(pa.float64())), "band": np.zeros(len(at), np.int32)})
    asked = np.arange(0, 700, 50)
    bars = next(ann._bars({8: x[:100]}, 21)(iter([batch(asked)])))

    class Sent:
        value = bars

    found = pa.Table.from_batches(ann._look(Sent, np.arange(100) + 5, 10, 11, None, 21)(batch(np.arange(a, a + 100)) for a in range(0, 700, 100))).to_pandas()
    for q in asked:
        value = ann.score(x[q], x)
        best = np.lexsort((np.arange(700), -value))[:21]
        mine = found[found.q == q + 5].sort_values(["score", "first"], ascending=[False, True])
        assert mine["first"].tolist() == best.tolist() and mine["score"].tolist() == value[best].tolist()


def test_ties_beyond_any_spare_place(spark):
    x = np.zeros((400, 8))
    x[:, 0] = 1
    x[1:, 1:] = np.random.default_rng(1).standard_normal((399, 7))  # all score 1 against the query
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = sorted((r.rank, r.vec_id) for r in ann.nearest(df, F.col("vec_id") == 0).collect())
    assert [v for _, v in got] == list(range(1, 21))


# ---------------------------------------------------------------- sentencepiece


def test_long_runs_without_spaces_equal_the_heap(monkeypatch):
    v = sentencepiece.Vocabulary.load()
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789+/") for _ in range(30_000)) + " and " + "the" * 400 + "日本語" * 300
    key = np.array([12345], np.uint64)
    for dropout in (0.0, 0.2):
        cut = sentencepiece.encode(v, [text], key, dropout)[0]
        together = v.tables()["together"]
        v.tables()["together"] = np.unique(np.array([ord(a) << 21 | ord(b) for a, b in set(zip(" " + text, text))], np.int64))  # no cuts
        whole = sentencepiece.encode(v, [text], key, dropout)[0]
        v.tables()["together"] = together
        assert cut.tolist() == whole.tolist() and sentencepiece.decode(v, cut) == text
    monkeypatch.setattr(sentencepiece, "SLICE", 1000)
    assert sentencepiece.encode(v, [text], key, 0.0)[0].tolist() == sentencepiece._spans(v, " " + text, key[0], 0.0).tolist()


def test_new_columns_do_not_replace_old_ones(spark):
    df = spark.createDataFrame([(1, "some words", "mine", 5)], "doc_id long, text string, pieces string, _key long")
    row = sentencepiece.encode_documents(df).first()
    assert row.pieces == "mine" and row["_key"] == 5 and len(row["_pieces"]) and row.lossless


# ------------------------------------------------------------------------- pii


def luhn(s):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


def test_pseudonyms_over_the_table(spark):
    """A scanner of its own over all texts: nothing it finds stays, all else does."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("text is not null")
    out = pii.pseudonymise(docs, "k")
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in (docs, out))
    assert {r.doc_id: r.text for r in pii.reveal(out, "k").collect()}.keys() == before.keys()
    address, octet = re.compile(r"(?<![\w.])[\w.+-]+@[\w-]+\.[a-z]{2,}"), re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])")
    found = 0
    for i, text in before.items():
        for m in address.findall(text):
            found += 1
            assert m not in after[i], (i, m)
        for m in octet.findall(text):
            if all(int(x) < 256 for x in m.split(".")):
                found += 1
                assert m not in after[i] or m in ("0.0.0.0", "127.0.0.1")
        for m in re.findall(r"(?<!\d)\d{16}(?!\d)", text):
            if luhn(m):
                found += 1
                assert m not in after[i]
        if not re.search(r"[@\d]", text):
            assert after[i] == text
    assert found > 0


# -------------------------------------------------------------------- pipeline


def test_pipeline_stages_against_plain_versions(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = {name: stage for name, stage in corpus_pipeline.STAGES}
    texts_of = lambda df: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
    before = texts_of(docs)

    # rules: base rules, and lines of 20 and more texts of a source
    ruled = at["quality rules"](spark, docs, SF).cache()
    source = {r.doc_id: r.source or "" for r in docs.select("doc_id", "source").collect()}
    normal = lambda line: re.sub(r"[\x20\x09-\x0D]+", " ", line).lower().strip(" ")
    holders = {}
    for i, t in before.items():
        for line in {normal(x) for x in (t or "").split("\n") if WORD.search(x)}:
            holders.setdefault((source[i], line), set()).add(t)
    frequent = {k for k, v in holders.items() if len(v) >= 20}
    want = {}
    for i, t in before.items():
        w = WORD.findall(t or "")
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        twice = {g for g in grams if grams.count(g) > 1} if len(set(grams)) < len(grams) else set()
        repeated = {k + j for k, g in enumerate(grams) if g in twice for j in range(3)}
        if len(w) < 50 or 100 * len(repeated) > 50 * len(w):
            continue
        lines = t.split("\n")
        lost = [x for x in lines if WORD.search(x) and (source[i], normal(x)) in frequent]
        if sum(len(WORD.findall(x)) for x in lost) <= 0.7 * len(w):
            want[i] = "\n".join(x for x in lines if not (WORD.search(x) and (source[i], normal(x)) in frequent))
    assert texts_of(ruled) == want

    # near duplicates: the smallest id of each class stays
    near = at["n-gram Jaccard join"](spark, ruled, SF).cache()
    classes = brute(sorted(want.items()), 5, 80, 100)
    assert texts_of(near) == {i: t for i, t in want.items() if not classes[i][0] or classes[i][1] == i}

    # secrets: what is left has none, all else stays
    clean = at["secret scans"](spark, near, SF).cache()
    kept, struck = texts_of(near), texts_of(clean)
    assert kept.keys() == struck.keys()
    access, hexa = re.compile(r"AKIA[A-Z0-9]{12,}"), re.compile(r"[0-9a-f]{32,}")
    for i, t in struck.items():
        assert not access.search(t) and not hexa.search(t)
        assert t == kept[i] or "[SECRET]" in t
        pieces = t.split("[SECRET]")
        assert re.fullmatch(".+?".join(map(re.escape, pieces)), kept[i], re.S)
    assert all(r.n_chars == len(r.text) for r in clean.where("instr(text, '[SECRET]') > 0").collect())

    # mixing: whole repetitions, and words near the targets
    mixed = at["mixing"](spark, clean, SF).cache()
    times = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert set(times) <= set(struck) and max(times.values()) <= 2
    total = sum(len(WORD.findall(t)) for t in struck.values())
    taken = sum(n * len(WORD.findall(struck[i])) for i, n in times.items())
    assert abs(taken - 1.5 * total) < 0.05 * total

    pieces = at["SentencePiece"](spark, mixed, SF).collect()
    assert len(pieces) == sum(times.values()) and all(r.lossless for r in pieces)
    v = sentencepiece.Vocabulary.load()
    assert all(sentencepiece.decode(v, np.array(r.pieces)) == struck[r.doc_id] for r in pieces[:50])
