"""Secret scans (DataFrame functions only).

Three base rules find assignments, access keys and long hexadecimal runs.  Two
character Markov models, one of random strings and one of ordinary identifiers,
then judge every other long run of key characters: its log-likelihood ratio
must exceed a margin.  Both models are first-order chains with add-one
smoothing, fitted by counting character pairs of labelled samples; what leaves
the executors is the table of pair ratios, whose size is the alphabet's square.

Places are code points, end exclusive.  They come from the lengths of the text
between matches, so a text is scanned by a rule only if the rule occurs in it.

Edge cases: a null text is empty; empty texts have no spans; tokens of any
length are scored in linear time; repeated rows get equal results; other
columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.llm.text import fresh

def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


ASSIGN = "(" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A maximal run that is too short fails as a whole, so the least length can
#: stand in these two patterns.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: What the Markov models judge: runs of 16 and more key characters with a digit and a letter.
TOKEN = r"[A-Za-z0-9_+/=-]{16,}"

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_+/=-"
KINDS = ("assign", "access", "hex", "random")
#: A token counts as random above this log-likelihood ratio, in nats.
MARGIN = 8.0
#: Parts from which samples of ordinary identifiers are made.
PARTS = (
    "user name value index count total order price date time file path list item node tree point cell grid zone area "
    "line text word page title level state event input output buffer stream table column record field group member "
    "account address number version config option default current previous first last start end update delete create "
    "select insert filter merge split join sort search match result error message request response client server "
    "handler manager service factory builder parser writer reader loader model view controller session context cache"
).split()


def default_samples(spark: SparkSession, count: int = 3000) -> DataFrame:
    """Labelled samples (text, random): ``count`` of either label, by rule.

    Random strings are digests in base 64, hexadecimal and mixed alphabets;
    identifiers join three to five common parts in the usual styles."""
    parts = F.array(*[F.lit(p) for p in PARTS])
    pick = lambda i: F.element_at(parts, (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(len(PARTS))) + 1).cast("int"))
    ids = spark.range(count)
    style = F.col("id") % 4
    digest = F.unhex(F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256))
    b64 = F.regexp_replace(F.base64(digest), r"\s", "")
    random = F.when(style == 0, b64).when(style == 1, F.regexp_replace(b64, "[+/=]", "")).when(style == 2, F.hex(digest)).otherwise(F.lower(F.hex(digest)))
    camel = F.concat(pick(1), F.initcap(pick(2)), F.initcap(pick(3)), F.initcap(pick(4)))
    snake = F.concat_ws("_", pick(1), pick(2), pick(3), pick(4))
    upper = F.upper(F.concat_ws("_", pick(1), pick(2), pick(3), (F.col("id") % 100).cast("string")))
    kebab = F.concat(F.concat_ws("-", pick(1), pick(2), pick(3)), F.lit("/"), pick(4), F.lit("-"), (2000 + F.col("id") % 30).cast("string"))
    plain = F.when(style == 0, camel).when(style == 1, snake).when(style == 2, upper).otherwise(kebab)
    return ids.select(random.alias("text"), F.lit(True).alias("random")).unionByName(ids.select(plain.alias("text"), F.lit(False).alias("random")))


def fit(samples: DataFrame) -> list[int]:
    """Log-likelihood ratios of character pairs, in thousandths of a nat, at
    place ``len(ALPHABET) * first + second``.  Other characters are skipped."""
    chars = F.filter(F.split(F.col("text"), ""), lambda c: F.instr(F.lit(ALPHABET), c) > 0)
    pairs = samples.select("random", chars.alias("c")).select(
        "random", F.explode(F.zip_with(F.slice("c", 1, F.greatest(F.size("c") - 1, F.lit(0))), F.slice("c", 2, F.greatest(F.size("c") - 1, F.lit(0))), lambda a, b: F.concat(a, b))).alias("pair")
    )
    k = len(ALPHABET)
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}  # at most 2 k^2 rows
    table = []
    for a in ALPHABET:
        rows = {label: [counts.get((label, a + b), 0) + 1 for b in ALPHABET] for label in (True, False)}
        sums = {label: sum(v) for label, v in rows.items()}
        table += [round(1000 * (math.log(r / sums[True]) - math.log(o / sums[False]))) for r, o in zip(rows[True], rows[False])]
    assert len(table) == k * k
    return table


def likelihood_ratio(token: Column, model: list[int]) -> Column:
    """Log-likelihood ratio of a token in thousandths of a nat."""
    k = len(ALPHABET)
    table = F.expr("from_json('" + str(model).replace(" ", "") + "', 'array<int>')")
    code = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

    def total(x: Column) -> Column:
        n = F.size(x) - 1
        steps = F.zip_with(F.slice(x, 1, n), F.slice(x, 2, n), lambda a, b: F.element_at(table, a * k + b + 1))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, v: acc + v)

    return F.element_at(F.transform(F.array(code), total), 1)


def spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Spans (start, kind, end) of the matches for which ``keep`` holds."""
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        ok = F.lit(True) if keep is None else keep(x["hit"])
        new = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(ok, F.concat(acc["got"], F.array(new))).otherwise(acc["got"]).alias("got"))

    pairs = F.zip_with(F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))), found, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    start = F.struct(F.lit(0).alias("at"), empty.alias("got"))
    return F.when(text.rlike(pattern), F.aggregate(pairs, start, step, lambda acc: acc["got"])).otherwise(empty)


def scan(docs: DataFrame, model: list[int] | None = None, text: str = "text", margin: float = MARGIN, into: str = "found") -> DataFrame:
    """Adds one column to ``docs``, the last: the spans by kind (assign, access,
    hex, random).  It is called ``into``, with underscores in front while ``docs``
    has a column of that name."""
    model = model or fit(default_samples(docs.sparkSession))
    name, a, x, h, r = fresh(docs, into, "_assign", "_access", "_hex", "_random")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = docs.withColumns({
        a: spans(t, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8),
        x: spans(t, ACCESS, 1),
        h: spans(t, HEX, 2),
        r: spans(t, TOKEN, 3, lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]") & (likelihood_ratio(m, model) > int(1000 * margin))),
    })
    known = F.concat(a, x, h)
    clear = lambda s: ~F.exists(known, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    random = F.when(F.size(r) > 0, F.filter(r, clear)).otherwise(F.col(r))
    return base.withColumn(name, F.struct(F.col(a).alias("assign"), F.col(x).alias("access"), F.col(h).alias("hex"), random.alias("random"))).drop(a, x, h, r)


def listed(found: Column) -> Column:
    """kind:start:end of spans by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    show = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(F.array_sort(found), show), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; ``n_chars``, if there, is
    made true again.  Texts without spans stay as they are."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    found = scan(docs.select(row, F.col(f"`{text}`").alias("text")), **options)
    at = found.columns[-1]
    every = F.array_sort(F.concat(*[F.col(f"{at}.{k}") for k in KINDS]))
    t = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        inside = s["start"] < acc["at"]  # overlaps what is already struck out
        part = F.when(inside, F.lit("")).otherwise(F.concat(F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], part).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(every, start, step, lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))))
    hit = F.size(every) > 0
    out = found.select("_row", F.when(hit, done).otherwise(t).alias("_new"), hit.alias("_hit"))
    new = {text.lower(): F.col("_new")}
    for c in docs.columns:
        if c.lower() == "n_chars":
            new["n_chars"] = F.when(F.col("_hit"), F.length("_new").cast(docs.schema[c].dataType)).otherwise(F.col(f"_row.`{c}`"))
    return out.select(*[new.get(c.lower(), F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs)
    n = lambda kind: F.size(f"found.{kind}").cast("long").alias(f"n_{kind}")
    base = F.concat("found.assign", "found.access", "found.hex")
    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.concat(base, "found.random")).alias("spans")
    )
