"""Pseudonyms for personal data (DataFrame functions only).

Numbers and dates that pass their validation (card numbers by Luhn, IBANs by
remainder, social security numbers and IPv4 addresses by range, dates by the
calendar, telephone numbers by shape) are permuted within their own format by a
keyed Feistel network.  The permutation is one to one and depends on the key
and the value alone, so equal values stay equal across documents, different
ones stay different, and whoever holds the key can go back (``reveal``).
Check digits are made anew, so a pseudonym passes the same validation.  E-mail
addresses, which are neither, get a keyed digest as their local part.

A text is cut once at all matches, every match is replaced by itself or its
pseudonym, and the parts are joined: linear in the text.

Edge cases: null stays null, texts without matches stay as they are, numbers
that fail validation are left alone, equal rows get equal results, other
columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8
#: Days from 1900-01-01 are permuted within spans of 2^16, which ends in 2079.
EPOCH = "1900-01-01"
SPAN = 65_536

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+"
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"
CARD = r"(?<![\w.+-])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w)"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?!\w)"
SSN = r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])"
DATE = r"(?<![\w/-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4})(?![\w/-])"
PHONE = (
    r"(?<![\w+])(?:\+\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}|\+\d{1,3}(?:[ .-]\d{2,4}){3,4}"
    r"|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?!\w)"
)
#: Kinds in the order in which a place is tried.
PATTERNS = {"email": EMAIL, "ip": IP, "iban": IBAN, "ssn": SSN, "date": DATE, "phone": PHONE, "card": CARD}
ANY = "|".join(PATTERNS.values())


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def feistel(value: Column, left: Column | int, right: Column | int, key: str, tweak: str, back: bool = False) -> Column:
    """Permutes 0 .. left * right - 1: the halves are added to, in turn and
    modulo their own range, by a keyed digest of the other half."""
    as_col = lambda c: (c if isinstance(c, Column) else F.lit(c)).cast("long")
    left, right = as_col(left), as_col(right)

    def digest(i: Column, x: Column) -> Column:
        return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), i, x), 256), 1, 15), 16, 10).cast("long")

    def step(acc: Column, i: Column) -> Column:
        sign = F.lit(-1 if back else 1).cast("long")
        a = F.when(i % 2 == 0, F.pmod(acc["a"] + sign * (digest(i, acc["b"]) % left), left)).otherwise(acc["a"])
        b = F.when(i % 2 == 1, F.pmod(acc["b"] + sign * (digest(i, acc["a"]) % right), right)).otherwise(acc["b"])
        return F.struct(a.alias("a"), b.alias("b"))

    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    start = F.struct(F.floor(value / right).cast("long").alias("a"), F.pmod(value, right).alias("b"))
    return F.aggregate(rounds, start, step, lambda acc: acc["a"] * right + acc["b"])


def permute_digits(digits: Column, key: str, tweak: str, back: bool = False) -> Column:
    """A digit string permuted among those of its length; the halves are kept
    apart, so up to 36 digits fit in 64-bit arithmetic."""

    def body(d: Column) -> Column:
        u = F.floor(F.length(d) / 2).cast("int")
        v = F.length(d) - u
        left, right = F.pow(F.lit(10.0), u).cast("long"), F.pow(F.lit(10.0), v).cast("long")

        def digest(i: Column, x: Column) -> Column:
            return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), F.length(d), i, x), 256), 1, 15), 16, 10).cast("long")

        def step(acc: Column, i: Column) -> Column:
            sign = F.lit(-1 if back else 1).cast("long")
            a = F.when(i % 2 == 0, F.pmod(acc["a"] + sign * (digest(i, acc["b"]) % left), left)).otherwise(acc["a"])
            b = F.when(i % 2 == 1, F.pmod(acc["b"] + sign * (digest(i, acc["a"]) % right), right)).otherwise(acc["b"])
            return F.struct(a.alias("a"), b.alias("b"))

        rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
        head = F.when(u == 0, F.lit("0")).otherwise(F.substring(d, F.lit(1), u)).cast("long")
        start = F.struct(F.coalesce(head, F.lit(0)).cast("long").alias("a"), F.substring(d, u + 1, v).cast("long").alias("b"))
        show = lambda acc: F.concat(
            F.when(u == 0, F.lit("")).otherwise(F.lpad(acc["a"].cast("string"), u, F.lit("0"))), F.lpad(acc["b"].cast("string"), v, F.lit("0"))
        )
        return F.aggregate(rounds, start, step, show)

    return _bind(digits, body)


def refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    step = lambda acc, c: F.when(
        c.rlike("[0-9]"), F.struct((acc["i"] + 1).alias("i"), F.concat(acc["out"], F.substring(digits, acc["i"], F.lit(1))).alias("out"))
    ).otherwise(F.struct(acc["i"].alias("i"), F.concat(acc["out"], c).alias("out")))
    return F.aggregate(F.split(shape, ""), F.struct(F.lit(1).alias("i"), F.lit("").alias("out")), step, lambda acc: acc["out"])


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum, the last digit counting once."""

    def add(acc: Column, c: Column) -> Column:
        x = c.cast("int") * F.when(acc["odd"], 1).otherwise(2)
        return F.struct((acc["s"] + F.when(x > 9, x - 9).otherwise(x)).alias("s"), (~acc["odd"]).alias("odd"))

    start = F.struct(F.lit(0).alias("s"), F.lit(True).alias("odd"))
    return F.aggregate(F.reverse(F.split(digits, "")), start, add, lambda acc: acc["s"])


def mod97(text: Column) -> Column:
    """The remainder by 97 of a string in which A stands for 10, B for 11, ..."""
    step = lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + c.cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _card(m: Column, key: str, back: bool) -> Column:
    def body(d: Column) -> Column:
        payload = permute_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card", back)
        full = _bind(payload, lambda p: F.concat(p, F.pmod(-luhn_sum(F.concat(p, F.lit("0"))), F.lit(10)).cast("string")))
        return F.when(luhn_sum(d) % 10 == 0, _bind(full, lambda f: refill(m, f))).otherwise(m)

    return _bind(_digits(m), body)


def _iban(m: Column, key: str, back: bool) -> Column:
    country, bban = F.substring(m, 1, 2), F.substring(m, 5, 30)
    moved = _bind(permute_digits(_digits(bban), key, "iban", back), lambda d: refill(bban, d))
    made = _bind(moved, lambda b: F.concat(country, F.lpad((98 - mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b))
    valid = mod97(F.concat(bban, F.substring(m, 1, 4))) == 1
    return F.when(valid & (F.length(_digits(bban)) > 1), made).otherwise(m)


def _ssn(m: Column, key: str, back: bool) -> Column:
    area = F.substring(m, 1, 3).cast("int")
    area = area - 1 - F.when(area > 666, 1).otherwise(0)
    value = ((area * 99 + F.substring(m, 5, 2).cast("int") - 1).cast("long")) * 9999 + F.substring(m, 8, 4).cast("int") - 1

    def show(x: Column) -> Column:
        a = F.floor(x / (99 * 9999)) + 1
        a = a + F.when(a >= 666, 1).otherwise(0)
        pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
        return F.concat_ws("-", pad(a, 3), pad(F.pmod(F.floor(x / 9999), F.lit(99)) + 1, 2), pad(F.pmod(x, F.lit(9999)) + 1, 4))

    return _bind(feistel(value, 898 * 99, 9999, key, "ssn", back), show)


def _ip(m: Column, key: str, back: bool) -> Column:
    value = F.aggregate(F.split(m, r"\."), F.lit(0).cast("long"), lambda acc, c: acc * 256 + c.cast("long"))
    show = lambda x: F.concat_ws(".", *[F.pmod(F.floor(x / 256**k), F.lit(256)).cast("string") for k in (3, 2, 1, 0)])
    return _bind(feistel(value, 65536, 65536, key, "ip", back), show)


def _date(m: Column, key: str, back: bool) -> Column:
    iso = m.contains("-")
    day = F.coalesce(F.try_to_timestamp(m, F.lit("yyyy-MM-dd")), F.try_to_timestamp(m, F.lit("dd/MM/yyyy"))).cast("date")

    def body(d: Column) -> Column:
        n = F.datediff(d, F.lit(EPOCH).cast("date")).cast("long")
        new = F.floor(n / SPAN) * SPAN + feistel(F.pmod(n, F.lit(SPAN)), 256, 256, key, "date", back)
        moved = F.date_add(F.lit(EPOCH).cast("date"), new.cast("int"))
        return F.when(d.isNull(), m).when(iso, F.date_format(moved, "yyyy-MM-dd")).otherwise(F.date_format(moved, "dd/MM/yyyy"))

    return _bind(day, body)


def _phone(m: Column, key: str, back: bool) -> Column:
    country = F.regexp_extract(m, r"^\+\d{1,3}", 0)  # stays, as part of the format
    rest = F.substring(m, F.length(country) + 1, F.length(m))
    return F.concat(country, _bind(permute_digits(_digits(rest), key, "phone", back), lambda d: refill(rest, d)))


def _email(m: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 16), F.lit("@mail.invalid"))


def kind_of(m: Column) -> Column:
    """The kind of a whole match."""
    out = F.when(m.contains("@"), "email")
    for kind, pattern in PATTERNS.items():
        out = out.when(m.rlike(f"^(?:{pattern})$"), kind) if kind != "email" else out
    return out


def pseudonym(m: Column, key: str, back: bool = False) -> Column:
    """A match's pseudonym, or itself where its validation fails."""
    makers = {"ip": _ip, "iban": _iban, "ssn": _ssn, "date": _date, "phone": _phone, "card": _card}

    def body(kind: Column) -> Column:
        out = F.when(kind == "email", m if back else _email(m, key))
        for name, make in makers.items():
            out = out.when(kind == name, make(m, key, back))
        return out.otherwise(m)

    return _bind(kind_of(m), body)


def _replace(t: Column, key: str, back: bool) -> tuple[Column, Column]:
    """The new text and the number of its matches that changed, as a struct."""
    gaps, hits = F.split(t, ANY, -1), F.regexp_extract_all(t, F.lit(ANY), F.lit(0))
    new = F.transform(hits, lambda m: pseudonym(m, key, back))
    parts = F.zip_with(gaps, F.concat(new, F.array(F.lit(""))), lambda g, h: F.concat(g, h))
    return F.array_join(parts, ""), hits


def pseudonymise(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; ``count``, if named,
    gets the number of matches looked at."""
    t = F.col(text)
    new, hits = _replace(t, key, False)
    found = t.rlike(ANY)
    cols = {text: F.when(found, new).otherwise(t)}
    if count:
        cols = {count: F.when(found, F.size(hits)).otherwise(F.lit(0)).cast("long"), **cols}
    return docs.withColumns(cols)


def reveal(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Numbers and dates as they were before ``pseudonymise``."""
    t = F.col(text)
    return docs.withColumn(text, F.when(t.rlike(ANY), _replace(t, key, True)[0]).otherwise(t))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs, "sample key", count="n_matches")
