"""Names, routes, paths, dates and number texts as column expressions."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from gridloom.functions.rules import cases

# ---------------------------------------------------------------------- routes

#: Prefixes of route families, in sorting order.
FAMILIES = {"I": "I-", "US": "US ", "SR": "SR "}
#: Direction words that are no part of a street's name.
DIRECTIONS = ("NB", "SB", "EB", "WB")


def _words(text: Column) -> Column:
    """Words between runs of white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")


def _word(words: Column, i: int) -> Column:
    return F.coalesce(F.get(words, F.lit(i)), F.lit(""))


def _number(digits: Column) -> Column:
    """Digits without leading zeros, as text."""
    return digits.cast("decimal(38,0)").cast("string")


def alias_route(alias: Column, code: Column) -> Column:
    """A route from a road's alias, such as 'HWY 89' or 'I-15'; '' if it is none."""
    words = _words(F.upper(F.regexp_replace(F.coalesce(alias, F.lit("")), "-", " ")))
    head, number = _word(words, 0), _word(words, 1)
    prefix = cases(
        (head == "I", "I-"), (head == "US", "US "), (head.isin("SR", "UT"), "SR "), ((head == "HWY") & F.coalesce(code.isin("2", "3"), F.lit(False)), "US "), (head == "HWY", "SR ")
    )
    return F.coalesce(F.when(number.rlike(r"^[0-9]{1,38}$"), F.concat(prefix, _number(number))), F.lit(""))


def route_key(code: Column, highway: Column, route: Column, *aliases: Column) -> Column:
    """'I-15', 'US 89A', 'SR 152' or '': the highway's name, else the numbered
    route (four digits and P or N), else the first alias that is a route."""
    code = F.coalesce(code.cast("string"), F.lit(""))
    highway, route = (F.upper(F.trim(F.coalesce(c, F.lit("")))) for c in (highway, route))
    number = F.when(route.rlike("^[0-9]{4}[PN]$"), F.substring(route, 1, 4).cast("int"))
    numbered = F.when(number.between(1, 999), F.concat(cases((code == "1", "I-"), (code.isin("2", "3"), "US "), otherwise="SR "), number.cast("string")))
    named = [F.when(key != "", key) for key in (alias_route(a, code) for a in aliases)]
    return F.coalesce(F.when(highway != "", highway), numbered, *named, F.lit(""))


def route_family(route: Column) -> Column:
    return cases((route.startswith("I-"), "I"), otherwise=F.element_at(F.split(route, " "), 1))


def route_number(route: Column) -> Column:
    """What follows the family; null where nothing does."""
    return cases((route.startswith("I-"), F.substring(route, 3, 1_000)), (route.contains(" "), F.regexp_replace(route, "^[^ ]* ", "")))


def route_sort_key(route: Column) -> Column:
    """(rank, number, route), to sort routes by."""
    family, digits = route_family(route), F.regexp_replace(route, "[^0-9]", "")
    rank = cases(*[(family == name, i) for i, name in enumerate(FAMILIES)], otherwise=len(FAMILIES))
    return F.struct(rank.alias("rank"), F.when(digits != "", digits.cast("long")).otherwise(F.lit(0)).alias("number"), route.alias("route"))


def street_name(full: Column, title_case: bool = True) -> Column:
    """A street's name without directions; '' where a route shield says it all.
    Only a word's first letter is raised, so '8th' stays."""
    words = F.filter(_words(full), lambda w: ~F.upper(w).isin(*DIRECTIONS))
    first = F.upper(_word(words, 0))
    shield = first.startswith("I-") | ((F.size(words) == 2) & first.isin("HWY", "SR", "US", "I") & _word(words, 1).rlike("^[0-9]+$"))
    shown = F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 10_000)))) if title_case else words
    return cases((shield, ""), otherwise=F.array_join(shown, " "))


def name_expression(title_case: bool = True) -> str:
    """The same rule of street names as Spark SQL text over ``$1``, for map styles
    and views that take an expression."""
    words = "filter(split(coalesce($1, ''), '\\\\s+'), w -> w <> '' AND NOT upper(w) IN (" + ", ".join(f"'{d}'" for d in DIRECTIONS) + "))"
    shown = f"transform({words}, w -> concat(upper(substring(w, 1, 1)), lower(substring(w, 2, 10000))))" if title_case else words
    first = f"upper(coalesce(get({words}, 0), ''))"
    return (
        f"CASE WHEN {first} LIKE 'I-%' OR (size({words}) = 2 AND {first} IN ('HWY', 'SR', 'US', 'I') AND get({words}, 1) RLIKE '^[0-9]+$') "
        f"THEN '' ELSE array_join({shown}, ' ') END"
    )


def symbol_route(symbol: Column, groups: Sequence[tuple[int, Sequence[str]]]) -> Column:
    """The route of a numbered symbol; ``groups`` are (first number, routes)."""
    flat = [(first, F.array(*[F.lit(r) for r in routes]), len(routes)) for first, routes in groups]
    return cases(*[(symbol.between(first, first + n - 1), F.get(names, symbol - first)) for first, names, n in flat])


# ----------------------------------------------------------------------- paths


def public_path(path: Column) -> Column:
    """A path fit for a public record: a network path keeps its last part only."""
    parts = F.filter(F.split(path, r"[\\/]+"), lambda p: p != "")
    device = F.slice(parts, 1, 2)
    parts = F.when((device == F.array(F.lit("?"), F.lit("UNC"))) | (device == F.array(F.lit("."), F.lit("UNC"))), F.slice(parts, 3, 100_000)).otherwise(parts)
    hidden = F.when(F.size(parts) > 2, F.concat(F.element_at(parts, -1), F.lit(" (network path redacted)"))).otherwise(F.lit("(network path redacted)"))
    return F.when(path.rlike(r"^[\\/]{2}"), hidden).otherwise(path)


def rebased_path(path: Column, root: str | None, folder: str = "lidar") -> Column:
    """A path below any drive's ``folder``, below ``root`` instead; others stay."""
    if not root:
        return path
    prefix = rf"(?i)^[a-z]:[\\/]+{re.escape(folder)}(?=[\\/]|$)"
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(path, prefix, ""), r"\\", "/"), "^/+", "")
    return F.when(path.rlike(prefix), F.when(rest == "", F.lit(root)).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), rest))).otherwise(path)


# ----------------------------------------------------------------------- tiles


def tile_name(x: Column, y: Column, prefix: str = "12TVL", easting: int = 400_000, northing: int = 4_500_000, size: int = 1_000) -> Column:
    """Name of the tile a place lies in: two digits each way."""
    two = lambda v, zero: F.lpad(F.floor((v - zero) / size).cast("string"), 2, "0")
    return F.concat(F.lit(prefix), two(x, easting), two(y, northing))


def neighbour_tiles(tile: Column, prefix_length: int = 5) -> Column:
    """Names of the eight tiles around one, west to east, south to north."""
    head = F.substring(tile, 1, prefix_length)
    col, row = (F.substring(tile, prefix_length + 1 + 2 * i, 2).cast("int") for i in (0, 1))
    two = lambda v: F.lpad(v.cast("string"), 2, "0")
    return F.array(*[F.concat(head, two(col + dc), two(row + dr)) for dc in (-1, 0, 1) for dr in (-1, 0, 1) if dc or dr])


def creation_date(year: Column, day: Column) -> Column:
    """Year and day of the year as an ISO date; null unless it lies in the year."""
    found = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day - 1)
    return F.when((year > 0) & day.between(1, 366) & (F.year(found) == year), F.date_format(found, "yyyy-MM-dd"))


def flight_summary(dates: Column) -> Column:
    """(dates, first, last, swaths) of a list of date texts: distinct trimmed ones,
    sorted and joined; swaths counts them all."""
    kept = F.filter(F.transform(dates, lambda d: F.trim(d)), lambda d: d.isNotNull() & (d != ""))
    order = F.array_sort(F.array_distinct(kept))
    return F.struct(F.array_join(order, ";").alias("dates"), F.array_min(order).alias("first"), F.array_max(order).alias("last"), F.size(kept).alias("swaths"))


# ----------------------------------------------------------------------- texts


def percent(value: Column) -> Column:
    """Two decimals; a sliver is not rounded to 0.00%."""
    return cases(((value > 0) & (value < 0.005), "<0.01%"), otherwise=F.format_string("%.2f%%", value))


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def estimate_text(value: Column, low: Column, high: Column, status: Column, percentage: bool) -> Column:
    """'12.3% [10.0%, 15.0%]' or '1,234 [1,000, 1,500]'; says when there is no
    interval.  Ties round away from zero."""
    one = (lambda v: F.format_string("%.1f%%", v * 100)) if percentage else thousands
    bare = F.concat(one(value), F.when(status.isNotNull() & (status != ""), F.lit(" [interval unavailable]")).otherwise(F.lit("")))
    return cases((value.isNull(), "n/a"), (low.isNull(), bare), otherwise=F.concat(one(value), F.lit(" ["), one(low), F.lit(", "), one(high), F.lit("]")))


def text_or_dash(value: Column) -> Column:
    text = value.cast("string")
    return cases((text.isNull() | (F.trim(text) == "") | (F.lower(text) == "nan"), "—"), otherwise=text)


def hex_colour(value: Column) -> Column:
    """#abc as #aabbcc, lower case; null for none; null where it is no colour."""
    text = F.lower(F.trim(value))
    long = F.regexp_replace(text, "^#([0-9a-f])([0-9a-f])([0-9a-f])$", "#$1$1$2$2$3$3")
    return F.when(long.rlike("^#[0-9a-f]{6}$"), long)


def affine(transform: str | None) -> tuple[float, ...]:
    """A transform list (matrix, translate, scale) as (a, b, c, d, e, f)."""
    a, b, c, d, e, f = 1.0, 0.0, 0.0, 1.0, 0.0, 0.0
    for name, inner in re.findall(r"(\w+)\s*\(([^)]*)\)", transform or ""):
        v = [float(x) for x in re.findall(r"[-+.\deE]+", inner)]
        if name == "matrix":
            p, q, r, s, t, u = v
        elif name == "translate":
            p, q, r, s, t, u = 1.0, 0.0, 0.0, 1.0, v[0], v[1] if len(v) > 1 else 0.0
        elif name == "scale":
            p, q, r, s, t, u = v[0], 0.0, 0.0, v[1] if len(v) > 1 else v[0], 0.0, 0.0
        else:
            raise ValueError(f"transform {name} is not supported")
        a, b, c, d, e, f = a * p + c * q, b * p + d * q, a * r + c * s, b * r + d * s, a * t + c * u + e, b * t + d * u + f
    return a, b, c, d, e, f


def apply_affine(m: Sequence[float], x: Column, y: Column) -> Column:
    a, b, c, d, e, f = m
    return F.struct((x * a + y * c + e).alias("x"), (x * b + y * d + f).alias("y"))


def canonical_json(value: object) -> str:
    """JSON with sorted keys and no blanks; equal values give equal texts."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def struct_digest(*fields: Column) -> Column:
    """SHA-256 of the fields as JSON; a null field is written as null."""
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def unit_token(frame_digest: Column, *identity: Column) -> Column:
    """24 hex digits that name a unit within a frame."""
    return F.substring(struct_digest(frame_digest, *identity), 1, 24)


def ids_digest(ids: Column) -> Column:
    """SHA-256 of a list of ids, whatever their order."""
    return F.sha2(F.array_join(F.array_sort(F.transform(ids, lambda i: i.cast("string"))), "\n"), 256)


def markdown_table(rows: Sequence[Sequence[object]], header: Sequence[str]) -> str:
    """A small result as a markdown table."""
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|")
    lines = [header, ["---"] * len(header), *rows]
    return "\n".join("| " + " | ".join(cell(v) for v in line) + " |" for line in lines) + "\n"


def record_markdown(record: dict, title: str) -> str:
    """A nested record as a markdown page: scalars listed, lists of records as
    tables, records as sections."""
    out = [f"# {title}", ""]
    scalars = {k: v for k, v in record.items() if not isinstance(v, (dict, list))}
    out += [f"- {k.replace('_', ' ')}: {'—' if v is None else v}" for k, v in scalars.items()]
    for k, v in record.items():
        if isinstance(v, dict):
            out += ["", "#" + record_markdown(v, k.replace("_", " "))]
        elif isinstance(v, list) and v and all(isinstance(x, dict) for x in v):
            names = list(dict.fromkeys(n for x in v for n in x))
            out += ["", f"## {k.replace('_', ' ')}", "", markdown_table([[x.get(n) for n in names] for x in v], names)]
        elif isinstance(v, list):
            out += ["", f"## {k.replace('_', ' ')}", "", *[f"- {x}" for x in v]]
    return "\n".join(out) + "\n"
