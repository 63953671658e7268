"""Feeds of other services as tables: map JSON, capabilities, city models, feature layers.

Each reader takes a table of document texts, so any number of documents is read
by as many tasks; nothing here opens a connection.
"""

from __future__ import annotations

import gzip
import json
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.functions.rings import RINGS

Ring = list[tuple[float, float]]


def overpass_query(west: float, south: float, east: float, north: float, timeout: int = 180) -> str:
    """Query text for building ways and relations within a box."""
    box = f"{south},{west},{north},{east}"
    return f"[out:json][timeout:{timeout}];(way[building]({box});relation[building]({box}););out geom;"


def stitch(lines: Sequence[Ring]) -> tuple[list[Ring], int]:
    """Closed rings from open lines joined end to end, in either direction, and
    the number of lines left over."""
    open_, rings, left = [list(l) for l in lines if len(l) > 1], [], 0
    while open_:
        ring = open_.pop(0)
        while ring[0] != ring[-1]:
            for i, line in enumerate(open_):
                if line[0] == ring[-1] or line[-1] == ring[-1]:
                    line = open_.pop(i)
                    ring += (line if line[0] == ring[-1] else line[::-1])[1:]
                    break
            else:
                break
        if ring[0] == ring[-1] and len(ring) > 3:
            rings.append(ring)
        else:
            left += 1
    return rings, left


def _element(e: dict) -> tuple:
    line = lambda g: [(p["lon"], p["lat"]) for p in g or [] if p]
    key, tags = (e.get("type"), e.get("id")), {str(k): str(v) for k, v in (e.get("tags") or {}).items()}
    if key[0] == "way":
        ring = line(e.get("geometry"))
        if len(ring) > 3 and ring[0] == ring[-1]:
            return *key, tags, [ring], None
        return *key, tags, None, "open way"
    if key[0] == "relation" and tags.get("type") == "multipolygon":
        rings, left = stitch([line(m.get("geometry")) for m in e.get("members", []) if m.get("type") == "way" and m.get("role") in ("outer", "inner", "")])
        if rings and not left:
            return *key, tags, rings, None
        return *key, tags, rings or None, "open rings" if rings else "no ring"
    return *key, tags, None, "no polygon"


def map_polygons(documents: DataFrame, body: str = "body") -> DataFrame:
    """(type, id, tags, rings, skipped) of the elements of map JSON documents; an
    element that several documents hold comes once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_element(e) for text in batch[body] if text for e in json.loads(text).get("elements", [])]
            out = pd.DataFrame(rows, columns=["type", "id", "tags", "rings", "skipped"])
            out["rings"] = [r and [[{"x": x, "y": y} for x, y in ring] for ring in r] for r in out["rings"]]
            yield out

    found = documents.select(body).mapInPandas(run, f"type string, id long, tags map<string,string>, rings {RINGS}, skipped string")
    names = ["tags", "rings", "skipped"]
    first = found.groupBy("type", "id").agg(F.min_by(F.struct(*names), F.concat_ws("|", F.col("skipped").isNotNull().cast("string"), F.to_json("rings"))).alias("e"))
    return first.select("type", "id", "e.*")


def local_name(tag: str) -> str:
    """A tag without its name space."""
    return tag.rsplit("}", 1)[-1]


def child_text(node: ET.Element, name: str) -> str | None:
    return next(((c.text or "").strip() or None for c in node if local_name(c.tag) == name), None)


def capability_layers(documents: DataFrame, body: str = "body") -> DataFrame:
    """(name, title, date, systems, path) of the named layers of WMS capabilities;
    reference systems are inherited, the date is the first ISO date in name or title."""
    import re

    def walk(node: ET.Element, systems: list[str], path: list[str]) -> Iterator[tuple]:
        own = systems + [c.text.strip() for c in node if local_name(c.tag) in ("CRS", "SRS") and c.text]
        name, title = child_text(node, "Name"), child_text(node, "Title")
        if name:
            date = re.search(r"\d{4}-\d{2}-\d{2}", f"{name} {title or ''}")
            yield name, title, date.group() if date else None, list(dict.fromkeys(own)), "/".join(path)
        for child in node:
            if local_name(child.tag) == "Layer":
                yield from walk(child, own, [*path, title or name or ""])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch[body]:
                for cap in (c for c in ET.fromstring(text) if local_name(c.tag) == "Capability"):
                    for layer in (c for c in cap if local_name(c.tag) == "Layer"):
                        rows += walk(layer, [], [])
            yield pd.DataFrame(rows, columns=["name", "title", "date", "systems", "path"])

    return documents.select(body).mapInPandas(run, "name string, title string, date string, systems array<string>, path string")


def convex_hull(points: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Corners of the hull, counter-clockwise from the lowest left one."""
    every = sorted(set(points))
    if len(every) < 3:
        return every

    def half(seq: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
        out: list[tuple[float, float]] = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    return half(every) + half(every[::-1])


def rotated_box(hull: Sequence[tuple[float, float]]) -> tuple[float, float]:
    """(length, width) of the smallest rectangle, turned any way, around a hull."""
    import math

    if len(hull) < 3:
        return (math.dist(hull[0], hull[-1]) if hull else 0.0), 0.0
    best = None
    for (x0, y0), (x1, y1) in zip(hull, [*hull[1:], hull[0]]):
        n = math.hypot(x1 - x0, y1 - y0)
        ux, uy = (x1 - x0) / n, (y1 - y0) / n
        along, across = [x * ux + y * uy for x, y in hull], [y * ux - x * uy for x, y in hull]
        a, b = max(along) - min(along), max(across) - min(across)
        if best is None or a * b < best[0]:
            best = (a * b, max(a, b), min(a, b))
    return best[1], best[2]


def city_models(shards: DataFrame, body: str = "content") -> DataFrame:
    """(id, kind, vertices, hull, length, width) of the objects of CityJSON shards
    (binary, gzip or plain); vertices are scaled and moved back to places."""
    def corners(boundary: object) -> Iterator[int]:
        if isinstance(boundary, int):
            yield boundary
        else:
            for b in boundary:
                yield from corners(b)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for raw in batch[body]:
                raw = bytes(raw)
                city = json.loads(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw)
                move = city.get("transform", {"scale": [1, 1, 1], "translate": [0, 0, 0]})
                places = [tuple(v * s + t for v, s, t in zip(p, move["scale"], move["translate"])) for p in city["vertices"]]
                for key, obj in city.get("CityObjects", {}).items():
                    used = sorted({i for g in obj.get("geometry", []) for i in corners(g["boundaries"])})
                    hull = convex_hull([places[i][:2] for i in used])
                    rows.append((key, obj.get("type"), len(used), [{"x": x, "y": y} for x, y in hull], *rotated_box(hull)))
            yield pd.DataFrame(rows, columns=["id", "kind", "vertices", "hull", "length", "width"])

    return shards.select(body).mapInPandas(run, "id string, kind string, vertices int, hull array<struct<x: double, y: double>>, length double, width double")


#: Column types of a feature service's field types.
FIELD_TYPES = {
    "esriFieldTypeOID": "long", "esriFieldTypeInteger": "long", "esriFieldTypeSmallInteger": "int", "esriFieldTypeDouble": "double", "esriFieldTypeSingle": "double",
    "esriFieldTypeString": "string", "esriFieldTypeDate": "timestamp", "esriFieldTypeGUID": "string", "esriFieldTypeGlobalID": "string",
}
RESERVED = ("OBJECTID", "SHAPE", "SHAPE_LENGTH", "SHAPE_AREA")


def attributes(features: DataFrame, fields: Sequence[dict], body: str = "attributes") -> DataFrame:
    """Typed columns of features' attribute JSON; dates are epoch milliseconds in
    UTC, reserved names get _SRC behind, texts are cut to their field's length."""
    columns = []
    for f in fields:
        raw = F.get_json_object(body, f"$['{f['name']}']")
        kind = FIELD_TYPES.get(f["type"], "string")
        value = F.timestamp_millis(raw.cast("long")) if kind == "timestamp" else raw.cast(kind)
        if kind == "string" and f.get("length"):
            value = F.substring(value, 1, f["length"])
        columns.append(value.alias(f["name"] + "_SRC" if f["name"].upper() in RESERVED else f["name"]))
    return features.select(*columns)


def hosted_ids(envelopes: Sequence[Sequence[float]], ids: Callable[[Sequence[float]], Sequence[int]], count: Callable[[Sequence[float]], int]) -> list[int]:
    """Object ids of all envelopes, each once, in order; an envelope whose ids are
    fewer than the server counts is refused."""
    found: dict[int, None] = {}
    for e in envelopes:
        own = list(ids(e))
        if len(own) != count(e):
            raise ValueError(f"the server lists {len(own)} ids, but counts {count(e)}")
        found.update(dict.fromkeys(own))
    return sorted(found)


def fetch_features(spark: SparkSession, ids: Sequence[int], get: Callable[[Sequence[int]], Sequence[str]], batch: int = 500) -> DataFrame:
    """(attributes) of features by id, in requests of at most ``batch`` ids, which
    are spread over tasks; ``get`` gives one JSON text per feature."""
    groups = [(list(ids[i : i + batch]),) for i in range(0, len(ids), batch)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield pd.DataFrame({"attributes": [text for own in rows["ids"] for text in get([int(i) for i in own])]})

    return spark.createDataFrame(groups, "ids array<long>").repartition(max(1, len(groups))).mapInPandas(run, "attributes string")


def schema_conflicts(existing: Sequence[dict], wanted: Sequence[dict]) -> tuple[list[dict], list[str]]:
    """Fields to add, and what stands against the migration: a present field of
    another type, shorter than asked, or without some of the coded values."""
    have = {f["name"].upper(): f for f in existing}
    add, against = [], []
    for f in wanted:
        old = have.get(f["name"].upper())
        if old is None:
            add.append(f)
        elif old["type"] != f["type"]:
            against.append(f"{f['name']}: {old['type']} instead of {f['type']}")
        elif f.get("length") and (old.get("length") or 0) < f["length"]:
            against.append(f"{f['name']}: shorter than {f['length']}")
        elif missing := sorted(set(f.get("values", ())) - set(old.get("values", f.get("values", ())))):
            against.append(f"{f['name']}: without {', '.join(map(str, missing))}")
    return add, against


def to_template(rows: DataFrame, template: Sequence[dict], mapping: dict[str, str], constants: dict[str, object]) -> DataFrame:
    """Rows in a template's schema: mapped columns, constants, null for the rest;
    values of mapped columns must fit their coded values."""
    names = {f["name"] for f in template}
    unknown = (set(mapping) | set(constants)) - names
    if unknown:
        raise ValueError(f"not in the template: {', '.join(sorted(unknown))}")

    def column(f: dict) -> Column:
        kind = FIELD_TYPES.get(f["type"], f["type"])
        value = F.lit(constants[f["name"]]) if f["name"] in constants else F.col(mapping[f["name"]]) if f["name"] in mapping else F.lit(None)
        value = value.cast(kind)
        if f.get("values"):
            value = F.when(value.isNull() | value.isin(*f["values"]), value).otherwise(F.raise_error(F.lit(f"{f['name']}: value outside of its domain")).cast(kind))
        return value.alias(f["name"])

    return rows.select(*[column(f) for f in template])
