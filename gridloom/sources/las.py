"""LAS 1.1 to 1.4 files as a Spark data source and sink.

``spark.read.format("las").load(folder)`` gives one row per point record;
``option("part", "headers")`` one row per file.  A file is cut into ranges of
records, each read by its own task at the file's own stride, so large tiles
spread over the cluster and no file is held in memory.  The driver lists files
and their sizes only; headers are read and checked where they are used.  Paths
are read through Arrow's file systems, so a folder in a shared store (hdfs, s3,
gs) works like a local one.

Filters on x, y, z and classification are applied while records are decoded,
and a file whose header places it outside of them is not read (with
``spark.sql.python.filterPushdown.enabled``).

``df.write.format("las").save(folder)`` writes LAS 1.4 files of point format 6,
one per task, under names that appear only once the job has succeeded;
``rewrite`` copies files with some fields changed and all other bytes kept.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import datasource as ds

POINTS = "file string, point_index long, x double, y double, z double, return_number int, return_count int, flags int, classification int"
HEADERS = (
    "path string, bytes long, mtime_ns long, version string, format int, points long, record_offset long, record_length int, "
    "xmin double, xmax double, ymin double, ymax double, zmin double, zmax double, year int, day int, wkt string"
)
#: Records that one task reads.
RANGE = 2_000_000
BLOCK = 200_000
#: Least header size by minor version, record length by format.
HEADER_SIZE = {1: 227, 2: 227, 3: 235, 4: 375}
RECORD_LENGTH = (20, 28, 26, 34, 57, 63, 30, 36, 38, 59, 67)


class BadFile(ValueError):
    """A file that is not a readable, uncompressed LAS file."""


def place(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path within it; plain paths are local."""
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def header(path: str) -> dict:
    """The public header and the projection text; refuses what the points could
    not be read from."""
    fs, inner = place(path)
    info = fs.get_file_info(inner)
    if info.type != pafs.FileType.File:
        raise BadFile(f"{path}: no file")
    with fs.open_input_file(inner) as f:
        head = f.read(375)
        if head[:4] != b"LASF" or len(head) < 227:
            raise BadFile(f"{path}: no LAS header")
        major, minor = head[24], head[25]
        day, year, head_size, at, n_vlr, kind, length, count = struct.unpack_from("<HHHIIBHI", head, 90)
        least = HEADER_SIZE.get(minor)
        if major != 1 or least is None:
            raise BadFile(f"{path}: version {major}.{minor}")
        if len(head) < least or head_size < least:
            raise BadFile(f"{path}: header cut short")
        if kind & 0x80:
            raise BadFile(f"{path}: compressed points")
        kind &= 0x3F
        if kind > 10 or kind >= 6 and minor < 4:
            raise BadFile(f"{path}: point format {kind} in version 1.{minor}")
        if minor == 4:
            count = struct.unpack_from("<Q", head, 247)[0] or count
        if length < RECORD_LENGTH[kind]:
            raise BadFile(f"{path}: records shorter than their format")
        if at < head_size or at + count * length > info.size:
            raise BadFile(f"{path}: points run past the end of the file")
        scale, offset = struct.unpack_from("<3d", head, 131), struct.unpack_from("<3d", head, 155)
        if not (np.isfinite(scale).all() and np.isfinite(offset).all()) or min(scale) <= 0:
            raise BadFile(f"{path}: scale {scale}, offset {offset}")
        xmax, xmin, ymax, ymin, zmax, zmin = struct.unpack_from("<6d", head, 179)
        wkt, here = None, head_size
        for _ in range(n_vlr):
            f.seek(here)
            vlr = f.read(54)
            if len(vlr) < 54 or here + 54 > at:
                raise BadFile(f"{path}: variable-length record cut short")
            record, size = struct.unpack_from("<HH", vlr, 18)
            here += 54 + size
            if here > at:
                raise BadFile(f"{path}: variable-length record runs into the points")
            if record == 2112:
                wkt = f.read(size).decode("utf-8", "replace").rstrip("\0")
    return {
        "path": path, "bytes": info.size, "mtime_ns": info.mtime_ns, "version": f"{major}.{minor}", "format": kind, "points": count, "record_offset": at, "record_length": length,
        "xmin": xmin, "xmax": xmax, "ymin": ymin, "ymax": ymax, "zmin": zmin, "zmax": zmax, "year": year, "day": day, "wkt": wkt, "scale": scale, "offset": offset,
    }


def decode(block: np.ndarray, head: dict) -> dict[str, np.ndarray]:
    """Columns of the records in ``block`` (a structured view)."""
    out = {c: block[c].astype(np.float64) * s + o for c, s, o in zip("xyz", head["scale"], head["offset"])}
    b, flags, code = (block[c].astype(np.int32) for c in ("returns", "flags", "cls"))
    if head["format"] >= 6:
        return out | {"return_number": b & 15, "return_count": b >> 4, "flags": flags & 15, "classification": code}
    return out | {"return_number": b & 7, "return_count": (b >> 3) & 7, "flags": code & 0xE0, "classification": code & 31}


def is_clean(flags, modern):
    """Not withheld, synthetic or overlap; columns or arrays.  Older formats have
    two flags in the upper bits of the class byte."""
    bits = 13 if modern else 160
    return (flags.bitwiseAND(bits) if hasattr(flags, "bitwiseAND") else flags & bits) == 0


def record_type(head: dict) -> np.dtype:
    return np.dtype({
        "names": ["x", "y", "z", "returns", "flags", "cls"], "formats": ["<i4", "<i4", "<i4", "u1", "u1", "u1"],
        "offsets": [0, 4, 8, 14, 15, 16 if head["format"] >= 6 else 15], "itemsize": head["record_length"],
    })


def blocks(path: str, head: dict, first: int, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first record, raw records) in blocks."""
    fs, inner = place(path)
    length = head["record_length"]
    with fs.open_input_file(inner) as f:
        for a in range(first, first + count, BLOCK):
            n = min(BLOCK, first + count - a)
            f.seek(head["record_offset"] + a * length)
            yield a, np.frombuffer(f.read(n * length), np.uint8).reshape(n, length)


# ----------------------------------------------------------------------- source


@dataclass
class Span(ds.InputPartition):
    path: str
    first: int
    count: int


_COMPARE = {ds.EqualTo: np.equal, ds.GreaterThan: np.greater, ds.GreaterThanOrEqual: np.greater_equal, ds.LessThan: np.less, ds.LessThanOrEqual: np.less_equal}
_FILTERED = ("x", "y", "z", "classification")


class LasReader(ds.DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.part, self.filters = options.get("path", ""), options.get("part", "points"), []

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            if self.part == "points" and type(f) in _COMPARE and len(f.attribute) == 1 and f.attribute[0] in _FILTERED:
                self.filters.append((f.attribute[0], _COMPARE[type(f)], f.value))
            else:
                yield f

    def partitions(self) -> list[ds.InputPartition]:
        fs, inner = place(self.path)
        info = fs.get_file_info(inner)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(inner, recursive=True))
        prefix = self.path.split("://")[0] + "://" if "://" in self.path and not isinstance(fs, pafs.LocalFileSystem) else ""
        files = sorted((f for f in found if f.type == pafs.FileType.File and f.path.lower().endswith(".las")), key=lambda f: f.path)
        if self.part == "headers":
            return [Span(prefix + f.path, 0, 0) for f in files]
        # by size alone: as many ranges as the shortest records would take
        return [Span(prefix + f.path, k * RANGE, RANGE) for f in files for k in range(-(-f.size // (RANGE * RECORD_LENGTH[0])) or 1)]

    def outside(self, head: dict) -> bool:
        """Whether the header's box shows that no record can pass."""
        for name, compare, value in self.filters:
            low, high = (head.get(f"{name}min"), head.get(f"{name}max")) if name in "xyz" else (None, None)
            if low is None:
                continue
            if compare in (np.greater, np.greater_equal, np.equal) and high < value or compare in (np.less, np.less_equal, np.equal) and low > value:
                return True
        return False

    def read(self, span: Span) -> Iterator:
        head = header(span.path)
        if self.part == "headers":
            yield tuple(v for k, v in head.items() if k not in ("scale", "offset"))
            return
        if self.outside(head):
            return
        kind = record_type(head)
        ints = ["return_number", "return_count", "flags", "classification"]
        for a, raw in blocks(span.path, head, span.first, max(0, min(span.count, head["points"] - span.first))):
            cols = decode(raw.reshape(-1).view(kind), head)
            keep = np.ones(len(raw), bool)
            for name, compare, value in self.filters:
                keep &= compare(cols[name], value)
            at = np.flatnonzero(keep)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([span.path] * len(at)), pa.array(a + at)] + [pa.array(cols[c][at]) for c in "xyz"] + [pa.array(cols[c][at].astype(np.int32)) for c in ints],
                    names=["file", "point_index", "x", "y", "z", *ints],
                )


# ------------------------------------------------------------------------- sink


@dataclass
class Written(ds.WriterCommitMessage):
    name: str | None
    points: int


def file_header(n: int, low: np.ndarray, high: np.ndarray, scale: float, offset: Sequence[float], extra: Sequence[str], by_return: np.ndarray, wkt: str | None) -> bytes:
    """A LAS 1.4 header of point format 6, with a descriptor per extra column."""
    vlrs = b""
    if wkt:
        text = wkt.encode() + b"\0"
        vlrs += struct.pack("<H16sHH32s", 0, b"LASF_Projection", 2112, len(text), b"") + text
    if extra:
        body = b"".join(struct.pack("<HBB32s4s24s24s24s24s24s32s", 0, 10, 0, name.encode()[:32], b"", b"", b"", b"", b"", b"", b"") for name in extra)
        vlrs += struct.pack("<H16sHH32s", 0, b"LASF_Spec", 4, len(body), b"") + body
    count = (wkt is not None and wkt != "") + bool(extra)
    head = bytearray(375)
    head[:4], head[24], head[25] = b"LASF", 1, 4
    struct.pack_into("<H", head, 6, 16)  # projection as text
    struct.pack_into("<HIIBH", head, 94, 375, 375 + len(vlrs), count, 6, 30 + 8 * len(extra))
    struct.pack_into("<3d3d", head, 131, scale, scale, scale, *offset)
    struct.pack_into("<6d", head, 179, high[0], low[0], high[1], low[1], high[2], low[2])
    struct.pack_into("<Q15Q", head, 247, n, *by_return)
    return bytes(head) + vlrs


class LasWriter(ds.DataSourceArrowWriter):
    """Options: ``path``, ``scale`` (0.001), ``offset`` ('x,y,z'), ``wkt``, and
    ``extra``: names of double columns kept as extra bytes."""

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.scale = float(options.get("scale", "0.001"))
        self.offset = [float(v) for v in options.get("offset", "0,0,0").split(",")]
        self.wkt = options.get("wkt")
        self.extra = [n for n in options.get("extra", "").split(",") if n]
        fs, inner = place(self.path)
        if not overwrite and fs.get_file_info(inner).type != pafs.FileType.NotFound:
            raise FileExistsError(f"{self.path} exists")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, inner = place(self.path)
        fs.create_dir(inner, recursive=True)
        name = f"{inner}/part-{task.partitionId():05d}.{task.taskAttemptId()}.partial"
        kind = np.dtype([("x", "<i4"), ("y", "<i4"), ("z", "<i4"), ("intensity", "<u2"), ("returns", "u1"), ("flags", "u1"), ("cls", "u1"), ("user", "u1"), ("angle", "<i2"), ("source", "<u2"), ("time", "<f8")] + [(f"extra_{e}", "<f8") for e in self.extra])
        low, high, n, by_return, parts = np.full(3, np.inf), np.full(3, -np.inf), 0, np.zeros(15, np.int64), []
        with fs.open_output_stream(name + ".points") as body:
            for batch in iterator:
                col = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
                rows = np.zeros(batch.num_rows, kind)
                for i, c in enumerate("xyz"):
                    v = col(c).astype(float)
                    whole = np.round((v - self.offset[i]) / self.scale)
                    if len(whole) and not (np.abs(whole) < 2**31).all():
                        raise ValueError(f"{c} does not fit the scale and offset")
                    rows[c] = whole
                    if len(v):
                        real = rows[c] * self.scale + self.offset[i]
                        low[i], high[i] = min(low[i], real.min()), max(high[i], real.max())
                rows["returns"] = col("return_number").astype(np.uint8) | col("return_count").astype(np.uint8) << 4
                rows["flags"], rows["cls"] = col("flags"), col("classification")
                for e in self.extra:
                    rows[f"extra_{e}"] = col(e)
                by_return += np.bincount(col("return_number"), minlength=16)[1:16]
                n += len(rows)
                body.write(rows.tobytes())
        if not n:
            fs.delete_file(name + ".points")
            return Written(None, 0)
        with fs.open_output_stream(name) as out, fs.open_input_stream(name + ".points") as body:
            out.write(file_header(n, low, high, self.scale, self.offset, self.extra, by_return, self.wkt))
            while part := body.read(8 << 20):
                out.write(part)
        fs.delete_file(name + ".points")
        return Written(name, n)

    def commit(self, messages: list) -> None:
        fs, _ = place(self.path)
        for m in messages:
            if m is not None and m.name:
                fs.move(m.name, m.name.split(".")[0] + ".las")

    def abort(self, messages: list) -> None:
        fs, _ = place(self.path)
        for m in messages:
            if m is not None and m.name:
                fs.delete_file(m.name)


class LasSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "las"

    def schema(self) -> str:
        return HEADERS if self.options.get("part") == "headers" else POINTS

    def reader(self, schema) -> ds.DataSourceReader:
        return LasReader(self.options)

    def writer(self, schema, overwrite: bool) -> ds.DataSourceWriter:
        return LasWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LasSource)


# --------------------------------------------------------------- copies, checks


def rewrite(files: DataFrame, changes: DataFrame, target: str, fields: Sequence[str]) -> DataFrame:
    """Copies of ``files`` (file) under ``target`` with ``fields`` (z, classification)
    of ``changes`` (file, point_index, fields) put in; all other bytes stay, the
    older formats' flag bits in the class byte too, and z limits in the header are
    made true.  Gives an audit: (file, target, points, changed).

    A file and its changes are one task's; an existing target is refused, and a
    copy appears under its name only when it is whole."""
    fields = list(fields)
    out = target.rstrip("/")

    def run(own: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            raise BadFile(f"changes of a file that is not copied: {new['file'].iloc[0]}")
        path = own["file"].iloc[0]
        head = header(path)
        kind, modern = record_type(head), head["format"] >= 6
        new = new.sort_values("point_index")
        at = new["point_index"].to_numpy(np.int64)
        if len(at) and (at[0] < 0 or at[-1] >= head["points"] or (np.diff(at) == 0).any()):
            raise ValueError(f"{path}: places that are not there, or twice")
        fs, inner = place(path)
        ofs, oroot = place(out)
        ofs.create_dir(oroot, recursive=True)
        final = f"{oroot}/{inner.rsplit('/', 1)[-1]}"
        if ofs.get_file_info(final).type != pafs.FileType.NotFound:
            raise FileExistsError(final)
        changed, zmin, zmax = 0, np.inf, -np.inf
        with fs.open_input_file(inner) as src, ofs.open_output_stream(final + ".partial") as dst:
            dst.write(src.read(head["record_offset"]))
            for a, raw in blocks(path, head, 0, head["points"]):
                rows = raw.copy()
                view = rows.reshape(-1).view(kind)
                i, j = np.searchsorted(at, [a, a + len(rows)])
                here = at[i:j] - a
                if "z" in fields:
                    view["z"][here] = np.round((new["z"].to_numpy(float)[i:j] - head["offset"][2]) / head["scale"][2])
                if "classification" in fields:
                    code = new["classification"].to_numpy(np.uint8)[i:j]
                    view["cls"][here] = code if modern else (view["cls"][here] & 0xE0) | (code & 31)
                changed += int((rows != raw).any(axis=1).sum())
                z = view["z"] * head["scale"][2] + head["offset"][2]
                zmin, zmax = min(zmin, z.min()), max(zmax, z.max())
                dst.write(rows.tobytes())
            src.seek(head["record_offset"] + head["points"] * head["record_length"])
            while part := src.read(8 << 20):
                dst.write(part)
        if "z" in fields and head["points"]:
            with ofs.open_input_file(final + ".partial") as f:
                whole = bytearray(f.read(head["record_offset"]))
            struct.pack_into("<2d", whole, 211, zmax, zmin)
            with ofs.open_input_file(final + ".partial") as f, ofs.open_output_stream(final + ".whole") as dst:
                f.seek(len(whole))
                dst.write(bytes(whole))
                while part := f.read(8 << 20):
                    dst.write(part)
            ofs.delete_file(final + ".partial")
            ofs.move(final + ".whole", final)
        else:
            ofs.move(final + ".partial", final)
        return pd.DataFrame({"file": [path], "target": [final], "points": [head["points"]], "changed": [changed]})

    keep = changes.select("file", "point_index", *fields)
    return files.select("file").distinct().groupBy("file").cogroup(keep.groupBy("file")).applyInPandas(run, "file string, target string, points long, changed long")


def compare_copies(pairs: DataFrame, allowed: Sequence[str] = ("classification",)) -> DataFrame:
    """(original, copy, same_layout, other_bytes, changed, noise_changed): byte by
    byte, what differs outside of the ``allowed`` fields, and noise points (classes
    7 and 18) whose class changed."""
    allowed = set(allowed)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for a, b in zip(batch["original"], batch["copy"]):
                ha, hb = header(a), header(b)
                same = all(ha[k] == hb[k] for k in ("points", "format", "record_length", "record_offset", "bytes"))
                other = changed = noise = 0
                if same:
                    kind = record_type(ha)
                    modern = ha["format"] >= 6
                    for (_, x), (_, y) in zip(blocks(a, ha, 0, ha["points"]), blocks(b, hb, 0, hb["points"])):
                        differ = x != y
                        changed += int(differ.any(axis=1).sum())
                        cls = x.reshape(-1).view(kind)["cls"] & (255 if modern else 31)
                        at = 16 if modern else 15
                        noise += int((np.isin(cls, (7, 18)) & differ[:, at]).sum())
                        if "z" in allowed:
                            differ[:, 8:12] = False
                        if "classification" in allowed:
                            differ[:, at] &= not modern and ((x[:, at] ^ y[:, at]) & 0xE0) != 0
                        other += int(differ.sum())
                rows.append((a, b, same, other, changed, noise))
            yield pd.DataFrame(rows, columns=["original", "copy", "same_layout", "other_bytes", "changed", "noise_changed"])

    return pairs.select("original", "copy").mapInPandas(run, "original string, copy string, same_layout boolean, other_bytes long, changed long, noise_changed long")


def protected_hashes(files: DataFrame) -> DataFrame:
    """(file, sha256): digest of each LAS file with its class bytes set to zero."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path in batch["file"]:
                head, digest = header(path), hashlib.sha256()
                fs, inner = place(path)
                at = 16 if head["format"] >= 6 else 15
                with fs.open_input_file(inner) as f:
                    digest.update(f.read(head["record_offset"]))
                    for _, raw in blocks(path, head, 0, head["points"]):
                        rows = raw.copy()
                        rows[:, at] &= 0 if head["format"] >= 6 else 0xE0
                        digest.update(rows.tobytes())
                    f.seek(head["record_offset"] + head["points"] * head["record_length"])
                    while part := f.read(8 << 20):
                        digest.update(part)
                out.append(digest.hexdigest())
            yield pd.DataFrame({"file": batch["file"], "sha256": out})

    return files.select("file").mapInPandas(run, "file string, sha256 string")


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file: its header, counts by class, and which kinds it holds."""
    head = spark.read.format("las").option("part", "headers").load(folder)
    per_class = spark.read.format("las").load(folder).groupBy("file", "classification").agg(F.count("*").alias("n"))
    per_file = per_class.groupBy("file").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("classification", "n")))).alias("classes"))
    has = lambda *codes: F.exists(F.map_keys("classes"), lambda k: k.isin(*codes))
    joined = head.join(per_file.withColumnRenamed("file", "path"), "path", "left")
    return joined.withColumns({"has_ground": has(2), "has_vegetation": has(3, 4, 5), "has_building": has(6), "has_noise": has(7, 18)})
