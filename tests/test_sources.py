"""The LAS source on files written here, and the scalar functions."""

import hashlib
import struct
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import scalars
from gridloom.sources import las


def write_las(path, xyz, cls, fmt=0, minor=2, scale=0.01, cut=0):
    modern, length = fmt >= 6, 30 if fmt >= 6 else 20
    size = 375 if minor == 4 else 227
    head = bytearray(size)
    head[:4], head[24], head[25] = b"LASF", 1, minor
    struct.pack_into("<HHHIIBHI", head, 90, 12, 2024, size, size, 0, fmt, length, 0 if minor == 4 else len(xyz))
    struct.pack_into("<3d", head, 131, scale, scale, scale)
    struct.pack_into("<6d", head, 179, *[v for c in range(3) for v in (xyz[:, c].max(), xyz[:, c].min())])
    if minor == 4:
        struct.pack_into("<Q", head, 247, len(xyz))
    body = bytearray()
    for p, c in zip(xyz, cls):
        r = bytearray(length)
        struct.pack_into("<3i", r, 0, *[round(v / 0.01) for v in p])
        r[14] = 0x21 if modern else 0x11
        r[16 if modern else 15] = c
        body += r
    path.write_bytes(bytes(head) + bytes(body)[: len(body) - cut])


@pytest.fixture()
def folder(tmp_path):
    rng = np.random.default_rng(4)
    xyz = np.round(rng.random((50, 3)) * 100, 2)
    write_las(tmp_path / "a.las", xyz, [2, 5] * 25)
    write_las(tmp_path / "b.las", xyz + 1, [6] * 50, fmt=6, minor=4)
    return tmp_path, xyz


def test_points_and_headers(spark, folder):
    path, xyz = folder
    las.register(spark)
    points = spark.read.format("las").load(str(path))
    rows = points.orderBy("file", "point_index").collect()
    assert len(rows) == 100
    assert np.allclose([[r.x, r.y, r.z] for r in rows[:50]], xyz, atol=0.006)
    assert {(r.return_number, r.return_count) for r in rows[:50]} == {(1, 2)} == {(r.return_number, r.return_count) for r in rows[50:]}
    assert {r.classification for r in rows[:50]} == {2, 5} and {r.classification for r in rows[50:]} == {6}
    heads = spark.read.format("las").option("part", "headers").load(str(path)).orderBy("path").collect()
    assert [(h.version, h.format, h.points) for h in heads] == [("1.2", 0, 50), ("1.4", 6, 50)]


def test_bad_files_are_refused(folder):
    path, xyz = folder
    (path / "c.las").write_bytes(b"LASF")
    write_las(path / "d.las", xyz, [2] * 50, cut=5)
    write_las(path / "e.las", xyz, [2] * 50, scale=0.0)
    for name in ("c", "d", "e"):
        with pytest.raises(las.BadFile):
            las.header(str(path / f"{name}.las"))


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.tree_id(F.lit("src"), 26912, F.lit(1.5), F.lit(2.25)).alias("u"), scalars.seed_for(F.lit("7"), F.lit("a")).alias("s"),
        scalars.lab_to_hex(F.lit(100.0), F.lit(0.0), F.lit(0.0)).alias("w"), scalars.lab_to_hex(F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("k"),
        scalars.wilson(F.lit(8.0), F.lit(10.0)).alias("i"),
    ).first()
    assert row.u == str(uuid.uuid5(uuid.NAMESPACE_URL, "src|26912|1.500000|2.250000"))
    assert row.s == int.from_bytes(hashlib.sha256(b"7|a").digest()[:8], "little") >> 1
    assert row.k == "#000000" and row.w in ("#ffffff", "#fffffe", "#feffff")
    assert abs(row.i.low - 0.4901625) < 1e-6 and abs(row.i.high - 0.9433178) < 1e-6
