"""Grids of cells to and from GeoTIFF, by the TIFF 6 layout: one strip per row, 32-bit
floats, a no-data text, the place of the upper left corner and the cell size."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from gridloom.sources.las import place

# TIFF tags.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, OFFSETS, SAMPLES, ROWS, COUNTS, FORMAT = 256, 257, 258, 259, 262, 273, 277, 278, 279, 339
PIXEL_SCALE, TIE_POINT, NODATA = 33550, 33922, 42113


def encode(array: np.ndarray, xmin: float, ymax: float, cell: float, nodata: float = -9999.0) -> bytes:
    """The file's bytes; unknown cells (NaN) are written as ``nodata``."""
    rows, cols = array.shape
    body = np.where(np.isfinite(array), array, nodata).astype("<f4").tobytes()
    text = f"{nodata:g}".encode() + b"\0"
    size = cols * 4
    entries = [
        (WIDTH, 4, [cols]), (HEIGHT, 4, [rows]), (BITS, 3, [32]), (COMPRESSION, 3, [1]), (PHOTOMETRIC, 3, [1]), (OFFSETS, 4, [8 + i * size for i in range(rows)]), (SAMPLES, 3, [1]), (ROWS, 4, [1]),
        (COUNTS, 4, [size] * rows), (FORMAT, 3, [3]), (PIXEL_SCALE, 12, [cell, cell, 0.0]), (TIE_POINT, 12, [0.0, 0.0, 0.0, xmin, ymax, 0.0]), (NODATA, 2, list(text)),
    ]
    form = {2: "B", 3: "H", 4: "I", 12: "d"}
    start = 8 + len(body)
    more_at = start + 2 + 12 * len(entries) + 4
    table, more = struct.pack("<H", len(entries)), b""
    for tag, kind, values in entries:
        raw = struct.pack(f"<{len(values)}{form[kind]}", *values)
        if len(raw) > 4:
            value = struct.pack("<I", more_at + len(more))
            more += raw + b"\0" * (len(raw) % 2)
        else:
            value = raw.ljust(4, b"\0")
        table += struct.pack("<HHI", tag, kind, len(values)) + value
    return struct.pack("<2sHI", b"II", 42, start) + body + table + struct.pack("<I", 0) + more


def decode(raw: bytes) -> tuple[np.ndarray, float, float, float]:
    """(array, xmin, ymax, cell) of a file as ``encode`` writes it."""
    if raw[:4] != b"II*\0":
        raise ValueError("no little-endian TIFF")
    (start,) = struct.unpack_from("<I", raw, 4)
    (n,) = struct.unpack_from("<H", raw, start)
    form = {2: ("B", 1), 3: ("H", 2), 4: ("I", 4), 12: ("d", 8)}
    tags = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from("<HHI", raw, start + 2 + 12 * i)
        code, size = form[kind]
        at = start + 10 + 12 * i
        if count * size > 4:
            (at,) = struct.unpack_from("<I", raw, at)
        tags[tag] = struct.unpack_from(f"<{count}{code}", raw, at)
    if tags[COMPRESSION] != (1,) or tags[BITS] != (32,) or tags[FORMAT] != (3,):
        raise ValueError("only uncompressed 32-bit floats")
    cols, rows = tags[WIDTH][0], tags[HEIGHT][0]
    out = np.frombuffer(b"".join(raw[o : o + c] for o, c in zip(tags[OFFSETS], tags[COUNTS])), "<f4").reshape(rows, cols).astype(float)
    out[out == float(bytes(tags[NODATA]).rstrip(b"\0"))] = np.nan
    return out, tags[TIE_POINT][3], tags[TIE_POINT][4], tags[PIXEL_SCALE][0]


def write_tiles(cells: DataFrame, folder: str, xmin: float, ymax: float, cell: float, block: int = 1024) -> DataFrame:
    """One GeoTIFF per block of cells (row, col, value), each written by its own task;
    gives (path, cells).  A file appears under its name only when it is whole."""
    from gridloom.operators.rasters import Window, with_halo

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        w = Window(pdf, ["value"])
        br, bc = int(pdf["br"].iloc[0]), int(pdf["bc"].iloc[0])
        fs, root = place(folder)
        fs.create_dir(root, recursive=True)
        path = f"{root}/r{br:04d}c{bc:04d}.tif"
        with fs.open_output_stream(path + ".partial") as f:
            f.write(encode(w["value"], xmin + w.c0 * cell, ymax - w.r0 * cell, cell))
        fs.move(path + ".partial", path)
        return pd.DataFrame({"path": [path], "cells": [len(pdf)]})

    return with_halo(cells.select("row", "col", "value"), block, 0).groupBy("br", "bc").applyInPandas(one, "path string, cells long")


def read_tiles(spark: SparkSession, folder: str, xmin: float, ymax: float) -> DataFrame:
    """Cells (row, col, value) of the GeoTIFF files below a folder, on one grid."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for raw in batch["content"]:
                a, x, y, cell = decode(bytes(raw))
                r, c = np.nonzero(np.isfinite(a))
                yield pd.DataFrame({"row": r + round((ymax - y) / cell), "col": c + round((x - xmin) / cell), "value": a[r, c]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").option("recursiveFileLookup", "true").load(folder)
    return files.select("content").mapInPandas(run, "row long, col long, value double")
