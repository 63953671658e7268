"""Files beside the tables: refusing, atomic and verified sinks, fingerprints,
manifests and resumable runs.  Paths are those of Arrow's file systems."""

from __future__ import annotations

import concurrent.futures
import hashlib
import json
import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.functions.names import canonical_json
from gridloom.sources.las import place


def exists(path: str) -> bool:
    fs, inner = place(path)
    return fs.get_file_info(inner).type != pafs.FileType.NotFound


def new_output(path: str) -> str:
    """The path, if nothing is there."""
    if exists(path):
        raise FileExistsError(f"{path} exists; choose a new output")
    return path


def write_json(path: str, value: object, refuse: bool = False) -> None:
    """Writes beside the name and renames, so readers see the old or the new whole."""
    if refuse:
        new_output(path)
    fs, inner = place(path)
    with fs.open_output_stream(inner + ".pending") as f:
        f.write((json.dumps(value, indent=1, ensure_ascii=False, allow_nan=False) + "\n").encode())
    fs.move(inner + ".pending", inner)


def read_json(path: str) -> object:
    fs, inner = place(path)
    with fs.open_input_stream(inner) as f:
        return json.loads(f.read().decode())


def append_line(path: str, row: Mapping) -> None:
    """One JSON line at the end of a log on a local or appending file system."""
    fs, inner = place(path)
    with fs.open_append_stream(inner) as f:
        f.write((canonical_json(row) + "\n").encode())


def csv_text(rows: Iterable[Mapping], columns: Sequence[str]) -> str:
    """The same text for the same rows: line feeds, blanks for null, quotes only
    where they are needed."""
    def cell(v: object) -> str:
        s = "" if v is None or isinstance(v, float) and math.isnan(v) else str(v)
        return '"' + s.replace('"', '""') + '"' if any(c in s for c in ',"\n\r') else s

    return "".join(",".join(map(cell, line)) + "\n" for line in [list(columns), *[[r.get(c) for c in columns] for r in rows]])


# ------------------------------------------------------------------ fingerprints


def fingerprint(path: str) -> dict:
    """Path, size and SHA-256 of a file, read in parts."""
    fs, inner = place(path)
    digest, size = hashlib.sha256(), 0
    with fs.open_input_stream(inner) as f:
        while part := f.read(8 << 20):
            digest.update(part)
            size += len(part)
    return {"path": path, "bytes": size, "sha256": digest.hexdigest()}


def verify_fingerprint(record: Mapping, path: str) -> None:
    found = fingerprint(path)
    if record.get("path") not in (None, found["path"]) or any(record.get(k) != found[k] for k in ("bytes", "sha256")):
        raise ValueError(f"{path} is not the recorded file")


def fingerprints(files: DataFrame) -> DataFrame:
    """(file, bytes, sha256) of many files, spread over tasks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [fingerprint(p) for p in batch["file"]]
            yield pd.DataFrame({"file": batch["file"], "bytes": [f["bytes"] for f in found], "sha256": [f["sha256"] for f in found]})

    return files.select("file").mapInPandas(run, "file string, bytes long, sha256 string")


def frame_digest(frame: Mapping) -> str:
    return hashlib.sha256(canonical_json({k: v for k, v in frame.items() if k != "digest"}).encode()).hexdigest()


def check_frame(frame: Mapping) -> Mapping:
    """The frame, if it is as it was when its digest was taken."""
    if frame.get("digest") != frame_digest(frame):
        raise ValueError("the stored frame was altered")
    return frame


# ----------------------------------------------------------------------- gates


def valid_extent(extent: Sequence[float] | None) -> list[float] | None:
    if extent is None:
        return None
    if len(extent) != 4 or not all(math.isfinite(float(v)) for v in extent):
        raise ValueError("an extent is four finite numbers")
    x0, y0, x1, y1 = map(float, extent)
    if x0 >= x1 or y0 >= y1:
        raise ValueError("an extent's lower corner comes first")
    return [x0, y0, x1, y1]


#: What a usable manifest of an inference run says, by its job.
TARGET_CLASS = {"building": 6, "tree": 5}


def inference_extent(manifest: Mapping, job: str, original: str, prediction: str, requested: Sequence[float] | None = None) -> list[float] | None:
    """The extent in which a prediction may be used; refuses runs that did not end
    well, had another job, or whose files are not the recorded ones."""
    wanted = {"schema_version": 1, "status": "complete", "job": job, "output_classes": [0, TARGET_CLASS.get(job)], "class_mode": "EDIT_ALL", "excluded_class_codes": [7, 18]}
    wrong = [k for k, v in wanted.items() if manifest.get(k) != v]
    if wrong or job not in TARGET_CLASS:
        raise ValueError(f"the manifest does not allow use: {', '.join(wrong) or job}")
    for key, path in (("source", original), ("output", prediction), ("model", manifest.get("model", {}).get("path", ""))):
        verify_fingerprint(manifest.get(key, {}), path)
    if any(manifest["source"].get(k) != manifest.get("input", {}).get(k) for k in ("bytes", "sha256")):
        raise ValueError("the run did not start from the source")
    have, asked = valid_extent(manifest.get("boundary")), valid_extent(requested)
    if have and asked and (asked[0] < have[0] or asked[1] < have[1] or asked[2] > have[2] or asked[3] > have[3]):
        raise ValueError("the requested extent reaches beyond the processed one")
    return asked or have


def completed(folder: str, manifest: str = "preparation.json") -> bool:
    """Whether a folder holds a finished preparation: False if there is none; one
    that is not whole is refused, not resumed."""
    if not exists(folder):
        return False
    path = f"{folder.rstrip('/')}/{manifest}"
    if not exists(path):
        raise ValueError(f"{folder} has no manifest; choose a new folder")
    state = read_json(path)
    missing = [f for f in state.get("files", []) if not exists(f"{folder.rstrip('/')}/{f}")]
    if state.get("status") != "complete" or not state.get("files") or missing:
        raise ValueError(f"{folder} is not complete; choose a new folder")
    return True


def run_tiles(folder: str, tiles: Sequence[str], signature: Mapping, work: Callable[[str], Mapping]) -> dict:
    """Runs ``work`` on each tile that the folder's state does not hold yet, and
    writes the state after each; a state of another signature is refused."""
    path = f"{folder.rstrip('/')}/run.json"
    if exists(path):
        state = read_json(path)
        if state["signature"] != json.loads(canonical_json(signature)):
            raise ValueError("the run was started with other parameters")
    else:
        fs, inner = place(folder)
        fs.create_dir(inner, recursive=True)
        state = {"signature": dict(signature), "tiles": {}}
    for tile in tiles:
        if tile not in state["tiles"]:
            state["tiles"][tile] = dict(work(tile))
            write_json(path, state)
    return state


def can_start(active: int, workers: int, memory: float, disk: float, least_memory: float, least_disk: float) -> bool:
    """Whether one more piece of work may start with what is free."""
    return active < workers and memory >= least_memory and disk >= least_disk


# -------------------------------------------------------------------- manifests


def manifest(spark: SparkSession, path: str, tiles: Sequence[str] | None = None) -> DataFrame:
    """A delivery manifest (tile, url, bytes, points), of the given tiles only;
    unknown tiles, repeated file names and bad sizes are refused."""
    rows = spark.read.option("header", True).schema("tile string, url string, bytes long, points long").csv(path)
    if tiles is not None:
        unknown = sorted(set(tiles) - {r.tile for r in rows.where(F.col("tile").isin(*tiles)).select("tile").distinct().collect()})
        if unknown:
            raise ValueError(f"tiles not in the manifest: {', '.join(unknown)}")
        rows = rows.where(F.col("tile").isin(*tiles))
    names = rows.groupBy(F.element_at(F.split("url", "/"), -1).alias("name")).count().where("count > 1")
    if not names.isEmpty() or not rows.where("bytes is null or bytes <= 0 or points is null or points <= 0").isEmpty():
        raise ValueError("the manifest repeats a file name or has no size")
    return rows


def fetch(rows: Sequence[Mapping], output: str, opener: Callable[[str, int], Iterable[bytes]], check: Callable[[str], int], workers: int = 4, retries: int = 5) -> list[dict]:
    """Files of a manifest into a folder, by up to eight workers; ``opener(url, at)``
    gives the bytes from a place on, so a broken download goes on where it ended.
    A file counts when its size and ``check(path)``, its number of points, are right."""
    if not 1 <= workers <= 8:
        raise ValueError("one to eight workers")
    fs, root = place(output)
    fs.create_dir(root, recursive=True)

    def one(row: Mapping) -> dict:
        path = f"{root}/{row['url'].rsplit('/', 1)[-1]}"
        size = lambda p: fs.get_file_info(p).size or 0
        if not exists(path):
            part, tries = path + ".part", 0
            while size(part) < row["bytes"] and tries < retries:
                tries += 1
                try:
                    with fs.open_append_stream(part) as f:
                        for piece in opener(row["url"], size(part)):
                            f.write(piece)
                except OSError:
                    continue
            if size(part) != row["bytes"]:
                return {"tile": row["tile"], "status": "SIZE", "bytes": size(part)}
            if check(part) != row["points"]:
                return {"tile": row["tile"], "status": "POINTS", "bytes": size(part)}
            fs.move(part, path)
            state = "FETCHED"
        else:
            state = "PRESENT" if size(path) == row["bytes"] else "SIZE"
        return {"tile": row["tile"], "status": state, "bytes": size(path)}

    with concurrent.futures.ThreadPoolExecutor(workers) as pool:
        done = []
        for result in pool.map(one, rows):
            done.append(result)
            append_line(f"{output.rstrip('/')}/download-log.jsonl", result)
    return done
