"""Summaries over tables of cells, footprints, faces, votes and runs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gridloom.plans.staging import materialize


def digitize(value: Column, breaks: Sequence[float]) -> Column:
    """Class 1, 2, ... by rising breaks, a break's value in the class above; 0 if unknown."""
    out = F.lit(len(breaks) + 1)
    for i, b in reversed(list(enumerate(breaks, 1))):
        out = F.when(value < b, F.lit(i)).otherwise(out)
    return F.when(value.isNull() | F.isnan(value), F.lit(0)).otherwise(out)


def size_class(value: Column, ranges: Sequence[tuple[float, float | None, str]]) -> Column:
    """Label of the range that holds a value; low included, high (None: open) not."""
    out = F.lit(None).cast("string")
    for low, high, label in reversed(ranges):
        out = F.when((value >= low) & (F.lit(True) if high is None else value < high), F.lit(label)).otherwise(out)
    return out


def roof_band(above: Column) -> Column:
    """-1 if unknown, 0 up to half a metre over the roof, 1 up to two, else 2."""
    return F.when(above.isNull() | F.isnan(above), -1).when(above <= 0.5, 0).when(above <= 2, 1).otherwise(2)


def height_statistics(rows: DataFrame, by: str, height: str = "h") -> DataFrame:
    """n, p50, p90 and max per group, of finite heights."""
    h = F.when(F.abs(F.col(height).cast("double")) < float("inf"), F.col(height))  # NaN is over infinity
    return rows.groupBy(by).agg(F.count(h).alias("n"), F.median(h).alias("p50"), F.percentile(h, F.lit(0.9)).alias("p90"), F.max(h).alias("max"))


def footprint_heights(cells: DataFrame, partial: Column | None = None) -> DataFrame:
    """Per footprint of cells (id, roof, ground): coverage, medians, paired heights and
    the status flags that apply, or OK.  Overlapping footprints are independent."""
    pair = F.col("roof").isNotNull() & F.col("ground").isNotNull()
    h = F.when(pair, F.col("roof") - F.col("ground"))
    partly = F.lit(False) if partial is None else partial
    out = cells.groupBy("id").agg(
        F.count("*").alias("cells"), F.count_if(pair).alias("roof_cells"), F.median(F.when(pair, F.col("roof"))).alias("roof_p50"), F.median(F.when(pair, F.col("ground"))).alias("ground_p50"),
        F.median(h).alias("p50"), F.percentile(h, F.lit(0.95)).alias("p95"), F.max(h).alias("max"), F.count_if(h < 0).alias("negative"), F.max(partly).alias("partial"),
    )
    cover = 100 * F.col("roof_cells") / F.col("cells")
    flags = F.concat_ws(
        ";", F.when(F.col("roof_cells") == 0, F.lit("NO_ROOF_SUPPORT")), F.when((F.col("roof_cells") > 0) & (cover < 50), F.lit("LOW_ROOF_SUPPORT")),
        F.when(F.col("negative") > 0, F.lit("NEGATIVE_HEIGHT")), F.when(F.col("partial"), F.lit("PARTIAL_AOI")),
    )
    return out.withColumn("coverage", cover).withColumn("status", F.when(flags == "", F.lit("OK")).otherwise(flags)).drop("partial")


def height_differences(rows: DataFrame, outlier: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """One row that compares lidar with reference heights (id, reference, lidar), and
    the outliers by size of their difference."""
    good = rows.where((F.col("reference") > 0) & F.col("lidar").isNotNull() & ~F.isnan("lidar") & ~F.isnan("reference")).withColumn("difference", F.col("lidar") - F.col("reference"))
    away = F.abs("difference")
    one = good.agg(
        F.count("*").alias("n"), F.median(F.col("lidar") / F.col("reference")).alias("median_ratio"), F.median("difference").alias("bias"), F.avg("difference").alias("mean"),
        F.median(away).alias("median_abs"), F.percentile(away, F.lit(0.9)).alias("p90_abs"),
    )
    return one, good.where(away > outlier).orderBy(away.desc(), "id")


def crosstab_collapse(pairs: DataFrame, positive: int) -> DataFrame:
    """Per reference class (reference, predicted, n): points, those predicted as the
    positive class, and their share."""
    hit = F.sum(F.when(F.col("predicted") == positive, F.col("n")).otherwise(0))
    return pairs.groupBy("reference").agg(F.sum("n").alias("points"), hit.alias("positive"), (hit / F.sum("n")).alias("share"))


def agreement_by_label(units: DataFrame) -> DataFrame:
    """Units (label, expected, family or null, points): how many are eligible, agree
    with their label's family or abstain."""
    eligible = F.col("expected").isNotNull() & (F.col("points") >= 12)
    agree = F.count_if(eligible & (F.col("family") == F.col("expected")))
    n = F.count_if(eligible)
    return units.groupBy("label").agg(F.count("*").alias("units"), n.alias("eligible"), agree.alias("agree"), F.count_if(eligible & F.col("family").isNull()).alias("abstain"), F.when(n > 0, agree / n).alias("agreement"))


def gate_summary(points: DataFrame) -> DataFrame:
    """Counts by class and shape group, with single returns and those near buildings."""
    return points.groupBy("classification", "shape").agg(F.count("*").alias("n"), F.count_if("single").alias("single"), F.count_if(F.col("near_m") <= 1.0).alias("near_building"))


def funnel(points: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """(step, n): rows that pass each step and all before it, in one scan."""
    passed, sums = F.lit(True), []
    for name, condition in steps:
        passed = passed & F.coalesce(condition, F.lit(False))
        sums.append(F.struct(F.lit(len(sums)).alias("step_no"), F.lit(name).alias("step"), F.count_if(passed).alias("n")))
    return points.agg(F.array(*sums).alias("s")).select(F.explode("s").alias("s")).select("s.step_no", "s.step", "s.n")


def cell_medians(shifts: DataFrame, size: float, least: int = 10) -> DataFrame:
    """Median shift (x, y, dx, dy) per square of ``size``, of squares with enough."""
    return shifts.groupBy(F.floor(F.col("x") / size).alias("cx"), F.floor(F.col("y") / size).alias("cy")).agg(F.count("*").alias("n"), F.median("dx").alias("dx"), F.median("dy").alias("dy")).where(F.col("n") >= least)


def _weighted_median(value: np.ndarray, count: np.ndarray) -> float:
    """Median of sorted values, each ``count`` times; nan if there are none."""
    total = np.cumsum(count)
    n = int(total[-1]) if len(total) else 0
    if not n:
        return np.nan
    low, high = np.searchsorted(total, [(n - 1) // 2, n // 2], side="right")
    return 0.5 * value[low] + 0.5 * value[high]


def _medians_around(reach: float, inside: Callable):
    """Per place and own shift (of one block): number, medians and spread of the
    others within reach.  Others are counted per place and shift; a place adds up
    the counts around it once, and takes each own shift out again."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        shifts, code = np.unique(pdf[["dx", "dy"]].to_numpy(), axis=0, return_inverse=True)
        code = code.ravel()
        dx, dy = shifts[:, 0], shifts[:, 1]
        known_x, known_y = (o[~np.isnan(v[o])] for v, o in ((dx, np.argsort(dx, kind="stable")), (dy, np.argsort(dy, kind="stable"))))
        # places by x, and what is counted at each
        places, at = np.unique(pdf[["x", "y"]].to_numpy(), axis=0, return_inverse=True)
        at = at.ravel()
        order = np.argsort(at, kind="stable")
        code_of, others = code[order], pdf["others"].to_numpy()[order]
        start = np.searchsorted(at[order], np.arange(len(places) + 1))
        own = pdf["own"].to_numpy()[order]
        own_index, own_taken = pdf.index.to_numpy()[order], pdf["reliable"].to_numpy()[order]
        out = []
        for p in np.unique(at[pdf["own"].to_numpy()]):
            x, y = places[p]
            a, b = np.searchsorted(places[:, 0], [x - reach * 1.001, x + reach * 1.001])
            near = a + np.flatnonzero(inside(places[a:b, 0] - x, places[a:b, 1] - y))
            length = start[near + 1] - start[near]
            rows = np.arange(length.sum()) + np.repeat(start[near] - np.concatenate(([0], np.cumsum(length)[:-1])), length)
            count = np.bincount(code_of[rows], weights=others[rows], minlength=len(shifts)).astype(np.int64)
            for r in range(start[p], start[p + 1]):
                if not own[r]:
                    continue
                mine = count
                if own_taken[r]:
                    mine = count.copy()
                    mine[code_of[r]] -= 1
                mx, my = _weighted_median(dx[known_x], mine[known_x]), _weighted_median(dy[known_y], mine[known_y])
                there = np.flatnonzero(mine)
                away = np.hypot(dx[there] - mx, dy[there] - my)
                by = np.argsort(away, kind="stable")
                by = by[~np.isnan(away[by])]
                out.append((own_index[r], int(mine.sum()), mx, my, _weighted_median(away[by], mine[there][by])))
        found = pd.DataFrame(out, columns=["row", "n", "mx", "my", "spread"]).set_index("row")
        found["k"] = pdf["k"].loc[found.index]
        return found[["k", "n", "mx", "my", "spread"]]

    return run


def medians_around(fits: DataFrame, reach: float, inside: Callable) -> DataFrame:
    """Per id of footprints (id, x, y, dx, dy, reliable): number of reliable others
    within reach (``inside`` of dx, dy), medians of their shifts and spread.  Ids
    without any are left out.

    Equal footprints are counted and worked on once, and no pairs are written.
    Rows of a repeated id are neighbours of neither, so these ids are joined."""
    from gridloom.operators.surfaces import point_blocks

    kinds = ["x", "y", "dx", "dy", "reliable"]
    rows = fits.select("id", *[F.col(c).cast("double").alias(c) for c in kinds[:4]], F.coalesce("reliable", F.lit(False)).alias("reliable"))
    repeated = materialize(rows.groupBy("id").agg(F.count("*").alias("m")).where("m > 1 or id is null").select("id"), "field-repeated")
    alike = materialize(rows.where("x is not null and y is not null").groupBy(*kinds).agg(F.count("*").alias("m")).withColumn("k", F.monotonically_increasing_id()), "field-alike")
    spread = point_blocks(alike.withColumn("others", F.when(F.col("reliable"), F.col("m")).otherwise(0)), reach, reach).where("own or reliable")
    found = spread.groupBy("bx", "by").applyInPandas(_medians_around(reach, inside), "k long, n long, mx double, my double, spread double")
    null = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    found = materialize(found.where("n > 0").select("k", "n", null("mx"), null("my"), null("spread")), "field-medians")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in kinds]
    once = rows.where("id is not null") if repeated.isEmpty() else rows.join(repeated, "id", "left_anti").where("id is not null")
    one = once.alias("r").join(alike.join(found, "k").alias("f"), same).select("r.id", "n", "mx", "my", "spread")
    return one if repeated.isEmpty() else one.unionByName(_joined_medians(rows.join(repeated, "id", "left_semi"), rows.where("reliable"), reach, inside))


def _joined_medians(own: DataFrame, fits: DataFrame, reach: float, inside: Callable) -> DataFrame:
    cell = lambda c: F.floor(F.col(c) / reach)
    span = F.array(F.lit(-1), F.lit(0), F.lit(1))
    own = own.select("id", "x", "y").withColumn("i", F.explode(span)).withColumn("j", F.explode(span)).withColumns({"cx": cell("x") + F.col("i"), "cy": cell("y") + F.col("j")})
    other = fits.select(F.col("id").alias("oid"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("dx").alias("odx"), F.col("dy").alias("ody"), cell("x").alias("cx"), cell("y").alias("cy"))
    near = own.join(other, ["cx", "cy"]).where((F.col("id") != F.col("oid")) & inside(F.col("x") - F.col("ox"), F.col("y") - F.col("oy")))
    middle = near.groupBy("id").agg(F.count("*").alias("n"), F.median("odx").alias("mx"), F.median("ody").alias("my"))
    spread = near.join(middle, "id").groupBy("id").agg(F.median(F.hypot(F.col("odx") - F.col("mx"), F.col("ody") - F.col("my"))).alias("spread"))
    return middle.join(spread, "id", "left")


def local_field(fits: DataFrame, reach: float = 150.0, least: int = 5) -> DataFrame:
    """Per footprint (id, x, y, dx, dy, reliable): the median shift of reliable others
    within reach, their number, spread, and how far its own shift is from theirs."""
    hypot = lambda u, v: (F.hypot(u, v) if isinstance(u, Column) else np.hypot(u, v)) <= reach
    enough = F.col("n") >= least
    joined = fits.join(medians_around(fits, reach, hypot), "id", "left")
    pick = lambda c: F.when(enough, F.col(c))
    return joined.select(
        "id", F.coalesce("n", F.lit(0)).alias("n"), pick("mx").alias("local_dx"), pick("my").alias("local_dy"), pick("spread").alias("spread"), F.hypot(pick("mx"), pick("my")).alias("local_m"),
        F.hypot(F.col("dx") - pick("mx"), F.col("dy") - pick("my")).alias("resid_m"),
    )


def shift_field(points: DataFrame, reach: float, least: int = 5) -> DataFrame:
    """(id, n, shift) of points (id, x, y, sx): number and median shift of the others
    within reach, where there are enough."""
    fits = points.select("id", "x", "y", F.col("sx").alias("dx"), F.lit(0.0).alias("dy"), F.lit(True).alias("reliable"))
    return medians_around(fits, reach, lambda u, v: u * u + v * v <= reach * reach).where(F.col("n") >= least).select("id", "n", F.col("mx").alias("shift"))


def state_counts(cells: DataFrame, cell_area: float) -> DataFrame:
    """Cells, hectares and share of each state per zone and class."""
    n = cells.groupBy("zone", "class", "state").agg(F.count("*").alias("cells"))
    total = n.groupBy("zone", "class").agg(F.sum("cells").alias("all"))
    return n.join(total, ["zone", "class"]).select("zone", "class", "state", "cells", (F.col("cells") * cell_area / 10_000).alias("ha"), (100 * F.col("cells") / F.col("all")).alias("pct"))


def roof_attributes(faces: DataFrame, main: float = 4.0, flat: float = 10.0, steep: float = 60.0) -> DataFrame:
    """Per building of roof faces (id, plan, area, perimeter, slope, azimuth, z_min,
    z_max, ground): main faces (of enough plan; all if none), area-weighted slope, the
    largest face's, areas by facing, ridge and eave heights, and odd faces."""
    big = F.col("plan") >= main
    some = faces.groupBy("id").agg(F.max(big).alias("has_main"))
    use = faces.join(some, "id").withColumn("use", big | ~F.col("has_main"))
    area = F.when(F.col("use"), F.col("area"))
    sloped = F.col("use") & F.col("slope").between(flat, steep)
    at = lambda low, high: F.col("azimuth").between(low, high) & (F.col("azimuth") < high) if low < high else (F.col("azimuth") >= low) | (F.col("azimuth") < high)
    side = lambda low, high: F.coalesce(F.sum(F.when(sloped & at(low, high), F.col("area"))), F.lit(0.0))
    return use.groupBy("id").agg(
        F.count_if(big).alias("planes"), F.count("*").alias("faces"), F.sum(F.when(F.col("use"), F.col("plan"))).alias("plan"), F.sum(area).alias("area"), (F.sum(area * F.col("slope")) / F.sum(area)).alias("slope_mean"),
        F.max_by("slope", F.struct(area, F.col("slope"))).alias("slope_main"), (F.max("z_max") - F.max("ground")).alias("ridge"), (F.min("z_min") - F.max("ground")).alias("eave"),
        F.coalesce(F.sum(F.when(F.col("use") & (F.col("slope") < flat), F.col("area"))), F.lit(0.0)).alias("flat_area"), side(315, 45).alias("north"), side(45, 135).alias("east"), side(135, 225).alias("south"), side(225, 315).alias("west"),
        F.count_if(F.col("plan") < 0.5).alias("tiny"), F.count_if((F.col("perimeter") > 0) & (2 * F.col("plan") / F.col("perimeter") < 0.4)).alias("slivers"), F.count_if(F.col("slope") > 75).alias("steep"),
    )


def level_errors(cells: DataFrame, by: str = "id") -> DataFrame:
    """Errors of a roof model (model or null) against lidar: bias, absolute p50 and
    p95, shares within 0.5 and 1 m, over 1 m above, missing."""
    e = F.col("model") - F.col("lidar")
    known = F.count(e)
    pct = lambda cond: F.when(known > 0, 100 * F.count_if(cond) / known)
    return cells.groupBy(by).agg(
        F.count("*").alias("cells"), F.median(e).alias("bias"), F.median(F.abs(e)).alias("abs_p50"), F.percentile(F.abs(e), F.lit(0.95)).alias("abs_p95"), pct(F.abs(e) <= 0.5).alias("within_05"),
        pct(F.abs(e) <= 1).alias("within_1"), pct(e > 1).alias("above_1"), (100 * F.count_if(F.col("model").isNull()) / F.count("*")).alias("missing"),
    )


def grade_models(answers: DataFrame, needed: int, share: float) -> DataFrame:
    """Per task and confidence (task, confidence, call, answer): hits of all that are
    answered, and whether the gate is passed."""
    scored = F.col("answer").isNotNull() & (F.col("answer") != "UNSURE")
    n, hits = F.count_if(scored), F.count_if(scored & (F.col("answer") == F.col("call")))
    return answers.groupBy("task", "confidence").agg(n.alias("n"), hits.alias("hits"), ((n >= needed) & (hits >= share * n)).alias("passed"))


def compare_runs(base: DataFrame, new: DataFrame) -> DataFrame:
    """Per metric of two runs (metric, value): both values, difference and percent."""
    a, b = base.select("metric", F.col("value").alias("base")), new.select("metric", F.col("value").alias("new"))
    gap = F.col("new") - F.col("base")
    return a.join(b, "metric", "full").select("metric", "base", "new", gap.alias("difference"), F.when(F.col("base") != 0, 100 * gap / F.col("base")).alias("percent"))


def zip_points(a: DataFrame, b: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Points of two copies of a file, joined by place in the file; places that only
    one has, or that lie apart, stop the query."""
    other = b.select("point_index", *[F.col(c).alias("_" + c) for c in "xyz"], *[c for c in b.columns if c not in a.columns])
    met = a.join(other, "point_index", "full")
    off = F.greatest(*[F.abs(F.col(c) - F.col("_" + c)) for c in "xyz"])
    good = F.coalesce(off <= tolerance, F.lit(False))
    return met.withColumn("x", F.when(good, F.col("x")).otherwise(F.raise_error(F.concat(F.lit("copies differ at point "), F.col("point_index").cast("string"))).cast("double"))).drop("_x", "_y", "_z")


def eyes_split(items: DataFrame, risky: Column, per_stratum: int, seed: int) -> DataFrame:
    """Items (id, stratum): EYES for the risky ones, SAMPLE for a fixed number of the
    others per stratum by hash, RULE for the rest."""
    from pyspark.sql import Window as W

    from gridloom.operators.reviews import draw_key

    tagged = items.withColumn("_r", F.coalesce(risky, F.lit(False)))
    place = F.row_number().over(W.partitionBy("stratum", "_r").orderBy(draw_key(seed, F.col("id")), "id"))
    return tagged.withColumn("_p", place).withColumn("part", F.when(F.col("_r"), F.lit("EYES")).when(F.col("_p") <= per_stratum, F.lit("SAMPLE")).otherwise(F.lit("RULE"))).drop("_r", "_p")


def tile_record(headers: DataFrame) -> DataFrame:
    """One row over a delivery's headers: counts, sums, versions, dates and densities."""
    area = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    density = F.when(area > 0, F.col("points") / area)
    return headers.agg(
        F.count("*").alias("tiles"), F.sum("points").alias("points"), F.sum("bytes").alias("bytes"), F.array_join(F.array_sort(F.collect_set(F.concat_ws("/", "version", "format"))), ";").alias("formats"),
        F.min(density).alias("density_min"), F.median(density).alias("density_p50"), F.max(density).alias("density_max"), F.min("zmin").alias("zmin"), F.max("zmax").alias("zmax"),
    )
