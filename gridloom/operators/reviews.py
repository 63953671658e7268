"""Samples, review queues, answers and decisions.

Draws are by keyed hash: the same keys and seed give the same draw in any order
of rows and on any number of tasks, without numbering the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from gridloom.plans.staging import discard, materialize


def draw_key(seed: int | str, *keys: Column) -> Column:
    """A key's place in the random order of a seed."""
    return F.xxhash64(F.lit(str(seed)), *[k.cast("string") for k in keys])


def draw(rows: DataFrame, key: str, n: int, seed: int, strata: Sequence[str] = ()) -> DataFrame:
    """A simple random sample of n rows (per stratum) without replacement, with its
    ``draw`` order; ties of hashes go by key."""
    order = W.partitionBy(*strata).orderBy(draw_key(seed, F.col(key)), key) if strata else None
    if order is None:
        some = rows.orderBy(draw_key(seed, F.col(key)), key).limit(n)  # a top-n that every task prunes
        return some.withColumn("draw", F.row_number().over(W.orderBy(draw_key(seed, F.col(key)), key)))
    return rows.withColumn("draw", F.row_number().over(order)).where(F.col("draw") <= n)


def review_order(units: DataFrame, seed: int, key: str = "id", stratum: str = "stratum") -> DataFrame:
    """Adds ``batch`` and ``place``: the first half of each stratum's draw, rounded
    up, is batch 1; within a batch units come in random order.  Places are numbered
    by a range partition per batch, not in one task."""
    sizes = units.groupBy(stratum).agg(F.count("*").alias("_n"))
    rank = F.row_number().over(W.partitionBy(stratum).orderBy("draw", key))
    batched = units.join(sizes, stratum).withColumn("batch", F.when(rank <= F.ceil(F.col("_n") / 2), F.lit(1)).otherwise(F.lit(2))).drop("_n")
    keyed = materialize(batched.withColumn("_k", draw_key(seed, F.col("batch"), F.col(key))), "review-order")
    # 256 slices of the hash's range; a slice's first place is the size of those before it
    part = keyed.withColumn("_s", F.shiftright("_k", 56))
    counts = part.groupBy("batch", "_s").agg(F.count("*").alias("_c"))
    before = W.orderBy("batch", "_s").rowsBetween(W.unboundedPreceding, -1)  # at most 512 rows
    starts = counts.withColumn("_b", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c")
    inside = F.row_number().over(W.partitionBy("batch", "_s").orderBy("_k", key))
    return part.withColumn("_i", inside).join(F.broadcast(starts), ["batch", "_s"]).withColumn("place", (F.col("_b") + F.col("_i")).cast("long")).drop("_k", "_s", "_b", "_i")


def spaced(units: DataFrame, spacing: float, order: Sequence[str]) -> DataFrame:
    """Units (id, x, y) kept one after the other in ``order``, each only if no kept
    one is nearer than ``spacing``: the same as going through them in turn.

    In rounds: a unit is kept once all earlier ones near it have gone, and goes
    once one near it is kept."""
    key = F.struct(*order, "id")
    state = materialize(units.withColumn("_o", key), "spaced")
    cell = lambda c: F.floor(F.col(c) / spacing)
    span = F.array(F.lit(-1), F.lit(0), F.lit(1))
    a = state.select(F.col("id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("_o").alias("ao"), F.explode(span).alias("i")).withColumn("j", F.explode(span))
    a = a.withColumns({"cx": F.floor(F.col("ax") / spacing) + F.col("i"), "cy": F.floor(F.col("ay") / spacing) + F.col("j")})
    b = state.select(F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), F.col("_o").alias("bo"), cell("x").alias("cx"), cell("y").alias("cy"))
    close = F.hypot(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by")) < spacing
    links = materialize(a.join(b, ["cx", "cy"]).where(close & (F.col("bo") < F.col("ao"))).select("a", "b"), "spaced-links")  # b comes before a
    open_ = materialize(state.select("id"), "spaced-open")
    kept = None
    while not open_.isEmpty():
        waiting = links.join(open_.select(F.col("id").alias("b")), "b", "left_semi")
        free = materialize(open_.join(waiting.select(F.col("a").alias("id")).distinct(), "id", "left_anti"), "spaced-free")
        kept = free if kept is None else kept.union(free)
        gone = links.join(free.select(F.col("id").alias("b")), "b", "left_semi").select(F.col("a").alias("id")).distinct()
        old, open_ = open_, materialize(open_.join(free, "id", "left_anti").join(gone, "id", "left_anti"), "spaced-open")
        discard(old)
    return units.limit(0) if kept is None else units.join(kept, "id", "left_semi")


def draw_spaced(units: DataFrame, sizes: Sequence[tuple[str, int]], seed: int, spacing: float) -> DataFrame:
    """Per stratum, in the given order, n units in random order, none nearer than
    ``spacing`` to one taken before, of any stratum."""
    taken = None
    for stratum, n in sizes:
        own = units.where(F.col("stratum") == stratum).withColumn("_k", draw_key(seed, F.col("id")))
        if taken is not None:  # those taken come first, so they hold their ground
            pool = taken.withColumn("_first", F.lit(0)).unionByName(own.withColumn("_first", F.lit(1)))
        else:
            pool = own.withColumn("_first", F.lit(1))
        good = spaced(pool, spacing, ["_first", "_k"]).where("_first = 1").orderBy("_k", "id").limit(n).drop("_first")
        good = materialize(good, "draw-spaced")
        taken = good if taken is None else taken.unionByName(good)
    return taken.drop("_k")


def interleave(queues: DataFrame, order: Sequence[str], spacing: float | None = None) -> DataFrame:
    """One review order over queues (queue, place, id, x, y): first of each in turn,
    then second of each, and so on.  With ``spacing``, a unit too near to an earlier
    one goes, and those behind it in its queue move up."""
    rank = F.array_position(F.array(*[F.lit(q) for q in order]), F.col("queue"))
    if spacing is not None:
        queues = spaced(queues.withColumn("_q", rank), spacing, ["place", "_q"]).drop("_q")
    turn = F.row_number().over(W.partitionBy("queue").orderBy("place", "id"))
    numbered = materialize(queues.withColumns({"queue_order": turn, "_q": rank}), "interleave")
    # before a unit come, of every queue, the units of earlier turns, and of its own turn the queues before it
    longest = numbered.groupBy("_q").agg(F.count("*").alias("n"))
    before = numbered.join(F.broadcast(longest.withColumnRenamed("_q", "_o")), F.lit(True))  # one row per queue
    ahead = F.least("n", F.col("queue_order") - 1 + (F.col("_o") < F.col("_q")).cast("int"))
    return before.groupBy(*numbered.columns).agg((F.sum(ahead) + 1).cast("long").alias("review_order")).drop("_q")


def priority_sample(candidates: DataFrame, cap: int, seed: int, top_share: float = 0.5) -> DataFrame:
    """The first part by priority (ties by x, y), the rest of ``cap`` at random from
    what is left; ``selection`` says which."""
    n = math.ceil(cap * top_share)
    top = materialize(candidates.orderBy(F.col("priority").desc(), "x", "y", "id").limit(n), "priority-top")
    rest = candidates.join(top.select("id"), "id", "left_anti")
    random = rest.orderBy(draw_key(seed, F.col("id")), "id").limit(max(0, cap - n))
    return top.withColumn("selection", F.lit("TOP")).unionByName(random.withColumn("selection", F.lit("RANDOM")))


def draw_plots(spark: SparkSession, tiles: DataFrame, count: int, seed: int, size: float = 30.0) -> DataFrame:
    """``count`` whole plots of each tile (tile, xmin, ymin, xmax, ymax), drawn by a
    seed of its own; tiles with fewer are refused."""
    if count < 1:
        raise ValueError("at least one plot")
    cols, rows = F.floor((F.col("xmax") - F.col("xmin")) / size), F.floor((F.col("ymax") - F.col("ymin")) / size)
    sized = tiles.withColumns({"cols": cols, "rows": rows}).withColumn("population", F.col("cols") * F.col("rows"))
    if not sized.where((F.col("population") < count) | F.col("population").isNull()).isEmpty():
        raise ValueError("a tile has too few whole plots")
    cells = sized.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("population") - 1)))
    order = W.partitionBy("tile").orderBy(draw_key(seed, F.col("tile"), F.col("cell")), "cell")
    drawn = cells.withColumn("order", F.row_number().over(order)).where(F.col("order") <= count)
    row, col = F.floor(F.col("cell") / F.col("cols")), F.col("cell") % F.col("cols")
    x, y = F.col("xmin") + col * size, F.col("ymin") + row * size
    return drawn.select("tile", "order", "population", F.format_string("%s_%03d_%03d", "tile", row, col).alias("plot"), x.alias("x0"), y.alias("y0"), (x + size).alias("x1"), (y + size).alias("y1"))


def random_places(cells: DataFrame, n: int, seed: int, cell: float, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """n cells (row, col) of an allowed domain, each with a place up to a quarter cell
    from its centre."""
    some = cells.orderBy(draw_key(seed, F.col("row"), F.col("col")), "row", "col").limit(n)
    jitter = lambda axis: (F.pmod(draw_key(f"{seed}{axis}", F.col("row"), F.col("col")), F.lit(1 << 20)) / (1 << 20) - 0.5) * 0.5
    return some.select("row", "col", (x0 + (F.col("col") + 0.5 + jitter("x")) * cell).alias("x"), (y0 + (F.col("row") + 0.5 + jitter("y")) * cell).alias("y"))


def block_split(units: DataFrame, seed: int, block: float = 50.0, share: float = 0.2) -> DataFrame:
    """Adds ``split``: whole blocks go to VALIDATION, a share of them by hash, one at
    least if there are two."""
    keyed = units.withColumns({"_bx": F.floor(F.col("x") / block), "_by": F.floor(F.col("y") / block)})
    blocks = materialize(keyed.select("_bx", "_by").distinct(), "split-blocks")
    n = blocks.count()
    wanted = max(1, int(round(n * share))) if n > 1 else 0
    valid = blocks.orderBy(draw_key(seed, F.col("_bx"), F.col("_by")), "_bx", "_by").limit(wanted).withColumn("split", F.lit("VALIDATION"))
    return keyed.join(valid, ["_bx", "_by"], "left").na.fill("TRAINING", ["split"]).drop("_bx", "_by")


def cap_per_band(items: DataFrame, cap: int) -> DataFrame:
    """Items (band, place, touched): all that were touched, and of the others the
    first of each band up to ``cap`` in all."""
    touched = F.sum(F.col("touched").cast("int")).over(W.partitionBy("band"))
    rank = F.row_number().over(W.partitionBy("band", "touched").orderBy("place"))
    return items.withColumns({"_t": touched, "_r": rank}).where(F.col("touched") | (F.col("_r") <= cap - F.col("_t"))).drop("_t", "_r")


def best_sites(candidates: DataFrame, criteria: Sequence[str], spacing: float = 5.0) -> DataFrame:
    """For each criterion in turn the candidate (id, x, y) with the largest value not
    within ``spacing`` of one chosen before; as many rows as criteria at most."""
    chosen: list[tuple] = []
    for name in criteria:
        free = candidates.where(F.col(name).isNotNull())
        for _, _, x, y in chosen:
            free = free.where(F.hypot(F.col("x") - x, F.col("y") - y) >= spacing)
        best = free.orderBy(F.col(name).desc(), "id").select("id", "x", "y").first()
        if best:
            chosen.append((name, best.id, best.x, best.y))
    kind = dict(candidates.dtypes)["id"]
    return candidates.sparkSession.createDataFrame(chosen, f"criterion string, id {kind}, x double, y double")


# ---------------------------------------------------------------------- answers


def checked_answers(answers: DataFrame, units: DataFrame, labels: Sequence[str], today: str) -> DataFrame:
    """Answers (id, label, reviewer, note, date) with ``problem``: '' for a good one,
    else why it is refused."""
    known = answers.join(units.select("id", F.lit(True).alias("_known")), "id", "left")
    label = F.upper(F.trim(F.coalesce("label", F.lit(""))))
    reviewer = F.trim(F.coalesce("reviewer", F.lit("")))
    day = F.try_to_date(F.substring(F.trim("date"), 1, 10), "yyyy-MM-dd")
    problem = (
        F.when(F.col("_known").isNull(), "unknown unit").when(~label.isin(*labels), "label is not in the domain").when((reviewer == "") | (F.length(reviewer) > 64), "reviewer")
        .when(F.length(F.coalesce("note", F.lit(""))) > 500, "note").when(day.isNull(), "date").when(day > F.date_add(F.to_date(F.lit(today)), 1), "date in the future").otherwise("")
    )
    return known.select("id", label.alias("label"), reviewer.alias("reviewer"), F.nullif(F.coalesce("note", F.lit("")), F.lit("")).alias("note"), day.alias("date"), problem.alias("problem"))


def merged_answers(store: DataFrame, new: DataFrame) -> DataFrame:
    """The store (id, answer, note, reviewer) after new ones in order of ``seq``:
    another reviewer's answer never changes; a blank answer without a note takes the
    row away; a note alone may stand.  ``taken`` counts what was applied."""
    current = store.select("id", "answer", "note", "reviewer", F.lit(-1).cast("long").alias("seq"))
    every = current.unionByName(new.select("id", "answer", "note", "reviewer", F.col("seq").cast("long").alias("seq")))
    history = every.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("seq", "answer", "note", "reviewer"))).alias("h"))  # answers to one item
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    kind = "struct<answer:string,note:string,reviewer:string,taken:int>"
    nothing = F.lit(None).cast(kind)

    def step(acc: Column, x: Column) -> Column:
        held = acc["reviewer"].isNotNull() & (acc["reviewer"] != x["reviewer"])
        gone = blank(x["answer"]) & blank(x["note"])
        n = F.coalesce(acc["taken"], F.lit(0)) + (x["seq"] >= 0).cast("int")
        row = F.struct(x["answer"].alias("answer"), x["note"].alias("note"), x["reviewer"].alias("reviewer"), n.alias("taken"))
        away = F.struct(F.lit(None).cast("string").alias("answer"), F.lit(None).cast("string").alias("note"), F.lit(None).cast("string").alias("reviewer"), n.alias("taken"))
        return F.when(held, acc).when(gone, away.cast(kind)).otherwise(row.cast(kind))

    last = history.select("id", F.aggregate("h", nothing, step).alias("s")).select("id", "s.*")
    return last.where("reviewer is not null")


def merged_decisions(groups: DataFrame, answers: DataFrame, rules: DataFrame, calls: DataFrame, failed: DataFrame) -> DataFrame:
    """One decision per group (id, kind) by the first of: a person's answer (id,
    decision), a rule for its kind that is still waiting, a call on its whole kind,
    a check of the kind that failed (back to waiting)."""
    joined = (
        groups.join(answers.select("id", F.col("decision").alias("_a")), "id", "left").join(rules.select("kind", F.col("decision").alias("_r")), "kind", "left")
        .join(calls.select("kind", F.col("decision").alias("_c")), "kind", "left").join(failed.select("kind", F.lit(True).alias("_f")), "kind", "left")
    )
    waiting, by_rule = F.col("by") == "waiting", F.col("by") == "rule"
    who = (
        F.when(F.col("_a").isNotNull() & (F.col("by") != "person"), "person").when(waiting & F.col("_r").isNotNull(), "rule").when(by_rule & F.col("_c").isNotNull(), "call")
        .when(by_rule & F.col("_f"), "waiting").otherwise(F.col("by"))
    )
    what = (
        F.when(F.col("_a").isNotNull() & (F.col("by") != "person"), F.col("_a")).when(waiting & F.col("_r").isNotNull(), F.col("_r")).when(by_rule & F.col("_c").isNotNull(), F.col("_c"))
        .when(by_rule & F.col("_f"), F.lit(None).cast("string")).otherwise(F.col("decision"))
    )
    return joined.select("id", "kind", who.alias("by"), what.alias("decision"))


def consensus_problems(points: DataFrame, repeats: int, codes: Sequence[int]) -> DataFrame:
    """One row with the number of points whose vote fields (code, agreement, tied,
    strict) contradict each other, by kind of fault."""
    a, n = F.col("agreement"), repeats
    votes = a * n
    count = lambda c: F.count_if(F.coalesce(c, F.lit(True)))
    strict = (a > 0.5) & ~F.col("tied")
    return points.agg(
        count(~F.col("code").isin(0, *codes)).alias("unknown_code"), count(F.isnan(a) | (a < 1 / n - 1e-6) | (a > 1)).alias("agreement_range"), count(F.abs(votes - F.rint(votes)) > 1e-5).alias("not_a_count"),
        count((F.col("code") == 0) != F.col("tied")).alias("code_0_not_tie"), count(strict != F.col("strict")).alias("strict_flag"), count(F.col("tied") & (a > 0.5)).alias("tie_with_majority"),
    )


def pass_spread(pairs: DataFrame, most: float = 0.02) -> DataFrame:
    """(tile, spread, even): gap between the highest and lowest agreement of two passes."""
    spread = F.max("agreement") - F.min("agreement")
    return pairs.groupBy("tile").agg(spread.alias("spread"), (spread <= most).alias("even"))


def flagged_out(rows: DataFrame, flags: DataFrame, values: Sequence[str], key: str = "id") -> DataFrame:
    """Rows whose key has none of the flag values."""
    return rows.join(flags.where(F.col("flag").isin(*values)).select(key).distinct(), key, "left_anti")


def product_class(base: Column, tree: Column, building: Column, policy: str = "tree-wins", conflict: int = 64) -> Column:
    """Class of a combined product: noise and ground of the baseline stay; of two
    models that both claim a point the policy's wins."""
    if policy not in ("tree-wins", "building-wins", "conflict-class") or policy == "conflict-class" and not 64 <= conflict <= 255:
        raise ValueError("unknown policy, or a conflict class out of 64 to 255")
    both = (tree == 5) & (building == 6)
    first = {"tree-wins": F.lit(5), "building-wins": F.lit(6), "conflict-class": F.lit(conflict)}[policy]
    return F.when(base.isin(7, 18), base).when(base == 2, F.lit(2)).when(both, first).when(tree == 5, F.lit(5)).when(building == 6, F.lit(6)).otherwise(F.lit(0))


def tree_cues(height: Column, width: Column, area: Column, roof_pct: Column, shed_pct: Column, trunk_in: Column, tops: Column, relief: Column) -> Column:
    """Flags of a tree model that call for a look, joined by ';'."""
    on = lambda cond, name: F.when(F.coalesce(cond, F.lit(False)), F.lit(name))
    return F.concat_ws(
        ";", on(height < 3, "SHRUB_LIKE"), on((height < 6) & (area >= 40) & (height < 0.5 * width), "BRUSH_LIKE"), on((roof_pct >= 25) | (shed_pct >= 25) | trunk_in, "ROOF_OR_SHED"),
        on((tops >= 6) | (width > 15), "MERGED_LIKE"), on(relief >= 3, "STEEP_GROUND"),
    )


def rule_group(kind: Column, canopy_pct: Column, vehicle: Column, area: Column) -> Column:
    """Review group of a compared outline; samples are drawn from these groups."""
    reshaped = F.when(canopy_pct >= 30, "auto_reshaped_trees").when(canopy_pct < 10, "auto_reshaped_lidar").otherwise("decide_reshaped")
    lone = F.when(vehicle, "auto_vehicles").when(area < 20, "small_rest").otherwise("auto_lidar_only")
    return (
        F.when(kind == "JOINS", "joins_wait").when(kind == "RESHAPED", reshaped).when(kind == "SPLITS", "auto_splits").when(kind == "TANGLE", "tangle_wait")
        .when(kind == "LEFT_ONLY", F.when(canopy_pct >= 30, "auto_county_kept").otherwise("auto_county_gone")).when(kind == "RIGHT_ONLY", lone)
    )
