"""Files, feeds, samples, answers, point shapes and streams."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_sources import folder, write_las  # noqa: F401

from gridloom.operators import reviews as V, surfaces as S
from gridloom.sources import feeds, files, las
from gridloom.streaming import windows


# ------------------------------------------------------------------------ files


def test_rewrite_keeps_all_other_bytes(spark, folder):  # noqa: F811
    path, _ = folder
    las.register(spark)
    points = spark.read.format("las").load(str(path)).where(~F.col("file").rlike("/(new|up)/"))
    changes = points.where("point_index % 5 = 0").select("file", "point_index", F.lit(9).alias("classification"), (F.col("z") + 1).alias("z"))
    audit = {r.file.split("/")[-1]: r for r in las.rewrite(points.select("file"), changes, str(path / "new"), ["classification"]).collect()}
    assert {n: r.changed for n, r in audit.items()} == {"a.las": 10, "b.las": 10}
    pairs = spark.createDataFrame([(r.file, r.target) for r in audit.values()], "original string, copy string")
    for r in las.compare_copies(pairs).collect():
        assert r.same_layout and r.other_bytes == 0 and r.changed == 10
    same = {r.file.split("/")[-2:][-1]: r.sha256 for r in las.protected_hashes(points.select("file").distinct()).collect()}
    new = {r.file.split("/")[-1]: r.sha256 for r in las.protected_hashes(pairs.select(F.col("copy").alias("file"))).collect()}
    assert same == new
    with pytest.raises(Exception, match="Exists|exists"):
        las.rewrite(points.select("file"), changes, str(path / "new"), ["classification"]).collect()
    las.rewrite(points.select("file"), changes.drop("classification"), str(path / "up"), ["z"]).collect()
    up = spark.read.format("las").load(str(path / "up")).agg(F.sum("z").alias("s"), F.max("z").alias("m")).first()
    old = points.agg(F.sum("z").alias("s")).first()
    assert up.s == pytest.approx(old.s + 20, abs=1e-6)
    head = spark.read.format("las").option("part", "headers").load(str(path / "up")).agg(F.max("zmax").alias("m")).first()
    assert head.m == pytest.approx(up.m)


def test_more_bad_headers(tmp_path):
    xyz = np.ones((3, 3))
    write_las(tmp_path / "a.las", xyz, [2] * 3, fmt=6, minor=2)
    write_las(tmp_path / "b.las", xyz, [2] * 3, minor=4, fmt=6)
    raw = bytearray((tmp_path / "b.las").read_bytes())
    raw[104] |= 0x80
    (tmp_path / "c.las").write_bytes(raw)
    raw = bytearray((tmp_path / "b.las").read_bytes())
    raw[100] = 3  # variable-length records that are not there
    (tmp_path / "d.las").write_bytes(raw)
    for name in ("a", "c", "d", "none"):
        with pytest.raises(las.BadFile):
            las.header(str(tmp_path / f"{name}.las"))
    assert las.header(str(tmp_path / "b.las"))["points"] == 3


def test_json_sinks_fingerprints_and_gates(tmp_path):
    p = str(tmp_path / "state.json")
    files.write_json(p, {"a": 1})
    assert files.read_json(p) == {"a": 1} and not files.exists(p + ".pending")
    with pytest.raises(FileExistsError):
        files.write_json(p, {}, refuse=True)
    record = files.fingerprint(p)
    files.verify_fingerprint(record, p)
    files.write_json(p, {"a": 2})
    with pytest.raises(ValueError):
        files.verify_fingerprint(record, p)
    frame = {"x": 1.5}
    frame["digest"] = files.frame_digest(frame)
    assert files.check_frame(frame) is frame
    with pytest.raises(ValueError):
        files.check_frame(frame | {"x": 2})
    model = {"path": str(tmp_path / "m"), **{}}
    (tmp_path / "m").write_bytes(b"model")
    prints = {k: files.fingerprint(str(tmp_path / n)) for k, n in (("source", "state.json"), ("output", "state.json"), ("model", "m"))}
    good = {"schema_version": 1, "status": "complete", "job": "tree", "output_classes": [0, 5], "class_mode": "EDIT_ALL", "excluded_class_codes": [7, 18], **prints, "input": prints["source"], "boundary": [0, 0, 9, 9]}
    assert files.inference_extent(good, "tree", p, p, [1, 1, 5, 5]) == [1, 1, 5, 5] and model
    for bad in (good | {"status": "failed"}, good | {"output_classes": [0, 6]}, good | {"input": {}}):
        with pytest.raises(ValueError):
            files.inference_extent(bad, "tree", p, p)
    with pytest.raises(ValueError):
        files.inference_extent(good, "tree", p, p, [1, 1, 10, 5])
    assert not files.completed(str(tmp_path / "nothing"))
    prep = tmp_path / "prep"
    prep.mkdir()
    with pytest.raises(ValueError):
        files.completed(str(prep))
    (prep / "a.las").write_bytes(b"x")
    files.write_json(str(prep / "preparation.json"), {"status": "complete", "files": ["a.las"]})
    assert files.completed(str(prep))
    assert files.csv_text([{"a": 1, "b": None}, {"a": 'x,"y"', "b": float("nan")}], ["a", "b"]) == 'a,b\n1,\n"x,""y""",\n'


def test_run_resumes_where_it_stopped(tmp_path):
    done = []

    def work(tile):
        if tile == "c" and len(done) < 3:
            done.append("fail")
            raise OSError("lost")
        done.append(tile)
        return {"n": len(tile)}

    with pytest.raises(OSError):
        files.run_tiles(str(tmp_path / "run"), ["a", "b", "c"], {"cell": 0.5}, work)
    state = files.run_tiles(str(tmp_path / "run"), ["a", "b", "c"], {"cell": 0.5}, work)
    assert done == ["a", "b", "fail", "c"] and list(state["tiles"]) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        files.run_tiles(str(tmp_path / "run"), ["a"], {"cell": 1.0}, work)
    assert files.can_start(1, 2, 8, 9, 4, 4) and not files.can_start(2, 2, 8, 9, 4, 4)


def test_fetch_goes_on_after_a_break(spark, tmp_path):
    body, calls = bytes(range(200)), []

    def opener(url, at):
        calls.append(at)
        yield body[at : at + 120]
        if at == 0:
            raise OSError("broken")

    rows = [{"tile": "t1", "url": "http://x/t1.las", "bytes": 200, "points": 7}, {"tile": "t2", "url": "http://x/t2.las", "bytes": 300, "points": 7}]
    got = {r["tile"]: r["status"] for r in files.fetch(rows, str(tmp_path / "in"), opener, lambda p: 7, workers=1, retries=3)}
    assert got == {"t1": "FETCHED", "t2": "SIZE"} and calls[:2] == [0, 120]
    assert (tmp_path / "in" / "t1.las").read_bytes() == body
    assert len((tmp_path / "in" / "download-log.jsonl").read_text().splitlines()) == 2
    (tmp_path / "m.csv").write_text("tile,url,bytes,points\na,http://x/a.las,10,1\nb,http://x/b.las,20,2\n")
    assert files.manifest(spark, str(tmp_path / "m.csv"), ["b"]).first().bytes == 20
    with pytest.raises(ValueError):
        files.manifest(spark, str(tmp_path / "m.csv"), ["z"])


# ------------------------------------------------------------------------ feeds


def test_map_polygons(spark):
    at = lambda *pts: [{"lon": x, "lat": y} for x, y in pts]
    doc = {"elements": [
        {"type": "way", "id": 1, "tags": {"building": "yes"}, "geometry": at((0, 0), (1, 0), (1, 1), (0, 0))}, {"type": "way", "id": 2, "geometry": at((0, 0), (1, 0), (1, 1))},
        {"type": "relation", "id": 3, "tags": {"type": "multipolygon"}, "members": [{"type": "way", "role": "outer", "geometry": at((0, 0), (4, 0), (4, 4))}, {"type": "way", "role": "outer", "geometry": at((0, 0), (0, 4), (4, 4))}]},
        {"type": "relation", "id": 4, "tags": {"type": "route"}}, {"type": "node", "id": 5},
    ]}
    text = json.dumps(doc)
    got = {(r.type, r.id): r for r in feeds.map_polygons(spark.createDataFrame([(text,), (text,)], "body string")).collect()}
    assert len(got) == 5 and got["way", 1].skipped is None and got["way", 2].skipped == "open way" and got["relation", 4].skipped == "no polygon"
    assert len(got["relation", 3].rings) == 1 and len(got["relation", 3].rings[0]) == 5
    assert "(40.0,-111.0,41.0,-110.0)" in feeds.overpass_query(-111.0, 40.0, -110.0, 41.0)


def test_capabilities_models_and_attributes(spark):
    xml = """<WMS xmlns="http://www.opengis.net/wms"><Capability><Layer><Title>All</Title><CRS>EPSG:3857</CRS><Layer><Name>d1</Name><Title>Flight 2024-05-06</Title><CRS>EPSG:26912</CRS></Layer></Layer></Capability></WMS>"""
    layer = feeds.capability_layers(spark.createDataFrame([(xml,)], "body string")).first()
    assert (layer.name, layer.date, layer.systems, layer.path) == ("d1", "2024-05-06", ["EPSG:3857", "EPSG:26912"], "All")
    city = {"transform": {"scale": [0.5, 0.5, 1], "translate": [10, 0, 0]}, "vertices": [[0, 0, 0], [8, 0, 0], [8, 4, 0], [0, 4, 0], [4, 2, 1]], "CityObjects": {"m1": {"type": "Tree", "geometry": [{"boundaries": [[[0, 1, 2, 3]], [[4, 0, 1]]]}]}}}
    model = feeds.city_models(spark.createDataFrame([(bytearray(json.dumps(city).encode()),)], "content binary")).first()
    assert model.vertices == 5 and len(model.hull) == 4 and (model.length, model.width) == (4.0, 2.0)
    rows = spark.createDataFrame([(json.dumps({"OBJECTID": 7, "When": 0, "Name": "abcdef"}),)], "attributes string")
    got = feeds.attributes(rows, [{"name": "OBJECTID", "type": "esriFieldTypeOID"}, {"name": "When", "type": "esriFieldTypeDate"}, {"name": "Name", "type": "esriFieldTypeString", "length": 3}]).first()
    assert got.OBJECTID_SRC == 7 and got.When.year == 1970 and got.Name == "abc"
    assert feeds.hosted_ids([(0, 0, 1, 1), (0, 0, 2, 2)], lambda e: [3, 1] if e[2] == 1 else [1, 5], lambda e: 2) == [1, 3, 5]
    with pytest.raises(ValueError):
        feeds.hosted_ids([(0, 0, 1, 1)], lambda e: [1], lambda e: 2)
    assert feeds.fetch_features(spark, list(range(7)), lambda ids: [str(i) for i in ids], 3).count() == 7
    add, against = feeds.schema_conflicts([{"name": "a", "type": "int"}, {"name": "b", "type": "text", "length": 5, "values": ["X"]}], [{"name": "A", "type": "text"}, {"name": "b", "type": "text", "length": 9}, {"name": "c", "type": "int"}])
    assert [f["name"] for f in add] == ["c"] and len(against) == 2
    out = feeds.to_template(spark.createDataFrame([(1, "X")], "k long, v string"), [{"name": "id", "type": "long"}, {"name": "code", "type": "string", "values": ["X"]}, {"name": "src", "type": "string"}, {"name": "none", "type": "double"}], {"id": "k", "code": "v"}, {"src": "s"}).first()
    assert tuple(out) == (1, "X", "s", None)


# ---------------------------------------------------------------------- samples


def test_spacing_equals_going_in_turn(spark):
    rng = random.Random(4)
    rows = [(i, rng.random() * 30, rng.random() * 30, rng.randrange(5)) for i in range(250)]
    kept = []
    for i, x, y, _ in sorted(rows, key=lambda r: (r[3], r[0])):
        if all((x - a) ** 2 + (y - b) ** 2 >= 4 for _, a, b in kept):
            kept.append((i, x, y))
    df = spark.createDataFrame(rows, "id long, x double, y double, rank long")
    assert {r.id for r in V.spaced(df, 2.0, ["rank"]).collect()} == {k[0] for k in kept}
    assert V.spaced(df.limit(0), 2.0, ["rank"]).count() == 0


def test_draws_and_orders(spark):
    units = spark.range(200).select("id", (F.col("id") * 1.0).alias("x"), F.lit(0.0).alias("y"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("stratum"), (F.col("id") % 17).alias("priority"))
    one = {r.id for r in V.draw(units, "id", 30, 5).collect()}
    assert len(one) == 30 and one == {r.id for r in V.draw(units.repartition(7), "id", 30, 5).collect()} != {r.id for r in V.draw(units, "id", 30, 6).collect()}
    drawn = V.draw_spaced(units, [("a", 20), ("b", 40)], 3, 2.0).collect()
    xs = sorted(r.x for r in drawn)
    assert sum(r.stratum == "a" for r in drawn) == 20 and min(np.diff(xs)) >= 2
    top = V.priority_sample(units, 11, 1).collect()
    assert sum(r.selection == "TOP" for r in top) == 6 and len(top) == 11 and {r.priority for r in top if r.selection == "TOP"} == {16}
    queues = spark.createDataFrame([("q1", i, i, float(i), 0.0) for i in range(3)] + [("q2", i, 10 + i, float(i), 50.0) for i in range(2)], "queue string, place long, id long, x double, y double")
    order = [r.id for r in V.interleave(queues, ["q1", "q2"]).orderBy("review_order").collect()]
    assert order == [0, 10, 1, 11, 2]
    plots = V.draw_plots(spark, spark.createDataFrame([("T", 0.0, 0.0, 95.0, 61.0)], "tile string, xmin double, ymin double, xmax double, ymax double"), 3, 9).collect()
    assert len({p.plot for p in plots}) == 3 and all(p.x1 <= 90 and p.y1 <= 60 and p.population == 6 for p in plots)
    places = V.random_places(spark.range(9).select(F.lit(0).cast("long").alias("row"), F.col("id").alias("col")), 4, 2, 0.5).collect()
    assert all(abs(p.x - (p.col + 0.5) * 0.5) <= 0.125 for p in places)
    split = V.block_split(units.withColumn("x", F.col("id") * 10.0), 4)
    per = split.groupBy(F.floor(F.col("x") / 50).alias("b")).agg(F.countDistinct("split").alias("n"), F.first("split").alias("s")).collect()
    assert all(p.n == 1 for p in per) and sum(p.s == "VALIDATION" for p in per) == 8
    capped = V.cap_per_band(spark.createDataFrame([("h", i, i in (7, 8)) for i in range(9)], "band string, place long, touched boolean"), 4).collect()
    assert sorted(r.place for r in capped) == [0, 1, 7, 8]
    sites = V.best_sites(units.withColumn("c2", -F.col("priority")), ["priority", "c2"], 5.0).collect()
    assert [s.id for s in sites] == [16, 0]


def test_answers_are_merged_in_turn(spark):
    store = spark.createDataFrame([("i1", "A", None, "ann")], "id string, answer string, note string, reviewer string")
    new = [("i1", "B", None, "bob", 1), ("i1", "C", "why", "ann", 2), ("i2", "", "only a note", "bob", 3), ("i3", "A", "", "bob", 4), ("i3", "", " ", "bob", 5), ("i3", "B", "", "cy", 6)]
    got = {r.id: (r.answer, r.reviewer, r.taken) for r in V.merged_answers(store, spark.createDataFrame(new, "id string, answer string, note string, reviewer string, seq int")).collect()}
    assert got == {"i1": ("C", "ann", 1), "i2": ("", "bob", 1), "i3": ("B", "cy", 3)}


# ----------------------------------------------------------------------- shapes


def test_knn_is_that_of_brute_force():
    rng = np.random.default_rng(6)
    p, q = rng.random((300, 3)) * 9, rng.random((40, 3)) * 9
    d, at = S.knn(p, q, 6, 1.5)
    full = np.sqrt(((q[:, None] - p[None]) ** 2).sum(axis=2))
    for i in range(40):
        best = [j for j in np.argsort(full[i], kind="stable") if full[i, j] <= 1.5][:6]
        assert at[i][at[i] >= 0].tolist() == best and np.allclose(d[i][: len(best)], full[i, best])


def test_faces_and_planes(spark):
    rng = np.random.default_rng(3)
    x, y = rng.random((2, 3000)) * 12
    z = 5 + 0.4 * x - 0.2 * y + rng.normal(0, 0.01, 3000)
    support = spark.createDataFrame([tuple(map(float, r)) for r in zip(x, y, z)], "x double, y double, z double")
    flat = lambda a, b: 5 + 0.4 * a - 0.2 * b
    tops = [(1, 6.0, 6.0, flat(6, 6) + 0.1), (2, 6.0, 6.0, flat(6, 6) + 2.0), (3, 40.0, 40.0, 5.0), (4, 5.0, 7.0, flat(5, 7) - 0.3)]
    got = {r.pid: r for r in S.face_votes(spark.createDataFrame(tops, "pid long, x double, y double, z double"), support, size=25.0).collect()}
    assert got[1].roof and abs(got[1].residual - 0.1) < 0.03 and not got[2].roof and abs(got[2].residual - 2) < 0.05
    assert got[3].support == 0 and got[3].nearest is None and got[4].roof
    cells = support.select(F.lit(1).cast("long").alias("region"), "x", "y", (F.col("z") * 0.3).alias("z"))
    plane = S.region_planes(cells, 0.5).first()
    assert plane.model_ok and abs(plane.a - 0.12) < 0.01 and abs(plane.b + 0.06) < 0.01 and plane.rmse < 0.01


def test_shape_features_and_shares(spark):
    line = [(i, i * 0.2, 0.0, 8.0, True, False) for i in range(40)]
    wall = [(100 + i, 20.0 + (i % 8) * 0.2, 5.0, 1.0 + (i // 8) * 0.2, False, False) for i in range(64)]
    df = spark.createDataFrame(line + wall + [(900, 50.0, 50.0, 1.0, True, True)], "pid long, x double, y double, z double, single boolean, building boolean")
    got = {r.pid: r for r in S.neighbourhood_shapes(df, 16, 5.0, 1.0, size=10.0).collect()}
    assert got[20].linearity > 0.99 and got[20].axis_z < 0.01 and got[130].planarity > 0.5 and got[130].normal_z < 0.01
    assert got[900].linearity is None and got[900].neighbors == 1 and got[900].building_m == 0
    shares = {r.pid: r for r in S.neighbourhood_shares(df.withColumn("group", F.when(F.col("pid") % 2 == 0, "mixed").otherwise("wire")), 16, 5.0, size=10.0).collect()}
    assert shares[20].single_share == 1 and shares[130].single_share == 0 and abs(shares[20].irregular_share - 9 / 17) < 0.07 and shares[900].irregular_share == 1


def test_shift_is_found(spark):
    outline = [(1, r, c) for r in range(20, 40) for c in range(20, 44)]
    roof = [(r + 4, c - 3) for _, r, c in outline]
    got = S.shift_fits(spark.createDataFrame(outline, "id long, row long, col long"), spark.createDataFrame(roof, "row long, col long")).first()
    assert (got.dx, got.dy, got.roof_best, got.edge) == (-0.75, -1.0, 1.0, False) and got.sharp > 0


# ---------------------------------------------------------------------- streams


def test_streams_over_many_batches(spark, tmp_path):
    rows = [(f"2026-01-0{1 + d} 0{h}:30:00", u, t) for d in range(6) for h in range(3) for u in range(2) for t in ("a", "b") if (d + u) % 5]
    for d in range(6):
        day = [r for r in rows if r[0][9] == str(1 + d)]
        spark.createDataFrame(day, "ts string, user_id long, event_type string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    path = str(tmp_path / "in" / "*.parquet")
    counts = windows.hourly_counts(windows.event_stream(spark, path, 1), "10 days")
    want = {}
    for ts, _, t in rows:
        want[ts[:13], t] = want.get((ts[:13], t), 0) + 1
    got = {(r.hour, r.event_type): r.n for r in counts.collect()}
    assert sorted(got.values()) == sorted(want.values()) and len(got) == len(want)
    pairs = windows.distinct_pairs(windows.event_stream(spark, path, 1), "1 day").collect()
    assert sorted((p.user_id, p.event_type) for p in pairs) == [(0, "a"), (0, "b"), (1, "a"), (1, "b")]


# ---------------------------------------------------------------------- rasters


def test_geotiff_round_trip(spark, tmp_path):
    from gridloom.sources import rasters

    rng = np.random.default_rng(1)
    rows = [(int(r), int(c), float(np.float32(rng.random()))) for r in range(13) for c in range(9) if (r + c) % 7]
    df = spark.createDataFrame(rows, "row long, col long, value double")
    assert rasters.write_tiles(df, str(tmp_path / "t"), 100.0, 200.0, 0.5, block=5).agg(F.sum("cells").alias("n")).first().n == len(rows)
    back = rasters.read_tiles(spark, str(tmp_path / "t"), 100.0, 200.0).collect()
    assert sorted((r.row, r.col, r.value) for r in back) == rows
    a, x, y, cell = rasters.decode(rasters.encode(np.array([[1.0, np.nan]]), 5.0, 9.0, 0.25))
    assert (x, y, cell, a[0, 0]) == (5.0, 9.0, 0.25, 1.0) and np.isnan(a[0, 1])
    with pytest.raises(ValueError):
        rasters.decode(b"MM\0*")


def test_command_line(spark, tmp_path, capsys):
    from gridloom.__main__ import main

    main(["list"])
    assert "canopy_cover_by_zone" in capsys.readouterr().out
    main(["sql", "tile_halos"])
    assert "range(3)" in capsys.readouterr().out
    out = str(tmp_path / "tiles")
    main(["tiles", "0", "0", "25", "10", out, "--size", "10", "--overlap", "2"])
    assert spark.read.parquet(out).count() == 3
    with pytest.raises(FileExistsError):
        main(["tiles", "0", "0", "25", "10", out])
