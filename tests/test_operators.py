"""Edges of single operators: ties, bounds, nulls, degenerate groups."""

import importlib.util
import math
import sys
import types
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from understory.functions.aggregates import arg_max, gini
from understory.functions.scalars import bucket, in_cells, layer_bin, safe_round, safe_xy_scale
from understory.operators import grid, segments, terrain, voxels
from understory.operators.delaunay import interpolate, triangulate
from understory.params import Parameters, artifacts, check_input, check_point_count, column_selection, select_dimensions, split_names
from understory.sources import las

P = Parameters()


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize(
    "change", [{"dataset_id": 0}, {"tile_size": 0}, {"threads": -1}, {"catalog_workers": 0}, {"grid_search_step": 21}, {"minimum_tree_voxels": 0}, {"maximum_height": 0.5}, {"voxel_resolution": float("nan")}, {"dtm_buffer": 0}]
)
def test_parameters_are_checked(change):
    with pytest.raises(ValueError):
        Parameters(**change)


def test_parameter_helpers(tmp_path):
    assert P.voxel_total == 3_475_000 and P.box_factors == [1, 2, 4, 8, 16, 32, 64]
    assert split_names(" a, b,,a ") == ("a", "b")
    assert select_dimensions(["z", "b", "a", "b"], ["a", "b", "c"]) == ["b", "a"]
    names = [f"e{i}" for i in range(1, 11)]
    assert [column_selection(x, names) for x in (["e10"], ["e1"], ["none"], ["e2", "e1"])] == ["xyzrn0", "xyzrn1", "xyzrn", "xyzrn12"]
    assert artifacts("/o", 5, "a b/c")["results"] == "/o/5_a_b_c_results.csv"
    with pytest.raises(ValueError, match="unsupported point count"):
        check_point_count(2**31, 2**31 - 1)
    for path in ("/nowhere.las", str(tmp_path), str(tmp_path / "x.txt")):
        with pytest.raises(ValueError):
            check_input(path)


def test_cells_round_down_and_layers_close_above(spark):
    df = spark.createDataFrame([(-0.1,), (0.0,), (0.2,), (1.0,), (1.01,), (70.0,)], "v double")
    assert [r[0] for r in df.select(in_cells(F.col("v"), 0.2)).collect()][:2] == [-1, 0]
    assert [r[0] for r in df.select(layer_bin(F.col("v"))).collect()] == [0, 0, 0, 0, 1, 69]
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.00005,), (None,)], "v double")
    assert [r[0] for r in odd.select(safe_round(F.col("v"))).collect()] == [None, None, 1.0, None]
    assert df.select(bucket(F.lit(64.0)), bucket(F.lit(65.0))).first() == (1, 2)
    assert df.select(safe_xy_scale(F.lit(5733149.0))).first()[0] == 0.01


@pytest.mark.parametrize(("numbers", "expected"), [([], None), ([3.0], None), ([0.0, 0.0], 0.0), ([1.0, 3.0], 0.5), ([-1.0, 1.0], 1.0), ([2.0, 2.0, 2.0], 0.0), ([None, 1.0, 3.0], 0.5)])
def test_gini(spark, numbers, expected):
    df = spark.createDataFrame([(1, v) for v in numbers], "k int, v double")
    rows = gini(df, ["k"], "v", "g").collect()
    assert (rows[0]["g"] if rows else None) == (None if expected is None else pytest.approx(expected))


def test_arg_max_takes_least_ties(spark):
    df = spark.createDataFrame([(1, 5.0, 2, 0.0), (1, 5.0, 1, 9.0), (1, 4.0, 0, 1.0)], "k int, h double, pid long, x double")
    assert arg_max(df, ["k"], "h", ["pid"], {"x": "top"}).first()["top"] == 9.0


def test_tiles_are_half_open(spark):
    tiles = grid.covering(spark, (0.0, 0.0, 40.0, 40.0), 20.0)
    points = spark.createDataFrame([(1, 20.0, 20.0), (2, 0.0, 0.0), (3, 40.0, 5.0), (4, 19.999999, 20.0), (5, -0.1, 1.0)], "id int, x double, y double")
    assert values(grid.lattice_join(points, tiles, how="left"), "id", "tile_id") == [(1, 4), (2, 1), (3, None), (4, 3), (5, None)]
    none = grid.lattice_join(points, tiles.limit(0), how="left")
    assert none.where("tile_id IS NULL").count() == 5
    assert grid.lattice_join(points, tiles.limit(0)).count() == 0


def test_edge_flags_on_and_off_the_lattice(spark):
    for corner, inner in ((412346.0, 9), (412340.0, 0)):
        tiles = grid.covering(spark, (corner, 5733140.0 + corner % 20, corner + 100, 5733240.0 + corner % 20), 20.0)
        assert grid.edge_flags(tiles, 20.0).where("NOT edge_tile").count() == inner


def test_moments_without_variance(spark):
    rows = [(1, 0.1, 0.1, 5.0), (2, 0.1, 0.1, 5.0), (2, 3.0, 3.0, 5.0), (3, 0.1, 0.1, 0.31)]
    points = spark.createDataFrame(rows, "tile_id int, x double, y double, h double")
    vox = voxels.tile_voxels(points, 0.2)
    got = {r["tile_id"]: r for r in voxels.height_moments(vox, P).collect()}
    assert got[1]["zsd"] is None and got[2]["zsd"] == 0 and got[2]["zskew"] is None and got[2]["zkurt"] is None and 3 not in got
    whole = {r["tile_id"]: r for r in voxels.tile_metrics(points, P).collect()}
    assert whole[3]["vox_filled"] == 0 and whole[3]["height_max"] == pytest.approx(0.4) and whole[3]["zq90"] is None and whole[3]["gap_fraction"] == 1.0
    odd = spark.createDataFrame([(1, 0.0, 0.0, v) for v in (float("nan"), float("inf"), -0.1, 70.0, 70.1, 0.0)], "tile_id int, x double, y double, h double")
    assert values(voxels.within_heights(odd, 70.0), "h") == [(0.0,), (70.0,)]


def test_flat_canopy_has_a_rumple_of_one(spark):
    cells = spark.createDataFrame([(1, i, j, 4.0) for i in range(3) for j in range(3)], "tile_id int, cx long, cy long, top double")
    assert voxels.rumple(cells, P).first()["rumple"] == pytest.approx(1.0)
    sloped = cells.withColumn("top", F.col("cx") * 0.5)
    assert voxels.rumple(sloped, P).first()["rumple"] == pytest.approx(math.sqrt(2))


def test_extents_equal_numpy(spark):
    rng = np.random.default_rng(3)
    cells = np.unique(np.rint(rng.normal(0, (30, 10, 4), (400, 3))).astype(int), axis=0)
    rows = [("d", 1.0, *map(int, c)) for c in cells] + [("d", 2.0, 0, 0, 0), ("d", 2.0, 1, 0, 0)] + [("d", 3.0, i, 0, 0) for i in range(5)]
    df = spark.createDataFrame(rows, "instance_dimension string, instance_id double, voxel_x long, voxel_y long, voxel_z long")
    got = {r["instance_id"]: [r[f"pca_extent_{i}"] for i in (1, 2, 3)] for r in segments.extents(df, P).collect()}
    xyz = cells * 0.2 - (cells * 0.2).mean(axis=0)
    _, vectors = np.linalg.eigh(np.cov(xyz.T))
    assert got[1.0] == pytest.approx(list(np.ptp(xyz @ vectors, axis=0)[::-1]))
    assert got[2.0] == [None] * 3
    assert got[3.0] == pytest.approx([0.8, 0, 0], abs=1e-9)


def test_gates_and_reasons(spark):
    df = spark.createDataFrame([(100, 3.0, 0.5, 3), (99, 3.1, None, 2), (100, 3.1, 0.5, 3)], "n_vox int, apex_z double, pca_extent_3 double, n_occupied_layers int")
    assert [(r["is_tree"], r["fail_reason"]) for r in segments.gated(df, P).collect()] == [(False, "apex "), (False, "voxels thickness layers "), (True, "")]


def test_segments_need_finite_positive_ids(spark):
    df = spark.createDataFrame([(v, 1.0) for v in (float("nan"), float("inf"), 0.0, -1.0, 4.0)], "instance_id double, h double")
    assert values(segments.valid(df, P), "instance_id") == [(4.0,)]


def test_heights_over_a_plane(spark):
    raster = spark.createDataFrame([(i, j, 10 + 0.5 * (i + 0.5) + 0.25 * (j + 0.5)) for i in range(6) for j in range(6)], "col long, row long, value double")
    points = spark.createDataFrame([(1, 2.3, 2.9, 20.0), (1, 2.3, 2.9, 20.0), (2, 50.0, 2.0, 20.0)], "pid int, x double, y double, z double")
    rows = terrain.normalize_bilinear(points, raster, 0.0, 0.0, 1.0).collect()
    assert [r["h"] for r in rows] == pytest.approx([20 - (10 + 0.5 * 2.3 + 0.25 * 2.9)] * 2)
    assert terrain.normalize_nearest(points, raster, 0.0, 0.0, 1.0).first()["h"] == pytest.approx(20 - (10 + 1.25 + 0.625))


def test_bounds_snap_and_cover(spark):
    df = spark.createDataFrame([(0.9999999999, 0.0, 3.0000000001, 0.0)], "xmin double, ymin double, xmax double, ymax double")
    r = terrain.snapped_bounds(df, 1.0).first()
    assert (r["gx0"], r["gx1"], r["gy0"], r["gy1"]) == (1.0, 3.0, 0.0, 1.0)
    assert terrain.covers((0, 0, 10, 10), (0.0, -1e-10, 10, 10), 1.0) and not terrain.covers((0, 0, 10, 10), (-0.01, 0, 10, 10), 1.0)


def test_degenerate_chunks(spark):
    rows = [(1, 0.0, 0.0), (1, 1.0, 1.0), (1, 2.0, 2.0), (2, 0.0, 0.0), (2, 1.0, 0.0), (2, 0.0, 1.0), (3, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k int, x double, y double")
    assert values(terrain.nondegenerate(df, ["k"]), "k", "usable") == [(1, False), (2, True), (3, False)]


def test_triangulation_is_delaunay():
    points = np.random.default_rng(2).uniform(0, 10, (60, 2))
    triangles = triangulate(points)
    for t in triangles:
        a, b, c = points[t]
        d = 2 * ((b - a)[0] * (c - a)[1] - (b - a)[1] * (c - a)[0])
        u = np.array([(c - a)[1] * ((b - a) ** 2).sum() - (b - a)[1] * ((c - a) ** 2).sum(), (b - a)[0] * ((c - a) ** 2).sum() - (c - a)[0] * ((b - a) ** 2).sum()]) / d
        inside = ((points - a - u) ** 2).sum(axis=1) < (u**2).sum() - 1e-9
        assert not np.delete(inside, t).any()
    z = points @ [0.3, -0.2] + 1
    at = np.random.default_rng(4).uniform(3, 7, (50, 2))
    got, found = interpolate(np.column_stack([points, z]), triangles, at)
    assert (found >= 0).all() and np.allclose(got, at @ [0.3, -0.2] + 1)
    assert len(triangulate(np.array([[0, 0], [1, 1], [2, 2]]))) == 0 and len(triangulate(points[:2])) == 0


def test_las_round_trip(spark, tmp_path):
    xyz = np.round(np.random.default_rng(1).uniform(0, 100, (2500, 3)), 3)
    for version, name in (((1, 4), "a.las"), ((1, 2), "b.las")):
        path = str(tmp_path / name)
        las.write(path, xyz, np.full(2500, 2), {"Tree": np.arange(2500.0)}, version=version)
        las.register(spark)
        df = spark.read.format("las").load(path)
        assert df.columns == ["x", "y", "z", "return_number", "number_of_returns", "classification", "Tree"]
        got = np.array([tuple(r) for r in df.orderBy("Tree").select("x", "y", "z").collect()])
        assert np.allclose(got, xyz, atol=6e-4)
        assert df.select("classification", "return_number", "number_of_returns").distinct().collect() == [(2, 1, 1)]
        assert las.read_header(path).count == 2500 and las.extent(path)[2] == pytest.approx(xyz[:, 0].max())
        assert spark.read.format("las").option("columns", "z").load(path).columns == ["z"]
    (tmp_path / "c.las").write_bytes(b"nothing")
    with pytest.raises(ValueError, match="not a LAS"):
        las.read_header(str(tmp_path / "c.las"))


def test_stream_of_batches_equals_the_whole(spark, sf_dir, tmp_path):
    from understory.plans import registry, virtual
    from understory.streaming.ingest import SegmentIngest

    long = virtual.long_points(spark, sf_dir)
    for i in range(3):
        long.where(F.col("pid") % 3 == i).coalesce(1).write.parquet(str(tmp_path / "in" / f"part{i}"))
    ingest = SegmentIngest(str(tmp_path / "state"), P)
    stream = spark.readStream.schema(long.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    ingest.start(stream, str(tmp_path / "checkpoint")).awaitTermination(120)
    ingest.add(long.where("pid % 3 = 0"), 99)  # a batch that comes twice changes nothing
    got, want = virtual.rounded(ingest.segments(spark)), registry.queries()["partial_final_segments"](spark, sf_dir)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_cli_checks_its_options(tmp_path, capsys):
    from understory.cli import main, parse

    path = str(tmp_path / "p.parquet")
    open(path, "w").close()
    _, p = parse(["--point_cloud", path, "--output-dir", ".", "--dataset-id", "3", "--instance-dimension", "a,b", "--instance_dimension", "a", "--tile-size", "10"])
    assert p.instance_dimensions == ("a", "b") and p.tile_size == 10
    assert main(["--point-cloud", "/missing.las", "--output-dir", ".", "--dataset-id", "3"]) == 1
    assert "does not exist" in capsys.readouterr().err


def test_usable_area_of_touching_and_overlapping_polygons():
    from understory import geometry as g

    square = lambda *box: g.rectangle(box)
    assert g.usable_area([square(0, 0, 20, 10), square(0, 10, 20, 20)]) == pytest.approx(400)
    assert g.usable_area([square(0, 0, 20, 12), square(0, 8, 20, 20)], [square(5, 5, 10, 30)]) == pytest.approx(400 - 75)
    assert g.complete((0, 0, 20, 20), [square(0, 0, 20, 10), square(0, 10, 20, 20)]) and not g.complete((0, 0, 20, 20), [square(0, 0, 20, 10), square(0, 10.5, 20, 20)])
    triangle = [[(0.0, 0.0), (8.0, 0.0), (0.0, 8.0), (0.0, 0.0)]]
    assert g.usable_area([triangle], [], (0, 0, 4, 4)) == pytest.approx(16) and g.usable_area([triangle], [], (0, 0, 5, 5)) == pytest.approx(23) and g.usable_area([triangle], [triangle]) == pytest.approx(0)
    bow = [[(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)]]
    assert g.usable_area([bow]) == pytest.approx(8)
    ring = [g.rectangle((0, 0, 10, 10))[0], g.rectangle((2, 2, 4, 4))[0]]
    assert g.usable_area([ring]) == pytest.approx(96) and not g.rectangles_apart([square(0, 0, 1, 1), square(1, 0, 2, 1)])
    with pytest.raises(ValueError, match="empty without"):
        g.usable([square(0, 0, 2, 2), square(2, 0, 4, 2)], [square(-1, -1, 5, 5)])


def test_tiles_over_touching_inclusions(spark):
    from understory import geometry as g

    halves = [g.rectangle((0.0, 0.0, 40.0, 10.0)), g.rectangle((0.0, 10.0, 40.0, 40.0))]
    whole = values(grid.optimized(spark, [(0.0, 0.0, 40.0, 40.0)], 20.0, 5.0), "tile_id", "xmin", "ymin")
    assert values(grid.optimized_in_polygons(spark, halves, 20.0, 5.0), "tile_id", "xmin", "ymin") == whole and len(whole) == 4
    moved = [g.rectangle((3.0, 1.0, 45.0, 21.0)), g.rectangle((3.0, 21.0, 45.0, 43.0))]
    bars = [(20.0, 30.0, 24.0, 36.0)]
    want = values(grid.optimized(spark, [(3.0, 1.0, 45.0, 43.0)], 20.0, 1.0, bars), "tile_id", "xmin", "ymin")
    assert values(grid.optimized_in_polygons(spark, moved, 20.0, 1.0, [g.rectangle(b) for b in bars]), "tile_id", "xmin", "ymin") == want
    assert grid.optimized_in_polygons(spark, [g.rectangle((0.0, 0.0, 9.0, 9.0))], 20.0, 5.0).count() == 0


@pytest.mark.parametrize("big", [False, True])
def test_geotiff_round_trip(spark, tmp_path, big):
    from understory.sinks import geotiff

    cells = [(c, r, c + 100.0 * r) for c in range(7) for r in range(50) if (c + r) % 3 and not 16 <= r < 34]
    geotiff.write(spark.createDataFrame([*cells, (9, 1, 5.0), (-1, 0, 5.0)], "col long, row long, value double"), str(tmp_path / "a.tif"), 10.0, 20.0, 0.5, 7, 50, 32633, big=big)
    got, tags = geotiff.read(str(tmp_path / "a.tif"))
    want = np.full((50, 7), np.nan)
    for c, r, v in cells:
        want[49 - r, c] = v
    assert np.array_equal(got, want, equal_nan=True) and tags[33922][3:5] == (10.0, 45.0) and tags[34735][-1] == 32633
    assert (tmp_path / "a.tif").read_bytes()[2] == (43 if big else 42)


def test_las_files_name_their_coordinate_system(tmp_path):
    from understory.sources.points import epsg_of

    path, xyz = str(tmp_path / "a.las"), np.random.default_rng(1).uniform(0, 9, (20, 3))
    for version in ((1, 4), (1, 2)):
        las.write(path, xyz, extras={"Tree": np.ones(20)}, version=version, epsg=25833)
        assert epsg_of(path) == 25833 and las.read_header(path).extras[0][0] == "Tree"
    las.write(path, xyz)
    assert epsg_of(path) is None and epsg_of("a.parquet") is None
    assert las._epsg(2112, b'PROJCS["x",GEOGCS["y",AUTHORITY["EPSG","4258"]],AUTHORITY["EPSG","25832"]]') == 25832


def test_triangulation_of_lattices_and_equal_points():
    lattice = np.stack(np.meshgrid(np.arange(30.0), np.arange(20.0)), -1).reshape(-1, 2)
    for points, area in ((lattice, 29 * 19), (np.vstack([lattice, lattice]), 29 * 19), (lattice[::-1] * 0.1 + 4e5, 29 * 19 * 0.01)):
        t = triangulate(points)
        a, b, c = (points[t[:, i]] for i in range(3))
        parts = ((b - a)[:, 0] * (c - a)[:, 1] - (b - a)[:, 1] * (c - a)[:, 0]) / 2
        assert (parts > 0).all() and parts.sum() == pytest.approx(area)


def test_ground_leaves_vegetation_out():
    rng = np.random.default_rng(4)
    xy = rng.uniform(0, 60, (8000, 2))
    ground = np.arange(8000) % 2 == 0
    z = 100 + 0.05 * xy[:, 0] + np.sin(xy[:, 1] / 9) + np.where(ground, 0, rng.uniform(0.6, 12, 8000))
    got = terrain._ground_points(np.column_stack([xy, z]), 20.0, 30.0, 1.0)
    assert got[ground].mean() > 0.99 and got[~ground].mean() < 0.02


def test_heights_by_window_count_late_points_until_the_watermark(spark, tmp_path):
    from understory.streaming.ingest import heights_by_window

    rows = [("2024-05-01 10:01:00", 2.0), ("2024-05-01 10:04:59", 4.0), ("2024-05-01 10:07:00", 8.0), ("2024-05-01 12:00:00", 1.0)]
    late = [("2024-05-01 10:02:00", 99.0), ("2024-05-01 11:58:00", 3.0)]
    schema = "t string, h double"
    for i, part in enumerate((rows, late)):
        spark.createDataFrame(part, schema).coalesce(1).selectExpr("cast(t AS timestamp) AS t", "h").write.parquet(str(tmp_path / "in" / f"p{i}"))
    stream = spark.readStream.schema("t timestamp, h double").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    query = heights_by_window(stream, "t").writeStream.outputMode("update").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {str(r["start"])[11:16]: (r["n"], r["height_max"]) for r in spark.sql("SELECT window.start, max(n) AS n, max(height_max) AS height_max FROM windows GROUP BY 1").collect()}
    assert got["10:05"] == (1, 8.0) and got["11:55"] == (1, 3.0) and got["12:00"] == (1, 1.0) and got["10:00"][0] in (2, 3)


def test_only_named_columns_are_read(spark, tmp_path):
    from understory.sources import points

    path = str(tmp_path / "a.las")
    las.write(path, np.random.default_rng(2).uniform(0, 9, (30, 3)), extras={"Tree": np.ones(30), "Other": np.zeros(30)})
    assert points.read(spark, path, ["x", "Tree"]).columns == ["x", "Tree"] and points.read(spark, path).count() == 30
    points.read(spark, path).write.parquet(str(tmp_path / "a.parquet"))
    assert points.read(spark, str(tmp_path / "a.parquet"), ["z"]).columns == ["z"]


def test_compressed_records_come_through_a_decoder(tmp_path, monkeypatch):
    """The decoder's part is played by a stand-in that unpacks zlib."""
    xyz = np.random.default_rng(7).uniform(0, 50, (2500, 3))
    path, packed = str(tmp_path / "a.las"), str(tmp_path / "a.laz")
    las.write(path, xyz, extras={"Tree": np.arange(2500.0)})
    h, data = las.read_header(path), bytearray((tmp_path / "a.las").read_bytes())
    data[104] |= 0x80
    (tmp_path / "a.laz").write_bytes(data[: h.offset] + zlib.compress(data[h.offset :]))

    class Decoder:
        def __init__(self, file):
            self.records = np.frombuffer(zlib.decompress(open(file, "rb").read()[h.offset :]), f"V{h.size}")

        __enter__ = lambda self: self
        __exit__ = lambda self, *_: None

        def seek(self, at):
            self.records = self.records[at:]

        def read_points(self, n):
            taken, self.records = self.records[:n], self.records[n:]
            return types.SimpleNamespace(array=taken)

    monkeypatch.setattr(las, "BATCH_RECORDS", 700)
    assert las.read_header(packed).compressed and not h.compressed
    if not importlib.util.find_spec("laspy"):
        with pytest.raises(ValueError, match="laspy"):
            las._Reader(packed, ["x"])
    monkeypatch.setattr(las.importlib.util, "find_spec", lambda name: True)
    monkeypatch.setitem(sys.modules, "laspy", types.SimpleNamespace(open=Decoder))
    columns = ["x", "z", "Tree"]
    for part in (las._Range(0, 2500), las._Range(900, 1401)):
        read = [[b.to_pylist() for b in las._Reader(p, columns).read(part)] for p in (path, packed)]
        assert read[0] == read[1] and sum(map(len, read[0])) == part.count
    with pytest.raises(ValueError, match="ends before"):
        list(las._Reader(packed, columns).read(las._Range(2000, 600)))


def test_ground_of_a_chunk_takes_only_lowest_points_together(spark, monkeypatch):
    """The classes are those of a chunk at hand as a whole, but no task gets more of it than the lowest points of small cells."""
    rng = np.random.default_rng(6)
    xyz = np.column_stack([rng.uniform(0, 60, (9000, 2)), np.zeros(9000)])
    xyz[:, 2] = 100 + 0.05 * xyz[:, 0] + np.sin(xyz[:, 1] / 9) + np.where(np.arange(9000) % 2 == 0, rng.uniform(0, 0.3, 9000), rng.uniform(0.6, 12, 9000))
    xyz[17] = xyz[16]
    df = spark.createDataFrame([(0, 0, i, *map(float, r)) for i, r in enumerate(xyz)], "chunk_x long, chunk_y long, i int, x double, y double, z double")
    dealt = []
    deal = terrain._dealt
    monkeypatch.setattr(terrain, "_dealt", lambda points, keys: dealt.append(points.count()) or deal(points, keys))
    found = terrain.classify_ground(df)
    assert found.columns == [*df.columns, "classification"]
    got = {r["i"]: r["classification"] == 2 for r in found.collect()}
    want = terrain._ground_points(xyz, 20.0, 30.0, 1.0)
    assert [got[i] for i in range(9000)] == want.tolist() and 0 < want.sum() < 9000
    assert dealt and max(dealt) <= 60 * 60
    few = terrain.classify_ground(df.where("i < 2"))
    assert [r["classification"] for r in few.collect()] == [1, 1]


def test_places_are_interpolated_in_all_points_triangles_but_few_are_triangulated(monkeypatch):
    from understory.operators import delaunay

    rng = np.random.default_rng(3)
    xy = rng.uniform(0, 30, (12000, 2))
    xy = xy[(np.hypot(*(xy - 12).T) > 7) | (rng.uniform(size=len(xy)) < 0.01)] + [4e5, 5.7e6]
    xyz = np.column_stack([xy, 5 * np.sin(xy[:, 0] / 7) + np.cos(xy[:, 1]) + rng.uniform(0, 0.1, len(xy))])
    at = np.stack(np.meshgrid(np.arange(-1, 31, 3.0), np.arange(-1, 31, 3.0)), -1).reshape(-1, 2) + [4e5, 5.7e6]
    value, t = interpolate(xyz, triangulate(xy), at)
    sizes = []
    monkeypatch.setattr(delaunay, "triangulate", lambda p: sizes.append(len(p)) or triangulate(p))
    got, found = delaunay.interpolated(xyz, at, 1000)
    assert (found == (t >= 0)).all() and 0 < found.sum() < len(at)
    assert got[found] == pytest.approx(value[found], abs=1e-9)
    assert max(sizes) < len(xy) / 3


def test_terrain_gathers_ground_points_only(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(*map(float, rng.uniform(0, 60, 2)), float(z)) for z in [*np.zeros(4000), *rng.uniform(2, 20, 20000)]]
    dealt = []
    deal = terrain._dealt
    monkeypatch.setattr(terrain, "_dealt", lambda points, keys: dealt.append(points.count()) or deal(points, keys))
    cells = terrain.terrain(spark.createDataFrame(rows, "x double, y double, z double"), 0.0, 0.0).collect()
    assert len({(r["col"], r["row"]) for r in cells}) == len(cells) > 3400
    assert all(abs(r["value"]) < 0.5 for r in cells if 1 < r["col"] < 58 and 1 < r["row"] < 58)
    assert dealt and max(dealt) < 24000


def test_extents_of_equal_variances_are_along_the_axes(spark):
    """Full boxes, as dense clouds make them, have no principal axes of their own; the order of rows must not make any."""
    cells = F.col("id") % 35, F.floor(F.col("id") / 35) % 35, F.floor(F.col("id") / 1225)
    boxes = None
    for k, (height, x) in enumerate(((21, 2061685), (36, 2061790), (35, 2061720))):
        c = cells if k < 2 else (cells[2], cells[0], cells[1])
        box = spark.range(1225 * height).select(F.lit("a").alias("instance_dimension"), F.lit(float(k)).alias("instance_id"), *((v + o).alias(f"voxel_{n}") for v, o, n in zip(c, (x, 28665745, 0), "xyz", strict=True)))
        boxes = box if boxes is None else boxes.unionByName(box)
    turned = [(t, t, t) for t in range(11)] + [(5 + a, 5 + b, 5 + c) for a, b, c in ((3, -3, 0), (-3, 3, 0), (3, 0, -3), (-3, 0, 3), (0, 3, -3), (0, -3, 3))]
    boxes = boxes.unionByName(spark.createDataFrame([("a", 3.0, *map(int, v)) for v in turned] + [("a", 4.0, 1, 2, t) for t in range(4)], boxes.schema))
    want = {0.0: [6.8, 6.8, 4.0], 1.0: [7.0, 6.8, 6.8], 2.0: [6.8, 6.8, 6.8], 3.0: [2 * 3**0.5, 1.2 * 2**0.5, 3.6 / 6**0.5], 4.0: [0.6, 0.0, 0.0]}
    seen = set()
    for seed in range(3):
        rows = segments.extents(boxes.repartition(7).orderBy(F.rand(seed)), P).collect()
        for r in rows:
            assert [r[f"pca_extent_{i}"] for i in (1, 2, 3)] == pytest.approx(want[r["instance_id"]], abs=1e-9)
        seen.add(tuple(sorted(map(tuple, rows))))
    assert len(seen) == 1


def test_diagnostics_of_full_boxes_have_the_boxes_sides(spark):
    from understory.operators import results

    at = [F.col("id") % 35, F.floor(F.col("id") / 35) % 35, F.floor(F.col("id") / 1225) % 21]
    tree = F.floor(F.col("id") / 25725)
    x, y, h = (F.lit(o) + (c + F.lit(0.5)) * 0.2 for o, c in zip((412337.0, 5733149.0, 0.0), at, strict=True))
    rows = spark.range(25725 * 6).select(F.col("id").alias("pid"), (x + tree * 7).alias("x"), (y + tree * 14).alias("y"), h.alias("h"), F.lit("PredInstance").alias("instance_dimension"), (tree + 1).cast("double").alias("instance_id"))
    table = segments.segment_table(rows.repartition(9), P).withColumn("tile_id", F.lit(None).cast("int"))
    found = results.segment_diagnostics(table, "a").collect()
    assert [(r["pc_ext1"], r["pc_ext2"], r["pc_ext3"], r["n_vox"], r["is_tree"]) for r in found] == [(6.8, 6.8, 4.0, 25725, True)] * 6
