"""Whole runs over a synthetic cloud: tiles, trees, rasters and files."""

import csv
import json
import sqlite3
import struct

import numpy as np
import pytest

from understory.params import Parameters
from understory.plans.run import run
from understory.sinks import geotiff
from understory.sources import las, synthetic

X0, Y0, SIDE = synthetic.CORNER_X, synthetic.CORNER_Y, 54.0


def rolling(x, y):
    return 143 + 1.5 * np.sin((x - X0) / 19) + 1.1 * np.cos((y - Y0) / 26)


@pytest.fixture(scope="module")
def cloud(spark, tmp_path_factory):
    """An orchard of 54 m by 54 m as a LAS file: trees by rows, all trees as one, and the trees under another name."""
    df = synthetic.orchard(spark, 13_000, SIDE - 2 * synthetic.STRIP)
    rows = np.array([tuple(r) for r in df.collect()])
    tree = rows[:, 4]
    path = str(tmp_path_factory.mktemp("cloud") / "cloud.las")
    las.write(path, rows[:, :3], extras={"PredInstance": np.ceil(tree / 7), "PredInstance_SAT": np.minimum(tree, 1), "Crown": tree})
    return path


def polygon(x0, y0, x1, y1):
    return {"type": "Polygon", "coordinates": [[[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]]}


def feature(geometry, role=None):
    return {"type": "Feature", "properties": {} if role is None else {"role": role}, "geometry": geometry}


INCLUDE, EXCLUDE = (X0 + 8, Y0 + 3, X0 + 48, Y0 + 43), (X0 + 30, Y0 + 25, X0 + 40, Y0 + 40)


def write_aoi(path, *features):
    path.write_text(json.dumps({"type": "FeatureCollection", "features": list(features)}))
    return str(path)


def read_csv(path):
    with open(path, newline="") as f:
        return list(csv.DictReader(f))


def rows_of(found, suffix="PredInstance"):
    return read_csv(next(p for p in found["paths"] if p.endswith(f"_{suffix}_results.csv")))


def test_whole_cloud_with_report(spark, cloud, tmp_path):
    found = run(spark, cloud, str(tmp_path), Parameters(dataset_id=7, performance_report=True))
    assert found["tiles"] == 9 and found["points"] == 13_000
    assert found["dimensions"] == ["PredInstance", "PredInstance_SAT"]
    rows = rows_of(found)
    assert [int(r["tile_id"]) for r in rows] == list(range(1, 10))
    assert len(rows[0]) == 34 and rows[0]["sensor"] == "NA" and rows[0]["edge_tile"] in ("TRUE", "FALSE")
    assert sum(int(r["n_seg_total"]) for r in rows) == sum(int(r["n_trees"]) for r in rows) == 9
    assert sum(int(r["n_trees"]) for r in rows_of(found, "PredInstance_SAT")) == 1
    grid, tags = geotiff.read(str(tmp_path / "7_dtm.tif"))
    y, x = np.mgrid[0 : grid.shape[0], 0 : grid.shape[1]]
    west, north = tags[33922][3], tags[33922][4]
    expected = rolling(west + x + 0.5, north - y - 0.5)
    known = np.isfinite(grid)
    assert known.mean() > 0.9 and np.abs(grid - expected)[known].max() < 0.35
    chm, tags = geotiff.read(str(tmp_path / "7_chm.tif"))
    assert tags[33550][0] == 0.5 and 16 < np.nanmax(chm) < 17.2
    assert (tmp_path / "7_tiles.png").read_bytes()[:8] == b"\x89PNG\r\n\x1a\n"
    report = read_csv(tmp_path / "7_performance.csv")[0]
    assert int(report["tile_count"]) == 9 and float(report["total_seconds"]) > 0


def test_inclusion_tiles_match_their_geojson(spark, cloud, tmp_path):
    aoi = write_aoi(tmp_path / "a.geojson", feature(polygon(*INCLUDE)))
    found = run(spark, cloud, str(tmp_path), Parameters(), aoi)
    assert found["tiles"] == 4
    rows = rows_of(found)
    data = json.loads((tmp_path / "1_PredInstance_tiles.geojson").read_text())["features"]
    for row, f in zip(rows, data, strict=True):
        for k, v in row.items():
            have = f["properties"][k]
            assert have is None if v == "NA" else str(have).upper() == v if v in ("TRUE", "FALSE") else have == v or abs(float(v) - have) < 1e-9
    assert not (tmp_path / "1_performance.csv").exists()
    assert 4 < float(rows[0]["rumple"]) < 12


def test_exclusion_and_geopackage(spark, tmp_path):
    from understory.operators import grid
    from understory.plans.run import footprint, tiles_for

    extent = (X0, Y0, X0 + 54, Y0 + 54)
    aoi = write_aoi(tmp_path / "a.geojson", feature(polygon(*INCLUDE), " Inclusion"), feature(polygon(*EXCLUDE), "EXCLUDE"))
    assert tiles_for(spark, footprint(aoi, extent), Parameters()).count() == 3
    path = tmp_path / "a.gpkg"
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
        for layer, box in (("include", INCLUDE), ("exclude", EXCLUDE)):
            ring = polygon(*box)["coordinates"][0]
            wkb = struct.pack("<BIII", 1, 3, 1, len(ring)) + b"".join(struct.pack("<2d", *p) for p in ring)
            db.execute(f"CREATE TABLE {layer} (fid INTEGER, geom BLOB)")
            db.execute(f"INSERT INTO {layer} VALUES (1, ?)", (b"GP\0\1" + struct.pack("<i", 32632) + wkb,))
            db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom')", (layer,))
    found = footprint(str(path), extent)
    assert tiles_for(spark, found, Parameters()).count() == 3
    none = write_aoi(tmp_path / "z.geojson", feature(polygon(X0 + 5, Y0 + 5, X0 + 15, Y0 + 15)))
    assert tiles_for(spark, footprint(none, extent), Parameters()).count() == 0
    triangle = {"type": "Polygon", "coordinates": [[[X0, Y0], [X0 + 50, Y0], [X0, Y0 + 50], [X0, Y0]]]}
    tiles = tiles_for(spark, footprint(write_aoi(tmp_path / "t.geojson", feature(triangle)), extent), Parameters(grid_search_step=5.0))
    assert tiles.count() == 1
    assert grid.edge_flags(tiles, 20.0).first()["edge_tile"]


def test_zero_tiles_write_empty_tables(spark, cloud, tmp_path):
    aoi = write_aoi(tmp_path / "z.geojson", feature(polygon(X0 + 5, Y0 + 5, X0 + 15, Y0 + 15)))
    found = run(spark, cloud, str(tmp_path), Parameters(instance_dimensions=("Missing", "Crown", "PredInstance", "Crown")), aoi)
    assert found["tiles"] == 0 and found["dimensions"] == ["Crown", "PredInstance"]
    assert rows_of(found) == []
    assert json.loads((tmp_path / "1_Crown_tiles.geojson").read_text()) == {"type": "FeatureCollection", "features": []}
    assert len(read_csv(tmp_path / "1_PredInstance_segment_diagnostics.csv")) == 9


def test_without_segments_tree_columns_are_null(spark, tmp_path):
    rng = np.random.default_rng(1)
    gx, gy = np.meshgrid(np.arange(21.0), np.arange(21.0))
    points = [(float(x), float(y), 0.0, 2) for x, y in zip(gx.ravel(), gy.ravel(), strict=True)] + [(float(x), float(y), float(z), 1) for x, y, z in rng.uniform(1, 19, (400, 3))]
    df = spark.createDataFrame(points, "x double, y double, z double, classification int")
    found = run(spark, df, str(tmp_path), Parameters())
    rows = read_csv(tmp_path / "1_results.csv")
    assert found["tiles"] == 1 and rows[0]["n_trees"] == "NA" and rows[0]["n_seg_total"] == "NA" and int(rows[0]["vox_filled"]) > 0


@pytest.mark.parametrize(
    ("geometry", "role", "message"),
    [
        ({"type": "Point", "coordinates": [0, 0]}, "include", "must contain only Polygon or MultiPolygon"),
        (polygon(0, 0, 40, 40), "include", "does not overlap"),
        (polygon(*INCLUDE), "other", "unknown AOI role"),
    ],
)
def test_bad_footprints(tmp_path, geometry, role, message):
    from understory.plans.run import footprint

    aoi = write_aoi(tmp_path / "a.geojson", feature(geometry, role))
    with pytest.raises(ValueError, match=message):
        footprint(aoi, (X0, Y0, X0 + 50, Y0 + 50))


def test_folder_must_be_writable(spark, tmp_path):
    df = spark.createDataFrame([(0.0, 0.0, 0.0), (1.0, 1.0, 1.0)], "x double, y double, z double")
    with pytest.raises(ValueError, match="cannot be written"):
        run(spark, df, str(tmp_path / "missing"), Parameters())


def test_two_runs_are_the_same(spark, tmp_path):
    from understory.plans import compare

    folders = []
    df = synthetic.orchard(spark, 6000, 40.0).persist()
    box = synthetic.aoi_box(40.0)
    for i in range(2):
        (tmp_path / str(i)).mkdir()
        aoi = write_aoi(tmp_path / "a.geojson", feature(polygon(*box)))
        run(spark, df.repartition(3 + i), str(tmp_path / str(i)), Parameters(performance_report=True), aoi)
        folders.append(str(tmp_path / str(i)))
    assert compare.csv_differences(f"{folders[0]}/1_PredInstance_results.csv", f"{folders[1]}/1_PredInstance_results.csv") == []
    assert compare.same_raster(f"{folders[0]}/1_dtm.tif", f"{folders[1]}/1_dtm.tif")
    assert set(compare.different_files(*folders)) <= {"1_dtm.tif"}
    rows = read_csv(f"{folders[0]}/1_PredInstance_results.csv")
    assert len(rows) == 4 and all(int(r["n_seg_total"]) > 4 for r in rows)


def test_differences_of_relations(spark):
    from understory.plans import compare

    a = spark.createDataFrame([(1, 1.0, "x"), (2, None, "y"), (3, 5.0, "z")], "k int, v double, s string")
    b = spark.createDataFrame([(1, 1.0 + 1e-12, "x"), (2, None, "w"), (4, 5.0, "z")], "k int, v double, s string")
    got = sorted((r["k"], r["column"]) for r in compare.differences(a, b, ["k"]).collect())
    assert got == [(2, "s"), (3, "s"), (3, "v"), (4, "s"), (4, "v")]
