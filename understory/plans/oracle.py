"""DuckDB SQL of the queries, over the same tables."""

from __future__ import annotations

from understory.operators.terrain import FLAT
from understory.plans.virtual import AOI, EXCLUSION, WIDE_AOI, P

_D = lambda v: f"CAST({v!r} AS DOUBLE)"
R, TILE, CHM, MAXIMUM, GREEN = _D(P.voxel_resolution), _D(P.tile_size), _D(P.chm_resolution), _D(P.maximum_height), _D(P.vegetation_minimum_height)

CLOUD = """
pts0 AS (SELECT l_orderkey * 10 + l_linenumber AS pid, (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 60000 AS hx,
  (l_orderkey * 6101 + l_partkey * 15485 + l_suppkey * 13) % 60000 AS hy, l_quantity, l_discount FROM lineitem),
pts1 AS (SELECT *, CAST(412337 AS DOUBLE) + hx / CAST(1000 AS DOUBLE) AS x, CAST(5733149 AS DOUBLE) + hy / CAST(1000 AS DOUBLE) AS y, hx // 7000 AS sx, hy // 7000 AS sy FROM pts0),
pts AS (SELECT *, (l_quantity - 1) / CAST(49 AS DOUBLE) * (4 + (sx * 7 + sy * 11) % 20) + l_discount AS h,
  CAST(CASE WHEN (sx + sy) % 5 = 0 THEN 0 ELSE 1 + sx + 100 * sy END AS DOUBLE) AS pi FROM pts1),
cloud AS (SELECT pid, x, y, CAST(96 AS DOUBLE) + CAST(0.02 AS DOUBLE) * (x - 412337) + CAST(0.03 AS DOUBLE) * (y - 5733149) + h AS z, h, pi AS "PredInstance",
  CAST(CASE WHEN pi = 0 THEN 0 ELSE 1 + hx // 20000 END AS DOUBLE) AS "PredInstance_SAT" FROM pts)"""


def _lattice(name: str, x0: float, y0: float, columns: int, rows: int) -> str:
    return f"""
{name} AS (SELECT CAST(r * {columns} + c + 1 AS INTEGER) AS tile_id, c AS col, r AS row, {_D(x0)} + c * {TILE} AS xmin, {_D(y0)} + r * {TILE} AS ymin,
  {_D(x0)} + c * {TILE} + {TILE} AS xmax, {_D(y0)} + r * {TILE} + {TILE} AS ymax FROM range({columns}) a(c), range({rows}) b(r))"""


TILES = _lattice("tiles", AOI[0], AOI[1], 2, 2)
TILED = "tiled AS (SELECT tile_id, pid, x, y, h FROM cloud JOIN tiles ON x >= xmin AND x < xmax AND y >= ymin AND y < ymax)"
VOXELS = f"""
vox AS (SELECT DISTINCT tile_id, CAST(floor(x / {R}) AS BIGINT) AS vx, CAST(floor(y / {R}) AS BIGINT) AS vy, CAST(floor(h / {R} + 0.5) AS BIGINT) AS vz FROM tiled WHERE h >= 0 AND h <= {MAXIMUM}),
voxz AS (SELECT *, vz * {R} AS z FROM vox),
veg AS (SELECT * FROM voxz WHERE z > {GREEN})"""
CANOPY = f"""
chm AS (SELECT tile_id, CAST(floor((vx + {_D(0.5)}) * {R} / {CHM}) AS BIGINT) AS cx, CAST(floor((vy + {_D(0.5)}) * {R} / {CHM}) AS BIGINT) AS cy, max(z) AS top FROM voxz GROUP BY ALL)"""
MOMENTS = """
mom AS (SELECT tile_id, stddev_samp(z) AS zsd,
  CASE WHEN var_pop(z) > 0 THEN (avg(z * z * z) - 3 * avg(z) * avg(z * z) + 2 * avg(z) * avg(z) * avg(z)) / pow(var_pop(z), 1.5) END AS zskew,
  CASE WHEN var_pop(z) > 0 THEN kurtosis_pop(z) + 3 END AS zkurt, quantile_cont(z, 0.9) AS zq90 FROM veg GROUP BY tile_id)"""
BOXES = f"""
boxes AS (SELECT tile_id, f AS factor, count(*) AS boxes FROM (SELECT DISTINCT tile_id, f, floor(vx / CAST(f AS DOUBLE)) AS a, floor(vy / CAST(f AS DOUBLE)) AS b, floor(vz / CAST(f AS DOUBLE)) AS c
  FROM veg, (SELECT unnest([{', '.join(map(str, P.box_factors))}]) AS f)) GROUP BY tile_id, f),
dim AS (SELECT tile_id, CASE WHEN count(*) >= 2 THEN regr_slope(ln(boxes), ln(1 / (factor * {R}))) END AS box_dim_fixed FROM boxes GROUP BY tile_id)"""
LAYERS = f"""
lay AS (SELECT tile_id, CAST(greatest(ceil(z) - 1, 0) AS BIGINT) AS layer, count(*) AS n FROM veg WHERE z <= {MAXIMUM} GROUP BY ALL),
vci AS (SELECT tile_id, -sum(p * ln(p)) / ln({int(P.maximum_height)}) AS vci FROM (SELECT tile_id, n / CAST(sum(n) OVER (PARTITION BY tile_id) AS DOUBLE) AS p FROM lay) GROUP BY tile_id)"""
CHM_STATS = f"""
cst AS (SELECT tile_id, avg(top) AS chm_mean, stddev_samp(top) AS chm_sd, stddev_samp(top) / nullif(avg(top), 0) AS chm_cv, avg(CASE WHEN top < {_D(P.gap_height_threshold)} THEN 1.0 ELSE 0.0 END) AS gap_fraction FROM chm GROUP BY tile_id)"""


def _triangle(first: str, right: str, second: str) -> str:
    u, v, area = f"({first}.top - {right}.top)", f"({second}.top - {right}.top)", f"{CHM} * {CHM}"
    return f"sqrt({area} * ({u} * {u} + {v} * {v}) + {area} * {area}) / 2"


RUMPLE = f"""
rum AS (SELECT a.tile_id, sum({_triangle('a', 'b', 'd')} + {_triangle('a', 'c', 'd')}) / (count(*) * {CHM} * {CHM}) AS rumple
  FROM chm a JOIN chm b ON b.tile_id = a.tile_id AND b.cx = a.cx + 1 AND b.cy = a.cy JOIN chm c ON c.tile_id = a.tile_id AND c.cx = a.cx AND c.cy = a.cy + 1
  JOIN chm d ON d.tile_id = a.tile_id AND d.cx = a.cx + 1 AND d.cy = a.cy + 1 GROUP BY a.tile_id)"""
EDGES = """
latt AS (SELECT tile_id, round_even((xmin + xmax) / 2 / 20, 0) AS i, round_even((ymin + ymax) / 2 / 20, 0) AS j FROM tiles),
edges AS (SELECT l.tile_id, (SELECT count(*) FROM (VALUES (-1,-1),(-1,0),(-1,1),(0,-1),(0,1),(1,-1),(1,0),(1,1)) o(dx, dy)
  WHERE EXISTS (SELECT 1 FROM latt m WHERE m.i = l.i + dx AND m.j = l.j + dy)) < 8 AS edge_tile FROM latt l)"""
LONG = """
long AS (SELECT pid, x, y, h, 'PredInstance' AS instance_dimension, "PredInstance" AS instance_id FROM cloud UNION ALL
  SELECT pid, x, y, h, 'PredInstance_SAT', "PredInstance_SAT" FROM cloud)"""
SEGMENTS = f"""
val AS (SELECT * FROM long WHERE instance_id > 0 AND h >= 0 AND h <= {MAXIMUM}),
svox AS (SELECT DISTINCT instance_dimension, instance_id, CAST(floor(x / {R}) AS BIGINT) AS voxel_x, CAST(floor(y / {R}) AS BIGINT) AS voxel_y, CAST(floor(h / {R}) AS BIGINT) AS voxel_z FROM val),
slay AS (SELECT DISTINCT instance_dimension, instance_id, CAST(floor(h) AS BIGINT) AS occupied_layer FROM val),
apex AS (SELECT instance_dimension, instance_id, x AS apex_x, y AS apex_y, h AS apex_z FROM (SELECT *, row_number() OVER (PARTITION BY instance_dimension, instance_id ORDER BY h DESC, pid, x, y) AS rn FROM val) WHERE rn = 1),
cnt AS (SELECT instance_dimension, instance_id, CAST(count(*) AS INTEGER) AS n_vox, count(*) * ({R} * {R} * {R}) AS voxel_volume, count(DISTINCT (voxel_x, voxel_y)) * ({R} * {R}) AS crown_area FROM svox GROUP BY ALL),
nly AS (SELECT instance_dimension, instance_id, CAST(count(*) AS INTEGER) AS n_occupied_layers FROM slay GROUP BY ALL)"""


def _longest(n: str) -> str:
    """The longest cross product of two rows of the matrix less an eigenvalue."""
    a, b, c = f"(xx - {n})", f"(yy - {n})", f"(zz - {n})"
    rows = [(a, "xy", "xz"), ("xy", b, "yz"), ("xz", "yz", c)]

    def cross(u, v):
        return f"[{u[1]} * {v[2]} - {u[2]} * {v[1]}, {u[2]} * {v[0]} - {u[0]} * {v[2]}, {u[0]} * {v[1]} - {u[1]} * {v[0]}]"

    made = [cross(rows[0], rows[1]), cross(rows[0], rows[2]), cross(rows[1], rows[2])]
    return f"list_reverse_sort([struct_pack(n := list_dot_product(v, v), v := v) FOR v IN [{', '.join(made)}]])[1].v"


PCA = f"""
low AS (SELECT instance_dimension, instance_id, min(voxel_x) AS mx, min(voxel_y) AS my, min(voxel_z) AS mz FROM svox GROUP BY ALL),
near AS (SELECT instance_dimension, instance_id, (voxel_x - mx) * {R} AS x, (voxel_y - my) * {R} AS y, (voxel_z - mz) * {R} AS z FROM svox JOIN low USING (instance_dimension, instance_id)),
cov AS (SELECT instance_dimension, instance_id, count(*) AS n, covar_pop(x, x) AS xx, covar_pop(x, y) AS xy, covar_pop(x, z) AS xz, covar_pop(y, y) AS yy, covar_pop(y, z) AS yz, covar_pop(z, z) AS zz FROM near GROUP BY ALL),
cov1 AS (SELECT *, (xx + yy + zz) / 3 AS q, pow(xx - (xx + yy + zz) / 3, 2) + pow(yy - (xx + yy + zz) / 3, 2) + pow(zz - (xx + yy + zz) / 3, 2) + 2 * (xy * xy + xz * xz + yz * yz) AS p2 FROM cov WHERE n >= 3),
cov2 AS (SELECT *, sqrt(p2 / 6) AS s FROM cov1 WHERE p2 > 0),
cov3 AS (SELECT *, acos(greatest(least(((xx - q) / s * ((yy - q) / s * (zz - q) / s - yz / s * yz / s) - xy / s * (xy / s * (zz - q) / s - yz / s * xz / s) + xz / s * (xy / s * yz / s - (yy - q) / s * xz / s)) / 2, 1), -1)) / 3 AS phi FROM cov2),
eig AS (SELECT *, q + 2 * s * cos(phi) AS l1, q + 2 * s * cos(phi + {_D(2.0943951023931953)}) AS l3 FROM cov3),
vec AS (SELECT instance_dimension, instance_id, {_longest('l1')} AS a, {_longest('l3')} AS c FROM eig),
unit AS (SELECT instance_dimension, instance_id, [v / sqrt(list_dot_product(a, a)) FOR v IN a] AS a, [v / sqrt(list_dot_product(c, c)) FOR v IN c] AS c FROM vec),
axes AS (SELECT *, [c[2] * a[3] - c[3] * a[2], c[3] * a[1] - c[1] * a[3], c[1] * a[2] - c[2] * a[1]] AS b FROM unit),
ext AS (SELECT instance_dimension, instance_id, max(x * a[1] + y * a[2] + z * a[3]) - min(x * a[1] + y * a[2] + z * a[3]) AS pca_extent_1,
  max(x * b[1] + y * b[2] + z * b[3]) - min(x * b[1] + y * b[2] + z * b[3]) AS pca_extent_2, max(x * c[1] + y * c[2] + z * c[3]) - min(x * c[1] + y * c[2] + z * c[3]) AS pca_extent_3
  FROM near JOIN axes USING (instance_dimension, instance_id) GROUP BY ALL)"""
TABLE = f"""
seg0 AS (SELECT * FROM apex FULL JOIN cnt USING (instance_dimension, instance_id) FULL JOIN nly USING (instance_dimension, instance_id) LEFT JOIN ext USING (instance_dimension, instance_id)),
seg1 AS (SELECT *, n_vox >= {P.minimum_tree_voxels} AS pass_voxels, apex_z > {P.apex_minimum_height} AS pass_apex, coalesce(pca_extent_3 >= {P.minimum_tree_thickness}, false) AS pass_thickness, n_occupied_layers >= {P.minimum_occupied_layers} AS pass_occupied_layers FROM seg0),
seg AS (SELECT seg1.*, pass_voxels AND pass_apex AND pass_thickness AND pass_occupied_layers AS is_tree,
  CASE WHEN pass_voxels THEN '' ELSE 'voxels ' END || CASE WHEN pass_apex THEN '' ELSE 'apex ' END || CASE WHEN pass_thickness THEN '' ELSE 'thickness ' END || CASE WHEN pass_occupied_layers THEN '' ELSE 'layers ' END AS fail_reason,
  (SELECT min(tile_id) FROM tiles WHERE apex_x >= xmin AND apex_x < xmax AND apex_y >= ymin AND apex_y < ymax) AS tile_id FROM seg1)"""


def _gini(column: str, name: str) -> str:
    return f"""
{name} AS (SELECT tile_id, CASE WHEN count(*) < 2 THEN NULL WHEN sum(v) = 0 THEN 0 ELSE (2 * sum(i * v) / (count(*) * sum(v)) - (count(*) + 1) / CAST(count(*) AS DOUBLE)) * count(*) / (count(*) - 1) END AS {name}
  FROM (SELECT tile_id, {column} AS v, row_number() OVER (PARTITION BY tile_id ORDER BY {column}) AS i FROM first WHERE is_tree) GROUP BY tile_id)"""


TREES = (
    """
first AS (SELECT * FROM seg WHERE instance_dimension = 'PredInstance' AND tile_id IS NOT NULL),
agg AS (SELECT tile_id, CAST(count(*) AS INTEGER) AS n_seg_total, CAST(count(*) FILTER (is_tree) AS INTEGER) AS n_trees,
  max(apex_z) FILTER (is_tree) AS tree_height_max, avg(apex_z) FILTER (is_tree) AS tree_height_mean, max(crown_area) FILTER (is_tree) AS tree_crownarea_max, avg(crown_area) FILTER (is_tree) AS tree_crownarea_mean,
  max(voxel_volume) FILTER (is_tree) AS tree_volume_max, avg(voxel_volume) FILTER (is_tree) AS tree_volume_mean FROM first GROUP BY tile_id),"""
    + ",".join(_gini(c, n) for c, n in (("apex_z", "tree_height_gini"), ("crown_area", "tree_crownarea_gini"), ("voxel_volume", "tree_volume_gini")))
    + """,
trees AS (SELECT * FROM agg LEFT JOIN tree_height_gini USING (tile_id) LEFT JOIN tree_crownarea_gini USING (tile_id) LEFT JOIN tree_volume_gini USING (tile_id))"""
)
_HEIGHTS = "hts AS (SELECT tile_id, max(z) AS height_max, avg(z) AS height_mean FROM voxz GROUP BY tile_id)"
_FILLED = "fil AS (SELECT tile_id, CAST(count(*) AS INTEGER) AS vox_filled FROM veg GROUP BY tile_id)"
_RASTER = """
cells AS (SELECT c AS col, r AS row, CAST(96 AS DOUBLE) + CAST(0.02 AS DOUBLE) * (c + CAST(0.5 AS DOUBLE)) + CAST(0.03 AS DOUBLE) * (r + CAST(0.5 AS DOUBLE)) AS value FROM range(60) a(c), range(60) b(r))"""


def _rounded(columns: str, digits: int = 6, even: bool = False) -> str:
    """name or ~name (rounded) in a comma-separated list."""
    f = "round_even" if even else "round"
    return ", ".join(f'{f}({c[1:]}, {digits}) AS {c[1:]}' if c.startswith("~") else c for c in (x.strip() for x in columns.split(",")))


def _sql(parts: list[str], select: str) -> str:
    return f"WITH {','.join(parts)}\n{select}"


def _inside(box, t: str = "") -> str:
    return f"{t}xmin >= {_D(box[0])} AND {t}ymin >= {_D(box[1])} AND {t}xmax <= {_D(box[2])} AND {t}ymax <= {_D(box[3])}"


def _apart(box) -> str:
    return f"(xmax <= {_D(box[0])} OR xmin >= {_D(box[2])} OR ymax <= {_D(box[1])} OR ymin >= {_D(box[3])})"


_SEARCH = f"""
offs AS (SELECT i * CAST(0.5 AS DOUBLE) AS offset_x, j * CAST(0.5 AS DOUBLE) AS offset_y FROM range(40) a(i), range(40) b(j)),
grid0 AS (SELECT offset_x, offset_y, ({_D(WIDE_AOI[0])} - offset_x) + c * {TILE} AS xmin, ({_D(WIDE_AOI[1])} - offset_y) + r * {TILE} AS ymin FROM offs, range(6) a(c), range(6) b(r)),
grid AS (SELECT *, xmin + {TILE} AS xmax, ymin + {TILE} AS ymax FROM grid0)"""


def _search(condition: str) -> str:
    return f"scored AS (SELECT offset_x, offset_y, count(*) FILTER ({condition}) AS tiles FROM grid GROUP BY ALL), best AS (SELECT * FROM scored ORDER BY tiles DESC, offset_x, offset_y LIMIT 1)"


def _placed(condition: str) -> str:
    return _sql(
        [_SEARCH, _search(condition)],
        f"SELECT CAST(row_number() OVER (ORDER BY ymin, xmin) AS INTEGER) AS tile_id, {_rounded('~xmin, ~ymin, ~xmax, ~ymax')} FROM grid JOIN best USING (offset_x, offset_y) WHERE {condition}",
    )


_KEYS = "instance_dimension, instance_id"
_EXT = "~pca_extent_1, ~pca_extent_2, ~pca_extent_3"
_SEG = [CLOUD, TILES, LONG, SEGMENTS, PCA, TABLE]
_VOX = [CLOUD, TILES, TILED, VOXELS]
_GATE_COLUMNS = "pass_voxels, pass_apex, pass_thickness, pass_occupied_layers, is_tree, fail_reason"
_FREE = _inside(WIDE_AOI)
_BARRED = f"{_FREE} AND {_apart(EXCLUSION)}"

SQL = {
    "scan_points": _sql([CLOUD], f'SELECT {_rounded("pid, ~x, ~y, ~z, ~h")}, "PredInstance", "PredInstance_SAT" FROM cloud'),
    "point_extent": _sql([CLOUD], "SELECT count(*) AS n_points, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM cloud"),
    "covering_grid": _sql(
        [CLOUD, f"b AS (SELECT min(x) AS x0, min(y) AS y0, max(x) - min(x) AS sx, max(y) - min(y) AS sy, CAST(ceil((max(x) - min(x)) / {TILE}) AS BIGINT) AS nc, CAST(ceil((max(y) - min(y)) / {TILE}) AS BIGINT) AS nr FROM cloud)",
         f"t AS (SELECT c, r, nc, x0 - (nc * {TILE} - sx) / 2 + c * {TILE} AS xmin, y0 - (nr * {TILE} - sy) / 2 + r * {TILE} AS ymin FROM b, range(100) a(c), range(100) d(r) WHERE c < nc AND r < nr)"],
        f"SELECT CAST(r * nc + c + 1 AS INTEGER) AS tile_id, round(xmin, 6) AS xmin, round(ymin, 6) AS ymin, round(xmin + {TILE}, 6) AS xmax, round(ymin + {TILE}, 6) AS ymax FROM t",
    ),
    "offset_search": _sql([_SEARCH, _search(_BARRED)], "SELECT offset_x, offset_y, tiles FROM scored"),
    "optimized_grid": _placed(_FREE),
    "grid_with_exclusion": _placed(_BARRED),
    "edge_flags_offlattice": _sql([_lattice("tiles", 412346.0, 5733158.0, 5, 5), EDGES], "SELECT tile_id, edge_tile FROM edges"),
    "edge_flags_aligned": _sql([_lattice("tiles", 412340.0, 5733160.0, 5, 5), EDGES], "SELECT tile_id, edge_tile FROM edges"),
    "points_in_tiles": _sql([CLOUD, TILES, TILED], f"SELECT tile_id, {_rounded('pid, ~x, ~y, ~h')} FROM tiled"),
    "ground_normalize_nearest": _sql([CLOUD, _RASTER], "SELECT pid, round(x, 6) AS x, round(y, 6) AS y, round(z - value, 6) AS h FROM cloud JOIN cells ON col = floor(x - 412337) AND row = floor(y - 5733149)"),
    "ground_normalize_bilinear": _sql(
        [CLOUD, _RASTER, "n AS (SELECT row_number() OVER () AS id, pid, x, y, z, (x - 412337) - CAST(0.5 AS DOUBLE) AS u, (y - 5733149) - CAST(0.5 AS DOUBLE) AS v FROM cloud)",
         "q AS (SELECT id, pid, x, y, z, value, (CASE WHEN i = 1 THEN u - floor(u) ELSE 1 - (u - floor(u)) END) * (CASE WHEN j = 1 THEN v - floor(v) ELSE 1 - (v - floor(v)) END) AS w FROM n, (VALUES (0,0),(0,1),(1,0),(1,1)) o(i, j), cells WHERE col = floor(u) + i AND row = floor(v) + j)"],
        "SELECT pid, round(x, 6) AS x, round(y, 6) AS y, round(z - sum(w * value) / sum(w), 6) AS h FROM q GROUP BY id, pid, x, y, z HAVING sum(w) > 0",
    ),
    "buffered_chunks": _sql(
        [CLOUD], """SELECT cx AS chunk_x, cy AS chunk_y, count(*) AS points, count(*) FILTER (floor((x - 412337) / 20) = cx AND floor((y - 5733149) / 20) = cy) AS core
  FROM cloud, range(-2, 6) a(cx), range(-2, 6) b(cy) WHERE cx BETWEEN floor((x - 412337 - 5) / 20) AND floor((x - 412337 + 5) / 20) AND cy BETWEEN floor((y - 5733149 - 5) / 20) AND floor((y - 5733149 + 5) / 20) GROUP BY ALL""",
    ),
    "nondegenerate_chunks": _sql(
        [CLOUD], """SELECT cx AS chunk_x, cy AS chunk_y, count(DISTINCT (x, y)) >= 3 AND NOT coalesce(var_pop(x) * var_pop(y) - covar_pop(x, y) * covar_pop(x, y) <= CAST(1e-9 AS DOUBLE) * var_pop(x) * var_pop(y), true) AS usable
  FROM cloud, range(-2, 6) a(cx), range(-2, 6) b(cy) WHERE cx BETWEEN floor((x - 412337 - 5) / 20) AND floor((x - 412337 + 5) / 20) AND cy BETWEEN floor((y - 5733149 - 5) / 20) AND floor((y - 5733149 + 5) / 20) GROUP BY ALL""",
    ),
    "tin_dtm": "SELECT c AS col, r AS row, true AS near, true AS not_below FROM range(60) a(c), range(60) b(r)",
    "ptd_ground": _sql([CLOUD], f"SELECT 2 AS classification, 61 * 61 + count(*) FILTER (h <= {FLAT}) AS points FROM cloud UNION ALL SELECT 1, count(*) FROM cloud WHERE h > {FLAT}"),
    "dtm_mosaic_mean": _sql(
        [_RASTER], """SELECT col, row, round(avg(value + CAST(0.01 AS DOUBLE) * cx - CAST(0.02 AS DOUBLE) * cy), 6) AS value FROM cells, range(-2, 6) a(cx), range(-2, 6) b(cy)
  WHERE cx BETWEEN floor((col + 0.5 - 5) / 20) AND floor((col + 0.5 + 5) / 20) AND cy BETWEEN floor((row + 0.5 - 5) / 20) AND floor((row + 0.5 + 5) / 20) GROUP BY ALL""",
    ),
    "tile_voxels": _sql(_VOX, "SELECT tile_id, vx, vy, vz FROM vox"),
    "tile_density": _sql([*_VOX, _FILLED], f"SELECT tile_id, vox_filled, {P.voxel_total} AS vox_total, round(vox_filled / {_D(float(P.voxel_total))}, 6) AS veg_density FROM fil"),
    "tile_heights": _sql([*_VOX, _HEIGHTS], f"SELECT tile_id, {_rounded('~height_max, ~height_mean')} FROM hts"),
    "tile_moments": _sql([*_VOX, MOMENTS], f"SELECT tile_id, {_rounded('~zsd, ~zskew, ~zkurt')} FROM mom"),
    "tile_zq90": _sql([*_VOX, MOMENTS], f"SELECT tile_id, {_rounded('~zq90')} FROM mom"),
    "tile_box_counts": _sql([*_VOX, BOXES], "SELECT tile_id, factor, boxes FROM boxes"),
    "tile_box_dimension": _sql([*_VOX, BOXES], f"SELECT tile_id, {_rounded('~box_dim_fixed')} FROM dim"),
    "tile_layers": _sql([*_VOX, LAYERS], "SELECT tile_id, layer, n FROM lay"),
    "tile_vci": _sql([*_VOX, LAYERS], f"SELECT tile_id, {_rounded('~vci')} FROM vci"),
    "tile_chm": _sql([*_VOX, CANOPY], f"SELECT tile_id, cx, cy, {_rounded('~top')} FROM chm"),
    "tile_chm_stats": _sql([*_VOX, CANOPY, CHM_STATS], f"SELECT tile_id, {_rounded('~chm_mean, ~chm_sd, ~chm_cv, ~gap_fraction')} FROM cst"),
    "tile_rumple": _sql([*_VOX, CANOPY, RUMPLE], f"SELECT tile_id, {_rounded('~rumple')} FROM rum"),
    "global_chm": _sql(
        [CLOUD, f"gv AS (SELECT DISTINCT CAST(floor(x / {R}) AS BIGINT) AS vx, CAST(floor(y / {R}) AS BIGINT) AS vy, CAST(floor(h / {R} + 0.5) AS BIGINT) AS vz FROM cloud WHERE h >= 0 AND h <= {MAXIMUM})"],
        f"SELECT CAST(floor((vx + {_D(0.5)}) * {R} / {CHM}) AS BIGINT) AS cx, CAST(floor((vy + {_D(0.5)}) * {R} / {CHM}) AS BIGINT) AS cy, round(max(vz * {R}), 6) AS top FROM gv GROUP BY ALL",
    ),
    "segment_unpivot": _sql([CLOUD, LONG], f"SELECT {_rounded('pid, ~x, ~y, ~h')}, {_KEYS} FROM long"),
    "segment_voxels": _sql([CLOUD, LONG, SEGMENTS], f"SELECT {_KEYS}, voxel_x, voxel_y, voxel_z FROM svox"),
    "segment_layers": _sql([CLOUD, LONG, SEGMENTS], f"SELECT {_KEYS}, occupied_layer FROM slay"),
    "segment_apex": _sql([CLOUD, LONG, SEGMENTS], f"SELECT {_KEYS}, {_rounded('~apex_x, ~apex_y, ~apex_z')} FROM apex"),
    "segment_counts": _sql([CLOUD, LONG, SEGMENTS], f"SELECT {_KEYS}, n_vox, {_rounded('~voxel_volume')} FROM cnt"),
    "segment_crown": _sql([CLOUD, LONG, SEGMENTS], f"SELECT {_KEYS}, {_rounded('~crown_area')} FROM cnt"),
    "segment_layer_totals": _sql([CLOUD, LONG, SEGMENTS], f"SELECT {_KEYS}, n_occupied_layers FROM nly"),
    "segment_pca": _sql([CLOUD, LONG, SEGMENTS, PCA], f"SELECT {_KEYS}, {_rounded(_EXT, 4)} FROM cnt LEFT JOIN ext USING ({_KEYS})"),
    "segment_full_outer": _sql(_SEG, f"SELECT {_KEYS}, {_rounded('~apex_z, n_vox, n_occupied_layers, ~crown_area')} FROM seg0"),
    "segment_gates": _sql(_SEG, f"SELECT {_KEYS}, pass_voxels, pass_apex, pass_thickness, pass_occupied_layers, is_tree FROM seg"),
    "segment_fail_reason": _sql(_SEG, f"SELECT {_KEYS}, fail_reason FROM seg"),
    "segment_buckets": _sql([CLOUD, LONG, SEGMENTS], f"SELECT {_KEYS}, CAST(instance_id % 64 AS INTEGER) + 1 AS bucket, count(*) AS points FROM val GROUP BY ALL"),
    "apex_to_tile": _sql(_SEG, f"SELECT {_KEYS}, {_rounded('~apex_x, ~apex_y')}, tile_id FROM seg"),
    "segment_diagnostics": _sql(
        _SEG, f"""SELECT 'virtual' AS file, CAST(NULL AS VARCHAR) AS sensor, CAST(NULL AS VARCHAR) AS country, tile_id, instance_id AS "PredInstance", n_vox, round_even(apex_z, 4) AS apex_z, round_even(pca_extent_1, 4) AS pc_ext1,
  round_even(pca_extent_2, 4) AS pc_ext2, round_even(pca_extent_3, 4) AS pc_ext3, n_occupied_layers AS n_zlayer, pass_voxels AS pass_vox, pass_apex, pass_thickness AS pass_thick, pass_occupied_layers AS pass_zlayer, is_tree, tile_id IS NOT NULL AS apex_in_tile
  FROM seg WHERE instance_dimension = 'PredInstance'""",
    ),
    "tile_tree_metrics": _sql([*_SEG, TREES], f"SELECT tile_id, n_seg_total, n_trees, {_rounded('~tree_height_max, ~tree_height_mean, ~tree_crownarea_max, ~tree_crownarea_mean, ~tree_volume_max, ~tree_volume_mean')} FROM agg"),
    "tree_gini": _sql([*_SEG, TREES], f"SELECT tile_id, {_rounded('~tree_height_gini, ~tree_crownarea_gini, ~tree_volume_gini')} FROM trees WHERE n_trees > 0"),
    "tile_results": _sql(
        [CLOUD, TILES, TILED, VOXELS, CANOPY, MOMENTS, BOXES, LAYERS, CHM_STATS, RUMPLE, EDGES, _HEIGHTS, _FILLED, LONG, SEGMENTS, PCA, TABLE, TREES],
        "SELECT 'virtual' AS file, CAST(NULL AS VARCHAR) AS sensor, CAST(NULL AS VARCHAR) AS country, tile_id, xmin AS tile_xmin, ymin AS tile_ymin, edge_tile, CAST((SELECT count(*) FROM tiles) AS INTEGER) AS n_tiles_plot, "
        f"coalesce(vox_filled, 0) AS vox_filled, {P.voxel_total} AS vox_total, round_even(vox_filled / {_D(float(P.voxel_total))}, 6) AS veg_density, "
        + _rounded("~zsd, ~zskew, ~zkurt, ~zq90, ~box_dim_fixed, ~vci, ~rumple, ~gap_fraction, ~chm_sd, ~chm_cv, ~height_max, ~height_mean", even=True)
        + ", coalesce(n_seg_total, 0) AS n_seg_total, coalesce(n_trees, 0) AS n_trees, "
        + _rounded("~tree_height_max, ~tree_height_mean, ~tree_height_gini, ~tree_crownarea_mean, ~tree_crownarea_max, ~tree_crownarea_gini, ~tree_volume_mean, ~tree_volume_max, ~tree_volume_gini", even=True)
        + " FROM tiles LEFT JOIN edges USING (tile_id) " + " ".join(f"LEFT JOIN {t} USING (tile_id)" for t in ("fil", "mom", "dim", "vci", "rum", "cst", "hts", "trees")),
    ),
    "union_distinct_chunks": _sql([CLOUD, LONG, SEGMENTS], f"SELECT {_KEYS}, count(*) AS voxels FROM svox GROUP BY ALL"),
    "partial_final_segments": _sql([CLOUD, LONG, SEGMENTS], f"SELECT {_KEYS}, {_rounded('~apex_x, ~apex_y, ~apex_z')}, n_vox, n_occupied_layers FROM apex JOIN cnt USING ({_KEYS}) JOIN nly USING ({_KEYS})"),
    "snap_bounds": _sql(
        [CLOUD, "b AS (SELECT min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM cloud)"],
        "SELECT " + ", ".join(
            f"{f}(CASE WHEN abs({c} / {CHM} - round_even({c} / {CHM}, 0)) < 1e-9 THEN round_even({c} / {CHM}, 0) ELSE {c} / {CHM} END) * {CHM} AS {n}"
            for n, f, c in (("gx0", "floor", "xmin"), ("gy0", "floor", "ymin"), ("gx1", "ceil", "xmax"), ("gy1", "ceil", "ymax"))
        ) + " FROM b",
    ),
    "safe_scale": _sql([CLOUD], "SELECT pow(CAST(10 AS DOUBLE), ceil(log10(max(greatest(abs(x), abs(y))) / (0.95 * CAST(2147483647 AS DOUBLE))))) AS scale FROM cloud"),
    "aoi_roles": """
SELECT event_type AS raw, CASE lower(trim(event_type)) WHEN 'include' THEN 'inclusion' WHEN 'inclusion' THEN 'inclusion' WHEN 'exclude' THEN 'exclusion' WHEN 'exclusion' THEN 'exclusion' END AS role, count(*) AS features
FROM (SELECT CASE n_nationkey % 4 WHEN 0 THEN ' Include' WHEN 1 THEN 'INCLUSION ' WHEN 2 THEN 'exclude' ELSE 'Exclusion' END AS event_type FROM nation) GROUP BY ALL""",
}
SQL["stream_segments"] = SQL["partial_final_segments"]
