"""Queries over layouts, views, images and their measures, and their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina import fixtures as fx
from lamina.operators import image as im
from lamina.operators import pixelmeasures as pm
from lamina.operators import raster as ras
from lamina.operators import view as vw
from lamina.session import settled

QUERIES: dict = {}
SQL: dict = {}
RES, VRES = fx.RES, fx.VIEW_RES


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    """Doubles at `places` decimals, without negative zero."""
    return df.withColumns({c: F.round(c, places) + F.lit(0.0) for c in cols})


def r6(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) + 0 AS {c}" for c in cols)


# ------------------------------------------------------------------ layouts
_MAP = f"""{fx.LATTICE}, {fx.tri_sql(RES)}, {fx.cells_sql(RES, ['uid'], False)},
tx AS (SELECT uid, y, x, count(*) AS coverage, max(fid) AS f, max(b0) AS b0, max(b1) AS b1, max(b2) AS b2 FROM frag GROUP BY uid, y, x),
am AS (SELECT uid, y, x, coverage, CASE WHEN coverage = 1 THEN f ELSE -1 END AS face_id, CASE WHEN coverage = 1 THEN b0 END AS b0, CASE WHEN coverage = 1 THEN b1 END AS b1, CASE WHEN coverage = 1 THEN b2 END AS b2 FROM tx)"""


@query("uv_raster", f"WITH {_MAP} SELECT uid, y, x, coverage, face_id, {r6('b0', 'b1', 'b2')} FROM am")
def uv_raster(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ras.address_map(*fx.lattice(spark, d), RES), "b0", "b1", "b2")


@query("raster_overlap", f"WITH {_MAP} SELECT uid, y, x, coverage FROM am WHERE coverage > 1")
def raster_overlap(spark: SparkSession, d: str) -> DataFrame:
    return ras.address_map(*fx.lattice(spark, d), RES).filter("coverage > 1").select("uid", "y", "x", "coverage")


@query("raster_winding", f"WITH {_MAP} SELECT uid, face_id, count(*) AS texels, round(sum(b0), 6) AS s0, round(sum(b1), 6) AS s1, round(sum(b2), 6) AS s2 FROM am WHERE face_id >= 0 AND floor(face_id / 2) % 3 = 0 GROUP BY uid, face_id")
def raster_winding(spark: SparkSession, d: str) -> DataFrame:
    m = ras.address_map(*fx.lattice(spark, d), RES).filter((F.col("face_id") >= 0) & (F.pmod(F.floor(F.col("face_id") / 2), F.lit(3)) == 0))
    return m.groupBy("uid", "face_id").agg(F.count("*").alias("texels"), *[F.round(F.sum(f"b{k}"), 6).alias(f"s{k}") for k in range(3)])


@query(
    "raster_stats",
    f"""WITH {_MAP}, fs AS (SELECT uid, count(*) AS num_faces, count(*) FILTER (area = 0) AS num_zero_area, count(*) FILTER (area < 0) AS num_flipped FROM ar GROUP BY uid)
    SELECT fs.*, covered_px, overlap_px, valid_px, valid_px / CAST({RES * RES} AS double) AS occupancy, overlap_px / CAST(greatest(covered_px, 1) AS double) AS overlap_ratio FROM fs JOIN
    (SELECT uid, count(*) AS covered_px, count(*) FILTER (coverage > 1) AS overlap_px, count(*) FILTER (coverage = 1) AS valid_px FROM am GROUP BY uid) USING (uid)""",
)
def raster_stats(spark: SparkSession, d: str) -> DataFrame:
    return ras.stats(*fx.lattice(spark, d), RES)


@query("face_indirection", f"WITH {_MAP} SELECT uid, y, x, CASE WHEN face_id >= 0 AND face_id % 7 <> 0 THEN 1000 - face_id ELSE -1 END AS face_id FROM am")
def face_indirection(spark: SparkSession, d: str) -> DataFrame:
    v, f = fx.lattice(spark, d)
    m = f.filter("fid % 7 <> 0").select("uid", "fid", (F.lit(1000) - F.col("fid")).alias("mesh_fid"))
    return ras.address_map(v, f, RES, m).select("uid", "y", "x", "face_id")


@query("family_stride", f"WITH {_MAP} SELECT uid, y, x, face_id FROM am WHERE y % 4 = 0 AND x % 4 = 0")
def family_stride(spark: SparkSession, d: str) -> DataFrame:
    return ras.address_map(*fx.lattice(spark, d), RES).filter("y % 4 = 0 and x % 4 = 0").select("uid", "y", "x", "face_id")


@query("uv_range", f"WITH {fx.LATTICE} SELECT uid, min(least(u, v)) AS low, max(greatest(u, v)) AS high, min(least(u, v)) < -0.001 OR max(greatest(u, v)) > 1.001 AS out_of_range FROM uvv GROUP BY uid")
def uv_range(spark: SparkSession, d: str) -> DataFrame:
    return ras.uv_range(fx.lattice(spark, d)[0])


# every third mesh lacks layout faces, another third layout vertices
_BROKEN = "cu AS (SELECT * FROM mf WHERE uid % 3 <> 1 OR fid % 11 <> 0), ct AS (SELECT * FROM mt WHERE uid % 3 <> 2 OR tid < 1000)"


@query(
    "mesh_check",
    f"""WITH {fx.FIELD}, {_BROKEN},
    nv AS (SELECT uid, count(*) AS n_vertices, count(*) FILTER (isnan(y) OR isinf(y)) AS not_finite FROM mv GROUP BY uid),
    nf AS (SELECT uid, count(*) AS n_faces FROM mf GROUP BY uid),
    nu AS (SELECT f.uid, count(DISTINCT f.fid) AS n_uv_faces, count(*) FILTER (t.tid IS NULL) AS uv_out_of_range
           FROM (SELECT uid, fid, unnest([a, b, c]) AS tid FROM cu) f LEFT JOIN ct t ON t.uid = f.uid AND t.tid = f.tid GROUP BY f.uid)
    SELECT uid, n_vertices, not_finite, n_faces, CAST(0 AS bigint) AS out_of_range, n_uv_faces, uv_out_of_range,
      CASE WHEN not_finite > 0 THEN 'vertex is not finite' WHEN n_uv_faces <> n_faces THEN 'layout and mesh differ in faces' WHEN uv_out_of_range > 0 THEN 'layout face without its vertex' END AS problem
    FROM nv JOIN nf USING (uid) JOIN nu USING (uid)""",
)
def mesh_check(spark: SparkSession, d: str) -> DataFrame:
    v, f, uv, uf = fx.height_field(spark, d)
    third = F.pmod("uid", F.lit(3))
    return ras.mesh_check(v, f, uv.filter((third != 2) | (F.col("tid") < 1000)), uf.filter((third != 1) | (F.pmod("fid", F.lit(11)) != 0)))


_UNWRAP = f"""{fx.FIELD}, gs AS (SELECT uid, CAST(ceil(sqrt(ceil(count(*) / 2.0))) AS double) AS s FROM mf GROUP BY uid),
gc AS MATERIALIZED (SELECT uid, fid, s, fid % 2 = 1 AS odd, (fid // 2) % CAST(s AS bigint) / s AS x, floor(fid // 2 / s) / s AS y, CAST(0.02 AS double) / s AS i, CAST(0.96 AS double) / s AS f FROM mf JOIN gs USING (uid)),
pt AS (SELECT *, unnest([0, 1, 2]) AS k FROM gc),
uvv AS MATERIALIZED (SELECT uid, fid * 3 + k AS tid, CASE WHEN odd THEN x + CASE k WHEN 1 THEN 2 * i ELSE f END WHEN k = 1 THEN x + f - i ELSE x + i END AS u,
  CASE WHEN odd THEN y + CASE k WHEN 2 THEN 2 * i ELSE f END WHEN k = 2 THEN y + f - i ELSE y + i END AS v FROM pt),
tri AS MATERIALIZED (SELECT uid, tid // 3 AS fid, {", ".join(f"max({c}) FILTER (tid % 3 = {k}) * CAST(256 AS double) AS p{a}{k}" for k in range(3) for c, a in (("u", "x"), ("v", "y")))} FROM uvv GROUP BY uid, tid // 3)"""
_MEASURED = """fs AS (SELECT uid, count(*) AS num_faces, count(*) FILTER (area = 0) AS num_zero_area, count(*) FILTER (area < 0) AS num_flipped FROM ar GROUP BY uid),
px_ AS (SELECT uid, count(*) AS covered_px, count(*) FILTER (coverage > 1) AS overlap_px, count(*) FILTER (coverage = 1) AS valid_px FROM (SELECT uid, y, x, count(*) AS coverage FROM frag GROUP BY uid, y, x) GROUP BY uid)"""


@query("grid_layout", f"WITH {_UNWRAP} SELECT uid, tid, round(u, 9) AS u, round(v, 9) AS v FROM uvv")
def grid_layout(spark: SparkSession, d: str) -> DataFrame:
    return rounded(ras.grid_unwrap(fx.height_field(spark, d)[1])[0], "u", "v", places=9)


@query(
    "grid_unwrap",
    f"""WITH {_UNWRAP}, {fx.cells_sql(256, ["uid"], False)}, {_MEASURED}
    SELECT *, valid_px / CAST(65536 AS double) AS occupancy, overlap_px / CAST(greatest(covered_px, 1) AS double) AS overlap_ratio FROM fs JOIN px_ USING (uid)""",
)
def grid_unwrap(spark: SparkSession, d: str) -> DataFrame:
    _, f, _, _ = fx.height_field(spark, d)
    v, uf = ras.grid_unwrap(f)
    return ras.stats(v, uf, 256)


# -------------------------------------------------------------------- views
_BOX = fx.cameras_sql(vw.box_cameras())
_SHAPE = fx.cameras_sql(vw.shape_cameras())
_ZB = f"{fx.FIELD}, {fx.normalized_sql()}, {_BOX}, {fx.fragments_sql(VRES)}"


def _fragments(spark: SparkSession, d: str, keep: DataFrame | None = None) -> DataFrame:
    v, f, _, _ = fx.height_field(spark, d)
    return vw.fragments(vw.normalized(v), f, vw.camera_table(spark, vw.box_cameras()), VRES, keep)


@query("normalize_box", f"WITH {fx.FIELD}, {fx.normalized_sql()} SELECT uid, vid, {r6('x', 'y', 'z')} FROM nv")
def normalize_box(spark: SparkSession, d: str) -> DataFrame:
    return rounded(vw.normalized(fx.height_field(spark, d)[0]), "x", "y", "z")


@query("normalize_sphere", f"WITH {fx.FIELD}, {fx.normalized_sql('sphere')} SELECT uid, vid, {r6('x', 'y', 'z')} FROM nv")
def normalize_sphere(spark: SparkSession, d: str) -> DataFrame:
    return rounded(vw.normalized(fx.height_field(spark, d)[0], "sphere"), "x", "y", "z")


@query(
    "ortho_camera",
    """WITH a AS (SELECT view, radians(az) AS az, radians(el) AS el FROM (VALUES (0, 45, 20), (1, 135, 20)) t(view, az, el))
    SELECT view, round(cos(az), 6) AS rx, 0.0::double AS ry, round(-sin(az), 6) AS rz, round(-sin(el) * sin(az), 6) AS ux, round(cos(el), 6) AS uy, round(-sin(el) * cos(az), 6) AS uz,
      round(cos(el) * sin(az), 6) AS kx, round(sin(el), 6) AS ky, round(cos(el) * cos(az), 6) AS kz, round(2.8 * cos(el) * sin(az), 6) AS ox, round(2.8 * sin(el), 6) AS oy, round(2.8 * cos(el) * cos(az), 6) AS oz FROM a""",
)
def ortho_camera(spark: SparkSession, d: str) -> DataFrame:
    return rounded(vw.camera_table(spark, vw.shape_cameras()), *vw.CAMERA_COLUMNS[1:])


@query("ortho_zbuffer", f"WITH {_ZB} SELECT uid, view, y, x, fid, {r6('b0', 'b1', 'b2')} FROM zb")
def ortho_zbuffer(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_fragments(spark, d).drop("z"), "b0", "b1", "b2")


@query("faces_keep", f"WITH {fx.FIELD.replace('mf AS (', 'mf AS (SELECT * FROM (').replace('AND h.x < 63)', 'AND h.x < 63) WHERE fid % 2 = 0)')}, {fx.normalized_sql()}, {_BOX}, {fx.fragments_sql(VRES)} SELECT uid, view, count(*) AS covered, sum(fid)::bigint AS fids FROM zb GROUP BY uid, view")
def faces_keep(spark: SparkSession, d: str) -> DataFrame:
    keep = fx.height_field(spark, d)[1].filter("fid % 2 = 0").select("uid", "fid")
    return _fragments(spark, d, keep).groupBy("uid", "view").agg(F.count("*").alias("covered"), F.sum("fid").alias("fids"))


def _render_sql(name: str, flip: bool) -> str:
    ty = "least(greatest(CAST(round_even(v * (h - 1), 0) AS integer), 0), h - 1)"
    if flip:
        ty = f"h - 1 - {ty}"
    return f"""{name} AS (SELECT t.uid, t.view, t.y, t.x, p.r, p.g, p.b FROM (
      SELECT uid, view, y, x, least(greatest(CAST(round_even(u * (w - 1), 0) AS integer), 0), w - 1) AS tx, {ty} AS ty FROM uvz JOIN dim ON dim.img = uvz.uid) t
      JOIN px p ON p.img = t.uid AND p.y = t.ty AND p.x = t.tx)"""


_UVZ = """dim AS (SELECT img, max(y) + 1 AS h, max(x) + 1 AS w FROM px GROUP BY img),
uv0 AS MATERIALIZED (SELECT z.*, f.b, f.c, f.a FROM zb z JOIN mf f ON f.uid = z.uid AND f.fid = z.fid),
uv1 AS MATERIALIZED (SELECT z.*, t.u * b0 AS u0, t.v * b0 AS v0 FROM uv0 z JOIN mt t ON t.uid = z.uid AND t.tid = z.a),
uv2 AS MATERIALIZED (SELECT z.*, u0 + t.u * b1 AS u1, v0 + t.v * b1 AS v1 FROM uv1 z JOIN mt t ON t.uid = z.uid AND t.tid = z.b),
uvz AS MATERIALIZED (SELECT z.*, u1 + t.u * b2 AS u, v1 + t.v * b2 AS v FROM uv2 z JOIN mt t ON t.uid = z.uid AND t.tid = z.c)"""
_RENDER = f"{fx.PX}, {_ZB}, {_UVZ}, {_render_sql('rd', False)}, {_render_sql('rf', True)}"


def _renders(spark: SparkSession, d: str, flipped: bool | None) -> DataFrame:
    """The six views of each height field under its own image, upside down or both ways."""
    px = fx.pixels(spark, d)
    _, _, uv, uf = fx.height_field(spark, d)
    frags = _fragments(spark, d).join(im.sizes(px).withColumnRenamed("img", "uid"), "uid")
    return vw.emission(frags, uv, uf, px.withColumnRenamed("img", "uid"), F.col("w"), F.col("h"), flipped)


@query("render_box_views", f"WITH {_RENDER} SELECT * FROM rd")
def render_box_views(spark: SparkSession, d: str) -> DataFrame:
    return _renders(spark, d, False)


@query("render_ortho", f"WITH {_RENDER} SELECT false AS flipped, * FROM rd UNION ALL SELECT true, * FROM rf")
def render_ortho(spark: SparkSession, d: str) -> DataFrame:
    return _renders(spark, d, None)


_LIGHT = vw._unit(vw.KEY_LIGHT)


@query(
    "render_shape",
    f"""WITH {fx.FIELD}, {fx.normalized_sql('sphere')}, {_SHAPE}, {fx.fragments_sql(VRES)},
    e0 AS MATERIALIZED (SELECT f.*, p.x AS x0, p.y AS y0, p.z AS z0 FROM mf f JOIN nv p ON p.uid = f.uid AND p.vid = f.a),
    e1 AS MATERIALIZED (SELECT f.*, p.x - x0 AS ax, p.y - y0 AS ay, p.z - z0 AS az FROM e0 f JOIN nv p ON p.uid = f.uid AND p.vid = f.b),
    e AS MATERIALIZED (SELECT f.*, p.x - x0 AS bx, p.y - y0 AS by_, p.z - z0 AS bz FROM e1 f JOIN nv p ON p.uid = f.uid AND p.vid = f.c),
    n AS (SELECT uid, fid, ay * bz - az * by_ AS nx, az * bx - ax * bz AS ny, ax * by_ - ay * bx AS nz FROM e),
    un AS (SELECT uid, fid, nx / greatest(sqrt(nx * nx + ny * ny + nz * nz), 1e-12) AS nx, ny / greatest(sqrt(nx * nx + ny * ny + nz * nz), 1e-12) AS ny, nz / greatest(sqrt(nx * nx + ny * ny + nz * nz), 1e-12) AS nz FROM n)
    SELECT z.uid, z.view, z.y, z.x, CAST(round_even(least(greatest(CAST(0.18 AS double) + abs(nx * kx + ny * ky + nz * kz) * CAST(0.45 AS double)
      + greatest(nx * (rx * CAST({_LIGHT[0]!r} AS double) + ux * CAST({_LIGHT[1]!r} AS double) + kx * CAST({_LIGHT[2]!r} AS double)) + ny * (ry * CAST({_LIGHT[0]!r} AS double) + uy * CAST({_LIGHT[1]!r} AS double) + ky * CAST({_LIGHT[2]!r} AS double)) + nz * (rz * CAST({_LIGHT[0]!r} AS double) + uz * CAST({_LIGHT[1]!r} AS double) + kz * CAST({_LIGHT[2]!r} AS double)), 0) * CAST(0.37 AS double), 0), 1) * 235, 0) AS integer) AS grey
    FROM zb z JOIN un USING (uid, fid) JOIN cam USING (view)""",
)
def render_shape(spark: SparkSession, d: str) -> DataFrame:
    v, f, _, _ = fx.height_field(spark, d)
    cams = vw.camera_table(spark, vw.shape_cameras())
    nv = vw.normalized(v, "sphere")
    return vw.shaded(vw.fragments(nv, f, cams, VRES), nv, f, cams)


_TILES = """dim AS (SELECT img, max(y) + 1 AS h, max(x) + 1 AS w FROM px GROUP BY img),
ts AS (SELECT px.*, CAST(floor(h / 2) AS integer) AS th, CAST(floor(w / 3) AS integer) AS tw FROM px JOIN dim USING (img)),
tl AS (SELECT img AS uid, CAST(floor(y / th) * 3 + floor(x / tw) AS integer) AS tile, y % th AS y, x % tw AS x, r, g, b, th, tw FROM ts WHERE floor(y / th) < 2 AND floor(x / tw) < 3)"""


def _tiles(spark: SparkSession, d: str) -> DataFrame:
    px = fx.pixels(spark, d).withColumnRenamed("img", "uid")
    return vw.sheet_tiles(px, im.sizes(px.withColumnRenamed("uid", "img")).withColumnRenamed("img", "uid"))


@query("sheet_tiles", f"WITH {fx.PX}, {_TILES} SELECT * FROM tl")
def sheet_tiles(spark: SparkSession, d: str) -> DataFrame:
    return _tiles(spark, d)


def _fg_sql(src: str, keys: str, th: str, tw: str) -> str:
    return f"""bg AS (SELECT {keys}, median(r) AS br, median(g) AS bgr, median(b) AS bb FROM (SELECT * FROM {src} WHERE y < 4 AND x < 4 UNION ALL SELECT * FROM {src} WHERE y >= {th} - 4 AND x >= {tw} - 4) GROUP BY {keys}),
    fg AS (SELECT s.*, greatest(abs(r - br), abs(g - bgr), abs(b - bb)) > 12 AS fg FROM {src} s JOIN bg USING ({keys}))"""


@query("tile_foreground", f"WITH {fx.PX}, {_TILES}, {_fg_sql('tl', 'uid, tile', 'th', 'tw')} SELECT uid, tile, y, x, fg FROM fg")
def tile_foreground(spark: SparkSession, d: str) -> DataFrame:
    return vw.tile_foreground(_tiles(spark, d), ["uid", "tile"]).select("uid", "tile", "y", "x", "fg")


_G8 = f"""{_RENDER}, canvas AS (SELECT img AS uid, view, y, x FROM dim, range(6) v(view), range({VRES}) a(y), range({VRES}) b(x)),
ref AS (SELECT c.uid, c.view, c.y, c.x, coalesce(least(r + (c.x * 7 + c.y * 3) % 5, 255), 210) AS r, coalesce(least(g + (c.x * 5 + c.y) % 3, 255), 210) AS g, coalesce(b, 210) AS b FROM canvas c LEFT JOIN rd USING (uid, view, y, x)),
{_fg_sql('ref', 'uid, view', str(VRES), str(VRES))},
un AS (SELECT fg.uid, fg.view, count(*) FILTER (fg AND d.r IS NOT NULL) AS inter, count(*) FILTER (fg OR d.r IS NOT NULL) AS uni,
  sum(CASE WHEN fg AND d.r IS NOT NULL THEN (d.r - fg.r) * (d.r - fg.r) + (d.g - fg.g) * (d.g - fg.g) + (d.b - fg.b) * (d.b - fg.b) END)::bigint AS se,
  sum(CASE WHEN fg AND d.r IS NOT NULL THEN (f.r - fg.r) * (f.r - fg.r) + (f.g - fg.g) * (f.g - fg.g) + (f.b - fg.b) * (f.b - fg.b) END)::bigint AS sf
  FROM fg LEFT JOIN rd d USING (uid, view, y, x) LEFT JOIN rf f USING (uid, view, y, x) GROUP BY fg.uid, fg.view),
ps AS (SELECT uid, view, round(inter / CAST(greatest(uni, 1) AS double), 4) AS iou,
  CASE WHEN inter < 100 THEN NULL WHEN se = 0 THEN 'inf'::double ELSE 10 * log10(65025 / (se / CAST(inter * 3 AS double))) END AS psnr, CASE WHEN inter < 100 THEN NULL WHEN sf = 0 THEN 'inf'::double ELSE 10 * log10(65025 / (sf / CAST(inter * 3 AS double))) END AS psnr_flip FROM un)"""


def _g8_views(spark: SparkSession, d: str) -> DataFrame:
    """(uid, view, iou, psnr, psnr_flip): each view against a reference made from it. The renders are written once, as both sides read them."""
    rendered = settled(_renders(spark, d, None), "renders")
    side = F.sequence(F.lit(0), F.lit(VRES - 1))
    canvas = rendered.select("uid").distinct().withColumn("view", F.explode(F.sequence(F.lit(0), F.lit(5)))).withColumn("y", F.explode(side)).withColumn("x", F.explode(side))
    at = ["uid", "view", "y", "x"]
    shifted = lambda c, dx, dy, m: F.coalesce(F.least(F.col(c) + F.pmod(F.col("x") * dx + F.col("y") * dy, F.lit(m)), F.lit(255)), F.lit(210)).alias(c)
    ref = canvas.join(rendered.filter("not flipped"), at, "left").select(*at, shifted("r", 7, 3, 5), shifted("g", 5, 1, 3), F.coalesce("b", F.lit(210)).alias("b"))
    fg = vw.tile_foreground(ref.withColumns({"th": F.lit(VRES), "tw": F.lit(VRES)}), ["uid", "view"])
    return pm.compared_views(fg.select(*at, "fg", *[F.col(c).alias(f"t{c}") for c in "rgb"]), rendered)


@query("g8_psnr_view", f"WITH {_G8} SELECT uid, view, round(psnr, 6) AS psnr, round(psnr_flip, 6) AS psnr_flip FROM ps")
def g8_psnr_view(spark: SparkSession, d: str) -> DataFrame:
    return _g8_views(spark, d).select("uid", "view", F.round("psnr", 6).alias("psnr"), F.round("psnr_flip", 6).alias("psnr_flip"))


_AGREE = """round(median(CASE WHEN psnr IS NOT NULL THEN least(psnr, 99) END), 3) AS g8_psnr, round(median(CASE WHEN psnr_flip IS NOT NULL THEN least(psnr_flip, 99) END), 3) AS g8_psnr_flip,
  count(*) AS g8_views, count(psnr) AS g8_views_measured, count(*) FILTER (psnr = 'inf'::double) AS g8_exact_views, round(median(iou), 4) AS g8_iou"""


# every fifth view is undefined, and passed over by the medians
@query("g8_agreement", f"WITH {_G8}, th AS (SELECT uid, view, iou, CASE WHEN (uid + view) % 5 <> 0 THEN psnr END AS psnr, CASE WHEN (uid + view) % 5 <> 0 THEN psnr_flip END AS psnr_flip FROM ps) SELECT uid, {_AGREE} FROM th GROUP BY uid")
def g8_agreement(spark: SparkSession, d: str) -> DataFrame:
    void = F.pmod(F.col("uid") + F.col("view"), F.lit(5)) == 0
    return pm.agreement(_g8_views(spark, d).withColumns({c: F.when(~void, F.col(c)) for c in ("psnr", "psnr_flip")}), "uid")


@query("g8_measure", f"WITH {_G8} SELECT uid, {_AGREE} FROM ps GROUP BY uid")
def g8_measure(spark: SparkSession, d: str) -> DataFrame:
    return pm.agreement(_g8_views(spark, d), "uid")


_SIL = f"""{_ZB}, cv AS (SELECT uid, view, true AS whole, fid % 3 <> 0 AND fid * 37 % 256 >= 128 AS a, fid % 5 <> 0 AND fid * 53 % 256 >= 128 AS b FROM zb)"""


def _masks(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(whole, a, b): coverage masks of the views, of all faces and of two thinned sets of them, with values from 0 to 255."""
    f = settled(_fragments(spark, d).select("uid", "view", "y", "x", "fid"), "fragments")
    at = ["uid", "view", "y", "x"]
    thin = lambda drop, k: f.filter(F.pmod("fid", F.lit(drop)) != 0).select(*at, F.pmod(F.col("fid") * k, F.lit(256)).alias("v"))
    return f.select(*at, F.lit(255).alias("v")), thin(3, 37), thin(5, 53)


@query("silhouette_iou", f"WITH {_SIL} SELECT uid, view, round(count(*) FILTER (a AND b) / count(*) FILTER (a OR b), 4) AS iou FROM cv GROUP BY uid, view")
def silhouette_iou(spark: SparkSession, d: str) -> DataFrame:
    _, a, b = _masks(spark, d)
    return pm.silhouettes(a, b, ["uid", "view"])


@query("g4_framing", f"WITH {_SIL}, io AS (SELECT uid, view, round(count(*) FILTER (a) / count(*), 4) AS m, round(count(*) FILTER (b) / count(*), 4) AS o FROM cv GROUP BY uid, view) SELECT uid, min(m) AS g4_iou_min, min(o) AS g4_iou_orig, count(*) AS g4_views FROM io GROUP BY uid")
def g4_framing(spark: SparkSession, d: str) -> DataFrame:
    whole, a, b = _masks(spark, d)
    keys = ["uid", "view"]
    ious = pm.silhouettes(a, whole, keys).join(pm.silhouettes(b, whole, keys).withColumnRenamed("iou", "iou_orig"), keys)
    return pm.framing(ious, "uid")


@query("flip_vertical", f"WITH {fx.PX}, dim AS (SELECT img, max(y) + 1 AS h FROM px GROUP BY img) SELECT img, h - 1 - y AS y, x, r FROM px JOIN dim USING (img)")
def flip_vertical(spark: SparkSession, d: str) -> DataFrame:
    px = fx.pixels(spark, d)
    return px.join(im.sizes(px), "img").select("img", (F.col("h") - 1 - F.col("y")).alias("y"), "x", "r")


# ------------------------------------------------------------------- images
def _image(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    px = fx.pixels(spark, d)
    return px, fx.valid(px)


_NEAR = """nn AS (SELECT a.img, a.y, a.x, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2, b.y AS ny, b.x AS nx FROM {g} a JOIN {g} b ON a.img = b.img AND NOT a.valid AND b.valid{near}),
nb AS (SELECT img, y, x, ny, nx, d2 FROM (SELECT *, row_number() OVER (PARTITION BY img, y, x ORDER BY d2, ny, nx) AS n FROM nn) WHERE n = 1)"""
_WITHIN = _NEAR.format(g="vm", near=" AND b.x BETWEEN a.x - 4 AND a.x + 4 AND b.y BETWEEN a.y - 4 AND a.y + 4 AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 16")
_FULL = _NEAR.format(g="vm", near="")


@query("margin_ring", f"WITH {fx.PX}, {_WITHIN} SELECT p.img, p.y, p.x, {', '.join(f'CASE WHEN valid THEN p.{c} ELSE coalesce(q.{c}, 0) END AS {c}' for c in 'rgb')} FROM px p JOIN vm USING (img, y, x) LEFT JOIN nb USING (img, y, x) LEFT JOIN px q ON q.img = p.img AND q.y = nb.ny AND q.x = nb.nx")
def margin_ring(spark: SparkSession, d: str) -> DataFrame:
    return im.margin_ring(*_image(spark, d))


@query("ring_mask", f"WITH {fx.PX}, {_WITHIN} SELECT img, y, x FROM nb")
def ring_mask(spark: SparkSession, d: str) -> DataFrame:
    return im.ring_mask(_image(spark, d)[1])


_DIL = f"{fx.PX}, {_FULL}, dl AS (SELECT p.img, p.y, p.x, {', '.join(f'CASE WHEN valid THEN p.{c} ELSE coalesce(q.{c}, 0) END AS {c}' for c in 'rgb')} FROM px p JOIN vm USING (img, y, x) LEFT JOIN nb USING (img, y, x) LEFT JOIN px q ON q.img = p.img AND q.y = nb.ny AND q.x = nb.nx)"


@query("dilate_full", f"WITH {_DIL} SELECT * FROM dl")
def dilate_full(spark: SparkSession, d: str) -> DataFrame:
    return im.dilate_full(*_image(spark, d))


_MASK = """dm AS (SELECT img, max(y) + 1 AS h, max(x) + 1 AS w FROM px GROUP BY img),
ms AS (SELECT dm.img, CAST(a.y AS integer) AS y, CAST(b.x AS integer) AS x, v.valid FROM dm CROSS JOIN range(32) a(y) CROSS JOIN range(32) b(x) JOIN vm v ON v.img = dm.img AND v.y = CAST(floor((a.y + CAST(0.5 AS double)) * h / 32) AS integer) AND v.x = CAST(floor((b.x + CAST(0.5 AS double)) * w / 32) AS integer))"""


@query("mask_resample", f"WITH {fx.PX}, {_MASK} SELECT * FROM ms")
def mask_resample(spark: SparkSession, d: str) -> DataFrame:
    px, grid = _image(spark, d)
    return im.mask_resized(grid, 32, im.sizes(px))


_LANCZOS = "CASE WHEN t = 0 THEN 1 WHEN abs(t) >= 3 THEN 0 ELSE sin(pi() * t) / (pi() * t) * sin(pi() * t / 3) / (pi() * t / 3) END"
_CUBIC = "CASE WHEN abs(t) < 1 THEN CAST(1.5 AS double) * abs(t) ** 3 - CAST(2.5 AS double) * t * t + 1 WHEN abs(t) < 2 THEN CAST(-0.5 AS double) * (abs(t) ** 3 - 5 * t * t + 8 * abs(t) - 4) ELSE 0 END"


def _resize_sql(src: str, size: int = 32, reach: int = 3, f: str = _LANCZOS) -> str:
    """Both passes with weights computed in SQL from the public formula of the kernel."""
    byte = lambda c: f"CAST(least(greatest((sum(CAST({c} AS bigint) * k)::bigint + 2097152) >> 22, 0), 255) AS integer) AS {c}"
    return f"""ns AS (SELECT DISTINCT unnest([h, w]) AS n FROM (SELECT max(y) + 1 AS h, max(x) + 1 AS w FROM {src} GROUP BY img)),
    ct AS (SELECT n, i, (i + CAST(0.5 AS double)) * n / {size} AS c, greatest(n / CAST({size} AS double), 1) AS s FROM ns CROSS JOIN range({size}) t(i)),
    rg AS (SELECT *, unnest(range(CAST(greatest(trunc(c - {reach} * s + CAST(0.5 AS double)), 0) AS bigint), CAST(least(trunc(c + {reach} * s + CAST(0.5 AS double)), n) AS bigint))) AS j FROM ct),
    rt AS (SELECT *, (j - c + CAST(0.5 AS double)) / s AS t FROM rg), rw AS (SELECT *, {f} AS w FROM rt), rn AS (SELECT *, w / sum(w) OVER (PARTITION BY n, i) * 4194304 AS q FROM rw),
    wt AS (SELECT n, i, j, CAST(trunc(CASE WHEN q >= 0 THEN q + CAST(0.5 AS double) ELSE q - CAST(0.5 AS double) END) AS bigint) AS k FROM rn),
    sz AS (SELECT img, max(y) + 1 AS h, max(x) + 1 AS w FROM {src} GROUP BY img),
    h1 AS (SELECT p.img, sz.h, p.y, wt.i AS x, {byte('r')}, {byte('g')}, {byte('b')} FROM {src} p JOIN sz USING (img) JOIN wt ON wt.n = sz.w AND wt.j = p.x GROUP BY p.img, sz.h, p.y, wt.i),
    lz AS (SELECT h1.img, CAST(wt.i AS integer) AS y, CAST(h1.x AS integer) AS x, {byte('r')}, {byte('g')}, {byte('b')} FROM h1 JOIN wt ON wt.n = h1.h AND wt.j = h1.y GROUP BY h1.img, wt.i, h1.x)"""


@query("lanczos_resize", f"WITH {fx.PX}, {_resize_sql('px')} SELECT * FROM lz")
def lanczos_resize(spark: SparkSession, d: str) -> DataFrame:
    return im.resized(fx.pixels(spark, d), 32)


@query("bicubic_resize", f"WITH {fx.PX}, {_resize_sql('px', 48, 2, _CUBIC)} SELECT * FROM lz")
def bicubic_resize(spark: SparkSession, d: str) -> DataFrame:
    return im.resized(fx.pixels(spark, d), 48, "cubic")


_DELIVER = f"""{_DIL}, {_resize_sql('dl')}, {_MASK}, n2 AS (SELECT a.img, a.y, a.x, b.y AS ny, b.x AS nx, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2 FROM ms a JOIN ms b ON a.img = b.img AND NOT a.valid AND b.valid WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 16),
b2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY img, y, x ORDER BY d2, ny, nx) AS n FROM n2) WHERE n = 1),
de AS (SELECT p.img, p.y, p.x, {', '.join(f'CASE WHEN valid THEN p.{c} ELSE coalesce(q.{c}, 0) END AS {c}' for c in 'rgb')} FROM lz p JOIN ms USING (img, y, x) LEFT JOIN b2 USING (img, y, x) LEFT JOIN lz q ON q.img = p.img AND q.y = b2.ny AND q.x = b2.nx)"""


@query("deliver_texture", f"WITH {_DELIVER} SELECT * FROM de")
def deliver_texture(spark: SparkSession, d: str) -> DataFrame:
    return im.delivered(*_image(spark, d), 32)


@query("delivered_digest", f"WITH {_DELIVER} SELECT img, concat('{im.DIGEST_PREFIX}', substr(sha256(unhex(string_agg(printf('%02x%02x%02x', r, g, b), '' ORDER BY y, x))), 1, 16)) AS digest FROM de GROUP BY img")
def delivered_digest(spark: SparkSession, d: str) -> DataFrame:
    return im.digest(im.delivered(*_image(spark, d), 32))


_RC = "rc AS (SELECT n.img, d2, abs(p.r - q.r) + abs(p.g - q.g) + abs(p.b - q.b) AS df, p.r + p.g + p.b AS t FROM nb n JOIN px p USING (img, y, x) JOIN px q ON q.img = n.img AND q.y = n.ny AND q.x = n.nx)"


@query("ring_consistency", f"WITH {fx.PX}, {_FULL}, {_RC} SELECT img, coalesce(round(sum(df) FILTER (d2 <= 16) / (3 * count(*) FILTER (d2 <= 16)), 4), 0) AS ring_difference, coalesce(round(sum(t) FILTER (d2 > 64) / (3 * count(*) FILTER (d2 > 64)), 4), 0) AS far_background, count(*) FILTER (d2 <= 16) AS ring_texels FROM (SELECT DISTINCT img FROM px) LEFT JOIN rc USING (img) GROUP BY img")
def ring_consistency(spark: SparkSession, d: str) -> DataFrame:
    return im.ring_consistency(*_image(spark, d))


# each image is an object with one of the two layouts
_FAM = f"""{fx.PX}, {_MAP}, ob AS (SELECT img, max(y) + 1 AS h, max(x) + 1 AS w, CASE WHEN img % 2 = 0 THEN 'plain' ELSE 'overlap' END AS layout FROM px GROUP BY img),
fm AS (SELECT ob.img AS uid, layout, 'xatlas' AS family, y * {RES} + x AS i, face_id, b0, b1, b2 FROM ob JOIN am ON am.uid = layout
  UNION ALL SELECT ob.img, layout, 'smart_uv', y * {RES} + x, CASE WHEN (y * {RES} + x) % 17 = 0 THEN face_id + 1 ELSE face_id END, b0, b1, b2 FROM ob JOIN am ON am.uid = layout)"""
_SAMP = f"""{_FAM},
su AS (SELECT m.uid, m.family, m.i, a.u * b0 + b.u * b1 + c.u * b2 AS u, a.v * b0 + b.v * b1 + c.v * b2 AS v FROM fm m LEFT JOIN uvf f ON f.uid = m.layout AND f.fid = m.face_id
  LEFT JOIN uvv a ON a.uid = f.uid AND a.tid = f.ta LEFT JOIN uvv b ON b.uid = f.uid AND b.tid = f.tb LEFT JOIN uvv c ON c.uid = f.uid AND c.tid = f.tc),
sm AS (SELECT su.uid, family, i, {", ".join(f"CASE WHEN u IS NULL THEN 0 ELSE coalesce({c}, 0) END AS {c}" for c in "rgb")} FROM su JOIN ob ON ob.img = su.uid
  LEFT JOIN px ON px.img = su.uid AND px.x = least(greatest(CAST(round_even(u * (w - 1), 0) AS integer), 0), w - 1) AND px.y = least(greatest(CAST(round_even(v * (h - 1), 0) AS integer), 0), h - 1))"""


def _families(spark: SparkSession, d: str) -> DataFrame:
    px = fx.pixels(spark, d).withColumnRenamed("img", "uid")
    uv, uf = fx.lattice(spark, d)
    layout = F.when(F.pmod("uid", F.lit(2)) == 0, "plain").otherwise("overlap").alias("layout")
    objects = px.select("uid").distinct().select("uid", layout)
    own = lambda df: df.withColumnRenamed("uid", "layout").join(objects, "layout").drop("layout")
    m = own(ras.address_map(uv, uf, RES)).withColumn("i", (F.col("y") * RES + F.col("x")).cast("long"))
    cols = ["uid", "i", "face_id", "b0", "b1", "b2"]
    other = m.select(*cols, F.lit("smart_uv").alias("family")).withColumn("face_id", F.when(F.pmod("i", F.lit(17)) == 0, F.col("face_id") + 1).otherwise(F.col("face_id")))
    return im.sampled_families(m.select(*cols, F.lit("xatlas").alias("family")).unionByName(other), own(uv), own(uf), px)


@query("sample_families", f"WITH {_SAMP} SELECT uid, family, i, r, g, b FROM sm")
def sample_families(spark: SparkSession, d: str) -> DataFrame:
    return _families(spark, d)


@query("g6_cross_family", f"WITH {_SAMP}, sp AS (SELECT uid, i, greatest(max(r) - min(r), max(g) - min(g), max(b) - min(b)) AS s, count(DISTINCT family) AS f FROM sm GROUP BY uid, i) SELECT uid, round(count(*) FILTER (s > 2) / count(*), 6) AS g6_bad_fraction, count(*) AS g6_points, max(f) AS g6_families FROM sp GROUP BY uid")
def g6_cross_family(spark: SparkSession, d: str) -> DataFrame:
    return pm.cross_family(_families(spark, d), ["uid"], "i")


@query("family_resolve", f"WITH {_SAMP} SELECT uid, family, round(avg((greatest(r, g, b) > 0)::int), 4) AS resolved FROM sm GROUP BY uid, family")
def family_resolve(spark: SparkSession, d: str) -> DataFrame:
    return pm.family_resolve(_families(spark, d), ["uid"])


# ----------------------------------------------------------------- measures
@query("g1_dark_frac", f"WITH {fx.PX} SELECT img, coalesce(round(count(*) FILTER (valid AND greatest(r, g, b) < 12) / nullif(count(*) FILTER (valid), 0), 4), 0) AS g1_dark_frac, count(*) FILTER (valid) AS g1_valid_texels FROM px JOIN vm USING (img, y, x) GROUP BY img")
def g1_dark_frac(spark: SparkSession, d: str) -> DataFrame:
    return pm.dark_coverage(*_image(spark, d))


_BLOBS = f"""RECURSIVE {fx.PX}, dk AS (SELECT img, y, x, y * 64 + x AS id FROM px JOIN vm USING (img, y, x) WHERE valid AND greatest(r, g, b) < 12),
reach AS (SELECT img, id AS root, id, y, x FROM dk UNION SELECT d.img, r.root, d.id, d.y, d.x FROM reach r JOIN dk d ON d.img = r.img AND abs(d.y - r.y) + abs(d.x - r.x) = 1),
comp AS (SELECT img, id, min(root) AS root FROM reach GROUP BY img, id), sz AS (SELECT img, root, count(*) AS n FROM comp GROUP BY img, root)"""


@query("g1_max_blob", f"WITH {_BLOBS} SELECT img, count(*) AS blobs, max(n) AS largest, sum(n)::bigint AS dark, round(max(n) / sum(n), 3) AS g1_max_blob FROM sz GROUP BY img")
def g1_max_blob(spark: SparkSession, d: str) -> DataFrame:
    return pm.dark_blobs(*_image(spark, d))


_FLAT = f"""{fx.PX}, fl AS (SELECT img, y, x, CASE WHEN (x - 20) * (x - 20) + (y - 32) * (y - 32) <= 196 THEN CAST(floor(r / 8) AS integer) ELSE 210 END AS v FROM px),
fd AS (SELECT img, max(y) + 1 AS h, max(x) + 1 AS w FROM fl GROUP BY img),
cn AS (SELECT f.img, median(v) AS bg FROM fl f JOIN fd USING (img) CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(a, b) WHERE (CASE WHEN a = 0 THEN y < 4 ELSE y >= h - 4 END) AND (CASE WHEN b = 0 THEN x < 4 ELSE x >= w - 4 END) GROUP BY f.img)"""


@query("g1_ref_dark", f"WITH {_FLAT} SELECT img, CASE WHEN count(*) FILTER (abs(v - bg) > 40) >= 500 THEN round(count(*) FILTER (abs(v - bg) > 40 AND v < 60) / count(*) FILTER (abs(v - bg) > 40), 4) END AS g1_ref_dark, count(*) FILTER (abs(v - bg) > 40) AS g1_ref_foreground_px FROM fl JOIN cn USING (img) GROUP BY img")
def g1_ref_dark(spark: SparkSession, d: str) -> DataFrame:
    px = fx.pixels(spark, d)
    v = F.when((F.col("x") - 20) * (F.col("x") - 20) + (F.col("y") - 32) * (F.col("y") - 32) <= 196, F.floor(F.col("r") / 8).cast("int")).otherwise(210)
    flat = px.select("img", "y", "x", *[v.alias(c) for c in "rgb"])
    return pm.reference_dark(flat, im.sizes(px))


@query(
    "measurement_row",
    f"""WITH {_BLOBS}, {_FULL}, {_RC}, a AS ({SQL['g1_dark_frac'].replace(f'WITH {fx.PX}', '')}), b AS (SELECT img, round(max(n) / sum(n), 3) AS g1_max_blob FROM sz GROUP BY img), c AS ({SQL['ring_consistency'].split(_RC)[1]})
    SELECT img, g1_dark_frac, g1_valid_texels, coalesce(g1_max_blob, 0) AS g1_max_blob, ring_texels, CASE WHEN ring_difference > 0 OR far_background > 0 THEN 'ring or background differs from the margin rule' END AS error,
      'g1_ref_dark g3 g4 g5 g6 g7 g8' AS unmeasured FROM a JOIN c USING (img) LEFT JOIN b USING (img)""",
)
def measurement_row(spark: SparkSession, d: str) -> DataFrame:
    from lamina.operators.measures import assembled

    rows = assembled(*_image(spark, d))
    return rows.select("img", "g1_dark_frac", "g1_valid_texels", "g1_max_blob", "ring_texels", "error", F.array_join("unmeasured", " ").alias("unmeasured"))


# everything an object may have: a reference, views, families; every third is blessed, every second has a renderer's numbers over its own
@query(
    "measurement_full",
    f"""WITH one AS ({SQL['g1_dark_frac']}), ring AS ({SQL['ring_consistency']}), blob AS ({SQL['g1_max_blob']}), ref AS ({SQL['g1_ref_dark']}), g8 AS ({SQL['g8_measure']}),
    fam AS (SELECT uid, max(resolved) FILTER (family = 'xatlas') AS fx, max(resolved) FILTER (family = 'smart_uv') AS fs FROM ({SQL['family_resolve']}) GROUP BY uid)
    SELECT CAST(one.img AS varchar) AS uid, g1_dark_frac, coalesce(g1_max_blob, 0) AS g1_max_blob, g1_ref_dark, g1_ref_foreground_px, one.img % 3 = 0 AS g1_bless, CASE WHEN one.img % 6 = 0 THEN 'seen' WHEN one.img % 3 = 0 THEN 'no note recorded' END AS g1_bless_note,
      CASE WHEN one.img % 2 = 0 THEN 30.0 + one.img ELSE g8_psnr END AS g8_psnr, g8_psnr_flip, g8_views, g8_views_measured, g8_exact_views, g8_iou, fx AS resolved_xatlas, fs AS resolved_smart_uv,
      CASE WHEN one.img % 2 = 0 THEN CAST(0.5 AS double) END AS g3_ratio, '' AS g3_note, CASE WHEN one.img % 2 = 0 THEN CAST(0.97 AS double) END AS g4_iou_min, CASE WHEN one.img % 2 = 0 THEN 4 END AS g5_valid_views,
      CASE WHEN one.img % 2 = 0 THEN 'g6 g7' ELSE 'g3 g4 g5 g6 g7' END AS unmeasured, CASE WHEN ring_difference > 0 OR far_background > 0 THEN 'ring or background differs from the margin rule' END AS error
    FROM one JOIN ring USING (img) LEFT JOIN blob USING (img) LEFT JOIN ref USING (img) LEFT JOIN g8 ON g8.uid = one.img LEFT JOIN fam ON fam.uid = one.img""",
)
def measurement_full(spark: SparkSession, d: str) -> DataFrame:
    from lamina.operators.measures import assembled

    px, grid = _image(spark, d)
    text = lambda df: df.withColumn("uid", F.col("uid").cast("string"))
    flat = (F.col("x") - 20) * (F.col("x") - 20) + (F.col("y") - 32) * (F.col("y") - 32) <= 196
    reference = px.select(F.col("img").alias("uid"), "y", "x", *[F.when(flat, F.floor(F.col("r") / 8).cast("int")).otherwise(210).alias(c) for c in "rgb"])
    families = pm.family_resolve(_families(spark, d), ["uid"]).groupBy("uid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("family", "resolved")))).alias("family_resolve"))
    objects = px.select(F.col("img").alias("uid")).distinct()
    bless = objects.filter("uid % 3 = 0").withColumn("note", F.when(F.pmod("uid", F.lit(6)) == 0, "seen").otherwise(" "))
    own = {"g3_ratio": F.lit(0.5), "g4_iou_min": F.lit(0.97), "g5_valid_views": F.lit(4.0), "g8_psnr": F.col("uid") + 30.0, "seconds": F.lit(3.0)}
    render = objects.filter("uid % 2 = 0").withColumn("measures", F.create_map(*[x for k, v in own.items() for x in (F.lit(k), v.cast("double"))])).withColumn("note", F.lit(""))
    rows = assembled(px, grid, text(reference), text(pm.agreement(_g8_views(spark, d), "uid")), text(families), text(bless), text(render))
    plain = ["uid", "g1_dark_frac", "g1_max_blob", "g1_ref_dark", "g1_ref_foreground_px", "g1_bless", "g1_bless_note", "g8_psnr", "g8_psnr_flip", "g8_views", "g8_views_measured", "g8_exact_views", "g8_iou", "g3_ratio", "g3_note", "g4_iou_min", "g5_valid_views", "error"]
    return rows.select(*plain, F.col("family_resolve")["xatlas"].alias("resolved_xatlas"), F.col("family_resolve")["smart_uv"].alias("resolved_smart_uv"), F.array_join("unmeasured", " ").alias("unmeasured"))
