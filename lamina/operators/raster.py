"""UV address raster: which texel belongs to which face, with barycentric weights.

Candidate cells come from each triangle's bounding box by two explodes, so the planner sees a Generate and a
filter and no range join. Texels covered by more than one face are invalid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def corner_columns(faces: DataFrame, points: DataFrame, ids: list[str], point_id: str, coords: list[str], keys: list[str], face: str = "fid") -> DataFrame:
    """One row per face with the coordinates of its three corners as <coord>0..2.

    The corners are exploded and joined once, then folded back: one join and one aggregation instead of three joins.
    """
    c = faces.select(*keys, face, F.posexplode(F.array(*ids)).alias("_k", point_id))
    j = c.join(points, [*[k for k in keys if k in points.columns], point_id])
    return j.groupBy(*keys, face).agg(*[F.max(F.when(F.col("_k") == k, F.col(x))).alias(f"{x}{k}") for k in range(3) for x in coords])


def _edge(a: int, b: int) -> Column:
    ax, ay, bx, by = (F.col(f"{n}{k}") for k in (a, b) for n in ("tx", "ty"))
    return (bx - ax) * (F.col("cy") - ay) - (by - ay) * (F.col("cx") - ax)


def _topleft(a: int, b: int) -> Column:
    dy = F.col(f"ty{b}") - F.col(f"ty{a}")
    dx = F.col(f"tx{b}") - F.col(f"tx{a}")
    return (dy < 0) | ((dy == 0) & (dx > 0))


def computed_once(df: DataFrame, columns: dict[str, Column], drop: list[str] | None = None) -> DataFrame:
    """The frame with columns that later filters read but do not work out again: the optimizer puts a filter's expressions in
    place of names all the way down, and a generated row stops it."""
    rest = [c for c in df.columns if c not in columns and c not in (drop or [])]
    return df.select(*rest, F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_once")).select(*rest, "_once.*")


def cells(tri: DataFrame, width: int, height: int, keys: list[str], shared_edges: bool, margin: bool = False) -> DataFrame:
    """Cells whose centre lies in the triangles (px0..py2), as keys, fid, x, y, b0..b2 in the caller's corner order.

    shared_edges: an edge belongs to both faces (a depth test settles it); otherwise only to one, by the top-left rule.
    Triangles without area are left out. margin: triangles wholly off the canvas are left out before clipping.
    """
    corners = [f"p{n}{k}" for k in range(3) for n in ("x", "y")]
    t = computed_once(tri, {c: F.col(c) for c in corners})
    area = (F.col("px1") - F.col("px0")) * (F.col("py2") - F.col("py0")) - (F.col("py1") - F.col("py0")) * (F.col("px2") - F.col("px0"))
    t = computed_once(t, {"area": area}).filter("area <> 0")
    pick = lambda n, k: F.when(F.col("area") < 0, F.col(f"p{n}{(0, 2, 1)[k]}")).otherwise(F.col(f"p{n}{k}"))
    t = computed_once(t, {"swap": F.col("area") < 0} | {f"t{n}{k}": pick(n, k) for k in range(3) for n in ("x", "y")}, ["area", *corners])
    lo = {n: F.least(*[F.col(f"t{n}{k}") for k in range(3)]) for n in ("x", "y")}
    hi = {n: F.greatest(*[F.col(f"t{n}{k}") for k in range(3)]) for n in ("x", "y")}
    if margin:
        t = t.filter((hi["x"] >= 0) & (lo["x"] <= width) & (hi["y"] >= 0) & (lo["y"] <= height))
    clip = lambda c, n: F.least(F.greatest(c, F.lit(0)), F.lit(n - 1)).cast("int")
    t = computed_once(t, {"x0": clip(F.ceil(lo["x"] - 0.5), width), "x1": clip(F.floor(hi["x"] - 0.5), width), "y0": clip(F.ceil(lo["y"] - 0.5), height), "y1": clip(F.floor(hi["y"] - 0.5), height)})
    t = t.filter("x0 <= x1 and y0 <= y1")  # a sequence would count down
    t = t.withColumn("x", F.explode(F.sequence("x0", "x1"))).withColumn("y", F.explode(F.sequence("y0", "y1")))
    t = t.withColumns({"cx": F.col("x").cast("double") + 0.5, "cy": F.col("y").cast("double") + 0.5})
    t = computed_once(t, {"e0": _edge(1, 2), "e1": _edge(2, 0), "e2": _edge(0, 1)})
    if shared_edges:
        inside = (F.col("e0") >= 0) & (F.col("e1") >= 0) & (F.col("e2") >= 0)
    else:
        own = lambda e, a, b: (F.col(e) > 0) | ((F.col(e) == 0) & _topleft(a, b))
        inside = own("e0", 1, 2) & own("e1", 2, 0) & own("e2", 0, 1)
    s = F.col("e0") + F.col("e1") + F.col("e2")
    t = t.filter(inside)
    second, third = F.col("e1") / s, F.col("e2") / s
    return t.withColumns({"b0": F.col("e0") / s, "b1": F.when(F.col("swap"), third).otherwise(second), "b2": F.when(F.col("swap"), second).otherwise(third)}).drop("e0", "e1", "e2", "cx", "cy", "x0", "x1", "y0", "y1", "swap", *[f"t{n}{k}" for n in ("x", "y") for k in range(3)])


def uv_triangles(uv_vertices: DataFrame, uv_faces: DataFrame, res: int) -> DataFrame:
    """Faces of (uid, fid, ta, tb, tc) over (uid, tid, u, v) in texels of a res x res atlas; v runs down."""
    t = corner_columns(uv_faces, uv_vertices, ["ta", "tb", "tc"], "tid", ["u", "v"], ["uid"])
    return t.select("uid", "fid", *[(F.col(f"{a}{k}") * float(res)).alias(f"p{b}{k}") for k in range(3) for a, b in (("u", "x"), ("v", "y"))])


def address_map(uv_vertices: DataFrame, uv_faces: DataFrame, res: int, face_map: DataFrame | None = None) -> DataFrame:
    """(uid, y, x, coverage, face_id, b0, b1, b2): every covered texel; face_id -1 and null weights where faces overlap.

    face_map (uid, fid, mesh_fid) leads from UV faces to mesh faces.
    """
    c = cells(uv_triangles(uv_vertices, uv_faces, res), res, res, ["uid"], shared_edges=False)
    # where only one face covers a texel, each maximum is that face's
    g = c.groupBy("uid", "y", "x").agg(F.count("*").alias("coverage"), *[F.max(b).alias(b) for b in ("fid", "b0", "b1", "b2")])
    one = F.col("coverage") == 1
    out = g.select("uid", "y", "x", "coverage", F.when(one, F.col("fid")).otherwise(-1).cast("long").alias("face_id"), *[F.when(one, F.col(b)).alias(b) for b in ("b0", "b1", "b2")])
    if face_map is not None:
        m = face_map.select("uid", F.col("fid").alias("face_id"), "mesh_fid")
        out = out.join(m, ["uid", "face_id"], "left").withColumn("face_id", F.coalesce("mesh_fid", F.lit(-1)).cast("long")).drop("mesh_fid")
    return out


def stats(uv_vertices: DataFrame, uv_faces: DataFrame, res: int) -> DataFrame:
    """Faces, faces without area, reversed faces, covered, overlapping and valid texels, occupancy and the overlapping share of what is covered, per uid."""
    tri = uv_triangles(uv_vertices, uv_faces, res)
    area = (F.col("px1") - F.col("px0")) * (F.col("py2") - F.col("py0")) - (F.col("py1") - F.col("py0")) * (F.col("px2") - F.col("px0"))
    f = tri.withColumn("a", area).groupBy("uid").agg(F.count("*").alias("num_faces"), F.count_if(F.col("a") == 0).alias("num_zero_area"), F.count_if(F.col("a") < 0).alias("num_flipped"))
    m = address_map(uv_vertices, uv_faces, res).groupBy("uid").agg(F.count("*").alias("covered_px"), F.count_if(F.col("coverage") > 1).alias("overlap_px"), F.count_if(F.col("coverage") == 1).alias("valid_px"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return f.join(m, "uid", "left").select("uid", "num_faces", "num_zero_area", "num_flipped", z("covered_px"), z("overlap_px"), z("valid_px"), (F.coalesce("valid_px", F.lit(0)) / F.lit(float(res * res))).alias("occupancy"), (F.coalesce("overlap_px", F.lit(0)) / F.greatest(F.coalesce("covered_px", F.lit(0)), F.lit(1))).alias("overlap_ratio"))


def mesh_check(vertices: DataFrame, faces: DataFrame, uv_vertices: DataFrame | None = None, uv_faces: DataFrame | None = None) -> DataFrame:
    """Violations of the mesh contract per uid, and the first of them as `problem` (null for none).

    Coordinates that are no finite numbers, faces whose corners do not exist and, for objects with a layout, another
    number of layout faces than faces, or layout faces whose corners do not exist.
    """
    bad = F.lit(False)
    for c in ("x", "y", "z"):
        bad = bad | F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    out = vertices.groupBy("uid").agg(F.count("*").alias("n_vertices"), F.count_if(bad).alias("not_finite")).join(_corners(faces, ["a", "b", "c"], vertices, "vid", "n_faces", "out_of_range"), "uid", "full")
    names = ["n_vertices", "not_finite", "n_faces", "out_of_range"]
    if uv_faces is not None:
        out = out.join(_corners(uv_faces, ["ta", "tb", "tc"], uv_vertices, "tid", "n_uv_faces", "uv_out_of_range").withColumn("_laid", F.lit(True)), "uid", "full")
        names += ["n_uv_faces", "uv_out_of_range"]
        laid = F.coalesce("_laid", F.lit(False))
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in names})
    problem = F.when(F.col("not_finite") > 0, "vertex is not finite").when(F.col("out_of_range") > 0, "face without its vertex")
    if uv_faces is not None:
        problem = problem.when(laid & (F.col("n_uv_faces") != F.col("n_faces")), "layout and mesh differ in faces").when(F.col("uv_out_of_range") > 0, "layout face without its vertex")
    return out.select("uid", *names, problem.alias("problem"))


def _corners(faces: DataFrame, ids: list[str], points: DataFrame, point: str, count: str, missing: str) -> DataFrame:
    c = faces.select("uid", "fid", F.explode(F.array(*ids)).alias(point)).join(points.select("uid", point, F.lit(1).alias("_there")), ["uid", point], "left")
    return c.groupBy("uid").agg(F.count_distinct("fid").alias(count), F.count_if(F.col("_there").isNull()).alias(missing))


def required(check: DataFrame) -> DataFrame:
    """The rows of mesh_check, or an error that names the first object and problem met."""
    return check.withColumn("problem", F.when(F.col("problem").isNotNull(), F.raise_error(F.concat(F.col("uid").cast("string"), F.lit(": "), F.col("problem"))).cast("string")))


def uv_range(uv_vertices: DataFrame, slack: float = 1e-3) -> DataFrame:
    """Smallest and largest coordinate per uid, and whether the layout leaves [0, 1]: then it cannot be one atlas."""
    g = uv_vertices.groupBy("uid").agg(F.min(F.least("u", "v")).alias("low"), F.max(F.greatest("u", "v")).alias("high"))
    return g.withColumn("out_of_range", (F.col("low") < -slack) | (F.col("high") > 1 + slack))


def grid_unwrap(faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A layout of our own: each face gets half a cell of a square grid. Provenance is grid, never that of a real unwrapper."""
    n = faces.groupBy("uid").agg(F.count("*").alias("_n"))
    side = F.ceil(F.sqrt(F.ceil(F.col("_n") / 2))).cast("double")
    f = faces.select("uid", "fid").join(n, "uid").withColumn("_s", side).withColumn("_c", F.floor(F.col("fid") / 2))
    x, y = F.pmod("_c", F.col("_s").cast("long")) / F.col("_s"), F.floor(F.col("_c") / F.col("_s")) / F.col("_s")
    inset, full = F.lit(0.02) / F.col("_s"), F.lit(0.96) / F.col("_s")
    odd = F.pmod("fid", F.lit(2)) == 1
    corners = F.array(
        F.struct(F.when(odd, x + full).otherwise(x + inset).alias("u"), F.when(odd, y + full).otherwise(y + inset).alias("v")),
        F.struct(F.when(odd, x + inset * 2).otherwise(x + full - inset).alias("u"), F.when(odd, y + full).otherwise(y + inset).alias("v")),
        F.struct(F.when(odd, x + full).otherwise(x + inset).alias("u"), F.when(odd, y + inset * 2).otherwise(y + full - inset).alias("v")),
    )
    v = f.select("uid", "fid", F.posexplode(corners).alias("k", "p")).select("uid", (F.col("fid") * 3 + F.col("k")).alias("tid"), "p.u", "p.v")
    return v, f.select("uid", "fid", *[(F.col("fid") * 3 + k).alias(c) for k, c in enumerate(("ta", "tb", "tc"))])
