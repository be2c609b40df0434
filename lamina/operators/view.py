"""Orthographic views of meshes: normalisation, projection, depth test, shading, sheets."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators.raster import cells, corner_columns

#: Distance of the camera, size of the normalised mesh, order and angles of the views.
RADIUS = 2.8
EXTENT = 0.95
VIEW_NAMES = ("front", "right", "top", "back", "left", "down")
SHAPE_ANGLES = ((45.0, 20.0), (135.0, 20.0))
KEY_LIGHT = (-0.4, 0.55, 0.73)


def _cross(a, b):
    return (a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def _unit(a):
    n = math.sqrt(sum(x * x for x in a))
    return tuple(x / n for x in a)


def camera(azimuth: float, elevation: float, radius: float = RADIUS) -> tuple:
    """(right, up, back, position) of a camera that looks at the origin; azimuth 0 is +Z, 90 is +X, elevation lifts to +Y."""
    az, el = math.radians(azimuth), math.radians(elevation)
    pos = (radius * math.cos(el) * math.sin(az), radius * math.sin(el), radius * math.cos(el) * math.cos(az))
    back = _unit(pos)
    up = (0.0, 0.0, 1.0) if abs(back[1]) > 0.999 else (0.0, 1.0, 0.0)
    right = _unit(_cross(up, back))
    return right, _cross(back, right), back, pos


def box_cameras() -> list[tuple]:
    """The six axis views with exact entries, in sheet order."""
    axes = {
        "front": ((1, 0, 0), (0, 1, 0), (0, 0, 1)),
        "right": ((0, 0, -1), (0, 1, 0), (1, 0, 0)),
        "top": ((1, 0, 0), (0, 0, -1), (0, 1, 0)),
        "back": ((-1, 0, 0), (0, 1, 0), (0, 0, -1)),
        "left": ((0, 0, 1), (0, 1, 0), (-1, 0, 0)),
        "down": ((-1, 0, 0), (0, 0, -1), (0, -1, 0)),
    }
    return [(i, *[float(x) for a in axes[n] for x in a], *[RADIUS * x for x in axes[n][2]]) for i, n in enumerate(VIEW_NAMES)]


def shape_cameras() -> list[tuple]:
    out = []
    for i, (az, el) in enumerate(SHAPE_ANGLES):
        r, u, b, p = camera(az, el)
        out.append((i, *r, *u, *b, *p))
    return out


CAMERA_COLUMNS = ["view", *[f"{a}{k}" for a in ("r", "u", "k") for k in "xyz"], "ox", "oy", "oz"]


def camera_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A handful of cameras as a relation."""
    return spark.createDataFrame(rows, "view int, " + ", ".join(f"{c} double" for c in CAMERA_COLUMNS[1:]))


def normalized(vertices: DataFrame, fit: str = "box", extent: float = EXTENT) -> DataFrame:
    """Vertices centred and scaled: the longest axis (box) or the largest radius (sphere) becomes +-extent. No extent is an error."""
    g = vertices.groupBy("uid").agg(*[f(c).alias(f"{n}{c}") for c in ("x", "y", "z") for f, n in ((F.min, "lo"), (F.max, "hi"))])
    g = g.select("uid", *[((F.col(f"lo{c}") + F.col(f"hi{c}")) / 2.0).alias(f"m{c}") for c in ("x", "y", "z")], F.greatest(*[F.col(f"hi{c}") - F.col(f"lo{c}") for c in ("x", "y", "z")]).alias("_box"))
    v = vertices.join(g, "uid")
    off = {c: F.col(c) - F.col(f"m{c}") for c in ("x", "y", "z")}
    if fit == "box":
        v = v.withColumn("_span", F.col("_box"))
    elif fit == "sphere":
        r = v.groupBy("uid").agg((F.max(F.sqrt(off["x"] * off["x"] + off["y"] * off["y"] + off["z"] * off["z"])) * 2.0).alias("_span"))
        v = v.join(r, "uid")
    else:
        raise ValueError(f"fit must be box or sphere, not {fit}")
    scale = F.when(F.col("_span") > 0, F.col("_span") / (2.0 * extent)).otherwise(F.raise_error(F.lit("mesh has zero extent")).cast("double"))
    return v.select("uid", "vid", *[(off[c] / scale).alias(c) for c in ("x", "y", "z")])


def fragments(vertices: DataFrame, faces: DataFrame, cameras: DataFrame, res: int, keep: DataFrame | None = None) -> DataFrame:
    """(uid, view, y, x, fid, b0, b1, b2, z): the nearest face at each pixel; equal depth (to 9 places) goes to the lower face.

    keep (uid, fid) restricts the faces. Back faces are not culled. The corners of a face are joined once; every view
    (a handful of cameras, which are broadcast) then projects them by arithmetic, so only fragments are shuffled.
    """
    if keep is not None:
        faces = faces.join(keep, ["uid", "fid"], "left_semi")
    t = corner_columns(faces, vertices, ["a", "b", "c"], "vid", ["x", "y", "z"], ["uid"]).withColumnsRenamed({f"{c}{k}": f"v{c}{k}" for c in "xyz" for k in range(3)})
    t = t.crossJoin(F.broadcast(cameras))

    def dot(axis: str, k: int) -> Column:
        return sum((F.col(f"{axis}{c}") * (F.col(f"v{c}{k}") - F.col(f"o{c}")) for c in "yz"), F.col(f"{axis}x") * (F.col(f"vx{k}") - F.col("ox")))

    corners = [x for k in range(3) for x in (((dot("r", k) * 0.5 + 0.5) * float(res)).alias(f"px{k}"), ((1.0 - (dot("u", k) * 0.5 + 0.5)) * float(res)).alias(f"py{k}"), (-dot("k", k)).alias(f"depth{k}"))]
    c = cells(t.select("uid", "view", "fid", *corners), res, res, ["uid", "view"], shared_edges=True, margin=True)
    z = F.col("depth0") * F.col("b0") + F.col("depth1") * F.col("b1") + F.col("depth2") * F.col("b2")
    # depth (9 places) and face as one number, so that fragments merge in a hash table instead of being sorted
    face = F.when(F.col("fid") < _FACES, F.col("fid")).otherwise(F.raise_error(F.lit("too many faces in a mesh")).cast("long"))
    c = c.withColumn("near", F.round(F.round(z, 9) * 1e9).cast("long") * _FACES + face)
    first = c.groupBy("uid", "view", "y", "x").agg(F.min("near").alias("near"), *[F.min_by(b, "near").alias(b) for b in ("b0", "b1", "b2")])
    return first.select("uid", "view", "y", "x", F.pmod("near", F.lit(_FACES)).alias("fid"), "b0", "b1", "b2", (F.floor(F.col("near") / _FACES) / 1e9).alias("z"))


#: Faces a mesh may have in a view, and with them the depths that fit beside: up to 8.5, thrice the camera's distance. More is an error.
_FACES = 1 << 30


def texel(coord: Column, size: int | Column) -> Column:
    """Nearest texel of a coordinate in [0, 1]: halves to even, clamped."""
    n = F.lit(size) if isinstance(size, int) else size
    return F.least(F.greatest(F.rint(coord * (n - 1)).cast("int"), F.lit(0)), (n - 1).cast("int"))


def emission(frags: DataFrame, uv_vertices: DataFrame, uv_faces: DataFrame, pixels: DataFrame, width: int | Column, height: int | Column, flipped: bool | None = False) -> DataFrame:
    """(uid, view, y, x, r, g, b): each fragment with the texel its face shows. pixels(uid, y, x, r, g, b).

    flipped samples the texture upside down; the fragments stay. With None both ways are taken in one pass, told apart
    by a column `flipped`. width and height may be columns of the fragments.
    """
    uv = corner_columns(uv_faces, uv_vertices, ["ta", "tb", "tc"], "tid", ["u", "v"], ["uid"])
    j = frags.join(uv, ["uid", "fid"])
    at = lambda c: F.col(f"{c}0") * F.col("b0") + F.col(f"{c}1") * F.col("b1") + F.col(f"{c}2") * F.col("b2")
    h = F.lit(height) if isinstance(height, int) else height
    ty = texel(at("v"), height)
    ways = [F.struct(F.lit(way).alias("flipped"), ((h - 1).cast("int") - ty if way else ty).alias("ty")) for way in ((False, True) if flipped is None else (flipped,))]
    j = j.select("uid", "view", "y", "x", texel(at("u"), width).alias("tx"), F.explode(F.array(*ways)).alias("way")).select("uid", "view", "y", "x", "tx", "way.*")
    p = pixels.select("uid", F.col("y").alias("ty"), F.col("x").alias("tx"), "r", "g", "b")
    return j.join(p, ["uid", "ty", "tx"]).select("uid", "view", "y", "x", *(["flipped"] if flipped is None else []), "r", "g", "b")


def shaded(frags: DataFrame, vertices: DataFrame, faces: DataFrame, cameras: DataFrame, base: int = 235, ambient: float = 0.18) -> DataFrame:
    """(uid, view, y, x, grey): flat shading by the face normal against the view and an off-axis light in camera space."""
    t = corner_columns(faces, vertices, ["a", "b", "c"], "vid", ["x", "y", "z"], ["uid"])
    e = lambda c, k: F.col(f"{c}{k}") - F.col(f"{c}0")
    n = {"nx": e("y", 1) * e("z", 2) - e("z", 1) * e("y", 2), "ny": e("z", 1) * e("x", 2) - e("x", 1) * e("z", 2), "nz": e("x", 1) * e("y", 2) - e("y", 1) * e("x", 2)}
    t = t.select("uid", "fid", *[c.alias(k) for k, c in n.items()])
    size = F.greatest(F.sqrt(F.col("nx") * F.col("nx") + F.col("ny") * F.col("ny") + F.col("nz") * F.col("nz")), F.lit(1e-12))
    t = t.select("uid", "fid", *[(F.col(k) / size).alias(k) for k in n])
    j = frags.join(t, ["uid", "fid"]).join(F.broadcast(cameras), "view")
    light = _unit(KEY_LIGHT)
    head = F.abs(F.col("nx") * F.col("kx") + F.col("ny") * F.col("ky") + F.col("nz") * F.col("kz"))
    world = {c: F.col(f"r{c}") * light[0] + F.col(f"u{c}") * light[1] + F.col(f"k{c}") * light[2] for c in "xyz"}
    key = F.greatest(F.col("nx") * world["x"] + F.col("ny") * world["y"] + F.col("nz") * world["z"], F.lit(0.0))
    shade = F.least(F.greatest(F.lit(ambient) + head * 0.45 + key * 0.37, F.lit(0.0)), F.lit(1.0))
    return j.select("uid", "view", "y", "x", F.rint(shade * base).cast("int").alias("grey"))


def sheet_tiles(pixels: DataFrame, size: DataFrame, rows: int = 2, cols: int = 3) -> DataFrame:
    """Pixels of a sheet with their tile in reading order and the place in it; what does not divide is dropped. size(uid, h, w)."""
    p = pixels.join(size, "uid").withColumns({"th": F.floor(F.col("h") / rows).cast("int"), "tw": F.floor(F.col("w") / cols).cast("int")})
    p = p.withColumns({"ti": F.floor(F.col("y") / F.col("th")).cast("int"), "tj": F.floor(F.col("x") / F.col("tw")).cast("int")})
    p = p.filter((F.col("ti") < rows) & (F.col("tj") < cols))
    return p.select("uid", (F.col("ti") * cols + F.col("tj")).alias("tile"), F.pmod("y", "th").alias("y"), F.pmod("x", "tw").alias("x"), "r", "g", "b", "th", "tw")


def tile_foreground(tiles: DataFrame, keys: list[str], delta: int = 12, corner: int = 4) -> DataFrame:
    """Pixels that differ from the background by more than delta; the background is the median of the first and last corner.

    tiles carry their height and width as th and tw.
    """
    first = (F.col("y") < corner) & (F.col("x") < corner)
    last = (F.col("y") >= F.col("th") - corner) & (F.col("x") >= F.col("tw") - corner)
    bg = tiles.filter(first | last).withColumn("_n", F.when(first & last, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).withColumn("_k", F.explode("_n"))
    bg = bg.groupBy(*keys).agg(*[F.median(c).alias(f"bg_{c}") for c in "rgb"])
    far = F.greatest(*[F.abs(F.col(c) - F.col(f"bg_{c}")) for c in "rgb"])
    return tiles.join(bg, keys).withColumn("fg", far > delta).drop("bg_r", "bg_g", "bg_b")
