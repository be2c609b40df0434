"""Image operators over long pixel relations (img, y, x, r, g, b) with a valid mask.

Nearest-texel search is separable: windows down each column find the nearest valid row, then each row is settled
from its columns. Ties go to the smallest (distance, y, x).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.session import fits

#: Fixed value: what a digest of delivered bytes starts with.
DIGEST_PREFIX = "delivered-v1|"


def column_nearest(grid: DataFrame) -> DataFrame:
    """(img, y, x, valid, ny): the nearest valid row in each texel's column, the upper one of two; null where there is none."""
    w = Window.partitionBy("img", "x").orderBy("y")
    own = F.when(F.col("valid"), F.col("y"))
    up = F.last(own, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    down = F.first(own, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    near = F.when(up.isNull() | ((down - F.col("y")) < (F.col("y") - up)), down).otherwise(up)
    return grid.select("img", "y", "x", "valid", near.alias("ny"))


def nearest_within(grid: DataFrame, margin: int) -> DataFrame:
    """(img, y, x, ny, nx, d2) of each invalid texel with a valid one within `margin`: 2 margin + 1 columns are looked at."""
    c = column_nearest(grid)
    src = c.filter(F.abs(F.col("ny") - F.col("y")) <= margin).select("img", "y", F.col("x").alias("nx"), "ny")
    spread = src.withColumn("x", F.explode(F.transform(F.sequence(F.lit(-margin), F.lit(margin)), lambda k: F.col("nx") + k)))
    d2 = (F.col("x") - F.col("nx")) * (F.col("x") - F.col("nx")) + (F.col("y") - F.col("ny")) * (F.col("y") - F.col("ny"))
    best = spread.withColumn("d2", d2).filter(F.col("d2") <= margin * margin).groupBy("img", "y", "x").agg(F.min(F.struct("d2", "ny", "nx")).alias("t"))
    return grid.filter(~F.col("valid")).select("img", "y", "x").join(best, ["img", "y", "x"]).select("img", "y", "x", "t.ny", "t.nx", "t.d2")


def _least_in_row(x: list[int], dy2: list[int], rank: list[int], at: list[int]) -> list[int]:
    """For each ascending `at` the candidate with the least (squared distance, rank): lower envelope of parabolas, in whole numbers.

    x ascends. Cost and rank are one number, scale * distance + rank; curvatures are equal, so the envelope is one of lines.
    """
    scale = len(x) + 1
    cost = [scale * (a * a + d) + r for a, d, r in zip(x, dy2, rank)]
    hull: list[int] = []
    for i in range(len(x)):
        while len(hull) > 1:
            a, b = hull[-2], hull[-1]
            if (cost[i] - cost[a]) * (x[b] - x[a]) > (cost[b] - cost[a]) * (x[i] - x[a]):
                break
            hull.pop()
        hull.append(i)
    out, k = [], 0
    for q in at:
        turn = 2 * scale * q
        while k + 1 < len(hull) and cost[hull[k + 1]] - turn * x[hull[k + 1]] < cost[hull[k]] - turn * x[hull[k]]:
            k += 1
        out.append(hull[k])
    return out


def _row_nearest(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settles whole rows of an image: for each texel the nearest of the row's column candidates, in time linear in the row."""
    for b in it:
        for img, y, xs, nys, inv in zip(b.column("img").to_pylist(), b.column("y").to_pylist(), b.column("xs").to_pylist(), b.column("nys").to_pylist(), b.column("todo").to_pylist()):
            if not xs or not inv:
                continue
            x, ny = np.array(xs, np.int64), np.array(nys, np.int64)
            order = np.argsort(x)
            x, ny, at = x[order], ny[order], np.sort(np.array(inv, np.int64))
            rank = np.empty(len(x), np.int64)
            rank[np.lexsort((x, ny))] = np.arange(len(x))
            best = np.array(_least_in_row(x.tolist(), ((ny - y) ** 2).tolist(), rank.tolist(), at.tolist()))
            n = len(at)
            d2 = (ny[best] - y) ** 2 + (x[best] - at) ** 2
            yield pa.RecordBatch.from_arrays([pa.array([img] * n, b.column("img").type), pa.array([y] * n, pa.int32()), *[pa.array(v.astype(np.int32)) for v in (at, ny[best], x[best], d2)]], ["img", "y", "x", "ny", "nx", "d2"])


def nearest_valid(grid: DataFrame) -> DataFrame:
    """(img, y, x, ny, nx, d2) of every invalid texel, at any distance; images without valid texels have none. A task holds single rows of an image."""
    c = column_nearest(grid)
    g = c.groupBy("img", "y").agg(
        F.collect_list(F.when(F.col("ny").isNotNull(), F.struct("x", "ny"))).alias("c"),
        F.collect_list(F.when(~F.col("valid"), F.col("x"))).alias("todo"),
    )
    kind = "string" if grid.schema["img"].dataType.simpleString() == "string" else "long"
    rows = g.select(F.col("img").cast(kind).alias("img"), F.col("y").cast("int").alias("y"), F.transform("c", lambda s: s["x"].cast("int")).alias("xs"), F.transform("c", lambda s: s["ny"].cast("int")).alias("nys"), F.transform("todo", lambda x: x.cast("int")).alias("todo"))
    return rows.mapInArrow(_row_nearest, f"img {kind}, y int, x int, ny int, nx int, d2 int")


def _colour_of(near: DataFrame, pixels: DataFrame) -> DataFrame:
    p = pixels.select("img", F.col("y").alias("ny"), F.col("x").alias("nx"), "r", "g", "b")
    return near.join(p, ["img", "ny", "nx"]).select("img", "y", "x", "r", "g", "b")


def margin_ring(pixels: DataFrame, grid: DataFrame, margin: int = 4, bg: int = 0) -> DataFrame:
    """Islands, a ring of their nearest colours up to `margin` around them, the background colour beyond."""
    base = pixels.join(grid, ["img", "y", "x"])
    ring = _colour_of(nearest_within(grid, margin), pixels).select("img", "y", "x", *[F.col(c).alias(f"n{c}") for c in "rgb"])
    return base.join(ring, ["img", "y", "x"], "left").select("img", "y", "x", *[F.when(F.col("valid"), F.col(c)).otherwise(F.coalesce(f"n{c}", F.lit(bg))).cast("int").alias(c) for c in "rgb"])


def dilate_full(pixels: DataFrame, grid: DataFrame) -> DataFrame:
    """Every invalid texel takes the colour of the nearest valid one; images without any turn black."""
    near = _colour_of(nearest_valid(grid), pixels).select("img", "y", "x", *[F.col(c).alias(f"n{c}") for c in "rgb"])
    base = pixels.join(grid, ["img", "y", "x"]).join(near, ["img", "y", "x"], "left")
    return base.select("img", "y", "x", *[F.when(F.col("valid"), F.col(c)).otherwise(F.coalesce(f"n{c}", F.lit(0))).cast("int").alias(c) for c in "rgb"])


def ring_mask(grid: DataFrame, margin: int = 4) -> DataFrame:
    """Invalid texels within `margin` of a valid one."""
    return nearest_within(grid, margin).select("img", "y", "x")


def ring_consistency(pixels: DataFrame, grid: DataFrame, margin: int = 4, far: int = 8) -> DataFrame:
    """Per image: mean difference of ring texels from their nearest valid colour, mean of the background beyond `far`, ring texels."""
    near = nearest_valid(grid)
    src = pixels.select("img", F.col("y").alias("ny"), F.col("x").alias("nx"), *[F.col(c).alias(f"n{c}") for c in "rgb"])
    j = near.join(src, ["img", "ny", "nx"]).join(pixels, ["img", "y", "x"])
    ring, beyond = F.col("d2") <= margin * margin, F.col("d2") > far * far
    diff = sum((F.abs(F.col(c) - F.col(f"n{c}")) for c in "gb"), F.abs(F.col("r") - F.col("nr"))).cast("long")
    total = (F.col("r") + F.col("g") + F.col("b")).cast("long")
    g = j.groupBy("img").agg(F.sum(F.when(ring, diff)).alias("d"), F.count_if(ring).alias("n"), F.sum(F.when(beyond, total)).alias("t"), F.count_if(beyond).alias("m"))
    some = grid.groupBy("img").agg(F.bool_or("valid").alias("_some"))
    out = some.join(g, "img", "left")
    share = lambda s, n: F.coalesce(F.round(F.try_divide(F.col(s), F.col(n) * 3), 4), F.lit(0.0))
    return out.select("img", share("d", "n").alias("ring_difference"), share("t", "m").alias("far_background"), F.coalesce("n", F.lit(0)).alias("ring_texels"))


def kernel_weights(src: int, dst: int, kernel: str = "lanczos") -> list[tuple[int, int, int, int]]:
    """(src, dst index, source index, weight): fixed-point weights (22 bits) of a separable resize."""
    def lanczos(x: float) -> float:
        if x == 0.0:
            return 1.0
        if not -3.0 < x < 3.0:
            return 0.0
        a, b = math.pi * x, math.pi * x / 3.0
        return math.sin(a) / a * math.sin(b) / b

    def cubic(x: float, a: float = -0.5) -> float:
        x = abs(x)
        if x < 1.0:
            return ((a + 2.0) * x - (a + 3.0)) * x * x + 1
        return (((x - 5) * x + 8) * x - 4) * a if x < 2.0 else 0.0

    f, reach = (lanczos, 3.0) if kernel == "lanczos" else (cubic, 2.0)
    scale = src / dst
    stretch = max(scale, 1.0)
    out = []
    for i in range(dst):
        centre = (i + 0.5) * scale
        lo, hi = max(int(centre - reach * stretch + 0.5), 0), min(int(centre + reach * stretch + 0.5), src)
        w = [f((k - centre + 0.5) / stretch) for k in range(lo, hi)]
        total = sum(w)
        for k, v in zip(range(lo, hi), w):
            x = v / total * (1 << 22)
            out.append((src, i, k, int(x + 0.5) if x >= 0 else int(x - 0.5)))
    return out


def sizes(pixels: DataFrame) -> DataFrame:
    """(img, h, w) of each image."""
    return pixels.groupBy("img").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))


def resized(pixels: DataFrame, size: int, kernel: str = "lanczos", dims: DataFrame | None = None) -> DataFrame:
    """Each image at size x size: two passes of a join with the weights of its own height and width, rounded to bytes in between.

    dims (img, h, w) is taken where it is known, else worked out. The weights are a table by distinct image size, made
    where it is needed; it is broadcast for up to 64 sizes, which is counted first.
    """
    dims = sizes(pixels) if dims is None else dims
    distinct = dims.select(F.explode(F.array("h", "w")).alias("n")).distinct()

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for n in b.column("n").to_pylist():
                cols = list(zip(*kernel_weights(n, size, kernel)))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int32()) for c in cols[:3]], pa.array(cols[3], pa.int64())], ["n", "dst", "src", "k"])

    weights = distinct.mapInArrow(rows, "n int, dst int, src int, k long")
    if fits(distinct, 64):
        weights = F.broadcast(weights)
    byte = lambda c: F.least(F.greatest(F.shiftright(F.sum(F.col(c).cast("long") * F.col("k")) + F.lit(1 << 21), 22), F.lit(0)), F.lit(255)).cast("int").alias(c)
    p = pixels.join(dims, "img")
    wide = p.join(weights, (p.w == weights.n) & (p.x == weights.src)).groupBy("img", "h", "y", "dst").agg(*[byte(c) for c in "rgb"]).withColumnRenamed("dst", "nx")
    tall = wide.join(weights, (wide.h == weights.n) & (wide.y == weights.src)).groupBy("img", "dst", "nx").agg(*[byte(c) for c in "rgb"])
    return tall.select("img", F.col("dst").alias("y"), F.col("nx").alias("x"), "r", "g", "b")


def mask_resized(grid: DataFrame, size: int, dims: DataFrame) -> DataFrame:
    """The mask at size x size by the texel under each centre, so that it stays a mask."""
    at = lambda c, n: F.floor((F.col(c) + 0.5) * F.col(n) / F.lit(float(size))).cast("int")
    cells = dims.withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(size - 1)))).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
    want = cells.select("img", F.col("y").alias("oy"), F.col("x").alias("ox"), at("y", "h").alias("y"), at("x", "w").alias("x"))
    return want.join(grid, ["img", "y", "x"]).select("img", F.col("oy").alias("y"), F.col("ox").alias("x"), "valid")


def delivered(pixels: DataFrame, grid: DataFrame, size: int, margin: int = 4) -> DataFrame:
    """The delivered texture: dilate, then resize, then resample the mask, then the margin; the order is what keeps black out of the seams."""
    dims = sizes(grid)
    small = resized(dilate_full(pixels, grid), size, dims=dims)
    return margin_ring(small, mask_resized(grid, size, dims), margin)


def digest(pixels: DataFrame) -> DataFrame:
    """(img, digest) over the bytes of each image, rows first; an image is at most one task's row."""
    h = F.lower(F.concat(*[F.lpad(F.hex(F.col(c).cast("long")), 2, "0") for c in "rgb"]))
    g = pixels.groupBy("img").agg(F.array_sort(F.collect_list(F.struct("y", "x", h.alias("h")))).alias("p"))
    return g.select("img", F.concat(F.lit(DIGEST_PREFIX), F.substring(F.sha2(F.unhex(F.array_join(F.transform("p", lambda s: s["h"]), "")), 256), 1, 16)).alias("digest"))


def sampled_families(texels: DataFrame, uv_vertices: DataFrame, uv_faces: DataFrame, pixels: DataFrame) -> DataFrame:
    """Every family's texels read out of the primary texture: (uid, family, i, r, g, b), black where the face does not exist.

    texels(uid, family, i, face_id, b0, b1, b2), uv_vertices(uid, tid, u, v), uv_faces(uid, fid, ta, tb, tc), pixels(uid, y, x,
    r, g, b); all joins are on the object. Objects without pixels have no rows.
    """
    from lamina.operators.raster import corner_columns
    from lamina.operators.view import texel

    uv = corner_columns(uv_faces, uv_vertices, ["ta", "tb", "tc"], "tid", ["u", "v"], ["uid"]).withColumnRenamed("fid", "face_id")
    size = pixels.groupBy("uid").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    at = lambda c: F.col(f"{c}0") * F.col("b0") + F.col(f"{c}1") * F.col("b1") + F.col(f"{c}2") * F.col("b2")
    t = texels.join(size, "uid").join(uv, ["uid", "face_id"], "left").select("uid", "family", "i", texel(at("v"), F.col("h")).alias("ty"), texel(at("u"), F.col("w")).alias("tx"), at("u").isNotNull().alias("there"))
    p = pixels.select("uid", F.col("y").alias("ty"), F.col("x").alias("tx"), "r", "g", "b")
    return t.join(p, ["uid", "ty", "tx"], "left").select("uid", "family", "i", *[F.when(F.col("there"), F.coalesce(c, F.lit(0))).otherwise(0).cast("int").alias(c) for c in "rgb"])
