"""Measures over pixel relations: dark coverage and blobs, witness, PSNR, agreement, silhouettes, families."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PSNR_CEILING = 99.0


def dark_coverage(pixels: DataFrame, grid: DataFrame, luma_max: int = 12) -> DataFrame:
    """(img, g1_dark_frac, g1_valid_texels): share of valid texels whose largest channel is below luma_max; 0 without valid texels."""
    j = pixels.join(grid, ["img", "y", "x"])
    dark = F.col("valid") & (F.greatest("r", "g", "b") < luma_max)
    g = j.groupBy("img").agg(F.count_if(dark).alias("d"), F.count_if("valid").alias("v"))
    return g.select("img", F.coalesce(F.round(F.try_divide(F.col("d"), F.col("v")), 4), F.lit(0.0)).alias("g1_dark_frac"), F.col("v").alias("g1_valid_texels"))


def label(ys: np.ndarray, xs: np.ndarray) -> np.ndarray:
    """Component number (4 neighbours) of each texel, by least label with pointer jumping."""
    n = len(ys)
    order = np.lexsort((xs, ys))
    y, x = ys[order], xs[order]
    right = np.flatnonzero((y[1:] == y[:-1]) & (x[1:] == x[:-1] + 1))
    key, want = y * (1 << 32) + x, (y + 1) * (1 << 32) + x
    at = np.searchsorted(key, want)
    down = np.flatnonzero((at < n) & (key[np.minimum(at, n - 1)] == want))
    a, b = np.concatenate([right, down]), np.concatenate([right + 1, at[down]])
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        nxt = root.copy()
        np.minimum.at(nxt, root[a], low)
        np.minimum.at(nxt, root[b], low)
        nxt = nxt[nxt]
        while not np.array_equal(nxt, nxt[nxt]):
            nxt = nxt[nxt]
        nxt = nxt[root]
        if np.array_equal(nxt, root):
            break
        root = nxt
    out = np.empty(n, np.int64)
    out[order] = root
    return out


def _components(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        for img, ys, xs in zip(b.column("img").to_pylist(), b.column("ys").to_pylist(), b.column("xs").to_pylist()):
            sizes = np.bincount(np.unique(label(np.array(ys, np.int64), np.array(xs, np.int64)), return_inverse=True)[1])
            yield pa.RecordBatch.from_arrays([pa.array([img], b.column("img").type), pa.array([len(sizes)], pa.int64()), pa.array([int(sizes.max())], pa.int64()), pa.array([int(sizes.sum())], pa.int64())], ["img", "blobs", "largest", "dark"])


def dark_blobs(pixels: DataFrame, grid: DataFrame, luma_max: int = 12) -> DataFrame:
    """(img, blobs, largest, dark, g1_max_blob) of images with dark valid texels. One image's dark texels are one task's row."""
    dark = pixels.join(grid.filter("valid"), ["img", "y", "x"]).filter(F.greatest("r", "g", "b") < luma_max)
    kind = "string" if pixels.schema["img"].dataType.simpleString() == "string" else "long"
    g = dark.groupBy(F.col("img").cast(kind).alias("img")).agg(F.collect_list(F.struct(F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"))).alias("p"))
    g = g.select("img", F.transform("p", lambda s: s["y"]).alias("ys"), F.transform("p", lambda s: s["x"]).alias("xs"))
    out = g.mapInArrow(_components, f"img {kind}, blobs long, largest long, dark long")
    return out.withColumn("g1_max_blob", F.round(F.col("largest") / F.col("dark"), 3))


def reference_dark(pixels: DataFrame, dims: DataFrame, luma_max: int = 60, delta: int = 40, least_px: int = 500) -> DataFrame:
    """(img, g1_ref_dark, g1_ref_foreground_px): share of the subject that is dark; null where the subject is too small.

    The background is the median of four corner blocks of max(4, min(h, w) div 32) pixels; overlapping blocks count twice.
    """
    p = pixels.join(dims, "img").withColumn("k", F.greatest(F.lit(4), F.floor(F.least("h", "w") / 32).cast("int")))
    top, bottom = F.col("y") < F.col("k"), F.col("y") >= F.col("h") - F.col("k")
    left, right = F.col("x") < F.col("k"), F.col("x") >= F.col("w") - F.col("k")
    times = sum(((a & b).cast("int") for a, b in ((bottom, right), (top, right), (bottom, left))), (top & left).cast("int"))
    bg = p.withColumn("times", times).filter("times > 0").withColumn("_r", F.explode(F.sequence(F.lit(1), F.col("times")))).groupBy("img").agg(*[F.median(c).alias(f"bg_{c}") for c in "rgb"])
    j = pixels.join(bg, "img").withColumn("fg", F.greatest(*[F.abs(F.col(c) - F.col(f"bg_{c}")) for c in "rgb"]) > delta)
    g = j.groupBy("img").agg(F.count_if("fg").alias("n"), F.count_if(F.col("fg") & (F.greatest("r", "g", "b") < luma_max)).alias("d"))
    return g.select("img", F.when(F.col("n") >= least_px, F.round(F.col("d") / F.col("n"), 4)).alias("g1_ref_dark"), F.col("n").alias("g1_ref_foreground_px"))


def psnr(squares: Column, samples: Column) -> Column:
    """PSNR from the sum of squared differences and the number of channel samples: infinite for none, null (undefined) without samples."""
    mse = squares / samples
    return F.when(samples == 0, None).when(squares == 0, F.lit(float("inf"))).otherwise(10.0 * F.log10(F.lit(65025.0) / mse))


#: Fixed value: pixels that both masks must share for a view to count.
LEAST_SHARED = 100


def compared_views(truth: DataFrame, rendered: DataFrame) -> DataFrame:
    """(uid, view, iou, psnr, psnr_flip): renders of a texture as it is and upside down against the true views.

    truth(uid, view, y, x, fg, tr, tg, tb) has every pixel of a view, rendered(uid, view, y, x, flipped, r, g, b) those a
    face covers. Colours are compared where both have the object; with fewer than LEAST_SHARED such pixels they are undefined.
    """
    at = ["uid", "view", "y", "x"]
    j = truth.join(rendered, at, "left")
    alpha = F.coalesce(~F.col("flipped"), F.lit(False))
    once = F.coalesce(~F.col("flipped"), F.lit(True))  # a covered pixel has two rows
    error = sum(((F.col(c).cast("long") - F.col(f"t{c}")) * (F.col(c).cast("long") - F.col(f"t{c}")) for c in "gb"), (F.col("r").cast("long") - F.col("tr")) * (F.col("r").cast("long") - F.col("tr")))
    both = F.col("fg") & alpha
    g = j.groupBy("uid", "view").agg(
        F.count_if(both).alias("i"),
        F.count_if(once & (F.col("fg") | alpha)).alias("u"),
        F.sum(F.when(both, error)).alias("se"),
        F.sum(F.when(F.col("fg") & F.coalesce("flipped", F.lit(False)), error)).alias("sf"),
    )
    samples = F.when(F.col("i") >= LEAST_SHARED, F.col("i") * 3).otherwise(0)
    return g.select("uid", "view", F.round(F.col("i") / F.greatest("u", F.lit(1)), 4).alias("iou"), psnr(F.col("se"), samples).alias("psnr"), psnr(F.col("sf"), samples).alias("psnr_flip"))


def agreement(views: DataFrame, key: str) -> DataFrame:
    """Median over views of the clipped PSNR, direct and flipped, and of the IoU; undefined views are skipped and counted.

    views(key, view, iou, psnr, psnr_flip).
    """
    # least() passes over nulls: an undefined view must not count as the ceiling
    clip = lambda c: F.when(F.col(c).isNotNull(), F.least(F.col(c), F.lit(PSNR_CEILING)))
    return views.groupBy(key).agg(
        F.round(F.median(clip("psnr")), 3).alias("g8_psnr"),
        F.round(F.median(clip("psnr_flip")), 3).alias("g8_psnr_flip"),
        F.count("*").alias("g8_views"),
        F.count("psnr").alias("g8_views_measured"),
        F.count_if(F.col("psnr") == float("inf")).alias("g8_exact_views"),
        F.round(F.median("iou"), 4).alias("g8_iou"),
    )


def iou(a: Column, b: Column) -> Column:
    """Aggregate: intersection over union of two boolean columns to 4 places, null for an empty union."""
    return F.round(F.try_divide(F.count_if(a & b), F.count_if(a | b)), 4)


def silhouettes(a: DataFrame, b: DataFrame, keys: list[str], threshold: int = 128) -> DataFrame:
    """(keys, iou) of two coverage masks (keys, y, x, v): a pixel counts from `threshold` on, one that a mask lacks is 0."""
    at = [*keys, "y", "x"]
    j = a.select(*at, F.col("v").alias("_a")).join(b.select(*at, F.col("v").alias("_b")), at, "full")
    on = lambda c: F.coalesce(F.col(c) >= threshold, F.lit(False))
    return j.groupBy(*keys).agg(iou(on("_a"), on("_b")).alias("iou"))


def framing(ious: DataFrame, key: str) -> DataFrame:
    """(key, g4_iou_min, g4_iou_orig, g4_views): worst IoU over the views now and originally; undefined ones are skipped."""
    return ious.groupBy(key).agg(F.min("iou").alias("g4_iou_min"), F.min("iou_orig").alias("g4_iou_orig"), F.count("*").alias("g4_views"))


def cross_family(colours: DataFrame, keys: list[str], point: str, tolerance: int = 2) -> DataFrame:
    """(keys, g6_bad_fraction, g6_points, g6_families): share of points where two families differ by more than tolerance in a channel."""
    spread = F.greatest(*[F.max(c) - F.min(c) for c in "rgb"])
    g = colours.groupBy(*keys, point).agg(spread.alias("s"), F.count_distinct("family").alias("f"))
    many = F.col("g6_families") >= 2
    h = g.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(F.col("s") > tolerance).alias("bad"), F.max("f").alias("g6_families"))
    return h.select(*keys, F.when(many, F.round(F.col("bad") / F.col("n"), 6)).otherwise(0.0).alias("g6_bad_fraction"), F.when(many, F.col("n")).otherwise(0).alias("g6_points"), "g6_families")


def family_resolve(colours: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, family, share of points that are not black)."""
    return colours.groupBy(*keys, "family").agg(F.round(F.avg((F.greatest("r", "g", "b") > 0).cast("double")), 4).alias("resolved"))
