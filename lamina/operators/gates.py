"""Ordered quality verdicts over measurement rows, their replay under other thresholds, and summaries."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Thresholds:
    """The limits of the gates; a missing key of a configuration has these values. Names and numbers are fixed values."""

    dark_luma_max: int = 12
    fail_dark_frac: float = 0.40
    smear_dark_frac: float = 0.15
    smear_max_blob: float = 0.50
    ref_dark_luma_max: int = 60
    ref_dark_frac_legit: float = 0.15
    ref_foreground_min_px: int = 500
    ref_background_delta: int = 40
    g3_fail_below: float = 0.35
    g3_log_above: float = 0.80
    g4_min_iou: float = 0.90
    g4_regression_tolerance: float = 0.005
    g5_min_valid_views: int = 3
    g6_max_bad_fraction: float = 0.001
    g7_max_ring_difference: float = 2.0
    g8_min_psnr: float = 8.0
    g8_flip_margin: float = 3.0
    g8_ambiguity_margin: float = 1.0
    g8_ambiguity_min_psnr: float = 15.0
    g8_missing_is_failure: bool = True


#: The verdicts in the order in which the gates are asked.
VERDICTS = ["FAIL:ERROR", "FAIL:G1_MISSING", "FAIL:G1_DARK_NO_GAIN", "FAIL:G1_DARK_SMEAR", "FAIL:G8_MISSING", "FAIL:G8_VIEW_MISMATCH", "FAIL:G3_ALBEDO_BAND", "FAIL:G4_FRAME", "FAIL:G5_GOLDEN", "FAIL:G6_CROSS_FAMILY", "FAIL:G7_MARGIN_RING", "PASS"]


def num(c: Column) -> Column:
    """A number, or null where it is missing, no number or NaN; numbers written as text count, infinities stay."""
    d = c.try_cast("double")
    return F.when(~F.isnan(d), d)


def _limits(t: Thresholds | None) -> dict[str, Column]:
    """The thresholds as literals, or as columns of the same names."""
    return {f.name: F.lit(getattr(t, f.name)) if t else F.col(f.name) for f in fields(Thresholds)}


def failures(t: Thresholds | None = None) -> list[Column]:
    """One predicate per verdict but the last, in order; each may lean on the earlier ones being false. None is never null."""
    x = _limits(t)
    dark, blob, ref = num(F.col("g1_dark_frac")), F.coalesce(num(F.col("g1_max_blob")), F.lit(0.0)), num(F.col("g1_ref_dark"))
    psnr, flip = num(F.col("g8_psnr")), F.coalesce(num(F.col("g8_psnr_flip")), F.lit(-1.0))
    ratio, iou, orig = num(F.col("g3_ratio")), num(F.col("g4_iou_min")), num(F.col("g4_iou_orig"))
    spared = F.coalesce(ref >= x["ref_dark_frac_legit"], F.lit(False)) | F.coalesce(F.col("g1_bless"), F.lit(False))
    tests = [
        F.col("error") != "",
        dark.isNull(),
        ~spared & (dark > x["fail_dark_frac"]),
        ~spared & (dark > x["smear_dark_frac"]) & (blob > x["smear_max_blob"]),
        psnr.isNull() & x["g8_missing_is_failure"],
        (flip >= psnr + x["g8_flip_margin"]) | ((flip >= psnr - x["g8_ambiguity_margin"]) & (psnr < x["g8_ambiguity_min_psnr"])) | (psnr < x["g8_min_psnr"]),
        (F.coalesce(F.col("g3_note"), F.lit("")) == "") & (ratio < x["g3_fail_below"]),
        iou.isNull() | ((iou < x["g4_min_iou"]) & (orig.isNull() | (iou < orig - x["g4_regression_tolerance"]))),
        F.col("g5_valid_views").isNull() | (F.col("g5_valid_views").cast("int") < x["g5_min_valid_views"]),
        num(F.col("g6_bad_fraction")) > x["g6_max_bad_fraction"],
        num(F.col("g7_ring_difference")) > x["g7_max_ring_difference"],
    ]
    return [F.coalesce(c, F.lit(False)) for c in tests]


def verdict(t: Thresholds | None = None) -> Column:
    """The first gate that fails, or PASS."""
    out = None
    for name, test in zip(VERDICTS, failures(t)):
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(VERDICTS[-1])


def _fixed(name: str, places: int) -> Column:
    """The number with so many places as text, halves upwards by magnitude, inf from 1e12 on; nothing where it is missing."""
    c = num(F.col(name))
    n = F.floor(F.abs(c) * F.lit(float(10**places)) + F.lit(0.5)).cast("bigint")
    digits = F.concat(F.floor(n / 10**places).cast("string"), F.lit("."), F.lpad((n % 10**places).cast("string"), places, "0"))
    return F.concat(F.when(c < 0, "-").otherwise(""), F.when(F.abs(c) < F.lit(1e12), digits).when(c.isNotNull(), "inf"))


def reasons(t: Thresholds = Thresholds()) -> Column:
    """What the failing gate saw, as text: empty for PASS. A view mismatch says which of its three rules was met first."""
    x = _limits(t)
    psnr, flip, iou, orig = num(F.col("g8_psnr")), F.coalesce(num(F.col("g8_psnr_flip")), F.lit(-1.0)), "g4_iou_min", num(F.col("g4_iou_orig"))
    mismatch = F.when(flip >= psnr + x["g8_flip_margin"], "upside down fits better").when((flip >= psnr - x["g8_ambiguity_margin"]) & (psnr < x["g8_ambiguity_min_psnr"]), "either way up fits badly").otherwise("no fit")
    framing = F.when(num(F.col(iou)).isNull(), "iou missing").when(orig.isNull(), F.concat(F.lit("iou "), _fixed(iou, 3), F.lit(", original unknown"))).otherwise(F.concat(F.lit("iou "), _fixed(iou, 3), F.lit(", original "), _fixed("g4_iou_orig", 3)))
    texts = [
        F.col("error"),
        F.lit("g1_dark_frac is missing"),
        F.concat(F.lit("dark "), _fixed("g1_dark_frac", 3), F.lit(", reference not dark")),
        F.concat(F.lit("dark "), _fixed("g1_dark_frac", 3), F.lit(", blob "), _fixed("g1_max_blob", 2)),
        F.lit("g8_psnr is missing"),
        F.concat(mismatch, F.lit(": psnr "), _fixed("g8_psnr", 1), F.lit(", flipped "), F.coalesce(_fixed("g8_psnr_flip", 1), F.lit("-1.0"))),
        F.concat(F.lit("albedo ratio "), _fixed("g3_ratio", 2)),
        framing,
        F.concat(F.lit("valid views "), F.coalesce(F.col("g5_valid_views").cast("string"), F.lit("missing"))),
        F.concat(F.lit("bad fraction "), _fixed("g6_bad_fraction", 4)),
        F.concat(F.lit("ring difference "), _fixed("g7_ring_difference", 2)),
    ]
    out = None
    for test, text in zip(failures(t), texts):
        out = F.when(test, F.array(text)) if out is None else out.when(test, F.array(text))
    return out.otherwise(F.array().cast("array<string>"))


def logged(t: Thresholds = Thresholds()) -> Column:
    """The numbers that were looked at, as a map: a gate's numbers once it was asked, the framing ones once it was passed, the dark share on PASS.

    The share of the reference and the original framing stay as null where they are missing; the other numbers are
    left out. A ratio above g3_log_above is repeated as g3_high_side.
    """
    x = _limits(t)
    at = None
    for i, test in enumerate(failures(t)):
        at = F.when(test, i) if at is None else at.when(test, i)
    at = at.otherwise(len(VERDICTS) - 1)
    psnr, ratio = num(F.col("g8_psnr")), num(F.col("g3_ratio"))
    asked = {v: at >= i for i, v in enumerate(VERDICTS)}
    banded = asked["FAIL:G3_ALBEDO_BAND"] & (F.coalesce(F.col("g3_note"), F.lit("")) == "") & ratio.isNotNull()
    entries = [
        ("g1_ref_dark", asked["FAIL:G1_DARK_NO_GAIN"], num(F.col("g1_ref_dark"))),
        ("g8_psnr", asked["FAIL:G8_VIEW_MISMATCH"] & psnr.isNotNull(), psnr),
        ("g8_psnr_flip", asked["FAIL:G8_VIEW_MISMATCH"] & psnr.isNotNull(), F.coalesce(num(F.col("g8_psnr_flip")), F.lit(-1.0))),
        ("g3_ratio", banded, ratio),
        ("g3_high_side", banded & asked["FAIL:G4_FRAME"] & (ratio > x["g3_log_above"]), ratio),
        ("g4_iou_min", asked["FAIL:G5_GOLDEN"], num(F.col("g4_iou_min"))),
        ("g4_iou_orig", asked["FAIL:G5_GOLDEN"], num(F.col("g4_iou_orig"))),
        ("g1_dark_frac", asked["PASS"], num(F.col("g1_dark_frac"))),
    ]
    return F.map_from_entries(F.array_compact(F.array(*[F.when(when, F.struct(F.lit(k).alias("k"), v.alias("v"))) for k, when, v in entries])))


def judged(rows: DataFrame, t: Thresholds = Thresholds(), keep: list[str] | None = None) -> DataFrame:
    return rows.select(*(keep or rows.columns), verdict(t).alias("verdict"))


def summary(verdicts: DataFrame) -> DataFrame:
    """Rows per verdict and, as verdict null, over all, with the share of PASS."""
    g = verdicts.rollup("verdict").agg(F.count("*").alias("n"), F.count_if(F.col("verdict") == "PASS").alias("passed"))
    return g.select("verdict", "n", F.round(F.try_divide(F.col("passed"), F.col("n")), 4).alias("pass_rate"))


def threshold_sets(spark: SparkSession, sets: dict[str, Thresholds]) -> DataFrame:
    """Named sets of thresholds as rows: as many as an operator names."""
    names = [f.name for f in fields(Thresholds)]
    return spark.createDataFrame([(k, *[asdict(t)[n] for n in names]) for k, t in sets.items()], ["threshold_set", *names])


def replay(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Verdict counts of all rows under each set of thresholds; the sets are a broadcast handful."""
    return rows.crossJoin(F.broadcast(sets)).select("threshold_set", verdict().alias("verdict")).groupBy("threshold_set", "verdict").agg(F.count("*").alias("n"))


def unmeasured_counts(rows: DataFrame) -> DataFrame:
    """How many rows name each field as unmeasured."""
    return rows.select(F.explode("unmeasured").alias("field")).groupBy("field").agg(F.count("*").alias("n"))
