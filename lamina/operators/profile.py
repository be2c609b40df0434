"""Column-level data quality profile: faults, shares of nulls, distincts, ranges, power sums, drift between loads.

All statistics come from one histogram per load and column, so they merge: power sums are whole numbers in units that
hold nine digits of a column's largest value, distincts are groups. Faults and shares of nulls are read off the
profile; the gap between the cumulative shares of neighbouring loads, which moments cannot bound, is exact from the
histogram, summed in ranges of values, so that no task holds a whole load.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.text import is_stand_in
from lamina.session import settled

#: Names an unmeasured list may hold.
GATE_NAMES = ["g1_ref_dark", "g3", "g4", "g5", "g6", "g7", "g8"]


@dataclass(frozen=True)
class Rule:
    """A profiled column: its fault predicate, the number that is compared between loads (None: not compared), its text form.

    plain: rows with equal numbers have equal values, so that the text is needed only where there is no number.
    """

    name: str
    fault: Column
    number: Column | None
    text: Column
    plain: bool = False


def outside(name: str, low: float, high: float) -> Column:
    """Not a number from low to high; null is no fault."""
    c = F.col(name)
    return F.coalesce(F.isnan(c) | (c < low) | (c > high), F.lit(False))


def bad_list(name: str, allowed: list[str]) -> Column:
    """Not an ascending list without repeats of allowed names; null is no fault."""
    c = F.col(name)
    known = F.forall(c, lambda x: F.coalesce(x.isin(allowed), F.lit(False)))
    return F.coalesce(~known | (c != F.array_sort(F.array_distinct(c))), F.lit(False))


def bad_text(name: str) -> Column:
    """Blank, a stand-in for a missing value, or with control or replacement characters; null is no fault."""
    c = F.col(name)
    return F.coalesce(is_stand_in(c) | c.rlike(r"[\p{Cc}\x{FFFD}]"), F.lit(False))


def measurement_rules() -> list[Rule]:
    def number(name: str, low: float, high: float) -> Rule:
        f = outside(name, low, high)
        return Rule(name, f, F.when(~f, F.col(name) + F.lit(0.0)), F.col(name).cast("string"), True)

    names = F.col("unmeasured")
    return [
        number("g1_dark_frac", 0.0, 1.0),
        number("g8_psnr", 0.0, 100.0),
        Rule("unmeasured", bad_list("unmeasured", GATE_NAMES), F.when(names.isNotNull(), F.size(names).cast("double")), F.array_join(names, "|", "")),
        Rule("error", bad_text("error"), None, F.col("error")),
    ]


def faults(df: DataFrame, rules: list[Rule], load: str = "load_id", row_id: str = "measurement_id") -> DataFrame:
    """(load, column_name, row id) of every value at fault, once however often the row is stored."""
    names = F.array_compact(F.array(*[F.when(r.fault, F.lit(r.name)) for r in rules]))
    return df.select(load, F.explode(names).alias("column_name"), row_id).distinct()


def histogram(df: DataFrame, rules: list[Rule], load: str = "load_id") -> DataFrame:
    """(load, column_name, value, missing, faulty, text_hash, rows): counts of equal values; partial sums are merged before the shuffle."""
    def one_of(r: Rule) -> Column:
        number = r.number if r.number is not None else F.lit(None).cast("double")
        unseen = r.text.isNotNull() & number.isNull() if r.plain else r.text.isNotNull()
        return F.struct(F.lit(r.name).alias("column_name"), number.alias("value"), r.text.isNull().alias("missing"), r.fault.alias("faulty"), F.when(unseen, F.unhex(F.md5(r.text))).alias("text_hash"))

    one = [one_of(r) for r in rules]
    return df.select(F.col(load).alias("load_id"), F.explode(F.array(*one)).alias("v")).select("load_id", "v.*").groupBy("load_id", "column_name", "value", "missing", "faulty", "text_hash").agg(F.count("*").alias("rows"))


def _big(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def with_before(profile: DataFrame) -> DataFrame:
    """The profile beside rows, nulls and comparable values of the load before (p_...; null for the first)."""
    w = Window.partitionBy("column_name").orderBy("load_id")
    return profile.select("*", *[F.lag(c).over(w).alias(f"p_{c}") for c in ("load_id", "n_rows", "n_null", "n")])


def null_drift(profile: DataFrame, percent: int = 15) -> DataFrame:
    """(load, column) whose share of nulls differs from the load before by more than `percent` hundredths."""
    gap = F.abs(_big("n_null") * _big("p_n_rows") - _big("p_n_null") * _big("n_rows"))
    return profile.filter(gap * 100 > _big("n_rows") * _big("p_n_rows") * percent).select("load_id", "column_name")


def value_drift(hist: DataFrame, profile: DataFrame, percent: int = 25, ranges: int = 64) -> DataFrame:
    """(load, column) where the largest gap between cumulative shares of this load and the one before exceeds `percent` hundredths.

    Each distinct value of a pair of loads is one row with two counts; running sums are taken inside ranges of
    values (cut at approximate quantiles) on top of the sums of the ranges before. Cuts only spread the work.
    """
    vals = hist.filter("value is not null").groupBy("load_id", "column_name", "value").agg(F.sum("rows").alias("c"))
    # one row a load and column: a log of loads, which stays small beside its rows
    pairs = profile.filter("p_load_id is not null").select("load_id", "p_load_id", "column_name", F.col("n").alias("values"), F.col("p_n").alias("p_values"))
    now = vals.join(F.broadcast(pairs.select("load_id", "column_name")), ["load_id", "column_name"]).select("load_id", "column_name", "value", "c", F.lit(0).cast("long").alias("p"))
    was = vals.withColumnRenamed("load_id", "p_load_id").join(F.broadcast(pairs.select("load_id", "p_load_id", "column_name")), ["p_load_id", "column_name"]).select("load_id", "column_name", "value", F.lit(0).cast("long").alias("c"), F.col("c").alias("p"))
    both = now.unionByName(was).groupBy("load_id", "column_name", "value").agg(F.sum("c").alias("c"), F.sum("p").alias("p"))
    cuts = vals.groupBy("column_name").agg(F.percentile_approx("value", [i / ranges for i in range(1, ranges)], 1000).alias("cuts"))
    both = both.join(F.broadcast(cuts), "column_name").withColumn("r", F.size(F.filter("cuts", lambda x: x < F.col("value")))).drop("cuts")
    inside = Window.partitionBy("load_id", "column_name", "r").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("load_id", "column_name").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    bases = both.groupBy("load_id", "column_name", "r").agg(F.sum("c").alias("c"), F.sum("p").alias("p"))
    bases = bases.select("load_id", "column_name", "r", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("bc"), F.coalesce(F.sum("p").over(before), F.lit(0)).alias("bp"))
    run = both.select("load_id", "column_name", "r", F.sum("c").over(inside).alias("c"), F.sum("p").over(inside).alias("p")).join(bases, ["load_id", "column_name", "r"]).join(F.broadcast(pairs), ["load_id", "column_name"])
    gap = F.abs(_big(F.col("c") + F.col("bc")) * _big("p_values") - _big(F.col("p") + F.col("bp")) * _big("values"))
    return run.filter(gap * 100 > _big("values") * _big("p_values") * percent).select("load_id", "column_name").distinct()


def found(df: DataFrame, rules: list[Rule], load: str = "load_id", row_id: str = "measurement_id", null_percent: int = 15, gap_percent: int = 25) -> DataFrame:
    """(load_id, column_name, row id): values at fault, and with row id 0 the loads that differ from the load before.

    The histogram is written once; the profile made of it names the loads and columns with violations, whose rows are then
    looked up, and the shares of nulls. All rows count as stored; the first load has none before.
    """
    hist = settled(histogram(df, rules, load), "histogram")
    rows = with_before(settled(profiled(hist), "profile"))
    at_fault = rows.filter("n_fault > 0").select("load_id", "column_name")
    bad = faults(df, rules, load, row_id).withColumnRenamed(load, "load_id")
    bad = bad.alias("f").join(F.broadcast(at_fault).alias("p"), F.col("f.load_id").eqNullSafe(F.col("p.load_id")) & (F.col("f.column_name") == F.col("p.column_name")), "left_semi")
    drift = null_drift(rows, null_percent).unionByName(value_drift(hist, rows, gap_percent)).distinct()
    return bad.select("load_id", "column_name", row_id).unionByName(drift.withColumn(row_id, F.lit(0).cast(df.schema[row_id].dataType)))


def profile(df: DataFrame, rules: list[Rule], load: str = "load_id") -> DataFrame:
    """One row per load and column: rows, nulls, faults, distincts, range, moments and the standardised difference to the load before."""
    return profiled(settled(histogram(df, rules, load), "histogram"))


#: Digits of a column's largest value that power sums keep. Squares of 10**13 rows stay within 38 digits; where cubes do not, the skew is null.
DIGITS = 9


def profiled(hist: DataFrame) -> DataFrame:
    """The profile of a histogram. Power sums s1 to s3 are whole numbers in units of 10**-places; columns without a finite number have null moments."""
    value = F.when(F.abs("value") < F.lit(float("inf")), F.col("value"))
    most = F.max(F.abs(value))
    units = hist.groupBy("column_name").agg(F.coalesce(F.lit(DIGITS - 1) - F.floor(F.log10(F.when(most > 0, most))), F.lit(0)).cast("int").alias("places"))
    h = hist.join(F.broadcast(units), "column_name")  # one row a column
    one = F.round(value * F.pow(F.lit(10.0), F.col("places"))).cast("long")
    wide = lambda c: c.cast("decimal(19,0)")
    square = one * one  # within 10**18
    powers = [wide(one), wide(square), (wide(square) * wide(one)).cast("decimal(28,0)")]
    c = F.col("rows").cast("decimal(13,0)")
    g = h.groupBy("load_id", "column_name", "places").agg(
        F.sum("rows").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("missing"), F.col("rows"))), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum(F.when(F.col("faulty"), F.col("rows"))), F.lit(0)).alias("n_fault"),
        F.count_if(~F.col("missing")).alias("n_distinct"),  # a row of the histogram is one value
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("rows"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(value.isNotNull(), F.col("rows"))), F.lit(0)).alias("finite"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        *[F.try_sum(F.try_multiply(p, c)).alias(f"s{i}") for i, p in enumerate(powers, 1)],
    )
    n, s1, s2, s3 = (F.col(x).cast("double") for x in ("finite", "s1", "s2", "s3"))
    scale = F.pow(F.lit(10.0), F.col("places"))
    mean = F.try_divide(s1, n)
    raw = F.try_divide(s2, n) - mean * mean
    var = F.when(raw < 0, 0.0).otherwise(raw)
    m3 = F.try_divide(s3, n) - 3 * mean * F.try_divide(s2, n) + 2 * mean * mean * mean
    g = g.select("load_id", "column_name", "n_rows", "n_null", "n_fault", "n_distinct", "n", "low", "high", (mean / scale).alias("mean"), (F.sqrt(var) / scale).alias("sd"), F.try_divide(m3, F.pow(F.sqrt(var), 3)).alias("skew"))
    w = Window.partitionBy("column_name").orderBy("load_id")
    spread = F.sqrt((F.col("sd") * F.col("sd") + F.pow(F.lag("sd").over(w), 2)) / 2)
    return g.withColumn("shift", F.try_divide(F.col("mean") - F.lag("mean").over(w), spread))
