"""Queries p3 and p5 and their SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions.text import real_sql
from lamina.functions.uids import object_sql
from lamina.operators import incremental as inc
from lamina.operators import profile as prof
from lamina.session import shared_table, table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    runs = table(spark, d, "runs")
    parts = []
    for consumer, source in (("status", inc.claims_source(table(spark, d, "claims"))), ("gate", inc.measurements_source(table(spark, d, "measurements")))):
        target = inc.replay(source, inc.successful_runs(runs, consumer), shared_table(spark, f"p3-{consumer}"))
        parts.append(target.changes().select(F.lit(consumer).alias("consumer"), "run_id", "row_id"))
    return parts[0].unionByName(parts[1])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    rules = prof.measurement_rules()
    return prof.found(table(spark, d, "measurements").select("load_id", "measurement_id", *[r.name for r in rules]), rules)


def p5_profile(spark: SparkSession, d: str) -> DataFrame:
    rules = prof.measurement_rules()
    p = prof.profile(table(spark, d, "measurements").select("load_id", *[r.name for r in rules]), rules)
    return p.select("load_id", "column_name", "n_rows", "n_null", "n_fault", "n_distinct", "low", "high", *[F.round(c, 5).alias(c) for c in ("mean", "sd", "shift")], F.round("skew", 4).alias("skew"))


_OBJ = object_sql("uid")
_STATE = """
ok AS (SELECT run_id, consumer, cutoff_at FROM (
         SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY logged_at DESC, outcome DESC) AS n FROM runs)
       WHERE n = 1 AND outcome = 'succeeded'),
seq AS (SELECT *, lag(run_id) OVER (PARTITION BY consumer ORDER BY run_id) AS before FROM ok)"""

P3_SQL = f"""WITH {_STATE},
src AS (
  SELECT 'status' AS consumer, concat_ws('/', coalesce(stage, '?'), uid, coalesce(content_key, '?')) AS k, event_at AS at, claim_id AS id, recorded_at AS seen,
         concat(coalesce(op, '?'), '/', coalesce(owner, '?')) AS v
  FROM claims WHERE uid IS NOT NULL
  UNION ALL
  SELECT 'gate', o, measured_at, measurement_id, arrived_at,
         concat_ws('/', coalesce(content_key, '?'), coalesce(error, '?'), {", ".join(f"coalesce(CAST({c} AS varchar), '?')" for c in ("g1_dark_frac", "g1_max_blob", "g1_ref_dark", "g1_bless", "g3_ratio", "g3_note", "g4_iou_min", "g4_iou_orig", "g5_valid_views", "g6_bad_fraction", "g7_ring_difference", "g8_psnr", "g8_psnr_flip", "unmeasured", "list_sort(map_entries(unmeasured_because))"))})
  FROM (SELECT *, {_OBJ} AS o FROM measurements) WHERE o IS NOT NULL),
st AS (
  SELECT s.consumer, r.run_id, r.before, s.k, s.id, s.v,
         row_number() OVER (PARTITION BY s.consumer, r.run_id, s.k ORDER BY s.at DESC NULLS LAST, s.id DESC) AS n
  FROM src s JOIN seq r ON s.consumer = r.consumer AND s.seen <= r.cutoff_at)
SELECT c.consumer, c.run_id, c.id AS row_id
FROM (SELECT * FROM st WHERE n = 1) c LEFT JOIN (SELECT * FROM st WHERE n = 1) p
  ON p.consumer = c.consumer AND p.run_id = c.before AND p.k = c.k
WHERE p.k IS NULL OR p.v <> c.v"""

_F1 = "(g1_dark_frac IS NOT NULL AND (isnan(g1_dark_frac) OR g1_dark_frac < 0 OR g1_dark_frac > 1))"
_F8 = "(g8_psnr IS NOT NULL AND (isnan(g8_psnr) OR g8_psnr < 0 OR g8_psnr > 100))"
_FU = "(unmeasured IS NOT NULL AND (unmeasured <> list_sort(list_distinct(unmeasured)) OR len(list_filter(unmeasured, lambda x: x IS NULL OR x NOT IN (" + ", ".join(f"'{g}'" for g in prof.GATE_NAMES) + "))) > 0))"
_FE = f"(error IS NOT NULL AND (NOT {real_sql('error')} OR regexp_matches(error, '[\\p{{Cc}}\\x{{FFFD}}]')))"
_LONG = f"""
long AS (
  SELECT load_id, measurement_id, 'g1_dark_frac' AS column_name, g1_dark_frac IS NULL AS missing, {_F1} AS bad, CASE WHEN NOT {_F1} THEN g1_dark_frac END AS v, CAST(g1_dark_frac + 0 AS varchar) AS txt FROM measurements
  UNION ALL SELECT load_id, measurement_id, 'g8_psnr', g8_psnr IS NULL, {_F8}, CASE WHEN NOT {_F8} THEN g8_psnr END, CAST(g8_psnr + 0 AS varchar) FROM measurements
  UNION ALL SELECT load_id, measurement_id, 'unmeasured', unmeasured IS NULL, {_FU}, CAST(len(unmeasured) AS double), CAST(unmeasured AS varchar) FROM measurements
  UNION ALL SELECT load_id, measurement_id, 'error', error IS NULL, {_FE}, NULL, error FROM measurements),
tot AS (SELECT load_id, column_name, count(*) AS n, count(*) FILTER (missing) AS nulls, count(v) AS vals FROM long GROUP BY ALL),
pair AS (SELECT *, lag(load_id) OVER w AS p_load, lag(n) OVER w AS p_n, lag(nulls) OVER w AS p_nulls, lag(vals) OVER w AS p_vals FROM tot WINDOW w AS (PARTITION BY column_name ORDER BY load_id))"""
P5_SQL = f"""WITH {_LONG},
pts AS (SELECT DISTINCT p.load_id, p.column_name, p.p_load, p.vals, p.p_vals, l.v FROM pair p JOIN long l ON l.column_name = p.column_name AND l.load_id IN (p.load_id, p.p_load) AND l.v IS NOT NULL),
cdf AS (SELECT load_id, column_name, v, c, sum(c) OVER (PARTITION BY load_id, column_name ORDER BY v) AS cum FROM (SELECT load_id, column_name, v, count(*) AS c FROM long WHERE v IS NOT NULL GROUP BY ALL)),
gap AS (SELECT p.load_id, p.column_name, abs(coalesce(a.cum, 0) * 1.0 * p.p_vals - coalesce(b.cum, 0) * 1.0 * p.vals) AS g, p.vals, p.p_vals
        FROM pts p ASOF LEFT JOIN cdf a ON a.load_id = p.load_id AND a.column_name = p.column_name AND p.v >= a.v
                   ASOF LEFT JOIN cdf b ON b.load_id = p.p_load AND b.column_name = p.column_name AND p.v >= b.v)
SELECT DISTINCT load_id, column_name, measurement_id FROM long WHERE bad
UNION
SELECT load_id, column_name, CAST(0 AS bigint) FROM pair WHERE abs(nulls * 1.0 * p_n - p_nulls * 1.0 * n) > 0.15 * n * p_n
UNION
SELECT load_id, column_name, CAST(0 AS bigint) FROM gap WHERE g > 0.25 * vals * p_vals AND vals > 0 AND p_vals > 0"""

P5_PROFILE_SQL = f"""WITH {_LONG},
agg AS (SELECT load_id, column_name, count(*) AS n_rows, count(*) FILTER (missing) AS n_null, count(*) FILTER (bad) AS n_fault, count(DISTINCT txt) AS n_distinct,
               min(v) AS low, max(v) AS high, avg(v) AS mean, stddev_pop(v) AS sd FROM long GROUP BY ALL),
cu AS (SELECT l.load_id, l.column_name, avg((v - mean) ** 3) AS m3 FROM long l JOIN agg a ON a.load_id = l.load_id AND a.column_name = l.column_name WHERE v IS NOT NULL GROUP BY ALL),
nx AS (SELECT *, lag(mean) OVER w AS pm, lag(sd) OVER w AS ps FROM agg WINDOW w AS (PARTITION BY column_name ORDER BY load_id))
SELECT load_id, column_name, n_rows, n_null, n_fault, n_distinct, low, high, round(mean, 5) AS mean, round(sd, 5) AS sd,
       round((mean - pm) / nullif(sqrt((sd * sd + ps * ps) / 2), 0), 5) AS shift, round(m3 / nullif(sd ** 3, 0), 4) AS skew
FROM nx LEFT JOIN cu USING (load_id, column_name)"""

QUERIES = {"p3_found": p3_found, "p5_found": p5_found, "p5_profile": p5_profile}
SQL = {"p3_found": P3_SQL, "p5_found": P5_SQL, "p5_profile": P5_PROFILE_SQL}
