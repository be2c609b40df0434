"""Queries over ids, captions, measurements and the ledger, and their SQL checks."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions.uids import VALID, is_valid_uid
from lamina.operators import captions as cap
from lamina.operators import gates
from lamina.operators import identity as idn
from lamina.operators import ledger as led
from lamina.session import table

RECIPE = {"reference_model": "ref-a", "reference_steps": 20, "reference_suffix": ", plain background", "atlas_resolution": 1024, "uv_convention": "top-down", "texture_resolution": 256, "margin_px": 4}
GEN = idn.recipe_digest(RECIPE)
DEL = idn.recipe_digest(RECIPE, idn.DELIVERY_FIELDS)
SALT = idn.SALT
PILOT = 100
QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


# ---------------------------------------------------------------- identity
@query("uid_valid", f"SELECT prepared_id, uid, coalesce(regexp_matches(uid, '{VALID}'), false) AS valid FROM prepared")
def uid_valid(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "prepared").select("prepared_id", "uid", F.coalesce(is_valid_uid(F.col("uid")), F.lit(False)).alias("valid"))


@query("content_uid", "SELECT doc_id, sha256(text) AS content_uid FROM documents")
def content_uid(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", idn.content_uid(F.col("text")).alias("content_uid"))


@query("source_digest", "SELECT doc_id, sha256(concat(text, lang)) AS digest FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL")
def source_digest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("text is not null and lang is not null").select("doc_id", idn.content_uid(F.concat("text", "lang")).alias("digest"))


@query("rank_blake2b")
def rank_blake2b(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "prepared").select("prepared_id", "uid", idn.rank_blake2b(F.col("uid")).alias("rank_key"))


@query(
    "pilot_topk",
    f"""SELECT uid, rank_key, row_number() OVER (ORDER BY rank_key, uid) - 1 AS place FROM (
      SELECT DISTINCT uid, substr(sha256(concat(uid, '|{SALT}')), 1, 16) AS rank_key FROM prepared WHERE regexp_matches(uid, '{VALID}') ORDER BY rank_key, uid LIMIT {PILOT})""",
)
def pilot_topk(spark: SparkSession, d: str) -> DataFrame:
    objects = table(spark, d, "prepared").filter(is_valid_uid(F.col("uid"))).select("uid").distinct()
    return idn.pilot(objects, PILOT, idn.rank_sha256(F.col("uid")))


@query("population_scan", f"SELECT population_id, uid, pos FROM (SELECT DISTINCT population_id, unnest(objects) AS uid, unnest(range(len(objects))) AS pos FROM population) WHERE regexp_matches(uid, '{VALID}')")
def population_scan(spark: SparkSession, d: str) -> DataFrame:
    pop = table(spark, d, "population").select("population_id", F.posexplode("objects").alias("pos", "uid"))
    return pop.filter(is_valid_uid(F.col("uid"))).select("population_id", "uid", F.col("pos").cast("long").alias("pos")).distinct()


@query(
    "population_growth",
    f"""WITH e AS (SELECT DISTINCT run_name, population_id, uid FROM (SELECT run_name, population_id, unnest(objects) AS uid FROM population) WHERE regexp_matches(uid, '{VALID}'))
    SELECT run_name, population_id, count(*) AS n_objects, count(*) FILTER (first = population_id) AS added
    FROM (SELECT *, min(population_id) OVER (PARTITION BY run_name, uid) AS first FROM e) GROUP BY ALL""",
)
def population_growth(spark: SparkSession, d: str) -> DataFrame:
    pop = table(spark, d, "population").select("run_name", "population_id", F.explode("objects").alias("uid")).filter(is_valid_uid(F.col("uid")))
    return idn.added_objects(pop, "run_name", "population_id", "uid")


@query(
    "population_extend",
    f"""WITH a AS (SELECT DISTINCT unnest(objects) AS uid FROM population), b AS (SELECT DISTINCT uid FROM prepared)
    SELECT uid, substr(sha256(concat(uid, '|{SALT}')), 1, 16) AS rank_key, uid NOT IN (SELECT uid FROM a WHERE uid IS NOT NULL) AS added
    FROM (SELECT uid FROM a UNION SELECT uid FROM b) WHERE regexp_matches(uid, '{VALID}')""",
)
def population_extend(spark: SparkSession, d: str) -> DataFrame:
    have = table(spark, d, "population").select(F.explode("objects").alias("uid"))
    both = idn.extend_population(have, table(spark, d, "prepared"), idn.rank_sha256(F.col("uid")))
    return both.filter(is_valid_uid(F.col("uid")))


def _seed_sql(text: str, digits: int) -> str:
    return f"CAST(concat('0x', substr(sha256({text}), 1, {digits})) AS hugeint)"


@query("object_seed", f"SELECT DISTINCT uid, stage, CAST({_seed_sql("concat_ws('|', uid, stage, '0')", 16)} % {idn.SPAN} AS bigint) AS seed FROM claims WHERE uid IS NOT NULL")
def object_seed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "claims").filter("uid is not null").select("uid", "stage").distinct().select("uid", "stage", idn.object_seed(F.col("uid"), F.col("stage")).alias("seed"))


@query("reference_seed", f"SELECT prepared_id, CAST({_seed_sql('uid', 8)} + 1000 * resolution AS bigint) AS seed FROM prepared WHERE uid IS NOT NULL")
def reference_seed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "prepared").filter("uid is not null").select("prepared_id", idn.reference_seed(F.col("uid"), F.col("resolution")).alias("seed"))


@query("content_key", "SELECT claim_id, substr(sha256(concat_ws('|', coalesce(stage, 'None'), coalesce(uid, 'None'), coalesce(content_key, 'None'))), 1, 16) AS key FROM claims")
def content_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "claims").select("claim_id", idn.content_key(F.col("stage"), F.col("uid"), F.col("content_key")).alias("key"))


_LATEST = """latest AS (SELECT uid, arg_max(caption, (line_no, caption_id)) AS caption, arg_max(caption_id, (line_no, caption_id)) AS caption_id
  FROM captions WHERE caption <> '' AND uid IS NOT NULL GROUP BY uid)"""
_ATT = """att AS (SELECT uid, max(TRY_CAST(extra['attempt'] AS integer)) AS attempt FROM claims WHERE uid IS NOT NULL GROUP BY uid)"""
_GEN = f"""{_LATEST}, {_ATT}, uids AS (SELECT DISTINCT uid FROM prepared WHERE regexp_matches(uid, '{VALID}')),
gen AS (SELECT u.uid, substr(sha256(concat_ws('|', coalesce(l.caption, ''), concat('attempt=', coalesce(a.attempt, 0)), '{GEN}')), 1, 16) AS generation_key
  FROM uids u LEFT JOIN latest l USING (uid) LEFT JOIN att a USING (uid))"""


def _keys(spark: SparkSession, d: str) -> DataFrame:
    uids = table(spark, d, "prepared").filter(is_valid_uid(F.col("uid"))).select("uid").distinct()
    latest = cap.latest(table(spark, d, "captions")).select("uid", "caption")
    att = table(spark, d, "claims").filter("uid is not null").groupBy("uid").agg(F.max(F.try_element_at("extra", F.lit("attempt")).try_cast("int")).alias("attempt"))
    j = uids.join(latest, "uid", "left").join(att, "uid", "left")
    return j.select("uid", idn.generation_key(F.col("caption"), F.col("attempt"), GEN).alias("generation_key"))


@query("generation_key", f"WITH {_GEN} SELECT uid, generation_key FROM gen")
def generation_key(spark: SparkSession, d: str) -> DataFrame:
    return _keys(spark, d)


@query("delivery_key", f"WITH {_GEN} SELECT uid, generation_key, substr(sha256(concat_ws('|', generation_key, '{DEL}')), 1, 16) AS delivery_key FROM gen")
def delivery_key(spark: SparkSession, d: str) -> DataFrame:
    return _keys(spark, d).withColumn("delivery_key", idn.delivery_key(F.col("generation_key"), DEL))


@query(
    "format_dispatch",
    """SELECT prepared_id, CASE lower(regexp_extract(source, '([.][A-Za-z0-9]+)$', 1)) WHEN '.obj' THEN 'obj' WHEN '.glb' THEN 'gltf' WHEN '.gltf' THEN 'gltf' ELSE 'unsupported' END AS format FROM prepared""",
)
def format_dispatch(spark: SparkSession, d: str) -> DataFrame:
    from lamina.sources.meshes import format_of

    return table(spark, d, "prepared").select("prepared_id", format_of(F.col("source")).alias("format"))


@query(
    "first_root_lookup",
    """SELECT uid, arg_min(source, (o, source)) AS source, min(o) AS o FROM (
      SELECT uid, source, CASE split_part(source, '/', 1) WHEN 'intake' THEN 0 WHEN 'drop' THEN 1 WHEN 'rescan' THEN 2 WHEN 'archive' THEN 3 ELSE 4 END AS o
      FROM prepared WHERE uid IS NOT NULL AND source IS NOT NULL) GROUP BY uid""",
)
def first_root_lookup(spark: SparkSession, d: str) -> DataFrame:
    folder = F.substring_index("source", "/", 1)
    o = F.when(folder == "intake", 0).when(folder == "drop", 1).when(folder == "rescan", 2).when(folder == "archive", 3).otherwise(4)
    rows = table(spark, d, "prepared").filter("uid is not null and source is not null").select("uid", "source", F.struct(o.alias("o"), F.col("source").alias("s")).alias("at"))
    return led.first_root(rows, "uid", "at", "source").select("uid", "source", F.col("at.o").alias("o"))


@query("num_or_missing", "SELECT claim_id, CASE WHEN NOT isnan(TRY_CAST(v AS double)) THEN TRY_CAST(v AS double) END AS number FROM (SELECT claim_id, coalesce(extra['attempt'], extra['chars'], owner) AS v FROM claims)")
def num_or_missing(spark: SparkSession, d: str) -> DataFrame:
    v = F.coalesce(F.try_element_at("extra", F.lit("attempt")), F.try_element_at("extra", F.lit("chars")), F.col("owner"))
    return table(spark, d, "claims").select("claim_id", gates.num(v).alias("number"))


_CONF = ("fail_dark_frac", "margin_px")


@query(
    "thresholds_defaults",
    """SELECT population_id, coalesce(TRY_CAST(config['margin_px'] AS double), 4) AS margin_px, coalesce(TRY_CAST(config['texture_resolution'] AS double), 256) AS texture_resolution,
    coalesce(TRY_CAST(config['fail_dark_frac'] AS double), CAST(0.4 AS double)) AS fail_dark_frac FROM (SELECT DISTINCT ON (population_id) * FROM population)""",
)
def thresholds_defaults(spark: SparkSession, d: str) -> DataFrame:
    get = lambda k, default: F.coalesce(F.try_element_at("config", F.lit(k)).try_cast("double"), F.lit(float(default))).alias(k)
    return table(spark, d, "population").dropDuplicates(["population_id"]).select("population_id", get("margin_px", 4), get("texture_resolution", 256), get("fail_dark_frac", gates.Thresholds().fail_dark_frac))


# ---------------------------------------------------------------- captions
@query("captions_latest", f"WITH {_LATEST} SELECT uid, caption_id, caption FROM latest")
def captions_latest(spark: SparkSession, d: str) -> DataFrame:
    return cap.latest(table(spark, d, "captions"))


_MERGE = """m AS (SELECT * FROM (SELECT uid, caption_id, caption, family, error, row_number() OVER (PARTITION BY uid ORDER BY
    CASE WHEN shard = 'captions.jsonl' AND coalesce(family, '') <> '' THEN 3 WHEN shard <> 'captions.jsonl' THEN 2 ELSE 1 END DESC,
    CASE WHEN shard = 'captions.jsonl' THEN '' ELSE shard END DESC,
    CASE WHEN shard = 'captions.jsonl' AND coalesce(family, '') = '' THEN -line_no ELSE line_no END DESC, caption_id DESC) AS n
  FROM captions WHERE uid <> '') WHERE n = 1)"""


@query("caption_merge", f"WITH {_MERGE} SELECT uid, caption_id, caption, family, error FROM m")
def caption_merge(spark: SparkSession, d: str) -> DataFrame:
    return cap.merge(table(spark, d, "captions"))


@query("caption_stats", f"WITH {_MERGE} SELECT count(*) AS objects, count(*) FILTER (coalesce(caption, '') <> '') AS with_caption, count(*) FILTER (coalesce(family, '') <> '') AS curated FROM m")
def caption_stats(spark: SparkSession, d: str) -> DataFrame:
    return cap.stats(cap.merge(table(spark, d, "captions")))


def _strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^{cap.BLANK}+|{cap.BLANK}+\\z', '', 'g')"


@query("prompt_for", f"SELECT caption_id, concat(regexp_replace({_strip_sql('caption')}, '[.]+\\z', ''), ', plain background') AS prompt FROM captions WHERE caption IS NOT NULL")
def prompt_for(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "captions").filter("caption is not null").select("caption_id", cap.prompt(F.col("caption"), RECIPE["reference_suffix"]).alias("prompt"))


@query("caption_clean", f"""SELECT doc_id, substr({_strip_sql(f'''regexp_replace(regexp_replace({_strip_sql('text')}, '^"+|"+\\z', '', 'g'), '{cap.BLANK}+', ' ', 'g')''')}, 1, 220) AS cleaned FROM documents""")
def caption_clean(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", cap.clean(F.col("text")).alias("cleaned"))


@query(
    "caption_views",
    f"""WITH s AS (SELECT DISTINCT uid, source AS name, CASE WHEN lower(source) LIKE '%.obj' THEN 0 ELSE 1 END AS preference FROM prepared WHERE regexp_matches(uid, '{VALID}') AND source IS NOT NULL),
    b AS (SELECT *, min(preference) OVER (PARTITION BY uid) AS best FROM s)
    SELECT uid, name, preference, place FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY name) AS place FROM b WHERE preference = best) WHERE place <= 2""",
)
def caption_views(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "prepared").filter(is_valid_uid(F.col("uid")) & F.col("source").isNotNull())
    return cap.views(p.select("uid", F.col("source").alias("name"), F.when(F.lower("source").like("%.obj"), 0).otherwise(1).alias("preference")).distinct())


@query("error_text", "SELECT caption_id, 'ValueError: ' || left(error, 138) AS error, left('ValueError: ' || error, 180) AS batch_error FROM captions WHERE error IS NOT NULL")
def error_text(spark: SparkSession, d: str) -> DataFrame:
    whole = F.concat(F.lit("ValueError: "), "error")
    return table(spark, d, "captions").filter("error is not null").select("caption_id", cap.error_text(whole).alias("error"), cap.error_text(whole, cap.BATCH_ERROR).alias("batch_error"))


@query("reference_batches", "SELECT owner, claim_id, CAST(floor((row_number() OVER (PARTITION BY owner ORDER BY claim_id) - 1) / 8) AS bigint) AS batch FROM (SELECT DISTINCT owner, claim_id FROM claims WHERE stage = 'reference' AND op = 'claim')")
def reference_batches(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "claims").filter("stage = 'reference' and op = 'claim'").select("owner", "claim_id").distinct()
    return cap.batches(c, "owner", ["claim_id"], 8)


# ------------------------------------------------------------------- gates
def _num_sql(c: str) -> str:
    return f"(CASE WHEN NOT isnan({c}) THEN {c} END)"


def _verdict_sql(t: str = "") -> str:
    """The CASE chain; t: prefix of threshold columns, else literals."""
    v = {f.name: (f"{t}{f.name}" if t else (str(getattr(gates.Thresholds(), f.name)).lower() if isinstance(getattr(gates.Thresholds(), f.name), bool) else f"CAST({getattr(gates.Thresholds(), f.name)} AS double)")) for f in fields(gates.Thresholds)}
    n = {c: _num_sql(c) for c in ("g1_dark_frac", "g1_max_blob", "g1_ref_dark", "g8_psnr", "g8_psnr_flip", "g3_ratio", "g4_iou_min", "g4_iou_orig", "g6_bad_fraction", "g7_ring_difference")}
    spared = f"(coalesce({n['g1_ref_dark']} >= {v['ref_dark_frac_legit']}, false) OR coalesce(g1_bless, false))"
    flip = f"coalesce({n['g8_psnr_flip']}, -1)"
    return f"""CASE WHEN error <> '' THEN 'FAIL:ERROR' WHEN {n['g1_dark_frac']} IS NULL THEN 'FAIL:G1_MISSING'
    WHEN NOT {spared} AND {n['g1_dark_frac']} > {v['fail_dark_frac']} THEN 'FAIL:G1_DARK_NO_GAIN'
    WHEN NOT {spared} AND {n['g1_dark_frac']} > {v['smear_dark_frac']} AND coalesce({n['g1_max_blob']}, 0) > {v['smear_max_blob']} THEN 'FAIL:G1_DARK_SMEAR'
    WHEN {n['g8_psnr']} IS NULL AND {v['g8_missing_is_failure']} THEN 'FAIL:G8_MISSING'
    WHEN {n['g8_psnr']} IS NOT NULL AND ({flip} >= {n['g8_psnr']} + {v['g8_flip_margin']} OR ({flip} >= {n['g8_psnr']} - {v['g8_ambiguity_margin']} AND {n['g8_psnr']} < {v['g8_ambiguity_min_psnr']}) OR {n['g8_psnr']} < {v['g8_min_psnr']}) THEN 'FAIL:G8_VIEW_MISMATCH'
    WHEN coalesce(g3_note, '') = '' AND {n['g3_ratio']} < {v['g3_fail_below']} THEN 'FAIL:G3_ALBEDO_BAND'
    WHEN {n['g4_iou_min']} IS NULL OR ({n['g4_iou_min']} < {v['g4_min_iou']} AND ({n['g4_iou_orig']} IS NULL OR {n['g4_iou_min']} < {n['g4_iou_orig']} - {v['g4_regression_tolerance']})) THEN 'FAIL:G4_FRAME'
    WHEN g5_valid_views IS NULL OR g5_valid_views < {v['g5_min_valid_views']} THEN 'FAIL:G5_GOLDEN'
    WHEN {n['g6_bad_fraction']} > {v['g6_max_bad_fraction']} THEN 'FAIL:G6_CROSS_FAMILY'
    WHEN {n['g7_ring_difference']} > {v['g7_max_ring_difference']} THEN 'FAIL:G7_MARGIN_RING' ELSE 'PASS' END"""


_ONCE = "(SELECT DISTINCT ON (measurement_id) * FROM measurements)"


def _measured(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "measurements").dropDuplicates(["measurement_id"])


@query("gate_verdict", f"SELECT measurement_id, uid, {_verdict_sql()} AS verdict FROM {_ONCE}")
def gate_verdict(spark: SparkSession, d: str) -> DataFrame:
    return gates.judged(_measured(spark, d), keep=["measurement_id", "uid"])


def _fixed_sql(c: str, p: int) -> str:
    n = f"TRY_CAST(floor(abs({c}) * {10**p} + 0.5) AS bigint)"
    return f"CASE WHEN {c} < 0 THEN '-' ELSE '' END || CASE WHEN abs({c}) < 1e12 THEN CAST({n} // {10**p} AS varchar) || '.' || lpad(CAST({n} % {10**p} AS varchar), {p}, '0') WHEN {c} IS NOT NULL THEN 'inf' END"


@query(
    "gate_reasons",
    f"""WITH m AS (SELECT measurement_id, error, {_verdict_sql()} AS verdict, {", ".join(f"{_num_sql(c)} AS {c}" for c in ("g1_dark_frac", "g1_max_blob", "g8_psnr", "g8_psnr_flip", "g3_ratio", "g4_iou_min", "g4_iou_orig", "g6_bad_fraction", "g7_ring_difference"))}, g5_valid_views FROM {_ONCE})
    SELECT measurement_id, verdict, CASE verdict
      WHEN 'FAIL:ERROR' THEN [error]
      WHEN 'FAIL:G1_MISSING' THEN ['g1_dark_frac is missing']
      WHEN 'FAIL:G1_DARK_NO_GAIN' THEN ['dark ' || {_fixed_sql("g1_dark_frac", 3)} || ', reference not dark']
      WHEN 'FAIL:G1_DARK_SMEAR' THEN ['dark ' || {_fixed_sql("g1_dark_frac", 3)} || ', blob ' || {_fixed_sql("g1_max_blob", 2)}]
      WHEN 'FAIL:G8_MISSING' THEN ['g8_psnr is missing']
      WHEN 'FAIL:G8_VIEW_MISMATCH' THEN [CASE WHEN coalesce(g8_psnr_flip, -1) >= g8_psnr + 3.0 THEN 'upside down fits better' WHEN coalesce(g8_psnr_flip, -1) >= g8_psnr - 1.0 AND g8_psnr < 15.0 THEN 'either way up fits badly' ELSE 'no fit' END
        || ': psnr ' || {_fixed_sql("g8_psnr", 1)} || ', flipped ' || coalesce({_fixed_sql("g8_psnr_flip", 1)}, '-1.0')]
      WHEN 'FAIL:G3_ALBEDO_BAND' THEN ['albedo ratio ' || {_fixed_sql("g3_ratio", 2)}]
      WHEN 'FAIL:G4_FRAME' THEN [CASE WHEN g4_iou_min IS NULL THEN 'iou missing' ELSE 'iou ' || {_fixed_sql("g4_iou_min", 3)} || coalesce(', original ' || {_fixed_sql("g4_iou_orig", 3)}, ', original unknown') END]
      WHEN 'FAIL:G5_GOLDEN' THEN ['valid views ' || coalesce(CAST(g5_valid_views AS varchar), 'missing')]
      WHEN 'FAIL:G6_CROSS_FAMILY' THEN ['bad fraction ' || {_fixed_sql("g6_bad_fraction", 4)}]
      WHEN 'FAIL:G7_MARGIN_RING' THEN ['ring difference ' || {_fixed_sql("g7_ring_difference", 2)}]
      ELSE CAST([] AS varchar[]) END AS reasons FROM m""",
)
def gate_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _measured(spark, d).select("measurement_id", gates.verdict(gates.Thresholds()).alias("verdict"), gates.reasons().alias("reasons"))


# written gate by gate: which numbers a row of each verdict leaves behind
_LOGGED = f"""WITH j AS (SELECT *, {_verdict_sql()} AS verdict FROM {_ONCE}),
  r AS (SELECT measurement_id, verdict, {", ".join(f"{_num_sql(c)} AS {c}" for c in ("g1_dark_frac", "g1_ref_dark", "g8_psnr", "g8_psnr_flip", "g3_ratio", "g4_iou_min", "g4_iou_orig"))}, g3_note,
    verdict IN ('FAIL:ERROR', 'FAIL:G1_MISSING') AS unread, verdict LIKE 'FAIL:G1%' OR verdict IN ('FAIL:ERROR', 'FAIL:G8_MISSING') AS before_views FROM j)
  SELECT measurement_id, 'g1_ref_dark' AS k, g1_ref_dark AS v FROM r WHERE NOT unread
  UNION ALL SELECT measurement_id, 'g8_psnr', g8_psnr FROM r WHERE NOT before_views AND g8_psnr IS NOT NULL
  UNION ALL SELECT measurement_id, 'g8_psnr_flip', coalesce(g8_psnr_flip, -1) FROM r WHERE NOT before_views AND g8_psnr IS NOT NULL
  UNION ALL SELECT measurement_id, 'g3_ratio', g3_ratio FROM r WHERE NOT before_views AND verdict <> 'FAIL:G8_VIEW_MISMATCH' AND coalesce(g3_note, '') = '' AND g3_ratio IS NOT NULL
  UNION ALL SELECT measurement_id, 'g3_high_side', g3_ratio FROM r WHERE NOT before_views AND verdict <> 'FAIL:G8_VIEW_MISMATCH' AND coalesce(g3_note, '') = '' AND g3_ratio > 0.8
  UNION ALL SELECT measurement_id, k, CASE k WHEN 'g4_iou_min' THEN g4_iou_min ELSE g4_iou_orig END FROM r, (VALUES ('g4_iou_min'), ('g4_iou_orig')) AS two(k) WHERE verdict = 'PASS' OR verdict[6:7] IN ('G5', 'G6', 'G7')
  UNION ALL SELECT measurement_id, 'g1_dark_frac', g1_dark_frac FROM r WHERE verdict = 'PASS'"""


@query("gate_logged", _LOGGED)
def gate_logged(spark: SparkSession, d: str) -> DataFrame:
    return _measured(spark, d).select("measurement_id", F.explode(gates.logged()).alias("k", "v"))


@query("gate_summary", f"SELECT verdict, count(*) AS n, round(count(*) FILTER (verdict = 'PASS') / count(*), 4) AS pass_rate FROM (SELECT {_verdict_sql()} AS verdict FROM {_ONCE}) GROUP BY ROLLUP (verdict)")
def gate_summary(spark: SparkSession, d: str) -> DataFrame:
    return gates.summary(gates.judged(_measured(spark, d), keep=["measurement_id"]))


_SETS = {"default": gates.Thresholds(), "strict": gates.Thresholds(fail_dark_frac=0.2, g8_min_psnr=12.0, g4_min_iou=0.95), "lenient": gates.Thresholds(g8_missing_is_failure=False, g5_min_valid_views=1, g6_max_bad_fraction=0.01)}


def _sets_sql() -> str:
    def lit(x):
        return str(x).lower() if isinstance(x, bool) else f"CAST({x} AS double)"

    return " UNION ALL ".join("SELECT '" + k + "' AS threshold_set, " + ", ".join(f"{lit(getattr(t, f.name))} AS {f.name}" for f in fields(gates.Thresholds)) for k, t in _SETS.items())


@query("gate_replay", f"SELECT threshold_set, verdict, count(*) AS n FROM (SELECT threshold_set, {_verdict_sql('s.')} AS verdict FROM {_ONCE} m CROSS JOIN ({_sets_sql()}) s) GROUP BY ALL")
def gate_replay(spark: SparkSession, d: str) -> DataFrame:
    return gates.replay(_measured(spark, d), gates.threshold_sets(spark, _SETS))


@query("unmeasured_counts", f"SELECT field, count(*) AS n FROM (SELECT unnest(unmeasured) AS field FROM {_ONCE}) GROUP BY field")
def unmeasured_counts(spark: SparkSession, d: str) -> DataFrame:
    return gates.unmeasured_counts(_measured(spark, d))


@query(
    "measure_upsert",
    """WITH m AS (SELECT DISTINCT measurement_id, uid, load_id FROM measurements WHERE uid IS NOT NULL), last AS (SELECT max(load_id) AS l FROM m), fresh AS (SELECT m.* FROM m, last WHERE load_id = l)
    SELECT * FROM fresh UNION ALL SELECT m.* FROM m, last WHERE load_id < l AND uid NOT IN (SELECT uid FROM fresh)""",
)
def measure_upsert(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "measurements").filter("uid is not null").select("measurement_id", "uid", "load_id").distinct()
    last = m.agg(F.max("load_id").alias("_l"))
    tagged = m.crossJoin(F.broadcast(last))
    return led.upsert(tagged.filter("load_id < _l").drop("_l"), tagged.filter("load_id = _l").drop("_l"), "uid")


@query(
    "render_override",
    f"""SELECT measurement_id, coalesce(r.psnr, m.g8_psnr) AS g8_psnr, m.g8_psnr_flip FROM {_ONCE} m
    LEFT JOIN (SELECT uid, min(g8_psnr) AS psnr FROM measurements WHERE g8_psnr IS NOT NULL AND NOT isnan(g8_psnr) GROUP BY uid) r ON r.uid = m.uid""",
)
def render_override(spark: SparkSession, d: str) -> DataFrame:
    from lamina.operators.measures import overridden

    m = _measured(spark, d)
    render = m.filter("g8_psnr is not null and not isnan(g8_psnr)").groupBy("uid").agg(F.min("g8_psnr").alias("psnr")).select("uid", F.create_map(F.lit("g8_psnr"), F.col("psnr"), F.lit("note"), F.lit(0.0)).alias("render"))
    own = F.map_from_entries(F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("k"), F.col(c).alias("v"))) for c in ("g8_psnr", "g8_psnr_flip")])))
    j = m.select("measurement_id", "uid", own.alias("own")).join(render, "uid", "left")
    both = overridden(F.col("own"), F.col("render"))
    return j.select("measurement_id", *[F.try_element_at(both, F.lit(c)).alias(c) for c in ("g8_psnr", "g8_psnr_flip")])


@query(
    "g3_albedo_ratio",
    f"""WITH f AS (SELECT *, isnan(coalesce(g8_psnr, 0)) OR isinf(coalesce(g8_psnr, 0)) OR isnan(coalesce(g8_psnr_flip, 0)) OR isinf(coalesce(g8_psnr_flip, 0)) AS odd FROM {_ONCE})
    SELECT measurement_id, CASE WHEN NOT odd THEN round(g8_psnr / nullif(g8_psnr_flip, 0), 4) END AS ratio, CASE WHEN odd THEN 'albedo is no number' WHEN coalesce(g8_psnr_flip, 0) = 0 THEN 'no visible albedo' ELSE '' END AS note FROM f""",
)
def g3_albedo_ratio(spark: SparkSession, d: str) -> DataFrame:
    from lamina.operators.measures import albedo_ratio as ratio

    r, note = ratio(F.col("g8_psnr"), F.col("g8_psnr_flip"))
    return _measured(spark, d).select("measurement_id", r.alias("ratio"), note.alias("note"))


# ------------------------------------------------------------------ ledger
_DONE = """done AS (SELECT stage, uid, unnest(arg_max({'claim_id': claim_id, 'content_key': content_key, 'owner': owner, 'event_at': event_at, 'extra': extra}, (coalesce(event_at, TIMESTAMP '0001-01-01'), claim_id)))
  FROM claims WHERE op = 'complete' AND uid IS NOT NULL GROUP BY stage, uid)"""


@query("queue_latest_done", f"WITH {_DONE} SELECT stage, uid, claim_id, content_key, owner, event_at FROM done")
def queue_latest_done(spark: SparkSession, d: str) -> DataFrame:
    return led.latest_done(table(spark, d, "claims")).drop("extra")


@query("done_extra", f"WITH {_DONE} SELECT stage, uid, len(map_keys(extra)) AS fields, coalesce(extra['attempt'], '-') AS attempt FROM done WHERE extra IS NOT NULL")
def done_extra(spark: SparkSession, d: str) -> DataFrame:
    done = led.latest_done(table(spark, d, "claims")).filter("extra is not null")
    e = led.done_extra(F.col("extra"))
    return done.select("stage", "uid", F.size(e).cast("long").alias("fields"), F.coalesce(F.try_element_at(e, F.lit("attempt")), F.lit("-")).alias("attempt"))


_EPOCH = f"""c AS (SELECT DISTINCT ON (claim_id) * FROM claims WHERE uid IS NOT NULL AND event_at IS NOT NULL),
l AS (SELECT *, lag(op) OVER w AS pop, lag(event_at) OVER w AS pat FROM c WINDOW w AS (PARTITION BY stage, uid, content_key ORDER BY event_at, claim_id)),
e AS (SELECT *, CAST(sum(CASE WHEN pop IS NULL OR pop IN ('complete', 'release') OR epoch_us(event_at) - epoch_us(pat) > {led.LEASE_SECONDS} * 1000000 THEN 1 ELSE 0 END)
  OVER (PARTITION BY stage, uid, content_key ORDER BY event_at, claim_id ROWS UNBOUNDED PRECEDING) AS bigint) AS epoch FROM l)"""


@query("queue_lease", f"WITH {_EPOCH} SELECT claim_id, stage, uid, content_key, op, epoch FROM e")
def queue_lease(spark: SparkSession, d: str) -> DataFrame:
    return led.lease_epochs(table(spark, d, "claims")).select("claim_id", "stage", "uid", "content_key", "op", "epoch")


@query("queue_claims", f"WITH {_EPOCH} SELECT stage, uid, content_key, epoch, arg_min(claim_id, (event_at, claim_id)) AS claim_id, arg_min({{'o': owner}}, (event_at, claim_id)).o AS owner FROM e WHERE op = 'claim' GROUP BY ALL")
def queue_claims(spark: SparkSession, d: str) -> DataFrame:
    return led.winners(table(spark, d, "claims"))


_NOW = "2026-03-25 00:00:00"


@query(
    "queue_expired",
    f"""SELECT stage, uid, content_key, t.owner AS owner, epoch_us(TIMESTAMP '{_NOW}') - epoch_us(t.at) > {led.LEASE_SECONDS} * 1000000 AS stale FROM (
      SELECT stage, uid, content_key, arg_max({{'at': event_at, 'op': op, 'owner': owner}}, (event_at, claim_id)) AS t FROM claims WHERE uid IS NOT NULL AND event_at IS NOT NULL GROUP BY ALL) WHERE t.op IN ('claim', 'touch')""",
)
def queue_expired(spark: SparkSession, d: str) -> DataFrame:
    return led.expired(table(spark, d, "claims"), F.lit(_NOW).cast("timestamp"))


@query(
    "queue_sessions",
    f"""WITH c AS (SELECT DISTINCT ON (claim_id) stage, uid, content_key, claim_id, event_at FROM claims WHERE uid IS NOT NULL AND event_at IS NOT NULL),
    l AS (SELECT *, CASE WHEN lag(event_at) OVER w IS NULL OR epoch_us(event_at) - epoch_us(lag(event_at) OVER w) > {led.LEASE_SECONDS} * 1000000 THEN 1 ELSE 0 END AS opens FROM c WINDOW w AS (PARTITION BY stage, uid, content_key ORDER BY event_at, claim_id)),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY stage, uid, content_key ORDER BY event_at, claim_id ROWS UNBOUNDED PRECEDING) AS n FROM l)
    SELECT stage, uid, content_key, min(event_at) AS started_at, max(event_at) AS last_at, count(*) AS events FROM s GROUP BY stage, uid, content_key, n""",
)
def queue_sessions(spark: SparkSession, d: str) -> DataFrame:
    return led.sessions(table(spark, d, "claims"))


_CURRENT = "cur AS (SELECT stage, uid, arg_max(content_key, (coalesce(event_at, TIMESTAMP '0001-01-01'), claim_id)) AS content_key FROM claims WHERE uid IS NOT NULL AND content_key IS NOT NULL GROUP BY stage, uid)"


def _current(claims: DataFrame) -> DataFrame:
    return claims.filter("uid is not null and content_key is not null").groupBy("stage", "uid").agg(F.max_by("content_key", F.struct("event_at", "claim_id")).alias("content_key"))


@query("work_remaining", f"WITH {_CURRENT}, {_DONE} SELECT stage, uid, content_key FROM cur WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.stage = cur.stage AND d.uid = cur.uid AND d.content_key = cur.content_key)")
def work_remaining(spark: SparkSession, d: str) -> DataFrame:
    claims = table(spark, d, "claims")
    return led.remaining(_current(claims), led.latest_done(claims).select("stage", "uid", "content_key"), ["stage", "uid", "content_key"])


_HELD = "held AS (SELECT DISTINCT uid FROM (SELECT uid, arg_max(op, (coalesce(event_at, TIMESTAMP '0001-01-01'), claim_id)) AS op FROM claims WHERE uid IS NOT NULL AND stage = 'generate' GROUP BY uid) WHERE op IN ('claim', 'touch'))"
_WORK = f"""WITH {_CURRENT}, {_DONE}, {_HELD}
  SELECT uid, content_key, sha256(uid) AS rank_key FROM cur WHERE stage = 'generate' AND NOT EXISTS (SELECT 1 FROM done d WHERE d.stage = 'generate' AND d.uid = cur.uid AND d.content_key = cur.content_key) AND uid NOT IN (SELECT uid FROM held)"""


def _work(spark: SparkSession, d: str, limit: int = 0) -> DataFrame:
    claims = table(spark, d, "claims")
    gen = claims.filter("stage = 'generate'")
    done = led.latest_done(gen).select("uid", "content_key")
    held = gen.filter("uid is not null").groupBy("uid").agg(F.max_by("op", F.struct("event_at", "claim_id")).alias("op")).filter("op in ('claim', 'touch')").select("uid")
    pop = _current(gen).select("uid", "content_key", F.sha2("uid", 256).alias("rank_key"))
    return led.work(pop, done, held, ["rank_key"], limit)


@query("work_iter", _WORK)
def work_iter(spark: SparkSession, d: str) -> DataFrame:
    return _work(spark, d)


@query("work_limit", f"{_WORK} ORDER BY rank_key LIMIT 20")
def work_limit(spark: SparkSession, d: str) -> DataFrame:
    return _work(spark, d, 20)


@query(
    "run_status",
    f"""WITH {_CURRENT}, {_DONE}, pop AS (SELECT DISTINCT uid FROM (SELECT unnest(objects) AS uid FROM population) WHERE regexp_matches(uid, '{VALID}')), st AS (SELECT DISTINCT stage FROM cur),
    h AS (SELECT stage, count(*) FILTER (NOT stale) AS in_flight, count(*) FILTER (stale) AS stale FROM ({SQL['queue_expired']}) GROUP BY stage),
    g AS (SELECT st.stage, count(*) AS total, count(*) FILTER (d.content_key = c.content_key) AS done, count(*) FILTER (d.content_key IS NOT NULL AND d.content_key IS DISTINCT FROM c.content_key) AS superseded
      FROM pop CROSS JOIN st LEFT JOIN cur c ON c.stage = st.stage AND c.uid = pop.uid LEFT JOIN done d ON d.stage = st.stage AND d.uid = pop.uid GROUP BY st.stage)
    SELECT g.stage, total, done, superseded, total - done AS remaining, coalesce(h.in_flight, 0) AS in_flight, coalesce(h.stale, 0) AS stale FROM g LEFT JOIN h ON h.stage = g.stage""",
)
def run_status(spark: SparkSession, d: str) -> DataFrame:
    claims = table(spark, d, "claims")
    pop = table(spark, d, "population").select(F.explode("objects").alias("uid")).filter(is_valid_uid(F.col("uid")))
    held = led.expired(claims, F.lit(_NOW).cast("timestamp"))
    return led.status(pop, _current(claims), led.latest_done(claims), held)


# the digest of an atlas stands for its bytes: here of the generating owner, or for every third object of the ledger row
@query(
    "assetize_plan",
    f"""WITH {_CURRENT}, {_DONE}, g AS (SELECT * FROM cur WHERE stage = 'generate'), gd AS (SELECT * FROM done WHERE stage = 'generate'), ad AS (SELECT * FROM done WHERE stage = 'assetize'),
    j AS (SELECT g.uid, g.content_key AS cur_key, gd.content_key AS done_key, ad.content_key AS own_key, CASE WHEN p.uid IS NOT NULL THEN coalesce(CASE WHEN gd.claim_id % 3 = 0 THEN CAST(gd.claim_id AS varchar) ELSE gd.owner END, '-') END AS atlas,
      coalesce(ad.owner, '-') AS own_digest, ad.uid IS NOT NULL AS own, gd.event_at > ad.event_at AS newer
      FROM g LEFT JOIN gd ON gd.uid = g.uid LEFT JOIN ad ON ad.uid = g.uid LEFT JOIN (SELECT DISTINCT uid FROM prepared) p ON p.uid = g.uid)
    SELECT uid, CASE WHEN newer THEN cur_key || '|atlas-newer' ELSE cur_key END AS asked_key,
      CASE WHEN done_key IS NULL OR done_key IS DISTINCT FROM cur_key THEN 'stale' WHEN atlas IS NULL THEN 'missing atlas' WHEN own AND atlas = own_digest AND own_key = cur_key THEN 'unchanged' ELSE 'deliver' END AS action
    FROM j WHERE CASE WHEN newer THEN cur_key || '|atlas-newer' ELSE cur_key END IS DISTINCT FROM own_key""",
)
def assetize_plan(spark: SparkSession, d: str) -> DataFrame:
    from lamina.operators.measures import asked_key, delivery_action

    claims = table(spark, d, "claims")
    done = led.latest_done(claims)
    name = F.coalesce("owner", F.lit("-"))
    g = _current(claims).filter("stage = 'generate'").select("uid", F.col("content_key").alias("current_key"), F.col("content_key").alias("delivery_key"))
    gd = done.filter("stage = 'generate'").select("uid", F.col("content_key").alias("done_key"), F.col("event_at").alias("atlas_at"), F.when(F.col("claim_id") % 3 == 0, F.col("claim_id").cast("string")).otherwise(name).alias("bytes"))
    ad = done.filter("stage = 'assetize'").select("uid", F.col("event_at").alias("delivered_at"), name.alias("own_digest"), F.col("content_key").alias("own_delivery"))
    files = table(spark, d, "prepared").select("uid").distinct().withColumn("there", F.lit(True))
    rows = g.join(gd, "uid", "left").join(ad, "uid", "left").join(files, "uid", "left").withColumn("atlas", F.when(F.col("there"), F.coalesce("bytes", F.lit("-"))))
    rows = rows.withColumn("asked_key", asked_key(F.col("delivery_key"), F.col("atlas_at"), F.col("delivered_at"))).filter(~F.col("asked_key").eqNullSafe(F.col("own_delivery")))
    return delivery_action(rows).select("uid", "asked_key", "action")



@query("spawn_summary", "SELECT consumer, count(*) AS workers, count(*) FILTER (outcome <> 'succeeded') AS failed, bool_and(outcome = 'succeeded') AS ok FROM runs WHERE outcome <> 'running' GROUP BY consumer")
def spawn_summary(spark: SparkSession, d: str) -> DataFrame:
    codes = table(spark, d, "runs").filter("outcome <> 'running'").select("consumer", F.when(F.col("outcome") == "succeeded", 0).otherwise(1).alias("code"))
    return led.spawn_ok(codes, "consumer", "code")


@query("worker_plan", "SELECT i AS worker, CAST(floor(i / 3) AS bigint) AS gpu FROM range(24) t(i)")
def worker_plan(spark: SparkSession, d: str) -> DataFrame:
    return led.worker_plan(spark, 8, 3)


@query(
    "prepared_record",
    """SELECT prepared_id, array_to_string(list_filter([CASE WHEN uv_out_of_range THEN 'layout outside [0, 1], replaced' END, CASE WHEN lower(trim(uv_source)) IN ('xatlas', 'grid') THEN 'layout made here' END,
      CASE WHEN overlap_texels > 0 THEN concat(overlap_texels, ' texels claimed twice') END, CASE WHEN occupancy < 0.05 THEN 'layout covers little of the atlas' END], lambda x: x IS NOT NULL), '; ') AS notes
    FROM (SELECT DISTINCT ON (prepared_id) * FROM prepared)""",
)
def prepared_record(spark: SparkSession, d: str) -> DataFrame:
    from lamina.operators.measures import preparation_notes

    return table(spark, d, "prepared").dropDuplicates(["prepared_id"]).select("prepared_id", F.array_join(preparation_notes(), "; ").alias("notes"))


@query("uv_source", "SELECT DISTINCT prepared_id, coalesce(nullif(lower(trim(uv_source)), ''), 'grid') AS uv_source FROM prepared")
def uv_source(spark: SparkSession, d: str) -> DataFrame:
    from lamina.operators.measures import uv_provenance

    return table(spark, d, "prepared").select("prepared_id", uv_provenance(F.col("uv_source")).alias("uv_source")).distinct()


@query("versions_row", "SELECT * FROM (VALUES ('contract_version', 'lamina.run/2'), ('gate_version', 'lamina.gates/1'), ('package_version', '0.2.0'), ('pipeline_version', 'lamina.pipeline/2'), ('recipe_version', 'lamina.recipe/1')) t(name, version)")
def versions_row(spark: SparkSession, d: str) -> DataFrame:
    from lamina.versions import VERSIONS

    return spark.createDataFrame(list(VERSIONS.items()), "name string, version string")
