"""Queries over file formats and streams, and their SQL checks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina import fixtures as fx
from lamina.operators import image as im
from lamina.operators import raster as ras
from lamina.plans.tabular import SQL as TABULAR
from lamina.session import shared_table, table
from lamina.sources import arrays, meshes, records
from lamina.sources.versions import Versions
from lamina.streaming import lease

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _mesh(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    v, f, uv, uf = fx.height_field(spark, d)
    return v, uv, f.join(uf, ["uid", "fid"])


_ORDERED = "of AS (SELECT uid, row_number() OVER (PARTITION BY uid ORDER BY fid) - 1 AS fid, a, b, c FROM mf)"


@query(
    "obj_sink_lines",
    f"""WITH {fx.FIELD} SELECT uid, 0 AS part, vid AS n, printf('v %.6f %.6f %.6f', x, y, z) AS line FROM mv UNION ALL SELECT uid, 1, tid, printf('vt %.6f %.6f', u, 1 - v) FROM mt
    UNION ALL SELECT uid, 2, fid, printf('f %d/%d %d/%d %d/%d', a + 1, a + 1, b + 1, b + 1, c + 1, c + 1) FROM mf""",
)
def obj_sink_lines(spark: SparkSession, d: str) -> DataFrame:
    return meshes.obj_lines(*_mesh(spark, d))


@query("obj_scan", f"WITH {fx.FIELD}, {_ORDERED} SELECT uid, fid, a, b, c, a AS ta, b AS tb, c AS tc FROM of")
def obj_scan(spark: SparkSession, d: str) -> DataFrame:
    return meshes.obj_scan(meshes.obj_text(meshes.obj_lines(*_mesh(spark, d))))[2]


@query("obj_files", f"WITH {fx.FIELD}, {_ORDERED} SELECT uid, count(*) AS n_faces, sum(a + 2 * b + 3 * c)::bigint AS corners FROM of GROUP BY uid")
def obj_files(spark: SparkSession, d: str) -> DataFrame:
    """Meshes to OBJ files in the shared folder, read back."""
    out = shared_table(spark, "obj")
    meshes.obj_files(meshes.obj_text(meshes.obj_lines(*_mesh(spark, d))), out)
    files = spark.read.format("binaryFile").load(out).select(F.regexp_extract("path", r"([0-9]+)\.obj", 1).cast("long").alias("uid"), F.decode("content", "UTF-8").alias("content"))
    return meshes.obj_scan(files)[2].groupBy("uid").agg(F.count("*").alias("n_faces"), F.sum(F.col("a") + 2 * F.col("b") + 3 * F.col("c")).alias("corners"))


@query("polygon_fan", "SELECT population_id, k, objects[1] AS a, objects[k + 1] AS b, objects[k + 2] AS c FROM (SELECT *, CAST(unnest(range(1, len(objects) - 1)) AS integer) AS k FROM (SELECT DISTINCT ON (population_id) population_id, objects FROM population))")
def polygon_fan(spark: SparkSession, d: str) -> DataFrame:
    return meshes.polygon_fan(table(spark, d, "population").dropDuplicates(["population_id"]), ["population_id"], "objects")


def _glb_files(spark: SparkSession, d: str) -> DataFrame:
    """(uid, content): height fields as GLB files; every third without texture coordinates, every second under a node that moves and scales it."""
    v, uv, f = _mesh(spark, d)
    lists = lambda df, key, cols: df.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct(key, *cols))).alias("l")).select("uid", F.flatten(F.transform("l", lambda s: F.array(*[s[c].cast("double") for c in cols]))).alias(f"l_{key}"))
    j = lists(v, "vid", ["x", "y", "z"]).join(lists(f, "fid", ["a", "b", "c"]), "uid").join(lists(uv, "tid", ["u", "v"]), "uid")

    def rows(it):
        for b in it:
            data = [
                meshes.glb_bytes(np.array(p).reshape(-1, 3), np.array(t).reshape(-1, 3), np.array(u).reshape(-1, 2) if k % 3 else None, {"translation": [4.0, 0.0, -2.0], "scale": [2.0, 2.0, 2.0]} if k % 2 else None)
                for k, p, t, u in zip(b.column("uid").to_pylist(), b.column("l_vid").to_pylist(), b.column("l_fid").to_pylist(), b.column("l_tid").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([b.column("uid"), pa.array(data, pa.binary())], ["uid", "content"])

    return j.mapInArrow(rows, "uid long, content binary")


_GLB_AT = "round(CAST(CAST({c} AS float) AS double) * CASE WHEN uid % 2 = 1 THEN 2 ELSE 1 END + CASE WHEN uid % 2 = 1 THEN {t} ELSE 0 END, 5) + 0"


# values of every vertex and texture coordinate (v as it stands in the file), and of every face in order
@query(
    "glb_scan",
    f"""WITH {fx.FIELD}, {_ORDERED} SELECT uid, 'v' AS part, vid AS n, {_GLB_AT.format(c="x", t=4)} AS p, {_GLB_AT.format(c="y", t=0)} AS q, {_GLB_AT.format(c="z", t=-2)} AS r FROM mv
    UNION ALL SELECT uid, 'vt', tid, round(CAST(CAST(u AS float) AS double), 5), round(CAST(CAST(v AS float) AS double), 5), NULL FROM mt WHERE uid % 3 <> 0
    UNION ALL SELECT uid, 'f', fid, a, b, c FROM of""",
)
def glb_scan(spark: SparkSession, d: str) -> DataFrame:
    v, t, f = meshes.glb_mesh(meshes.glb_scan(_glb_files(spark, d)))
    r = lambda c: F.round(c, 5) + F.lit(0.0)
    wide = lambda *cols: [F.col(c).cast("double").alias(n) for c, n in zip(cols, "pqr")]
    out = v.select("uid", F.lit("v").alias("part"), F.col("vid").alias("n"), r("x").alias("p"), r("y").alias("q"), r("z").alias("r"))
    out = out.unionByName(t.select("uid", F.lit("vt").alias("part"), F.col("tid").alias("n"), r("u").alias("p"), r("v").alias("q"), F.lit(None).cast("double").alias("r")))
    return out.unionByName(f.select("uid", F.lit("f").alias("part"), F.col("fid").alias("n"), *wide("a", "b", "c")))


@query("glb_texcoord", f"WITH {fx.FIELD} SELECT uid, uid % 3 <> 0 AS has_texcoord FROM (SELECT DISTINCT uid FROM mv)")
def glb_texcoord(spark: SparkSession, d: str) -> DataFrame:
    return meshes.declares_texcoord(_glb_files(spark, d))


def _read_images(spark: SparkSession, folder: str) -> DataFrame:
    images = spark.read.format("image").load(folder)
    return images.withColumn("img", F.regexp_extract("image.origin", r"([0-9]+)\.png", 1).cast("long"))


@query("png_roundtrip", f"WITH {fx.PX} SELECT img, y, x, r, g, b FROM px")
def png_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Images to PNG files in the shared folder, read back by the image source."""
    out = shared_table(spark, "png")
    arrays.png_files(fx.pixels(spark, d), out)
    return arrays.image_pixels(_read_images(spark, out))


@query("png_modes", f"WITH {fx.PX} SELECT img, y, x, r, CASE WHEN img % 2 = 0 THEN r ELSE g END AS g, CASE WHEN img % 2 = 0 THEN r ELSE b END AS b FROM px")
def png_modes(spark: SparkSession, d: str) -> DataFrame:
    """Grey files and files with alpha, read back as colours."""
    out, px = shared_table(spark, "png"), fx.pixels(spark, d)
    odd = F.pmod("img", F.lit(2)) == 1
    arrays.png_files(px.filter(~odd).select("img", "y", "x", F.col("r").alias("v")), out)
    arrays.png_files(px.filter(odd).select("img", "y", "x", "r", "g", "b", F.pmod("x", F.lit(256)).alias("a")), out)
    return arrays.image_pixels(_read_images(spark, out))


@query("mask_roundtrip", f"WITH {fx.PX} SELECT img, y, x, CASE WHEN img % 2 = 0 THEN valid ELSE (r * 19595 + g * 38470 + b * 7471 + 32768) // 65536 > 127 END AS valid FROM px JOIN vm USING (img, y, x)")
def mask_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Masks to grey files, and colour files read as masks."""
    out, px = shared_table(spark, "png"), fx.pixels(spark, d)
    even = F.pmod("img", F.lit(2)) == 0
    arrays.png_files(fx.valid(px).filter(even).withColumnRenamed("valid", "v"), out)
    arrays.png_files(px.filter(~even), out)
    return arrays.mask_pixels(_read_images(spark, out))


@query("jsonl_roundtrip", "SELECT caption_id, uid, caption, family FROM captions")
def jsonl_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Captions to JSON lines and back."""
    out = shared_table(spark, "jsonl")
    records.write_jsonl(table(spark, d, "captions").select("caption_id", "uid", "caption", "family"), out, "caption_id")
    return spark.read.schema("caption_id long, uid string, caption string, family string").json(out)


@query("jsonl_lines", "SELECT caption_id, row_number() OVER (ORDER BY caption_id) AS line_no, uid FROM (SELECT DISTINCT caption_id, uid FROM captions)")
def jsonl_lines(spark: SparkSession, d: str) -> DataFrame:
    """Captions as one file of JSON lines, read in small splits: lines keep their numbers."""
    out = shared_table(spark, "jsonl")
    rows = table(spark, d, "captions").select("caption_id", F.coalesce("uid", F.lit("")).alias("uid"), F.col("uid").isNull().alias("none")).distinct()
    rows.coalesce(1).sortWithinPartitions("caption_id").write.json(out)
    at = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 << 10))
    try:
        lines = records.numbered_lines(spark, out)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", at)
    r = F.from_json("value", "caption_id long, uid string, none boolean").alias("r")
    return lines.select("line_no", r).select("r.caption_id", "line_no", F.when(~F.col("r.none"), F.col("r.uid")).alias("uid"))


@query("replaced_table", "SELECT DISTINCT claim_id, op FROM claims WHERE op <> 'touch'")
def replaced_table(spark: SparkSession, d: str) -> DataFrame:
    """A table that is replaced by a frame that reads it, and a failed write that leaves no trace."""
    v = Versions(spark, shared_table(spark, "replaced"))
    v.replace(table(spark, d, "claims").select("claim_id", "op").distinct())
    current = lambda: v.read([v.latest()[1]], "claim_id long, op string")
    v.replace(current().filter("op <> 'touch'"))
    v.write(current().filter("op = 'claim'"))
    return current()


@query("safetensors_families", f"WITH {fx.PX} SELECT img AS uid, family, y, x, CAST(r AS bigint) AS face_id FROM px CROSS JOIN (VALUES ('xatlas'), ('partial')) t(family) WHERE y % 4 = 0 AND x % 4 = 0")
def safetensors_families(spark: SparkSession, d: str) -> DataFrame:
    """Arrays of two families written as safetensors bytes and read back every fourth texel."""
    px = fx.pixels(spark, d)
    g = px.groupBy(F.col("img").alias("uid")).agg(F.array_sort(F.collect_list(F.struct("y", "x", "r"))).alias("p")).join(im.sizes(px).withColumnRenamed("img", "uid"), "uid").select("uid", "h", "w", F.transform("p", lambda s: s["r"]).alias("v"))

    def rows(it):
        for b in it:
            for uid, h, w, v in zip(b.column("uid").to_pylist(), b.column("h").to_pylist(), b.column("w").to_pylist(), b.column("v").to_pylist()):
                a = np.array(v).reshape(h, w)
                third = np.full((h, w, 3), 1 / 3)
                data = arrays.tensor_bytes({"xatlas_face_id": a.astype(np.int32), "xatlas_barycentric": np.moveaxis(third, -1, 0).astype(np.float16), "partial_face_id": a.astype(np.int64), "partial_barycentric": third.astype(np.float32)})
                yield pa.RecordBatch.from_arrays([pa.array([uid], pa.int64()), pa.array([data], pa.binary())], ["uid", "content"])

    return arrays.family_scan(g.mapInArrow(rows, "uid long, content binary")).select("uid", "family", "y", "x", "face_id")


# a stream gives out what its watermark has passed: six hours before the last event, in whole milliseconds
_PASSED = "(SELECT epoch_ms(max(event_at)) - 6 * 3600000 FROM claims WHERE uid IS NOT NULL AND event_at IS NOT NULL)"


@query("stream_claims", TABULAR["queue_claims"].replace("FROM claims", f"FROM (SELECT * FROM claims WHERE epoch_us(event_at) <= {_PASSED} * 1000)"))
def stream_claims(spark: SparkSession, d: str) -> DataFrame:
    return lease.run_to_table(lease.claims_won(lease.read_events(spark, f"{d}/claims.parquet")), "won")


@query("stream_sessions", f"SELECT * FROM ({TABULAR['queue_sessions']}) WHERE epoch_us(last_at) + {lease.LEASE_SECONDS} * 1000000 <= {_PASSED} * 1000")
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    return lease.run_to_table(lease.sessions(lease.read_events(spark, f"{d}/claims.parquet")), "sessions")


@query("prepare_mesh", f"WITH {fx.FIELD} SELECT uid, count(*) AS n_vertices FROM mv GROUP BY uid")
def prepare_mesh(spark: SparkSession, d: str) -> DataFrame:
    """Height fields through OBJ text, scan and contract check."""
    v, t, f = meshes.obj_scan(meshes.obj_text(meshes.obj_lines(*_mesh(spark, d))))
    ok = ras.mesh_check(v, f)
    return ok.filter("not_finite = 0 and out_of_range = 0").select("uid", "n_vertices")
