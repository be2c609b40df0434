"""The stages of a run as compositions of operators, and their command line.

A work folder holds tables as published versions: population, captions, attempts, pixels, valid, delivered,
measurements, verdicts and those of prepare. Each stage reads tables and writes some; a table is replaced as a whole, by a
manifest that can be written only once. The ledger (claims, completions, releases) only grows, an append at a time.

The models (caption, reference, generate) are outside: a configuration may name the command of a worker, which reads
the work folder and writes its products there. Without one, a stage says what it lacks and ends with an error.
"""

from __future__ import annotations

import argparse
import json
import os
import subprocess
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators import captions as cap
from lamina.operators import gates, identity, image, ledger, raster, view
from lamina.operators.measures import asked_key, assembled, delivery_action, preparation_notes, resolved_families, sheet_agreement
from lamina.session import build_session, hadoop_path, settled
from lamina.sources import arrays, meshes, records
from lamina.sources.versions import Versions
from lamina.versions import VERSIONS

STAGES = ("caption", "reference", "generate", "assetize", "measure")
#: Stages whose key has the delivery parameters in it.
DELIVERY_STAGES = ("assetize", "measure")
#: Fields of a recipe and their defaults.
RECIPE = {"reference_model": "", "reference_steps": 20, "reference_suffix": ", plain background", "atlas_resolution": 2048, "uv_convention": "v-down", "texture_resolution": 256, "margin_px": 4}
LEDGER = "claim_id long, stage string, uid string, op string, owner string, content_key string, event_at timestamp_ntz, extra map<string,string>"


class Refused(RuntimeError):
    """A stage cannot run, and says why."""


class Run:
    """One work folder with its recipe."""

    def __init__(self, spark: SparkSession, work: str, config: dict | None = None):
        self.spark, self.work, self.config = spark, work.rstrip("/"), config or {}
        self.recipe = RECIPE | self.config.get("recipe", {})

    # ------------------------------------------------------------- tables
    def versions(self, name: str) -> Versions:
        return Versions(self.spark, f"{self.work}/{name}")

    def table(self, name: str) -> DataFrame:
        last = self.versions(name).latest()
        if last is None:
            raise Refused(f"no table {name} in {self.work}")
        return self.spark.read.parquet(f"{self.work}/{name}/{last[1]['data']}")

    def has(self, name: str) -> bool:
        return self.versions(name).latest() is not None

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """The table replaced as a whole; a stage may read its old self meanwhile, and a crash leaves that one."""
        self.versions(name).replace(df)
        return self.table(name)

    def merged(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """The table with the rows of these keys replaced."""
        return self.write(ledger.upsert(self.table(name), df, key) if self.has(name) else df, name)

    # ------------------------------------------------------------- ledger
    def ledger(self) -> DataFrame:
        v = self.versions("ledger")
        return v.read(list(v.published().values()), LEDGER)

    def log(self, rows: DataFrame, stage: str, op: str, owner: str) -> None:
        """Appends one event for each (uid, content_key[, extra])."""
        now = time.time_ns() // 1000
        extra = F.col("extra") if "extra" in rows.columns else F.lit(None).cast("map<string,string>")
        at = F.timestamp_micros(F.lit(now)).cast("timestamp_ntz")
        id_ = F.xxhash64("uid", F.lit(stage), F.lit(op), F.lit(now))
        self.versions("ledger").append(rows.select(id_.alias("claim_id"), F.lit(stage).alias("stage"), "uid", F.lit(op).alias("op"), F.lit(owner).alias("owner"), "content_key", at.alias("event_at"), extra.alias("extra")))

    def done(self, stage: str) -> DataFrame:
        return ledger.latest_done(self.ledger().filter(F.col("stage") == stage))

    # --------------------------------------------------------------- keys
    def population(self) -> DataFrame:
        if not self.has("population"):
            raise Refused(f"no population in {self.work}: select objects or prepare meshes first")
        return self.table("population")

    def keys(self) -> DataFrame:
        """(uid, place, generation_key, delivery_key) of the work set: by caption, attempt and the recipe's values."""
        p = self.population().select("uid", "place")
        caps = self.table("captions").filter("caption <> ''").select("uid", "caption") if self.has("captions") else None
        tries = self.table("attempts").select("uid", "attempt") if self.has("attempts") else None
        p = p.join(caps, "uid", "left") if caps is not None else p.withColumn("caption", F.lit(None).cast("string"))
        p = p.join(tries, "uid", "left") if tries is not None else p.withColumn("attempt", F.lit(None).cast("int"))
        p = p.withColumn("generation_key", identity.generation_key(F.col("caption"), F.col("attempt"), identity.recipe_digest(self.recipe)))
        return p.select("uid", "place", "generation_key", identity.delivery_key(F.col("generation_key"), identity.recipe_digest(self.recipe, identity.DELIVERY_FIELDS)).alias("delivery_key"))

    # ------------------------------------------------------------- stages
    def prepare(self, *paths: str, res: int = 256, view_res: int = 512) -> DataFrame:
        """OBJ and GLB files to vertices, layouts, address maps, masks, generator texts, shape views and one record each.

        A mesh without a usable layout gets the grid layout. A file that gives no mesh keeps its record, with an error.
        """
        files = settled(self.spark.read.format("binaryFile").load(list(paths)).select(identity.content_uid(F.col("content")).alias("uid"), "content", F.col("path").alias("source"), meshes.format_of(F.col("path")).alias("format")), "files")
        obj = files.filter("format = 'obj'").select("uid", F.try_validate_utf8("content").alias("content"))
        scan = settled(meshes.glb_scan(files.filter("format = 'gltf'")), "glb")
        v, t, f = (settled(a.unionByName(b), "mesh") for a, b in zip(meshes.obj_scan(obj.filter("content is not null")), meshes.glb_mesh(scan.filter("part <> 'error'"))))
        bad = raster.uv_range(t).filter("out_of_range").select("uid")
        own = f.filter("ta is not null").join(bad, "uid", "left_anti")
        made = f.join(own.select("uid").distinct(), "uid", "left_anti")
        gv, gf = raster.grid_unwrap(made)
        uv = t.join(own.select("uid").distinct(), "uid", "left_semi").unionByName(gv)
        uf = own.select("uid", "fid", "ta", "tb", "tc").unionByName(gf)
        v, f, uv, uf = (self.write(df, name) for name, df in (("vertices", v), ("faces", f), ("uv_vertices", uv), ("uv_faces", uf)))
        s = raster.stats(uv, uf, res)
        kept = own.select("uid").distinct().withColumn("uv_source", F.lit("supplied"))
        n = v.groupBy("uid").agg(F.greatest(*[F.max(c) - F.min(c) for c in "xyz"]).alias("_extent"))
        check = raster.mesh_check(v, f, uv, uf).select("uid", F.when(F.col("n_vertices") > 0, F.col("n_vertices")).alias("n_vertices"), "problem")
        seen = f.select("uid").distinct().withColumn("_faces", F.lit(True))
        unread = scan.filter("part = 'error'").select("uid").unionByName(obj.filter("content is null").select("uid")).distinct().withColumn("_unread", F.lit(True))
        rec = files.select("uid", "source", "format")
        flags = bad.withColumn("uv_out_of_range", F.lit(True))
        for df in (s, n, check, kept, seen, unread, flags):
            rec = rec.join(df, "uid", "left")
        error = (
            F.when(F.col("format") == "unsupported", "unsupported format")
            .when(F.col("_unread"), "unreadable file")
            .when(F.col("n_vertices").isNull(), "no vertices")
            .when(F.col("_faces").isNull(), "no faces")
            .when(F.col("problem").isNotNull(), F.col("problem"))
            .when(F.coalesce("valid_px", F.lit(0)) == 0, "layout covers no texel")
            .when(~F.coalesce(F.col("_extent") > 0, F.lit(False)), "mesh has zero extent")
        )
        rec = rec.withColumns({"resolution": F.lit(res), "error": error, "uv_source": F.when(F.col("_faces"), F.coalesce("uv_source", F.lit("grid"))), "uv_out_of_range": F.coalesce("uv_out_of_range", F.lit(False)), "overlap_texels": F.col("overlap_px")})
        rec = rec.withColumn("notes", F.when(F.col("_faces"), preparation_notes())).drop("_extent", "_faces", "_unread", "problem")
        out = self.write(rec, "prepared")
        good = out.filter("error is null").select("uid").distinct()
        a = self.write(raster.address_map(uv, uf, res).join(good, "uid", "left_semi"), "addresses")
        side = F.sequence(F.lit(0), F.lit(res - 1))
        grid = good.withColumn("y", F.explode(side)).withColumn("x", F.explode(side)).join(a.select("uid", "y", "x", "coverage"), ["uid", "y", "x"], "left")
        self.write(grid.select(F.col("uid").alias("img"), "y", "x", F.coalesce(F.col("coverage") == 1, F.lit(False)).alias("valid")), "valid")
        v, f, uv, uf = (df.join(good, "uid", "left_semi") for df in (v, f, uv, uf))
        self.write(meshes.obj_text(meshes.obj_lines(v, uv, f.select("uid", "fid", "a", "b", "c").join(uf, ["uid", "fid"]))), "generator_obj")
        cams, nv = view.camera_table(self.spark, view.shape_cameras()), view.normalized(v, "sphere")
        self.write(view.shaded(view.fragments(nv, f, cams, view_res), nv, f, cams), "shape_views")
        self.select(good)
        return out

    def generator_mesh(self) -> tuple[DataFrame, DataFrame, DataFrame] | None:
        """(vertices, uv_vertices, faces) read back from the text the generator was given, as it painted into that one."""
        return meshes.obj_scan(self.table("generator_obj")) if self.has("generator_obj") else None

    def select(self, objects: DataFrame, pilot: int = 0) -> DataFrame:
        """Freezes or extends the work set, in rank order."""
        objects = objects.select("uid")
        if self.has("population"):
            objects = self.table("population").select("uid").unionByName(objects)
        return self.write(identity.pilot(objects.distinct(), pilot, identity.rank_sha256(F.col("uid"))), "population")

    def merge_captions(self, captions: DataFrame) -> DataFrame:
        return self.write(cap.merge(captions), "captions")

    def spawn(self, stage: str) -> int:
        """Runs the workers of a model stage side by side; 0 where all ended well. The command is the configuration's."""
        command = self.config.get("workers", {}).get(stage)
        if not command:
            raise Refused(f"no worker for {stage}: the models are outside; name its command under workers.{stage}, or let its products be written to {self.work} and completed in the ledger")
        plan = ledger.worker_plan(self.spark, int(self.config.get("gpus", 1)), 1 if stage == "reference" else int(self.config.get("workers_per_gpu", 1))).collect()
        env = lambda r: os.environ | {"LAMINA_WORK": self.work, "LAMINA_WORKER": str(r.worker), "CUDA_VISIBLE_DEVICES": str(r.gpu)}
        procs = [subprocess.Popen(command, env=env(r)) for r in plan]
        return int(any([p.wait() != 0 for p in procs]))

    def deliver(self, size: int | None = None, margin: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """Atlases (pixels, valid) to delivered textures, and to full ones without a margin, which views are rendered from."""
        size, margin = size or self.recipe["texture_resolution"], self.recipe["margin_px"] if margin is None else margin
        px, grid = self.table("pixels"), self.table("valid")
        if only is not None:
            px, grid = (df.join(only.select(F.col("uid").alias("img")), "img", "left_semi") for df in (px, grid))
        full = settled(image.resized(image.dilate_full(px, grid), size, dims=image.sizes(grid)), "full")
        self.merged(full, "texture_full", "img")
        return self.merged(image.margin_ring(full, image.mask_resized(grid, size, image.sizes(grid)), margin), "delivered", "img")

    def assetize(self, limit: int = 0, owner: str = "assetize") -> dict:
        """Delivers what is due, in the order of the work set, and logs it: counts of what was done and why not.

        Due is an object that is not complete at its delivery key, or whose atlas (table atlases: uid, atlas_at) is newer. Refused
        are objects whose atlas was not completed at the current generation key, or is not there; an atlas with the bytes of
        the last delivery is left alone.
        """
        k = self.keys()
        own = self.done("assetize").select("uid", F.col("content_key").alias("own_key"), F.col("event_at").alias("delivered_at"), F.col("extra")["atlas_digest"].alias("own_digest"), F.col("extra")["delivery_key"].alias("own_delivery"))
        gen = self.done("generate").select("uid", F.col("content_key").alias("done_key"))
        due = k.join(own, "uid", "left").join(gen, "uid", "left")
        due = due.join(self.table("atlases").select("uid", "atlas_at"), "uid", "left") if self.has("atlases") else due.withColumn("atlas_at", F.lit(None).cast("timestamp_ntz"))
        due = due.withColumn("asked_key", asked_key(F.col("delivery_key"), F.col("atlas_at"), F.col("delivered_at")))
        due = due.filter(~F.col("asked_key").eqNullSafe(F.col("own_key"))).orderBy("place")
        due = settled(due.limit(limit) if limit else due, "due")
        atlas = None
        if self.has("pixels") and self.has("valid"):
            mask = self.table("valid").select("img", "y", "x", F.when(F.col("valid"), 255).otherwise(0).alias("r"), F.lit(0).alias("g"), F.lit(0).alias("b"))
            mine = lambda df: df.join(due.select(F.col("uid").alias("img")), "img", "left_semi")
            # the digest of an atlas is read only for objects that are due
            atlas = image.digest(mine(self.table("pixels"))).join(image.digest(mine(mask)).withColumnRenamed("digest", "mask"), "img").select(F.col("img").alias("uid"), F.concat_ws("|", "digest", "mask").alias("atlas"))
        due = due.join(atlas, "uid", "left") if atlas is not None else due.withColumn("atlas", F.lit(None).cast("string"))
        act = settled(delivery_action(due.withColumn("current_key", F.col("generation_key"))), "actions")
        self.log(act.select("uid", F.col("delivery_key").alias("content_key")), "assetize", "claim", owner)
        ready = act.filter("action = 'deliver'")
        counts = {r.action: r["count"] for r in act.groupBy("action").count().collect()}
        if counts.get("deliver"):
            out = image.digest(self.deliver(only=ready).join(ready.select(F.col("uid").alias("img")), "img", "left_semi")).select(F.col("img").alias("uid"), F.col("digest").alias("delivered"))
            pairs = [x for kv in (("atlas_digest", "atlas"), ("delivered_digest", "delivered"), ("generation_key", "generation_key"), ("delivery_key", "delivery_key")) for x in (F.lit(kv[0]), F.col(kv[1]))]
            self.log(ready.join(out, "uid").select("uid", F.col("delivery_key").alias("content_key"), F.create_map(*pairs).alias("extra")), "assetize", "complete", owner)
        self.log(act.filter("action <> 'deliver'").select("uid", F.col("delivery_key").alias("content_key")), "assetize", "release", owner)
        return {"assetized": counts.get("deliver", 0), "missing_atlas": counts.get("missing atlas", 0), "atlas_not_current": counts.get("stale", 0), "unchanged_atlas": counts.get("unchanged", 0)}

    def measure(self, size: int | None = None, view_res: int = 512, only: DataFrame | None = None) -> DataFrame:
        """Fresh measurement rows over the delivered textures, folded into the stored ones.

        What else is there is measured too: references, sheets (uid, y, x, r, g, b), families (uid, family, i, face_id,
        b0, b1, b2), bless (uid, note) and render (uid, measures, note); sheets and families need the tables of prepare.
        """
        size = size or self.recipe["texture_resolution"]
        valid, px = self.table("valid"), self.table("delivered")
        if only is not None:
            valid, px = (df.join(only.select(F.col("uid").alias("img")), "img", "left_semi") for df in (valid, px))
        grid = image.mask_resized(valid, size, image.sizes(valid))
        there = lambda name: self.table(name) if self.has(name) else None
        named = lambda df: df.withColumn("uid", F.col("img").cast("string")).drop("img")
        mesh = [there(n) for n in ("vertices", "faces", "uv_vertices", "uv_faces")]
        whole, agreement, resolved = all(m is not None for m in mesh), None, None
        if whole and self.has("sheets"):
            full = self.table("texture_full") if self.has("texture_full") else px
            agreement = sheet_agreement(tuple(mesh), named(full), self.table("sheets"), view_res)
        if whole and self.has("families"):
            resolved = resolved_families(self.table("families"), mesh[2], mesh[3], named(px))
        fresh = assembled(px, grid, there("references"), agreement, resolved, there("bless"), there("render"), self.recipe["margin_px"]).drop("img")
        if self.has("measurements"):
            old = self.table("measurements")
            kinds = {f.name: f.dataType for f in fresh.schema}
            old = old.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in old.columns})
            fresh = fresh.withColumns({f.name: F.lit(None).cast(f.dataType) for f in old.schema if f.name not in kinds})
            fresh = ledger.upsert(old, fresh, "uid")
        return self.write(fresh, "measurements")

    def measure_due(self, view_res: int = 512, owner: str = "measure") -> dict:
        """Measures delivered objects that are not complete at their delivery key: complete without an error, released with one."""
        k = self.keys().select("uid", F.col("delivery_key").alias("content_key"))
        ready = self.done("assetize").select("uid", "content_key")
        due = settled(k.join(ready, ["uid", "content_key"], "left_semi").join(self.done("measure").select("uid", "content_key"), ["uid", "content_key"], "left_anti"), "due")
        n = due.count()
        if n:
            self.log(due, "measure", "claim", owner)
            rows = due.join(self.measure(view_res=view_res, only=due).select("uid", "error"), "uid")
            rows = settled(rows, "measured")
            self.log(rows.filter("error is null").select("uid", "content_key"), "measure", "complete", owner)
            self.log(rows.filter("error is not null").select("uid", "content_key"), "measure", "release", owner)
        all_rows = self.table("measurements") if self.has("measurements") else None
        if all_rows is None:
            return {"measured": 0, "rows_total": 0, "errors": 0, "unmeasured_fields": {}}
        total = all_rows.agg(F.count("*").alias("n"), F.count_if(F.col("error").isNotNull()).alias("bad")).first()
        return {"measured": n, "rows_total": total.n, "errors": total.bad, "unmeasured_fields": {r.field: r.n for r in gates.unmeasured_counts(all_rows).collect()}}

    def gate(self, thresholds: gates.Thresholds = gates.Thresholds()) -> DataFrame:
        if not self.has("measurements"):
            raise Refused(f"no measurements in {self.work}: the gate judges stored rows and makes none")
        rows = self.table("measurements")
        return self.write(rows.select("uid", gates.verdict(thresholds).alias("verdict"), gates.reasons(thresholds).alias("reasons"), gates.logged(thresholds).alias("logged")), "verdicts")

    def status(self) -> dict:
        """Objects, captions, the state of each stage by the ledger at the current keys, and the verdicts."""
        out: dict = dict(VERSIONS)
        if self.has("population"):
            k = settled(self.keys(), "keys")
            out["objects"] = k.count()
            out["with_caption"] = self.table("captions").filter("caption <> ''").join(k, "uid", "left_semi").count() if self.has("captions") else 0
            stages = self.spark.createDataFrame([(s, s in DELIVERY_STAGES) for s in STAGES], "stage string, late boolean")
            current = k.crossJoin(F.broadcast(stages)).select("stage", "uid", F.when(F.col("late"), F.col("delivery_key")).otherwise(F.col("generation_key")).alias("content_key"))  # five stages
            events = self.ledger()
            held = ledger.expired(events, F.current_timestamp())
            rows = ledger.status(k.select("uid"), current, ledger.latest_done(events), held).collect()
            out["stages"] = {r.stage: {c: r[c] for c in ("total", "done", "superseded", "remaining", "in_flight", "stale")} for r in rows}
        if self.has("verdicts"):
            n = {r.verdict or "": (r.n, r.pass_rate) for r in gates.summary(self.table("verdicts")).collect()}
            judged, rate = n.pop("", (0, 0.0))
            out["gates"] = {"judged": judged, "pass": n.get("PASS", (0,))[0], "pass_rate": rate, "by_verdict": {v: c for v, (c, _) in sorted(n.items(), key=lambda x: -x[1][0])}}
        return out

    def texture(self, mesh: str, out: str, thresholds: gates.Thresholds = gates.Thresholds(), view_res: int = 512) -> dict:
        """One mesh in, one texture out: the whole loop on one object. Where a stage refuses or fails, nothing after it runs."""
        prepared = self.prepare(mesh, res=self.recipe["texture_resolution"], view_res=view_res).collect()
        if len(prepared) != 1 or prepared[0].error:
            raise Refused(f"prepare: {prepared[0].error if prepared else 'no file'}")
        uid = prepared[0].uid
        for stage in ("caption", "reference", "generate"):
            key = self.keys().filter(F.col("uid") == uid).first().generation_key
            if self.done(stage).filter((F.col("uid") == uid) & (F.col("content_key") == key)).isEmpty() and self.spawn(stage):
                raise Refused(f"{stage}: a worker failed")
        made = self.assetize()
        if made["missing_atlas"] or made["atlas_not_current"]:
            raise Refused(f"assetize: {json.dumps(made)}")
        if self.measure_due(view_res)["errors"]:
            raise Refused("measure: the delivered texture breaks the margin rule")
        row = self.gate(thresholds).filter(F.col("uid") == uid).first()
        arrays.png_files(self.table("delivered").filter(F.col("img") == uid).withColumn("img", F.lit("texture")), out)
        return {"texture": f"{out}/texture.png", "uid": uid, "verdict": row.verdict, "reasons": row.reasons, "logged": row.logged, "work": self.work}


def _prepare(run: Run, a) -> int:
    return int(not run.prepare(*a.mesh, res=run.recipe["texture_resolution"]).filter("error is not null").isEmpty())


def _select(run: Run, a) -> int:
    run.select(records.read_population(run.spark, a.population), a.pilot)
    return 0


def _caption(run: Run, a) -> int:
    code = run.spawn("caption") if run.config.get("workers", {}).get("caption") else 0
    fs, p = hadoop_path(run.spark, f"{run.work}/shards/*.jsonl")
    if not fs.globStatus(p):
        raise Refused(f"no caption shards in {run.work}/shards and no worker that writes them")
    lines = records.read_captions(run.spark, f"{run.work}/shards/*.jsonl").withColumn("caption_id", F.lit(None).cast("long"))
    run.merge_captions(lines.withColumn("error", cap.error_text(F.col("error"))))
    return code


def _assetize(run: Run, a) -> int:
    made = run.assetize(a.limit)
    print(json.dumps(made))
    return int(bool(made["missing_atlas"] or made["atlas_not_current"]))


def _measure(run: Run, a) -> int:
    report = run.measure_due()
    print(json.dumps(report))
    return int(bool(report["errors"]))


def _gate(run: Run, a) -> int:
    run.gate(records.load_thresholds(a.thresholds) if a.thresholds else gates.Thresholds())
    return 0


def _texture(run: Run, a) -> int:
    out = run.texture(a.mesh[0], a.out or f"{run.work}/out", records.load_thresholds(a.thresholds) if a.thresholds else gates.Thresholds())
    print(json.dumps(out, default=str))
    return 0 if out["verdict"] == "PASS" else 2


COMMANDS: dict[str, Callable[[Run, argparse.Namespace], int]] = {
    "texture": _texture,
    "select": _select,
    "prepare": _prepare,
    "caption": _caption,
    "reference": lambda run, a: run.spawn("reference"),
    "generate": lambda run, a: run.spawn("generate"),
    "assetize": _assetize,
    "measure": _measure,
    "gate": _gate,
    "status": lambda run, a: 0,
}


def main(args: list[str], spark: SparkSession | None = None) -> int:
    """0 done, 1 a stage failed, refused or left work undone, 2 a texture that does not pass."""
    p = argparse.ArgumentParser(prog="lamina")
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("--config")
    p.add_argument("--work")
    p.add_argument("--mesh", nargs="*", default=[])
    p.add_argument("--population")
    p.add_argument("--pilot", type=int, default=0)
    p.add_argument("--limit", type=int, default=0)
    p.add_argument("--thresholds")
    p.add_argument("--out")
    a = p.parse_args(args)
    try:
        config = records.load_config(a.config, () if a.work else ("work",)) if a.config else {}
        work = a.work or config.get("work")
        if not work:
            raise Refused("no work folder: give --work, or work in the configuration")
        run = Run(spark or build_session(), work, config)
        code = COMMANDS[a.command](run, a)
        print(json.dumps(run.status()))
        return code
    except (Refused, FileNotFoundError, ValueError) as e:
        print(f"{a.command}: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
