"""Stages end to end, gates, captions, configuration."""

import base64
import json
import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.operators import captions as cap
from lamina.operators import gates, identity, raster
from grids import encode_grid
from lamina.operators import image as im
from lamina.run import Refused, Run, main
from lamina.sources import arrays, meshes, records

CLEAN = {"uid": "u", "error": None, "g1_dark_frac": 0.034, "g1_max_blob": 0.21, "g1_ref_dark": None, "g1_bless": False, "g8_psnr": 22.5, "g8_psnr_flip": 9.5, "g3_note": "", "g3_ratio": 0.62, "g4_iou_min": 0.955, "g4_iou_orig": 0.961, "g5_valid_views": 6, "g6_bad_fraction": 0.0002, "g7_ring_difference": 0.9}
SCHEMA = ", ".join(f"{k} {'string' if k in ('uid', 'error', 'g3_note') else 'boolean' if k == 'g1_bless' else 'int' if k == 'g5_valid_views' else 'double'}" for k in CLEAN)


@pytest.mark.parametrize(
    "change,want",
    [({}, "PASS"), ({"error": "x"}, "FAIL:ERROR"), ({"g1_dark_frac": float("nan")}, "FAIL:G1_MISSING"), ({"g1_dark_frac": 0.5}, "FAIL:G1_DARK_NO_GAIN"), ({"g1_dark_frac": 0.5, "g1_ref_dark": 0.2}, "PASS"),
     ({"g1_dark_frac": 0.5, "g1_bless": True}, "PASS"), ({"g1_dark_frac": 0.2, "g1_max_blob": 0.6}, "FAIL:G1_DARK_SMEAR"), ({"g8_psnr": None}, "FAIL:G8_MISSING"), ({"g8_psnr": float("inf")}, "PASS"),
     ({"g8_psnr": 7.9}, "FAIL:G8_VIEW_MISMATCH"), ({"g8_psnr_flip": 27.0}, "FAIL:G8_VIEW_MISMATCH"), ({"g8_psnr": 14.0, "g8_psnr_flip": 13.0}, "FAIL:G8_VIEW_MISMATCH"), ({"g3_ratio": 0.3}, "FAIL:G3_ALBEDO_BAND"),
     ({"g3_ratio": 0.3, "g3_note": "none"}, "PASS"), ({"g3_ratio": None}, "PASS"), ({"g4_iou_min": None}, "FAIL:G4_FRAME"), ({"g4_iou_min": 0.8, "g4_iou_orig": 0.8}, "PASS"), ({"g4_iou_min": 0.8}, "FAIL:G4_FRAME"),
     ({"g5_valid_views": 2}, "FAIL:G5_GOLDEN"), ({"g6_bad_fraction": 0.002}, "FAIL:G6_CROSS_FAMILY"), ({"g7_ring_difference": 2.1}, "FAIL:G7_MARGIN_RING"), ({"g7_ring_difference": None}, "PASS")],
)
def test_verdict(spark, change, want):
    row = CLEAN | change
    df = spark.createDataFrame([tuple(row.values())], SCHEMA)
    assert df.select(gates.verdict(gates.Thresholds())).first()[0] == want


def test_caption_precedence(spark):
    rows = [(1, "u", "old", None, None, "captions.jsonl", 1), (2, "u", "w0", None, None, "captions_w0.jsonl", 9), (3, "u", "w1", None, None, "captions_w1.jsonl", 1), (4, "v", "cur", "curated", None, "captions.jsonl", 2),
            (5, "v", "new", None, None, "captions_w9.jsonl", 1), (6, "x", "first", "", None, "captions.jsonl", 3), (7, "x", "second", None, None, "captions.jsonl", 4), (8, None, "n", None, None, "captions.jsonl", 5)]
    df = spark.createDataFrame(rows, "caption_id long, uid string, caption string, family string, error string, shard string, line_no int")
    assert {r.uid: r.caption for r in cap.merge(df).collect()} == {"u": "w1", "v": "cur", "x": "first"}


def test_seeds_and_keys(spark):
    one = spark.range(1)
    assert one.select(identity.object_seed(F.lit("a" * 32), "generate")).first()[0] == 2125606136
    assert one.select(identity.content_key(F.lit("a"), F.lit(None).cast("string"))).first()[0] != one.select(identity.content_key(F.lit("a"))).first()[0]
    base = {"reference_steps": 20, "margin_px": 4}
    assert identity.recipe_digest(base) == identity.recipe_digest(base | {"margin_px": 8}) != identity.recipe_digest(base | {"reference_steps": 30})


def test_pilot_is_a_prefix(spark):
    df = spark.createDataFrame([(f"{i:032x}",) for i in range(50)], "uid string")
    few, many = ([r.uid for r in identity.pilot(df, n, identity.rank_blake2b(F.col("uid"))).orderBy("place").collect()] for n in (8, 20))
    assert many[:8] == few


OBJ = "v 0 0 0\nv 1 0 0\nv 1 1 0\nvt 0.1 0.1\nvt 0.9 0.1\nvt 0.9 0.9\nf 1/1 2/2 3/3\n"


def test_stages(spark, tmp_path):
    (tmp_path / "a.obj").write_text(OBJ)
    (tmp_path / "b.obj").write_text(OBJ.replace("vt 0.9 0.9", "vt 3 0.9"))
    run = Run(spark, f"file://{tmp_path}/work")
    rec = {r.source.rsplit("/", 1)[1]: r for r in run.prepare(f"{tmp_path}/*.obj", res=64).collect()}
    assert (rec["a.obj"].uv_source, rec["b.obj"].uv_source) == ("supplied", "grid") and rec["a.obj"].valid_px > 0
    assert rec["a.obj"].notes == [] and rec["b.obj"].notes[:2] == ["layout outside [0, 1], replaced", "layout made here"]
    rng = np.random.default_rng(0)
    mask = np.zeros((32, 32), bool)
    mask[6:26, 6:26] = True
    run.write(encode_grid(spark, 5, rng.integers(90, 250, (32, 32, 3)).astype(np.uint8)), "pixels")
    run.write(spark.createDataFrame([(5, y, x, bool(mask[y, x])) for y in range(32) for x in range(32)], "img long, y int, x int, valid boolean"), "valid")
    run.deliver(16)
    assert run.measure(16).first().error is None
    run.measure(16)
    run.gate()
    got = run.status()
    assert got["objects"] == 2 and got["gates"] == {"judged": 1, "pass": 0, "pass_rate": 0.0, "by_verdict": {"FAIL:G8_MISSING": 1}}
    assert got["stages"]["assetize"]["remaining"] == 2 and got["pipeline_version"]
    v, t, f = run.generator_mesh()
    assert f.count() == 2 and v.count() == 6


def test_prepare_keeps_every_file(spark, tmp_path):
    """A GLB is read, what gives no mesh is named, and the mask leads on to a delivered texture."""
    pos, uv = np.array([[0, 0, 0], [1, 0, 0], [1, 1, 0]], float), np.array([[0.1, 0.1], [0.9, 0.1], [0.9, 0.9]])
    (tmp_path / "m.glb").write_bytes(meshes.glb_bytes(pos, np.array([[0, 1, 2]]), uv))
    for name, data in (("broken.glb", b"glTF\xff\xfe"), ("points.obj", b"v 0 0 0\nv 1 0 0\n"), ("odd.obj", b"v \xff\xfe 0 0\n"), ("x.stl", b"solid")):
        (tmp_path / name).write_bytes(data)
    run = Run(spark, f"file://{tmp_path}/work")
    rec = {r.source.rsplit("/", 1)[1]: r for r in run.prepare(*[str(p) for p in tmp_path.glob("*.*")], res=16, view_res=16).collect()}
    assert {k: r.error for k, r in rec.items()} == {"m.glb": None, "broken.glb": "unreadable file", "points.obj": "no faces", "odd.obj": "unreadable file", "x.stl": "unsupported format"}
    assert rec["m.glb"].uv_source == "supplied" and run.status()["objects"] == 1
    assert run.table("valid").filter("valid").count() == rec["m.glb"].valid_px > 0 and run.table("valid").count() == 256
    assert run.table("shape_views").count() > 0 and "f 1/1 2/2 3/3" in run.table("generator_obj").first().content
    run.write(run.table("valid").select("img", "y", "x", *[F.lit(200).alias(c) for c in "rgb"]), "pixels")
    run.deliver(8)
    assert run.measure(8, 16).first().uid == rec["m.glb"].uid


def test_measure_takes_what_is_there(spark, tmp_path):
    """Two objects of one atlas; the first has a view sheet, a reference, families, a blessing and renderer numbers."""
    run = Run(spark, f"file://{tmp_path}/work")
    rng = np.random.default_rng(1)
    for img in (5, 6):
        part = encode_grid(spark, img, rng.integers(90, 250, (32, 32, 3)).astype(np.uint8))
        px = part if img == 5 else px.unionByName(part)
    run.write(px, "pixels")
    run.write(px.select("img", "y", "x", F.lit(True).alias("valid")), "valid")
    run.deliver(32)
    both = lambda rows, schema: spark.createDataFrame([(u, *r) for u in ("5", "6") for r in rows], "uid string, " + schema)
    run.write(both([(0, -1.0, -1.0, 0.0), (1, 1.0, -1.0, 0.0), (2, 1.0, 1.0, 0.0), (3, -1.0, 1.0, 0.0)], "vid long, x double, y double, z double"), "vertices")
    run.write(both([(0, 0.0, 1.0), (1, 1.0, 1.0), (2, 1.0, 0.0), (3, 0.0, 0.0)], "tid long, u double, v double"), "uv_vertices")
    run.write(both([(0, 0, 1, 2), (1, 0, 2, 3)], "fid long, a long, b long, c long"), "faces")
    run.write(both([(0, 0, 1, 2), (1, 0, 2, 3)], "fid long, ta long, tb long, tc long"), "uv_faces")
    # the sheet shows what the front view shows, on a ground of 10
    full = {(r.y, r.x): (r.r, r.g, r.b) for r in run.table("texture_full").filter("img = 5").collect()}
    tile = lambda y, x: full[(round((y - 1) / 30 * 31), round((x - 1) / 30 * 31))] if 1 <= y < 31 and 1 <= x < 31 else (10, 10, 10)
    run.write(spark.createDataFrame([("5", y, x, *(tile(y, x) if y < 32 and x < 32 else (10, 10, 10))) for y in range(64) for x in range(96)], "uid string, y int, x int, r int, g int, b int"), "sheets")
    run.write(spark.createDataFrame([("5", y, x, *([200] * 3 if y < 8 else [20] * 3)) for y in range(40) for x in range(40)], "uid string, y int, x int, r int, g int, b int"), "references")
    run.write(spark.createDataFrame([("5", f, i, i % 2 if f == "a" else 9, 1.0, 0.0, 0.0) for f in "ab" for i in range(4)], "uid string, family string, i long, face_id long, b0 double, b1 double, b2 double"), "families")
    run.write(spark.createDataFrame([("5", "looked at")], "uid string, note string"), "bless")
    run.write(spark.createDataFrame([("5", {"g3_ratio": 0.5, "g4_iou_min": 0.97, "g5_valid_views": 4.0, "seconds": 3.0}, "")], "uid string, measures map<string,double>, note string"), "render")
    row = {r.uid: r for r in run.measure(32, 32).collect()}
    assert row["6"].unmeasured == ["g1_ref_dark", "g3", "g4", "g5", "g6", "g7", "g8"] and not row["6"].g1_bless
    assert row["5"].unmeasured == ["g6", "g7"] and row["5"].g1_bless and row["5"].g1_ref_dark is not None
    assert row["5"].g8_views == 6 and row["5"].g8_psnr > row["5"].g8_psnr_flip and row["5"].family_resolve == {"a": 1.0, "b": 0.0}
    assert {r.uid: r.verdict for r in run.gate().collect()} == {"5": "PASS", "6": "FAIL:G8_MISSING"}


def atlas(spark, run, uids, seed=0):
    rng = np.random.default_rng(seed)
    parts = [encode_grid(spark, 0, rng.integers(90, 250, (32, 32, 3)).astype(np.uint8)).withColumn("img", F.lit(u)) for u in uids]
    px = parts[0]
    for p in parts[1:]:
        px = px.unionByName(p)
    run.write(px, "pixels")
    run.write(px.select("img", "y", "x", (F.col("x").between(6, 25) & F.col("y").between(6, 25)).alias("valid")), "valid")


def generated(run):
    run.log(run.keys().select("uid", F.col("generation_key").alias("content_key")), "generate", "complete", "gpu0")


def test_delivery_ladder(spark, tmp_path):
    """Stale, missing, delivered, unchanged and delivered anew; a limit; the ledger decides what is due."""
    uids = [f"{i:032x}" for i in range(3)]
    run = Run(spark, f"file://{tmp_path}/work", {"recipe": {"texture_resolution": 16}})
    with pytest.raises(Refused):
        run.population()
    run.select(spark.createDataFrame([(u,) for u in uids], "uid string"))
    none = {"assetized": 0, "missing_atlas": 0, "atlas_not_current": 0, "unchanged_atlas": 0}
    assert run.assetize() == none | {"atlas_not_current": 3}
    generated(run)
    assert run.assetize() == none | {"missing_atlas": 3}
    atlas(spark, run, uids)
    assert run.assetize(limit=1) == none | {"assetized": 1}
    assert run.assetize() == none | {"assetized": 2} and run.assetize() == none
    assert run.table("delivered").groupBy("img").count().filter("count = 256").count() == 3
    # a touched atlas with the same bytes is left alone, one with other bytes is delivered anew
    run.write(spark.createDataFrame([(u,) for u in uids], "uid string").withColumn("atlas_at", F.lit("2999-01-01").cast("timestamp_ntz")), "atlases")
    assert run.assetize() == none | {"unchanged_atlas": 3}
    atlas(spark, run, uids, 1)
    assert run.assetize() == none | {"assetized": 3}
    # another caption makes the atlas stale: it is not relabelled; another margin only delivers again
    run.write(spark.createDataFrame([("x", uids[0], "A chair", None, None)], "caption_id string, uid string, caption string, family string, error string"), "captions")
    run.recipe["margin_px"] = 2
    assert run.assetize() == none | {"assetized": 2, "atlas_not_current": 1}
    got = run.status()["stages"]["assetize"]
    assert (got["total"], got["done"], got["superseded"], got["remaining"]) == (3, 2, 1, 1)
    assert run.measure_due()["measured"] == 2 and run.measure_due()["measured"] == 0
    assert run.status()["stages"]["measure"]["done"] == 2


def test_formats_and_contract_fail_by_name(spark):
    assert spark.createDataFrame([("a.OBJ",)], "p string").select(meshes.supported(F.col("p"))).first()[0] == "obj"
    with pytest.raises(Exception, match="unsupported mesh format: a.stl"):
        spark.createDataFrame([("a.stl",)], "p string").select(meshes.supported(F.col("p"))).collect()
    v = spark.createDataFrame([("m", 0, 0.0, 0.0, 0.0), ("m", 1, float("nan"), 0.0, 0.0)], "uid string, vid long, x double, y double, z double")
    f = spark.createDataFrame([("m", 0, 0, 1, 7)], "uid string, fid long, a long, b long, c long")
    check = raster.mesh_check(v, f)
    r = check.first()
    assert (r.not_finite, r.out_of_range, r.problem) == (1, 1, "vertex is not finite")
    with pytest.raises(Exception, match="m: vertex is not finite"):
        raster.required(check).collect()


def test_a_failed_write_keeps_the_table(spark, tmp_path):
    run = Run(spark, f"file://{tmp_path}/work")
    run.write(spark.range(3).select(F.col("id").alias("uid")), "t")
    broken = run.table("t").select(F.when(F.col("uid") == 1, F.raise_error(F.lit("no"))).otherwise(F.col("uid")).cast("long").alias("uid"))
    with pytest.raises(Exception):
        run.write(broken, "t")
    assert sorted(r.uid for r in run.table("t").collect()) == [0, 1, 2]
    run.write(run.table("t").filter("uid > 0"), "t")
    assert sorted(r.uid for r in run.table("t").collect()) == [1, 2]


WORKER = """
import json, os, sys
sys.path.insert(0, {repo!r})
stage = sys.argv[1]
from pyspark.sql import functions as F
from lamina.run import Refused, Run, main
from lamina.session import build_session
run = Run(build_session("local[1]", "worker"), os.environ["LAMINA_WORK"], {{"recipe": json.loads({recipe!r})}})
k = run.keys().select("uid", F.col("generation_key").alias("content_key"))
if stage == "generate":
    run.write(run.table("valid").select("img", "y", "x", *[(F.col("x") * 3 + F.col("y") * c + 60).alias(n) for n, c in (("r", 1), ("g", 2), ("b", 3))]), "pixels")
run.log(k, stage, "complete", "w" + os.environ["LAMINA_WORKER"])
"""


def test_texture_command(spark, tmp_path, capsys):
    """The whole loop by the command line; workers stand in for the models. A stage without one refuses by name."""
    (tmp_path / "m.obj").write_text(OBJ)
    recipe = {"texture_resolution": 16}
    (tmp_path / "worker.py").write_text(WORKER.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), recipe=json.dumps(recipe)))
    bare = {"work": f"file://{tmp_path}/none", "recipe": recipe}
    (tmp_path / "bare.json").write_text(json.dumps(bare))
    assert main(["texture", "--config", f"{tmp_path}/bare.json", "--mesh", f"{tmp_path}/m.obj"], spark) == 1
    assert "no worker for caption" in capsys.readouterr().err
    command = {s: [sys.executable, f"{tmp_path}/worker.py", s] for s in ("caption", "reference", "generate")}
    (tmp_path / "run.json").write_text(json.dumps({"work": f"file://{tmp_path}/work", "recipe": recipe, "workers": command}))
    (tmp_path / "limits.json").write_text('{"g8_missing_is_failure": false}')
    out = f"{tmp_path}/out"
    # no renderer and no sheet: the framing gate has nothing to go by
    assert main(["texture", "--config", f"{tmp_path}/run.json", "--mesh", f"{tmp_path}/m.obj", "--out", out, "--thresholds", f"{tmp_path}/limits.json"], spark) == 2
    assert '"verdict": "FAIL:G4_FRAME"' in capsys.readouterr().out
    assert arrays.image_pixels(spark.read.format("image").load(out).withColumn("img", F.lit(0))).count() == 256
    # with a renderer's numbers the same run passes
    run = Run(spark, f"file://{tmp_path}/work", {"recipe": recipe})
    uid = run.population().first().uid
    run.write(spark.createDataFrame([(uid, {"g4_iou_min": 0.99, "g5_valid_views": 4.0}, "")], "uid string, measures map<string,double>, note string"), "render")
    run.measure(view_res=16)
    assert main(["gate", "--work", run.work, "--thresholds", f"{tmp_path}/limits.json"], spark) == 0
    assert json.loads(capsys.readouterr().out)["gates"]["by_verdict"] == {"PASS": 1}
    assert main(["gate", "--work", f"file://{tmp_path}/none2"], spark) == 1
    assert "no measurements" in capsys.readouterr().err


def test_commands(spark, tmp_path, capsys):
    work = f"file://{tmp_path}/work"
    (tmp_path / "p.json").write_text(json.dumps(["a" * 32, "b" * 32]))
    assert main(["select", "--work", work, "--population", f"{tmp_path}/p.json"], spark) == 0
    assert main(["caption", "--work", work], spark) == 1 and "no caption shards" in capsys.readouterr().err
    (tmp_path / "work" / "shards").mkdir()
    (tmp_path / "work" / "shards" / "captions_w0.jsonl").write_text("\n".join(json.dumps({"uid": c * 32, "caption": t}) for c, t in (("a", "One."), ("a", "Two."), ("b", ""))))
    assert main(["caption", "--work", work], spark) == 0
    assert json.loads(capsys.readouterr().out)["with_caption"] == 1
    assert main(["generate", "--work", work], spark) == 1 and "workers.generate" in capsys.readouterr().err
    assert main(["assetize", "--work", work], spark) == 1
    assert main(["status"], spark) == 1 and "no work folder" in capsys.readouterr().err


def test_gltf_transforms_sparse_and_normalised():
    pos, tri, uv = np.array([[0, 0, 0], [1, 0, 0], [0, 1, 0]], float), np.array([[0, 1, 2]]), np.array([[0, 0.25], [1, 0.25], [0, 0.75]])
    half = float(np.sqrt(0.5))
    turned = meshes.glb_bytes(pos, tri, uv, {"translation": [1, 2, 3], "rotation": [0, 0, half, half], "scale": [2, 2, 2]})
    (p, t, u), = meshes.glb_primitives(turned)
    assert np.allclose(p, [[1, 2, 3], [1, 4, 3], [-1, 2, 3]]) and np.allclose(u, uv) and t.tolist() == [[0, 1, 2]]
    (p, t, _), = meshes.glb_primitives(meshes.glb_bytes(pos, tri, uv, {"scale": [-1, 1, 1]}))
    assert t.tolist() == [[0, 2, 1]] and p[1].tolist() == [-1, 0, 0]
    body = np.array([[0, 255], [128, 0], [0, 0]], "<u1").tobytes() + b"\0\0" + np.array([2], "<u2").tobytes() + b"\0\0" + np.array([[9, 9, 9]], "<f4").tobytes()
    doc = {
        "buffers": [{"uri": "data:application/octet-stream;base64," + base64.b64encode(body).decode()}],
        "bufferViews": [{"buffer": 0, "byteOffset": 0, "byteLength": 6}, {"buffer": 0, "byteOffset": 8, "byteLength": 2}, {"buffer": 0, "byteOffset": 12, "byteLength": 12}],
        "accessors": [
            {"componentType": 5126, "type": "VEC3", "count": 3, "sparse": {"count": 1, "indices": {"bufferView": 1, "componentType": 5123}, "values": {"bufferView": 2}}},
            {"bufferView": 0, "componentType": 5121, "normalized": True, "type": "VEC2", "count": 3},
        ],
        "meshes": [{"primitives": [{"attributes": {"POSITION": 0, "TEXCOORD_0": 1}}]}],
    }
    (p, t, u), = meshes.glb_primitives(json.dumps(doc).encode())
    assert p.tolist() == [[0, 0, 0], [0, 0, 0], [9, 9, 9]] and np.allclose(u, [[0, 1], [128 / 255, 0], [0, 0]])
    for bad in (doc | {"buffers": [{"uri": "other.bin"}]}, doc | {"nodes": [{"children": [0]}], "scenes": [{"nodes": [0]}]}):
        with pytest.raises(ValueError):
            meshes.glb_primitives(json.dumps(bad).encode())


def test_records(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"uids": ["a", "b"]}))
    (tmp_path / "captions_w0.jsonl").write_text('{"uid": "a", "caption": "x"}\n\nbroken\n')
    assert [r.uid for r in records.read_population(spark, f"{tmp_path}/p.json").collect()] == ["a", "b"]
    assert sorted((r.uid or "-", r.shard) for r in records.read_captions(spark, f"{tmp_path}/captions_w0.jsonl").collect()) == [("-", "captions_w0.jsonl"), ("a", "captions_w0.jsonl")]
    (tmp_path / "t.json").write_text('{"g8_min_psnr": 9.0}')
    assert records.load_thresholds(f"{tmp_path}/t.json").g8_min_psnr == 9.0
    with pytest.raises(FileNotFoundError):
        records.load_thresholds(f"{tmp_path}/none.json")
