"""Properties of layouts, views and images on small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from grids import encode_grid
from lamina.operators import image as im
from lamina.operators import pixelmeasures as pm
from lamina.operators import raster as ras
from lamina.operators import view as vw
from lamina.sources import arrays, meshes

QUAD = [(0.1, 0.1), (0.9, 0.1), (0.9, 0.9), (0.1, 0.9)]


def layout(spark, pts, faces):
    v = spark.createDataFrame([("m", i, *map(float, p)) for i, p in enumerate(pts)], "uid string, tid long, u double, v double")
    f = spark.createDataFrame([("m", i, *t) for i, t in enumerate(faces)], "uid string, fid long, ta long, tb long, tc long")
    return v, f


@pytest.mark.parametrize("res,covered", [(16, 144), (17, 169), (64, 2704)])
def test_quad_is_covered_once(spark, res, covered):
    m = ras.address_map(*layout(spark, QUAD, [(0, 1, 2), (0, 2, 3)]), res)
    r = m.agg(F.count("*").alias("n"), F.max("coverage").alias("c"), F.max(F.abs(F.col("b0") + F.col("b1") + F.col("b2") - 1)).alias("e")).first()
    assert (r.n, r.c) == (covered, 1) and r.e < 1e-12


def test_overlap_flip_and_zero_area(spark):
    nested = [(0.1, 0.1), (0.9, 0.1), (0.1, 0.9), (0.2, 0.2), (0.5, 0.2), (0.2, 0.5), (0.7, 0.7)]
    s = ras.stats(*layout(spark, nested, [(0, 1, 2), (3, 5, 4), (6, 6, 6)]), 32).first()
    assert (s.num_faces, s.num_zero_area, s.num_flipped) == (3, 1, 1) and s.overlap_px > 0 and s.valid_px == s.covered_px - s.overlap_px


def test_winding_does_not_move_weights(spark):
    a = ras.address_map(*layout(spark, QUAD, [(0, 1, 2)]), 16).orderBy("y", "x").collect()
    b = ras.address_map(*layout(spark, QUAD, [(0, 2, 1)]), 16).orderBy("y", "x").collect()
    assert all(abs(p.b0 - q.b0) + abs(p.b1 - q.b2) + abs(p.b2 - q.b1) < 1e-12 for p, q in zip(a, b))


def test_empty_layout(spark):
    assert ras.address_map(*layout(spark, QUAD, []), 16).count() == 0


def grid(spark, mask, img=0):
    return spark.createDataFrame([(img, y, x, bool(mask[y, x])) for y in range(mask.shape[0]) for x in range(mask.shape[1])], "img long, y int, x int, valid boolean")


def test_nearest_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    mask = rng.random((24, 20)) < 0.04
    ys, xs = np.nonzero(mask)
    want = {}
    for y in range(24):
        for x in range(20):
            if not mask[y, x]:
                want[y, x] = min(((y - a) ** 2 + (x - b) ** 2, a, b) for a, b in zip(ys.tolist(), xs.tolist()))
    g = grid(spark, mask)
    assert {(r.y, r.x): (r.d2, r.ny, r.nx) for r in im.nearest_valid(g).collect()} == want
    assert {(r.y, r.x): (r.d2, r.ny, r.nx) for r in im.nearest_within(g, 4).collect()} == {k: v for k, v in want.items() if v[0] <= 16}


def test_no_valid_texel_turns_black(spark):
    px = encode_grid(spark, 0, np.full((5, 5, 3), 9, np.uint8))
    assert im.dilate_full(px, grid(spark, np.zeros((5, 5), bool))).agg(F.max("r")).first()[0] == 0


def test_resize_keeps_a_flat_image(spark):
    px = encode_grid(spark, 0, np.full((20, 33, 3), 77, np.uint8))
    r = im.resized(px, 16).agg(F.count("*"), F.min("g"), F.max("g")).first()
    assert tuple(r) == (256, 77, 77)


def test_delivered_ring_is_consistent(spark):
    rng = np.random.default_rng(0)
    px = encode_grid(spark, 0, rng.integers(100, 250, (40, 40, 3)).astype(np.uint8))
    mask = np.zeros((40, 40), bool)
    mask[12:26, 10:30] = True
    g = grid(spark, mask)
    out = im.delivered(px, g, 20)
    r = im.ring_consistency(out, im.mask_resized(g, 20, im.sizes(px))).first()
    assert (r.ring_difference, r.far_background) == (0.0, 0.0) and r.ring_texels > 0


def test_blobs_by_both_ways(spark):
    rng = np.random.default_rng(4)
    dark = rng.random((30, 30)) < 0.55
    px = encode_grid(spark, 0, np.where(dark[..., None], 0, 200).repeat(3, 2).astype(np.uint8))
    r = pm.dark_blobs(px, grid(spark, np.ones((30, 30), bool))).first()
    ys, xs = np.nonzero(dark)
    lab = pm.label(ys, xs)
    left, sizes = set(zip(ys.tolist(), xs.tolist())), []
    while left:
        todo, n = [left.pop()], 0
        while todo:
            y, x = todo.pop()
            n += 1
            near = {(y, x + 1), (y, x - 1), (y + 1, x), (y - 1, x)} & left
            left -= near
            todo += near
        sizes.append(n)
    assert (r.blobs, r.largest, r.dark) == (len(sizes), max(sizes), sum(sizes)) == (len(set(lab.tolist())), np.bincount(np.unique(lab, return_inverse=True)[1]).max(), dark.sum())


def test_cameras_agree_with_the_rig():
    for az, row in ((0.0, 0), (90.0, 1)):
        r, u, b, p = vw.camera(az, 0.0)
        assert np.allclose([*r, *u, *b, *p], vw.box_cameras()[row][1:])


def test_depth_test_keeps_the_nearer_face(spark):
    v = spark.createDataFrame([("m", i, *p) for i, p in enumerate([(-0.5, -0.5, 0.0), (0.5, -0.5, 0.0), (0.0, 0.5, 0.0), (-0.5, -0.5, 0.4), (0.5, -0.5, 0.4), (0.0, 0.5, 0.4)])], "uid string, vid long, x double, y double, z double")
    f = spark.createDataFrame([("m", 0, 0, 1, 2), ("m", 1, 3, 5, 4)], "uid string, fid long, a long, b long, c long")
    front = vw.camera_table(spark, vw.box_cameras()[:1])
    assert {r.fid for r in vw.fragments(v, f, front, 32).collect()} == {1}


OBJ = "# c\nv 0 0 0\nv 1 0 0\nv 1 1 0\nv 0 1 0\nvt 0 0\nvt 1 0\nvt 1 1\nvt 0\n\tv 9 9 9\nf 1/1 2/2 3/3 4/4\nf -4/-4 -3/-3 -2/-2\nf 1 2\n"


def test_obj_scan(spark):
    files = spark.createDataFrame([("a", OBJ), ("b", OBJ.replace("f -4/-4 -3/-3 -2/-2", "f 1//1 2//1 3//1")), ("e", "")], "uid string, content string")
    v, t, f = meshes.obj_scan(files)
    assert v.filter("uid = 'a'").count() == 4
    assert [tuple(r) for r in f.filter("uid = 'a'").orderBy("fid").collect()] == [("a", 0, 0, 1, 2, 0, 1, 2), ("a", 1, 0, 2, 3, 0, 2, 3), ("a", 2, 0, 1, 2, 0, 1, 2)]
    assert f.filter("uid = 'b' and ta is not null").count() == 0 and f.filter("uid = 'b'").count() == 3
    assert {r.tid: r.v for r in t.filter("uid = 'a'").collect()}[3] == 1.0


def test_binary_formats_round_trip():
    pos, tri, uv = np.random.default_rng(0).random((4, 3)).astype(np.float32), np.array([[0, 1, 2], [0, 2, 3]]), np.array(QUAD, np.float32)
    (p, t, u), = meshes.glb_primitives(meshes.glb_bytes(pos, tri, uv))
    assert np.array_equal(p, pos) and np.array_equal(t, tri) and np.array_equal(u, uv)
    assert meshes.has_texcoord(meshes.glb_bytes(pos, tri, uv)) and not meshes.has_texcoord(meshes.glb_bytes(pos, tri, None))
    w = np.moveaxis(np.random.default_rng(1).random((5, 6, 3)), -1, 0).astype(np.float16)
    assert np.array_equal(arrays.tensors(arrays.tensor_bytes({"w": w}))["w"], w)


def test_broken_glb_is_a_row(spark):
    df = spark.createDataFrame([("x", bytearray(b"no"))], "uid string, content binary")
    assert [r.part for r in meshes.glb_scan(df).collect()] == ["error"]
