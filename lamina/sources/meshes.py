"""Mesh sources and sinks: OBJ text as relations, GLB bytes through Arrow."""

from __future__ import annotations

import base64
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def format_of(path: Column) -> Column:
    """obj, gltf or unsupported, by the ending of the path."""
    s = F.lower(F.regexp_extract(path, r"(\.[A-Za-z0-9]+)\z", 1))
    return F.when(s == ".obj", "obj").when(s.isin(".glb", ".gltf"), "gltf").otherwise("unsupported")


def supported(path: Column) -> Column:
    """The format of the path, or an error that names the path."""
    f = format_of(path)
    return F.when(f != "unsupported", f).otherwise(F.raise_error(F.concat(F.lit("unsupported mesh format: "), F.coalesce(path, F.lit("null"))))).cast("string")


def polygon_fan(polygons: DataFrame, keys: list[str], corners: str) -> DataFrame:
    """Triangles (0, k, k + 1) of each list of corners; lists of fewer than three have none."""
    p = polygons.filter(F.size(corners) >= 3).withColumn("k", F.explode(F.sequence(F.lit(1), F.size(corners) - 2)))
    at = lambda i: F.element_at(corners, i + 1)
    return p.select(*keys, "k", at(F.lit(0)).alias("a"), at(F.col("k")).alias("b"), at(F.col("k") + 1).alias("c"))


def _obj_lines(files: DataFrame) -> DataFrame:
    """(uid, pos, tag, fields, nv, nt): lines of OBJ texts with the vertices and texture vertices up to each.

    The tag ends at the first blank; indented and tabbed lines are no tags. Files are numbered by line, so a window
    over one file counts what came before.
    """
    lines = files.select("uid", F.posexplode(F.split("content", "\r?\n")).alias("pos", "line")).filter("line <> '' and not startswith(line, '#')")
    tag = F.substring_index("line", " ", 1)
    rest = F.trim(F.regexp_replace(F.substring(F.col("line"), F.length(tag) + 2, F.length("line")), r"\s+", " "))
    rows = lines.select("uid", "pos", tag.alias("tag"), F.split(rest, " ").alias("fields")).filter(F.col("tag").isin("v", "vt", "f"))
    w = Window.partitionBy("uid").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({"nv": F.count_if(F.col("tag") == "v").over(w), "nt": F.count_if(F.col("tag") == "vt").over(w)})


def obj_scan(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vertices, uv_vertices, faces) of OBJ texts (uid, content).

    Polygons are fanned; indices below zero count back from the last vertex so far; v, v/vt, v//vn and v/vt/vn are
    read; a texture vertex with one number has 0 as its second; the second runs down in the result. Texture
    indices are null for a file unless every triangle has them.
    """
    rows = _obj_lines(files)
    num = lambda i: F.element_at("fields", i).cast("double")
    v = rows.filter("tag = 'v'").select("uid", (F.col("nv") - 1).alias("vid"), num(1).alias("x"), num(2).alias("y"), num(3).alias("z"))
    second = F.when(F.size("fields") > 1, F.try_element_at("fields", F.lit(2)).cast("double")).otherwise(0.0)
    t = rows.filter("tag = 'vt'").select("uid", (F.col("nt") - 1).alias("tid"), num(1).alias("u"), (F.lit(1.0) - second).alias("v"))

    def index(part: int, seen: str):
        def one(ref: Column) -> Column:
            i = F.get(F.split(ref, "/"), F.lit(part))
            n = F.when(i != "", i.cast("long"))
            return F.when(n > 0, n - 1).otherwise(F.col(seen) + n)

        return one

    poly = rows.filter("tag = 'f' and size(fields) >= 3").select("uid", "pos", F.transform("fields", index(0, "nv")).alias("vi"), F.transform("fields", index(1, "nt")).alias("ti"))
    fan = poly.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("vi") - 2)))
    at = lambda c, i: F.element_at(c, i + 1)
    order = Window.partitionBy("uid").orderBy("pos", "k")
    tri = fan.select(
        "uid",
        (F.row_number().over(order) - 1).cast("long").alias("fid"),
        *[at("vi", i).alias(c) for c, i in (("a", F.lit(0)), ("b", F.col("k")), ("c", F.col("k") + 1))],
        *[at("ti", i).alias(c) for c, i in (("ta", F.lit(0)), ("tb", F.col("k")), ("tc", F.col("k") + 1))],
    )
    whole = F.bool_and(F.col("ta").isNotNull() & F.col("tb").isNotNull() & F.col("tc").isNotNull()).over(Window.partitionBy("uid"))
    f = tri.withColumn("_w", whole).select("uid", "fid", "a", "b", "c", *[F.when(F.col("_w"), F.col(c)).alias(c) for c in ("ta", "tb", "tc")])
    return v, t, f


def obj_lines(vertices: DataFrame, uv_vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """(uid, part, n, line): the lines of an OBJ file in order: vertices, texture vertices turned back up, faces from 1."""
    six = lambda c: F.format_string("%.6f", F.bround(c, 6))  # noqa: E731  (halves to even, as C does)
    v = vertices.select("uid", F.lit(0).alias("part"), F.col("vid").alias("n"), F.concat_ws(" ", F.lit("v"), six(F.col("x")), six(F.col("y")), six(F.col("z"))).alias("line"))
    t = uv_vertices.select("uid", F.lit(1).alias("part"), F.col("tid").alias("n"), F.concat_ws(" ", F.lit("vt"), six(F.col("u")), six(F.lit(1.0) - F.col("v"))).alias("line"))
    ref = lambda a, b: F.concat((F.col(a) + 1).cast("string"), F.lit("/"), (F.col(b) + 1).cast("string"))
    f = faces.select("uid", F.lit(2).alias("part"), F.col("fid").alias("n"), F.concat_ws(" ", F.lit("f"), ref("a", "ta"), ref("b", "tb"), ref("c", "tc")).alias("line"))
    return v.unionByName(t).unionByName(f)


def obj_text(lines: DataFrame) -> DataFrame:
    """(uid, content): one text per mesh."""
    g = lines.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("part", "n", "line"))).alias("l"))
    return g.select("uid", F.concat(F.array_join(F.transform("l", lambda s: s["line"]), "\n"), F.lit("\n")).alias("content"))


def obj_files(texts: DataFrame, folder: str) -> DataFrame:
    """(path, size) of the OBJ files written for the texts (uid, content), from the tasks."""
    from lamina.sources.arrays import binary_files

    return binary_files(texts.select(F.col("uid").alias("img"), F.encode("content", "UTF-8").alias("content")), folder, ".obj")


#: Component types of binary glTF accessors, and components of their shapes.
_KIND = {5120: "<i1", 5121: "<u1", 5122: "<i2", 5123: "<u2", 5125: "<u4", 5126: "<f4"}
_WIDTH = {"SCALAR": 1, "VEC2": 2, "VEC3": 3, "VEC4": 4}


def glb_chunks(data: bytes) -> tuple[dict, bytes]:
    """JSON and binary chunk of a GLB file; anything else raises ValueError."""
    if len(data) < 20 or data[:4] != b"glTF":
        raise ValueError("no GLB file")
    at, doc, body = 12, None, b""
    while at + 8 <= len(data):
        size, kind = struct.unpack_from("<II", data, at)
        part = data[at + 8 : at + 8 + size]
        if kind == 0x4E4F534A:
            doc = json.loads(part)
        elif kind == 0x004E4942 and not body:
            body = part
        at += 8 + size
    if doc is None:
        raise ValueError("GLB without JSON")
    return doc, body


def _stored(doc: dict, body: bytes, ref: dict, kind: np.dtype, width: int, count: int) -> np.ndarray:
    """Elements of a buffer view; strided views are honoured. Buffers are the binary chunk or data written into the JSON."""
    view = doc["bufferViews"][ref["bufferView"]]
    uri = doc.get("buffers", [{}])[view.get("buffer", 0)].get("uri")
    if uri is not None:
        if not uri.startswith("data:"):
            raise ValueError("buffer in another file")
        body = base64.b64decode(uri.partition(",")[2])
    start, size = view.get("byteOffset", 0) + ref.get("byteOffset", 0), kind.itemsize * width
    step = view.get("byteStride") or size
    raw = np.frombuffer(body, np.uint8)[start:]
    if count and len(raw) < (count - 1) * step + size:
        raise ValueError("accessor beyond its buffer")
    return np.lib.stride_tricks.as_strided(raw, (count, size), (step, 1)).copy().view(kind).reshape(count, width)


def glb_accessor(doc: dict, body: bytes, i: int) -> np.ndarray:
    """The numbers of an accessor, one row an element: sparse ones filled in, normalised integers as fractions."""
    a = doc["accessors"][i]
    kind, width, n = np.dtype(_KIND[a["componentType"]]), _WIDTH[a["type"]], a["count"]
    out = _stored(doc, body, a, kind, width, n) if "bufferView" in a else np.zeros((n, width), kind)
    if "sparse" in a:
        s = a["sparse"]
        at = _stored(doc, body, s["indices"], np.dtype(_KIND[s["indices"]["componentType"]]), 1, s["count"])[:, 0]
        out[at] = _stored(doc, body, s["values"], kind, width, s["count"])
    if a.get("normalized") and kind.kind in "iu":
        return np.maximum(out / float(np.iinfo(kind).max), -1.0)
    return out


def _placed(doc: dict) -> list[tuple[dict, np.ndarray]]:
    """Every mesh the scene shows with its 4 x 4 transform, in the order of the nodes; a file without scenes shows its meshes as they are."""
    nodes = doc.get("nodes", [])
    if not nodes or "scenes" not in doc:
        return [(m, np.eye(4)) for m in doc.get("meshes", [])]
    out = []

    def walk(i: int, parent: np.ndarray, above: tuple) -> None:
        if i in above:
            raise ValueError("nodes in a circle")
        n = nodes[i]
        here = parent @ _transform(n)
        if "mesh" in n:
            out.append((doc["meshes"][n["mesh"]], here))
        for c in n.get("children", []):
            walk(c, here, (*above, i))

    for i in doc["scenes"][doc.get("scene", 0)].get("nodes", []):
        walk(i, np.eye(4), ())
    return out


def _transform(node: dict) -> np.ndarray:
    """A node's matrix, or its translation, rotation (quaternion x, y, z, w) and scale."""
    if "matrix" in node:
        return np.array(node["matrix"], float).reshape(4, 4).T
    x, y, z, w = node.get("rotation", (0.0, 0.0, 0.0, 1.0))
    turn = np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])
    out = np.eye(4)
    out[:3, :3] = turn * np.array(node.get("scale", (1.0, 1.0, 1.0)), float)
    out[:3, 3] = node.get("translation", (0.0, 0.0, 0.0))
    return out


def glb_primitives(data: bytes) -> list[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """(positions, triangles, texture coordinates or None) of every triangle primitive of the scene, moved to its place.

    glTF's v runs down already. The winding of a mirrored node is turned back.
    """
    doc, body = gltf_parts(data)
    out = []
    for mesh, place in _placed(doc):
        for p in mesh.get("primitives", []):
            if p.get("mode", 4) != 4:
                continue
            pos = glb_accessor(doc, body, p["attributes"]["POSITION"]).astype(np.float64)
            if not np.array_equal(place, np.eye(4)):
                pos = pos @ place[:3, :3].T + place[:3, 3]
            idx = glb_accessor(doc, body, p["indices"]).reshape(-1) if "indices" in p else np.arange(len(pos))
            tri = idx.astype(np.int64).reshape(-1, 3)
            if np.linalg.det(place[:3, :3]) < 0:
                tri = tri[:, [0, 2, 1]]
            uv = glb_accessor(doc, body, p["attributes"]["TEXCOORD_0"]).astype(np.float64) if "TEXCOORD_0" in p["attributes"] else None
            out.append((pos, tri, uv))
    return out


def gltf_parts(data: bytes) -> tuple[dict, bytes]:
    """JSON and binary part of a GLB file, or of a .gltf text (whose buffers are in the text)."""
    if data[:4] != b"glTF" and data.lstrip()[:1] == b"{":
        return json.loads(data), b""
    return glb_chunks(data)


def has_texcoord(data: bytes) -> bool:
    doc, _ = gltf_parts(data)
    return any("TEXCOORD_0" in p.get("attributes", {}) for m in doc.get("meshes", []) for p in m.get("primitives", []))


def declares_texcoord(files: DataFrame) -> DataFrame:
    """(uid, has_texcoord) of GLB and .gltf files (uid, content): whether any primitive declares TEXCOORD_0; null for an unreadable file."""

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = []
            for data in b.column("content").to_pylist():
                try:
                    out.append(has_texcoord(data or b""))
                except (ValueError, KeyError, IndexError, TypeError):
                    out.append(None)
            yield pa.RecordBatch.from_arrays([b.column("uid"), pa.array(out, pa.bool_())], ["uid", "has_texcoord"])

    return files.select("uid", "content").mapInArrow(rows, f"uid {files.schema['uid'].dataType.simpleString()}, has_texcoord boolean")


def glb_bytes(pos: np.ndarray, tri: np.ndarray, uv: np.ndarray | None, node: dict | None = None) -> bytes:
    """A GLB file of one primitive, under a node with a transform if one is given."""
    parts = [pos.astype("<f4").tobytes(), tri.astype("<u4").tobytes()] + ([uv.astype("<f4").tobytes()] if uv is not None else [])
    views, at = [], 0
    for p in parts:
        views.append({"buffer": 0, "byteOffset": at, "byteLength": len(p)})
        at += len(p)
    acc = [{"bufferView": 0, "componentType": 5126, "count": len(pos), "type": "VEC3"}, {"bufferView": 1, "componentType": 5125, "count": tri.size, "type": "SCALAR"}]
    attr = {"POSITION": 0}
    if uv is not None:
        acc.append({"bufferView": 2, "componentType": 5126, "count": len(uv), "type": "VEC2"})
        attr["TEXCOORD_0"] = 2
    doc = json.dumps({"asset": {"version": "2.0"}, "buffers": [{"byteLength": at}], "bufferViews": views, "accessors": acc, "meshes": [{"primitives": [{"attributes": attr, "indices": 1}]}], "nodes": [{"mesh": 0} | (node or {})], "scenes": [{"nodes": [0]}], "scene": 0}).encode()
    doc += b" " * (-len(doc) % 4)
    body = b"".join(parts)
    body += b"\0" * (-len(body) % 4)
    return b"glTF" + struct.pack("<II", 2, 12 + 8 + len(doc) + 8 + len(body)) + struct.pack("<II", len(doc), 0x4E4F534A) + doc + struct.pack("<II", len(body), 0x004E4942) + body


def glb_scan(files: DataFrame) -> DataFrame:
    """(uid, primitive, part, n, p, q, r): vertices (part v), texture coordinates (vt) and triangles (f) of GLB files (uid, content); unreadable files give one row of part error."""

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["uid", "primitive", "part", "n", "p", "q", "r"]
        for b in it:
            for uid, data in zip(b.column("uid"), b.column("content").to_pylist()):
                try:
                    prims = glb_primitives(data or b"")
                except (ValueError, KeyError, IndexError, TypeError, RecursionError):
                    yield pa.RecordBatch.from_arrays([pa.array([uid.as_py()], uid.type), pa.array([0], pa.int32()), pa.array(["error"]), pa.array([0], pa.int64()), *[pa.array([None], pa.float64())] * 3], names)
                    continue
                for i, (pos, tri, uv) in enumerate(prims):
                    for part, m in (("v", pos), ("f", tri), ("vt", uv)):
                        if m is None:
                            continue
                        m = np.column_stack([m, np.full((len(m), 3 - m.shape[1]), np.nan)]).astype(np.float64) if m.shape[1] < 3 else m.astype(np.float64)
                        yield pa.RecordBatch.from_arrays([pa.repeat(uid, len(m)), pa.repeat(pa.scalar(i, pa.int32()), len(m)), pa.repeat(part, len(m)), pa.array(np.arange(len(m))), *[pa.array(m[:, k]) for k in range(3)]], names)

    kind = files.schema["uid"].dataType.simpleString()
    return files.select("uid", "content").mapInArrow(rows, f"uid {kind}, primitive int, part string, n long, p double, q double, r double")


def glb_mesh(scan: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vertices, uv_vertices, faces) of glb_scan's rows, as obj_scan gives them; primitives are numbered on.

    Texture indices are null for a file unless every primitive has texture coordinates, which lie one a vertex.
    """
    counts = scan.groupBy("uid", "primitive").agg(*[F.count_if(F.col("part") == p).alias(f"n_{p}") for p in ("v", "f", "vt")])
    before = Window.partitionBy("uid").orderBy("primitive").rowsBetween(Window.unboundedPreceding, -1)
    off = counts.select("uid", "primitive", *[F.coalesce(F.sum(f"n_{p}").over(before), F.lit(0)).alias(f"at_{p}") for p in ("v", "f")], F.bool_and(F.col("n_vt") == F.col("n_v")).over(Window.partitionBy("uid")).alias("laid"))
    j = scan.join(off, ["uid", "primitive"])
    v = j.filter("part = 'v'").select("uid", (F.col("n") + F.col("at_v")).alias("vid"), F.col("p").alias("x"), F.col("q").alias("y"), F.col("r").alias("z"))
    t = j.filter("part = 'vt' and laid").select("uid", (F.col("n") + F.col("at_v")).alias("tid"), F.col("p").alias("u"), F.col("q").alias("v"))
    corner = lambda c: (F.col(c).cast("long") + F.col("at_v"))
    f = j.filter("part = 'f'").select("uid", (F.col("n") + F.col("at_f")).alias("fid"), *[corner(c).alias(n) for c, n in zip("pqr", "abc")], *[F.when(F.col("laid"), corner(c)).alias(n) for c, n in zip("pqr", ("ta", "tb", "tc"))])
    return v, t, f
