"""Binary sources and sinks: safetensors and PNG, parsed and written in Arrow batches."""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.session import settled

#: Number types of the safetensors format.
_TYPES = {"F64": "<f8", "F32": "<f4", "F16": "<f2", "I64": "<i8", "I32": "<i4", "I16": "<i2", "I8": "<i1", "U8": "<u1", "BOOL": "<u1"}


def tensors(data: bytes) -> dict[str, np.ndarray]:
    """Arrays of a safetensors file by name."""
    n = struct.unpack_from("<Q", data)[0]
    head = json.loads(data[8 : 8 + n])
    body = memoryview(data)[8 + n :]
    return {k: np.frombuffer(body[t["data_offsets"][0] : t["data_offsets"][1]], _TYPES[t["dtype"]]).reshape(t["shape"]) for k, t in head.items() if k != "__metadata__"}


def tensor_bytes(arrays: dict[str, np.ndarray]) -> bytes:
    """A safetensors file; arrays are laid out in C order, whatever their strides."""
    names = {np.dtype(v): k for k, v in _TYPES.items() if k != "BOOL"}
    head, parts, at = {}, [], 0
    for k, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        head[k] = {"dtype": names[a.dtype], "shape": list(a.shape), "data_offsets": [at, at + len(raw)]}
        parts.append(raw)
        at += len(raw)
    doc = json.dumps(head).encode()
    doc += b" " * (-len(doc) % 8)
    return struct.pack("<Q", len(doc)) + doc + b"".join(parts)


def family_scan(files: DataFrame, families: tuple[str, ...] = ("xatlas", "smart_uv", "partial"), stride: int = 4) -> DataFrame:
    """(uid, family, y, x, face_id, b0, b1, b2): every stride-th texel of each family in safetensors files (uid, content).

    Face ids of any integer type and weights as [3, H, W] or [H, W, 3] are read; files with fewer than two families give nothing.
    """

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for uid, data in zip(b.column("uid"), b.column("content").to_pylist()):
                t = tensors(data)
                have = [f for f in families if f"{f}_face_id" in t and f"{f}_barycentric" in t]
                if len(have) < 2:
                    continue
                for f in have:
                    face, w = t[f"{f}_face_id"].astype(np.int64), t[f"{f}_barycentric"].astype(np.float64)
                    w = np.moveaxis(w, 0, -1) if w.shape[0] == 3 and w.ndim == 3 and w.shape[:2] != face.shape else w
                    ys, xs = np.meshgrid(np.arange(0, face.shape[0], stride), np.arange(0, face.shape[1], stride), indexing="ij")
                    ys, xs = ys.ravel(), xs.ravel()
                    yield pa.RecordBatch.from_arrays([pa.repeat(uid, len(ys)), pa.repeat(f, len(ys)), pa.array(ys.astype(np.int32)), pa.array(xs.astype(np.int32)), pa.array(face[ys, xs]), *[pa.array(w[ys, xs, k]) for k in range(3)]], ["uid", "family", "y", "x", "face_id", "b0", "b1", "b2"])

    kind = files.schema["uid"].dataType.simpleString()
    return files.select("uid", "content").mapInArrow(rows, f"uid {kind}, family string, y int, x int, face_id long, b0 double, b1 double, b2 double")


def png_bytes(a: np.ndarray) -> bytes:
    """A PNG file of 8-bit numbers: [h, w] grey, [h, w, 3] colour, [h, w, 4] colour with alpha."""
    h, w = a.shape[:2]
    kind = {1: 0, 3: 2, 4: 6}[1 if a.ndim == 2 else a.shape[2]]
    raw = np.concatenate([np.zeros((h, 1), np.uint8), a.reshape(h, -1)], axis=1).tobytes()
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def _plain_kind(df: DataFrame) -> str:
    return "string" if df.schema["img"].dataType.simpleString() == "string" else "long"


def png_encode(pixels: DataFrame) -> DataFrame:
    """(img, content): a PNG per image of (img, y, x) and r, g, b, or r, g, b, a, or v (grey; true and false are 255 and 0).

    Every pixel must be there. One image is one task's row.
    """
    bands = ["v"] if "v" in pixels.columns else ["r", "g", "b", *(["a"] if "a" in pixels.columns else [])]
    level = lambda c: (F.col(c).cast("int") * 255 if pixels.schema[c].dataType.simpleString() == "boolean" else F.col(c).cast("int")).alias(c)

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for img, h, w, v in zip(b.column("img"), b.column("h").to_pylist(), b.column("w").to_pylist(), b.column("v").to_pylist()):
                a = np.array(v, np.uint8).reshape((h, w) if len(bands) == 1 else (h, w, len(bands)))
                yield pa.RecordBatch.from_arrays([pa.array([img.as_py()], img.type), pa.array([png_bytes(a)], pa.binary())], ["img", "content"])

    kind = _plain_kind(pixels)
    g = pixels.select(F.col("img").cast(kind).alias("img"), "y", "x", *map(level, bands)).groupBy("img").agg(F.array_sort(F.collect_list(F.struct("y", "x", *bands))).alias("p"), (F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    flat = F.flatten(F.transform("p", lambda s: F.array(*[s[c] for c in bands])))
    return g.select("img", "h", "w", flat.alias("v")).mapInArrow(rows, f"img {kind}, content binary")


def binary_files(files: DataFrame, folder: str, ending: str) -> DataFrame:
    """(path, size): each row of (img, content) written to folder/img + ending, from the tasks, by the file system the folder names.

    A file appears whole under its name, and a repeated task writes the same file again. Runs at once.
    """
    at = folder if "://" in folder or folder.startswith("file:") else "file://" + os.path.abspath(folder)
    at = "s3://" + at[6:] if at.startswith("s3a://") else at

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(at)
        store.create_dir(base, recursive=True)
        for b in it:
            paths = [f"{base}/{i}{ending}" for i in b.column("img").to_pylist()]
            for path, data in zip(paths, b.column("content").to_pylist()):
                part = f"{base}/_{uuid.uuid4().hex}.part"
                with store.open_output_stream(part) as out:
                    out.write(data)
                store.move(part, path)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([len(x) for x in b.column("content").to_pylist()], pa.int64())], ["path", "size"])

    return settled(files.select("img", "content").mapInArrow(rows, "path string, size long"), "files")


def png_files(pixels: DataFrame, folder: str) -> DataFrame:
    """(path, size) of the PNG files written for the images."""
    return binary_files(png_encode(pixels), folder, ".png")


def image_pixels(images: DataFrame) -> DataFrame:
    """(img, y, x, r, g, b) of rows of Spark's image source, as colours: grey is repeated, alpha is dropped. One image is one task's row."""
    kind = _plain_kind(images)

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for img, h, w, n, data in zip(b.column("img"), *(b.column(c).to_pylist() for c in ("h", "w", "n", "data"))):
                a = np.frombuffer(data, np.uint8).reshape(h, w, n)
                a = np.repeat(a, 3, axis=2) if n == 1 else a[:, :, 2::-1]  # the source's bytes are blue first
                y, x = np.divmod(np.arange(h * w, dtype=np.int32), np.int32(w))
                flat = a.reshape(-1, 3).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.repeat(img, h * w), pa.array(y), pa.array(x), *[pa.array(flat[:, k]) for k in range(3)]], ["img", "y", "x", "r", "g", "b"])

    i = images.select(F.col("img").cast(kind).alias("img"), F.col("image.height").alias("h"), F.col("image.width").alias("w"), F.col("image.nChannels").alias("n"), F.col("image.data").alias("data"))
    return i.mapInArrow(rows, f"img {kind}, y int, x int, r int, g int, b int")


#: Fixed value: luminance above which a mask counts a pixel.
MASK_ABOVE = 127


def mask_pixels(images: DataFrame) -> DataFrame:
    """(img, y, x, valid) of masks of any colour mode: luminance (16-bit weights of red, green, blue) above MASK_ABOVE."""
    luma = F.shiftright(F.col("r") * 19595 + F.col("g") * 38470 + F.col("b") * 7471 + 32768, 16)
    return image_pixels(images).select("img", "y", "x", (luma > MASK_ABOVE).alias("valid"))
