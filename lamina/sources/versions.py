"""Tables that appear whole: data in folders of their own, published by manifests that can be written only once."""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lamina.session import hadoop_path

#: Stores without a rename that fails on an existing file; a conditional put takes its place.
OBJECT_STORES = ("s3a", "s3", "gs")


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file whole, unless there is one already: of two writers one gets True.

    A shared folder: a hard link, which fails on an existing name. Object stores: a conditional put. Others
    (HDFS): a rename, which does not replace a file.
    """
    fs, p = hadoop_path(spark, path)
    fs.mkdirs(p.getParent())
    scheme = p.toUri().getScheme() or fs.getScheme()
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    if scheme == "file":
        local, tmp = p.toUri().getPath(), hadoop_path(spark, beside)[1].toUri().getPath()
        with open(tmp, "w") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(tmp, local)
            return True
        except FileExistsError:
            return False
        except OSError:  # a mount without hard links: created only if absent
            try:
                with open(local, "x") as f:
                    f.write(text)
                return True
            except FileExistsError:
                return False
        finally:
            os.unlink(tmp)
    if scheme in OBJECT_STORES:
        try:
            out = fs.createFile(p).overwrite(False).opt("fs.option.create.conditional.overwrite", "true").build()
            out.write(bytearray(text.encode()))
            out.close()
            return True
        except Exception:
            if fs.exists(p):
                return False
            raise
    tmp = hadoop_path(spark, beside)[1]
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.exists(p) and fs.rename(tmp, p):
        return True
    fs.delete(tmp, False)
    return False


def small_text(spark: SparkSession, path: str) -> str:
    fs, p = hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


@dataclass
class Versions:
    """Published versions of one table in a folder. A version is there wholly or not at all, and never replaced."""

    spark: SparkSession
    path: str

    def published(self) -> dict[int, dict]:
        """Manifest of each version, in order."""
        return {v: self._manifest(v) for v in self._numbers()}

    def latest(self) -> tuple[int, dict] | None:
        """Number and manifest of the last version; only that manifest is read."""
        found = self._numbers()
        return (found[-1], self._manifest(found[-1])) if found else None

    def _numbers(self) -> list[int]:
        fs, p = hadoop_path(self.spark, f"{self.path}/manifests")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[2:-5]) for n in names if n.startswith("v=") and n.endswith(".json"))

    def _manifest(self, version: int) -> dict:
        return json.loads(small_text(self.spark, f"{self.path}/manifests/v={version}.json"))

    def replace(self, rows: DataFrame) -> None:
        """The table as a whole; the version before it stays for its readers, older ones go."""
        name = self.write(rows)
        while True:
            last = self.latest()
            n = last[0] + 1 if last else 1
            if put_if_absent(self.spark, f"{self.path}/manifests/v={n}.json", json.dumps({"data": name})):
                break
        if n > 2:
            self.drop(self._manifest(n - 2)["data"])

    def append(self, rows: DataFrame) -> None:
        """More rows, all or none; writers that append at once do not lose each other's."""
        name = self.write(rows)
        while True:
            last = self._numbers()
            if put_if_absent(self.spark, f"{self.path}/manifests/v={last[-1] + 1 if last else 1}.json", json.dumps({"data": name})):
                return

    def write(self, rows: DataFrame) -> str:
        """The rows in a data folder nobody reads yet; its name."""
        name = f"data-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}")
        return name

    def publish(self, version: int, name: str, **more) -> bool:
        """Makes a data folder a version; where another writer was first, its folder is deleted."""
        if put_if_absent(self.spark, f"{self.path}/manifests/v={version}.json", json.dumps({"data": name, **more})):
            return True
        self.drop(name)
        return False

    def drop(self, name: str) -> None:
        fs, p = hadoop_path(self.spark, f"{self.path}/{name}")
        fs.delete(p, True)

    def read(self, manifests: list[dict], schema: StructType | str) -> DataFrame:
        at = [f"{self.path}/{m['data']}" for m in manifests]
        return self.spark.read.schema(schema).parquet(*at) if at else self.spark.createDataFrame([], schema)
