"""Committed stages of a run: what an interrupted run has finished is read, not computed again.

A stage is a table, a pooled model or a few settings, written below the run's folder and committed
by renaming one small file into place, which names where the data are. A stage without that file
never happened, whatever it left behind. Stages belong to a fingerprint of input and settings, so a
run on other rows or with other settings starts afresh.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.ml.util import MLReadable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.session import materialize


class Unkept:
    """Stages that live as long as the session: nothing is committed."""

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return materialize(build())

    def pooled(self, name: str, kind: type[MLReadable], build: Callable[[], MLReadable]) -> MLReadable:
        return build()

    def value(self, name: str, build: Callable[[], dict]) -> dict:
        return build()


class Stages(Unkept):
    """Stages below ``folder``; the first commit of a name counts, later ones read it."""

    def __init__(self, spark: SparkSession, folder: str, fingerprint: str):
        self.spark = spark
        self.root = f"{folder}/stages"
        self.home = f"{self.root}/{fingerprint}"

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        def made() -> dict:
            path = self._new_path(name)
            df = build()
            df.write.parquet(path)
            return {"path": path, "schema": df.schema.jsonValue()}

        at = self.value(name, made)
        return self.spark.read.schema(T.StructType.fromJson(at["schema"])).parquet(at["path"])

    def pooled(self, name: str, kind: type[MLReadable], build: Callable[[], MLReadable]) -> MLReadable:
        def made() -> dict:
            path = self._new_path(name)
            build().write().save(path)
            return {"path": path}

        return kind.load(self.value(name, made)["path"])

    def value(self, name: str, build: Callable[[], dict]) -> dict:
        """What was committed under ``name``, or what ``build`` returns, committed now."""
        found = self._committed(name)
        if found is None:
            self._commit(name, build())
            found = self._committed(name)
        return found

    def names(self) -> list[str]:
        """Names of the committed stages."""
        home = self._path(f"{self.home}/committed")
        fs = self._fs(home)
        if not fs.exists(home):
            return []
        files = [status.getPath().getName() for status in fs.listStatus(home)]
        return sorted(x.removesuffix(".json") for x in files if x.endswith(".json"))

    def clear(self) -> None:
        """Remove all stages below the folder, whatever run they belong to."""
        root = self._path(self.root)
        self._fs(root).delete(root, True)

    def _committed(self, name: str) -> dict | None:
        path = self._path(f"{self.home}/committed/{name}.json")
        fs = self._fs(path)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, name: str, value: dict) -> None:
        draft = self._path(f"{self.home}/drafts/{uuid.uuid4().hex}")
        final = self._path(f"{self.home}/committed/{name}.json")
        fs = self._fs(final)
        fs.mkdirs(final.getParent())
        out = fs.create(draft)
        try:
            out.write(bytearray(json.dumps(value).encode()))
        finally:
            out.close()
        # A rename does not replace a file: of two runs that finish a stage the first one commits.
        if not fs.exists(final) and not fs.rename(draft, final) and not fs.exists(final):
            raise OSError(f"cannot commit stage {name}")

    def _new_path(self, name: str) -> str:
        return f"{self.home}/data/{name}-{uuid.uuid4().hex}"

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())


def content_of(df: DataFrame) -> str:
    """Text that tells tables of other rows apart, from sums that no order of the rows changes."""
    columns = sorted(df.columns)
    row = F.xxhash64(*columns)
    other = F.xxhash64(F.lit(1), *columns)
    found = df.agg(
        F.count("*"), F.bit_xor(row), F.bit_xor(other), F.sum(F.pmod(row, F.lit(1 << 31))),
    ).first()
    return repr((columns, *found))


def fingerprint(*parts: object) -> str:
    return hashlib.sha256("\n".join(repr(p) for p in parts).encode()).hexdigest()[:24]
