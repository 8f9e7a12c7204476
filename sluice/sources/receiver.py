"""A receiver: a table kept in buckets of its keys, each as of a version that a pointer names.

A commit writes the buckets that it touches under a new version, then the pointer is replaced in one step, with the number of
the batch that it holds. A crash in between leaves the old pointer in force; a batch that was applied is not applied again.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a table; a commit of few keys rewrites few of them.
BUCKETS = 64
_NONE = {"version": -1, "batch": -1, "bookmarks": {}, "buckets": {}}


class Receiver:
    def __init__(self, spark: SparkSession, path: str, schema: str, keys: tuple[str, ...] = ("coll", "doc_key"), buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.keys, self.n_buckets = spark, path.rstrip("/"), schema, keys, buckets
        jvm = spark.sparkContext._jvm
        self._new = jvm.org.apache.hadoop.fs.Path
        self._fs = self._new(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._jvm = jvm

    def _names(self, folder: str) -> list[str]:
        at = self._new(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _pointer(self) -> dict:
        """The newest complete pointer; pointers are numbered files, so that one is never rewritten."""
        names = [n for n in self._names("pointers") if not n.startswith("_")]
        if not names:
            return dict(_NONE)
        stream = self._fs.open(self._new(f"{self.path}/pointers/{names[-1]}"))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    @property
    def batch(self) -> int:
        return self._pointer()["batch"]

    @property
    def bookmarks(self) -> dict[str, str]:
        return self._pointer()["bookmarks"]

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.n_buckets))

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        held = self._pointer()["buckets"]
        paths = [f"{self.path}/v{v:09d}/bucket={b}" for b, v in held.items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def commit(self, rows: DataFrame, batch: int, bookmarks: dict[str, str] | None = None, partitions: int | None = None, buckets: list[int] | None = None) -> bool:
        """Puts rows in place of all that is there, or of what some buckets hold, unless this batch or a later one is there already."""
        now = self._pointer()
        if batch <= now["batch"]:
            return False
        version = now["version"] + 1
        folder = f"v{version:09d}"
        dealt = rows.withColumn("bucket", self.bucket())
        (dealt.coalesce(partitions) if partitions else dealt.repartition("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{folder}")
        held = {} if buckets is None else {b: v for b, v in now["buckets"].items() if int(b) not in buckets}
        held |= {n.removeprefix("bucket="): version for n in self._names(folder) if n.startswith("bucket=")}
        text = json.dumps({"version": version, "batch": batch, "bookmarks": now["bookmarks"] | (bookmarks or {}), "buckets": held})
        temp, final = self._new(f"{self.path}/pointers/_{version:09d}"), self._new(f"{self.path}/pointers/{version:09d}")
        out = self._fs.create(temp, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self._fs.rename(temp, final):
            raise RuntimeError(f"version {version} was committed by another writer")
        self._clean(now, held)
        return True

    def _clean(self, before: dict, held: dict[str, int]) -> None:
        """Deletes what neither this pointer nor the one before names: readers that began on that one go on."""
        needed = {f"v{v:09d}" for v in (*before["buckets"].values(), *held.values(), before["version"] + 1)}
        for name in self._names(""):
            if name.startswith("v") and name not in needed:
                self._fs.delete(self._new(f"{self.path}/{name}"), True)
        for name in self._names("pointers")[:-2]:
            self._fs.delete(self._new(f"{self.path}/pointers/{name}"), False)

    def drop(self, batch: int) -> bool:
        return self.commit(self.spark.createDataFrame([], self.schema), batch)
