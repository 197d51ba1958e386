"""A keyed table in versions: hash buckets are written anew where they change and referenced where they don't."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
_MANIFEST = "bucket int, written int"


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def child_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers ``n`` of the folders ``name=n`` below ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    return sorted(int(n.removeprefix(f"{name}=")) for n in names if n.startswith(f"{name}="))


@dataclass(frozen=True)
class BucketTable:
    """Rows of ``schema`` below ``path``, dealt by the hash of ``key`` to ``buckets``.

    ``data/version=v/bucket=b`` holds the rows of a bucket as version v wrote them. The manifest of a
    version names for each bucket the version that wrote it, one row per bucket; it is written last, as a single file, and
    a version counts from then on. So a run that ends before that changes nothing, and one that is repeated
    writes the same version again. The folders of one bucket are read as they are named: a hash never needs a listing.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    buckets: int = BUCKETS

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[int]:
        """The versions that count: those whose manifest is complete."""
        found = child_folders(self.spark, f"{self.path}/manifest", "version")
        return [v for v in found if self._complete(v)]

    def _complete(self, version: int) -> bool:
        file = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest/version={version}/_SUCCESS")
        return file.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(file)

    def manifest(self, version: int) -> dict[int, int]:
        """For each bucket with rows the version that wrote it; at most ``buckets`` rows."""
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/version={version}").collect()
        return {r["bucket"]: r["written"] for r in rows}

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version (the latest), of some buckets only if they are given."""
        chosen = max(self.versions()) if version is None else version
        where = {b: v for b, v in self.manifest(chosen).items() if buckets is None or b in set(buckets)}
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(where.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that the keys of ``rows`` fall in."""
        return sorted(r["b"] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def create(self, rows: DataFrame) -> None:
        """Version 0, unless there is one."""
        if not self.versions():
            self._write(rows, 0, {}, list(range(self.buckets)))

    def replace(self, base: int, version: int, touched: Sequence[int], rows: DataFrame) -> None:
        """Write ``version``: ``rows`` are all rows of the ``touched`` buckets, the others stay as in version ``base``."""
        self._write(rows, version, self.manifest(base), touched)

    def _write(self, rows: DataFrame, version: int, base: dict[int, int], touched: Sequence[int]) -> None:
        data = f"{self.path}/data/version={version}"
        if touched:
            # One file per bucket, sorted by key.
            named = rows.select(*self.schema.fieldNames(), self.bucket().alias("bucket"))
            ordered = named.repartition("bucket").sortWithinPartitions("bucket", self.key)
            ordered.write.mode("overwrite").partitionBy("bucket").parquet(data)
        own = set(child_folders(self.spark, data, "bucket")) if touched else set()
        manifest = {b: v for b, v in base.items() if b not in set(touched)} | dict.fromkeys(own, version)
        entries = self.spark.createDataFrame(sorted(manifest.items()), _MANIFEST)
        entries.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")

    def vacuum(self, keep: int = 2) -> None:
        """Remove all but the last ``keep`` versions and the buckets that only those used; what a dead run left goes too."""
        versions = self.versions()
        kept = versions[-keep:]
        used = {(v, b) for k in kept for b, v in self.manifest(k).items()}
        for v in versions[:-keep]:
            remove_folder(self.spark, f"{self.path}/manifest/version={v}")
        for v in child_folders(self.spark, f"{self.path}/data", "version"):
            if v > kept[-1]:
                continue  # a run may be writing it
            own = child_folders(self.spark, f"{self.path}/data/version={v}", "bucket")
            if not any((v, b) in used for b in own):
                remove_folder(self.spark, f"{self.path}/data/version={v}")
                continue
            for b in own:
                if (v, b) not in used:
                    remove_folder(self.spark, f"{self.path}/data/version={v}/bucket={b}")
