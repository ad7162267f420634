"""A state in buckets of its key, with a manifest per version.

A version's manifest says for each bucket which version last wrote it.  A new version
writes the buckets that its changes fall into and takes all others over by their entry,
so a small batch moves a small part of a large state.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

MANIFEST = "bucket int, version long, n_rows long, n_bytes long, n_buckets int"


@dataclass(frozen=True, eq=False)
class Buckets:
    """``keys`` are expressions over state rows and change rows alike, of the same types in both.

    ``count`` buckets are fixed for the life of a state; it bounds what the driver reads of a
    manifest.  ``keep`` versions stay readable, the one before the last among them, since a
    batch that is run again starts from it.
    """

    root: str
    keys: Sequence[Column]
    count: int = 64
    keep: int = 2

    def __post_init__(self) -> None:
        if self.count < 1 or self.keep < 2:
            raise ValueError("at least one bucket and two versions are needed")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.count)).cast("int")

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifest/version={version}"

    def _data(self, version: int, bucket: int | None = None) -> str:
        return f"{self.root}/data/version={version}" + ("" if bucket is None else f"/_bucket={bucket}")

    def manifest(self, spark: SparkSession, version: int) -> dict[int, Row]:
        """The entry of each bucket that has rows; at most ``count``."""
        entries = spark.read.schema(MANIFEST).parquet(self._manifest(version)).collect()
        if any(e["n_buckets"] != self.count for e in entries):
            raise ValueError(f"the state was written in another number of buckets than {self.count}")
        return {e["bucket"]: e for e in entries}

    def begin(self, initial: DataFrame) -> None:
        """Store ``initial`` as version -1."""
        initial.limit(0).write.mode("overwrite").parquet(f"{self.root}/columns")
        self._write(initial, -1, {})

    def touched(self, changes: DataFrame) -> list[int]:
        """The buckets that ``changes`` fall into."""
        return sorted(r["_bucket"] for r in changes.select(self.bucket().alias("_bucket")).distinct().collect())

    def read(self, spark: SparkSession, version: int, only: Iterable[int] | None = None) -> DataFrame:
        """The state of a version, or only some of its buckets."""
        schema = spark.read.parquet(f"{self.root}/columns").schema
        held = self.manifest(spark, version)
        wanted = sorted(held if only is None else held.keys() & set(only))
        if not wanted:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*[self._data(held[b]["version"], b) for b in wanted])

    def write(self, part: DataFrame, version: int, touched: Iterable[int]) -> None:
        """Store ``part`` as all rows of the buckets ``touched``; the others stay as they were.

        The manifest comes last: a version is there once its manifest is.  A repeated write
        replaces its own files.  Files that no kept version names are removed.
        """
        held = self.manifest(part.sparkSession, version - 1)
        for bucket in touched:
            held.pop(bucket, None)
        self._write(part, version, held)
        self._retire(part.sparkSession, version - self.keep)

    def _write(self, part: DataFrame, version: int, held: dict[int, Row]) -> None:
        spark = part.sparkSession
        columns = part.columns
        rows = part.withColumn("_bucket", self.bucket()).hint("rebalance", "_bucket")
        rows.write.mode("overwrite").partitionBy("_bucket").parquet(self._data(version))
        schema = part.select(*columns).schema.add("_bucket", "integer")
        files = (
            spark.read.schema(schema).parquet(self._data(version))
            .groupBy("_bucket", "_metadata.file_path")
            .agg(F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("size"))
        )
        written = files.groupBy("_bucket").agg(F.sum("n").alias("n"), F.sum("size").alias("size")).collect()
        entries = [tuple(e) for e in held.values()]
        entries += [(r["_bucket"], version, r["n"], r["size"], self.count) for r in written]
        spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("overwrite").parquet(self._manifest(version))

    def _retire(self, spark: SparkSession, version: int) -> None:
        """Remove a version's manifest, and its files that the next version does not name."""
        hadoop = spark._jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        manifest = hadoop.Path(self._manifest(version))
        files = manifest.getFileSystem(conf)
        if not files.exists(manifest):
            return
        named = {(b, e["version"]) for b, e in self.manifest(spark, version + 1).items()}
        for b, e in self.manifest(spark, version).items():
            if (b, e["version"]) not in named:
                files.delete(hadoop.Path(self._data(e["version"], b)), True)
        files.delete(manifest, True)
