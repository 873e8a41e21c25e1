"""Keyed state of a stream as versioned tables in the shared folder.

A stream that must accept rows behind the watermark can't use Spark's stateful operators,
which drop them. Its state is kept here instead: a table gets one version for each
micro-batch, written under the batch's id, and a batch reads versions below its own id only.
A batch that runs again after a failure therefore starts from the same state and overwrites
what it had written, so every row counts once. Folder names follow from the batch id alone;
nothing is listed and nothing passes through the driver.

Rows are dealt to ``BUCKETS`` folders by the hash of their key, so that a batch reads the
buckets that its keys fall into. Writes hold only the rows that a batch adds or changes; every
``compact_every`` versions the live rows are written out as a new base, so that a read never
meets more than that many versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 16
COMPACT_EVERY = 16

_BUCKET, _VERSION, _FOLDER, GONE = "__bucket", "__version", "__folder", "__gone"


class VersionedTable:
    """Rows of ``schema``, the latest of each ``ids`` standing; without ``ids`` an append-only log."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, ids: list[str] | None = None,
                 buckets: int = BUCKETS, compact_every: int = COMPACT_EVERY):
        self.spark, self.path, self.schema, self.key, self.ids = spark, path.rstrip("/"), schema, key, ids
        self.buckets, self.compact_every = buckets, compact_every

    def bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of the keys of ``rows``: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def _folders(self, before: int, base: int | None = None) -> list[str]:
        """The base below ``before`` and the versions after it."""
        if base is None:
            # The batch whose id is a multiple writes its base after reading, so it still reads the one before.
            base = (before - 1) // self.compact_every * self.compact_every if self.ids and before else 0
        return [self._folder("base", base)] * (base > 0) + [self._folder("delta", v) for v in range(base, before)]

    def _folder(self, kind: str, version: int) -> str:
        return f"{self.path}/{_FOLDER}={kind}-{version}"

    def _write(self, rows: DataFrame, folder: str, version: int, spread: int = 1) -> None:
        # A file for each bucket that has rows, or up to ``spread`` of them.
        rows = rows.withColumn(_VERSION, F.lit(version).cast("long")).withColumn(_BUCKET, self.bucket())
        rows.repartition(_BUCKET, F.pmod(F.xxhash64(*self.schema.names), F.lit(spread))).write.mode("overwrite").partitionBy(_BUCKET).parquet(folder)

    def _stored(self) -> T.StructType:
        extra = [T.StructField(GONE, T.BooleanType())] if self.ids else []
        return T.StructType([*self.schema.fields, *extra, T.StructField(_VERSION, T.LongType()),
                             T.StructField(_FOLDER, T.StringType()), T.StructField(_BUCKET, T.IntegerType())])

    def read(self, before: int, buckets: list[int] | None = None) -> DataFrame:
        """The rows that stand after the versions below ``before``, of all or some buckets."""
        return self._read(self._folders(before), buckets)

    def _read(self, folders: list[str], buckets: list[int] | None = None) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self._stored()).option("basePath", self.path).parquet(*folders)
        if buckets is not None:
            rows = rows.filter(F.col(_BUCKET).isin(buckets) if buckets else F.lit(False))
        names = self.schema.names
        if self.ids is None:
            return rows.select(*names)
        # Ids travel as one struct, so that null ones are ids too.
        rest = [c for c in names if c not in self.ids]
        last = rows.groupBy(F.struct(*self.ids).alias("__id")).agg(F.max_by(F.struct(*rest, GONE), _VERSION).alias("__row"))
        return last.filter(~F.col(f"__row.{GONE}")).select(
            *[F.col(f"__id.{c}" if c in self.ids else f"__row.{c}").alias(c) for c in names])

    def write(self, rows: DataFrame, version: int, spread: int = 1) -> None:
        """Add ``rows`` as a version: with ids, the rows that are new, changed or (``__gone``) no longer there.

        ``spread`` tasks share the rows of a bucket, since all rows of a key fall into one."""
        if self.ids and version and version % self.compact_every == 0:
            # Reads from this version on start here. A batch that runs again writes the same base again.
            older = self._folders(version, version - self.compact_every)
            self._write(self._read(older).withColumn(GONE, F.lit(False)), self._folder("base", version), version - 1)
        if self.ids and GONE not in rows.columns:
            rows = rows.withColumn(GONE, F.lit(False))
        self._write(rows.select(*self.schema.names, *([GONE] if self.ids else [])), self._folder("delta", version), version, spread)
