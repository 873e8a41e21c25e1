"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronokey.session import checkpoint_dir

#: A side is broadcast by hint only after its rows were counted and are at most this many (8 to 40 bytes each).
BROADCAST_ROWS = 500_000


def small_batches(spark: SparkSession) -> None:
    """Keep this session's Arrow batches small, since texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(col: str | Column) -> Column:
    """A text column; null counts as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/chronokey-{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    This cuts lineage with true file sizes for the planner, and survives the
    loss of executors, since the files are not theirs.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to hold at most ``rows`` rows, else as it is.

    Above the limit the join runs as an ordinary shuffled one, with the same result.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def packed(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` in one struct ``row``, so that no helper column clashes with them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def runs(batches: Iterator, key: str) -> Iterator:
    """Split a stream of Arrow batches, sorted by ``key``, into (key, table) runs.

    Only the rows of one key are held at a time.
    """
    import numpy as np
    import pyarrow as pa

    held: list = []
    current = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [len(k)]])
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            if held and k[s] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = k[s]
            held.append(b.slice(s, e - s))
    if held:
        yield current, pa.Table.from_batches(held)
