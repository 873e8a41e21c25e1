"""Token ids as compressed binary segments, in ascending document order.

Documents are range-partitioned and sorted by id, encoded with a byte-level BPE
vocabulary file and an end id, and written as segments of the format of
``rans.py`` (each with the frequency table its blocks share). The segments lie in the
binary column of Parquet files, so Spark's own commit protocol covers lost
executors and any store that Spark reaches. A reader decodes segments in parallel and
finds each document's first id from the segments' totals.

Cases: a null text is empty (only the end id). Null ids come last. Repeated ids are
ordered by text; repeated rows are repeated. An empty table gives an empty store.
A document is never split between segments. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_or_empty

#: Ids after which a segment is closed.
SEGMENT_IDS = 1 << 20
END_ID = 2


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text", partitions: int | None = None, segment_ids: int = SEGMENT_IDS) -> None:
    """Write (part, seq, n_docs, n_ids, doc_ids, payload) rows to ``path``."""
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.col("doc_id").asc_nulls_last()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("t"))
    rows = rows.repartitionByRange(n, key).sortWithinPartitions(key, "t")

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from .bpe import encoder
        from .rans import encode_segment

        enc, part, seq = encoder(vocabulary), TaskContext.get().partitionId(), 0
        ids, held, n_ids = [], [], 0
        end = np.array([end_id], np.int32)

        def segment():
            sizes = np.array([len(x) + 1 for x in ids], np.int64)
            flat = np.concatenate([y for x in ids for y in (x, end)]) if ids else np.zeros(0, np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([len(flat)], pa.int64()),
                 pa.array([held], pa.list_(pa.int64())), pa.array([encode_segment(flat, sizes)], pa.binary())],
                ["part", "seq", "n_docs", "n_ids", "doc_ids", "payload"])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for at in range(0, batch.num_rows, 256):
                for x, k in zip(enc.encode(batch.column(1).slice(at, 256).to_pylist()), keys[at:at + 256], strict=True):
                    ids.append(x)
                    held.append(k)
                    n_ids += len(x) + 1
                    if n_ids >= segment_ids:
                        yield segment()
                        ids, held, n_ids, seq = [], [], 0, seq + 1
        if ids:
            yield segment()

    rows.mapInArrow(encode, "part int, seq int, n_docs long, n_ids long, doc_ids array<long>, payload binary").write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (little-endian unsigned 32-bit integers)."""
    segments = spark.read.schema("part int, seq int, n_docs long, n_ids long, doc_ids array<long>, payload binary").parquet(path)
    sizes = segments.select("part", "seq", "n_ids")
    # Prefix sums in two levels: parts (one row each), then the segments of a part.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inner = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    starts = sizes.withColumn("inner", inner).join(parts, "part").select("part", "seq", (F.col("before") + F.col("inner")).alias("first"))

    def decode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from .rans import decode_segment

        for batch in batches:
            for k in range(batch.num_rows):
                first, keys, payload = (batch.column(i)[k].as_py() for i in range(3))
                ids, counts = decode_segment(payload)
                raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts)
                cuts = pa.array(np.concatenate([[0], ends * 4]).astype(np.int32), pa.int32())
                for a in range(0, len(keys), 2048):
                    b = min(len(keys), a + 2048)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[a:b], pa.int64()), pa.array(first + ends[a:b] - counts[a:b], pa.int64()),
                         pa.Array.from_buffers(pa.binary(), b - a, [None, cuts.slice(a, b - a + 1).buffers()[1], pa.py_buffer(raw)], offset=a)],
                        ["doc_id", "start", "ids"])

    return (segments.join(starts, ["part", "seq"]).select("first", "doc_ids", "payload")
            .mapInArrow(decode, "doc_id long, start long, ids binary"))
