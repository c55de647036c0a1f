"""Token ids in Parquet: list columns, dictionary pages, small row groups, page indexes.

A folder holds one file per range of document ids, in ascending order over the files:

    shard int           number of the file's range
    shard_start bigint  ids of all documents before this one in the file
    doc_id bigint       sorted, so row-group statistics and page indexes prune by it
    n_tokens bigint     ids of the document, the end id included
    ids array<int>      dictionary-encoded (a vocabulary of 49,408 ids fits in one dictionary page)

A reader that selects documents touches only the pages of their rows; one that wants lengths only
never reads ids. Row groups are small enough for a task to hold several.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from skymart.llm.tokens import default_path, encoder, with_end

SCHEMA = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("shard_start", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ]
)
#: Parquet writer settings: bytes of a row group, of a page, rows of a page, dictionary limit.
LAYOUT = {
    "compression": "zstd",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
}


def encode(docs: DataFrame, *, end_id: int = 1, tokenizer: str | None = None) -> DataFrame:
    """Rows of the file format for ``docs`` (doc_id, text), ranged and sorted by doc_id.

    Null text is empty (its end id alone). Null ids come first. Rows with one doc_id stay in the
    order in which the input holds them, however many they are; a range may end between them.
    Extra columns are ignored, an empty table gives no rows.
    """
    path = tokenizer or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, before = context.partitionId() if context else 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids, counts = with_end(*encoder(path).encode(part.column(1)), end_id)
                ends = np.cumsum(counts)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(part), shard, np.int32)),
                        pa.array(before + ends - counts),
                        part.column(0),
                        pa.array(counts),
                        lists,
                    ],
                    names=["shard", "shard_start", "doc_id", "n_tokens", "ids"],
                )
                before += int(ends[-1]) if len(ends) else 0

    placed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.monotonically_increasing_id().alias("place"),
    )
    ordered = placed.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
    return ordered.select("doc_id", "text").mapInArrow(run, SCHEMA)


def write(docs: DataFrame, path: str, *, end_id: int = 1, tokenizer: str | None = None) -> None:
    encode(docs, end_id=end_id, tokenizer=tokenizer).write.options(**LAYOUT).parquet(path)


def read(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The written rows; ``where`` on doc_id, shard or n_tokens reaches the page indexes."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    return rows if where is None else rows.filter(where)


def with_start(rows: DataFrame, path: str) -> DataFrame:
    """Add ``start``: the ids of all documents before each one, over all files.

    Reads only the lengths for it. There is one total per file, summed up in file order.
    """
    spark = rows.sparkSession
    totals = read(spark, path).groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("shard", F.coalesce(before, F.lit(0)).alias("shard_base"))
    joined = rows.join(F.broadcast(starts), "shard")
    return joined.withColumn("start", F.col("shard_base") + F.col("shard_start"))


def checksums(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of each row's ids as little-endian 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum(batch.column(2).to_numpy(zero_copy_only=False))
            raw, begin = memoryview(flat.tobytes()), 0
            crcs = []
            for end in (4 * ends).tolist():
                crcs.append(zlib.crc32(raw[begin:end]))
                begin = end
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
