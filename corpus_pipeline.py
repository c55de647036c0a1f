"""From raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last keep the columns of documents, and any others that
come along, whatever their names.

Null and empty texts go at language ID, as they have no letter. Null ids are documents of their own.
Rows with one id are told apart by their texts; equal rows share one fate in line dedup and
decontamination, and one of them stays in near-dedup. Very long texts are worked on whole. Empty
tables give empty tables with the same columns.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skymart.llm import decontaminate, langid, line_dedup, near_dup, packing
from skymart.llm.common import keep, table
from skymart.llm.ship import shipped

#: Rows sent to all tasks to leave documents out; more of them are joined by a shuffle.
SENT_ROWS = 500_000

#: Rows that go to a Python worker at once. Spark's 10,000 are the texts of a whole partition, which lie
#: in the executor's direct memory and again in the worker, beside what earlier stages left in both.
BATCH_ROWS = 1_000


def _stage(run: Callable) -> Callable:
    """``run``, sending the package first and rows in small batches."""

    @functools.wraps(run)
    def small(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return run(spark, docs, sf_dir)

    return shipped(small)


def _numbered(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with its columns by number (so that no name can clash), and doc_id, text and lang."""
    own = [f"column_{i}" for i in range(len(docs.columns))]
    by_name = dict(zip(docs.columns, own))
    known = [F.col(by_name[name]).alias(name) for name in ("doc_id", "text", "lang") if name in by_name]
    return docs.toDF(*own).select(*own, *known), own


def _without(docs: DataFrame, gone: DataFrame, on: Column, name: str) -> DataFrame:
    """``docs`` (as d) without those that match a row of ``gone`` (as g)."""
    gone = keep(gone.distinct(), name)
    sent = F.broadcast(gone) if gone.count() <= SENT_ROWS else gone
    return docs.alias("d").join(sent.alias("g"), on, "left_anti")


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out texts without letters, and those too unlike the language they are nearest to.

    Null and empty texts have no letter. Repeated rows and long texts are judged like any other; of
    two languages equally near the first by name counts. Without any labelled text all go.
    """
    rows, own = _numbered(docs)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = langid.fit(rows, fold != 2)
    return langid.predict(rows, model, own).filter("not rejected").select(*own).toDF(*docs.columns)


@_stage
def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop repeated and near-repeated lines, and documents of which no text is left by that.

    A line lives where it occurs first, by doc_id (null last) and line number. Rows of equal id and
    text are one document. Documents that lose no line stay as they are, null and empty ones as well.
    """
    rows, own = _numbered(docs)
    by_name = dict(zip(docs.columns, own))
    found = line_dedup.dedup(rows, own)
    left = found.filter((F.col("n_repeated") + F.col("n_similar") == 0) | (F.trim("new_text") != ""))
    changed = {by_name["text"]: F.col("new_text")}
    if "n_chars" in by_name:
        changed[by_name["n_chars"]] = F.length("new_text").cast("bigint")
    return left.withColumns(changed).select(*own).toDF(*docs.columns)


@_stage
def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each near-duplicate group, one with the smallest id; null ids come last.

    Rows are told apart by a written key in the order of ids, so rows that repeat an id and rows
    without one are compared as well. Texts without words are no copies of each other and stay. Which
    of several equal rows stays makes no difference.
    """
    renamed, own = _numbered(docs)
    ordered = renamed.orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    rows = keep(ordered.select(*own, "text", F.monotonically_increasing_id().alias("row")), "rows")
    found = near_dup.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))
    gone = found.filter("not kept").select(F.col("doc_id").alias("copy"))
    left = _without(rows, gone, F.col("d.row") == F.col("g.copy"), "copies")
    return left.select(*[f"d.{c}" for c in own]).toDF(*docs.columns)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that hold a window of a benchmark item.

    Texts without words hold none. Rows of equal id and text, also without id, share one fate.
    """
    judged = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    gone = judged.filter("contaminated").select("doc_id", "text_hash")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.xxhash64("d.text") == F.col("g.text_hash"))
    return _without(docs, gone, same, "contaminated")


@_stage
def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of 4096; null and empty texts are their end id alone."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_deduplication),
    ("MinHash near-dedup", near_deduplication),
    ("benchmark decontamination", decontamination),
    ("packing", sequence_packing),
]

#: Language models and tokenizers are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
