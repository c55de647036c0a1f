"""Secret scan over an incremental blob ledger.

Every version of every document is addressed by the SHA-256 of its text. The ledger is a Parquet
folder of (blob, rules, spans): which blob was scanned under which rule set, and what was found. A
scan reads only texts whose (blob, rules) pair the ledger lacks, once per distinct text, appends
them in one job, and joins the findings back to all documents that hold the blob. A failed append
publishes nothing, so its blobs stay unseen.

Null text is an empty text. Repeated rows give repeated results. An empty table gives no rows.
Extra columns are ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
SCHEMA = f"blob string, rules string, spans {SPANS}"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_ARROW = pa.schema([("blob", pa.string()), ("rules", pa.string()), ("spans", _SPANS)])


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters.

    ``hints``: lower-case strings of which a text with a match holds one; none means unknown.
    """

    kind: str
    pattern: str
    least: int
    group: int = 0
    hints: tuple[str, ...] = ()


# The base rules.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        2,
        ("password", "passwd", "secret", "token", "api"),
    ),
    Rule("access", "AKIA[A-Z0-9]+", 20, hints=("akia",)),
    Rule("hex", "[0-9a-f]{24,}", 24),
)


def version(rules: tuple[Rule, ...]) -> str:
    """Name of a rule set: changes with any of its rules."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def find(text: str, rules: tuple[Rule, ...]) -> list[tuple[str, int, int]]:
    """Spans of one text by start, then in the order of the rules."""
    low, found = text.lower(), []
    for order, rule in enumerate(rules):
        if rule.hints and not any(h in low for h in rule.hints):
            continue
        for m in re.compile(rule.pattern, re.ASCII).finditer(text):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), order, m.end(), rule.kind))
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], SCHEMA)


def _addressed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id"), text.alias("text")).withColumn("blob", F.sha2("text", 256))


def scan_unseen(docs: DataFrame, path: str, rules: tuple[Rule, ...] = BASE_RULES) -> None:
    """Append the scans of all blobs in ``docs`` that the ledger lacks under these rules."""
    name = version(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"kind": k, "start": a, "end": b} for k, a, b in find(text.as_py(), rules)] for text in batch.column(1)
            ]
            names = pa.array([name] * batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), names, pa.array(spans, _SPANS)], schema=_ARROW)

    seen = read_ledger(docs.sparkSession, path).filter(F.col("rules") == name).select("blob")
    blobs = _addressed(docs).select("blob", "text").dropDuplicates(["blob"])
    blobs.join(seen, "blob", "left_anti").select("blob", "text").mapInArrow(run, SCHEMA).write.mode("append").parquet(
        path
    )


def scan(docs: DataFrame, path: str, rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """doc_id, blob and spans of every row of ``docs``, scanning only what the ledger lacks."""
    scan_unseen(docs, path, rules)
    ledger = read_ledger(docs.sparkSession, path).filter(F.col("rules") == version(rules))
    return _addressed(docs).select("doc_id", "blob").join(ledger.drop("rules"), "blob")


def count(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def joined(spans):
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
