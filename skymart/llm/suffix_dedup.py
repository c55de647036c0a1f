"""Removal of repeated byte strings with suffix arrays by two-stage sorting.

Each byte covered by a string of ``LENGTH`` bytes that starts anywhere else, too, goes. To bring equal
strings together, every window of that length is given an anchor: the smallest hash of the ``GRAM``
bytes long strings in it, the last one among equals. It depends on the window's bytes alone. Windows
in a row with one anchor form a run, and its bytes a context.

1. Contexts that occur twice are repeated as a whole: counting finds them, without any text.
2. Different contexts of one anchor are compared by suffix arrays, a block of whole anchors at a
   time, each context once. The suffixes smaller than their successors are sorted directly, the rest
   is induced from them by one scan over the buckets of first bytes; this doubles the sorted depth
   each time. Neighbours with a common prefix of ``LENGTH`` or more are repeated.
3. An anchor of more than ``ANCHOR_CONTEXTS`` contexts would be a group of any size in one task. Its
   windows are counted one by one by a 128-bit hash instead.

Null texts are empty. Null ids and repeated rows are documents like any other. Extra columns are
ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skymart.llm import words
from skymart.llm.common import keep, rows_by_bytes, text_buffer

LENGTH, GRAM = 400, 100
SEGMENT, OVER = 1 << 20, LENGTH - 1
BLOCK = 1 << 20
ANCHOR_CONTEXTS = 1000

_PLACE = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor place of every window of ``data``, and the hash of every gram."""
    n = len(data) - LENGTH + 1
    at = np.arange(len(data) - GRAM + 1)
    hashes = words.span_hashes(data, at, at + GRAM)
    keys = (hashes & ~_PLACE) | (_PLACE - at.astype(np.uint64))
    span, width = 1, LENGTH - GRAM + 1
    while 2 * span <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    keys = np.minimum(keys[:n], keys[width - span : width - span + n])
    return (_PLACE - (keys & _PLACE)).astype(np.int64), hashes


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """row, first and last window (within the row), anchor and context hashes of the runs of a batch."""
    out: list[list[np.ndarray]] = [[] for _ in range(6)]
    for a, b in rows_by_bytes(offsets, SEGMENT):
        begin, end = int(offsets[a]), int(offsets[b])
        for at in range(begin, max(end - OVER, begin), SEGMENT) if b == a + 1 else [begin]:
            part = data[at : min(at + SEGMENT + OVER, end) if b == a + 1 else end]
            if len(part) < LENGTH:
                continue
            place, hashes = anchors(part)
            edges = offsets[a + 1 : b + 1] - at
            window = np.arange(len(place))
            row = np.searchsorted(edges, window, "right")
            inside = window + LENGTH <= edges[np.minimum(row, len(edges) - 1)]
            first = inside.copy()
            first[1:] &= (place[1:] != place[:-1]) | (row[1:] != row[:-1]) | ~inside[:-1]
            last = inside.copy()
            last[:-1] &= first[1:] | ~inside[1:]
            first, last = np.flatnonzero(first), np.flatnonzero(last)
            raw = memoryview(part.tobytes())
            digests = b"".join(
                xxhash.xxh3_128_digest(raw[i:j]) for i, j in zip(first.tolist(), (last + LENGTH).tolist())
            )
            context = np.frombuffer(digests, np.int64).reshape(-1, 2)
            base = at - offsets[a + row[first]]
            columns = (a + row[first], base + first, base + last, hashes[place[first]].view(np.int64))
            for kept, column in zip(out, (*columns, context[:, 0], context[:, 1])):
                kept.append(column)
    return tuple(np.concatenate([np.zeros(0, np.int64), *c]) for c in out)


def occurrences(docs: DataFrame) -> DataFrame:
    """One row per run: doc_id, text_hash, first, last (windows), anchor, c1, c2 (context)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, first, last, anchor, c1, c2 = _runs(*text_buffer(batch.column(2)))
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    *(pa.array(c) for c in (first, last, anchor, c1, c2)),
                ],
                names=["doc_id", "text_hash", "first", "last", "anchor", "c1", "c2"],
            )

    return docs.mapInArrow(
        run,
        "doc_id bigint, text_hash bigint, first bigint, last bigint, anchor bigint, c1 bigint, c2 bigint",
    )


def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors; the last one counts as such."""
    differs = np.append(t[:-1] != t[1:], True)
    at = np.where(differs, np.arange(len(t)), len(t))
    decided = np.minimum.accumulate(at[::-1])[::-1]
    up = np.append(t[:-1] < t[1:], True)
    return up[decided]


def induce(t: np.ndarray, smaller: np.ndarray, sorted_smaller: np.ndarray) -> np.ndarray:
    """Order of all suffixes from that of the smaller ones: one scan over the buckets of first bytes."""
    waiting: dict[int, list[np.ndarray]] = {}
    heads = t[sorted_smaller]
    order = []
    for c in np.unique(t).tolist():
        bucket = waiting.pop(c, [])
        level = np.concatenate(bucket) if bucket else np.zeros(0, np.int64)
        bucket = [level]
        while len(level):  # larger ones that start with the same byte twice
            before = level[level > 0] - 1
            level = before[(t[before] == c) & ~smaller[before]]
            bucket.append(level)
        bucket.append(sorted_smaller[np.searchsorted(heads, c) : np.searchsorted(heads, c, "right")])
        whole = np.concatenate(bucket)
        order.append(whole)
        before = whole[whole > 0] - 1
        before = before[t[before] > c]
        head = t[before]
        before = before[np.argsort(head, kind="stable")]
        symbols, starts = np.unique(np.sort(head), return_index=True)
        for symbol, part in zip(symbols.tolist(), np.split(before, starts[1:])):
            waiting.setdefault(symbol, []).append(part)
    return np.concatenate(order)


def suffix_order(t: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Order of the suffixes by their first ``depth`` bytes at least.

    Also gives the ranks of all suffixes by half of that depth, and that half.
    """
    n = len(t)
    padded = np.append(t, np.zeros(8, np.uint8)).astype(np.uint64)
    head = np.zeros(n, np.uint64)
    for j in range(8):
        head = head << np.uint64(8) | padded[j : j + n]
    rank = np.unique(head, return_inverse=True)[1].astype(np.int64)
    smaller = smaller_than_next(t)
    some = np.flatnonzero(smaller)
    half = 8
    while True:
        behind = np.append(rank[half:], np.full(min(half, n), -1))[:n] + 1
        pair = rank * (n + 1) + behind
        order = induce(t, smaller, some[np.argsort(pair[some], kind="stable")])
        if 2 * half >= depth:
            return order, rank, half
        new = np.append(0, np.cumsum(np.diff(pair[order]) != 0))
        rank = np.empty(n, np.int64)
        rank[order] = new
        half *= 2


def repeated_starts(contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per context, which of its strings of ``length`` bytes start elsewhere in the contexts, too."""
    sizes = np.array([len(c) for c in contexts])
    # Bytes of UTF-8 stay below 255: 0 is left for the ends of contexts.
    t = np.frombuffer(b"\xff".join([*contexts, b""]), np.uint8) + np.uint8(1)
    order, rank, half = suffix_order(t, length)
    fits = np.append(np.concatenate([np.arange(n, -1, -1) >= length for n in sizes]), False)[: len(t)]
    i, j = order[:-1], order[1:]
    both = fits[i] & fits[j]
    i, j = i[both], j[both]
    equal = (rank[i] == rank[j]) & (rank[i + length - half] == rank[j + length - half])
    found = np.zeros(len(t), bool)
    found[i[equal]] = found[j[equal]] = True
    starts = np.cumsum(sizes + 1) - sizes - 1
    return [found[s : s + max(n - length + 1, 0)] for s, n in zip(starts, sizes)]


def _ranges(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], found.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


RANGES = "c1 bigint, c2 bigint, low bigint, high bigint"


def _by_suffixes(contexts: DataFrame) -> DataFrame:
    """Ranges of repeated windows in contexts (anchor, c1, c2, bytes) of the same anchors."""

    def found(rows: list[dict]) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], []]
        for row, starts in zip(rows, repeated_starts([r["bytes"] for r in rows])):
            low, high = _ranges(starts)
            for kept, values in zip(columns, ([row["c1"]] * len(low), [row["c2"]] * len(low), low, high)):
                kept.extend(values)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["c1", "c2", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if size >= BLOCK and row["anchor"] != block[-1]["anchor"]:
                    yield found(block)
                    block, size = [], 0
                block.append(row)
                size += len(row["bytes"])
        if block:
            yield found(block)

    # A fixed number of partitions: contexts are small for the work they make, and would be drawn together.
    parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return contexts.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(run, RANGES)


def _by_windows(contexts: DataFrame) -> DataFrame:
    """The same for anchors of any number of contexts, by counting windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = memoryview(row["bytes"])
                n = len(raw) - LENGTH + 1
                digests = b"".join(xxhash.xxh3_128_digest(raw[i : i + LENGTH]) for i in range(n))
                w = np.frombuffer(digests, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["c1"])),
                        pa.array(np.full(n, row["c2"])),
                        pa.array(np.arange(n)),
                        pa.array(w[:, 0]),
                        pa.array(w[:, 1]),
                    ],
                    names=["c1", "c2", "low", "w1", "w2"],
                )

    windows = keep(
        contexts.select("c1", "c2", "bytes").mapInArrow(
            run, "c1 bigint, c2 bigint, low bigint, w1 bigint, w2 bigint"
        ),
        "hot-windows",
    )
    often = keep(windows.groupBy("w1", "w2").count().filter("count > 1").drop("count"), "often")
    found = windows.join(often, ["w1", "w2"]).select("c1", "c2", "low")
    # Windows in a row differ from their rank by the same number.
    rank = F.row_number().over(Window.partitionBy("c1", "c2").orderBy("low"))
    rows = found.withColumn("row", F.col("low") - rank).groupBy("c1", "c2", "row")
    return rows.agg(F.min("low").alias("low"), F.max("low").alias("high")).drop("row")


def _same(left: str, right: str) -> Column:
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (
        F.col(f"{left}.text_hash") == F.col(f"{right}.text_hash")
    )


def _contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes of the contexts ``wanted`` (place, anchor, c1, c2), from the texts."""
    one = F.struct("place.first", "place.last", "anchor", "c1", "c2")
    by_doc = wanted.groupBy(F.col("place.doc_id").alias("doc_id"), F.col("place.text_hash").alias("text_hash"))
    by_doc = keep(by_doc.agg(F.collect_list(one).alias("runs")), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, runs in zip(batch.column(0), batch.column(1)):
                raw, rows = text.as_py().encode(), runs.as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([r[c] for r in rows], pa.int64()) for c in ("anchor", "c1", "c2")),
                        pa.array([raw[r["first"] : r["last"] + LENGTH] for r in rows], pa.binary()),
                    ],
                    names=["anchor", "c1", "c2", "bytes"],
                )

    joined = docs.alias("d").join(by_doc.alias("w"), _same("d", "w")).select("d.text", "w.runs")
    found = joined.mapInArrow(run, "anchor bigint, c1 bigint, c2 bigint, bytes binary")
    # A row that is there twice gives its contexts twice.
    return keep(found.dropDuplicates(["anchor", "c1", "c2"]), "contexts")


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (runs of removed bytes) and kept (binary) of every row."""
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    runs = keep(occurrences(docs), "runs")
    place = F.struct("doc_id", "text_hash", "first", "last")
    classes = keep(
        runs.groupBy("anchor", "c1", "c2").agg(F.count("*").alias("n"), F.min(place).alias("place")), "classes"
    )
    shared = keep(classes.groupBy("anchor").agg(F.count("*").alias("m")).filter("m > 1"), "anchors")
    wanted = classes.join(shared, "anchor")
    contexts = _contexts(docs, wanted).join(shared, "anchor")
    ranges = _by_suffixes(contexts.filter(F.col("m") <= ANCHOR_CONTEXTS).drop("m"))
    ranges = ranges.union(_by_windows(contexts.filter(F.col("m") > ANCHOR_CONTEXTS).drop("m")))
    # One row per context: the whole of those that occur twice, the ranges found in the others.
    last = F.col("place.last") - F.col("place.first")
    span = F.struct(F.lit(0).cast("bigint").alias("low"), last.alias("high"))
    whole = classes.filter("n > 1").select("c1", "c2", F.array(span).alias("spans"))
    partly = ranges.join(whole.select("c1", "c2"), ["c1", "c2"], "left_anti").groupBy("c1", "c2")
    marks = keep(whole.union(partly.agg(F.collect_set(F.struct("low", "high")))), "ranges")
    shifted = F.transform(
        "spans", lambda r: F.struct((F.col("first") + r["low"]).alias("low"), (F.col("first") + r["high"]).alias("high"))
    )
    hits = runs.join(marks, ["c1", "c2"]).select("doc_id", "text_hash", shifted.alias("spans"))
    by_doc = keep(
        hits.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("spans")).alias("ranges")), "removed"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = np.frombuffer(text.encode(), np.uint8)
                if not ranges:
                    rows.append((len(raw), 0, 0, raw.tobytes()))
                    continue
                depth = np.zeros(len(raw) + 1, np.int64)
                np.add.at(depth, [r["low"] for r in ranges], 1)
                np.add.at(depth, [r["high"] + LENGTH for r in ranges], -1)
                gone = np.cumsum(depth[:-1]) > 0
                rows.append((len(raw), int(gone.sum()), len(_ranges(gone)[0]), raw[~gone].tobytes()))
            sizes, removed, spans, kept = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in (sizes, removed, spans)), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    joined = docs.alias("d").join(by_doc.alias("r"), _same("d", "r"), "left")
    return joined.select("d.doc_id", "d.text", "r.ranges").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )
