"""Near-duplicate documents by HyperMinHash.

A document's set is its distinct word shingles. Its sketch has 336 buckets: a shingle's hash picks
the bucket, and a bucket keeps, of its smallest remaining hash, the number of leading zeros and the
ten bits behind the first one, in 16 bits. Empty buckets take another's register for banding. Documents with equal sets are one class, held by the
smallest id, and only classes go on:

1. Bands of six registers are buckets of candidates. In each, every member is paired with the
   smallest id only, so a group of any size gives as many pairs as members.
2. Pairs pass the size bound and the Jaccard estimate from their registers, corrected for registers
   that agree by chance, with five standard deviations of slack; then the full sets are compared.
3. Links give components. Members of one bucket that are in different components after that are
   checked against each other as well, so no pair of a bucket is left unchecked unless already
   connected. Buckets are cut into blocks, and two blocks meet in a task. By registers it tells the
   members that have a pair left to check, once for each pair in the first band it shares; with
   the full sets of those, another task counts common shingles of all pairs at once and emits links
   that connect something. No list of pairs is written: rows grow with members, also in a group
   of near copies that all just miss the threshold.

For a pair at a similarity of 0.8 the chance to share none of the 56 bands is about 4 in 100 million, and
links through other documents make up for most of these.

Null or empty texts, and texts without words, have no set and no link. A text with fewer words than
a shingle is one shingle. Null ids are kept and never linked. Ids should be unique; rows that repeat
one give one result row each, by their own texts. Extra columns are ignored, empty tables give no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymart.llm import words
from skymart.llm.common import keep, lean, text_buffer
from skymart.llm.components import components

BANDS, BAND_SIZE, MANTISSA = 56, 6, 10
BUCKETS = BANDS * BAND_SIZE
EMPTY = np.uint16(0xFFFF)
#: Standard deviations of the estimate by which a pair may miss the threshold and still be confirmed.
SLACK = 5
#: Members and shingles of a block, about; a task compares two blocks.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
#: Shingles whose holders are compared at once.
COLUMNS = 4096
#: Texts whose words are hashed at once.
TEXTS = 200
#: Parts of the bucket keys that are counted apart. Nearly all keys are held by one set, so a task's table of
#: counts has a row for nearly every key it reads.
KEY_PARTS = 4
#: Ids sent to all tasks to pick the texts of candidates; more of them are joined by a shuffle.
SENT_IDS = 500_000

_FLOORS = np.array([-(-(b << 64) // BUCKETS) for b in range(BUCKETS)], np.uint64)


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    data, offsets = text_buffer(texts)
    h, rows = words.word_hashes(data, offsets)
    n = len(offsets) - 1
    bounds = np.searchsorted(rows, np.arange(n + 1))
    with np.errstate(over="ignore"):
        whole = h[: max(len(h) - width + 1, 0)].copy()
        for j in range(1, width):
            whole = words.mix(whole * words.MIX[0] + h[j : j + len(whole)])
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(whole[a : b - width + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[a:b].tobytes())], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers of a sorted set: leading zeros and mantissa of the smallest hash of each bucket."""
    at = np.searchsorted(shingles, _FLOORS)
    full = np.flatnonzero(at < np.append(at[1:], len(shingles)))
    registers = np.full(BUCKETS, EMPTY, np.uint16)
    rest = (shingles[at[full]] - _FLOORS[full]) * np.uint64(BUCKETS) | np.uint64(1)
    zeros = 63 - np.floor(np.log2(rest.astype(np.float64))).astype(np.int64)
    zeros = np.clip(zeros, 0, 63)
    # Rounding to a double may have lifted a value to the next power of two.
    zeros += (rest >> (63 - zeros).astype(np.uint64)) == 0
    zeros = np.minimum(zeros, 63)
    shifted = rest << zeros.astype(np.uint64) << np.uint64(1)
    registers[full] = (zeros.astype(np.uint64) << np.uint64(MANTISSA) | shifted >> np.uint64(64 - MANTISSA)).astype(
        np.uint16
    )
    return registers


def dense(registers: np.ndarray) -> np.ndarray:
    """Registers with each empty one filled from another, tried in a fixed random order.

    Else a band of a small set would rest on a register or two, and agree by one common shingle.
    """
    out, full = registers.copy(), registers != EMPTY
    empty, turn = np.flatnonzero(~full), 0
    if not full.any():
        return out
    while len(empty):
        source = _fill(turn)[empty]
        hit = full[source]
        out[empty[hit]] = registers[source[hit]]
        empty, turn = empty[~hit], turn + 1
    return out


_DRAWS: list[np.ndarray] = []
_DRAW = np.random.default_rng(7)


def _fill(turn: int) -> np.ndarray:
    """The bucket that each bucket takes its register from at a turn, the same for all sets."""
    while len(_DRAWS) <= turn:
        _DRAWS.append(_DRAW.integers(0, BUCKETS, BUCKETS))
    return _DRAWS[turn]


def bands(registers: np.ndarray) -> np.ndarray:
    """Bucket keys of the bands."""
    grouped = dense(registers).reshape(BANDS, BAND_SIZE)
    keys = [xxhash.xxh3_64_intdigest(grouped[b].tobytes(), seed=b) for b in range(BANDS)]
    return np.array(keys, np.uint64).view(np.int64)


def linkable(n_shingles: Column, percent: int) -> Column:
    """Sets large enough to be linked with a different one."""
    return 100 * n_shingles >= percent * (n_shingles + 1)


def chance(n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Probability that a register of two unrelated sets of these sizes agrees, both being in use.

    The smallest of n uniform values has density n (1-x)**(n-1); two of them fall into the same
    cell of width w about x with probability w**2 times both densities. Summed over the octaves.
    """
    m1, m2 = np.maximum(n1 / BUCKETS, 1.0), np.maximum(n2 / BUCKETS, 1.0)
    power = m1 + m2 - 1
    total = np.zeros(np.broadcast(m1, m2).shape)
    for zeros in range(0, 54):
        low, high = 2.0 ** -(zeros + 1), 2.0**-zeros
        width = low / (1 << MANTISSA)
        total += width * m1 * m2 / power * ((1 - low) ** power - (1 - high) ** power)
    return np.minimum(total, 0.5)


def estimate(a: np.ndarray, b: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of register rows, and the number of registers each rests on."""
    used = (a != EMPTY) | (b != EMPTY)
    count = used.sum(axis=1)
    share = ((a == b) & used).sum(axis=1) / np.maximum(count, 1)
    random = chance(n1, n2)
    return (share - random) / (1 - random), count


def likely(a: np.ndarray, b: np.ndarray, n1: np.ndarray, n2: np.ndarray, percent: int) -> np.ndarray:
    """Which register rows may belong to sets that are similar enough.

    The spread is that of independent draws, which is more than that of registers.
    """
    guess, count = estimate(a, b, n1, n2)
    share = percent / 100
    spread = share * (1 - share) / np.maximum(count, 1)
    return (guess >= share - SLACK * np.sqrt(spread)) & (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2))


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, signature of the set (null if empty) and registers of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                sets = shingle_sets(batch.column(1), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([sketch(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "signature", "registers"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        lean(run), "doc_id bigint, n_shingles bigint, signature binary, registers binary"
    )


def _keys(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [bands(np.frombuffer(r, np.uint16)) for r in batch.column(1).to_pylist()]
            keys = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            ids = np.repeat(batch.column(0).to_numpy(), [len(r) for r in rows])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], names=["key", "id"])

    return classes.select("id", "registers").mapInArrow(lean(run), "key bigint, id bigint")


def _hubs(keys: DataFrame) -> DataFrame:
    """key and smallest id of the buckets with several members."""
    parts = []
    for part in range(KEY_PARTS):
        own = keys.filter(F.pmod(F.col("key"), F.lit(KEY_PARTS)) == part)
        held = own.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("n"))
        parts.append(held.filter("n > 1").drop("n"))
    return functools.reduce(DataFrame.union, parts)


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that pass the size bound and the estimate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n1, n2 = (batch.column(i).to_numpy().astype(float) for i in (2, 3))
            passed = likely(_registers(batch.column(4)), _registers(batch.column(5)), n1, n2, percent)
            yield batch.filter(pa.array(passed)).select([0, 1])

    one = classes.select(F.col("id").alias("a"), F.col("n_shingles").alias("n1"), F.col("registers").alias("r1"))
    two = classes.select(F.col("id").alias("b"), F.col("n_shingles").alias("n2"), F.col("registers").alias("r2"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "n1", "n2", "r1", "r2")
    return joined.mapInArrow(lean(run), "a bigint, b bigint")


CELL = ["key", "x", "y"]


def _cells(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members (key, id, label) of buckets by pair of blocks: key, x, y, own block, id, label, n_shingles."""
    sized = keep(members.join(classes.select("id", "n_shingles"), "id"), "sized")
    counts = sized.groupBy("key").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("size"))
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK, F.col("size") / BLOCK_SHINGLES)).cast("int")
    placed = sized.join(counts.select("key", blocks.alias("blocks")), "key")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cells.select(
        "key",
        F.least("own", "other").alias("x"),
        F.greatest("own", "other").alias("y"),
        "own",
        "id",
        "label",
        "n_shingles",
    )


def _unchecked(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Rows of cells that have a likely pair across components there; key, x, y, own, id, label."""
    rows = _cells(members, classes).join(classes.select("id", "registers"), "id")

    def run(cell: pa.Table) -> pa.Table:
        ids, labels, own, n = (cell[c].to_numpy() for c in ("id", "label", "own", "n_shingles"))
        x, y, here = (cell[c][0].as_py() for c in ("x", "y", "key"))
        registers, n = _registers(cell["registers"].combine_chunks()), n.astype(float)
        keys = np.array([bands(r) for r in registers])
        told = np.zeros(len(ids), bool)
        for i in np.flatnonzero(own == x).tolist():
            if x == y:
                right = np.flatnonzero((labels != labels[i]) & (ids > ids[i]))
            else:
                right = np.flatnonzero((own != x) & (labels != labels[i]))
            right = right[100 * np.minimum(n[right], n[i]) >= percent * np.maximum(n[right], n[i])]
            # A pair that meets in several buckets is told in the one of its first common band.
            same = keys[right] == keys[i]
            right = right[keys[i][same.argmax(axis=1)] == here]
            if len(right):
                size = np.full(len(right), n[i])
                right = right[likely(registers[i : i + 1], registers[right], size, n[right], percent)]
                told[right] = True
                told[i] |= len(right) > 0
        return cell.select([*CELL, "own", "id", "label"]).filter(pa.array(told))

    return rows.groupBy(*CELL).applyInArrow(run, "key bigint, x int, y int, own int, id bigint, label bigint")


def common_shingles(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles the sets ``left`` and ``right`` (numbers of sets) have in common, pair by pair."""
    values = np.concatenate([np.zeros(0, np.uint64), *sets])
    holder = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count[code] > 1
    code, holder = np.cumsum(count > 1)[code[shared]] - 1, holder[shared]
    order = np.argsort(code, kind="stable")
    code, holder = code[order], holder[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, int(code[-1]) + 1 if len(code) else 0, COLUMNS):
        a, b = np.searchsorted(code, (start, start + COLUMNS))
        has = np.zeros((len(sets), COLUMNS), bool)
        has[holder[a:b], code[a:b] - start] = True
        bits = np.packbits(has, axis=1).view(np.uint64)
        theirs = bits[right]
        for row, own in enumerate(bits[left]):
            out[row] += np.bitwise_count(own & theirs).sum(axis=1, dtype=np.int64)
    return out


def _roots(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Those of ``pairs`` that connect something new."""
    parent, used = list(range(n)), []
    for i, j in pairs.tolist():
        a, b = i, j
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if a != b:
            parent[b] = a
            used.append((i, j))
    return used


def _linked(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of a cell, as few as connect what is similar enough."""

    def run(cell: pa.Table) -> pa.Table:
        ids, labels, own = (cell[c].to_numpy() for c in ("id", "label", "own"))
        x, y = cell["x"][0].as_py(), cell["y"][0].as_py()
        held = [np.frombuffer(s, np.uint64) for s in cell["set"].to_pylist()]
        left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
        n = np.array([len(s) for s in held], float)
        common = common_shingles(held, left, right)
        union = n[left][:, None] + n[right][None, :] - common
        similar = (100 * common >= percent * union) & (labels[left][:, None] != labels[right][None, :])
        i, j = np.nonzero(similar)
        used = _roots(len(ids), np.stack([left[i], right[j]], axis=1))
        a = [min(ids[i], ids[j]) for i, j in used]
        b = [max(ids[i], ids[j]) for i, j in used]
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return cells.join(sets, "id").groupBy(*CELL).applyInArrow(run, "a bigint, b bigint")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and text of the documents with these ids, equal rows once."""
    ids = keep(ids.distinct(), "ids")
    few = ids.count() <= SENT_IDS
    return docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, "doc_id", "left_semi").distinct()


def _confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                passed = []
                for s, t in zip(shingle_sets(batch.column(2), width), shingle_sets(batch.column(3), width)):
                    common = len(np.intersect1d(s, t, assume_unique=True))
                    passed.append(100 * common >= percent * (len(s) + len(t) - common))
                yield batch.filter(pa.array(passed, pa.bool_())).select([0, 1])

    pairs = keep(pairs, "pairs")
    texts = keep(_texts(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))), "texts")
    joined = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("t1")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("t2")), "b"
    )
    return keep(joined.select("a", "b", "t1", "t2").mapInArrow(lean(run), "a bigint, b bigint"), "links")


def _sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """id, set (sorted hashes) of the documents ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                sets = [s.tobytes() for s in shingle_sets(batch.column(1), width)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "set"])

    return _texts(docs, ids.select(F.col("id").alias("doc_id"))).mapInArrow(lean(run), "id bigint, set binary")


def _crossing(
    live: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int
) -> DataFrame:
    """Links between members of one bucket that are in different components."""
    known = live.select("key", "id").join(labels.withColumnRenamed("node", "id"), "id", "left")
    labelled = keep(known.select("key", "id", F.coalesce("component", "id").alias("label")), "labelled")
    spread = labelled.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h"))
    mixed = keep(spread.filter("l <> h").select("key"), "mixed")
    cells = keep(_unchecked(labelled.join(mixed, "key"), classes, percent), "cells")
    sets = keep(_sets(docs, cells, width), "sets")
    return keep(_linked(cells, sets, percent), "crossing")


def near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable) and kept for every row of ``docs``.

    Documents are linked if 100 * |intersection| >= percent * |union| of their shingle sets.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    drawn = keep(sketches(docs, width), "sketches")
    first = drawn.filter("doc_id is not null and signature is not null").groupBy("signature")
    classes = keep(
        first.agg(
            F.min("doc_id").alias("id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("registers").alias("registers"),
        ),
        "classes",
    )
    keys = keep(_keys(classes.filter(linkable(F.col("n_shingles"), percent))), "keys")
    hubs = keep(_hubs(keys), "hubs")
    live = keep(keys.join(hubs, "key"), "live")
    starred = keep(live.filter("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), "starred")
    links = _confirmed(_likely(starred, classes, percent), docs, width, percent)
    labels = components(links)
    more = _crossing(live, labels, classes, docs, width, percent)
    if not more.isEmpty():
        labels = components(links.union(more))
    found = drawn.select("doc_id", "n_shingles", "signature").join(classes.select("signature", "id"), "signature", "left")
    found = found.join(labels.withColumnRenamed("node", "id"), "id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
