"""Phrases of two to five words that occur far more often together than their parts suggest.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces into words at
spaces and tabs. Everything is counted per language; a null language is ``und``.

1. Every occurrence of one to five words has a 48-bit key, and the key's leading part names one of
   the hash partitions. A first pass adds up the mass (occurrences) of each partition.
2. Misra-Gries summaries: a task sorts some millions of keys at a time and counts them. These are
   summaries from which nothing had to be taken off: capacity grows with the mass of all data and a
   block of keys does not, so reducing them would save bytes on small inputs only. Summaries of one
   partition are merged: counts of equal keys are added, and whenever more than ``capacity`` counters
   are there, the (capacity + 1)st largest count is taken off all. Capacity exceeds mass divided by
   threshold, so what is taken off a counter in total stays below the threshold, and every phrase
   that reaches the threshold keeps one. Counters that can't reach it with what was taken off go.
3. The second pass counts exactly. A bitmap of a size fixed beforehand keeps most other phrases out
   of the shuffle (it lets some pass, and never loses one); phrases are then counted as such, so
   neither equal keys nor the bitmap change a result. Phrases below the threshold go.
4. A candidate is cut behind its first, second, ... word; the parts' counts are looked up among the
   phrases. The cut of the lowest score counts, and of equal ones the first. Scores are whole
   numbers from exact decimals.
5. A candidate goes if a longer one that holds it has ``covered`` per cent of its count. Counts never
   grow with length, so it is enough to look at those longer by one word.

A hash partition is read as a stream of short lists of counters; what a task holds is bounded by the
capacity. Hot phrases arrive as one counter per block.

Null texts are empty, without words. Repeated rows, null ids and equal ids are documents like any
other. A very long text is cut behind white space; phrases across a cut are counted once. Ties go to
the higher count, then to the smaller phrase by UTF-8 bytes. Extra columns are ignored, empty tables
and languages without frequent phrases give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skymart.llm import words
from skymart.llm.common import keep, text_buffer

LONGEST, THRESHOLD, COVERED, TOP = 5, 100, 100, 2000
#: Bytes of text for each hash partition, and the least number of them per shuffle partition.
PARTITION_BYTES, LEAST_PARTITIONS = 256 << 20, 4
#: Keys sorted at a time, and counters sent in one row.
BLOCK_KEYS, ROW_KEYS = 4 << 20, 1024
#: Bytes of text taken at a time by the two passes.
SLICE_BYTES, COUNTED_BYTES = 1 << 20, 6 << 20
KEY_BITS = 48
#: The bitmap has about 32 bits for each key, and no more than 2 ** 28 (32 MB) for any number of them.
BITMAP_BITS = (20, 28)

_SPACE, _BREAK = 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 32]] = _SPACE
_CLASS[[*b".,;:!?", 10, 11, 12, 13]] = _BREAK
_ODD = np.uint64(0x9FB21C651E98DF25)
_SUMMARY = pa.schema(
    [("partition", pa.int64()), ("n", pa.int64()), ("first", pa.int64()), ("steps", pa.binary()), ("counts", pa.binary())]
)


@dataclass
class Part:
    """Words of a slice of lower-cased bytes. The first ``old`` words were in the slice before."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    opens: np.ndarray
    old: int


def _cuts(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int, int, int]]:
    """begin, end, first row, last row + 1; a long row is cut behind separators."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1, row + 1)
        at, end = int(offsets[row]), int(offsets[stop])
        while at < end:
            cut = end if end - at <= 2 * limit else at + limit
            while cut < end:
                found = np.flatnonzero(_CLASS[data[cut : cut + limit]])
                if found.size:
                    cut += int(found[0]) + 1
                    break
                cut = min(cut + limit, end)
            yield at, cut, row, stop
            at = cut
        row = stop


def parts(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[Part]:
    before: list[int] = []
    seen = -1
    for begin, end, first, last in _cuts(data, offsets, limit):
        if seen != first or last != first + 1:
            before = []
        seen = first
        at = before[0] if before else begin
        low = words.LOWERED[data[at:end]]
        kind = _CLASS[low]
        inside = kind == 0
        edges = offsets[first + 1 : last] - at
        is_start = inside.copy()
        is_start[1:] &= ~inside[:-1]
        is_start[edges[edges < len(low)]] = inside[edges[edges < len(low)]]
        is_end = inside.copy()
        is_end[:-1] &= ~inside[1:]
        is_end[edges[edges > 0] - 1] = inside[edges[edges > 0] - 1]
        starts, ends = np.flatnonzero(is_start), np.flatnonzero(is_end) + 1
        rows = np.searchsorted(edges, starts, "right") + first
        breaks = np.zeros(len(low) + 1, np.int64)
        np.cumsum(kind == _BREAK, out=breaks[1:])
        opens = np.ones(len(starts), bool)
        opens[1:] = (breaks[starts[1:]] > breaks[ends[:-1]]) | (rows[1:] != rows[:-1])
        yield Part(low, starts, ends, rows, opens, len(before))
        before = (starts[-(LONGEST - 1) :] + at).tolist()


def phrases(part: Part, seeds: np.ndarray, base: int = words.BASES[0]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, the first words of all new phrases, and their hashes."""
    h = words.span_hashes(part.data, part.starts, part.ends, base)
    whole, valid = h ^ seeds[part.rows], np.ones(len(h), bool)
    with np.errstate(over="ignore"):
        for n in range(1, LONGEST + 1):
            if n > 1:
                whole = words.mix(whole[:-1] * _ODD + h[n - 1 :])
                valid = valid[:-1] & ~part.opens[n - 1 :]
            if len(whole) == 0:
                return
            new = valid.copy()
            new[: max(part.old - n + 1, 0)] = False
            at = np.flatnonzero(new)
            yield at, words.mix(whole[at] + np.uint64(n))


def _seeds(langs: list[str], base: int) -> np.ndarray:
    raw = [lang.encode() for lang in langs]
    ends = np.cumsum([len(r) for r in raw])
    sizes = np.array([len(r) for r in raw], np.int64)
    return words.span_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - sizes, ends, base)


def _keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """48-bit keys of all phrases of a batch (lang, text)."""
    langs = batch.column(0).dictionary_encode()
    if not batch.num_rows:
        return
    seeds = _seeds(langs.dictionary.to_pylist(), words.BASES[0])[langs.indices.to_numpy()]
    for part in parts(*text_buffer(batch.column(1))):
        for _, hashes in phrases(part, seeds):
            yield hashes >> np.uint64(64 - KEY_BITS)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    """Keys of all batches, ``size`` at a time, in one array that is used again."""
    held, n = np.empty(size, np.uint64), 0
    for batch in batches:
        for keys in _keys(batch):
            while len(keys):
                some = keys[: size - n]
                held[n : n + len(some)] = some
                n, keys = n + len(some), keys[len(some) :]
                if n == size:
                    yield held
                    n = 0
    if n:
        yield held[:n]


def partition_of(keys: np.ndarray, partitions: int) -> np.ndarray:
    """Hash partitions are equal ranges of keys, so sorted keys lie partition by partition."""
    return ((keys >> np.uint64(16)) * np.uint64(partitions) >> np.uint64(KEY_BITS - 16)).astype(np.int64)


def _first_keys(partitions: int) -> np.ndarray:
    """Smallest key of each partition, and one beyond all."""
    heads = [-(-(p << (KEY_BITS - 16)) // partitions) << 16 for p in range(partitions)]
    return np.array([*heads, 1 << KEY_BITS], np.uint64)


def distinct(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their counts added up."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def reduced(keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``capacity`` counters at most, and what was taken off each."""
    if len(keys) <= capacity:
        return keys, counts, 0
    off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    left = counts > off
    return keys[left], counts[left] - off, off


def _packed(values: np.ndarray) -> bytes:
    """As many bytes for each value as the largest needs, bytes of equal weight side by side."""
    width = max((int(values.max()).bit_length() + 7) // 8, 1)
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpacked(raw: memoryview, n: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(-1, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.reshape(-1).view("<u8")


def masses(texts: DataFrame, partitions: int) -> DataFrame:
    """partition, mass: how many phrases of one to five words each hash partition has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(partitions, np.int64)
        for batch in batches:
            for keys in _keys(batch):
                total += np.bincount(partition_of(keys, partitions), minlength=partitions)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["partition", "mass"])

    found = texts.mapInArrow(run, "partition bigint, mass bigint")
    return found.groupBy("partition").agg(F.sum("mass").alias("mass"))


def _summaries(texts: DataFrame, partitions: int, block_keys: int) -> DataFrame:
    """partition, n, steps between sorted keys, counts: the counters of a block, some at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _first_keys(partitions)
        for keys in _blocks(batches, block_keys):
            keys.sort()
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            counts = np.diff(first, append=len(keys))
            keys = keys[first]
            bounds = np.searchsorted(keys, edges).tolist()
            rows = []
            for p, (a, b) in enumerate(zip(bounds, bounds[1:])):
                for at in range(a, b, ROW_KEYS):
                    stop = min(at + ROW_KEYS, b)
                    steps = np.diff(keys[at:stop])
                    packed = _packed(steps) if stop > at + 1 else b""
                    rows.append((p, stop - at, int(keys[at]), packed, _packed(counts[at:stop])))
                    if len(rows) == 1000 or stop == bounds[-1]:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows), _SUMMARY)], schema=_SUMMARY
                        )
                        rows = []

    return texts.mapInArrow(run, "partition bigint, n bigint, first bigint, steps binary, counts binary")


class _Summary:
    """The merged counters of one hash partition."""

    def __init__(self, capacity: int):
        self.capacity, self.off, self.waiting = capacity, 0, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.more: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.more.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > max(len(self.keys), 1 << 18):
            self.merge()

    def merge(self) -> None:
        keys, counts = distinct(
            np.concatenate([self.keys, *(m[0] for m in self.more)]),
            np.concatenate([self.counts, *(m[1] for m in self.more)]),
        )
        self.keys, self.counts, off = reduced(keys, counts, self.capacity)
        self.off += off
        self.more, self.waiting = [], 0

    def survivors(self, threshold: int) -> np.ndarray:
        self.merge()
        return self.keys[self.counts + self.off >= threshold]


def _survivors(summaries: DataFrame, capacity: dict[int, int], threshold: int) -> DataFrame:
    """Keys whose phrases may reach the threshold."""
    sent = summaries.sparkSession.sparkContext.broadcast(capacity)

    def batch_of(summary: _Summary) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(summary.survivors(threshold).view(np.int64))], names=["key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, summary = None, None
        for batch in batches:
            partition, n, first = (batch.column(i).to_numpy() for i in range(3))
            for row in range(batch.num_rows):
                if partition[row] != here:
                    if summary:
                        yield batch_of(summary)
                    here = partition[row]
                    summary = _Summary(sent.value[int(here)])
                keys = np.full(n[row], first[row], np.uint64)
                if n[row] > 1:
                    keys[1:] += np.cumsum(_unpacked(batch.column(3)[row].as_buffer(), int(n[row]) - 1), dtype=np.uint64)
                summary.add(keys, _unpacked(batch.column(4)[row].as_buffer(), int(n[row])).astype(np.int64))
        if summary:
            yield batch_of(summary)

    return summaries.repartition("partition").sortWithinPartitions("partition").mapInArrow(run, "key bigint")


def _bitmap(keys: DataFrame) -> tuple[np.ndarray, int]:
    """Bits of the leading parts of all keys, and how many bits a leading part has."""
    low, high = BITMAP_BITS
    bits = min(max((keys.count() * 16).bit_length(), low), high)
    place = F.shiftright(F.col("key"), KEY_BITS - bits) + 1  # buckets of 32768 are counted from 1 on
    built = keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap")
    )
    out = np.zeros((1 << bits) >> 3, np.uint8)
    for row in built.toLocalIterator():  # 2 ** 28 bits at most, 4096 bytes a row
        at = (row["bucket"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(row["bitmap"], np.uint8)
    return out, bits


class _Hits:
    """Occurrences of phrases let through, of a few slices of text."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.columns: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(6)]
        self.pieces: list[np.ndarray] = []
        self.base = 0

    def add(self, part: Part, seeds: list[np.ndarray], row_lang: np.ndarray, bitmap: np.ndarray, bits: int) -> None:
        both = zip(phrases(part, seeds[0]), phrases(part, seeds[1], words.BASES[1]))
        for n, ((at, one), (_, two)) in enumerate(both, 1):
            place = (one >> np.uint64(64 - bits)).astype(np.int64)
            hit = np.flatnonzero(bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1)
            at = at[hit]
            found = (
                one[hit].view(np.int64),
                two[hit].view(np.int64),
                part.starts[at] + self.base,
                part.ends[at + n - 1] + self.base,
                row_lang[part.rows[at]],
                np.full(len(at), n),
            )
            for column, values in zip(self.columns, found):
                column.append(values)
        self.pieces.append(part.data)
        self.base += len(part.data)

    def batch(self, names: list[str], total: np.ndarray) -> pa.RecordBatch:
        """lang, phrase, size, f of what was added, and ``total`` as the empty phrases."""
        one, two, starts, ends, lang, size = (np.concatenate(c) for c in self.columns)
        order = np.argsort(one)
        if ((one[order[1:]] == one[order[:-1]]) & (two[order[1:]] != two[order[:-1]])).any():
            order = np.lexsort((two, one))
        new = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
        first = np.flatnonzero(np.append(True, new)) if len(order) else np.zeros(0, np.int64)
        counts = np.diff(np.append(first, len(order)))
        raw, first = np.concatenate([np.zeros(0, np.uint8), *self.pieces]).tobytes(), order[first]
        spans = zip(starts[first].tolist(), ends[first].tolist())
        found = [b" ".join(raw[a:b].split()).decode() for a, b in spans]
        known = np.flatnonzero(total)
        columns = (
            pa.array([*(names[i] for i in lang[first].tolist()), *(names[i] for i in known.tolist())], pa.string()),
            pa.array([*found, *[""] * len(known)], pa.string()),
            pa.array(np.append(size[first], np.zeros(len(known), np.int64)).astype(np.int32)),
            pa.array(np.append(counts, total[known])),
        )
        self.clear()
        return pa.RecordBatch.from_arrays(list(columns), names=["lang", "phrase", "size", "f"])


def counted(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """lang, phrase, size, f of all phrases with one of ``keys`` (and a few others), exactly.

    The empty phrase, of size 0, has the number of all words.
    """
    bitmap, bits = _bitmap(keys)
    sent = texts.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = _Hits()
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            names, row_lang = langs.dictionary.to_pylist(), langs.indices.to_numpy().astype(np.int64)
            seeds = [_seeds(names, base)[row_lang] if names else None for base in words.BASES]
            total = np.zeros(len(names), np.int64)
            for part in parts(*text_buffer(batch.column(1))):
                total += np.bincount(row_lang[part.rows[part.old :]], minlength=len(names))
                hits.add(part, seeds, row_lang, sent.value, bits)
                if hits.base >= COUNTED_BYTES:
                    yield hits.batch(names, total)
                    total[:] = 0
            yield hits.batch(names, total)

    found = texts.mapInArrow(run, "lang string, phrase string, size int, f bigint")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))


def frequent(
    docs: DataFrame, *, threshold: int = THRESHOLD, partitions: int | None = None, block_keys: int = BLOCK_KEYS
) -> DataFrame:
    """lang, phrase, size, f of all phrases of one to five words that occur ``threshold`` times or more.

    The number of all words of a language is there as the empty phrase, whatever it is.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")
    ).filter("text <> ''")
    if partitions is None:
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        least = LEAST_PARTITIONS * int(spark.conf.get("spark.sql.shuffle.partitions"))
        partitions = max(least, -(-size // PARTITION_BYTES))
    rows = masses(texts, partitions).collect()  # one row per hash partition
    capacity = {r["partition"]: r["mass"] // threshold + 1 for r in rows}
    keys = keep(_survivors(_summaries(texts, partitions, block_keys), capacity, threshold), "phrase-keys")
    return keep(counted(texts, keys).filter((F.col("f") >= threshold) | (F.col("size") == 0)), "phrases")


def scored(found: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, n, score of every phrase of two words or more."""
    n = found.filter("size = 0").select("lang", F.col("f").alias("n"))
    f = found.filter("size > 0")
    cuts = f.filter("size > 1").select(
        "lang",
        "phrase",
        "size",
        F.col("f").alias("a"),
        F.split("phrase", " ", -1).alias("w"),
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
    )
    sides = cuts.select(
        "lang",
        "phrase",
        "size",
        "a",
        "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    left = f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    whole = "decimal(20,0)"
    score = F.expr(f"(1000BD * cast(a as {whole}) * cast(n as {whole})) div (cast(l as {whole}) * cast(r as {whole}))")
    joined = sides.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(n, "lang")
    least = joined.withColumn("score", score).groupBy("lang", "phrase", "size", "a", "n")
    best = least.agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "size", "a", "best.l", "best.r", "n", "best.score")


def uncovered(found: DataFrame, covered: int) -> DataFrame:
    """lang, phrase of two words or more that no longer candidate covers."""
    f = found.filter("size > 1")
    w = F.split("phrase", " ", -1)
    inner = F.array(
        F.array_join(F.slice(w, F.lit(1), F.col("size") - 1), " "),
        F.array_join(F.slice(w, F.lit(2), F.col("size") - 1), " "),
    )
    held = f.filter("size > 2").select("lang", F.explode(inner).alias("phrase"), "f")
    most = held.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    joined = f.join(most, ["lang", "phrase"], "left")
    return joined.filter(F.expr(f"most is null or 100BD * most < {int(covered)}BD * f")).select("lang", "phrase")


def collocations(
    docs: DataFrame, *, threshold: int = THRESHOLD, covered: int = COVERED, top: int = TOP, **how: int
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language by score."""
    found = frequent(docs, threshold=threshold, **how)
    rows = scored(found).join(uncovered(found, covered), ["lang", "phrase"], "left_semi")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
