"""Mixing sources to target weights by a low-discrepancy schedule.

Sizes are words. Sources, sorted by code point with null last, have weights that repeat ``WEIGHTS``, and share
the words of all documents. No source gives more than ``EPOCHS`` times its size; what it can't give is
shared anew by weight until no target is above that.

1. The documents of a source are shuffled by a hash of id and text and laid end to end, ``EPOCHS`` times
   over; this stream is cut into blocks of ``BLOCK`` words, however long the documents are.
2. Slot k of the schedule has the van der Corput point of k (its bits reversed behind the binary
   point). The cumulative targets cut [0, 1) into an interval for each source; the point's interval
   names the slot's source. How many earlier points lie in an interval follows from the bits of k, so
   the rank of a slot among those of its source needs no counting and no shuffle.
3. The slot of rank r takes block r of its source. Slots beyond the target stay out; if some blocks
   of a target are left when all slots are dealt (a few for each source, by the discrepancy),
   they follow in turn. The last block is cut at the target, so a source gives exactly its target,
   rounded down.

Prefix sums of sizes come from sums of small hash ranges within a source, so a source with a third of
all rows is summed by many tasks. Only numbers travel; texts stay where they are.

Null texts have no words: they take no part and have a row all the same. Null ids and equal ids are
told apart by their texts; rows that are equal in id, text and source are interchangeable. A null
source is a source. Extra columns are ignored. An empty table gives no rows; without any word all
targets are zero.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skymart.llm.common import keep

WEIGHTS, EPOCHS, BLOCK = (1, 2, 3), 3, 4096
#: Points have this many bits, which is the bound on slots as well.
BITS = 60
#: Interval ends sent to all tasks at once (8 bytes each); with more sources the schedule is dealt in turns.
SENT_SOURCES = 1_000_000
#: Rows of a source that one prefix sum runs over, about.
RANGE_ROWS = 10_000

WORDS = r"[^\x20\x09-\x0D]+"
_WIDE = "decimal(38,0)"


def reversed_bits(k: np.ndarray) -> np.ndarray:
    """The lowest ``BITS`` bits of k in reverse order: the van der Corput point times 2 ** BITS."""
    out = np.zeros(len(k), np.uint64)
    k = k.astype(np.uint64)
    for _ in range(BITS):
        out = out << np.uint64(1) | k & np.uint64(1)
        k = k >> np.uint64(1)
    return out


def points_below(k: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many of the points of 0 .. k - 1 are below x / 2 ** BITS.

    The numbers below k fall into one block of 2 ** e numbers for each bit e of k. The points of a
    block lie 2 ** -e apart, all shifted by the point of the bits above e.
    """
    k, x = k.astype(np.int64), x.astype(np.int64)
    total, shift = np.zeros(len(k), np.int64), np.zeros(len(k), np.int64)
    for e in range(int(k.max(initial=0)).bit_length() - 1, -1, -1):
        has = (k >> e) & 1 == 1
        step = 1 << (BITS - e)
        below = np.clip(-((shift - x) // step), 0, 1 << e)
        total += np.where(has, below, 0)
        shift += np.where(has, 1 << (BITS - 1 - e), 0)
    return total


def _in_order(rows: DataFrame, order: Sequence[Column], name: str) -> tuple[DataFrame, dict[int, int]]:
    """``rows`` sorted and written with their part and place, and the number of rows before each part."""
    placed = rows.orderBy(*order).select(
        "*", F.spark_partition_id().alias("part"), (F.monotonically_increasing_id() % (1 << 33)).alias("place")
    )
    placed = keep(placed, name)
    return placed, _before(placed.groupBy("part").agg(F.count("*").alias("n")))


def _before(sums: DataFrame) -> dict[int, int]:
    """Running total before each part (part, n); there are as many as partitions."""
    total, out = 0, {}
    for part, n in sorted((r["part"], int(r["n"])) for r in sums.collect()):
        out[part] = total
        total += n
    return out


def _looked_up(known: dict[int, int]) -> Column:
    pairs = [F.lit(v) for part, n in known.items() for v in (part, n)]
    return F.create_map(*pairs)[F.col("part")].cast("bigint") if pairs else F.lit(0).cast("bigint")


def targets(sizes: DataFrame, *, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """source, number (place among sources), weight, source_size, target, take (the target rounded down).

    ``sizes`` has a source and its source_size per row.
    """
    order = [F.col("source").isNull(), F.col("source").cast("binary")]
    placed, before = _in_order(sizes, order, "mix-sources")
    number = _looked_up(before) + F.col("place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (number % len(weights) + 1).cast("int")).cast("bigint")
    rows = keep(placed.select("source", "source_size", "part", number.alias("number"), weight.alias("weight")), "mix-weights")
    total = int(rows.agg(F.sum(F.col("source_size").cast(_WIDE))).first()[0] or 0)
    share, parts, bound = 0, 0, F.lit(False)
    while True:  # each turn binds a source or ends; a handful of turns in practice
        free = rows.filter(~bound).agg(F.sum(F.col("weight").cast(_WIDE))).first()[0]
        held = rows.filter(bound).agg(F.sum(F.col("source_size").cast(_WIDE))).first()[0]
        now = total - epochs * int(held or 0), int(free or 0)
        if now == (share, parts) or not free:
            break
        share, parts = now
        bound = F.expr(f"cast(weight as decimal(10,0)) * {share}BD > {epochs * parts}BD * cast(source_size as decimal(20,0))")
    part = f"cast(weight as decimal(10,0)) * {share}BD"
    by_weight = F.expr(f"cast({part} as double)") / F.lit(float(parts or 1))
    floor = F.expr(f"({part}) div {parts or 1}BD")
    most = epochs * F.col("source_size")
    return rows.select(
        "source",
        "number",
        "part",
        "weight",
        "source_size",
        F.when(bound, most.cast("double")).otherwise(by_weight).alias("target"),
        F.when(bound, most).otherwise(floor).alias("take"),
    )


def laid_out(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, size, source, start: words of their source before them) and source sizes."""
    shuffled = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.md5(F.coalesce("text", F.lit("")))))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("bigint").alias("size"),
        shuffled.alias("at"),
    )
    rows = keep(rows, "mix-sizes")
    sources = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    sources = keep(sources, "mix-source-sizes")
    # A source of n rows has about n / RANGE_ROWS ranges of the first 32 bits of the shuffling hash.
    ranges = sources.select(F.col("source").alias("s"), F.ceil(F.col("n") / RANGE_ROWS).alias("ranges"))
    head = F.conv(F.substring("at", 1, 8), 16, 10).cast("bigint")
    ranged = rows.join(ranges, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "at", F.shiftright(head * F.col("ranges"), 32).alias("range")
    )
    sums = keep(ranged.groupBy("source", "range").agg(F.sum("size").alias("sum")), "mix-ranges")
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("source", "range").orderBy("at", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    inner = ranged.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))
    placed = inner.join(bases, same).select("doc_id", "source", "size", "at", (F.col("base") + F.col("inner")).alias("start"))
    return placed, sources.select("source", "source_size")


def schedule(shares: DataFrame, *, block: int = BLOCK, sent_sources: int = SENT_SOURCES) -> DataFrame:
    """slot, number (of the source), rank: which block of which source each slot takes.

    ``shares`` has number, part and take per source.
    """
    spark = shares.sparkSession
    total = int(shares.agg(F.sum(F.col("take").cast(_WIDE))).first()[0] or 0)
    count = -(-total // block)
    before = _before(shares.groupBy("part").agg(F.sum("take").alias("n")))
    order = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    # Ends of the intervals: reach / total in BITS bits, in two steps that fit 38 digits.
    reach = shares.select("number", "take", (F.sum("take").over(order) + _looked_up(before)).alias("reach"))
    half, whole = f"{1 << (BITS // 2)}BD", f"{max(total, 1)}BD"
    scaled = f"cast(reach as decimal(20,0)) * {half}"
    halves = reach.withColumn("high", F.expr(f"({scaled}) div {whole}"))
    low = F.expr(f"(({scaled} - cast(high as decimal(12,0)) * {whole}) * {half}) div {whole}")
    ends = keep(
        halves.select(
            "number",
            (F.col("high") * (1 << (BITS // 2)) + low).alias("high"),
            F.expr(f"(take + {block - 1}) div {block}").alias("wanted"),
        ),
        "mix-ends",
    )
    n_sources = ends.count()
    slots, first, low_end = None, 0, 0
    while first < n_sources:
        own = ends.filter(F.col("number").between(first, first + sent_sources - 1))
        rows = own.select("number", "high", "wanted").toPandas().sort_values("number")
        bounds = np.append(low_end, rows["high"].to_numpy())
        turn = _turn(spark, count, bounds, rows["wanted"].to_numpy(), first)
        slots = turn if slots is None else slots.union(turn)
        low_end, first = int(bounds[-1]), first + sent_sources
    empty = spark.createDataFrame([], "slot bigint, number bigint, rank bigint")
    return empty if slots is None else slots.union(_left_over(ends, count, n_sources))


def _turn(spark: SparkSession, count: int, bounds: np.ndarray, wanted: np.ndarray, first: int) -> DataFrame:
    """Slots of the sources whose intervals ``bounds`` cut."""
    sent = spark.sparkContext.broadcast((bounds, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, blocks = sent.value
        for batch in batches:
            k = batch.column(0).to_numpy()
            point = reversed_bits(k).astype(np.int64)
            own = np.searchsorted(ends, point, "right") - 1
            some = np.flatnonzero((own >= 0) & (own < len(blocks)))
            k, own = k[some], own[some]
            rank = points_below(k, ends[own + 1]) - points_below(k, ends[own])
            some = rank < blocks[own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(k[some]), pa.array(own[some] + first), pa.array(rank[some])], names=["slot", "number", "rank"]
            )

    return spark.range(count).mapInArrow(run, "slot bigint, number bigint, rank bigint")


def _left_over(ends: DataFrame, count: int, n_sources: int) -> DataFrame:
    """Blocks that no point of the schedule reached, source after source in turn, behind its last slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, low, high, wanted = (c.to_numpy() for c in batch.columns)
            k = np.full(len(number), count)
            dealt = points_below(k, high) - points_below(k, low)
            more = np.maximum(wanted - dealt, 0)
            which = np.repeat(np.arange(len(number)), more)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(more) - more, more)
            slot = count + nth * n_sources + number[which]
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(number[which]), pa.array(dealt[which] + nth)], names=["slot", "number", "rank"]
            )

    # An interval begins where the one of the source before ends.
    own = ends.select("number", "high", "wanted")
    before = ends.select((F.col("number") + 1).alias("number"), F.col("high").alias("low"))
    joined = own.join(before, "number", "left").select("number", F.coalesce("low", F.lit(0)).alias("low"), "high", "wanted")
    return joined.mapInArrow(run, "slot bigint, number bigint, rank bigint")


def mix(
    docs: DataFrame, *, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """The mix as pieces, and the documents with their targets.

    Pieces: slot, offset (words of the slot before it), number (of the source), at, start (together
    they name a document of the source), doc_id, from_word, n_words. Read by slot and offset they are the mix.
    Documents: doc_id, size, source, source_size, number, at, start, target.
    """
    rows, sizes = laid_out(docs)
    shares = keep(targets(sizes, weights=weights, epochs=epochs), "mix-targets")
    slots = schedule(shares, block=block)
    known = shares.select(F.col("source").alias("s"), "number", "source_size", "target", "take")
    placed = keep(
        rows.join(known, F.col("source").eqNullSafe(F.col("s"))).select(
            "doc_id", "size", "source", "source_size", "number", "at", "start", "target", "take"
        ),
        "mix-documents",
    )
    # Every time round, a document lies in a row of blocks of its source's stream.
    turns = placed.filter("size > 0").select(
        "doc_id", "size", "number", "at", "start", "take", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"), "source_size"
    )
    begin = F.col("start") + F.col("epoch") * F.col("source_size")
    turns = turns.withColumn("begin", begin).withColumn("end", F.least(begin + F.col("size"), F.col("take")))
    blocks = turns.filter("begin < end").select(
        "*", F.explode(F.sequence(F.expr(f"begin div {block}"), F.expr(f"(end - 1) div {block}"))).alias("rank")
    )
    low = F.greatest("begin", F.col("rank") * block)
    high = F.least("end", (F.col("rank") + 1) * block)
    pieces = blocks.join(slots, ["number", "rank"]).select(
        "slot",
        (low - F.col("rank") * block).alias("offset"),
        "number",
        "at",
        "start",
        "doc_id",
        (low - F.col("begin")).alias("from_word"),
        (high - low).alias("n_words"),
    )
    return pieces, placed.drop("take")


def taken(pieces: DataFrame, documents: DataFrame) -> DataFrame:
    """doc_id, size, source, source_size, target and taken (words of the mix) of every document."""
    # A document with words is the only one at its place in the source.
    sums = pieces.groupBy("number", "start").agg(F.sum("n_words").alias("words"))
    found = documents.join(
        sums.select(F.col("number").alias("n"), F.col("start").alias("s"), "words"),
        (F.col("size") > 0) & (F.col("number") == F.col("n")) & (F.col("start") == F.col("s")),
        "left",
    )
    return found.select(
        "doc_id", "size", "source", "source_size", "target", F.coalesce("words", F.lit(0)).cast("bigint").alias("taken")
    )
