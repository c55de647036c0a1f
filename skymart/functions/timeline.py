"""Row-frame windows over time that stay balanced when one key holds most of the rows.

``partitionBy(key)`` puts the whole history of a key into one task. A trailing frame only looks a
few rows back, so a long history can be cut into slices: every slice is computed on its own, after
receiving the last rows of the slices before it.

Slices are cut at row quantiles, wherever in time the rows lie. A sample of the order keys, drawn by
hash, is ranked within each key; every so many sampled rows make a cut. A row finds its slice by
binary search in the cuts of its key. Everything is part of the plan: nothing runs while it is built,
and where no key is long the cuts are empty and adaptive execution drops the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Rows of a slice, about; shorter time lines stay whole. Where cuts are placed never changes results.
SLICE_ROWS = 1_000_000
#: Sampled rows for each slice: sizes vary by an eighth of a slice, seven of them to twice the target.
SAMPLES = 64
#: Bound on the list of cuts, which is sent to all tasks. With more rows than this many slices hold,
#: all slices grow alike; no key is left out.
MAX_CUTS = 100_000
#: Rows with a null key have no time line; they are spread over this many groups.
NULL_GROUPS = 1_024

SLICE = "__slice"
HALO = "__halo"
TIME = "__time"
PLACE = "__place"
CUTS = "__cuts"


def _place(sort_keys: Sequence[str]) -> Column:
    """The row order as one comparable value, nulls last."""
    return F.struct(*[c for name in sort_keys for c in (F.col(name).isNull(), F.col(name))])


def _cuts(df: DataFrame, key: str, sort_keys: Sequence[str], slice_rows: int) -> DataFrame:
    """The cuts of each key that has any, in order. At most ``MAX_CUTS`` altogether."""
    every = max(slice_rows // SAMPLES, 1)
    per_slice = max(slice_rows // every * 3 // 4, 1)
    drawn = F.pmod(F.xxhash64(key, *sort_keys), F.lit(every)) == 0
    sample = df.where(F.col(key).isNotNull() & drawn).select(key, _place(sort_keys).alias(PLACE))
    ranked = sample.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy(PLACE)))
    # The same shuffle of the sample serves the count and the cuts.
    total = ranked.where(F.col("__rank") % per_slice == 0).agg(F.count(F.lit(1)).alias("n")).scalar()
    step = F.greatest(F.ceil(total / F.lit(MAX_CUTS)), F.lit(1)).cast("int") * per_slice
    cuts = ranked.where(F.col("__rank") % step == 0).groupBy(key)
    return cuts.agg(F.sort_array(F.collect_list(PLACE)).alias(CUTS))


def _slice_of(sort_keys: Sequence[str]) -> Column:
    """Number of cuts before the row, by doubling steps back from the largest."""
    place, cuts = _place(sort_keys), F.col(CUTS)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(MAX_CUTS.bit_length()))])

    def step(found: Column, by: Column) -> Column:
        return F.when(F.get(cuts, found + by - 1) < place, found + by).otherwise(found)

    return F.when(cuts.isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), step))


def sliced(
    df: DataFrame, *, key: str, sort_keys: Sequence[str], slice_rows: int = SLICE_ROWS
) -> tuple[DataFrame, DataFrame]:
    """``df`` with the column ``SLICE``, and the list of cuts."""
    cuts = F.broadcast(_cuts(df, key, sort_keys, slice_rows))
    spread = -F.lit(1) - F.pmod(F.xxhash64(*sort_keys), F.lit(NULL_GROUPS)).cast("int")
    number = F.when(F.col(key).isNotNull(), _slice_of(sort_keys)).otherwise(spread)
    return df.join(cuts, key, "left").withColumn(SLICE, number).drop(CUTS), cuts


def with_trailing(
    df: DataFrame,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    *,
    key: str,
    order: str,
    lookback: int,
    inputs: Sequence[str],
    tie: Sequence[str] = (),
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add window columns that look at most ``lookback`` rows back within ``key``.

    ``columns`` maps a name to a function of the ordered window; ``inputs`` are the columns these
    functions read. ``order`` is a timestamp, ``tie`` breaks equal timestamps. Rows with a null
    key get null.
    """
    sort_keys = [TIME, *[name for name in tie if name in df.columns]]
    base = df.drop(*columns).withColumn(TIME, F.unix_micros(F.col(order).cast("timestamp")))
    whole, cuts = sliced(base, key=key, sort_keys=sort_keys, slice_rows=slice_rows)

    # Last rows of every slice of the cut keys, then the last rows before every slice.
    carried = list(dict.fromkeys([*sort_keys, order, *inputs]))
    backwards = Window.partitionBy(key, SLICE).orderBy(*[F.desc_nulls_first(c) for c in sort_keys])
    tails = (
        base.select(key, *carried)
        .join(cuts, key)
        .withColumn(SLICE, _slice_of(sort_keys))
        .drop(CUTS)
        .withColumn("__rank", F.row_number().over(backwards))
        .where(F.col("__rank") <= lookback)
        .groupBy(key, SLICE)
        .agg(F.sort_array(F.collect_list(F.struct(_place(sort_keys), *carried))).alias("__tail"))
    )
    earlier = Window.partitionBy(key).orderBy(SLICE).rowsBetween(-lookback, -1)
    before = F.flatten(F.collect_list("__tail").over(earlier))
    nearest = F.slice(
        "__before", F.greatest(F.size("__before") - F.lit(lookback), F.lit(0)) + F.lit(1), F.lit(lookback)
    )
    halo = (
        tails.select(key, SLICE, before.alias("__before"))
        .select(key, SLICE, F.explode(nearest).alias("__row"))
        .select(key, SLICE, *[F.col(f"__row.{name}").alias(name) for name in carried])
        .withColumn(HALO, F.lit(True))
    )

    window = Window.partitionBy(key, SLICE).orderBy(*[F.asc_nulls_last(c) for c in sort_keys])
    known = F.col(key).isNotNull()
    added = [F.when(known, make(window)).alias(name) for name, make in columns.items()]
    return (
        whole.withColumn(HALO, F.lit(False))
        .unionByName(halo, allowMissingColumns=True)
        .select("*", *added)
        .where(~F.col(HALO))
        .drop(TIME, SLICE, HALO)
    )
