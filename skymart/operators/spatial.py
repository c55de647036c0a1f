"""Spatial operators on features, points and stations."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymart.functions import geometry as geo
from skymart.session import materialize, shared_dir

EXACT_DISTANCE = 1e-4  # fixed value: closer stations give their own value


# -- X1, X2 --------------------------------------------------------------------------------------


def bbox(features: DataFrame) -> DataFrame:
    """One row with the extremes over all vertices; vertices are reduced within their row."""
    points = geo.vertices(F.col("polygons"))
    lons, lats = geo.axis(points, 0), geo.axis(points, 1)
    return features.agg(
        F.min(F.array_min(lons)).alias("min_lon"),
        F.max(F.array_max(lons)).alias("max_lon"),
        F.min(F.array_min(lats)).alias("min_lat"),
        F.max(F.array_max(lats)).alias("max_lat"),
    )


def expand_bbox(box: DataFrame, fraction: float) -> DataFrame:
    """The box widened on every side by a fraction of its size."""
    lon_pad = (F.col("max_lon") - F.col("min_lon")) * F.lit(fraction)
    lat_pad = (F.col("max_lat") - F.col("min_lat")) * F.lit(fraction)
    return box.select(
        (F.col("min_lon") - lon_pad).alias("min_lon"),
        (F.col("max_lon") + lon_pad).alias("max_lon"),
        (F.col("min_lat") - lat_pad).alias("min_lat"),
        (F.col("max_lat") + lat_pad).alias("max_lat"),
    )


def centroid(features: DataFrame) -> DataFrame:
    """Mean of all vertices per feature, without a shuffle."""
    points = geo.vertices(F.col("polygons"))
    return features.select(
        *[c for c in features.columns if c != "polygons"],
        geo.mean_of(geo.axis(points, 0)).alias("lon"),
        geo.mean_of(geo.axis(points, 1)).alias("lat"),
    )


def projected_centroid(
    features: DataFrame, box: DataFrame, width: float, height: float
) -> DataFrame:
    """X2 on the canvas: mean of the projected vertices."""
    points = geo.vertices(F.col("polygons"))
    corners = geo.Box.columns()

    def on_canvas(index: int) -> Column:
        return F.transform(
            points, lambda p: geo.project(F.get(p, 0), F.get(p, 1), corners, width, height)[index]
        )

    return features.join(F.broadcast(box)).select(  # one row
        *[c for c in features.columns if c != "polygons"],
        geo.mean_of(on_canvas(0)).alias("x"),
        geo.mean_of(on_canvas(1)).alias("y"),
    )


# -- X3 ------------------------------------------------------------------------------------------


def mercator_project(points: DataFrame, box: DataFrame, width: float, height: float) -> DataFrame:
    """Add ``x`` and ``y`` to points with ``lon`` and ``lat``."""
    x, y = geo.project(F.col("lon"), F.col("lat"), geo.Box.columns(), width, height)
    joined = points.join(F.broadcast(box))  # one row
    return joined.select(*points.columns, x.alias("x"), y.alias("y"))


def mercator_unproject(points: DataFrame, box: DataFrame, width: float, height: float) -> DataFrame:
    """X3 inverse: add ``lon`` and ``lat`` to points with ``x`` and ``y``."""
    lon, lat = geo.unproject(F.col("x"), F.col("y"), geo.Box.columns(), width, height)
    joined = points.join(F.broadcast(box))  # one row
    return joined.select(*points.columns, lon.alias("lon"), lat.alias("lat"))


# -- X4 ------------------------------------------------------------------------------------------

#: Columns of a polygon's grid, about, and the least number of its bands.
COLUMNS, LEAST_BANDS = 8, 8
#: Edges aimed at in a band, and how many rows its bands may make of an edge on average.
BAND_EDGES, ROWS_PER_EDGE = 16, 4
#: Part of a cell by which an edge counts as reaching into the next one, so that rounding can't matter.
MARGIN = 1e-9
CELL_KEYS = ["__lx", "__ly", "__cx", "__cy"]


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("bigint")


def _edges(features: DataFrame) -> DataFrame:
    """One row per edge of every outline, with the point before it and the polygon's grid.

    Cells are 2 ** level wide and high. Bands grow with the number of edges, unless long edges would
    then fall into too many of them.
    """
    rings = features.select(F.explode("polygons").alias("polygon")).select(
        F.monotonically_increasing_id().alias("__polygon"), F.get("polygon", F.lit(0)).alias("__ring")
    )
    x, y = geo.axis(F.col("__ring"), 0), geo.axis(F.col("__ring"), 1)
    n = F.size("__ring")
    before = F.concat(F.slice("__ring", -1, 1), F.slice("__ring", F.lit(1), n - 1))
    sized = rings.where(n > 0).select(
        "__polygon",
        "__ring",
        before.alias("__before"),
        n.alias("__n"),
        (F.array_max(x) - F.array_min(x)).alias("__wide"),
        (F.array_max(y) - F.array_min(y)).alias("__high"),
    )
    rise = F.zip_with("__ring", "__before", lambda a, b: F.abs(F.get(a, 1) - F.get(b, 1)))
    rise = F.greatest(F.aggregate(rise, F.lit(0.0), lambda total, v: total + v), F.lit(1e-9))
    high = F.greatest("__high", F.lit(1e-9))
    bands = F.greatest(F.col("__n") / BAND_EDGES, F.lit(float(LEAST_BANDS)))
    bands = F.greatest(F.least(bands, ROWS_PER_EDGE * F.col("__n") * high / rise), F.lit(1.0))
    leveled = sized.withColumns(
        {
            "__lx": F.ceil(F.log2(F.greatest("__wide", F.lit(1e-9)) / COLUMNS)).cast("int"),
            "__ly": F.ceil(F.log2(high / bands)).cast("int"),
        }
    )
    point = lambda c, i: F.get(F.get(F.col(c), F.col("__i")), i)
    earlier = F.pmod(F.col("__i") - 1, F.col("__n"))
    numbered = leveled.withColumn("__i", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    return numbered.select(
        "__polygon",
        "__lx",
        "__ly",
        point("__ring", 0).alias("x1"),
        point("__ring", 1).alias("y1"),
        point("__before", 0).alias("x0"),
        point("__before", 1).alias("y0"),
        F.get(F.get("__before", earlier), 0).alias("xp"),
        F.get(F.get("__before", earlier), 1).alias("yp"),
    )


def _columns_of(xa: Column, ya: Column, xb: Column, yb: Column) -> tuple[Column, Column]:
    """First and last column that an edge may touch inside its row's band."""
    height, width = F.pow(F.lit(2.0), "__ly"), F.pow(F.lit(2.0), "__lx")
    low, high = F.col("__cy") * height, (F.col("__cy") + 1) * height
    at = lambda y: xa + (xb - xa) * (y - ya) / F.nullif(yb - ya, F.lit(0.0))
    ends = (
        F.coalesce(at(F.greatest(low, F.least(ya, yb))), xa),
        F.coalesce(at(F.least(high, F.greatest(ya, yb))), xb),
    )
    pad = width * MARGIN + 1e-11
    return (
        F.floor((F.least(*ends) - pad) / width).cast("bigint"),
        F.floor((F.greatest(*ends) + pad) / width).cast("bigint"),
    )


def polygon_cells(features: DataFrame) -> DataFrame:
    """Grid cells of all outlines that are inside or cut; those outside have no row.

    The cells of a polygon lie in bands of latitude and in columns. A cell holds the edges that may
    touch its column inside its band (none: the cell is inside). Of the edges east of it only the
    parity counts: ``odd`` tells it at the cell's lower border, and each latitude of ``turns`` changes it,
    where the outline enters or leaves the columns further east. So an edge lies in the cells it
    touches, and no outline is copied.
    """
    height = F.pow(F.lit(2.0), "__ly")
    edges = _edges(features)
    banded = edges.withColumn(
        "__cy",
        F.explode(
            F.sequence(
                _cell(F.least("y0", "y1"), F.col("__ly")), _cell(F.greatest("y0", "y1"), F.col("__ly"))
            )
        ),
    )
    first, last = _columns_of(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    before, _ = _columns_of(F.col("xp"), F.col("yp"), F.col("x0"), F.col("y0"))
    low, high = F.col("__cy") * height, (F.col("__cy") + 1) * height
    edge = F.struct(
        "x0",
        "y0",
        "x1",
        "y1",
        first.alias("first"),
        last.alias("last"),
        ((F.col("y1") > low) != (F.col("y0") > low)).alias("spans"),
        F.when((F.col("y0") > low) & (F.col("y0") < high), before).alias("before"),
    )
    bands = banded.groupBy("__polygon", "__lx", "__ly", "__cy").agg(F.collect_list(edge).alias("__edges"))
    columns = F.sequence(F.array_min("__edges.first"), F.array_max("__edges.last"))
    cells = bands.withColumn("__cx", F.explode(columns))
    cx = F.col("__cx")
    east = F.filter("__edges", lambda e: (e["first"] > cx) & e["spans"])
    local = F.filter("__edges", lambda e: (e["first"] <= cx) & (e["last"] >= cx))
    turns = F.filter(
        "__edges", lambda e: e["before"].isNotNull() & ((e["first"] > cx) != (e["before"] > cx))
    )
    found = cells.select(
        *CELL_KEYS,
        (F.size(east) % 2 == 1).alias("__odd"),
        F.transform(turns, lambda e: e["y0"]).alias("__turns"),
        F.transform(local, lambda e: F.struct(e["x0"], e["y0"], e["x1"], e["y1"])).alias("__local"),
    )
    return found.where(F.col("__odd") | (F.size("__turns") > 0) | (F.size("__local") > 0))


def _inside(lon: Column, lat: Column) -> Column:
    """Even-odd rule from a cell: its own edges, and the parity of those further east."""
    crossed = F.filter(
        "__local",
        lambda e: geo.crosses(lon, lat, e["x1"], e["y1"], e["x0"], e["y0"]),
    )
    turned = F.filter("__turns", lambda y: y <= lat)
    return (F.size(crossed) + F.size(turned) + F.col("__odd").cast("int")) % 2 == 1


def points_in_polygons(
    points: DataFrame, features: DataFrame, *, lon: str = "lon", lat: str = "lat", key: str
) -> DataFrame:
    """The points inside any polygon, by the even-odd rule on its outline.

    Points meet the cells they lie in and are tested against the edges of those. ``key`` is the
    points' unique column, needed where outlines of several sizes exist.
    """
    cells = polygon_cells(features)
    sizes = _edges(features).select("__lx", "__ly").distinct()
    levels = [tuple(row) for row in sizes.collect()]  # pairs of sizes, a few dozen
    if not levels:
        return points.where(F.lit(False))
    grids = F.array(*[F.struct(F.lit(a).alias("__lx"), F.lit(b).alias("__ly")) for a, b in sorted(levels)])
    probes = points.withColumn("__grid", F.explode(grids)).select(
        *points.columns,
        "__grid.*",
        _cell(F.col(lon), F.col("__grid.__lx")).alias("__cx"),
        _cell(F.col(lat), F.col("__grid.__ly")).alias("__cy"),
    )
    inside = _inside(F.col(f"p.{lon}"), F.col(f"p.{lat}"))
    same_cell = [F.col(f"p.{name}") == F.col(f"o.{name}") for name in CELL_KEYS]
    matched = same_cell[0] & same_cell[1] & same_cell[2] & same_cell[3] & inside
    # Size statistics don't see that an outline becomes many cells: unless told, Spark sends all of them to
    # every task. Sorted by cell, they can be spilled, and a cell with many points is split.
    hits = probes.alias("p").join(cells.hint("merge").alias("o"), matched, "left_semi").drop(*CELL_KEYS)
    return hits if len(levels) == 1 else hits.dropDuplicates([key])


def flag_points(
    points: DataFrame, features: DataFrame, *, lon: str = "lon", lat: str = "lat", key: str
) -> DataFrame:
    """All points with a flag ``inside``."""
    hits = points_in_polygons(points, features, lon=lon, lat=lat, key=key)
    marked = hits.select(key, F.lit(True).alias("inside"))
    return points.join(marked, key, "left").withColumn(
        "inside", F.coalesce("inside", F.lit(False))
    )


# -- X5 ------------------------------------------------------------------------------------------


def hex_grid(
    box: DataFrame, features: DataFrame, *, radius: float, width: float, height: float
) -> DataFrame:
    """Centres of flat-top hexagons over the canvas, kept where inside a feature.

    Odd rows shift by a whole column step, as the lattice is defined, so the centres form a
    rectangular lattice. Every edge meets the lattice rows between its ends; a row's crossings of an
    outline in order give the runs of columns inside it. So the work follows the outline's crossings
    and the cells found, and no centre is tested against a polygon.
    """
    column_step, row_step = radius * 2 * 0.75, math.sqrt(3) * radius
    corners = geo.Box.columns()
    x0, y0 = geo.project(corners.min_lon, corners.max_lat, corners, width, height)
    x1, y1 = geo.project(corners.max_lon, corners.min_lat, corners, width, height)
    canvas = box.select(
        *[F.col(c).alias(c) for c in ("min_lon", "max_lon", "min_lat", "max_lat")],
        *[v.alias(n) for v, n in zip((x0, y0, x1, y1), ("left", "top", "right", "bottom"))],
    )
    edges = _edges(features).select("__polygon", "x0", "y0", "x1", "y1").join(F.broadcast(canvas))  # one row

    def row_near(lat: Column) -> Column:
        """The lattice row at a latitude, before rounding to a whole one."""
        top, bottom = geo.mercator(corners.max_lat), geo.mercator(corners.min_lat)
        y = (top - geo.mercator(lat)) / (top - bottom) * F.lit(float(height))
        return (y - F.col("top")) / F.lit(row_step)

    def bounded(value: Column, last: Column) -> Column:
        return F.greatest(F.lit(-1), F.least(value, last)).cast("int")

    last_row = F.floor((F.col("bottom") - F.col("top")) / F.lit(row_step)) + 2
    last_col = F.floor((F.col("right") - F.col("left")) / F.lit(column_step)) + 2
    upper, lower = row_near(F.greatest("y0", "y1")), row_near(F.least("y0", "y1"))
    row_range = F.sequence(bounded(F.floor(upper) - 1, last_row), bounded(F.ceil(lower) + 1, last_row))
    offset = F.when(F.col("row") % 2 != 0, F.lit(column_step)).otherwise(F.lit(0.0))
    _, lat = geo.unproject(F.lit(0.0), F.col("cy"), corners, width, height)
    crossings = (
        edges.withColumn("row", F.explode(row_range))
        .withColumn("cy", F.col("top") + F.col("row") * F.lit(row_step))
        .where(F.col("cy") <= F.col("bottom") + F.lit(row_step))
        .withColumn("lat", lat)
        .where((F.col("y1") > F.col("lat")) != (F.col("y0") > F.col("lat")))
        .withColumn("at", geo.crossing(F.col("lat"), F.col("x1"), F.col("y1"), F.col("x0"), F.col("y0")))
    )
    lines = crossings.groupBy("__polygon", "row", "cy", "lat", *canvas.columns).agg(
        F.sort_array(F.collect_list("at")).alias("at")
    )
    # Crossings 0 and 1, 2 and 3, ... bound the runs: an odd number of crossings lies further east.
    pair = F.explode(F.sequence(F.lit(0), F.expr("size(at) div 2 - 1").cast("int")))
    runs = lines.withColumn("pair", pair).select(
        "*", F.get("at", F.col("pair") * 2).alias("west"), F.get("at", F.col("pair") * 2 + 1).alias("east")
    )

    def col_near(lon: Column) -> Column:
        x = (lon - corners.min_lon) / (corners.max_lon - corners.min_lon) * F.lit(float(width))
        return (x - F.col("left") - offset) / F.lit(column_step)

    col_range = F.sequence(
        bounded(F.floor(col_near(F.col("west"))) - 1, last_col),
        bounded(F.ceil(col_near(F.col("east"))) + 1, last_col),
    )
    cells = (
        runs.withColumn("col", F.explode(col_range))
        .withColumn("cx", F.col("left") + F.col("col") * F.lit(column_step) + offset)
        .where(F.col("cx") <= F.col("right") + F.lit(column_step))
    )
    lon, _ = geo.unproject(F.col("cx"), F.col("cy"), corners, width, height)
    placed = cells.withColumn("lon", lon).where((F.col("lon") >= F.col("west")) & (F.col("lon") < F.col("east")))
    return placed.select(
        F.concat_ws(":", "row", "col").alias("cell"), "row", "col", "cx", "cy", "lon", "lat"
    ).dropDuplicates(["row", "col"])  # polygons may overlap


# -- X6 ------------------------------------------------------------------------------------------

#: Stations (24 bytes each) of a block, and targets that meet one in a task.
STATIONS_PER_BLOCK, TARGETS_PER_BLOCK = 500_000, 500_000
#: Targets and stations of a distance matrix evaluated at once: a matrix stays in a core's cache.
MATRIX_TARGETS, MATRIX_STATIONS = 16, 4096
#: Cells of a side of the grid by which targets are dealt into parts, as a power of two.
PART_LEVEL = 6
#: Cells with this many cells' width between their middles meet by their nodes (a side has ``NODES`` at a power of 2).
APART, NODES = 3, 16
#: Pairs of a target and a station up to which a part and a block meet without cells, and up to which two cells
#: meet directly, near ones and others. Stations of a cell that are spread to its nodes one by one.
FEW_PAIRS, NEAR_PAIRS, FAR_PAIRS, LEAF = 20_000_000, 25_000, 5_000, 256
#: Levels of cells at most.
DEPTH = 26

_BLOCK = "block bigint, xs array<double>, ys array<double>, vs array<double>"
_SUMS = "__id bigint, block bigint, hit double, w double, wv double"


def idw(
    targets: DataFrame,
    stations: DataFrame,
    *,
    power: float = 2.0,
    block_rows: int = STATIONS_PER_BLOCK,
    pack_rows: int = TARGETS_PER_BLOCK,
) -> DataFrame:
    """Inverse-distance mean of all stations at every target.

    ``stations`` has ``seq`` (their order), ``lon``, ``lat`` and ``value``. A station closer than
    the exact distance gives its value, the first one in order. Stations with a null among these
    take no part; without any station the result is 0. A target without coordinates has no value.
    Rows of ``targets`` are evaluated each on its own, whatever keys they have.

    Every station counts at every target. Stations are packed into numbered array blocks of a written
    table, targets are dealt by their place into parts of about ``pack_rows`` or fewer; each part meets
    each block in a task, and the sums of a target are added up by Spark. In a task near stations are
    summed one by one, and those of cells further away together, as exact as doubles are (``_tree_sums``).
    """
    spark = targets.sparkSession
    folder = f"{shared_dir(spark)}/idw-{uuid.uuid4().hex}"
    usable = stations.select("seq", "lon", "lat", "value").na.drop()
    n_stations = usable.count()
    ranged = usable.repartitionByRange(max(1, math.ceil(n_stations / block_rows)), "seq").sortWithinPartitions("seq")
    blocks = materialize(ranged.mapInPandas(_packer(block_rows), _BLOCK), f"{folder}/stations")
    numbers = blocks.agg(F.collect_list("block")).first()[0]  # one number per block
    rows = targets.withColumn("__id", F.monotonically_increasing_id())
    rows = materialize(rows, f"{folder}/targets")
    placed = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    mean = F.coalesce(F.col("__wv") / F.nullif("__w", F.lit(0.0)), F.lit(0.0))
    value = F.when(placed, F.coalesce("__hit", mean)).alias("value")
    if not numbers:
        return rows.select(*targets.columns, F.when(placed, F.lit(0.0)).alias("value"))
    # Several pairs of a part and a block for every core, so that all cores end at about the same time.
    pairs = 8 * spark.sparkContext.defaultParallelism
    spots = rows.where(placed).select("__id", F.col("lon").cast("double"), F.col("lat").cast("double"))
    n_targets = rows.count()
    parts = max(math.ceil(n_targets / pack_rows), math.ceil(pairs / len(numbers)))
    part = F.pmod(F.xxhash64("__id"), F.lit(parts))
    if n_targets * n_stations > FEW_PAIRS * parts * len(numbers):  # otherwise no cells are used
        part, parts = _parts(spots, math.ceil(n_targets / parts))
    dealt = spots.select(
        part.cast("int").alias("part"),
        F.explode(F.lit(numbers).cast("array<bigint>")).alias("block"),
        "__id",
        "lon",
        "lat",
    )
    copies = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "*")
    met = dealt.groupBy("part", "block").cogroup(copies.groupBy("part", "block"))
    sums = met.applyInArrow(_matrix_sums(power), _SUMS)
    first = F.min_by("hit", F.when(F.col("hit").isNotNull(), F.col("block")))
    summed = sums.groupBy("__id").agg(first.alias("__hit"), F.sum("w").alias("__w"), F.sum("wv").alias("__wv"))
    return rows.join(summed, "__id", "left").select(*targets.columns, value)


def _parts(spots: DataFrame, size: int) -> tuple[Column, int]:
    """Number of the part that a target belongs to, and how many there are: neighbouring cells of a grid.

    Parts have up to ``size`` targets, about. A cell with more is dealt out by hash. Coordinates that are
    not finite count as in the first column or row.
    """
    finite = [F.when(F.abs(c) < F.lit(math.inf), F.col(c)) for c in ("lon", "lat")]
    box = spots.agg(*[f(c) for c in finite for f in (F.min, F.max)]).first()
    place = F.lit(0)
    for axis, (value, low, high) in enumerate(zip(finite, box[::2], box[1::2])):
        span = (high - low) / 2**PART_LEVEL if low is not None else 0.0
        if not 0 < span < math.inf:
            continue
        cell = F.least(F.coalesce(F.floor((value - low) / span), F.lit(0)), F.lit(2**PART_LEVEL - 1)).cast("int")
        for bit in range(PART_LEVEL):
            place = place + F.shiftleft(F.shiftright(cell, bit).bitwiseAND(F.lit(1)), 2 * bit + axis)
    counts = dict(spots.groupBy(place.alias("place")).count().collect())  # at most 4 ** PART_LEVEL rows
    first, shares = [0] * 4**PART_LEVEL, [1] * 4**PART_LEVEL
    part, held = 0, 0
    for at, count in sorted(counts.items()):
        if held and held + count > size:
            part, held = part + 1, 0
        first[at], shares[at] = part, math.ceil(count / size)
        part, held = part + shares[at] - 1, held + count if shares[at] == 1 else size
    at = place + 1
    dealt = F.pmod(F.xxhash64("__id"), F.element_at(F.lit(shares), at))
    return F.element_at(F.lit(first), at) + dealt, part + 1


# The functions below are closures, so that they travel to the tasks by value and these need not import
# this package.


def _packer(rows: int):
    """Packs the stations of a partition, in order, into numbered blocks; later partitions count higher."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        rest: list[pd.DataFrame] = []
        size = 0

        def block(part: pd.DataFrame) -> pd.DataFrame:
            arrays = {n: [part[c].to_numpy(float)] for n, c in (("xs", "lon"), ("ys", "lat"), ("vs", "value"))}
            return pd.DataFrame({"block": [number], **arrays})

        for frame in frames:
            rest.append(frame)
            size += len(frame)
            while size >= rows:
                whole = pd.concat(rest, ignore_index=True)
                yield block(whole[:rows])
                number += 1
                rest, size = [whole[rows:]], size - rows
        if size:
            yield block(pd.concat(rest, ignore_index=True))

    return pack


def _matrix_sums(power: float):
    """Sums of one block of stations at a part of the targets, and the first station too close.

    Rows whose numbers are not finite are evaluated one by one, all others by the cells they lie in.
    """
    near, apart = _pair_sums(power), _tree_sums(power)

    def sums(part: pa.Table, block: pa.Table) -> pa.Table:
        lons, lats = (part[c].to_numpy() for c in ("lon", "lat"))
        xs, ys, vs = (block[c].combine_chunks().flatten().to_numpy() for c in ("xs", "ys", "vs"))
        both = np.stack([np.ones(len(vs)), vs], axis=1)
        first = np.full(len(lons), len(vs))
        total = np.zeros((len(lons), 2))
        sound = np.isfinite(lons) & np.isfinite(lats)
        usual = np.isfinite(xs) & np.isfinite(ys) & np.isfinite(vs)
        every = np.ones(len(vs), bool)
        for add, t, s in ((apart, sound, usual), (near, sound, ~usual), (near, ~sound, every)):
            if t.any() and s.any():
                some, least = total[t], first[t]
                add(lons[t], lats[t], xs[s], ys[s], both[s], np.flatnonzero(s), some, least)
                total[t], first[t] = some, least
        hit = first < len(vs)
        out = {
            "__id": part["__id"],
            "block": pa.array(np.full(len(lons), block["block"][0].as_py(), np.int64)),
            "hit": pa.array(vs[np.where(hit, first, 0)], mask=~hit),
            "w": pa.array(total[:, 0]),
            "wv": pa.array(total[:, 1]),
        }
        return pa.table(out)

    return sums


def _pair_sums(power: float):
    """Adds weights and weighted values of stations to targets, pair by pair, and finds the first station too close.

    Weights follow from squared distances. Only distances near the exact one are measured as such.
    """
    tile, wide, exact = MATRIX_TARGETS * MATRIX_STATIONS, MATRIX_STATIONS, EXACT_DISTANCE
    doubtful = exact * exact * (1 + 1e-9)

    def add(lons, lats, xs, ys, both, numbers, total, first) -> None:
        square, other = np.empty(tile), np.empty(tile)
        for at in range(0, len(xs), wide):
            x, y, given = xs[at : at + wide], ys[at : at + wide], both[at : at + wide]
            tall = tile // len(x)
            for row in range(0, len(lons), tall):
                lon, lat = lons[row : row + tall, None], lats[row : row + tall, None]
                a, b = (m[: len(lon) * len(x)].reshape(len(lon), len(x)) for m in (square, other))
                np.subtract(lon, x, out=a)
                np.multiply(a, a, out=a)
                np.subtract(lat, y, out=b)
                np.multiply(b, b, out=b)
                np.add(a, b, out=a)
                if not a.min() > doubtful:  # also where a coordinate is not a number
                    i, j = np.nonzero(a <= doubtful)
                    near = np.hypot(lon[i, 0] - x[j], lat[i, 0] - y[j]) < exact
                    i, j = i[near], j[near]
                    np.minimum.at(first, row + i, numbers[at + j])
                    a[i, j] = 1.0
                if power == 2:
                    np.divide(1.0, a, out=a)
                else:
                    np.power(a, -power / 2, out=a)
                total[row : row + tall] += a @ given

    return add


def _tree_sums(power: float):
    """The same as ``_pair_sums`` for finite numbers, without evaluating every pair.

    Targets and stations lie in the cells of one quadtree. Cells next to each other are split on, until
    few pairs are left to evaluate one by one. Cells that lie apart meet by Chebyshev nodes: weights of the
    stations are spread to the nodes of their cell, summed at the nodes of the target's cell, and
    interpolated there. No station is left out: interpolation is wrong by some 1e-14 of a weight at most,
    which is about what adding up rounds off. Origin and sides of cells are such that places within a cell
    have no rounding.
    """
    apart, exact, deepest = APART, EXACT_DISTANCE, DEPTH
    few, few_near, few_far, leaf = FEW_PAIRS, NEAR_PAIRS, FAR_PAIRS, LEAF
    nodes = NODES + max(0, math.ceil(power) - 2)
    one_by_one = _pair_sums(power)
    order = np.arange(nodes)
    spots = np.cos(np.pi * (order + 0.5) / nodes)
    cosines = np.cos(np.outer(order, np.pi * (order + 0.5) / nodes)) * np.where(order, 2, 1)[:, None] / nodes

    def basis(u: np.ndarray) -> np.ndarray:
        """Lagrange polynomials of the nodes at places between -1 and 1: (nodes, places)."""
        t = np.empty((nodes, len(u)))
        t[0], t[1] = 1.0, u
        for i in range(2, nodes):
            t[i] = 2 * u * t[i - 1] - t[i - 2]
        return cosines.T @ t

    halves = [basis((spots + side) / 2) for side in (-1, 1)]  # nodes of a cell at those of its lower and upper half

    def between(dx: int, dy: int) -> np.ndarray:
        """Weights of a cell's nodes at those of another, both of side 2."""
        x = (2 * dx + spots[:, None] - spots) ** 2
        y = (2 * dy + spots[:, None] - spots) ** 2
        square = x[:, None, :, None] + y[None, :, None, :]
        return (1.0 / square if power == 2 else square ** (-power / 2)).reshape(nodes**2, nodes**2)

    def spans(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """All numbers from each start to before its stop."""
        n = stops - starts
        return np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())

    class Cells:
        """Points sorted by cell. ``level(l)``: starts of cells, with the end; their columns and rows."""

        def __init__(self, x: np.ndarray, y: np.ndarray, west: float, south: float, side: float, depth: int):
            self.depth, self.west, self.south, self.side = depth, west, south, side
            last, step = (1 << depth) - 1, side * 0.5**depth
            cx, cy = (np.clip(np.floor((a - b) / step), 0, last).astype(np.int64) for a, b in ((x, west), (y, south)))
            key = np.zeros(len(x), np.int64)
            for bit in range(depth):
                key |= ((cx >> bit & 1) << 2 * bit) | ((cy >> bit & 1) << 2 * bit + 1)
            self.order = np.argsort(key, kind="stable")
            self.x, self.y, self.cx, self.cy, self.key = (a[self.order] for a in (x, y, cx, cy, key))
            self.known: dict[int, tuple] = {}

        def level(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            if level not in self.known:
                down = self.depth - level
                key = self.key >> 2 * down
                starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                self.known[level] = np.append(starts, len(key)), self.cx[starts] >> down, self.cy[starts] >> down
            return self.known[level]

        def children(self, level: int) -> np.ndarray:
            """First child of every cell, with the end."""
            return np.searchsorted(self.level(level + 1)[0], self.level(level)[0])

        def inside(self, level: int, cell: int) -> tuple[slice, np.ndarray, np.ndarray]:
            """Points of a cell, and the nodes' polynomials there by x and by y."""
            starts, cx, cy = self.level(level)
            here, side = slice(starts[cell], starts[cell + 1]), self.side * 0.5**level
            u = (self.x[here] - (self.west + (cx[cell] + 0.5) * side)) / (side / 2)
            v = (self.y[here] - (self.south + (cy[cell] + 0.5) * side)) / (side / 2)
            return here, basis(u), basis(v)

    def grid(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float, int]:
        """West, south and side of the whole square, and how many levels have exact cells not below the exact distance."""
        low = x.min(), y.min()
        wide = max(x.max() - low[0], y.max() - low[1])
        if not 0 < wide < 1e100:
            return 0.0, 0.0, 0.0, 0
        side = 2.0 ** (math.floor(math.log2(wide * 1.001)) + 1)
        step = side * 0.5**deepest
        smallest = max(exact, 2.0**-40 * max(np.abs(x).max(), np.abs(y).max()))
        depth = min(deepest, max(0, math.floor(math.log2(side / smallest))))
        return math.floor(low[0] / step) * step, math.floor(low[1] / step) * step, side, depth

    def plan(goals: Cells, sources: Cells):
        """Pairs of cells by level: those that meet by nodes, and those that meet directly; cells that are split."""
        t = s = np.zeros(1, np.int64)
        by_nodes, direct, split = [], [], []
        level = 0
        while True:
            (at, tx, ty), (bt, sx, sy) = goals.level(level), sources.level(level)
            n = (at[t + 1] - at[t]) * (bt[s + 1] - bt[s])
            near = np.maximum(np.abs(tx[t] - sx[s]), np.abs(ty[t] - sy[s])) < apart
            far = ~near & (n > few_far)
            on = near & (n > few_near) & (level < goals.depth)
            by_nodes.append((t[far], s[far]))
            direct.append((t[~far & ~on], s[~far & ~on]))
            split.append(np.unique(t[on]))
            if not on.any():
                return by_nodes, direct, split
            t, s = t[on], s[on]
            a, b = goals.children(level), sources.children(level)
            wide = b[s + 1] - b[s]
            n = (a[t + 1] - a[t]) * wide
            pair, at = np.repeat(np.arange(len(t)), n), spans(np.zeros_like(n), n)
            t, s = a[t[pair]] + at // wide[pair], b[s[pair]] + at % wide[pair]
            level += 1

    def meet_by_nodes(goals: Cells, sources: Cells, both: np.ndarray, by_nodes: list) -> list[tuple]:
        """By level: cells of targets that have sums at their nodes, and these (cells, 2, nodes, nodes)."""
        needed = [np.unique(s) for _, s in by_nodes]
        level = 0
        while level < len(needed):  # a large cell's weights come from its children's
            starts = sources.level(level)[0]
            large = needed[level][starts[needed[level] + 1] - starts[needed[level]] > leaf]
            if level < sources.depth and len(large):
                child = sources.children(level)
                below = spans(child[large], child[large + 1])
                if level + 1 == len(needed):
                    needed.append(below)
                else:
                    needed[level + 1] = np.union1d(needed[level + 1], below)
            level += 1
        tables: dict[tuple[int, int], np.ndarray] = {}
        found: list[tuple] = [()] * len(by_nodes)
        under = None
        for level in range(len(needed) - 1, -1, -1):
            cells = needed[level]
            starts, cx, cy = sources.level(level)
            weights = np.zeros((len(cells), 2, nodes, nodes))
            large = (starts[cells + 1] - starts[cells] > leaf) & (level < sources.depth)
            for i in np.flatnonzero(~large):
                here, px, py = sources.inside(level, cells[i])
                for k in range(2):
                    weights[i, k] = (px * both[here, k]) @ py.T
            if large.any():
                child = sources.children(level)
                below = spans(child[cells[large]], child[cells[large] + 1])
                parent = np.repeat(np.flatnonzero(large), child[cells[large] + 1] - child[cells[large]])
                _, ux, uy = sources.level(level + 1)
                for x in range(2):
                    for y in range(2):
                        some = (ux[below] & 1 == x) & (uy[below] & 1 == y)
                        lower = under[1][np.searchsorted(under[0], below[some])]
                        weights[parent[some]] += halves[x] @ lower @ halves[y].T
            under = cells, weights
            if level >= len(by_nodes) or not len(by_nodes[level][0]):
                continue
            t, s = by_nodes[level]
            _, tx, ty = goals.level(level)
            cells_t = np.unique(t)
            sums = np.zeros((len(cells_t), 2, nodes**2))
            flat = weights.reshape(len(cells), 2, nodes**2)
            scale = (sources.side * 0.5**level / 2) ** -power
            dx, dy = tx[t] - cx[s], ty[t] - cy[s]
            code = (dx + 2 * apart) * 4 * apart + dy + 2 * apart
            by_code = np.argsort(code, kind="stable")
            for group in np.split(by_code, np.flatnonzero(np.diff(code[by_code])) + 1):
                offset = int(dx[group[0]]), int(dy[group[0]])
                if offset not in tables:
                    tables[offset] = between(*offset)
                given = flat[np.searchsorted(cells, s[group])].reshape(-1, nodes**2)
                # A cell has one other at this offset.
                sums[np.searchsorted(cells_t, t[group])] += scale * (given @ tables[offset].T).reshape(-1, 2, nodes**2)
            found[level] = cells_t, sums.reshape(-1, 2, nodes, nodes)
        return found

    def interpolate(goals: Cells, found: list[tuple], split: list, total: np.ndarray) -> None:
        """Adds sums at nodes to the targets, by way of the children where a cell is split."""
        cells, sums = np.zeros(0, np.int64), np.zeros((0, 2, nodes, nodes))
        for level in range(len(split)):
            if found[level]:
                every = np.union1d(cells, found[level][0])
                added = np.zeros((len(every), 2, nodes, nodes))
                added[np.searchsorted(every, cells)] = sums
                added[np.searchsorted(every, found[level][0])] += found[level][1]
                found[level], cells, sums = (), every, added
            on = np.isin(cells, split[level])
            for i in np.flatnonzero(~on):
                here, px, py = goals.inside(level, cells[i])
                for k in range(2):
                    total[here, k] += ((sums[i, k].T @ px) * py).sum(axis=0)
            if not on.any():
                cells, sums = cells[:0], sums[:0]
                continue
            child = goals.children(level)
            parents = cells[on]
            below = spans(child[parents], child[parents + 1])
            parent = np.repeat(np.flatnonzero(on), child[parents + 1] - child[parents])
            _, cx, cy = goals.level(level + 1)
            lower = np.empty((len(below), 2, nodes, nodes))
            for x in range(2):
                for y in range(2):
                    some = (cx[below] & 1 == x) & (cy[below] & 1 == y)
                    lower[some] = halves[x].T @ sums[parent[some]] @ halves[y]
            cells, sums = below, lower

    def meet(goals: Cells, sources: Cells, both: np.ndarray, numbers: np.ndarray, direct: list, total, first) -> None:
        """Adds the stations of cells that meet directly."""
        for level, (t, s) in enumerate(direct):
            if not len(t):
                continue
            at, bt = goals.level(level)[0], sources.level(level)[0]
            by_goal = np.argsort(t, kind="stable")
            for group in np.split(by_goal, np.flatnonzero(np.diff(t[by_goal])) + 1):
                here = slice(at[t[group[0]]], at[t[group[0]] + 1])
                some = spans(bt[s[group]], bt[s[group] + 1])
                x, y, given = sources.x[some], sources.y[some], both[some]
                one_by_one(goals.x[here], goals.y[here], x, y, given, numbers[some], total[here], first[here])

    def add(lons, lats, xs, ys, both, numbers, total, first) -> None:
        west, south, side, depth = grid(np.concatenate([lons, xs]), np.concatenate([lats, ys]))
        if not depth or len(lons) * len(xs) <= few:
            return one_by_one(lons, lats, xs, ys, both, numbers, total, first)
        goals, sources = (Cells(x, y, west, south, side, depth) for x, y in ((lons, lats), (xs, ys)))
        both, numbers = both[sources.order], numbers[sources.order]
        sums, least = np.zeros_like(total), first[goals.order]
        by_nodes, direct, split = plan(goals, sources)
        interpolate(goals, meet_by_nodes(goals, sources, both, by_nodes), split, sums)
        meet(goals, sources, both, numbers, direct, sums, least)
        total[goals.order] += sums
        first[goals.order] = least

    return add
