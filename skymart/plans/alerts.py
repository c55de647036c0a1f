"""Warning feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields of an alert, severities from the worst down.
ALERT_FIELDS = (
    "event",
    "headline",
    "description",
    "urgency",
    "severity",
    "certainty",
    "effective",
    "expires",
    "web",
)
SEVERITIES = ("Extreme", "Severe", "Moderate", "Minor")


def _stripped(value: Column) -> Column:
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def first_element(xml: Column, name: str) -> Column:
    """Trimmed content of the first element of a name; empty text if there is none."""
    return _stripped(F.regexp_extract(xml, f"(?s)<{name}>(.*?)</{name}>", 1))


def elements(xml: Column, name: str) -> Column:
    """Contents of all elements of a name."""
    return F.regexp_extract_all(xml, F.lit(f"(?s)<{name}>(.*?)</{name}>"), F.lit(1))


def polygon_points(content: Column) -> Column:
    """ "lat,lon lat,lon ..." as [[lon, lat], ...]"""

    def swapped(pair: Column) -> Column:
        parts = F.split(pair, ",")
        return F.array(F.get(parts, 1).try_cast("double"), F.get(parts, 0).try_cast("double"))

    return F.transform(F.split(_stripped(content), r"\s+"), swapped)


def feed_items(feed: DataFrame) -> DataFrame:
    """Items of feed documents (``feed_id``, ``xml``) in feed order."""
    return feed.select("feed_id", F.posexplode(elements(F.col("xml"), "item"))).select(
        "feed_id",
        F.col("pos").alias("position"),
        first_element(F.col("col"), "title").alias("title"),
        first_element(F.col("col"), "link").alias("link"),
    )


def parse_alerts(feed: DataFrame, documents: DataFrame, region: str) -> DataFrame:
    """Alerts of the region's feed items; items without a document are dropped.

    ``documents`` has one row (``link``, ``xml``) per fetched alert.
    """
    items = feed_items(feed).where(F.lower("title").contains(region) & (F.col("link") != ""))
    info_block = F.regexp_extract("xml", "(?s)<info>(.*?)</info>", 1)
    info = F.when(F.col("xml").rlike("(?s)<info>.*?</info>"), info_block).otherwise(F.col("xml"))
    areas = F.transform(
        elements(F.col("info"), "area"),
        lambda area: F.struct(
            first_element(area, "areaDesc").alias("areaDesc"),
            F.transform(elements(area, "polygon"), polygon_points).alias("polygons"),
        ),
    )
    return (
        items.join(documents.select("link", info.alias("info")), "link")
        .select(
            "feed_id",
            "position",
            "link",
            *[first_element(F.col("info"), name).alias(name) for name in ALERT_FIELDS],
            areas.alias("areas"),
        )
    )


def severity_rank(severity: Column) -> Column:
    """Position in the severity order; unknown ones rank before all."""
    return F.array_position(F.array(*[F.lit(name) for name in SEVERITIES]), severity)


def top_alert(alerts: DataFrame) -> DataFrame:
    """The alert shown first; feed order decides among equals."""
    return alerts.orderBy(severity_rank(F.col("severity")), "feed_id", "position").limit(1)


def alert_polygons(alerts: DataFrame) -> DataFrame:
    """One row per alert, area and polygon.

    The outer generators with a filter on their output do the work of the inner ones; for those
    Spark would derive a filter on the input and extract the areas a second time.
    """
    areas = (
        alerts.select("*", F.posexplode_outer("areas").alias("area_position", "area"))
        .where(F.col("area").isNotNull())
        .drop("areas")
    )
    polygons = areas.select(
        *[c for c in areas.columns if c != "area"],
        F.col("area.areaDesc").alias("areaDesc"),
        F.posexplode_outer("area.polygons").alias("polygon_position", "polygon"),
    )
    return polygons.where(F.col("polygon").isNotNull())
