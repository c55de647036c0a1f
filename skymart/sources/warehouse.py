"""Star schema on parquet with atomically published snapshots.

A snapshot is a small manifest naming the directories of every table and the watermark. A load
writes new directories and then publishes the next manifest by one rename that fails if another
writer took that number: data and watermark become visible together or not at all.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession

from skymart.schemas import TABLES

#: Older manifests are dropped; they only serve readers that started before the last loads.
KEPT_MANIFESTS = 5
#: Column by which a table's directories are cut: days, months, or hash buckets of locations.
PARTITIONED = {
    "fact_weather": "date",
    "fact_days": "month",
    "time_coverage": "month",
    "seen_keys": "date",
    "location_totals": "bucket",
    "location_stats": "bucket",
}
#: Hash buckets of the tables with a row per location; a load rewrites those it touches.
BUCKETS = 16


@dataclass(frozen=True)
class Snapshot:
    """``tables`` maps a table to directories; for partitioned tables the leaf ones."""

    version: int = 0
    watermark_us: int | None = None
    updated_at: str | None = None
    tables: dict[str, list[str]] = field(default_factory=dict)

    @property
    def watermark(self) -> datetime | None:
        if self.watermark_us is None:
            return None
        return datetime.fromtimestamp(self.watermark_us / 1_000_000, UTC)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._manifests = f"{self.root}/_manifests"

    # -- file system -----------------------------------------------------------------------

    def _hadoop(self, path: str):
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _children(self, path: str) -> list[str]:
        target, fs = self._hadoop(path)
        return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []

    def _read_text(self, path: str) -> str:
        target, fs = self._hadoop(path)
        stream = fs.open(target)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(
                stream, "UTF-8"
            )
        finally:
            stream.close()

    def _write_new(self, path: str, content: str) -> None:
        """Complete file or nothing; fails if ``path`` exists."""
        draft, fs = self._hadoop(f"{path}.{uuid.uuid4().hex}.tmp")
        stream = fs.create(draft, False)
        stream.write(bytearray(content.encode()))
        stream.close()
        sc = self.spark.sparkContext
        context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            draft.toUri() if draft.toUri().getScheme() else fs.getUri(),
            sc._jsc.hadoopConfiguration(),
        )
        no_overwrite = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(fs.makeQualified(draft), fs.makeQualified(self._hadoop(path)[0]), no_overwrite)

    def delete(self, path: str) -> None:
        target, fs = self._hadoop(path)
        fs.delete(target, True)

    # -- snapshots -------------------------------------------------------------------------

    def snapshot(self) -> Snapshot:
        versions = [int(n[:-5]) for n in self._children(self._manifests) if n.endswith(".json")]
        if not versions:
            return Snapshot()
        return Snapshot(**json.loads(self._read_text(self._manifest(max(versions)))))

    def _manifest(self, version: int) -> str:
        return f"{self._manifests}/{version:012d}.json"

    def publish(
        self, base: Snapshot, tables: dict[str, list[str]], watermark_us: int | None
    ) -> Snapshot:
        """Make ``tables`` (the changed ones) and the watermark the current state."""
        new = Snapshot(
            base.version + 1,
            watermark_us,
            datetime.now(UTC).isoformat(),
            {**base.tables, **tables},
        )
        self._write_new(self._manifest(new.version), json.dumps(new.__dict__))
        self._expire(new.version - KEPT_MANIFESTS)
        return new

    def _directories(self, version: int) -> set[str]:
        tables = json.loads(self._read_text(self._manifest(version)))["tables"]
        return {path for paths in tables.values() for path in paths}

    def _expire(self, version: int) -> None:
        """Drop a manifest and the directories that only it and older ones name.

        A directory that the next snapshot left out never comes back.
        """
        if version <= 0 or f"{version:012d}.json" not in self._children(self._manifests):
            return
        for path in self._directories(version) - self._directories(version + 1):
            self.delete(path)
            above, _, name = path.rpartition("/")
            if not name.startswith("load=") and not any("=" in c for c in self._children(above)):
                self.delete(above)  # the last day or bucket of its load
        self.delete(self._manifest(version))

    # -- L1 --------------------------------------------------------------------------------

    def get_watermark(self) -> datetime | None:
        """L1"""
        return self.snapshot().watermark

    def set_watermark(self, instant: datetime) -> Snapshot:
        """L1"""
        moment = instant if instant.tzinfo else instant.replace(tzinfo=UTC)
        return self.publish(self.snapshot(), {}, round(moment.timestamp() * 1_000_000))

    # -- tables ----------------------------------------------------------------------------

    def new_dir(self, table: str) -> str:
        return f"{self.root}/{table}/load={uuid.uuid4().hex}"

    def write(self, df: DataFrame, table: str) -> list[str]:
        """Write rows to a new directory and return the directories to publish."""
        path = self.new_dir(table)
        if table not in PARTITIONED:
            df.write.parquet(path)
            return [path]
        by = PARTITIONED[table]
        # One shuffle by day would put a busy day into one task; AQE's rebalance splits it.
        # Sorted rows give the location filter of the queries selective row-group statistics.
        sort_key = next((c for c in ("location_id", "location") if c in df.columns), df.columns[0])
        balanced = df.hint("rebalance", by).sortWithinPartitions(by, sort_key)
        balanced.write.partitionBy(by).parquet(path)
        parts = [f"{path}/{name}" for name in self._children(path) if name.startswith(f"{by}=")]
        if not parts:  # no rows
            self.delete(path)
        return parts

    def read(self, name: str, paths: list[str]) -> DataFrame:
        """Rows of some directories of a table."""
        schema = TABLES[name]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        if name in PARTITIONED:
            reader = reader.option("basePath", f"{self.root}/{name}")
        df = reader.parquet(*paths)
        return df.drop("load") if "load" in df.columns else df

    def table(
        self,
        name: str,
        *,
        snapshot: Snapshot | None = None,
        dates: Iterable[date] | None = None,
        since: date | None = None,
        buckets: Iterable[int] | None = None,
    ) -> DataFrame:
        """A table of the current or a given snapshot, optionally only some days or buckets of it."""
        snapshot = snapshot or self.snapshot()
        paths = snapshot.tables.get(name, [])
        if name in PARTITIONED:
            if dates is not None:
                wanted = {d.isoformat() for d in dates}
                paths = [p for p in paths if partition_value(p) in wanted]
            if since is not None:
                paths = [p for p in paths if partition_value(p) >= since.isoformat()]
            if buckets is not None:
                some = {str(b) for b in buckets}
                paths = [p for p in paths if partition_value(p) in some]
        return self.read(name, paths)

    def register_views(self, names: Iterable[str] = TABLES) -> None:
        """Expose the tables to ``spark.sql``."""
        current = self.snapshot()
        for name in names:
            self.table(name, snapshot=current).createOrReplaceTempView(name)


def partition_value(path: str) -> str:
    return path.rsplit("=", 1)[1]
