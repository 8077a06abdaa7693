"""Structured Streaming versions of the ingest and revision steps
(T01-T03).  File drops are read with ``readStream``; event time must be a
TIMESTAMP (not NTZ) for watermarks, so it is cast on the way in.
Checkpoints and outputs live under the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from firn.operators.common import best_row
from firn.operators.zonal import QUANTILES, nodata_to_null, region_mean, zone_product
from firn.sources.versions import VersionedStore


def read_drops(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def dedupe_stream(drops: DataFrame, keys: list[str], event_time: str = "time",
                  delay: str = "7 days") -> DataFrame:
    """Each (key, time) kept once while within the watermark (T01, for sources of equal rank).  The copy that
    arrives first wins; inside one batch, equal keys are one row of that batch.  A copy that comes later than
    ``delay`` behind the newest event is dropped as late, so ``delay`` must cover the delivery lag."""
    ts = F.col(event_time).cast("timestamp")
    return (drops.withColumn("_evt", ts).withWatermark("_evt", delay)
            .dropDuplicatesWithinWatermark([*keys, event_time]).drop("_evt"))


def day_completeness_stream(drops: DataFrame, keys: list[str], event_time: str = "time",
                            delay: str = "7 days") -> DataFrame:
    """Hours present per tumbling day and key (T03), for output mode ``update``:
    a batch emits the days it changed, and days behind the watermark leave the state.
    The hours of a day are bits of one long, so copies do not count and the state of a day is one number."""
    hr = F.col(event_time).cast("timestamp")
    d = drops.select(*keys, F.date_trunc("hour", hr).alias("_hr")).withWatermark("_hr", delay)
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.hour("_hr")))
    return d.groupBy(*keys, F.window("_hr", "1 day").alias("w")).agg(F.bit_count(bits).cast("bigint").alias("n_hours"))


def first_wins_join(first: DataFrame, second: DataFrame, keys: list[str], value: str, prio: str = "prio",
                    event_time: str = "time", delays: tuple[str, str] = ("7 days", "7 days")) -> DataFrame:
    """One row per (keys, time) of two streams, ``first`` over ``second`` whatever arrives first.

    Each stream is reduced to one row per (key, time), by least ``prio`` where it mixes sources, as soon as its watermark has
    passed; a full outer join with watermarks on both sides then pairs them.  A row of one side waits until no partner
    can come any more, so a hindcast that arrived long before its reanalysis is superseded, and the state holds no more than
    the time between the two watermarks.  Each delay must cover how far rows of that stream come out of time order."""
    def reduced(stream, delay, side):
        t = F.col(event_time).cast("timestamp")
        return (stream.withColumn("_evt", t).withWatermark("_evt", delay).groupBy(*keys, "_evt")
                .agg(F.min_by(value, prio).alias(f"{value}_{side}"), F.min(prio).alias(f"{prio}_{side}")))
    a, b = reduced(first, delays[0], 1), reduced(second, delays[1], 2)
    j = a.join(b, [*keys, "_evt"], "full_outer")
    won = F.col(f"{prio}_1").isNotNull()
    return j.select(*keys, F.col("_evt").cast("timestamp_ntz").alias(event_time),
                    F.when(won, F.col(f"{value}_1")).otherwise(F.col(f"{value}_2")).alias(value),
                    F.when(won, F.col(f"{prio}_1")).otherwise(F.col(f"{prio}_2")).alias(prio))


class LatestDays:
    """Table of the newest state per (key, day) from an ``update`` stream (T03), in versions by day.  A batch
    carries the new state of the keys it touched; their days are merged with the rows of other keys and committed at
    once, so a read opens each day once however many epochs there were, and a repeated batch changes nothing."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], schema, day_col: str = "day"):
        types = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.keys, self.day_col = keys, day_col
        self.store = VersionedStore(spark, root, {"days": (day_col, types)})

    def apply(self, batch: DataFrame, epoch: int = 0) -> list[str]:
        days = [f"{self.day_col}={r[0]}" for r in batch.select(self.day_col).distinct().collect()]  # of one batch
        if not days:
            return []
        columns = batch.columns
        rows = batch.withColumn("_new", F.lit(1)).unionByName(self.store.read("days", only=days).withColumn("_new", F.lit(0)))
        changed = self.store.stage("days", best_row(rows, self.keys, F.col("_new")).select(*columns).hint("rebalance", self.day_col))
        self.store.commit()
        return changed

    def read(self) -> DataFrame:
        return self.store.read("days")


class LateRows(ValueError):
    """A stream dropped rows that came later than its watermark allows."""


def run_to_end(query_builder, checkpoint: str, allow_late: bool = False):
    """Start a query with an availableNow trigger and wait until it has
    consumed every drop present.  Rows that a stateful operator dropped as late are an error
    unless ``allow_late``: a result that lacks them would look complete."""
    q = query_builder.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    late = sum(op.numRowsDroppedByWatermark for p in q.recentProgress for op in p.stateOperators)
    if late and not allow_late:
        raise LateRows(f"{late} rows were later than the watermark; give a longer delay")
    return q


class RevisionStore:
    """Rolling revision of a day-partitioned table, in versions.

    Each micro-batch re-delivers recent days.  Only the days it touches are
    rebuilt: stored and new rows of those days are merged per variable, by source priority
    and inside a priority by the newest delivery (J01, A07), in one aggregate.  Every variable keeps the
    rank of the value it holds, so a later delivery is compared with that value and
    not with whatever else its row holds.  Rows of days more than ``lookback``
    days before the newest day of their drop are not revised.

    The rebuilt days are staged as a new version and one small pointer commits them, together with whatever
    ``follow`` stages for the same days, so readers see all of an epoch or nothing of it.  A batch that fails in
    between leaves the old version; its repeat merges the same rows into the same days, which changes nothing twice.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], variables: list[str], schema,
                 day_col: str = "day", prio: str = "prio", drop_col: str = "drop_no", lookback: int = 7,
                 follow: "DayProducts | None" = None):
        """``schema`` is that of the batches; ``follow`` is kept up to date with the days that change."""
        self.spark, self.keys, self.variables = spark, keys, variables
        self.day_col, self.prio, self.drop_col, self.lookback, self.follow = day_col, prio, drop_col, lookback, follow
        types = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        table = StructType([types[k] for k in (*keys, *variables)] + [StructField(f"{v}_rank", LongType()) for v in variables]
                           + [types[day_col]])
        self.store = VersionedStore(spark, root, {"table": (day_col, table), **(follow.tables(types[day_col]) if follow else {})})

    def apply(self, batch: DataFrame, epoch: int = 0) -> list[str]:
        """Merges a batch and commits; returns the folders of the days it changed."""
        day = F.col(self.day_col)
        newest = batch.groupBy(self.drop_col).agg(F.max(self.day_col).alias("_newest"))
        recent = batch.join(newest, self.drop_col)
        # rank: least priority first, newest delivery first inside it
        rank = F.col(self.prio).cast("bigint") * F.lit(1 << 32) - F.col(self.drop_col)
        new = recent.where(day > F.date_sub("_newest", self.lookback)).select(
            *self.keys, self.day_col, *self.variables,
            *[F.when(F.col(v).isNotNull(), rank).alias(f"{v}_rank") for v in self.variables])
        days = [f"{self.day_col}={r[0]}" for r in new.select(self.day_col).distinct().collect()]  # at most ``lookback`` a drop
        if not days:
            return []
        rows = new.unionByName(self.store.read("table", only=days))
        merged = rows.groupBy(*self.keys, self.day_col).agg(
            *[F.min_by(v, f"{v}_rank").alias(v) for v in self.variables],
            *[F.min(f"{v}_rank").alias(f"{v}_rank") for v in self.variables])
        changed = self.store.stage("table", merged.hint("rebalance", self.day_col))
        if self.follow:
            self.follow.stage(self.store, self.store.read("table", only=changed, staged=True))
        self.store.commit()
        return changed

    def read(self, version: int | None = None) -> DataFrame:
        return self.store.read("table", version).select(*self.keys, self.day_col, *self.variables)


class DayProducts:
    """Zone means, region means and the zone product, kept up to date by days (A01, A02, J14 from T02).

    Sums and counts stand by (day, zone, variable).  When an epoch changes days, those of these days alone are
    built again from the changed rows and replace their partitions; other days are neither read nor written.
    A day has a row for every zone, as in A01.
    """

    def __init__(self, cell_zone: DataFrame, cells: list[str], variables: dict[str, str], as_of: str, day_col: str = "day"):
        """``cell_zone`` has the cells' columns, zone and region; ``variables`` names product variables by their columns."""
        self.cell_zone, self.cells, self.variables, self.as_of, self.day_col = cell_zone, cells, variables, as_of, day_col

    def tables(self, day: StructField) -> dict:
        means = StructType.fromDDL("variable string, zone string, region string, total double, n long").add(day)
        regions = StructType.fromDDL("variable string, region string, mean double").add(day)
        columns = [f"{q}_{v}" for q in QUANTILES for v in self.variables]
        product = StructType.fromDDL("zone string, " + ", ".join(f"{c} double" for c in columns) + ", FC boolean").add(day)
        return {"means": (self.day_col, means), "regions": (self.day_col, regions), "product": (self.day_col, product)}

    def stage(self, store: VersionedStore, rows: DataFrame) -> None:
        """Builds everything of the days in ``rows`` (all rows of these days) and stages it with them."""
        day = self.day_col
        long = rows.unpivot([day, *self.cells], list(self.variables.values()), "_column", "value")
        name = F.create_map(*[F.lit(x) for v, c in self.variables.items() for x in (c, v)])
        value = nodata_to_null(F.col("value"))
        sums = (long.join(self.cell_zone, self.cells).groupBy(day, name[F.col("_column")].alias("variable"), "zone")
                .agg(F.sum(value).alias("total"), F.count(value).alias("n")))
        zones = self.cell_zone.select("zone", "region").distinct()
        days = rows.agg(F.collect_set(day)).scalar()  # those of one epoch
        every = (zones.withColumn(day, F.explode(days))
                 .withColumn("variable", F.explode(F.array(*[F.lit(v) for v in self.variables]))))
        means = every.join(sums, [day, "variable", "zone"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
        written = store.stage("means", means.hint("rebalance", day))
        means = self.means(store.read("means", only=written, staged=True))
        store.stage("regions", region_mean(means, zones, ("variable", day)).hint("rebalance", day))
        product = zone_product(means.withColumnRenamed(day, "date"), self.as_of, variables=tuple(self.variables))
        store.stage("product", product.withColumnRenamed("date", day).hint("rebalance", day))

    def means(self, sums: DataFrame) -> DataFrame:
        """(variable, day, zone, mean) from the stored sums and counts."""
        return sums.select("variable", self.day_col, "zone", F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("mean"))
