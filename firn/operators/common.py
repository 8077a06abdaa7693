"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firn.sources.textio import stored

# Most columns a wide table gets (zone names of a pivot, a few hundred in practice).
MAX_DIMENSION_VALUES = 10_000


def distinct_values(df: DataFrame, col: str, limit: int = MAX_DIMENSION_VALUES) -> list:
    """Sorted distinct values of a small dimension column, with a size check."""
    vals = [r[0] for r in df.select(col).distinct().limit(limit + 1).collect()]
    if len(vals) > limit:
        raise ValueError(f"{col} has more than {limit} distinct values; keep it long")
    return sorted(v for v in vals if v is not None)

# Rows that one task groups or sorts at most, about; a hash table over them takes some hundred MB.
TASK_ROWS = 1 << 20


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in as many pieces as ``rows`` need, at least one a core: a task's share stays the same as the input
    grows.  Unlike the pieces that adaptive execution joins by bytes, these are not joined."""
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return df.repartition(n, *keys)


def join_spread(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Inner or left join in pieces by the number of joined rows, so that an aggregate right after it has a bounded share in
    each task.  Both sides are read twice (for the number first): pass stored or cheap tables."""
    n_left, n_right = (d.groupBy(key).agg(F.count(F.lit(1)).alias(f"_n{k}")) for k, d in enumerate((left, right)))
    rows = n_left.join(n_right, key, how).agg(F.sum(F.col("_n0") * F.coalesce("_n1", F.lit(1)))).first()[0] or 0
    return spread(left, rows, key).join(spread(right, rows, key), key, how)


# Number of the block that a row is in (see ``Blocks``).
BLOCK = "_block"
# Blocks of zones up to which a day's rows are copied to all of them; beyond, only to those where their point has a zone.
FEW = 4


class Blocks:
    """A table of zones and days in blocks of some zones and some days, for joins whose rows are grouped by zone and day next.

    ``series`` has rows of a point and a day, ``rows`` of a point and a zone (weights, pixels); joined by point they are many times
    as long as both and as the groups.  So the sides are shuffled, not what they join to: a zone's rows go to the blocks of
    all days, a day's rows to those of all zones, and each block, one task, joins and groups what it has.
    A block has about two million groups and at most four million of ``rows``.  Of the ways to cut that hold this, the one that copies
    least is taken.  Pass stored tables: they are counted first.  Rows without a zone or a day are in no block."""

    def __init__(self, series: DataFrame, rows: DataFrame, zones: DataFrame, keys: list[str], zone: str = "zone", date: str = "date"):
        self.zone, self.date, self.keys, self.n_rows = zone, date, list(keys), rows.count()
        self.zones = stored(zones.select(zone).where(F.col(zone).isNotNull()).distinct(), "zones")
        self.present = stored(series.select(*keys).where(F.col(date).isNotNull()).distinct(), "keys")
        days = max(1, self.present.select(date).distinct().count())
        need = max(series.sparkSession.sparkContext.defaultParallelism, -(-self.zones.count() * self.present.count() // (2 * TASK_ROWS)))
        self.n_zone = max(1, -(-self.n_rows // (4 * TASK_ROWS)), -(-need // days),
                          round((need * self.n_rows / max(1, series.count())) ** 0.5))
        self.n_day = min(days, -(-need // self.n_zone))

    def _cut(self, df: DataFrame, block: Column) -> DataFrame:
        return df.withColumn(BLOCK, block.cast("int")).repartitionById(self.n_zone * self.n_day, F.col(BLOCK))

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(self.zone), F.lit(self.n_zone)).cast("int")

    def _day(self) -> Column:
        return F.pmod(F.unix_date(F.col(self.date).cast("date")), F.lit(self.n_day))

    def of_zones(self, df: DataFrame) -> DataFrame:
        """Rows with a zone, in the blocks of all days."""
        at = F.explode(F.sequence(F.lit(0), F.lit(self.n_day - 1)))
        df = df.where(F.col(self.zone).isNotNull()).withColumn("_at", at)
        return self._cut(df, self._part() * self.n_day + F.col("_at")).drop("_at")

    def of_days(self, df: DataFrame, parts: DataFrame | None = None, key: str | None = None) -> DataFrame:
        """Rows with a day, in the blocks of all zones, or of those that ``parts`` has for their ``key``."""
        df = df.where(F.col(self.date).isNotNull())
        if parts is not None:
            df = df.join(parts, key)
        else:
            df = df.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(self.n_zone - 1))))
        return self._cut(df, F.col("_part") * self.n_day + self._day()).drop("_part")

    def join(self, series: DataFrame, rows: DataFrame, key: str) -> DataFrame:
        """Inner join by ``key`` inside the blocks; a group by block, zone and day follows without a shuffle."""
        parts = None
        if self.n_zone > FEW:
            parts = rows.where(F.col(self.zone).isNotNull()).select(key, self._part().alias("_part")).distinct()
        rows = spread(rows, self.n_rows * self.n_day, key)  # many tasks copy them, whatever files they stand in
        # a point's rows lie together in the table that a day's rows look them up in; the running number keeps the sort, which
        # the optimizer would drop below a join
        r = self.of_zones(rows).sortWithinPartitions(key).withColumn("_at", F.monotonically_increasing_id())
        r = r.where(F.col("_at") >= 0).drop("_at").hint("shuffle_hash")
        return self.of_days(series, parts, key).join(r, [BLOCK, key])

    def grid(self) -> DataFrame:
        """Every zone and every key, in the blocks."""
        return self.of_zones(self.zones).join(self.of_days(self.present).hint("shuffle_hash"), BLOCK)


def block_of(df: DataFrame) -> list[str]:
    """The block column for a list of keys, where ``df`` is in blocks."""
    return [BLOCK] if BLOCK in df.columns else []


def best_row(df: DataFrame, keys: list[str], rank: Column, least: bool = False) -> DataFrame:
    """Per key the whole row of the highest (``least``: lowest) long rank.

    Every column is picked by the same rank in one partial+final aggregate: a hash
    aggregate while all columns have fixed widths, and copies of a hot key meet on the map side.
    Rows of equal rank are equal candidates; all columns come from the same one.
    """
    pick = F.min_by if least else F.max_by
    rest = [c for c in df.columns if c not in keys]
    return (df.withColumn("_rank", rank.cast("bigint")).groupBy(*keys)
            .agg(*[pick(F.col(c), F.col("_rank")).alias(c) for c in rest]).select(*df.columns))
