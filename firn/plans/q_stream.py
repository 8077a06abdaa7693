"""Streaming queries: S1 delivered as daily file drops and consumed with
Structured Streaming; each result is read back from its sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from firn.functions.numeric import rnd, rnd_sql
from firn.plans.registry import register
from firn.sources import standins as S
from firn.sources.tables import Tables
from firn.operators.zonal import QUANTILES
from firn.sources.textio import scratch_path, stored
from firn.streaming import drops as D

# Delivery lag of each source in days (drop day = data day + lag).
DELIVERY_LAG = {"reanalysis": 5, "daily_fc": 0, "cont_fc": -2}
# Days that a revision reaches back, days between drops, files in a micro-batch, spans of days that drops land in.
LOOKBACK_DAYS, DROP_EVERY, FILES_PER_BATCH, BATCHES = 7, 4, 8, 4
FORECASTS = ("daily_fc", "cont_fc")


def delay(sources) -> str:
    """How far rows of these sources can come out of time order when drops come in order: the spread of their lags and a day."""
    lags = [DELIVERY_LAG[s] for s in sources]
    return f"{max(lags) - min(lags) + 1} days"


def land_drops(t: Tables, streams: dict[str, tuple], heartbeat: str | None = None) -> dict:
    """S1 rows by delivery day, landed span by span, as a stream for each name of ``streams`` (its sources).
    ``heartbeat`` is the time after the last event at which a last file comes, with one row of no cell (NULL): it
    moves the watermark on, so that nothing waits for partners for ever."""
    lag = F.create_map(*[x for k, v in DELIVERY_LAG.items() for x in (F.lit(k), F.lit(v))])
    s = S.s1(t).select("source", "prio", "lat_i", "lon_i", "time", "value",
                       F.date_add(F.to_date("time"), F.element_at(lag, F.col("source"))).alias("drop_day"))
    s = stored(s, "drops")
    bounds = s.agg(F.min("drop_day").alias("lo"), F.max("drop_day").alias("hi"), F.max("time").alias("end")).first()
    out = {}
    for name, sources in streams.items():
        path, rows = scratch_path(t.spark, f"drops-{name}"), s.where(F.col("source").isin(*sources))
        days = (bounds.hi - bounds.lo).days // BATCHES + 1 if bounds.lo else 0
        for k in range(BATCHES if days else 0):  # one landing after the other
            part = F.floor(F.datediff("drop_day", F.lit(bounds.lo)) / days) == k
            rows.where(part).repartition(FILES_PER_BATCH).write.mode("append").parquet(path)
        if heartbeat and days:
            beat = rows.limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name != "time" else (
                F.lit(bounds.end) + F.expr(f"INTERVAL {heartbeat}")).cast("timestamp_ntz").alias("time") for f in rows.schema])
            beat.write.mode("append").parquet(path)
        out[name] = D.read_drops(t.spark, path, s.schema, max_files=FILES_PER_BATCH)
    return out


@register("t01_stream_dedupe", S.with_ctes(f"""
SELECT lat_i, lon_i, time, min_by(value, prio) AS value, min(prio) AS prio FROM s1 GROUP BY ALL""", "s1"))
def t01_stream_dedupe(t: Tables):
    """Each (cell, time) once, of the source that must win: forecasts arrive days before the reanalysis that supersedes them,
    in a stream of their own, and the two are joined with watermarks of three days and one day."""
    st = land_drops(t, {"reanalysis": ("reanalysis",), "forecast": FORECASTS}, heartbeat="60 DAYS")
    joined = D.first_wins_join(st["reanalysis"], st["forecast"], ["lat_i", "lon_i"], "value",
                               delays=(delay(("reanalysis",)), delay(FORECASTS)))
    out = scratch_path(t.spark, "t01-out")
    D.run_to_end(joined.where("lat_i IS NOT NULL").writeStream.format("parquet").option("path", out), scratch_path(t.spark, "t01-ckpt"))
    return t.spark.read.schema(joined.schema).parquet(out)


@register("t01_first_arrival", S.with_ctes("""
SELECT lat_i, lon_i, time, true AS from_a_source FROM s1 GROUP BY ALL""", "s1"))
def t01_first_arrival(t: Tables):
    """For sources of equal rank: each (cell, time) kept once, with the value of the source that delivered it first."""
    out = scratch_path(t.spark, "t01f-out")
    d = D.dedupe_stream(land_drops(t, {"all": tuple(DELIVERY_LAG)})["all"], ["lat_i", "lon_i"], delay=delay(DELIVERY_LAG))
    D.run_to_end(d.writeStream.format("parquet").option("path", out), scratch_path(t.spark, "t01f-ckpt"))
    kept = t.spark.read.parquet(out).select("lat_i", "lon_i", "time", "source", "value")
    s = S.s1(t).select("lat_i", "lon_i", "time", "source", F.col("value").alias("delivered"))
    j = kept.join(s, ["lat_i", "lon_i", "time", "source"], "left")
    return j.select("lat_i", "lon_i", "time", F.col("value").eqNullSafe(F.col("delivered")).alias("from_a_source"))


def revision_drops(t: Tables):
    """A drop every four days, each with the seven days up to it.  A later delivery
    of a forecast differs by a hundredth a drop; reanalysis comes only with the last drop of a day."""
    s = S.s1(t).select("source", "prio", "lat_i", "lon_i", "time", "value", F.to_date("time").alias("day"))
    first = s.agg(F.min("day")).scalar()
    since = F.datediff(F.col("day"), first)
    # drop k is on day 4k + 6; it holds the days from 4k to 4k + 6
    k_lo = F.greatest(F.ceil((since - (LOOKBACK_DAYS - 1)) / DROP_EVERY).cast("int"), F.lit(0))
    k_hi = F.floor(since / DROP_EVERY).cast("int")
    d = s.withColumn("k_hi", k_hi).withColumn("drop_no", F.explode(F.sequence(k_lo, k_hi)))
    d = d.where((F.col("source") != "reanalysis") | (F.col("drop_no") == F.col("k_hi")))
    value = F.when(F.col("source") == "reanalysis", F.col("value")).otherwise(F.col("value") + F.col("drop_no") / 100)
    return d.select("source", "prio", "lat_i", "lon_i", "time", value.alias("value"), "day", "drop_no",
                    F.date_add(first, F.col("drop_no") * DROP_EVERY + 6).alias("drop_day"))


_DROPS = f"""
f AS (SELECT min(CAST(time AS DATE)) AS first FROM s1),
d AS (SELECT source, prio, lat_i, lon_i, time, CAST(time AS DATE) AS day, value,
             unnest(range(greatest(CAST(ceil((CAST(time AS DATE) - first - {LOOKBACK_DAYS - 1}) / {DROP_EVERY}.0) AS INT), 0),
                          CAST(floor((CAST(time AS DATE) - first) / {DROP_EVERY}.0) AS INT) + 1)) AS drop_no,
             CAST(floor((CAST(time AS DATE) - first) / {DROP_EVERY}.0) AS INT) AS k_hi FROM s1, f),
r AS (SELECT lat_i, lon_i, time, prio, drop_no,
             CASE WHEN source = 'reanalysis' THEN value ELSE value + drop_no / 100 END AS value
      FROM d WHERE source <> 'reanalysis' OR drop_no = k_hi)"""


def run_revision(t: Tables, store: D.RevisionStore) -> None:
    """Drops land in two parts; a stream takes each up, a few files a batch, and goes on where it stopped."""
    d = revision_drops(t)
    drops, landing = scratch_path(t.spark, "revision-drops"), scratch_path(t.spark, "revision-landing")
    last = d.agg(F.max("drop_no")).first()[0]
    if last is None:
        return
    d.withColumn("half", (2 * F.col("drop_no") > last).cast("int")).repartitionByRange(FILES_PER_BATCH, "half", "drop_no").write.partitionBy("half").parquet(drops)
    for half in (0, 1):
        part = t.spark.read.parquet(f"{drops}/half={half}")
        part.write.mode("append").parquet(landing)
        stream = D.read_drops(t.spark, landing, part.schema, max_files=FILES_PER_BATCH // 4)
        D.run_to_end(stream.writeStream.foreachBatch(store.apply), f"{landing}-ckpt")


REVISION_SCHEMA = "source string, prio int, lat_i int, lon_i int, time timestamp_ntz, value double, day date, drop_no int, drop_day date"


def revision_store(t: Tables, follow=None) -> D.RevisionStore:
    return D.RevisionStore(t.spark, scratch_path(t.spark, "revision-store"), ["lat_i", "lon_i", "time"], ["value"],
                           REVISION_SCHEMA, lookback=LOOKBACK_DAYS, follow=follow)


@register("t02_rolling_revision", S.with_ctes(f"""
SELECT lat_i, lon_i, time, {rnd_sql('value')} AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY lat_i, lon_i, time ORDER BY prio, drop_no DESC) AS rn FROM r) WHERE rn = 1""",
                                              "s1", extra=_DROPS))
def t02_rolling_revision(t: Tables):
    """Every drop re-delivers the last 7 days with changed forecasts; day partitions are rebuilt
    per micro-batch as a new version (reanalysis over forecast, newest delivery first)."""
    store = revision_store(t)
    run_revision(t, store)
    return store.read().select("lat_i", "lon_i", "time", rnd("value").alias("value"))


# Columns of cells in a zone; product variables from the one value.
ZONE_COLUMNS, PRODUCT_FROM, PRODUCT_AS_OF = 4, {"SWE": "value"}, "2024-01-20"


def cell_zones(t: Tables):
    """Zones of S1 cells: blocks of four columns of a row; the rows are the regions."""
    cells = S.s1(t).select("lat_i", "lon_i").distinct()
    zone = F.concat(F.lit("B"), "lat_i", F.lit("_"), F.floor(F.col("lon_i") / ZONE_COLUMNS))
    return stored(cells.select("lat_i", "lon_i", zone.alias("zone"), F.concat(F.lit("L"), "lat_i").alias("region")), "cell-zones")


def kept_products(t: Tables) -> D.RevisionStore:
    follow = D.DayProducts(cell_zones(t), ["lat_i", "lon_i"], PRODUCT_FROM, PRODUCT_AS_OF)
    store = revision_store(t, follow)
    run_revision(t, store)
    return store


_KEPT = _DROPS + f""",
w AS (SELECT lat_i, lon_i, CAST(time AS DATE) AS day, value FROM (
  SELECT *, row_number() OVER (PARTITION BY lat_i, lon_i, time ORDER BY prio, drop_no DESC) AS rn FROM r) WHERE rn = 1),
cz AS (SELECT DISTINCT lat_i, lon_i, 'B' || lat_i || '_' || (lon_i // {ZONE_COLUMNS}) AS zone, 'L' || lat_i AS region FROM s1),
zz AS (SELECT DISTINCT zone, region FROM cz),
zm AS (SELECT dd.day, zz.zone, zz.region, avg(x.value) AS mean FROM (SELECT DISTINCT day FROM w) dd CROSS JOIN zz
       LEFT JOIN (SELECT w.day, cz.zone, w.value FROM w JOIN cz USING (lat_i, lon_i)) x ON x.day = dd.day AND x.zone = zz.zone GROUP BY ALL)"""


@register("t02_kept_zone_means", S.with_ctes(f"SELECT day, zone, {rnd_sql('mean')} AS mean FROM zm", "s1", extra=_KEPT))
def t02_kept_zone_means(t: Tables):
    """Daily zone means kept up to date by the days that each epoch changed (A01 from T02)."""
    store = kept_products(t)
    return store.follow.means(store.store.read("means")).select("day", "zone", rnd("mean").alias("mean"))


@register("t02_kept_region_means", S.with_ctes(f"SELECT day, region, {rnd_sql('avg(mean)')} AS mean FROM zm GROUP BY day, region", "s1", extra=_KEPT))
def t02_kept_region_means(t: Tables):
    """Daily region means kept up to date in the same way (A02 from T02)."""
    return kept_products(t).store.read("regions").select("day", "region", rnd("mean").alias("mean"))


@register("t02_kept_product", S.with_ctes(f"""
SELECT zone, day, {', '.join(f"{rnd_sql('mean')} AS {q}_SWE" for q in QUANTILES)}, day >= DATE '{PRODUCT_AS_OF}' AS FC FROM zm""", "s1", extra=_KEPT))
def t02_kept_product(t: Tables):
    """The zone product kept up to date in the same way (J14 from T02)."""
    p = kept_products(t).store.read("product")
    return p.select("zone", "day", *[rnd(f"{q}_SWE").alias(f"{q}_SWE") for q in QUANTILES], "FC")


@register("t03_day_completeness", S.with_ctes("""
SELECT source, CAST(time AS DATE) AS day, count(DISTINCT time) AS n_hours, count(DISTINCT time) = 24 AS complete
FROM s1 GROUP BY 1, 2""", "s1"))
def t03_day_completeness(t: Tables):
    """Hours present per source and tumbling day from the drop stream, batch by batch in update mode."""
    drops = land_drops(t, {"all": tuple(DELIVERY_LAG)})["all"]
    agg = D.day_completeness_stream(drops, ["source"], delay=delay(DELIVERY_LAG))
    agg = agg.select("source", F.to_date("w.start").alias("day"), "n_hours")
    days = D.LatestDays(t.spark, scratch_path(t.spark, "t03-out"), ["source", "day"], agg.schema)
    D.run_to_end(agg.writeStream.outputMode("update").foreachBatch(days.apply), scratch_path(t.spark, "t03-ckpt"))
    return days.read().select("source", "day", "n_hours", (F.col("n_hours") == 24).alias("complete"))
