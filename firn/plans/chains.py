"""End-to-end chains: the operational flow from point series to published
zone products, written as one lazy plan over the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firn.functions.numeric import rnd, rnd_sql
from firn.operators import common as CM
from firn.operators import geometry as G
from firn.operators import points as PT
from firn.operators import raster as R
from firn.operators import zonal as Z
from firn.plans.registry import register
from firn.sources import standins as S
from firn.sources.tables import Tables
from firn.sources.textio import stored

# Chain parameters.
AS_OF = "1999-01-01"
PIXEL = 500.0
CHAIN_VARIABLES = ("SWE", "HS")


def zone_products_from_points(archive: DataFrame, latest: DataFrame, pixels: DataFrame, edges: DataFrame,
                              as_of: str, res: float, variables=("swe", "snd")) -> DataFrame:
    """archive (+) latest (A07) -> zone runs (J11) -> factorised zonal
    mean (M02 = J15 -> A01 without the pixel x day table) -> region
    roll-up (A02) -> product rows with quantile copies and FC (J13, J14,
    P16, P20) for both levels.  Shuffles: the overlay on the cluster, its rows
    and the weights into blocks of zones and days, the roll-up on small keys.  Both variables are joined at once and get
    long after it, a day having a row of each."""
    kl = PT.keep_last(archive, latest, ["cluster", "date"])
    series = stored(kl.select("cluster", "date", *variables), "series")
    weights = stored(G.cluster_weights(G.zone_runs(edges, pixels, res), pixels), "weights")
    zr = stored(edges.select("zone", "region").distinct(), "zone-regions")
    blocks = CM.Blocks(series, weights, zr, ["date"])
    wide = G.factorised_zonal_mean(weights, series, ["date"], list(variables), zr, blocks=blocks)
    # explode keeps the rows in their blocks, unpivot would not
    long = F.array(*[F.struct(R.product_names(F.lit(v))[0].alias("variable"), F.col(v).alias("mean")) for v in variables])
    zm = wide.select(CM.BLOCK, "date", "zone", F.explode(long).alias("_v")).select(CM.BLOCK, "date", "zone", "_v.variable", "_v.mean")
    rm = Z.region_mean(zm, zr, blocks=blocks).withColumnRenamed("region", "zone")
    cols = ["zone", "date"] + [f"{q}_{v}" for q in Z.QUANTILES for v in Z.PRODUCT_VARIABLES] + ["FC"]
    out = []
    for level, means in (("zone", zm), ("region", rm)):
        p = Z.zone_product(means, as_of, variables=tuple(n for n in CHAIN_VARIABLES))
        p = Z.ensure_columns(p, cols).select(F.lit(level).alias("level"), *cols)
        out.append(p)
    return out[0].unionByName(out[1])


_CHAIN_SQL = f"""
, bo AS (SELECT cluster FROM s5 GROUP BY cluster HAVING count(DISTINCT src) = 2),
  kl AS (SELECT cluster, date, swe, snd FROM (
           SELECT *, row_number() OVER (PARTITION BY cluster, date ORDER BY prio DESC, ord DESC) AS rn FROM s5)
         WHERE rn = 1 OR cluster NOT IN (SELECT cluster FROM bo)),
  zp AS (SELECT e.zone, p.pixel FROM s4a p JOIN zones e
           ON ((e.y1 <= p.y) <> (e.y2 <= p.y)) AND p.x < e.x1 + (p.y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
         GROUP BY e.zone, p.pixel HAVING count(*) % 2 = 1),
  zr AS (SELECT DISTINCT zone, region FROM zones),
  dt AS (SELECT DISTINCT date FROM kl),
  v AS (SELECT zp.zone, kl.date, kl.swe, kl.snd FROM zp JOIN s4a USING (pixel) JOIN kl USING (cluster)),
  zm AS (SELECT dt.date, zr.zone, zr.region, avg(v.swe) AS swe, avg(v.snd) AS hs
         FROM dt CROSS JOIN zr LEFT JOIN v ON v.date = dt.date AND v.zone = zr.zone
         GROUP BY dt.date, zr.zone, zr.region),
  rm AS (SELECT date, region AS zone, avg(swe) AS swe, avg(hs) AS hs FROM zm GROUP BY date, region),
  lv AS (SELECT 'zone' AS level, zone, date, swe, hs FROM zm UNION ALL SELECT 'region', zone, date, swe, hs FROM rm)
SELECT level, zone, date,
       {', '.join(f"{rnd_sql('swe')} AS {q}_SWE, {rnd_sql('hs')} AS {q}_HS, CAST(NULL AS DOUBLE) AS {q}_ROF" for q in Z.QUANTILES)},
       date >= DATE '{AS_OF}' AS FC
FROM lv"""


@register("chain_zone_products", S.with_ctes("", "s4a", "s5", "zones", extra=_CHAIN_SQL))
def chain_zone_products(t: Tables):
    """Daily flow: point overlay -> zone pixels -> factorised zonal mean ->
    region roll-up -> zone and region product tables (SWE, HS; ROF absent)."""
    s = S.s5(t)
    p = zone_products_from_points(s.where(F.col("src") == "archive"), s.where(F.col("src") == "latest"),
                                  S.s4a(t), S.zones(t), AS_OF, PIXEL)
    return p.select("level", "zone", "date",
                    *[rnd(c).alias(c) if c[0] == "Q" else F.col(c) for c in p.columns[3:-1]], "FC")


def hourly_forcing(runs: DataFrame, reanalysis: DataFrame, run_keys: list[str], cell_to_grid,
                   switch: int = 144, acc: str = "acc", value: str = "tp") -> DataFrame:
    """Forecast runs -> rates (W01) -> hourly values (W02) -> valid times ->
    latest run per cell and hour (W04) -> reanalysis over forecast (J01).
    Shuffles: knots on (run, cell, step), where copies of a knot are combined on the
    map side, then on (run, cell) for the windows; hours on (cell, time) for the latest run and the merge."""
    from firn.operators import forcing as P
    from firn.operators import merge as M
    rate = P.deaccumulate(runs, run_keys, acc, switch=switch).select(*run_keys, "step", "rate")
    hourly = P.interpolate_hourly(rate, run_keys, "rate")
    lat_i, lon_i = cell_to_grid(F.col(run_keys[1]))
    fc = hourly.select(lat_i.alias("lat_i"), lon_i.alias("lon_i"),
                       (F.col(run_keys[0]).cast("timestamp_ntz")
                        + F.make_dt_interval(F.lit(0), F.col("hour").cast("int"))).alias("time"),
                       F.col(run_keys[0]).alias("run"), F.col("rate").alias(value))
    latest = P.latest_run(fc, ["lat_i", "lon_i", "time"], "run")
    both = M.concat(reanalysis.select("lat_i", "lon_i", "time", value, F.lit(1).alias("prio")),
                    latest.select("lat_i", "lon_i", "time", value, F.lit(2).alias("prio")))
    return M.priority_merge(both, ["lat_i", "lon_i", "time"], [value], source="src_prio")


def _s2_cell_to_grid(cell):
    """S2 cells are users, as the cells of S1."""
    return (cell % S.GRID_ROWS).cast("int"), F.floor(cell / S.GRID_ROWS).cast("int")


def _forcing_sql() -> str:
    from firn.plans.q_forcing import _W02
    return _W02 + f""",
  fc AS (SELECT CAST(cell % {S.GRID_ROWS} AS INT) AS lat_i, CAST(cell // {S.GRID_ROWS} AS INT) AS lon_i,
                CAST(run_date AS TIMESTAMP) + to_hours(CAST(hour AS BIGINT)) AS time, run_date AS run, rate AS tp FROM h),
  lt AS (SELECT lat_i, lon_i, time, tp FROM (
           SELECT *, row_number() OVER (PARTITION BY lat_i, lon_i, time ORDER BY run DESC) AS rn FROM fc) WHERE rn = 1),
  u AS (SELECT lat_i, lon_i, time, value AS tp, 1 AS prio FROM s1 WHERE source = 'reanalysis'
        UNION ALL SELECT lat_i, lon_i, time, tp, 2 FROM lt)"""


@register("chain_hourly_forcing", S.with_ctes(f"""
SELECT lat_i, lon_i, time, {rnd_sql('min_by(tp, prio) FILTER (WHERE tp IS NOT NULL)')} AS tp,
       min(prio) FILTER (WHERE tp IS NOT NULL) AS src_prio
FROM u GROUP BY lat_i, lon_i, time""", "s1", "s2", extra=_forcing_sql()))
def chain_hourly_forcing(t: Tables):
    """Forecast runs deaccumulated and interpolated to hours, latest run per
    hour, then merged under the reanalysis (S2 runs, S1 reanalysis)."""
    from firn.plans.q_forcing import S2_SWITCH
    rean = S.s1(t).where(F.col("source") == "reanalysis").select("lat_i", "lon_i", "time", F.col("value").alias("tp"))
    out = hourly_forcing(S.s2(t), rean, ["run_date", "cell"], _s2_cell_to_grid, switch=S2_SWITCH)
    return out.select("lat_i", "lon_i", "time", rnd("tp").alias("tp"), "src_prio")
