"""Point series and raster queries on S4a/S4b (pixels, cluster series) and
S5 (archive and latest point series)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from firn.functions.geodesy import tm_forward_sql
from firn.functions.numeric import rnd, rnd_sql
from firn.operators import points as PT
from firn.operators import raster as R
from firn.plans.registry import register
from firn.sources import standins as S
from firn.sources import textio
from firn.sources.tables import Tables

VARS = ["swe", "snd", "rof", "gst"]
# The J12 target grid (degrees; its rows follow the pixel rows), the height of a
# target cell and the source pixel size (m).
TARGET = dict(lon0=66.625, lat_top=40.64, res=0.005, n_lon=54)
TARGET_M, PIXEL = 555, 500.0


def q(body: str, *names: str, extra: str = "") -> str:
    return S.with_ctes(body, *names, extra=extra)


def s5_split(t: Tables):
    s = S.s5(t)
    return s.where(F.col("src") == "archive"), s.where(F.col("src") == "latest")


@register("a07_keep_last", q("""
SELECT src, prio, cluster, date, swe, snd FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster, date ORDER BY prio DESC, ord DESC) AS rn FROM s5)
WHERE rn = 1 OR cluster NOT IN (SELECT cluster FROM s5 GROUP BY cluster HAVING count(DISTINCT src) = 2)""", "s5"))
def a07_keep_last(t: Tables):
    """Archive overlaid by latest: whole row of the last copy per (cluster, date) of points that both
    have; points of one input unchanged."""
    a, l = (x.drop("src") for x in s5_split(t))
    src = F.when(F.col("prio") == 2, "latest").otherwise("archive")
    return PT.keep_last(a, l, ["cluster", "date"]).select(src.alias("src"), "prio", "cluster", "date", "swe", "snd")


@register("a07_one_sided", q("SELECT src, prio, cluster, date, swe, snd FROM s5 WHERE src = 'archive'", "s5"))
def a07_one_sided(t: Tables):
    """Only the archive exists: it passes through unchanged, duplicates kept."""
    a, _ = s5_split(t)
    return PT.keep_last(a, None, ["cluster", "date"]).drop("ord")


@register("j20_concat_runs", q("""
SELECT src, 'FSM_pt_' || CAST(cluster AS VARCHAR) AS name, date, swe, snd FROM s5
WHERE cluster IN (SELECT cluster FROM s5 WHERE src = 'archive')""", "s5"))
def j20_concat_runs(t: Tables):
    """Runs concatenated per point; point list taken from the first run."""
    s = S.s5(t).select("src", PT.point_name(F.col("cluster")).alias("name"), "date", "swe", "snd")
    return PT.concat_runs(s, "src", "name", "archive")


@register("u02_point_names", q("""
SELECT 'FSM_pt_' || CAST(cluster AS VARCHAR) AS name FROM s5 WHERE src = 'archive'
UNION SELECT 'FSM_pt_' || CAST(cluster AS VARCHAR) FROM s5 WHERE src = 'latest'""", "s5"))
def u02_point_names(t: Tables):
    """Distinct union of the point names of archive and latest."""
    a, l = s5_split(t)
    nm = lambda d: d.select(PT.point_name(F.col("cluster")).alias("name"))
    return PT.name_union(nm(a), nm(l))


@register("so01_natural_sort", q("""
SELECT name, array_to_string(list_transform(regexp_extract_all(name, '([0-9]+|[^0-9]+)', 1),
         lambda x: CASE WHEN regexp_full_match(x, '[0-9]+')
           THEN length(length(ltrim(x[:-2], '0') || x[-1])::VARCHAR) || length(ltrim(x[:-2], '0') || x[-1])::VARCHAR || ':' || ltrim(x[:-2], '0') || x[-1]
           ELSE lower(x) END), '|') AS sort_key
FROM (SELECT DISTINCT CASE WHEN cluster % 3 = 0 THEN 'fsm_pt_' ELSE 'FSM_pt_' END || CASE WHEN cluster % 5 = 0 THEN '10000000000000000000' ELSE '' END
      || CAST(cluster AS VARCHAR) AS name FROM s5)""", "s5"))
def so01_natural_sort(t: Tables):
    """Point names in natural order (digit runs numeric, case folded)."""
    c = F.col("cluster")
    names = S.s5(t).select(F.concat(F.when(c % 3 == 0, "fsm_pt_").otherwise("FSM_pt_"),
                                    F.when(c % 5 == 0, "1" + "0" * 19).otherwise(""), c.cast("string")).alias("name")).distinct()
    return names.select("name", PT.natural_sort_key(F.col("name")).alias("sort_key")).orderBy("sort_key")


@register("so02_hydro_sort", q("""
SELECT *, row_number() OVER (PARTITION BY cluster, hydro_month, dom ORDER BY ord) AS rank FROM (
  SELECT cluster, date, swe, snd, CAST(CASE WHEN month(date) < 9 THEN month(date) + 12 ELSE month(date) END AS INT) AS hydro_month,
         CAST(day(date) AS INT) AS dom, ord FROM s5 WHERE src = 'archive')""", "s5"))
def so02_hydro_sort(t: Tables):
    """Archive series in hydrological order (Sep first, year ignored, stable); ``rank`` shows the order
    among the rows of one calendar day."""
    a, _ = s5_split(t)
    day = Window.partitionBy("cluster", "hydro_month", "dom").orderBy("ord")
    return (PT.hydro_sort(a, ["cluster"], "date", "ord")
            .select("cluster", "date", "swe", "snd", "hydro_month", "dom", "ord", F.row_number().over(day).cast("bigint").alias("rank")))


# What the text queries leave out, to show how a missing value is written.
_NULLED = "CASE WHEN day(date) % 7 = 0 THEN NULL ELSE {v} END"


def gappy_series(t: Tables):
    """S4b with no snd on every seventh day of the month."""
    return S.s4b(t).withColumn("snd", F.when(F.dayofmonth("date") % 7 != 0, F.col("snd")))


def _text_value(v: str) -> str:
    return rnd_sql(_NULLED.format(v=v) if v == "snd" else v)


@register("io03_text_roundtrip", q(f"""
SELECT cluster, CAST(date AS TIMESTAMP) AS time, {', '.join(f"{_text_value(v)} AS {v}" for v in VARS)} FROM s4b""", "s4b"))
def io03_text_roundtrip(t: Tables):
    """Cluster series with missing values written as per-point whitespace text and parsed back."""
    path = textio.scratch_path(t.spark, "points")
    s = gappy_series(t).select(PT.point_name(F.col("cluster")).alias("point"),
                               F.col("date").cast("timestamp_ntz").alias("time"), *VARS)
    textio.write_point_text(s, path, "point", "time", VARS)
    back = textio.read_point_text(t.spark, path, VARS)
    return back.select("cluster", "time", *[rnd(v).alias(v) for v in VARS])


_LONG = """
, lg AS (SELECT cluster, date, variable, value FROM s4b UNPIVOT (value FOR variable IN (swe, snd, rof, gst)))"""


def s4b_long(t: Tables):
    return S.s4b(t).unpivot(["cluster", "date"], VARS, "variable", "value")


@register("a11_var_by_cluster", q(f"SELECT cluster, date, variable, {rnd_sql('value')} AS value FROM lg", "s4b", extra=_LONG))
def a11_var_by_cluster(t: Tables):
    """Point variables gathered long: (cluster, date, variable, value)."""
    return s4b_long(t).withColumn("value", rnd("value"))


@register("p17_product_names", q(f"""
SELECT cluster, date, variable,
       CASE variable WHEN 'swe' THEN 'SWE' WHEN 'snd' THEN 'HS' WHEN 'rof' THEN 'ROF' WHEN 'gst' THEN 'GST' ELSE upper(variable) END AS product,
       CASE variable WHEN 'swe' THEN 'mm' WHEN 'snd' THEN 'm' WHEN 'rof' THEN 'mm' WHEN 'gst' THEN 'k' END AS unit,
       {rnd_sql('value')} AS value FROM lg""", "s4b", extra=_LONG))
def p17_product_names(t: Tables):
    """Model variables renamed to product names and units."""
    name, unit = R.product_names(F.col("variable"))
    return s4b_long(t).select("cluster", "date", "variable", name.alias("product"), unit.alias("unit"),
                              rnd("value").alias("value"))


@register("p21_first_band", q(f"""
SELECT cluster, date, 1 AS band, {rnd_sql('swe')} AS value FROM s4b""", "s4b"))
def p21_first_band(t: Tables):
    """First band of a stacked raster (bands = swe, snd, rof, gst)."""
    stack = s4b_long(t).withColumn("band", (F.array_position(F.array(*[F.lit(v) for v in VARS]),
                                                             F.col("variable"))).cast("int"))
    return R.first_band(stack).select("cluster", "date", "band", rnd("value").alias("value"))


@register("p22_first_timestep", q("""
SELECT lat_i, lon_i, CAST(time AS DATE) AS date, min_by(value, time) AS value, min(time) AS first_time
FROM s1 WHERE source = 'reanalysis' GROUP BY 1, 2, 3""", "s1"))
def p22_first_timestep(t: Tables):
    """Per cell and day the value of the first timestep of that day."""
    s = S.s1(t).where(F.col("source") == "reanalysis")
    return R.first_timestep(s, ["lat_i", "lon_i"], "time", "value")


@register("g05_grid_coords", q(f"""
SELECT pixel, row_i, col_i,
       (SELECT min(x - col_i * {PIXEL}) FROM s4a) - {PIXEL / 2} + col_i * {PIXEL} AS x_corner,
       (SELECT max(y + row_i * {PIXEL}) FROM s4a) + {PIXEL / 2} - row_i * {PIXEL} AS y_corner
FROM s4a""", "s4a"))
def g05_grid_coords(t: Tables):
    """Pixel corner coordinates from the rebuilt grid origin."""
    return R.corner_coords(S.s4a(t), PIXEL, PIXEL).select("pixel", "row_i", "col_i", "x_corner", "y_corner")


@register("j15_cluster_to_pixel", q(f"""
SELECT pixel, row_i, col_i, date, {', '.join(f"{rnd_sql(v)} AS {v}" for v in VARS)}
FROM s4a JOIN s4b USING (cluster)""", "s4a", "s4b"))
def j15_cluster_to_pixel(t: Tables):
    """Cluster series spread over their pixels."""
    j = R.cluster_to_pixel(S.s4a(t), S.s4b(t))
    return j.select("pixel", "row_i", "col_i", "date", *[rnd(v).alias(v) for v in VARS])


_EX, _NY = tm_forward_sql("t_lon", "t_lat")
_J12 = f"""
, tr AS (SELECT DISTINCT CAST(row_i * {int(PIXEL)} // {TARGET_M} AS INT) AS t_row FROM s4a),
  tg AS (SELECT t_row, CAST(unnest(range({TARGET['n_lon']})) AS INT) AS t_col FROM tr),
  tc AS (SELECT t_row, t_col, {TARGET['lon0']} + (t_col + 0.5) * {TARGET['res']} AS t_lon,
                {TARGET['lat_top']} - (t_row + 0.5) * {TARGET['res']} AS t_lat FROM tg),
  org AS (SELECT min(x) - {PIXEL / 2} AS x_left, max(y) + {PIXEL / 2} AS y_top FROM s4a),
  tp AS (SELECT t_row, t_col, CAST(floor(({_EX} - x_left) / {PIXEL}) AS INT) AS col_i,
                CAST(floor((y_top - {_NY}) / {PIXEL}) AS INT) AS row_i FROM tc, org)"""


@register("j12_reproject", q(f"""
SELECT t_row, t_col, date, {rnd_sql('swe')} AS swe
FROM tp JOIN s4a USING (row_i, col_i) JOIN s4b USING (cluster)""", "s4a", "s4b", extra=_J12))
def j12_reproject(t: Tables):
    """Daily SWE reprojected from the UTM pixel grid to a lon/lat grid (nearest)."""
    px = S.s4a(t)
    o = px.agg(F.struct(F.min("x").alias("x"), F.max("y").alias("y"))).scalar()
    x_left, y_top = o.getField("x") - F.lit(PIXEL / 2), o.getField("y") + F.lit(PIXEL / 2)
    rows = px.select(F.floor(F.col("row_i") * int(PIXEL) / TARGET_M).cast("int").alias("t_row")).distinct()
    m = R.reproject_nearest(R.target_grid(rows, **TARGET), px.select("row_i", "col_i", "cluster"), x_left, y_top, PIXEL)
    j = R.cluster_to_pixel(m, S.s4b(t).select("cluster", "date", "swe"))
    return j.select("t_row", "t_col", "date", rnd("swe").alias("swe"))


# Pixels per cluster of M01, its seed and number of mini-batches.
MEMBERS, SEED, MINI_BATCHES = 50, 2, 4
FEATURES = [f"f{i}" for i in range(7)]


def _draw_sql(use: str, col: str = "id") -> str:
    return f"('0x' || substr(md5('{SEED}:{use}:' || {col}::varchar), 1, 8))::bigint"


def _nearest_sql(points: str, centres: str) -> str:
    """Every point against every centre."""
    gap = " + ".join(f"(p.z[{i}] - c.z[{i}]) * (p.z[{i}] - c.z[{i}])" for i in range(1, 8))
    return f"SELECT p.id, p.z, arg_min(c.cluster, ({gap}, c.cluster)) AS cluster FROM {points} p, {centres} c GROUP BY p.id, p.z"


def _clusters_sql() -> str:
    """Mini-batch k-means round by round, nearest centres by brute force."""
    unit = ", ".join(f"coalesce(floor(({f} - avg({f}) OVER ()) / nullif(stddev_samp({f}) OVER (), 0) * 65536.0 + 0.5)::bigint, 0)" for f in FEATURES)
    ctes = [f"pt AS (SELECT pixel AS id, [{unit}] AS z FROM s7)",
            f"c0 AS (SELECT id AS cluster, 0::bigint AS n, z FROM pt WHERE {_draw_sql('seed')} % {MEMBERS} = 0 OR id = (SELECT arg_min(id, ({_draw_sql('seed')}, id)) FROM pt))"]
    for k in range(MINI_BATCHES):
        at = ", ".join(f"CASE WHEN m > 0 THEN floor((n * c.z[{i}] + s[{i}])::double / (n + m))::bigint ELSE c.z[{i}] END" for i in range(1, 8))
        ctes += [f"p{k} AS (SELECT * FROM pt WHERE {_draw_sql('batch')} % {MINI_BATCHES} = {k})", f"n{k} AS ({_nearest_sql(f'p{k}', f'c{k}')})",
                 f"m{k} AS (SELECT cluster, count(*) AS m, [{', '.join(f'sum(z[{i}])::bigint' for i in range(1, 8))}] AS s FROM n{k} GROUP BY cluster)",
                 f"c{k + 1} AS (SELECT c.cluster, n + coalesce(m, 0) AS n, [{at}] AS z FROM c{k} c LEFT JOIN m{k} USING (cluster))"]
    return ",\n".join([*ctes, f"lab AS ({_nearest_sql('pt', f'c{MINI_BATCHES}')})"])


def clustered(t: Tables):
    from firn.operators.cluster import cluster_pixels
    return cluster_pixels(S.s7(t), "pixel", FEATURES, members=MEMBERS, seed=SEED, batches=MINI_BATCHES)


@register("m01_cluster_pixels", q("SELECT id AS pixel, cluster FROM lab", "s7", extra=_clusters_sql()))
def m01_cluster_pixels(t: Tables):
    """Pixels clustered by seven standardised features; the same rounds by brute force give the same labels."""
    return clustered(t)[0].select("pixel", "cluster")


@register("m01_centroids", q(f"""
SELECT cluster, count(*) AS n_pixels, {', '.join(f"{rnd_sql(f'avg({f})')} AS {f}" for f in FEATURES)}
FROM lab JOIN s7 ON id = pixel GROUP BY cluster""", "s7", extra=_clusters_sql()))
def m01_centroids(t: Tables):
    """Means of the raw member features and number of members of each cluster."""
    return clustered(t)[1].select("cluster", "n_pixels", *[rnd(f).alias(f) for f in FEATURES])


@register("io04_text_sink", q(f"""
SELECT cluster, count(*) AS n_lines, {', '.join(f"count({_text_value(v)}) AS n_{v}, {rnd_sql(f'sum({_text_value(v)})')} AS {v}" for v in VARS)}
FROM s4b GROUP BY cluster""", "s4b"))
def io04_text_sink(t: Tables):
    """Lines and values written per point file by the whitespace text sink."""
    path = textio.scratch_path(t.spark, "points-sink")
    s = gappy_series(t).select(PT.point_name(F.col("cluster")).alias("point"),
                               F.col("date").cast("timestamp_ntz").alias("time"), *VARS)
    textio.write_point_text(s, path, "point", "time", VARS)
    field = F.split("value", " ")
    value = {v: F.when(field[4 + k] != textio.MISSING, rnd(field[4 + k].cast("double"))) for k, v in enumerate(VARS)}
    cl = F.regexp_extract(F.col("point"), r"_(\d+)$", 1).cast("bigint")
    return t.spark.read.text(path).groupBy(cl.alias("cluster")).agg(
        F.count(F.lit(1)).alias("n_lines"), *[x for v in VARS for x in (F.count(value[v]).alias(f"n_{v}"), rnd(F.sum(value[v])).alias(v))])
