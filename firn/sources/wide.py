"""Wide tables of any number of zones (IO05, IO06, A03): CSV files cut into chunks of columns.

A chunk is a folder with the columns of some zones: a header line and a line for each key.  A table of (zone, chunk) says where a
zone stands.  Lines are put together from arrays inside the tasks, so the plan is the same for ten zones and for a
million, and no list of zones comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firn.sources.textio import stored

_FIELD = r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'


def _quoted(c: Column) -> Column:
    """A field of a CSV line."""
    return F.when(c.rlike(r'[",\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def _fields(line: Column) -> Column:
    """The fields of a CSV line."""
    raw = F.regexp_extract_all(line, F.lit(_FIELD), F.lit(1))
    return F.transform(raw, lambda x: F.when(x.startswith('"'), F.replace(
        F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))


def zone_chunks(zones: DataFrame, zone_col: str = "zone", per_chunk: int = 1000) -> DataFrame:
    """(zone, chunk): as many chunks as the zones need, by a hash of the name; about ``per_chunk`` zones in each."""
    zones = stored(zones.select(zone_col).where(F.col(zone_col).isNotNull()).distinct(), "zone-names")
    chunks = max(1, -(-zones.count() // per_chunk))
    return zones.withColumn("chunk", F.pmod(F.xxhash64(zone_col), F.lit(chunks).cast("long")).cast("int"))


def write_wide_chunks(long: DataFrame, path: str, key: str, zone_col: str = "zone", value_col: str = "mean", per_chunk: int = 1000) -> None:
    """Long -> wide files (IO06): every key of ``long`` in every chunk; a value that is not there is an empty field."""
    long = stored(long.select(key, zone_col, value_col), "long")
    spots = zone_chunks(long, zone_col, per_chunk)
    keys = long.agg(F.sort_array(F.collect_set(key))).scalar()  # dates
    names = stored(spots.groupBy("chunk").agg(F.sort_array(F.collect_list(zone_col)).alias("names")), "zone-chunks")
    places = names.select("chunk", F.posexplode("names").alias("_at", zone_col))
    # the values of a line in the order of its columns; a column may have one (a map refuses a second)
    values = long.join(places, zone_col).groupBy("chunk", key).agg(F.sort_array(F.map_entries(F.map_from_entries(F.collect_list(F.struct(
        F.col("_at"), F.col(value_col).cast("string")))))).alias("of"))
    grid = names.select("chunk", F.size("names").alias("_width"), F.explode(keys).alias(key))
    # before each value the commas since the one before, behind the last those to the end: no look-up of each column
    place = lambda i: F.coalesce(F.get("of", i)["key"], F.lit(-1))
    cells = F.transform("of", lambda x, i: F.concat(F.repeat(F.lit(","), x["key"] - place(i - 1)), F.coalesce(x["value"], F.lit(""))))
    line = F.concat(F.coalesce(F.array_join(cells, ""), F.lit("")), F.repeat(F.lit(","), F.col("_width") - 1 - place(F.size("of") - 1)))
    rows = grid.join(values, ["chunk", key], "left").select("chunk", F.lit(1).alias("_order"), key, F.concat(
        F.col(key).cast("string"), line).alias("value"))
    header = names.select("chunk", F.lit(0).alias("_order"), F.lit(None).cast(long.schema[key].dataType).alias(key), F.concat_ws(
        ",", F.lit(key), F.array_join(F.transform("names", _quoted), ",")).alias("value"))
    lines = header.unionByName(rows)
    (lines.repartition("chunk").sortWithinPartitions("chunk", "_order", key).select("chunk", "value")
     .write.mode("errorifexists").partitionBy("chunk").text(path))


def number_repeats(names: Column) -> Column:
    """Repeated names get .1, .2, ... behind their second, third, ... place."""
    def numbered(name, k):
        before = F.size(F.filter(F.slice(names, F.lit(1), k), lambda x: x == name))
        return F.when(before > 0, F.concat(name, F.lit("."), before.cast("string"))).otherwise(name)
    # names that all differ, the usual case, need not be compared with each other
    return F.when(F.size(F.array_distinct(names)) == F.size(names), names).otherwise(F.transform(names, numbered))


def read_wide_chunks(spark: SparkSession, path: str, key: str, key_type: str = "date", zone_col: str = "zone",
                     value_col: str = "mean", wanted: DataFrame | None = None) -> DataFrame:
    """Wide files -> long (IO05): (key, zone, value).  A header is a line that begins with the name of the key; each folder
    (chunk) has its own, and all files in it the same columns.  ``wanted`` is a table of zones to keep."""
    lines = spark.read.schema("value string, chunk int").text(path).where(F.col("value") != "")
    fields = lines.select("chunk", "value", F.substring_index("value", ",", 1).alias("_key"))
    headers = fields.where(F.col("_key").isin(key, f'"{key}"')).groupBy("chunk").agg(F.any_value("value").alias("_header"))
    headers = headers.select("chunk", _fields(F.col("_header")).alias("_h"))
    headers = headers.select("chunk", number_repeats(F.slice("_h", F.lit(2), F.size("_h"))).alias("_names"))
    rows = fields.where(~F.col("_key").isin(key, f'"{key}"')).join(headers, "chunk")
    cells = F.split("value", ",")  # numbers and dates have no quotes
    rows = rows.select(F.col("_key").cast(key_type).alias(key), F.explode(F.arrays_zip(
        F.col("_names").alias("z"), F.slice(cells, F.lit(2), F.size(cells)).alias("v"))).alias("c"))
    out = rows.select(key, F.col("c.z").alias(zone_col), F.when(F.col("c.v") != "", F.col("c.v")).cast("double").alias(value_col))
    return out if wanted is None else out.join(wanted.select(zone_col).distinct(), zone_col, "left_semi").select(out.columns)
