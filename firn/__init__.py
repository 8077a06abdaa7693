"""firn: a Spark-native engine for gridded forcing, point series, rasters
and zonal products.

Every operator is a DataFrame -> DataFrame function built from native
Spark column expressions, joins, aggregates and windows, so Catalyst
plans, prunes and pushes down the whole chain.
"""

__version__ = "0.1.0"
