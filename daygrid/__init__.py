"""daygrid: entity-day panels on Spark.

Source resolution and cleaning, daily aggregation on a dense entity x day
grid, rolling/lag features, next-day labels, missing flags and imputation,
profiling, temporal splits, baseline models and evaluation, all as lazy
DataFrame / SQL / Spark ML plans.
"""

__version__ = "0.1.0"
