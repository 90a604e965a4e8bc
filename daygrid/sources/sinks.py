"""Sinks (SRC10-SRC14, SRC16, TOP1).

Tables are written by every task in parallel (a folder of part files, never
funnelled through one task); small JSON records are written as one JSON
document.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DATE, KEY


def write_panel_csv(df: DataFrame, path: str, sort: bool = True) -> None:
    """SRC10 (+TOP1): header CSV part files, rows range-partitioned and sorted
    by (entity, day) so the concatenated parts are in order."""
    out = df.orderBy(KEY, DATE) if sort else df
    out.write.mode("overwrite").option("header", "true").csv(path)


#: Rows of the panel that a file holds at most.
FILE_ROWS = 2_000_000


def write_panel_parquet(df: DataFrame, path: str, partition_by: str | None = "year", warnings=None, file_rows: int = FILE_ROWS) -> bool:
    """SRC11: parquet partitioned by year; a failure is recorded, not raised.

    The rows of each year are counted first and dealt to as many files as they need, by
    entity, so neither tasks nor years multiply the number of files and no file grows
    with the panel."""
    try:
        if partition_by and partition_by in df.columns:
            sizes = {r[0]: r["count"] for r in df.groupBy(partition_by).count().collect()}  # a row a year
            files = {k: -(-n // file_rows) for k, n in sizes.items()}
            mine = F.coalesce(*[F.when(F.col(partition_by).eqNullSafe(F.lit(k)), F.lit(n)) for k, n in files.items()], F.lit(1))
            salted = df.withColumn("__file", F.pmod(F.xxhash64(KEY), mine))
            dealt = salted.repartition(max(1, sum(files.values())), partition_by, "__file").drop("__file")
            w = dealt.sortWithinPartitions(partition_by, KEY, DATE).write.mode("overwrite").option("maxRecordsPerFile", file_rows).partitionBy(partition_by)
        else:
            w = df.sortWithinPartitions(KEY, DATE).write.mode("overwrite").option("maxRecordsPerFile", file_rows)
        w.parquet(path)
        return True
    except Exception as exc:  # noqa: BLE001
        if warnings is not None:
            warnings.add(f"Parquet export skipped: {exc}")
        return False


def write_json_record(spark: SparkSession, record: dict[str, Any], path: str) -> None:
    """SRC12 / SRC14 / SRC16: one nested record as a JSON document."""
    text = json.dumps(record, ensure_ascii=False, indent=2, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


INVENTORY_COLUMNS = (
    "source_group",
    "relative_path",
    "file_name",
    "extension",
    "size_mb",
    "readable_type_guess",
    "date_detected_in_name",
    "suggested_phase",
    "notes",
)


def write_inventory_csv(inv: DataFrame, path: str) -> None:
    """SRC13: the nine inventory columns, header CSV."""
    inv.select(*INVENTORY_COLUMNS).write.mode("overwrite").option("header", "true").csv(path)
