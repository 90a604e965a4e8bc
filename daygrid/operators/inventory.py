"""File inventory over a file table (one row per file): classification, notes,
inspection quota, counts and the rule join (STR7-STR13, NUM1, WIN6, AGG10,
AGG11, JOIN9, TOP7).

Input: a DataFrame with ``relative_path`` (``/`` separated), ``file_name`` and
``size_bytes``; optionally ``inspect_result`` (text from a content probe such
as ``header_profile`` / ``json_shape``) and ``scan_error``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import files as FF
from .joins import join_bounded, join_small

INSPECTABLE = ("tabular", "geospatial_vector", "raster", "compressed_archive")


def classify_files(files: DataFrame) -> DataFrame:
    """Per-file columns of the inventory, before notes.

    Extension and source group come out of a one-row ``inline``: they are computed once a
    file, where a filter or class built on plain columns would repeat their text work
    in every place that names them."""
    ext, group = FF.file_extension(F.col("file_name")), FF.source_group(F.col("relative_path"))
    out = files.drop("__ext", "source_group").select(
        "*", F.inline(F.array(F.struct(ext.alias("__ext"), group.alias("source_group"))))
    )
    out = out.withColumns(
        {
            "date_detected_in_name": FF.date_in_text(F.concat_ws(" ", F.col("relative_path"), F.col("file_name"))),
            "size_mb": FF.size_mb(F.col("size_bytes")),
        }
    )
    out = out.withColumn("readable_type_guess", FF.readable_type(F.col("__ext")))
    phase = FF.usability_class(F.col("source_group"), F.col("readable_type_guess"), F.col("__ext"), F.col("size_mb"))
    return out.withColumn("__phase", phase).withColumns(
        {
            "suggested_phase": F.col("__phase.phase"),
            "extension": F.when(F.col("__ext") == "", F.lit("no_extension")).otherwise(F.col("__ext")),
            "extension_raw": F.col("__ext"),
        }
    )


def inspection_quota(inv: DataFrame, max_per_group: int = 5) -> DataFrame:
    """WIN6: the first ``max_per_group`` inspectable files per (source group,
    type), in path order, are inspected; the others are marked skipped.

    ``row_number() <= n`` is planned as a WindowGroupLimit that keeps n rows
    per group in every partition before the shuffle, so a group holding most
    files never reaches one task whole; the small chosen set is written once (its
    count and the join read it) and joined back on the (unique) path."""
    w = Window.partitionBy("source_group", "readable_type_guess").orderBy("relative_path")
    inspectable = F.col("readable_type_guess").isin(*INSPECTABLE)
    chosen = (
        inv.filter(inspectable)
        .select("source_group", "readable_type_guess", "relative_path")
        .withColumn("__rn", F.row_number().over(w))
        .filter(F.col("__rn") <= max_per_group)
        .select("relative_path", F.lit(True).alias("inspected"))
    )
    return (
        join_small(inv, chosen, "relative_path", "left", materialize=True)
        .withColumn("inspected", F.coalesce(F.col("inspected"), F.lit(False)))
        .withColumn("inspect_skipped", inspectable & ~F.col("inspected"))
    )


def with_notes(inv: DataFrame, max_per_group: int = 5) -> DataFrame:
    """STR12: ``phase1_reason=… | can_convert…=YES/NO | <inspection>``, cut at 420."""
    can = F.when(F.col("__phase.can_convert"), F.lit("YES")).otherwise(F.lit("NO"))
    probe = F.col("inspect_result") if "inspect_result" in inv.columns else F.lit(None).cast("string")
    third = (
        F.when(F.col("inspected"), probe)
        .when(F.col("inspect_skipped"), F.lit(f"inspection_skipped=limit_reached({max_per_group}) for source/type"))
    )
    return inv.withColumn(
        "notes",
        FF.compact_note(
            F.concat(F.lit("phase1_reason="), F.col("__phase.reason")),
            F.concat(F.lit("can_convert_to_municipio_fecha="), can),
            third,
        ),
    )


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


def inventory_counts(inv: DataFrame) -> DataFrame:
    """AGG10: (dimension, value, file_count) for extension (unsupported ->
    'untracked'), source group and phase, plus the total, in one grouping-sets pass."""
    ext = F.when(F.col("extension").isin(*FF.SUPPORTED_EXTENSIONS), F.col("extension")).otherwise(F.lit("untracked"))
    base = inv.select(ext.alias("e"), F.col("source_group").alias("g"), F.col("suggested_phase").alias("p"))
    stacked = base.select(
        F.inline(
            F.array(
                F.struct(F.lit("extension").alias("dimension"), F.col("e").alias("value")),
                F.struct(F.lit("source_group").alias("dimension"), F.col("g").alias("value")),
                F.struct(F.lit("phase").alias("dimension"), F.col("p").alias("value")),
                F.struct(F.lit("total").alias("dimension"), F.lit("all").alias("value")),
            )
        )
    )
    return stacked.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("file_count"))


def rules_frame(spark: SparkSession) -> DataFrame:
    """The fixed source rules as a small DataFrame (13 rows)."""
    rows = [(g, r[0], r[1], r[2]) for g, r in FF.SOURCE_RULES.items()]
    return spark.createDataFrame(
        rows, "source_group string, default_phase string, phase1_reason string, can_convert_to_municipio_fecha boolean"
    )


def source_rationale(inv: DataFrame) -> DataFrame:
    """JOIN9: file count per source group with its rule (UNKNOWN rule as default)."""
    rules = rules_frame(inv.sparkSession)
    counts = inv.groupBy("source_group").agg(F.count(F.lit(1)).alias("file_count"))
    # Rules are a fixed 13-row table; the UNKNOWN defaults are literals.
    u = FF.SOURCE_RULES["UNKNOWN"]
    return join_bounded(counts, rules, "source_group", "left").select(
        "source_group",
        "file_count",
        F.coalesce(F.col("default_phase"), F.lit(u[0])).alias("default_phase"),
        F.coalesce(F.col("phase1_reason"), F.lit(u[1])).alias("phase1_reason"),
        F.coalesce(F.col("can_convert_to_municipio_fecha"), F.lit(u[2])).alias("can_convert_to_municipio_fecha"),
    )


def top_source_groups(inv: DataFrame, n: int = 12) -> DataFrame:
    """TOP7: source groups by file count (ties by name)."""
    return (
        inv.groupBy("source_group")
        .agg(F.count(F.lit(1)).alias("file_count"))
        .orderBy(F.desc("file_count"), F.asc("source_group"))
        .limit(n)
    )


def error_sample(files: DataFrame, limit: int = 1000) -> DataFrame:
    """AGG11: number of scan errors and the first ``limit`` of them (by path).

    The ordered limit keeps at most ``limit`` rows per partition before the
    merge, so the list never holds more than ``limit`` entries."""
    errs = files.filter(F.col("scan_error").isNotNull())
    first = errs.orderBy("relative_path", "scan_error").limit(limit)
    listed = first.agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct(F.col("relative_path"), F.col("scan_error")))),
            lambda s: F.concat_ws(": ", s["relative_path"], s["scan_error"]),
        ).alias("scan_errors")
    )
    n = errs.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return listed.select(n.alias("n_errors"), "scan_errors")
