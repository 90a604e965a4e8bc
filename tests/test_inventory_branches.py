"""The derived raw folder reaches every branch of the file inventory."""

from pyspark.sql import functions as F

from daygrid.functions import files as FF
from daygrid.operators import inventory as INV
from daygrid.plans import scalar_queries as Q


def test_branches(spark):
    d = "/root/testdata/sf0.01"
    rows = Q.file_classes(spark, d).collect()
    assert {r["source_group"] for r in rows} == set(FF.SOURCE_RULES)
    assert {r["readable_type_guess"] for r in rows} == {"tabular", "geospatial_vector", "raster", "compressed_archive", "other"}
    assert {r["suggested_phase"] for r in rows} >= {"IGNORE_FOR_NOW", "NEEDS_LIGHT_PREPROCESSING", "READY_FOR_PHASE1", "TOO_HEAVY_FOR_PHASE1_NOTEBOOK", "NEEDS_HEAVY_GEOSPATIAL_PREPROCESSING"}
    special = {FF.REASON_OTHER, FF.REASON_ARCHIVE, FF.REASON_BIG_TABLE, FF.REASON_HEAVY_RASTER, FF.REASON_RASTER, FF.REASON_VECTOR}
    reasons = {r["phase1_reason"] for r in rows}
    assert special <= reasons and {rule[1] for g, rule in FF.SOURCE_RULES.items() if g not in ("CHIRPS", "UNKNOWN")} <= reasons
    notes = [r["notes"] for r in Q.file_notes(spark, d).collect()]
    assert any(len(n) == FF.NOTE_MAX_LEN and n.endswith("...") for n in notes) and any("limit_reached(5)" in n for n in notes) and any("columns=" in n and len(n) < FF.NOTE_MAX_LEN for n in notes)
    quota = Q.file_quota(spark, d).collect()
    assert {(r["inspected"], r["inspect_skipped"]) for r in quota} == {(True, False), (False, True), (False, False)}
    counts = Q.file_counts(spark, d).collect()
    assert {r["value"] for r in counts if r["dimension"] == "extension"} >= {"csv", "txt", "tif.gz", "geojson", "zip", "gz", "rar", "untracked"}
    assert Q.file_rules_join(spark, d).count() == 13 and Q.file_groups_by_count(spark, d).count() == 12


def test_text_work_once_a_file(spark):
    """Filters and classes do not repeat the path and name work; the quota is computed once."""
    files = Q.raw_files(spark, "/root/testdata/sf0.001")
    classified = INV.classify_files(files)
    plan = classified.filter(F.col("readable_type_guess").isin(*INV.INSPECTABLE))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(lower(") + plan.count("regexp_extract(substring_index(lower(") <= 1 and plan.count("lower(file_name") + plan.count("lower(concat(F") <= 2
    quota = INV.inspection_quota(classified)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in quota


def test_extensions_and_groups_of_odd_names(spark):
    names = ["a.csv", ".hidden", "x.tar.gz", "m.TIF.GZ", "dir.v1/name", "a.", "..", "a\nb.csv", "b/.c", "é.TXT", "", None, "a.b\n"]
    paths = ["PRECIPITACIÓN IDEAM/a", "Precipitación\\ideam", "Topografía y Cartografía IGAC/x", "ﬁle/chirps", "mapbiomas", "", None]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(FF.file_extension("n")).collect()
    assert [r[0] for r in got] == ["csv", "", "gz", "tif.gz", "", "", "", "", "", "txt", "", None, "b\n"]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(FF.source_group("p")).collect()
    assert [r[0] for r in got] == ["PRECIPITACION_IDEAM", "UNKNOWN", "IGAC_TOPO_CARTO", "CHIRPS", "MAPBIOMAS", "UNKNOWN", "UNKNOWN"]
