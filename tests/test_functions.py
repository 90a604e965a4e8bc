import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daygrid.functions import dates as D
from daygrid.functions import files as FF
from daygrid.functions import text as T


def py_normalize_text(v):
    if v is None:
        return ""
    t = unicodedata.normalize("NFKD", str(v).strip())
    return "".join(c for c in t if not unicodedata.combining(c)).lower()


def py_normalize_key(v):
    t = re.sub(r"[^a-z0-9]+", "_", py_normalize_text(v))
    return re.sub(r"_+", "_", t).strip("_")


ALPHABET = st.sampled_from(
    list("abcXYZ 019_-.,;") + list("áéíóúñÑçÇüÜöÖäÄßèÈêÊàÀÁÉÍÓÚ") + ["́", "̃", "\t", "\n", " ", "ﬁ", "Ĳ"]
)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=24), min_size=1, max_size=8))
def test_normalize_matches_unicodedata(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v string")
    got = df.select(T.normalize_text("v").alias("t"), T.normalize_key("v").alias("k")).collect()
    for v, r in zip(values + [None], got):
        assert r["t"] == py_normalize_text(v)
        assert r["k"] == py_normalize_key(v)


def test_clean_code_edge_rows(spark):
    rows = [("0021.00",), (" 21-45 7 ",), ("ABC.0",), ("12.50",), (None,), ("",)]
    got = [r[0] for r in spark.createDataFrame(rows, "c string").select(T.clean_code("c")).collect()]
    assert got == ["0021", "21457", "ABC", "1250", None, ""]
    ints = spark.createDataFrame([(21,), (-5,), (None,)], "c bigint")
    assert [r[0] for r in ints.select(T.clean_code("c", ints.schema["c"].dataType)).collect()] == ["21", "5", None]


def test_decimal_comma_and_lenient(spark):
    rows = [("6,25",), ("-75,5 m",), ("abc",), ("",), ("1.2.3",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "v string").select(T.decimal_comma_double("v")).collect()]
    assert got == [6.25, -75.5, None, None, None, None]
    got = [r[0] for r in spark.createDataFrame([("12",), ("x",), (" 3.5 ",)], "v string").select(T.lenient_double("v")).collect()]
    assert got == [12.0, None, 3.5]


def test_lenient_timestamp_formats(spark):
    rows = [("2021-03-04 10:00:00",), ("2021-03-04T10:00:00+05:00",), ("2021/03/04",), ("03/04/2021",), ("25/12/2021",), ("nope",), (None,)]
    df = spark.createDataFrame(rows, "v string")
    got = [r[0] for r in df.select(F.date_format(D.lenient_timestamp(F.col("v")), "yyyy-MM-dd HH:mm").alias("t")).collect()]
    assert got == ["2021-03-04 10:00", "2021-03-04 10:00", "2021-03-04 00:00", "2021-03-04 00:00", "2021-12-25 00:00", None, None]


def test_calendar_monday_is_zero(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-06",), ("2024-01-07",)], "d string").select(F.to_date("d").alias("date"))
    got = df.withColumns(D.calendar_columns("date")).select("day_of_week", "is_weekend", "day_of_year").collect()
    assert [(r[0], r[1]) for r in got] == [(0, 0), (5, 1), (6, 1)]


def test_keyword_flag(spark):
    df = spark.createDataFrame([("Inundación súbita",), ("AVENIDA TORRENCIAL",), ("Sequía",), (None,)], "t string")
    got = [r[0] for r in df.select(T.contains_any("t", ["inund", "crecient", "avenida torrencial", "desbord"])).collect()]
    assert got == [1, 1, 0, 0]


def test_file_classification_edge_paths(spark):
    rows = [
        ("chirps/2021/x.tif.gz", "x.tif.gz", 10),
        ("misc/README", "README", 1),
        ("Precipitación IDEAM/DATA.CSV", "DATA.CSV", 300 * 1024 * 1024),
        ("ground truth inundaciones/eventos_2021-03-04.csv", "eventos_2021-03-04.csv", 1000),
        ("sar sentinel-1/s1_20210304.tif", "s1_20210304.tif", 5),
        ("open-meteo/meteo_2021_03.csv", "meteo_2021_03.csv", 5),
        ("datos_comprimidos/a.zip", "a.zip", 5),
        ("otros/b.zip", "b.zip", 5),
        ("dem/raster-2021.tif", "raster-2021.tif", 150 * 1024 * 1024),
        ("mapbiomas/cov.geojson", "cov.geojson", 5),
        ("tr centros poblados/cp.shp", "cp.shp", 5),
    ]
    df = spark.createDataFrame(rows, "relative_path string, file_name string, size_bytes bigint")
    from daygrid.operators.inventory import classify_files

    got = {
        r["relative_path"]: r
        for r in classify_files(df).select(
            "relative_path", "extension", "readable_type_guess", "source_group", "date_detected_in_name", "suggested_phase"
        ).collect()
    }
    assert got["chirps/2021/x.tif.gz"]["extension"] == "tif.gz"
    assert got["chirps/2021/x.tif.gz"]["suggested_phase"] == "TOO_HEAVY_FOR_PHASE1_NOTEBOOK"
    assert got["misc/README"]["extension"] == "no_extension"
    assert got["misc/README"]["suggested_phase"] == "IGNORE_FOR_NOW"
    big = got["Precipitación IDEAM/DATA.CSV"]
    assert (big["extension"], big["source_group"], big["suggested_phase"]) == ("csv", "PRECIPITACION_IDEAM", "NEEDS_LIGHT_PREPROCESSING")
    gt = got["ground truth inundaciones/eventos_2021-03-04.csv"]
    assert (gt["suggested_phase"], gt["date_detected_in_name"]) == ("READY_FOR_PHASE1", "2021-03-04")
    assert got["sar sentinel-1/s1_20210304.tif"]["date_detected_in_name"] == "2021-03-04"
    assert got["open-meteo/meteo_2021_03.csv"]["date_detected_in_name"] == "2021-03"
    assert got["dem/raster-2021.tif"]["date_detected_in_name"] == "2021"
    assert got["dem/raster-2021.tif"]["suggested_phase"] == "TOO_HEAVY_FOR_PHASE1_NOTEBOOK"
    assert got["datos_comprimidos/a.zip"]["suggested_phase"] == "IGNORE_FOR_NOW"
    assert got["otros/b.zip"]["suggested_phase"] == "NEEDS_LIGHT_PREPROCESSING"
    assert got["mapbiomas/cov.geojson"]["suggested_phase"] == "NEEDS_HEAVY_GEOSPATIAL_PREPROCESSING"
    assert got["tr centros poblados/cp.shp"]["suggested_phase"] == "NEEDS_LIGHT_PREPROCESSING"


def test_compact_note_cut(spark):
    df = spark.createDataFrame([("a" * 500, "b"), ("x", "y")], "p string, q string")
    got = [r[0] for r in df.select(FF.compact_note("p", "q")).collect()]
    assert len(got[0]) == 420 and got[0].endswith("...")
    assert got[1] == "x | y"


def test_header_profile_and_json_shape(spark):
    df = spark.createDataFrame([("a;b;c\n1;2;3\n\n4;5;6\n", '{"type": "FeatureCollection", "features": [{"properties": {"x": 1, "y": 2}}]}')], "t string, j string")
    r = df.select(FF.header_profile("t", F.lit(";")).alias("h"), FF.json_shape("j").alias("s")).first()
    assert (r["h"]["sample_rows"], r["h"]["n_columns"], r["h"]["columns"]) == (2, 3, ["a", "b", "c"])
    assert (r["s"]["json_type"], r["s"]["feature_count"], r["s"]["property_keys"]) == ("dict", 1, ["x", "y"])


def test_common_date_spellings(spark):
    from daygrid.functions import dates as D

    texts = {
        "01/15/2024 12:00:00 AM": "2024-01-15 00:00:00", "01/15/2024 01:30:00 PM": "2024-01-15 13:30:00", "1/5/2024": "2024-01-05 00:00:00",
        "15/01/2024 3:05": "2024-01-15 03:05:00", "15-01-2024": "2024-01-15 00:00:00", "Jan 15 2024": "2024-01-15 00:00:00", "15 Jan 2024 4:05 PM": "2024-01-15 16:05:00",
        "January 15, 2024": "2024-01-15 00:00:00", "2024/1/5 7:08": "2024-01-05 07:08:00", "20240115": "2024-01-15 00:00:00", "2024-01-15T10:11:12": "2024-01-15 10:11:12",
        "32/13/2024": None, "soon": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", D.lenient_timestamp("t").cast("string").alias("p")).collect()
    assert {r["t"]: r["p"] for r in rows} == texts
    assert tuple(D.unparsed_count(df, "t").first()) == (len(texts), 2)


def test_header_resolution():
    from daygrid.sources.canonical import Headers

    h = Headers(["Código Estación", "CODIGO_estacion", "Fecha", "Fecha Observación", "valor", "Fecha evento"])
    assert h.best(["codigo"]) == "CODIGO_estacion"  # the later of two alike stands in the first's place
    assert h.best(["fecha"]) == "Fecha" and h.best(["fecha", "observacion"]) == "Fecha Observación"
    assert h.best(["fecha"], ["observacion", "evento"]) == "Fecha" and h.best(["valor"], ["valor"]) is None
    assert h.best(["lluvia"]) is None and h.best([]) is None and Headers([]).best(["x"]) is None
