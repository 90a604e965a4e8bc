"""Readers, sinks and the three end-to-end entry points on temporary folders."""

import io
import json
import os
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from daygrid.plans import pipelines as PL
from daygrid.sources import canonical as C
from daygrid.sources import files as SF
from daygrid.sources import readers as R


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(text)


@pytest.fixture(scope="module")
def raw_root():
    root = tempfile.mkdtemp(prefix="daygrid-raw-")
    _write(
        f"{root}/Estaciones IDEAM/CNE_IDEAM.csv",
        "Codigo;Nombre;Municipio;Departamento;Latitud;Longitud;Altitud\n"
        "0021.00;A;Medellín;Antioquia;6,25;-75,5;1500\n"
        "0021;A2;Medellin;ANTIOQUIA;6,35;-75,6;1510\n"
        "33-1;B;Bello;Antioquia;6,3;-75,55;1400\n"
        "55;C;Cali;Valle;3,4;-76,5;1000\n",
    )
    _write(
        f"{root}/Ground Truth Inundaciones/historico_emergencias_antioquia.csv",
        "Fecha Evento,Municipio,Evento,Departamento\n"
        "2024-01-02 10:00,Medellín,INUNDACIÓN,Antioquia\n"
        "2024-01-03 09:00,Medellin,Creciente,Antioquia\n"
        "bad date,Bello,Inundación,Antioquia\n"
        "2024-01-05,Bello,Sismo,Antioquia\n",
    )
    _write(
        f"{root}/Open-Meteo/meteo_antioquia_progreso.csv",
        "time,codigoestacion,temperature_2m,relative_humidity_2m,wind_speed_10m\n"
        "2024-01-01T00:00,0021,20.5,80,3\n"
        "2024-01-01T01:00,0021,x,82,4\n"
        "2024-01-04T01:00,331,18,70,2\n",
    )
    _write(
        f"{root}/Precipitacion IDEAM/precipitacion_antioquia_final.csv",
        "CodigoEstacion|FechaObservacion|ValorObservado|DescripcionSensor\n"
        "0021|2024-01-01 01:00|2.0|Precipitación\n"
        "0021|2024-01-02 01:00|-1|Precipitación\n"
        "331|2024-01-04 01:00|5|Precipitación\n"
        "331|2024-01-04 02:00|7|Temperatura\n",
    )
    lvl = f"{root}/{PL.LEVEL_FOLDER}"
    os.makedirs(lvl, exist_ok=True)
    with zipfile.ZipFile(f"{lvl}/part1.zip", "w") as zf:
        zf.writestr("a.csv", "CodigoEstacion,Fecha,Valor,Parametro\n0021,2024-01-01,1.5,NIVEL\n0021,2024-01-02,1.7,NIVEL\n0021,2024-01-02,9,CAUDAL\n")
        zf.writestr("b.csv", "ignored,second,member\n")
    with zipfile.ZipFile(f"{lvl}/part2.zip", "w"):
        pass
    with open(f"{lvl}/broken.zip", "wb") as fh:
        fh.write(b"not a zip")
    return root


def test_sniff_delimiter_and_latin1(spark):
    root = tempfile.mkdtemp(prefix="daygrid-enc-")
    _write(f"{root}/a.csv", "x;y;z\n1;2;3\n")
    _write(f"{root}/b.csv", "nombre,valor\nMedellín,1\n", encoding="latin-1")
    assert R.sniff(spark, f"{root}/a.csv") == (";", "UTF-8")
    d, enc = R.sniff(spark, f"{root}/b.csv")
    assert (d, enc) == (",", "ISO-8859-1")
    assert R.read_csv(spark, f"{root}/b.csv").first()["nombre"] == "Medellín"


def test_canonicalize_loose_headers(spark):
    df = spark.createDataFrame([("1", "2024-01-01", "3", "4", "s")], ["Código Estación", "Fecha Observación", "VALOR", "Valor Observado", "Descripción Sensor"])
    out = C.canonicalize(df, C.RAIN)
    assert out.columns == ["time_raw", "precip_raw", "station_code_raw", "sensor_raw"]
    assert out.first()["precip_raw"] == "4"
    with pytest.raises(C.MissingColumns):
        C.canonicalize(df.select("VALOR"), C.RAIN)


def test_zip_parts(spark, raw_root):
    w = R.Warnings()
    parts = R.read_zip_parts(spark, f"{raw_root}/{PL.LEVEL_FOLDER}", w).collect()
    assert len(parts) == 3 and {p["param_raw"] for p in parts} == {"NIVEL", "CAUDAL"}
    assert any("broken.zip" in m for m in w.items)


def test_pick_file(spark, raw_root):
    files = SF.list_files(spark, raw_root)
    got = SF.pick_file_with_fallback(files, PL.RAIN_CHOICE).first()
    assert got["file_name"] == "precipitacion_antioquia_final.csv"


def test_build_from_folder_end_to_end(spark, raw_root):
    out = tempfile.mkdtemp(prefix="daygrid-out-")
    panel, meta = PL.build_from_folder(spark, raw_root, out, include_level=True)
    rows = {(r["municipio_key"], str(r["date"])): r for r in panel.collect()}
    assert meta["n_municipios"] == 2 and meta["rows"] == len(rows) == 2 * 4  # 2024-01-01..04 (labels shifted)
    assert meta["feature_count"] == len(meta["feature_columns"])
    m1 = rows[("medellin", "2024-01-01")]
    assert m1["flood_next_24h"] == 1 and m1["precip_mm_24h_sum"] == 2.0
    assert m1["meteo_obs_count_24h"] == 2.0 and m1["river_level_mean_24h"] == 1.5
    assert rows[("medellin", "2024-01-02")]["river_level_delta_24h"] == pytest.approx(0.2)
    b4 = rows[("bello", "2024-01-04")]
    assert b4["precip_mm_24h_sum"] == 5.0  # temperature sensor filtered out
    assert b4["precip_mm_24h_sum_missing"] == 0 and rows[("bello", "2024-01-01")]["precip_mm_24h_sum_missing"] == 1
    assert all(r[c] is not None for r in rows.values() for c in meta["feature_columns"])  # fully imputed
    back = R.reload_panel(spark, f"{out}/panel_csv", numeric=["precip_mm_24h_sum"])
    assert back.count() == len(rows)
    assert spark.read.parquet(f"{out}/panel_parquet").count() == len(rows)
    saved = json.loads("\n".join(r[0] for r in spark.read.text(f"{out}/panel_metadata").collect()))
    assert saved["rows"] == len(rows) and saved["parquet_saved"] is True


def test_inventory_from_folder(spark, raw_root):
    inv, summary = PL.inventory_from_folder(spark, raw_root)
    assert summary["total_files"] == 7
    rows = {r["file_name"]: r for r in inv.collect()}
    assert rows["historico_emergencias_antioquia.csv"]["suggested_phase"] == "READY_FOR_PHASE1"
    assert "n_columns=4" in rows["historico_emergencias_antioquia.csv"]["notes"]
    assert rows["broken.zip"]["readable_type_guess"] == "compressed_archive"
    assert summary["source_group_counts"]["DHIME_NIVEL_IDEAM"] == 3


def test_csv_quoting_and_first_lines(spark, tmp_path):
    from daygrid.sources import readers as R

    path = tmp_path / "q.csv"
    path.write_text('name,day,note\n"a ""b"", c",2024-01-01,x\nplain,2024-01-02,"two\nlines"\n')
    rows = R.read_csv(spark, str(path), multi_line=True).collect()
    assert [tuple(r) for r in rows] == [('a "b", c', "2024-01-01", "x"), ("plain", "2024-01-02", "two\nlines")]
    semi = tmp_path / "s.csv"
    semi.write_text("a;b;c\n" * 5 + "1,2,3,4,5,6,7,8,9\n" * 5000)
    assert R.sniff(spark, str(semi), sample_bytes=25)[0] == ";"


def test_preset_session_values_survive(spark):
    from daygrid.session import configure

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "12345")
    try:
        configure(spark)
        assert spark.conf.get(key) == "12345"
    finally:
        spark.conf.set(key, before)


def test_lost_rows_are_counted_by_reason(spark, raw_root):
    _, meta = PL.build_from_folder(spark, raw_root, include_level=True)
    said = meta["warnings"]
    assert "Event log: 1 rows with unreadable times." in said
    assert "Weather: 1 rows with unreadable numbers in temp_raw." in said
    assert "Precipitation: 1 rows with negative values." in said
    assert not any("department match" in w for w in said)


def test_sources_that_cannot_be_used_are_left_out(spark, raw_root, tmp_path):
    import shutil

    root = tmp_path / "raw"
    shutil.copytree(raw_root, root)
    _write(f"{root}/Precipitacion IDEAM/precipitacion_antioquia_final.csv", "FechaObservacion|ValorObservado\n2024-01-01 01:00|2.0\n")
    _write(f"{root}/Estaciones IDEAM/CNE_IDEAM.csv", "Codigo;Municipio;Departamento\n21;Medellín;Valle\n33;Bello;Valle\n")
    panel, meta = PL.build_from_folder(spark, str(root))
    assert "Precipitation file could not be mapped to municipio." in meta["warnings"]
    assert "Station catalog has no explicit antioquia department match; using full file." in meta["warnings"]
    assert not any(c.startswith("precip") for c in panel.columns) and "meteo_obs_count_24h" in panel.columns


def test_panel_files_by_size(spark, tmp_path):
    rows = [(f"k{i % 40}", f"2{y}-01-{1 + i // 40:02d}", 2000 + y) for y in (20, 21) for i in range(400 if y == 20 else 40)]
    df = spark.createDataFrame(rows, "municipio_key string, date string, year int").repartition(13)
    from daygrid.sources import sinks

    assert sinks.write_panel_parquet(df, str(tmp_path / "p"), file_rows=100)
    files = {y: [f for f in os.listdir(tmp_path / "p" / f"year={y}") if f.endswith(".parquet")] for y in (2020, 2021)}
    assert len(files[2021]) == 1 and 4 <= len(files[2020]) <= 8
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.count() == len(rows) and sorted(map(tuple, back.select(*df.columns).collect())) == sorted(rows)
    assert sinks.write_panel_parquet(df.drop("year"), str(tmp_path / "q"))


@pytest.fixture(scope="module")
def odd_tree():
    """Names that Spark's own listing hides, links, a link loop, hidden and generated folders."""
    root = tempfile.mkdtemp(prefix="daygrid-tree-")
    _write(f"{root}/_x/_part.csv", "a,b\n1,2\n")
    _write(f"{root}/.top.csv", "a;b\n")
    _write(f"{root}/.git/no.csv", "x")
    _write(f"{root}/__pycache__/no.csv", "x")
    _write(f"{root}/deep/er/still/a b.json", '{"k": 1, "l": 2}')
    _write(f"{root}/deep/long.csv", "h1,h2\n" + "1,2\n" * 1000)
    _write(f"{root}/deep/long.json", json.dumps({"type": "FeatureCollection", "features": [{"properties": {"p": 1}}] * 400}))
    _write(f"{root}/deep/list.json", "[1, 2]")
    _write(f"{root}/out/old.csv", "x")
    os.symlink(f"{root}/nowhere", f"{root}/dangling.csv")
    os.symlink(f"{root}/deep", f"{root}/linked")
    with zipfile.ZipFile(f"{root}/deep/z.zip", "w") as zf:
        zf.writestr("m1", "x")
        zf.writestr("m2", "y")
    with open(f"{root}/deep/bad.zip", "wb") as fh:
        fh.write(b"no archive")
    return root


def test_tree_lists_every_name(spark, odd_tree):
    rows = {r["relative_path"]: r for r in SF.list_tree(spark, odd_tree, skip=f"{odd_tree}/out").collect()}
    assert set(rows) == {"_x/_part.csv", ".top.csv", "deep/er/still/a b.json", "deep/long.csv", "deep/long.json", "deep/list.json", "deep/z.zip", "deep/bad.zip"}
    assert all(r["scan_error"] is None and r["size_bytes"] == os.path.getsize(f"{odd_tree}/{n}") and r["modification_time"] is not None for n, r in rows.items())
    assert {r["file_name"] for r in SF.list_files(spark, odd_tree, (".CSV",)).collect()} == {"_part.csv", ".top.csv", "long.csv", "old.csv"}


def test_what_cannot_be_read_is_a_row(spark, odd_tree, monkeypatch):
    rows = SF.list_tree(spark, f"{odd_tree}/not there").collect()
    assert len(rows) == 1 and rows[0]["scan_error"].startswith("list_error=FileNotFoundError")
    _, summary = PL.inventory_from_folder(spark, f"{odd_tree}/not there")
    assert summary["total_files"] == 0 and summary["n_scan_errors"] == 1 and "FileNotFoundError" in summary["scan_errors"][0]


def test_inspection_reads_first_bytes_only(spark, odd_tree):
    inv, summary = PL.inventory_from_folder(spark, odd_tree, outdir=None, max_inspect_per_group=9, inspect_bytes=64)
    notes = {r["relative_path"]: r["notes"] for r in inv.collect()}
    assert summary["scan_errors"] == [] and summary["total_files"] == 9
    assert "sample_rows=5; n_columns=2; columns=['h1', 'h2']" in notes["deep/long.csv"]
    assert "vector_inspection_skipped=larger_than(64)" in notes["deep/long.json"]
    assert "json_keys=['k', 'l']" in notes["deep/er/still/a b.json"] and "json_type=list" in notes["deep/list.json"]
    assert "zip_members=2; sample_members=['m1', 'm2']" in notes["deep/z.zip"] and "zip_inspection_error=BadZipFile" in notes["deep/bad.zip"]
    from daygrid.sources import storage

    heads = storage.first_bytes(spark.createDataFrame([(f"{odd_tree}/deep/long.csv",)], "path string"), 10).first()
    assert bytes(heads["head"]) == b"h1,h2\n1,2\n"


def test_streamed_parts(spark, monkeypatch, tmp_path):
    body = "CodigoEstacion,Fecha,Valor\n" + "".join(f"{i},2024-01-01,{i}.5\n" for i in range(2000))
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("a.csv", body)
    with zipfile.ZipFile(tmp_path / "cols.zip", "w") as zf:
        zf.writestr("c.csv", "x,y\n1,2\n")
    whole = (tmp_path / "a.zip").read_bytes()
    at = whole.index(b"a.csv") + 2500  # damaged inside: rows before the damage do not count
    (tmp_path / "cut.zip").write_bytes(whole[:at] + b"\x00" * 40 + whole[at + 40 :])
    monkeypatch.setattr(R, "PART_ROWS", 100)
    w = R.Warnings()
    rows = R.read_zip_parts(spark, str(tmp_path), w).collect()
    assert len(rows) == 2000 and {r["_part"] for r in rows} == {f"{tmp_path}/a.zip"}
    assert len(w.items) == 2 and any("cols.zip" in m and "missing required" in m for m in w.items) and any("cut.zip" in m for m in w.items)


def test_named_errors_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(R, "LISTED_ERRORS", 3)
    w = R.Warnings()
    w.add_rows("Bad", spark.createDataFrame([(f"p{i}", "e") for i in range(9)], "a string, b string"))
    assert w.items == ["Bad p0: e", "Bad p1: e", "Bad p2: e", "Bad: 9 in all, the first 3 listed"]
