"""End-to-end entry points: inventory of a raw folder, panel build from raw
sources, and train/evaluate on a panel. Each is a composition of the
operators; the only values brought to the driver are chosen file paths,
scalar bounds/metrics and small result tables.
"""

from __future__ import annotations

import datetime as _dt
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import lenient_timestamp
from ..functions.text import normalize_text
from ..operators import evaluate as EV
from ..operators import features as FE
from ..operators import inventory as INV
from ..operators import models as MD
from ..operators.impute import feature_columns
from ..operators.panel import PanelOptions, build_panel
from ..operators.split import split_report, temporal_split
from ..schema import DATE, FLOOD_EVENT_KEYWORDS, KEY, NAME, NON_FEATURES, TARGET
from ..session import cut_lineage
from ..sources import canonical as C
from ..sources import files as SF
from ..sources import readers as R
from ..sources import sinks as K
from ..sources import storage as ST

# Keyword sets the reference uses to choose each source file,
# in fallback order, as (include, exclude).
STATIONS_CHOICE = [(["estaciones", "ideam"], ["chirps", "sentinel", "mapbiomas"])]
EVENTS_CHOICE = [(["historico", "emergencias", "antioquia"], []), (["ground", "truth", "inund"], [])]
WEATHER_CHOICE = [(["meteo", "antioquia", "progreso"], []), (["open", "meteo"], [])]
RAIN_CHOICE = [(["precipitacion", "antioquia", "final"], []), (["precipitacion", "antioquia"], [])]
LEVEL_FOLDER = "DHIME IDEAM nivel"
REGION = "antioquia"
#: First bytes of a file that its inspection reads.
INSPECT_BYTES = 4 << 20


def _pick(files: DataFrame, choices) -> str | None:
    row = SF.pick_file_with_fallback(files, choices).select("path").first()
    return row["path"] if row else None


def _counted(df: DataFrame, notes: list, what: str, lost: dict[str, Column]) -> DataFrame:
    """``df`` observed while it is read: ``notes`` gets (what, observation) with the number
    of rows for each reason in ``lost``, so that counting them costs no pass of its own."""
    seen = Observation()
    notes.append((what, seen))
    return df.observe(seen, *[F.count_if(F.coalesce(c, F.lit(False))).alias(reason) for reason, c in lost.items()])


def _no_time(df: DataFrame, col: str) -> Column:
    raw = F.col(col).cast("string")
    return raw.isNotNull() & (F.trim(raw) != "") & lenient_timestamp(F.col(col), df.schema[col].dataType).isNull()


def _no_number(col: str) -> Column:
    return F.col(col).isNotNull() & F.col(col).try_cast("double").isNull()


def _has_place(df: DataFrame) -> bool:
    return bool({"station_code_raw", "municipio_raw"} & set(df.columns))


def build_from_folder(
    spark: SparkSession,
    raw_root: str,
    outdir: str | None = None,
    start: Any = None,
    end: Any = None,
    include_level: bool = False,
    region: str | None = REGION,
) -> tuple[DataFrame, dict]:
    """Entry 1: discover sources, canonicalize, build and (optionally) write the panel.

    Rows that are lost on the way (unreadable times and numbers, negative rain)
    are counted by reason while the sources are read, and reported with what is missing
    in ``warnings``; optional sources that cannot be used are left out."""
    warnings = R.Warnings()
    notes: list = []
    used: dict[str, str | None] = {}
    files = SF.list_files(spark, raw_root)
    if files.limit(1).count() == 0:
        raise FileNotFoundError(f"No tabular files found under {raw_root}")

    st = _pick(files, STATIONS_CHOICE)
    if st is None:
        raise FileNotFoundError("No station catalogue file found.")
    used["stations"] = st
    catalogue = C.canonicalize(R.read_table(spark, st), C.CATALOGUE)
    if region and "departamento_raw" in catalogue.columns:
        if catalogue.filter(normalize_text(F.col("departamento_raw")).contains(region)).isEmpty():
            warnings.add(f"Station catalog has no explicit {region} department match; using full file.")

    gt = _pick(files, EVENTS_CHOICE)
    if gt is None:
        raise FileNotFoundError("No ground truth event table found.")
    used["ground_truth"] = gt
    events = C.canonicalize(R.read_table(spark, gt), C.EVENTS)
    events = _counted(events, notes, "Event log", {"unreadable times": _no_time(events, "event_time_raw")})

    mt = _pick(files, WEATHER_CHOICE)
    if mt is None:
        raise FileNotFoundError("No weather file found.")
    used["weather"] = mt
    weather = C.canonicalize(R.read_table(spark, mt), C.WEATHER)
    measured = [c for c in ("temp_raw", "rh_raw", "wind_raw") if c in weather.columns]
    lost = {"unreadable times": _no_time(weather, "time_raw")} | {f"unreadable numbers in {c}": _no_number(c) for c in measured}
    weather = _counted(weather, notes, "Weather", lost)

    rain = None
    pr = _pick(files, RAIN_CHOICE)
    raw_rain = R.read_optional(spark, pr, warnings, "Precipitation")
    if raw_rain is not None:
        used["precip"] = pr
        try:
            rain = C.canonicalize(raw_rain, C.RAIN)
        except C.MissingColumns as exc:
            warnings.add(f"Precip file missing required columns: {exc}")
    if rain is not None and not _has_place(rain):
        warnings.add("Precipitation file could not be mapped to municipio.")
        rain = None
    if rain is not None:
        value = F.col("precip_raw").try_cast("double")
        rain = _counted(rain, notes, "Precipitation", {"unreadable times": _no_time(rain, "time_raw"), "unreadable numbers": _no_number("precip_raw"), "negative values": value < 0})

    level = None
    if include_level:
        root = raw_root.rstrip("/") + "/" + LEVEL_FOLDER
        try:
            level = R.read_zip_parts(spark, root, warnings)
            used["level"] = root
            level = _counted(level, notes, "Level", {"unreadable times": _no_time(level, "time_raw"), "unreadable numbers": _no_number("level_raw")})
        except Exception as exc:  # noqa: BLE001 - absent folder degrades the block
            warnings.add(f"Level folder not usable; skipping level features ({exc}).")

    options = PanelOptions(region=region, keywords=FLOOD_EVENT_KEYWORDS, start=start, end=end)
    panel = cut_lineage(build_panel(catalogue, events, weather, rain, level, options))
    for what, seen in notes:  # all sources have been read by now
        try:
            lost = seen.get
        except Py4JJavaError:  # a source without rows is planned away, and its metrics with it
            continue
        for reason, n in lost.items():
            if n:
                warnings.add(f"{what}: {n} rows with {reason}.")
    meta = panel_metadata(panel)
    meta.update(used_sources=used, warnings=warnings.items)
    if outdir:
        K.write_panel_csv(panel, f"{outdir}/panel_csv")
        meta["parquet_saved"] = K.write_panel_parquet(panel, f"{outdir}/panel_parquet", warnings=warnings)
        K.write_json_record(spark, meta, f"{outdir}/panel_metadata")
    return panel, meta


def panel_metadata(panel: DataFrame) -> dict:
    """AGG9 + IMP3: rows, entities, date range and the feature list."""
    row = panel.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(KEY).alias("n"), F.min(DATE).alias("lo"), F.max(DATE).alias("hi")
    ).first()
    feats = feature_columns(panel)
    return {
        "grain": "entity-day",
        "target": f"{TARGET} (binary)",
        "rows": row["rows"],
        "n_municipios": row["n"],
        "date_min": str(row["lo"]),
        "date_max": str(row["hi"]),
        "feature_count": len(feats),
        "feature_columns": feats,
    }


def inventory_from_folder(
    spark: SparkSession, root: str, outdir: str | None = None, max_inspect_per_group: int = 5, sample_rows: int = 5, inspect_bytes: int = INSPECT_BYTES
) -> tuple[DataFrame, dict]:
    """Entry 2: classify every file under ``root``; inspect the first few
    per (source group, type) from their first ``inspect_bytes`` bytes; counts, summary
    and what could not be read."""
    tree = ST.list_tree(spark, root, skip=outdir)
    files = tree.filter(F.col("scan_error").isNull())
    classified = INV.inspection_quota(INV.classify_files(files), max_inspect_per_group)
    probes = _inspect(classified.filter(F.col("inspected")), sample_rows, inspect_bytes)
    inv = INV.with_notes(classified.join(probes, "path", "left"), max_inspect_per_group).select(*INV.INVENTORY_COLUMNS)
    inv = cut_lineage(inv)
    counts = {(r["dimension"], r["value"]): r["file_count"] for r in INV.inventory_counts(inv).collect()}
    summary = {
        "scan_timestamp": _dt.datetime.now().isoformat(),
        "root": root,
        "total_files": counts.get(("total", "all"), 0),
        "extension_counts": dict(sorted((v, n) for (d, v), n in counts.items() if d == "extension")),
        "source_group_counts": dict(sorted((v, n) for (d, v), n in counts.items() if d == "source_group")),
        "phase_counts": dict(sorted((v, n) for (d, v), n in counts.items() if d == "phase")),
        "source_group_phase1_rationale": {r["source_group"]: r.asDict() for r in INV.source_rationale(inv).collect()},
    }
    errors = INV.error_sample(tree).first()
    summary |= {"n_scan_errors": errors["n_errors"], "scan_errors": errors["scan_errors"]}
    if outdir:
        K.write_inventory_csv(inv, f"{outdir}/dataset_inventory_csv")
        K.write_json_record(spark, summary, f"{outdir}/dataset_inventory_summary")
    return inv, summary


def _inspect(chosen: DataFrame, sample_rows: int, inspect_bytes: int) -> DataFrame:
    """Inspection text of the chosen files (at most ``max_inspect_per_group`` per group and
    type), from their first bytes, read by the tasks. A JSON document that does not end
    within them is not counted, and said to be larger."""
    from ..functions import files as FF

    heads = ST.first_bytes(chosen, inspect_bytes).join(chosen.select("path", "size_bytes"), "path")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    ext = FF.file_extension(name)
    longer = F.col("size_bytes") > inspect_bytes
    text = F.make_valid_utf8(F.col("head").cast("string"))
    text = F.when(longer, F.regexp_replace(text, r"[^\n]*+\z", "")).otherwise(text)  # no broken last line
    prof = FF.header_profile(text, SF.detect_delimiter(F.col("head")), sample_rows)
    shape = FF.json_shape(text)
    quoted = lambda names: F.concat(F.lit("["), F.array_join(F.transform(names, lambda c: F.concat(F.lit("'"), c, F.lit("'"))), ", "), F.lit("]"))
    is_json = ext.isin("geojson", "json")
    kind = F.when(ext.isin("csv", "txt"), "tabular").when(ext == "zip", "zip").when(is_json, "vector").otherwise("file")
    result = (
        F.when(F.col("error").isNotNull(), F.concat(kind, F.lit("_inspection_error="), F.col("error")))
        .when(ext.isin("csv", "txt"), F.format_string("sample_rows=%d; n_columns=%d; columns=%s", prof["sample_rows"], prof["n_columns"], quoted(prof["columns"])))
        .when(is_json & longer, F.lit(f"vector_inspection_skipped=larger_than({inspect_bytes})"))
        .when(is_json & (shape["feature_count"] == 0), F.lit("geojson_features=0; properties=[]"))
        .when(is_json & shape["feature_count"].isNotNull(), F.format_string("geojson_features~%d; properties=%s", shape["feature_count"], quoted(shape["property_keys"])))
        .when(is_json & (shape["json_type"] == "dict"), F.concat(F.lit("json_keys="), quoted(shape["keys"])))
        .when(is_json, F.concat(F.lit("json_type="), shape["json_type"]))
        .when(ext == "zip", F.format_string("zip_members=%d; sample_members=%s", F.size("members"), quoted(F.slice("members", 1, 8))))
        .when(ext == "rar", F.lit("rar_inspection=requires_optional_rar_support"))
        .when(ext == "gz", F.concat(F.lit("gz_member_guess="), FF.gzip_member_guess(name)))
        .when(ext == "tif.gz", F.lit("raster_meta=compressed_tif_gz (extract required)"))
    )
    return heads.select("path", result.alias("inspect_result"))


def train_and_evaluate(spark: SparkSession, panel: DataFrame, outdir: str | None = None, seed: int = 42, dataset_path: str | None = None) -> tuple[dict, DataFrame]:
    """Entry 3: usable features, temporal split, train-fitted imputation and
    scaling, balanced logistic regression and an oversampled 64-32 network,
    metrics per split, threshold sweep on validation and its best threshold on test, test
    view. With ``outdir`` each model is saved together with its imputer and scaler, as a
    ``PipelineModel`` that scores raw panel rows."""
    panel = cut_lineage(panel)
    feats = FE.usable_features(panel)
    sp = cut_lineage(temporal_split(panel))
    train = sp.filter(F.col("split") == "train")
    med = FE.train_medians(train, feats)
    feats = [c for c in feats if med.get(c) is not None]
    stats = FE.scaling_stats(FE.impute(train, med), feats)
    ready = cut_lineage(FE.standardize(FE.impute(sp, med), stats))
    train = ready.filter(F.col("split") == "train")

    counts = FE.class_counts(train)
    weights, balanced = FE.balanced_weights(train, counts=counts)
    lr = MD.fit_logistic(FE.with_weights(train, weights), feats)
    over, sizes = FE.oversample_minority(train.select(*feats, TARGET), seed=seed) if balanced else (train, {"used": False})
    mlp = MD.fit_mlp(over, feats, seed=seed)

    scored = MD.score(lr, ready, feats, "p_lr", "pred_lr")
    scored = cut_lineage(MD.score(mlp, scored, feats, "p_mlp", "pred_mlp"))
    long = scored.select(
        "split",
        F.col(TARGET).alias("y_true"),
        F.inline(F.array(F.struct(F.lit("logistic_regression").alias("model"), F.col("p_lr").alias("p")), F.struct(F.lit("mlp").alias("model"), F.col("p_mlp").alias("p")))),
    )
    table = EV.classification_metrics(long, "y_true", "p", ["model", "split"])
    results = {f"{r['model']}|{r['split']}": r.asDict() for r in table.collect()}
    sweep = EV.threshold_sweep(long.filter((F.col("model") == "mlp") & (F.col("split") == "validation")), "y_true", "p", ["model"])
    thresholds = cut_lineage(EV.best_threshold(sweep, ["model"]))
    best = thresholds.first()
    view = scored.filter(F.col("split") == "test").select(
        DATE, NAME, F.col(TARGET).alias("y_true"), "p_lr", "p_mlp", "pred_lr", "pred_mlp", F.to_date(DATE).alias("day")
    )
    at_best = EV.metrics_at(long.filter((F.col("model") == "mlp") & (F.col("split") == "test")), "y_true", "p", thresholds, ["model"]).first()
    report = {r["split"]: r for r in split_report(ready).collect()}
    payload = {
        "timestamp": _dt.datetime.now(_dt.timezone.utc).isoformat(),
        "dataset_path": dataset_path,
        "dataset_shape": [panel.count(), len(panel.columns)],
        "target_positive_rate": panel.agg(F.avg(F.col(TARGET).cast("double"))).first()[0],
        "excluded_columns": sorted(NON_FEATURES),
        "usable_feature_columns": feats,
        "n_features": len(feats),
        "split": {f"{s}_dates": [str(report[s]["date_min"]), str(report[s]["date_max"])] for s in report} | {f"{s}_rows": report[s]["rows"] for s in report},
        "class_weight": "balanced" if balanced else None,
        "oversampling": sizes,
        "models": results,
        "mlp_best_validation_threshold": best["best_threshold"] if best else None,
        "mlp_test_at_best_threshold": at_best.asDict() if at_best else None,
        "imputer": {c: med[c] for c in feats},
        "scaler": {c: {"mean": stats[c][0], "std": stats[c][1]} for c in feats},
    }
    if outdir:
        artifacts = {"baseline_model": f"{outdir}/logistic_regression", "mlp_model": f"{outdir}/mlp", "metrics": f"{outdir}/metrics"}
        for model, at in ((lr, "baseline_model"), (mlp, "mlp_model")):
            MD.applicable(model, feats, med, stats).write().overwrite().save(artifacts[at])
        payload["artifacts"] = artifacts
        K.write_json_record(spark, payload, artifacts["metrics"])
    return payload, view
