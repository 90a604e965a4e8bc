"""File-inventory expressions: extension, type class, source group, dates in
names, usability class, notes, header profile, JSON shape.

All are plain column expressions (``when`` chains, regex extraction), applied
to a file table of any size with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _col, normalize_text

# ---------------------------------------------------------------------------
# These must equal the reference's to give the same results.
# ---------------------------------------------------------------------------

SUPPORTED_EXTENSIONS = (
    "csv", "txt", "xlsx", "xls", "shp", "gpkg", "geojson", "json", "kml",
    "tif", "tiff", "tif.gz", "zip", "rar", "gz",
)

TYPE_CLASSES = (
    ("tabular", ("csv", "txt", "xlsx", "xls")),
    ("geospatial_vector", ("shp", "gpkg", "geojson", "json", "kml")),
    ("raster", ("tif", "tiff", "tif.gz")),
    ("compressed_archive", ("zip", "rar", "gz")),
)

# Ordered keyword -> source group; the first keyword found in the normalized
# relative path wins.
SOURCE_KEYWORDS = (
    ("precipitacion ideam", "PRECIPITACION_IDEAM"),
    ("estaciones meteorologicas ideam", "ESTACIONES_IDEAM"),
    ("open-meteo", "OPEN_METEO"),
    ("topografia y cartografia igac", "IGAC_TOPO_CARTO"),
    ("mapbiomas", "MAPBIOMAS"),
    ("tr centros poblados", "TR_CENTROS_POBLADOS"),
    ("ground truth inundaciones", "GROUND_TRUTH_INUNDACIONES"),
    ("chirps", "CHIRPS"),
    ("sar sentinel-1", "SENTINEL1_GEE"),
    ("google earth engine", "SENTINEL1_GEE"),
    ("smap humedad suelo", "SMAP_SUELO"),
    ("dhime ideam nivel", "DHIME_NIVEL_IDEAM"),
    ("datos_comprimidos", "DATOS_COMPRIMIDOS"),
)

# Source group -> (default phase, reason, can convert to entity-day).
SOURCE_RULES = {
    "PRECIPITACION_IDEAM": (
        "NEEDS_LIGHT_PREPROCESSING",
        "Series de precipitacion son valiosas para MLP, pero requieren limpieza "
        "y agregacion a municipio-fecha.",
        True,
    ),
    "ESTACIONES_IDEAM": (
        "NEEDS_LIGHT_PREPROCESSING",
        "Metadatos y/o series de estaciones IDEAM; requieren unificacion de codigos, "
        "georreferenciacion y agregacion espacial.",
        True,
    ),
    "OPEN_METEO": (
        "NEEDS_LIGHT_PREPROCESSING",
        "Datos meteorologicos tabulares suelen ser utiles para MLP, con mapeo "
        "a municipios y estandarizacion temporal.",
        True,
    ),
    "IGAC_TOPO_CARTO": (
        "NEEDS_HEAVY_GEOSPATIAL_PREPROCESSING",
        "Topografia/cartografia es clave como covariable estatica, pero requiere "
        "procesamiento geoespacial (zonal stats) para volverlo tabular.",
        True,
    ),
    "MAPBIOMAS": (
        "NEEDS_HEAVY_GEOSPATIAL_PREPROCESSING",
        "Cobertura del suelo aporta variables de susceptibilidad, pero requiere "
        "agregacion espacial por municipio (y eventualmente por anio).",
        True,
    ),
    "TR_CENTROS_POBLADOS": (
        "NEEDS_LIGHT_PREPROCESSING",
        "Capas de centros poblados sirven para exposicion/vulnerabilidad; "
        "normalmente necesitan joins espaciales y agregados simples.",
        True,
    ),
    "GROUND_TRUTH_INUNDACIONES": (
        "READY_FOR_PHASE1",
        "Fuente candidata para variable objetivo (ocurrencia de inundacion), "
        "prioritaria para construir etiqueta binaria.",
        True,
    ),
    "CHIRPS": (
        "TOO_HEAVY_FOR_PHASE1_NOTEBOOK",
        "Rasters diarios masivos; util para features de lluvia, pero conviene "
        "preagregar fuera de notebook a tabla municipio-fecha.",
        True,
    ),
    "SENTINEL1_GEE": (
        "NEEDS_HEAVY_GEOSPATIAL_PREPROCESSING",
        "SAR aporta senales hidricas valiosas, pero requiere pipeline geoespacial "
        "y temporal para extraer estadisticos tabulares.",
        True,
    ),
    "SMAP_SUELO": (
        "NEEDS_HEAVY_GEOSPATIAL_PREPROCESSING",
        "Humedad del suelo es util para inundaciones, pero suele venir en grillas "
        "o formatos pesados que requieren agregacion espacial/temporal.",
        True,
    ),
    "DHIME_NIVEL_IDEAM": (
        "NEEDS_LIGHT_PREPROCESSING",
        "Niveles hidrologicos de IDEAM son utiles para predictor auxiliar; "
        "requieren limpieza temporal y consolidacion por area/municipio.",
        True,
    ),
    "DATOS_COMPRIMIDOS": (
        "IGNORE_FOR_NOW",
        "Contenedor de archivos comprimidos (posibles duplicados o staging). "
        "Conviene priorizar datos ya extraidos para Fase 1.",
        False,
    ),
    "UNKNOWN": (
        "IGNORE_FOR_NOW",
        "Fuente no identificada automaticamente; revisar manualmente si aporta "
        "a tabla municipio-fecha.",
        False,
    ),
}

# Phase decisions that override the source default.
REASON_OTHER = "Archivo no identificado como insumo de datos principal."
REASON_ARCHIVE = "Archivo comprimido; extraer y validar contenido antes de usarlo en tabla tabular."
REASON_BIG_TABLE = "Tabular potencialmente util, pero voluminoso; conviene lectura por chunks y agregacion."
REASON_HEAVY_RASTER = "Raster pesado; mejor preprocesar fuera del notebook y convertir a municipio-fecha."
REASON_RASTER = "Raster requiere extraccion geoespacial para generar features tabulares."
REASON_VECTOR = "Vector util tras joins espaciales/agregacion a municipio."
HEAVY_RASTER_GROUPS = ("CHIRPS", "SENTINEL1_GEE", "MAPBIOMAS")
HEAVY_VECTOR_GROUPS = ("IGAC_TOPO_CARTO", "MAPBIOMAS", "SENTINEL1_GEE")
BIG_TABLE_MB = 250
BIG_RASTER_MB = 100
NOTE_MAX_LEN = 420

# Dates in names: y-m-d with separator, yyyymmdd, y-m, bare 20xx year.
DATE_PATTERNS = (
    r"(20\d{2})[._-](0[1-9]|1[0-2])[._-](0[1-9]|[12]\d|3[01])",
    r"(20\d{2})(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])",
    r"(20\d{2})[._-](0[1-9]|1[0-2])",
    r"\b(20\d{2})\b",
)

# ---------------------------------------------------------------------------


def file_extension(name: ColumnOrName) -> Column:
    """STR7: lower-cased last suffix without the dot, ``tif.gz`` kept whole."""
    lower = F.lower(_col(name))
    # Path(...).suffix: the part after the last '.', unless the name starts with it.
    plain = F.regexp_extract(F.substring_index(lower, "/", -1), r"^.+\.([^.]*)$", 1)
    return F.when(lower.endswith(".tif.gz"), F.lit("tif.gz")).otherwise(plain)


def readable_type(ext: ColumnOrName) -> Column:
    """STR8: type class from the extension."""
    e = _col(ext)
    out = None
    for label, exts in TYPE_CLASSES:
        cond = e.isin(list(exts))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit("other"))


def source_group(path: ColumnOrName) -> Column:
    """STR9: first source keyword contained in the normalized path, else UNKNOWN."""
    text = normalize_text(F.replace(_col(path), F.lit("\\"), F.lit("/")), trim=False)

    def first(t: Column) -> Column:
        out = None
        for kw, group in SOURCE_KEYWORDS:
            cond = t.contains(kw)
            out = F.when(cond, F.lit(group)) if out is None else out.when(cond, F.lit(group))
        return out.otherwise(F.lit("UNKNOWN"))

    return F.get(F.transform(F.array(text), first), F.lit(0))  # the path is normalized once, not for every keyword


def date_in_text(text: ColumnOrName) -> Column:
    """STR10: first matching date pattern as partial ISO text, else ''."""
    t = _col(text)
    ymd = DATE_PATTERNS[0]
    compact = DATE_PATTERNS[1]
    ym = DATE_PATTERNS[2]
    year = DATE_PATTERNS[3]

    def found(p: str) -> Column:
        return t.rlike(p)

    def ext(p: str, i: int) -> Column:
        return F.regexp_extract(t, p, i)

    return (
        F.when(found(ymd), F.concat_ws("-", ext(ymd, 1), ext(ymd, 2), ext(ymd, 3)))
        .when(found(compact), F.concat_ws("-", ext(compact, 1), ext(compact, 2), ext(compact, 3)))
        .when(found(ym), F.concat_ws("-", ext(ym, 1), ext(ym, 2)))
        .when(found(year), ext(year, 1))
        .otherwise(F.lit(""))
    )


def size_mb(length_bytes: ColumnOrName) -> Column:
    """NUM1: bytes -> MB rounded to 4 places."""
    return F.round(_col(length_bytes).cast("double") / F.lit(1024.0 * 1024.0), 4)


def _rule_col(group: Column, idx: int) -> Column:
    out = None
    for g, rule in SOURCE_RULES.items():
        val = F.lit(rule[idx])
        cond = group == F.lit(g)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(F.lit(SOURCE_RULES["UNKNOWN"][idx]))


def usability_class(
    group: ColumnOrName, rtype: ColumnOrName, ext: ColumnOrName, mb: ColumnOrName
) -> Column:
    """STR11: struct(phase, reason, can_convert) decided in the reference order."""
    g, t, e, m = _col(group), _col(rtype), _col(ext), _col(mb)
    default_phase, default_reason, can = _rule_col(g, 0), _rule_col(g, 1), _rule_col(g, 2)

    def pick(phase, reason, convert):
        return F.struct(phase.alias("phase"), reason.alias("reason"), convert.alias("can_convert"))

    lit = F.lit
    return (
        F.when(t == "other", pick(lit("IGNORE_FOR_NOW"), lit(REASON_OTHER), lit(False)))
        .when(
            e.isin("zip", "rar", "gz") & (g == "DATOS_COMPRIMIDOS"),
            pick(default_phase, default_reason, can),
        )
        .when(t == "compressed_archive", pick(lit("NEEDS_LIGHT_PREPROCESSING"), lit(REASON_ARCHIVE), can))
        .when(
            (g == "GROUND_TRUTH_INUNDACIONES") & (t == "tabular"),
            pick(lit("READY_FOR_PHASE1"), default_reason, can),
        )
        .when(
            (t == "tabular") & (m > BIG_TABLE_MB),
            pick(lit("NEEDS_LIGHT_PREPROCESSING"), lit(REASON_BIG_TABLE), can),
        )
        .when(
            (t == "raster") & (g.isin(*HEAVY_RASTER_GROUPS) | (m > BIG_RASTER_MB)),
            pick(lit("TOO_HEAVY_FOR_PHASE1_NOTEBOOK"), lit(REASON_HEAVY_RASTER), can),
        )
        .when(t == "raster", pick(lit("NEEDS_HEAVY_GEOSPATIAL_PREPROCESSING"), lit(REASON_RASTER), can))
        .when(
            (t == "geospatial_vector") & g.isin(*HEAVY_VECTOR_GROUPS),
            pick(lit("NEEDS_HEAVY_GEOSPATIAL_PREPROCESSING"), default_reason, can),
        )
        .when(t == "geospatial_vector", pick(lit("NEEDS_LIGHT_PREPROCESSING"), lit(REASON_VECTOR), can))
        .otherwise(pick(default_phase, default_reason, can))
    )


def compact_note(*parts: ColumnOrName, max_len: int = NOTE_MAX_LEN) -> Column:
    """STR12: parts joined by ' | ', cut to max_len-3 + '...' when longer."""
    note = F.concat_ws(" | ", *[_col(p) for p in parts])
    return F.when(
        F.char_length(note) > max_len, F.concat(F.substring(note, 1, max_len - 3), F.lit("..."))
    ).otherwise(note)


def gzip_member_guess(name: ColumnOrName) -> Column:
    """STR13: file name without a trailing ``.gz`` (case-insensitive)."""
    n = _col(name)
    return F.when(
        F.lower(n).endswith(".gz"), F.substring(n, F.lit(1), F.char_length(n) - 3)
    ).otherwise(n)


def header_profile(text: ColumnOrName, sep: ColumnOrName, sample_rows: int = 5) -> Column:
    """STR14: struct(sample_rows, n_columns, columns[<=12]) of a delimited text."""
    t = _col(text)
    # the header and the first sample_rows lines that are not empty; the rest is not split
    head = rf"\A([^\r\n]*+)((?:[\r\n]++[^\r\n]++){{0,{sample_rows}}})"
    body = F.filter(F.split(F.regexp_extract(t, head, 2), r"[\r\n]+"), lambda x: F.length(x) > 0)
    header = F.split(F.regexp_extract(t, head, 1), F.concat(F.lit("\\Q"), _col(sep), F.lit("\\E")))
    return F.struct(
        F.least(F.size(body), F.lit(sample_rows)).alias("sample_rows"),
        F.size(header).alias("n_columns"),
        F.slice(header, 1, 12).alias("columns"),
    )


def json_shape(text: ColumnOrName) -> Column:
    """JSN1: struct(json_type, keys[<=12], feature_count, property_keys[<=12])."""
    t = _col(text)
    keys = F.json_object_keys(t)
    is_fc = F.get_json_object(t, "$.type") == F.lit("FeatureCollection")
    n_feat = F.json_array_length(F.get_json_object(t, "$.features"))
    props = F.json_object_keys(F.get_json_object(t, "$.features[0].properties"))
    return F.struct(
        F.when(keys.isNotNull(), F.lit("dict"))
        .when(F.json_array_length(t).isNotNull(), F.lit("list"))
        .otherwise(F.lit("other"))
        .alias("json_type"),
        F.slice(keys, 1, 12).alias("keys"),
        F.when(is_fc, F.coalesce(n_feat, F.lit(0))).alias("feature_count"),
        F.when(is_fc, F.coalesce(F.slice(props, 1, 12), F.array().cast("array<string>"))).alias(
            "property_keys"
        ),
    )
