"""Registered queries for scalar text/date/number functions, filters and the
file inventory, each over whole driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import files as FF
from ..functions import text as T
from ..operators import filters as FL
from ..operators import inventory as INV
from ..sources import files as SF
from . import analogues as S
from .registry import query, sql_clean_code, sql_norm_key, sql_norm_text, sql_strip


def _t(spark, d, name):
    return S.table(spark, d, name)


# ---------------------------------------------------------------------------
# STR1 / STR2 on whole documents
# ---------------------------------------------------------------------------


@query(
    "normalize_key_docs",
    f"""
SELECT doc_id, {sql_norm_text('text')} AS text_norm, {sql_norm_key('text')} AS text_key
FROM documents
""",
)
def normalize_key_docs(spark: SparkSession, d: str) -> DataFrame:
    """STR1 + STR2 over every document's full text."""
    docs = _t(spark, d, "documents")
    return docs.select("doc_id", T.normalize_text("text").alias("text_norm"), T.normalize_key("text").alias("text_key"))


@query(
    "entity_key_columns",
    f"""
SELECT c_custkey, {sql_strip('c_name')} AS municipio_name, {sql_norm_key(sql_strip('c_name'))} AS municipio_key
FROM customer WHERE {sql_norm_key(sql_strip('c_name'))} <> ''
""",
)
def entity_key_columns(spark: SparkSession, d: str) -> DataFrame:
    """STR4 + FLT7: display name and key from a raw name column."""
    c = _t(spark, d, "customer").select("c_custkey", *[v.alias(k) for k, v in T.entity_columns(F.col("c_name")).items()])
    return FL.non_empty_key(c, "municipio_key")


@query(
    "station_code_clean",
    f"""
SELECT c_custkey,
  {sql_clean_code('c_name')} AS code_name,
  {sql_clean_code("CAST(c_custkey AS VARCHAR) || '.00'")} AS code_float_text,
  {sql_clean_code("' ' || c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) || ' '")} AS code_spaced
FROM customer
""",
)
def station_code_clean(spark: SparkSession, d: str) -> DataFrame:
    """STR3 on three code spellings per customer."""
    c = _t(spark, d, "customer")
    return c.select(
        "c_custkey",
        T.clean_code(F.col("c_name")).alias("code_name"),
        T.clean_code(F.concat(F.col("c_custkey").cast("string"), F.lit(".00"))).alias("code_float_text"),
        T.clean_code(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("-"), F.col("c_nationkey").cast("string"), F.lit(" "))).alias(
            "code_spaced"
        ),
    )


@query(
    "decimal_comma_parse",
    """
SELECT c_custkey,
  TRY_CAST(regexp_replace(replace(replace(CAST(c_acctbal AS VARCHAR), '.', ','), ',', '.'), '[^0-9.\\-]', '', 'g') AS DOUBLE) AS value_comma,
  TRY_CAST(regexp_replace(replace(' ~' || replace(CAST(c_acctbal AS VARCHAR), '.', ',') || ' m', ',', '.'), '[^0-9.\\-]', '', 'g') AS DOUBLE) AS value_noisy,
  TRY_CAST(regexp_replace(replace(c_mktsegment, ',', '.'), '[^0-9.\\-]', '', 'g') AS DOUBLE) AS value_text
FROM customer
""",
)
def decimal_comma_parse(spark: SparkSession, d: str) -> DataFrame:
    """STR5: decimal-comma numbers (the balance written with ',')."""
    c = _t(spark, d, "customer")
    comma = F.replace(c.c_acctbal.cast("string"), F.lit("."), F.lit(","))
    return c.select(
        "c_custkey",
        T.decimal_comma_double(comma).alias("value_comma"),
        T.decimal_comma_double(F.concat(F.lit(" ~"), comma, F.lit(" m"))).alias("value_noisy"),
        T.decimal_comma_double(F.col("c_mktsegment")).alias("value_text"),
    )


@query(
    "lenient_numeric",
    """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_num,
       TRY_CAST(event_type AS DOUBLE) AS type_num
FROM events
""",
)
def lenient_numeric(spark: SparkSession, d: str) -> DataFrame:
    """STR6: lenient casts of JSON text and of non-numeric text."""
    e = _t(spark, d, "events")
    return e.select(
        "event_id",
        T.lenient_double(F.get_json_object("props", "$.k")).alias("k_num"),
        T.lenient_double(F.col("event_type")).alias("type_num"),
    )


_TS_SPELLINGS = (
    ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT%H:%M:%S"),
    ("yyyy/MM/dd HH:mm", "%Y/%m/%d %H:%M"),
    ("MM/dd/yyyy", "%m/%d/%Y"),
    ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
)


def _ts_raw_spark(o: DataFrame):
    k = F.pmod(F.col("o_orderkey"), F.lit(5))
    expr = F.when(k == 4, F.col("o_orderstatus"))
    for i, (fmt, _) in enumerate(_TS_SPELLINGS):
        expr = expr.when(k == i, F.date_format(F.col("o_orderdate"), fmt))
    return expr


def _ts_raw_sql() -> str:
    arms = " ".join(f"WHEN o_orderkey % 5 = {i} THEN strftime(o_orderdate, '{f}')" for i, (_, f) in enumerate(_TS_SPELLINGS))
    return f"CASE {arms} ELSE o_orderstatus END"


@query(
    "lenient_timestamp",
    f"""
WITH r AS (SELECT o_orderkey, {_ts_raw_sql()} AS raw FROM orders)
SELECT o_orderkey, raw,
  strftime(coalesce(
    CASE WHEN regexp_full_match(raw, '\\d{{4}}-\\d{{2}}-\\d{{2}}([ T]\\d{{2}}:\\d{{2}}(:\\d{{2}})?)?') THEN TRY_CAST(raw AS TIMESTAMP) END,
    try_strptime(raw, '%Y/%m/%d %H:%M:%S'), try_strptime(raw, '%Y/%m/%d %H:%M'), try_strptime(raw, '%Y/%m/%d'),
    try_strptime(raw, '%m/%d/%Y %H:%M:%S'), try_strptime(raw, '%m/%d/%Y %H:%M'), try_strptime(raw, '%m/%d/%Y'),
    try_strptime(raw, '%d/%m/%Y %H:%M:%S'), try_strptime(raw, '%d/%m/%Y %H:%M'), try_strptime(raw, '%d/%m/%Y'),
    try_strptime(raw, '%Y%m%d')), '%Y-%m-%d %H:%M:%S') AS parsed
FROM r
""",
)
def lenient_timestamp(spark: SparkSession, d: str) -> DataFrame:
    """DAT1 over order dates written in four spellings plus unparsable text."""
    o = _t(spark, d, "orders").select("o_orderkey", _ts_raw_spark(_t(spark, d, "orders")).alias("raw"))
    parsed = D.lenient_timestamp(F.col("raw"))
    return o.select("o_orderkey", "raw", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query(
    "calendar_features",
    """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS date,
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(day(o_orderdate) AS INTEGER) AS day, CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year,
  CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week,
  CAST(CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend
FROM orders WHERE o_orderdate IS NOT NULL
""",
)
def calendar_features(spark: SparkSession, d: str) -> DataFrame:
    """DAT2 + DAT3 on every order day."""
    days = _t(spark, d, "orders").select(D.day_floor("o_orderdate").alias("date")).filter(F.col("date").isNotNull()).distinct()
    return days.withColumns(D.calendar_columns("date"))


@query(
    "date_grid",
    """
SELECT CAST(g.d AS DATE) AS date FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders) b,
LATERAL (SELECT unnest(generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d) g
""",
)
def date_grid(spark: SparkSession, d: str) -> DataFrame:
    """DAT4: every day between the first and last order day (inclusive)."""
    days = _t(spark, d, "orders").select(D.day_floor("o_orderdate").alias("d"))
    b = days.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    return b.select(D.day_sequence(F.col("lo"), F.col("hi")).alias("date"))


# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------


@query(
    "date_clip",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01' AND CAST(o_orderdate AS DATE) <= DATE '1997-12-31'
""",
)
def date_clip(spark: SparkSession, d: str) -> DataFrame:
    """FLT1: inclusive day clip (pushed to the parquet scan)."""
    o = _t(spark, d, "orders").select("o_orderkey", D.day_floor("o_orderdate").alias("date"))
    return FL.clip_dates(o, "date", "1996-01-01", "1997-12-31")


_FALLBACK_BASE = f"""
base AS (
  SELECT c.c_custkey, {sql_norm_text('r.r_name')} AS dept
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


@query(
    "fallback_filter",
    f"""
WITH {_FALLBACK_BASE}
SELECT c_custkey, 'america' AS wanted FROM base
WHERE contains(dept, 'america') OR NOT EXISTS (SELECT 1 FROM base WHERE contains(dept, 'america'))
UNION ALL
SELECT c_custkey, 'antioquia' AS wanted FROM base
WHERE contains(dept, 'antioquia') OR NOT EXISTS (SELECT 1 FROM base WHERE contains(dept, 'antioquia'))
""",
)
def fallback_filter(spark: SparkSession, d: str) -> DataFrame:
    """FLT2: keep the wanted department unless none matches (then keep all);
    one region that exists and one that does not."""
    c, n, r = _t(spark, d, "customer"), _t(spark, d, "nation"), _t(spark, d, "region")
    base = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select("c_custkey", "r_name")
    out = None
    for wanted in ("america", "antioquia"):
        kept = FL.text_contains_filter(base, "r_name", wanted).select("c_custkey", F.lit(wanted).alias("wanted"))
        out = kept if out is None else out.unionByName(kept)
    return out


@query(
    "invalid_to_null",
    """
SELECT l_orderkey, l_linenumber, l_quantity - 10 AS value FROM lineitem WHERE l_quantity - 10 >= 0
""",
)
def invalid_to_null(spark: SparkSession, d: str) -> DataFrame:
    """FLT6 + FLT5: negative readings become null and are dropped."""
    li = _t(spark, d, "lineitem")
    v = li.select("l_orderkey", "l_linenumber", FL.negative_to_null(F.col("l_quantity") - 10).alias("value"))
    return FL.drop_nulls(v, ["value"])


@query(
    "keyword_event_flag",
    f"""
SELECT o_orderkey,
  CAST(CASE WHEN contains({sql_norm_text('o_orderpriority')}, 'urgent') OR contains({sql_norm_text('o_orderpriority')}, 'high') THEN 1 ELSE 0 END AS INTEGER) AS is_event
FROM orders
""",
)
def keyword_event_flag(spark: SparkSession, d: str) -> DataFrame:
    """FLT8: 1 when the normalized type contains any keyword."""
    o = _t(spark, d, "orders")
    return o.select("o_orderkey", T.contains_any("o_orderpriority", ["urgent", "high"]).alias("is_event"))


# ---------------------------------------------------------------------------
# File inventory over the page table (url path = file path, html = content)
# ---------------------------------------------------------------------------

_URL_PATH = "^[a-z]+://[^/]+/?([^?#]*)"
_URL_HOST = "^[a-z]+://([^/?#]+)"


def page_files(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "pages")
    path = F.regexp_extract("url", _URL_PATH, 1)
    host = F.regexp_extract("url", _URL_HOST, 1)
    rel = F.concat_ws("/", host, path)
    return p.select(
        "page_id",
        rel.alias("relative_path"),
        F.regexp_extract(rel, r"([^/]*)$", 1).alias("file_name"),
        F.octet_length("html").cast("long").alias("size_bytes"),
    )


_SQL_PAGE_FILES = f"""
pf AS (
  SELECT page_id, rel AS relative_path, regexp_extract(rel, '([^/]*)$', 1) AS file_name, octet_length(encode(html)) AS size_bytes
  FROM (SELECT page_id, html, concat_ws('/', regexp_extract(url, '{_URL_HOST}', 1), regexp_extract(url, '{_URL_PATH}', 1)) AS rel FROM pages)
)"""


def _sql_extension(name: str) -> str:
    base = f"lower({name})"
    suffix = f"regexp_extract({base}, '^.+(\\.[^.]*)$', 1)"
    return (
        f"(CASE WHEN suffix({base}, '.tif.gz') THEN 'tif.gz' "
        f"WHEN {suffix} = '.' THEN '' ELSE regexp_replace({suffix}, '^\\.', '') END)"
    )


def _sql_type(ext: str) -> str:
    arms = " ".join(
        f"WHEN {ext} IN ({', '.join(repr(e) for e in exts)}) THEN '{label}'" for label, exts in FF.TYPE_CLASSES
    )
    return f"(CASE {arms} ELSE 'other' END)"


def _sql_group(path: str) -> str:
    text = f"lower(strip_accents(replace({path}, '\\', '/')))"
    arms = " ".join(f"WHEN contains({text}, '{kw}') THEN '{g}'" for kw, g in FF.SOURCE_KEYWORDS)
    return f"(CASE {arms} ELSE 'UNKNOWN' END)"


def _sql_rule(group: str, idx: int) -> str:
    def lit(v):
        if isinstance(v, bool):
            return "true" if v else "false"
        return "'" + str(v).replace("'", "''") + "'"

    arms = " ".join(f"WHEN {group} = '{g}' THEN {lit(r[idx])}" for g, r in FF.SOURCE_RULES.items())
    return f"(CASE {arms} ELSE {lit(FF.SOURCE_RULES['UNKNOWN'][idx])} END)"


def _sql_phase(g: str, t: str, e: str, m: str) -> tuple[str, str, str]:
    """(phase, reason, can_convert) CASE expressions in the reference order."""
    dp, dr, dc = _sql_rule(g, 0), _sql_rule(g, 1), _sql_rule(g, 2)
    heavy_r = ", ".join(f"'{x}'" for x in FF.HEAVY_RASTER_GROUPS)
    heavy_v = ", ".join(f"'{x}'" for x in FF.HEAVY_VECTOR_GROUPS)
    conds = [
        (f"{t} = 'other'", "'IGNORE_FOR_NOW'", f"'{FF.REASON_OTHER}'", "false"),
        (f"{e} IN ('zip', 'rar', 'gz') AND {g} = 'DATOS_COMPRIMIDOS'", dp, dr, dc),
        (f"{t} = 'compressed_archive'", "'NEEDS_LIGHT_PREPROCESSING'", f"'{FF.REASON_ARCHIVE}'", dc),
        (f"{g} = 'GROUND_TRUTH_INUNDACIONES' AND {t} = 'tabular'", "'READY_FOR_PHASE1'", dr, dc),
        (f"{t} = 'tabular' AND {m} > {FF.BIG_TABLE_MB}", "'NEEDS_LIGHT_PREPROCESSING'", f"'{FF.REASON_BIG_TABLE}'", dc),
        (f"{t} = 'raster' AND ({g} IN ({heavy_r}) OR {m} > {FF.BIG_RASTER_MB})", "'TOO_HEAVY_FOR_PHASE1_NOTEBOOK'", f"'{FF.REASON_HEAVY_RASTER}'", dc),
        (f"{t} = 'raster'", "'NEEDS_HEAVY_GEOSPATIAL_PREPROCESSING'", f"'{FF.REASON_RASTER}'", dc),
        (f"{t} = 'geospatial_vector' AND {g} IN ({heavy_v})", "'NEEDS_HEAVY_GEOSPATIAL_PREPROCESSING'", dr, dc),
        (f"{t} = 'geospatial_vector'", "'NEEDS_LIGHT_PREPROCESSING'", f"'{FF.REASON_VECTOR}'", dc),
    ]
    out = []
    for k in (1, 2, 3):
        arms = " ".join(f"WHEN {c[0]} THEN {c[k]}" for c in conds)
        default = (dp, dr, dc)[k - 1]
        out.append(f"(CASE {arms} ELSE {default} END)")
    return out[0], out[1], out[2]


def _sql_classified(files: str = _SQL_PAGE_FILES) -> str:
    phase, reason, can = _sql_phase("source_group", "readable_type_guess", "ext", "size_mb")
    return f"""{files},
c1 AS (
  SELECT *, {_sql_extension('file_name')} AS ext, {_sql_group('relative_path')} AS source_group,
         round(size_bytes / 1048576.0, 4) AS size_mb
  FROM pf
),
c2 AS (SELECT *, {_sql_type('ext')} AS readable_type_guess FROM c1),
cls AS (
  SELECT *, {phase} AS suggested_phase, {reason} AS reason, {can} AS can_convert,
         CASE WHEN ext = '' THEN 'no_extension' ELSE ext END AS extension
  FROM c2
)"""


def _classified(spark, d):
    return INV.classify_files(page_files(spark, d))


@query(
    "url_extension_class",
    f"""
WITH {_sql_classified()}
SELECT page_id, file_name, extension, readable_type_guess FROM cls
""",
)
def url_extension_class(spark: SparkSession, d: str) -> DataFrame:
    """STR7 + STR8 on page paths."""
    return _classified(spark, d).select("page_id", "file_name", "extension", "readable_type_guess")


@query(
    "url_source_group",
    f"""
WITH {_sql_classified()}
SELECT page_id, relative_path, source_group FROM cls
""",
)
def url_source_group(spark: SparkSession, d: str) -> DataFrame:
    """STR9 on page paths."""
    return _classified(spark, d).select("page_id", "relative_path", "source_group")


@query(
    "size_mb",
    f"""
WITH {_SQL_PAGE_FILES}
SELECT page_id, size_bytes, round(size_bytes / 1048576.0, 4) AS size_mb FROM pf
""",
)
def size_mb(spark: SparkSession, d: str) -> DataFrame:
    """NUM1: bytes to MB at 4 places."""
    return page_files(spark, d).select("page_id", "size_bytes", FF.size_mb("size_bytes").alias("size_mb"))


@query(
    "usability_class",
    f"""
WITH {_sql_classified()}
SELECT page_id, source_group, readable_type_guess, extension, size_mb, suggested_phase,
       reason AS phase1_reason, can_convert AS can_convert_to_municipio_fecha
FROM cls
""",
)
def usability_class(spark: SparkSession, d: str) -> DataFrame:
    """STR11: usability class, reason and convertible flag per file."""
    c = _classified(spark, d)
    return c.select(
        "page_id",
        "source_group",
        "readable_type_guess",
        "extension",
        "size_mb",
        "suggested_phase",
        F.col("__phase.reason").alias("phase1_reason"),
        F.col("__phase.can_convert").alias("can_convert_to_municipio_fecha"),
    )


def _sql_inventory(max_per_group: int = 5, files: str = _SQL_PAGE_FILES, probe: str = "NULL") -> str:
    skipped = f"inspection_skipped=limit_reached({max_per_group}) for source/type"
    inspectable = ", ".join(f"'{x}'" for x in INV.INSPECTABLE)
    return f"""{_sql_classified(files)},
q AS (
  SELECT *, readable_type_guess IN ({inspectable}) AS inspectable,
         row_number() OVER (PARTITION BY source_group, readable_type_guess ORDER BY relative_path) AS rn
  FROM cls
),
nt AS (
  SELECT *, concat_ws(' | ', 'phase1_reason=' || reason,
                      'can_convert_to_municipio_fecha=' || CASE WHEN can_convert THEN 'YES' ELSE 'NO' END,
                      CASE WHEN inspectable AND rn > {max_per_group} THEN '{skipped}' WHEN inspectable THEN {probe} END) AS note
  FROM q
),
inv AS (
  SELECT page_id, source_group, relative_path, file_name, extension, size_mb, readable_type_guess,
         '' AS date_detected_in_name, suggested_phase,
         CASE WHEN length(note) > {FF.NOTE_MAX_LEN} THEN substr(note, 1, {FF.NOTE_MAX_LEN - 3}) || '...' ELSE note END AS notes
  FROM nt
)"""


def _inventory(spark, d):
    files = page_files(spark, d)
    inv = INV.with_notes(INV.inspection_quota(INV.classify_files(files)))
    return inv


@query(
    "note_compact",
    f"""
WITH {_sql_inventory()}
SELECT page_id, notes, CAST(length(notes) AS BIGINT) AS note_length FROM inv
""",
)
def note_compact(spark: SparkSession, d: str) -> DataFrame:
    """STR12: the inventory notes (joined, cut at 420)."""
    inv = _inventory(spark, d)
    return inv.select("page_id", "notes", F.char_length("notes").cast("long").alias("note_length"))


@query(
    "inspect_quota",
    f"""
WITH {_sql_inventory()}
SELECT page_id, source_group, readable_type_guess,
       (readable_type_guess IN ('tabular', 'geospatial_vector', 'raster', 'compressed_archive') AND rn <= 5) AS inspected
FROM q
""",
)
def inspect_quota(spark: SparkSession, d: str) -> DataFrame:
    """WIN6: first 5 inspectable files per (source group, type)."""
    q = INV.inspection_quota(INV.classify_files(page_files(spark, d)))
    return q.select("page_id", "source_group", "readable_type_guess", "inspected")


@query(
    "inventory_counts",
    f"""
WITH {_sql_inventory()}
SELECT dimension, value, count(*) AS file_count FROM (
  SELECT 'extension' AS dimension, CASE WHEN extension IN ({', '.join(repr(e) for e in FF.SUPPORTED_EXTENSIONS)}) THEN extension ELSE 'untracked' END AS value FROM inv
  UNION ALL SELECT 'source_group', source_group FROM inv
  UNION ALL SELECT 'phase', suggested_phase FROM inv
  UNION ALL SELECT 'total', 'all' FROM inv
) GROUP BY dimension, value
""",
)
def inventory_counts(spark: SparkSession, d: str) -> DataFrame:
    """AGG10: counts by extension, source group, phase and the total."""
    return INV.inventory_counts(_inventory(spark, d))


@query(
    "inventory_rules_join",
    f"""
WITH {_sql_inventory()}
SELECT source_group, count(*) AS file_count,
  {_sql_rule('source_group', 0)} AS default_phase, {_sql_rule('source_group', 1)} AS phase1_reason,
  {_sql_rule('source_group', 2)} AS can_convert_to_municipio_fecha
FROM inv GROUP BY source_group
""",
)
def inventory_rules_join(spark: SparkSession, d: str) -> DataFrame:
    """JOIN9: source counts with their rule, UNKNOWN as default."""
    return INV.source_rationale(_inventory(spark, d))


@query(
    "source_groups_by_count",
    f"""
WITH {_sql_inventory()}
SELECT source_group, count(*) AS file_count FROM inv GROUP BY source_group ORDER BY file_count DESC, source_group LIMIT 12
""",
)
def source_groups_by_count(spark: SparkSession, d: str) -> DataFrame:
    """TOP7: the 12 largest source groups."""
    return INV.top_source_groups(_inventory(spark, d), 12)


# ---------------------------------------------------------------------------
# File inventory of a raw folder derived from the orders (every branch is reached)
# ---------------------------------------------------------------------------

# Folders of a raw tree, one for each source group, one of none, with accents and capitals.
RAW_FOLDERS = (
    "Precipitación IDEAM", "Estaciones Meteorológicas IDEAM", "Open-Meteo", "Topografía y Cartografía IGAC", "MapBiomas", "TR Centros Poblados",
    "Ground Truth Inundaciones", "CHIRPS diario", "SAR Sentinel-1", "Google Earth Engine", "SMAP humedad suelo", "DHIME IDEAM nivel", "datos_comprimidos", "varios",
)
RAW_ENDINGS = ("csv", "TXT", "xlsx", "shp", "GeoJSON", "json", "tif", "tif.gz", "zip", "gz", "rar", "pdf", "")
#: Bytes a file has for each unit of an order's price (files from kilobytes to a gigabyte).
RAW_BYTES = 2_000


def raw_files(spark: SparkSession, d: str) -> DataFrame:
    """A file for every order: folder and ending by key, size by price, inspection text by customer."""
    pick = lambda names, n: F.element_at(F.array(*map(F.lit, names)), (n % len(names) + 1).cast("int"))
    key = F.col("o_orderkey")
    ending = pick(RAW_ENDINGS, F.floor(key / len(RAW_FOLDERS)))
    name = F.concat(F.lit("F"), key.cast("string"), F.when(ending == "", "").otherwise(F.concat(F.lit("."), ending)))
    return _t(spark, d, "orders").select(
        "o_orderkey",
        F.concat(pick(RAW_FOLDERS, key), F.lit("/"), name).alias("relative_path"),
        name.alias("file_name"),
        (F.floor(F.col("o_totalprice")) * RAW_BYTES).cast("long").alias("size_bytes"),
        F.expr("concat('columns=', repeat(o_orderpriority, cast(o_custkey % 40 as int)))").alias("inspect_result"),
    )


def _sql_pick(names, n: str) -> str:
    return f"([{', '.join(repr(x) for x in names)}])[({n}) % {len(names)} + 1]"


_SQL_RAW_FILES = f"""
rf AS (
  SELECT *, {_sql_pick(RAW_FOLDERS, 'o_orderkey')} AS folder, {_sql_pick(RAW_ENDINGS, f'o_orderkey // {len(RAW_FOLDERS)}')} AS ending FROM orders
),
pf AS (
  SELECT o_orderkey, folder || '/' || name AS relative_path, name AS file_name, CAST(floor(o_totalprice) AS BIGINT) * {RAW_BYTES} AS size_bytes,
         'columns=' || repeat(o_orderpriority, o_custkey % 40) AS probe
  FROM (SELECT *, 'F' || o_orderkey || CASE WHEN ending = '' THEN '' ELSE '.' || ending END AS name FROM rf)
)"""
_SQL_RAW_INVENTORY = _sql_inventory(files=_SQL_RAW_FILES, probe="probe").replace("SELECT page_id, source_group", "SELECT o_orderkey, source_group")


def _raw_inventory(spark, d, max_per_group: int = 5):
    return INV.with_notes(INV.inspection_quota(INV.classify_files(raw_files(spark, d)), max_per_group), max_per_group)


@query(
    "file_classes",
    f"""
WITH {_sql_classified(_SQL_RAW_FILES)}
SELECT o_orderkey, relative_path, extension, source_group, readable_type_guess, size_mb, suggested_phase,
       reason AS phase1_reason, can_convert AS can_convert_to_municipio_fecha
FROM cls
""",
)
def file_classes(spark: SparkSession, d: str) -> DataFrame:
    """STR7-STR9, STR11: extension, type, group and usability class in all their cases."""
    c = INV.classify_files(raw_files(spark, d))
    return c.select(
        "o_orderkey", "relative_path", "extension", "source_group", "readable_type_guess", "size_mb", "suggested_phase",
        F.col("__phase.reason").alias("phase1_reason"), F.col("__phase.can_convert").alias("can_convert_to_municipio_fecha"),
    )


@query(
    "file_notes",
    f"""
WITH {_SQL_RAW_INVENTORY}
SELECT o_orderkey, notes, CAST(length(notes) AS BIGINT) AS note_length FROM inv
""",
)
def file_notes(spark: SparkSession, d: str) -> DataFrame:
    """STR12 + WIN6: notes with inspection text, quota notice and the cut at 420."""
    return _raw_inventory(spark, d).select("o_orderkey", "notes", F.char_length("notes").cast("long").alias("note_length"))


@query(
    "file_quota",
    f"""
WITH {_SQL_RAW_INVENTORY}
SELECT o_orderkey, source_group, readable_type_guess, inspectable AND rn <= 5 AS inspected, inspectable AND rn > 5 AS inspect_skipped FROM q
""",
)
def file_quota(spark: SparkSession, d: str) -> DataFrame:
    """WIN6: the first 5 inspectable files of each group and type, the others skipped."""
    q = INV.inspection_quota(INV.classify_files(raw_files(spark, d)))
    return q.select("o_orderkey", "source_group", "readable_type_guess", "inspected", "inspect_skipped")


@query(
    "file_counts",
    f"""
WITH {_SQL_RAW_INVENTORY}
SELECT dimension, value, count(*) AS file_count FROM (
  SELECT 'extension' AS dimension, CASE WHEN extension IN ({', '.join(repr(e) for e in FF.SUPPORTED_EXTENSIONS)}) THEN extension ELSE 'untracked' END AS value FROM inv
  UNION ALL SELECT 'source_group', source_group FROM inv
  UNION ALL SELECT 'phase', suggested_phase FROM inv
  UNION ALL SELECT 'total', 'all' FROM inv
) GROUP BY dimension, value
""",
)
def file_counts(spark: SparkSession, d: str) -> DataFrame:
    """AGG10 over every extension, group and phase."""
    return INV.inventory_counts(_raw_inventory(spark, d))


@query(
    "file_rules_join",
    f"""
WITH {_SQL_RAW_INVENTORY}
SELECT source_group, count(*) AS file_count,
  {_sql_rule('source_group', 0)} AS default_phase, {_sql_rule('source_group', 1)} AS phase1_reason,
  {_sql_rule('source_group', 2)} AS can_convert_to_municipio_fecha
FROM inv GROUP BY source_group
""",
)
def file_rules_join(spark: SparkSession, d: str) -> DataFrame:
    """JOIN9: every group with its rule, UNKNOWN as default."""
    return INV.source_rationale(_raw_inventory(spark, d))


@query(
    "file_groups_by_count",
    f"""
WITH {_SQL_RAW_INVENTORY}
SELECT source_group, count(*) AS file_count FROM inv GROUP BY source_group ORDER BY file_count DESC, source_group LIMIT 12
""",
)
def file_groups_by_count(spark: SparkSession, d: str) -> DataFrame:
    """TOP7: the 12 largest of 13 groups."""
    return INV.top_source_groups(_raw_inventory(spark, d), 12)


@query(
    "pick_scored_source",
    f"""
WITH {_SQL_PAGE_FILES},
k AS (SELECT *, lower(strip_accents(regexp_replace(relative_path, '^\\s+|\\s+$', '', 'g'))) AS key FROM pf),
s AS (
  SELECT page_id, relative_path, size_bytes,
    CAST(contains(key, 'blog') AS INTEGER) + CAST(contains(key, 'en/') AS INTEGER) + CAST(contains(key, '.html') AS INTEGER) AS score
  FROM k WHERE NOT contains(key, 'utm')
)
SELECT page_id, relative_path, size_bytes, score FROM s WHERE score > 0
ORDER BY score DESC, size_bytes DESC, relative_path DESC LIMIT 1
""",
)
def pick_scored_source(spark: SparkSession, d: str) -> DataFrame:
    """SRC2: the best-scoring page path for keywords blog / en/ / .html, excluding utm."""
    files = page_files(spark, d)
    return SF.pick_file(files, ["blog", "en/", ".html"], ["utm"]).select("page_id", "relative_path", "size_bytes", "score")


@query(
    "source_pick_fallback",
    f"""
WITH {_SQL_PAGE_FILES},
k AS (SELECT *, lower(strip_accents(regexp_replace(relative_path, '^\\s+|\\s+$', '', 'g'))) AS key FROM pf),
s AS (
  SELECT page_id, relative_path, size_bytes, CAST(contains(key, 'precipitacion') AS INTEGER) AS score, 0 AS choice FROM k
  UNION ALL
  SELECT page_id, relative_path, size_bytes, CAST(contains(key, 'example.org') AS INTEGER) + CAST(contains(key, '/de/') AS INTEGER), 1 FROM k
)
SELECT page_id, relative_path, size_bytes, score, choice FROM s WHERE score > 0
ORDER BY choice, score DESC, size_bytes DESC, relative_path DESC LIMIT 1
""",
)
def source_pick_fallback(spark: SparkSession, d: str) -> DataFrame:
    """SRC3: the first keyword set finds nothing, the fallback set picks."""
    files = page_files(spark, d)
    picked = SF.pick_file_with_fallback(files, [(["precipitacion"], []), (["example.org", "/de/"], [])])
    return picked.select("page_id", "relative_path", "size_bytes", "score", "choice")


# ---------------------------------------------------------------------------
# Text content: dates, delimiters, header profile, JSON shape, gzip names
# ---------------------------------------------------------------------------

_DATE_SPELLINGS = (("yyyy-MM-dd", "%Y-%m-%d"), ("yyyyMMdd", "%Y%m%d"), ("yyyy_MM", "%Y_%m"), ("yyyy", "%Y"))


def _sql_date_in_text(t: str) -> str:
    p = FF.DATE_PATTERNS
    return (
        f"CASE WHEN regexp_matches({t}, '{p[0]}') THEN concat_ws('-', regexp_extract({t}, '{p[0]}', 1), regexp_extract({t}, '{p[0]}', 2), regexp_extract({t}, '{p[0]}', 3)) "
        f"WHEN regexp_matches({t}, '{p[1]}') THEN concat_ws('-', regexp_extract({t}, '{p[1]}', 1), regexp_extract({t}, '{p[1]}', 2), regexp_extract({t}, '{p[1]}', 3)) "
        f"WHEN regexp_matches({t}, '{p[2]}') THEN concat_ws('-', regexp_extract({t}, '{p[2]}', 1), regexp_extract({t}, '{p[2]}', 2)) "
        f"WHEN regexp_matches({t}, '{p[3]}') THEN regexp_extract({t}, '{p[3]}', 1) ELSE '' END"
    )


@query(
    "date_in_text",
    f"""
WITH names AS (
  SELECT 'order' AS kind, o_orderkey AS id,
    'raw/orders_' || CASE o_orderkey % 4 {" ".join(f"WHEN {i} THEN strftime(o_orderdate, '{f}')" for i, (_, f) in enumerate(_DATE_SPELLINGS))} END || '/part.csv' AS t
  FROM orders
  UNION ALL SELECT 'document', doc_id, text FROM documents
)
SELECT kind, id, {_sql_date_in_text('t')} AS date_detected FROM names
""",
)
def date_in_text(spark: SparkSession, d: str) -> DataFrame:
    """STR10 on order-derived file names (four date spellings) and whole document texts."""
    o = _t(spark, d, "orders")
    k = F.pmod(F.col("o_orderkey"), F.lit(4))
    spelled = None
    for i, (fmt, _) in enumerate(_DATE_SPELLINGS):
        spelled = F.when(k == i, F.date_format("o_orderdate", fmt)) if spelled is None else spelled.when(k == i, F.date_format("o_orderdate", fmt))
    names = o.select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.concat(F.lit("raw/orders_"), spelled, F.lit("/part.csv")).alias("t"))
    docs = _t(spark, d, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("t"))
    return names.unionByName(docs).select("kind", "id", FF.date_in_text("t").alias("date_detected"))


@query(
    "delimiter_detect",
    """
WITH b AS (
  SELECT doc_id, unnest(regexp_extract_all(substr(hex(encode(text)), 1, 8192), '..')) AS byte FROM documents
),
c AS (
  SELECT d.doc_id,
    count(*) FILTER (WHERE byte = '2C') AS c0, count(*) FILTER (WHERE byte = '3B') AS c1,
    count(*) FILTER (WHERE byte = '09') AS c2, count(*) FILTER (WHERE byte = '7C') AS c3
  FROM documents d LEFT JOIN b ON d.doc_id = b.doc_id GROUP BY d.doc_id
)
SELECT doc_id,
  CASE WHEN greatest(c0, c1, c2, c3) = 0 THEN ','
       WHEN c0 = greatest(c0, c1, c2, c3) THEN ','
       WHEN c1 = greatest(c0, c1, c2, c3) THEN ';'
       WHEN c2 = greatest(c0, c1, c2, c3) THEN chr(9)
       ELSE '|' END AS delimiter
FROM c
""",
)
def delimiter_detect(spark: SparkSession, d: str) -> DataFrame:
    """SRC4: delimiter of each document from its first 4096 bytes (the operator's
    defined sample, as the reference reads it)."""
    docs = _t(spark, d, "documents")
    return docs.select("doc_id", SF.detect_delimiter(F.encode("text", "UTF-8")).alias("delimiter"))


@query(
    "header_profile",
    """
WITH c AS (SELECT doc_id, string_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10)) AS lines FROM documents),
body AS (SELECT doc_id, unnest(lines[2:]) AS l FROM c),
n AS (SELECT doc_id, count(*) FILTER (WHERE length(l) > 0) AS k FROM body GROUP BY doc_id),
h AS (SELECT doc_id, string_split(lines[1], ',') AS header FROM c)
SELECT h.doc_id,
  CAST(least(coalesce(n.k, 0), 5) AS INTEGER) AS sample_rows,
  CAST(len(header) AS INTEGER) AS n_columns,
  array_to_string(header[1:12], ' | ') AS columns
FROM h LEFT JOIN n ON h.doc_id = n.doc_id
""",
)
def header_profile(spark: SparkSession, d: str) -> DataFrame:
    """STR14: sampled row count, column count and first 12 header names of each
    document read as a comma-separated table (whole text split into lines)."""
    docs = _t(spark, d, "documents")
    prof = FF.header_profile(F.col("text"), F.lit(","))
    return docs.select(
        "doc_id",
        prof["sample_rows"].alias("sample_rows"),
        prof["n_columns"].alias("n_columns"),
        F.array_join(prof["columns"], " | ").alias("columns"),
    )


@query(
    "json_keys_props",
    """
SELECT event_id,
  CASE json_type(props) WHEN 'OBJECT' THEN 'dict' WHEN 'ARRAY' THEN 'list' ELSE 'other' END AS json_type,
  array_to_string(json_keys(props)[1:12], ',') AS keys
FROM events
""",
)
def json_keys_props(spark: SparkSession, d: str) -> DataFrame:
    """JSN1: JSON shape (type and first 12 keys) of each event payload."""
    e = _t(spark, d, "events")
    shape = FF.json_shape(F.col("props"))
    return e.select("event_id", shape["json_type"].alias("json_type"), F.array_join(shape["keys"], ",").alias("keys"))


@query(
    "gzip_member_guess",
    f"""
WITH n AS (
  SELECT source || '_' || CAST(doc_id AS VARCHAR) || '.' || lang || '.gz' AS file_name FROM documents
  UNION ALL SELECT regexp_extract(regexp_extract(url, '{_URL_PATH}', 1), '([^/]*)$', 1) FROM pages
)
SELECT file_name, CASE WHEN suffix(lower(file_name), '.gz') THEN substr(file_name, 1, length(file_name) - 3) ELSE file_name END AS member
FROM n
""",
)
def gzip_member_guess(spark: SparkSession, d: str) -> DataFrame:
    """STR13: member name of gzip files (document archives and page names)."""
    docs = _t(spark, d, "documents").select(
        F.concat(F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), F.lit("."), F.col("lang"), F.lit(".gz")).alias("file_name")
    )
    pages = _t(spark, d, "pages").select(F.regexp_extract(F.regexp_extract("url", _URL_PATH, 1), r"([^/]*)$", 1).alias("file_name"))
    return docs.unionByName(pages).select("file_name", FF.gzip_member_guess("file_name").alias("member"))


@query(
    "error_sample",
    f"""
WITH {_SQL_PAGE_FILES},
e AS (SELECT relative_path, 'no file name in path' AS scan_error FROM pf WHERE file_name = ''),
firsts AS (SELECT * FROM e ORDER BY relative_path, scan_error LIMIT 1000)
SELECT (SELECT count(*) FROM e) AS n_errors,
       (SELECT string_agg(relative_path || ': ' || scan_error, ' | ' ORDER BY relative_path, scan_error) FROM firsts) AS scan_errors
""",
)
def error_sample(spark: SparkSession, d: str) -> DataFrame:
    """AGG11: number of scan errors and the first 1000 (by path); a page path
    without a file name stands for a file that could not be inspected."""
    files = page_files(spark, d).withColumn(
        "scan_error", F.when(F.col("file_name") == "", F.lit("no file name in path"))
    )
    out = INV.error_sample(files, 1000)
    return out.select("n_errors", F.array_join("scan_errors", " | ").alias("scan_errors"))
