"""
dialect routing, line caps and header fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notchline import constants as C
from notchline.functions.text import dialect, dialect_scale, field, first_lines, java_split
from notchline.plans.registry import query
from notchline.session import scratch_path
from notchline.sources import folders
from notchline.sources.envelope import read_envelope, read_with_rejects, union_files, write_envelope
from notchline.sources.tables import Tables

STANDIN_MARKER = "the "


def doc_files(t: Tables) -> DataFrame:
    """Documents as files: ``filename = source_docid``."""
    return t.documents.select(
        F.concat_ws("_", "source", F.col("doc_id").cast("string")).alias("filename"),
        F.col("text").alias("file_contents"),
    )


def page_files(t: Tables) -> DataFrame:
    return t.pages.select(F.col("url").alias("filename"), F.col("html").alias("file_contents"))


@query(
    "scan_nested_envelope",
    oracle="""SELECT source || '_' || CAST(doc_id AS VARCHAR) AS filename, text AS file_contents
FROM documents""",
)
def scan_nested_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#1: documents written in the nested envelope (contents as bytes) to the
    shared scratch folder, then read back as one directory scan and flattened."""
    path = scratch_path(spark, "envelope")
    write_envelope(doc_files(Tables(spark, sf_dir)), path)
    return read_envelope(spark, path)


@query(
    "read_damaged_folder",
    oracle="""SELECT source || '_' || CAST(doc_id AS VARCHAR) AS filename, CAST(length(text) AS INTEGER) AS n_chars,
  CASE WHEN doc_id % 50 = 7 OR text IS NULL THEN 'no contents' ELSE 'ok' END AS outcome FROM documents
UNION ALL SELECT 'damaged.parquet', NULL, 'unreadable'""",
)
def read_damaged_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1, CTL-2: a folder with the documents' envelope files, some records without contents, and a
    damaged file: every good record, and a row with its reason for all that is not."""
    files = doc_files(Tables(spark, sf_dir))
    lost = F.regexp_extract("filename", "([0-9]+)$", 1).cast("bigint") % 50 == 7
    path = scratch_path(spark, "damaged")
    sizes = files.select("filename", F.length("file_contents").alias("n_chars"))
    write_envelope(files.withColumn("file_contents", F.when(~lost, F.col("file_contents"))), path)
    folders.write_text(spark, f"{path}/damaged.parquet", "PAR1 no table")
    good, bad = read_with_rejects(spark, path)
    named = bad.where("filename IS NOT NULL").join(sizes, "filename").select("filename", "n_chars", F.col("reason").alias("outcome"))
    whole = bad.where("filename IS NULL").select(F.col("source_file").alias("filename"), F.lit(None).cast("int").alias("n_chars"), F.col("reason").alias("outcome"))
    return good.select("filename", F.length("file_contents").alias("n_chars"), F.lit("ok").alias("outcome")).unionByName(named).unionByName(whole)


@query(
    "union_files",
    oracle="""SELECT source || '_' || CAST(doc_id AS VARCHAR) AS filename, text AS file_contents
FROM documents
UNION ALL
SELECT url AS filename, html AS file_contents FROM pages""",
)
def union_files_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#2: the typed empty seed unioned with both file sources."""
    t = Tables(spark, sf_dir)
    return union_files(spark, doc_files(t), page_files(t))


@query("count_files", oracle="SELECT count(*) AS n_files FROM documents")
def count_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#3: row count as a one-row aggregate (no driver round trip)."""
    return Tables(spark, sf_dir).documents.agg(F.count(F.lit(1)).alias("n_files"))


@query(
    "first_file",
    oracle="""SELECT doc_id, source, lang, n_chars, text FROM documents ORDER BY doc_id LIMIT 1""",
)
def first_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#4: the lowest-id file (a per-partition top-1 then a merge, no full sort)."""
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", "source", "lang", "n_chars", "text").orderBy("doc_id").limit(1)


@query(
    "route_version",
    oracle=f"""SELECT lang,
  CASE WHEN contains(text, '{STANDIN_MARKER}') THEN '{C.DIALECT_NEW}' ELSE '{C.DIALECT_OLD}' END AS version,
  count(*) AS n_files
FROM documents GROUP BY ALL""",
)
def route_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#5: dialect by marker, counted per language and dialect."""
    d = Tables(spark, sf_dir).documents
    return (
        d.select("lang", dialect(F.col("text"), STANDIN_MARKER).alias("version"))
        .groupBy("lang", "version")
        .agg(F.count(F.lit(1)).alias("n_files"))
    )


@query(
    "version_scale",
    oracle=f"""SELECT doc_id, version, scale, n_chars * scale AS scaled_chars FROM (
  SELECT doc_id, n_chars,
    CASE WHEN contains(text, '{STANDIN_MARKER}') THEN '{C.DIALECT_NEW}' ELSE '{C.DIALECT_OLD}' END AS version,
    CASE WHEN contains(text, '{STANDIN_MARKER}') THEN {C.SCALE_NEW} ELSE {C.SCALE_OLD} END AS scale
  FROM documents)""",
)
def version_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#6: coordinate scale per dialect, applied to a size column."""
    d = Tables(spark, sf_dir).documents
    v = dialect(F.col("text"), STANDIN_MARKER)
    return d.select("doc_id", "n_chars", v.alias("version")).select(
        "doc_id",
        "version",
        dialect_scale(F.col("version")).alias("scale"),
        (F.col("n_chars") * dialect_scale(F.col("version"))).alias("scaled_chars"),
    )


@query(
    "cap_lines",
    oracle=f"""WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS parts,
  CASE WHEN contains(text, '{STANDIN_MARKER}') THEN {C.MAXLINE} ELSE {C.MAXLINE_OLD} END AS cap FROM documents),
e AS (SELECT doc_id, parts, unnest(range(1, least(len(parts), cap) + 1)) AS line_no FROM s)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, parts[line_no] AS line,
  CAST(length(parts[line_no]) AS INTEGER) AS line_len, CAST(len(parts) AS INTEGER) AS n_lines
FROM e""",
)
def cap_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#7: the first lines of every file, as many as its dialect's cap, numbered from 1, with the
    file's total line count beside them."""
    d = Tables(spark, sf_dir).documents
    lines = F.split(F.col("text"), "\n")
    new = dialect(F.col("text"), STANDIN_MARKER) == C.DIALECT_NEW
    cap = F.when(new, F.lit(C.MAXLINE)).otherwise(F.lit(C.MAXLINE_OLD))
    return d.select(
        "doc_id",
        F.size(lines).alias("n_lines"),
        F.posexplode(first_lines(F.col("text"), cap)).alias("pos", "line"),
    ).select(
        "doc_id",
        (F.col("pos") + 1).alias("line_no"),
        "line",
        F.length("line").alias("line_len"),
        "n_lines",
    )


_LANG = r'<html lang="([^"]*)"'
_TITLE = r"<title>([^<]*)</title>"
_PATH = r"^[a-z]+://[^/]+(/[^?#]*)"


@query(
    "header_extract",
    oracle=f"""SELECT page_id,
  regexp_extract(html, '{_LANG}', 1) AS lang,
  regexp_extract(html, '{_TITLE}', 1) AS title,
  string_split(url, '/')[3] AS host,
  regexp_extract(url, '{_PATH}', 1) AS path
FROM pages""",
)
def header_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#8: header fields out of the file text by pattern, host by position."""
    p = Tables(spark, sf_dir).pages
    return p.select(
        "page_id",
        F.regexp_extract("html", _LANG, 1).alias("lang"),
        F.regexp_extract("html", _TITLE, 1).alias("title"),
        field(F.split("url", "/"), 2).alias("host"),
        F.regexp_extract("url", _PATH, 1).alias("path"),
    )


@query(
    "split_fields",
    oracle="""WITH s AS (SELECT page_id, string_split(regexp_replace(url, '/+$', ''), '/') AS f FROM pages)
SELECT page_id, f[1] AS f0, f[2] AS f1, f[3] AS f2, f[4] AS f3, f[5] AS f4, CAST(len(f) AS INTEGER) AS n_fields
FROM s""",
)
def split_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """#9: positional fields 0..4 of the url split on '/', Java rules (trailing
    empty fields dropped), null past the end."""
    p = Tables(spark, sf_dir).pages
    f = java_split(F.col("url"), "/")
    return p.select("page_id", f.alias("f")).select(
        "page_id",
        *[field(F.col("f"), i).alias(f"f{i}") for i in range(5)],
        F.size("f").alias("n_fields"),
    )
