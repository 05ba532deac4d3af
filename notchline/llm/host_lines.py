"""Quality rules: base counts of every text and cross-document line frequency.

Lines are normalised (lower case, digits to 0, white space to one space) and hashed;
a line that stands in more distinct documents of its host than the host's limit is
removed; a document is rejected if what is left has fewer than ``MIN_WORDS`` words or less than half of its words.
The limit of a host is ``MAX_DOCS`` documents or ``MAX_SHARE`` of its documents, whichever is more.

DataFrame functions only. Repeated 8-word windows are found inside a row, from the
sorted hashes of its windows, so no window is shuffled. Line counts are combined before they are
shuffled by (host, line); a line that a third of all documents share is one partial count a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notchline.llm.common import stored, table, text_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # per cent of words in repeated windows
MAX_DOCS = 10
MAX_SHARE = 0.001

# Fixed values of the word rule: white space is these six ASCII characters
SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def base_counts(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """One row for each row of ``docs``: row, id, host, the counts, and ``lines``: (line hash,
    words of the line) of the lines that have a word."""
    src = docs.select(F.col(doc_id).alias("id"), F.col(host).cast("string").alias("host"), text_of(text).alias("text"))
    t = F.col("text")
    d = src.withColumn("w", F.transform(words_of(t), lambda w: F.xxhash64(w)))
    plain = F.split(t, "\n")
    d = d.withColumn("with_word", F.filter(plain, lambda x: F.length(F.translate(x, _BLANKS, "")) > 0))
    smooth = F.regexp_replace(F.translate(F.lower(t), "123456789", "000000000"), r"[\x20\x09\x0B-\x0D]+", " ")
    d = d.withColumn("norm", F.filter(F.transform(F.split(smooth, "\n"), lambda x: F.trim(x)), lambda x: x != ""))
    n = F.size("w")
    windows = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("w", i, F.lit(WINDOW))))
    d = d.withColumn("hashes", F.when(n > WINDOW, windows))
    d = d.withColumn("at", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twin = F.filter("at", lambda x, k: (F.get("at", k - 1)["h"] == x["h"]) | (F.get("at", k + 1)["h"] == x["h"]))
    d = d.withColumn("twin", F.sort_array(F.transform(twin, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("twin", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("twin", k + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x
    )
    return d.select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        "host",
        n.cast("long").alias("n_words"),
        F.length(F.translate(t, _BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("with_word") - F.size(F.array_distinct("with_word"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.transform("norm", lambda x: F.struct(F.xxhash64(x).alias("line"), F.size(F.split(x, " ")).alias("words"))).alias("lines"),
    )


def host_line_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", max_docs: int = MAX_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """One row for each row of ``docs``: id, the base counts, ``n_removed_words`` (words of lines
    above their host's limit), ``base_failed`` and ``kept``. A null or blank text has
    no words and fails; a null host is a host of its own; repeated rows with one
    id count as one document of a host and are judged each; rows with a null id count as documents each."""
    base = stored(base_counts(docs, doc_id, text, host), "host-lines")  # row numbers are fixed from here on
    doc = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("row "), F.col("row")))
    lines = base.select("row", doc.alias("doc"), F.coalesce("host", F.lit("")).alias("host"), F.explode("lines").alias("l")).select("row", "doc", "host", "l.line", "l.words")
    limit = base.groupBy(F.coalesce("host", F.lit("")).alias("host")).agg(F.greatest(F.lit(float(max_docs)), F.lit(max_share) * F.count_distinct(doc)).alias("most"))
    counts = lines.groupBy("host", "line").agg(F.count_distinct("doc").alias("docs")).where(F.col("docs") > max_docs)
    above = counts.join(limit, "host").where("docs > most").select("host", "line")
    removed = lines.join(above, ["host", "line"]).groupBy("row").agg(F.sum("words").alias("gone"))
    gone = F.coalesce("gone", F.lit(0)).cast("long")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    depleted = (F.col("n_words") - gone < MIN_WORDS) | (2 * gone > F.col("n_words"))
    counts_of = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return base.drop("lines").join(removed, "row", "left").select("id", *counts_of, gone.alias("n_removed_words"), failed.alias("base_failed"), (~failed & ~depleted).alias("kept"))


def op7_host_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_line_rules(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


QUERIES = {"op7_host_lines": op7_host_lines}
ORACLE = {
    "op7_host_lines": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
m AS (SELECT *, regexp_extract_all(t, '[^{SPACE}]+') AS w FROM d),
win AS (SELECT r, i, w[i:i + {WINDOW - 1}] AS s FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM m WHERE len(w) >= {WINDOW})),
rep AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, s) > 1), (SELECT unnest(range({WINDOW})) AS k) GROUP BY r),
raw AS (SELECT r, doc_id, host, unnest(string_split(t, chr(10))) AS l FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM raw WHERE regexp_matches(l, '[^{SPACE}]') GROUP BY r),
ln AS (
  SELECT * FROM (SELECT r, doc_id, host, trim(regexp_replace(translate(lower(l), '123456789', '000000000'), '[{SPACE}]+', ' ', 'g')) AS l FROM raw)
  WHERE l <> ''),
lim AS (SELECT host, greatest({MAX_DOCS}, {MAX_SHARE} * count(DISTINCT doc_id)) AS most FROM d GROUP BY host),
above AS (SELECT host, l FROM ln JOIN lim USING (host) GROUP BY host, l, most HAVING count(DISTINCT doc_id) > most),
gone AS (SELECT r, sum(len(string_split(l, ' '))) AS n FROM ln JOIN above USING (host, l) GROUP BY r),
f AS (
  SELECT doc_id, len(w) AS n_words,
    length(regexp_replace(t, '[{SPACE}]+', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_removed_words
  FROM m LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, n_removed_words::BIGINT AS n_removed_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words)
    AND NOT (n_words - n_removed_words < {MIN_WORDS} OR 2 * n_removed_words > n_words) AS kept
FROM f"""
}
