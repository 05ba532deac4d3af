"""Benchmark decontamination by template canonicalisation.

A text becomes a list of tokens: words, numbers, currency and per cent signs. Its
template has typed placeholders: <num> for a number, <unit> for a unit of measure beside a
number, <name> for a word with a capital letter; other words stay, in lower case. Windows of ``WINDOW``
template tokens of documents and items are hashed and joined. Matches on one
diagonal (document position less item position) make an alignment; it counts
if the windows cover at least ``COVER`` item tokens (or the whole of a shorter
item) and the slots are consistent: within the cover, equal item values of one type
go to equal document values, and different ones to different ones. So a question with other numbers
and names is found, and a text that only shares a template is not.

With ``whole`` (the query and the pipeline have it) more is found: (1) pieces on diagonals up to ``NEAR`` off a middle
one add up, and a run of names is one placeholder too, so that 'Mary Ann' can stand for 'Tom'; (2)
of slots in conflict the most frequent values stay, and the alignment counts if the
tokens without the others still reach the cover; (3) whatever the template, ``COVER`` item tokens in a row
(or the whole of a shorter item of ``SMALLEST`` tokens or more) that stand word for word in the text, in any case.

The whole search first finds the texts that can hold anything at all. Whatever is found rests on a run of ``WINDOW``
template tokens or of ``COVER`` words that item and text share, and such a run holds a gram of about half its length that
begins at a multiple of that length in the text. So a text is hashed at every fourth template place and at every
seventh word only, against all grams of the items; texts without a common gram are done, and the windows
of every place are made for the others alone.

DataFrame functions only. The items' grams and windows, if they number ``BROADCAST`` or less, are broadcast
(24 bytes each), else the join shuffles. Texts are tokenised once; the form with runs of names comes from the tokens.
Slots are checked on documents with a match only. Items with fewer than ``WINDOW`` tokens
have no template window and are found word for word only; windows with fewer than ``LITERAL`` plain words are no template evidence.
Items of one word are not searched: they would mark every text with the word. Columns of any name are left as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notchline.llm.common import every, named, stored, table, text_of, without

WINDOW = 8
LITERAL = 4
COVER = 13
NEAR = 4
SMALLEST = 2
BROADCAST = 1_000_000
SALTS = 16  # a hot text's rows are joined in so many parts

# Units of measure that stand beside a number
UNITS = [
    "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "yard", "yards", "mile", "miles",
    "mg", "g", "kg", "ton", "tons", "tonnes", "ounce", "ounces", "pound", "pounds",
    "ml", "cl", "l", "liter", "liters", "litre", "litres", "gallon", "gallons",
    "ms", "s", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours", "day", "days",
    "week", "weeks", "month", "months", "year", "years",
    "cent", "cents", "dollar", "dollars", "euro", "euros", "usd", "eur", "percent", "degrees",
    "%", "$", "€", "£",
]
_TOKEN = r"[\p{L}\p{M}]+|[0-9]+(?:[.,:/][0-9]+)*|[%$€£]"
#: Placeholder codes in place of a word's hash.
NUM, UNIT, NAME = 1, 2, 3
#: The form of windows compared word for word; 0 and 1 are templates without and with runs of names.
VERBATIM = 2


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


def _is_num(t: Column) -> Column:
    return F.coalesce(F.ascii(t).between(48, 57), F.lit(False))


def template_of(tokens: str) -> Column:
    """Codes of the tokens column: a placeholder's number, or the hash of the word."""
    col = F.col(tokens)

    def word(t: Column) -> Column:
        return F.when(F.lower(t) != t, F.lit(NAME).cast("long")).otherwise(F.xxhash64(t))

    def code(t: Column, i: Column) -> Column:
        beside = _is_num(F.get(col, i - 1)) | _is_num(F.get(col, i + 1))
        unit = beside & (F.length(t) <= 8) & F.lower(t).isin(UNITS)
        return F.when(_is_num(t), F.lit(NUM).cast("long")).when(unit, F.lit(UNIT).cast("long")).otherwise(word(t))

    # without a number there is no unit either, and less to ask of every token
    return F.when(F.exists(col, _is_num), F.transform(col, code)).otherwise(F.transform(col, word))


def _is_slot(code: Column) -> Column:
    return (code >= NUM) & (code <= NAME)


def windows_of(codes: str) -> Column:
    n = F.size(codes)
    each = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(codes, i, F.lit(WINDOW))))
    return F.when(n >= WINDOW, each).otherwise(F.array().cast("array<bigint>"))


def _hashed_windows(codes: Column, width: int, seed: int) -> Column:
    n = F.size(codes)
    each = F.transform(F.sequence(F.lit(1), n - (width - 1)), lambda i: F.xxhash64(F.slice(codes, i, F.lit(width)), F.lit(seed)))
    return F.when(n >= width, each).otherwise(F.array().cast("array<bigint>"))


def _coded(df: DataFrame) -> DataFrame:
    """Adds t0 (tokens), c0 (their codes), c1 (codes with each run of names as one) and ``words``: hashes of the
    tokens without regard to case (ß is ss)."""
    df = df.withColumn("t0", tokens_of(F.col("text"))).withColumn("c0", template_of("t0"))
    goes_on = lambda c, i: (c == NAME) & F.coalesce(F.get("c0", i - 1) == NAME, F.lit(False))
    df = df.withColumn("c1", F.filter("c0", lambda c, i: ~goes_on(c, i)))
    sharp = F.col("text").contains("ß") | F.col("text").contains("ẞ")
    plain = F.transform("t0", lambda t: F.xxhash64(F.lower(t)))
    return df.withColumn("words", F.when(sharp, F.transform("t0", lambda t: F.xxhash64(F.replace(F.lower(t), F.lit("ß"), F.lit("ss"))))).otherwise(plain))


def _forms(df: DataFrame) -> DataFrame:
    """``_coded`` with t1 (tokens with each run of names as one) and the windows w0, w1 of both forms (none in w1 if the
    text has no run)."""
    df = _coded(df)
    begins = lambda i: ~((F.get("c0", i) == NAME) & F.coalesce(F.get("c0", i - 1) == NAME, F.lit(False)))
    places = F.when(F.size("c0") > 0, F.sequence(F.lit(0), F.size("c0") - 1)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("__at", F.filter(places, begins))
    piece = lambda s, k: F.array_join(F.slice("t0", s + 1, F.coalesce(F.get("__at", k + 1), F.size("t0")) - s), " ")
    df = df.withColumn("t1", F.transform("__at", piece)).drop("__at")
    none = F.array().cast("array<bigint>")
    return df.withColumn("w0", _hashed_windows(F.col("c0"), WINDOW, 0)).withColumn("w1", F.when(F.size("t0") == F.size("t1"), none).otherwise(_hashed_windows(F.col("c1"), WINDOW, 0)))


def _grams(codes: Column, width: int, seed: int, step: int = 1) -> Column:
    """Hashes of the grams of ``width`` codes that begin at multiples of ``step``."""
    n = F.size(codes)
    each = F.transform(F.sequence(F.lit(1), n - (width - 1), F.lit(step)), lambda i: F.xxhash64(F.slice(codes, i, F.lit(width)), F.lit(seed)))
    return F.when(n >= width, each).otherwise(F.array().cast("array<bigint>"))


def _half(n: int) -> int:
    """The longest gram that every run of ``n`` holds at a multiple of its length."""
    return (n + 1) // 2


def possible(texts: DataFrame, items: DataFrame, lengths: list[int]) -> DataFrame:
    """(__key) of the texts (__key, text) that share a gram with an item; see the module."""
    width = _half(WINDOW)
    grams = [items.select(F.explode(_grams(F.col(c), width, -1)).alias("h")) for c in ("c0", "c1")]
    for n in lengths:
        mine = items.where(F.size("t0") == n if n < COVER else F.size("t0") >= n)
        grams.append(mine.select(F.explode(_grams(F.col("words"), _half(n), n)).alias("h")))
    known = grams[0]
    for g in grams[1:]:
        known = known.union(g)
    known = stored(known.distinct(), "item-grams")
    few = known.count() <= BROADCAST
    runs = F.when(F.size("c0") == F.size("c1"), F.array().cast("array<bigint>")).otherwise(_grams(F.col("c1"), width, -1, width))
    own = F.concat(_grams(F.col("c0"), width, -1, width), runs, *[_grams(F.col("words"), _half(n), n, _half(n)) for n in lengths])
    each = _coded(texts).select("__key", F.explode_outer(own).alias("h"))
    return each.join(F.broadcast(known) if few else known, "h", "left_semi").select("__key").distinct()


def _key(text: str) -> Column:
    """128 bits that stand for a text: equal texts share their result."""
    t = text_of(text)
    return F.concat_ws("-", F.hex(F.xxhash64(t)), F.hex(F.xxhash64(t, F.lit(1))))


def _windows(df: DataFrame, *keep: str) -> DataFrame:
    d = df.withColumn("tokens", tokens_of(F.col("text"))).withColumn("codes", template_of("tokens")).withColumn("windows", windows_of("codes"))
    # outer: an inner explode would add a filter on the array's size, which is pushed below and computes it again
    return d.select(*keep, F.posexplode_outer("windows").alias("pos", "h"))


def bench_items(bench: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, items, tokens, codes): one row for each distinct token list, ``items`` its ids."""
    b = bench.select(named(item_id).alias("id"), tokens_of(text_of(text)).alias("tokens")).where(F.size("tokens") >= WINDOW)
    one = b.groupBy("tokens").agg(F.min("id").alias("item"), F.array_sort(F.collect_set("id")).alias("items"))
    return one.withColumn("codes", template_of("tokens"))


def _consistent(pairs: Column) -> Column:
    """Of (kind, a, b) each distinct pair with its count that no more frequent one of the
    same a or the same b (ties: the larger a and b) is in conflict with."""
    counted = F.transform(F.array_distinct(pairs), lambda u: F.struct(F.size(F.filter(pairs, lambda x: x == u)).alias("n"), u["kind"].alias("kind"), u["a"].alias("a"), u["b"].alias("b")))
    rival = lambda u, v: (u["kind"] == v["kind"]) & ((u["a"] == v["a"]) | (u["b"] == v["b"])) & (v > u)
    return F.filter(counted, lambda u: ~F.exists(counted, lambda v: rival(u, v)))


def whole_alignments(docs: DataFrame, bench: DataFrame, text: str, item_id: str, bench_text: str) -> DataFrame:
    """``alignments`` with neighbouring diagonals, runs of names and the consistent part of slots."""
    b = bench.select(named(item_id).alias("id"), text_of(bench_text).alias("text")).where(F.size(tokens_of(F.col("text"))) >= SMALLEST)
    one = b.groupBy("text").agg(F.min("id").alias("item"), F.array_sort(F.collect_set("id")).alias("items"))
    items = stored(_forms(one.withColumn("item", F.xxhash64("text"))), "items")
    each = [items.select("item", F.lit(g).alias("g"), F.col(f"c{g}").alias("codes"), F.posexplode(f"w{g}").alias("ipos", "h")) for g in (0, 1)]
    literal = F.size(F.filter(F.slice("codes", F.col("ipos") + 1, F.lit(WINDOW)), lambda c: ~_is_slot(c)))
    wins = each[0].union(each[1]).where(literal >= LITERAL).select("h", "item", "g", "ipos")
    lengths = sorted(r.n for r in items.select(F.least(F.lit(COVER), F.size("t0")).alias("n")).distinct().collect())  # COVER of them at most
    for n in lengths:  # word for word: g is VERBATIM
        mine = items.where(F.size("t0") == n if n < COVER else F.size("t0") >= n)
        wins = wins.union(mine.select(F.posexplode(_hashed_windows(F.col("words"), n, n)).alias("ipos", "h"), "item").select("h", "item", F.lit(VERBATIM).alias("g"), "ipos"))
    wins = stored(wins, "item-windows")
    few = wins.count() <= BROADCAST
    texts = docs.select(_key(text).alias("__key"), text_of(text).alias("text"))
    texts = without(texts, stored(possible(texts, items, lengths), "possible"), F.col("__key"), "left_semi")
    ends = F.array(F.size("w0"), F.size("w0") + F.size("w1"))
    verbatim = [_hashed_windows(F.col("words"), n, n) for n in lengths]
    places = _forms(texts).select("__key", ends.alias("ends"), F.posexplode_outer(F.concat("w0", "w1", *verbatim)).alias("at", "h"))
    hits = places.join(F.broadcast(wins) if few else wins, "h")
    f = F.when(F.col("at") < F.col("ends")[0], 0).when(F.col("at") < F.col("ends")[1], 1).otherwise(VERBATIM)
    start = F.when(f == 0, 0).when(f == 1, F.col("ends")[0]).otherwise(F.col("ends")[1])
    # positions of verbatim windows count from the first one of any length: a diagonal of one item has one length
    hits = hits.select("__key", "item", f.alias("f"), "g", (F.col("at") - start - F.col("ipos")).alias("shift"), "ipos").where((F.col("f") == VERBATIM) == (F.col("g") == VERBATIM))
    side = ["__key", "item", "f", "g"]
    diagonals = hits.groupBy(*side, "shift").agg(F.array_sort(F.collect_set("ipos")).alias("at")).join(items.select("item", F.size("t0").alias("n")), "item")
    width = F.when(F.col("g") == VERBATIM, F.least(F.lit(COVER), F.col("n"))).otherwise(WINDOW)
    spans = F.aggregate(F.transform("at", lambda p, k: F.least(width, F.coalesce(F.get("at", k + 1) - p, width))), F.lit(0), lambda a, x: a + x)
    diagonals = stored(diagonals.withColumn("span", spans).drop("n"), "diagonals")
    exact = diagonals.where(F.col("g") == VERBATIM).groupBy("__key", "item").agg(F.max("span").alias("covered"))
    exact = exact.join(items.select("item", "items"), "item").select("__key", "item", "items", "covered", F.lit(0).alias("n_slots"))
    least = F.least(F.lit(COVER), F.when(F.col("g") == 0, F.size("t0")).otherwise(F.size("t1")))
    off = F.explode(F.sequence(F.lit(-NEAR), F.lit(NEAR))).alias("off")
    around = diagonals.where(F.col("g") != VERBATIM).select(*side, "shift", "at", "span", off)
    around = around.withColumn("middle", F.col("shift") + F.col("off")).groupBy(*side, "middle").agg(F.sum("span").alias("most"), F.collect_list(F.struct(F.abs("off").alias("far"), "shift", "at")).alias("parts"))
    found = around.join(items.select("item", "t0", "t1"), "item").where(F.col("most") >= least).select(*side, "middle", F.explode("parts").alias("part"))
    cell = F.explode(F.array_distinct(F.flatten(F.transform("part.at", lambda p: F.sequence(p, p + (WINDOW - 1)))))).alias("ip")
    cells = found.select(*side, "middle", cell, F.struct("part.far", "part.shift").alias("by")).groupBy(*side, "middle", "ip").agg(F.min("by").alias("by"))
    cells = cells.groupBy(*side, "middle").agg(F.collect_list(F.struct("ip", (F.col("ip") + F.col("by.shift")).alias("pos"))).alias("cells"))
    found = stored(cells, "alignments")
    again = without(texts, found.select("__key"), F.col("__key"), "left_semi").dropDuplicates(["__key"])
    theirs = _forms(again).select("__key", F.col("t0").alias("d0"), F.col("t1").alias("d1"))
    both = found.join(theirs, "__key").join(items.select("item", "items", "t0", "t1", "c0", "c1"), "item")
    pick = lambda by, x: F.when(F.col(by) == 0, F.col(f"{x}0")).otherwise(F.col(f"{x}1"))
    both = both.select("__key", "item", "items", "cells", least.alias("least"), pick("f", "d").alias("theirs"), pick("g", "t").alias("mine"), pick("g", "c").alias("codes"))
    value = lambda c, p: F.lower(F.regexp_replace(F.get(c, p), r"\s+", " "))
    slots = F.filter("cells", lambda c: _is_slot(F.get("codes", c["ip"])))
    both = both.withColumn("pairs", F.transform(slots, lambda c: F.struct(F.get("codes", c["ip"]).alias("kind"), value("mine", c["ip"]).alias("a"), value("theirs", c["pos"]).alias("b"))))
    both = both.withColumn("good", _consistent(F.col("pairs")))
    # two pieces that overlap in the document count its tokens once
    cover = F.least(F.size("cells"), F.size(F.array_distinct(F.transform("cells", lambda c: c["pos"]))))
    kept = F.aggregate("good", F.lit(0), lambda a, x: a + x["n"])
    judged = both.select("__key", "item", "items", (cover - F.size("pairs") + kept).alias("covered"), F.size("good").alias("n_slots"), "least")
    # written before it is filtered: a filter here would become the join's and work all of this out again for each slot
    judged = stored(judged, "judged").where(F.col("covered") >= F.col("least")).drop("least")
    return judged.union(exact)


def alignments(docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id", bench_text: str = "text", whole: bool = False) -> DataFrame:
    """(__key, item, items, covered, n_slots): consistent alignments of enough cover."""
    if whole:
        return whole_alignments(docs, bench, text, item_id, bench_text)
    items = stored(bench_items(bench, item_id, bench_text), "items")
    wins = items.withColumn("windows", windows_of("codes")).select("item", "codes", F.posexplode_outer("windows").alias("ipos", "h"))
    literal = F.size(F.filter(F.slice("codes", F.col("ipos") + 1, F.lit(WINDOW)), lambda c: ~_is_slot(c)))
    wins = stored(wins.where(literal >= LITERAL).select("h", "item", "ipos"), "item-windows")
    few = wins.count() <= BROADCAST
    texts = docs.select(_key(text).alias("__key"), text_of(text).alias("text"))
    hits = _windows(texts, "__key").join(F.broadcast(wins) if few else wins, "h")
    # repeated texts repeat their hits: distinct window positions per diagonal
    found = hits.groupBy("__key", "item", (F.col("pos") - F.col("ipos")).alias("shift")).agg(F.array_sort(F.collect_set("ipos")).alias("at"))
    spans = F.aggregate(F.transform("at", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("at", k + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    found = found.withColumn("covered", spans).join(items.select("item", "items", F.col("tokens").alias("mine"), "codes"), "item")
    found = stored(found.where(F.col("covered") >= F.least(F.lit(COVER), F.size("mine"))), "alignments")
    again = without(texts, found.select("__key"), F.col("__key"), "left_semi").dropDuplicates(["__key"])
    both = again.select("__key", tokens_of(F.col("text")).alias("theirs")).join(found, "__key")
    inside = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + (WINDOW - 1)))))
    both = both.withColumn("inside", inside)
    slots = F.filter("inside", lambda p: _is_slot(F.get("codes", p)))
    value = lambda c, p: F.lower(F.get(c, p))
    pair = lambda p: F.struct(F.get("codes", p).alias("kind"), value("mine", p).alias("a"), value("theirs", p + F.col("shift")).alias("b"))
    both = both.withColumn("pairs", F.array_distinct(F.transform(slots, pair)))

    def one_way(side: str) -> Column:
        return F.size(F.array_distinct(F.transform("pairs", lambda x: F.struct(x["kind"], x[side])))) == F.size("pairs")

    return both.where(one_way("a") & one_way("b")).select("__key", "item", "items", "covered", F.size("pairs").alias("n_slots"))


def contaminated(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", bench_text: str = "text", whole: bool = False) -> DataFrame:
    """(id, contaminated, n_items, covered, items): one row for each row of ``docs``;
    ``items`` are the benchmark ids found, ascending, ``covered`` the most item tokens covered.
    Null and empty texts hold nothing; null items are passed over; an empty benchmark
    finds nothing; repeated rows are judged each."""
    hit = alignments(docs, bench, text, item_id, bench_text, whole)
    flags = hit.groupBy("__key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), F.max("covered").alias("covered"))
    # a third of all rows may be one text: its rows are dealt over SALTS parts, and the few flags repeated in each
    flags = flags.withColumn("__salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    rows = docs.select(named(doc_id).alias("id"), _key(text).alias("__key"), (F.monotonically_increasing_id() % SALTS).cast("int").alias("__salt"))
    rows = rows.join(flags, ["__key", "__salt"], "left")
    items = F.coalesce("items", F.array().cast(flags.schema["items"].dataType))
    return rows.select("id", (F.size(items) > 0).alias("contaminated"), F.size(items).alias("n_items"), F.coalesce("covered", F.lit(0)).alias("covered"), items.alias("items"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id", bench_text: str = "text", whole: bool = False) -> DataFrame:
    """The rows of ``docs``, with their columns, that hold no benchmark item. Null and empty texts stay; rows of
    one text go or stay together."""
    hit = stored(alignments(docs, bench, text, item_id, bench_text, whole).select("__key").distinct(), "contaminated")
    return without(docs, hit, _key(text)).select(*every(docs))


def op9_template_decon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), whole=True).withColumnRenamed("id", "doc_id")


QUERIES = {"op9_template_decon": op9_template_decon}
ORACLE: dict[str, str] = {}
