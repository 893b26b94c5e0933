"""Quality rules with adaptive thresholds; DataFrame functions only.

1. Every whole text gives counts (words, code points, symbols, repeated lines, words in
   repeated windows) and from them four ratios in whole numbers.
2. Per language, source and ratio the values of the documents that pass the base rules
   go into a mergeable quantile sketch: values keep their leading ``SKETCH_BITS`` bits, so
   a quantile is at most one part in 2 ** (SKETCH_BITS - 1) too small, and the sketch
   is the count per kept value. Sketches merge by adding counts: tasks merge theirs
   before the shuffle, sources merge into their language and languages into the whole.
   The result is the same in whatever order that happens.
3. A ratio's fences lie ``FENCE`` interquartile ranges and a slack outside the quartiles
   of its language and source. Groups of fewer than ``MIN_DOCS`` documents take their
   language's fences, and those of the whole table where that has as few.
4. The fences are joined to the documents, and those outside any of them go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinesia.llm.graph import stored

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
SKETCH_BITS = 7
FENCE = 3
MIN_DOCS = 100
SALTS = 16
# ratio: (numerator, scale, denominator, two-sided, slack per 1000 of the median, least slack)
RATIOS = {
    "word_length": ("word_chars", 100, "n_words", True, 250, 0),  # hundredths of a code point
    "symbols": ("n_symbols", 1000, "word_chars", False, 0, 40),  # per thousand
    "dup_lines": ("n_dup_lines", 1000, "n_lines", False, 0, 350),
    "repeats": ("n_repeat_words", 1000, "n_words", False, 0, 250),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.transform(F.array(value), body)[0]


def _equal_neighbours(keyed: Column) -> Column:
    """Positions ``i`` of the structs (key, i) whose key another struct has, ascending."""

    def pairs(s: Column) -> Column:
        n = F.greatest(F.size(s) - 1, F.lit(0))
        both = F.zip_with(F.slice(s, F.lit(1), n), F.slice(s, F.lit(2), n), lambda a, b: F.when(a["key"] == b["key"], F.array(a["i"], b["i"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(both, lambda p: p.isNotNull()))))

    return _let(F.sort_array(keyed), pairs)


def repeat_words(words: Column, width: int = WINDOW) -> Column:
    """Words in windows of ``width`` words that the array holds twice or more, the first included.

    Windows with a hash of their own are out at once; the others are compared word by
    word, so the count is exact. Every step sorts or hashes: long texts take n log n.
    """

    def windows(ws: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(ws) - (width - 1))
        return _let(F.transform(ws, lambda w: F.xxhash64(w)), lambda h: F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, F.lit(width)))))

    def covered(at: Column) -> Column:
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda acc, i: F.struct((acc["n"] + i + width - F.greatest(acc["end"], i)).alias("n"), (i + width).alias("end"))
        return F.aggregate(at, zero, step, lambda acc: acc["n"].cast("long"))

    def counted(ws: Column, hashes: Column) -> Column:
        likely = _equal_neighbours(F.transform(hashes, lambda h, i: F.struct(h.alias("key"), i.alias("i"))))
        exact = _let(
            likely,
            lambda at: _equal_neighbours(F.transform(at, lambda i: F.struct(F.array_join(F.slice(ws, i + 1, F.lit(width)), " ").alias("key"), i.alias("i")))),
        )
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(covered(exact))

    return _let(words, lambda ws: F.when(F.size(ws) < width, F.lit(0).cast("long")).otherwise(_let(windows(ws), lambda h: counted(ws, h))))


def text_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Per document: doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed."""
    whole = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"),
    )
    split = whole.select(
        "doc_id", "lang", "source", "t",
        F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("ws"),
        F.filter(F.split("t", "\n", -1), lambda x: F.regexp_like(x, F.lit(WORD))).alias("ls"),
    )
    counts = split.select(
        "doc_id", "lang", "source",
        F.size("ws").cast("long").alias("n_words"),
        F.aggregate("ws", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("ls").cast("long").alias("n_lines"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("ws")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counts.select("*", failed.alias("base_failed"))


def ratio(name: str) -> Column:
    top, scale, bottom, *_ = RATIOS[name]
    return F.expr(f"({scale} * {top}) div greatest({bottom}, 1)")


def sketch_value(value: Column) -> Column:
    """The value with all but its leading bits cleared."""
    bits = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, bits), bits)


def sketches(counts: DataFrame) -> DataFrame:
    """(lang, source, ratio, value, n): the sketch of each language, source and ratio."""
    rows = counts.filter(~F.col("base_failed")).select(
        "lang", "source", F.explode(F.map_from_arrays(F.array(*[F.lit(r) for r in RATIOS]), F.array(*[ratio(r) for r in RATIOS]))).alias("ratio", "value")
    )
    return rows.groupBy("lang", "source", "ratio", sketch_value(F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group of ``keys``: ``docs`` (documents in its sketch) and <ratio>_low, <ratio>_high."""
    merged = sketch.groupBy(*keys, "ratio", "value").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "ratio")
    ranked = merged.select(
        "*", F.sum("n").over(group.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum("n").over(group).alias("docs")
    )
    quartile = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("docs"), F.col("value")))
    found = ranked.groupBy(*keys, "ratio").agg(F.max("docs").alias("docs"), quartile(1).alias("q1"), quartile(2).alias("q2"), quartile(3).alias("q3"))
    columns = []
    for name, (_, _, _, two_sided, share, least) in RATIOS.items():
        slack = FENCE * (F.col("q3") - F.col("q1")) + F.greatest(F.expr(f"({share} * q2) div 1000"), F.lit(least))
        own = F.col("ratio") == name
        low = F.col("q1") - slack if two_sided else F.lit(0)
        columns += [F.max(F.when(own, low)).alias(f"{name}_low"), F.max(F.when(own, F.col("q3") + slack)).alias(f"{name}_high")]
    return found.groupBy(*keys).agg(F.max("docs").alias("docs"), *columns)


def thresholds(sketch: DataFrame) -> DataFrame:
    """The fences that hold for each language and source: its own, its language's or the whole table's."""
    names = [f"{r}_{side}" for r in RATIOS for side in ("low", "high")]
    as_struct = lambda name: F.struct("docs", *names).alias(name)
    own = fences(sketch, ["lang", "source"]).select("lang", "source", as_struct("own"))
    langs = fences(sketch, ["lang"]).select(F.col("lang").alias("l"), as_struct("of_lang"))
    whole = fences(sketch.withColumn("every", F.lit(1)), ["every"]).select("every", as_struct("of_all"))
    both = own.join(langs, F.col("lang").eqNullSafe(F.col("l"))).withColumn("one", F.lit(1)).join(whole, F.col("one") == F.col("every"))
    used = F.when(F.col("own.docs") >= MIN_DOCS, F.col("own")).when(F.col("of_lang.docs") >= MIN_DOCS, F.col("of_lang")).otherwise(F.col("of_all"))
    return both.select("lang", "source", used.alias("used")).select("lang", "source", "used.*")


def quality(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, kept, the ratios and ``fences_docs``.

    ``fences_docs`` is the number of documents behind the fences used. A null text has no
    words and fails. Null languages and sources are groups of their own. Texts without
    a line or word character have ratio 0. Values on a fence stay. Rows that repeat
    a doc_id are judged each on their own. Other columns are ignored, whatever
    their names. An empty table, or one without a row that passes the base rules, gives
    no fences and no row to judge by them. Texts of any length are read whole; a row's
    arrays take a few times the text. A language or source with a third of all rows is
    dealt over ``SALTS`` tasks at the join.
    """
    counts = stored(spark, text_counts(docs, doc_id, text, lang, source), "quality-counts")
    limits = thresholds(stored(spark, sketches(counts), "quality-sketches"))
    limits = limits.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), F.col("docs").alias("fences_docs"), *[c for c in limits.columns if c.endswith(("_low", "_high"))], F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    rows = counts.select("*", *[ratio(r).alias(r) for r in RATIOS], F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("_n"))
    match = F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_n") == F.col("_salt"))
    joined = rows.join(limits, match, "left")
    inside = F.lit(True)
    for r in RATIOS:
        inside = inside & F.col(r).between(F.col(f"{r}_low"), F.col(f"{r}_high"))
    return joined.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"), *RATIOS, "fences_docs")


def keep_quality(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", **names: str) -> DataFrame:
    """doc_id of the rows that pass, for a join back by the caller."""
    return quality(spark, docs, doc_id, **names).filter("kept").select("doc_id")
