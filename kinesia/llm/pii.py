"""Personal data and the terms that give it away; DataFrame functions only.

Base spans are e-mail addresses, IP addresses, card and phone numbers, found by
patterns and checks. To these, information-theoretic sanitisation adds terms: over
the documents of the corpus, a term t reveals an entity e (a found value) by their
pointwise mutual information PMI = ln(N * n(t, e) / (n(t) * n(e))), out of the
entity's information content IC = ln(N / n(e)). A term whose PMI reaches the
disclosure share of IC is generalised in the documents that hold the entity. Every
pair is scored, whatever its counts. Against chance, p(e | t) = n(t, e) / n(t) is
smoothed towards the base rate p(e) = n(e) / N, as if PRIOR documents more with the
term had been met: PMI = ln((n(t, e) + PRIOR p(e)) / (n(t) + PRIOR) / p(e)). A pair
met once so loses ln(1.5), which stays above the share where the entity is rare
enough: with the threshold of 0.9, from 58 documents on for an entity in one of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinesia.llm.graph import stored

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns, with what makes them linear: no retry inside a run of one class
# (a match starts where a run starts, or where the match before it ended).
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "phone": "+", "ip": ".", "card": None}
OCTETS = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"
TERM = r"[\p{L}\p{M}]{3,}"
DISCLOSURE = 0.9
PRIOR = 0.5
CELL_WORDS = 16384  # 64-bit words of the bitmap of wanted terms
DOC_WORDS = 4096  # 64-bit words of the bitmap of documents with terms


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total, i):
        x = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return total + F.when(i % 2 == 1, doubled).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(OCTETS)
    n = F.length(_digits(value))
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(_digits(value))).otherwise(F.lit(False))
    return n.between(9, 15) if kind == "phone" else F.lit(True)


BLOCK = 128  # matches
NONE = "array<struct<start:int,rank:int,end:int,value:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _located(text: Column, pattern: Column, rank: int) -> Column:
    """All matches of a pattern with their code-point places, from the lengths of what lies between them.

    Arrays grow by copying, so spans are laid out in blocks of BLOCK matches, each from
    where the block before it ends; the time is in proportion to the matches.
    """
    moved = lambda at, x: at + x["gap"] + F.length(x["value"])

    def step(acc, x):
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), moved(acc["at"], x).alias("end"), x["value"].alias("value"))
        return F.struct(moved(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def laid(blocks):
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        begins = F.aggregate(
            blocks, zero, lambda acc, b: F.struct(F.aggregate(b, acc["at"], moved).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"]
        )
        spans = lambda b, at: F.aggregate(b, F.struct(at.alias("at"), F.array().cast(NONE).alias("out")), step, lambda acc: acc["out"])
        return F.flatten(F.zip_with(blocks, begins, spans))

    def located(found):
        between = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        pairs = F.zip_with(between, found, lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("value")))
        count = F.floor((F.size(found) - 1) / BLOCK).cast("int")
        blocks = lambda p: F.transform(F.sequence(F.lit(0), count), lambda b: F.slice(p, b * BLOCK + 1, BLOCK))
        return F.when(F.size(found) > 0, _let(_let(pairs, blocks), laid)).otherwise(F.array().cast(NONE))

    return _let(F.regexp_extract_all(text, pattern, F.lit(0)), located)


def base_spans(text: Column, kind: str) -> Column:
    """The spans of one kind: failing matches are dropped, not tried again."""
    spans = F.filter(_located(text, F.lit(PATTERNS[kind]), KINDS.index(kind)), lambda s: _valid(kind, s["value"]))
    hint = HINTS[kind]
    return F.when(F.contains(text, F.lit(hint)), spans).otherwise(F.array().cast(NONE)) if hint else spans


def _shown(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, [*KINDS, "term"]))
    each = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"]))
    return F.array_join(each, ",")


def found_base(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text and the base spans by kind."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.select("doc_id", "text", *[base_spans(F.col("text"), k).alias(k) for k in KINDS])


def _reveals(total: int, disclosure: float, prior: float) -> Column:
    """Whether the term's smoothed mutual information reaches the share of the entity's information content."""
    share = F.col("n_e") / F.lit(float(max(total, 1)))  # an empty table has no pairs, but constants are folded
    content = -F.log(share)
    given = (F.col("n_te") + F.lit(prior) * share) / (F.col("n_t") + F.lit(prior))
    return (content > 0) & (F.log(given / share) >= disclosure * content)


def _bitmap(keys: DataFrame, words: int) -> Callable[[Column], Column]:
    """A test for the keys of a one-column table, of a fixed size: it lets through too many, never too few."""
    cell = lambda k: F.pmod(F.xxhash64(k), F.lit(64 * words)).cast("int")
    cells = keys.select(cell(F.col(keys.columns[0])).alias("c"))
    rows = cells.groupBy(F.shiftright("c", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, c % 64))").alias("bits"))
    table = [0] * words
    for r in rows.collect():  # at most ``words`` rows
        table[r["word"]] = r["bits"]
    bits = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")
    return lambda k: F.getbit(F.element_at(bits, F.shiftright(cell(k), 6) + 1), cell(k) % 64) == 1


def revealing_terms(spark: SparkSession, found: DataFrame, total: int, disclosure: float, prior: float) -> DataFrame:
    """(doc_id, terms): the terms of a document that reveal one of its entities.

    The entities that one document only holds have the same counts with each of its
    terms (n_te = n_e = 1): they are scored once per term, not once per pair.
    """
    everything = F.concat(*KINDS)
    values = F.array_distinct(F.transform(everything, lambda s: F.concat_ws(":", s["rank"], s["value"])))
    with_entity = found.filter((F.size(everything) > 0) & F.col("doc_id").isNotNull())
    pairs = stored(spark, with_entity.select("doc_id", F.explode(values).alias("entity")).distinct(), "pii-entities")
    entities = pairs.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"), F.min("doc_id").alias("only"))
    entities = stored(spark, entities, "pii-counts")
    single = entities.filter("n_e = 1").select(F.col("only").alias("doc_id")).distinct()
    held = pairs.join(entities.filter("n_e > 1").drop("only"), "entity")

    clear = F.col("text")
    for kind in ("email",):  # letters occur in this kind only
        clear = F.when(F.contains("text", F.lit("@")), F.regexp_replace(clear, PATTERNS[kind], " ")).otherwise(clear)
    words = F.array_distinct(F.regexp_extract_all(clear, F.lit(TERM), F.lit(0)))
    # terms of documents with an entity; then the counts over all documents of those that may reveal one
    local = stored(spark, with_entity.select("doc_id", F.explode(words).alias("term")).distinct(), "pii-local")
    met = stored(spark, local.join(held, "doc_id").select("doc_id", "entity", "n_e", "term"), "pii-terms")
    joint = met.groupBy("entity", "term").agg(F.first("n_e").alias("n_e"), F.count(F.lit(1)).alias("n_te"))
    # a term's documents seen so far are no more than all its documents: pairs that they rule out already go
    reveals = _reveals(total, disclosure, prior)
    seen = stored(spark, local.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")), "pii-seen")
    once = lambda df: df.withColumns({"n_e": F.lit(1), "n_te": F.lit(1)}).filter(reveals).select("term")
    joint = stored(spark, joint.join(seen, "term").filter(reveals).drop("n_t"), "pii-joint")
    rare = stored(spark, once(seen), "pii-rare")
    # terms are counted over all documents; a bitmap of the wanted terms leaves out most others before they are sent
    has = _bitmap(joint.select("term").unionByName(rare), CELL_WORDS)
    maybe = F.filter(words, has)
    everywhere = found.select(F.explode(maybe).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    everywhere = stored(spark, everywhere, "pii-everywhere")
    # an inner join: a semi join would be pushed below the count, and send every occurrence
    flagged = joint.join(everywhere, "term").filter(reveals).select("entity", "term")
    out = met.join(flagged, ["entity", "term"]).select("doc_id", "term")
    alone = stored(spark, once(everywhere.join(rare, "term")), "pii-alone")
    of_single = local.filter(_bitmap(alone, CELL_WORDS)(F.col("term"))).join(alone, "term").join(single, "doc_id").select("doc_id", "term")
    return out.unionByName(of_single).groupBy("doc_id").agg(F.array_sort(F.collect_set("term")).alias("terms"))


def sanitise(spark: SparkSession, docs: DataFrame, disclosure: float = DISCLOSURE, prior: float = PRIOR, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, text, email, ip, card, phone, term (spans), sanitised (text).

    Spans have start and end in code points. Base spans of different kinds may
    overlap; terms are whole runs of at least three letters outside base spans. In
    ``sanitised`` each maximal covered stretch is replaced by the name of its first
    span's kind in brackets. Null text is empty. Rows without a doc_id get base spans
    only; rows that repeat a doc_id share their terms. Other columns are ignored.
    """
    found = found_base(docs, doc_id, text)
    terms = stored(spark, revealing_terms(spark, found, found.count(), disclosure, prior), "pii-flagged")
    # the text of a document is sent only where a bitmap lets it pass as one with terms
    some = F.coalesce(_bitmap(terms.select("doc_id"), DOC_WORDS)(F.col("doc_id")), F.lit(False)) & F.col("doc_id").isNotNull()
    joined = found.filter(some).join(terms.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id"), "left")
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{M}])(?:"), F.array_join("terms", "|"), F.lit(r")(?![\p{L}\p{M}])"))
    base = F.concat(*KINDS)
    inside = lambda s: F.exists(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"]))
    spans = F.filter(_located(F.col("text"), pattern, len(KINDS)), lambda s: ~inside(s))
    none = F.array().cast(NONE)
    with_terms = joined.withColumn("term", F.when(F.col("terms").isNotNull(), spans).otherwise(none)).drop("_id", "terms")
    out = with_terms.unionByName(found.filter(~some).withColumn("term", none))
    return out.withColumn("sanitised", _sanitised(F.col("text"), F.concat(*KINDS, "term")))


def _sanitised(text: Column, spans: Column) -> Column:
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in [*KINDS, "term"]])

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        more = F.concat(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["rank"] + 1))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], more)).otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    end = F.lit(2**31 - 1)
    return F.aggregate(F.array_sort(spans), zero, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, end)))


def span_digests(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    out = sanitise(spark, docs, **options)
    return out.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_shown(F.concat(*KINDS)), 256).alias("base_sha256"), _shown(F.concat(*KINDS, "term")).alias("spans"),
    )
