"""Exact dedup by content-defined chunk recipes; DataFrame functions only.

1. Every normalised text is cut into chunks where its own characters say so
   (a minimum length, then the first boundary pattern, a maximum length), so equal
   passages get equal chunks wherever they start after a boundary.
2. Chunks are deduplicated to verified identifiers: chunk bytes move once, to the
   group of their 64-bit hash and their content. A hash that stands for one content
   only is a verified identifier. If any hash stands for two contents, identifiers
   take the chunk's SHA-256 as well.
3. A document's recipe is the ordered list of its identifiers. Texts are equal when
   the lists are equal; only these short lists are grouped and joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
MIN_CHUNK, MAX_CHUNK = 512, 4096
# after the minimum, a chunk ends behind one of these letters and a space
CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 2}}}?[dfhkmnprtz] |.{{1,{MAX_CHUNK}}}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def chunks(text: Column) -> Column:
    """The chunks of a text in order; joined they are the text. Empty text: no chunk."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def colliding_hashes(docs: DataFrame, text: str) -> DataFrame:
    """Chunk hashes that stand for more than one content."""
    parts = docs.select(F.explode(chunks(normalised(F.col(text)))).alias("chunk"))
    verified = parts.groupBy(F.xxhash64("chunk").alias("h"), "chunk").agg(F.count(F.lit(1)).alias("n"))
    return verified.groupBy("h").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; empty texts are equal to each other. Of equal texts
    the smallest non-null doc_id stays. Rows without a doc_id are dropped in favour
    of rows that have one; if none has, keep_id is null and they all stay. Rows that
    repeat the kept doc_id and its text are all marked kept. Other columns are
    ignored, whatever their names. An empty table gives an empty result.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    if colliding_hashes(source, "text").isEmpty():
        identify = lambda c: F.xxhash64(c)
    else:
        identify = lambda c: F.concat(F.hex(F.xxhash64(c)), F.sha2(c, 256))
    recipes = source.select("doc_id", normalised(F.col("text")).alias("norm")).select(
        "doc_id", F.transform(chunks(F.col("norm")), identify).alias("recipe"), F.sha2("norm", 256).alias("text_sha256")
    )
    groups = recipes.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return recipes.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns, without the rows whose text an earlier document has.

    A row is known by its id and its text: of rows that repeat an id, each goes or
    stays by its own text.
    """
    kept = exact_dedup(docs, doc_id, text).filter("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha256"))
    own = F.sha2(normalised(docs[text].cast("string")), 256)
    return docs.join(kept, docs[doc_id].eqNullSafe(kept["_kept_id"]) & (own == kept["_kept_sha256"]), "left_semi")
