"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram's vector is the product
(binding) of its letters' vectors, rotated by their place; a text's vector is the sum
(bundle) of its trigrams' vectors, and a language's prototype the sum over its
training texts. A text gets the language whose prototype has the
highest cosine with it. Words are lower-cased runs of letters, with a blank on
either side.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSIONS = 1024
LETTER_SLOTS = 1 << 12  # letters share the random vector of their code's slot
UNKNOWN = "und"
SEED = 5
BLOCK_CHARS = 1 << 19
BLOCK_TEXTS = 64
ROWS = 1 << 10  # of a table, in double precision at a time


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(slot of each code point, 0 if it is no letter; random vector of each slot, all ones for the blank)."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    slot_of = np.where(letter, np.arange(0x110000) % (LETTER_SLOTS - 1) + 1, 0).astype(np.int16)
    slots = np.random.Generator(np.random.PCG64(SEED)).integers(0, 2, (LETTER_SLOTS, DIMENSIONS), np.int8)
    return slot_of, slots * np.int8(2) - np.int8(1)


def letter_slots(text: str) -> Iterator[np.ndarray]:
    """The slots of a text's letters, one 0 for a run of anything else and at either end; in blocks.

    A block repeats the last two slots of the one before, so each trigram lies in one block.
    """
    slot_of, _ = _tables()
    before = np.zeros(1, np.int16)
    for i in range(0, len(text), BLOCK_CHARS):
        code = np.frombuffer(text[i : i + BLOCK_CHARS].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        slot = np.concatenate([before, slot_of[code]])
        if i + BLOCK_CHARS >= len(text):
            slot = np.append(slot, np.int16(0))
        keep = np.ones(len(slot), bool)
        keep[1:] = (slot[1:] > 0) | (slot[:-1] > 0)
        slot = slot[keep]
        yield slot
        before = slot[-2:]


def bound_vectors(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The bound vectors of trigrams given by their letters' slots."""
    _, slots = _tables()
    return np.roll(slots[a], 2, 1) * np.roll(slots[b], 1, 1) * slots[c]


class Bundler:
    """Counts a text's trigrams and bundles the counts.

    Letters met get small numbers, so that a trigram is found by its place in a table;
    texts with more different letters, or more different trigrams, than the tables
    hold are bundled without them, with the same result.
    """

    SMALL = 7  # bits of a letter's number

    def __init__(self, most: int = 1 << 14):
        self.most = most
        self.reset()

    def reset(self) -> None:
        self.number = np.full(LETTER_SLOTS, -1, np.int32)
        self.number[0] = 0
        self.letters = 1
        self.row = np.full(1 << (3 * self.SMALL), -1, np.int32)
        self.known = 0
        self.vectors = np.zeros((self.most, DIMENSIONS), np.float32)  # memory is taken as rows are filled

    def full(self) -> bool:
        return self.known > self.most // 2

    def _rows(self, slot: np.ndarray) -> np.ndarray | None:
        """Table row of each trigram around a letter; None if the tables can't hold them."""
        new = np.unique(slot[self.number[slot] < 0])
        if self.letters + len(new) > 1 << self.SMALL:
            return None
        self.number[new] = np.arange(self.letters, self.letters + len(new))
        self.letters += len(new)
        n = self.number[slot]
        key = ((n[:-2] << (2 * self.SMALL)) | (n[1:-1] << self.SMALL) | n[2:])[slot[1:-1] > 0]
        row = self.row[key]
        if (row < 0).any():
            fresh, at = np.unique(key[row < 0], return_index=True)
            if self.known + len(fresh) > self.most:
                return None
            where = np.flatnonzero(slot[1:-1] > 0)[row < 0][at]
            self.vectors[self.known : self.known + len(fresh)] = bound_vectors(slot[where], slot[where + 1], slot[where + 2])
            self.row[fresh] = np.arange(self.known, self.known + len(fresh))
            self.known += len(fresh)
            row = self.row[key]
        return row

    def counts(self, text: str) -> tuple[np.ndarray | None, np.ndarray | None]:
        """(counts by table row, None), (None, bundled vector), or (None, None) for a text without a letter."""
        total = None
        for slot in letter_slots(text):
            row = self._rows(slot)
            if row is None:
                return None, self._bundle(text)
            if len(row):
                part = np.bincount(row, minlength=self.known)
                if total is not None:
                    part[: len(total)] += total
                total = part
        return total, None

    @staticmethod
    def _bundle(text: str) -> np.ndarray:
        total = np.zeros(DIMENSIONS)
        for slot in letter_slots(text):
            at = np.flatnonzero(slot[1:-1] > 0)
            wide = slot.astype(np.int64)
            _, first, n = np.unique((wide[at] << 24) | (wide[at + 1] << 12) | wide[at + 2], return_index=True, return_counts=True)
            for i in range(0, len(first), 4096):
                f = at[first[i : i + 4096]]
                total += n[i : i + 4096] @ bound_vectors(slot[f], slot[f + 1], slot[f + 2]).astype(np.float64)
        return total

    def bundle(self, counts: list[np.ndarray]) -> np.ndarray:
        """The bundled vectors of texts given by their counts."""
        table = np.zeros((len(counts), self.known), np.float32)
        for i, c in enumerate(counts):
            table[i, : len(c)] = c
        return (table @ self.vectors[: self.known]).astype(np.float64)


def fit_prototypes(spark: SparkSession, training: DataFrame, text: str, lang: str) -> dict[str, list[float]]:
    """{language: prototype} from every training row with a text and a language.

    Tasks add up the trigrams of their rows by language; only the bundled sums, one row
    of DIMENSIONS numbers per language, reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        counted: dict[str, np.ndarray] = {}
        bundler = Bundler()

        def empty_table() -> None:
            for name, c in counted.items():
                for i in range(0, len(c), ROWS):
                    sums[name] = sums.get(name, 0) + c[i : i + ROWS] @ bundler.vectors[i : i + len(c[i : i + ROWS])].astype(np.float64)
            counted.clear()

        for batch in batches:
            for t, name in zip(batch.column(0), batch.column(1).to_pylist()):
                if bundler.full():
                    empty_table()
                    bundler.reset()
                counts, vector = bundler.counts(t.as_py())
                if vector is not None:
                    sums[name] = sums.get(name, 0) + vector
                elif counts is not None:
                    old = counted.get(name)
                    if old is not None:
                        counts[: len(old)] += old
                    counted[name] = counts
        empty_table()
        names = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([np.rint(sums[n]).astype(np.int64) for n in names], pa.list_(pa.int64()))], ["lang", "v"]
        )

    rows = training.select(F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("l"))
    parts = rows.filter("t is not null and l is not null").mapInArrow(run, "lang string, v array<long>")
    # whole numbers, so that the sum does not depend on the order of the tasks
    summed = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    rows = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).collect()
    return {r["lang"]: [float(x["x"]) for x in r["v"]] for r in sorted(rows, key=lambda r: r["lang"])}


def language_udf(prototypes: dict[str, list[float]]):
    """Arrow UDF: text to (lang_pred, score); score is the cosine, cut to 0..1.

    Null text, text without a letter, and any text when there is no prototype are
    ``und`` with score 0. Equal cosines go to the smallest language name.
    """
    names = sorted(prototypes)
    table = np.array([prototypes[n] for n in names], np.float64).reshape(len(names), DIMENSIONS)
    if names:
        table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-300)

    @F.arrow_udf("lang_pred string, score double")
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bundler = Bundler()
        for texts in batches:
            langs, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            for i in range(0, len(texts), BLOCK_TEXTS):
                if bundler.full():
                    bundler.reset()
                at, counts, vectors = [], [], []
                for k, t in enumerate(texts[i : i + BLOCK_TEXTS], i):
                    c, v = bundler.counts(t.as_py() or "")
                    if v is not None:
                        vectors.append((k, v))
                    elif c is not None:
                        at.append(k)
                        counts.append(c)
                bundled = np.concatenate([bundler.bundle(counts).reshape(-1, DIMENSIONS), *[v[None] for _, v in vectors]])
                at += [k for k, _ in vectors]
                if not at or not names:
                    continue
                norm = np.linalg.norm(bundled, axis=1)
                cosine = bundled @ table.T / np.maximum(norm, 1e-300)[:, None]
                best = cosine.argmax(1)
                langs[at] = [names[b] for b in best]
                scores[at] = np.clip(cosine[np.arange(len(at)), best], 0, 1)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    return language


def predict(docs: DataFrame, prototypes: dict[str, list[float]], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score. Other columns are ignored."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), language_udf(prototypes)(F.col(text).cast("string")).alias("p"))
    return rows.select("doc_id", "p.lang_pred", "p.score")


def held_out(doc_id: str) -> F.Column:
    """Rows that training never sees: crc32 of the id as text, modulo 4, is 2. A null id is trained on."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Fit on the rows that are not held out and predict every row: doc_id, held_out, lang_pred, score."""
    prototypes = fit_prototypes(spark, docs.filter(~held_out(doc_id)), text, lang)
    out = predict(docs, prototypes, doc_id, text)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
