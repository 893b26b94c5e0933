"""BPE encoding and decoding with a word-end vocabulary file, by contiguous rank arrays.

A word is held as the list of its parts, cut at the boundaries, and beside it the rank
of each adjacent pair. The smallest rank is found by a scan, the boundary inside that pair
is deleted, and only the two neighbouring ranks are looked up again; words are
short, so a scan beats a heap. A scan per merge is quadratic in the word, so words
above a length (one of a million letters is possible) take their smallest rank from a
heap instead, with the same result. Short words repeat, so each task keeps a table of
those it has met, bounded in words and so in bytes.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_PAIR = 1 << 62
CACHED_WORDS = 1 << 18  # about 120 MB a task when full
SHORT_WORD = 64  # letters of a word that is scanned and kept
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else the next free letter from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(free)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary file (a ``tokenizers`` JSON of a word-end BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        pairs = (m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern).findall
        self.letters = _byte_letters()
        size = 1 + max([*self.vocab.values(), *self.special.values()])
        self.tokens: list[str] = [""] * size
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.encoded = lru_cache(CACHED_WORDS)(self._encode_word)

    def _encode_word(self, word: str) -> bytes:
        """The ids of one word as little-endian 32-bit integers."""
        parts = [self.letters[b] for b in word.encode("utf-8")]
        parts[-1] += self.suffix
        if len(word) > SHORT_WORD:
            return np.array([self.vocab[p] for p in self._merged_by_heap(parts)], "<u4").tobytes()
        rank = self.ranks.get
        ranks = [rank(pair, NO_PAIR) for pair in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == NO_PAIR:
                break
            at = ranks.index(low)  # the leftmost of the smallest
            parts[at] += parts[at + 1]
            del parts[at + 1], ranks[at]  # the boundary inside the pair goes
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), NO_PAIR)
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), NO_PAIR)
        return np.array([self.vocab[p] for p in parts], "<u4").tobytes()

    def _merged_by_heap(self, parts: list[str | None]) -> list[str]:
        """The parts left of a long word; boundaries are links, so that deleting one moves nothing."""
        rank, end = self.ranks.get, len(parts)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [(r, i) for i, pair in enumerate(zip(parts, parts[1:])) if (r := rank(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            low, at = heapq.heappop(heap)
            gone = after[at]
            # a rank stands for one pair: any other one is out of date
            if parts[at] is None or gone == end or rank((parts[at], parts[gone])) != low:
                continue
            parts[at] += parts[gone]
            parts[gone] = None
            after[at] = after[gone]
            if after[at] < end:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < end and (r := rank((parts[left], parts[after[left]]))) is not None:
                    heapq.heappush(heap, (r, left))
        return [p for p in parts if p is not None]

    @staticmethod
    def normalise(text: str) -> str:
        """NFC, then lower case letter by letter (no rule for a final sigma)."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        pieces = self.split_special.split(text) if any(s in text for s in self.special) else [text]
        out = []
        for piece in pieces:
            if piece in self.special:
                out.append(self.special[piece].to_bytes(4, "little"))
            elif piece:
                words = self.words(self.normalise(piece))
                if max(map(len, words), default=0) <= SHORT_WORD:
                    out += map(self.encoded, words)
                else:
                    out += [self.encoded(w) if len(w) <= SHORT_WORD else self._encode_word(w) for w in words]
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids, joined by spaces (the file names no decoder)."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(4)
def load(path: str) -> WordBpe:
    return WordBpe(path)


@contextmanager
def task_encoder(path: str) -> Iterator[WordBpe]:
    """The encoder for one task. Its word table goes with the task: workers live on and serve other stages."""
    bpe = load(path)
    try:
        yield bpe
    finally:
        bpe.encoded.cache_clear()


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, ids (array), decoded (text).

    Null text is empty and has no ids. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_encoder(path) as bpe:
            for batch in batches:
                ids = [bpe.encode(t or "") for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in ids], pa.list_(pa.int64())),
                        pa.array([bpe.decode(x) for x in ids], pa.string()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<long>, decoded string")


def encode_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The digests are taken where the ids are made, so ids and decoded texts are held
    one document at a time. Null and empty texts have no tokens; repeated rows repeat.
    Very long texts and words take time in proportion to their length (times its logarithm).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with task_encoder(path) as bpe:
            for batch in batches:
                counts, ids_sha, text_sha = [], [], []
                for t in batch.column(1):
                    ids = bpe.encode(t.as_py() or "")
                    counts.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    text_sha.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
