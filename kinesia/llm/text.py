"""Vectorised hashing of words and word runs over UTF-8 bytes (numpy, inside tasks).

Words are maximal runs of bytes other than space and \\t \\n \\v \\f \\r. Hashes are
64-bit and depend on the bytes alone, so every task and every run agrees. Short words
take a polynomial hash, all at once; longer ones, where such a hash modulo 2**64 loses
bits to words built for it, a cryptographic one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

BLOCK_BYTES = 1 << 20
SHORT_WORD = 32  # bytes
PACKED_ROWS = 1024
_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 2**64)
_powers = [np.ones(1, _U), np.ones(1, _U)]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    h = (h ^ (h >> _U(31))) * _U(0x7FB5D329728EA185)
    h = (h ^ (h >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return h ^ (h >> _U(33))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i mod 2**64 for i < n, grown by doubling."""
    while len(_powers[0]) < n:
        for k, base in enumerate((BASE, BASE_INVERSE)):
            old = _powers[k]
            _powers[k] = np.concatenate([old, old * _U(pow(base, len(old), 2**64))])
    return _powers[0][:n], _powers[1][:n]


def word_bounds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of a byte buffer."""
    space = IS_SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(buf) and not space[0]:
        edge = np.concatenate([[0], edge])
    if len(buf) and not space[-1]:
        edge = np.concatenate([edge, [len(buf)]])
    return edge[0::2], edge[1::2]


def word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words of a byte buffer."""
    starts, ends = word_bounds(buf)
    up, down = _power_table(len(buf) + 1)
    prefix = np.zeros(len(buf) + 1, _U)
    np.cumsum(BYTE_CODE[buf] * up[:-1], out=prefix[1:])
    h = mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(_U))
    for i in np.flatnonzero(ends - starts > SHORT_WORD).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(buf[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return starts, ends, h


def run_hashes(words: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, _U)
    mult = _U((seed * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D | 1) & 0xFFFFFFFFFFFFFFFF)
    h = np.full(n, _U(seed), _U)
    for i in range(k):
        h = (h ^ (h >> _U(29))) * mult + words[i : i + n]
    return mix(h)


def doc_blocks(texts: list[bytes], block: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of documents of about ``block`` bytes together, whole documents each."""
    i = size = 0
    for j, t in enumerate(texts):
        if size and size + len(t) > block:
            yield i, j
            i, size = j, 0
        size += len(t) + 1
    if i < len(texts):
        yield i, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts as one buffer, each followed by a newline, and the offset of each (one more than texts)."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    return buf, at


def as_bytes(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null is empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) with the text compressed: it moves several times."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        for part in (batch.slice(i, PACKED_ROWS) for i in range(0, batch.num_rows, PACKED_ROWS)):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([pack(t) for t in as_bytes(part.column(1))], pa.binary())], ["doc_id", "text"])
