"""Words of texts as 64-bit hashes, for a block of texts at a time."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np

SPACE = 0x20
# Longer words get a cryptographic digest.
LONG_WORD = 64

_RANDOM = np.random.default_rng(20240131)
_COMBINE = _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_table(keep: bytes) -> bytes:
    """A table for ``bytes.translate``: A-Z to lower case, bytes outside ``keep`` to a space."""
    lower = bytes(range(256)).lower()
    return bytes(b if b in keep else SPACE for b in lower)


# Words of letters, digits and everything outside ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM = byte_table(bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100)))
# Words between white space: [^\x20\x09-\x0D]+
BLANK = byte_table(bytes(b for b in range(256) if b != SPACE and not 0x09 <= b <= 0x0D))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _loads(block: np.ndarray) -> np.ndarray:
    """Eight bytes from every place on as one number, zeros behind the end."""
    padded = np.concatenate([block, np.zeros(8, np.uint8)])
    return np.ndarray(len(block) + 1, "<u8", padded, strides=(1,))


def _eights(loads: np.ndarray, starts: np.ndarray, length: np.ndarray, at: int) -> np.ndarray:
    """The bytes ``at`` to ``at + 8`` of spans longer than ``at``, zeros behind a span's end."""
    left = np.minimum(length - at, 8).astype(np.uint64)
    spare = np.uint64(64) - left * np.uint64(8)
    return loads[starts + at] << spare >> spare


def span_hashes(block: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span ``[start, end)``; spans are not empty.

    Eight bytes at a time are mixed in, so that a span of up to eight bytes shares its
    hash with no other of its length. Spans over ``LONG_WORD`` bytes get a cryptographic
    digest each: no text can be made up of long words that agree.
    """
    length = ends - starts
    loads = _loads(block)
    out = mix(length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    rest = np.flatnonzero(length <= LONG_WORD)
    at = 0
    while len(rest):
        eight = _eights(loads, starts[rest], length[rest], at)
        out[rest] = mix(out[rest] ^ eight) + np.uint64(at)
        at += 8
        rest = rest[length[rest] > at]
    for k in np.flatnonzero(length > LONG_WORD).tolist():
        digest = hashlib.blake2b(block[starts[k] : ends[k]].tobytes(), digest_size=8)
        out[k] = int.from_bytes(digest.digest(), "little")
    return out


def same_spans(
    block: np.ndarray, starts: np.ndarray, other: np.ndarray, others: np.ndarray, length: np.ndarray
) -> np.ndarray:
    """Whether ``length`` bytes from ``starts`` in one block are those from ``others`` in another."""
    out = np.ones(len(starts), bool)
    loads, other_loads = _loads(block), _loads(other)
    rest, at = np.flatnonzero(length > 0), 0
    while len(rest):
        a = _eights(loads, starts[rest], length[rest], at)
        rest_same = a == _eights(other_loads, others[rest], length[rest], at)
        out[rest[~rest_same]] = False
        at += 8
        rest = rest[rest_same]
        rest = rest[length[rest] > at]
    return out


@dataclass
class Words:
    """Words of several texts: ``hashes[first[i]:first[i + 1]]`` are those of text ``i``."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    block: np.ndarray


def words_of(texts: list[bytes], table: bytes) -> Words:
    """The words of ``texts`` under ``table``; a text without words has none."""
    block = np.frombuffer(b" " + b" ".join(texts).translate(table) + b" ", np.uint8)
    edges = np.flatnonzero(np.diff((block != SPACE).view(np.int8))) + 1
    starts, ends = edges[0::2], edges[1::2]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(sizes + 1)]) + 1
    first = np.searchsorted(starts, begins)
    return Words(span_hashes(block, starts, ends), first, starts, ends, block)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` neighbours; empty when there are fewer."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out += hashes[i : i + n] * _COMBINE[i]
    return mix(out)
