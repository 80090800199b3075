"""Word shingles of many texts at once, as 64-bit hashes in arrays; plain helpers for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Five words make a shingle; a text of fewer, but not none, is one shingle.
SHINGLE = 5
# Characters of text that are worked on at a time (a longer text alone).
BLOCK = 3_000_000
# Words whose hash a Python worker remembers.
CACHE_WORDS = 150_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(bits: np.ndarray) -> np.ndarray:
    """Between 0 and 1, never either."""
    return ((bits >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < CACHE_WORDS and len(word) <= 64:
            self[word] = value
        return value


HASHES = WordHashes()


def blocks(texts: list[str], limit: int = BLOCK) -> Iterator[slice]:
    """Consecutive slices of about ``limit`` characters."""
    first = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield slice(first, i)
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield slice(first, len(texts))


def text_blocks(column: pa.Array, limit: int) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about ``limit`` bytes, a NULL as an empty one, with the place of the first; only they are Python strings at a time."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    first = size = 0
    for i, own in enumerate([*sizes, limit + 1]):
        if i > first and size + own > limit:
            yield first, [t or "" for t in column.slice(first, i - first).to_pylist()]
            first, size = i, 0
        size += own


def ascii_words(text: str) -> list[str]:
    """What stands between ASCII white space (``str.split`` alone would also split at other spaces)."""
    return text.split() if text.isascii() and not _odd_spaces(text) else text.translate(_SPACES).split(" ")


_SPACES = {9: " ", 10: " ", 11: " ", 12: " ", 13: " "}


def _odd_spaces(text: str) -> bool:
    return "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text


def words_of(text: str) -> list[str]:
    found = ascii_words(text)
    return found if "" not in found else [w for w in found if w]


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text: their hashes, how often each occurs, and the position of its text."""
    own = [words_of(text) for text in texts]
    counts = np.fromiter(map(len, own), np.int64, len(own))
    hashes = np.empty(int(counts.sum()), np.uint64)
    at = 0
    for found in own:
        hashes[at : at + len(found)] = np.fromiter(map(HASHES.__getitem__, found), np.uint64, len(found))
        at += len(found)
    doc = np.repeat(np.arange(len(own)), counts)
    word = mix(hashes)
    code = word[: max(0, len(word) - SHINGLE + 1)].copy()
    for k in range(1, SHINGLE):
        code = code * _ODD + word[k : len(code) + k]
    ends = np.cumsum(counts)
    whole = np.flatnonzero(np.arange(len(code)) + SHINGLE <= ends[doc[: len(code)]])
    code, doc = [mix(code[whole])], [doc[whole]]
    for i in np.flatnonzero((counts > 0) & (counts < SHINGLE)):
        short = word[ends[i] - counts[i] : ends[i]]
        code.append(mix(np.array([np.bitwise_xor.reduce(short * (_ODD ** np.arange(1, len(short) + 1, dtype=np.uint64))) + np.uint64(len(short))])))
        doc.append(np.array([i]))
    code, doc = np.concatenate(code), np.concatenate(doc)
    key = mix(code + mix(doc.astype(np.uint64) + np.uint64(1)))  # one number for text and shingle
    order = np.argsort(key)
    first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if len(key) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(key)))
    return code[order[first]], n, doc[order[first]]


def bags(texts: list[str]) -> list[np.ndarray]:
    """Each text's multiset of shingles as a set: the j-th copy of a shingle is a member of its own."""
    code, n, doc = shingles(texts)
    order = np.argsort(doc, kind="stable")
    code, n, doc = code[order], n[order], doc[order]
    copy = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    members = mix(np.repeat(code, n) + copy.astype(np.uint64) * _ODD)
    sizes = np.bincount(doc, weights=n, minlength=len(texts)).astype(np.int64)
    return np.split(members.view(np.int64), np.cumsum(sizes)[:-1]) if len(texts) else []
