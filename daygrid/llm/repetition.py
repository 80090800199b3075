"""Quality rules: base counts of a text, and limits on its repetition from a suffix array of words.

The suffixes of all texts of a block are sorted at once by prefix doubling; suffixes of different texts never compare
equal, and only suffixes that still have equals are sorted again. The common prefixes of neighbours come from the ranks of the rounds, by
halving. A place's neighbours in the suffix array have the longest match with it, so the intervals of equal prefixes
give for each word the longest repeated substring that starts there. The substrings of ``SHORTEST`` words and
more are the repeats; the union of their spans is the covered part.

A text fails if more than ``MAX_COVERED`` of its words are covered, or a repeat has more than ``MAX_LONGEST``
words. Base: fewer than 50 words, or more than half of the words in three-word windows that the text has twice.

Memory is bounded by a block of texts (or the longest one). Defined cases: a NULL or empty text has no words and
fails the base; overlapping occurrences count; repeated rows get one row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.shingles import HASHES, blocks, mix, words_of

SHORTEST = 10
MAX_COVERED = 0.3
MAX_LONGEST = 100
WINDOW = 3
LEAST_WORDS = 50
# Percent of the words.
MAX_REPEAT_WORDS = 50

# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
_SPACE = " \t\n\x0b\x0c\r"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]


def repeat_lengths(code: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each place the length of the longest substring from there that its text has at another place too.

    ``code``: a number for each word, different in different texts; ``ends``: one past the last place of the place's text.
    """
    n = len(code)
    if not n:
        return np.zeros(0, np.int64)
    order = np.argsort(code, kind="stable")
    first = np.concatenate([[True], code[order][1:] != code[order][:-1]])
    rank = np.empty(n, np.int64)  # the place in the suffix array where the suffixes that read so begin; from 1
    rank[order] = _starts(first) + 1
    levels, width = [rank], 1
    suffix = order
    while True:
        alone = first & np.concatenate([first[1:], [True]])
        open_ = np.flatnonzero(~alone)  # places in the suffix array that are not settled
        if not len(open_):
            break
        places = suffix[open_]
        beyond = places + width
        follow = np.where(beyond < ends[places], rank[np.minimum(beyond, n - 1)], 0)
        again = np.lexsort((follow, rank[places]))
        places, follow = places[again], follow[again]
        old = rank[places]
        suffix = suffix.copy()
        suffix[open_] = places
        changed = np.concatenate([[True], (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])])
        first = first.copy()
        first[open_] = changed
        rank = rank.copy()
        rank[places] = open_[_starts(changed)] + 1
        levels.append(rank)
        width *= 2
    left, right = suffix[:-1], suffix[1:]
    # Places that share no word have no common prefix; the others are compared from the widest round down.
    pairs = np.flatnonzero(levels[0][left] == levels[0][right])
    a, b, common = left[pairs], right[pairs], np.zeros(len(pairs), np.int64)
    for k in reversed(range(len(levels))):
        inside = (a + common < ends[a]) & (b + common < ends[b])
        equal = inside & (levels[k][np.minimum(a + common, n - 1)] == levels[k][np.minimum(b + common, n - 1)])
        common += equal * 2**k
    length = np.zeros(n, np.int64)
    np.maximum.at(length, a, common)
    np.maximum.at(length, b, common)
    return length


def _starts(first: np.ndarray) -> np.ndarray:
    """For each place the last one up to it that is marked."""
    return np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie inside a span."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def measured(texts: list[str]) -> dict[str, np.ndarray]:
    """The numbers of ``COUNTS`` for each text."""
    own = [words_of(text) for text in texts]
    n_words = np.fromiter(map(len, own), np.int64, len(own))
    doc, last = np.repeat(np.arange(len(own)), n_words), np.cumsum(n_words)
    code = np.fromiter((HASHES[w] for words in own for w in words), np.uint64, int(n_words.sum()))
    code = mix(code + mix(doc.astype(np.uint64) + np.uint64(1)))
    length = repeat_lengths(code, last[doc])
    per_text = lambda marked: np.bincount(doc, weights=marked, minlength=len(own)).astype(np.int64)
    windows, repeats = np.flatnonzero(length >= WINDOW), np.flatnonzero(length >= SHORTEST)
    longest = np.zeros(len(own), np.int64)
    np.maximum.at(longest, doc, length)
    lines = [[line for line in text.split("\n") if line.strip(_SPACE)] for text in texts]
    return {
        "n_words": n_words,
        "word_chars": np.array([sum(map(len, words)) for words in own], np.int64),
        "n_symbols": np.array([sum(map(text.count, SYMBOLS)) for text in texts], np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": per_text(_covered(windows, np.full(len(windows), WINDOW), len(code))),
        "covered_words": per_text(_covered(repeats, length[repeats], len(code))),
        "longest_repeat": longest,
    }


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id``, the numbers of ``COUNTS``, ``base_failed`` and ``kept`` of every row of ``docs``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for part in blocks(texts):
                found = measured(texts[part])
                yield pa.RecordBatch.from_arrays([batch.column(0)[part.start : part.stop], *(pa.array(found[c], pa.int64()) for c in COUNTS)], names=["doc_id", *COUNTS])

    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(measure, f"doc_id bigint, {counts}")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_WORDS)
    repetitive = (F.col("covered_words") > F.col("n_words") * MAX_COVERED) | (F.col("longest_repeat") > MAX_LONGEST)
    return rows.select("*", failed.alias("base_failed"), (~failed & ~repetitive).alias("kept"))
