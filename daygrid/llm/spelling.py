"""Spelling variants: words that differ by one letter, found with a bit-sliced index of positions, and the form they are variants of.

Words are counted over all documents by DataFrame functions. Two words are near if one inserted, deleted or replaced code point turns
one into the other. The comparison is exact and complete, without all pairs:

1. Two words, the shorter of ``m`` code points, that differ first before the middle have their ends in common, others their beginnings. So every
   word is put under its beginning and under its end, once as the shorter and once as the longer of a pair. A key that more than ``GROUP`` words have is
   divided in the same way: what is left between the common beginning and the common end has a middle again. A pair comes together
   under exactly one of the finest keys. At last one code point is left open, and no more words than the alphabet allows share a key.
2. The words of a key are numbered, and for every position and letter one integer has a bit for each word with that letter there. A word is
   compared with all at once: running over its letters, one integer holds the words that agree so far, one those with a letter replaced, and one those with a letter
   inserted, which agree with the index of the next position.

Only each word's number of near words and its best one leave a key, not the pairs. The chains of forms are followed by pointer doubling; a
form is at least twice as frequent as its word, so chains are no longer than the logarithm of the largest count.

Defined cases: NULL and empty texts have no words; a NULL id counts as an empty string in the hash; repeated rows count as often as they occur; other
columns are ignored; an empty table gives no rows; of equally frequent near words the smallest in code-point order is taken.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.sizing import broadcast_within, row_bound, stored

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 5
LEAST_COUNT = 3
# A form is so many times as frequent as its word.
RATIO = 2
# One in so many words of the corpus loses a letter.
THINNED = 97
# Words of a key that are not divided further.
GROUP = 4096


def words(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: runs of letters with A-Z lowered, of which one in 97 has lost a letter; those of some length and frequency."""
    # The shorter runs cannot become words.
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    rows = rows.withColumn("run", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    rows = rows.select("run", F.crc32(F.concat_ws(":", "doc", "run").cast("binary")).alias("h"))
    place = F.pmod("h", F.char_length("run")).cast("int")
    thinned = F.concat(F.col("run").substr(F.lit(1), place), F.col("run").substr(place + 2, F.char_length("run")))
    own = rows.select(F.when(F.col("h") % THINNED == 0, thinned).otherwise(F.col("run")).alias("word")).where(F.char_length("word") >= LEAST_LENGTH)
    return own.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _divided(rows: DataFrame) -> DataFrame:
    """Each row under the two keys that its own is divided into: longer by half of the letters left open, at the beginning or at the end."""
    open_letters = F.col("m") - F.col("head") - F.col("tail")
    half = F.floor(open_letters / 2).cast("int")
    both = F.array(
        F.struct((F.col("head") + half).alias("head"), F.col("tail").alias("tail")),
        F.struct(F.col("head").alias("head"), (F.col("tail") + open_letters - half).alias("tail")),
    )
    return rows.select("word", "n", "m", F.explode(both).alias("part")).select("word", "n", "m", "part.head", "part.tail").withColumn("key", _key())


def _key():
    beginning, end = F.col("word").substr(F.lit(1), F.col("head")), F.expr("right(word, tail)")
    return F.concat_ws(":", "m", "head", "tail", beginning, end)


def keyed(vocabulary: DataFrame, group: int = GROUP) -> list[DataFrame]:
    """Tables of ``key, m, head, tail, word, n`` whose keys at most ``group`` words have, or all but one letter in common."""
    length = F.char_length("word")
    shorter = F.explode(F.array_distinct(F.array(length, F.greatest(length - 1, F.lit(LEAST_LENGTH)))))
    rows = _divided(vocabulary.select("word", "n", shorter.alias("m"), F.lit(0).alias("head"), F.lit(0).alias("tail")))
    ready = []
    while True:
        crowded = rows.where(F.col("m") - F.col("head") - F.col("tail") > 1).groupBy("key").count().where(F.col("count") > group).select("key")
        crowded = stored(crowded, small=True)
        bound = row_bound(crowded)
        if bound == 0:
            return [*ready, rows]
        crowded = broadcast_within(crowded, bound)
        ready.append(rows.join(crowded, "key", "left_anti"))
        rows = stored(_divided(rows.join(crowded, "key", "left_semi")))


def near_in_group(m: int, head: int, tail: int, members: list[tuple[str, int]]) -> dict[str, tuple[int, int, str]]:
    """Of words with a beginning of ``head`` and an end of ``tail`` letters in common: the number of near words, the best one's count and itself.

    Pairs of two words of ``m`` letters, and of one with one of ``m + 1``; with a common end only those that differ before it.
    """
    index: list[dict[str, int]] = [defaultdict(int) for _ in range(m - tail - head + 1)]
    short = 0
    for k, (word, _) in enumerate(members):
        bit = 1 << k
        if len(word) == m:
            short |= bit
        for own, letter in zip(index, word[head:], strict=False):
            own[letter] |= bit
    every = (1 << len(members)) - 1
    found: dict[str, tuple[int, int, str]] = {}

    def add(word: str, near: str, n: int) -> None:
        number, best, form = found.get(word, (0, 0, ""))
        found[word] = (number + 1, n, near) if n > best or (n == best and near < form) else (number + 1, best, form)

    for word, n in members:
        if len(word) != m:
            continue
        same, replaced, inserted = every, 0, 0
        for own, after, letter in zip(index, index[1:], word[head:], strict=False):
            agree = own.get(letter, 0)
            inserted = (inserted | same) & after.get(letter, 0)
            replaced = (replaced & agree) | (same & ~agree)
            same &= agree
        longer = (inserted & ~same if tail else inserted | same) & ~short
        replaced &= short
        near = longer | replaced
        while near:
            bit = near & -near
            near ^= bit
            other, other_n = members[bit.bit_length() - 1]
            add(word, other, other_n)
            if bit & longer:
                add(other, word, n)
    return found


def nearest(vocabulary: DataFrame, group: int = GROUP) -> DataFrame:
    """``word, n_near, near_n, near`` of the words that have near words: their number, and the most frequent one."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shape, members = None, (0, 0, 0), []
        for batch in batches:
            out: list[tuple[str, tuple[int, int, str]]] = []
            for own, m, head, tail, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != key:
                    if len(members) > 1:
                        out += near_in_group(*shape, members).items()
                    key, shape, members = own, (m, head, tail), []
                members.append((word, n))
            yield _found(out)
        if len(members) > 1:
            yield _found(near_in_group(*shape, members).items())

    parts = None
    for rows in keyed(vocabulary, group):
        sorted_rows = rows.select("key", "m", "head", "tail", "word", "n").repartition("key").sortWithinPartitions("key")
        part = sorted_rows.mapInArrow(search, "word string, n_near bigint, near_n bigint, near string")
        parts = part if parts is None else parts.unionByName(part)
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("near"))).alias("best")
    sums = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return sums.select("word", "n_near", (-F.col("best.rank")).alias("near_n"), F.col("best.near").alias("near"))


def _found(rows) -> pa.RecordBatch:
    rows = list(rows)
    kinds = {"word": pa.string(), "n_near": pa.int64(), "near_n": pa.int64(), "near": pa.string()}
    flat = [[r[0] for r in rows], *([r[1][i] for r in rows] for i in range(3))]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(flat, kinds.values(), strict=True)], names=list(kinds))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for rows of ``word, form``: the last form of the chain; every round doubles the steps that are taken."""
    links = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        links = stored(moved)
        if links.where("moved").isEmpty():
            return links.select("word", "root")


def variants(docs: DataFrame, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the corpus."""
    vocabulary = stored(words(docs))
    rows = vocabulary.join(nearest(vocabulary, group), "word", "left")
    has_form = F.col("near_n") >= ratio * F.col("n")
    rows = stored(rows.select(
        "word", F.when(has_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(has_form, F.col("near_n")).alias("form_n"),
    ))
    last = roots(rows.where("form is not null"))
    return rows.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
