"""Where given word windows occur in documents: a prefix-filtered join, by DataFrame operations alone.

A window that occurs has all its words in the document, so its rarest word is a sufficient
prefix: words are ordered by how often they occur in all documents, each window is indexed under
its rarest one, and only places of that word are candidates. The word's place inside the window gives the start
(positional bound), the document's length must hold the window (length bound), the second rarest word must
stand at its place, and then the window's words are compared exactly, all in the task that
reads the document. No text is shuffled.

The index of windows is broadcast in parts of at most ``PART`` windows; more windows
mean more passes over the documents, not a larger broadcast.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.sizing import broadcast_within, row_bound, stored

# Everything that is no word; A-Z stay, and are lowered word by word.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PART = 100_000


def raw_words(text: Column) -> Column:
    """The words of a text in order, in their own case; the first and last entries may be empty strings."""
    return F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1)


def word_count(words: Column) -> Column:
    n = F.size(words)
    return (n - F.when(F.get(words, F.lit(0)) == "", 1).otherwise(0) - F.when((n > 1) & (F.get(words, n - 1) == ""), 1).otherwise(0)).cast("bigint")


def _before_first(words: Column) -> Column:
    return F.when(F.get(words, F.lit(0)) == "", 1).otherwise(0)


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text in lower case, without empty entries (for short tables)."""
    return F.filter(F.split(lowered(F.coalesce(text, F.lit(""))), SEPARATORS, -1), lambda w: w != "")


def spread(found: Column, length: int) -> Column:
    """All windows of ``length`` words as strings; of fewer words, but not none, the whole is one."""
    n = F.size(found)
    starts = F.when(n >= length, F.sequence(F.lit(1), F.greatest(n - length + 1, F.lit(1)))).when(n > 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(found, i, F.lit(length)), " "))


def _frequencies(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """How often each word of the vocabulary occurs in all documents."""
    found = docs.select(F.explode(raw_words(F.col("text"))).alias("word")).select(F.lower("word").alias("token"))
    return found.join(broadcast_within(vocabulary, row_bound(vocabulary)), "token").groupBy("token").agg(F.count("*").alias("frequency"))


def index(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``windows`` (distinct ``window`` strings) under their rarest word, with the second rarest."""
    entries = windows.select("window", F.posexplode(F.split("window", " ")).alias("offset", "word")).withColumn("token", F.lower("word"))
    frequencies = _frequencies(docs, stored(entries.select("token").distinct(), small=True))
    ranked = entries.join(frequencies, "token", "left").groupBy("window").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("frequency", F.lit(0).cast("bigint")).alias("frequency"), "token", "offset"))).alias("order")
    )
    first, second = F.get("order", F.lit(0)), F.get("order", F.lit(1))
    return ranked.select("window", first["token"].alias("token"), first["offset"].alias("offset"), second["token"].alias("second"), second["offset"].alias("second_offset"), F.size("order").alias("length"))


def occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``key, start, length, window`` for each place of a window in ``docs`` (``key, text``).

    ``start`` counts the document's words from 0. Repeated rows give repeated places.
    """
    indexed = stored(index(docs, windows), small=True)
    passes = max(1, -(-indexed.count() // PART))
    split = docs.select("key", raw_words(F.col("text")).alias("words"))
    placed = split.select("key", "words", F.posexplode("words").alias("place", "word")).withColumn("place_token", F.lower("word"))

    def one(part: DataFrame) -> DataFrame:
        start = F.col("place") - F.col("offset")
        fits = (start >= 0) & (start + F.col("length") <= F.size("words"))
        second = F.col("second").isNull() | (F.lower(F.get("words", start + F.col("second_offset"))) == F.col("second"))
        same = lowered(F.array_join(F.slice("words", start + 1, F.col("length")), " ")) == F.col("window")
        within = F.when(fits, F.when(second, same).otherwise(False)).otherwise(False)
        joined = placed.join(F.broadcast(part), (F.col("place_token") == F.col("token")) & within)
        return joined.select("key", (start - _before_first(F.col("words"))).alias("start"), "length", "window")

    parts = [indexed.where(F.pmod(F.xxhash64("window"), F.lit(passes)) == i) for i in range(passes)]
    return reduce(DataFrame.unionByName, map(one, parts))
