"""Benchmark decontamination: which words of a document lie inside a benchmark item's window.

A window is 13 consecutive words of an item, or the whole of a shorter one. ``windows.py``
finds all exact occurrences with a prefix-filtered join; here they are merged into
covered words and judged. A document is contaminated if a twentieth of its words, and at least one, is covered.

Work on texts is keyed by their MD5 digest, so copies are merged before the shuffle. What is
collected by key is bounded by one document's words.

Defined cases: NULL texts have no words; an item without words has no window; repeated rows get
one row each; an empty benchmark hits nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.windows import occurrences, raw_words, spread, word_count, words
from daygrid.sizing import stored

WINDOW = 13
# One covered word among so many makes a document contaminated.
SHARE = 20


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (``doc_id, text``) as ``doc_id, n_words, n_hit, item_ids, contaminated``."""
    own = benchmark.select("item_id", F.explode(spread(words(F.col("text")), window)).alias("window"))
    own = stored(own.distinct(), small=True)
    text = F.coalesce("text", F.lit(""))
    places = occurrences(docs.select(F.md5(text).alias("key"), "text"), own.select("window").distinct())
    places = stored(places.distinct(), small=True)
    # Spans in order of start; each adds the words past the furthest end so far.
    step = lambda done, span: F.struct(
        F.greatest(done["end"], span["start"] + span["length"]).alias("end"),
        (done["n"] + F.greatest(F.lit(0), span["start"] + span["length"] - F.greatest(done["end"], span["start"]))).alias("n"),
    )
    spans = places.select("key", "start", "length").distinct().groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("spans"))
    covered = spans.select("key", F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step)["n"].cast("bigint").alias("n_hit"))
    items = places.select("key", "window").distinct().join(own, "window").groupBy("key").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    known = docs.select("doc_id", F.md5(text).alias("key"), word_count(raw_words(F.col("text"))).alias("n_words"))
    joined = known.join(covered.join(items, "key", "left"), "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated; all columns stay."""
    judged = hits(docs.select(F.md5(F.coalesce("text", F.lit(""))).alias("doc_id"), "text"), benchmark, window)
    bad = judged.where("contaminated").select(F.col("doc_id").alias("bad")).distinct()
    return docs.alias("own").join(bad.alias("other"), F.md5(F.coalesce("own.text", F.lit(""))) == F.col("other.bad"), "left_anti")
