"""URL filters: rules by host and path, and a character language model for the URLs that no rule fits.

The URLs that a rule allows or blocks train two variable-order Markov models. A model's grams are
counted at the longest order once, over all URLs; shorter orders are sums of these counts.
Witten-Bell smoothing mixes each order with the next shorter one:
P(c|h) = (N(hc) + T(h) P(c|h')) / (N(h) + T(h)), with T(h) the number of different successors, and with the
uniform distribution below order 0. A URL's score is the difference of its log likelihoods divided by its
number of characters. A quarter of the URLs with a rule is not learned from; the threshold is the one that best separates
these (largest sum of the two rates of right verdicts; of equal ones the one nearest to 0), and 0 if they lack one verdict.

Characters outside printable ASCII count as one character, so the alphabet has 96 members, and
no context has more successors than that. Equal URLs are counted and scored once, with
their number as weight.

Defined cases: a NULL URL, or one without ``://``, has empty host and path; without URLs of
either verdict to learn from the score is 0 and the verdict is ``allow``; a score equal to the threshold
allows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.sizing import stored

ORDER = 4
# Texts whose MD5 begins with one of these, a quarter of them, are not learned from and set the threshold.
HELD = ("0", "1", "2", "3")
# Starts of grams that are cut from one stretch of a text.
STRETCH = 256
ALPHABET = 96  # printable ASCII without the space, one for the rest, one for the end
# Copies of the model's rows in the scoring join: a gram that every URL has is split into so many keys.
SALTS = 16
STEP = 0.01  # of the histogram of scores


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


# Fixed values of the contract.
RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct of the longest fitting rule's name and verdict, else NULL; of equally long ones the first in order."""
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r), reverse=True)[::-1]:
        own = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        fits = F.when(own, F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(fits)
    return fits


def _grams(texts: DataFrame, order: int) -> DataFrame:
    """``texts`` without ``text`` and with one row for each character and for the end: ``gram``, the character after its ``order`` predecessors.

    A text is first cut into stretches, so that the work grows with its length.
    """
    padded = F.concat(F.lit(" " * order), F.col("text"), F.lit("\x02"))
    starts = F.sequence(F.lit(0), F.floor(F.char_length("text") / STRETCH).cast("int"))
    stretches = F.transform(starts, lambda k: F.substr(padded, k * STRETCH + 1, F.lit(STRETCH + order)))
    names = [c for c in texts.columns if c != "text"]
    cut = texts.select(*names, F.explode(stretches).alias("stretch")).where(F.char_length("stretch") > order)
    own = F.transform(F.sequence(F.lit(1), F.char_length("stretch") - order), lambda i: F.substr("stretch", i, F.lit(order + 1)))
    return cut.select(*names, F.explode(own).alias("gram"))


def model(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, ratio``: log P(last | before) of the accepted minus that of the rejected, for each gram of the texts.

    ``texts``: ``text, allow, block`` with the numbers of accepted and rejected URLs that read so and are to be learned from.
    """
    grams = _grams(texts.select("text", "allow", "block"), order)
    grams = stored(grams.groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")), small=True)
    below = None
    for k in range(order + 1):
        # Sums over all longer grams with this ending; at most ALPHABET of them share a context.
        level = grams.groupBy(F.substr("gram", F.lit(order - k + 1)).alias("gram")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        context = F.substr("gram", F.lit(1), F.lit(k))
        totals = level.groupBy(context.alias("context")).agg(*(f(c).alias(f"{n}_{c}") for c in ("allow", "block") for f, n in ((F.sum, "n"), (lambda c: F.sum((F.col(c) > 0).cast("long")), "t"))))
        level = level.withColumn("context", context).join(totals, "context")
        if below is None:
            level = level.withColumns({"p_allow": F.lit(1 / ALPHABET), "p_block": F.lit(1 / ALPHABET)})
        else:
            level = level.withColumn("end", F.substr("gram", F.lit(2))).join(below, "end")
        mixed = {c: F.when(F.col(f"n_{c}") > 0, (F.col(c) + F.col(f"t_{c}") * F.col(f"p_{c}")) / (F.col(f"n_{c}") + F.col(f"t_{c}"))).otherwise(F.col(f"p_{c}")) for c in ("allow", "block")}
        below = level.select(F.col("gram").alias("end"), *(p.alias(f"p_{c}") for c, p in mixed.items()))
        if k % 2:
            below = stored(below, small=True)
    return below.select(F.col("end").alias("gram"), (F.log("p_allow") - F.log("p_block")).alias("ratio"))


def scores(texts: DataFrame, ratios: DataFrame, order: int = ORDER) -> DataFrame:
    """``texts`` (with a ``key`` of each) with ``score``, the mean ratio of their grams."""
    salt = F.pmod("key", F.lit(SALTS).cast("bigint"))
    grams = _grams(texts.select("key", "text", salt.alias("salt")), order)
    split = ratios.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    means = grams.join(split, ["gram", "salt"]).groupBy("key").agg(F.avg(F.round("ratio", 9)).alias("score"))
    return texts.join(means, "key")


def threshold(scored: DataFrame, step: float = STEP) -> float:
    """The score that best tells apart the accepted from the rejected; 0 if there are none of either."""
    # Scores are differences of logarithms of probabilities that smoothing keeps away from 0: a histogram
    # between -20 and 20 is bounded, and holds all of them.
    at = F.greatest(F.lit(-20.0), F.least(F.lit(20.0), F.floor(F.col("score") / step) * step))
    bins = scored.where("allow + block > 0").groupBy(at.alias("at")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).orderBy("at").collect()
    allow, block = sum(b["allow"] for b in bins), sum(b["block"] for b in bins)
    if not allow or not block:
        return 0.0
    best, found, below_allow, below_block = (-1.0, 0.0), 0.0, 0, 0
    for b in bins:
        key = ((allow - below_allow) / allow + below_block / block, -abs(b["at"]))
        if key > best:
            best, found = key, b["at"]
        below_allow, below_block = below_allow + b["allow"], below_block + b["block"]
    return found


def judged(pages: DataFrame, rules: list[Rule] = RULES, order: int = ORDER) -> DataFrame:
    """``pages`` (its ``page_id`` and ``url``) as ``page_id, host, path, rule, verdict, score`` (NULL score where a rule decides)."""
    host, path = host_and_path(F.col("url"))
    known = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = known.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    known = known.withColumn("text", F.regexp_replace(F.concat("host", "path"), r"[^\x21-\x7e]", "\x01"))
    count = lambda verdict: F.sum(F.when(F.col("fit.verdict") == verdict, 1).otherwise(0))
    texts = known.groupBy("text").agg(count("allow").alias("allow"), count("block").alias("block"), F.max(F.col("fit").isNull()).alias("open"))
    texts = stored(texts.withColumns({"key": F.monotonically_increasing_id(), "held": F.substr(F.md5("text"), F.lit(1), F.lit(1)).isin(*HELD)}))
    # The held-out URLs take part as texts without a verdict.
    learn = texts.withColumns({c: F.when(F.col("held"), 0).otherwise(F.col(c)).cast("bigint") for c in ("allow", "block")})
    both = learn.agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).first()
    if both["allow"] and both["block"]:
        scored = stored(scores(texts, model(learn, order), order))
    else:
        scored = texts.withColumn("score", F.lit(0.0))
    limit = threshold(scored.where("held"))
    joined = known.join(scored.where("open").select("text", "score"), "text", "left")
    learned = F.when(F.col("score") >= limit, "allow").otherwise("block")
    return joined.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", learned).alias("verdict"), F.when(F.col("fit").isNull(), F.col("score")).alias("score"))
