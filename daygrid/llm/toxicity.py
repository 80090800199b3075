"""Toxicity by weak supervision: voters, a generative label model over them, a linear classifier.

Voters. A lexicon entry is a word or the beginning of words; it votes ``toxic`` for a text in which at least one word
in ``1 / RATE`` is one of its own. A few entries are given; the others are mined from labelled
texts: words and beginnings that are at that rate in toxic texts much more often than chance allows. Pattern
voters judge all entries together (their share of the words, how many differ) and the way of writing; they also vote
``clean``. The label of a training text is one more voter, since labels err too.

Label model. The true class is latent; each voter has a probability of each vote (toxic, clean, none) given the class,
fitted by expectation and maximisation from the votes alone. Voters that agree beyond what the class explains (beginnings of the same
words do) are found by their correlation given the class and share one voice, and the model is fitted again.

Classifier. Logistic regression on the shares of the entries, trained on the posterior of the label model, gives the score.

The fit uses at most ``SAMPLE`` labelled rows outside the held-out fold, drawn by a hash of their id; everything
it learns is a few hundred numbers. Every text is scored whole, in the task that reads it.

Defined cases: NULL and empty texts have no words and get the score of the intercept; a NULL id counts as the empty string for the
fold; of several labels for an id the largest counts, NULL labels none; without labelled rows of both classes the given
entries decide alone, and with them the share of words at which they do is ``RATE``; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.llm.batches import in_small_batches
from daygrid.sizing import stored

FOLDS = 5
SAMPLE = 20_000
RATE = 0.006
# A mined entry needs this log-likelihood ratio (chance: below 1e-5), so many toxic texts, and this lift.
LEAST_EVIDENCE, LEAST_TEXTS, LEAST_LIFT = 20.0, 3, 4.0
# Mined entries that vote, after redundant beginnings have gone; of those before, so many at most reach the driver.
ENTRIES, MINED = 500, 20_000
# A beginning gives way to a continuation that finds this share of its toxic texts.
SAME = 0.8
PREFIXES = (3, 4, 5, 6, 7)
# Correlation given the class from which two voters share one voice.
ALIKE = 0.25

# Insults that need no corpus to be known, in English, German, French and Spanish.
GIVEN = (
    "idiot idiots moron morons stupid dumb loser losers scum trash pathetic worthless disgusting clown filth vermin bastard bitch "
    "dummkopf trottel arschloch abschaum idioten connard imbécile salaud ordure abruti estúpido imbécil basura escoria gilipollas"
).split()
_SECOND_PERSON = re.compile(r"\b(you are|you're|du bist|tu es|eres)\b")

_WORDS = re.compile(r"[^\W\d_]+")
CACHE_WORDS = 200_000


class Model(NamedTuple):
    entries: list[str]  # "=word" or a beginning
    weights: list[float]
    intercept: float


class _Entries(dict):
    """The entries that a word belongs to, by position."""

    def __init__(self, entries: list[str]):
        super().__init__()
        self.places = {e: i for i, e in enumerate(entries)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.places[e] for e in [f"={word}", *(word[:k] for k in PREFIXES if len(word) > k)] if e in self.places)
        if len(self) < CACHE_WORDS and len(word) <= 64:
            self[word] = found
        return found


def _words(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def counts(text: str, entries: _Entries) -> tuple[Counter, int, int, int]:
    """Words by entry, words in any entry, different ones of them, and words."""
    words = _words(text)
    hits = [w for w in words if entries[w]]
    by_entry = Counter(i for w in hits for i in entries[w])
    return by_entry, len(hits), len(set(hits)), len(words)


def features(text: str, entries: _Entries, n: int) -> np.ndarray:
    """Shares of the words in units of ``RATE`` (at most 4): of each of the ``n`` entries, of all, of different ones; and whether all is in capitals."""
    by_entry, hits, different, words = counts(text, entries)
    row = np.zeros(n + 3)
    if words:
        for i, k in by_entry.items():
            row[i] = min(4.0, k / words / RATE)
        row[n], row[n + 1] = min(4.0, hits / words / RATE), min(4.0, different / words / RATE)
        row[n + 2] = text.isupper()
    return row


def votes(row: np.ndarray, text: str, label: int) -> np.ndarray:
    """1 toxic, -1 clean, 0 none: of each entry, of the patterns, and of the label."""
    all_, different, capitals = row[-3:]
    rude = bool(_SECOND_PERSON.search(text.lower()))
    patterns = [
        1 if all_ >= 1.5 else -1 if all_ < 0.75 else 0,
        1 if different >= 1 else -1 if all_ == 0 else 0,
        1 if capitals and all_ >= 1 else 0,
        1 if rude and all_ >= 1 else 0,
    ]
    return np.concatenate([(row[:-3] >= 1).astype(int), patterns, [2 * label - 1]]).astype(np.int8)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``text, toxic`` of at most about ``sample`` labelled rows outside the held-out fold."""
    known = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label"))
    own = known.where(~held_out(F.col("doc_id")))
    total = own.count()
    if total > sample:
        own = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * sample / total))
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(own, "doc_id").select("text", F.col("label").alias("toxic"))


def mined(rows: DataFrame) -> list[str]:
    """Entries by evidence: how far their presence departs from independence of the label, over ``rows`` (``text, toxic``)."""

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = Counter(_words(text))
                n, by_entry = sum(own.values()), Counter()
                for word, k in own.items():
                    by_entry[f"={word}"] += k
                    for length in PREFIXES:
                        if len(word) > length:
                            by_entry[word[:length]] += k
                total[int(toxic > 0)].update(e for e, k in by_entry.items() if k >= RATE * n)
                total[int(toxic > 0)][""] += 1
        names = list(total[0].keys() | total[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([total[c][e] for e in names], pa.int64()) for c in (1, 0))], names=["entry", "t", "c"])

    summed = stored(in_small_batches(rows).mapInArrow(presence, "entry string, t bigint, c bigint").groupBy("entry").agg(F.sum("t").alias("t"), F.sum("c").alias("c")), small=True)
    texts = summed.where("entry = ''").first()
    if texts is None or not texts["t"] or not texts["c"]:
        return []
    share = texts["t"] / (texts["t"] + texts["c"])
    n, t, c = F.col("t") + F.col("c"), F.col("t"), F.col("c")
    evidence = 2 * (t * F.log(t / (n * share)) + F.when(c > 0, c * F.log(c / (n * (1 - share)))).otherwise(0.0))
    lift = (t + 0.5) / texts["t"] / ((c + 0.5) / texts["c"])
    strong = summed.where((F.col("entry") != "") & (t >= LEAST_TEXTS) & (lift >= LEAST_LIFT)).withColumn("evidence", evidence).where(F.col("evidence") >= LEAST_EVIDENCE)
    best = strong.orderBy(F.round("evidence", 6).desc(), "entry").limit(MINED).select("entry", "t").collect()
    return _most_specific({r["entry"]: r["t"] for r in best})[:ENTRIES]


def _most_specific(texts: dict[str, int]) -> list[str]:
    """Without the beginnings that find little more than one of their own continuations does."""
    longest: dict[str, int] = {}  # by beginning: the texts of the continuation that is in most
    for entry, n in texts.items():
        whole = entry.removeprefix("=")
        for own in {whole[:k] for k in PREFIXES if k <= len(whole)} - {entry}:
            longest[own] = max(longest.get(own, 0), n)
    return [e for e, n in texts.items() if e[0] == "=" or longest.get(e, 0) < SAME * n]


def label_model(cast: np.ndarray, n: np.ndarray | None = None, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Posterior probability of the toxic class for each row of votes, and each voter's weight (its share of a voice).

    ``n``: how often each row occurs (once).
    """
    # Near copies of one voter would pass for the class itself: they share a voice from the start.
    n = np.ones(len(cast)) if n is None else n.astype(float)
    weight = 1 / _voices(cast, n, np.ones(len(cast)), 0.9)
    start = np.clip(0.5 + 0.4 * np.sign((cast > 0) @ weight - (cast < 0) @ weight), 0.05, 0.95)
    posterior = _fit(cast, n, weight, start, rounds)
    weight = 1 / _voices(cast, n, posterior, ALIKE)
    return _fit(cast, n, weight, start, rounds), weight


def _fit(cast: np.ndarray, n: np.ndarray, weight: np.ndarray, posterior: np.ndarray, rounds: int) -> np.ndarray:
    is_vote = [(cast == v).astype(float) for v in (1, -1, 0)]
    for _ in range(rounds):
        prior = np.clip(np.average(posterior, weights=n), 1e-3, 0.5)
        logit = np.full(len(cast), math.log(prior / (1 - prior)))
        for own in is_vote:
            given_toxic = ((n * posterior) @ own + 0.1) / (n @ posterior + 0.3)
            given_clean = ((n * (1 - posterior)) @ own + 0.1) / (n @ (1 - posterior) + 0.3)
            logit += own @ (weight * np.log(given_toxic / given_clean))
        after = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(after - posterior).max() < 1e-6:
            return after
        posterior = after
    return posterior


def _voices(cast: np.ndarray, n: np.ndarray, posterior: np.ndarray, alike_from: float) -> np.ndarray:
    """Among how many voters each one's voice is shared: the sum of its correlations given the class."""
    toxic = (cast > 0).astype(float)
    shared = np.zeros((cast.shape[1],) * 2)
    for p in (n * posterior, n * (1 - posterior)):
        mean = p @ toxic / max(p.sum(), 1e-9)
        shared += ((toxic - mean) * p[:, None]).T @ (toxic - mean)
    spread = np.sqrt(np.maximum(np.diag(shared), 1e-9))
    correlation = shared / np.outer(spread, spread)
    np.fill_diagonal(correlation, 1.0)
    return np.where(correlation > alike_from, np.minimum(correlation, 1.0), 0.0).sum(axis=1)


def logistic(x: np.ndarray, target: np.ndarray, n: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights, the intercept last, by Newton steps; targets are probabilities, ``n`` the number of each row. The intercept is not shrunk."""
    x = np.column_stack([x, np.ones(len(x))])
    w, shrink = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.diag(shrink), x.T @ (n * (p - target)) + shrink * w)
        w = w - step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = stored(training_rows(docs, labels, sample))
    entries = list(dict.fromkeys([*(f"={w}" for w in GIVEN), *mined(rows)]))
    n = len(entries)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Entries(entries)
        for batch in batches:
            out_x, out_v = [], []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = features(text, known, n)
                out_x.append(row.tobytes())
                out_v.append(votes(row, text, int(toxic > 0)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out_x, pa.binary()), pa.array(out_v, pa.binary())], names=["x", "votes"])

    # Bounded by the sample and the number of entries; texts without any entry are mostly equal, and sent once.
    equal = rows.mapInArrow(measure, "x binary, votes binary").groupBy("x", "votes").agg(F.count("*").alias("n"))
    measured = equal.toPandas().sort_values(["x", "votes"])  # the same sums on every run
    x = np.frombuffer(b"".join(map(bytes, measured["x"]))).reshape(len(measured), n + 3)
    cast = np.frombuffer(b"".join(map(bytes, measured["votes"])), np.int8).reshape(len(measured), n + 5)
    times = measured["n"].to_numpy(float)
    if len(set(cast[:, -1])) < 2:
        plain = np.zeros(n + 3)
        plain[n] = 8.0  # the share of given words alone, even at RATE
        return Model(entries, plain.tolist(), -8.0)
    posterior, _ = label_model(cast, times)
    w = logistic(x, posterior, times)
    return Model(entries, np.round(w[:-1], 9).tolist(), round(float(w[-1]), 9))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights, n = _Entries(model.entries), np.array(model.weights), len(model.entries)
        for batch in batches:
            logits = [float(features(text or "", known, n) @ weights) + model.intercept for text in map(pa.StringScalar.as_py, batch.column(1))]
            scores = 1 / (1 + np.exp(-np.clip(np.array(logits), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(scores, 9), pa.float64())], names=["doc_id", "score"])

    return in_small_batches(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))).mapInArrow(score, "doc_id bigint, score double")


def judged(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    found = scored(docs, fitted(docs, labels, sample))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic; all columns stay."""
    fields = [f.name for f in docs.schema.fields]
    place = fields.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights, n = _Entries(model.entries), np.array(model.weights), len(model.entries)
        for batch in batches:
            texts = map(pa.StringScalar.as_py, batch.column(place))
            scores = [1 / (1 + math.exp(-max(-30.0, min(30.0, float(features(t or "", known, n) @ weights) + model.intercept)))) for t in texts]
            yield batch.filter(pa.array([round(s, 9) < 0.5 for s in scores], pa.bool_()))

    return in_small_batches(docs).mapInArrow(keep, docs.schema)
