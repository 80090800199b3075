"""Personal data: base spans by format, and more spans that boosted trees pick from wide candidates.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers by fixed rules; they always stay.
High-recall generators propose more kinds, which may overlap each other and the base: ``secret`` (a long run
of letters and digits), ``number`` (a long run of digits with separators), ``address`` (an e-mail address whose marks are
written out), ``handle`` (a user's name after "@") and ``password`` (what is assigned to such a name, also without digits).

Nobody has labelled the candidates, so each kind learns from what is certain. A secret that is assigned to a
name like ``token`` or ``password`` is one, and a run of another place is taken for none; the trees do not see
that name. A number that is a base span or follows a word like ``tel`` or ``ssn`` is personal; another with the format of a phone or
identity number and groups of digits inside a longer number are left open, and any other is taken for not. The trees see neither that
word nor the "+" that the base looks for. A handle after a word like ``follow`` is one, an annotation of program text is none, others are left
open. A candidate that is surely personal is added also where there are no trees for its kind. The trees see format (lengths, classes of characters, groups, entropy, checksum) and context (marks
and words around it), and so find secrets without a name, and numbers that the fixed rules swallow in a longer run. A kind's threshold is the lowest
score at which its precision on candidates held out of training is at least ``PRECISION``; where there is none, nothing is added.

The trees, their cuts and the thresholds come from all candidates of all documents. A kind with at most ``LOCAL`` of them is fitted by the
driver. One with more is fitted by jobs over the distinct rows of its features: exact quantiles by counts in order, a histogram of each node of
a tree's level, the running precision of held-out scores; only what these sum up to reaches the driver. Both give the same trees.
Every text is searched whole, in the task that reads it.

Defined cases: a NULL text is empty in the result of ``found`` and stays NULL when redacted; repeated rows get one row each; an
empty text has no spans; without candidates of both sorts nothing is learned; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrid.llm.batches import in_small_batches
from daygrid.sizing import stored

# The driver itself fits a kind that has at most so many candidates.
LOCAL = 20_000
# Gradients are summed over tasks as whole multiples of its inverse, so their order does not matter.
SCALE = 2.0**30
PRECISION = 0.95
TREES, DEPTH, RATE, BINS, LEAST = 40, 3, 0.3, 32, 5

# The kinds in the order of spans that start together.
KINDS = ["email", "ip", "card", "phone", "secret", "number", "address", "handle", "password"]

# The kinds that trees are grown for; the others are proposed only where they are certain.
LEARNED = {"secret", "number", "handle"}

# Fixed values of the contract; an address is found from its "@", and a dotted number from the start of its digits, which
# gives the same matches in linear time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_SECRET = re.compile(r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{16,}={0,2}")
_NUMBER = re.compile(r"(?<![0-9])[0-9][0-9 ().-]{6,}[0-9]")
_GROUP = re.compile(r"[0-9]{12,19}")
_NAMED = re.compile(r"(token|secret|key|passw(or)?d|pwd|auth|credential)s?[\"']?\s*[=:]\s*[\"']?$", re.IGNORECASE)
_CALLED = re.compile(
    r"(?<![^\W_])(tel|telephone|phone|mobile|cell|fax|call|whatsapp|telefon|handy|mobil|tel[eé]fono|m[oó]vil|t[eé]l|t[eé]l[eé]phone|portable|ssn|social security|passport|id|identity|identity card|"
    r"national id|personal id|tax id|driver'?s licen[cs]e)(\s+(no|nr|number|num))?\s*[.:=#]*\s*[(]?$",
    re.IGNORECASE,
)
_DATE = re.compile(r"(1[0-9]|20)[0-9]{2}[ .-][0-9]{1,2}[ .-][0-9]{1,2}|[0-9]{1,2}[ .-][0-9]{1,2}[ .-](1[0-9]|20)[0-9]{2}")
_LIKE_PERSONAL = re.compile(r"\(?[0-9]{1,5}\)?([ .-]{1,2}\(?[0-9]{2,5}\)?){1,5}")
_AT = r"(?: ?[\[({<] ?(?:at|@) ?[\])}>] ?| at )"
_DOT = r"(?: ?[\[({<] ?(?:dot|\.) ?[\])}>] ?| dot )"
_ADDRESS = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?:"
    rf"{_AT}[A-Za-z0-9-]{{1,63}}(?:(?:{_DOT}|\.)[A-Za-z0-9-]{{1,63}})*{_DOT}[A-Za-z0-9-]{{2,63}}"
    r"| ?[\[({<] ?(?:at|@) ?[\])}>] ?[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+"
    rf"|@[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}})+)",
    re.IGNORECASE,
)
_WRITTEN = re.compile(r"[\[({<] ?(?:at|@|dot|\.) ?[\])}>]| dot ", re.IGNORECASE)
_HANDLE = re.compile(r"(?<![\w@.%+/-])@[A-Za-z_][A-Za-z0-9_]{1,29}(?![\w@])(?!\.\w)")
_FOLLOWED = re.compile(r"(follow|twitter|instagram|insta|telegram|tiktok|github|user|username|handle|account|dm|contact|message|by|via)( me| us)?( on| at)?\s*[:=]?\s*[(\"']?$", re.IGNORECASE)
_PASSWORD = re.compile(r"(?:passw(?:or)?d|passphrase|passcode|pwd)s?[\"']?\s*(?:[=:]|\bis:)\s*(?:\"([^\"\n]{4,64})\"|'([^'\n]{4,64})'|([^\s\"'<>,;]{4,64}))", re.IGNORECASE)

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            free = domain.end()
        else:
            free = at + 1  # no address reaches over an "@"
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed rules by start, then kind."""
    found: list[Span] = [(s, e, "email") for s, e in emails(text)]
    if _DIGIT.search(text):
        found += [(*m.span(), "ip") for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        found += [(*m.span(), "card") for m in _CARD.finditer(text) if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            found += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


class Candidate(NamedTuple):
    start: int
    end: int
    kind: str
    sure: bool | None  # None: not known


def candidates(text: str, base: list[Span]) -> list[Candidate]:
    """What the generators propose, and whether it is surely personal."""
    out = []
    if _WRITTEN.search(text):
        out += [Candidate(*m.span(), "address", True) for m in _ADDRESS.finditer(text)]
    for m in _HANDLE.finditer(text) if "@" in text else ():
        start, end = m.span()
        line = text[max(0, start - 40) : start].rpartition("\n")[2]
        annotation = not line.strip() and text[end : end + 1] in ("(", "\n", "")
        out.append(Candidate(start, end, "handle", True if _FOLLOWED.search(text, max(0, start - 40), start) else False if annotation else None))
    out += [Candidate(*m.span(m.lastindex), "password", True) for m in _PASSWORD.finditer(text)]
    if not _DIGIT.search(text):
        return out
    out += [Candidate(*m.span(), "secret", bool(_NAMED.search(text, max(0, m.start() - 40), m.start()))) for m in _SECRET.finditer(text) if _DIGIT.search(m[0])]
    taken = {(s, e) for s, e, kind in base if kind in ("card", "phone", "ip")}
    for m in _NUMBER.finditer(text):
        start, end = m.span()
        sure: bool | None = any((s, end) in taken for s in (start, start - 1))  # a phone number's sign stands before
        if not sure:
            if text[max(0, start - 1) : start] == "(" and ")" in m[0].partition("(")[0]:
                start -= 1
            sure = _personal(text, start, end)
        out.append(Candidate(start, end, "number", sure))
        groups = [g.span() for g in _GROUP.finditer(m[0])]
        if len(groups) > 1:
            out += [Candidate(m.start() + s, m.start() + e, "number", None) for s, e in groups]
    return out


def _personal(text: str, start: int, end: int) -> bool | None:
    """What is known of a number that is no base span: True by the word before it, None if only its format is that of a personal one."""
    if end - start > 40 or _DATE.fullmatch(text, start, end) or not 7 <= len(_digits(text[start:end])) <= 15:
        return False
    if _CALLED.search(text, max(0, start - 40), start):
        return True
    return None if _LIKE_PERSONAL.fullmatch(text, start, end) else False


def features(text: str, c: Candidate) -> list[float]:
    """Format and context, but not the name that something is assigned to, nor what makes a number a base span by itself."""
    own = text[c.start : c.end]
    n = len(own)
    digits = sum("0" <= x <= "9" for x in own)
    upper, lower = sum("A" <= x <= "Z" for x in own), sum("a" <= x <= "z" for x in own)
    shares = [own.count(x) / n for x in set(own)]
    groups = [g for g in re.split(r"[^A-Za-z0-9]+", own) if g]
    before, after = text[max(0, c.start - 24) : c.start], text[c.end : c.end + 24]
    return [
        n, digits / n, digits == n and luhn(own), upper / n, lower / n, sum(x in "0123456789abcdefABCDEF" for x in own) / n, -sum(s * math.log(s) for s in shares),
        len(groups), max(map(len, groups)), min(map(len, groups)), own.count(" "), own.count("."), own.count("-"), own.count("("),
        sum(a.isdigit() != b.isdigit() for a, b in zip(own, own[1:], strict=False)) / n,
        before.endswith(("'", '"')) and after.startswith(("'", '"')), before.rstrip(" '\"").endswith(("=", ":")), c.kind != "number" and before.endswith("+"), before[-1:] == "\n" or not before, after[:1] == "\n" or not after,
        sum(x.isalpha() for x in before), sum(x.isalpha() for x in after), any("0" <= x <= "9" for x in before), any("0" <= x <= "9" for x in after),
    ]


class Tree(NamedTuple):
    """Nodes in breadth-first order: the feature (-1: a leaf), its cut, and the value."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.node(x)]

    def node(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        node = np.zeros(len(x), int)
        for _ in range(DEPTH):
            f = self.feature[node]
            right = x[np.arange(len(x)), np.maximum(f, 0)] > self.cut[node]
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return node


class Boosted(NamedTuple):
    start: float
    trees: list[Tree]
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((t.of(x) for t in self.trees), np.zeros(len(x)))


Models = dict[str, Boosted]


def _best_split(left: list[list[np.ndarray]], whole: Sequence[float]) -> tuple[float, int, int]:
    """Gain, feature (-1: none) and cut of the best split; ``left`` has for each feature the sums of gradient, hessian and rows up to each of its cuts."""
    best, (g, h, _) = (1e-6, -1, 0), whole
    for f, low in enumerate(left):
        high = [w - s for w, s in zip(whole, low, strict=True)]
        gain = low[0] ** 2 / (low[1] + 1) + high[0] ** 2 / (high[1] + 1) - g**2 / (h + 1)
        gain[(low[2] < LEAST) | (high[2] < LEAST)] = -1
        if len(gain) and gain.max() > best[0]:
            best = (gain.max(), f, int(gain.argmax()))
    return best


def _empty_tree() -> Tree:
    size = 2 ** (DEPTH + 1) - 1
    return Tree(np.full(size, -1), np.zeros(size), np.zeros(size))


def _grow(x: np.ndarray, bins: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray) -> Tree:
    tree = _empty_tree()
    feature, cut, value = tree
    rows = {0: np.arange(len(x))}
    for node in range(len(value)):
        own = rows.pop(node, None)
        if own is None:
            continue
        g, h = gradient[own], hessian[own]
        value[node] = RATE * g.sum() / (h.sum() + 1.0)
        if node >= 2**DEPTH - 1 or len(own) < 2 * LEAST:
            continue
        ones = np.ones(len(own))
        left = [[np.cumsum(np.bincount(bins[own, f], weights=w, minlength=len(edges) + 1))[:-1] for w in (g, h, ones)] for f, edges in enumerate(cuts)]
        _, f, at = _best_split(left, (g.sum(), h.sum(), len(own)))
        if f >= 0:
            feature[node], cut[node] = f, cuts[f][at]
            high = x[own, f] > cut[node]
            rows[2 * node + 1], rows[2 * node + 2] = own[~high], own[high]
    return tree


def boosted(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Boosted | None:
    """Trees fitted to three quarters of the candidates, their threshold to the rest; None if either sort is rare.

    A row stands for ``weight`` candidates where precision is taken.
    """
    if min(y.sum(), len(y) - y.sum()) < 2 * LEAST:
        return None
    order = np.lexsort(np.column_stack([y, x]).T)
    x, y, weight = x[order], y[order].astype(float), np.ones(len(y)) if weight is None else weight[order]
    test = np.arange(len(y)) % 4 == 3
    fit_x, fit_y = x[~test], y[~test]
    cuts = [np.unique(np.quantile(fit_x[:, f], np.arange(1, BINS) / BINS)) for f in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(c, fit_x[:, f], side="left") for f, c in enumerate(cuts)])
    start = math.log(fit_y.mean() / (1 - fit_y.mean()))
    total, trees = np.full(len(fit_y), start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        trees.append(_grow(fit_x, bins, cuts, fit_y - p, p * (1 - p)))
        total += trees[-1].of(fit_x)
    model = Boosted(start, trees, math.inf)
    score, truth, held = model.score(x[test]), y[test], weight[test]
    limits = [s for s in np.unique(score) if np.average(truth[score >= s], weights=held[score >= s]) >= PRECISION]
    return model._replace(threshold=float(limits[0]) if limits else math.inf)


def _running(rows: DataFrame, groups: list[str], order: list[Column], sums: list[str]) -> DataFrame:
    """``rows``, and as ``<sum>_before`` the sums over those of the group that come before in ``order``, which has no ties.

    Rows are sorted in ranges, and each adds what the ranges before it sum up to; no group is in one task.
    """
    ranges = stored(rows.repartitionByRange(*groups, *order).withColumn("range", F.spark_partition_id()))
    whole = ranges.groupBy(*groups, "range").agg(*[F.sum(c).alias(c) for c in sums])
    inside = Window.partitionBy(*groups, "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*groups).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    until = whole.select(*groups, "range", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_until") for c in sums])
    both = ranges.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{c}_inside") for c in sums]).join(F.broadcast(until), [*groups, "range"])
    return both.select(*rows.columns, *[(F.col(f"{c}_inside") + F.col(f"{c}_until")).alias(f"{c}_before") for c in sums])


def _quantile(values: dict[int, float], n: int, share: float) -> float:
    """As ``np.quantile``, from the values at the places around it."""
    at = share * (n - 1)
    low, high, t = values[math.floor(at)], values[math.ceil(at)], at - math.floor(at)
    return high - (high - low) * (1 - t) if t >= 0.5 else low + (high - low) * t


def _all_cuts(rows: DataFrame, sizes: dict[str, int]) -> dict[str, list[np.ndarray]]:
    """The exact quantiles of each feature by kind, from ``kind, x, n`` where ``sizes`` are the sums of ``n``."""
    shares = np.arange(1, BINS) / BINS
    places = {kind: sorted({p for s in shares for p in (math.floor(s * (n - 1)), math.ceil(s * (n - 1)))}) for kind, n in sizes.items()}
    values = rows.select("kind", "n", F.posexplode("x").alias("f", "value")).groupBy("kind", "f", "value").agg(F.sum("n").alias("n"))
    placed = _running(values, ["kind", "f"], [F.col("value")], ["n"])
    wanted = F.coalesce(*[F.when(F.col("kind") == kind, F.array(*[F.lit(p).cast("bigint") for p in own])) for kind, own in places.items()])
    at = F.filter(wanted, lambda p: (p >= F.col("n_before")) & (p < F.col("n_before") + F.col("n")))
    found: dict[tuple[str, int], dict[int, float]] = {}
    for r in placed.select("kind", "f", "value", F.explode(at).alias("place")).collect():
        found.setdefault((r.kind, r.f), {})[r.place] = r.value
    return {kind: [np.unique([_quantile(found[kind, f], n, s) for s in shares]) for f in sorted(f for k, f in found if k == kind)] for kind, n in sizes.items()}


def boosted_by_jobs(rows: DataFrame) -> Models:
    """:func:`boosted` for every kind of ``kind, sure, x, n`` (distinct features, and how many candidates have them), whatever their number."""
    totals: dict[str, list[int]] = {}
    for r in rows.groupBy("kind", "sure").agg(F.sum("n").alias("n")).collect():
        totals.setdefault(r.kind, [0, 0])[r.sure] = r.n
    kinds = sorted(kind for kind, both in totals.items() if min(both) >= 2 * LEAST)
    if not kinds:
        return {}
    # Every fourth candidate, in the order of features from the last to the first, is held out.
    order = [F.reverse("x"), F.col("sure")]
    placed = _running(rows.where(F.col("kind").isin(kinds)), ["kind"], order, ["n"])
    held = F.floor((F.col("n_before") + F.col("n")) / 4) - F.floor(F.col("n_before") / 4)
    placed = stored(placed.select("kind", "sure", "x", (F.col("n") - held).alias("n"), held.alias("held")))
    fit: dict[str, list[int]] = {kind: [0, 0] for kind in kinds}
    for r in placed.groupBy("kind", "sure").agg(F.sum("n").alias("n")).collect():
        fit[r.kind][r.sure] = r.n
    cuts = _all_cuts(placed.where("n > 0"), {kind: sum(both) for kind, both in fit.items()})
    starts = {kind: math.log((y / (n + y)) / (1 - y / (n + y))) for kind, (n, y) in fit.items()}

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").flatten()).reshape(batch.num_rows, -1)
            own, bins = np.array(batch.column("kind").to_pylist()), np.zeros(x.shape, "u1")
            for kind in np.unique(own):
                mine = own == kind
                bins[mine] = np.column_stack([np.searchsorted(c, x[mine, f], side="left") for f, c in enumerate(cuts[str(kind)])])
            packed = pa.array([b.tobytes() for b in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("sure"), packed, batch.column("n"), batch.column("held")], names=["kind", "sure", "bins", "n", "held"])

    binned = placed.mapInArrow(to_bins, "kind string, sure boolean, bins binary, n bigint, held bigint")
    binned = stored(binned.groupBy("kind", "sure", "bins").agg(F.sum("n").alias("n"), F.sum("held").alias("held")))
    by_bin: dict[str, list[Tree]] = {kind: [] for kind in kinds}  # their cuts are numbers of bins
    for _ in range(TREES):
        for kind, tree in _grown(binned.where("n > 0"), starts, by_bin, cuts).items():
            by_bin[kind].append(tree)
    limits = _thresholds(binned.where("held > 0"), {kind: Boosted(starts[kind], by_bin[kind], math.inf) for kind in kinds})
    models = {}
    for kind, trees in by_bin.items():
        real = [t._replace(cut=np.array([cuts[kind][f][int(c)] if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut, strict=True)])) for t in trees]
        models[kind] = Boosted(starts[kind], real, limits.get(kind, math.inf))
    return models


def _by_kind(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """Kind, bins, label and number of rows ``kind, bins, sure, n``, kind by kind."""
    for batch in batches:
        own = np.array(batch.column(0).to_pylist())
        bins = np.frombuffer(b"".join(batch.column(1).to_pylist()), "u1").reshape(batch.num_rows, -1)
        sure, n = np.array(batch.column(2).to_pylist(), bool), np.array(batch.column(3))
        for kind in np.unique(own):
            yield str(kind), bins[own == kind], sure[own == kind], n[own == kind]


def _grown(rows: DataFrame, starts: dict[str, float], trees: dict[str, list[Tree]], cuts: dict[str, list[np.ndarray]]) -> dict[str, Tree]:
    """The next tree of each kind, one job for each of its levels; cuts are numbers of bins."""
    grown = {kind: _empty_tree() for kind in starts}
    for depth in range(DEPTH):
        first, nodes = 2**depth - 1, 2**depth

        def histograms(batches: Iterator[pa.RecordBatch], first: int = first, nodes: int = nodes) -> Iterator[pa.RecordBatch]:
            sums: dict[str, np.ndarray] = {}
            for kind, bins, sure, n in _by_kind(batches):
                total = np.full(len(bins), starts[kind])
                for tree in trees[kind]:
                    total += tree.of(bins)
                p = 1 / (1 + np.exp(-total))
                at, width = grown[kind].node(bins), bins.shape[1]
                cell = (((at - first) * width)[:, None] + np.arange(width)) * BINS + bins
                cell, here = cell[at >= first].ravel(), at >= first  # a leaf above this level has no children
                parts = [np.rint(w * SCALE) * n for w in (sure - p, p * (1 - p))] + [n]
                new = [np.bincount(cell, weights=np.repeat(w[here], width), minlength=nodes * width * BINS).astype("i8") for w in parts]
                sums[kind] = sums.get(kind, 0) + np.array(new)
            for kind, own in sums.items():
                some = np.flatnonzero(own[2])
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(some), pa.string()), pa.array(some), *[pa.array(w[some]) for w in own]], names=["kind", "cell", "g", "h", "n"])

        out = rows.select("kind", "bins", "sure", "n").mapInArrow(histograms, "kind string, cell bigint, g bigint, h bigint, n bigint")
        whole = out.groupBy("kind", "cell").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")]).toPandas()
        for kind, own in whole.groupby("kind"):
            tree, width = grown[kind], len(cuts[kind])
            cells = np.zeros((3, nodes * width * BINS))
            cells[:, own["cell"]] = own[["g", "h", "n"]].to_numpy(float).T / np.array([[SCALE], [SCALE], [1.0]])
            for k, sums in enumerate(cells.reshape(3, nodes, width, BINS).transpose(1, 0, 2, 3)):
                g, h, n = sums[:, 0].sum(axis=1)
                node = first + k
                if not depth:
                    tree.value[node] = RATE * g / (h + 1.0)
                if n < 2 * LEAST:
                    continue
                left = [[np.cumsum(w[f])[: len(edges)] for w in sums] for f, edges in enumerate(cuts[kind])]
                _, f, at = _best_split(left, (g, h, n))
                if f >= 0:
                    tree.feature[node], tree.cut[node] = f, at
                    low = [w[at] for w in left[f]]
                    for child, (cg, ch) in ((2 * node + 1, low[:2]), (2 * node + 2, (g - low[0], h - low[1]))):
                        tree.value[child] = RATE * cg / (ch + 1.0)
    return grown


def _thresholds(rows: DataFrame, models: Models) -> dict[str, float]:
    """For each kind the lowest score of held-out rows from which on upwards precision is high enough; none where there is no such score."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, bins, sure, n in _by_kind(batches):
            columns = [pa.array([kind] * len(n), pa.string()), pa.array(models[kind].score(bins)), pa.array(n), pa.array(n * sure)]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "score", "n", "true"])

    scored = rows.select("kind", "bins", "sure", F.col("held").alias("n")).mapInArrow(score, "kind string, score double, n bigint, true bigint")
    scored = scored.groupBy("kind", "score").agg(F.sum("n").alias("n"), F.sum("true").alias("true"))
    above = _running(scored, ["kind"], [F.col("score").desc()], ["n", "true"])
    precise = (F.col("true_before") + F.col("true")) / (F.col("n_before") + F.col("n")) >= PRECISION
    return {r.kind: r.score for r in above.where(precise).groupBy("kind").agg(F.min("score").alias("score")).collect()}


def fitted(docs: DataFrame, sample: int | None = None) -> Models:
    """A model for each kind that the candidates allow, from all of them.

    Only on request it is fitted to a draw of about ``sample`` candidates of each kind and label, which then count for those they stand for.
    """
    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.xxhash64("doc_id", "text").alias("hash")).where(F.col("text").rlike("[0-9@]"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (c.kind, c.sure, zlib.crc32(f"{own} {c.start} {c.kind}".encode()) / 2**32, list(map(float, features(text, c))))
                for text, own in zip(map(pa.StringScalar.as_py, batch.column(0)), batch.column(1).to_pylist(), strict=True)
                for c in candidates(text, base_spans(text))
                if c.sure is not None and c.kind in LEARNED
            ]
            kinds = [pa.string(), pa.bool_(), pa.float64(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["kind", "sure", "draw", "x"])

    measured = stored(in_small_batches(rows).mapInArrow(measure, "kind string, sure boolean, draw double, x array<double>"))
    totals = {(r.kind, r.sure): r.n for r in measured.groupBy("kind", "sure").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = {kind: sum(n for (k, _), n in totals.items() if k == kind) for kind in sorted({k for k, _ in totals})}
    shares = {key: min(1.0, sample / n) if sample else 1.0 for key, n in totals.items()}
    many = [kind for kind, n in sizes.items() if n > LOCAL and not sample]
    models: dict[str, Boosted | None] = {}
    if few := [kind for kind in sizes if kind not in many]:
        drawn = reduce(lambda a, b: a | b, [(F.col("kind") == k) & (F.col("sure") == s) & (F.col("draw") < share) for (k, s), share in shares.items() if k in few])
        for kind, own in measured.where(drawn).select("kind", "sure", "x").toPandas().groupby("kind"):
            sure = own["sure"].to_numpy(bool)
            models[kind] = boosted(np.array(own["x"].tolist()), sure, np.array([1 / shares[kind, bool(s)] for s in sure]))
    if many:
        distinct = measured.where(F.col("kind").isin(many)).groupBy("kind", "sure", "x").agg(F.count(F.lit(1)).alias("n"))
        models.update(boosted_by_jobs(distinct))
    return {kind: models[kind] for kind in sizes if models.get(kind) is not None}


def all_spans(text: str, models: Models) -> tuple[list[Span], list[Span]]:
    """Base spans, and these with the added ones; an added one is sure or good enough, and overlaps neither the base nor a better one."""
    base = base_spans(text)
    taken, added = _merged([(s, e) for s, e, _ in base]), []
    proposed = [c for c in candidates(text, base) if c.kind in models or c.sure]
    if proposed:
        x = np.array([list(map(float, features(text, c))) for c in proposed])
        margin = np.zeros(len(proposed))
        for kind, model in models.items():
            own = np.array([c.kind == kind for c in proposed])
            if own.any():
                margin[own] = model.score(x[own]) - model.threshold
        margin = np.maximum(margin, [0 if c.sure else -math.inf for c in proposed])
        for k in np.argsort(-margin, kind="stable"):
            c = proposed[k]
            at = bisect_left(taken, (c.end,))  # what is taken from here on starts behind it
            if margin[k] >= 0 and (not at or taken[at - 1][1] <= c.start):
                taken.insert(at, (c.start, c.end))
                added.append((c.start, c.end, c.kind))
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of intervals, as intervals that do not overlap, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def found(docs: DataFrame, models: Models) -> DataFrame:
    """``doc_id``, the number of base spans of each kind, their digest, and all spans."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [all_spans(text or "", models) for text in map(pa.StringScalar.as_py, batch.column(1))]
            numbers = [pa.array([sum(kind == k for _, _, kind in base) for base, _ in spans], pa.int64()) for k in KINDS[:4]]
            digests = pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in spans], pa.string())
            joined = pa.array([_joined(every) for _, every in spans], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, digests, joined], names=["doc_id", *(f"n_{k}" for k in KINDS[:4]), "base_sha256", "spans"])

    numbers = ", ".join(f"n_{k} bigint" for k in KINDS[:4])
    return in_small_batches(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))).mapInArrow(search, f"doc_id bigint, {numbers}, base_sha256 string, spans string")


def redacted_text(text: str, models: Models) -> str:
    """``text`` with ``[KIND]`` in place of each span; spans that overlap become one, named by the first."""
    out, at, k = [], 0, 0
    _, spans = all_spans(text, models)
    while k < len(spans):
        start, reach, kind = spans[k]
        k += 1
        while k < len(spans) and spans[k][0] < reach:
            reach = max(reach, spans[k][1])
            k += 1
        out += [text[at:start], f"[{kind.upper()}]"]
        at = reach
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, models: Models) -> DataFrame:
    """``docs`` with personal data taken out of ``text`` (and ``n_chars``, if there, following it); all other columns stay."""
    names = docs.columns
    place = names.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None else redacted_text(t, models) for t in map(pa.StringScalar.as_py, batch.column(place))]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = in_small_batches(docs).mapInArrow(clean, docs.schema)
    return out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), "n_chars")) if "n_chars" in names else out
