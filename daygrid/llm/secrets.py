"""Secrets in texts: all rules as one minimised automaton that reads every byte once.

The base rules (``assign``, ``access``, ``hex``) always stay; the others add the published formats of keys and tokens. The matches of a family of rules are
the leftmost longest ones that do not overlap each other; a match that fails its rule's second condition is dropped, and nothing inside it is tried again.
Each base rule is a family of its own. Matches of different families may overlap, and all are returned.

The automaton is compiled once on the driver (its size depends on the rules alone) and sent with the task's code. The scan keeps one
number per text beside the matches, needs no shuffle, and takes time linear in the text: the way back to a match's start ends at the match before.

Defined cases: a NULL text is empty in the result of ``found`` and stays NULL when redacted; an empty text has no spans; repeated rows get
one row each; columns other than id and text are ignored by ``found`` and kept by ``redacted``; an empty table gives no rows. Offsets are code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.automaton import Automaton, compiled


class Rule(NamedTuple):
    kind: str
    pattern: str  # what a match is
    kept: str  # what a match must be, whole, to stay
    family: str  # matches of one family do not overlap
    bounded: bool = False  # starts only where no word goes on


def _cased(words: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", words)


def _assigned(names: str, least: int) -> tuple[str, str]:
    """A name in either case, ":" or "=", and a value; kept if the value has ``least`` characters."""
    head = f"({_cased(names)})" + r"""["']?\x20*[:=]\x20*["']?"""
    return head + "[A-Za-z0-9+/_.=-]+", head + f"[A-Za-z0-9+/_.=-]{{{least},}}"


def _long(head: str, body: str, least: int) -> tuple[str, str]:
    return f"{head}[{body}]+", f"{head}[{body}]{{{least},}}"


# The base rules, and the published formats of other secrets, in the order of spans that start together.
# Runs of hex digits are everywhere, so their least length is in the pattern itself; as runs cannot overlap, that finds the same.
RULES = [
    Rule("assign", *_assigned("password|passwd|secret|token|api_?key", 12), "assign"),
    Rule("access", *_long("AKIA", "A-Z0-9", 14), "access"),
    Rule("hex", "[0-9a-f]{16,}", "[0-9a-f]{16,}", "hex"),
    Rule("named", *_assigned("pwd|passphrase|passcode|credentials?|(access|private|account|signing|encryption)[_-]?key", 8), "format"),
    Rule("github", *_long("gh[oprsu]_", "A-Za-z0-9", 36), "format", True),
    Rule("gitlab", *_long("glpat-", "A-Za-z0-9_-", 20), "format", True),
    Rule("slack", *_long("xox[abeoprs]-", "A-Za-z0-9-", 10), "format", True),
    Rule("google", *_long("AIza", "A-Za-z0-9_-", 35), "format", True),
    Rule("stripe", *_long("[rs]k_(live|test)_", "A-Za-z0-9", 16), "format", True),
    Rule("npm", *_long("npm_", "A-Za-z0-9", 36), "format", True),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_.-]+", r"SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{32,}\.*", "format", True),
    Rule("jwt", r"eyJ[A-Za-z0-9_.-]+", r"eyJ[A-Za-z0-9_-]{6,}\.eyJ[A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]{16,}\.*", "format", True),
    Rule("bearer", *_long(r"[Bb]earer\x20", "A-Za-z0-9._~+/=-", 20), "format", True),
    Rule("login", r"://[A-Za-z0-9._~%-]+:[A-Za-z0-9._~%!$*+-]+@", r"://[^:]+:.{4,}@", "login"),
    Rule("private", r"-----BEGIN\x20([A-Z]+\x20)*PRIVATE\x20KEY-----", r"-----BEGIN\x20([A-Z]+\x20)*PRIVATE\x20KEY-----", "private"),
]

# The first rules are the base.
BASE = 3

SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"
Span = tuple[int, int, str]


@cache
def automaton(rules: tuple[Rule, ...]) -> Automaton:
    return compiled([[(r.pattern, r.bounded) for r in rules if r.family == family] for family in _families(rules)])


def _families(rules: tuple[Rule, ...]) -> list[str]:
    return list(dict.fromkeys(r.family for r in rules))


class Scanner:
    """The compiled rules; sent to the tasks as plain arrays."""

    def __init__(self, rules: list[Rule] | None = None):
        own = tuple(RULES if rules is None else rules)
        self.machine = automaton(own)
        self.kinds = [r.kind for r in own]
        patterns = [(re.compile(r.pattern.encode()), re.compile(r.kept.encode()), k, r.family) for k, r in enumerate(own)]
        self.members = [[p[:3] for p in patterns if p[3] == family] for family in _families(own)]

    def _rule(self, family: int, data: bytes, start: int, end: int) -> int | None:
        """The rule of a match, if it stays."""
        for pattern, kept, rule in self.members[family]:
            if pattern.fullmatch(data, start, end):
                return rule if kept.fullmatch(data, start, end) else None
        return None

    def spans(self, data: bytes) -> list[Span]:
        """Spans of a UTF-8 text, in code points, by start and then in the order of the rules."""
        found = [(start, rule, end) for family, start, end in self.machine.matches(data) if (rule := self._rule(family, data, start, end)) is not None]
        if found and not data.isascii():
            place = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
            found = [(int(place[start]), rule, int(place[end])) for start, rule, end in found]
        return [(start, end, self.kinds[rule]) for start, rule, end in sorted(found)]


def _bytes(column: pa.Array) -> Iterator[bytes]:
    return (x or b"" for x in map(pa.BinaryScalar.as_py, column.cast(pa.binary())))


def found(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """``doc_id, spans``: every span of every text as kind, start and end (exclusive)."""
    scanner = scanner or Scanner()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = [[{"kind": k, "start": s, "end": e} for s, e, k in scanner.spans(data)] for data in _bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(search, f"doc_id bigint, spans {SPANS}")


def redacted_text(text: str, scanner: Scanner) -> str:
    """``text`` with ``[KIND]`` in place of its secrets; spans that overlap become one, named by the first."""
    out, at = [], 0
    for start, end, kind in scanner.spans(text.encode()):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """``docs`` with secrets taken out of ``text``; all other columns stay."""
    scanner = scanner or Scanner()
    place = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[place] = pa.array([t if t is None else redacted_text(t, scanner) for t in map(pa.StringScalar.as_py, columns[place])], batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(clean, docs.schema)
