"""Many regular expressions as one deterministic automaton over bytes; plain helpers for use inside tasks.

Rules are compiled by Thompson's construction and subset construction, each family of rules by itself and then all together, and
minimised into one array of transitions, so a text is read once, byte by byte, whatever the number of rules. A state knows, for every
family, the matches that may still be running, the one that started first in front; it tells which families' leftmost longest match ended
before the byte just read. Where that match starts is read backwards, with a small automaton of the family alone.

Matches of a family do not overlap, those of different families may. Each family that can be inside a match beside the others multiplies
the states, so rules that need not overlap belong in one. A match must end where it can no longer grow: after its first full match
every further byte that keeps it alive completes it again, as with a repeated class at the end; and a match must not end while an
earlier one of its family is still open. ``compiled`` refuses other rules, and rules that match nothing.

Patterns are ASCII: literals, ``\\xHH`` and escaped marks, ``[...]`` with ranges, ``(...)``, ``|``, ``?``, ``*``, ``+``, ``{m}``, ``{m,}``, ``{m,n}``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

from daygrid.llm.shingles import mix

# No byte of UTF-8: ends every text, and every match.
END = b"\xff"

# Bytes that a bounded rule's match may not follow.
WORD = frozenset(b"-0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz")

Family = list[tuple[str, bool]]  # patterns whose matches do not overlap, and whether they start only where no word goes on
Node = tuple  # ("set", frozenset) | ("seq", nodes) | ("alt", nodes) | ("repeat", node, least, most or None)


def parsed(pattern: str) -> Node:
    at = 0

    def peek() -> str:
        return pattern[at : at + 1]

    def take() -> str:
        nonlocal at
        if at >= len(pattern):
            raise ValueError(f"pattern ends early: {pattern}")
        at += 1
        return pattern[at - 1]

    def expect(mark: str) -> None:
        if take() != mark:
            raise ValueError(f"{mark} expected at {at - 1}: {pattern}")

    def escaped() -> int:
        mark = take()
        if mark == "x":
            return int(take() + take(), 16)
        if mark.isalnum():
            raise ValueError(f"unknown escape: {pattern}")
        return ord(mark)

    def byte() -> int:
        mark = take()
        return escaped() if mark == "\\" else ord(mark)

    def either() -> Node:
        options = [sequence()]
        while peek() == "|":
            take()
            options.append(sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence() -> Node:
        items = []
        while peek() not in ("", "|", ")"):
            items.append(repeated())
        return ("seq", items)

    def repeated() -> Node:
        node = atom()
        while peek() in ("?", "*", "+", "{") and peek():
            mark = take()
            if mark == "{":
                least = number()
                most: int | None = least
                if peek() == ",":
                    take()
                    most = number() if peek() != "}" else None
                expect("}")
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[mark]
            node = ("repeat", node, least, most)
        return node

    def number() -> int:
        digits = ""
        while peek().isdigit():
            digits += take()
        return int(digits)

    def atom() -> Node:
        if peek() == "(":
            take()
            node = either()
            expect(")")
            return node
        if peek() == "[":
            take()
            found: set[int] = set()
            while peek() != "]":
                first = last = byte()
                if peek() == "-" and pattern[at + 1 : at + 2] != "]":
                    take()
                    last = byte()
                found.update(range(first, last + 1))
            take()
            return ("set", frozenset(found))
        return ("set", frozenset([byte()]))

    tree = either()
    if at < len(pattern):
        raise ValueError(f"unbalanced pattern: {pattern}")
    return tree


def reversed_tree(node: Node) -> Node:
    if node[0] == "seq":
        return ("seq", [reversed_tree(n) for n in reversed(node[1])])
    if node[0] == "alt":
        return ("alt", [reversed_tree(n) for n in node[1]])
    return ("repeat", reversed_tree(node[1]), *node[2:]) if node[0] == "repeat" else node


class Nfa:
    """Thompson's automaton of some trees: a start and a final state for each, moves on bytes and empty moves."""

    def __init__(self, trees: list[Node]):
        self.moves: list[tuple[frozenset, int] | None] = []
        self.empty: list[list[int]] = []
        self.starts = [self._new() for _ in trees]
        self.finals = [self._add(tree, at) for tree, at in zip(trees, self.starts, strict=True)]
        self._closed: dict[frozenset, frozenset] = {}

    def _new(self) -> int:
        self.moves.append(None)
        self.empty.append([])
        return len(self.moves) - 1

    def _link(self, a: int, b: int) -> None:
        self.empty[a].append(b)

    def _add(self, node: Node, at: int) -> int:
        if node[0] == "set":
            inner, end = self._new(), self._new()
            self._link(at, inner)
            self.moves[inner] = (node[1], end)
            return end
        if node[0] == "seq":
            for part in node[1]:
                at = self._add(part, at)
            return at
        end = self._new()
        if node[0] == "alt":
            for option in node[1]:
                self._link(self._add(option, at), end)
            return end
        _, inner, least, most = node
        for _ in range(least):
            at = self._add(inner, at)
        if most is None:
            loop = self._new()
            self._link(at, loop)
            self._link(self._add(inner, loop), loop)
            self._link(loop, end)
            return end
        self._link(at, end)
        for _ in range(most - least):
            at = self._add(inner, at)
            self._link(at, end)
        return end

    def closure(self, states: frozenset) -> frozenset:
        """What empty moves reach; only states that matter later (they move, or are final) are kept."""
        if states not in self._closed:
            seen, left = set(states), list(states)
            while left:
                for to in self.empty[left.pop()]:
                    if to not in seen:
                        seen.add(to)
                        left.append(to)
            self._closed[states] = frozenset(s for s in seen if self.moves[s] or s in self.finals)
        return self._closed[states]

    def step(self, states: frozenset, byte: int) -> frozenset:
        return self.closure(frozenset(m[1] for s in states if (m := self.moves[s]) and byte in m[0]))


def byte_classes(nfas: list[Nfa]) -> tuple[bytes, list[int]]:
    """The class of each byte, and one byte of each class; bytes of a class move all automata alike."""
    sets = [WORD, *sorted({m[0] for nfa in nfas for m in nfa.moves if m}, key=sorted)]
    kinds: dict[tuple, int] = {}
    own = [kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(255)]
    return bytes([*own, len(kinds)]), [*map(own.index, range(len(kinds))), END[0]]


Running = tuple[tuple[frozenset, bool], ...]  # possible matches of a family, the earliest first: states, whether it has matched


def _advance(nfa: Nfa, running: Running, fresh: frozenset, byte: int) -> tuple[Running, bool]:
    """The possible matches after ``byte``, where ``fresh`` may start, and whether a match ended before it."""
    kept: list[tuple[frozenset, bool]] = []
    seen: frozenset = frozenset()
    ended = False
    for states, matched in (*running, (fresh, False)):
        after = nfa.step(states, byte) - seen
        if matched and not after:
            if kept:
                raise ValueError("a match ends while an earlier one is open")
            ended = True
        if not after:
            continue
        full = not after.isdisjoint(nfa.finals)
        if matched and not full:
            raise ValueError("a match goes on without being one")
        kept.append((after, full))
        seen |= after
        if full:  # later starts lie inside this match
            break
    return tuple(kept), ended


def _forward(family: Family, nfa: Nfa, first: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The least table of one family, by state and class, from state 0; and whether a state tells that a match has ended."""
    everywhere = nfa.closure(frozenset(at for at, (_, bounded) in zip(nfa.starts, family, strict=True) if not bounded))
    anywhere = nfa.closure(frozenset(nfa.starts))
    if not anywhere.isdisjoint(nfa.finals):
        raise ValueError("a rule matches the empty text")
    has_bounds = everywhere != anywhere
    numbers: dict[tuple, int] = {((), False, False): 0}
    rows = []
    for running, _, inside in (queue := list(numbers)):
        row = []
        for byte in first:
            state = (*_advance(nfa, running, everywhere if inside else anywhere, byte), has_bounds and byte in WORD)
            if state not in numbers:
                numbers[state] = len(numbers)
                queue.append(state)
            row.append(numbers[state])
        rows.append(row)
    return minimised(np.array(rows), np.array([ended for _, ended, _ in queue], int))


def minimised(table: np.ndarray, told: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal states merged (Moore's refinement), state 0 first: the least table, and what its states tell."""
    kind = np.unique(told, return_inverse=True)[1]
    weights = np.random.default_rng(0).integers(1, 2**63, table.shape[1] + 1, np.uint64) | np.uint64(1)
    while True:
        # Rows are compared by a 64-bit sum of products.
        sums = kind.astype(np.uint64) * weights[-1]
        for c in range(table.shape[1]):
            sums += mix(kind[table[:, c]].astype(np.uint64) + np.uint64(1)) * weights[c]
        finer = np.unique(sums, return_inverse=True)[1]
        if finer.max() == kind.max():
            break
        kind = finer
    first = np.unique(kind, return_index=True)[1]
    order = np.argsort(first)  # kinds in the order of their first states
    place = np.argsort(order)
    return place[kind[table[first[order]]]], told[first[order]]


def product(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The automaton that runs all ``parts`` at once, as far as it can be reached from their states 0; it tells a bit for each part."""
    states = np.zeros((1, len(parts)), np.int64)
    sizes = np.array([len(table) for table, _ in parts])
    if np.log2(sizes.astype(float)).sum() > 62:
        raise ValueError("too many rules")
    radix = np.concatenate([[1], np.cumprod(sizes[:-1])])
    numbers = {0: 0}
    rows, at = [], 0
    while at < len(states):
        fresh = states[at:]
        after = np.stack([table[fresh[:, k]] for k, (table, _) in enumerate(parts)], axis=2)
        codes = after @ radix
        for code in np.unique(codes).tolist():
            numbers.setdefault(code, len(numbers))
        rows.append(np.vectorize(numbers.__getitem__, otypes=[np.int64])(codes))
        at = len(states)
        new = np.array(list(numbers)[at:], np.int64)
        states = np.concatenate([states, (new[:, None] // radix) % sizes])
    told = sum(np.asarray(ended)[states[:, k]].astype(np.int64) << k for k, (_, ended) in enumerate(parts))
    return np.concatenate(rows), told


class Automaton(NamedTuple):
    classes: bytes  # the class of each byte
    width: int  # number of classes
    table: list[int]  # at state + class: the next state; states are multiples of ``width``
    start: int
    limit: int  # states below it tell that matches have ended
    ended: list[list[int]]  # by state / width, for those: the families
    backward: list[tuple[bytes, int, list[int], list[tuple[bool, bool]]]]  # by family: classes, width, table (-1: none), whether a state is a whole match, and a bounded one

    @property
    def states(self) -> int:
        return len(self.table) // self.width

    def matches(self, data: bytes) -> Iterator[tuple[int, int, int]]:
        """Leftmost longest matches of every family that do not overlap others of the family: (family, start, end), by end."""
        table, limit, state = self.table, self.limit, self.start
        reach: dict[int, int] = {}
        for i, c in enumerate((data + END).translate(self.classes)):
            state = table[state + c]
            if state < limit:
                for family in self.ended[state // self.width]:
                    yield family, self.begin(family, data, reach.get(family, 0), i), i
                    reach[family] = i

    def begin(self, family: int, data: bytes, first: int, end: int) -> int:
        """The earliest start, not before ``first``, of a match that ends at ``end``."""
        classes, width, table, whole = self.backward[family]
        state, found = 0, end
        for at in range(end - 1, first - 1, -1):
            state = table[state * width + classes[data[at]]]
            if state < 0:
                break
            free, bounded = whole[state]
            if free or (bounded and (at == 0 or data[at - 1] not in WORD)):
                found = at
        return found


def _backward(family: Family) -> tuple[bytes, int, list[int], list[tuple[bool, bool]]]:
    nfa = Nfa([reversed_tree(parsed(pattern)) for pattern, _ in family])
    classes, first = byte_classes([nfa])
    numbers = {nfa.closure(frozenset(nfa.starts)): 0}
    table = []
    for states in (queue := list(numbers)):
        for byte in first:
            after = nfa.step(states, byte)
            if after and after not in numbers:
                numbers[after] = len(numbers)
                queue.append(after)
            table.append(numbers[after] if after else -1)
    ends = [(end, bounded) for end, (_, bounded) in zip(nfa.finals, family, strict=True)]
    return classes, len(first), table, [tuple(any(end in s and bounded == kind for end, bounded in ends) for kind in (False, True)) for s in queue]


def compiled(families: list[Family]) -> Automaton:
    """One automaton for all ``families``."""
    nfas = [Nfa([parsed(pattern) for pattern, _ in family]) for family in families]
    classes, first = byte_classes(nfas)
    table, told = minimised(*product([_forward(family, nfa, first) for family, nfa in zip(families, nfas, strict=True)]))
    order = np.argsort(told == 0, kind="stable")  # those that tell something first
    place, width = np.argsort(order), len(first)
    telling = told[order][: int((told != 0).sum())]
    return Automaton(
        classes, width, (place[table[order]] * width).ravel().tolist(), int(place[0]) * width, len(telling) * width,
        [[k for k in range(len(families)) if t >> k & 1] for t in telling.tolist()], list(map(_backward, families)),
    )
