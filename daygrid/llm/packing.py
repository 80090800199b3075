"""Best-fit packing: tokenize, cut what is longer than a sequence, and pack the pieces by bin completion.

Pieces are dealt at random into groups of a few thousand, and every group is packed
in one task from the lengths alone; the number of groups grows with the data. Each
group wastes less than a sequence or two, so the whole is within a small
fraction of a percent of the least possible number. Inside a group, best-fit decreasing gives the
incumbent; where that is above the lower bound, branch and bound packs the sequences that waste
most anew, first a few, at last the whole group, with more nodes than sequences: it takes the
largest piece left, enumerates the undominated ways to fill the rest of
its sequence, and gives up a branch as soon as its waste rules out a better solution.

Defined cases: NULL text is empty; an empty text still has its end mark, so it is one piece of
one token; rows that repeat are packed as often as they occur; an empty table gives no rows;
columns other than the id and the text are ignored.
"""

from __future__ import annotations

import array
import json
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.batches import in_small_batches
from daygrid.llm.shingles import text_blocks
from daygrid.sizing import stored

CAPACITY = 4096
END_ID = 1
# Pieces per group on average.
GROUP_SIZE = 4000
# Words and chunks of them, together, whose ids a Python worker remembers.
CACHE_WORDS = 300_000
# Bytes of text that are looked up together (a longer text alone).
BLOCK_BYTES = 1 << 20
# Sequences that the first search of a group packs anew.
FIRST_PART = 16
# Branches that a search may try, beside two for each of its sequences, before it settles for the incumbent.
MAX_NODES = 500
# Fillings that are kept, and choices that are looked at, for one sequence of the search; best-fit, the incumbent, has no such bounds.
MAX_FILLINGS = 20
MAX_TRIES = 200

# The steps of a tokenizer whose words may be looked up one by one; any other is given whole texts.
_STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
# The same words, over the letters, numbers and spaces of Latin-1 in lower case.
_LETTERS, _NUMBERS, _SPACES = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"


# What a byte-level model writes for each byte: itself where it is printable, else a letter from 256 on.
_PRINTABLE = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
_BYTES = {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}


class _Ids(dict):
    """Ids, as bytes, by word and by what stands between two spaces; what it lacks is computed and, while there is room, kept."""

    def __init__(self, tokenize: Callable[[str], list]):
        super().__init__()
        self.tokenize = tokenize

    def __missing__(self, chunk: str) -> bytes:
        words = [chunk] if chunk.isalpha() else _WORDS.findall(chunk)
        if words == [chunk]:
            # A word alone needs the model only, without the steps around it.
            letters = chunk if chunk.isascii() and chunk.isprintable() else chunk.encode().decode("latin-1").translate(_BYTES)
            ids = array.array("I", [t.id for t in self.tokenize(letters)]).tobytes()
        else:
            ids = b"".join(map(self.__getitem__, words))
        if len(self) < CACHE_WORDS and len(chunk) <= 64:
            self[chunk] = ids
        return ids


class _Words:
    """The ids of texts, with a memory for words and for what stands between two spaces."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            own = json.load(file)
        self.by_word = all(own.get(step) == known for step, known in _STEPS.items())
        self.memory = _Ids(self.tokenizer.model.tokenize)

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        return self.of([text])[0]

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as the tokenizer gives them for the whole of it.

        Latin-1 texts are split at spaces and then into the tokenizer's own words, and what repeats
        comes from memory. Such a text has no combining marks, so lowering it
        first changes nothing; one that may hold a special token is left whole.
        """
        split = [self.by_word and "<|" not in text and _latin(text) for text in texts]
        found = iter(self._by_word([text for text, own in zip(texts, split, strict=True) if own]))
        return [next(found) if own else self.whole(text) for text, own in zip(texts, split, strict=True)]

    def _by_word(self, texts: list[str]) -> Iterator[bytes]:
        """Each distinct chunk is looked up once for all texts."""
        if not texts:
            return
        chunks = pc.split_pattern(pa.array([text.lower().replace("\n", " ") for text in texts], pa.large_string()), " ")
        coded = chunks.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(map(self.memory.__getitem__, distinct), pa.large_binary()).take(coded.indices)
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets, "i8")[chunks.offsets.to_numpy()]
        whole = memoryview(data or b"")
        for start, end in pairwise(ends.tolist()):
            yield bytes(whole[start:end])

    def forget(self) -> None:
        """Empties the memory; a worker lives longer than its task."""
        self.memory.clear()


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@cache
def words_of(path: str) -> _Words:
    return _Words(path)


def tokenize(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, on request, ``ids`` (little-endian, 32 bits each)."""
    end = array.array("I", [end_id]).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(tokenizer_path)
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            doc_ids = iter(batch.column(0).to_pylist())
            for _, texts in text_blocks(batch.column(1), BLOCK_BYTES):
                for own in words.of(texts):
                    doc_id, ids = next(doc_ids), memoryview(own + end)
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        out["doc_id"].append(doc_id)
                        out["piece"].append(k)
                        out["start"].append(at // 4)
                        out["length"].append(len(part) // 4)
                        out["ids_crc32"].append(zlib.crc32(part))
                        out["ids"].append(bytes(part) if keep_ids else None)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))
        words.forget()

    pieces = in_small_batches(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))).mapInArrow(cut, PIECES)
    return pieces if keep_ids else pieces.drop("ids")


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing; ``lengths`` descend. Bins hold positions in ``lengths``."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (room left, bin), ascending
    for i, length in enumerate(lengths):
        at = bisect_left(room, (length, -1))
        if at < len(room):
            left, b = room.pop(at)
            bins[b].append(i)
        else:
            left, b = capacity, len(bins)
            bins.append([i])
        if left > length:
            insort(room, (left - length, b))
    return bins


def lower_bound(lengths: list[int], capacity: int) -> int:
    """No packing needs fewer: by volume, and by pieces above half a sequence with what no longer fits beside them."""
    best = -(-sum(lengths) // capacity)
    small = sorted({x for x in lengths if 2 * x <= capacity})[:64]
    for k in [0, *small]:
        big = sum(x > capacity - k for x in lengths)
        middle = [x for x in lengths if capacity - k >= x and 2 * x > capacity]
        rest = sum(x for x in lengths if k <= x and 2 * x <= capacity)
        free = len(middle) * capacity - sum(middle)
        best = max(best, big + len(middle) + max(0, -(-(rest - free) // capacity)))
    return best


def _fillings(lengths: list[int], left: list[int], room: int, most: int) -> list[tuple[int, list[int]]]:
    """Undominated ways to fill ``room`` from the positions ``left`` (longest first), as (waste, positions), least waste first.

    Fillings that waste more than ``most`` are left out; the search would give them up.

    A filling is dominated if a piece left out could take the place of some of its pieces and fit: whatever
    is then possible with the smaller ones was possible before.
    """
    found: list[tuple[int, list[int]]] = []
    seen: set[tuple[int, ...]] = set()
    tried = 0

    places: dict[int, list[int]] = {}
    for i in left:
        places.setdefault(lengths[i], []).append(i)
    kinds = sorted(places, reverse=True)
    descending = [-x for x in kinds]

    open_kinds = int.from_bytes(np.packbits(np.bincount(kinds, minlength=room + 1) > 0, bitorder="little").tobytes(), "little") if kinds else 0  # bit x: a piece of length x is left

    def dominated(chosen: list[int], free: int) -> bool:
        if not free:
            return False
        sums, used = 1, Counter(lengths[i] for i in chosen)  # bit s: some of the chosen pieces add up to s
        others = open_kinds
        for x, n in used.items():
            if n == len(places[x]):
                others ^= 1 << x
            for _ in range(n):
                sums |= sums << x
        # All lengths above a sum by 1 to ``free``, in steps that double.
        reach, width = sums << 1, 1
        while width < free:
            step = min(width, free - width)
            reach |= reach << step
            width += step
        return bool(reach & others)

    def go(at: int, free: int, chosen: list[int]) -> None:
        nonlocal tried
        tried += 1
        last = True
        # Lengths descend: skip to the first that fits, and take as many of it as fit, then fewer.
        for k in range(max(at, bisect_left(descending, -free)), len(kinds)):
            last = False
            for n in range(min(len(places[kinds[k]]), free // kinds[k]), 0, -1):
                if len(found) >= MAX_FILLINGS or tried >= MAX_TRIES:
                    return
                go(k + 1, free - n * kinds[k], chosen + places[kinds[k]][:n])
        key = tuple(lengths[i] for i in chosen)
        if last and free <= most and key not in seen and not dominated(chosen, free):
            seen.add(key)
            found.append((free, chosen))

    go(0, room, [])
    if not found:
        found = [(room, [])]
    return sorted(found, key=lambda x: x[0])


def complete(lengths: list[int], capacity: int, max_nodes: int = MAX_NODES) -> list[list[int]]:
    """Pack descending ``lengths`` into as few bins as the search finds; positions by bin.

    The bins that waste most are packed anew, more of them each time that this saves none, up to all.
    """
    best = best_fit(lengths, capacity)
    least = lower_bound(lengths, capacity)
    size = FIRST_PART
    while len(best) > least:
        best.sort(key=lambda own: sum(lengths[i] for i in own))
        places = sorted(i for own in best[:size] for i in own)
        rank = {i: k for k, i in enumerate(places)}
        part = [[rank[i] for i in own] for own in best[:size]]
        found = _searched([lengths[i] for i in places], capacity, part, max_nodes + 2 * len(part))
        if len(found) < len(part):
            best[:size] = [[places[k] for k in own] for own in found]
        elif size >= len(best):
            break
        else:
            size *= 2
    return best


def _searched(lengths: list[int], capacity: int, best: list[list[int]], max_nodes: int) -> list[list[int]]:
    """Branch and bound from the incumbent ``best``; a descent takes one node a bin, so ``max_nodes`` should be above their number."""
    least = lower_bound(lengths, capacity)
    spare, nodes = len(best) * capacity - sum(lengths), 0  # waste of the incumbent
    # Depth first with an own stack; only the branch that is being followed is held.
    bins: list[list[int]] = []
    stack = [(0, _branches(lengths, list(range(len(lengths))), capacity, spare - capacity))]
    while stack and nodes < max_nodes and len(best) > least:
        waste, branches = stack[-1]
        free, filled, rest = next(branches, (0, [], None))
        if rest is None or waste + free > spare - capacity:  # the fillings to come waste no less
            stack.pop()
            if bins:
                bins.pop()
        elif not rest:
            best = [*bins, filled]
            spare -= capacity
        else:
            nodes += 1
            bins.append(filled)
            stack.append((waste + free, _branches(lengths, rest, capacity, spare - capacity - waste - free)))
    return best


def _branches(lengths: list[int], left: list[int], capacity: int, most: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """For each filling around the largest piece left: its waste, its positions, the positions that remain."""
    for free, chosen in _fillings(lengths, left[1:], capacity - lengths[left[0]], most):
        inside = {left[0], *chosen}
        yield free, [left[0], *chosen], [i for i in left if i not in inside]


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP_SIZE) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; no sequence is longer than ``capacity``, and none has gaps."""
    if "ids" in pieces.columns:
        raise ValueError("pack lengths alone, and join the ids afterwards")
    pieces = stored(pieces)
    groups = max(1, -(-pieces.count() // group_size))

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        sequence, offset = np.zeros(len(group), "int64"), np.zeros(len(group), "int64")
        lengths = group["length"].tolist()
        first = int(group["group"].iloc[0]) << 32
        for b, positions in enumerate(complete(lengths, capacity)):
            at = 0
            for i in positions:
                sequence[i], offset[i] = first + b, at
                at += lengths[i]
        return group.drop(columns="group").assign(sequence_id=sequence, offset=offset)

    kinds = ", ".join(f"{name} {kind}" for name, kind in pieces.dtypes)
    # By their place in the stored table, so that equal rows are spread too.
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(one, f"{kinds}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The place of every piece of every document."""
    return pack(tokenize(docs, tokenizer_path, capacity, end_id, keep_ids=False), capacity)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, length, ids``, from pieces with their ids and their places."""
    key = ["doc_id", "piece", "ids_crc32"]
    # Equal rows are interchangeable; numbering them keeps the join one to one.
    both = [F.row_number().over(_window(key)).alias("copy")]
    joined = pieces.select("*", *both).join(placed.select(*key, "sequence_id", "offset", *both), [*key, "copy"])
    rows = joined.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return rows.select("sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda whole, part: F.concat(whole, part["ids"])).alias("ids"))


def _window(key: list[str]):
    from pyspark.sql import Window

    return Window.partitionBy(*key).orderBy(*key)
