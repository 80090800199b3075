"""Alignment of two tokenizers by interval coalescing, and how often the ids of one meet those of the other.

Tokens are intervals of bytes of a space and the text. The tokens of both sorts are sorted by start (``lexsort``); where a start
reaches the running maximum of the ends (``maximum.accumulate``) a group ends, that is where tokens of both end. Inside a group every token is
expanded to the tokens of the other sort that it overlaps; these are the links.

A pair's count, over the whole corpus, is needed for every document again. Documents are worked on in blocks of about ``BLOCK``
characters. A block has a dictionary of its different pairs, and its documents keep the pairs' numbers in it as differences in bytes, so what crosses
the network are the dictionaries: one row per pair and block, however often the pair occurs. They are summed by pair and go back to their blocks, and
each block's documents are read against its dictionary. No task holds more than a block and the rows of a batch, and nothing is broadcast but one
number per id of the second tokenizer.

Token ids come from the vocabulary files. A byte-level file whose merges are in the order of its ids, and that has no steps of its own, is
run by ``tiktoken`` from the same entries, with equal results and faster; any other by ``tokenizers``.

Defined cases: NULL and empty texts, and those whose tokens do not spell a space and the text, have no tokens and zeros; rows that
repeat count as often as they occur; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.packing import _BYTES
from daygrid.sizing import stored

# Characters that share a dictionary of pairs, and those that are aligned at a time.
BLOCK = 8_000_000
PART = 400_000

# Fixed value: how byte-level vocabularies cut a text into words, without its look-ahead for spaces.
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
# A run of spaces longer than this is left to the vocabulary's own library.
_SPACES = re.compile(r"\s{2000}")

NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
ALIGNED = f"block bigint, doc_id bigint, {', '.join(f'{n} bigint' for n in NUMBERS)}, groups_sha256 string, groups string, links binary, pairs array<bigint>, totals array<bigint>"


class Encoder:
    """Ids of texts, and the bytes of each id."""

    def __init__(self, path: str):
        self.fast = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.lead = ""  # the model adds a space itself
            self.plain = lambda texts: model.encode(texts, num_threads=1)
            self.bytes = [_piece_bytes(model.id_to_piece(i)) for i in range(model.vocab_size())]
            return
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        own.encode_special_tokens = True
        self.lead = " "
        self.plain = lambda texts: [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]
        back = {c: b for b, c in _BYTES.items()}
        vocabulary = own.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(back[c] if c in back else ord(c) for c in token) if all(c in back or ord(c) < 256 for c in token) else token.encode()
        self.fast = _ranked(path, self.bytes, set(own.get_added_tokens_decoder()))

    def ids(self, texts: list[str]) -> list[list[int]]:
        texts = [self.lead + t for t in texts]
        if self.fast is None:
            return self.plain(texts)
        slow = [i for i, t in enumerate(texts) if _SPACES.search(t)]
        found = [None if i in slow else self.fast(t) for i, t in enumerate(texts)] if slow else list(map(self.fast, texts))
        for i, ids in zip(slow, self.plain([texts[i] for i in slow]), strict=True):
            found[i] = ids
        return found


def _ranked(path: str, entries: list[bytes], added: set[int]):
    """The encoder of a plain byte-level file from its entries, or None if the file is something else."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as file:
        own = json.load(file)
    steps, model = own["pre_tokenizer"] or {}, own["model"]
    plain = own["normalizer"] is None and steps.get("type") == "ByteLevel" and not steps["add_prefix_space"] and steps.get("use_regex", True)
    if not plain or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        return None
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if [model["vocab"].get(m) for m in merges] != list(range(256, 256 + len(merges))):
        return None
    ranks = {token: i for i, token in enumerate(entries) if i not in added}
    return tiktoken.Encoding("entries", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _piece_bytes(piece: str) -> bytes:
    one = re.fullmatch("<0x([0-9A-F]{2})>", piece)
    return bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode()


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Aligned(NamedTuple):
    a: np.ndarray  # ids of the first tokens of all texts, one text after another
    b: np.ndarray
    group_a: np.ndarray  # the group of each token, ascending
    group_b: np.ndarray
    link_a: np.ndarray  # positions of linked tokens
    link_b: np.ndarray


def aligned(ends_a: np.ndarray, ends_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> Aligned:
    """Groups and links of tokens given by their ends; both sorts cover the same bytes from 0 without gaps."""
    start = np.concatenate([[0], ends_a[:-1], [0], ends_b[:-1]])[: len(a) + len(b)] if len(a) else np.zeros(0, np.int64)
    end = np.concatenate([ends_a, ends_b])
    kind = np.repeat([0, 1], [len(a), len(b)])
    order = np.lexsort((kind, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.concatenate([[False], start[order][1:] >= reach[:-1]]) if len(order) else np.zeros(0, bool)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    # The tokens of the other sort that end after a token starts and start before it ends.
    first = np.searchsorted(ends_b, start[: len(a)], "right")
    last = np.searchsorted(start[len(a) :], ends_a, "left")
    number = last - first
    link_a = np.repeat(np.arange(len(a)), number)
    link_b = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number) + np.repeat(first, number)
    return Aligned(a, b, group[: len(a)], group[len(a) :], link_a, link_b)


@cache
def _written(size: int) -> list[bytes]:
    """Ids followed by each of the marks that may come after them."""
    return [f"{i}{mark}".encode() for mark in ",|;" for i in range(size)]


def group_texts(found: Aligned, group_doc: np.ndarray, docs: int) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` for each document."""
    size = int(max(found.a.max(initial=0), found.b.max(initial=0))) + 1
    size = 1 << size.bit_length()
    group = np.concatenate([found.group_a, found.group_b])
    kind = np.repeat([0, 1], [len(found.a), len(found.b)])
    order = np.argsort(group * 2 + kind, kind="stable")
    ids, group, kind = np.concatenate([found.a, found.b])[order], group[order], kind[order]
    new_group = np.append(group[1:] != group[:-1], True)
    mark = np.where(new_group, 2, np.append(kind[1:] != kind[:-1], False))
    words = list(map(_written(size).__getitem__, (ids + mark * size).tolist()))
    ends = np.searchsorted(group_doc[group], np.arange(docs), "right").tolist()
    return [b"".join(words[s:e])[:-1] for s, e in zip([0, *ends[:-1]], ends, strict=True)]


def packed_numbers(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2**28 in groups of seven bits, the last group of each marked; and the bytes of each."""
    size = 1 + (numbers >= 1 << 7) + (numbers >= 1 << 14) + (numbers >= 1 << 21)
    which = np.repeat(np.arange(len(numbers)), size)
    place = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
    out = (numbers[which] >> (7 * place)) & 127
    return (out | np.where(place == size[which] - 1, 128, 0)).astype(np.uint8), size


def unpacked_numbers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers, and where in ``data`` each ends."""
    ends = np.flatnonzero(data & 128)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)
    if not len(ends):
        return np.zeros(0, np.int64), ends
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts), ends + 1


class _Block:
    """One block in the making: the numbers of its pairs, and their totals."""

    def __init__(self):
        self.numbers: dict[int, int] = {}
        self.totals: list[int] = []
        self.size = 0

    def number(self, pairs: np.ndarray) -> np.ndarray:
        different, place, n = np.unique(pairs, return_inverse=True, return_counts=True)
        own = np.fromiter((self.numbers.setdefault(p, len(self.numbers)) for p in different.tolist()), np.int64, len(different))
        self.totals += [0] * (len(self.numbers) - len(self.totals))
        for k, count in zip(own.tolist(), n.tolist(), strict=True):
            self.totals[k] += count
        return own[place]


def _part(doc_ids: list, texts: list[str], path_a: str, path_b: str, block: _Block, keep_groups: bool) -> dict[str, list]:
    """The rows of some documents."""
    coders = encoder(path_a), encoder(path_b)
    spelt = [(" " + t).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    used = [i for i, t in enumerate(texts) if t]
    ids = [dict(zip(used, coder.ids([texts[i] for i in used]), strict=True)) for coder in coders]
    used = [i for i in used if all(b"".join(map(coder.bytes.__getitem__, own[i])) == spelt[i] for coder, own in zip(coders, ids, strict=True))]
    sides = []
    for coder, own in zip(coders, ids, strict=True):
        counts = np.zeros(len(texts), np.int64)
        counts[used] = [len(own[i]) for i in used]
        flat = np.fromiter(chain.from_iterable(own[i] for i in used), np.int64, int(counts.sum()))
        sides.append((counts, flat, np.cumsum(_lengths(coder)[flat])))
    (n_a, a, ends_a), (n_b, b, ends_b) = sides
    found = aligned(ends_a, ends_b, a, b)
    doc_a = np.repeat(np.arange(len(texts)), n_a)
    group_doc = doc_a[np.searchsorted(found.group_a, np.arange(found.group_a[-1] + 1))] if len(a) else np.zeros(0, np.int64)
    written = group_texts(found, group_doc, len(texts))
    link_doc = doc_a[found.link_a]
    numbers = block.number(a[found.link_a] << 32 | b[found.link_b])
    key = np.sort(link_doc << 32 | numbers)
    link_doc, numbers = key >> 32, key & 0xFFFFFFFF
    before = np.concatenate([[0], numbers[:-1]])[: len(numbers)]
    first = np.concatenate([[True], link_doc[1:] != link_doc[:-1]])[: len(numbers)]
    data, size = packed_numbers(numbers - np.where(first, 0, before))
    n_links = np.bincount(link_doc, minlength=len(texts))
    cuts = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n_links)])].tolist()
    raw = data.tobytes()
    return {
        "doc_id": doc_ids, "n_a": n_a.tolist(), "n_b": n_b.tolist(), "n_groups": np.bincount(group_doc, minlength=len(texts)).tolist(), "n_links": n_links.tolist(),
        "groups_sha256": [hashlib.sha256(w).hexdigest() if w else "" for w in written], "groups": [w.decode() if keep_groups else None for w in written],
        "links": [raw[s:e] for s, e in zip(cuts[:-1], cuts[1:], strict=True)],
    }


_LENGTHS: dict[int, np.ndarray] = {}


def _lengths(coder: Encoder) -> np.ndarray:
    if id(coder) not in _LENGTHS:
        _LENGTHS[id(coder)] = np.array(list(map(len, coder.bytes)))
    return _LENGTHS[id(coder)]


_KINDS = {
    "block": pa.int64(), "doc_id": pa.int64(), **{n: pa.int64() for n in NUMBERS}, "groups_sha256": pa.string(), "groups": pa.string(), "links": pa.binary(),
    "pairs": pa.list_(pa.int64()), "totals": pa.list_(pa.int64()),
}


def _rows(block: int, columns: dict[str, list]) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    columns = {"block": [block] * size, **columns}
    return pa.RecordBatch.from_arrays([pa.array(columns[n], t) if n in columns else pa.nulls(size, t) for n, t in _KINDS.items()], names=list(_KINDS))


def blocks(docs: DataFrame, path_a: str, path_b: str, block_size: int = BLOCK, keep_groups: bool = False) -> DataFrame:
    """One row per document, with its links as numbers of its block's dictionary, and one row per block with the dictionary."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = _Block()
        for batch in batches:
            doc_ids, at = batch.column(0).to_pylist(), 0
            while at < len(doc_ids):
                texts, size = [], 0
                while at + len(texts) < len(doc_ids) and (not texts or size < PART):
                    texts.append(batch.column(1)[at + len(texts)].as_py() or "")
                    size += len(texts[-1])
                yield _rows(number, _part(doc_ids[at : at + len(texts)], texts, path_a, path_b, block, keep_groups))
                at += len(texts)
                block.size += size
                if block.size >= block_size:
                    yield _rows(number, {"pairs": [list(block.numbers)], "totals": [block.totals]})
                    number, block = number + 1, _Block()
        if block.numbers:
            yield _rows(number, {"pairs": [list(block.numbers)], "totals": [block.totals]})

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(work, ALIGNED)


def pair_counts(made: DataFrame) -> DataFrame:
    """``block, number, a, b, n``: every dictionary's pairs with their counts in the whole corpus."""
    from pyspark.sql import Window

    rows = made.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "totals")).alias("number", "own"))
    rows = rows.select("block", "number", F.col("own.pairs").alias("pair"), F.col("own.totals").alias("total"))
    # A pair has one row per block: map-side sums are already in it, and no pair has a large share.
    rows = rows.withColumn("n", F.sum("total").over(Window.partitionBy("pair")))
    return rows.select("block", "number", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "n")


def alignment(docs: DataFrame, path_a: str, path_b: str, block_size: int = BLOCK, keep_groups: bool = False) -> DataFrame:
    """``doc_id``, the numbers of tokens, groups and links, ``n_best, count_sum``, the digest of the groups and, on request, the groups."""
    made = stored(blocks(docs, path_a, path_b, block_size, keep_groups))
    counts = stored(pair_counts(made))
    # One row per id of the second vocabulary.
    best = counts.groupBy("b").agg(F.max("n").alias("most"))
    known = counts.join(F.broadcast(best), "b").select("block", "number", "n", (F.col("n") == F.col("most")).alias("best"))
    names = ["doc_id", *NUMBERS, "groups_sha256", *(["groups"] if keep_groups else [])]

    def one(own: pa.Table, dictionary: pa.Table) -> pa.Table:
        order = np.argsort(dictionary["number"].to_numpy())
        n, is_best = dictionary["n"].to_numpy()[order], dictionary["best"].to_numpy()[order].astype(np.int64)
        sums: dict[str, list] = {"n_best": [], "count_sum": []}
        for data in own["links"]:
            numbers = np.cumsum(unpacked_numbers(np.frombuffer(data.as_py(), np.uint8))[0])
            sums["n_best"].append(int(is_best[numbers].sum()))
            sums["count_sum"].append(int(n[numbers].sum()))
        return pa.table([*(own[c] for c in names), *(pa.array(v, pa.int64()) for v in sums.values())], names=[*names, *sums])

    kinds = dict(made.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in names), "n_best bigint", "count_sum bigint"])
    rows = made.where("links is not null").select("block", *names, "links")
    return rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(one, schema)
