import hashlib
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daygrid.llm import packing
from daygrid.llm.packing import CAPACITY, GROUP_SIZE, _Words, best_fit, complete, lower_bound, pack, pack_documents, sequences, tokenize
from daygrid.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def fewest(lengths, capacity):
    """Least number of bins, by trying every assignment."""
    best = len(lengths)
    for choice in product(range(len(lengths)), repeat=len(lengths)):
        loads = [sum(x for x, c in zip(lengths, choice, strict=True) if c == b) for b in set(choice)]
        if max(loads) <= capacity:
            best = min(best, len(loads))
    return best


def test_ids_equal_those_of_the_whole_text(plain):
    words = _Words(PATH)
    draw = random.Random(5)
    alphabet = list("aAbBéÉß 0179.,'!-\n\t ²½µÿ\x1c\x85\xa0") + ["'s", "'LL", "Σ", "ﬁ", "İ", "é", "漢", "🙂", "<|endoftext|>", "<|ENDOFTEXT|>", " "]
    texts = ["", " ", "don't", "<|endoftext|>", "<|StartOfText|> x", *("".join(draw.choices(alphabet, k=draw.randint(1, 40))) for _ in range(3000))]
    for text in texts:
        assert np.frombuffer(words.ids(text), "<u4").tolist() == plain(text), repr(text)


def test_what_repeats_is_looked_up_once_for_all_texts(monkeypatch, plain):
    """A batch costs its distinct chunks, and a chunk that is one word is neither split nor kept twice."""
    words, asked = _Words(PATH), Counter()
    letters = "abcdefghijklmnopqrstuvwxyzàéÿß"
    distinct = ["".join(c) for c in product(letters, repeat=2)]

    class Counted(type(words.memory)):
        def __getitem__(self, chunk):
            asked["looked up"] += 1
            return super().__getitem__(chunk)

    words.memory = Counted(lambda word: asked.update(["model"]) or words.tokenizer.model.tokenize(word))
    texts = [" ".join(distinct), " ".join(distinct[::-1]).upper().replace("SS", "ß"), "", "\n".join(distinct * 3), "漢 ab", "é ab. ab."]
    assert [np.frombuffer(own, "<u4").tolist() for own in words.of(texts)] == [plain(text) for text in texts]
    # Beside the words: what stands between spaces and is none, "ab." and "", with its parts.
    assert asked["model"] <= len(distinct) + 2 and asked["looked up"] <= len(distinct) + 8
    assert len(words.memory) <= len(distinct) + 8
    monkeypatch.setattr(packing, "CACHE_WORDS", 10)
    full = _Words(PATH)
    assert full.of(texts) == words.of(texts) and len(full.memory) == 10
    full.forget()
    assert not full.memory and full.of([]) == []


def test_search_reaches_the_least_number():
    draw = random.Random(1)
    for _ in range(60):
        lengths = sorted((draw.randint(1, 10) for _ in range(draw.randint(1, 6))), reverse=True)
        bins = complete(lengths, 10)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert max(sum(lengths[i] for i in b) for b in bins) <= 10
        assert lower_bound(lengths, 10) <= fewest(lengths, 10) == len(bins)


def test_search_beats_best_fit():
    lengths = sorted([6, 5, 5, 4, 3, 3, 2, 2] * 3 + [7, 7, 3, 3], reverse=True)
    better = 0
    draw = random.Random(3)
    for _ in range(200):
        lengths = sorted((draw.randint(8, 45) for _ in range(24)), reverse=True)
        found, incumbent = complete(lengths, 100), best_fit(lengths, 100)
        assert sorted(i for b in found for i in b) == list(range(24))
        assert all(sum(lengths[i] for i in b) <= 100 for b in found)
        assert len(found) <= len(incumbent)
        better += len(found) < len(incumbent)
    assert better


@pytest.mark.parametrize("shortest, longest, seed", [(300, 1800, 1), (400, 1400, 7)])
def test_search_finishes_on_a_production_group(shortest, longest, seed):
    draw = random.Random(seed)
    lengths = sorted((draw.randrange(shortest, longest) for _ in range(GROUP_SIZE)), reverse=True)
    found = complete(lengths, CAPACITY)
    assert sorted(i for b in found for i in b) == list(range(GROUP_SIZE))
    assert max(sum(lengths[i] for i in b) for b in found) <= CAPACITY
    assert len(best_fit(lengths, CAPACITY)) > lower_bound(lengths, CAPACITY) + 4 and len(found) <= lower_bound(lengths, CAPACITY) + 1


def check_places(found, docs, plain, capacity):
    expected = {}
    for doc_id, text in docs:
        ids = np.array([*plain(text or ""), 1], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected.setdefault((doc_id, k, at, len(part), zlib.crc32(part.tobytes())), []).append(1)
    seen, loads = {}, {}
    for r in found:
        seen.setdefault((r.doc_id, r.piece, r.start, r.length, r.ids_crc32), []).append(1)
        loads.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert seen == expected
    for places in loads.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return loads


def test_query_over_whole_table(spark, sf_dir, plain):
    found = QUERIES["op10_best_fit_packing"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    loads = check_places(found, docs, plain, 4096)
    least = -(-sum(r.length for r in found) // 4096)
    assert len(loads) <= least + 1


def test_edges(spark, plain):
    docs = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (4, "word " * 30), (None, "x")]
    frame = spark.createDataFrame([(a, b, "x", 1) for a, b in docs], "doc_id bigint, text string, length string, group int")
    check_places(pack_documents(frame, PATH, 8).collect(), docs, plain, 8)
    assert pack_documents(frame.limit(0), PATH, 8).count() == 0


def test_many_groups_and_sequences(spark, plain):
    docs = [(i, hashlib.md5(str(i).encode()).hexdigest() * (i % 4)) for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    pieces = tokenize(frame, PATH, 64)
    placed = pack(pieces.drop("ids"), 64, group_size=50)
    check_places(placed.collect(), docs, plain, 64)
    whole = sequences(pieces, placed).collect()
    assert len(whole) == placed.select("sequence_id").distinct().count()
    assert all(len(r.ids) == 4 * r.length <= 256 for r in whole)
    by_id = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in whole}
    for r in placed.collect():
        assert zlib.crc32(by_id[r.sequence_id][r.offset : r.offset + r.length].tobytes()) == r.ids_crc32


def test_equal_rows_are_spread_over_groups(spark):
    rows = spark.range(100_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("start"), F.lit(900).cast("bigint").alias("length"), F.lit(5).cast("bigint").alias("ids_crc32"))
    placed = pack(rows)
    groups = placed.groupBy(F.shiftright("sequence_id", 32).alias("group")).count().collect()
    assert len(groups) == 25 and max(g["count"] for g in groups) < 3 * 4000
    assert placed.select("sequence_id").distinct().count() <= 25_000 + 25


def test_fillings_of_many_small_pieces():
    """Runs of equal pieces are taken at once, so hundreds of pieces make one filling."""
    draw = random.Random(1)
    lengths = sorted((draw.randint(1, 15) for _ in range(4000)), reverse=True)
    found = packing._fillings(lengths, list(range(4000)), 4096, 4096)
    assert found[0][0] == 0 and sum(lengths[i] for i in found[0][1]) == 4096 and len(set(found[0][1])) == len(found[0][1])
    # Every undominated filling of a small case.
    few = [7, 5, 5, 3, 2]
    ways = {tuple(few[i] for i in chosen) for _, chosen in packing._fillings(few, list(range(5)), 10, 10)}
    assert ways == {(7, 3), (5, 5), (5, 3, 2)}


def test_other_tokenizers_get_whole_texts():
    words = _Words(public_tokenizers.path("byte_bpe_50k.json"))
    assert not words.by_word and _Words(PATH).by_word
    text = "It's  a Test, naïve 12"
    assert np.frombuffer(words.ids(text), "<u4").tolist() == Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids


def test_a_group_whose_bound_is_out_of_reach_is_searched_without_a_walk_over_all_lengths(monkeypatch):
    """Domination is one test of bits, with the same fillings as a loop over every length left."""
    draw = random.Random(8)
    for _ in range(60):
        lengths = sorted((draw.randint(1, 60) for _ in range(draw.randint(1, 14))), reverse=True)
        room = draw.randint(1, 100)
        for free, chosen in packing._fillings(lengths, list(range(len(lengths))), room, room):
            others = list(lengths)
            for i in chosen:
                others.remove(lengths[i])
            sums = {0}
            for i in chosen:
                sums |= {s + lengths[i] for s in sums}
            assert not chosen or not any(0 < x - s <= free for x in others for s in sums)
    looked = Counter()

    class Looked(Counter):
        def __getitem__(self, key):
            looked["up"] += 1
            return super().__getitem__(key)

    monkeypatch.setattr(packing, "Counter", Looked)
    many = list(range(20_000, 16_000, -2))
    assert packing._fillings(many, list(range(len(many))), 100_001, 100_001)
    assert looked["up"] < len(many)
