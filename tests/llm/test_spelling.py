import random
import zlib
from collections import Counter

import pytest

from daygrid.llm import spelling
from daygrid.llm.spelling import keyed, near_in_group, nearest, roots, variants, words
from tests.conftest import rows


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(docs):
    """Character by character, as the contract says it."""
    found = Counter()
    for doc_id, text in docs:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c < "a" else c
                continue
            if run:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                found[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
            run = ""
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def plain_variants(vocabulary):
    near = {w: [v for v in vocabulary if is_near(w, v)] for w in vocabulary}
    best = {w: min(found, key=lambda v: (-vocabulary[v], v)) for w, found in near.items() if found}
    form = {w: v for w, v in best.items() if vocabulary[v] >= 2 * vocabulary[w]}
    out = []
    for w, n in vocabulary.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), vocabulary[form[w]] if w in form else None))
    return sorted(out, key=lambda r: r[0])


def corpus(seed, letters, size):
    draw = random.Random(seed)
    base = ["".join(draw.choices(letters, k=draw.randint(5, 8))) for _ in range(size)]
    spoilt = []
    for w in base:
        for _ in range(draw.randint(0, 3)):
            i = draw.randrange(len(w))
            spoilt.append(draw.choice([w[:i] + w[i + 1 :], w[:i] + draw.choice(letters) + w[i:], w[:i] + draw.choice(letters) + w[i + 1 :], w + draw.choice(letters)]))
    pool = [*base * 3, *spoilt]
    return [(i, " ".join(w.title() if draw.random() < 0.2 else w for w in draw.choices(pool, k=60))) for i in range(len(pool) // 6)]


@pytest.mark.parametrize("group", [2, 5, 4096])
@pytest.mark.parametrize("letters", ["ab", "abcdeéÿÀ×"])
def test_against_brute_force(spark, letters, group):
    docs = corpus(4, letters, 120)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    vocabulary = plain_words(docs)
    assert len(vocabulary) > 50 and dict(rows(words(frame))) == vocabulary
    assert [tuple(r) for r in variants(frame, group=group).orderBy("word").collect()] == plain_variants(vocabulary)


def test_each_pair_comes_together_once(spark):
    """With keys divided as far as they go, every near pair is found once, and no key keeps many words."""
    draw = random.Random(9)
    vocabulary = {"".join(draw.choices("ab", k=draw.randint(5, 11))): 3 for _ in range(1500)}
    frame = spark.createDataFrame(list(vocabulary.items()), "word string, n bigint")
    want = {(w, sum(is_near(w, v) for v in vocabulary)) for w in vocabulary}
    assert {(r.word, r.n_near) for r in nearest(frame, 3).collect()} == {x for x in want if x[1]}
    for table in keyed(frame, 3):
        sizes = [(r.open, r["count"]) for r in table.selectExpr("key", "m - head - tail AS open").groupBy("key", "open").count().collect()]
        assert all(n <= 3 or left <= 1 for left, n in sizes)


def test_hot_key(spark):
    """Words that nearly all share beginning and end: the key is divided, and nothing is lost."""
    vocabulary = {f"internal{a}{b}{c}isation": 3 + len(a + b + c) for a in "abcdefgh" for b in ("", *"abcdefgh") for c in "abcdefgh"}
    frame = spark.createDataFrame(list(vocabulary.items()), "word string, n bigint")
    assert len(keyed(frame, 50)) > 1
    assert {(r.word, r.n_near) for r in nearest(frame, 50).collect()} == {(w, sum(is_near(w, v) for v in vocabulary)) for w in vocabulary}


def test_index_of_one_group():
    assert near_in_group(5, 0, 0, [("aabbb", 3), ("ababb", 5), ("aabb", 9)]) == {}
    assert near_in_group(5, 2, 0, [("aabbb", 3), ("aabab", 5), ("aabbbb", 9), ("aabbab", 4)]) == {
        "aabbb": (3, 9, "aabbbb"), "aabab": (2, 4, "aabbab"), "aabbbb": (1, 3, "aabbb"), "aabbab": (2, 5, "aabab"),
    }
    # The same insertion seen from the end is left to the beginning's key.
    assert near_in_group(5, 0, 3, [("aabbb", 3), ("aaabbb", 5), ("xabbb", 7)]) == {"aabbb": (1, 7, "xabbb"), "xabbb": (1, 3, "aabbb")}


def test_long_chains(spark):
    links = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(40)] + [("x", "w05")]
    found = dict(rows(roots(spark.createDataFrame(links, "word string, form string"))))
    assert set(found.values()) == {"w40"} and len(found) == 41


def test_nulls_repeats_long_texts_and_other_columns(spark):
    text = "Straße " * 3 + "strase " + "Été " * 9
    docs = [(1, None, 0), (2, "", 0), (None, text, 1), (3, text, 2), (3, text, 2), (4, "strase strase strase " + "x" * 100_000, 3)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, n int")
    want = plain_words([("" if i is None else i, t) for i, t, _ in docs])
    assert "straße" in want and dict(rows(words(frame))) == want
    assert [tuple(r) for r in variants(frame).orderBy("word").collect()] == plain_variants(want)
    assert variants(frame.limit(0)).count() == 0


def test_ties_take_the_smallest(spark):
    frame = spark.createDataFrame([("aaaaa", 3), ("aaaac", 6), ("aaaab", 6), ("caaaa", 6)], "word string, n bigint")
    assert {(r.word, r.n_near, r.near_n, r.near) for r in nearest(frame).collect()} == {
        ("aaaaa", 3, 6, "aaaab"), ("aaaab", 2, 6, "aaaac"), ("aaaac", 2, 6, "aaaab"), ("caaaa", 1, 3, "aaaaa"),
    }
    assert spelling.RATIO == 2
