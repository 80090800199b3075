import random
import re

import numpy as np

from daygrid.llm.queries import QUERIES
from daygrid.llm.repetition import COUNTS, judged, measured, repeat_lengths


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def covered(own, n):
    places = {}
    for i in range(len(own) - n + 1):
        places.setdefault(tuple(own[i : i + n]), []).append(i)
    return {q for found in places.values() if len(found) > 1 for p in found for q in range(p, p + n)}


def longest(own):
    n = 0
    while covered(own, n + 1):
        n += 1
    return n


def plain(text):
    text, own = text or "", words(text)
    lines = [line for line in text.split("\n") if words(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(covered(own, 3)), len(covered(own, 10)), longest(own))


def verdict(numbers):
    n, _, _, _, repeat, cover, most = numbers
    failed = n < 50 or 100 * repeat > 50 * n
    return failed, not failed and cover <= 0.3 * n and most <= 100


def test_lengths_equal_brute_force():
    draw = random.Random(1)
    for _ in range(200):
        texts = [draw.choices("abcd"[: draw.randint(1, 4)], k=draw.randint(0, 30)) for _ in range(4)]
        code = np.array([1000 * d + ord(w) for d, own in enumerate(texts) for w in own], np.uint64)
        doc = np.repeat(np.arange(4), [len(t) for t in texts])
        found = repeat_lengths(code, np.cumsum([len(t) for t in texts])[doc]).tolist()
        common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert found == [max((common(own[i:], own[j:]) for j in range(len(own)) if j != i), default=0) for own in texts for i in range(len(own))]


def cases():
    draw = random.Random(2)
    vocabulary = [f"w{i}" for i in range(3000)]
    fresh = lambda n: draw.choices(vocabulary, k=n)
    passage = fresh(101)
    yield from ["", None, "   \n\t", "a", "a b\xa0c\x1cd é", "### *** $%&|<>", "x y\nx y\n\n\nx y \n", "one two\r\none two\r\n", " ".join(fresh(49)), " ".join(fresh(50))]
    yield from (" ".join(fresh(400) + passage[:k] + fresh(300) + passage[:k] + fresh(300)) for k in (9, 10, 50, 100, 101))
    yield from (" ".join((fresh(k) + passage[:20]) * 3) for k in (20, 100, 200))
    yield from (" ".join(draw.choices("abc", k=k)) for k in (60, 300))
    yield "spam " * 3000


def test_measures_equal_brute_force():
    texts = [t or "" for t in cases()]
    found = measured(texts)
    for i, text in enumerate(texts[:-1]):
        assert tuple(int(found[c][i]) for c in COUNTS) == plain(text), text[:60]
    assert [int(found[c][len(texts) - 1]) for c in ("n_words", "n_repeat_words", "covered_words", "longest_repeat")] == [3000, 3000, 3000, 2999]


def test_judged(spark):
    texts = list(cases())[:-1]
    rows = [(i, t, "x", True) for i, t in enumerate(texts)] + [(0, "again", "y", False), (None, "no id", "z", None)] * 2
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string, kept boolean")
    out = sorted((tuple(r) for r in judged(frame).collect()), key=str)
    assert out == sorted(((i, *plain(t), *verdict(plain(t))) for i, t, _, _ in rows), key=str)
    assert {r[-1] for r in out} == {True, False}
    assert judged(frame.limit(0)).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op6_quality_rules"](spark, sf_dir).collect():
        own = words(texts[r.doc_id])
        assert (r.n_words, r.n_repeat_words) == (len(own), len(covered(own, 3)))
        assert r.base_failed == (len(own) < 50 or 100 * r.n_repeat_words > 50 * len(own))
        assert r.kept == (not r.base_failed and len(covered(own, 10)) <= 0.3 * len(own) and not covered(own, 101))
