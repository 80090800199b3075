import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from daygrid.llm.neardup import bag_minhash, components, deduplicated, groups, stays
from daygrid.llm.queries import QUERIES
from daygrid.llm.shingles import bags, shingles


def bag(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1 if words else 0)))


def overlap(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def classes(rows):
    """Frozen sets of row numbers: equal texts, and all pairs at 0.8 or more, transitively."""
    own = [bag(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    same, index = {}, defaultdict(list)
    for i, (_, text) in enumerate(rows):
        if text is not None:
            root[find(i)] = find(same.setdefault(text, i))
        if text is not None and same[text] == i:
            for shingle in own[i]:
                index[shingle].append(i)
    tried = set()
    for i in same.values():
        for j in {j for shingle in own[i] for j in index[shingle] if j < i}:
            if (i, j) not in tried and overlap(own[i], own[j]) >= 0.8:
                root[find(i)] = find(j)
    found = defaultdict(list)
    for i in range(len(rows)):
        found[find(i)].append(i)
    return list(found.values())


def expected(rows):
    out = []
    for group in classes(rows):
        ids = [rows[i][0] for i in group]
        least = min((i for i in ids if i is not None), default=None)
        out += [(i, least) for i in ids]
    return sorted(out, key=str)


def got(frame):
    return sorted(((r.doc_id, r.class_id) for r in frame.collect()), key=str)


def test_shingles_and_bags():
    texts = ["", "a", "a b", "a b c d e", "a b c d e f", "a a a a a a a a", " \t\na  b\x0bc\x0cd\re ", "x\x1cy\xa0z", "a b c d e"]
    code, n, doc = shingles(texts)
    counts = [sorted(n[doc == i].tolist()) for i in range(len(texts))]
    assert counts == [[], [1], [1], [1], [1, 1], [4], [1], [1], [1]]
    assert code[doc == 3] == code[doc == 6] == code[doc == 8] and code[doc == 3] in code[doc == 4]
    assert [len(b) for b in bags(texts)] == [0, 1, 1, 1, 2, 4, 1, 1, 1]
    assert len(np.unique(np.concatenate(bags(["a " * 3000])))) == 2996


def test_signatures_estimate_weighted_similarity():
    draw = np.random.default_rng(1)
    m, errors = 2000, []
    for _ in range(12):
        code = draw.integers(1, 2**63, 60).astype(np.uint64)
        a, b = (draw.integers(0, top, 60) for top in (3, 40))
        b = np.where(draw.random(60) < 0.5, a, b)
        weight, doc = np.concatenate([a[a > 0], b[b > 0]]), np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        signature = bag_minhash(np.concatenate([code[a > 0], code[b > 0]]), weight, doc, 3, m)
        truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        errors.append((signature[0] == signature[1]).mean() - truth)
        assert np.isfinite(signature[:2]).all() and np.isinf(signature[2]).all()
    assert max(map(abs, errors)) < 4 * 0.5 / m**0.5 and abs(np.mean(errors)) < 0.01


def test_components(spark):
    draw = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [tuple(sorted((200 + draw.randint(0, 80), 200 + draw.randint(0, 80)))) for _ in range(60)]
    pairs = [(a, b) for a, b in pairs if a != b]
    root = {}
    for x in {x for p in pairs for x in p}:
        root[x] = x
    for _ in pairs:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    found = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in found} == root


def changed(draw, words, share):
    return [w if draw.random() > share else f"n{draw.randint(0, 10**6)}" for w in words]


def test_groups_equal_brute_force(spark):
    draw = random.Random(4)
    rows, vocabulary = [], [f"w{i}" for i in range(4000)]
    for base in range(25):
        words = draw.choices(vocabulary, k=draw.randint(6, 300))
        rows += [(len(rows) + k, " ".join(changed(draw, words, draw.choice([0, 0.005, 0.01, 0.02, 0.04, 0.1])))) for k in range(draw.randint(1, 9))]
    hub = draw.choices(vocabulary, k=200)  # many near copies of one text; they are less alike among themselves
    rows += [(1000 + k, " ".join(changed(draw, hub, 0.012))) for k in range(60)]
    rows += [(2000 + k, text) for k, text in enumerate(["", "", " ", None, None, "a", "a", "a b c d", "a b c d e", "a " * 4000, "a " * 4100, "a " * 9000])]
    rows += [(3000, rows[0][1]), (3000, "other text with the same id of its own"), (None, rows[0][1]), (None, "no id"), (None, "no id"), (5, rows[5][1])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(groups(frame)) == expected(rows)


def test_deduplicated_keeps_columns_and_one_row_each(spark):
    long = " ".join(f"w{i}" for i in range(100))
    rows = [(3, long, "x", 1), (1, long + " more", "y", 2), (1, long + " more", "a", 2), (7, "alone", "z", 3), (8, None, "n", 4), (8, None, "n", 4), (None, "alone", "z", 3)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, digest string, node int")
    kept = sorted(map(tuple, deduplicated(frame).collect()), key=str)
    assert kept == sorted([(1, long + " more", "a", 2), (7, "alone", "z", 3), (8, None, "n", 4), (8, None, "n", 4)], key=str)
    assert deduplicated(frame.limit(0)).count() == 0 and groups(frame.limit(0)).count() == 0


@pytest.mark.parametrize("rounds", [0, 1])
def test_the_last_round_loses_no_link(spark, rounds):
    from daygrid.llm import neardup

    draw = random.Random(6)
    hub = [f"w{i}" for i in range(300)]
    chain = [hub]  # each like the next, the ends unlike
    for _ in range(12):
        chain.append(changed(draw, chain[-1], 0.015))
    rows = [(i, " ".join(words)) for i, words in enumerate(chain)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    signed = neardup.signed(frame)
    own = neardup.stored(signed.withColumn("node", signed.doc_id))
    labels = components_of(neardup.links(frame, own, rounds=rounds))
    brute = {frozenset(g) for g in classes(rows) if len(g) > 1}
    assert labels == brute


def components_of(edges):
    found = defaultdict(set)
    for r in components(edges).collect():
        found[r.component].add(r.node)
    return {frozenset(g) for g in found.values()}


def test_query_against_brute_force(spark, sf_dir):
    found = QUERIES["op7_bag_minhash_dedup"](spark, sf_dir)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(found) == expected(rows)
    assert found.where("kept").count() == len(classes(rows))


def test_stays_is_a_column(spark):
    frame = spark.createDataFrame([(1, b"a", 1, b"a"), (1, b"b", 1, b"a"), (None, None, None, None)], "doc_id int, digest binary, class_id int, class_digest binary")
    assert [r[0] for r in frame.select(stays()).collect()] == [True, False, True]
