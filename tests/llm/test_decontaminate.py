import random
import re

import pytest

from daygrid.llm import windows
from daygrid.llm.decontaminate import clean, hits
from daygrid.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, items, n=13):
    own, hit, found = words(text), set(), set()
    for item_id, item in items:
        sought = words(item)
        for i in range(max(1, len(sought) - n + 1) if sought else 0):
            window = sought[i : i + n]
            for p in range(len(own) - len(window) + 1):
                if own[p : p + len(window)] == window:
                    hit |= set(range(p, p + len(window)))
                    found.add(str(item_id))
    return len(own), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(own)


def tables(spark):
    draw = random.Random(3)
    vocabulary = ["the", "of", "The", "É", "é", "x1", "K", "İ", "ß", "Σ", "ς"] + [f"w{i}" for i in range(30)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([1, 2, 5, 12, 13, 14, 30])))) for i in range(25)]
    items += [(0, None), (77, ""), (78, "?!"), (79, items[3][1]), (None, items[4][1])]
    docs = []
    for i in range(60):
        own = draw.choices(vocabulary, k=draw.randint(0, 40))
        for _ in range(draw.randint(0, 2)):
            item = draw.choice(items)[1] or ""
            own += item.split()[draw.randint(0, 1) :] + draw.choices(vocabulary, k=draw.randint(0, 30))
        docs.append((i, draw.choice(["", "...", "\n"]) + draw.choice([" ", ", ", "--"]).join(own) + draw.choice(["", "."])))
    docs += [(100, None), (101, ""), (102, "?"), (3, docs[3][1]), (3, docs[4][1]), (None, docs[5][1]), (103, "w1 " * 50_000 + (items[7][1] or ""))]
    docs = [(*d, "x", 1) for d in docs]
    return items, docs, spark.createDataFrame(items, "item_id bigint, text string"), spark.createDataFrame(docs, "doc_id bigint, text string, window string, length int")


@pytest.mark.parametrize("part", [windows.PART, 20])
def test_hits_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(windows, "PART", part)  # 20: many passes
    items, docs, benchmark, frame = tables(spark)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in hits(frame, benchmark).collect()), key=str)
    own = [i for i in items if i[0] is not None]
    expected = [(i, *plain(t, own)) for i, t, _, _ in docs]
    null = [(i, *plain(t, items)) for i, t, _, _ in docs]  # an item without an id still covers words
    assert got == sorted(((i, n, h, f, c) for (i, _, _, f, _), (_, n, h, _, c) in zip(expected, null, strict=True)), key=str)
    kept = sorted((tuple(r) for r in clean(frame, benchmark).collect()), key=str)
    assert kept == sorted((d for d, x in zip(docs, null, strict=True) if not x[-1]), key=str) and 0 < len(kept) < len(docs)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert [tuple(r) for r in hits(docs, benchmark.limit(0)).collect()] == [(1, 3, 0, [], False)]
    assert hits(docs.limit(0), benchmark).count() == 0 and clean(docs, benchmark).count() == 0


def test_query(spark, sf_dir):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 150").collect()
    found = {r.doc_id: r for r in QUERIES["op8_benchmark_decontamination"](spark, sf_dir).collect()}
    for d in docs:
        n, hit, ids, bad = plain(d.text, items)
        assert (found[d.doc_id].n_words, found[d.doc_id].n_hit, found[d.doc_id].n_items, found[d.doc_id].contaminated) == (n, hit, len(ids), bad)
