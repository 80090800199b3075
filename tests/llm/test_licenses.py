import random
import re
import time

import pytest

from daygrid.llm.licenses import BANDS, NOTICES, notices, scanned, size_class, stride
from daygrid.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(own):
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def plain(text, given=NOTICES, contained=0.8):
    own, best = words(text), {}
    for name, notice in given:
        sought, size = shingles(words(notice)), size_class(len(words(notice)))
        for start in range(0, max(len(own), 1), stride(size)):
            share = len(sought & shingles(own[start : start + size + stride(size)])) / len(sought)
            if share >= contained:
                best[name] = max(best.get(name, 0), share)
    return sorted(best.items())


def got(frame):
    return [(r.doc_id, [(x.license_id, x.containment) for x in r.licenses]) for r in frame.collect()]


def test_bands_retrieve_what_is_contained():
    for n in range(5, 400):
        size = size_class(n)
        most = size + stride(size) - 4  # shingles of a window
        shared = -(-4 * (n - 4) // 5)
        least = shared / (most + (n - 4) - shared)
        assert n <= size and least >= 0.44 and (1 - least) ** BANDS < 1e-5


def test_common_licenses_and_versions():
    head = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    for family, version, name in [("", "2", "GPL-2.0"), ("", "3", "GPL-3.0"), ("Lesser ", "2.1", "LGPL-2.1"), ("Lesser ", "3", "LGPL-3.0"), ("Affero ", "3", "AGPL-3.0")]:
        assert [x for x, _ in plain(head.format(family, version))] == [name]
    assert [x for x, _ in plain("You should have received a copy of the GNU General Public License along with this program")] == ["GPL"]
    for name, notice in NOTICES:
        if name not in ("GPL", "GPL-3.0"):
            assert [x for x, _ in plain(notice)] == [name]
    assert {"ISC", "CC0-1.0", "Unlicense"} <= {name for name, _ in NOTICES}


def test_scan_equals_brute_force(spark):
    draw = random.Random(1)
    vocabulary = [f"w{i}" for i in range(50)] + "the this is of License work under".split()
    texts = [None, "", "licensed under", "Released under the MIT License.", "RELEASED under--the\nMIT licenseé", "Released under the MIT", " ".join(NOTICES[10][1].split()[:-3])]
    for name, notice in NOTICES * 6:
        own = notice.split()
        for _ in range(draw.randint(0, 2)):
            own[draw.randrange(len(own))] = draw.choice(vocabulary)
        texts.append(" ".join(draw.choices(vocabulary, k=draw.randint(0, 60)) + own + draw.choices(vocabulary, k=draw.randint(0, 30)) + (notice.split() if draw.random() < 0.3 else [])))
    texts.append("x " * 30_000 + NOTICES[6][1] + " y" * 30_000)
    rows = [(i, t, "x", 5) for i, t in enumerate(texts)] + [(3, "again " + NOTICES[0][1], "x", 5), (None, NOTICES[0][1], "x", 5), (None, NOTICES[0][1], "x", 5)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, key string, size int")
    assert sorted(got(scanned(frame, notices(spark))), key=str) == sorted(((i, plain(t)) for i, t, _, _ in rows), key=str)


def test_short_notices_are_refused(spark):
    with pytest.raises(ValueError):
        notices(spark, [("MIT", "MIT License")])


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert scanned(frame, notices(spark)).count() == 0
    assert got(scanned(spark.createDataFrame([(1, "nothing here")], "doc_id bigint, text string"), notices(spark))) == [(1, [])]


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op2_license_scan"](spark, sf_dir).collect()
    assert len(found) == len(texts) and any(r.n_licenses for r in found)
    for r in found:
        assert r.licenses == ",".join(name for name, _ in plain(texts[r.doc_id])) and r.n_licenses == len(plain(texts[r.doc_id]))


def test_a_text_of_thousands_of_notices(spark):
    """Its time grows with its length: the words are split once, and the windows are cut from them."""
    line = NOTICES[0][1]
    times = []
    for n in (500, 5000):
        text = " ".join(f"{line} word{i} and some more words of its own" for i in range(n))
        start = time.perf_counter()
        found = scanned(spark.createDataFrame([(1, text)], "doc_id int, text string"), notices(spark)).collect()
        times.append(time.perf_counter() - start)
        assert [x.license_id for x in found[0].licenses] == [NOTICES[0][0]]
    assert times[1] < 60
