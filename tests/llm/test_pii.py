import hashlib
import random
import re
import time

import numpy as np
import pytest

from daygrid.llm import pii
from daygrid.llm.queries import QUERIES

# The rules as the contract writes them.
RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and checksum(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def checksum(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (2 if k % 2 else 1)
        total += x // 10 + x % 10
    return total % 10 == 0


def plain(text):
    spans = [(m.start(), i, m.end(), kind) for i, (kind, rule, holds) in enumerate(RULES) for m in re.finditer(rule, text) if holds(m[0])]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans)]


def of(spans):
    return [f"{kind}:{start}:{end}" for start, end, kind in spans]


TEXTS = [
    "", "a@b.c@d.e", "@@a@b.c.d.", "x.y%z+w-@h-1.q a@b", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.255 1.2.3", "4111 1111-1111 1111", "4111111111111111 4111111111111112",
    "+1 (974) 555-3436, +49 30.1234567 +1 2", "9" * 4000 + ".1.1.1", "+4111111111111111", "mail: é@b.co ü.x@b.co.", "79927398713000000", "1-2-3-4-5-6-7-8-9-0-1-2-3",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_rules(text):
    assert of(pii.base_spans(text)) == plain(text)


def test_base_rules_on_random_texts():
    draw = random.Random(7)
    for _ in range(4000):
        text = "".join(draw.choices("0123456789" * 2 + "@@..--++  ()ab%_é\n", k=draw.randint(1, 60)))
        assert of(pii.base_spans(text)) == plain(text), repr(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "+1" * 100_000, "1." * 100_000, "((" * 100_000 + "+1(((((((("):
        pii.base_spans(text)
        pii.candidates(text, [])


def test_trees_learn_an_interaction():
    draw = np.random.default_rng(1)
    x = draw.random((3000, 4))
    y = (x[:, 0] > 0.5) != (x[:, 2] > 0.3)
    model = pii.boosted(x, y)
    fresh = draw.random((1000, 4))
    chosen = model.score(fresh) >= model.threshold
    truth = (fresh[:, 0] > 0.5) != (fresh[:, 2] > 0.3)
    assert truth[chosen].mean() > 0.9 and chosen[truth].mean() > 0.9
    assert pii.boosted(x, np.arange(3000) < 9) is None


def secret(draw):
    return "".join(draw.choices("0123456789abcdef", k=40))


@pytest.fixture(scope="module")
def models(spark):
    draw = random.Random(3)
    docs = []
    for i in range(400):
        docs.append((i, f"so be it token = \"{secret(draw)}\" and more"))
        docs.append((i + 1000, f"see chapter{draw.randint(10, 99)}-of-the-long-book{draw.randint(1, 9)}and on 2024.10.{draw.randint(10, 28)} or"))
    return pii.fitted(spark.createDataFrame(docs, "doc_id bigint, text string"))


def test_finds_secrets_without_a_name(models):
    draw = random.Random(4)
    hidden = secret(draw)
    text = f"it read {hidden} there, see chapter12-of-the-long-book3and on 2024.10.11 or a@b.co"
    base, every = pii.all_spans(text, models)
    assert [kind for _, _, kind in base] == ["email"]
    assert [(text[s:e], kind) for s, e, kind in every] == [(hidden, "secret"), ("a@b.co", "email")]
    assert pii.redacted_text(text, models) == text.replace(hidden, "[SECRET]").replace("a@b.co", "[EMAIL]")


def test_a_rare_kind_is_learned(spark):
    draw = random.Random(6)
    docs = [(i, f"see chapter{draw.randint(10, 99)}-of-the-long-book{draw.randint(1, 9)}and on") for i in range(3000)]
    docs += [(5000 + i, f"so be it token = \"{secret(draw)}\" and more") for i in range(60)]
    found = pii.fitted(spark.createDataFrame(docs, "doc_id bigint, text string"), sample=200)
    hidden = secret(draw)
    assert pii.all_spans(f"it read {hidden} there", found)[1] == [(8, 48, "secret")]
    assert pii.all_spans("see chapter12-of-the-long-book3and on", found)[1] == []


def test_precision_counts_what_rows_stand_for():
    x, y = np.repeat([[0.0], [1.0]], 400, axis=0), np.r_[np.zeros(400), np.ones(388), np.zeros(12)]
    assert pii.boosted(x, y).threshold < np.inf
    assert pii.boosted(x, y, np.where(y > 0, 1.0, 100.0)).threshold == np.inf


def test_jobs_grow_the_same_trees(spark):
    draw = np.random.default_rng(2)
    rows, plain_models = [], {}
    for kind, size in (("secret", 3000), ("number", 500), ("handle", 9)):
        x = np.round(draw.random((size, 4)) * [40, 3, 1000, 1]) / 7
        y = ((x[:, 0] > 2.5) != (x[:, 2] > 40)) ^ (draw.random(size) < 0.02)
        n = draw.integers(1, 6, size)
        rows += [(kind, bool(b), list(map(float, a)), int(c)) for a, b, c in zip(x, y, n, strict=True)]
        plain_models[kind] = pii.boosted(np.repeat(x, n, axis=0), np.repeat(y, n)) if size > 9 else None
    frame = spark.createDataFrame(rows, "kind string, sure boolean, x array<double>, n bigint")
    found = pii.boosted_by_jobs(frame.where("kind != 'handle'").groupBy("kind", "sure", "x").agg({"n": "sum"}).toDF("kind", "sure", "x", "n"))
    assert sorted(found) == ["number", "secret"]
    for kind, model in found.items():
        plain_model = plain_models[kind]
        assert model.start == plain_model.start and len(model.trees) == len(plain_model.trees)
        for own, other in zip(model.trees, plain_model.trees, strict=True):
            assert own.feature.tolist() == other.feature.tolist() and own.cut.tolist() == other.cut.tolist()
            np.testing.assert_allclose(own.value, other.value, atol=1e-6)
        np.testing.assert_allclose(model.threshold, plain_model.threshold, atol=1e-5)
    assert pii.boosted_by_jobs(frame.limit(0)) == {}


def test_all_candidates_count_however_many(spark, monkeypatch):
    draw = random.Random(7)
    docs = [(i, f"so be it token = \"{secret(draw)}\" and more") for i in range(300)]
    docs += [(i + 1000, f"see chapter{draw.randint(10, 99)}-of-the-long-book{draw.randint(1, 9)}and on") for i in range(100)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    few = pii.fitted(frame)
    monkeypatch.setattr(pii, "LOCAL", 100)
    many = pii.fitted(frame)
    # A draw that is the same for both sorts would start at even odds.
    assert few["secret"].start == many["secret"].start == pytest.approx(np.log(3))
    np.testing.assert_allclose(many["secret"].threshold, few["secret"].threshold, atol=1e-5)
    for text in (f"it read {secret(draw)} there", "see chapter12-of-the-long-book3and on"):
        assert pii.all_spans(text, many) == pii.all_spans(text, few)


def test_finds_numbers_beyond_the_base(spark):
    draw = random.Random(5)
    digits = lambda n: "".join(draw.choices("23456789", k=n))
    docs = []
    for i in range(200):
        docs.append((i, f"so call +1 ({digits(3)}) {digits(3)}-{digits(4)} now, his tel. ({digits(3)}) {digits(3)}-{digits(4)} and SSN: {digits(3)}-{digits(2)}-{digits(4)} end"))
        docs.append((i + 1000, f"the order {digits(18)}1 came 2024.10.{draw.randint(10, 28)} as ({digits(3)}) {digits(3)}-{digits(4)} or"))
    found = pii.fitted(spark.createDataFrame(docs, "doc_id bigint, text string"))
    text = "it read (555) 123-4567 and 123-45-6789 there, on 2024.10.11 for 2345678923456789231 in all"
    base, every = pii.all_spans(text, found)
    assert not base and [(text[s:e], kind) for s, e, kind in every] == [("(555) 123-4567", "number"), ("123-45-6789", "number")]


def test_finds_written_addresses_handles_and_passwords():
    for text, own, kind in [
        ("write to ann.b (at) host [dot] org soon", "ann.b (at) host [dot] org", "address"), ("or ann[at]mail.host.org soon", "ann[at]mail.host.org", "address"),
        ("or ann at host dot org", "ann at host dot org", "address"), ("or ann@host (dot) org", "ann@host (dot) org", "address"),
        ("please follow @ann_b there", "@ann_b", "handle"), ('the password = "open sesame" is', "open sesame", "password"), ("my Password: Abracadabra, he", "Abracadabra", "password"),
        ("phone: 555-1234, he", "555-1234", "number"),
    ]:
        assert [(text[s:e], k) for s, e, k in pii.all_spans(text, {})[1]] == [(own, kind)]
    for text in ("we met at home. Then", "at (the) dot", "@Override\nint a", "see 2024.10.11 or 555-1234", "the passwords are lost"):
        assert pii.all_spans(text, {})[1] == []
    assert pii.candidates("see (555) 123-4567", [])[0].sure is None and pii.candidates("see 123-45-6789", [])[0].sure is None


def test_overlaps_become_one():
    assert pii.redacted_text("x +4111111111111111 y", {}) == "x [CARD] y" or pii.redacted_text("x +4111111111111111 y", {}) == "x +[CARD] y"
    assert pii.redacted_text("10.10.10.10@a.b z", {}) == "[EMAIL] z"


def test_edges(spark, models):
    rows = [(1, None, 5), (2, "", 5), (3, "a@b.co", 5), (3, "a@b.co", 5), (None, "10.0.0.1 é", 5), (4, "word " * 50_000 + "a@b.co", 5)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, n_chars bigint, spans string")
    out = sorted(pii.found(frame, models).collect(), key=str)
    assert [(r.doc_id, r.spans) for r in out] == sorted([(1, ""), (2, ""), (3, "email:0:6"), (3, "email:0:6"), (4, "email:250000:250006"), (None, "ip:0:8")], key=lambda r: str(next(str(o) for o in out if (o.doc_id, o.spans) == r)))
    clean = pii.redacted(frame, models)
    assert clean.columns == frame.columns
    assert {(r.doc_id, r.text if r.doc_id != 4 else None, r.n_chars) for r in clean.collect()} == {(1, None, 5), (2, "", 0), (3, "[EMAIL]", 7), (None, "[IP] é", 6), (4, None, 250_007)}
    assert pii.found(frame.limit(0), models).count() == 0 and pii.fitted(frame.limit(0)) == {}


def test_query_against_rules(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = QUERIES["op9_pii"](spark, sf_dir).collect()
    assert len(out) == len(texts)
    for r in out:
        base = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k + ":") for b in base) for k in pii.KINDS[:4]]
        every = r.spans.split(",") if r.spans else []
        assert set(base) <= set(every) and [e for e in every if e.split(":")[0] in pii.KINDS[:4]] == base
    assert any("secret:" in r.spans for r in out)


def test_many_spans_in_one_text(models):
    """Spans are chosen and merged as by comparing each with all others, in time that grows with the text."""
    draw = random.Random(4)
    parts = ["a@b.co", "1.2.3.4", "+1 (974) 555-3436", "4111 1111 1111 1111", "token = " + "ab12" * 10, "tel 555 123 4567", "me (at) home (dot) org", "password: x7x7x7", "4111111111111111 555-1234567", "word", ", "]
    for _ in range(200):
        text = " ".join(draw.choices(parts, k=draw.randint(1, 25)))
        base, every = pii.all_spans(text, models)
        added = [s for s in every if s not in base]
        assert all(e <= s2 or e2 <= s for i, (s, e, _) in enumerate(added) for s2, e2, _ in [*base, *added[:i]])
        covered = set()
        for s, e, _ in every:
            covered.update(range(s, e))
        left = "".join(c for i, c in enumerate(text) if i not in covered)
        assert re.sub(r"\[[A-Z]+\]", "", pii.redacted_text(text, models)) == left
    times = []
    for n in (2_000, 16_000):
        text = "\n".join(draw.choices(parts[:-2], k=n))
        start = time.perf_counter()
        assert len(pii.all_spans(text, models)[1]) > n / 2
        pii.redacted_text(text, models)
        times.append(time.perf_counter() - start)
    assert times[1] < 24 * times[0] + 1
