import hashlib
import math
import random
import re
import time
from collections import defaultdict

import pytest

from daygrid.llm.queries import QUERIES
from daygrid.llm.urls import ALPHABET, RULES, STEP, judged


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    return lower, re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.host + r.path), default=None)


def grams(text, order):
    padded = " " * order + text + "\x02"
    return [padded[i : i + order + 1] for i in range(len(text) + 1)]


def plain(urls, order=4):
    """Rows as the operator gives them, from dictionaries."""
    known = [(i, *parts(u)) for i, u in urls]
    rules = [rule_of(h, p) for _, h, p in known]
    texts = [re.sub(r"[^\x21-\x7e]", "\x01", h + p) for _, h, p in known]
    labels = [r.verdict if r else None for r in rules]
    held = [hashlib.md5(t.encode()).hexdigest()[0] in "0123" for t in texts]
    learned = {label for label, h in zip(labels, held, strict=True) if not h}
    both = {"allow", "block"} <= learned

    def trained(verdict):
        n = [defaultdict(lambda: defaultdict(int)) for _ in range(order + 1)]
        for text, label, h in zip(texts, labels, held, strict=True):
            if label == verdict and not h:
                for g in grams(text, order):
                    for k in range(order + 1):
                        n[k][g[order - k : -1]][g[-1]] += 1

        def p(g):
            value = 1 / ALPHABET
            for k in range(order + 1):
                own = n[k].get(g[order - k : -1])
                if own:
                    value = (own.get(g[-1], 0) + len(own) * value) / (sum(own.values()) + len(own))
            return value

        return p

    score = dict.fromkeys(texts, 0.0)
    if both:
        allow, block = trained("allow"), trained("block")
        for text in set(texts):
            own = grams(text, order)
            score[text] = sum(round(math.log(allow(g)) - math.log(block(g)), 9) for g in own) / len(own)
    limit = 0.0
    judges = [(label, math.floor(score[t] / STEP) * STEP) for label, t, h in zip(labels, texts, held, strict=True) if h and label]
    n_allow, n_block = (sum(label == v for label, _ in judges) for v in ("allow", "block"))
    if n_allow and n_block:
        best = (-1.0, 0.0)
        for at in sorted({b for _, b in judges}):
            right = sum(lab == "allow" and b >= at for lab, b in judges) / n_allow
            rejected = sum(lab == "block" and b < at for lab, b in judges) / n_block
            if (right + rejected, -abs(at)) > best:
                best, limit = (right + rejected, -abs(at)), at
    out = []
    for (i, h, p), r, t in zip(known, rules, texts, strict=True):
        verdict = r.verdict if r else "allow" if score[t] >= limit else "block"
        out.append((i, h, p, r.host + r.path if r else None, verdict, None if r else round(score[t], 6)))
    return out


def got(frame):
    return [(r.page_id, r.host, r.path, r.rule, r.verdict, None if r.score is None else round(r.score, 6)) for r in frame.collect()]


def test_parts_and_rules(spark):
    urls = ["HTTP://WWW.Example.ORG/es/A?x#y", "x://example.org/en/1", "x://example.org/en/2", "x://notexample.org/es/", "x://org/", "x://org", "x://a.com/fr/", "x://a.com/de/é",
            "x://com/de/", "x://a.com/fr", "x://xcom/fr/", None, "", "no scheme", "://", "a://b://c/d", "x://h?q/p", "x://h#f/p", "x://É.ORG/", "x:///only/path", "x://a.example.org/es/\n/z"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, urls[0]), (None, urls[1]), (99, "x://q.net/"), (99, "x://q.net/")]
    frame = spark.createDataFrame([(*r, "h", "t", 1.0) for r in rows], "page_id bigint, url string, host string, text string, score double")
    assert sorted(map(str, got(judged(frame)))) == sorted(map(str, plain(rows)))
    assert judged(frame.limit(0)).count() == 0


@pytest.mark.parametrize("tops", [("org", "com"), ("net",), ("org", "net")])
def test_model_equals_brute_force(spark, tops):
    draw = random.Random(len(tops))
    hosts = [f"{a}{b}.{t}" for a in ("a", "www.b", "c") for b in ("x", "yz", ".example") for t in tops]
    rows = [(i, f"http://{draw.choice(hosts)}/{draw.choice(['fr', 'de', 'en', 'es'])}/{draw.randint(0, 999)}{draw.choice(['', '?q', 'ü', '.html'])}") for i in range(250)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(2000, "http://q.net/" + "long/" * 4000)]
    assert sorted(map(str, got(judged(spark.createDataFrame(rows, "page_id bigint, url string"))))) == sorted(map(str, plain(rows)))


def test_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()]
    found = QUERIES["op4_url_filter"](spark, sf_dir)
    assert sorted(map(str, got(found))) == sorted(map(str, plain(rows)))
    assert {r.verdict for r in found.where("rule IS NULL").collect()} == {"allow", "block"}


def test_very_long_urls_take_time_in_proportion(spark):
    """A URL of 100,000 characters is one row of work for each of them."""
    long = "x://a.net/" + "abc/" * 25_000
    rows = [(1, long), (2, "x://b.net/" + "xyz" * 13_000), (3, "x://a.org/ab"), (4, "x://a.com/de/xy")]
    rows += [(10 + i, f"x://h{i}.org/abc/{i}") for i in range(20)] + [(40 + i, f"x://h{i}.com/de/xyz/{i}") for i in range(20)]
    start = time.perf_counter()
    found = {r[0]: r for r in got(judged(spark.createDataFrame(rows, "page_id bigint, url string")))}
    assert time.perf_counter() - start < 60
    assert found[1][4] == "allow" and found[2][4] == "block" and len(found[1][2]) == 100_001
    assert sorted(map(str, found.values())) == sorted(map(str, plain(rows)))
