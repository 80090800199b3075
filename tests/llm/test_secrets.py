import random
import re
import time

import duckdb
import pytest

from daygrid.llm.automaton import compiled
from daygrid.llm.queries import ORACLES, QUERIES
from daygrid.llm.secrets import RULES, Scanner, found, redacted


def plain(text):
    """The rules by Python's own regular expressions, one family after another."""
    out = []
    for family in dict.fromkeys(r.family for r in RULES):
        own = [(k, r) for k, r in enumerate(RULES) if r.family == family]
        either = "|".join(("(?<![A-Za-z0-9_-])" if r.bounded else "") + f"(?P<k{k}>{r.pattern})" for k, r in own)
        for m in re.finditer(either, text):
            k = next(k for k, _ in own if m[f"k{k}"] is not None)
            if re.fullmatch(RULES[k].kept, m[0]):
                out.append((m.start(), k, m.end()))
    return [(start, end, RULES[k].kind) for start, k, end in sorted(out)]


PLANTED = {
    "assign": 'token = "abcdefghijkl"', "access": "AKIA0123456789ABCD", "hex": "0123456789abcdef", "named": "db_pwd: hunter2hunter2", "github": "ghp_" + "a1B2" * 9,
    "gitlab": "glpat-" + "x-_1" * 5, "slack": "xoxb-123-456-abcDEF", "google": "AIza" + "Ab_-0" * 7, "stripe": "sk_live_" + "9z" * 8, "npm": "npm_" + "Zz09" * 9,
    "sendgrid": "SG." + "a" * 16 + "." + "b" * 32, "jwt": "eyJhbGciOi.eyJzdWIiOi.abcdefghijklmnop", "bearer": "Bearer abc/def+ghi~jkl._-=123", "login": "postgres://me:s3cret@host/db",
    "private": "-----BEGIN RSA PRIVATE KEY-----",
}


@pytest.mark.parametrize("kind", sorted(PLANTED))
def test_each_kind_is_found(kind):
    text = f"é {PLANTED[kind]} ü"
    spans = Scanner().spans(text.encode())
    assert kind in [k for _, _, k in spans] and spans == plain(text)
    assert set(PLANTED) == {r.kind for r in RULES}


def test_equals_plain_expressions_on_random_texts():
    scanner, draw = Scanner(), random.Random(3)
    parts = [*PLANTED.values(), *(p[: len(p) // 2] for p in PLANTED.values()), "password", "APIKEY", "api_key", "pass", '"', "'", " ", "=", ":", "AKIA", "éß", ".", "-", "_", "0a" * 9, "://", "@", "\n"]
    seen = set()
    for _ in range(6000):
        text = "".join(draw.choices(parts, k=draw.randint(1, 12)))
        spans = scanner.spans(text.encode())
        assert spans == plain(text), text
        seen |= {k for _, _, k in spans}
    assert seen == set(PLANTED)


def test_failing_matches_are_not_tried_again():
    assert Scanner().spans(b"token=password: abcdefghijklmnop") == []
    odd = "\u017fecret=abcdefghijkl to\u212aen=abcdefghijkl"  # letters that only fold to s and k
    assert Scanner().spans(odd.encode()) == plain(odd) == []


def test_long_runs_take_linear_time():
    scanner = Scanner()
    scanner.spans(b"warm")
    start = time.perf_counter()
    for text in ("a" * 400_000, "token=" * 70_000, "AKIA" * 100_000, "://a:" * 80_000, "eyJa." * 80_000, "0" * 15 + "x", "pwd " * 100_000):
        assert scanner.spans(text.encode()) == plain(text)
    assert time.perf_counter() - start < 20


def test_states_are_few_and_minimal():
    machine = Scanner().machine
    assert machine.states < 10_000
    # Two ways to write a rule give automata of one size, and redundant alternatives add nothing.
    assert compiled([[("ab+", False)]]).states == compiled([[("a(b|b)b*|abb+", False)]]).states


@pytest.mark.parametrize("pattern", ["a*", "(ab)+c?d*|", "a(bc)?", "[", "a)", r"\w"])
def test_refused_patterns(pattern):
    with pytest.raises(ValueError):
        compiled([[(pattern, False)]])


def test_rules_of_a_user():
    machine = compiled([[("ab{2,3}", False)], [("x[0-9]{2}", True)]])
    assert list(machine.matches(b"abbbb yabb x123 ax12 x45")) == [(0, 0, 4), (0, 7, 10), (1, 11, 14), (1, 21, 24)]


def test_tables(spark):
    rows = [(1, None, 0), (2, "", 1), (3, "é token=abcdefghijkl", 2), (3, "é token=abcdefghijkl", 2), (4, "clean", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans int")
    spans = {(r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in found(docs).collect()}
    assert spans == {(1, ()), (2, ()), (3, (("assign", 2, 20),)), (4, ())} and found(docs).count() == 5
    clean = redacted(docs)
    assert clean.schema == docs.schema
    assert sorted((r.doc_id, r.text) for r in clean.collect() if r.text) == [(3, "é [ASSIGN]"), (3, "é [ASSIGN]"), (4, "clean")]
    assert found(docs.limit(0)).count() == 0 and redacted(docs.limit(0)).count() == 0


def test_query_and_sql_on_planted_texts(spark, tmp_path):
    draw = random.Random(5)
    texts = [" ".join(draw.choices([*PLANTED.values(), "word", "é", 'x="', "."], k=draw.randint(1, 20))) for _ in range(200)]
    docs = spark.createDataFrame([*enumerate(texts), (1000, None), (1001, "")], "doc_id bigint, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = duck.execute(ORACLES["op12_secret_scan"])
    names = [d[0] for d in want.description]
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r)) for r in QUERIES["op12_secret_scan"](spark, str(tmp_path)).select(*names).collect())
