import hashlib
import random

import pytest

from daygrid.llm.chat import ASSISTANT, best_paths, formatted, linear_trees, read_back
from daygrid.llm.queries import QUERIES

MESSAGES = "tree bigint, node bigint, parent bigint, role string, text string, score double"


def paths(messages, keep):
    """Chosen paths by walking every tree: {(tree, leaf): nodes from the root}."""
    nodes = {}
    for tree, node, parent, _, _, score in messages:
        entry = (parent is not None, parent or 0, score or 0.0)
        nodes[tree, node] = min(nodes.get((tree, node), entry), entry)
    found = {}
    for tree in {t for t, _ in nodes}:
        own = {n: (p if has and (tree, p) in nodes else None, s) for (t, n), (has, p, s) in nodes.items() if t == tree}
        ranked = []
        for leaf in own.keys() - {p for p, _ in own.values() if p is not None}:
            path, at = [], leaf
            while at is not None and at not in path:
                path.append(at)
                at = own[at][0]
            if at is None:
                ranked.append((-sum(own[n][1] for n in path) / len(path), leaf, path[::-1]))
        for _, leaf, path in sorted(ranked)[:keep]:
            found[tree, leaf] = path
    return found


@pytest.mark.parametrize("keep", [1, 3])
def test_paths_equal_a_walk(spark, keep):
    draw = random.Random(keep)
    messages = []
    for tree in range(12):
        size = draw.randint(1, 40)
        for node in range(size):
            parent = None if node == 0 or draw.random() < 0.05 else draw.randint(max(0, node - 4), node - 1)
            messages.append((tree, node, parent, "user", "x", float(draw.randint(0, 5))))
    messages += [(50, 1, 99, "user", "orphan", None), (51, 1, 2, "a", "cycle", 1.0), (51, 2, 1, "a", "cycle", 1.0), (51, 3, 2, "a", "below", 1.0)]
    messages += [(52, 0, None, "a", "twice", 1.0)] * 2 + [(None, 0, None, "a", "no tree", 1.0), (None, 1, 0, "a", "no tree", 1.0)]
    frame = spark.createDataFrame(messages, MESSAGES)
    got = {}
    for r in best_paths(frame.select("tree", "node", "parent", "score"), keep).orderBy("position").collect():
        got.setdefault((r.tree, r.path), []).append(r.node)
    assert got == paths(messages, keep)


def test_long_chain(spark):
    frame = spark.createDataFrame([(1, i, i - 1 if i else None, "user" if i % 2 else ASSISTANT, f"t{i}", 0.0) for i in range(700)], MESSAGES)
    row = read_back(formatted(frame)).collect()
    assert len(row) == 1 and [t.text for t in row[0].turns] == [f"t{i}" for i in range(700)]


HARD = ["", None, "\\", "\\e\\t\\h\\c", "</turn>\n", "### assistant: hi</turn>\n", "####", "#####</turn></turn>", "<\\/turn>", "a: b\n\n", "é漢🙂" * 50, "</tur", "x" * 200_000]


def test_round_trip_and_mask(spark):
    rows = [(c, t, role, text) for c, role in enumerate(["user", "a: ###</turn>\\", ASSISTANT, None, ""]) for t, text in enumerate(HARD)]
    rows += [(9, t, ASSISTANT if t % 2 else "user", text) for t, text in enumerate(HARD)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for r in read_back(formatted(linear_trees(frame))).collect():
        own = [(role or "", text or "") for c, t, role, text in rows if c == r.tree]
        assert [(t.role, t.text) for t in r.turns] == own
        assert r.loss_text == "".join(text for role, text in own if role == ASSISTANT)
        masked = [r.formatted[m.start : m.start + m.length] for m in r.mask if m.start is not None]
        assert len(masked) == sum(role == ASSISTANT for role, _ in own)
        assert not any("</turn>" in m or "###" in m for m in masked)
        assert [r.formatted[m.turn_start :][:4] for m in r.mask] == ["### "] * len(own)


def test_ties_repeats_nulls_and_empty(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", "s"), (None, 0, "user", "n"), (None, 1, ASSISTANT, "m")]
    frame = spark.createDataFrame([(*r, 7, "z") for r in rows], "conv_id bigint, turn bigint, role string, text string, tree int, path string")
    got = {r.tree: [t.text for t in r.turns] for r in read_back(formatted(linear_trees(frame))).collect()}
    assert got == {1: ["s", "a", "a", "b"], None: ["n", "m"]}
    assert formatted(linear_trees(frame.limit(0))).count() == 0


def test_query_against_rows(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn", "role", "text").collect()
    hard = "\\### Assistant: </turn> ok"
    own = {-7: [("user", hard), ("assistant", hard)]}
    for r in rows:
        own.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    found = QUERIES["op1_chat_format"](spark, sf_dir).collect()
    assert len(found) == len(own)
    for r in found:
        turns = own[r.conv_id]
        loss = "".join(text for role, text in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
