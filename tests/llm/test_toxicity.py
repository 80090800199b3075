import math
import random
import zlib

import numpy as np
import pytest

from daygrid.llm import toxicity
from daygrid.llm.queries import QUERIES


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def corpus(n, seed):
    """Texts of invented words; toxic ones have one word in fifty from a small list, and some labels are wrong."""
    draw = random.Random(seed)
    plain, rude = [f"{a}{b}" for a in "ba ce di fo gu la mi no".split() for b in "len tor mas kin pul ver".split()], ["zarkon", "zarkis", "zarkul", "moron", "quelp"]
    docs, truth, labels = [], {}, []
    for i in range(n):
        toxic = draw.random() < 0.15
        words = draw.choices(plain, k=draw.randint(30, 300))
        for k in draw.sample(range(len(words)), max(2, len(words) // 40) if toxic else 0):
            words[k] = draw.choice(rude)
        docs.append((i, " ".join(words)))
        truth[i] = int(toxic)
        labels.append((i, truth[i] if draw.random() > 0.03 else 1 - truth[i]))
    return docs, truth, labels


def auc(scores, truth):
    high, low = [s for i, s in scores.items() if truth[i]], np.array([s for i, s in scores.items() if not truth[i]])
    return np.mean([(h > low).mean() + 0.5 * (h == low).mean() for h in high])


def test_learns_unknown_words_despite_wrong_labels(spark):
    docs, truth, labels = corpus(1200, 1)
    found = toxicity.judged(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in docs if fold(i)}
    assert auc({r.doc_id: r.score for r in held}, truth) > 0.99
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_held_out_labels_change_nothing(spark):
    docs, truth, labels = corpus(300, 2)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    other = [(i, 1 - x if fold(i) else x) for i, x in labels]
    models = [toxicity.fitted(frame, spark.createDataFrame(rows, "doc_id bigint, toxic int")) for rows in (labels, other)]
    assert models[0] == models[1]


def test_label_model_finds_accuracies_and_copies():
    draw = np.random.default_rng(3)
    y = draw.random(4000) < 0.2
    vote = lambda hit, miss: np.where(y, draw.random(4000) < hit, draw.random(4000) < miss).astype(int)
    good = [vote(0.8, 0.01), vote(0.7, 0.02), vote(0.75, 0.01)]
    bad = vote(0.3, 0.25)
    cast = np.column_stack([*good, *[bad] * 6, 2 * vote(0.9, 0.05) - 1])
    posterior, weight = toxicity.label_model(cast)
    assert np.allclose(weight[3:9], 1 / 6) and np.allclose(weight[:3], 1)
    assert ((posterior > 0.5) == y).mean() > 0.97


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, None)]])
def test_without_both_classes(spark, labels):
    docs = [(1, "all is well"), (2, None), (3, ""), (4, "you idiot"), (None, "moron " * 3), (4, "you idiot"), (5, "word " * 40_000)]
    frame = spark.createDataFrame([(*d, 1.0, 0) for d in docs], "doc_id bigint, text string, score double, toxic int")
    found = toxicity.judged(frame, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    assert sorted((r.doc_id, r.predicted) for r in found if r.doc_id) == [(1, 0), (2, 0), (3, 0), (4, 1), (4, 1), (5, 0)]
    assert toxicity.judged(frame.limit(0), spark.createDataFrame(labels, "doc_id bigint, toxic int")).count() == 0


def test_accepted_keeps_columns_and_repeats(spark):
    docs = [("x", 1, "all is well", None), ("x", 1, "all is well", None), ("y", 2, "you idiot", 1.0), ("z", None, None, 2.0)]
    frame = spark.createDataFrame(docs, "entry string, doc_id bigint, text string, score double")
    model = toxicity.fitted(frame, spark.createDataFrame([], "doc_id bigint, toxic int"))
    kept = toxicity.accepted(frame, model)
    assert kept.columns == frame.columns and sorted(map(tuple, kept.collect()), key=str) == sorted([d for d in docs if d[1] != 2], key=str)


def test_query(spark, sf_dir):
    found = {r.doc_id: r for r in QUERIES["op3_toxicity"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(found) == docs.count() and all(r.held_out == fold(i) for i, r in found.items())
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert auc({i: found[i].score for i in truth}, truth) > 0.8
    assert np.mean([found[i].predicted == truth[i] for i in truth]) > 0.95


def plain_label_model(votes, rounds=50):
    """The generative model in loops over rows and voters: shared voices, then rates of each vote given the class, then posteriors."""
    size, voters = len(votes), range(len(votes[0]))

    def voices(posterior, limit):
        toxic = [[v > 0 for v in row] for row in votes]
        shared = [[0.0 for _ in voters] for _ in voters]
        for p in (posterior, [1 - x for x in posterior]):
            total = max(sum(p), 1e-9)
            mean = [sum(w for w, row in zip(p, toxic, strict=True) if row[j]) / total for j in voters]
            for i in voters:
                for j in voters:
                    shared[i][j] += sum(w * (row[i] - mean[i]) * (row[j] - mean[j]) for w, row in zip(p, toxic, strict=True))
        found = []
        for i in voters:
            voice = 1.0
            for j in voters:
                if i != j:
                    c = shared[i][j] / math.sqrt(max(shared[i][i], 1e-9) * max(shared[j][j], 1e-9))
                    voice += min(c, 1.0) if c > limit else 0.0
            found.append(1 / voice)
        return found

    def fit(weight, posterior):
        for _ in range(rounds):
            prior = min(0.5, max(1e-3, sum(posterior) / size))
            rate = {}
            for j in voters:
                for v in (1, -1, 0):
                    yes = sum(p for p, row in zip(posterior, votes, strict=True) if row[j] == v)
                    no = sum(1 - p for p, row in zip(posterior, votes, strict=True) if row[j] == v)
                    rate[j, v] = math.log((yes + 0.1) / (sum(posterior) + 0.3)) - math.log((no + 0.1) / (size - sum(posterior) + 0.3))
            logits = [math.log(prior / (1 - prior)) + sum(weight[j] * rate[j, row[j]] for j in voters) for row in votes]
            after = [1 / (1 + math.exp(-max(-30.0, min(30.0, x)))) for x in logits]
            far = max(abs(a - b) for a, b in zip(after, posterior, strict=True))
            posterior = after
            if far < 1e-6:
                break
        return posterior

    weight = voices([1.0] * size, 0.9)
    lean = [sum(w for w, v in zip(weight, row, strict=True) if v > 0) - sum(w for w, v in zip(weight, row, strict=True) if v < 0) for row in votes]
    start = [0.9 if x > 0 else 0.1 if x < 0 else 0.5 for x in lean]
    weight = voices(fit(weight, start), toxicity.ALIKE)
    return fit(weight, start), weight


@pytest.mark.parametrize("seed", range(4))
def test_label_model_against_loops(seed):
    """Voters of different accuracy, one of them copied and one nearly so; equal rows once with their number give the same."""
    draw = random.Random(seed)
    votes = []
    for _ in range(120):
        truth = 1 if draw.random() < 0.3 else -1
        row = [0 if draw.random() < 0.4 else truth if draw.random() < right else -truth for right in (0.9, 0.8, 0.7, 0.6)]
        votes.append([*row, row[0], row[1] if draw.random() < 0.9 else 0])
    posterior, weight = toxicity.label_model(np.array(votes, np.int8))
    want, want_weight = plain_label_model(votes)
    assert posterior == pytest.approx(want, abs=1e-6) and weight == pytest.approx(want_weight, abs=1e-9)
    assert weight[0] < 0.7 and weight[4] < 0.7
    # Of voters without copies, whose sums have no rounding that could break a tie.
    own = [tuple(row[:4]) for row in votes]
    different = sorted(set(own))
    once, _ = toxicity.label_model(np.array(different, np.int8), np.array([own.count(v) for v in different]))
    want, _ = plain_label_model(own)
    assert dict(zip(different, once, strict=True)) == pytest.approx(dict(zip(own, want, strict=True)), abs=1e-6)


def test_redundant_beginnings_go_before_the_cut():
    texts = {"zar": 100, "zark": 95, "zarko": 90, "=zarkon": 85, "mor": 60, "=moron": 20, "=morse": 30}
    plain = [e for e in texts if e[0] == "=" or not any(o != e and o.removeprefix("=").startswith(e) and texts[o] >= toxicity.SAME * texts[e] for o in texts)]
    assert toxicity._most_specific(texts) == plain == ["=zarkon", "mor", "=moron", "=morse"]
