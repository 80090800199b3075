"""MinHash near-dedup with BagMinHash: weighted Jaccard similarity of multisets of five-word shingles.

Signature. Over time and the weight axis of a shingle runs a Poisson process; a point has a time, a weight
between 0 and infinity and one of the signature's components. A document with weight w of
the shingle sees the points below w, and a component is the earliest point seen. Two documents share it with
the probability of their weighted Jaccard similarity. The weight axis is a hierarchy of
intervals [0, 1), [1, 2), [2, 4), [4, 8), ..., each with a process of its own, so weight w costs log2(w) processes
and not w. Points are made in order of time, only up to the time by which all components
of the document are almost surely set; the few documents for which that is too early get twice the time.

Search. Equal texts are one class from the start. Signatures are cut into bands; a bucket is the
classes that share a band. In each round all members of a bucket are compared with one of them, its centre
(in the next round with a few more, and only with what is not connected yet). What is then still apart within a bucket is
joined on the shingles that few of these texts have, with bounds on the overlap that leave out no
similar pair. So a bucket of thousands of near copies costs thousands of comparisons, and no
link that would connect two components is lost. Comparisons are exact: multiset overlap
at ``SIMILARITY`` or more. Connected classes form a group.

Misses: at similarity 0.8 all 25 bands of 5 differ with probability 5e-5; at 0.9, 2e-10.

Words are what stands between ASCII white space, case matters. Defined cases: a text without words is similar only to
equal texts; a NULL text is a group of its own; the member that stays is the one
with the least id (a NULL id last; of equal ids the text with the lesser MD5); rows that
repeat with id and text are one member; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrid.llm.batches import in_small_batches
from daygrid.llm.shingles import HASHES, bags, mix, shingles, text_blocks, uniform
from daygrid.sizing import broadcast_within, row_bound, stored

SIMILARITY = 0.8
BANDS, ROWS = 25, 5
CENTRE_ROUNDS = 2
# Centres of a bucket in each round after the first.
CENTRES = 6
# A shingle that more of the compared texts have is common.
RARE = 32
# Bytes of text that a task works on at a time (a longer text alone).
BLOCK_BYTES = 500_000

_STEP, _PART, _WEIGHT, _LEVEL = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def bag_minhash(code: np.ndarray, weight: np.ndarray, doc: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures of ``n`` documents: times of the earliest points, by document and component (infinite without shingles)."""
    signature = np.full(n * m, np.inf)
    if len(code):
        level = [np.zeros(len(code), np.int64)]
        element = [np.arange(len(code))]
        for k in range(1, int(weight.max()).bit_length() + 1):
            more = np.flatnonzero(weight > 2 ** (k - 1))
            element.append(more)
            level.append(np.full(len(more), k))
        element, level = np.concatenate(element), np.concatenate(level)
        low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
        width = np.where(level > 0, low, 1.0)
        seed = mix(code[element] + level.astype(np.uint64) * _LEVEL)
        until = (math.log(m) + 3) / np.maximum(np.bincount(doc, weights=weight, minlength=n), 1)
        filled = np.bincount(doc, minlength=n) == 0
        where = doc[element]
        while len(seed):
            _earliest(signature, seed, low, width, weight[element].astype(float), where, until[where], m)
            filled |= np.isfinite(signature.reshape(n, m)).all(axis=1)
            open_ = ~filled[where]
            seed, low, width, element, where = (x[open_] for x in (seed, low, width, element, where))
            until *= 2
    return signature.reshape(n, m)


def _earliest(signature: np.ndarray, seed: np.ndarray, low: np.ndarray, width: np.ndarray, weight: np.ndarray, doc: np.ndarray, until: np.ndarray, m: int) -> None:
    """Lower ``signature`` to the points of each process up to its time limit."""
    time = np.zeros(len(seed))
    while len(seed):
        seed = seed + _STEP
        draw = mix(seed)
        time = time - np.log(uniform(draw)) / (m * width)
        live = np.flatnonzero(time <= until)
        seed, low, width, weight, doc, until, time, draw = (x[live] for x in (seed, low, width, weight, doc, until, time, draw))
        seen = low + width * uniform(mix(draw ^ _WEIGHT)) < weight
        part = (mix(draw ^ _PART) % np.uint64(m)).astype(np.int64)
        np.minimum.at(signature, (doc * m + part)[seen], time[seen])


def bands_of(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One number for each document and band."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(-1, bands, rows)
    found = np.arange(bands, dtype=np.uint64) * _LEVEL + np.zeros((len(bits), 1), np.uint64)
    for k in range(rows):
        found = mix(found * _STEP + bits[:, :, k])
    return found.view(np.int64)


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, digest, bands`` of each row; no digest for a NULL text, no bands for one without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, own in text_blocks(batch.column(1), BLOCK_BYTES):
                code, weight, doc = shingles(own)
                keys = bands_of(bag_minhash(code, weight, doc, len(own), bands * rows), bands, rows)
                has = np.bincount(doc, minlength=len(own)) > 0
                offsets = np.concatenate([[0], np.cumsum(np.where(has, bands, 0))])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[has].ravel()))
                missing = batch.column(1).slice(first, len(own)).is_null().to_pylist()
                digests = pa.array([None if none else hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t, none in zip(own, missing, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(own)), digests, lists], names=["doc_id", "digest", "bands"])
                del code, weight, doc, keys, own, lists, digests
        HASHES.clear()  # the worker lives on

    return in_small_batches(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))).mapInArrow(sign, "doc_id bigint, digest binary, bands array<bigint>")


def bagged(docs: DataFrame) -> DataFrame:
    """``node, bag`` from ``node, text``."""

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, own in text_blocks(batch.column(1), BLOCK_BYTES):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(own)), pa.array(bags(own), pa.list_(pa.int64()))], names=["node", "bag"])
        HASHES.clear()

    return in_small_batches(docs.select("node", "text")).mapInArrow(bag, "node bigint, bag array<bigint>")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``a, b`` pairs; a component is its least node."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), small=True)
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).select("node", F.least("node", "component").alias("component")), small=True)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        # Then each label gives way to its own label, which halves long chains.
        after = lower.join(labels.select(F.col("node").alias("new"), F.col("component").alias("far")), "new", "left")
        found = stored(after.select("node", "old", F.least("new", F.coalesce("far", "new")).alias("component")), small=True)
        changed = not found.where("old <> component").isEmpty()
        labels = found.select("node", "component")
        if not changed:
            return labels


def verified(pairs: DataFrame, bag: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose multisets of shingles are similar enough."""
    left, right = bag.select(F.col("node").alias("a"), F.col("bag").alias("bag_a")), bag.select(F.col("node").alias("b"), F.col("bag").alias("bag_b"))
    both = F.size(F.array_intersect("bag_a", "bag_b"))
    joined = pairs.join(left, "a").join(right, "b").withColumn("both", both)
    return joined.where(F.col("both") >= similarity * (F.size("bag_a") + F.size("bag_b") - F.col("both"))).select("a", "b")


def links(docs: DataFrame, classes: DataFrame, similarity: float = SIMILARITY, rounds: int = CENTRE_ROUNDS) -> DataFrame | None:
    """Pairs ``a, b`` of classes that connect all similar ones; None without candidates.

    ``classes``: ``node, digest, bands``.
    """
    keys = classes.select("node", F.posexplode("bands").alias("band", "key"))
    full = keys.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    members = stored(keys.join(full, ["band", "key"]).select("node", F.xxhash64("band", "key").alias("bucket")), small=True)
    nodes = stored(members.select("node").distinct(), small=True)
    bound = row_bound(nodes)
    if bound == 0:
        return None
    wanted = stored(classes.join(broadcast_within(nodes, bound), "node").select("node", "digest"), small=True)
    # Of equal texts any is as good, so one row of each is enough.
    texts = docs.select(_digest(F.col("text")).alias("digest"), "text").join(broadcast_within(wanted, bound), "digest")
    bag = stored(bagged(texts.groupBy("node").agg(F.first("text").alias("text"))))
    # The most typical member of a bucket is the one that shares buckets with most others.
    shared = members.join(members.groupBy("bucket").agg(F.count("*").alias("n")), "bucket")
    sizes = bag.select("node", F.size("bag").alias("size"))
    known = stored(shared.groupBy("node").agg(F.sum("n").alias("shared")).join(sizes, "node"), small=True)
    edges, labels = None, known.select("node", F.col("node").alias("component"))
    for k in range(rounds + 1):
        placed = members.join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
        placed = stored(placed.join(known, "node"), small=True)
        parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
        mixed = parts.groupBy("bucket").agg(F.count("*").alias("parts"), F.max(F.struct("n", "component"))["component"].alias("main")).where("parts > 1")
        mixed = stored(mixed.select("bucket", "main"), small=True)
        if k < rounds:
            # First the most typical member of each bucket is the centre, then the next ones are.
            rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.col("shared").desc(), "node"))
            open_ = placed.join(mixed, "bucket")
            centres = open_.withColumn("rank", rank).where(F.col("rank") <= (CENTRES if k else 1))
            centres = centres.select("bucket", *(F.col(c).alias(f"{c}_c") for c in ("node", "component", "size")))
            # Sets of very different sizes cannot be similar.
            alike = F.least("size", "size_c") >= similarity * F.greatest("size", "size_c")
            pairs = open_.join(centres, "bucket").where((F.col("component") != F.col("component_c")) & alike).select(F.col("node_c").alias("a"), F.col("node").alias("b"))
        else:
            pairs = _apart(placed.join(mixed, "bucket"), bag, similarity)
        pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), small=True)
        if pairs.isEmpty() and mixed.isEmpty():
            break
        found = verified(pairs, bag, similarity)
        edges = stored(found if edges is None else edges.union(found), small=True)
        labels = components(edges)
    return edges


def _apart(placed: DataFrame, bag: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``a, b`` of members of a bucket that are in different components and could be similar.

    ``placed``: ``bucket, node, component, main``, the last the largest component of the bucket. A shingle that more than ``RARE``
    of these nodes have is common. Similar nodes of sizes m and n share s * (m + n) / (1 + s) members or more, which is at most the rare
    ones they share and the common ones of the one that has fewer. So a pair either shares
    a rare shingle, and is found by a join on these, or both have common ones enough; the others need no look.
    """
    placed = stored(placed, small=True)
    nodes = placed.select("node", "component").distinct()
    members = stored(bag.join(nodes, "node").select("node", "component", F.size("bag").alias("n"), F.explode("bag").alias("member")))
    often = members.groupBy("member").agg(F.count("*").alias("holders")).where("holders > 1")
    held = stored(members.join(often, "member"))
    common = held.where(F.col("holders") > RARE).groupBy("node").agg(F.count("*").alias("common"))
    sizes = stored(members.select("node", "component", "n").distinct().join(common, "node", "left").fillna(0, ["common"]), small=True)
    share = similarity / (1 + similarity)
    left, right = (sizes.select(*(F.col(c).alias(f"{c}_{side}") for c in sizes.columns)) for side in "ab")
    needed = share * (F.col("n_a") + F.col("n_b")) - F.least("common_a", "common_b")
    rare = held.where(F.col("holders") <= RARE).select("member", "node", "component")
    other = rare.select("member", F.col("node").alias("node_b"), F.col("component").alias("component_b"))
    sharing = rare.join(other, "member").where("node < node_b AND component <> component_b").groupBy(F.col("node").alias("node_a"), "node_b").agg(F.count("*").alias("both"))
    first = sharing.join(left, "node_a").join(right, "node_b").where(F.col("both") >= needed)
    # Of two components one is not the largest.
    able = placed.join(sizes.select("node", "n", "common"), "node").where(F.col("common") >= share * (1 + similarity) * F.col("n"))
    able = able.join(placed.groupBy("node").agg(F.collect_set("bucket").alias("buckets")), "node")  # one for each band at most
    # Sizes of similar nodes are in the same class or the next, so a bucket is met class by class.
    able = able.withColumn("class", F.floor(F.log("n") / math.log(1 / similarity)).cast("int"))
    columns = [*sizes.columns, "buckets"]
    near = F.explode(F.array(*[F.col("class") + k for k in (-1, 0, 1)])).alias("class")
    one = able.where("component <> main").select("bucket", near, *(F.col(c).alias(f"{c}_a") for c in columns))
    two = able.select("bucket", "class", *(F.col(c).alias(f"{c}_b") for c in columns))
    # A pair that shares several buckets is looked at in one of them.
    here = F.array_min(F.array_intersect("buckets_a", "buckets_b")) == F.col("bucket")
    alike = F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b")
    second = one.join(two, ["bucket", "class"]).where(alike & (F.col("component_a") != F.col("component_b")) & (needed <= 0) & here)
    return first.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).union(second.select("node_a", "node_b"))


def groups(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, digest, class_id, class_digest`` of each row of ``docs`` (``doc_id, text``).

    The class is named by id and digest of the member that stays.
    """
    rows = stored(signed(docs))
    member = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest"))
    classes = stored(rows.where("digest IS NOT NULL").groupBy("digest").agg(F.first("bands").alias("bands"), member.alias("first")).withColumn("node", F.monotonically_increasing_id()))
    edges = links(docs, classes, similarity)
    own = classes.select("digest", "node", "first")
    if edges is None:
        named = own.select("digest", F.col("first").alias("stays"))
    else:
        labelled = own.join(components(edges), "node", "left").select("digest", "first", F.coalesce("component", "node").alias("component"))
        best = labelled.groupBy("component").agg(F.min("first").alias("stays"))
        named = labelled.join(best, "component").select("digest", "stays")
    named = named.select("digest", F.col("stays.doc_id").alias("class_id"), F.col("stays.digest").alias("class_digest"))
    null = rows.where("digest IS NULL").select("doc_id", "digest", F.col("doc_id").alias("class_id"), F.col("digest").alias("class_digest"))
    return rows.where("digest IS NOT NULL").join(named, "digest").select("doc_id", "digest", "class_id", "class_digest").unionByName(null)


def stays() -> Column:
    """Of the result of ``groups``: whether the row is the member that stays."""
    return F.col("doc_id").eqNullSafe(F.col("class_id")) & F.col("digest").eqNullSafe(F.col("class_digest"))


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` for each group; all columns stay. Rows that repeat with id and text leave one, with the least other columns."""
    found = stored(groups(docs.select("doc_id", "text"), similarity).where("digest IS NOT NULL"), small=True)
    counted = found.groupBy("doc_id", "digest").agg(F.count("*").alias("n"), F.max(stays()).alias("kept"))
    gone = counted.where("NOT kept").select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone"))
    gone = stored(gone, small=True)
    match = F.col("own.doc_id").eqNullSafe(F.col("other.gone_id")) & (_digest(F.col("own.text")) == F.col("other.gone"))
    left = docs.alias("own").join(broadcast_within(gone, row_bound(gone)).alias("other"), match, "left_anti")
    twice = stored(counted.where("kept AND n > 1").select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone")), small=True)
    if twice.isEmpty():
        return left
    repeated = left.alias("own").join(twice.alias("other"), match, "left_semi")
    names = [c for c in docs.columns if c not in ("doc_id", "text")]
    once = repeated.groupBy("doc_id", "text").agg(F.min(F.struct(*names)).alias("rest")).select("doc_id", "text", "rest.*") if names else repeated.distinct()
    return left.alias("own").join(twice.alias("other"), match, "left_anti").unionByName(once.select(*docs.columns))
