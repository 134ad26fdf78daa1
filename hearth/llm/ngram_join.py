"""N-gram Jaccard join by chosen paths.

Documents are sets of hashed word shingles; two documents are linked when the
Jaccard similarity of their sets is at least ``threshold``.  In each of
``runs`` independent runs a set chooses shared tokens by a common random
function, each with probability ``1 / (threshold * size)``: those are its first
nodes, and at every node it can choose again, ``DEPTH`` levels deep.  Similar
sets choose alike.  Bucket sizes decide how far down a branch is followed: a
node with at most ``LIMIT`` sets is a leaf, a larger one is split by the tokens
its sets choose next, and what is still large at the last level is compared in
blocks.  So no bucket is cut off.

A pair at the threshold meets at a first-level leaf of one run with
probability 1 - 1/e or more, and at a leaf of the third level with about 0.42,
so ``RUNS`` runs find it with probability over 0.9999 and 0.998; closer pairs
meet more surely.  Equal sets are joined by their digests, always.

Leaves are compared twice: byte sketches pick the sets that may have a partner
here, then these sets' shingles are brought and compared exactly.  A pair that
shares several leaves counts in the one with the smallest number only.  Tasks
give out link counts and spanning links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import U64, bound_batches, checkpointed, mix64, shuffle_partitions, signed, text_bytes

SHINGLE = 5
THRESHOLD = 0.8
RUNS = 12
DEPTH = 3
LIMIT = 128               # sets in a leaf
BLOCK = 256               # sets compared at once where a bucket stays large
SKETCH = 64
SKETCH_MATCHES = 36       # of SKETCH; a pair at 0.8 falls below with probability under 1e-5
LAST = (1 << 63) - 1      # the place of a document without an id: after all others
_SEEDS = np.arange(1, SKETCH + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)


def shingles(text: bytes, n: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of the runs of ``n`` words; a shorter text is one run."""
    words = text.lower().split()
    if not words:
        return np.empty(0, U64)
    w = mix64(np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words)), 4)
    n = min(n, len(words))
    h = np.zeros(len(w) - n + 1, U64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = h * U64(0x100000001B3) + w[k:k + len(h)]
    return np.unique(mix64(h, 5))


def digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def chosen(s: np.ndarray, nodes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The children of ``nodes`` that the set chooses: each one's parent (by place) and its number."""
    chance = 1.0 / (threshold * max(len(s), 1))
    drawn = mix64(s[None, :] ^ nodes[:, None], 7)
    parent, token = np.nonzero(drawn < U64(int(chance * 2.0 ** 64))) if chance < 1 else np.nonzero(np.ones(drawn.shape, bool))
    with np.errstate(over="ignore"):
        return parent, mix64(nodes[parent] + drawn[parent, token], 8) | U64(1)


def first_nodes(s: np.ndarray, runs: int, threshold: float) -> np.ndarray:
    """The set's nodes of the first level, over all runs."""
    return np.unique(chosen(s, mix64(np.arange(1, runs + 1, dtype=U64), 6), threshold)[1])


def branches(s: np.ndarray, nodes: np.ndarray, threshold: float) -> np.ndarray:
    """The set's branches below ``nodes``: a row of ``DEPTH - 1`` numbers each, 0 where it ends early."""
    done, above, at = [], np.empty((len(nodes), 0), U64), nodes
    for level in range(1, DEPTH):
        parent, at = chosen(s, at, threshold)
        if level > 1:
            ends = np.setdiff1d(np.arange(len(above)), parent)
            done.append(np.pad(above[ends], ((0, 0), (0, DEPTH - level))))
        above = np.hstack([above[parent], at[:, None]])
    return np.vstack([*done, above])


def _documents(docs: DataFrame) -> DataFrame:
    bound_batches(docs.sparkSession)
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
                       F.xxhash64("text").alias("th"), text_bytes().alias("body"))


def _parsed(shingle: int, runs: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, size, found = [], [], []
            for body in batch.column(2):
                s = shingles(body.as_py(), shingle)
                cls.append(digest(s))
                size.append(len(s))
                found.append(signed(first_nodes(s, runs, threshold)))
            yield pa.record_batch({
                "doc": batch.column(0), "th": batch.column(1), "cls": pa.array(cls, pa.binary()), "size": pa.array(size, pa.int32()),
                "nodes": _lists(found)})

    return run


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(a) for a in arrays])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int64), *arrays])))


def _short(s: np.ndarray) -> bytes:
    """A set's hashes, 48 bits of each."""
    return np.ascontiguousarray(s).view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _long(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.view(U64).ravel()


def _sets(shingle: int, threshold: float):
    """``cls, sketch, set, below`` of each representative; ``below``: its branches under the large nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches, sets, below = [], [], []
            for body, large in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                s = shingles(body.as_py(), shingle)
                low = np.full(SKETCH, ~U64(0))
                for i in range(0, len(s), 4096):
                    low = np.minimum(low, mix64(s[i:i + 4096][None, :] ^ _SEEDS[:, None]).min(1))
                sketches.append((low & U64(255)).astype(np.uint8).tobytes())
                sets.append(_short(s))
                below.append(signed(branches(s, np.array(large or [], np.int64).view(U64), threshold).ravel()))
            yield pa.record_batch({"cls": batch.column(0), "sketch": pa.array(sketches, pa.binary()), "set": pa.array(sets, pa.binary()),
                                   "below": _lists(below)})

    return run


def _groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[tuple]]:
    """Runs of rows with the same first ``width`` columns, in the order they come."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if rows and row[:width] != rows[0][:width]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _pairs(rows: list[tuple], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that this leaf block answers for and whose sizes and sketches allow a link."""
    bucket, bi, bj = rows[0][:3]
    sketch = np.frombuffer(b"".join(r[7] for r in rows), np.uint8).reshape(len(rows), SKETCH)
    size = np.array([r[5] for r in rows])
    block = np.array([r[8] for r in rows])
    leaves = [set(r[6]) for r in rows]
    left, right = [], []
    for i in range(len(rows) - 1):
        j = np.arange(i + 1, len(rows))
        ok = (sketch[i] == sketch[j]).sum(1) >= SKETCH_MATCHES
        ok &= np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j])
        if bi != bj:
            ok &= block[i] != block[j]
        for k in j[ok].tolist():
            if min(leaves[i] & leaves[k]) == bucket:
                left.append(i)
                right.append(k)
    return np.array(left, np.int64), np.array(right, np.int64)


_ROW = "bucket long, bi int, bj int, cls binary, copies long, size int, leaves array<long>, sketch binary, block int"


def _candidates(threshold: float):
    """Re-emits the rows that have a possible partner in their leaf block."""
    names = [c.split()[0] for c in _ROW.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in _groups(batches, 3):
            if len(rows) > 1:
                left, right = _pairs(rows, threshold)
                out += [rows[i] for i in np.union1d(left, right).tolist()]
            if len(out) > 2000:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                out = []
        if out:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return run


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The sizes of the intersections of the given pairs."""
    if len(left) <= 2 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(left, right, strict=True)])
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, col, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = times[col] > 1
    row, col = row[keep], np.unique(col[keep], return_inverse=True)[1]
    both = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for a in range(0, int(col[-1]) + 1 if len(col) else 0, 4096):     # a slice of the incidence matrix at a time
        part = slice(*np.searchsorted(col, [a, a + 4096]))
        m = np.zeros((len(sets), 4096), np.float32)
        m[row[part], col[part] - a] = 1
        both += m @ m.T
    return both[left, right].astype(np.int64)


def _links(threshold: float):
    """Per leaf block: each linked set with its partners' copies and the first set it hangs together with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, 3):
            left, right = _pairs(rows, threshold)
            if not len(left):
                continue
            size, copies = np.array([r[5] for r in rows]), np.array([r[4] for r in rows])
            shared = _shared([_long(r[9]) for r in rows], left, right)
            ok = shared >= threshold * (size[left] + size[right] - shared) - 1e-9
            left, right = left[ok], right[ok]
            n = np.zeros(len(rows), np.int64)
            np.add.at(n, left, copies[right])
            np.add.at(n, right, copies[left])
            root = list(range(len(rows)))

            def top(i, root=root):
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for i, j in zip(left.tolist(), right.tolist(), strict=True):
                a, b = sorted((top(i), top(j)))
                root[b] = a
            at = np.flatnonzero(n).tolist()
            if at:
                yield pa.record_batch({"cls": pa.array([rows[i][3] for i in at], pa.binary()), "links": pa.array(n[at]),
                                       "to": pa.array([rows[top(i)][3] for i in at], pa.binary())})

    return run


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``cls, label``: each node with the least label in its connected part.

    ``nodes``: ``cls, label``; ``edges``: ``a, b``.  Every round takes the
    least label among the neighbours and then that label's own label, as
    grouped minima with partial aggregation, until nothing changes; the rows
    stay distributed and each round is checkpointed.
    """
    edges = checkpointed(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct())
    labels = checkpointed(nodes.select("cls", "label", F.col("cls").alias("head")))
    while True:
        # the least label next door, carried with the node that owns it
        near = (edges.join(labels, F.col("b") == F.col("cls"))
                     .groupBy(F.col("a").alias("cls")).agg(F.min(F.struct("label", "head")).alias("m")))
        met = (labels.join(near, "cls", "left")
                     .select("cls", F.least(F.struct("label", "head"), F.coalesce("m", F.struct("label", "head"))).alias("m"), "label")
                     .select("cls", F.col("m.label").alias("label"), F.col("m.head").alias("head"), F.col("label").alias("was")))
        heads = met.select(F.col("cls").alias("_h"), F.col("label").alias("_l"), F.col("head").alias("_hh"))
        jumped = checkpointed(met.join(heads, F.col("head") == F.col("_h"), "left").select(
            "cls", F.least("label", F.coalesce("_l", "label")).alias("label"),
            F.when(F.col("_l") < F.col("label"), F.col("_hh")).otherwise(F.col("head")).alias("head"), "was"))
        if not jumped.where("label <> was").limit(1).count():
            return jumped.select("cls", "label")
        labels = jumped.select("cls", "label", "head")


def linked(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, runs: int = RUNS) -> DataFrame:
    """Every document row, without its text, with its group: ``doc, th, cls, first, n_links``.

    ``doc`` is the id (``LAST`` for null), ``th`` a hash of the text, ``cls``
    the digest of the shingle set, ``first`` the least ``(doc, th)`` of the
    group (the connected part under links), ``n_links`` the number of other
    rows linked to this one, copies included.
    """
    n_parts = shuffle_partitions(docs.sparkSession)
    rows = checkpointed(_documents(docs).mapInArrow(
        _parsed(shingle, runs, threshold), "doc long, th long, cls binary, size int, nodes array<long>"))
    classes = checkpointed(rows.groupBy("cls", "size").agg(
        F.min(F.struct("doc", "th")).alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("nodes").alias("nodes")))

    # first level: nodes of several sets are leaves, or large ones to be split
    at_first = classes.select("cls", F.explode("nodes").alias("bucket"))
    shared = at_first.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    met = checkpointed(at_first.join(shared, "bucket"))
    reps = classes.select("cls", "size", "rep", "copies").join(
        met.groupBy("cls").agg(F.collect_list(F.when(F.col("m") > LIMIT, F.col("bucket"))).alias("large")), "cls")

    # the sets that share a node: their sketches, their shingles and their branches below large nodes
    named = reps.select("cls", F.col("rep.doc").alias("_doc"), F.col("rep.th").alias("_th"), "large")
    one = Window.partitionBy("doc", "th").orderBy("doc", "th")
    sets = checkpointed(_documents(docs).join(named, (F.col("doc") == F.col("_doc")) & (F.col("th") == F.col("_th")))
                        .withColumn("_n", F.row_number().over(one)).where("_n = 1")     # equal rows: once
                        .select("cls", "body", "large").mapInArrow(_sets(shingle, threshold), "cls binary, sketch binary, set binary, below array<long>"))

    leaves = met.where(f"m <= {LIMIT}")
    width = DEPTH - 1
    open_ = (sets.where("size(below) > 0").select("cls", "below", F.expr(f"explode(sequence(0, size(below) div {width} - 1))").alias("i"))
                 .select("cls", *[F.expr(f"below[i * {width} + {k}]").alias(f"k{k + 1}") for k in range(width)]))
    for level in range(1, DEPTH):
        key, last = f"k{level}", level == DEPTH - 1
        here = open_.where(f"{key} <> 0").select(F.col(key).alias("bucket"), "cls").distinct()
        count = here.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        leaves = leaves.unionByName(here.join(count if last else count.where(f"m <= {LIMIT}"), "bucket").select(*leaves.columns))
        if not last:
            open_ = open_.join(count.where(f"m > {LIMIT}").select(F.col("bucket").alias(key)), key, "left_semi")
    leaves = checkpointed(leaves)
    reps = reps.drop("large").join(leaves.groupBy("cls").agg(F.sort_array(F.collect_set("bucket")).alias("leaves")), "cls")

    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    dealt = (leaves.join(reps.select("cls", "size", "copies", "leaves"), "cls").join(sets.select("cls", "sketch"), "cls")
                   .withColumn("block", F.pmod(F.xxhash64("cls"), blocks).cast("int"))
                   .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
                   .withColumn("bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other")))
    group = ["bucket", "bi", "bj"]
    columns = [c.split()[0] for c in _ROW.split(", ")]
    likely = (dealt.select(*columns).repartition(n_parts, *group).sortWithinPartitions(*group)
                   .mapInArrow(_candidates(threshold), _ROW))
    links = checkpointed(likely.join(sets.select("cls", "set"), "cls").select(*columns, "set")
                         .repartition(n_parts, *group).sortWithinPartitions(*group)
                         .mapInArrow(_links(threshold), "cls binary, links long, to binary"))

    counted = links.groupBy("cls").agg(F.sum("links").alias("links"))
    label = F.struct(F.col("rep.doc").alias("doc"), F.col("rep.th").alias("th"))
    parts = components(reps.join(counted, "cls").select("cls", label.alias("label")),
                       links.select(F.col("cls").alias("a"), F.col("to").alias("b")))
    found = (classes.select("cls", "size", "rep", "copies").join(counted, "cls", "left").join(parts, "cls", "left")
                    .select("cls", F.when(F.col("size") > 0, F.coalesce("label", "rep")).alias("first"),
                            F.when(F.col("size") > 0, F.col("copies") - 1 + F.coalesce("links", F.lit(0)))
                            .otherwise(F.lit(0)).alias("n_links")))
    return rows.select("doc", "th", "cls").join(found, "cls").select(
        "doc", "th", "cls", F.coalesce("first", F.struct("doc", "th")).alias("first"), "n_links")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, runs: int = RUNS) -> DataFrame:
    """Per document row: ``doc_id, class_id, n_links``.

    Words are runs of ASCII non-blanks with A-Z lower-cased; a text of fewer
    than ``shingle`` words is one shingle.  ``class_id`` is the least id of the
    group of documents hanging together by links, ``n_links`` the number of
    other rows with a similarity of at least ``threshold``, copies counted.
    Null and empty texts have no shingles and no links; null ids count as the
    last and keep a null class when alone; repeated rows are copies of each
    other; extra columns are ignored; an empty table gives no rows.
    """
    known = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return linked(docs, shingle, threshold, runs).select(
        known("doc").alias("doc_id"), known("first.doc").alias("class_id"), "n_links")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One document row of each group, the least id's; all columns kept.

    Rows without shingles are in no group and stay.  Of rows that are equal in
    id and text one stays, unless they have no shingles.
    """
    keep = (linked(docs, **options).where((F.col("first.doc") == F.col("doc")) & (F.col("first.th") == F.col("th")))
            .select(F.col("doc").alias("_doc"), F.col("th").alias("_th"), (F.col("cls") == F.lit(digest(np.empty(0, U64)))).alias("_empty"))
            .distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_at"), F.xxhash64("text").alias("_tx"))
    one = Window.partitionBy("_at", "_tx").orderBy("_at", "_tx")
    return (rows.join(keep, (F.col("_at") == F.col("_doc")) & (F.col("_tx") == F.col("_th")))
                .withColumn("_n", F.row_number().over(one)).where("_n = 1 OR _empty")
                .select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns]))
