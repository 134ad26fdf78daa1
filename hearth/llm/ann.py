"""Approximate nearest neighbours by cross-polytope hashing.

Three rounds of random signs and a fast Hadamard transform turn a unit vector
pseudo-randomly; the nearest signed axis (largest coordinate, with its sign)
is its hash.  A table's bucket is the nearest axes of several rotations: ``SPARE``
more than it takes to have no fewer buckets than rows.  A query scores a bucket
by the sum of its own coordinates on the bucket's axes and probes those of
the best scores in every table: the share ``probes`` of all of a table's
buckets, by a threshold the query carries.

Rows and probing queries meet in tasks grouped by the first axis; there only
the rows whose whole bucket passes the query's threshold are compared, in
double precision, and each group's ``k`` best distinct ids leave it; a last
merge keeps the best ``k`` of a query.

Both sides of a first axis are split into blocks (``block_rows`` rows,
``block_queries`` queries) that meet pair by pair, each pair its own group, so
no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import broadcast_if_small, checkpointed, stored

TABLES = 2
PROBES = 0.22           # of a table's buckets; see the README for recall
SPARE = 4               # rotations beyond those that tell the rows apart
BLOCK_ROWS = 1024
BLOCK_QUERIES = 4096
DRAWN = 4096            # buckets drawn to place a query's threshold
CHUNK = 64              # queries whose probes are laid out at a time
HIT = "query_id long, vec_id long, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """The unnormalised fast Hadamard transform of each row (a power of two wide)."""
    n, h = x.shape[1], 1
    x = x.copy()
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        a, b = y[:, :, 0, :] + y[:, :, 1, :], y[:, :, 0, :] - y[:, :, 1, :]
        x = np.stack([a, b], axis=2).reshape(len(x), n)
        h *= 2
    return x


def rotate(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Pseudo-random rotation ``H D3 H D2 H D1 x`` of unit vectors, padded to a power of two."""
    width = 1 << max(0, (x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), width))
    y[:, :x.shape[1]] = x
    rng = np.random.default_rng([seed, table, width])
    for _ in range(3):
        y = hadamard(y * rng.choice([-1.0, 1.0], width)) / np.sqrt(width)
    return y


def signed_axes(y: np.ndarray) -> np.ndarray:
    """Each row's coordinates on the signed axes: axis ``i`` is ``2i`` or, negative, ``2i+1``."""
    both = np.empty((len(y), 2 * y.shape[1]))
    both[:, 0::2], both[:, 1::2] = y, -y
    return both


def depth_for(n_rows: int, dim: int) -> int:
    """Rotations of a table: ``SPARE`` more than give it no fewer buckets than rows."""
    n_axes, depth = 2 << max(0, (dim - 1).bit_length()), 1
    while n_axes ** depth < n_rows:
        depth += 1
    return depth + SPARE


def coordinates(x: np.ndarray, table: int, depth: int, seed: int) -> list[np.ndarray]:
    """The signed coordinates of each row under the table's rotations."""
    x = x / np.abs(x).max(1, keepdims=True)      # no overflow in the norm
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [signed_axes(rotate(x, table * 64 + r, seed)) for r in range(depth)]


def thresholds(coords: list[np.ndarray], table: int, probes: float, seed: int) -> np.ndarray:
    """Each query's least score of a probed bucket: a quantile over ``DRAWN`` buckets, the same for all queries."""
    if probes >= 1:
        return np.full(len(coords[0]), -np.inf)
    rng = np.random.default_rng([seed, table, len(coords), 1])
    scores = sum(c[:, rng.integers(0, c.shape[1], DRAWN)] for c in coords)
    return np.quantile(scores, 1 - probes, axis=1)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, v``: vectors that are not null, not zero and hold only finite numbers; floats stay floats."""
    v = F.col(embedding) if dict(vectors.dtypes)[embedding] == "array<float>" else F.col(embedding).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
                   .where("vec_id IS NOT NULL AND v IS NOT NULL").where(finite & F.exists("v", lambda x: x != 0)))


def _by_width(batch: pa.RecordBatch, chunk: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``dim, positions, matrix`` of at most ``chunk`` rows: vectors of different width are never compared."""
    rows = batch.column(1).to_pylist()
    by_dim: dict[int, list[int]] = {}
    for i, r in enumerate(rows):
        by_dim.setdefault(len(r), []).append(i)
    for dim, at in by_dim.items():
        for lo in range(0, len(at), chunk):
            part = at[lo:lo + chunk]
            yield dim, np.array(part), np.array([rows[i] for i in part], np.float64)


def _type(vectors: DataFrame) -> str:
    return dict(vectors.dtypes)["v"]


def _hashed_rows(vectors: DataFrame, n_rows: int, tables: int, seed: int) -> DataFrame:
    """``dim, tab, bucket`` (the first axis), ``code`` (the others), ``vec_id, v``: one row per vector and table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in _by_width(batch, 4096):
                for t in range(tables):
                    hashes = np.stack([c.argmax(1) for c in coordinates(x, t, depth_for(n_rows, dim), seed)], 1).astype(np.int32)
                    yield pa.record_batch({
                        "dim": pa.array(np.full(len(at), dim, np.int32)), "tab": pa.array(np.full(len(at), t, np.int32)),
                        "bucket": pa.array(hashes[:, 0]), "code": pa.array(list(hashes[:, 1:]), pa.list_(pa.int32())),
                        "vec_id": batch.column(0).take(pa.array(at)), "v": batch.column(1).take(pa.array(at))})

    return vectors.mapInArrow(run, f"dim int, tab int, bucket int, code array<int>, vec_id long, v {_type(vectors)}")


def _hashed_queries(queries: DataFrame, n_rows: int, tables: int, probes: float, seed: int) -> DataFrame:
    """``dim, tab, bucket, least, vec_id, v``: one row per query, table and first axis with a bucket it probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in _by_width(batch, CHUNK):
                for t in range(tables):
                    coords = coordinates(x, t, depth_for(n_rows, dim), seed)
                    least = thresholds(coords, t, probes, seed)
                    q, axis = np.nonzero(coords[0] + sum(c.max(1) for c in coords[1:])[:, None] >= least[:, None])
                    pick = pa.array(at[q])
                    yield pa.record_batch({
                        "dim": pa.array(np.full(len(q), dim, np.int32)), "tab": pa.array(np.full(len(q), t, np.int32)),
                        "bucket": pa.array(axis.astype(np.int32)), "least": pa.array(least[q]),
                        "vec_id": batch.column(0).take(pick), "v": batch.column(1).take(pick)})

    return queries.mapInArrow(run, f"dim int, tab int, bucket int, least double, vec_id long, v {_type(queries)}")


def _probed(n_rows: int, seed: int):
    """Which rows of a group lie in buckets that a query of the group probes: a matrix, queries by rows."""

    def run(queries: pd.DataFrame, q: np.ndarray, rows: pd.DataFrame) -> np.ndarray:
        table, first = int(queries.tab.iloc[0]), int(queries.bucket.iloc[0])
        coords = coordinates(q, table, depth_for(n_rows, q.shape[1]), seed)
        code = np.stack(rows.code.to_list())
        score = coords[0][:, [first]] + sum(c[:, code[:, i]] for i, c in enumerate(coords[1:]))
        return score >= queries.least.to_numpy()[:, None]

    return run


def _best(k: int, probed=None):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})]
        if queries.empty or rows.empty:
            return out[0]
        rows = rows.sort_values("vec_id")
        row_ids = rows.vec_id.to_numpy()
        x, q = np.stack(rows.v.to_list()).astype(np.float64), np.stack(queries.v.to_list()).astype(np.float64)
        for lo in range(0, len(q), CHUNK):
            part = slice(lo, lo + CHUNK)
            mask = None if probed is None else probed(queries.iloc[part], q[part], rows)
            for i, (query_id, v) in enumerate(zip(queries.vec_id.to_numpy()[part], q[part], strict=True)):
                at = np.flatnonzero(row_ids != query_id if mask is None else mask[i] & (row_ids != query_id))
                if not len(at):
                    continue
                ids = row_ids[at]
                first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
                d = np.minimum.reduceat(np.sqrt(((x[at] - v) ** 2).sum(1)), first)      # an id counts once, at its nearest row
                ids = ids[first]
                near = np.arange(len(d)) if len(d) <= k else np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
                near = near[np.lexsort((ids[near], d[near]))][:k]
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[near], "score": d[near]}))
        return pd.concat(out[1:]) if len(out) > 1 else out[0]

    return run


def _blocks(hashed: DataFrame, size: int, name: str) -> DataFrame:
    """The number of blocks of every first axis and table; at most two rows per dimension and table."""
    counted = (hashed.groupBy("dim", "tab", "bucket").agg(F.count(F.lit(1)).alias("n"))
                     .select("dim", "tab", "bucket", F.ceil(F.col("n") / size).cast("int").alias(name)))
    return broadcast_if_small(checkpointed(counted))


def _search(queries: DataFrame, vectors: DataFrame, n_rows: int, k: int, tables: int, probes: float, block_rows: int,
            block_queries: int, seed: int) -> DataFrame:
    rows, probing = _hashed_rows(vectors, n_rows, tables, seed), _hashed_queries(queries, n_rows, tables, probes, seed)
    key = ["dim", "tab", "bucket"]
    n_row_blocks, n_query_blocks = _blocks(rows, block_rows, "row_blocks"), _blocks(probing, block_queries, "query_blocks")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        """A row goes to the one block of its side, and to every block of the other."""
        return (side.join(n_row_blocks, key).join(n_query_blocks, key)
                    .withColumn(own, F.pmod(F.xxhash64("vec_id", "v"), F.col(f"{own}s")).cast("int"))
                    .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))))

    group = [*key, "row_block", "query_block"]
    rows = dealt(rows, "row_block", "query_block").select(*group, "code", "vec_id", "v")
    probing = dealt(probing, "query_block", "row_block").select(*group, "least", "vec_id", "v")
    return probing.groupBy(*group).cogroup(rows.groupBy(*group)).applyInPandas(_best(k, _probed(n_rows, seed)), HIT)


def _merged(hits: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (hits.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
                .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, tables: int = TABLES, probes: float = PROBES,
            block_rows: int = BLOCK_ROWS, seed: int = 11, vec_id: str = "vec_id", embedding: str = "embedding",
            block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` found for each row of ``queries``.

    Nearness is the Euclidean distance of the original vectors, in double
    precision; ties go to the smaller id.  Returns ``query_id, rank`` (from 1),
    ``vec_id, score``.  A row with the query's own id is no candidate.
    ``probes`` is the share of each table's buckets that a query probes (all
    from 1 on).  Vectors that are null, zero or hold null or non-finite
    components, and rows without an id, take no part; vectors of another width
    than the query's are no candidates; rows that repeat an id count once, at
    their nearest.  Other columns are ignored; empty tables give no rows.

    Queries that found fewer than ``k`` rows (tiny tables) are searched again
    with every bucket of one table, which is all candidates.
    """
    # equal rows are one, so that a repeated row fills no block; an id's different vectors may go to several
    rows = stored(usable(vectors, vec_id, embedding).distinct(), "vectors")
    asked = usable(queries, vec_id, embedding).distinct()
    n_rows = rows.count()
    hits = _search(asked, rows, n_rows, k, tables, probes, block_rows, block_queries, seed)
    found = checkpointed(_merged(hits, k))        # read twice
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = checkpointed(asked.join(full, "vec_id", "left_anti"))
    if not short.count():
        return found
    again = _merged(_search(short, rows, n_rows, k, 1, 1.0, block_rows, block_queries, seed), k)
    return found.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(again)
