"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item meet through shared seeds (runs of
``min_match`` equal tokens).  Each such pair is tiled: running Karp-Rabin
finds the longest matches between unmarked tokens, the longest are marked
first, and the search length falls until no match of ``min_match`` tokens is
left.  Tiles never overlap and may come in any order, so a passage whose parts
were moved about is still covered.  An item leaks into a document when the
tiles cover at least ``threshold`` of the item's tokens.

A benchmark of at most ``BLOCK_BYTES`` of text is sent to the documents, which
stay where they are: no document is shuffled, and a passage that a third of all
documents share costs each of them one tiling.  A larger one is never sent whole:
the distinct texts' seeds are sifted by a Bloom filter of the benchmark's seeds,
of bounded size, and only those that pass are dealt by seed to meet the items.
Pairs that share too few seeds to reach the threshold go; the others are tiled.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from hearth.llm.common import BROADCAST_ROWS, U64, bound_batches, mix64, signed, stored
from hearth.llm.url_filter import BROADCAST_BYTES, bloom_blocks, filter_blocks_for, filter_bytes, sifted

MIN_MATCH = 5
THRESHOLD = 0.6
BLOCK_BYTES = 8 << 20      # benchmark text sent to the tasks at once
_TOKEN = re.compile(r"\w+")
_BASE = 0x100000001B3

LEAK = StructType([StructField("item_id", LongType()), StructField("coverage", DoubleType()), StructField("tiles", LongType())])
_ARROW_LEAK = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.int64())]))


def tokens(text: str) -> list[str]:
    """Lower-cased runs of word characters."""
    return _TOKEN.findall(text.lower())


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` token ids (Karp-Rabin polynomial, mixed)."""
    h = np.zeros(max(len(ids) - n + 1, 0), U64)
    with np.errstate(over="ignore"):
        for k in range(n if len(h) else 0):
            h = h * U64(_BASE) + ids[k:k + len(h)].astype(U64)
    return mix64(h)


def tile(pattern: list[int], text: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(pattern start, text start, length)`` of at least ``min_match`` tokens.

    Equal lengths are marked in order of pattern, then text position.
    """
    p_free, t_free = [True] * len(pattern), [True] * len(text)
    tiles: list[tuple[int, int, int]] = []
    length = max(min_match, min(len(pattern), len(text)))
    while True:
        queue = [(-n, i, j) for n, i, j in _scan(pattern, text, p_free, t_free, length)]
        heapq.heapify(queue)
        while queue:
            n, i, j = heapq.heappop(queue)
            free = [p_free[i + k] and t_free[j + k] for k in range(-n)]
            if all(free):
                p_free[i:i - n] = t_free[j:j - n] = [False] * -n
                tiles.append((i, j, -n))
                continue
            # a longer tile has taken a part: the rest queues up at its own length
            k = 0
            for is_free, run in groupby(free):
                size = len(list(run))
                if is_free and size >= length:
                    heapq.heappush(queue, (-size, i + k, j + k))
                k += size
        if length <= min_match:
            return tiles
        length = max(min_match, length // 2)


def _scan(pattern, text, p_free, t_free, length) -> list[tuple[int, int, int]]:
    """The maximal matches ``(length, i, j)`` of at least ``length`` free tokens, by running Karp-Rabin."""
    at = defaultdict(list)
    for j, h in _running(text, t_free, length):
        at[h].append(j)
    found = []
    for i, h in _running(pattern, p_free, length):
        for j in at.get(h, ()):
            if i and j and p_free[i - 1] and t_free[j - 1] and pattern[i - 1] == text[j - 1]:
                continue                # inside a match that starts earlier
            n = 0
            while (i + n < len(pattern) and j + n < len(text) and p_free[i + n] and t_free[j + n]
                   and pattern[i + n] == text[j + n]):
                n += 1
            if n >= length:             # also verifies the hash
                found.append((n, i, j))
    return found


def _running(seq, free, length):
    """(start, hash) of every window of ``length`` free tokens; the hash is rolled."""
    top, mask = pow(_BASE, length - 1, 1 << 64), (1 << 64) - 1
    h = run = 0
    for k, x in enumerate(seq):
        if not free[k]:
            h = run = 0
            continue
        if run == length:
            h = (h - seq[k - length] * top) & mask
            run -= 1
        h = (h * _BASE + x) & mask
        run += 1
        if run == length:
            yield k - length + 1, h


class Index:
    """One block of the benchmark: token ids, and the items behind every seed."""

    def __init__(self, items: list[tuple[int | None, str]], min_match: int):
        self.min_match = min_match
        self.vocab: dict[str, int] = {}
        self.items: list[tuple[int | None, list[int]]] = []
        seeds: dict[int, set[int]] = defaultdict(set)
        for item_id, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in tokens(text)]
            if len(ids) < min_match:
                continue
            for h in window_hashes(np.array(ids, np.int64), min_match).tolist():
                seeds[h].add(len(self.items))
            self.items.append((item_id, ids))
        self.seed_hashes = np.array(sorted(seeds), U64)
        self.seed_items = [sorted(seeds[h]) for h in self.seed_hashes.tolist()]

    def leaks(self, text: str, threshold: float) -> list[dict]:
        if not len(self.seed_hashes):
            return []
        get = self.vocab.get
        ids = np.array([get(w, 0) for w in tokens(text)], np.int64)
        hashes = window_hashes(ids, self.min_match)
        at = np.searchsorted(self.seed_hashes, hashes)
        at[at == len(self.seed_hashes)] = 0
        starts = np.flatnonzero(self.seed_hashes[at] == hashes)
        if not len(starts):
            return []
        by_item: dict[int, list[int]] = defaultdict(list)
        for s in starts.tolist():
            for item in self.seed_items[at[s]]:
                by_item[item].append(s)
        out = []
        for item, where in by_item.items():
            item_id, pattern = self.items[item]
            tiles = tile(pattern, self._runs(ids, where), self.min_match)
            coverage = sum(n for _, _, n in tiles) / len(pattern)
            if coverage >= threshold:
                out.append({"item_id": item_id, "coverage": coverage, "tiles": len(tiles)})
        return sorted(out, key=lambda x: (x["item_id"] is None, x["item_id"] or 0))

    def _runs(self, ids: np.ndarray, where: list[int]) -> list[int]:
        """The document's tokens under the item's seeds; unequal separators stand for the rest."""
        out, end = [], 0
        for s in where:
            if s > end or not out:
                out.append(-len(out) - 1)
                end = s
            out.extend(ids[end:s + self.min_match].tolist())
            end = s + self.min_match
        return out


def _seeds_of(min_match: int, min_share: float):
    """Task: ``(key, text)`` to ``key, seed, n`` (the seed's places in the text) and ``least``: the places
    that a text of this length must share for tiles over ``min_share`` of it, as a tile of ``n`` tokens has
    ``n - min_match + 1`` places, at least a ``min_match``-th of its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, int] = {}
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = []
                for w in tokens(text):
                    h = known.get(w)
                    if h is None:
                        h = known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
                    ids.append(h)
                seeds, n = np.unique(window_hashes(np.array(ids, U64), min_match), return_counts=True)
                least = max(1, int(np.ceil(min_share * len(ids) / min_match - 1e-9)))
                yield pa.record_batch({"key": pa.array([key] * len(seeds), pa.string()), "seed": pa.array(signed(seeds)),
                                       "n": pa.array(n.astype(np.int64)), "least": pa.array(np.full(len(seeds), least, np.int64))})

    return run


def _tiled(min_match: int, threshold: float):
    """Task: pairs ``(key, item_key, text, item_text)`` to the tiling of those that reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, item_key, text, item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += [(key, item_key, x["coverage"], x["tiles"]) for x in Index([(None, item)], min_match).leaks(text, threshold)]
            yield pa.record_batch({name: pa.array([r[i] for r in out], kind) for i, (name, kind) in enumerate(
                [("key", pa.string()), ("item_key", pa.string()), ("coverage", pa.float64()), ("tiles", pa.int64())])})

    return run


def _leaks_by_text(docs: DataFrame, items: DataFrame, min_match: int, threshold: float) -> DataFrame:
    """``key`` (the MD5 of a text), ``item_id, coverage, tiles``, through a join on shared seeds."""
    texts = docs.select(F.md5("text").alias("key"), F.col("text").cast("string").alias("text")).where("text != ''").dropDuplicates(["key"])
    wanted = items.select(F.md5("text").alias("key"), "text").dropDuplicates(["key"])
    seeds = "key string, seed long, n long, least long"
    item_seeds = stored(wanted.mapInArrow(_seeds_of(min_match, threshold), seeds)
                              .select(F.col("key").alias("item_key"), "seed", "n", "least"), "benchmark-seeds")
    n_seeds = item_seeds.agg(F.count_distinct("seed")).first()[0]          # one number
    n_blocks = min(filter_blocks_for(n_seeds), BROADCAST_BYTES // filter_bytes(1))     # past it the filter lets more through
    blocks = F.broadcast(bloom_blocks(item_seeds, "seed", n_blocks))
    met = sifted(texts.mapInArrow(_seeds_of(min_match, threshold), seeds).select("key", "seed"), blocks, "seed", n_blocks)
    pairs = (met.join(item_seeds, "seed").groupBy("key", "item_key").agg(F.sum("n").alias("n"), F.first("least").alias("least"))
                .where("n >= least").select("key", "item_key"))
    tiling = (pairs.join(texts, "key").join(wanted.select(F.col("key").alias("item_key"), F.col("text").alias("item_text")), "item_key")
                   .select("key", "item_key", "text", "item_text")
                   .mapInArrow(_tiled(min_match, threshold), "key string, item_key string, coverage double, tiles long"))
    return tiling.join(items.select(F.md5("text").alias("item_key"), "item_id"), "item_key").select("key", "item_id", "coverage", "tiles")


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD,
               block_bytes: int = BLOCK_BYTES, column: str = "leaks") -> DataFrame:
    """Every document row with the benchmark items that leak into it.

    Adds ``column``: an array of ``item_id, coverage`` (share of the item's
    tokens under tiles) and ``tiles``, by item; empty for a clean document.
    All other columns of ``docs`` stay as they are; ``column`` must not be one
    of them.  Null and empty texts are clean; repeated rows are each judged;
    null, empty and repeated items: an item of fewer than ``min_match`` tokens
    is never found, equal items are each reported; an empty table on either
    side is fine.  A benchmark of more than ``block_bytes`` of text takes the
    join on shared seeds, with the same result.
    """
    if column in docs.columns:
        raise ValueError(f"the documents already have a column {column!r}")
    bound_batches(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    if (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > block_bytes:
        return _with_leaks(docs, _leaks_by_text(docs, items, min_match, threshold), column)
    out = docs.withColumn(column, F.array().cast(ArrayType(LEAK)))
    text_at, schema = docs.columns.index("text"), out.schema
    sent = docs.sparkSession.sparkContext.broadcast([(r[0], r[1]) for r in items.collect()])   # at most block_bytes of text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(sent.value, min_match)
        for batch in batches:
            found = [index.leaks(text, threshold) if text else [] for text in batch.column(text_at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, _ARROW_LEAK)], names=batch.schema.names)

    return out.mapInArrow(run, schema)


def _with_leaks(docs: DataFrame, leaks: DataFrame, column: str) -> DataFrame:
    """The documents with the leaks of their text; sent to them while there are few, counted once written."""
    leaks = stored(leaks, "leaks")
    order = F.struct(F.col("item_id").isNull().alias("null"), "item_id", "coverage", "tiles")
    grouped = leaks.groupBy(F.col("key").alias("_leak_key")).agg(F.transform(
        F.array_sort(F.collect_list(order)), lambda x: F.struct(x["item_id"].alias("item_id"), x["coverage"].alias("coverage"),
                                                                x["tiles"].alias("tiles"))).alias(column))
    if leaks.count() <= BROADCAST_ROWS:
        grouped = F.broadcast(grouped)          # a key and three numbers a row
    key = "_leak_key"
    return (docs.join(grouped, F.md5(docs["text"]) == F.col(key), "left")
                .select(*[docs[f"`{c}`"] for c in docs.columns],
                        F.coalesce(grouped[column], F.array().cast(ArrayType(LEAK))).alias(column)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The document rows into which no benchmark item leaks, all columns kept."""
    column = "leaks"
    while column in docs.columns:
        column += "_"
    return find_leaks(docs, benchmark, column=column, **options).where(F.size(column) == 0).drop(column)
