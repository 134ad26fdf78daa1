"""Phrase collocation mining on a weighted de Bruijn graph.

Texts become pieces of words.  The graph of a language has an edge for every
run of ``LONGEST`` words in a piece, from the node of its first ``LONGEST - 1``
words to that of its last, weighted by its occurrences.  Only edges are counted;
a shorter phrase's count follows from the flow through it: what leaves it by
edges one word longer, plus the pieces that end with it,

    f(w1..wk) = sum over w of f(w1..wk w) + ends(w1..wk)        k < LONGEST

1. Pairs of neighbouring words that occur fewer than ``min_count`` times are in
   no candidate, so pieces are cut between them.  A Bloom filter of the other
   pairs (of bounded size; false positives only leave a cut out) travels to
   the tasks.  It is built from hashes counted by hash range.
2. Each block of texts builds its own graph and compacts unary paths: a node
   with one edge in and one out, where no piece starts or ends, is passed over,
   so a path travels as one row of words with one weight, not a row per edge.
3. Paths are cut into edges again, the edges and ends of all blocks added up in
   one exchange, and the flow gives the shorter counts, level by level.
4. Candidates are scored at their lowest cut.  A candidate inside a longer one
   that is as frequent goes; one word longer is enough to look at, since counts
   only fall as phrases grow.

Words are counted as text, never as hashes; arithmetic is on whole decimals.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import U64, bound_batches, mix64, shuffle_partitions, stored

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
UNKNOWN = "und"
BLOCK_BYTES = 6 << 20         # text of a block
SLICE_BYTES = 64 << 20        # text whose pairs a hash range takes, at most, when there are many texts
FILTER_BYTES = 64 << 20       # bound of the pair filter
SALTS = 16                    # parts in which a language's best are looked for first
_KEY_BITS = 48
_BREAK = b"."
_SEPARATORS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)     # fixed values: what ends a piece


class Block:
    """The words of some texts as numbers; 0 stands between pieces.  A number belongs to one language."""

    def __init__(self):
        self._next = count(1)
        self._numbers: dict[str, defaultdict] = {}
        self._ids: list[int] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        numbers = self._numbers.get(lang)
        if numbers is None:
            numbers = self._numbers[lang] = defaultdict(self._next.__next__, {_BREAK: 0})
        # A-Z become lower case; what ends a piece becomes a word of its own
        words = text.lower().translate(_SEPARATORS).replace(_BREAK, b" . ").replace(b"\t", b" ").split(b" ")
        self._ids += [numbers[w] for w in words if w]
        self._ids.append(0)
        self.size += len(text) + 1

    def close(self) -> None:
        self.ids = np.array(self._ids, np.int64)
        self._ids = []
        n = next(self._next)
        self.words: list[bytes] = [b""] * n
        self.langs: list[str] = [""] * n
        for lang, numbers in self._numbers.items():
            for word, i in numbers.items():
                if i:
                    self.words[i], self.langs[i] = word, lang

    def pair_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Where a pair of neighbours begins, and its key: language and both words as a 48-bit hash."""
        seeds = {lang: xxhash.xxh3_64_intdigest(lang) for lang in self._numbers}
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, seeds[lang]) if lang in seeds else 0
                              for w, lang in zip(self.words, self.langs, strict=True)), U64, len(self.words))
        at = np.flatnonzero((self.ids[:-1] > 0) & (self.ids[1:] > 0)) if len(self.ids) else np.empty(0, np.int64)
        with np.errstate(over="ignore"):
            key = mix64(hashes[self.ids[at]], 3) * U64(0x100000001B3) + hashes[self.ids[at + 1]]
        return at, mix64(key, 4) >> U64(64 - _KEY_BITS)


def blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[Block]:
    """The rows (lang, text) of a task, in blocks of about ``block_bytes`` of text; a text is never cut."""
    block = Block()
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            block.add(lang, text)
            if block.size >= block_bytes:
                block.close()
                yield block
                block = Block()
    if block.size:
        block.close()
        yield block


# --- the filter of frequent pairs --------------------------------------------------------------------------------

def _slice_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> U64(_KEY_BITS - 32)) * U64(n)) >> U64(32)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers by byte plane: the many zero bytes vanish in the shuffle's compression."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _unplane(data: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _pair_cells(n_slices: int, block_bytes: int):
    """Each block's distinct pairs and their counts, by hash range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, block_bytes):
            keys, counts = np.unique(block.pair_keys()[1], return_counts=True)
            bounds = np.searchsorted(_slice_of(keys, n_slices), np.arange(n_slices + 1, dtype=U64))
            some = np.flatnonzero(np.diff(bounds))
            cuts = [slice(bounds[s], bounds[s + 1]) for s in some]
            yield pa.record_batch({
                "slice": pa.array(some.astype(np.int32)),
                "keys": pa.array([_planes(np.diff(keys[c], prepend=U64(0))) for c in cuts], pa.binary()),
                "counts": pa.array([_planes(counts[c].astype(np.uint32)) for c in cuts], pa.binary())})

    return run


def _positions(keys: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return mix64(keys, 5) & mask, mix64(keys, 6) & mask


def _segment(min_count: int, most_bits: int):
    """One hash range: its frequent pairs as a segment of the filter."""
    def run(cells: pa.Table) -> pa.Table:
        keys = np.concatenate([np.cumsum(_unplane(k.as_py(), np.uint64), dtype=U64) for k in cells.column("keys")])
        counts = np.concatenate([_unplane(c.as_py(), np.uint32) for c in cells.column("counts")])
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        totals = np.add.reduceat(counts[order].astype(np.int64), first)
        often = keys[first][totals >= min_count]
        bits = np.zeros(max(8, min(most_bits, 1 << (16 * len(often)).bit_length())), bool)
        for at in _positions(often, U64(len(bits) - 1)):
            bits[at] = True
        return pa.table({"slice": cells.column("slice").slice(0, 1), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    return run


class PairFilter:
    """Which pairs may be frequent: a Bloom filter in segments by hash range."""

    def __init__(self, segments: dict[int, bytes], n_slices: int):
        sizes = np.array([len(segments.get(s, b"\0")) for s in range(n_slices)], np.int64)
        self.n, self.start, self.mask = n_slices, (np.cumsum(sizes) - sizes).astype(U64), (sizes * 8 - 1).astype(U64)
        self.bits = np.frombuffer(b"".join(segments.get(s, b"\0") for s in range(n_slices)), np.uint8)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        s = _slice_of(keys, self.n).astype(np.int64)
        start, out = self.start[s], np.ones(len(keys), bool)
        for at in _positions(keys, self.mask[s]):
            out &= (self.bits[start + (at >> U64(3))] >> (at & U64(7)).astype(np.uint8)) & 1 == 1
        return out


def pair_filter(texts: DataFrame, min_count: int, block_bytes: int = BLOCK_BYTES) -> PairFilter:
    """The filter of the pairs that occur ``min_count`` times or more in ``texts`` (lang, text as bytes)."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(shuffle_partitions(texts.sparkSession), -(-size // SLICE_BYTES))
    most = 1 << ((FILTER_BYTES * 8 // n).bit_length() - 1)
    rows = (texts.mapInArrow(_pair_cells(n, block_bytes), "slice int, keys binary, counts binary")
                 .groupBy("slice").applyInArrow(_segment(min_count, max(8, most)), "slice int, bits binary"))
    return PairFilter({r["slice"]: bytes(r["bits"]) for r in rows.collect()}, n)       # FILTER_BYTES at most


# --- a block's graph ---------------------------------------------------------------------------------------------

def _ranks(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 for equal (left, right), and how many there are of each."""
    _, place, counts = np.unique(left * (np.int64(right.max(initial=0)) + 1) + right, return_inverse=True, return_counts=True)
    return place, counts


def paths_and_ends(block: Block, keep: PairFilter | None) -> Iterator[tuple[bool, str, str, int]]:
    """(is an end, language, words, weight): the block's compacted paths and what its fragments end with.

    A fragment is a run of words in a piece whose pairs ``keep`` lets through.
    Paths hold ``LONGEST`` words or more; ends hold a fragment's last
    ``LONGEST - 1`` words, or all if it has fewer.
    """
    ids = block.ids
    linked = np.zeros(len(ids), bool)                    # a word and the next are of one fragment
    at, keys = block.pair_keys()
    linked[at if keep is None else at[keep(keys)]] = True
    text = lambda a, b: " ".join(block.words[i].decode("utf-8", "replace") for i in ids[a:b])
    lone = (ids > 0) & ~linked
    lone[1:] &= ~linked[:-1]
    times = np.bincount(ids[lone], minlength=1)
    for i in np.flatnonzero(times).tolist():
        yield True, block.langs[i], block.words[i].decode("utf-8", "replace"), int(times[i])
    # the words of longer fragments, moved together
    inside = linked.copy()
    inside[1:] |= linked[:-1]
    where = np.flatnonzero(inside)
    if not len(where):
        return
    word, go_on = ids[where], linked[where]
    last = np.flatnonzero(~go_on)
    first = np.r_[0, last[:-1] + 1]
    length = last - first + 1
    room = np.repeat(last, length) - np.arange(len(word)) + 1          # words from here to the fragment's end
    # grams[k]: the places where k words follow, and the number of those k words
    grams = {1: (np.arange(len(word)), word)}
    for k in range(2, LONGEST + 1):
        places = np.flatnonzero(room >= k)
        shorter = np.zeros(len(word), np.int64)
        shorter[grams[k - 1][0]] = grams[k - 1][1]
        grams[k] = places, _ranks(shorter[places], word[places + k - 1])[0]
    node_at = np.full(len(word), -1)
    node_at[grams[LONGEST - 1][0]] = grams[LONGEST - 1][1]
    for k in range(1, LONGEST):
        mine = last[length == k] if k < LONGEST - 1 else last[length >= k]
        start = mine - k + 1
        number = np.zeros(len(word), np.int64)
        number[grams[k][0]] = grams[k][1]
        _, one, times = np.unique(number[start], return_index=True, return_counts=True)
        for a, c in zip(start[one].tolist(), times.tolist(), strict=True):
            yield True, block.langs[word[a]], text(where[a], where[a] + k), c
    place, edge = grams[LONGEST]
    if not len(place):
        return
    # a node is passed over if one edge leads in, one out, and no fragment starts or ends there
    n_nodes = int(node_at.max()) + 1
    edges, one, weight = np.unique(edge, return_index=True, return_counts=True)
    source, target = node_at[place[one]], node_at[place[one] + 1]
    unary = (np.bincount(source, minlength=n_nodes) == 1) & (np.bincount(target, minlength=n_nodes) == 1)
    long = length >= LONGEST - 1
    unary[node_at[first[long]]] = False
    unary[node_at[last[long] - LONGEST + 2]] = False
    joins = unary[node_at[place]]                                      # this edge goes on from the one before
    head = np.flatnonzero(~joins)
    end = np.r_[head[1:], len(place)] - 1                              # the run's last edge, in places one after another
    _, pick = np.unique(edge[head], return_index=True)
    for h, e in zip(head[pick].tolist(), end[pick].tolist(), strict=True):
        a = where[place[h]]
        yield False, block.langs[ids[a]], text(a, a + (e - h) + LONGEST), int(weight[edge[h]])


def _graph_rows(keep, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = PairFilter.__new__(PairFilter)
        passes.__dict__.update(keep.value)
        for block in blocks(batches, block_bytes):
            rows = list(paths_and_ends(block, passes))
            for i in range(0, len(rows), 100_000):
                is_end, lang, words, weight = zip(*rows[i:i + 100_000], strict=True)
                yield pa.record_batch({"is_end": pa.array(is_end), "lang": pa.array(lang, pa.string()),
                                       "words": pa.array(words, pa.string()), "weight": pa.array(weight, pa.int64())})

    return run


# --- counts, scores, the best ------------------------------------------------------------------------------------

def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """Tables ``lang, phrase, f`` of the phrases of 1 to ``LONGEST`` words, written.

    Single words are all there; of longer phrases all that occur ``min_count``
    times or more, with their whole counts, and some rarer ones.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                        F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b"")).alias("text"))
    keep = spark.sparkContext.broadcast(vars(pair_filter(texts, min_count, block_bytes)))
    rows = texts.mapInArrow(_graph_rows(keep, block_bytes), "is_end boolean, lang string, words string, weight long")
    w = F.split("words", " ")
    # a path gives its edges, an end the phrases of each length that stop there
    edges = F.transform(F.sequence(F.lit(1), F.size(w) - (LONGEST - 1)),
                        lambda i: F.struct(F.lit(LONGEST).alias("k"), F.array_join(F.slice(w, i, LONGEST), " ").alias("phrase")))
    stops = F.expr("transform(sequence(1, size(split(words, ' '))), i -> struct(i as k, substring_index(words, ' ', -i) as phrase))")
    given = stored(rows.select("lang", "weight", F.explode(F.when(F.col("is_end"), stops).otherwise(edges)).alias("g"))
                       .groupBy("lang", "g.k", "g.phrase").agg(F.sum("weight").alias("f")), "graph", by=("k",))
    of = lambda k: given.where(F.col("k") == k).select("lang", "phrase", "f")
    levels = [of(LONGEST)]
    for k in range(LONGEST - 1, 0, -1):
        flow = levels[0].select("lang", F.substring_index("phrase", " ", k).alias("phrase"), F.col("f"))
        levels.insert(0, stored(flow.unionByName(of(k)).groupBy("lang", "phrase").agg(F.sum("f").alias("f")), f"phrases{k}"))
    return levels


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``LONGEST`` words by score.

    ``lang, rank`` (from 1), ``phrase, a, l, r, n, score``: ``a``
    occurrences (at least ``min_count``), ``l`` and ``r`` those of the parts at
    the cut with the lowest ``score = floor(1000 a n / (l r))``, of cuts alike the
    first; ``n`` words of the language.  Phrases inside a longer one that occurs
    as often are left out.  Order: score and ``a`` falling, then the phrase by
    bytes.  Null texts count as empty and null languages as ``und``; equal rows
    each count; ids are not read, other columns are ignored; an empty table
    gives no rows.
    """
    levels = phrase_counts(docs, min_count, block_bytes)
    total = levels[0].groupBy("lang").agg(F.sum("f").alias("n"))
    often = [lv.where(F.col("f") >= min_count).withColumn("k", F.lit(k)) for k, lv in enumerate(levels, 1)]
    parts = often[0]
    for lv in often[1:]:
        parts = parts.unionByName(lv)
    longer = often[2]
    for lv in often[3:]:
        longer = longer.unionByName(lv)
    # the greatest count of a phrase one word longer, on either side
    around = (longer.select("lang", F.explode(F.array(F.expr("substring_index(phrase, ' ', k - 1)"),
                                                      F.expr("substring_index(phrase, ' ', 1 - k)"))).alias("phrase"), "f")
                    .groupBy("lang", "phrase").agg(F.max("f").alias("around")))
    kept = (parts.where("k > 1").join(around, ["lang", "phrase"], "left")
                 .where(F.col("around").isNull() | (F.col("around") < F.col("f"))))
    cuts = (kept.select("lang", "phrase", F.col("f").alias("a"), "k", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
                .withColumn("left", F.expr("substring_index(phrase, ' ', cut)"))
                .withColumn("right", F.expr("substring_index(phrase, ' ', cut - k)")))
    scored = (cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
                  .join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
                  .join(F.broadcast(total), "lang")                      # a row per language
                  .withColumn("score", F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0)))"
                                              " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")))
    lowest = (scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("s"))
                    .select("lang", "phrase", "s.score", "s.a", "s.l", "s.r", "s.n"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first among parts of a language, so that no task gets all its phrases
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    best = lowest.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    return (best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
                .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
