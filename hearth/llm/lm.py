"""Language-model scoring with a weighted backoff automaton.

The model is a smoothed n-gram model of the training documents' tokens.  Its
states are the contexts seen in training.  A seen n-gram is an arc with its
log probability; every state has one failure arc, to the next shorter context,
whose weight is the log of the mass left for unseen continuations.  Scoring a
text is one walk from left to right that carries the state: take the arc of the
token if there is one, else add the failure weight and try again from the state
below; the arc names the next state.  The walk takes many stretches of text at
once, one token each a step; a stretch that starts inside a text first reads
the ``order - 1`` tokens before it, which fix the state.

Smoothing: a context seen ``c`` times leaves the mass ``beta`` to the shorter
context, ``P(w | u) = (1 - beta) c(uw) / c(u) + beta P'(w)``, where ``beta`` is
the Good-Turing estimate (share of n-grams seen once) over all contexts with
the same binary logarithm of ``c``.  Single tokens are discounted by
``D = n1 / (n1 + 2 n2)``; the mass ``D V / N`` is the unknown token's.  What
follows a context seen once was itself seen once, so the estimate for such
contexts is 1: their arcs weigh what the shorter context gives.  They need no
state, and the n-grams after them are neither exchanged nor counted.

Neither the counts nor the automaton ever sit in one place.  Documents are
dealt to blocks of bounded size.  Each block lists its distinct n-grams as
sorted hashes, cut into key ranges (slices); a slice adds up the counts of its
range over all blocks and answers every block for the n-grams it listed.  So
each block walks its documents over just the part of the automaton that they
can reach.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import U64, held_out, mix64, shuffle_partitions, text_bytes

ORDER = 2
BLOCK_BYTES = 8 << 20      # text of a block
STRETCH = 512              # tokens that one walker reads
LEVELS = 48                # binary logarithms of context counts
END, BEGIN = b" end", b" begin"      # no token holds a blank
_X = "doc_id long, held boolean, body binary, block int"
_CELL = "slice int, block int, n_gram int, keys binary, counts binary, levels binary"
_REPLY = "block int, slice int, n_gram int, counts binary, stats array<long>"


class Block:
    """The tokens of one block of documents: every text's words, A-Z lower-cased, then the end."""

    def __init__(self, docs: pa.Table):
        vocabulary: dict[bytes, int] = {END: 0}
        ids, lengths = [], []
        for body in docs.column("body"):
            words = body.as_py().lower().split()
            ids.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in words), np.int64, len(words)))
            ids.append(np.zeros(1, np.int64))
            lengths.append(len(words) + 1)
        self.lengths = np.array(lengths, np.int64)
        self.ids = np.concatenate(ids) if ids else np.empty(0, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.train = np.repeat(~docs.column("held").to_numpy().astype(bool), self.lengths)
        self.hash = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), U64, len(vocabulary))
        self._grams = self.hash[self.ids]           # hash of the n-gram that ends at each token
        self._begin = U64(xxhash.xxh3_64_intdigest(BEGIN))
        self.order = 0

    def next_order(self, counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys of the n-grams one token longer that can matter, and each token's place in them, or -1.

        An n-gram is left out if its context was seen less than twice in training (see the module's text), or
        its last tokens never (then neither was it).  ``counts``: those of the shorter n-grams at each token.
        """
        self.order += 1
        if self.order > 1:
            with np.errstate(over="ignore"):
                before = np.r_[U64(0), self._grams[:-1]]
                before[self.starts] = self._begin
                self._grams = mix64(before, 10) * U64(0x100000001B3) + self.hash[self.ids]
                self._begin = mix64(np.array([self._begin]), 10)[0] * U64(0x100000001B3) + self._begin
        if self.order == 1:
            return np.unique(mix64(self._grams, 9), return_inverse=True)
        matter = (self.context_counts(counts[-1], _train_docs(self, counts[0])) > 1) & (counts[-1] > 0)
        keys, some = np.unique(mix64(self._grams[matter], 9), return_inverse=True)
        place = np.full(len(self.ids), -1, np.int64)
        place[matter] = some
        return keys, place

    def context_counts(self, counts: np.ndarray, n_train_docs: int) -> np.ndarray:
        """Training count of each token's context, from the counts of the n-grams one shorter at each token."""
        out = np.r_[0, counts[:-1]]
        out[self.starts] = n_train_docs
        return out


def _slices(keys: np.ndarray, n: int) -> np.ndarray:
    """Bounds of the ``n`` key ranges in sorted ``keys``."""
    which = ((keys >> U64(32)) * U64(n)) >> U64(32)
    return np.searchsorted(which, np.arange(n + 1, dtype=U64))


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers by byte plane: the zero planes vanish in the shuffle's compression."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def _numbers(planes: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, by byte plane."""
    return _planes(np.diff(keys, prepend=U64(0)))


def _unpack(packed: bytes) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(_numbers(packed, U64), dtype=U64)


def _levels(context: np.ndarray) -> np.ndarray:
    return np.clip(np.log2(np.maximum(context, 1)).astype(np.int64), 0, LEVELS - 1).astype(np.uint8)


def _replied(replies: pa.Table, order: int) -> np.ndarray:
    """The counts answered for one order, in the block's key order."""
    rows = sorted((r["slice"], r["counts"]) for r in replies.select(["slice", "n_gram", "counts"]).to_pylist() if r["n_gram"] == order)
    return np.concatenate([np.frombuffer(zlib.decompress(c), np.int64) for _, c in rows]) if rows else np.empty(0, np.int64)


def _counts_at(block: Block, replies: pa.Table, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The training count of the 1-gram, 2-gram, ... up to ``order`` that ends at each token, and each one's number."""
    out, places = [], []
    for k in range(1, order + 1):
        keys, place = block.next_order(out)
        counts = _replied(replies, k)
        if len(counts) != len(keys):
            raise RuntimeError("a block was dealt other documents than before: the input is not stable")
        out.append(np.r_[counts, 0][place])
        places.append(place)
    return out, places


def _train_docs(block: Block, ones: np.ndarray) -> int:
    """Training documents in the corpus: the count of the end token, which every block holds."""
    return int(ones[block.starts[0] + block.lengths[0] - 1]) if len(ones) else 0


def _cells(order: int, n_slices: int):
    """The block's n-grams of one order, by slice."""
    def run(key: tuple, docs: pa.Table, replies: pa.Table | None = None) -> pa.Table:
        block = Block(docs)
        known, _ = _counts_at(block, replies, order - 1) if order > 1 else ([], [])
        keys, place = block.next_order(known)
        asked = place >= 0
        counts = np.bincount(place[asked], weights=block.train[asked], minlength=len(keys)).astype(np.uint32)
        levels = np.zeros(len(keys), np.uint8)
        if order > 1:
            levels[place[asked]] = _levels(block.context_counts(known[-1], _train_docs(block, known[0])))[asked]
        bounds = _slices(keys, n_slices)
        some = np.flatnonzero(np.diff(bounds))
        cut = [slice(bounds[s], bounds[s + 1]) for s in some]
        return pa.table({
            "slice": pa.array(some.astype(np.int32)), "block": pa.array(np.full(len(some), key[0].as_py(), np.int32)),
            "n_gram": pa.array(np.full(len(some), order, np.int32)), "keys": pa.array([_pack(keys[c]) for c in cut], pa.binary()),
            "counts": pa.array([_planes(counts[c]) for c in cut], pa.binary()),
            "levels": pa.array([levels[c].tobytes() for c in cut], pa.binary())})

    if order == 1:
        return lambda key, docs: run(key, docs)
    return run


def _merge(cells: pa.Table) -> pa.Table:
    """One slice: the counts over all blocks, told to each block; the first row carries the slice's statistics.

    Statistics: distinct n-grams, n-grams seen twice, then by level the n-grams seen once and all occurrences.
    """
    keys = [_unpack(k.as_py()) for k in cells.column("keys")]
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    mine = np.concatenate([_numbers(c.as_py(), np.uint32) for c in cells.column("counts")])
    totals = np.bincount(place, weights=mine).astype(np.int64)
    level = np.zeros(len(totals), np.int64)
    level[place] = np.concatenate([np.frombuffer(c.as_py(), np.uint8) for c in cells.column("levels")])
    stats = np.r_[(totals > 0).sum(), (totals == 2).sum(), np.bincount(level[totals == 1], minlength=LEVELS),
                  np.bincount(level, weights=totals, minlength=LEVELS).astype(np.int64)]
    ends = np.cumsum([len(k) for k in keys])
    return pa.table({
        "block": cells.column("block"), "slice": cells.column("slice"), "n_gram": cells.column("n_gram"),
        "counts": pa.array([zlib.compress(totals[place[e - len(k):e]].tobytes(), 1) for e, k in zip(ends, keys, strict=True)], pa.binary()),
        "stats": pa.array([stats.tolist()] + [None] * (len(keys) - 1), pa.list_(pa.int64()))})


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for order, stats in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True):
            if stats is not None:
                sums[order] = sums.get(order, 0) + np.array(stats, np.int64)
    for order, s in sums.items():
        yield pa.record_batch({"n_gram": pa.array(np.full(len(s), order, np.int32)), "at": pa.array(np.arange(len(s), dtype=np.int32)),
                               "value": pa.array(s)})


class Automaton:
    """The part of the backoff automaton that one block's tokens reach."""

    def __init__(self, stats: dict[int, np.ndarray]):
        ones = stats[1]
        self.v, n2 = int(ones[0]), int(ones[1])
        n1, self.n = int(ones[2:2 + LEVELS].sum()), int(ones[2 + LEVELS:].sum())
        self.discount = n1 / (n1 + 2 * n2) if n1 else 0.5
        self.beta = {k: (s[2:2 + LEVELS] + 1.0) / (s[2 + LEVELS:] + 1.0) for k, s in stats.items() if k > 1}

    def singles(self, counts: np.ndarray) -> np.ndarray:
        """Arcs of the empty context: each token's probability, unknown ones sharing one class."""
        if not self.n:
            return np.ones(len(counts))
        return np.where(counts > 0, (counts - self.discount) / self.n, self.discount * self.v / self.n)

    def build(self, block: Block, counts: list[np.ndarray], places: list[np.ndarray]) -> None:
        """States, arcs and failure arcs from the training counts of the n-grams at each token.

        State 0 is the empty context, then come the contexts of document starts, then the n-grams seen in
        training.  Arcs lie sorted by (state, token); an arc knows its weight and the state it leads to.
        """
        order, v = len(counts), len(block.hash)
        n_docs = _train_docs(block, counts[0])
        begins = list(range(1, order)) if n_docs else []
        self.begin = begins[-1] if begins else 0
        self.fail = [np.zeros(1, np.int64), np.array(begins, np.int64) - 1]
        self.fail_weight = [np.zeros(1), np.array([self._failure(m + 1, np.array([n_docs]))[0] for m in begins], float)]
        n_states, at = 1 + len(begins), [np.zeros(len(block.ids), np.int64)]       # at[m]: state of the m tokens up to each, or -1
        keys, weights, targets = [], [], []
        for k in range(1, order + 1):
            # one token stands for each distinct n-gram
            place = places[k - 1]
            seen = np.flatnonzero(counts[k - 1] > 0)
            some = seen[np.unique(place[seen], return_index=True)[1]]
            if k < order:
                state = np.full(place.max(initial=-1) + 2, -1, np.int64)       # the last entry is that of place -1
                state[place[some]] = n_states + np.arange(len(some))
                n_states += len(some)
                at.append(state[place])
                self.fail.append(at[k - 1][some])
                self.fail_weight.append(self._failure(k + 1, counts[k - 1][some]))
            source = np.zeros(len(some), np.int64)
            if k > 1:
                before = np.r_[0, at[k - 1][:-1]]
                before[block.starts] = k - 1                    # the start's context; its texts were seen, as the n-gram was
                source = before[some]
            keys.append(source * v + block.ids[some])
            weights.append(self._arc_weight(block, counts, k, some, n_docs))
            targets.append(at[min(k, order - 1)][some])
        keys = np.concatenate(keys)
        by = np.argsort(keys)
        self.keys, self.weight, self.target = keys[by], np.concatenate(weights)[by], np.concatenate(targets)[by]
        self.fail, self.fail_weight = np.concatenate(self.fail), np.concatenate(self.fail_weight)
        self.unknown = float(np.log10(self.singles(np.zeros(1, np.int64)))[0])

    def _beta(self, k: int, context: np.ndarray) -> np.ndarray:
        return np.minimum(self.beta[k][_levels(context)], 1.0)

    def _failure(self, k: int, context: np.ndarray) -> np.ndarray:
        """Weight of the failure arcs of contexts (of ``k - 1`` tokens) seen ``context`` times."""
        return np.log10(self._beta(k, context))

    def _arc_weight(self, block: Block, counts: list[np.ndarray], k: int, some: np.ndarray, n_docs: int) -> np.ndarray:
        """log10 probability of seen n-grams: their own share, and below it that of the n-grams one shorter."""
        p = self.singles(counts[0][some])
        for j in range(2, k + 1):
            context = block.context_counts(counts[j - 2], n_docs)[some]
            beta = self._beta(j, context)
            p = (1 - beta) * counts[j - 1][some] / context + beta * p
        return np.log10(p)

    def walk(self, block: Block, order: int) -> np.ndarray:
        """log10 probability of each token, by one traversal from left to right."""
        v, warm = len(block.hash), order - 1
        out = np.zeros(len(block.ids))
        # stretches: where each begins to read, begins to count, and ends
        n = -(-block.lengths // STRETCH)
        first = np.repeat(block.starts, n) + STRETCH * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        end = np.minimum(first + STRETCH, np.repeat(block.starts + block.lengths, n))
        start = np.repeat(block.starts, n)
        read = np.maximum(first - warm, start)
        fresh = read == start
        by = np.argsort(read - end, kind="stable")               # longest first, so those still reading are a prefix
        read, first, end = read[by], first[by], end[by]
        state = np.where(fresh[by], self.begin, 0)
        active = np.searchsorted(read - end, -np.arange((end - read).max(initial=0)), side="left")
        for step, m in enumerate(active):
            where = read[:m] + step
            gained = self._step(state[:m], block.ids[where], v)
            counted = where >= first[:m]
            out[where[counted]] = gained[counted]
        return out

    def _step(self, state: np.ndarray, token: np.ndarray, v: int) -> np.ndarray:
        """Read one token from each state, in place; returns the weights of the arcs taken."""
        gained = np.zeros(len(state))
        todo = np.arange(len(state))
        while len(todo):
            q = state[todo]
            want = q * v + token[todo]
            arc = np.searchsorted(self.keys, want)
            hit = np.zeros(len(todo), bool)
            inside = arc < len(self.keys)
            hit[inside] = self.keys[arc[inside]] == want[inside]
            taken, arc = todo[hit], arc[hit]
            gained[taken] += self.weight[arc]
            state[taken] = self.target[arc]
            lost = todo[~hit & (q == 0)]                         # a token never seen in training
            gained[lost] += self.unknown
            todo = todo[~hit & (q != 0)]
            gained[todo] += self.fail_weight[state[todo]]
            state[todo] = self.fail[state[todo]]
        return gained

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.n + self.v + 1))


_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _scored(order: int):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({c.split()[0]: pa.array([], t) for c, t in zip(_SCORES.split(", "), (
                pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True)})
        block = Block(docs)
        counts, places = _counts_at(block, replies, order)
        stats = {k: np.zeros(2 + 2 * LEVELS, np.int64) for k in range(1, order + 1)}
        for k, sums in zip(replies.column("n_gram").to_pylist(), replies.column("stats"), strict=True):
            if k < 0:
                stats[-k] = np.array(sums.as_py(), np.int64)
        model = Automaton(stats)
        model.build(block, counts, places)
        add = lambda x: np.add.reduceat(x, block.starts)
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held"), "n_tokens": pa.array(block.lengths),
            "n_known": pa.array(add((counts[0] > 0).astype(np.int64))), "train_tokens": pa.array(np.full(docs.num_rows, model.n)),
            "base_score": pa.array(add(model.base(counts[0]))), "score": pa.array(add(model.walk(block, order)))})

    return run


def score(docs: DataFrame, order: int = ORDER, modulus: int = 7, remainder: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every document row scored by the model of the documents outside the held-out fold.

    Tokens are the runs of ASCII non-blanks, A-Z lower-cased, then one end.
    Returns ``doc_id, held_out, n_tokens, n_known`` (tokens seen in training),
    ``train_tokens, base_score`` (add-one unigram, log10) and ``score`` (the
    automaton's log10 probability).  Null text counts as empty and has the end
    alone; rows with a null id are training rows; repeated rows are each
    counted and scored; other columns are ignored; an empty table gives no
    rows.  Tokens and n-grams are known by 64-bit hashes.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    n = max(1, -(-size // block_bytes), min(shuffle_partitions(spark), -(-size // (block_bytes // 4))))
    # one exchange of the texts: every step below reads it again
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), modulus, remainder).alias("held"),
                        text_bytes().alias("body"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("block")
                        ).repartition(n, "block")
    replies, stats = [], []
    for k in range(1, order + 1):
        by_block = dealt.groupBy("block")
        if k == 1:
            cells = by_block.applyInArrow(_cells(1, n), _CELL)
        else:
            cells = by_block.cogroup(_union(replies).groupBy("block")).applyInArrow(_cells(k, n), _CELL)
        replies.append(cells.groupBy("slice").applyInArrow(_merge, _REPLY).repartition(n, "block"))
        stats.append(replies[-1].mapInArrow(_statistics, "n_gram int, at int, value long"))
    known = (_union(stats).groupBy("n_gram", "at").agg(F.sum("value").alias("value"))
             .groupBy("n_gram").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("sums")))   # one row an order
    # every block gets the statistics as further replies, not on each of its documents
    told = (spark.range(n, numPartitions=1).crossJoin(F.broadcast(known))
                 .select(F.col("id").cast("int").alias("block"), F.lit(-1).alias("slice"), (-F.col("n_gram")).alias("n_gram"),
                         F.lit(b"").alias("counts"), F.col("sums.value").alias("stats")))
    return (dealt.groupBy("block").cogroup(_union([*replies, told]).groupBy("block"))
                 .applyInArrow(_scored(order), _SCORES))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
