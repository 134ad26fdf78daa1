"""Suffix-array dedup: bytes under a long string that an earlier document also has.

Every window of ``length`` bytes has an anchor, the seed inside it with the
least hash; equal windows have equal anchors at equal places.  Neighbouring
windows with one anchor form a fragment, kept under the anchor's hash, so equal
windows of all documents meet under one key:

1. blocks of documents list the keys and content hashes of their fragments; a
   key met in one document only is dropped, its windows repeat nowhere;
2. under a shared key with a single fragment, its least document is all there
   is to find.  The fragments under keys with several different ones meet, equal
   ones as one with their least document, and a suffix array of them all finds
   the windows they share: the fragments are cut into 16-byte symbols in
   step with their anchor, the array groups the suffixes that agree on the symbols of
   a window's core, and the few bytes beside the core finish the comparison;
3. every block learns the least document of each of its windows and removes
   the bytes under those that start in a smaller one.

The suffix array is built by the linear grouping construction: suffixes are
grouped by their Lyndon prefix, groups are processed in descending order, and
the previous-smaller pointers found on the way extend the prefixes of the
suffixes they point to; one ascending pass then emits every group's order from
the same pointers.  Nothing is renamed recursively.

A key with more than ``HOT`` different fragments (the edge of a passage that
very many documents share) is not gathered: each of its windows goes out under
its own hash instead, where only equal windows meet.  Fragments and such windows
are told apart by their 48-bit key and 48 bits or more of a content hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import U64, mix64, shuffle_partitions, text_bytes

LENGTH = 50
SYMBOL = 16                # bytes of a symbol of the suffix array
SPREAD = 19                # seeds in a window
HOT = 20_000
AT_ONCE = 8192             # fragments sorted at once; those of one key stay together
BLOCK_BYTES = 4 << 20
CHUNK_BYTES = 1 << 18      # text hashed at once
LAST = (1 << 63) - 1       # the place of a document without an id: after all others
_BASE = 0x9E3779B97F4A7C15
_BYTE = mix64(np.arange(1, 257, dtype=U64), 20)
#: What the keys turn out to be: in one document only, one fragment, several, more than HOT.
ALONE, SINGLE, SEVERAL, CROWDED = range(4)
_KEYS = "slice int, block int, keys binary, hashes binary, shared binary"
_REPLY = "block int, slice int, part int, a binary, b binary, c binary"
_FRAGMENTS = "slice int, block int, part int, keys binary, hashes binary, docs binary, shape binary, body binary"


# --- the suffix array -------------------------------------------------------------------------------------------

def suffix_array(s: list[int]) -> list[int]:
    """The starts of the suffixes of ``s`` in ascending order, by linear grouping."""
    n = len(s)
    if not n:
        return []
    symbols = np.asarray(s)
    order = np.argsort(symbols, kind="stable")           # groups by first symbol
    starts = np.flatnonzero(np.r_[True, symbols[order][1:] != symbols[order][:-1]])
    ends = np.r_[starts[1:], n] - 1
    # a suffix's position and its group's start; a group's last position
    place, group, last = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, np.int64)
    place[order] = np.arange(n)
    group[order] = np.repeat(starts, ends - starts + 1)
    last[starts] = ends
    sa, place, group, last = order.tolist(), place.tolist(), group.tolist(), last.tolist()
    previous = [-1] * n                                  # the nearest earlier suffix in a lower group
    # first pass: final groups, in descending order
    end = n - 1
    while end >= 0:
        p = sa[end]
        start = group[p]
        if start == end:                                 # alone in its group: at most one suffix grows
            q = p - 1
            while q >= 0 and group[q] > start:
                q = previous[q]
            previous[p] = q
            if q >= 0 and last[g := group[q]] != g:      # and splits off as the last of its own
                to, at = last[g], place[q]
                other = sa[to]
                sa[at], sa[to] = other, q
                place[other], place[q] = at, to
                last[g], last[to], group[q] = to - 1, to, to
            end -= 1
            continue
        members = sorted(sa[start:end + 1])
        times: dict[int, int] = {}
        for p in members:
            q = p - 1
            while q >= 0 and group[q] > start:           # larger: its own pointer skips what is larger still
                q = previous[q]
            if q >= 0 and group[q] == start:             # the same prefix again right before: same pointer
                q = previous[q]
            previous[p] = q
            if q >= 0:
                times[q] = times.get(q, 0) + 1
        # the suffixes pointed to grow by the group's prefix, once or several times: they follow
        # what stays of their group, those that grow most last
        by_times: dict[int, list[int]] = {}
        for q, k in times.items():
            by_times.setdefault(k, []).append(q)
        for k in sorted(by_times, reverse=True):
            touched: dict[int, int] = {}
            for q in by_times[k]:
                g = group[q]
                to = last[g]
                touched.setdefault(g, to)
                other, at = sa[to], place[q]
                sa[at], sa[to] = other, q
                place[other], place[q] = at, to
                last[g] = to - 1
            for g, old in touched.items():
                new = last[g] + 1
                last[g] = last[g] if new > g else old
                last[new] = old
                for i in range(new, old + 1):
                    group[sa[i]] = new
        end = start - 1
    # second pass: as a suffix gets its final place, so do those whose prefix ends where it starts
    free, placed, out = list(range(n)), [False] * n, [-1] * n
    at = -1
    while at < n:
        q = (n if at < 0 else out[at]) - 1
        while q >= 0 and not placed[q]:
            g = group[q]
            out[free[g]] = q
            free[g] += 1
            placed[q] = True
            q = previous[q]
        at += 1
    return out


# --- windows and fragments --------------------------------------------------------------------------------------

class Fragments:
    """The fragments of a block's documents: ``start``, ``n`` windows, anchor, key and content hash."""

    def __init__(self, docs: pa.Table, length: int):
        bodies = [b.as_py() for b in docs.column("body")]
        self.doc = docs.column("doc").to_numpy()
        sizes = np.array([len(b) for b in bodies], np.int64)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.bytes = np.frombuffer(b"".join(bodies), np.uint8)
        parts, i = [], 0
        while i < len(bodies):
            j = i + 1
            while j < len(bodies) and self.ends[j] - self.begins[i] <= CHUNK_BYTES:
                j += 1
            parts.append(self._chunk(i, j, length))
            i = j
        self.start, self.n, self.anchor, self.key, self.hash, self.row = (
            np.concatenate(x) for x in zip(*parts, strict=True))

    def _chunk(self, i: int, j: int, length: int):
        lo, raw = self.begins[i], self.bytes[self.begins[i]:self.ends[j - 1]]
        seed = length - SPREAD + 1
        if len(raw) < length:
            empty = np.empty(0, np.int64)
            return empty, empty, empty, empty.view(U64), empty.view(U64), empty
        h = mix64(_rolling(raw, seed), 21)
        # the least seed of each window, the leftmost on a tie: hash above, place below
        least = _sliding_argmin(h, SPREAD)
        begin, end = self.begins[i:j] - lo, self.ends[i:j] - lo
        count = np.maximum(end - begin - length + 1, 0)
        row, at = np.repeat(np.arange(i, j), count), np.repeat(begin, count) + _within(count)
        anchor = least[at]
        first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]) if len(at) else at
        n = np.diff(np.r_[first, len(at)])
        start, anchor, row = at[first], anchor[first], row[first]
        with np.errstate(over="ignore"):
            content = mix64(h[start] * U64(3) + h[start + n - 1 + SPREAD - 1] * U64(5)
                            + ((anchor - start) * 64 + n).astype(U64) * U64(_BASE) + h[anchor], 22)
        return start + lo, n, anchor - start, h[anchor] >> U64(16), content, row

    def windows(self, pick: np.ndarray, length: int):
        """The picked fragments window by window: ``(of, start, key, hash)``."""
        of = np.repeat(pick, self.n[pick])
        start = self.start[of] + _within(self.n[pick])
        key = np.empty(len(of), U64)
        for i in range(0, len(of), 1 << 16):
            h = np.zeros(len(of[i:i + (1 << 16)]), U64)
            with np.errstate(over="ignore"):
                for k in range(length):
                    h = h * U64(_BASE) + _BYTE[self.bytes[start[i:i + (1 << 16)] + k]]
            key[i:i + (1 << 16)] = mix64(h, 23)
        return of, start, key


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the counted groups."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _rolling(raw: np.ndarray, n: int) -> np.ndarray:
    """The polynomial hash of every run of ``n`` bytes, by doubling."""
    power, size, parts, left = _BYTE[raw], 1, [], n
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                parts.append((size, power))
            left >>= 1
            if left:
                power = power[:-size] * U64(pow(_BASE, size, 1 << 64)) + power[size:]
                size *= 2
        count, at = len(raw) - n + 1, 0
        out = np.zeros(count, U64)
        for size, p in parts:
            out = out * U64(pow(_BASE, size, 1 << 64)) + p[at:at + count]
            at += size
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    out, size = x, 1
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def _sliding_argmin(h: np.ndarray, width: int, step: int = 1 << 22) -> np.ndarray:
    """Where the least hash of each window is, the leftmost on a tie: place bits below the hash's upper ones."""
    out, low = [], U64((1 << 24) - 1)
    for i in range(0, len(h) - width + 1, step):
        part = h[i:i + step + width - 1]
        out.append((_sliding_min((part & ~low) | np.arange(len(part), dtype=U64), width) & low).astype(np.int64) + i)
    return np.concatenate(out)


# --- exchange between blocks and slices -------------------------------------------------------------------------

def _cut(keys: np.ndarray, n: int) -> list[tuple[int, slice]]:
    """The non-empty ones of ``n`` equal ranges of the 48-bit keys, as slices of the sorted ``keys``."""
    bounds = np.searchsorted(((keys >> U64(16)) * U64(n)) >> U64(32), np.arange(n + 1, dtype=U64))
    return [(int(s), slice(bounds[s], bounds[s + 1])) for s in np.flatnonzero(np.diff(bounds))]


def _pack(x: np.ndarray) -> bytes:
    """Sorted numbers as differences, by byte plane: zero planes vanish in the shuffle's compression."""
    return np.diff(x.astype(U64), prepend=U64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(b: bytes) -> np.ndarray:
    return np.cumsum(_planes(b, U64), dtype=U64)


def _by_plane(x: np.ndarray) -> bytes:
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _planes(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _grouped(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort order by the columns (last one first) and where the groups of equal rows begin in it."""
    order = np.lexsort(columns)
    new = np.zeros(max(len(order) - 1, 0), bool)
    for c in columns:
        new |= c[order][1:] != c[order][:-1]
    return order, np.flatnonzero(np.r_[True, new][:len(order)])


class Entries:
    """Occurrences grouped by key and, if given, content: the distinct ones in key order."""

    def __init__(self, row, start, n, offset, doc, key, content):
        self.n, self.doc = n, doc
        self.at = start + row          # its place when every document has one slot more than bytes
        order, first = _grouped(key) if content is None else _grouped(content, key)
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(order)]))
        rep = order[first]
        self.e_key, self.e_start, self.e_n, self.e_offset = key[rep], start[rep], n[rep], offset[rep]
        self.e_hash = None if content is None else content[rep]
        self.e_doc = np.minimum.reduceat(doc[order], first) if len(first) else np.empty(0, np.int64)


class Block:
    """A block's fragments, grouped the same way in every step."""

    def __init__(self, docs: pa.Table, length: int):
        self.length, self.f = length, Fragments(docs, length)
        self.keys, self.place = np.unique(self.f.key, return_inverse=True)
        self.docs = self.f.doc[self.f.row]

    def listed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct (key, hash) pairs in order, and whether several documents have the key."""
        low, high = np.full(len(self.keys), LAST), np.full(len(self.keys), -LAST - 1)
        np.minimum.at(low, self.place, self.docs)
        np.maximum.at(high, self.place, self.docs)
        times = np.bincount(self.place, minlength=len(self.keys))
        once = times[self.place] == 1
        rest = np.flatnonzero(~once)
        order, first = _grouped(self.f.hash[rest], self.place[rest])
        pick = np.r_[np.flatnonzero(once), rest[order][first]]
        pick = pick[np.lexsort((self.f.hash[pick], self.place[pick]))] if len(rest) else pick[np.argsort(self.place[pick])]
        return self.f.key[pick], self.f.hash[pick], (low != high)[self.place[pick]]

    def entries(self, kinds: np.ndarray) -> dict[int, Entries]:
        """By part: fragments alone under a shared key, fragments among others, and windows of crowded keys."""
        kind, f = kinds[self.place], self.f
        out = {}
        for part in (SINGLE, SEVERAL):
            w = np.flatnonzero(kind == part)
            out[part] = Entries(f.row[w], f.start[w], f.n[w], f.anchor[w], self.docs[w], f.key[w], f.hash[w] if part == SEVERAL else None)
        of, start, own = f.windows(np.flatnonzero(kind == CROWDED), self.length)
        out[CROWDED] = Entries(f.row[of], start, np.ones(len(of), np.int64), np.zeros(len(of), np.int64), self.docs[of], own >> U64(16), own)
        return out


def _answers(replies: pa.Table, part: int) -> list[dict]:
    """A block's replies of one part, in key order (each slice is a range of keys)."""
    rows = replies.filter(pa.array(np.asarray(replies.column("part")) == part)).to_pylist()
    return sorted(rows, key=lambda r: r["slice"])


def _kinds_of(block: Block, replies: pa.Table) -> np.ndarray:
    got = [np.frombuffer(zlib.decompress(r["a"]), np.uint8) for r in _answers(replies, ALONE)]
    out = np.concatenate(got) if got else np.empty(0, np.uint8)
    if len(out) != len(block.keys):
        raise RuntimeError("a block was dealt other documents than before: the input is not stable")
    return out


def _short(hashes: np.ndarray) -> bytes:
    """48 bits of each hash, by byte plane."""
    return np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()


def _list_keys(length: int, n_slices: int):
    def run(key: tuple, docs: pa.Table) -> pa.Table:
        keys, hashes, shared = Block(docs, length).listed()
        cut = _cut(keys, n_slices)
        return pa.table({
            "slice": pa.array([s for s, _ in cut], pa.int32()), "block": pa.array([key[0].as_py()] * len(cut), pa.int32()),
            "keys": pa.array([_pack(keys[c]) for _, c in cut], pa.binary()),
            "hashes": pa.array([_short(hashes[c]) for _, c in cut], pa.binary()),
            "shared": pa.array([np.packbits(shared[c]).tobytes() for _, c in cut], pa.binary())})

    return run


def _judge_keys(hot: int):
    """One slice: tells every block what each of its keys is."""
    def run(cells: pa.Table) -> pa.Table:
        keys = [_unpack(k.as_py()) for k in cells.column("keys")]
        sizes = np.array([len(k) for k in keys])
        key, of = np.concatenate(keys), np.repeat(np.arange(len(keys)), sizes)
        planes = [np.frombuffer(h.as_py(), np.uint8).reshape(6, -1).T for h in cells.column("hashes")]
        content = np.zeros((len(key), 8), np.uint8)
        content[:, :6] = np.concatenate(planes)
        flags = np.concatenate([np.unpackbits(np.frombuffer(b.as_py(), np.uint8))[:n] for b, n in zip(cells.column("shared"), sizes, strict=True)])
        distinct, place = np.unique(key, return_inverse=True)
        low, high = np.full(len(distinct), len(keys)), np.full(len(distinct), -1)
        np.minimum.at(low, place, of)
        np.maximum.at(high, place, of)
        shared = (low != high) | (np.bincount(place, weights=flags, minlength=len(distinct)) > 0)
        order, first = _grouped(content.view(U64).ravel(), place)
        different = np.bincount(place[order][first], minlength=len(distinct))
        kind = np.where(~shared, ALONE, np.where(different == 1, SINGLE, np.where(different <= hot, SEVERAL, CROWDED))).astype(np.uint8)
        out, e = [], 0
        for k in keys:      # a block's pairs are in key order: one answer for each of its keys
            mine = place[e:e + len(k)]
            e += len(k)
            out.append(zlib.compress(kind[mine[np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])]].tobytes(), 1))
        return _replies(cells, np.full(len(keys), ALONE), out)

    return run


def _replies(cells: pa.Table, part: np.ndarray, a: list[bytes], b: list[bytes] | None = None, c: list[bytes] | None = None) -> pa.Table:
    none = [b""] * len(a)
    return pa.table({"block": cells.column("block"), "slice": cells.column("slice"), "part": pa.array(part.astype(np.int32)),
                     "a": pa.array(a, pa.binary()), "b": pa.array(b or none, pa.binary()), "c": pa.array(c or none, pa.binary())})


def _list_fragments(length: int, n_slices: int):
    def run(key: tuple, docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _no_rows(_FRAGMENTS)
        block, rows = Block(docs, length), []
        for part, e in block.entries(_kinds_of(block, replies)).items():
            for s, c in _cut(e.e_key, n_slices):
                size = e.e_n[c] + length - 1
                several = part == SEVERAL
                rows.append((s, key[0].as_py(), part, _pack(e.e_key[c]), b"" if part == SINGLE else e.e_hash[c].tobytes(), _by_plane(e.e_doc[c]),
                             np.r_[e.e_n[c], e.e_offset[c]].astype(np.uint8).tobytes() if several else b"",
                             block.f.bytes[np.repeat(e.e_start[c], size) + _within(size)].tobytes() if several else b""))
        names, kinds = zip(*[c.split() for c in _FRAGMENTS.split(", ")], strict=True)
        types = [pa.int32() if k == "int" else pa.binary() for k in kinds]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=list(names))

    return run


def _no_rows(schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.table({c.split()[0]: pa.array([], kinds[c.split()[1]]) for c in schema.split(", ")})


def least_documents(body: np.ndarray, at: np.ndarray, n: np.ndarray, offset: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """For every window of the given fragments, in order: the least document of all equal windows.

    ``at``: where each fragment begins in ``body``; ``n``: its windows;
    ``offset``: its anchor's place, to which the symbols keep step.
    """
    core = (length - SYMBOL + 1) // SYMBOL
    phase = offset % SYMBOL
    symbols = (n + length - 1 - phase) // SYMBOL
    of = np.repeat(np.arange(len(n)), symbols)
    place = (at + phase)[of] + SYMBOL * _within(symbols)
    text = np.ascontiguousarray(body[place[:, None] + np.arange(SYMBOL)]).view(U64).reshape(-1, SYMBOL // 8)
    order, first = _grouped(*text.T)
    rank = np.empty(len(text), np.int64)
    rank[order] = np.repeat(np.arange(1, len(first) + 1), np.diff(np.r_[first, len(order)]))
    # the symbols as ranks, a 0 after each fragment
    first = np.cumsum(symbols + 1) - (symbols + 1)
    seq = np.zeros(int((symbols + 1).sum()), np.int64)
    seq[first[of] + _within(symbols)] = rank
    left = np.zeros(len(seq), np.int64)
    left[first[of] + _within(symbols)] = np.repeat(symbols, symbols) - _within(symbols)
    sa = np.array(suffix_array(seq.tolist()))
    sa = sa[left[sa] >= core]                    # suffixes that hold a whole core
    cores = seq[sa[:, None] + np.arange(core)]
    group = np.zeros(len(seq), np.int64)
    group[sa] = np.cumsum(np.r_[True, (cores[1:] != cores[:-1]).any(1)][:len(sa)])
    # each window: the group of its first core, and the bytes beside it
    w_of = np.repeat(np.arange(len(n)), n)
    w = _within(n)
    step = -(-(w - phase[w_of]) // SYMBOL)
    lead = phase[w_of] + SYMBOL * step - w
    beside = np.arange(length - SYMBOL * core)[None, :]
    beside = np.where(beside < lead[:, None], beside, beside + SYMBOL * core) + (at[w_of] + w)[:, None]
    rest = np.zeros((len(w), -(-beside.shape[1] // 8) * 8), np.uint8)
    rest[:, :beside.shape[1]] = body[beside]
    order, begin = _grouped(*rest.view(U64).T, group[first[w_of] + step] * SYMBOL + lead)
    out = np.empty(len(w), np.int64)
    out[order] = np.repeat(np.minimum.reduceat(doc[w_of][order], begin), np.diff(np.r_[begin, len(order)])) if len(order) else 0
    return out


def _whole_keys(key: np.ndarray) -> Iterator[slice]:
    """Cuts the sorted keys into slices of about ``AT_ONCE``, none of them inside a key."""
    ends = np.r_[np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)]
    start = 0
    while start < len(key):
        end = int(ends[min(np.searchsorted(ends, start + AT_ONCE), len(ends) - 1)])
        yield slice(start, end)
        start = end


def _judge_fragments(length: int):
    """One slice: every block learns the least document of each of its entries, by window where windows differ."""
    def run(cells: pa.Table) -> pa.Table:
        out = []
        for part in (SINGLE, SEVERAL, CROWDED):
            mine = cells.filter(pa.array(np.asarray(cells.column("part")) == part))
            if mine.num_rows:
                out.append(_judge_part(mine, part, length))
        return pa.concat_tables(out)

    return run


def _judge_part(cells: pa.Table, part: int, length: int) -> pa.Table:
    get = lambda c, f: [f(x.as_py()) for x in cells.column(c)]
    keys = get("keys", _unpack)
    key, doc = np.concatenate(keys), np.concatenate(get("docs", lambda b: _planes(b, np.int64)))
    content = None if part == SINGLE else np.concatenate(get("hashes", lambda b: np.frombuffer(b, U64)))
    # equal entries as one
    order, first = _grouped(key) if content is None else _grouped(content, key)
    same = np.empty(len(order), np.int64)
    same[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(order)]))
    least = np.minimum.reduceat(doc[order], first)
    ends = np.cumsum([len(k) for k in keys])
    mine = [same[e - len(k):e] for e, k in zip(ends, keys, strict=True)]
    kind = np.full(len(keys), part)
    if part != SEVERAL:
        return _replies(cells, kind, [zlib.compress(_by_plane(least[m]), 1) for m in mine])
    shape = get("shape", lambda b: np.frombuffer(b, np.uint8).astype(np.int64).reshape(2, -1))
    n, offset = np.concatenate([s[0] for s in shape]), np.concatenate([s[1] for s in shape])
    begin = np.cumsum(n + length - 1) - (n + length - 1)
    rep = order[first]
    n = n[rep]
    body = np.concatenate(get("body", lambda b: np.frombuffer(b, np.uint8)))
    at, offset = begin[rep], offset[rep]
    low = np.concatenate([least_documents(body, at[c], n[c], offset[c], least[c], length) for c in _whole_keys(key[rep])])
    w = np.cumsum(n) - n
    varies = np.maximum.reduceat(low, w) != np.minimum.reduceat(low, w)
    some = [m[varies[m]] for m in mine]
    return _replies(cells, kind, [zlib.compress(_by_plane(low[w[m]]), 1) for m in mine],
                    [zlib.compress(np.packbits(varies[m]).tobytes(), 1) for m in mine],
                    [zlib.compress(_by_plane(low[np.repeat(w[v], n[v]) + _within(n[v])]), 1) for v in some])


_CLEANED = "doc long, n_bytes long, n_removed long, n_spans long, kept binary, known boolean"


def _cover(cover: np.ndarray, e: Entries, answers: list[dict], length: int) -> None:
    """Adds, as differences, the bytes under the windows that start in a smaller document."""
    base, varies, low = [np.empty(0, np.int64)], [np.empty(0, bool)], [np.empty(0, np.int64)]
    for r in answers:
        base.append(_planes(zlib.decompress(r["a"]), np.int64))
        varies.append(np.unpackbits(np.frombuffer(zlib.decompress(r["b"]), np.uint8))[:len(base[-1])].astype(bool)
                      if r["b"] else np.zeros(len(base[-1]), bool))
        if r["c"]:
            low.append(_planes(zlib.decompress(r["c"]), np.int64))
    base, varies, low = np.concatenate(base), np.concatenate(varies), np.concatenate(low)
    if len(base) != len(e.e_key):
        raise RuntimeError("a block was dealt other documents than before: the input is not stable")
    # entries whose windows all have one least document
    all_ = np.flatnonzero(~varies[e.entry] & (base[e.entry] < e.doc))
    np.add.at(cover, e.at[all_], 1)
    np.add.at(cover, e.at[all_] + e.n[all_] + length - 1, -1)
    # the others, window by window
    skip = np.cumsum(np.where(varies, e.e_n, 0)) - np.where(varies, e.e_n, 0)
    some = np.flatnonzero(varies[e.entry])
    of, w = np.repeat(some, e.n[some]), _within(e.n[some])
    hit = low[skip[e.entry[of]] + w] < e.doc[of]
    at = e.at[of[hit]] + w[hit]
    np.add.at(cover, at, 1)
    np.add.at(cover, at + length, -1)


def _remove(length: int):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _no_rows(_CLEANED.replace(", known boolean", "")).append_column("known", pa.array([], pa.bool_()))
        block = Block(docs, length)
        f = block.f
        cover = np.zeros(len(f.bytes) + docs.num_rows, np.int32)
        for part, e in block.entries(_kinds_of(block, replies)).items():
            _cover(cover, e, _answers(replies, part), length)
        removed, spans, kept = [], [], []
        for i, (a, b) in enumerate(zip(f.begins.tolist(), f.ends.tolist(), strict=True)):
            gone = np.cumsum(cover[a + i:b + i]) > 0
            removed.append(int(gone.sum()))
            spans.append(int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum()))
            kept.append((f.bytes[a:b][~gone] if removed[-1] else f.bytes[a:b]).tobytes())
        return pa.table({
            "doc": docs.column("doc"), "n_bytes": pa.array(f.ends - f.begins), "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()), "kept": pa.array(kept, pa.binary()), "known": docs.column("known")})

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every document row without the bytes that an earlier document has too.

    A byte goes when it lies under a string of ``length`` bytes (at least 40)
    that also starts in a document with a smaller id; strings are judged on
    the input, overlaps count, and strings never cross documents.  Returns
    ``doc_id, n_bytes, n_removed, n_spans`` (maximal removed runs) and ``kept``
    (the remaining bytes).  Null text is empty; a null id comes after all
    others; rows with equal ids are not earlier than each other; other columns
    are ignored; an empty table gives no rows.
    """
    if length < 40:
        raise ValueError("strings of at least 40 bytes are looked for")
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    n = max(1, -(-size // block_bytes), min(shuffle_partitions(spark), -(-size // (block_bytes // 4))))
    # one exchange of the texts: every step below reads it again
    dealt = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.col("doc_id").isNotNull().alias("known"),
                        text_bytes().alias("body"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("block")
                        ).repartition(n, "block")
    keys = (dealt.groupBy("block").applyInArrow(_list_keys(length, n), _KEYS)
                 .repartition(n, "slice").groupBy("slice").applyInArrow(_judge_keys(hot), _REPLY).repartition(n, "block"))
    found = (dealt.groupBy("block").cogroup(keys.groupBy("block")).applyInArrow(_list_fragments(length, n), _FRAGMENTS)
                  .repartition(n, "slice").groupBy("slice").applyInArrow(_judge_fragments(length), _REPLY).repartition(n, "block"))
    return (dealt.groupBy("block").cogroup(keys.unionByName(found).groupBy("block")).applyInArrow(_remove(length), _CLEANED)
                 .select(F.when(F.col("known"), F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept"))

