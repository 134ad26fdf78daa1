"""SentencePiece encoding and decoding by vectorised merge rounds.

A byte-pair model joins, again and again, the pair of neighbouring symbols
whose piece has the best score, the leftmost of equals, until no pair is a
piece.  Here all words of a batch are joined at once, in rounds over flat numpy
arrays: every word's best pair rank is one segmented minimum, all its
occurrences are joined together from the left, and what is finished leaves the
arrays.  A round that would bring forth a pair as good as the one being joined
joins only the leftmost occurrence in that word, so the order is exactly the
one of pair by pair.

Words never touch each other: texts are cut where two characters meet that no
piece holds side by side, so a text without blanks has short words as well.

Models: byte-pair pieces with byte fallback, no normalisation, blanks written
as U+2581 and one put before the text.  Others are refused.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import bound_batches

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
NONE = np.int32(2**31 - 1)            # rank of a pair that is no piece
#: Distinct words and their characters that a task keeps between batches.
KEPT_WORDS, KEPT_CHARS = 400_000, 16 << 20
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6      # fixed values: piece types of the model file


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message."""
    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[i]
            value |= (byte & 127) << shift
            i, shift = i + 1, shift + 7
            if byte < 128:
                return value, i

    i = 0
    while i < len(data):
        key, i = varint(i)
        if key & 7 == 0:
            value, i = varint(i)
        else:
            size, i = varint(i) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], i)
            value, i = data[i:i + size], i + size
        yield key >> 3, value


@dataclass
class Model:
    """A model as arrays.  Symbols are numbers: the pieces' ids, above them characters that are no piece."""

    chars: np.ndarray          # sorted code points that pieces hold
    char_symbol: np.ndarray    # the symbol of each
    adjacent: np.ndarray       # sorted: place of a character * len(chars) + place of the one after it, for all inside pieces
    pair_key: np.ndarray       # sorted: left symbol * n_symbols + right symbol
    pair_rank: np.ndarray      # rank of the joined piece, equal for equal scores
    pair_joined: np.ndarray    # its symbol
    n_symbols: int
    byte_id: np.ndarray        # id of each of the 256 byte pieces
    unknown_id: int
    end_id: int
    apart: bool                # no piece holds a blank after another character: texts can be cut there
    blank_block: int           # blanks of the longest blank piece, if runs may be cut into such blocks; else 0
    piece_bytes: np.ndarray    # what each id decodes to, joined
    piece_start: np.ndarray    # and where each begins (one more at the end)


def read_model(path: str | None = None) -> Model:
    """The model file as arrays; its size is fixed, it is read on the driver."""
    with open(path or model_path(), "rb") as f:
        top = list(_fields(f.read()))
    trainer = dict(_fields(next(v for k, v in top if k == 2)))
    normal = dict(_fields(next(v for k, v in top if k == 3)))
    pieces, scores, kinds = [], [], []
    for number, value in top:
        if number == 1:
            piece = dict(_fields(value))
            pieces.append(piece[1].decode())
            scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
            kinds.append(piece.get(3, _NORMAL))
    if trainer.get(3, 1) != 2 or not trainer.get(35, 0) or set(kinds) - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
        raise ValueError("not a byte-pair model with byte fallback and without user-defined pieces")
    if normal.get(2, b"") or not normal.get(3, 1) or normal.get(4, 1) or not normal.get(5, 1) or trainer.get(24, 0):
        raise ValueError("the model changes texts otherwise than by one blank before them")
    symbol = {p: i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == _NORMAL}
    joinable = list(symbol)
    for c in sorted({c for p in joinable for c in p} - symbol.keys()):
        symbol[c] = len(pieces) + len(symbol)
    n = max(symbol.values()) + 1
    order = {s: r for r, s in enumerate(sorted({scores[symbol[p]] for p in joinable}, reverse=True))}
    pairs, chars = {}, sorted({ord(c) for p in joinable for c in p})
    place, adjacent = {chr(c): i for i, c in enumerate(chars)}, set()
    for p in joinable:
        adjacent.update(place[a] * len(chars) + place[b] for a, b in zip(p, p[1:], strict=False))
        for i in range(1, len(p)):
            left, right = symbol.get(p[:i]), symbol.get(p[i:])
            if left is not None and right is not None:
                pairs[left * n + right] = (order[scores[symbol[p]]], symbol[p])
    keys = np.array(sorted(pairs), np.int64)
    byte_id = np.zeros(256, np.int32)
    for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)):
        if k == _BYTE:
            byte_id[int(p[3:5], 16)] = i
    shown = [p.replace(BLANK, " ").encode() if k == _NORMAL else bytes([int(p[3:5], 16)]) if k == _BYTE
             else trainer.get(44, b" \xe2\x81\x87 ") if k == _UNKNOWN else b"" for p, k in zip(pieces, kinds, strict=True)]
    model = Model(
        chars=np.array(chars, np.int64), char_symbol=np.array([symbol[chr(c)] for c in chars], np.int32),
        adjacent=np.array(sorted(adjacent), np.int64), pair_key=keys,
        pair_rank=np.array([pairs[k][0] for k in keys.tolist()], np.int32),
        pair_joined=np.array([pairs[k][1] for k in keys.tolist()], np.int32), n_symbols=n, byte_id=byte_id,
        unknown_id=kinds.index(_UNKNOWN), end_id=trainer.get(42, 2), apart=not any(BLANK in p.lstrip(BLANK) for p in joinable), blank_block=0,
        piece_bytes=np.frombuffer(b"".join(shown), np.uint8), piece_start=np.cumsum([0] + [len(s) for s in shown]))
    runs = [p for p in joinable if len(p) > 1 and not p.strip(BLANK)]
    if runs and model.apart and not any(BLANK in p[1:] for p in joinable if p.strip(BLANK)) \
            and {order[scores[symbol[p]]] for p in runs} == {len(order) - 1}:
        model.blank_block = _blank_block(model, max(map(len, runs)))
    return model


def _blank_block(model: Model, longest: int) -> int:
    """``longest`` if blanks alone always make blocks of that length from the left; else 0.

    Asked where blanks join last and leftmost first: once the first block is whole
    it joins nothing more, so what follows is a run of its own.  The last
    blank of a run may join what comes after it, and is left out of the blocks.
    """
    def lengths(n: int) -> list[int]:
        at = merge_rounds(model, np.full(n, model.char_symbol[model.chars == ord(BLANK)][0]), np.zeros(1, np.int64))[1]
        return np.diff(np.r_[at, n]).tolist()

    return longest if all(lengths(longest + n) == [longest, *lengths(n)] for n in range(1, 2 * longest + 1)) else 0


def _pair_at(model: Model, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank (``NONE`` if no piece) and joined symbol of each pair of symbols; unknown ones are -1."""
    key = left.astype(np.int64) * model.n_symbols + right
    at = np.minimum(np.searchsorted(model.pair_key, key), len(model.pair_key) - 1)
    found = (model.pair_key[at] == key) & (left >= 0) & (right >= 0)
    return np.where(found, model.pair_rank[at], NONE), model.pair_joined[at]


def merge_rounds(model: Model, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join the symbols of every word until no pair is a piece.

    ``starts``: where each (non-empty) word begins.  Returns the symbols left
    and the place in the input at which each begins, in input order.
    """
    sym, at = symbols.astype(np.int32), np.arange(len(symbols))
    done_sym, done_at = [], []
    if not len(sym) or not len(model.pair_key):
        return sym, at
    rank, joined = np.full(len(sym), NONE), np.zeros(len(sym), np.int32)
    rank[:-1], joined[:-1] = _pair_at(model, sym[:-1], sym[1:])
    rank[starts[1:] - 1] = NONE
    while True:
        best = np.minimum.reduceat(rank, starts)
        lengths = np.diff(np.r_[starts, len(sym)])
        if (best == NONE).any():                           # compaction: finished words leave
            live = np.repeat(best != NONE, lengths)
            done_sym.append(sym[~live])
            done_at.append(at[~live])
            sym, at, rank, joined = sym[live], at[live], rank[live], joined[live]
            best, lengths = best[best != NONE], lengths[best != NONE]
            starts = np.cumsum(lengths) - lengths
            if not len(sym):
                break
        word = np.repeat(np.arange(len(starts)), lengths)
        pick = np.flatnonzero(rank == best[word])
        # of overlapping occurrences every other one, from the left
        fresh = np.r_[True, np.diff(pick) != 1]
        run = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        pick = pick[(np.arange(len(pick)) - run) % 2 == 0]
        # the pairs seen when an occurrence is joined and those right of it are not yet
        new, of = joined[pick], word[pick]
        after = np.minimum(pick + 2, len(sym) - 1)
        right = np.where((pick + 2 < len(sym)) & (word[after] == of), sym[after], -1)
        before = np.maximum(pick - 1, 0)
        left = np.where((pick > 0) & (word[before] == of), sym[before], -1)
        touching = np.flatnonzero(np.diff(pick) == 2) + 1
        touching = touching[of[touching] == of[touching - 1]]
        left[touching] = new[touching - 1]
        r_left, _ = _pair_at(model, left, new)
        r_right, _ = _pair_at(model, new, right)
        early = (r_left <= best[of]) | (r_right <= best[of])
        if early.any():                                    # such words take their leftmost occurrence alone
            alone = np.zeros(len(starts), bool)
            alone[of[early]] = True
            first = np.r_[True, of[1:] != of[:-1]]
            keep = first | ~alone[of]
            pick, new, of = pick[keep], new[keep], of[keep]
        sym[pick] = new
        left_over = np.ones(len(sym), bool)
        left_over[pick + 1] = False
        place = np.cumsum(left_over) - 1
        sym, at, rank, joined, word = sym[left_over], at[left_over], rank[left_over], joined[left_over], word[left_over]
        starts = np.searchsorted(word, np.arange(len(starts)))
        pick = place[pick]
        stale = np.zeros(len(sym), bool)
        stale[pick] = True
        stale[pick[pick > 0] - 1] = True
        changed = np.flatnonzero(stale)
        inner = changed[changed + 1 < len(sym)]
        inner = inner[word[inner + 1] == word[inner]]
        rank[changed] = NONE
        rank[inner], joined[inner] = _pair_at(model, sym[inner], sym[inner + 1])
    sym, at = np.concatenate(done_sym), np.concatenate(done_at)
    order = np.argsort(at, kind="stable")
    return sym[order], at[order]


def encode_words(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words (blanks as U+2581), joined, and the number of ids of each word."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ends = np.cumsum([len(w) for w in words])
    if not len(flat):
        return np.empty(0, np.int32), np.zeros(len(words), np.int64)
    place = np.minimum(np.searchsorted(model.chars, flat), len(model.chars) - 1)
    known = model.chars[place] == flat
    # cut between words, and where two characters meet that no piece holds side by side
    beside = place[:-1] * len(model.chars) + place[1:]
    seen = np.minimum(np.searchsorted(model.adjacent, beside), len(model.adjacent) - 1)
    cut = np.r_[True, ~((model.adjacent[seen] == beside) & known[:-1] & known[1:])]
    cut[ends[ends < len(flat)]] = True
    if model.blank_block:
        _cut_blanks(flat == ord(BLANK), cut, model.blank_block)
    sym, at = merge_rounds(model, np.where(known, model.char_symbol[place], -1), np.flatnonzero(cut))
    # characters that are no piece become their bytes
    bare = np.flatnonzero((sym < 0) | (sym >= len(model.piece_start) - 1))
    if len(bare):
        raw = [chr(c).encode("utf-8", "replace") for c in flat[at[bare]].tolist()]
        size = np.ones(len(sym), np.int64)
        size[bare] = [len(r) for r in raw]
        sym, at, is_byte = np.repeat(sym, size), np.repeat(at, size), np.repeat(np.isin(np.arange(len(size)), bare), size)
        sym[is_byte] = model.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
    counts = np.diff(np.searchsorted(at, np.r_[0, ends]))
    return sym, counts


def _cut_blanks(blank: np.ndarray, cut: np.ndarray, block: int) -> None:
    """Mark the whole blocks of each run of blanks; the last blank of a run stays out of them."""
    edge = np.flatnonzero(np.diff(np.r_[False, blank, False].astype(np.int8)))
    # a run also ends where words meet
    for a, b in edge.reshape(-1, 2)[np.diff(edge.reshape(-1, 2), axis=1)[:, 0] > block].tolist():
        inner = np.flatnonzero(cut[a:b]) + a
        for s, e in zip(np.r_[a, inner].tolist(), np.r_[inner, b].tolist(), strict=True):
            cut[s + block:e:block] = True


def decode_ids(model: Model, ids: np.ndarray) -> str:
    """The text of one list of ids: the blank put before it goes, bytes that are no text become U+FFFD each."""
    return decode_lists(model, np.asarray(ids, np.int64), np.array([len(ids)]))[0]


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


def decode_lists(model: Model, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """The texts of many lists of ids, given joined."""
    codecs.register_error("each-byte", _each_byte)
    size = np.diff(model.piece_start)[ids]
    ends = np.cumsum(size)
    flat = model.piece_bytes[np.arange(ends[-1] if len(ends) else 0) + np.repeat(model.piece_start[ids] - ends + size, size)]
    last = np.r_[0, np.cumsum(counts)]
    at = np.r_[0, ends][last]
    whole, out = flat.tobytes(), []
    # the first id that shows anything loses its blank, if it is a piece
    shown = np.r_[np.flatnonzero(size), len(ids)]
    first = shown[np.searchsorted(shown, last[:-1])]
    strip = np.zeros(len(counts), bool)
    some = np.flatnonzero(first < last[1:])
    strip[some] = ~np.isin(ids[first[some]], np.r_[model.byte_id, model.unknown_id]) & (flat[at[:-1][some]] == 32)
    # bytes on either side of an id that shows nothing make no character together
    gaps = np.flatnonzero((size[:-1] == 0) & ~np.isin(np.arange(1, len(ids)), last)) if len(ids) else np.empty(0, np.int64)
    inner = np.searchsorted(gaps, last)
    for k, (a, b, s) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strip.tolist(), strict=True)):
        parts = [a + s, *np.maximum(ends[gaps[inner[k]:inner[k + 1]]], a + s).tolist(), b]
        out.append("".join(whole[x:y].decode("utf-8", "each-byte") for x, y in zip(parts, parts[1:], strict=False)))
    return out


class Encoder:
    """Encodes texts; the words met are kept, up to a bound, between batches."""

    _WORD = re.compile(f"{BLANK}+[^{BLANK}]*")

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self._place: dict[str, int] = {}
        self._ids, self._counts, self._chars = np.empty(0, np.int32), np.empty(0, np.int64), 0

    def words(self, text: str) -> list[str]:
        """The text cut before each run of blanks, if no piece holds a blank after another character."""
        if not text:
            return []
        text = BLANK + text.replace(" ", BLANK)
        return self._WORD.findall(text) if self.model.apart else [text]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id, joined; and the number of ids of each."""
        if len(self._place) > KEPT_WORDS or self._chars > KEPT_CHARS:
            self._clear()
        place, n_words, index, fresh = self._place, [], [], []
        known = len(place)
        for text in texts:
            words = self.words(text)
            index += [place.setdefault(w, len(place)) for w in words]
            n_words.append(len(words))
        fresh = list(place)[known:] if len(place) > known else []
        if fresh:
            ids, counts = encode_words(self.model, fresh)
            self._ids, self._counts = np.r_[self._ids, ids], np.r_[self._counts, counts]
            self._chars += sum(map(len, fresh))
        at = np.array(index, np.int64)
        size = self._counts[at]
        begin = (np.cumsum(self._counts) - self._counts)[at]
        ends = np.cumsum(size)
        flat = self._ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)]
        words_end = np.cumsum(n_words)
        text_end = np.r_[0, ends][words_end]
        return np.insert(flat, text_end, self.model.end_id), np.diff(np.r_[0, text_end]) + 1


def encode_decode(docs: DataFrame, model: str | None = None, text: str = "text") -> DataFrame:
    """``doc_id, ids`` (with the end id) and ``decoded`` of every document row's whole text.

    ``model``: path of the model file on the driver.  Null texts count as
    empty: the end id alone, decoded to the empty text.  Texts of any length
    and of any characters are taken whole; repeated rows are each encoded; other
    columns are ignored; an empty table gives no rows.  A map without a shuffle.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model))     # fixed size: the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [b.decode("utf-8", "replace") if b else "" for b in batch.column(1).to_pylist()]
            ids, counts = encoder.encode(texts)
            offsets = pa.array(np.r_[0, np.cumsum(counts)], pa.int32())
            yield pa.record_batch({"doc_id": batch.column(0), "ids": pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                                   "decoded": pa.array(decode_lists(shared.value, ids.astype(np.int64), counts), pa.string())})

    rows = docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")
