"""Line dedup by a deletion-neighbourhood join.

Lines are sequences of words; two lines are near when one word edit
(replaced, added or left out) or none makes them equal.  Every line that can
have a partner emits its deletion neighbourhood, the line less each one of its
words, as hashed keys.  Equal keys join: lines that lose a word at the same
place differ by a replacement, a line equal to another's variant differs by an
addition.  The earliest partner is verified on the words themselves, and only
the earliest line is kept.

Two steps keep the join small without losing a pair.  Equal lines are first
reduced to one.  And as one edit leaves either the first or the last half of
the shorter line untouched, only lines that share such a half with another
line emit variants.  Variants are hashed in constant time each from prefix
sums, groups are reduced to their earliest line by partial aggregation, and no
pairs within a group are formed.

Every row has its own place, ``doc, rep, line``: its id (null after all
others), the hash of its text, and the line number, so rows without an id or
with a repeated one stay apart.  Rows equal in id and text are told apart
beforehand: one of them stands for the text, every line of the others repeats it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import BROADCAST_ROWS, U64, bound_batches, broadcast_if_small, mix64, row_hash, signed, stored, text_bytes

MIN_WORDS = 5             # shorter lines are only matched exactly
BLANKS = " \t\n\r\x0b\x0c"
CHUNK_BYTES = 2 << 20     # text hashed at once
LAST = (1 << 63) - 1      # the place of a document without an id: after all others
#: Odd multipliers of the two polynomial hashes and their inverses modulo 2^64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)


class Hashes:
    """Hashes of any run of words in constant time, for two bases."""

    def __init__(self, words: list[bytes]):
        w = mix64(np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words)), 1)
        self.sums, self.powers = [], []
        with np.errstate(over="ignore"):
            for base, inverse in zip(_BASES, _INVERSES, strict=True):
                down = np.cumprod(np.r_[U64(1), np.full(len(words), inverse, U64)])[:-1]
                self.sums.append(np.r_[U64(0), np.cumsum(w * down)])
                self.powers.append(np.cumprod(np.r_[U64(1), np.full(len(words), base, U64)]))

    def run(self, k: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The hash, by base ``k``, of words ``a`` to ``b`` (exclusive); 0 for none."""
        with np.errstate(over="ignore"):
            return np.where(b > a, (self.sums[k][b] - self.sums[k][a]) * self.powers[k][np.maximum(b - 1, 0)], U64(0))

    def without(self, k: int, a: int, b: int, at: np.ndarray) -> np.ndarray:
        """The hashes, by base ``k``, of words ``a`` to ``b`` less the word ``at``, for each ``at``."""
        with np.errstate(over="ignore"):
            return self.run(k, np.full(len(at), a), at) * self.powers[k][b - 1 - at] + self.run(k, at + 1, np.full(len(at), b))


def _halves(h: Hashes, a: np.ndarray, b: np.ndarray, short: np.ndarray) -> list[np.ndarray]:
    """Keys of the first and of the last half when the shorter line has ``short`` words."""
    first = short // 2
    with np.errstate(over="ignore"):
        return [mix64(h.run(0, a, a + first) + short.astype(U64), 2), mix64(h.run(0, b - (short - first), b) + short.astype(U64), 3)]


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line with a word: its place, length, two hashes, and the keys of its halves."""
    for batch in batches:
        docs, reps, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
        i = 0
        while i < len(docs):
            words, ends, place, size = [], [], [], 0
            while i < len(docs) and (not size or size < CHUNK_BYTES):
                raw = texts[i].as_py()
                size += len(raw) + 1
                for n, line in enumerate(raw.split(b"\n")):
                    got = line.split()
                    if got:
                        words += got
                        ends.append(len(words))
                        place.append((docs[i], reps[i], n))
                i += 1
            if not ends:
                continue
            h, b = Hashes(words), np.array(ends)
            a = np.r_[0, b[:-1]]
            n = b - a
            keys = _halves(h, a, b, n) + _halves(h, a, b, np.maximum(n - 1, 0))
            doc, rep, line = zip(*place, strict=True)
            yield pa.record_batch({
                "doc": pa.array(doc, pa.int64()), "rep": pa.array(rep, pa.int64()), "line": pa.array(line, pa.int32()), "n": pa.array(n.astype(np.int32)),
                "h1": pa.array(signed(h.run(0, a, b))), "h2": pa.array(signed(h.run(1, a, b))),
                **{f"k{j}": pa.array(signed(k)) for j, k in enumerate(keys)}})


_LINE = "doc long, rep long, line int, n int, h1 long, h2 long, k0 long, k1 long, k2 long, k3 long"
_VARIANT = "r1 long, r2 long, pos int, doc long, rep long, line int, words binary"


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each wanted line whole (``pos`` -1, with its words) and less each one of its words."""

    def packed(rows):
        r1, r2, pos, doc, rep, line, words = zip(*rows, strict=True)
        n = [len(p) for p in pos]
        text = [x for w, k in zip(words, n, strict=True) for x in [w, *[None] * (k - 1)]]
        return pa.record_batch({
            "r1": pa.array(signed(np.concatenate(r1))), "r2": pa.array(signed(np.concatenate(r2))),
            "pos": pa.array(np.concatenate(pos).astype(np.int32)), "doc": pa.array(np.repeat(np.array(doc, np.int64), n)),
            "rep": pa.array(np.repeat(np.array(rep, np.int64), n)), "line": pa.array(np.repeat(np.array(line, np.int32), n)), "words": pa.array(text, pa.binary())})

    rows, size = [], 0
    for batch in batches:
        for doc, rep, raw, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(),
                                         strict=True):
            lines = raw.as_py().split(b"\n") if wanted else []
            for n in wanted or ():
                words = lines[n].split()
                h, at = Hashes(words), np.arange(len(words))
                whole = [h.run(k, np.array([0]), np.array([len(words)])) for k in (0, 1)]
                rows.append((np.r_[whole[0], h.without(0, 0, len(words), at)], np.r_[whole[1], h.without(1, 0, len(words), at)],
                             np.r_[-1, at], doc, rep, n, b" ".join(words)))
                size += len(words) + 1
                if size > 50_000:
                    yield packed(rows)
                    rows, size = [], 0
    if rows:
        yield packed(rows)


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether at most one word replaced, added or left out makes the lines equal."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [within_one(a.split(), b.split()) for a, b in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
        yield batch.filter(pa.array(ok, pa.bool_())).select([0, 1, 2])


def _rows(docs: DataFrame) -> DataFrame:
    """``_row`` (all columns), ``doc``, ``rep`` and ``copy``: whether the row repeats another's id and text.

    Of rows equal in id and text one is no copy: the least by the hash of all
    columns.  Only such rows are written; their running number is fixed there.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text_bytes()).alias("rep"),
                       row_hash(docs).alias("_hash"))
    twice = stored(rows.groupBy("doc", "rep").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc", "rep"), "twice")
    if twice.isEmpty():
        return rows.select("_row", "doc", "rep", F.lit(False).alias("copy"))
    small = broadcast_if_small(twice)
    several = stored(rows.join(small, ["doc", "rep"], "left_semi").withColumn("_i", F.monotonically_increasing_id()), "copies")
    first = several.groupBy("doc", "rep").agg(
        F.min(F.struct(F.col("_row.doc_id").isNull().alias("n"), F.col("_hash").alias("h"), F.col("_i").alias("i"))).alias("f")
        ).select(F.col("f.i").alias("_i"), F.lit(False).alias("copy"))
    return rows.join(small, ["doc", "rep"], "left_anti").select("_row", "doc", "rep", F.lit(False).alias("copy")).unionByName(
        several.join(first, "_i", "left").select("_row", "doc", "rep", F.coalesce("copy", F.lit(True)).alias("copy")))


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The lines to drop: ``doc, rep, line`` (``doc`` is the id, or ``LAST`` for null; ``rep`` the hash of the text; lines from 0).

    A line is dropped when an earlier line of the corpus, by document id, then
    text hash, then line number, has the same words, or, both having at least
    ``min_words``, is one word edit away.  Earlier lines count whether or not
    they are dropped themselves.  Words are runs of ASCII non-blanks; lines
    without words are never dropped.  Rows equal in id and text are one here;
    ``line_report`` and ``dedup_lines`` drop every line with words of all but
    one of them.
    """
    return _repeated(_rows(docs), min_words)


def _repeated(rows: DataFrame, min_words: int) -> DataFrame:
    texts = rows.where("NOT copy").select("doc", "rep", text_bytes("_row.text").alias("body"))
    lines = stored(texts.mapInArrow(_lines, _LINE), "lines")
    place = F.struct("doc", "rep", "line")
    distinct = stored(lines.groupBy("h1", "h2", "n").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("times"), *[F.first(f"k{j}").alias(f"k{j}") for j in range(4)]), "distinct")
    # exact: later places of a line that occurs more than once
    again = (lines.select("h1", "h2", "n", "doc", "rep", "line")
                  .join(broadcast_if_small(distinct.where("times > 1").select("h1", "h2", "n", "first")), ["h1", "h2", "n"])
                  .where(place > F.col("first")).select("doc", "rep", "line"))

    # lines that share a half with another line
    keyed = distinct.where(F.col("n") >= min_words).select("first", F.explode(F.array(
        *[F.struct((F.col("n") - (j // 2)).alias("short"), F.col(f"k{j}").alias("key")) for j in range(4)])).alias("half")
        ).select("first", "half.short", "half.key")
    shared = stored(keyed.groupBy("short", "key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("short", "key"), "halves")
    wanted = stored(keyed.join(broadcast_if_small(shared), ["short", "key"], "left_semi").groupBy("first.doc", "first.rep")
                    .agg(F.sort_array(F.collect_set("first.line")).alias("wanted")), "wanted")
    few = wanted.agg(F.coalesce(F.sum(F.size("wanted")), F.lit(0))).first()[0] <= BROADCAST_ROWS      # its size is its lines
    bodies = texts.join(F.broadcast(wanted) if few else wanted, ["doc", "rep"]).select("doc", "rep", "body", "wanted")
    variants = stored(bodies.mapInArrow(_variants, _VARIANT), "variants")

    whole = variants.where("pos = -1").select("r1", "r2", place.alias("whole"))
    less = variants.where("pos >= 0").select("r1", "r2", "pos", place.alias("at"))
    earliest = stored(less.groupBy("r1", "r2", "pos").agg(F.min("at").alias("e"), F.max("at").alias("l")).where("e < l").drop("l"), "earliest")
    replaced = less.join(broadcast_if_small(earliest), ["r1", "r2", "pos"]).where("e < at").select("at", "e")
    # a variant equals at most one whole line, so this join does not grow
    added = less.join(broadcast_if_small(whole), ["r1", "r2"]).select("at", "whole")
    links = (replaced.unionByName(added.where("whole < at").select("at", F.col("whole").alias("e")))
                     .unionByName(added.where("at < whole").select(F.col("whole").alias("at"), F.col("at").alias("e"))))
    best = stored(links.groupBy("at").agg(F.min("e").alias("e")), "best")
    words = variants.where("pos = -1").select(place.alias("whole"), "words")
    near = (best.join(words.select(F.col("whole").alias("at"), F.col("words").alias("a")), "at")
                .join(words.select(F.col("whole").alias("e"), F.col("words").alias("b")), "e")
                .select("at.doc", "at.rep", "at.line", "a", "b").mapInArrow(_verify, "doc long, rep long, line int"))
    return again.unionByName(near)


def line_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_removed, removed`` (line numbers from 0, ascending).

    Null text has no lines, empty text one empty line.
    """
    rows = _rows(docs)
    gone = _repeated(rows, min_words).groupBy("doc", "rep").agg(F.sort_array(F.collect_set("line")).alias("_gone"))
    split = F.split("_row.text", "\n")
    with_words = F.filter(F.transform(split, lambda x, i: F.when(x.rlike(r"[^\x20\x09-\x0D]"), i)), lambda i: i.isNotNull())
    return (rows.withColumn("_n", F.coalesce(F.size(split), F.lit(0)))
                .withColumn("_all", F.when(F.col("copy"), with_words))
                .select(F.col("_row.doc_id").alias("doc_id"), "doc", "rep", "copy", "_n", "_all")
                .join(gone, ["doc", "rep"], "left")
                .withColumn("_gone", F.when(F.col("copy"), F.col("_all")).otherwise(F.col("_gone")))
                .select("doc_id", F.greatest("_n", F.lit(0)).cast("long").alias("n_lines"),
                        F.greatest(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
                        F.coalesce("_gone", F.array().cast("array<int>")).alias("removed")))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The document rows without their repeated lines; all columns kept, ``text`` rebuilt.

    A row all of whose lines with words were dropped goes; rows that lost
    nothing stay as they were, null and empty texts among them.
    """
    rows = _rows(docs)
    gone = _repeated(rows, min_words).groupBy("doc", "rep").agg(F.collect_set("line").alias("_gone"))
    joined = rows.join(gone, ["doc", "rep"], "left").select("_row", "_gone", F.col("_row.text").alias("_text"), "copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, stay = [], []
            for gone_lines, text, copy in zip(*[batch.column(i).to_pylist() for i in (1, 2, 3)], strict=True):
                if copy:        # all its lines with words, or nothing
                    gone_lines = (text or "").strip(BLANKS)
                    text = "" if gone_lines else text
                elif gone_lines:
                    drop = set(gone_lines)
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
                out.append(text)
                stay.append(not gone_lines or bool(text.strip(BLANKS)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), batch.column(3)], names=batch.schema.names).filter(pa.array(stay, pa.bool_()))

    cleaned = joined.mapInArrow(run, joined.schema)
    return cleaned.select(*[(F.col("_text") if c == "text" else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
