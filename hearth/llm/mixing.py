"""Mixing sources to target weights by systematic sampling.

Every source gets a target number of words; each of its documents is expected
``target / source size`` times.  Documents are put in order (by size, so the
draw is even over sizes), their expected copies are prefix-summed within the
source, one random offset per source is added, and a document is emitted once
per integer boundary that its stretch of the sum crosses.

All documents of a source expect the same number of copies, so the prefix sum
of the document with rank ``k`` is ``k * rate``: only a rank within the source
is needed.  Ranks come from a range-partitioned numbering (no window over a
whole source), so a source with a third of all rows is spread over all tasks.
The sums are decimals, so neither partitioning nor task order changes a draw.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import checkpointed, row_hash, stored
from hearth.operators.keys import assign_key

CAP = 3               # no document is taken more often than this
SMALL_SOURCES = 100_000   # so many source rows (a name and four numbers each) are broadcast, more are joined by shuffle
RATE = "decimal(38,12)"


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text, null as 0."""
    pieces = F.split(text, r"[\x20\x09-\x0D]+")
    return F.coalesce(F.size(F.array_remove(pieces, "")).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = CAP) -> DataFrame:
    """Target words per source, from one row per source: ``source, source_size``.

    Sources in code point order, null last, weigh ``weights`` in turn and
    share the total size by weight; a target stops at ``cap`` times its
    source's size and the excess is shared again among the rest until none is
    above.  Adds ``target double``.  Each round is one aggregate; only its
    three totals reach the driver.
    """
    ranked = assign_key(sizes, [F.col("source").isNull(), F.col("source").cast("binary")], "_rank", start=0)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = checkpointed(ranked.withColumn("_w", weight.cast("long")))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = None      # words per unit of weight; a source is capped when level * weight exceeds its cap
    limit = F.col("source_size") * cap
    while True:
        full = F.lit(False) if level is None else F.lit(level) * F.col("_w") > limit
        capped, free = ranked.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("_w"))), F.lit(0))).first()
        if not free:
            break
        new = (total - capped) / free
        if new == level:
            break
        level = new
    target = limit.cast("double") if level is None else F.least(F.lit(level) * F.col("_w"), limit.cast("double"))
    return ranked.select("source", "source_size", target.alias("target"))


def offset(source: Column, seed: int) -> Column:
    """The source's one random offset in [0, 1), fixed by the seed."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(2.0 ** 32)).cast(RATE)


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = CAP, seed: int = 17) -> DataFrame:
    """How often each document is taken so that its source meets its target.

    Reads ``doc_id``, ``source`` and ``text``; other columns are ignored.  One
    row per document row: ``doc_id, source, size`` (words), ``source_size``,
    ``target, copies, taken`` (``copies * size``).  Null sources are one
    source; null, empty and blank texts have size 0 and are never taken; a
    source of size 0 has target 0.  Repeated rows are separate documents and
    are drawn separately; an empty table gives no rows.  The seed fixes the draw.
    """
    return _draw(docs.select("doc_id", "source", "text"), [], weights, cap, seed).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _draw(docs: DataFrame, ties: list[str], weights: Sequence[int] = (1, 2, 3), cap: int = CAP, seed: int = 17) -> DataFrame:
    """The draws of ``mix`` with the columns ``ties``, which put rows equal in id, source and text in order."""
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_hash"), *ties)
    # ranked within the source: by size, then id, then text; repeated rows take neighbouring ranks
    numbered = assign_key(sized, [F.col("source").isNull(), F.col("source").cast("binary"), "size", "doc_id", "_hash", *ties], "_key")
    stats = checkpointed(numbered.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("_key").alias("_first")))
    targets = source_targets(stats.select("source", "source_size"), weights, cap)
    rated = (targets.join(stats.select(F.col("source").alias("_src"), "_first"), F.expr("source <=> _src")).drop("_src")
                    .withColumn("_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                                .otherwise(F.lit(0.0)).cast(RATE))
                    .withColumn("_u", offset(F.col("source"), seed))
                    .withColumnRenamed("source", "_src"))
    if stats.count() <= SMALL_SOURCES:
        rated = F.broadcast(rated)          # so a hot source's documents stay where they are
    rank = (F.col("_key") - F.col("_first")).cast("decimal(20,0)")
    before = F.floor((rank * F.col("_rate")).cast(RATE) + F.col("_u"))
    after = F.floor(((rank + 1) * F.col("_rate")).cast(RATE) + F.col("_u"))
    return (numbered.join(rated, F.expr("source <=> _src"))
                    .withColumn("copies", F.when(F.col("size") > 0, after - before).otherwise(F.lit(0)).cast("long"))
                    .select("doc_id", "source", "size", "source_size", "target", "copies", *ties))


def take(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves: every row as often as the mix takes it, all columns kept.

    Documents taken zero times are left out, so this is a sampling operator;
    repeats are equal rows.  Every row has its own draw: rows without an id, or
    with a repeated one, too.  The rows are written once, which fixes the number
    that carries a row's draw back to it; rows equal in id, source and text are
    drawn in the order of the hash of all columns.
    """
    rows = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), row_hash(docs).alias("_all"),
                              F.monotonically_increasing_id().alias("_at")), "mixed")
    n = (_draw(rows.select("_row.doc_id", "_row.source", "_row.text", "_all", "_at"), ["_all", "_at"], **options)
         .where("copies > 0").select("_at", F.col("copies").alias("_n")))
    return (rows.join(n, "_at").withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
                .select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns]))
