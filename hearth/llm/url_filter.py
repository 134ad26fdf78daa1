"""URL filters: path rules first, then a blocked Bloom filter with an exact check.

A listed canonical URL is looked up in two steps.  A blocked Bloom filter
(each key sets ``BITS`` bits inside one 512-bit block) passes the possible
hits; an exact hash join with the list removes its false positives.  The
filter is itself a DataFrame, one row per block, so building it is a grouped
``bit_or`` and probing it is a join on the block number.  While its computed
size is under ``broadcast_bytes`` it is sent to the pages, and only the possible
hits leave their task for the exact join; beyond that size the distinct urls are
probed by a shuffled join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import checkpointed

#: 512-bit blocks held as eight longs; one bit of each long per key.
WORDS = 8
BITS_PER_KEY = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]   # (allow | block, host, path)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else ''."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a leading ``www.`` and path without ``.html`` or trailing slashes.

    Scheme, query and fragment are dropped.  Null without ``://``, so such
    urls never match a list.
    """
    host = F.regexp_replace(url_host(url), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(url_path(url), r"/+$", ""), r"\.html$", "")
    return F.when(F.contains(url, F.lit("://")), F.concat(host, path))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule's text and its verdict, both null if none fits.

    A rule fits its host and all subdomains if the path starts with the
    rule's; rules are a short configured list, folded into one expression.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, r_host, r_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == r_host) | F.endswith(host, F.lit(f".{r_host}"))) & F.startswith(path, F.lit(r_path))
        text = F.when(fits, F.lit(r_host + r_path)).otherwise(text)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return text, verdict


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(n_blocks))


def _words(key: Column) -> list[Column]:
    """One bit in each of the block's longs, six hash bits apiece."""
    h = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(WORDS)]


def bloom_blocks(listed: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """The filter: ``block`` and its longs ``w0`` ... ``w7``; blocks without keys have no row."""
    k = F.col(key)
    tagged = listed.where(k.isNotNull()).select(
        _block(k, n_blocks).alias("block"), *[w.alias(f"w{i}") for i, w in enumerate(_words(k))])
    return tagged.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def filter_blocks_for(n_keys: int) -> int:
    return max(1, -(-n_keys * BITS_PER_KEY // 512))


BROADCAST_BYTES = 32 << 20


def filter_bytes(n_blocks: int) -> int:
    return n_blocks * (WORDS + 1) * 8


def _passes(key: Column) -> Column:
    """Whether every bit of the key is set in the block beside it; false without a block."""
    passes = None
    for i, bit in enumerate(_words(key)):
        hit = F.col(f"w{i}").bitwiseAND(bit) != 0
        passes = hit if passes is None else passes & hit
    return F.coalesce(passes, F.lit(False))


def sifted(rows: DataFrame, blocks: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """The rows whose key the filter lets through; false positives among them."""
    return rows.withColumn("block", _block(F.col(key), n_blocks)).join(blocks, "block").where(_passes(F.col(key))).select(*rows.columns)


def listed_hits(candidates: DataFrame, listed: DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The distinct keys of ``candidates`` that ``listed`` holds.

    Null keys never match.  Candidates are first reduced to distinct keys, so
    a hot url is probed and joined once, with partial aggregation before the
    shuffle.
    """
    n_blocks = filter_blocks_for(listed.agg(F.count(key)).first()[0])   # one number
    blocks = bloom_blocks(listed, key, n_blocks)
    if filter_bytes(n_blocks) <= broadcast_bytes:
        blocks = F.broadcast(blocks)        # size computed above
    keys = candidates.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    return sifted(keys, blocks, key, n_blocks).join(listed.select(key), key, "left_semi")    # exact: no false positive stays


def with_hits(rows: DataFrame, listed: DataFrame, key: str, hit: str = "hit", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every row, with ``hit`` true where ``listed`` (distinct keys, already written) holds its key.

    Rows that the filter stops are not exchanged.  The possible hits are joined
    with the list itself, sent to them while its keys are under
    ``broadcast_bytes`` and dealt by key beyond (a hot key is split by the
    adaptive skew join).  Null keys are no hits; repeated rows stay.
    """
    n, size = listed.agg(F.count(key), F.coalesce(F.sum(F.octet_length(key)), F.lit(0))).first()   # two numbers
    n_blocks = filter_blocks_for(n)
    if filter_bytes(n_blocks) > broadcast_bytes:
        hits = listed_hits(rows, listed, key, broadcast_bytes).withColumn(hit, F.lit(True))
        return rows.join(hits, key, "left").withColumn(hit, F.coalesce(hit, F.lit(False)))
    blocks = checkpointed(bloom_blocks(listed, key, n_blocks))           # read by both branches
    probed = (rows.withColumn("block", _block(F.col(key), n_blocks)).join(F.broadcast(blocks), "block", "left")   # size computed above
                  .withColumn(hit, _passes(F.col(key))).drop("block", *[f"w{i}" for i in range(WORDS)]))
    names = listed.select(key, F.lit(True).alias("_held"))
    if size + 16 * n <= broadcast_bytes:
        names = F.broadcast(names)
    exact = (probed.where(F.col(hit)).join(names, key, "left").withColumn(hit, F.coalesce("_held", F.lit(False))).drop("_held"))
    return exact.unionByName(probed.where(~F.col(hit)))


def shared_addresses(pages: DataFrame, url: str = "url") -> DataFrame:
    """The canonical urls that more than one page row claims: ``canonical``."""
    return (pages.select(canonical(F.col(url)).alias("canonical")).where("canonical IS NOT NULL")
                 .groupBy("canonical").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("canonical"))


def url_verdicts(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (), url: str = "url",
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Judge every page row: the longest fitting rule's verdict, else block what ``listed`` holds.

    ``pages``: ``page_id`` and the url column (others are ignored).
    ``listed``: ``canonical``, the canonical urls to block (repeats and nulls
    do no harm).  Returns ``page_id, host, path, rule, verdict, listed``; a
    null url or one without ``://`` has empty host and path, fits no rule and
    is allowed.  Repeated rows are each judged; an empty list blocks nothing.
    """
    host, path = url_host(F.col(url)), url_path(F.col(url))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = (pages.select("page_id", host.alias("host"), path.alias("path"), canonical(F.col(url)).alias("canonical"))
                   .withColumn("rule", rule).withColumn("rule_verdict", verdict))
    listed = checkpointed(listed.select("canonical").where("canonical IS NOT NULL").distinct())   # read three times
    return (with_hits(judged, listed, "canonical", "hit", broadcast_bytes)
            .select("page_id", "host", "path", "rule",
                    F.coalesce("rule_verdict", F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"),
                    F.col("hit").alias("listed")))
