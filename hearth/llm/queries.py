"""The registered queries ``opN_<name>`` of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import ann, collocations, decontaminate, langid, line_dedup, lm, mixing, ngram_join, pieces, suffix_dedup, token_counts, url_filter, whitening
from hearth.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- 1: approximate nearest neighbours ---------------------------------------------------------------------------

@_query
def op1_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors found for every vec_id divisible by 100."""
    e = table(spark, sf_dir, "embeddings")
    return ann.nearest(e, e.where(F.col("vec_id") % 100 == 0))


# --- 2: line dedup -----------------------------------------------------------------------------------------------

@_query
def op2_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every document that repeat an earlier line or are one word edit away."""
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


# --- 3: url filters ----------------------------------------------------------------------------------------------

# The contract's rules.
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/"))


@_query
def op3_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict; the list holds the canonical urls that several pages claim."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.url_verdicts(pages, url_filter.shared_addresses(pages), URL_RULES)


ORACLE["op3_url_verdicts"] = r"""
WITH p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
         contains(url, '://') AS ok
  FROM pages),
c AS (
  SELECT *, CASE WHEN ok THEN regexp_replace(host, '^www\.', '') ||
                regexp_replace(regexp_replace(path, '/+$', ''), '\.html$', '') END AS canonical FROM p),
l AS (SELECT canonical FROM c WHERE canonical IS NOT NULL GROUP BY canonical HAVING count(*) > 1),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                              ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m AS (
  SELECT c.*, (SELECT max(struct_pack(n := length(rhost || rpath), rule := rhost || rpath, verdict := r.verdict)) FROM r
               WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS best,
         canonical IS NOT NULL AND canonical IN (SELECT canonical FROM l) AS listed
  FROM c)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM m
"""


# --- 4: mixing sources -------------------------------------------------------------------------------------------

@_query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


# --- 5: benchmark decontamination --------------------------------------------------------------------------------

@_query
def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether a benchmark item leaks into it, and which."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", (F.size("leaks") > 0).alias("contaminated"), F.size("leaks").alias("n_items"),
        F.col("leaks.item_id").alias("item_ids"), F.array_max("leaks.coverage").alias("coverage"))


# --- 6: n-gram Jaccard join --------------------------------------------------------------------------------------

@_query
def op6_similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group under five-word shingle similarity of 0.8 or more, and its number of links."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


# --- 7: suffix-array dedup ---------------------------------------------------------------------------------------

@_query
def op7_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the bytes removed under 50-byte strings of earlier documents, and the digest of the rest."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# --- 8: token counts ---------------------------------------------------------------------------------------------

@_query
def op8_line_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


# --- 9: language-model scoring -----------------------------------------------------------------------------------

@_query
def op9_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability under the backoff automaton and under the base model."""
    return lm.score(table(spark, sf_dir, "documents"))


# --- 10: language identification ---------------------------------------------------------------------------------

@_query
def op10_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the documents outside the held-out fold."""
    return langid.identify(table(spark, sf_dir, "documents"))


# --- 12: SentencePiece encoding and decoding ---------------------------------------------------------------------

@_query
def op12_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the ids of its whole text with the end id, and the digests of the ids and of the text decoded from them."""
    return pieces.encode_decode(table(spark, sf_dir, "documents")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


# --- 13: embedding whitening -------------------------------------------------------------------------------------

@_query
def op13_whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's first four whitened coordinates, fitted to the distinct lattice vectors."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


# --- 11: phrase collocation mining -------------------------------------------------------------------------------

@_query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every language's 2000 best phrases of two to five words that occur 100 times or more."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE["op11_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k FROM i, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
x AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, array_to_string(string_split(phrase, ' ')[1:k - 1], ' ') AS phrase FROM f WHERE k > 2
    UNION ALL SELECT lang, f, array_to_string(string_split(phrase, ' ')[2:k], ' ') FROM f WHERE k > 2)
  GROUP BY lang, phrase),
c AS (
  SELECT f.lang, f.phrase, f.k, f.f AS a, unnest(range(1, f.k)) AS cut FROM f LEFT JOIN x ON x.lang = f.lang AND x.phrase = f.phrase
  WHERE f.k > 1 AND (x.f IS NULL OR x.f < f.f)),
s AS (
  SELECT c.lang, c.phrase, c.cut, c.a, l.f AS l, r.f AS r, n.n,
         ((1000::HUGEINT * c.a::HUGEINT * n.n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT))::BIGINT AS score
  FROM c JOIN n ON n.lang = c.lang
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(string_split(c.phrase, ' ')[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(string_split(c.phrase, ' ')[cut + 1:c.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000
"""
