import hashlib
import math
import os
import random
import tempfile
from decimal import ROUND_HALF_UP, Decimal

import pytest
from test_decontaminate import brute_tiles
from test_langid import SYLLABLES, text
from test_line_dedup import brute as brute_lines
from test_mixing import targets
from test_ngram_join import brute as brute_groups

import __spark_entry__ as entry
import corpus_pipeline
from hearth.llm import decontaminate, langid, queries

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    """Documents of three languages with copies, near copies, repeated lines, benchmark passages and junk."""
    rng = random.Random(6)
    items = [(i, text(rng, rng.choice(list(SYLLABLES)), 20)) for i in range(6)]
    rows, shared = [], [text(rng, "aa", 12) for _ in range(3)]
    for d in range(110):
        lang = list(SYLLABLES)[d % 3]
        body = [text(rng, lang, rng.randint(6, 30)) for _ in range(rng.randint(1, 5))]
        if d % 7 == 3:
            body.insert(rng.randrange(len(body) + 1), rng.choice(shared))
        if d % 11 == 5:
            body.append(items[d % 6][1])
        if d % 9 == 4 and rows:
            old = rng.choice(rows)[1].split()
            old[rng.randrange(len(old))] = "changed"
            body = [" ".join(old)]
        if d % 13 == 6 and rows:
            body = [rng.choice(rows)[1]]
        t = "\n".join(body)
        rows.append((d, t, lang, rng.choice(["s1", "s2", "s3", "hot", "hot"]), len(t)))
    rows += [(200, None, "aa", "s1", 0), (201, "", None, None, 0), (202, "12 34 -- 56", "bb", "s2", 11)]
    return rows, items


def brute(spark, rows, items):
    net = langid.fit(spark.createDataFrame(rows, COLUMNS))
    best, score = langid.classify(net, [(r[1] or "").encode() for r in rows])
    rows = [r for r, b, s in zip(rows, best, score) if b >= 0 and s >= .3]
    gone = brute_lines([r[:2] for r in rows])
    kept = []
    for r in rows:
        lines = r[1].split("\n")
        t = "\n".join(x for i, x in enumerate(lines) if i not in gone.get(r[0], ()))
        if not gone.get(r[0]) or t.strip():
            kept.append((r[0], t, *r[2:]))
    first = {d: c for d, c, _ in brute_groups([r[:2] for r in kept])}
    kept = [r for r in kept if first[r[0]] == r[0]]
    clean = []
    for r in kept:
        t = decontaminate.tokens(r[1])
        if not any(brute_tiles(p, t, 5) >= .6 * len(p) for p in (decontaminate.tokens(x) for _, x in items)):
            clean.append(r)
    size = {r[0]: len(r[1].split()) for r in clean}
    sizes = {}
    for r in clean:
        sizes[r[3]] = sizes.get(r[3], 0) + size[r[0]]
    want = targets(sizes)
    out = []
    for s in sizes:
        rate = Decimal(want[s] / sizes[s]).quantize(Decimal("1e-12"), ROUND_HALF_UP)
        u = (Decimal(int(hashlib.md5(f"17:s{s}".encode()).hexdigest()[:8], 16)) / Decimal(2 ** 32)).quantize(Decimal("1e-12"), ROUND_HALF_UP)
        for k, r in enumerate(sorted((r for r in clean if r[3] == s), key=lambda r: (size[r[0]], r[0]))):
            out += [r] * (math.floor((k + 1) * rate + u) - math.floor(k * rate + u))
    return sorted(out, key=str)


def test_pipeline_matches_brute_force(spark):
    rows, items = corpus()
    folder = tempfile.mkdtemp(prefix="hearth-pipeline-")
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(spark, rows, items)


def test_stages_take_an_empty_table(spark):
    docs = spark.createDataFrame([], COLUMNS)
    folder = tempfile.mkdtemp(prefix="hearth-pipeline-")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.count() == 0


def test_every_operator_is_registered():
    names = entry.queries()
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names
    assert [n for n in range(1, 11) if not any(k.startswith(f"op{n}_") for k in names)] == []


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no sample data")
def test_url_query_matches_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    want = con.sql(queries.ORACLE["op3_url_verdicts"]).fetchall()
    got = entry.queries()["op3_url_verdicts"](spark, sf).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
