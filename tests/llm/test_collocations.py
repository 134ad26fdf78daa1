import random
import re
from collections import Counter

import pytest

from hearth.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, rank string, phrase string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "r", "p", "n") for i, (t, lang) in enumerate(rows)], SCHEMA)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counts(rows):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    return f, n


def brute(rows, min_count, top):
    """By the definition, with Python's whole numbers."""
    f, n = counts(rows)
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    out = []
    for lang in {lang for lang, _ in found}:
        mine = []
        for (other, w), a in found.items():
            if other != lang or any(o == lang and len(v) > len(w) and b >= a and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))
                                    for (o, v), b in found.items()):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                                        for k in range(1, len(w)))
            mine.append((-score, -a, " ".join(w).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def result(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def text(rng, words, n):
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!?", " \x1c", "\x0b"]) for _ in range(n))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_the_definition(spark, seed):
    """Random texts with repeated passages, several blocks, and cut ties; equal rows count each."""
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "é", "ÉA", "日本", "x-y", "'s", "\x1d"]
    passage = "one two three four five six seven eight nine"
    rows = [(text(rng, words, rng.randint(0, 60)), rng.choice(["en", "de", None, "und"])) for _ in range(60)]
    rows += [(f"{rng.choice(words)} {passage} {rng.choice(words)}", "en") for _ in range(8)] + [(passage, "de")] * 5
    rows += [(None, "en"), ("", None), ("...", "fr"), ("a " * 300, "xx"), ("b b b b. " * 30, "yy")]
    for min_count, top in ((4, 2000), (5, 7)):
        got = result(co.collocations(frame(spark, rows), min_count=min_count, top=top, block_bytes=400))
        assert got == brute(rows, min_count, top)


def test_flow_gives_the_counts_of_shorter_phrases(spark):
    rng = random.Random(7)
    rows = [(text(rng, ["a", "b", "c"], 80), "en") for _ in range(20)]
    f, _ = counts(rows)
    for k, level in enumerate(co.phrase_counts(frame(spark, rows), min_count=3, block_bytes=300), 1):
        got = {(r.lang, tuple(r.phrase.split(" "))): r.f for r in level.collect()}
        want = {key: a for key, a in f.items() if len(key[1]) == k and (a >= 3 or k == 1)}
        assert {key: a for key, a in got.items() if a >= 3 or k == 1} == want


def test_unary_paths_are_compacted():
    """A passage that always runs alike is one path of all its words; a fork ends it."""
    block = co.Block()
    passage = " ".join(f"w{i}" for i in range(30))
    for _ in range(4):
        block.add("en", f"x {passage} y".encode())
    block.add("en", b"w3 w4 w5 w6 w7 z")
    block.close()
    rows = list(co.paths_and_ends(block, None))
    paths = {w: c for e, _, w, c in rows if not e}
    # the other text starts at the node w3 w4 w5 w6 and forks at w4 w5 w6 w7
    assert sorted(paths.values()) == [1, 4, 4, 5] and sum(len(p.split()) - 4 for p in paths) == 28 + 1
    assert max(len(p.split()) for p in paths) > 20
    assert sum(c for e, _, _, c in rows if e) == 5


def test_filter_lets_every_frequent_pair_through(spark, monkeypatch):
    """However small the filter, results are the same; a small one only lets more through."""
    rng = random.Random(5)
    rows = [(text(rng, [f"w{i}" for i in range(40)], 200), "en") for _ in range(30)]
    want = brute(rows, 6, 2000)
    assert want and result(co.collocations(frame(spark, rows), min_count=6, block_bytes=1000)) == want
    monkeypatch.setattr(co, "FILTER_BYTES", 64)
    assert result(co.collocations(frame(spark, rows), min_count=6, block_bytes=1000)) == want


def test_scores_beyond_longs(spark):
    """1000 a n / (l r) with factors whose product passes 64 bits, in the query's arithmetic."""
    a, n, l, r = 99_999_999_999, 99_999_999_999_999, 99_999_999_999, 99_999_999_998
    got = spark.sql(f"select (cast(1000 as decimal(4,0)) * cast({a}L as decimal(17,0)) * cast({n}L as decimal(17,0)))"
                    f" div (cast({l}L as decimal(19,0)) * cast({r}L as decimal(19,0)))").first()[0]
    assert got == 1000 * a * n // (l * r)


def test_empty_table_and_long_text(spark):
    assert co.collocations(frame(spark, [])).collect() == []
    assert co.collocations(frame(spark, [(None, None)])).collect() == []
    rows = [("left right " * 20_000, "en"), ("left right", None)]
    assert result(co.collocations(frame(spark, rows))) == brute(rows, 100, 2000)
