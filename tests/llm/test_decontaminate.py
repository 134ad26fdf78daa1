import random

import pytest

from hearth.llm import decontaminate as dc

SCHEMA = "doc_id long, text string, item_id string, coverage double"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "i", 1.0) for d, t in rows], SCHEMA)


def bench(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, leaks string")


def brute_tiles(p, t, m):
    """Greedy tiling straight from its definition: always the longest match of unmarked tokens."""
    fp, ft, total = [True] * len(p), [True] * len(t), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                n = 0
                while i + n < len(p) and j + n < len(t) and fp[i + n] and ft[j + n] and p[i + n] == t[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < m:
            return total
        fp[i:i + n], ft[j:j + n] = [False] * n, [False] * n
        total += n


def test_tiling_matches_the_definition():
    rng = random.Random(3)
    for _ in range(400):
        p = [rng.randrange(4) for _ in range(rng.randint(0, 18))]
        t = [rng.randrange(4) for _ in range(rng.randint(0, 30))]
        for m in (2, 3, 5):
            tiles = dc.tile(p, t, m)
            want = brute_tiles(p, t, m)
            assert all(p[i:i + n] == t[j:j + n] and n >= m for i, j, n in tiles)
            for side, size in ((0, len(p)), (1, len(t))):
                used = sorted((x[side], x[2]) for x in tiles)
                assert all(a + n <= b for (a, n), (b, _) in zip(used, used[1:])) and (not used or sum(used[-1]) <= size)
            assert sum(n for *_, n in tiles) == want


def passages():
    rng = random.Random(1)
    w = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    items = [(i, " ".join(w(rng.randint(15, 60)))) for i in range(20)]
    docs, planted = [], {}
    for d in range(60):
        text = w(rng.randint(0, 300))
        if d % 3 == 0:
            item, words = items[d % 20][0], items[d % 20][1].split()
            cut = len(words) // 2
            if d % 2:
                words = words[cut:] + w(4) + words[:cut]            # its halves change places
            text = text[:50] + words + text[50:]
            planted[d] = item
        docs.append((d, " ".join(text).capitalize() + "."))
    return items, docs, planted


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 400])
def test_planted_and_reordered_passages_are_found(spark, block):
    items, docs, planted = passages()
    got = dc.find_leaks(frame(spark, docs), bench(spark, items), block_bytes=block, column="found").collect()
    assert {r.doc_id: [x.item_id for x in r.found] for r in got if r.found} == {d: [i] for d, i in planted.items()}


def test_clean_rows_keep_all_columns(spark):
    items, docs, planted = passages()
    out = dc.decontaminate(frame(spark, docs), bench(spark, items))
    assert out.columns == ["doc_id", "text", "item_id", "coverage"]
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(range(60)) - set(planted))


def test_nulls_short_items_repeated_and_empty(spark):
    item = "alpha beta gamma delta epsilon zeta"
    docs = [(1, None), (2, ""), (None, item), (3, item), (3, item), (4, "x " * 30000 + item), (5, "one two")]
    items = [(7, item), (7, item), (None, item), (8, None), (9, ""), (10, "one two")]
    hit = [7, 7, None]
    for block in (dc.BLOCK_BYTES, 10):
        found = dc.find_leaks(frame(spark, docs), bench(spark, items).drop("leaks"), block_bytes=block)
        got = sorted(((r.doc_id, [x.item_id for x in r.leaks]) for r in found.collect()), key=str)
        assert got == sorted([(1, []), (2, []), (None, hit), (3, hit), (3, hit), (4, hit), (5, [])], key=str)
    assert dc.find_leaks(frame(spark, docs), bench(spark, [])).count() == len(docs)
    assert dc.find_leaks(frame(spark, []), bench(spark, items)).collect() == []


def dense(n_docs=40, n_items=25):
    """Few words, so that documents and items share seeds everywhere and coverage takes every value."""
    rng = random.Random(12)
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(3, 24)))) for i in range(n_items)]
    docs = [(d, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 90)))) for d in range(n_docs)]
    return items, docs


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 100])
def test_whole_documents_tiled_by_definition(spark, block):
    """Every document against every item, tiled whole: what the seeds cut away was no part of any tile."""
    items, docs = dense()
    want = {}
    for d, text in docs:
        for i, item in items:
            p, t = item.split(), text.split()
            share = brute_tiles(p, t, 5) / len(p)
            if share >= 0.6 and len(p) >= 5:
                want.setdefault(d, []).append((i, pytest.approx(share)))
    got = dc.find_leaks(frame(spark, docs), bench(spark, items).drop("leaks"), block_bytes=block).collect()
    assert {r.doc_id: [(x.item_id, x.coverage) for x in r.leaks] for r in got if r.leaks} == want and len(got) == len(docs)
    assert len(want) > 5 and sum(map(len, want.values())) < len(items) * len(docs)


def test_clashing_columns_and_long_texts_in_the_seed_join(spark):
    """The join keeps columns named like its own, and a text of a megabyte is judged whole."""
    item = " ".join(f"w{i}" for i in range(40))
    rows = [(1, "x " * 500000 + item, "k", 1), (2, "clean", "k", 2), (2, None, "k", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, block int")
    out = dc.find_leaks(docs, bench(spark, [(1, item), (2, "y " * 30)]).drop("leaks"), block_bytes=1)
    assert out.columns == ["doc_id", "text", "key", "block", "leaks"]
    assert sorted((r.doc_id, r.block, [x.item_id for x in r.leaks]) for r in out.collect()) == [(1, 1, [1]), (2, 2, []), (2, 3, [])]
