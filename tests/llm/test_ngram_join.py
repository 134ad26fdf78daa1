import random

import numpy as np

from hearth.llm import ngram_join as nj

SCHEMA = "doc_id long, text string, lang string, cls string, size int, leaves string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", "c", 1, "l") for d, t in rows], SCHEMA)


def brute(rows):
    """(class_id, n_links) per row, by comparing all pairs of sets."""
    sets = []
    for _, t in rows:
        w = [x.lower() for x in (t or "").encode().split()]
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n = len(rows)
    near = [[j for j in range(n) if j != i and sets[i] and sets[j]
             and len(sets[i] & sets[j]) >= .8 * len(sets[i] | sets[j]) - 1e-9] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], min(ids) if ids else None, len(near[i])))
    return sorted(out, key=str)


def got(spark, rows):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in nj.near_duplicates(frame(spark, rows)).collect()), key=str)


def corpus():
    rng = random.Random(9)
    rows = []
    for g in range(25):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(30, 200))]
        for _ in range(rng.randint(1, 7)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(99)}"
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    assert got(spark, rows) == brute(rows)


def test_large_groups_are_split(spark, monkeypatch):
    monkeypatch.setattr(nj, "LIMIT", 3)
    monkeypatch.setattr(nj, "BLOCK", 4)
    rows = corpus()
    assert got(spark, rows) == brute(rows)


def test_nulls_short_long_and_repeated(spark):
    long = " ".join(f"w{i}" for i in range(20000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  two"), (None, "one two"), (6, long), (7, long + " x"),
            (8, "alone in the world we are"), (8, "alone in the world we are"), (None, "nobody else says this sentence at all")]
    assert got(spark, rows) == brute(rows)
    kept = sorted(((r.doc_id, r.text) for r in nj.keep_first(frame(spark, rows)).collect()), key=str)
    assert kept == sorted([rows[0], rows[1], rows[2], rows[3], rows[6], rows[8], rows[10]], key=str)


def test_keep_first_keeps_columns(spark):
    out = nj.keep_first(frame(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (3, "other words here")]))
    assert out.columns == ["doc_id", "text", "lang", "cls", "size", "leaves"]
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_empty_table(spark):
    assert got(spark, []) == []
    assert nj.keep_first(frame(spark, [])).collect() == []


def test_pairs_at_the_threshold_meet():
    """Measured recall of one set of runs at a first-level leaf, for sets of similarity just over 0.8."""
    rng = np.random.default_rng(1)
    met = 0
    for _ in range(300):
        s = np.unique(rng.integers(1, 1 << 62, 90, dtype=np.uint64))
        a, b = s[:85], s[5:]                                     # 80 shared of 90
        pa_, pb = nj.first_nodes(a, nj.RUNS, .8), nj.first_nodes(b, nj.RUNS, .8)
        met += bool(set(pa_.tolist()) & set(pb.tolist()))
    assert met == 300
