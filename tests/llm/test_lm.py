import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from hearth.llm import lm

SCHEMA = "doc_id long, text string, block int, held string, stats string"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "h", "s") for d, t in rows], SCHEMA)


def brute(rows, order):
    """The same model from plain dictionaries and a token by token walk."""
    seqs = [(d, WORD.findall((t or "").encode().lower()) + [None]) for d, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    grams = [Counter() for _ in range(order + 1)]
    n_docs = held.count(False)

    def ctx(seq, i, k):
        return tuple((["<s>"] * k + seq)[i:i + k])

    for (_, seq), h in zip(seqs, held):
        if not h:
            for i, w in enumerate(seq):
                for k in range(1, order + 1):
                    grams[k][(*ctx(seq, i, k - 1), w)] += 1
    n, v = sum(grams[1].values()), len(grams[1])
    n1, n2 = (sum(c == k for c in grams[1].values()) for k in (1, 2))
    d = n1 / (n1 + 2 * n2) if n1 else .5

    def seen(c):
        return n_docs if set(c) == {"<s>"} else grams[len(c)][c]

    once, total = Counter(), Counter()
    for k in range(2, order + 1):
        for g, c in grams[k].items():
            lev = int(math.log2(seen(g[:-1])))
            once[k, lev] += c == 1
            total[k, lev] += c

    def logp(c, w):
        if not c:
            if not n:
                return 0.0
            g = grams[1][(w,)]
            return math.log10((g - d) / n if g else d * v / n)
        s = seen(c)
        if not s:
            return logp(c[1:], w)
        lev = int(math.log2(s))
        beta = min(1, (once[len(c) + 1, lev] + 1) / (total[len(c) + 1, lev] + 1))
        g = grams[len(c) + 1][(*c, w)]
        low = logp(c[1:], w)
        return math.log10((1 - beta) * g / s + beta * 10 ** low) if g else math.log10(beta) + low

    out = []
    for (i, seq), h in zip(seqs, held):
        out.append((i, h, len(seq), sum(grams[1][(w,)] > 0 for w in seq), n,
                    sum(math.log10((grams[1][(w,)] + 1) / (n + v + 1)) for w in seq),
                    sum(logp(ctx(seq, j, order - 1), w) for j, w in enumerate(seq))))
    return out


def check(spark, rows, order=2, **options):
    got = sorted(map(tuple, lm.score(frame(spark, rows), order, **options).collect()), key=str)
    want = sorted(brute(rows, order), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-9)
    return got


def corpus():
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(60)]
    return [(d, " ".join(rng.choice(vocab[:1 + rng.randrange(60)]) for _ in range(rng.randint(0, 60)))) for d in range(120)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_matches_a_plain_model(spark, order):
    check(spark, corpus(), order, block_bytes=2000)


def test_nulls_empty_long_and_repeated(spark):
    long = " ".join(f"w{i % 700}" for i in range(20000))
    check(spark, [(1, None), (2, ""), (3, "Ab\tAB\x0bab"), (None, "x y"), (None, "x y"), (5, long), (5, long), (6, "é É")], 3)


@pytest.mark.parametrize("stretch", [1, 2, 3, 7])
def test_stretches_carry_the_state(spark, monkeypatch, stretch):
    """The walk is cut anywhere, also inside the first tokens of a text, without a change."""
    whole = block_scores(corpus(), 3, lm.STRETCH)
    assert np.array_equal(whole, block_scores(corpus(), 3, stretch))


def block_scores(rows, order, stretch):
    """Token weights of one block that is the whole corpus, without Spark."""
    docs = pa.table({"doc_id": pa.array([d for d, _ in rows]), "held": pa.array([d % 5 == 2 for d, _ in rows]),
                     "body": pa.array([t.encode() for _, t in rows], pa.binary())})
    block, counts, places, stats = lm.Block(docs), [], [], {}
    for k in range(1, order + 1):
        keys, place = block.next_order(counts)
        asked = place >= 0
        seen = np.bincount(place[asked], weights=block.train[asked], minlength=len(keys)).astype(np.int64)
        level = np.zeros(len(keys), np.int64)
        if k > 1:
            level[place[asked]] = lm._levels(block.context_counts(counts[-1], lm._train_docs(block, counts[0])))[asked]
        stats[k] = np.r_[(seen > 0).sum(), (seen == 2).sum(), np.bincount(level[seen == 1], minlength=lm.LEVELS),
                         np.bincount(level, weights=seen, minlength=lm.LEVELS).astype(np.int64)]
        counts.append(np.r_[seen, 0][place])
        places.append(place)
    model = lm.Automaton(stats)
    model.build(block, counts, places)
    kept, lm.STRETCH = lm.STRETCH, stretch
    try:
        return model.walk(block, order)
    finally:
        lm.STRETCH = kept


def test_states_and_failure_arcs(spark):
    """Every failure arc leads to a shorter context, and each chain ends in the empty one."""
    rows = corpus()
    docs = pa.table({"doc_id": pa.array([d for d, _ in rows]), "held": pa.array([False] * len(rows)),
                     "body": pa.array([t.encode() for _, t in rows], pa.binary())})
    block, counts, places = lm.Block(docs), [], []
    for _ in range(3):
        keys, place = block.next_order(counts)
        asked = place >= 0
        counts.append(np.r_[np.bincount(place[asked], minlength=len(keys)), 0][place])
        places.append(place)
    model = lm.Automaton({k: np.ones(2 + 2 * lm.LEVELS, np.int64) for k in (1, 2, 3)})
    model.build(block, counts, places)
    assert len(model.fail) == len(model.fail_weight) and (model.fail[1:] < np.arange(1, len(model.fail))).all()
    assert (np.diff(model.keys) > 0).all() and model.target.max() < len(model.fail) and model.target.min() >= 0
    state = np.arange(len(model.fail))
    for _ in range(2):
        state = model.fail[state]
    assert not state.any()


def test_no_context_is_seen_twice(spark):
    check(spark, [(1, "a b c d")], 3)
    check(spark, [(1, "a b"), (3, "c d"), (4, "e f")], 3, block_bytes=20)


def test_only_held_out_and_empty_tables(spark):
    held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)
    check(spark, [(held, "a b c")])
    assert lm.score(frame(spark, [])).collect() == []


def test_probabilities_add_up_to_one(spark):
    """After "b", the known tokens and the unknown class share all probability."""
    fold = [d for d in range(3000) if zlib.crc32(str(d).encode()) % 7 == 2]
    rows = [(d, t) for d, t in zip((d for d in range(99) if d not in fold), ["a b a c", "a b b", "c a b", "d d"])]
    words = ["a", "b", "c", "d", "unseen"]
    asked = [(fold[0], "b"), *[(fold[i + 1], f"b {w}") for i, w in enumerate(words)]]
    score = {r[0]: r[6] for r in check(spark, rows + asked)}
    after = {w: [r[6] for r in brute(rows + [(fold[0], w)], 1)][-1] for w in words}      # only to name the tokens
    end = 10 ** score[fold[0]]
    got = 0.0
    for i, w in enumerate(words):
        # P(b w end) / P(end | w) = P(b) P(w | b)
        only = dict((r[0], r[6]) for r in check(spark, rows + [(fold[0], w)]))[fold[0]]
        first = after[w] - [r[6] for r in brute(rows + [(fold[0], "")], 1)][-1]
        start = _start(rows, w)
        got += 10 ** (score[fold[i + 1]] - (only - start))
        assert first < 0
    p_b = 10 ** _start(rows, "b")
    assert abs((got + end) / p_b - 1) < 1e-9


def _start(rows, w):
    """log10 P(w | start), from the plain model: the text less its end."""
    fold = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)
    whole = brute(rows + [(fold, w)], 2)[-1][6]
    # P(end | w): one token text with the start mass taken off
    grams = Counter()
    for _, t in rows:
        seq = [*t.split(), None]
        grams.update(zip(["<s>", *seq], seq))
    return whole - _end_after(rows, w, grams)


def _end_after(rows, w, grams):
    singles = Counter(x for _, t in rows for x in [*t.split(), None])
    n, v = sum(singles.values()), len(singles)
    n1, n2 = (sum(c == k for c in singles.values()) for k in (1, 2))
    d = n1 / (n1 + 2 * n2) if n1 else .5
    low = (singles[None] - d) / n
    c = singles[w]
    if not c:
        return math.log10(low)
    seen = lambda u: len(rows) if u == "<s>" else singles[u]
    lev = int(math.log2(c))
    same = [(g, k) for g, k in grams.items() if int(math.log2(seen(g[0]))) == lev]
    beta = min(1, (sum(k == 1 for _, k in same) + 1) / (sum(k for _, k in same) + 1))
    return math.log10((1 - beta) * grams[w, None] / c + beta * low)


def test_texts_are_shuffled_once(spark):
    df = lm.score(frame(spark, corpus()), block_bytes=2000)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 4
