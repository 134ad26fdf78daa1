import random

import pytest

from hearth.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string, block int, kept string, doc int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "k", 2) for d, t in rows], SCHEMA)


def brute(rows, length=50):
    least = {}
    data = [(sd.LAST if d is None else d, (t or "").encode()) for d, t in rows]
    for d, b in data:
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            least[w] = min(least.get(w, sd.LAST), d)
    out = []
    for (d, b), (i, _) in zip(data, rows):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if least[b[k:k + length]] < d:
                gone[k:k + length] = b"\x01" * length
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def check(spark, rows, **options):
    got = sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in sd.remove_repeats(frame(spark, rows), **options).collect()), key=str)
    assert got == brute(rows, options.get("length", 50))


def corpus(seed=4, docs=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(rng.randint(8, 80)) for _ in range(12)]
    rows = []
    for d in range(docs):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(shared) if rng.random() < .5 else text(rng.randint(1, 40))
            if rng.random() < .4 and len(p) > 2:
                i = rng.randrange(len(p))
                p = p[:i] + rng.choice(["", "x", "yz"]) + p[i + 1:]
            parts.append(p[rng.randrange(5):])
        rows.append((d * 3, "\n".join(parts)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [sd.HOT, 1])
def test_matches_brute_force(spark, hot):
    check(spark, corpus(), hot=hot, block_bytes=3000)


def test_few_fragments_at_once(spark, monkeypatch):
    monkeypatch.setattr(sd, "AT_ONCE", 3)
    check(spark, corpus(7), block_bytes=3000)


def test_other_lengths(spark):
    check(spark, corpus(5), length=41, block_bytes=5000)
    check(spark, corpus(6), length=64, block_bytes=5000)


def test_periodic_and_exact_copies(spark):
    rows = [(1, "a" * 49), (2, "a" * 50), (3, "a" * 130), (4, "ab" * 60), (5, "ab" * 100 + "c"), (6, "xab" * 50), (7, "ab" * 60)]
    check(spark, rows)


def test_nulls_empty_long_and_repeated(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh ") for _ in range(400_000))
    rows = [(5, long), (6, long[1000:5000] + "!" + long[9000:9100]), (5, long[:300]), (5, long[:300]), (None, long[200:400]),
            (None, "z" * 60), (7, "z" * 60), (8, None), (9, ""), (9, "short")]
    check(spark, rows)


def test_empty_table(spark):
    assert sd.remove_repeats(frame(spark, [])).collect() == []


def test_suffix_array():
    rng = random.Random(8)
    for _ in range(3000):
        s = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 40))]
        if rng.random() < .3:
            s = s[:max(1, len(s) // 4)] * 4
        assert sd.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_texts_are_shuffled_once(spark):
    df = sd.remove_repeats(frame(spark, corpus()), block_bytes=3000)
    df.collect()
    assert df._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 3
