import random

from hearth.llm import line_dedup

SCHEMA = "doc_id long, text string, lang string, doc int, line int, h1 string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2, "h") for d, t in rows], SCHEMA)


def near(a, b):
    a, b = a.split(), b.split()
    if a == b:
        return True
    if min(len(a), len(b)) < line_dedup.MIN_WORDS:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    """Per (doc id): the dropped line numbers, by comparing every line with all earlier ones."""
    rows = sorted(((line_dedup.LAST if d is None else d, t) for d, t in rows if t is not None), key=lambda r: r[0])
    lines = [(d, i, x) for d, t in rows for i, x in enumerate(t.split("\n")) if x.split()]
    gone = {}
    for d, i, x in lines:
        if any((e, j) < (d, i) and near(x, y) for e, j, y in lines):
            gone.setdefault(d, set()).add(i)
    return gone


def report(spark, rows):
    got = line_dedup.line_report(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_removed == len(r.removed) and r.n_removed <= r.n_lines
    return {line_dedup.LAST if r.doc_id is None else r.doc_id: set(r.removed) for r in got if r.removed}


def test_matches_brute_force(spark):
    rng = random.Random(3)
    words = ["a", "b", "c", "d", "e"]
    base = [[rng.choice(words) for _ in range(rng.randint(1, 9))] for _ in range(12)]
    rows = []
    for d in range(40):
        lines = []
        for _ in range(rng.randint(0, 6)):
            w = list(rng.choice(base))
            if rng.random() < .7 and w:
                i = rng.randrange(len(w))
                kind = rng.random()
                w = w[:i] + ([rng.choice(words)] if kind < .4 else [] if kind < .7 else [w[i], rng.choice(words)]) + w[i + 1:]
            lines.append("  ".join(w) if rng.random() < .2 else " ".join(w))
        rows.append((d, "\n".join(lines)))
    assert report(spark, rows) == brute(rows)


def test_nulls_empty_long_and_repeated(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, None), (2, ""), (3, "\n \n"), (None, "x y z one two"), (4, "x y z one two"), (5, "x y z one two"), (5, "x y z one two"),
            (6, long), (7, long + " more"), (8, "a b"), (9, "a c"), (10, "a b")]
    assert report(spark, rows) == brute(rows) == {5: {0}, line_dedup.LAST: {0}, 7: {0}, 10: {0}}


def test_dedup_lines_keeps_columns(spark):
    rows = [(1, "one two three four five\nshort"), (2, "one two three four six\nother"), (3, "short"), (4, None), (5, "")]
    out = line_dedup.dedup_lines(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "lang", "doc", "line", "h1"]
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: rows[0][1], 2: "other", 4: None, 5: ""}


def test_empty_table(spark):
    assert line_dedup.line_report(frame(spark, [])).collect() == []
    assert line_dedup.dedup_lines(frame(spark, [])).collect() == []


def test_hot_line_and_variants(spark):
    rows = [(d, f"the same long line every time\npage number {d} of the report") for d in range(300)]
    assert report(spark, rows) == {d: {0, 1} for d in range(1, 300)}


def test_without_broadcasts(spark, monkeypatch):
    from hearth.llm import common
    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", -1)
    rows = [(d, f"the same long line every time\npage number {d} of the report\nshort") for d in range(40)]
    assert report(spark, rows) == brute(rows)


def by_row(rows):
    """The dropped lines of every row, rows of one id in the order of their text's hash, which the operator fixes."""
    lines = [(i, n, x) for i, (_, t) in enumerate(rows) for n, x in enumerate((t or "").split("\n")) if x.split()]
    return [{n for j, n, x in lines if j == i and any((e, m) < (i, n) and near(x, y) for e, m, y in lines)} for i in range(len(rows))]


def in_place(spark, rows):
    """The rows in the operator's order of places: id (null last), text hash."""
    from pyspark.sql import functions as F
    f = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")).cast("binary")))
    return [(r.doc_id, r.text) for r in f.orderBy(F.col("doc_id").isNull(), "doc_id", "h", "text").collect()]


def reported(spark, rows):
    got = line_dedup.line_report(frame(spark, rows)).collect()
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_lines, tuple(r.removed)) for r in got)


def wanted(rows):
    return sorted((d is None, d or 0, len(t.split("\n")) if t is not None else 0, tuple(sorted(g))) for (d, t), g in zip(rows, by_row(rows)))


def test_rows_without_an_id_or_with_a_repeated_one_stay_apart(spark):
    rows = in_place(spark, [
        (1, "one two three four five\nalpha"), (None, None), (None, "one two three four six"),
        (None, "own first line of this row\none two three four seven\nsecond line that nothing repeats here"),
        (None, "quite another text for a start\nclean words stand here alone\nalpha\nmore lines follow until the end"),
        (7, "left line of the short text"), (7, "gamma\ndelta\none two three four eight\nkept by the longer text alone"),
        (7, "epsilon\ngamma")])
    assert reported(spark, rows) == wanted(rows)
    out = line_dedup.dedup_lines(frame(spark, rows)).collect()
    kept = [(d, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in g) if g else t) for (d, t), g in zip(rows, by_row(rows))]
    assert sorted(map(str, [(r.doc_id, r.text) for r in out])) == sorted(str(k) for k, g in zip(kept, by_row(rows)) if not g or k[1].split())


def test_equal_rows_lose_their_lines_but_one(spark):
    text = "the first line of the text\n\nthe last one"
    rows = in_place(spark, [(None, text)] * 5 + [(3, text + "\nand more")] * 2 + [(4, "")] * 3 + [(None, None)] * 2 + [(None, "")] * 2)
    assert reported(spark, rows) == wanted(rows)
    out = line_dedup.dedup_lines(frame(spark, rows)).collect()
    assert sorted(str((r.doc_id, r.text)) for r in out) == sorted(
        map(str, [(3, text + "\nand more")] + [(4, "")] * 3 + [(None, None)] * 2 + [(None, "")] * 2))
