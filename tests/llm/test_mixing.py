import random
import re

from hearth.llm import mixing

SCHEMA = "doc_id long, source string, text string, size string, target string, copies string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)


def targets(sizes):
    """Resharing round by round, as the contract states it."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, open_, out = sum(sizes.values()), set(order), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > 3 * sizes[s]}
        if not over:
            out |= {s: left * w[s] / total for s in open_}
            break
        out |= {s: 3 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        open_ -= over
    return out


def check(spark, rows):
    got = mixing.mix(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = targets(sizes)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) <= 1e-9 * max(1, want[r.source])
        rate = r.target / r.source_size if r.source_size else 0
        assert r.taken == r.copies * r.size and r.taken <= 3 * r.size and (not r.size or abs(r.copies - rate) < 1)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((d is None, d or 0, size(t)) for d, _, t in rows)
    for s in sizes:      # in order of size, the draws miss the target by little more than one document
        assert abs(taken[s] - want[s]) <= 2 * largest[s] + 1
    return got


def corpus(n=400):
    rng = random.Random(7)
    return [(i, rng.choice(["a", "b", "c", "d", "é", "Z", None, "hot", "hot", "hot"]), "w " * rng.randint(0, 50)) for i in range(n)]


def test_targets_and_draws(spark):
    rows = corpus() + [(1000 + i, "tiny", "one two") for i in range(2)]
    first = check(spark, rows)
    again = mixing.mix(frame(spark, rows[::-1]).repartition(7)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_many_sources_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SMALL_SOURCES", 0)
    check(spark, corpus(120))


def test_nulls_empty_long_and_repeated(spark):
    check(spark, [(1, "a", None), (2, "a", ""), (3, "a", " \x0b\n"), (4, None, "x\x85y z"), (5, "b", "w " * 50000), (5, "b", "w " * 50000),
                  (None, "a", "q r s"), (None, "a", "q r s")])


def test_only_empty_texts_and_empty_table(spark):
    assert [r.taken for r in check(spark, [(1, "a", None), (2, "b", "")])] == [0, 0]
    assert mixing.mix(frame(spark, [])).collect() == []
    assert mixing.take(frame(spark, [])).collect() == []


def test_take_repeats_rows(spark):
    rows = corpus(100)
    copies = {r.doc_id: r.copies for r in mixing.mix(frame(spark, rows)).collect()}
    out = mixing.take(frame(spark, rows))
    assert out.columns == ["doc_id", "source", "text", "size", "target", "copies"]
    got = [r.doc_id for r in out.collect()]
    assert {i: got.count(i) for i in copies} == copies


def test_take_draws_every_row_without_an_id_for_itself(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, None, 5]), rng.choice(["a", "b", None]), " ".join([f"r{i}"] * rng.randint(1, 30))) for i in range(150)]
    rows += [(None, "a", None), (None, "b", ""), (None, "c", "same words"), (None, "c", "same words"), (None, "d", "other words")]
    size = lambda t: len((t or "").split())
    draws, out = {}, {}
    for r in mixing.mix(frame(spark, rows)).collect():
        draws.setdefault((str(r.doc_id), str(r.source), r.size), []).append(r.copies)
    taken = [(r.doc_id, r.source, r.text) for r in mixing.take(frame(spark, rows)).collect()]
    for row in dict.fromkeys(rows):
        out.setdefault((str(row[0]), str(row[1]), size(row[2])), []).append(taken.count(row))
    assert {k: sum(v) for k, v in draws.items()} == {k: sum(v) for k, v in out.items()}
    single = {k: sorted(v) for k, v in draws.items() if len(v) == len(out[k])}
    assert len(single) > 30 and single == {k: sorted(out[k]) for k in single}
    again = mixing.take(frame(spark, rows[::-1]).repartition(7)).collect()
    assert sorted(map(str, taken)) == sorted(str((r.doc_id, r.source, r.text)) for r in again)
