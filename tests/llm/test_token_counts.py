import random

import numpy as np
import pytest

from hearth.llm import token_counts as tc

SCHEMA = "doc_id long, text string, title string, section string, n_tokens string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "Title " + str(d), "s", "n") for d, t in rows], SCHEMA)


def brute(texts, rule):
    """Token by token from another library's offsets over the same vocabulary."""
    tokenizers = pytest.importorskip("tokenizers")
    import os
    path = "/opt/tokenizers/byte_bpe_50k.json"
    if not os.path.exists(path):
        pytest.skip("no vocabulary file")
    tok = tokenizers.Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    out = []
    for d, t in texts:
        t = t or ""
        parts = t.split("\n")
        parts = [p + "\n" for p in parts[:-1]] + ([parts[-1]] if parts[-1] or len(parts) == 1 else [])
        ends = np.cumsum([len(p) for p in parts])
        offsets = tok.encode(t, add_special_tokens=False).offsets
        n = [0] * len(parts)
        for a, b in offsets:
            share = [max(0, min(b, e) - max(a, e - len(p))) for p, e in zip(parts, ends)]
            n[int(np.argmax(share)) if rule == "majority" else next(i for i, x in enumerate(share) if x)] += 1
        out += [(d, i, int(e - len(p)), int(e), k, len(offsets)) for i, (p, e, k) in enumerate(zip(parts, ends, n))]
    return sorted(out, key=str)


TEXTS = [(1, "Hello world\n\n\nthis is  a text.\n"), (2, None), (3, ""), (4, "\n"), (5, "naïve café\r\n – ünïcödé ☃☃\n日本語"),
         (6, "a  \n  b \t\n\n c"), (7, "x" * 5000 + "\n" + "word " * 3000), (7, "x\ny"), (None, "null id\n\n")]


@pytest.mark.parametrize("rule", ["majority", "start"])
def test_lines_match_offsets(spark, rule):
    rng = random.Random(1)
    rows = TEXTS + [(100 + i, "".join(rng.choice("ab é\n\n .,1") for _ in range(rng.randint(0, 80)))) for i in range(40)]
    got = sorted(((r.doc_id, r.section, r.char_start, r.char_end, r.n_tokens, r.doc_tokens)
                  for r in tc.token_counts(frame(spark, rows), rule=rule).collect()), key=str)
    assert got == brute(rows, rule)


def test_sections_add_up_and_fields(spark):
    rows = tc.token_counts(frame(spark, TEXTS), fields=("title", "text"), by="fields").collect()
    assert len(rows) == 2 * len(TEXTS)
    for key in {(r.doc_id, r.doc_tokens) for r in rows if r.doc_id not in (7,)}:
        assert sum(r.n_tokens for r in rows if (r.doc_id, r.doc_tokens) == key) == key[1]
    assert all(r.n_crossing <= r.n_tokens for r in rows)


def test_empty_table_and_bad_arguments(spark):
    assert tc.token_counts(frame(spark, [])).collect() == []
    with pytest.raises(ValueError):
        tc.token_counts(frame(spark, []), by="pages")


def encoder():
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("test", pat_str=tc.PATTERN, mergeable_ranks=tc.load_ranks(), special_tokens={})


def test_long_runs_are_encoded_as_the_unsplit_text(monkeypatch):
    """Cut out or not, runs of white space give the same tokens, at sizes that both ways can do."""
    enc, rng = encoder(), random.Random(3)
    for run in (20_000, 3):
        monkeypatch.setattr(tc, "LONG_RUN", min(run, 10_000))
        for c in " ", "\n", "\t", "\u3000", " \n":
            for a, b in (("", ""), ("word", ""), ("", "word"), ("word.", "word"), ("x", "1"), ("\x1c", "\x1c"), ("a", "'s")):
                text = a + c * run + b + c * run + b
                assert tc.encode_whole(text, enc).tolist() == enc.encode_ordinary(text)
    monkeypatch.setattr(tc, "LONG_RUN", 2)
    for _ in range(300):
        text = "".join(rng.choice("a '\n\t\u00a0\x1c1.s") for _ in range(rng.randint(0, 40)))
        assert tc.encode_whole(text, enc).tolist() == enc.encode_ordinary(text)


def test_five_million_of_one_character(spark):
    n = 5_000_000
    rows = [(1, " " * n), (2, "\n" * n), (3, "a" * n), (4, "a" + " " * n + "b")]
    counts = {}
    for r in tc.token_counts(frame(spark, rows), by="fields").collect():
        counts[r.doc_id] = (r.char_end, r.n_tokens, r.doc_tokens)
    small = [len(encoder().encode_ordinary(c * 100_000)) for c in " \na"]
    assert counts[1] == (n, small[0] * 50, small[0] * 50) and counts[2] == (n, small[1] * 50, small[1] * 50)
    assert counts[3] == (n, small[2] * 50, small[2] * 50) and counts[4] == (n + 2, n + 1, n + 1)
    lines = tc.token_counts(frame(spark, rows[1:2])).agg({"section": "max", "n_tokens": "sum"}).first()
    assert tuple(lines) == (n - 1, counts[2][2]) or set(lines) == {n - 1, counts[2][2]}


def test_majority_is_the_first_of_the_fullest():
    bounds = np.array([0, 2, 2, 5, 6])
    owner, crossing = tc.allocate(np.array([0, 1, 1, 4]), np.array([2, 6, 3, 8]), bounds, "majority")
    assert owner.tolist() == [0, 2, 0, 4] and crossing.tolist() == [False, True, True, True]
