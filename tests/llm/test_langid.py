import random

import numpy as np

from hearth.llm import langid as li

SCHEMA = "doc_id long, text string, lang string, score string, source string"
SYLLABLES = {"aa": ["ka", "mo", "ri", "tu"], "bb": ["sch", "ung", "ein", "pf"], "cc": ["eau", "ois", "ez", "qu"]}


def text(rng, lang, n=40):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(n=240):
    rng = random.Random(2)
    langs = list(SYLLABLES)
    return [(i, text(rng, langs[i % 3]), langs[i % 3]) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, lang, "s", "x") for d, t, lang in rows], SCHEMA)


def test_backpropagation_matches_finite_differences():
    rng = np.random.default_rng(1)
    h = 3
    w = {"xf": rng.standard_normal((256, 3 * h)), "uf": rng.standard_normal((h, 3 * h)), "xb": rng.standard_normal((256, 3 * h)),
         "ub": rng.standard_normal((h, 3 * h)), "v": rng.standard_normal((2 * h, 2)), "c": rng.standard_normal(2)}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    net = li.Network(["a", "b"], w)
    seq, lab = li.padded([b"abca", b"ddab", b"cccc"]), np.array([0, 1, 1])
    _, grads = li.step(net, seq, lab)
    for name, g in grads.items():
        flat = np.flatnonzero(np.abs(g.ravel()) > 1e-3)
        for i in rng.choice(flat, min(6, len(flat)), replace=False):
            at = np.unravel_index(i, g.shape)
            old, eps = w[name][at], np.float32(1e-2)
            w[name][at] = old + eps
            up, _ = li.step(net, seq, lab)
            w[name][at] = old - eps
            down, _ = li.step(net, seq, lab)
            w[name][at] = old
            assert abs((up - down) / (2 * eps) - g[at]) < 2e-2 * max(1.0, abs(g[at])), (name, at)


def test_held_out_accuracy_and_determinism(spark):
    rows = corpus()
    first = li.identify(frame(spark, rows), steps=250).collect()
    truth = {d: lang for d, _, lang in rows}
    held = [r for r in first if r.held_out]
    assert len(first) == len(rows) and len(held) > 30
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in first)
    again = li.identify(frame(spark, rows[::-1]).repartition(3), steps=250).collect()
    assert {(r.doc_id, r.lang_pred, round(r.score, 5)) for r in first} == {(r.doc_id, r.lang_pred, round(r.score, 5)) for r in again}


def test_words_are_pooled_as_positions_are_labelled():
    rng = random.Random(4)
    net = li.train([(lang, text(rng, lang).encode()) for lang in SYLLABLES for _ in range(5)], steps=40)
    body = (text(rng, "aa", 30) + " 12 -- " + "schung" * 40).encode()
    total = np.zeros(3)
    for w in li.pieces(body):
        if li._lettered(w):
            total += li.label(net, li.padded([w]))[:, 0].sum(0)
    best, score = li.classify(net, [body])
    assert best[0] == total.argmax() and abs(score[0] - total.max() / total.sum()) < 1e-5


def test_nulls_letterless_long_and_repeated(spark):
    rows = corpus(60) + [(900, None, "aa"), (901, "", "bb"), (902, "12 +-\n!", "aa"), (903, "kamo " * 20000, None), (None, "ungein pfsch", None),
                         (903, "kamo " * 20000, None), (904, "x" * 70000, "zz")]
    got = li.identify(frame(spark, rows), steps=120).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert all(by[i][0].lang_pred == "und" and by[i][0].score == 0 for i in (900, 901, 902))
    assert [r.lang_pred for r in by[903]] == ["aa", "aa"] and by[None][0].lang_pred == "bb" and not by[None][0].held_out
    assert {r.lang_pred for r in got} <= {"aa", "bb", "cc", "zz", "und"}


def test_without_labels_and_empty(spark):
    assert [r.lang_pred for r in li.identify(frame(spark, [(1, "abc", None)])).collect()] == ["und"]
    assert li.identify(frame(spark, [])).collect() == []


def test_keep_identified_keeps_clean_rows_and_columns(spark):
    rows = corpus(90) + [(900, None, "aa"), (902, "12 +-\n!", "aa")]
    out = li.keep_identified(frame(spark, rows), steps=200)
    assert out.columns == ["doc_id", "text", "lang", "score", "source"]
    assert sorted(r.doc_id for r in out.collect()) == list(range(90))


def test_without_labels_only_texts_without_letters_go(spark):
    rows = [(1, "a clean text", None), (2, "ещё один", None), (None, "no id either", None), (3, None, None), (4, "", None), (5, " \n12 - 34!", None)]
    f = frame(spark, rows)
    out = li.keep_identified(f)
    assert out.columns == f.columns
    assert {(r.doc_id, r.text, r.lang) for r in out.collect()} == set(rows[:3])


def test_letters_are_unicode_letters_wherever_words_are_cut(spark):
    """Number signs are no letters; a letter after many digits is one, whatever the piece border."""
    rows = corpus(60) + [(1000, "½ ² 12", None), (1001, "_ ٣ Ⅻ ①", None), (1002, "1" * 47 + "é", None), (1003, "²" * 500, None)]
    rows += [(1100 + k, "1" * k + "日" + "2" * 100, None) for k in range(40, 52)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in li.identify(frame(spark, rows), steps=30).collect()}
    assert all(got[k] == ("und", 0.0) for k in (1000, 1001, 1003))
    assert all(got[k][0] != "und" and 0 < got[k][1] <= 1 for k in [1002, *range(1140, 1152)])


def test_pieces_are_whole_characters():
    rng = random.Random(5)
    for _ in range(200):
        word = "".join(rng.choice("aé日𝔸1") for _ in range(rng.randint(1, 300)))
        cut = li.pieces(word.encode())
        assert "".join(p.decode() for p in cut) == word and max(map(len, cut)) <= li.PIECE
    assert [len(p) for p in li.pieces(b"\x80" * 100)] and b"".join(li.pieces(b"\x80" * 100)) == b"\x80" * 100


def test_training_sample_is_bounded(spark):
    rows = [(i, ("abc " * 50)[:200], lang) for i, lang in enumerate(["p"] * 30 + ["q"] * 20 + ["r"] * 10)]
    got = li.training_sample(frame(spark, rows), train_docs=5, train_chars=11, max_langs=2)
    assert {lang for lang, _ in got} == {"p", "q"} and len(got) == 10 and {t for _, t in got} == {b"abc abc abc"}
