import hashlib
import random

import numpy as np
import pytest

from hearth.llm import pieces as pc

spm = pytest.importorskip("sentencepiece")
SCHEMA = "doc_id long, text string, ids string, decoded string"


@pytest.fixture(scope="module")
def model():
    return pc.read_model()


@pytest.fixture(scope="module")
def library():
    return spm.SentencePieceProcessor(model_file=pc.model_path())


def agree(model, library, texts):
    ids, counts = pc.Encoder(model).encode(texts)
    want = library.encode(texts, add_eos=True)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
    assert pc.decode_lists(model, ids.astype(np.int64), counts) == library.decode(want)


def test_odd_texts_and_blanks_as_the_library(model, library):
    odd = ["", " ", "  a", "a", "▁a", " ▁", "a  ", "\0a\0", "x\x80é𝔸😀", "</s>", "<s>a", "<0x41>", "\n\n", "\t\r\n", "e\u0301", "ﬁ Ａ ①"]
    runs = [a + " " * k + b for k in range(70) for a in ("", "x") for b in ("", "b", "\n", "the")]
    agree(model, library, odd + runs)


def test_random_texts_as_the_library(model, library):
    rng = random.Random(1)
    vocabulary = [library.id_to_piece(i) for i in range(259, 32000)]
    agree(model, library, ["".join(rng.choice("ab é\n\n .,1日𝔸▁  theing") for _ in range(rng.randint(0, 120))) for _ in range(3000)])
    agree(model, library, ["".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30))) for _ in range(3000)])


def test_very_long_words_as_the_library(model, library):
    rng = random.Random(2)
    agree(model, library, [" " * 300_001, "a" * 300_000, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000)),
                           "日本語" * 30_000, "🙂" * 20_000])


def test_decoding_any_ids_as_the_library(model, library):
    rng = random.Random(3)
    pool = [0, 1, 2, 259, 264, *range(3, 400)]
    for _ in range(4000):
        ids = [rng.choice(pool) for _ in range(rng.randint(0, 12))]
        assert pc.decode_ids(model, np.array(ids, np.int64)) == library.decode(ids)


def test_words_kept_between_batches_are_bounded(model, library, monkeypatch):
    monkeypatch.setattr(pc, "KEPT_WORDS", 3)
    encoder = pc.Encoder(model)
    for text in ("one two three four five", "six one two", "seven", "two"):
        ids, _ = encoder.encode([text])
        assert ids.tolist() == library.encode(text, add_eos=True) and len(encoder._place) <= 8


def plain(pairs, word):
    """Pair by pair: the best rank, the leftmost of equals."""
    word = list(word)
    while True:
        ranked = [(pairs[a, b][0], i) for i, (a, b) in enumerate(zip(word, word[1:])) if (a, b) in pairs]
        if not ranked:
            return word
        i = min(ranked)[1]
        word[i:i + 2] = [pairs[word[i], word[i + 1]][1]]


def test_rounds_equal_pair_by_pair_for_any_ranks(model):
    """Also where a joined piece ranks before its parts, or equal to them."""
    rng = random.Random(4)
    for _ in range(150):
        strings = {c for c in "abc"} | {"".join(rng.choice("abc") for _ in range(rng.randint(2, 4))) for _ in range(12)}
        symbol = {p: i for i, p in enumerate(sorted(strings))}
        rank = {p: rng.randint(0, 6) for p in strings}
        pairs = {(symbol[p[:i]], symbol[p[i:]]): (rank[p], symbol[p])
                 for p in strings for i in range(1, len(p)) if p[:i] in symbol and p[i:] in symbol}
        n = len(symbol)
        keys = sorted(a * n + b for a, b in pairs)
        own = pc.Model(**{**vars(model), "n_symbols": n, "pair_key": np.array(keys, np.int64),
                          "pair_rank": np.array([pairs[divmod(k, n)][0] for k in keys], np.int32),
                          "pair_joined": np.array([pairs[divmod(k, n)][1] for k in keys], np.int32)})
        words = [[symbol[rng.choice("abc")] for _ in range(rng.randint(1, 12))] for _ in range(8)]
        starts = np.cumsum([0] + [len(w) for w in words[:-1]])
        got, at = pc.merge_rounds(own, np.array(sum(words, [])), starts)
        assert got.tolist() == sum((plain(pairs, w) for w in words), [])
        assert set(starts.tolist()) <= set(at.tolist())


def test_nulls_repeats_empty_table_and_clashing_columns(spark, library):
    rows = [(1, "Hello  world"), (2, None), (3, ""), (None, "no id"), (1, "Hello  world"), (5, "word " * 20_000)]
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)
    got = sorted(((r.doc_id, list(r.ids), r.decoded) for r in pc.encode_decode(df).collect()), key=str)
    assert got == sorted(((d, library.encode(t or "", add_eos=True), t or "") for d, t in rows), key=str)
    assert pc.encode_decode(df.limit(0)).collect() == []


def test_query_digests(spark, library):
    from hearth.llm.common import table
    from hearth.llm.queries import QUERIES

    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_piece_round_trip"](spark, "/root/testdata/sf0.001").collect()}
    docs = table(spark, "/root/testdata/sf0.001", "documents").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r.text or "", add_eos=True)
        assert got[r.doc_id] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                                 hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_other_models_are_refused(tmp_path):
    """A model that writes no blank before the text, and one that is not byte-pair."""
    with open(pc.model_path(), "rb") as f:
        data = f.read()
    at = data.rindex(b"identity")
    assert data[at + 10:at + 14] == b"\x18\x01\x20\x00"
    for where, value in ((at + 11, 0), (at + 13, 1)):
        changed = bytearray(data)
        changed[where] = value
        (tmp_path / "other.model").write_bytes(changed)
        with pytest.raises(ValueError):
            pc.read_model(str(tmp_path / "other.model"))
