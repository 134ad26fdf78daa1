"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a word (with a blank on either side, cut
into pieces of ``PIECE`` bytes if longer) forwards and backwards and labels
every byte with language probabilities; a document's probability of a language
is the mean over the bytes of all its words that hold a letter.  Equal words
get equal labels, so a task labels each distinct word of a batch once and
weighs it by its occurrences: every position of the whole text counts.

The network is trained here, in numpy, by backpropagation through time and
Adam, on a bounded sample: of the ``MAX_LANGS`` languages with the most
labelled documents, at most ``train_docs`` documents each, chosen by a hash of
their id, and of each document at most ``TRAIN_CHARS`` characters.  Predictions
read whole texts.

A letter is a character of Unicode's category L.  Long words are cut where a
character starts, so a text has a lettered piece exactly if it has a letter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import bound_batches, held_out

HIDDEN = 16
TRAIN_DOCS = 200          # per language; with the next two the bound on the training sample
TRAIN_CHARS = 16_384      # of a training text
MAX_LANGS = 64            # languages learned, the most frequent first
STEPS = 700
BATCH = 384
PIECE = 48
CHUNK = 512               # words labelled at once: small enough for the caches
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_NAMES = ("xf", "uf", "xb", "ub", "v", "c")


@dataclass
class Network:
    """Parameters: per direction the byte table (256 x 3H) and recurrence (H x 3H), and the output layer."""

    langs: list[str]
    weights: dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


def _run(x: np.ndarray, u: np.ndarray, seq: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States after each byte: (length, words, hidden).  ``keep`` collects what the backward pass needs."""
    hidden = u.shape[0]
    h = np.zeros((len(seq), hidden), np.float32)
    out = np.empty((seq.shape[1], len(seq), hidden), np.float32)
    for t in range(seq.shape[1]):
        g, a = x[seq[:, t]], h @ u
        zr = _sigmoid(g[:, :2 * hidden] + a[:, :2 * hidden])
        z, r = zr[:, :hidden], zr[:, hidden:]
        n = np.tanh(g[:, 2 * hidden:] + r * a[:, 2 * hidden:])
        if keep is not None:
            keep.append((h, z, r, n, a[:, 2 * hidden:]))
        h = n + z * (h - n)
        out[t] = h
    return out


def _back(grad: np.ndarray, x: np.ndarray, u: np.ndarray, seq: np.ndarray, keep: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the byte table and the recurrence, through time."""
    hidden = u.shape[0]
    dx, du = np.zeros_like(x), np.zeros_like(u)
    dh = np.zeros((len(seq), hidden), np.float32)
    for t in range(seq.shape[1] - 1, -1, -1):
        h, z, r, n, an = keep[t]
        dh = dh + grad[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * an * r * (1 - r)
        da = np.concatenate([dz, dr, dn * r], 1)
        np.add.at(dx, seq[:, t], np.concatenate([dz, dr, dn], 1))
        du += h.T @ da
        dh = dh * z + da @ u.T
    return dx, du


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def padded(words: list[bytes]) -> np.ndarray:
    """Words of one length as a byte matrix with a blank on either side."""
    m = np.full((len(words), len(words[0]) + 2), 32, np.uint8)
    m[:, 1:-1] = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
    return m


def label(net: Network, seq: np.ndarray) -> np.ndarray:
    """Probabilities of every position but the outer blanks: (length, words, languages)."""
    w = net.weights
    f = _run(w["xf"], w["uf"], seq)
    b = _run(w["xb"], w["ub"], seq[:, ::-1])[::-1]
    return _softmax(np.concatenate([f, b], 2)[1:-1] @ w["v"] + w["c"])


def step(net: Network, seq: np.ndarray, lang: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over all positions, and its gradients."""
    w, kf, kb = net.weights, [], []
    f = _run(w["xf"], w["uf"], seq, kf)
    b = _run(w["xb"], w["ub"], seq[:, ::-1], kb)[::-1]
    both = np.concatenate([f, b], 2)
    p = _softmax(both[1:-1] @ w["v"] + w["c"])
    n = p.shape[0] * p.shape[1]
    loss = -np.log(p[:, np.arange(len(lang)), lang] + 1e-12).mean()
    p[:, np.arange(len(lang)), lang] -= 1
    p /= n
    d = np.zeros_like(both)
    d[1:-1] = p @ w["v"].T
    hidden = f.shape[2]
    dxf, duf = _back(d[:, :, :hidden], w["xf"], w["uf"], seq, kf)
    dxb, dub = _back(d[::-1, :, hidden:], w["xb"], w["ub"], seq[:, ::-1], kb)
    dv = np.einsum("twh,twc->hc", both[1:-1], p)
    return float(loss), {"xf": dxf, "uf": duf, "xb": dxb, "ub": dub, "v": dv, "c": p.sum((0, 1))}


def pieces(text: bytes) -> list[bytes]:
    """The text's words, long ones cut into pieces of at most ``PIECE`` bytes, never inside a character."""
    words = text.split()
    if len(words) and max(map(len, words)) > PIECE:
        words = [p for w in words for p in ([w] if len(w) <= PIECE else _cut(w))]
    return words


def _cut(word: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(word):
        end = at + PIECE
        # back over the at most three bytes that continue a character
        back = next((k for k in range(4) if end - k >= len(word) or word[end - k] & 0xC0 != 0x80), 0)
        yield word[at:end - back]
        at = end - back


def _lettered(word: bytes) -> bool:
    return _LETTER.search(word.decode("utf-8", "replace")) is not None


def train(samples: list[tuple[str, bytes]], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, seed: int = 5) -> Network:
    """A network fitted to (language, text) pairs; languages weigh alike."""
    rng = np.random.default_rng(seed)
    langs = sorted({lang for lang, _ in samples})
    counts = [Counter() for _ in langs]
    for lang, text in samples:
        counts[langs.index(lang)].update(pieces(text))
    by_len: dict[int, tuple[list[bytes], list[int], list[float]]] = {}
    for k, c in enumerate(counts):
        c = {w: n for w, n in sorted(c.items()) if _lettered(w)}
        total = sum(c.values())
        for word, n in c.items():
            words, lab, weight = by_len.setdefault(len(word), ([], [], []))
            words.append(word)
            lab.append(k)
            weight.append(n / total)
    r = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    weights = {"xf": r(256, 3 * hidden, scale=0.3), "uf": r(hidden, 3 * hidden, scale=hidden ** -0.5),
               "xb": r(256, 3 * hidden, scale=0.3), "ub": r(hidden, 3 * hidden, scale=hidden ** -0.5),
               "v": r(2 * hidden, len(langs), scale=0.3), "c": np.zeros(len(langs), np.float32)}
    net = Network(langs, weights)
    if len(langs) < 2 or not by_len:
        return net
    lengths = sorted(by_len)
    data = {n: (padded(by_len[n][0]), np.array(by_len[n][1]), np.cumsum(by_len[n][2])) for n in lengths}
    # a length is drawn by its share of positions
    share = np.array([data[n][2][-1] * n for n in lengths])
    m = {k: np.zeros_like(w) for k, w in weights.items()}
    v = {k: np.zeros_like(w) for k, w in weights.items()}
    for i in range(1, steps + 1):
        n = lengths[rng.choice(len(lengths), p=share / share.sum())]
        seq, lab, cum = data[n]
        pick = np.minimum(np.searchsorted(cum, rng.random(batch) * cum[-1], "right"), len(lab) - 1)
        _, grads = step(net, seq[pick], lab[pick])
        rate = 0.02 * min(1.0, 2 * (1 - i / (steps + 1)))
        for k, g in grads.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            weights[k] -= (rate * (m[k] / (1 - 0.9 ** i)) / (np.sqrt(v[k] / (1 - 0.99 ** i)) + 1e-8)).astype(np.float32)
    return net


def word_sums(net: Network, words: list[bytes]) -> np.ndarray:
    """Per word: its positions' probabilities summed (words without a letter: zero)."""
    out = np.zeros((len(words), len(net.langs)))
    by_len: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if _lettered(w):
            by_len.setdefault(len(w), []).append(i)
    for at in by_len.values():
        for j in range(0, len(at), CHUNK):
            part = at[j:j + CHUNK]
            out[part] = label(net, padded([words[i] for i in part])).sum(0)
    return out


def classify(net: Network, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Best language (its number, -1 without a letter) and its pooled probability, per text."""
    index: dict[bytes, int] = {}
    at = [[index.setdefault(w, len(index)) for w in pieces(t)] for t in texts]
    sums = word_sums(net, list(index))
    best, score = np.full(len(texts), -1), np.zeros(len(texts))
    for d, ids in enumerate(at):
        pooled = sums[np.array(ids, np.int64)].sum(0)
        total = pooled.sum()
        if total > 0:
            best[d] = int(pooled.argmax())
            score[d] = pooled[best[d]] / total
    return best, np.clip(score, 0.0, 1.0)


def training_sample(docs: DataFrame, train_docs: int = TRAIN_DOCS, modulus: int = 4, remainder: int = 2,
                    train_chars: int = TRAIN_CHARS, max_langs: int = MAX_LANGS) -> list[tuple[str, bytes]]:
    """At most ``train_docs`` texts of each non-null ``lang`` outside the held-out fold.

    Ranked by a hash of the id below the shuffle, so no language is gathered
    anywhere; the bounded sample is what reaches the driver: ``max_langs``
    languages (those with the most such documents, ties to the smaller name)
    times ``train_docs`` documents times ``train_chars`` characters.
    """
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    rows = (docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
                .where(F.col("lang").isNotNull() & F.substring("text", 1, train_chars).rlike(r"\p{L}")
                       & ~held_out(F.col("doc_id"), modulus, remainder)))
    langs = [r[0] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).collect()]
    rows = (rows.where(F.col("lang").isin(langs))
                .withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= train_docs))
    got = rows.select("lang", F.substring("text", 1, train_chars).cast("binary"), "_n").collect()
    return [(r[0], bytes(r[1])) for r in sorted(got, key=lambda r: (r[0], r[2]))]


def predict(docs: DataFrame, net: Network | None, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Every row of ``docs`` with its predicted language and that language's probability.

    All columns are kept; ``pred`` and ``score`` must not be among them.  The
    prediction reads ``text`` alone: null, empty or letterless text, and any
    text when ``net`` is None, is ``und`` with score 0.
    """
    if {pred, score} & set(docs.columns):
        raise ValueError("the documents already have a column of that name")
    out = docs.withColumn(pred, F.lit(UNDETERMINED)).withColumn(score, F.lit(0.0))
    if net is None:
        return out
    bound_batches(docs.sparkSession)
    text_at, langs, weights = docs.columns.index("text"), net.langs, net.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = Network(langs, weights)
        for batch in batches:
            texts = batch.column(text_at).cast(pa.binary()).to_pylist() if batch.num_rows else []
            best, prob = classify(local, [t or b"" for t in texts])
            named = pa.array([langs[b] if b >= 0 else UNDETERMINED for b in best.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], named, pa.array(prob, pa.float64())], names=batch.schema.names)

    return out.mapInArrow(run, out.schema)


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS, **options) -> Network | None:
    """The network fitted to the training sample of ``docs``; None without any labelled text."""
    samples = training_sample(docs, train_docs)
    return train(samples, **options) if samples else None


def identify(docs: DataFrame, **options) -> DataFrame:
    """Train on the labelled documents outside the held-out fold, then label every row.

    ``doc_id, held_out, lang_pred, score``.  Null languages are not learned
    from; repeated rows are each labelled; an empty table gives no rows.
    """
    rows = docs.select("doc_id", "text")
    return predict(rows, fit(docs, **options)).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = 0.3, **options) -> DataFrame:
    """The document rows whose text has a language with at least ``min_score``; all columns kept.

    When no document has a label there is nothing to learn languages from, and
    only null, empty and letterless texts go.
    """
    net = fit(docs, **options)
    if net is None:
        return docs.where(F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    pred, score = "lang_pred", "lang_score"
    while {pred, score} & set(docs.columns):
        pred, score = pred + "_", score + "_"
    labelled = predict(docs, net, pred, score)
    return labelled.where((F.col(pred) != UNDETERMINED) & (F.col(score) >= min_score)).drop(pred, score)
