"""Token counts by offset-mapped attribution.

Each document is encoded once, as a whole, by a byte-level BPE vocabulary.
The tokens' byte lengths give their character spans; an interval join (binary
search in the section bounds) lays the spans over the document's sections, and
every token is allocated to exactly one section by a stated rule, so section
counts add up to the document's token count.

Rules for a token that crosses a section boundary:

* ``majority`` (default): the section that holds most of its characters, the
  earlier one on a tie;
* ``start``: the section that holds its first character.

A token that is only a part of one multi-byte character counts as covering it.

A run of white space of millions of characters would overflow the stack of the
split pattern's matcher; such runs are encoded as the one piece they are
(``encode_whole``), which leaves every token as it was.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import bound_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The public split pattern of this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Runs of white space (the characters of the pattern's ``\\s``) that are encoded on their own.
LONG_RUN = 10_000
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Rows of one output batch: a text of millions of lines is given out in several.
OUT_ROWS = 500_000

SECTION_SCHEMA = ("doc_id long, section int, char_start long, char_end long, "
                  "n_tokens long, n_crossing long, doc_tokens long")


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """The vocabulary file as {token bytes: rank}; fixed size, read on the driver."""
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in (line.split() for line in f if line.strip())}


def allocate(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token span and whether it crosses a bound.

    ``bounds``: the sections' first characters, ascending, starting at 0;
    empty sections share a bound and are never chosen for a character.
    """
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends - 1, "right") - 1
    crossing = last > first
    owner = first.copy()
    if rule == "majority":
        at = np.flatnonzero(crossing)
        if len(at):
            parts = last[at] - first[at] + 1                     # sections each crossing token touches
            begin = np.cumsum(parts) - parts
            token = np.repeat(np.arange(len(at)), parts)
            section = np.arange(len(token)) - np.repeat(begin - first[at], parts)
            left = np.maximum(bounds[section], starts[at][token])
            right = np.minimum(np.r_[bounds, np.iinfo(np.int64).max][section + 1], ends[at][token])
            held = right - left
            best = np.flatnonzero(held == np.maximum.reduceat(held, begin)[token])
            owner[at] = section[best[np.searchsorted(best, begin)]]   # the earliest of the fullest
    elif rule != "start":
        raise ValueError(f"unknown rule {rule!r}")
    return owner, crossing


def encode_whole(text: str, encoding) -> np.ndarray:
    """The token ids of a text under ``PATTERN``, whatever its length.

    The pattern takes a run of white space before other text as one piece
    without its last character, and at the end of the text as one piece; and a
    piece always ends where white space begins.  So a long run can be cut out and
    encoded as that piece.
    """
    ids, at = [], 0
    for run in re.finditer(_SPACE + "{%d,}" % LONG_RUN, text):
        end = run.end() - (run.end() < len(text))
        ids += [encoding.encode_ordinary(text[at:run.start()]), encoding._encode_single_piece(text[run.start():end])]
        at = end
    ids.append(encoding.encode_ordinary(text[at:]))
    return np.concatenate([np.asarray(i, np.int64) for i in ids])


def section_counts(parts: Sequence[str], encode, token_bytes: np.ndarray, rule: str):
    """(char_start, char_end, n_tokens, n_crossing) of each part and the document's token count."""
    text = "".join(parts)
    lens = np.fromiter((len(p) for p in parts), np.int64, len(parts))
    ends = np.cumsum(lens)
    bounds = ends - lens
    ids = np.asarray(encode(text), np.int64)
    raw = np.frombuffer(text.encode(), np.uint8)
    counts = np.zeros(len(parts), np.int64)
    crossed = np.zeros(len(parts), np.int64)
    if len(ids):
        char_of = np.cumsum((raw & 0xC0) != 0x80) - 1      # character of each byte
        byte_end = np.cumsum(token_bytes[ids])
        t_start = char_of[byte_end - token_bytes[ids]]
        t_end = char_of[byte_end - 1] + 1
        owner, crossing = allocate(t_start, t_end, bounds, rule)
        counts += np.bincount(owner, minlength=len(parts))
        crossed += np.bincount(owner[crossing], minlength=len(parts))
    return bounds, ends, counts, crossed, len(ids)


def line_sections(text: str) -> list[str]:
    """A text's lines, each with the line feed that ends it; '' is one empty section."""
    parts = text.split("\n")
    return [p + "\n" for p in parts[:-1]] + ([parts[-1]] if parts[-1] or len(parts) == 1 else [])


def token_counts(docs: DataFrame, fields: Sequence[str] = ("text",), by: str = "lines", rule: str = "majority",
                 vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Tokens of each document and of each of its sections.

    ``fields``: the text columns that make up a document, in order; null
    fields count as empty.  ``by``: ``lines`` cuts the joined text after each
    line feed, ``fields`` takes every field as one section.  One row per
    document row and section: ``doc_id, section`` (from 0), ``char_start``,
    ``char_end`` (end exclusive), ``n_tokens``, ``n_crossing`` (allocated
    tokens that cross a bound) and ``doc_tokens``.  An empty document has one
    empty section; repeated rows are each counted; other columns are ignored;
    an empty table gives no rows.  A text may be of any length and repeat one
    character; with a ``pattern`` of one's own, the matcher's limits hold.  A map
    over the rows without any shuffle.
    """
    if by not in ("lines", "fields"):
        raise ValueError(f"unknown sections {by!r}")
    bound_batches(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))   # fixed size: the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        encode = (lambda text: encode_whole(text, encoding)) if pattern == PATTERN else encoding.encode_ordinary
        token_bytes = np.zeros(max(ranks.value.values()) + 1, np.int64)
        for tok, rank in ranks.value.items():
            token_bytes[rank] = len(tok)
        for batch in batches:
            cols = [batch.column(i + 1).to_pylist() for i in range(len(fields))]
            out, n = [], []
            for values in zip(*cols, strict=True):
                parts = [v or "" for v in values]
                if by == "lines":
                    parts = line_sections("".join(parts))
                out.append(section_counts(parts, encode, token_bytes, rule))
                n.append(len(parts))
            if not out:
                continue
            rows = np.repeat(np.arange(len(n)), n)
            counted = pa.record_batch({
                "doc_id": batch.column(0).take(pa.array(rows)),
                "section": pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in n])),
                "char_start": pa.array(np.concatenate([o[0] for o in out])),
                "char_end": pa.array(np.concatenate([o[1] for o in out])),
                "n_tokens": pa.array(np.concatenate([o[2] for o in out])),
                "n_crossing": pa.array(np.concatenate([o[3] for o in out])),
                "doc_tokens": pa.array(np.repeat(np.array([o[4] for o in out], np.int64), n)),
            })
            for i in range(0, counted.num_rows, OUT_ROWS):
                yield counted.slice(i, OUT_ROWS)

    picked = docs.select(F.col("doc_id").cast("long"), *[F.col(f).cast("string") for f in fields])
    return picked.mapInArrow(run, SECTION_SCHEMA)
