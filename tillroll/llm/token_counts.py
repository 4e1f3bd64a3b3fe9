"""Token counts by section, from one encoding of each whole document.

Method (offset-mapped attribution): a document is encoded once, whole; the byte lengths
of its tokens give each token's character span; the spans are interval-joined to the
document's sections (sorted, so a binary search for each token); a token that crosses a
section boundary is allocated by a stated rule:

* ``largest``: to the section that holds most of its characters, the earlier of ties;
* ``start``: to the section that holds its first character.

Beside that, ``n_tokens_share`` splits every token by characters, so fractions add up to
the document's tokens too.  A token that holds only some bytes of a character counts as
spanning this whole character.

Results for odd input: a null or empty text has one empty section with no tokens (none
with given sections); a null id stays null; repeated rows give repeated results; an empty
table gives no rows; only the named columns are read.  Characters in no given section are
counted in a row whose ``section`` is null.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the published pre-tokenisation pattern of this byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
RULES = ("largest", "start")
# White space, as the pattern's \s.  Longer runs of it overflow the pattern's look-ahead, so their
# pre-token, all of the run but what may join the next word, goes to the merges directly.
SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % (1 << 14))
SCHEMA = ("doc_id long, section int, start long, end long, n_tokens long, n_tokens_share double, "
          "n_crossing long")

_ENCODERS: dict[int, tuple] = {}


def _encoder(ranks: bytes):
    """The encoder and the byte length of each token id; built once in a worker."""
    key = hash(ranks)
    if key not in _ENCODERS:
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        enc = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        size = np.zeros(max(table.values()) + 1, np.int64)
        size[list(table.values())] = [len(b) for b in table]
        _ENCODERS[key] = (enc, size)
    return _ENCODERS[key]


def encode(text: str, enc) -> list[int]:
    """Token ids of the whole ``text``."""
    ids, at = [], 0
    for m in SPACES.finditer(text):
        end = m.end() if m.end() == len(text) else m.end() - 1
        ids += enc.encode_ordinary(text[at:m.start()])
        ids += enc._encode_single_piece(text[m.start():end])
        at = end
    return ids + enc.encode_ordinary(text[at:])


def token_spans(text: str, enc, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each token of ``text`` in characters."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids = np.asarray(encode(text, enc), np.int64)
    ends = np.cumsum(size[ids])
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    if len(raw) == len(text):
        return ends - size[ids], ends
    char = np.cumsum((raw & 0xC0) != 0x80)  # number of characters begun up to each byte
    return char[ends - size[ids]] - 1, char[ends - 1]


def line_edges(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lines, each with its line break, as character intervals."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(points == 10) + 1
    if not len(ends) or ends[-1] != len(text):
        ends = np.append(ends, len(text))
    return np.concatenate(([0], ends[:-1])), ends


def allocate(ts: np.ndarray, te: np.ndarray, ss: np.ndarray, se: np.ndarray, rule: str):
    """Tokens, their shares and the crossing tokens of each section; last: of no section.

    ``ts``/``te``: token spans in order; ``ss``/``se``: sorted sections that do not overlap.
    """
    n = len(ss)
    count, share, cross = np.zeros(n + 1, np.int64), np.zeros(n + 1), np.zeros(n + 1, np.int64)
    first = np.searchsorted(se, ts, side="right")
    last = np.searchsorted(ss, te, side="left") - 1
    whole = (first == last) & (first < n)
    whole[whole] &= (ss[first[whole]] <= ts[whole]) & (te[whole] <= se[first[whole]])
    count[:n] += np.bincount(first[whole], minlength=n)[:n]
    share += count
    for t in np.flatnonzero(~whole).tolist():
        a, b = int(ts[t]), int(te[t])
        part = [(i, min(b, int(se[i])) - max(a, int(ss[i]))) for i in range(int(first[t]), int(last[t]) + 1)]
        part = [(i, k) for i, k in part if k > 0]
        out = b - a - sum(k for _, k in part)
        for i, k in part + [(n, out)] * (out > 0):
            share[i] += k / (b - a)
            cross[i] += len(part) + (out > 0) > 1
        if rule == "start":
            home = next((i for i, _ in part if ss[i] <= a), n)
        else:
            home = max(part + [(n, out)], key=lambda x: (x[1], -x[0]))[0]
        count[home] += 1
    return count, share, cross


def _attribute(batches: Iterator[pa.RecordBatch], ranks, rule: str) -> Iterator[pa.RecordBatch]:
    enc, size = _encoder(ranks.value)
    names = SCHEMA.replace(",", "").split()[::2]
    for batch in batches:
        given = batch.column(2) if batch.num_columns > 2 else None
        out: list[list[np.ndarray]] = [[] for _ in names]
        rows, none = [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            if given is None:
                ss, se = line_edges(text)
            else:
                spans = sorted((x["start"], x["end"], k) for k, x in enumerate(given[i].as_py() or []))
                ss, se = (np.array([s[j] for s in spans], np.int64) for j in (0, 1))
            count, share, cross = allocate(*token_spans(text, enc, size), ss, se, rule)
            keep = len(ss) + bool(share[-1] or count[-1])
            rows += [i] * keep
            none += [False] * len(ss) + [True] * (keep - len(ss))
            for col, v in zip(out[1:], (np.arange(len(count), dtype=np.int32), np.append(ss, 0), np.append(se, 0),
                                        count, share, cross)):
                col.append(v[:keep])
        if not rows:
            continue
        cols = [np.concatenate(c) for c in out[1:]]
        mask = np.array(none)
        arrays = [batch.column(0).take(pa.array(rows))]
        arrays += [pa.array(c, mask=mask) for c in cols[:3]] + [pa.array(c) for c in cols[3:]]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def token_counts(docs: DataFrame, ranks_path: str = DEFAULT_RANKS, rule: str = "largest",
                 sections: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of each section of each whole text.

    ``sections`` names an ``array<struct<start:long,end:long>>`` column of character
    intervals that do not overlap; without it the sections are the lines.  The vocabulary
    (under 1 MB) is read by the driver and broadcast, as executors may not see its folder.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    cols = [F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")]
    if sections:
        cols.append(F.col(sections).cast("array<struct<start:long,end:long>>").alias("sections"))
    return docs.select(*cols).mapInArrow(lambda it: _attribute(it, ranks, rule), SCHEMA)
