"""SentencePiece encoding and decoding by a forward pass over a trie of distinct words.

Texts are marked (a mark in front, each space a mark) and cut into words at marks and at
characters that no piece has, over which no piece reaches.  The distinct words of a batch
are sorted, so that equal prefixes adjoin, and walked as a trie depth-first: a stack holds
the forward state of every prefix of the current word, and the next word keeps the states
of the prefix that both share.  The state of a prefix is its last piece, the best of the
pieces that end there:

* unigram models: the piece with the largest sum of scores (Viterbi; ties: the longest);
* BPE models: the one piece that follows the best segmentation of the prefix before it as
  the merges would have it.  A segmentation is the merges' result exactly if each two
  neighbouring pieces, merged alone, stay these two; every prefix has one such last
  piece.  So the same forward pass gives the ids of the merge algorithm, where a plain sum
  of scores would not.

Characters without a piece become byte pieces, or the unknown id in models without these.
Words are handled whole, in time linear in their length.  A worker keeps the ids of words between
the batches of a task in two generations of at most KEPT_BYTES each, and gives their memory back
after it, as it lives on for the stages of other operators; words over LONG characters (whole texts, in
scripts without spaces) are walked on their own and not kept.

Results for odd input: a null text counts as empty and has no ids; a null id stays null;
repeated rows give repeated rows; an empty table gives no rows; all further columns are
kept, except that the new ones replace those of the same names.  ``decode`` gives back the marked text: equal
to the input, except for the model's own normalisation (none in the model used here).
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import let_go, positional

MARK = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values: kinds of pieces
# What a worker keeps between the batches of a task: words in each of two generations (bytes), compared pairs.
KEPT_BYTES = 12 << 20
WORD_BYTES = 180        # of a kept word, besides its characters and ids
LONG = 1024
KEPT_PAIRS = 200_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, data[at:at + n]
            at += n


class Model:
    """Pieces, scores and kinds of a model file, and the forward pass over its pieces."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.mode, self.dummy_prefix = UNIGRAM, True
        for field, value in _fields(data):
            if field == 1:
                p = dict(_fields(value))
                self.pieces.append(p[1].decode())
                self.scores.append(float(np.frombuffer(p.get(2, b"\0\0\0\0"), np.float32)[0]))
                self.kinds.append(p.get(3, NORMAL))
            elif field == 2:
                self.mode = dict(_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                self.dummy_prefix = bool(dict(_fields(value)).get(3, 1))
        usable = [i for i, k in enumerate(self.kinds) if k in (NORMAL, USER)]
        self.id_of = {self.pieces[i]: i for i in usable}
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == UNKNOWN), 0)
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i, k in enumerate(self.kinds) if k == BYTE}
        self.chars = {c for p in self.id_of for c in p}
        if any(MARK in p.lstrip(MARK) for p in self.id_of):
            raise ValueError("pieces that reach over words need another way of cutting texts")
        # Single characters without a piece are symbols too: they get ids past the pieces.
        self.symbols = {c: self.id_of.get(c, len(self.pieces) + k) for k, c in enumerate(sorted(self.chars))}
        self.text_of = dict(enumerate(self.pieces)) | {i: c for c, i in self.symbols.items()}
        self._fits: dict[int, bool] = {}
        self._alone: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.kept = 0
        self.bytes_of = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN
                         else p.replace(MARK, " ").encode() for p, k in zip(self.pieces, self.kinds)]

    @cached_property
    def trie(self) -> dict:
        """The pieces as a trie: a node maps a character to [the next node, the piece that ends there or -1]."""
        trie: dict = {}
        for piece, i in self.id_of.items():
            node, at = trie, None
            for c in piece:
                at = node.setdefault(c, [{}, -1])
                node = at[0]
            if at:
                at[1] = i
        return trie

    # ------------------------------------------------------------- merges (BPE)

    def merges(self, word: str) -> tuple[str, ...]:
        """The result of the merge algorithm on a short string: best score, then leftmost."""
        parts = list(word)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = self.id_of.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.scores[k] > best):
                    best, at = self.scores[k], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return tuple(parts)

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges leave two pieces, put together, as these two."""
        if len(self._fits) > KEPT_PAIRS:
            self._fits.clear()
        pair = (self.text_of[left], self.text_of[right])
        known = self._fits[left << 32 | right] = self.merges(pair[0] + pair[1]) == pair
        return known

    def alone(self, piece: int) -> bool:
        """Whether the merges make the piece of its own characters."""
        if piece not in self._alone:
            self._alone[piece] = len(self.merges(self.pieces[piece])) == 1
        return self._alone[piece]

    # ------------------------------------------------------------- forward pass

    def encode_words(self, words: list[str]) -> None:
        """Puts the ids (as bytes) of sorted distinct words of known characters into ``self.words``."""
        bpe, trie, symbols, scores, pairs, alone = self.mode == BPE, self.trie, self.symbols, self.scores, self._fits, self._alone
        last: list[int] = [-1]        # last[i]: last piece of the best segmentation of word[:i]
        size: list[int] = [0]         # its length
        total: list[float] = [0.0]    # the sum of scores
        live: list[list] = [[(trie, 0)]]  # trie nodes of word[s:i], with s, that longer pieces start with
        before = ""
        for word in words:
            n = len(word)
            if n > LONG:
                self.words[word] = self.encode_long(word)
                continue
            k, most = 0, min(n, len(before))
            while k < most and word[k] == before[k]:
                k += 1
            del last[k + 1:], size[k + 1:], total[k + 1:], live[k + 1:]
            for i in range(k + 1, n + 1):
                c = word[i - 1]
                chosen, length, best, going = -1, 1, 0.0, []
                for node, s in live[i - 1]:  # longest first
                    step = node.get(c)
                    if step is None:
                        continue
                    node, piece = step
                    if node:
                        going.append((node, s))
                    if piece < 0:
                        continue
                    if not bpe:
                        score = total[s] + scores[piece]
                        if chosen < 0 or score > best:
                            chosen, length, best = piece, i - s, score
                    elif chosen < 0:
                        if s:
                            fits = pairs.get(last[s] << 32 | piece)
                            if fits is None:
                                fits = self.fits(last[s], piece)
                        else:
                            fits = alone.get(piece)
                            if fits is None:
                                fits = self.alone(piece)
                        if fits:
                            chosen, length = piece, i - s
                if chosen < 0:
                    chosen, best = symbols[c], total[i - 1] - 1e9
                last.append(chosen)
                size.append(length)
                if not bpe:
                    total.append(best)
                going.append((trie, i))
                live.append(going)
            before = word
            out, i = [], n
            while i:
                out.append(last[i])
                i -= size[i]
            self.words[word] = self.packed(out[::-1])

    def encode_long(self, word: str) -> bytes:
        """The ids of a word of any length: the same pass, which keeps two numbers a character (three for unigrams)
        and the trie nodes of the place where it is."""
        last, size, total = array("i", [-1]), array("i", [0]), array("d", [0.0])
        live = [(self.trie, 0)]
        for i, c in enumerate(word, 1):
            chosen, length, best, going = -1, 1, 0.0, []
            for node, s in live:
                node, piece = node.get(c, (None, -1))
                if node:
                    going.append((node, s))
                if piece < 0:
                    continue
                if self.mode != BPE:
                    score = total[s] + self.scores[piece]
                    if chosen < 0 or score > best:
                        chosen, length, best = piece, i - s, score
                elif chosen < 0:
                    fits = (self._fits.get(last[s] << 32 | piece) if s else self._alone.get(piece))
                    if fits is None:
                        fits = self.fits(last[s], piece) if s else self.alone(piece)
                    if fits:
                        chosen, length = piece, i - s
            if chosen < 0:
                chosen, best = self.symbols[c], (total[i - 1] if self.mode != BPE else 0.0) - 1e9
            last.append(chosen)
            size.append(length)
            if self.mode != BPE:
                total.append(best)
            going.append((self.trie, i))
            live = going
        out, i = array("i"), len(word)
        while i:
            out.append(last[i])
            i -= size[i]
        out.reverse()
        return self.packed(out)

    def packed(self, symbols: list[int] | array) -> bytes:
        """Ids as bytes, symbols without a piece by their bytes or as the unknown id."""
        if max(symbols) >= len(self.pieces):
            symbols = [j for i in symbols for j in ([i] if i < len(self.pieces) else self.fallback(self.text_of[i]))]
        return array("i", symbols).tobytes()

    def fallback(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode("utf-8")] if self.byte_ids else [self.unknown]

    # ------------------------------------------------------------- texts

    @cached_property
    def kind_at(self) -> np.ndarray:
        """Kinds of code points, the last for all above: marks, known characters, unknown ones."""
        out = np.full(max(map(ord, self.chars | {MARK})) + 2, 2, np.int8)
        out[[ord(c) for c in self.chars]] = 1
        out[ord(MARK)] = 0
        return out

    def cut(self, texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
        """The marked words of texts, and the number of words before each text and the end.
        A word: marks and then other known characters; or a run of unknown characters."""
        front = MARK if self.dummy_prefix else ""
        marked = "".join([front + t for t in texts if t]).replace(" ", MARK)
        ends = np.cumsum([0, *[len(t) and len(t) + len(front) for t in texts]])
        codes = np.frombuffer(marked.encode("utf-32-le"), np.uint32)
        kind = self.kind_at[np.minimum(codes, len(self.kind_at) - 1)]
        start = np.ones(len(codes) + 1, bool)
        now, prev = kind[1:], kind[:-1]
        start[1:-1] = (now != prev) & ((now != 1) | (prev == 2))
        start[ends] = True
        size = np.ones(len(codes) + 1, np.int8)
        for least in (0x80, 0x800, 0x10000):
            size[:-1] += codes >= least
        at = np.flatnonzero(start)
        offsets = (np.cumsum(size, dtype=np.int64) - size)[at]
        words = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(offsets), pa.py_buffer(marked.encode()))
        return words, np.searchsorted(at, ends)

    def encode_flat(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The ids of all texts, and where each text's begin and the last one's end."""
        cut, first = self.cut(texts)
        coded = cut.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if self.kept > KEPT_BYTES:  # words in use move on to the new generation
            self.older, self.words, self.kept = self.words, {}, 0
        words, older = self.words, self.older
        new, seen = [], 0
        for w in distinct:
            if w not in words:
                seen += 1
                if w in older:
                    words[w] = older[w]
                elif w[0] != MARK and w[0] not in self.chars:
                    words[w] = array("i", [j for c in w for j in self.fallback(c)]).tobytes()
                else:
                    new.append(w)
        new.sort()
        self.encode_words(new)
        ids = [words[w] for w in distinct]
        for w in [w for w in new if len(w) > LONG]:
            del words[w]
        self.kept += seen * WORD_BYTES + sum(4 * len(w) for w in new if len(w) <= LONG)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        lists = pa.LargeListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(ids), np.int32)))
        ends = np.concatenate([[0], np.cumsum(sizes[coded.indices.to_numpy()])])
        return lists.take(coded.indices).flatten(), ends[first]

    def forget(self) -> None:
        """Drops the kept words and compared pairs."""
        self.words, self.older, self.kept = {}, {}, 0
        self._fits.clear()

    def encode(self, texts: list[str]) -> list[list[int]]:
        flat, ends = self.encode_flat(texts)
        flat = flat.to_pylist()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]

    def decode(self, ids) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


_MODELS: dict[int, Model] = {}
_BATCH_BYTES = 1 << 20  # of texts that are encoded or decoded together


def _model(data: bytes) -> Model:
    key = hash(data)
    if key not in _MODELS:
        _MODELS[key] = Model(data)
    return _MODELS[key]


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of about _BATCH_BYTES of a column, a row at least."""
    at = 0
    size = batch.column(column).nbytes / max(1, batch.num_rows)
    rows = max(1, int(_BATCH_BYTES / max(size, 1)))
    while at < batch.num_rows:
        yield batch.slice(at, rows)
        at += rows


def _encode(batches: Iterator[pa.RecordBatch], data, text: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    model = _model(data.value)
    try:
        for whole in batches:
            for b in _parts(whole, text):
                flat, lengths = model.encode_flat([t or "" for t in b.column(text).to_pylist()])
                made = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([*b.columns, made, pa.array(np.diff(lengths), pa.int64())], names=names)
            let_go()
    finally:
        model.forget()
        let_go()


def _decode(batches: Iterator[pa.RecordBatch], data, ids: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    model = _model(data.value)
    for whole in batches:
        for b in _parts(whole, ids):
            texts = [model.decode(x or []) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=names)


def _checked(batches: Iterator[pa.RecordBatch], data) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) through _encode and _decode, as digests."""
    names = ["doc_id", "text", "ids", "n_tokens", "decoded"]
    for b in _decode(_encode(batches, data, 1, names[:4]), data, 2, names):
        digest = [hashlib.sha256(x.values.to_numpy().tobytes()).hexdigest() for x in b.column(2)]
        texts = b.column(4).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(3), pa.array(digest, pa.string()),
             pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
             pa.array([x == y for x, y in zip(texts, b.column(1).to_pylist())], pa.bool_())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "exact"])


def _broadcast(docs: DataFrame, model_path: str):
    """The driver reads the model (under 1 MB), as executors may not see its folder."""
    with open(model_path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _with(docs: DataFrame, model_path: str, source: str, run, made: list[T.StructField]) -> DataFrame:
    """Adds columns by ``run``."""
    docs = docs.drop(*[f.name for f in made])
    data = _broadcast(docs, model_path)
    schema = T.StructType([*docs.schema.fields, *made])
    at, names = docs.columns.index(source), schema.names
    return positional(docs).mapInArrow(lambda it: run(it, data, at, names), schema)


def encode(docs: DataFrame, model_path: str = DEFAULT_MODEL, text_col: str = "text", ids_col: str = "token_ids",
           count_col: str = "n_tokens") -> DataFrame:
    """``docs`` with the token ids of the whole text and their number."""
    return _with(docs, model_path, text_col, _encode,
                 [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False)), T.StructField(count_col, T.LongType())])


def decode(docs: DataFrame, model_path: str = DEFAULT_MODEL, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of the token ids."""
    return _with(docs, model_path, ids_col, _decode, [T.StructField(text_col, T.StringType())])


def round_trip(docs: DataFrame, model_path: str = DEFAULT_MODEL) -> DataFrame:
    """Per document: its tokens, digests of their ids (as 32-bit little-endian numbers) and of the text
    they decode to, and whether this is the text.  Encodes and decodes in one pass of one worker."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    data = _broadcast(docs, model_path)
    return rows.mapInArrow(lambda it: _checked(it, data),
                           "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean")
