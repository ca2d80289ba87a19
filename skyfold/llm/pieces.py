"""Operator 1, SentencePiece encoding and decoding with a fixed public vocabulary.

An Aho-Corasick automaton over the pieces reads a text once. At every place
the automaton's state and its output links give all pieces that end there, and
each relaxes the best score of that place (Viterbi for the sum of the piece
scores). A character that no piece covers alone may also be passed over as
unknown, at the least score less ``UNKNOWN_PENALTY``; it is written as the
byte pieces of its UTF-8 form.

No piece continues over a space, so the words of a text are independent, and
a bounded cache of two generations holds the result of words that come again.
Spaces stand in the automaton as spaces (the vocabulary's U+2581), so that a
U+2581 in the text is an ordinary unknown character and every text decodes to
itself. Each word is decoded again when it enters the cache, which proves the
round trip of the texts made of such words.

Of equal scores the longer last piece wins. Defined cases: null text gives null
ids, zero tokens and a true round trip; an empty text gives no token.
"""

from __future__ import annotations

import hashlib
import pickle
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructType

from skyfold.llm import bytekit as bk

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Units of a generation of the cache, and the longest unit kept there.
CACHE_WORDS, CACHE_CHARS = 150_000, 48
_LEAST, _ALONE = -float("inf"), (1, -1, 0.0)


class Vocabulary:
    """Pieces (with plain spaces), their ids and scores, and the 256 byte pieces."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]) -> None:
        self.pieces, self.byte_ids = pieces, byte_ids
        self.unknown = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN_PENALTY

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {*byte_ids, *(i for i in ids if model.is_unknown(i) or model.is_control(i) or model.is_unused(i))}
        return cls({model.id_to_piece(i).replace(SPACE, " "): (i, model.get_score(i)) for i in ids if i not in special}, byte_ids)


class Encoder:
    """The automaton, and the cache of words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.unknown, self.byte_ids = vocabulary.unknown, vocabulary.byte_ids
        self.next: list[dict[str, int]] = [{}]
        self.piece: list[tuple[int, int, float] | None] = [None]
        for text, (i, score) in vocabulary.pieces.items():
            state = 0
            for c in text:
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    self.piece.append(None)
                state = self.next[state][c]
            self.piece[state] = (len(text), i, score)
        self._link()
        self.bytes_of = [b""] * (max([i for i, _ in vocabulary.pieces.values()] + self.byte_ids) + 1)
        for text, (i, _) in vocabulary.pieces.items():
            self.bytes_of[i] = text.encode()
        for b, i in enumerate(self.byte_ids):
            self.bytes_of[i] = bytes([b])
        if any(" " in p.lstrip(" ") for p in vocabulary.pieces):
            self.units = re.compile(r"(?s).+")
        else:
            alone = "".join(c for c in "\n\t\r" if not any(c in p for p in vocabulary.pieces))
            self.units = re.compile(rf" *[^ {alone}]+| +" + (f"|[{alone}]" if alone else ""))
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.lossy: set[str] = set()

    def _link(self) -> None:
        """Fail links, and of every state the pieces along its output links, longest first."""
        self.fail = [0] * len(self.next)
        self.out: list[tuple[tuple[int, int, float], ...]] = [()] * len(self.next)
        queue = [0]
        for state in queue:
            for c, child in self.next[state].items():
                if state:
                    f = self.fail[state]
                    while f and c not in self.next[f]:
                        f = self.fail[f]
                    self.fail[child] = self.next[f].get(c, 0)
                own = self.piece[child]
                self.out[child] = ((own,) if own else ()) + self.out[self.fail[child]]
                queue.append(child)

    def _step(self, state: int, c: str) -> int:
        """The state after ``c``; what the fail links lead to is noted in the state."""
        at = state
        while at and c not in self.next[at]:
            at = self.fail[at]
        after = self.next[at].get(c, 0)
        if after:
            self.next[state][c] = after
        return after

    def segment(self, text: str) -> list[int]:
        """Ids of the best segmentation of a stretch of text."""
        nxt, out, unknown = self.next, self.out, self.unknown
        best, back, state, i = [0.0], [_ALONE], 0, 0
        for c in text:
            i += 1
            state = nxt[state].get(c) or self._step(state, c)
            top, how, alone = _LEAST, _ALONE, False
            for piece in out[state]:
                score = piece[2] + best[i - piece[0]]
                if score > top:
                    top, how = score, piece
                alone = piece[0] == 1
            if not alone and best[i - 1] + unknown > top:
                top, how = best[i - 1] + unknown, _ALONE
            best.append(top)
            back.append(how)
        ids, i = [], len(text)
        while i:
            length, piece, _ = back[i]
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(self.byte_ids[b] for b in reversed(text[i - 1].encode()))
            i -= length
        return ids[::-1]

    def word(self, unit: str) -> bytes:
        """Ids of a unit as bytes, from the cache's older generation or anew."""
        got = self.old.get(unit)
        if got is None:
            ids = np.array(self.segment(unit), np.int32)
            got = ids.tobytes()
            if b"".join(map(self.bytes_of.__getitem__, ids.tolist())) != unit.encode():
                self.lossy.add(unit)
        if len(unit) <= CACHE_CHARS:
            if len(self.cache) >= CACHE_WORDS:
                self.old, self.cache = self.cache, {}
            self.cache[unit] = got
        return got

    def encode_bytes(self, text: str) -> tuple[bytes, bool]:
        """The ids as bytes of an int32 array, and whether every unit decodes to itself."""
        if not text:
            return b"", True
        get, word = self.cache.get, self.word
        units = self.units.findall(" " + text)
        ids = b"".join([get(u) or word(u) for u in units])
        return ids, not self.lossy or self.lossy.isdisjoint(units)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text)[0], np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of the text; the space that encoding puts first goes."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))[1:]


#: The encoder of a worker process: that of the last vocabulary used.
_ENCODER: list = [None, None]


def _encoder(shared) -> Encoder:
    if _ENCODER[0] != shared.id:
        _ENCODER[:] = shared.id, Encoder(shared.value)
    return _ENCODER[1]


class _Shared:
    """A broadcast vocabulary and a name for it by which workers know it again."""

    def __init__(self, spark, value: Vocabulary) -> None:
        self.broadcast = spark.sparkContext.broadcast(value)
        self.id = hashlib.sha256(pickle.dumps((sorted(value.pieces.items()), value.byte_ids))).hexdigest()

    @property
    def value(self):
        return self.broadcast.value


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``docs`` with ``token_ids`` array<int>, ``n_tokens`` long and ``round_trip`` boolean (the ids
    decode to the text); columns of these names are replaced."""
    spark = docs.sparkSession
    added = {"token_ids": ArrayType(IntegerType()), "n_tokens": LongType(), "round_trip": BooleanType()}
    own = [c for c in docs.columns if c not in added]
    shared = _Shared(spark, Vocabulary.load(model))

    def run(batches):
        coder = _encoder(shared)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            coded = [coder.encode_bytes(t) if t else (b"", True) for t in texts.to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids, _ in coded], dtype=np.int64)])
            same = [x for _, x in coded]
            flat = pa.array(np.frombuffer(b"".join(ids for ids, _ in coded), np.int32))
            mask = texts.is_null() if texts.null_count else None
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=mask)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(np.diff(ends), pa.int64()), pa.array(same, pa.bool_())],
                                             names=[*batch.schema.names, *added])

    schema = StructType(docs.select(*own).schema.fields)
    for name, kind in added.items():
        schema = schema.add(name, kind)
    return bk.map_batches(docs.select(*own), run, schema)


def decode(encoded: DataFrame, model: str = MODEL, ids: str = "token_ids") -> DataFrame:
    """``encoded`` with ``decoded`` string, the text of the column ``ids`` (null where that is null; bytes
    that are no UTF-8 become U+FFFD); a column of this name is replaced."""
    own = [c for c in encoded.columns if c != "decoded"]
    shared = _Shared(encoded.sparkSession, Vocabulary.load(model))

    def run(batches):
        pieces = pa.array(_encoder(shared).bytes_of, pa.binary())
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())]).astype(np.int32)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), pieces.take(lists.flatten())), b"")
            text = pa.array([None if x is None else x[1:].decode("utf-8", "replace") for x in pc.if_else(lists.is_null(), pa.scalar(None, pa.binary()), joined).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, "decoded"])

    return bk.map_batches(encoded.select(*own), run, StructType(encoded.select(*own).schema.fields).add("decoded", StringType()))
