"""Operator 12, BPE encoding and decoding with a fixed public vocabulary.

A text is read as the vocabulary's file says: special tokens are cut out as
they stand, the rest is brought to NFC and lower case and split into words
(contractions, letters, single digits, runs of other signs; white space goes).
A word's UTF-8 bytes are its first symbols, the last one marked as word end.
The symbols form a doubly linked list, and a priority queue holds the rank of
every neighbouring pair that the merge table knows. The least rank (leftmost
among equals) is merged first; entries whose symbols have changed since are
stale and skipped. Decoding looks up every id's vocabulary string and
concatenates them, with a space between (the file names no decoder).

Words are independent, so a bounded cache of two generations keeps the result
of words that come again. Characters that this Python's tables don't know yet
(newer Unicode versions) change case and class by version; a text that holds
one is split by the vocabulary's own library.

Defined cases: null text is empty: no ids, and decoded again as an empty text;
special tokens' strings in a text become their ids; rows that repeat are
encoded each; columns named like the added ones are replaced, others stay.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from skyfold.llm import bytekit as bk

VOCABULARY = "word_bpe_49k.json"
#: Words of a generation of the cache, and the longest word kept there.
CACHE_WORDS, CACHE_CHARS = 300_000, 48
#: How the vocabulary's file splits words; another file's splitting isn't known here.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte in the vocabulary: itself where printable
    in Latin-1, else the next free one from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in own else next(free)) for b in range(256)]


class Vocabulary:
    """Ids of strings, ranks of merges and special tokens."""

    def __init__(self, ids: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int]) -> None:
        self.ids, self.merges, self.special = ids, merges, special

    @classmethod
    def load(cls, path: str | None = None) -> Vocabulary:
        with open(path or default_path(), encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END or WORDS not in json.dumps(data["pre_tokenizer"], ensure_ascii=False).replace("\\\\", "\\"):
            raise ValueError("a BPE vocabulary with word ends and this module's splitting is needed")
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        return cls(model["vocab"], merges, {t["content"]: t["id"] for t in data["added_tokens"]})

    def strings(self) -> list[str]:
        both = self.ids | self.special
        out = [""] * (max(both.values(), default=-1) + 1)
        for s, i in both.items():
            out[i] = s
        return out


class Encoder:
    """Merge table over ids, and the cache of words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        ids = vocabulary.ids
        signs = byte_signs()
        self.first = [ids[s] for s in signs]
        self.last = [ids[s + END] for s in signs]
        # (left, right) -> rank and merged id
        self.merge = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(vocabulary.merges)}
        self.special = vocabulary.special
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.words = regex.compile(WORDS)
        self.ascii_words = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.library = None

    def merged(self, word: str) -> list[int]:
        """Ids of one word: the queue of ranks over the linked list of symbols."""
        raw = word.encode()
        sym = [self.first[b] for b in raw]
        sym[-1] = self.last[raw[-1]]
        n, merge = len(sym), self.merge
        if n == 1:
            return sym
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(found[0], i, found[1], pair) for i, pair in enumerate(zip(sym, sym[1:])) if (found := merge.get(pair))]
        heapq.heapify(queue)
        while queue:
            _, i, new, (a, b) = heapq.heappop(queue)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue                    # stale: one of the two has been merged since
            sym[i], sym[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := merge.get(pair := (new, sym[k])):
                    heapq.heappush(queue, (found[0], i, found[1], pair))
            if (h := before[i]) >= 0:
                if found := merge.get(pair := (sym[h], new)):
                    heapq.heappush(queue, (found[0], h, found[1], pair))
        return [s for s in sym if s >= 0]

    def word(self, word: str) -> bytes:
        """Ids as bytes, from the older generation or anew; empty for a character of unknown kind."""
        got = self.old.get(word)
        if got is None:
            if not word.isascii() and any(unicodedata.category(c) == "Cn" for c in word):
                return b""
            got = np.array(self.merged(word), np.int32).tobytes()
        if len(word) <= CACHE_CHARS:
            if len(self.young) >= CACHE_WORDS:
                self.old, self.young = self.young, {}
            self.young[word] = got
        return got

    def _by_library(self, text: str) -> list[str]:
        """The words as the vocabulary's own normaliser and splitting give them."""
        if self.library is None:
            from tokenizers import Regex, normalizers, pre_tokenizers
            self.library = (normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]), pre_tokenizers.Split(Regex(WORDS), "removed", invert=True))
        return [w for w, _ in self.library[1].pre_tokenize_str(self.library[0].normalize_str(text))]

    def _plain(self, text: str) -> list[bytes]:
        if text.isascii():
            words = self.ascii_words.findall(text.lower())
        else:
            text = unicodedata.normalize("NFC", text)
            # lower() of a whole text writes a last sigma in another way
            words = self.words.findall(text.lower() if "Σ" not in text else "".join(map(str.lower, text)))
        get, word = self.young.get, self.word
        out = [get(w) or word(w) for w in words]
        if b"" in out:
            return [np.array(self.merged(w), np.int32).tobytes() for w in self._by_library(text)]
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a text, as the bytes of an int32 array."""
        if self.cut is None or not any(s in text for s in self.special):
            return b"".join(self._plain(text))
        out: list[bytes] = []
        for k, piece in enumerate(self.cut.split(text)):
            out += [np.int32(self.special[piece]).tobytes()] if k % 2 else self._plain(piece)
        return b"".join(out)


_ENCODER: list = [None, None]


def _encoder(path: str) -> Encoder:
    """One encoder a worker process, for the last vocabulary used."""
    if _ENCODER[0] != path:
        _ENCODER[:] = path, Encoder(Vocabulary.load(path))
    return _ENCODER[1]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``token_ids`` array<int> and ``n_tokens`` long; columns of these names are
    replaced. ``path``: the vocabulary's file, at the same place on every executor."""
    path = path or default_path()
    added = {"token_ids": ArrayType(IntegerType()), "n_tokens": LongType()}
    own = [c for c in docs.columns if c not in added]

    def run(batches):
        coder = _encoder(path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            ids = [coder.encode(t) if t else b"" for t in texts.to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)])
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(np.diff(ends))], names=[*batch.schema.names, *added])

    schema = StructType(docs.select(*own).schema.fields)
    for name, kind in added.items():
        schema = schema.add(name, kind)
    return bk.map_batches(docs.select(*own), run, schema)


_STRINGS: list = [None, None]


def _strings(path: str) -> pa.Array:
    if _STRINGS[0] != path:
        _STRINGS[:] = path, pa.array(Vocabulary.load(path).strings(), pa.string())
    return _STRINGS[1]


def decode(encoded: DataFrame, path: str | None = None, ids: str = "token_ids") -> DataFrame:
    """``encoded`` with ``decoded`` string, the text of the column ``ids`` (null where that is null)."""
    path = path or default_path()
    own = [c for c in encoded.columns if c != "decoded"]

    def run(batches):
        strings = _strings(path)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            flat = strings.take(lists.flatten())
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), flat)
            text = pc.binary_join(tokens, " ")
            if lists.null_count:
                text = pc.if_else(lists.is_null(), pa.scalar(None, pa.string()), text)
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, "decoded"])

    schema = StructType(encoded.select(*own).schema.fields).add("decoded", StringType())
    return bk.map_batches(encoded.select(*own), run, schema)
