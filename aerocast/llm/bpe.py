"""BPE encoding and decoding of a word-level vocabulary file.

A word is held as its parts (ids, one boundary between any two) plus one
contiguous array with the rank of each boundary's pair. A step scans the array
for its minimum, deletes that boundary and refreshes the two neighbouring ranks. Words are short, so the scan is
cheaper than any queue; the rare word above ``SCAN_MAX`` parts goes through a
heap that merges in the same order.

Texts are cut at ASCII white space, which the tokenizer drops, and the ids of a
piece are kept in a bounded cache, since pieces repeat.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import BoundedCache, chunked, text_batches

SCAN_MAX = 200
#: Pieces and words whose ids a worker keeps.
CACHE_MAX = 200_000
#: From this character on, classes differ between Unicode versions; the library's own normaliser and splitter decide there.
LATER = "\u0530"
_NO_RANK = 1 << 60
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabulary files of byte-level BPE."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Bpe:
    """Encoder and decoder for a tokenizer file with word ends and lower-casing."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        # a pair of ids in one integer -> its rank; rank -> the id it makes
        self.ranks = {self.vocab[a] << 20 | self.vocab[b]: i for i, (a, b) in enumerate(model["merges"])}
        self.merged = [self.vocab[a + b] for a, b in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*self.vocab.values(), *self.special.values()]) + 1)
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        letters = byte_letters()
        self.inner = [self.vocab[c] for c in letters]
        self.last = [self.vocab[c + self.end] for c in letters]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern.replace(r"\s", _SPACE))
        self.path = path
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.words = BoundedCache(lambda word: self.merge(word.encode("utf-8", "surrogatepass")), CACHE_MAX)
        self.pieces = BoundedCache(self._piece, CACHE_MAX)

    # -- one word ---------------------------------------------------------------

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        parts = [self.inner[b] for b in word]
        parts[-1] = self.last[word[-1]]
        if len(parts) > SCAN_MAX:
            return self._merge_long(parts)
        rank_of, merged = self.ranks.get, self.merged
        ranks = [rank_of(a << 20 | b, _NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) < _NO_RANK:
            i = ranks.index(low)
            parts[i] = merged[low]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of(parts[i] << 20 | parts[i + 1], _NO_RANK)
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] << 20 | parts[i], _NO_RANK)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges with a heap: lowest rank first, leftmost among equals."""
        n = len(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, i + 1) for i in range(n - 1) if (r := self.ranks.get(parts[i] << 20 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, a, b = heapq.heappop(heap)
            if parts[a] < 0 or after[a] != b or self.ranks.get(parts[a] << 20 | parts[b]) != rank:
                continue
            parts[a], parts[b] = self.merged[rank], -1
            after[a] = after[b]
            if after[a] >= 0:
                before[after[a]] = a
            for x, y in ((before[a], a), (a, after[a])):
                if x >= 0 and y >= 0 and (r := self.ranks.get(parts[x] << 20 | parts[y])) is not None:
                    heapq.heappush(heap, (r, x, y))
        return [p for p in parts if p >= 0]

    # -- texts ------------------------------------------------------------------

    def _piece(self, piece: bytes) -> bytes:
        """Ids of a run without ASCII white space, as 32-bit integers."""
        ids: list[int] = []
        raw = piece.decode("utf-8", "surrogatepass")
        for part in self.cut.split(raw) if "<|" in raw else (raw,):
            if part in self.special:
                ids.append(self.special[part])
                continue
            for word in self._split(part):
                ids += self.words[word]
        return array("i", ids).tobytes()

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def _split(self, part: str) -> list[str]:
        if part.isascii():
            return self.split.findall(part.lower())
        if max(part) < LATER:
            return self.split.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        low = self.library.normalizer.normalize_str(part)
        return [low[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(low)]

    def encode(self, text: str | None) -> np.ndarray:
        pieces = (text or "").encode("utf-8", "surrogatepass").split()
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, pieces)), dtype=np.int32)

    def decode(self, ids) -> str:
        """Token strings joined by a space, special tokens included, as for a file without a decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """The tokenizer of a path, built once per worker."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids array<int>, decoded string`` for every row.

    Null and empty texts give no ids and an empty decoded text. Repeated rows
    give repeated results; other columns are ignored. ``path`` must hold the same file
    on every worker.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in chunked(batches, 1, 1 << 20):
            ids = [bpe.encode(t) for t in b.column(1).to_pylist()]
            decoded = [bpe.decode(i.tolist()) for i in ids]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(decoded, pa.string())],
                [id_col, "ids", "decoded"])

    return text_batches(docs).select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias(text_col)) \
        .mapInArrow(run, f"`{id_col}` {id_type}, ids array<int>, decoded string")
