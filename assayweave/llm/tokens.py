"""Corpus encoding with a public byte-pair vocabulary (problem 7).

The merges of a byte-pair vocabulary never cross the words its pattern cuts, so each
distinct word is encoded once per worker.  A word is encoded by dynamic programming
over its prefixes: :class:`PrefixTable` stores, for each prefix, the one token that the
encoding of that prefix ends with.  A token fits at the end of a prefix exactly if it is
compatible with the last token of what comes before, so a table grows by appending
without looking back further than the longest token, and an edit only touches the
entries near it.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k"
# Fixed value: the published pattern that cuts text into words before the merges.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct words remembered per worker; when full the memory starts afresh, results don't change.
REMEMBERED = 400_000
#: Pairs of tokens remembered per worker, likewise.
REMEMBERED_PAIRS = 1_000_000


class Vocabulary:
    """Tokens and merge ranks of a byte-pair vocabulary; a token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {i: t for t, i in ranks.items()}
        self._longest: dict[bytes, int] = {}
        for token in ranks:
            end = token[-2:]
            if len(token) > self._longest.get(end, 0):
                self._longest[end] = len(token)
        self.longest = max(map(len, ranks))
        self._fits: dict[tuple[int, int], bool] = {}

    @classmethod
    def load(cls, folder: str = TOKENIZER_DIR, name: str = VOCABULARY) -> Vocabulary:
        with open(f"{folder}/{name}.tiktoken", "rb") as lines:
            return cls({base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)})

    def merge(self, text: bytes) -> list[int]:
        """Plain merging by lowest rank, leftmost first: the definition, for short inputs."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before``: merging both texts gives just these two. -1 is the start."""
        known = self._fits.get((before, token))
        if known is None:
            if before < 0:
                known = self.merge(self.bytes[token]) == [token]
            else:
                known = self.merge(self.bytes[before] + self.bytes[token]) == [before, token]
            if len(self._fits) >= REMEMBERED_PAIRS:
                self._fits.clear()
            self._fits[before, token] = known
        return known

    def last_token(self, text: bytes, end: int, last: list[int]) -> int:
        """The token that the encoding of ``text[:end]`` ends with, given those of all shorter prefixes."""
        longest = self._longest.get(text[max(0, end - 2) : end], 1) if end > 1 else 1
        for start in range(max(0, end - longest), end):
            token = self.ranks.get(text[start:end])
            if token is not None and self.fits(last[start], token):
                return token
        raise ValueError("the vocabulary lacks a byte")


class PrefixTable:
    """Encoding of a growing or edited byte string; ``last[i]`` belongs to its first ``i`` bytes."""

    def __init__(self, vocabulary: Vocabulary, text: bytes = b""):
        self.vocabulary, self.text, self.last = vocabulary, b"", [-1]
        self.append(text)

    def append(self, more: bytes) -> None:
        """Exact append: no entry already there changes."""
        start = len(self.text)
        self.text += more
        for end in range(start + 1, len(self.text) + 1):
            self.last.append(self.vocabulary.last_token(self.text, end, self.last))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of ``text[start:stop]``; returns how many entries were computed.

        Entries before ``start`` stay.  Behind the edit, as soon as the entries of as many
        places as the longest token has bytes agree with the old ones, all later ones do.
        """
        old_last, tail = self.last, self.text[stop:]
        self.text, self.last = self.text[:start] + new + tail, old_last[: start + 1]
        computed = agreed = 0
        shift = len(new) - (stop - start)
        for end in range(start + 1, len(self.text) + 1):
            token = self.vocabulary.last_token(self.text, end, self.last)
            self.last.append(token)
            computed += 1
            behind = end > start + len(new) and old_last[end - shift] == token
            agreed = agreed + 1 if behind else 0
            if agreed > self.vocabulary.longest:
                self.last += old_last[end - shift + 1 :]
                break
        return computed

    def ids(self) -> list[int]:
        """The tokens of the whole text, read off backwards."""
        out, end = [], len(self.text)
        while end:
            token = self.last[end]
            out.append(token)
            end -= len(self.vocabulary.bytes[token])
        return out[::-1]


class Encoder:
    """Encodes texts word by word, each distinct word once."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._cut = regex.compile(WORDS)
        self._known: dict[str, tuple[int, ...]] = {}

    def _word(self, word: str) -> tuple[int, ...]:
        whole = self.vocabulary.ranks.get(raw := word.encode())
        ids = (whole,) if whole is not None and self.vocabulary.fits(-1, whole) else tuple(PrefixTable(self.vocabulary, raw).ids())
        if len(self._known) >= REMEMBERED:
            self._known.clear()
        self._known[word] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        """Token ids; none for null and empty texts."""
        if not text:
            return []
        known, out = self._known, []
        for word in self._cut.findall(text):
            ids = known.get(word)
            out += self._word(word) if ids is None else ids
        return out

    def count(self, text: str | None) -> int:
        """Number of tokens."""
        if not text:
            return 0
        known, n = self._known, 0
        for word in self._cut.findall(text):
            ids = known.get(word)
            n += len(self._word(word) if ids is None else ids)
        return n


@lru_cache(maxsize=4)
def encoder(folder: str = TOKENIZER_DIR, name: str = VOCABULARY) -> Encoder:
    """The encoder of this process."""
    return Encoder(Vocabulary.load(folder, name))


def _ids_array(lists: Iterable[list[int]]) -> pa.Array:
    flat, ends = [], [0]
    for ids in lists:
        flat += ids
        ends.append(len(flat))
    return pa.ListArray.from_arrays(pa.array(np.asarray(ends, dtype=np.int32)), pa.array(np.asarray(flat, dtype=np.int32)))


def encode_corpus(documents: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZER_DIR, name: str = VOCABULARY) -> DataFrame:
    """``key, ids`` of every row: token ids without special tokens, whole texts.

    Null and empty texts get an empty list.  A narrow map: no shuffle, and the vocabulary
    is read from ``folder`` once per worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(folder, name).encode
        for batch in batches:
            for part in range(0, batch.num_rows, 500):  # keeps the flat list of ids small
                piece = batch.slice(part, 500)
                ids = _ids_array(encode(t) for t in piece.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([piece.column(key), ids], names=[key, "ids"])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(run, f"{key} {kind}, ids array<int>")


def count_tokens(documents: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZER_DIR, name: str = VOCABULARY) -> DataFrame:
    """``key, n_tokens`` of every row; null and empty texts have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder(folder, name).count
        for batch in batches:
            n = np.fromiter((count(t) for t in batch.column(text).to_pylist()), dtype=np.int64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(n)], names=[key, "n_tokens"])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(run, f"{key} {kind}, n_tokens long")
