"""Byte-level BPE by prefix-sharing traversal of the distinct words.

The encoding of a word's prefix ends in one token, and that token settles how
the prefix before it is encoded. The distinct words of a batch, sorted, are the
trie in depth-first order: what is known of the prefix a word shares with the one
before is kept, and only the states below are computed. The last token of a prefix is the one whose pair
with the last token of the prefix before it stays as it is when merged.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator, Sequence
from functools import cache
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import mapped

VOCABULARY = "byte_bpe_50k.json"
WORDS_KEPT = 150_000  # encodings a worker keeps between batches of texts
PAIRS_KEPT = 300_000  # pairs of tokens known to stay or fall
TOGETHER = 3_000_000  # characters of texts encoded together; the more, the more prefixes are shared


def _byte_letters() -> dict[str, int]:
    """The byte for each letter a vocabulary spells bytes with: printable ones as they are, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Encodes words of bytes; ``words`` keeps what has been encoded."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = _byte_letters()
        spelled = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.ids = {
            bytes(letters[c] for c in token): number for token, number in spelled.items() if token not in self.special
        }
        self.spelling = {number: token for token, number in self.ids.items()}
        self.spelling |= {number: text.encode() for text, number in self.special.items()}
        self.prefixes = {token[:end] for token in self.ids for end in range(1, len(token) + 1)}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}  # pair: rank, result
        self.parts: dict[int, tuple[int, int]] = {}  # result: the pair it is made of
        self.rank: dict[int, int] = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = (spelled[part] for part in (pair if isinstance(pair, list) else pair.split(" ")))
            result = self.ids[self.spelling[left] + self.spelling[right]]
            self.merges[left, right] = rank, result
            if result not in self.parts:
                self.parts[result], self.rank[result] = (left, right), rank
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.stays: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {text: struct.pack("<I", number) for text, number in self.special.items()}

    def _stays(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens are what merging their bytes gives.

        Undoes the merges of both, latest first: the pair falls if a merge across
        the border would have come before one that made its sides.
        """
        a, b, limit, result = left, right, len(self.merges), True
        while True:
            across = self.merges.get((a, b))
            if across is not None and across[0] < limit:
                result = False
                break
            rank_a, rank_b = self.rank.get(a, -1), self.rank.get(b, -1)
            if rank_a < 0 and rank_b < 0:
                break
            if rank_a > rank_b:  # the later merge is undone first; of equal ones the right one
                limit, a = rank_a, self.parts[a][1]
                # A merge across of the same rank comes after the one to its left.
            else:
                limit, b = rank_b + 1, self.parts[b][0]
                # A merge across of the same rank comes before the one to its right.
        if len(self.stays) > PAIRS_KEPT:
            self.stays.clear()
        self.stays[left, right] = result
        return result

    def learn(self, words: set[str]) -> None:
        """Encode the words in depth-first order of their trie."""
        ids, prefixes, known, spelling = self.ids, self.prefixes, self.stays, self.spelling
        last: list[int] = [-1]  # last[i]: the last token of the first i bytes
        open_from: list[int] = [0]  # open_from[i]: where the longest part of a token that ends there starts
        before = b""
        for word, text in sorted((text.encode(), text) for text in words):
            shared = len(os.path.commonprefix((before, word)))
            del last[shared + 1 :], open_from[shared + 1 :]
            first = open_from[shared]
            for end in range(shared + 1, len(word) + 1):
                while word[first:end] not in prefixes:
                    first += 1
                open_from.append(first)
                for start in range(first, end):
                    token = ids.get(word[start:end])
                    if token is None:
                        continue
                    if start:
                        pair = last[start], token
                        stays = known.get(pair)
                        if stays is None:
                            stays = self._stays(*pair)
                        if not stays:
                            continue
                    last.append(token)
                    break
            before = word
            tokens, end = [], len(word)
            while end:
                tokens.append(last[end])
                end -= len(spelling[last[end]])
            self.words[text] = struct.pack(f"<{len(tokens)}I", *reversed(tokens))

    def pieces(self, text: str) -> list[str]:
        """The words of a text in order; a special token is a word of its own."""
        if not any(token in text for token in self.special):
            return self.pattern.findall(text)
        out: list[str] = []
        at = 0
        for match in self.special_pattern.finditer(text):
            out += self.pattern.findall(text[at : match.start()])
            out.append(match[0])
            at = match.end()
        return out + self.pattern.findall(text[at:])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian numbers of 32 bits. New words are learnt together."""
        pieces = [self.pieces(text) for text in texts]
        distinct = set().union(*pieces)
        new = distinct - self.words.keys()
        if len(self.words) + len(new) > WORDS_KEPT:
            # Those of these texts stay; the frequent ones are among them.
            self.words = {word: self.words[word] for word in (distinct | self.special.keys()) & self.words.keys()}
        self.learn(new)
        return [b"".join(map(self.words.__getitem__, each)) for each in pieces]

    def decode(self, ids: Sequence[int]) -> str:
        return b"".join(map(self.spelling.__getitem__, ids)).decode("utf-8", "replace")


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _texts(batch: pa.RecordBatch) -> Iterator[list[str]]:
    texts, size = [], 0
    for scalar in batch.column(1):
        texts.append(scalar.as_py() or "")
        size += len(texts[-1])
        if size >= TOGETHER:
            yield texts
            texts, size = [], 0
    yield texts


def encode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = encoder(path)
    for batch in batches:
        encoded = [ids for texts in _texts(batch) for ids in model.encode(texts)]
        ends = np.cumsum([0, *(len(ids) // 4 for ids in encoded)], dtype=np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(encoded), "<i4")))
        yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])


def digest_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = encoder(path)
    for batch in batches:
        rows: list[tuple[int, str, str]] = []
        for texts in _texts(batch):
            for ids in model.encode(texts):
                decoded = model.decode(np.frombuffer(ids, "<u4").tolist())
                rows.append((len(ids) // 4, sha256(ids).hexdigest(), sha256(decoded.encode()).hexdigest()))
        columns = [list(column) for column in zip(*rows, strict=True)] or [[], [], []]
        kinds = [pa.int64(), pa.string(), pa.string()]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *arrays], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        )


def decode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = encoder(path)
    for batch in batches:
        texts = [None if ids is None else model.decode(ids) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


def _rows(docs: DataFrame, id_column: str, column: str, alias: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(column).alias(alias))


def encode_documents(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """doc_id and ids of each row of ``docs``; null and empty texts have no ids.

    ``vocabulary`` is the path of the tokenizer's file on every worker. The text of a
    special token is that token. Repeated rows are each encoded; a null id stays null.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    return mapped(_rows(docs, id_column, text_column, "text"), encode_batches, "doc_id long, ids array<int>", path)


def decode_documents(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The texts of ``encode_documents``' rows; null ids give a null text."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    return mapped(_rows(encoded, "doc_id", "ids", "ids"), decode_batches, "doc_id long, text string", path)


def round_trip(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """Number of tokens and digests of the ids and of the decoded text, for each row of ``docs``."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return mapped(_rows(docs, id_column, text_column, "text"), digest_batches, schema, path)
