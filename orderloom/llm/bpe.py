"""Byte-level BPE encoding and decoding.

A text is cut where the tokenizer's own pre-tokenizer cuts it; each word then becomes
a contiguous array of parts with the merge rank of every adjacent pair. The smallest
rank is found by scanning, the boundary between its two parts is deleted, and the
ranks of the two neighbouring pairs are looked up anew, until no pair can merge. For
words of many parts scanning would be quadratic, so those keep their ranks in a heap;
both give the same ids.

Frequent words come from bounded caches in each Python worker. The tokenizer file is
read once by the driver and sent to the tasks (its size does not grow with the data).
"""

from __future__ import annotations

import array
import heapq
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import need

# Words of more parts than this keep their ranks in a heap.
SCAN_PARTS = 96
# Entries of each cache, and characters of its longest key.
CACHE_ENTRIES, CACHE_CHARS = 1 << 19, 48
NEVER = 1 << 40

# The split pattern of byte-level BPE, over classes named by ASCII
# stand-ins (see `Classes`).
WORDS = re.compile(
    r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII
)
# A blank before a character that is not white space always starts a word.
PIECES = re.compile(r"(?= \S)")
BLANK_RUN = re.compile(r" (?:\s|\Z)")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte: itself where printable, else from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = itertools.count(256)
    return {chr(b if b in printable else next(others)): b for b in range(256)}


class Classes(dict):
    """Code point to an ASCII stand-in of its class: letter, digit, white space or other.

    ASCII characters stand for themselves. The class of any other is asked of the
    tokenizers library, so its edition of Unicode decides.
    """

    def __init__(self):
        from tokenizers import pre_tokenizers

        super().__init__({c: c for c in range(128)})
        self._split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str

    def _together(self, text: str) -> bool:
        return len(self._split(text)) == 1

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = next((k for k in "a0#" if self._together(k + c)), "\n")
        self[code] = kind
        return kind


class Cache(dict):
    """Word to the bytes of its ids, worked out on the first look-up and bounded in size."""

    def __init__(self, encode, prefix: str = ""):
        self._encode, self._prefix = encode, prefix

    def __missing__(self, word: str) -> bytes:
        ids = self._encode(self._prefix + word)
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = ids
        return ids


class Bpe:
    """A byte-level BPE tokenizer read from the JSON text of its file."""

    def __init__(self, file_text: str):
        file = json.loads(file_text)
        model = file["model"]
        if model["type"] != "BPE" or file["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("only byte-level BPE files are read")
        if file["pre_tokenizer"]["add_prefix_space"] or file.get("normalizer"):
            raise ValueError("prefix blanks and normalizers are not supported")
        alphabet, vocab = byte_alphabet(), model["vocab"]
        self.byte_ids = [0] * 256
        for char, byte in alphabet.items():
            self.byte_ids[byte] = vocab[char]
        self.merged, self.ranks = [], {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[left] << 20 | vocab[right]] = rank
            self.merged.append(vocab[left + right])
        self.special = {}
        for token in file["added_tokens"]:
            if any(token[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError(f"unsupported added token {token}")
            self.special[token["content"]] = token["id"]
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(alphabet[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        longest_first = sorted(map(re.escape, self.special), key=len, reverse=True)
        self._special = re.compile(f"({'|'.join(longest_first)})") if self.special else None
        self._classes = Classes()
        self._words = Cache(self._encode_word)
        self._plain = Cache(self._encode_piece)
        self._spaced = Cache(self._encode_piece, " ")

    # --- words -------------------------------------------------------------------

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word's bytes."""
        parts = [self.byte_ids[b] for b in word]
        return self._merge_scanning(parts) if len(parts) <= SCAN_PARTS else self._merge_by_heap(parts)

    def _merge_scanning(self, parts: list[int]) -> list[int]:
        rank_of, merged = self.ranks.get, self.merged
        ranks = [rank_of(a << 20 | b, NEVER) for a, b in itertools.pairwise(parts)]
        while ranks:
            least = min(ranks)
            if least == NEVER:
                break
            at = ranks.index(least)
            parts[at] = merged[least]
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] << 20 | parts[at + 1], NEVER)
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] << 20 | parts[at], NEVER)
        return parts

    def _merge_by_heap(self, parts: list[int]) -> list[int]:
        """The same merges in the same order, with the next and previous part of each kept."""
        n, rank_of = len(parts), self.ranks.get
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [
            (rank, i) for i in range(n - 1) if (rank := rank_of(parts[i] << 20 | parts[i + 1])) is not None
        ]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or rank_of(parts[i] << 20 | parts[j]) != rank:
                continue  # one of the two has merged otherwise meanwhile
            parts[i], gone[j], after[i] = self.merged[rank], True, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (found := rank_of(parts[a] << 20 | parts[b])) is not None:
                    heapq.heappush(heap, (found, a))
        return [p for p, dead in zip(parts, gone) if not dead]

    def _encode_word(self, word: str) -> bytes:
        return array.array("I", self.merge(word.encode())).tobytes()

    def words(self, text: str) -> list[str]:
        """The text cut as the tokenizer's pre-tokenizer cuts it."""
        if text.isascii():
            return WORDS.findall(text)
        return [text[m.start() : m.end()] for m in WORDS.finditer(text.translate(self._classes))]

    def _encode_piece(self, piece: str) -> bytes:
        return b"".join(map(self._words.__getitem__, self.words(piece)))

    # --- texts -------------------------------------------------------------------

    def _encode_plain(self, text: str) -> bytes:
        if BLANK_RUN.search(text):
            return b"".join(map(self._plain.__getitem__, PIECES.split(text)))
        first, *rest = text.split(" ")
        return self._plain[first] + b"".join(map(self._spaced.__getitem__, rest))

    def encode_bytes(self, text: str) -> bytes:
        """The ids as 32-bit numbers in the machine's byte order; added tokens keep their own id."""
        if not text:
            return b""
        if not self._special or not self._special.search(text):
            return self._encode_plain(text)
        return b"".join(
            array.array("I", [self.special[part]]).tobytes() if i % 2 else self._encode_plain(part)
            for i, part in enumerate(self._special.split(text))
            if part
        )

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.uint32).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[int, Bpe] = {}


def loaded(file_text: str) -> Bpe:
    """The tokenizer of a file's text, built once per Python worker."""
    key = hash(file_text)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(file_text)
    return _LOADED[key]


def tokenizer_text(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row (id, ids) per row of `docs`: the ids of the whole text.

    A null text counts as empty and has no ids; a null id stays null; repeated rows each
    get their row; an empty table gives an empty result. Other columns are not read.
    """
    need(docs, (id_column, text_column))
    file = docs.sparkSession.sparkContext.broadcast(tokenizer_text(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(file.value)
        for batch in batches:
            encoded = [bpe.encode_bytes(t or "") for t in batch.column(1).to_pylist()]
            offsets = np.zeros(len(encoded) + 1, np.int32)
            np.cumsum([len(e) // 4 for e in encoded], out=offsets[1:])
            values = np.frombuffer(b"".join(encoded), np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["id", "ids"])

    kind = docs.schema[id_column].dataType.simpleString()
    slim = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return slim.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, tokenizer: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """Rows (id, ids, text) of rows with ids; null ids count as none and give an empty text."""
    need(encoded, (id_column, ids_column))
    file = encoded.sparkSession.sparkContext.broadcast(tokenizer_text(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(file.value)
        for batch in batches:
            texts = [bpe.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "ids", "text"]
            )

    kind = encoded.schema[id_column].dataType.simpleString()
    slim = encoded.select(F.col(id_column).alias("id"), F.col(ids_column).alias("ids"))
    rows = slim.mapInArrow(run, f"id {kind}, ids array<int>, text string")
    return rows.withColumnsRenamed({"id": id_column, "ids": ids_column})
