"""Byte-pair encoding and decoding from a public tokenizer file.

Words are merged with a priority queue of merge ranks over a doubly linked list of symbols;
an entry whose symbols have changed since it was queued is stale and skipped. Text goes through
the steps that the file states: special tokens are cut out, then NFC, lower case per
character, the split into pieces, the byte alphabet. Decoding concatenates vocabulary strings.
Texts with characters that are newer than Python's Unicode tables take the two middle steps from the library,
whose tables are others again; merging stays the same.

Words repeat, so every task keeps the encodings of words it has met; the store has a
fixed bound and is cut by half when it is full, which changes nothing but the time.

Edge cases: null and empty texts have no ids and decode to the empty text; a text of any
length is encoded whole, one row at a time; an id outside the vocabulary cannot be decoded and
fails; input columns other than id and text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cached_property

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

# White space of the file's normalizer (Unicode White_Space)
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# str.split() also cuts at these four
EXTRA_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
MAX_WORDS = 500_000


def byte_alphabet() -> dict[int, str]:
    """Printable stand-ins of the 256 bytes: Latin-1's visible ones stand for themselves, the others follow 255."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in visible}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(visible))
    return table


def newer_characters() -> set[str]:
    """Characters that the ``regex`` module knows and ``unicodedata`` does not."""
    unknown = "".join([c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn"])
    return set(regex.findall(r"\P{Cn}", unknown))


def merge_word(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge a word's symbols, lowest rank first and leftmost among equals."""
    n = len(symbols)
    if n < 2:
        return symbols
    after = [*range(1, n), -1]
    before = [*range(-1, n - 1)]
    queue = []
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            queue.append((rank, i, symbols[i], symbols[i + 1]))
    heapq.heapify(queue)
    while queue:
        _, i, left, right = heapq.heappop(queue)
        j = after[i]
        if symbols[i] != left or j < 0 or symbols[j] != right:
            continue  # stale
        symbols[i] = left + right
        symbols[j] = None
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        k = before[i]
        if k >= 0:
            rank = ranks.get((symbols[k], symbols[i]))
            if rank is not None:
                heapq.heappush(queue, (rank, k, symbols[k], symbols[i]))
        k = after[i]
        if k >= 0:
            rank = ranks.get((symbols[i], symbols[k]))
            if rank is not None:
                heapq.heappush(queue, (rank, i, symbols[i], symbols[k]))
    return [s for s in symbols if s is not None]


class NewerCharacter(Exception):
    """A run has a character that only the library's tables know."""


class Words(dict):
    """run without white space -> its ids, found on first sight."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, run: str) -> bytes:
        found = self[run] = self.find(run)
        return found


class Codec:
    """Encoder and decoder of one tokenizer file (tokenizers' JSON: BPE with word ends).

    ``newer`` are ``newer_characters()``, which take as long to find as some megabytes to encode: once for all tasks.
    """

    def __init__(self, path: str, newer: set[str] | None = None):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.merges = model["merges"]
        self.end = model["end_of_word_suffix"] or ""
        self.strings = {i: s for s, i in (self.vocab | self.special).items()}
        self.alphabet = byte_alphabet()
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern.replace(r"\s", SPACE)).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split
        self.words = Words(self._run)
        self.library = Tokenizer.from_file(path)
        self.newer = newer_characters() if newer is None else newer
        # the first plane by one character class; the few characters beyond it are looked up
        self.near_newer = re.compile("[" + "".join(c for c in sorted(self.newer) if c <= "\uffff") + "]").search
        self.beyond = re.compile("[\U00010000-\U0010ffff]+").findall

    @cached_property
    def ranks(self) -> dict[tuple[str, str], int]:
        return {tuple(pair): rank for rank, pair in enumerate(self.merges)}

    def has_newer(self, text: str) -> bool:
        return self.near_newer(text) is not None or not all(map(self.newer.isdisjoint, self.beyond(text)))

    def word(self, piece: str) -> bytes:
        """Ids of one piece, as little-endian unsigned 32-bit integers."""
        alphabet = self.alphabet
        return self.ids_of([alphabet[b] for b in piece.encode("utf-8")])

    def ids_of(self, symbols: list[str]) -> bytes:
        """Ids of a piece that is spelt in the byte alphabet."""
        symbols[-1] += self.end
        vocab = self.vocab
        return array("I", [vocab[s] for s in merge_word(symbols, self.ranks)]).tobytes()

    def _run(self, run: str) -> bytes:
        """Ids of a run without white space."""
        if not run.isascii() and self.has_newer(run):
            raise NewerCharacter  # never stored, so that every text with it comes here
        words = self.words
        return b"".join([words[p] if p in words else self.word(p) for p in self.pieces(run)])

    def normalize(self, text: str) -> str:
        if not text.isascii():
            # per character, so a sigma that ends a word stays a plain one
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, four bytes each."""
        if not text:
            return b""
        if "<|" not in text or len(parts := self.cut(text)) == 1:
            return self._plain(text)
        return b"".join(
            array("I", [self.special[p]]).tobytes() if p in self.special else self._plain(p) for p in parts if p
        )

    def _plain(self, text: str) -> bytes:
        # characters that Python's tables lack pass through its normalization, so the runs still have them
        plain = self.normalize(text)
        # no piece reaches over white space, so runs without any are looked up whole
        runs = self.pieces(plain) if any(c in plain for c in EXTRA_SPACE) else plain.split()
        words = self.words
        try:
            out = b"".join([words[r] for r in runs])
        except NewerCharacter:
            pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return b"".join([self.ids_of(list(piece)) for piece, _ in pieces])
        if len(words) > MAX_WORDS:
            for run in list(words)[: MAX_WORDS // 2]:
                del words[run]
        return out

    def decode(self, ids: bytes) -> str:
        """The vocabulary strings in a row; the file has no decoder, so a space stands between them."""
        return " ".join([self.strings[i] for i in array("I", ids)])


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) to (id, ids binary): four bytes an id, little-endian. Map-only."""
    newer = newer_characters()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Codec(path, newer)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = [coder.encode(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.large_binary())], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def digest_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text: (id, n_tokens, ids_sha256, decoded_sha256), in one pass over the text.

    Ids and decoded text live for one row at a time; ids of a repeated piece decode once.
    """
    newer = newer_characters()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Codec(path, newer)
        for batch in batches:
            n, ids_hash, text_hash = [], [], []
            for text in batch.column(1):
                ids = coder.encode(text.as_py())
                n.append(len(ids) // 4)
                ids_hash.append(hashlib.sha256(ids).hexdigest())
                text_hash.append(hashlib.sha256(coder.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash), pa.array(text_hash)],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
