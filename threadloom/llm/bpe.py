"""Byte-pair encoding and decoding.

A word is a doubly linked list of symbols. A heap holds the possible merges by rank, then place;
an entry whose symbols changed since it was pushed is stale and skipped. Decoding looks up every
id's vocabulary string and joins them.

Texts are cut where no merge can cross: at white space. Equal pieces are encoded once and kept in
a bounded store, which each task fills for itself, so memory does not grow with the data.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from threadloom.llm.common import map_batches, text_of

# Pieces a task keeps; a full store is emptied. This bounds memory and changes no result.
KEPT_PIECES = 300_000

# An id's and a place's room in the numbers that stand for pairs and heap entries.
ID_BITS, PLACE_BITS = 20, 32
PLACE_MASK = (1 << PLACE_BITS) - 1

# Fixed patterns of the two vocabularies' splitting rules.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Separators that Python's str methods take for white space and the vocabularies do not.
ODD_SEPARATORS = re.compile("[\x1c-\x1f]")


def default_path(name: str) -> str:
    """A public vocabulary's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The printable letter for each byte in byte-level vocabularies: printable bytes stand for
    themselves, the others for the code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Vocabulary:
    """A vocabulary file with byte-level merges, with or without word-end marks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.suffix = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.ids | self.specials).items()}
        # a pair of ids as one number -> rank, and rank -> merged id
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (left, right) in enumerate(model["merges"]):
            self.ranks.setdefault(self.ids[left] << ID_BITS | self.ids[right], rank)
            self.merged.append(self.ids[left + right])
        # the vocabulary with word ends works on normalized lower-case words
        self.lowers = bool(self.suffix)
        self.pattern = regex.compile(WORD_PATTERN if self.lowers else BYTE_PATTERN)
        self.letters = byte_letters()
        self.bytes_of = {letter: byte for byte, letter in self.letters.items()}
        self.joins_with_space = spec.get("decoder") is None
        self.special_pattern = re.compile("|".join(re.escape(s) for s in self.specials) or "(?!)")

    def normalize(self, text: str) -> str:
        if not self.lowers:
            return text
        # letter by letter: a final sigma is like any other
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pretokens(self, piece: str) -> list[str]:
        """A piece's words, in byte letters."""
        words = self.pattern.findall(self.normalize(piece))
        return [w if w.isalpha() and w.isascii() else self.in_letters(w) for w in words]

    def in_letters(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self.letters)

    def merge(self, word: str) -> list[int]:
        """The ids of one word in byte letters."""
        if not word:
            return []
        ids, rank_of, merged = self.ids, self.ranks.get, self.merged
        symbols = [ids[c] for c in word]
        symbols[-1] = ids[word[-1] + self.suffix]
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            rank = rank_of(symbols[i] << ID_BITS | symbols[i + 1])
            if rank is not None:
                heap.append(rank << PLACE_BITS | i)
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i = entry & PLACE_MASK
            j = after[i]
            if j >= n or symbols[i] < 0:
                continue  # stale
            rank = entry >> PLACE_BITS
            if rank_of(symbols[i] << ID_BITS | symbols[j]) != rank:
                continue  # stale
            symbols[i] = new = merged[rank]
            symbols[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                rank = rank_of(new << ID_BITS | symbols[k])
                if rank is not None:
                    heapq.heappush(heap, rank << PLACE_BITS | i)
            h = before[i]
            if h >= 0:
                rank = rank_of(symbols[h] << ID_BITS | new)
                if rank is not None:
                    heapq.heappush(heap, rank << PLACE_BITS | h)
        return [s for s in symbols if s >= 0]

    def encode_piece(self, piece: str) -> list[int]:
        return [i for word in self.pretokens(piece) for i in self.merge(word)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: vocabulary strings, joined as the file's decoder says."""
        strings = [self.strings[i] for i in ids]
        if self.joins_with_space:
            return " ".join(strings)
        data = bytearray()
        for string in strings:
            known = all(c in self.bytes_of for c in string)
            data += bytes(self.bytes_of[c] for c in string) if known else string.encode()
        return data.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


WHITE_AND_WORD = re.compile(r"\s*\S+|\s+")


def pieces_of(text: str, keeps_white_space: bool) -> list[str]:
    """Cut a text at white space. With ``keeps_white_space`` it leads the piece that follows."""
    if ODD_SEPARATORS.search(text):
        return [text]
    return WHITE_AND_WORD.findall(text) if keeps_white_space else text.split()


def segments_of(text: str, specials: re.Pattern, ids: dict[str, int]) -> Iterator[str | int]:
    """The ordinary stretches of a text, and the ids of special tokens between them."""
    at = 0
    for match in specials.finditer(text):
        yield text[at : match.start()]
        yield ids[match[0]]
        at = match.end()
    yield text[at:]


class Store(dict):
    """Results by piece; computes what is missing and empties itself when it is full."""

    def __init__(self, compute: Callable[[str], str], size: int = KEPT_PIECES):
        super().__init__()
        self.compute, self.size = compute, size

    def __missing__(self, piece: str) -> str:
        if len(self) >= self.size:
            self.clear()
        value = self.compute(piece)
        if len(piece) < 200:
            self[piece] = value
        return value


def encode_decode(df: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns ``doc_id``, ``n_tokens``, ``ids`` (decimal ids joined by a space) and ``decoded``. A
    null text is empty: no ids, an empty decoded text. Rows are kept as they are, repeats and
    null keys included; other columns are ignored.
    """
    schema = f"{key} {df.schema[key].dataType.simpleString()}, n_tokens long, ids string, decoded string"

    def task(batches):
        encode, decode, split = coders(path)
        for keys, texts in batches:
            ids = [encode(t) for t in texts]
            yield (
                keys,
                [i.count(" ") + 1 if i else 0 for i in ids],
                ids,
                [decode(i) for i in ids],
            )

    return map_batches(df.select(key, text_of(text).alias("text")), task, schema)


def coders(path: str) -> tuple[Callable[[str], str], Callable[[str], str], Vocabulary]:
    """Functions from text to joined decimal ids and back."""
    vocab = vocabulary(path)

    def joined(piece: str) -> str:
        return " ".join(map(str, vocab.encode_piece(piece)))

    def lowered(piece: str) -> str:
        """Capitals and a mark at the end are looked up apart, so that words are merged once."""
        if piece.isascii() and "'" not in piece:
            low = piece.lower()
            word, mark = low[:-1], low[-1:]
            if word.isalpha() and not mark.isalnum():
                return f"{by_piece[word]} {by_piece[mark]}"
            if low != piece:
                return by_piece[low]
        return joined(piece)

    by_piece = Store(lowered if vocab.lowers else joined)
    by_ids = Store(lambda ids: vocab.strings[int(ids)], size=len(vocab.strings) + 1)

    def encode(text: str) -> str:
        if "<|" in text and vocab.special_pattern.search(text):
            found = []
            for segment in segments_of(text, vocab.special_pattern, vocab.specials):
                found.append(str(segment) if isinstance(segment, int) else plain(segment))
            return " ".join(filter(None, found))
        return plain(text)

    def plain(text: str) -> str:
        pieces = pieces_of(text, not vocab.lowers)
        return " ".join(filter(None, map(by_piece.__getitem__, pieces)))

    def decode(ids: str) -> str:
        if vocab.joins_with_space:
            return " ".join(map(by_ids.__getitem__, ids.split()))
        return vocab.decode(list(map(int, ids.split())))

    return encode, decode, vocab

