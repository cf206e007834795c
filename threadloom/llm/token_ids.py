"""Token ids of whole texts from the tokenizers library, equal pieces looked up once."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

from threadloom.llm.bpe import pieces_of

# Pieces of one generation; two are kept. This bounds memory and changes no result.
GENERATION = 400_000

# A mark that ends a word: no vocabulary word crosses its place.
END_MARK = re.compile(r"(?<=[a-zß-öø-ÿ])(?=[,.](?:\s|$))")

# White space on which all libraries agree.
JOINING = frozenset(" \t\n\r")


def is_latin(text: str) -> bool:
    """Whether no letter is composed, and lower case the same in every library."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids.

    The library is slow on whole texts and many pieces repeat, so texts are cut at white space,
    where neither vocabulary merges, and only pieces that are not in the bounded store go to the
    library. Texts that may hold a special token's string, in any case of letters, or separators on
    which white-space rules differ, go to it whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        added = self.library.get_added_tokens_decoder().values()
        # how special tokens begin; lowering a piece could make one of another case whole
        self.marks = {token.content[:2] for token in added}
        # the vocabulary with word ends drops white space, the other one encodes it
        self.keeps_white_space = bool(self.library.encode(" ", add_special_tokens=False).ids)
        # bytes of each id's token, where a text's tokens hold exactly the bytes of the text
        self.sizes = None if self.library.normalizer or not self.keeps_white_space else self._sizes()
        self.store: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _sizes(self) -> np.ndarray:
        size = np.zeros(self.library.get_vocab_size(with_added_tokens=True), np.int64)
        for token, number in self.library.get_vocab(with_added_tokens=False).items():
            size[number] = len(token)
        return size

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece. Those that begin with white space and end with none go to the
        library as one text, as they could stand in one; bytes tell where each piece's ids end."""
        if self.sizes is None:
            return self._library(pieces)
        joined = [p for p in pieces if p[:1] in JOINING and not p[-1].isspace()]
        found = {}
        if joined:
            ids = np.array(self.library.encode_batch_fast(["".join(joined)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.cumsum([len(p.encode()) for p in joined])
            reached = np.cumsum(self.sizes[ids])
            at = np.searchsorted(reached, ends)
            if reached[-1] == ends[-1] and (reached[at] == ends).all():
                data, borders = ids.tobytes(), [0, *(4 * (at + 1)).tolist()]
                found = {p: data[a:b] for p, a, b in zip(joined, borders, borders[1:], strict=False)}
        rest = [p for p in pieces if p not in found]
        found.update(zip(rest, self._library(rest), strict=True))
        return [found[p] for p in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        cut = [None if any(s in text for s in self.marks) else self._pieces(text) for text in texts]
        store = self._with(set().union(*filter(None, cut)))
        return [
            self._library([text])[0]
            if pieces is None
            else b"".join(map(store.__getitem__, pieces))
            for text, pieces in zip(texts, cut, strict=True)
        ]

    def _pieces(self, text: str) -> list[str]:
        if not self.keeps_white_space and is_latin(text):
            # this vocabulary lowers every letter: words then differ less
            text = END_MARK.sub(" ", text.lower())
        return pieces_of(text, self.keeps_white_space)

    def _with(self, pieces: set[str]) -> dict[str, bytes]:
        """The store, with these pieces in it."""
        if len(self.store) > GENERATION:
            self.store, self.older = {}, self.store
        store, older = self.store, self.older
        missing = []
        for piece in pieces.difference(store):
            known = older.get(piece)
            if known is None:
                missing.append(piece)
            else:
                store[piece] = known
        store.update(zip(missing, self._ids(missing), strict=True))
        return store


@lru_cache(maxsize=1)
def kept_encoder(path: str) -> Encoder:
    """An encoder that stays with its worker, so that later tasks find its pieces."""
    return Encoder(path)
