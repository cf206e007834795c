"""Special tokens' strings in other cases of letters are ordinary text, as in the library."""

import pytest
from tokenizers import Tokenizer

from threadloom.llm.bpe import default_path
from threadloom.llm.token_ids import Encoder

TEXTS = [
    "a <|EndOfText|> b", "A <|endoftext|> B", "<|STARTOFTEXT|>", "x<|StartOfText|>y", "<|", "a <| b |> c",
    "<|endoftext|", "|endoftext|>", "ENDOFTEXT", "É <|ENDOFTEXT|> é", "plain Text, here.",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_library_s(name):
    library = Tokenizer.from_file(default_path(name))
    want = [e.ids for e in library.encode_batch(TEXTS, add_special_tokens=False)]
    found = Encoder(default_path(name)).encode(TEXTS)
    assert [[int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] for ids in found] == want
