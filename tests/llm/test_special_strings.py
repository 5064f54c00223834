"""Texts that hold the strings of special tokens get the ids of the plain library call."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from concord.llm import packing, tokens

PARTS = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "end", "Étude", "it's", "x,", "7", " ", " ", " ", "  ", "\n", "\t", " "]


@pytest.mark.parametrize("name, keeps_space", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_are_those_of_the_plain_call(name, keeps_space):
    path = packing.tokenizer_path(name)
    plain, own = Tokenizer.from_file(path), tokens.Encoder(path, keeps_space)
    draw = random.Random(3)
    texts = ["end <|endoftext|> next", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>\nc"]
    texts += ["".join(draw.choice(PARTS) for _ in range(draw.randint(1, 14))) for _ in range(3000)]
    for text in texts:
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == want, text
    if keeps_space:
        assert np.frombuffer(own.encode(texts[0]), "<u4").tolist() == [437, 220, 50256, 1306]
