"""Ids equal those of the plain library, whatever white space or added tokens a text holds."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventlake.llm.tokens import ChunkEncoder

SPACES = [" ", " ", " ", "\n", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", " ", " ", " ", " ", "　", "​", "﻿"]
BITS = ["Liste", "eins", ":", "a", "größe", "don't", "x1", "--", "K", "ſt", "İ", "日本", "😀", "é", "42", ".", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|", "\x00", "\x01"]


@pytest.mark.parametrize(("name", "keep_space"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_ids_equal_the_library(name, keep_space):
    path = public_tokenizers.path(name)
    plain, ours = Tokenizer.from_file(path), ChunkEncoder(path, keep_space, limit=500)
    rnd = random.Random(11)
    texts = ["Liste :\n\xa0 eins\xa0zwei", "hello <|endoftext|> world", "hello<|endoftext|>", " <|EndOfText|>", "\n", " a\n b", "a \nb", "\n\na"]
    texts += ["".join(rnd.choice(SPACES if rnd.random() < 0.5 else BITS) for _ in range(rnd.randint(1, 24))) for _ in range(12_000)]
    texts += [" ".join(rnd.choice(BITS[:16]) for _ in range(rnd.randint(1, 40))) + rnd.choice(SPACES) for _ in range(2_000)]
    for t in texts:
        assert np.frombuffer(ours.ids(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)
