"""Token counts of texts with very long runs of one kind of character."""

import random

import numpy as np
import pytest

from tillroll.llm import token_counts as tc

from test_tokens import encoder

RNG = random.Random(9)
LONG = {
    "spaces": "a" + " " * 20_000 + "word",
    "spaces at the end": "word" + " " * 20_000,
    "line feeds": "a" + " \n" * 10_000 + "word",
    "line feed last": "a" + " " * 20_000 + "\nword " + "\t" * 17_000 + "\t1",
    "other spaces": "a" + "　" * 20_000 + "x" + "\xa0" * 20_000 + "\x1cword",
    "letters": "".join(RNG.choice("ACGT") for _ in range(100_000)),
    "marks": "x " + "=" * 20_001 + " y",
    "digits": "".join(RNG.choice("0123456789") for _ in range(20_000)) + " 1",
}


@pytest.mark.parametrize("kind", LONG)
def test_long_runs_equal_the_library(kind):
    enc, size = encoder()
    ids = enc.encode_ordinary(LONG[kind])
    assert tc.encode(LONG[kind], enc) == ids
    start, end = tc.token_spans(LONG[kind], enc, size)
    assert len(start) == len(ids) and start[0] == 0 and end[-1] == len(LONG[kind])


@pytest.mark.parametrize("n", [17_000, 40_000])
def test_long_runs_equal_the_other_library(n):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    enc, _ = encoder()
    for text in ("a" + " " * n + "word", "A" * n + " b", "x " + "=" * n):
        assert tc.encode(text, enc) == lib.encode(text, add_special_tokens=False).ids


def test_white_space_beyond_the_patterns_stack():
    enc, size = encoder()
    text = "a" + " " * 2_000_000 + "word"
    start, end = tc.token_spans(text, enc, size)
    assert end[-1] == len(text) and np.array_equal(start[1:], end[:-1]) and text[start[-1]:] == " word"
