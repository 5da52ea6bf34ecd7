"""Plain words are remembered in lower case; whatever stands among them, ids are those of the library."""

import random

import pytest

pytest.importorskip("packwatch.llm")

import public_tokenizers  # noqa: E402

from packwatch.llm.bpe import Codec  # noqa: E402

PARTS = ["<|endoftext|>", "<|ENDOFTEXT|>", "é", "É", "\t", "’", "—", "ẞ", "İ", "\x1c", "\x85", "\xa0", "\r", "It's", "WE'LL"]
PARTS += ["don''t", "'S", "x" * 70, "123", "日本", "ß", "×", "a\x00b", "Mail", "...", "ﬁ", "Σας", "é", "THEN,", "then"]


@pytest.fixture(scope="module")
def codec():
    return Codec(public_tokenizers.path("word_bpe_49k.json"))


def test_case_variants_are_remembered_once(codec):
    text = "Then then, THEN\nthen the\tThe THEN, tHen"
    found = [i for ids in codec.words(text, "ids") for i in ids]
    assert found == codec.whole.encode(text, add_special_tokens=False).ids
    assert set(codec.lowered["ids"]) == {"then", "then,", ""} and set(codec.kinds["ids"]) == {"the\tThe"}


def test_plain_and_other_words_mixed(codec):
    r = random.Random(1)
    for _ in range(3000):
        text = "".join(r.choice(PARTS) + r.choice(["", " ", "\n"]) for _ in range(r.randint(0, 12)))
        found = [i for ids in codec.words(text, "ids") for i in ids]
        assert found == codec.whole.encode(text, add_special_tokens=False).ids, text
