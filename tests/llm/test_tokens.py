import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linefit.llm import tokens

NAME = tokens.DEFAULT
ODD = [
    "", "  ", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>", "é ́x ﬀ İi ΟΔΟΣ Σας", "x\x1dy \x85a\xa0b　c",
    "'s 'S don't we'LL ''re", "한국어 ᄒ 한", "aaaa aaaaa !!!! !!a1b22", "﻿ab ⁠", "ß÷× µªº",
    "%%% This*** the&&& 99.9% a|b", "x" * 500,
]


def expected(text):
    return tokens.load_tokenizer(NAME).encode(text, add_special_tokens=False).ids


def got(texts):
    encoder = tokens.word_encoder(NAME)
    return [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)]


def test_ids_equal_the_librarys():
    assert got(ODD) == [expected(t) for t in ODD]


def test_words_are_merged_by_the_files_own_table():
    encoder = tokens.word_encoder(NAME)
    words = ["the", "Theand,", "éèê", "aaa", "abababab", "a1b2", "...", "x!y", "ÀÉ", "zzzzzzzzzz"]
    ids, ends = encoder.table.ids_of(words)
    assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends)] == [expected(w) for w in words]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_texts(texts):
    assert got(texts) == [expected(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcthe .,!ÉéàB19'\n<|", max_size=80))
def test_plain_texts(text):
    assert got([text]) == [expected(text)]


def test_words_come_back_after_the_older_ones_are_dropped(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 2)
    encoder = tokens.WordEncoder(NAME)
    texts = [f"word{i} again {'y' * 100}" for i in range(6)]
    for _ in range(2):
        for text in texts:
            (found,) = encoder.encode([text])
            assert np.frombuffer(found, encoder.dtype).tolist() == expected(text)
    assert len(encoder.known) + len(encoder.older) < 8


def test_other_tokenizers_go_to_the_library():
    import public_tokenizers

    assert tokens.MergeTable.of(public_tokenizers.path("byte_bpe_50k.json")) is None


def test_a_known_word_is_looked_up_once_a_group():
    asked = []

    class Counted(dict):
        def get(self, word, other=None):
            asked.append(word)
            return super().get(word, other)

        def __contains__(self, word):
            asked.append(word)
            return super().__contains__(word)

        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    encoder = tokens.WordEncoder(NAME)
    texts = ["one two two three", "three four", "one four"]
    first = list(encoder.encode(texts))
    encoder.known = Counted(encoder.known)
    assert list(encoder.encode(texts)) == first
    assert sorted(asked) == ["four", "one", "three", "two"]


def test_any_white_space_divides_words():
    texts = [f"ab{chr(c)}cd{chr(c)}" for c in range(0x3100) if chr(c).isspace()]
    assert got(texts) == [expected(t) for t in texts]
    assert got(["", " "]) == [[], []] and got([]) == []
