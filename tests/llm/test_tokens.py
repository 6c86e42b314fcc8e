"""Ids of the short ways with words against the library's, and how little is left to the library."""

import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import public_tokenizers  # noqa: E402

from escrutinio.llm import simple8b, tokens  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
MARKS = [".", ",", "!", "***", "$$$", "%%%,", "'", "|>"]
ODD = ["<|endoftext|>", "<|ENDOFTEXT|>.", "é", "É.", "é,", "×.", "÷!", "İ.", "İa", "Σς.", "€.", "²;", "中.", "​.", " .", "\x1c", "it's.", "a'll!", "7.5,", "--", "ǆ?"]


def plain(tokenizer, text):
    return np.array(tokenizer.library.encode(text, add_special_tokens=False).ids, tokenizer.dtype).tobytes()


def test_ids_are_the_librarys():
    tokenizer, rng = tokens.WordTokenizer(PATH), random.Random(5)
    pieces = [*MARKS, *ODD, "Word", "año", " ", "  ", "\n", "\t"]
    texts = ["", " ", "\n", *("".join(rng.choices(pieces, k=rng.randrange(12))) for _ in range(1500))]
    for at in range(0, len(texts), 250):
        some = texts[at : at + 250]
        assert tokenizer.encode([t.encode() for t in some]) == [plain(tokenizer, t) for t in some]


def test_a_word_is_learned_once_for_all_its_marks():
    tokenizer = tokens.WordTokenizer(PATH)
    words = ["erenthed", "ciónqueciónga", "laasícota"]
    text = " ".join(w + m for w in words for m in ["", *MARKS])
    assert tokenizer.encode([text.encode()]) == [plain(tokenizer, text)]
    assert len(tokenizer.young) <= len(words) + len(MARKS) + 1  # the absent mark


def test_ids_outlive_the_cache(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 3)
    tokenizer = tokens.WordTokenizer(PATH)
    for text in ["one two. three four!", "four five, one", "two. six seven eight", "", "one* one"] * 2:
        assert tokenizer.encode([text.encode(), b""]) == [plain(tokenizer, text), b""]


@pytest.mark.parametrize("kind", ["<u2", "<u4", "<u8"])
def test_words_take_the_widest_count_that_fits(kind):
    rng = np.random.default_rng(4)
    values = (rng.integers(0, 1 << 62, 3000, dtype=np.uint64) >> rng.integers(0, 62, 3000).astype(np.uint64)).astype(kind)
    values[::7] = 0
    expected = []
    for start in range(0, len(values), 64):
        block, at = [int(v) for v in values[start : start + 64]], 0
        while at < len(block):
            fitting = [c for c in simple8b.COUNTS if at + c <= len(block) and max(block[at : at + c]) < 1 << (60 // c)]
            expected.append(simple8b.COUNTS.index(fitting[0]) if fitting else 15)
            at += fitting[0] if fitting else 1
    words, offsets = simple8b.encode(values, 64)
    assert np.array_equal(simple8b.decode(words, offsets), values.astype(np.uint64))
    if kind != "<u8":  # else raw words follow escapes
        assert (words >> np.uint64(60)).tolist() == expected


def test_words_kept_are_bounded_by_their_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_BYTES", 1 << 20, raising=False)
    tokenizer = tokens.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    texts = [(chr(97 + k) * 100_000 + " the").encode() for k in range(26)]
    assert [tokenizer.encode([t])[0] for t in texts] == tokenizer.encode(texts)
    one = tokens.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    assert [one.encode([t])[0] for t in texts] == tokenizer.encode(texts)
    for k in range(200):
        one.encode([f"{'x' * 9000}{k}".encode()])
        assert sum(len(w) for known in (one.young, one.old) for w in known) < 3 << 20
