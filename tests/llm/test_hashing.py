"""Word hashes: the same words give the same hashes, other words others, however the text is cut."""

import random
import re

import numpy as np

from policylens.llm import hashing


def test_words_and_their_hashes_match_one_to_one(monkeypatch):
    rnd = random.Random(1)
    letters = "abAB é\t\n\x0b\x0c\r\x1c\x85日"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(2000)] + ["", None, " ", "x"]
    seen = {}
    for text in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x20\x09-\x0D]+", low)
        got = hashing.word_hashes(text).tolist()
        assert len(got) == len(found)
        for word, h in zip(found, got, strict=True):
            assert seen.setdefault(h, word) == word
    assert len(set(seen.values())) == len(seen)
    long = " ".join(t for t in texts if t)
    whole = hashing.word_hashes(long)
    monkeypatch.setattr(hashing, "BLOCK", 50)
    assert (hashing.word_hashes(long) == whole).all()


def test_anagrams_and_near_words_differ():
    words = [f"{a}{b}{c}{d}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh" for d in "abcdefgh"]
    words += ["ab" * n for n in range(3, 300)] + ["ba" * n for n in range(3, 300)]
    assert len(np.unique(hashing.word_hashes(" ".join(words)))) == len(set(words))


def test_a_word_longer_than_a_block():
    long = "x" * (3 * hashing.BLOCK)
    got = hashing.word_hashes(f"a {long} b {long} a")
    assert len(got) == 5 and got[0] == got[4] and got[1] == got[3] and len(set(got.tolist())) == 3
