"""Ids of texts against one call of the tokenizer for each text."""

import random

import pyarrow as pa
import pytest

from weftline.llm import tokens

LETTERS = "abcdefgXYZàéÿŸÀßø×÷ΣσİÍж中9０'’-_.,!<|>\u0085 \t\n "


@pytest.mark.parametrize("remembered", [3, 40, 300_000])
def test_ids_equal_one_call_for_each_text(vocabulary, monkeypatch, remembered):
    """Slices share words, so that some are kept and some forgotten whenever more than `remembered` are known."""
    monkeypatch.setattr(tokens, "REMEMBERED", remembered)
    rng, codec = random.Random(5), tokens.Encoder(vocabulary)
    common = ["the", "Été", "don't", "naïve", "x9", "<|endoftext|>", "ÉCOLE", "l'été", "ῼ", "é"]
    for _ in range(30):
        texts = [None, "", *(
            " ".join(rng.choices(common, k=3)) + "".join(rng.choices(LETTERS, k=rng.randrange(40))) + rng.choice([" ", "the"])
            for _ in range(20)
        )]
        flat, bounds = codec.encode(pa.array(texts), 1)
        got = [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == [[*codec.tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def test_words_of_several_slices_are_kept(vocabulary, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 8)
    codec = tokens.Encoder(vocabulary)
    for k in range(6):
        codec.encode(pa.array([f"often elsewhere word{'abcdefgh'[k]}x only{'abcdefgh'[k]}y"]))
    learned = []
    monkeypatch.setattr(codec, "_learn", learned.append)
    codec.encode(pa.array(["often elsewhere"]))
    assert not learned and len(codec.known) <= 8
