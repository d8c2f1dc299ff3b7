"""Insults that are spread or broken up: learnt from plain ones, found in texts that the model hasn't seen."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tallyforge.llm import toxicity
from tallyforge.llm.batches import text_bytes

INSULTS = "idiot moron loser trash stupid worthless pathetic disgusting".split()


def prose(rng, n):
    return " ".join("".join(rng.choices("the of an re in on er th st ti ea ou".split(), k=rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    clean = [prose(rng, rng.randint(20, 90)) for _ in range(240)]
    toxic = [f"{prose(rng, 25)} {INSULTS[i % len(INSULTS)]} {prose(rng, 25)}" for i in range(240)]
    return toxicity.fit(clean + toxic, np.array([False] * 240 + [True] * 240))


def scores(model, texts):
    return model.score(*text_bytes(pa.array(texts, pa.large_string())))


ALTERATIONS = {
    "plain": lambda w: w, "upper": str.upper, "dots": ".".join, "dashes": "--".join, "spaces": " ".join, "two spaces": "  ".join, "an x": "x".join, "newlines": "\n".join, "no width": "​".join,
    "a letter inside": lambda w: f"{w[: len(w) // 2]}k{w[len(w) // 2 :]}", "a letter early": lambda w: f"{w[:2]}q{w[2:]}",
}


@pytest.mark.parametrize("name", ALTERATIONS)
def test_altered_insults_are_found(model, name):
    """Words of six letters and more stay telling when altered; shorter ones have two gapless subsequences only, and are missed more often."""
    rng = random.Random(2)
    found = {w: (scores(model, [f"{prose(rng, 30)} {ALTERATIONS[name](w)} {prose(rng, 30)}" for _ in range(5)]) >= 0.5).mean() for w in INSULTS}
    assert np.mean([found[w] for w in INSULTS if len(w) > 5]) >= (0.75 if name == "two spaces" or "letter" in name else 0.9), found
    assert np.mean(list(found.values())) >= (0.9 if name in ("plain", "upper", "dots", "dashes", "no width") else 0.5), found


def test_clean_texts_stay(model):
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(10, 400)) for _ in range(100)] + ["", "​​", "x"]
    assert (scores(model, texts) >= 0.5).mean() <= 0.03


def test_strides_are_plain_slices():
    texts = ["", "a", "abcdefg", "i d i o t", "zz"]
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    for stride in (2, 3):
        own, cuts = toxicity.strided(data, offsets, stride)
        got = [own[a:b].tobytes().decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        assert got == [t[k::stride] for t in texts for k in range(stride)]


def test_characters_without_width():
    text = "a​b‏c⁠d﻿e‐"
    data, offsets = toxicity.joined(*text_bytes(pa.array([text], pa.large_string())))
    assert data.tobytes().decode() == "abcde‐"
