"""Helpers of the tests."""

import random

import numpy as np


def brute_components(values, distance, ids=None):
    """The smallest id that is reachable from each value, by comparing all pairs."""
    values = np.array(values, np.uint64)
    ids = list(range(len(values))) if ids is None else ids
    root = np.arange(len(values))
    for i, value in enumerate(values):
        close = np.bitwise_count(values ^ value) <= distance
        for r in set(root[close]):
            root[root == r] = root[i]
    return [min(ids[j] for j in np.flatnonzero(root == root[i])) for i in range(len(values))]


def prose(seed: int, n: int) -> str:
    """So many words that repeat now and then, in lines."""
    draw = random.Random(seed)
    words = ["".join(draw.choices("aeiourstln", k=draw.randint(1, 7))) for _ in range(120)]
    return " ".join(draw.choice(words) + draw.choice(["", "", "", ",", ".\n"]) for _ in range(n))


def thue_morse(n: int, letters: str = "ab") -> str:
    """A word on which sums of powers modulo a power of two agree with those of its complement."""
    return "".join(letters[i.bit_count() & 1] for i in range(n))
