"""Invented texts for the tests of the text operators."""

import random


def prose(rng: random.Random, n: int, vocabulary: int = 3000) -> list[str]:
    """Words of an invented text; a few are frequent."""
    return [f"w{int(vocabulary * rng.random() ** 2.5)}" for _ in range(n)]
