"""Made-up texts for the tests."""

from __future__ import annotations

import random


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))


def changed(text: str, every: int, mark: str) -> str:
    """One word in ``every`` replaced."""
    return " ".join(f"{mark}{i}" if i % every == every // 2 else w for i, w in enumerate(text.split(" ")))
