"""Invented prose, and a plain model to hold the trie against."""

import math
import random
from collections import Counter, defaultdict

from starload.llm.lm_score import EDGE, ORDER, SYMBOLS

WORDS = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "mu", "nu", "xi", "rho"]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice("abcdefgh") + rng.choice("stuvwxyz") for _ in range(n))


_CACHE: dict = {}


def plain_ppm(learned: list[bytes], text: bytes) -> float:
    """log10 probability by walking down the contexts with explicit exclusion sets."""
    key = id(learned)
    if key not in _CACHE:
        seen = defaultdict(Counter)
        for t in learned:
            symbols = [EDGE] * ORDER + list(t) + [EDGE]
            for i in range(ORDER, len(symbols)):
                for k in range(ORDER + 1):
                    seen[tuple(symbols[i - k : i])][symbols[i]] += 1
        _CACHE[key] = seen
    seen = _CACHE[key]
    symbols = [EDGE] * ORDER + list(text) + [EDGE]
    total = 0.0
    for i in range(ORDER, len(symbols)):
        excluded: set = set()
        for k in range(ORDER, -1, -1):
            context = seen.get(tuple(symbols[i - k : i]))
            if not context:
                continue
            left = {s: n for s, n in context.items() if s not in excluded}
            n, d = sum(left.values()), len(left)
            if symbols[i] in left:
                total += math.log10(left[symbols[i]] / (n + d))
                break
            if d:
                total += math.log10(d / (n + d))
            excluded |= set(context)
        else:
            total -= math.log10(SYMBOLS - len(excluded))
    return total
