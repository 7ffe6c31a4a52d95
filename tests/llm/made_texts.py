"""Made-up prose for the tests."""

from __future__ import annotations

import random

WORDS = {"en": "the of and to in that is was for with on as by at from this".split(), "fr": "le la les des une est dans pour que qui sur avec pas au".split(), "de": "der die das und ist nicht ein mit auf von zu den für im".split()}


def prose(rng: random.Random, lang: str, n: int) -> str:
    words = WORDS[lang]
    return " ".join(rng.choice(words) + (rng.choice(words) if rng.random() < 0.5 else "") for _ in range(n))
