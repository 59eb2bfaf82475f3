"""Plain word lists that the operators and the cross-checking SQL both read."""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path


@lru_cache(maxsize=1)
def spanish_stopwords() -> tuple[str, ...]:
    """The Spanish stop-word list that ships with Spark, one word a line, in its order."""
    lines = (Path(__file__).parent / "spanish_stopwords.txt").read_text(encoding="utf-8").split("\n")
    return tuple(dict.fromkeys(w for w in lines if w))
