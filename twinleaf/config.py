"""Settings of a run, passed explicitly; their digest is part of every stage's cache key."""

from __future__ import annotations

import hashlib
from dataclasses import asdict, dataclass


@dataclass(frozen=True)
class Config:
    section_sep: str = " / "
    lower: float = 0.55  # least combined score of a candidate
    upper: float = 0.85  # from here on: high_confidence
    top_k: int = 5
    weight_char: float = 0.40
    weight_word: float = 0.25
    weight_fuzzy: float = 0.35
    prefilter: float = 0.6  # of lower: least of the two cosines' greater one
    confidence: float = 0.7  # from here on a section counts as classified
    batch_size: int = 25

    def digest(self) -> str:
        return hashlib.sha256(repr(sorted(asdict(self).items())).encode()).hexdigest()[:16]
