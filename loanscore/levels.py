"""Point levels and subject weights.

The reference keeps these as session-conf strings; here they are plain
arguments so a changed level never needs a new session.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Levels:
    # The seven point levels of the scoring rules.
    very_bad: float = 0.0
    bad: float = 100.0
    ok: float = 250.0
    good: float = 350.0
    very_good: float = 500.0
    unacceptable: float = -500.0
    no_points: float = 0.0

    def value(self, name: str) -> float:
        return float(getattr(self, name))


@dataclass(frozen=True)
class Weights:
    # Weight of each subject total in the member total.
    payments: float = 0.2
    defaults: float = 0.25
    inquiries: float = 0.25
    loan: float = 0.15
    personal: float = 0.15


DEFAULT_LEVELS = Levels()
DEFAULT_WEIGHTS = Weights()
