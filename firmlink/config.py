"""Job parameters."""

from __future__ import annotations

from dataclasses import dataclass

# Defaults of the matching job (block prefix length, score bands).
DEFAULT_BLOCK_CHARS = 3
DEFAULT_THRESHOLD_LO = 0.80
DEFAULT_THRESHOLD_HI = 0.95
# The original job appends on every run; here a rerun adds nothing twice.
DEFAULT_WRITE_MODE = "insert_if_absent"


@dataclass(frozen=True)
class MatchConfig:
    """Parameters of the unification job.

    ``lo <= score < hi`` is the borderline band (closed below, open above);
    ``score >= hi`` is accepted without confirmation.
    ``confirm_limit`` bounds the distinct name pairs handed to a confirmation
    *function*; by default all are asked, and a bound warns with the number of
    pairs left out. A verdict table is never capped.
    ``write_mode`` for the unified table: ``insert_if_absent`` on ``(abn,
    domain)``, ``append`` (every run adds its rows) or ``overwrite``.
    """

    block_chars: int = DEFAULT_BLOCK_CHARS
    lo: float = DEFAULT_THRESHOLD_LO
    hi: float = DEFAULT_THRESHOLD_HI
    confirm_limit: int | None = None
    write_mode: str = DEFAULT_WRITE_MODE

    def __post_init__(self):
        if self.write_mode not in ("append", "overwrite", "insert_if_absent"):
            raise ValueError("write_mode must be append, overwrite or insert_if_absent")
        if not (0.0 < self.lo <= self.hi <= 1.0):
            raise ValueError("need 0 < lo <= hi <= 1")
        if self.block_chars < 1:
            raise ValueError("block_chars must be >= 1")
