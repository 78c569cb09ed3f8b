"""Chinese-restaurant seating of Pitman-Yor processes over numpy arrays.

A type is a dish in one restaurant: `c` customers at `t` tables. Given its customers, the chance of t
tables is proportional to S(c, t) x alpha^t, where S are generalised Stirling numbers of the
restaurant's discount and alpha is the weight of a new table: (strength + discount x tables) x what
the parent restaurant gives the dish.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Customers up to which the conditional is taken as a whole. Further ones sit down one after the
#: other, each by its own chances, in blocks of a sixteenth of those who sit already.
WHOLE = 256
#: Customers of the types that are drawn side by side: up to the first, up to the second and so on.
WIDTHS = (2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, WHOLE)


@lru_cache(maxsize=8)
def stirling(discount: float) -> np.ndarray:
    """log S(c, t) for c, t up to WHOLE; minus infinity where t > c."""
    logs = np.full((WHOLE + 1, WHOLE + 1), -np.inf)
    logs[0, 0] = 0
    tables = np.arange(1, WHOLE + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in range(WHOLE):
            stay = np.log(np.maximum(c - discount * tables, 0)) + logs[c, 1:]
            logs[c + 1, 1:] = np.logaddexp(logs[c, :-1], np.where(np.isnan(stay), -np.inf, stay))
    return logs


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64 bits that depend on both of two unsigned 64-bit numbers, in this order."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x += b
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


class Keyed:
    """Stands in for a generator: what a type draws depends on its key alone, so that every task that
    holds the type draws the same. Late customers are the mean of their binomial, rounded at random."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys

    def chance(self, some: np.ndarray, salt: int) -> np.ndarray:
        return (mixed(self.keys[some], np.uint64(salt)) >> np.uint64(11)) / 2.0**53


def draw_tables(c: np.ndarray, alpha: np.ndarray, discount: float, rng: np.random.Generator | Keyed) -> np.ndarray:
    """One Gibbs draw of the tables of each type; no customers, no tables."""
    return draws_of_tables(c, alpha, discount, [rng])[0]


def draws_of_tables(
    c: np.ndarray, alpha: np.ndarray, discount: float, rngs: list[np.random.Generator | Keyed]
) -> list[np.ndarray]:
    """As `draw_tables`, a draw for each generator: all have the same chances."""
    draws = [np.minimum(c, 1).astype(np.int64) for _ in rngs]
    logs = stirling(round(discount, 6))
    several = np.flatnonzero(c > 1)
    first = np.minimum(c[several], WHOLE)
    ordered = np.argsort(first, kind="stable")
    order, first = several[ordered], first[ordered]
    log_alpha = np.log(np.maximum(alpha[order], 1e-300))
    ends = np.searchsorted(first, WIDTHS, side="right")
    for width, start, end in zip(WIDTHS, [0, *ends], ends):
        rows = max(1, 2_000_000 // width)
        for at in range(start, end, rows):
            to = min(end, at + rows)
            some = order[at:to]
            # More tables than customers have no chance.
            weights = logs[first[at:to], 1 : width + 1] + log_alpha[at:to, None] * np.arange(1, width + 1)
            weights = np.cumsum(np.exp(weights - weights.max(axis=1, keepdims=True)), axis=1)
            for out, rng in zip(draws, rngs, strict=True):
                picks = (rng.chance(some, 0) if isinstance(rng, Keyed) else rng.random(len(some))) * weights[:, -1]
                out[some] = 1 + (weights < picks[:, None]).sum(axis=1)
    return [_seat_late(out, c, alpha, discount, rng) for out, rng in zip(draws, rngs, strict=True)]


def _seat_late(
    out: np.ndarray, c: np.ndarray, alpha: np.ndarray, discount: float, rng: np.random.Generator | Keyed
) -> np.ndarray:
    """Add the tables of customers beyond WHOLE."""
    late = np.flatnonzero(c > WHOLE)
    seated, salt = np.full(len(late), WHOLE, np.int64), 0
    while len(late):
        salt += 1
        step = np.minimum(np.maximum(seated // 16, 1), c[late] - seated)
        rest = np.maximum(seated + step // 2 - discount * out[late], 1e-9)
        new = alpha[late] / (alpha[late] + rest)
        if isinstance(rng, Keyed):
            out[late] += np.floor(step * new + rng.chance(late, salt)).astype(np.int64)
        else:
            out[late] += rng.binomial(step, new)
        seated = seated + step
        more = seated < c[late]
        late, seated = late[more], seated[more]
    return np.minimum(out, np.maximum(c, 0))
