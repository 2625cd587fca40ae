"""Value ranges of integer-like types, and the widths decimals are stored in."""

from __future__ import annotations

from dataclasses import dataclass

#: Most digits that fit a storage width, narrowest first (fixed values).
DECIMAL_DIGITS = ((2, 8), (4, 16), (9, 32), (18, 64), (38, 128))


@dataclass(frozen=True)
class Range:
    """Integers from ``lo`` to ``hi``, both included."""

    lo: int
    hi: int

    def covers(self, other: Range) -> bool:
        return self.lo <= other.lo and other.hi <= self.hi

    def __contains__(self, value: int) -> bool:
        return self.lo <= value <= self.hi


BIT = Range(0, 1)


def source_integer(bits: int) -> Range:
    """All of two's complement, as a DataFrame may hold it."""
    return Range(-(1 << (bits - 1)), (1 << (bits - 1)) - 1)


def stored_integer(bits: int) -> Range:
    """The least value is the mark of a null, so the range is symmetric."""
    top = (1 << (bits - 1)) - 1
    return Range(-top, top)


def decimal_digits(precision: int) -> Range:
    """Of the unscaled value."""
    return Range(1 - 10**precision, 10**precision - 1)


def decimal_bits(precision: int) -> int:
    """Storage width of a decimal, or -1 where no width holds it."""
    if precision < 1:
        return -1
    return next((bits for digits, bits in DECIMAL_DIGITS if precision <= digits), -1)
