"""The phone scanner's contract as a plain loop, to check the regular expression against.

A number opens with the country code, may have one trunk zero, must have a known
area code once three digits are there, and is void when an eleventh digit is
followed by anything that could belong to a number.
"""

from __future__ import annotations

import re

INSIDE = frozenset("0123456789-+ ()")
OPENING = re.compile(rb"0031|\+31|\+.31|\+..31", re.S)


def scan(text: str, codes: set[str]) -> list[str]:
    data = text.encode()
    found, at = [], 0
    while opening := OPENING.search(data, at):
        at, number = _follow(data, opening.end(), codes)
        if number:
            found.append(number)
    return found


def _follow(data: bytes, at: int, codes: set[str]) -> tuple[int, str | None]:
    """Where scanning resumes after a number that opened before ``at``, and the number if it is good."""
    digits, trunk = "0", False
    for i in range(at, len(data)):
        c = chr(data[i])
        if c not in INSIDE:
            service = digits[:4] in ("0800", "0900") and len(digits) in (8, 11)
            return i + 1, digits if len(digits) == 10 or service else None
        if len(digits) == 11 or (len(digits) == 4 and not {digits[:3], digits} & codes):
            return i + 1, None
        if c.isdigit():
            if c == "0" and digits == "0":
                if trunk:
                    return i + 1, None
                trunk = True
            else:
                digits += c
    return len(data), None
