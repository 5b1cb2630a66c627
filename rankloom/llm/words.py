"""Words of a text inside Python tasks."""

from __future__ import annotations

import re

# A-Z lower-cased, what is no letter, no digit and not beyond ASCII made blank.
_LOWERED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, as UTF-8. Null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWERED).split() if text else []


_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def word_places(text: str) -> list[tuple[int, int]]:
    """First character and end of each word of `words_of`."""
    return [m.span() for m in _WORD.finditer(text)]
