"""Character vocabularies."""

from __future__ import annotations

from dataclasses import dataclass

# The two character sets, in index order.
MINIMAL_CHARACTERS = (
    "abcdefghijklmnopqrstuvwxyz"
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    "0123456789"
    "!&()?-'\",.:; \n\t"
)
DEFAULT_CHARACTERS = MINIMAL_CHARACTERS + "@#$%^*{}[]/+_\\|<>=`"


@dataclass(frozen=True)
class Vocabulary:
    """Characters in index order; the stop symbol takes the next index."""

    characters: str = DEFAULT_CHARACTERS
    stop_symbol: str = "\0"

    @property
    def stop(self) -> int:
        return len(self.characters)


MINIMAL = Vocabulary(MINIMAL_CHARACTERS)
DEFAULT = Vocabulary(DEFAULT_CHARACTERS)
