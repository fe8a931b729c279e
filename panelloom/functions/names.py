"""Column-name rules. They work on the schema only, so no Spark job runs."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

# Letters whose ASCII form is more than the letter without its accent.
_SPELLED_OUT = str.maketrans({"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d"})
_SYMBOL_WORDS = {"%": "_percent_", "#": "_number_", "'": "", '"': ""}


def snake_name(name: str) -> str:
    return name.lower().replace(" ", "_")


def clean_name(name: str) -> str:
    """lower_snake_case in ASCII, starting with a letter (digits get an ``x``)."""
    for symbol, word in _SYMBOL_WORDS.items():
        name = name.replace(symbol, word)
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z][a-z])", "_", name)
    name = unicodedata.normalize("NFKD", name.lower().translate(_SPELLED_OUT))
    name = name.encode("ascii", "ignore").decode()
    name = re.sub(r"[^a-z0-9]+", "_", name).strip("_")
    return name if name and not name[0].isdigit() else f"x{name}"


def question_name(name: str) -> str:
    """A survey question without line breaks, text after ``?`` and bracketed scale notes."""
    name = re.sub(r"\r?\n", " ", name)
    name = name.split("?", 1)[0]
    return clean_name(re.sub(r"\([^)]*\)", "", name).strip())


def numbered(names: Iterable[str]) -> list[str]:
    """Second and later uses of a name get ``_2``, ``_3`` ..."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out
