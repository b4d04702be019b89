"""Texts reduced to letters and words, where case and normal form do not matter."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import numpy as np
import regex

_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}\p{N}]+")
_PREFIX = regex.compile(r"^\s*(?:\([^()]*\)|\[[^\[\]]*\]|（[^（）]*）|【[^【】]*】|\{[^{}]*\}|<[^<>]*>|《[^《》]*》|〈[^〈〉]*〉)")
_ASCII = str.maketrans({chr(i): " " for i in range(128) if not chr(i).isalnum()})


def words(text: str) -> str:
    """Lower-case words (unbroken runs of letters, marks and digits), one blank between."""
    if text.isascii():
        return " ".join(text.lower().translate(_ASCII).split())
    return _NOT_LETTERS.sub(" ", unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).lower())).strip()


def letters(text: str) -> str:
    """Only the letters, marks and digits, in lower case, without a leading bracketed prefix."""
    m = _PREFIX.match(text)
    return words(text[m.end() :] if m else text).replace(" ", "")


@cache
def _is_letter() -> np.ndarray:
    table = np.zeros(sys.maxunicode + 1, dtype=bool)
    table[[ord(c) for c in regex.findall(r"[\p{L}\p{M}\p{N}]", "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)])))]] = True
    table[10] = True
    return table


def letters_of(texts: list[str]) -> list[str]:
    """``letters`` of each text, with one pass over all of them."""
    if not texts:
        return []
    own = []
    for t in texts:
        m = _PREFIX.match(t)
        t = (t[m.end() :] if m else t).replace("\n", " ")
        own.append(t.lower() if t.isascii() else unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", t).lower()))
    codes = np.frombuffer("\n".join(own).encode("utf-32-le"), dtype=np.uint32)
    return codes[_is_letter()[codes]].tobytes().decode("utf-32-le").split("\n")
