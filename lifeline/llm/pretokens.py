"""Splitting of texts into the units that a BPE tokenizer encodes one by one.

Texts of common Latin characters are split by compiled character classes; a
text with any other character goes through the tokenizer's own normaliser and
splitter, so results follow the library everywhere.  Lower-casing and NFC do
nothing unusual inside the Latin range (tests compare with the library).
"""

from __future__ import annotations

import re
import unicodedata

#: Characters whose normalisation or class is left to the library: all beyond Latin Extended-A and common punctuation.
_OTHER = re.compile("[^\x00-ſ‐-‧‰-⁞€]")
_SPACE = r"\t-\r \x85\xa0"


def _class(major: str) -> str:
    """Characters of a Unicode class, as the inside of a character class."""
    chars = [chr(c) for c in [*range(0x180), *range(0x2010, 0x205F), 0x20AC] if unicodedata.category(chr(c))[0] == major]
    return "".join(re.escape(c) for c in chars)


_L, _N = _class("L"), _class("N")
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_SPACE}{_L}{_N}]+")
_BYTE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_SPACE}{_L}{_N}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


class Splitter:
    """Pre-tokens of texts for one tokenizer file."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        special = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(sorted(special, key=len, reverse=True))) if special else None
        self.lower = tokenizer.normalizer is not None
        self.pattern = _WORD if self.lower else _BYTE

    def _plain(self, text: str) -> list[str]:
        if not _OTHER.search(text):
            return self.pattern.findall(text.lower() if self.lower else text)
        if self.lower:
            text = self.tokenizer.normalizer.normalize_str(text)
        return [text[s:e] for _, (s, e) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def __call__(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.special is None or not (found := [m.span() for m in self.special.finditer(text)]):
            return self._plain(text)
        out, last = [], 0
        for s, e in found:
            out += self._plain(text[last:s])
            out.append(text[s:e])
            last = e
        return out + self._plain(text[last:])
