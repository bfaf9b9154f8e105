"""Splitting text into the units within which a byte-level BPE merges, exactly as the tokenizer's own splitter does.

Merges never cross these units, so each is encoded once and remembered (in a memory of bounded size).
"""

from __future__ import annotations

import os
import re
from functools import cache

from tokenizers import Tokenizer

# Characters for which the splitter's classes are spelt out below: ASCII without the separators 1C-1F, Latin letters and signs without
# superscript and fraction digits, dashes, quotes, ellipsis.
_KNOWN = r"\x00-\x1B\x20-\x7E\xA0-\xB1\xB4-\xB8\xBA\xBB\xBF-ɏ‐-―‘-„…"
_LETTERS = r"A-Za-z\xAA\xB5\xBA\xC0-\xD6\xD8-\xF6\xF8-ɏ"
_UNKNOWN = re.compile(f"[^{_KNOWN}]")
# Letters come first, as most units are words; nothing that begins with a letter could be anything else.
_UNITS = re.compile(f" ?[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\\s0-9{_LETTERS}]+|\\s+(?!\\S)|\\s+")

SPECIAL = "<|endoftext|>"


@cache
def byte_characters() -> dict[str, int]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else the next free character from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in shown}
    rest = (b for b in range(256) if b not in set(shown))
    return table | {chr(256 + i): b for i, b in enumerate(rest)}


def as_bytes(token: str) -> bytes:
    table = byte_characters()
    return bytes(table[c] for c in token)


@cache
def load(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def units(text: str, tokenizer: Tokenizer) -> list[str]:
    """The units of a text without special tokens; they concatenate to the text."""
    if _UNKNOWN.search(text) is None:
        return _UNITS.findall(text)
    return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]


def pieces(text: str, size: int = 1 << 16):
    """Cut a text into pieces of about ``size`` characters, each encoded alone to the ids it has in the whole.

    A cut lies between a visible character and white space: a unit never goes on there and never looks further right.
    A text without such a place is one piece.
    """
    at, n = 0, len(text)
    while n - at > size:
        end = at + size
        while end > at + 1 and not (text[end].isspace() and not text[end - 1].isspace()):
            end -= 1
        if end == at + 1:  # no place before, so look behind
            end = at + size
            while end < n and not (text[end].isspace() and not text[end - 1].isspace()):
                end += 1
        yield text[at:end]
        at = end
    yield text[at:]
