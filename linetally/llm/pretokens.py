"""Byte-level pre-tokens and vocabulary files of public tokenizers."""

from __future__ import annotations

import json
import re
from functools import lru_cache

#: Planes with assigned letters, digits and spaces; elsewhere every code point is of the kind "other".
_PLANES = ((0x0, 0xD800), (0xE000, 0x40000), (0xE0000, 0xE0200))


@lru_cache(maxsize=1)
def split_patterns() -> tuple[str, str]:
    """The widely published byte-level split as patterns of the ``re``
    module (for texts without, and with, characters from U+10000 on):
    contractions, letters, digits, other signs, white space.

    The classes are spelled out as ranges, as the Unicode tables of Python and of the
    tokenizers library differ for newer characters. They are read from the
    library's own splitter: in ``a?1!?|`` the code point ``?`` stays with the
    ``a`` if it is a letter, with the ``1`` if it is a digit, with the ``!`` if
    it is another sign, and with none if it is white space (a plain space
    may lead any of them). Run once on the
    driver; the workers get the patterns."""
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    ranges: dict[str, list[list[int]]] = {"letter": [], "digit": [], "space": []}
    for low, high in _PLANES:
        for base in range(low, high, 2048):
            codes = range(base, min(base + 2048, high))
            starts = {i for _, (i, _) in split.pre_tokenize_str("".join([f"a{chr(c)}1!{chr(c)}|" for c in codes]))}
            for k, c in enumerate(codes):
                at = 6 * k
                kind = ("space" if c == 0x20 else "letter" if at + 1 not in starts
                        else "digit" if at + 2 not in starts else "space" if at + 4 in starts else None)
                if kind and ranges[kind] and ranges[kind][-1][1] == c - 1:
                    ranges[kind][-1][1] = c
                elif kind:
                    ranges[kind].append([c, c])

    def pattern(below: int) -> str:
        cls = {k: "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in v if a < below) for k, v in ranges.items()}
        letter, digit, space = cls["letter"], cls["digit"], cls["space"]
        return (f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+"
                f"|[{space}]+(?![^{space}])|[{space}]+")

    return pattern(0x10000), pattern(0x110000)


class Splitter:
    """Cuts a text into its pre-tokens. ``re`` tests classes of characters
    below U+10000 by a table, those above range by range, so a text without the latter
    gets the pattern without them; the cuts are the same."""

    def __init__(self, patterns: tuple[str, str]):
        self.narrow, self.wide = map(re.compile, patterns)

    def __call__(self, text: str) -> list[str]:
        plain = len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        return (self.narrow if plain else self.wide).findall(text)


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each
    byte: printable Latin-1 signs stand for themselves, the other bytes get
    the characters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str) -> tuple[dict[bytes, int], list[tuple[bytes, bytes]], dict[str, int]]:
    """Token bytes to id, merges in rank order, added tokens to id, from a
    ``tokenizer.json`` file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    to_byte = byte_alphabet()
    raw = lambda s: bytes(to_byte[c] for c in s)
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = {raw(k): v for k, v in spec["model"]["vocab"].items() if k not in added}
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    return vocab, [(raw(a), raw(b)) for a, b in merges], added
