"""Pre-tokenisation of the two public vocabularies and bounded tables of ids.

A text is cut at special-token strings, then into words by the vocabulary's
own pattern.  BPE never crosses a word, so a word's ids can be reused: each
worker keeps bounded tables of what it has met, and only unseen words reach
the encoder, in batches.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable

import numpy as np
import regex

# Fixed values of the vocabularies' own files.
LOWER_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same for texts of code points below 256, where the classes are short lists.
_L, _N, _B = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
LOWER_PLAIN = rf"'(?:s|t|re|ve|m|ll|d)|[{_L}]+|[{_N}]|[^{_B}{_L}{_N}]+"
BYTE_PLAIN = rf"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[{_N}]+| ?[^{_B}{_L}{_N}]+|[{_B}]+(?![^{_B}])|[{_B}]+"

#: Before a special token's string among words: no word is a blank and that string.
MARK = " "

#: A text longer than this is worked on in pieces, cut where a blank follows a non-blank.
PIECE_CHARS = 1 << 20
_CUT = regex.compile(r"(?<=\S)(?=\s)")


def pieces(text: str, size: int = PIECE_CHARS) -> Iterable[str]:
    """Cut a long text where no word of either pattern can cross."""
    start = 0
    while len(text) - start > size:
        m = _CUT.search(text, start + size)
        if m is None:
            break
        yield text[start:m.start()]
        start = m.start()
    yield text[start:] if start else text


def latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def lower_normal(text: str) -> str:
    """NFC, then lower case one code point at a time (no final-sigma rule).
    White space is only a separator for this vocabulary and stays as it is."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


class WordSplitter:
    """Cuts texts into words by a vocabulary's pattern, special tokens as themselves."""

    def __init__(self, pattern: str, plain: str, normal: Callable[[str], str] | None, specials: Iterable[str]):
        self.pattern, self.plain, self.normal = regex.compile(pattern).findall, re.compile(plain).findall, normal
        self.specials = [s for s in specials if s]
        alternatives = "|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True))
        self.special = regex.compile(f"({alternatives})") if self.specials else None

    def words(self, text: str) -> Iterable[list[str]]:
        """One list of words per bounded piece of the text."""
        parts = [text]
        if self.special is not None and any(s in text for s in self.specials):
            parts = self.special.split(text)
        for k, part in enumerate(parts):
            if k % 2:
                yield [MARK + part]
            elif part:
                for p in pieces(part):
                    if self.normal:
                        p = self.normal(p)
                    yield self.plain(p) if latin(p) else self.pattern(p)


class TextIds:
    """Ids of whole texts, by a table word -> ids (little-endian int32 bytes).

    ``encode`` maps a list of unseen words to (flat ids, lengths).  The table is
    bounded in entries; when it is full, only what the batch at hand uses stays: a
    rare word costs one more encoding, never a result.
    """

    def __init__(self, splitter: WordSplitter, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
                 specials: dict[str, int], limit: int = 700_000, longest: int = 48):
        self.splitter, self.encode, self.limit, self.longest = splitter, encode, limit, longest
        self.fixed = {MARK + w: np.array([i], "<i4").tobytes() for w, i in specials.items()}
        self.table: dict[str, bytes] = dict(self.fixed)

    def learn(self, lists: list[list[str]]) -> list[str]:
        """Enter the unseen words; returns those that are too long to keep."""
        seen: set[str] = set()
        seen.update(*lists)
        new = list(seen.difference(self.table))
        if not new:
            return new
        if len(self.table) + len(new) > self.limit:
            have = self.table
            self.table = {**self.fixed, **{w: have[w] for w in seen if w in have}}
        flat, lengths = self.encode(new)
        raw = np.ascontiguousarray(flat, dtype="<i4").tobytes()
        a = 0
        for w, b in zip(new, (np.cumsum(lengths) * 4).tolist()):
            self.table[w] = raw[a:b]
            a = b
        return [w for w in new if len(w) > self.longest]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        lists, owner = [], []
        for k, t in enumerate(texts):
            for ws in self.splitter.words(t):
                lists.append(ws)
                owner.append(k)
        long = self.learn(lists)
        get = self.table.__getitem__
        got: list[list[bytes]] = [[] for _ in texts]
        for k, ws in zip(owner, lists):
            got[k].append(b"".join(map(get, ws)))
        for w in long:
            del self.table[w]
        return [np.frombuffer(b"".join(g), "<i4") for g in got]
