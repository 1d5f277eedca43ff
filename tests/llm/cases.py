"""Small hostile tables and brute-force versions shared by the corpus tests."""

import collections
import re
import zlib

import numpy as np
import xxhash

WORDS = r"[^\x20\x09-\x0D]+"

LONG = ("Lorem ipsum dolor sit amet, consectetur adipiscing elit.\n" * 3 + "été 12 ñ ") * 6000     # about 1 MB

TEXTS = [
    "", None, " \t\n ", "one", "Two words", "The quick brown fox jumps over the lazy dog. " * 4,
    "The quick brown fox jumps over the lazy dog. " * 4, "Straße ÉCOLE ΑΣ İstanbul ﬁ 日本語 ١٢٣ ½ 😀👩‍👩‍👧",
    "It's 'still we'll'd ''s don't I'M", "a<|endoftext|>B<|startoftext|> <|ENDOFTEXT|>", "x\x1cy\x85z\xa0w​q \x00\x01",
    "a  b", "a \n b\n\n c  ", "\t\n y", "aaaaaaaaaaaaaaaaaaaaaaaaaaa" * 30, "#### *** $$$ %%% ||| <a> & b", "line\nline\nline\nother\n\n",
    "123 456 . , !", LONG, LONG + " tail",
]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, row long, pattern string, score string, ids string"


def documents(spark, texts=None):
    """Rows with null ids, null columns, repeated rows and columns that clash."""
    texts = TEXTS if texts is None else texts
    rows = [(i, t, "en" if i % 2 else None, None, None, None, i, "p", None, "x") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "no id here at all", None, None, None, 1, 1, None, None, None)] if len(rows) > 5 else []
    return spark.createDataFrame(rows, SCHEMA)


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def fingerprint(text, k=4):
    words = re.findall(WORDS, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    ones = collections.Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components(n, linked):
    """Root of each of n items under the links, by union-find."""
    root = list(range(n))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a
    for a, b in linked:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def rule_counts(text):
    words = re.findall(WORDS, text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen, cover = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            cover.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if re.search(WORDS, x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover))
