"""BPE encoding and decoding in batched numpy merge rounds.

The symbols of many words lie in one flat array.  Each round looks up every
neighbouring pair by binary search over the sorted pair keys, takes the lowest
rank of each word, merges all its non-overlapping occurrences from left to
right, and retires words without a pair left.  Words are independent, so a
batch of them is one set of array operations.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, tokenizer_path
from .wordsplit import LOWER_PLAIN, LOWER_WORDS, TextIds, WordSplitter, lower_normal

NO_RANK = np.int64(1) << 40


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from code point 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, nxt = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], nxt = chr(nxt), nxt + 1
    return out


class MergeTable:
    """The vocabulary as arrays: byte symbols, sorted pair keys, ranks and results."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.suffix = model.get("end_of_word_suffix") or ""
        self.size = max([*vocab.values(), *self.specials.values()]) + 1
        letters = byte_letters()
        self.inner = np.array([vocab.get(c, -1) for c in letters], np.int64)
        self.final = np.array([vocab.get(c + self.suffix, -1) for c in letters], np.int64)
        self.tokens = np.empty(self.size, dtype=object)
        for token, i in [*vocab.items(), *self.specials.items()]:
            self.tokens[i] = token
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.decimal = np.array([str(i) for i in range(self.size)], dtype=object)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the number of ids of each word."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[data]
        filled = np.flatnonzero(lens)
        last = np.cumsum(lens)[filled] - 1
        sym[last] = self.final[data[last]]
        owner = np.repeat(np.arange(len(raw)), lens)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            size = np.diff(np.r_[start, len(sym)])
            pair = np.empty(len(sym), np.int64)
            pair[:-1] = sym[:-1] * self.size + sym[1:]
            pair[start + size - 1] = -1                         # a word's last symbol has no right neighbour
            at = np.searchsorted(self.keys, pair)
            at[at == len(self.keys)] = 0
            rank = np.where(self.keys[at] == pair, self.ranks[at], NO_RANK)
            best = np.minimum.reduceat(rank, start)
            live = best < NO_RANK
            if not live.all():
                keep = np.repeat(live, size)
                done.append((owner[~keep], sym[~keep]))
                sym, owner, rank, at = sym[keep], owner[keep], rank[keep], at[keep]
                best, size = best[live], size[live]
                if not len(sym):
                    break
            hit = rank == np.repeat(best, size)
            # within a run of adjacent hits (one symbol repeated) every second one is merged
            place = np.arange(len(hit))
            first = hit & ~np.r_[False, hit[:-1]]
            run = np.maximum.accumulate(np.where(first, place, 0))
            merge = np.flatnonzero(hit & ((place - run) % 2 == 0))
            sym[merge] = self.made[at[merge]]
            keep = np.ones(len(sym), bool)
            keep[merge + 1] = False
            sym, owner = sym[keep], owner[keep]
        if not done:
            return np.empty(0, np.int32), np.zeros(len(words), np.int64)
        who, ids = np.concatenate([o for o, _ in done]), np.concatenate([s for _, s in done])
        order = np.argsort(who, kind="stable")
        return ids[order].astype(np.int32), np.bincount(who, minlength=len(words))

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary names no decoder: tokens joined by one space."""
        return " ".join(self.tokens[ids].tolist())


class BpeCodec:
    """Encoder (texts to id arrays) and decoder of one vocabulary, with a worker's tables."""

    def __init__(self, vocabulary: str):
        self.merges = MergeTable(tokenizer_path(vocabulary))
        specials = self.merges.specials
        self.encode = TextIds(WordSplitter(LOWER_WORDS, LOWER_PLAIN, lower_normal, specials), self.merges.encode_words, specials)

    def decode(self, ids: np.ndarray) -> str:
        return self.merges.decode(ids)


_CODECS: dict[str, BpeCodec] = {}


def codec(vocabulary: str) -> BpeCodec:
    """One codec per worker process and vocabulary."""
    if vocabulary not in _CODECS:
        _CODECS[vocabulary] = BpeCodec(vocabulary)
    return _CODECS[vocabulary]


def encode(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text.  Null texts count as empty and give
    an empty array; rows are kept as they come, repeated ids included."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in batches:
            got = c.encode([t or "" for t in b.column(1).to_pylist()])
            flat = np.concatenate([np.empty(0, "<i4"), *got])
            offsets = np.r_[0, np.cumsum([len(g) for g in got])].astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, flat)],
                                             names=["doc_id", "ids"])
    return map_batches(docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")), kernel,
                       "doc_id long, ids array<int>")


def decode(ids: DataFrame, vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    """(doc_id, text): the decoded text of each row of (doc_id, ids); null ids give null."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in batches:
            col = b.column(1)
            text = [None if not col[i].is_valid else c.decode(np.asarray(col[i].values)) for i in range(len(col))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], names=["doc_id", "text"])
    return map_batches(ids.select("doc_id", "ids"), kernel, "doc_id long, text string")


def encode_decode_digests(docs: DataFrame, vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    """Per document: number of ids, sha256 of the decimal ids, sha256 of the text
    decoded from those ids.  One narrow pass: texts in, digests out, so neither
    ids nor decoded texts are shuffled or stored.  Null text counts as empty
    (no ids, digests of the empty string)."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        decimal = c.merges.decimal
        for b in batches:
            n, digest, decoded = [], [], []
            for ids in c.encode([t or "" for t in b.column(1).to_pylist()]):
                n.append(len(ids))
                digest.append(hashlib.sha256(" ".join(decimal[ids].tolist()).encode()).hexdigest())
                decoded.append(hashlib.sha256(c.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return map_batches(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]), kernel,
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
