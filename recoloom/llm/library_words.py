"""Ids by the tokenizers library, fed with each distinct word once.

The library encodes the words that a worker has not met; a text's ids are
its words' ids in a row, which is what the library gives for the whole text,
as BPE never crosses a word and special tokens are cut out first.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from .common import tokenizer_path
from .wordsplit import BYTE_PLAIN, BYTE_WORDS, LOWER_PLAIN, LOWER_WORDS, TextIds, WordSplitter, lower_normal


class LibraryEncoder:
    """``encode(texts)``: the id arrays of texts."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"          # Spark owns the cores
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(tokenizer_path(vocabulary))
        self.lib.no_truncation()
        self.lib.no_padding()
        specials = {t.content: i for i, t in self.lib.get_added_tokens_decoder().items()}
        lower = self.lib.normalizer is not None
        self.suffix = getattr(self.lib.model, "end_of_word_suffix", None)
        if self.suffix:
            vocab = self.lib.get_vocab()
            self.final = np.zeros(max(vocab.values()) + 1, bool)
            self.final[[i for t, i in vocab.items() if t.endswith(self.suffix)]] = True
        splitter = (WordSplitter(LOWER_WORDS, LOWER_PLAIN, lower_normal, specials) if lower
                    else WordSplitter(BYTE_WORDS, BYTE_PLAIN, None, specials))
        self.encode = TextIds(splitter, self._words, specials)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.suffix:                                         # words end where an id with the suffix stands
            flat = np.array(self.lib.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self.final[flat]) + 1
            if len(ends) == len(words):
                return flat, np.diff(np.r_[0, ends])
        got = [e.ids for e in self.lib.encode_batch_fast(words, add_special_tokens=False)]
        return np.array(list(chain.from_iterable(got)), np.int32), np.fromiter(map(len, got), np.int64, len(got))


_ENCODERS: dict[str, LibraryEncoder] = {}


def encoder(vocabulary: str) -> LibraryEncoder:
    """One encoder per worker process and vocabulary."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = LibraryEncoder(vocabulary)
    return _ENCODERS[vocabulary]
