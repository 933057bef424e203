"""Token ids of whole texts, as little-endian unsigned 32-bit integers."""

from __future__ import annotations

import os
import re
import sys
from array import array
from types import ModuleType

import numpy as np

from mnemolake.llm.common import tokenizer_path

#: A blank in front of white space or at the end: only texts with one are cut with care.
_RUNS = re.compile(r" (?=\s|\Z)")
#: Cutting in front of a blank between two other characters never changes the ids: the vocabulary's pre-tokenizer
#: starts a new piece there.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: A word of letters, maybe with signs behind it: two pieces at most for the pre-tokenizer.
_PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+)([!-&(-/:-@\[-`{-~]*)")
#: Fixed values of byte-level vocabularies: the character that stands for each byte.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHER = [b for b in range(256) if b not in _OWN]
_BYTES = {b: chr(b) for b in _OWN} | {b: chr(256 + k) for k, b in enumerate(_OTHER)}


_KEPT = "mnemolake_kept_encoder"


class Encoder(dict):
    """Ids of words with a blank before them, as bytes: a memory of words over a tokenizer.

    Byte-level BPE works piece by piece, so the ids of a text are those of its words in a row. Words come back far
    more often than they are new, and the memory saves those calls. It has two generations of at most ``words``
    words each: when the young one is full it becomes the old one, from which words that come back are taken over.
    """

    def __init__(self, vocabulary: str, words: int = 300_000, longest: int = 48):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(vocabulary))
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.words, self.longest, self.old = words, longest, {}

    def _whole(self, part: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([part], add_special_tokens=False)[0].ids).tobytes()

    def _new(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return array("I", [t.id for t in self.model.tokenize(_BYTES[32] + word)]).tobytes()
        plain = _PLAIN.fullmatch(word)
        if not plain:
            return self._whole(" " + word)
        letters, signs = plain.groups()
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(_BYTES)
        ids = [t.id for t in self.model.tokenize(_BYTES[32] + letters)]
        if signs:
            ids += [t.id for t in self.model.tokenize(signs)]
        return array("I", ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self._new(word)
        if len(word) <= self.longest:
            if len(self) >= self.words:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; added tokens that it spells out keep their own id."""
        if any(t in text for t in self.added):
            return self._whole(text)
        parts = _CUT.split(text) if _RUNS.search(text) else text.split(" ")
        return self._whole(parts[0]) + b"".join(map(self.__getitem__, parts[1:]))


def encoder(vocabulary: str, words: int, keep: bool = False) -> Encoder:
    """An encoder for the task, or with ``keep`` for all tasks of this Python worker, which then holds its words for good.

    The library travels by value, so that its own globals are new in every task; a kept encoder lies on a module that
    the worker knows by name. A worker keeps one encoder, that of the last vocabulary and size asked for.
    """
    if not keep:
        return Encoder(vocabulary, words)
    kept = sys.modules.setdefault(_KEPT, ModuleType(_KEPT))
    if getattr(kept, "made_for", None) != (vocabulary, words):
        kept.encoder, kept.made_for = Encoder(vocabulary, words), (vocabulary, words)
    return kept.encoder
