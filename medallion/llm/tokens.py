"""Token ids of whole texts by a public tokenizer, word by word where that gives the same ids."""

from __future__ import annotations

import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from medallion.llm.common import kept

TOKENIZER = "word_bpe_49k.json"
# Words of a generation that a process keeps with their ids (about 200 bytes each), beside those of the one before.
KEPT_WORDS = 600_000

# ASCII punctuation behind letters is a word of its own for this tokenizer, unless it begins with an apostrophe.
_TAIL = re.compile(r"[.,!?;:#$%&*|()\"\-]+$")
# Characters that str.split takes for white space and the tokenizer does not, and the start of a special token.
_ODD = re.compile("[\x1c-\x1f]|<\\|")
# Letters below this are the same in all versions of Unicode that matter.
_SETTLED = "\u0530"


def byte_letters() -> dict[int, str]:
    """The printable stand-ins of bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(others)}


class WordIds(dict):
    """Ids of words, learned as they come, and of texts, as ``encode(text, add_special_tokens=False)`` gives them.

    The tokenizer normalises and cuts at white space before anything else, so a text's ids are those of its words
    in turn.  A word of letters goes to the tokenizer's model at once; other words go through the whole tokenizer,
    and so do texts with special tokens or odd separators.
    """

    def __init__(self, name: str = TOKENIZER):
        super().__init__()
        self.before: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.model = self.tokenizer.model
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.code = "H" if self.dtype is np.uint16 else "I"
        self.stand_ins = byte_letters()
        self.direct = name == TOKENIZER

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None and self.direct:
            if word.isalpha():
                plain = (word if word.isascii() else unicodedata.normalize("NFC", word)).lower()
                if word.isascii() or (plain.isalpha() and "\u03a3" not in word and max(plain) < _SETTLED):
                    letters = plain if word.isascii() else plain.encode().decode("latin-1").translate(self.stand_ins)
                    ids = array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()
            elif (tail := _TAIL.search(word)) and (core := word[:tail.start()]).isalpha():
                ids = self[core] + self[tail[0]]
        if ids is None:
            ids = self.whole(word)
        self[word] = ids
        return ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Little-endian ids of a text, two bytes each (four, if the vocabulary needs it)."""
        if not text:
            return b""
        if not self.direct or _ODD.search(text):
            return self.whole(text)
        if len(self) > KEPT_WORDS:  # words still in use come over from the last generation
            self.before = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, text.split()))


@kept
@lru_cache(2)
def word_ids(name: str = TOKENIZER) -> WordIds:
    """The process's own, so that words learned by one task serve the next of its kind."""
    return WordIds(name)


def encoded(column, name: str = TOKENIZER):
    """Arrays of ids of a text column, one text after another."""
    held = word_ids(name)
    for text in column:
        yield np.frombuffer(held.encode(text.as_py()), held.dtype)
