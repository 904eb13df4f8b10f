"""Token ids of whole texts from a `tokenizers` file, computed once per distinct space-separated word.

The vocabulary file's pre-tokenizer never lets a token span white space, so the ids of a text are the ids of its words
one after the other. Each worker keeps the ids of the words it has seen (two bounded generations: when the young one is
full it becomes the old one) and asks the library only for new words. Texts for which that does not hold word by word go to the library whole: those
with a special-token marker, which the library cuts out before it looks at words.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

#: Words kept per worker and generation: bounds its memory, has no effect on results.
MAX_WORDS = 800_000
#: Punctuation that may end a word.
ENDS = b".,;:!?%$&*#)"
#: Words that normalization only lower-cases and the pre-tokenizer keeps whole.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_ENCODERS: dict[str, "WordEncoder"] = {}


class WordEncoder(dict):
    """word (bytes, UTF-8) -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        super().__init__()
        self.old: dict[bytes, bytes] = {}
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]

        # The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for characters from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.byte_chars = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}

    def library(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def merged(self, letters: str) -> bytes:
        """Ids of one pre-token, in lower case and the byte-level alphabet, straight from the library's model."""
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= MAX_WORDS:
            self.old = dict(self)
            self.clear()
        if word in self.old:
            ids = self[word] = self.old[word]
            return ids
        head = word.rstrip(ENDS)
        if len(head) < len(word) and head[-1:].isalpha():      # letters and punctuation never share a token
            ids = self[head] + self[word[len(head):]]
        elif word.isalpha():                                  # ASCII letters: one pre-token
            ids = self.merged(word.lower().decode())
        elif LETTERS.fullmatch(text := word.decode("utf-8", "replace")):
            ids = self.merged(text.lower().encode().decode("latin-1").translate(self.byte_chars))
        else:
            ids = self.library(text)
        self[word] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """Ids of a whole text, exactly the library's. Lower-casing ASCII first only merges words that the vocabulary
        treats alike; it is left out where combining marks (U+03xx, first byte 0xCC) could compose differently."""
        low = text.lower()
        if b"<" in text and any(s.lower() in low for s in self.specials):
            return self.library(text.decode("utf-8", "replace"))
        if b"\xcc" not in text:
            text = low
        return b"".join(map(self.__getitem__, text.replace(b"\n", b" ").split(b" ")))


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def binary_column(batch, name: str):
    """Texts of an Arrow column as bytes, without making Python strings."""
    import pyarrow as pa
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def as_ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<u4")
