"""Token ids of whole texts by a tokenizer file, with the pieces between spaces kept in a table.

Both kinds of vocabulary split a text before the merges, and a piece never reaches over the start
of a run of spaces: in the byte-level pattern a space belongs to what follows, in the word-level
one it is dropped. So a text may be cut before each run of spaces, and a piece that came up
before need not be encoded again. A piece of letters is one word to the vocabulary's model, which
is then asked without the patterns, for all new words of a batch in one call.

As by the library's default, the names of special tokens in a text become their ids; with
``plain=True`` they are ordinary text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain
from struct import pack

import numpy as np
from tokenizers import Tokenizer

# Unicode White_Space, which is what the vocabularies' patterns call a space.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
IS_SPACE = re.compile(f"[{SPACES}]").match

# A word of Latin-1 letters after at most one space or line feed, and one closing mark.
WORD = re.compile("[ \\n]?([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,]?)")

# The table of pieces starts anew at this many; longer pieces are not kept.
MOST_KEPT = 1_000_000
LONGEST_KEPT = 64

# Characters of texts that are encoded together, and words that the model is asked about at a time.
BATCH_CHARACTERS = 1 << 20
WORDS_AT_ONCE = 20_000


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins of the byte-level alphabet: bytes without one follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, for one vocabulary file."""

    def __init__(self, path: str, plain: bool = False) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        added = self.tokenizer.get_added_tokens_decoder()
        self.names = [] if plain else [token.content for token in added.values()]
        self.model = self.tokenizer.model
        self.words = Tokenizer(self.model)
        # The word-level kind drops the space and lowers the letters.
        self.spaced = self._whole(" a") != self._whole("a")
        suffix = getattr(self.model, "end_of_word_suffix", None) or ""
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.letters = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for name, number in vocabulary.items():
            self.letters[number] = len(name.removesuffix(suffix) if suffix else name)
        self.known: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)

    def _model_ids(self, words: list[str]) -> Iterator[bytes]:
        """The ids of words in the model's letters; the lengths of the tokens say where a word ends."""
        for first in range(0, len(words), WORDS_AT_ONCE):
            some = words[first : first + WORDS_AT_ONCE]
            encoding = self.words.encode_batch_fast([some], is_pretokenized=True, add_special_tokens=False)[0]
            ids = np.array(encoding.ids, dtype="<u4")
            ends = np.cumsum(np.fromiter(map(len, some), dtype=np.int64, count=len(some)))
            upto = np.cumsum(self.letters[ids])
            last = np.searchsorted(upto, ends)
            if last[-1] + 1 != len(ids) or (upto[last] != ends).any():
                yield from (pack(f"<{len(t)}I", *t) for t in ([x.id for x in self.model.tokenize(w)] for w in some))
                continue
            content, begin = ids.tobytes(), 0
            for end in (4 * (last + 1)).tolist():
                yield content[begin:end]
                begin = end

    def _mark(self, mark: str) -> bytes:
        if mark and mark not in self.marks:
            self.marks[mark] = next(self._model_ids([mark]))
        return self.marks[mark] if mark else b""

    def ids(self, text: str) -> np.ndarray:
        """The ids of one text that is not worth keeping pieces of."""
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def learn(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """The ids of pieces (see PIECES), which are not kept here."""
        return self._learn_bytes(pieces) if self.spaced else self._learn_words(pieces)

    def _learn_bytes(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Byte-level pieces, many as one text: it is cut before each run of spaces as any text, and
        the bytes of the tokens say where a piece ends."""
        found: dict[str, bytes] = {}
        inner = []
        for piece in pieces:
            # The start of a text and the spaces at its end are whole texts to the patterns.
            if IS_SPACE(piece[0]) and not IS_SPACE(piece[-1]):
                inner.append(piece)
            else:
                found[piece] = self._whole(piece)
        for first in range(0, len(inner), WORDS_AT_ONCE):
            some = inner[first : first + WORDS_AT_ONCE]
            encoding = self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0]
            ids = np.array(encoding.ids, dtype="<u4")
            ends = np.cumsum(np.fromiter(map(len, map(str.encode, some)), dtype=np.int64, count=len(some)))
            upto = np.cumsum(self.letters[ids])
            last = np.searchsorted(upto, ends)
            if last[-1] + 1 != len(ids) or (upto[last] != ends).any():
                found.update((piece, self._whole(piece)) for piece in some)
                continue
            content, begin = ids.tobytes(), 0
            for piece, end in zip(some, (4 * (last + 1)).tolist(), strict=True):
                found[piece] = content[begin:end]
                begin = end
        return found

    def _learn_words(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Pieces of a vocabulary of lower-case words; the model is asked about those that are one."""
        found: dict[str, bytes] = {}
        names, words, marks = [], [], []
        for piece in pieces:
            word = WORD.fullmatch(piece)
            if word is None:
                found[piece] = self._whole(piece)
                continue
            letters, mark = word.groups()
            letters = letters.lower()
            if not letters.isascii():
                letters = letters.encode().decode("latin-1").translate(BYTE_LETTERS)
            names.append(piece)
            words.append(letters)
            marks.append(mark)
        for piece, ids, mark in zip(names, self._model_ids(words), marks, strict=True):
            found[piece] = ids + self._mark(mark)
        return found

    def encode_all(self, texts: Sequence[str], characters: int = BATCH_CHARACTERS) -> Iterator[bytes]:
        """The ids of each text; a batch is closed at so many characters, and larger ones repeat more of their pieces."""
        batch: list[str] = []
        size = 0
        for text in texts:
            batch.append(text)
            size += len(text)
            if size > characters:
                yield from self._encode_batch(batch)
                batch, size = [], 0
        yield from self._encode_batch(batch)

    def _encode_batch(self, texts: list[str]) -> Iterator[bytes]:
        named = [any(name in text for name in self.names) for text in texts]
        lists = [[] if whole else PIECES.findall(text) for text, whole in zip(texts, named, strict=True)]
        if len(self.known) > MOST_KEPT:
            self.known.clear()
        new = self.learn(set(chain.from_iterable(lists)).difference(self.known))
        known = self.known
        known.update(new)
        for text, whole, pieces in zip(texts, named, lists, strict=True):
            yield self._whole(text) if whole else b"".join(map(known.__getitem__, pieces))
        for piece in new:
            if len(piece) > LONGEST_KEPT:
                del known[piece]

    def encode(self, text: str) -> bytes:
        return next(self._encode_batch([text]))


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, plain: bool = False) -> Encoder:
    """The worker's encoder for a file; it lives as long as the worker does."""
    if (path, plain) not in _ENCODERS:
        _ENCODERS[path, plain] = Encoder(path, plain)
    return _ENCODERS[path, plain]
