"""Public tokenizer files, and encoders that remember the words they have seen.

A text is cut at white space that every pre-tokenizer here also cuts at, so the ids of a text are those of its chunks
in a row. Each Python worker remembers chunks; a chunk not seen yet that is a plain word with marks after it is
put together from its word, which goes to the merge model without the steps before it, and its marks. Memories are
bounded, which changes speed alone. Texts with white space other than blanks and line feeds, or with a special token's
opening, go to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable
from functools import cache

REMEMBERED = 800_000

#: White space or control characters on whose class regular expression engines might differ.
_ODD_SPACE = re.compile(
    r"[\x00-\x09\x0b-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
#: A word of Latin letters without combining marks, then ASCII marks but no apostrophe or angle bracket.
_WORD_MARKS = re.compile(r"([\n ]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\[-`{-~]*)")


def path(name: str) -> str:
    """Where the public tokenizer file ``name`` lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def tokenizer(file: str):
    """The tokenizer of a JSON file, one per Python worker; encoding stays within the task's core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(file)
    found.no_truncation()
    found.no_padding()
    return found


def _byte_signs() -> list[str]:
    """The printable sign that byte-level vocabularies write for each byte, by rule: printable Latin-1 bytes stand for
    themselves, the others are numbered from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


_SIGNS = _byte_signs()


def _signs(text: str) -> str:
    return text if text.isascii() and text.isalpha() else "".join([_SIGNS[b] for b in text.encode()])


class _Memory(dict):
    """Chunk -> value; a missing chunk is worked out and kept. When full, the older half of what was kept goes."""

    def __init__(self, direct: Callable, word: Callable, plus: Callable):
        super().__init__()
        self.direct, self.word, self.plus = direct, word, plus
        self.older, self.words, self.older_words, self.marks = {}, {}, {}, {}

    def _word(self, head: str, word: str):
        key = head + word
        value = self.words.get(key)
        if value is None:
            value = self.older_words.get(key)
            if value is None:
                value = self.word(head, word)
            if len(self.words) >= REMEMBERED // 2:
                self.older_words, self.words = self.words, {}
            self.words[key] = value
        return value

    def _mark(self, marks: str):
        value = self.marks.get(marks)
        if value is None:
            value = self.direct(marks)
            if len(self.marks) < REMEMBERED // 10:
                self.marks[marks] = value
        return value

    def __missing__(self, chunk: str):
        value = self.older.get(chunk)
        if value is None:
            match = _WORD_MARKS.fullmatch(chunk)
            if match is None:
                value = self.direct(chunk)
            elif match[3]:
                value = self.plus(self._word(match[1], match[2]), self._mark(match[3]))
            else:
                value = self._word(match[1], match[2])
        if len(self) >= REMEMBERED // 2:
            self.older = dict(self)
            self.clear()
        if len(chunk) <= 64:
            self[chunk] = value
        return value


@cache
def ids_encoder(file: str) -> Callable[[str], bytes]:
    """Text -> its ids as little-endian unsigned 32-bit numbers, for a vocabulary in lower case that drops white space."""
    whole = tokenizer(file)
    encode, piece = whole.encode, whole.model.tokenize

    def direct(text: str) -> bytes:
        ids = encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(head: str, letters: str) -> bytes:
        ids = [t.id for t in piece(_signs(letters.lower()))]
        return struct.pack(f"<{len(ids)}I", *ids)

    memory = _Memory(direct, word, lambda a, b: a + b)

    def ids(text: str) -> bytes:
        if "<|" in text or _ODD_SPACE.search(text):
            return direct(text)
        return b"".join(map(memory.__getitem__, text.split()))

    return ids


_CHUNKS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")


@cache
def count_encoder(file: str) -> Callable[[str], int]:
    """Text -> its number of ids, for a byte-level vocabulary that keeps white space before words."""
    whole = tokenizer(file)
    encode, piece = whole.encode, whole.model.tokenize

    def direct(text: str) -> int:
        return len(encode(text, add_special_tokens=False).ids)

    def word(head: str, letters: str) -> int:
        if head == "\n":  # a line feed before a word is a piece of its own
            return len(piece(_SIGNS[10])) + len(piece(_signs(letters)))
        return len(piece((_SIGNS[32] if head else "") + _signs(letters)))

    memory = _Memory(direct, word, lambda a, b: a + b)

    def count(text: str) -> int:
        if "<|" in text or _ODD_SPACE.search(text):
            return direct(text)
        return sum(map(memory.__getitem__, _CHUNKS.findall(text)))

    return count
