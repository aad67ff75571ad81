"""Token ids of whole texts by the tokenizers library, with a bounded cache of
white-space separated chunks (a chunk's ids do not depend on its neighbours)."""

from __future__ import annotations

import os
import re
from array import array

from eventlake.llm.common import only_cache

_CONTROL = re.compile(r"[\x00-\x02]")
_BLANK = re.compile(r"(?<=\S) (?=\S)")
_ODD_SPACE = re.compile(r"[^\S \n]")
#: Marks of a chunk at the start of the text and of a chunk after a newline.
_FIRST, _LINE = "\x01", "\x02"
_ENCODERS: dict[tuple, ChunkEncoder] = {}


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes printable bytes as themselves and the rest, in order, from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTERS = _byte_letters()


def _pack(ids) -> bytes:
    return array("I", ids).tobytes()


class ChunkEncoder(dict):
    """Ids of texts as little-endian uint32 bytes; the dict holds chunk -> ids.

    `keep_space`: the tokenizer gives white space to tokens (byte-level BPE: a
    blank belongs to the word after it and a lone newline is a piece of its
    own); otherwise white space is dropped and letters are lower-cased.  A text
    is cut only where the tokenizer's own pre-tokenizer must cut, so the ids are
    those of the whole text.  A chunk of letters is one piece and goes to the
    library's BPE model directly; any other goes through the whole tokenizer, and
    so does a text that holds one of the tokenizer's added tokens (such as <|endoftext|>).
    The cache only saves repeated work; it holds at most twice `limit` entries
    (chunks met since the last turn-over, and those of the turn before it).
    """

    def __init__(self, path: str, keep_space: bool, limit: int = 400_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # the library finds these in a text before it cuts words (some in its lower-case form)
        added = {t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = re.compile("|".join(map(re.escape, sorted(added)))) if added else None
        self.keep_space, self.limit = keep_space, limit
        self.newline = self.whole("\n") if keep_space else b""
        self.marks: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return _pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        """One piece of letters, with the blank before it where that counts."""
        word = word.replace(" ", "\u0120") if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS)
        return _pack([t.id for t in self.model.tokenize(word)])

    def _piece(self, chunk: str) -> bytes:
        blank = chunk[:1] == " "
        body = chunk[blank:]
        word = body if body.isalpha() else body[:-1]
        tail = body[len(word):]
        if not word.isalpha() or tail and tail not in ".,;:!?":
            return self.whole(chunk)
        if not self.keep_space:
            low = word.lower()
            if not word.isascii() and (len(low) != len(word) or not low.isalpha() or max(low) > "ɏ"):
                return self.whole(chunk)
            word = low
        if tail and tail not in self.marks:
            self.marks[tail] = self.whole(tail)
        return self._word(" " * blank + word) + (self.marks[tail] if tail else b"")

    def __missing__(self, chunk: str) -> bytes:
        if (got := self.before.get(chunk)) is not None:
            self[chunk] = got
            return got
        if chunk[:1] == _FIRST:
            got = self._piece(chunk[1:])
        elif chunk[:1] == _LINE:
            got = self.newline + self._piece(chunk[1:])
        else:
            got = self._piece(" " + chunk) if self.keep_space else self._piece(chunk) if chunk else b""
        if len(chunk) <= 64:
            self[chunk] = got
        return got

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(self) > self.limit:
            self.before = dict(self)
            self.clear()
        if self.added and self.added.search(text.lower()):
            return self.whole(text)
        if not self.keep_space:
            if "\x01" in text or "\x02" in text:
                return self.whole(text)
            return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))
        # white space only as single blanks or newlines inside the text: every cut is certain
        if not _ODD_SPACE.search(text) and not _CONTROL.search(text):
            parts = (_FIRST + text.replace("\n", " " + _LINE)).split(" ")
            if not {"", _FIRST, _LINE} & set(parts):
                return b"".join(map(self.__getitem__, parts))
        return b"".join(map(self.whole, self._cut(text)))

    @staticmethod
    def _cut(text: str) -> list[str]:
        """Long pieces of a text with unusual white space, cut at certain places."""
        parts, out, size = _BLANK.split(text), [], 0
        for k, p in enumerate(parts):
            p = " " + p if k else p
            if out and size + len(p) < 4000:
                out[-1].append(p)
                size += len(p)
            else:
                out.append([p])
                size = len(p)
        return ["".join(x) for x in out]


def encoder(path: str, keep_space: bool) -> ChunkEncoder:
    """One encoder for each worker process and vocabulary file."""
    only_cache("tokens", _ENCODERS.clear)
    key = (path, keep_space)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, keep_space)
    return _ENCODERS[key]
