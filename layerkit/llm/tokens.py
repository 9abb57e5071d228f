"""Token ids of whole texts inside tasks, with the ids of repeated pieces looked up.

Both tokenizers split a text into pieces (words with the space before them, digits, runs of
punctuation, contractions) before they merge anything, so the ids of a text are the ids of its
pieces one after the other. ``TextEncoder`` finds the pieces of a text by one pattern over
characters whose class is plain (letters up to Latin Extended-A, digits, common punctuation,
single spaces and line ends) and keeps the ids of those it has met, as little-endian unsigned
32-bit bytes; only pieces not met before reach the tokenizer. A text with anything else in it
(other scripts, other white space, two spaces in a row) is cut at single spaces between
non-space characters, where a piece always ends, and each part that is not plain is given to
the tokenizer as it stands.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterator

import numpy as np

_LETTERS = "A-Za-zÀ-ÖØ-öø-\u017f"
_MARKS = "!-/:-@\\[-`{-~¡-©«¬®-±´¶-¸»¿×÷\u2010-\u2027\u2030-\u205e"
_PARTS_OF_WORDS = "'(?:[stmd]|re|ve|ll)"
# byte level: a space belongs to what follows it; a run of line ends is one match, plain only if single
_SPACED = rf"{_PARTS_OF_WORDS}| ?[{_LETTERS}]+| ?[0-9]+| ?[{_MARKS}]+|\n"
# word level: white space is dropped, each digit is a piece
_BARE = rf"{_PARTS_OF_WORDS}|[{_LETTERS}]+|[0-9]|[{_MARKS}]+"
_OTHER_SPACE = [chr(i) for i in range(0x3001) if chr(i).isspace() and chr(i) != " "]
_CUT = re.compile(r"(?<=\S) (?=\S)")
_JOINED = 64  # pieces given to the tokenizer in one string


def _odd_space(text: str) -> bool:
    """Whether a space of the text is at its end or beside another white space."""
    if text[0] == " " or text[-1] == " " or "  " in text:
        return True
    return any(w in text and (w + " " in text or " " + w in text) for w in _OTHER_SPACE)


class TextEncoder:
    """Ids of texts under one tokenizer file, without special tokens.

    ``keep``: after so many pieces (and so many odd parts) the memory turns over: the older half
    is forgotten but for what is met again. So it stays bounded on any vocabulary.
    """

    def __init__(self, path: str, keep: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.keep = keep
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.by_spaces = "Ġthe" in vocab  # byte level: the space belongs to the word after it
        plain = _SPACED if self.by_spaces else _BARE
        self.is_plain = re.compile(plain).fullmatch
        # what is not plain is found as well, as a piece whose ids are never kept
        self.find = re.compile(rf"\n\n+|{plain}|(?s:.)" if self.by_spaces else rf"{plain}|[^ \n\t\r]").findall
        top = max(vocab.values()) + 1
        self.first_of_run = np.zeros(top, bool)
        for token, i in vocab.items():
            self.first_of_run[i] = token.startswith("Ġ") if self.by_spaces else token.endswith("</w>")
        self.line_end = vocab.get("Ċ")
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.older_parts: dict[str, bytes] = {}

    # -- whole texts ---------------------------------------------------------------------
    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text (null: none) as little-endian unsigned 32-bit bytes."""
        gc.disable()  # many small objects, no cycles: collecting would take most of the time
        try:
            found = [self._pieces(t) if t else [] for t in texts]
            self._learn(set().union(*found))
            get = self.pieces.__getitem__
            out, odd = [], []
            for i, pieces in enumerate(found):
                try:
                    out.append(b"".join(map(get, pieces)))
                except KeyError:
                    out.append(b"")
                    odd.append(i)
            for i, ids in zip(odd, self._by_parts([texts[i] for i in odd])):
                out[i] = ids
            return out
        finally:
            gc.enable()

    def _pieces(self, text: str) -> list[str]:
        return self.find(text if self.by_spaces else text.lower())

    # -- texts with odd characters -------------------------------------------------------
    def _by_parts(self, texts: list[str]) -> list[bytes]:
        """Ids of texts whose plain pieces are known, part by part."""
        if not texts:
            return []
        cut = [self._cut(t) for t in texts]
        if len(self.parts) > self.keep:
            self.older_parts, self.parts = self.parts, {}
        odd = []
        for part in self._recall(set().union(*cut), self.parts, self.older_parts):
            try:
                self.parts[part] = b"".join(map(self.pieces.__getitem__, self._pieces(self._text_of(part))))
            except KeyError:
                odd.append(part)
        for part, ids in zip(odd, self._library([self._text_of(p) for p in odd])):
            self.parts[part] = ids
        return [b"".join(map(self.parts.__getitem__, parts)) for parts in cut]

    def _cut(self, text: str) -> list[str]:
        if not self.by_spaces:
            return text.replace("\n", " ").split(" ")
        parts = _CUT.split(text) if _odd_space(text) else text.split(" ")
        # the first part has no space before it: its key starts with one character no other key starts with
        parts[0] = " " + parts[0]
        return parts

    def _text_of(self, part: str) -> str:
        """What a part stands for: byte-level parts but the first have a space before them."""
        if not self.by_spaces:
            return part
        return part[1:] if part[:1] == " " else " " + part

    def _library(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        encoded = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in encoded]

    # -- pieces --------------------------------------------------------------------------
    @staticmethod
    def _recall(wanted: set[str], now: dict[str, bytes], older: dict[str, bytes]) -> list[str]:
        """Take what the older half knows into ``now``; returns what neither knows."""
        new = []
        for p in wanted.difference(now):
            ids = older.get(p)
            if ids is None:
                new.append(p)
            else:
                now[p] = ids
        return new

    def _learn(self, pieces: set[str]) -> None:
        """Remember the ids of the plain ones of ``pieces``."""
        if len(self.pieces) > self.keep:  # between two calls of encode, so nothing in use is lost
            self.older_pieces, self.pieces = self.pieces, {}
        new = [p for p in self._recall(pieces, self.pieces, self.older_pieces) if self.is_plain(p)]
        if not self.by_spaces:
            self._learn_joined(new, " ")
            return
        self._learn_joined([p for p in new if p[0] == " "], "")
        self._learn_joined([p for p in new if p[0] not in " \n"], "\n")
        if "\n" in pieces:
            self.pieces["\n"] = np.asarray([self.line_end], "<u4").tobytes()

    def _learn_joined(self, new: list[str], between: str) -> None:
        """Encode pieces many to a string, and cut its ids where a piece starts or ends."""
        groups = [new[i:i + _JOINED] for i in range(0, len(new), _JOINED)]
        strings = [between.join(g) for g in groups]
        for group, e in zip(groups, self.tok.encode_batch_fast(strings, add_special_tokens=False) if new else []):
            ids = np.asarray(e.ids, "<u4")
            if between == "\n":  # a line end between two pieces
                marks = np.flatnonzero(ids == self.line_end)
                starts, ends = np.append(0, marks + 1), np.append(marks, len(ids))
            elif self.by_spaces:  # the first id of a piece starts with its space
                starts = np.flatnonzero(self.first_of_run[ids])
                ends = np.append(starts[1:], len(ids))
            else:  # the last id of a piece ends a word
                ends = np.flatnonzero(self.first_of_run[ids]) + 1
                starts = np.append(0, ends[:-1])
            if len(starts) == len(group):
                raw = ids.tobytes()
                for p, a, b in zip(group, (4 * starts).tolist(), (4 * ends).tolist()):
                    self.pieces[p] = raw[a:b]
            else:  # a piece of an unexpected shape: one by one
                self.pieces.update(zip(group, self._library(group)))


def public_tokenizer(name: str) -> str:
    """Path of an installed public tokenizer file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The encoder of this Python worker; workers are reused, so its memory serves many tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def encoded_slices(path: str, texts, most_chars: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Encode an Arrow string column in slices of about ``most_chars``; yields (first row, ids)."""
    enc = encoder(path)
    start, held, chars = 0, [], 0
    for i in range(len(texts)):
        t = texts[i].as_py()
        held.append(t)
        chars += len(t or "")
        if chars >= most_chars:
            yield start, enc.encode(held)
            start, held, chars = i + 1, [], 0
    if held:
        yield start, enc.encode(held)
