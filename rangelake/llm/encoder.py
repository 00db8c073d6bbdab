"""Ids of whole texts by a public tokenizer, with a bounded cache of words.

Both vocabularies encode word by word: a cut in front of a space between two characters that aren't white space never
changes an id. So a text is cut there, words that were met before come from the cache, and the tokenizers library
encodes the others. Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterable
from functools import cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words that a cache holds before it is cut down to those of the last texts.
WORDS = 1_000_000
#: Bytes of text to encode at once: the more, the fewer words are looked up.
AT_ONCE = 8 << 20
#: End of a document.
END = np.zeros(1, dtype="<u4").tobytes()

_DOUBLE_SPACE = re.compile(r"\s\s")
_WORD_EDGE = re.compile(r"(?<=\S) (?=\S)")
_PLAIN = re.compile(r"[^\s\x01]+").fullmatch
#: Letters and one mark behind them, which both vocabularies always part, and whose ids don't depend on each other.
_LETTERS = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+"
_LETTERS_ONLY = re.compile(_LETTERS).fullmatch
#: How the vocabularies' model takes a word of letters alone behind a space: what stands before it, and whether in lower case.
_FORMS = (("\u0120", False), ("", True))
#: What may stand between words that are encoded as one text: white space that stays a token, or a character of its own.
_BETWEEN = ("\n", " \x01")


def _byte_letters() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes as: printable ones as they are, others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()


class _Numbers(dict):
    """Numbers words in order; ``new`` are those numbered since it was emptied."""

    def __init__(self, *args) -> None:
        super().__init__(*args)
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = n = len(self)
        return n


class Encoder:
    def __init__(self, path: str, most: int = WORDS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.most = most
        self.number = _Numbers()
        self.ids: list[bytes] = []
        self.marks = {m: np.array(self._ids(m), dtype="<u4").tobytes() for m in ".,;:!?"}
        self.form = next((f for f in _FORMS if all(self._model([w], f)[0] == self._library([f" {w}"])[0] for w in ("Hello", "t\u00e9l\u00e9", "a", "Stra\u00dfe"))), None)
        self.between, self.mark = None, -1
        word, other = self._ids(" a"), self._ids(" b")
        for between in _BETWEEN:
            ids = self._ids(f" a{between} b")
            if len(ids) == len(word) + len(other) + 1 and ids[: len(word)] == word and ids[len(word) + 1 :] == other:
                self.between, self.mark = between, ids[len(word)]
                break

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _model(self, words: list[str], form: tuple[str, bool]) -> list[bytes]:
        """Words of letters alone, straight through the tokenizer's model: they are one piece."""
        before, lower = form
        tokenize = self.tokenizer.model.tokenize
        ids: list[int] = []
        ends = []
        for w in words:
            raw = w.lower() if lower else w
            if not raw.isascii():  # ASCII letters stand for themselves
                raw = raw.encode().decode("latin-1").translate(_BYTE_LETTERS)
            ids += [t.id for t in tokenize(before + raw)]
            ends.append(4 * len(ids))
        flat = np.array(ids, dtype="<u4").tobytes()
        return [flat[a:z] for a, z in zip([0, *ends], ends, strict=False)]

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Each word's ids behind a space. Other plain words are joined, some a text, and told apart by the mark between."""
        letters = [w for w in words if _LETTERS_ONLY(w)] if self.form else []
        out: dict[str, bytes] = dict(zip(letters, self._model(letters, self.form), strict=True)) if letters else {}
        plain = [w for w in words if w not in out and _PLAIN(w)] if self.between else []
        for lo in range(0, len(plain), 64):
            own = plain[lo : lo + 64]
            ids = np.array(self.tokenizer.encode_batch_fast([self.between.join([f" {w}" for w in own])], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
            if len(ends) == len(own):  # else a word has the mark inside
                raw, begin = ids.tobytes(), 0
                for word, end in zip(own, (4 * ends).tolist(), strict=True):
                    out[word] = raw[begin:end]
                    begin = end + 4
        rest = [w for w in words if w not in out]
        out.update(zip(rest, self._library([f" {w}" for w in rest]), strict=True))
        return out

    def _learn(self) -> None:
        """Ids of the words that were numbered since the last time."""
        new = self.number.new
        if not new:
            return
        self.number.new = []
        collects = gc.isenabled()
        gc.disable()  # nothing here is part of a cycle, and looking for some in all that is held takes a seventh of the time
        try:
            marked = {w: w[:-1] for w in new if w[-1:] in self.marks and _LETTERS_ONLY(w[:-1])}
            stems = set(marked.values())
            known = {w: self.ids[n] for w in stems if (n := self.number.get(w, len(self.ids))) < len(self.ids)}
            fresh = stems.union(w for w in new if w not in marked).difference(known)
            known.update(self._words(list(fresh)))
            self.ids += [known[marked[w]] + self.marks[w[-1]] if w in marked else known[w] for w in new]
        finally:
            if collects:
                gc.enable()

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Each word's ids, behind a space."""
        numbers = list(map(self.number.__getitem__, words))
        self._learn()
        out = list(map(self.ids.__getitem__, numbers))
        self._forget(words)
        return out

    def encode_words(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of the words of each text, each behind a space; little-endian unsigned 32-bit integers."""
        numbers = [list(map(self.number.__getitem__, words)) for words in texts]
        self._learn()
        ids = self.ids.__getitem__
        out = [b"".join(map(ids, n)) for n in numbers]
        self._forget(w for words in texts for w in words)
        return out

    def _forget(self, last: Iterable[str]) -> None:
        """Cuts a full cache down to the last words."""
        if len(self.ids) > self.most:
            kept = {w: self.ids[self.number[w]] for w in set(last)}
            self.number, self.ids = _Numbers((w, i) for i, w in enumerate(kept)), list(kept.values())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        cut = [_WORD_EDGE.split(t) if _DOUBLE_SPACE.search(t) else t.split(" ") for t in texts]
        firsts = self._library([words[0] for words in cut])
        for words in cut:
            del words[0]
        return [first + rest for first, rest in zip(firsts, self.encode_words(cut), strict=True)]


@cache
def encoder(name: str, most: int = WORDS) -> Encoder:
    """The encoder of a vocabulary file: a path, or a name in the public_tokenizers package. One for each process."""
    if "/" not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Encoder(name, most)
