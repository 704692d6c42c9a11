"""Token ids of whole texts with remembered ids for every piece between blanks.

Both public vocabularies cut a text at white space before anything else: what stands between two blanks,
with the first of them, gives the same ids alone as inside its text. They also cut between a Latin letter
and the punctuation after it. A worker therefore asks the library once for each distinct piece. Texts in
which other white space meets a blank, or that hold unusual white space, long line breaks or the string
of a special token, or that end in two line breaks, are encoded whole by the library. Ids equal the library's for every text.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from functools import cached_property

import numpy as np

END_ID = 2
#: Pieces a worker remembers before it forgets all of them; bounds its memory, not its results.
MOST_PIECES = 500_000
LONGEST_PIECE = 64
#: Marks of pieces met once, by hash: only what comes again is remembered.
MARKS = 1 << 21
_END = array("I", [END_ID]).tobytes()

_WORD = re.compile(r"( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:|)*&$#%\-]*)")
#: Unusual white space; the line break and the blank are judged by what stands beside them.
_RARE = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
_ODD = ["  ", " \n", "\n ", "\n\n\n"]


def _key(piece: str) -> str:
    """A piece without its blank; one that has none is led by a line break instead."""
    return piece[1:] if piece[:1] == " " else "\n" + piece


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self._tokenizer.to_str())
        self._folds_case = '"Lowercase"' in json.dumps(rules["normalizer"])
        self._odd = [*_ODD, *(t["content"] for t in rules["added_tokens"] if t["content"])]
        letters = [chr(c) for c in range(0x21, 0x100) if _WORD.fullmatch("a" + chr(c)) or _WORD.fullmatch(chr(c))]
        cut = self._tokenizer.pre_tokenizer.pre_tokenize_str
        self._bytes = str.maketrans({c: cut(c)[0][0] for c in letters} | {" ": "".join(x for x, _ in cut(" "))})
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, bytes] = {}
        self._tails: dict[str, bytes] = {}
        self._met = bytearray(MARKS)

    def _remember(self, key: str, ids: bytes) -> None:
        mark = hash(key) & (MARKS - 1)
        if self._met[mark]:
            self._known[key] = ids
        else:
            self._met[mark] = 1

    def _whole(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _spelt(self, letters: str) -> bytes:
        """Ids of letters (with a blank before) or of punctuation: one piece of the library's own cut."""
        return array("I", [t.id for t in self._tokenizer.model.tokenize(letters.translate(self._bytes))]).tobytes()

    def _piece(self, piece: str) -> bytes:
        """piece: what stands between two blanks, led by its blank."""
        match = _WORD.fullmatch(piece)
        if match is None:
            found = self._whole(piece)
        else:
            blank, word, tail = match.groups()
            word = word.lower() if self._folds_case else blank + word
            # The word may be known as a piece of its own.
            found = self._known.get(word if self._folds_case else _key(word)) or self._spelt(word)
            if tail:
                after = self._tails.get(tail)
                if after is None:
                    after = self._spelt(tail)
                    if len(tail) <= LONGEST_PIECE:
                        self._tails[tail] = after
                found += after
        if len(piece) <= LONGEST_PIECE:
            self._remember(_key(piece), found)
        return found

    def _is_odd(self, text: str) -> bool:
        return text[:1] == " " or text.endswith((" ", "\n\n")) or any(x in text for x in self._odd) or _RARE.search(text) is not None

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text, its end id last, as unsigned 32-bit integers."""
        if self._is_odd(text):
            return np.frombuffer(self._whole(text) + _END, "<u4")
        if len(self._known) + len(self._tails) > MOST_PIECES:
            self._forget()
        get, out = self._known.get, []
        for n, line in enumerate(text.split("\n")):
            if n:
                out.append(self._line_break)
            if not line:
                continue
            pieces = line.split(" ")
            found = list(map(get, pieces))
            # The first piece has no blank; its key has a line break instead.
            found[0] = get("\n" + pieces[0])
            if None in found:
                for i, ids in enumerate(found):
                    if ids is None:
                        found[i] = self._piece(" " + pieces[i] if i else pieces[i])
            out += found
        out.append(_END)
        return np.frombuffer(b"".join(out), "<u4")

    @cached_property
    def _line_break(self) -> bytes:
        return self._whole("\n")


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes())
