"""Exact memoised encoding on top of the tokenizers library.

A tokenizer file of the library is run in two levels. A text is cut at white
space where the file's own pre-tokenizer always cuts; each cut-out word is
looked up in a bounded memo. A word not seen yet goes through the
pre-tokenizer, and each of its parts through the library's merge model, once.
A word of letters is one part by itself; as a part of other words it is looked
up among the words, so it is held once.
Texts whose cuts aren't certain (runs of white space, special tokens) take the
library's whole-text path, so ids always equal encode(...).ids.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from sys import getsizeof

#: Unicode White_Space, as the regular expressions of the tokenizer files see \s.
SPACE = "\t-\r \x85\xa0  -     　"
#: Below this code point no character combines or is renamed by NFC, and categories are settled.
_LATIN_END = "\u0250"


def _latin(kind: str, lower: bool = False) -> str:
    """The characters of a category below _LATIN_END, as the inside of a character class."""
    found = (chr(c) for c in range(ord(_LATIN_END)) if unicodedata.category(chr(c))[0] == kind)
    return "".join(c for c in found if not (lower and c.isascii() and c.isupper()))


_L, _N, _LOW = _latin("L"), _latin("N"), _latin("L", lower=True)
#: The patterns of the two pre-tokenizers over Latin text; wider words take the library's.
_BYTE_LATIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{SPACE}{_L}{_N}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
_WORD_LATIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LOW}]+|[{_N}]|[^{SPACE}{_LOW}{_N}]+")
SPACE_SET = frozenset(chr(c) for c in range(0x3001) if re.match(f"[{SPACE}]", chr(c)))
_ODD_SPACES = "".join(sorted(SPACE_SET - {" ", "\n"}))
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: A space between two characters that aren't white space: both kinds of file always cut there.
SAFE_CUT = re.compile(rf"(?<=[^{SPACE}]) (?=[^{SPACE}])")
#: Longer texts are encoded slice by slice.
SLICE = 1 << 20
#: The memo of parts gets this share of the bytes of the words' memo: it holds no words of letters.
PARTS_SHARE = 8


class Memo(dict):
    """A dict of bounded bytes: two generations, the older one dropped when the newer is full.

    Keys of over `longest` characters are worked out each time and not kept:
    long words hardly come again. weigh gives the bytes of a value; without it
    an entry counts as a word and its ids, by the word's length.
    """

    def __init__(self, make, budget: int = 48 << 20, longest: int = 256, weigh=None):
        super().__init__()
        self.make, self.budget, self.longest, self.weigh, self.old, self.held = make, budget, longest, weigh, {}, 0

    def __missing__(self, key):
        n = len(key)
        if n > self.longest:
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        held = self.held + (150 + 5 * n if self.weigh is None else 100 + getsizeof(key) + self.weigh(value))
        if held > self.budget:
            self.old, held = dict(self), 0
            self.clear()
        self[key] = value
        self.held = held
        return value


def byte_alphabet() -> dict[int, str]:
    """The visible character that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in table)
    return table | {b: chr(256 + i) for i, b in enumerate(hidden)}


class LibraryEncoder:
    """encode(text) gives the ids of a tokenizers file as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, budget: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        spec = json.loads(open(path, encoding="utf-8").read())
        self.special = [t["content"] for t in spec["added_tokens"]]
        kind = json.dumps([spec["normalizer"], spec["pre_tokenizer"]])
        self.table = byte_alphabet()
        self.parts = Memo(self._part, budget // PARTS_SHARE)
        if spec["normalizer"] is None and '"ByteLevel", "add_prefix_space": false' in kind and '"use_regex": true' in kind:
            self.encode_slice = self._encode_spaced
            self.words = Memo(self._later_word, budget)
        elif '"Lowercase"' in kind and '"NFC"' in kind and '"Removed"' in kind:
            self.encode_slice = self._encode_split
            self.words = Memo(self._lower_word, budget)
        else:
            self.encode_slice = None

    def encode(self, text: str) -> bytes:
        """Ids of a text of any length; a long one is cut where every file cuts, if it has such a place."""
        if self.encode_slice is None:
            return self.encode_whole(text)
        if len(text) <= SLICE:
            return self.encode_slice(text)
        out, start = [], 0
        while start < len(text):
            cut = SAFE_CUT.search(text, start + SLICE)
            end = cut.start() if cut else len(text)
            out.append(self.encode_slice(text[start:end]))
            start = end
        return b"".join(out)

    def encode_whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        if part.isascii() and part.isprintable():
            return self._ids(part.replace(" ", "Ġ"))
        return self._ids(part.encode().decode("latin-1").translate(self.table))

    def _ids(self, mapped: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a piece of text that starts and ends where the pre-tokenizer cuts."""
        if word.isascii() or max(word) < _LATIN_END:
            return b"".join([self.words[p[1:]] if p[0] == " " and p[1:].isalpha() else self.parts[p] for p in _BYTE_LATIN.findall(word)])
        return b"".join(self._ids(x) for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(word))

    def _later_word(self, word: str) -> bytes:
        """A word after a space, which is its pre-token's, or with the line end before it."""
        if word.isalpha() and (word.isascii() or max(word) < _LATIN_END):
            return self._part(" " + word)
        return self._word(word if word[:1] == "\n" else " " + word)

    def _lower_word(self, word: str) -> bytes:
        low = word.lower()
        if low.isascii() or max(low) < _LATIN_END:
            if low.isalpha():
                return self._part(low) if low == word else self.words[low]
            return b"".join([self.words[p] if p.isalpha() else self.parts[p] for p in _WORD_LATIN.findall(low)])
        word = self.tokenizer.normalizer.normalize_str(word)
        return b"".join(self._ids(x) for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(word))

    def _has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def _encode_spaced(self, text: str) -> bytes:
        """A space between two characters that aren't white space always starts a pre-token,
        and a line end between two such characters is one by itself."""
        if self._uncertain(text):
            return self.encode_runs(text)
        words = text.replace("\n", " \n").split(" ")
        return b"".join([self._word(words[0]), *map(self.words.__getitem__, words[1:])]) if text else b""

    def _uncertain(self, text: str) -> bool:
        return (
            text[:1] in (" ", "\n") or text[-1:] in (" ", "\n") or any(x in text for x in ("  ", " \n", "\n ", "\n\n"))
            or any(x in text for x in _ODD_SPACES) or self._has_special(text)
        )

    def encode_runs(self, text: str) -> bytes:
        """As _encode_spaced, for texts with runs of white space."""
        if self._has_special(text):
            return self.encode_whole(text)
        return b"".join(map(self._run, _RUNS.findall(text)))

    def _run(self, run: str) -> bytes:
        return self.words[run[1:]] if run[0] == " " and run[1:2] and run[1] not in SPACE_SET else self._word(run)

    def _encode_split(self, text: str) -> bytes:
        """White space only separates; control separators aren't white space to the file."""
        if _SEPARATORS.search(text) or self._has_special(text):
            return self.encode_whole(text)
        return b"".join(map(self.words.__getitem__, text.split()))


#: White-space level of the GPT-2 pattern: a word with the one space before it, or a run of white space.
_RUNS = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

_LOADED: dict[str, LibraryEncoder] = {}


def encoder(path: str, budget: int = 56 << 20) -> LibraryEncoder:
    """One encoder for each worker process and file; budget: bytes of a generation of its words."""
    if path not in _LOADED:
        _LOADED[path] = LibraryEncoder(path, budget)
    return _LOADED[path]
