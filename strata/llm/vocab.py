"""Token ids of whole texts, exactly as the tokenizers library gives them, for the price of a word lookup.

The library spends its time on words it has seen before. Both kinds of vocabulary used here never join characters over
certain gaps between words, so a text is cut at those gaps, and each distinct word is given to the library once per
Python worker. A text for which the cut is not safe goes to the library whole.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections.abc import Callable

import numpy as np

# Words held by each of the two generations of a cache, and the longest word worth holding.
CACHED_WORDS, CACHED_LENGTH = 600_000, 64
# Fixed value: ASCII punctuation but the apostrophe, which may begin a contraction.
PUNCTUATION = frozenset('!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')


# Letters below this one are one character in either case, and composed as they stand.
BEYOND = "\u0130"


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones (of Latin-1) for themselves, the
    others, in their order, for the characters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in printable]
    return {b: chr(b) if b in printable else chr(256 + hidden.index(b)) for b in range(256)}


def plain_letters(word: str) -> bool:
    """Is the word one run of letters to either kind of tokenizer, and only its case changes when it is normalised?"""
    return word.isalpha() and max(word) < BEYOND


class Irregular(Exception):
    """The text can't be cut at every space."""


class WordCache(dict):
    """Results by word. The older of two generations is dropped when the younger is full, so memory stays bounded and
    frequent words stay."""

    def __init__(self, make: Callable[[str], object], limit: int = CACHED_WORDS) -> None:
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, word: str):
        value = self.older.get(word)
        if value is None:
            value = self.make(word)
            if len(word) > CACHED_LENGTH:
                return value
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[word] = value
        return value


def stem(word: str) -> int:
    """Where a word that ends in punctuation behind a letter can be cut; 0 for others. Both kinds of tokenizer end a run
    of letters there and take all the punctuation as one run."""
    end = len(word)
    while end and word[end - 1] in PUNCTUATION:
        end -= 1
    return end if 0 < end < len(word) and word[end - 1].isalpha() else 0


class Encoder:
    """``encode(text)``: the ids as bytes of ``dtype`` (two bytes where the vocabulary allows it, else four)."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        spec = json.loads(self.library.to_str())
        self.special = [a["content"] for a in spec["added_tokens"]]
        self.encode = {"dropped": self._dropped, "kept": self._kept}.get(white_space(spec), self.whole)
        self.words = WordCache(self._word)
        self.runs = WordCache(self.whole)
        self.spaced = WordCache(lambda w: self._plain(w, " "))
        self.first = WordCache(lambda w: self._plain(w, ""))
        self.newline = self.whole("\n")
        self.letters, self.code = byte_letters(), "H" if self.dtype.itemsize == 2 else "I"

    def whole(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def run_of_letters(self, word: str) -> bytes:
        """What `whole` gives for a word that is one run to the library, at half the price."""
        spelled = word.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.library.model.tokenize(spelled)]).tobytes()

    def _word(self, word: str) -> bytes:
        if not word:
            return b""
        if plain_letters(word):
            lower = word.lower()
            return self.run_of_letters(word) if lower == word else self.words[lower]
        letters = stem(word)
        return self.words[word[:letters]] + self.words[word[letters:]] if letters else self.whole(word)

    def _plain(self, word: str, space: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise Irregular
        if plain_letters(word):
            return self.run_of_letters(space + word)
        letters = stem(word)
        if letters:
            return (self.spaced if space else self.first)[word[:letters]] + self.first[word[letters:]]
        return self.whole(space + word)

    def _has_special(self, text: str) -> bool:
        return any(s in text for s in self.special)

    def _dropped(self, text: str) -> bytes:
        """For vocabularies that drop white space: no token and no normal form reaches over a space or newline."""
        if self._has_special(text):
            return self.whole(text)
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))

    def _kept(self, text: str) -> bytes:
        """For byte-level vocabularies: a single space between two words belongs to the second, a single newline
        between two words is a token run of its own. Longer runs of white space are kept in one piece with the words
        at their sides."""
        if self._has_special(text):
            return self.whole(text)
        if not text:
            return b""
        out = []
        try:
            for line in text.split("\n"):
                head, *rest = line.split(" ")
                out += (self.newline, self.first[head], *map(self.spaced.__getitem__, rest))
            return b"".join(out[1:])
        except Irregular:
            return b"".join(map(self.runs.__getitem__, re.split(r"(?<=\S)(?= \S)", text)))


def white_space(spec: dict) -> str:
    """What a tokenizer does with white space, read from its description: dropped, kept or (anything else) unknown."""
    normal, cut = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
    if spec["model"]["type"] != "BPE" or any(a["lstrip"] or a["rstrip"] or a["normalized"] for a in spec["added_tokens"]):
        return "unknown"
    if not normal and cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]:
        return "kept"
    steps = [n["type"] for n in normal.get("normalizers", [])]
    cuts = cut.get("pretokenizers", [])
    if set(steps) <= {"NFC", "Replace", "Lowercase"} and cuts and cuts[0]["type"] == "Split":
        replaced = [(n["pattern"], n["content"]) for n in normal["normalizers"] if n["type"] == "Replace"]
        # Letters are one run, digits single, all else but white space one run; apostrophes begin contractions.
        words_only = cuts[0]["invert"] and cuts[0]["behavior"] == "Removed" and cuts[0]["pattern"].get("Regex", "").endswith(r"[^\s\p{L}\p{N}]+")
        levels = [c for c in cuts[1:] if c["type"] != "ByteLevel" or c["use_regex"] or c["add_prefix_space"]]
        if replaced == [({"Regex": r"\s+"}, " ")] and words_only and not levels:
            return "dropped"
    return "unknown"


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file; its caches outlive a task."""
    return Encoder(path)


def tokenizer_digest(path: str) -> str:
    """What decides the ids: the vocabulary file and the library's version."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(tokenizers.__version__.encode() + b"\0" + f.read()).hexdigest()
