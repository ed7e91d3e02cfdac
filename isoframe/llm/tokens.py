"""Token ids of whole texts by a public byte-level BPE vocabulary."""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

#: Words, and pre-tokens of other words, remembered by each Python worker: the first
#: it meets, which are likely the common ones.
REMEMBER = 250_000
#: Words with marks after them are remembered while fewer words than this are;
#: later ones are put together from both.
REMEMBER_MARKED = 100_000
#: Characters that make one pre-token where they follow a letter: the
#: punctuation of ASCII but for the apostrophe, with which suffixes begin.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Longest one remembered, in characters.
LONGEST = 64
#: All versions of Unicode in use class the characters before this one alike.
AGREED = "\u0250"


def vocabulary() -> str:
    """Path of the vocabulary file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_names() -> dict[int, str]:
    """The printable character by which byte-level BPE writes each byte.

    Printable Latin-1 characters stand for themselves, the other bytes for the
    characters from 256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Remembered(dict):
    """Values of strings by a function, remembered up to a number."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, key: str) -> bytes:
        value = self.find(key)
        if len(self) < (REMEMBER_MARKED if key[-1:] in MARKS else REMEMBER) and len(key) <= LONGEST:
            self[key] = value
        return value


class _Crossing(Exception):
    """White space meets at a space, so that pre-tokens may cross it."""


def _letters(word: str) -> bool:
    """Whether all of a word is letters, whichever version of Unicode is asked."""
    return word.isalpha() and (word.isascii() or max(word) < AGREED)


class Encoder:
    """Ids of texts, put together from those of words that recur.

    The vocabulary's pattern cuts a text into pre-tokens, each encoded for
    itself by the BPE model of the ``tokenizers`` library.  A space after and
    before other characters begins a pre-token, so texts are split at spaces and line
    ends, and the words' ids are remembered; the pattern isn't asked about letters
    with MARKS after them.  Where white space meets, it goes over the whole text.  A text with a special token's string
    goes to the library as it is.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.find = regex.compile(public_tokenizers.PATTERN)
        self._model = self.tokenizer.model
        # Words are remembered here; looking for them in the model's own cache costs a fifth of its time.
        self._model._resize_cache(0)
        self._names = _byte_names()
        self._as: dict[str, str] = {}
        self.pretokens = _Remembered(self.of_pretoken)
        self._words = _Remembered(self._word)

    def whole(self, text: str) -> bytes:
        """Ids by the library alone."""
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return array("I", found.ids).tobytes()

    def of_pretoken(self, pretoken: str) -> bytes:
        """Ids of one pre-token, in which no special token is seen."""
        # ASCII letters are written as they are.
        spelled = pretoken if pretoken.isascii() and pretoken.isalpha() else pretoken.encode().decode("latin-1").translate(self._names)
        return self._of_spelled(spelled)

    def _of_spelled(self, spelled: str) -> bytes:
        return array("I", [t.id for t in self._model.tokenize(spelled)]).tobytes()

    def view(self, text: str) -> str:
        """The text as the pattern should see it, character for character.

        The library and ``regex`` know different versions of Unicode; a
        character that they class differently is shown as one of the class
        that the library gives it.
        """
        if text.isascii() or max(text) < AGREED:
            return text
        odd = {c: self._shown(c) for c in set(text) if c > "\x7f"}
        odd = {ord(c): x for c, x in odd.items() if c != x}
        return text.translate(odd) if odd else text

    def _shown(self, c: str) -> str:
        if c not in self._as:
            rule = self.tokenizer.pre_tokenizer.pre_tokenize_str
            probe = "a{0}b 1{0}1 !{0}! {0}"
            theirs = [b - a for _, (a, b) in rule(probe.format(c))]
            self._as[c] = next(x for x in (c, "a", "1", "!", "\t") if [len(p) for p in self.find.findall(probe.format(x))] == theirs)
        return self._as[c]

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        view = self.view(text)
        if view is text:
            return self.find.findall(text)
        return [text[m.start() : m.end()] for m in self.find.finditer(view)]

    def _joined(self, text: str) -> bytes:
        return b"".join(map(self.pretokens.__getitem__, self.split(text)))

    def _word(self, word: str) -> bytes:
        """Ids of what stands between two spaces, with the one before it."""
        if _letters(word):
            return self._of_spelled(self._names[0x20] + word) if word.isascii() else self.of_pretoken(" " + word)
        if not word or word[-1].isspace() or (word[0].isspace() and (word[0] != "\n" or word[1].isspace())):
            raise _Crossing
        if word[0] != "\n":
            return self._marked(word, self._words) or self._joined(" " + word)
        return self.pretokens["\n"] + (self._marked(word[1:], self.pretokens) or self._joined(word[1:]))

    def _marked(self, word: str, ids: _Remembered) -> bytes:
        """Ids of letters, as ``ids`` has them, with or without marks after them; none of another word."""
        stem = word.rstrip(MARKS)
        if not _letters(stem):
            return b""
        return ids[stem] + self.pretokens[word[len(stem) :]] if len(stem) < len(word) else ids[stem]

    def ids(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self.whole(text)
        # A line end is taken as the beginning of a word that no space precedes.
        head, *rest = text.replace("\n", " \n").split(" ")
        try:
            if head[-1:].isspace():
                raise _Crossing
            words = b"".join(map(self._words.__getitem__, rest))
        except _Crossing:
            return self._joined(text)
        return self._joined(head) + words


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    return Encoder(path)
