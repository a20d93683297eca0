"""Token ids of whole texts, as bytes of little-endian unsigned 32-bit ids.

The public tokenizers split a text into pre-tokens and encode each on its own
with their merge table. Texts repeat their words, so the ids of a word, and of
a pre-token in it, are asked from the library once and then looked up. The
splits are made here for texts of the plain alphabet below, where they are the
tokenizer's own rules; any other text goes to the library whole. Both ways
give the library's ids.
"""

from __future__ import annotations

import os
import re
from array import array

#: Texts of these characters only are split here: ASCII with line feeds, and
#: the Latin-1 letters (all precomposed, so no normalisation changes them).
_OTHER = re.compile(r"[^\n -~À-ÖØ-öø-ÿ]")
_L = "A-Za-zÀ-ÖØ-öø-ÿ"

# The pre-token rules the two vocabularies were made with.
_RULES = {
    "byte_bpe_50k.json": rf"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[0-9]+| ?[^ \n{_L}0-9]+|[ \n]+(?![^ \n])|[ \n]+",
    "word_bpe_49k.json": rf"'(?:s|t|re|ve|m|ll|d)|[{_L}]+|[0-9]|[^ \n{_L}0-9]+",
}


def _byte_letters() -> dict[int, str]:
    """Byte -> the letter that byte-level vocabularies write for it: itself
    where it prints, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder:
    """``encode(text)``: the ids of a text.

    Knows at most ``most`` words (and pre-tokens, half as many again) and starts
    anew beyond that, so its memory is bounded whatever the corpus holds.
    """

    def __init__(self, name: str, most: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(public_tokenizers.path(name))
        self.library.encode_special_tokens = True
        self.rule = re.compile(_RULES[name]).findall if name in _RULES else None
        self.spaced = name == "byte_bpe_50k.json"  # a word's blank is part of it; else text is lower-cased and blanks go
        self.model, self.letters, self.most = self.library.model, _byte_letters(), most
        self.tokens: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _by_rule(self, text: str) -> bytes:
        known, out = self.tokens, []
        for token in self.rule(text):
            ids = known.get(token)
            if ids is None:
                if len(known) >= self.most * 3 // 2:
                    known.clear()
                shown = token.encode().decode("latin-1").translate(self.letters)
                ids = known[token] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if self.rule is None or not (text.isascii() and text.isprintable()) and _OTHER.search(text):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        if not self.spaced:
            parts, head = text.lower().split(), b""
        elif "  " in text or "\n " in text:  # blanks that may join across words
            return self._by_rule(text)
        else:
            first, *parts = text.split(" ")
            head = self._by_rule(first)
        new = set(parts).difference(self.words)
        if new:
            if len(self.words) + len(new) > self.most:
                self.words.clear()
                new = set(parts)
            blank = " " if self.spaced else ""
            for w in new:
                self.words[w] = self._by_rule(blank + w)
        return head + b"".join(map(self.words.__getitem__, parts))


_KEPT: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """One encoder per vocabulary and worker process."""
    if name not in _KEPT:
        _KEPT[name] = Encoder(name)
    return _KEPT[name]
