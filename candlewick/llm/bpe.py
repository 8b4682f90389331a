"""Token ids of whole texts, encoded by the tokenizers library piece by piece.

The byte-level pre-tokenizer always starts a new piece at a space that is
followed by a non-space character, and merges never cross pieces. A text can
therefore be cut in front of every such space and each cut encoded on its own:
the joined ids equal the ids of the whole text (``tests/llm/test_tokens.py`` holds
this against the library on generated texts, special strings included). Cuts
repeat a lot, so the ids of cuts and words seen so far are kept in dictionaries
of bounded size, and only what is not in them goes to the library.

A missing cut that is one word of Latin letters, perhaps with ASCII punctuation
behind it, is split there (the pre-tokenizer does so too) and its word goes
straight to the library's BPE model, without the cost of a whole encoding; all
other cuts take the library's full path. The rule
holds for tokenizers without a normalizer and with the byte-level pre-tokenizer;
``Encoder`` looks at the file and otherwise encodes whole texts.
"""

from __future__ import annotations

import functools
import json
import re
import sys
from array import array

#: Entries of each dictionary per Python worker (about 100 MB); a full one takes no more.
CACHE_ENTRIES = 500_000
#: Longer cuts are encoded but not kept.
CACHE_CHARS = 40

_SPACE_THEN_SPACE = re.compile(r" (?!\S)")
_CUT = re.compile(r" (?=\S)")
_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
#: A special string that no cut matching _WORD can hold: a letter or digit behind another character.
_OUTSIDE_WORDS = re.compile(r"\S*[!-/:-@\[-`{-~]\S*[A-Za-z0-9]\S*")


def cut(text: str) -> list[str]:
    """The text cut at every space followed by a non-space; that space is left out."""
    if _SPACE_THEN_SPACE.search(text):
        return _CUT.split(text)
    return text.split(" ")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: printable Latin-1 stands for itself,
    the other bytes take the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(others)}}


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def spell(word: str, letters: dict[int, str]) -> str:
    """A space and ``word`` as the BPE model spells them; ASCII stands for itself."""
    if word.isascii():
        return letters[32] + word
    return letters[32] + word.encode().decode("latin-1").translate(letters)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, in bytes."""

    def __init__(self, path: str, max_entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.max_entries = max_entries
        self.cuts: dict[str, bytes] = {}    # cuts that follow a space
        self.words: dict[str, bytes] = {}   # words after a space
        self.tails: dict[str, bytes] = {}   # short punctuation behind a word
        self.letters = _byte_letters()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        odd = [t for t in spec.get("added_tokens", [])
               if t["lstrip"] or t["rstrip"] or t["single_word"]
               or not _OUTSIDE_WORDS.fullmatch(t["content"])]
        # an added token splits the text before the pre-tokenizer does, so white space right before one
        # is a piece of its own: that must not merge a last space with the character before it
        blank = "".join(self.letters[b] for b in b" \t\n\r\x0b\x0c")
        loose = [t for t in spec["model"].get("vocab", {}) if len(t) > 1 and t[-1] == self.letters[32]
                 and t[-2] in blank] if spec.get("added_tokens") else []
        self.by_cut = (not loose and not spec.get("normalizer") and not odd and pre.get("type") == "ByteLevel"
                       and bool(pre.get("use_regex")) and not pre.get("add_prefix_space")
                       and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout"))

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [_packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _tail(self, tail: str) -> bytes:
        ids = self.tails.get(tail)
        if ids is None:
            ids = self._encode([tail])[0]
            if len(tail) <= 4:
                self.tails[tail] = ids
        return ids

    def _missing(self, cuts: set[str]) -> dict[str, bytes]:
        found, rest, words, tails = {}, [], self.words, self.tails
        tokenize, match, room = self.model.tokenize, _WORD.fullmatch, self.max_entries - len(self.words)
        for c in cuts:
            m = match(c)
            if m is None:
                rest.append(c)
                continue
            word, tail = m.groups()
            ids = words.get(word)
            if ids is None:
                ids = _packed([t.id for t in tokenize(spell(word, self.letters))])
                if room > 0 and len(word) <= CACHE_CHARS:
                    words[word] = ids
                    room -= 1
            if tail:
                end = tails.get(tail)
                ids += self._tail(tail) if end is None else end
            found[c] = ids
        for at in range(0, len(rest), 10_000):
            part = rest[at:at + 10_000]
            found.update(zip(part, self._encode([" " + c for c in part])))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, without added special tokens."""
        if not self.by_cut:
            return self._encode(texts)
        parts = [cut(t) for t in texts]
        starts = self._encode([p[0] for p in parts])
        get, out, gaps, missing = self.cuts.get, [], [], set()
        for p in parts:
            del p[0]
            got = list(map(get, p))
            gap = [i for i, ids in enumerate(got) if ids is None] if None in got else ()
            missing.update(p[i] for i in gap)
            out.append(got)
            gaps.append(gap)
        if missing:
            found = self._missing(missing)
            for got, gap, p in zip(out, gaps, parts):
                for i in gap:
                    got[i] = found[p[i]]
            if len(self.cuts) < self.max_entries:
                self.cuts.update(x for x in found.items() if len(x[0]) <= CACHE_CHARS)
        return [s + b"".join(got) for s, got in zip(starts, out)]


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and tokenizer file."""
    return Encoder(path)


def slices(texts: list[str], chars: int = 2_000_000):
    """Ranges of ``texts`` of about ``chars`` characters, so that a call's memory is bounded."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
