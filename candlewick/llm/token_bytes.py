"""Two tokenizers side by side: ids of a text and the bytes each id stands for."""

from __future__ import annotations

import functools
import json
import re

from candlewick.llm.bpe import _byte_letters, spell

#: A space between characters that are no spaces; neither side may be white space after it.
_CUT = re.compile(r"(?<=[^ ]) (?=\S)")
_LATIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
_OTHER_SPACE = re.compile(r" (?!\S)")


def segments(text: str) -> list[str]:
    """``text`` cut at every space that stands between two non-spaces; that space is left out."""
    if text.startswith(" ") or _OTHER_SPACE.search(text):
        return _CUT.split(text)
    return text.split(" ")


class ByteLevel:
    """A byte-level BPE of the tokenizers library; special strings in texts are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.tails: dict[str, list[int]] = {"": []}     # ids of short punctuation behind a word
        byte_of = {letter: b for b, letter in self.letters.items()}
        self.bytes_of = {i: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
                         for t, i in self.tokenizer.get_vocab().items()}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        added = [t for t in spec.get("added_tokens", []) if not t["special"]]
        # its pattern starts a piece at a space before a non-space, and merges stay inside pieces
        self.starts_at_space = (not spec.get("normalizer") and not added and pre.get("type") == "ByteLevel"
                                and bool(pre.get("use_regex")) and not pre.get("add_prefix_space")
                                and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout"))

    def _tail(self, tail: str) -> list[int]:
        if tail not in self.tails:
            ids = self.tokenizer.encode(tail, add_special_tokens=False).ids
            if len(tail) > 3:
                return ids
            self.tails[tail] = ids
        return self.tails[tail]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of a space and each text. A word of Latin letters is one piece of the byte-level pattern,
        ASCII punctuation behind it the next, so the word goes straight to the BPE model."""
        out, rest = [None] * len(texts), []
        for i, t in enumerate(texts):
            m = _LATIN.fullmatch(t) if self.starts_at_space else None
            if m:
                out[i] = [x.id for x in self.model.tokenize(spell(m[1], self.letters))] + self._tail(m[2])
            else:
                rest.append(i)
        for at in range(0, len(rest), 10_000):
            part = rest[at:at + 10_000]
            encoded = self.tokenizer.encode_batch_fast([" " + texts[i] for i in part], add_special_tokens=False)
            for i, e in zip(part, encoded):
                out[i] = e.ids
        return out


class Pieces:
    """A sentencepiece model that puts a space before the text and falls back to bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = {i: bytes([int(t[3:5], 16)]) if self.model.is_byte(i) else t.replace("▁", " ").encode()
                         for i, t in enumerate(names)}
        # no piece reaches from a non-space over a space, and the first piece starts with the added space
        self.starts_at_space = (not any("▁" in t.lstrip("▁") for t in names)
                                and names[self.model.encode("a")[0]].startswith("▁"))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@functools.lru_cache(maxsize=8)
def tokenizer(path: str) -> ByteLevel | Pieces:
    """One per Python worker and file; ``.model`` files belong to sentencepiece."""
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)
