"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent letter 1- to 3-grams (words
padded by one blank), most frequent first. A document's own most frequent n-grams,
counted over its whole text, are compared to each profile by the out-of-place
distance: the difference of ranks, or the profile's length for an n-gram that the
profile lacks. The nearest profile names the language.

Profiles are learned on the driver from about ``sample`` distinct texts of each
language (chosen by a hash of the text over all learnable rows), so learning does
not grow with the corpus; every document is compared in its own task.

Defined results: null text or text without letters is ``und`` with score 0, and
so is every text when there is nothing to learn from; null lang is never learned;
a null ``doc_id`` counts as held out; ties go to the first language by name;
repeated rows are judged each.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.bpe import slices
from candlewick.llm.common import text_or_empty
from candlewick.llm.samples import chosen_keys, text_key, texts_of
from candlewick.llm.toxicity import fold

UNKNOWN = "und"
PROFILE = 400      # n-grams of a profile
DOCUMENT = 300     # n-grams of a document that are compared
_BLANK = 32
_BITS = np.uint64(21)  # of a code point


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str) -> np.ndarray:
    """Codes of all 1- to 3-grams of the text's letters; words are padded by one blank."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, dtype=np.uint64)
    before = np.concatenate(([True], letter[:-1]))
    kept = np.where(letter, codes, _BLANK)[letter | before]          # one blank for each run of others
    c = np.concatenate(([_BLANK], kept, [_BLANK])).astype(np.uint64)
    blank = c == _BLANK
    two = c[:-1] | (c[1:] << _BITS)
    three = two[:-1] | (c[2:] << (_BITS + _BITS))
    return np.concatenate([c[~blank], two[~(blank[:-1] & blank[1:])], three[~blank[1:-1]]])


def ranked(codes: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` most frequent n-grams, most frequent first, ties by code."""
    if len(codes) > most:
        least = -np.partition(-counts, most - 1)[most - 1]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))][:most]


def profile(texts: list[str], most: int = PROFILE) -> np.ndarray:
    """Ranked n-grams of a language's texts."""
    total = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    for a, b in slices(texts):
        codes, counts = np.unique(np.concatenate([grams(t) for t in texts[a:b]]), return_counts=True)
        both, at = np.unique(np.concatenate([total[0], codes]), return_inverse=True)
        total = both, np.bincount(at, weights=np.concatenate([total[1], counts])).astype(np.int64)
    return ranked(*total, most)


@dataclass
class Profiles:
    """Profiles of all languages as one table of ranks: n-gram (sorted) x language."""

    languages: list[str]
    codes: np.ndarray
    ranks: np.ndarray
    size: int

    @classmethod
    def of(cls, profiles: dict[str, np.ndarray], size: int = PROFILE) -> Profiles:
        languages = sorted(profiles)
        codes = np.unique(np.concatenate([profiles[x] for x in languages] or [np.zeros(0, dtype=np.uint64)]))
        ranks = np.full((len(codes), len(languages)), -1, dtype=np.int64)
        for j, x in enumerate(languages):
            ranks[np.searchsorted(codes, profiles[x]), j] = np.arange(len(profiles[x]))
        return cls(languages, codes, ranks, size)

    def predict(self, text: str) -> tuple[str, float]:
        """(language, score); the score is 1 - distance / greatest possible distance."""
        found = grams(text)
        if not len(found) or not len(self.codes):
            return UNKNOWN, 0.0
        own = ranked(*np.unique(found, return_counts=True), DOCUMENT)
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        ranks = np.where((self.codes[at] == own)[:, None], self.ranks[at], -1)
        places = np.arange(len(own))[:, None]
        distance = np.where(ranks < 0, self.size, np.minimum(np.abs(ranks - places), self.size)).sum(axis=0)
        best = int(distance.argmin())
        return self.languages[best], float(1.0 - distance[best] / (self.size * len(own)))


def learn(docs: DataFrame, sample: int = 1000, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Profiles:
    """Profiles of the languages of ``docs``, from about ``sample`` distinct texts of each."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), text_key(text_col).alias("key")) \
        .where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    keys = chosen_keys(rows, ["lang"], most=sample)
    chosen = texts_of(rows, keys, ["lang"]).select("lang", "text").collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(chosen):
        texts.setdefault(r["lang"], []).append(r["text"])
    return Profiles.of({lang: p for lang, t in texts.items() if len(p := profile(t))})


def _predict(profiles):
    def run(batches: Iterator):
        import pyarrow as pa

        predict = profiles.value.predict
        for batch in batches:
            found = [predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(profiles)  # PROFILE n-grams a language
    return text_or_empty(docs, id_col, text_col).mapInArrow(_predict(sent), "doc_id long, lang_pred string, score double")


def held_out(id_col: str = "doc_id", folds: int = 5):
    return fold(id_col, folds) == 0
