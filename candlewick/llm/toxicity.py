"""Toxicity: a linear-chain conditional random field tags toxic words; its marginals score documents.

The model is fitted on the driver from about ``sample`` distinct labelled texts,
taken evenly over labels and spellings, so the fit does not grow with the corpus.
Every document is tagged whole, in its own task, by the broadcast model (weights
of the features that the sample shows to go with the label).

A document's score is a logistic function of the sum of its words' marginals (the
expected number of toxic words) and of its length, fitted on the same documents:
one word that may be toxic says little in a long text. Spans are runs of words
with marginal 0.5 or more.

Defined results: null or empty text, or text without letters, scores 0; a text's
label is toxic if any copy's is; labels of
null or of unknown documents are not used; repeated labels of a document count as
toxic if any is; without labels every score is 0; a null ``doc_id`` is never
learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm import crf
from candlewick.llm.bpe import slices
from candlewick.llm.common import text_or_empty
from candlewick.llm.samples import chosen_keys, text_key, texts_of

SPAN_LEAST = 0.5
SPANS = "array<struct<start:int,end:int,score:double>>"


def fold(id_col: str, folds: int):
    """crc32 of doc_id as text, modulo ``folds``; 0 for null."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(0))


def trait(text_col: str = "text"):
    """A property of the text alone that tells alphabets and spellings apart, as one of 64 numbers: its
    first letter outside ASCII (0 without one)."""
    first = F.lower(F.regexp_extract(F.col(text_col), r"[^\x00-\x7F]", 0))
    return F.when(first == "", 0).otherwise(F.pmod(F.xxhash64(first), F.lit(63)) + 1).cast("int")


def labelled_texts(docs: DataFrame, labels: DataFrame, sample: int, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic") -> list[tuple[str, int]]:
    """About ``sample`` distinct labelled texts, sorted. They are taken evenly from the groups of one
    label and one :func:`trait`, small groups whole, so a rare language or spelling is learned too."""
    marked = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
              .where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label")))
    texts = text_or_empty(docs, id_col, text_col).withColumn("key", text_key())
    pool = (texts.select("doc_id", "key", trait().alias("trait")).join(marked, "doc_id")
            .groupBy("key").agg(F.max("label").alias("label"), F.first("trait").alias("trait")))
    keys = chosen_keys(pool, ["label", "trait"], total=sample)
    rows = texts_of(texts, keys, ["label", "trait"]).select("text", "label").collect()
    return sorted((r["text"], r["label"]) for r in rows)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 4000, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> crf.Model:
    """Model from about ``sample`` labelled texts; ``labels`` has id_col and label_col (0 or 1)."""
    rows = labelled_texts(docs, labels, sample, id_col, text_col, label_col)
    return crf.fit([t for t, _ in rows], [y for _, y in rows])


def document_score(p: np.ndarray, model: crf.Model) -> tuple[float, list[tuple[int, int, float]]]:
    """(score, toxic spans as first word, last word, highest marginal) of a document's marginals."""
    if not len(p):
        return 0.0, []
    score = model.document(p)
    hot = p >= SPAN_LEAST
    if not hot.any():
        return score, []
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hot.astype(np.int8), [0]))))
    return score, [(int(a), int(b) - 1, float(p[a:b].max())) for a, b in zip(edges[::2], edges[1::2])]


def _tag(model):
    def run(batches: Iterator):
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("spans", pa.list_(pa.struct(
            [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))])
        tagger = model.value
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts, 6_000_000):
                scores, found = [], []
                for text, p in zip(texts[a:b], tagger.tag([crf.words(t) for t in texts[a:b]])):
                    score, spans = document_score(p, tagger)
                    if spans:  # character offsets in the lower-cased text
                        at = [m.span() for m in crf.WORD.finditer(text.lower())]
                        spans = [{"start": at[x][0], "end": at[y][1], "score": s} for x, y, s in spans]
                    scores.append(score)
                    found.append(spans)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a:b], pa.int64()), pa.array(scores, pa.float64()), pa.array(found, schema[2].type)],
                    schema=schema)

    return run


def toxicity(docs: DataFrame, model: crf.Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and spans (start, end, score: offsets of offending characters) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's words
    return text_or_empty(docs, id_col, text_col).mapInArrow(_tag(sent), f"doc_id long, score double, spans {SPANS}")
