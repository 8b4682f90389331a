"""Resampling: checksums against zlib, weights and ranks against a plain version."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewick.llm import importance
from candlewick.llm.crc_features import SPAN, crc32_spans, text_slices, word_features

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=900), st.data())
def test_spans_have_the_checksums_of_zlib(data, draw):
    cuts = draw.draw(st.lists(st.tuples(st.integers(0, len(data) - 1), st.integers(1, 900)), min_size=1, max_size=20))
    cuts += [(0, n) for n in (1, SPAN, SPAN + 1, 2 * SPAN, 2 * SPAN + 1)]
    starts = np.array([a for a, _ in cuts])
    ends = np.minimum(starts + np.array([n for _, n in cuts]), len(data))
    got = crc32_spans(np.frombuffer(data, np.uint8), starts, ends)
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in zip(starts, ends)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aZ0é中 .-\n🙂", max_size=30), min_size=1, max_size=8))
def test_features_of_texts(texts):
    texts = [*texts, "", "long" * 100 + " " + "words" * 200]
    for row, data, offsets in text_slices(pa.array(texts), most=20):
        n_words, text, bucket = word_features(data, offsets, 10_000)
        for i in range(len(offsets) - 1):
            words, want = features(texts[row + i])
            assert n_words[i] == len(words)
            assert sorted(bucket[text == i]) == sorted(zlib.crc32(f.encode()) % 10_000 for f in want)


def resampled(rows, target, buckets, percent, min_words, seed):
    """(doc_id, n_features, weight, score, rank) of every row, plainly."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            for f in features(x)[1]:
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets))))
            for b in range(buckets)]
    out = []
    for i, x in rows:
        words, fs = features(x)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))
        out.append((len(words) < min_words, -score, i is None, i or 0, weight, len(fs), i))
    out.sort()
    drawn = percent * sum(not x[0] for x in out) // 100
    return [(i, n, w, -neg, k + 1 if k < drawn else None) for k, (_, neg, _, _, w, n, i) in enumerate(out)]


def test_equals_the_plain_version(spark, make_docs, odd_rows):
    rows = odd_rows + [(None, "the same words here again " * 9)] * 40 + [
        (20 + i % 30, " ".join(f"w{(i * k) % 17}" for k in range(i % 60))) for i in range(120)]
    target = ["the same words", None, "", "w1 w2 w3 w1 w2"]
    marks = spark.createDataFrame([(t, 1) for t in target], "text string, weight int")
    for percent, min_words in ((25, 20), (100, 0), (0, 5)):
        got = importance.resample(make_docs(rows, 5), marks, 500, percent, min_words, seed=3)
        got = [(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect()]
        assert sorted(map(str, got)) == sorted(map(str, resampled(rows, target, 500, percent, min_words, 3)))


def test_empty_tables(spark, make_docs):
    none, some = make_docs([]), make_docs([(1, "a b c")])
    assert importance.resample(none, some.select("text")).collect() == []
    assert importance.resample(make_docs([(1, ""), (2, None)]), none).select("weight").distinct().collect()[0][0] == 0
    (row,) = importance.resample(some, none, percent=100, min_words=1).collect()
    assert (row["n_features"], row["rank"]) == (5, 1)


def test_equal_scores_are_spread_over_tasks(spark):
    """A repeated id with one text (all scores equal) does not meet in one task."""
    scored = spark.range(4000).select(F.lit(5).cast("long").alias("doc_id"), F.lit(30).cast("long").alias("n_words"),
                                      F.lit(1).cast("long").alias("n_features"), F.lit(0).cast("long").alias("weight"),
                                      F.lit(10).cast("long").alias("score")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = importance.ordered(scored, 20)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_part = [r["count"] for r in placed.groupBy(F.shiftrightunsigned("at", 33)).count().collect()]
    assert sum(per_part) == 4000 and max(per_part) < 2000
    ranks = sorted(r["rank"] for r in importance.draw(scored, 50).where("rank is not null").collect())
    assert ranks == list(range(1, 2001))
