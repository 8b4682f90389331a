"""Alignment: segments against whole texts, sums against a plain version."""

from array import array
from collections import Counter
from itertools import accumulate

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.llm import alignment
from candlewick.llm.common import tokenizer_path
from candlewick.llm.token_bytes import tokenizer

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
TEXT = st.lists(st.sampled_from([" ", "  ", "   ", "\n", " \n", "\t", "don't", "word.", "é,\"", "a<|endoftext|>", "é", "naïve", "▁", "🙂", "中文", "ALL!!",
                                 "<|endoftext|>", "</s>", "<0x41>", "\x1c", "\xa0", "\x00", "words ", " x"]),
                max_size=12).map("".join)


def whole(text):
    """(A ids, B ids, groups, links) of a whole text by comparing all byte ranges."""
    if not text:
        return [], [], [], []
    (a,), (b,) = tokenizer(A).encode([text]), tokenizer(B).encode([text])
    parts = [[tokenizer(p).bytes_of[i] for i in ids] for p, ids in ((A, a), (B, b))]
    if any(b"".join(x) != b" " + text.encode() for x in parts):
        return [], [], [], []
    ends = [list(accumulate(map(len, x))) for x in parts]
    starts = [[0, *e[:-1]] for e in ends]
    links = [(x, y) for i, x in enumerate(a) for j, y in enumerate(b)
             if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]]
    common = sorted(set(ends[0]) & set(ends[1]))
    groups = [([x for x, e in zip(a, ends[0]) if lo < e <= hi], [y for y, e in zip(b, ends[1]) if lo < e <= hi])
              for lo, hi in zip([0, *common], common)]
    return a, b, groups, links


def as_text(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_segments_have_the_alignment_of_the_whole_text(texts):
    aligner = alignment.Aligner(A, B)
    assert aligner.by_segment
    for _ in range(2):  # the second time from what is remembered
        cuts, found = aligner.align(texts)
        for t, c in zip(texts, cuts):
            a, b, groups, links = whole(t)
            assert ";".join(found[s][0] for s in c) == as_text(groups)
            assert (sum(found[s][1] for s in c), sum(found[s][2] for s in c)) == (len(a), len(b))
            pairs = [x for s in c for x in array("q", found[s][4])]
            assert Counter((x >> 32, x & 0xFFFFFFFF) for x in pairs) == Counter(links)


def test_tokenizers_without_the_promise_take_whole_texts():
    assert not alignment.Aligner(tokenizer_path("word_bpe_49k.json"), B).by_segment


def expected(rows):
    texts = [(i, *whole(t)) for i, t in rows]
    pairs = Counter(p for *_, links in texts for p in links)
    most = Counter()
    for (_, b), n in pairs.items():
        most[b] = max(most[b], n)
    return [(i, len(a), len(b), len(g), len(ls), sum(pairs[p] == most[p[1]] for p in ls), sum(pairs[p] for p in ls),
             as_text(g)) for i, a, b, g, ls in texts]


@pytest.mark.parametrize("chunk", [1, 50, 1_000_000])
def test_equals_the_plain_version(make_docs, odd_rows, chunk):
    rows = [(i, t and t[:2000]) for i, t in odd_rows] + [(30, "▁ no such space"), (31, " lead"), (32, "trail ")] \
        + [(40, "copies of a text")] * 12
    got = alignment.align(make_docs(rows), A, B, chunk_segments=chunk).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected(rows)))


def test_tables_without_tokens(make_docs):
    assert alignment.align(make_docs([]), A, B).collect() == []
    got = alignment.align(make_docs([(1, None), (None, ""), (2, "▁")]), A, B, digest=True).collect()
    assert sorted(str(tuple(r)[1:]) for r in got) == ["(0, 0, 0, 0, 0, 0, '')"] * 3


def test_query_equals_the_plain_version(spark):
    import hashlib

    from candlewick.llm import registry
    from candlewick.llm.common import table

    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect() if len(r["text"]) < 4000]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.createOrReplaceTempView("short_documents")
    got = alignment.align(docs, A, B, digest=True).collect()
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in expected(rows)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert registry.op12_alignment(spark, sf).count() == table(spark, sf, "documents").count()


def test_aligning_keeps_the_cycle_collector_out():
    """It is off while texts are aligned, and as it was before afterwards, after an error too."""
    import gc

    import public_tokenizers

    from candlewick.llm.alignment import Aligner

    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    aligner, during = Aligner(*paths), []
    inner = aligner._new
    aligner._new = lambda texts: (during.append(gc.isenabled()), inner(texts))[1]
    for on in (True, False):
        (gc.enable if on else gc.disable)()
        try:
            cuts, _ = aligner.align([f"some words {on}"])
            assert cuts[0] == ["some", "words", str(on)] and gc.isenabled() is on
            with pytest.raises(AttributeError):
                aligner.align([1])
            assert gc.isenabled() is on
        finally:
            gc.enable()
    assert during == [False, False]
