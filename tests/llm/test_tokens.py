"""Packing, token files, token counts: ids against the library itself."""

import struct
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candlewick.llm import bpe, packing, token_counts, token_files
from candlewick.llm.common import scratch, tokenizer_path

PATH = tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)
TEXT = st.lists(st.one_of(
    st.sampled_from([" ", "  ", "\n", "\t ", " \n", "\x1c", "\xa0", "<|endoftext|>", "<|endof", "'s", "don't", "é", "ß",
                     "ALL", "caps!!", "a,b", "12", "3.5", "中文", "🙂", "word", "naïve.", "(x)"]),
    st.text(max_size=6)), max_size=14).map("".join)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_cut_texts_have_the_ids_of_whole_texts(texts):
    small = bpe.Encoder(PATH, max_entries=5)
    assert small.by_cut
    for _ in range(2):  # the second time from the dictionaries
        assert small.encode(texts) == [packed(ids_of(t)) for t in texts]


def test_other_tokenizers_take_the_whole_text():
    enc = bpe.Encoder(tokenizer_path("word_bpe_49k.json"))
    assert not enc.by_cut
    other = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    text = "Some Words, twice  Some Words"
    assert enc.encode([text]) == [packed(other.encode(text, add_special_tokens=False).ids)]


def check_packing(rows, pieces, window):
    want = defaultdict(int)
    for i, t in rows:
        want[(i, packed([*ids_of(t), 1]))] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        assert len(r["ids"]) == 4 * r["length"] and r["length"] > 0
        by_doc[r["doc_id"]].append((r["start"], bytes(r["ids"]), r["doc_tokens"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= window
    total = sum(len(ids) // 4 * n for (_, ids), n in want.items())
    assert sum(r["length"] for r in pieces) == total
    for doc_id in {d for d, _ in want}:
        texts = [ids for (d, ids), n in want.items() if d == doc_id for _ in range(n)]
        if len(texts) == 1:  # each id in exactly one piece
            assert b"".join(ids for _, ids, _ in sorted(by_doc[doc_id])) == texts[0]
            assert {n for *_, n in by_doc[doc_id]} == {len(texts[0]) // 4}
        else:
            assert sum(len(ids) for _, ids, _ in by_doc[doc_id]) == sum(map(len, texts))
    return len(by_sequence), total


@pytest.mark.parametrize("open_windows,partitions", [(16, 3), (1, 5)])
def test_packing(make_docs, odd_rows, open_windows, partitions):
    rows = odd_rows + [(100 + i, f"short text number {i} " * (i % 37)) for i in range(300)]
    pieces = packing.pack(make_docs(rows, partitions), PATH, window=256, open_windows=open_windows,
                          min_cut=8, merge_partitions=2).collect()
    n, total = check_packing(rows, pieces, 256)
    assert total / (n * 256) > 0.95


def test_packing_of_nothing(make_docs):
    assert packing.pack(make_docs([]), PATH).count() == 0


def test_best_fit_prefers_the_tightest_window_and_emits_the_fullest():
    w = packing.Windows(size=10, most=2, min_cut=4, first_id=0)
    assert w.add("a", b"\0" * 4 * 7) == [] and w.add("b", b"\0" * 4 * 5) == []
    assert [p[0] for p in w.add("c", b"\0" * 4 * 3)] == ["a", "c"]      # room 3 rather than 5
    assert w.add("d", b"\0" * 4 * 6) == []
    out = w.add("e", b"\0" * 4 * 8)                                     # fits nowhere: the fullest (d) is filled up
    assert [(p[0], p[1], p[2]) for p in out] == [("d", 0, 6), ("e", 0, 4)]
    assert sorted((p[0], p[1], p[2]) for p in w.left()) == [("b", 0, 5), ("e", 4, 4)]


def test_token_files_round_trip(spark, make_docs, odd_rows):
    rows = odd_rows + [(50 + i, f"doc {i} " * (i * 7)) for i in range(60)]
    folder, manifest = token_files.write_token_files(make_docs(rows), PATH)
    got = sorted(token_files.read_token_files(spark, folder, manifest).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    assert sorted(bytes(r["ids"]) for r in got) == sorted(packed([*ids_of(t), 2]) for _, t in rows)
    some = token_files.read_token_files(spark, folder, manifest, doc_ids=[6, 55]).collect()
    assert {(r["doc_id"], bytes(r["ids"])) for r in some} == {(r["doc_id"], bytes(r["ids"])) for r in got
                                                               if r["doc_id"] in (6, 55)}


def test_token_files_of_nothing(spark, make_docs):
    folder, manifest = token_files.write_token_files(make_docs([]), PATH)
    assert token_files.read_token_files(spark, folder, manifest).count() == 0


def test_frames_are_independent_and_checked(tmp_path):
    import pyarrow as pa
    import zstandard

    docs = [(i, packed(list(range(i * 10, i * 10 + n)))) for i, n in enumerate([3, 0, 500, 40, 2, 90, 1])]
    path = str(tmp_path / "x.ids.zst")
    with open(path, "wb") as f:
        w = token_files.Writer(f, frame_ids=100)
        for i, ids in docs:
            w.add(i, ids)
        w.close()
    with pa.OSFile(path, "rb") as f:
        r = token_files.Reader(f)
        assert r.ids(6) == docs[6][1] and r.frames_read == 1
        assert [(r.doc_id(i), r.ids(i)) for i in range(len(docs))] == docs
        assert len(r.frames) > 5
    raw = open(path, "rb").read()
    with zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True) as s:
        assert s.read() == b"".join(ids for _, ids in docs)  # any zstandard decoder reads the stream
    bad = bytearray(raw)
    table = len(raw) - 9 - 12 * len(r.frames)
    bad[table + 8] ^= 1  # checksum of the first frame
    with pytest.raises(ValueError, match="checksum"):
        token_files.Reader(pa.BufferReader(bytes(bad))).ids(0)
    with pytest.raises(ValueError, match="seek table"):
        token_files.Reader(pa.BufferReader(raw[:-1] + b"\0"))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts(make_docs, odd_rows, name):
    path = tokenizer_path(name)
    if name.endswith(".model"):
        import sentencepiece

        count = lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t or ""))
    else:
        count = lambda t: len(ids_of(t))
    got = token_counts.token_counts(make_docs(odd_rows), path, limit=10).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(
        ((i, len((t or "").encode()), count(t), count(t) > 10) for i, t in odd_rows), key=key)


def test_only_misses_are_encoded_and_versions_stay_apart(spark, make_docs, monkeypatch):
    cache = scratch(spark, "cache-test")
    first = token_counts.token_counts(make_docs([(1, "a b"), (2, "a b"), (3, "c")]), PATH, cache=cache)
    assert first.count() == 3
    assert spark.read.parquet(cache).count() == 2  # distinct texts
    token_counts.token_counts(make_docs([(4, "c"), (5, "d e f")]), PATH, cache=cache).count()
    assert spark.read.parquet(cache).count() == 3  # one miss appended
    before = spark.read.parquet(cache).agg(F.max("n_tokens")).first()[0]
    token_counts.token_counts(make_docs([(4, "c")]), tokenizer_path("word_bpe_49k.json"), cache=cache).count()
    rows = spark.read.parquet(cache)
    assert rows.select("tokenizer").distinct().count() == 2 and rows.count() == 4 and before == 3
    assert token_counts.token_counts(make_docs([]), PATH, cache=cache).count() == 0


def test_checksum_column_is_the_library_s(make_docs):
    row = packing.pack(make_docs([(1, "some text")]), PATH).select(F.crc32("ids")).first()
    assert row[0] == zlib.crc32(packed([*ids_of("some text"), 1]))
