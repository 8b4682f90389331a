"""Quality ledger, decontamination, line dedup and the similarity join against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from candlewick.llm import decontamination, jaccard_join, line_dedup, quality
from candlewick.llm.components import components
from candlewick.llm.line_index import LineIndex
from candlewick.llm.shingles import shingle_set, shingles

WS = " \t\n\x0b\x0c\r"


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


# ------------------------------------------------------------------ quality


def measures(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    lines = [x for x in text.split("\n") if x.strip(WS)]
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)),
            len(again), sum("A" <= c <= "Z" for c in text))


def test_ledger(make_docs, odd_rows):
    rows = odd_rows + [(20, "a b c a b c a b c"), (21, "x y z\nx y z\n\nx y z"), (22, "## $$ <b>|| ok")]
    got = quality.ledger(make_docs(rows)).collect()
    assert sorted(tuple(r[m] for m in quality.MEASURES) for r in got) == sorted(measures(t) for _, t in rows)
    for r in got:
        assert bool(r["fail_bits"] & 1) == (r["n_words"] < 50)
        assert bool(r["fail_bits"] & 2) == (100 * r["n_repeat_words"] > 50 * r["n_words"])


def test_policies_and_ablations(make_docs):
    good = " ".join(f"Word{i} and{i}" for i in range(60))
    rows = [(1, good), (2, "short"), (3, "same words here " * 40), (4, good.replace(" ", "### ")), (5, None)]
    docs = make_docs(rows)
    assert {r["doc_id"] for r in quality.kept_documents(docs, 1).collect()} == {1, 4}
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1}
    found = {r["rule"]: r for r in quality.ablations(quality.ledger(docs)).collect()}
    assert set(found) == set(quality.POLICIES[quality.CURRENT])
    assert found["few_words"]["failed"] == 2 and found["symbols"]["failed_alone"] == 1
    assert found["symbols"]["kept"] == 1 and found["symbols"]["documents"] == 5
    assert quality.kept_documents(make_docs([])).count() == 0


# ------------------------------------------------------------------ decontamination


def spelled(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def contaminated(text, items):
    w, hit, names = spelled(text), set(), set()
    for item, t in items:
        iw = spelled(t)
        if not iw:
            continue
        n = min(13, len(iw))
        windows = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in windows:
                hit.update(range(i, i + n))
                names.update([] if item is None else [str(item)])
    return len(w), len(hit), sorted(names)


def test_decontamination(spark, make_docs, odd_rows):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "é", "straße"]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = [(i, " ".join(words(n))) for i, n in enumerate([13, 14, 20, 40, 40, 60, 1, 3, 12, 3])]
    items += [(3, items[4][1]), (None, "w1 w2"), (None, " ".join(words(25))), (90, None), (91, "..."), (92, items[2][1])]
    rows = list(odd_rows)
    for i in range(60):
        parts = words(rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            w = spelled(rng.choice(items)[1])
            a = rng.randrange(len(w) + 1)
            parts += w[a:a + rng.choice([5, 12, 13, 14, 30])] + words(rng.randrange(4))
        text = rng.choice([" ", ", ", " -- "]).join(parts)
        rows.append((100 + i, text.upper() if i % 5 == 0 else text))
    rows += rows[-3:]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    docs = make_docs(rows)
    got = decontamination.contamination(docs, bench).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got) == sorted(
        (str(i), n, h, names, h > 0 and 20 * h >= n) for i, t in rows for n, h, names in [contaminated(t, items)])
    clean = decontamination.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not r["contaminated"] for r in got)


def test_decontamination_without_a_benchmark(spark, make_docs, odd_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r["n_hit"] == 0 for r in decontamination.contamination(make_docs(odd_rows), none).collect())
    assert decontamination.contamination(make_docs([]), none).count() == 0


def test_benchmark_beyond_the_broadcast_bound(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    item = " ".join(f"t{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontamination.contamination(make_docs([(1, "x " + item), (2, "y")]), bench).collect()
    assert {r["doc_id"]: r["n_hit"] for r in got} == {1: 20, 2: 0}


# ------------------------------------------------------------------ line dedup


def deduplicated(rows):
    import hashlib

    holders = defaultdict(set)
    place = lambda i, t: (i is None, int(hashlib.sha256((t or "").encode()).hexdigest()[:15], 16) if i is None else i)
    key = lambda line: ascii_lower(line.strip(WS))
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(place(i, t))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 2 or min(holders[key(x)]) == place(i, t)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("per_shard", [250_000, 20])
def test_line_dedup(make_docs, odd_rows, per_shard):
    rng = random.Random(5)
    pool = ["A shared line of text", "a SHARED line of text  ", "\tÉtéÉtéÉté", "étéétéété x", "short", "ninechars",
            "tenchars..", "ééééééééé", "éééééééééé", ""] + [f"line number {i} of the pool" for i in range(40)]
    rows = odd_rows + [(100 + i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 9)))) for i in range(80)]
    rows += [rows[-1], (100, rows[-2][1])]  # a repeated row, and a second text of one id
    rows += [(None, f"only without an id, one\nown text {i % 7}\n{pool[i]}") for i in range(20)]
    docs = make_docs(rows)
    got = line_dedup.deduplicated(docs, keys_per_shard=per_shard).collect()
    name = lambda r: (str(r[0]), *r[1:])
    assert sorted(name((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"])) for r in got) == sorted(
        map(name, deduplicated(rows)))
    assert all(r["row"]["words"] == "w" for r in got)


def test_line_dedup_of_nothing(make_docs):
    assert line_dedup.deduplicated(make_docs([])).count() == 0


def test_minimal_perfect_hash():
    rng = np.random.default_rng(1)
    high, low = (rng.integers(-2**63, 2**63, 5000, dtype=np.int64) for _ in range(2))
    high[:40] = high[0]  # equal halves
    low[40:80], high[40:80] = low[0], np.arange(40)
    index = LineIndex.load(LineIndex.build(high, low, np.arange(5000), np.arange(5000) * 3).dump())
    cell = index.find(high, low)
    assert sorted(cell) == list(range(5000))  # minimal and perfect
    assert (index.parts["first"][cell] == np.arange(5000) * 3).all()
    other = rng.integers(-2**63, 2**63, (2, 5000), dtype=np.int64)
    assert (index.find(other[0], other[1]) < 0).mean() > 0.999  # fingerprints reject other keys
    assert len(LineIndex.build(*(np.zeros(0, np.int64),) * 4).find(high, low)) == 5000


# ------------------------------------------------------------------ similarity join


def test_shingles():
    assert len(shingles(b"", 5)) == 0 and len(shingles(b" \n", 5)) == 0
    assert len(shingles(b"one two", 5)) == 1 and len(shingles(b"a b c d e f", 5)) == 2
    assert (shingles("A É b c d".encode(), 5) == shingles("a É B c D".encode(), 5)).all()
    assert len(shingle_set(b"a b c d e a b c d e a b c d e", 5)) == len(shingles(b"a b c d e a b c d e a b c d e", 5)) == 5


def linked(rows, k=5, percent=80):
    place = lambda i: jaccard_join.LAST_ID if i is None else i
    sets = [(place(i), shingle_set((t or "").encode(), k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            common = len(x & y)
            if common and 100 * common >= percent * (len(x) + len(y) - common) and find(i) != find(j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    back = lambda i: None if i == jaccard_join.LAST_ID else i
    return [(back(i), len(s), back(find(i))) for i, s in sets]


@pytest.mark.parametrize("hot", [16, 3])
def test_similarity_join(make_docs, odd_rows, monkeypatch, hot):
    monkeypatch.setattr(jaccard_join, "HOT_LEAST", hot)
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    bases = [[rng.choice(vocabulary) for _ in range(n)] for n in (3, 5, 6, 12, 30, 60, 60, 150)]
    rows = list(odd_rows)
    for i in range(90):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):  # near copies, chains of them
            if w:
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            w += [rng.choice(vocabulary) for _ in range(rng.randrange(12))]
        if rng.random() < 0.3:
            w = passage + w  # a passage that many documents share
        rows.append((200 - i, " ".join(w).upper() if i % 7 == 0 else "  ".join(w)))
    got = jaccard_join.linked(make_docs(rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, linked(rows)))
    docs = make_docs(rows)
    kept = jaccard_join.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _, c in linked(rows) if i == c}


def test_classes_of_one_group_are_compared_with_each_other(make_docs):
    """Documents of one size and prefix of which only the later two are similar: no chance may hide it."""
    rng = random.Random(21)
    for seed in range(2):
        base = [f"b{seed}x{i}" for i in range(60)]
        rows = []
        for i in range(12):
            w = list(base)
            a = rng.randrange(4) * 12
            w[a:a + 12] = [f"c{seed}y{i % 3}z{j}" for j in range(12)]
            rows.append((i, " ".join(w)))
        got = jaccard_join.linked(make_docs(rows)).collect()
        assert sorted(map(tuple, got)) == sorted(linked(rows))


def test_similarity_join_tells_texts_of_one_id_apart(make_docs):
    """Rows without an id, or with a repeated one, are documents by their texts."""
    rng = random.Random(31)
    a, b, c, d, e = (" ".join(rng.choice("abcdefghij") + str(rng.randrange(999)) for _ in range(60)) for _ in range(5))
    near = lambda text: text + " end"
    rows = [(3, a), (5, a), (5, b), (None, near(a)), (None, c), (None, d), (None, near(d)), (7, near(c)), (5, e),
            (8, near(e)), (None, d), (9, b.upper()), (9, b.upper()), (11, ""), (None, None), (None, "")]
    got = jaccard_join.linked(make_docs(rows)).collect()
    n = lambda text: len(shingle_set(text.encode(), 5))
    want = [(3, n(a), 3), (5, n(a), 3), (5, n(b), 5), (None, n(near(a)), 3), (None, n(c), 7), (None, n(d), None),
            (None, n(near(d)), None), (7, n(near(c)), 7), (5, n(e), 5), (8, n(near(e)), 5), (None, n(d), None),
            (9, n(b), 5), (9, n(b), 5), (11, 0, 11), (None, 0, None), (None, 0, None)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    kept = sorted(((r["doc_id"], r["text"]) for r in jaccard_join.distinct_documents(make_docs(rows)).collect()), key=str)
    of_d = [row for row in kept if row[0] is None and row[1] in (d, near(d))]
    assert len(of_d) == 1
    assert kept == sorted([(3, a), (5, b), (7, near(c)), (5, e), (11, ""), (None, None), (None, ""), *of_d], key=str)
    copies = [(1, a), (1, a), (None, b), (None, b)]  # the smallest document itself is repeated
    kept = [(r["doc_id"], r["text"]) for r in jaccard_join.distinct_documents(make_docs(copies)).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (None, b)], key=str)


def test_similarity_join_of_nothing(make_docs):
    assert jaccard_join.linked(make_docs([])).count() == 0
    assert jaccard_join.linked(make_docs([(1, None), (2, "")])).count() == 2


def test_packed_cells_round_trip():
    rng = np.random.default_rng(2)
    for cells in ([], [0], [65534], [65535], [65536, 4_000_000], np.unique(rng.integers(0, 1 << 22, 500))):
        cells = np.array(cells, dtype=np.int64)
        assert (jaccard_join.unpacked(jaccard_join.packed(cells)) == cells).all()


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)] + [(7, 7)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1]}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_hash_of_no_items_is_that_of_the_empty_text():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
