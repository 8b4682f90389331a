"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

For one text, the cumulative byte ends of both token lists go into end-to-index
dictionaries; the sorted keys that both hold cut the two id lists into groups,
and in each group the overlapping pairs of tokens are the links.

Texts are aligned segment by segment: both tokenizers always end a token before
a space that stands between two non-spaces (``token_bytes`` checks this on the
vocabularies), so a text's groups are those of its segments in turn, and a
segment that was met before is not aligned again. If the tokenizers do not
promise it, or a segment's bytes do not add up, the whole text is one segment.

How often two ids are linked in the corpus is a sum over all links, and each
document needs the sums of its own links back. The links themselves never cross
the network: a task cuts its documents into chunks of bounded size and stores,
per chunk, the distinct id pairs with their counts, its segments as positions
in that list, and the documents as segment numbers. Only distinct pairs per
chunk are shuffled (a frequent pair is one row per chunk, and Spark splits it
further), the totals return to the chunk, and each chunk is put together on its
own.

Memory per task: a chunk, or one longer text. Defined results: null or empty
texts, and texts whose token bytes do not add up to a space and the text, have
no tokens: zeros and an empty ``groups``; null ``doc_id`` stays null; repeated
rows count each; an empty table gives no rows; other input columns are ignored.
"""

from __future__ import annotations

import functools
import gc
import hashlib
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import stored, text_or_empty
from candlewick.llm.token_bytes import segments, tokenizer

#: Segments of a chunk, and segments remembered per Python worker.
CHUNK_SEGMENTS = 1_000_000
REMEMBERED = 300_000
#: Longer segments are aligned each time.
SEGMENT_CHARS = 60


def common_slices(ends_a: list[int], ends_b: list[int]) -> list[tuple[int, int, int, int]]:
    """Index ranges (a from, a to, b from, b to) between the byte offsets where both lists end a token."""
    index_a = dict(zip(ends_a, range(1, len(ends_a) + 1)))
    index_b = dict(zip(ends_b, range(1, len(ends_b) + 1)))
    out, a, b = [], 0, 0
    for end in sorted(index_a.keys() & index_b.keys()):
        i, j = index_a[end], index_b[end]
        out.append((a, i, b, j))
        a, b = i, j
    return out


def slice_links(ends_a: list[int], ends_b: list[int], part: tuple[int, int, int, int]) -> list[tuple[int, int]]:
    """Index pairs of the tokens of one slice whose byte ranges overlap."""
    a, a_end, b, b_end = part
    if b_end - b == 1:
        return [(i, b) for i in range(a, a_end)]
    if a_end - a == 1:
        return [(a, j) for j in range(b, b_end)]
    out = []
    while a < a_end and b < b_end:
        out.append((a, b))
        step_a, step_b = ends_a[a] <= ends_b[b], ends_b[b] <= ends_a[a]
        a, b = a + step_a, b + step_b
    return out


def uncollected(work):
    """``work`` with the collector of reference cycles off. The alignments are tuples and lists without
    cycles, made by the hundred thousand, and looking through them again and again costs a tenth of
    the time; what is dropped is freed at once all the same."""
    @functools.wraps(work)
    def run(*args, **kw):
        on = gc.isenabled()
        gc.disable()
        try:
            return work(*args, **kw)
        finally:
            if on:
                gc.enable()
    return run


class Aligner:
    """Alignments of segments, the common ones remembered."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = tokenizer(path_a), tokenizer(path_b)
        self.by_segment = self.a.starts_at_space and self.b.starts_at_space
        self.known: dict[str, tuple | None] = {}

    def _sound(self, texts: list[str], ids_a: list, ids_b: list) -> list[bool]:
        """Whether both tokenizers' bytes of each text add up to a space and the text."""
        want = [b" " + t.encode() for t in texts]
        return [b"".join([self.a.bytes_of[i] for i in a]) == w == b"".join([self.b.bytes_of[i] for i in b])
                for w, a, b in zip(want, ids_a, ids_b)]

    def _new(self, texts: list[str]) -> dict[str, tuple | None]:
        """Alignment of each text: (groups, number of A ids, of B ids, of groups, id pairs of the links
        as ``a << 32 | b`` in native 64-bit integers); None if its bytes do not add up.

        The texts are laid end to end: a text's end is the end of a token on both sides, so the slices
        of all texts are found with one pair of dictionaries and dealt out to the texts again."""
        ids_a, ids_b = self.a.encode(texts), self.b.encode(texts)
        sound = self._sound(texts, ids_a, ids_b)
        if not all(sound):
            out = dict.fromkeys((t for t, ok in zip(texts, sound) if not ok))
            rest = [t for t, ok in zip(texts, sound) if ok]
            return out | (self._new(rest) if rest else {})
        flat_a, flat_b = list(chain.from_iterable(ids_a)), list(chain.from_iterable(ids_b))
        ends_a = list(accumulate([len(self.a.bytes_of[i]) for i in flat_a]))
        ends_b = list(accumulate([len(self.b.bytes_of[i]) for i in flat_b]))
        name_a, name_b = list(map(str, flat_a)), list(map(str, flat_b))
        groups, links, upto_a, upto_links = [], [], [], []
        for part in common_slices(ends_a, ends_b):
            a, i, b, j = part
            if i - a == 1 == j - b:
                groups.append(f"{name_a[a]}|{name_b[b]}")
                links.append(flat_a[a] << 32 | flat_b[b])
            else:
                groups.append(",".join(name_a[a:i]) + "|" + ",".join(name_b[b:j]))
                links += [flat_a[x] << 32 | flat_b[y] for x, y in slice_links(ends_a, ends_b, part)]
            upto_a.append(i)
            upto_links.append(len(links))
        packed = array("q", links).tobytes()
        last = np.searchsorted(np.array(upto_a), np.cumsum([len(x) for x in ids_a])).tolist()
        out, g, k = {}, 0, 0
        for t, a, b, end in zip(texts, ids_a, ids_b, last):
            to = upto_links[end]
            out[t] = (";".join(groups[g:end + 1]), len(a), len(b), end + 1 - g, packed[8 * k:8 * to])
            g, k = end + 1, to
        return out

    @uncollected
    def align(self, texts: list[str]) -> tuple[list[list[str]], dict[str, tuple]]:
        """Segments of each text (none if it has no tokens), and the alignment of each segment."""
        cuts = [segments(t) if self.by_segment and t else [t] if t else [] for t in texts]
        wanted = set().union(*cuts)
        found = {s: self.known[s] for s in wanted if s in self.known}
        missing = [s for s in wanted if s not in found]
        for at in range(0, len(missing), 20_000):
            found |= self._new(missing[at:at + 20_000])
        if len(self.known) < REMEMBERED:
            self.known.update((s, found[s]) for s in missing if len(s) <= SEGMENT_CHARS)
        bad = {s for s, x in found.items() if x is None}
        if bad:
            for i, c in enumerate(cuts):
                if not bad.isdisjoint(c):
                    whole = found.get(texts[i]) if len(c) == 1 else self._new([texts[i]])[texts[i]]
                    cuts[i] = [texts[i]] if whole else []
                    if whole:
                        found[texts[i]] = whole
        return cuts, found


class Chunk:
    """Documents of one chunk, as numbers of its distinct segments."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.segments: list[tuple] = []
        self.groups: list[str] = []     # of each segment
        self.docs: list[tuple] = []     # (doc_id, groups, segment numbers)
        self.size = 0

    def add(self, doc_id, cuts: list[str], found: dict[str, tuple], digest: bool) -> None:
        numbers = list(map(self.number.get, cuts))
        if None in numbers:
            for i, s in enumerate(cuts):
                if numbers[i] is None:
                    numbers[i] = self.number.setdefault(s, len(self.segments))
                    if numbers[i] == len(self.segments):
                        self.segments.append(found[s])
                        self.groups.append(found[s][0])
        groups = ";".join([self.groups[n] for n in numbers])
        if digest and cuts:
            groups = hashlib.sha256(groups.encode()).hexdigest()
        self.docs.append((doc_id, groups, np.array(numbers, dtype=np.uint32)))
        self.size += len(cuts)

    def rows(self, chunk: int) -> Iterator[dict]:
        """One row per document and one with the chunk's distinct pairs and its segments' places in them."""
        n_a, n_b, n_groups, n_links = (np.array([f(s) for s in self.segments], dtype=np.int64) for f in (
            lambda s: s[1], lambda s: s[2], lambda s: s[3], lambda s: len(s[4]) // 8))
        used = np.zeros(len(self.segments), dtype=np.int64)
        for doc_id, groups, numbers in self.docs:
            np.add.at(used, numbers, 1)
            yield {"chunk": chunk, "doc_id": doc_id, "groups": groups, "numbers": numbers.tobytes(),
                   **{k: int(x[numbers].sum()) for k, x in (("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups),
                                                            ("n_links", n_links))}}
        links = np.frombuffer(b"".join([s[4] for s in self.segments]), np.int64)
        pairs, place = np.unique(links, return_inverse=True)
        count = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(count, place, np.repeat(used, n_links))
        yield {"chunk": chunk, "pairs": pairs, "counts": count, "places": place.astype(np.uint32).tobytes(),
               "numbers": n_links.astype(np.uint32).tobytes()}


CHUNKS = ("chunk long, doc_id long, groups string, numbers binary, n_a long, n_b long, n_groups long, n_links long, "
          "pairs array<long>, counts array<long>, places binary")


def _chunks(path_a: str, path_b: str, digest: bool, chunk_segments: int):
    def run(batches: Iterator):
        import pyarrow as pa
        from pyspark import TaskContext

        number, integers = pa.int64(), pa.list_(pa.int64())
        schema = pa.schema([("chunk", number), ("doc_id", number), ("groups", pa.string()), ("numbers", pa.binary()),
                            *((k, number) for k in ("n_a", "n_b", "n_groups", "n_links")),
                            ("pairs", integers), ("counts", integers), ("places", pa.binary())])
        aligner = Aligner(path_a, path_b)
        chunk, name = Chunk(), TaskContext.get().partitionId() << 33

        def out():
            rows, size = [], 0
            for r in chunk.rows(name):
                rows.append(r)
                size += len(r.get("groups", "")) + len(r["numbers"])
                if size > 1 << 23:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(texts), 200):
                cuts, found = aligner.align(texts[at:at + 200])
                for doc_id, c in zip(ids[at:at + 200], cuts):
                    chunk.add(doc_id, c, found, digest)
                    if chunk.size >= chunk_segments:
                        yield from out()
                        chunk, name = Chunk(), name + 1
        if chunk.docs:
            yield from out()

    return run


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups string")


def _finish(chunk, totals):
    """Sums of one chunk: its rows, and (place, total, best) of its distinct pairs."""
    import pyarrow as pa
    import pyarrow.compute as pc

    total = np.empty(totals.num_rows, dtype=np.int64)
    best = np.empty(totals.num_rows, dtype=np.int64)
    at = totals["place"].to_numpy()
    total[at], best[at] = totals["total"].to_numpy(), totals["best"].to_numpy().astype(np.int64)
    is_doc = chunk["places"].is_null()
    docs, (own,) = chunk.filter(is_doc), chunk.filter(pc.invert(is_doc)).to_pylist()
    ends = np.cumsum(np.frombuffer(own["numbers"], np.uint32).astype(np.int64))
    places = np.frombuffer(own["places"], np.uint32)

    def by_segment(values):
        upto = np.concatenate([[0], np.cumsum(values[places])])
        return np.diff(upto[np.concatenate([[0], ends])])

    total, best = by_segment(total), by_segment(best)
    numbers = [np.frombuffer(x, np.uint32) for x in docs["numbers"].to_pylist()]
    sums = [pa.array([int(v[n].sum()) for n in numbers], pa.int64()) for v in (best, total)]
    return pa.table([*(docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), *sums, docs["groups"]],
                    names=[c.split()[0] for c in ALIGNED.split(", ")])


def align(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, digest: bool = False,
          chunk_segments: int = CHUNK_SEGMENTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Alignment of every row: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose id pair is the
    most frequent one of its B id, ties included), count_sum (how often the links' id pairs are linked
    in all texts, summed) and ``groups`` as ``a1,a2|b1;a3|b2,b3``, or their SHA-256 with ``digest``.
    """
    aligned = stored(text_or_empty(docs, id_col, text_col).mapInArrow(
        _chunks(tokenizer_a, tokenizer_b, digest, chunk_segments), CHUNKS), "aligned")
    own = aligned.where("places is not null")
    counts = (own.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
              .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("total")))
    b = F.col("pair").bitwiseAND((1 << 32) - 1)
    counts = stored(counts.withColumn("b", b), "pair-counts")
    most = counts.groupBy("b").agg(F.max("total").alias("most"))
    counts = (counts.join(F.broadcast(most), "b")  # one row per id of the second vocabulary
              .select("pair", "total", (F.col("total") == F.col("most")).alias("best")))
    back = (own.select("chunk", F.posexplode("pairs").alias("place", "pair")).join(counts, "pair")
            .select(F.col("chunk").alias("of_chunk"), "place", "total", "best"))
    rows = aligned.select("chunk", "doc_id", "groups", "numbers", "n_a", "n_b", "n_groups", "n_links", "places")
    return rows.groupBy("chunk").cogroup(back.groupBy("of_chunk")).applyInArrow(_finish, ALIGNED)
