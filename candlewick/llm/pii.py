"""Personal data by weak supervision.

Certain patterns give spans that always stay. Around them, loose patterns give
candidates; six labelers (strict pattern, gazetteer, context words, edges,
shape, dummy numbers) vote on each. Expectation-maximisation estimates, without
any label, how reliable each labeler is for each kind, from how often all
combinations of votes occur in the corpus; its posteriors train the final span
classifier (logistic regression), which adds candidates to the certain spans.

Scale: texts are read once and never shuffled. A candidate's kind, form and
votes are one number below ``CODES`` (about 17,000), so the whole corpus is
counted, and the driver fits both models on at most that many weighted rows.

Defined results: null or empty text has no span; null ``doc_id`` stays null;
repeated rows are searched each; an empty table gives no rows and a classifier
that adds nothing; other input columns are ignored. What the strict pattern's
check refutes is never added as it stands. An added span that overlaps
a certain one must be of its kind and contain it; among added spans that overlap, the best score stays,
then the longer, then the earlier one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import stored, text_or_empty
from candlewick.llm.pii_spans import FORMS, KINDS, LABELERS, STRICT, candidates, code, decode, votes

#: Certain spans and candidates of a document: kind number, start, end (code points), and the candidate's code.
FOUND = "doc_id long, certain array<struct<kind:int,start:long,end:long>>, " \
        "candidates array<struct<kind:int,start:long,end:long,code:int>>"
SPANS = "doc_id long, spans array<struct<kind:string,start:long,end:long,certain:boolean>>"


def _find(batches: Iterator):
    import pyarrow as pa

    span = [("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]
    schema = pa.schema([("doc_id", pa.int64()), ("certain", pa.list_(pa.struct(span))),
                        ("candidates", pa.list_(pa.struct([*span, ("code", pa.int32())])))])
    for batch in batches:
        certain, possible = [], []
        for text in batch.column(1).to_pylist():
            good, more = candidates(text)
            certain.append([{"kind": KINDS.index(k), "start": a, "end": b} for k, a, b in good])
            possible.append([{"kind": KINDS.index(k), "start": a, "end": b,
                              "code": code(k, form, votes(text, k, a, b, form))} for k, a, b, form in more])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(certain, schema.field(1).type),
                                          pa.array(possible, schema.field(2).type)], schema=schema)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Certain spans and candidates of every row (see ``FOUND``)."""
    return text_or_empty(docs, id_col, text_col).mapInArrow(_find, FOUND)


def vote_counts(found: DataFrame) -> dict[int, int]:
    """How often each combination of kind, form and votes occurs in the corpus."""
    rows = found.select(F.explode("candidates.code").alias("code")).groupBy("code").count().collect()
    return {r["code"]: r["count"] for r in rows}


#: What is believed of a labeler before any vote is seen: P(against, none, for) of spans that are not
#: real and of real ones; worth ``PRIOR_VOTES`` votes. The strict pattern is trusted more than the others.
PRIOR = np.array([[[0.60, 0.35, 0.05], [0.01, 0.29, 0.70]]] + [[[0.45, 0.35, 0.20], [0.10, 0.35, 0.55]]] * 5)
PRIOR_VOTES = 20.0


def reliabilities(counts: dict[int, int], kind: str, rounds: int = 50):
    """Expectation-maximisation on one kind's votes.

    Returns (share of real spans, P(vote | not real, real) of each labeler as an array
    ``[class, labeler, vote + 1]``, posterior of each code). Starts from the prior beliefs.
    """
    codes = sorted(c for c in counts if decode(c)[0] == kind)
    share, p = 0.5, PRIOR.transpose(1, 0, 2)
    if not codes:
        return share, p, {}
    v = np.array([decode(c)[2] for c in codes])
    n = np.array([counts[c] for c in codes], dtype=float)
    for _ in range(rounds):
        log = np.log(p)[:, np.arange(len(LABELERS)), v + 1].sum(axis=2)
        odds = log[1] - log[0] + np.log(share / (1 - share))
        real = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        share = (n @ real + 1) / (n.sum() + 2)
        p = PRIOR_VOTES * PRIOR.transpose(1, 0, 2)
        for k, member in enumerate((1 - real, real)):
            for x in (-1, 0, 1):
                p[k, :, x + 1] += (n * member) @ (v == x)
        p = p / p.sum(axis=2, keepdims=True)
    return share, p, dict(zip(codes, real))


def _features(c: int) -> np.ndarray:
    kind, form, vote = decode(c)
    x = np.zeros(1 + len(FORMS) + 2 * len(LABELERS))
    x[0] = x[1 + form] = 1
    for i, v in enumerate(vote):
        if v:
            x[1 + len(FORMS) + 2 * i + (v > 0)] = 1
    return x


def fit(counts: dict[int, int], rounds: int = 50, penalty: float = 1.0) -> dict[str, list[float]]:
    """Weights of the span classifier per kind, trained on the posteriors (Newton's method; the rows
    are combinations of votes, weighted by the logarithm of their counts so that no hot one rules)."""
    model = {}
    for kind in KINDS:
        posterior = reliabilities(counts, kind)[2]
        if not posterior:
            continue
        x = np.array([_features(c) for c in posterior])
        y = np.array(list(posterior.values()))
        n = np.log1p([counts[c] for c in posterior])
        w = np.zeros(x.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
            slope = x.T @ (n * (p - y)) + penalty * 0.1 * w
            curve = (x * (n * p * (1 - p))[:, None]).T @ x + penalty * 0.1 * np.eye(len(w))
            w -= np.linalg.solve(curve, slope)
        model[kind] = w.tolist()
    return model


def span_score(model: dict[str, list[float]], c: int) -> float:
    """Probability that a candidate is real; 0 for a kind without a model."""
    w = model.get(decode(c)[0])
    return 0.0 if w is None else float(1 / (1 + np.exp(-np.clip(_features(c) @ np.array(w), -50, 50))))


def chosen(certain: list[dict], possible: list[dict], score: dict[int, float], least: float) -> list[tuple]:
    """All spans of a document as (start, kind number, end, is certain), in order."""
    out = [(s["start"], s["kind"], s["end"], True) for s in certain]
    added = []
    for c in sorted(possible, key=lambda c: (-score[c["code"]], c["start"] - c["end"], c["start"], c["kind"])):
        _, form, vote = decode(c["code"])
        if score[c["code"]] < least or form == STRICT or vote[0] < 0:
            continue
        a, b, k = c["start"], c["end"], c["kind"]
        if any(x < b and a < y and not (j == k and a <= x and y <= b) for x, j, y, _ in out):
            continue
        if any(x < b and a < y for x, _, y, _ in added):
            continue
        added.append((a, k, b, False))
    return sorted(out + added)


def _choose(score: dict[int, float], least: float):
    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            spans = [[{"kind": KINDS[k], "start": a, "end": b, "certain": sure}
                      for a, k, b, sure in chosen(c, p, score, least)]
                     for c, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                       ("certain", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    return run


def spans(docs: DataFrame, least: float = 0.9, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and all spans of every row, by start and kind; ``certain`` tells pattern from classifier.
    ``least`` is the score from which a candidate is added."""
    found = stored(find(docs, id_col, text_col), "pii-candidates")
    counts = vote_counts(found)
    model = fit(counts)
    score = {c: span_score(model, c) for c in counts}
    return found.mapInArrow(_choose(score, least), SPANS)
