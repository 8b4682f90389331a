"""Personal data: certain spans against plain patterns, the labelers' reliabilities, what the classifier adds."""

import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.llm import pii, registry
from candlewick.llm.common import table
from candlewick.llm.pii_spans import CODES, KINDS, candidates, certain, code, decode, luhn, votes

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def digits_sum(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total


def plainly(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                  "card": lambda: 14 <= len(d) <= 19 and digits_sum(d) % 10 == 0,
                  "phone": lambda: 10 <= len(d) <= 15}[kind]()
            if ok:
                out.append((m.start(), KINDS.index(kind), m.end()))
    return sorted(out)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(
    st.sampled_from(["@", ".", " ", "-", "+", "+1 (509) 555-6973", "4104321470856409", "10.0.0.255", "256.1.1.1", "a@b.c",
                     "x.y@z.example.com", "é", "0", "00", "1234", "(", ")", "a", "\n", "4539-1488 0343 6467"]),
    st.text(alphabet="0123456789.+- @a", max_size=8)), max_size=14).map("".join))
def test_certain_spans(text):
    assert sorted((a, KINDS.index(k), b) for k, a, b in certain(text)[0]) == plainly(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 200_000, "+" * 400_000, "+1" + "(" * 400_000,
                 "1 " * 200_000, "1:" * 200_000, "a." * 200_000 + "@", " at " * 100_000 + " at a dot "):
        candidates(text)


def test_codes_round_trip():
    for n in range(0, CODES, 7):
        assert code(*decode(n)) == n
    assert luhn("4539148803436467") and not luhn("4539148803436468")


def test_reliabilities_of_planted_labelers():
    """Labelers of known accuracy on a known truth: the estimates find them."""
    import random

    rng, counts = random.Random(5), {}
    right = (0.95, 0.9, 0.8, 0.9, 0.85, 0.7)
    for _ in range(20_000):
        truth = rng.random() < 0.6
        vote = tuple((1 if truth else -1) if rng.random() < r else (-1 if truth else 1) for r in right)
        c = code("phone", 2, vote)
        counts[c] = counts.get(c, 0) + 1
    share, p, posterior = pii.reliabilities(counts, "phone")
    assert abs(share - 0.6) < 0.03
    for i, r in enumerate(right):
        assert abs(p[1, i, 2] - r) < 0.04 and abs(p[0, i, 0] - r) < 0.04
    model = pii.fit(counts)
    assert all((pii.span_score(model, c) > 0.5) == (x > 0.5) for c, x in posterior.items() if abs(x - 0.5) > 0.2)


FILL = [(100 + i, f"words here {i} then +1 (5{i % 90 + 10}) 555-69{i % 90 + 10} and 41.{i}.3.7 or ann.{i}@mail{i}.example.com "
         f"while {n} stays; id=\"ab{i}c41043214708564{i % 90 + 10}\"")
        for i, n in enumerate(str(x) for x in range(4104321470850000, 4104321470859999) if luhn(str(x)))][:200]


def test_what_the_classifier_adds(make_docs):
    """A phone number and a card that run into other numbers; no part of a hexadecimal token."""
    rows = FILL + [(1, "ask +1 (826) 555-4081 190.137.223.204 now"), (2, "ask 4104321470856409 27 now"),
                   (3, 'token = "a3a1b97e25e5c1059743005344d08a6b96b1869b"'), (4, "call 987-555-6973 today"),
                   (5, "version 1.2.3.4.5 of 2024-01-02 10 11 12 13"), (6, "ann [at] mail [dot] example [dot] com"),
                   (7, None), (8, ""), (None, "a@b.com"), (9, "nothing"), (9, "nothing")]
    got = {}
    for r in pii.spans(make_docs(rows)).collect():
        got.setdefault(r["doc_id"], []).append([(s["kind"], s["start"], s["end"], s["certain"]) for s in r["spans"]])
    assert got[1] == [[("phone", 4, 21, False), ("ip", 22, 37, True)]]
    assert got[2] == [[("card", 4, 20, False)]]
    assert got[3] == got[7] == got[8] == [[]] and got[9] == [[], []]
    assert got[4] == [[("phone", 5, 17, False)]]
    assert got[None] == [[("email", 0, 7, True)]]
    assert len(got) == 210


def test_empty_table(make_docs):
    assert pii.spans(make_docs([])).collect() == []
    assert pii.fit({}) == {} and pii.span_score({}, 0) == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    rows = registry.op13_pii(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        want = plainly(texts[r["doc_id"]])
        listed = [f"{KINDS[k]}:{a}:{b}" for a, k, b in want]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x[1] == i for x in want) for i in range(len(KINDS))]
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(listed) <= set(spans)
        for s in set(spans) - set(listed):
            kind, a, b = s.split(":")
            assert kind in ("card", "phone") and (kind == "phone" or luhn(texts[r["doc_id"]][int(a):int(b)]))
    assert zlib.crc32(b"1") and votes("x", "phone", 0, 1, 5)
