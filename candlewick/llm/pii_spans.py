"""Personal data in one text: certain spans by pattern, candidates, and the labelers' votes on each.

The patterns run in time linear in the text: runs of digits or address
characters are entered at their start only and never given back.
"""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")
#: How a candidate came about; ``STRICT`` is the certain pattern itself.
FORMS = ("strict", "failed", "part", "spelled", "wide", "plain")
STRICT, FAILED, PART, SPELLED, WIDE, PLAIN = range(6)
LABELERS = ("pattern", "gazetteer", "context", "edges", "shape", "dummy")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_GROUP = re.compile(r"[0-9]+")
_SPELLED_HINT = re.compile(r"[\[({]\s?at\s?[\])}]| at \S{1,63} dot ", re.I)
_SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?:\s?[\[({]\s?at\s?[\])}]\s?| at )"
    r"[A-Za-z0-9-]{1,63}(?:(?:\s?[\[({]\s?dot\s?[\])}]\s?| dot |\.)[A-Za-z0-9-]{1,63})+", re.I)
_IP6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
_WIDE_CARD = re.compile(r"(?<![0-9])[0-9]{4}([._/ ]| {2})(?:[0-9]{4}\1){2}[0-9]{4}(?![0-9])")
_PLAIN_PHONE = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"
                          r"|(?<![0-9+(.-])00[0-9]{1,3}(?:[ -][0-9]{2,5}){2,4}(?![0-9])")
_CODE_BEFORE = re.compile(r"\+[0-9]{1,3}[ .-]?$")

# Gazetteers and context words: short lists of our own.
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io co me tv us uk de fr es it nl be ch at se no dk fi pl "
                        "pt ie ca mx br ar cl au nz jp cn kr in ru tr za eu example test".split())
COUNTRY_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 "
                          "63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
CONTEXT = {
    "email": ({"email", "e-mail", "mail", "contact", "write", "reach", "correo", "courriel"}, {"package", "git", "ssh"}),
    "ip": ({"ip", "address", "host", "server", "client", "login", "from"}, {"version", "release", "v", "section", "figure"}),
    "card": ({"card", "visa", "mastercard", "amex", "credit", "payment", "karte", "tarjeta", "carte"},
             {"isbn", "order", "invoice", "tracking", "serial", "id", "ean", "token", "hash"}),
    "phone": ({"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "teléfono", "whatsapp"},
              {"isbn", "order", "invoice", "serial", "id", "version"}),
}
_WORDS = re.compile(r"[\w-]+")
_WORD_CHAR = re.compile(r"\w")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(s: str) -> str:
    return "".join(_GROUP.findall(s))


def emails(text: str) -> list[tuple[int, int]]:
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
        at = text.find("@", at + 1)
    return out


def certain(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(spans of the certain patterns that pass their check, those that fail it)."""
    good, failed = [("email", *s) for s in emails(text)], []
    if "." in text:
        for m in _IP.finditer(text):
            ok = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
            (good if ok else failed).append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = _digits(m[0])
            (good if 14 <= len(d) <= 19 and luhn(d) else failed).append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        (good if 10 <= len(_digits(m[0])) <= 15 else failed).append(("phone", *m.span()))
    return good, failed


def _runs(text: str, start: int, end: int, least: int, most: int, anchored: bool):
    """Spans of consecutive digit groups with ``least`` to ``most`` digits in all."""
    groups = [m.span() for m in _GROUP.finditer(text, start, end)]
    for i in range(1 if anchored else len(groups)):
        n = 0
        for j in range(i, len(groups)):
            n += groups[j][1] - groups[j][0]
            if n > most:
                break
            if n >= least:
                yield start if anchored else groups[i][0], groups[j][1]


def candidates(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, int]]]:
    """(certain spans, candidates as (kind, start, end, form)); the certain spans are candidates too."""
    good, failed = certain(text)
    out = [(*s, STRICT) for s in good] + [(*s, FAILED) for s in failed]
    for kind, a, b in failed:
        if kind == "card":
            out += [("card", x, y, PART) for x, y in _runs(text, a, b, 13, 19, False)]
        elif kind == "phone":
            out += [("phone", x, y, PART) for x, y in _runs(text, a, b, 10, 15, True)]
    for kind, a, b in good:
        if kind == "email":
            start = a
            while start and a - start < 64 and (text[start - 1] in _LOCAL or text[start - 1].isalpha()):
                start -= 1
            if start < a:
                out.append(("email", start, b, WIDE))
    if _SPELLED_HINT.search(text):
        out += [("email", *m.span(), SPELLED) for m in _SPELLED.finditer(text)]
    if ":" in text:
        out += [("ip", *m.span(), WIDE) for m in _IP6.finditer(text) if m[0].count(":") == 7 or "::" in m[0]]
    out += [("card", *m.span(), WIDE) for m in _WIDE_CARD.finditer(text)]
    out += [("phone", *m.span(), PLAIN) for m in _PLAIN_PHONE.finditer(text)
            if not _CODE_BEFORE.search(text, max(0, m.start() - 6), m.start())]
    return good, list(dict.fromkeys(out))


def _pattern(kind: str, span: str, form: int) -> int:
    if form in (STRICT, FAILED):
        return 1 if form == STRICT else -1
    if kind == "card":
        return 1 if luhn(_digits(span)) else -1
    if kind == "ip":
        import ipaddress

        try:
            return 1 if ipaddress.IPv6Address(span).is_global else 0
        except ValueError:
            return -1
    return 0


def _gazetteer(kind: str, span: str) -> int:
    if kind == "email":
        return 1 if _WORDS.findall(span)[-1].lower() in TOP_DOMAINS else -1
    d = _digits(span)
    if kind == "ip":
        first = span.split(".")[0].lstrip("0")
        return 0 if ":" in span else -1 if first in ("", "127", "255") else 1
    if kind == "card":
        known = (d[0] == "4" and len(d) in (13, 16, 19) or d[:2] in ("51", "52", "53", "54", "55", "34", "37", "65")
                 or d[:4] == "6011" or "2221" <= d[:4] <= "2720")
        return 1 if known else -1
    if not span.startswith(("+", "00")):
        return 0
    d = d.removeprefix("00") if span.startswith("00") else d
    return 1 if any(d.startswith(c) for c in (d[:1], d[:2]) if c in COUNTRY_CODES) else -1


def _context(kind: str, text: str, start: int) -> int:
    words = {w.lower() for w in _WORDS.findall(text, max(0, start - 40), start)[-3:]}
    good, bad = CONTEXT[kind]
    return -1 if words & bad else 1 if words & good else 0


def _edges(kind: str, text: str, start: int, end: int) -> int:
    glued = [bool(_WORD_CHAR.match(text, i)) for i in (start - 1, end) if 0 <= i < len(text)]
    dotted = (text[end:end + 1] in (".", "-", ":") and text[end + 1:end + 2].isdigit()
              or start > 1 and text[start - 1] in ".-:" and text[start - 2].isdigit())
    return -1 if any(glued) or dotted and kind != "email" else 1


def _shape(kind: str, span: str, form: int) -> int:
    groups = [len(g) for g in _GROUP.findall(span)]
    if kind == "card":
        return 1 if groups in ([4, 4, 4, 4], [4, 6, 5], [4, 4, 4, 4, 3]) or len(groups) == 1 and groups[0] <= 16 else -1
    if kind == "phone":
        if groups[:1] == [1] and span.startswith("+"):
            return 1 if groups in ([1, 3, 3, 4], [1, 10]) else -1
        return 1 if form == PLAIN or 2 <= len(groups) <= 5 and 2 <= groups[-1] <= 10 and sum(groups) >= 10 else -1
    if kind == "ip":
        return 1 if form == WIDE or max(groups) <= 3 else -1
    local = re.split(r"@|\W+at\W+", span, maxsplit=1, flags=re.I)[0].strip()
    return 1 if 1 <= len(local) <= 64 and local[0] not in ".-" and ".." not in span else -1


def _dummy(kind: str, span: str) -> int:
    if kind in ("card", "phone"):
        d = _digits(span)
        return -1 if len(set(d)) <= 2 or d in "01234567890123456789" else 0
    return 0


def votes(text: str, kind: str, start: int, end: int, form: int) -> tuple[int, ...]:
    """One vote per labeler: 1 for, -1 against, 0 none."""
    span = text[start:end]
    return (_pattern(kind, span, form), _gazetteer(kind, span), _context(kind, text, start),
            _edges(kind, text, start, end), _shape(kind, span, form), _dummy(kind, span))


def code(kind: str, form: int, vote: tuple[int, ...]) -> int:
    """A candidate's kind, form and votes as one number below ``CODES``."""
    n = KINDS.index(kind) * len(FORMS) + form
    for v in vote:
        n = 3 * n + v + 1
    return n


#: Bound on the different candidates there can be.
CODES = len(KINDS) * len(FORMS) * 3 ** len(LABELERS)


def decode(n: int) -> tuple[str, int, tuple[int, ...]]:
    vote = []
    for _ in LABELERS:
        n, v = divmod(n, 3)
        vote.append(v - 1)
    return KINDS[n // len(FORMS)], n % len(FORMS), tuple(reversed(vote))
