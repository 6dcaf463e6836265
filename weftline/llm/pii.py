"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.

The four base kinds (``email``, ``ip``, ``card``, ``phone``) follow fixed rules, and a base span
stays whatever its score.  Two further kinds are kept only with enough evidence: ``iban``
(mod-97) and ``idnum`` (three, two and four digits, by context words).  Every pattern is
written so that one pass over the text suffices: a match can only start where the run of
characters it needs starts, so very long runs cost no repeated attempts.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from weftline.llm import words as W

#: fixed order of kinds
KINDS = ("email", "ip", "card", "phone", "iban", "idnum")
BASE_KINDS = KINDS[:4]
FIELDS = ("n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
          "spans array<struct<kind:string,start:int,stop:int,score:double>>")


_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")
_IDNUM = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: fixed values: score before context, and words that raise it
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.85, "idnum": 0.4}
CONTEXT = {
    "email": ("mail", "email", "e-mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "idnum": ("ssn", "social", "security", "tax", "id"),
}
NEAR, RAISE, MIN_SCORE = 40, 0.3, 0.7
_WORD = re.compile(r"[^\W\d_][\w-]*")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    code = iban.replace(" ", "")
    if not 15 <= len(code) <= 34:
        return False
    rest = 0
    for c in code[4:] + code[:4]:
        v = int(c, 36)
        rest = (rest * (100 if v > 9 else 10) + v) % 97
    return rest == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")




def _emails(text: str):
    """Looks only at the surroundings of each at sign, so that long words cost nothing."""
    at, place = 0, text.find("@")
    while place >= 0:
        start = place
        while start > at and (text[start - 1] in _LOCAL):
            start -= 1
        d = _DOMAIN.match(text, place + 1) if start < place else None
        if d:
            yield start, d.end()
            at = d.end()
        else:
            at = place + 1
        place = text.find("@", at)


_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def _score(text: str, kind: str, start: int, stop: int) -> float:
    """Prior of the kind, raised when one of its context words stands near."""
    around = text[max(0, start - NEAR):start] + "\n" + text[stop:stop + NEAR]
    near = any(w.lower() in CONTEXT[kind] for w in _WORD.findall(around))
    return round(min(1.0, PRIOR[kind] + (RAISE if near else 0.0)), 3)


def find_spans(text: str) -> list[tuple[int, str, int, float]]:
    """All spans of one text as (start, kind, stop, score), by start and then kind."""
    found = []
    for s, e in _emails(text):
        found.append((s, "email", e))
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p) < 4 or not p[:-3].strip("0") for p in m[0].split(".")) and all(int(p[-3:]) <= 255 for p in m[0].split(".")):
                found.append((m.start(), "ip", m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = _digits(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                found.append((m.start(), "card", m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), "phone", m.end()))
    spans = [(s, k, e, _score(text, k, s, e)) for s, k, e in found]
    for kind, pattern, valid in (("iban", _IBAN, mod97), ("idnum", _IDNUM, lambda _: True)):
        for m in pattern.finditer(text):
            if valid(m[0]) and (score := _score(text, kind, m.start(), m.end())) >= MIN_SCORE:
                spans.append((m.start(), kind, m.end(), score))
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[1])))


def _arrays(texts: pa.Array) -> list[pa.Array]:
    texts = pc.fill_null(texts, "")
    # only texts with a digit or an at sign can hold a span
    maybe = pc.match_substring_regex(texts, "[0-9@]").to_pylist()
    spans = [find_spans(t.as_py()) if m else [] for t, m in zip(texts, maybe)]
    counts = [pa.array([sum(s[1] == k for s in row) for row in spans], pa.int64()) for k in BASE_KINDS]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))
    rows = [[{"kind": k, "start": s, "stop": e, "score": v} for s, k, e, v in row] for row in spans]
    return [*counts, pa.array(rows, kind)]


def personal_data(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Spans of personal data in each whole text.

    Rows ``(row, n_email, n_ip, n_card, n_phone, spans)``: ``row`` packs the carried columns,
    ``spans`` are (kind, start, stop, score) in code points, stop exclusive, by start and
    then kind.

    Null and empty texts have no spans.  Kinds are judged apart, so spans of two kinds may
    overlap.  Repeated rows give repeated results; an empty table gives no rows.  There is no
    limit on the text length.
    """
    return W.text_map(docs, text, carry, _arrays, FIELDS)


def masked(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """Text with each span replaced by its kind in brackets; overlapping spans become one."""
    if not text or not spans:
        return text
    out, at = [], 0
    for start, stop, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def _mask_arrays(texts: pa.Array) -> list[pa.Array]:
    out = [None if t is None else masked(t, [(s, e, k) for s, k, e, _ in find_spans(t)]) for t in texts.to_pylist()]
    return [pa.array(out, pa.string())]


def mask_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns with personal data in ``text`` masked; null stays null."""
    done = W.text_map(docs, text, None, _mask_arrays, "masked string")
    return done.select(*[W.column("row").getField(c).alias(c) if c != text else W.column("masked").alias(c)
                         for c in docs.columns])
