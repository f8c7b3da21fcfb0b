"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds of the base rules in their order, then those that the checks below add.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "secret")
#: An added span counts from this score on.
MIN_SCORE = 0.5
#: Characters before and after a span in which context words count.
NEAR = 48
#: Least entropy, in bits a character, of a run of letters and digits that may be a secret.
SECRET_BITS = 3.0

# Scores of a pattern alone, with its checksum, and for a context word nearby.
SCORES = {
    "email": (0.9, 0.9),
    "ip": (0.6, 0.6),
    "card": (0.2, 0.8),
    "phone": (0.5, 0.5),
    "iban": (0.2, 0.9),
    "ssn": (0.3, 0.3),
    "secret": (0.1, 0.4),
}
CONTEXT_BONUS = 0.3
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "credit", "debit", "visa", "mastercard", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security"),
    "secret": ("secret", "token", "key", "apikey", "password", "passwd", "credential", "bearer"),
}
# Account number lengths by country, as the IBAN registry lists them.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}

# The parts of the base patterns. Possessive repeats and the looks behind keep every scan linear: where the
# first character of a run does not lead to a match, no later one does.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-".decode())
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
# The rest of an account number of each length.
_IBAN_REST = {n: re.compile(rf"(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for n in sorted(set(IBAN_LENGTHS.values()))}
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+=*+")
_WORD = re.compile(r"[A-Za-z-]+")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """Whether a digit string passes the Luhn check."""
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def mod97(number: str) -> bool:
    """Whether an account number without blanks has its country's length and leaves 1 modulo 97."""
    if IBAN_LENGTHS.get(number[:2]) != len(number):
        return False
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from the sign outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        found = _DOMAIN.match(text, at + 1)
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if found and start < at:
            yield start, found.end()
            done = found.end()
        elif start < at:
            done = max(done, at)
        at = text.find("@", max(done, at + 1))


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[Span]:
    """Spans of the base rules: leftmost, not overlapping within a kind; failing matches are dropped."""
    out: list[Span] = [("email", *s) for s in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def _ibans(text: str) -> Iterator[Span]:
    """Account numbers whose checksum holds; the search goes on behind each, and one character on after a failed check."""
    at = 0
    while m := _IBAN.search(text, at):
        at = m.start() + 1
        rest = _IBAN_REST.get(IBAN_LENGTHS.get(m[0][:2], 0))
        whole = rest.match(text, m.end()) if rest else None
        if whole and mod97((m[0] + whole[0]).replace(" ", "")):
            at = whole.end()
            yield "iban", m.start(), at


def entropy(run: str) -> float:
    """Bits a character of a run of characters, by how often each is in it."""
    return sum(n * math.log2(len(run) / n) for n in Counter(run).values()) / len(run)


def _secrets(text: str) -> Iterator[Span]:
    """Long runs of letters and digits as mixed as chance makes them; only a context word nearby makes one a secret."""
    for m in _SECRET.finditer(text):
        if _DIGIT.search(m[0]) and re.search("[A-Za-z]", m[0]) and entropy(m[0]) >= SECRET_BITS:
            yield "secret", *m.span()


def added_spans(text: str) -> list[Span]:
    """Candidates of the added kinds that pass their checksum or entropy, where there is one."""
    if not _DIGIT.search(text):
        return []
    return [*_ibans(text), *(("ssn", *m.span()) for m in _SSN.finditer(text)), *_secrets(text)]


def score(text: str, kind: str, start: int, end: int) -> float:
    """Score of a span: its pattern, its checksum, and a bonus for a context word on either side."""
    alone, checked = SCORES[kind]
    value = checked if kind in ("card", "iban", "secret") else alone
    around = f"{text[max(0, start - NEAR) : start]} {text[end : end + NEAR]}".lower()
    if not set(_WORD.findall(around)).isdisjoint(CONTEXT[kind]):
        value += CONTEXT_BONUS
    return min(1.0, value)


def find(text: str) -> list[tuple[str, int, int, float, bool]]:
    """Spans with score and whether a base rule found them, by kind and start.

    Base spans stay whatever their score; an added span needs ``MIN_SCORE``.
    """
    spans = [(*s, score(text, *s), True) for s in base_spans(text)]
    added = [(*s, score(text, *s), False) for s in added_spans(text)]
    kinds = {k: i for i, k in enumerate(BASE + ADDED)}
    return sorted(spans + [s for s in added if s[3] >= MIN_SCORE], key=lambda s: (kinds[s[0]], s[1]))


def redact(text: str, spans: list[tuple[str, int, int, float, bool]]) -> str:
    """The text with a mark of its kind for each span; spans that overlap are replaced as one, by the first's kind."""
    out, done = [], 0
    last = None
    for kind, start, end, *_ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if last is not None and start < done:
            done = max(done, end)
            continue
        out += [text[done:start], f"[{kind.upper()}]"]
        last, done = kind, end
    return "".join([*out, text[done:]])


def _joined(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, *_ in spans)


def find_pii(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Columns key, a count for each base kind, ``base_sha256``, ``spans``, ``scores`` and ``redacted``.

    Offsets are code points, the end is exclusive. Null counts as empty: no spans,
    the checksum of the empty string, and a null ``redacted``. Rows are
    independent: no shuffle.
    """
    fields = [f"n_{k} long" for k in BASE]
    fields += ["base_sha256 string", "spans string", "scores array<double>", "redacted string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [find(t) if t else [] for t in texts]
            base = [[s for s in f if s[4]] for f in found]
            counts = [pa.array([sum(s[0] == k for s in f) for f in base], pa.int64()) for k in BASE]
            yield pa.record_batch(
                [
                    batch.column(0),
                    *counts,
                    pa.array([hashlib.sha256(_joined(f).encode()).hexdigest() for f in base], pa.string()),
                    pa.array([_joined(f) for f in found], pa.string()),
                    pa.array([[s[3] for s in f] for f in found], pa.list_(pa.float64())),
                    pa.array([redact(t, f) if f else t for t, f in zip(texts, found, strict=True)], pa.string()),
                ],
                ["key", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "scores", "redacted"],
            )

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, ", ".join([f"key {kind}", *fields])).withColumnRenamed("key", key)


def redact_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` with spans in the text replaced by marks such as ``[EMAIL]``; null stays null."""

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([redact(t, find(t)) if t else t for t in texts.to_pylist()], pa.string())

    return df.withColumn(text, clean(F.col(f"`{text}`")))
