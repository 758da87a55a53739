"""Personal data: anchors found by one automaton, boundaries by parsers around each anchor.

An Aho-Corasick automaton reports at-signs, plus signs, digits, scheme marks and identifier cues in
one pass over a whole text. At each anchor a parser that looks only at the characters around it
expands the span and validates it. Base kinds follow their patterns exactly, leftmost and without
overlap within a kind; a match that fails its check is dropped and its characters stay used up.

Added kinds: ``login`` (an address with a user name before its host), ``account`` and ``secret`` (a value
behind a password or key cue). An account stands directly behind a cue that is a word of its own, save
for a sign or a word like "number", and is one of: an IBAN whose checksum holds, a social security number
of valid parts, a passport number behind its cue, or five to 20 digits with single blanks or hyphens.
Prose behind a cue is left alone. Parsers read a bounded number of characters or move past what they
have read, so the time is linear in the text, whatever it repeats.

Null and empty texts have no spans. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.llm import texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "account", "secret")
ACCOUNT_CUES = ("iban", "account", "acct", "ssn", "passport")
SECRET_CUES = ("password", "passwd", "pwd", "api_key", "apikey", "secret", "token")

_LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SCHEME = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-"
_LOGIN = re.compile(r"://[^\s/@?#]+@[^\s/@?#]+")
# What may stand between a cue and its value; every repetition is bounded.
_FILLER = re.compile(r"[\x20\t]{0,4}(?:(?:number|no\.?|nr\.?|is|id)(?![A-Za-z0-9])[\x20\t]{0,4})?[:=#]?[\x20\t]{0,4}", re.I)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?!000|666|9)[0-9]{3}([\x20-]?)(?!00)[0-9]{2}\1(?!0000)[0-9]{4}")
_PASSPORT = re.compile(r"[A-Z]{0,2}[0-9]{6,9}")
_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9]){4,19}")
_SECRET = re.compile(r"[\x20\t]*[:=][\x20\t]*(\S{6,})")

Span = tuple[str, int, int]


def _automaton() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for sign in ("@", "+", *"0123456789"):
        made.add_word(sign, (sign if sign in "@+" else "digit", 1))
    made.add_word("://", ("scheme", 3))
    for what, cues in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                made.add_word(form, (what, len(form)))
    made.make_automaton()
    return made


_ANCHORS = _automaton()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _valid_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(match: re.Match) -> str:
    return "".join(_DIGITS.findall(match[0]))


def _alone(text: str, start: int, end: int) -> bool:
    """Whether neither side of a span goes on as a word."""
    around = text[start - 1 : start] + text[end : end + 1] if start else text[end : end + 1]
    return not any(c.isalnum() or c == "_" for c in around)


def valid_iban(iban: str) -> bool:
    """The checksum of an IBAN without blanks."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _account(text: str, cue: str, end: int) -> tuple[int, int] | None:
    """The account number behind a cue that ends at ``end``."""
    start = _FILLER.match(text, end).end()
    if match := _IBAN.match(text, start):
        # Words in capitals may follow: the longest part that ends a word and passes counts.
        for stop in range(match.end(), start + 14, -1):
            if _alone(text, start, stop) and text[stop - 1] != " " and valid_iban(text[start:stop].replace(" ", "")):
                return start, stop
    for pattern in (_SSN, *([_PASSPORT] if cue == "passport" else []), _NUMBER):
        if (match := pattern.match(text, start)) and _alone(text, start, match.end()):
            return start, match.end()
    return None


def find_spans(text: str) -> list[Span]:
    """All spans of a text, by kind in the order of ``KINDS``, then start."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    used = dict.fromkeys(KINDS, 0)
    after_at = 0

    def add(kind: str, start: int, end: int, valid: bool = True) -> None:
        if valid:
            found[kind].append((kind, start, end))
        used[kind] = end

    for last, (anchor, size) in _ANCHORS.iter(text):
        at = last - size + 1
        if anchor == "digit":
            if at >= used["ip"]:
                if match := _IP.match(text, at):
                    add("ip", at, match.end(), all(map(_valid_part, match.groups())))
                else:
                    used["ip"] = _DIGITS.match(text, at).end()
            if at >= used["card"]:
                if match := _CARD.match(text, at):
                    digits = _digits(match)
                    add("card", at, match.end(), 16 <= len(digits) <= 19 and luhn(digits))
        elif anchor == "@":
            floor = max(used["email"], after_at)
            before = text[floor:at]
            start = floor + len(before.rstrip(_LOCAL))
            after_at = at + 1
            if start < at and (match := _DOMAIN.match(text, at)):
                add("email", start, match.end())
        elif anchor == "+":
            if at >= used["phone"] and (match := _PHONE.match(text, at)):
                add("phone", at, match.end(), 8 <= len(_digits(match)) <= 15)
        elif anchor == "scheme":
            floor = max(used["login"], at - 32)
            start = floor + len(text[floor:at].rstrip(_SCHEME))
            if start < at and (match := _LOGIN.match(text, at)):
                add("login", start, match.end())
        elif anchor == "account":
            if at >= used["account"] and _alone(text, at, last + 1):
                if place := _account(text, text[at : last + 1].lower(), last + 1):
                    add("account", *place)
        elif at >= used["secret"]:
            if match := _SECRET.match(text, last + 1):
                add("secret", match.start(1), match.end(1))
    return [span for kind in KINDS for span in found[kind]]


def redact_text(text: str | None) -> str | None:
    """Spans replaced by their kind in brackets; overlapping ones become one, named by the first."""
    if not text:
        return text
    out, done = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in find_spans(text)):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, spans`` (array of kind, start, end) for each row; other columns are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [find_spans(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], [key, "spans"])

    rows = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias(text))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, spans array<struct<kind:string,start:int,end:int>>")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; rows and other columns stay as they are."""
    docs = docs.withColumn(text, F.col(text).cast("string"))
    place, names = docs.columns.index(text), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in texts.groups(whole, text):
                columns = list(batch.columns)
                columns[place] = pa.array([redact_text(t.as_py()) for t in columns[place]], pa.string())
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
