"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, plus signs, digits, schemes and words that
introduce an identifier. A deterministic local parser expands each anchor to the boundaries of its kind and validates
it. Four base kinds have the fixed grammars below; ``url`` and ``account`` are found besides and replace none of them.

    email    [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip       [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)          parts at most 255
    card     [0-9]([\\x20-]?[0-9])+                         14 to 19 digits that pass Luhn
    phone    \\+[0-9][\\x20().0-9-]+[0-9]                    10 to 15 digits

Each is matched leftmost and without overlap within its kind; a match that fails its check is dropped and not retried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account")

# fixed values: the characters of the grammars and the words that introduce an account
DIGITS = frozenset("0123456789")
LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
LOCAL = LABEL | frozenset("._%+")
PHONE = DIGITS | frozenset(" ().-")
URL_STOP = frozenset(" \t\n\x0b\f\r<>\"'`|\\^{}[]")
URL_TAIL = ".,;:!?)"
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("iban", "IBAN", "account no", "Account no", "account number", "Account number", "passport no", "Passport no", "SSN", "ssn")

Span = tuple[int, int]


def automaton() -> ahocorasick.Automaton:
    anchors = ahocorasick.Automaton()
    for kind, words in (("@", "@"), ("+", "+"), ("0", DIGITS), ("url", SCHEMES), ("account", CUES)):
        for word in words:
            anchors.add_word(word, (kind, len(word)))
    anchors.make_automaton()
    return anchors


def email_at(text: str, at: int, floor: int) -> Span | None:
    """The address around an at-sign; its local part begins at ``floor`` at the earliest."""
    start, n = at, len(text)
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = label = at + 1
    while end < n and text[end] in LABEL:
        end += 1
    if start == at or end == label:
        return None
    last = end
    while last < n and text[last] == ".":
        part = last + 1
        while part < n and text[part] in LABEL:
            part += 1
        if part == last + 1:
            break
        last = part
    return (start, last) if last > end else None


def number_groups(text: str, start: int, n: int) -> list[Span]:
    """Runs of digits from ``start`` on, joined by single dots."""
    runs = []
    while True:
        end = start
        while end < n and text[end] in DIGITS:
            end += 1
        runs.append((start, end))
        if end + 1 < n and text[end] == "." and text[end + 1] in DIGITS:
            start = end + 1
        else:
            return runs


def card_end(text: str, start: int, n: int) -> int:
    """End of the digits from ``start`` on, each after at most one space or hyphen."""
    end = start + 1
    while end < n:
        if text[end] in DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in DIGITS:
            end += 2
        else:
            break
    return end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) << (i & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def phone_at(text: str, plus: int, n: int) -> Span | None:
    """The longest number after a plus sign: a digit, at least one character of a number, a digit."""
    if plus + 1 >= n or text[plus + 1] not in DIGITS:
        return None
    end = plus + 2
    while end < n and text[end] in PHONE:
        end += 1
    while end > plus + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return (plus, end) if end > plus + 3 else None


def url_at(text: str, start: int, after: int, n: int) -> Span | None:
    end = after
    while end < n and text[end] not in URL_STOP:
        end += 1
    while end > after and text[end - 1] in URL_TAIL:
        end -= 1
    return (start, end) if end > after else None


def account_at(text: str, after: int, n: int) -> Span | None:
    """Eight or more letters and digits, at least five of them digits, soon after a cue."""
    start = after
    while start < n and start < after + 3 and text[start] in " :.#":
        start += 1
    end = start
    while end < n and (text[end] in LABEL or (text[end] == " " and end + 1 < n and text[end + 1] in DIGITS)):
        end += 1
    value = text[start:end]
    return (start, end) if sum(c in LABEL and c != "-" for c in value) >= 8 and len(only_digits(value)) >= 5 else None


def find_spans(text: str, anchors: ahocorasick.Automaton) -> Iterator[tuple[str, int, int]]:
    """``kind, start, end`` of every span, by anchor."""
    n = len(text)
    email_floor = ip_done = card_done = phone_done = url_done = account_done = 0
    for at, (anchor, length) in anchors.iter(text):
        if anchor == "0":
            if at >= card_done:
                card_done = card_end(text, at, n)
                if card_done - at >= 14:
                    digits = only_digits(text[at:card_done])
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        yield "card", at, card_done
            if at >= ip_done:
                runs = number_groups(text, at, n)
                ip_done = runs[-1][1]
                for i in range(0, len(runs) - 3, 4):
                    if all(int(text[a:b].lstrip("0")[:4] or 0) < 256 for a, b in runs[i:i + 4]):
                        yield "ip", runs[i][0], runs[i + 3][1]
        elif anchor == "@":
            if at >= email_floor and (span := email_at(text, at, email_floor)):
                yield "email", *span
                email_floor = span[1]
        elif anchor == "+":
            if at >= phone_done and (span := phone_at(text, at, n)):
                phone_done = span[1]
                if 10 <= len(only_digits(text[span[0]:span[1]])) <= 15:
                    yield "phone", *span
        elif anchor == "url":
            if at >= url_done and (span := url_at(text, at - length + 1, at + 1, n)):
                yield "url", *span
                url_done = span[1]
        elif at >= account_done and (span := account_at(text, at + 1, n)):
            yield "account", *span
            account_done = span[1]


def ordered_spans(text: str | None, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    return sorted(find_spans(text, anchors), key=lambda s: (s[1], KINDS.index(s[0]), s[2])) if text else []


def listed(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


FOUND = T.StructType([
    *[T.StructField(f"n_{k}", T.LongType()) for k in BASE], T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
])


def find_personal(documents: DataFrame) -> DataFrame:
    """All columns with ``n_email, n_ip, n_card, n_phone``, ``base_sha256`` and ``spans``; input columns of these names are replaced.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then by kind. A null or empty text has none.
    Repeated rows get equal results. An empty table gives an empty result.
    """
    own = [c for c in documents.columns if c not in FOUND.names]
    documents = documents.select([f"`{c}`" for c in own])
    at = own.index("text")

    def run(batches):
        anchors = automaton()
        for batch in batches:
            rows = []
            for text in batch.column(at):
                spans = ordered_spans(text.as_py(), anchors)
                base = [s for s in spans if s[0] in BASE]
                kinds = [s[0] for s in base]
                rows.append((*map(kinds.count, BASE), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
            found = [pa.array(c, pa.int64() if i < len(BASE) else pa.string()) for i, c in enumerate(zip(*rows))] if rows else [
                pa.array([], pa.int64() if i < len(BASE) else pa.string()) for i in range(len(FOUND))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*own, *FOUND.names])

    return documents.mapInArrow(run, T.StructType([*documents.schema.fields, *FOUND.fields]))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind; spans that overlap are one, named by the first."""
    out, done = [], 0
    for kind, start, end in spans:
        if start >= done:
            out += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def mask_personal(documents: DataFrame) -> DataFrame:
    """The same columns; every span of personal data in ``text`` becomes its kind in angle brackets. Null stays null."""
    own = documents.columns
    at = own.index("text")

    def run(batches):
        anchors = automaton()
        for batch in batches:
            texts = [t if t is None else masked(t, ordered_spans(t, anchors)) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=own)

    return documents.mapInArrow(run, documents.schema)
