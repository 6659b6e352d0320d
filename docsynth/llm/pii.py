"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors (at-signs, plus signs, digits,
URL schemes, account and street cues); a deterministic local parser expands each
anchor to its boundaries and validates it. Per kind, spans are the leftmost
non-overlapping matches of the kind's pattern; a match that fails its check is
dropped and not retried, but its characters stay consumed. The work is narrow.

Kinds: ``email``, ``ip``, ``card``, ``phone`` (base), then ``account`` (IBAN by
its mod-97 check, or a cue word with 6 to 17 digits), ``address`` (number, street
name, street word) and ``url``. Offsets are code points, ends exclusive.

Defined results: null and empty texts have no spans; rows are judged each on
their own, whatever their ids; extra columns are carried along, a column of the
name ``spans`` (or, in ``redacted``, ``n_pii``) is replaced.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_BYTES, map_columns, sha_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("account", "address", "url")

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType(), False), T.StructField("start", T.LongType(), False),
                                  T.StructField("end", T.LongType(), False)]))

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"[:\x20]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"\x20?(?:no|nr|number|num|id)?[.:#\x20]{0,4}([0-9](?:-?[0-9]){5,16})(?![0-9])", re.IGNORECASE)
_STREET = re.compile(r"[0-9]{1,5}[A-Za-z]?\x20(?:[A-Z][a-z'-]+\x20){1,4}\Z")
_URL = re.compile(r"://[^\s\"'<>]+")

_ACCOUNT_CUES = ("account", "acct", "konto", "compte", "cuenta")
_STREET_CUES = ("Street", "Avenue", "Road", "Lane", "Drive", "Boulevard")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def iban_valid(value: str) -> bool:
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def anchors() -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    for c in "0123456789":
        auto.add_word(c, ("n", 1))
    auto.add_word("@", ("@", 1))
    auto.add_word("+", ("+", 1))
    auto.add_word("://", ("u", 3))
    for w in _ACCOUNT_CUES:
        for form in (w, w.capitalize(), w.upper()):
            auto.add_word(form, ("a", len(form)))
    for w in ("IBAN", "Iban", "iban"):
        auto.add_word(w, ("i", len(w)))
    for w in _STREET_CUES:
        auto.add_word(w, ("s", len(w)))
    auto.make_automaton()
    return auto


def spans_of(text: str | None, auto: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans of a text, by kind as in ``KINDS``, then by start."""
    found: dict[str, list[tuple[int, int]]] = {}
    done = dict.fromkeys(KINDS, 0)
    if not text:
        return []

    def keep(kind: str, start: int, end: int, valid: bool = True) -> None:
        done[kind] = end
        if valid:
            found.setdefault(kind, []).append((start, end))

    for last, (sign, width) in auto.iter(text):
        at = last - width + 1
        if sign == "n":
            if at >= done["card"] and (m := _CARD.match(text, at)):
                digits = m[0].replace(" ", "").replace("-", "")
                keep("card", at, m.end(), 16 <= len(digits) <= 19 and luhn(digits))
            if at >= done["ip"]:
                if m := _IP.match(text, at):
                    keep("ip", at, m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")))
                else:  # no other digit of this run can start one
                    done["ip"] = _DIGITS.match(text, at).end()
        elif sign == "@":
            start = at
            while start > done["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at)):
                keep("email", start, m.end())
        elif sign == "+":
            if at >= done["phone"] and (m := _PHONE.match(text, at)):
                keep("phone", at, m.end(), 8 <= sum(c in "0123456789" for c in m[0]) <= 15)
        elif sign == "u":
            start = at
            while start > done["url"] and at - start < 12 and text[start - 1] in _SCHEME:
                start -= 1
            if start < at and at >= done["url"] and text[start].isalpha() and (m := _URL.match(text, at)):
                value = m[0].rstrip(".,;:!?)]}")
                if len(value) > 3:
                    keep("url", start, at + len(value))
        elif sign == "s":
            if last + 1 < len(text) and text[last + 1].isalnum():
                continue
            m = _STREET.search(text, max(done["address"], at - 120), at)
            if m and not (m.start() and text[m.start() - 1].isalnum()):
                keep("address", m.start(), last + 1)
        else:
            pattern = _IBAN if sign == "i" else _ACCOUNT
            m = pattern.match(text, last + 1)
            if m and m.start(1) >= done["account"] and (sign == "a" or iban_valid(m[1].replace(" ", ""))):
                keep("account", m.start(1), m.end(1))
    return [(k, a, b) for k in KINDS for a, b in found.get(k, ())]


def pii_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with ``spans``: kind, start, end of all personal data."""

    def run(batches):
        auto = anchors()
        for batch in batches:
            yield {"spans": [[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t, auto)] for t in batch[text]]}

    return map_columns(docs, run, [text], [("spans", SPANS)], slice_bytes=SLICE_BYTES)


def redact_text(value: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every span replaced by its kind in brackets (overlapping spans: one, the first's)."""
    if not spans:
        return value
    out, at = [], 0
    for start, end, kind in sorted((a, b, k) for k, a, b in spans):
        if start >= at:
            out += [value[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + value[at:]


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with every span of personal data in ``text`` replaced, and ``n_pii``, their number."""

    def run(batches):
        auto = anchors()
        for batch in batches:
            spans = [spans_of(t, auto) for t in batch[text]]
            yield {text: [redact_text(t, s) for t, s in zip(batch[text], spans)], "n_pii": [len(s) for s in spans]}

    return map_columns(docs, run, [text], [(text, T.StringType()), ("n_pii", T.LongType())], slice_bytes=SLICE_BYTES)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``pii_spans``."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of(*BASE_KINDS)
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
                        sha_of(joined(base)).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
