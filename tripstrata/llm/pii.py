r"""Personal data by anchor expansion.

One automaton (Aho-Corasick) goes over the whole text and finds anchors: at-signs, plus
signs, digits, the ``://`` of a scheme, and cue words that announce an identifier.  At
each anchor a parser of its kind expands to both sides as far as its characters
reach and validates what it got.  A parser starts where the last one of its kind
ended, so the time is linear in the text.

Four kinds are the base: ``email``, ``ip``, ``card`` and ``phone``.  The cues add
``login`` (user and password in an address), ``ip6`` (a bracketed host of an address),
``iban`` (right country form and remainder), ``ssn`` (allowed ranges) and ``account``
(digits after a word for an account).  An added span inside a base span is left out.

One map over rows without a shuffle; the automaton is built once in each worker.
"""

from __future__ import annotations

import functools
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.common import map_batches, text_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "ip6", "iban", "ssn", "account")
SPAN = "struct<start:bigint,end:bigint,kind:string>"

CARD_DIGITS, PHONE_DIGITS, ACCOUNT_DIGITS = (12, 19), (9, 15), (6, 17)
_RANK = {kind: number for number, kind in enumerate(KINDS)}
_DIGITS = frozenset("0123456789")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.+-")

# What may stand to the right of an anchor.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_QUAD = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOGIN = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=-]+:[A-Za-z0-9._~%!$&'()*+,;=:-]+(?=@[A-Za-z0-9\[])")
_BRACKET = re.compile(r"(?:[^\s/@\[\]]*@)?\[([0-9A-Fa-f:.]{2,45})\]")
_AFTER = re.compile(r"(?:\x20?(?:number|no\.?|nr\.?|code))?\x20?[:#=]?\x20?", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_SSN = re.compile(r"([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_ACCOUNT = re.compile(r"[0-9](?:[\x20-]?[0-9])+(?![A-Za-z0-9])")

CUES = {
    "iban": ("iban",),
    "ssn": ("ssn", "social security"),
    "account": ("account", "acct", "konto", "kontonummer", "cuenta", "compte"),
}


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = 2 * value - 9 if value > 4 else 2 * value
        total += value
    return total % 10 == 0


def _digits_of(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def _left(text: str, at: int, floor: int, allowed: frozenset) -> int:
    while at > floor and text[at - 1] in allowed:
        at -= 1
    return at


@functools.lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for digit in _DIGITS:
        found.add_word(digit, ("digit", 1))
    for sign, kind in (("@", "at"), ("+", "plus"), ("://", "scheme")):
        found.add_word(sign, (kind, len(sign)))
    for kind, cues in CUES.items():
        for cue in cues:
            for form in (cue, cue.upper(), cue.capitalize(), cue.title()):
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


class _Parsers:
    """The parsers over one text; each knows where its last match ended."""

    def __init__(self, text: str):
        self.text, self.spans = text, []
        self.email_end = self.chain_end = self.quad_end = 0

    def add(self, kind: str, start: int, end: int) -> None:
        self.spans.append((start, end, kind))

    def at(self, start: int, end: int) -> None:
        left = _left(self.text, start, self.email_end, _LOCAL)
        right = _DOMAIN.match(self.text, end) if left < start else None
        if right:
            self.email_end = right.end()
            self.add("email", left, right.end())

    def digit(self, start: int, end: int) -> None:
        text = self.text
        if start >= self.chain_end:
            chain = _CHAIN.match(text, start)
            self.chain_end = chain.end()
            digits = _digits_of(chain[0])
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                self.add("card", start, chain.end())
        if start >= self.quad_end and not (start and text[start - 1] in _DIGITS):
            quad = _QUAD.match(text, start)
            if quad:
                self.quad_end = quad.end()
                parts = [part.lstrip("0") for part in quad.groups()]
                if all(len(part) <= 3 and int(part or "0") <= 255 for part in parts):
                    self.add("ip", start, quad.end())

    def plus(self, start: int, end: int) -> None:
        found = _PHONE.match(self.text, start)
        if found and PHONE_DIGITS[0] <= len(_digits_of(found[0])) <= PHONE_DIGITS[1]:
            self.add("phone", start, found.end())

    def scheme(self, start: int, end: int) -> None:
        if _left(self.text, start, max(0, start - 32), _SCHEME) == start:
            return
        login = _LOGIN.match(self.text, end)
        if login:
            self.add("login", login.start(), login.end())
        host = _BRACKET.match(self.text, end)
        if host:
            try:
                ipaddress.IPv6Address(host[1])
            except ValueError:
                return
            self.add("ip6", host.start(1), host.end(1))

    def _after(self, start: int, end: int) -> int | None:
        """Where the identifier starts that a cue announces."""
        text = self.text
        if start and text[start - 1].isalnum() or end < len(text) and text[end].isalpha():
            return None
        at = _AFTER.match(text, end).end()
        return at if at > end else None

    def iban(self, start: int, end: int) -> None:
        at = self._after(start, end)
        found = _IBAN.match(self.text, at) if at is not None else None
        if not found:
            return
        # Words may follow in capitals: the longest form that proves right.
        for stop in range(found.end(), found.start() + 14, -1):
            code = self.text[found.start() : stop].replace(" ", "")
            if self.text[stop - 1] != " " and 15 <= len(code) <= 34:
                number = "".join(str(int(c, 36)) for c in code[4:] + code[:4])
                if int(number) % 97 == 1:
                    self.add("iban", found.start(), stop)
                    return

    def ssn(self, start: int, end: int) -> None:
        at = self._after(start, end)
        found = _SSN.match(self.text, at) if at is not None else None
        if found and found[1] not in ("000", "666") and found[1] < "900" and found[2] != "00" and found[3] != "0000":
            self.add("ssn", found.start(), found.end())

    def account(self, start: int, end: int) -> None:
        at = self._after(start, end)
        found = _ACCOUNT.match(self.text, at) if at is not None else None
        if found and ACCOUNT_DIGITS[0] <= len(_digits_of(found[0])) <= ACCOUNT_DIGITS[1]:
            self.add("account", found.start(), found.end())


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` by start and then kind, in code points, end exclusive."""
    parsers = _Parsers(text)
    parse = {kind: getattr(parsers, kind) for kind in ("at", "digit", "plus", "scheme", *CUES)}
    for last, (kind, size) in automaton().iter(text):
        parse[kind](last + 1 - size, last + 1)
    spans = sorted(set(parsers.spans), key=lambda s: (s[0], _RANK[s[2]], s[1]))
    kept, reach = [], -1
    for span in spans:
        if span[2] in BASE:
            reach = max(reach, span[1])
            kept.append(span)
        # Base spans that start at the same place come first.
        elif span[1] > reach:
            kept.append(span)
    return kept


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with a mark for every span; overlapping ones share the first one's mark."""

    def pieces() -> Iterator[str]:
        at = 0
        for start, end, kind in spans:
            if start >= at:
                yield text[at:start]
                yield f"<{kind}>"
            at = max(at, end)
        yield text[at:]

    return "".join(pieces())


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def scan_pii(docs: DataFrame, key: str = "doc_id", text: Column | str = "text", mask: bool = False) -> DataFrame:
    """``key, spans`` for each row, and with ``mask`` also the text with its spans masked.

    Whole texts are read, however long.  A null text is empty and has no spans; repeated
    rows each get their row, and no rows give none.  Other columns play no part.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        found = [find_spans(t) for t in texts]
        rows = [[{"start": s, "end": e, "kind": k} for s, e, k in spans] for spans in found]
        columns = {"key": batch.column("key"), "spans": pa.array(rows, _SPANS)}
        if mask:
            columns["masked"] = pa.array([masked(*x) for x in zip(texts, found, strict=True)], pa.string())
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    schema = f"key {kind}, spans array<{SPAN}>" + ", masked string" * mask
    return map_batches(rows, run, schema).withColumnRenamed("key", key)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    parts = F.transform(
        spans,
        lambda s: F.concat_ws(":", s.getField("kind"), s.getField("start").cast("string"), s.getField("end").cast("string")),
    )
    return F.array_join(parts, ",")


def of_kinds(spans: Column | str, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s.getField("kind").isin(*kinds))
