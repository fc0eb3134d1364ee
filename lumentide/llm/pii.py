"""Personal data in texts: expressions propose, checksums confirm, context decides.

Two layers. The base layer takes every match of four fixed expressions (e-mail, IPv4, payment
card, international phone number) that passes its check. The second layer scores further
candidates: parts of base matches that failed as a whole (two card numbers side by side, a
phone number followed by an address), account numbers with mod-97 check digits, IPv6
addresses, national identity numbers, local phone numbers and credentials. A candidate's
score is what its form is worth, raised by a passed checksum and by words of its kind
nearby, lowered by words that announce something else.

All scans are linear in the text: quantifiers are possessive and start at the beginning of
a run, so a text of one long word or number costs no more than any other.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lumentide.llm.common import with_arrow_columns


class Span(NamedTuple):
    """A find: code points `start` to `end` (exclusive), a score, and whether of the base layer."""

    kind: str
    start: int
    end: int
    score: float
    base: bool


BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ipv6", "national_id", "local_phone", "credential")

_LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_GROUP = re.compile(r"[0-9]++")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f:]{6,45}(?![0-9A-Za-z:])")
_NATIONAL = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")
_LOCAL_PHONE = re.compile(
    r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ ./-])"
    r"[0-9]{2,4}[ .-][0-9]{2,4}(?:[ .-][0-9]{2,4})?(?![0-9A-Za-z]|[.-][0-9])")
_CREDENTIAL = re.compile(
    r"(?i)(?:token|secret|passwor[dt]|passwd|api[_-]?key|access[_-]?key)[\"']?"
    r" ?(?:=|:|=>) ?[\"']?(?P<value>[A-Za-z0-9_+/=.-]{12,}+)")

# Words near a find that speak for its kind, in the languages of the corpus.
_FOR = {
    "card": "card|visa|mastercard|amex|credit|debit|karte|kreditkarte|carte|tarjeta|payment",
    "phone": "phone|tel|call|mobile|fax|telefon|handy|anruf|téléphone|teléfono|móvil",
    "local_phone": "phone|tel|call|mobile|fax|telefon|handy|anruf|téléphone|teléfono|móvil",
    "iban": "iban|account|bank|konto|compte|cuenta|bic|swift",
    "ipv6": "ip|ipv6|address|host|server|adresse|dirección",
    "national_id": "ssn|social|security|sozialversicherung|sécurité|sociale|seguridad|identity",
    "credential": "login|auth|authorization|bearer|aws|github",
}
# Words that announce a number of another kind.
_AGAINST = "isbn|issn|doi|version|build|order|invoice|page|section|serial|figure|table|rfc"
_NEAR = 40
_CONTEXT = {kind: re.compile(rf"(?i)\b(?:{words})\b") for kind, words in _FOR.items()}
_OTHER = re.compile(rf"(?i)\b(?:{_AGAINST})\b")


def passes_luhn(digits: str) -> bool:
    """Whether the last digit is the others' Luhn check digit."""
    doubled = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def passes_mod97(account: str) -> bool:
    """Whether the check digits of an account number (ISO 13616) are right."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_PART:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _digits(text: str) -> str:
    return "".join(_GROUP.findall(text))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and passes_luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def _near(kind: str, text: str, start: int, end: int) -> float:
    """What the words around a find add to or take from its score."""
    around = f"{text[max(0, start - _NEAR):start]} \0 {text[end:end + _NEAR // 2]}"
    found = 0.3 if kind in _CONTEXT and _CONTEXT[kind].search(around) else 0.0
    return found - (0.3 if _OTHER.search(around) else 0.0)


def _issued(digits: str) -> bool:
    """Whether a card number begins with digits that payment networks use, at their length."""
    first = digits[0]
    return (first in "2456" and len(digits) in (13, 16, 19)
            or digits[:2] in ("34", "37") and len(digits) == 15)


def _cards_within(text: str, start: int, end: int) -> Iterator[tuple[int, int, float]]:
    """Card numbers among the groups of digits of a match that failed as a whole.

    At most 19 groups of digits from each group on can belong to a number, so this is linear.
    """
    groups = [m.span() for m in _GROUP.finditer(text, start, end)]
    at = 0
    while at < len(groups):
        digits, taken = "", at
        for last in range(at, min(at + 19, len(groups))):
            digits += text[slice(*groups[last])]
            if len(digits) > 19:
                break
            if len(digits) >= 13 and passes_luhn(digits) and _issued(digits):
                yield groups[at][0], groups[last][1], 0.7
                taken = last
                break
        at = taken + 1


def _phone_within(text: str, start: int, end: int) -> tuple[int, int, float] | None:
    """The longest beginning of a failed phone match that ends before a space and passes."""
    digits, best = 0, None
    for group in _GROUP.finditer(text, start, end):
        digits += group.end() - group.start()
        if digits > 15:
            break
        if digits >= 9 and text[group.end():group.end() + 1] == " ":
            best = group.end()
    return (start, best, 0.6) if best else None


def _national(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _is_ipv6(text: str) -> bool:
    if text.count(":") < 2:
        return False
    try:
        address = ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return int(address) >> 125 == 1  # global unicast


def _mixed(value: str) -> bool:
    """Whether a value looks drawn at random: digits and letters, many different ones."""
    return (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
            and len(set(value)) >= 8)


def _further(text: str, failed: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, float]]:
    """Candidates of the second layer with the worth of their form and checksum."""
    for kind, start, end in failed:
        if kind == "card":
            yield from (("card", *c) for c in _cards_within(text, start, end))
        elif kind == "phone" and (found := _phone_within(text, start, end)):
            yield "phone", *found
    for m in _IBAN.finditer(text):
        # The expression may run into words in capitals; account numbers end where mod-97 fits.
        ends = [i for i in range(m.end(), m.start() + 14, -1)
                if i == m.end() or text[i] == " "]
        for end in ends:
            account = text[m.start():end].replace(" ", "")
            if 15 <= len(account) <= 34 and passes_mod97(account):
                yield "iban", m.start(), end, 0.8
                break
    if "::" in text or text.count(":") > 6:
        for m in _IPV6.finditer(text):
            if _is_ipv6(m.group()):
                yield "ipv6", *m.span(), 0.7
    for m in _NATIONAL.finditer(text):
        if _national(m.group()):
            yield "national_id", *m.span(), 0.4
    for m in _LOCAL_PHONE.finditer(text):
        if 7 <= len(_digits(m.group())) <= 12:
            yield "local_phone", *m.span(), 0.3
    for m in _CREDENTIAL.finditer(text):
        if _mixed(m["value"]):
            yield "credential", *m.span("value"), 0.7


_CHECKED: tuple[tuple[str, re.Pattern, Callable[[str], bool]], ...] = (
    ("ip", _IP, _is_ip), ("card", _CARD, _is_card), ("phone", _PHONE, _is_phone))


def find_pii(text: str, least: float = 0.5) -> list[Span]:
    """All spans of a text, by kind in the order of `KINDS`, then start.

    A base match stays whatever its context; its score, too, tells how sure it is. A
    candidate of the second layer stays if its score is `least` or more and it shares no
    character with a base span or with an earlier candidate.
    """
    found = [("email", *span, 0.9, True) for span in _emails(text)] if "@" in text else []
    failed: list[tuple[str, int, int]] = []
    if _DIGIT.search(text):
        for kind, form, passes in _CHECKED:
            for m in form.finditer(text):
                if passes(m.group()):
                    found.append((kind, *m.span(), 0.6, True))
                elif kind != "ip" and m.end() - m.start() > 12:
                    failed.append((kind, *m.span()))
        found += [(*candidate, False) for candidate in _further(text, failed)]
    spans = []
    for kind, start, end, worth, base in found:
        score = min(1.0, max(0.0, worth + _near(kind, text, start, end)))
        if base or score >= least:
            spans.append(Span(kind, start, end, score, base))
    return sorted(_apart(spans), key=lambda s: (KINDS.index(s.kind), s.start))


def _apart(spans: list[Span]) -> Iterator[Span]:
    """Base spans, and of the others those apart from them and from earlier or better ones."""
    starts: list[int] = []
    ends: list[int] = []
    for span in sorted((s for s in spans if s.base), key=lambda s: s.start):
        yield span
        if ends and span.start <= ends[-1]:
            ends[-1] = max(ends[-1], span.end)
        else:
            starts.append(span.start)
            ends.append(span.end)
    done = 0
    for span in sorted((s for s in spans if not s.base),
                       key=lambda s: (s.start, -s.score, -s.end, KINDS.index(s.kind))):
        at = bisect_right(ends, span.start)
        if span.start >= done and (at == len(starts) or starts[at] >= span.end):
            done = span.end
            yield span


_SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("base", T.BooleanType())])


def scan_pii(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Add `spans`: what `find_pii` finds in the text, in code points.

    Narrow: no shuffle, no state; a worker holds one Arrow batch. A column of the name
    `spans` is replaced, all others are kept, whatever their names. NULL and empty texts have
    no spans; repeated rows have the same; an empty table gives an empty table. Texts are
    scanned whole, in time linear in their length.
    """
    def scanned(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(
            [[s._asdict() for s in find_pii(t, least)] if t else [] for t in texts.to_pylist()],
            pa.list_(pa.struct([
                ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                ("score", pa.float64()), ("base", pa.bool_())])))]

    return with_arrow_columns(
        docs, scanned, [text_col], [T.StructField("spans", T.ArrayType(_SPAN))])


def mask_pii(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """Add `masked`: the text with every run of characters of some span as one `<kind>`.

    Where spans overlap the run has the kind of the first in the order of the column.
    """
    def masked(texts: pa.Array, spans: pa.Array) -> list[pa.Array]:
        return [pa.array([None if t is None else _masked(t, s or [])
                          for t, s in zip(texts.to_pylist(), spans.to_pylist())], pa.string())]

    return with_arrow_columns(
        docs, masked, [text_col, spans_col], [T.StructField("masked", T.StringType())])


def _masked(text: str, spans: list[dict]) -> str:
    out, at, reach = [], 0, 0
    for span in sorted(spans, key=lambda s: s["start"]):
        if span["start"] >= reach:
            out += [text[at:span["start"]], f"<{span['kind']}>"]
        reach = at = max(reach, span["end"])
    return "".join([*out, text[at:]])


def span_digest(spans: str, base_only: bool = False):
    """Column: `kind:start:end` of the spans in their order, comma-joined."""
    listed = F.filter(spans, lambda s: s["base"]) if base_only else F.col(spans)
    return F.array_join(F.transform(listed, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
