"""Personal data in texts by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus-signs, digits,
`://` and account words. Around each anchor a small deterministic parser expands
to the left and right, and the span counts if it passes its check (octet range,
Luhn, digit count, IBAN remainder). Spans of a kind are leftmost and do not
overlap; a span that fails its check is dropped without a second try.

Kinds: email, ip, card, phone (base), then url (an address with a user part or
an IP host) and account (a number after an account word), which are kept only
where they do not touch a base span.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import id_text, ids_of, small_batches, text_of

BASE = ("email", "ip", "card", "phone")
ADDED = ("url", "account")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
DIGITS = re.compile(r"[0-9]++")
ADDRESS = re.compile(r"[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
AUTHORITY = re.compile(r"[^\s/?#\"'<>]++")
NUMBER = re.compile(r"[\s:=#.]{0,4}(?:(?:no|nr|number)\b[\s:=#.]{0,4})?([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){10,30}|[0-9](?:[ -]?[0-9]){5,17})", re.I)
CUES = ("iban", "account", "acct", "konto", "compte", "cuenta")

Span = tuple[int, int]


@dataclass(frozen=True)
class PiiParams:
    cues: tuple[str, ...] = CUES
    card_digits: tuple[int, int] = (13, 19)
    phone_digits: tuple[int, int] = (9, 15)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def iban(number: str) -> bool:
    plain = number.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def octets(address: str) -> bool:
    parts = [p.lstrip("0") for p in address.split(".")]
    return all(len(p) < 4 and int(p or 0) <= 255 for p in parts)


def automaton(params: PiiParams):
    """Anchors by what they start: email, phone, digit, url or account."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in [("@", "email"), ("+", "phone"), ("://", "url")]:
        found.add_word(word, (kind, len(word)))
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for cue in params.cues:
        for form in (cue.lower(), cue.upper(), cue.capitalize()):
            found.add_word(form, ("account", len(form)))
    found.make_automaton()
    return found


def find(text: str, anchors, params: PiiParams) -> dict[str, list[Span]]:
    """Spans (start, end) in code points by kind."""
    spans: dict[str, list[Span]] = {kind: [] for kind in BASE + ADDED}
    after = dict.fromkeys((*BASE, *ADDED), 0)  # where the next span of a kind may start
    for last, (kind, length) in anchors.iter(text):
        at = last - length + 1
        if kind == "digit":
            if at >= after["ip"]:
                match = ADDRESS.match(text, at)
                if match and octets(match[0]):
                    spans["ip"].append(match.span())
                after["ip"] = (match or DIGITS.match(text, at)).end()
            if at >= after["card"] and (match := CARD.match(text, at)):
                after["card"] = match.end()
                digits = match[0].replace(" ", "").replace("-", "")
                if params.card_digits[0] <= len(digits) <= params.card_digits[1] and luhn(digits):
                    spans["card"].append(match.span())
        elif kind == "email":
            start = at
            while start > after["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (match := DOMAIN.match(text, at + 1)):
                spans["email"].append((start, match.end()))
                after["email"] = match.end()
        elif kind == "phone":
            if at >= after["phone"] and (match := PHONE.match(text, at)):
                after["phone"] = match.end()
                digits = sum(c in "0123456789" for c in match[0])
                if params.phone_digits[0] <= digits <= params.phone_digits[1]:
                    spans["phone"].append(match.span())
        elif kind == "url":
            _url(text, at, after, spans)
        elif kind == "account" and at >= after["account"]:
            _account(text, at, last + 1, after, spans)
    taken = sorted(s for kind in BASE for s in spans[kind])
    reach = list(accumulate((end for _, end in taken), max))
    for kind in ADDED:
        spans[kind] = [s for s in spans[kind] if not _touches(s, taken, reach)]
    return spans


def _url(text: str, at: int, after: dict, spans: dict) -> None:
    start = at
    while start > after["url"] and text[start - 1].isascii() and text[start - 1].isalpha():
        start -= 1
    match = AUTHORITY.match(text, at + 3)
    if start == at or not match:
        return
    user, _, host = match[0].rpartition("@")
    address = ADDRESS.match(host)
    if user or (address and octets(address[0])):
        spans["url"].append((start, match.end()))
    after["url"] = match.end()


def _account(text: str, at: int, end: int, after: dict, spans: dict) -> None:
    if at and text[at - 1].isalnum():
        return
    match = NUMBER.match(text, end)
    if not match:
        return
    after["account"] = match.end()
    if match[1][0].isdigit() or iban(match[1]):
        spans["account"].append(match.span(1))


def _touches(span: Span, taken: list[Span], reach: list[int]) -> bool:
    """Whether a base span overlaps; `reach` is the largest end up to each base span."""
    place = bisect.bisect_left(taken, (span[1], -1))
    return place > 0 and reach[place - 1] > span[0]


def joined(spans: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in kinds for a, b in spans[kind])


def find_personal_data(docs: DataFrame, params: PiiParams | None = None) -> DataFrame:
    """Counts and spans of personal data per document, over whole texts.

    A null text counts as empty and has no spans. Repeated rows keep a row each,
    null ids stay null, other columns are not read, an empty table gives no rows.
    """
    params = params or PiiParams()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors = automaton(params)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                spans = find(text, anchors, params)
                base = joined(spans, BASE)
                rows.append(
                    (doc_id, *(len(spans[k]) for k in BASE),
                     hashlib.sha256(base.encode()).hexdigest(), joined(spans, BASE + ADDED),
                     *(len(spans[k]) for k in ADDED))
                )
            yield pd.DataFrame(rows, columns=names).assign(doc_id=ids_of(batch["doc_id"]))

    schema = (
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_sha256 string, spans string, n_url bigint, n_account bigint"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    rows = small_batches(docs).select(id_text("doc_id").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(run, schema)
