"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

Spans count code points, end exclusive. The base kinds follow fixed rules and are always reported.
The method adds what those rules leave out: a proposal is reported if its score reaches the
threshold. A proposal starts from its kind's prior; a passed checksum confirms it, a failed one
rejects it, and each context word within a window before or after it moves the score.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.llm.common import Taken, batch, workers_import

Span = tuple[int, int, str]

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn")
KINDS = BASE_KINDS + ADDED_KINDS

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits is entered at its first digit only, so that a long run is read once.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Fixed value: length of an IBAN by country, from the registry of ISO 13616.
IBAN_LENGTHS = {
    part[:2]: int(part[2:])
    for part in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29"
        " ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20"
        " LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29"
        " PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
        " YE30"
    ).split()
}
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_CARD_ALONE = re.compile(r"(?<![0-9])(?:[0-9]{4}[ -]){3}[0-9]{1,7}(?![0-9])|(?<![0-9])[0-9]{12,19}(?![0-9])")
_PHONE_ALONE = re.compile(
    r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-][0-9]{2,4}){2,3}(?![0-9])"
    r"|(?<![0-9(+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])"
)
_DIGITS = re.compile(r"[0-9]")

#: Prior of a proposal, by kind.
PRIOR = {"iban": 0.3, "ssn": 0.4, "card": 0.3, "phone": 0.4}
#: What a passed checksum adds; a failed one rejects the proposal.
CONFIRMED = 0.5
#: What a context word adds or takes, within WINDOW code points on either side.
NEAR, AGAINST, WINDOW, THRESHOLD = 0.3, 0.4, 48, 0.6
#: Fixed value: words that speak for a kind.
CONTEXT = {
    "iban": re.compile(r"\b(?:iban|account|bank|konto|compte|cuenta|transfer)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social security|tax id|taxpayer)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|telephone|mobile|cell|call|fax|telefon|contact)\b", re.I),
}
#: Fixed value: words that speak against any kind.
COUNTER = re.compile(r"\b(?:order|invoice|isbn|serial|version|part|sku|tracking)\b", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    """ISO 7064 mod 97-10 of an IBAN without spaces."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain.tld. The local part is the whole run before an @, so each @
    is looked at once, however long the run."""
    free, at = 0, text.find("@")
    while at >= 0:
        run = text[free:at]
        start = free + len(run.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def _byte_part(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """Fixed rules, leftmost and without overlaps within a kind; a failing match is dropped."""
    found = [(a, b, "email") for a, b in _emails(text)]
    found += [(*m.span(), "ip") for m in _IP.finditer(text) if all(map(_byte_part, m.groups()))]
    for m in _CARD.finditer(text):
        digits = _only_digits(m[0]) if m.end() - m.start() >= 12 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), "card"))
    if "+" in text:
        found += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 9 <= len(_only_digits(m[0])) <= 15]
    return _ordered(found)


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Spans that pass mod-97. A proposal may run on into the words after it, so it is cut at its country's
    length, or for countries unknown at each end of a word, the longest first; the search goes on behind
    what is found, or within what is not."""
    m = _IBAN.search(text)
    while m:
        end = next((at for at in _iban_ends(m) if mod97(text[m.start() : at].replace(" ", ""))), None)
        if end:
            yield m.start(), end
        m = _IBAN.search(text, end or m.start() + 1)


def _iban_ends(m: re.Match) -> list[int]:
    """Where an IBAN within the proposal may end: it has 15 to 34 characters and no part of a word is left."""
    sizes, size = {}, 0
    for at, char in enumerate(m[0], 1):
        size += char != " "
        if char != " " and m[0][at : at + 1] in ("", " ") and 15 <= size <= 34:
            sizes[size] = m.start() + at
    if known := IBAN_LENGTHS.get(m[0][:2]):
        return [sizes[n] for n in dict.fromkeys((known, max(sizes, default=0))) if n in sizes]
    return [sizes[n] for n in sorted(sizes, reverse=True)]


def _score(text: str, start: int, end: int, kind: str, confirmed: bool) -> float:
    around = text[max(0, start - WINDOW) : start] + " " + text[end : end + WINDOW]
    score = PRIOR[kind] + CONFIRMED * confirmed
    return score + NEAR * bool(CONTEXT[kind].search(around)) - AGAINST * bool(COUNTER.search(around))


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Proposals beyond the base rules that reach the threshold and meet no base span."""
    proposals: list[tuple[int, int, str, bool]] = []
    if len(_DIGITS.findall(text)) >= 9:
        proposals += [(start, end, "iban", True) for start, end in _ibans(text)]
        for m in _CARD_ALONE.finditer(text):
            digits = _only_digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                proposals.append((*m.span(), "card", True))
        for m in _SSN.finditer(text):
            if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
                proposals.append((*m.span(), "ssn", False))
        for m in _PHONE_ALONE.finditer(text):
            if 9 <= len(_only_digits(m[0])) <= 15:
                # A country code takes the place of a check: no phone number has a checksum.
                proposals.append((*m.span(), "phone", m[0][0] == "+"))
    taken, out = Taken((a, b) for a, b, _ in base), []
    for start, end, kind, confirmed in sorted(proposals, key=lambda p: (-p[3], p[0])):
        if not taken.meets(start, end) and _score(text, start, end, kind, confirmed) >= THRESHOLD:
            out.append((start, end, kind))
            taken.add(start, end)
    return out


def all_spans(text: str) -> list[Span]:
    base = base_spans(text)
    return _ordered(base + added_spans(text, base))


def digest_of(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def mask(text: str) -> str:
    """`text` with every span replaced by its kind in brackets; overlaps become one, of the first kind."""
    out, at = [], 0
    spans = all_spans(text)
    merged: list[list] = []
    for start, end, kind in spans:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    for start, end, kind in merged:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join(out) + text[at:] if out else text


RESULT = pa.schema(
    [("doc_id", pa.int64())]
    + [(f"n_{k}", pa.int64()) for k in BASE_KINDS]
    + [("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())]
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        rows = []
        for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            base = base_spans(text or "")
            added = added_spans(text or "", base)
            kinds = [kind for _, _, kind in base]
            digest = hashlib.sha256(digest_of(base).encode()).hexdigest()
            rows.append((doc_id, *map(kinds.count, BASE_KINDS), digest, digest_of(_ordered(base + added)), len(added)))
        yield batch(RESULT, *(zip(*rows, strict=True) if rows else [[]] * len(RESULT)))


def personal_data(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, digest of the base spans and all spans, for every row of `docs`.

    A null text counts as empty, a null id stays null, repeated rows give repeated rows, an empty
    table gives none. Other columns are not read. Every text is searched to its end, in time that
    grows with its length.
    """
    workers_import(docs.sparkSession)
    kinds = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return docs.select(F.col(id_column).cast("long"), text).mapInArrow(
        _scan, f"doc_id long, {kinds}, base_sha256 string, spans string, n_added long"
    )


@F.pandas_udf(T.StringType())
def _masked(texts: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else mask(t) for t in texts], dtype=object)


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with personal data in `text` replaced by the kind in brackets; null stays null and all
    other columns stay as they are."""
    workers_import(docs.sparkSession)
    return docs.withColumn(text, _masked(F.col(text)))
