"""Personal data and secrets: patterns propose spans, checksums confirm them, nearby words adjust the score (operator 10).

Kinds: email, ip, card (Luhn) and phone as fixed base kinds, and on top iban (the country's length, mod 97) and secret (keys and
tokens of known form, and values of enough entropy that stand by themselves or after a password word). A span on top counts
if its score reaches ``least``: a random-looking value alone does not, one next to a word like token or key does. Each document
is scanned whole, inside one task, with patterns that run in time linear in the text; there is no shuffle.

Defined cases: null text counts as empty; repeated rows and ids each give one row; an empty table gives an empty
result; extra columns are ignored; digit runs of any length are read without converting them to numbers.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "secret")

LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]*")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: The longest run that an IBAN can be the beginning of; :func:`iban_end` says where it ends.
IBAN_RUN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
#: Characters of an IBAN by country code, as registered.
IBAN_LENGTH = {c: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in codes.split()}
ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")

#: Keys and tokens that their form gives away.
KNOWN_SECRET = re.compile(
    r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}"
    r"|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})(?![A-Za-z0-9])"
    r"|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----")
#: A value after a password word, and a run that may be a key.
PASSWORD = re.compile(r"(?i)\b(?:pass(?:word|wd|phrase|code)?|pwd)\b[ \t]{0,3}(?:is|=|:)[ \t]{0,3}[\"']?([^\s\"']{6,64})(?![^\s\"'.,;!?)])")
RANDOM_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])")
#: Bits a character of a random-looking run, at least.
ENTROPY = 3.0

#: Words that make a kind more likely, searched within CONTEXT characters before the span.
HINTS = {
    "email": re.compile(r"e-?mail|contact|write to", re.I), "ip": re.compile(r"\bip\b|address|host|server", re.I),
    "card": re.compile(r"card|visa|master|payment|credit", re.I), "phone": re.compile(r"phone|call|tel\b|mobile|fax", re.I),
    "iban": re.compile(r"iban|account|bank|transfer", re.I),
    "secret": re.compile(r"token|secret|pass(?:word|wd|phrase|code)|pwd|credential|bearer|api.?key|access.?key|private.?key|\bauth", re.I),
}
#: Words that speak against personal data.
AGAINST = re.compile(r"example|version|isbn|order no|serial|sample|checksum|\bsha-?[0-9]|\bmd5|commit|digest", re.I)
CONTEXT = 40
#: What a kind scores by itself; a secret of known form scores KNOWN_SCORE.
SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "secret": 0.4}
KNOWN_SCORE = 0.9
#: A span on top of the base kinds counts from this score on.
LEAST = 0.5


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def iban_end(text: str, start: int, stop: int) -> int | None:
    """End of the IBAN that begins at ``start`` of the run up to ``stop``; none if mod 97 confirms no possible end.

    It ends before a character that is no letter or digit, after as many characters as its country code has; a code
    that is not registered may have any length, and the longest one that is confirmed counts.
    """
    length = IBAN_LENGTH.get(text[start:start + 2])
    ends, chars = [], 0
    for k in range(start, stop):
        chars += text[k] != " "
        if text[k] != " " and chars >= 15 and length in (None, chars) and text[k + 1:k + 2] not in ALNUM:
            ends.append(k + 1)
    return next((e for e in reversed(ends) if mod97(text[start:e].replace(" ", ""))), None)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping IBANs; a start that fails is left by one character only."""
    m = IBAN_RUN.search(text)
    while m:
        end = iban_end(text, m.start(), m.end())
        if end:
            yield m.start(), end
        m = IBAN_RUN.search(text, end or m.start() + 1)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses: from each @, the run of local characters before it and the domain after it."""
    done, at = 0, text.find("@")
    local = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in local:
            start -= 1
        end = at + 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, (end := m.end())
        done = end
        at = text.find("@", end)


def entropy(value: str) -> float:
    """Bits a character, from how often each occurs."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def secrets(text: str) -> Iterator[tuple[int, int, float]]:
    """(start, end, score by itself) of possible secrets; a run holds letters and digits and looks random."""
    for m in KNOWN_SECRET.finditer(text):
        yield m.start(), m.end(), KNOWN_SCORE
    for m in PASSWORD.finditer(text):
        value = m[1].rstrip(".,;!?)")
        if len(value) >= 6 and not value.isalpha():
            yield m.start(1), m.start(1) + len(value), SCORE["secret"]
    for m in RANDOM_RUN.finditer(text):
        if any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0]) and entropy(m[0]) >= ENTROPY:
            yield m.start(), m.end(), SCORE["secret"]


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def spans(text: str, least: float = LEAST) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind as listed in KINDS: every confirmed base span, and those on top of them
    whose score reaches ``least``. Of secrets that overlap, the one that begins first counts, then the longest."""
    found = []
    if "@" in text:
        found += [("email", s, e) for s, e in emails(text)]
    if "." in text:
        found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(map(small, m.groups()))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text)
                  if 9 <= sum(m[0].count(d) for d in "0123456789") <= 15]
    scored = [(k, s, e, score(text, k, s, e)) for k, s, e in found]
    more = [("iban", s, e, score(text, "iban", s, e)) for s, e in ibans(text)]
    done = 0
    for s, e, own in sorted(secrets(text), key=lambda x: (x[0], -x[1])):
        points = score(text, "secret", s, e, own)
        if s >= done and points >= least:
            more.append(("secret", s, e, points))
            done = e
    scored += [x for x in more if x[3] >= least]
    return sorted(scored, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def score(text: str, kind: str, start: int, end: int, own: float | None = None) -> float:
    before = text[max(0, start - CONTEXT):start]
    points = SCORE[kind] if own is None else own
    return round(min(1.0, max(0.0, points + 0.2 * bool(HINTS[kind].search(before)) - 0.3 * bool(AGAINST.search(before)))), 2)


SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """doc_id and its spans (kind, start, end in code points, end exclusive, score), one row per document. Spans on top of the
    base kinds are those whose score reaches ``least``."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1):
                out.append([dict(zip(("kind", "start", "end", "score"), s)) for s in spans(text.as_py() or "", least)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, ARROW_SPANS)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def personal_data_digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans, all spans as text, their scores in the same order, and the number of
    secrets."""
    def joined(keep):
        return F.array_join(F.transform(keep, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))
    base = of(*BASE)
    return found.select(
        "doc_id", *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
        F.size(of("secret")).cast("bigint").alias("n_secret"))
