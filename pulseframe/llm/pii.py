"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Base kinds (always kept when their own test holds): ``email``, ``ip`` (parts at
most 255), ``card`` (12 to 19 digits, Luhn), ``phone`` (9 to 15 digits).  Added
kinds, kept when their score reaches ``min_score``: ``iban`` (mod-97),
``ssn`` (area, group and serial rules; needs a context word nearby), ``secret``.

Secrets: keys of a known form (fixed prefix and length); private keys, from their first
to their last line; values given to a name such as token or password, which must look
drawn at random (length, entropy per character, digits among letters); and long
strings of that look with a context word nearby.

Matches of a kind are leftmost and do not overlap; a base match that fails its
test is dropped without a second try inside it.  An account number may run on
into the next upper-case words or numbers: every word end at 15 to 34 characters
is tested, the length of its country first, then the longest; if none holds, the
search goes on behind its first four characters.  Every pattern runs in time
linear in the text.  Scores: a prior per kind, plus a checksum bonus, plus a bonus for
a context word within ``CONTEXT_CHARS`` before or after.

Null and empty texts have no spans.  Rows are handled each on its own (ties,
repeated rows and null ids do not matter); ``redact`` keeps all columns.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm.common import per_row, table, text_bytes

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "secret")
MIN_SCORE = 0.5
CONTEXT_CHARS = 48
#: kind: (prior, checksum bonus, context bonus, context words)
SCORES = {
    "email": (0.8, 0.0, 0.2, "mail email e-mail contact write correo courriel"),
    "ip": (0.6, 0.0, 0.3, "ip address host server login adresse"),
    "card": (0.3, 0.4, 0.3, "card credit debit visa mastercard payment karte carte tarjeta"),
    "phone": (0.6, 0.0, 0.3, "phone tel call mobile fax telefon téléphone teléfono"),
    "iban": (0.2, 0.5, 0.3, "iban account bank konto compte cuenta transfer"),
    "ssn": (0.3, 0.0, 0.4, "ssn social security"),
    "secret": (0.3, 0.5, 0.3, "token secret password passwd key credential auth bearer api"),
}
_CONTEXT = {k: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, v[3].split())) + r")(?!\w)", re.I)
            for k, v in SCORES.items()}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits is taken whole: what follows it decides, so no later start inside can match.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+")
_WORD_END = re.compile(r"(?<! )(?![A-Za-z0-9])")
#: Characters of an account number by country (registry of ISO 13616).
_IBAN_CHARS = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 "
    "GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 "
    "ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SD18 SE24 SI19 SK24 SM27 ST25 SV28 TN24 "
    "TR26 UA29 VA22 VG24 XK20").split()}
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_KEY = re.compile(r"(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,255}+|xox[abprs]-[A-Za-z0-9-]{10,255}+)(?![A-Za-z0-9_])")
_PEM = re.compile(r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----")
_PEM_END = re.compile(r"-----END (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----")
_GIVEN = re.compile(r"(?<![A-Za-z0-9])(token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|auth[_-]?key)[\"']?[ \t]{0,3}[:=][ \t]{0,3}[\"']?"
                    r"([A-Za-z0-9+/_.~!@#$%^&*=-]{8,}+)", re.I)
_LONG = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}+={0,2}(?![A-Za-z0-9+/_=-])")
#: Least characters and least bits of entropy per character of a value that looks random.
RANDOM_CHARS, RANDOM_BITS, PASSWORD_CHARS = 16, 3.0, 8
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        total += _DOUBLED[int(c)] if k % 2 else int(c)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """ISO 7064 check of an account number whose first four characters move to the end."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the longest local part before it and the domain after it."""
    done = 0
    at = text.find("@")
    while at >= 0:
        if at >= done and (domain := _DOMAIN.match(text, at + 1)):
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = domain.end()
                yield start, done
        at = text.find("@", at + 1)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers that end at a word end and hold their checksum."""
    m = _IBAN.search(text)
    while m:
        start, done = m.start(), m.start() + 4
        ends = [(k, account) for k in range(start + 15, m.end() + 1)
                if _WORD_END.match(text, k) and 15 <= len(account := text[start:k].replace(" ", "")) <= 34]
        usual = _IBAN_CHARS.get(m[0][:2])
        for end, account in sorted(ends, key=lambda e: (len(e[1]) != usual, -e[0])):
            if mod97(account):
                yield start, end
                done = end
                break
        m = _IBAN.search(text, done)


def entropy(value: str) -> float:
    """Bits per character by the value's own character counts."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def looks_random(value: str) -> bool:
    return (RANDOM_CHARS <= len(value) <= 512 and any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
            and entropy(value) >= RANDOM_BITS)


def secrets(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whether its form says so); leftmost first, without overlaps."""
    found = [(*m.span(), True) for m in _KEY.finditer(text)]
    end = 0
    for m in _PEM.finditer(text) if "PRIVATE KEY-----" in text else ():
        if m.start() >= end:
            last = _PEM_END.search(text, m.end())
            end = last.end() if last else m.end()
            found.append((m.start(), end, True))
            if not last:
                break  # none later has an end either
    for m in _GIVEN.finditer(text):
        value = m[2].rstrip(".!")
        password = m[1].lower() in ("password", "passwd", "pwd")
        if looks_random(value) or (password and PASSWORD_CHARS <= len(value) <= 512 and any(c.isdigit() for c in value) and not value.isdigit()):
            found.append((m.start(2), m.start(2) + len(value), True))
    found += [(*m.span(), False) for m in _LONG.finditer(text) if looks_random(m[0])]
    end = 0
    for start, stop, checked in sorted(found, key=lambda x: (x[0], -x[1], not x[2])):
        if start >= end:
            yield start, stop, checked
            end = stop


def proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, whether a checksum holds); what fails its test is left out."""
    for start, end in emails(text):
        yield "email", start, end, False
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end(), False
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 40 and 12 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            yield "card", m.start(), m.end(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                yield "phone", m.start(), m.end(), False
    for start, end in ibans(text):
        yield "iban", start, end, True
    for m in _SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            yield "ssn", m.start(), m.end(), False
    for start, end, checked in secrets(text):
        yield "secret", start, end, checked


def spans_of(text: str, min_score: float = MIN_SCORE) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) by start, then kind as listed."""
    found = []
    for kind, start, end, checked in proposals(text):
        prior, checksum, context, _ = SCORES[kind]
        near = (_CONTEXT[kind].search(text, max(0, start - CONTEXT_CHARS), start)
                or _CONTEXT[kind].search(text, end, end + CONTEXT_CHARS))
        score = prior + checksum * checked + context * bool(near)
        if kind in BASE or score >= min_score:
            found.append((start, end, kind, round(min(1.0, score), 3)))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


_FOUND = pa.schema([("id", pa.int64()), ("spans", pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))])


def find(docs: DataFrame, min_score: float = MIN_SCORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end, score>>); offsets are code points, end exclusive."""
    def rows(ids, texts):
        for key, text in zip(ids, texts):
            yield key, [{"kind": k, "start": s, "end": e, "score": x}
                        for s, e, k, x in spans_of(text.decode("utf-8", "replace"), min_score)]
    return docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("t")).mapInArrow(
        per_row(_FOUND, rows), "id long, spans array<struct<kind:string,start:int,end:int,score:double>>")


def redacted(text: str, min_score: float = MIN_SCORE) -> str:
    """The text with every span replaced by ``[KIND]``; of overlapping spans, one mark."""
    out, done = [], 0
    for start, end, kind, _ in spans_of(text, min_score):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]]) if out else text


def redact(docs: DataFrame, min_score: float = MIN_SCORE, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data masked in the text; every row and column is kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                batch = big.slice(at, 256)
                k = batch.schema.get_field_index(text_col)
                texts = [None if t is None else redacted(t, min_score) for t in batch.column(k).to_pylist()]
                yield batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))
    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col("id").alias("doc_id"), *map(count, BASE),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        count("iban"), count("ssn"), count("secret"), F.size("spans").cast("long").alias("n_spans"))
