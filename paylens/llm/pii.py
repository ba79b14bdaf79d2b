"""Personal data by anchor expansion.

One Aho-Corasick automaton over fixed anchors (at-signs, plus signs, digits, schemes, identifier cues) scans every text
once. Each hit goes to a local parser that expands to both sides as far as its grammar allows, however long that is, and
validates what it found: number ranges, check digits, length. Parsers are deterministic and read each character a bounded
number of times.

Base kinds are email, ip, card and phone. Beyond them the cues add: email written with (at) and (dot), account (IBANs
with a right check number, and numbers named as accounts), address (house number and street), secret (keys, tokens and
passwords given as ``name = value``), and login (user and password inside a URL). What is added never overlaps a base
span. Texts run through Arrow batches, one text at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import pick, small_batches

BASE = ("email", "ip", "card", "phone")
SPAN = "array<struct<kind:string,start:int,end:int,base:boolean>>"

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

ACCOUNT_CUES = ("account number", "account no", "account", "acct", "kontonummer", "konto", "numéro de compte", "compte",
                "número de cuenta", "cuenta")
SECRET_CUES = ("token", "password", "passwd", "api_key", "apikey", "api key", "secret", "access_key", "private_key")
STREET_BEFORE = ("street", "road", "avenue", "lane", "drive", "boulevard")  # 12 Long Street
STREET_AFTER = ("straße", "strasse", "gasse")  # Lange Straße 12
STREET_LEAD = ("rue", "calle", "avenida")  # 12 rue Longue, calle Larga 12
_ACCOUNT_TAIL = re.compile(r"(?:\s|[.:#=]|no\b|number\b|nr\b){0,6}([0-9](?:[ -]?[0-9]){5,})")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_IBAN_START = re.compile(r"[A-Z]{2}[0-9]{2}")
_IBAN_CUE = re.compile(r"(?<![^\W_])(?:iban|IBAN|Iban)")
_NOT_BLANK = re.compile(r"\S|\Z")
_IBAN_STOP = re.compile(rf"\n|{_IBAN_CUE.pattern}")
IBAN_LENGTHS = {code[:2]: int(code[2:]) for code in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 "
    "FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 "
    "LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 "
    "RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
_SECRET_TAIL = re.compile(r"""["']?\s{0,3}[=:]\s{0,3}["']?([A-Za-z0-9+/_.=-]{8,})""")
_HOUSE_BEFORE = re.compile(r"(?<![0-9])[0-9]{1,5}[a-z]? $")
_STREET_WORDS = 3  # of a street's name, before its kind or behind it
_CAPITAL = re.compile(r"[A-ZÄÖÜ]")
_HOUSE_AFTER = re.compile(r" [0-9]{1,5}[a-z]?\b")
_NUMBER_LEAD = re.compile(r"(?<![0-9])[0-9]{1,5},? $")
_LEAD_TAIL = re.compile(r" (?:de |la |del |des |du |los |las ){0,2}(?:[A-ZÁÉÍÓÚÈÀÂ][\w'-]*+ ?){1,3}(,? ?[0-9]{1,5}\b)?")
_AT = re.compile(r" ?[(\[{] ?at ?[)\]}] ?", re.I)
_MASKED = re.compile(r"[A-Za-z0-9-]{1,63}(?: ?[(\[{] ?(?:dot|punkt|punto|point) ?[)\]}] ?[A-Za-z0-9-]{1,63}){1,5}", re.I)
_LOGIN = re.compile(r"[^\s/?#@:\"'<>]++:[^\s/?#@\"'<>]++@")


@cache
def _automaton() -> ahocorasick.Automaton:
    words = {"@": "@", "+": "+", "://": "login", **{d: "digit" for d in "0123456789"}}
    for kind, cues in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES), ("before", STREET_BEFORE),
                       ("after", STREET_AFTER), ("lead", STREET_LEAD), ("iban", ("iban",)), ("mask", ("(at)", "[at]", "{at}",
                        "( at )", "[ at ]"))):
        for cue in cues:
            words |= dict.fromkeys((cue, cue.upper(), cue.capitalize(), cue.title()), kind)
    automaton = ahocorasick.Automaton()
    for word, kind in words.items():
        automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _iban_ok(code: str) -> bool:
    code = code.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _left(text: str, at: int, stop: int) -> int:
    while at > stop and text[at - 1] in _LOCAL:
        at -= 1
    return at


def base_spans(text: str, hits: list[tuple[int, str]]) -> list[tuple[str, int, int]]:
    """Leftmost, non-overlapping spans of each base kind; a match that fails its check is dropped and passed over."""
    found = []
    email = chain = ip = phone = 0  # where the search of each kind goes on
    for at, kind in hits:
        if kind == "@":
            start = _left(text, at, email)
            if start < at and (domain := _DOMAIN.match(text, at + 1)):
                email = domain.end()
                found.append(("email", start, email))
        elif kind == "+":
            if at >= phone and (m := _PHONE.match(text, at)):
                phone = m.end()
                if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append(("phone", at, phone))
        elif kind == "digit":
            if at >= chain:
                m = _CHAIN.match(text, at)
                chain = m.end()
                digits = _NOT_DIGIT.sub("", m[0]) if 12 <= chain - at <= 37 else ""
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", at, chain))
            if at >= ip and not (at > ip and text[at - 1] in "0123456789" and text[at - 1].isascii()):
                if m := _IP.match(text, at):
                    ip = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                        found.append(("ip", at, ip))
    return sorted(found, key=lambda s: (s[1], BASE.index(s[0])))


def _account(text: str, start: int, end: int):
    m = _ACCOUNT_TAIL.match(text, end)
    return m and ("account", m.start(1), m.end(1))


def _ibans(text: str, at: int, stop: int) -> list[tuple[str, int, int]]:
    """All accounts of a stretch. A country's own length tells where one ends, whatever follows; for other countries every
    end is tried, the longest first."""
    found = []
    while m := _IBAN_START.search(text, at, stop):
        most = _IBAN.match(text, m.start()) or m
        ends = [k for k in range(most.start() + 1, most.end() + 1) if text[k - 1] != " "]
        size = IBAN_LENGTHS.get(most[0][:2])
        good = [k for k in (ends[size - 1:size] if size else ends[:13:-1])
                if not (text[k:k + 1].isascii() and text[k:k + 1].isalnum()) and _iban_ok(text[m.start():k])]
        found += [("account", m.start(), good[0])] if good else []
        at = good[0] if good else m.start() + 1
    return found


def _iban(text: str, start: int, end: int):
    """The accounts up to the end of the line, or to the next cue, which searches on from there; if the line has none, those
    of the next line that is not blank."""
    for _ in range(2):
        last = _IBAN_STOP.search(text, end)
        if found := _ibans(text, end, last.start() if last else len(text)):
            return found
        if not last or last[0] != "\n":
            return None
        end = _NOT_BLANK.search(text, last.end()).start()
    return None


def _secret(text: str, start: int, end: int):
    m = _SECRET_TAIL.match(text, end)
    return m and ("secret", m.start(1), m.end(1), any(c.isdigit() for c in m[1]))


def _left_word(text: str, at: int, marks: str) -> int:
    while at and (text[at - 1].isalnum() or text[at - 1] in marks):
        at -= 1
    return at


def _street_before(text: str, start: int, end: int):
    """The longest name of up to _STREET_WORDS capitalised words with a house number before it."""
    at, found = start, None
    for _ in range(_STREET_WORDS):
        if not at or text[at - 1] != " ":
            break
        word = _left_word(text, at - 1, "_'-")
        if word == at - 1 or not "A" <= text[word] <= "Z":
            break
        at = word
        if m := _HOUSE_BEFORE.search(text, max(0, at - 8), at):
            found = "address", m.start(), end
    return found


def _street_after(text: str, start: int, end: int):
    house = _HOUSE_AFTER.match(text, end)
    if not house:
        return None
    stop = start - (start > 0 and text[start - 1] in " -")
    stem = _CAPITAL.search(text, _left_word(text, stop, "_-"), stop)
    return (stem or text[start].isupper()) and ("address", stem.start() if stem else start, house.end())


def _street_lead(text: str, start: int, end: int):
    number, tail = _NUMBER_LEAD.search(text, max(0, start - 8), start), _LEAD_TAIL.match(text, end)
    if not tail or not (number or tail[1]):
        return None
    return "address", number.start() if number else start, tail.end() - (len(tail[0]) - len(tail[0].rstrip()))


def _masked(text: str, start: int, end: int):
    """Names and labels have at most 64 and 63 characters by the mail standard."""
    left = start - 1 if start and text[start - 1] == " " else start
    begin, m = _left(text, left, max(0, left - 64)), _MASKED.match(text, end + (text[end:end + 1] == " "))
    return m and begin < left and ("email", begin, m.end())


def _login(text: str, start: int, end: int):
    m = _LOGIN.match(text, end)
    return m and ("login", m.start(), m.end() - 1)


PARSERS: dict[str, Callable] = {"account": _account, "iban": _iban, "secret": _secret, "before": _street_before,
                                "after": _street_after, "lead": _street_lead, "mask": _masked, "login": _login}
_FREE_LEFT = {"after", "mask", "login"}  # cues that may follow a letter


def find(text: str | None) -> list[tuple[str, int, int, bool]]:
    """All spans of a text as (kind, start, end, base), by start, then base kinds as listed, then added ones."""
    text = text or ""
    hits, cues = [], []
    for last, (kind, size) in _automaton().iter(text):
        if kind in PARSERS:
            cues.append((last - size + 1, last + 1, kind))
        else:
            hits.append((last - size + 1, kind))
    if not hits and not cues:
        return []
    spans = [(*s, True) for s in base_spans(text, hits)]
    taken, free = sorted((s, e) for _, s, e, _ in spans), 0
    added, secret = [], 0
    for start, end, kind in cues:
        if kind not in _FREE_LEFT and start and text[start - 1].isalnum():
            continue
        if kind == "secret" and end + 1 < secret:  # its value would end where one ends that was read whole
            continue
        if got := PARSERS[kind](text, start, end):
            if kind == "secret":
                *got, good = got
                secret, got = got[2], [tuple(got)] if good else []
            added += got if isinstance(got, list) else [got]
    place = 0
    for kind, start, end in sorted(set(added), key=lambda s: (s[1], -s[2], s[0])):
        while place < len(taken) and taken[place][0] < start:
            free, place = max(free, taken[place][1]), place + 1
        if start >= free and not (place < len(taken) and taken[place][0] < end):
            spans.append((kind, start, end, False))
            free = end
    return sorted(spans, key=lambda s: (s[1], not s[3], BASE.index(s[0]) if s[0] in BASE else len(BASE), s[0]))


def _find_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in find(t)] for t in texts])


def spans(text: Column) -> Column:
    """The spans of a text (code points, end exclusive); a null or empty text has none."""
    return F.pandas_udf(_find_batches, SPAN)(text)


def find_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and spans.

    Null and empty texts have no span, long ones are read whole, repeated rows give repeated results, an id may be null,
    an empty table gives an empty result, other columns are ignored. Of added spans that overlap, the one that begins
    first stays, then the longer one.
    """
    return small_batches(pick(docs, doc_id=doc_id, text=text)).select("doc_id", spans(F.col("text")).alias("spans"))


def redact(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first counts."""
    step = F.aggregate(
        found, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, s: F.when(s.start < a["at"], a).otherwise(F.struct(F.concat(
            a["out"], F.substr(text, a["at"] + 1, s.start - a["at"]), F.lit("<"), s.kind, F.lit(">")).alias("out"),
            s.end.alias("at"))),
        lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1)))
    return F.when(F.size(found) == 0, text).otherwise(step)
