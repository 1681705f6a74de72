r"""Personal data by anchor expansion.

An Aho-Corasick automaton passes over the whole text once and reports anchors: at-signs, a plus before a digit, a dot
between digits, two digits in a row or with a blank or hyphen between them, "://" schemes and identifier cues such as
"iban" or "ssn". From each anchor a deterministic parser walks outward to the boundaries of what it names and
validates it. Anchors that lie in a span already walked for their kind are passed over, so the work is linear.

Base kinds give the leftmost non-overlapping matches of their patterns, failing matches dropped without a retry:

* email `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+`
* ip `[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)`, parts at most 255
* card `[0-9]([\x20-]?[0-9])+`, 12 to 19 digits that pass Luhn's check
* phone `\+[0-9][\x20().0-9-]+[0-9]`, 9 to 15 digits

Further kinds: `login`, a URL that carries a user name (scheme://user[:password]@host); `account`, what follows a cue
for a bank account (two letters and 13 to 32 letters or digits that pass the mod-97 check, blanks between groups) or a
social security number (3-2-4 digits, hyphens or blanks between, no part all zeros).

Results: a null or empty text has no spans. Spans are in code points, ends exclusive, ordered by start, then kind.
Rows are independent, so repeated rows give equal results; an empty table gives an empty one.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.llm.arrow import extend

KINDS = ("email", "ip", "card", "phone", "login", "account")
_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LOCAL = _LETTERS | _DIGITS | frozenset("._%+-")
_LABEL = _LETTERS | _DIGITS | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_URL = _LETTERS | _DIGITS | frozenset("-._~%!$&'()*+,;=:")
#: Cues in lower case, and what follows them.
IBAN_CUES = ("iban", "account no", "account number", "kontonummer")
SSN_CUES = ("ssn", "social security")


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    ten = [str(d) for d in range(10)]
    a.add_word("@", ("email", 1))
    a.add_word("://", ("login", 3))
    for x in ten:
        a.add_word(f"+{x}", ("phone", 2))
        for y in ten:
            a.add_word(f"{x}.{y}", ("ip", 3))
            for gap in ("", " ", "-"):
                a.add_word(f"{x}{gap}{y}", ("card", 2 + len(gap)))
    for cue in IBAN_CUES + SSN_CUES:
        kind = "iban" if cue in IBAN_CUES else "ssn"
        for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
            a.add_word(form, (kind, len(form)))
    a.make_automaton()
    return a


def _run(text: str, at: int, allowed: frozenset) -> int:
    """The end of the run of allowed characters that starts at `at`."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def _run_back(text: str, at: int, allowed: frozenset, low: int) -> int:
    while at > low and text[at - 1] in allowed:
        at -= 1
    return at


def luhn(digits: list[str]) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


# Each parser takes the text, the anchor's start and end, and the end of its kind's last match. It gives the start and
# end of the match, or no start and the end of what cannot match any more.


def _email(text: str, a: int, b: int, low: int) -> tuple[int | None, int]:
    start = _run_back(text, a, _LOCAL, low)
    end = _run(text, b, _LABEL)
    if start == a or end == b:
        return None, low
    labels = 0
    while end < len(text) and text[end] == "." and (more := _run(text, end + 1, _LABEL)) > end + 1:
        end, labels = more, labels + 1
    return (start, end) if labels else (None, low)


def _ip(text: str, a: int, b: int, low: int) -> tuple[int | None, int]:
    start = _run_back(text, a + 1, _DIGITS, low)
    parts, at = [], start
    while len(parts) < 4:
        end = _run(text, at, _DIGITS)
        if end == at:
            break
        parts.append(text[at:end])
        done, at = end, end + 1
        if end >= len(text) or text[end] != ".":
            break
    if len(parts) < 4:
        return None, done
    # A part of very many digits is over 255 unless zeros lead it.
    good = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)
    return (start if good else None), done


def _card(text: str, a: int, b: int, low: int) -> tuple[int | None, int]:
    start = at = _run_back(text, a + 1, _DIGITS, low)
    digits = []
    while True:
        end = _run(text, at, _DIGITS)
        digits.extend(text[at:end])
        if end + 1 < len(text) and text[end] in " -" and text[end + 1] in _DIGITS:
            at = end + 1
        else:
            break
    return (start if 12 <= len(digits) <= 19 and luhn(digits) else None), end


def _phone(text: str, a: int, b: int, low: int) -> tuple[int | None, int]:
    end = _run_back(text, _run(text, b, _PHONE), _PHONE - _DIGITS, b)
    if end - b < 2:
        return None, low
    digits = sum(c in _DIGITS for c in text[a:end])
    return (a if 9 <= digits <= 15 else None), end


def _login(text: str, a: int, b: int, low: int) -> tuple[int | None, int]:
    start = _run_back(text, a, _LETTERS, low)
    user = _run(text, b, _URL)
    if start == a or user == b or user >= len(text) or text[user] != "@":
        return None, low
    end = _run(text, user + 1, _LABEL | {"."})
    return (start, end) if end > user + 1 else (None, low)


def _after_cue(text: str, at: int) -> int:
    """Past blanks, colons, equal signs and hashes, at most eight of them."""
    stop = min(len(text), at + 8)
    while at < stop and text[at] in " :=#.":
        at += 1
    return at


def _iban(text: str, a: int, b: int, low: int) -> tuple[int | None, int]:
    start = at = _after_cue(text, b)
    found, end = [], None
    while at < len(text) and len(found) < 34:
        if text[at] in _LETTERS or text[at] in _DIGITS:
            found.append(text[at].upper())
            at += 1
            if _iban_valid(found):
                end = at  # the longest that passes
        elif text[at] == " " and found and len(found) % 4 == 0:
            at += 1
        else:
            break
    return (None, low) if end is None or _run(text, end, _DIGITS) > end else (start, end)


def _iban_valid(found: list[str]) -> bool:
    if not 15 <= len(found) <= 34 or not (found[0] in _LETTERS and found[1] in _LETTERS and found[2] in _DIGITS and found[3] in _DIGITS):
        return False
    return int("".join(str(int(c, 36)) for c in found[4:] + found[:4])) % 97 == 1


def _ssn(text: str, a: int, b: int, low: int) -> tuple[int | None, int]:
    start = at = _after_cue(text, b)
    for n in (3, 2, 4):
        part = text[at : at + n]
        if len(part) < n or not _DIGITS.issuperset(part) or set(part) == {"0"}:
            return None, low
        at += n
        if n != 4 and at < len(text) and text[at] in " -":
            at += 1
    return (None, low) if at < len(text) and text[at] in _DIGITS else (start, at)


#: For each kind of anchor its parser and the kind of its spans.
_PARSERS = {"email": (_email, "email"), "ip": (_ip, "ip"), "card": (_card, "card"), "phone": (_phone, "phone"), "login": (_login, "login"), "iban": (_iban, "account"), "ssn": (_ssn, "account")}


def spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) in order."""
    out = []
    low = dict.fromkeys(_PARSERS, 0)
    for last, (anchor, width) in automaton().iter(text):
        a, b = last + 1 - width, last + 1
        if a < low[anchor]:
            continue
        parse, kind = _PARSERS[anchor]
        start, end = parse(text, a, b, low[anchor])
        if start is not None:
            out.append((start, KINDS.index(kind), end))
        low[anchor] = max(low[anchor], end)
    return sorted(out)


def found(df: DataFrame, text: str = "text") -> DataFrame:
    """Add `pii`: array of (start, number of the kind in KINDS, stop), in order. A column of that name is replaced."""
    item = T.StructType([T.StructField("start", T.IntegerType(), False), T.StructField("number", T.IntegerType(), False), T.StructField("stop", T.IntegerType(), False)])

    def make():
        def work(piece: pa.RecordBatch) -> list:
            return [[[{"start": a, "number": k, "stop": b} for a, k, b in spans(t)] if t else [] for t in piece.column(text).to_pylist()]]

        return work

    return extend(df, text, [T.StructField("pii", T.ArrayType(item, False), False)], make)


def redacted(df: DataFrame, text: str = "text") -> DataFrame:
    """`df` with every span of its text replaced by its kind in brackets; spans that overlap make one. Nulls stay."""

    def make():
        def work(piece: pa.RecordBatch) -> list:
            return [[t if t is None else _redact(t) for t in piece.column(text).to_pylist()]]

        return work

    return extend(df, text, [T.StructField(text, T.StringType(), True)], make).select(*df.columns)


def _redact(text: str) -> str:
    parts, at = [], 0
    for start, kind, end in spans(text):
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]]) if parts else text


def joined(array: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({array}, s -> concat_ws(':', array({names})[s.number], s.start, s.stop)), ',')")
