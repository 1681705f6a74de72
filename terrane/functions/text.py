"""Text normalisation as column expressions; all stay inside the JVM."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def _folding() -> tuple[str, str]:
    """Every letter of the Latin blocks that decomposes to an ASCII letter and marks, with that letter; and d with stroke."""
    pairs = {"đ": "d", "Đ": "D"}
    for code in range(0xC0, 0x1F00):
        base = unicodedata.normalize("NFD", chr(code))
        if len(base) > 1 and base[0].isascii() and all(unicodedata.category(m) == "Mn" for m in base[1:]):
            pairs[chr(code)] = base[0]
    return "".join(pairs), "".join(pairs.values())


def fold(x: Column) -> Column:
    """Without accents, precomposed or as combining marks. Case stays."""
    return F.regexp_replace(F.translate(x, *_folding()), r"\p{Mn}+", "")


def squeeze(x: Column) -> Column:
    """White space as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def words_only(x: Column) -> Column:
    """Folded, lower case, everything but a-z and 0-9 a blank."""
    return F.trim(F.regexp_replace(F.lower(fold(x)), r"[^a-z0-9]+", " "))


def project_name(x: Column) -> Column:
    """`words_only` without the generic words of project names."""
    return squeeze(F.regexp_replace(words_only(x), r"\b(the|du an|khu do thi|kdt|kdc)\b", " "))


#: Generic leading words of project names; each stands before those that it begins with.
PROJECT_PREFIXES = (
    "khu do thi moi", "khu do thi", "khu dan cu", "khu biet thu", "khu nghi duong", "khu nha pho", "cao oc van phong",
    "toa nha van phong", "can ho chung cu", "can ho dich vu", "can ho", "chung cu", "van phong", "khu phuc hop",
)


def project_core(x: Column) -> Column:
    """`project_name` without leading generic words, however many stand there."""
    return F.trim(F.regexp_replace(project_name(x), f"^(?:(?:{'|'.join(PROJECT_PREFIXES)})(?: |$))+", ""))


def trailing_number(name: Column) -> Column:
    """The number at the end of a name, one letter after it allowed; null if none."""
    return F.nullif(F.regexp_extract(name, r"(\d+)(?:\s*[a-z])?$", 1), F.lit(""))


def place_name(x: Column, kinds: str) -> Column:
    """Folded, lower case, abbreviations of kinds of places spelt out, then without a leading kind (alternatives)."""
    y = F.lower(fold(x))
    for short, full in (("tt", "thi tran"), ("p", "phuong"), ("x", "xa")):
        y = F.regexp_replace(y, rf"\b{short}(?:\.\s*|\s+)", f"{full} ")
    return F.trim(F.regexp_replace(squeeze(y), rf"^(?:{kinds})\s+", ""))


def province_name(x: Column) -> Column:
    return place_name(x, r"tp\.?|thanh pho|tinh")


def ward_name(x: Column) -> Column:
    """A ward's name; a name that is a number loses its zeros."""
    return F.regexp_replace(place_name(x, "phuong|xa|thi tran"), r"^0+(\d+)$", "$1")


def slug(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(fold(x)), r"[^a-z0-9]+", "-"), F.lit("-"))


def address_part(address: Column, from_end: int) -> Column:
    """The part that is `from_end` commas from the end (1: last); null if there are fewer."""
    parts = F.split(address, ",", -1)
    return F.trim(F.try_element_at(parts, F.lit(-from_end)))


def street_part(address: Column) -> Column:
    """What stands before the last three parts; null if there are no more than three."""
    parts = F.split(address, ",", -1)
    n = F.size(parts)
    return F.when(n > 3, F.trim(F.array_join(F.slice(parts, 1, F.greatest(n - 3, F.lit(0))), ",")))


def normal_url(url: Column) -> Column:
    """Scheme and host in lower case, query parameters sorted by key, no fragment, no slash at the end of the path."""
    u = F.trim(url)
    bare = F.regexp_replace(u, "#.*$", "")
    head = F.substring_index(bare, "?", 1)
    origin = F.lower(F.regexp_extract(head, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1))
    path = F.regexp_replace(F.regexp_replace(head, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", ""), "/+$", "")
    query = F.when(bare.contains("?"), F.substring(bare, F.char_length(head) + 2, F.char_length(bare)))
    pairs = F.filter(F.split(query, "&", -1), lambda p: p != "")
    order = F.transform(pairs, lambda p, i: F.struct(F.substring_index(p, "=", 1).alias("k"), i.alias("i"), F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("="))).alias("p")))
    joined = F.array_join(F.transform(F.array_sort(order), lambda s: s["p"]), "&")
    return F.concat(origin, F.when(path == "", "/").otherwise(path), F.when(F.coalesce(F.size(pairs), F.lit(0)) > 0, F.concat(F.lit("?"), joined)).otherwise(""))


def phone(x: Column) -> Column:
    """The first phone number of a text, its blanks, dots and hyphens removed; null if masked or of under nine digits."""
    found = F.regexp_extract(x, r"\+?\d[\d\s.\-]{7,}\d", 0)
    digits = F.regexp_replace(found, r"[\s.\-]", "")
    return F.when((found != "") & ~x.contains("*") & (F.char_length(F.regexp_replace(digits, r"\D", "")) >= 9), digits)


def degrees(x: Column) -> Column:
    """Degrees, minutes and seconds with a hemisphere as a decimal number, south and west negative."""
    p = r"""(\d+)\s*°\s*(\d+)\s*['′]\s*([\d.]+)\s*["″]\s*([NSEWnsew])"""
    g = [F.regexp_extract(x, p, i) for i in range(1, 5)]
    size = g[0].try_cast("double") + g[1].try_cast("double") / 60 + g[2].try_cast("double") / 3600
    return F.when(F.lower(g[3]).isin("s", "w"), -size).otherwise(size)


def without_markup(x: Column) -> Column:
    """Markdown links by their text, then images, tags and runs of white space removed."""
    y = F.regexp_replace(x, r"\[([^\]]*)\]\([^)]*\)", "$1")
    y = F.regexp_replace(y, r"!\[[^\]]*\]\([^)]*\)", "")
    return squeeze(F.regexp_replace(y, "<[^>]+>", " "))


def filled(x: Column) -> Column:
    """Whether a text is neither null nor blank."""
    return F.coalesce(F.trim(x) != "", F.lit(False))


def one_line(x: Column, length: int = 50) -> Column:
    """The first characters of the text without its line breaks."""
    return F.left(F.regexp_replace(x, r"[\n\r]", ""), F.lit(length))


def coordinates(url: Column) -> Column:
    """Latitude and longitude of a link to a map, as a text; null without them."""
    number = lambda i: F.nullif(F.regexp_extract(url, r"(?i)(?:center|q)=(-?\d+\.?\d*),\s*(-?\d+\.?\d*)", i), F.lit("")).try_cast("double")
    return F.concat(number(1).cast("string"), F.lit(","), number(2).cast("string"))
