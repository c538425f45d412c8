"""Text, number and unit functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Factor to the dimension's base unit, by unit.
UNITS = {
    "mm": ("length", 0.001),
    "cm": ("length", 0.01),
    "m": ("length", 1.0),
    "km": ("length", 1000.0),
    "ft": ("length", 0.3048),
    "g": ("mass", 0.001),
    "kg": ("mass", 1.0),
    "lb": ("mass", 0.45359237),
    "t": ("mass", 1000.0),
    "km/h": ("speed", 1 / 3.6),
    "m/s": ("speed", 1.0),
}


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normalize_label(c: Column) -> Column:
    """Brackets dropped, symbols to blanks, maximum and minimum shortened, lower case."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(c), r"\([^)]*\)|\[[^\]]*\]", " "), r"[^a-z0-9]+", " ")
    return collapse(F.regexp_replace(F.regexp_replace(bare, r"\bmaximum\b", "max"), r"\bminimum\b", "min"))


def parse_number(c: Column) -> Column:
    """English or continental separators: the last of two kinds is the decimal sign; a lone one before three digits groups thousands."""
    s = F.regexp_replace(c, r"[\s ]", "")
    both = s.rlike(r"[.].*,") | s.rlike(r",.*[.]")
    comma_last = F.length(F.substring_index(s, ",", -1)) < F.length(F.substring_index(s, ".", -1))
    grouped = s.rlike(r"^[+-]?[0-9]{1,3}(,[0-9]{3})+$")
    plain = F.when(both & comma_last, F.translate(F.translate(s, ".", ""), ",", ".")).when(both | grouped, F.translate(s, ",", "")).otherwise(F.translate(s, ",", "."))
    return plain.try_cast("double")


def tokens(c: Column) -> Column:
    """Words in small letters; those of scripts without blanks between words as pairs of characters."""
    words = F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    pairs = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - 1, F.lit(1))), lambda i: F.substring(w, i, F.lit(2)))
    return F.flatten(F.transform(words, lambda w: F.when(w.rlike("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7a3\u0e00-\u0e7f]"), pairs(w)).otherwise(F.array(w))))


def search_tokens(c: Column) -> Column:
    """Runs of Latin and Cyrillic letters and digits, and signs of degrees, shares and inches, one by one; none of a null text."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[a-z0-9\u00C0-\u024F\u0400-\u04FF]+|[°%″′\"]"), F.lit(0))


def est_tokens(c: Column) -> Column:
    return (F.floor(F.length(c) / 3.6) + 1).cast("long")


def text_quality(c: Column) -> Column:
    """Share of letters, digits and blanks, three places."""
    good = F.length(F.regexp_replace(c, r"[^\p{L}\p{N} ]", ""))
    return F.round(good / F.greatest(F.length(c), F.lit(1)), 3)


def host(url: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(F.lower(url), r"^[a-z]+://([^/?#:]+)", 1), r"^www\.", "")


def locale(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://[^/]+/([a-z]{2})(?:[/?#]|$)", 1)


def to_base(value: Column, unit: Column) -> Column:
    return F.coalesce(*[F.when(unit == u, value * F.lit(f)) for u, (_, f) in UNITS.items()])


def dimension(unit: Column) -> Column:
    return F.coalesce(*[F.when(unit == u, F.lit(d)) for u, (d, _) in UNITS.items()])
