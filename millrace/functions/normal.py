"""Normal forms of texts, product names and answer values, and what values have in common.

Plain functions, and pandas UDFs of the same for columns. Null and empty texts give empty ones.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Signs that are written alike, by normal form.
DASHES, HYPHENS = "–—−", "‐‑‒⁃﹣－"
TEXT_SIGNS = str.maketrans({**dict.fromkeys(DASHES + HYPHENS, "-"), "’": "'", "“": '"', "”": '"', "­": None})
ANSWER_SIGNS = str.maketrans({**dict.fromkeys(DASHES, "-"), "º": "°", "×": "x", "®": None, "™": None})
NAME_MARKS, NAME_EDGES, ANSWER_EDGES = str.maketrans("", "", "®™©"), " .,:;-'\"()", " .;,"
#: Words after a number that are no units.
NO_UNITS = frozenset(("x", "or", "to", "and", "e", "s"))


def _plain(text: str | None, signs: dict) -> str:
    return " ".join(unicodedata.normalize("NFKC", text or "").translate(signs).split()).lower()


def text_form(text: str | None) -> str:
    """Compatibility forms, dashes and quotes alike, single blanks, small letters."""
    return _plain(text, TEXT_SIGNS)


def name_form(name: str | None) -> str:
    """The text form without marks of trade and without signs at the edges."""
    return text_form((name or "").translate(NAME_MARKS)).strip(NAME_EDGES)


def answer_form(value: str | None) -> str:
    """What two values are compared as."""
    return _plain(value, ANSWER_SIGNS).strip(ANSWER_EDGES)


def numbers(value: str | None) -> list[float]:
    """Numbers in a value. Commas group if they stand before three digits throughout, or alone before three; else they are decimal."""
    found = []
    for sign in re.findall(r"\d+(?:[.,]\d+)*", value or ""):
        parts = sign.split(",")
        grouped = re.fullmatch(r"\d{1,3}(?:,\d{3})+(?:\.\d+)?", sign) or ("." not in sign and len(parts[-1]) == 3)
        plain = sign.replace(",", "" if grouped else "." if "." not in sign else ",")
        try:
            found.append(float(plain))
        except ValueError:
            continue
    return found


def unit_words(value: str | None) -> set[str]:
    return set(re.findall(r"\d\s*([a-z°%\"']+(?:/[a-z]+)?)", answer_form(value))) - NO_UNITS


def holds(text: str, part: str) -> bool:
    """Whether the part occurs in the text as a run of whole tokens: no letter or digit goes on at its edges, and no number with a point."""
    text = text.replace("_", " ")
    if not part or part not in text:  # most pairs; a pattern need not be made
        return False
    before = r"(?<!\w)" if part[0].isalnum() else ""
    after = r"(?!\w)" if part[-1].isalnum() else ""
    before += r"(?<!\.)" if part[0].isdigit() else ""
    after += r"(?!\.\d)" if part[-1].isalnum() else ""
    return re.search(before + re.escape(part) + after, text) is not None


def _column(form):
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(form, na_action=None)

    return run


def normal_text(c: Column) -> Column:
    return _column(text_form)(c)


def normal_name(c: Column) -> Column:
    return _column(name_form)(c)


def normal_answer(c: Column) -> Column:
    return _column(answer_form)(c)
