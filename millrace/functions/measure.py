"""Measurements in text: numbers with units are read as atoms, and connectors between neighbours make ranges, pairs and products of them."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

#: Factor to the dimension's base unit and dimension, by unit; forms that differ by case stand apart in CASED.
UNITS = {
    "mm": (0.001, "length"), "cm": (0.01, "length"), "m": (1.0, "length"), "km": (1000.0, "length"), "ft": (0.3048, "length"), "in": (0.0254, "length"), "inch": (0.0254, "length"),
    "nm": (1852.0, "length"), "mi": (1609.344, "length"), "yd": (0.9144, "length"),
    "g": (0.001, "mass"), "kg": (1.0, "mass"), "t": (1000.0, "mass"), "lb": (0.45359237, "mass"), "lbs": (0.45359237, "mass"), "oz": (0.028349523125, "mass"),
    "km/h": (1 / 3.6, "speed"), "kph": (1 / 3.6, "speed"), "mph": (0.44704, "speed"), "m/s": (1.0, "speed"), "m/sec": (1.0, "speed"), "fps": (0.3048, "speed"), "kts": (1852 / 3600, "speed"), "knots": (1852 / 3600, "speed"),
    "hp": (745.7, "power"), "kw": (1000.0, "power"), "mw": (1e6, "power"), "hz": (1.0, "frequency"), "khz": (1e3, "frequency"), "mhz": (1e6, "frequency"), "ghz": (1e9, "frequency"),
    "s": (1.0, "time"), "sec": (1.0, "time"), "min": (60.0, "time"), "h": (3600.0, "time"), "hours": (3600.0, "time"), "rpm": (1 / 60, "rate"), "rds/min": (1 / 60, "rate"), "rounds/min": (1 / 60, "rate"),
    "v": (1.0, "voltage"), "l": (0.001, "volume"), "litres": (0.001, "volume"), "bar": (1e5, "pressure"), "psi": (6894.757, "pressure"), "kgm": (9.80665, "torque"), "°": (1.0, "angle"), "°c": (1.0, "temperature"), "db": (1.0, "level"),
}
CASED = {"Nm": (1.0, "torque"), "kN": (1e3, "force"), "KN": (1e3, "force"), "N": (1.0, "force"), "kn": (1852 / 3600, "speed"), "W": (1.0, "power"), "J": (1.0, "energy")}
#: Things that are counted, and words before a value that make it a bound.
COUNTED = "man crew rounds troops seats passengers wheels cylinders barrels tubes missiles channels persons soldiers members".split()
BOUNDS = {
    "up_to": ["up to", "upto", "max", "max.", "maximum", "bis zu"],
    "at_least": ["at least", "min", "min.", "minimum"],
    "gt": ["over", "more than", "above", "in excess of", "exceeding", "greater than", ">"],
    "lt": ["less than", "under", "below", "<"],
    "ge": [">=", "≥"],
    "le": ["<=", "≤"],
    "approx": ["approx", "approx.", "approximately", "about", "around", "ca.", "circa", "nearly", "almost", "~", "≈", "±"],
}
OF_WORD = {w: c for c, words in BOUNDS.items() for w in words}


def _spaced(u: str) -> str:
    return r"\s?/\s?".join(re.escape(p) for p in u.split("/"))


_ANY_CASE = "|".join(_spaced(u) for u in sorted(UNITS, key=len, reverse=True))
_OWN_CASE = "|".join(_spaced(u) for u in sorted(CASED, key=len, reverse=True))
ATOM = re.compile(
    rf"(?:(?<![\w.,])|(?<=\d[xX×]))(?P<num>[-−+]?(?:\d{{1,3}}(?:[ ,.]\d{{3}})+(?:[.,]\d+)?|\d+(?:[.,]\d+)?|[.]\d+))(?P<plus>\s?\+)?"
    rf"(?:\s?-?\s?(?P<unit>(?:{_OWN_CASE}|(?i:{_ANY_CASE})|%|(?i:percent)|(?i:{'|'.join(COUNTED)}))(?![\w])))?",
)
#: What may stand between two atoms, and the kind it makes.
LINKS = [("range", re.compile(r"\s*(?:to|–|—|-|bis|\.\.\.|…)\s*\Z")), ("product", re.compile(r"\s*[x×X*]\s*\Z")), ("dual", re.compile(r"\s*[(\[]\s*\Z")), ("dual", re.compile(r"\s*/\s*\Z")), ("ratio", re.compile(r"\s?:\s?\Z"))]
BEFORE = re.compile(r"(?:(?<=\s)|\A|(?<=\())(" + "|".join(re.escape(w) for w in sorted(OF_WORD, key=len, reverse=True)) + r")\s*\Z", re.IGNORECASE)


@dataclass
class Found:
    a: int
    b: int
    kind: str
    values: list[tuple[float, str | None]] = field(default_factory=list)
    comparator: str = "eq"


def number(s: str) -> float | None:
    """The last of two separators is the decimal sign; a lone one before three digits groups thousands, but for 0.xxx."""
    t = re.sub(r"[  ]", "", s.replace("−", "-").lstrip("+"))
    if "," in t and "." in t:
        t = t.replace(",", "") if t.rindex(".") > t.rindex(",") else t.replace(".", "").replace(",", ".")
    elif re.fullmatch(r"-?[1-9]\d{0,2}(,\d{3})+", t) or re.fullmatch(r"-?\d{1,3}(\.\d{3}){2,}", t):
        t = t.replace(",", "").replace(".", "")
    else:
        t = t.replace(",", ".")
    try:
        return float(t)
    except ValueError:
        return None


def unit_key(u: str | None) -> str | None:
    if u is None:
        return None
    u = re.sub(r"\s", "", u)
    return u if u in CASED else u.lower()


def dimension(u: str | None) -> str | None:
    if u is None:
        return None
    if u in ("%", "percent"):
        return "ratio"
    return "count" if u in COUNTED else (CASED.get(u) or UNITS.get(u) or (0, None))[1]


def base(value: float, u: str | None) -> float | None:
    factor = CASED.get(u or "") or UNITS.get(u or "")
    return None if factor is None else round(value * factor[0], 6)


def _link(text: str, left: re.Match, right: re.Match) -> str | None:
    gap = text[left.end() : right.start()]
    if len(gap) > 6:
        return None
    for kind, rule in LINKS:
        if rule.match(gap):
            return kind
    return None


def _group(text: str, atoms: list[re.Match]) -> list[tuple[str, list[re.Match]]]:
    """Neighbours with a connector joined from the left; a group has one kind of connector."""
    out: list[tuple[str, list[re.Match]]] = []
    for atom in atoms:
        if out:
            kind, group = out[-1]
            link = _link(text, group[-1], atom)
            fits = link in ("range", "ratio", "dual") and len(group) == 1 or link == "product" and len(group) < 3
            if link == "dual" and not (group[-1]["unit"] and atom["unit"]):
                fits = False
            if link == "range" and not atom["unit"]:
                fits = False
            if fits and kind in ("one", link):
                out[-1] = (link, [*group, atom])
                continue
        out.append(("one", [atom]))
    return out


def _kind(text: str, kind: str, values: list[tuple[float, str | None]]) -> str | None:
    """The kind of a group; None for plain numbers, years and product codes."""
    a, u = values[0]
    if kind == "one":
        if u is None or (u in ("s", "in") and 1900 <= a <= 2099) or (u in COUNTED and 1900 < a <= 2099):
            return None
        return "percent" if u in ("%", "percent") else "count" if u in COUNTED else "scalar"
    if kind == "ratio":
        return "ratio" if values[1] == (1.0, None) else None
    if kind == "product":
        (b, v), whole = values[1], a.is_integer()
        if len(values) == 3:
            return "composite" if any(x for _, x in values) else None
        if u is None and v is None:
            return "config" if whole and b.is_integer() and {a, b} <= {2, 4, 6, 8, 10, 12, 14, 16} else "calibre" if 4.5 <= a < b and 18 <= b <= 230 else None
        if u is None and a >= 4.5 and 18 <= b <= 230 and b > a and b.is_integer() and v == "mm":
            return "calibre"
        return "multiplier" if u is None and whole and a <= 16 else "composite"
    return kind if any(x for _, x in values) else None


def find(text: str | None) -> list[Found]:
    """Measurements in order, none overlapping; null and text without digits have none. One pass over the text."""
    out = []
    for kind, group in _group(text or "", [m for m in ATOM.finditer(text or "") if number(m["num"]) is not None and (m["unit"] or not text[m.end() : m.end() + 1].isalpha() or text[m.end()] in "xX×")]):
        values = [(number(m["num"]), unit_key(m["unit"])) for m in group]
        made = _kind(text, kind, values)
        if made is None:
            continue
        a, b = group[0].start(), group[-1].end()
        if made == "dual" and text[group[0].end() : group[-1].start()].strip() in ("(", "["):
            close = re.match(r"\s*[)\]]", text[b:])
            b += close.end() if close else 0
        found = Found(a, b, made, values)
        word = BEFORE.search(text[max(0, a - 24) : a])
        if word and made in ("scalar", "range", "dual", "count", "percent"):
            found.a = max(0, a - 24) + word.start(1)
            found.comparator = OF_WORD[word[1].lower()]
            found.kind = "bound" if made == "scalar" else made
        elif made == "scalar" and group[0]["plus"]:
            found.comparator, found.kind = "at_least", "bound"
        out.append(found)
    return out
