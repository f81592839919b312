"""Recorded dimensions, as written, read into measurements.

A value is cut into tokens, the tokens into segments, and a segment is read by descent: crosses of items, each a measure with
words for its axis, unit and qualifiers around it. Where a segment can't be read, it is tried again with "by" as a cross,
with a cross between a unit and the next axis, and without the words at its end, the least change first.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from .lexer import column_parser

# Units with their spellings, classes, base factors and exact pairs; words of axes; qualifiers; fractions.
SPELLINGS = {
    "mm": "mm mms millimetre millimetres millimeter millimeters", "cm": "cm cms centimetre centimetres centimeter centimeters", "m": "m metre metres meter meters",
    "in": "in ins inch inches inhes", "ft": "ft foot feet", "g": "g gm gms gram grams gramme grammes", "kg": "kg kgs kilogram kilograms", "lb": "lb lbs pound pounds",
    "oz": "oz ounce ounces", "ton": "ton tons tonne tonnes", "ml": "ml millilitre millilitres", "deg": "deg degree degrees", "min": "min mins minute minutes", "sec": "sec secs second seconds",
}
UNITS = {word: unit for unit, words in SPELLINGS.items() for word in words.split()}
CLASSES = {"linear": "mm cm m in ft", "mass": "g kg lb oz ton", "volume": "ml", "angle": "deg", "time": "min sec"}
CLASS_OF = {unit: name for name, units in CLASSES.items() for unit in units.split()}
TO_BASE = {"mm": 1.0, "cm": 10.0, "m": 1000.0, "in": 25.4, "ft": 304.8, "g": 1.0, "kg": 1000.0, "lb": 453.59237, "oz": 28.349523125, "ml": 1.0, "deg": 1.0, "min": 60.0, "sec": 1.0}
PAIRS = {("ft", "in"): 12, ("lb", "oz"): 16, ("kg", "g"): 1000}
AXES = {
    "height": "height high ht h", "width": "width wide wd w", "depth": "depth deep dp d", "length": "length long len l", "diameter": "diameter diam dia", "thickness": "thickness thick",
    "breadth": "breadth", "weight": "weight wt weighs", "circumference": "circumference circ", "radius": "radius",
}
AXIS_OF = {word: axis for axis, words in AXES.items() for word in words.split()}
QUALIFIERS = {"approx": "approx approximate approximately about ca circa est estimated", "maximum": "max maximum", "minimum": "min minimum", "exact": "exact exactly", "nominal": "nominal normally"}
QUALIFIER_OF = {word: q for q, words in QUALIFIERS.items() for word in words.split()}
FRACTIONS = {"¼": "1/4", "½": "1/2", "¾": "3/4", "⅓": "1/3", "⅔": "2/3", "⅕": "1/5", "⅖": "2/5", "⅗": "3/5", "⅘": "4/5", "⅙": "1/6", "⅚": "5/6", "⅛": "1/8", "⅜": "3/8", "⅝": "5/8", "⅞": "7/8"}
UNSURE_AXES = ("d",)
BARE_AXES = ("height", "width", "depth")

_LEX = re.compile(r"""
    (?P<frac>\d+/\d+) | (?P<number>\d{1,3}(?:,\d{3})+(?!\d)(?:\.\d+)? | \d+,\d{1,2}(?!\d) | \d+\.\d+ | \d+ | \.\d+)
  | (?P<inches>["″“”]) | (?P<prime>['′‘’]) | (?P<vulgar>[¼½¾⅓⅔⅕⅖⅗⅘⅙⅚⅛⅜⅝⅞]) | (?P<word>[^\W\d_]+) | (?P<sep>[;,\n\r]) | (?P<mark>\S)
""", re.X)  # fmt: skip
_DOTTED_MIXED = re.compile(r"(?P<whole>\d+)\.(?P<part>\d+/\d+)")
MARKS = {"×": "x", "*": "x", "–": "-", "—": "-", "[": "(", "]": ")", "=": ":", "~": "about"}


@dataclass(frozen=True)
class Token:
    """kind: number, frac, unit, word, or the mark itself; ``text`` as it stands, ``value`` of numbers and units."""

    kind: str
    text: str
    value: object = None


def lex(text: str, prime_unit: str) -> list[Token]:
    out: list[Token] = []
    at = 0
    after_digit = False
    while m := _DOTTED_MIXED.match(text, at) or _LEX.search(text, at):
        if mixed := _DOTTED_MIXED.match(text, m.start()):  # 18.5/8 is 18 and 5/8
            out += [_number(mixed["whole"]), Token("frac", mixed["part"])]
            at, after_digit = mixed.end(), True
            continue
        kind, own = m.lastgroup, m[0]
        at = m.end()
        if kind == "number":
            out.append(_number(own))
        elif kind == "frac":
            out.append(Token("frac", own))
        elif kind == "vulgar":
            out.append(Token("frac", FRACTIONS[own]))
        elif kind in ("inches", "prime") and after_digit:
            unit = "in" if kind == "inches" else prime_unit
            out.append(Token("unit", unit, unit))
        elif kind == "sep":
            out.append(Token("sep", own))
        elif kind == "word":
            # A cross may stand glued to the word before it: 4insx6ins.
            if own != "x" and own.endswith("x") and text[at : at + 1].isdigit():
                out += [_word(own[:-1]), Token("x", "x")]
            else:
                out.append(_word(own))
            if text[at : at + 1] == "." and not text[at + 1 : at + 2].isdigit():
                at += 1  # the dot of an abbreviation
        else:
            mark = MARKS.get(own, own)
            out.append(_word(mark) if mark.isalpha() and mark != "x" else Token(mark, mark))
        after_digit = kind in ("number", "frac", "vulgar")
    return out


def _number(own: str) -> Token:
    head, _, tail = own.partition(",")
    plain = own.replace(",", "") if len(tail.split(".")[0].split(",")[0]) == 3 else own.replace(",", ".")
    return Token("number", plain, float(plain))


def _word(own: str) -> Token:
    return Token("x", "x") if own == "x" else Token("unit", own, UNITS[own]) if own in UNITS else Token("word", own)


def _known(t: Token) -> bool:
    return t.kind == "unit" or t.text in AXIS_OF or t.text in QUALIFIER_OF


def _measured(t: Token) -> bool:
    return t.kind in ("number", "frac") or any(c.isdigit() for c in t.text)


class Reader:
    """A descent over a segment's tokens; ``ValueError`` where they aren't a chain of items."""

    def __init__(self, own: list[Token]):
        self.own, self.at = own, 0

    def peek(self, ahead: int = 0) -> Token:
        return self.own[self.at + ahead] if self.at + ahead < len(self.own) else Token("end", "")

    def take(self) -> Token:
        self.at += 1
        return self.own[self.at - 1]

    def chain(self) -> list[dict]:
        items = [self.item()]
        while self.peek().kind == "x":
            self.take()
            items.append(self.item())
        if self.peek().kind != "end":
            raise ValueError
        return items

    def item(self) -> dict:
        out = {"entries": [], "axis": None, "unsure": False, "unit": None, "qualifiers": []}
        while (t := self.peek()).text in QUALIFIER_OF or t.text in AXIS_OF:
            self.named(out, self.take())
            if self.peek().kind == ":":
                self.take()
        out["entries"] = self.measure()
        while (t := self.peek()).kind == "unit" or t.text in AXIS_OF or t.text in QUALIFIER_OF:
            self.take()
            if t.kind == "unit":
                out["unit"] = t.value
            else:
                self.named(out, t)
        return out

    def named(self, out: dict, t: Token) -> None:
        if t.text in AXIS_OF:
            out["axis"], out["unsure"] = AXIS_OF[t.text], t.text in UNSURE_AXES
        else:
            out["qualifiers"].append(QUALIFIER_OF[t.text])

    def measure(self) -> list[tuple[float, str | None, str | None]]:
        """(value, qualifier, unit) of a number, of the ends of a range, or of a sum in two units."""
        low = self.number()
        if self.peek().text in ("-", "to"):
            self.take()
            high = self.number()
            if low > high:
                raise ValueError
            return [(low, "minimum", None), (high, "maximum", None)]
        if self.peek().kind == "unit" and self.peek(1).kind == "number":
            large, more, small = self.take(), self.take(), self.take()
            factor = PAIRS.get((large.value, small.value)) if small.kind == "unit" else None
            if factor is None:
                raise ValueError
            return [(low * factor + more.value, None, small.value)]
        return [(low, None, None)]

    def number(self) -> float:
        t = self.take() if self.peek().kind in ("number", "frac") else None
        if t is None:
            raise ValueError
        if t.kind == "frac":
            return self.fraction(t)
        return t.value + (self.fraction(self.take()) if self.peek().kind == "frac" else 0)

    def fraction(self, t: Token) -> float:
        a, b = map(int, t.text.split("/"))
        if not b:
            raise ValueError
        return a / b


def joined(*words: str | None) -> str | None:
    return " ".join(dict.fromkeys(w for w in words if w)) or None


def with_context(own: list[Token]) -> tuple[list[Token], str | None, list[str]]:
    """A segment without its label and the unknown words before its measure: those name a part."""
    part, qualifiers = [], []
    colon = next((k for k, t in enumerate(own) if t.kind == ":"), None)
    if colon is not None and not any(map(_measured, own[:colon])):
        axes, units = [], []
        for t in own[:colon]:
            if t.text in AXIS_OF:
                axes.append(t)
            elif t.text in QUALIFIER_OF:
                qualifiers.append(QUALIFIER_OF[t.text])
            elif t.kind == "unit":
                units.append(t)
            elif t.kind not in ("/", "("):  # kw / mm: 23
                part.append(t.text)
        own = [*axes, *[own[colon]] * bool(axes), *own[colon + 1 :], *units]
    skip = 0
    while skip < len(own) and not _known(own[skip]) and not _measured(own[skip]):
        part.append(own[skip].text)
        skip += 1
    return own[skip:], " ".join(w for w in part if w != ":") or None, qualifiers


def read_segment(own: list[Token]) -> list[dict] | None:
    own, part, label = with_context(own)
    if not any(map(_measured, own)):
        return None
    if len(own) == 2 and own[0].kind == "unit":  # mm 209
        own = own[::-1]
    try:
        items = Reader(own).chain()
    except ValueError:
        return None
    # A unit holds for the items before it that have none, then for those after it.
    for order in (items[::-1], items):
        unit = None
        for x in order:
            unit = x["unit"] = x["unit"] or unit
    spatial = [x for x in items if CLASS_OF.get(x["unit"], "linear") == "linear"]
    if not any(x["axis"] for x in items) and len(spatial) in (2, 3):
        for x, axis in zip(spatial, BARE_AXES):
            x["axis"], x["unsure"] = axis, True
    out = []
    for k, x in enumerate(items):
        for value, ending, unit in x["entries"]:
            unit = unit or x["unit"]
            axis = x["axis"] or ("weight" if CLASS_OF.get(unit) == "mass" else None)
            out.append({"dimension_type": axis, "dimension_value": value, "dimension_measurement_unit": unit, "dimension_value_qualifier": joined(*label, *x["qualifiers"], ending), "dimension_measured_part": part, "axis": k if len(items) > 1 else None, "type_ambiguous": x["unsure"]})
    return out


def recovered(own: list[Token]) -> list[dict] | None:
    """The first reading of a changed segment."""
    cross = Token("x", "x")
    tried = [own]
    for by, beside in product((False, True), repeat=2):
        changed = [cross if by and t.text == "by" else t for t in own]
        if beside:
            changed = [y for a, b in zip(changed, [*changed[1:], Token("end", "")]) for y in ([a, cross] if a.kind == "unit" and b.text in AXIS_OF else [a])]
        bare = list(changed)
        while bare and bare[-1].text in (".", ";", ":", ","):
            bare.pop()
        short = list(changed)
        while short and not _known(short[-1]) and not _measured(short[-1]):
            short.pop()
        for candidate in (bare, short if any(t.kind == "unit" for t in short) else []):
            if candidate and candidate not in tried:
                tried.append(candidate)
                if (found := read_segment(candidate)) is not None:
                    return found
    return None


def split(own: list[Token]) -> list[list[Token]]:
    out: list[list[Token]] = [[]]
    for t in own:
        if t.kind == "sep":
            out.append([])
        else:
            out[-1].append(t)
    return [x for x in out if x]


def units_in_labels(own: list[Token]) -> list[Token]:
    """Brackets and strokes around a lone unit go: kw (mm): 23."""
    out: list[Token] = []
    k = 0
    while k < len(own):
        if own[k].kind == "(" and k + 2 < len(own) and own[k + 1].kind == "unit" and own[k + 2].kind == ")":
            out.append(own[k + 1])
            k += 3
        else:
            out.append(own[k])
            k += 1
    return out


def read(raw: str, prime_unit: str = "ft") -> dict | None:
    text = raw.strip().lower()
    general = ["uncertain"] if "?" in text else []
    bound = "maximum" if "<" in text else "minimum" if ">" in text else None
    own = units_in_labels([t for t in lex(text, prime_unit) if t.kind not in ("?", "<", ">")])
    plain, others, part, extra = [], [], None, []
    k = 0
    while k < len(own):
        end = next((j for j in range(k + 1, len(own)) if own[j].kind == ")"), None) if own[k].kind == "(" else None
        if end is None:
            plain.append(own[k])
            k += 1
            continue
        inside = own[k + 1 : end]
        if any(map(_measured, inside)):
            others.append(inside)  # another reading: 15 cm (6 in)
        elif inside and all(t.text in QUALIFIER_OF for t in inside):
            extra += [QUALIFIER_OF[t.text] for t in inside]
        elif inside and part is None:
            part = " ".join(t.text for t in inside)
        k = end + 1
    measurements, residue = [], []
    for segment, other in [*((s, False) for s in split(plain)), *((s, True) for s in others)]:
        found = read_segment(segment)
        if found is None:
            found = recovered(segment)
        if found is None:
            residue.append(" ".join(t.text for t in segment))
            continue
        for m in found:
            m["dimension_value_qualifier"] = joined(m["dimension_value_qualifier"], "parenthetical" if other else None, *extra, *general, bound)
            m["dimension_measured_part"] = m["dimension_measured_part"] or part
        measurements += found
    if not measurements:
        return None
    return {"measurements": measurements, "residue": residue, "status": "partial" if residue else "resolved"}


MEASUREMENT = "struct<dimension_type:string,dimension_value:double,dimension_measurement_unit:string,dimension_value_qualifier:string,dimension_measured_part:string,axis:int,type_ambiguous:boolean>"
RESULT = f"struct<measurements:array<{MEASUREMENT}>,residue:array<string>,status:string>"


def dimensions(raw, prime_unit: str = "ft"):
    """A column of recorded dimensions as (measurements, residue, status), null where nothing can be read; a prime stands for ``prime_unit``."""
    return column_parser(lambda v: read(v, prime_unit), RESULT)(raw)


def base_magnitude(value, unit):
    """A value column in its class's base unit by a unit column; null for units without one."""
    from pyspark.sql import functions as F

    factors = F.create_map(*[F.lit(x) for pair in TO_BASE.items() for x in pair])
    return value * F.try_element_at(factors, unit)
