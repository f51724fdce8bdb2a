"""Names, references and free text as column expressions."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters that no Unicode decomposition takes apart, and what they fold to. Fixed values.
LONE = {"æ": "ae", "ð": "d", "đ": "d", "ħ": "h", "ı": "i", "ĸ": "k", "ł": "l", "ŋ": "n", "ø": "o", "œ": "oe", "ß": "ss", "ŧ": "t", "þ": "th"}
#: Months by their first three letters. Fixed values.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
#: Spaces that look plain and are not: no-break, narrow no-break, figure.
ODD_SPACES = "\u00a0\u202f\u2007"
#: Letters of the national grid's squares: I is left out.
GRID_LETTERS = "ABCDEFGHJKLMNOPQRSTUVWXYZ"
_ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def _folds() -> dict[str, str]:
    """Every lower-case letter of Latin-1, Latin Extended-A and the Welsh w and y, by its base letters."""
    table = dict(LONE)
    for c in map(chr, [*range(0xDF, 0x180), 0x1E81, 0x1E83, 0x1E85, 0x1EF3]):
        base = "".join(x for x in unicodedata.normalize("NFKD", c) if x.isascii() and x.isalnum())
        if c.islower() and c not in table and base:
            table[c] = base.lower()
    return table


def fold(text: Column) -> Column:
    """Lower case, accents off their letters, letters and digits only."""
    table = _folds()
    single = {k: v for k, v in table.items() if len(v) == 1}
    out = F.translate(F.lower(text), "".join(single), "".join(single.values()))
    for letter, base in table.items():
        if len(base) > 1:
            out = F.replace(out, F.lit(letter), F.lit(base))
    return F.regexp_replace(out, "[^a-z0-9]", "")


def said_once(text: Column) -> Column:
    """'A - B' as its first half where both halves fold equal; anything else as it is."""
    halves = F.split(text, " - ")
    first, second = F.trim(F.get(halves, 0)), F.trim(F.get(halves, 1))
    return F.when((F.size(halves) == 2) & (first != "") & (fold(first) == fold(second)), first).otherwise(text)


def slug(text: Column) -> Column:
    """Letters and digits joined by single dashes; 'area' where none are left."""
    out = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-|-$", "")
    return F.when(F.coalesce(out, F.lit("")) == "", "area").otherwise(out)


@F.pandas_udf(T.StringType())
def _unescaped(text: pd.Series) -> pd.Series:
    return text.astype(object).str.replace(_ENTITY, lambda m: html.unescape(m.group(0)), regex=True) if text.notna().any() else text.astype(object)


def clean_text(text: Column, rounds: int = 3) -> Column:
    """Character references with their semicolon decoded, up to three times over, and odd spaces made plain.

    Only texts that hold a reference are sent to Python, nulls in place of the others.
    """
    out = text
    for _ in range(rounds):
        out = F.coalesce(_unescaped(F.when(out.rlike(_ENTITY), out)), out)
    return F.translate(out, ODD_SPACES, " " * len(ODD_SPACES))


def unclean_in(text: Column) -> Column:
    """What clean_text would change: the references, then odd spaces as U+XXXX; null stays null."""
    odd = [F.when(F.contains(text, F.lit(c)), F.array(F.lit(f"U+{ord(c):04X}"))).otherwise(F.array().cast("array<string>")) for c in sorted(ODD_SPACES)]
    return F.concat(F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0)), *odd)


def description(text: Column) -> Column:
    """length_km (field 3, written in miles) and note (field 4) of a piped description."""
    bits = F.split(text, r"\|")
    note = F.get(bits, 3)
    return F.struct(F.round(F.get(bits, 2).try_cast("double") * 1.609344, 6).alias("length_km"), F.when((note != "") & (note != "none"), note).alias("note"))


def council_reference(ref: Column, authority: Column) -> Column:
    """'CODE|parish|number' as (parish, number): piece and sheet suffixes go, and a parish that the number names or the authority is."""
    parts = F.transform(F.split(F.coalesce(ref, F.lit("")), r"\|"), lambda p: F.trim(p))
    number = F.trim(F.regexp_replace(F.element_at(parts, -1), r"#\d+$", ""))
    given = F.when(F.size(parts) >= 3, F.trim(F.regexp_replace(F.get(parts, F.size(parts) - 2), r"\s*-\s*[A-Za-z]{1,4}\d+[A-Za-z]?$", ""))).otherwise("")
    # \Q..\E keeps a parish's own brackets and dots from being read as a pattern.
    whole = F.concat(F.lit("(?i)"), F.when(given.rlike(r"^\w"), r"(?<!\w)").otherwise(""), F.lit(r"\Q"), given, F.lit(r"\E"), F.when(given.rlike(r"\w$"), r"(?!\w)").otherwise(""))
    parish = F.when((given == "") | given.eqNullSafe(authority) | F.regexp_like(number, whole), "").otherwise(given)
    return F.filter(F.array(parish, number), lambda p: p != "")


def parish_key(text: Column) -> Column:
    """A parish as compared: '&' is 'and', words for a council go, letters and digits only."""
    plain = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("&"), F.lit(" and "))
    return F.regexp_replace(F.regexp_replace(plain, r"\b(?:cp|parish|civil parish|town council|pc)\b", " "), "[^a-z0-9]+", "")


def number_key(text: Column) -> Column:
    """A path number as compared: status words, leading zeros and trailing '/0' go."""
    words = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\b(?:boat|byway|by|bw|u?ucr|u?uct|no\.?|number)\b", " ")
    parts = F.filter(F.split(F.regexp_replace(F.trim(words), r"^u?uc[rt](?=\d)", ""), "[^a-z0-9]+"), lambda p: p != "")
    bare = F.transform(parts, lambda p: F.regexp_replace(p, r"^0+(?=\d)", ""))
    return F.regexp_replace(F.array_join(bare, "/"), "(?<=.)(?:/0)+$", "")


def number_rank(text: Column) -> Column:
    """The digits a number starts with, for sorting; null without."""
    return F.regexp_extract(text, r"^\s*(\d+)", 1).try_cast("long")


def parish_variants(text: Column) -> Column:
    """'A / B' and 'A (B in the order)' as both names."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), r"\s*/\s*|\s*\(\s*|\s*\)\s*"), lambda p: F.trim(F.regexp_replace(p, r"(?i)\bin the order\b", "")))
    return F.filter(parts, lambda p: p != "")


def without_contacts(text: Column) -> Column:
    """E-mail addresses, phone numbers and named contacts taken out of a summary."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), r"\S+@\S+", "")
    out = F.trim(F.regexp_replace(out, r"(?:\+44\s?|\b0)\d{2,4}[\s-]?\d{3,4}[\s-]?\d{3,4}\b", ""))
    out = F.regexp_replace(out, r"(?i)\bfor (?:further )?information,?\s*$", "")
    out = F.regexp_replace(F.regexp_replace(out, r"(?i)\s+-\s+[^-()]*?\bcontact\b", ""), r"(?i)\b[\w.' ]*\bcontact\b", "")
    return F.regexp_replace(F.regexp_replace(out, r"\s+", " "), r"^[\s:-]+|[\s:-]+$", "")


def vehicles(text: Column) -> Column:
    """Whom an order's words shut out, and the width above which: (vehicles, width_m), both null where they do not say."""
    t = F.lower(F.coalesce(text, F.lit("")))
    spared = t.rlike(r"(?:except|excluding|other than|but not)\s+(?:for\s+)?(?:solo\s+)?motor\s?-?cycles|motor\s?-?c[yi]c?les?\s+(?:without\s+sidecars\s+)?(?:are\s+)?exempt")
    width = F.regexp_extract(t, r"width\s+(?:exceeding|over|of more than|greater than)\s+(\d+(?:\.\d+)?)\s*m", 1).try_cast("double")
    kind = F.when(spared, "motor_vehicles_except_motorcycles").when(width.isNotNull(), "vehicles_over_width").when(t.rlike(r"\b(?:all|any) (?:vehicles|traffic)\b|axled vehicles"), "all_vehicles").when(
        t.rlike(r"motor vehicles?|motori[sz]ed vehicles?|mechanically propelled|prohibition of driving|motor vehciles"), "motor_vehicles")
    return F.struct(kind.alias("vehicles"), F.when(kind == "vehicles_over_width", width).alias("width_m"))


def width_m(text: Column) -> Column:
    """A tagged width in metres, between 0 and 100; feet, feet and inches, and inches are converted."""
    feet = F.regexp_extract(text, r"^\s*(\d+)\s*'\s*(\d+(?:\.\d+)?)\s*\"?\s*$", 1).try_cast("double")
    inches = F.regexp_extract(text, r"^\s*(\d+)\s*'\s*(\d+(?:\.\d+)?)\s*\"?\s*$", 2).try_cast("double")
    plain = r"^\s*(\d+(?:\.\d+)?)\s*(m|metres?|meters?|ft|feet|'|\")?\s*$"
    value, unit = F.regexp_extract(F.lower(text), plain, 1).try_cast("double"), F.regexp_extract(F.lower(text), plain, 2)
    metres = value * F.when(unit.isin("ft", "feet", "'"), 0.3048).when(unit == '"', 0.0254).otherwise(1.0)
    return F.when(feet.isNotNull(), F.round((feet * 12 + inches) * 0.0254, 3)).when((metres > 0) & (metres <= 100), F.round(metres, 3))


def grid_reference(text: Column) -> Column:
    """A national grid reference as (easting, northing) of its square's centre; null where it cannot be placed."""
    t = F.upper(F.trim(text))
    full = r"^(\d{6})\s*[ ,:]\s*(\d{6,7})$"
    short = r"^([A-HJ-Z]{2})\s*(\d+)\s*(\d*)$"
    a, b = F.regexp_extract(t, short, 2), F.regexp_extract(t, short, 3)
    even = F.length(a) % 2 == 0
    half = (F.length(a) / 2).cast("int")
    east = F.when(b != "", a).when(even, F.substring(a, F.lit(1), half))
    north = F.when(b != "", b).when(even, F.substring(a, half + 1, half))
    fits = t.rlike(short) & (F.length(east) == F.length(north)) & F.length(east).between(2, 5)
    letter = lambda k: F.instr(F.lit(GRID_LETTERS), F.substring(t, k, 1)) - 1
    l1, l2 = letter(1), letter(2)
    scale = F.pow(F.lit(10.0), 5 - F.length(east))
    placed = lambda square, digits: square * 100000 + digits.try_cast("double") * scale + scale / 2
    e100 = F.pmod(l1 - 2, F.lit(5)) * 5 + l2 % 5
    n100 = (F.lit(19) - F.floor(l1 / 5) * 5) - F.floor(l2 / 5)
    return F.when(t.rlike(full), F.struct(F.regexp_extract(t, full, 1).try_cast("double").alias("easting"), F.regexp_extract(t, full, 2).try_cast("double").alias("northing"))).when(
        fits, F.struct(placed(e100, east).alias("easting"), placed(n100, north).alias("northing")))


def month_of(text: Column) -> Column:
    """Number of the last month that a title names."""
    last = F.element_at(F.regexp_extract_all(F.lower(text), F.lit(rf"\b({'|'.join(MONTHS)})[a-z]*"), F.lit(1)), -1)
    return F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), last), F.lit(0)).cast("int")


def page_text(body: Column) -> Column:
    """Readable lines of an HTML page: no scripts, styles or tags; block ends are line ends; references decoded."""
    out = F.regexp_replace(body, r"(?is)<(script|style|noscript|head)\b.*?</\1\s*>|<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>|</(?:p|div|li|tr|h[1-6]|ul|ol|table|section|article)\s*>", "\n")
    out = clean_text(F.regexp_replace(out, r"(?s)<[^>]*>", " "))
    return F.regexp_replace(F.regexp_replace(out, r"[ \t\r\f]+", " "), r"^\s+|\s+$|(?<=\n)\s+| +(?=\n)", "")
