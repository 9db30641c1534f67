"""Names, identifiers and numbers as text."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# fixed values: small Cyrillic and Greek letters and the Latin ones for them, without the marks of the standards
CYRILLIC = dict(zip(
    "а б в г д е ё ж з и й к л м н о п р с т у ф х ц ч ш щ ъ ы ь э ю я і ї є ґ ў ј љ њ ћ ђ џ ѓ ќ ѕ".split(),
    "a b v g d e e z z i j k l m n o p r s t u f h c c s s \" y ' e u a i i e g u j l n c d d g k z".split()))
GREEK = dict(zip(
    "α β γ δ ε ζ η θ ι κ λ μ ν ξ ο π ρ σ ς τ υ φ χ ψ ω".split(), "a b g d e z e th i k l m n x o p r s s t y ph ch ps o".split()))


def _letter_table() -> dict[str, str]:
    """Cyrillic and Greek letters of both cases, accented Greek ones by their decomposition."""
    table = CYRILLIC | GREEK
    for code in (*range(0x0386, 0x03CF), *range(0x1F00, 0x2000)):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.lower() in GREEK:
            table[chr(code).lower()] = GREEK[base.lower()]
    return table | {letter.upper(): plain.capitalize() for letter, plain in table.items() if len(letter.upper()) == 1 and letter != "ς"}


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters and their plain ones, from Unicode decomposition; other letters that one stands for."""
    pairs = {letter: plain for letter, plain in _letter_table().items() if len(plain) == 1}
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if base.isascii() and base.isalpha():
            pairs[chr(code)] = base
    # fixed values: Latin letters without a decomposition
    pairs.update({"Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i"})
    return "".join(pairs), "".join(pairs.values())


ACCENTED, PLAIN = _accent_table()

# fixed values: letters written as two
LETTER_PAIRS = {"ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "TH", "þ": "th"}
LETTER_PAIRS |= {letter: plain for letter, plain in _letter_table().items() if len(plain) == 2 and letter in "θφχψΘΦΧΨ"}


def to_plain_latin(text: Column | str) -> Column:
    """Latin letters without marks; Cyrillic and Greek letters become Latin ones. Other scripts stay."""
    # upsilon after a vowel is u, gamma before another guttural is n
    spoken = F.regexp_replace(_col(text), "(?<=[αεηοΑΕΗΟ])[υύ]", "u")
    spoken = F.regexp_replace(spoken, "γ(?=[γκξχ])", "n")
    plain = F.translate(F.regexp_replace(F.translate(spoken, "йЙ", "jJ"), r"\p{M}", ""), ACCENTED, PLAIN)
    for letter, pair in LETTER_PAIRS.items():
        plain = F.replace(plain, F.lit(letter), F.lit(pair))
    return plain


def stripped(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), r"^\s+|\s+$", "")


def without_outer_quotes(text: Column | str) -> Column:
    return F.regexp_replace(_col(text), '^"+|"+$', "")


def joined_initials(name: Column | str) -> Column:
    """``Smith J X`` becomes ``Smith JX``; matches do not overlap."""
    return F.regexp_replace(_col(name), r"(\s[A-Z])(\s)([A-Z])", "$1$3")


def author_name(name: Column | str) -> Column:
    """Author name in the form the literature search expects."""
    bare = F.translate(stripped(name), ",.", "")
    return joined_initials(to_plain_latin(without_outer_quotes(bare)))


def manuscript_id_from_doi(doi: Column | str, prefix: str) -> Column:
    """The 5 or 6 digit number after ``prefix`` (a pattern, dots match any character), else null."""
    pattern = f"{prefix}([0-9]{{5,6}})"
    return F.nullif(F.regexp_extract(F.lower(_col(doi)), pattern, 1), F.lit(""))


def contains(text: Column | str, part: Column | str) -> Column:
    """Substring test that is null when either side is null and false for an empty part."""
    part = _col(part)
    return F.when(part == "", F.lit(False)).otherwise(F.instr(_col(text), part) > 0)


def rounded_integer(value: Column | str) -> Column:
    """Nearest integer, halves away from zero."""
    return F.round(_col(value)).cast("bigint")


def display_number(value: Column | str, digits: int | None = None) -> Column:
    """Number as text without a trailing ``.0``."""
    value = _col(value)
    if digits is not None:
        value = F.round(value, digits)
    return F.regexp_replace(value.cast("string"), r"\.0$", "")
