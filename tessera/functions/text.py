"""Text folding as native Spark expressions (no Python worker).

The replaced job transliterated titles and snippets to ASCII with a
row-at-a-time Python UDF and then upper-cased them.  Here the same folding
is one expression tree:

1. one ``translate`` for every letter that becomes one character;
2. letters and symbols with a replacement of several characters: the text is
   cut at them once, and each one found is looked up in a table;
3. combining marks after a Latin, Greek or Cyrillic letter removed, other
   scripts' marks kept;
4. emoji, arrows, box drawing and other pictures removed;
5. ``upper``.

So a text is passed over a fixed number of times, whatever the size of the
tables.  Steps 2 to 4 are for texts that the first step has not made ASCII,
which their length in bytes tells.

The tables are built by rule from ``unicodedata``: a character whose
compatibility decomposition, without marks, is ASCII becomes that (accented
letters, ordinals, fractions, full-width forms, ligatures, letter-like
symbols).  Greek and Cyrillic letters go through their romanisation, accented
ones by way of their base letter.  Scripts without a table stay as they are.
Strings that are pure ASCII skip all steps.  Null in, null out.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: replacements that decomposition cannot give, in code-point order.
SPECIAL_TRANSLITERATIONS = [
    ("\u00a0", " "), ("¡", "!"), ("¢", "c"), ("£", "GBP"), ("¥", "JPY"), ("§", "S"), ("©", "(c)"), ("«", "<<"), ("®", "(r)"),
    ("°", "deg"), ("±", "+/-"), ("·", "*"), ("»", ">>"), ("¿", "?"), ("Æ", "AE"), ("Ð", "D"), ("×", "x"), ("Ø", "O"), ("Þ", "Th"),
    ("ß", "ss"), ("æ", "ae"), ("ð", "d"), ("÷", "/"), ("ø", "o"), ("þ", "th"), ("Đ", "D"), ("đ", "d"), ("Ħ", "H"), ("ħ", "h"),
    ("ı", "i"), ("Ł", "L"), ("ł", "l"), ("Ŋ", "NG"), ("ŋ", "ng"), ("Œ", "OE"), ("œ", "oe"), ("Ŧ", "T"), ("ŧ", "t"), ("ẞ", "SS"),
    ("‐", "-"), ("‑", "-"), ("‒", "-"), ("–", "-"), ("—", "--"), ("―", "--"), ("‘", "'"), ("’", "'"), ("‚", ","), ("“", '"'),
    ("”", '"'), ("„", '"'), ("†", "+"), ("•", "*"), ("‹", "<"), ("›", ">"), ("⁄", "/"), ("€", "EUR"), ("−", "-"),
]
# --- fixed values: romanisation of the Greek and Cyrillic small letters, in alphabet order.
GREEK = list(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split()))
CYRILLIC = list(zip("абвгдежзийклмнопрстуфхцчшщъыьэюяёђѓєѕіїјљњћќўџґ",
                    "a b v g d e zh z i i k l m n o p r s t u f kh ts ch sh shch ' y ' e iu ia io dj g ie dz i i j lj nj c k u dz g".split()))

# Ranges of the decomposition rule: Latin-1 to Latin Extended-B, Greek to Cyrillic, Latin and Greek
# Extended, super- and subscripts, letter-like symbols and number forms, ligatures, full-width forms.
_RULE_RANGES = [(0x00A0, 0x0250), (0x0370, 0x0530), (0x1E00, 0x2000), (0x2024, 0x2027), (0x2070, 0x20A0),
                (0x2100, 0x2190), (0xFB00, 0xFB07), (0xFF01, 0xFF5F)]
# Arrows to dingbats, further symbols, variation selectors, joiners and emoji.
_PICTURES = "[\\x{200D}\\x{2190}-\\x{27BF}\\x{2900}-\\x{2BFF}\\x{FE0E}\\x{FE0F}\\x{1F000}-\\x{1FAFF}]"
_MARKS = r"([\x00-\x7F\p{IsLatin}\p{IsGreek}\p{IsCyrillic}])\p{M}+"


@lru_cache(maxsize=1)
def replacements() -> dict[str, str]:
    """Every character with an ASCII replacement."""
    out = dict(SPECIAL_TRANSLITERATIONS)
    for small, latin in [*GREEK, *CYRILLIC]:
        out.setdefault(small, latin)
        if small.upper() != small:
            out.setdefault(small.upper(), latin.capitalize())
    for first, end in _RULE_RANGES:
        for ch in map(chr, range(first, end)):
            if ch in out:
                continue
            plain = [c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c)]
            ascii_ = "".join(out.get(c, c) for c in plain)
            if plain and ascii_.isascii() and ascii_ != ch:
                out[ch] = ascii_
    return out


def _ranges(characters: list[str]) -> str:
    """A character class of the blocks of 32 code points that hold the characters."""
    blocks = sorted({ord(c) >> 5 for c in characters})
    runs: list[list[int]] = []
    for b in blocks:
        if runs and runs[-1][1] == b - 1:
            runs[-1][1] = b
        else:
            runs.append([b, b])
    return "[" + "".join(f"\\x{{{a << 5:X}}}-\\x{{{(b << 5) + 31:X}}}" for a, b in runs) + "]"


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def _several(c: Column) -> Column:
    """The characters with a longer replacement replaced: cut at them, looked up, joined."""
    table = {k: v for k, v in replacements().items() if len(v) != 1}
    ranges = _ranges(list(table))
    lookup = F.str_to_map(F.lit("\n".join(f"{k}\t{v}" for k, v in table.items())), F.lit("\n"), F.lit("\t"))  # one constant for the planner
    found = F.transform(F.regexp_extract_all(c, F.lit(ranges), F.lit(0)), lambda x: F.coalesce(F.element_at(lookup, x), x))
    pieces = F.split(c, ranges, -1)
    joined = F.array_join(F.zip_with(pieces, found, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(c.rlike(ranges), joined).otherwise(c)


def fold_accents(c: Column | str) -> Column:
    """ASCII-fold a string column (keeps case)."""
    col = F.col(c) if isinstance(c, str) else c
    single = {k: v for k, v in replacements().items() if len(v) == 1}
    letters = F.translate(col, "".join(single), "".join(single.values()))

    def plain(c: Column) -> Column:
        return F.when(_is_ascii(c), c).otherwise(F.regexp_replace(F.regexp_replace(c, _MARKS, "$1"), _PICTURES, ""))

    rest = F.element_at(F.transform(F.array(_several(letters)), plain), 1)  # an array of one, so that the text is made once
    return F.when(_is_ascii(col), col).when(_is_ascii(letters), letters).otherwise(rest)


def fold_upper(c: Column | str) -> Column:
    """Normalised review text: ASCII-folded, upper case."""
    return F.upper(fold_accents(c))
