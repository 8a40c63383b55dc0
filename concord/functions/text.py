"""Cleaning of text and names."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Strings that stand for no value.
NULL_LIKE = ("", "na", "n/a", "nan", "none", "null", "nil", "nas", "-", "--", "n.a", "n.a.")
#: Letters that decompose into no ASCII letter.
SPELLED = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "þ": "th", "Þ": "Th", "ð": "d", "Ð": "D", "ı": "i"}


def _plain_letters() -> tuple[str, str]:
    """Letters of the Latin blocks that are one ASCII letter with marks, and these."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))[0]) for c in range(0xC0, 0x250) if chr(c) not in SPELLED]
    pairs = [(a, b) for a, b in pairs if b.isascii() and b.isalpha() and all(unicodedata.combining(x) for x in unicodedata.normalize("NFKD", a)[1:])]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


MARKED, PLAIN = _plain_letters()


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility composition. Arrow UDF: Spark has no such function; use it only for feeds that need it."""
    return s.map(lambda x: None if x is None else x if x.isascii() else unicodedata.normalize("NFKC", x))


#: Cyrillic and Greek small letters in Latin ones.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "io", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p",
    "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "iu", "я": "ia",
    "ђ": "dj", "ѓ": "gj", "є": "ie", "ѕ": "dz", "і": "i", "ї": "yi", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "tsh", "ќ": "kj", "ў": "u", "џ": "dzh", "ғ": "gh", "қ": "k", "ҳ": "h", "ә": "a", "ө": "o", "ү": "u", "ң": "ng",
}
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t",
    "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
}
#: Words of Unicode's letter names that are no part of the sound.
NO_SOUND = frozenset("LETTER CHARACTER SMALL CAPITAL SIGN VOWEL SARA SYLLABLE DIGIT FINAL INITIAL MEDIAL ISOLATED FORM VIRAMA NUKTA MARK WITH".split())
#: Scripts whose letters have names that begin with their sound (ARABIC LETTER FEH: f).
NAMED = frozenset("ARABIC HEBREW GEORGIAN ARMENIAN THAI LAO SYRIAC COPTIC".split())


def latin_of(letter: str) -> str:
    """A letter of any script in Latin ones, small.

    Cyrillic and Greek by the tables; marks go; others by the sound in Unicode's name of the letter (DEVANAGARI LETTER KA: k,
    HANGUL SYLLABLE GA: ga), where consonants of scripts with an inherent vowel lose it. An ideograph has no sound there: it
    becomes a word of its code (u5317), so that equal names stay equal and none is lost.
    """
    if letter.isascii():
        return letter
    low = letter.lower()
    if low in CYRILLIC or low in GREEK:
        return CYRILLIC.get(low, GREEK.get(low, ""))
    plain = unicodedata.normalize("NFKD", letter)
    if plain != letter and not unicodedata.name(letter, "").startswith("HANGUL"):
        return "".join(map(latin_of, plain))
    name = unicodedata.name(letter, "")
    if not unicodedata.category(letter).startswith(("L", "N", "M")) or not name or "VIRAMA" in name or (unicodedata.combining(letter) and "VOWEL" not in name):
        return letter if not unicodedata.category(letter).startswith("M") else ""
    if "IDEOGRAPH" in name:
        return f" u{ord(letter):x} "
    if unicodedata.category(letter) == "Nd":
        return str(unicodedata.digit(letter))
    sound = (w for w in name.split()[1:] if w not in NO_SOUND)
    said = next(sound, "").lower()
    if name.split()[0] in NAMED and said:
        return re.match("[^aeiou]+|[aeiou]", said)[0]
    inherent = " LETTER " in name and "VIRAMA" in unicodedata.name(chr((ord(letter) & ~0x7F) + 0x4D), "")  # scripts laid out as Devanagari is
    return said[:-1] if inherent and len(said) > 1 and said.endswith("a") and said != "aa" else said


@F.pandas_udf(StringType())
def romanised(s: pd.Series) -> pd.Series:
    """Other scripts than Latin in Latin letters. Arrow UDF: a letter becomes several, by rules that Spark has no function for; ASCII and Latin texts pass as they are."""
    known = {}

    def of(x):
        if x is None or x.isascii() or max(x) < "\u0370":
            return x
        for c in set(x) - known.keys():
            known[c] = c if c < "\u0370" else latin_of(c)
        return "".join(known[c] for c in x)

    return s.map(of)


def ascii_fold(c: Column, scripts: bool = False) -> Column:
    """Latin letters without their marks, and other scripts in Latin letters if asked for; what is left over beyond ASCII stays."""
    plain = c = romanised(c) if scripts else c
    for letter, spelled in SPELLED.items():
        if len(spelled) > 1:
            c = F.replace(c, F.lit(letter), F.lit(spelled))
    single = {k: v for k, v in SPELLED.items() if len(v) == 1}
    c = F.translate(c, MARKED + "".join(single), PLAIN + "".join(single.values()))
    return F.when(F.octet_length(plain) == F.length(plain), plain).otherwise(F.regexp_replace(c, r"\p{M}+", ""))


def some_value(c: Column) -> Column:
    """c, null where it is null-like. A test beside c would work c out twice."""
    return F.get(F.filter(F.array(c), lambda x: ~x.isin(*NULL_LIKE)), F.lit(0))


def clean_text(c: Column, unicode: bool = False) -> Column:
    """White space collapsed and trimmed, lower case, null-like strings null; composed first if unicode is set."""
    c = c.cast("string")
    return some_value(F.lower(F.trim(F.regexp_replace(nfkc(c) if unicode else c, r"\s+", " "))))


def name_norm(c: Column, scripts: bool = False) -> Column:
    """A name as words of a-z and 0-9; & is read as and; null-like names are null."""
    c = F.replace(F.lower(ascii_fold(c.cast("string"), scripts)), F.lit("&"), F.lit(" and "))
    return some_value(F.trim(F.regexp_replace(c, "[^0-9a-z]+", " ")))


def name_tokens(norm: Column, min_len: int = 2) -> Column:
    """Words of at least min_len letters, and all numbers; order and repeats are kept."""
    return F.filter(F.split(F.coalesce(norm, F.lit("")), " "), lambda t: (F.length(t) >= min_len) | t.rlike("^[0-9]+$"))


def signature(tokens: Column) -> Column:
    """The words in order of the alphabet."""
    return F.array_join(F.sort_array(tokens), " ")


def one_of(token: Column, words) -> Column:
    """Whether a token is in a small list of words; false where the list is empty."""
    return token.isin(*words) if words else F.lit(False)


def jaccard(a: Column, b: Column) -> Column:
    """Share of distinct tokens in common; null where either is null or both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(a.isNotNull() & b.isNotNull() & (union > 0), F.size(F.array_intersect(a, b)) / union)
