"""Countries, states, addresses, categories and ratings."""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whole-word expansions in addresses.
ABBREVIATIONS = {"rd": "road", "st": "street", "opp": "opposite", "nr": "near", "no": "number", "bldg": "building", "apt": "apartment", "flr": "floor", "hwy": "highway", "jn": "junction", "jct": "junction"}
#: Words of no use for an address's identity.
ADDRESS_STOPWORDS = ("road", "street", "near", "opposite", "number", "building", "floor", "the", "and", "main", "cross", "lane", "area", "city", "district", "po", "dist")
#: Keywords of property types; the first type with a keyword in the text wins.
TYPE_KEYWORDS = {
    "resort": ["resort"], "villa": ["villa"], "homestay": ["homestay", "home stay", "home-stay"],
    "guesthouse": ["guest house", "guesthouse", "guest-house", "lodge", "inn", "b&b", "bed and breakfast"],
    "hostel": ["hostel", "dormitory", "backpacker"], "apartment": ["apartment", "aparthotel", "apart hotel", "serviced apartment", "flat", "condo", "studio"], "hotel": ["hotel", "motel"],
}
#: Strings that say there is no chain.
NO_CHAIN = ("no chain", "independent", "none", "n/a")
#: Patterns of postal codes in their field and in an address.
POSTAL_FIELD, POSTAL_ADDRESS = "([1-9][0-9]{5})", r"\b([1-9][0-9]{5})\b"


def lookup(c: Column, table: dict) -> Column:
    """The value of a small table; null where there is none."""
    return F.create_map(*[F.lit(x) for x in chain(*table.items())])[c] if table else F.lit(None).cast("string")


def country(code: Column, name: Column, numeric: dict, names: dict) -> tuple[Column, Column]:
    """(ISO code, where it comes from): a code of two letters passes, then the numeric codes, then the names."""
    code = F.upper(code)
    iso, number, named = code.rlike("^[A-Z]{2}$"), lookup(code, numeric), lookup(name, names)
    value = F.when(iso, code).otherwise(F.coalesce(number, named))
    source = F.when(iso, "iso2").when(number.isNotNull(), "numeric_code_map").when(named.isNotNull(), "name_map").otherwise("unresolved")
    return value, source


def address_norm(c: Column, abbreviations: dict | None = None) -> Column:
    for short, full in {**ABBREVIATIONS, **(abbreviations or {})}.items():
        c = F.regexp_replace(c, rf"\b{short}\b", full)
    c = F.trim(F.regexp_replace(F.regexp_replace(c, "[^0-9a-z ]+", " "), r"\s+", " "))
    return F.when(c != "", c)


def address_tokens(norm: Column, core: bool = False) -> Column:
    """Words of two letters or more; without the stopwords if core is set. Repeats are kept."""
    tokens = F.filter(F.split(F.coalesce(norm, F.lit("")), " "), lambda t: F.length(t) >= 2)
    return F.filter(tokens, lambda t: ~t.isin(*ADDRESS_STOPWORDS)) if core else tokens


def postal(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def property_type(c: Column, codes: dict | None = None, keywords: dict | None = None) -> Column:
    """Bucket of a type text, after a provider's codes; unknown where no keyword is in it."""
    c = F.coalesce(lookup(c, codes), c) if codes else c
    out = None
    for kind, words in (keywords or TYPE_KEYWORDS).items():
        hit = c.rlike("|".join(re.escape(w).replace(r"\-", "-").replace(r"\ ", " ").replace(r"\&", "&") for w in words))
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("unknown")


def star_rating(c: Column) -> Column:
    return F.when((c > 0) & (c <= 5), c)


def positive(c: Column) -> Column:
    return F.when(c > 0, c)


def hotel_chain(c: Column) -> Column:
    return F.when(~c.isin(*NO_CHAIN), c)


def first_word(c: Column) -> Column:
    return F.get(F.split(c, " "), F.lit(0))
