"""Phones, emails and web addresses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Region:
    """A numbering plan: calling code, trunk prefix, and lengths of national numbers; without a code, only numbers with one are read."""

    code: str
    trunk: str
    shortest: int
    longest: int


#: Numbering plans.
REGIONS = {
    "IN": Region("91", "0", 10, 10), "US": Region("1", "1", 10, 10), "NZ": Region("64", "0", 8, 10), "GB": Region("44", "0", 9, 10), "DE": Region("49", "0", 6, 11),
    "FR": Region("33", "0", 9, 9), "ES": Region("34", "", 9, 9), "NP": Region("977", "0", 8, 10), "SI": Region("386", "0", 8, 8), "SM": Region("378", "", 6, 10),
    "AR": Region("54", "0", 10, 11), "LC": Region("1", "1", 10, 10), "LU": Region("352", "", 4, 11), "ME": Region("382", "0", 8, 9), "MK": Region("389", "0", 8, 8),
    "UZ": Region("998", "8", 9, 9), "IT": Region("39", "", 6, 11), "PT": Region("351", "", 9, 9), "NL": Region("31", "0", 9, 9), "BE": Region("32", "0", 8, 9),
    "AT": Region("43", "0", 4, 13), "CH": Region("41", "0", 9, 9), "AU": Region("61", "0", 9, 9), "CA": Region("1", "1", 10, 10), "JP": Region("81", "0", 9, 10),
    "TH": Region("66", "0", 8, 9), "AE": Region("971", "0", 8, 9), "GR": Region("30", "", 10, 10), "HR": Region("385", "0", 8, 9), "TR": Region("90", "0", 10, 10),
}
INTERNATIONAL = Region("", "", 1, 0)
#: What is no phone, and what parts phones in a field.
JUNK_PHONE = r"^[0\s\-+().]*$"
PHONE_BREAK = r"[,/;|&]+|-{2,}|\s{2,}"


def plan_of(region: str) -> Region:
    """The region's plan; of a region without one only international numbers are read."""
    return REGIONS.get((region or "").upper(), INTERNATIONAL)


def phone_numbers(raw: Column, region: str) -> tuple[Column, Column]:
    """(valid numbers as +code and national number, without repeats; count of invalid parts)."""
    plan = plan_of(region)
    parts = F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), PHONE_BREAK), lambda p: F.trim(p)), lambda p: (p != "") & ~p.rlike(JUNK_PHONE))

    def number(p):
        digits = F.regexp_replace(p, "[^0-9]", "")
        abroad = p.rlike(r"^\s*\+|^00")
        if not plan.code:
            plain = F.regexp_replace(digits, "^00", "")
            return F.when(abroad & ~p.rlike("[A-Za-z]{3,}") & F.length(plain).between(8, 15), F.concat(F.lit("+"), plain))
        plain = F.regexp_replace(digits, "^00", "")
        national = F.when(abroad & plain.startswith(plan.code), F.substr(plain, F.lit(len(plan.code) + 1)))
        national = national.when(abroad, F.lit(None)).when((F.length(digits) > plan.longest) & digits.startswith(plan.code), F.substr(digits, F.lit(len(plan.code) + 1))).otherwise(digits)
        national = F.regexp_replace(national, f"^(?:{plan.trunk})+", "") if plan.trunk else national
        other = F.when(abroad & ~plain.startswith(plan.code) & F.length(plain).between(8, 15), F.concat(F.lit("+"), plain))
        own = F.when(F.length(national).between(plan.shortest, plan.longest), F.concat(F.lit("+" + plan.code), national))
        letters = p.rlike("[A-Za-z]{3,}")
        return F.when(~letters, F.coalesce(own, other))

    numbers = F.transform(parts, number)
    return F.array_distinct(F.filter(numbers, lambda n: n.isNotNull())), F.size(F.filter(numbers, lambda n: n.isNull()))


def last10(numbers: Column) -> Column:
    return F.transform(numbers, lambda n: F.right(n, F.lit(10)))


def emails(raw: Column) -> Column:
    """Addresses in lower case, in order, repeats kept; never null."""
    parts = F.split(F.regexp_replace(F.lower(F.coalesce(raw, F.lit(""))), r"[;/\s]+", ","), ",")
    return F.filter(parts, lambda e: e.rlike(r"^[^@]+@[^@]+\.[^@]+$"))


def email_part(addresses: Column, part: int) -> Column:
    """Local parts (1) or domains (2)."""
    return F.transform(addresses, lambda e: F.split_part(e, F.lit("@"), F.lit(part)))


def all_generic(locals_: Column, generic) -> Column:
    """Whether all local parts are generic; true where there is none."""
    return F.coalesce(F.forall(locals_, lambda x: x.isin(*generic)), F.lit(False))


#: Public suffixes of two labels.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "co.in", "org.in", "net.in", "com.au", "net.au", "org.au", "co.nz", "net.nz", "org.nz", "com.np", "com.br", "co.jp", "co.za", "com.mx", "com.sg")


def url_host(url: Column) -> Column:
    """Host in lower case without a leading www.; a missing scheme is supplied; null where there is none."""
    u = F.trim(url)
    full = F.when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), u).otherwise(F.concat(F.lit("http://"), u))
    host = F.lower(F.try_parse_url(full, F.lit("HOST")))
    host = F.regexp_replace(host, r"^www\.", "")
    return F.when(host.contains("."), host)


def registered_domain(host: Column) -> Column:
    """The public suffix and the label before it."""
    labels = F.split(host, r"\.")
    two = F.array_join(F.slice(labels, -2, 2), ".")
    three = F.array_join(F.slice(labels, -3, 3), ".")
    return F.when(F.size(labels) < 2, None).when(two.isin(*TWO_LABEL_SUFFIXES) & (F.size(labels) >= 3), three).when(two.isin(*TWO_LABEL_SUFFIXES), None).otherwise(two)
