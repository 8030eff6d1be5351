"""Text functions as Column expressions: cleaning, folding, detectors, n-grams. All run inside whole-stage code."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings that mean "missing", by layer.
INGEST_MISSING = ["nan", "null", "none", "n/a", "na", "#n/a", "<na>"]
FIELD_MISSING = ["nan", "null", "none", "n/a", "undefined"]

# Patterns of names and addresses.
URL_START = r"https?://(?:www\.)?|www\."
URL_END = r"\.(?:com|org|net|in|fr|co|io|biz|info|gov|edu)(?:/[^\s]*)?\b"
PHONE = r"\b(?:\+?\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b|\b\d{10}\b"
HONORIFIC = r"^(?:m\s*/?\s*s\.?|shri|sri|smt|dr\.?|er\.?|late)\s+"
ORDINAL = r"\b(\d+)(?:st|nd|rd|th)\b"
POSTAL = r"\b([1-9][0-9]{5}|[0-9]{5}(?:-[0-9]{4})?)\b"

# Legal forms and what they are called in canonical form.
LEGAL_FORMS = {
    "private limited": "pvt ltd", "pvt limited": "pvt ltd", "pvt ltd": "pvt ltd", "pvtltd": "pvt ltd", "p limited": "pvt ltd",
    "limited": "ltd", "ltd": "ltd", "incorporated": "inc", "inc": "inc", "corporation": "corp", "corp": "corp",
    "limited liability company": "llc", "llc": "llc", "l l c": "llc", "company": "co", "co": "co",
    "sarl": "sarl", "s a r l": "sarl", "sa": "sa", "s a": "sa", "gmbh": "gmbh",
    "enterprise": "enterprises", "enterprises": "enterprises", "associates": "associates", "industries": "industries",
    "solutions": "solutions", "services": "services", "technologies": "technologies", "private": "pvt", "pvt": "pvt",
    "llp": "llp", "l l p": "llp", "public limited": "ltd", "plc": "ltd", "p l c": "ltd", "proprietorship": "prop", "prop": "prop",
}

# Address words and what they are shortened to.
ADDRESS_WORDS = {
    "road": "rd", "rd": "rd", "street": "st", "st": "st", "str": "st", "avenue": "ave", "ave": "ave", "av": "ave",
    "boulevard": "blvd", "blvd": "blvd", "bd": "blvd", "lane": "ln", "ln": "ln", "drive": "dr", "dr": "dr", "court": "ct", "ct": "ct",
    "place": "pl", "pl": "pl", "square": "sq", "sq": "sq", "highway": "hwy", "hwy": "hwy", "expressway": "expy", "expy": "expy",
    "parkway": "pkwy", "pkwy": "pkwy", "route": "rt", "rt": "rt", "circle": "cir", "cir": "cir",
    "rue": "rue", "chemin": "ch", "ch": "ch", "allee": "all", "all": "all", "impasse": "imp", "imp": "imp", "passage": "pas", "pas": "pas",
    "cours": "crs", "crs": "crs", "quai": "quai", "zi": "zi",
    "suite": "ste", "ste": "ste", "apartment": "apt", "apt": "apt", "floor": "fl", "fl": "fl", "flr": "fl",
    "building": "bldg", "bldg": "bldg", "room": "rm", "rm": "rm", "department": "dept", "dept": "dept",
    "nagar": "nagar", "ngr": "nagar", "marg": "marg", "mrg": "marg", "sector": "sector", "sec": "sector", "colony": "colony",
    "chowk": "chowk", "bazaar": "bazar", "bazar": "bazar", "opposite": "opp", "opp": "opp", "near": "nr", "nr": "nr",
    "behind": "behind", "beside": "beside", "cross": "cross", "north": "n", "south": "s", "east": "e", "west": "w",
}

# Names of countries; all others stand for themselves in capitals.
COUNTRIES = {
    "us": "US", "usa": "US", "united states": "US", "united states of america": "US", "u s": "US", "u s a": "US",
    "india": "INDIA", "in": "INDIA", "ind": "INDIA", "bharat": "INDIA", "hindustan": "INDIA",
    "france": "FRANCE", "fr": "FRANCE", "fra": "FRANCE", "republique francaise": "FRANCE",
    "uk": "UK", "united kingdom": "UK", "gb": "UK", "gbr": "UK", "great britain": "UK", "england": "UK",
    "canada": "CANADA", "ca": "CANADA", "can": "CANADA", "germany": "GERMANY", "de": "GERMANY", "deu": "GERMANY", "deutschland": "GERMANY",
    "australia": "AUSTRALIA", "au": "AUSTRALIA", "aus": "AUSTRALIA", "singapore": "SINGAPORE", "sg": "SINGAPORE", "sgp": "SINGAPORE",
    "japan": "JAPAN", "jp": "JAPAN", "jpn": "JAPAN",
}
SEEN_COUNTRIES = ["US", "INDIA"]

LEGAL_PATTERN = r"\b(" + "|".join(sorted(LEGAL_FORMS, key=len, reverse=True)) + r")\b"


def lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def _latin() -> tuple[str, str]:
    """Letters of the Latin blocks whose decomposition is one ASCII letter and marks, and those letters."""
    pairs = []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii():
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


LATIN, ASCII = _latin()


def strip(c: Column) -> Column:
    """Without white space at the ends, non-breaking space and the like included; null is empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", "")


def clean_field(c: Column) -> Column:
    """A field as it is read: stripped, and empty where it says that it is missing."""
    s = strip(c)
    return F.when(F.lower(s).isin(INGEST_MISSING), F.lit("")).otherwise(s)


def fold(c: Column) -> Column:
    """Lower case without accents, for Latin text. `functions.fuzzy.fold_any` has all of Unicode and the Indic scripts."""
    return F.lower(F.translate(F.regexp_replace(c, r"[̀-ͯ]", ""), LATIN, ASCII))


def squeeze(c: Column) -> Column:
    """Only a-z, 0-9 and single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[^a-z0-9\s]", " "), r"\s+", " "))


def tokens(c: Column) -> Column:
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, " "))


def char_ngrams(c: Column, n: int = 3) -> Column:
    """The n-character strings of #text#, repeats included; the padded text if it is shorter, none for an empty one."""
    padded = F.concat(F.lit("#"), c, F.lit("#"))
    whole = F.transform(F.sequence(F.lit(1), F.length(padded) - (n - 1)), lambda i: F.substring(padded, i, F.lit(n)))
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<string>")).when(F.length(padded) < n, F.array(padded)).otherwise(whole)


def longest(words: Column) -> Column:
    """The longest of an array of strings, the first of several; empty for none."""
    return F.aggregate(words, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))


def unzero(c: Column) -> Column:
    """A number without leading zeros."""
    return F.when(c.rlike("^0+$"), F.lit("0")).otherwise(F.regexp_replace(c, "^0+", ""))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
