"""Security identifiers and content fingerprints as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values of the characters of a security number: fixed order.
CUSIP_ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ*@#"


#: Symbols of exchanges' own tests; fixed values.
TEST_SYMBOLS = ("ZVZZT", "ZWZZT", "ZXZZT", "ZJZZT", "TEST")


def publishable(symbol: Column) -> Column:
    """Whether a symbol is one to five letters with an optional class of one or two, and none of the tests."""
    return symbol.rlike(r"^[A-Z]{1,5}([.-][A-Z]{1,2})?$") & ~symbol.isin(*TEST_SYMBOLS)


def accession(url: Column) -> Column:
    """A filing's id from its address, with dashes; empty if the address has none."""
    raw = F.regexp_extract(url, r"/data/[0-9]+/([0-9]{18})/", 1)
    return F.regexp_replace(raw, r"^([0-9]{10})([0-9]{2})([0-9]{6})$", "$1-$2-$3")


def index_address(url: Column) -> Column:
    """The address of the index page of a filing that has this address."""
    return F.concat(F.regexp_extract(url, r"^(.*/[0-9]{18}/)", 1), accession(url), F.lit("-index.htm"))


def cusip_check_digit(base: Column) -> Column:
    """The check digit of eight characters: every second value doubled, digits summed, modulo ten; null for others."""
    upper = F.upper(base)

    def value(i: Column) -> Column:
        v = F.instr(F.lit(CUSIP_ALPHABET), F.substring(upper, i + 1, F.lit(1))) - 1
        d = F.when(i % 2 == 1, v * 2).otherwise(v)
        return F.floor(d / 10).cast("int") + d % 10

    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(7)), value), F.lit(0), lambda a, b: a + b)
    return F.when(upper.rlike(r"^[0-9A-Z*@#]{8}$"), (10 - total % 10) % 10)


def issuer(cusip: Column) -> Column:
    return F.substring(cusip, 1, 6)


def fingerprint(*parts: Column) -> Column:
    """SHA-256 of the parts, folded to lower case and parted by a unit separator; null parts count as empty."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(F.lower(F.trim(p)), F.lit("")) for p in parts]), 256)


def content_hash(*columns: Column) -> Column:
    """A hash of a row's values, nulls told apart."""
    return F.xxhash64(F.to_json(F.struct(*columns)))
