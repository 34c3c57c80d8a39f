"""Per-row text rules as native column expressions (no Python UDFs).

All of these stay inside whole-stage codegen: ``regexp_replace``,
``regexp_extract``, ``lower``, ``sha2`` ...  The patterns below are written
so that Java regex (Spark) and RE2 (the DuckDB oracle) read them the same
way: whitespace is spelled out as an explicit class equal to Python's
``str.isspace`` set, because the rules were defined with Python's Unicode
``\\s``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must stay exactly as written for results to agree.
# ---------------------------------------------------------------------------
# Unicode whitespace = Python's str.isspace set (29 code points).  Spelled
# out for RE2 (the DuckDB oracle); Java gets the same set as one Unicode
# property plus the four separators, which matches about twice as fast.
WS_PORTABLE = r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
WS = r"[\p{IsWhite_Space}\x{1C}-\x{1F}]"
DOT_RUN = r"\.{2,}"                          # two or more dots -> blank
SYMBOLS = r"[®™]"                            # registered / trade mark signs -> removed
COLON_DOT = r":+\.?:*"                       # runs of ':' with an optional '.' -> blank


def patterns(ws: str) -> dict[str, str]:
    """The whitespace-bearing patterns, for a given spelling of whitespace."""
    return {
        # HTML line break, any case -> blank
        "BR_TAG": r"(?i)<br" + ws + r"*/?>",
        # Pack size: number + unit, tried first; then a count + pack word.
        "SIZE": r"(?i)(\d+(?:\.\d+)?)" + ws + r"*(kg|g|l|ml)",
        "PACK": r"(?i)(\d+)" + ws + r"*(pack|pk|pkt|each)",
        # Unit price text such as "$1.50 / 100G": amount, '/', optional quantity, unit letters.
        "UNIT_PRICE": (r"^" + ws + r"*\$?(\d+(?:\.\d+)?)" + ws + r"*/" + ws
                       + r"*(\d+(?:\.\d+)?)?([A-Za-z]+)" + ws + r"*$"),
    }


_P = patterns(WS)
BR_TAG, SIZE_PATTERN, PACK_PATTERN, UNIT_PRICE_PATTERN = _P["BR_TAG"], _P["SIZE"], _P["PACK"], _P["UNIT_PRICE"]
# Separator of the row fingerprint and of the product signature.
HASH_SEP = "||"
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_name(col) -> Column:
    """lower-cased product name with tags, symbols and punctuation runs
    removed and whitespace collapsed to single blanks."""
    # Rule order: line breaks, dot runs -> blank; lower; symbols removed;
    # whitespace collapsed; ':'/'.' runs -> blank; whitespace collapsed; trim.
    # Two passes are folded away without changing the result: line breaks
    # and dot runs share no characters and both become a blank (one
    # alternation), and the first collapse is subsumed by the last (the
    # ':'/'.' rule never looks at whitespace).
    c = _c(col)
    c = F.regexp_replace(c, BR_TAG + "|" + DOT_RUN, " ")
    c = F.lower(c)
    c = F.regexp_replace(c, SYMBOLS, "")
    c = F.regexp_replace(c, COLON_DOT, " ")
    c = F.regexp_replace(c, WS + "+", " ")
    return F.trim(c)


def parse_pack(col) -> tuple[Column, Column]:
    """(unit_size DOUBLE, unit_uom STRING) from a normalised name.

    The first size hit wins over any pack hit; the number goes through a
    32-bit float first, as the original rule stored it."""
    c = _c(col)
    has_size = c.rlike(SIZE_PATTERN)
    has_pack = c.rlike(PACK_PATTERN)
    num = (F.when(has_size, F.regexp_extract(c, SIZE_PATTERN, 1))
           .when(has_pack, F.regexp_extract(c, PACK_PATTERN, 1)))
    unit = (F.when(has_size, F.lower(F.regexp_extract(c, SIZE_PATTERN, 2)))
            .when(has_pack, F.lower(F.regexp_extract(c, PACK_PATTERN, 2))))
    size = num.try_cast("double").cast("float").cast("double")
    return size, unit


def parse_unit_price(col) -> tuple[Column, Column, Column]:
    """(unit_price, unit_size, unit_uom) from text like '$1.50 / 100G';
    anything that does not parse (or NULL / empty) gives (0.0, 0.0, '')."""
    c = _c(col)
    ok = F.coalesce(c.rlike(UNIT_PRICE_PATTERN), F.lit(False))
    price = F.regexp_extract(c, UNIT_PRICE_PATTERN, 1).try_cast("double")
    qty = F.coalesce(F.nullif(F.regexp_extract(c, UNIT_PRICE_PATTERN, 2), F.lit("")), F.lit("1")).try_cast("double")
    uom = F.lower(F.regexp_extract(c, UNIT_PRICE_PATTERN, 3))
    return (F.when(ok, price).otherwise(F.lit(0.0)),
            F.when(ok, qty).otherwise(F.lit(0.0)),
            F.when(ok, uom).otherwise(F.lit("")))


def as_text(col) -> Column:
    """String form used inside fingerprints (NULL stays NULL and is skipped)."""
    return _c(col).cast("string")


def row_hash(cols: list) -> Column:
    """sha256 hex of the columns joined by '||'; NULL parts are skipped."""
    return F.sha2(F.concat_ws(HASH_SEP, *[as_text(c) for c in cols]), 256)


def signature(brand_id="brand_id", canonical_name="canonical_name",
              unit_size="unit_size", unit_uom="unit_uom") -> Column:
    """canonical product signature."""
    return row_hash([brand_id, canonical_name, unit_size, unit_uom])


def token_sort(col) -> Column:
    """Tokens split on whitespace, sorted, joined by one blank."""
    toks = F.split(F.trim(F.regexp_replace(_c(col), WS + "+", " ")), " ")
    toks = F.filter(toks, lambda t: t != F.lit(""))
    return F.array_join(F.array_sort(toks), " ")
