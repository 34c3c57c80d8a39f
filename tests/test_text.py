"""Text rules (F1-F3, F6) on the hand-worked edge cases of FIXTURES.md."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricelake.functions.text import normalize_name, parse_pack, parse_unit_price, token_sort
from pricelake.operators.fuzzy import lcs_length


def _one(spark, expr_fn, values, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [tuple(r) for r in df.select(*expr_fn(F.col("x"))).collect()]


def test_normalize_name(spark):
    got = _one(spark, lambda c: [normalize_name(c)],
               ["Choc<br />Chip... Cookies®  200G", "A::.:B 1.5L", "  Tim Tam\tOriginal ", "x.y"])
    assert [g[0] for g in got] == ["choc chip cookies 200g", "a b 1.5l", "tim tam original", "x.y"]


@pytest.mark.parametrize("text,size,uom", [
    ("milk 1.5l", 1.5, "l"), ("6 pack pies 500g", 500.0, "g"), ("12 large eggs", 12.0, "l"),
    ("muffins 4 pk", 4.0, "pk"), ("rice 1,000g", 0.0, "g"), ("bread", None, None),
    ("juice 1.1l", float.fromhex("0x1.19999ap+0"), "l"),  # 32-bit float widened
])
def test_parse_pack(spark, text, size, uom):
    [(s, u)] = _one(spark, lambda c: list(parse_pack(c)), [text])
    assert (s, u) == (size, uom)


def test_parse_unit_price(spark):
    got = _one(spark, lambda c: list(parse_unit_price(c)), ["$1.50 / 100G", "2/EA", "n/a", "", None, " $3 /KG "])
    assert got == [(1.5, 100.0, "g"), (2.0, 1.0, "ea"), (0.0, 0.0, ""), (0.0, 0.0, ""), (0.0, 0.0, ""),
                   (3.0, 1.0, "kg")]


def test_token_sort(spark):
    got = _one(spark, lambda c: [token_sort(c)], ["milk full cream", "  b  a ", "single"])
    assert [g[0] for g in got] == ["cream full milk", "a b", "single"]


def _lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for ch in a:
        cur = [0]
        for j, bj in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ch == bj else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc de", max_size=40), st.text(alphabet="abc de", max_size=40))
def test_lcs_bit_parallel_equals_dp(a, b):
    assert lcs_length(a, b) == _lcs_dp(a, b)


def test_lcs_long_strings():
    a = "abcdefghij" * 20
    b = "bcdefghija" * 19
    assert lcs_length(a, b) == _lcs_dp(a, b)


def test_whitespace_classes_agree(spark):
    """Java's fast class and the RE2 spelling are both Python's isspace set."""
    from pricelake.functions.text import WS, WS_PORTABLE
    chars = [chr(i) for i in range(0x10000) if not (0xD800 <= i < 0xE000)]
    df = spark.createDataFrame([(c,) for c in chars], "c string")
    fast = {r.c for r in df.where(F.col("c").rlike("^" + WS + "$")).collect()}
    portable = {r.c for r in df.where(F.col("c").rlike("^" + WS_PORTABLE + "$")).collect()}
    assert fast == portable == {c for c in chars if c.isspace()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", " ", "  ", "\t", " ", ".", "..", "...", ":", "::", ":.:",
                                 "<br>", "<BR />", "<br/>", "®", "™", "12", "g", " "]), max_size=12))
def test_normalize_equals_stepwise_rules(spark, parts):
    """The folded expression equals the rules applied one by one."""
    from pricelake.functions.text import COLON_DOT, DOT_RUN, SYMBOLS, WS
    from pricelake.functions.text import BR_TAG
    text = "".join(parts)
    c = F.col("x")
    for pat, rep in [(BR_TAG, " "), (DOT_RUN, " ")]:
        c = F.regexp_replace(c, pat, rep)
    c = F.lower(c)
    for pat, rep in [(SYMBOLS, ""), (WS + "+", " "), (COLON_DOT, " "), (WS + "+", " ")]:
        c = F.regexp_replace(c, pat, rep)
    [(folded, stepwise)] = _one(spark, lambda x: [normalize_name(x), F.trim(c)], [text])
    assert folded == stepwise
