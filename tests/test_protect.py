"""Masking, hashing, cleaning and amount checks, against the expected values and a restatement in Python."""

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txguard.functions import protect
from txguard.operators.quality import valid_amount


@pytest.fixture
def apply(spark):
    """Evaluate a column function on a list of texts."""
    def run(function, values, kind="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        return [r.o for r in rows.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]

    return run


MASKED = [("C1234567890", "C1234******"), ("C123", "C123"), ("", ""), (None, None), ("M12345", "M1234*"),
          ("C1231006815", "C1231******"), ("C9876543210", "C9876******"), ("C1234", "C1234"), ("C12345", "C1234*")]


def test_mask(apply):
    assert apply(protect.mask_account, [v for v, _ in MASKED]) == [m for _, m in MASKED]


def test_mask_hides_the_rest(apply):
    (masked,) = apply(protect.mask_account, ["C9876543210"])
    assert masked.startswith("C9876") and masked.count("*") == 6 and "543210" not in masked


def test_mask_fixed(apply):
    assert apply(protect.mask_fixed, ["C1234567890", "C1234", None]) == ["C1234***", "C1234", None]


QUOTES, STATEMENTS = ["'", "1'", "x');"], ["delete from accounts", "or 2=2", "select pin from cards"]
INJECTIONS = [f"{quote} {statement}{end}" for quote in QUOTES for statement in STATEMENTS for end in ("", ";", " --")]


def test_sanitize_removes_injections(apply):
    for cleaned in apply(protect.sanitize, INJECTIONS):
        assert not any(mark in cleaned for mark in ("'", ";", "--", "="))


def test_sanitize_keeps_letters_digits_and_joins(apply):
    texts = ["M77-b_3 ok", 'note="<b>paid</b>" -- x', "\t M42\n", "42€ ✔ M42", "", None, "--", "a---b"]
    assert apply(protect.sanitize, texts) == ["M77-b_3 ok", "notebpaidb  x", "M42", "42  M42", "", "", "", "a-b"]


def test_sanitize_cuts(apply):
    assert apply(lambda c: protect.sanitize(c, max_length=50), ["A" * 200]) == ["A" * 50]
    assert apply(protect.sanitize, ["A" * 200]) == ["A" * 100]
    assert apply(protect.sanitize_ui, ["a--b" + "A" * 200]) == ["a--b" + "A" * 46]


def test_amounts(apply):
    amounts = [100.0, 0.01, 99_999_999.99, 0.0, -100.0, 100_000_000.0, 999_999_999.99, None, float("nan")]
    assert apply(valid_amount, amounts, "double") == [True] * 3 + [False] * 6


def test_hash(apply):
    salted = apply(lambda c: protect.hash_account(c, "s"), ["C123", "C123", "C456", "", None, "C1234567890"])
    assert salted[0] == salted[1] != salted[2]
    assert salted[0] == hashlib.sha256(b"s:C123").hexdigest()[:16] and len(salted[0]) == 16
    assert salted[3:5] == ["", ""] and "C1234567890" not in salted[5]


def test_hash_short(apply):
    assert apply(protect.hash_short, ["key", "", None]) == [hashlib.sha256(b"key").hexdigest()[:8], "none", "none"]


def test_money(apply):
    amounts = [1234.56, 0.0, 999.999, 1234567.0]
    assert apply(protect.format_money, amounts, "double") == ["$1,234.56", "$0.00", "$1,000.00", "$1,234,567.00"]
    assert apply(lambda c: protect.format_money(c, 0), amounts, "double") == ["$1,235", "$0", "$1,000", "$1,234,567"]


texts = st.lists(st.one_of(st.none(), st.text(st.characters(codec="utf-8"), max_size=130),
                           st.text("aB9-_ \t\n\x1c\x85\xa0 ;'", max_size=130)), min_size=40, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=texts)
def test_text_functions_match_python(apply, values):
    def clean(text, length, comments):
        kept = re.sub(r"[^a-zA-Z0-9\s\-_]", "", (text or "")[:length])
        return (kept.replace("--", "") if comments else kept).strip()

    assert apply(protect.sanitize, values) == [clean(v, 100, True) for v in values]
    assert apply(protect.sanitize_ui, values) == [clean(v, 50, False) for v in values]
    assert apply(protect.mask_account, values) == [
        v if not v or len(v) <= 5 else v[:5] + "*" * (len(v) - 5) for v in values]
    assert apply(lambda c: protect.hash_account(c, "x"), values) == [
        hashlib.sha256(f"x:{v}".encode()).hexdigest()[:16] if v else "" for v in values]
