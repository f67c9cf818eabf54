"""Masking, hashing and cleaning of account ids and typed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python counts as white space, and what cleaned text may keep besides them.
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
KEPT = rf"a-zA-Z0-9{SPACE}\-_"


def mask_account(account: Column, visible_chars: int = 4) -> Column:
    """Keep the prefix letter and ``visible_chars`` more, star the rest; short ids stay as they are."""
    shown = visible_chars + 1
    stars = F.repeat(F.lit("*"), F.length(account) - shown)
    return F.when(F.length(account) > shown, F.concat(F.substring(account, 1, shown), stars)).otherwise(account)


def mask_fixed(account: Column, shown: int = 5) -> Column:
    """Keep ``shown`` characters and add three stars, whatever the length of the rest."""
    return F.when(F.length(account) > shown, F.concat(F.substring(account, 1, shown), F.lit("***"))).otherwise(account)


def hash_account(account: Column, salt: str) -> Column:
    """First 16 hex digits of SHA-256 over ``salt:id``; empty text for a missing id."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), account).cast("binary"), 256)
    return F.when(F.length(account) > 0, F.substring(digest, 1, 16)).otherwise(F.lit(""))


def hash_short(key: Column) -> Column:
    """First 8 hex digits of SHA-256, or ``none`` for a missing key."""
    return F.when(F.length(key) > 0, F.substring(F.sha2(key.cast("binary"), 256), 1, 8)).otherwise(F.lit("none"))


def sanitize(text: Column, max_length: int = 100, drop_comments: bool = True) -> Column:
    """Cut to ``max_length``, drop unsafe characters (and ``--``), strip; missing text becomes empty."""
    kept = F.regexp_replace(F.substring(text, 1, max_length), f"[^{KEPT}]", "")
    if drop_comments:
        kept = F.replace(kept, F.lit("--"), F.lit(""))
    stripped = F.regexp_replace(kept, rf"^[{SPACE}]+|[{SPACE}]+\z", "")
    return F.coalesce(stripped, F.lit(""))


def sanitize_ui(text: Column) -> Column:
    """The search box variant: 50 characters, comment marks stay."""
    return sanitize(text, max_length=50, drop_comments=False)


def format_money(amount: Column, decimals: int = 2) -> Column:
    """``$1,234.56``; the sign stays behind the currency mark as Python's format does it."""
    return F.concat(F.lit("$"), F.format_number(amount, decimals))
