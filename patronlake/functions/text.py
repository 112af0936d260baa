"""Text clean-up: e-mail validation, title case, accents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from patronlake.schemas import EMAIL_PATTERN

# Plain letters for the accented ones in the pseudonym name lists.
ACCENTED = "ãíáúóêéâôõàçü"
UNACCENTED = "aiauoeeaooacu"

# Provider domains with the usual typing slips. They are well-formed, so the e-mail
# pattern accepts them; only this list finds them.
TYPO_DOMAINS = ["gmal.com", "hotmal.com", "outlok.com", "yaho.com.br"]
# Provider domains that lost the dot before "com".
DOTLESS_DOMAINS = ["gmailcom", "hotmailcom", "yahoocom.br", "outlookcom", "uolcom.br"]


def clean_email(column: Column) -> Column:
    """Lower-cased address, or NULL. The pattern is tested before trimming, so an address with a
    leading blank is rejected, not repaired."""
    return F.when(column.rlike(EMAIL_PATTERN), F.lower(F.trim(column)))


def email_fault(column: Column) -> Column:
    """Kind of fault in a raw address; the first that applies."""
    domain = F.lower(F.substring_index(F.trim(column), "@", -1))
    return (
        F.when(column.isNull() | (F.trim(column) == ""), "missing")
        .when(~column.contains("@"), "no_at")
        .when(domain.isin(*TYPO_DOMAINS), "typo_domain")
        .when(~domain.contains(".") | domain.isin(*DOTLESS_DOMAINS), "no_dot")
        .when(~column.rlike(EMAIL_PATTERN), "malformed")
        .otherwise("ok")
    )


def text_or(column: Column, default: str) -> Column:
    trimmed = F.trim(column)
    return F.coalesce(F.nullif(trimmed, F.lit("")), F.lit(default))


def strip_accents(column: Column) -> Column:
    return F.translate(column, ACCENTED, UNACCENTED)


def title_case(column: Column) -> Column:
    """Capitalise every run of letters, also after digits and punctuation.

    ``initcap`` only starts words at blanks, so a marked blank is put before each such run and
    taken out again.
    """
    marked = F.regexp_replace(column, r"(?<=[^\p{L}])(?=\p{L})", "\u0001 ")
    return F.regexp_replace(F.initcap(marked), "\u0001 ", "")


def contains_pattern(term: str) -> str:
    """Search box term → ILIKE pattern. ``%`` and ``_`` in the term stay wildcards."""
    return f"%{term}%"
