"""Text cleansing (T01-T09) as Column functions.

Order of `clean`: NFKC, emoji removal, squeeze, PII masks, special characters, synonyms, profanity, white space,
trim. Null and '' pass unchanged. Only NFKC and the two lexicons need Python (Arrow batches); all else is native.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lakewright.functions.keywords import Replacer

#: Emoji blocks, variation selectors, joiners, key-cap and flag parts.
EMOJI = (
    r"[0-9#*]\x{FE0F}?\x{20E3}|[\x{1F1E6}-\x{1F1FF}]{2}"
    r"|[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{2300}-\x{23FF}\x{3030}\x{303D}\x{3297}\x{3299}\x{2049}\x{203C}\x{00A9}\x{00AE}\x{2122}\x{2139}"
    r"\x{2194}-\x{21AA}\x{24C2}\x{25AA}-\x{25FE}][\x{FE0F}\x{1F3FB}-\x{1F3FF}]*(?:\x{200D}[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}][\x{FE0F}\x{1F3FB}-\x{1F3FF}]*)*|\x{FE0F}"
)
#: Beyond what emoji are made of; each alternative above needs such a character.
_RARE = r"[^\x{00}-\x{A8}\x{AA}-\x{AD}\x{AF}-\x{2038}\x{3040}-\x{3296}\x{329A}-\x{FE0E}\x{FE10}-\x{1EFFF}]"
# The masks' patterns decide what is masked.
EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
PHONE = r"01[016789](?U:[-\s.])?\p{Nd}{3,4}(?U:[-\s.])?\p{Nd}{4}"
ACCOUNT = r"(?<!\p{Nd})\p{Nd}{10,14}(?!\p{Nd})|(?<![\p{L}\p{N}_])\p{Nd}{3,6}-\p{Nd}{2,6}-\p{Nd}{3,6}(?![\p{L}\p{N}_])"
KEPT = r"[^\p{L}\p{N}_\s\x{0085}\x{00A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{3000}!?.,\[\]]"


def normalize_unicode(c: Column) -> Column:
    """T01. ASCII text is its own NFKC form and reaches the UDF as null."""

    @pandas_udf("string")
    def nfkc(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")

    return F.coalesce(nfkc(F.when(~c.rlike(r"^\p{ASCII}*\z"), c)), c)


def _only_if(c: Column, needs, change) -> Column:
    """change(c) where needs(c), else c; c is computed once."""
    return F.element_at(F.transform(F.array(c), lambda x: F.when(needs(x), change(x)).otherwise(x)), 1)


def remove_emojis(c: Column) -> Column:
    """T02."""
    return _only_if(c, lambda x: (F.length(x) < F.octet_length(x)) & x.rlike(_RARE), lambda x: F.regexp_replace(x, EMOJI, ""))


def reduce_repeated_chars(c: Column) -> Column:
    """Three or more of a character (but line feeds) become two."""
    return F.regexp_replace(c, r"([^\n])\1{2,}", "$1$1")


def mask_email(c: Column) -> Column:
    return _only_if(c, lambda x: x.contains("@"), lambda x: F.regexp_replace(x, EMAIL, "[EMAIL]"))


def mask_phone(c: Column) -> Column:
    return _only_if(c, lambda x: x.contains("01"), lambda x: F.regexp_replace(x, PHONE, "[TEL]"))


def mask_account(c: Column) -> Column:
    return _only_if(c, lambda x: x.rlike(r"\p{Nd}{3}"), lambda x: F.regexp_replace(x, ACCOUNT, "[ACC]"))


def mask_pii(c: Column) -> Column:
    """E-mail, then phone, then account numbers."""
    return mask_account(mask_phone(mask_email(c)))


def remove_special_chars(c: Column) -> Column:
    """T05."""
    return F.regexp_replace(c, KEPT, "")


def replace_words(c: Column, words: dict[str, str]) -> Column:
    """Longest match, case-insensitive; Latin keywords only at word borders."""
    if not words:
        return c
    replacer = Replacer(words)

    @pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(replacer.replace, na_action="ignore")

    return run(c)


def normalize_whitespace(c: Column) -> Column:
    """T08."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean(c: Column, synonyms: dict[str, str] | None = None, profanity: dict[str, str] | list[str] | None = None) -> Column:
    """T09. The two lexicons share one UDF hop."""
    out = remove_special_chars(mask_pii(reduce_repeated_chars(remove_emojis(normalize_unicode(c)))))
    tags = dict.fromkeys(profanity, "[SLANG]") if isinstance(profanity, list) else dict(profanity or {})
    if synonyms or tags:
        first, second = Replacer(synonyms or {}), Replacer(tags)

        @pandas_udf("string")
        def lexicons(s: pd.Series) -> pd.Series:
            return s.map(lambda x: second.replace(first.replace(x)), na_action="ignore")

        out = lexicons(out)
    return strip(normalize_whitespace(out))


def is_blank(c: Column) -> Column:
    """null or white space only."""
    return c.isNull() | ~c.rlike(r"(?U)\S")


def clean_text(c: Column) -> Column:
    """Null to '', line breaks to spaces, runs collapsed, trimmed."""
    return strip(normalize_whitespace(F.coalesce(c, F.lit(""))))
