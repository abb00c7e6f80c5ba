"""Text rules for descriptions and messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Prefixes dropped from descriptions, one after the other.
DESCRIPTION_PREFIXES = ("Betaling:", "Payment:", "Transfer:")
DESCRIPTION_LENGTH = 1000  # the reference cuts descriptions to so many characters

# Keyword groups, the first that matches names the category.
CATEGORY_WORDS = {
    "income": ("salary", "salaris"),
    "housing": ("rent", "huur"),
    "groceries": ("groceries", "albert heijn", "jumbo", "boodschappen"),
    "transfer": ("transfer", "overschrijving"),
    "subscription": ("netflix", "spotify", "subscription"),
    "utilities": ("gas", "water", "electric", "energie"),
}

# Currency codes and other spellings of them.
CURRENCIES = ("EUR", "USD", "GBP", "CHF", "JPY", "AUD", "CAD", "SEK", "NOK", "DKK", "PLN", "CZK", "HUF")
CURRENCY_ALIASES = {"€": "EUR", "$": "USD", "£": "GBP", "EURO": "EUR", "DOLLAR": "USD"}

TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def first_match(rules, otherwise) -> Column:
    """The value of the first (condition, value) pair that holds."""
    rules = list(rules)
    out = F.when(rules[0][0], rules[0][1])
    for condition, value in rules[1:]:
        out = out.when(condition, value)
    return out.otherwise(otherwise)


def contains_any(c: Column, words) -> Column:
    """True when the text holds one of the words, whatever the case; false on null."""
    low, hit = F.lower(c), F.lit(False)
    for word in words:
        hit = hit | low.contains(word)
    return F.coalesce(hit, F.lit(False))


def clean_description(c: Column, length: int | None = None) -> Column:
    """One line without prefixes: the whole text, or its first ``length`` characters (DESCRIPTION_LENGTH for the reference's cut)."""
    prefixes = "".join(f"(?:{prefix} *)?" for prefix in DESCRIPTION_PREFIXES)
    text = F.regexp_replace(F.trim(F.regexp_replace(c, r"\s+", " ")), f"^{prefixes}", "")
    return F.when(F.length(c) > 0, text if length is None else F.substring(text, 1, length))


def category(c: Column) -> Column:
    return first_match(((contains_any(c, words), name) for name, words in CATEGORY_WORDS.items()), "other")


def last_token(c: Column) -> Column:
    return F.split_part(c, F.lit(" "), F.lit(-1))


def word_count(c: Column) -> Column:
    """Blank-separated pieces; null when there is no text."""
    text = F.trim(F.coalesce(c, F.lit("")))
    return F.when(text != "", F.size(F.split(text, " ")))


def is_numeric(c: Column) -> Column:
    """An amount where an account was expected."""
    return F.coalesce(F.regexp_replace(c, "[.,-]", "").rlike("^[0-9]+$"), F.lit(False))


def dutch_decimal(c: Column, kind: str = "decimal(15,2)") -> Column:
    """``1.234,56`` and ``1234.56`` both read as 1234.56; other text as null."""
    dutch = F.translate(F.translate(c, ".", ""), ",", ".")
    return F.when(c.contains(","), dutch).otherwise(c).try_cast(kind)


def normalize_currency(c: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in CURRENCY_ALIASES.items() for x in pair])
    return F.when(F.length(c) > 0, F.coalesce(F.try_element_at(names, F.upper(c)), F.upper(c)))


def valid_currency(c: Column) -> Column:
    return F.coalesce(c.isin(*CURRENCIES), F.lit(False))


def tokens(c: Column) -> Column:
    """Distinct lower-case words of a text."""
    parts = F.split(F.lower(F.coalesce(c, F.lit(""))), TOKEN_BREAK)
    return F.array_distinct(F.filter(parts, lambda t: t != ""))
