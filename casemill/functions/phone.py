"""Phone number rules. Patterns are the fixed values of the Dutch number plan."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
NL_MOBILE = r"^(06|\+316)[0-9]{8}$"
NL_LANDLINE = r"^(0[1-57-9]|\+31[1-57-9])[0-9]{7,8}$"
INTERNATIONAL = r"^\+[0-9]{10,14}$"
KNOWN_COUNTRIES = ("+31", "+32", "+49", "+33", "+44")
PROVIDERS = {"KPN": "[0-2]", "Vodafone": "[3-5]", "T-Mobile": "[6-8]"}


def e164(c: Column, country_code: str = "31") -> Column:
    """International form with a plus; null when there is no digit.

    ``00`` and a national leading zero are both replaced by the plus form.
    """
    digits = F.regexp_replace(c, "[^0-9]", "")
    intl = (
        F.when(digits.startswith("00"), digits.substr(F.lit(3), F.length(digits)))
        .when(digits.rlike("^0[1-9][0-9]{8}$"),
              F.concat(F.lit(country_code), digits.substr(F.lit(2), F.length(digits))))
        .when((F.length(digits) == 9) & ~digits.startswith(country_code),
              F.concat(F.lit(country_code), digits))
        .otherwise(digits)
    )
    return F.when(F.length(intl) > 0, F.concat(F.lit("+"), intl))


def valid_e164(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\+[1-9][0-9]{1,14}$"), F.lit(False))


def valid(c: Column) -> Column:
    """10 to 15 characters in one of the three known shapes."""
    shape = c.rlike(NL_MOBILE) | c.rlike(NL_LANDLINE) | c.rlike(INTERNATIONAL)
    return F.coalesce(F.length(c).between(10, 15) & shape, F.lit(False))


def normalize_nl(c: Column) -> Column:
    """National numbers get +31 for their zero, plus forms stay, others get +31 in front."""
    national = c.rlike(r"^06[0-9]{8}$") | c.rlike(r"^0[1-57-9][0-9]{7,8}$")
    return (
        F.when(national, F.concat(F.lit("+31"), c.substr(F.lit(2), F.length(c))))
        .when(c.rlike(r"^\+[0-9]+$"), c)
        .otherwise(F.concat(F.lit("+31"), c))
    )


def country_code(c: Column) -> Column:
    return F.when(c.startswith("+"), F.substring(c, 1, 3)).otherwise(F.lit(KNOWN_COUNTRIES[0]))


def phone_type(c: Column) -> Column:
    return (
        F.when(c.rlike(r"^(\+316|06)"), "mobile")
        .when(c.rlike(r"^(\+31[1-57-9]|0[1-57-9])"), "landline")
        .when(c.rlike(r"^\+[0-9]{2}[6-9]"), "mobile")
        .otherwise("unknown")
    )


def provider(c: Column) -> Column:
    rule = F.lit("Unknown")
    for name, digit in PROVIDERS.items():
        rule = F.when(c.rlike(rf"^(\+316|06){digit}"), name).otherwise(rule)
    return rule


def area_code(c: Column) -> Column:
    return F.when(c.startswith("+31"), F.substring(c, 4, 2))


def local_number(c: Column) -> Column:
    return F.when(c.startswith("+31"), c.substr(F.lit(6), F.length(c))).otherwise(c)


def intake_clean(c: Column) -> Column:
    """Drop blanks, dashes and brackets; a leading plus becomes 00."""
    return F.regexp_replace(F.regexp_replace(c, r"[\s\-()]", ""), r"^\+", "00")
