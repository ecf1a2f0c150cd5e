"""Cleaning of dirty text, as native column expressions (``Column -> Column``).

Every function returns null where nothing usable is left. Source columns are read as text: the digit
filters would turn a number printed as ``3.0`` into 30 and one printed as ``1.0E7`` into 1.07.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Patterns, placeholders and vocabularies of the source data.
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
OCCUPATION_BLANK = "_______"
NAME_UNWANTED = r"[^A-Za-z .'-]"
LOAN_SEPARATOR = r"\s+and\s+|,\s+and\s+|,\s*"
NO_LOAN = "Not Specified"
UNKNOWN = "Unknown"
CREDIT_MIX_ORDER = ["Bad", "Standard", "Good"]
PAYMENT_BEHAVIOUR_ORDER = [
    "Low_spent_Small_value_payments", "Low_spent_Medium_value_payments", "Low_spent_Large_value_payments",
    "High_spent_Small_value_payments", "High_spent_Medium_value_payments", "High_spent_Large_value_payments",
]
# The first feature store leaves out the ``Large`` values.
PAYMENT_BEHAVIOUR_V1 = [
    "High_spent_Small_value_payments", "High_spent_Medium_value_payments",
    "Low_spent_Small_value_payments", "Low_spent_Medium_value_payments",
]
OUTLIER_CAPS = {
    "Num_Bank_Accounts": 10,
    "Num_Credit_Card": 10,
    "Interest_Rate": 34,
    "Num_of_Loan": 9,
    "Num_of_Delayed_Payment": 47,
    "Num_Credit_Inquiries": 26,
}


def _only(c: Column, kept: str) -> Column:
    """Text reduced to the characters of a class such as ``\\d.``."""
    return F.regexp_replace(c.cast("string"), f"[^{kept}]", "")


def not_negative(c: Column) -> Column:
    """Negative values to null."""
    return F.when(c >= 0, c)


def first_number(c: Column) -> Column:
    """Age, first form: the first run of digits."""
    return F.regexp_extract(c, r"(\d+)", 1).try_cast("int")


def age_in_range(c: Column, low: int = 0, high: int = 100) -> Column:
    """Age, second form: all digits run together, kept within ``low``..``high``."""
    age = _only(c, r"\d").try_cast("int")
    return F.when(age.between(low, high), age)


def social_security(c: Column) -> Column:
    """Kept when it has the form ddd-dd-dddd."""
    return F.when(c.rlike(SSN_PATTERN), c)


def occupation_title(c: Column) -> Column:
    """Occupation, first form: placeholder and blank to null, underscores to spaces, initial capitals."""
    filled = (F.trim(c) != "") & (c != OCCUPATION_BLANK)
    return F.when(filled, F.initcap(F.regexp_replace(c, "_", " ")))


def occupation_plain(c: Column) -> Column:
    """Occupation, second form: placeholder to null and one spelling repaired."""
    return F.when(c == "Media_Manager", F.lit("Media Manager")).when(c != OCCUPATION_BLANK, c)


def person_name(c: Column) -> Column:
    """Letters, space, dot, apostrophe and hyphen, without outer spaces."""
    return F.trim(F.regexp_replace(c, NAME_UNWANTED, ""))


def money(c: Column, scale: int | None = 2, signed: bool = False) -> Column:
    """Digits and dot (with ``signed`` also the minus) to double, rounded unless ``scale`` is None.

    Unsigned, the minus is dropped, so ``-12.5`` gives 12.5. Signed, negative amounts become null.
    """
    value = _only(c, r"\d.-" if signed else r"\d.").try_cast("double")
    value = value if scale is None else F.round(value, scale)
    return not_negative(value) if signed else value


def signed_decimal(c: Column, scale: int = 2) -> Column:
    """Digits, dot and minus to double, rounded."""
    return F.round(_only(c, r"\d.-").try_cast("double"), scale)


def signed_count(c: Column) -> Column:
    """Digits and minus to int, negative to null."""
    return not_negative(_only(c, r"\d-").try_cast("int"))


def plain_count(c: Column) -> Column:
    """Number text to int (decimals cut off), negative to null."""
    return not_negative(whole(c))


def whole(c: Column) -> Column:
    """Number text to int, decimals cut off."""
    return c.try_cast("double").try_cast("int")


def digit_count(c: Column, signed: bool = False) -> Column:
    """Digits run together to int; the sign is lost unless ``signed``, which nulls negative counts."""
    return signed_count(c) if signed else _only(c, r"\d").try_cast("int")


def history_years(c: Column) -> Column:
    """``N Years and M Months`` to years with two decimals."""
    years = F.regexp_extract(c, r"(\d+)\s+Years", 1).try_cast("int")
    months = F.regexp_extract(c, r"(\d+)\s+Months", 1).try_cast("int")
    return F.round(years + months / 12, 2)


def history_months(c: Column) -> Column:
    """``N Years and M Months`` at the start of the text to months."""
    form = r"^(\d+) Years and (\d+) Months"
    years = F.regexp_extract(c, form, 1).try_cast("int")
    return years * 12 + F.regexp_extract(c, form, 2).try_cast("int")


def credit_mix_title(c: Column) -> Column:
    """Trimmed, ``_`` to null, initial capitals."""
    mix = F.trim(c)
    return F.when(mix != "_", F.initcap(mix))


def ordinal(c: Column, order: Sequence[str]) -> Column:
    """Rank of the value in ``order``, starting at 0; other values to null."""
    ranks = F.create_map(*[F.lit(x) for pair in zip(order, range(len(order))) for x in pair])
    return F.try_element_at(ranks, c)


def yes_no_text(c: Column) -> Column:
    """Yes or No in any case, else null."""
    answer = F.initcap(F.trim(c))
    return F.when(answer.isin("Yes", "No"), answer)


def yes_no_flag(c: Column) -> Column:
    """Exactly Yes to true, exactly No to false, else null."""
    return F.when(c.isin("Yes", "No"), c == "Yes")


def allowed(c: Column, values: Sequence[str]) -> Column:
    """Kept when listed in ``values``, else null."""
    return F.when(c.isin(*values), c)


def loan_text(c: Column) -> Column:
    """Null or blank loan list to ``Not Specified``."""
    return F.when(F.trim(c) != "", c).otherwise(F.lit(NO_LOAN))


def loan_list_text(c: Column) -> Column:
    """Lower case, all separators unified to a comma."""
    return F.regexp_replace(F.lower(c), LOAN_SEPARATOR, ",")


def split_trim(c: Column) -> Column:
    """Comma list to an array of trimmed elements."""
    return F.transform(F.split(c, ","), F.trim)


def cap(c: Column, top: int) -> Column:
    """Values above ``top`` to ``top``; null stays null."""
    return F.when(c > top, F.lit(top)).otherwise(c)


def clamp_negative(c: Column) -> Column:
    """Negative values to 0; null stays null."""
    return F.when(c < 0, F.lit(0)).otherwise(c)


def column_label(text: str) -> str:
    """Column-name form of a category: space and hyphen to underscore."""
    return text.replace(" ", "_").replace("-", "_")
