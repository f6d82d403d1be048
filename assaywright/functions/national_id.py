"""National identity number check built from native functions (``luhn_check`` included)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import named

# The number's format and the message texts.
PREFIX = "784"
DIGITS = 15
OLDEST_YEAR = 1800
LEAD = "Invalid Emirates ID - "
BAD_PREFIX = LEAD + "Must start with 784"
BAD_LENGTH = LEAD + "Emirates ID must be 15 digits long"
BAD_YEAR = LEAD + "Year in Emirates ID must be greater than 1800 and less than {year}"
NOT_NUMERIC = LEAD + "Non-numeric characters"
BAD_CHECKSUM = LEAD + "Invalid checksum"
BAD_DOB = LEAD + "Emirates ID year does not match DOB year"


def national_id_messages(column: str, current_year: int, dob_column: str | None = None) -> list[Column]:
    """Nullable messages, one per sub-check; all NULL means the number is valid."""
    number = F.regexp_replace(named(column), r"[\s-]+", "")
    year = F.substring(number, 4, 4).try_cast("int")
    checks = [
        F.when(~number.startswith(PREFIX), F.lit(BAD_PREFIX)),
        F.when(F.length(number) != DIGITS, F.lit(BAD_LENGTH)),
        F.when((year <= OLDEST_YEAR) | (year >= current_year), F.lit(BAD_YEAR.format(year=current_year))),
        F.when(~number.rlike("^[0-9]*$"), F.lit(NOT_NUMERIC)).when(
            (F.length(number) != DIGITS) | ~F.call_function("luhn_check", number), F.lit(BAD_CHECKSUM)
        ),
    ]
    if dob_column:
        checks.append(F.when(year != birth_year(named(dob_column)), F.lit(BAD_DOB)))
    return checks


def birth_year(value: Column) -> Column:
    """Year of a birth date in one of three shapes; NULL for anything else."""
    stamp = F.when(
        value.rlike(r"^\d{2}-\d{2}-\d{4} \d{2}:\d{2}:\d{2}$"),
        F.to_date(F.try_to_timestamp(value, F.lit("dd-MM-yyyy HH:mm:ss"))),
    )
    stamp = stamp.when(
        value.rlike(r"^\d{2}-\d{2}-\d{4}$"), F.to_date(F.try_to_timestamp(value, F.lit("dd-MM-yyyy")))
    )
    stamp = stamp.when(
        value.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.to_date(F.try_to_timestamp(value, F.lit("yyyy-MM-dd")))
    )
    return F.year(stamp)
