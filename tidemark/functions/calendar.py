"""Calendar arithmetic as column expressions that never raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names and abbreviations, folded to plain lower-case letters, in English,
#: German, Spanish and French. Fixed values.
MONTHS = {
    1: "january jan januar jan janner enero ene janvier janv",
    2: "february feb februar febrero fevrier fevr fev",
    3: "march mar marz maerz mrz marzo mars",
    4: "april apr abril abr avril avr",
    5: "may mai mayo",
    6: "june jun juni junio juin",
    7: "july jul juli julio juillet juil",
    8: "august aug agosto ago aout",
    9: "september sep sept septiembre septembre",
    10: "october oct oktober okt octubre octobre",
    11: "november nov noviembre novembre",
    12: "december dec dezember dez diciembre dic decembre",
}


def month_number(name: Column) -> Column:
    """The month of a folded name, null if it is none."""
    pairs = {word: number for number, words in MONTHS.items() for word in words.split()}
    table = F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))
    return F.try_element_at(table, name)


def is_leap(year: Column) -> Column:
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def days_in_month(year: Column, month: Column) -> Column:
    """Days of a month; 0 if the month is none."""
    return (
        F.when(month.isin(1, 3, 5, 7, 8, 10, 12), 31)
        .when(month.isin(4, 6, 9, 11), 30)
        .when(month == 2, F.when(is_leap(year), 29).otherwise(28))
        .otherwise(0)
    )


def day_number(year: Column, month: Column, day: Column) -> Column:
    """Days since 1970-01-01 of a proleptic Gregorian date with a year of 0 or more."""
    y = year.cast("long") - F.when(month <= 2, 1).otherwise(0)
    era = F.floor(y / 400)
    yoe = y - era * 400
    doy = F.floor((153 * (month + F.when(month > 2, -3).otherwise(9)) + 2) / 5) + day - 1
    doe = yoe * 365 + F.floor(yoe / 4) - F.floor(yoe / 100) + doy
    return era * 146097 + doe - 719468
