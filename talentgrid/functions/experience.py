"""Experience texts such as ``"3-5 years"`` and ``"10+ years"``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from talentgrid import vocab


def _int(text: Column) -> Column:
    return text.try_cast("int")


def _numbers(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1))


def _first_number(text: Column) -> Column:
    return _int(F.get(_numbers(text), 0))


def _after_dash(text: Column) -> Column:
    """The word that follows the first dash, as a number."""
    tail = F.trim(F.get(F.split(text, "-"), 1))
    return _int(F.get(F.split(tail, r"\s+"), 0))


def year_bounds(text: Column) -> tuple[Column, Column]:
    """(fewest, most) years; (0, 0) where the text has no readable range."""
    numbers = _numbers(text)
    first, second = _int(F.get(numbers, 0)), _int(F.get(numbers, 1))
    is_open = text.contains("+")
    is_range = text.contains("-") & (F.size(numbers) == 2)
    is_single = F.size(numbers) == 1
    low = F.when(is_open | is_range | is_single, first)
    high = F.when(is_open, first + 2).when(is_range, second).when(is_single, first)
    return F.coalesce(low, F.lit(0)), F.coalesce(high, F.lit(0))


def most_years(text: Column) -> Column:
    """Upper year of a text: an open range counts two more than it says."""
    years = (
        F.when(text.contains("+"), _first_number(text) + 2)
        .when(text.contains("-"), _after_dash(text))
        .otherwise(_first_number(text))
    )
    return F.coalesce(years, F.lit(0))


def years_for_employers(text: Column) -> Column:
    """As :func:`most_years`, but a dash is looked for before a plus sign."""
    years = (
        F.when(text.contains("-"), _after_dash(text))
        .when(text.contains("+"), _first_number(text) + 2)
        .otherwise(_first_number(text))
    )
    return F.coalesce(years, F.lit(0))


def employer_range(years: Column) -> tuple[Column, Column]:
    """(fewest, most) previous employers expected after so many years."""

    def chain(pick: int) -> Column:
        *bounded, last = vocab.EMPLOYER_RANGES
        out = None
        for row in bounded:
            # the first band is the exact value 0, not everything up to it
            hit = years == row[0] if row[0] == 0 else years <= row[0]
            out = F.when(hit, row[pick]) if out is None else out.when(hit, row[pick])
        return out.otherwise(last[pick])

    return chain(1), chain(2)


def derived_years(text: Column, gap: Column) -> tuple[Column, Column]:
    """(graduation year, birth year) implied by an experience text."""
    graduation = F.lit(vocab.RULE_YEAR) - (most_years(text) + gap)
    return graduation, graduation - vocab.GRADUATION_AGE
