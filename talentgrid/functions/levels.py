"""Rules from a job title or a level text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from talentgrid import vocab
from talentgrid.functions.lookup import contains_any, first_contained, lookup


def seniority_from_title(title: Column) -> Column:
    """Level of the first title keyword, tried in table order."""
    return first_contained(title, vocab.TITLE_KEYWORDS.items(), vocab.DEFAULT_LEVEL)


def level_from_title(title: Column, category: Column, strict_words: bool = False) -> Column:
    """Experience level by ordered rules: executives, managers, ..., starters.

    Plain containment is the default, under which "cco" is found in "account";
    ``strict_words`` asks for whole words instead.  A title no rule covers takes
    the first level its category allows.
    """
    text = F.lower(title)

    def has(*words: str) -> Column:
        if not strict_words:
            return contains_any(text, words)
        whole = "|".join(word.replace(".", r"\.") for word in words)
        return text.rlike(rf"(^|\W)({whole})(\W|$)")

    out = F.when(has(*vocab.CHIEF_WORDS), "C-Level Executive (CXO)")
    out = out.when(has(*vocab.EXECUTIVE_WORDS), "Director/VP")
    for word, level in vocab.TITLE_LEVEL_WORDS:
        out = out.when(has(word), level)
    out = out.when(has("developer") & ~has(*vocab.MID_LEVEL_BLOCKERS), vocab.DEFAULT_LEVEL)
    for word, level in vocab.STARTER_WORDS:
        out = out.when(has(word), level)
    return out.otherwise(F.get(lookup(vocab.ALLOWED_LEVELS, category), 0))


def salary_band_level(level: Column) -> Column:
    """Name of the first salary band contained in a level text, else NULL."""
    return first_contained(level, [(name, name) for name in vocab.SALARY_BANDS])


def salary_band(band_level: Column) -> tuple[Column, Column]:
    """(lowest, highest) salary of a band; (0, 0) without one."""
    low = {name: band[0] for name, band in vocab.SALARY_BANDS.items()}
    high = {name: band[1] for name, band in vocab.SALARY_BANDS.items()}
    return lookup(low, band_level, 0), lookup(high, band_level, 0)


def years_texts(band_level: Column) -> Column:
    """Experience texts a level may be written with (level -> class -> texts)."""
    return lookup(vocab.YEARS_TEXTS, lookup(vocab.LEVEL_YEARS_CLASS, band_level))


def allowed_employment(level: Column) -> Column:
    return lookup(vocab.EMPLOYMENT_RULES, level, vocab.DEFAULT_EMPLOYMENT)


def allowed_languages(country: Column) -> Column:
    return lookup(vocab.COUNTRY_LANGUAGES, country)
