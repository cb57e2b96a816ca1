"""Rule columns for tables of posts and candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from talentgrid.functions import draws, experience, levels
from talentgrid.functions.lookup import literal_table, split_location
from talentgrid import vocab


def experience_columns(records: DataFrame, text: str) -> DataFrame:
    """``min_years max_years`` as the score reads a text, ``most_years`` as the load rules do."""
    low, high = experience.year_bounds(F.col(text))
    return records.withColumns(
        {"min_years": low, "max_years": high, "most_years": experience.most_years(F.col(text))}
    )


def title_columns(records: DataFrame, title: str, category: str, strict_words: bool = False) -> DataFrame:
    """``title_seniority`` by keyword and ``title_level`` by ordered rules."""
    return records.withColumns(
        {
            "title_seniority": levels.seniority_from_title(F.col(title)),
            "title_level": levels.level_from_title(F.col(title), F.col(category), strict_words),
        }
    )


def salary_band_columns(records: DataFrame, level: str) -> DataFrame:
    """``band`` and its ``band_min``, ``band_max`` for a level text."""
    named = records.withColumn("band", levels.salary_band_level(F.col(level)))
    low, high = levels.salary_band(F.col("band"))
    return named.withColumns({"band_min": low, "band_max": high})


def employer_columns(candidates: DataFrame, text: str = "experience_range") -> DataFrame:
    """``employers_min employers_max`` expected for an experience text."""
    low, high = experience.employer_range(
        experience.years_for_employers(F.coalesce(F.col(text), F.lit("")))
    )
    return candidates.withColumns({"employers_min": low, "employers_max": high})


def location_columns(candidates: DataFrame, text: str = "location") -> DataFrame:
    """``city`` and ``country`` of a ``"City, Country"`` text."""
    city, country = split_location(F.col(text))
    return candidates.withColumns({"city": city, "country": country})


def employment_allowed(posts: DataFrame, level: Column) -> DataFrame:
    """``employment_ok``: the employment type is one the level allows."""
    allowed = levels.allowed_employment(level)
    return posts.withColumn("employment_ok", F.array_contains(allowed, F.col("employment_type")))


def language_allowed(posts: DataFrame) -> DataFrame:
    """``language_ok``: the language is spoken in the country; NULL for an unknown country."""
    allowed = levels.allowed_languages(F.col("country"))
    return posts.withColumn("language_ok", F.array_contains(allowed, F.col("language")))


def draw_continent(posts: DataFrame, key: str, industry: str) -> DataFrame:
    """Add ``drawn_continent``: a weighted draw by the industry's continent weights.

    The weights become half-open integer ranges, so the draw is an equi-join on the
    industry with a range condition against a broadcast table of 108 rows.
    """
    ranges = []
    for name, weights in vocab.CONTINENT_WEIGHTS.items():
        upper = 0
        for continent, weight in zip(vocab.CONTINENTS, weights):
            ranges.append((name, continent, upper, upper + weight, sum(weights)))
            upper += weight
    table = literal_table(
        posts.sparkSession, ["weights_of", "drawn_continent", "from", "to", "total"], ranges
    )
    known = F.col(industry).isin([name for name in vocab.CONTINENT_WEIGHTS if name != "default"])
    weights_of = F.when(known, F.col(industry)).otherwise("default")
    hexed = posts.withColumn("weights_of", weights_of).withColumn(
        "digest", draws.digest(F.col(key), F.lit("continent"))
    )
    at = draws.whole(F.col("digest"), F.col("total"))
    return (
        hexed.join(F.broadcast(table), "weights_of")
        .filter((F.col("from") <= at) & (at < F.col("to")))
        .drop("weights_of", "digest", "from", "to", "total")
    )


def draw_salary(posts: DataFrame, key: str, level: str) -> DataFrame:
    """Add the salary band of a level text and ``drawn_salary`` from within it."""
    banded = salary_band_columns(posts, level)
    digest = draws.digest(F.col(key), F.lit("salary"))
    drawn = draws.between(digest, F.col("band_min"), F.col("band_max"))
    return banded.withColumn("drawn_salary", drawn)


def draw_deadline(posts: DataFrame, key: str, posted: str) -> DataFrame:
    """Add ``drawn_deadline``: a whole number of days after posting, within the rule."""
    low, high = vocab.DEADLINE_DAYS
    digest = draws.digest(F.col(key), F.lit("deadline"))
    days = draws.between(digest, F.lit(low), F.lit(high))
    return posts.withColumn(
        "drawn_deadline", F.col(posted) + F.make_dt_interval(days=days.cast("int"))
    )


def draw_employment(posts: DataFrame, key: str, title: str) -> DataFrame:
    """Add ``drawn_employment``: one of the types the title's seniority allows."""
    allowed = levels.allowed_employment(levels.seniority_from_title(F.col(title)))
    digest = draws.digest(F.col(key), F.lit("employment"))
    return posts.withColumn("drawn_employment", draws.pick(digest, allowed))


def draw_years(candidates: DataFrame, key: str, text: str) -> DataFrame:
    """Add ``drawn_graduation`` and ``drawn_birth``: years that fit the experience text."""
    digest = draws.digest(F.col(key), F.lit("graduation"))
    gap = draws.between(digest, F.lit(0), F.lit(vocab.GRADUATION_GAP))
    graduation, birth = experience.derived_years(F.col(text), gap)
    return candidates.withColumns({"drawn_graduation": graduation, "drawn_birth": birth})


def sample_list(records: DataFrame, key: str, items: str, size: Column, into: str) -> DataFrame:
    """Add ``into``: ``size`` elements of the list ``items``, no position twice."""
    return records.withColumn(into, draws.sample(F.col(items), size, F.col(key), F.lit(items)))
