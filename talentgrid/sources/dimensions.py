"""The vocabularies as lookup tables, for SQL and joins.

Every table is a literal of at most a few hundred rows, safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talentgrid import vocab
from talentgrid.functions.lookup import literal_table
from talentgrid.operators.families import family_table


def dimensions(spark: SparkSession) -> dict[str, DataFrame]:
    """Name -> table; ``ordinal`` gives the order in which keys are tried."""

    def table(columns: str, rows) -> DataFrame:
        return literal_table(spark, columns.split(), list(rows))

    return {
        "category_family": family_table(spark),
        "title_keyword": table(
            "ordinal keyword level",
            [(at, *pair) for at, pair in enumerate(vocab.TITLE_KEYWORDS.items())],
        ),
        "salary_band": table(
            "ordinal level min_salary max_salary",
            [(at, level, *band) for at, (level, band) in enumerate(vocab.SALARY_BANDS.items())],
        ),
        "level_years": table("level years_class", vocab.LEVEL_YEARS_CLASS.items()),
        "years_text": table(
            "years_class text",
            [(kind, text) for kind, texts in vocab.YEARS_TEXTS.items() for text in texts],
        ),
        "employment_rule": table("keyword types", vocab.EMPLOYMENT_RULES.items()),
        "category_counts": table(
            "category skills certificates_min certificates_max levels",
            [
                (name, vocab.SKILL_COUNTS[name], *vocab.CERTIFICATE_RANGES[name], levels)
                for name, levels in vocab.ALLOWED_LEVELS.items()
            ],
        ),
        "seniority_rank": table("word rank", vocab.SENIORITY_RANKS.items()),
        "country_language": table(
            "country language",
            [(name, spoken) for name, many in vocab.COUNTRY_LANGUAGES.items() for spoken in many],
        ),
        "industry_weight": table(
            "industry continent weight",
            [
                (industry, continent, weight)
                for industry, weights in vocab.CONTINENT_WEIGHTS.items()
                for continent, weight in zip(vocab.CONTINENTS, weights)
            ],
        ),
        "education_weight": table(
            "age_band education_level weight",
            [
                (band, level, weight)
                for band, (_, weights) in vocab.EDUCATION_WEIGHTS.items()
                for level, weight in zip(vocab.EDUCATION_LEVELS, weights)
            ],
        ),
        "employer_range": table("years_up_to fewest most", vocab.EMPLOYER_RANGES),
    }


def register(spark: SparkSession) -> None:
    """Make every dimension a temporary view of its name."""
    for name, rows in dimensions(spark).items():
        rows.createOrReplaceTempView(name)
