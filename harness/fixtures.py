"""Job-market tables projected from the driver's tables.

Integer arithmetic on the keys only, so that DuckDB (``harness.oracle``) derives
the same rows.  ``k`` is the table key and ``q`` = floor(k / 20).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from talentgrid import vocab
from talentgrid.functions.experience import most_years
from talentgrid.functions.lookup import literal_list

EXPERIENCE_TEXTS = [
    "0 years", "0-1 years", "1-2 years", "2-3 years", "3-5 years", "4-6 years",
    "5-8 years", "8-10 years", "10+ years", "12-15 years", "15+ years", "5 to 7 years",
]
TITLE_PREFIXES = ["", "Senior ", "Junior ", "Lead ", "Vice President of ", "Head of ", "Staff ", "Graduate "]
TITLE_NOUNS = [
    "Internal Auditor", "Accountant", "Developer", "Data Analyst", "Product Manager",
    "Quality Control Inspector", "Cloud Architect", "Sales Representative", "Entry Clerk",
    "Chief of Staff", "UX Designer", "Site Reliability Engineer", "Sr. Consultant",
]
INDUSTRIES = [
    "Information Technology", "Banking", "Healthcare", "Manufacturing", "Energy", "Retail",
    "Oil & Gas", "Gaming", "Legal Services", "Insurance", "Automotive",
]
LANGUAGES = ["English", "German", "French", "Spanish", "Hindi", "Mandarin Chinese"]
#: invented choices of the posts; two contracts are named as some level's rule names them
CONTRACTS = ["Full-time", "Contract", "by the day", "evenings", "on call", "one season", "trial month"]
PLACES = ["at the site", "from home", "now here, now there"]
APPLY_WAYS = [f'way {i}, "form {i}"' for i in range(6)]
BOARDS = [f"board {i}" for i in range(20)]
COUNTRIES = list(vocab.COUNTRY_LANGUAGES)
REGION_CONTINENT = {
    "AFRICA": "Africa", "AMERICA": "North America", "ASIA": "Asia", "EUROPE": "Europe",
    "MIDDLE EAST": "Asia",
}
EVENT_STATUS = {
    "signup": "Applied", "view": "Under Review", "click": "Shortlisted",
    "purchase": "Interview Scheduled", "error": "Rejected",
}
SKILL_POOL, CERT_POOL = 24, 9


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(words: list[str], index: Column) -> Column:
    return F.get(literal_list(words), index.cast("int"))


def _series(first: Column, step: int, count: Column, pool: int, word: str) -> Column:
    """``count`` words numbered first, first+step, ... (mod pool), capitals alternating."""
    return F.transform(
        F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(
            F.array().cast("array<int>")
        ),
        lambda i: F.concat(
            F.when(i % 2 == 0, word.capitalize()).otherwise(word),
            F.lit("_"),
            ((first + i * step) % pool).cast("string"),
        ),
    )


def _start(key: Column) -> Column:
    return F.timestamp_seconds(F.lit(1704067200) + key * 60)


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    q = F.floor(k / 20).cast("bigint")
    experience = F.when(k % 103 != 0, _pick(EXPERIENCE_TEXTS, (q + 5 * k) % 12))
    graduation = vocab.RULE_YEAR - (most_years(F.coalesce(experience, F.lit(""))) + k % 3) - F.when(
        k % 50 == 0, 10
    ).otherwise(0)
    employers = _series(q + k, 3, k % 7, 40, "company")
    return customer.join(
        F.broadcast(nation), customer["c_nationkey"] == nation["n_nationkey"]
    ).select(
        F.concat(F.lit("cand-"), k.cast("string")).alias("candidate_id"),
        F.concat(F.lit("Name "), k.cast("string")).alias("name"),
        _pick(["male", "female"], k % 2).alias("gender"),
        (graduation - vocab.GRADUATION_AGE - F.when(k % 60 == 0, 1).otherwise(0)).cast("string").alias("date_of_birth"),
        F.col("n_name").alias("nationality"),
        F.concat(F.lit("City"), (k % 30).cast("string"), F.lit(", "), F.col("n_name")).alias("location"),
        graduation.cast("int").alias("graduation_year"),
        ((20 + k % 21) / 10).alias("gpa"),
        _pick(vocab.EDUCATION_LEVELS, (q + 3 * k) % 8).alias("education_level"),
        _pick(vocab.CATEGORIES, (7 * k) % 20).alias("job_category"),
        F.concat(_pick(TITLE_PREFIXES, q % 8), _pick(TITLE_NOUNS, (q + 5 * k) % 13)).alias("current_title"),
        _pick(vocab.LEVELS, (q + 3 * k) % 22).alias("seniority"),
        experience.alias("experience_range"),
        F.when((q + 3 * k) % 22 == 0, "").otherwise(F.concat(F.lit("company_"), (k % 40).cast("string"))).alias("current_company"),
        employers.alias("previous_companies"),
        F.transform(employers, lambda name: F.concat(F.lit("industry of "), name)).alias("previous_industries"),
        F.when(k % 97 != 0, _series(q + 3 * k, 7, F.lit(12), SKILL_POOL, "skill")).alias("skills"),
        _series(k, 2, k % 6, CERT_POOL, "cert").alias("certifications"),
        F.when(k % 101 != 0, (12000 + 5000 * ((q + 37 * k) % 40)).cast("double")).alias("current_salary"),
        _start(k).alias("timestamp"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    place = nation.join(F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"])
    part = table(spark, sf_dir, "part").select("p_partkey")
    k = F.col("p_partkey")
    q = F.floor(k / 20).cast("bigint")
    level = (q + 3 * k) % 22
    posted = F.timestamp_seconds(F.lit(1704067200) + (k % 365) * 86400 + k % 86400)
    deadline = F.timestamp_seconds(
        F.lit(1704067200) + (k % 365) * 86400 + k % 86400
        + F.when(k % 40 == 0, 40).otherwise(5 + k % 25) * 86400
    )
    return part.join(F.broadcast(place), k % 25 == place["n_nationkey"]).select(
        F.concat(F.lit("post-"), k.cast("string")).alias("post_id"),
        F.concat(F.lit("company_"), (k % 40).cast("string")).alias("company"),
        _pick(vocab.CATEGORIES, (3 * k) % 20).alias("category"),
        F.concat(_pick(TITLE_PREFIXES, (q + k) % 8), _pick(TITLE_NOUNS, (q + 4 * k) % 13)).alias("job_title"),
        _pick(APPLY_WAYS, (q + k) % 6).alias("application_method"),
        posted.alias("post_date"),
        deadline.alias("deadline"),
        _series(k, 2, k % 6, CERT_POOL, "cert").alias("certifications"),
        F.when(k % 89 == 0, F.array().cast("array<string>"))
        .otherwise(_series(q + 5 * k, 7, F.lit(10), SKILL_POOL, "skill")).alias("skills_needed"),
        _pick(BOARDS, (q + 11 * k) % 20).alias("platform"),
        _pick(CONTRACTS, (q + k) % 7).alias("employment_type"),
        F.concat(F.lit("City"), (k % 30).cast("string")).alias("city"),
        F.when(k % 25 % 7 == 6, F.col("n_name"))
        .otherwise(_pick(COUNTRIES, (4 * (k % 25)) % len(COUNTRIES))).alias("country"),
        _pick(LANGUAGES, (q + k) % 6).alias("language"),
        _pick(PLACES, (q + 2 * k) % 3).alias("work_mode"),
        _pick(INDUSTRIES, (q + k) % 11).alias("industry"),
        _pick(vocab.LEVELS, level).alias("detailed_experience_level"),
        F.when(k % 50 == 0, 0.0)
        .otherwise((12000 + 5000 * ((q + 53 * k) % 40)).cast("double")).alias("salary"),
        _pick(EXPERIENCE_TEXTS, (q + 9 * k) % 12).alias("years_experience"),
        _start(k).alias("timestamp"),
        _region_continent(F.col("r_name")).alias("continent"),
    )


def _region_continent(region: Column) -> Column:
    out = None
    for name, continent in REGION_CONTINENT.items():
        out = F.when(region == name, continent) if out is None else out.when(region == name, continent)
    return out


def application_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications told by the event stream, for reports that need no match."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    event, user = F.col("event_id"), F.col("user_id")
    status = None
    for kind, name in EVENT_STATUS.items():
        hit = F.col("event_type") == kind
        status = F.when(hit, name) if status is None else status.when(hit, name)
    moment = F.col("ts").cast("timestamp")
    return events.select(
        F.concat(F.lit("app-"), event.cast("string")).alias("application_id"),
        F.concat(F.lit("cand-"), user.cast("string")).alias("candidate_id"),
        F.concat(F.lit("post-"), (event % 200).cast("string")).alias("post_id"),
        moment.alias("application_date"),
        F.least(F.lit(100), F.floor("value")).cast("int").alias("compatibility_score"),
        status.alias("status"),
        _pick(APPLY_WAYS, event % 6).alias("application_method"),
        moment.alias("timestamp"),
        F.when(event % 211 != 0, _pick(vocab.FAMILIES, user % 14)).alias("job_post_family_group"),
    )


#: the vocabulary of category number c lacks the last c % 5 skills and c % 3 certificates
SKILL_VOCABULARY = {
    category: [f"{word}_{i}" for i in range(SKILL_POOL - at % 5) for word in ("skill", "Skill")]
    for at, category in enumerate(vocab.CATEGORIES)
}
CERT_VOCABULARY = {
    category: [f"{word}_{i}" for i in range(CERT_POOL - at % 3) for word in ("cert", "Cert")]
    for at, category in enumerate(vocab.CATEGORIES)
}
