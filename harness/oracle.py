"""DuckDB twins of the registered queries, written from the rules and not from the Spark code."""

from __future__ import annotations

from harness import fixtures as fx
from talentgrid import vocab


def _q(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(map(_q, value)) + "]"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def _values(name: str, columns: str, rows) -> str:
    body = ", ".join("(" + ", ".join(map(_q, row)) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def _at(words, index: str) -> str:
    return f"({_q(list(words))})[({index}) + 1]"


def _series(first: str, step: int, count: str, pool: int, word: str) -> str:
    return (
        f"[(CASE WHEN i % 2 = 0 THEN '{word.capitalize()}' ELSE '{word}' END) || '_' "
        f"|| CAST((({first}) + i * {step}) % {pool} AS VARCHAR) FOR i IN range(0, CAST({count} AS BIGINT))]"
    )


def _case(pairs, otherwise: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {value}" for test, value in pairs) + f" ELSE {otherwise} END"


EPOCH = "TIMESTAMP '2024-01-01 00:00:00'"

# -- rules as SQL text ------------------------------------------------------


def _nums(text: str) -> str:
    return f"regexp_extract_all({text}, '[0-9]+')"


def _low(text: str) -> str:
    n = _nums(text)
    return (
        f"coalesce(CASE WHEN contains({text}, '+') THEN TRY_CAST({n}[1] AS INTEGER) "
        f"WHEN contains({text}, '-') AND len({n}) = 2 THEN TRY_CAST({n}[1] AS INTEGER) "
        f"WHEN len({n}) = 1 THEN TRY_CAST({n}[1] AS INTEGER) ELSE 0 END, 0)"
    )


def _high(text: str) -> str:
    n = _nums(text)
    return (
        f"coalesce(CASE WHEN contains({text}, '+') THEN TRY_CAST({n}[1] AS INTEGER) + 2 "
        f"WHEN contains({text}, '-') AND len({n}) = 2 THEN TRY_CAST({n}[2] AS INTEGER) "
        f"WHEN len({n}) = 1 THEN TRY_CAST({n}[1] AS INTEGER) ELSE 0 END, 0)"
    )


def _most(text: str) -> str:
    n = _nums(text)
    return (
        f"coalesce(CASE WHEN contains({text}, '+') THEN TRY_CAST({n}[1] AS INTEGER) + 2 "
        f"WHEN contains({text}, '-') THEN TRY_CAST(regexp_extract({text}, '-\\s*([0-9]+)(\\s|$)', 1) AS INTEGER) "
        f"ELSE TRY_CAST({n}[1] AS INTEGER) END, 0)"
    )


def _lane(text: str, lane: int = 0) -> str:
    return f"CAST('0x' || substr(md5({text}), {8 * lane + 1}, 8) AS BIGINT)"


def _seed(text: str, lane: int = 0) -> str:
    return f"({_lane(text, lane)} % 2147483628 + 1)"


def _whole(text: str, size: str) -> str:
    return f"(({_lane(text)} * ({size})) >> 32)"


def _first_in(text: str, table) -> list[tuple[str, str]]:
    return [(f"contains(lower({text}), {_q(key.lower())})", _q(value)) for key, value in table]


def _seniority(title: str) -> str:
    return _case(_first_in(title, vocab.TITLE_KEYWORDS.items()), _q(vocab.DEFAULT_LEVEL))


def _band(level: str) -> str:
    return _case(_first_in(level, [(name, name) for name in vocab.SALARY_BANDS]))


def _rank(level: str, aliases: bool = False) -> str:
    table = dict(vocab.SENIORITY_RANKS)
    if aliases:
        table |= {text: table[word] for text, word in vocab.RANK_ALIASES.items()}
    return _case([(f"lower({level}) = {_q(key)}", rank) for key, rank in table.items()], "3")


def _title_level(title: str, category: str, strict: bool) -> str:
    def has(*words):
        if strict:
            body = "|".join(word.replace(".", "\\.") for word in words)
            return f"regexp_matches(lower({title}), '(^|[^a-z0-9_])({body})([^a-z0-9_]|$)')"
        return "(" + " OR ".join(f"contains(lower({title}), {_q(word)})" for word in words) + ")"

    rules = [
        (has("chief", "cxo"), "'C-Level Executive (CXO)'"),
        (has("cfo", "cio", "cto", "cmo", "cco", "vp", "vice president", "director", "head"), "'Director/VP'"),
    ]
    rules += [(has(word), _q(level)) for word, level in vocab.TITLE_LEVEL_WORDS]
    rules += [(f"{has('developer')} AND NOT {has('junior', 'intern', 'entry')}", "'Mid Level'")]
    rules += [
        (has("junior"), "'Junior'"),
        (has("entry"), "'Entry Level'"),
        (has("intern", "graduate"), "'Internship'"),
    ]
    first = [(f"{category} = {_q(name)}", _q(allowed[0])) for name, allowed in vocab.ALLOWED_LEVELS.items()]
    return _case(rules, _case(first))


def _allowed(key: str, table, default=None) -> str:
    return _case([(f"{key} = {_q(name)}", _q(list(items))) for name, items in table.items()], _q(default))


def _years_texts(band: str) -> str:
    return _allowed(band, {level: vocab.YEARS_TEXTS[kind] for level, kind in vocab.LEVEL_YEARS_CLASS.items()})


def _employers(years: str, at: int) -> str:
    rules = [
        (f"{years} = 0" if row[0] == 0 else f"{years} <= {row[0]}", row[at])
        for row in vocab.EMPLOYER_RANGES
        if row[0] is not None
    ]
    return _case(rules, str(vocab.EMPLOYER_RANGES[-1][at]))


# -- fixture tables ---------------------------------------------------------

_TEXTS = fx.EXPERIENCE_TEXTS

CAND_BASE = f"""cand_base AS (
  SELECT c_custkey AS k, c_custkey // 20 AS q, n_name,
         CASE WHEN c_custkey % 103 <> 0 THEN {_at(_TEXTS, '(c_custkey // 20 + 5 * c_custkey) % 12')} END AS experience_range
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

CAND = f"""{CAND_BASE}, cand_years AS (
  SELECT *, CAST(2025 - ({_most("coalesce(experience_range, '')")} + k % 3)
                 - CASE WHEN k % 50 = 0 THEN 10 ELSE 0 END AS INTEGER) AS graduation_year
  FROM cand_base), cand AS (
  SELECT k, 'cand-' || k AS candidate_id,
    'Name ' || k AS name,
    {_at(['male', 'female'], 'k % 2')} AS gender,
    CAST(graduation_year - 22 - CASE WHEN k % 60 = 0 THEN 1 ELSE 0 END AS VARCHAR) AS date_of_birth,
    n_name AS nationality,
    'City' || (k % 30) || ', ' || n_name AS location,
    graduation_year,
    (20 + k % 21) / CAST(10 AS DOUBLE) AS gpa,
    {_at(vocab.EDUCATION_LEVELS, '(q + 3 * k) % 8')} AS education_level,
    {_at(vocab.CATEGORIES, '(7 * k) % 20')} AS job_category,
    {_at(fx.TITLE_PREFIXES, 'q % 8')} || {_at(fx.TITLE_NOUNS, '(q + 5 * k) % 13')} AS current_title,
    {_at(vocab.LEVELS, '(q + 3 * k) % 22')} AS seniority,
    experience_range,
    CASE WHEN (q + 3 * k) % 22 = 0 THEN '' ELSE 'company_' || (k % 40) END AS current_company,
    {_series('q + k', 3, 'k % 7', 40, 'company')} AS previous_companies,
    ['industry of ' || x FOR x IN {_series('q + k', 3, 'k % 7', 40, 'company')}] AS previous_industries,
    CASE WHEN k % 97 <> 0 THEN {_series('q + 3 * k', 7, '12', fx.SKILL_POOL, 'skill')} END AS skills,
    {_series('k', 2, 'k % 6', fx.CERT_POOL, 'cert')} AS certifications,
    CASE WHEN k % 101 <> 0 THEN CAST(12000 + 5000 * ((q + 37 * k) % 40) AS DOUBLE) END AS current_salary,
    {EPOCH} + to_minutes(CAST(k AS BIGINT)) AS "timestamp"
  FROM cand_years)"""

POST = f"""post_base AS (
  SELECT p_partkey AS k, p_partkey // 20 AS q, n_name, r_name
  FROM part JOIN nation ON p_partkey % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey), post AS (
  SELECT k, 'post-' || k AS post_id,
    'company_' || (k % 40) AS company,
    {_at(vocab.CATEGORIES, '(3 * k) % 20')} AS category,
    {_at(fx.TITLE_PREFIXES, '(q + k) % 8')} || {_at(fx.TITLE_NOUNS, '(q + 4 * k) % 13')} AS job_title,
    {_at(fx.APPLY_WAYS, '(q + k) % 6')} AS application_method,
    {EPOCH} + to_days(CAST(k % 365 AS INTEGER)) + to_seconds(k % 86400) AS post_date,
    {EPOCH} + to_days(CAST(k % 365 + CASE WHEN k % 40 = 0 THEN 40 ELSE 5 + k % 25 END AS INTEGER)) + to_seconds(k % 86400) AS deadline,
    {_series('k', 2, 'k % 6', fx.CERT_POOL, 'cert')} AS certifications,
    CASE WHEN k % 89 = 0 THEN CAST([] AS VARCHAR[]) ELSE {_series('q + 5 * k', 7, '10', fx.SKILL_POOL, 'skill')} END AS skills_needed,
    {_at(fx.BOARDS, '(q + 11 * k) % 20')} AS platform,
    {_at(fx.CONTRACTS, '(q + k) % 7')} AS employment_type,
    'City' || (k % 30) AS city,
    CASE WHEN k % 25 % 7 = 6 THEN n_name ELSE {_at(fx.COUNTRIES, f'(4 * (k % 25)) % {len(fx.COUNTRIES)}')} END AS country,
    {_at(fx.LANGUAGES, '(q + k) % 6')} AS language,
    {_at(fx.PLACES, '(q + 2 * k) % 3')} AS work_mode,
    {_at(fx.INDUSTRIES, '(q + k) % 11')} AS industry,
    {_at(vocab.LEVELS, '(q + 3 * k) % 22')} AS detailed_experience_level,
    CASE WHEN k % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(12000 + 5000 * ((q + 53 * k) % 40) AS DOUBLE) END AS salary,
    {_at(_TEXTS, '(q + 9 * k) % 12')} AS years_experience,
    {EPOCH} + to_minutes(CAST(k AS BIGINT)) AS "timestamp",
    {_case([(f'r_name = {_q(name)}', _q(continent)) for name, continent in fx.REGION_CONTINENT.items()])} AS continent
  FROM post_base)"""

APP = f"""app AS (
  SELECT 'app-' || event_id AS application_id, 'cand-' || user_id AS candidate_id,
    'post-' || (event_id % 200) AS post_id, CAST(ts AS TIMESTAMP) AS application_date,
    CAST(least(100, floor(value)) AS INTEGER) AS compatibility_score,
    {_case([(f'event_type = {_q(kind)}', _q(status)) for kind, status in fx.EVENT_STATUS.items()])} AS status,
    {_at(fx.APPLY_WAYS, 'event_id % 6')} AS application_method,
    CAST(ts AS TIMESTAMP) AS "timestamp",
    CASE WHEN event_id % 211 <> 0 THEN {_at(vocab.FAMILIES, 'user_id % 14')} END AS job_post_family_group
  FROM events)"""

FAMILY = _values(
    "family", "family_group, category",
    [(name, category) for name, members in vocab.FAMILY_CATEGORIES.items() for category in members],
)


def _pairs(aliases: bool = False, min_score: int = 30, where: str = "TRUE") -> str:
    def distinct(skills: str) -> str:
        return f"list_distinct([lower(s) FOR s IN coalesce({skills}, CAST([] AS VARCHAR[])) IF s IS NOT NULL])"

    return f"""{CAND}, {POST}, c_side AS (
  SELECT candidate_id, job_category AS category, {distinct('skills')} AS have, {_low('experience_range')} AS c_years,
         {_rank('seniority', aliases)} AS c_rank, lower(seniority) AS c_level,
         coalesce(current_salary, 0) AS c_salary, "timestamp" AS c_time
  FROM cand), p_side AS (
  SELECT post_id, category, {distinct('skills_needed')} AS need, {_low('years_experience')} AS p_years,
         {_rank('detailed_experience_level', aliases)} AS p_rank, lower(detailed_experience_level) AS p_level,
         coalesce(salary, 0) AS p_salary, post_date, deadline, application_method, "timestamp" AS p_time
  FROM post), common AS (
  SELECT *, list_sort(list_intersect(have, need)) AS shared
  FROM c_side JOIN p_side USING (category) WHERE {where}), parts AS (
  SELECT *, CAST(25 AS DOUBLE)
    + CASE WHEN len(need) > 0 THEN CAST(len(shared) AS DOUBLE) / CAST(len(need) AS DOUBLE) * 30 ELSE 0 END
    + CASE WHEN c_years >= p_years THEN 20 ELSE CAST(c_years AS DOUBLE) / CAST(greatest(1, p_years) AS DOUBLE) * 15 END
    + CASE WHEN c_rank >= p_rank THEN 15 ELSE CAST(c_rank AS DOUBLE) / CAST(greatest(1, p_rank) AS DOUBLE) * 10 END
    + CASE WHEN p_salary >= c_salary * CAST(1.2 AS DOUBLE) THEN 10 WHEN p_salary = c_salary THEN 8
           WHEN p_salary >= c_salary * CAST(0.9 AS DOUBLE) THEN 6 WHEN p_salary >= c_salary * CAST(0.7 AS DOUBLE) THEN 3 ELSE 0 END AS raw
  FROM common), scored AS (
  SELECT *, CAST(least(100, floor(raw + CAST(0.5 AS DOUBLE))) AS INTEGER) AS compatibility_score FROM parts), pair AS (
  SELECT *, {_reason()} AS match_reason FROM scored WHERE compatibility_score >= {min_score})"""


def _reason() -> str:
    texts = (
        "[CASE WHEN TRUE THEN 'Same career field' END, "
        "CASE WHEN len(shared) >= 3 THEN 'Strong skills match in ' || array_to_string(shared[1:3], ', ') END, "
        "CASE WHEN c_years >= p_years THEN 'Meets experience requirements' END, "
        "CASE WHEN c_level <> '' AND contains(p_level, c_level) THEN 'Appropriate seniority level' END]"
    )
    return f"array_to_string(([r FOR r IN {texts} IF r IS NOT NULL])[1:3], '; ')"


def _unit(lane: int) -> str:
    draw = f"(residue * {_seed('family_group', lane)}) % 2147483629"
    return f"(CAST({draw} AS DOUBLE) / CAST(2147483629 AS DOUBLE))"


def _chances(distinct: bool = False) -> str:
    families = "(SELECT min(family_group) AS family_group, category FROM family GROUP BY category)" if distinct else "family"
    return f"""{_pairs()}, {FAMILY}, drawn AS (
  SELECT *, ({_seed('candidate_id')} * {_seed('post_id')}) % 2147483647 AS residue,
    CASE WHEN compatibility_score >= 70 THEN CAST(0.8 AS DOUBLE) WHEN compatibility_score >= 50 THEN CAST(0.5 AS DOUBLE)
         WHEN compatibility_score >= 30 THEN CAST(0.2 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS apply_probability
  FROM pair JOIN {families} AS family USING (category)), chance AS (
  SELECT *, {_unit(0)} < apply_probability AS applies,
    CAST(trunc({_unit(1)} * date_diff('day', CAST(post_date AS DATE), CAST(deadline AS DATE))) AS INTEGER) AS day,
    CAST(trunc({_unit(2)} * 86400) AS BIGINT) AS second,
    {_unit(3)} AS status_draw,
    (residue * {_seed("family_group || '|id'")}) % 2147483629 % 1000000 AS digits
  FROM drawn)"""


def _applications(distinct: bool = False) -> str:
    def pick(words) -> str:
        return _at(words, "CAST(trunc(status_draw * 3) AS BIGINT)")

    return f"""{_chances(distinct)}, application AS (
  SELECT candidate_id || '_' || post_id || '_' || lpad(CAST(digits AS VARCHAR), 6, '0') AS application_id,
    candidate_id, post_id,
    CAST(CAST(post_date AS DATE) + day AS TIMESTAMP) + to_seconds(second) AS application_date,
    compatibility_score,
    CASE WHEN compatibility_score >= 80 AND day <= 7 THEN {pick(['Under Review', 'Interview Scheduled', 'Shortlisted'])}
         WHEN compatibility_score >= 60 THEN {pick(['Applied', 'Under Review', 'Shortlisted'])}
         ELSE {pick(['Applied', 'Under Review', 'Rejected'])} END AS status,
    application_method, match_reason, family_group AS job_post_family_group
  FROM chance WHERE applies)"""


_APPLICATION_ROWS = """SELECT application_id, candidate_id, post_id, CAST(application_date AS VARCHAR) AS application_date,
  compatibility_score, status, application_method, match_reason, job_post_family_group FROM application"""


def _conformity() -> str:
    def list_rules(category: str, skills: str):
        low = _case([(f"{category} = {_q(n)}", r[0]) for n, r in vocab.CERTIFICATE_RANGES.items()])
        high = _case([(f"{category} = {_q(n)}", r[1]) for n, r in vocab.CERTIFICATE_RANGES.items()])
        size = _case([(f"{category} = {_q(n)}", v) for n, v in vocab.SKILL_COUNTS.items()])
        known_skills = _allowed(category, fx.SKILL_VOCABULARY)
        known_certs = _allowed(category, fx.CERT_VOCABULARY)
        return {
            "certificate count in range": f"len(certifications) BETWEEN {low} AND {high}",
            "skill count exact": f"len({skills}) = {size}",
            "skills in vocabulary": f"CASE WHEN {skills} IS NOT NULL THEN list_has_all({known_skills}, {skills}) END",
            "certificates in vocabulary": f"list_has_all({known_certs}, certifications)",
        }

    def level_rules(level: str, salary: str, years: str):
        band = _band(level)
        low = _case([(f"{band} = {_q(n)}", b[0]) for n, b in vocab.SALARY_BANDS.items()], "0")
        high = _case([(f"{band} = {_q(n)}", b[1]) for n, b in vocab.SALARY_BANDS.items()], "0")
        return {
            "salary in band": f"{salary} BETWEEN {low} AND {high}",
            "years allowed for level": f"CASE WHEN {years} IS NOT NULL THEN list_contains({_years_texts(band)}, {years}) END",
        }

    text = "experience_range"
    since = f"(2025 - graduation_year - {_most(text)})"
    posts = {
        "deadline after posting": "date_diff('day', CAST(post_date AS DATE), CAST(deadline AS DATE)) BETWEEN 5 AND 29",
        **list_rules("category", "skills_needed"),
        **level_rules("detailed_experience_level", "salary", "years_experience"),
        "employment allowed for level": f"list_contains({_allowed(_seniority('job_title'), vocab.EMPLOYMENT_RULES, vocab.DEFAULT_EMPLOYMENT)}, employment_type)",
        "language allowed in country": f"list_contains({_allowed('country', vocab.COUNTRY_LANGUAGES)}, language)",
    }
    candidates = {
        **list_rules("job_category", "skills"),
        **level_rules("seniority", "current_salary", text),
        "employers in range": f"CASE WHEN {text} IS NOT NULL THEN len(previous_companies) BETWEEN {_employers(_most(text), 1)} AND {_employers(_most(text), 2)} END",
        "industry per employer": "len(previous_industries) = len(previous_companies)",
        "graduation fits experience": f"CASE WHEN {text} IS NOT NULL THEN {since} BETWEEN 0 AND 2 END",
        "birth fits graduation": "CAST(date_of_birth AS INTEGER) = graduation_year - 22",
        "employer unless intern": "(seniority = 'Internship') = (current_company = '')",
    }
    selects = [
        f"SELECT '{source}' AS source, {_q(rule)} AS rule, count(*) FILTER (WHERE {test}) AS passed, "
        f"count(*) FILTER (WHERE NOT ({test})) AS failed, count(*) FILTER (WHERE ({test}) IS NULL) AS \"unknown\" FROM {table}"
        for source, table, rules in (("job_posts", "post", posts), ("candidate_info", "cand", candidates))
        for rule, test in rules.items()
    ]
    return f"WITH {CAND}, {POST} " + " UNION ALL ".join(selects)


def _mix(base: str, group: str, member: str, observed: str, weights) -> str:
    return f"""WITH {base}, seen AS ({observed}), {_values('wanted', 'g, m, weight', weights)}, both_sides AS (
  SELECT coalesce(seen.g, wanted.g) AS g, coalesce(seen.m, wanted.m) AS m, coalesce(n, 0) AS n, coalesce(weight, 0) AS weight
  FROM seen FULL JOIN wanted ON seen.g = wanted.g AND seen.m = wanted.m), shares AS (
  SELECT g, m, n,
    coalesce(round(CAST(n AS DOUBLE) * 100 / nullif(sum(n) OVER (PARTITION BY g), 0), 2), 0) AS observed,
    coalesce(round(CAST(weight AS DOUBLE) * 100 / nullif(sum(weight) OVER (PARTITION BY g), 0), 2), 0) AS expected
  FROM both_sides)
SELECT g AS {group}, m AS {member}, CAST(n AS BIGINT) AS n, observed, expected, round(observed - expected, 2) AS difference FROM shares"""


def _counts(base: str, table: str, column: str, tail: str = "") -> str:
    return (
        f"WITH {base} SELECT {column}, count(*) AS n FROM {table} "
        f"WHERE {column} IS NOT NULL GROUP BY {column} {tail}"
    )


def _shares(base: str, table: str, column: str) -> str:
    return f"""WITH {base}, counted AS (SELECT {column}, count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {column})
SELECT {column}, n, round(CAST(n AS DOUBLE) * 100 / (SELECT sum(n) FROM counted), 2) AS percent FROM counted"""


_BAND = _at(vocab.TIME_BANDS, "hour(application_date) // 3")
_BANDS = f"""bands AS (SELECT CAST(hour(application_date) // 3 AS INTEGER) AS band, count(*) AS applications
  FROM app WHERE application_date IS NOT NULL GROUP BY ALL), labelled AS (
  SELECT band, {_at(vocab.TIME_BANDS, 'band')} AS time_interval, applications FROM bands)"""


def _tally(table: str, **keys: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{kpi}' AS kpi, CAST({key} AS VARCHAR) AS key, count(*) AS n FROM {table} "
        f"WHERE {key} IS NOT NULL GROUP BY {key}"
        for kpi, key in keys.items()
    )


def _app_tally(table: str) -> str:
    return _tally(
        table, applications="'all'", time_band=_BAND, job_family="job_post_family_group",
        score_bin="greatest(0, least(19, compatibility_score // 5))", status="status",
    )


_OTHER_TALLIES = (
    _tally("post", job_posts="'all'", work_mode="work_mode", employment_type="employment_type", country="country")
    + " UNION ALL " + _tally("cand", candidates="'all'", education_level="education_level")
)

_TOTALS = """SELECT (SELECT count(*) FROM app) AS total_applications, (SELECT round(avg(compatibility_score), 1) FROM app) AS avg_match_score,
  (SELECT count(*) FROM app WHERE status = 'Shortlisted') AS shortlisted,
  (SELECT count(*) FROM post) AS total_job_posts, (SELECT count(*) FROM cand) AS total_candidates"""


def _cards(score: str, listed: str) -> str:
    def grouped(number: str) -> str:
        return f"format('{{:,}}', CAST({number} AS BIGINT))"

    rows = [
        ("Total Applications", grouped("total_applications")),
        ("Active Job Posts", grouped("total_job_posts")),
        ("Active Candidates", grouped("total_candidates")),
        ("Avg Match Score", score),
        ("Shortlisted", grouped(listed)),
    ]
    return f"WITH {CAND}, {POST}, {APP}, t AS ({_TOTALS}) " + " UNION ALL ".join(
        f"SELECT '{name}' AS metric, {text} AS shown FROM t" for name, text in rows
    )


_RECENT = 'FROM app ORDER BY "timestamp" DESC, application_id LIMIT 100'


def _json_list(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NOT NULL THEN CASE WHEN len({column}) = 0 THEN '[]' "
        f"ELSE '[\"' || array_to_string({column}, '\",\"') || '\"]' END END"
    )


def _weight_ranges() -> str:
    rows = []
    for industry, weights in vocab.CONTINENT_WEIGHTS.items():
        for at, continent in enumerate(vocab.CONTINENTS):
            rows.append((industry, continent, sum(weights[:at]), sum(weights[: at + 1]), sum(weights)))
    return _values("ranges", "industry_key, drawn_continent, lo, hi, total", rows)


_NAMED_INDUSTRY = "CASE WHEN industry IN (" + ", ".join(
    _q(name) for name in vocab.CONTINENT_WEIGHTS if name != "default"
) + ") THEN industry ELSE 'default' END"

_AGE = "(2025 - CAST(date_of_birth AS INTEGER))"

ORACLES: dict[str, str] = {
    "match_scores": f"WITH {_pairs()} SELECT candidate_id, post_id, category, compatibility_score FROM pair",
    "match_scores_aliases": f"WITH {_pairs(aliases=True)} SELECT candidate_id, post_id, category, compatibility_score FROM pair",
    "match_within": "WITH " + _pairs(where="p_time BETWEEN c_time - INTERVAL 60 MINUTE AND c_time + INTERVAL 60 MINUTE")
    + " SELECT candidate_id, post_id, category, compatibility_score FROM pair",
    "match_at_70": f"WITH {_pairs(min_score=70)} SELECT candidate_id, post_id, category, compatibility_score FROM pair",
    "match_at_85": f"WITH {_pairs(min_score=85)} SELECT candidate_id, post_id, category, compatibility_score FROM pair",
    "match_reasons": f"WITH {_pairs()} SELECT candidate_id, post_id, match_reason FROM pair",
    "applications": f"WITH {_applications()} {_APPLICATION_ROWS}",
    "applications_distinct_pairs": f"WITH {_applications(distinct=True)} {_APPLICATION_ROWS}",
    "stream_match": f"WITH {_applications()} {_APPLICATION_ROWS}",
    "status_by_tier": f"""WITH {_applications()} SELECT CASE WHEN compatibility_score >= 80 THEN '80+'
  WHEN compatibility_score >= 60 THEN '60-79' ELSE 'below 60' END AS tier, status, count(*) AS n FROM application GROUP BY ALL""",
    "application_times": f"""WITH {_applications()} SELECT post_id, count(*) AS applications,
  CAST(min(application_date) AS VARCHAR) AS first_application, CAST(max(application_date) AS VARCHAR) AS last_application
  FROM application GROUP BY post_id""",
    "thinning_rate": f"""WITH {_chances()} SELECT apply_probability, CAST(count(*) AS BIGINT) AS pairs,
  CAST(count(*) FILTER (WHERE applies) AS BIGINT) AS applied FROM chance GROUP BY apply_probability""",
    "family_fanout": f"""WITH {CAND}, {POST}, {FAMILY}
SELECT 'candidate' AS side, family_group AS family, job_category AS category, count(*) AS n
FROM cand LEFT JOIN family ON job_category = family.category GROUP BY ALL
UNION ALL SELECT 'post', family_group, post.category, count(*) FROM post LEFT JOIN family ON post.category = family.category GROUP BY ALL""",
    "family_pairs": f"""WITH {CAND}, {POST}, {FAMILY}, c AS (
  SELECT family_group AS family, family.category, count(*) AS n FROM cand JOIN family ON job_category = family.category GROUP BY ALL), p AS (
  SELECT family_group AS family, family.category, count(*) AS n FROM post JOIN family ON post.category = family.category GROUP BY ALL), same AS (
  SELECT c.family, sum(c.n * p.n) AS pairs FROM c JOIN p ON c.family = p.family AND c.category = p.category GROUP BY c.family), cf AS (
  SELECT family, sum(n) AS n FROM c GROUP BY family), pf AS (SELECT family, sum(n) AS n FROM p GROUP BY family)
SELECT family, CAST(coalesce(cf.n, 0) AS BIGINT) AS candidates, CAST(coalesce(pf.n, 0) AS BIGINT) AS posts,
  CAST(coalesce(same.pairs, 0) AS BIGINT) AS same_category_pairs, CAST(coalesce(cf.n, 0) * coalesce(pf.n, 0) AS BIGINT) AS family_pairs
FROM cf FULL JOIN pf USING (family) LEFT JOIN same USING (family)""",
    "experience_parse": f"WITH {CAND} SELECT candidate_id, experience_range, {_low('experience_range')} AS min_years, {_high('experience_range')} AS max_years FROM cand",
    "max_years": f"WITH {POST} SELECT post_id, years_experience, {_most('years_experience')} AS most_years FROM post",
    "employer_range": f"""WITH {CAND}, y AS (SELECT candidate_id, {_most("coalesce(experience_range, '')")} AS years FROM cand)
SELECT candidate_id, {_employers('years', 1)} AS employers_min, {_employers('years', 2)} AS employers_max FROM y""",
    "seniority_from_title": f"WITH {CAND} SELECT candidate_id, current_title, {_seniority('current_title')} AS title_seniority FROM cand",
    "level_from_title": f"WITH {POST} SELECT post_id, job_title, {_title_level('job_title', 'category', False)} AS title_level FROM post",
    "level_from_title_strict": f"WITH {POST} SELECT post_id, job_title, {_title_level('job_title', 'category', True)} AS title_level FROM post",
    "seniority_rank": f"WITH {POST} SELECT post_id, {_rank('detailed_experience_level')} AS rank, {_rank('detailed_experience_level', True)} AS rank_with_aliases FROM post",
    "salary_band": f"""WITH {POST}, b AS (SELECT post_id, {_band('detailed_experience_level')} AS band FROM post), r AS (
  SELECT *, {_case([(f'band = {_q(n)}', v[0]) for n, v in vocab.SALARY_BANDS.items()], '0')} AS band_min,
  {_case([(f'band = {_q(n)}', v[1]) for n, v in vocab.SALARY_BANDS.items()], '0')} AS band_max FROM b)
SELECT post_id, band, band_min, band_max, CAST(band_min + {_whole("post_id || '|salary'", 'band_max - band_min + 1')} AS BIGINT) AS drawn_salary FROM r""",
    "years_allowed": f"""WITH {POST}, t AS (SELECT post_id, years_experience, {_years_texts(_band('detailed_experience_level'))} AS texts FROM post)
SELECT post_id, array_to_string(texts, '|') AS allowed_texts, list_contains(texts, years_experience) AS allowed FROM t""",
    "level_dimension_join": f"""WITH {POST}, {_values('bands', 'level, years_class, texts, min_salary, max_salary', [
        (level, vocab.LEVEL_YEARS_CLASS[level], len(vocab.YEARS_TEXTS[vocab.LEVEL_YEARS_CLASS[level]]), *band)
        for level, band in vocab.SALARY_BANDS.items()])}
SELECT detailed_experience_level AS level, years_class, CAST(texts AS BIGINT) AS texts, min_salary, max_salary, count(*) AS posts,
  count(*) FILTER (WHERE salary < min_salary) AS underpaid
FROM post LEFT JOIN bands ON detailed_experience_level = level GROUP BY ALL""",
    "location_split": f"WITH {CAND} SELECT candidate_id, trim(split_part(location, ',', 1)) AS city, trim(split_part(location, ',', 2)) AS country FROM cand",
    "employment_allowed": f"""WITH {POST} SELECT post_id, employment_type,
  list_contains({_allowed(_seniority('job_title'), vocab.EMPLOYMENT_RULES, vocab.DEFAULT_EMPLOYMENT)}, employment_type) AS employment_ok FROM post""",
    "language_allowed": f"""WITH {POST} SELECT post_id, country, language,
  list_contains({_allowed('country', vocab.COUNTRY_LANGUAGES)}, language) AS language_ok FROM post""",
    "derived_years": f"""WITH {CAND}, g AS (SELECT candidate_id,
  2025 - ({_most("coalesce(experience_range, '')")} + {_whole("candidate_id || '|graduation'", '3')}) AS year FROM cand)
SELECT candidate_id, CAST(year AS BIGINT) AS drawn_graduation, CAST(year - 22 AS BIGINT) AS drawn_birth FROM g""",
    "drawn_deadlines": f"""WITH {POST} SELECT post_id,
  CAST(post_date + to_days(CAST(5 + {_whole("post_id || '|deadline'", '25')} AS INTEGER)) AS VARCHAR) AS drawn_deadline FROM post""",
    "drawn_employment": f"""WITH {POST}, a AS (SELECT post_id,
  {_allowed(_seniority('job_title'), vocab.EMPLOYMENT_RULES, vocab.DEFAULT_EMPLOYMENT)} AS allowed FROM post)
SELECT post_id, allowed[{_whole("post_id || '|employment'", 'len(allowed)')} + 1] AS drawn_employment FROM a""",
    "keyed_ids": """WITH d AS (SELECT event_id, md5(event_id || '|' || event_type) AS h FROM events)
SELECT event_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS record_id FROM d""",
    "weighted_pick": f"""WITH {POST}, {_weight_ranges()}
SELECT post_id, industry, drawn_continent FROM post JOIN ranges ON industry_key = {_NAMED_INDUSTRY}
WHERE {_whole("post_id || '|continent'", 'total')} >= lo AND {_whole("post_id || '|continent'", 'total')} < hi""",
    "sample_without_repeats": f"""WITH {POST}, item AS (
  SELECT post_id, unnest(skills_needed) AS skill, unnest(range(0, len(skills_needed))) AS position FROM post), ranked AS (
  SELECT *, md5(post_id || '|skills_needed|' || position) AS draw, row_number() OVER (PARTITION BY post_id ORDER BY md5(post_id || '|skills_needed|' || position), skill) AS rn
  FROM item), four AS (SELECT post_id, string_agg(skill, '|' ORDER BY rn) AS sampled FROM ranked WHERE rn <= 4 GROUP BY post_id)
SELECT post.post_id, coalesce(sampled, '') AS sampled FROM post LEFT JOIN four ON post.post_id = four.post_id""",
    "education_mix": _mix(
        CAND, "age_band", "education_level",
        f"""SELECT CASE WHEN {_AGE} < 25 THEN 'under 25' WHEN {_AGE} < 35 THEN '25-34' WHEN {_AGE} < 50 THEN '35-49' ELSE '50 and over' END AS g,
  education_level AS m, count(*) AS n FROM cand GROUP BY ALL""",
        [(band, level, weight) for band, (_, row) in vocab.EDUCATION_WEIGHTS.items()
         for level, weight in zip(vocab.EDUCATION_LEVELS, row)],
    ),
    "continent_mix": _mix(
        POST, "industry", "continent",
        f"SELECT {_NAMED_INDUSTRY} AS g, continent AS m, count(*) AS n FROM post WHERE continent IS NOT NULL GROUP BY ALL",
        [(industry, continent, weight) for industry, row in vocab.CONTINENT_WEIGHTS.items()
         for continent, weight in zip(vocab.CONTINENTS, row)],
    ),
    "conformity_report": _conformity(),
    "kpi_totals": f"WITH {CAND}, {POST}, {APP} {_TOTALS}",
    "kpi_cards": _cards("printf('%.1f%%', avg_match_score)", "shortlisted"),
    "kpi_totals_missing_columns": _cards("'N/A'", "0"),
    "source_counts": f"""WITH {CAND}, {POST}, {APP} SELECT 'applications' AS source, count(*) AS rows FROM app
UNION ALL SELECT 'job_posts', count(*) FROM post UNION ALL SELECT 'candidates', count(*) FROM cand""",
    "kpi_report": f"WITH {CAND}, {POST}, {APP} {_app_tally('app')} UNION ALL {_OTHER_TALLIES}",
    "kpi_report_of_match": f"WITH {_applications()} {_app_tally('application')} UNION ALL {_OTHER_TALLIES}",
    "stream_kpi": f"WITH {APP} {_app_tally('app')}",
    "apps_by_3h": f"WITH {APP}, {_BANDS} SELECT * FROM labelled ORDER BY band",
    "peak_band": f"WITH {APP}, {_BANDS} SELECT * FROM labelled ORDER BY applications DESC, band LIMIT 1",
    "top_families": _counts(APP, "app", "job_post_family_group", "ORDER BY n DESC, job_post_family_group LIMIT 10"),
    "score_histogram": f"""WITH {APP}, b AS (SELECT CAST(greatest(0, least(19, compatibility_score // 5)) AS INTEGER) AS bin
  FROM app WHERE compatibility_score IS NOT NULL)
SELECT bin, bin * 5 AS bin_from, (bin + 1) * 5 AS bin_to, count(*) AS n FROM b GROUP BY bin""",
    "status_share": _shares(APP, "app", "status"),
    "score_box": f"""WITH {APP}, box AS (
  SELECT status, count(*) AS n, min(compatibility_score) AS lo, quantile_cont(compatibility_score, 0.25) AS q1,
    quantile_cont(compatibility_score, 0.5) AS median, quantile_cont(compatibility_score, 0.75) AS q3, max(compatibility_score) AS hi
  FROM app WHERE status IS NOT NULL AND compatibility_score IS NOT NULL GROUP BY status), j AS (
  SELECT box.*, compatibility_score AS s, compatibility_score BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM box JOIN app ON app.status = box.status WHERE compatibility_score IS NOT NULL)
SELECT status, n, lo AS min, round(q1, 3) AS q1, round(median, 3) AS median, round(q3, 3) AS q3, hi AS max,
  min(s) FILTER (WHERE inside) AS lower_whisker, max(s) FILTER (WHERE inside) AS upper_whisker, count(*) FILTER (WHERE NOT inside) AS outliers
FROM j GROUP BY ALL""",
    "work_mode_counts": _counts(POST, "post", "work_mode"),
    "employment_share": _shares(POST, "post", "employment_type"),
    "education_counts": _counts(CAND, "cand", "education_level"),
    "salary_histogram": f"""WITH {POST}, paid AS (SELECT salary FROM post WHERE salary > 0), r AS (
  SELECT min(salary) AS lo, max(salary) AS hi FROM paid), b AS (
  SELECT CAST(least(29, floor((salary - lo) / (hi - lo) * 30)) AS INTEGER) AS bin, lo, (hi - lo) / 30 AS width FROM paid CROSS JOIN r)
SELECT bin, round(lo + bin * width, 2) AS bin_from, round(lo + (bin + 1) * width, 2) AS bin_to, count(*) AS n FROM b GROUP BY ALL""",
    "top_countries": _counts(POST, "post", "country", "ORDER BY n DESC, country LIMIT 15"),
    "recent_applications": f"""WITH {APP} SELECT application_id, candidate_id, post_id, compatibility_score, status, application_method,
  CAST("timestamp" AS VARCHAR) AS "timestamp" {_RECENT}""",
    "recent_applications_missing_columns": f"""WITH {APP} SELECT application_id, candidate_id, post_id, compatibility_score,
  CAST("timestamp" AS VARCHAR) AS "timestamp" {_RECENT}""",
    "sorted_page": f"""WITH {APP} SELECT application_id, candidate_id, post_id, compatibility_score, status FROM app
ORDER BY compatibility_score DESC NULLS LAST, application_id LIMIT 50 OFFSET 100""",
    "page_count": f"WITH {APP} SELECT count(*) AS rows, CAST(greatest(1, ceil(count(*) / 25.0)) AS BIGINT) AS pages FROM app",
    "numbered_pages": f"""WITH {APP}, n AS (
  SELECT application_id, status, compatibility_score, row_number() OVER (ORDER BY status NULLS LAST, application_id) AS row FROM app)
SELECT *, CAST((row + 24) // 25 AS BIGINT) AS page FROM n""",
    "decode_json": """SELECT CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k, count(*) AS n,
  CAST(max(CAST(ts AS TIMESTAMP)) AS VARCHAR) AS latest FROM events GROUP BY 1""",
    "json_roundtrip": f"""WITH {CAND} SELECT candidate_id, name, gender, date_of_birth, nationality, location, graduation_year, gpa,
  education_level, job_category, current_title, seniority, experience_range, current_company,
  array_to_string(previous_companies, '|') AS previous_companies, array_to_string(previous_industries, '|') AS previous_industries,
  array_to_string(skills, '|') AS skills, array_to_string(certifications, '|') AS certifications, current_salary,
  CAST("timestamp" AS VARCHAR) AS "timestamp" FROM cand""",
    "table_load_dedup": """WITH incoming AS (SELECT 'cand-' || o_custkey AS candidate_id, o_orderkey AS delivery,
    CAST(o_orderdate AS TIMESTAMP) AS delivered, o_orderpriority AS source,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT candidate_id, delivery, CAST(delivered AS VARCHAR) AS delivered, source FROM incoming
WHERE rn = 1 AND candidate_id NOT IN (SELECT 'cand-' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "csv_export": f"""WITH {POST} SELECT post_id, company, category, job_title, application_method,
  CAST(post_date AS VARCHAR) AS post_date, CAST(deadline AS VARCHAR) AS deadline,
  {_json_list('certifications')} AS certifications, {_json_list('skills_needed')} AS skills_needed,
  platform, employment_type, city, country, language, work_mode, industry, detailed_experience_level,
  CAST(salary AS VARCHAR) AS salary, years_experience, CAST("timestamp" AS VARCHAR) AS "timestamp" FROM post""",
    "json_roundtrip_posts": f"""WITH {POST} SELECT post_id, company, category, job_title, application_method,
  CAST(post_date AS VARCHAR) AS post_date, CAST(deadline AS VARCHAR) AS deadline,
  array_to_string(certifications, '|') AS certifications, array_to_string(skills_needed, '|') AS skills_needed,
  platform, employment_type, city, country, language, work_mode, industry, detailed_experience_level,
  salary, years_experience, CAST("timestamp" AS VARCHAR) AS "timestamp" FROM post""",
    "topic_snapshot": f"""WITH {CAND}, firsts AS (SELECT k % 3 AS p, min(k) AS low FROM cand GROUP BY ALL), kept AS (
  SELECT p, k FROM cand JOIN firsts ON k % 3 = p WHERE k < low + 600), scans AS (SELECT unnest([1, 2]) AS scan)
SELECT CAST(scan AS INTEGER) AS scan, CAST(p AS INTEGER) AS partition, count(*) AS records, CAST(min(k) AS BIGINT) AS first, CAST(max(k) AS BIGINT) AS last
FROM kept CROSS JOIN scans GROUP BY ALL""",
    "rejected_records": f"""WITH {CAND}, told AS (SELECT k, CASE WHEN k % 11 = 0 THEN 'no object' WHEN k % 13 = 0 THEN 'unfit field'
  WHEN k % 17 = 0 THEN 'no object' WHEN k % 19 = 0 THEN 'no value' END AS reason FROM cand)
SELECT CASE WHEN reason IS NULL OR reason = 'unfit field' THEN 'row' ELSE 'row of NULLs' END AS outcome, count(*) AS records,
  CAST(NULL AS BIGINT) AS offsets FROM told GROUP BY ALL
UNION ALL SELECT reason, count(*), CAST(sum(k) AS BIGINT) FROM told WHERE reason IS NOT NULL GROUP BY ALL""",
    "processing_time": f"WITH {_applications()} SELECT CAST(1 AS BIGINT) AS times, count(*) AS applications FROM application",
    "table_definition": f"WITH {POST} SELECT post_id, category, salary, len(skills_needed) AS skills FROM post",
    "page_by_index": f"""WITH {APP}, placed AS (SELECT *, row_number() OVER (ORDER BY compatibility_score DESC NULLS LAST, application_id) AS row FROM app)
SELECT application_id, compatibility_score, status, row FROM placed
WHERE (row - 1) // 50 IN (2, ((SELECT count(*) FROM app) - 1) // 50)""",
    "stream_indicators": f"""WITH {APP}, {_BANDS}, s AS (SELECT status, CAST(compatibility_score AS INTEGER) AS s FROM app), box AS (
  SELECT status, count(*) AS n, min(s) AS lo, quantile_cont(s, 0.25) AS q1, quantile_cont(s, 0.5) AS median, quantile_cont(s, 0.75) AS q3,
    max(s) AS hi FROM s WHERE status IS NOT NULL AND s IS NOT NULL GROUP BY status), j AS (
  SELECT box.*, s, s BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM box JOIN s USING (status) WHERE s IS NOT NULL), boxes AS (
  SELECT status, n, lo, q1, median, q3, hi, min(s) FILTER (WHERE inside) AS lw, max(s) FILTER (WHERE inside) AS uw,
    count(*) FILTER (WHERE NOT inside) AS outliers FROM j GROUP BY ALL), shares AS (
  SELECT status, count(*) AS n FROM app WHERE status IS NOT NULL GROUP BY status)
SELECT 'total_applications' AS indicator, 'all' AS key, count(*) AS n, CAST(NULL AS DOUBLE) AS value FROM app
UNION ALL SELECT 'avg_match_score', 'all', NULL, round(avg(s), 1) FROM s
UNION ALL SELECT 'shortlisted', 'all', count(*) FILTER (WHERE status = 'Shortlisted'), NULL FROM app
UNION ALL SELECT 'time_band', time_interval, applications, NULL FROM labelled
UNION ALL SELECT * FROM (SELECT 'peak_band', time_interval, applications, NULL FROM labelled ORDER BY applications DESC, band LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'job_family', job_post_family_group, count(*) AS n, NULL FROM app
  WHERE job_post_family_group IS NOT NULL GROUP BY ALL ORDER BY n DESC, job_post_family_group LIMIT 10)
UNION ALL SELECT 'score_bin', CAST(greatest(0, least(19, s // 5)) AS VARCHAR), count(*), NULL FROM s WHERE s IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'status', status, n, round(n * 100.0 / (SELECT sum(n) FROM shares), 2) FROM shares
UNION ALL SELECT 'score_n', status, NULL, n FROM boxes UNION ALL SELECT 'score_min', status, NULL, lo FROM boxes
UNION ALL SELECT 'score_q1', status, NULL, round(q1, 3) FROM boxes UNION ALL SELECT 'score_median', status, NULL, round(median, 3) FROM boxes
UNION ALL SELECT 'score_q3', status, NULL, round(q3, 3) FROM boxes UNION ALL SELECT 'score_max', status, NULL, hi FROM boxes
UNION ALL SELECT 'score_lower_whisker', status, NULL, lw FROM boxes UNION ALL SELECT 'score_upper_whisker', status, NULL, uw FROM boxes
UNION ALL SELECT 'score_outliers', status, NULL, outliers FROM boxes""",
    "stream_table_load": f"""WITH {CAND} SELECT candidate_id, name, seniority, CAST("timestamp" AS VARCHAR) AS "timestamp",
  3 * (SELECT count(*) FROM cand) AS delivered FROM cand""",
}
