"""DuckDB SQL with the result each query must have."""

from __future__ import annotations

from cohort.checks.fixtures import LABELLED, POPULATION, RAW_POPULATION, SCORED, WIDE

TARGET = "has_health_issues"

# Columns of the population table, by kind.
NUMERIC = (
    "annual_income_usd", "smokes_per_day", "drinks_per_week", "children_count",
    "attempts_to_quit_smoking", "attempts_to_quit_drinking", "sleep_hours", "bmi",
    "social_support", "years_smoking", "pack_years", "heavy_smoker_flag",
    "heavy_drinker_flag", "bmi_obese_flag", "sleep_deficit", "diet_score",
    "exercise_score", "mh_score", "poly_use",
)
CATEGORIES = {
    "gender": ("female", "male"),
    "education_level": ("automobile", "building", "furniture", "household", "machinery"),
    "employment_status": ("1-urgent", "2-high", "3-medium", "4-not specified", "5-low"),
    "marital_status": ("f", "o", "p"),
    "mental_health_status": ("good", "moderate", "poor"),
    "therapy_history": ("current", "none", "past"),
}
ALL_COLUMNS = (
    "id", "name", "annual_income_usd", "smokes_per_day", "drinks_per_week",
    "children_count", "attempts_to_quit_smoking", "attempts_to_quit_drinking",
    "sleep_hours", "bmi", "social_support", "smoking_rate_pct", "gender",
    "education_level", "employment_status", "marital_status",
    "mental_health_status", "therapy_history", "years_smoking", "pack_years",
    "heavy_smoker_flag", "heavy_drinker_flag", "bmi_obese_flag", "sleep_deficit",
    "diet_score", "exercise_score", "mh_score", "poly_use", TARGET,
)


def r6(x: str) -> str:
    return (
        f"(case when abs({x}) < 1e12::double "
        f"then floor(({x}) * 1e6::double + 0.5::double) / 1e6::double else {x} end)"
    )


def _with(*parts: tuple[str, str]) -> str:
    return "with " + ",\n".join(f"{name} as ({sql})" for name, sql in parts) + "\n"


_POPULATION = ("population", POPULATION)
_RAW = ("raw_population", RAW_POPULATION)
_NORMAL = (
    "normal",
    'select "ID" as id, " Annual  Income USD " as annual_income_usd, "Gender" as gender, '
    '"Education Level" as education_level, "Has Health Issues" as has_health_issues '
    "from raw_population",
)


def on_population(sql: str, *more: tuple[str, str]) -> str:
    return _with(_POPULATION, *more) + sql


def on_raw(sql: str, *more: tuple[str, str]) -> str:
    return _with(_POPULATION, _RAW, _NORMAL, *more) + sql


def _number(x: str) -> str:
    pattern = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return (
        f"case when regexp_full_match(trim({x}), '{pattern}') "
        f"then try_cast(trim({x}) as double) end"
    )


def _token(x: str) -> str:
    return f"nullif(lower(trim({x})), '')"


_CLEAN = (
    "clean",
    f"select distinct id, {_number('annual_income_usd')} as annual_income_usd, "
    f"{_token('gender')} as gender, {_token('education_level')} as education_level, "
    "has_health_issues from normal",
)

INCOME_BAND = """case
  when annual_income_usd <= 25000 then '<25k' when annual_income_usd <= 50000 then '25–50k'
  when annual_income_usd <= 75000 then '50–75k' when annual_income_usd <= 100000 then '75–100k'
  when annual_income_usd <= 150000 then '100–150k' when annual_income_usd > 150000 then '150k+' end"""


def _smoke(low: str) -> str:
    return f"""case when smokes_per_day {low} 0 then null when smokes_per_day <= 1 then 'none'
  when smokes_per_day <= 5 then 'ultra' when smokes_per_day <= 10 then 'light'
  when smokes_per_day <= 20 then 'med' when smokes_per_day > 20 then 'heavy' end"""


def _drink(low: str) -> str:
    return f"""case when drinks_per_week {low} 0 then null when drinks_per_week <= 1 then 'none'
  when drinks_per_week <= 7 then 'very_low' when drinks_per_week <= 14 then 'low'
  when drinks_per_week <= 28 then 'mod' when drinks_per_week > 28 then 'high' end"""


LOG_INCOME = "ln(1 + annual_income_usd)"
_INCOME_STATS = (
    "income_stats",
    "select avg(annual_income_usd) as mu, stddev_samp(annual_income_usd) as sd, "
    "quantile_cont(annual_income_usd, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]) as edges "
    "from population",
)
INCOME_Z = "(annual_income_usd - mu) / case when coalesce(sd, 0) = 0 then 1 else sd end"
INCOME_DECILE = """case when annual_income_usd is not null and len(list_distinct(edges)) >= 2 then
  cast(len(list_filter(list_distinct(edges), lambda e:
    e > list_min(edges) and e < list_max(edges) and e < annual_income_usd)) as integer) end"""
RATIO = "(coalesce(children_count, 0) + 1) / (coalesce(annual_income_usd, 0) + 1) * 1e6"
QUIT_SMOKE = "coalesce(attempts_to_quit_smoking, 0) / (coalesce(smokes_per_day, 0) + 1)"
QUIT_DRINK = "coalesce(attempts_to_quit_drinking, 0) / (coalesce(drinks_per_week, 0) + 1)"
POLY = "cast(coalesce(smokes_per_day >= 20 and drinks_per_week >= 14, false) as integer)"
RISKS = " + ".join(
    f"cast(coalesce({p}, false) as integer)"
    for p in (
        "heavy_smoker_flag > 0", "heavy_drinker_flag > 0", "bmi_obese_flag > 0",
        "sleep_deficit > 1", "diet_score <= 1", "exercise_score <= 1", "mh_score >= 1",
        "poly_use > 0",
    )
)
PACK_LOG, PACK_SQRT = "ln(1 + pack_years)", "sqrt(pack_years)"
YEARS_HEAVY = "years_smoking * cast(coalesce(heavy_smoker_flag > 0, false) as integer)"


def _modes(name: str, source: str, value: str, keys: tuple[str, ...]) -> list[tuple[str, str]]:
    """CTEs ``<name>_group`` (keys, mode) and ``<name>_all`` (mode)."""
    by = ", ".join(keys)
    present = " and ".join(f"{k} is not null" for k in (*keys, value))
    return [
        (
            f"{name}_group",
            f"select {by}, {value} as mode from (select {by}, {value}, row_number() over "
            f"(partition by {by} order by count(*) desc, {value}) as rk from {source} "
            f"where {present} group by {by}, {value}) where rk = 1",
        ),
        (
            f"{name}_all",
            f"select {value} as mode from {source} where {value} is not null "
            f"group by {value} order by count(*) desc, {value} limit 1",
        ),
    ]


def _fill(name: str, source: str, value: str, keys: tuple[str, ...]) -> list[tuple[str, str]]:
    """The mode CTEs and ``<name>``: the source with its value filled."""
    on = " and ".join(f"s.{k} = g.{k}" for k in keys)
    return [
        *_modes(name, source, value, keys),
        (
            name,
            f"select s.* replace (coalesce(s.{value}, g.mode, "
            f"(select mode from {name}_all)) as {value}) "
            f"from {source} s left join {name}_group g on {on}",
        ),
    ]


_BANDED = ("banded", f"select *, {INCOME_BAND} as income_band from population")
_SOCIAL = ("marital_status", "children_count")
_EDUCATION = ("employment_status", "income_band")
_THERAPY = ("education_level", "marital_status", "mental_health_status")


def _split(source: str, key: str, label: str | None) -> list[tuple[str, str]]:
    """CTE ``marked``: key, label and side of every row."""
    group = label or "cast(null as integer)"
    return [
        (
            "draws",
            f"select *, {group} as grp, md5('42:' || cast({key} as varchar)) as draw from {source}",
        ),
        ("sizes", "select grp, count(*) as n from draws group by grp"),
        (
            "totals",
            "select sum(n) as total, sum(n) - ceil(sum(n) * cast(0.2 as double)) as n_train from sizes",
        ),
        (
            "exact",
            "select grp, n, n_train, n_train * n / total as share from sizes, totals",
        ),
        (
            "quotas",
            "select grp, n - floor(share) - case when row_number() over "
            "(order by share - floor(share) desc, cast(grp as varchar)) <= "
            "n_train - sum(floor(share)) over () then 1 else 0 end as n_test from exact",
        ),
        (
            "marked",
            "select d.*, case when row_number() over (partition by d.grp order by d.draw) "
            "<= q.n_test then 'test' else 'train' end as split "
            "from draws d join quotas q on d.grp is not distinct from q.grp",
        ),
    ]


def _scaled(column: str, source: str = "population") -> str:
    filled = f"coalesce({column}, (select median({column}) from {source}))"
    stats = f"(select {{}}({filled}) from {source})"
    mean, sd = stats.format("avg"), stats.format("stddev_pop")
    return f"({filled} - {mean}) / case when {sd} = 0 then 1 else {sd} end"


def _top(column: str, source: str = "population") -> str:
    return (
        f"(select {column} from {source} where {column} is not null "
        f"group by {column} order by count(*) desc, {column} limit 1)"
    )


def _filled(column: str) -> str:
    return f"coalesce({column}, {_top(column)})"


def _scaling_stats(columns: tuple[str, ...]) -> list[tuple[str, str]]:
    """Medians, then mean and deviation of each filled column, as CTEs."""
    medians = ", ".join(f"median({c}) as md_{c}" for c in columns)
    filled = ", ".join(f"coalesce({c}, md_{c}) as f_{c}" for c in columns)
    moments = ", ".join(f"avg(f_{c}) as mu_{c}, stddev_pop(f_{c}) as sd_{c}" for c in columns)
    return [
        ("medians", f"select {medians} from population"),
        ("filled", f"select population.*, {filled} from population, medians"),
        ("moments", f"select {moments} from filled"),
    ]


def _standard(column: str) -> str:
    return (
        f"(f_{column} - mu_{column}) / case when sd_{column} = 0 then 1 else sd_{column} end"
    )


def _matrix() -> list[tuple[str, str]]:
    numbers = [f'{r6(_standard(c))} as "{c}"' for c in NUMERIC]
    hots = [
        f"cast({_filled(c)} = '{v}' as double) as \"{c}_{v}\""
        for c, values in CATEGORIES.items()
        for v in values
    ]
    columns = ", ".join(
        [
            "id", *numbers, 'cast(0 as double) as "smoking_rate_pct"', *hots,
            'cast(1 as double) as "referral_source_missing"',
        ]
    )
    return [*_scaling_stats(NUMERIC), ("matrix", f"select {columns} from filled, moments")]


MATRIX_COLUMNS = (
    *NUMERIC, "smoking_rate_pct",
    *[f"{c}_{v}" for c, values in CATEGORIES.items() for v in values],
    "referral_source_missing",
)


def _null_rows(columns: tuple[str, ...], source: str, extra: str = "") -> str:
    return " union all ".join(
        f"select '{c}' as \"column\"{extra}, count(\"{c}\") as non_null, "
        f'count(*) - count("{c}") as nulls, count(*) as n_all from {source}'
        for c in columns
    )


def _dtype(column: str) -> str:
    if column == "id":
        return "bigint"
    if column == TARGET:
        return "int"
    return "string" if column == "name" or column in CATEGORIES else "double"


_PROFILE = (
    "profile",
    " union all ".join(
        f"select '{c}' as \"column\", '{_dtype(c)}' as dtype, count(\"{c}\") as non_null, "
        f'count(*) - count("{c}") as nulls, count(*) as n_all from population'
        for c in ALL_COLUMNS
    ),
)

# Features in running order with their inputs.
CATALOG = (
    (0, "basic_cleanup", ()),
    (10, "income_features", ("annual_income_usd",)),
    (20, "smoke_intensity", ("smokes_per_day",)),
    (20, "drink_intensity", ("drinks_per_week",)),
    (30, "ratios_dependents", ("annual_income_usd", "children_count")),
    (30, "quit_effort_smoke_norm", ("attempts_to_quit_smoking", "smokes_per_day")),
    (30, "quit_effort_drink_norm", ("attempts_to_quit_drinking", "drinks_per_week")),
    (40, "impute_social_support", ("children_count", "marital_status", "social_support")),
    (40, "impute_education_level", ("education_level", "employment_status", "income_band")),
    (
        40, "impute_therapy_history",
        ("education_level", "marital_status", "mental_health_status", "therapy_history"),
    ),
    (65, "heavy_poly_use", ("drinks_per_week", "smokes_per_day")),
    (66, "pack_years_transforms", ("pack_years",)),
    (67, "alcohol_transforms", ("drinks_per_week",)),
    (
        68, "risk_burden",
        ("bmi_obese_flag", "diet_score", "exercise_score", "heavy_drinker_flag",
         "heavy_smoker_flag", "mh_score", "poly_use", "sleep_deficit"),
    ),
    (70, "duration_intensity_interactions", ("heavy_smoker_flag", "smokes_per_day", "years_smoking")),
)


def _catalog() -> str:
    rows = []
    for order, name, requires in CATALOG:
        # income_band is not among the given columns, so no row has it.
        present = " and ".join(
            f"{c} is not null" if c != "income_band" else "false" for c in requires
        )
        rows.append(
            f"select {order} as \"order\", '{name}' as name, 'ENABLED' as status, "
            f"'{','.join(requires)}' as requires, "
            f"count(*) filter (where {present or 'true'}) as complete_rows from population"
        )
    return " union all ".join(rows)


def _wide_correlations() -> str:
    columns = [*WIDE, *[f"{c}_sq" for c in WIDE]]
    value = {c: c for c in WIDE} | {f"{c}_sq": f"({c} * {c})" for c in WIDE}
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    lists = (
        ", ".join(f"'{a}'" for a, _ in pairs), ", ".join(f"'{b}'" for _, b in pairs),
        ", ".join(r6(f"corr({value[a]}, {value[b]})") for a, b in pairs),
    )
    x, y, corr = (f"unnest([{part}])" for part in lists)
    return f"select {x} as x, {y} as y, {corr} as corr from population"


def _correlations() -> str:
    columns = ["annual_income_usd", "smokes_per_day", "bmi", "sleep_hours"]
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    return " union all ".join(
        f"select '{a}' as x, '{b}' as y, {r6(f'corr({a}, {b})')} as corr from population"
        for a, b in pairs
    )


_SCORED = ("scored", SCORED)
_CELLS = (
    "cells",
    "select count(*) filter (where label = 0 and pred = 0) as tn, "
    "count(*) filter (where label = 0 and pred = 1) as fp, "
    "count(*) filter (where label = 1 and pred = 0) as fn, "
    "count(*) filter (where label = 1 and pred = 1) as tp from scored",
)


def on_scored(sql: str, *more: tuple[str, str]) -> str:
    return _with(_POPULATION, _SCORED, *more) + sql


def _share(part: str, whole: str) -> str:
    return f"case when {whole} = 0 then 0 else cast({part} as double) / ({whole}) end"


_DERIVED_SQL = f"""select id, income_band,
  {r6(LOG_INCOME)} as log_income, {r6(INCOME_Z)} as income_z, {INCOME_DECILE} as income_decile,
  {_smoke('<')} as smoke_intensity, {_drink('<')} as drink_intensity,
  {r6(RATIO)} as ratio_ppm,
  {r6(QUIT_SMOKE)} as quit_effort_smoke_norm, {r6(QUIT_DRINK)} as quit_effort_drink_norm,
  social_support, education_level, therapy_history, {POLY} as heavy_poly_use,
  {r6(PACK_LOG)} as pack_years_log, {r6(PACK_SQRT)} as pack_years_sqrt,
  {r6('pack_years * pack_years')} as pack_years_sq,
  {r6('drinks_per_week / 7')} as drink_per_day,
  {r6('(drinks_per_week / 7) * (drinks_per_week / 7)')} as drink_per_day_sq,
  {r6('ln(1 + drinks_per_week)')} as drinks_per_week_log,
  {RISKS} as risk_factor_count, cast(({RISKS}) >= 2 as integer) as elevated_risk_flag,
  {r6(YEARS_HEAVY)} as years_smoking_x_heavy,
  {r6('years_smoking * smokes_per_day')} as years_smoking_x_spd
from therapy, income_stats"""

_FEATURE_TABLE = (
    _INCOME_STATS,
    _BANDED,
    *_fill("social", "banded", "social_support", _SOCIAL),
    *_fill("education", "social", "education_level", _EDUCATION),
    *_fill("therapy", "education", "therapy_history", _THERAPY),
)
_FOREST_NUMBERS = (
    *NUMERIC, "smoking_rate_pct", "log_income", "income_z", "income_decile", "dependents_ratio",
    "quit_effort_smoke_norm", "quit_effort_drink_norm", "heavy_poly_use", "pack_years_log",
    "pack_years_sqrt", "pack_years_sq", "drink_per_day", "drink_per_day_sq", "drinks_per_week_log",
    "risk_factor_count", "elevated_risk_flag", "years_smoking_x_heavy", "years_smoking_x_spd",
)


def _forest_names() -> str:
    """Numeric features by name, text features by name and value."""
    parts = [f"select '{c}' as feature" for c in _FOREST_NUMBERS]
    texts = {c: c for c in (*CATEGORIES, "income_band")}
    texts |= {"smoke_intensity": _smoke("<"), "drink_intensity": _drink("<")}
    for name, value in texts.items():
        parts.append(
            f"select distinct '{name}_' || ({value}) as feature from therapy where ({value}) is not null"
        )
    return " union all ".join(parts)


def _missing_gives_null(name: str) -> str:
    """No value as soon as one score is missing."""
    return f"select case when count(*) filter (where id % 50 = 0) = 0 then 0::double end as {name} from scored"


_SMOKER = "cast(heavy_smoker_flag > 0 as integer)"

ORACLES: dict[str, str] = {
    "csv_source": on_raw(
        "select cast(id as bigint) as id_number, nullif(annual_income_usd, '') as income_text, "
        "nullif(gender, '') as gender, nullif(education_level, '') as education_level, "
        "cast(has_health_issues as bigint) as has_health_issues from normal"
    ),
    "normalize_names": on_raw("select * from normal"),
    "coerce_numeric": on_raw(
        f"select id, {_number('annual_income_usd')} as annual_income_usd from normal"
    ),
    "standardize_strings": on_raw(
        f"select id, {_token('gender')} as gender, "
        f"{_token('education_level')} as education_level from normal"
    ),
    "dedup": on_raw("select distinct * from normal"),
    "dedup_count": on_raw(
        "select (select count(*) from normal) as rows_before, "
        "count(*) as rows_after, (select count(*) from normal) - count(*) as dropped "
        "from (select distinct * from normal)"
    ),
    "ensure_id": on_population(
        "select row_number() over (order by name, id) as id, id as person, name, "
        "annual_income_usd, gender from population"
    ),
    "row_id": on_raw(
        "select row_number() over (order by id, annual_income_usd nulls last, gender nulls last, "
        "education_level nulls last, has_health_issues) - 1 as row_id, * from normal"
    ),
    "basic_cleanup": on_raw("select * from clean", _CLEAN),
    "drop_pii": on_population("select * exclude (id, name) from population"),
    "drop_target_cols": on_population(f"select * exclude ({TARGET}) from population"),
    "drop_target": on_population(f"select * exclude ({TARGET}) from population"),
    "infer_columns": on_population(
        "select \"column\", case when dtype = 'string' then 'categorical' else 'numeric' end "
        "as kind, non_null from profile",
        _PROFILE,
    ),
    "all_null_columns": on_population(
        'select "column" from profile where non_null = 0', _PROFILE
    ),
    "to01": on_population(
        f"select id, cast({TARGET} = 1 as integer) as from_bool, {TARGET} as from_int from population"
    ),
    "head_n": on_population(
        "select id, name, annual_income_usd from population "
        "order by annual_income_usd nulls first, id limit 10"
    ),
    "schema_profile": on_population(
        'select "column", dtype, non_null, nulls, '
        "round_even(nulls / n_all * 100, 2) as null_pct from profile",
        _PROFILE,
    ),
    "table_shape": on_population(
        f"select count(*) as n_rows, cast({len(ALL_COLUMNS)} as bigint) as n_columns from population"
    ),
    "columns_with_nulls": on_population(
        'select "column" from profile where nulls > 0', _PROFILE
    ),
    "top_missing": on_population(
        'select "column", nulls from profile order by nulls desc, "column" limit 10', _PROFILE
    ),
    "income_summary": on_population(
        "select " + ", ".join(
            f"{r6(f'{function}(annual_income_usd)')} as {name}"
            for function, name in (
                ("min", "min"), ("max", "max"), ("median", "median"), ("avg", "mean"),
                ("stddev_samp", "std"),
            )
        ) + " from population"
    ),
    "target_counts": on_population(
        f"select {TARGET}, count(*) as count from population group by 1"
    ),
    "value_counts_with_missing": on_population(
        "select marital_status, count(*) as count from population group by 1"
    ),
    "corr_matrix": on_population(_correlations()),
    "corr_matrix_wide": on_population(_wide_correlations()),
    "histogram_infinite": on_population(
        f"select b.bin, {r6('lo + b.bin * w')} as \"left\", {r6('lo + (b.bin + 1) * w')} as \"right\", "
        "(select count(*) from finite where least(floor((income - lo) / w), 9) = b.bin) as count "
        "from (select cast(range as integer) as bin from range(10)) b, bounds "
        "union all select cast(-1 as integer), '-infinity'::double, '-infinity'::double, count(*) "
        "from incomes where income = '-infinity'::double having count(*) > 0 "
        "union all select cast(10 as integer), 'infinity'::double, 'infinity'::double, count(*) "
        "from incomes where income = 'infinity'::double having count(*) > 0",
        (
            "incomes",
            "select case when id % 50 = 0 then 'infinity'::double when id % 70 = 1 then '-infinity'::double "
            "else annual_income_usd end as income from population",
        ),
        ("finite", "select income from incomes where isfinite(income)"),
        ("bounds", "select min(income) as lo, (max(income) - min(income)) / 10 as w from finite"),
    ),
    "histogram": on_population(
        f"select b.bin, {r6('lo + b.bin * w')} as \"left\", {r6('lo + (b.bin + 1) * w')} as \"right\", "
        "(select count(*) from population where annual_income_usd is not null and "
        "least(floor((annual_income_usd - lo) / w), 9) = b.bin) as count "
        "from (select cast(range as integer) as bin from range(10)) b, "
        "(select min(annual_income_usd) as lo, "
        "(max(annual_income_usd) - min(annual_income_usd)) / 10 as w from population)"
    ),
    "income_band": on_population(f"select id, {INCOME_BAND} as income_band from population"),
    "log_income": on_population(f"select id, {r6(LOG_INCOME)} as log_income from population"),
    "income_z": on_population(
        f"select id, {r6(INCOME_Z)} as income_z from population, income_stats", _INCOME_STATS
    ),
    "income_decile": on_population(
        f"select id, {INCOME_DECILE} as income_decile from population, income_stats",
        _INCOME_STATS,
    ),
    "smoke_intensity": on_population(
        f"select id, {_smoke('<')} as smoke_intensity, {_smoke('<=')} as open_lowest from population"
    ),
    "drink_intensity": on_population(
        f"select id, {_drink('<')} as drink_intensity, {_drink('<=')} as open_lowest from population"
    ),
    "dependents_ratio": on_population(
        f"select id, {r6(RATIO)} as ratio_ppm, "
        f"{r6('(children_count + 1) / (annual_income_usd + 1) * 1e6')} as unfilled_ppm from population"
    ),
    "quit_effort_smoke": on_population(
        f"select id, {r6(QUIT_SMOKE)} as quit_effort_smoke_norm, "
        f"{r6('attempts_to_quit_smoking / (smokes_per_day + 1)')} as unfilled from population"
    ),
    "quit_effort_drink": on_population(
        f"select id, {r6(QUIT_DRINK)} as quit_effort_drink_norm, "
        f"{r6('attempts_to_quit_drinking / (drinks_per_week + 1)')} as unfilled from population"
    ),
    "heavy_poly_use": on_population(f"select id, {POLY} as heavy_poly_use from population"),
    "pack_years_transforms": on_population(
        f"select id, {r6(PACK_LOG)} as pack_years_log, {r6(PACK_SQRT)} as pack_years_sqrt, "
        f"{r6('pack_years * pack_years')} as pack_years_sq from population"
    ),
    "alcohol_transforms": on_population(
        f"select id, {r6('drinks_per_week / 7')} as drink_per_day, "
        f"{r6('(drinks_per_week / 7) * (drinks_per_week / 7)')} as drink_per_day_sq, "
        f"{r6('ln(1 + drinks_per_week)')} as drinks_per_week_log from population"
    ),
    "risk_burden": on_population(
        f"select id, {RISKS} as risk_factor_count, "
        f"cast(({RISKS}) >= 2 as integer) as elevated_risk_flag from population"
    ),
    "duration_intensity": on_population(
        f"select id, {r6(YEARS_HEAVY)} as years_smoking_x_heavy, "
        f"{r6('years_smoking * smokes_per_day')} as years_smoking_x_spd from population"
    ),
    "mode_safe": on_population(
        "select k.marital_status, k.children_count, g.mode from "
        "(select distinct marital_status, children_count from population "
        "where marital_status is not null and children_count is not null) k "
        "left join social_group g on k.marital_status = g.marital_status "
        "and k.children_count = g.children_count",
        *_modes("social", "population", "social_support", _SOCIAL),
    ),
    "global_mode": on_population(
        "select mode as education_level from education_all",
        *_modes("education", "banded", "education_level", _EDUCATION)[1:],
    ).replace("from banded", "from population"),
    "impute_social_support": on_population(
        "select id, social_support from social",
        *_fill("social", "population", "social_support", _SOCIAL),
    ),
    "impute_education": on_population(
        "select id, education_level from education",
        _BANDED,
        *_fill("education", "banded", "education_level", _EDUCATION),
    ),
    "impute_therapy": on_population(
        "select id, therapy_history from therapy",
        _BANDED,
        *_fill("education", "banded", "education_level", _EDUCATION),
        *_fill("therapy", "education", "therapy_history", _THERAPY),
    ),
    "build_features": on_population(
        _DERIVED_SQL,
        *_FEATURE_TABLE,
    ),
    "features_reloaded": on_population(
        f"select * from ({_DERIVED_SQL}) where id % 2 = 1",
        *_FEATURE_TABLE,
    ),
    "income_decile_tied": on_population(
        f"select id, {INCOME_DECILE} as income_decile from tied, income_stats",
        (
            "tied",
            "select * replace (case when id % 2 = 0 then 12345.67::double else annual_income_usd end "
            "as annual_income_usd) from population",
        ),
        (_INCOME_STATS[0], _INCOME_STATS[1].replace("from population", "from tied")),
    ),
    "price_deciles": "select cast(d as integer) as decile, "
    + r6("(select quantile_cont(l_extendedprice, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]) "
         "from lineitem)[d + 1]")
    + " as price from range(11) t(d)",
    "registry_only": on_population(
        f"select id, {POLY} as heavy_poly_use, {RISKS} as risk_factor_count, "
        f"cast(({RISKS}) >= 2 as integer) as elevated_risk_flag from population"
    ),
    "registry_exclude": on_population(
        f"select id, education_level, social_support, {RISKS} as risk_factor_count, "
        "false as has_band from social",
        *_fill("social", "population", "social_support", _SOCIAL),
    ),
    "registry_skip": on_population(
        f"select id, {POLY} as heavy_poly_use, 'pack_years_transforms,risk_burden' as left_out "
        "from population"
    ),
    "interim_roundtrip": on_population("select * from population"),
    "build_if_absent": on_population("select id, annual_income_usd from population"),
    "metrics_roundtrip": on_scored(
        "select "
        + ", ".join(
            f"{r6(_share(part, whole))} as {name}"
            for name, part, whole in (
                ("accuracy", "(tn + tp)", "tn + fp + fn + tp"),
                ("precision", "tp", "tp + fp"),
                ("recall", "tp", "tp + fn"),
                ("f1", "2 * tp", "2 * tp + fp + fn"),
            )
        )
        + ", tn + fp + fn + tp as n, tn, fp, fn, tp from cells",
        _CELLS,
    ),
    "roc_auc_missing": on_scored(_missing_gives_null("roc_auc")),
    "log_loss_missing": on_scored(_missing_gives_null("log_loss")),
    "rf_train": on_population(
        "select 1::double as accuracy, 1::double as precision, 1::double as recall, "
        "1::double as f1, 1::double as roc_auc, cast(ceil(count(*) / 5) as bigint) as n from population"
    ),
    "rf_predict": on_population(f"select id, {_SMOKER} as pred, true as agrees from population"),
    "rf_importances": on_population(
        f"select feature, 1::double as total from ({_forest_names()})", *_FEATURE_TABLE
    ),
    "feature_catalog": on_population(_catalog()),
    "split_train": on_population(
        f"select id, {TARGET}, split from marked", *_split("population", "id", TARGET)
    ),
    "split_many_classes": on_population(
        "select id, class, split from marked",
        (
            "classed",
            "select *, 'c' || (id % greatest(1, (select count(*) from population) // 12)) as class from population",
        ),
        *_split("classed", "id", "class"),
    ),
    "split_plain": on_population(
        f"select id, {TARGET}, split from marked", *_split("population", "id", None)
    ),
    "split_counts": on_population(
        f"select {TARGET}, split, count(*) as n from marked group by 1, 2",
        *_split("population", "id", TARGET),
    ),
    "split_counts_imbalanced": _with(("labelled", LABELLED), *_split("labelled", "doc_id", "toxic"))
    + "select toxic, split, count(*) as n from marked group by 1, 2",
    "scale_numeric": on_population(
        "select id, "
        + ", ".join(
            f"{r6(_standard(c))} as {c}"
            for c in ("annual_income_usd", "children_count", "social_support", "bmi")
        )
        + " from filled, moments",
        *_scaling_stats(("annual_income_usd", "children_count", "social_support", "bmi")),
    ),
    "scale_all_null": on_population(
        "select id, cast(0 as double) as smoking_rate_pct, bmi as later_value from population"
    ),
    "impute_most_frequent": on_population(
        "select id, "
        + ", ".join(
            f"{_filled(c)} as {c}" for c in ("education_level", "marital_status", "therapy_history")
        )
        + " from population"
    ),
    "impute_missing_label": on_population("select id, 'missing' as referral_source from population"),
    "one_hot": on_population(
        " union all ".join(
            f"select id, '{c}_' || {value} as feature, cast(1 as double) as value from population"
            for c, value in (
                ("gender", _filled("gender")),
                ("employment_status", _filled("employment_status")),
                ("education_level", _filled("education_level")),
                ("referral_source", "'missing'"),
            )
        )
    ),
    "vector_of_names": on_population(
        "select id, (select count(distinct name) from named) as length, "
        "dense_rank() over (order by name) - 1 as place from named",
        ("named", f"select id, {_filled('name')} as name from population"),
    ),
    "preprocess_matrix": on_population("select * from matrix", *_matrix()),
    "assert_no_nulls": on_population(
        'select "column", nulls from nulls_after',
        *_matrix(),
        ("nulls_after", _null_rows(MATRIX_COLUMNS, "matrix")),
    ),
    "guard_report": on_population(
        "select count(*) as rows, count(*) filter (where id % 97 = 0) as missing_keys, "
        "count(*) filter (where id % 50 <> 0 and id % 60 = 1) as missing_labels, "
        "count(*) filter (where id % 50 = 0 or id % 60 = 1) as strange_labels, '2' as example from population"
    ),
    "class_weights": on_population(
        f"select {TARGET} as label, count(*) as n, "
        f"{r6('sum(count(*)) over () / (count(*) over () * count(*))')} as weight "
        f"from population group by {TARGET}"
    ),
    "class_weights_imbalanced": _with(("labelled", LABELLED))
    + "select quality as label, count(*) as n, "
    + f"{r6('sum(count(*)) over () / (count(*) over () * count(*))')} as weight "
    + "from labelled group by quality",
    "confusion_matrix": on_scored("select tn, fp, fn, tp from cells", _CELLS),
    "classification_metrics": on_scored(
        "select "
        + ", ".join(
            f"{r6(_share(part, whole))} as {name}"
            for name, part, whole in (
                ("accuracy", "(tn + tp)", "tn + fp + fn + tp"),
                ("precision", "tp", "tp + fp"),
                ("recall", "tp", "tp + fn"),
                ("f1", "2 * tp", "2 * tp + fp + fn"),
            )
        )
        + " from cells",
        _CELLS,
    ),
    "roc_auc_continuous": f"select {r6('sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg))')} as roc_auc from ("
    "select pos, neg, coalesce(sum(neg) over (order by score rows between unbounded preceding "
    "and 1 preceding), 0) as below from (select l_extendedprice as score, "
    "cast(count(*) filter (where l_returnflag = 'R') as double) as pos, "
    "cast(count(*) filter (where l_returnflag <> 'R') as double) as neg from lineitem group by 1))",
    "roc_auc": on_scored(
        f"select {r6('sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg))')} as roc_auc from ("
        "select pos, neg, coalesce(sum(neg) over (order by score rows between unbounded preceding "
        "and 1 preceding), 0) as below from (select score, "
        "cast(count(*) filter (where label = 1) as double) as pos, "
        "cast(count(*) filter (where label = 0) as double) as neg from scored group by score))"
    ),
    "log_loss": on_scored(
        "select "
        + r6(
            "avg(-ln(greatest(least(case when label = 1 then score else 1 - score end, "
            "1 - 2.220446049250313e-16::double), 2.220446049250313e-16::double)))"
        )
        + " as log_loss from scored"
    ),
    "support": on_scored(
        f"select count(label) as n, {r6('avg(cast(label as double))')} as pos_rate from scored"
    ),
}
