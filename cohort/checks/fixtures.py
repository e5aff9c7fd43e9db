"""Test tables derived from the given ones.

The SQL text is portable: it runs unchanged in Spark and in DuckDB, so both
sides of a comparison start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POPULATION = """
select
  o.o_orderkey as id,
  c.c_name as name,
  case when o.o_orderkey % 11 = 0 then null else o.o_totalprice end as annual_income_usd,
  case when o.o_orderkey % 17 = 0 then null else cast(o.o_orderkey % 31 as double) end as smokes_per_day,
  case when o.o_orderkey % 19 = 0 then null else cast(o.o_custkey % 43 as double) end as drinks_per_week,
  case when o.o_orderkey % 23 = 0 then null else cast(o.o_orderkey % 4 as double) end as children_count,
  case when o.o_orderkey % 29 = 0 then null else cast(o.o_orderkey % 6 as double) end as attempts_to_quit_smoking,
  cast(o.o_custkey % 5 as double) as attempts_to_quit_drinking,
  cast(4 + o.o_orderkey % 6 as double) as sleep_hours,
  cast(18 + o.o_custkey % 23 as double) as bmi,
  case when o.o_orderkey % 7 = 0 then null else cast(c.c_nationkey % 5 as double) end as social_support,
  cast(null as double) as smoking_rate_pct,
  case when o.o_custkey % 2 = 0 then 'female' else 'male' end as gender,
  case when o.o_orderkey % 5 = 0 then null else lower(c.c_mktsegment) end as education_level,
  lower(o.o_orderpriority) as employment_status,
  case when o.o_orderkey % 13 = 0 then null else lower(o.o_orderstatus) end as marital_status,
  case o.o_custkey % 3 when 0 then 'good' when 1 then 'moderate' else 'poor' end as mental_health_status,
  case when o.o_orderkey % 9 = 0 then null
       when o.o_custkey % 4 = 0 then 'current'
       when o.o_custkey % 4 = 1 then 'past' else 'none' end as therapy_history,
  cast(o.o_orderkey % 41 as double) as years_smoking,
  cast((o.o_orderkey % 31) * (o.o_orderkey % 41) as double) / cast(20 as double) as pack_years,
  case when o.o_orderkey % 31 >= 20 then 1.0e0 else 0.0e0 end as heavy_smoker_flag,
  case when o.o_custkey % 43 >= 14 then 1.0e0 else 0.0e0 end as heavy_drinker_flag,
  case when o.o_custkey % 23 >= 12 then 1.0e0 else 0.0e0 end as bmi_obese_flag,
  cast(greatest(0, 4 - o.o_orderkey % 6) as double) as sleep_deficit,
  case when o.o_orderkey % 10 = 0 then null else cast(o.o_orderkey % 4 as double) end as diet_score,
  cast(o.o_custkey % 4 as double) as exercise_score,
  cast(o.o_custkey % 3 as double) as mh_score,
  case when o.o_orderkey % 31 > 0 and o.o_custkey % 43 > 0 then 1.0e0 else 0.0e0 end as poly_use,
  cast((o.o_orderkey * 7 + o.o_custkey) % 2 as integer) as has_health_issues
from orders o left join customer c on o.o_custkey = c.c_custkey
"""

RAW_POPULATION = """
select
  cast(id as varchar(20)) as "ID",
  case cast(id % 9 as integer)
    when 0 then '1,000' when 1 then '  42 ' when 2 then '1d' when 3 then 'abc'
    when 4 then '' when 5 then '1e3' when 6 then '0x10'
    else cast(cast(floor(coalesce(annual_income_usd, 0)) as bigint) as varchar(40)) end as " Annual  Income USD ",
  case cast(id % 4 as integer)
    when 0 then '  Female ' when 1 then 'MALE' when 2 then '   ' else gender end as "Gender",
  coalesce(upper(education_level), '') as "Education Level",
  has_health_issues as "Has Health Issues"
from population
union all
select
  cast(id as varchar(20)), '1,000', '  Female ',
  coalesce(upper(education_level), ''), has_health_issues
from population where id % 36 = 0
"""

SCORED = """
select id, has_health_issues as label,
  cast((id * 37 + 11) % 101 as double) / cast(100 as double) as score,
  case when (id * 37 + 11) % 101 >= 50 then 1 else 0 end as pred
from population
"""

LABELLED = """
select d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
from documents d join labels l on d.doc_id = l.doc_id
"""


#: Numeric columns of the population, with gaps.
WIDE = (
    "annual_income_usd", "smokes_per_day", "drinks_per_week", "children_count", "attempts_to_quit_smoking",
    "attempts_to_quit_drinking", "sleep_hours", "bmi", "social_support", "years_smoking", "pack_years",
    "sleep_deficit", "diet_score", "exercise_score", "mh_score",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def population(spark: SparkSession, folder: str) -> DataFrame:
    sql = POPULATION.replace("from orders o left join customer c", "from {orders} o left join {customer} c")
    return spark.sql(
        sql, orders=table(spark, folder, "orders"), customer=table(spark, folder, "customer")
    )


def _over_population(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    sql = sql.replace("from population", "from {population}").replace('"', "`")
    return spark.sql(sql, population=population(spark, folder))


def raw_population(spark: SparkSession, folder: str) -> DataFrame:
    return _over_population(spark, folder, RAW_POPULATION)


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return _over_population(spark, folder, SCORED)


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    sql = LABELLED.replace("documents d", "{documents} d").replace("labels l", "{labels} l")
    return spark.sql(
        sql, documents=table(spark, folder, "documents"), labels=table(spark, folder, "labels")
    )
