"""Fixture views: the domain tables stood up on the driver's test tables.

Each view is one SQL text that runs unchanged in Spark and DuckDB, so a Spark
query and its DuckDB oracle start from identical rows.  In Spark the text is run
with ``spark.sql(text, **frames)`` (DataFrame arguments, no global temp views);
for DuckDB the same text becomes a ``WITH`` clause in front of the oracle query.

Table placeholders are written ``{name}``.  Base tables are the driver's parquet
files; every other name is another fixture view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# name -> SQL; order matters only for readability, dependencies are resolved by name.
FIXTURE_SQL: dict[str, str] = {
    "ip_baseline": """
select o_orderkey as rn,
       concat('D', cast(n_regionkey as string)) as dataset,
       concat('S0', cast(c_nationkey % 5 as string)) as sitetret,
       cast(year(o_orderdate) as int) as fyear,
       case when o_custkey % 41 = 0 then null else cast(o_custkey % 100 as int) end as age,
       concat('ag', cast(o_custkey % 4 as string)) as age_group,
       cast(o_orderkey % 2 + 1 as string) as sex,
       case o_orderstatus when 'F' then 'ip_elective_admission'
                          when 'O' then 'ip_non-elective_admission'
                          else 'op_procedure' end as pod,
       case o_orderstatus when 'F' then 'elective'
                          when 'O' then 'non-elective' else 'maternity' end as grp,
       c_mktsegment as tretspef,
       nullif(o_orderpriority, '4-NOT SPECIFIED') as sushrg,
       cast(o_orderkey % 2 as int) as maternity_delivery_in_spell,
       case when o_orderkey % 3 = 0 then 1 else 0 end as has_procedure,
       cast(o_custkey % 30 as int) as speldur,
       cast(o_orderkey % 5 + 1 as string) as classpat
from {orders}
join {customer} on o_custkey = c_custkey
join {nation} on c_nationkey = n_nationkey""",
    "ip_runs": """
select l_orderkey as rn, cast(l_partkey % 256 + 1 as int) as model_run,
       cast(l_quantity as int) - 1 as speldur, cast(l_linenumber as string) as classpat
from {lineitem} where l_returnflag <> 'R'""",
    "ip_avoided": """
select l_orderkey as rn, cast(l_partkey % 256 + 1 as int) as model_run,
       cast(l_quantity as int) - 1 as speldur, cast(l_linenumber as string) as classpat
from {lineitem} where l_returnflag = 'R'""",
    "op_baseline": """
select event_id as rn,
       concat('D', cast(user_id % 3 as string)) as dataset,
       concat('S0', cast(user_id % 5 as string)) as sitetret,
       cast(user_id % 100 as int) as age,
       case when user_id % 10 = 0 then null else concat('ag', cast(user_id % 4 as string)) end as age_group,
       cast(100 + user_id % 7 as string) as tretspef,
       event_type as type,
       concat('og', cast(event_id % 2 as string)) as grp,
       event_id % 3 = 0 as is_first,
       event_id % 5 = 0 as has_procedures,
       event_id % 2 = 0 as is_gp_ref,
       event_id % 7 = 0 as is_cons_cons_ref,
       cast(event_id % 4 as int) as attendances,
       cast((event_id + 1) % 3 as int) as tele_attendances
from {events}""",
    "aae_baseline": """
select event_id as rn,
       concat('D', cast(user_id % 3 as string)) as dataset,
       concat('S0', cast(user_id % 5 as string)) as sitetret,
       concat('aae_type-0', cast(event_id % 4 + 1 as string)) as pod,
       cast(user_id % 100 as int) as age,
       concat('ag', cast(user_id % 4 as string)) as age_group,
       cast(event_id % 3 + 1 as string) as attendance_category,
       concat('0', cast(event_id % 4 + 1 as string)) as aedepttype,
       nullif(event_type, 'error') as acuity,
       concat('aae_', event_type) as hsagrp,
       value > 50 as is_ambulance,
       case when value > 50 then 'ambulance' else 'walk-in' end as grp,
       event_id % 11 = 0 as is_discharged_no_treatment,
       event_id % 13 = 0 as is_frequent_attender,
       event_id % 7 = 0 and event_type <> 'view' as is_left_before_treatment,
       event_id % 5 = 0 as is_low_cost_referred_or_discharged,
       cast(event_id % 3 + 1 as int) as arrivals
from {events}""",
    "runs16": """
select distinct cast(o_orderkey % 16 + 1 as int) as model_run from {orders}""",
    "op_runs": """
select rn, model_run, cast((rn + model_run) % 4 as int) as attendances,
       cast((rn + 2 * model_run) % 3 as int) as tele_attendances
from {op_baseline} cross join {runs16}""",
    "aae_runs": """
select rn, model_run, cast((rn + model_run) % 3 + 1 as int) as arrivals
from {aae_baseline} cross join {runs16}""",
    "op_conversion": """
select cast(l_partkey % 16 + 1 as int) as model_run,
       concat('D', cast(l_suppkey % 3 as string)) as dataset,
       concat('S0', cast(l_suppkey % 6 as string)) as sitetret,
       concat('ag', cast(l_suppkey % 4 as string)) as age_group,
       cast(l_orderkey % 100 as int) as age,
       cast(100 + l_suppkey % 8 as string) as tretspef,
       cast(l_linenumber as int) as attendances
from {lineitem} where l_returnflag = 'R'""",
    "sdec_conversion": """
select cast(l_partkey % 16 + 1 as int) as model_run,
       concat('D', cast(l_suppkey % 3 as string)) as dataset,
       concat('S0', cast(l_suppkey % 6 as string)) as sitetret,
       concat('ag', cast(l_suppkey % 4 as string)) as age_group,
       cast(l_orderkey % 100 as int) as age,
       cast(l_orderkey % 3 + 1 as string) as attendance_category,
       '05' as aedepttype, 'click' as acuity,
       case when l_linestatus = 'F' then 'ambulance' else 'walk-in' end as grp,
       cast(l_linenumber as int) as arrivals
from {lineitem} where l_returnflag = 'A'""",
    "default_old": """
select 'scn' as scenario, dataset, pod, sitetret, measure, model_run, sum(value) as value from (
  select dataset, pod, sitetret, 'beddays' as measure, 0 as model_run,
         cast(speldur + 1 as bigint) as value from {ip_baseline}
  union all
  select dataset, pod, sitetret, 'admissions', 0, cast(1 as bigint) from {ip_baseline}
  union all
  select b.dataset, b.pod, b.sitetret, 'beddays', r.model_run, cast(r.speldur + 1 as bigint)
  from {ip_baseline} b join {ip_runs} r on b.rn = r.rn
  union all
  select b.dataset, b.pod, b.sitetret, 'admissions', r.model_run, cast(1 as bigint)
  from {ip_baseline} b join {ip_runs} r on b.rn = r.rn
  union all select 'D0', 'zero_pod', 'S00', 'admissions', 0, cast(0 as bigint)
  union all select 'D0', 'zero_pod', 'S00', 'admissions', 1, cast(0 as bigint)
  union all select 'D0', 'base_only', 'S00', 'admissions', 0, cast(7 as bigint)
) t group by dataset, pod, sitetret, measure, model_run""",
    "default_new": """
select 'scn-testdev' as scenario, dataset, pod, sitetret, measure, model_run,
       case when pod = 'zero_pod' and model_run > 0 then value + 5
            when sitetret = 'S01' then value * 2 else value end as value
from {default_old} where not (dataset = 'D1' and pod = 'op_procedure')
union all select 'scn-testdev', 'D0', 'new_pod', 'S00', 'admissions', 0, cast(3 as bigint)
union all select 'scn-testdev', 'D0', 'new_pod', 'S00', 'admissions', 1, cast(4 as bigint)""",
    # Aggregated results with the labels of the detailed ones: a mean over all runs per cell.
    "default_means": """
select 'ip' as activity, dataset, pod, sitetret, 'admissions' as measure, cast(count(*) as double) / 256 as mean
from (select b.dataset, b.sitetret, r.speldur, case when r.classpat = '2' then 'ip_elective_daycase' else b.pod end as pod
      from {ip_baseline} b join {ip_runs} r on b.rn = r.rn) a
where pod <> 'op_procedure' group by dataset, pod, sitetret
union all
select 'ip', dataset, pod, sitetret, 'beddays', cast(sum(speldur + 1) as double) / 256
from (select b.dataset, b.sitetret, r.speldur, case when r.classpat = '2' then 'ip_elective_daycase' else b.pod end as pod
      from {ip_baseline} b join {ip_runs} r on b.rn = r.rn) a
where pod <> 'op_procedure' group by dataset, pod, sitetret
union all
select 'op', b.dataset, b.type, b.sitetret, 'attendances', cast(sum(r.attendances) as double) / 16
from {op_baseline} b join {op_runs} r on b.rn = r.rn group by b.dataset, b.type, b.sitetret
union all
select 'op', b.dataset, b.type, b.sitetret, 'tele_attendances', cast(sum(r.tele_attendances) as double) / 16
from {op_baseline} b join {op_runs} r on b.rn = r.rn group by b.dataset, b.type, b.sitetret
union all
select 'op', dataset, 'op_procedure', sitetret, 'attendances', cast(sum(attendances) as double) / 16
from {op_conversion} group by dataset, sitetret
union all
select 'aae', b.dataset, b.pod, b.sitetret, b.grp, cast(sum(r.arrivals) as double) / 16
from {aae_baseline} b join {aae_runs} r on b.rn = r.rn group by b.dataset, b.pod, b.sitetret, b.grp
union all
select 'aae', dataset, 'aae_type-05', sitetret, grp, cast(sum(arrivals) as double) / 16
from {sdec_conversion} group by dataset, sitetret, grp""",
    "step_counts_old": """
select b.dataset, 'ip' as activity_type, b.pod, l_returnflag as change_factor,
       l_linestatus as strategy, 'beddays' as measure,
       cast(l_partkey % 256 + 1 as int) as model_run,
       0 - cast(sum(l_quantity) as bigint) as value
from {lineitem} join {ip_baseline} b on l_orderkey = b.rn
group by b.dataset, b.pod, l_returnflag, l_linestatus, cast(l_partkey % 256 + 1 as int)""",
    "step_counts_new": """
select dataset, activity_type, pod, change_factor,
       case when change_factor = 'N' then concat(strategy, '2') else strategy end as strategy,
       measure, model_run,
       case when pod = 'op_procedure' then value * 3 else value end as value
from {step_counts_old}""",
    # rn that repeats between datasets and years, as in separately numbered extracts
    "ip_renumbered": """
select rn as old_rn, cast(row_number() over (partition by dataset, fyear order by rn) as bigint) as rn, dataset, fyear,
       sitetret, age, age_group, sex, pod, grp, tretspef, sushrg, maternity_delivery_in_spell, has_procedure, speldur, classpat
from {ip_baseline}""",
    "ip_runs_renumbered": """
select b.dataset, b.fyear, b.rn, r.model_run, r.speldur, r.classpat
from {ip_runs} r join {ip_renumbered} b on r.rn = b.old_rn""",
    "ip_avoided_renumbered": """
select b.dataset, b.fyear, b.rn, r.model_run, r.speldur, r.classpat
from {ip_avoided} r join {ip_renumbered} b on r.rn = b.old_rn""",
    "strategies_renumbered": """
select b.dataset, b.fyear, b.rn, s.kind, s.strategy, s.sample_rate
from {strategies} s join {ip_renumbered} b on s.rn = b.old_rn""",
    "default_means_year": """
select dataset, fyear, pod, sitetret, 'admissions' as measure, cast(count(*) as double) / 256 as mean
from (select b.dataset, b.fyear, b.sitetret, r.speldur, case when r.classpat = '2' then 'ip_elective_daycase' else b.pod end as pod
      from {ip_baseline} b join {ip_runs} r on b.rn = r.rn) a
where pod <> 'op_procedure' group by dataset, fyear, pod, sitetret
union all
select dataset, fyear, pod, sitetret, 'beddays', cast(sum(speldur + 1) as double) / 256
from (select b.dataset, b.fyear, b.sitetret, r.speldur, case when r.classpat = '2' then 'ip_elective_daycase' else b.pod end as pod
      from {ip_baseline} b join {ip_runs} r on b.rn = r.rn) a
where pod <> 'op_procedure' group by dataset, fyear, pod, sitetret""",
    # aggregated results over the population of the national product: the baseline's own pods
    "default_means_national": """
select b.fyear, b.pod, 'admissions' as measure, cast(count(*) as double) / 256 as mean
from {ip_baseline} b join {ip_runs} r on b.rn = r.rn group by b.fyear, b.pod
union all
select b.fyear, b.pod, 'beddays', cast(sum(r.speldur + 1) as double) / 256
from {ip_baseline} b join {ip_runs} r on b.rn = r.rn group by b.fyear, b.pod""",
    # outpatients and A&E of several years in one table
    "op_years": """
select *, cast(2019 + rn % 3 as int) as fyear from {op_baseline}""",
    "aae_years": """
select *, cast(2019 + rn % 4 as int) as fyear from {aae_baseline}""",
    "strategies": """
select l_orderkey as rn,
       case when l_linestatus = 'F' then 'aa' else 'ef' end as kind,
       concat(l_returnflag, '_', cast(l_linenumber as string)) as strategy,
       l_discount as sample_rate
from {lineitem} where l_returnflag <> 'N'""",
    "data_versions": """
select concat('v', cast(n_regionkey + 1 as string), '.',
              cast(n_nationkey % 13 as string), '.', cast(n_nationkey % 4 as string)) as version
from {nation} union all select 'dev' union all select 'v3.1' union all select 'vnext.0.1'
union all select 'v6.0.1-rc1' union all select 'v9'""",
    "file_paths": """
select concat('full-model-results/v4.1/', dataset, '/scn-', pod, '/20250101_100000/ip/model_run=',
              cast(model_run as string),
              case when dataset = 'D1' then '/data.csv' else '/0.parquet' end) as path
from {default_old} where model_run > 0
union all select 'full-model-results/v4.1/D9/flat/20250101_100000/readme.txt'
union all select 'file1.json'""",
    # Versioned pair for release-to-release checks: "dev" is the view as is,
    # "release" the same view with some rows removed.
    "ip_baseline_release": """
select * from {ip_baseline}
where rn % 50 <> 0 and not (pod = 'op_procedure' and dataset = 'D2')""",
    "op_baseline_release": """
select * from {op_baseline}
where rn % 50 <> 0 and not (has_procedures and dataset = 'D2')""",
    "aae_baseline_release": """
select * from {aae_baseline}
where rn % 50 <> 0 and not (pod = 'aae_type-04' and dataset = 'D2')""",
    "strategies_release": """
select * from {strategies} where rn % 50 <> 0 and strategy <> 'R_7'""",
    # Run parameters, one JSON document per row, built from the nation table.
    "params_json": """
select concat('{{"scenario": "scn-', lower(n_name), '", "dataset": "D', cast(n_regionkey as string),
              '", "app_version": "v4.', cast(n_nationkey % 3 as string),
              '", "start_year": ', cast(2020 + n_nationkey % 5 as string),
              ', "create_datetime": "20250101_1', lpad(cast(n_nationkey as string), 5, '0'),
              '", "seed": ', cast(n_nationkey * 7 as string),
              ', "extra": "x', cast(n_nationkey as string), '", "non-demographic_adjustment": ',
              case when n_nationkey % 4 = 1
                   then '{{"variant": "own", "value-type": "other", "values": ' else '' end,
              '{{"elective": [1.0', cast(n_nationkey % 10 as string),
              ', 1.02], "maternity": [1.01, 1.0', cast(n_regionkey as string), ']}}',
              case when n_nationkey % 4 = 1 then '}}' else '' end, '}}') as json
from {nation}""",
}

# Spark spellings of views whose shared text uses a cross join with the 16-row run
# list: the same rows, produced by exploding the run list (a scalar subquery)
# instead of a cartesian product.
SPARK_SQL: dict[str, str] = {
    # one join and one aggregation that emits both measures; two numbers a run row are estimated
    # small, so the hint keeps the runs from being sent whole to every task
    "default_old": """
select 'scn' as scenario, dataset, pod, sitetret, measure, model_run, value from (
  select dataset, pod, sitetret, model_run, stack(2, 'beddays', beddays, 'admissions', admissions) as (measure, value)
  from (
    select dataset, pod, sitetret, model_run, cast(sum(speldur + 1) as bigint) as beddays, count(*) as admissions from (
      select dataset, pod, sitetret, 0 as model_run, speldur from {ip_baseline}
      union all
      select /*+ merge(r) */ b.dataset, b.pod, b.sitetret, r.model_run, r.speldur
      from {ip_baseline} b join {ip_runs} r on b.rn = r.rn) j
    group by dataset, pod, sitetret, model_run) a
  union all select 'D0', 'zero_pod', 'S00', 0, 'admissions', cast(0 as bigint)
  union all select 'D0', 'zero_pod', 'S00', 1, 'admissions', cast(0 as bigint)
  union all select 'D0', 'base_only', 'S00', 0, 'admissions', cast(7 as bigint)
) t""",
    "op_runs": """
select rn, model_run, cast((rn + model_run) % 4 as int) as attendances,
       cast((rn + 2 * model_run) % 3 as int) as tele_attendances
from {op_baseline}
lateral view explode((select sort_array(collect_set(model_run)) from {runs16})) r as model_run""",
    "aae_runs": """
select rn, model_run, cast((rn + model_run) % 3 + 1 as int) as arrivals
from {aae_baseline}
lateral view explode((select sort_array(collect_set(model_run)) from {runs16})) r as model_run""",
    # one join and one aggregation an activity; the exploded runs are estimated at a fraction of
    # their rows, so the hint keeps them from being sent whole to every task
    "default_means": """
select 'ip' as activity, dataset, pod, sitetret,
       stack(2, 'admissions', cast(admissions as double) / 256, 'beddays', cast(beddays as double) / 256) as (measure, mean)
from (select dataset, pod, sitetret, count(*) as admissions, sum(speldur + 1) as beddays
      from (select /*+ merge(r) */ b.dataset, b.sitetret, r.speldur, case when r.classpat = '2' then 'ip_elective_daycase' else b.pod end as pod
            from {ip_baseline} b join {ip_runs} r on b.rn = r.rn) a
      where pod <> 'op_procedure' group by dataset, pod, sitetret) t
union all
select 'op', dataset, type, sitetret,
       stack(2, 'attendances', cast(attendances as double) / 16, 'tele_attendances', cast(tele_attendances as double) / 16) as (measure, mean)
from (select /*+ merge(r) */ b.dataset, b.type, b.sitetret, sum(r.attendances) as attendances, sum(r.tele_attendances) as tele_attendances
      from {op_baseline} b join {op_runs} r on b.rn = r.rn group by b.dataset, b.type, b.sitetret) t
union all
select 'op', dataset, 'op_procedure', sitetret, 'attendances', cast(sum(attendances) as double) / 16
from {op_conversion} group by dataset, sitetret
union all
select /*+ merge(r) */ 'aae', b.dataset, b.pod, b.sitetret, b.grp, cast(sum(r.arrivals) as double) / 16
from {aae_baseline} b join {aae_runs} r on b.rn = r.rn group by b.dataset, b.pod, b.sitetret, b.grp
union all
select 'aae', dataset, 'aae_type-05', sitetret, grp, cast(sum(arrivals) as double) / 16
from {sdec_conversion} group by dataset, sitetret, grp""",
}

_PLACEHOLDER = re.compile(r"\{([a-z_0-9]+)\}")


def _deps(name: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(FIXTURE_SQL[name])))


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str, _memo: dict | None = None) -> DataFrame:
    """Build a fixture view as a lazy DataFrame."""
    memo = {} if _memo is None else _memo
    if name in memo:
        return memo[name]
    if name in BASE_TABLES:
        df = load_table(spark, sf_dir, name)
    else:
        frames = {d: fixture(spark, sf_dir, d, memo) for d in _deps(name)}
        df = spark.sql(SPARK_SQL.get(name, FIXTURE_SQL[name]), **frames)
    memo[name] = df
    return df


class Fixtures:
    """Lazily built fixture views for one sf directory, shared within a query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._memo: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        return fixture(self.spark, self.sf_dir, name, self._memo)


def duckdb_with(sql: str, views: list[str] | None = None) -> str:
    """Prefix ``sql`` with the fixture views it names, as DuckDB CTEs.

    ``views`` may be given; otherwise fixture names found in ``sql`` are used.
    """
    wanted = views if views is not None else [
        n for n in FIXTURE_SQL if re.search(rf"\b{n}\b", sql)
    ]
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n in BASE_TABLES:
            return
        for d in _deps(n):
            visit(d)
        order.append(n)

    for n in wanted:
        visit(n)
    if not order:
        return sql
    ctes = []
    for n in order:
        body = FIXTURE_SQL[n].replace("{{", "\x00").replace("}}", "\x01")
        body = _PLACEHOLDER.sub(lambda m: m.group(1), body)
        body = body.replace("\x00", "{").replace("\x01", "}")
        ctes.append(f"{n} AS ({body}\n)")
    body = sql.strip()
    if body.lower().startswith("with "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
