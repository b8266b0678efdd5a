"""DuckDB oracle SQL per registered query.

Written independently of the Spark operators, in the most direct form: zero
padding as explicit rows, gap filling as a cross join of runs and cells, as-of
lookups as correlated subqueries.  Fixture views come in as CTEs
(``sources.fixtures.duckdb_with``), so both engines start from identical rows.
"""

from __future__ import annotations

from ..sources.fixtures import duckdb_with

R = 6  # rounding places, as in plans.queries.ROUND

# Band labels and cell keys.
LOS_DETAILED_SQL = """case when {c} = 0 then '0 days' when {c} = 1 then '1 day'
  when {c} = 2 then '2 days' when {c} = 3 then '3 days'
  when {c} between 4 and 7 then '4-7 days' when {c} between 8 and 14 then '8-14 days'
  when {c} between 15 and 21 then '15-21 days' else '22+ days' end"""
LOS_AVOIDED_SQL = "case when {c} = 0 then '0 days' else '1+ days' end"
LOS_CUSTOM_SQL = """case when {c} = 0 then '0 days' when {c} between 1 and 6 then '1-6 days'
  when {c} between 7 and 14 then '7-14 days' else '15+ days' end"""
LOS_NATIONAL_SQL = "case when {c} = 0 then '0' when {c} = 1 then '1' when {c} >= 2 then '2+' end"
AGE_CUSTOM_SQL = """case when {c} between 0 and 9 then 'Paeds < 10' when {c} between 10 and 17
  then 'Paeds 10-17' when {c} between 18 and 64 then 'Adults 18-64' else 'Adults >= 65' end"""
AGE_CUT_SQL = """case when coalesce({c}, -1) >= -1 and coalesce({c}, -1) < 0 then 'Unknown'
  when {c} >= 0 and {c} < 1 then '0' when {c} >= 1 and {c} < 18 then '1-17'
  when {c} >= 18 and {c} < 1000 then '18+' else 'nan' end"""
OP_POD_SQL = """case when {p}has_procedures then 'op_procedure' when {p}is_first then 'op_first'
  else 'op_follow-up' end"""

IP_BY = ["dataset", "fyear"]
IP_STD = [*IP_BY, "sitetret", "age_group", "sex", "pod", "tretspef", "los_group", "maternity_delivery_in_spell"]
IP_HRG = [*IP_BY, "sitetret", "age_group", "pod", "tretspef", "sushrg", "maternity_delivery_in_spell"]
OP_CELLS = ["dataset", "sitetret", "pod", "age_group", "tretspef"]
AAE_STD = ["dataset", "sitetret", "pod", "age_group", "attendance_category", "aedepttype", "acuity"]
AAE_HRG = ["dataset", "sitetret", "pod", "age_group", "attendance_category", "aedepttype"]


def f(tpl: str, c: str) -> str:
    return tpl.format(c=c, p="")


def notnull(cols, alias: str = "") -> str:
    return " and ".join(f"{alias}{c} is not null" for c in cols)


def summary_ctes(src: str, cells: list[str], n_runs: int, name: str = "summ") -> str:
    """CTEs: zero-pad each cell of ``src`` (cells..., value) to n_runs rows, then
    quantiles and mean."""
    k = ", ".join(cells)
    kc = ", ".join(f"c.{x}" for x in cells)
    return f"""
_cnt_{name} AS (select {k}, count(*) as _k from {src} group by all),
_pad_{name} AS (
  select {k}, cast(value as double) as value from {src}
  union all
  select {kc}, 0.0 from _cnt_{name} c, range({n_runs} - c._k)
),
{name} AS (
  select {k}, quantile_cont(value, 0.1) as lwr_ci, quantile_cont(value, 0.5) as median,
         sum(value) / {n_runs}.0 as mean, quantile_cont(value, 0.9) as upr_ci
  from _pad_{name} group by all
)"""


# --------------------------------------------------------------- ip detailed
def ip_per_run_ctes(cells: list[str], hrg: bool, runs: str = "ip_runs", los: str = LOS_DETAILED_SQL,
                    positive: bool = True, name: str = "ipr") -> str:
    age = f(AGE_CUT_SQL, "b.age") if hrg else "b.age_group"
    k = ", ".join(cells)
    pos = "where value > 0" if positive else ""
    return f"""
_j_{name} AS (
  select r.model_run, b.dataset, b.fyear, b.sitetret, {age} as age_group, b.sex,
         case when r.classpat = '2' then 'ip_elective_daycase' else b.pod end as pod,
         b.tretspef, b.sushrg, {f(los, 'r.speldur')} as los_group, b.maternity_delivery_in_spell,
         r.speldur + 1 as beddays, b.has_procedure
  from ip_baseline b join {runs} r on b.rn = r.rn
),
_a_{name} AS (
  select model_run, {k}, count(*) as admissions, sum(beddays) as beddays,
         sum(has_procedure) as procedures
  from _j_{name} where {notnull(cells)} group by all
),
_l_{name} AS (
  select model_run, {k}, case when pod = 'op_procedure' then 'attendances' else 'admissions' end
         as measure, cast(admissions as bigint) as value from _a_{name}
  union all
  select model_run, {k}, 'beddays', cast(beddays as bigint) from _a_{name}
  where pod is distinct from 'op_procedure'
  union all
  select model_run, {k}, 'procedures', cast(procedures as bigint) from _a_{name}
  where pod is distinct from 'op_procedure'
),
{name} AS (select * from _l_{name} {pos})"""


def detailed_ip_sql(cells: list[str], hrg: bool) -> str:
    return ("WITH " + ip_per_run_ctes(cells, hrg) + ","
            + summary_ctes("ipr", cells + ["measure"], 256)
            + "\nselect * from summ")


# --------------------------------------------------------------- op detailed
def op_base_cte(hrg: bool, name: str = "opb") -> str:
    age = f(AGE_CUT_SQL, "age") if hrg else "coalesce(age_group, 'unknown')"
    return f"""
{name} AS (
  select rn, dataset, coalesce(sitetret, 'unknown') as sitetret, {OP_POD_SQL.format(p='')} as pod,
         {age} as age_group, coalesce(tretspef, 'unknown') as tretspef,
         attendances, tele_attendances
  from op_baseline
)"""


def op_per_run_ctes(hrg: bool, name: str = "opr") -> str:
    k = ", ".join(OP_CELLS)
    conv_age = f(AGE_CUT_SQL, "age") if hrg else "age_group"
    return op_base_cte(hrg) + f""",
_rows_{name} AS (
  select r.model_run, b.dataset, b.sitetret, b.pod, b.age_group, b.tretspef,
         cast(r.attendances as bigint) as attendances,
         cast(r.tele_attendances as bigint) as tele_attendances
  from opb b join op_runs r on b.rn = r.rn
),
_conv_{name} AS (
  select model_run, dataset, sitetret, 'op_procedure' as pod, {conv_age} as age_group, tretspef,
         sum(attendances) as attendances
  from op_conversion group by all
),
_m_{name} AS (
  select model_run, {k}, sum(attendances) as attendances, sum(tele_attendances) as tele_attendances
  from _rows_{name} group by all
),
_t_{name} AS (
  select coalesce(m.model_run, c.model_run) as model_run,
         coalesce(m.dataset, c.dataset) as dataset,
         coalesce(m.sitetret, c.sitetret) as sitetret, coalesce(m.pod, c.pod) as pod,
         coalesce(m.age_group, c.age_group) as age_group, coalesce(m.tretspef, c.tretspef) as tretspef,
         coalesce(m.attendances, 0) + coalesce(c.attendances, 0) as attendances,
         m.tele_attendances
  from _m_{name} m full join (select * from _conv_{name} where {notnull(OP_CELLS)}) c
    on m.model_run = c.model_run and m.dataset = c.dataset and m.sitetret = c.sitetret and m.pod = c.pod
   and m.age_group = c.age_group and m.tretspef = c.tretspef
),
{name} AS (
  select model_run, {k}, 'attendances' as measure, cast(attendances as bigint) as value from _t_{name}
  union all
  select model_run, {k}, 'tele_attendances', cast(tele_attendances as bigint) from _t_{name}
  where tele_attendances is not null
)"""


def detailed_op_sql(hrg: bool) -> str:
    return ("WITH " + op_per_run_ctes(hrg) + ","
            + summary_ctes("opr", OP_CELLS + ["measure"], 16) + "\nselect * from summ")


# -------------------------------------------------------------- aae detailed
def aae_base_cte(hrg: bool, name: str = "aeb") -> str:
    age = f(AGE_CUT_SQL, "age") if hrg else "coalesce(age_group, 'unknown')"
    return f"""
{name} AS (
  select rn, dataset, coalesce(sitetret, 'unknown') as sitetret, coalesce(pod, 'unknown') as pod,
         {age} as age_group, coalesce(attendance_category, 'unknown') as attendance_category,
         coalesce(aedepttype, 'unknown') as aedepttype, coalesce(acuity, 'unknown') as acuity,
         case when is_ambulance then 'ambulance' else 'walk-in' end as measure, arrivals
  from aae_baseline
)"""


def aae_per_run_ctes(cells: list[str], hrg: bool, name: str = "aer") -> str:
    k = ", ".join(cells)
    conv_age = f(AGE_CUT_SQL, "age") if hrg else "age_group"
    return aae_base_cte(hrg) + f""",
_all_{name} AS (
  select r.model_run, {", ".join('b.' + c for c in cells)}, b.measure, r.arrivals
  from aeb b join aae_runs r on b.rn = r.rn
  union all
  select model_run, {k}, measure, arrivals from (
    select model_run, dataset, sitetret, 'aae_type-05' as pod, {conv_age} as age_group, attendance_category,
           aedepttype, acuity, grp as measure, arrivals from sdec_conversion) s
  where {notnull(cells + ['measure'])}
),
{name} AS (
  select model_run, {k}, measure, cast(sum(arrivals) as bigint) as value from _all_{name} group by all
)"""


def detailed_aae_sql(cells: list[str], hrg: bool) -> str:
    return ("WITH " + aae_per_run_ctes(cells, hrg) + ","
            + summary_ctes("aer", cells + ["measure"], 16) + "\nselect * from summ")


# --------------------------------------------------------------- attach
def attach_sql(summ_sql_ctes: str, base_ctes: str, cells: list[str]) -> str:
    keys = cells + ["measure"]
    on = " and ".join(f"s.{c} = b.{c}" for c in keys)
    sel = ", ".join(f"coalesce(s.{c}, b.{c}) as {c}" for c in keys)
    return f"""WITH {summ_sql_ctes}, {base_ctes}
select {sel}, coalesce(s.lwr_ci, 0) as lwr_ci, coalesce(s.median, 0) as median,
       coalesce(s.mean, 0) as mean, coalesce(s.upr_ci, 0) as upr_ci,
       coalesce(cast(b.value as double), 0) as baseline
from summ s full join basecells b on {on}"""


def ip_base_cells_cte(cells: list[str]) -> str:
    k = ", ".join(cells)
    return f"""
_bj AS (
  select dataset, fyear, sitetret, {f(AGE_CUT_SQL, 'age')} as age_group,
         case when classpat = '2' then 'ip_elective_daycase' else pod end as pod, tretspef, sushrg,
         maternity_delivery_in_spell, speldur + 1 as beddays, has_procedure
  from ip_baseline
),
_ba AS (select {k}, count(*) as admissions, sum(beddays) as beddays, sum(has_procedure) as procedures
        from _bj where {notnull(cells)} group by all),
basecells AS (
  select * from (
    select {k}, case when pod = 'op_procedure' then 'attendances' else 'admissions' end as measure,
           admissions as value from _ba
    union all select {k}, 'beddays', beddays from _ba where pod is distinct from 'op_procedure'
    union all select {k}, 'procedures', procedures from _ba where pod is distinct from 'op_procedure'
  ) t where value > 0
)"""


def attach_ip_sql() -> str:
    summ = ip_per_run_ctes(IP_HRG, True) + "," + summary_ctes("ipr", IP_HRG + ["measure"], 256)
    return attach_sql(summ, ip_base_cells_cte(IP_HRG), IP_HRG)


def attach_op_sql() -> str:
    summ = op_per_run_ctes(True) + "," + summary_ctes("opr", OP_CELLS + ["measure"], 16)
    k = ", ".join(OP_CELLS)
    base = f"""
basecells AS (
  select {k}, 'attendances' as measure, sum(attendances) as value from opb group by all
  union all
  select {k}, 'tele_attendances', sum(tele_attendances) from opb group by all
)"""
    return attach_sql(summ, base, OP_CELLS)


def attach_aae_sql() -> str:
    summ = aae_per_run_ctes(AAE_HRG, True) + "," + summary_ctes("aer", AAE_HRG + ["measure"], 16)
    k = ", ".join(AAE_HRG)
    base = f"""
basecells AS (select {k}, measure, sum(arrivals) as value from aeb group by all)"""
    return attach_sql(summ, base, AAE_HRG)


# --------------------------------------------------------------- completeness
COMPLETENESS_SQL = """
select prefix, has_directories, has_model_run_dirs, has_parquet_in_model_run, runs_with_parquet,
       is_full_results,
       case when is_full_results then 'ok' when not has_directories then 'flat'
            when not has_model_run_dirs then 'no_model_run_dirs'
            else 'no_parquet_in_model_run' end as status,
       is_full_results and runs_with_parquet = 256 as all_runs_present
from (
  select prefix, bool_or(has_dir) as has_directories, bool_or(has_run) as has_model_run_dirs,
         bool_or(has_pq) as has_parquet_in_model_run,
         count(distinct case when has_pq then regexp_extract(path, '/model_run=(\\d+)/', 1) end)
           as runs_with_parquet,
         bool_or(has_dir) and bool_or(has_run) and bool_or(has_pq) as is_full_results
  from (
    select path,
           case when len(string_split(path, '/')) > 5
                then array_to_string(list_slice(string_split(path, '/'), 1, 5), '/') else path end as prefix,
           contains(path, '/') as has_dir, contains(path, '/model_run=') as has_run,
           contains(path, '/model_run=') and ends_with(path, '/0.parquet') as has_pq
    from file_paths
  ) t group by prefix
) g"""


# --------------------------------------------------------------- national
def national_sample_cte(fraction: float, seed: int, year: int | None = None) -> str:
    keep = (f"where fyear = {year}" if year else "") if fraction >= 1 else (
        f"where ('0x' || substr(md5('{seed}:' || cast(rn as varchar)), 1, 15))::bigint"
        f" < {int(fraction * 2**60)}")
    return f"""
smp AS (select rn, fyear, dataset as source, 'NATIONAL' as dataset, 'NATIONAL' as sitetret, age, pod, grp, sushrg,
               speldur, classpat from ip_baseline {keep})"""


NAT_CELLS = ["los_group", "pod", "sushrg"]


def national_stats_sql(per_run_cte: str) -> str:
    """Brute force: cross join of runs and cells, zero where absent, then stats."""
    def stats(v: str) -> str:
        m, s, n = f"avg({v})", f"stddev_samp({v})", f"count({v})"
        return (f"round({m}, {R}) as mean_{v}, round({s}, {R}) as std_{v}, "
                f"round(greatest(0, {m} - 1.645 * ({s} / sqrt({n}))), {R}) as {v}_lower_ci, "
                f"round({m} + 1.645 * ({s} / sqrt({n})), {R}) as {v}_upper_ci")
    k = ", ".join(NAT_CELLS)
    on = " and ".join(f"c.{x} is not distinct from p.{x}" for x in NAT_CELLS)
    return f"""WITH {per_run_cte},
runs AS (select cast(range + 1 as int) as model_run from range(256)),
cells AS (select distinct {k} from pr),
filled AS (
  select r.model_run, {", ".join('c.' + x for x in NAT_CELLS)},
         coalesce(p.beddays, 0) as beddays, coalesce(p.admissions, 0) as admissions
  from runs r cross join cells c
  left join pr p on p.model_run = r.model_run and {on}
)
select {k}, {stats('beddays')}, {stats('admissions')} from filled group by all"""


def national_per_run_cte(fraction: float = 1.0, year: int | None = None) -> str:
    return national_sample_cte(fraction, 7, year) + f""",
pr AS (
  select r.model_run, {f(LOS_NATIONAL_SQL, 'r.speldur')} as los_group, s.pod, s.sushrg,
         cast(sum(r.speldur + 1) as bigint) as beddays, count(*) as admissions
  from smp s left join ip_runs r on s.rn = r.rn
  where r.model_run is not null
  group by all
)"""


def national_avoided_per_run_cte() -> str:
    return national_sample_cte(1.0, 7) + f""",
pr AS (
  select a.model_run, {f(LOS_NATIONAL_SQL, 'a.speldur')} as los_group,
         case when a.classpat = '2' then 'ip_elective_daycase'
              when a.classpat = '3' then 'ip_regular_day_attender'
              when a.classpat = '4' then 'ip_regular_night_attender'
              else 'ip_' || s.grp || '_admission' end as pod,
         s.sushrg, cast(sum(a.speldur + 1) as bigint) as beddays, count(*) as admissions
  from ip_avoided a left join smp s on a.rn = s.rn
  group by all
)"""


# --------------------------------------------------------------- run lists
COLLECT_RUNS_SQL = """
select scenario, dataset, pod, sitetret, measure,
       max(case when model_run = 0 then value end) as baseline,
       nullif(array_to_string(list(value order by model_run) filter (where model_run <> 0), ','), '')
         as model_runs,
       avg(value) filter (where model_run <> 0) as mean
from {src} group by scenario, dataset, pod, sitetret, measure"""


def a6(src: str, name: str) -> str:
    return f"""
{name} AS (
  select scenario, dataset, pod, sitetret, measure,
         max(case when model_run = 0 then value end) as baseline,
         avg(value) filter (where model_run <> 0) as mean
  from {src} group by all
)"""


def pct(old: str, new: str, scale: str = "100", rnd: int | None = None) -> str:
    ratio = f"({new} / {old} - 1)"
    if rnd is not None:
        ratio = f"round_even({ratio}, {rnd})"
    return (f"case when {old} is null or {new} is null then 0.0 "
            f"when {old} = 0 then case when {new} = 0 then 0.0 else 'Infinity'::double end "
            f"else abs({ratio}) * {scale} end")


# --------------------------------------------------------------- custom
def suppress_sql(src: str, full: list[str], group: list[str]) -> str:
    collapsed = [c for c in full if c not in group]
    keep = ", ".join(f"cast({c} as varchar) as {c}" if c in collapsed else c for c in full)
    grp = ", ".join(f"'grouped' as {c}" if c in collapsed else c for c in full)
    return f"""
select {keep}, value, false as is_grouped from {src} where value >= 5
union all
select {grp}, value, true as is_grouped from (
  select {", ".join(group)}, cast(sum(value) as bigint) as value from {src} where value < 5 group by all
) s"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # ----------------------------------------------------------- sources
    q["scan_baseline"] = """select dataset, fyear, rn, sitetret, age, pod, tretspef, has_procedure,
        speldur, classpat from ip_baseline"""
    q["scan_runs"] = "select rn, model_run, speldur, classpat from ip_runs"
    q["list_datasets"] = "select distinct fyear, dataset from ip_baseline"
    q["resolve_version"] = r"""
WITH v AS (
  select version, cast(regexp_extract(version, '^v?(\d+)\.(\d+)\.(\d+)', 1) as int) as major,
         cast(regexp_extract(version, '^v?(\d+)\.(\d+)\.(\d+)', 2) as int) as minor,
         cast(regexp_extract(version, '^v?(\d+)\.(\d+)\.(\d+)', 3) as int) as patch
  from data_versions where regexp_matches(version, '^v?(\d+)\.(\d+)\.(\d+)([-.+]?[A-Za-z][0-9A-Za-z.-]*)?$')
),
req AS (
  select distinct case when version = 'dev' then version
                       else array_to_string(list_slice(string_split(version, '.'), 1, 2), '.') end
                  as requested
  from data_versions
),
rp AS (
  select requested, cast(nullif(regexp_extract(requested, '^v?(\d+)(\.(\d+))?', 1), '') as int) as major,
         coalesce(cast(nullif(regexp_extract(requested, '^v?(\d+)(\.(\d+))?', 3), '') as int), 1000000) as minor
  from req
)
select requested,
       case when rp.major is null then 'N/A' else coalesce((
         select arg_max(v.version, v.major * 1000000 + v.minor * 1000 + v.patch) from v
         where v.major < rp.major or (v.major = rp.major and v.minor <= rp.minor)), 'N/A') end
         as resolved,
       requested as simplified,
       (select arg_max(version, major * 1000000 + minor * 1000 + patch) from v) as latest
from rp"""
    q["parse_paths"] = """
WITH p AS (select regexp_replace(path, '^full-model-results/', 'aggregated-model-results/') as path
           from file_paths),
s AS (select path, string_split(trim(path, '/'), '/') as parts from p),
v AS (select path, parts, len(parts) >= 5 and parts[1] = 'aggregated-model-results' as valid from s)
select path, valid,
       case when valid then parts[2] end as version, case when valid then parts[3] end as dataset,
       case when valid then parts[4] end as scenario, case when valid then parts[5] end as datetime,
       case when valid and regexp_matches(parts[5], '^\\d{8}_\\d{6}$') then parts[5] end as run_datetime,
       case when valid then concat_ws('/', 'aggregated-model-results', parts[2], parts[3], parts[4], parts[5]) end
         as aggregated_path,
       case when valid then concat_ws('/', 'full-model-results', parts[2], parts[3], parts[4], parts[5]) end
         as full_path
from v"""
    q["run_completeness"] = COMPLETENESS_SQL
    q["params_catalog"] = """
WITH p AS (
  select json_extract_string(json, '$.scenario') as scenario,
         json_extract_string(json, '$.dataset') as dataset,
         json_extract_string(json, '$.app_version') as app_version,
         cast(json_extract(json, '$.start_year') as int) as start_year,
         json_extract_string(json, '$.create_datetime') as create_datetime,
         cast(json_extract(json, '$.seed') as bigint) as seed,
         json_extract_string(json, '$.extra') as extra,
         coalesce(json_extract_string(json, '$."non-demographic_adjustment".variant'), 'ndg-test') as variant,
         coalesce(json_extract_string(json, '$."non-demographic_adjustment"."value-type"'),
                  'year-on-year-growth') as value_type,
         coalesce(json_extract(json, '$."non-demographic_adjustment".values'),
                  json_extract(json, '$."non-demographic_adjustment"')) as ndg
  from params_json
),
k AS (select p.*, unnest(json_keys(ndg)) as ndg_key from p),
v AS (select k.*, cast(json_extract(ndg, '$."' || ndg_key || '"') as double[]) as vals from k)
select scenario, dataset, app_version, start_year, create_datetime, seed, extra,
       variant as ndg_variant, value_type as ndg_value_type, ndg_key,
       cast(i - 1 as int) as ndg_pos, vals[i] as ndg_value
from v, range(1, len(vals) + 1) t(i)"""

    # ----------------------------------------------------------- filters
    q["filter_sites"] = "select rn, dataset, sitetret from ip_baseline where sitetret in ('S00', 'S03')"
    q["bands"] = f"""
select rn, {f(LOS_DETAILED_SQL, 'speldur')} as los_detailed, {f(LOS_AVOIDED_SQL, 'speldur')} as los_avoided,
       {f(LOS_CUSTOM_SQL, 'speldur')} as los_custom, {f(LOS_NATIONAL_SQL, 'speldur')} as los_national,
       {f(AGE_CUSTOM_SQL, 'age')} as age_custom, {f(AGE_CUT_SQL, 'age')} as age_cut
from ip_baseline"""
    q["op_pod"] = f"select rn, {OP_POD_SQL.format(p='')} as pod from op_baseline"

    # ----------------------------------------------------------- detailed
    cells = ["dataset", "pod", "sitetret", "measure"]
    q["run_summary"] = ("WITH rs AS (select dataset, pod, sitetret, measure, value from default_old "
                        "where model_run > 0)," + summary_ctes("rs", cells, 256) + "\nselect * from summ")
    q["detailed_ip_standard"] = detailed_ip_sql(IP_STD, hrg=False)
    q["detailed_ip_hrg"] = detailed_ip_sql(IP_HRG, hrg=True)
    q["sink_roundtrip"] = q["detailed_ip_standard"]
    q["detailed_op_standard"] = detailed_op_sql(hrg=False)
    q["detailed_op_hrg"] = detailed_op_sql(hrg=True)
    q["detailed_aae_standard"] = detailed_aae_sql(AAE_STD, hrg=False)
    q["detailed_aae_hrg"] = detailed_aae_sql(AAE_HRG, hrg=True)
    q["detailed_op_checked"] = q["detailed_op_standard"]
    q["detailed_aae_checked"] = q["detailed_aae_standard"]
    q["run_row_counts"] = """
WITH r AS (select * from op_runs),
e AS (select cast(range + 1 as int) as model_run from range(16))
select e.model_run, count(r.rn) as run_rows, (select count(*) from op_baseline) as baseline_rows,
       count(r.rn) = (select count(*) from op_baseline) as ok
from e left join r on e.model_run = r.model_run group by e.model_run"""
    q["run_row_counts_aae"] = """
WITH e AS (select cast(range + 1 as int) as model_run from range(16))
select e.model_run, count(r.rn) as run_rows, (select count(*) from aae_baseline) as baseline_rows,
       count(r.rn) = (select count(*) from aae_baseline) as ok
from e left join aae_runs r on e.model_run = r.model_run group by e.model_run"""
    av = [*IP_BY, "pod", "los_group", "sushrg"]
    q["activity_avoided"] = ("WITH " + ip_per_run_ctes(av, False, runs="ip_avoided", los=LOS_AVOIDED_SQL,
                                                       positive=False) + ","
                             + summary_ctes("ipr", av + ["measure"], 256) + "\nselect * from summ")
    q["attach_baseline_ip"] = attach_ip_sql()
    q["attach_baseline_op"] = attach_op_sql()
    q["attach_baseline_aae"] = attach_aae_sql()
    done = f"""
comp AS ({COMPLETENESS_SQL}),
done AS (select distinct string_split(prefix, '/')[3] as dataset from comp
         where all_runs_present and string_split(prefix, '/')[4] = 'scn-ip_elective_admission')"""
    q["pipeline_hrg_baseline"] = f"""
WITH ip AS ({q['attach_baseline_ip']}),
op AS ({q['attach_baseline_op']}),
aae AS ({q['attach_baseline_aae']}),{done}
select * from (
  select *, 'ip' as activity from ip
  union all by name select *, 'op' as activity from op
  union all by name select *, 'aae' as activity from aae
) t where dataset in (select dataset from done)"""

    # ----------------------------------------------------------- run lists
    q["collect_runs"] = COLLECT_RUNS_SQL.format(src="default_old")
    q["collect_runs_no_baseline"] = """
select scenario, dataset, pod, sitetret, measure,
       array_to_string(list(value order by model_run), ',') as model_runs, avg(value) as mean
from default_old group by scenario, dataset, pod, sitetret, measure"""

    def reconciled(kind: str, ctes: str, measures: list[str], cell: str, total: str, tolerance: float) -> str:
        m = ", ".join(f"'{x}'" for x in measures)
        return f"""WITH {ctes},
det AS (select measure, sum({cell.format(c='mean')}) as detailed from summ where measure in ({m}) group by all),
dft AS (select p.pair, d.measure, sum(d.mean) as "default" from default_means d, (values ('match'), ('broken')) p(pair)
        where d.activity = '{kind}' and d.measure in ({m}) and (p.pair = 'match' or d.dataset <> 'D0') group by all),
j AS (select pair, measure, cast({total.format(c='round("default", 6)')} as double) as "default",
             cast({total.format(c='round(detailed, 6)')} as double) as detailed from dft join det using (measure))
select pair, measure, "default", detailed, detailed - "default" as diff, abs(detailed - "default") <= {tolerance} as ok
from j"""

    q["reconcile"] = reconciled("ip", ip_per_run_ctes(IP_STD, False) + "," + summary_ctes("ipr", IP_STD + ["measure"], 256),
                                ["beddays", "admissions"], "{c}", "trunc({c})", 1)
    q["reconcile_op"] = reconciled("op", op_per_run_ctes(False) + "," + summary_ctes("opr", OP_CELLS + ["measure"], 16),
                                   ["attendances", "tele_attendances"], "round_even({c}, 1)", "trunc({c})", 1)
    q["reconcile_aae"] = reconciled("aae", aae_per_run_ctes(AAE_STD, False) + "," + summary_ctes("aer", AAE_STD + ["measure"], 16),
                                    ["ambulance", "walk-in"], "{c}", "round_even({c}, 0)", 1)

    # ----------------------------------------------------------- baselines
    q["baseline_ip"] = """
select dataset, fyear, sitetret, grp, pod, tretspef, count(rn) as admissions,
       cast(sum(speldur + 1) as bigint) as beddays, cast(sum(speldur) as bigint) as speldur
from ip_baseline group by all"""
    q["baseline_op"] = """
select dataset, sitetret, grp, tretspef, type, cast(sum(attendances) as bigint) as attendances,
       cast(sum(tele_attendances) as bigint) as tele_attendances
from op_baseline group by all"""
    q["baseline_aae"] = """
select dataset, sitetret, hsagrp, aedepttype, attendance_category, cast(sum(arrivals) as bigint) as arrivals
from aae_baseline group by all"""

    ipk = ["dataset", "fyear", "sitetret", "custom_age_groups", "custom_los_groups", "tretspef", "pod",
           "maternity_delivery_in_spell"]
    q["custom_baseline_ip"] = f"""
WITH b AS (
  select dataset, fyear, sitetret, {f(AGE_CUSTOM_SQL, 'age')} as custom_age_groups,
         {f(LOS_CUSTOM_SQL, 'speldur')} as custom_los_groups, tretspef,
         case when classpat = '2' then 'ip_elective_daycase' else pod end as pod,
         maternity_delivery_in_spell, speldur + 1 as beddays, has_procedure
  from ip_baseline
),
a AS (select {", ".join(ipk)}, count(*) as admissions, sum(beddays) as beddays,
             sum(has_procedure) as procedures from b where {notnull(ipk)} group by all),
cells AS (
  select * from (
    select {", ".join(ipk)}, 'admissions' as measure, cast(admissions as bigint) as value from a
    union all select {", ".join(ipk)}, 'beddays', cast(beddays as bigint) from a
    union all select {", ".join(ipk)}, 'procedures', cast(procedures as bigint) from a
  ) t where value > 0
)""" + suppress_sql("cells", ipk + ["measure"], ["dataset", "fyear", "pod", "measure"])

    def custom_op(table: str, by: list[str]) -> str:
        opk = [*by, "sitetret", "custom_age_groups", "tretspef", "pod"]
        return f"""
WITH b AS (
  select {", ".join(by)}, sitetret, {f(AGE_CUSTOM_SQL, 'age')} as custom_age_groups, tretspef,
         {OP_POD_SQL.format(p='')} as pod, attendances, tele_attendances
  from {table}
),
cells AS (
  select {", ".join(opk)}, 'attendances' as measure, cast(sum(attendances) as bigint) as value
  from b where {notnull(opk)} group by all
  union all
  select {", ".join(opk)}, 'tele_attendances', cast(sum(tele_attendances) as bigint)
  from b where {notnull(opk)} group by all
)""" + suppress_sql("cells", opk + ["measure"], [*by, "pod"])

    def custom_aae(table: str, by: list[str]) -> str:
        aek = [*by, "sitetret", "pod", "custom_age_groups", "aedepttype", "acuity"]
        return f"""
WITH b AS (
  select {", ".join(by)}, sitetret, pod, {f(AGE_CUSTOM_SQL, 'age')} as custom_age_groups, aedepttype, acuity,
         case when is_ambulance then 'ambulance' else 'walk-in' end as measure, arrivals
  from {table}
),
cells AS (select {", ".join(aek)}, measure, cast(sum(arrivals) as bigint) as value
          from b where {notnull(aek + ['measure'])} group by all)""" + suppress_sql(
            "cells", aek + ["measure"], [*by, "pod"])

    q["custom_baseline_op"] = custom_op("op_baseline", ["dataset"])
    q["custom_baseline_aae"] = custom_aae("aae_baseline", ["dataset"])
    customs = {a: q[f"custom_baseline_{a}"] for a in ("ip", "op", "aae")}

    def stacked(parts: dict[str, str]) -> str:
        return " union all by name ".join(f"select *, '{a}' as activity from ({sql}) {a}_x" for a, sql in parts.items())

    q["custom_baseline_years"] = stacked({
        "ip": q["custom_baseline_ip"], "op": custom_op("op_years", IP_BY), "aae": custom_aae("aae_years", IP_BY)})
    q["pipeline_standard"] = f"WITH {done.strip()} select * from ({stacked(customs)}) t where dataset in (select dataset from done)"
    sited = {a: sql.replace(f"from {a}_baseline", f"from (select * from {a}_baseline where sitetret in ({s})) w")
             for (a, sql), s in zip(customs.items(), ["'S00', 'S03'", "'S01'", "select sitetret from aae_baseline"])}
    q["custom_baseline_sites"] = stacked(sited)
    sk = ["dataset", "sitetret", "pod", "tretspef", "sushrg"]
    q["suppress_small_counts"] = f"""
WITH cells AS (select {", ".join(sk)}, count(rn) as value from ip_baseline
               where {notnull(sk)} group by all)""" + suppress_sql("cells", sk, ["dataset", "pod"])

    # ----------------------------------------------------------- national
    q["sample_rows"] = "WITH " + national_sample_cte(0.01, 7) + """
select rn, source as dataset, fyear from smp"""
    q["national_baseline"] = "WITH " + national_sample_cte(1.0, 7) + f"""
select {f(LOS_NATIONAL_SQL, 'speldur')} as los_group, pod, sushrg,
       cast(sum(speldur + 1) as bigint) as beddays, count(*) as admissions
from smp group by all"""
    q["national_results"] = national_stats_sql(national_per_run_cte())
    q["national_avoided"] = national_stats_sql(national_avoided_per_run_cte())
    q["fill_missing_groups"] = "WITH " + national_per_run_cte() + """,
runs AS (select distinct model_run from pr),
cells AS (select distinct los_group, pod, sushrg from pr)
select r.model_run, c.los_group, c.pod, c.sushrg,
       coalesce(p.beddays, 0) as beddays, coalesce(p.admissions, 0) as admissions
from runs r cross join cells c
left join pr p on p.model_run = r.model_run and c.los_group is not distinct from p.los_group
  and c.pod is not distinct from p.pod and c.sushrg is not distinct from p.sushrg"""
    nat = national_stats_sql(national_per_run_cte())
    q["national_reconcile"] = f"""
WITH nat AS ({nat.replace(f'round(', '(').replace(f', {R})', ')')}),""" + a6("default_old", "d6") + """,
det AS (select 'admissions' as measure, sum(mean_admissions) as detailed from nat where starts_with(pod, 'ip_')
        union all select 'beddays', sum(mean_beddays) from nat where starts_with(pod, 'ip_')),
dft AS (select measure, sum(mean) as "default" from d6
        where starts_with(pod, 'ip_') and measure in ('admissions', 'beddays') group by all),
j AS (select coalesce(a.measure, b.measure) as measure, coalesce(a."default", 0) as "default",
             coalesce(b.detailed, 0) as detailed
      from dft a full join det b on a.measure = b.measure)
select measure, round("default", 6) as "default", round(detailed, 6) as detailed,
       round(detailed - "default", 6) as diff, abs(detailed - "default") <= 1e-6 as ok from j"""

    # means over a fixed number of runs add up to totals over the runs
    q["national_reconcile_years"] = """
WITH det AS (
  select b.fyear, 'admissions' as measure, count(*) / 256 as t from ip_baseline b join ip_runs r on b.rn = r.rn
  where starts_with(b.pod, 'ip_') and b.fyear in (1995, 1996) group by all
  union all
  select b.fyear, 'beddays', sum(r.speldur + 1) / 256 from ip_baseline b join ip_runs r on b.rn = r.rn
  where starts_with(b.pod, 'ip_') and b.fyear in (1995, 1996) group by all),
dft AS (
  select p.pair, case when p.pair = 'match' then fyear else 3991 - fyear end as fyear, measure, sum(mean) as t
  from default_means_national, (values ('match'), ('other_year')) p(pair)
  where starts_with(pod, 'ip_') and fyear in (1995, 1996) group by all)
select pair, fyear, measure, round(dft.t, 6) as "default", round(det.t, 6) as detailed,
       round(det.t - dft.t, 6) as diff, abs(det.t - dft.t) <= 1e-6 as ok
from dft join det using (fyear, measure)"""

    # ----------------------------------------------------------- cohorts
    def op_mit(keys: list[str], site: bool, table: str = "op_baseline") -> str:
        k = ", ".join(keys)
        def cs(pred: str, col: str, alias: str) -> str:
            e = f"sum(case when {pred} then {col} end)"
            if site:
                e = f"coalesce({e}, 0)"
            return f"cast({e} as bigint) as {alias}"
        tele = "not has_procedures"
        gp, cons, fu = "is_gp_ref and is_first", "is_cons_cons_ref", "not is_first and not has_procedures"
        cols = [cs(tele, "attendances", "convert_to_tele_attendances")]
        if site:
            cols.append(cs(tele, "tele_attendances", "convert_to_tele_tele_attendances"))
        for name, pred in (("gp_referred", gp), ("consultant_to_consultant_referrals", cons),
                           ("followup_reduction", fu)):
            cols += [cs(pred, "attendances", f"{name}_attendances"),
                     cs(pred, "tele_attendances", f"{name}_tele_attendances")]
        return (f"select {k}, {', '.join(cols)} from {table} where {notnull(keys)} group by all "
                f"having bool_or({tele} or {gp} or {cons} or {fu})")

    q["mitigators_op"] = op_mit(["dataset", "type"], False)
    q["mitigators_op_site"] = op_mit(["dataset", "sitetret", "type"], True)

    def aae_mit(keys: list[str], table: str = "aae_baseline") -> str:
        flags = ["is_discharged_no_treatment", "is_frequent_attender", "is_left_before_treatment",
                 "is_low_cost_referred_or_discharged"]
        cols = ", ".join(f"cast(coalesce(sum(case when {x} then arrivals end), 0) as bigint) as {x}"
                         for x in flags)
        return f"select {', '.join(keys)}, {cols} from {table} where {notnull(keys)} group by all"

    q["mitigators_aae"] = aae_mit(["dataset", "hsagrp"])
    q["mitigators_aae_site"] = aae_mit(["dataset", "sitetret", "hsagrp"])
    q["mitigators_op_years"] = op_mit([*IP_BY, "type"], False, "op_years")
    q["mitigators_op_site_years"] = op_mit([*IP_BY, "sitetret", "type"], True, "op_years")
    q["mitigators_aae_years"] = aae_mit([*IP_BY, "hsagrp"], "aae_years")
    q["mitigators_aae_site_years"] = aae_mit([*IP_BY, "sitetret", "hsagrp"], "aae_years")
    yk = [*IP_BY, "sitetret", "grp", "tretspef", "type"]
    q["baseline_op_years"] = f"""
select {", ".join(yk)}, cast(sum(attendances) as bigint) as attendances,
       cast(sum(tele_attendances) as bigint) as tele_attendances from op_years where {notnull(yk)} group by all"""
    yk = [*IP_BY, "sitetret", "hsagrp", "aedepttype", "attendance_category"]
    q["baseline_aae_years"] = f"""
select {", ".join(yk)}, cast(sum(arrivals) as bigint) as arrivals from aae_years where {notnull(yk)} group by all"""
    q["strategy_efficiencies"] = """
select b.dataset, b.fyear, s.strategy, b.sitetret, cast(sum(b.speldur) as bigint) as speldur,
       cast(sum(b.speldur + 1) as bigint) as beddays, count(s.rn) as admissions
from strategies s join ip_baseline b on s.rn = b.rn where s.kind = 'ef' group by all"""
    q["strategy_avoidance"] = """
select b.dataset, b.fyear, s.strategy, b.sitetret, count(s.rn) as admissions,
       round(sum(s.sample_rate), 6) as sample_rate_sum, cast(sum(b.speldur + 1) as bigint) as beddays
from strategies s join ip_baseline b on s.rn = b.rn where s.kind = 'aa' group by all"""

    # ----------------------------------------------------------- comparisons
    q["compare_results"] = "WITH " + a6("default_old", "o6") + "," + a6("default_new", "n6") + f""",
o AS (select dataset, pod, measure, cast(coalesce(sum(baseline), 0) as double) as baseline_old,
             cast(coalesce(sum(mean), 0) as double) as mean_old from o6 group by all),
n AS (select dataset, pod, measure, cast(coalesce(sum(baseline), 0) as double) as baseline_new,
             cast(coalesce(sum(mean), 0) as double) as mean_new from n6 group by all),
j AS (select coalesce(o.dataset, n.dataset) as dataset, coalesce(o.pod, n.pod) as pod,
             coalesce(o.measure, n.measure) as measure, baseline_old, mean_old, baseline_new, mean_new,
             case when o.dataset is not null and n.dataset is not null then 'both'
                  when o.dataset is not null then 'only_old' else 'only_new' end as status
      from o full join n on o.dataset = n.dataset and o.pod = n.pod and o.measure = n.measure)
select dataset, pod, measure, round(baseline_old, {R}) as baseline_old, round(mean_old, {R}) as mean_old,
       round(baseline_new, {R}) as baseline_new, round(mean_new, {R}) as mean_new,
       round({pct('mean_old', 'mean_new')}, {R}) as pct_diff, status
from j"""
    sck = ["dataset", "activity_type", "pod", "change_factor", "strategy", "measure"]
    on = " and ".join(f"o.{c} = n.{c}" for c in sck)
    q["compare_stepcounts"] = f"""
WITH o AS (select {", ".join(sck)}, avg(value) as mean_old from step_counts_old group by all),
n AS (select {", ".join(sck)}, avg(value) as mean_new from step_counts_new group by all),
j AS (select {", ".join(f"coalesce(o.{c}, n.{c}) as {c}" for c in sck)},
             coalesce(mean_old, 0) as mean_old, coalesce(mean_new, 0) as mean_new,
             case when o.dataset is not null and n.dataset is not null then 'both'
                  when o.dataset is not null then 'only_old' else 'only_new' end as status
      from o full join n on {on})
select {", ".join(sck)}, round(mean_old, {R}) as mean_old, round(mean_new, {R}) as mean_new,
       round({pct('mean_old', 'mean_new')}, {R}) as pct_diff, status from j"""
    q["compare_default"] = "WITH " + a6("default_old", "o6") + "," + a6("default_new", "n6") + f"""
select o.dataset, o.pod, o.sitetret, o.measure,
       round(o.baseline, {R}) as baseline_scn, round(o.mean, {R}) as mean_scn,
       round({pct('o.mean', 'o.baseline', '1', 4)}, {R}) as pct_diff_scn,
       round(n.baseline, {R}) as baseline_scn_testdev, round(n.mean, {R}) as mean_scn_testdev,
       round({pct('n.mean', 'n.baseline', '1', 4)}, {R}) as pct_diff_scn_testdev
from o6 o join n6 n on o.dataset is not distinct from n.dataset and o.pod is not distinct from n.pod
  and o.sitetret is not distinct from n.sitetret and o.measure is not distinct from n.measure"""
    q["compare_default_rowwise"] = "WITH " + a6("default_old", "o6") + f""",
w AS (select dataset, pod, sitetret, measure, baseline,
             lag(baseline) over (partition by dataset order by pod, sitetret, measure) as prev from o6)
select dataset, pod, sitetret, measure, round(baseline, {R}) as baseline,
       round({pct('prev', 'baseline', '1', 4)}, {R}) as pct_diff from w"""

    def release(dev: str, rel: str, keys: list[str], aggs: list[tuple[str, str]]) -> str:
        k = ", ".join(keys)
        a = ", ".join(f"{expr} as {name}" for name, expr in aggs)
        sel = []
        for name, _ in aggs:
            sel += [f"coalesce(d.{name}, 0) as dev_{name}", f"coalesce(r.{name}, 0) as release_{name}"]
        eq = [f"coalesce(d.{n}, 0) = coalesce(r.{n}, 0)" for n, _ in aggs]
        on = " and ".join(f"d.{c} = r.{c}" for c in keys)
        return f"""
WITH d AS (select {k}, {a} from {dev} where {notnull(keys)} group by all),
r AS (select {k}, {a} from {rel} where {notnull(keys)} group by all)
select {", ".join(f"coalesce(d.{c}, r.{c}) as {c}" for c in keys)}, {", ".join(sel)},
       {", ".join(f"{e} as {n}_equal" for e, (n, _) in zip(eq, aggs))},
       {" and ".join(eq)} as all_equal
from d full join r on {on}"""

    q["release_check_ip"] = release("ip_baseline", "ip_baseline_release", ["dataset", "pod"], [
        ("admissions", "count(rn)"), ("beddays", "cast(sum(speldur + 1) as bigint)")])
    op_dev = f"(select *, {OP_POD_SQL.format(p='')} as pod from op_baseline)"
    op_rel = f"(select *, {OP_POD_SQL.format(p='')} as pod from op_baseline_release)"
    q["release_check_op"] = release(op_dev, op_rel, ["dataset", "pod"], [
        ("attendances", "cast(sum(attendances) as bigint)"),
        ("tele_attendances", "cast(sum(tele_attendances) as bigint)")])
    q["release_check_aae"] = release("aae_baseline", "aae_baseline_release", ["dataset", "pod", "grp"], [
        ("arrivals", "cast(sum(arrivals) as bigint)")])
    def release_of(dev: str, rel: str, keys: list[str], cols: list[str]) -> str:
        on = " and ".join(f"d.{c} = r.{c}" for c in keys)
        sel = ", ".join(f"coalesce(d.{c}, 0) as dev_{c}, coalesce(r.{c}, 0) as release_{c}, "
                        f"coalesce(d.{c}, 0) = coalesce(r.{c}, 0) as {c}_equal" for c in cols)
        both = " and ".join(f"coalesce(d.{c}, 0) = coalesce(r.{c}, 0)" for c in cols)
        return (f"WITH d AS ({dev}), r AS ({rel}) select {', '.join(f'coalesce(d.{c}, r.{c}) as {c}' for c in keys)}, "
                f"{sel}, {both} as all_equal from d full join r on {on}")

    names = ["gp_referred", "consultant_to_consultant_referrals", "followup_reduction"]
    q["release_check_op_mitigators"] = release_of(
        q["mitigators_op"], q["mitigators_op"].replace("op_baseline", "op_baseline_release"), ["dataset", "type"],
        ["convert_to_tele_attendances", *[f"{n}_{m}" for n in names for m in ("attendances", "tele_attendances")]])
    q["release_check_aae_mitigators"] = release_of(
        q["mitigators_aae"], q["mitigators_aae"].replace("aae_baseline", "aae_baseline_release"), ["dataset", "hsagrp"],
        ["is_discharged_no_treatment", "is_frequent_attender", "is_left_before_treatment",
         "is_low_cost_referred_or_discharged"])
    verdicts = []
    for kind, values in (("ip", ["admissions", "beddays"]), ("op", ["attendances", "tele_attendances"]), ("aae", ["arrivals"])):
        for v in [*values, "all"]:
            verdicts.append(f"select '{v}' as value, bool_and({v}_equal) as all_rows_equal, "
                            f"count(*) filter (where not {v}_equal) as rows_differing, '{kind}' as activity from c_{kind}")
    q["release_verdict"] = "WITH " + ", ".join(f"c_{k} AS ({q[f'release_check_{k}']})" for k in ("ip", "op", "aae")) + (
        " " + " union all ".join(verdicts))
    q["release_check_mitigators"] = f"""
WITH d AS (select kind, strategy, count(rn) as cnt, sum(sample_rate) as sr from strategies group by all),
r AS (select kind, strategy, count(rn) as cnt, sum(sample_rate) as sr from strategies_release group by all)
select coalesce(d.kind, r.kind) as kind, coalesce(d.strategy, r.strategy) as strategy,
       d.cnt as count_dev, r.cnt as count_release, round(d.sr, {R}) as sample_rate_dev,
       round(r.sr, {R}) as sample_rate_release,
       d.cnt is not distinct from r.cnt as count_equal, d.sr is not distinct from r.sr as sample_rate_equal,
       d.cnt is not distinct from r.cnt and d.sr is not distinct from r.sr as all_equal,
       d.cnt - r.cnt as count_diff
from d full join r on d.kind = r.kind and d.strategy = r.strategy"""

    q.update(_stored_oracle(q))
    return {k: duckdb_with(v) for k, v in q.items()}


def _stored_oracle(q: dict[str, str]) -> dict[str, str]:
    """Keys over stored layouts: the same rows as the tables they were written from."""
    ip = "rn, dataset, fyear, sitetret, age, pod, grp, tretspef, sushrg, speldur, classpat"
    s = {
        "layout_baseline": f"""
select 'ip' as activity, dataset, fyear, rn, sitetret, age, pod, grp, case when fyear >= 1995 then has_procedure end as has_procedure,
       cast(speldur as bigint) as value from ip_baseline
union all
select 'op', dataset, cast(2000 + rn % 3 as int), rn, sitetret, age, type, grp, null, cast(attendances as bigint) from op_baseline
union all
select 'aae', dataset, cast(2000 + rn % 3 as int), rn, sitetret, age, pod, grp, null, cast(arrivals as bigint) from aae_baseline""",
        "layout_runs": "select rn, model_run, speldur, classpat from ip_runs",
        "layout_datasets": """
select 'ip' as activity, fyear, dataset from ip_baseline group by all
union all select 'op', cast(2000 + rn % 3 as int), dataset from op_baseline group by all
union all select 'aae', cast(2000 + rn % 3 as int), dataset from aae_baseline group by all""",
        "layout_release_check": q["release_check_ip"],
        "scan_baseline_flat": f"select {ip} from ip_baseline",
        "listing_completeness": """
select 'full-model-results/v4.1/' || b.dataset || '/scn/20250101_100000' as prefix, 'ok' as status,
       count(distinct r.model_run) as runs_with_parquet, count(distinct r.model_run) = 256 as all_runs_present
from ip_runs r join ip_baseline b on r.rn = b.rn group by b.dataset""",
        "params_fields": """
WITH k AS (select json_extract_string(json, '$.dataset') as dataset, json_extract_string(json, '$.scenario') as scenario,
                  json_extract_string(json, '$.create_datetime') as create_datetime, json, unnest(json_keys(json)) as field
           from params_json)
select dataset, scenario, create_datetime, field,
       case when field = 'non-demographic_adjustment' then json_extract_string(json, '$."non-demographic_adjustment".variant')
            else json_extract_string(json, '$."' || field || '"') end as value from k""",
        "params_upgraded": """
WITH k AS (select json_extract_string(json, '$.dataset') as dataset, json_extract_string(json, '$.scenario') as scenario,
                  json_extract_string(json, '$.create_datetime') as create_datetime, json, unnest(json_keys(json)) as field
           from params_json),
n AS (select *, json_extract(json, '$."non-demographic_adjustment"') as ndg, '$."non-demographic_adjustment"' as at from k)
select dataset, scenario, create_datetime, field,
       case when field <> 'non-demographic_adjustment' then json_extract_string(json, '$."' || field || '"')
            else coalesce(json_extract_string(ndg, '$.variant'), 'ndg-test') || '/'
                 || coalesce(json_extract_string(ndg, '$."value-type"'), 'year-on-year-growth') || '/'
                 || cast(cast(json_extract(coalesce(json_extract(ndg, '$.values'), ndg), '$.elective[0]') as double) as varchar) end as value
from n""",
        "product_refresh": """
select b.dataset, b.fyear, b.pod, cast(sum(speldur + 1) as bigint) as beddays, count(*) as admissions from ip_baseline b group by all""",
        "results_written": "select *, activity <> 'op' as written_late from (" + " union all by name ".join(
            f"select *, '{a}' as activity from ({q[f'custom_baseline_{a}']}) {a}_x" for a in ("ip", "op", "aae")) + ") t",
        "runs_in_batches": q["run_summary"],
        "reconcile_cells": "WITH " + ip_per_run_ctes(IP_STD, False) + "," + summary_ctes("ipr", IP_STD + ["measure"], 256) + """,
det AS (select dataset, fyear, measure, sum(cast(mean as decimal(28,12))) as d from summ
        where measure in ('beddays', 'admissions') group by all),
src AS (select p.pair, m.dataset, m.fyear, m.measure, sum(cast(m.mean as decimal(28,12))) + max(case
          when p.pair = 'opposite' and m.measure = 'beddays' and m.dataset = 'D0' then 5
          when p.pair = 'opposite' and m.measure = 'beddays' and m.dataset = 'D1' then -5 else 0 end) as t
        from default_means_year m, (values ('match'), ('opposite')) p(pair) group by all)
select pair, dataset, fyear, measure, cast(t as double) as "default", cast(d as double) as detailed,
       cast(d - t as double) as diff, d = t as ok
from src join det using (dataset, fyear, measure)""",
        "baseline_levels": """
select 'dataset' as level, dataset, fyear, null as sitetret, null as pod, null as sushrg, count(*) as admissions,
       cast(sum(speldur + 1) as bigint) as beddays from ip_baseline group by dataset, fyear
union all
select 'pod', dataset, fyear, null, pod, null, count(*), cast(sum(speldur + 1) as bigint) from ip_baseline group by dataset, fyear, pod
union all
select 'site', dataset, fyear, sitetret, pod, null, count(*), cast(sum(speldur + 1) as bigint)
from ip_baseline group by dataset, fyear, sitetret, pod
union all
select 'hrg', dataset, fyear, null, null, sushrg, count(*), cast(sum(speldur + 1) as bigint)
from ip_baseline where sushrg is not null group by dataset, fyear, sushrg""",
        "national_year": national_stats_sql(national_per_run_cte(year=1995)),
    }
    for key in ("national_results", "national_avoided", "strategy_efficiencies", "strategy_avoidance"):
        s[f"{key}_renumbered"] = q[key]
    return s
