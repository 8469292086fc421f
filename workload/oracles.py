"""The same results in SQL over the given tables."""

from __future__ import annotations

_MONTHLY = """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
       strftime(o_orderdate, '%Y-%m-01') as report_dt
from orders
"""

_AUDIT = """
select cast(event_id % 2147483647 as integer) as ctl_loading,
       strftime(ts, '%Y-%m-%d %H:%M:%S') as ctl_validfrom,
       'report_dt=' || strftime(ts, '%Y-%m-%d') as partitions,
       case when event_type = 'error' then 1 else 0 end as is_force_load,
       cast(user_id % 4 as integer) as last_success_step,
       3 as last_step_in_general,
       user_id as count_rows,
       1 as is_change
from events
"""

_LAST_STEP = f"""
select max(last_success_step) as last_step
from ({_AUDIT})
where ctl_validfrom = (select max(ctl_validfrom) from ({_AUDIT}))
"""

_PREVIOUS = f"""
select count_rows as previous
from ({_AUDIT})
order by ctl_validfrom desc, ctl_loading desc
limit 1
"""


def _mart(load_id: int, run_start: str, month: str) -> str:
    return f"""
    select {load_id} as ctl_loading, '{run_start}' as ctl_validfrom,
           o.o_orderkey, o.o_custkey, c.c_mktsegment, c.c_nationkey,
           cast(o.o_totalprice as float) as total,
           strftime(o.o_orderdate, '%Y-%m-01') as report_dt
    from orders o left join customer c on o.o_custkey = c.c_custkey
    where strftime(o.o_orderdate, '%Y-%m-01') = '{month}'
    """


_RUN = "2024-01-16 06:00:00"
_MONTH = "2001-07-01"

_COUNT_AFTER_LOSS = f"""
(select count(*) from ({_MONTHLY}) where not (report_dt = '{_MONTH}' and o_orderstatus = 'O'))
"""

_NEWEST = f"(select 'report_dt=' || max(report_dt) from ({_MONTHLY}))"

ORACLES = {
    "scan_table": f"select o_orderkey, o_totalprice, report_dt from ({_MONTHLY})",
    "scan_partition": f"""
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
        from ({_MONTHLY}) where report_dt = '{_MONTH}'""",
    "scan_partition_path": f"""
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
        from ({_MONTHLY}) where report_dt = '{_MONTH}'""",
    "list_partitions": f"select distinct 'report_dt=' || report_dt as partition from ({_MONTHLY})",
    "last_partition": f"""
        select distinct 'report_dt=' || report_dt as partition
        from ({_MONTHLY}) order by 1 desc limit 1""",
    "partition_inventory": f"""
        select distinct report_dt, true as all_parquet, true as files_agree from ({_MONTHLY})""",
    "partition_sizes": f"select distinct report_dt, true as bytes_agree from ({_MONTHLY})",
    "touched_partitions": f"select distinct report_dt from ({_MONTHLY}) where o_totalprice > 499000",
    "create_mart": _MONTHLY,
    "recreate_mart": f"""
        select o_orderkey, cast(null as varchar) as note, report_dt from ({_MONTHLY})""",
    "recreate_types": f"""
        select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as integer) as o_custkey,
               cast(cast(o_totalprice as decimal(12, 2)) as varchar) as price, report_dt
        from ({_MONTHLY})""",
    "recover_partitions": f"select o_orderkey, o_custkey, report_dt from ({_MONTHLY})",
    "overwrite_partition": f"""
        select o_orderkey, report_dt,
               case when report_dt = '{_MONTH}' then -o_totalprice else o_totalprice end as o_totalprice
        from ({_MONTHLY})""",
    "overwrite_empty": f"select o_orderkey, o_totalprice, report_dt from ({_MONTHLY})",
    "audit_append": f"""
        {_AUDIT}
        union all
        select -1, '{_RUN}', null, null, null, null, (select count(*) from orders), null""",
    "truncate_partitions": f"""
        select o_orderkey, report_dt from ({_MONTHLY})
        where report_dt not between '1996-03-01' and '2000-10-01'""",
    "truncate_external": f"""
        select o_orderkey, report_dt from ({_MONTHLY})
        where report_dt not between '1996-03-01' and '2000-10-01'""",
    "run_stats": f"""
        select 7 as loading_id, 42 as entity_id, 1 as stat_id, '2024-01-16' as value
        union all
        select 7, 42, 2, case when (select count(*) from orders) is distinct from
                                   (select previous from ({_PREVIOUS})) then '1' else '0' end
        union all
        select 7, 42, 5, (select max(report_dt) from ({_MONTHLY}))
        union all
        select 7, 42, 11, '{_RUN}'
        union all
        select 7, 42, 15, 'true'""",
    "stamp_load": f"""
        select 7 as ctl_loading, '{_RUN}' as ctl_validfrom, o_orderkey, o_custkey from orders""",
    "filter_report_date": f"""
        select o_orderkey, o_totalprice, report_dt from ({_MONTHLY}) where report_dt = '{_MONTH}'""",
    "narrow_cast": """
        select o_orderkey,
               try_cast(o_orderkey * 7 as smallint) as key_small,
               try_cast(floor(o_totalprice) as smallint) as price_small,
               cast(substr(o_orderpriority, 1, 1) as smallint) as priority_small,
               cast(o_totalprice as float) as price_float,
               try_cast(o_totalprice * 1e35 as float) as price_huge
        from orders""",
    "partition_value": f"""
        select o_orderkey, report_dt as date_value, o_orderstatus as status_value, '' as absent_value
        from ({_MONTHLY})""",
    "report_date": f"""
        select o_orderkey, report_dt as first_date, report_dt as suffix from ({_MONTHLY})""",
    "retention_cutoff": """
        select o_orderkey,
               strftime(t - interval '14 months', '%Y-%m-%d %H:%M:%S') as months_only,
               strftime(t - interval '25 months' - interval '3 days', '%Y-%m-%d %H:%M:%S') as mixed
        from (select o_orderkey,
                     date_trunc('day', o_orderdate) + interval '6 hours 30 minutes' as t
              from orders)""",
    "target_file_count": "select doc_id, n_chars // 512 + 1 as files from documents",
    "change_flag": f"""
        select report_dt,
               case when nullif(count(*) filter (where o_orderstatus = 'F'), 0)
                         is distinct from count(*) then 1 else 0 end as is_change,
               0 as same, 1 as forced
        from ({_MONTHLY}) group by report_dt""",
    "mart_left_join": f"""
        select o.o_orderkey, o.o_custkey, o.o_totalprice as total, o.report_dt,
               c.c_mktsegment, c.c_nationkey
        from ({_MONTHLY}) o left join customer c on o.o_custkey = c.c_custkey""",
    "left_join_unmatched": """
        select d.doc_id, d.lang, d.n_chars, l.quality, l.toxic
        from documents d left join labels l on d.doc_id = l.doc_id""",
    "left_join_fanout": """
        select c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
        from customer c left join orders o on c.c_custkey = o.o_custkey""",
    "left_join_hot_keys": """
        select o.line_key, o.o_orderkey, l.l_orderkey, l.l_linenumber
        from (select case when o_orderkey < 4 then 1 else cast(o_custkey as integer) + 1 end as line_key, o_orderkey
              from orders) o
        left join (select case when l_returnflag = 'R' then 1 else l_orderkey + 1 end as key, l_orderkey, l_linenumber
                   from lineitem) l on o.line_key = l.key""",
    "count_where": """
        select count(*) as n_rows from lineitem where l_quantity > 25 and l_returnflag = 'R'""",
    "count_all": "select count(*) as n_rows from lineitem",
    "max_where": "select max(o_totalprice) as max_value from orders where o_orderstatus = 'O'",
    "max_empty": "select max(o_totalprice) as max_value from orders where o_totalprice < 0",
    "last_step": _LAST_STEP,
    "previous_count": _PREVIOUS,
    "mart_rows": _mart(7, _RUN, _MONTH),
    "mart_build": _mart(7, _RUN, _MONTH),
    "corporate_mart": f"""
        with profile as (
          select cast(o_custkey as varchar) as inn,
                 cast(max(day(o_orderdate)) as smallint) as days_from_registration,
                 cast(count(*) filter (where o_orderstatus = 'O') as smallint) as op_tech_other_bank_cnt,
                 cast(max(o_totalprice) as float) as balance_rs,
                 cast(count(*) filter (where o_orderstatus = 'F') as smallint)
                   as out_tech_our_bank_contragents,
                 cast(count(*) filter (where o_orderstatus = 'P') as smallint)
                   as in_tech_our_bank_contragents,
                 cast(count(*) as smallint) as in_tech_our_bank_cnt,
                 cast(min(o_totalprice) as float) as op_tech_our_bank_amt,
                 cast(count(*) filter (where o_orderpriority = '1-URGENT') as smallint)
                   as op_pays_our_bank_cnt,
                 cast(count(*) filter (where o_orderpriority = '2-HIGH') as smallint)
                   as out_pays_our_bank_cnt,
                 cast(count(*) filter (where o_orderpriority = '5-LOW') as smallint)
                   as in_pays_our_bank_contragents,
                 cast(max(case when o_orderstatus = 'F' then o_totalprice end) as float)
                   as op_pays_our_bank_amt,
                 strftime(o_orderdate, '%Y-%m-01') as report_dt
          from orders group by o_custkey, strftime(o_orderdate, '%Y-%m-01')
        ), reference as (
          select case when c_nationkey < 20 then cast(c_custkey as varchar) end as inn, cast(c_nationkey as varchar) as okved_cd,
                 c_mktsegment as segment, c_name as sector,
                 case when c_acctbal < 0 then 'debtor' else 'holder' end as kopf_nm
          from customer
        )
        select 7 as ctl_loading, '{_RUN}' as ctl_validfrom, p.*,
               r.okved_cd, r.segment, r.sector, r.kopf_nm
        from profile p left join reference r on p.inn = r.inn
        where p.report_dt = '{_MONTH}'""",
    "resolve_date": f"""
        select o_orderkey, report_dt from ({_MONTHLY})
        where report_dt = (select max(report_dt) from ({_MONTHLY}))""",
    "resume_steps": f"""
        select step, cast(case when step > (select last_step from ({_LAST_STEP}))
                               then (select count(*) from orders where o_orderstatus = status)
                               else 0 end as bigint) as n_rows
        from (values (1, 'F'), (2, 'O'), (3, 'P')) as s(step, status)""",
    "force_reload": _mart(9, _RUN, "2001-06-01"),
    "change_of_run": f"""
        select previous, (select count(*) from orders) as current,
               case when previous is distinct from (select count(*) from orders)
                    then 1 else 0 end as is_change
        from ({_PREVIOUS})""",
    "compaction_plan": f"select distinct report_dt, true as fits from ({_MONTHLY})",
    "compact_partition": f"""
        select report_dt, count(*) as n_rows, min(o_orderkey) as low, max(o_orderkey) as high,
               true as as_planned
        from ({_MONTHLY}) group by report_dt""",
    "compact_two_levels": f"""
        select o_orderstatus, report_dt, count(*) as n_rows, min(o_orderkey) as low, max(o_orderkey) as high,
               true as within_plan, 0 as n_again
        from ({_MONTHLY}) group by o_orderstatus, report_dt""",
    "retention_plan": f"""
        select 'report_dt=' || report_dt as partition, report_dt as value,
               '2000-05-31 06:00:00' as cutoff,
               max(o_totalprice) > 499000 as touched,
               max(o_totalprice) <= 499000 and report_dt < '2000-05-31 06:00:00' as expired
        from ({_MONTHLY}) group by report_dt""",
    "retention_external": f"select o_orderkey, report_dt from ({_MONTHLY}) where report_dt > '2000-06-01'",
    "retention_apply": f"select o_orderkey, report_dt from ({_MONTHLY}) where report_dt > '2000-06-01'",
    "step_job": _mart(8, _RUN, _MONTH),
    "run_audit": f"""
        select 1 as ctl_loading, '2024-01-16 06:00:00' as ctl_validfrom, {_NEWEST} as partitions,
               1 as is_force_load, 1 as last_success_step, 1 as last_step_in_general,
               (select count(*) from orders) as count_rows, 1 as is_change
        union all
        select 2, '2024-02-16 06:00:00', {_NEWEST}, 0, 1, 1, {_COUNT_AFTER_LOSS},
               case when {_COUNT_AFTER_LOSS} <> (select count(*) from orders) then 1 else 0 end
        union all
        select 3, '2024-03-16 06:00:00', {_NEWEST}, 0, 0, 1, {_COUNT_AFTER_LOSS}, 0""",
    "mart_job": _mart(12, "2001-08-16 06:00:00", _MONTH),
    "job_recovery": f"""
        select load_id as ctl_loading, o_orderkey, step as last_success_step, is_change
        from ({_MONTHLY}), (values (21, 1, 1), (22, 2, 0)) as r(load_id, step, is_change)
        where report_dt = '{_MONTH}'""",
    "mart_job_audit": f"""
        select 11 as ctl_loading, '2001-07-16 06:00:00' as ctl_validfrom,
               'report_dt={_MONTH}' as partitions, 1 as is_force_load, 1 as last_success_step,
               1 as last_step_in_general, count(*) as count_rows, 1 as is_change
        from ({_MONTHLY}) where report_dt = '{_MONTH}'
        union all
        select 12, '2001-08-16 06:00:00', 'report_dt={_MONTH}', 0, 1, 1, count(*), 0
        from ({_MONTHLY}) where report_dt = '{_MONTH}'""",
}
