"""SQL counterparts of the registered queries, for another engine on the same tables.

They are written from the definitions (pairs, sorts, plain quantiles), not from the Spark plans.
"""

from __future__ import annotations

import re

from pulsegrid.registry.proxies import HISTORY_MODELS, LAB_ITEMS

# Inputs, as common table expressions in dependency order.
_BASE = {
    "patients": """
        select c_custkey as subject_id, case when c_custkey % 2 = 0 then 'M' else 'F' end as gender,
          18 + (c_custkey * 7) % 79 as anchor_age, 2024 - c_custkey % 5 as anchor_year
        from customer where c_mktsegment <> 'MACHINERY'""",
    "record_list": """
        select user_id as subject_id, event_id as study_id, event_id as file_name, ts as ecg_time
        from events where event_type = 'view'""",
    "labevents": """
        select user_id as subject_id, ts as charttime,
          case event_type when 'click' then case when event_id % 2 = 0 then 50971 else 52610 end
            when 'purchase' then case when event_id % 2 = 0 then 50983 else 52623 end
            when 'error' then case when event_id % 2 = 0 then 51002 else 52642 end else 99999 end as itemid,
          case when event_id % 5 = 0 then null else value end as valuenum, 'mEq/L' as valueuom,
          event_id as labevent_id
        from events where event_type <> 'view'""",
    "d_labitems": "select * from (values " + ", ".join(f"({i}, '{n}')" for i, n in LAB_ITEMS) + ") as v(itemid, label)",
    "icustay_detail": """
        select user_id as subject_id, event_id as hadm_id, event_id as stay_id,
          case when user_id % 2 = 0 then 'M' else 'F' end as gender, 18 + (user_id * 7) % 79 as admission_age,
          ts - interval 6 hour as admittime, ts + interval 48 hour as dischtime, ts as icu_intime,
          ts + interval 1 hour * cast(floor(value) as int) as icu_outtime,
          case when event_id % 7 = 0 then 1 else 0 end as hospital_expire_flag
        from events where event_type = 'signup'""",
    "hosp": """
        select s.*, r.study_id, r.ecg_time,
          cast(row_number() over (partition by s.stay_id order by r.ecg_time, r.study_id) as integer) as ecg_order
        from record_list r join icustay_detail s on s.subject_id = r.subject_id
          and r.ecg_time between s.icu_intime - interval 8 hour and s.icu_intime + interval 24 hour""",
    "labs": """
        select le.subject_id, le.charttime, r.study_id, r.ecg_time, d.label, le.itemid, le.valuenum, le.labevent_id,
          (epoch_us(le.charttime) - epoch_us(r.ecg_time)) / 60000000.0::double as lab_offset
        from labevents le join record_list r on le.subject_id = r.subject_id
          and r.ecg_time between le.charttime - interval 4 hour and le.charttime + interval 4 hour
        left join d_labitems d on le.itemid = d.itemid
        where le.itemid in (51002, 52642, 50971, 52610, 50983, 52623)""",
    "ranked_any": """
        select *, row_number() over (partition by study_id, label
          order by abs(lab_offset), charttime, labevent_id) as rk from labs""",
    "ranked_valued": """
        select *, row_number() over (partition by study_id, label
          order by abs(lab_offset), charttime, labevent_id) as rk from labs where valuenum is not null""",
    "wide": """
        select k.study_id,
          max(case when lower(v.label) = 'troponin i' then valuenum end) as troponin_i,
          max(case when lower(v.label) = 'troponin i' then lab_offset end) as troponin_i_offset,
          max(case when lower(v.label) = 'potassium' then valuenum end) as potassium,
          max(case when lower(v.label) = 'potassium' then lab_offset end) as potassium_offset,
          max(case when lower(v.label) = 'sodium' then valuenum end) as sodium,
          max(case when lower(v.label) = 'sodium' then lab_offset end) as sodium_offset
        from (select distinct study_id from labs) k
        left join (select * from ranked_valued where rk = 1) v on v.study_id = k.study_id group by k.study_id""",
    "hosp1": """
        select study_id, hadm_id, hospital_expire_flag,
          case when icu_outtime >= dischtime then 1 else 0 end as icu_expire_flag,
          (epoch_us(ecg_time) - epoch_us(icu_intime)) / 60000000.0::double as ecg_offset
        from (select *, count(*) over (partition by study_id) as n from hosp where ecg_order = 1) t where n = 1""",
    "scores": """
        select r.study_id, 18 + (r.subject_id * 7) % 79 + 40 * e.embedding[1]::double as age_pred
        from record_list r join embeddings e on e.vec_id = r.study_id % (select count(*) from embeddings)""",
    "known_scores": """
        select s.* from scores s join record_list r on r.study_id = s.study_id
        where r.subject_id in (select subject_id from patients)""",
    "delta": """
        select h.*, s.age_pred, s.age_pred - h.admission_age as age_delta,
          coalesce(icu_outtime >= dischtime and hospital_expire_flag = 1, false) as icu_mort
        from hosp h left join scores s on h.study_id = s.study_id where ecg_order = 1 and admission_age < 90""",
    "scored": """
        select h.*, s.age_pred, s.age_pred - h.admission_age as age_delta,
          coalesce(icu_outtime >= dischtime and hospital_expire_flag = 1, false) as icu_mort
        from hosp h left join known_scores s on h.study_id = s.study_id""",
    "vector_signals": """
        select vec_id, list_transform(range(0, 8), lambda l: list_transform(range(0, 8), lambda i: case
          when vec_id % 17 = 0 and l = 0 then 1.0::double when vec_id % 19 = 0 and l = 3 and i = 2 then 'NaN'::double
          else embedding[l * 8 + i + 1]::double end)) as signal from embeddings""",
    "signals": """
        select r.file_name, v.signal from record_list r
        join vector_signals v on v.vec_id = r.file_name % (select count(*) from embeddings)""",
    "samples": """
        select file_name, l.lead, i.i, signal[l.lead + 1][i.i + 1] as value from signals
        cross join (select unnest(range(0, 8)) as lead) l cross join (select unnest(range(0, 8)) as i) i""",
    "leads": """
        select file_name, lead, count(*) as n, bool_or(isnan(value)) as has_nan, min(value) as lo, max(value) as hi,
          avg(case when not isnan(value) then value end) as m
        from samples group by file_name, lead""",
    "lead_rows": """
        select s.file_name, s.lead, any_value(l.has_nan) as has_nan,
          case when any_value(l.has_nan) then 'NaN'::double else any_value(l.lo) end as lo,
          case when any_value(l.has_nan) then 'NaN'::double else any_value(l.hi) end as hi,
          case when any_value(l.has_nan) then 'NaN'::double else any_value(l.m) end as m,
          case when any_value(l.has_nan) then 'NaN'::double
            else sqrt(sum(case when isnan(value) then 0 else (value - l.m) * (value - l.m) end) / 8) end as sd,
          not any_value(l.has_nan) and any_value(l.lo) = any_value(l.hi) as flat
        from samples s join leads l on l.file_name = s.file_name and l.lead = s.lead group by s.file_name, s.lead""",
    "flags": """
        select file_name, bool_or(flat) as any_flat, bool_or(has_nan) as any_nan from lead_rows group by file_name""",
    "whole": """
        select s.file_name, avg(value) as m from samples s join flags f on f.file_name = s.file_name
        where not any_nan group by s.file_name""",
    "summary": """
        select f.file_name,
          case when any_value(any_nan) then 'NaN'::double else any_value(w.m) end as mean,
          case when any_value(any_nan) then 'NaN'::double
            else sqrt(avg((case when any_nan then 0 else value end - coalesce(w.m, 0))
              * (case when any_nan then 0 else value end - coalesce(w.m, 0)))) end as sd
        from flags f join samples s on s.file_name = f.file_name left join whole w on w.file_name = f.file_name
        group by f.file_name""",
    "zscores": """
        select s.file_name, s.lead, s.i, (s.value - r.m) / r.sd as value from samples s
        join flags f on f.file_name = s.file_name and not any_flat and not any_nan
        join lead_rows r on r.file_name = s.file_name and r.lead = s.lead""",
    "hashed": """
        select r.study_id, r.subject_id, r.ecg_time, p.gender,
          year(r.ecg_time) - p.anchor_year + p.anchor_age as ecg_age,
          ('0x' || substr(md5('42:' || r.subject_id::varchar), 1, 8))::bigint / 4294967296.0::double as u
        from record_list r left join patients p on p.subject_id = r.subject_id""",
    "split_records": """
        select * exclude (u), case when u < 0.2 then 'test' when u < 0.2::double + 0.8::double * 0.2::double then 'val'
          else 'train' end as split from hashed""",
    "quality": """
        select f.file_name as filename, r.ecg_age::double as age, 500 as fs, s.mean, s.sd, any_flat as all_zeros,
          any_nan, split
        from flags f join summary s on s.file_name = f.file_name join split_records r on r.study_id = f.file_name""",
    "features": """
        select r.study_id as file_name, r.split, r.ecg_age::double as age,
          case when gender = 'M' then 1 else 0 end as gender, gender is not null as gender_known,
          w.* exclude (study_id), h.hospital_expire_flag, h.icu_expire_flag, h.ecg_offset,
          z.n_samples, z.sample, z.weighted
        from split_records r
        join (select file_name, cast(count(*) as integer) as n_samples,
            max(case when lead = 1 and i = 2 then value end) as sample,
            sum(value * (lead * 8 + i + 1)) as weighted
          from zscores group by file_name) z on z.file_name = r.study_id
        left join wide w on w.study_id = r.study_id left join hosp1 h on h.study_id = r.study_id""",
    "history": """
        select case event_type when 'click' then 'cnn-age' when 'purchase' then 'cnn-sodium'
            when 'error' then 'resnet-age2' when 'signup' then 'resnet-gender' else 'transformer-age' end as model,
          cast(day(ts) - 1 as integer) as epoch, round(avg(value), 6) as loss,
          round(avg(case when event_id % 3 = 0 then value end), 6) as val_loss,
          round(avg(value * value), 7) as mse,
          round(avg(case when event_id % 3 = 0 then value * value end), 7) as val_mse
        from events group by 1, 2""",
    "done": """
        select study_id, model, version from known_scores
        cross join (values ('cnn-age', '1'), ('resnet-age', '1')) as v(model, version)""",
    "models": """
        select * from (values ('cnn-age', '1', 3), ('resnet-age', '2', 7), ('resnet-sodium', '1', 5))
          as v(model, version, step)""",
}


def _needs(sql: str) -> list[str]:
    """Names of the inputs ``sql`` uses, directly or through another input, in order."""
    wanted: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"(?:from|join)\s+\(?\s*(\w+)", todo.pop()))
        new = (words & set(_BASE)) - wanted
        wanted |= new
        todo += [_BASE[n] for n in new]
    return [n for n in _BASE if n in wanted]


def _with(select: str, **local: str) -> str:
    parts = [f"{n} as ({_BASE[n]})" for n in _needs(" ".join([select, *local.values()]))]
    parts += [f"{n} as ({body})" for n, body in local.items()]
    return (f"with {', '.join(parts)} " if parts else "") + select


def r(expr: str, digits: int | None = None, name: str | None = None) -> str:
    """Rounded and free of -0.0, like the Spark side."""
    name = name or expr.split(".")[-1]
    if digits is None:
        digits = 10 if name.strip('"').endswith("offset") or name == "ecg_delta" else 6
    return f"round({expr}, {digits}) + 0.0::double as {name}"


def _bins(source: str, col: str, q: int) -> dict[str, str]:
    """Edges by plain quantiles and bins by counting the edges below a value."""
    probs = ", ".join(str(i / q) for i in range(q + 1))
    return {
        "raw_edges": f"select unnest(quantile_cont({col}::double, [{probs}])) as e from {source} where {col} is not null",
        "edges": "select list(distinct round(e, 9)) as es from raw_edges",
        "sorted_edges": "select list_sort(es) as es from edges",
        "binned": f"""
            select s.*, cast(case when {col} is not null then
                greatest(len(list_filter(es, lambda e: e < round({col}, 9))) - 1, 0) end as integer) as bin, es
            from {source} s cross join sorted_edges""",
    }


_RATES = f"""select bin, {r('es[bin + 1]', name='bin_lo')}, {r('es[bin + 2]', name='bin_hi')}, count(*) as n,
    {r('avg(hospital_expire_flag)', name='hospital_expire_flag_rate')},
    {r('avg(icu_mort::int)', name='icu_mort_rate')}
    from binned where bin is not null group by bin, es"""

_WIDE = ", ".join(
    [r(f"{n}{suffix}") for n in ("troponin_i", "potassium", "sodium") for suffix in ("", "_offset")]
)

_FEATURES = f"""select file_name, split, {r('age')}, gender, gender_known, {_WIDE},
    hospital_expire_flag::double as hospital_expire_flag, icu_expire_flag::double as icu_expire_flag,
    {r('ecg_offset')}, n_samples, {r('sample')}, {r('weighted')} from features"""



def _describe(probs: tuple[float, ...], digits: int) -> str:
    marks = [r(f"quantile_cont(x, {p})", digits, f"p{round(p * 100)}") for p in probs]
    ends = [r("min(x)", digits, "min"), r("max(x)", digits, "max")]
    return ", ".join(["count(*) as count", r("avg(x)", name="mean"), r("stddev_samp(x)", name="std"), *ends, *marks])


def _linear(value: str, step: str) -> str:
    """Sum over samples of value times ((position * step) % 11 - 5) / 10."""
    return f"sum({value} * ((((lead * 8 + i) * {step}) % 11 - 5) / 10.0::double))"


def _unit_of(text: str) -> str:
    return f"(('0x' || substr(md5('42:' || {text}), 1, 8))::bigint / 4294967296.0::double)"


def _permuted(table: str, index: str, size: str, parts: str, name: str, rounds: int = 16) -> str:
    """``table`` with the permuted ``index`` as ``name``, one nested query per round."""
    sql = f"select *, {index} as x from {table}"
    for k in range(1, rounds + 1):
        turn = f"floor({_unit_of(f"{parts} || ':pair:{k}'")} * {size})::bigint"
        paired = f"select *, (({turn} - x) % {size} + {size}) % {size} as partner from ({sql})"
        stays = f"{_unit_of(f"{parts} || ':swap:{k}:' || greatest(x, partner)")} < 0.5"
        sql = f"select * exclude (x, partner), case when {stays} then x else partner end as x from ({paired})"
    return f"select * exclude (x), x as {name} from ({sql})"


def _epoch_order(epoch: int, rows_per_shard: int) -> str:
    return _with(
        "select study_id, shard, shard_row, epoch_shard, epoch_row from by_row",
        counted=f"select study_id, greatest(1, ceil(count(*) over () / {rows_per_shard}.0::double))::bigint as shards from record_list",
        dealt=f"select *, floor({_unit_of('study_id::varchar')} * shards)::bigint as shard from counted",
        sharded="""select *, row_number() over (partition by shard order by study_id) - 1 as shard_row,
          count(*) over (partition by shard) as shard_rows from dealt""",
        by_shard=_permuted("sharded", "shard", "shards", f"'{epoch}'", "epoch_shard"),
        by_row=_permuted("by_shard", "shard_row", "shard_rows", f"'{epoch}:' || shard", "epoch_row"),
    )


def all_oracles() -> dict[str, str]:
    o: dict[str, str] = {}

    # sources and sinks
    o["read_csv_table"] = _with(
        "select subject_id, gender, anchor_age::integer as anchor_age, anchor_year::integer as anchor_year from patients"
    )
    o["read_typed_csv"] = _with(
        """select subject_id, stay_id, gender, admission_age::double as admission_age, icu_intime, hospital_expire_flag
        from icustay_detail"""
    )
    o["history_read_many"] = _with(
        """select model, split_part(model, '-', 1) as arch,
          case when split_part(model, '-', 2) = 'age2' then 'age' else split_part(model, '-', 2) end as task,
          epoch, loss, val_loss, case when model <> 'resnet-gender' then mse end as mse,
          case when model <> 'resnet-gender' then val_mse end as val_mse from history"""
    )
    o["score_map_explode"] = _with(f"select study_id, {r('age_pred')} from scores")
    o["read_split_projection"] = _with("select study_id, gender, ecg_age::double as ecg_age from split_records where split = 'train'")
    o["shard_write_roundtrip"] = _with("select study_id, subject_id, ecg_time, split from split_records")

    # columns and predicates
    o["parse_times"] = _with("select stay_id, admittime, dischtime, icu_intime, icu_outtime from icustay_detail")
    o["anchored_age"] = _with("select study_id, ecg_age::double as ecg_age from split_records")
    o["lab_offsets"] = _with(
        f"""select study_id, labevent_id, {r('lab_offset', name='"offset"')},
        {r('abs(lab_offset)', name='abs_offset')} from labs"""
    )
    o["ecg_hours_from_icu"] = _with(
        f"""select stay_id, study_id,
        {r('(epoch_us(ecg_time) - epoch_us(icu_intime)) / 3600000000.0::double', name='ecg_delta')} from hosp"""
    )
    o["icu_expire_flag"] = _with(
        "select stay_id, case when icu_outtime >= dischtime then 1 else 0 end as icu_expire_flag from icustay_detail"
    )
    o["icu_mort"] = _with(
        """select stay_id, coalesce(icu_outtime >= dischtime and hospital_expire_flag = 1, false) as icu_mort
        from icustay_detail"""
    )
    o["gender_encode"] = _with(
        """select study_id, case when gender = 'M' then 1 else 0 end as gender, gender is not null as gender_known
        from split_records"""
    )
    o["age_delta"] = _with(f"select stay_id, study_id, {r('age_delta')} from delta")
    o["drop_missing_labels"] = _with(
        f"select study_id, {r('potassium')}, {r('potassium_offset')} from wide where potassium is not null"
    )
    o["age_cap_filter"] = _with(
        """select stay_id, admission_age, case when admission_age < 90 then 1.0::double end as strict
        from icustay_detail where admission_age <= 90"""
    )
    o["cohort_filters"] = _with(
        """select stay_id, study_id, 'first' as predicate from d where ecg_order = 1
        union all select stay_id, study_id, 'later' from d where ecg_order > 1
        union all select stay_id, study_id, 'death' from d where hospital_expire_flag = 1
        union all select stay_id, study_id, 'much_younger' from d where age_pred - admission_age < -10""",
        d="select h.*, s.age_pred from hosp h left join scores s on s.study_id = h.study_id",
    )
    o["model_name_parts"] = _with(
        """select model, epoch, split_part(model, '-', 1) as arch,
        case when split_part(model, '-', 2) = 'age2' then 'age' else split_part(model, '-', 2) end as task from history"""
    )

    # joins
    o["ecg_with_demographics"] = _with(
        "select study_id, subject_id, gender, ecg_age::double as ecg_age from split_records"
    )
    o["lab_interval_join"] = _with(
        "select subject_id, study_id, labevent_id, itemid, valuenum, charttime, ecg_time from labs"
    )
    o["lab_interval_join_tiles"] = o["lab_interval_join"]
    o["stay_interval_join"] = _with("select subject_id, stay_id, study_id, ecg_time, icu_intime from hosp")
    o["lab_label_lookup"] = _with(
        "select labevent_id, l.itemid, label from labevents l left join d_labitems d on d.itemid = l.itemid"
    )
    # Value and offset separately: the first may come from a later pair than the second.
    first_nonnull = """
        select a.study_id, a.label, v.valuenum, a.lab_offset from (select * from ranked_any where rk = 1) a
        left join (select * from ranked_valued where rk = 1) v on v.study_id = a.study_id and v.label = a.label"""
    per_label = ", ".join(
        f"{r(f'max(case when lower(label) = {label!r} then {col} end)', name=f'{short}{suffix}')}"
        for label, short in (("troponin i", "troponin_i"), ("potassium", "potassium"), ("sodium", "sodium"))
        for col, suffix in (("valuenum", ""), ("lab_offset", "_offset"))
    )
    o["labs_full_outer"] = _with(f"select study_id, {per_label} from fn group by study_id", fn=first_nonnull)
    o["attach_labels"] = _with(
        f"""select r.study_id, r.subject_id, {_WIDE}, hadm_id::double as hadm_id,
          hospital_expire_flag::double as hospital_expire_flag, icu_expire_flag::double as icu_expire_flag,
          {r('ecg_offset')}
        from record_list r left join wide w on w.study_id = r.study_id left join hosp1 h on h.study_id = r.study_id"""
    )
    o["scores_to_outcomes"] = _with(f"select stay_id, study_id, admission_age, {r('age_pred')} from scored")
    o["semi_join_multi_ecg"] = _with(
        """select stay_id, study_id, ecg_order from hosp
        where stay_id in (select stay_id from hosp where ecg_order = 2)"""
    )
    o["nearest_lab"] = _with(
        f"""select study_id, lower(label) as label, labevent_id, {r('valuenum')}, {r('lab_offset', name='"offset"')}
        from ranked_any where rk = 1"""
    )
    o["pending_scores"] = _with(
        """select r.study_id, m.model, m.version from record_list r cross join models m
        where not exists (select 1 from done d where d.study_id = r.study_id and d.model = m.model
          and d.version = m.version)"""
    )

    # aggregates
    o["nearest_lab_coherent"] = _with(
        f"""select k.study_id, k.label, {r('valuenum')}, {r('lab_offset', name='"offset"')}
        from (select distinct study_id, label from labs) k
        left join (select * from ranked_valued where rk = 1) v on v.study_id = k.study_id and v.label = k.label"""
    )
    o["nearest_lab_first_nonnull"] = _with(
        f"select study_id, label, {r('valuenum')}, {r('lab_offset', name='\"offset\"')} from fn",
        fn=first_nonnull,
    )
    o["stays_multi_ecg"] = _with(
        "select stay_id, max(ecg_order) as max_ecg_order from hosp group by stay_id having max(ecg_order) > 1"
    )
    o["unique_study_filter"] = _with(
        """select study_id, stay_id, hadm_id, ecg_time from hosp where ecg_order = 1
        and study_id in (select study_id from hosp where ecg_order = 1 group by study_id having count(*) = 1)"""
    )
    o["gender_counts"] = _with(
        """select gender, count(*) as n from (select distinct subject_id, gender, admission_age from hosp)
        group by gender"""
    )
    o["distinct_subjects"] = _with("select count(distinct subject_id) as n_subjects from hosp")
    o["distinct_demographics"] = _with("select distinct subject_id, gender, admission_age from hosp")
    o["describe_outcomes"] = _with(
        "select \"column\", "
        + _describe((0.2, 0.4, 0.5, 0.6, 0.8, 0.9, 0.95, 0.98, 0.99), 10)
        + " from cells group by \"column\"",
        cells="""select 'admission_age' as "column", admission_age::double as x from hosp
          union all select 'hospital_expire_flag', hospital_expire_flag::double from hosp
          union all select 'ecg_offset', (epoch_us(ecg_time) - epoch_us(icu_intime)) / 60000000.0::double from hosp""",
    )
    o["visits_per_subject"] = _with(
        "select 'n_rows' as \"column\", " + _describe((0.2, 0.4, 0.5, 0.6, 0.8), 6) + " from visits",
        visits="select count(*)::double as x from hosp group by subject_id",
    )
    o["mortality_by_delta_decile"] = _with(_RATES, **_bins("scored", "age_delta", 10))
    o["mortality_of_followed_stays"] = _with(
        _RATES,
        followed="select * from scored where stay_id in (select stay_id from hosp where ecg_order = 2)",
        **_bins("followed", "age_delta", 10),
    )
    share = "count(*) filter (where {})::double / count(*)"
    o["quality_profile"] = _with(
        " union all ".join(
            f"select '{c}' as \"column\", '{kind}' as kind, {r(share.format(cond), name='rate')} from quality"
            for c, kind, cond in (
                ("age", "missing", "age is null"),
                ("mean", "missing", "mean is null or isnan(mean)"),
                ("sd", "missing", "sd is null or isnan(sd)"),
                ("all_zeros", "true", "all_zeros"),
                ("any_nan", "true", "any_nan"),
            )
        )
    )
    o["rows_per_split"] = _with("select split, count(*) as n from split_records group by split")
    demographics = """select r.*, p.gender, p.anchor_age, p.anchor_year,
        year(r.ecg_time) - p.anchor_year + p.anchor_age as ecg_age, s.age_pred
        from record_list r left join patients p on p.subject_id = r.subject_id
        left join known_scores s on s.study_id = r.study_id"""
    o["non_null_counts"] = _with(
        " union all ".join(
            f"select '{c}' as \"column\", '{kind}' as \"type\", count({c}) as non_null from d"
            for c, kind in {
                "study_id": "bigint", "subject_id": "bigint", "file_name": "bigint", "ecg_time": "timestamp_ntz", "gender": "string",
                "anchor_age": "bigint", "anchor_year": "bigint", "ecg_age": "bigint", "age_pred": "double",
            }.items()
        ),
        d=demographics,
    )
    died = "count(distinct case when hospital_expire_flag = 1 then subject_id end)"
    o["subject_death_share"] = _with(
        f"""select {died} as n_event, count(distinct subject_id) as n_subjects,
        {r(f'{died}::double / count(distinct subject_id)', 9, 'share')} from hosp"""
    )
    o["age_correlation"] = _with(
        f"""select {r('r')}, n, {r('r * sqrt((n - 2) / (1 - r * r))', name='t')}
        from (select corr(admission_age, age_pred) as r, count(age_pred) as n from scored)"""
    )
    o["age_histogram"] = _with(
        "select ceil(admission_age - 0.5)::double as center, count(*) as n from hosp group by 1"
    )
    o["age_hexbin"] = _with(
        f"""select {r('x0 + i * dx', name='x')}, {r('y0 + j * dy', name='y')}, count(*) as n from (
          select *, case when near then i1 else i2 end as i, case when near then j1 else j2 end as j from (
            select *, (u - i1) * (u - i1) + 3 * (v - j1) * (v - j1)
              <= (u - i2) * (u - i2) + 3 * (v - j2) * (v - j2) as near from lattice))
        group by i, j, x0, y0, dx, dy""",
        pts="select admission_age::double as x, age_pred as y from scored where age_pred is not null",
        steps="""select (max(x) - min(x)) / 30 as dx, (max(y) - min(y)) / 30 as ry, min(x) as lx, min(y) as ly from pts""",
        grid="""select dx, ry * sqrt(3.0::double) as dy, floor(lx / dx) * dx - 1e-6::double as x0,
          floor(ly / ry) * ry - 1e-6::double as y0 from steps""",
        placed="select (x - x0) / dx as u, (y - y0) / dy as v, x0, y0, dx, dy from pts cross join grid",
        lattice="""select *, floor(u + 0.5::double) as i1, floor(v + 0.5::double) as j1,
          floor(u) + 0.5::double as i2, floor(v) + 0.5::double as j2 from placed""",
    )
    o["error_density"] = _with(
        f"""select bin as age_bin, {r('any_value(lo + g * step)', name='x')},
          {r('sum(w / total * exp(-((g - c) * step / h) * ((g - c) * step / h) / 2) / (h * sqrt(2 * pi())))', name='density')}
        from weights join widths using (bin) cross join range_ cross join (select unnest(range(0, 512)) as g)
        group by bin, g""",
        present="select * from scored where age_pred is not null",
        **_bins("present", "admission_age", 5),
        range_="select min(age_delta) as lo, (max(age_delta) - min(age_delta)) / 511 as step from binned",
        widths="""select bin, count(*)::double as total, 0.9::double * least(stddev_samp(age_delta),
          (quantile_cont(age_delta, 0.75) - quantile_cont(age_delta, 0.25)) / 1.34::double)
          * pow(count(*), -0.2::double) as h from binned group by bin""",
        cells="""select bin, (age_delta - lo) / step as a, least(floor((age_delta - lo) / step), 510) as c
          from binned cross join range_""",
        weights="""select bin, c, sum(w) as w from (select bin, c, 1 - (a - c) as w from cells
          union all select bin, c + 1, a - c from cells) group by bin, c""",
    )
    o["regression_metrics"] = _with(
        f"""select gender, count(*) as n, {r('avg(age_delta * age_delta)', name='mse')},
        {r('avg(abs(age_delta))', name='mae')} from scored where age_pred is not null group by gender"""
    )
    o["binary_metrics"] = _with(
        f"""select b.gender, b.n, {r('b.accuracy')}, {r('b.log_loss')}, {r('a.auc')} from basics b
        join (select gender, sum((fpr - next_fpr) * (tpr + next_tpr) / 2) as auc from (
            select *, lead(fpr) over (partition by gender order by k) as next_fpr,
              lead(tpr) over (partition by gender order by k) as next_tpr from curve) group by gender) a
          on a.gender = b.gender""",
        risks="""select gender, hospital_expire_flag as y, 1 / (1 + exp(-(age_pred - 60) / 15)) as p
          from scored where age_pred is not null""",
        basics="""select gender, count(*) as n, avg(((p > 0.5)::int = y)::int) as accuracy,
          avg(-(y * ln(least(greatest(p, 1e-7::double), 1 - 1e-7::double))
            + (1 - y) * ln(1 - least(greatest(p, 1e-7::double), 1 - 1e-7::double)))) as log_loss
          from risks group by gender""",
        cuts="""select k, case k when 0 then -1e-7::double when 199 then 1 + 1e-7::double else k / 199.0::double end as cut
          from (select unnest(range(0, 200)) as k)""",
        curve="""select gender, k, count(*) filter (where y = 1 and p > cut)::double / count(*) filter (where y = 1) as tpr,
          count(*) filter (where y = 0 and p > cut)::double / count(*) filter (where y = 0) as fpr
          from risks cross join cuts group by gender, k""",
    )

    o["exact_auc"] = _with(
        f"""select gender, count(*) as n, {r('(sum(rank) filter (where y = 1) - n1 * (n1 + 1) / 2) / (n1 * n0)', name='auc')}
        from ranked group by gender, n1, n0""",
        years="select gender, hospital_expire_flag as y, round(age_pred) as p from scored where age_pred is not null",
        ranked="""select gender, y, count(*) filter (where y = 1) over (partition by gender)::double as n1,
          count(*) filter (where y = 0) over (partition by gender)::double as n0,
          rank() over (partition by gender order by p) + (count(*) over (partition by gender, p) - 1) / 2.0::double as rank
          from years""",
    )

    # ranking and bins
    o["ecg_order"] = _with("select stay_id, study_id, ecg_time, ecg_order from hosp")
    o["first_ecg_per_stay"] = _with("select stay_id, study_id, ecg_time from hosp where ecg_order = 1")
    o["lab_quantile_sketches"] = _with(
        """select itemid, prob, count(*) as n, 1 as within_bound
        from labevents, (select unnest([0.05, 0.25, 0.5, 0.75, 0.95])::double as prob)
        where valuenum is not null and not isnan(valuenum::double) group by itemid, prob"""
    )
    placed = f"bin, {r('es[bin + 1]', name='bin_lo')}, {r('es[bin + 2]', name='bin_hi')}"
    o["age_delta_deciles"] = _with(
        f"select stay_id, study_id, {r('age_delta')}, {placed} from binned", **_bins("delta", "age_delta", 10)
    )
    o["age_quintiles"] = _with(
        f"select stay_id, study_id, admission_age, {placed} from binned", **_bins("hosp", "admission_age", 5)
    )

    # limits, samples, shuffles
    o["first_n_records"] = _with("select study_id, ecg_time from record_list order by ecg_time, study_id limit 10")
    o["sample_stays"] = _with(
        "select stay_id, study_id from hosp where stay_id in (select stay_id from chosen)",
        chosen="""select stay_id from (select distinct stay_id from hosp)
          order by substr(md5('42:' || stay_id::varchar), 1, 8), stay_id limit 250""",
    )
    o["epoch_order"] = _epoch_order(epoch=3, rows_per_shard=64)
    o["epoch_shuffle"] = _with(
        "select study_id, md5('42:3:' || study_id::varchar) as shuffle_key from record_list"
    )

    # unions and reshaping
    o["union_histories"] = _with(
        """select epoch, loss, val_loss, case when model <> 'resnet-gender' then mse end as mse,
        case when model <> 'resnet-gender' then val_mse end as val_mse, model from history"""
    )
    o["labs_wide"] = _with(f"select study_id, {_WIDE} from wide")
    o["history_pivot"] = _with(
        "select epoch, "
        + ", ".join(f"max(case when model = '{m}' then val_mse end) as {m.replace('-', '_')}" for m in HISTORY_MODELS)
        + " from history group by epoch"
    )
    o["history_unpivot"] = _with(
        """select model, epoch, 'loss' as name, loss as value from history
        union all select model, epoch, 'val_loss', val_loss from history"""
    )

    # signals
    o["signal_explode"] = _with(
        f"""select file_name, cast(lead as integer) as lead,
        ['I', 'II', 'III', 'aVR', 'aVF', 'aVL', 'V1', 'V2'][lead + 1] as lead_name, cast(i as integer) as i,
        {r('value')} from samples"""
    )
    o["lead_stats"] = _with(
        f"""select file_name, cast(lead as integer) as lead, {r('lo', name='min')}, {r('hi', name='max')},
        {r('m', name='mean')}, {r('sd')}, has_nan, flat from lead_rows"""
    )
    o["signal_summary"] = _with(f"select file_name, {r('mean')}, {r('sd')} from summary")
    o["signal_flags"] = _with("select file_name, any_flat, any_nan from flags")
    o["reject_bad_signals"] = _with(
        """select count(*) as n, count(*) filter (where not any_flat and not any_nan) as n_kept,
        count(*) filter (where any_flat) as n_flat, count(*) filter (where any_nan) as n_nan from flags"""
    )
    long = f"select file_name, cast(lead as integer) as lead, cast(i as integer) as i, {r('value')} from"
    o["zscore_signal"] = _with(f"{long} zscores")
    o["signal_reshape"] = _with(f"{long} samples")
    o["augment_noise"] = _with(
        f"{long} noisy",
        noisy="""select file_name, lead, i, value - 0.5::double + ('0x' || substr(md5('42:1:' || file_name::varchar
          || ':' || lead::varchar || ':' || i::varchar), 1, 8))::bigint / 4294967296.0::double as value from samples""",
    )
    o["signal_quality"] = _with(
        f"select filename, {r('age')}, fs, {r('mean')}, {r('sd')}, all_zeros, any_nan, split from quality"
    )

    # splits, features, scores
    o["group_split"] = _with("select study_id, subject_id, split from split_records")
    o["group_split_exact"] = _with(
        """select r.study_id, r.subject_id, case when k.pos < n_test then 'test'
          when k.pos < n_test + ceil(0.2::double * (n - n_test)) then 'val' else 'train' end as split
        from record_list r join placed k on k.subject_id = r.subject_id""",
        subjects="select distinct subject_id from record_list",
        placed="""select subject_id, row_number() over (order by substr(md5('42:' || subject_id::varchar), 1, 8),
            subject_id) - 1 as pos, count(*) over () as n, ceil(0.2::double * count(*) over ()) as n_test
          from subjects""",
    )
    o["split_leaks"] = _with(
        """select subject_id, count(distinct split) as n_splits from (
          select subject_id, case when u < 0.2 then 'test' when u < 0.2::double + 0.8::double * 0.2::double then 'val'
            else 'train' end as split from hashes)
        group by subject_id having count(distinct split) > 1""",
        hashes="""select subject_id, ('0x' || substr(md5('42:' || study_id::varchar), 1, 8))::bigint
          / 4294967296.0::double as u from record_list""",
    )
    o["feature_rows"] = _with(_FEATURES)
    o["job_features"] = o["feature_rows_bucketed"] = o["feature_rows"]
    none = "null::double as age_input, null::double as gender_input"
    young, gender, kept = (r("age", name="label"), "age <= 90"), ("gender::double as label", "true"), "{0} is not null"
    views = {name: (none, *young) for name in "cnn-age resnet-age transformer-age transformer-age1 transformer-age2 transformer-age3".split()}
    views |= {name: (none, *gender) for name in "cnn-gender resnet-gender tl-age-sex transformer-gender".split()}
    views |= {f"{net}-{x}": (none, r(x, name="label"), kept.format(x)) for net in ("cnn", "resnet") for x in ("potassium", "sodium")}
    views["resnet-age2"] = ("null::double as age_input, gender::double as gender_input", *young)
    mortality = "icu_expire_flag::double as label", "icu_expire_flag is not null and age is not null"
    views["tl-age-mort"] = (f"{r('age', name='age_input')}, gender::double as gender_input", *mortality)
    o["task_views"] = _with(
        " union all ".join(
            f"select file_name, {inputs}, {label}, {r('weighted')}, '{name}' as task from features where {which}"
            for name, (inputs, label, which) in views.items()
        )
    )
    o["task_view_training"] = _with(
        f"""select f.file_name, f.gender::double as gender_input, {r('f.age', name='label')},
        {r('f.weighted + n.noise', name='weighted')} from features f join noise n on n.file_name = f.file_name where f.age <= 90""",
        noise=f"""select file_name, sum((lead * 8 + i + 1) * ({_unit_of("'1:' || file_name::varchar || ':' || lead::varchar || ':' || i::varchar")} - 0.5::double))
          as noise from samples group by file_name""",
    )
    sound = "samples s join flags f on f.file_name = s.file_name and not any_flat and not any_nan"
    o["score_batches"] = _with(
        f"select s.file_name, {r(_linear('value', '3'), name='score')} from {sound} group by s.file_name"
    )
    o["score_all_models"] = _with(
        f"""select s.file_name as study_id, {r(_linear('value', 'm.step'), name='score')}, m.model, m.version
        from {sound} cross join models m
        where not exists (select 1 from done d where d.study_id = s.file_name and d.model = m.model
          and d.version = m.version) group by s.file_name, m.model, m.version"""
    )

    # jobs
    o["job_lab_labels"] = o["labs_wide"]
    o["job_hosp_labels"] = _with(
        f"select study_id, hadm_id, hospital_expire_flag, icu_expire_flag, {r('ecg_offset')} from hosp1"
    )
    o["job_split"] = _with("select study_id, subject_id, ecg_age::double as ecg_age, split, false as leaked from split_records")
    o["job_quality"] = (
        o["quality_profile"]
        + " union all select split, 'rows', round(count(*)::double, 6) + 0.0::double from quality group by split"
    )
    o["job_age_mortality"] = _with(_RATES, **_bins("delta", "age_delta", 10))
    o["job_age_over_time"] = _with(
        f"""select stay_id, h.study_id,
          {r('(epoch_us(ecg_time) - epoch_us(icu_intime)) / 3600000000.0::double', name='ecg_delta')},
          {r('s.age_pred - h.admission_age', name='age_delta')}, hospital_expire_flag
        from hosp h left join scores s on s.study_id = h.study_id where stay_id in (select stay_id from chosen)""",
        chosen="""select stay_id from (select distinct stay_id from hosp where ecg_order = 2)
          order by substr(md5('42:' || stay_id::varchar), 1, 8), stay_id limit 250""",
    )
    o["job_history"] = _with(
        """select model, task, epoch, 'loss' as name, loss as value from t
        union all select model, task, epoch, 'val_loss', val_loss from t""",
        t="""select *, case when split_part(model, '-', 2) = 'age2' then 'age' else split_part(model, '-', 2) end as task
          from history""",
    )
    return o
