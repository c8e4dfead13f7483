"""The queries of the registry as plain SQL over the parquet tables, for the check."""

from __future__ import annotations

from namelens.bindings import duckdb_text
from namelens.registry import RUN_TIME, SAMPLE_SIZE, VERSION
from namelens.schemas import VOTER_FIELDS

RUN_TS = f"'{RUN_TIME}'"


def name(c: str) -> str:
    return f"nullif(regexp_replace(lower(trim({c})),'[^a-z]','','g'),'')"


def zip5(c: str) -> str:
    digits = f"regexp_replace({c},'[^0-9]','','g')"
    return f"case when length({digits}) >= 5 then substr({digits},1,5) end"


def gender(c: str) -> str:
    return f"case when upper(trim({c})) in ('M','MALE') then 'M' when upper(trim({c})) in ('F','FEMALE') then 'F' end"


def ratio(a: str, b: str) -> str:
    return f"round(cast({a} as double)/nullif(cast({b} as double),0),6)"


def ts(c: str) -> str:
    return f"strftime({c},'%Y-%m-%d %H:%M:%S')"


def bucket(c: str) -> str:
    return f"floor({c}*10)/10"


AGES = {
    "generic": ([(0, 24), (25, 44), (45, 64), (65, None)], (0.70, 0.55, 0.40)),
    "specific": (
        [(0, 17), (18, 24), (25, 34), (35, 44), (45, 54), (55, 64), (65, None)],
        (0.85, 0.70, 0.60),
    ),
}


def label(lo: int, hi: int | None) -> str:
    return f"{lo}_PLUS" if hi is None else f"{lo}_{hi}"


def in_bucket(age: str, lo: int, hi: int | None) -> str:
    return f"{age} >= {lo}" if hi is None else f"{age} between {lo} and {hi}"


def score_gender(counts: str) -> str:
    return f"""
select first_name, male_qty, female_qty, total_qty, male_probability, female_probability,
 greatest(male_probability, female_probability) max_probability,
 round(abs(male_probability - female_probability),6) probability_gap,
 case when male_probability > female_probability then 'M'
      when female_probability > male_probability then 'F' else 'U' end predicted_gender,
 case when greatest(male_probability, female_probability) >= 0.75 and male_probability > female_probability then 'M'
      when greatest(male_probability, female_probability) >= 0.75 and female_probability > male_probability then 'F' else 'U' end reportable_gender,
 case when greatest(male_probability, female_probability) >= 0.90 then 'HIGH'
      when greatest(male_probability, female_probability) >= 0.75 then 'MEDIUM'
      when greatest(male_probability, female_probability) >= 0.60 then 'LOW' else 'AMBIGUOUS' end confidence_level,
 cast(case when total_qty < 100 then 1 else 0 end as bigint) is_rare_name
from (select *, male_qty + female_qty total_qty, {ratio('male_qty','male_qty+female_qty')} male_probability,
  {ratio('female_qty','male_qty+female_qty')} female_probability from ({counts}))
"""


def age_lookup(kind: str) -> str:
    bounds, (high, medium, low) = AGES[kind]
    stems = [f"age_{label(*b).lower()}" for b in bounds]
    sums = ", ".join(
        f"cast(sum(case when {in_bucket('2026-year', *b)} then quantity else 0 end) as bigint) {s}_qty"
        for b, s in zip(bounds, stems)
    )
    qtys = ", ".join(f"{s}_qty" for s in stems)
    probs = ", ".join(f"{ratio(s + '_qty', 'total_qty')} {s}_probability" for s in stems)
    cases = " ".join(
        f"when {s}_qty >= greatest({qtys}) then '{label(*b)}'" for b, s in zip(bounds, stems)
    )
    return f"""
select *, case when total_qty < 250 then 'AMBIGUOUS' when max_probability >= {high} then 'HIGH'
  when max_probability >= {medium} then 'MEDIUM' when max_probability >= {low} then 'LOW' else 'AMBIGUOUS' end confidence_level,
 cast(case when total_qty < 100 then 1 else 0 end as bigint) is_rare_name
from (select first_name, cast(2026 as bigint) reference_year, {qtys}, total_qty, {probs},
  {ratio(f'greatest({qtys})', 'total_qty')} max_probability, case {cases} end predicted_age_bucket
  from (select *, {' + '.join(f'{s}_qty' for s in stems)} total_qty
    from (select first_name, {sums} from stage where first_name is not null group by first_name)))
"""


def age_actual(kind: str) -> str:
    cases = " ".join(
        f"when {in_bucket('2026-birth_year', *b)} then '{label(*b)}'" for b in AGES[kind][0]
    )
    return f"case {cases} end"


# Named steps; a query lists the ones it needs and `sql` adds those they need in turn.
STEPS: dict[str, str] = {
    "stage": f"""select {name('first_name')} first_name, {gender('gender')} gender,
 cast(quantity as bigint) quantity, cast(year as bigint) as year from ssa_raw
 where first_name is not null and {gender('gender')} is not null and quantity is not null and year is not null""",
    "voters": f"""select state_voter_id, name_suffix, {name('first_name')} first_name, {name('middle_name')} middle_name,
 {name('last_name')} last_name, {gender('gender')} gender, cast(birth_year as bigint) birth_year,
 {zip5('registration_zip_code')} registration_zip_code, registration_state,
 {zip5('mailing_zip_code')} mailing_zip_code, mailing_state, {ts('loaded_ts')} loaded_ts
 from voter_raw where {name('first_name')} is not null and {gender('gender')} is not null""",
    "clean": f"""select *, cast(first_name_clean is null as bigint) first_name_missing_flag,
 cast(last_name_clean is null as bigint) last_name_missing_flag, cast(zip5 is null as bigint) zip_unusable_flag,
 length(first_name_clean) first_name_length, length(last_name_clean) last_name_length, {ts('load_time')} load_ts
 from (select client_id, batch_id, record_id, first_name first_name_raw, last_name last_name_raw, zip zip_raw,
  {name('first_name')} first_name_clean, {name('last_name')} last_name_clean, {zip5('zip')} zip5, load_ts load_time from person_input)""",
    "genders": score_gender(
        "select first_name, cast(sum(case when gender='M' then quantity else 0 end) as bigint) male_qty,"
        " cast(sum(case when gender='F' then quantity else 0 end) as bigint) female_qty from stage group by first_name"
    ),
    "ages_generic": age_lookup("generic"),
    "ages_specific": age_lookup("specific"),
    "people": """select p.client_id, p.batch_id, p.record_id, p.first_name_raw, p.last_name_raw, p.zip_raw,
 p.first_name_clean, p.last_name_clean, p.zip5, p.first_name_missing_flag, p.zip_unusable_flag, p.first_name_length, p.load_ts,
 cast(l.first_name is not null as bigint) ssa_lookup_match_flag, l.male_qty ssa_male_qty, l.female_qty ssa_female_qty,
 l.total_qty ssa_total_qty, l.male_probability ssa_male_probability, l.female_probability ssa_female_probability,
 l.max_probability ssa_max_probability, l.probability_gap ssa_probability_gap, l.predicted_gender ssa_predicted_gender,
 l.confidence_level ssa_confidence_level, l.is_rare_name ssa_is_rare_name, l.reportable_gender ssa_reportable_gender
 from clean p left join genders l on p.first_name_clean = l.first_name""",
    "improvement": f"""select client_id, batch_id, record_id, first_name_raw, first_name_clean, last_name_raw, last_name_clean,
 zip_raw, zip5, ssa_male_probability, ssa_female_probability, ssa_confidence_level, ssa_lookup_match_flag,
 ssa_predicted_gender, ssa_reportable_gender, '{VERSION}' model_version
 from people join client on people.client_id = client.id where model_improvement_program_participant""",
    "results": f"""select client_id, batch_id, record_id, ssa_predicted_gender predicted_gender, ssa_reportable_gender reportable_gender,
 ssa_confidence_level confidence_level, ssa_max_probability max_probability, ssa_probability_gap probability_gap,
 '{VERSION}' model_version, load_ts processed_ts, first_name_missing_flag, ssa_is_rare_name is_rare_name_flag,
 ssa_male_probability male_probability, ssa_female_probability female_probability, ssa_lookup_match_flag name_match_found_flag
 from people""",
    "old_results": """select client_id, batch_id, record_id, 'U' predicted_gender, 'U' reportable_gender, 'LOW' confidence_level,
 cast(0.5 as double) max_probability, cast(0 as double) probability_gap, 'v0.00' model_version, '2026-01-01 00:00:00' processed_ts,
 cast(0 as bigint) first_name_missing_flag, cast(0 as bigint) is_rare_name_flag, cast(0.5 as double) male_probability,
 cast(0.5 as double) female_probability, cast(1 as bigint) name_match_found_flag from old_records""",
    "parsed": """select *, nullif(regexp_extract(storage_file_name,'client_([^/]+)',1),'') app_organization_id,
 nullif(regexp_extract(storage_file_name,'batch_([^/]+)',1),'') app_batch_id,
 regexp_extract(storage_file_name,'[^/]+$') file_basename,
 regexp_replace(regexp_extract(storage_file_name,'[^/]+$'),'^[^_]+_','') original_source_file_name from landing""",
    "batch_keys": """select c.app_organization_id, b.app_batch_id, b.client_id, b.id batch_id
 from client_batch b join client c on c.id = b.client_id""",
    "request_keys": """select c.app_organization_id, b.app_batch_id, b.client_id, b.id batch_id
 from request_batch b join request_client c on c.id = b.client_id""",
    "decisions": f"""select app_organization_id, app_batch_id, status, requested_credits, approved_credits, denial_reason,
 {ts('decision_ts')} decision_ts, {ts('created_ts')} created_ts, seq from (select *, row_number() over (
  partition by app_organization_id, app_batch_id order by coalesce(decision_ts, created_ts) desc, seq desc) rn
 from approval_results) where rn = 1""",
    "open_keys": "select client_id, id batch_id from client_batch where delivery_complete_ts is null",
    "wide_status": f"""select client_id, batch_id, app_batch_id, enrichment_type, enrichment_type_code, enrichment_status,
 enrichment_metrics_payload, {ts('started_ts')} started_ts, {ts('completed_ts')} completed_ts, error_message,
 {ts('created_ts')} created_ts, {ts('updated_ts')} updated_ts from enrichment_status""",
    "running_status": f"""select client_id, batch_id, app_batch_id, enrichment_type, enrichment_type_code,
 case when enrichment_status='PENDING' then 'RUNNING' else enrichment_status end enrichment_status, enrichment_metrics_payload,
 case when enrichment_status='PENDING' then coalesce(started_ts, {RUN_TS}) else started_ts end started_ts, completed_ts,
 case when enrichment_status='PENDING' then null else error_message end error_message, created_ts,
 case when enrichment_status='PENDING' then {RUN_TS} else updated_ts end updated_ts,
 enrichment_status='PENDING' as was_pending from wide_status""",
    "candidates": """select distinct client_id, batch_id from request_keys k
 where exists (select 1 from enrichment_status s where s.client_id=k.client_id and s.batch_id=k.batch_id)
 and not exists (select 1 from enrichment_status s where s.client_id=k.client_id and s.batch_id=k.batch_id and s.enrichment_status <> 'COMPLETED')""",
    "blocks": """select client_id, batch_id, string_agg(enrichment_metrics_payload, ',' order by enrichment_type_code) analysis
 from enrichment_status where enrichment_status='COMPLETED' and enrichment_metrics_payload like '{"analysis%' group by all""",
    "messages": f"""select k.client_id, k.batch_id, k.app_batch_id, k.app_organization_id,
 '{{"batch_id":"' || k.app_batch_id || '","delivery_status":"READY","delivery_status_updated_at":"' || {RUN_TS} || '.000 +0000","file_analysis":['
 || coalesce(b.analysis,'') || '],"organization_id":"' || k.app_organization_id || '"}}' payload,
 'DELIVERY_STATUS_UPDATED' event_type, 'READY' status, cast(0 as bigint) attempt_count, {RUN_TS} created_ts
 from request_keys k left join blocks b on b.client_id=k.client_id and b.batch_id=k.batch_id""",
}


def metrics(matched_only: bool) -> str:
    """The metrics as separate branches, one scan each."""
    matched = "where ssa_lookup_match_flag = 1" if matched_only else ""

    def branch(metric, kind, show, labelled, value, label_sort, sort, where, extra=""):
        return f"""select client_id, batch_id, '{VERSION}' model_version, '{metric}' metric_name, '{kind}' metric_type,
 '{show}' metric_display_type, {labelled} metric_label, cast({value} as double) metric_value, {label_sort} metric_label_sort,
 cast({sort} as bigint) metric_sort, max(load_ts) processed_ts from people {where} group by client_id, batch_id{extra}"""

    parts = [
        branch("Gender", "COUNT", "INTEGER", "ssa_reportable_gender", "count(*)", "'VALUE'", 1, matched, ", ssa_reportable_gender"),
        branch("Confidence Level", "COUNT", "INTEGER", "ssa_confidence_level", "count(*)", "'CONFIDENCE'", 2, matched, ", ssa_confidence_level"),
        branch("Uncommon Names", "COUNT", "INTEGER", "'TOTAL_UNCOMMON_NAMES'", "count(case when ssa_is_rare_name=1 then 1 end)", "null", 3, matched),
        branch("Missing First Name", "COUNT", "INTEGER", "'MISSING_FIRST_NAME'", "count(case when first_name_missing_flag=1 then 1 end)", "null", 4, ""),
    ]
    if matched_only:
        parts.append(branch("Unmatched Records", "COUNT", "INTEGER", "'UNMATCHED'", "count(case when ssa_lookup_match_flag=0 then 1 end)", "null", 5, ""))
    n = len(parts)
    for offset, (title, col) in enumerate([("Max Probability", "max_probability"), ("Probability Gap", "probability_gap")], start=1):
        # Millionths as whole numbers, so that the mean is rounded from exact sums.
        micros = f"cast(round(ssa_{col}*1000000) as bigint)"
        parts.append(
            branch(f"Average {title}", "AVERAGE", "PERCENT", f"'AVERAGE_{col.upper()}'", f"round(avg({micros}))/1000000", "null", n + offset, matched)
        )
    return " union all ".join(parts)


STEPS["metrics"] = metrics(True)
STEPS["older_metrics"] = metrics(False)


def payloads(source: str) -> str:
    value = "case when metric_type='COUNT' then cast(cast(metric_value as bigint) as varchar) else rtrim(rtrim(cast(cast(metric_value as decimal(12,6)) as varchar),'0'),'.') end"
    # Null labels and null values are left out.
    item = f"""'{{' || concat_ws(',', '"label":"' || metric_label || '"', '"value":' || {value}) || '}}'"""
    return f"""select client_id, batch_id, model_version, '{{"analysis_type":"gender_metrics","metrics":[' ||
 string_agg(block, ',' order by metric_sort, metric_name) || ']}}' enrichment_metrics_payload from (
 select client_id, batch_id, model_version, metric_sort, metric_name,
  '{{"metric_display_type":"' || any_value(metric_display_type) || '",' || coalesce('"metric_label_sort":"' || any_value(metric_label_sort) || '",','')
  || '"metric_name":"' || metric_name || '","metric_sort":' || metric_sort || ',"metric_type":"' || any_value(metric_type) || '","metrics":['
  || string_agg({item}, ',' order by metric_label nulls last) || ']}}' block
 from {source} group by client_id, batch_id, model_version, metric_sort, metric_name) group by client_id, batch_id, model_version"""


STEPS["payloads"] = payloads("metrics")
STEPS["older_payloads"] = payloads("older_metrics")


def merged(target: str, source: str, keys: list[str], columns: list[str], updated: list[str], inserted: dict[str, str] | None = None, sets: dict[str, str] | None = None) -> str:
    """A merge as a full outer join."""
    inserted, sets = inserted or {}, sets or {}
    out = []
    for c in columns:
        new = f"s.{c}" if c in keys or c in updated else inserted.get(c, "null")
        if c in keys:
            value = f"coalesce(t.{c}, s.{c})"
        elif c in sets:
            value = f"case when t._t and s._s then {sets[c]} when t._t then t.{c} else {inserted.get(c, 'null')} end"
        elif c in updated:
            value = f"case when s._s then s.{c} else t.{c} end"
        else:
            value = f"case when t._t then t.{c} else {new if c not in inserted else inserted[c]} end"
        out.append(f"{value} {c}")
    on = " and ".join(f"t.{k} = s.{k}" for k in keys)
    return f"select {', '.join(out)} from (select *, true _t from {target}) t full outer join (select *, true _s from {source}) s on {on}"


RECORD = ["client_id", "batch_id", "record_id"]
RESULT_COLUMNS = [
    "predicted_gender", "reportable_gender", "confidence_level", "max_probability", "probability_gap",
    "model_version", "processed_ts", "first_name_missing_flag", "is_rare_name_flag",
    "male_probability", "female_probability", "name_match_found_flag",
]
STORE_COLUMNS = [
    "first_name_raw", "first_name_clean", "last_name_raw", "last_name_clean", "zip_raw", "zip5",
    "ssa_male_probability", "ssa_female_probability", "ssa_confidence_level", "ssa_lookup_match_flag",
    "ssa_predicted_gender", "ssa_reportable_gender", "model_version",
]
STEPS["old_store"] = (
    "select client_id, batch_id, record_id, 'LOW' ssa_confidence_level, 'v0.00' model_version, '2026-01-01 00:00:00' opted_in_data_loaded_ts, "
    + ", ".join(
        f"cast(null as {'double' if 'probability' in c else 'bigint' if 'flag' in c else 'varchar'}) {c}"
        for c in STORE_COLUMNS if c not in ("ssa_confidence_level", "model_version")
    )
    + " from old_records"
)
STEPS["downloads"] = """select r.client_id, r.batch_id, r.record_id, r.first_name, r.last_name, r.zip, g.male_probability, g.female_probability,
 g.confidence_level gender_confidence_level, g.reportable_gender predicted_gender
 from person_input r left join (select results.* from results join open_keys using (client_id, batch_id)) g
 on r.client_id=g.client_id and r.batch_id=g.batch_id and r.record_id=g.record_id"""


def age_baseline(kind: str) -> str:
    return f"""select p.client_id, p.batch_id, p.record_id, p.first_name_raw, p.last_name_raw, p.zip_raw, p.first_name_clean,
 p.last_name_clean, p.zip5, p.first_name_missing_flag, p.zip_unusable_flag, p.first_name_length, p.load_ts,
 cast(l.first_name is not null as bigint) ssa_age_lookup_match_flag, l.total_qty ssa_age_total_qty, l.max_probability ssa_age_max_probability,
 l.predicted_age_bucket ssa_predicted_age_bucket, l.confidence_level ssa_age_confidence_level, l.is_rare_name ssa_age_is_rare_name
 from clean p left join ages_{kind} l on p.first_name_clean = l.first_name"""


def accuracy(by_bucket: bool) -> str:
    extra = f", {bucket('max_probability')} max_probability_bucket" if by_bucket else ""
    group = ", max_probability_bucket" if by_bucket else ""
    return f"""select confidence_level{group}, {ratio('sum(case when predicted_gender=gender then 1 else 0 end)', 'count(*)')} ssa_predicted_accuracy,
 {ratio('sum(case when reportable_gender=gender then 1 else 0 end)', 'count(*)')} ssa_reported_accuracy, count(*) record_count
 from (select s.confidence_level, s.predicted_gender, s.reportable_gender, v.gender{extra.replace('max_probability*', 's.max_probability*')}
 from genders s join voters v on s.first_name = v.first_name) group by confidence_level{group}"""


def age_accuracy(kind: str, by_bucket: bool) -> str:
    group = "prob_bucket" if by_bucket else "confidence_level"
    return f"""select {group}, count(*) total_records, count(case when actual = predicted_age_bucket then 1 end) correct_records,
 {ratio('count(case when actual = predicted_age_bucket then 1 end)', 'count(*)')} percent_accuracy from (
 select s.confidence_level, {bucket('s.max_probability')} prob_bucket, s.predicted_age_bucket, v.actual
 from (select first_name, {age_actual(kind)} actual from voters) v {'join' if by_bucket else 'left join'} ages_{kind} s on v.first_name = s.first_name
 where v.actual is not null) group by {group}"""


def delivery_result() -> str:
    return """select id, http_status between 200 and 299 is true as ok,
 case when http_status between 200 and 299 then null else coalesce('HTTP ' || http_status || ': ' || substr(coalesce(body,''),1,5000), substr(error,1,5000)) end as message
 from delivery_outcomes"""


STEPS["judged"] = delivery_result()
OUTBOX_COLUMNS = "client_id, batch_id, app_batch_id, app_organization_id, payload, event_type, status, cast(attempt_count as bigint) attempt_count"
LARGEST = "(select batch_id from person_input group by batch_id order by count(*) desc, batch_id limit 1)"
NUMERIC_FIRST = "try_cast(record_id as bigint) is null, try_cast(record_id as bigint), record_id"

ORACLES: dict[str, str] = {
    "landing_rows": """select app_organization_id, app_batch_id, cast(count(*) as bigint) records, true numbered,
 cast(sum(cast(zip as bigint)) as bigint) zips, cast(sum(length(first_name)+length(last_name)) as bigint) letters
 from (select * replace (coalesce(app_organization_id,'none') as app_organization_id) from parsed) group by app_organization_id, app_batch_id""",
    "append_stream": f"""select client_id, batch_id, enrichment_type_code, enrichment_status, {ts('updated_ts')} updated_ts, count(*) times_seen
 from enrichment_status group by all""",
    "upload_to_results": f"""select c.id client_id, p.record_id, l.predicted_gender, l.reportable_gender, l.confidence_level, l.max_probability,
 l.probability_gap, '{VERSION}' model_version, {ts('p.load_ts')} processed_ts, cast({name('p.first_name')} is null as bigint) first_name_missing_flag,
 l.is_rare_name is_rare_name_flag, l.male_probability, l.female_probability, cast(l.first_name is not null as bigint) name_match_found_flag,
 p.app_batch_id, count(*) over (partition by c.id, p.app_batch_id) processed_record_count, {RUN_TS} delivery_complete_ts, 'READY' message_status
 from parsed p join client c on c.app_organization_id = p.app_organization_id left join genders l on l.first_name = {name('p.first_name')}""",
    "safe_cast_load": """select cast(try_cast(state_voter_id as bigint) as double) state_voter_id, first_name,
 try_cast(trim(birth_year) as bigint) birth_year, cast(coalesce(cast(try_strptime(registration_date,'%Y-%m-%d') as date),
 cast(try_strptime(registration_date,'%m/%d/%Y') as date)) as varchar) registration_date from voter_text""",
    "export_projection": """select record_id, trim(first_name) first_name, last_name, zip, cast(cast(male_probability as decimal(10,6)) as varchar) male_probability,
 cast(cast(female_probability as decimal(10,6)) as varchar) female_probability, gender_confidence_level, predicted_gender,
 app_organization_id, app_batch_id from downloads join batch_keys using (client_id, batch_id)""",
    "sample_client_file": f"""select cast(state_voter_id as varchar) record_id, first_name, last_name, registration_zip_code zip
 from voters order by state_voter_id limit {SAMPLE_SIZE}""",
    "normalize_name": f"""select client_id, batch_id, record_id, {name('first_name')} first_name_clean, {name('last_name')} last_name_clean,
 nullif(regexp_replace(lower(trim(first_name)),'\\P{{L}}+','','g'),'') first_name_letters from person_input""",
    "normalize_zip5": f"select state_voter_id, {zip5('registration_zip_code')} registration_zip5, {zip5('mailing_zip_code')} mailing_zip5 from voter_raw",
    "normalize_gender": f"select state_voter_id, {gender('gender')} gender_clean from voter_raw",
    "sql_functions": f"""select state_voter_id, {name('first_name')} first_name, {zip5('registration_zip_code')} zip5,
 {gender('gender')} gender from voter_raw""",
    "parse_upload_path": "select record_id, app_organization_id, app_batch_id, file_basename, original_source_file_name from parsed",
    "name_search": "select * from genders where first_name ilike '%RING%'",
    "ssa_stage": "select * from stage",
    "person_clean": "select * exclude (load_time) from clean",
    "voter_stage": "select * from voters",
    "gender_lookup": "select * from genders",
    "voter_gender_lookup": score_gender(
        "select first_name, count(case when gender='M' then 1 end) male_qty, count(case when gender='F' then 1 end) female_qty from voters group by first_name"
    ),
    "age_lookup_generic": "select * from ages_generic",
    "age_lookup_specific": "select * from ages_specific",
    "gender_baseline": "select * from people",
    "age_baseline_expanded": age_baseline("specific"),
    "age_baseline_collapsed": age_baseline("generic"),
    "low_confidence": """select client_id, batch_id, record_id, first_name_raw, first_name_clean, zip_raw, zip5, ssa_predicted_gender,
 ssa_reportable_gender, ssa_male_probability, ssa_female_probability ssa_female_probablity, ssa_confidence_level, model_version
 from improvement where ssa_confidence_level in ('LOW','AMBIGUOUS')""",
    "unmatched_report": f"""select client_id, batch_id, total_records, unmatched_records, {ratio('unmatched_records','total_records')} percent_unmatched,
 matched_low_records, {ratio('matched_low_records','total_records')} percent_low, matched_ambiguous_records,
 {ratio('matched_ambiguous_records','total_records')} percent_amgiguous, matched_low_records + matched_ambiguous_records match_low_ambiguous_records,
 {ratio('(matched_low_records + matched_ambiguous_records)','total_records')} percent_low_amgiguous
 from (select client_id, batch_id, count(*) total_records, count(case when ssa_lookup_match_flag=0 then 1 end) unmatched_records,
 count(case when ssa_confidence_level='LOW' then 1 end) matched_low_records, count(case when ssa_confidence_level='AMBIGUOUS' then 1 end) matched_ambiguous_records
 from improvement group by client_id, batch_id)""",
    "batch_gender_summary": f"""select cast(client_id as varchar) client_id, cast(batch_id as varchar) batch_id, '{VERSION}' model_version,
 count(*) total_records, count(case when first_name_missing_flag=0 then 1 end) usable_first_name_records, count(case when ssa_lookup_match_flag=1 then 1 end) ssa_lookup_match_records,
 {ratio('count(case when ssa_lookup_match_flag=1 then 1 end)','count(*)')} ssa_lookup_match_rate, count(case when ssa_confidence_level='HIGH' then 1 end) high_confidence_records,
 count(case when ssa_confidence_level='MEDIUM' then 1 end) medium_confidence_records, count(case when ssa_confidence_level='LOW' then 1 end) low_confidence_records,
 count(case when ssa_confidence_level='AMBIGUOUS' then 1 end) ambiguous_records, count(case when ssa_reportable_gender='M' then 1 end) reportable_m_records,
 count(case when ssa_reportable_gender='F' then 1 end) reportable_f_records, count(case when ssa_reportable_gender='U' then 1 end) reportable_u_records,
 max(load_ts) processed_ts from people group by people.client_id, people.batch_id""",
    "batch_metrics": "select * from metrics",
    "batch_metrics_all_rows": "select * from older_metrics",
    "metrics_payload": "select * from payloads",
    "metrics_delivery_payload": f"""select k.client_id, k.batch_id, k.app_batch_id, k.app_organization_id,
 '{{"batch_id":"' || k.app_batch_id || '","delivery_status":"READY","delivery_status_updated_at":"' || {RUN_TS} || '.000 +0000","file_analysis":['
 || coalesce(p.enrichment_metrics_payload,'') || '],"organization_id":"' || k.app_organization_id || '"}}' payload,
 'DELIVERY_STATUS_UPDATED' event_type, 'READY' status, cast(0 as bigint) attempt_count, {RUN_TS} created_ts
 from batch_keys k join open_keys o using (client_id, batch_id) left join older_payloads p using (client_id, batch_id)""",
    "delivery_payload": "select * from messages",
    "config_select_list": """select app_organization_id, app_batch_id, case when config_json like '%FIRST_NAME%' then 'SRC.FIRST_NAME, ' else '' end
 || 'SRC.RECORD_ID, SRC.MALE_PROBABILITY, SRC.PREDICTED_GENDER' select_list from output_config""",
    "gender_accuracy": accuracy(False),
    "gender_accuracy_by_bucket": accuracy(True),
    "age_accuracy_specific": age_accuracy("specific", False),
    "age_accuracy_generic": age_accuracy("generic", False),
    "age_accuracy_by_bucket": age_accuracy("generic", True),
    "age_accuracy_by_bucket_specific": age_accuracy("specific", True),
    "prob_histogram": f"select {bucket('max_probability')} prob_bucket, count(*) records from ages_specific group by 1",
    "confidence_distribution": "select ssa_confidence_level, count(*) record_count from people group by 1",
    "non_high_records": """select first_name_raw, first_name_clean, ssa_is_rare_name, ssa_confidence_level, ssa_female_probability,
 ssa_male_probability, ssa_predicted_gender, ssa_reportable_gender from people where ssa_confidence_level <> 'HIGH'""",
    "batch_record_counts": """select p.client_id, p.batch_id, b.app_batch_id, count(*) record_count from person_input p
 join client_batch b on b.client_id=p.client_id and b.id=p.batch_id group by 1, 2, 3""",
    "approval_requests": f"""select q.app_organization_id organization_id, q.app_batch_id batch_id, {ts('q.created_ts')} created_at,
 coalesce(max(b.record_count),0) record_count from approval_queue q join request_batch b on b.app_batch_id=q.app_batch_id
 where q.status='PENDING' group by 1, 2, 3""",
    "pending_queue_rows": """select distinct client_id, batch_id, app_batch_id, enrichment_type_code, enrichment_type
 from enrichment_status where enrichment_status='PENDING'""",
    "register_batches": """select client_id, file_name, record_count, app_batch_id, storage_file_name,
 (select max(id) from client_batch where delivery_complete_ts is not null) + row_number() over (order by storage_file_name) id
 from (select c.id client_id, p.original_source_file_name file_name, count(*) record_count, p.app_batch_id, p.storage_file_name
 from parsed p join client c on c.app_organization_id = p.app_organization_id
 left join (select * from client_batch where delivery_complete_ts is not null) b on b.app_batch_id = p.app_batch_id and b.client_id = c.id
 where b.id is null group by 1, 2, 4, 5)""",
    "raw_insert_absent": f"""select k.client_id, k.batch_id, p.record_id, p.first_name, p.last_name, p.zip, {ts('p.load_ts')} load_ts
 from parsed p join batch_keys k using (app_organization_id, app_batch_id) where not exists (select 1 from old_records r
 where r.client_id=k.client_id and r.batch_id=k.batch_id and r.record_id=p.record_id)""",
    "enqueue_approval": f"""with known as (select k.* from batch_keys k join client_batch b on b.id=k.batch_id and b.client_id=k.client_id where b.delivery_complete_ts is not null)
 select app_organization_id, app_batch_id, batch_id, 'APPROVED' status, '2026-04-01 00:00:00' created_ts, '2026-04-01 00:00:00' updated_ts from known
 union all select distinct app_organization_id, app_batch_id, batch_id, 'PENDING', {RUN_TS}, {RUN_TS} from parsed join batch_keys using (app_organization_id, app_batch_id)
 where not exists (select 1 from known where known.app_organization_id=parsed.app_organization_id and known.app_batch_id=parsed.app_batch_id)""",
    "latest_approval": "select * from decisions",
    "apply_decisions": f"""select q.app_organization_id, q.app_batch_id, q.batch_id, case when d.seq is null then q.status else d.status end status,
 d.requested_credits, d.approved_credits, d.denial_reason, d.decision_ts, {ts('q.created_ts')} created_ts,
 case when d.seq is null then {ts('q.updated_ts')} else {RUN_TS} end updated_ts
 from approval_queue q left join decisions d using (app_organization_id, app_batch_id)""",
    "enrichment_requests": """select distinct k.client_id, k.batch_id, k.app_batch_id, a.label enrichment_type, a.code enrichment_type_code, 'PENDING' enrichment_status
 from decisions d join request_keys k using (app_organization_id, app_batch_id) join (
  select app_organization_id, app_batch_id, unnest(from_json(json_extract(config_json,'$.attributes'),'[{"code":"VARCHAR","label":"VARCHAR"}]'), recursive := true) from output_config) a
 using (app_organization_id, app_batch_id) where d.status='APPROVED' and a.code is not null and not exists (
 select 1 from enrichment_status s where s.client_id=k.client_id and s.batch_id=k.batch_id and s.app_batch_id=k.app_batch_id and s.enrichment_type_code=a.code)""",
    "purge_approved_landing": """select record_id, storage_file_name from request_landing p where not exists (select 1 from decisions t
 join request_client c on c.app_organization_id=t.app_organization_id join request_batch b on b.client_id=c.id and b.app_batch_id=t.app_batch_id
 where b.storage_file_name=p.storage_file_name and t.status='APPROVED')""",
    "advance_status": "select * exclude (was_pending) from running_status",
    "fail_unsupported": f"""select * exclude (was_pending, bad) replace (case when bad then 'FAILED' else enrichment_status end as enrichment_status,
 case when bad then 'Unsupported enrichment type code.' else error_message end as error_message, case when bad then {RUN_TS} else updated_ts end as updated_ts)
 from (select *, was_pending and enrichment_type_code not in (select code from attribute) bad from running_status)""",
    "open_batches": "select client_id, batch_id, count(*) record_count from person_input join open_keys using (client_id, batch_id) group by 1, 2",
    "upsert_results": merged("old_results", "results", RECORD, RECORD + RESULT_COLUMNS, RESULT_COLUMNS),
    "model_improvement_upsert": merged(
        "old_store", "improvement", RECORD, [*RECORD, *STORE_COLUMNS, "opted_in_data_loaded_ts"], STORE_COLUMNS,
        {"opted_in_data_loaded_ts": RUN_TS},
    ),
    "metrics_upsert": """select coalesce(t.client_id,s.client_id) client_id, coalesce(t.batch_id,s.batch_id) batch_id,
 coalesce(t.model_version,s.model_version) model_version, coalesce(t.metric_name,s.metric_name) metric_name,
 coalesce(t.metric_type,s.metric_type) metric_type, coalesce(t.metric_display_type,s.metric_display_type) metric_display_type,
 coalesce(t.metric_label,s.metric_label) metric_label, coalesce(s.metric_value,case when s.client_id is null then t.metric_value end) metric_value,
 case when t.client_id is null then s.metric_label_sort else t.metric_label_sort end metric_label_sort,
 case when t.client_id is null then s.metric_sort else t.metric_sort end metric_sort, coalesce(s.processed_ts,t.processed_ts) processed_ts
 from older_metrics t full outer join metrics s on t.client_id=s.client_id and t.batch_id=s.batch_id and t.model_version=s.model_version
 and t.metric_name=s.metric_name and t.metric_type=s.metric_type and t.metric_label=s.metric_label""",
    "complete_status": f"""select * exclude (hit) replace (case when hit then 'COMPLETED' else enrichment_status end as enrichment_status,
 case when hit then (select '{{"records":' || coalesce(b.record_count,0) || '}}' from request_batch b where b.id=batch_id) else enrichment_metrics_payload end as enrichment_metrics_payload,
 case when hit then {RUN_TS} else completed_ts end as completed_ts, case when hit then null else error_message end as error_message,
 case when hit then {RUN_TS} else updated_ts end as updated_ts)
 from (select *, enrichment_type_code='GNDRPR' and batch_id in (select batch_id from enrichment_status where enrichment_status='PENDING') hit from wide_status)""",
    "completion_candidates": "select * from candidates",
    "complete_batches": f"""select b.id, b.client_id, b.app_batch_id, b.storage_file_name, b.record_count,
 case when k.batch_id is not null then coalesce(r.n,0) end processed_record_count, case when k.batch_id is not null then {RUN_TS} end delivery_complete_ts
 from request_batch b left join candidates k on k.client_id=b.client_id and k.batch_id=b.id
 left join (select client_id, batch_id, count(*) n from request_people group by 1, 2) r on r.client_id=b.client_id and r.batch_id=b.id""",
    "outbox_upsert": f"""select t.client_id, t.batch_id, t.app_batch_id, t.app_organization_id, case when t.processed_ts is null then m.payload else t.payload end payload,
 t.event_type, case when t.processed_ts is null then m.status else t.status end status, cast(t.attempt_count as bigint) attempt_count, {ts('t.last_attempt_ts')} last_attempt_ts,
 t.last_error, {ts('t.created_ts')} created_ts, {ts('t.processed_ts')} processed_ts
 from outbox t join messages m on m.client_id=t.client_id and m.batch_id=t.batch_id
 union all select m.client_id, m.batch_id, m.app_batch_id, m.app_organization_id, m.payload, m.event_type, m.status, m.attempt_count, null, null, m.created_ts, null
 from messages m where not exists (select 1 from outbox t where t.client_id=m.client_id and t.batch_id=m.batch_id and t.processed_ts is null)""",
    "purge_delivered": f"""select * replace ({ts('load_ts')} as load_ts) from person_input p where not exists (
 select 1 from client_batch b where b.client_id=p.client_id and b.id=p.batch_id and b.delivery_complete_ts is not null)""",
    "single_batch_results": f"select *, row_number() over (order by {NUMERIC_FIRST}) place from results where batch_id = {LARGEST}",
    "download_rows": "select * from downloads",
    "pending_downloads": """select k.app_organization_id, k.app_batch_id, r.client_id, r.batch_id, r.record_id, r.first_name, r.last_name, r.zip,
 g.male_probability, g.female_probability, g.confidence_level gender_confidence_level, g.reportable_gender predicted_gender
 from (select distinct app_organization_id, app_batch_id from download_queue where processing_status='PENDING') q join batch_keys k using (app_organization_id, app_batch_id)
 join person_input r using (client_id, batch_id) left join results g on g.client_id=r.client_id and g.batch_id=r.batch_id and g.record_id=r.record_id""",
    "download_ready_upsert": f"""select k.app_organization_id, k.app_batch_id, 'downloads/' || k.app_organization_id || '/' || k.app_batch_id || '/results_' || k.app_batch_id || '.csv.gz' download_object_key,
 'READY' download_status, coalesce({ts('q.queued_ts')}, {RUN_TS}) queued_ts, 'PENDING' processing_status, cast(null as varchar) processing_started_ts,
 cast(null as varchar) processed_ts, cast(null as varchar) error_message, coalesce({ts('q.created_ts')}, {RUN_TS}) created_ts, {RUN_TS} updated_ts
 from request_keys k left join ready_queue q using (app_organization_id, app_batch_id)""",
    "apply_delivery_outcomes": f"""select t.id, t.client_id, t.batch_id, t.app_batch_id, t.app_organization_id, t.payload, t.event_type,
 case when j.id is null then t.status when j.ok then 'SUCCEEDED' else 'FAILED' end status,
 cast(case when j.id is null then t.attempt_count else coalesce(t.attempt_count,0)+1 end as bigint) attempt_count,
 case when j.id is null then {ts('t.last_attempt_ts')} else {RUN_TS} end last_attempt_ts,
 case when j.id is null then t.last_error else j.message end last_error, {ts('t.created_ts')} created_ts,
 case when j.ok then {RUN_TS} else {ts('t.processed_ts')} end processed_ts from outbox t left join judged j on j.id = t.id""",
    "delivery_totals": "select count(*) processed, count(case when ok then 1 end) succeeded, count(case when not ok then 1 end) failed from judged",
    "rarest_name_per_year": """select first_name, gender, cast(year as bigint) as year, cast(quantity as bigint) quantity from (
 select *, row_number() over (partition by gender, year order by quantity, first_name) rn from ssa_raw) where rn = 1""",
    "record_order": f"select client_id, batch_id, record_id, row_number() over (partition by client_id, batch_id order by {NUMERIC_FIRST}) place from person_input",
    "name_history": "select first_name, gender, year, quantity from stage where first_name ilike 'small%'",
}


OPEN = "(select * from client_batch where delivery_complete_ts is null)"
COUNTED = "(select client_id, batch_id, count(*) n from person_input group by all)"


def voter_value(field: str, kind: str) -> str:
    if kind.startswith("decimal"):
        return f"cast(try_cast({field} as bigint) as double) {field}"
    if kind == "int":
        return f"try_cast({field} as bigint) {field}"
    if kind == "date":
        days = f"coalesce(cast(try_strptime({field},'%Y-%m-%d') as date), cast(try_strptime({field},'%m/%d/%Y') as date))"
        return f"cast({days} as varchar) {field}"
    return field


def voter_file_load() -> str:
    names = list(VOTER_FIELDS)
    casts = ", ".join(voter_value(n, k) for n, k in VOTER_FIELDS.items())
    line = lambda own: " || '|' || ".join(f"coalesce({n},'')" for n in own)
    rejected = f"case kind when 'short' then {line(names[:31])} else {line(names)} || '|x|y' end"
    nothing = ", ".join(f"null {n}" for n in names)
    return f"""select {casts}, cast(null as varchar) rejected from voter_file where kind = 'whole'
 union all select {nothing}, {rejected} rejected from voter_file where kind <> 'whole'"""


ORACLES |= {
    "refresh_chain": f"""select p.client_id, p.batch_id, p.record_id, {name('p.first_name')} first_name_clean,
 cast(g.first_name is not null as bigint) ssa_lookup_match_flag, g.predicted_gender ssa_predicted_gender,
 g.max_probability ssa_max_probability, a.predicted_age_bucket ssa_predicted_age_bucket, p.batch_id % 5 = 1 rewritten, true settled
 from (select * replace (case when batch_id % 5 = 1 then reverse(first_name) else first_name end as first_name)
  from person_input where batch_id % 5 <> 0) p
 left join genders g on g.first_name = {name('p.first_name')} left join ages_generic a on a.first_name = {name('p.first_name')}""",
    "repeated_completion": f"""select b.client_id, b.id batch_id, 'COMPLETED' processing_status, cast(null as varchar) error_message,
 coalesce(n,0) processed_record_count, cast(1 as bigint) messages, cast(0 as bigint) people_left, 'FAILED' failed_status,
 coalesce(n,0) people_after_failure from {OPEN} b left join {COUNTED} c on c.client_id=b.client_id and c.batch_id=b.id""",
    "requeued_batch": f"""select b.client_id, b.id batch_id, case when id % 2 = 0 then 'COMPLETED' else 'FAILED' end processing_status,
 case when id % 2 = 1 then 'lost' end error_message, case when id % 2 = 0 then coalesce(n,0) end processed_record_count,
 cast(1 - id % 2 as bigint) messages, case when id % 2 = 1 then coalesce(n,0) else 0 end people_left
 from {OPEN} b left join {COUNTED} c on c.client_id=b.client_id and c.batch_id=b.id""",
    "three_enrichments": f"""select b.client_id, b.id batch_id, t.code enrichment_type_code, 'COMPLETED' enrichment_status,
 cast(null as varchar) error_message, case t.code when 'AGEXPD' then 'FAILED' else 'COMPLETED' end first_status,
 case t.code when 'AGEXPD' then 'lost' end first_error, n results, cast(1 as bigint) times_queued
 from {OPEN} b join {COUNTED} c on c.client_id=b.client_id and c.batch_id=b.id join attribute t on true""",
    "purge_landing_job": """select case when cast(record_id as bigint) % 2 = 0 then storage_file_name else storage_file_name || '.more.csv' end storage_file_name,
 count(*) records, cast(sum(cast(record_id as bigint)) as bigint) ids from landing
 where storage_file_name not like '%client_org-%' or cast(regexp_extract(storage_file_name,'client_org-([0-9]+)',1) as int) % 2 = 1 group by 1""",
    "metrics_upsert_stored": ORACLES["metrics_upsert"]
    .replace("from older_metrics t", ", true few_parts from older_metrics t")
    .replace("join metrics s", "join (select * from metrics where client_id = 1) s"),
    "voter_file_load": voter_file_load(),
    "config_variant": """select app_organization_id, app_batch_id,
 case cast(substr(app_batch_id,3) as bigint) % 6 when 3 then 'GNDRPR' when 5 then 'AGCLPS,AGEXPD' end codes,
 case cast(substr(app_batch_id,3) as bigint) % 6 when 4 then 'FIRST_NAME,RECORD_ID,LAST_NAME,ZIP' when 5 then 'ZIP' end fields from dirty_config""",
    "export_column_lists": """with d as (select *, batch_id % 3 kind from downloads join batch_keys using (client_id, batch_id))
 select app_organization_id, app_batch_id, case kind when 0 then record_id || ',' || coalesce(predicted_gender,'')
  when 1 then coalesce(zip,'') || ',' || last_name || ',' || record_id
  else coalesce(cast(cast(male_probability as decimal(10,6)) as varchar),'') || ',' || case trim(first_name) when '' then '""' else coalesce(trim(first_name),'') end || ',' || record_id end as line from d
 union all select distinct app_organization_id, app_batch_id, case kind when 0 then 'RECORD_ID,PREDICTED_GENDER'
  when 1 then 'ZIP,LAST_NAME,RECORD_ID' else 'MALE_PROBABILITY,FIRST_NAME,RECORD_ID' end from d""",
    "ad_hoc_batch_load": f"""select cast(7 as bigint) client_id, cast(70 as bigint) batch_id, {RUN_TS} load_ts, count(*) records,
 count(case when regexp_matches(record_id,'[13579]$') then 1 end) with_own_id, count(case when not regexp_matches(record_id,'[13579]$') then 1 end) made_ids,
 cast(0 as bigint) without_id, cast(sum(length(last_name)) as bigint) letters from person_input where client_id = 3""",
    "name_count_files": """select gender, cast(year as bigint) as year, count(*) as rows, cast(sum(quantity) as bigint) quantity,
 cast(sum(length(first_name)) as bigint) letters from ssa_raw group by all""",
    "filled_record_ids": """select storage_file_name, record_id as row,
 case when cast(record_id as bigint) % 7 = 0 then sha256(storage_file_name || '|' || record_id) else record_id end record_id from landing""",
}


def _mentions(text: str, step: str) -> bool:
    padded = text.replace("\n", " ").replace("(", " ").replace(")", " ").replace(",", " ")
    return any(f" {word} {step} " in f" {padded} " for word in ("from", "join"))


def _needed(text: str, found: list[str]) -> None:
    from namelens.bindings import TEXTS

    for step in [*STEPS, *TEXTS]:
        if step not in found and _mentions(text, step):
            _needed(STEPS[step] if step in STEPS else duckdb_text(step), found)
            if step not in found:
                found.append(step)


def sql(query: str) -> str:
    """The full SQL of one query, with every step it needs."""
    text = ORACLES[query].strip()
    found: list[str] = []
    _needed(text, found)
    steps = [f"{s} as ({STEPS[s] if s in STEPS else duckdb_text(s)})" for s in found]
    if not steps:
        return text
    if text.startswith("with "):
        return "with " + ", ".join(steps) + ", " + text.removeprefix("with ")
    return "with " + ", ".join(steps) + " " + text
