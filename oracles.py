"""DuckDB SQL for the queries, written independently of the Spark code."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

RAW = """raw as (
  select cast(d.doc_id as varchar) as complaint_id, d.lang as product,
    concat(d.lang, '-', d.doc_id % 3) as sub_product,
    concat('issue ', d.doc_id % 7) as issue,
    case when d.doc_id % 2 = 0 then concat('detail ', d.doc_id % 11) end as sub_issue,
    d.source as company, concat('S', d.doc_id % 50) as state,
    concat(cast(date '2023-01-01' + cast(d.doc_id % 365 as int) as varchar), 'T22:07:34.000Z') as date_received,
    concat(cast(date '2023-01-01' + cast(d.doc_id % 365 + (d.doc_id * 7) % 5 as int) as varchar), 'T01:00:00.000Z')
      as date_sent_to_company,
    case when d.doc_id % 10 = 0 then 'Untimely response' when d.doc_id % 10 < 3 then 'Closed with relief'
      else 'Closed with explanation' end as company_response,
    case when l.quality = 1 then 'Yes' when l.quality = 0 then 'No' end as timely,
    d.text as complaint_what_happened,
    case when d.doc_id % 4 = 0 then 'Phone' else 'Web' end as submitted_via
  from documents d left join labels l on d.doc_id = l.doc_id)"""

ANSWERED = "answered as (select * replace (coalesce(timely, 'No') as timely) from raw)"


def typed(source: str) -> str:
    return f"""typed as (
  select cast(complaint_id as bigint) as complaint_id, product, sub_product, issue, sub_issue, company, state,
    cast(date_received[1:10] as date) as date_received,
    cast(date_sent_to_company[1:10] as date) as date_sent_to_company,
    cast(date_sent_to_company[1:10] as date) - cast(date_received[1:10] as date) as days_to_route,
    company_response, case timely when 'Yes' then true when 'No' then false end as was_timely, submitted_via,
    trim(complaint_what_happened) as narrative, length(trim(complaint_what_happened)) as narrative_length
  from {source})"""


STAGE = """facts as (
  select * from typed where narrative_length >= 20
  qualify complaint_id = min(complaint_id) over (partition by narrative))"""

STAGED = f"with {RAW}, {typed('raw')}, {STAGE}"
STAGED_ANSWERED = f"with {RAW}, {ANSWERED}, {typed('answered')}, {STAGE}"

ORDER_CASES = """facts as (
  select o.o_orderkey as complaint_id, c.c_mktsegment as product, n.n_name as company,
    o.o_orderstatus = 'F' as was_timely
  from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey)"""

PAIRS = """pairs as (
  select * from (
    select product, company, count(*) as complaint_count,
      case when count(was_timely) > 0
        then round(count(*) filter (was_timely) * cast(100 as double) / count(*), 1) end as pct_timely_response
    from facts group by product, company)
  where complaint_count >= 5)"""
AVERAGES = """averages as (
  select product, round(count(*) filter (was_timely) * cast(100 as double) / count(was_timely), 1)
    as category_avg_pct_timely
  from facts group by product)"""
WORST = f"""{PAIRS}, {AVERAGES}
select * from (
  select product, company, complaint_count, pct_timely_response, category_avg_pct_timely,
    rank() over (partition by product order by pct_timely_response nulls first) as rank_within_category
  from pairs join averages using (product))
where pct_timely_response < category_avg_pct_timely"""

TIMELY = "round(count(*) filter (was_timely) * cast(100 as double) / count(*), 1) as pct_timely_response"
BY_CATEGORY = f"""select product, count(*) as complaint_count, {TIMELY},
  round(sum(days_to_route) / count(days_to_route), 1) as avg_days_to_route,
  round(sum(narrative_length) / count(narrative_length), 0) as avg_narrative_length,
  len(list_distinct(list(company))) as distinct_companies
from facts group by product"""
BY_RESPONSE = f"""select company_response, count(*) as complaint_count, {TIMELY},
  round(sum(days_to_route) / count(days_to_route), 1) as avg_days_to_route
from facts group by company_response"""
TOP_COMPANIES = f"""select * from (
  select company, count(*) as complaint_count, {TIMELY}, len(list_distinct(list(product))) as distinct_products
  from facts group by company)
where complaint_count >= 10 order by complaint_count desc, company limit 25"""

# Cell texts read as null, quoted for SQL.
NULL_TOKENS = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)
# White space, as SQL code points.
WHITE = "concat(" + ", ".join(
    f"chr({c})" for c in [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203),
                          8232, 8233, 8239, 8287, 12288]
) + ")"

RAW_COLUMNS = (
    "complaint_id", "product", "sub_product", "issue", "sub_issue", "company", "state",
    "date_received", "date_sent_to_company", "company_response", "timely",
    "complaint_what_happened", "submitted_via",
)

# Sources and sinks
ORACLES["json_hits_explode"] = """
select cast(event_id as varchar) as event_id, event_type, json_extract_string(props, '$.k') as k,
  cast(null as varchar) as channel
from events"""
ORACLES["load_raw_responses"] = f"""with {RAW}
select * exclude (n) from (
  select *, row_number() over (partition by product order by cast(complaint_id as bigint)) as n
  from raw where complaint_what_happened <> '' and date_received >= '2023-06-01')
where n <= 50"""
ORACLES["source_filter"] = f"""with {RAW}
select * from raw where product in ('en', 'fr') and coalesce(complaint_what_happened, '') <> ''
  and date_received >= '2023-06-01'"""
ORACLES["quota_per_category"] = f"""with {RAW}
select * exclude (n) from (
  select *, row_number() over (partition by product order by cast(complaint_id as bigint)) as n from raw)
where n <= 50"""
ORACLES["union_categories"] = f"with {RAW} select * from raw where product in ('de', 'en', 'es', 'fr')"
ORACLES["csv_roundtrip"] = f"with {RAW} select " + ", ".join(
    f"case when {c} not in ({NULL_TOKENS}) then {c} end as {c}" for c in RAW_COLUMNS
) + " from raw"
ORACLES["raw_reload_count"] = "select count(*) as rows from documents"
ORACLES["lake_export_counts"] = f"""{STAGED_ANSWERED},
by_category as ({BY_CATEGORY}), by_response as ({BY_RESPONSE}), top as ({TOP_COMPANIES})
select 'mart_complaints_by_category' as dataset, 'mart' as kind, count(*) as rows from by_category
union all select 'mart_company_response_analysis', 'mart', count(*) from by_response
union all select 'mart_top_companies', 'mart', count(*) from top
union all select 'stg_complaints', 'fact table', count(*) from facts"""
ORACLES["lake_snapshot_latest"] = f"""{STAGED}
select complaint_id, product, narrative_length, date '2024-03-02' as run_date from facts"""
ORACLES["gated_build"] = f"{STAGED_ANSWERED}, {WORST}"

# Staging
ORACLES["stg_clean"] = f"{STAGED} select * from facts"
ORACLES["parse_iso_ts"] = f"""with {RAW}
select complaint_id, cast(epoch(cast(date_received[1:19] as timestamp)) as bigint) as received_s,
  cast(date_received[1:10] as date) as received
from raw"""
ORACLES["days_to_route"] = """
select cast(doc_id as varchar) as complaint_id, cast((doc_id * 7) % 5 as bigint) as days from documents"""
ORACLES["text_normalise"] = f"""
with padded as (select doc_id, concat(' ', chr(9), text, chr(10), ' ') as p from documents)
select doc_id, trim(p) as trimmed, trim(p, {WHITE}) as stripped, length(trim(p)) as length from padded"""
ORACLES["narrative_present"] = f"""with {RAW}
select complaint_id, product from raw where complaint_what_happened <> ''"""
ORACLES["dedupe_narrative"] = """
select * exclude (n) from (select *, row_number() over (partition by text order by doc_id) as n from documents)
where n = 1"""
ORACLES["dedupe_by_id"] = """
select user_id, event_id, event_type from (
  select *, row_number() over (partition by user_id order by event_id) as n from events)
where n = 1"""
CLEAN = f"""with {RAW}, stripped as (
  select cast(complaint_id as bigint) as complaint_id, product, trim(complaint_what_happened, {WHITE}) as narrative
  from raw where complaint_what_happened is not null and product is not null),
clean as (
  select complaint_id, product, narrative from (
    select *, row_number() over (partition by narrative order by complaint_id) as n
    from stripped where length(narrative) >= 20)
  where n = 1)"""
ORACLES["clean_for_training"] = f"{CLEAN} select * from clean"
ORACLES["cleaning_report"] = f"""{CLEAN}
select (select count(*) from raw) as rows_before, (select count(*) from clean) as rows_after,
  (select count(*) from stripped where length(narrative) >= 20) - (select count(*) from clean) as duplicates,
  (select count(*) from raw) - (select count(*) from stripped where length(narrative) >= 20) as missing_or_short"""

# Marts and ranking
ORACLES["mart_by_category"] = f"{STAGED} {BY_CATEGORY}"
ORACLES["mart_by_response"] = f"{STAGED} {BY_RESPONSE}"
ORACLES["mart_top_companies"] = f"{STAGED} {TOP_COMPANIES}"
ORACLES["marts_from_cube"] = ORACLES["mart_by_category"]
ORACLES["reconcile_marts"] = f"""{STAGED}
select count(*) as staged_cases, count(*) as category_cases, count(*) as response_cases, true as reconciled
from facts"""
ORACLES["rate_by_pair"] = f"with {ORDER_CASES}, {PAIRS} select * from pairs"
ORACLES["category_avg_rate"] = f"{STAGED}, {AVERAGES} select * from averages"
ORACLES["rank_within_category"] = f"""{STAGED}, {PAIRS}
select *, rank() over (partition by product order by pct_timely_response nulls first) as rank_within_category
from pairs"""
ORACLES["worst_in_class"] = f"{STAGED}, {WORST}"
ORACLES["worst_in_class_head"] = f"{STAGED}, {WORST} order by product, rank_within_category, company limit 30"
ORACLES["mart_from_catalog"] = ORACLES["mart_by_category"]
ORACLES["worst_in_class_orders"] = f"with {ORDER_CASES}, {WORST}"

ORACLES["guards"] = """
select 'export of no rows' as guard, true as raised, cast(0 as bigint) as rows
union all select 'export', false, count(*) from documents
union all select 'read of no rows', true, 0
union all select 'read', false, count(*) from documents
union all select 'build of no rows', true, 0
union all select 'build that a check fails', true, 0
union all select 'report as one file', false, count(distinct lang) from documents"""

# Checks
ORACLES["check_unique"] = """
select 'unique' as check, 'documents' as model, 'text' as column, count(*) as failures
from (select text from documents where text is not null group by text having count(*) > 1)
union all select 'unique', 'orders', 'o_orderkey', count(*)
from (select o_orderkey from orders where o_orderkey is not null group by o_orderkey having count(*) > 1)"""
ORACLES["check_not_null"] = f"""with {RAW}
select 'not_null' as check, 'raw' as model, 'complaint_id' as column,
  count(*) filter (complaint_id is null) as failures from raw
union all select 'not_null', 'raw', 'timely', count(*) filter (timely is null) from raw
union all select 'not_null', 'raw', 'sub_issue', count(*) filter (sub_issue is null) from raw"""
ORACLES["check_accepted"] = f"""{STAGED}
select 'accepted_values' as check, 'stg_complaints' as model, 'product' as column,
  count(distinct product) as failures
from facts where product not in ('en', 'fr')"""
ORACLES["check_negative_days"] = f"""{STAGED}
select 'non_negative' as check, 'stg_complaints' as model, 'days_to_route' as column, count(*) as failures
from facts where days_to_route - 1 < 0"""


def _suite() -> str:
    def nulls(model: str, column: str) -> str:
        return (f"select 'not_null' as check, '{model}' as model, '{column}' as column, "
                f"count(*) filter ({column} is null) as failures from {model}")

    def repeats(model: str, column: str) -> str:
        return (f"select 'unique', '{model}', '{column}', count(*) from (select {column} from {model} "
                f"where {column} is not null group by {column} having count(*) > 1)")

    facts = ("complaint_id", "product", "narrative", "narrative_length", "was_timely")
    parts = [nulls("stg_complaints", c) for c in facts]
    parts.append("select 'non_negative', 'stg_complaints', 'days_to_route', count(*) from facts "
                 "where days_to_route < 0")
    parts.append(repeats("stg_complaints", "complaint_id"))
    parts.append("select 'accepted_values', 'stg_complaints', 'product', count(distinct product) "
                 "from facts where product not in ('en', 'fr', 'de')")
    parts += [nulls("mart_complaints_by_category", c) for c in ("product", "complaint_count")]
    parts += [nulls("mart_company_response_analysis", "company_response"), nulls("mart_top_companies", "company")]
    parts += [repeats("mart_complaints_by_category", "product"),
              repeats("mart_company_response_analysis", "company_response"),
              repeats("mart_top_companies", "company")]
    return (f"{STAGED}, stg_complaints as (select * from facts), "
            f"mart_complaints_by_category as ({BY_CATEGORY}), "
            f"mart_company_response_analysis as ({BY_RESPONSE}), mart_top_companies as ({TOP_COMPANIES}) "
            + " union all ".join(parts))


ORACLES["check_suite"] = _suite()

# Profile
ORACLES["class_balance"] = f"{CLEAN} select product, count(*) as count from clean group by product"
ORACLES["length_profile"] = """
with l as (select length(text) as length from documents)
select count(length) as count, round(avg(length), 6) as mean, round(stddev_samp(length), 6) as std,
  min(length) as min, quantile_cont(length, 0.25) as q1, quantile_cont(length, 0.5) as median,
  quantile_cont(length, 0.75) as q3, max(length) as max
from l"""
ORACLES["length_box_by_category"] = """
with l as (select lang, length(text) as length from documents),
q as (select lang, count(*) as count, quantile_cont(length, 0.25) as q1, quantile_cont(length, 0.5) as median,
  quantile_cont(length, 0.75) as q3 from l group by lang)
select lang, count, min(length) filter (length >= q1 - 1.5 * (q3 - q1)) as whisker_low, q1, median, q3,
  max(length) filter (length <= q3 + 1.5 * (q3 - q1)) as whisker_high
from l join q using (lang) group by lang, count, q1, median, q3"""
ORACLES["short_labels"] = """
with named as (select c_custkey, concat(c_mktsegment, ' ', c_nationkey, ' segment') as name from customer)
select c_custkey, case when length(name) <= 18 then name else concat(name[1:16], '…') end as short,
  case when length(name) <= 22 then name else concat(name[1:20], '…') end as longer
from named"""

# Splits
QUOTAS = """counts as (select lang, count(*) as n from documents group by lang),
totals as (select sum(n) as total, cast(ceil(cast(0.2 as double) * sum(n)) as bigint) as test from counts),
shares as (select lang, n, (n * test) // total as base, (n * test) % total as rest, test from counts, totals),
quotas as (
  select lang, base + case when row_number() over (order by rest desc, lang) <= test - sum(base) over ()
    then 1 else 0 end as quota
  from shares)"""
ORACLES["stratified_split"] = f"""with {QUOTAS}, placed as (
  select doc_id, lang, row_number() over (partition by lang order by md5(concat('42:', doc_id)), doc_id) as n
  from documents)
select doc_id, lang, case when n <= quota then 'test' else 'train' end as split
from placed join quotas using (lang)"""
ORACLES["stratified_folds"] = """
with counts as (select lang, count(*) as n from documents group by lang),
starts as (select lang, n, sum(n) over (order by lang) - n as start from counts),
slots as (select lang, n, start, unnest(range(cast(start as bigint), cast(start + n as bigint))) % 5 as fold
  from starts),
ends as (select lang, fold, sum(count(*)) over (partition by lang order by fold) as last
  from slots group by lang, fold),
placed as (
  select doc_id, lang, repeat, row_number() over (
    partition by repeat, lang order by md5(concat('42:', repeat, ':', doc_id)), doc_id) as n
  from documents, (select unnest([0, 1, 2]) as repeat))
select doc_id, lang, cast(repeat as int) as repeat, cast(min(fold) as int) as fold
from placed join ends using (lang) where n <= last
group by doc_id, lang, repeat"""
ORACLES["sample_per_class"] = """
select doc_id, lang from (
  select doc_id, lang, row_number() over (partition by lang order by md5(concat('42:', doc_id)), doc_id) as n
  from documents)
where n <= 40"""

# Text classification
WORDS = r"""words as (
  select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]{2,}') as w from documents),
terms as (
  select doc_id, w || list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])) as terms from words)"""
TOP_TERMS = """tokens as (select doc_id, unnest(terms) as term from terms),
per_doc as (select doc_id, term, count(*) as tf from tokens group by doc_id, term),
vocabulary as (
  select term, sum(tf) as tf, count(*) as df from per_doc group by term having count(*) >= 3
  order by sum(tf) desc, term limit 20000)"""
ORACLES["tokens_per_doc"] = f"""with {WORDS}
select doc_id, len(terms) as n_terms, len(list_distinct(terms)) as n_distinct,
  md5(array_to_string(terms, '|')) as terms_md5
from terms"""
# The English stop words of Spark.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until while of at by for with
about against between into through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some such no nor not only
own same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd
she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't
haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could
here's how's let's ought that's there's what's when's where's who's why's would
""".split()
ENGLISH = ", ".join("'" + word.replace("'", "''") + "'" for word in ENGLISH_STOP_WORDS)
ORACLES["english_tokens_per_doc"] = f"""with {WORDS.split("terms as")[0]}
kept as (select doc_id, list_filter(w, lambda x: x not in ({ENGLISH})) as w from words),
terms as (
  select doc_id, w || list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])) as terms from kept)
select doc_id, len(terms) as n_terms, md5(array_to_string(terms, '|')) as terms_md5 from terms"""
ORACLES["document_frequency"] = f"""with {WORDS}, {TOP_TERMS}
select term, cast(tf as bigint) as tf, df from vocabulary"""
ORACLES["tfidf_formula"] = f"""with {WORDS}, {TOP_TERMS},
raws as (
  select doc_id, term, per_doc.tf as tf,
    per_doc.tf * (ln((1 + (select count(*) from documents)) / (1 + df)) + 1) as w
  from per_doc join vocabulary using (term)),
norms as (select doc_id, sqrt(sum(w * w)) as norm from raws group by doc_id)
select doc_id, term, tf, round(w / norm, 6) as weight from raws join norms using (doc_id)"""
ORACLES["class_weights"] = f"""{CLEAN}, counts as (select product, count(*) as n from clean group by product)
select product, n, round((select sum(n) from counts) / ((select count(*) from counts) * n), 9) as weight
from counts"""
HELD_OUT = CLEAN + """, sizes as (select product, count(*) as n, sum(count(*)) over () as total from clean group by product),
wanted as (select *, cast(ceil(cast(0.2 as double) * total) as bigint) as test from sizes),
shares as (select *, n * test // total as base, n * test % total as rest from wanted),
quotas as (select product, base + case when row_number() over (order by rest desc, product) <= test - sum(base) over ()
  then 1 else 0 end as quota from shares),
placed as (
  select clean.*, quota, row_number() over (
    partition by product order by md5(concat('42:', complaint_id)), complaint_id) as n
  from clean join quotas using (product)),
held_out as (select * from placed where n <= quota), train as (select * from placed where n > quota)"""
ORACLES["classifier_predictions"] = f"""{HELD_OUT}
select complaint_id, product as true_product, true as known_class, true as gradient_in_bound from held_out"""
ORACLES["fit_objective"] = f"""{HELD_OUT}
select count(*) as n_rows, count(distinct product) as n_classes, round(ln(count(distinct product)), 9) as objective_without,
  true as objective_is_less, true as gradient_in_bound from train"""
ORACLES["prediction_report"] = f"""{HELD_OUT}
select product as label, cast(count(*) as double) as support, true as agrees from held_out group by product
union all select unnest(['accuracy', 'macro avg', 'weighted avg']), cast(count(*) as double), true from held_out"""
ORACLES["cv_macro_f1"] = f"""{HELD_OUT},
fold_starts as (
  select product, count(*) as n, sum(count(*)) over (order by product) - count(*) as start from train group by product),
fold_slots as (
  select product, unnest(range(cast(start as bigint), cast(start + n as bigint))) % 5 as fold from fold_starts),
fold_sizes as (select cast(fold as int) as fold, count(*) as n_rows from fold_slots group by fold)
select cast(repeat as int) as repeat, fold, n_rows, n_rows as n_ids, n_rows as n_scored, cast(15 as bigint) as n_folds, true as mean_agrees
from fold_sizes, (select unnest([0, 1, 2]) as repeat)"""
ORACLES["model_reload_same_preds"] = f"""{CLEAN}
select count(*) - cast(ceil(cast(0.2 as double) * count(*)) as bigint) as n_rows,
  count(*) - cast(ceil(cast(0.2 as double) * count(*)) as bigint) as n_same
from clean"""

# Metrics
PREDICTED = """predicted as (
  select doc_id as complaint_id, lang as true_label, case when doc_id % 7 = 0 then 'en' else lang end as pred_label,
    case when doc_id % 11 = 0 or doc_id % 13 = 0 then null when doc_id % 5 = 0 then 'fr' else lang end as external_pred,
    (doc_id * 37) % 997 / 100.0 as latency_s, doc_id % 11 = 0 as failed
  from documents)"""
SCORES = f"""{PREDICTED}, labels_seen as (
  select true_label as label from predicted union select pred_label from predicted),
class_counts as (
  select label, count(*) filter (true_label = label and pred_label = label) as tp,
    count(*) filter (pred_label = label) as predicted, count(*) filter (true_label = label) as actual
  from predicted join labels_seen on label = true_label or label = pred_label group by label),
scores as (
  select label, tp, actual, case when predicted = 0 then 0.0 else tp / predicted end as p,
    case when actual = 0 then 0.0 else tp / actual end as rc,
    case when tp = 0 then 0.0 else 2 * (tp / predicted) * (tp / actual) / ((tp / predicted) + (tp / actual)) end as f
  from class_counts)"""
ORACLES["confusion_matrix"] = f"""with {PREDICTED}, l as (select distinct true_label as label from predicted)
select t.label as true_label, p.label as pred_label, count(complaint_id) as count
from l t cross join l p left join predicted on true_label = t.label and pred_label = p.label
group by t.label, p.label"""
ORACLES["classification_report"] = f"""with {SCORES},
total as (select sum(tp) / sum(actual) as accuracy, sum(actual) as n from scores)
select label, round(p, 9) as "precision", round(rc, 9) as recall, round(f, 9) as "f1-score",
  round(cast(actual as double), 9) as support from scores
union all select 'accuracy', round(accuracy, 9), round(accuracy, 9), round(accuracy, 9), round(accuracy, 9) from total
union all select 'macro avg', round(avg(p), 9), round(avg(rc), 9), round(avg(f), 9), cast(sum(actual) as double)
  from scores
union all select 'weighted avg', round(sum(p * actual) / sum(actual), 9), round(sum(rc * actual) / sum(actual), 9),
  round(sum(f * actual) / sum(actual), 9), cast(sum(actual) as double) from scores"""
ORACLES["macro_f1"] = f"""with {SCORES}
select round(avg(f), 9) as macro_f1, round(sum(f * actual) / sum(actual), 9) as weighted_f1,
  round(sum(tp) / sum(actual), 9) as accuracy
from scores"""
ORACLES["metrics_kv"] = f"""with {SCORES}, text_values as (
  select 'macro_f1' as metric, printf('%.4f', avg(f)) as value from scores
  union all select 'accuracy', printf('%.4f', sum(tp) / sum(actual)) from scores)
select metric, value, cast(value as double) as number from text_values"""
ORACLES["compare_same_rows"] = f"""with {PREDICTED}
select count(*) as n_rows, round(avg(cast(pred_label = true_label as int)), 9) as baseline_acc,
  round(avg(cast(external_pred = true_label as int)), 9) as external_acc_parseable_only,
  round(count(*) filter (external_pred = true_label) / count(*), 9) as external_acc_all_rows,
  count(*) filter (external_pred is null) as external_unparseable
from predicted"""
# Two-sided 95 % critical values of Student's t for 1 to 30 degrees of freedom.
T_VALUES = (
    "12.706204736, 4.302652730, 3.182446305, 2.776445105, 2.570581836, 2.446911851, 2.364624252, "
    "2.306004135, 2.262157163, 2.228138852, 2.200985160, 2.178812830, 2.160368656, 2.144786688, "
    "2.131449546, 2.119905299, 2.109815578, 2.100922040, 2.093024054, 2.085963447, 2.079613845, "
    "2.073873068, 2.068657610, 2.063898562, 2.059538553, 2.055529439, 2.051830516, 2.048407142, "
    "2.045229642, 2.042272456"
)
ORACLES["mean_ci"] = f"""
with per_source as (select lang, source, avg(n_chars) as chars from documents group by lang, source),
stats as (select lang, count(*) as n, avg(chars) as mean, stddev_samp(chars) as sd from per_source group by lang),
widths as (select lang, n, mean, ([{T_VALUES}])[n - 1] * sd / sqrt(n) as half_width from stats)
select lang, n, round(mean, 6) as mean, round(half_width, 4) as half_width,
  concat(printf('%.3f', mean), ' ± ', printf('%.3f', half_width)) as summary
from widths"""

# External classifier
ORACLES["parse_labels"] = """
select conv_id, turn,
  list_filter(['queux', 'ción', 'ung', 'the', 'é'], lambda p: contains(lower(trim(text)), p))[1] as label
from conversations"""
ORACLES["build_prompts"] = """
select doc_id, concat('Classify this consumer complaint into exactly one of these categories. ',
  'Reply with only the category name, nothing else.', chr(10), chr(10), 'Categories:', chr(10),
  '- Credit card', chr(10), '- Mortgage', chr(10), '- Checking or savings account', chr(10),
  '- Student loan', chr(10), '- Vehicle loan or lease', chr(10),
  '- Money transfer, virtual currency, or money service', chr(10), chr(10),
  'Complaint:', chr(10), text, chr(10), chr(10), 'Category:') as prompt
from documents"""
ORACLES["scrub_text"] = """
select doc_id, replace(replace(text, 'tion', '[REDACTED]'), 'qu', '[REDACTED]') as text from documents"""
ORACLES["external_reliability"] = f"""with {PREDICTED}
select count(*) as n_rows, round(avg(cast(pred_label = true_label as int)), 6) as baseline_acc,
  round(avg(cast(external_pred = true_label as int)), 6) as external_acc_parseable_only,
  round(count(*) filter (external_pred = true_label) / count(*), 6) as external_acc_all_rows,
  count(*) filter (external_pred is null) as external_unparseable,
  count(*) filter (failed) as errors,
  count(*) filter (external_pred is null and not failed) as invalid_label,
  round(avg(latency_s), 6) as mean_latency_s, round(quantile_cont(latency_s, 0.5), 6) as p50_latency_s,
  round(quantile_cont(latency_s, 0.95), 6) as p95_latency_s
from predicted"""


def _answers(rows: str) -> str:
    """The stand-in classifier in SQL: votes by short words of the whole request."""
    words = {"de": "'der', 'die', 'und', 'das', 'ein'", "en": "'the', 'and', 'of', 'to', 'in'",
             "es": "'el', 'los', 'y', 'que', 'del'", "fr": "'le', 'la', 'les', 'des', 'et'"}
    votes = ", ".join(f"len(list_filter(w, lambda x: x in ({listed}))) as {code}" for code, listed in words.items())
    return f"""asked as (
  select *, regexp_split_to_array(lower(concat(
    'Classify this consumer complaint into exactly one of these categories. ',
    'Reply with only the category name, nothing else.', chr(10), chr(10), 'Categories:', chr(10),
    '- de', chr(10), '- en', chr(10), '- es', chr(10), '- fr', chr(10), chr(10),
    'Complaint:', chr(10), narrative, chr(10), chr(10), 'Category:')), '\\s+') as w
  from {rows}),
votes as (select * exclude (w), {votes} from asked),
answers as (
  select *, case when de >= greatest(en, es, fr) then 'de' when en >= greatest(es, fr) then 'en'
    when es >= fr then 'es' else 'fr' end as answer
  from votes)"""


ORACLES["external_scores"] = f"""with {RAW},
cases as (select complaint_id, product, complaint_what_happened as narrative from raw), {_answers("cases")}
select complaint_id, product, concat('It is ', answer, '.') as external_raw_output, answer as external_pred,
  cast(null as varchar) as error
from answers"""
ORACLES["external_retries"] = """
with asked as (
  select doc_id, doc_id % 11 = 0 as broken, doc_id % 5 as failures, doc_id % 7 = 0 as refused from documents),
told as (
  select doc_id, case when broken then 'bad request' when failures < 3 then 'answered' when refused then 'refused'
    else 'too many calls' end as outcome,
    case when not broken and failures < 3 then concat('try ', failures + 1) else '' end as answer from asked)
select outcome, answer, count(*) as n, min(doc_id) as first_doc, cast(sum(doc_id) as bigint) as doc_sum
from told group by outcome, answer"""
ORACLES["compare_sample"] = f"""{CLEAN}, sampled as (
  select complaint_id, product, narrative from clean
  qualify row_number() over (partition by product order by md5(concat('42:', complaint_id)), complaint_id) <= 40),
{_answers("sampled")}
select count(*) as n_rows,
  round(count(*) filter (case when complaint_id % 7 = 0 then 'en' else product end = product) / count(*), 9)
    as baseline_acc,
  round(count(*) filter (answer = product) / count(*), 9) as external_acc_all_rows,
  cast(0 as bigint) as external_unparseable, cast(0 as bigint) as errors, cast(0 as bigint) as invalid_label
from answers"""
