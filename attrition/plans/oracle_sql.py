"""DuckDB oracle SQL for the query catalog.

Written as plain SQL over the driver's views, independent of the Spark
operators: the fixture customers come from ``cust`` (see oracle_base), every
other table is derived here in CTEs. Float aggregates are rounded to 6
digits on both sides (summation order differs between engines); sums of
integers are cast to bigint (DuckDB returns hugeint).
"""

from __future__ import annotations

from ..functions.random import sql_uniform
from ..schema import OHE_DOMAINS, SERVICE_COLS
from .oracle_base import d, with_cust

SCORE = "round(p,4)"

# --- derived tables as CTE text -------------------------------------------
F1 = ("f1 as (select *, total_charges / (case when tenure = 0 then 1 else tenure end) as avg_monthly_revenue, "
      + " + ".join(f"coalesce(cast({c}='Yes' as integer),0)" for c in SERVICE_COLS)
      + " as num_services from cust)")

RAW_COLS = ("customer_id,gender,senior_citizen,partner,dependents,tenure,contract,internet_service,"
            "online_security,tech_support,online_backup,device_protection,streaming_tv,streaming_movies,"
            "phone_service,multiple_lines,paperless_billing,payment_method,monthly_charges,total_charges,churn")


def _tenure_case(col: str = "tenure") -> str:
    return (f"case when {col}>=0 and {col}<=6 then '0-6m' when {col}>6 and {col}<=12 then '6-12m' "
            f"when {col}>12 and {col}<=24 then '12-24m' when {col}>24 and {col}<=48 then '24-48m' "
            f"when {col}>48 and {col}<=72 then '48+m' end")


def feat_cte(cutoff_source: str = "cust") -> str:
    return F1 + f""", feat as (select {RAW_COLS}, avg_monthly_revenue, num_services,
 case when tenure > 24 then 1 else 0 end as is_loyal,
 case when monthly_charges > (select quantile_cont(monthly_charges, {d(0.75)}) from {cutoff_source}) then 1 else 0 end as is_high_value,
 case when tech_support='No' and online_security='No' then 1 else 0 end as no_support_services,
 case when coalesce(contains(lower(payment_method),'automatic'), false) then 1 else 0 end as auto_payment,
 monthly_charges / (num_services + 1) as charge_per_service,
 {_tenure_case()} as tenure_bucket from f1)"""


def _bin(col: str) -> str:
    return f"case {col} when 'Yes' then 1 when 'No' then 0 when 'Male' then 1 when 'Female' then 0 end"


CONTRACT_CASE = "case contract when 'Month-to-month' then 0 when 'One year' then 1 when 'Two year' then 2 end"


def indicator_cols() -> list[str]:
    return [f"{c}_{v}" for c, vals in OHE_DOMAINS.items() for v in vals]


def _indicators() -> str:
    return ", ".join(f"cast(coalesce({c}='{v}', false) as integer) as \"{c}_{v}\""
                     for c, vals in OHE_DOMAINS.items() for v in vals)


SCALAR_FEATURES = ["gender", "senior_citizen", "partner", "dependents", "tenure", "contract",
                   "phone_service", "paperless_billing", "monthly_charges", "total_charges",
                   "avg_monthly_revenue", "num_services", "is_loyal", "is_high_value",
                   "no_support_services", "auto_payment", "charge_per_service"]


def enc_cte() -> str:
    return f"""enc as (select customer_id, {_bin('gender')} as gender, senior_citizen, {_bin('partner')} as partner,
 {_bin('dependents')} as dependents, tenure, {CONTRACT_CASE} as contract, {_bin('phone_service')} as phone_service,
 {_bin('paperless_billing')} as paperless_billing, monthly_charges, total_charges, churn, avg_monthly_revenue,
 num_services, is_loyal, is_high_value, no_support_services, auto_payment, charge_per_service, {_indicators()} from feat)"""


def feature_names() -> list[str]:
    return SCALAR_FEATURES + indicator_cols()


def _q(c: str) -> str:
    return f'"{c}"'


def u_id(stream: str) -> str:
    return sql_uniform("customer_id", stream)


def _scaled_select(source: str, stats: str, where: str = "") -> str:
    cols = feature_names()
    parts = [f"round(({_q(c)} - m{i}) / (case when s{i} is null or s{i} = 0 then 1 else s{i} end), 6) as {_q(c)}"
             for i, c in enumerate(cols)]
    return f"select customer_id, {', '.join(parts)} from {source}, {stats} {where}"


def _stats(source: str, where: str) -> str:
    cols = feature_names()
    aggs = ", ".join(f"avg(cast({_q(c)} as double)) m{i}, stddev_pop(cast({_q(c)} as double)) s{i}"
                     for i, c in enumerate(cols))
    return f"stats as (select {aggs} from {source} {where})"


def _hist(value: str, n: int) -> str:
    return with_cust(f"""
select r.churn, g.bin, r.lo + g.bin * ((r.hi - r.lo) / {n}) as bin_lo,
 r.lo + (g.bin + 1) * ((r.hi - r.lo) / {n}) as bin_hi, coalesce(c.cnt, 0)::bigint as count
from r cross join (select cast(unnest(range(0, {n})) as integer) as bin) g
left join c on c.churn = r.churn and c.bin = g.bin""",
        f"""r as (select churn, min(cast({value} as double)) lo, max(cast({value} as double)) hi from cust where {value} is not null group by churn),
b as (select cust.churn, case when r.hi = r.lo then 0 else cast(least(floor((cast({value} as double) - r.lo) / (r.hi - r.lo) * {n}), {n - 1}) as integer) end as bin
      from cust join r on cust.churn = r.churn where {value} is not null),
c as (select churn, bin, count(*) cnt from b group by churn, bin)""")


def _rate(key: str) -> str:
    return with_cust(f"select {key}, round(avg(cast(churn as double)), 6) as churn_rate, count(*) as count "
                     f"from cust where {key} is not null group by {key}")


def _seg(col: str) -> str:
    return (f"case when {col} > 0 and {col} <= {d(0.3)} then 'Low Risk' when {col} > {d(0.3)} and {col} <= {d(0.6)} "
            f"then 'Medium Risk' when {col} > {d(0.6)} and {col} <= {d(1.0)} then 'High Risk' end")


SCORED = f"scored as (select customer_id, churn, {SCORE} as score from cust)"
MODELS = (f"longm as (select customer_id, churn, 'rule' as model, {SCORE} as score from cust "
          f"union all select customer_id, churn, 'tenure', 1 - cast(tenure as double) / 72 from cust "
          f"union all select customer_id, churn, 'charges', monthly_charges / 120 from cust)")


def _auc_ap(source: str, group: str | None = None) -> str:
    """AUC by mid-ranks (Mann-Whitney), AP as the step sum; per group."""
    g = f"{group}, " if group else ""
    part = f"partition by {group} " if group else ""
    gb = f"group by {group}" if group else ""
    on = f"on a.{group} = t.{group}" if group else "on true"
    return f"""
rk as (select {g}churn, rank() over ({part}order by score) + (count(*) over ({part[:-1] + ', score' if group else 'partition by score'}) - 1) / 2.0 as ar from {source}),
a as (select {g}sum(case when churn = 1 then ar else 0 end) srk, sum(churn)::double P, sum(1 - churn)::double N from rk {gb}),
sg as (select {g}score, sum(churn) tp, sum(1 - churn) fp from {source} group by {g}score),
cm as (select {g}tp, sum(tp) over ({part}order by score desc) tpc, sum(fp) over ({part}order by score desc) fpc from sg),
ap as (select {g}sum(tp * (tpc::double / (tpc + fpc))) / sum(tp) as avg_precision from cm {gb}),
t as (select a.*, (srk - P * (P + 1) / 2) / (P * N) as auc_roc from a)"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["gen_customers"] = with_cust(f"select {RAW_COLS} from cust")
    q["scan_customers"] = q["gen_customers"]
    q["rule_propensity"] = with_cust("select customer_id, p from cust")

    feat = feat_cte()
    q["feat_avg_monthly_revenue"] = with_cust("select customer_id, avg_monthly_revenue from feat", feat)
    q["feat_num_services"] = with_cust("select customer_id, num_services from feat", feat)
    q["feat_is_loyal"] = with_cust("select customer_id, is_loyal from feat", feat)
    q["feat_is_high_value"] = with_cust("select customer_id, is_high_value from feat", feat)
    q["feat_no_support"] = with_cust("select customer_id, no_support_services from feat", feat)
    q["feat_auto_payment"] = with_cust("select customer_id, auto_payment from feat", feat)
    q["feat_charge_per_service"] = with_cust("select customer_id, charge_per_service from feat", feat)
    q["feat_tenure_bucket"] = with_cust("select customer_id, tenure_bucket from feat", feat)
    q["engineer_features"] = with_cust("select * from feat", feat)
    q["preview_features"] = with_cust(
        "select customer_id, tenure, monthly_charges, num_services, charge_per_service, is_loyal, churn "
        "from feat order by customer_id limit 10", feat)

    q["clean_customers"] = q["gen_customers"]
    q["profile"] = with_cust("select count(*) as n_rows, 21 as n_cols from cust")
    q["class_distribution"] = with_cust(
        "select churn, count(*) as count, count(*) / (select count(*) from cust) as rate from cust group by churn")
    q["imbalance_ratio"] = with_cust(
        "select count(*) filter (where churn = 0) as n_negative, count(*) filter (where churn = 1) as n_positive, "
        "round(avg(cast(churn as double)), 6) as positive_rate, "
        "cast(count(*) filter (where churn = 0) as double) / nullif(count(*) filter (where churn = 1), 0) as imbalance_ratio from cust")
    q["churn_share"] = with_cust(
        "select churn, count(*) as count, count(*) / (select count(*) from cust) as share from cust group by churn")
    q["null_profile"] = with_cust(
        f"select 'risk_segment' as \"column\", count(*) as null_count from cust where ({_seg('p')}) is null "
        f"having count(*) > 0")

    enc = feat + ", " + enc_cte()
    q["encode_binary"] = with_cust(
        "select customer_id, gender, partner, dependents, phone_service, paperless_billing from enc", enc)
    q["encode_ordinal"] = with_cust("select customer_id, contract from enc", enc)
    q["encode_onehot"] = with_cust(
        "select customer_id, " + ", ".join(_q(c) for c in indicator_cols()) + " from enc", enc)
    q["encode_features"] = with_cust("select * from enc", enc)

    # align_columns: batch lacking tech_support and streaming_tv
    kept = [c for c in SERVICE_COLS if c not in ("tech_support", "streaming_tv")]
    f1b = ("f1 as (select *, total_charges / (case when tenure = 0 then 1 else tenure end) as avg_monthly_revenue, "
           + " + ".join(f"coalesce(cast({c}='Yes' as integer),0)" for c in kept) + " as num_services from cust)")
    featb = feat_cte().replace(F1, f1b).replace(
        "case when tech_support='No' and online_security='No' then 1 else 0 end",
        "case when online_security='No' then 1 else 0 end")
    cols = []
    for c in SCALAR_FEATURES:
        cols.append(c)
    body = []
    for c, vals in OHE_DOMAINS.items():
        for v in vals:
            if c in ("tech_support", "streaming_tv"):
                body.append(f"0.0::double as {_q(c + '_' + v)}")
            else:
                body.append(_q(c + "_" + v))
    q["align_columns"] = with_cust(
        "select customer_id, " + ", ".join(cols) + ", " + ", ".join(body) + " from enc",
        featb + ", " + enc_cte())

    split = f"sp as (select customer_id, churn, {u_id('split')} < {d(0.2)} as is_test from cust)"
    q["stratified_split"] = with_cust("select customer_id, churn, is_test from sp", split)
    q["split_report"] = with_cust(
        "select case when is_test then 'test' else 'train' end as split, count(*) as rows, "
        "round(avg(cast(churn as double)), 6) as churn_rate from sp group by 1", split)
    hsql = f"('0x'||substr(md5(customer_id||':split:42'),1,8))::bigint"
    q["stratified_split_exact"] = with_cust(
        f"""select customer_id, churn, rn <= want as is_test from (
 select customer_id, churn, row_number() over (partition by churn order by {hsql}, customer_id) rn,
 round(count(*) over (partition by churn) * {d(0.2)}) want from cust)""")
    q["stratified_folds"] = with_cust(
        f"select customer_id, churn, cast(least(floor({u_id('fold')} * 5), 4) as integer) as fold from cust")
    q["class_weights"] = with_cust(
        "select churn, count(*) as count, (select count(*) from cust) / (2.0 * count(*)) as weight "
        "from cust group by churn")

    encs = enc + ", " + split.replace("from cust", "from cust") + \
        ", ence as (select enc.*, sp.is_test from enc join sp using (customer_id))"
    q["standard_scale"] = with_cust(
        _scaled_select("ence", "stats"), encs + ", " + _stats("ence", "where not is_test"))
    # prepare_new_data: cutoff and scale fitted on the train side, applied to test rows
    feat_tr = feat_cte("train_cust").replace("from cust)", "from cust)")
    q["prepare_new_data"] = with_cust(
        _scaled_select("ence", "stats", "where is_test"),
        f"train_cust as (select * from cust where not ({u_id('split')} < {d(0.2)})), "
        + feat_tr + ", " + enc_cte() + ", " + split
        + ", ence as (select enc.*, sp.is_test from enc join sp using (customer_id)), "
        + _stats("ence", "where not is_test"))

    q["hist_tenure"] = _hist("tenure", 30)
    q["hist_monthly_charges"] = _hist("monthly_charges", 40)
    q["rate_by_contract"] = _rate("contract")
    q["rate_by_internet"] = _rate("internet_service")
    q["rate_by_payment"] = _rate("payment_method")
    cols = ["senior_citizen", "tenure", "monthly_charges", "total_charges", "churn"]
    pairs = [(cols[j], cols[i]) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    q["correlation_pairs"] = with_cust(" union all ".join(
        f"select '{a}' as col_a, '{b}' as col_b, round(corr(cast({a} as double), cast({b} as double)), 6) as corr from cust"
        for a, b in pairs))

    every = sorted(SCALAR_FEATURES + indicator_cols() + ["churn"])
    both = [(every[i], every[j]) for i in range(len(every)) for j in range(i)]
    q["correlation_matrix"] = with_cust(
        "select unnest([" + ", ".join(f"'{a}'" for a, _ in both) + "]) as col_a, unnest(["
        + ", ".join(f"'{b}'" for _, b in both) + "]) as col_b, unnest(["
        + ", ".join(f"case when isfinite(corr({_q(a)}::double, {_q(b)}::double)) "
                    f"then round(corr({_q(a)}::double, {_q(b)}::double), 6) end" for a, b in both)
        + "]) as corr from enc", enc)
    tp, fp, fn = (f"count(*) filter (where churn = {y} and score {o} trial / {d(20)})" for y, o in (
        (1, ">="), (0, ">="), (1, "<")))
    q["best_threshold_so_far"] = with_cust(
        "select trial, round(f1, 6) as f1, round(max(f1) over (order by trial), 6) as best_so_far from t",
        SCORED + f""", t as (select trial, coalesce(2.0::double * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0) as f1
 from scored cross join (select unnest(range(1, 20))::integer as trial) group by trial)""")

    # cleaning: the dirt is the fixture's, the repair is written independently
    dirt = """d0 as (select * exclude (p), cast(substr(customer_id, 5, 7) as integer) as k from cust),
d1 as (select * replace (
  case when k % 5 = 0 or k % 11 = 0 then null else total_charges end as total_charges,
  case when k % 13 = 0 then null else tenure end as tenure,
  case when k % 17 = 0 then null else monthly_charges end as monthly_charges,
  case when k % 19 = 0 then null else payment_method end as payment_method,
  case when k % 4 = 0 then null else gender end as gender) from d0),
cleaned as (select * exclude (k) replace (
  coalesce(total_charges, round(monthly_charges * tenure, 2)) as total_charges) from d1)"""
    q["clean_dirty_customers"] = with_cust("select * from cleaned", dirt)
    q["null_profile_dirty"] = with_cust(" union all ".join(
        f"select '{c}' as \"column\", count(*) as null_count from cleaned where {c} is null having count(*) > 0"
        for c in RAW_COLS.split(",")), dirt)
    q["encode_dirty"] = with_cust("select * from enc", dirt + ", " + feat_cte("cleaned").replace(
        "from cust)", "from cleaned)") + ", " + enc_cte())

    q["risk_segment"] = with_cust(f"select customer_id, {_seg('p')} as risk_segment from cust")
    q["hard_decision"] = with_cust(
        f"select customer_id, cast(p >= {d(0.5)} as integer) as churn_prediction from cust")
    q["score_customers"] = with_cust(
        f"select customer_id, {SCORE} as churn_probability, cast(p >= {d(0.5)} as integer) as churn_prediction, "
        f"{_seg('p')} as risk_segment from cust")
    q["segment_detail"] = with_cust(
        f"select customer_id, p as churn_probability, churn as actual_churn, {_seg('p')} as risk_segment from cust")
    q["segment_summary"] = with_cust(f"""
select dim.risk_segment, dim.segment_rank, coalesce(s.cnt, 0)::bigint as count,
 round(s.rate, 6) as actual_churn_rate, round(s.prob, 6) as avg_prob
from (values ('Low Risk', 1), ('Medium Risk', 2), ('High Risk', 3)) dim(risk_segment, segment_rank)
left join (select {_seg('p')} as seg, count(*) cnt, avg(cast(churn as double)) rate, avg(p) prob
           from cust group by 1) s on s.seg = dim.risk_segment""")
    q["segment_counts"] = with_cust(f"""
select dim.risk_segment, coalesce(s.cnt, 0)::bigint as count
from (values ('Low Risk'), ('Medium Risk'), ('High Risk')) dim(risk_segment)
left join (select {_seg('p')} as seg, count(*) cnt from cust group by 1) s on s.seg = dim.risk_segment""")
    q["retention_impact"] = with_cust(f"""
select total_churners, churners_caught,
 case when total_churners > 0 then churners_caught / total_churners else 0.0 end as coverage, saved,
 case when total_churners > 0 then saved / total_churners else 0.0 end as reduction
from (select total_churners, churners_caught, cast(floor(churners_caught * {d(0.3)}) as bigint) as saved
 from (select cast(sum(churn) as bigint) total_churners,
   cast(coalesce(sum(case when ({_seg('p')}) = 'High Risk' then churn else 0 end), 0) as bigint) churners_caught
   from cust))""")

    q["metric_accuracy"] = with_cust(
        f"select round(avg(cast((churn = cast({SCORE} >= {d(0.5)} as integer)) as double)), 6) as accuracy from cust")
    q["metric_f1"] = with_cust(f"""
select round(case when 2 * tp + fp + fn = 0 then 0.0 else 2.0 * tp / (2 * tp + fp + fn) end, 6) as f1 from (
 select count(*) filter (where churn = 1 and s >= {d(0.5)}) tp, count(*) filter (where churn = 0 and s >= {d(0.5)}) fp,
 count(*) filter (where churn = 1 and s < {d(0.5)}) fn from (select churn, {SCORE} s from cust))""")
    q["metric_auc"] = with_cust("select round(auc_roc, 6) as auc_roc from t", SCORED + "," + _auc_ap("scored"))
    q["metric_avg_precision"] = with_cust(
        "select round(avg_precision, 6) as avg_precision from ap", SCORED + "," + _auc_ap("scored"))
    q["metrics_row"] = with_cust(f"""
select round(acc, 6) as accuracy, round(auc_roc, 6) as auc_roc,
 round(case when 2 * tp + fp + fn = 0 then 0.0 else 2.0 * tp / (2 * tp + fp + fn) end, 6) as f1,
 round(avg_precision, 6) as avg_precision
from t, ap, (select avg(cast((churn = cast(score >= {d(0.5)} as integer)) as double)) acc,
 count(*) filter (where churn = 1 and score >= {d(0.5)}) tp, count(*) filter (where churn = 0 and score >= {d(0.5)}) fp,
 count(*) filter (where churn = 1 and score < {d(0.5)}) fn from scored)""", SCORED + "," + _auc_ap("scored"))
    q["roc_curve"] = with_cust(f"""
select threshold, round(fpc / n, 6) as fpr, round(tpc / p, 6) as tpr from (
 select score as threshold, sum(tp) over (order by score desc)::double tpc, sum(fp) over (order by score desc)::double fpc,
 sum(tp) over ()::double p, sum(fp) over ()::double n from (
  select score, sum(churn) tp, sum(1 - churn) fp from scored group by score))
union all select 'infinity'::double, 0.0, 0.0""", SCORED)
    q["pr_curve"] = with_cust(f"""
select threshold, round(tpc / (tpc + fpc), 6) as precision, round(tpc / p, 6) as recall from (
 select score as threshold, sum(tp) over (order by score desc)::double tpc, sum(fp) over (order by score desc)::double fpc,
 sum(tp) over ()::double p from (
  select score, sum(churn) tp, sum(1 - churn) fp from scored group by score))
union all select null::double, 1.0, 0.0""", SCORED)
    q["confusion_matrix"] = with_cust(f"""
select a.actual, b.predicted, count(s.customer_id)::bigint as count
from (values (0), (1)) a(actual) cross join (values (0), (1)) b(predicted)
left join (select customer_id, churn, cast(score >= {d(0.5)} as integer) pred from scored) s
 on s.churn = a.actual and s.pred = b.predicted group by a.actual, b.predicted""", SCORED)
    q["classification_report"] = with_cust(f"""
select class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1_score, 6) as f1_score, support from (
 select '0' as class, p0 as precision, r0 as recall, f0 as f1_score, s0 as support from m
 union all select '1', p1, r1, f1, s1 from m
 union all select 'accuracy', null, null, (tp + tn) / n, n from m
 union all select 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n from m
 union all select 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n from m)""",
        SCORED + f""", c as (select count(*) filter (where churn = 1 and score >= {d(0.5)})::double tp,
 count(*) filter (where churn = 0 and score >= {d(0.5)})::double fp,
 count(*) filter (where churn = 0 and score < {d(0.5)})::double tn,
 count(*) filter (where churn = 1 and score < {d(0.5)})::double fn from scored),
m as (select tp, tn, (tn + fp)::bigint s0, (tp + fn)::bigint s1, (tp + fp + tn + fn)::bigint n,
 coalesce(tn / nullif(tn + fn, 0), 0) p0, coalesce(tn / nullif(tn + fp, 0), 0) r0,
 coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) f0,
 coalesce(tp / nullif(tp + fp, 0), 0) p1, coalesce(tp / nullif(tp + fn, 0), 0) r1,
 coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) f1 from c)""")
    q["model_comparison"] = with_cust(f"""
select s.model, round(acc, 6) as accuracy, round(auc_roc, 6) as auc_roc,
 round(case when 2 * tp + fp + fn = 0 then 0.0 else 2.0 * tp / (2 * tp + fp + fn) end, 6) as f1,
 round(avg_precision, 6) as avg_precision
from (select model, avg(cast((churn = cast(score >= {d(0.5)} as integer)) as double)) acc,
 count(*) filter (where churn = 1 and score >= {d(0.5)}) tp, count(*) filter (where churn = 0 and score >= {d(0.5)}) fp,
 count(*) filter (where churn = 1 and score < {d(0.5)}) fn from longm group by model) s
join t on t.model = s.model join ap on ap.model = s.model""", MODELS + "," + _auc_ap("longm", "model"))
    q["model_comparison_long"] = (
        q["model_comparison"].replace("\nselect s.model,", "\nselect * from (unpivot (select s.model,", 1)
        + ") on accuracy, auc_roc, f1, avg_precision into name metric value value)")
    q["soft_vote"] = with_cust(
        f"select customer_id, round(({SCORE} + (1 - cast(tenure as double) / 72) + monthly_charges / 120) / 3, 6) "
        "as soft_vote from cust")
    q["knn_minority"] = """
select vec_id, neighbor_id, rank from (
 select a.vec_id, b.vec_id as neighbor_id,
  cast(row_number() over (partition by a.vec_id order by
   list_distance(cast(a.embedding as double[]), cast(b.embedding as double[])), b.vec_id) as integer) as rank
 from embeddings a join embeddings b on a.label = b.label and a.vec_id <> b.vec_id) where rank <= 5"""
    names = ["random_forest", "logistic_regression", "gbt_a", "gbt_b", "gbt_fallback", "soft_voting",
             "stacking_ensemble"]
    q["model_score_check"] = with_cust(
        f"select unnest({names}) as model, n as n_rows, m as n_customers, 0::bigint as n_outside from "
        "(select count(*) as n, count(distinct customer_id) as m from sp where is_test)", split)
    q["out_of_fold_check"] = with_cust(
        f"select unnest({names[:4]}) as model, fold, churn, n as n_rows, n as n_customers, 0::bigint as n_outside from "
        f"(select cast(least(floor({u_id('fold')} * 5), 4) as integer) as fold, churn, count(*) as n from sp "
        "where not is_test group by 1, 2)", split)
    q["attribution_check"] = with_cust(
        "select count(*) as n_rows, 0::bigint as n_violations from sp where is_test", split)
    q["registry_check"] = with_cust(
        "select unnest(['logistic_regression', 'gbt_b', 'stacking_ensemble']) as model, n as n_rows, "
        "0::bigint as n_changed from (select count(*) as n from cust)")
    q["smote_row_check"] = with_cust("""
select churn, (select max(n) from c) - n as n_rows, (select max(n) from c) - n as n_ids, 0::bigint as n_strays
from c where n < (select max(n) from c)""",
        f"c as (select churn, count(*) as n from cust where not ({u_id('split')} < {d(0.2)}) group by churn)")
    q["smote_counts"] = with_cust("""
select churn, false as is_synthetic, n as count from c
union all
select churn, true, (select max(n) from c) - n from c
where n < (select max(n) from c) and (select count(*) from c) = 2""",
        f"c as (select churn, count(*) as n from cust where not ({u_id('split')} < {d(0.2)}) group by churn)")
    from .catalog import scorecard_terms
    terms = scorecard_terms()
    ind = "ind as (select " + ", ".join(f"cast({cond} as double) as {n}" for n, cond, _ in terms) + " from cust)"
    q["linear_attribution"] = with_cust(" union all ".join(
        f"select '{n}' as feature, round(avg(abs({d(w)} * ({n} - (select avg({n}) from ind)))), 6) "
        f"as mean_abs_attribution from ind" for n, _, w in terms), ind)
    return q


ORACLE_SQL = build()
