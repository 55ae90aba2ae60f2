"""Shared SQL text for the DuckDB oracles.

``CUST`` is the fixture customer table written as independent SQL over the
driver's ``customer`` view: same hash draws, same formulas, every decimal
literal cast to double so both engines compute in binary floating point.
"""

from __future__ import annotations

from ..functions.random import sql_normal, sql_uniform


def _u(stream: str) -> str:
    return sql_uniform("c_custkey", stream)


def _z(stream: str) -> str:
    return sql_normal("c_custkey", stream)


def d(x: float) -> str:
    return f"cast({x} as double)"


def cust_sql() -> str:
    """SELECT producing the 21 raw columns plus the propensity ``p``."""
    gamma = f"(-ln({_u('t1')})-ln({_u('t2')})+power({_z('t3')},2)/2)"
    addon = {"online_security": 0.29, "tech_support": 0.29, "online_backup": 0.34,
             "device_protection": 0.34, "streaming_tv": 0.38, "streaming_movies": 0.39}
    addon_u = ",".join(f"{_u(n)} as u_{n}" for n in addon)
    addon_case = ",".join(
        f"case when internet_service='No' then 'No internet service' when u_{n}<{d(s)} then 'Yes' else 'No' end as {n}"
        for n, s in addon.items())
    return f"""
with b as (select concat('CUST',lpad(cast(c_custkey as varchar),7,'0')) customer_id,
 case when {_u('gender')}<{d(0.5)} then 'Male' else 'Female' end gender,
 case when {_u('senior')}<{d(0.84)} then 0 else 1 end senior_citizen,
 case when {_u('partner')}<{d(0.48)} then 'Yes' else 'No' end as partner,
 case when {_u('dependents')}<{d(0.3)} then 'Yes' else 'No' end as dependents,
 cast(floor(least({d(72.0)},greatest({d(1.0)},14*{gamma}))) as integer) tenure,
 case when {_u('contract')}<{d(0.55)} then 'Month-to-month' when {_u('contract')}<{d(0.79)} then 'One year' else 'Two year' end contract,
 case when {_u('inet')}<{d(0.34)} then 'DSL' when {_u('inet')}<{d(0.78)} then 'Fiber optic' else 'No' end internet_service,
 {addon_u},
 case when {_u('phone')}<{d(0.9)} then 'Yes' else 'No' end as phone_service, {_u('lines')} as u_lines,
 case when {_u('paperless')}<{d(0.59)} then 'Yes' else 'No' end as paperless_billing,
 case when {_u('pay')}<{d(0.34)} then 'Electronic check' when {_u('pay')}<{d(0.57)} then 'Mailed check' when {_u('pay')}<{d(0.79)} then 'Bank transfer (automatic)' else 'Credit card (automatic)' end payment_method,
 {_z('charge')} as z_charge, {_u('total')} as u_total, {_u('churn')} as u_churn from customer),
c as (select customer_id,gender,senior_citizen,partner,dependents,tenure,contract,internet_service,
 {addon_case},
 phone_service, case when phone_service='No' then 'No phone service' when u_lines<{d(0.42)} then 'Yes' else 'No' end multiple_lines,
 paperless_billing,payment_method,
 round(least({d(120.0)},greatest({d(18.0)},case internet_service when 'Fiber optic' then 80+20*z_charge when 'DSL' then 55+15*z_charge else 25+8*z_charge end)),2) monthly_charges,
 u_total,u_churn from b),
dd as (select *, round(monthly_charges*tenure*({d(0.9)}+{d(0.2)}*u_total),2) total_charges,
 least({d(0.95)},greatest({d(0.0)},{d(0.05)}+case contract when 'Month-to-month' then {d(0.28)} when 'One year' then {d(0.05)} else {d(0)} end
 +case when tenure<=6 then {d(0.20)} else {d(0)} end+case when tenure<=12 then {d(0.10)} else {d(0)} end-case when tenure>=48 then {d(0.12)} else {d(0)} end
 +case when monthly_charges>80 then {d(0.12)} else {d(0)} end+case when tech_support='No' then {d(0.08)} else {d(0)} end+case when online_security='No' then {d(0.07)} else {d(0)} end
 +case when internet_service='Fiber optic' then {d(0.08)} else {d(0)} end+case when payment_method='Electronic check' then {d(0.08)} else {d(0)} end+senior_citizen*{d(0.05)})) p from c)
select customer_id,gender,senior_citizen,partner,dependents,tenure,contract,internet_service,
 online_security,tech_support,online_backup,device_protection,streaming_tv,streaming_movies,
 phone_service,multiple_lines,paperless_billing,payment_method,monthly_charges,total_charges,
 case when u_churn<p then 1 else 0 end churn, p from dd
"""


def with_cust(body: str, extra_ctes: str = "") -> str:
    """Prefix a query with the ``cust`` CTE (and optional further CTEs)."""
    extra = f", {extra_ctes}" if extra_ctes else ""
    return f"with cust as ({cust_sql()}){extra}\n{body}"
