"""The registered queries as SQL for DuckDB, over the same order tables.

Written from the rules' text, with joins and NOT IN where the jobs aggregate.
Points, cut-offs, weights, purposes and key attributes are fixed values.
"""

from __future__ import annotations

_RAW = """
li as (
  select l_orderkey,
    cast(sum(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))) as decimal(28,4)) as pr,
    cast(sum(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2))) as decimal(28,4)) as it,
    cast(sum(case when l_returnflag = 'R' then cast(l_quantity as decimal(12,2)) else 0 end) as decimal(28,4)) as lf
  from lineitem group by l_orderkey
),
base as (
  select *, o_orderkey % 499 = 0 as blank,
    case when o_orderkey % 3 = 0 then 60 else 36 end as tm,
    cast(o_totalprice as decimal(12,2)) as price,
    strftime(o_orderdate, '%b-%Y') as mon
  from orders join customer on o_custkey = c_custkey left join li on l_orderkey = o_orderkey
),
raw as (
  select
    concat('L', cast(o_orderkey as varchar)) as id,
    case when not blank then c_name end as emp_title,
    case when not blank then case c_custkey % 13 when 0 then null when 1 then 'n/a' when 2 then '< 1 year'
      when 12 then '10+ years' else concat(cast(c_custkey % 13 - 1 as varchar), ' years') end end as emp_length,
    case when not blank then case c_mktsegment when 'BUILDING' then 'OWN' when 'AUTOMOBILE' then 'RENT'
      when 'FURNITURE' then 'MORTGAGE' when 'HOUSEHOLD' then 'ANY' else 'OTHER' end end as home_ownership,
    case when not blank and c_acctbal >= 0 then cast(floor(cast(c_acctbal as decimal(12,2)) * 10) as bigint) end as annual_inc,
    case when not blank then concat(lpad(cast(c_custkey % 1000 as varchar), 3, '0'), 'xx') end as zip_code,
    case when not blank then case c_nationkey % 10 when 0 then concat('NATION_', cast(c_nationkey as varchar))
      when 1 then 'ca' when 2 then null else concat(chr(65 + c_nationkey), 'A') end end as addr_state,
    case when not blank then substr('ABCDEFG', cast(1 + o_orderkey % 7 as int), 1) end as grade,
    case when not blank then concat(substr('ABCDEFG', cast(1 + o_orderkey % 7 as int), 1),
      cast(1 + (o_orderkey // 7) % 5 as varchar)) end as sub_grade,
    case when not blank then case c_custkey % 3 when 0 then 'Verified' when 1 then 'Source Verified'
      else 'Not Verified' end end as verification_status,
    cast(cast(abs(c_acctbal) as decimal(12,2)) * 100 + case when o_orderkey % 4 = 0 then 1000 else 0 end as decimal(28,4)) as tot_hi_cred_lim,
    case when c_custkey % 10 = 0 then 'Joint App' else 'Individual' end as application_type,
    case when c_custkey % 10 = 0 and c_acctbal >= 0 then cast(floor(cast(c_acctbal as decimal(12,2)) * 15) as decimal(28,4)) end as annual_inc_joint,
    case when c_custkey % 10 = 0 then 'Not Verified' end as verification_status_joint,
    case when o_orderkey % 97 <> 0 then cast(price as decimal(28,4)) end as loan_amnt,
    cast(price as decimal(28,4)) as funded_amnt,
    concat(' ', cast(tm as varchar), ' months') as term,
    concat(cast(5 + o_orderkey % 20 as varchar), '.5%') as int_rate,
    cast(cast(cast(price * 100 as bigint) // tm as decimal(12,2)) * 0.01 as decimal(28,4)) as installment,
    mon as issue_d,
    case (o_orderkey // 3) % 7 when 0 then 'Fully Paid' when 1 then 'Current' when 2 then 'In Grace Period'
      when 3 then 'Late (16-30 days)' when 4 then 'Late (31-120 days)' when 5 then 'Charged Off' else 'Default' end as loan_status,
    case o_orderkey % 9 when 0 then 'debt_consolidation' when 1 then 'credit_card' when 2 then 'car' when 3 then 'house'
      when 4 then 'medical' when 5 then 'wedding' when 6 then 'other' when 7 then 'zzz free text' else o_orderpriority end as purpose,
    concat('Loan ', o_orderpriority) as title,
    pr as total_rec_prncp, it as total_rec_int, lf as total_rec_late_fee,
    cast(case when o_orderkey % 50 = 0 then 0 else pr + it + lf end as decimal(28,4)) as total_pymnt,
    cast(cast(cast(price * 100 as bigint) // tm as decimal(12,2)) * 0.01 * (case o_orderkey % 5 when 0 then 0.25 when 1 then 0.75
      when 2 then 1.00 when 3 then 1.25 else 2.00 end) as decimal(28,4)) as last_pymnt_amnt,
    case when o_orderkey % 17 = 0 then '0.0' else mon end as last_pymnt_d,
    case when o_orderkey % 19 = 0 then '0.0' when o_orderkey % 2 = 0 then null else mon end as next_pymnt_d,
    case when o_orderkey % 41 = 0 then 'n/a' else concat(cast(greatest((o_orderkey // 2) % 12 - 5, 0) as varchar), '.0') end as delinq_2yrs,
    cast(o_orderkey % 4 * 100 as decimal(28,4)) as delinq_amnt,
    greatest(o_orderkey % 11 - 4, 0) as pub_rec,
    greatest((o_orderkey // 11) % 9 - 4, 0) as pub_rec_bankruptcies,
    greatest((o_orderkey // 13) % 10 - 3, 0) as inq_last_6mths,
    case when o_orderkey % 6 = 0 then 10 + o_orderkey % 50 end as mths_since_last_delinq,
    case when o_orderkey % 8 = 0 then 20 + o_orderkey % 50 end as mths_since_last_record
  from base
),
keyed as (
  select *, sha256(concat_ws('||', emp_title, emp_length, home_ownership, cast(annual_inc as varchar), zip_code,
    addr_state, grade, sub_grade, verification_status)) as member_id
  from raw
)"""

_SPLITS = """
split_customers as (
  select member_id, emp_title, emp_length, home_ownership, annual_inc, addr_state, zip_code, 'USA' as country,
    grade, sub_grade, verification_status, tot_hi_cred_lim, application_type, annual_inc_joint, verification_status_joint
  from keyed
),
split_loans as (
  select id as loan_id, member_id, loan_amnt, funded_amnt, term, int_rate, installment, issue_d, loan_status, purpose, title
  from keyed
),
split_repayments as (
  select id as loan_id, total_rec_prncp, total_rec_int, total_rec_late_fee, total_pymnt, last_pymnt_amnt, last_pymnt_d, next_pymnt_d
  from keyed
),
split_defaulters as (
  select member_id, delinq_2yrs, delinq_amnt, pub_rec, pub_rec_bankruptcies, inq_last_6mths, total_rec_late_fee,
    mths_since_last_delinq, mths_since_last_record
  from keyed
)"""

_CLEAN = """
parsed_customers as (
  select member_id, emp_title, try_cast(regexp_replace(emp_length, '\\D', '', 'g') as int) as emp_length, home_ownership,
    cast(annual_inc as decimal(28,4)) as annual_income, addr_state, zip_code as address_zipcode, country as address_country,
    grade, sub_grade, verification_status, tot_hi_cred_lim as total_high_credit_limit, application_type,
    annual_inc_joint as join_annual_income, verification_status_joint
  from (select distinct * from split_customers) where annual_inc is not null
),
customers as (
  select * exclude (addr_state) replace (coalesce(emp_length, (select cast(floor(avg(emp_length)) as int) from parsed_customers)) as emp_length),
    case when length(addr_state) > 2 then 'NA' else addr_state end as address_state
  from parsed_customers
),
loans as (
  select loan_id, member_id, loan_amnt as loan_amount, funded_amnt as funded_amount,
    cast(regexp_replace(term, '\\D', '', 'g') as int) / 12.0::double as loan_term_years,
    cast(replace(int_rate, '%', '') as decimal(8,4)) as interest_rate,
    installment as monthly_installment, issue_d as issue_date, loan_status,
    case when purpose in ('debt_consolidation', 'credit_card', 'home_improvement', 'other', 'major_purchase', 'medical',
      'small_business', 'car', 'vacation', 'moving', 'house', 'wedding', 'renewable_energy', 'educational')
      then purpose else 'other' end as loan_purpose,
    title as loan_title
  from split_loans
  where loan_amnt is not null and funded_amnt is not null and term is not null and installment is not null
    and issue_d is not null and loan_status is not null and purpose is not null
),
complete_repayments as (
  select loan_id, total_rec_prncp as total_principal_received, total_rec_int as total_interest_received,
    total_rec_late_fee as total_late_fee_received, total_pymnt as total_payment_received,
    last_pymnt_amnt as last_payment_amount, last_pymnt_d as last_payment_date, next_pymnt_d as next_payment_date
  from split_repayments
  where total_rec_prncp is not null and total_rec_int is not null and total_rec_late_fee is not null
    and total_pymnt is not null and last_pymnt_amnt is not null
),
repayments as (
  select * from (
    select * replace (
      cast(case when total_principal_received <> 0 and total_payment_received = 0
        then total_principal_received + total_interest_received + total_late_fee_received
        else total_payment_received end as decimal(28,4)) as total_payment_received,
      case when last_payment_date = '0.0' then null else last_payment_date end as last_payment_date,
      case when next_payment_date = '0.0' then null else next_payment_date end as next_payment_date)
    from complete_repayments)
  where total_payment_received <> 0
),
defaulters as (
  select * replace (coalesce(cast(try_cast(delinq_2yrs as double) as int), 0) as delinq_2yrs) from split_defaulters
),
delinq as (
  select member_id, delinq_2yrs, delinq_amnt, cast(mths_since_last_delinq as int) as mths_since_last_delinq
  from defaulters where delinq_2yrs > 0 or mths_since_last_delinq > 0
),
detail as (
  select member_id, coalesce(cast(pub_rec as int), 0) as pub_rec,
    coalesce(cast(pub_rec_bankruptcies as int), 0) as pub_rec_bankruptcies,
    coalesce(cast(inq_last_6mths as int), 0) as inq_last_6mths
  from defaulters
)"""

_QUARANTINE = """
bad as (
  select distinct member_id from (
    select member_id from customers group by member_id having count(*) > 1
    union all select member_id from delinq group by member_id having count(*) > 1
    union all select member_id from detail group by member_id having count(*) > 1)
),
customers_new as (select * from customers where member_id not in (select member_id from bad)),
delinq_new as (select * from delinq where member_id not in (select member_id from bad)),
detail_new as (select * from detail where member_id not in (select member_id from bad)),
loans_new as (select * from loans where member_id not in (select member_id from bad))"""


def _counted(column: str, many: int) -> str:
    return (
        f"case when {column} = 0 then 800 when {column} between 1 and 2 then 250 "
        f"when {column} between 3 and 5 then 100 "
        f"when {column} > 5 or {column} is null then {many} end"
    )


_SCORES = f"""
payment_points as (
  select l.loan_id, l.member_id,
    case when last_payment_amount < monthly_installment * 0.5 then 100
      when last_payment_amount >= monthly_installment * 0.5 and last_payment_amount < monthly_installment then 100
      when last_payment_amount = monthly_installment then 500
      when last_payment_amount > monthly_installment and last_payment_amount <= monthly_installment * 1.5 then 650
      when last_payment_amount > monthly_installment * 1.5 then 800 else 0 end as last_payment_pts,
    case when total_payment_received >= funded_amount * 0.5 then 650
      when total_payment_received < funded_amount * 0.5 and total_payment_received > 0 then 500
      when total_payment_received = 0 or total_payment_received is null then 0 end as total_payment_pts
  from repayments r join loans_new l on l.loan_id = r.loan_id
),
default_points as (
  select e.member_id, {_counted("delinq_2yrs", 750)} as delinq_pts, {_counted("pub_rec", 100)} as public_records_pts,
    {_counted("pub_rec_bankruptcies", 100)} as public_bankruptcies_pts, {_counted("inq_last_6mths", 0)} as enq_pts
  from detail_new e join delinq_new d on d.member_id = e.member_id
),
financial_points as (
  select l.loan_id, l.member_id,
    case when lower(loan_status) like '%fully paid%' then 800 when lower(loan_status) like '%current%' then 500
      when lower(loan_status) like '%in grace period%' then 250
      when lower(loan_status) like '%late (16-30 days)%' or lower(loan_status) like '%late (31-120 days)%' then 100
      else 0 end as loan_status_pts,
    case when lower(home_ownership) like '%own' then 800 when lower(home_ownership) like '%rent' then 500
      when lower(home_ownership) like '%mortgage' then 250
      when lower(home_ownership) like '%any' or home_ownership is null then 100 end as home_pts,
    case when funded_amount <= total_high_credit_limit * 0.1 then 800 when funded_amount <= total_high_credit_limit * 0.2 then 650
      when funded_amount <= total_high_credit_limit * 0.3 then 500 when funded_amount <= total_high_credit_limit * 0.5 then 250
      when funded_amount <= total_high_credit_limit * 0.7 then 100 else 0 end as credit_limit_pts,
    cast(case when grade in ('F', 'G') then 0
      when sub_grade[1] = grade and sub_grade[2] in ('1', '2', '3', '4', '5') then
        (case grade when 'A' then 800 when 'B' then 650 when 'C' then 500 when 'D' then 250 when 'E' then 100 end)
        * (case sub_grade[2] when '1' then 1.00 when '2' then 0.95 when '3' then 0.90 when '4' then 0.85 else 0.80 end)
      end as decimal(12,4)) as grade_pts
  from loans_new l join customers_new c on c.member_id = l.member_id
),
weighted as (
  select p.loan_id, p.member_id,
    cast((last_payment_pts + total_payment_pts) * 0.20 as decimal(12,4)) as payment_history_pts,
    cast((delinq_pts + public_records_pts + public_bankruptcies_pts + enq_pts) * 0.45 as decimal(12,4)) as defaulters_history_pts,
    cast((loan_status_pts + home_pts + credit_limit_pts + grade_pts) * 0.35 as decimal(12,4)) as financial_health_pts
  from payment_points p join default_points d on d.member_id = p.member_id join financial_points f on f.loan_id = p.loan_id
),
totals as (
  select *, cast(payment_history_pts + defaulters_history_pts + financial_health_pts as decimal(12,4)) as loan_score from weighted
),
scores as (
  select *, case when loan_score > 2500 then 'A' when loan_score > 2000 then 'B' when loan_score > 1500 then 'C'
    when loan_score > 1000 then 'D' when loan_score > 750 then 'E' when loan_score <= 750 then 'F' end as loan_final_grade
  from totals
)"""


def _banded(value: str) -> str:
    return (
        f"case when {value} >= 100 then 100 when {value} >= 80 then 80 "
        f"when {value} >= 60 then 60 when {value} >= 40 then 40 "
        f"when {value} >= 20 then 20 else 0 end"
    )


def _counted_100(value: str) -> str:
    return (
        f"case when {value} >= 3 then 20 when {value} >= 2 then 40 "
        f"when {value} >= 1 then 60 when {value} >= 0 then 100 else 0 end"
    )


def _pct(numerator: str, denominator: str) -> str:
    return (
        f"cast({numerator} as double) / nullif(cast({denominator} as double), 0) "
        f"* cast(100 as double)"
    )


_HUNDRED = f"""
hundred_payment as (
  select *, {_banded("last_payment_percentage")} as last_payment_pts, {_banded("total_payment_percentage")} as total_payment_pts
  from (
    select l.loan_id, l.member_id, {_pct("last_payment_amount", "monthly_installment")} as last_payment_percentage,
      {_pct("total_payment_received", "funded_amount")} as total_payment_percentage
    from repayments r join loans l on l.loan_id = r.loan_id)
),
hundred_defaulters as (
  select e.member_id, {_counted_100("delinq_2yrs")} as delinq_pts, {_counted_100("pub_rec")} as public_records_pts,
    {_counted_100("pub_rec_bankruptcies")} as public_bankruptcies_pts, {_counted_100("inq_last_6mths")} as enq_pts
  from detail_new e join delinq_new d on d.member_id = e.member_id
),
hundred_financial as (
  select loan_id, member_id, credit_limit_utilization,
    case loan_status when 'Fully Paid' then 100 when 'Current' then 80 when 'Late' then 40 else 20 end as loan_status_pts,
    case home_ownership when 'OWN' then 100 when 'MORTGAGE' then 60 when 'RENT' then 40 else 20 end as home_pts,
    {_banded("credit_limit_utilization")} as credit_limit_pts,
    case grade when 'A' then 100 when 'B' then 80 when 'C' then 60 when 'D' then 40 else 20 end as grade_pts
  from (
    select l.loan_id, l.member_id, {_pct("funded_amount", "total_high_credit_limit")} as credit_limit_utilization,
      loan_status, home_ownership, grade
    from loans_new l join customers_new c on c.member_id = l.member_id)
),
hundred_points as (
  select p.loan_id, p.member_id, last_payment_pts, total_payment_pts, delinq_pts, public_records_pts, public_bankruptcies_pts,
    enq_pts, loan_status_pts, home_pts, credit_limit_pts, grade_pts,
    (last_payment_pts + total_payment_pts) * cast(0.2 as double) as payment_history_score,
    (delinq_pts + public_records_pts + public_bankruptcies_pts + enq_pts) * cast(0.45 as double) as defaulters_history_score,
    (loan_status_pts + home_pts + credit_limit_pts + grade_pts) * cast(0.35 as double) as financial_health_score
  from hundred_payment p join hundred_defaulters d on d.member_id = p.member_id join hundred_financial f on f.loan_id = p.loan_id
),
hundred_final as (
  select *, case when total_score > 90 then 'A' when total_score > 80 then 'B' when total_score > 70 then 'C'
    when total_score > 60 then 'D' when total_score > 50 then 'E' else 'F' end as grade
  from (select *, payment_history_score + defaulters_history_score + financial_health_score as total_score from hundred_points)
)"""

_PARTS = (_RAW, _SPLITS, _CLEAN, _QUARANTINE, _SCORES, _HUNDRED)


def _sql(body: str, parts: int) -> str:
    return "with" + ",".join(_PARTS[:parts]) + "\n" + body


def _frequency(column: str, table: str, parts: int) -> str:
    return _sql(f"select {column}, count(*) as total from {table} group by 1", parts)


def _duplicated(table: str) -> str:
    return _sql(
        f"select member_id from {table} group by member_id having count(*) > 1", 3
    )


def _check(kind: str, column: str, hits: str, table: str) -> str:
    return (
        f"select '{kind}' as check_name, '{column}' as column_name, "
        f"cast({hits} as bigint) as n_hits, count(*) as n_rows, "
        f"coalesce(cast({hits} as double) / nullif(cast(count(*) as double), 0) "
        f"* cast(100 as double), 0) as pct from {table}"
    )


def _quality(table: str, nulls: list, uniques: list, ranges: dict, parts: int) -> str:
    checks = [
        _check("null_checks", c, f"count(*) filter (where {c} is null)", table)
        for c in nulls
    ]
    checks += [
        _check(
            "unique_checks",
            c,
            f"(count(distinct {c}) + coalesce(max(case when {c} is null then 1 else 0 end), 0))",
            table,
        )
        for c in uniques
    ]
    checks += [
        _check(
            "range_checks",
            c,
            f"count(*) filter (where {c} < {low} or {c} > {high})",
            table,
        )
        for c, (low, high) in ranges.items()
    ]
    return _sql(" union all ".join(checks), parts)


_DQ_LOANS = _quality(
    "loans",
    ["loan_id", "member_id", "funded_amount", "monthly_installment"],
    ["loan_id", "member_id"],
    {"funded_amount": (0, 1000000), "monthly_installment": (0, 10000)},
    3,
)

# Every loan of a customer once. A quarantined borrower's customer rows agree in
# the attributes of the key; what they may disagree in is not served.
_WIDE = _sql(
    """select l.loan_id, c.member_id, emp_title, emp_length, home_ownership, annual_income, address_state, address_zipcode,
      address_country, grade, sub_grade, verification_status, total_high_credit_limit, application_type, join_annual_income,
      verification_status_joint, loan_amount, funded_amount, loan_term_years, interest_rate, monthly_installment, issue_date,
      loan_status, loan_purpose, total_principal_received, total_interest_received, total_late_fee_received,
      last_payment_date, next_payment_date, delinq_2yrs, delinq_amnt, mths_since_last_delinq,
      pub_rec, pub_rec_bankruptcies, inq_last_6mths, is_quarantined
    from (
      select member_id, emp_title, emp_length, home_ownership, annual_income, address_state, address_zipcode, address_country,
        grade, sub_grade, verification_status, total_high_credit_limit, application_type, join_annual_income,
        verification_status_joint, false as is_quarantined
      from customers where member_id not in (select member_id from bad)
      union all
      select distinct member_id, emp_title, emp_length, home_ownership, annual_income, address_state, address_zipcode,
        address_country, grade, sub_grade, verification_status, null, null, null, null, true
      from customers where member_id in (select member_id from bad)) c
      left join loans l on c.member_id = l.member_id
      left join repayments r on l.loan_id = r.loan_id
      left join delinq d on c.member_id = d.member_id and not c.is_quarantined
      left join detail e on c.member_id = e.member_id and not c.is_quarantined""",
    4,
)

_COUNTS = _sql(
    """select 'customers' as table_name, count(*) as n_rows from customers
    union all select 'loans', count(*) from loans
    union all select 'loans_repayments', count(*) from repayments
    union all select 'loans_defaulters_delinq', count(*) from delinq
    union all select 'loans_defaulters_detail_rec_enq', count(*) from detail""",
    3,
)


def _mean(column: str) -> str:
    return (
        f"cast(sum({column}) as double) / nullif(cast(count({column}) as double), 0)"
    )


_REPORT_COLUMNS = (
    "count(*) as n_loans, count(*) filter (where loan_score is null) as n_unscored, "
    + ", ".join(
        f"{_mean(c)} as avg_{c}"
        for c in (
            "payment_history_pts",
            "defaulters_history_pts",
            "financial_health_pts",
            "loan_score",
        )
    )
)


def _far(column: str) -> str:
    value = f"cast({column} as double)"
    return (
        f"select loan_id, '{column}' as column_name, {value} as value from repayments, "
        f"(select avg({value}) as m, stddev_samp({value}) as sd from repayments) "
        f"where abs({value} - m) > 3 * sd"
    )


_TYPES = {
    "double": "annual_inc delinq_2yrs pub_rec pub_rec_bankruptcies inq_last_6mths mths_since_last_delinq mths_since_last_record",
    "decimal(28,4)": "tot_hi_cred_lim annual_inc_joint loan_amnt funded_amnt installment total_rec_prncp total_rec_int "
    "total_rec_late_fee total_pymnt last_pymnt_amnt delinq_amnt",
}
_UNPARSED = _sql(
    " union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {c} is not null and "
        f"try_cast(cast({c} as varchar) as {kind}) is null) as n_unparsed from raw"
        for kind, columns in _TYPES.items()
        for c in columns.split()
    ),
    1,
)
_MEMBER_TABLES = {
    "customers": "customers",
    "loans_defaulters_delinq": "delinq",
    "loans_defaulters_detail_rec_enq": "detail",
}
_BAD_LISTS = _sql(
    " union all ".join(
        f"select 'bad_{name}' as list_name, member_id from {table} group by member_id having count(*) > 1"
        for name, table in _MEMBER_TABLES.items()
    )
    + " union all select 'bad_customer_data_final', member_id from bad",
    4,
)
_EXTERNAL = _sql(
    " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows from {table}"
        for name, table in {
            **_MEMBER_TABLES,
            "loans": "loans",
            "loans_repayments": "repayments",
            "customers_new": "customers_new",
            "loans_new": "loans_new",
            "loans_defaulters_delinq_new": "delinq_new",
            "loans_defaulters_detail_rec_enq_new": "detail_new",
        }.items()
    ),
    4,
)

_SCORE_ROWS = _sql("select * from scores", 5)

# Days: scores of five runs that move by a rule on the loan's number.
_DAYS = """
days as (
  select * from (values (0, date '2020-01-01'), (1, date '2020-01-02'), (2, date '2020-01-05'), (3, date '2020-02-01'),
    (4, date '2020-03-10')) as t(k, score_date)
),
moved as (
  select loan_id, k, score_date, cast(loan_score + 300 * (((n + k) // 2) % 3) as decimal(12,4)) as loan_score
  from (select loan_id, loan_score, cast(substr(loan_id, 2) as bigint) as n from scores), days where (n + k) % 5 <> 0
),
daily as (
  select *, case when loan_score > 2500 then 'A' when loan_score > 2000 then 'B' when loan_score > 1500 then 'C'
    when loan_score > 1000 then 'D' when loan_score > 750 then 'E' when loan_score <= 750 then 'F' end as loan_final_grade
  from moved
)"""


def _days(body: str) -> str:
    return "with" + ",".join([*_PARTS[:5], _DAYS]) + "\n" + body


def _arrived(upto: int) -> str:
    """The scores after some arrivals, from the raw rows that have come."""
    raw = _RAW.replace("from raw\n)", f"from raw where cast(substr(id, 2) as bigint) % 3 <= {upto}\n)")
    return "(with" + ",".join([raw, *_PARTS[1:5]]) + "\nselect * from scores)"


_OTHER_SCORES = (
    _SCORES.replace("* 0.20", "* 0.30").replace("* 0.45", "* 0.30").replace("* 0.35", "* 0.40")
    .replace("750 end as delinq_pts", "700 end as delinq_pts")
    .replace("> 2500 then 'A'", "> 2400 then 'A'").replace("> 2000 then 'B'", "> 1900 then 'B'")
    .replace("> 1500 then 'C'", "> 1400 then 'C'").replace("> 1000 then 'D'", "> 900 then 'D'")
    .replace("> 750 then 'E'", "> 700 then 'E'").replace("<= 750 then 'F'", "<= 700 then 'F'")
)


def _outside(column: str) -> str:
    """Values outside the quartile fences; a quartile is the value at ceil(n / 4)."""
    return (
        f"select loan_id, '{column}' as column_name, v as value "
        f"from (select loan_id, cast({column} as double) as v from repayments), ("
        f"select q1 - 1.5 * (q3 - q1) as low, q3 + 1.5 * (q3 - q1) as high from ("
        f"select max(v) filter (where r = ceil(n * 0.25)) as q1, max(v) filter (where r = ceil(n * 0.75)) as q3 from ("
        f"select v, row_number() over (order by v) as r, count(*) over () as n "
        f"from (select cast({column} as double) as v from repayments)))) where v < low or v > high"
    )


_MONTHLY = """
monthly as (
  select strftime(strptime('01-' || issue_date, '%d-%b-%Y'), '%Y-%m') as issue_month, loan_final_grade, count(*) as n_loans,
    count(loan_score) as n_scored, sum(loan_score) as sum_score
  from scores s join loans l on l.loan_id = s.loan_id group by 1, 2
)"""

_MONTHLY_SCORES = _sql(
    f"""select strftime(strptime('01-' || issue_date, '%d-%b-%Y'), '%Y-%m') as issue_month, loan_final_grade,
      count(*) as n_loans, {_mean("loan_score")} as avg_score, min(loan_score) as min_score, max(loan_score) as max_score
    from scores s join loans l on l.loan_id = s.loan_id group by 1, 2""",
    5,
)

ORACLES: dict[str, str] = {
    "member_key": _sql("select id as loan_id, member_id from keyed", 1),
    "raw_profile": _sql(
        """select cast(sum(total) as bigint) as n_rows, count(*) as n_members,
          count(*) filter (where total > 1) as n_repeated_members, 37 as n_columns
        from (select member_id, count(*) as total from keyed group by member_id)""",
        1,
    ),
    "repeated_members": _sql(
        """select member_id, count(*) as total from keyed group by member_id having count(*) > 1
        order by total desc, member_id""",
        1,
    ),
    "member_freq_topk": _sql(
        """select member_id, count(*) as total from keyed group by member_id having count(*) > 1
        order by total desc, member_id limit 2""",
        1,
    ),
    "empty_key_rows": _sql(
        "select id, member_id from keyed where member_id like 'e3b0c44298fc1c149%'", 1
    ),
    "member_inspect": _sql(
        """select member_id, id, tot_hi_cred_lim, delinq_2yrs, inq_last_6mths
        from keyed where member_id like 'e4%'""",
        1,
    ),
    "key_with_null_token": _sql(
        """select id as loan_id, sha256(concat_ws('||', coalesce(emp_title, '?'), coalesce(emp_length, '?'),
          coalesce(home_ownership, '?'), coalesce(cast(annual_inc as varchar), '?'), coalesce(zip_code, '?'),
          coalesce(addr_state, '?'), coalesce(grade, '?'), coalesce(sub_grade, '?'),
          coalesce(verification_status, '?'))) as member_id from raw""",
        1,
    ),
    "split_customers": _sql("select * from split_customers", 2),
    "split_loans": _sql("select * from split_loans", 2),
    "split_repayments": _sql("select * from split_repayments", 2),
    "split_defaulters": _sql("select * from split_defaulters", 2),
    "clean_customers": _sql("select * from customers", 3),
    "emp_length_impute": _sql(
        "select emp_length, count(*) as n_customers from customers group by 1", 3
    ),
    "emp_length_values": _sql("select distinct emp_length from split_customers", 2),
    "state_norm_length": _frequency("address_state", "customers", 3),
    "state_norm_regex": _sql(
        """select case when regexp_full_match(addr_state, '[A-Z]{2}') then addr_state else 'NA' end as address_state,
          count(*) as total from parsed_customers group by 1""",
        3,
    ),
    "long_state_codes": _sql(
        "select count(*) as n_rows from split_customers where length(addr_state) > 2", 2
    ),
    "clean_loans": _sql("select * from loans", 3),
    "loan_purpose_freq": _frequency("loan_purpose", "loans", 3),
    "raw_purpose_freq": _frequency("purpose", "keyed", 1),
    "clean_repayments": _sql("select * from repayments", 3),
    "zero_payment_anomalies": _sql(
        """select * from complete_repayments
        where total_payment_received = 0 and total_principal_received <> 0""",
        3,
    ),
    "zero_payment_counts": _sql(
        """select count(*) as n_rows, count(*) filter (where total_payment_received = 0) as n_zero,
          count(*) filter (where total_payment_received = 0 and total_principal_received <> 0) as n_unbooked
        from complete_repayments""",
        3,
    ),
    "date_sentinels": _sql(
        """select count(*) filter (where last_pymnt_d = '0.0') as n_last_marked,
          count(*) filter (where next_pymnt_d = '0.0') as n_next_marked,
          count(*) filter (where last_pymnt_d = '0.0' or last_pymnt_d is null) as n_last_missing,
          count(*) filter (where next_pymnt_d = '0.0' or next_pymnt_d is null) as n_next_missing
        from split_repayments""",
        2,
    ),
    "clean_defaulters": _sql("select * from defaulters", 3),
    "delinq_freq_raw": _frequency("delinq_2yrs", "keyed", 1),
    "delinq_freq": _frequency("delinq_2yrs", "defaulters", 3),
    "delinq_extract": _sql("select * from delinq", 3),
    "delinq_extract_all_columns": _sql(
        "select * from defaulters where delinq_2yrs > 0 or mths_since_last_delinq > 0",
        3,
    ),
    "credit_issue_members": _sql(
        """select member_id from defaulters
        where pub_rec > 0 or pub_rec_bankruptcies > 0 or inq_last_6mths > 0""",
        3,
    ),
    "credit_issue_records": _sql(
        """select * from defaulters
        where pub_rec > 0 or pub_rec_bankruptcies > 0 or inq_last_6mths > 0""",
        3,
    ),
    "detail_records": _sql("select * from detail", 3),
    "table_counts": _COUNTS,
    "member_freq_customers": _frequency("member_id", "customers", 3),
    "dup_members_customers": _duplicated("customers"),
    "dup_members_delinq": _duplicated("delinq"),
    "dup_members_detail": _duplicated("detail"),
    "quarantine_list": _sql("select * from bad", 4),
    "quarantine_list_of_tables": _sql("select * from bad", 4),
    "customers_new": _sql("select * from customers_new", 4),
    "delinq_new": _sql("select * from delinq_new", 4),
    "detail_new": _sql("select * from detail_new", 4),
    "loans_not_quarantined": _sql("select * from loans_new", 4),
    "member_freq_customers_new": _frequency("member_id", "customers_new", 4),
    "payment_points": _sql("select * from payment_points", 5),
    "default_points": _sql("select * from default_points", 5),
    "financial_points": _sql("select * from financial_points", 5),
    "loan_score": _SCORE_ROWS,
    "loan_score_joined": _SCORE_ROWS,
    "loan_score_bucketed": _SCORE_ROWS,
    "loan_score_stored": _sql(
        """select s.*, issue_date, 'registered' as run_id, date '2020-01-01' as score_date
        from scores s join loans l on l.loan_id = s.loan_id""",
        5,
    ),
    "grade_distribution": _sql(
        "select loan_final_grade, count(*) as n_loans from scores group by 1", 5
    ),
    "grade_slice": _sql("select * from scores where loan_final_grade in ('C')", 5),
    "scored_count": _sql(
        "select 'loan_score' as table_name, count(*) as n_rows from scores", 5
    ),
    "pct_ops": _sql(
        f"""select id as loan_id, {_pct("installment", "funded_amnt")} as installment_pct from keyed""",
        1,
    ),
    "threshold_points": _sql(
        f"""select id as loan_id, inq_last_6mths, {_counted_100("inq_last_6mths")} as enq_pts from keyed""",
        1,
    ),
    "string_map": _sql(
        """select id as loan_id, case home_ownership when 'ANY' then 'OTHER' when 'OWN' then 'OWNED'
          else home_ownership end as home_ownership from keyed""",
        1,
    ),
    "hundred_payment": _sql("select * from hundred_payment", 6),
    "hundred_payment_as_written": _sql(
        """select * replace (0 as last_payment_pts, 0 as total_payment_pts) from hundred_payment""",
        6,
    ),
    "hundred_defaulters": _sql("select * from hundred_defaulters", 6),
    "hundred_financial": _sql("select * from hundred_financial", 6),
    "hundred_final": _sql("select * from hundred_final", 6),
    "hundred_final_joined": _sql("select * from hundred_final", 6),
    "hundred_saved": _sql(
        """select member_id, payment_history_score, defaulters_history_score, financial_health_score, total_score, grade
        from hundred_final""",
        6,
    ),
    "dq_loans": _DQ_LOANS,
    "dq_loans_raw": _quality(
        "(select loan_amnt as loan_amount, purpose as loan_purpose, issue_d as issue_date, loan_status from split_loans)",
        ["loan_amount", "loan_purpose", "issue_date"],
        ["loan_status", "loan_purpose"],
        {"loan_amount": (5000, 400000)},
        2,
    ),
    "dq_customers": _quality(
        "customers",
        ["member_id", "annual_income", "home_ownership"],
        ["member_id"],
        {"annual_income": (0, 10000000)},
        3,
    ),
    "dq_repayments": _quality(
        "repayments",
        ["loan_id", "last_payment_amount", "total_payment_received"],
        ["loan_id"],
        {"last_payment_amount": (0, 10000), "total_payment_received": (0, 1000000)},
        3,
    ),
    "dq_failures": f"""select * from ({_DQ_LOANS}) where (check_name = 'null_checks' and pct > 0)
      or (check_name = 'unique_checks' and 100 - pct > 1)""",
    "outliers": _sql(
        " union all ".join(
            _far(c)
            for c in (
                "total_payment_received",
                "total_late_fee_received",
                "last_payment_amount",
            )
        ),
        3,
    ),
    "wide_view": _WIDE,
    "wide_view_catalog": _WIDE,
    "wide_table_catalog": _WIDE,
    "monthly_scores": _MONTHLY_SCORES,
    "monthly_scores_merged": _MONTHLY_SCORES,
    "score_report": _sql(
        f"""select loan_purpose, address_state, cast(grouping_id(loan_purpose, address_state) as int) as grouping_level, {_REPORT_COLUMNS}
        from scores s join loans l on l.loan_id = s.loan_id join customers_new c on c.member_id = s.member_id
        group by rollup (loan_purpose, address_state)""",
        5,
    ),
    "score_report_by_grade": _sql(
        f"""select loan_final_grade, cast(grouping_id(loan_final_grade) as int) as grouping_level, {_REPORT_COLUMNS}
        from scores group by rollup (loan_final_grade)""",
        5,
    ),
    "raw_csv_keys": _sql(
        """select id as loan_id, sha256(concat_ws('||', emp_title, emp_length, home_ownership,
          cast(cast(annual_inc as double) as varchar), zip_code, addr_state, grade, sub_grade, verification_status)) as member_id
        from raw""",
        1,
    ),
    "csv_roundtrip": _sql(
        "select * replace (cast(annual_inc as decimal(28,4)) as annual_inc) from split_customers",
        2,
    ),
    "single_file_csv": _sql("select member_id, 1 as n_files from bad", 4),
    "csv_pipeline": _COUNTS,
    "parquet_roundtrip": _sql("select * from loans", 3),
    "stream_scores": _SCORE_ROWS,
    "unparsed_values": _UNPARSED,
    "inferred_csv": _sql(
        """select cast(delinq_amnt as double) as delinq_amnt, cast(pub_rec as integer) as pub_rec, count(*) as total
        from split_defaulters group by 1, 2""",
        2,
    ),
    "cleaned_csv": _sql(
        "select *, member_id in (select member_id from bad) as is_quarantined from loans", 4
    ),
    "temp_view": _frequency("loan_status", "loans", 3),
    "ingest_dates": _sql("select loan_id, '2020-01-31 12:30:00' as ingested from loans", 3),
    "external_tables": _EXTERNAL,
    "external_loans": _sql(
        "select *, member_id in (select member_id from bad) as is_quarantined from loans", 4
    ),
    "member_freq_delinq": _frequency("member_id", "delinq", 3),
    "member_freq_detail": _frequency("member_id", "detail", 3),
    "member_inspect_customers": _sql(
        "select member_id, total_high_credit_limit from customers where member_id like 'e4%'", 3
    ),
    "member_inspect_delinq": _sql("select * from delinq where member_id like 'e4%'", 3),
    "member_inspect_detail": _sql("select * from detail where member_id like 'e4%'", 3),
    "bad_member_lists": _BAD_LISTS,
    "loan_score_sql": _SCORE_ROWS,
    "loan_score_other_rules": "with" + ",".join([*_PARTS[:4], _OTHER_SCORES]) + "\nselect * from scores",
    "score_history": _days(
        """select loan_id, loan_score, loan_final_grade, min(score_date) as valid_from,
          (select score_date from days where days.k = max(i.k) + 1) as valid_to
        from (select *, k - row_number() over (partition by loan_id, loan_score order by k) as island from daily) i
        group by loan_id, loan_score, loan_final_grade, island"""
    ),
    "scores_as_of": _days(
        """select a.loan_id, a.asked_on, loan_score, loan_final_grade
        from (select loan_id, n, date '2020-01-01' + cast(n % 80 - 5 as int) as asked_on,
            (select max(k) from days where score_date <= date '2020-01-01' + cast(n % 80 - 5 as int)) as k
          from (select id as loan_id, cast(substr(id, 2) as bigint) as n from keyed)) a
        left join daily d on d.loan_id = a.loan_id and d.k = a.k"""
    ),
    "grade_migration": _days(
        """select b.m as to_month, a.loan_final_grade as from_grade, b.loan_final_grade as to_grade, count(*) as n_loans
        from held a join held b on a.loan_id = b.loan_id and b.m = a.m + interval 1 month group by 1, 2, 3"""
    ).replace(
        "\nselect b.m",
        """,
held as (
  select loan_id, loan_final_grade, m from (
    select *, date_trunc('month', score_date)::date as m,
      row_number() over (partition by loan_id, date_trunc('month', score_date) order by k desc) as r from daily)
  where r = 1
)
select b.m""",
    ),
    "rolling_scores": "with"
    + ",".join([*_PARTS[:5], _MONTHLY])
    + """
select m.issue_month, m.loan_final_grade, m.n_loans, cast(m.n_loans - coalesce(sum(o.n_loans) filter (where o.i = m.i - 1), 0) as bigint) as n_more_loans,
  cast(sum(o.sum_score) as double) / nullif(cast(sum(o.n_scored) as double), 0) as rolling_score
from (select *, 12 * cast(substr(issue_month, 1, 4) as int) + cast(substr(issue_month, 6, 2) as int) as i from monthly) m
join (select *, 12 * cast(substr(issue_month, 1, 4) as int) + cast(substr(issue_month, 6, 2) as int) as i from monthly) o
  on o.loan_final_grade is not distinct from m.loan_final_grade and o.i between m.i - 2 and m.i
group by m.issue_month, m.loan_final_grade, m.n_loans""",
    "robust_outliers": _sql(
        " union all ".join(
            _outside(c) for c in ("total_payment_received", "total_late_fee_received", "last_payment_amount")
        ),
        3,
    ),
    "distinct_over_months": _sql(
        " union all ".join(
            f"select '{c}' as column_name, count(distinct {e}) as n_distinct, true as is_close from keyed"
            for c, e in (("member_id", "member_id"), ("loan_id", "id"), ("purpose", "purpose"))
        ),
        1,
    ),
    "wide_table_refreshed": _WIDE,
    "customer_loans_salted": _sql(
        """select loan_id, member_id, loan_status, grade, home_ownership
        from loans join (select distinct member_id, grade, home_ownership from customers) using (member_id)""",
        3,
    ),
    "dq_observed": _DQ_LOANS,
    "loans_published": _sql("select * from loans", 3),
    "csv_rejects": _sql(
        """select case n % 50 when 0 then 'too few columns' when 1 then 'too many columns' when 2 then 'values'
            when 3 then 'values' else 'kept' end as reason,
          case n % 50 when 2 then 'loan_amnt' when 3 then 'funded_amnt,installment' else '' end as lost, count(*) as n_rows
        from (select cast(substr(loan_id, 2) as bigint) as n from split_loans) group by 1, 2""",
        2,
    ),
    "stream_quarantine": _SCORE_ROWS,
    "stream_retracted": " union all ".join(
        f"select * from {_arrived(i)} where loan_id not in (select loan_id from {_arrived(i + 1)})" for i in range(2)
    ),
    # All loans, those of quarantined borrowers too.
    "stream_joined_payments": _sql("select * from payment_points", 5).replace("join loans_new l on l.loan_id = r.loan_id", "join loans l on l.loan_id = r.loan_id"),
}
