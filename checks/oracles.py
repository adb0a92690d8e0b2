"""The registered queries in plain SQL over the same tables, written independently of the operators."""

from __future__ import annotations

from checks.fixtures import PL_MONTHS, REGIONS, VIEWS
from checks.queries import (
    AS_OF,
    FACILITY,
    INCLUDED_OFFICES,
    KEYWORDS,
    KNOWN_REGIONS,
    MONTH,
    PATIENT,
    PATIENT_CATEGORIES,
    PL_MONTH,
    SNAPSHOT_PREFIXES,
)

# every month of the yearly sheets; the visits lie within them
ALL_MONTHS = [f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13)]
# Fixed values of the reports, written out here and not imported, so that a wrong value in the library shows.
VALID_STAGES = (
    "Closed",
    "Open",
    "Review",
    "In Progress",
    "Not Started",
    "Patient Canceled",
    "Center Canceled",
    "No Show",
)
VISITS_ONLY_NOTE = "In visits but NOT in claims - possible billing delay or data entry issue"
CLAIMS_ONLY_NOTE = "In claims but NOT in visits - UNMATCHED patient or data discrepancy"
DEPOSIT_CAUSES_LEDGER_HIGH = (
    "Deposits not yet recorded in the visit system",
    "Non-patient deposits (loans, transfers)",
    "Timing difference - payment received before visit closed",
)
DEPOSIT_CAUSES_VISITS_HIGH = (
    "Visit payments not yet deposited",
    "Refunds or chargebacks in the ledger",
    "Credit card processing delays",
)
PL_CAUSES_LEDGER_HIGH = (
    "Insurance payments received but not posted to visits in the visit system",
    "Payments for older visits (before the visit system date range)",
    "Timing difference - ledger records when deposited, the visit system when posted",
)
PL_CAUSES_VISITS_HIGH = (
    "Visit payments not yet reflected in the ledger",
    "Refunds or adjustments in the ledger",
    "Possible data entry discrepancy",
)
AGE_BUCKETS = (
    ("31-60 days", 31, 60),
    ("61-90 days", 61, 90),
    ("91-120 days", 91, 120),
    ("120+ days", 121, None),
)
BILLING = "('Review','Open','Closed')"
CANCELED = "('Patient Canceled','Center Canceled')"
OPERATIONAL = "('No Show','Patient Canceled','Center Canceled','Not Started')"


def quoted(values) -> str:
    return "(" + ",".join("'" + str(v).replace("'", "''") + "'" for v in values) + ")"


def dbl(x: str) -> str:
    return f"cast({x} as double)"


def big(x: str) -> str:
    return f"cast({x} as bigint)"


def rnd(x: str, digits: int = 2) -> str:
    f = float(10**digits)
    up = f"cast(cast(floor(({x}) * {f} + 0.5) as bigint) as double) / {f}"
    down = f"cast(-cast(floor(-({x}) * {f} + 0.5) as bigint) as double) / {f}"
    return f"(case when ({x}) < 0 then {down} else {up} end)"


def ratio(n: str, d: str, factor: str = "") -> str:
    return f"({dbl(n)} / nullif({dbl(d)}, 0){factor})"


def pct(n: str, d: str, digits: int = 2) -> str:
    return rnd(ratio(n, d, " * 100.0"), digits)


def zsum(x: str, where: str | None = None) -> str:
    return f"coalesce(sum({x})" + (f" filter (where {where})" if where else "") + ", 0)"


def month(x: str) -> str:
    return f"strftime({x}, '%Y-%m')"


def text_date(x: str) -> str:
    return f"cast(cast({x} as date) as varchar)"


def one_of(case: dict[str, str], default: str = "null") -> str:
    return "case " + " ".join(f"when {k} then {v}" for k, v in case.items()) + f" else {default} end"


_FACILITY_OF = f"case when facility in {quoted(KNOWN_REGIONS)} then facility else 'Unknown' end"
_OFFICE_FACILITY = one_of({f"upper(office) like '%{r}%'": f"'{r}'" for r in KNOWN_REGIONS}, "'Unknown'")
_DOB = "date_of_birth"

# name -> (tables it reads, text)
STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "pnames": (
        ("fx_patients",),
        """select name_norm, max_by(patient_id, patient_id) as patient_id from (
             select patient_id, upper(trim(split_part(patient_name, ',', 2)) || ' ' || trim(split_part(patient_name, ',', 1))) as name_norm
             from fx_patients) p group by name_norm""",
    ),
    "kclaims": (
        ("fx_claims", "pnames"),
        """select c.*, coalesce(e.patient_id, f.patient_id) as patient_id,
             case when e.patient_id is not null then 'exact' when f.patient_id is not null then 'first_last' else 'none' end as match_level
           from fx_claims c left join pnames e on e.name_norm = upper(trim(c.patient_name))
           left join pnames f on f.name_norm = upper(split_part(trim(c.patient_name), ' ', 1) || ' ' || split_part(trim(c.patient_name), ' ', -1))""",
    ),
    "g1": (
        ("kclaims",),
        """select * from kclaims where patient_id is not null and service_date is not null
           qualify row_number() over (partition by patient_id, service_date order by row_no desc) = 1""",
    ),
    "vl": (
        ("fx_visits",),
        "select * from fx_visits qualify row_number() over (partition by patient_id, dos order by row_no desc) = 1",
    ),
    "flagged": (
        ("fx_visits", "g1"),
        f"""select *, lb_days > 14 and visit_stage = 'Review' as f_attn,
             visit_stage = 'Open' and lb_days > 30 and coalesce(total_paid, 0) = 0 and ci = 0 and cp = 0 as f_ar,
             hit and ((ci > 0 and vi = 0) or (cp > 0 and vp = 0)) as f_post,
             hit and ((vi > 0 and ci > 0 and vi <> ci) or (vp > 0 and cp > 0 and vp <> cp)) as f_mis
           from (select v.*, date '{AS_OF}' - v.dos as lb_days, c.row_no is not null as hit,
             c.insurance_payments as c_ins, c.patient_payments as c_pat,
             coalesce(c.insurance_payments, 0) as ci, coalesce(c.patient_payments, 0) as cp,
             coalesce(v.primary_paid, 0) as vi, coalesce(v.patient_paid, 0) as vp
             from fx_visits v left join g1 c on c.patient_id = v.patient_id and c.service_date = v.dos
             where v.visit_stage in {BILLING}) x""",
    ),
    "compared": (
        ("vl", "g1"),
        """select *, v_bill <> c_bill as d_bill, v_pat <> c_pat as d_pat, v_ins <> c_ins as d_ins, v_tot <> c_tot as d_tot,
             coalesce(nullif(concat_ws(' | ',
               case when v_bill <> c_bill then 'BILLED: visit=$' || v_bill || ' vs claim=$' || c_bill end,
               case when v_pat <> c_pat then 'PATIENT PAID: visit=$' || v_pat || ' vs claim=$' || c_pat end,
               case when v_ins <> c_ins then 'INSURANCE PAID: visit=$' || v_ins || ' vs claim=$' || c_ins end,
               case when v_tot <> c_tot then 'TOTAL PAID: visit=$' || v_tot || ' vs claim=$' || c_tot end), ''), 'None') as disc
           from (select v.patient_id, v.dos, v.payer, v.provider, v.referral_source, v.facility, v.visit_stage, c.row_no as c_row,
             cast(coalesce(v.last_billed, 0) as decimal(18,2)) as v_bill, cast(coalesce(v.patient_paid, 0) as decimal(18,2)) as v_pat,
             cast(coalesce(v.primary_paid, 0) as decimal(18,2)) as v_ins, cast(coalesce(v.total_paid, 0) as decimal(18,2)) as v_tot,
             case when c.row_no is not null then cast(coalesce(c.charges, 0) as decimal(18,2)) end as c_bill,
             case when c.row_no is not null then cast(coalesce(c.patient_payments, 0) as decimal(18,2)) end as c_pat,
             case when c.row_no is not null then cast(coalesce(c.insurance_payments, 0) as decimal(18,2)) end as c_ins,
             case when c.row_no is not null then cast(coalesce(c.patient_payments, 0) + coalesce(c.insurance_payments, 0) as decimal(18,2)) end as c_tot
             from vl v left join g1 c on c.patient_id = v.patient_id and c.service_date = v.dos) x""",
    ),
    "allrows": (
        ("fx_visits", "kclaims"),
        f"""select patient_id, dos as service_date, coalesce(last_billed, 0) as charges, coalesce(patient_paid, 0) as patient_payments,
             coalesce(primary_paid, 0) + coalesce(secondary_paid, 0) as insurance_payments, coalesce(total_paid, 0) as total_paid,
             facility, 'Visits' as source, 0 as rank, row_no from fx_visits
           union all select patient_id, service_date, coalesce(charges, 0), coalesce(patient_payments, 0), coalesce(insurance_payments, 0),
             coalesce(patient_payments, 0) + coalesce(insurance_payments, 0), {_OFFICE_FACILITY}, 'Claims', 1, row_no
           from kclaims where patient_id is not null""",
    ),
    "merged": (
        ("allrows",),
        """select * from allrows where service_date is not null
           qualify row_number() over (partition by patient_id, service_date order by total_paid desc, rank, row_no) = 1""",
    ),
    "comm": (
        ("fx_visits", "g1"),
        f"""select v.*, coalesce(v.last_billed, 0) as billed, c.row_no is not null as hit, c.insurance_payments as c_ins,
             c.adjustments as c_adj, c.patient_payments as c_pat, c.current_balance as c_bal
           from fx_visits v left join g1 c on c.patient_id = v.patient_id and c.service_date = v.dos
           where v.visit_stage in {BILLING} and v.visit_type ilike '%com%'""",
    ),
    "coll": (
        ("fx_visits", "g1"),
        f"""select v.*, case when v.total_paid > 0 then v.total_paid
               when c.row_no is not null then c.insurance_payments + c.patient_payments else 0 end as collected
           from fx_visits v left join g1 c on c.patient_id = v.patient_id and c.service_date = v.dos
           where v.visit_stage in {BILLING}""",
    ),
    "dep": (
        ("fx_deposits",),
        """select * from fx_deposits
           qualify row_number() over (partition by facility, txn_date, amount, memo order by row_no, cleared, account) = 1""",
    ),
    "kept": (
        ("dep",),
        "select * from dep where not coalesce(" + " or ".join(f"lower(memo) like '%{k}%'" for k in KEYWORDS) + ", false)",
    ),
    "plcells": (
        ("fx_pl_wide",),
        " union all ".join(
            f"select facility, yr, row_no, label, cast(yr as varchar) || '-{m}' as month, {c} as cell from fx_pl_wide" for c, m in PL_MONTHS.items()
        ),
    ),
    "pl": (
        ("plcells",),
        f"""select month, label as category, amount, facility, label in {quoted(PATIENT_CATEGORIES)} and type = 'Income' as is_patient_revenue, type
            from (select p.*, try_cast(replace(replace(trim(p.cell), '$', ''), ',', '') as decimal(18,2)) as amount,
                    case when p.row_no > e.row_no then 'Expense' when p.row_no > i.row_no then 'Income' end as type
                  from plcells p
                  left join (select facility, yr, row_no from fx_pl_wide where label = 'Income') i on i.facility = p.facility and i.yr = p.yr
                  left join (select facility, yr, row_no from fx_pl_wide where label = 'Expenses') e on e.facility = p.facility and e.yr = p.yr
                  where p.label not in ('Income', 'Expenses', 'Net Income') and p.label not like 'Total %') x
            where type is not null and coalesce(amount, 0) <> 0""",
    ),
    "keylines": (
        ("plcells",),
        f"""select facility, label as line_item, month,
              coalesce(try_cast(replace(replace(trim(cell), '$', ''), ',', '') as decimal(18,2)), 0) as amount
            from plcells where label in ('Total for Income', 'Total for Expenses', 'Net Income', 'Contract labor')""",
    ),
    "nd": (
        ("fx_claims", "fx_patients"),
        """select c.*, coalesce(cast(e.id as varchar), case when d.n is not null then 'CLOSE_MATCH' else 'UNMATCHED' end) as match_id,
             case when e.id is null then coalesce(d.n, 0) else 0 end as candidates, upper(regexp_replace(trim(c.patient_name), '\\s+', ' ', 'g')) as nn
           from fx_claims c
           left join (select upper(trim(split_part(patient_name, ',', 2)) || ' ' || trim(split_part(patient_name, ',', 1))) as nn, dob,
                        max(patient_id) as id from fx_patients group by 1, 2) e
             on e.nn = upper(regexp_replace(trim(c.patient_name), '\\s+', ' ', 'g')) and e.dob = c.dob
           left join (select dob, count(*) as n from fx_patients group by dob) d on d.dob = c.dob""",
    ),
    "decided": (
        ("nd", "fx_decisions"),
        """select nd.* replace (case when nd.match_id = 'CLOSE_MATCH' then coalesce(f.decision, nd.match_id) else nd.match_id end as match_id)
           from nd left join fx_decisions f on f.name_norm = nd.nn and f.dob = nd.dob""",
    ),
    "listing": (
        ("fx_manifest",),
        "select file_name, prefix, max(modified) as modified, max(size) as size from fx_manifest group by 1, 2",
    ),
    "log": (
        ("listing",),
        """select file_name as table_name, prefix as source_id, modified - interval 1 day as modified, modified - interval 1 day as loaded_at
           from listing where size % 3 <> 0
           union all select file_name, prefix, cast(modified as timestamp), cast(modified as timestamp)
           from listing where size % 3 <> 0 and size % 2 = 0""",
    ),
    "gaps": (
        ("fx_visits",),
        """select * replace (
             case when row_no % 29 <> 0 then patient_id end as patient_id, cast(date_trunc('month', dos) as date) as dos,
             case when row_no % 31 = 0 then 'Lost' when row_no % 37 <> 0 then visit_stage end as visit_stage,
             case when row_no % 41 = 0 then -total_paid else total_paid end as total_paid) from fx_visits""",
    ),
    "master": (
        ("fx_patients",),
        """select cast(patient_id as varchar) as master_id, 'customer ' || substr(patient_name, 1, 10) as patient_name,
             cast(dob as varchar) as date_of_birth from fx_patients where patient_id % 2 = 0""",
    ),
    "batch": (
        ("fx_claims",),
        """select cast(row_no as varchar) as master_id, trim(patient_name) as patient_name, cast(dob as varchar) as date_of_birth, row_no
           from fx_claims where row_no % 11 <> 0 and row_no % 17 <> 0""",
    ),
    "unb": (
        ("fx_visits",),
        f"select * from fx_visits where {month('dos')} = '{MONTH}' and visit_stage in {BILLING} and last_billed is null",
    ),
}


def oracle(reads: str, select: str) -> str:
    """The select with every step and table it needs in front, in order."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name in needed:
            return
        if name in STEPS:
            for other in STEPS[name][0]:
                add(other)
        needed.append(name)

    for name in reads.split():
        add(name)
    ctes = [f"{n} as ({STEPS[n][1] if n in STEPS else VIEWS[n].strip()})" for n in needed]
    return "with " + ",\n".join(ctes) + "\n" + select


ORACLES: dict[str, str] = {}


def put(name: str, reads: str, select: str) -> None:
    ORACLES[name] = oracle(reads, select)


V = "fx_visits"

# --- sources ---
def with_breaks(column: str, when: str = "true") -> str:
    """The column with line breaks in the rows that the registered query writes so."""
    return f"case when row_no % 7 = 0 and {when} then 'first, \"line\"' || chr(10) || chr(9) || 'and' || chr(10) || {column} else {column} end as {column}"


put("read_visits", V, f"""select patient_id_text as patient_id, patient_name, {text_date('dos')} as dos, visit_stage, provider, visit_type, facility,
  payer_type, payer, {with_breaks('referral_source', 'year(dos) >= 1998')}, {', '.join(f'{dbl(c)} as {c}' for c in ('last_billed', 'primary_allowed', 'primary_not_allowed',
  'primary_paid', 'secondary_paid', 'patient_paid', 'total_paid', 'written_off', 'current_balance'))}
  from (select *, cast(patient_id as varchar) as patient_id_text from fx_visits) v""")
_NUM = "try_cast(trim(replace(replace(money_text, '$', ''), ',', '')) as decimal(18,2))"
put("typed_currency", "fx_text", f"select row_no, {dbl(_NUM)} as amount from fx_text")
put("typed_dates", "fx_text",
    f"select row_no, cast(cast(try_strptime(trim(date_text), '%m/%d/%Y') as date) as varchar) as dos from fx_text")
_NUM0 = "coalesce(try_cast(trim(replace(replace(replace(replace(money_text, '$', ''), ',', ''), '(', ''), ')', '')) as decimal(18,2)), 0)"
put("typed_currency_zero", "fx_text",
    f"select row_no, {dbl(_NUM0)} as amount, {dbl(f'case when money_text like {chr(39)}(%){chr(39)} then -{_NUM0} else {_NUM0} end')} as signed from fx_text")
put("read_claims", "fx_claims", f"""select patient_name, {text_date('dob')} as dob, {text_date('service_date')} as service_date,
  {text_date('first_bill_date')} as first_bill_date, {with_breaks('office')}, {', '.join(f'coalesce({dbl(c)}, 0) as {c}' for c in ('charges', 'adjustments',
  'patient_payments', 'insurance_payments', 'current_balance'))} from fx_claims""")
put("read_deposits", "fx_deposits",
    f"select row_no, {text_date('txn_date')} as txn_date, {dbl('amount')} as amount, {with_breaks('memo', 'year(txn_date) % 2 = 0')}, cleared, account, facility from fx_deposits")
put("read_pl_long", "pl", f"select month, category, {dbl('amount')} as amount, facility, is_patient_revenue, type from pl")
put("pl_key_lines", "keylines", f"select facility, line_item, month, {dbl('amount')} as amount from keylines")
put("pl_cell_lookup", "plcells", f"""select facility, cast(replace(cell, '$', '') as double) as amount from plcells
  where label = 'Total for Income' and month = '{PL_MONTH}'""")
put("read_patients", "fx_patients",
    "select cast(patient_id as varchar) as master_id, patient_name, cast(dob as varchar) as date_of_birth from fx_patients")
put("changed_sources", "listing log", """select file_name as table_name, prefix as source_id, strftime(cast(modified as timestamp), '%Y-%m-%d %H:%M:%S') as modified
  from listing where not exists (select 1 from log where table_name = file_name and log.modified = listing.modified
    and loaded_at = (select max(loaded_at) from log l2 where l2.table_name = file_name))""")
put("refresh_table", V, f"select row_no, patient_id, {text_date('dos')} as dos, {dbl('total_paid')} as total_paid from fx_visits")
put("refresh_changed_files", V, f"""select cast(patient_id as varchar) as patient_id, {text_date('dos')} as dos, visit_stage, provider,
  {dbl('case when year(dos) = 1997 then total_paid + 1 else total_paid end')} as total_paid, cast(year(dos) as varchar) as yr from fx_visits""")
put("cache_status", "log", """select table_name, source_id, strftime(modified, '%Y-%m-%d %H:%M:%S') as modified, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') as loaded_at
  from log qualify row_number() over (partition by table_name order by loaded_at desc) = 1 order by table_name""")
put("latest_snapshot", "listing", """select prefix, file_name, cast(modified as varchar) as modified from listing
  qualify row_number() over (partition by prefix order by modified desc, file_name desc) = 1""")
_PREFIX = one_of({f"starts_with(file_name, '{p}')": f"'{p}'" for p in SNAPSHOT_PREFIXES})
put("snapshot_retention_plan", "listing", f"""select file_name, prefix, extension, stamp,
   case when rn = 1 and not (strptime(stamp, '%Y%m%d_%H%M%S') < timestamp '2001-12-17 00:00:00') then 'keep' else 'delete' end as action
  from (select *, row_number() over (partition by prefix, extension order by stamp desc, file_name desc) as rn
    from (select file_name, {_PREFIX} as prefix, regexp_extract(file_name, '(\\.[^.]*)$', 1) as extension,
      regexp_extract(file_name, '(\\d{{8}}_\\d{{6}})', 1) as stamp from listing) a where prefix is not null) b""")
put("register_sql", f"{V} fx_patients", f"""select facility, count(*) filter (where visit_stage in {BILLING}) as checked_in,
  {dbl('sum(total_paid)')} as collected, count(distinct v.patient_id) as patients
  from fx_visits v join fx_patients p using (patient_id) group by facility""")

# --- metrics ---
_MEASURES = f"""count(*) as n_rows, count(patient_id) as visits, {zsum('primary_allowed')} as billed, {zsum('total_paid')} as collected,
  {zsum('written_off')} as written_off"""


def grouped(dim: str, source: str = "fx_visits") -> str:
    return f"""(select {dim}, {_MEASURES}, (select count(*) from {source}) as all_rows, (select {zsum('total_paid')} from {source}) as all_collected
      from {source} where {dim} is not null group by {dim}) g"""


_RATE = f"{pct('collected', 'billed')} as collection_rate"
_AVG = f"{rnd(ratio('collected', 'visits'))} as avg_per_visit"
_SHARE_V = f"{pct('visits', 'all_rows')} as pct_of_visits"
_SHARE_R = f"{pct('collected', 'all_collected')} as pct_of_revenue"
_MONEY = f"{dbl('billed')} as billed, {dbl('collected')} as collected"
_PROVIDER = f"select provider, visits, {_MONEY}, {_RATE}, {_AVG}, {_SHARE_R}, {dbl('written_off')} as written_off from {grouped('provider')}"
_PAYER = f"select payer_type, visits, {_MONEY}, {_RATE}, {_AVG}, {_SHARE_V}, {_SHARE_R} from {grouped('payer_type')}"
_FACILITY = f"select facility, visits, {_MONEY}, {_RATE}, {_AVG}, {_SHARE_V} from {grouped('facility')}"


def summary(source: str) -> str:
    return f"""select n_rows as total_visits, unique_patients, {dbl('billed')} as total_billed, {dbl('collected')} as total_collected,
      coalesce({pct('collected', 'billed')}, 0) as collection_rate, coalesce({rnd(ratio('collected', 'n_rows'))}, 0) as avg_collection_per_visit,
      {dbl('written_off')} as total_written_off, {dbl('greatest(billed - collected - written_off, 0)')} as total_outstanding
      from (select {_MEASURES}, count(distinct patient_id) as unique_patients from {source}) s"""


put("executive_summary", V, summary("fx_visits"))
put("provider_performance", V, _PROVIDER)
put("insurance_analysis", V, _PAYER)
put("facility_comparison", V, _FACILITY)
put("top_providers", V, _PROVIDER + " order by collected desc, provider limit 5")
put("export_csv", V, _PROVIDER)
put("export_json", V, _FACILITY)


def stages(source: str) -> str:
    return f"select visit_stage, visits as n, {pct('visits', 'all_rows')} as pct_of_total, {_MONEY} from {grouped('visit_stage', source)}"


put("visit_stage_breakdown", "gaps", stages("gaps"))


def pipeline(source: str) -> str:
    steps = [
        ("billed", "b", False), ("insurance_allowed", "b", False), ("insurance_paid", "i", True), ("patient_responsible", "0", False),
        ("patient_paid", "p", True), ("written_off", "w", True), ("total_collected", "c", True),
        ("total_outstanding", "greatest(b - c - w, 0)", True),
    ]
    base = f"""(select {zsum('primary_allowed')} as b, {zsum('primary_paid')} as i, {zsum('patient_paid')} as p, {zsum('written_off')} as w,
      {zsum('total_paid')} as c from {source}) s"""
    return " union all ".join(
        f"select {big(str(k + 1))} as step, '{n}' as stage, {dbl(x)} as amount, {pct(x, 'b') if share else 'cast(null as double)'} as pct_of_billed from {base}"
        for k, (n, x, share) in enumerate(steps)
    )


put("collection_pipeline", V, pipeline("fx_visits"))


def flags(source: str, floor: float, ceiling: float) -> str:
    uncollected = "total_paid = 0 and primary_allowed > 0 and visit_stage not in ('Not Started','Patient Canceled','Center Canceled')"
    def low(dim: str, severity: str, kind: str) -> str:
        return f"""select '{severity}' as severity, '{kind}' as flag_type, {dim} as subject, visits as affected_records, rate, {dbl('collected')} as amount
          from (select *, {pct('collected', 'billed')} as rate from {grouped(dim, source)}) q where rate < {floor}"""
    return f"""{low('payer_type', 'medium', 'Low Insurance Collection Rate')}
      union all select 'high', 'Uncollected Claims with Balance', 'all', count(*), cast(null as double), {dbl('sum(primary_allowed)')}
        from {source} where {uncollected} having count(*) > 0
      union all select 'medium', 'High Write-off Percentage', 'all', cast(null as bigint), {pct('w', 'b')}, {dbl('w')}
        from (select sum(written_off) as w, sum(primary_allowed) as b from {source}) s where {ratio('w', 'b', ' * 100.0')} > {ceiling}
      union all {low('provider', 'low', 'Provider Below Collection Threshold')}"""


put("red_flags", V, flags("fx_visits", 55.0, 2.0))


def report(source: str, providers: int | None, tag: str) -> str:
    top = " order by collected desc, provider limit " + str(providers) if providers else ""
    provider = _PROVIDER.replace("fx_visits", source)
    payer, facility = _PAYER.replace("fx_visits", source), _FACILITY.replace("fx_visits", source)
    group = ("visits", "billed", "collected", "collection_rate", "avg_per_visit")
    sections = [
        ("executive_summary", "'all'", summary(source), ("total_visits", "unique_patients", "total_billed", "total_collected",
         "collection_rate", "avg_collection_per_visit", "total_written_off", "total_outstanding")),
        ("collection_pipeline", "stage", pipeline(source), ("amount", "pct_of_billed")),
        ("provider_performance", "provider", provider + top, (*group, "pct_of_revenue", "written_off")),
        ("facility_comparison", "facility", facility, (*group, "pct_of_visits")),
        ("insurance_analysis", "payer_type", payer, (*group, "pct_of_visits", "pct_of_revenue")),
        ("visit_stage_breakdown", "visit_stage", stages(source), ("n", "pct_of_total", "billed", "collected")),
        ("red_flags", "severity || ': ' || flag_type || ': ' || subject", flags(source, 70.0, 15.0), ("affected_records", "rate", "amount")),
    ]
    parts = []
    for section, key, text, measures in sections:
        for m in measures:
            parts.append(f"select '{section}' as section, {key} as key, '{m}' as measure, {dbl(m)} as value, '{tag}' as date_range from ({text}) t where {m} is not null")
    return " union all ".join(parts)


STEPS["in_range"] = (("fx_visits",), "select * from fx_visits where dos between date '1997-01-01' and date '1998-12-31'")
put("all_metrics", V, report("fx_visits", None, "all"))
put("report_table", "in_range", report("in_range", 5, "1997-01-01 to 1998-12-31"))
put("export_metrics_bundle", V, f"""select section, key, measure, value from ({report("fx_visits", None, "all")}) r
  where section <> 'collection_pipeline'""")
put("save_result_sets", "fx_visits unb", f"""select 'needs_attention' as result, '20010901_000000' as run_ts, patient_id, {text_date('dos')} as dos, provider, facility
    from fx_visits where visit_stage = 'Review' and date '{AS_OF}' - dos > 14
  union all select 'unbilled', '20010901_000000', patient_id, {text_date('dos')}, provider, facility from unb""")

# --- filters ---
put("filter_date_range", V, f"""select row_no, patient_id, {text_date('dos')} as dos, {dbl('total_paid')} as total_paid from fx_visits
  where dos between date '1996-02-01' and date '1997-02-28'""")
put("filter_month", V, f"select row_no, patient_id, {text_date('dos')} as dos from fx_visits where {month('dos')} = '{MONTH}'")
put("stage_class", V, f"""select row_no, visit_stage, case when visit_stage in {BILLING} then 'billing'
  when visit_stage in {OPERATIONAL} then 'operational' else 'other' end as stage_class from fx_visits""")
put("facility_normalized", V, f"select row_no, {_FACILITY_OF} as facility_normalized from fx_visits")
put("facility_from_office", "fx_claims", f"select row_no, office, {_OFFICE_FACILITY} as facility from fx_claims")
put("claims_facility_filter", "fx_claims",
    f"select row_no, office, {dbl('charges')} as charges from fx_claims where office in {quoted(INCLUDED_OFFICES)}")
put("commercial_filter", V, f"""select row_no, visit_type, visit_stage from fx_visits
  where visit_type ilike '%com%' and visit_stage in {BILLING}""")
put("days_since_service", V, f"select row_no, {text_date('dos')} as dos, {big(f'date {chr(39)}{AS_OF}{chr(39)} - dos')} as days_since_dos from fx_visits")
_UP = "upper(trim(coalesce(name_text, '')))"
put("name_normalized", "fx_text", f"""select row_no, u as name_upper, trim(regexp_replace(u, '\\s+', ' ', 'g')) as name_collapsed,
   case when strpos(u, ',') > 0 then trim(trim(substr(u, strpos(u, ',') + 1)) || ' ' || trim(substr(u, 1, strpos(u, ',') - 1))) else u end as name_flipped,
   case when len(t) >= 2 then t[1] || ' ' || t[-1] end as first_last
  from (select row_no, {_UP} as u, regexp_split_to_array({_UP}, '\\s+') as t from fx_text) x""")
put("dob_normalized", "fx_text", """select row_no, case when t like '%/%/%' then
    cast(cast(split_part(t, '/', 1) as int) as varchar) || '/' || cast(cast(split_part(t, '/', 2) as int) as varchar) || '/' || split_part(t, '/', 3) else t end as dob
  from (select row_no, trim(coalesce(date_text, '')) as t from fx_text) x""")
put("allowed_identity_check", V, f"""select row_no, {dbl('last_billed')} as last_billed, {dbl('primary_allowed')} as primary_allowed, {dbl('na')} as primary_not_allowed
  from (select *, primary_not_allowed + case when row_no % 23 = 0 then 0.01 else 0 end as na from fx_visits) v where primary_allowed + na <> last_billed""")
put("head_sample", V, f"select row_no, patient_id, {text_date('dos')} as dos, visit_stage from fx_visits order by row_no limit 5")
put("table_info", "fx_patients", f"""select {big('position')} as position, column_name, data_type, (select count(*) from fx_patients) as row_count, {big('3')} as column_count
  from (values (1, 'patient_id', 'bigint'), (2, 'patient_name', 'string'), (3, 'dob', 'date')) t(position, column_name, data_type)""")

# --- validation ---
put("check_columns", V, """select column_name, severity, (select count(*) from fx_visits) as n_rows
  from (values ('provider', 'error'), ('payer', 'warning'), ('referral_source', 'warning')) t(column_name, severity)""")
_ANY = "coalesce(cast(try_strptime(trim(date_text), '%m/%d/%Y') as date), cast(try_strptime(trim(date_text), '%Y-%m-%d') as date))"
put("profile_dates", "fx_text", f"""select count(*) as total_records, count(*) filter (where date_text is null or date_text = '') as null_dates,
   count(*) filter (where d is null and date_text <> '') as invalid_dates, count(*) filter (where d > date '2000-06-30') as future_dates,
   cast(min(d) as varchar) as min_date, cast(max(d) as varchar) as max_date from (select date_text, {_ANY} as d from fx_text) t""")
put("profile_ids", "gaps", f"""select {big('sum(n)')} as total_records, {big('sum(n) filter (where patient_id is null)')} as null_ids,
   count(distinct patient_id) as unique_patients, {big('coalesce(sum(n) filter (where n > 1), 0)')} as duplicate_visits
  from (select patient_id, dos, count(*) as n from gaps group by 1, 2) g""")
_PROFILED = ("primary_allowed", "total_paid", "patient_paid", "primary_paid", "written_off", "last_billed")
put("profile_numeric", "gaps", " union all ".join(f"""select '{c}' as column_name, count(*) filter (where {c} is null) as null_count,
   count(*) filter (where {c} < 0) as negative_count, count(*) filter (where {c} = 0) as zero_count, {dbl(f'min({c})')} as min_value,
   {dbl(f'max({c})')} as max_value, {dbl(f'sum({c})')} as sum_value from gaps""" for c in _PROFILED))
_STATUS = f"case when visit_stage is null then 'null' when visit_stage in {quoted(VALID_STAGES)} then 'valid' else 'unknown' end"
put("profile_stages", "gaps", f"select visit_stage as stage, count(*) as n, {_STATUS} as status from gaps group by 1")


def broken(source: str, as_of: str) -> list[tuple[str, str, str, str]]:
    return [
        ("Total Paid exceeds Primary Allowed", "warning", "Records where payment exceeds allowed amount", "total_paid > primary_allowed and primary_allowed > 0"),
        ("Closed visits with $0 billed", "warning", "Closed visits that have no billing amount", "visit_stage = 'Closed' and primary_allowed = 0"),
        ("Open visits older than 90 days", "high", "Open visits that may need follow-up", f"visit_stage = 'Open' and date '{as_of}' - dos > 90"),
    ]


put("business_rule_violations", V, " union all ".join(
    f"select '{r}' as rule, count(*) as n, '{s}' as severity, '{t}' as description from fx_visits where {w} having count(*) > 0"
    for r, s, t, w in broken("fx_visits", AS_OF)))


def check(name: str, field: str, measure: str, value: str, bad: str | None) -> str:
    level = f"case when {value} > 0 then '{bad}' else 'info' end" if bad else "'info'"
    return f"select '{name}' as check_name, '{field}' as field, '{measure}' as measure, {dbl(value)} as value, {level} as severity from gaps"


_CHECKS = " union all ".join([
    "select 'columns' as check_name, 'referral_source' as field, 'missing' as measure, cast(1 as double) as value, 'warning' as severity",
    check("dates", "dos", "total_records", "count(*)", None),
    check("dates", "dos", "null_dates", "count(*) filter (where dos is null)", "error"),
    check("dates", "dos", "invalid_dates", "count(*) filter (where false)", "error"),
    check("dates", "dos", "future_dates", "count(*) filter (where dos > date '2000-06-30')", "warning"),
    *[check("numeric", c, "negative_count", f"count(*) filter (where {c} < 0)", "warning") for c in _PROFILED],
    *[check("rules", r, "violations", f"count(*) filter (where {w})", "error" if s == "high" else "warning") for r, s, _, w in broken("gaps", "2000-06-30")],
    check("ids", "patient_id", "null_ids", "count(*) filter (where patient_id is null)", "error"),
    check("ids", "patient_id", "unique_patients", "count(distinct patient_id)", None),
    f"""select 'ids', 'patient_id', 'duplicate_visits', {dbl('coalesce(sum(n), 0)')}, case when sum(n) > 0 then 'warning' else 'info' end
        from (select count(*) as n from gaps group by patient_id, dos having count(*) > 1) d""",
    f"""select 'stages', coalesce(visit_stage, ''), {_STATUS} || '_count', {dbl('count(*)')},
        case when {_STATUS} = 'valid' then 'info' else 'warning' end from gaps group by visit_stage""",
])
STEPS["checks"] = (("gaps",), _CHECKS)
put("validation_summary", "checks", """select * from checks union all select 'overall', 'table', 'is_valid',
  case when count(*) filter (where severity = 'error') = 0 then 1.0 else 0.0 end, case when count(*) filter (where severity = 'error') = 0 then 'info' else 'error' end from checks""")
_STAT = "select '{c}' as column_name, count(*) as total_rows, count(*) - count({c}) as null_count, {rest} from fx_visits"
_STAT_NUM = ("count({c}) as n, cast(min({c}) as double) as min_value, cast(max({c}) as double) as max_value, "
             + rnd("cast(sum({c}) as double) / count({c})") + " as mean, " + rnd("stddev_samp(cast({c} as double))") + " as std, "
             + ", ".join(rnd(f"quantile_cont(cast({{c}} as double), {q})") + f" as p{int(q * 100)}" for q in (0.25, 0.5, 0.75)))
_STAT_TEXT = "cast(null as bigint) as n, " + ", ".join(f"cast(null as double) as {x}" for x in ("min_value", "max_value", "mean", "std", "p25", "p50", "p75"))
put("summary_stats", V, " union all ".join(
    [_STAT.format(c=c, rest=_STAT_TEXT) for c in ("patient_name", "dos", "visit_stage", "provider", "facility", "payer_type", "payer",
                                                 "referral_source", "visit_type")]
    + [_STAT.format(c=c, rest=_STAT_NUM.replace("{c}", c)) for c in ("row_no", "patient_id", "last_billed", "primary_allowed", "primary_not_allowed",
       "primary_paid", "secondary_paid", "patient_paid", "total_paid", "written_off", "current_balance")]))

# --- metrics by stage, facility, month ---
put("overview_kpis", V, f"""select count(*) as total_visits, {dbl(zsum('last_billed'))} as total_charged, {dbl(zsum('total_paid'))} as total_collected,
   {dbl(zsum('current_balance'))} as total_balance, coalesce({pct('sum(total_paid) filter (where primary_allowed > 0)', 'sum(primary_allowed) filter (where primary_allowed > 0)')}, 0) as collection_rate
  from fx_visits where visit_stage in {BILLING}""")
put("zero_allowed_visits", V, f"""select payer_type, count(*) as visits, {dbl(zsum('total_paid'))} as paid, {dbl(zsum('last_billed'))} as charges
  from fx_visits where primary_allowed = 0 and payer_type is not null group by payer_type""")
put("facility_amounts_long", V, " union all ".join(
    f"select facility, '{m}' as metric, {dbl(zsum(c))} as amount from fx_visits where visit_stage in {BILLING} and facility is not null group by facility"
    for m, c in (("Charged", "last_billed"), ("Collected", "total_paid"), ("Outstanding", "current_balance"))))
put("billing_stage_counts", V, f"select visit_stage, count(*) as n from fx_visits where visit_stage in {BILLING} group by 1")
put("operational_rates", V, f"""select facility, scheduled, no_show, canceled, {pct('no_show', 'scheduled')} as no_show_rate, {pct('canceled', 'scheduled')} as cancellation_rate
  from (select facility, count(*) as scheduled, count(*) filter (where visit_stage = 'No Show') as no_show,
    count(*) filter (where visit_stage in {CANCELED}) as canceled from fx_visits group by 1) s""")
_IN = f"visit_stage in {BILLING}"
_UNB = f"{_IN} and coalesce(last_billed, 0) = 0"
put("visit_monthly_summary", V, f"""select {month('dos')} as month, facility, min(strftime(dos, '%B %Y')) as month_label, count(*) filter (where {_IN}) as checked_in,
   count(*) filter (where {_UNB}) as unbilled, count(*) filter (where visit_stage in {CANCELED}) as cancelled, count(*) filter (where visit_stage = 'No Show') as no_show,
   {dbl(f'round({zsum("last_billed", _IN)}, 0)')} as gross_charges, {dbl(f'round({zsum("total_paid")}, 0)')} as collected,
   {dbl(f'round({zsum("primary_allowed", _IN)}, 0)')} as primary_allowed from fx_visits group by 1, 2""")
_PAID_MORE = zsum("total_paid + case when year(dos) = 1997 then 1 else 0 end")
ORACLES["monthly_after_change"] = ORACLES["visit_monthly_summary"].replace(zsum("total_paid"), _PAID_MORE)
_PERIOD = f"""count(*) filter (where {_IN}) as checked_in, count(*) filter (where {_UNB}) as unbilled, {dbl(zsum('last_billed', _IN))} as billed, {dbl(zsum('total_paid'))} as collected"""
put("visits_by_period", V, f"select {month('dos')} as month, {_PERIOD} from fx_visits where facility = '{FACILITY}' group by 1")
_LINES = {"pl_revenue": "Total for Income", "pl_expenses": "Total for Expenses", "net_income": "Net Income"}
STEPS["metric_rows"] = (("fx_visits", "keylines"), " union all ".join(
    [f"select facility, month, '{m}' as metric, cast({m} as decimal(28,2)) as amount from (select facility, {month('dos')} as month, {_PERIOD} from fx_visits group by 1, 2) p"
     for m in ("checked_in", "unbilled", "billed", "collected")]
    + [f"select facility, month, '{m}' as metric, cast(amount as decimal(28,2)) as amount from keylines where line_item = '{line}'" for m, line in _LINES.items()]))
_PIVOT = ", ".join(f"cast(coalesce(sum(amount) filter (where month = '{m}'), 0) as double) as \"{m}\"" for m in ALL_MONTHS)
put("facility_month_pivot", "metric_rows", f"select metric, {_PIVOT} from metric_rows where facility = '{FACILITY}' group by metric")
put("combined_month_pivot", "metric_rows", f"""select facility, metric, {_PIVOT} from (select * from metric_rows
   union all select 'COMBINED', month, metric, amount from metric_rows) r group by 1, 2""")
put("pl_month_table", "keylines", "select facility, month, " + ", ".join(
    f"{dbl(zsum('amount', f'line_item = {chr(39)}{line}{chr(39)}'))} as {n}" for n, line in (
        ("revenue", "Total for Income"), ("expenses", "Total for Expenses"), ("net_income", "Net Income"), ("contract_labor", "Contract labor"))) + " from keylines group by 1, 2")
put("month_drilldown", V, f"""select scheduled, checked_in, cancelled, no_show, scheduled - checked_in - cancelled - no_show as unaccounted, never_billed,
   {pct('never_billed', 'checked_in', 1)} as never_billed_pct from (select count(*) as scheduled, count(*) filter (where {_IN}) as checked_in,
     count(*) filter (where visit_stage in {CANCELED}) as cancelled, count(*) filter (where visit_stage = 'No Show') as no_show,
     count(*) filter (where {_IN} and last_billed is null) as never_billed from fx_visits where {month('dos')} = '{MONTH}') s""")
put("other_stage_counts", V, f"""select visit_stage, count(*) as n from fx_visits where {month('dos')} = '{MONTH}'
   and visit_stage not in {BILLING} and visit_stage not in {CANCELED} and visit_stage <> 'No Show' group by 1""")
_BILLED = f"""count(*) filter (where last_billed > 0) as billed_count, {dbl(zsum('last_billed', 'last_billed > 0'))} as billed_total,
   {dbl(zsum('primary_allowed'))} as allowed, {dbl(zsum('total_paid'))} as paid, {dbl(zsum('primary_paid'))} as insurance_paid, {dbl(zsum('patient_paid'))} as patient_paid,
   coalesce({rnd('cast(sum(last_billed) filter (where last_billed > 0) as double) / nullif(count(*) filter (where last_billed > 0), 0)')}, 0) as billed_avg"""
_MONTH_IN = f"from fx_visits where {_IN} and {month('dos')} = '{MONTH}'"
put("billing_summary_by", V, " union all ".join(
    f"select '{d}' as dimension, {d} as value, {_BILLED} {_MONTH_IN} group by {d}" for d in ("provider", "payer")))
put("billing_totals", V, f"select {_BILLED} {_MONTH_IN}")

# --- identity ---
_NEW = """select master_id, patient_name, date_of_birth from (select *, row_number() over (partition by patient_name, date_of_birth order by row_no) as rn from batch) b
  where rn = 1 and not exists (select 1 from master m where m.patient_name = b.patient_name and m.date_of_birth = b.date_of_birth)"""
put("patients_upsert", "master batch", f"select * from master union all {_NEW}")
put("patients_upsert_stats", "master batch", f"""select new_patients, batch_rows - keys as duplicates_in_batch, keys - new_patients as already_known, m + new_patients as total_patients
  from (select (select count(*) from ({_NEW}) n) as new_patients, (select count(*) from batch) as batch_rows,
    (select count(*) from (select distinct patient_name, date_of_birth from batch) d) as keys, (select count(*) from master) as m) s""")
_FLIP = "upper(trim(split_part(patient_name, ',', 2)) || ' ' || trim(split_part(patient_name, ',', 1)))"
put("patients_from_visits", "fx_patients fx_visits", f"""select {_FLIP} as name_norm, patient_id from fx_patients where patient_id % 3 = 0
  union all select name_norm, id from (select {_FLIP} as name_norm, patient_id * 10 + row_no % 10 as id,
     row_number() over (partition by patient_name order by row_no) as rn from fx_visits) v
   where rn = 1 and name_norm not in (select {_FLIP} from fx_patients where patient_id % 3 = 0)""")
put("claims_patient_match", "kclaims", "select row_no, patient_id, match_level from kclaims")
put("name_dob_match", "nd", f"select row_no, match_id, {big('candidates')} as candidate_count from nd")
put("close_match_candidates", "nd fx_patients", f"""select {text_date('dob')} as dob, {_FLIP} as candidate_name, patient_name, patient_id from fx_patients
  where dob in (select dob from nd where match_id = 'CLOSE_MATCH')""")
put("apply_match_decisions", "decided", "select row_no, match_id from decided")
put("match_stats", "decided", f"""select *, {pct('matched', 'total', 1)} as match_rate from (select count(*) as total,
   count(*) filter (where match_id not in ('UNMATCHED', 'CLOSE_MATCH')) as matched, count(*) filter (where match_id = 'CLOSE_MATCH') as close_matches,
   count(*) filter (where match_id = 'UNMATCHED') as unmatched from decided) s""")
_FOLLOW = "match_id in ('UNMATCHED', 'CLOSE_MATCH')"
put("unmatched_patients", "nd", f"""select patient_name, {text_date('dob')} as dob, min(row_no) as first_row, count(*) as n_rows from nd where {_FOLLOW} group by patient_name, nd.dob""")
put("id_to_name", "fx_patients", f"select patient_id, {_FLIP} as patient_name from fx_patients")
put("deid_split", "nd", f"select row_no, match_id, {_FOLLOW} as needs_follow_up from nd")
put("deid_counts", "nd", f"""select count(*) as total_records, count(*) filter (where not {_FOLLOW}) as matched_records, count(*) filter (where {_FOLLOW}) as follow_up_records from nd""")
put("deid_follow_up", "nd", f"select row_no, patient_name, {text_date('dob')} as dob, match_id from nd where {_FOLLOW}")
put("deidentify", "nd", f"""select match_id as "Patient Account Number", row_no as "Claim Number", {text_date('service_date')} as "Service Date", {dbl('charges')} as "Charges" from nd""")
put("phi_leak_check", "fx_claims", """select 'patient name column' as problem, 'Patient Name (First Last)' as column_name, count(patient_name) as n_rows from fx_claims
  union all select 'birth date column', 'Patient Birth Date', count(dob) from fx_claims
  union all select 'id column missing', 'Patient Account Number', count(*) from fx_claims""")

# --- record-level reconciliation ---
put("claims_last_by_key", "g1", f"select patient_id, {text_date('service_date')} as dos, row_no, {dbl('charges')} as charges, office from g1")
put("operational_summary", V, f"""select visit_stage, n, {pct('n', '(sum(n) over ())', 1)} as pct_of_operational
  from (select visit_stage, count(patient_id) as n from fx_visits where visit_stage in {OPERATIONAL} group by 1) s""")
put("needs_attention", V, f"""select row_no, patient_id, {text_date('dos')} as dos, {big(f'date {chr(39)}{AS_OF}{chr(39)} - dos')} as days_since_dos, provider, facility,
  coalesce({dbl('last_billed')}, 0) as last_billed from fx_visits where visit_stage = 'Review' and date '{AS_OF}' - dos > 14""")
put("outstanding_ar", "flagged", f"""select row_no, patient_id, {text_date('dos')} as dos, {big('lb_days')} as days_since_dos, provider, facility, payer,
  coalesce({dbl('last_billed')}, 0) as last_billed, case when hit then 'Yes' else 'No' end as claim_match from flagged where f_ar""")
_PAYCOLS = f"""row_no, patient_id, {text_date('dos')} as dos, visit_stage, provider, facility, {dbl('last_billed')} as last_billed, {dbl('primary_paid')} as primary_paid,
  {dbl('c_ins')} as claim_insurance_payments, {dbl('patient_paid')} as patient_paid, {dbl('c_pat')} as claim_patient_payments"""
put("needs_posting", "flagged", f"select {_PAYCOLS} from flagged where f_post")
put("mismatched_payments", "flagged", f"""select {_PAYCOLS}, {dbl('primary_paid - c_ins')} as insurance_diff, {dbl('patient_paid - c_pat')} as patient_diff from flagged where f_mis""")
_OVER = [
    ("records", "visits", "count(*)", "fx_visits"), ("records", "billing_visits", f"count(*) filter (where {_IN})", "fx_visits"),
    ("records", "operational_visits", f"count(*) filter (where visit_stage in {OPERATIONAL})", "fx_visits"), ("records", "claims", "count(*)", "fx_claims"),
    ("needs_attention", "n", "count(*) filter (where f_attn)", "flagged"), ("needs_attention", "amount_on_hold", zsum("last_billed", "f_attn"), "flagged"),
    ("needs_attention", "oldest_days", "max(lb_days) filter (where f_attn)", "flagged"),
    ("outstanding_ar", "n", "count(*) filter (where f_ar)", "flagged"), ("outstanding_ar", "amount_at_risk", zsum("last_billed", "f_ar"), "flagged"),
    ("outstanding_ar", "oldest_days", "max(lb_days) filter (where f_ar)", "flagged"), ("outstanding_ar", "without_claim", "count(*) filter (where f_ar and not hit)", "flagged"),
    ("needs_posting", "n", "count(*) filter (where f_post)", "flagged"), ("needs_posting", "insurance_to_post", zsum("c_ins", "f_post"), "flagged"),
    ("needs_posting", "patient_to_post", zsum("c_pat", "f_post"), "flagged"),
    ("mismatched", "n", "count(*) filter (where f_mis)", "flagged"), ("mismatched", "insurance_discrepancy", zsum("abs(vi - ci)", "f_mis"), "flagged"),
    ("mismatched", "patient_discrepancy", zsum("abs(vp - cp)", "f_mis"), "flagged"),
]
put("reconciliation_overview", "flagged fx_claims", " union all ".join(
    f"select '{s}' as section, '{m}' as measure, {dbl(x)} as value from {t}" for s, m, x, t in _OVER))
put("match_status", "vl g1 kclaims", f"""select coalesce(v.patient_id, c.patient_id) as patient_id, {text_date('coalesce(v.dos, c.service_date)')} as dos, v.row_no as visit_row, c.row_no as claim_row,
   case when c.row_no is null then 'visits_only' when v.row_no is null then 'claims_only' else 'matched' end as status
  from vl v full outer join g1 c on c.patient_id = v.patient_id and c.service_date = v.dos
  union all select patient_id, {text_date('service_date')}, null, row_no, 'claims_only' from kclaims where patient_id is null""")
_YN = ", ".join(f"case when {d} then 'NO' else 'YES' end as {n}_match" for n, d in (("billed", "d_bill"), ("patient", "d_pat"), ("insurance", "d_ins"), ("total", "d_tot")))
_AMTS = ", ".join(f"{dbl(a)} as {b}" for a, b in (("v_bill", "visit_billed"), ("v_pat", "visit_patient_paid"), ("v_ins", "visit_insurance_paid"), ("v_tot", "visit_total_paid")))
_CAMTS = ", ".join(f"{dbl(a)} as {b}" for a, b in (("c_bill", "claim_charges"), ("c_pat", "claim_patient_paid"), ("c_ins", "claim_insurance_paid"), ("c_tot", "claim_total_paid")))
_KEY = f"patient_id, {text_date('dos')} as dos"
put("compare_matched", "compared", f"""select {_KEY}, payer, provider, referral_source, facility, {_AMTS}, {_CAMTS}, {_YN}, disc as discrepancies from compared where c_row is not null""")
put("comparison_stats", "compared fx_visits fx_claims", f"""select *, matched - records_with_discrepancies as perfect_matches, {pct('matched', 'claims_total', 1)} as matched_pct_of_claims,
   {pct('(matched - records_with_discrepancies)', 'matched', 1)} as match_quality from (select (select count(*) from fx_visits) as visits_total, (select count(*) from fx_claims) as claims_total,
   count(*) as matched, {', '.join(f'count(*) filter (where {d}) as {n}_mismatches' for n, d in (('billed', 'd_bill'), ('patient', 'd_pat'), ('insurance', 'd_ins'), ('total', 'd_tot')))},
   {big('sum(d_bill::int + d_pat::int + d_ins::int + d_tot::int)')} as field_discrepancies, count(*) filter (where disc <> 'None') as records_with_discrepancies from compared where c_row is not null) s""")
put("visits_only", "compared", f"""select {_KEY}, payer, provider, referral_source, facility, visit_stage, {_AMTS}, '{VISITS_ONLY_NOTE}' as note from compared where c_row is null""")
_CO = f"""{text_date('c.service_date')} as dos, c.row_no, {dbl('c.charges')} as charges, {dbl('c.insurance_payments')} as insurance_payments, {dbl('c.patient_payments')} as patient_payments,
   {dbl('c.current_balance')} as current_balance, '{CLAIMS_ONLY_NOTE}' as note"""
put("claims_only", "vl g1 kclaims", f"""select c.patient_id, {_CO} from g1 c where not exists (select 1 from vl v where v.patient_id = c.patient_id and v.dos = c.service_date)
  union all select c.patient_id, {_CO} from kclaims c where c.patient_id is null""")
put("expected_match_by_stage", "compared", """select visit_stage, count(*) as n, case visit_stage when 'Closed' then 'concern' when 'Open' then 'possible' else 'expected' end as outcome
  from compared where c_row is null group by 1""")
_HIT = "c_row is not null"
_MASTER = f"""select {_KEY}, payer as case_primary_insurance, case when {_HIT} then 'Both' else 'Visits Only' end as source,
   case when {_HIT} then 'Matched' else 'Unmatched in Claims' end as match_status, provider, referral_source, facility, {_AMTS}, {_CAMTS},
   {', '.join(f"case when {_HIT} then case when {d} then 'NO' else 'YES' end end as {n}_match" for n, d in (('billed', 'd_bill'), ('patient', 'd_pat'), ('insurance', 'd_ins'), ('total', 'd_tot')))},
   case when c_row is null then visit_stage end as visit_stage, case when {_HIT} then disc end as discrepancies, case when c_row is null then '{VISITS_ONLY_NOTE}' end as note from compared"""
put("billing_master", "compared", _MASTER)
put("billing_master_summary", "compared", f"""select 'source' as grouping, source as value, count(*) as n from ({_MASTER}) m group by source
  union all select 'match_status', match_status, count(*) from ({_MASTER}) m group by match_status
  union all select 'discrepancies', 'matched records', count(*) filter (where discrepancies <> 'None') from ({_MASTER}) m""")
put("combined_dedup", "merged", f"""select patient_id, {text_date('service_date')} as service_date, {dbl('charges')} as charges, {dbl('patient_payments')} as patient_payments,
  {dbl('insurance_payments')} as insurance_payments, {dbl('total_paid')} as total_paid, facility, source from merged""")
put("combined_stats", "merged allrows kclaims fx_visits", """select (select count(*) from fx_visits) as visit_records, (select count(*) from kclaims) as claim_records,
   (select count(patient_id) from kclaims) as claims_matched, (select count(*) from kclaims where patient_id is null) as claims_unmatched,
   (select count(*) from allrows) as combined_records, (select count(*) from allrows) - count(*) as duplicates_removed, count(*) as final_records,
   count(*) filter (where source = 'Visits') as final_from_visits, count(*) filter (where source = 'Claims') as final_from_claims from merged""")
put("combined_monthly", "merged", f"""select {month('service_date')} as month, facility, {dbl('sum(charges)')} as charges, {dbl('sum(patient_payments)')} as patient_paid,
  {dbl('sum(insurance_payments)')} as insurance_paid, {dbl('sum(total_paid)')} as total_paid, count(patient_id) as visit_count from merged where facility is not null group by 1, 2""")
put("commercial_detail", "comm fx_patients", f"""select c.row_no, c.patient_id, coalesce(p.nm, 'Unknown') as patient_name, {text_date('c.dos')} as dos, visit_stage, visit_type, payer_type, payer, facility,
   {dbl('billed')} as last_billed, {dbl('primary_paid')} as primary_paid, {dbl('c_ins')} as claim_insurance_payments, {dbl('c_adj')} as claim_adjustments, {dbl('patient_paid')} as patient_paid,
   {dbl('c_pat')} as claim_patient_payments, {dbl('current_balance')} as current_balance, {dbl('c_bal')} as claim_current_balance, case when hit then 'Yes' else 'No' end as claim_match
  from comm c left join (select patient_id, {_FLIP} as nm from fx_patients where patient_id % 4 <> 0) p on p.patient_id = c.patient_id""")
_COMM = f"""count(*) as visits, count(*) filter (where hit) as matched, {dbl(zsum('billed'))} as charges, {dbl(zsum('c_ins'))} as claim_insurance,
   {dbl(zsum('c_pat'))} as claim_patient, {dbl(zsum('c_bal'))} as claim_balance"""
put("commercial_overview", "comm", f"""select {_COMM}, count(*) filter (where not hit) as unmatched, {dbl(zsum('billed', 'hit'))} as matched_charges, {dbl(zsum('billed', 'not hit'))} as unmatched_charges,
   {dbl(zsum('c_adj'))} as claim_adjustments, {dbl(f"{zsum('billed', 'hit')} - {zsum('c_adj')} - {zsum('c_ins')} - {zsum('c_pat')}")} as balance_check from comm""")


def roll(label: str, dims: tuple[str, ...]) -> str:
    cols = ", ".join((f"cast({d} as varchar)" if d in dims else "cast(null as varchar)") + f" as {d}" for d in ("facility", "payer", "visit_stage", "patient_id"))
    return f"select '{label}' as rollup, {cols}, {_COMM} from comm group by {', '.join('comm.' + d for d in dims)}"


put("commercial_rollups", "comm", " union all ".join([
    roll("facility", ("facility",)), roll("payer", ("payer",)), roll("visit_stage", ("visit_stage",)), roll("patient_id", ("patient_id",)),
    roll("facility x visit_stage", ("facility", "visit_stage"))]))
put("top_payers", "comm", f"""select payer, {dbl('charges')} as charges, {dbl('bal')} as claim_balance, visits, case when bal > 0 then 'Balance Remaining' else 'Fully Resolved' end as balance_flag
  from (select payer, sum(billed) as charges, {zsum('c_bal')} as bal, count(*) as visits from comm group by payer) p order by p.charges desc, payer limit 10""")
put("patient_history", "fx_visits g1 fx_patients", f"""select v.row_no, v.patient_id, (select {_FLIP} from fx_patients where patient_id = {PATIENT}) as patient_name, payer, {text_date('v.dos')} as dos, visit_stage, provider, facility,
   {dbl('last_billed')} as last_billed, {dbl('primary_paid')} as primary_paid, {dbl('patient_paid')} as patient_paid, {dbl('total_paid')} as total_paid,
   {dbl('c.insurance_payments')} as claim_insurance_payments, {dbl('c.patient_payments')} as claim_patient_payments, {text_date('c.first_bill_date')} as claim_first_bill_date,
   {big('case when c.first_bill_date >= v.dos then c.first_bill_date - v.dos end')} as days_to_first_bill
  from fx_visits v left join g1 c on c.patient_id = v.patient_id and c.service_date = v.dos where v.patient_id = {PATIENT}""")
put("patient_header", V, f"""select patient_id, (select payer from fx_visits b where b.patient_id = a.patient_id order by dos, row_no limit 1) as payer,
   (select facility from fx_visits b where b.patient_id = a.patient_id group by facility order by count(*) desc, facility limit 1) as facility,
   count(*) as visits, {dbl(zsum('last_billed'))} as total_billed, {dbl(zsum('total_paid'))} as total_paid from fx_visits a group by patient_id""")
put("unbilled_visits", "unb", f"select {_KEY}, visit_stage, provider, facility from unb")
_SEEN = "exists (select 1 from fx_visits t where t.row_no % 2 = 0 and t.patient_id = u.patient_id and t.dos = u.dos)"
put("append_new_unbilled", "unb fx_visits", f"""select '{AS_OF}' as run_date, strftime(dos, '%B %Y') as month_label, {_KEY}, visit_stage, provider, facility from unb u where not {_SEEN}""")
_TRACKED = f"strftime(dos, '%B %Y') as month_label, {_KEY}, visit_stage, provider, facility from"
_MISSING = "not exists (select 1 from fx_visits t where t.row_no % 2 = 0 and year(t.dos) = 1997 and t.patient_id = u.patient_id and t.dos = u.dos)"
put("unbilled_tracker", V, f"""select '2001-08-01' as run_date, {_TRACKED} fx_visits where row_no % 2 = 0 and year(dos) = 1997
  union all select case {month('dos')} when '{MONTH}' then '{AS_OF}' else '2001-10-01' end, {_TRACKED} fx_visits u
  where {month('dos')} in ('{MONTH}', '1997-07') and visit_stage in {BILLING} and last_billed is null and {_MISSING}""")
put("unbilled_append_counts", "unb fx_visits", f"select count(*) filter (where not {_SEEN}) as added, count(*) filter (where {_SEEN}) as skipped from unb u")

# --- ledger ---
_DEP = f"facility, {text_date('txn_date')} as txn_date, {dbl('amount')} as amount, memo, row_no, cleared, account"
put("deposits_clean", "dep", f"select {_DEP} from dep")
put("deposits_dedup", "dep", f"select {_DEP} from dep")
put("patient_deposits", "kept", f"select {_DEP} from kept")
put("deposits_by_facility", "dep", f"select {_DEP} from dep where facility = '{FACILITY}'")
_DSTAT = f"count(*) as n, {dbl(zsum('amount'))} as total, {text_date('min(txn_date)')} as first_date, {text_date('max(txn_date)')} as last_date from dep"
put("deposit_stats", "dep", f"select facility, {_DSTAT} group by facility union all select 'ALL', {_DSTAT}")
_OUT = "coalesce(" + " or ".join(f"lower(memo) like '%{k}%'" for k in KEYWORDS) + ", false)"
put("excluded_deposit_stats", "dep", f"""select count(*) filter (where {_OUT}) as excluded, {dbl(zsum('amount', _OUT))} as excluded_amount,
  count(*) filter (where not {_OUT}) as kept, {dbl(zsum('amount', f'not {_OUT}'))} as kept_amount from dep""")


def by_region(key: str, alias: str, source: str) -> str:
    cols = ", ".join(f"{dbl(zsum('amount', f'facility = {chr(39)}{r}{chr(39)}'))} as \"{r}\"" for r in KNOWN_REGIONS)
    rest = dbl(zsum("amount", f"facility is null or facility not in {quoted(KNOWN_REGIONS)}"))
    return f"select {key} as {alias}, {cols}, {rest} as other, {dbl(zsum('amount'))} as total from {source} group by 1"


put("deposits_daily", "dep", by_region("cast(txn_date as varchar)", "date", "dep"))
put("deposits_monthly", "dep", by_region(month("txn_date"), "month", "dep"))
_PLS = f"""{dbl(zsum('amount', "type = 'Income'"))} as total_income, {dbl(zsum('amount', "type = 'Expense'"))} as total_expense, {dbl(zsum('amount', 'is_patient_revenue'))} as patient_revenue,
  {dbl(zsum('amount', "type = 'Income' and not is_patient_revenue"))} as non_patient_revenue, string_agg(distinct month, '|' order by month) as months,
  string_agg(distinct category, '|' order by category) as categories from pl"""
put("pl_stats", "pl", f"select facility, {_PLS} group by facility union all select 'ALL', {_PLS}")
put("pl_monthly_revenue", "pl", by_region("month", "month", "(select * from pl where is_patient_revenue) q"))
put("pl_monthly_expenses", "pl", by_region("month", "month", "(select * from pl where type = 'Expense') q"))
put("pl_by_category", "pl", f"select category, {dbl('sum(amount)')} as amount from pl where type = 'Income' group by 1")


def recon(visits: str, ledger: str, flag_pct: float, without: float, count: bool) -> str:
    diff = "(la - vc)"
    share = f"coalesce({ratio(diff, 'vc', ' * 100.0')}, case when la <> 0 then {without} else 0.0 end)"
    return f"""select month, facility, {dbl('vc')} as visits_collected, {dbl('vp')} as visits_patient_paid, {dbl('vi')} as visits_insurance_paid, n as visit_count, {dbl('la')} as ledger_amount,
       {'ln as ledger_count,' if count else ''} {dbl(diff)} as discrepancy, {rnd(share)} as discrepancy_pct,
       case when abs({share}) > {flag_pct} or abs({diff}) > 500 then 'REVIEW' else 'OK' end as flag
      from (select coalesce(v.month, l.month) as month, coalesce(v.facility, l.facility) as facility, coalesce(vc, 0) as vc, coalesce(vp, 0) as vp, coalesce(vi, 0) as vi,
          coalesce(n, 0) as n, coalesce(la, 0) as la, coalesce(ln, 0) as ln
        from ({visits}) v full outer join ({ledger}) l on v.month = l.month and v.facility = l.facility) x"""


_RV = f"""select {month('dos')} as month, {_FACILITY_OF} as facility, sum(total_paid) as vc, sum(patient_paid) as vp, sum(primary_paid) as vi, count(patient_id) as n from fx_visits group by 1, 2"""
_RC = f"""select {month('service_date')} as month, {_FACILITY_OF} as facility, sum(total_paid) as vc, sum(patient_payments) as vp, sum(insurance_payments) as vi, count(patient_id) as n from merged group by 1, 2"""
_RD = f"select {month('txn_date')} as month, facility, sum(amount) as la, count(*) as ln from kept group by 1, 2"
_RP = "select month, facility, sum(amount) as la, count(*) as ln from pl where is_patient_revenue group by 1, 2"
_R1, _R4 = recon(_RV, _RD, 5, 0.0, True), recon(_RC, _RP, 10, 100.0, False)
put("recon_deposits_monthly", "fx_visits kept", _R1)
put("recon_pl_monthly", "merged pl", _R4)


def totals(visits: str, ledger: str) -> str:
    def both(text: str, cols: str) -> str:
        return f"(select facility, {cols} from ({text}) a group by facility union all select 'ALL', {cols} from ({text}) a)"
    return f"""select facility, {dbl('vc')} as visits_collected, {dbl('vp')} as visits_patient_paid, {dbl('vi')} as visits_insurance_paid, {dbl('la')} as ledger_amount, {dbl('la - vc')} as discrepancy,
      coalesce({pct('(la - vc)', 'vc')}, 0) as discrepancy_pct from (select coalesce(v.facility, l.facility) as facility, coalesce(vc, 0) as vc, coalesce(vp, 0) as vp, coalesce(vi, 0) as vi, coalesce(la, 0) as la
      from {both(visits, 'sum(vc) as vc, sum(vp) as vp, sum(vi) as vi')} v full outer join {both(ledger, 'sum(la) as la')} l on v.facility = l.facility) x"""


put("recon_deposits_totals", "fx_visits kept", totals(_RV, _RD))
put("recon_pl_totals", "merged pl", totals(_RC, _RP))


def recon_flags(text: str, high: float, up: tuple[str, ...], down: tuple[str, ...]) -> str:
    return f"""select month, facility, visits_collected, ledger_amount, discrepancy, discrepancy_pct, case when abs(discrepancy) > {high} then 'HIGH' else 'MEDIUM' end as severity,
      case when ledger_amount > visits_collected then 'ledger > visits' else 'visits > ledger' end as direction,
      case when ledger_amount > visits_collected then '{' | '.join(up)}' else '{' | '.join(down)}' end as possible_causes from ({text}) r where flag = 'REVIEW'"""


put("recon_deposits_flags", "fx_visits kept", recon_flags(_R1, 2000, DEPOSIT_CAUSES_LEDGER_HIGH, DEPOSIT_CAUSES_VISITS_HIGH))
put("recon_pl_flags", "merged pl", recon_flags(_R4, 5000, PL_CAUSES_LEDGER_HIGH, PL_CAUSES_VISITS_HIGH))

# --- dashboard ---
put("monthly_collections", "coll", f"""select {month('dos')} as month, {dbl(zsum('last_billed'))} as total_charges, {dbl(zsum('collected'))} as total_collected,
   {dbl(zsum('last_billed', "visit_stage = 'Open'"))} as total_ar, count(*) as visit_count, count(*) filter (where visit_stage = 'Open') as open_count,
   count(*) filter (where visit_stage = 'Closed') as closed_count, count(*) filter (where visit_stage = 'Review') as review_count,
   coalesce({pct('sum(total_paid) filter (where primary_allowed > 0)', 'sum(primary_allowed) filter (where primary_allowed > 0)')}, 0) as collection_rate from coll group by 1""")
put("collections_by_provider", "coll", f"""select provider, {dbl(zsum('last_billed'))} as charges, {dbl(zsum('collected'))} as collected from coll where {month('dos')} = '{MONTH}' group by 1""")
put("ar_aging", "flagged", " union all ".join(
    f"select '{label}' as bucket, count(*) as visits, {dbl(zsum('last_billed'))} as amount from flagged where f_ar and lb_days >= {lo}" + (f" and lb_days <= {hi}" if hi else "")
    for label, lo, hi in AGE_BUCKETS))
put("available_months", "pl fx_visits", f"select month from pl union select {month('dos')} from fx_visits")
_INC, _EXP = zsum("amount", "type = 'Income'"), zsum("amount", "type = 'Expense'")
put("pl_month_summary", "pl", f"select {dbl(_INC)} as income, {dbl(_EXP)} as expenses, {dbl(f'{_INC} - {_EXP}')} as net from pl where month = '{PL_MONTH}'")
put("pl_month_categories", "pl", f"select type, category, {dbl('sum(amount)')} as amount from pl where month = '{PL_MONTH}' group by 1, 2")
put("pl_month_facility_net", "pl", f"select facility, {dbl(_INC)} as revenue, {dbl(_EXP)} as expenses, {dbl(f'{_INC} - {_EXP}')} as net from pl where month = '{PL_MONTH}' group by 1")
put("ehr_vs_ledger_gap", "coll pl", f"""select coalesce(c.month, l.month) as month, {dbl('coalesce(e, 0)')} as ehr_collected, {dbl('coalesce(i, 0)')} as ledger_income, {dbl('coalesce(e, 0) - coalesce(i, 0)')} as gap
  from (select {month('dos')} as month, sum(collected) as e from coll group by 1) c full outer join (select month, sum(amount) as i from pl where type = 'Income' group by 1) l on l.month = c.month""")
_AR = f"from fx_visits where visit_stage = 'Open' and {month('dos')} = '{MONTH}'"
put("ar_detail_month", V, f"""select row_no, {_KEY}, visit_stage, provider, facility, payer_type, payer, referral_source, visit_type, {', '.join(f'{dbl(c)} as {c}' for c in ('last_billed', 'primary_allowed',
  'primary_not_allowed', 'primary_paid', 'secondary_paid', 'patient_paid', 'total_paid', 'written_off', 'current_balance'))} {_AR}""")
put("ar_detail_totals", V, f"select count(*) as open_visits, {dbl(zsum('last_billed'))} as total_ar {_AR}")
