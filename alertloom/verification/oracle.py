"""SQL the registered queries are compared with, over the same tables.

Every statement starts from the derived `alerts` and `triage` of `derived.py` and reads as the question it
answers. Where it can be put in another way than in the Spark code, it is: chains from pairs, baselines and
medians joined back, distinct values as a table of their own, weekdays from a calendar, bands and
maintenance windows as tables, forest trees grown level by level.
"""

from __future__ import annotations

import math

from alertloom import schemas as S
from alertloom.anomaly.evaluate import BASELINES, METHODS
from alertloom.anomaly.forest import PRIME, TERMS
from alertloom.functions.exprs import tactic_column
from alertloom.reports import PREVIEW_ROWS, REPORTS
from alertloom.verification.derived import DAYS, PLANTED_LEVEL, PLANTED_RULE

_LISTED = ", ".join(f"'{t}'" for t in S.FEATURE_TACTICS)
_TACTICS = ", ".join(f"'{t}'" for t in S.TACTICS)

BASE = f"""
with ev as (
    select *, cast(json_extract_string(props, '$.k') as int) as k,
           cast(floor(value * 37) as int) as wait
    from events
),
alerts as (
    select cast(event_id as varchar) as alert_id,
           ts,
           event_type as rule_id,
           cast(least(15, 3 + floor(value / 16)) as int) as level,
           'rule ' || event_type as rule_description,
           case when k % 13 < 8 then 'T' || (1000 + k % 50) end as mitre_technique,
           case when k % 13 < 8 then ([{_LISTED}])[k % 13 + 1] end as mitre_tactic,
           'host-' || cast(k % 12 as varchar) as agent,
           case when k % 5 = 0 then null
                when k % 2 = 0 then '10.10.0.' || cast(k as varchar)
                else '185.220.0.' || cast(k as varchar) end as src_ip,
           'u' || cast(user_id as varchar) as src_user,
           case when event_id % 4 = 0 then 't' || (event_id % 9) end as dst_user,
           '/var/log/' || event_type || '-' || (k % 3) as location
    from ev
),
triage as (
    select cast(event_id as varchar) as alert_id,
           ts + to_seconds(wait) as opened_at,
           ts + to_seconds(wait + (event_id % 40) * 30) as closed_at,
           'an-' || cast(event_id % 4 as varchar) as analyst,
           case when user_id % (case when event_type = 'view' then 50 else 10 end) = 0 then 'true_positive'
                when user_id % 10 < 4 then 'benign' else 'false_positive' end as disposition,
           user_id % (case when event_type = 'view' then 50 else 10 end) = 0
               and cast(least(15, 3 + floor(value / 16)) as int) >= 9 as escalated
    from ev
    where event_id % 3 <> 0
),
planted as (
    select alert_id from alerts where level >= {PLANTED_LEVEL} and rule_id = '{PLANTED_RULE}'
)"""

# Model features come from these counts of a host-hour.
_BREADTH = [
    "alerts", "distinct_rules", "distinct_users", "distinct_src_ips", "external_ips", "high_sev_alerts",
    "distinct_tactics",
]
_COUNTS = [*_BREADTH, *[tactic_column(t) for t in S.FEATURE_TACTICS]]
_MODEL = [f"{c}_excess" for c in _COUNTS] + ["max_level", "avg_level"]
_SHOWN = ["alerts", "distinct_rules", "distinct_tactics", "distinct_users", "external_ips"]

_OF_TACTIC = ",\n           ".join(
    f"count(*) filter (where mitre_tactic = '{t}') as {tactic_column(t)}" for t in S.FEATURE_TACTICS
)
_WINDOWS = ", ".join(f"({day}, {first}, {last})" for day, first, last in S.MAINTENANCE_WINDOWS)

# What was seen in a host-hour is a table of its distinct values, counted by kind.
FEATURES = f"""{BASE},
hours as (select *, date_trunc('hour', ts) as hour from alerts),
seen as (
    select distinct agent, hour, 'rule' as kind, rule_id as value from hours where rule_id is not null
    union all
    select distinct agent, hour, 'user', src_user from hours where src_user is not null
    union all
    select distinct agent, hour, 'address', src_ip from hours where src_ip is not null
    union all
    select distinct agent, hour, 'tactic', mitre_tactic from hours where mitre_tactic is not null
),
breadth as (
    select agent, hour,
           count(*) filter (where kind = 'rule') as distinct_rules,
           count(*) filter (where kind = 'user') as distinct_users,
           count(*) filter (where kind = 'address') as distinct_src_ips,
           count(*) filter (where kind = 'address' and value not like '10.%') as external_ips,
           count(*) filter (where kind = 'tactic') as distinct_tactics
    from seen group by agent, hour
),
volume as (
    select agent, hour, count(*) as alerts, max(level) as max_level, avg(level) as avg_level,
           count(*) filter (where level >= 10) as high_sev_alerts,
           {_OF_TACTIC}
    from hours group by agent, hour
),
patching (weekday, opens, closes) as (values {_WINDOWS}),
features as (
    select v.*, coalesce(b.distinct_rules, 0) as distinct_rules, coalesce(b.distinct_users, 0) as distinct_users,
           coalesce(b.distinct_src_ips, 0) as distinct_src_ips, coalesce(b.external_ips, 0) as external_ips,
           coalesce(b.distinct_tactics, 0) as distinct_tactics,
           cast(extract(hour from v.hour) as int) as hour_of_day, isodow(v.hour) as weekday,
           cast(p.weekday is not null as int) as maintenance_window
    from volume v
    left join breadth b on b.agent is not distinct from v.agent and b.hour is not distinct from v.hour
    left join patching p on p.weekday = isodow(v.hour) and extract(hour from v.hour) between p.opens and p.closes
)"""

# Medians per host and kind of hour, joined back; then the same for the distances from them.
_MEDIANS = ", ".join(f"median({c}) as mid_{c}" for c in _COUNTS)
_DISTANCES = ", ".join(f"{c} - mid_{c} as off_{c}" for c in _COUNTS)
_SPREADS = ", ".join(f"median(abs(off_{c})) as mad_{c}" for c in _COUNTS)
_EXCESS = ",\n           ".join(
    f"round(ln(1 + greatest(off_{c} / (case mad_{c} when 0 then 1 else mad_{c} end), 0)), 9) as {c}_excess"
    for c in _COUNTS
)
_SAME = "x.agent is not distinct from y.agent and x.maintenance_window = y.maintenance_window"

EXCESS = f"""{FEATURES},
normal as (select agent, maintenance_window, {_MEDIANS} from features group by agent, maintenance_window),
away as (select x.*, {_DISTANCES} from features x join normal y on {_SAME}),
spread as (select agent, maintenance_window, {_SPREADS} from away group by agent, maintenance_window),
parts as (
    select x.agent, x.hour, x.max_level, x.avg_level, {", ".join("x." + c for c in _SHOWN)},
           {_EXCESS}
    from away x join spread y on {_SAME}
),
excess as (select *, round({" + ".join(f"{c}_excess" for c in _COUNTS)}, 9) as excess_score from parts)"""

TRUTH = """
truth as (
    select distinct agent, date_trunc('hour', ts) as hour from alerts where alert_id in (select alert_id from planted)
)"""

_KNOWN = "exists (select 1 from truth t where t.agent is not distinct from e.agent and t.hour = e.hour)"

RANKED = f"""{EXCESS},
{TRUTH},
ranked as (
    select e.*,
           row_number() over (order by excess_score desc, agent nulls last, hour) as heur_rank,
           row_number() over (order by alerts desc, agent nulls last, hour) as volume_rank,
           {_KNOWN} as is_malicious
    from excess e
)"""


def forest(trees: int = 300, sample: int = 256, seed: int = 42) -> str:
    """The isolation forest: every tree is grown level by level, then every row walks down all trees.

    Assumes at least `sample` rows, which sets the height. A node is known by its place: the root is 1, the
    children of p are 2p and 2p + 1.
    """
    height = math.ceil(math.log2(sample))
    terms = ", ".join(f"('0x' || substr(h, {1 + 8 * i}, 8))::bigint % {PRIME} as x{i}" for i in range(TERMS))
    ticket = "0"
    for i in range(TERMS):
        ticket = f"(({ticket}) * t + x{i}) % {PRIME}"
    grown = [
        f"""
tickets as (
    select r, t, key, {ticket} as ticket
    from (select *, {terms} from points), (select unnest(range({trees})) as t)
),
level0 as (
    select t, r, 1 as place from tickets
    qualify row_number() over (partition by t order by ticket, key) <= {sample}
)"""
    ]
    for i in range(height):
        grown.append(
            f"""
splits{i} as (
    select t, place, picked.f as f, picked.low + share * (picked.high - picked.low) as cut
    from (
        select t, place, options[1 + choice % len(options)] as picked, share
        from (
            select t, place, list(struct_pack(f := f, low := low, high := high) order by f) as options,
                   ('0x' || substr(md5('{seed}|' || t || '|' || place), 1, 8))::bigint as choice,
                   ('0x' || substr(md5('{seed}|' || t || '|' || place), 9, 8))::bigint / 4294967296.0::double as share
            from (
                select t, place, f, min(xs[f]) as low, max(xs[f]) as high
                from level{i} join points using (r), (select unnest(range(1, {len(_MODEL) + 1})) as f)
                group by t, place, f having min(xs[f]) < max(xs[f])
            )
            group by t, place
        )
    )
),
level{i + 1} as (
    select t, r, 2 * place + (xs[f] > cut)::int as place from level{i} join splits{i} using (t, place) join points using (r)
)"""
        )
    sizes = " union all ".join(f"select t, place, count(*) as n from level{i} group by t, place" for i in range(height + 1))
    walks = ["walk0 as (select r, t, 1 as place from points, (select unnest(range(%d)) as t))" % trees]
    for i in range(height):
        walks.append(
            f"""walk{i + 1} as (
    select w.r, w.t, case when s.f is null then w.place else 2 * w.place + (xs[s.f] > s.cut)::int end as place
    from walk{i} w join points using (r) left join splits{i} s on s.t = w.t and s.place = w.place
)"""
        )
    path = "case when {n} > 2 then 2 * (ln({n} - 1) + 0.5772156649015329) - 2 * ({n} - 1) / {n}::double when {n} = 2 then 1 else 0 end"
    return f"""points as materialized (
    select row_number() over () as r, agent, hour, [{", ".join(f"{c}::double" for c in _MODEL)}] as xs,
           coalesce(agent, '<null>') || '|' || hour::varchar as key,
           md5('{seed}|' || coalesce(agent, '<null>') || '|' || hour::varchar) as h
    from excess
),{",".join(grown)},
sizes as ({sizes}),
{", ".join(walks)},
scores as (
    select r, round(pow(2, -avg(floor(log2(place)) + {path.format(n="coalesce(n, 0)")}) / ({path.format(n=sample)})), 9) as anomaly_score
    from walk{height} left join sizes using (t, place) group by r
),
scored as (
    select e.*, anomaly_score
    from excess e join points p on p.agent is not distinct from e.agent and p.hour = e.hour join scores using (r)
)"""


SCORED = f"{EXCESS},\n{forest()}"

COMBINED = f"""{SCORED},
{TRUTH},
three as (
    select e.*, {_KNOWN} as is_malicious,
           row_number() over (order by anomaly_score desc, agent nulls last, hour) as if_rank,
           row_number() over (order by excess_score desc, agent nulls last, hour) as heur_rank,
           row_number() over (order by alerts desc, agent nulls last, hour) as volume_rank
    from scored e
),
ranked as (
    select *, least(if_rank, heur_rank) as combined_rank,
           row_number() over (order by least(if_rank, heur_rank), anomaly_score desc, agent nulls last, hour)
               as combined_position
    from three
)"""


def _precision(ranked: str, methods: dict[str, str]) -> str:
    long = " union all ".join(f"select '{m}' as method, {rank} as r, is_malicious from ranked" for m, rank in methods.items())
    return f"""{ranked},
long as ({long}),
ks as (select unnest([10, 25, 50, 100]) as k),
known as (select count(*) as n from ranked where is_malicious)
select method, k, count(*) filter (where is_malicious and r <= k) as hits,
       hits::double / k as precision, hits::double / nullif((select n from known), 0) as recall
from long, ks group by method, k"""


def _incident_ranks(ranked: str, methods: dict[str, str]) -> str:
    return f"""{ranked},
incidents as (select 'first_on_' || agent as incident, agent, min(hour) as hour from truth group by agent)
select i.incident, i.agent, i.hour, {", ".join(f"r.{rank} as {m}" for m, rank in methods.items())}
from incidents i left join ranked r on r.agent is not distinct from i.agent and r.hour = i.hour"""


def _top(ranked: str, rank: str, score: str) -> str:
    return f"""{ranked}
select {rank} as rank, agent, strftime(hour, '%Y-%m-%d %H:00') as hour, alerts,
       distinct_rules as rules, distinct_tactics as tactics, distinct_users as users, external_ips,
       max_level, round({score}, 3) as score, is_malicious
from ranked where {rank} <= 15"""


def _importance(ranked: str, rank: str) -> str:
    long = " union all ".join(f"select '{f}' as feature, {rank} as r, {f}::double as x from ranked" for f in _MODEL)
    return f"""{ranked},
long as ({long}),
moved as (
    select feature, abs((avg(x) filter (where r <= 25) - avg(x)) / nullif(stddev_samp(x), 0)) as z
    from long group by feature
)
select feature, round(z, 1) as abs_z from moved order by z desc nulls last, feature limit 6"""


def _histogram(ranked: str, score: str) -> str:
    return f"""{ranked},
edges as (
    select is_malicious, min({score}) as lo, max({score}) as hi, case when is_malicious then 40 else 80 end as bins
    from ranked group by is_malicious
),
binned as (
    select e.is_malicious, least(floor((r.{score} - e.lo) / (e.hi - e.lo) * e.bins)::int, e.bins - 1) as bin,
           count(*) as n
    from ranked r join edges e using (is_malicious) group by 1, 2
),
grid as (select *, unnest(range(0, bins))::int as bin from edges)
select g.is_malicious, g.bin, round(lo + g.bin * ((hi - lo) / bins), 6) as bin_start,
       round(lo + (g.bin + 1) * ((hi - lo) / bins), 6) as bin_end, coalesce(c.n, 0) as host_hours
from grid g left join binned c using (is_malicious, bin)"""


def _chains(tail: str) -> str:
    return f"""{BASE},
severe as (
    select row_number() over () as n, * from alerts where level >= 8 and mitre_tactic is not null
),
pairs as (
    select a.n as opening, b.n as following from severe a join severe b using (agent)
    where b.ts - a.ts between interval 0 hours and interval 2 hours
    union
    select a.n, b.n from severe a join severe b using (src_user)
    where b.ts - a.ts between interval 0 hours and interval 2 hours
),
chains as (
    select a.alert_id, a.agent as first_host, a.src_user, a.ts as window_start,
           max(b.ts) as window_end,
           list_sort(list(distinct b.mitre_tactic)) as tactics,
           count(distinct b.agent) as hosts_in_window
    from pairs p join severe a on a.n = p.opening join severe b on b.n = p.following
    group by all
)
select first_host, src_user, window_start, window_end, len(tactics) as tactics_in_window,
       hosts_in_window, array_to_string(tactics, ' | ') as tactics_seen
from chains where len(tactics) >= 3 {tail}"""


def _bursts(tail: str) -> str:
    return f"""{BASE},
per_hour as (
    select rule_id, agent, date_trunc('hour', ts) as hour, count(*) as alerts from alerts group by all
),
normal as (
    select rule_id, agent, avg(alerts) as usual, stddev_samp(alerts) as spread
    from per_hour group by all having stddev_samp(alerts) > 0
),
texts as (select rule_id, min(rule_description) as rule_description from alerts group by all)
select h.hour, h.rule_id, x.rule_description, h.agent, h.alerts,
       round(n.usual, 1) as usual_per_hour, round((h.alerts - n.usual) / n.spread, 1) as z_score
from per_hour h
join normal n on n.rule_id is not distinct from h.rule_id and n.agent is not distinct from h.agent
left join texts x on x.rule_id = h.rule_id
where h.alerts - n.usual > 5 * n.spread {tail}"""


# Triage rows per alert id, and what each alert contributes to a left join with triage.
JOINED = f"""{BASE},
seen as (
    select alert_id, count(*) as n, count(*) filter (where disposition = 'true_positive') as tp,
           count(*) filter (where disposition = 'false_positive') as fp
    from triage where alert_id is not null group by all
),
per_alert as (
    select a.*, coalesce(s.n, 0) as n, coalesce(s.tp, 0) as tp, coalesce(s.fp, 0) as fp,
           greatest(coalesce(s.n, 0), 1) as joined
    from alerts a left join seen s on s.alert_id = a.alert_id
)"""


def _noisy(min_alerts: int) -> str:
    """The recommendation is the first row of a table whose thresholds hold."""
    return f"""{JOINED},
rates as (
    select rule_id, nullif(cast(sum(n) as bigint), 0) as triaged, sum(tp) as tp, sum(fp) as fp
    from per_alert group by all
),
verdicts (place, above, least, below, recommendation) as (
    values (1, {min_alerts}, 0.0, 0.03, '{S.TUNE}'), (2, -1, 0.5, 2.0, '{S.KEEP}')
),
measured as (
    select row_number() over () as m, v.*, r.triaged, r.tp, r.fp, r.tp / r.triaged as share
    from (select rule_id, rule_description, level, count(*) as alerts from alerts group by all) v
    left join rates r on r.rule_id = v.rule_id
),
advised as (
    select m, arg_min(recommendation, place) as recommendation
    from measured join verdicts on alerts > above and share >= least and share < below group by m
),
report as (
    select rule_id, rule_description, level, alerts,
           round(100.0 * alerts / (select count(*) from alerts), 1) as pct_of_all_alerts, triaged,
           round(100.0 * tp / triaged, 1) as tp_rate_pct, round(100.0 * fp / triaged, 1) as fp_rate_pct,
           coalesce(recommendation, '{S.REVIEW}') as recommendation
    from measured left join advised using (m)
)"""


def _tune(min_alerts: int) -> str:
    return f"""{JOINED},
tune as (
    select rule_id
    from (select rule_id, sum(joined) as volume, sum(n) as n, sum(tp) as tp from per_alert group by all)
    where volume > {min_alerts} and n > 0 and tp / n < 0.03
)"""


# Lowest and highest level of each severity.
_LEVELS = "levels (severity, lowest, highest) as (values ('low', 0, 6), ('medium', 7, 9), ('high', 10, 11), ('critical', 12, 15))"

_DAILY = f"""{BASE},
{_LEVELS},
banded as (select ts::date as day, severity from alerts left join levels on level between lowest and highest)
select day, {", ".join(f"count(*) filter (where severity = '{x}') as {x}" for x in ("low", "medium", "high", "critical"))},
       count(*) as total
from banded group by day"""

# The days on record with their weekdays, and each alert's day and hour.
_CALENDAR = f"""{BASE},
fired as (select ts::date as day, extract(hour from ts)::int as hour from alerts),
calendar as (select distinct day, dayname(day) as weekday, isodow(day) as dow_num from fired),
cells as (select weekday, dow_num, hour, count(*) as alerts from fired join calendar using (day) group by all)"""

_GRID = ", ".join(f"sum(alerts) filter (where hour = {h})::bigint as h{h:02d}" for h in range(24))


# Rules and hosts of an address are rows of their own, each with its number of alerts, counted by kind.
_OUTSIDE = "src_ip is not null and left(src_ip, 3) <> '10.'"
_SOME_DAYS = f" and ts::date between '{DAYS[0].date()}' and '{DAYS[1].date()}'"
_SOURCES = f"""{BASE},
met as (
    select src_ip, 'rule' as kind, rule_id as value, ts, level from alerts where {_OUTSIDE}
    union all
    select src_ip, 'host', agent, ts, level from alerts where {_OUTSIDE}
),
values_met as (
    select src_ip, kind, value, count(*) as n, min(ts) as earliest, max(ts) as latest, max(level) as highest
    from met group by all
),
sources as (
    select src_ip, cast(sum(n) filter (kind = 'rule') as bigint) as alerts,
           count(value) filter (kind = 'rule') as distinct_rules, count(value) filter (kind = 'host') as hosts_touched,
           min(earliest) as first_seen, max(latest) as last_seen, max(highest) as max_level
    from values_met group by src_ip
)"""


_OTHER_DAYS = f"ts::date not between '{DAYS[0].date()}' and '{DAYS[1].date()}'"

# Some alerts taken up by two analysts, and some rows twice.
_AGAIN = f"""{BASE},
again as (
    select * from triage
    union all select * from triage where cast(alert_id as bigint) % 11 = 0
    union all
    select alert_id, opened_at + interval 1 hour, closed_at + interval 2 hour, 'an-9', 'benign', false
    from triage where cast(alert_id as bigint) % 7 = 0
)"""


def statements(min_alerts: int) -> dict[str, str]:
    found = _statements(min_alerts)
    counts = [
        f"""select '{r.number}' as number, '{r.name}' as report, count(*) as rows,
       (select count(*)::int from (describe {found[r.name]})) as columns from ({found[r.name]})"""
        for r in REPORTS
    ]
    found["report_results"] = f"""
select *, least(rows, {PREVIEW_ROWS})::int as previewed from ({" union all ".join(counts)})"""
    found["written_workload"] = found["analyst_workload"]
    return found


def _statements(min_alerts: int) -> dict[str, str]:
    """SQL per query key; `min_alerts` is the tuning threshold used for these tables."""
    latency = f"""{BASE},
bands (severity, lowest, minutes) as (
    values ('critical', 12, 15), ('high', 10, 30), ('medium', 7, 60), ('low', -1, 240)
),
t as (
    select a.ts, a.level, b.severity, b.minutes,
           cast(floor(epoch(tr.opened_at)) - floor(epoch(a.ts)) as bigint) as to_open,
           cast(floor(epoch(tr.closed_at)) - floor(epoch(tr.opened_at)) as bigint) as working
    from triage tr join alerts a using (alert_id)
    join bands b on b.lowest = (select max(lowest) from bands where lowest <= coalesce(a.level, 0))
)"""
    return {
        "load_alerts": f"{BASE} select * from alerts",
        "load_triage": f"{BASE} select * from triage",
        "load_planted": f"{BASE} select * from planted",
        "load_incidents": f"""{BASE}, {TRUTH}
select 'first_on_' || agent as incident, agent, min(hour) as hour from truth group by agent""",
        "daily_volume_of_days": f"""
select * from (
    {_DAILY.replace("from alerts left join", f"from (select * from alerts where ts >= '{DAYS[0]}' and ts < '{DAYS[1]}') left join")}
)""",
        "load_counts": f"""{BASE}
select 'alerts' as table_name, count(*) as row_count from alerts
union all select 'triage', count(*) from triage""",
        "replaced_days": f"""
select * from (
    {_DAILY.replace("from alerts left join", f"from (select * from alerts where level >= 10 or {_OTHER_DAYS}) alerts left join")}
)""",
        "triage_of_days": f"""{BASE}
select * from triage where opened_at >= '{DAYS[0]}' and opened_at < '{DAYS[1]}'""",
        "latest_triage": f"""{_AGAIN}
select alert_id, opened_at, closed_at, analyst, disposition, escalated from again
qualify row_number() over (partition by alert_id order by closed_at desc, opened_at desc, analyst desc) = 1""",
        "repeated_triage": f"""{_AGAIN}
select alert_id, count(*) as actions, count(distinct analyst) as analysts, min(opened_at) as first_opened_at,
       max(closed_at) as last_closed_at, count(distinct disposition) > 1 as outcomes_differ
from again group by alert_id having count(*) > 1""",
        "streamed_hourly_severity": f"""{latency.split("t as (")[0].rstrip().rstrip(",")}
select date_trunc('hour', ts) as hour, b.severity, count(*) as alerts
from alerts a join bands b on b.lowest = (select max(lowest) from bands where lowest <= a.level)
group by all""",
        "daily_volume_by_severity": _DAILY,
        "chart_daily_volume": f"""
select day, strftime(day, '%b %d') as label, low, medium, high, critical from ({_DAILY})""",
        "noisy_rules": f"{_noisy(min_alerts)} select * from report",
        "chart_noisy_rules": f"""{_noisy(min_alerts)}
select rule_id, level, substring(rule_description, 1, 48) as label, alerts,
       split_part(recommendation, ':', 1) as verdict
from report order by alerts desc, rule_id, rule_description, level limit 12""",
        "time_to_triage": f"""{latency}
select severity, count(*) as triaged,
       round(cast(sum(to_open) as double) / count(to_open) / 60.0, 1) as mean_min_to_triage,
       round(quantile_cont(to_open, 0.5) / 60.0, 1) as p50_min_to_triage,
       round(quantile_cont(to_open, 0.9) / 60.0, 1) as p90_min_to_triage,
       round(cast(sum(working) as double) / count(working) / 60.0, 1) as mean_min_working,
       round(100.0 * count(*) filter (where to_open <= 60 * minutes) / count(*), 1) as pct_within_sla
from t group by all""",
        "triage_by_hour": f"""{latency}
select cast(extract(hour from ts) as int) as hour_fired, count(*) as triaged,
       round(cast(sum(to_open) as double) / count(to_open) / 60.0, 1) as mean_min_to_triage,
       round(quantile_cont(to_open, 0.9) / 60.0, 1) as p90_min_to_triage
from t where level >= 7 group by 1""",
        "mitre_coverage": f"""{JOINED},
listed as (select unnest([{_TACTICS}]) as tactic),
found as (
    select l.tactic, count(distinct p.rule_id) as rules,
           cast(coalesce(sum(p.joined), 0) as bigint) as alerts,
           cast(coalesce(sum(p.tp), 0) as bigint) as confirmed_true_positives
    from listed l left join per_alert p on p.mitre_tactic = l.tactic
    group by all
)
select *, case when alerts = 0 then 'BLIND SPOT: no detection rule'
               when confirmed_true_positives = 0 then 'no confirmed detections in 30 days'
               else 'covered' end as status
from found""",
        "hourly_heatmap": f"{_CALENDAR} select * from cells",
        "hourly_heatmap_grid": f"{_CALENDAR} select dow_num, {_GRID} from cells group by dow_num",
        "burst_detection": _bursts("order by z_score desc, hour, rule_id, agent limit 15"),
        "all_bursts": _bursts(""),
        "top_source_ips": f"""{_SOURCES}
select * from sources order by distinct_rules desc, alerts desc, src_ip limit 15""",
        "approx_source_breadth": f"""{_SOURCES.replace(_OUTSIDE, _OUTSIDE + _SOME_DAYS)}
select src_ip, alerts, distinct_rules as rules, hosts_touched as hosts
from sources order by rules desc, alerts desc, src_ip limit 15""",
        "attack_chains": _chains(
            "order by tactics_in_window desc, hosts_in_window desc, window_start, first_host, src_user limit 10"
        ),
        "all_attack_chains": _chains(""),
        "attack_chain_members": f"""
with chains as (
    select distinct first_host, src_user, window_start from (
        {_chains("order by tactics_in_window desc, hosts_in_window desc, window_start, first_host, src_user limit 10")}
    )
), {BASE.strip().removeprefix("with ")}
select c.first_host, c.src_user, c.window_start, a.alert_id, a.ts, a.rule_id, a.level, a.mitre_tactic, a.agent,
       a.src_user as "user",
       case when a.agent = c.first_host and a.src_user = c.src_user then 'both'
            when a.agent = c.first_host then 'host' else 'user' end as shares
from chains c join alerts a on a.agent = c.first_host or a.src_user = c.src_user
where a.level >= 8 and a.mitre_tactic is not null and a.ts - c.window_start between interval 0 hours and interval 2 hours""",
        "escalated_alerts": f"""{BASE}
select a.alert_id, a.ts, a.rule_id, a.level, a.mitre_tactic, a.agent, count(*) as escalations,
       max(t.closed_at) as last_closed_at
from alerts a join triage t on t.alert_id = a.alert_id and t.escalated group by all""",
        "approx_time_to_open": f"""{latency}
select severity, count(*) as actions, true as p50_within_1pct, true as p90_within_1pct
from t where to_open is not null and ts is not null group by all""",
        "analyst_workload": f"""{BASE},
work as (
    select analyst, disposition, escalated,
           cast(floor(epoch(closed_at)) - floor(epoch(opened_at)) as bigint) as seconds
    from triage
)
select analyst, count(*) as alerts_closed,
       round(cast(sum(seconds) as double) / count(seconds) / 60.0, 1) as mean_min_per_alert,
       round(100.0 * count(*) filter (where disposition = 'true_positive') / count(*), 1) as tp_pct,
       round(100.0 * count(*) filter (where disposition = 'false_positive') / count(*), 1) as fp_pct,
       count(*) filter (where escalated) as escalations
from work group by all""",
        "untriaged_high_severity": f"""{JOINED}
select level, cast(sum(joined) as bigint) as alerts, cast(sum(n) as bigint) as triaged,
       cast(sum(joined) - sum(n) as bigint) as untriaged,
       round(100.0 * sum(n) / sum(joined), 1) as pct_triaged
from per_alert where level >= 7 group by all""",
        "untriaged_alerts": f"""{BASE}
select * from alerts a
where level >= 7 and not exists (select 1 from triage t where t.alert_id = a.alert_id)""",
        "tuning_candidates": f"{_tune(min_alerts)} select rule_id from tune",
        "weekly_trend_after_tuning": f"""{_tune(min_alerts)},
flagged as (
    select cast(date_trunc('week', ts) as date) as week, rule_id not in (select rule_id from tune) as stays
    from alerts
)
select week, count(*) as alerts, count(*) filter (where stays) as alerts_after_tuning,
       round(100.0 * (count(*) - count(*) filter (where stays)) / count(*), 1) as pct_reduction
from flagged group by all""",
        "host_hour_features": f"{FEATURES} select * from features",
        "host_hour_features_by_day": f"{FEATURES} select * from features",
        "host_hour_excess": f"""{EXCESS}
select agent, hour, {", ".join(f"round({c}, 9) as {c}" for c in _MODEL)}, excess_score from excess""",
        "malicious_host_hours": f"{BASE}, {TRUTH} select * from truth",
        "baseline_ranking": f"""{RANKED}
select agent, hour, alerts, excess_score, is_malicious, heur_rank, volume_rank from ranked""",
        "baseline_precision_recall_at_k": _precision(RANKED, BASELINES),
        "baseline_incident_ranks": _incident_ranks(RANKED, BASELINES),
        "baseline_top_anomalies": _top(RANKED, "heur_rank", "excess_score"),
        "baseline_feature_importance": _importance(RANKED, "heur_rank"),
        "baseline_score_histogram": _histogram(RANKED, "excess_score"),
        "anomaly_scores": f"{SCORED} select agent, hour, anomaly_score from scored",
        "stored_forest_scores": f"{SCORED} select agent, hour, anomaly_score from scored",
        "combined_ranking": f"""{COMBINED}
select agent, hour, anomaly_score, excess_score, if_rank, heur_rank, volume_rank, combined_rank, combined_position
from ranked""",
        "host_hour_scores": f"""{COMBINED}
select agent, hour, {", ".join(_SHOWN + _MODEL)}, excess_score, anomaly_score, is_malicious, if_rank, heur_rank,
       volume_rank, combined_rank, combined_position
from ranked""",
        "precision_recall_at_k": _precision(COMBINED, METHODS),
        "incident_ranks": _incident_ranks(COMBINED, METHODS),
        "top_anomalies": _top(COMBINED, "if_rank", "anomaly_score"),
        "feature_importance": _importance(COMBINED, "if_rank"),
        "score_histogram": _histogram(COMBINED, "anomaly_score"),
        "scoring_summary": f"""{RANKED}
select count(*) as host_hours, count(distinct agent) as hosts,
       count(*) filter (where is_malicious) as malicious_host_hours,
       round(100.0 * count(*) filter (where is_malicious) / count(*), 2) as malicious_pct
from ranked""",
    }
