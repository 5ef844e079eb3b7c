"""SQL for those corpus queries that SQL can express, written from what each result means."""

from __future__ import annotations

from alertloom.llm import chat, link_trust
from alertloom.llm.licenses import PERCENT, TEMPLATES, bigrams_of

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(column: str) -> str:
    return f"translate({column}, '{_UPPER}', '{_LOWER}')"


def _ngram_join() -> str:
    return rf"""
with recursive words as (
    select row_number() over () as d, doc_id,
           regexp_extract_all(coalesce({_lower("text")}, ''), '[^\x20\x09-\x0D]+') as w
    from documents
),
shingles as (
    select distinct d, unnest(case
        when len(w) = 0 then []::varchar[]
        when len(w) < 4 then [array_to_string(w, ' ')]
        else [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]
    end) as s
    from words
),
sizes as (select d, count(*) as n from shingles group by d),
common as (
    select a.d as x, b.d as y, count(*) as shared
    from shingles a join shingles b on a.s = b.s and a.d < b.d
    group by 1, 2
),
links as (
    select x, y from common join sizes p on p.d = x join sizes q on q.d = y
    where 100 * shared >= 85 * (p.n + q.n - shared)
),
ways as (select x, y from links union all select y, x from links),
reached as (
    select d as x, d as y from words
    union
    select reached.x, ways.y from reached join ways on ways.x = reached.y
)
select me.doc_id, coalesce(any_value(n), 0) as n_shingles, min(other.doc_id) as component_id
from reached
join words me on me.d = reached.x
join words other on other.d = reached.y
left join sizes on sizes.d = me.d
group by me.d, me.doc_id
"""


def _warc() -> str:
    return """
with payloads as (
    select row_number() over () as p, page_id, coalesce(html, '') as body from pages
),
digests as (
    select p, page_id, strlen(body) as payload_bytes, sha1(body) as hex from payloads
),
nibbles as (
    select *, [strpos('0123456789abcdef', substr(hex, i, 1)) - 1 for i in range(1, 41)] as h from digests
),
coded as (
    select p, page_id, payload_bytes,
        array_to_string([
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + (((16 * h[i * 5 // 4 + 1] + h[i * 5 // 4 + 2]) >> (3 - i * 5 % 4)) & 31)::int, 1)
            for i in range(0, 32)], '') as payload_digest
    from nibbles
),
lasts as (
    select payload_digest, payload_bytes, max(struct_pack(page_id := page_id, p := p)) as last
    from coded group by 1, 2
)
select page_id, payload_bytes, payload_digest,
       case when p = last.p then 'response' else 'revisit' end as record_type,
       case when p = last.p then null else last.page_id end as refers_to
from coded join lasts using (payload_digest, payload_bytes)
"""


def _licenses() -> str:
    rows = []
    for name, text in TEMPLATES.items():
        grams = bigrams_of(text)
        rows += [f"('{name}', '{g}', {n}, {sum(grams.values())})" for g, n in grams.items()]
    return f"""
with templates (license, bigram, there, size) as (values {", ".join(rows)}),
docs as (select row_number() over () as d, doc_id, text from documents),
words as (
    select d, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') as w
    from docs where text is not null
),
grams as (
    select d, unnest(range(1, len(w))) as place, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) as bigram
    from words
),
places as (
    select *, row_number() over (partition by d, license, bigram order by place) as nth
    from grams join templates using (bigram)
),
hits as (
    select p.*, coalesce(q.place, 0) as back
    from places p left join places q
        on q.d = p.d and q.license = p.license and q.bigram = p.bigram and q.nth = p.nth - p.there
),
-- Stretches from one hit to another; a bigram counts at most as often as the template has it.
stretches as (
    select a.d, a.license, a.size, b.place - a.place + 1 as n,
           sum((b.back < a.place)::int) over (partition by a.d, a.license, a.place order by b.place) as shared
    from hits a join hits b
        on b.d = a.d and b.license = a.license and b.place between a.place and a.place + 2 * a.size
),
best as (
    select d, license, max(2.0 * shared / (n + size)) as dice from stretches
    where 200 * shared >= {PERCENT} * (n + size) group by d, license
),
found as (
    select d, count(*) as n_licenses, string_agg(license, ',' order by license) as licenses,
           arg_min(license, struct_pack(x := -dice, y := license)) as best_license, round(max(dice), 6) as best_dice
    from best group by d
)
select doc_id, coalesce(n_licenses, 0) as n_licenses, coalesce(licenses, '') as licenses, best_license,
       best_dice::double as best_dice
from docs left join found using (d)
"""


def _contamination() -> str:
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
with docs as (
    select row_number() over () as d, doc_id, regexp_extract_all(coalesce({_lower("text")}, ''), '{pattern}') as w
    from documents
),
items as (
    select coalesce(item_id::varchar, '') as item, regexp_extract_all(coalesce({_lower("text")}, ''), '{pattern}') as w
    from benchmark
),
windows as (
    select item, least(13, len(w)) as n, unnest([
        array_to_string(w[i:i + least(13, len(w)) - 1], ' ') for i in range(1, greatest(1, len(w) - 12) + 1)
    ]) as words
    from items where len(w) > 0
),
places as (
    select d, n, i, array_to_string(w[i:i + n - 1], ' ') as words
    from (select d, w, n, unnest(range(1, len(w) - n + 2)) as i from docs, (select distinct n from windows))
),
found as (select d, i, n, item from places join windows using (n, words)),
covered as (select d, count(distinct spot) as n_hit from (select d, unnest(range(i, i + n)) as spot from found) group by d),
named as (
    select d, count(*) as n_items, string_agg(item, ',' order by item) as ids
    from (select distinct d, item from found) group by d
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join covered using (d) left join named using (d)
"""


def _escaped(text: str) -> str:
    """Null as empty, and a backslash in every mark of turns."""
    return rf"regexp_replace(coalesce({text}, ''), '<(\\*)\|im_(start|end)\|>', '<\\\1|im_\2|>', 'g')"


def _chat() -> str:
    """The repair one turn at a time: costs of all states forwards, then the cheapest states backwards."""
    automaton = chat.Automaton()
    steps = str(automaton.steps.tolist())
    closing = str(automaton.closing.tolist())
    far = int(automaton.steps.max())
    names = ", ".join(f"('{name}', {label})" for name, label in chat.ALIASES.items())
    acts, ends = [], []
    for label in range(4):
        for s in range(4):
            for r, role in chat.ROLES.items():
                inserted, merged = automaton.actions(label, s, r) if automaton.steps[label, s, r] < far else ([], False)
                done = ["merge"] * merged + ["relabel"] * (label != r) + [f"insert {chat.ROLES[x]}" for x in inserted]
                opening = chat._piece("", s, r, inserted, merged, None)
                acts.append(f"({label}, {s + 1}, {r + 1}, '{role}', '{', '.join(done)}', '{opening}')")
    for r in range(4):
        left = chat._CLOSING[r]
        added = ", ".join(f"close {chat.ROLES[x]}" for x in left)
        ends.append(f"({r + 1}, '{added}', '{chat._piece('', r, r, [], True, left)[1:]}')")
    return f"""
with recursive labels (name, label) as (values {names}),
turns as (
    select conv_id, turn, {_escaped('text')} as text, coalesce(label, 0) as label,
           row_number() over (partition by conv_id order by turn nulls first, role nulls first) - 1 as position,
           count(*) over (partition by conv_id) as n
    from conversations left join labels on name = lower(trim(role))
),
ahead as (
    select distinct conv_id, -1::bigint as position, [0, {far}, {far}, {far}]::bigint[] as costs from turns
    union all
    select t.conv_id, t.position, [
        least({far}, list_min([a.costs[s] + ({steps})[t.label + 1][s][r] for s in [1, 2, 3, 4]])) for r in [1, 2, 3, 4]]
    from ahead a join turns t on t.conv_id is not distinct from a.conv_id and t.position = a.position + 1
),
last as (
    select a.conv_id, a.position, [a.costs[s] + ({closing})[s] for s in [1, 2, 3, 4]] as costs
    from ahead a join turns t on t.conv_id is not distinct from a.conv_id and t.position = a.position
    where t.position = t.n - 1
),
behind as (
    select conv_id, position, list_position(costs, list_min(costs)) as state from last
    union all
    select conv_id, position, list_position(costs, list_min(costs)) as state from (
        select b.conv_id, a.position, [a.costs[s] + ({steps})[t.label + 1][s][b.state] for s in [1, 2, 3, 4]] as costs
        from behind b
        join turns t on t.conv_id is not distinct from b.conv_id and t.position = b.position
        join ahead a on a.conv_id is not distinct from b.conv_id and a.position = b.position - 1
    )
),
acts (label, before, state, role, action, opening) as (values {", ".join(acts)}),
ends (state, action, ending) as (values {", ".join(ends)})
select t.conv_id, t.turn, t.position, acts.role,
       coalesce(nullif(concat_ws(', ', nullif(acts.action, ''),
           case when t.position = t.n - 1 then nullif(ends.action, '') end), ''), 'keep') as action,
       acts.opening || t.text || case when t.position = t.n - 1 then ends.ending else '' end as rendered
from turns t
join behind b on b.conv_id is not distinct from t.conv_id and b.position = t.position
join behind p on p.conv_id is not distinct from t.conv_id and p.position = t.position - 1
join acts on acts.label = t.label and acts.before = p.state and acts.state = b.state
join ends on ends.state = b.state
"""


def _rules() -> str:
    given = ", ".join(f"('{v}', '{r}')" for v, r in link_trust.RULES)
    link = link_trust.LINK.replace("'", "''")
    passed, unit = link_trust.PASSED, link_trust.UNIT
    least = unit * (100 - passed) // 100 * link_trust.BLOCKED // 100
    return f"""
with recursive rules as (
    select verdict, rule, regexp_extract(rule, '^[^/]*') as host, regexp_replace(rule, '^[^/]*', '') as start
    from (values {given}) as given(verdict, rule)
),
urls as (
    select row_number() over () as u, page_id, html,
           coalesce({_lower(f"regexp_extract(url, '{link_trust.URL}', 1)")}, '') as host,
           coalesce(regexp_extract(url, '{link_trust.URL}', 2), '') as path
    from pages
),
decided as (
    select u, rule, rules.verdict from urls join rules
        on (urls.host = rules.host or ends_with(urls.host, '.' || rules.host)) and starts_with(path, start)
    qualify row_number() over (partition by u order by length(rule) desc, length(rules.host) desc, rules.verdict desc) = 1
),
counted as (
    select host, count(*) as n, count(*) filter (verdict = 'allow') as allowed, count(*) filter (verdict = 'block') as blocked
    from urls left join decided using (u) where host != '' group by host
),
found as (
    select host as a, {_lower("unnest(regexp_extract_all(html, '" + link + "', 1))")} as b from urls
),
links as (select a, b, count(*) as n from found where a != '' and b != '' and a != b group by a, b),
ways as (
    select 'trust' as kind, a, b, n, sum(n) over (partition by a) as total from links
    union all
    select 'distrust', b, a, n, sum(n) over (partition by b) from links
),
walk as (
    select 0 as step, 'trust' as kind, host, ({unit} * allowed // n) * {100 - passed} // 100 as score from counted
    union all
    select 0, 'distrust', host, ({unit} * blocked // n) * {100 - passed} // 100 from counted
    union all
    select step + 1, kind, b, sum((score::hugeint * n // total) * {passed} // 100)::bigint
    from walk join ways using (kind) where walk.host = ways.a and step < {link_trust.STEPS} and score > 0
    group by step, kind, b
),
scores as (
    select host, sum(score) filter (kind = 'trust')::bigint as trust, sum(score) filter (kind = 'distrust')::bigint as distrust
    from walk group by host
)
select page_id, host, path, rule,
       case when decided.verdict is not null then decided.verdict
            when distrust > trust and distrust >= {least} then 'block' else 'allow' end as verdict,
       coalesce(trust, 0)::bigint as trust, coalesce(distrust, 0)::bigint as distrust
from urls left join decided using (u) left join scores using (host)
"""


def _crc32(text: str) -> str:
    """Of an ASCII text: one step for each byte, by the table of the polynomial's remainders."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    step = f"xor(c >> 8, {table}[(xor(c, b) & 255) + 1])"
    codes = f"[ascii(x)::bigint for x in string_split({text}, '')]"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {step}), 4294967295)"


def _tree(name: str, leaves: str) -> str:
    """All nodes of trees (tree, i, n, node), and what stands before and after each in its run."""
    return f"""
{name} as (
    select 0 as level, tree, i, n, node from {leaves}
    union all
    select level + 1, tree, i // 3, (n + 2) // 3, sha256(string_agg(node, '' order by i))
    from {name} where n > 1 group by level, tree, i // 3, n
),
{name}_runs as (
    select level, tree, i, n,
           coalesce(string_agg(node, '') over (w rows between unbounded preceding and 1 preceding), '') as earlier,
           coalesce(string_agg(node, '') over (w rows between 1 following and unbounded following), '') as later
    from {name} where n > 1 window w as (partition by level, tree, i // 3 order by i)
)"""


def _way_up(name: str, tree: str, start: str) -> str:
    """From each row (r, tree, i, n, proof, now) of `start` to its tree's root."""
    return f"""
{name} as (
    select 0 as level, r, tree, i, n, proof, now from {start}
    union all
    select w.level + 1, r, w.tree, w.i // 3, (w.n + 2) // 3, proof || earlier || later, sha256(earlier || now || later)
    from {name} w join {tree}_runs s on s.level = w.level and s.tree is not distinct from w.tree and s.i = w.i
)"""


def _manifest() -> str:
    def leaf(text: str) -> str:
        values = ["doc_id", "source", "lang", "n_chars", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}::varchar) || ':' || {v}::varchar, '-')" for v in values) + ")"

    return f"""
with recursive docs as (
    select row_number() over () as r, doc_id, source as tree, {leaf("text")} as leaf,
           case when {_crc32("doc_id::varchar")} % 2 = 0 then {leaf("replace(text, chr(10), '')")} else {leaf("text")} end as other
    from documents
),
placed as (
    select *, leaf as node, '' as proof, other as now, count(*) over (partition by tree) as n,
           row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i
    from docs
),{_tree("low", "placed")},
tops as (
    select 0 as tree, tree as source, row_number() over (order by tree nulls first) - 1 as i, count(*) over () as n, node
    from low where n = 1
),{_tree("high", "tops")},{_way_up("climbed", "low", "placed")},
reached as (
    select r, t.tree, t.i, t.n, proof, now from climbed c join tops t on t.source is not distinct from c.tree where c.n = 1
),{_way_up("ended", "high", "reached")},
root as (select node from high where n = 1)
select doc_id, leaf, t.node as subroot, root.node as root, sha256(e.proof) as proof_sha256, e.now as folded_root,
       e.now = root.node as verified
from docs d join ended e on e.r = d.r and e.n = 1 join tops t on t.source is not distinct from d.tree, root
"""


def statements() -> dict[str, str]:
    return {
        "op2_chat_formatting": _chat(),
        "op1_ngram_jaccard_join": _ngram_join(),
        "op3_warc_assembly": _warc(),
        "op4_license_scan": _licenses(),
        "op6_decontamination": _contamination(),
        "op11_url_filters": _rules(),
        "op12_merkle_manifest": _manifest(),
    }
