"""DuckDB SQL for the training-data queries that SQL can say."""

from __future__ import annotations

import string

from lakeops.llm import quality_rules, secret_scan

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def secrets() -> str:
    """All matches of each rule; the pieces between matches give the places."""
    found = []
    for rank, rule in enumerate(secret_scan.RULES):
        p = _quoted(rule.pattern)
        found.append(
            f"""select doc_id, {rank} as rank, '{rule.kind}' as kind, m[i] as m, list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) as s from
 (select *, unnest(generate_series(1, len(m))) as i from (select doc_id, regexp_extract_all(t, {p}, 0) as m, regexp_extract_all(t, {p}, {rule.group}) as g, string_split_regex(t, {p}) as p from d)) where length(g[i]) >= {rule.least}"""
        )
    base = "kind in ('assign', 'access', 'hex')"
    listed = "string_agg(kind || ':' || cast(s as bigint) || ':' || cast(s + length(m) as bigint), ',' order by s, rank)"
    return f"""with d as (select doc_id, coalesce(text, '') as t from documents), hits as ({" union all ".join(found)}),
per as (select doc_id, {", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in ("assign", "access", "hex"))}, {listed} filter ({base}) as base, {listed} as spans from hits group by 1)
select d.doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in ("assign", "access", "hex"))}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join per on d.doc_id = per.doc_id"""


def quality() -> str:
    """Counts by list functions; repeated windows by counting their words."""
    symbols = _quoted(quality_rules.SYMBOLS)
    stop = ", ".join(_quoted(w) for w in dict.fromkeys(quality_rules.STOP_WORDS))

    def broken(rule: quality_rules.Rule) -> str:
        parts = rule.metric.split(" / ")
        value = f"cast({parts[0]} as double)" + (f" / {parts[1]}" if len(parts) == 2 else "")
        value = f"case when {parts[1]} > 0 then {value} else 0 end" if len(parts) == 2 else value
        tests = ([f"({value}) < {rule.least}"] if rule.least is not None else []) + ([f"({value}) > {rule.most}"] if rule.most is not None else [])
        return f"case when {' or '.join(tests)} then '{rule.name}' end"

    return rf"""with w as (select doc_id, coalesce(text, '') as text, {WORDS} as ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from documents),
win as (select doc_id, i, array_to_string(ws[i:i+7], chr(31)) as k from (select doc_id, ws, unnest(generate_series(1, len(ws) - 7)) as i from w where len(ws) > 7)),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, k) as c from win) where c > 1),
cov as (select doc_id, count(distinct p) as n from (select doc_id, unnest(generate_series(i, i + 7)) as p from rep) group by 1),
m as (select w.doc_id, len(ws) as n_words, length(translate(text, {SPACES}, '')) as word_chars, length(text) - length(translate(text, {symbols}, '')) as n_symbols, len(ls) as n_lines, len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(n, 0) as n_repeat_words,
 len(list_filter(ws, lambda x: lower(translate(x, '.,;:!?', '')) in ({stop}))) as n_stop_words, len(list_filter(ws, lambda x: length(x) > 1 and regexp_matches(x, '\p{{Lu}}') and not regexp_matches(x, '\p{{Ll}}'))) as n_capital_words, len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) as n_letter_words,
 len(list_filter(ls, lambda x: rtrim(x, ' ') like '%...' or rtrim(x, ' ') like '%…')) as n_ellipsis_lines, len(list_filter(ls, lambda x: substr(ltrim(x, ' '), 1, 1) in ('-', '*', '•'))) as n_bullet_lines from w left join cov on cov.doc_id = w.doc_id),
j as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed, concat_ws(',', {", ".join(map(broken, quality_rules.RULES))}) as failed_rules from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and failed_rules = '' as kept, failed_rules from j"""


def near_duplicates() -> str:
    """All pairs that share a shingle, and what links reach."""
    return _linked_documents(75, ", w.doc_id = component_id as kept")


def jaccard_components() -> str:
    """The same at a higher similarity."""
    return _linked_documents(80, "")


def _linked_documents(percent: int, more: str) -> str:
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return f"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+') as ws from documents),
s as (select distinct doc_id, array_to_string(ws[i:i+4], chr(31)) as k from (select doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) as i from w where len(ws) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.k = b.k and a.doc_id <> b.doc_id group by 1, 2),
links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= {percent} * (x.n + y.n - c)),
reach as (select doc_id as a, doc_id as b from w union select reach.a, links.b from reach join links on reach.b = links.a)
select w.doc_id, coalesce(n, 0) as n_shingles, component_id{more} from w left join n on n.doc_id = w.doc_id join (select a, min(b) as component_id from reach group by 1) on a = w.doc_id"""


def mix() -> str:
    """The thresholds by a running sum over all draws of a source."""
    draw = "cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '|' || coalesce(source, '')), 1, 15) as bigint)"
    by_room = "order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding"
    return f"""with d as (select doc_id, source, len({WORDS}) as size, {draw} as draw from documents),
t as (select source, cast(sum(size) as bigint) as source_size from d group by 1),
g as (select *, ([5, 2, 1])[(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from t),
r as (select *, (sum(source_size) over () * 1.5::double - coalesce(sum(source_size) over ({by_room}), 0) * 2.0::double) / (sum(weight) over () - coalesce(sum(weight) over ({by_room}), 0)) as rate,
 row_number() over (order by source_size / weight, source nulls last) as place from g),
f as (select *, rate * weight >= source_size * 2.0::double as full_ from r),
x as (select source, source_size, case when full_ or shared is null then source_size * 2.0::double else least(source_size * 2.0::double, shared * weight) end as target from f, (select arg_min(rate, place) filter (not full_) as shared from f)),
e as (select *, case when source_size > 0 then cast(floor(target / source_size + 1e-12) as bigint) else 0 end as epochs from x),
q as (select *, greatest(0, target - epochs * source_size) as rest from e),
c as (select source, draw, sum(size) as n, sum(sum(size)) over (partition by source order by draw) as upto from d group by 1, 2),
b as (select q.source, arg_min(c.draw, c.draw) as cut, arg_min(rest - (upto - n), c.draw) as left_, arg_min(n, c.draw) as n from q join c on c.source is not distinct from q.source and upto > rest group by 1)
select d.doc_id, d.size, source_size, target, size * (epochs + case when b.cut is not null and d.draw < b.cut + case when left_ > 0 and left_ * 2 >= b.n then 1 else 0 end then 1 else 0 end) as taken
from d join q on d.source is not distinct from q.source left join b on b.source is not distinct from d.source"""


def divergence() -> str:
    """Terms of whole texts, document by document, and the complete table of groups and kept terms."""
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return f"""with d as materialized (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents),
w as (select r, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d),
t as materialized (select r, lang, source, term, count(*) as n from w group by 1, 2, 3, 4),
kept as materialized (select lang, term from t group by 1, 2 having count(*) >= 30),
v as (select lang, count(*) as v from kept group by 1),
g as (select distinct lang, source from d),
c as (select t.lang, source, t.term, sum(n) as n from t join kept on kept.lang = t.lang and kept.term = t.term group by 1, 2, 3),
f as materialized (select g.lang, g.source, kept.term, coalesce(c.n, 0) as n from g join kept on kept.lang = g.lang left join c on c.lang = g.lang and c.source = g.source and c.term = kept.term),
s as materialized (select f.*, 1 + (1000000000::hugeint * (n + 5)) // (sum(n) over (partition by f.lang, source) + 5 * v) as p, 1 + (1000000000::hugeint * (sum(n) over (partition by f.lang, term) + 5)) // (sum(n) over (partition by f.lang) + 5 * v) as q from f join v on v.lang = f.lang),
pairs as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from s a join s b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
allp as (select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value from g a join g b on a.lang = b.lang and a.source <> b.source left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source),
terms as (select lang, source, 'term' as part, term as item, cast(p - q as bigint) as value from s where n > 0 and p > q)
select *, cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank from allp
union all select * from (select *, cast(row_number() over (partition by lang, source order by value desc, item) as integer) as rank from terms) where rank <= 50"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Rounds of assignment and exact means, one common table expression after the other."""
    steps = [
        """k as (select vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * x) as bigint)) as x from embeddings
 where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"v as (select vec_id, label, p, list_slice(x, p * len(x) // {parts} + 1, (p + 1) * len(x) // {parts}) as x from k, (select unnest(range({parts})) as p))",
        f"c0 as (select p, row_number() over (partition by p order by vec_id) - 1 as e, x from v qualify e < {entries})",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} as (select vec_id, label, p, any_value(x) as x, min((d, e)) as best from
 (select v.vec_id, v.label, v.p, v.x, c.e, list_sum(list_transform(list_zip(v.x, c.x), lambda z: cast(z[1] - z[2] as hugeint) * (z[1] - z[2]))) as d from v join c{r} c on c.p = v.p) group by vec_id, label, p)""")
        if r < rounds:
            steps.append(f"""m{r} as (select p, e, list((s - ((s % n) + n) % n) // n order by i) as x from (select p, best[2] as e, i, sum(x[i]) as s, count(*) as n from (select p, best, x, unnest(range(1, len(x) + 1)) as i from a{r}) group by 1, 2, 3) group by 1, 2),
c{r + 1} as (select c.p, c.e, coalesce(list_transform(m.x, lambda y: cast(y as bigint)), c.x) as x from c{r} c left join m{r} m on m.p = c.p and m.e = c.e)""")
    return f"""with {", ".join(steps)},
f as (select vec_id, label, string_agg(lower(printf('%02x', cast(best[2] as integer))), '' order by p) as code, cast(sum(best[1]) as bigint) as error from a{rounds} group by vec_id, label),
h as (select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) as codebooks_sha256 from c{rounds})
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from f, h"""
