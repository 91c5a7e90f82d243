"""SQL that the queries of this folder are checked against."""

from __future__ import annotations

from bidlens.llm.urls import BAD_LIMIT, BOUND_Z, LONG_SUFFIXES, RHO_RANGE

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DUPLICATES = f"""
with d as (select doc_id, {_LOWER.format("coalesce(text, '')")} as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from d
"""

_ESCAPED = "replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'), '|', '&vert;')"

CHAT = f"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
s as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos,
         count(*) over (partition by conv_id) as n,
         length({_ESCAPED.format("text")}) + case role when 'user' then 18 when 'assistant' then 5
           else 11 + length({_ESCAPED.format("role")}) end as size
  from t),
c as (select *, sum(size) over (partition by conv_id order by pos) as upto from s)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by pos) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(upto) filter (where role = 'assistant' or pos = n) as bigint) as formatted_chars
from c group by conv_id
"""

_SUFFIXES = ", ".join(f"'{s}'" for s in LONG_SUFFIXES)


def _level(name: str, unit: str, parent: str) -> str:
    """Shrinkage of one level: its units, the weight of their priors, their posterior means and bounds."""
    above = ("select 'x' as k, 0 as n, 0 as bad, 0.0 as w, overall as parent from total" if parent == ""
             else f"select {parent} as k, n, bad, w, parent from {parent}_level")
    prior = "a.parent" if parent == "" else "(a.bad - u.bad + a.w * a.parent) / (a.n - u.n + a.w)"
    key = "'x'" if parent == "" else parent
    return f"""
{name}_units as (
  select u.*, {prior} as parent from (
    select {unit}, {key} as k, sum(n) as n, sum(bad) as bad from sites group by all) u
  join ({above}) a on u.k = a.k),
{name}_weight as (
  select 1 / least(greatest(coalesce(
    (sum((bad - n * parent) * (bad - n * parent)) - sum(n * parent * (1 - parent)))
    / nullif(sum(n * (n - 1) * parent * (1 - parent)), 0), {RHO_RANGE[1]}), {RHO_RANGE[0]}), {RHO_RANGE[1]}) - 1 as w
  from {name}_units),
{name}_level as (
  select {unit}, n, bad, w, parent, (bad + w * parent) / (n + w) as mean from {name}_units, {name}_weight),"""


URL_VERDICTS = f"""
with p as (
  select page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")} as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
  from pages),
q as (select *, regexp_replace(regexp_replace(host, '^[^@]*@', ''), '[.]?(:[0-9]*)?$', '') as site from p),
r as (select *, string_split(site, '.') as parts, regexp_matches(site, '^[0-9.]+$|^[[]') as address from q),
two as (select *, array_to_string(parts[-2:], '.') as last2 from r),
u as (
  select page_id, host, path, site,
    case when address then site when last2 in ({_SUFFIXES}) then array_to_string(parts[-3:], '.') else last2 end as domain,
    case when address then '' when last2 in ({_SUFFIXES}) then last2 else parts[-1] end as suffix
  from two),
sites as (
  select site, domain, suffix, count(*) as n,
         sum(case when coalesce(quality = 0, false) or coalesce(toxic = 1, false) then 1 else 0 end) as bad
  from u join labels on page_id = doc_id where host <> '' group by all),
total as (select (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1) as overall from sites),
{_level("suffix", "suffix", "")}
{_level("domain", "domain", "suffix")}
{_level("site", "site", "domain")}
judged as (
  select u.*, coalesce(s.mean - {BOUND_Z} * sqrt(s.mean * (1 - s.mean) / (s.n + s.w + 1)),
           m.prior - {BOUND_Z} * sqrt(m.prior * (1 - m.prior) / ((select w from site_weight) + 1))) as bound
  from u left join site_level s on u.site = s.site
  left join (select x.page_id as pid, coalesce(d.mean, f.mean, (select overall from total)) as prior
             from u x left join domain_level d on x.domain = d.domain left join suffix_level f on x.suffix = f.suffix) m
    on u.page_id = m.pid),
ruled as (
  select *, case
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule
  from judged)
select page_id, host, path, rule,
       case when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
            when host <> '' and bound > {BAD_LIMIT} then 'block' else 'allow' end as verdict
from ruled
"""

JACCARD_COMPONENTS = f"""
with recursive w as (
  select doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws
  from documents),
sh as (
  select distinct doc_id, unnest(case when len(ws) >= 3 then list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
    when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as s
  from w),
n as (select doc_id, count(*) as n from sh group by doc_id),
met as (select a.doc_id as x, b.doc_id as y, count(*) as o from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (select x, y from met join n p on x = p.doc_id join n q on y = q.doc_id where 100 * o >= 90 * (p.n + q.n - o)),
reach(d, m) as (select doc_id, doc_id from documents union select r.d, l.y from reach r join links l on r.m = l.x)
select d.doc_id, coalesce(n.n, 0) as n_shingles, (select min(m) from reach r where r.d = d.doc_id) as component_id,
       (select count(*) from links l where l.x = d.doc_id) as n_links
from documents d left join n on d.doc_id = n.doc_id
"""

# The checksum of each run in its document, byte by byte over the polynomial's table.
SPELLING_VARIANTS = f"""
with recursive tab as (
  select list(v order by i) as t from (
    select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as v
    from (select unnest(range(256)) as i))),
raw as (
  select coalesce(cast(doc_id as varchar), '') as id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{7,}}')) as run from documents),
runs as (select id, {_LOWER.format("run")} as run, count(*) as c from raw group by all),
hexed as (select run, c, hex(encode(id || ':' || run)) as h from runs),
bytes as (
  select run, c, list_prepend(4294967295, list_transform(range(0, length(h) // 2), lambda i:
    (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)) as b from hexed),
sums as (
  select run, c, xor(list_reduce(b, lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) as h from bytes, tab),
cut as (
  select c, case when h % 31 = 0 then substr(run, 1, cast(h % length(run) as int)) || substr(run, cast(h % length(run) as int) + 2) else run end as word
  from sums),
words as (select word, cast(sum(c) as bigint) as n from cut where length(word) >= 7 group by word having sum(c) >= 2),
gaps as (select word, n, i, substr(word, 1, cast(i - 1 as int)) || substr(word, cast(i + 1 as int)) as d from (
  select word, n, unnest(range(1, length(word) + 1)) as i from words)),
pairs as (
  select a.word as a, b.word as b, b.n as n from gaps a join gaps b on a.i = b.i and a.d = b.d and a.word <> b.word
  union all
  select distinct g.word, w.word, w.n from gaps g join words w on g.d = w.word
  union all
  select distinct w.word, g.word, g.n from gaps g join words w on g.d = w.word),
best as (
  select a, count(*) as n_near, first(b order by n desc, b) as b, max(n) as bn from pairs group by a),
forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when bn >= 10 * w.n then b end as form,
         case when bn >= 10 * w.n then bn end as form_n from words w left join best on w.word = a),
ways(word, root) as (
  select word, word from forms union all
  select ways.word, forms.form from ways join forms on ways.root = forms.word where forms.form is not null)
select f.word, f.form, ways.root, f.n, cast(f.n_near as bigint) as n_near, cast(f.form_n as bigint) as form_n
from forms f join ways on f.word = ways.word join forms e on ways.root = e.word where e.form is null
"""
