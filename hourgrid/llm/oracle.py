"""The same results as the queries' in DuckDB's SQL, for the operators that SQL can express on whole tables."""

from __future__ import annotations

from hourgrid.llm import chat_format, queries, url_filter, vector_codes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _runs(table: str, key: str) -> str:
    """Distinct five-word runs of each text of ``table``."""
    return rf"""
select distinct {key}, array_to_string(w[k : k + 4], ' ') as run
from (select {key}, w, unnest(range(1, len(w) - 3)) as k
      from (select {key}, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') as w
            from {table}))"""


DECONTAMINATION = f"""
with docs as ({_runs("documents", "doc_id")}),
     items as ({_runs("benchmark", "item_id")}),
     sizes as (select item_id, count(*) as n_item from items group by item_id)
select doc_id, item_id, count(*) as n_shared, n_item, count(*) / n_item as containment
from docs join items using (run) join sizes using (item_id)
group by doc_id, item_id, n_item
having count(*) >= 0.8 * n_item
"""


def _chat() -> str:
    escaped = lambda x: f"regexp_replace({x}, '<(~*)\\|', '<~\\1|', 'g')"
    spoof = queries.SPOOF
    return f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '{spoof}'), (-1, 1, 'assistant', '{spoof}')),
formatted as (
  select *, '{chat_format.START}' || replace({escaped("role")}, chr(10), '{chat_format.LINE}') || chr(10)
            || {escaped("text")} || '{chat_format.END}' || chr(10) as formatted
  from turns)
select conv_id,
       count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, formatted)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, formatted) filter (where role = 'assistant'), ''))
         as loss_sha256,
       sum(length(formatted))::bigint as formatted_chars,
       0::bigint as n_attachments,
       0::bigint as attachment_tokens
from formatted group by conv_id
"""


def _url_filter() -> str:
    longest = sorted(url_filter.RULES, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')" for h, p, _ in longest]
    rule = " ".join(f"when {f} then '{h}{p}'" for f, (h, p, _) in zip(fits, longest, strict=True))
    says = " ".join(f"when {f} then '{v}'" for f, (_, _, v) in zip(fits, longest, strict=True))
    low, high = url_filter.STRENGTH

    def strength(groups: str) -> str:
        """Prior strength for the groups, which have bad, n and mu."""
        return f"""
select case when coalesce(more, 0) = 0 or seen <= expected then {high}
            else round(least(greatest(more / (seen - expected) - 1, {low}), {high}), 6) end as k
from (select sum(n * (bad / n - mu) * (bad / n - mu)) as seen, sum(mu * (1 - mu)) as expected,
             sum((n - 1) * mu * (1 - mu)) as more from {groups})"""

    return rf"""
with urls as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '{url_filter.URL}', 1), '{UPPER}', '{LOWER}') as host,
         regexp_extract(coalesce(url, ''), '{url_filter.URL}', 2) as path
  from pages),
known as (
  select doc_id, case when quality = 0 or toxic = 1 then 1.0::double when quality = 1 and toxic = 0 then 0.0::double end as bad
  from labels),
hosts0 as (
  select host, sum(bad) as bad, count(*)::double as n,
         array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') as domain, string_split(host, '.')[-1] as suffix
  from urls join known on try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})', 1), '') as bigint) = doc_id
  where bad is not null group by host),
suffixes0 as (
  select suffix, sum(bad) as bad, sum(n) as n, (select (sum(bad) + 1) / (sum(n) + 2) from hosts0) as mu from hosts0 group by suffix),
suffixes as (select suffix, (bad + k * mu) / (n + k) as mu from suffixes0, ({strength("suffixes0")})),
domains0 as (
  select domain, d.bad, d.n, mu from (select domain, suffix, sum(bad) as bad, sum(n) as n from hosts0 group by domain, suffix) d
  join suffixes using (suffix)),
domains as (select domain, (bad + k * mu) / (n + k) as mu from domains0, ({strength("domains0")})),
hosts1 as (select host, bad, n, mu from hosts0 join domains using (domain)),
hosts2 as (select host, n, k, (bad + k * mu) / (n + k) as rate from hosts1, ({strength("hosts1")})),
verdicts as (
  select host, case when rate - {url_filter.Z} * sqrt(rate * (1 - rate) / (n + k + 1)) > {url_filter.LIMIT}
                    then 'block' else 'allow' end as by_host from hosts2)
select page_id, host, path, case {rule} end as rule, coalesce(case {says} end, by_host, 'allow') as verdict
from urls left join verdicts using (host)
"""


NGRAM_JOIN = rf"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, array_to_string(w[k : k + 3], ' ') as shingle
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as k from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as m from shingles a join shingles b using (shingle)
  where a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * m >= 85 * (x.n + y.n - m)),
reach(a, b) as (
  select doc_id, doc_id from documents union select reach.a, links.b from reach join links on reach.b = links.a)
select a as doc_id, coalesce(any_value(n), 0) as n_shingles, min(b) as component_id
from reach left join sizes on sizes.doc_id = a group by a
"""

# Whole numbers of 128 bits hold the products of components up to 2^48; larger ones SQL leaves out.
TOP_K = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::hugeint) as w
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: coalesce(isfinite(x) and abs(x::double) <= 281474976710656, false))) = len(embedding)),
scores as (
  select q.vec_id as query_id, c.vec_id, coalesce(list_reduce(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2]), lambda a, b: a + b, 0::hugeint), 0) as score
  from vectors q join vectors c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id)
select query_id, rank::int as rank, vec_id, try_cast(score as bigint) as score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores)
where rank <= 5
"""


def _vector_codes() -> str:
    n, size, scale = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.SCALE
    steps = []
    for k in range(vector_codes.ROUNDS + 1):
        steps.append(f"""
near{k} as materialized (
  select row, p, any_value(v) as v, min({{'d': d, 'e': e}}) as m
  from (select row, p, a.v, e, list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
        from parts a join book{k} b using (p))
  group by row, p)""")
        if k < vector_codes.ROUNDS:
            steps.append(f"""
book{k + 1} as materialized (
  select p, e, coalesce(n.v, b.v) as v
  from book{k} b left join (
    select p, e, list(((s - (((s % c) + c) % c)) // c)::bigint order by i) as v
    from (select p, m.e as e, i, sum(x) as s, count(*) as c
          from (select p, m, unnest(v) as x, unnest(range(len(v))) as i from near{k}) group by p, m.e, i)
    group by p, e) n using (p, e))""")
    last = vector_codes.ROUNDS
    return f"""
with kept as materialized (
  select row_number() over (order by vec_id) as row, vec_id, label,
         list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as w
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
parts as materialized (
  select row, p, w[p * (len(w) // {n}) + 1 : (p + 1) * (len(w) // {n})] as v from kept, (select unnest(range({n})) as p)),
book0 as materialized (select p, row - 1 as e, v from parts where row <= {size}),
{",".join(steps)},
coded as (
  select row, string_agg(printf('%02x', m.e), '' order by p) as code, sum(m.d)::bigint as error from near{last} group by row)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
       (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) from book{last}) as codebooks_sha256
from coded join kept using (row)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_decontamination": DECONTAMINATION,
        "op5_chat_formatting": _chat(),
        "op6_url_filter": _url_filter(),
        "op8_ngram_jaccard_join": NGRAM_JOIN,
        "op10_exact_top_k": TOP_K,
        "op11_vector_codes": _vector_codes(),
    }
