"""The SQL of the operators, as DuckDB runs it on the same tables."""

from __future__ import annotations

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: str) -> str:
    return f"translate({text}, '{LETTERS}', '{LETTERS.lower()}')"


DEDUP = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""

DECONTAMINATION = f"""
with d as (
  select doc_id, list_filter(string_split_regex({lowered("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') w
  from documents),
b as (
  select cast(item_id as varchar) item, list_filter(string_split_regex({lowered("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') w
  from benchmark),
windows as (
  select distinct item, array_to_string(w[i:i + 9], ' ') win, least(len(w), 10) size
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i from b where len(w) > 0)),
places as (
  select doc_id, w, size, unnest(range(1, len(w) - size + 2)) i
  from d, (select distinct size from windows) where len(w) >= size),
hits as (
  select doc_id, item, i, p.size from (select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') win from places) p
  join windows using (win, size)),
spread as (select distinct doc_id, unnest(range(i, i + size)) place from hits),
words as (select doc_id, count(*) n_hit from spread group by 1),
items as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) items from (select distinct doc_id, item from hits) group by 1)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
       sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""

# Base 32 of the 40 hex digits: five of them are 20 bits, four letters.
WARC = """
with p as (select page_id, coalesce(html, '') html, sha1(coalesce(html, '')) h from pages),
five as (select page_id, html, h, list_transform(range(8), lambda g: cast('0x' || substr(h, g * 5 + 1, 5) as bigint)) n from p)
select page_id, cast(octet_length(encode(html)) as bigint) payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((n[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') payload_digest,
       case when page_id = min(page_id) over same then 'response' else 'revisit' end record_type,
       nullif(min(page_id) over same, page_id) refers_to
from five window same as (partition by html)
"""

JACCARD = f"""
with recursive w as (
  select doc_id, list_filter(string_split_regex({lowered("coalesce(text, '')")}, '[\x20\x09-\x0D]+'), lambda w: w <> '') w
  from documents),
s as (
  select distinct doc_id, unnest(case when len(w) > 4 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      when len(w) > 0 then [array_to_string(w, ' ')] else [] end) g
  from w),
n as (select doc_id, count(*) n from s group by 1),
p as (select a.doc_id a, b.doc_id b, count(*) k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 75 * (x.n + y.n - k)),
e as (select a, b from l union all select b, a from l),
reach as (select doc_id, doc_id r from documents union select reach.doc_id, e.b from reach join e on e.a = reach.r)
select doc_id, coalesce(any_value(n), 0) n_shingles, min(r) component_id from reach left join n using (doc_id) group by 1
"""

FILL_IN_MIDDLE = """
with d as (select doc_id, coalesce(text, '') text, sha256('1:' || doc_id) h from documents),
u as (
  select doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') w,
         list_transform(range(4), lambda i: cast('0x' || substr(h, 8 * i + 1, 8) as bigint)) r
  from d),
c as (
  select doc_id, text, w, len(w) n, least(r[1] % (len(w) + 1), r[2] % (len(w) + 1)) a, greatest(r[1] % (len(w) + 1), r[2] % (len(w) + 1)) b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or r[3] % 100 >= 90 then 'plain'
              when r[4] % 100 < 20 then 'spm' else 'psm' end form
  from u),
p as (select *, array_to_string(w[1:a], '') prefix, array_to_string(w[a + 1:b], '') middle, array_to_string(w[b + 1:], '') suffix from c)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end prefix_chars, case when form <> 'plain' then length(middle) end middle_chars,
       sha256(case form when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle else text end) output_sha256,
       sha256(text) restored_sha256
from p
"""


def centroids(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    distance = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    floor = "cast((s - ((s % n) + n) % n) // n as bigint)"
    steps = [f"""
v as materialized (
  select row_number() over () as i, vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) v
  from embeddings
  where len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {dims}),
c0 as materialized (
  select cast(row_number() over (order by sha256('3:' || vec_id), v) - 1 as integer) k, v c from v
  qualify row_number() over (order by sha256('3:' || vec_id), v) <= {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as materialized (
  select i, vec_id, v, min({distance}) d, arg_min(k, {distance} * {k} + k) k from v, c{r} group by i, vec_id, v)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} as materialized (
  select c{r}.k, coalesce(m.c, c{r}.c) c from c{r} left join (
    select k, list({floor} order by pos) c from (
      select k, pos, cast(sum(v[pos]) as bigint) s, count(*) n from a{r}, range(1, {dims + 1}) as t(pos) group by k, pos) group by k) m on m.k = c{r}.k)""")
    return f"""with {",".join(steps)}
select vec_id, a{rounds}.k cluster, cast(d as bigint) distance, cast(sum(d) over (partition by a{rounds}.k) as bigint) cluster_inertia,
       cast(sum(d) over () as bigint) inertia, sha256(array_to_string(c, ',')) centroid_sha256
from a{rounds} join c{rounds} on a{rounds}.k = c{rounds}.k
"""


LLM_ORACLES = {
    "op11_fill_in_middle": FILL_IN_MIDDLE,
    "op13_centroid_clustering": centroids(),
    "op1_jaccard_join": JACCARD,
    "op3_benchmark_decontamination": DECONTAMINATION,
    "op8_exact_dedup": DEDUP,
    "op9_warc": WARC,
}
