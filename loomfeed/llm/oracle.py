"""SQL for the queries that SQL can express on whole tables in reasonable time.

The language model, rANS files, SimHash (XXH64), approximate search, toxicity,
the hash tree (XXH64 and crc32), packing and the pipeline have none; they are
tested against brute force, exact round trips or held-out accuracy.
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _folded(text: str) -> str:
    lower = f"translate({text}, '{_UPPER}', '{_LOWER}')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP2 = r"""
with d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
n as (select r, doc_id, w, len(w) as n from d),
win as (
  select r, i, sha256(array_to_string(w[i:i + 34], ' ')) as h
  from (select r, w, unnest(range(1, n - 33)) as i from n where n >= 35)),
again as (select h from win group by h having count(*) > 1),
hit as (
  select distinct r, unnest(range(i, i + 35)) as p
  from win where h in (select h from again)),
word as (select r, w[p] as word, p from (select r, w, unnest(range(1, n + 1)) as p from n)),
kept as (
  select r, sha256(string_agg(word, ' ' order by p)) as h
  from word anti join hit using (r, p) group by r),
gone as (select r, count(*) as n_removed from hit group by r)
select doc_id, n as n_words, coalesce(n_removed, 0) as n_removed,
       coalesce(h, sha256('')) as kept_sha256
from n left join gone using (r) left join kept using (r)
"""

OP5 = """
with p as (select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as h from pages),
m as (select *, max(page_id) over (partition by h) as top from p)
select page_id, cast(strlen(body) as bigint) as payload_bytes,
       array_to_string([
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                (cast('0x' || substr(h, cast(5 * (i // 4) + 1 as integer), 5) as integer)
                 >> (15 - 5 * (i % 4))) % 32 + 1, 1)
         for i in range(0, 32)], '') as payload_digest,
       case when page_id = top then 'response' else 'revisit' end as record_type,
       case when page_id <> top then top end as refers_to
from m
"""

OP10 = f"""
with b as (select item_id, {_folded('text')} as w from benchmark where text is not null),
s as (select item_id, w, len(w) as n from b where len(w) > 0),
win as (
  select item_id, w as x, n as size from s where n < 10
  union all
  select item_id, w[i:i + 9], 10 from (select *, unnest(range(1, n - 8)) as i from s where n >= 10)),
d as (
  select row_number() over () as r, doc_id, {_folded("coalesce(text, '')")} as w from documents),
size as (select distinct size from win),
found as (
  select r, i, size, x from (
    select r, i, size, w[i:i + size - 1] as x
    from (select r, w, size, unnest(range(1, len(w) - size + 2)) as i from d, size where len(w) >= size))
  where x in (select x from win)),
hit as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + size)) as p from found) group by r),
item as (
  select r, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct r, cast(item_id as varchar) as id from found join win using (x)) group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join item using (r)
"""

ORACLE = {"op2_substrings": OP2, "op5_warc": OP5, "op10_decontaminate": OP10}
