"""The SQL (DuckDB) that the queries of this package are compared with."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def line_dedup(source: str) -> str:
    """doc_id, text (kept), n_lines, n_dropped for the rows (doc_id, text) of ``source``."""
    return f"""
with split as (
    select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from {source}
), line as (
    select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from split
), keyed as (
    select *, {_LOWER.format(f"trim(line, {_SPACES})")} as key from line
), frequent as (
    select key, max(doc_id) as last from keyed where length(key) >= 40
    group by key having count(distinct doc_id) >= 5
), marked as (
    select k.*, f.key is not null and f.last <> k.doc_id as dropped from keyed k left join frequent f using (key)
)
select doc_id, coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '') as text,
       count(*) as n_lines, count(*) filter (where dropped) as n_dropped
from marked group by doc_id"""




def contamination(source: str) -> str:
    """The columns of op2 for the rows (doc_id, text) of ``source``."""
    words = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
with item as (
    select item_id, {words.format(_LOWER.format("coalesce(text, '')"))} as w from benchmark
), item_window as (
    select distinct item_id, least(len(w), 10) as size,
           array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as win
    from item, unnest(range(1, len(w) - least(len(w), 10) + 2)) as t(i) where len(w) > 0
), doc as (
    select doc_id, {words.format(_LOWER.format("coalesce(text, '')"))} as w from {source}
), doc_window as (
    select doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') as win
    from doc, (select distinct size from item_window) s, unnest(range(1, len(w) - size + 2)) as t(i)
), match as (
    select d.doc_id, d.i, d.size, b.item_id from doc_window d join item_window b using (size, win)
), hit as (
    select doc_id, count(distinct place) as n_hit from match, unnest(range(i, i + size)) as t(place) group by doc_id
), found as (
    select doc_id, count(distinct item_id) as n_items,
           sha256(string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar))) as items_sha256
    from match group by doc_id
)
select doc.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       coalesce(items_sha256, sha256('')) as items_sha256, n_hit is not null as contaminated
from doc left join hit using (doc_id) left join found using (doc_id)"""



WARC = """
with page as (
    select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages
), held as (
    select *, max(page_id) over (partition by html) as holder from page
)
select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           cast(((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::int >> (15 - 5 * (i % 4))) & 31) + 1 as int), 1)
           for i in range(32)], '') as payload_digest,
       case when page_id is distinct from holder then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from holder then holder end as refers_to
from held"""

AUDIT = f"""
with doc as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
           string_split_regex(trim(coalesce(text, ''), {_SPACES}), '[ \\t-\\r]+') as split from documents
), worded as (
    select *, case when split = [''] then [] else split end as w, min(doc_id) over (partition by text) as first from doc
), failing as (
    select doc_id, part, (len(w) < 50)::int as a, (100 * len(list_distinct(w)) < 65 * len(w))::int as b,
           (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::int as c,
           regexp_matches(text, '[#$%&*|]')::int as d, coalesce(first < doc_id, false)::int as e
    from worded
), label as (
    select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id
), judged as (
    select part, ['A', 'B', 'C', 'D', 'E'] as names, [a, b, c, d, e] as fails, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic
    from failing left join label using (doc_id)
), grouped as (
    select part, names, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from judged group by all
), letter as (
    select unnest(['A', 'B', 'C', 'D', 'E']) as x
), orders as (
    select a.x || b.x || c.x || d.x || e.x as filter_order from letter a, letter b, letter c, letter d, letter e
    where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), stepped as (
    select part, filter_order, step::int as step, substr(filter_order, step::int, 1) as own,
           fails[list_position(names, substr(filter_order, step::int, 1))] = 1 as failed,
           len(list_filter(names, lambda x, i: fails[i] = 1 and instr(filter_order, x) < step)) > 0 as gone,
           list_sum(fails) = 1 as alone, n, good, toxic
    from grouped, orders, range(1, 6) as t(step)
), counted as (
    select part, filter_order, step, own, coalesce(sum(n) filter (not failed and not gone), 0)::bigint as kept,
           coalesce(sum(n) filter (failed and not gone), 0)::bigint as removed,
           coalesce(sum(n) filter (failed and gone), 0)::bigint as redundant,
           coalesce(sum(n) filter (failed and alone), 0)::bigint as unique_fails,
           coalesce(sum(good) filter (failed and not gone), 0)::bigint as good_lost,
           coalesce(sum(toxic) filter (failed and not gone), 0)::bigint as toxic_lost
    from stepped group by all
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, own))::bigint as shapley
from counted"""

SPELLING = f"""
with recursive bits as (  -- the table of crc32, by its rule
    select i::bigint as k, i::bigint as v, 0 as r from range(256) as t(i)
    union all
    select k, case when v % 2 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, r + 1 from bits where r < 8
), run as (
    select coalesce(cast(doc_id as varchar), '') as id, {_LOWER.format("found")} as run, count(*) as times
    from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as found from documents) group by all
), step as (
    select id, run, hex(encode(id || ':' || run)) as hex, 0 as i, 4294967295::bigint as crc from run
    union all
    select id, run, hex, i + 1, xor(crc >> 8, v)
    from step join bits on r = 8 and k = xor(crc & 255, ('0x' || substr(hex, 2 * i + 1, 2))::bigint) where 2 * i < length(hex)
), hashed as (
    select id, run, xor(crc, 4294967295) as h from step where 2 * i = length(hex)
), written as (
    select case when h % 199 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word,
           times
    from run join hashed using (id, run)
), word as (
    select word, sum(times)::bigint as n from written where length(word) >= 6 group by word having sum(times) >= 5
), less as (
    select word, i, substr(word, 1, i::int - 1) || substr(word, i::int + 1) as rest from word, range(1, length(word) + 1) as t(i)
), near as (
    select a.word as word, b.word as other from less a join less b on a.rest = b.rest and a.i = b.i and a.word <> b.word
    union select less.word, w.word from less join word w on less.rest = w.word
    union select w.word, less.word from less join word w on less.rest = w.word
), best as (
    select near.word, count(*) as n_near, arg_min(other, (-w.n, other)) as other, max(w.n) as most
    from near join word w on w.word = near.other group by near.word
), judged as (
    select word.word, n, coalesce(n_near, 0) as n_near, case when most >= 5 * n then other end as form,
           case when most >= 5 * n then most end as form_n
    from word left join best using (word)
), chain as (
    select word, word as root from judged
    union all
    select chain.word, judged.form from chain join judged on chain.root = judged.word where judged.form is not null
), ended as (
    select chain.word, root from chain join judged on chain.root = judged.word where judged.form is null
)
select word, form, root, n, n_near, form_n from judged join ended using (word)"""

ORACLES = {
    "op11_filter_audit": AUDIT,
    "op12_spelling": SPELLING,
    "op7_warc": WARC,
    "op2_decontaminate": contamination("documents"),
    "op10_line_dedup": f"select doc_id, n_lines, n_dropped, sha256(text) as kept_sha256 from ({line_dedup('documents')})",
}
