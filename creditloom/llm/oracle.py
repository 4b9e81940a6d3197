"""DuckDB SQL for the queries that SQL can express."""

SQL: dict[str, str] = {}

SQL["op3_decontaminate"] = r"""
with doc as (
    select doc_id, row_number() over () as r,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
    from documents
), item as (
    select item_id::varchar as item_id,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
    from benchmark
), win as (
    select distinct item_id, least(10, len(w)) as size,
        array_to_string(list_slice(w, pos, pos + least(10, len(w)) - 1), ' ') as t
    from (select *, unnest(range(1, len(w) - least(10, len(w)) + 2)) as pos from item where len(w) > 0)
), sizes as (select distinct size from win
), place as (
    select r, size, pos, array_to_string(list_slice(w, pos, pos + size - 1), ' ') as t
    from (select r, w, size, unnest(range(1, len(w) - size + 2)) as pos from doc, sizes where len(w) >= size)
), hit as (select r, p.size, pos, item_id from place p join win on win.t = p.t and win.size = p.size
), spot as (
    select r, count(distinct word) as n_hit
    from (select r, unnest(range(pos, pos + size)) as word from (select distinct r, pos, size from hit)) group by r
), named as (
    select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct r, item_id from hit) group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join spot using (r) left join named using (r)
"""

SQL["op4_ngram_jaccard"] = r"""
with recursive doc as (
    select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+'), []) as w
    from documents
), shingle as (
    select distinct doc_id, list_slice(w, pos, pos + least(5, len(w)) - 1) as s
    from (select *, unnest(range(1, len(w) - least(5, len(w)) + 2)) as pos from doc where len(w) > 0)
), sized as (select doc_id, count(*) as n from shingle group by doc_id
), shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as i
    from shingle a join shingle b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2
), link as (
    select a, b from shared join sized x on x.doc_id = a join sized y on y.doc_id = b
    where 100 * i >= 75 * (x.n + y.n - i)
), both_ways as (select a, b from link union select b, a from link
), reach(doc_id, other) as (
    select doc_id, doc_id from doc
    union
    select reach.doc_id, both_ways.b from reach join both_ways on both_ways.a = reach.other
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, coalesce(links, 0)::bigint as n_links
from doc left join sized using (doc_id)
join (select doc_id, min(other) as component_id from reach group by doc_id) using (doc_id)
left join (select a as doc_id, count(*) as links from both_ways group by a) using (doc_id)
"""

SQL["op1_warc_chunks"] = r"""
with page as (
    select page_id, coalesce(html, '') as html from pages
), summed as (select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as h from page
), digit as (  -- 5 hex digits are 20 bits, which are 4 digits of base 32
    select page_id, payload_bytes, k,
        (('0x' || substr(h, (k // 4)::int * 5 + 1, 5))::int >> (15 - 5 * (k % 4))::int) & 31 as v
    from (select *, unnest(range(0, 32)) as k from summed)
), digested as (
    select page_id, payload_bytes,
        string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v + 1, 1), '' order by k) as payload_digest
    from digit group by page_id, payload_bytes
), firsts as (select payload_digest, payload_bytes, min(page_id) as first from digested group by all
)
select page_id, payload_bytes, payload_digest,
    case when page_id = first then 'response' else 'revisit' end as record_type,
    case when page_id <> first then first end as refers_to
from digested join firsts using (payload_digest, payload_bytes)
"""

SQL["op6_url_ranges"] = r"""
with parsed as (
    select page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
    from pages
), rules(verdict, rhost, rpath) as (
    values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
        ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fitting as (
    select page_id, arg_max(rhost || rpath, length(rhost) * 1000 + length(rpath)) as rule,
        arg_max(verdict, length(rhost) * 1000 + length(rpath)) as verdict
    from parsed join rules on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
    group by page_id
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parsed left join fitting using (page_id)
"""

SQL["op11_spelling_chunks"] = r"""
with recursive found as (
    select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[a-zÀ-ÿ]+')) as w
    from documents
), run as (
    select w, k, cast(k as integer) as times, hex(encode(coalesce(doc_id::varchar, '') || ':' || w)) as digits
    from (select doc_id, w, count(*) as k from found group by doc_id, w)
), nibble as (  -- the checksum's table for four bits, by its rule
    select list(c order by k) as t from (
        select k, list_reduce([k, 0, 0, 0, 0]::bigint[], lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) as c
        from (select unnest(range(0, 16))::bigint as k))
), summed as (  -- four bits at a time, each byte's low half first
    select w, times, 4294967295 - list_reduce(
            list_prepend(4294967295::bigint, list_transform(range(0, length(digits)),
                lambda i: (strpos('0123456789ABCDEF', digits[i + 2 - 2 * (i % 2)]) - 1)::bigint)),
            lambda c, d: xor(c >> 4, t[(xor(c, d) & 15) + 1])) as h
    from run, nibble
), changed as (
    select case when h % 97 = 0 then substr(w, 1, (h % length(w))::int) || substr(w, (h % length(w))::int + 2) else w end as word, times
    from summed
), word as (
    select word, sum(times)::bigint as n from changed where length(word) >= 5 group by word having sum(times) >= 3
), gap as (
    select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
    from (select word, n, unnest(range(1, length(word) + 1))::int as i from word)
), near as (
    select a.word, b.word as other, b.n as m from gap a join gap b on a.rest = b.rest and a.i = b.i and a.word <> b.word
    union select a.word, b.word, b.n from gap a join word b on a.rest = b.word
    union select b.word, a.word, a.n from gap a join word b on a.rest = b.word
), best as (
    select word, count(*) as n_near, (list({'m': -m, 'other': other} order by -m, other))[1] as best from near group by word
), named as (
    select word, n, coalesce(n_near, 0)::bigint as n_near,
        case when -best.m >= 2 * n then best.other end as form, case when -best.m >= 2 * n then -best.m end::bigint as form_n
    from word left join best using (word)
), step(word, root) as (
    select word, word from named
    union all
    select step.word, named.form from step join named on named.word = step.root where named.form is not null
)
select named.word, named.form, step.root, named.n, named.n_near, named.form_n
from named join step on step.word = named.word join named as ending on ending.word = step.root and ending.form is null
"""

SQL["op13_bag_search"] = r"""
with doc as (
    select doc_id, row_number() over () as r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents
), asked as (
    select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
), size as (select r, count(*) as n from doc group by r
), total as (select count(*) as documents, sum(n)::bigint as terms from size
), held as (select r, term, count(*)::bigint as tf from doc where term in (select term from asked) group by r, term
), weight as (
    select term, floor(1000 * ln((2 * documents + 2)::double / (2 * df + 1)::double))::bigint as w
    from (select term, count(*) as df from held group by term), total
), part as (
    select r, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * documents) // terms))) as s
    from held join size using (r) join weight using (term), total
), score as (select item_id, r, sum(s)::bigint as score from part join asked using (term) group by item_id, r
), ranked as (
    select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank
    from score join (select distinct r, doc_id from doc) using (r) where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 50
"""
