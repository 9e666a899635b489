"""SQL for the operators that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

NEAR_DEDUP = f"""
    with recursive w as (select doc_id, {_SPACED} as ws from documents),
    s as (
      select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
        else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as g, least(len(ws), 5) as k from w),
    n as (select doc_id, count(*) as n from s group by doc_id),
    c as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b on a.g = b.g and a.k = b.k and a.doc_id < b.doc_id group by 1, 2),
    l as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 75 * (x.n + y.n - shared)),
    e as (select a, b from l union all select b, a from l),
    r as (select a as doc_id, b as other from e union select r.doc_id, e.b from r join e on r.other = e.a),
    m as (select doc_id, min(other) as least_ from r group by doc_id)
    select w.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, least(w.doc_id, coalesce(m.least_, w.doc_id)) as component_id,
      w.doc_id = least(w.doc_id, coalesce(m.least_, w.doc_id)) as kept
    from w left join n using (doc_id) left join m using (doc_id)"""

DECONTAMINATION = f"""
    with d as (select doc_id, {_ALNUM} as ws from documents),
    b as (select item_id, {_ALNUM} as ws from benchmark),
    i as (select item_id, least(len(ws), 10) as n, array_to_string(ws[p:p + least(len(ws), 10) - 1], ' ') as g
      from (select item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) as p from b where len(ws) > 0)),
    k as (select distinct n from i),
    t as (select doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') as g from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as p from d, k)),
    h as (select doc_id, t.n, p, item_id from t join (select distinct item_id, n, g from i) using (n, g)),
    x as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + n)) as q from h) group by doc_id),
    y as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as varchar) as item from h) group by doc_id)
    select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from d left join x using (doc_id) left join y using (doc_id)"""

CHAT_FORMATTING = """
    with recursive m as (select cast(conv_id as varchar) as conv, turn, role, text, conv_id + turn as nth, conv_id % 3 as kind from conversations),
    c as (select conv, conv || ':' || turn as id, turn, case when role = 'user' then 'reply' else 'set_context' end as name,
        nth % 13 = 0 as raw, nth % 5 = 0 as other, nth % 11 = 0 as odd, nth % 7 = 0 or text is null as bare, text, nth,
        case when role = 'user' then conv || ':' || (turn + case when kind = 1 or kind = 2 and turn % 4 < 2 then 2 else -2 end) end as waits
      from m where role in ('user', 'system')),
    e as (select x.conv, x.id, x.waits from c x join c y on x.conv = y.conv and x.waits = y.id),
    k as (select conv, count(*) as n from c group by conv),
    w as (select conv, id, 0 as depth from c union all select e.conv, e.id, depth + 1 from w join e on e.conv = w.conv and e.waits = w.id join k on k.conv = w.conv where depth < k.n),
    l as (select w.conv, id, max(depth) as deepest, any_value(n) as n from w join k on k.conv = w.conv group by w.conv, id),
    d as (select c.*, case when deepest < n then cast(deepest as integer) end as level,
        case when raw then 'json' else array_to_string(list_filter([case when nth % 15 = 0 and nth % 9 <> 0 then 'choice meta.lang' end, case when nth % 12 = 0 then 'missing meta.tags[].k' end, case when bare then 'missing text' end, case when nth % 9 = 0 then 'type meta.lang' end,
          case when other then 'type turn' end, case when nth % 21 = 0 then 'unknown meta.extra' end, case when odd then 'unknown mood' end], lambda x: x is not null), ',') end as problems,
        case when raw then '{"text":' || cast(to_json('no json: ' || coalesce(text, '')) as varchar) || '}' else '{' || case when nth % 3 = 0 then '"meta":{' || case when nth % 21 = 0 then '"extra":true,' else '' end || '"lang":' || case when nth % 9 = 0 then '5' when nth % 15 = 0 then '"xx"' else '"en"' end
            || ',"tags":[{"k":"a","n":1},{' || case when nth % 12 = 0 then '' else '"k":"b",' end || '"n":2}]},' else '' end || case when odd then '"mood":"odd",' else '' end
          || case when bare then '' else '"text":' || cast(to_json(text) as varchar) || ',' end || '"turn":' || case when other then '"' || turn || '"' else cast(turn as varchar) end || '}' end as arguments
      from c join l on c.conv = l.conv and c.id = l.id),
    r as (select conv, conv || ':' || (turn - 1) as id, turn as result_turn, text as result from m where role not in ('user', 'system') or role is null),
    j as (select conv, id, turn, name, result_turn, result, level, problems, arguments, turn is not null as is_call,
        case when turn is null then 'no call' when level is null then 'cycle' when result_turn is null then 'no result' else 'linked' end as status
      from d full join r using (conv, id))
    select conv, id, turn, name, result_turn, level, status, case when is_call then problems = '' end as valid, problems,
      '{' || case when is_call then '"arguments":' || arguments || ',' else '' end || '"conversation":"' || conv || '","id":"' || id || '"' || coalesce(',"level":' || level, '')
        || case when is_call then ',"name":"' || name || '","problems":[' || case when problems = '' then '' else '"' || replace(problems, ',', '","') || '"' end || ']' else '' end
        || coalesce(',"result":' || cast(to_json(result) as varchar), '') || coalesce(',"result_turn":' || result_turn, '') || ',"status":"' || status || '"'
        || case when is_call then ',"turn":' || turn || ',"valid":' || (problems = '') else '' end || '}' as json
    from j"""

_UINT = "cast('0x' || substr(h, {}, 8) as ubigint)"
_JOIN = "coalesce(array_to_string({}, ''), '')"

FILL_IN_MIDDLE = rf"""
    with d as (select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
    u as (select doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as us, {_UINT.format(1)} as h1, {_UINT.format(9)} as h2, {_UINT.format(17)} as h3, {_UINT.format(25)} as h4 from d),
    c as (select *, len(us) as n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) as x, greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) as y,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form from u),
    p as (select *, {_JOIN.format("us[1:x]")} as a, {_JOIN.format("us[x + 1:y]")} as m, {_JOIN.format("us[y + 1:]")} as z from c)
    select doc_id, n, form, case when form <> 'plain' then length(a) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
      sha256(case form when 'plain' then t when 'psm' then '<P>' || a || '<S>' || z || '<M>' || m else '<S>' || z || '<P>' || a || '<M>' || m end) as output_sha256, sha256(t) as restored_sha256
    from p"""

CONVERSATION_TRIE = """
    with k as (select list_transform(range(256), lambda x: list_reduce(range(8), lambda a, i: case when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end, x)) as t),
    s as (select conv_id as c, list(md5(coalesce(role, '')) || md5(coalesce(text, '')) order by turn nulls first, role, text) as g, list(octet_length(encode(coalesce(text, ''))) order by turn nulls first, role, text) as b
      from conversations where conv_id is not null group by conv_id),
    h as (select c, g, b, xor(list_reduce(list_transform(string_split(cast(c as varchar), ''), lambda x: cast(ascii(x) as bigint)), lambda a, x: xor(a // 256, k.t[xor(a, x) % 256 + 1]), 4294967295), 4294967295) % 9 as h from s, k),
    r as (select h.c, coalesce(z.g[1:h.h], []) || h.g[h.h + 1:] as g, coalesce(z.b[1:h.h], []) || h.b[h.h + 1:] as b from h left join s z on z.c = h.c - h.c % 5),
    p as (select c, d, md5(array_to_string(g[1:d], '')) || d as key, case when d > 0 then md5(array_to_string(g[1:d - 1], '')) || (d - 1) end as above, coalesce(b[d], 0) as bytes, d = len(g) as is_end from (select *, unnest(range(0, len(g) + 1)) as d from r)),
    n as (select key, any_value(above) as above, any_value(d) as depth, min(c) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(bytes) as saved, coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where is_end), '') as ends from p group by key),
    w as (select n.*, m.conv_id as parent_conv_id, coalesce(x.n, 0) as n_children from n left join n m on m.key = n.above left join (select above, count(*) as n from n group by above) x on x.above = n.key),
    u as (select p.key, sum(w.saved) as saved_tokens, count(*) filter (where w.n_children = 0) as n_leaves from w join p on p.c = w.conv_id and p.d <= w.depth group by p.key)
    select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, cast(saved_tokens as bigint) as saved_tokens, sha256(ends) as ends_sha256 from w join u using (key)"""
