"""DuckDB SQL for the queries that SQL can express, over the same tables."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LEAF = ", ".join(
    f"case when {c} is null then '-' else concat(strlen(cast({c} as varchar)), ':', {c}) end" for c in ("doc_id", "source", "lang", "n_chars", "text")
)

ORACLE = {
    "op1_line_dedup": f"""
        with lines as (
            select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as place
            from documents),
        keyed as (select *, {LOWER.format(f"trim(line, {WHITE})")} as key from lines),
        repeated as (
            select key, max(doc_id) as keeper from keyed where length(key) >= 20
            group by key having count(distinct doc_id) >= 3),
        judged as (
            select k.*, coalesce(k.doc_id <> r.keeper, false) as dropped from keyed k left join repeated r using (key))
        select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by place) filter (not dropped), '')) as kept_sha256
        from judged group by doc_id""",
    "op2_exact_topk": """
        with vectors as (
            select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
            select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
            from vectors q join vectors c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 20 = 0),
        ranked as (
            select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
                   vec_id, score from scored)
        select * from ranked where rank <= 20""",
    "op5_decontamination": rf"""
        with items as (
            select item_id, regexp_extract_all({LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark),
        cut as (
            select item_id, words, unnest(range(1, greatest(len(words) - 10, 0) + 2)) as pos from items where len(words) > 0),
        windows as (
            select distinct item_id, array_to_string(list_slice(words, pos, pos + 9), ' ') as window_text,
                   len(list_slice(words, pos, pos + 9)) as length from cut),
        docs as (
            select doc_id, coalesce(regexp_extract_all({LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as words
            from documents),
        starts as (
            select doc_id, words, length, unnest(range(1, len(words) - length + 2)) as pos
            from docs, (select distinct length from windows) where len(words) >= length),
        runs as (
            select doc_id, pos, length, array_to_string(list_slice(words, pos, pos + length - 1), ' ') as window_text from starts),
        hits as (select r.doc_id, r.pos, r.length, w.item_id from runs r join windows w using (length, window_text)),
        hit_words as (
            select doc_id, count(distinct place) as n_hit
            from (select doc_id, unnest(range(pos, pos + length)) as place from hits) group by doc_id),
        hit_items as (
            select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
            from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
        select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from docs left join hit_words using (doc_id) left join hit_items using (doc_id)""",
    "op6_near_dedup": rf"""
        with recursive docs as (
            select doc_id, coalesce(regexp_extract_all({LOWER.format("text")}, '[^\x20\x09-\x0D]+'), []) as words from documents),
        runs as (
            select doc_id, words, unnest(range(1, greatest(len(words) - 3, 0) + 2)) as place from docs where len(words) > 0),
        shingles as (select distinct doc_id, array_to_string(list_slice(words, place, place + 2), ' ') as shingle from runs),
        sizes as (select doc_id, count(*) as n from shingles group by doc_id),
        shared as (
            select a.doc_id as a, b.doc_id as b, count(*) as overlap
            from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
        links as (
            select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
            where 100 * overlap >= 85 * (x.n + y.n - overlap)),
        ends as (select a, b from links union all select b, a from links),
        reached as (
            select doc_id as node, doc_id as other from docs
            union
            select r.node, e.b from reached r join ends e on r.other = e.a),
        least as (select node, min(other) as component_id from reached group by node)
        select d.doc_id, coalesce(s.n, 0) as n_shingles, l.component_id, l.component_id = d.doc_id as kept
        from docs d left join sizes s using (doc_id) join least l on l.node = d.doc_id""",
    "op7_substring_dedup": r"""
        with docs as (
            select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as words from documents),
        places as (select doc_id, words, unnest(range(1, len(words) + 1)) as place from docs),
        windows as (
            select doc_id, place, array_to_string(list_slice(words, place, place + 34), ' ') as passage
            from places where place + 34 <= len(words)),
        often as (select passage from windows group by passage having count(*) > 1),
        starts as (select doc_id, place, 1 as repeated from windows where passage in (select passage from often)),
        judged as (
            select p.doc_id, p.place, p.words[p.place] as word,
                   max(coalesce(repeated, 0)) over (
                       partition by p.doc_id order by p.place rows between 34 preceding and current row) = 1 as removed
            from places p left join starts s on p.doc_id = s.doc_id and p.place = s.place),
        kept as (
            select doc_id, count(*) filter (removed) as n_removed,
                   string_agg(word, ' ' order by place) filter (not removed) as kept
            from judged group by doc_id)
        select doc_id, len(words) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
        from docs left join kept using (doc_id)""",
    "op11_url_filters": rf"""
        with recursive cut as (
            select page_id, html, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as after from pages),
        parsed as (
            select page_id, html, {LOWER.format("regexp_extract(after, '^[^/?#]*')")} as host, regexp_extract(after, '^[^/?#]*([^?#]*)', 1) as path
            from (select page_id, html, coalesce(after, '') as after from cut)),
        rules(verdict, rule, name, start) as (
            values ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
                   ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
                   ('block', 'com/de/', 'com', '/de/')),
        numbered as (select *, row_number() over () as id from parsed),
        fits as (
            select id, rule, verdict from numbered join rules
            on (host = name or ends_with(host, '.' || name)) and starts_with(path, start)
            qualify row_number() over (partition by id order by length(rule) desc, rule) = 1),
        decided as (select n.*, f.rule, f.verdict from numbered n left join fits f using (id)),
        hrefs as (
            select host as source, unnest(regexp_extract_all(
                regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'), '(?is)<script\b.*?</script', ' ', 'g'),
                               '(?is)<style\b.*?</style', ' ', 'g'),
                '(?i)<a[ \t\n\r\f](?:[^<>]*?[ \t\n\r\f"''])?href[ \t\n\r\f]*=[ \t\n\r\f]*["'']?([^"'' \t\n\r\f<>]+)', 1)) as link
            from parsed),
        ends as (
            select source, {LOWER.format("regexp_extract(link, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)")} as target from hrefs),
        edges as (select distinct source, target from ends where source <> '' and target <> '' and source <> target),
        ways as (
            select 'trust' as kind, source as giver, target as taker from edges union all select 'distrust', target, source from edges),
        flows as (select *, count(*) over (partition by kind, giver) as parts from ways),
        amounts as (
            select 0 as round, case verdict when 'allow' then 'trust' else 'distrust' end as kind, host, count(*) * 150000 as amount
            from decided where rule is not null and host <> '' group by kind, host
            union all
            select a.round + 1, a.kind, f.taker, cast(sum(a.amount // f.parts) as bigint) * 85 // 100
            from amounts a join flows f on f.kind = a.kind and f.giver = a.host where a.round < 20 and a.amount > 0
            group by a.round, a.kind, f.taker),
        hosts as (
            select host, cast(sum(case kind when 'trust' then amount else 0 end) as bigint) as trust,
                   cast(sum(case kind when 'distrust' then amount else 0 end) as bigint) as distrust
            from amounts group by host)
        select page_id, d.host, path, rule, coalesce(trust, 0) as trust, coalesce(distrust, 0) as distrust,
               coalesce(verdict, case when coalesce(trust, 0) + coalesce(distrust, 0) = 0 or trust / (trust + distrust) >= 0.5
                                      then 'allow' else 'block' end) as verdict
        from decided d left join hosts h on h.host = d.host""",
    "op12_hard_negatives": """
        with vectors as (
            select row_number() over () as id, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
            where vec_id is not null and label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        anchors as (
            select vec_id as anchor_id, label, v, min(id) as anchor from vectors where vec_id % 50 = 0 group by vec_id, label, v),
        scored as (
            select a.anchor, a.anchor_id, a.label <> c.label as other, c.vec_id, c.id, cast(list_dot_product(a.v, c.v) as bigint) as score
            from anchors a join vectors c on len(a.v) = len(c.v)),
        positives as (
            select anchor, anchor_id, vec_id as positive_id, score as positive_score,
                   row_number() over (partition by anchor order by score desc, vec_id) as place
            from scored where not other and vec_id <> anchor_id),
        met as (
            select p.anchor_id, p.positive_id, s.vec_id as negative_id, p.positive_score, s.score as negative_score,
                   cast(row_number() over (partition by p.anchor, p.place order by s.score desc, s.vec_id) as integer) as rank
            from positives p join scored s on s.anchor = p.anchor and s.other
            where p.place <= 5 and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score)
        select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from met where rank <= 3""",
    "op13_merkle_manifest": f"""
        with recursive docs as (
            select *, row_number() over () as id,
                   list_reduce(
                       list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint)),
                       lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))) as crc
            from documents),
        named as (
            select id, doc_id, source, sha256(concat({LEAF})) as leaf,
                   case when xor(crc, 4294967295) % 2 = 0 then sha256(concat({LEAF.replace("text", "replace(text, chr(10), '')")}))
                        else sha256(concat({LEAF})) end as claimed
            from docs),
        leaves as (
            select *, dense_rank() over (order by source nulls first) - 1 as tree,
                   row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos
            from named),
        nodes as (
            select 0 as level, tree, pos, leaf as node from leaves
            union all
            select level + 1, tree, pos // 3, sha256(string_agg(node, '' order by pos))
            from (select *, max(pos) over (partition by tree) as last from nodes) where last > 0 group by level, tree, pos // 3),
        subroots as (select tree, node as subroot, level as height from nodes qualify level = max(level) over (partition by tree)),
        over as (
            select 0 as level, tree as pos, subroot as node from subroots
            union all
            select level + 1, pos // 3, sha256(string_agg(node, '' order by pos))
            from (select *, max(pos) over () as last from over) where last > 0 group by level, pos // 3),
        folds as (
            select id, tree, pos, 0 as level, claimed as folded, '' as proof from leaves
            union all
            select f.id, f.tree, f.pos // 3, f.level + 1,
                   sha256(concat(coalesce(string_agg(n.node, '' order by n.pos) filter (n.pos < f.pos), ''), f.folded,
                                 coalesce(string_agg(n.node, '' order by n.pos) filter (n.pos > f.pos), ''))),
                   concat(f.proof, coalesce(string_agg(n.node, '' order by n.pos) filter (n.pos <> f.pos), ''))
            from folds f join subroots s on s.tree = f.tree and f.level < s.height
            join nodes n on n.tree = f.tree and n.level = f.level and n.pos // 3 = f.pos // 3
            group by f.id, f.tree, f.pos, f.level, f.folded, f.proof),
        above as (
            select f.id, f.tree as pos, 0 as level, f.folded, f.proof from folds f join subroots s on s.tree = f.tree and f.level = s.height
            union all
            select a.id, a.pos // 3, a.level + 1,
                   sha256(concat(coalesce(string_agg(n.node, '' order by n.pos) filter (n.pos < a.pos), ''), a.folded,
                                 coalesce(string_agg(n.node, '' order by n.pos) filter (n.pos > a.pos), ''))),
                   concat(a.proof, coalesce(string_agg(n.node, '' order by n.pos) filter (n.pos <> a.pos), ''))
            from above a join over n on n.level = a.level and n.pos // 3 = a.pos // 3
            where a.level < (select max(level) from over)
            group by a.id, a.pos, a.level, a.folded, a.proof),
        top as (select node as root, level as height from over qualify level = max(level) over ())
        select l.doc_id, l.leaf, s.subroot, t.root, sha256(a.proof) as proof_sha256, a.folded as folded_root, a.folded = t.root as verified
        from leaves l join subroots s on s.tree = l.tree join above a on a.id = l.id cross join top t where a.level = t.height""",
}
