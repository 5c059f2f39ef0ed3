"""The registered queries a second time, as plain SQL for an independent engine."""

from __future__ import annotations

from platewise.plans.bridge import CUISINES, LEXICON, PHRASES


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


def epoch(ts: str) -> str:
    return f"cast(floor(epoch({ts})) as bigint)"


DAY0 = 788918400
TERM_SPACE = 1 << 20
VECTOR_TEXT = "string_agg(dim || ':' || cast(round(weight * 10000) as bigint), ' ' order by dim)"


def _text_counts(table: str, key: str) -> str:
    words = r"unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'))"
    return f"""
        select {key}, ('0x' || substr(md5(term), 1, 13))::bigint % {TERM_SPACE} as dim, count(*) as n
        from (select {key}, {words} as term from {table}) z where term <> '' group by all"""


def _unit_terms(counts: str, key: str) -> str:
    return f"""
        select {key}, dim, weight / sqrt(total) as weight from (
            select *, sum(weight * weight) over (partition by {key}) as total from (
                select c.{key}, c.dim, c.n * ln((passages + 1) / (coalesce(holding, 0) + 1)) as weight
                from {counts} c left join text_holding h on h.dim = c.dim
                cross join (select count(text)::double as passages from documents) p) y) z
        where weight > 0"""


# Named steps; each may read the ones before it.
STEPS = {
    "users_raw": f"""
        select cast(c_custkey as varchar) as user_id, n_name as shipping_city, r_name as shipping_state,
               case when c_custkey % 2 = 0 then 'en' else 'fr' end as locale,
               case when c_mktsegment = 'FURNITURE' then '1' else '0' end as grandpa,
               case when c_acctbal > 0 then '1' else '0' end as subscribed,
               cast({DAY0} + 86400 * c_custkey as bigint) as created_at, c_custkey as ord
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
        union all
        select cast(c_custkey as varchar), 'MOVED', r_name, 'en', '0', '1',
               cast({DAY0} + 86400 * c_custkey as bigint), 1000000000 + c_custkey
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
        where c_custkey % 10 = 0""",
    "users": """
        select * exclude (rn) from (
            select *, row_number() over (partition by user_id order by ord desc) as rn from users_raw)
        where rn = 1""",
    "menus_raw": f"""
        select p_partkey as ord, cast(p_partkey as varchar) as item_id, p_name as meal,
               concat(split_part(p_name, ' ', 1), ', ', split_part(p_name, ' ', 2), ', ', lower(p_type)) as ingredients,
               cast({DAY0} + 86400 * p_partkey as bigint) as creation_ts
        from part""",
    "menus": """
        select * exclude (rn) from (
            select *, row_number() over (partition by meal order by ord) as rn from menus_raw)
        where rn = 1""",
    "aliases": """
        select r.item_id as raw_id, m.item_id as item_id, r.ord
        from menus_raw r join menus m on r.meal = m.meal""",
    "ratings": """
        select cast(o_custkey as varchar) as user_id, cast(l_partkey as varchar) as menu_item_id,
               cast(1 + floor((l_quantity - 1) / 10) as integer) as rating, l_shipdate as ts
        from lineitem join orders on l_orderkey = o_orderkey""",
    "choices": """
        select cast(user_id as varchar) as user_id, regexp_extract(props, '([0-9]+)', 1) as menu_item_id,
               case when event_type = 'click' then 'true' else 'false' end as manual, ts as created_at
        from events where event_type in ('click', 'purchase')""",
    "events_raw": f"""
        select user_id, menu_item_id as raw_id, 'Watch' as event_type, cast(rating * 20 as double) as event_value,
               {epoch('ts')} as created_at, case when rating > 3 then 1 else 0 end as liked from ratings
        union all
        select user_id, menu_item_id, 'Click', cast(1 as double), {epoch('created_at')}, 1
        from choices where manual = 'true'""",
    "resolved": """
        select e.*, a.item_id from events_raw e join aliases a on e.raw_id = a.raw_id""",
    "interactions": """
        select user_id, item_id, event_type, event_value, created_at, liked from (
            select *, row_number() over (partition by user_id, item_id
                order by created_at desc, event_type, event_value, raw_id) as rn
            from resolved)
        where rn = 1""",
    "audience": """
        select item_id, count(distinct user_id) as users from interactions where liked = 1 group by item_id""",
    "popular": """
        select item_id, users, row_number() over (order by users desc, item_id) as rank
        from audience order by users desc, item_id limit 5""",
    "text_counts": _text_counts("documents", "doc_id"),
    "text_holding": "select dim, count(*) as holding from text_counts group by dim",
    "passage_terms": _unit_terms("text_counts", "doc_id"),
    "asked_counts": _text_counts("benchmark", "item_id"),
    "query_terms": _unit_terms("asked_counts", "item_id"),
    "text_scores": """
        select cast(q.item_id as varchar) as query_id, cast(p.doc_id as varchar) as item_id, any_value(d.source) as name,
               round(sum(q.weight * p.weight), 6) as score
        from query_terms q join passage_terms p on p.dim = q.dim join documents d on d.doc_id = p.doc_id
        group by q.item_id, p.doc_id having score > 0""",
    "lexicon": f"select * from (values {_values(LEXICON)}) as v(term, base, food_group)",
    "cuisines": f"select * from (values {_values(CUISINES)}) as v(base, cuisine)",
    "phrases": f"select * from (values {_values(PHRASES)}) as v(term, base, food_group)",
    "phrase_parts": """
        select item_id, meal, creation_ts, generate_subscripts(parts, 1) as pos, unnest(parts) as term from (
            select *, [replace(meal, ' ', '-'), concat('fried ', split_part(ingredients, ', ', 3)), 'sea salt'] as parts
            from menus) z""",
    "phrase_runs": """
        select p.item_id, p.pos, s.i, n.i as size, array_to_string(w[s.i:s.i + n.i - 1], ' ') as phrase
        from (select *, string_split(replace(term, '-', ' '), ' ') as w from phrase_parts) p,
            range(1, 4) s(i), range(1, 3) n(i) where s.i + n.i - 1 <= len(w)""",
    "phrase_found": """
        select item_id, pos, base, food_group from (
            select r.*, x.base, x.food_group, row_number() over (partition by r.item_id, r.pos order by i, size desc) as rn
            from phrase_runs r join phrases x on x.term = r.phrase) z where rn = 1""",
    "phrase_terms": """
        select p.item_id, p.meal, p.creation_ts, p.pos, coalesce(f.base, p.term) as base,
               coalesce(f.food_group, 'other') as food_group
        from phrase_parts p left join phrase_found f on f.item_id = p.item_id and f.pos = p.pos""",
    "phrase_votes": """
        select item_id, cuisine from (
            select item_id, cuisine, row_number() over (partition by item_id order by count(*) desc, cuisine) as rn
            from phrase_terms join cuisines using (base) group by item_id, cuisine) z
        where rn = 1""",
    "terms": """
        select m.item_id, m.meal, m.creation_ts, t.pos, coalesce(l.base, t.term) as base,
               coalesce(l.food_group, 'other') as food_group
        from menus m
        cross join lateral (select unnest(range(1, 1 + len(string_split(m.ingredients, ',')))) as pos,
            unnest(list_transform(string_split(m.ingredients, ','), lambda x: lower(trim(x)))) as term) t
        left join lexicon l on l.term = t.term where t.term <> ''""",
    "roles": """
        select item_id, any_value(meal) as name, any_value(creation_ts) as created_at,
               min(case when food_group = 'protein' then pos end) as p1,
               min(case when food_group = 'grain' then pos end) as p2,
               min(case when food_group = 'vegetable' then pos end) as p3
        from terms group by item_id""",
    "votes": """
        select item_id, cuisine from (
            select item_id, cuisine, row_number() over (partition by item_id order by count(*) desc, cuisine) as rn
            from terms join cuisines using (base) group by item_id, cuisine)
        where rn = 1""",
    "enriched": """
        select r.item_id, r.created_at, r.name,
               coalesce((select base from terms t where t.item_id = r.item_id and t.pos = r.p1), '') as genres,
               coalesce((select base from terms t where t.item_id = r.item_id and t.pos = r.p2), '') as genre_l2,
               coalesce((select base from terms t where t.item_id = r.item_id and t.pos = r.p3), '') as genre_l3,
               coalesce((select string_agg(base, '|' order by pos) from terms t where t.item_id = r.item_id
                   and t.pos not in (coalesce(r.p1, -1), coalesce(r.p2, -1), coalesce(r.p3, -1))), '')
                   as product_description,
               coalesce(v.cuisine, 'none') as content_classification
        from roles r left join votes v on v.item_id = r.item_id""",
    "counts": """
        select name, count(*) as count from (
            select trim(unnest(list_concat(string_split(product_description, '|'), [genres, genre_l2, genre_l3])))
                as name from enriched)
        where name <> '' group by name""",
    "role_sets": """
        select distinct role, name from (
            select 'primary' as role, genres as name from enriched
            union all select 'secondary', genre_l2 from enriched
            union all select 'tertiary', genre_l3 from enriched)
        where trim(name) <> '' and name <> 'none'""",
    "dims": """
        select label, generate_subscripts(embedding, 1) as pos, cast(unnest(embedding) as double) as x
        from embeddings""",
    "centroids": """
        select query_id, list(x order by pos) as q from (
            select cast(label as varchar) as query_id, pos, avg(x) as x from dims group by label, pos)
        group by query_id""",
    "scored": """
        select query_id, cast(vec_id as varchar) as item_id, cast(label as varchar) as name,
               round(list_cosine_similarity(cast(embedding as double[]), q), 6) as score
        from embeddings, centroids""",
    "ranked": """
        select *, row_number() over (partition by query_id order by score desc, item_id) as rank from scored""",
    "menu_hits": """
        select r.query_id, a.item_id, round(max(r.score), 4) as score
        from ranked r join aliases a on a.raw_id = r.item_id where r.rank <= 200
        group by r.query_id, a.item_id""",
    "best_scores": "select item_id, max(score) as score from menu_hits group by item_id",
    "total_users": "select count(distinct user_id) as total from users_raw",
    "order_dates": f"""
        select o_orderkey, case
                 when o_orderpriority = '1-URGENT' then {epoch('o_orderdate')}
                 when o_orderpriority = '2-HIGH' then {epoch('o_orderdate')} + 37800
                 when o_orderpriority = '3-MEDIUM' then {epoch('o_orderdate')}
                 when o_orderpriority = '5-LOW' then {epoch('o_orderdate')} + 86398 end as created_at
        from orders""",
    "picks": """
        select user_id, item_id, score, rank from (
            select taste.user_id, m.item_id, taste.likes * a.users as score,
                   row_number() over (partition by taste.user_id
                       order by taste.likes * a.users desc, m.item_id) as rank
            from (select i.user_id, e.genres, count(*) filter (i.liked = 1) as likes
                  from interactions i join enriched e on e.item_id = i.item_id group by i.user_id, e.genres) taste
            join enriched m on m.genres = taste.genres
            join audience a on a.item_id = m.item_id
            where taste.likes > 0 and not exists (
                select 1 from interactions s where s.user_id = taste.user_id and s.item_id = m.item_id))
        where rank <= 5""",
    "recent": """
        select * from (
            select *, row_number() over (partition by user_id order by created_at desc, item_id) as rank
            from interactions)
        where rank <= 5""",
}

ENRICHED = "item_id, created_at, name, genres, genre_l2, genre_l3, product_description, content_classification"
INTERACTION = """user_id as "USER_ID", raw_id as "ITEM_ID", event_type as "EVENT_TYPE",
    event_value as "EVENT_VALUE", created_at as "TIMESTAMP", liked as "LIKED" """
INTEREST = """concat(shipping_city, '|', shipping_state, '|', locale,
    case when grandpa = '1' then '|grandpa' else '' end, case when subscribed = '1' then '|subscribed' else '' end)"""
COMPARED = {
    "Score": "case when score <> 0 then cast(cast(round(score * 100, 2) as decimal(10,2)) as varchar) else '' end",
    "ID": "item_id", "Type": "content_classification", "Main Ingredient": "genres", "Secondary": "genre_l2",
    "Tertiary": "genre_l3", "Other Ingredients:": "replace(product_description, '|', ',')",
}
COMPARE_CELLS = " union all ".join(
    f"select '{label}' as attribute, rank, {value} as value from shown" for label, value in COMPARED.items())
COMPARE_COLUMNS = ", ".join(f"max(case when rank = {n} then value end) as menu_{n}" for n in range(1, 6))

# Query name: the last named step it needs, and the final select.
SQL = {
    "scan_csv_roundtrip": f"""
        select user_id, menu_item_id, cast(rating as bigint) as rating, {epoch('ts')} as created_at from ratings""",
    "scan_tsv_roundtrip": """
        select user_id, shipping_city, shipping_state, grandpa, subscribed, locale, created_at from users_raw""",
    "header_merge": """
        select item_id as menu_id, creation_ts as "CREATION_TIMESTAMP", item_id as "ITEM_ID",
               cast(ord as varchar) as meal_id, meal as "Meal", ingredients as "Ingredients",
               split_part(ingredients, ', ', 1) as "AllergensContains", replace(ingredients, ', ', chr(10)) as "AllergensMayContains",
               case when ord % 3 = 0 then 'yes' else 'no' end as "Spicy",
               case when ord % 2 = 0 then 'true' else 'false' end as gluten_free from menus_raw""",
    "route_files": """
        select case event_type when 'view' then 'ratings' when 'click' then 'choices'
                    when 'signup' then 'users' when 'purchase' then 'menus' end as dataset, count(*) as n
        from events where event_type <> 'error' group by 1""",
    "quarantine": """
        select event_id, case when event_type <> 'error' then cast(user_id as double) end as score,
               case when event_type = 'error' then concat(event_id, ',', event_type, ',n/a') else '' end as record
        from events""",
    "upsert_latest": "select * from interactions",
    "upsert_snapshots": "select * from interactions",
    "insert_absent": """
        select item_id, meal as name, 'kept' as origin from menus
        union all
        select item_id, meal, 'new' from menus_raw where item_id not in (select item_id from menus)""",
    "scan_table": "select item_id, meal, ingredients, creation_ts from menus_raw",
    "vector_upsert": """
        select cast(vec_id as varchar) as id,
               case when label >= 5 then concat('new-', label) else cast(label as varchar) end as name,
               cast(len(embedding) as bigint) as n_dims,
               round(sqrt(list_sum(list_transform(embedding, lambda x: cast(x as double) * x))), 4) as norm
        from embeddings""",
    "export_items": """
        select item_id as "ITEM_ID", cast(0 as float) as "PRICE", created_at as "CREATION_TIMESTAMP",
               genres as "GENRES", genre_l2 as "GENRE_L2", genre_l3 as "GENRE_L3",
               product_description as "PRODUCT_DESCRIPTION", content_classification as "CONTENT_CLASSIFICATION"
        from enriched""",
    "export_interactions": """
        select user_id as "USER_ID", item_id as "ITEM_ID", event_type as "EVENT_TYPE",
               cast(event_value as float) as "EVENT_VALUE", created_at as "TIMESTAMP" from interactions""",
    "export_users": f"""select user_id as "USER_ID", {INTEREST} as "INTEREST" from users""",
    "menus_project": """
        select item_id as menu_id, creation_ts as "CREATION_TIMESTAMP", item_id as "ITEM_ID",
               cast(ord as varchar) as meal_id, meal as "Meal", ingredients as "Ingredients",
               split_part(ingredients, ', ', 1) as "AllergensContains", replace(ingredients, ', ', chr(10)) as "AllergensMayContains",
               case when ord % 3 = 0 then 'yes' else 'no' end as "Spicy",
               case when ord % 2 = 0 then 'true' else 'false' end as gluten_free from menus_raw""",
    "users_project": """
        select user_id, shipping_city, shipping_state, grandpa, subscribed, locale, created_at from users_raw""",
    "ratings_to_interactions": f"select {INTERACTION} from events_raw where event_type = 'Watch'",
    "choices_to_interactions": f"select {INTERACTION} from events_raw where event_type = 'Click'",
    "choices_manual": f"""
        select user_id, menu_item_id, manual, {epoch('created_at')} as created_at from choices where manual = 'true'""",
    "interactions_union": f"select {INTERACTION} from events_raw",
    "liked_only": "select * from interactions where liked = 1",
    "users_curated": f"""
        select user_id as "USER_ID", {INTEREST} as "INTEREST", shipping_city as "CITY", shipping_state as "STATE",
               locale as "LOCALE", created_at as "CREATED_AT" from users_raw""",
    "menus_curated": """
        select item_id as "ITEM_ID", cast(0 as decimal(10,2)) as "PRICE", created_at as "CREATION_TIMESTAMP",
               name as "NAME", genres as "GENRES", genre_l2 as "GENRE_L2", genre_l3 as "GENRE_L3",
               product_description as "PRODUCT_DESCRIPTION", content_classification as "CONTENT_CLASSIFICATION"
        from enriched""",
    "typed_curated": f"""
        select cast(user_id as varchar) as "USER_ID", cast(event_id as varchar) as "ITEM_ID",
               event_type as "EVENT_TYPE",
               case when event_type <> 'error' then cast(user_id as double) end as "EVENT_VALUE",
               case when event_type <> 'error' then {epoch('ts')} end as "TIMESTAMP",
               case when event_type = 'click' then 1 else 0 end as "LIKED"
        from events""",
    "date_to_epoch": "select * from order_dates",
    "bad_dates": "select count(*) as n_rows, count(*) filter (created_at is null) as n_bad from order_dates",
    "serial_to_epoch": f"select o_orderkey, {epoch('o_orderdate')} + 21600 as created_at from orders",
    "strip_quoted_commas": """
        select doc_id, array_to_string(list_transform(string_split(text, '"'), lambda x, i:
                   case when i % 2 = 0 and i < len(string_split(text, '"')) then replace(x, ',', '') else x end),
                   '"') as cleaned
        from documents""",
    "comma_to_space": "select doc_id, replace(text, ',', ' ') as cleaned from documents",
    "parse_number_prefix": """
        select o_orderkey, cast(split_part(o_orderpriority, '-', 1) as bigint) as priority,
               cast(cast(o_totalprice as decimal(18,2)) as double) as price, cast(null as bigint) as status
        from orders""",
    "split_membership": """
        select ord, user_id, case when locale = 'en' then 1 else 0 end as english,
               case when shipping_state = 'ASIA' or shipping_city = 'ASIA' then 1 else 0 end as asian
        from users_raw""",
    "interest_tags": f"select ord, user_id, {INTEREST} as interest from users_raw",
    "score_pct": "select round(l_discount * 100, 2) as score_pct, count(*) as n from lineitem group by 1",
    "passage_text": """
        select item_id, concat(name, ' ', genres, ' ', genre_l2, ' ', genre_l3, ' ',
                               replace(product_description, '|', ' ')) as passage from enriched""",
    "query_text": """
        select item_id, concat(name, ',', replace(product_description, '|', ',')) as query from enriched""",
    "event_label": """
        select user_id, raw_id, created_at,
               case event_type when 'Watch' then '+3 rating' when 'Click' then 'Selection' else event_type end as label
        from events_raw""",
    "epoch_to_date": """
        select user_id, raw_id, event_type, cast(make_timestamp(created_at * 1000000) as date) as day
        from events_raw""",
    "parse_answer": """
        select p_partkey,
               case when p_type = 'PROMO' then '' else split_part(p_name, ' ', 2) end as genres,
               '' as genre_l2, '' as genre_l3,
               case when p_type = 'PROMO' then '' else concat(split_part(p_name, ' ', 1), '|salt') end
                   as product_description,
               case when p_type = 'PROMO' then 'none' else lower(p_type) end as content_classification
        from part""",
    "lookup_by_key": """
        select * from interactions where user_id = (
            select user_id from interactions group by user_id order by count(*) desc, user_id limit 1)""",
    "alias_resolve": "select * from resolved",
    "menus_by_ids": f"select {ENRICHED} from enriched where item_id in (select item_id from popular)",
    "users_liking_items": """
        select user_id, shipping_city, shipping_state, locale, created_at from users where user_id in (
            select user_id from interactions where liked = 1 and item_id in (select item_id from popular))""",
    "recs_with_names": """
        select p.item_id, p.users, p.rank as number, coalesce(m.meal, 'N/A') as menu_name
        from popular p left join menus m on m.item_id = p.item_id""",
    "interactions_with_names": """
        select e.user_id, e.raw_id as item_id, e.event_type, e.event_value, e.created_at, e.liked,
               coalesce(m.meal, 'Unknown') as menu_name, 'N/A' as price
        from events_raw e left join menus m on m.item_id = e.raw_id""",
    "menus_with_scores": """
        select m.item_id, m.meal as name, coalesce(s.score, 0) as score
        from menus m left join best_scores s on s.item_id = m.item_id""",
    "role_counts": """
        select r.role, r.name, coalesce(c.count, 0) as count from role_sets r left join counts c on c.name = r.name""",
    "other_ingredients": "select name, count from counts where name not in (select name from role_sets)",
    "hits_with_audience": """
        select h.query_id, h.item_id, h.score, coalesce(a.users, 0) as users
        from menu_hits h left join audience a on a.item_id = h.item_id""",
    "collapse_menus": """
        select m.item_id, cast((a.position - 1) // 1000 as bigint) as chunk_no,
               string_agg(a.raw_id, '|' order by a.position) as other_ids, m.meal, m.ingredients, m.creation_ts
        from menus m join (select *, row_number() over (partition by item_id order by ord) as position
                           from aliases) a on a.item_id = m.item_id
        group by m.item_id, (a.position - 1) // 1000, m.meal, m.ingredients, m.creation_ts""",
    "ingredient_counts": "select * from counts",
    "count_users": "select total as users from total_users",
    "audience_size": """
        select count(distinct user_id) as users from interactions where liked = 1
            and item_id in (select item_id from popular where rank <= 3)""",
    "audience_per_item": "select * from audience",
    "role_sets": "select * from role_sets",
    "reach_pct": """
        select item_id, users, cast(floor(100.0 * users / total + 0.5) as bigint) as reach_pct
        from audience, total_users""",
    "dedup_counts": "select count(*) as menus_loaded, count(distinct meal) as menus_kept from menus_raw",
    "dedup_first": "select * from menus",
    "dedup_last": "select * from users",
    "dedup_newest": "select * from interactions",
    "rank_numbers": """
        select name, count, row_number() over (order by count desc, name) as number
        from counts order by count desc, name limit 5""",
    "recent_by_user": "select * from recent",
    "ingredients_sorted": "select * from counts order by count desc, name",
    "ingredients_top50": """
        select name, count(*) as count, greatest(count(*) over () - 50, 0) as remaining
        from (select trim(unnest(string_split(ingredients, ','))) as name from menus_raw)
        where name <> '' group by name order by count desc, name limit 50""",
    "users_page": """
        select user_id, shipping_city, shipping_state, locale, created_at from users order by user_id
        limit 10 offset 10""",
    "vector_cap": "select vec_id, label from embeddings order by vec_id limit 100000",
    "compare_menus": f"""
        select attribute, {COMPARE_COLUMNS} from ({COMPARE_CELLS}) group by attribute""",
    "enrich_menus": f"select {ENRICHED} from enriched",
    "knn_cosine": "select query_id, item_id, name, round(score, 4) as score, rank from ranked where rank <= 5",
    "enrich_phrases": """
        select f.item_id, any_value(creation_ts) as created_at, any_value(meal) as name,
               coalesce(min_by(base, pos) filter (food_group = 'protein'), '') as genres,
               coalesce(min_by(base, pos) filter (food_group in ('grain', 'starch')), '') as genre_l2,
               coalesce(min_by(base, pos) filter (food_group in ('vegetable', 'fruit', 'spice')), '') as genre_l3,
               coalesce(string_agg(base, '|' order by pos) filter (food_group = 'other' or earlier), '') as product_description,
               coalesce(any_value(cuisine), 'none') as content_classification
        from (select *, case when food_group = 'other' then false else row_number() over (partition by item_id,
                  case when food_group = 'protein' then 1 when food_group in ('grain', 'starch') then 2 else 3 end,
                  food_group = 'other' order by pos) > 1 end as earlier from phrase_terms) f
        left join phrase_votes v on v.item_id = f.item_id group by f.item_id""",
    "embed_passages": f"""
        select doc_id, count(*) as terms, {VECTOR_TEXT} as vector from passage_terms group by doc_id""",
    "embed_queries": f"""
        select item_id, count(*) as terms, {VECTOR_TEXT} as vector from query_terms group by item_id""",
    "search_texts": """
        select query_id, item_id, name, round(score, 4) as score, rank from (
            select *, row_number() over (partition by query_id order by score desc, item_id) as rank from text_scores) z
        where rank <= 5""",
    "knn_bounded": "select query_id, item_id, name, round(score, 4) as score, rank from ranked where rank <= 5",
    "knn_ivf_recall": """
        select count(*) as queries, 5 * count(*) as hits, true as recall_reached from embeddings where vec_id % 20 = 0""",
    "most_popular": "select * from popular",
    "picks_affinity": "select * from picks",
    "search_with_audience": """
        select h.query_id, h.item_id, h.score, coalesce(a.users, 0) as users,
               cast(floor(100.0 * coalesce(a.users, 0) / total + 0.5) as bigint) as reach_pct,
               m.meal as name, coalesce(g.search_users, 0) as search_users
        from menu_hits h cross join total_users
        left join audience a on a.item_id = h.item_id left join menus m on m.item_id = h.item_id
        left join (select query_id, count(distinct user_id) as search_users
                   from menu_hits join interactions using (item_id) where liked = 1 group by query_id) g
            on g.query_id = h.query_id""",
    "user_view": """
        select s.section, s.user_id, s.rank, s.item_id, coalesce(m.meal, 'N/A') as menu_name from (
            select 'recent' as section, user_id, rank, item_id from recent
            union all select 'picks', user_id, rank, item_id from picks
            union all select 'popular', 'everybody', rank, item_id from popular) s
        left join menus m on m.item_id = s.item_id""",
    "stream_ingest": f"select {INTERACTION} from events_raw",
    "stream_upsert": "select * from interactions",
    "stream_audience": "select * from audience",
    "stream_counters": "select * from counts",
}
EXTRA_STEPS = {
    "compare_menus": {"shown": """
        select p.rank, e.*, coalesce(s.score, 0) as score from popular p join enriched e on e.item_id = p.item_id
        left join best_scores s on s.item_id = e.item_id"""},
}


def _needed(text: str, steps: dict[str, str]) -> list[str]:
    """Names of the steps that the text reads, and those they read in turn, in order."""
    wanted: set[str] = set()
    pending = [text]
    while pending:
        words = set(pending.pop().replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in words & steps.keys() - wanted:
            wanted.add(name)
            pending.append(steps[name])
    return [name for name in steps if name in wanted]


def oracle_queries() -> dict[str, str]:
    built = {}
    for name, final in SQL.items():
        steps = {**STEPS, **EXTRA_STEPS.get(name, {})}
        parts = [f"{step} as materialized ({steps[step]})" for step in _needed(final, steps)]
        built[name] = (f"with {', '.join(parts)} " if parts else "") + final
    return built
