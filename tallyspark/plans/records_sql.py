"""DuckDB SQL for the record queries."""

from __future__ import annotations

_O = """o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price, o_orderpriority AS priority, o_orderstatus AS status FROM orders)"""
_E = """e AS (SELECT event_id, user_id, event_type, value, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS d, CAST(ts AS DATE) AS day, ts FROM events)"""
_NEW = f"""{_O}, old AS (SELECT o_orderkey, price, status, priority, 1 AS version FROM o),
new AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 3 THEN price END AS price, CASE WHEN o_orderkey % 700 <> 3 THEN status END AS status, priority,
  CASE WHEN o_orderkey % 4 = 1 THEN 2 ELSE 1 END AS version FROM o)"""
#: Later orders of the lowest priority that are closed count in another group.
MOVED = "CASE WHEN CAST(o_orderdate AS DATE) >= DATE '1998-07-01' AND o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS priority"
_MOVE = """a AS (SELECT priority, count(*) AS n FROM o WHERE day < DATE '1998-07-01' GROUP BY 1), b AS (SELECT priority, count(*) AS n FROM o WHERE day >= DATE '1998-07-01' {more} GROUP BY 1),
m AS (SELECT priority, coalesce(a.n, 0) AS from_n, coalesce(b.n, 0) AS to_n, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM a FULL JOIN b USING (priority))"""
_TITLE_WORDS = """list_distinct(list_filter(regexp_extract_all(lower(regexp_extract(html, '<title>([^<]*)</title>', 1)), '[\\p{L}\\p{N}]{3,}'),
  lambda w: w NOT IN ('the','of','and','to','in','a','is','that','for','it','on','with','as','by','at','from','this','are','or','an')))"""

SQL = {
    "rank_top_n_per_group": f"WITH {_O} SELECT priority, o_orderkey, price, CAST(row_number() OVER (PARTITION BY priority ORDER BY price DESC, o_orderkey) AS INTEGER) AS rank FROM o QUALIFY rank <= 30",
    "rank_global_cap": f"WITH {_O} SELECT o_orderkey, day FROM o ORDER BY day DESC, o_orderkey LIMIT 80",
    "rank_round_robin": f"""WITH {_O}, r AS (SELECT priority, o_orderkey, CAST(row_number() OVER (PARTITION BY priority ORDER BY day DESC, o_orderkey) AS INTEGER) AS round FROM o)
      SELECT * FROM r ORDER BY round, priority LIMIT 23""",
    "rank_pick_three": f"""WITH {_O}, a AS (SELECT *, 1 AS pick FROM o ORDER BY day DESC, o_orderkey LIMIT 1),
      b AS (SELECT *, 2 AS pick FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a) ORDER BY price DESC, day DESC, o_orderkey LIMIT 1),
      u AS (SELECT * FROM a UNION ALL SELECT * FROM b),
      c AS (SELECT *, 3 AS pick FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u) ORDER BY priority IN (SELECT priority FROM u), day DESC, o_orderkey LIMIT 1)
      SELECT o_orderkey, pick FROM u UNION ALL SELECT o_orderkey, pick FROM c""",
    "rank_best_by_score": f"""WITH {_O}, s AS (SELECT *, CASE status WHEN 'F' THEN 3 WHEN 'O' THEN 2 ELSE 1 END AS score FROM o)
      SELECT o_custkey, o_orderkey, score FROM s QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY score DESC, day DESC, o_orderkey) = 1""",
    "dedupe_first_wins": f"WITH {_O} SELECT o_custkey, priority, o_orderkey FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey, priority ORDER BY day, o_orderkey) = 1",
    "dedupe_duplicate_texts": "SELECT sha256(coalesce(text, '')) AS digest, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY 1 HAVING count(*) > 1",
    "dedupe_dropped_in_any": f"""WITH {_O}, r AS (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, priority ORDER BY day, o_orderkey) AS a,
      row_number() OVER (PARTITION BY o_custkey, status ORDER BY day, o_orderkey) AS b FROM o) SELECT o_orderkey FROM r WHERE a = 1 AND b = 1""",
    "dedupe_provenance": f"""WITH {_E}, s AS (SELECT DISTINCT user_id, event_type, CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END AS r FROM e),
      g AS (SELECT user_id, first(event_type ORDER BY r, event_type) AS owner, list(event_type ORDER BY event_type) AS every FROM s GROUP BY user_id)
      SELECT user_id, owner, array_to_string(list_filter(every, lambda x: x <> owner), ',') AS also FROM g""",
    "dedupe_repeat_marks": f"""WITH {_O}, f AS (SELECT o_orderkey, first_value(o_orderkey) OVER (PARTITION BY o_custkey, priority ORDER BY day, o_orderkey) AS first FROM o)
      SELECT o_orderkey, CASE WHEN first <> o_orderkey THEN first END AS repeats FROM f""",
    "dedupe_merge_spans": f"""WITH {_E}, s AS (SELECT user_id, d AS start, d + CAST(floor(value / 20) AS INTEGER) AS stop FROM e),
      covered AS (SELECT DISTINCT user_id, unnest(range(start, stop + 1)) AS x FROM s),
      i AS (SELECT user_id, x, x - row_number() OVER (PARTITION BY user_id ORDER BY x) AS g FROM covered),
      m AS (SELECT user_id, CAST(min(x) AS INTEGER) AS start, CAST(max(x) AS INTEGER) AS stop FROM i GROUP BY user_id, g)
      SELECT m.user_id, m.start, m.stop AS "end", (SELECT count(*) FROM s WHERE s.user_id = m.user_id AND s.start BETWEEN m.start AND m.stop) AS n FROM m""",
    "dedupe_same_keys": f"""WITH {_E}, a AS (SELECT DISTINCT user_id FROM e WHERE d < 15), b AS (SELECT DISTINCT user_id FROM e WHERE d >= 15),
      c AS (SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS only_left, (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS only_right)
      SELECT only_left, only_right, only_left = 0 AND only_right = 0 AS agree FROM c""",
    "dedupe_anchored_groups": f"""WITH RECURSIVE {_E}, days AS (SELECT DISTINCT user_id, day FROM e),
      anchors AS (SELECT user_id, min(day) AS day FROM days GROUP BY user_id UNION ALL
        SELECT a.user_id, (SELECT min(d.day) FROM days d WHERE d.user_id = a.user_id AND date_diff('day', a.day, d.day) > 5) AS day FROM anchors a WHERE a.day IS NOT NULL)
      SELECT e.event_id, CAST((SELECT count(*) FROM anchors a WHERE a.user_id = e.user_id AND a.day <= e.day) AS INTEGER) AS "group" FROM e""",
    "dedupe_first_fit_groups": f"""WITH RECURSIVE {_E}, r AS (SELECT user_id, event_id, date_diff('day', DATE '2024-01-01', day) AS d, row_number() OVER (PARTITION BY user_id ORDER BY day, event_id) AS i FROM e),
      fold AS (SELECT user_id, event_id, 1 AS i, [[d]] AS groups, CAST(0 AS BIGINT) AS g FROM r WHERE i = 1
        UNION ALL SELECT user_id, event_id, i, CASE WHEN p = 0 THEN list_append(groups, [d]) ELSE list_concat(list_concat(groups[:p - 1], [list_append(groups[p], d)]), groups[p + 1:]) END,
          CASE WHEN p = 0 THEN len(groups) ELSE p - 1 END FROM (
          SELECT f.user_id, r.event_id, r.i, r.d, f.groups, coalesce(list_position(list_transform(f.groups, lambda g: list_max(g) - r.d <= 6 AND r.d - list_min(g) <= 6), true), 0) AS p
          FROM fold f JOIN r ON r.user_id = f.user_id AND r.i = f.i + 1))
      SELECT user_id, event_id, CAST(g AS INTEGER) AS "group" FROM fold""",
    "dedupe_alike_titles": f"""WITH p AS (SELECT page_id, {_TITLE_WORDS} AS w, page_id % 5 AS d FROM pages),
      j AS (SELECT a.page_id AS a, b.page_id AS b, len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) AS similarity
        FROM p a JOIN p b ON a.page_id < b.page_id AND abs(a.d - b.d) <= 2 AND len(a.w) > 0 AND len(b.w) > 0)
      SELECT a, b, round(similarity, 6) AS similarity FROM j WHERE similarity >= 0.6::DOUBLE""",
    "dedupe_kept_titles": f"""WITH RECURSIVE p AS (SELECT page_id, {_TITLE_WORDS} AS w FROM pages),
      j AS (SELECT b.page_id AS b, list(a.page_id) AS partners FROM p a JOIN p b ON a.page_id < b.page_id AND len(a.w) > 0 AND len(b.w) > 0
        WHERE len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) >= 0.6::DOUBLE GROUP BY 1),
      r AS (SELECT page_id, row_number() OVER (ORDER BY page_id) AS n, coalesce(partners, []) AS partners FROM p LEFT JOIN j ON b = page_id),
      g AS (SELECT CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS kept UNION ALL
        SELECT r.n, CASE WHEN len(list_intersect(g.kept, r.partners)) > 0 THEN g.kept ELSE list_append(g.kept, r.page_id) END FROM g JOIN r ON r.n = g.n + 1)
      SELECT unnest(kept) AS page_id FROM g WHERE n = (SELECT max(n) FROM r)""",
    "dedupe_near_duplicates": f"""WITH p AS (SELECT page_id, {_TITLE_WORDS} AS w, page_id % 5 AS d, regexp_extract(url, '^([^?#]*)', 1) AS link,
        list_distinct(regexp_extract_all(regexp_extract(html, '<title>([^<]*)</title>', 1), '(?:^|[^\\p{{L}}\\p{{N}}])(\\p{{Lu}}[\\p{{L}}\\p{{N}}]{{2,}})', 1)) AS n FROM pages)
      SELECT DISTINCT b.page_id AS b FROM p a JOIN p b ON a.page_id < b.page_id WHERE a.link <> '' AND a.link = b.link OR len(a.w) > 0 AND list_sort(a.w) = list_sort(b.w)
        OR abs(a.d - b.d) <= 2 AND len(list_distinct(list_concat(a.w, b.w))) > 0 AND (len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) >= 0.6::DOUBLE
          OR len(list_intersect(a.n, b.n)) >= 2 AND len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) >= 0.2::DOUBLE)""",
    "dedupe_unique_slugs": """WITH c AS (SELECT c_custkey, lower(c_mktsegment) AS base, c_nationkey AS region FROM customer),
      f AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY c_custkey) = 1 AS first FROM c),
      k AS (SELECT *, row_number() OVER (PARTITION BY base, region, first ORDER BY c_custkey) AS k FROM f)
      SELECT c_custkey, CASE WHEN first THEN base WHEN k = 1 THEN base || '-' || region ELSE base || '-' || region || '-' || k END AS slug FROM k""",
    "ids_check_digit": """WITH b AS (SELECT p_partkey, upper(left(replace(p_name, ' ', ''), 3)) || lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') AS base FROM part),
      v AS (SELECT p_partkey, base, i, (instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ*@#', base[i]) - 1) * CASE WHEN i % 2 = 0 THEN 2 ELSE 1 END AS v FROM b, range(1, 9) t(i))
      SELECT p_partkey, base, CAST((10 - sum(v // 10 + v % 10) % 10) % 10 AS INTEGER) AS digit FROM v GROUP BY ALL""",
    "text_chunks": """WITH RECURSIVE d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) > 0),
      c AS (SELECT doc_id, text, n, 0 AS k, 0 AS start, substr(text, 1, 8000) AS piece FROM d),
      step AS (SELECT doc_id, text, n, k, start, piece, CASE WHEN start + 8000 >= n THEN n - start
        WHEN strpos(reverse(piece), chr(10)) > 0 AND length(piece) - strpos(reverse(piece), chr(10)) + 1 > 4000 THEN length(piece) - strpos(reverse(piece), chr(10)) + 1 ELSE 8000 END AS len FROM c
        UNION ALL SELECT doc_id, text, n, k + 1, start + len - 400, substr(text, start + len - 400 + 1, 8000),
          CASE WHEN start + len - 400 + 8000 >= n THEN n - (start + len - 400)
            WHEN strpos(reverse(substr(text, start + len - 400 + 1, 8000)), chr(10)) > 0 AND 8000 - strpos(reverse(substr(text, start + len - 400 + 1, 8000)), chr(10)) + 1 > 4000
            THEN 8000 - strpos(reverse(substr(text, start + len - 400 + 1, 8000)), chr(10)) + 1 ELSE 8000 END
        FROM step WHERE start + 8000 < n)
      SELECT doc_id, CAST(k AS INTEGER) AS k, CAST(start AS INTEGER) AS start, CAST(len AS INTEGER) AS n FROM step""",
    "state_deadline_ledger": f"""WITH {_E}, s AS (SELECT user_id AS id, day, CASE WHEN event_type = 'purchase' THEN day + CAST(floor(value) AS INTEGER) END AS closing FROM e WHERE event_type IN ('purchase', 'error')),
      f AS (SELECT id, max(closing) AS hit FROM s WHERE day <= DATE '2024-01-15' GROUP BY id),
      one AS (SELECT id, hit AS closing, CASE WHEN hit IS NOT NULL THEN DATE '2024-01-15' END AS seen, CASE WHEN hit IS NULL THEN 1 ELSE 0 END AS misses FROM f WHERE hit IS NULL OR hit >= DATE '2024-01-15'),
      g AS (SELECT id, max(closing) AS hit FROM s WHERE day > DATE '2024-01-15' GROUP BY id)
      SELECT id, coalesce(g.hit, one.closing) AS closing, CASE WHEN g.hit IS NOT NULL THEN coalesce(one.seen, DATE '2024-01-31') ELSE one.seen END AS first_seen,
        CASE WHEN g.hit IS NOT NULL THEN DATE '2024-01-31' ELSE one.seen END AS last_seen,
        CAST(CASE WHEN g.hit IS NOT NULL THEN 0 WHEN g.id IS NOT NULL THEN coalesce(one.misses, 0) + 1 ELSE coalesce(one.misses, 0) END AS INTEGER) AS misses
      FROM one FULL JOIN g USING (id) WHERE coalesce(g.hit, one.closing) IS NULL OR coalesce(g.hit, one.closing) >= DATE '2024-01-31'""",
    "state_retention": f"""WITH {_E}, p AS (SELECT user_id, CAST(user_id % 7 AS INTEGER) AS grp, max(day) AS last_confirmed FROM e WHERE d < 28 GROUP BY ALL),
      n AS (SELECT DISTINCT user_id, CAST(user_id % 7 AS INTEGER) AS grp FROM e WHERE d >= 28)
      SELECT user_id, grp, DATE '2024-01-29' AS last_confirmed, false AS unconfirmed FROM n UNION ALL
      SELECT user_id, grp, last_confirmed, true FROM p WHERE grp IN (SELECT grp FROM n WHERE grp < 4) AND user_id NOT IN (SELECT user_id FROM n)
        AND date_diff('day', last_confirmed, DATE '2024-01-29') <= 7""",
    "state_archive": f"""WITH {_E}, s AS (SELECT user_id, min(day) AS f, max(day) AS l FROM e WHERE d < 29 GROUP BY 1 UNION ALL SELECT DISTINCT user_id, DATE '2024-01-30', DATE '2024-01-30' FROM e WHERE d >= 29)
      SELECT user_id, min(f) AS first_seen, max(l) AS last_seen FROM s GROUP BY 1 HAVING date_diff('day', max(l), DATE '2024-01-30') <= 10""",
    "state_slug_registry": """WITH c AS (SELECT c_custkey, concat('seg-', c_nationkey, '-', c_custkey % 50) AS slug FROM customer),
      k AS (SELECT * FROM c WHERE c_custkey % 3 = 0 QUALIFY row_number() OVER (PARTITION BY slug ORDER BY c_custkey) = 1),
      n AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY c_custkey) AS i FROM c WHERE c_custkey NOT IN (SELECT c_custkey FROM k))
      SELECT * FROM k UNION ALL SELECT c_custkey, CASE WHEN i > 1 OR slug IN (SELECT slug FROM k) THEN slug || '-' || c_custkey ELSE slug END FROM n""",
    "state_absence_spells": f"""WITH {_E}, p AS (SELECT DISTINCT user_id, d FROM e), w AS (SELECT *, d - lag(d) OVER (PARTITION BY user_id ORDER BY d) > 1 AS back FROM p)
      SELECT user_id, min(d) AS first_day, max(d) AS last_day, count(*) AS days, count(*) FILTER (WHERE back) AS returns FROM w GROUP BY 1""",
    "state_freshness": f"""WITH {_E}, g AS (SELECT user_id, max(ts) AS l, last(event_type ORDER BY ts, event_id) AS kind FROM e GROUP BY 1),
      a AS (SELECT user_id, kind, CAST(floor((epoch(TIMESTAMP '2024-01-31 00:00:00') - floor(epoch(l))) / 3600) AS BIGINT) AS age FROM g)
      SELECT user_id, age, CASE WHEN age <= 36 THEN 'fresh' WHEN kind = 'error' THEN 'degraded' WHEN age <= 54 THEN 'not-due' ELSE 'stale' END AS status FROM a""",
    "state_transitions": """WITH s AS (SELECT conv_id, turn, CASE WHEN length(text) < 60 THEN 'silent' WHEN contains(text, '?') THEN 'asks' ELSE role END AS state FROM conversations),
      w AS (SELECT *, last_value(CASE WHEN state <> 'silent' THEN state END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)
      SELECT conv_id, turn, state, before, CASE WHEN state = 'silent' THEN 'silent' WHEN before IS NULL THEN 'first' WHEN before = state THEN 'same' ELSE 'changed' END AS kind FROM w""",
    "state_signature_changes": f"""WITH {_O}, q AS (SELECT *, CAST(year(day) * 4 + quarter(day) - 1 AS INTEGER) AS q FROM o), n AS (SELECT priority, q, count(*) AS s FROM q GROUP BY ALL),
      p AS (SELECT priority, q, count(*) AS s FROM q WHERE o_orderkey % 500 <> 7 GROUP BY ALL),
      c AS (SELECT n.priority, n.q FROM n LEFT JOIN p USING (priority, q) WHERE n.s IS DISTINCT FROM p.s)
      SELECT * FROM c UNION SELECT c.priority, c.q + 1 FROM c JOIN n ON n.priority = c.priority AND n.q = c.q + 1""",
    "join_group_movement": f"WITH {_O}, {_MOVE.format(more='')} SELECT * FROM m",
    "contract_counts": f"""WITH {_O}, c AS (SELECT count(*) FILTER (day < DATE '1998-07-01') AS b, count(*) FILTER (day >= DATE '1998-07-01') AS n FROM o)
      SELECT 'least_rows' AS name, CAST(n AS DOUBLE) AS value, n >= 200 AS ok FROM c UNION ALL SELECT 'ratio', n / b, n / b BETWEEN 0.6::DOUBLE AND 2 FROM c""",
    "contract_fields": """SELECT name, value, value = 0 AS ok FROM (SELECT 'doc_id' AS name, count(*) FILTER (doc_id IS NULL) AS value FROM documents UNION ALL
      SELECT 'text', count(*) FILTER (coalesce(trim(text), '') = '') FROM documents UNION ALL SELECT 'lang', count(*) FILTER (coalesce(trim(lang), '') = '') FROM documents UNION ALL
      SELECT 'source', count(*) FILTER (coalesce(trim(source), '') = '') FROM documents)""",
    "contract_groups": f"WITH {_O.replace('o_orderpriority AS priority', MOVED)}, {_MOVE.format(more='')} SELECT *, from_n < 20 OR to_n * 2 > from_n AS ok FROM m",
    "contract_stamps": f"""WITH {_O} SELECT 'stamp_age' AS name, CAST(DATE '1998-08-01' - m AS DOUBLE) AS value, coalesce(DATE '1998-08-01' - m BETWEEN 0 AND 30, false) AS ok, status
      FROM (SELECT s AS status, (SELECT max(day) FROM o WHERE o.status = s) AS m FROM (VALUES ('F'), ('O'), ('P'), ('X')) v(s))""",
    "contract_shrinks": f"""WITH {_O}, g AS (SELECT o_custkey || '/' || status AS own, count(*) FILTER (day < DATE '1995-06-01') AS from_n, count(*) FILTER (day >= DATE '1995-06-01') AS to_n FROM o GROUP BY 1)
      SELECT own, from_n, to_n, to_n - from_n AS delta, to_n >= from_n AS ok FROM g WHERE from_n > 0""",
    "contract_immutable": f"""WITH {_O}, a AS (SELECT o_orderkey AS k, price, CASE WHEN o_orderkey % 11 <> 0 THEN status END AS status, status AS s FROM o WHERE day < DATE '1998-01-01'),
      b AS (SELECT k, k % 13 <> 0 OR s = 'O' AS there, k % 7 = 0 AS p, CASE WHEN k % 22 <> 0 THEN s END IS DISTINCT FROM status AS t FROM a)
      SELECT k AS o_orderkey, CASE WHEN there THEN 'changed' ELSE 'gone' END AS change, CASE WHEN there THEN concat_ws(',', CASE WHEN p THEN 'price' END, CASE WHEN t THEN 'status' END) END AS fields FROM b WHERE NOT there OR p OR t""",
    "contract_field_losses": f"""WITH {_NEW}, c AS (SELECT f AS field, count(*) FILTER (CASE f WHEN 'price' THEN o.price IS NOT NULL WHEN 'status' THEN o.status IS NOT NULL ELSE o.priority IS NOT NULL END) AS had,
      count(*) FILTER (CASE f WHEN 'price' THEN n.price IS NULL WHEN 'status' THEN n.status IS NULL ELSE n.priority IS NULL END) AS lost
      FROM old o JOIN new n USING (o_orderkey), (VALUES ('price'), ('status'), ('priority')) t(f) GROUP BY f)
      SELECT *, lost >= 25 AND lost > 0.05 * had AS refused FROM c""",
    "contract_protect": f"""WITH {_NEW} SELECT n.o_orderkey, CASE WHEN n.version > o.version THEN n.price ELSE coalesce(n.price, o.price) END AS price,
      CASE WHEN n.version > o.version THEN n.status ELSE coalesce(n.status, o.status) END AS status, n.version,
      CAST(CASE WHEN n.version > o.version THEN 0 ELSE (n.price IS NULL)::INT + (n.status IS NULL)::INT END AS INTEGER) AS restored FROM new n JOIN old o USING (o_orderkey)""",
    "join_field_changes": f"""WITH {_NEW} SELECT n.o_orderkey, 'price' AS field, 'lost' AS change FROM new n WHERE n.price IS NULL UNION ALL SELECT n.o_orderkey, 'status', 'lost' FROM new n WHERE n.status IS NULL""",
    "join_refresh": f"WITH {_O} SELECT o_orderkey, CASE WHEN status = 'O' OR day >= DATE '1998-07-01' THEN 'new' ELSE status END AS status FROM o",
    "join_carry_forward": f"WITH {_O} SELECT o_orderkey, false AS carried FROM o WHERE day >= DATE '1998-07-01' UNION ALL SELECT o_orderkey, true FROM o WHERE day < DATE '1998-07-01' AND priority < '3'",
    "join_unambiguous": """SELECT o_custkey || '/' || strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS month, min(o_orderpriority) AS priority FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = 1""",
    "join_fill_from_group": """WITH p AS (SELECT p_partkey, p_size AS grp, CASE WHEN p_partkey % 3 = 0 THEN CASE WHEN p_size % 2 = 0 THEN 'even' ELSE p_type END END AS label FROM part),
      g AS (SELECT grp, min(label) AS l FROM p GROUP BY 1 HAVING count(DISTINCT label) = 1) SELECT p_partkey, p.grp, coalesce(label, l) AS label FROM p LEFT JOIN g USING (grp)""",
    "join_longest_prefix": """WITH t AS (SELECT * FROM (VALUES ('10', 'ten'), ('101', 'ten-one'), ('12', 'twelve'), ('1234', 'run'), ('55', 'double')) v(prefix, value))
      SELECT c.code, t.value, t.prefix FROM (SELECT CAST(c_custkey AS VARCHAR) AS code FROM customer) c LEFT JOIN t ON starts_with(c.code, t.prefix)
      QUALIFY row_number() OVER (PARTITION BY c.code ORDER BY length(t.prefix) DESC NULLS LAST) = 1""",
    "join_effective_on": f"""WITH {_O}, t AS (SELECT priority, f::DATE AS f, u::DATE AS u, value FROM (VALUES ('1-URGENT', NULL, '1997-12-31', 'a'), ('1-URGENT', '1998-01-01', NULL, 'b'),
      ('2-HIGH', '1996-01-01', '1999-12-31', 'c'), ('2-HIGH', '1999-01-01', NULL, 'd')) v(priority, f, u, value)),
      g AS (SELECT o.o_orderkey, o.priority, o.day, count(t.value) AS n, min(t.value) AS v FROM o LEFT JOIN t ON t.priority = o.priority AND (f IS NULL OR f <= day) AND (u IS NULL OR u >= day) GROUP BY ALL)
      SELECT o_orderkey, priority, day, CASE WHEN n = 1 THEN v END AS value, CASE WHEN n = 1 THEN 'resolved' WHEN n > 1 THEN 'ambiguous' ELSE 'unresolved' END AS status FROM g""",
    "rules_first_match": "SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN 'value' WHEN p_type IN ('STANDARD', 'MEDIUM') THEN 'core' WHEN p_type = 'LARGE' THEN 'premium' ELSE 'other' END AS label FROM part",
    "rules_row_problems": r"""WITH c AS (SELECT doc_id, [CASE WHEN NOT coalesce(length(text) >= 40, false) THEN 'short' END, CASE WHEN NOT coalesce(lang IN ('en', 'de', 'fr', 'es'), false) THEN 'lang' END,
      CASE WHEN NOT coalesce(NOT regexp_matches(text, '[#*$%&|<>]{3}'), false) THEN 'symbols' END, CASE WHEN NOT coalesce(n_chars <= 20000, false) THEN 'long' END] AS p FROM documents)
      SELECT doc_id, list_filter(p, lambda x: x IS NOT NULL)[1] AS first, array_to_string(list_filter(p, lambda x: x IS NOT NULL), ',') AS every FROM c""",
    "text_canonical_url": r"""WITH u AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS b FROM pages),
      s AS (SELECT page_id, regexp_replace(lower(regexp_extract(b, '^[a-zA-Z]+://([^/?]*)', 1)), '^(www|m)\.', '') AS host, regexp_replace(regexp_extract(b, '^[a-zA-Z]+://[^/?]*([^?]*)', 1), '/+$', '') AS path,
        list_sort(list_filter(string_split(regexp_extract(b, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid|source)='))) AS q FROM u)
      SELECT page_id, host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url FROM s""",
    "text_html": r"""WITH t AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)\b.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g') AS b FROM pages),
      d AS (SELECT page_id, replace(replace(replace(replace(replace(replace(b, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS b FROM t)
      SELECT page_id, trim(regexp_replace(b, '\s+', ' ', 'g')) AS body FROM d""",
    "text_links": """WITH l AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS h FROM pages)
      SELECT page_id, CAST(k - 1 AS INTEGER) AS k, h[k] AS href FROM (SELECT page_id, h, unnest(range(1, len(h) + 1)) AS k FROM l)""",
    "text_folded_names": r"""SELECT c_custkey, replace(trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) || ' and sohne holdings inc', ' ', '-') AS slug,
      trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) || ' and sohne' AS core, 'BRK-B' AS ticker FROM customer""",
    "text_line_ratios": """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL), g AS (SELECT doc_id, line, count(*) AS n FROM l WHERE line <> '' GROUP BY ALL)
      SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_lines, round(max(n) / sum(n), 6) AS edge_ratio FROM g GROUP BY 1""",
    "text_excerpt_caps": r"""SELECT item_id, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS n_words, len(regexp_extract_all(text, '\S+')) <= 30 AND length(text) <= 220 AS fits FROM benchmark""",
    "dates_quarters": f"""WITH {_O} SELECT o_orderkey, concat(year(day), 'Q', quarter(day)) AS quarter,
      concat(year(day - INTERVAL 3 MONTH), 'Q', quarter(date_trunc('quarter', day) - INTERVAL 1 DAY)) AS previous,
      concat(year(q), 'Q', quarter(q)) AS due, CAST(day + ((5 - isodow(day) + 7) % 7)::INTEGER AS DATE) AS friday
      FROM (SELECT *, date_trunc('quarter', day - 48) - INTERVAL 1 DAY AS q FROM o)""",
    "agg_histogram": f"""WITH {_O}, b AS (SELECT CASE WHEN price < 250 THEN 'a' WHEN price < 1000 THEN 'b' WHEN price < 50000 THEN 'c' WHEN price < 200000 THEN 'd' ELSE 'e' END AS bucket FROM o)
      SELECT l.bucket, count(b.bucket) AS n FROM (SELECT unnest(['a', 'b', 'c', 'd', 'e']) AS bucket) l LEFT JOIN b USING (bucket) GROUP BY 1""",
    "agg_summary_counts": f"""WITH {_O} SELECT priority, count(*) FILTER (status = 'F') AS "F", count(*) FILTER (status = 'O') AS "O", count(*) FILTER (status = 'P') AS "P" FROM o GROUP BY 1""",
    "agg_set_statistics": f"WITH {_O} SELECT priority, median(price) AS median, round(avg(price), 4) AS mean, count(price) AS n FROM o GROUP BY 1",
    "agg_mode_by_repetition": f"""WITH {_O}, g AS (SELECT o_custkey, priority, count(*) AS n, min(o_orderkey) AS f FROM o GROUP BY ALL)
      SELECT o_custkey, priority AS mode FROM g QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, f) = 1""",
    "agg_score_grade": f"""WITH {_O}, s AS (SELECT o_custkey, CAST(least(count(*), 5) * 8 + least(count(DISTINCT priority), 8) * 5 + 20 AS BIGINT) AS score FROM o GROUP BY 1)
      SELECT o_custkey, score, CASE WHEN score >= 80 THEN 'A' WHEN score >= 60 THEN 'B' WHEN score >= 40 THEN 'C' ELSE 'D' END AS grade FROM s""",
}
