"""DuckDB SQL for the queries that SQL can express."""

SQL: dict[str, str] = {}

SQL["op1_quality_ledger"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), m AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, w,
         array_to_string(w, '') AS c,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d
), g AS (
  SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM m)
), two AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1
), rep AS (
  SELECT r, count(DISTINCT i + k) AS n FROM two, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), v AS (
  SELECT doc_id, n_words, CAST(length(c) AS BIGINT) AS word_chars,
         CAST(length(c) - length(regexp_replace(c, '[#*$%&|<>]+', '', 'g')) AS BIGINT)
           AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(length(c) - length(regexp_replace(c, '\p{Lu}+', '', 'g')) AS BIGINT) AS n_upper
  FROM m LEFT JOIN rep USING (r)
), b AS (
  SELECT *, CAST(n_words < 50 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 50 * n_words AS BIGINT)
    + 4 * CAST(10 * n_symbols > word_chars AS BIGINT)
    + 8 * CAST(2 * n_dup_lines > n_lines AS BIGINT)
    + 16 * CAST(10 * n_upper > 3 * word_chars AS BIGINT)
    + 32 * CAST(word_chars < 2 * n_words AS BIGINT)
    + 64 * CAST(word_chars > 20 * n_words AS BIGINT) AS fail_bits
  FROM v
)
SELECT *, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept FROM b
"""

SQL["ledger_ablation"] = f"""
WITH j AS ({SQL["op1_quality_ledger"]}),
bits(rule, bit) AS (
  VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4), ('repeated_lines', 8),
         ('shouting', 16), ('short_words', 32), ('long_words', 64)
), policies(policy, everything) AS (VALUES ('base-1', 3), ('base-2', 11), ('text-1', 127))
SELECT policy, rule,
       CAST(coalesce(sum(CAST((fail_bits & bit) <> 0 AS INT)), 0) AS BIGINT) AS n_failed,
       CAST(coalesce(sum(CAST((fail_bits & everything) = bit AS INT)), 0) AS BIGINT) AS n_only,
       CAST(coalesce(sum(CAST((fail_bits & everything) = 0 AS INT)), 0) AS BIGINT) AS n_kept
FROM policies JOIN bits ON (everything & bit) <> 0 CROSS JOIN j
GROUP BY policy, rule
"""

SQL["op9_warc_revisits"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n
  FROM pages
), r AS (
  SELECT page_id, n, sha1(html) AS digest,
         CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS top
  FROM p
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM r
"""

SQL["op6_near_duplicates"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id,
       doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)
"""

SQL["op7_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), v AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 8, 2))) AS i
        FROM b WHERE len(w) > 0)
), s AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, greatest(CAST(len(w) AS BIGINT) - n + 2, 1))) AS i
        FROM d, (SELECT DISTINCT n FROM v))
), h AS (
  SELECT DISTINCT s.r, s.i, s.n, v.item_id FROM s JOIN v USING (n, g)
), c AS (
  SELECT r, count(DISTINCT i + k) AS n_hit
  FROM (SELECT r, i, unnest(range(0, n)) AS k FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY r
), t AS (
  SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""

SQL["op8_chat_snapshots"] = r"""
WITH t AS (
  SELECT DISTINCT conv_id, coalesce(turn, -4611686018427387904) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, pos, string_agg(role || chr(1) || text || chr(2), '' ORDER BY role, text) AS s
  FROM t GROUP BY conv_id, pos
), p AS (
  SELECT conv_id, pos, max(pos) OVER (PARTITION BY conv_id) AS top,
         string_agg(CAST(pos AS VARCHAR) || chr(3) || s, '') OVER (
           PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS h
  FROM c
), e AS (
  SELECT conv_id, h, min(conv_id) OVER (PARTITION BY h) AS least FROM p WHERE pos = top
), k AS (
  SELECT conv_id FROM e
  WHERE conv_id = least AND h NOT IN (SELECT h FROM p WHERE pos < top)
), b AS (
  SELECT conv_id, CAST(floor(pos / 256) AS BIGINT) AS block, count(*) AS n_turns,
         string_agg('<|' || regexp_replace(role, '\|(\\*)>', '|\\\1>', 'g') || '|>' || chr(10)
                    || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|end|>' || chr(10), ''
                    ORDER BY pos, role, text) AS s
  FROM t WHERE conv_id IN (SELECT conv_id FROM k) GROUP BY ALL
)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY block) - 1 AS segment, n_turns,
       CAST(strlen(s) AS BIGINT) AS n_bytes, sha256(s) AS text_sha256
FROM b
"""


def _clusters_sql(k: int = 16, rounds: int = 3) -> str:
    """Rounds of assigning and moving, one pair of CTEs a round; c0 are the first centroids."""

    def assigned(n: int) -> str:
        # the nearest centroid, ties by number; the distance is exact in integers
        return f"""a{n} AS (
  SELECT r, min_by(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT x.r, y.c, CAST(sum((x.e - y.e) * (x.e - y.e)) AS BIGINT) AS d
    FROM x JOIN c{n} y USING (j) GROUP BY ALL) GROUP BY r
)"""

    def moved(n: int) -> str:
        # floor of an exact quotient: the remainder is made non-negative first
        return f"""m{n} AS (
  SELECT a{n}.c, j, CAST(sum(e) AS BIGINT) AS s, count(*) AS n
  FROM x JOIN a{n} USING (r) GROUP BY ALL
), c{n + 1} AS (
  SELECT o.c, o.j, coalesce((s - ((s % n) + n) % n) // n, o.e) AS e
  FROM c{n} o LEFT JOIN m{n} USING (c, j)
)"""

    steps = ", ".join(f"{assigned(n)}, {moved(n)}" for n in range(rounds))
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda z: z IS NOT NULL AND isfinite(z))) = 64
), x AS (
  SELECT r, j, CAST(floor(64 * CAST(embedding[j] AS DOUBLE)) AS BIGINT) AS e
  FROM v, (SELECT unnest(range(1, 65)) AS j)
), f AS (
  SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c
  FROM v WHERE vec_id IS NOT NULL ORDER BY c LIMIT {k}
), c0 AS (
  SELECT c, j, e FROM x JOIN f USING (r)
), {steps}, {assigned(rounds)}, h AS (
  SELECT c, sha256(string_agg(e, ',' ORDER BY j)) AS h FROM c{rounds} GROUP BY c
)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM v JOIN a{rounds} USING (r) JOIN h USING (c)
"""


SQL["op12_centroid_clusters"] = _clusters_sql()


def _repair_sql() -> str:
    """Labels are eight digits of cost and the audit, so that text order is label order.

    l0 to l3 are the best labels with nothing kept, a system, a user and an assistant turn
    kept last; NULL where there is none, which least() passes over.
    """

    def plus(label: str, cost: str, edit: str) -> str:
        return f"lpad(CAST(CAST({label}[1:8] AS BIGINT) + {cost} AS VARCHAR), 8, '0') || {label}[9:] || '{edit}'"

    # inserts: user after nothing, system or assistant; then assistant after user
    closed = f"""
    SELECT g, i, l0, l1, l2, least(l3, {plus("l2", "5", "I")}) AS l3 FROM (
      SELECT g, i, l0, l1, l3, least(l2, {plus("l0", "5", "I")}, {plus("l1", "5", "I")},
        {plus("l3", "5", "I")}) AS l2 FROM"""
    before_user = ["l0", "l1", "l3"]
    to_user = ", ".join(
        f"CASE WHEN NOT gone THEN {plus(x, 'stay + 1', 'R')} END, "
        f"CASE WHEN NOT gone AND r = 'u' THEN {plus(x, 'stay', 'K')} END"
        for x in before_user
    )
    return f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda c: CAST(ascii(c) AS BIGINT))),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS hit
  FROM conversations, crc
), ids AS (
  SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations)
), dam AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN hit = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM o WHERE hit <> 0
), n AS (
  SELECT g, turn, role, text, role[1:1] AS r,
    row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY g, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM dam JOIN ids ON dam.conv_id IS NOT DISTINCT FROM ids.conv_id
), f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
    WHEN nth > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' END AS fault
  FROM n
), h AS (
  SELECT g, i, r, role, text, turn, fault, coalesce(fault IN ('blank', 'duplicate'), false) AS gone,
    CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS stay, lag(r) OVER (PARTITION BY g ORDER BY i) AS p
  FROM f
), c AS (
  SELECT g, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (p IS NOT NULL AND p || r NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM h GROUP BY g
), dp AS ({closed} (
      SELECT g, CAST(0 AS BIGINT) AS i, '00000000' AS l0, CAST(NULL AS VARCHAR) AS l1,
             CAST(NULL AS VARCHAR) AS l2, CAST(NULL AS VARCHAR) AS l3 FROM c))
  UNION ALL {closed} (
      SELECT dp.g, h.i, {plus("l0", "2", "D")} AS l0,
        least({plus("l1", "2", "D")},
              CASE WHEN NOT gone AND r = 's' THEN {plus("l0", "stay", "K")} END) AS l1,
        least({plus("l2", "2", "D")}, {to_user}) AS l2,
        least({plus("l3", "2", "D")}, CASE WHEN NOT gone THEN {plus("l2", "stay + 1", "R")} END,
              CASE WHEN NOT gone AND r = 'a' THEN {plus("l2", "stay", "K")} END) AS l3
      FROM dp JOIN h ON h.g = dp.g AND h.i = dp.i + 1))
), b AS (
  SELECT g, CAST(l[1:8] AS BIGINT) AS cost, l[9:] AS audit
  FROM (SELECT dp.g, least(l0, l3) AS l FROM dp JOIN c ON c.g = dp.g AND c.n = dp.i)
), e AS (
  SELECT g, k, e, sum(CAST(e <> 'I' AS INTEGER)) OVER w AS i, sum(CAST(e <> 'D' AS INTEGER)) OVER w AS m
  FROM (SELECT g, unnest(range(1, length(audit) + 1)) AS k, audit[k:k] AS e FROM b)
  WINDOW w AS (PARTITION BY g ORDER BY k)
), q AS (
  SELECT e.g, e.k, e.e, e.m, h.role, CASE WHEN e.e <> 'I' THEN h.text ELSE '' END AS text,
    max(CAST(e.m = 1 AND e.e = 'K' AND h.r = 's' AS INTEGER)) OVER (PARTITION BY e.g) AS sys
  FROM e LEFT JOIN h ON h.g = e.g AND h.i = e.i WHERE e.e <> 'D'
), z AS (
  SELECT g, string_agg(CASE WHEN e = 'K' THEN role WHEN (m - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END
                       || ':' || text, chr(10) ORDER BY k) AS s
  FROM q GROUP BY g
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(s, '')) AS repaired_sha256
FROM ids LEFT JOIN c USING (g) LEFT JOIN b USING (g) LEFT JOIN z USING (g)
"""


SQL["op13_conversation_repair"] = _repair_sql()
