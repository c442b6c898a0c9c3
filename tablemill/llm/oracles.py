"""DuckDB SQL for the queries that SQL can express exactly."""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP1_SQL = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
  FROM split
), sizes AS (
  SELECT d.doc_id, count(s.s) AS n FROM documents d LEFT JOIN shingles s USING (doc_id) GROUP BY d.doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * i >= 75 * (x.n + y.n - i)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM sizes s JOIN reach r USING (doc_id) GROUP BY s.doc_id, s.n
"""


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP6_SQL = rf"""
WITH item AS (
  SELECT item, row_number() OVER (ORDER BY item, text) AS k, regexp_extract_all(translate(text, {_AZ}), '{_ALNUM}') AS w
  FROM (SELECT DISTINCT item_id::VARCHAR AS item, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL)
), span AS (
  SELECT item, k, w, least(len(w), 10) AS size, unnest(range(greatest(len(w) - 9, least(len(w), 1)))) AS off FROM item
), win AS (
  SELECT item, k, off, size, array_to_string(w[off + 1:off + size], ' ') AS gram FROM span
), doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '{_ALNUM}') AS w FROM documents
), place AS (
  SELECT doc_id, w, size, unnest(range(greatest(len(w) - size + 1, 0))) AS pos FROM doc, (SELECT DISTINCT size FROM win)
), hit AS (
  SELECT doc_id, pos, size, item, k, off FROM (SELECT doc_id, pos, size, array_to_string(w[pos + 1:pos + size], ' ') AS gram FROM place) JOIN win USING (size, gram)
), covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM hit) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
), run AS (
  SELECT doc_id, k, any_value(item) AS item, count(*) - 1 + min(size) AS words, min(pos) AS pos, min(off) AS off
  FROM (SELECT *, pos - off AS diagonal, pos - row_number() OVER (PARTITION BY doc_id, k, pos - off ORDER BY pos) AS part FROM hit) GROUP BY doc_id, k, diagonal, part
), longest AS (
  SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY words DESC, pos, k, off) = 1
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items, sha256(coalesce(f.items, '')) AS items_sha256,
  coalesce(l.words, 0) AS longest_words, coalesce(l.pos, -1) AS longest_at, l.item AS longest_item, coalesce(l.off, -1) AS longest_item_at, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN covered c USING (doc_id) LEFT JOIN found f USING (doc_id) LEFT JOIN longest l USING (doc_id)
"""


def op3_sql(templates: list[tuple[str, list[str]]], dice: float, slack) -> str:
    """The licence scan; ``templates`` are names with their bigrams."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    values = ", ".join(f"({k}, {quote(name)}, {len(grams)}, {slack(len(grams)) + 1}, [{', '.join(map(quote, grams))}])" for k, (name, grams) in enumerate(templates))
    return rf"""
WITH template(k, license, m, room, own) AS (VALUES {values}), own AS (SELECT k, license, m, room, unnest(own) AS g FROM template
), low AS (SELECT doc_id, translate(coalesce(text, ''), {_AZ}) AS t FROM documents
), word AS (
  SELECT doc_id, list_filter(string_split_regex(t, '[^0-9a-z\x{{80}}-\x{{10FFFF}}]+'), lambda w: w <> '') AS w FROM low
), gram AS (
  SELECT doc_id, unnest(range(len(w) - 1)) AS pos, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM word WHERE len(w) > 1
), place AS (
  SELECT doc_id, k, license, m, pos, sum(fresh) OVER (PARTITION BY doc_id, k ORDER BY pos) AS string
  FROM (SELECT doc_id, k, license, m, pos, CASE WHEN pos - lag(pos) OVER (PARTITION BY doc_id, k ORDER BY pos) <= room THEN 0 ELSE 1 END AS fresh FROM gram JOIN own USING (g))
), stretch AS (
  SELECT doc_id, k, license, m, string, min(pos) AS first, max(pos) AS last FROM place GROUP BY ALL HAVING count(*) * 3 >= 2 * m
), sized AS (
  SELECT s.doc_id, s.k, s.license, s.m, s.first, s.last, count(DISTINCT g.g) AS n, count(DISTINCT CASE WHEN o.g IS NOT NULL THEN g.g END) AS shared
  FROM stretch s JOIN gram g ON g.doc_id = s.doc_id AND g.pos BETWEEN s.first AND s.last LEFT JOIN own o ON o.k = s.k AND o.g = g.g GROUP BY ALL
), near AS (
  SELECT doc_id, license, first, last, 2.0::DOUBLE * shared / (n + m) AS dice FROM sized WHERE 2.0::DOUBLE * shared / (n + m) >= {dice}
  QUALIFY row_number() OVER (PARTITION BY doc_id, first ORDER BY dice DESC, license) = 1
), hit AS (
  SELECT * FROM near QUALIFY last > coalesce(max(last) OVER (PARTITION BY doc_id ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1)
)
SELECT d.doc_id, count(h.first) AS n_matches, coalesce(string_agg(DISTINCT h.license, ',' ORDER BY h.license), '') AS licenses,
  coalesce(array_to_string(list_sort(list_distinct(list(h.first) FILTER (WHERE h.first IS NOT NULL))), ','), '') AS places, coalesce(max(h.dice), 0.0::DOUBLE) AS best_dice
FROM documents d LEFT JOIN hit h USING (doc_id) GROUP BY d.doc_id
"""


def _crc_steps(longest: str) -> str:
    """Table crc_step(v, k, c): the checksum's register after k zero bits, from a byte or from its first value.
    A checksum is the exclusive or of what each byte, and the first value, have become at the end."""
    return f"""crc_step(v, k, c) AS (
  SELECT v, 0, v FROM (SELECT unnest(range(256)) AS v UNION ALL SELECT 4294967295)
  UNION ALL SELECT v, k + 1, xor(c >> 1, (c & 1) * 3988292384) FROM crc_step WHERE k < 8 * ({longest})
)"""


def _crc_of(keyed: str) -> str:
    """Tables crc_byte and crc(key, h) of the distinct texts of table ``keyed`` (key)."""
    return f"""crc_byte AS (
  SELECT key, octet_length(encode(key)) AS n, unnest(range(octet_length(encode(key)))) AS i, hex(encode(key)) AS x FROM {keyed}
), crc AS (
  SELECT key, xor(xor(bit_xor(s.c), any_value(z.c)), 4294967295) AS h
  FROM crc_byte b JOIN crc_step s ON s.v = ('0x' || substr(x, 2 * i + 1, 2))::BIGINT AND s.k = 8 * (n - i)
  JOIN crc_step z ON z.v = 4294967295 AND z.k = 8 * n GROUP BY key
)"""


OP11_SQL = rf"""
WITH RECURSIVE run AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(r, {_AZ}) AS r
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents)
), own AS (SELECT id || ':' || r AS key, r, count(*) AS n FROM run GROUP BY ALL
), {_crc_steps("SELECT max(octet_length(encode(key))) FROM own")}, {_crc_of("own")}, kept AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, (h % length(r))::BIGINT) || substr(r, (h % length(r))::BIGINT + 2) ELSE r END AS word, n FROM own JOIN crc USING (key)
), word AS (SELECT word, sum(n)::BIGINT AS n FROM kept WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (SELECT word, substr(word, 1, k) || substr(word, k + 2) AS v FROM (SELECT word, unnest(range(length(word))) AS k FROM word)
), pair AS (
  SELECT DISTINCT a.word AS a, b.word AS b FROM cut a JOIN cut b USING (v) WHERE a.word <> b.word AND length(a.word) = length(b.word) AND len(list_filter(range(1, length(a.word) + 1), lambda k: a.word[k] <> b.word[k])) = 1
), link AS (
  SELECT a, b FROM pair UNION SELECT c.word, w.word FROM cut c JOIN word w ON w.word = c.v UNION SELECT w.word, c.word FROM cut c JOIN word w ON w.word = c.v
), best AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY w.n DESC, b) AS b, max(w.n) AS bn FROM link JOIN word w ON w.word = b GROUP BY a
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 2 * n THEN b END AS form, CASE WHEN bn >= 2 * n THEN bn END AS form_n FROM word LEFT JOIN best USING (word)
), up(word, reached, form) AS (SELECT word, word, form FROM formed UNION ALL SELECT u.word, f.word, f.form FROM up u JOIN formed f ON f.word = u.form)
SELECT f.word, f.form, u.reached AS root, f.n, f.n_near, f.form_n FROM formed f JOIN up u ON u.word = f.word AND u.form IS NULL
"""

OP12_SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, pos, array_to_string(w[pos + 1:pos + 20], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 19, 0))) AS pos FROM doc)
), again AS (
  SELECT doc_id, pos FROM win QUALIFY row_number() OVER (PARTITION BY gram ORDER BY doc_id, pos) > 1
), gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(pos, pos + 20)))) AS gone FROM again GROUP BY doc_id
), word AS (
  SELECT doc_id, w, unnest(w) AS word, unnest(range(len(w))) AS k FROM doc
), kept AS (
  SELECT word.doc_id, string_agg(word, ' ' ORDER BY k) AS t FROM word LEFT JOIN (SELECT doc_id, unnest(gone) AS k, true AS out FROM gone) USING (doc_id, k) WHERE out IS NULL GROUP BY word.doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(len(gone), 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _tree(name: str, leaves: str) -> str:
    """Table ``name`` (tree, level, idx, h, n): all nodes above ``leaves`` (tree, 0, idx, h, n); and ``name``_kids, each parent's children."""
    return f"""{name}(tree, level, idx, h, n) AS (
  SELECT tree, 0, idx, h, n FROM {leaves}
  UNION ALL SELECT tree, level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 3, n
), {name}_kids AS (
  SELECT tree, level, idx // 3 AS parent, list(h ORDER BY idx) AS hs FROM {name} WHERE n > 1 GROUP BY ALL
)"""


def _climb(name: str, tree: str, start: str) -> str:
    """Table ``name``: each document's way from ``start`` (doc_id, tree, idx, found, proof) up ``tree``."""
    return f"""{name}(doc_id, tree, level, idx, found, proof) AS (
  SELECT doc_id, tree, 0, idx, found, proof FROM {start}
  UNION ALL
  SELECT c.doc_id, c.tree, c.level + 1, c.idx // 3,
    sha256(array_to_string(list_transform(k.hs, lambda h, i: CASE WHEN i = c.idx % 3 + 1 THEN c.found ELSE h END), '')),
    c.proof || array_to_string(list_filter(k.hs, lambda h, i: i <> c.idx % 3 + 1), '')
  FROM {name} c JOIN {tree}_kids k ON k.tree = c.tree AND k.level = c.level AND k.parent = c.idx // 3
), {name}_end AS (SELECT doc_id, tree, found, proof FROM {name} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1)"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


OP13_SQL = f"""
WITH RECURSIVE own AS (SELECT DISTINCT doc_id::VARCHAR AS key FROM documents
), {_crc_steps("SELECT max(octet_length(encode(key))) FROM own")}, {_crc_of("own")}, leaf AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n,
    {_leaf("text")} AS h, CASE WHEN c.h % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS found
  FROM documents d JOIN crc c ON c.key = d.doc_id::VARCHAR
), {_tree("node", "leaf")}, sub AS (
  SELECT '' AS tree, tree AS own, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n, h FROM node WHERE n = 1
), {_tree("top", "sub")}, {_climb("low", "node", "(SELECT *, '' AS proof FROM leaf)")}, {_climb("high", "top", "(SELECT e.doc_id, s.tree, s.idx, e.found, e.proof FROM low_end e JOIN sub s ON s.own = e.tree)")}
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, r.h AS root, sha256(e.proof) AS proof_sha256, e.found AS folded_root, e.found = r.h AS verified
FROM leaf l JOIN sub s ON s.own = l.tree JOIN high_end e USING (doc_id) JOIN top r ON r.n = 1
"""
