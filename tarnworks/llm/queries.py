"""One query for each operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnworks.llm import (
    contamination, licenses, mixture, nearest, pieces, prefix_trie, shards, simhash, sketches, spelling,
    toxicity, urls, wordpiece,
)
from tarnworks.session import fresh_folder
from tarnworks.sources.tables import table


def op1_nearest(spark, d):
    vectors = table(spark, d, "embeddings")
    return nearest.nearest(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op2_mixture(spark, d):
    mixed = mixture.mix(table(spark, d, "documents")).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken",
        F.size("passes").alias("n_passes"),
        F.round(F.get("passes", F.lit(0))["position"], 6).alias("first_position"),
        F.round(F.get("passes", F.size("passes") - 1)["position"], 6).alias("last_position"),
    )
    return mixture.in_order(mixed, "first_position")


def op3_sketches(spark, d):
    return sketches.fingerprinted(table(spark, d, "documents"))


def op4_toxicity(spark, d):
    docs = table(spark, d, "documents")
    return toxicity.scored(docs, toxicity.fitted(docs, table(spark, d, "labels")))


def op5_token_counts(spark, d):
    automaton = wordpiece.Automaton(wordpiece.vocabulary())
    return wordpiece.token_counts(table(spark, d, "documents"), automaton)


def op6_simhash(spark, d):
    return simhash.near_groups(table(spark, d, "documents"))


def op7_licenses(spark, d):
    return licenses.scanned(table(spark, d, "documents"))


def op8_urls(spark, d):
    return urls.judged(table(spark, d, "pages"), urls.rule_table(spark))


def op9_pieces(spark, d):
    return pieces.encoded(table(spark, d, "documents"), pieces.Vocabulary.load())


def op10_shards(spark, d):
    rows, _ = shards.sharded(table(spark, d, "documents"), folder=fresh_folder(spark, "slot-maps"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot", "version",
    )


def op11_prefix_trie(spark, d):
    return prefix_trie.prefix_trie(table(spark, d, "conversations"))


def op12_spelling(spark, d):
    return spelling.spelling_groups(table(spark, d, "documents"))


def op13_contamination(spark, d):
    return contamination.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


OP2_SQL = """WITH sized AS (
  SELECT doc_id, source, md5(concat(doc_id, ':', text)) AS place,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents),
sources AS (SELECT source, sum(size)::DOUBLE AS source_size,
    row_number() OVER (ORDER BY source IS NULL, source) - 1 AS turn FROM sized GROUP BY source),
limits AS (SELECT *, [5.0, 2.0, 1.0][turn % 3 + 1]::DOUBLE AS weight, 3 * source_size AS full_words,
    (1.5 - 0.5 * (turn % 3))::DOUBLE AS rise FROM sources),
levels AS (SELECT *, full_words / weight AS full_at,
    (sum(source_size) OVER () - (sum(full_words) OVER w - full_words))
      / (sum(weight) OVER () - (sum(weight) OVER w - weight)) AS level
  FROM limits WINDOW w AS (ORDER BY full_words / weight, turn ROWS UNBOUNDED PRECEDING)),
targets AS (SELECT *, least(full_words, weight * coalesce((
    SELECT arg_min(level, full_at * 1e6 + turn) FROM levels WHERE level <= full_at), 'inf'::DOUBLE)) AS target FROM levels),
placed AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.rise, floor(t.target) AS goal,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS before
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
passes AS (SELECT p.*, k, greatest(0, least(size, goal - (k * source_size + before))) AS words,
    least(1.0, (k * source_size + before + greatest(0, least(size, goal - (k * source_size + before))) / 2)
      / nullif(target, 0)) AS share
  FROM placed p, range(3) AS n(k)),
timed AS (SELECT *, 2 * share / (rise + sqrt(greatest(0, rise * rise + 4 * (1 - rise) * share))) AS position FROM passes)
SELECT doc_id, size, source_size::BIGINT AS source_size, round(target, 6) AS target, sum(words)::BIGINT AS taken,
  (count(*) FILTER (words > 0))::INTEGER AS n_passes,
  round(min(position) FILTER (words > 0), 6) AS first_position,
  round(max(position) FILTER (words > 0), 6) AS last_position
FROM timed GROUP BY doc_id, size, source_size, target, before"""

OP8_SQL = """WITH parts AS (
  SELECT page_id, url, contains(coalesce(url, ''), '://') AS whole,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', ['host', 'path']) AS p FROM pages),
judged AS (
  SELECT row_number() OVER () AS n, page_id, whole, translate(p.host,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, p.path AS path FROM parts),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (SELECT n, arg_max(h || p, len(h || p)) AS rule, arg_max(verdict, len(h || p)) AS verdict
  FROM judged JOIN rules ON whole AND (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM judged LEFT JOIN fits USING (n)"""

OP11_SQL = """WITH keyed AS (
  SELECT conv_id, turn, sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS k,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS w FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'k': k, 'w': w} ORDER BY turn NULLS FIRST, k) AS ts FROM keyed GROUP BY conv_id),
heads AS (SELECT *, conv_id - conv_id % 20 AS first, xor(4294967295, list_reduce(
    [4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda a, b: list_reduce([xor(a, b)] || range(8),
      lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)))) % 4 AS h FROM own),
built AS (SELECT a.conv_id, list_concat(coalesce(b.ts[1:a.h], []), a.ts[a.h + 1:]) AS ts
  FROM heads a LEFT JOIN own b ON b.conv_id = a.first),
members AS (SELECT conv_id, d, len(ts) = d AS last, coalesce(ts[d].w, 0) AS words,
    array_to_string(list_transform(ts[1:d], lambda t: t.k), '') AS node,
    array_to_string(list_transform(ts[1:d - 1], lambda t: t.k), '') AS above
  FROM (SELECT *, unnest(range(len(ts) + 1)) AS d FROM built)),
nodes AS (SELECT node, d AS depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM members GROUP BY node, d),
born AS (SELECT above, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY above),
full_nodes AS (SELECT n.*, coalesce(b.n, 0) AS n_children FROM nodes n LEFT JOIN born b ON b.above = n.node),
subtrees AS (SELECT m.node, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * f.words)::BIGINT AS saved_tokens
  FROM full_nodes f JOIN members m ON m.conv_id = f.conv_id AND m.d <= f.depth GROUP BY m.node)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM full_nodes f JOIN subtrees s USING (node) LEFT JOIN full_nodes p ON f.depth > 0 AND p.node = f.above"""

OP12_SQL = """WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
told AS (SELECT concat(doc_id, ':', run) AS s, any_value(run) AS run, count(*) AS n FROM runs GROUP BY s),
crc_table AS (SELECT i, list_reduce([i] || range(8),
    lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)) AS v FROM range(256) AS r(i)),
steps(s, bytes, spot, crc) AS (
  SELECT s, hex(s), 0, 4294967295 FROM told UNION ALL
  SELECT s, bytes, spot + 2, xor(crc >> 8, v) FROM steps
    JOIN crc_table ON i = xor(crc % 256, 16 * (strpos('0123456789ABCDEF', bytes[spot + 1]) - 1) + strpos('0123456789ABCDEF', bytes[spot + 2]) - 1)
    WHERE spot < length(bytes)),
sums AS (SELECT s, xor(crc, 4294967295) AS h FROM steps WHERE spot = length(bytes)),
written AS (SELECT n, CASE WHEN h % 97 = 0
    THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
  FROM told JOIN sums USING (s)),
words AS (SELECT word, sum(n)::BIGINT AS n FROM written WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS (SELECT DISTINCT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
shorter AS (SELECT DISTINCT l.word AS long, w.word AS short FROM less l JOIN words w ON l.rest = w.word),
near AS (SELECT a.word, b.word AS other FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT long, short FROM shorter UNION ALL SELECT short, long FROM shorter),
tops AS (SELECT near.word, count(*) AS n_near, max({'n': w.n}).n AS best_n, arg_min(other, {'n': -w.n, 'w': other}) AS best
  FROM near JOIN words w ON near.other = w.word GROUP BY near.word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form,
    CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n FROM words w LEFT JOIN tops USING (word)),
way(word, root) AS (SELECT word, word FROM forms UNION ALL
  SELECT way.word, f.form FROM way JOIN forms f ON f.word = way.root WHERE f.form IS NOT NULL),
roots AS (SELECT way.word, root FROM way JOIN forms f ON f.word = way.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""

OP13_SQL = """WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
bench AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
items AS (SELECT *, least(10, len(ws)) AS wide FROM bench WHERE len(ws) > 0),
spans AS (SELECT item_id, ws, wide, s, array_to_string(ws[s + 1:s + wide], ' ') AS gram
  FROM (SELECT *, unnest(range(len(ws) - wide + 1)) AS s FROM items)),
wides AS (SELECT DISTINCT wide FROM items),
grams AS (SELECT r, wide, spot, array_to_string(ws[spot + 1:spot + wide], ' ') AS gram
  FROM (SELECT r, ws, wide, unnest(range(len(ws) - wide + 1)) AS spot FROM docs, wides WHERE len(ws) >= wide)),
found AS (SELECT DISTINCT r, g.wide, spot, item_id FROM grams g JOIN spans USING (wide, gram)),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(spot, spot + wide)) AS p FROM found) GROUP BY r),
owned AS (SELECT r, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r),
places AS (SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM docs),
counts AS (SELECT word, count(*) AS n FROM places GROUP BY word),
asked AS (SELECT item_id, ws, s, q, word, row_number() OVER w AS turn, least(2, count(*) OVER (PARTITION BY item_id, ws, s)) AS asked
  FROM (SELECT item_id, ws, s, unnest(range(s, s + wide)) AS q, unnest(ws[s + 1:s + wide]) AS word FROM spans) JOIN counts USING (word)
  WINDOW w AS (PARTITION BY item_id, ws, s ORDER BY n, q)),
bases AS (SELECT DISTINCT a.item_id, a.ws, a.s, p.r, p.pos - a.q AS base FROM asked a JOIN places p USING (word) WHERE turn = 1),
there AS (SELECT DISTINCT b.item_id, b.ws, b.s, b.r, base, q, turn, asked FROM bases b
  JOIN asked a ON a.item_id = b.item_id AND a.ws = b.ws AND a.s = b.s
  JOIN places p ON p.r = b.r AND p.word = a.word AND abs(p.pos - q - base) <= 4),
close AS (SELECT r, count(DISTINCT item_id) AS n_near_items FROM (SELECT r, item_id FROM there GROUP BY r, item_id, ws, s, base
    HAVING count(*) * 10 >= least(10, len(ws)) * 8 AND count(*) FILTER (turn <= 2) = any_value(asked)) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0) AS n_near_items
FROM docs LEFT JOIN hits USING (r) LEFT JOIN owned USING (r) LEFT JOIN close USING (r)"""

QUERIES = {
    "op1_nearest": (op1_nearest, None),
    "op2_mixture": (op2_mixture, OP2_SQL),
    "op3_sketches": (op3_sketches, None),
    "op4_toxicity": (op4_toxicity, None),
    "op5_token_counts": (op5_token_counts, None),
    "op6_simhash": (op6_simhash, None),
    "op7_licenses": (op7_licenses, None),
    "op8_urls": (op8_urls, OP8_SQL),
    "op9_pieces": (op9_pieces, None),
    "op10_shards": (op10_shards, None),
    "op11_prefix_trie": (op11_prefix_trie, OP11_SQL),
    "op12_spelling": (op12_spelling, OP12_SQL),
    "op13_contamination": (op13_contamination, OP13_SQL),
}
