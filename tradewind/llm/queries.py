"""The registered query of each operator, and its SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import chat, exact_dedup, fingerprints, masked_lm, mixing, near_dedup, phrases, pieces, quality, rules, secrets, token_files, trie
from tradewind.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build
    return register


@query("op1_exact_dedup", r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
     g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query("op3_mixing", r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rnk FROM s),
w AS (SELECT *, (CASE rnk % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap,
             1.5::DOUBLE * (SELECT sum(source_size) FROM s)::DOUBLE AS total FROM r),
p AS (SELECT *, row_number() OVER o AS i, sum(cap) OVER o - cap AS capped, sum(weight) OVER () - (sum(weight) OVER o - weight) AS open
      FROM w WINDOW o AS (ORDER BY cap / weight, rnk ROWS UNBOUNDED PRECEDING)),
l AS (SELECT (total - capped) / open AS level FROM p WHERE cap > (total - capped) / open * weight ORDER BY i LIMIT 1),
t AS (SELECT source, source_size, rnk, least(cap, (SELECT level FROM l) * weight) AS target FROM w),
c AS (SELECT d.doc_id, d.size, t.source_size, t.rnk, t.target, copy::BIGINT AS copy, md5('mix:' || copy || ':' || d.doc_id) AS k
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, (SELECT unnest([0, 1]) AS copy)
      WHERE d.size > 0 AND copy < ceil(t.target / t.source_size)),
q AS (SELECT *, copy * source_size + sum(size) OVER (PARTITION BY rnk, copy ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start FROM c),
v AS (SELECT *, least(size, floor(target)::BIGINT - start) AS got, least(1.0::DOUBLE, (start + size) / target) AS finish FROM q WHERE start < floor(target)),
m AS (SELECT *, sum(got) OVER (ORDER BY finish, rnk, copy, k, doc_id, size ROWS UNBOUNDED PRECEDING) - got AS pos FROM v),
u AS (SELECT doc_id, sum(greatest(0, least(got, floor(1.5 * (SELECT sum(source_size) FROM s))::BIGINT - pos)))::BIGINT AS taken FROM m GROUP BY doc_id)
SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(u.taken, 0)::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN u ON u.doc_id = d.doc_id
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


@query("op5_chat_formatting")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.sql("SELECT -1L AS conv_id, stack(2, 0L, 'user', 1L, 'assistant') AS (turn, role), :said AS text", {"said": said})
    read = chat.read_windows(chat.format_windows(turns.unionByName(own)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return read.select(F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


@query("op8_secret_scans")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def number(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"].isin([r.kind for r in secrets.BASE_RULES]))
    return found.select("doc_id", *[number(r.kind) for r in secrets.BASE_RULES],
                        F.sha2(secrets.joined_spans(base), 256).alias("base_sha256"), secrets.joined_spans(F.col("secrets")).alias("spans"))


@query("op10_near_dedup", r"""
WITH RECURSIVE w AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS MATERIALIZED (SELECT DISTINCT doc_id, h FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                          ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS h FROM w)),
n AS MATERIALIZED (SELECT w.doc_id, count(h) AS n_shingles FROM w LEFT JOIN g USING (doc_id) GROUP BY w.doc_id),
p AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM g x JOIN g y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL)
      JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= 85 * (na.n_shingles + nb.n_shingles - shared)),
e AS MATERIALIZED (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT a AS doc_id, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id)
SELECT n.doc_id, n.n_shingles, coalesce(c.root, n.doc_id) AS component_id, n.doc_id = coalesce(c.root, n.doc_id) AS kept
FROM n LEFT JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) c USING (doc_id)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


@query("op4_sentencepiece")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op9_token_files")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_table(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2)


@query("op6_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_table(table(spark, sf_dir, "documents"))


@query("op7_quality_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


@query("op2_lm_scoring")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return masked_lm.score_documents(docs, masked_lm.train(docs))


@query("op11_quality_rules", r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
b AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             (length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
o AS (SELECT doc_id, unnest(range(0, len(words) - 2)) AS i, words FROM t WHERE len(words) > 2),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i + 1], words[i + 2], words[i + 3]) AS times FROM o),
r AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE times > 1) GROUP BY doc_id),
v AS MATERIALIZED (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, len(x), 2), lambda i: [('0x' || substr(x, i, 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, y: CASE WHEN y >= 0 THEN xor(a, y) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295::BIGINT) AS h FROM (SELECT DISTINCT w, hex(w) AS x FROM (SELECT unnest(words) AS w FROM t))),
h AS (SELECT doc_id, list(h ORDER BY i) AS hs FROM (SELECT doc_id, unnest(words) AS w, unnest(range(len(words))) AS i FROM t) JOIN v USING (w) GROUP BY doc_id),
c AS MATERIALIZED (SELECT doc_id, unnest(list_concat(list_transform(hs, lambda x: x % 16384),
        list_transform(range(1, len(hs)), lambda i: (hs[i] * 31 + hs[i + 1] * 7919 + 12345) % 16384))) AS cell FROM h),
s AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND coalesce(toxic, 0) = 0),
n AS (SELECT cell, count(*) AS n, count(s.doc_id) AS sure FROM c LEFT JOIN s USING (doc_id) GROUP BY cell),
z AS (SELECT cell, round(1e6::DOUBLE * (ln(sure::DOUBLE * ((SELECT sum(n) FROM n) + 16384)::DOUBLE / (n + 1)::DOUBLE + 16384::DOUBLE)
        - ln((SELECT sum(sure) FROM n)::DOUBLE + 16384::DOUBLE)))::BIGINT AS weight FROM n),
k AS (SELECT doc_id, count(*) AS n_grams, sum(weight)::BIGINT AS score FROM c JOIN z USING (cell) GROUP BY doc_id),
a AS (SELECT doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_grams, 0)::BIGINT AS n_grams, coalesce(score, 0)::BIGINT AS score
      FROM b LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND score >= -100000 * n_grams AS kept FROM a
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = table(spark, sf_dir, "labels").where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id")
    return rules.judge(docs, rules.gram_weights(docs, trusted))


@query("op13_prefix_trie", r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos, coalesce(role, '') AS role, coalesce(text, '') AS body
           FROM conversations WHERE conv_id IS NOT NULL),
z AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
          lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
          lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295::BIGINT) % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT z.conv_id, 0 AS part, pos, role, body FROM z JOIN t ON t.conv_id = z.base WHERE pos < h
      UNION ALL SELECT z.conv_id, 1, pos, role, body FROM z JOIN t ON t.conv_id = z.conv_id WHERE pos >= h),
l AS (SELECT z.conv_id, coalesce(p.path, []) AS path FROM z LEFT JOIN (SELECT conv_id, list({'role': role, 'body': body} ORDER BY part, pos) AS path FROM r GROUP BY conv_id) p USING (conv_id)),
d AS (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM l),
n AS MATERIALIZED (SELECT depth, path[1:depth] AS node, min(conv_id) AS conv_id, count(*) AS n_convs,
          sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends_sha256 FROM d GROUP BY ALL),
k AS (SELECT depth - 1 AS depth, node[1:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS MATERIALIZED (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * length(n.node[n.depth].body) END AS saved
      FROM n LEFT JOIN k ON k.depth = n.depth AND k.node = n.node),
a AS (SELECT up AS depth, node[1:up] AS node, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM m) GROUP BY ALL)
SELECT m.conv_id, m.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, m.n_convs, m.n_children, a.n_leaves, a.saved_tokens, m.ends_sha256
FROM m JOIN a ON a.depth = m.depth AND a.node = m.node LEFT JOIN m p ON p.depth = m.depth - 1 AND p.node = m.node[1:m.depth - 1]
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(*trie.share_openings(trie.turn_rows(table(spark, sf_dir, "conversations"))))


@query("op12_collocations", r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
f1 AS MATERIALIZED (SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(ws) AS x FROM w) GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, q[1] AS x, q[2] AS y, count(*) AS f FROM (SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: [ws[i], ws[i + 1]])) AS q FROM w) GROUP BY ALL),
f3 AS MATERIALIZED (SELECT lang, q[1] AS x, q[2] AS y, q[3] AS z, count(*) AS f FROM (SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: [ws[i], ws[i + 1], ws[i + 2]])) AS q FROM w) GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
m AS (SELECT lang, x, y, max(f) AS most FROM (SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY ALL),
c2 AS (SELECT c.lang, c.x || ' ' || c.y AS phrase, c.f AS a, u.f AS l, v.f AS r, (1000000::HUGEINT * c.f * c.f) // (u.f::HUGEINT * v.f) AS score
       FROM f2 c JOIN f1 u ON u.lang = c.lang AND u.x = c.x JOIN f1 v ON v.lang = c.lang AND v.x = c.y LEFT JOIN m ON m.lang = c.lang AND m.x = c.x AND m.y = c.y
       WHERE c.f >= 10 AND 100 * coalesce(most, 0) < 50 * c.f),
c3 AS (SELECT c.lang, c.x || ' ' || c.y || ' ' || c.z AS phrase, c.f AS a, u.f AS l1, yz.f AS r1, xy.f AS l2, v.f AS r2,
              (1000000::HUGEINT * c.f * c.f) // (u.f::HUGEINT * yz.f) AS s1, (1000000::HUGEINT * c.f * c.f) // (xy.f::HUGEINT * v.f) AS s2
       FROM f3 c JOIN f1 u ON u.lang = c.lang AND u.x = c.x JOIN f1 v ON v.lang = c.lang AND v.x = c.z
       JOIN f2 xy ON xy.lang = c.lang AND xy.x = c.x AND xy.y = c.y JOIN f2 yz ON yz.lang = c.lang AND yz.x = c.y AND yz.y = c.z),
a AS (SELECT lang, phrase, a, l, r, score FROM c2 UNION ALL
      SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM c3),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM a)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM k JOIN n USING (lang) WHERE rank <= 2000
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))
