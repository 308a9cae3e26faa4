"""The operators of this package over the given tables, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontam, fertility, fim, gru_lm, licenses, minhash, mixing, quality_pu,
               rtree, simhash, suffix, toxicity)
from ._common import read_table

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = rf"""
WITH dw AS (SELECT row_number() OVER () AS rid, doc_id,
                   regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS l,
              array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS body
       FROM (SELECT item_id, regexp_extract_all({_LOW},
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) i,
            unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS r(s)
       WHERE len(w) > 0),
places AS (SELECT rid, l, s, array_to_string(w[s:s + l - 1], ' ') AS body
           FROM dw, (SELECT DISTINCT l FROM iw) x, unnest(range(1, len(w) - l + 2)) AS r(s)
           WHERE len(w) >= l),
hits AS (SELECT DISTINCT rid, l, s, item_id FROM places JOIN iw USING (l, body)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit
            FROM hits, unnest(range(s, s + l)) AS r(p) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items,
                 string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM (SELECT DISTINCT rid, item_id FROM hits) h GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)
"""


# Fixed value: the turns of conversation -7.
PROBE = "</s>[INST] ok [/INST]"

_CONTROL = r"[<\[]\\*(?:\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\])"

OP4_SQL = rf"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations
           UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
t AS (SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), ''
                        ORDER BY turn NULLS FIRST, role, text) AS whole,
             coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                      FILTER (role = 'assistant'), '') AS loss,
             sum(length(role) + length(text) + {len(chat.BEGIN + chat.SEP + chat.END)}
                 + len(regexp_extract_all(role, '{_CONTROL}'))
                 + len(regexp_extract_all(text, '{_CONTROL}'))) AS chars
      FROM r GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM t
"""

OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS h,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)
                      AS size
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS total,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
k AS (SELECT *, row_number() OVER (ORDER BY 2 * total / CAST(weight AS DOUBLE), i) AS k FROM w),
lev AS (SELECT *, (1.5 * CAST(sum(total) OVER () AS DOUBLE)
                   - coalesce(CAST(sum(2 * total) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING
                                                   AND 1 PRECEDING) AS DOUBLE), 0))
                  / (CAST(sum(weight) OVER () AS DOUBLE)
                     - coalesce(CAST(sum(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING
                                                  AND 1 PRECEDING) AS DOUBLE), 0)) AS level
        FROM k),
edge AS (SELECT min(k) AS k FROM lev WHERE level * weight <= 2 * total),
t AS (SELECT source, total,
             CASE WHEN lev.k < edge.k THEN CAST(2 * total AS DOUBLE)
                  ELSE (SELECT level FROM lev x, edge y WHERE x.k = y.k) * weight END AS target
      FROM lev, edge),
u AS (SELECT *, CAST(round_even(target, 0) AS BIGINT) AS used FROM t),
p AS (SELECT *, CASE WHEN total = 0 THEN 0 ELSE used // total END AS times FROM u),
o AS (SELECT d.doc_id, d.size, p.total, p.target, p.times, p.used - p.times * p.total AS r,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id
                               ROWS UNBOUNDED PRECEDING) AS after
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, total AS source_size, target,
       CAST(size * (times + CASE WHEN 2 * after - size <= 2 * r THEN 1 ELSE 0 END) AS BIGINT)
           AS taken
FROM o
"""


def op10_sql() -> str:
    """The look-up of op10 in DuckDB, from the same fixed values."""
    def lit(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def lines(text: str) -> str:
        low = (f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
               "'abcdefghijklmnopqrstuvwxyz')")
        plain = (f"regexp_replace(regexp_replace({low}, {lit(licenses.COPYRIGHT_LINE)}, '', 'g'), "
                 f"{lit(licenses.BREAKS)}, ' ', 'g')")
        for variant, canonical in licenses.SPELLINGS:
            plain = f"replace({plain}, {lit(variant)}, {lit(canonical)})"
        return (f"list_filter(list_transform(string_split({plain}, chr(10)), "
                "lambda x: trim(x, ' ')), lambda x: x <> '')")

    known = ", ".join(f"({lit(i)}, {lit(t)})" for i, t in licenses.KNOWN)
    return f"""
WITH known AS (SELECT body, min(license_id) AS license_id
               FROM (SELECT license_id, array_to_string({lines("text")}, ' ') AS body
                     FROM (VALUES {known}) k(license_id, text)) b GROUP BY body),
d AS (SELECT row_number() OVER () AS rid, doc_id, {lines("text")} AS lines FROM documents),
notices AS (SELECT rid, count(*) AS n,
                   array_to_string(list_sort(list_distinct(list(license_id))), ',') AS ids
            FROM (SELECT rid, unnest(lines) AS body FROM d) l JOIN known USING (body)
            GROUP BY rid)
SELECT doc_id, sha256(array_to_string(lines, ' ')) AS text_digest, license_id,
       CAST(coalesce(n, 0) AS BIGINT) AS n_notices, coalesce(ids, '') AS notice_ids
FROM d LEFT JOIN known ON known.body = array_to_string(lines, ' ') AND len(lines) > 0
       LEFT JOIN notices USING (rid)
"""


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
r AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a,
             CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3,
             CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (SELECT *, least(a, b) AS c1, greatest(a, b) AS c2,
             CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>')
                       OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
t AS (SELECT *, substr(text, 1, c1) AS p, substr(text, c1 + 1, c2 - c1) AS m,
             substr(text, c2 + 1) AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN c1 END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN c2 - c1 END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM t
"""

OP12_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w
                     FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3
                                   THEN [array_to_string(w, ' ')]
                                   ELSE list_transform(range(1, len(w) - 1), lambda i:
                                        w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
      FROM w),
x AS (SELECT g, min(doc_id) AS node FROM (SELECT doc_id, list_sort(g) AS g FROM s) k
      WHERE len(g) > 0 GROUP BY g),
e AS (SELECT node, len(g) AS n, unnest(g) AS h FROM x),
pairs AS (SELECT a.node AS u, b.node AS v FROM e a JOIN e b ON a.h = b.h AND a.node < b.node
          GROUP BY a.node, b.node, a.n, b.n
          HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT u, v FROM pairs UNION SELECT v, u FROM pairs),
reach AS (SELECT node AS u, node AS v FROM x UNION
          SELECT r.u, edges.v FROM reach r JOIN edges ON edges.u = r.v),
roots AS (SELECT u AS node, min(v) AS component_id FROM reach GROUP BY u)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles,
       coalesce(roots.component_id, s.doc_id) AS component_id,
       s.doc_id = coalesce(roots.component_id, s.doc_id) AS kept
FROM s LEFT JOIN x ON x.g = list_sort(s.g) LEFT JOIN roots USING (node)
"""

OP13_SQL = """
WITH p AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, p.vec_id AS id, a.label = p.label AS same,
             CAST(list_dot_product(a.v, p.v) AS BIGINT) AS score
      FROM p a JOIN p ON a.vec_id <> p.vec_id WHERE a.vec_id % 100 = 0),
pos AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
            AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM pos JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 5
"""


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    return simhash.simhash_dedup(read_table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    return decontam.decontaminate(read_table(spark, sf_dir, "documents"),
                                  read_table(spark, sf_dir, "benchmark")).drop("_key")


def op3_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base quality counts, token measures and verdict of every document."""
    return fertility.quality_rules(read_table(spark, sf_dir, "documents")).drop("_key")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of control strings, read back from the formatted packs."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)],
                                  rows.schema)
    return chat.read_back(chat.format_chats(rows.unionByName(probe))).drop("pack", "n_tokens")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated passages."""
    done = suffix.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "repeats.n_bytes", "repeats.n_removed", "repeats.n_spans",
                       F.sha2("repeats.kept", 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"),
                             read_table(spark, sf_dir, "labels")).drop("passages")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_pu.quality_scores(read_table(spark, sf_dir, "documents"),
                                     read_table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the target mix takes of every document."""
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("_key")


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under the language model and the unigram base."""
    return gru_lm.score_documents(read_table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences in every document, as its whole text and as single lines."""
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and cuts of every document, with digests of the output and of the text restored."""
    done = fim.fill_in_middle(read_table(spark, sf_dir, "documents"))
    restored = fim.restore(F.col("output"), F.col("form"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored, 256).alias("restored_sha256"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document by the similarity of its shingle set."""
    return minhash.minhash_dedup(read_table(spark, sf_dir, "documents"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the positives of every anchor."""
    rows = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rtree.hard_negatives(rows.withColumn("label", moved), F.col("id") % 100 == 0)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_decontaminate": op2_decontaminate,
    "op3_fertility": op3_fertility,
    "op4_chat": op4_chat,
    "op5_repeats": op5_repeats,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_mixing": op8_mixing,
    "op9_lm": op9_lm,
    "op10_licenses": op10_licenses,
    "op11_fim": op11_fim,
    "op12_minhash": op12_minhash,
    "op13_negatives": op13_negatives,
}
ORACLE = {
    "op2_decontaminate": OP2_SQL,
    "op4_chat": OP4_SQL,
    "op8_mixing": OP8_SQL,
    "op10_licenses": op10_sql(),
    "op11_fim": OP11_SQL,
    "op12_minhash": OP12_SQL,
    "op13_negatives": OP13_SQL,
}
