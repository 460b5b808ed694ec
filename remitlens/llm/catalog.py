"""The registered queries op1 to op13 and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm import (
    bpe, fill_in_middle, fingerprints, jaccard_join, kneser_ney, line_dedup, packing, prefix_trie, private_data,
    substring_dedup, token_counts, toxicity, vp_search,
)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_line_dedup", """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM lines),
common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (k IN (SELECT k FROM common)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (k NOT IN (SELECT k FROM common)), ''))
         AS kept_sha256
FROM keyed GROUP BY doc_id""")
def op1(spark, sf_dir):
    out = line_dedup.drop_common_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query("op4_token_counts")
def op4(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@query("op6_best_fit_packing")
def op6(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"), size=2048, end_id=0)


@query("op8_fingerprints")
def op8(spark, sf_dir):
    out = fingerprints.edited_and_next(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                      fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
                      fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                      "near_edited", "near_next")


@query("op10_bpe_codec")
def op10(spark, sf_dir):
    return bpe.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                            digests=True)


@query("op2_substring_dedup", """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
runs AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words)),
firsts AS (SELECT run, min(doc_id) AS first FROM runs GROUP BY run),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM runs JOIN firsts USING (run) WHERE first < doc_id),
dropped AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed,
       sha256(coalesce(array_to_string(
         [w[p] for p in range(1, len(w) + 1) if ps IS NULL OR NOT list_contains(ps, p)], ' '), '')) AS kept_sha256
FROM words LEFT JOIN dropped USING (doc_id)""")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, min_words=13, digest=True) \
        .select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op3_vantage_search")
def op3(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return vp_search.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20, factor=0.2)


@query("op5_jaccard_join", """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id
FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id, n""")
def op5(spark, sf_dir):
    found, _ = jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), percent=75, k=5)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query("op9_toxicity")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, threshold=0.3) \
        .select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op7_quality_perplexity")
def op7(spark, sf_dir):
    return kneser_ney.perplexities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_fill_in_middle", """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
         sha256('7:' || doc_id) AS s FROM documents),
h AS (
  SELECT *, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2, ('0x' || s[25:32])::BIGINT AS h4 FROM d),
cut AS (
  SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
part AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
         array_to_string(u[b + 1:], '') AS x FROM cut)
SELECT doc_id, len(u)::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || x || '<M>' || m
              ELSE '<S>' || x || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM part""")
def op11(spark, sf_dir):
    out = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"), seed="7", percent=100, spm_percent=50)
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def _kind_sql(name: str, pattern: str, passes: str, edges: tuple[str, str] | None = None, words: str = "",
              plain_score: float = 1.0, context: float = 0.0) -> str:
    """The spans of one kind as SQL (a list of start, end)."""
    edge = "true" if not edges else (f"NOT regexp_matches(substr(t, x.s, 1), '{edges[0]}') "
                                     f"AND NOT regexp_matches(substr(t, x.e + 1, 1), '{edges[1]}')")
    near = f"'(?i)(^|[^A-Za-z])({words})([^A-Za-z]|$)'"
    return f"""
m_{name} AS (SELECT doc_id, t, regexp_extract_all(t, '{pattern}') AS f, string_split_regex(t, '{pattern}') AS p FROM docs),
x_{name} AS (SELECT *, [{{'v': f[i], 'c': right(p[i], 40) || ' ' || left(p[i + 1], 40),
    's': (list_sum([length(y) FOR y IN p[1:i]]) + coalesce(list_sum([length(y) FOR y IN f[1:i - 1]]), 0))::BIGINT,
    'e': (list_sum([length(y) FOR y IN p[1:i]]) + list_sum([length(y) FOR y IN f[1:i]]))::BIGINT}}
    FOR i IN range(1, len(f) + 1)] AS xs FROM m_{name}),
{name} AS (SELECT doc_id, [{{'s': x.s, 'e': x.e}} FOR x IN xs IF ({passes.replace('$', 'x.v')}) AND {edge}
    AND {plain_score} + CASE WHEN regexp_matches(x.c, {near}) THEN {context} ELSE 0 END >= 0.5] AS {name} FROM x_{name})"""


_DIGITS = "regexp_replace($, '[^0-9]', '', 'g')"
_LUHN_SQL = (f"length({_DIGITS}) BETWEEN 13 AND 19 AND list_sum([CASE WHEN i % 2 = 1 THEN d ELSE (2 * d) // 10 + (2 * d) % 10 "
             f"END FOR d, i IN [c::INT FOR c IN string_split(reverse({_DIGITS}), '')]]) % 10 = 0")
_IBAN_TURNED = "substr(replace($, ' ', ''), 5) || left(replace($, ' ', ''), 4)"
_MOD_97_SQL = ("list_reduce(list_prepend(0, [CASE WHEN c < 'A' THEN ascii(c) - 48 ELSE ascii(c) - 55 END "
               f"FOR c IN string_split({_IBAN_TURNED}, '')]), lambda a, b: (a * CASE WHEN b > 9 THEN 100 ELSE 10 END + b) % 97) = 1")
_KINDS_SQL = ",".join([
    _kind_sql("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    _kind_sql("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
              "list_bool_and([length(ltrim(y, '0')) < 4 AND ('0' || right(y, 3))::INT <= 255 FOR y IN string_split($, '.')])"),
    _kind_sql("card", r"[0-9](?:[\x20-]?[0-9])+", _LUHN_SQL),
    _kind_sql("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
    _kind_sql("iban", private_data.IBAN, _MOD_97_SQL, private_data.EDGES["iban"], "iban|bank|account|transfer", 0.7, 0.3),
    _kind_sql("ssn", private_data.SSN, "NOT regexp_matches($, '^(000|666|9)|-00-|-0000$')".replace("0000$", "0000\\z"),
              private_data.EDGES["ssn"], "ssn|social security", 0.3, 0.4),
    _kind_sql("local", private_data.LOCAL, "true", private_data.EDGES["local"],
              "phone|tel|telephone|call|mobile|fax", 0.3, 0.4)])


@query("op13_private_data", f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),{_KINDS_SQL},
base AS (
  SELECT *, [{{'k': 'email', 's': x.s, 'e': x.e}} FOR x IN email] || [{{'k': 'ip', 's': x.s, 'e': x.e}} FOR x IN ip] ||
    [{{'k': 'card', 's': x.s, 'e': x.e}} FOR x IN card] || [{{'k': 'phone', 's': x.s, 'e': x.e}} FOR x IN phone] AS b,
    [{{'k': 'iban', 's': x.s, 'e': x.e}} FOR x IN iban] || [{{'k': 'ssn', 's': x.s, 'e': x.e}} FOR x IN ssn] ||
    [{{'k': 'local', 's': x.s, 'e': x.e}} FOR x IN "local"] AS extra
  FROM email JOIN ip USING (doc_id) JOIN card USING (doc_id) JOIN phone USING (doc_id) JOIN iban USING (doc_id)
  JOIN ssn USING (doc_id) JOIN "local" USING (doc_id)),
everything AS (
  SELECT *, b || [x FOR x IN extra IF len([y FOR y IN b IF x.s < y.e AND y.s < x.e]) = 0] AS spans FROM base)
SELECT doc_id, len(email)::BIGINT AS n_email, len(ip)::BIGINT AS n_ip, len(card)::BIGINT AS n_card,
       len(phone)::BIGINT AS n_phone,
       sha256(coalesce(array_to_string([x.k || ':' || x.s || ':' || x.e FOR x IN b], ','), '')) AS base_sha256,
       coalesce(array_to_string([x.k || ':' || x.s || ':' || x.e FOR x IN spans], ','), '') AS spans
FROM everything""")
def op13(spark, sf_dir):
    out = private_data.find_private(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.col("base_spans")
    return out.select("doc_id", *[private_data.count_of(k.name, base).alias(f"n_{k.name}")
                                  for k in private_data.KINDS if k.base],
                      F.sha2(private_data.as_text(base), 256).alias("base_sha256"),
                      private_data.as_text(F.col("spans")).alias("spans"))


_CRC32_SQL = ("xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')]), "
              "lambda a, b: list_reduce(list_prepend(xor(a, b), [1::BIGINT, 1, 1, 1, 1, 1, 1, 1]), "
              "lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT)")


@query("op12_prefix_trie", f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS donor, {_CRC32_SQL} % 4 AS h FROM t),
r AS (
  SELECT c.conv_id, pos, role, text FROM c JOIN t ON t.conv_id = donor WHERE pos <= h
  UNION ALL SELECT c.conv_id, pos, role, text FROM c JOIN t USING (conv_id) WHERE pos > h),
turns AS (
  SELECT conv_id, row_number() OVER w AS depth, text,
         list(length(role) || ':' || length(text) || ':' || role || text) OVER w AS path
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
member AS (
  SELECT conv_id, depth, text, sha256(array_to_string(path, '')) AS node,
         CASE WHEN depth = 1 THEN 'root' ELSE sha256(array_to_string(path[:-2], '')) END AS up,
         depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM turns
  UNION ALL SELECT conv_id, 0, '', 'root', NULL, NOT EXISTS (FROM r WHERE r.conv_id = c.conv_id) FROM c),
node AS (
  SELECT depth, node, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * len(regexp_extract_all(any_value(text), '[^\\x20\\x09-\\x0D]+')) AS saved,
         sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM member GROUP BY depth, node),
kids AS (SELECT up AS node, count(*) AS n FROM node WHERE up IS NOT NULL GROUP BY up),
full_node AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (node)),
below AS (  -- every node under each node: on the path of the lower node's smallest member
  SELECT m.node, sum(f.saved) AS saved_tokens, count(*) FILTER (f.n_children = 0) AS n_leaves
  FROM full_node f JOIN member m ON m.conv_id = f.conv_id AND m.depth <= f.depth GROUP BY m.node)
SELECT f.conv_id, f.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM full_node f JOIN below USING (node) LEFT JOIN node p ON p.node = f.up""")
def op12(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), group=20)
