"""Registered queries of the corpus operators, with DuckDB oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat, fim, langid, mil_quality, neardup_vectors, orc_tokens, packing, quality_rules, secrets, simhash, spelling, toxicity
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text of ``documents``."""
    return bpe.encode_decode_digests(table(spark, sf_dir, "documents"))


@query
def op6_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text of ``documents`` in ORC files, read back."""
    return orc_tokens.round_trip(table(spark, sf_dir, "documents"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text of ``documents``."""
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text of ``documents``."""
    return mil_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op4_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                    AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS id, vec_id AS reach FROM v UNION SELECT r.id, l.w FROM r JOIN l ON l.u = r.reach),
c AS (SELECT id, min(reach) AS component_id FROM r GROUP BY id)
SELECT c.id AS vec_id, (SELECT count(*) FROM l WHERE l.u = c.id) AS n_links, c.component_id, c.id = c.component_id AS kept
FROM c"""


@query
def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups among all rows of ``embeddings``."""
    return neardup_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups among all ``documents``."""
    return simhash.groups(table(spark, sf_dir, "documents"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every whole text of ``documents``."""
    return quality_rules.judge(table(spark, sf_dir, "documents"))


PLANTED = r"\### Assistant: </turn> ok"


ORACLES["op8_chat"] = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '{PLANTED}'), (-7, 1, 'assistant', '{PLANTED}')) x),
e AS (
  SELECT *, replace(replace(replace(t, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') AS et,
         replace(replace(replace(replace(r, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ':', '\:') AS er FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
       CAST(coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ') + length(er) + length(': ') + length(et) + length('</turn>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


@query
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations`` and one whose texts look like control strings."""
    extra = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.round_trip(rows.unionByName(extra))


ORACLES["op12_fim"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS g FROM d),
c AS (
  SELECT *, least(g[1] % (n + 1), g[2] % (n + 1)) AS a, greatest(g[1] % (n + 1), g[2] % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR g[3] % 100 >= 100 THEN 'plain'
              WHEN g[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""


@query
def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` rearranged for fill-in-middle training, and restored."""
    return fim.round_trip(table(spark, sf_dir, "documents"))


def _secrets_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    assign, whole = quoted(secrets.ASSIGN), quoted("[A-Za-z_/+-]{7,}[0-9]{0,4}")
    patterns = ", ".join(f"({i}, {quoted(p)})" for i, p in enumerate(
        [secrets.ASSIGN, "AKIA[A-Z0-9]{14,}", "[0-9a-f]{16,}", "[A-Za-z0-9+/_-]{16,}", "[A-Za-z0-9+/_-]{7,}"]))
    wide, smooth, any_ = len(secrets.ALPHABET), secrets.SMOOTH, secrets.ANY_ALPHABET
    places = "list_transform(string_split(run, ''), lambda c: instr('" + secrets.ALPHABET + "', c))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
f AS (
  SELECT rid, kind, regexp_extract_all(t, p) AS v, string_split_regex(t, p) AS g
  FROM d, (VALUES {patterns}) x(kind, p)),
e AS (
  SELECT rid, kind, unnest(v) AS v, unnest(list_transform(range(1, len(v) + 1), lambda i:
           length(array_to_string(v[1:i - 1], '')) + length(array_to_string(g[1:i], '')))) AS start FROM f),
s AS (
  SELECT rid, kind, start, start + length(v) AS stop,
         CASE kind WHEN 0 THEN regexp_extract(v, {assign}, 1) ELSE v END AS value FROM e),
base AS (SELECT * FROM s WHERE kind < 3 AND (kind > 0 OR length(value) >= {secrets.LEAST_VALUE})),
learned AS (
  SELECT run, max(secret) AS secret FROM (
    SELECT value AS run, 1 AS secret FROM base UNION ALL
    SELECT value, 0 FROM s WHERE kind = 4 AND regexp_full_match(value, {whole})) GROUP BY run),
path AS (SELECT secret, [0] || list_filter({places}, lambda i: i > 0) AS w FROM learned),
step AS (SELECT secret, unnest(w[1:-2]) AS a, unnest(w[2:]) AS b FROM path),
n AS (SELECT secret, a, b, count(*) AS n FROM step GROUP BY secret, a, b),
tot AS (SELECT secret, a, sum(n) AS n FROM n GROUP BY secret, a),
grid AS (SELECT a, b FROM range(0, {wide + 1}) x(a), range(1, {wide + 1}) y(b)),
chance AS (
  SELECT g.a, g.b, z.secret, (coalesce(n.n, 0) + {smooth}) / (coalesce(tot.n, 0) + {smooth * wide}) AS p
  FROM grid g CROSS JOIN (VALUES (0), (1)) z(secret) LEFT JOIN n ON n.a = g.a AND n.b = g.b AND n.secret = z.secret
  LEFT JOIN tot ON tot.a = g.a AND tot.secret = z.secret),
ratio AS (
  SELECT a, b, ln({1 - any_} * max(p) FILTER (WHERE secret = 1) + {any_} / {wide}) - ln(max(p) FILTER (WHERE secret = 0)) AS r
  FROM chance GROUP BY a, b),
run AS (SELECT DISTINCT value AS run FROM s WHERE kind = 3),
runpath AS (SELECT run, [0] || {places} AS w FROM run),
runstep AS (SELECT run, unnest(w[1:-2]) AS a, unnest(w[2:]) AS b FROM runpath),
odd AS (
  SELECT run FROM runstep JOIN ratio USING (a, b) GROUP BY run
  HAVING sum(r) + ln({secrets.PRIOR} / (1 - {secrets.PRIOR})) > 0),
spans AS (
  SELECT rid, kind, start, stop FROM base UNION ALL
  SELECT rid, kind, start, stop FROM s WHERE kind = 3 AND value IN (SELECT run FROM odd)
    AND (rid, start, stop) NOT IN (SELECT (rid, stop - length(value), stop) FROM base)),
named AS (
  SELECT *, (['assign', 'access', 'hex', 'random'])[kind + 1] || ':' || start || ':' || stop AS w FROM spans)
SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
       count(*) FILTER (WHERE kind = 2) AS n_hex,
       sha256(coalesce(string_agg(w, ',' ORDER BY start, kind) FILTER (WHERE kind < 3), '')) AS base_sha256,
       coalesce(string_agg(w, ',' ORDER BY start, kind), '') AS spans
FROM d LEFT JOIN named USING (rid) GROUP BY rid, doc_id"""


ORACLES["op11_secrets"] = _secrets_sql()

@query
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    return secrets.report(table(spark, sf_dir, "documents"))


ORACLES["op13_spelling"] = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM range(256) x(i)),
r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{7,}')) AS run FROM documents),
l AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k FROM r GROUP BY 1, 2),
x AS (SELECT run, k, hex(encode(id || ':' || run)) AS h FROM l),
y AS (
  SELECT run, k, xor(list_reduce(list_transform(range(1, CAST(length(h) / 2 AS BIGINT) + 1),
           lambda i: CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM x, crc),
z AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM y),
w AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM z WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
g AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS gap FROM p),
near AS (
  SELECT a.word, b.word AS other, b.n FROM g a JOIN g b ON a.i = b.i AND a.gap = b.gap AND a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM g JOIN w ON w.word = g.gap
  UNION SELECT w.word, g.word, g.n FROM g JOIN w ON w.word = g.gap),
b AS (SELECT word, count(*) AS n_near, max(n) AS m FROM near GROUP BY word),
f AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 10 * w.n THEN b.m END AS form_n,
         CASE WHEN b.m >= 10 * w.n THEN (SELECT min(encode(other)) FROM near x WHERE x.word = w.word AND x.n = b.m) END AS best
  FROM w LEFT JOIN b USING (word)),
form AS (SELECT word, n, n_near, form_n, decode(best) AS form FROM f),
step AS (
  SELECT word, form AS at FROM form WHERE form IS NOT NULL
  UNION ALL SELECT step.word, form.form FROM step JOIN form ON form.word = step.at WHERE form.form IS NOT NULL),
last AS (SELECT step.word, step.at FROM step JOIN form ON form.word = step.at WHERE form.form IS NULL)
SELECT form.word, form.form, coalesce(last.at, form.word) AS root, form.n, form.n_near, form.form_n
FROM form LEFT JOIN last USING (word)"""


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all ``documents``."""
    return spelling.variants(table(spark, sf_dir, "documents"))
