"""Registered queries of the training-data operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.shared import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Only A-Z: the engines' lower() would fold other letters too.
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


# Smallest id reachable over links l(a, b), for the nodes of n(id): appended to a WITH list.
REACH = """
either AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(id, goal) AS (SELECT id, id FROM n UNION SELECT r.id, either.b FROM reach r JOIN either ON either.a = r.goal),
component AS (SELECT id, min(goal) AS component_id FROM reach GROUP BY id)
"""

JACCARD_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array({ASCII_LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS size, unnest(sh) AS g FROM s),
l AS (SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.size, y.size HAVING 100 * count(*) >= 85 * (x.size + y.size - count(*))),
n AS (SELECT doc_id AS id FROM documents), {REACH}
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id FROM s JOIN component ON id = doc_id
"""


@query("op2_jaccard_join", JACCARD_SQL)
def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.jaccard import jaccard_components

    return jaccard_components(read(spark, folder, "documents"), width=4, percent=85).select("doc_id", "n_shingles", "component_id")


@query("op3_best_fit_pack")
def op3_best_fit_pack(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from tidemark.llm.packing import best_fit_pack, token_pieces

    found = token_pieces(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)
    return best_fit_pack(found, 4096)


LINES_SQL = f"""
WITH line AS (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM
  (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
keyed AS (SELECT *, {ASCII_LOWER.format("regexp_replace(regexp_replace(line, '^[ \\x09-\\x0D]+', ''), '[ \\x09-\\x0D]+$', '')")} AS key FROM line),
repeated AS (SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
judged AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id > r.keeper AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query("op5_line_dedup", LINES_SQL)
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tidemark.llm.lines import dedup_lines

    found = dedup_lines(read(spark, folder, "documents"), least=10)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op6_language_id")
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tidemark.llm.langid import fit, held_out, predict

    docs = read(spark, folder, "documents").withColumn("held_out", held_out(F.col("doc_id")))
    return predict(docs.select("doc_id", "held_out", "text"), fit(docs.where("not held_out"))).drop("text")


@query("op8_token_files")
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from tidemark.llm.tokenfile import read_token_files, write_token_files

    return read_token_files(*write_token_files(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0))


EMBEDDING_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
n AS (SELECT vec_id AS id FROM v), {REACH},
links AS (SELECT a, count(*) AS n_links FROM either GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN component ON id = vec_id LEFT JOIN links ON a = vec_id
"""


@query("op1_embedding_dedup", EMBEDDING_SQL)
def op1_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.embed import embedding_groups

    return embedding_groups(read(spark, folder, "embeddings"), threshold=0.93)


@query("op9_decontaminate")
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.decontaminate import mark_leaks

    return mark_leaks(read(spark, folder, "documents").select("doc_id", "text"), read(spark, folder, "benchmark")).drop("text")


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tidemark.llm.secrets import digest, find_secrets

    found = find_secrets(read(spark, folder, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(digest(F.col("base")), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))


@query("op4_surrogates")
def op4_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.privacy import replace_private

    return replace_private(read(spark, folder, "documents").select("doc_id", "text"), key="tidemark")


REPEATS_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, x, h[2 * x + 1 : 2 * x + 100] AS s FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS x FROM d WHERE n >= 50)),
f AS (SELECT md5(s) AS k, min(doc_id) AS least FROM w GROUP BY 1),
hit AS (SELECT w.doc_id, x FROM w JOIN f ON md5(w.s) = f.k WHERE w.doc_id > f.least),
edge AS (SELECT doc_id, x, CASE WHEN x <= lag(x) OVER o + 50 THEN 0 ELSE 1 END AS fresh FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY x)),
island AS (SELECT doc_id, min(x) AS a, max(x) + 50 AS e FROM (SELECT doc_id, x, sum(fresh) OVER (PARTITION BY doc_id ORDER BY x) AS g FROM edge) GROUP BY doc_id, g),
gap AS (SELECT doc_id, e AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS z FROM island UNION ALL SELECT doc_id, 0, min(a) FROM island GROUP BY doc_id),
total AS (SELECT doc_id, sum(e - a) AS gone, count(*) AS spans FROM island GROUP BY doc_id),
kept AS (SELECT g.doc_id, string_agg(h[2 * a + 1 : 2 * coalesce(z, n)], '' ORDER BY a) AS k FROM gap g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN total ON total.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""


@query("op7_repeated_bytes", REPEATS_SQL)
def op7_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tidemark.llm.repeats import remove_repeats

    return remove_repeats(read(spark, folder, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(64 * x)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op11_top_k", TOP_K_SQL)
def op11_top_k(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.topk import top_k

    return top_k(read(spark, folder, "embeddings"), k=20, every=20, scale=64)


INTERACTION_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (SELECT doc_id, part, concat(CASE WHEN len(ws) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' END,
  CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' END, CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
  CASE WHEN doc_id > least THEN 'E' END) AS fails FROM w),
g AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n FROM f LEFT JOIN g USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT part, filter_order, step, filter_order[step] AS letter, fails, good, toxic, n,
  list_min(list_transform(string_split(fails, ''), lambda l: CASE WHEN l = '' THEN 6 ELSE instr(filter_order, l) END)) AS gone
  FROM c, o, (SELECT unnest(range(1, 6)) AS step)),
t AS (SELECT part, filter_order, step, letter, sum(n) FILTER (WHERE gone > step) AS kept, sum(n) FILTER (WHERE gone = step) AS removed,
  sum(n) FILTER (WHERE gone < step AND contains(fails, letter)) AS redundant, sum(n) FILTER (WHERE fails = letter) AS unique_fails,
  sum(n * good) FILTER (WHERE gone = step) AS good_lost, sum(n * toxic) FILTER (WHERE gone = step) AS toxic_lost
  FROM s GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, letter), 0) AS BIGINT) AS shapley
FROM t
"""


@query("op12_filter_audit", INTERACTION_SQL)
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    from tidemark.llm.interaction import filter_interactions

    return filter_interactions(read(spark, folder, "documents"), read(spark, folder, "labels"))


def _codes_sql(rounds: int = 6) -> str:
    """Lloyd rounds as a chain of views: an entry's components by (part, entry, place), all parts compared with all entries in each."""
    near = """a{n} AS (SELECT row, part, arg_min(entry, (dist, entry)) AS entry, min(dist) AS dist FROM (SELECT x.row, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v)) AS dist
  FROM x JOIN b{n} b ON b.part = x.part AND b.place = x.place GROUP BY x.row, x.part, b.entry) GROUP BY row, part)"""
    move = """m{n} AS (SELECT x.part, a.entry, x.place, CAST(floor(sum(x.v) / count(*)) AS BIGINT) AS v FROM x JOIN a{n} a ON a.row = x.row AND a.part = x.part GROUP BY x.part, a.entry, x.place),
b{next} AS (SELECT b.part, b.entry, b.place, coalesce(m.v, b.v) AS v FROM b{n} b LEFT JOIN m{n} m ON m.part = b.part AND m.entry = b.entry AND m.place = b.place)"""
    steps = ",\n".join(near.format(n=n) + ",\n" + move.format(n=n, next=n + 1) for n in range(rounds)) + ",\n" + near.format(n=rounds)
    return f"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(4096 * x) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT row, i // (len // 8) AS part, i % (len // 8) AS place, e[i + 1] AS v FROM (SELECT row, e, len(e) AS len, unnest(range(len(e))) AS i FROM k)),
b0 AS (SELECT part, row AS entry, place, v FROM x WHERE row < 16),
{steps},
book AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM b{rounds}),
code AS (SELECT row, string_agg('0' || substr('0123456789abcdef', CAST(entry AS INT) + 1, 1), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error FROM a{rounds} GROUP BY row)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM k JOIN code USING (row), book
"""


@query("op13_vector_codes", _codes_sql())
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    import hashlib

    from pyspark.sql import functions as F

    from tidemark.llm.compress import product_codes, with_label_error

    coded, books = product_codes(read(spark, folder, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.lower(F.hex("code")).alias("code")
    return with_label_error(coded).select("vec_id", code, "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
