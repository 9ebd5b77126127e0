"""The operators as registered queries, each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.llm import (
    byte_bpe, decontaminate, language_id, licenses, line_dedup, merkle, ngram_join, packing, periodic, pseudonyms, quality, training_order,
    url_filter,
)
from tidewatt.llm.shared import prepare, small, stored

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.link_documents(table(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark, sf_dir):
    rows = quality.judged(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", *[F.col(f"_quality.{c}") for c in quality.COUNTS[:5]],
                       F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


@query
def op3_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op4_line_dedup(spark, sf_dir):
    """Per document: its lines that go, and the length and CRC-32 of the text that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = line_dedup.repeated(docs)
    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    rows = docs.join(small(stored(gone, "repeated"), "size(exact) + size(near) + 1"), "doc_id", "left")
    drop = F.coalesce(F.concat("exact", "near"), F.array().cast("array<bigint>"))
    kept = F.concat_ws("\n", F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("drop"), i.cast("long"))))
    rows = rows.withColumns({"n_lines": lines, "n_exact": size("exact"), "n_near": size("near"), "drop": drop})
    rows = rows.withColumn("kept", F.when(F.size("drop") == 0, F.col("text")).otherwise(kept))
    return rows.select("doc_id", "n_lines", "n_exact", "n_near", F.length("kept").cast("long").alias("kept_chars"),
                       F.crc32(F.encode("kept", "UTF-8")).alias("kept_crc32"))


@query
def op6_training_order(spark, sf_dir):
    """Place and digest of every sequence, from the shards as written."""
    docs, path = table(spark, sf_dir, "documents"), training_order.scratch(spark)
    rows = training_order.materialize(docs, path, key=20240501)
    kind = training_order.layout(spark, path) or ("<u2", training_order.LENGTH, training_order.STRIDE)
    return training_order.digest(rows, *kind)


@query
def op7_pii_pseudonyms(spark, sf_dir):
    """Every document with pseudonyms in its text; the key is a parameter of the operator, this one is for tests."""
    rows = pseudonyms.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), b"registered query")
    return rows.select("doc_id", "text", *[F.col(f"_replaced.{k}").alias(f"n_{k}") for k in pseudonyms.NAMES])


@query
def op10_benchmark_decontamination(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~language_id.held_out()))
    found = language_id.identify(docs, model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query
def op5_license_scan(spark, sf_dir):
    """Documents as files of a tree source/language/hundreds; every sixteenth is its directory's licence file."""
    name = F.when(F.col("doc_id") % 16 == 0, F.concat(F.lit("LICENSE-"), "doc_id")).otherwise(F.concat("doc_id", F.lit(".txt")))
    folder = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")),
                         F.expr("doc_id div 10000"), F.expr("doc_id div 100"))
    files = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", folder, name).alias("path"), "text")
    return licenses.scan(files)


@query
def op9_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query
def op11_byte_bpe(spark, sf_dir):
    """Digests of the ids of every text, and of the bytes they decode to."""
    return byte_bpe.digest(byte_bpe.decoded(byte_bpe.encoded(table(spark, sf_dir, "documents"))))


@query
def op12_merkle_manifest(spark, sf_dir):
    """Every row against a copy in which some texts are lower-cased."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.when(F.expr("crc32(cast(doc_id as string)) % 5 = 0"), lowered).otherwise(F.col("text"))
    return merkle.manifest(table(spark, sf_dir, "documents"), found)


@query
def op13_periodic_runs(spark, sf_dir):
    """Runs of every text, a tenth of which has a period planted."""
    return periodic.digest(periodic.detect(periodic.planted(table(spark, sf_dir, "documents"))))


# ---- SQL forms of the operators that have one --------------------------------------------------

WORD = r"[^\x20\x09-\x0D]+"
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op1_ngram_jaccard_join"] = f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all({LOWERED}, '{WORD}') AS ws FROM documents),
s AS MATERIALIZED (SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END)) AS g FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT l.v, r.c FROM r JOIN l ON l.u = r.doc_id)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.c) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""


def _quartile_sql(name: str, keys: str) -> str:
    """Quartile buckets of the merged sketches k by keys."""
    return f"""{name} AS (SELECT {keys} r, max(total) AS total, min(b) FILTER (4 * seen >= total) AS low,
  min(b) FILTER (4 * seen >= 3 * total) AS high FROM (SELECT *, sum(d) OVER (PARTITION BY {keys} r ORDER BY b) AS seen,
  sum(d) OVER (PARTITION BY {keys} r) AS total FROM (SELECT {keys} r, b, sum(d) AS d FROM k GROUP BY {keys} r, b)) GROUP BY {keys} r)"""


RATIO_ROWS = ", ".join(
    f"('{r}', {scale} * {top} // greatest({under}, 1), {least}, {str(below).lower()})"
    for r, (top, under, scale, least, below) in quality.RATIOS.items())

SQL["op2_quality_rules"] = f"""
WITH w AS MATERIALIZED (SELECT doc_id, coalesce('=' || lang, '-') AS l, coalesce('=' || source, '-') AS s, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
li AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup FROM
  (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM w) WHERE regexp_matches(x, '{WORD}') GROUP BY doc_id),
tri AS (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri),
  (VALUES (0), (1), (2)) AS o(j) WHERE c > 1 GROUP BY doc_id),
f AS MATERIALIZED (SELECT w.doc_id, l, s, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
  coalesce(rep.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
  length(regexp_replace(t, '[^!-/:-@\\[-`{{-~]', '', 'g')) AS n_marks
  FROM w LEFT JOIN li ON li.doc_id = w.doc_id LEFT JOIN rep ON rep.doc_id = w.doc_id),
b AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
v AS MATERIALIZED (SELECT b.doc_id, l, s, base_failed, x.r, x.v, x.least, x.below, greatest(length(bin(x.v)) - 6, 0) AS shift
  FROM b, LATERAL (VALUES {RATIO_ROWS}) AS x(r, v, least, below)),
k AS MATERIALIZED (SELECT l, s, r, (v >> shift) << shift AS b, count(*) AS d FROM v WHERE NOT base_failed GROUP BY ALL),
{_quartile_sql('own', 'l, s,')}, {_quartile_sql('by_lang', 'l,')}, {_quartile_sql('world', '')},
q AS (SELECT own.l, own.s, own.r,
  CASE WHEN own.total >= {quality.LEAST_DOCS} THEN own.low WHEN by_lang.total >= {quality.LEAST_DOCS} THEN by_lang.low ELSE world.low END AS low,
  CASE WHEN own.total >= {quality.LEAST_DOCS} THEN own.high WHEN by_lang.total >= {quality.LEAST_DOCS} THEN by_lang.high ELSE world.high END AS high
  FROM own JOIN by_lang ON by_lang.l = own.l AND by_lang.r = own.r JOIN world ON world.r = own.r),
out AS (SELECT doc_id, bool_and(v.v <= high + greatest({quality.FENCE} * (high - low), least)
  AND (NOT below OR v.v >= low - greatest({quality.FENCE} * (high - low), least))) AS inside
  FROM v JOIN q ON q.l = v.l AND q.s = v.s AND q.r = v.r GROUP BY doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(inside, true) AS kept
FROM b LEFT JOIN out ON out.doc_id = b.doc_id"""


# CRC-32 of a short text, byte by byte and bit by bit.
_CRC_SQL = """xor(list_reduce([4294967295::UBIGINT] || [ascii(c)::UBIGINT FOR c IN string_split({0}, '')], lambda a, b:
  list_reduce([xor(a, b)] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)),
  4294967295::UBIGINT)"""


def _levels_sql(name: str, group: str, n: int) -> str:
    """CTEs name1 .. name<n>: the nodes (group, i, h) of each level above name0; a level with one node stays as it is."""
    parts = []
    for k in range(1, n + 1):
        last = f"{name}{k - 1}"
        parts.append(f"""{name}{k} AS MATERIALIZED (SELECT {group}, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {last}
  WHERE ({group}) IN (SELECT {group} FROM {last} GROUP BY {group} HAVING count(*) > 1) GROUP BY {group}, i // 16
  UNION ALL SELECT {group}, i, h FROM {last} WHERE ({group}) IN (SELECT {group} FROM {last} GROUP BY {group} HAVING count(*) = 1))""")
    return ",\n".join(parts)


def _way_sql(name: str, group: str, n: int) -> str:
    """CTEs name_s0 .. : the nodes before (b) and after (a) each node in its run; name_p: the way up of each node of level 0."""
    parts = [f"""{name}_s{k} AS MATERIALIZED (SELECT x.{group}, x.i, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i < x.i), '') AS b,
  coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (WHERE y.i > x.i), '') AS a, count(y.i) > 0 AS up, max(c.n) > 1 AS higher
  FROM {name}{k} x JOIN (SELECT {group}, count(*) AS n FROM {name}{k} GROUP BY {group}) c ON c.{group} = x.{group}
  LEFT JOIN {name}{k} y ON y.{group} = x.{group} AND y.i // 16 = x.i // 16 AND y.i <> x.i GROUP BY x.{group}, x.i)""" for k in range(n)]
    way = " || ".join(f"CASE WHEN s{k}.higher THEN [{{'b': s{k}.b, 'a': s{k}.a}}] ELSE [] END" for k in range(n))
    joins = " ".join(f"JOIN {name}_s{k} s{k} ON s{k}.{group} = x.{group} AND s{k}.i = CASE WHEN {' AND '.join(f's{j}.higher' for j in range(k)) or 'true'} "
                     f"THEN x.i // {16 ** k} ELSE 0 END" for k in range(n))
    parts.append(f"{name}_p AS MATERIALIZED (SELECT x.{group}, x.i, {way} AS way FROM {name}0 x {joins})")
    return ",\n".join(parts)


# Levels enough for 16 ** 5 rows a source and 16 ** 3 sources.
_FIELD_SQL = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || {0}, '-')"
_LEAF_SQL = " || ".join(_FIELD_SQL.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}"))
SQL["op12_merkle_manifest"] = f"""
WITH d AS (SELECT *, CASE WHEN {_CRC_SQL.format("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN {LOWERED} ELSE text END AS found FROM documents),
l AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '-') AS s, sha256({_LEAF_SQL.format("text")}) AS h,
  sha256({_LEAF_SQL.format("found")}) AS other FROM d),
r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM l),
t0 AS MATERIALIZED (SELECT s, i, h FROM r),
{_levels_sql("t", "s", 5)},
{_way_sql("t", "s", 5)},
u0 AS MATERIALIZED (SELECT 0 AS g, row_number() OVER (ORDER BY s) - 1 AS i, h, s FROM t5),
{_levels_sql("u", "g", 3)},
{_way_sql("u", "g", 3)},
f AS (SELECT r.doc_id, r.h AS leaf, r.other, t5.h AS subroot, u3.h AS root, t_p.way || u_p.way AS way
  FROM r JOIN t_p ON t_p.s = r.s AND t_p.i = r.i JOIN t5 ON t5.s = r.s JOIN u0 ON u0.s = r.s JOIN u_p ON u_p.i = u0.i, u3)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string([x.b || x.a FOR x IN way], '')) AS proof_sha256,
  list_reduce([{{'b': other, 'a': ''}}] || way, lambda m, x: {{'b': sha256(x.b || m.b || x.a), 'a': ''}}).b AS folded_root,
  folded_root = root AS verified FROM f"""
