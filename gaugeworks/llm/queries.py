"""The registered queries of the document operators, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import (bit_packing, bloom_lm, language_id, licenses, minmax_dedup, mixing, packing, periodic_runs, prefix_trie, quality_qda,
                            quality_rules, url_templates, vector_forest)
from gaugeworks.llm.stats import with_stats
from gaugeworks.llm.text import WORD_PATTERN, crc_mod
from gaugeworks.session import cut

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def quality_labels(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, quality``, one row per id; ids with contradictory labels are left out."""
    return (table(spark, sf, "labels").where("quality in (0, 1)").groupBy("doc_id")
            .agg(F.min("quality").alias("quality"), F.max("quality").alias("_max")).where("quality = _max").drop("_max"))


MIX_WEIGHTS = [5, 2, 1]

ORACLES["op1_source_mix"] = r"""
WITH docs AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM docs GROUP BY source),
w AS (SELECT *, [5, 2, 1][sid % 3 + 1]::BIGINT AS weight, 3 * source_size AS cap FROM src),
lev AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tgt AS (SELECT *, CASE WHEN level > cap / weight THEN cap::DOUBLE
  ELSE max(CASE WHEN level <= cap / weight THEN level END) OVER () * weight END AS target FROM lev),
pos AS (SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS quota,
  sum(size) OVER (PARTITION BY source ORDER BY md5('7:' || coalesce(doc_id::VARCHAR, 'null')), size ROWS UNBOUNDED PRECEDING)::BIGINT - size AS start
  FROM docs JOIN tgt USING (source))
SELECT doc_id, size, source_size, target, (greatest(0, least(size, quota - start)) + greatest(0, least(size, quota - source_size - start))
  + greatest(0, least(size, quota - 2 * source_size - start)))::BIGINT AS taken FROM pos"""


@_query
def op1_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    """Words that the mix by weights 5, 2, 1 takes of every document."""
    return mixing.taken(mixing.mix(table(spark, sf, "documents"), MIX_WEIGHTS))


@_query
def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Counts, base verdict and risk-controlled verdict of every document; strata are the languages."""
    stats = cut(with_stats(table(spark, sf, "documents"), keep=["doc_id", "lang"]))
    labels = quality_labels(spark, sf).select("doc_id", (F.col("quality") == 1).alias("good"))
    judged = quality_rules.with_verdict(stats, quality_rules.learn_cutoffs(stats, labels, "lang"), "lang")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "failed_rule")


@_query
def op3_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of every document; rows whose crc32 remainder is 0 are never learnt from."""
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    stats = cut(with_stats(table(spark, sf, "documents"), keep=["doc_id"]))
    model = quality_qda.fit(stats.where(~held_out).join(quality_labels(spark, sf), "doc_id"), "quality")
    return quality_qda.with_score(stats, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: The rules on hosts and paths.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

def _sql_level(d: int) -> str:
    """One level of the tree of templates: children, variable branches, merged children, longer prefixes."""
    part = f"parts[{d + 1}]" if d < 15 else "array_to_string(parts[16:], '/')"
    share = "(gg + 10.0 * every) / (ll + 10.0)"
    return f"""k{d} AS MATERIALIZED (SELECT host, prefix, {part} AS part, sum(n) AS n, sum(labels) AS l, sum(goods) AS g FROM t{d} WHERE len(parts) > {d} GROUP BY ALL),
b{d} AS (SELECT host, prefix, sum(n) AS nn, sum(l) AS ll, sum(g) AS gg FROM k{d} GROUP BY ALL HAVING exp(ln(sum(n)) - sum(n * ln(n)) / sum(n)) > 20.5),
m{d} AS (SELECT host, prefix, part FROM k{d} JOIN b{d} USING (host, prefix) CROSS JOIN ev
  WHERE 20 * n < nn AND NOT (l > 0 AND abs(g / l - {share}) > 2.58 * sqrt({share} * (1 - {share}) / l))),
t{d + 1} AS MATERIALIZED (SELECT t.* REPLACE (CASE WHEN len(parts) > {d} THEN t.prefix || '/' || (CASE WHEN m.part IS NULL THEN {part} ELSE '*' END) ELSE t.prefix END AS prefix,
  CASE WHEN len(parts) > {d} THEN list_append(t.t, CASE WHEN m.part IS NULL THEN {part} ELSE '*' END) ELSE t.t END AS t)
  FROM t{d} t LEFT JOIN m{d} m ON m.host = t.host AND m.prefix = t.prefix AND m.part = {part} AND len(parts) > {d}),"""


ORACLES["op4_url_filter"] = r"""
WITH r AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
p AS (SELECT page_id, CASE WHEN instr(u, '://') > 0 THEN substr(u, instr(u, '://') + 3) ELSE '' END AS rest FROM r),
q AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
lab AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id HAVING min(quality) = max(quality)),
m AS (SELECT page_id, host, path, regexp_replace(regexp_replace(path, '^/', ''), '[0-9]+', '*', 'g') AS shape, good
  FROM q LEFT JOIN lab ON doc_id = TRY_CAST(regexp_extract(path, '([0-9]+)[^0-9/]*/?$', 1) AS BIGINT)),
s AS (SELECT host, shape, count(*) AS n, count(good) AS labels, coalesce(sum(good), 0) AS goods FROM m GROUP BY host, shape),
ev AS (SELECT (coalesce(sum(goods), 0) + 1)::DOUBLE / (coalesce(sum(labels), 0) + 2) AS every FROM s),
t0 AS (SELECT *, string_split(shape, '/') AS parts, '' AS prefix, []::VARCHAR[] AS t FROM s),
{levels}lv AS (SELECT host, shape, labels, goods, d AS depth, CASE WHEN d = 0 THEN '' ELSE '/' || array_to_string(t[1:d], '/') END AS node,
  CASE WHEN d = 0 THEN NULL WHEN d = 1 THEN '' ELSE '/' || array_to_string(t[1:d - 1], '/') END AS parent
  FROM (SELECT *, unnest(range(len(t) + 1)) AS d FROM t16)),
nd AS (SELECT host, depth, node, sum(labels)::DOUBLE AS labels, sum(goods)::DOUBLE AS goods, max(parent) AS parent FROM lv GROUP BY ALL),
ab AS (SELECT nd.*, CASE WHEN nd.depth = 0 THEN every ELSE (u.goods + 10.0 * every) / (u.labels + 10.0) END AS above
  FROM nd CROSS JOIN ev LEFT JOIN nd u ON u.host = nd.host AND u.depth = nd.depth - 1 AND u.node = nd.parent WHERE nd.labels > 0),
jd AS (SELECT host, depth, node, (goods + 10.0 * above) / (labels + 10.0) AS purity FROM ab
  WHERE abs(goods / labels - above) > 2.58 * sqrt(above * (1 - above) / labels)),
bad AS (SELECT host, shape FROM lv JOIN jd USING (host, depth, node) GROUP BY host, shape HAVING arg_max(purity, depth) < 0.5),
rl AS (SELECT page_id, m.host, path, shape, CASE
  WHEN (m.host = 'example.com' OR ends_with(m.host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (m.host = 'example.net' OR ends_with(m.host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (m.host = 'org' OR ends_with(m.host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (m.host = 'net' OR ends_with(m.host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM m)
SELECT page_id, rl.host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM rl LEFT JOIN bad ON bad.host = rl.host AND bad.shape = rl.shape""".replace("{levels}", "\n".join(map(_sql_level, range(16))))


@_query
def op4_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Verdict on every url. The last number of a path names the document whose quality label the page has."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    number = F.regexp_extract(url_templates.host_and_path(F.col("url"))[1], "([0-9]+)[^0-9/]*/?$", 1)
    labels = quality_labels(spark, sf).select(F.col("doc_id").alias("_doc"), F.col("quality").alias("good"))
    pages = pages.join(labels, number.try_cast("bigint") == F.col("_doc"), "left").drop("_doc")
    return url_templates.judge_urls(pages, URL_RULES)


@_query
def op5_bloom_lm(spark: SparkSession, sf: str) -> DataFrame:
    """Base and model score of every document; rows whose crc32 remainder is 2 are never learnt from."""
    docs, held_out = table(spark, sf, "documents"), crc_mod(F.col("doc_id"), 7) == 2
    model, rare = bloom_lm.learn(docs.where(~held_out))
    return bloom_lm.score(docs, model, rare, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@_query
def op6_vector_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Links of all embeddings with a cosine of at least 0.95, and their components."""
    found = vector_forest.vector_links(table(spark, sf, "embeddings"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


@_query
def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's place in bins of 2,048 words; equal texts never share a bin."""
    return packing.pack(table(spark, sf, "documents"))


@_query
def op8_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Best licence of every document, its Dice coefficient, and the number of lines in matches."""
    return licenses.scan_licenses(table(spark, sf, "documents"), keep=["doc_id"])


@_query
def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document; rows whose crc32 remainder is 2 are never learnt from."""
    docs = table(spark, sf, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = language_id.learn(docs.where(~held_out))
    return language_id.with_language(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


@_query
def op10_minmax_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate groups of all documents: three-word shingles, similarity of at least 0.85."""
    found = minmax_dedup.near_duplicates(table(spark, sf, "documents"), width=3, percent=85)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


#: SQL text of the unsigned crc32 of decimal digits: every byte is followed by eight shifts (-1) of the remainder.
_SQL_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({0}, ''), lambda ch:
  [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1
  THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295)"""

ORACLES["op11_periodic_runs"] = r"""
WITH src AS (SELECT row_number() OVER () AS r, doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS w,
  CASE WHEN doc_id IS NOT NULL THEN {crc} ELSE 1 END AS h FROM documents),
par AS (SELECT *, h // 10 AS g, len(w) AS n FROM src),
pa2 AS (SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM par),
pa3 AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM pa2),
docs AS (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
  list_transform(range(n), lambda i: w[(CASE WHEN i < a THEN i ELSE a + (i - a) % p END)::BIGINT + 1]) ELSE w END AS w FROM pa3),
win AS (SELECT r, n, i, hash(w[i + 1], w[i + 2], w[i + 3], w[i + 4], w[i + 5]) AS x, w[i + 1:i + 5] AS five FROM (SELECT r, n, w, unnest(range(n - 4)) AS i FROM docs WHERE n > 5)),
eq AS (SELECT u.r, u.i, v.i - u.i AS d FROM win u JOIN win v ON u.r = v.r AND u.x = v.x AND u.five = v.five AND v.i > u.i AND v.i - u.i <= u.n / 4),
isl AS (SELECT r, d, min(i) AS s, count(*) + 4 AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY r, d ORDER BY i) AS grp FROM eq) GROUP BY r, d, grp),
runs AS (SELECT r, s, l + d AS length, min(d) AS period FROM isl WHERE l + d >= 6 AND l >= 3 * d GROUP BY r, s, l + d),
best AS (SELECT r, s, length, period, row_number() OVER (PARTITION BY r ORDER BY length::DECIMAL(38, 10) / period DESC, s, period) AS k FROM runs),
txt AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || length || ',' || period || chr(10), '' ORDER BY s, period) AS t FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + period, s + length)) AS i FROM runs),
col AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS c FROM (SELECT r, unnest(range(n)) AS i, unnest(w) AS x FROM docs) ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
  (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(t, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
FROM docs LEFT JOIN txt ON txt.r = docs.r LEFT JOIN best ON best.r = docs.r AND k = 1 LEFT JOIN col ON col.r = docs.r""".replace(
    "{crc}", _SQL_CRC32.format("doc_id::VARCHAR"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: of each tenth document, by crc32 of its id, the words from a place on repeat in a period. Rows
    without an id stay as they are."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD_PATTERN), F.lit(0))

    def repeated(w):
        n, g = F.size(w).cast("long"), F.floor(F.col("_crc") / 10)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        # Place and period are values of their own within the list of places, worked out once a text.
        at = F.transform(F.array(F.struct(a.alias("a"), p.alias("p"))), lambda v: F.transform(
            F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < v["a"], i).otherwise(v["a"] + (i - v["a"]) % v["p"])))[0]
        return F.array_join(F.transform(at, lambda i: F.get(w, i.cast("int"))), " ")

    planted = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)))[0]
    return (docs.select("doc_id", "text", crc.alias("_crc"))
            .select("doc_id", F.when(F.col("_crc") % 10 == 0, planted).otherwise(F.col("text")).alias("text")))


@_query
def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of every document, after some texts have been made periodic: their number, the most repeated one, and digests of
    all runs and of the collapsed text."""
    found = periodic_runs.with_runs(with_planted_runs(table(spark, sf, "documents")), keep=["doc_id"])
    best = F.aggregate("runs", F.expr("cast(null as struct<start:long,length:long,period:long>)"), lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@_query
def op12_bit_packed_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Place, number and checksum of the token ids of every document, read back from the files of packed ids."""
    import public_tokenizers

    folder = bit_packing.fresh_folder(spark)
    bit_packing.write_files(table(spark, sf, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return bit_packing.read_documents(spark, folder)


ORACLES["op13_prefix_trie"] = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
  md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {crc} % 4 AS h, conv_id - conv_id % 20 AS base FROM (SELECT DISTINCT conv_id FROM t)),
a AS (SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = c.base AND pos <= h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h),
b AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS pos, md5(length(role) || ':' || role || text) AS d,
  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS words FROM a),
l AS (SELECT c.conv_id, coalesce(list(d ORDER BY pos) FILTER (d IS NOT NULL), []) AS ds, coalesce(list(words ORDER BY pos) FILTER (d IS NOT NULL), []) AS ws
  FROM c LEFT JOIN b ON b.conv_id = c.conv_id GROUP BY c.conv_id),
m AS (SELECT conv_id, len(ds) AS size, d AS depth, array_to_string(ds[1:d], ',') AS node, CASE WHEN d > 0 THEN array_to_string(ds[1:d - 1], ',') END AS parent,
  CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS words FROM (SELECT *, unnest(range(len(ds) + 1)) AS d FROM l)),
n AS (SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
  coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '') AS ends FROM m GROUP BY depth, node),
k AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (depth, node)),
u AS (SELECT x.depth, x.node, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved
  FROM v JOIN m ON m.conv_id = v.conv_id AND m.depth <= v.depth JOIN n x ON x.depth = m.depth AND x.node = m.node GROUP BY ALL)
SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs, v.n_children::BIGINT AS n_children,
  u.n_leaves::BIGINT AS n_leaves, u.saved::BIGINT AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM v JOIN u ON u.depth = v.depth AND u.node = v.node LEFT JOIN n p ON p.depth = v.depth - 1 AND p.node = v.parent""".replace(
    "{crc}", _SQL_CRC32.format("conv_id::VARCHAR"))


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of conversations that begin like the first one of their twenty, and all conversations, turnless ones included."""
    plain = cut(prefix_trie.numbered(cut(prefix_trie.turn_digests(conversations)), ["turn"]))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    convs = cut(plain.select("conv").distinct())
    heads = plain.where("conv % 20 = 0 and pos <= 3").select(F.col("conv").alias("base"), "pos", "digest", "words")
    given = (convs.withColumn("h", h).join(heads, (F.col("conv") - F.col("conv") % 20 == F.col("base")) & (F.col("pos") <= F.col("h")))
             .select("conv", F.lit(0).alias("part"), "pos", "digest", "words"))
    own = plain.where(F.col("pos") > h).select("conv", F.lit(1).alias("part"), "pos", "digest", "words")
    return cut(prefix_trie.numbered(cut(given.unionByName(own)), ["part", "pos"])), convs


@_query
def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """All nodes of the prefix trie of the rebuilt conversations."""
    nodes, ends = prefix_trie.prefix_trie(*rebuilt_turns(table(spark, sf, "conversations")))
    return nodes.join(prefix_trie.ends_digests(ends), ["depth", "key"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
