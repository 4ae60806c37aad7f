"""The operators on their whole tables, and the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathwarden.llm import bag_minhash, bk_tree, byte_bpe, chunk_dedup, decontaminate, host_quality, html_text, license_scan, sharding, suffix_dedup, turn_repair, url_filter, whitening
from pathwarden.session import cut_lineage
from pathwarden.sources.location_view import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_qgram_leaks")
def op1(spark, d):
    return decontaminate.find_leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def _license_sql() -> str:
    """The scan by brute force: every block against every template."""
    needs = license_scan._needs(license_scan.PHRASES, license_scan.TEMPLATES, license_scan.THRESHOLD)
    width = max(len(t.split()) for t in [*license_scan.PHRASES, *[t for t, _ in license_scan.TEMPLATES]])
    templates = ", ".join(f"('{label}', {tokens}, {need})" for _, kind, label, tokens, need in needs if kind == "template")
    places = " UNION ALL ".join(
        f"SELECT row, i - 1 AS place, '{label}' AS label FROM (SELECT row, words, unnest(range(1, len(words) + 1)) AS i FROM w "
        f"WHERE list_has_all(words, {phrase.split()})) WHERE " + " AND ".join(f"words[i + {k}] = '{word}'" for k, word in enumerate(phrase.split()))
        for phrase, label in license_scan.PHRASES.items()
    )
    return rf"""
WITH w AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{license_scan.UPPER}', '{license_scan.LOWER}'), '{license_scan.WORD}') AS words
  FROM documents),
blocks AS (
  SELECT row, list_distinct(words[s + 1 : s + {2 * width}]) AS piece
  FROM (SELECT row, words, unnest(range(0, len(words), {width})) AS s FROM w)),
templates(label, tokens, need) AS (VALUES {templates}),
met AS (SELECT row, label, len(list_intersect(piece, tokens)) AS met, len(tokens) AS size, need FROM blocks, templates),
found AS (SELECT row, list(DISTINCT label) AS labels, max(met / size) AS score FROM met WHERE met >= need GROUP BY row),
places AS ({places}),
base AS (SELECT row, count(*) AS n, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY row)
SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, found.labels))), ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(score, 0) END AS score
FROM w LEFT JOIN base USING (row) LEFT JOIN found USING (row)
"""


@query("op2_license_scan", _license_sql())
def op2(spark, d):
    return license_scan.scan(table(spark, d, "documents"))


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
URL_SQL = rf"""
WITH rules(host, path, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
cut AS (
  SELECT row_number() OVER () AS row, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (
  SELECT row, page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
fits AS (
  SELECT row, r.host || r.path AS rule, verdict,
         row_number() OVER (PARTITION BY row ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS n
  FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT page_id, u.host, u.path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN (SELECT * FROM fits WHERE n = 1) USING (row)
"""


@query("op3_url_rules", URL_SQL)
def op3(spark, d):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, d, "pages"), rules)


@query("op4_suffix_dedup")
def op4(spark, d):
    return suffix_dedup.dedup(table(spark, d, "documents"), with_kept=False)


@query("op5_near_duplicates")
def op5(spark, d):
    found = bag_minhash.classes(table(spark, d, "documents"))
    return found.withColumn("kept", F.col("class_id") == F.col("doc_id"))


@query("op6_html_text")
def op6(spark, d):
    return html_text.extract(table(spark, d, "pages").select("page_id", "url", "html")).drop("html")


HOST_SQL = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text, row_number() OVER () AS row,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT row, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS k
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
repeated AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, k) AS n FROM windows) WHERE n > 1),
marked AS (
  SELECT row, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT row, i + unnest([0, 1, 2]) AS j FROM repeated) GROUP BY row),
lined AS (SELECT row, unnest(string_split(text, chr(10))) AS line FROM w),
lines AS (
  SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lined WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row),
m AS (
  SELECT doc_id, source, len(words) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM w LEFT JOIN marked USING (row) LEFT JOIN lines USING (row)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
f AS (SELECT *, base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines AS rule_failed FROM b),
hosts AS (SELECT source, count(*) AS n, CAST(count(*) FILTER (WHERE rule_failed) AS DOUBLE) AS x FROM f GROUP BY source),
moments AS (SELECT avg(x / n) AS m, var_samp(x / n) AS v, avg(1 / n) AS d FROM hosts),
prior AS (
  SELECT m, CASE WHEN coalesce(v - m * (1 - m) * d, 0) > 0 THEN greatest(m * (1 - m) / (v - m * (1 - m) * d) - 1, 0) END AS s
  FROM moments),
verdicts AS (SELECT source, coalesce((x + m * s) / (n + s), m) AS host_rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       round(host_rate, 9) AS host_rate, NOT base_failed AND host_rate < 0.9 AS kept
FROM f JOIN verdicts ON f.source IS NOT DISTINCT FROM verdicts.source
"""


@query("op7_host_quality", HOST_SQL)
def op7(spark, d):
    # The measures are a thin table: stored once, read for the hosts and for the verdicts.
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    measured = cut_lineage(host_quality.with_measures(docs).drop("text"))
    judged = host_quality.judge(measured, host_quality.host_verdicts(measured))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.round("host_rate", 9).alias("host_rate"), "kept"
    )


SHARD_SQL = """
WITH s AS (
  SELECT doc_id, source, CAST(coalesce(strlen(text), 0) AS BIGINT) + 1 AS size, md5('interleave-1:' || doc_id) AS o FROM documents),
r AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY o, doc_id) - 1) / (2 * count(*) OVER (PARTITION BY source)) AS share,
         count(*) OVER () AS n FROM s),
p AS (SELECT *, row_number() OVER (ORDER BY share, source, o, doc_id) - 1 AS place FROM r)
SELECT doc_id, size, 'rows' AS law, CAST(place * 8 // n AS INTEGER) AS shard,
       CAST(place - ((place * 8 // n) * n + 7) // 8 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM p
"""


@query("op8_interleave")
def op8(spark, d):
    rows = sharding.interleave(table(spark, d, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op8_interleave_places", SHARD_SQL)
def op8_places(spark, d):
    """The shards without the checksum, which DuckDB lacks."""
    return op8(spark, d).drop("text_crc32")


@query("op9_merge_replay")
def op9(spark, d):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, d, "documents").select("doc_id", "text")
    return byte_bpe.digest_columns(docs, ranks, public_tokenizers.PATTERN).drop("text")


@query("op10_chunk_dedup")
def op10(spark, d):
    return chunk_dedup.cut_repeats(table(spark, d, "documents").select("doc_id", "text"))


#: The damage of op11 by crc32 of `conv_id:turn` modulo 20: 0 drops, 1 empties, 2 takes the sentence ends, 3 repeats, 4 makes user.
def _damaged(rows: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    drawn = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("fate"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    left = drawn.where("fate != 0").withColumn("copy", F.explode(copies))
    new_text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return left.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), new_text.alias("text"))


def _repair_sql() -> str:
    """All lists of edits of each rest of a conversation, the best of each state of the grammar kept as text."""
    never = 1_000_000_000
    state = lambda cost, audit, said: f"{{'c': {cost}, 'a': {audit}, 't': {said}}}"
    said = lambda role: f"[{role} || ':' || text]"
    keep = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    fill = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}

    def options(s):
        to, role = fill[s]
        yield state(f"4 + g{s}.c", f"'D' || g{s}.a", f"g{s}.t")
        yield state(f"CASE WHEN must THEN {never} ELSE 3 + extra + g{to}.c END", f"'R' || g{to}.a", f"list_concat([{chr(39)}{role}:{chr(39)} || text], g{to}.t)")
        for initial, to in keep[s].items():
            yield state(f"CASE WHEN must OR initial <> '{initial}' THEN {never} ELSE extra + g{to}.c END", f"'K' || g{to}.a", f"list_concat({said('role')}, g{to}.t)")

    inserted = lambda g, role: state(f"3 + {g}.c", f"'I' || {g}.a", f"list_concat(['{role}:'], {g}.t)")
    least = ", ".join(f"list_min([{', '.join(options(s))}]) AS b{s}" for s in range(4))
    return rf"""
WITH RECURSIVE drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
fated AS (
  SELECT *, xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT)),
         lambda c, b: list_reduce([xor(c, b)] || [CAST(0 AS BIGINT)] || list_transform(range(7), lambda i: CAST(0 AS BIGINT)),
                                  lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 AS fate FROM drawn),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copy FROM fated WHERE fate <> 0),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place FROM damaged),
fault AS (
  SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank,
         row_number() OVER (PARTITION BY conv, role, text ORDER BY place) > 1 AS again,
         NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut, left(role, 1) AS initial,
         lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY place) AS previous FROM placed),
turns AS (
  SELECT conv, place, role, text, initial, blank OR again AS must, CASE WHEN cut AND NOT blank AND NOT again THEN 3 ELSE 0 END AS extra FROM fault),
rest AS (
  SELECT conv, max(place) AS place, {state("0", "''", "CAST([] AS VARCHAR[])")} AS g0, {state("6", "'II'", "['user:', 'assistant:']")} AS g1,
         {state("3", "'I'", "['assistant:']")} AS g2, {state("0", "''", "CAST([] AS VARCHAR[])")} AS g3 FROM turns GROUP BY conv
  UNION ALL
  SELECT conv, place - 1, list_min([b0, {inserted("f2", "user")}]), list_min([b1, {inserted("f2", "user")}]), f2, f3 FROM (
    SELECT *, list_min([b2, {inserted("b3", "assistant")}]) AS f2, list_min([b3, {inserted("b2", "user")}]) AS f3 FROM (
      SELECT turns.conv, turns.place, {least} FROM rest JOIN turns USING (conv, place)))),
figures AS (
  SELECT conv_id, min(conv) AS conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE NOT blank AND again) AS duplicate, count(*) FILTER (WHERE NOT blank AND NOT again AND cut) AS truncated,
         count(*) FILTER (WHERE previous || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM fault GROUP BY conv_id)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(g0.c, 0) AS BIGINT) AS cost, coalesce(g0.a, '') AS audit,
       sha256(coalesce(array_to_string(g0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN figures ON ids.conv_id IS NOT DISTINCT FROM figures.conv_id
LEFT JOIN rest ON rest.conv = figures.conv AND rest.place = 0
"""


@query("op11_turn_repair", _repair_sql())
def op11(spark, d):
    rows = table(spark, d, "conversations")
    return turn_repair.audits(_damaged(rows), also=rows)


@query("op12_bk_trees")
def op12(spark, d):
    found = bk_tree.near_components(table(spark, d, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


@query("op13_whitening")
def op13(spark, d):
    return whitening.whiten(table(spark, d, "embeddings"))
