"""The operators' queries over whole tables, and the SQL that some must agree with."""

from __future__ import annotations

import math
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepframe.llm import bpe, decontaminate, fingerprints, html_extract, lang_id, licences, line_dedup, merkle, quality, quality_rules, secret_scan, simhash, whitening
from prepframe.llm.words import words_of

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(parts: int):
    """The fold of a document: crc32 of its id as text, modulo the number of parts."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(3) == 1)
    model = lang_id.fit_language_model(docs.where("NOT held_out"))
    return lang_id.label_languages(docs, model, "text", ["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), VOCABULARY, "text", ["doc_id"], ids=False)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.remove_repeated_passages(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("removed", lambda x: F.concat(x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))), ",")
    return found.select("doc_id", "text", "n_removed", spans.alias("removed"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents")).drop("matches")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(5) == 0)
    ranking = quality.fit_ranking(docs, table(spark, sf_dir, "labels").where(fold(5) != 0))
    return quality.score_quality(docs, ranking, "text", ["doc_id", "held_out"])


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("starts", "ends")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.summarise_secrets(table(spark, sf_dir, "documents"))


#: Fields of a leaf of the manifest, in order.
LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", line_dedup.UPPER, line_dedup.LOWER)
    tampered = F.when(fold(5) == 0, merkle.leaf_digest([*[F.col(c) for c in LEAF_FIELDS[:-1]], lower]))
    return merkle.manifest(docs, LEAF_FIELDS, other=tampered)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality_rules.fit_rules(docs, table(spark, sf_dir, "labels").where(fold(5) != 0))
    return quality_rules.apply_rules(docs, forest, "text", ["doc_id"])


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.fit_whitening(vectors).transform(vectors)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_bpe,
        op3_line_dedup,
        op4_fingerprints,
        op5_html_extract,
        op6_simhash,
        op7_licence_scan,
        op8_quality,
        op9_decontaminate,
        op10_secret_scan,
        op11_merkle,
        op12_quality_rules,
        op13_whitening,
    )
}

_LOW = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words_sql(text: str) -> str:
    return rf"regexp_extract_all({_LOW.format(text)}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"


_WORDS = _words_sql("coalesce(text, chr(32))")

#: Between paragraphs: line ends with a wordless line, or several, between them.
_BREAK = r"\n[^0-9A-Za-z\x{80}-\x{10FFFF}]*\n"


def _licence_sql() -> str:
    """Phrases by place, every line against every template, and every window of a paragraph that holds a template's words."""

    def places(phrase: str) -> str:
        own = phrase.split()
        test = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(own))
        return f"list_filter(range(1, len(w) - {len(own) - 2}), lambda i: {test})"

    rows = []
    for number, (text, label) in enumerate(licences.TEMPLATES):
        own = sorted({x.decode() for x in words_of(text)})
        rows.append(f"({number}, '{label}', [{', '.join(repr(x) for x in own)}], {math.ceil(licences.THRESHOLD * len(own) - 1e-9)}, {licences.window_of(text)})")
    each = [(places(p), label) for p, label in licences.PHRASES]
    found = ", ".join(f"CASE WHEN len({x}) > 0 THEN '{label}' END" for x, label in each)
    return f"""
WITH templates(t, label, own, needed, span) AS (VALUES {", ".join(rows)}),
docs AS (SELECT doc_id, text, {_WORDS} AS w FROM documents),
base AS (
  SELECT doc_id, len(w) AS n_words, {" || ".join(x for x, _ in each)} AS spots,
         list_filter([{found}], lambda x: x IS NOT NULL) AS labels FROM docs),
lines AS (SELECT DISTINCT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs WHERE text IS NOT NULL),
met AS (
  SELECT doc_id, label, len(list_intersect(list_distinct(lw), own)) AS held, len(own) AS size, needed
  FROM (SELECT doc_id, {_words_sql("line")} AS lw FROM lines) l, templates),
paragraphs AS (
  SELECT DISTINCT doc_id, unnest(regexp_split_to_array(text, '{_BREAK}')) AS paragraph FROM docs WHERE contains(text, chr(10))),
wide AS (
  SELECT doc_id, label, own, needed, span, pw
  FROM (SELECT doc_id, {_words_sql("paragraph")} AS pw FROM paragraphs WHERE contains(trim(paragraph, chr(10)), chr(10))) p, templates
  WHERE len(list_intersect(list_distinct(pw), own)) >= needed),
spread AS (
  SELECT doc_id, label, list_max(list_transform(range(1, greatest(len(pw) - span, 0) + 2), lambda i: len(list_intersect(list_distinct(list_slice(pw, i, i + span - 1)), own)))) AS held,
         len(own) AS size, needed FROM wide),
more AS (
  SELECT doc_id, list(DISTINCT label) AS labels, max(held / size) AS score
  FROM (SELECT * FROM met UNION ALL SELECT * FROM spread) WHERE held >= needed GROUP BY doc_id)
SELECT doc_id, n_words, len(spots) AS n_base, list_min(spots) - 1 AS first_word, list_max(spots) - 1 AS last_word,
       array_to_string(list_sort(b.labels), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(b.labels || coalesce(m.labels, []))), ',') AS labels,
       CASE WHEN len(spots) > 0 THEN 1.0 ELSE coalesce(score, 0.0) END::DOUBLE AS score
FROM base b LEFT JOIN more m USING (doc_id)"""


def _merkle_sql() -> str:
    """Trees level by level; each row's path as the joined digests left and right of it."""

    def leaf(text: str) -> str:
        each = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END" for c in [*LEAF_FIELDS[:-1], text]]
        return f"sha256({' || '.join(f'({x})' for x in each)})"

    bits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    crc = f"xor(list_reduce([4294967295] || {bits}, lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"

    def levels(name: str, base: str) -> str:
        return f"""{name} AS (
  {base}
  UNION ALL
  SELECT tree, level + 1, idx // {merkle.FAN}, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + {merkle.FAN - 1}) // {merkle.FAN})
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // {merkle.FAN})"""

    def runs(name: str, nodes: str) -> str:
        return f"""{name} AS (
  SELECT tree, level, idx // {merkle.FAN} AS run, list(digest ORDER BY idx) AS own FROM {nodes} WHERE n > 1 GROUP BY tree, level, idx // {merkle.FAN})"""

    def path(place: str, runs: str, tree: str, first: int) -> str:
        at = f"({place} // ({merkle.FAN} ** level)::BIGINT)"
        return f"""SELECT doc_id, {first} + level AS step, array_to_string(own[:{at} % {merkle.FAN}], '') AS l,
         array_to_string(own[{at} % {merkle.FAN} + 2:], '') AS r
  FROM placed JOIN {runs} ON {runs}.tree = {tree} AND run = {at} // {merkle.FAN}"""

    return f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, {leaf("text")} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf(_LOW.format("text"))} ELSE {leaf("text")} END AS held
  FROM documents),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
  FROM hashed),
{levels("nodes", "SELECT tree, 0 AS level, idx, leaf AS digest, n FROM placed")},
subroots AS (SELECT tree, digest FROM nodes WHERE n = 1),
{levels("tops", "SELECT 0::BIGINT AS tree, 0 AS level, tree AS idx, digest, (SELECT count(*) FROM subroots) AS n FROM subroots")},
top AS (SELECT digest AS root FROM tops WHERE n = 1),
{runs("low", "nodes")},
{runs("high", "tops")},
path AS (
  {path("idx", "low", "placed.tree", 0)}
  UNION ALL
  {path("placed.tree", "high", "0", 100)}),
proofs AS (
  SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY step)) AS proof, list(l || '|' || r ORDER BY step) AS beside FROM path GROUP BY doc_id),
found AS (
  SELECT p.doc_id, leaf, s.digest AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256,
         list_reduce([held] || coalesce(beside, []), lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root
  FROM placed p JOIN subroots s USING (tree) CROSS JOIN top LEFT JOIN proofs USING (doc_id))
SELECT *, folded_root = root AS verified FROM found"""


ORACLES: dict[str, str] = {
    "op11_merkle": _merkle_sql(),
    "op7_licence_scan": _licence_sql(),
    "op3_line_dedup": rf"""
WITH pieces AS (
  SELECT doc_id, text, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS k
  FROM (SELECT doc_id, text, regexp_extract_all({_LOW.format('text')}, '(?:[^ \t\n\x0B\f\r。！？]*[。！？]|[^ \t\n\x0B\f\r。！？]+)[ \t\n\x0B\f\r]*') AS pieces FROM documents)),
words AS (
  SELECT *, rtrim(piece, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS word,
         length(text) - sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS spot
  FROM pieces),
ends AS (
  SELECT *, contains('{line_dedup.SENTENCE_ENDS}', right(word, 1)) OR md5(word)[:{len(line_dedup.MARK)}] < '{line_dedup.MARK}' OR contains(piece, chr(10)) AS last FROM words),
numbered AS (
  SELECT *, coalesce(count(*) FILTER (WHERE last) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM ends),
cut AS (
  SELECT doc_id, place, length(any_value(text)) AS size, CASE WHEN place = 0 THEN 0 ELSE min(spot) END AS start, string_agg(word, ' ' ORDER BY k) AS unit,
         count(*) AS n FROM numbered GROUP BY doc_id, place),
units AS (
  SELECT doc_id, place, start, coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY place), size) AS stop, unit,
         greatest(n, length(regexp_replace(unit, '[^\p{{Han}}\p{{Hiragana}}\p{{Katakana}}\p{{Thai}}\p{{Lao}}\p{{Khmer}}\p{{Myanmar}}]', '', 'g')) // 2) AS words
  FROM cut),
kept AS (
  SELECT *, first_value(doc_id) OVER w AS k_id, first_value(place) OVER w AS k_place FROM units WINDOW w AS (PARTITION BY unit ORDER BY doc_id, place)),
gone AS (
  SELECT *, place - row_number() OVER w AS run, k_place - place AS shift, sum(words) OVER w AS upto
  FROM kept WHERE NOT (doc_id = k_id AND place = k_place) WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
found AS (
  SELECT doc_id, min(place) AS a, max(place) AS b FROM gone GROUP BY doc_id, run, k_id, shift
  HAVING max(upto) - min(upto - words) >= {line_dedup.MIN_WORDS} AND 2 * sum(words) >= max(upto) - min(upto - words)),
marked AS (
  SELECT u.*, EXISTS (SELECT 1 FROM found f WHERE f.doc_id = u.doc_id AND place BETWEEN a AND b) AS away FROM units u),
spans AS (
  SELECT doc_id, min(start) AS start, max(stop) AS stop, count(*) AS n
  FROM (SELECT *, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM marked WHERE away) GROUP BY doc_id, run),
removed AS (
  SELECT doc_id, sum(n) AS n_removed, string_agg(start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start) AS removed FROM spans GROUP BY doc_id),
stays AS (
  SELECT doc_id, string_agg(CASE WHEN away THEN '' ELSE substring(text, start::BIGINT + 1, (stop - start)::BIGINT) END, '' ORDER BY place) AS text
  FROM marked JOIN documents USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.text, d.text) AS text, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN removed USING (doc_id) LEFT JOIN stays s USING (doc_id)""",
    "op9_decontaminate": f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {decontaminate.WINDOW}) AS n,
         unnest(list_transform(range(1, greatest(len(w) - {decontaminate.WINDOW - 1}, 1) + 1),
                lambda i: array_to_string(list_slice(w, i, i + {decontaminate.WINDOW - 1}), ' '))) AS gram
  FROM items WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS spot,
         unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(list_slice(w, i, i + n - 1), ' '))) AS gram
  FROM docs, sizes WHERE len(w) >= n),
found AS (SELECT doc_id, g.n, spot, item_id FROM grams g JOIN windows v ON g.gram = v.gram AND g.n = v.n),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(spot, spot + n)) AS word FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {decontaminate.SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
}
