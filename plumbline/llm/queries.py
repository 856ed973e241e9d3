"""The registered queries of this package, each next to its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    decontam,
    langid,
    lexical,
    licences,
    lines,
    merkle,
    neardup,
    pagetext,
    pieces,
    pii,
    quality,
    scoring,
    tokencounts,
)
from plumbline.llm.stored import table

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def vocabulary(name: str = "piece_bpe_32k.model") -> str:
    """Where the public tokenizers keep a file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of their decoding."""
    docs = table(spark, sf_dir, "documents")
    found = pieces.round_trips(docs, pieces.model_bytes(vocabulary()))
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_differing")


@query("op3_near_duplicates")
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of similar documents that each document belongs to."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


_LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keys AS (
  SELECT doc_id, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first FROM keys WHERE length(key) >= 10 GROUP BY key
), judged AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(f.first < k.doc_id, FALSE) AS gone
  FROM keys k LEFT JOIN firsts f ON f.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query("op5_line_dedup", _LINES_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the lines that an earlier one has."""
    kept = lines.deduplicated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op2_personal_data")
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of plain and disguised identifiers of every document."""
    return pii.counted(pii.personal_data(table(spark, sf_dir, "documents")))


def _licences_sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(n)}, {quote(t)})" for n, t in licences.KNOWN)
    bare = r"""regexp_replace(regexp_replace(lower(coalesce(text, '')),
      '(?m)^[^\p{L}\p{N}\n©(]*(copyright[ \t]*(\(c\)|©|[0-9])|\(c\)|©)[^\n]*', '', 'g'),
      '[^\p{L}\p{N}\n]+', ' ', 'g')"""
    for old, new in licences.SPELLINGS:
        bare = f"replace({bare}, {quote(old)}, {quote(new)})"
    whole = "sha256(trim(regexp_replace(lines, '[ \\n]+', ' ', 'g'), ' '))"
    return f"""
WITH known AS (
  SELECT digest, min(licence) AS licence FROM (
    SELECT licence, {whole} AS digest
    FROM (SELECT licence, {bare} AS lines FROM (VALUES {values}) AS k(licence, text)))
  GROUP BY digest
), forms AS (SELECT doc_id, {bare} AS lines FROM documents
), parts AS (
  SELECT doc_id, trim(unnest(string_split(lines, chr(10))), ' ') AS line FROM forms
), notices AS (
  SELECT doc_id, count(*) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS names
  FROM (SELECT doc_id, sha256(line) AS digest FROM parts WHERE line <> '') p
  JOIN known USING (digest) GROUP BY doc_id
), whole AS (SELECT doc_id, {whole} AS digest FROM forms)
SELECT w.doc_id, w.digest, k.licence, coalesce(n.n, 0) AS n_notices, coalesce(n.names, '') AS licences
FROM whole w LEFT JOIN known k ON k.digest = w.digest LEFT JOIN notices n ON n.doc_id = w.doc_id
"""


@query("op7_licence_scan", _licences_sql())
def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences that equal a document or one of its lines."""
    return licences.scanned(table(spark, sf_dir, "documents"), licences.known_digests(spark))


_QUALITY_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split(translate(coalesce(text, ''),
      ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '      '), ' '), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x,
      ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '') AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, words[i:i+4] AS part
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM texts WHERE len(words) >= 5)
), twice AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, part) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, sum(least(5, coalesce(later - i, 5))) AS n FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS later FROM twice)
  GROUP BY doc_id
), stutters AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT doc_id, words, unnest(range(2, len(words) + 1)) AS i FROM texts) WHERE words[i] = words[i - 1]
  GROUP BY doc_id
), measures AS (
  SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(length(regexp_replace(text, '\P{Lu}', '', 'g')) AS BIGINT) AS n_upper,
    CAST(length(regexp_replace(text, '\P{L}', '', 'g')) AS BIGINT) AS n_letters,
    CAST(coalesce(s.n, 0) AS BIGINT) AS n_stutter
  FROM texts t LEFT JOIN covered c ON c.doc_id = t.doc_id LEFT JOIN stutters s ON s.doc_id = t.doc_id
), book AS (SELECT *, CAST(FAILED AS BIGINT) AS failed FROM measures)
SELECT *, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM book
"""
_QUALITY_SQL = _QUALITY_SQL.replace(
    "FAILED AS BIGINT",
    " + ".join(f"CASE WHEN {c} THEN {1 << r} ELSE 0 END" for r, c in enumerate(quality.RULES.values()))
    + " AS BIGINT",
)


@query("op8_quality_rules", _QUALITY_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of every document and the verdict of the latest policy."""
    return quality.judged(quality.ledger(table(spark, sf_dir, "documents")))


_ABLATION_SQL = f"WITH judged AS ({_QUALITY_SQL}) " + " UNION ALL ".join(
    f"""SELECT '{rule}' AS rule, '{quality.LATEST}' AS policy, count(*) FILTER (failed & {bit} <> 0) AS failing,
      count(*) FILTER (failed = {bit}) AS "only", count(*) FILTER (failed = 0) AS kept,
      count(*) FILTER (failed & ~{bit} = 0) AS kept_without FROM judged"""
    for rule, bit in ((rule, quality.bits([rule])) for rule in quality.RULES)
)


@query("op8_ablation", _ABLATION_SQL)
def op8_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the latest policy costs, alone and beside the others."""
    return quality.ablation(quality.ledger(table(spark, sf_dir, "documents")))


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    found = decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "question_overlap", "answer_overlap")


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, and whether it has one."""
    found = langid.identified(langid.document_evidence(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "declared", "language", "posterior", "n_grams", "kept")


@query("op10_page_language")
def op10_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page, by its text, its markup, and its address."""
    found = langid.identified(langid.page_evidence(table(spark, sf_dir, "pages")))
    return found.select(F.col("doc_id").alias("page_id"), "declared", "language", "posterior", "n_grams", "kept")


@query("op9_page_text")
def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pagetext.main_texts(table(spark, sf_dir, "pages"))


@query("op4_model_scores")
def op4_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The context-mixing score of every document beside its unigram score."""
    return scoring.scored(table(spark, sf_dir, "documents"))


_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
_MANIFEST_SQL = f"""
WITH RECURSIVE table_of_crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))
), checked AS (
  SELECT documents.*, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 7 = 0 AS shown
  FROM documents, table_of_crc
), leaves AS (
  SELECT doc_id, lang AS tree, {_LEAF} AS leaf,
    CASE WHEN shown THEN {_LEAF.replace("CAST(n_chars AS VARCHAR)", "CAST(n_chars + 1 AS VARCHAR)")}
      ELSE {_LEAF} END AS given
  FROM checked
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n
  FROM leaves
), nodes(tree, lvl, pos, n, h) AS (
  SELECT tree, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT tree, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY tree, lvl, pos // 2, n
), tops AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), uppers(lvl, pos, n, h) AS (
  SELECT 0, pos, n, h FROM tops
  UNION ALL
  SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM uppers WHERE n > 1 GROUP BY lvl, pos // 2, n
), steps AS (
  SELECT p.tree, p.pos, 0 AS part, l.lvl, s.h, (p.pos >> l.lvl) & 1 AS side
  FROM placed p
  JOIN (SELECT DISTINCT tree, lvl FROM nodes WHERE n > 1) l ON l.tree IS NOT DISTINCT FROM p.tree
  LEFT JOIN nodes s ON s.tree IS NOT DISTINCT FROM p.tree AND s.lvl = l.lvl AND s.pos = xor(p.pos >> l.lvl, 1)
  UNION ALL
  SELECT p.tree, p.pos, 1, l.lvl, s.h, (t.pos >> l.lvl) & 1
  FROM placed p JOIN tops t ON t.tree IS NOT DISTINCT FROM p.tree
  CROSS JOIN (SELECT DISTINCT lvl FROM uppers WHERE n > 1) l
  LEFT JOIN uppers s ON s.lvl = l.lvl AND s.pos = xor(t.pos >> l.lvl, 1)
), ways AS (
  SELECT tree, pos, sha256(coalesce(string_agg(h, '' ORDER BY part, lvl), '')) AS proof_sha256,
    list(CASE WHEN h IS NULL THEN '-' WHEN side = 1 THEN 'L' || h ELSE 'R' || h END ORDER BY part, lvl) AS way
  FROM steps GROUP BY tree, pos
), ends AS (
  SELECT p.doc_id, p.leaf, t.h AS subroot, (SELECT h FROM uppers WHERE n = 1) AS root,
    coalesce(w.proof_sha256, sha256('')) AS proof_sha256,
    list_reduce(list_prepend(p.given, coalesce(w.way, [])), lambda a, b: sha256(
      CASE WHEN b = '-' THEN a WHEN b[1] = 'L' THEN b[2:] || a ELSE a || b[2:] END)) AS folded_root,
    p.pos AS rank, p.n AS tree_leaves
  FROM placed p JOIN tops t ON t.tree IS NOT DISTINCT FROM p.tree
  LEFT JOIN ways w ON w.tree IS NOT DISTINCT FROM p.tree AND w.pos = p.pos
)
SELECT *, folded_root = root AS verified FROM ends
"""


@query("op13_merkle_manifest", _MANIFEST_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and check of every document."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query("op12_token_counts")
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return tokencounts.token_counts(table(spark, sf_dir, "documents"), pieces.model_bytes(vocabulary()))


_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
_SEARCH_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL
), sized AS (SELECT r, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0
), totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sized
), counts AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM sized) GROUP BY r, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
), asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), scores AS (
  SELECT a.item_id, c.r, any_value(s.doc_id) AS doc_id,
    CAST(sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 20 * (100 - 50 + ((50 * s.n * t.docs) // t.length)))))
      AS BIGINT) AS score
  FROM asked a JOIN counts c ON c.term = a.term JOIN weights w ON w.term = a.term JOIN sized s ON s.r = c.r, totals t
  GROUP BY a.item_id, c.r
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank
  FROM scores WHERE score > 0)
WHERE rank <= 50
"""


@query("op11_ranked_search", _SEARCH_SQL)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents of every benchmark item."""
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
