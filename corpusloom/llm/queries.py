"""Registered queries of the training-data operators: production parameters, whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import collocations, decontam, html_extract, imatch, jaccard_join, line_dedup, pii, quality, ranked_search, secrets, spm_codec, token_counts, token_files
from corpusloom.llm.storage import load

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: The key of the PII pseudonyms where the session sets none under ``corpusloom.pii.key``.
PII_KEY = "corpusloom-demonstration-key"


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.ngram_jaccard_classes(load(spark, sf_dir, "documents"), n=4, percent=85)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract_pages(pages).withColumn("n_chars", F.length("text").cast("long"))


def op3_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digest(load(spark, sf_dir, "documents"), BYTE_BPE, end_id=0)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm_codec.round_trip_digest(load(spark, sf_dir, "documents"), PIECE_BPE)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs, load(spark, sf_dir, "labels")).select("doc_id", "expected_grade", "tail_probability", "keep")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_digest(secrets.find_secrets(load(spark, sf_dir, "documents")))


def sample_edits(text: F.Column) -> F.Column:
    """Three edits of each text: a replacement at a quarter, an insertion in the middle, a deletion
    at three quarters."""
    n = F.length(text).cast("long")
    one = lambda start, size, new: F.struct(F.floor(start).cast("long").alias("start"), (F.floor(start) + size).cast("long").alias("end"), F.lit(new).alias("new"))
    return F.array(one(n / 4, 12, " revised text"), one(n / 2, 0, "inserted words, 2026 "), one(n * 3 / 4, 200, ""))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text").withColumn("edits", sample_edits(F.col("text")))
    return token_counts.count_with_edits(docs, BYTE_BPE)


def op8_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.imatch_edits(load(spark, sf_dir, "documents"))


def pii_key(spark: SparkSession) -> str:
    return spark.conf.get("corpusloom.pii.key", PII_KEY)


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise_pii(load(spark, sf_dir, "documents").select("doc_id", "text"), pii_key(spark))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines_digest(load(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(load(spark, sf_dir, "documents"))


def secret_scan_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op6 that SQL can express: the base kinds."""
    return op6_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def imatch_edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op8 that SQL can express: the edited texts."""
    rows = imatch.with_next(load(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(imatch.edited_text(), 256).alias("edited_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_html_extraction, op3_token_id_files, op4_sentencepiece, op5_quality_classifier,
        op6_secret_scan, op7_token_counts, op8_imatch_fingerprints, op9_pii_pseudonyms, op10_benchmark_decontamination,
        op11_ranked_search, op12_line_dedup, op13_collocations,
        secret_scan_base, imatch_edited_texts,
    )
}

#: All pairs of documents with a shingle in common, closed over links: for small tables.
JACCARD_SQL = """WITH RECURSIVE
w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT count(*) FROM e WHERE e.a = d.doc_id) AS n_links, (SELECT min(c) FROM r WHERE r.doc_id = d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id"""


def _secret_sql() -> str:
    """Matches of each kind by regular expressions; a match starts behind the pieces and matches
    before it."""
    either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    names = "|".join(either(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    quote = "[\"'']?"
    kinds = (
        (0, "assign", f"({names}){quote}\\x20*[:=]\\x20*{quote}([A-Za-z0-9+/_.=-]+)", 2, 8),
        (1, "access", "AKIA[A-Z0-9]+", 0, 16),
        (2, "hex", "[0-9a-f]+", 0, 32),
    )
    parts = [f"SELECT doc_id, {o} AS o, '{name}' AS kind, regexp_extract_all(text, '{p}') AS ms, regexp_split_to_array(text, '{p}') AS ps, list_transform(regexp_extract_all(text, '{p}', {group}), lambda x: length(x) >= {least}) AS ok FROM documents" for o, name, p, group, least in kinds]
    return f"""WITH m AS ({' UNION ALL '.join(parts)}),
k AS (SELECT *, unnest(list_filter(range(1, len(ms) + 1), lambda i: ok[i])) AS k FROM m),
x AS (SELECT doc_id, o, kind, k, CAST(list_sum(list_transform(ps[1:k], lambda t: length(t))) + coalesce(list_sum(list_transform(ms[1:k - 1], lambda t: length(t))), 0) AS BIGINT) AS s, length(ms[k]) AS n FROM k)
SELECT d.doc_id, count(*) FILTER (WHERE o = 0) AS n_assign, count(*) FILTER (WHERE o = 1) AS n_access, count(*) FILTER (WHERE o = 2) AS n_hex, sha256(coalesce(string_agg(kind || ':' || s || ':' || (s + n), ',' ORDER BY s, o), '')) AS base_sha256
FROM documents d LEFT JOIN x ON x.doc_id = d.doc_id GROUP BY d.doc_id"""


EDITED_SQL = """WITH o AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id) AS k, count(*) OVER () AS n FROM documents)
SELECT a.doc_id, length(a.text) AS n_chars, sha256(left(a.text, length(a.text) - length(a.text) // 2) || left(b.text, length(a.text) // 2)) AS edited_sha256
FROM o a JOIN o b ON b.k = a.k % a.n + 1"""

#: Every document that shares a term with an item is scored.
RANKED_SQL = """WITH w AS (SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents
  UNION ALL SELECT 'i', item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) FROM benchmark),
p AS (SELECT id AS doc_id, term, count(*) AS tf, CAST(sum(count(*)) OVER (PARTITION BY id) AS BIGINT) AS n FROM w WHERE side = 'd' GROUP BY id, term),
t AS (SELECT count(DISTINCT doc_id) AS docs, CAST(sum(tf) AS BIGINT) AS words FROM p),
v AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, t GROUP BY term, docs),
s AS (SELECT i.id AS item_id, p.doc_id, CAST(sum(v.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words)))) AS BIGINT) AS score
  FROM (SELECT DISTINCT id, term FROM w WHERE side = 'i') i JOIN p USING (term) JOIN v USING (term), t GROUP BY i.id, p.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 10"""

LINES_SQL = """WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
l AS (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS pos FROM s),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
g AS (SELECT k, max(doc_id) AS owner FROM k WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT k.*, coalesce(doc_id < owner, false) AS gone FROM k LEFT JOIN g USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM d GROUP BY doc_id"""

#: Every phrase is counted.
PHRASES_SQL = """WITH p AS (SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda w: w <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents)),
u AS (SELECT lang, id, unnest(w) AS w, generate_subscripts(w, 1) AS pos FROM (SELECT *, row_number() OVER () AS id FROM p)),
x AS (SELECT lang, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM u WINDOW o AS (PARTITION BY id ORDER BY pos)),
g AS (SELECT lang, 1 AS size, w AS phrase FROM x UNION ALL SELECT lang, 2, w || ' ' || w2 FROM x WHERE w2 IS NOT NULL UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3 FROM x WHERE w3 IS NOT NULL),
f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
k AS (SELECT lang, phrase, f AS a, 1 AS k, w[1] AS head, array_to_string(w[2:], ' ') AS rest FROM c UNION ALL SELECT lang, phrase, f, 2, w[1] || ' ' || w[2], w[3] FROM c WHERE size = 3),
s AS (SELECT k.*, x.f AS l, y.f AS r, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score FROM k
  JOIN f x ON x.lang = k.lang AND x.phrase = k.head JOIN f y ON y.lang = k.lang AND y.phrase = k.rest),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, phrase, max(f) AS longer FROM (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, f FROM c WHERE size = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), f FROM c WHERE size = 3) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM m LEFT JOIN o USING (lang, phrase) JOIN n USING (lang) WHERE coalesce(100 * longer < 50 * a, true) QUALIFY rank <= 2000"""

#: What SQL can express. Library tokenizers, trained models, keyed permutations and latent spaces are
#: beyond it; tests/llm holds those operators against brute force.
ORACLE_SQL: dict[str, str] = {"op1_ngram_jaccard_join": JACCARD_SQL, "secret_scan_base": _secret_sql(), "imatch_edited_texts": EDITED_SQL, "op11_ranked_search": RANKED_SQL, "op12_line_dedup": LINES_SQL, "op13_collocations": PHRASES_SQL}
