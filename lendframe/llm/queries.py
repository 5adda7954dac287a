"""Registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lendframe.staging import staging_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # workers on this machine import the package from where the driver has it, whatever folder they start in
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendframe.llm import toxicity

    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendframe.llm import quality

    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendframe.llm import pieces

    return pieces.encode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendframe.llm import token_counts

    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), limit=512)


def op1_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendframe.llm import chaining

    return chaining.passages(table(spark, sf_dir, "documents"), least_words=40, least_identity=0.8)


def op2_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendframe.llm import archive

    return archive.report(table(spark, sf_dir, "pages"), staging_path(spark, "archive"), least_bytes=0)


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendframe.llm import embedding_dedup

    return embedding_dedup.report(table(spark, sf_dir, "embeddings"), least=0.9, recall=0.95)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendframe.llm import suffix_dedup

    return suffix_dedup.report(table(spark, sf_dir, "documents"), length=100)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendframe.llm import decontaminate

    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendframe.llm import jaccard_join

    return jaccard_join.report(table(spark, sf_dir, "documents"), size=5, percent=75)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendframe.llm import packing

    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), capacity=1024, end_id=2)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendframe.llm import phrases

    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, most_words=4, cover_percent=80, most=2000)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lendframe.llm import alignment

    return alignment.alignments(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


QUERIES = {
    "op1_chaining": op1_chaining,
    "op2_warc_archive": op2_warc_archive,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_token_counts": op9_token_counts,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_packing": op11_packing,
    "op12_phrases": op12_phrases,
    "op13_alignment": op13_alignment,
}
_WORDS5 = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

SQL: dict[str, str] = {
    "op2_warc_archive": """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS last FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id != last THEN last END AS refers_to
FROM h""",
    "op3_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v),
ok AS (SELECT * FROM n WHERE norm > 0 AND isfinite(norm)),
edges AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.vec_id != b.vec_id AND len(a.e) = len(b.e)
          WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
reach AS (SELECT vec_id AS node, vec_id AS seen FROM v UNION SELECT r.node, e.y FROM reach r JOIN edges e ON e.x = r.seen)
SELECT v.vec_id, (SELECT count(*) FROM edges WHERE x = v.vec_id) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN (SELECT node AS vec_id, min(seen) AS component_id FROM reach GROUP BY node) c USING (vec_id)""",
    "op4_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS x FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 99)) AS p FROM d WHERE len(h) >= 200)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY x ORDER BY doc_id, p) AS n FROM s) WHERE n > 1),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM (
    SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM (
        SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM later))
    GROUP BY doc_id, span),
cuts AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS upto FROM spans),
kept AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
                string_agg(substr(h, 2 * upto + 1, 2 * (a - upto)), '' ORDER BY a) AS head
         FROM cuts JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op5_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS5} AS w FROM documents),
b AS (SELECT item_id, {_WORDS5} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
       FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT r, i, dw.size, item_id FROM dw JOIN bw USING (size, win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM hit) GROUP BY r),
bj AS (SELECT DISTINCT item_id, j, least(len(w), 10) AS size, array_to_string(w[j:j + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS j FROM b WHERE len(w) > 0)),
runs AS (SELECT r, max(n) AS longest FROM (
    SELECT r, max(i + size) - min(i) AS n
    FROM (SELECT r, item_id, i, size, i - j AS diagonal, i - row_number() OVER (PARTITION BY r, item_id, i - j ORDER BY i) AS island
          FROM dw JOIN bj USING (size, win))
    GROUP BY r, item_id, diagonal, island) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated,
       CAST(coalesce(longest, 0) AS BIGINT) AS longest_match
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r) LEFT JOIN runs USING (r)""",
    "op10_jaccard_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY x, y),
links AS (SELECT x, y FROM both_ JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT r.node, e.y FROM reach r JOIN edges e ON e.x = r.seen)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY node) USING (doc_id)""",
    "op12_phrases": r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS a
      FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) s(k) WHERE len(w) >= k))
      GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cuts AS (SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:k], ' ') AS y
         FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
best AS (SELECT lang, phrase, a, l, r, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS first FROM (
        SELECT cuts.*, p.a AS l, q.a AS r, CAST((CAST(2000000 AS HUGEINT) * cuts.a) // (p.a + q.a) AS BIGINT) AS score
        FROM cuts JOIN f p ON p.lang = cuts.lang AND p.phrase = x JOIN f q ON q.lang = cuts.lang AND q.phrase = y)) WHERE first = 1),
longer AS (SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer
           FROM (SELECT *, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS s FROM c WHERE k >= 3)) GROUP BY ALL),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
           FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
}
