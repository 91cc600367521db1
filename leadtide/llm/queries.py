"""The queries of the corpus operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from leadtide.llm import (
    chunks, divergence, fingerprints, langid, mixing, packing, phrases, pii, quality, simhash, suffixes, toxicity, vectorfit,
)
from leadtide.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Where only the driver was told of this folder, tell the workers of a session too.
        folder = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
        known = spark.sparkContext.environment.get("PYTHONPATH", "")
        if folder not in known.split(os.pathsep):
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [folder, known]))
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), corpus_pipeline.tokenizer_path(), tokens=False)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle_words=3, most_bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(documents(spark, sf_dir))).drop("key")


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality.quality_rules(documents(spark, sf_dir).select("doc_id", "text"), labels)
    return judged.drop("text")


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select(
        "doc_id", "source", "copy", "mix_key", F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_md5")
    )


ORACLE["op6_mixing"] = """
WITH RECURSIVE sizes AS (
  SELECT source, count(*) AS n FROM documents GROUP BY source
), rates AS (
  SELECT source, (1.0::DOUBLE * (SELECT sum(n) FROM sizes)) / ((SELECT count(*)::DOUBLE FROM sizes) * n) AS rate
  FROM sizes
), steps AS (
  SELECT source, rate, 0 AS k, -rate AS log_p, exp(-rate) AS below FROM rates
  UNION ALL
  SELECT source, rate, k + 1, log_p + ln(rate / (k + 1)), below + exp(log_p + ln(rate / (k + 1)))
  FROM steps
  WHERE k + 1 < ceil(rate + 9 * sqrt(rate) + 30)
), drawn AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS text_md5,
         ('0x' || substr(md5(concat_ws('|', '42', doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496::DOUBLE AS u
  FROM documents
), times AS (
  SELECT d.doc_id, d.source, d.text_md5,
         (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM d.source AND d.u >= s.below) AS n
  FROM drawn d
), copies AS (
  SELECT doc_id, source, text_md5, unnest(range(1, n + 1))::INTEGER AS copy FROM times
)
SELECT doc_id, source, copy, text_md5,
       ('0x' || substr(md5(concat_ws('|', '43', doc_id::VARCHAR, text_md5, copy::VARCHAR)), 1, 13))::BIGINT::DOUBLE
         / 4503599627370496::DOUBLE AS mix_key
FROM copies
"""


@query
def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(documents(spark, sf_dir)).drop("words")


@query
def op8_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.deduplicate_chunks(documents(spark, sf_dir)).drop("kept")


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(documents(spark, sf_dir), labels).drop("segments")


@query
def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, sf_dir), length=100).drop("kept")


#: Bytes are pairs of hexadecimal digits here, since SQL cuts texts by characters.
ORACLE["op10_suffixes"] = """
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), starts AS (
  SELECT doc_id, unnest(list_transform(range(0, length(h) // 2 - 99),
    lambda s: {'s': s, 'string': md5_number(substr(h, 2 * s + 1, 200))})) AS x
  FROM bytes
), strings AS (
  SELECT doc_id, x.s AS s, x.string AS string FROM starts
), firsts AS (
  SELECT string, min({'doc_id': doc_id, 's': s}) AS f FROM strings GROUP BY string HAVING count(*) > 1
), repeats AS (
  SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before
  FROM strings JOIN firsts USING (string) WHERE doc_id <> f.doc_id OR s <> f.s
), runs AS (
  SELECT doc_id, s, count(*) FILTER (WHERE before IS NULL OR s > before + 100) OVER (
    PARTITION BY doc_id ORDER BY s) AS run
  FROM repeats
), spans AS (
  SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM runs GROUP BY doc_id, run
), parts AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS low, a AS high FROM spans
  UNION ALL
  SELECT d.doc_id, coalesce(max(b), 0), any_value(length(h) // 2) FROM bytes d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * low + 1, 2 * (high - low)), '' ORDER BY low) AS k
  FROM parts JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(h) // 2 AS n_bytes, (length(h) - length(k)) // 2 AS n_removed,
       (SELECT count(*) FROM spans s WHERE s.doc_id = bytes.doc_id) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM bytes JOIN kept USING (doc_id)
"""


@query
def op11_vectorfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return vectorfit.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), tokens=False)


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


ORACLE["op12_phrases"] = """
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), cut AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts
), pieces AS (
  SELECT lang, row_number() OVER () AS piece_id, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM cut
), words AS (
  SELECT lang, piece_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM pieces
), sizes AS (
  SELECT lang, count(*) AS n FROM words GROUP BY lang
), next AS (
  SELECT lang, w, lead(w) OVER piece AS x, lead(w, 2) OVER piece AS y FROM words WINDOW piece AS (PARTITION BY piece_id ORDER BY i)
), grams AS (
  SELECT lang, 1 AS size, w AS phrase FROM next
  UNION ALL
  SELECT lang, 2, w || ' ' || x FROM next WHERE x IS NOT NULL
  UNION ALL
  SELECT lang, 3, w || ' ' || x || ' ' || y FROM next WHERE y IS NOT NULL
), counts AS (
  SELECT lang, size, phrase, count(*) AS n, {'lang': lang, 'part': phrase} AS key FROM grams GROUP BY lang, size, phrase
), candidates AS (
  SELECT lang, size, phrase, n, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND n >= 10
), cuts AS (
  SELECT lang, phrase, size, n AS a, k, {'lang': lang, 'part': array_to_string(w[1:k], ' ')} AS head,
         {'lang': lang, 'part': array_to_string(w[k + 1:], ' ')} AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), scored AS (
  SELECT c.lang, c.phrase, c.size, c.a, c.k, h.n AS l, t.n AS r,
         (1000000::HUGEINT * c.a * c.a // (h.n::HUGEINT * t.n))::BIGINT AS score
  FROM cuts c JOIN counts h ON h.key = c.head JOIN counts t ON t.key = c.tail
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), holders AS (
  SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, n FROM candidates WHERE size = 3
), most AS (
  SELECT lang, phrase, max(n) AS holder FROM holders GROUP BY ALL
), free AS (
  SELECT s.* FROM lowest s LEFT JOIN most m USING (lang, phrase)
  WHERE s.size = 3 OR m.holder IS NULL OR 100 * m.holder < 50 * s.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM free JOIN sizes USING (lang)
QUALIFY rank <= 2000
"""


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(documents(spark, sf_dir))


ORACLE["op13_divergence"] = """
WITH texts AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), groups AS (
  SELECT DISTINCT lang, source FROM texts
), terms AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM texts
), kept AS (
  SELECT lang, term FROM terms GROUP BY ALL HAVING count(DISTINCT d) >= 30
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL
), dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
), shares AS (
  SELECT lang, source, term, n, 1 + 1000000000 * (n + 5)
           // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p
  FROM dense
), lang_counts AS (
  SELECT lang, term, sum(n) AS n FROM dense GROUP BY ALL
), lang_shares AS (
  SELECT lang, term, 1 + 1000000000 * (n + 5)
           // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q
  FROM lang_counts
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM found
QUALIFY part = 'pair' OR rank <= 50
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
