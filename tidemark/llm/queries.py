"""The registered queries of this package, each a thin use of its operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, language, lines, mails, mixing, negatives, phrases, quality, quotes, substrings, tiling, tokenids, topk, warc
from tidemark.session import scratch_folder
from tidemark.sources.tables import read_table

TOKENIZER = "word_bpe_49k.json"


def remainder(n: int):
    """crc32 of doc_id as text, modulo n."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(n))


def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.taken_words(read_table(spark, sf, "documents"))


def op2_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "warc")
    warc.write(read_table(spark, sf, "pages"), path)
    return warc.read(spark, path, payloads=False).drop("url", "payload")


def op3_tiling(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold half of a test item or more, a row for each item."""
    return tiling.leaks(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op4_token_ids(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "token-ids")
    tokenids.write(read_table(spark, sf, "documents"), path, tokenizer_path())
    return tokenids.read(spark, path, with_ids=False)


def op5_substrings(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.deduplicate(read_table(spark, sf, "documents"), size=20, with_text=False)


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    model = quality.train(docs, read_table(spark, sf, "labels"), "quality", remainder(3) != 1)
    out = quality.scored(docs, model)
    return out.select(
        "doc_id",
        (remainder(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "lang")
    out = language.predict(docs, language.learn(docs, remainder(5) != 0))
    return out.select("doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score")


def op8_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = read_table(spark, sf, "embeddings")
    return topk.search(vectors, F.pmod("vec_id", F.lit(20)) == 0)


def op9_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.similar(read_table(spark, sf, "documents"), size=4, percent=85)


def op10_quotes(spark: SparkSession, sf: str) -> DataFrame:
    """Each turn in the conversation that its quotes put it in, without them."""
    messages, names = mails.quoting(read_table(spark, sf, "conversations"))
    return mails.labelled(quotes.conversations(messages), names)


def op11_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf, "documents"))


def op12_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh row teaches with the next label; every hundredth is an anchor."""
    other = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    vectors = read_table(spark, sf, "embeddings").withColumn("label", other)
    return negatives.mine(vectors, F.pmod("vec_id", F.lit(100)) == 0)


def op13_lines(spark: SparkSession, sf: str) -> DataFrame:
    out = lines.deduplicate(read_table(spark, sf, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_warc": op2_warc,
    "op3_tiling": op3_tiling,
    "op4_token_ids": op4_token_ids,
    "op5_substrings": op5_substrings,
    "op6_quality": op6_quality,
    "op7_language": op7_language,
    "op8_topk": op8_topk,
    "op9_jaccard": op9_jaccard,
    "op10_quotes": op10_quotes,
    "op11_phrases": op11_phrases,
    "op12_negatives": op12_negatives,
    "op13_lines": op13_lines,
}

ORACLE_SQL: dict[str, str] = {
    "op2_warc": """
        WITH given AS (
          SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        hashed AS (
          SELECT page_id, octet_length(payload) AS n, sha1(payload) AS hex FROM given),
        coded AS (
          SELECT *, list_aggregate(list_transform(range(32), lambda i:
                      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                             1 + (((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::INTEGER)
                                   >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)),
                    'string_agg', '') AS digest,
                 max(page_id) OVER (PARTITION BY hex) AS best,
                 count(*) OVER (PARTITION BY hex) AS copies
          FROM hashed)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN page_id = best OR best IS NULL THEN 'response' ELSE 'revisit' END
                 AS record_type,
               CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to
        FROM coded""",
    "op8_topk": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
          FROM embeddings),
        scored AS (
          SELECT q.vec_id AS query_id, c.vec_id,
                 CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 20 = 0)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                     AS rank FROM scored)
        WHERE rank <= 20""",
    "op10_quotes": """
        SELECT conv_id, turn, first_value(conv_id) OVER w AS root_conv_id,
               lag(turn) OVER w AS parent_turn,
               row_number() OVER w - 1 AS depth, row_number() OVER w - 1 AS position,
               trim(text, E' \t\n\r') AS text
        FROM conversations
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
    "op11_phrases": r"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words
          FROM documents),
        grams AS (
          SELECT lang, k, list_transform(range(1, len(words) - k + 2),
                                         lambda i: array_to_string(words[i:i + k - 1], ' ')) AS all_of_k
          FROM pieces, (SELECT unnest(range(1, 6)) AS k) WHERE len(words) >= k),
        counts AS (
          SELECT lang, k, phrase, count(*) AS f
          FROM (SELECT lang, k, unnest(all_of_k) AS phrase FROM grams) GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
        candidates AS (
          SELECT lang, k, phrase, string_split(phrase, ' ') AS words, f AS a
          FROM counts WHERE k >= 2 AND f >= 100),
        cuts AS (
          SELECT c.*, cut, x.f AS l, y.f AS r, n,
                 CAST(1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
          FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
          JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(words[1:cut], ' ')
          JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(words[cut + 1:], ' ')
          JOIN totals t ON t.lang = c.lang),
        worst AS (
          SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        inner_parts AS (
          SELECT DISTINCT c.lang, array_to_string(words[i:i + size - 1], ' ') AS phrase, a
          FROM candidates c, (SELECT unnest(range(2, 5)) AS size), (SELECT unnest(range(1, 5)) AS i)
          WHERE size < k AND i + size - 1 <= k),
        kept AS (
          SELECT * FROM worst w WHERE NOT EXISTS (
            SELECT 1 FROM inner_parts p
            WHERE p.lang = w.lang AND p.phrase = w.phrase AND 100 * p.a >= 100 * w.a))
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, score
        FROM kept
        QUALIFY rank <= 2000""",
    "op12_negatives": """
        WITH v AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
          SELECT a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same,
                 CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
          FROM v a JOIN v c ON a.vec_id <> c.vec_id AND a.vec_id % 100 = 0),
        positives AS (
          SELECT * FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.vec_id AS positive_id,
               CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id,
               p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
             AND 80 * p.score <= 100 * n.score AND n.score <= p.score
        WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
        QUALIFY rank <= 5""",
    "op13_lines": r"""
        WITH lines AS (
          SELECT row, doc_id, unnest(given) AS line, generate_subscripts(given, 1) AS pos
          FROM (SELECT row_number() OVER () AS row, doc_id,
                       string_split(coalesce(text, ''), E'\n') AS given FROM documents)),
        keyed AS (
          SELECT *, translate(trim(line, E' \t\n\x0B\f\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') AS key
          FROM lines),
        judged AS (
          SELECT *, length(key) >= 10
                    AND coalesce(doc_id <> min(doc_id) OVER (PARTITION BY key), false) AS goes
          FROM keyed)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
               sha256(coalesce(string_agg(line, E'\n' ORDER BY pos) FILTER (NOT goes), ''))
                 AS kept_sha256
        FROM judged GROUP BY row, doc_id""",
}
