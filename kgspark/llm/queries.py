"""The registered queries of this subpackage, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.llm import collocations, exact, mtree, neardup, packing, pieces, pii, quality, ranked, secrets, simhash, tokens, warc
from kgspark.llm.common import table

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"
TOKEN_LIMIT = 4096


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text; ``cut_chars`` is how much of the text the limit reaches."""
    counted = tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), [TOKEN_LIMIT])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), F.col("cuts")[0].cast("long").alias("cut_chars"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_classes(table(spark, sf_dir, "documents"))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth id against all rows."""
    return mtree.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest_columns(pii.with_spans(table(spark, sf_dir, "documents")))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives and read back."""
    folder = warc.scratch_archives(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    records = warc.read_archives(spark, folder, with_payload=False).filter("reason is null")
    return records.select(warc.page_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_id("refers_to").alias("refers_to"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded."""
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest_columns(secrets.with_spans(table(spark, sf_dir, "documents")))


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all documents for every benchmark item."""
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_classes(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_near_duplicates, op3_top_k, op4_quality, op5_pii, op6_warc, op7_packing, op8_exact_dedup, op9_pieces, op10_secrets,
        op11_ranked, op12_collocations, op13_simhash,
    )
}

SQL: dict[str, str] = {
    "op3_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
        d AS (SELECT page_id, strlen(html) AS payload_bytes, h, min(page_id) OVER (PARTITION BY h) AS first,
          list_transform(generate_series(0, 39), lambda i: instr('0123456789abcdef', substr(h, CAST(i + 1 AS BIGINT), 1)) - 1) AS n FROM p),
        b AS (SELECT *, list_reduce(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
          ((n[1 + (5 * i) // 4] * 16 + coalesce(n[2 + (5 * i) // 4], 0)) // CAST(pow(2, 3 - (5 * i) % 4) AS BIGINT)) % 32 AS BIGINT), 1)), lambda x, y: x || y) AS digest FROM d)
        SELECT page_id, payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id <> first THEN first END AS refers_to FROM b""",
    "op8_exact_dedup": r"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
        w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM w""",
    "op11_ranked": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
        n AS (SELECT doc_id, len(t) AS n FROM d WHERE len(t) > 0), c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY ALL),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, c),
        q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
          FROM q JOIN w USING (term) JOIN tf USING (term) JOIN n USING (doc_id), c GROUP BY ALL),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50""",
    "op12_collocations": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        q AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        t AS (SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM q),
        o AS (SELECT lang, w1, lead(w1) OVER x AS w2, lead(w1, 2) OVER x AS w3 FROM t WINDOW x AS (PARTITION BY id ORDER BY i)),
        g AS (SELECT lang, 1 AS k, w1 AS phrase, count(*) AS a FROM o GROUP BY ALL UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM o WHERE w2 IS NOT NULL GROUP BY ALL
          UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM o WHERE w3 IS NOT NULL GROUP BY ALL),
        n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND a >= 10),
        h AS (SELECT c.*, j, array_to_string(w[1 : j], ' ') AS p1, array_to_string(w[j + 1 :], ' ') AS p2 FROM c, (VALUES (1), (2)) t(j) WHERE j < k),
        s AS (SELECT h.lang, h.phrase, h.a, j, x.a AS l, y.a AS r, CAST((CAST(1000000 AS HUGEINT) * h.a * h.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
          FROM h JOIN g x ON x.lang = h.lang AND x.phrase = p1 JOIN g y ON y.lang = h.lang AND y.phrase = p2),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        u AS (SELECT lang, phrase, max(longer) AS longer FROM (SELECT lang, array_to_string(w[1 : 2], ' ') AS phrase, a AS longer FROM c WHERE k = 3 UNION ALL SELECT lang, array_to_string(w[2 : 3], ' '), a FROM c WHERE k = 3) GROUP BY ALL),
        r AS (SELECT b.*, n, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank FROM b JOIN n ON n.lang = b.lang LEFT JOIN u ON u.lang = b.lang AND u.phrase = b.phrase WHERE coalesce(100 * longer < 50 * a, true))
        SELECT lang, rank, phrase, a, l, r, n, score FROM r WHERE rank <= 2000""",
}
