"""One registered query per operator: opN_<name>(spark, sf_dir), over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import bpe, collocate, common, greedy, htmlcrf, icws, packing, periodic, pii, pivots, quality, secrets, topk, toxicity

Query = Callable[[SparkSession, str], DataFrame]

# Places of the public vocabularies; parameters, never copied.
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece count of every document under the byte-level vocabulary."""
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    return greedy.token_counts(docs, common.vocabulary_bytes(BYTE_VOCABULARY))


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article text of every page."""
    return htmlcrf.extract(common.table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.93 or more between all embeddings of one label, and their components."""
    return pivots.near_duplicates(common.table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the byte-level ranks and decoded again: token count and digests."""
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.digests(docs, bpe.read_ranks(BYTE_RANKS))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labels that are not held out."""
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.train_on(docs, common.table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.classify(docs, model)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the base formats, and what their contexts discover."""
    return pii.find(common.table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2048 tokens by large-item matching and best fit."""
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    with open(BYTE_VOCABULARY, encoding="utf-8") as f:
        return packing.pack(docs, f.read(), added_tokens=True)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labels that are not held out."""
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train_on(docs, common.table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.classify(docs, model)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document: five-word shingles, weighted Jaccard of 0.8 or more."""
    return icws.near_duplicates(common.table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every 50th embedding with all others."""
    rows = common.table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_k(rows, F.col("vec_id") % 50 == 0)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: the base formats, and what decodes to a private key or a signed token."""
    found = secrets.find(common.table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", *[c.alias(k) for k, c in secrets.summary(F.col("found")).items()])


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of repeated words in every document, a tenth of them made periodic from some word on.

    The document's id decides that: with h its crc32, g = h div 10, n words,
    a = g % n and p = 1 + (n - a) div (3 + g % 8), word i >= a becomes word
    a + (i - a) % p where h % 10 = 0.
    """
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    # The generator keeps the words from being cut once for each use of them.
    cut = docs.select("doc_id", F.explode(F.array(periodic.words("text"))).alias("w"),
                      F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(1)).alias("h"))
    whole = F.call_function("div", F.col("h"), F.lit(10))
    n = F.size("w").cast("long")
    placed = cut.select("doc_id", "w", "h", whole.alias("g"), n.alias("n")).withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END"))
    placed = placed.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    changed = F.transform("w", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    docs = placed.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), changed).otherwise(F.col("w")).alias("words"))
    found = periodic.find(docs)
    return found.select("doc_id", *[c.alias(k) for k, c in periodic.summary(F.col("runs"), F.col("collapsed")).items()])


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 best-bound phrases of two and three words, over all documents."""
    docs = common.table(spark, sf_dir, "documents", "lang", "text")
    return collocate.best(collocate.phrases(docs), 2000).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_token_counts, op2_html_main_text, op3_embedding_near_dedup, op4_bpe_round_trip,
    op5_quality_classifier, op6_pii, op7_best_fit_packing,
    op8_toxicity, op9_minhash_near_dedup, op10_exact_top_k, op11_secret_scan, op12_periodic_runs, op13_collocations)}

_USABLE = "list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0"

ORACLE_SQL: dict[str, str] = {
    "op3_embedding_near_dedup": f"""
        WITH RECURSIVE good AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE label IS NOT NULL AND {_USABLE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
            ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
        reach AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
        counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
        SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
        FROM embeddings e JOIN roots USING (vec_id) LEFT JOIN counts USING (vec_id)""",
    "op10_exact_top_k": f"""
        WITH good AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings WHERE {_USABLE}),
        scores AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM good q JOIN good c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
        WHERE rank <= 5""",
    "op13_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        parts AS (
            SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
            FROM cut, range(1, 4) AS sizes(size) WHERE len(w) >= size),
        counts AS (SELECT lang, size, phrase, count(*)::HUGEINT AS f FROM parts GROUP BY ALL),
        totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
        candidates AS (SELECT lang, size, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2 AND f >= 10),
        cuts AS (
            SELECT c.lang, c.size, c.phrase, c.f, k, a.f AS l, b.f AS r, 1000000 * c.f * c.f // (a.f * b.f) AS score
            FROM candidates c, range(1, 3) AS ks(k)
            JOIN counts a ON a.lang = c.lang AND a.phrase = array_to_string(c.w[1:k], ' ') AND a.size = k
            JOIN counts b ON b.lang = c.lang AND b.phrase = array_to_string(c.w[k + 1:], ' ') AND b.size = c.size - k
            WHERE k < c.size),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inside AS (
            SELECT lang, phrase, max(f) AS longer FROM (
                SELECT lang, array_to_string(w[1:2], ' ') AS phrase, f FROM candidates WHERE size = 3
                UNION ALL SELECT lang, array_to_string(w[2:3], ' '), f FROM candidates WHERE size = 3) GROUP BY ALL),
        kept AS (
            SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, phrase)
            WHERE size = 3 OR longer IS NULL OR 100 * longer < 50 * f),
        placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank FROM kept)
        SELECT lang, rank::BIGINT AS rank, phrase, f::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
        FROM placed JOIN totals USING (lang) WHERE rank <= 2000""",
}
