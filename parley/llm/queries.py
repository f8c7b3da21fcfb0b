"""One registered query for each operator of this package, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import alignment, bpe, decontaminate, langid, lblm, pii, quality, resample, shards, simhash, sites, syncmers, warc
from parley.plans.inputs import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """A vocabulary file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(key: str, of: int) -> Column:
    """crc32 of the key as text, modulo a number."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % of


def quality_model(spark: SparkSession, sf: str) -> quality.Model:
    """The classifier, fitted on labelled rows outside the held-out fold."""
    labels = table(spark, sf, "labels").where(remainder("doc_id", 5) != 0)
    return quality.learn(table(spark, sf, "documents"), labels)


@query
def op1_quality(spark, sf):
    scored = quality.rate(table(spark, sf, "documents"), quality_model(spark, sf))
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op2_simhash(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


@query
def op3_shards(spark, sf):
    placed = shards.shard(table(spark, sf, "documents"), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op4_bpe(spark, sf):
    return bpe.encode_texts(table(spark, sf, "documents"), vocabulary(), keep=False)


@query
def op5_pii(spark, sf):
    return pii.find_pii(table(spark, sf, "documents")).drop("scores", "redacted")


@query
def op6_sites(spark, sf):
    return sites.extract(table(spark, sf, "pages"))


@query
def op7_langid(spark, sf):
    docs = table(spark, sf, "documents")
    model = langid.learn(docs.where(remainder("doc_id", 3) != 1))
    found = langid.identify(docs, model)
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op8_warc(spark, sf):
    read = warc.archived(table(spark, sf, "pages")).where("kind = 'record'")
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op9_syncmers(spark, sf):
    return syncmers.compare_with_next(table(spark, sf, "documents"))


@query
def op10_decontaminate(spark, sf):
    found = decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "cosine", "common", "answer")


@query
def op11_alignment(spark, sf):
    paths = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    return alignment.align_texts(table(spark, sf, "documents"), *paths)


@query
def op12_resample(spark, sf):
    drawn = resample.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_lblm(spark, sf):
    held = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    scored = lblm.score_texts(table(spark, sf, "documents"), remainder("doc_id", 7) != 2)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


# The archives as SQL: base32 is made of five hexadecimal digits at a time, four characters each.
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_FOURS = " || ".join(
    f"substr('{_LETTERS}', 1 + ((('0x' || substr(h, {1 + 5 * i}, 5))::BIGINT >> {s}) & 31)::INTEGER, 1)"
    for i in range(8)
    for s in (15, 10, 5, 0)
)

ORACLES: dict[str, str] = {
    "op8_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
        q AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
        SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_FOURS} AS payload_digest,
          CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id <> top THEN top END AS refers_to
        FROM q""",
    "op12_resample": """
        WITH steps AS (
          SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
          FROM (SELECT unnest(range(256)) AS n)),
        texts AS (
          SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
        worded AS (
          SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
        runs AS (
          SELECT side, id, unnest(w) AS f FROM worded UNION ALL
          SELECT side, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM worded WHERE len(w) > 1),
        hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM runs)),
        bytes AS (
          SELECT f, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b FROM hexed),
        hashed AS (
          SELECT f, xor(list_reduce([4294967295] || b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS k
          FROM bytes, steps),
        fallen AS (SELECT side, id, k FROM runs JOIN hashed USING (f)),
        counts AS (SELECT k, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM fallen GROUP BY k),
        totals AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM counts),
        gains AS (
          SELECT k, floor(1000 * ln((t + 1.0::DOUBLE) * (s_all + 10000) / ((s + 1.0::DOUBLE) * (t_all + 10000)))) AS g
          FROM counts, totals),
        means AS (
          SELECT id, count(*) AS n, floor(sum(g) / count(*))::BIGINT AS weight FROM fallen JOIN gains USING (k)
          WHERE side = 0 GROUP BY id),
        scored AS (
          SELECT d.id, len(d.w) AS words, coalesce(m.n, 0)::BIGINT AS n, coalesce(m.weight, 0)::BIGINT AS weight,
            coalesce(m.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.id), 1, 8))::BIGINT + 0.5::DOUBLE)
              / 4294967296)))::BIGINT AS score
          FROM worded d LEFT JOIN means m USING (id) WHERE d.side = 0),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, id) AS place,
            count(*) FILTER (words >= 20) OVER () * 25 // 100 AS wanted FROM scored)
        SELECT id AS doc_id, n AS n_features, weight, score::BIGINT AS score,
          CASE WHEN words >= 20 AND place <= wanted THEN place::BIGINT END AS rank
        FROM placed""",
}
