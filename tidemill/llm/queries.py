"""The registered queries of this subpackage, each over its whole table, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.llm import (
    contamination, filter_audit, importance, jaccard, mixing, neighbours, quality, scoring, substrings, token_counts, toxicity, url_filters, warc,
)
from tidemill.llm.common import fold, table


PREDICTED = 0.3  # scores from here on are label 1


def _judged(rows: DataFrame, held_out) -> DataFrame:
    return rows.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= PREDICTED).cast("int").alias("predicted")
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 4) == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), keep=~held_out)
    return _judged(toxicity.with_score(docs.select("doc_id", "text"), model), held_out)


def op2_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_through_warc(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc.doc_id", "n_words", "n_removed", "kept_sha256")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_copies(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 5) == 0
    network = quality.fit(docs, table(spark, sf_dir, "labels"), keep=~held_out)
    return _judged(quality.with_score(docs.select("doc_id", "text"), network), held_out)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents").select("doc_id", "text"), fold(F.col("doc_id"), 7) == 2
    return scoring.score(docs, scoring.fit(docs, keep=~held_out), held_out)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.judge(pages, url_filters.fit(pages))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_warc_members, op3_substrings, op4_neighbours, op5_mixing, op6_jaccard, op7_quality,
        op8_decontamination, op9_suffix_tree_scores, op10_token_counts, op11_resampling, op12_filter_audit,
        op13_url_filters,
    )
}

ORACLES: dict[str, str] = {
    "op3_substrings": r"""
        WITH d AS (
            SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
        ), s AS (
            SELECT doc_id, s, array_to_string(w[s : s + 19], ' ') AS win
            FROM (SELECT doc_id, w, unnest(range(1, greatest(0, len(w) - 19) + 1)) AS s FROM d)
        ), r AS (
            SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS place FROM s) WHERE place > 1
        ), g AS (
            SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM r
        ), k AS (
            SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d
        ), n AS (
            SELECT k.doc_id, count(g.p) AS n_removed, string_agg(CASE WHEN g.p IS NULL THEN k.w[k.p] END, ' ' ORDER BY k.p) AS kept
            FROM k LEFT JOIN g ON g.doc_id = k.doc_id AND g.p = k.p GROUP BY k.doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN n USING (doc_id)
    """,
    "op6_jaccard": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), p AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
        ), l AS (
            SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)
        ), e AS (
            SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l
        ), reach AS (
            SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a
        ), least_of AS (
            SELECT a, min(b) AS b FROM reach GROUP BY a
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(least_of.b, d.doc_id)) AS component_id
        FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_of ON least_of.a = d.doc_id
    """,
    "op8_decontamination": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id,
                   coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
            FROM documents
        ), i AS (
            SELECT CAST(item_id AS VARCHAR) AS item_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ), iw AS (
            SELECT DISTINCT item_id, array_to_string(w[s : s + least(10, len(w)) - 1], ' ') AS win, least(10, len(w)) AS n
            FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM i WHERE len(w) > 0)
        ), dw AS (
            SELECT rid, s, n, array_to_string(w[s : s + n - 1], ' ') AS win
            FROM (SELECT rid, w, n, unnest(range(1, greatest(0, len(w) - n + 1) + 1)) AS s FROM d, (SELECT DISTINCT n FROM iw))
        ), o AS (
            SELECT rid, s, dw.n, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n
        ), h AS (
            SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT rid, s, n FROM o)) GROUP BY rid
        ), l AS (
            SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT rid, item_id FROM o) GROUP BY rid
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h USING (rid) LEFT JOIN l USING (rid)
    """,
    "op5_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
                   md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
            FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no,
                   CAST(sum(sum(size)) OVER () AS BIGINT) * 1.5::DOUBLE AS wanted
            FROM d GROUP BY source
        ), w AS (
            SELECT *, ([5, 2, 1])[no % 3 + 1] AS weight, source_size * 2 AS cap FROM s
        ), l AS (
            SELECT *, (wanted - coalesce(sum(cap) OVER (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                      / sum(weight) OVER (ORDER BY cap / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
            FROM w
        ), t AS (
            SELECT *, least(cap::DOUBLE, weight * max(level) OVER ()) AS target, CAST(round(wanted / 16) AS BIGINT) AS blocks,
                   greatest(1, CAST(ceil(source_size / 1000000.0) AS BIGINT)) AS n_shards
            FROM l
        ), q AS (
            SELECT no, row_number() OVER (ORDER BY target / (2 * j + 1) DESC, no) AS place, blocks
            FROM (SELECT *, unnest(range(CAST(target / 16 + 2 + target / 16 * 0.01 AS BIGINT))) AS j FROM t WHERE target > 0)
        ), won AS (
            SELECT no, count(*) AS seats FROM q WHERE place <= blocks GROUP BY no
        ), e AS (
            SELECT d.*, t.no, t.source_size, t.target, coalesce(won.seats, 0) AS source_seats,
                   ('0x' || substr(draw, 1, 8))::BIGINT % t.n_shards AS shard
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN won ON won.no = t.no
        ), h AS (
            SELECT no, shard, sum(size)::BIGINT AS shard_size, max(source_seats) AS source_seats FROM e GROUP BY no, shard
        ), hq AS (
            SELECT no, shard, row_number() OVER (PARTITION BY no ORDER BY shard_size / (2 * j + 1) DESC, shard) AS place, source_seats
            FROM (SELECT *, unnest(range(CAST(shard_size * 2 / 16 + 3 AS BIGINT))) AS j FROM h WHERE shard_size > 0)
        ), hw AS (
            SELECT no, shard, count(*) AS seats FROM hq WHERE place <= source_seats GROUP BY no, shard
        ), p AS (
            SELECT e.*, h.shard_size, least(coalesce(hw.seats, 0) * 16, h.shard_size * 2) AS quota,
                   coalesce(sum(e.size) OVER (PARTITION BY e.no, e.shard ORDER BY draw, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
            FROM e JOIN h ON h.no = e.no AND h.shard = e.shard LEFT JOIN hw ON hw.no = e.no AND hw.shard = e.shard
        )
        SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
               CAST(CASE WHEN shard_size > 0 THEN quota // shard_size ELSE 0 END * size
                    + greatest(0, least(size, quota - CASE WHEN shard_size > 0 THEN quota // shard_size ELSE 0 END * shard_size - before)) AS BIGINT) AS taken
        FROM p
    """,
    "op2_warc_members": r"""
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), g AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
        )
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM g
    """,
    "op11_resampling": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id,
                   coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
            FROM documents
        ), x AS (
            SELECT rid, unnest(w) AS word FROM d
        ), y AS (
            SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
            FROM benchmark
        ), crc AS (
            SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS step
        ), h AS (
            SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM x UNION SELECT word FROM y)
        ), b AS (
            SELECT word, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS bytes FROM h
        ), k AS (
            SELECT word, xor(list_reduce(bytes, lambda c, b: xor(c // 256, step[xor(c, b) % 256 + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
            FROM b, crc
        ), s AS (
            SELECT bucket, count(*) AS n FROM x JOIN k USING (word) GROUP BY bucket
        ), t AS (
            SELECT bucket, count(*) AS n FROM y JOIN k USING (word) GROUP BY bucket
        ), g AS (
            SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM x) + 10000)::DOUBLE
                                                / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM y) + 10000)::DOUBLE))) AS BIGINT) AS gain
            FROM s LEFT JOIN t USING (bucket)
        ), weights AS (
            SELECT rid, CAST(sum(gain) AS BIGINT) AS weight FROM x JOIN k USING (word) JOIN g USING (bucket) GROUP BY rid
        ), scores AS (
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS able,
                   coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296))) AS BIGINT) AS score
            FROM d LEFT JOIN weights USING (rid)
        ), places AS (
            SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place FROM scores
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= (SELECT count(*) FROM scores WHERE able) * 10 // 100 THEN place END AS rank
        FROM places
    """,
    "op12_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
            FROM documents
        ), m AS (
            SELECT doc_id, part,
                   CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 16 ELSE 0 END AS mask
            FROM d
        ), l AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
        ), c AS (
            SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask
        ), f AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
        ), o AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
            FROM f a JOIN f b ON b.f <> a.f JOIN f c ON c.f NOT IN (a.f, b.f) JOIN f d ON d.f NOT IN (a.f, b.f, c.f) JOIN f e ON e.f NOT IN (a.f, b.f, c.f, d.f)
        ), s AS (
            SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS bit,
                   coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))), 0)::INTEGER AS before
            FROM o, (SELECT unnest(range(1, 6)) AS step)
        ), e AS (
            SELECT part, filter_order, CAST(step AS INTEGER) AS step, mask, n, good, toxic, bit, mask & bit <> 0 AS fails, mask & before <> 0 AS earlier FROM c, s
        ), r AS (
            SELECT part, filter_order, step, bit,
                   CAST(sum(CASE WHEN NOT fails AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN fails AND NOT earlier THEN n ELSE 0 END) AS BIGINT) AS removed,
                   CAST(sum(CASE WHEN fails AND earlier THEN n ELSE 0 END) AS BIGINT) AS redundant, CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
                   CAST(sum(CASE WHEN fails AND NOT earlier THEN good ELSE 0 END) AS BIGINT) AS good_lost, CAST(sum(CASE WHEN fails AND NOT earlier THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
            FROM e GROUP BY part, filter_order, step, bit
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM r
    """,
}
