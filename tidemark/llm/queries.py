"""Named queries of the operators on the test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    covertree,
    decontaminate,
    hardnegatives,
    langid,
    minhash,
    mixing,
    packing,
    phrases,
    preference,
    secretscan,
    superkmers,
    tokenfiles,
    topk,
)
from tidemark.llm.storage import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def tokenizer(name: str) -> str:
    """Path of an installed tokenizer file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_cover_tree_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = covertree.link_vectors(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", "kept")


ORACLES["op1_cover_tree_near_dedup"] = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND list_count(embedding) = len(embedding)
      AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
       AND list_cosine_similarity(a.v, b.v) >= 0.93
), reached AS (
    SELECT vec_id AS id, vec_id AS other FROM embeddings
    UNION
    SELECT r.id, l.y FROM reached r JOIN links l ON l.x = r.other
), counted AS (
    SELECT x, count(*) AS n FROM links GROUP BY x
)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, r.low AS component_id,
       r.low = e.vec_id AS kept
FROM embeddings e
JOIN (SELECT id, min(other) AS low FROM reached GROUP BY id) r ON r.id = e.vec_id
LEFT JOIN counted c ON c.x = e.vec_id
"""


@query
def op2_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation 2 i is taken as chosen, 2 i + 1 as rejected."""
    convs = preference.conversations(table(spark, sf_dir, "conversations"))
    number = F.col("conv_id").cast("long")
    pairs = convs.where(number % 2 == 0).select(
        (number / 2).cast("long").alias("pair_id"),
        number.alias("chosen_id"),
        (number + 1).alias("rejected_id"),
    )
    return preference.preference_records(convs, pairs)


ORACLES["op2_preference_format"] = """
WITH convs AS (
    SELECT conv_id,
           list(struct_pack(role := coalesce(role, 'unknown'), text := coalesce(text, ''))
                ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), pairs AS (
    SELECT a.conv_id // 2 AS pair_id, a.conv_id AS chosen_id, b.conv_id AS rejected_id,
           a.turns AS x, b.turns AS y,
           coalesce(list_min(list_filter(range(1, greatest(len(a.turns), len(b.turns)) + 1),
                lambda i: a.turns[i] IS DISTINCT FROM b.turns[i])) - 1, len(a.turns)) AS n
    FROM convs a JOIN convs b ON a.conv_id % 2 = 0 AND b.conv_id = a.conv_id + 1
), split AS (
    SELECT pair_id, chosen_id, rejected_id, n, x[1:n] AS p, x[n + 1:] AS x, y[n + 1:] AS y
    FROM pairs
), parts AS (
    SELECT *, list_transform(p, lambda t: concat('<|', t.role, '|>', chr(10), t.text, '<|end|>', chr(10))) AS rp,
        list_transform(x, lambda t: concat('<|', t.role, '|>', chr(10), t.text, '<|end|>', chr(10))) AS rx,
        list_transform(y, lambda t: concat('<|', t.role, '|>', chr(10), t.text, '<|end|>', chr(10))) AS ry
    FROM split
), placed AS (
    SELECT *, list_transform(range(1, len(x) + 1), lambda i: struct_pack(role := x[i].role,
            e := coalesce(list_sum(list_transform(rx[1:i], lambda r: length(r))), 0)::BIGINT - 1,
            n := length(x[i].text) + 7)) AS sx,
        list_transform(range(1, len(y) + 1), lambda i: struct_pack(role := y[i].role,
            e := coalesce(list_sum(list_transform(ry[1:i], lambda r: length(r))), 0)::BIGINT - 1,
            n := length(y[i].text) + 7)) AS sy
    FROM parts
)
SELECT pair_id, chosen_id, rejected_id, n::INT AS prompt_turns,
    coalesce(array_to_string(rp, ''), '') AS prompt,
    coalesce(array_to_string(rx, ''), '') AS chosen,
    coalesce(array_to_string(list_transform(list_filter(sx, lambda s: s.role = 'assistant'),
        lambda s: concat(s.e - s.n, ':', s.e)), ','), '') AS chosen_mask,
    coalesce(array_to_string(ry, ''), '') AS rejected,
    coalesce(array_to_string(list_transform(list_filter(sy, lambda s: s.role = 'assistant'),
        lambda s: concat(s.e - s.n, ':', s.e)), ','), '') AS rejected_mask
FROM placed
"""


@query
def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLES["op3_exact_top_k"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
      AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.scan_secrets(table(spark, sf_dir, "documents"), texts=False)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = superkmers.remove_repeats(table(spark, sf_dir, "documents"), texts=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLES["op5_substring_dedup"] = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs)
), firsts AS (
    SELECT s, min(doc_id) AS low FROM windows GROUP BY s
), removed AS (
    SELECT DISTINCT doc_id, p FROM (
        SELECT doc_id, unnest(range(i, i + 50)) AS p
        FROM windows JOIN firsts USING (s) WHERE low < doc_id)
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs)
    ANTI JOIN removed USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(
        table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json")
    )
    return packing.pack(pieces)


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, files = tokenfiles.write_tokens(
        table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=2
    )
    return tokenfiles.read_tokens(folder, files)


@query
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


ORACLES["op8_minhash_near_dedup"] = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * c >= 75 * (p.n + q.n - c)
), reached AS (
    SELECT doc_id AS id, doc_id AS other FROM docs
    UNION
    SELECT r.id, l.y FROM reached r JOIN links l ON l.x = r.other
)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id,
       min(other) = d.doc_id AS kept
FROM docs d JOIN reached r ON r.id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
"""


@query
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs).drop("text")


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 4
    model = langid.fit(docs.where(remainder != 2))
    held = docs.select("doc_id", "text", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"))
    return langid.identify(held, model, keep_text=False)


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\x0A-\x0D]+')) AS piece
          FROM documents)
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), grams AS (
    SELECT lang, m, w[i:i + m - 1] AS p, count(*) AS f
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
          FROM pieces, (SELECT unnest(range(1, 6)) AS m))
    GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
    SELECT g.lang, g.m, g.p, g.f AS a, k, x.f AS l, y.f AS r, n,
           (1000::HUGEINT * g.f * n) // (x.f::HUGEINT * y.f) AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM grams WHERE m > 1) g
    JOIN grams x ON x.lang = g.lang AND x.p = g.p[1:k]
    JOIN grams y ON y.lang = g.lang AND y.p = g.p[k + 1:g.m]
    JOIN totals t ON t.lang = g.lang
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), longer AS (
    SELECT lang, p[i:i + s - 1] AS p, max(f) AS f
    FROM (SELECT *, unnest(range(1, m - s + 2)) AS i
          FROM (SELECT *, unnest(range(2, m)) AS s FROM grams WHERE m > 2))
    GROUP BY ALL
), kept AS (
    SELECT c.*, array_to_string(c.p, ' ') AS phrase
    FROM lowest c LEFT JOIN longer q ON q.lang = c.lang AND q.p = c.p
    WHERE q.f IS NULL OR 100 * q.f < 100 * c.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.hard_negatives(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved
    )


ORACLES["op12_hard_negatives"] = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
      AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           list_inner_product(a.v, b.v)::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INT AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
     AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""


@query
def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


ORACLES["op13_decontaminate"] = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), grams AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + 9], ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
          FROM items WHERE len(w) > 0)
), windows AS (
    SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS s
    FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
          FROM docs, (SELECT DISTINCT m FROM grams))
), found AS (
    SELECT doc_id, i, m, item_id FROM windows JOIN grams USING (m, s)
), hit AS (
    SELECT doc_id, count(DISTINCT p) AS n
    FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit,
       coalesce(named.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
