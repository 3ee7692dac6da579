"""One query per operator, over its whole table, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollgraph.llm import (
    chat_trees,
    cover_topk,
    decontaminate,
    hard_negatives,
    importance,
    jaccard_join,
    language_id,
    line_dedup,
    main_text,
    mixing,
    quality,
    secrets,
    substring_dedup,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(run):
        QUERIES[run.__name__] = run
        if sql:
            CHECKS[run.__name__] = sql
        return run

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a repeated window of 20 words covers go; the first place stays."""
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


@query()
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingles agree to 0.8 or more."""
    linked = jaccard_join.link_components(table(spark, sf_dir, "documents"))
    return linked.select("doc_id", "n_shingles", "component_id")


LINE_SQL = r"""
WITH split AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split
), repeated AS (
    SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.*, r.key IS NOT NULL AND k.doc_id < r.holder AS dropped
    FROM keyed k LEFT JOIN repeated r ON r.key = k.key
)
"""


@query(
    LINE_SQL
    + """SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY doc_id"""
)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 20 code points or more in 3 documents stay in the largest doc_id."""
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query()
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that leaks a benchmark item, with the item and the overlaps."""
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("body")


@query()
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of each document, sources weighing 5, 2, 1, repeating."""
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    field = language_id.learn_languages(docs.where(language_id.fold("doc_id", 5) != 0))
    held = F.coalesce(language_id.fold("doc_id", 5) == 0, F.lit(False))
    found = language_id.predict_languages(docs.withColumn("held_out", held), field, ("doc_id", "held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(language_id.fold("doc_id", 3) != 1)
    model, prior = quality.learn_quality(docs, labels)
    return quality.score_quality(docs, model, prior, language_id.fold("doc_id", 3) == 1)


@query()
def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text.extract_pages(table(spark, sf_dir, "pages"))


CHAT_SQL = """
WITH turns AS (
    SELECT conv_id, turn, role, text FROM conversations UNION ALL
    SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
), plain AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('<|im_start|>') + length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;')) + 1
        + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM plain GROUP BY conv_id
"""


@query(CHAT_SQL)
def op3_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and what is read back from it."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"),
    )
    made = chat_trees.format_trees(chat_trees.linear_nodes(rows.unionByName(extra)))
    read = made.select(
        F.col("tree").alias("conv_id"), "formatted",
        chat_trees.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(chat_trees.read_loss(F.col("formatted"), F.col("spans")), "").alias("loss"),
    )
    plain = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), sha(plain).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), sha(F.col("loss")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


TOP_SQL = """
WITH ints AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM ints q JOIN ints d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query(TOP_SQL)
def op8_cover_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products for every hundredth vector, over all vectors."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return cover_topk.search(vectors, F.col("vec_id") % 100 == 0)


RESAMPLE_SQL = r"""
WITH RECURSIVE steps AS (
    SELECT i AS byte, i::BIGINT AS c, 0 AS k FROM range(256) t(i) UNION ALL
    SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc_table AS (
    SELECT list(c ORDER BY byte) AS t FROM steps WHERE k = 8
), raw AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), wanted AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), features AS (
    SELECT doc_id, unnest(words) AS word FROM raw
), words AS (
    SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM features UNION SELECT word FROM wanted)
), hashed AS (
    SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(range(1, length(h) + 1, 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
    FROM words, crc_table
), s AS (
    SELECT bucket, count(*) AS n FROM features JOIN hashed USING (word) GROUP BY bucket
), t AS (
    SELECT bucket, count(*) AS n FROM wanted JOIN hashed USING (word) GROUP BY bucket
), gains AS (
    SELECT b.bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM features) + 10000)
        / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM wanted) + 10000)))) AS BIGINT) AS gain
    FROM range(10000) b(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
), weighed AS (
    SELECT doc_id, sum(gain) AS weight FROM features JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
        CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(
            (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM raw LEFT JOIN weighed USING (doc_id)
), placed AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
    CASE WHEN place <= (SELECT count(*) * 10 // 100 FROM placed) THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""


@query(RESAMPLE_SQL)
def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn towards the benchmark's words, by weight and seeded noise."""
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query()
def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document by three patterns and by characters a token."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


NEGATIVE_SQL = """
WITH ints AS (
    SELECT row_number() OVER () AS tag, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same,
        CAST(list_sum(list_transform(list_zip(a.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM ints a JOIN ints d ON a.vec_id <> d.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
        AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""


@query(NEGATIVE_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score 80 to 100 % of each positive of every anchor."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, turned)
