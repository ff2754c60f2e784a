"""Queries over next-token counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.functions import chars
from corpusflow.operators import ngram
from corpusflow.operators.encode import CharEncoder
from corpusflow.operators.sampling import sample_documents
from corpusflow.operators.splits import split_contiguous
from corpusflow.plans.char_corpus import char_encoder, char_ngrams
from corpusflow.plans.corpus_queries import LONG, STARTS, STREAM, VOCAB
from corpusflow.plans.registry import query
from corpusflow.scratch import stored
from corpusflow.sources.tables import read_documents, read_table

BIGRAMS = f"""
    {VOCAB}, {LONG}, {STREAM},
    pairs AS (SELECT id AS ctx, lead(id) OVER (ORDER BY gpos) AS id FROM stream),
    counts AS (SELECT ctx, CAST(id AS INTEGER) AS id, count(*) AS cnt FROM pairs WHERE id IS NOT NULL GROUP BY ALL)"""
UNIFORM = "CAST('0x' || left(md5({0}), 15) AS BIGINT) / 1152921504606846976.0::DOUBLE"


def _corpus(spark: SparkSession, folder: str, n: int = 2) -> tuple[DataFrame, CharEncoder]:
    """N-gram counts of all documents in order, and the encoder; unknown characters get an id of their own."""
    docs = read_documents(spark, folder)
    encoder = char_encoder(docs)
    return char_ngrams(docs.withColumn("split", F.lit("train")), encoder, n), CharEncoder(encoder.vocab, "unk", encoder.size)


def _prompts(spark: SparkSession, folder: str, encoder: CharEncoder) -> DataFrame:
    turns = read_table(spark, folder, "conversations")
    key = F.concat_ws("/", "conv_id", "turn").alias("key")
    return encoder.encode(turns.select(key, "text"))


@query(f"WITH {BIGRAMS} SELECT ctx, id, cnt FROM counts")
def bigram_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _corpus(spark, folder)[0]


@query(f"""
    WITH {VOCAB}, {LONG}, {STREAM},
    triples AS (SELECT lag(id) OVER w * 65536 + id AS ctx, lead(id) OVER w AS id FROM stream WINDOW w AS (ORDER BY gpos))
    SELECT ctx, CAST(id AS INTEGER) AS id, count(*) AS cnt FROM triples WHERE ctx IS NOT NULL AND id IS NOT NULL GROUP BY ALL
""")
def trigram_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _corpus(spark, folder, 3)[0]


@query(f"""
    WITH {VOCAB}, {LONG}, {STREAM},
    grams AS (
        SELECT lag(id, 5) OVER w AS first, concat_ws(' ', lag(id, 5) OVER w, lag(id, 4) OVER w, lag(id, 3) OVER w, lag(id, 2) OVER w, lag(id) OVER w) AS ctx, id
        FROM stream WINDOW w AS (ORDER BY gpos)
    )
    SELECT ctx, CAST(id AS INTEGER) AS id, count(*) AS cnt FROM grams WHERE first IS NOT NULL GROUP BY ALL
""")
def sixgram_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Six characters each, contexts as text."""
    return _corpus(spark, folder, 6)[0].select(F.array_join(F.col("ctx").cast("array<string>"), " ").alias("ctx"), "id", "cnt")


@query(f"""
    WITH {BIGRAMS}, w AS (SELECT *, pow(cnt, 1 / 0.8::DOUBLE) AS weight FROM counts)
    SELECT ctx, id, cnt, round(weight / sum(weight) OVER (PARTITION BY ctx), 6) AS p FROM w
""")
def next_probs(spark: SparkSession, folder: str) -> DataFrame:
    table, _ = _corpus(spark, folder)
    return ngram.next_probs(table, 0.8).withColumn("p", F.round("p", 6))


@query(f"""
    WITH {BIGRAMS}, top AS (SELECT *, rank() OVER (PARTITION BY ctx ORDER BY cnt DESC) AS r FROM counts)
    SELECT ctx, id, cnt, round(cnt / sum(cnt) OVER (PARTITION BY ctx), 6) AS p FROM top WHERE r <= 5
""")
def topk_next(spark: SparkSession, folder: str) -> DataFrame:
    table, _ = _corpus(spark, folder)
    return ngram.top_k_probs(table, 5).withColumn("p", F.round("p", 6))


@query(f"""
    WITH {BIGRAMS},
    cdf AS (
        SELECT ctx, id, sum(cnt) OVER (PARTITION BY ctx ORDER BY id) AS upto, sum(cnt) OVER (PARTITION BY ctx) AS total FROM counts
    ),
    prompts AS (
        SELECT conv_id || '/' || turn AS key, right(text, 1) AS ch FROM conversations
    ),
    drawn AS (
        SELECT key, min(c.id) AS next
        FROM prompts JOIN vocab USING (ch) JOIN cdf AS c ON c.ctx = vocab.id
        WHERE c.upto > total * ({UNIFORM.format("'7:' || key || ':0'")})
        GROUP BY key
    )
    SELECT key, next FROM prompts LEFT JOIN drawn USING (key)
""")
def sample_next(spark: SparkSession, folder: str) -> DataFrame:
    """One draw after the last character of every conversation turn."""
    table, encoder = _corpus(spark, folder)
    context = F.when(F.size("ids") > 0, ngram.pack_context(F.col("ids"), 1))  # an empty turn has none, and draws nothing
    prompts = _prompts(spark, folder, encoder).select("key", context.alias("ctx"))
    return ngram.sample_next(prompts, ngram.next_probs(table), seed=7).select("key", "next")


@query(f"""
    WITH both_splits AS (
        SELECT 'train' AS split, doc_id, text FROM documents UNION ALL SELECT 'val', item_id, text FROM benchmark
    ),
    vocab AS (
        SELECT row_number() OVER (ORDER BY ch) - 1 AS id, ch
        FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM both_splits) WHERE ch <> ''
    ),
    long AS (
        SELECT split, doc_id, unnest(string_split(text, '')) AS ch, unnest(range(0, length(text))) AS pos
        FROM both_splits WHERE length(text) > 0
    ),
    pairs AS (
        SELECT split, id AS ctx, lead(id) OVER (PARTITION BY split ORDER BY doc_id, pos) AS id FROM long JOIN vocab USING (ch)
    ),
    counts AS (SELECT split, ctx, id, count(*) AS cnt FROM pairs WHERE id IS NOT NULL GROUP BY ALL),
    model AS (SELECT ctx, id, cnt AS seen FROM counts WHERE split = 'train'),
    totals AS (SELECT ctx, sum(seen) AS total FROM model GROUP BY ctx)
    SELECT split, CAST(sum(cnt) AS BIGINT) AS targets, round(sum(-cnt * ln((coalesce(seen, 0) + 1.0::DOUBLE) /
           (coalesce(total, 0) + (SELECT count(*) FROM vocab)))) / sum(cnt), 6) AS loss
    FROM counts LEFT JOIN model USING (ctx, id) LEFT JOIN totals USING (ctx) GROUP BY split
""")
def cross_entropy(spark: SparkSession, folder: str) -> DataFrame:
    """Loss of the bigrams of all documents on themselves and on the benchmark items."""
    docs = read_documents(spark, folder).withColumn("split", F.lit("train"))
    items = read_table(spark, folder, "benchmark").select(F.col("item_id").alias("doc_id"), "text", F.lit("val").alias("split"))
    both = docs.unionByName(items)
    encoder = char_encoder(both)
    # read twice, and small beside the corpus
    counts = stored(char_ngrams(both, encoder, by=("split",)), "counts")
    model = counts.where("split = 'train'").drop("split")
    scored = ngram.cross_entropy(counts, model, encoder.size)
    return scored.select("split", "targets", F.round("loss", 6).alias("loss"))


@query(f"""
    WITH RECURSIVE {BIGRAMS},
    top AS (SELECT *, rank() OVER (PARTITION BY ctx ORDER BY cnt DESC) AS r FROM counts),
    cdf AS (
        SELECT ctx, id, sum(cnt) OVER (PARTITION BY ctx ORDER BY id) AS upto, sum(cnt) OVER (PARTITION BY ctx) AS total
        FROM top WHERE r <= 3
    ),
    choices AS (SELECT ctx, list(id ORDER BY id) AS ids, list(upto / total ORDER BY id) AS uptos FROM cdf GROUP BY ctx),
    made AS (
        SELECT conv_id || '/' || turn AS key, 0 AS step, v.id AS last, text AS text
        FROM conversations LEFT JOIN vocab AS v ON v.ch = right(text, 1)
        UNION ALL
        SELECT key, step + 1, c.ids[coalesce(list_position(list_transform(c.uptos,
                   lambda x: x > {UNIFORM.format("'11:' || key || ':' || step")}), true), len(c.ids))] AS last, text || nv.ch
        FROM made JOIN choices AS c ON c.ctx = made.last
        JOIN vocab AS nv ON nv.id = c.ids[coalesce(list_position(list_transform(c.uptos,
                   lambda x: x > {UNIFORM.format("'11:' || key || ':' || step")}), true), len(c.ids))]
        WHERE step < 12
    )
    SELECT key, md5(arg_max(text, step)) AS digest FROM made GROUP BY key
""")
def continue_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation turn continued by 12 characters."""
    table, encoder = _corpus(spark, folder)
    marked = {**encoder.vocab, "�": len(encoder.vocab)}
    prompts = _prompts(spark, folder, encoder)
    longer = ngram.continue_prompts(prompts.select("key", "ids"), table, steps=12, top_k=3, temperature=1.0, seed=11)
    return longer.select("key", F.md5(chars.decode_column("ids", marked)).alias("digest"))


@query(f"""
    WITH RECURSIVE {BIGRAMS},
    top AS (SELECT *, rank() OVER (PARTITION BY ctx ORDER BY cnt DESC) AS r FROM counts),
    cdf AS (
        SELECT ctx, id, sum(cnt) OVER (PARTITION BY ctx ORDER BY id) AS upto, sum(cnt) OVER (PARTITION BY ctx) AS total
        FROM top WHERE r <= 3
    ),
    choices AS (SELECT ctx, list(id ORDER BY id) AS ids, list(upto / total ORDER BY id) AS uptos FROM cdf GROUP BY ctx),
    made AS (
        SELECT conv_id || '/' || turn AS key, sample, 0 AS step, v.id AS last, text AS text
        FROM conversations LEFT JOIN vocab AS v ON v.ch = right(text, 1), range(3) AS s(sample)
        UNION ALL
        SELECT key, sample, step + 1, c.ids[coalesce(list_position(list_transform(c.uptos,
                   lambda x: x > {UNIFORM.format("'5:' || key || ':' || sample || ':' || step")}), true), len(c.ids))] AS last, text || nv.ch
        FROM made JOIN choices AS c ON c.ctx = made.last
        JOIN vocab AS nv ON nv.id = c.ids[coalesce(list_position(list_transform(c.uptos,
                   lambda x: x > {UNIFORM.format("'5:' || key || ':' || sample || ':' || step")}), true), len(c.ids))]
        WHERE step < 8
    )
    SELECT key, CAST(sample AS INTEGER) AS sample, md5(arg_max(text, step)) AS digest FROM made GROUP BY key, sample
""")
def continue_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation turn continued by 8 characters, three times."""
    table, encoder = _corpus(spark, folder)
    marked = {**encoder.vocab, "�": len(encoder.vocab)}
    prompts = _prompts(spark, folder, encoder)
    longer = ngram.continue_prompts(prompts.select("key", "ids"), table, steps=8, top_k=3, temperature=1.0, seed=5, samples=3)
    return longer.select("key", "sample", F.md5(chars.decode_column("ids", marked)).alias("digest"))


@query(f"""
    WITH {VOCAB}, {STARTS},
    corpus AS (SELECT split, string_agg(part, '' ORDER BY doc_id) AS text, sum(length(part)) AS n FROM parts GROUP BY split),
    letters AS (
        SELECT unnest(string_split(text, '')) AS ch, unnest(range(length(text))) AS pos FROM corpus WHERE split = 'train'
    ),
    follows AS (SELECT ch, lead(ch) OVER (ORDER BY pos) AS nxt FROM letters),
    model AS (SELECT ch, nxt, count(*) AS seen FROM follows WHERE nxt IS NOT NULL GROUP BY ALL),
    totals AS (SELECT ch, sum(seen) AS total FROM model GROUP BY ch),
    draws AS (
        SELECT split, iter, row,
               CAST('0x' || left(md5('42:' || split || ':' || iter || ':' || row), 15) AS BIGINT) % CAST(n - 128 AS BIGINT) AS start
        FROM corpus, (SELECT unnest(range(10)) AS iter), (SELECT unnest(range(12)) AS row)
    ),
    blocks AS (SELECT split, iter, row, string_split(substr(text, start + 1, 129), '') AS b FROM draws JOIN corpus USING (split)),
    pairs AS (SELECT split, iter, unnest(b[:128]) AS ch, unnest(b[2:]) AS nxt FROM blocks),
    losses AS (
        SELECT split, iter, avg(-ln((coalesce(seen, 0) + 1.0::DOUBLE) / (coalesce(total, 0) + (SELECT count(*) FROM vocab)))) AS loss
        FROM pairs LEFT JOIN model USING (ch, nxt) LEFT JOIN totals USING (ch) GROUP BY split, iter
    )
    SELECT split, count(*) AS iters, round(avg(loss), 6) AS loss FROM losses GROUP BY split
""")
def estimate_loss(spark: SparkSession, folder: str) -> DataFrame:
    """Loss of the train split's bigrams on 10 batches of 12 drawn blocks of either split."""
    docs = read_documents(spark, folder)
    encoder = char_encoder(docs)
    cut = stored(split_contiguous(docs, 0.9), "cut")
    table = stored(char_ngrams(cut.where("split = 'train'"), encoder), "counts")
    blocks = sample_documents(cut, encoder.encode, iters=10, batch=12, block=128, seed=42)
    found = ngram.estimate_loss(blocks, table, encoder.size)
    return found.select("split", "iters", F.round("loss", 6).alias("loss"))
