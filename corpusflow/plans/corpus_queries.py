"""Queries over documents: sources, vocabularies, encoding, splits, pages, token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusflow.functions import chars, subword
from corpusflow.functions.completions import split_completion as add_completion_parts
from corpusflow.functions.lists import crop_context as crop, shift_pairs as shifted
from corpusflow.functions.chars import collect_vocab
from corpusflow.operators import encode, pages as page_ops, rows, splits, vocab as vocab_ops
from corpusflow.operators.sampling import sample_documents
from corpusflow.plans.char_corpus import char_encoder, char_pages, char_totals
from corpusflow.plans.registry import query
from corpusflow.scratch import scratch_path
from corpusflow.sinks.tables import append_registry, write_vocab
from corpusflow.sources.dataset import read_dataset, read_encoder, read_vocab
from corpusflow.sources.tables import read_documents, read_table, spread, spread_documents
from corpusflow.sources.text import read_text_corpus, read_text_lines, sum_first_field
from corpusflow.sources.tokenfile import read_token_files, sample_token_files, write_token_files

# Shared pieces of the SQL.  DuckDB splits text by code points, as Spark does.
VOCAB = """
    vocab AS (
        SELECT row_number() OVER (ORDER BY ch) - 1 AS id, ch
        FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents)
        WHERE ch <> ''
    )"""
LONG = """
    long AS (
        SELECT doc_id, unnest(string_split(text, '')) AS ch, unnest(range(0, length(text))) AS pos
        FROM documents WHERE length(text) > 0
    ),
    coded AS (SELECT doc_id, pos, id FROM long JOIN vocab USING (ch))"""
STREAM = """
    stream AS (SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS gpos, id FROM coded)"""
STARTS = """
    starts AS (
        SELECT doc_id, text, length(text) AS len,
               sum(length(text)) OVER (ORDER BY doc_id) - length(text) AS start,
               CAST(floor(sum(length(text)) OVER () * CAST(0.9 AS DOUBLE)) AS BIGINT) AS cut
        FROM documents
    ),
    parts AS (
        SELECT 'train' AS split, doc_id, CASE WHEN start + len <= cut THEN text ELSE left(text, CAST(cut - start AS BIGINT)) END AS part
        FROM starts WHERE start < cut
        UNION ALL
        SELECT 'val', doc_id, CASE WHEN start >= cut THEN text ELSE substr(text, CAST(cut - start + 1 AS BIGINT)) END
        FROM starts WHERE start + len > cut OR start >= cut
    )"""


def _digest(ids: str = "ids"):
    return F.md5(F.array_join(F.col(ids).cast("array<string>"), ",")).alias("digest")


def _one_split(docs: DataFrame) -> DataFrame:
    return docs.withColumn("split", F.lit("train"))


@query("""
    SELECT 'train' AS split, doc_id, lang, source, n_chars, md5(text) AS digest FROM documents
""")
def src_documents(spark: SparkSession, folder: str) -> DataFrame:
    data = read_dataset(spark, "documents", folder)
    return data.select("split", "doc_id", "lang", "source", "n_chars", F.md5("text").alias("digest"))


@query("""
    SELECT lang, CAST(sum(length(regexp_replace(text, '\\r\\n?', chr(10), 'g')) + 1) AS BIGINT) AS chars
    FROM documents GROUP BY lang
""")
def text_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Texts written to plain files and read back as whole files."""
    path = scratch_path(spark, "text")
    docs = read_table(spark, folder, "documents").select("lang", "text")
    docs.write.partitionBy("lang").option("maxRecordsPerFile", 2000).text(path)
    files = read_text_corpus(spark, f"{path}/lang=*")
    lang = F.regexp_extract("path", "/lang=([^/]+)/", 1)
    return files.groupBy(lang.alias("lang")).agg(F.sum(chars.char_len("text")).alias("chars"))


@query("""
    SELECT lang, CAST(sum(length(regexp_replace(text, '\\r\\n?', chr(10), 'g')) + 1) AS BIGINT) AS chars,
           CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS lines
    FROM documents GROUP BY lang
""")
def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same files read line by line in ranges, as files of any size are."""
    path = scratch_path(spark, "text")
    read_table(spark, folder, "documents").select("lang", "text").write.partitionBy("lang").text(path)
    lines = read_text_lines(spark, f"{path}/lang=*")
    lang = F.regexp_extract("path", "/lang=([^/]+)/", 1)
    return lines.groupBy(lang.alias("lang")).agg(F.sum(chars.char_len("text")).alias("chars"), F.count("*").alias("lines"))


@query("""
    SELECT event_type AS name, round(sum(value), 4) AS total FROM events GROUP BY event_type
""")
def first_field_sums(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of ``value event_id`` in one folder per event type, summed per file."""
    path = scratch_path(spark, "weights")
    events = read_table(spark, folder, "events")
    lines = events.select("event_type", F.concat_ws("  ", F.col("value").cast("string"), "event_id").alias("line"))
    lines.write.partitionBy("event_type").text(path)
    files = sum_first_field(spark, f"{path}/event_type=*")
    name = F.regexp_extract("file", "/event_type=([^/]+)/", 1)
    return files.groupBy(name.alias("name")).agg(F.round(F.sum("total"), 4).alias("total"))


@query("""
    SELECT lang, count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS chars,
           (SELECT count(DISTINCT ch) FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents AS i
            WHERE i.lang = d.lang) WHERE ch <> '') AS vocab_size
    FROM documents AS d GROUP BY lang
""")
def corpus_stats(spark: SparkSession, folder: str) -> DataFrame:
    return vocab_ops.corpus_stats(spread_documents(spark, folder, "lang"), by=("lang",))


@query("""
    SELECT ch, count(*) AS cnt FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents)
    WHERE ch <> '' GROUP BY ch
""")
def char_freq(spark: SparkSession, folder: str) -> DataFrame:
    return vocab_ops.char_freq(spread_documents(spark, folder))


@query(f"WITH {VOCAB} SELECT CAST(id AS INTEGER) AS id, ch FROM vocab")
def vocab(spark: SparkSession, folder: str) -> DataFrame:
    return vocab_ops.build_vocab(spread_documents(spark, folder))


@query(f"WITH {VOCAB} SELECT count(*) AS vocab_size FROM vocab")
def vocab_size(spark: SparkSession, folder: str) -> DataFrame:
    return vocab_ops.vocab_size(spread_documents(spark, folder))


@query(f"WITH {VOCAB} SELECT CAST(id AS INTEGER) AS id, ch FROM vocab")
def vocab_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Vocabulary stored and read back."""
    path = scratch_path(spark, "vocab")
    write_vocab(vocab_ops.build_vocab(spread_documents(spark, folder)), path)
    return read_vocab(spark, path)


@query(f"""
    WITH {VOCAB}, {LONG}
    SELECT doc_id, md5(string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos)) AS digest FROM coded GROUP BY doc_id
""")
def stored_encoder(spark: SparkSession, folder: str) -> DataFrame:
    """Documents encoded with the encoder that a stored vocabulary gives."""
    docs, path = spread_documents(spark, folder), scratch_path(spark, "vocab")
    write_vocab(vocab_ops.build_vocab(docs), path)
    return read_encoder(spark, path).encode(docs).select("doc_id", _digest())


_OOV = """
    WITH known AS (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents WHERE lang = 'en'),
    used AS (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents WHERE lang = 'de')
"""


@query(_OOV + "SELECT ch, count(*) AS cnt FROM used WHERE ch <> '' AND ch NOT IN (SELECT ch FROM known) GROUP BY ch")
def oov_chars(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread_documents(spark, folder, "lang")
    known = vocab_ops.build_vocab(docs.where("lang = 'en'"))
    return vocab_ops.oov_chars(docs.where("lang = 'de'"), known)


@query(_OOV + """
    SELECT doc_id, string_agg(DISTINCT ch, '' ORDER BY ch) AS chars
    FROM used WHERE ch <> '' AND ch NOT IN (SELECT ch FROM known) GROUP BY doc_id
""")
def oov_rows(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread_documents(spark, folder, "lang")
    known = vocab_ops.build_vocab(docs.where("lang = 'en'"))
    found = vocab_ops.oov_rows(docs.where("lang = 'de'"), known)
    return found.select("doc_id", F.array_join("chars", "").alias("chars"))


@query(f"""
    WITH {VOCAB}, {LONG}
    SELECT doc_id, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum, CAST(sum(id * pos) AS BIGINT) AS place_sum
    FROM coded GROUP BY doc_id
""")
def token_long(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread_documents(spark, folder)
    long = vocab_ops.token_long(docs, vocab_ops.build_vocab(docs))
    weighted = F.col("id").cast("bigint") * F.col("pos")
    return long.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.sum("id").alias("id_sum"), F.sum(weighted).alias("place_sum")
    )


@query(f"""
    WITH {VOCAB}, {LONG}
    SELECT doc_id, lang, CAST(length(text) AS INTEGER) AS len, digest FROM documents JOIN (
        SELECT doc_id, md5(string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos)) AS digest FROM coded GROUP BY doc_id
    ) USING (doc_id)
""")
def encode_chars(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread_documents(spark, folder, "lang")
    coded = encode.encode_chars(docs, vocab_ops.build_vocab(docs))
    return coded.select("doc_id", "lang", "len", _digest())


@query("SELECT doc_id, md5(text) AS digest FROM documents")
def decode_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread_documents(spark, folder)
    known = collect_vocab(vocab_ops.build_vocab(docs))
    return encode.decode_ids(encode.encode_chars(docs, known), known).select("doc_id", F.md5("text").alias("digest"))


@query("""
    SELECT doc_id, lang, CAST(strlen(text) + 1 AS INTEGER) AS len, 256 AS last_id, md5(hex(encode(text))) AS digest
    FROM documents
""")
def encode_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Subword encoding with the single-byte ranks: ids are the UTF-8 bytes, then end of text."""
    coded = subword.encode_subword(spread_documents(spark, folder, "lang"), subword.byte_ranks())
    digits = F.transform(F.slice("ids", F.lit(1), F.col("len") - 1), lambda i: F.lpad(F.hex(i), 2, "0"))
    return coded.select("doc_id", "lang", "len", F.element_at("ids", -1).alias("last_id"), F.md5(F.array_join(digits, "")).alias("digest"))


@query("SELECT doc_id, md5(text) AS digest FROM documents")
def bytes_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    ranks = subword.byte_ranks()
    coded = subword.encode_subword(spread_documents(spark, folder), ranks)
    return subword.decode_subword(coded, ranks).select("doc_id", F.md5("text").alias("digest"))


# Where the ranks of a 50k byte-pair encoding lie, unless the session names another file.
RANKS_SETTING, RANKS_PATH = "spark.corpusflow.ranks.path", "/opt/tokenizers/byte_bpe_50k.tiktoken"


@query("SELECT doc_id, 50256 AS last_id, true AS shorter, md5(text) AS digest FROM documents")
def subword_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The 50k byte-pair encoding: decodes to the text, takes no more ids than bytes."""
    ranks = subword.read_ranks(spark.conf.get(RANKS_SETTING, RANKS_PATH))
    docs = spread_documents(spark, folder).withColumn("bytes", F.octet_length("text"))
    coded = subword.encode_subword(docs, ranks)
    checked = coded.withColumns({"last_id": F.element_at("ids", -1), "shorter": F.col("len") <= F.col("bytes") + 1})
    return subword.decode_subword(checked, ranks).select("doc_id", "last_id", "shorter", F.md5("text").alias("digest"))


@query("""
    SELECT conv_id, turn, CAST(strlen(text) + 1 AS INTEGER) AS as_prompt, CAST(strlen(text) + 13 AS INTEGER) AS as_text,
           256 AS last_id
    FROM conversations
""")
def encode_prompt(spark: SparkSession, folder: str) -> DataFrame:
    """The end-of-text marker is one id in a prompt and plain bytes in a corpus."""
    ranks = subword.byte_ranks()
    marked = read_table(spark, folder, "conversations").withColumn("text", F.concat("text", F.lit(subword.END_OF_TEXT)))
    coded = subword.encode_prompt(marked, ranks)
    plain = F.size(subword.encode_column("text", ranks, eot=False))
    return coded.select(
        "conv_id", "turn", F.size("ids").alias("as_prompt"), plain.alias("as_text"), F.element_at("ids", -1).alias("last_id")
    )


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def drop_columns(spark: SparkSession, folder: str) -> DataFrame:
    return rows.drop_columns(read_table(spark, folder, "documents"), "text")


@query("""
    SELECT d.doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic, length(text) AS n, length(string_split(text, ' ')) AS words
    FROM documents AS d LEFT JOIN labels USING (doc_id)
""")
def map_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A Python function per row of the whole corpus; label columns survive, the text does not."""
    labelled = spread_documents(spark, folder).join(read_table(spark, folder, "labels"), "doc_id", "left")
    labelled = labelled.withColumns({name: F.coalesce(name, F.lit(-1)) for name in ("quality", "toxic")})

    def measure(row: dict) -> dict:
        return {"n": len(row["text"]), "words": len(row["text"].split(" "))}

    return rows.map_rows(labelled, measure, "n bigint, words bigint", remove_columns=["text"])


@query("""
    SELECT conv_id, turn, string_split(text, chr(10))[1] AS prompt,
           '> ' || array_to_string(string_split(text, chr(10))[2:], chr(10) || '> ') AS formatted
    FROM (SELECT conv_id, turn, text || chr(10) || role || chr(10) || text AS text FROM conversations)
""")
def split_completion(spark: SparkSession, folder: str) -> DataFrame:
    """Completions are the turn, its role and the turn again on lines of their own."""
    turns = read_table(spark, folder, "conversations")
    completions = turns.select("conv_id", "turn", F.concat_ws("\n", "text", "role", "text").alias("text"))
    return add_completion_parts(completions).select("conv_id", "turn", "prompt", "formatted")


@query("""
    WITH runs AS (SELECT DISTINCT user_id FROM events), more AS (SELECT DISTINCT user_id FROM events WHERE value > 50)
    SELECT 'runs/' || user_id AS path, count(*) AS n FROM (SELECT * FROM runs UNION ALL SELECT * FROM more) GROUP BY user_id
""")
def registry_append(spark: SparkSession, folder: str) -> DataFrame:
    """Run folders appended twice to one registry."""
    path, events = scratch_path(spark, "registry"), read_table(spark, folder, "events")
    for part in (events, events.where("value > 50")):
        append_registry(part.select(F.concat(F.lit("runs/"), "user_id").alias("path")).distinct(), path)
    return spark.read.parquet(path).groupBy("path").agg(F.count("*").alias("n"))


@query("""
    SELECT CASE WHEN CAST('0x' || left(md5('2357:' || doc_id), 15) AS BIGINT) / 1152921504606846976.0::DOUBLE < 0.1
           THEN 'val' ELSE 'train' END AS split, doc_id FROM documents
""")
def split_random(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_random(read_table(spark, folder, "documents").select("doc_id"), 0.1)


@query(f"WITH {STARTS} SELECT split, doc_id, length(part) AS n, md5(part) AS digest FROM parts")
def split_contiguous(spark: SparkSession, folder: str) -> DataFrame:
    cut = splits.split_contiguous(read_documents(spark, folder), 0.9)
    return cut.select("split", "doc_id", F.length("text").cast("bigint").alias("n"), F.md5("text").alias("digest"))


@query(f"""
    WITH {VOCAB}, {STARTS},
    ids AS (
        SELECT split, count(*) AS tokens FROM (SELECT split, unnest(string_split(part, '')) AS ch FROM parts) JOIN vocab USING (ch)
        GROUP BY split
    )
    SELECT split, count(*) AS documents, any_value(tokens) AS tokens FROM parts JOIN ids USING (split) GROUP BY split
""")
def char_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The character corpus from end to end: vocabulary, 90/10 cut, ids, totals."""
    return char_totals(read_documents(spark, folder))


@query("""
    SELECT split, CAST(sum(strlen(text) + 1) AS BIGINT) AS tokens FROM (
        SELECT CASE WHEN CAST('0x' || left(md5('2357:' || doc_id), 15) AS BIGINT) / 1152921504606846976.0::DOUBLE < 0.1
               THEN 'val' ELSE 'train' END AS split, text FROM documents
    ) GROUP BY split
""")
def token_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Random split, subword encoding with end of text, tokens per split."""
    parted = splits.split_random(spread_documents(spark, folder), 0.1)
    return page_ops.token_totals(subword.encode_subword(parted, subword.byte_ranks()))


# Byte-pair merges in SQL, on the hexadecimal bytes of every distinct piece: one with a rank of its own is one id, in
# others the leftmost pair of the lowest rank is joined until no pair has a rank.  A stretch is blanks and what follows
# them; its blanks but the last are a piece by themselves.
_BLANK = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_PIECES = rf"""
    ranks AS (
        SELECT hex(from_base64(token)) AS token, rank
        FROM read_csv('{RANKS_PATH}', delim = ' ', header = false, quote = '', escape = '', auto_detect = false,
                      columns = {{'token': 'VARCHAR', 'rank': 'INTEGER'}})
    ),
    stretches AS (
        SELECT stretch, count(*) AS n
        FROM (SELECT unnest(regexp_extract_all(text, '[{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+')) AS stretch FROM documents)
        GROUP BY stretch
    ),
    cut AS (SELECT stretch, n, regexp_extract(stretch, '^([{_BLANK}]*)[{_BLANK}][^{_BLANK}]', 1) AS blank FROM stretches),
    pieces AS (
        SELECT hex(encode(piece)) AS piece, sum(n) AS n FROM (
            SELECT blank AS piece, n FROM cut WHERE blank <> ''
            UNION ALL
            SELECT unnest(regexp_extract_all(substr(stretch, length(blank) + 1),
                '''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_BLANK}\p{{L}}\p{{N}}]+|[{_BLANK}]+')), n
            FROM cut
        ) GROUP BY piece
    ),
    merging AS (
        SELECT piece, regexp_extract_all(piece, '..') AS parts FROM pieces WHERE piece NOT IN (SELECT token FROM ranks)
        UNION ALL
        SELECT piece, parts[:place - 1] || [parts[place] || parts[place + 1]] || parts[place + 2:] FROM (
            SELECT piece, parts, arg_min(place, (rank, place)) AS place FROM (
                SELECT piece, parts, place, parts[place] || parts[place + 1] AS token
                FROM (SELECT piece, parts, unnest(range(1, len(parts))) AS place FROM merging)
            ) JOIN ranks USING (token) GROUP BY piece, parts
        )
    ),
    sizes AS (SELECT piece, min(len(parts)) AS ids FROM merging GROUP BY piece)"""


@query(f"""
    WITH RECURSIVE {_PIECES},
    total AS (
        SELECT CAST(nullif(count(text), 0) AS BIGINT) + CAST(coalesce(
            (SELECT sum(n * coalesce(ids, 1)) FROM pieces LEFT JOIN sizes USING (piece)), 0) AS BIGINT) AS tokens
        FROM documents
    )
    SELECT 'train' AS split, tokens, round(tokens / 491520.0::DOUBLE, 6) AS iters FROM total
""")
def epoch_iters(spark: SparkSession, folder: str) -> DataFrame:
    """How many iterations of 491,520 tokens read the subword corpus once: the 50k byte-pair encoding, merges and all."""
    from corpusflow.functions.metrics import BatchShape
    from corpusflow.operators.runlog import epoch_iters as with_iters

    ranks = subword.read_ranks(spark.conf.get(RANKS_SETTING, RANKS_PATH))
    coded = subword.encode_subword(_one_split(spread_documents(spark, folder)), ranks)
    shape = BatchShape(gas=5, world=8, batch=12, block=1024)
    return with_iters(page_ops.token_totals(coded), shape.tokens_per_iter).withColumn("iters", F.round("iters", 6))


@query("""
    SELECT 'train' AS split, doc_id, CAST(sum(length(text)) OVER (ORDER BY doc_id) - length(text) AS BIGINT) AS start
    FROM documents
""")
def doc_offsets(spark: SparkSession, folder: str) -> DataFrame:
    docs = _one_split(read_table(spark, folder, "documents"))
    return page_ops.token_offsets(docs, length=F.length("text")).select("split", "doc_id", "start")


@query("SELECT lang AS split, doc_id, CAST(ntile(64) OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS INTEGER) AS shard FROM documents")
def shards(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select(F.col("lang").alias("split"), "doc_id")
    return page_ops.contiguous_shards(docs, 64)


_PAGES = f"""
    WITH {VOCAB}, {LONG}, {STREAM}
    SELECT 'train' AS split, gpos // 1024 AS page, CAST(count(*) AS INTEGER) AS size,
           md5(string_agg(CAST(id AS VARCHAR), ',' ORDER BY gpos)) AS digest
    FROM stream GROUP BY gpos // 1024
"""


@query(_PAGES)
def token_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = char_pages(_one_split(read_documents(spark, folder)))
    return pages.select("split", "page", F.size("ids").alias("size"), _digest())


@query("""
    WITH ends AS (SELECT CAST(sum(length(text) + 1) OVER (ORDER BY doc_id) - 1 AS BIGINT) AS gpos FROM documents),
    total AS (SELECT max(gpos) + 1 AS n FROM ends),
    pages AS (SELECT unnest(range(0, (n + 1023) // 1024)) AS page, n FROM total),
    counted AS (SELECT gpos // 1024 AS page, count(*) AS ends FROM ends GROUP BY gpos // 1024)
    SELECT 'train' AS split, page, CAST(least(1024, n - page * 1024) AS INTEGER) AS size, CAST(coalesce(ends, 0) AS INTEGER) AS ends
    FROM pages LEFT JOIN counted USING (page)
""")
def subword_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of documents that end with a marker of their own, as subword corpora do."""
    docs = read_documents(spark, folder)
    encoder = char_encoder(docs)
    marked = encoder.encode(spread(_one_split(docs), "doc_id")).withColumn("ids", F.concat("ids", F.array(F.lit(encoder.size))))
    # a character more than the text has: the offsets never touch the encoder
    offsets = page_ops.token_offsets(_one_split(docs), length=F.length("text") + 1)
    pages = page_ops.cut_pages(page_ops.in_order(marked.select("split", "doc_id", "ids"), offsets), 1024)
    ends = F.size(F.filter("ids", lambda i: i == encoder.size))
    return pages.select("split", "page", F.size("ids").alias("size"), ends.alias("ends"))


def _written(spark: SparkSession, folder: str, layout: str) -> DataFrame:
    path, docs = scratch_path(spark, "tokens"), _one_split(read_documents(spark, folder))
    write_token_files(char_pages(docs), path, layout=layout, in_stretches=True)
    back = read_token_files(spark, path).where("split = 'train'")
    return back.select("split", "page", F.size("ids").alias("size"), _digest())


@query(_PAGES)
def roundtrip_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as part files with a manifest and read back."""
    return _written(spark, folder, "parts")


@query(_PAGES)
def roundtrip_single_files(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written in place into one flat file per split and read back."""
    return _written(spark, folder, "single")


@query(f"""
    WITH {VOCAB}, {LONG}
    SELECT doc_id, md5(string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos)) AS digest
    FROM coded JOIN (SELECT doc_id, length(text) AS n FROM documents) USING (doc_id)
    WHERE pos >= n - 256 GROUP BY doc_id
""")
def crop_context(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread_documents(spark, folder)
    coded = encode.encode_chars(docs, vocab_ops.build_vocab(docs))
    return coded.select("doc_id", crop("ids", 256).alias("ids")).select("doc_id", _digest())


@query("""
    SELECT doc_id, md5(left(text, greatest(length(text) - 1, 0))) AS x_digest, md5(substr(text, 2)) AS y_digest
    FROM documents
""")
def shift_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Inputs and targets over the whole of every document, as text."""
    docs = spread_documents(spark, folder)
    known = collect_vocab(vocab_ops.build_vocab(docs))
    coded = encode.encode_chars(docs, known)
    coded = coded.select("doc_id", *shifted("ids", F.greatest(F.col("len") - 1, F.lit(0))))
    return coded.select(
        "doc_id",
        F.md5(chars.decode_column("x", known)).alias("x_digest"),
        F.md5(chars.decode_column("y", known)).alias("y_digest"),
    )


@query("""
    WITH lengths AS (SELECT lang, sum(length(text)) AS n FROM documents GROUP BY lang),
    corpus AS (SELECT lang, string_agg(text, '' ORDER BY doc_id) AS text FROM documents GROUP BY lang),
    draws AS (
        SELECT lang AS split, iter, row,
               CAST('0x' || left(md5('1337:' || lang || ':' || iter || ':' || row), 15) AS BIGINT) % CAST(n - 256 AS BIGINT) AS start
        FROM lengths, (SELECT unnest(range(16)) AS iter), (SELECT unnest(range(12)) AS row)
    )
    SELECT split, CAST(iter AS INTEGER) AS iter, CAST(row AS INTEGER) AS row, start,
           md5(substr(text, start + 1, 256)) AS x_digest, md5(substr(text, start + 2, 256)) AS y_digest
    FROM draws JOIN corpus ON lang = split
""")
def sample_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """16 batches of 12 blocks of 256 characters from every language, as text."""
    docs = read_documents(spark, folder, "lang").withColumnRenamed("lang", "split")
    encoder = char_encoder(docs)
    return _as_text(sample_documents(docs, encoder.encode, iters=16, batch=12, block=256), encoder.vocab)


def _as_text(blocks: DataFrame, known: dict[str, int]) -> DataFrame:
    return blocks.select(
        "split", "iter", "row", "start",
        F.md5(chars.decode_column("x", known)).alias("x_digest"),
        F.md5(chars.decode_column("y", known)).alias("y_digest"),
    )


_STORE = f"""
    WITH {STARTS},
    corpus AS (SELECT split, string_agg(part, '' ORDER BY doc_id) AS text, CAST(sum(length(part)) AS BIGINT) AS n FROM parts GROUP BY split)"""


@query(_STORE + """
    SELECT split, page, CAST(least(1024, n - page * 1024) AS INTEGER) AS size, md5(substr(text, page * 1024 + 1, 1024)) AS digest
    FROM (SELECT split, n, text, unnest(range(0, (n + 1023) // 1024)) AS page FROM corpus)
""")
def two_split_store(spark: SparkSession, folder: str) -> DataFrame:
    """The 90/10 cut written as token files of both splits and read back, pages as text."""
    docs, path = read_documents(spark, folder), scratch_path(spark, "tokens")
    encoder = char_encoder(docs)
    write_token_files(char_pages(splits.split_contiguous(docs, 0.9), encoder=encoder), path, in_stretches=True)
    back = read_token_files(spark, path)
    return back.select("split", "page", F.size("ids").alias("size"), F.md5(chars.decode_column("ids", encoder.vocab)).alias("digest"))


@query(_STORE + """,
    draws AS (
        SELECT split, iter, row,
               CAST('0x' || left(md5('1337:' || split || ':' || iter || ':' || row), 15) AS BIGINT) % CAST(n - 64 AS BIGINT) AS start
        FROM corpus, (SELECT unnest(range(20)) AS iter), (SELECT unnest(range(12)) AS row)
    )
    SELECT split, CAST(iter AS INTEGER) AS iter, CAST(row AS INTEGER) AS row, start,
           md5(substr(text, start + 1, 64)) AS x_digest, md5(substr(text, start + 2, 64)) AS y_digest
    FROM draws JOIN corpus USING (split)
""")
def sample_stored_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """20 batches of 12 blocks of 64 characters, read at their places in the token files of two splits."""
    docs, path = read_documents(spark, folder), scratch_path(spark, "tokens")
    encoder = char_encoder(docs)
    write_token_files(char_pages(splits.split_contiguous(docs, 0.9), encoder=encoder), path, in_stretches=True)
    return _as_text(sample_token_files(spark, path, iters=20, batch=12, block=64), encoder.vocab)
