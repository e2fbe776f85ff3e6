"""The registered queries of the numbered operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merch.llm import audit, chat, decontaminate, licenses, mixing, mtree, neighbours, packing, quality, simhash, toxicity, variants, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.near_vectors(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", F.col("n_links").cast("bigint").alias("n_links"), F.col("component_id").cast("bigint").alias("component_id"), "kept")


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_and_read(spark, table(spark, sf_dir, "pages"))
    number = lambda c: F.when(F.col(c) != "", F.col(c)).cast("bigint").alias(c)
    return read.select(number("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.packed_sequences(table(spark, sf_dir, "documents"), vocabulary())
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def license_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.array(*[F.lit(label) for label in sorted(set(licenses.BASE.values()))])
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(docs).withColumn("places", F.filter("hits", lambda h: F.array_contains(base, h["label"])))
    starts = F.transform("places", lambda h: h["first_word"])
    text = lambda labels: F.array_join(F.array_sort(labels), ",")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        text(F.array_distinct(F.transform("places", lambda h: h["label"]))).alias("base_labels"), text("labels").alias("labels"), "score",
        "expression", "obligations",
    )


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def near_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "kept")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return chat.read_back(chat.format_conversations(turns))


def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = toxicity.train(docs, labels.where(~held_out))
    found = toxicity.score_texts(docs.select("doc_id", "text", "lang"), model)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "toxic_flag")


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", "places", "perplexity", "threshold", "trusted", "keep")


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mtree.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.select(F.col("query_id").cast("bigint").alias("query_id"), "rank", F.col("vec_id").cast("bigint").alias("vec_id"), "score")


def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES = {
    "op1_nn_descent": near_vectors,
    "op2_capture_index": archive,
    "op3_best_fit_packing": packed,
    "op4_license_scan": license_labels,
    "op5_pareto_mixing": mixed,
    "op6_simhash_bk_tree": near_texts,
    "op7_chat_round_trip": conversations,
    "op8_toxicity_cnn": toxic_scores,
    "op9_kneser_ney_quality": quality_scores,
    "op10_m_tree_top_k": top_products,
    "op11_filter_audit": filter_audit,
    "op12_spelling_variants": spelling_variants,
    "op13_decontamination": contaminated,
}

ORACLE_SQL: dict[str, str] = {
    "op2_capture_index": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS holder FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND holder <> page_id THEN holder END AS refers_to FROM m""",
    "op10_m_tree_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_filter_audit": r"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
m AS (SELECT doc_id, part, (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
             + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
             + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > least, false)::INT AS mask FROM w),
g AS (SELECT doc_id AS marked, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM m LEFT JOIN g ON doc_id = marked GROUP BY ALL),
o AS (SELECT '' AS filter_order UNION ALL
      SELECT filter_order || l FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) WHERE NOT contains(filter_order, l)),
b AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit),
s AS (SELECT filter_order, step, bit AS own, (SELECT coalesce(sum(bit), 0)::INT FROM b WHERE contains(filter_order[1:step - 1], l)) AS before
      FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o WHERE length(filter_order) = 5) JOIN b ON l = filter_order[step]),
r AS (SELECT part, filter_order, step, own,
             sum(CASE WHEN mask & own = 0 AND mask & before = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, s GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r""",
    "op12_spelling_variants": r"""
WITH RECURSIVE steps AS (SELECT i, 0 AS k, i::BIGINT AS v FROM range(256) t(i)
                         UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM steps WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS tab FROM steps WHERE k = 8),
runs AS (SELECT id, run, count(*) AS times
         FROM (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
                      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
         WHERE length(run) >= 7 GROUP BY ALL),
hexed AS (SELECT *, hex(encode(id || ':' || run)) AS hx FROM runs),
hashed AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(hx), 2),
                  lambda i: (instr('0123456789ABCDEF', hx[i]) * 16 + instr('0123456789ABCDEF', hx[i + 1]) - 17)::BIGINT)),
                  lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) AS h FROM hexed, crc),
vocabulary AS (SELECT word, sum(times)::BIGINT AS n
               FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, times FROM hashed)
               WHERE length(word) >= 7 GROUP BY 1 HAVING sum(times) >= 2),
less AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS short FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS i FROM vocabulary)),
pairs AS (SELECT a.word, b.word AS other FROM less a JOIN less b ON a.i = b.i AND a.short = b.short AND a.word <> b.word
          UNION SELECT a.word, b.word FROM less a JOIN vocabulary b ON a.short = b.word
          UNION SELECT b.word, a.word FROM less a JOIN vocabulary b ON a.short = b.word),
near AS (SELECT p.word, count(*) AS n_near, first(o.word ORDER BY o.n DESC, o.word) AS best, max(o.n) AS best_n
         FROM pairs p JOIN vocabulary o ON p.other = o.word GROUP BY 1),
known AS (SELECT v.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
                 CASE WHEN best_n >= 10 * n THEN best_n END AS form_n FROM vocabulary v LEFT JOIN near USING (word)),
chain AS (SELECT word, word AS last, 0 AS depth FROM known UNION ALL SELECT c.word, k.form, depth + 1 FROM chain c JOIN known k ON c.last = k.word WHERE k.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM known JOIN (SELECT word, arg_max(last, depth) AS root FROM chain GROUP BY 1) USING (word)""",
    "op13_decontamination": r"""
WITH split AS (SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[i + 1:i + least(len(words), 10)], ' ') AS w
            FROM (SELECT *, unnest(range(0, len(words) - least(len(words), 10) + 1)) AS i FROM items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT k, size, unnest(range(0, len(words) - size + 1)) AS i, words FROM split, sizes WHERE len(words) >= size),
found AS (SELECT k, i, p.size, item_id FROM places p JOIN windows v ON p.size = v.size AND array_to_string(words[i + 1:i + p.size], ' ') = v.w),
hit AS (SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT k, unnest(range(i, i + size)) AS j FROM found) GROUP BY 1),
listed AS (SELECT k, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT k, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM split LEFT JOIN hit USING (k) LEFT JOIN listed USING (k)""",
}
