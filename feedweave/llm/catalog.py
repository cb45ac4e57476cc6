"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweave.llm import bpe, htmltext, kdshard, licenses, mixing, prefixtrie, ranked, simhash, tokencount, topk, toxicity, vecdedup, warc

# Production parameters.
TOP, SCALE = 20, 64
COSINE = 0.95
SHARDS = 16
TARGET_WEIGHTS = {f"src{k}": 20 - k for k in range(20)}
OTHER_WEIGHT = 5
SHINGLE_WORDS = 3
BIT_DISTANCE = 2
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
FAMILY, MOST_SHARED_TURNS = 20, 3
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 2048
BEST_DOCUMENTS = 10

QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, TOP, SCALE)


ORACLES["op1_topk"] = f"""
WITH v AS (
    SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS double)) AS bigint) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_inner_product(CAST(q.v AS double[]), CAST(c.v AS double[])) AS bigint) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS integer) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}
"""


@query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels").select("doc_id", "toxic"))
    scored = toxicity.with_score(docs, model)
    return scored.select(
        "doc_id",
        toxicity.is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    tokens = bpe.round_trip(docs, RANKS, PATTERN, with_tokens=False)
    return tokens.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op4_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.with_licenses(table(spark, folder, "documents"))


@query
def op5_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vecdedup.near_duplicates(table(spark, folder, "embeddings"), threshold=COSINE)


ORACLES["op5_vector_dedup"] = f"""
WITH RECURSIVE usable AS (
    SELECT vec_id, CAST(embedding AS double[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= {COSINE}
),
reach AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, least(e.vec_id, coalesce(m.b, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(m.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id LEFT JOIN least m ON m.a = e.vec_id
"""


@query
def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = htmltext.main_text(table(spark, folder, "pages"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    archives = warc.archive_folder(spark)
    directory = warc.write(pages, archives)
    found = warc.lookup(pages.select(warc.surt(F.col("url")).alias("key")), directory, archives, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op7_warc"] = f"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest,
           octet_length(encode(coalesce(html, ''))) AS n
    FROM pages
),
r AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p)
SELECT page_id, CAST(n AS bigint) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= {warc.LEAST_REVISIT_BYTES} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {warc.LEAST_REVISIT_BYTES} AND page_id <> first THEN first END AS refers_to
FROM r
"""


@query
def op8_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = kdshard.shard(table(spark, folder, "documents"), shards=SHARDS)
    none = F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", none)


@query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, TARGET_WEIGHTS, OTHER_WEIGHT)
    return mixed.select("doc_id", "source", "pool", "block", "slot", "release", "deadline", "position")


_POOLS = ", ".join(f"({k}, '{name}', {TARGET_WEIGHTS[name]})" for k, name in enumerate(sorted(TARGET_WEIGHTS)))
ORACLES["op9_mixing"] = f"""
WITH RECURSIVE pools(number, pool, weight) AS (
    VALUES {_POOLS}, ({len(TARGET_WEIGHTS)}, NULL, {OTHER_WEIGHT})
),
dealt AS (
    SELECT d.doc_id, d.source, coalesce(p.number, {len(TARGET_WEIGHTS)}) AS number,
           row_number() OVER (PARTITION BY coalesce(p.number, {len(TARGET_WEIGHTS)})
               ORDER BY substr(md5(coalesce(CAST(d.doc_id AS varchar), '')), 1, 3), d.doc_id NULLS FIRST,
                        md5(d.text) NULLS FIRST) - 1 AS idx
    FROM documents d LEFT JOIN pools p ON d.source = p.pool
),
size AS (SELECT greatest(1, (count(*) + {mixing.BLOCKS - 1}) // {mixing.BLOCKS}) AS rows FROM documents),
supply AS (
    SELECT p.number, p.pool, p.weight, count(d.number) AS docs,
           (count(d.number) + any_value(s.rows) - 1) // any_value(s.rows) AS blocks
    FROM pools p CROSS JOIN size s LEFT JOIN dealt d ON d.number = p.number
    GROUP BY p.number, p.pool, p.weight
),
windows AS (
    SELECT b.number, b.j,
           CAST(sum(least(q.weight * b.j, q.blocks * b.weight)) AS bigint) // b.weight AS release,
           (CAST(sum(least(q.weight * (b.j + 1), q.blocks * b.weight)) AS bigint) + b.weight - 1) // b.weight
               AS deadline
    FROM (SELECT number, weight, unnest(range(blocks)) AS j FROM supply) b CROSS JOIN supply q
    GROUP BY b.number, b.weight, b.j
),
edf(slot, done, pick) AS (
    SELECT CAST(-1 AS bigint), (SELECT list(CAST(0 AS bigint)) FROM supply), CAST(NULL AS integer)
    UNION ALL
    SELECT t + 1, done[1:pick] || [done[pick + 1] + 1] || done[pick + 2:], pick
    FROM (SELECT e.slot AS t, e.done, arg_min(w.number, w.deadline * 1000 + w.number) AS pick
          FROM edf e JOIN windows w ON w.j = e.done[w.number + 1] AND w.release <= e.slot + 1
          GROUP BY e.slot, e.done)
),
slots AS (
    SELECT e.slot, e.pick AS number, e.done[e.pick + 1] - 1 AS block,
           least(s.rows, u.docs - (e.done[e.pick + 1] - 1) * s.rows) AS size
    FROM edf e JOIN supply u ON u.number = e.pick CROSS JOIN size s
),
placed AS (
    SELECT *, coalesce(sum(size) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM slots
)
SELECT d.doc_id, d.source, p.pool, CAST(s.block AS integer) AS block, s.slot, w.release, w.deadline,
       CAST(s.before + d.idx % z.rows AS bigint) AS position
FROM dealt d CROSS JOIN size z
JOIN placed s ON s.number = d.number AND s.block = d.idx // z.rows
JOIN windows w ON w.number = s.number AND w.j = s.block
JOIN pools p ON p.number = d.number
"""


@query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return simhash.near_duplicates(docs, shingle_words=SHINGLE_WORDS, distance=BIT_DISTANCE)


@query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.prefix_trie(table(spark, folder, "conversations"), FAMILY, MOST_SHARED_TURNS)


_TURN_ID = "sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, '')))"
ORACLES["op11_prefix_trie"] = f"""
WITH turns AS (
    SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_TURN_ID}[1:32]) AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
own AS (SELECT conv_id, list(t ORDER BY place) AS turns FROM turns GROUP BY conv_id),
shares AS (
    SELECT conv_id, xor(list_reduce(
               list_prepend(CAST(4294967295 AS bigint),
                   [CAST(ascii(CAST(conv_id AS varchar)[i]) AS bigint) FOR i IN range(1, length(CAST(conv_id AS varchar)) + 1)]),
               lambda c, x: list_reduce(list_prepend(xor(c, x), [CAST(b AS bigint) FOR b IN range(8)]),
                   lambda v, b: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)
           % {MOST_SHARED_TURNS + 1} AS h
    FROM own
),
paths AS (
    SELECT o.conv_id, CASE WHEN s.h > 0 AND d.turns IS NOT NULL THEN d.turns[1:s.h] ELSE [] END || o.turns[s.h + 1:] AS p
    FROM own o JOIN shares s ON s.conv_id = o.conv_id LEFT JOIN own d ON d.conv_id = o.conv_id - o.conv_id % {FAMILY}
),
steps AS (
    SELECT conv_id, len(p) AS n, depth, p[1:depth] AS prefix FROM (SELECT *, unnest(range(len(p) + 1)) AS depth FROM paths)
),
nodes AS (
    SELECT min(conv_id) AS conv_id, depth, prefix, count(*) AS n_convs,
           list(conv_id ORDER BY conv_id) FILTER (n = depth) AS ends
    FROM steps GROUP BY depth, prefix
),
members AS (
    SELECT s.conv_id, s.depth, n.conv_id AS node FROM steps s JOIN nodes n ON n.depth = s.depth AND n.prefix = s.prefix
),
linked AS (
    SELECT n.*, m.node AS parent_conv_id FROM nodes n LEFT JOIN members m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1
),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n FROM linked WHERE depth > 0 GROUP BY ALL),
own_values AS (
    SELECT l.*, coalesce(c.n, 0) AS n_children,
           CASE WHEN l.depth = 0 THEN 0
                ELSE (l.n_convs - 1) * len(regexp_extract_all(l.prefix[-1].text, '[^\x20\x09-\x0D]+')) END AS saved
    FROM linked l LEFT JOIN children c ON c.conv_id = l.conv_id AND c.depth = l.depth
),
subtrees AS (
    SELECT m.node AS conv_id, m.depth, count(*) FILTER (v.n_children = 0) AS n_leaves, sum(v.saved) AS saved
    FROM own_values v JOIN members m ON m.conv_id = v.conv_id AND m.depth <= v.depth
    GROUP BY m.node, m.depth
)
SELECT v.conv_id, v.depth, v.parent_conv_id, v.n_convs, v.n_children, s.n_leaves,
       CAST(s.saved AS bigint) AS saved_tokens,
       sha256(coalesce(array_to_string(v.ends, ','), '')) AS ends_sha256
FROM own_values v JOIN subtrees s ON s.conv_id = v.conv_id AND s.depth = v.depth
"""


@query
def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    sized = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = tokencount.token_counts(sized, WORD_TOKENIZER)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"), BEST_DOCUMENTS)


_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{}')".format(
    ranked.TERM
)
ORACLES["op13_ranked_search"] = f"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents
),
held AS (SELECT row, doc_id, CAST(len(terms) AS bigint) AS n, terms FROM docs WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS bigint) AS length FROM held),
counts AS (
    SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, n, unnest(terms) AS term FROM held) GROUP BY ALL
),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(t.docs) + 2 AS double) / CAST(2 * count(*) + 1 AS double))) AS bigint) AS w
    FROM counts CROSS JOIN total t GROUP BY term
),
scored AS (
    SELECT a.item_id, c.row, c.doc_id,
           CAST(sum(a.times * w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (25 + (75 * c.n * t.docs) // t.length)))) AS bigint) AS score
    FROM asked a JOIN counts c ON c.term = a.term JOIN weights w ON w.term = a.term CROSS JOIN total t
    GROUP BY a.item_id, c.row, c.doc_id
),
ordered AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS integer) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ordered WHERE rank <= {BEST_DOCUMENTS}
"""
