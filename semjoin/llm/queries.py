"""One query per operator, with production parameters, over its whole table; and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from semjoin.llm import chat, crosspoly, exact_dedup, language_id, merkle, mixing, packing, runs, sharding, simhash, token_counts, topk, toxicity
from semjoin.llm.common import stage

#: SimHash: words of a shingle, and the most bits that linked fingerprints differ in.
NEAR_WORDS, NEAR_BITS = 3, 2
#: Packing: words a batch holds when padded, and the number of length buckets.
PACK = {"token_budget": 16384, "buckets": 12}
#: Token counts: the vocabulary's file, and its free identifier that ends a document.
TOKENIZER, EOD = "/opt/tokenizers/byte_bpe_50k.tiktoken", 50256
#: Sharding: the shards' names.
SHARDS = [f"shard-{i:03d}" for i in range(64)]
#: Chat: the one tool of the calls that op8 derives, and its schema.
TOOLS = {"note": {"type": "object", "required": ["text", "turn"], "additionalProperties": False,
                  "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}}}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against a fresh digest index: which copy stays, and how many there are."""
    return exact_dedup.DigestIndex(spark).add(_table(spark, sf_dir, "documents"), batch=1)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint (3-word shingles) and its component at 2 bits or fewer."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), NEAR_WORDS, NEAR_BITS)
    return found.select("doc_id", "fingerprint", "component_id")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, counted in flat token files."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), TOKENIZER, EOD)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard."""
    docs = _table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, F.col("doc_id"), SHARDS).select("row.doc_id", "slot", "shard")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's block and schedule slot, sources weighted by the square root of their characters."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", F.length("text").alias("chars"))
    docs = stage(docs, "mixing")
    placed = mixing.scheduled(docs, F.col("chars"), mixing.source_weights(docs, F.col("chars")))
    return placed.select("row.doc_id", "source", "lane", "block", "slot", "start")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; learned from rows whose crc32(doc_id as text) mod 3 is not 1."""
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs, _crc32_mod("doc_id", 3) != 1)
    held_out = F.coalesce(_crc32_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return docs.select("doc_id", held_out, language_id.predict(F.col("text"), model).alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest products for every vector whose id is divisible by 20, against all others."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def tool_traffic(conversations: DataFrame) -> DataFrame:
    """The conversations with tool calls derived from them, as the table has none.

    Every assistant message also calls ``note`` with its text and turn, under an identifier made of conversation and
    turn; every later user message is also the result of the call of the turn before (an orphan if that was none).
    """
    made = lambda turn: F.concat(F.lit("c"), F.coalesce("conv_id", F.lit(-1)), F.lit("-"), turn)
    text = F.coalesce("text", F.lit(""))
    call = F.struct(made(F.col("turn")).alias("id"), F.lit("note").alias("name"), F.struct(text.alias("text"), F.col("turn").alias("turn")).alias("arguments"))
    with_call = F.to_json(F.struct(text.alias("content"), F.array(call).alias("tool_calls")))
    own = conversations.select("conv_id", "turn", "role", F.when(F.col("role") == "assistant", with_call).otherwise(F.col("text")).alias("text"))
    answer = F.to_json(F.struct(made(F.col("turn") - 1).alias("tool_call_id"), text.alias("content")))
    return own.unionByName(conversations.filter("role = 'user' AND turn > 0").select("conv_id", "turn", F.lit("tool").alias("role"), answer.alias("text")))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message, call and result of the conversations, linked, in order, checked and as canonical JSON."""
    return chat.link_and_format(tool_traffic(_table(spark, sf_dir, "conversations")), TOOLS)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's length bucket, batch and position."""
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, packing.word_count(F.col("text")), **PACK)


def _crc32_mod(column: str, k: int) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % k


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.FM:
    """Trained on the labelled rows of ``docs`` whose crc32(doc_id as text) mod 5 is not 0."""
    return toxicity.train(docs, _table(spark, sf_dir, "labels"), _crc32_mod("doc_id", 5) != 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score; labels of held-out rows are never seen."""
    docs = _table(spark, sf_dir, "documents")
    s = toxicity.score(F.col("text"), toxicity_model(spark, docs, sf_dir))
    scored = docs.select("doc_id", F.coalesce(_crc32_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), s.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof in the manifest of a tree a language, and the root that a tampered copy folds to."""
    docs = _table(spark, sf_dir, "documents")
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = F.when(F.coalesce(_crc32_mod("doc_id", 7) == 0, F.lit(False)), F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars"))
    return merkle.Manifest(docs, columns, "lang", "doc_id", claimed=[*columns[:3], more, columns[4]]).proofs()


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links at cosine 0.9 or more and its component."""
    return crosspoly.near_duplicates(_table(spark, sf_dir, "embeddings"), 0.9)


def periodic_tail(words: list[bytes], h: int | None) -> list[bytes]:
    """Where 10 divides h, the words from place a on repeat the p words from there; a and p follow from h."""
    n = len(words)
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs of words; a tenth of the documents get a periodic tail first."""
    docs = _table(spark, sf_dir, "documents")
    return runs.text_runs(docs, periodic_tail, F.crc32(F.col("doc_id").cast("string").cast("binary")))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_sharding": op3_sharding,
    "op4_mixing": op4_mixing,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_language_id": op6_language_id,
    "op7_exact_topk": op7_exact_topk,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_embedding_near_dedup": op12_embedding_near_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}

#: Fixed value: the polynomial of CRC-32, bits reversed.
_CRC32_POLY = 0xEDB88320
#: CRC-32 of the decimal doc_id, a bit a step; each digit enters on the first of its eight steps.
_SQL_CRC32 = f"""xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, {_CRC32_POLY} * (xor(a, x) & 1))))"""


def _sql_field(c: str) -> str:
    return f"coalesce(concat(octet_length(encode(CAST({c} AS VARCHAR))), ':', CAST({c} AS VARCHAR)), '-')"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(concat(" + ", ".join(_sql_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + "))"


ORACLES = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op7_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.v, p.v) AS BIGINT) AS score
                   FROM v q JOIN v p ON q.vec_id % 20 = 0 AND p.vec_id <> q.vec_id),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op11_merkle_manifest": f"""
        WITH RECURSIVE own AS (
               SELECT doc_id, coalesce(concat('=', lang), '') AS tree, {_sql_leaf("n_chars")} AS leaf,
                      CASE WHEN {_SQL_CRC32} % 7 = 0 THEN {_sql_leaf("(n_chars + 1)")} ELSE {_sql_leaf("n_chars")} END AS claimed
               FROM documents),
             leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS j,
                               count(*) OVER (PARTITION BY tree) AS n FROM own),
             lower AS (SELECT tree, 0 AS level, j, n, leaf AS digest FROM leaves
                       UNION ALL
                       SELECT tree, level + 1, j // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY j)) FROM lower WHERE n > 1
                       GROUP BY tree, level, j // 2, n),
             subroots AS (SELECT tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS j, count(*) OVER () AS n FROM lower WHERE n = 1),
             upper AS (SELECT 0 AS level, j, n, digest FROM subroots
                       UNION ALL
                       SELECT level + 1, j // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY j)) FROM upper WHERE n > 1
                       GROUP BY level, j // 2, n),
             root AS (SELECT digest AS root FROM upper WHERE n = 1),
             climb AS (SELECT l.doc_id, l.tree, l.leaf, l.j AS at, 0 AS level, l.j, l.n, l.claimed AS folded, '' AS path FROM leaves l
                       UNION ALL
                       SELECT c.doc_id, c.tree, c.leaf, c.at, c.level + 1, c.j // 2, (c.n + 1) // 2,
                              sha256(CASE WHEN s.digest IS NULL THEN c.folded WHEN c.j % 2 = 1 THEN concat(s.digest, c.folded) ELSE concat(c.folded, s.digest) END),
                              concat(c.path, coalesce(s.digest, ''))
                       FROM climb c LEFT JOIN lower s ON s.tree = c.tree AND s.level = c.level AND s.j = xor(c.j, 1) WHERE c.n > 1),
             tops AS (SELECT c.doc_id, c.tree, c.leaf, c.at, t.digest AS subroot, 0 AS level, t.j, t.n, c.folded, c.path
                      FROM climb c JOIN subroots t ON t.tree = c.tree WHERE c.n = 1
                      UNION ALL
                      SELECT c.doc_id, c.tree, c.leaf, c.at, c.subroot, c.level + 1, c.j // 2, (c.n + 1) // 2,
                             sha256(CASE WHEN s.digest IS NULL THEN c.folded WHEN c.j % 2 = 1 THEN concat(s.digest, c.folded) ELSE concat(c.folded, s.digest) END),
                             concat(c.path, coalesce(s.digest, ''))
                      FROM tops c LEFT JOIN upper s ON s.level = c.level AND s.j = xor(c.j, 1) WHERE c.n > 1)
        SELECT doc_id, leaf, subroot, root, sha256(path) AS proof_sha256, folded AS folded_root, folded = root AS verified
        FROM tops, root WHERE tops.n = 1""",
    # all pairs: the query finds its pairs by hashing, and misses less than one in a hundred of those just at 0.9
    "op12_embedding_near_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                     AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
             link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
                      AND list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.9),
             reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, link.b FROM reach JOIN link ON link.a = reach.r),
             smallest AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
             degree AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM smallest LEFT JOIN degree USING (vec_id)""",
}
