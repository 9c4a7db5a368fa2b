"""One query per operator over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.llm import chat, collocations, linededup, mixing, pieces, pii, prefix_trie, quality, sharding, simhash, style_tree, topk, toxicity
from haulmark.llm.common import written

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Text that looks like the template itself.
ODD_TURN = "\\### Assistant: </turn> ok"


def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations formatted into windows, and what reading them back gives."""
    odd = spark.createDataFrame(
        [(-7, 0, "user", ODD_TURN), (-7, 1, "assistant", ODD_TURN)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    windows = chat.read_back(chat.format_conversations(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    ordered = F.sort_array(
        F.collect_list(F.struct(F.coalesce("part", F.lit(-(2**62))).alias("part"), "window", said.alias("said"), "loss_text"))
    )
    per_conv = windows.groupBy("conv_id").agg(
        F.sum("n_new").alias("n_turns"),
        ordered.alias("w"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
        F.count("*").alias("n_windows"),
    )
    loss = F.array_join("w.loss_text", "")
    return per_conv.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join("w.said", "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )


def op2_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the smallest document reachable over near fingerprints."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a quarter of the labels is held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.score_documents(docs, _table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.3).cast("int").alias("predicted"),
    )


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans, and all spans with those that the labelers add."""
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")


def op5_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to near equal sources: which are read in which epoch, and where in the order."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "mix_tokens", "mix_epoch", "mix_position")


#: Vocabulary files of public tokenizers.
TOKENIZERS = "/opt/tokenizers"


def op6_viterbi_pieces(spark: SparkSession, sf_dir: str, model: str = f"{TOKENIZERS}/piece_bpe_32k.model") -> DataFrame:
    """Piece ids of every document, and whether decoding them gives the text back."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encode(docs, model, keep=["doc_id"], round_trip="round_trip")
    return coded.select("doc_id", F.size("ids").alias("n_tokens"), "ids", "round_trip")


def op7_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners, by integer inner product, of every fiftieth vector among all others."""
    vectors = _table(spark, sf_dir, "embeddings").filter(topk.usable(F.col("embedding")))
    vectors = vectors.select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op8_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, the base rules, and the verdict of the voting rules."""
    found = quality.score_quality(_table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("quality") >= 0.5)).alias("kept"),
        "quality",
    )


def op9_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents less the runs of lines that repeat earlier ones."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.remove_repeated_runs(docs)


def op10_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards by the hash tree, and their shards with one more."""
    tree = sharding.even_tree(40)
    placed = sharding.assign_shards(_table(spark, sf_dir, "documents"), tree)
    grown = sharding.place(F.col("doc_id"), sharding.grow(tree))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        grown.alias("grown_shard"),
    )


def op11_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of the conversations, each begun with the first turns of the first of its five."""
    turns = written(prefix_trie.numbered_turns(_table(spark, sf_dir, "conversations")), "numbered")
    base, shared = F.expr("conv_id - conv_id % 5"), F.expr("crc32(cast(conv_id as string)) % 9")
    return prefix_trie.prefix_trie(*prefix_trie.branched(turns, base, shared, most=8))


def op12_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = style_tree.main_text(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op13_setm_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_chat_windows": op1_chat_windows,
    "op2_simhash_components": op2_simhash_components,
    "op3_toxicity": op3_toxicity,
    "op4_personal_data": op4_personal_data,
    "op5_temperature_mix": op5_temperature_mix,
    "op6_viterbi_pieces": op6_viterbi_pieces,
    "op7_voronoi_top_k": op7_voronoi_top_k,
    "op8_quality_votes": op8_quality_votes,
    "op9_line_runs": op9_line_runs,
    "op10_hash_tree": op10_hash_tree,
    "op11_burst_trie": op11_burst_trie,
    "op12_style_tree": op12_style_tree,
    "op13_setm_collocations": op13_setm_collocations,
}

#: CRC-32 table and checksum by the bitwise rule; the tree of 5 regions of 2 racks of 4 shards, and a sixth region.
_HASH_TREE_SQL = """
    WITH crc AS (
        SELECT list(list_reduce([i] || [0 for k in range(8)], lambda c, k:
            CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS entry
        FROM range(256) t(i)
    ), d AS (
        SELECT row_number() OVER () AS n, doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key,
               hex(encode(coalesce(text, ''))) AS h
        FROM documents
    ), c AS (
        SELECT n, doc_id, key, len(h) // 2 + 16 AS size,
               xor(list_reduce([4294967295] || [CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT) for i in range(len(h) // 2)],
                   lambda a, b: xor(a >> 8, entry[xor(a, b) % 256 + 1])), 4294967295) AS text_crc32
        FROM d, crc
    ), region AS (
        SELECT c.*, r, -ln((CAST('0x' || substr(md5(key || '/' || r), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
               / CASE WHEN r = 5 THEN 1.0 ELSE 8.0 END AS draw
        FROM c, range(6) t(r)
    ), rooted AS (
        SELECT n, doc_id, key, size, text_crc32, arg_min(r, draw) FILTER (r < 5) AS region, arg_min(r, draw) = 5 AS moves
        FROM region GROUP BY ALL
    ), racked AS (
        SELECT n, doc_id, key, size, text_crc32, region, moves,
               arg_min(k, -ln((CAST('0x' || substr(md5(key || '/' || region || '/' || k), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)) AS rack
        FROM rooted, range(2) t(k) GROUP BY ALL
    ), placed AS (
        SELECT n, doc_id, key, size, text_crc32, moves, region * 8 + rack * 4 + arg_min(s,
               -ln((CAST('0x' || substr(md5(key || '/' || region || '/' || rack || '/' || (region * 8 + rack * 4 + s)), 1, 13) AS BIGINT) + 0.5)
               / 4503599627370496.0)) AS shard
        FROM racked, range(4) t(s) GROUP BY n, doc_id, key, size, text_crc32, moves, region, rack
    )
    SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
           row_number() OVER (PARTITION BY shard ORDER BY CAST('0x' || substr(md5(key || ':' || text_crc32), 1, 6) AS INTEGER) % 4096,
                              doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
           CAST(CASE WHEN moves THEN 40 ELSE shard END AS INTEGER) AS grown_shard
    FROM placed"""

ORACLE: dict[str, str] = {
    "op10_hash_tree": _HASH_TREE_SQL,
    "op11_burst_trie": """
    WITH crc AS (
        SELECT list(list_reduce([i] || [0 for k in range(8)], lambda c, k:
            CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS entry
        FROM range(256) t(i)
    ), own AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS rank,
               md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id, strlen(coalesce(text, '')) AS size
        FROM conversations WHERE conv_id IS NOT NULL
    ), conv AS (
        SELECT conv_id, n, hex(encode(CAST(conv_id AS VARCHAR))) AS h, conv_id - conv_id % 5 AS base
        FROM (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id)
    ), branch AS (
        SELECT conv_id, n, base, xor(list_reduce([4294967295] || [CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT) for i in range(len(h) // 2)],
                   lambda a, b: xor(a >> 8, entry[xor(a, b) % 256 + 1])), 4294967295) % 9 AS shared
        FROM conv, crc
    ), taken AS (
        SELECT b.conv_id, b.base, b.shared, least(b.shared, coalesce(o.n, 0)) AS taken FROM branch b LEFT JOIN branch o ON o.conv_id = b.base
    ), turn AS (
        SELECT t.conv_id, o.rank AS depth, o.id, o.size FROM taken t JOIN own o ON o.conv_id = t.base AND o.rank <= t.shared
        UNION ALL
        SELECT t.conv_id, t.taken + o.rank - t.shared, o.id, o.size FROM taken t JOIN own o ON o.conv_id = t.conv_id AND o.rank > t.shared
    ), walk AS (
        SELECT conv_id, depth, size, md5(string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS name FROM turn
        UNION ALL SELECT conv_id, 0, 0, '' FROM taken
    ), linked AS (
        SELECT *, lag(name) OVER c AS above, lead(name) OVER c IS NULL AS ends FROM walk WINDOW c AS (PARTITION BY conv_id ORDER BY depth)
    ), node AS (
        SELECT depth, name, above, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM linked GROUP BY depth, name, above
    ), parent AS (
        SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM node c WHERE c.above = n.name AND c.depth = n.depth + 1) AS n_children
        FROM node n LEFT JOIN node p ON p.name = n.above AND p.depth = n.depth - 1
    ), subtree AS (
        SELECT w.depth, w.name, count(*) FILTER (p.n_children = 0) AS n_leaves, sum(p.saved) AS saved_tokens
        FROM parent p JOIN walk w ON w.conv_id = p.conv_id AND w.depth <= p.depth GROUP BY w.depth, w.name
    )
    SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves,
           CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
    FROM parent JOIN subtree USING (depth, name)""",
    "op13_setm_collocations": r"""
        WITH piece AS (
            SELECT row_number() OVER () AS piece, lang, p FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
                FROM documents)
        ), listed AS (
            SELECT piece, lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM piece
        ), word AS (
            SELECT piece, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM listed
        ), total AS (
            SELECT lang, count(*) AS n FROM word GROUP BY lang
        ), often AS (
            SELECT lang, w FROM word GROUP BY ALL HAVING count(*) >= 100
        ), run AS (
            SELECT piece, lang, pos, w, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4, lead(w, 4) OVER p AS w5
            FROM word WINDOW p AS (PARTITION BY piece ORDER BY pos)
        ), phrase AS (
            SELECT lang, ws, count(*) AS a FROM (
                SELECT lang, [w] AS ws FROM run SEMI JOIN often USING (lang, w)
                UNION ALL SELECT lang, [w, w2] FROM run SEMI JOIN often USING (lang, w) WHERE w2 IS NOT NULL
                UNION ALL SELECT lang, [w, w2, w3] FROM run SEMI JOIN often USING (lang, w) WHERE w3 IS NOT NULL
                UNION ALL SELECT lang, [w, w2, w3, w4] FROM run SEMI JOIN often USING (lang, w) WHERE w4 IS NOT NULL
                UNION ALL SELECT lang, [w, w2, w3, w4, w5] FROM run SEMI JOIN often USING (lang, w) WHERE w5 IS NOT NULL)
            GROUP BY ALL HAVING count(*) >= 100
        ), closed AS (
            SELECT lang, ws, a FROM phrase
            ANTI JOIN (
                SELECT DISTINCT lang, ws[i:i + k - 1] AS ws, a FROM phrase, range(2, 5) s(k), range(1, 5) t(i)
                WHERE k < len(ws) AND i + k - 1 <= len(ws)) inner_part USING (lang, ws, a)
            WHERE len(ws) > 1
        ), cut AS (
            SELECT c.lang, c.ws, c.a, b.a AS l, e.a AS r, n, k,
                   CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(b.a AS HUGEINT) * e.a) AS BIGINT) AS score
            FROM closed c JOIN total USING (lang), range(1, 5) t(k), phrase b, phrase e
            WHERE k < len(c.ws) AND b.lang = c.lang AND b.ws = c.ws[1:k] AND e.lang = c.lang AND e.ws = c.ws[k + 1:]
        ), lowest AS (
            SELECT lang, array_to_string(ws, ' ') AS phrase, a, n, unnest(min({'score': score, 'k': k, 'l': l, 'r': r})) FROM cut GROUP BY lang, ws, a, n
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
    "op7_voronoi_top_k": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), p AS (
            SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
                   CAST(list_sum([q.e[i] * d.e[i] for i in range(1, len(q.e) + 1)]) AS BIGINT) AS score
            FROM v q JOIN v d ON q.vec_id <> d.vec_id
            WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
}
