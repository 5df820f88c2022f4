"""The registered query of each operator, over its whole table with production parameters, and SQL beside it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.llm import (
    bond_negatives,
    bpe,
    license_scan,
    ngram_join,
    permutation_index,
    preference_chat,
    prefix_trie,
    quality_rules,
    radix_dedup,
    secret_scan,
    source_mixing,
    substring_dedup,
    token_counts,
)
from starmill.llm.common import table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document: five-word shingles, similarity of 0.8 or more."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, through a cache that is empty at first."""
    cache = token_counts.TokenCountCache(spark)
    return token_counts.token_counts(table(spark, sf_dir, "documents"), PIECES, cache)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal normalised texts of every document, and the row that stays."""
    return radix_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior, rate and copies of every document for the default target weights."""
    return source_mixing.domain_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to."""
    return bpe.encode(table(spark, sf_dir, "documents"), WORDS, ("n_tokens", "ids_sha256", "decoded_sha256"))


def op6_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with its last answer swapped: prompt and masked completions, turn by turn."""
    pairs = preference_chat.swapped_answers(table(spark, sf_dir, "conversations"))
    return preference_chat.preference_segments(*pairs)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence paragraph of every document, with its family."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of at least 50 words of every document that other documents repeat, nearly or exactly."""
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document, its value as a digest, with the forest's verdict."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    digest = F.sha2("value", 256).alias("value_sha256")
    return found.select("doc_id", "place", digest, F.length("value").alias("length"), "probability", "is_secret")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain counts, score and verdict of every document."""
    return quality_rules.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hardest negatives of every fiftieth vector's positives, by whole-number components."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = bond_negatives.participants(table(spark, sf_dir, "embeddings"), moved)
    return bond_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op12_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found of every twentieth vector."""
    index = permutation_index.PermutationIndex(table(spark, sf_dir, "embeddings"))
    return index.search(F.col("vec_id") % 20 == 0, 20)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations, rebuilt to share their starts."""
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.shared_starts(turns))


QUERIES = (
    op1_ngram_jaccard_join,
    op2_token_counts,
    op3_exact_dedup,
    op4_mix_sources,
    op5_bpe,
    op6_preference_chat,
    op7_license_scan,
    op8_substring_dedup,
    op9_secret_scan,
    op10_quality_rules,
    op11_hard_negatives,
    op12_permutation_index,
    op13_prefix_trie,
)

ORACLES = {
    "op13_prefix_trie": r"""
        WITH RECURSIVE
        crc_bits AS (
            SELECT b AS code, b AS value, 0 AS step FROM range(256) t(b)
            UNION ALL
            SELECT code, CASE WHEN value % 2 = 1 THEN xor(value // 2, 3988292384) ELSE value // 2 END, step + 1
            FROM crc_bits WHERE step < 8
        ),
        crc_table AS (SELECT list(value ORDER BY code) AS t FROM crc_bits WHERE step = 8),
        turns AS (
            SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        whole AS (SELECT conv_id, list(said ORDER BY place) AS s FROM turns GROUP BY conv_id),
        taken AS (
            SELECT w.conv_id, w.s, coalesce(b.s, []) AS base,
                   xor(4294967295, list_reduce(
                       list_prepend(4294967295, list_transform(range(1, len(CAST(w.conv_id AS VARCHAR)) + 1),
                                                               lambda i: ord(CAST(w.conv_id AS VARCHAR)[i]))),
                       lambda crc, x: xor(crc // 256, t[xor(crc % 256, x) + 1])
                   )) % 6 AS h
            FROM whole w CROSS JOIN crc_table LEFT JOIN whole b ON b.conv_id = w.conv_id - w.conv_id % 100
        ),
        rebuilt AS (SELECT conv_id, list_concat(base[1:h], s[h + 1:]) AS s FROM taken),
        paths AS (SELECT conv_id, len(s) AS n, unnest(range(len(s) + 1)) AS depth, s FROM rebuilt),
        members AS (SELECT conv_id, depth, n = depth AS ended, s[1:depth] AS start FROM paths),
        groups AS (
            SELECT depth, start, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
            FROM members GROUP BY depth, start
        ),
        nodes AS (
            SELECT g.*, p.conv_id AS parent_conv_id,
                   (g.n_convs - 1) * CASE WHEN g.depth = 0 THEN 0 ELSE length(g.start[-1].text) END AS cost
            FROM groups g LEFT JOIN groups p ON p.depth = g.depth - 1 AND p.start = g.start[1:g.depth - 1]
        ),
        children AS (
            SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
        ),
        known AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c USING (conv_id, depth)),
        -- a node is below those that its least member goes through
        pairs AS (
            SELECT up.conv_id, up.depth, d.cost, d.n_children FROM known d
            JOIN members m ON m.conv_id = d.conv_id AND m.depth <= d.depth
            JOIN groups up ON up.depth = m.depth AND up.start = m.start
        ),
        sums AS (
            SELECT conv_id, depth, CAST(sum(cost) AS BIGINT) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
            FROM pairs GROUP BY ALL
        )
        SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, k.parent_conv_id, k.n_convs, k.n_children, s.n_leaves,
               s.saved_tokens, k.ends_sha256
        FROM known k JOIN sums s USING (conv_id, depth)
    """,
    "op11_hard_negatives": r"""
        WITH kept AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
            FROM kept a JOIN kept b ON a.vec_id <> b.vec_id
            WHERE a.vec_id % 50 = 0
        ),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY rank <= 3
    """,
    "op6_preference_chat": r"""
        WITH plain AS (
            SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS role,
                   replace(coalesce(text, ''), '<|', '< |') AS text
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        turns AS (
            SELECT conv_id AS id, role, text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS place
            FROM plain
        ),
        answers AS (
            SELECT id, place, text FROM turns WHERE role = 'assistant'
            QUALIFY place = max(place) OVER (PARTITION BY id)
        ),
        rejected AS (
            SELECT t.id, t.role, t.place, CASE WHEN t.place = a.place THEN b.text ELSE t.text END AS text
            FROM turns t LEFT JOIN answers a ON a.id = t.id LEFT JOIN answers b ON b.id = xor(t.id, 1)
            WHERE a.place IS NULL OR t.place <> a.place OR b.text IS NOT NULL
        ),
        prefix AS (
            SELECT t.id, min(t.place) FILTER (WHERE r.id IS NULL) AS first
            FROM turns t LEFT JOIN rejected r ON r.id = t.id AND r.place = t.place AND r.role = t.role AND r.text = t.text
            GROUP BY t.id
        ),
        parts AS (
            SELECT t.*, CASE WHEN first IS NULL OR place < first THEN 'prompt' ELSE 'chosen' END AS part
            FROM turns t JOIN prefix USING (id)
            UNION ALL BY NAME
            SELECT r.*, 'rejected' AS part FROM rejected r JOIN prefix USING (id) WHERE place >= first
        ),
        rendered AS (
            SELECT *, '<|' || role || '|>' || chr(10) AS head, part <> 'prompt' AND role = 'assistant' AS in_loss
            FROM parts
        ),
        segments AS (SELECT *, head || text || '<|end|>' || chr(10) AS segment FROM rendered),
        placed AS (
            SELECT *, CAST(sum(length(segment)) OVER (PARTITION BY id, part ORDER BY place) AS BIGINT) AS segment_end
            FROM segments
        )
        SELECT id AS pair_id, part, CAST(place AS INTEGER) AS place, role, segment, in_loss,
               segment_end - length(segment) AS segment_begin, segment_end,
               CASE WHEN in_loss THEN segment_end - length(segment) + length(head) END AS loss_begin
        FROM placed
    """,
    "op1_ngram_jaccard_join": r"""
        WITH RECURSIVE
        words AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ),
        sets AS (
            SELECT doc_id, list_sort(list_distinct(
                CASE WHEN len(w) = 0 THEN []
                     WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                     ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END
            )) AS s FROM words
        ),
        tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS n
            FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id
            GROUP BY ALL
        ),
        links AS (SELECT a, b, NOT (n = na AND n = nb) AS other FROM common WHERE 5 * n >= 4 * (na + nb - n)),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM sets
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
        ),
        classes AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a),
        other_sets AS (
            SELECT l.a, count(DISTINCT s.s) AS n FROM links l JOIN sets s ON s.doc_id = l.b WHERE l.other GROUP BY l.a
        )
        SELECT c.doc_id, c.class_id,
               (SELECT count(*) FROM links l WHERE l.a = c.doc_id) AS n_links,
               coalesce(o.n, 0) AS n_text_links
        FROM classes c LEFT JOIN other_sets o ON o.a = c.doc_id
    """,
    "op3_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY t)
    """,
}


def queries() -> dict:
    return {q.__name__: q for q in QUERIES}
