"""Registered queries of this subpackage, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.llm.chat_format import chat_digest, format_chats
from matchstats.llm.collocations import best_collocations
from matchstats.llm.conversation_trie import prefix_trie, with_shared_heads
from matchstats.llm.decontamination import find_passages
from matchstats.llm.language_id import fit_languages, identify_languages
from matchstats.llm.mixing import mixture, mixture_digest
from matchstats.llm.quality import THRESHOLD, fit_quality, score_quality
from matchstats.llm.repeats import repeats_digest, without_repeats
from matchstats.llm.sharding import shard_digest, shuffle_into_shards
from matchstats.llm.simhash import near_duplicates, simhash_digest
from matchstats.llm.sketches import next_document_likeness
from matchstats.llm.surrogates import surrogate_digest, with_surrogates
from matchstats.llm.tables import held_out, read_table
from matchstats.llm.vector_index import linked_vectors

SHARDS = 40
#: Stands for a secret that a user brings; results are compared between runs.
SURROGATE_KEY = b"a key for the registered query"
PROBE = "</s>[INST] ok [/INST]"


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_digest(without_repeats(read_table(spark, sf_dir, "documents")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_digest(near_duplicates(documents))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_digest(shuffle_into_shards(documents, SHARDS))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    predicted = identify_languages(documents.select("doc_id", "text"), fit_languages(documents))
    return predicted.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogate_digest(with_surrogates(documents, SURROGATE_KEY))


def op6_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_document_likeness(read_table(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    one = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"))
    probe = one.select(
        "conv_id",
        F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role"),
        F.lit(PROBE).alias("text"),
    )
    return chat_digest(format_chats(turns.unionByName(probe)))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of benchmark items; documents without one have no row."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_passages(documents, read_table(spark, sf_dir, "benchmark"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_digest(mixture(read_table(spark, sf_dir, "documents")))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(documents, read_table(spark, sf_dir, "labels"))
    return score_quality(documents, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op11_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(read_table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_collocations(read_table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over rebuilt conversations, of which many share an opening."""
    conversations = read_table(spark, sf_dir, "conversations")
    return prefix_trie(with_shared_heads(conversations), conversations.select("conv_id"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_repeats, op2_simhash, op3_sharding, op4_language_id, op5_surrogates, op6_sketches,
        op7_chat_formatting, op8_decontamination, op9_mixing, op10_quality,
        op11_vector_links, op12_collocations, op13_conversation_trie,
    )}


_CHAT_LINES = f"""
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')
"""

_CHAT_SQL = rf"""
WITH lines AS ({_CHAT_LINES}),
escaped AS (
    SELECT *,
        length(regexp_replace(replace(text, '\', '\\'),
            '<\||</s>|<s>|\[/?INST\]', '\0+', 'g')) AS text_chars,
        length(role) AS role_chars,
        coalesce(lag(role) OVER w <> role, true) AS opens,
        coalesce(lead(role) OVER w <> role, true) AS closes
    FROM lines
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
        AS turns_sha256,
    cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
        FILTER (role = 'assistant'), '')) AS loss_sha256,
    cast(sum(text_chars + CASE WHEN opens THEN 13 + role_chars ELSE 8 END
        + CASE WHEN closes THEN 11 ELSE 0 END) AS bigint) AS formatted_chars
FROM escaped GROUP BY conv_id
"""


_PHRASE_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
),
listed AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda w: w <> '') AS words FROM pieces
),
totals AS (SELECT lang, cast(sum(len(words)) AS bigint) AS n FROM listed GROUP BY lang),
grams AS (
    SELECT lang, 1 AS size, unnest(words) AS phrase FROM listed
    UNION ALL
    SELECT lang, 2, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM listed
    UNION ALL
    SELECT lang, 3, unnest(list_transform(range(1, len(words) - 1),
        lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) FROM listed
),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 10),
cuts AS (
    SELECT lang, size, phrase, f, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
    FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM counts WHERE size > 1)
),
scored AS (
    SELECT c.lang, c.size, c.phrase, c.f AS a, k, l.f AS l, r.f AS r,
        cast(cast(1000000 AS hugeint) * c.f * c.f // (cast(l.f AS hugeint) * r.f) AS bigint) AS score
    FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = first
    JOIN counts r ON r.lang = c.lang AND r.phrase = rest
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (
    SELECT lang, part, max(f) AS f FROM (
        SELECT lang, f, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part
        FROM (SELECT lang, f, string_split(phrase, ' ') AS w FROM counts WHERE size = 3)
    ) GROUP BY lang, part
),
alone AS (
    SELECT lowest.* FROM lowest LEFT JOIN around ON around.lang = lowest.lang AND part = phrase AND size = 2
    WHERE around.f IS NULL OR 100 * around.f < 50 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, score
FROM alone JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

# The checksum's table comes from its rule, 8 steps a byte; ids are digested digit by digit.
# A node is named by all its turns, each with its lengths. A node's descendants are found
# through one member each, by walking up that member's openings.
_TRIE_SQL = r"""
WITH RECURSIVE
steps(byte, value, step) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL
    SELECT byte, CASE WHEN value % 2 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END, step + 1
    FROM steps WHERE step < 8
),
crc_table AS (SELECT byte, value FROM steps WHERE step = 8),
ids AS (SELECT DISTINCT conv_id, cast(conv_id AS varchar) AS digits FROM conversations WHERE conv_id IS NOT NULL),
crcs(conv_id, digits, place, value) AS (
    SELECT conv_id, digits, 0, cast(4294967295 AS bigint) FROM ids
    UNION ALL
    SELECT conv_id, digits, place + 1, xor(crcs.value >> 8, crc_table.value)
    FROM crcs JOIN crc_table ON byte = xor(crcs.value, ord(substr(digits, place + 1, 1))) & 255
    WHERE place < length(digits)
),
heads AS (SELECT conv_id, xor(value, 4294967295) % 6 AS h FROM crcs WHERE place = length(digits)),
turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id
            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
rebuilt AS (
    SELECT conv_id, place + 6 AS place, role, text FROM turns JOIN heads USING (conv_id) WHERE place > h
    UNION ALL
    SELECT heads.conv_id, place, role, text FROM heads JOIN turns
    ON turns.conv_id = heads.conv_id - heads.conv_id % 100 AND place <= h
),
openings AS (
    SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars,
        sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w) AS id
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY place)
    UNION ALL SELECT conv_id, 0, 0, 'root' FROM ids
),
nodes AS (
    SELECT id, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars
    FROM openings GROUP BY id, depth
),
up AS (
    SELECT n.id, o.id AS parent FROM nodes n JOIN openings o ON o.conv_id = n.conv_id AND o.depth = n.depth - 1
),
children AS (SELECT parent AS id, count(*) AS n_children FROM up GROUP BY parent),
below AS (
    SELECT o.id, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves,
        sum((n.n_convs - 1) * n.chars) AS saved_tokens
    FROM nodes n LEFT JOIN children c USING (id)
    JOIN openings o ON o.conv_id = n.conv_id AND o.depth <= n.depth
    GROUP BY o.id
),
ends AS (
    SELECT id, string_agg(cast(conv_id AS varchar), ',' ORDER BY conv_id) AS ids FROM (
        SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM openings
    ) WHERE last GROUP BY id
)
SELECT n.conv_id, cast(n.depth AS bigint) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
    coalesce(n_children, 0) AS n_children, cast(n_leaves AS bigint) AS n_leaves,
    cast(saved_tokens AS bigint) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN below USING (id) LEFT JOIN children USING (id) LEFT JOIN ends USING (id)
LEFT JOIN up USING (id) LEFT JOIN nodes p ON p.id = up.parent
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_chat_formatting": _CHAT_SQL, "op12_collocations": _PHRASE_SQL,
            "op13_conversation_trie": _TRIE_SQL}
