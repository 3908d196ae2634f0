"""The registered queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catlink.llm.chat_template import conversation_digests

    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    return conversation_digests(table.unionByName(extra))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catlink.llm.simhash import simhash_components

    out = simhash_components(_table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op3_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catlink.llm.weak_labels import classify

    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catlink.llm.license_scan import license_scan

    return license_scan(_table(spark, sf_dir, "documents"))


#: Passages from this many bytes on are told apart by op5's last columns: under 50 words of usual length.
PASSAGE_BYTES = 240


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rules, both on the input: strings of 400 bytes go everywhere; of repeated passages, the later ones (``n_later``, ``text_once``)."""
    from catlink.llm.suffix_dedup import suffix_dedup

    out = suffix_dedup(_table(spark, sf_dir, "documents"), min_bytes=400, also=(PASSAGE_BYTES, "first", True))
    # what is left, as text: a removal may end inside a character, whose other bytes show as U+FFFD there
    left, once = F.make_valid_utf8(F.col("kept").cast("string")), F.col("kept1").cast("string")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), left.alias("text"), F.col("n_removed1").alias("n_later"), once.alias("text_once"))


#: Tokenizer versions of the rollup query, as regular expressions of their tokens.
WORDS_1 = r"[^\x20\x09-\x0D]+"
PIECES_2 = r"\p{L}+|\p{N}|[^\x20\x09-\x0D\p{L}\p{N}]+"


def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads estimates, revises them to counts, adds a tokenizer version, deletes later copies, repeats a batch.

    Of rows with one text the smallest id stays; without any id, none of them is a later copy.
    """
    from catlink.functions.runtime import checkpoint
    from catlink.llm.token_rollup import RollupStore, changes, shared_folder

    text = F.coalesce(F.col("text"), F.lit(""))
    counted = checkpoint(
        _table(spark, sf_dir, "documents").select(
            "doc_id", "source", "lang", F.ceil(F.coalesce("n_chars", F.lit(0)) / 4).alias("estimate"),
            F.regexp_count(text, F.lit(WORDS_1)).cast("long").alias("words"), F.regexp_count(text, F.lit(PIECES_2)).cast("long").alias("pieces"),
            F.sha2(text, 256).alias("digest"),
        )
    )
    first = counted.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    copies = counted.join(first.withColumnsRenamed({"digest": "_g", "doc_id": "_first"}), (F.col("digest") == F.col("_g")) & F.col("doc_id").eqNullSafe(F.col("_first")), "left_anti")
    store = RollupStore(spark, shared_folder(spark, "rollup"))
    store.commit("load", changes(counted, "words@1", 1, "estimate"))
    store.commit("recount", changes(counted, "words@1", 0, "words", was="estimate"))
    store.commit("pieces", changes(counted, "pieces@2", 1, "pieces"))
    gone = changes(copies, "words@1", -1, "words").unionByName(changes(copies, "pieces@2", -1, "pieces"))
    for _ in range(2):  # the second commit of the id changes nothing
        store.commit("copies", gone)
    store.compact()
    return store.totals()


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catlink.llm.decontaminate import contaminated

    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), shingle=5, similarity=0.8)


def op8_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from catlink.llm.cover_tree import cosine_links

    return cosine_links(_table(spark, sf_dir, "embeddings"), cosine=0.98)


def op9_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from catlink.llm.lattice_lm import lattice_score

    return lattice_score(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), held_out=2)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from catlink.llm.bpe import bpe_encode

    out = bpe_encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f) and name[2].isdigit()}


#: Conversations as the formatter sees them; backslash, number sign, less-than and colon take one more character.
_OP1 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(regexp_replace(role, '[\\#<:]', 'xx', 'g')) + length(regexp_replace(text, '[\\#<:]', 'xx', 'g')) + 15)::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""

_OP6 = rf"""
WITH d AS (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '{WORDS_1}')) AS words, len(regexp_extract_all(coalesce(text, ''), '{PIECES_2}')) AS pieces,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents
), kept AS (SELECT * FROM d WHERE doc_id IS NOT DISTINCT FROM first)
SELECT source, lang, 'words@1' AS tokenizer, count(*)::BIGINT AS documents, sum(words)::BIGINT AS tokens FROM kept GROUP BY source, lang
UNION ALL SELECT source, lang, 'pieces@2', count(*)::BIGINT, sum(pieces)::BIGINT FROM kept GROUP BY source, lang
"""

def _op4() -> str:
    """Every shingle of every document against every template, window by window."""
    from catlink.llm.license_scan import SEPARATORS, TEMPLATES

    split = f"list_filter(string_split(regexp_replace(lower(text), '{SEPARATORS}', ' ', 'g'), ' '), lambda w: w <> '')"
    quoted = lambda x: x.replace("'", "''")
    values = ", ".join(f"({i}, '{k.split('/')[0]}', '{quoted(t)}')" for i, (k, t) in enumerate(sorted(TEMPLATES.items())))
    return rf"""
WITH t AS (SELECT template, license, {split} AS w FROM (VALUES {values}) AS v(template, license, text)),
k AS (SELECT DISTINCT template, license, array_to_string(w[i:i + 4], ' ') AS shingle FROM (SELECT template, license, w, unnest(range(1, len(w) - 3)) AS i FROM t)),
n AS (SELECT template, count(*) AS s FROM k GROUP BY template),
d AS (SELECT doc_id, {split} AS w FROM documents),
p AS (SELECT doc_id, unnest(range(0, len(w) - 4)) AS pos, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS shingle FROM d),
m AS (SELECT doc_id, template, license, s, shingle, unnest([pos // s, pos // s - 1]) AS win FROM p JOIN k USING (shingle) JOIN n USING (template)),
c AS (SELECT doc_id, license, win * any_value(s) AS first_word, count(DISTINCT shingle) / any_value(s) AS containment FROM m WHERE win >= 0 GROUP BY doc_id, template, license, win)
SELECT doc_id, license, max(containment)::DOUBLE AS containment, arg_min(first_word, (-containment, first_word))::BIGINT AS first_word
FROM c WHERE containment >= 0.8 GROUP BY doc_id, license
"""


_OP8 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), l AS (
  SELECT a.vec_id AS src, b.vec_id AS dst FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), r AS (
  SELECT vec_id AS src, vec_id AS dst FROM v UNION SELECT r.src, l.dst FROM r JOIN l ON r.dst = l.src
), c AS (SELECT src AS vec_id, min(dst)::BIGINT AS component_id FROM r GROUP BY src)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.src = c.vec_id)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM c
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_format": _OP1, "op4_license_scan": _op4(), "op6_token_rollup": _OP6, "op8_cover_tree": _OP8}
