"""The registered queries of this subpackage over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.llm import (
    chat,
    decontaminate,
    licences,
    linededup,
    merkle,
    neighbours,
    packing,
    simhash,
    suffixes,
    tokenfiles,
    toxicity,
    whitening,
    wrappers,
)
from tracklens.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(table) -> DataFrame``, where ``table(name)`` opens a whole table."""

    def register(build):
        def opened(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return build(lambda table: spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))

        QUERIES[name] = opened
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query(
    "op4_line_dedup",
    """
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents
    ), keyed AS (
        SELECT doc_id, pos, line,
               translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM lines
    ), repeated AS (
        SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3
    ), judged AS (
        SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id <> r.last, FALSE) AS gone
        FROM keyed k LEFT JOIN repeated r ON k.key = r.key
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
    """,
)
def op4(table) -> DataFrame:
    kept = linededup.drop_repeated_lines(table("documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op5_simhash")
def op5(table) -> DataFrame:
    return simhash.near_duplicates(table("documents"))


@query("op3_packing")
def op3(table) -> DataFrame:
    return packing.digest(packing.pack(table("documents")))


@query(
    "op8_decontamination",
    """
    WITH words AS (
        SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM benchmark
    ), doc_words AS (
        SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}]+') AS w FROM documents
    ), item_shingles AS (
        SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
    ), doc_shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc_words WHERE len(w) > 0)
    ), sizes AS (SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id)
    SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item,
           count(*)::DOUBLE / any_value(n_item) AS containment
    FROM item_shingles JOIN sizes USING (item_id) JOIN doc_shingles USING (s)
    GROUP BY doc_id, item_id HAVING count(*) * 5 >= any_value(n_item) * 4
    """,
)
def op8(table) -> DataFrame:
    return decontaminate.contained_items(table("documents"), table("benchmark"))


@query("op10_toxicity")
def op10(table) -> DataFrame:
    docs = table("documents")
    scored = toxicity.score(docs, toxicity.train(docs, table("labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.col("worst").alias("worst_sentence"),
    )


@query(
    "op2_chat_format",
    """
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), marked AS (
        SELECT *, coalesce(role <> lag(role) OVER w, TRUE) AS opens,
               length(text) + length(text) - length(translate(text, '~[<]', '')) AS size,
               length(role) + length(role) - length(translate(role, '~[<]', '')) AS role_size
        FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
               AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
               FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(size + CASE WHEN opens THEN 9 + role_size ELSE 3 END)::BIGINT AS formatted_chars
    FROM marked GROUP BY conv_id
    """,
)
def op2(table) -> DataFrame:
    return chat.digests(chat.format_chats(chat.with_probe(table("conversations"))))


@query("op9_html_extraction")
def op9(table) -> DataFrame:
    return wrappers.extract(table("pages"))


@query("op6_suffix_dedup")
def op6(table) -> DataFrame:
    cut = suffixes.remove_repeats(table("documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op1_nearest")
def op1(table) -> DataFrame:
    return neighbours.nearest(table("embeddings"), F.col("vec_id") % 50 == 0)


@query("op7_licences")
def op7(table) -> DataFrame:
    return licences.scan(table("documents"))


@query("op11_whitening")
def op11(table) -> DataFrame:
    whitened = whitening.whiten(table("embeddings"))
    return whitened.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))  # NULL past the range of a long


@query(
    "op12_merkle",
    """
    WITH RECURSIVE fields AS (
        SELECT doc_id, lang, n_chars,
               coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                   || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') AS head,
               coalesce(strlen(text) || ':' || text, '-') AS tail,
               list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''),
                                                                   lambda c: ord(c)::UBIGINT),
                   lambda crc, byte: list_reduce(
                       [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
                       lambda x, _: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))) AS crc
        FROM documents
    ), hashed AS (
        SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
               CASE WHEN xor(crc, 4294967295::UBIGINT) % 7 = 0 AND n_chars IS NOT NULL
                    THEN sha256(head || strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) || tail) END AS tampered
        FROM fields
    ), leaves AS (
        SELECT *, coalesce('v' || lang, '') AS k,
               row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
        FROM hashed
    ), levels AS (
        SELECT k, pos, leaf AS h, count(*) OVER (PARTITION BY k) AS n, 0 AS level FROM leaves
        UNION ALL
        SELECT k, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2, level + 1
        FROM levels WHERE n > 1 GROUP BY k, pos // 2, n, level
    ), subroots AS (
        SELECT k, h, row_number() OVER (ORDER BY k) - 1 AS place FROM levels WHERE n = 1
    ), tops AS (
        SELECT place AS pos, h, count(*) OVER () AS n, 0 AS level FROM subroots
        UNION ALL
        SELECT pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2, level + 1
        FROM tops WHERE n > 1 GROUP BY pos // 2, n, level
    ), steps AS (
        SELECT l.k, l.pos, own.level AS step, CASE WHEN own.pos % 2 = 1 THEN near.h END AS a,
               CASE WHEN own.pos % 2 = 0 THEN near.h END AS b
        FROM leaves l JOIN levels own ON own.k = l.k AND own.pos = l.pos >> own.level AND own.n > 1
        LEFT JOIN levels near ON near.k = own.k AND near.level = own.level AND near.pos = xor(own.pos, 1)
        UNION ALL
        SELECT l.k, l.pos, 1000 + own.level, CASE WHEN own.pos % 2 = 1 THEN near.h END,
               CASE WHEN own.pos % 2 = 0 THEN near.h END
        FROM leaves l JOIN subroots s ON s.k = l.k JOIN tops own ON own.pos = s.place >> own.level AND own.n > 1
        LEFT JOIN tops near ON near.level = own.level AND near.pos = xor(own.pos, 1)
    ), paths AS (
        SELECT k, pos, sha256(string_agg(coalesce(a, '') || coalesce(b, ''), '' ORDER BY step)) AS proof_sha256,
               list(coalesce(a, '') ORDER BY step) AS lefts, list(coalesce(b, '') ORDER BY step) AS rights
        FROM steps GROUP BY k, pos
    ), folds AS (
        SELECT k, pos, coalesce(tampered, leaf) AS h, 0 AS done FROM leaves
        UNION ALL
        SELECT f.k, f.pos, sha256(p.lefts[done + 1] || f.h || p.rights[done + 1]), done + 1
        FROM folds f JOIN paths p USING (k, pos) WHERE done < len(p.lefts)
    )
    SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
           f.h AS folded_root, f.h = r.h AS verified
    FROM leaves l JOIN subroots s USING (k) LEFT JOIN paths p USING (k, pos)
    JOIN folds f ON f.k = l.k AND f.pos = l.pos AND f.done = coalesce(len(p.lefts), 0)
    JOIN tops r ON r.n = 1
    """,
)
def op12(table) -> DataFrame:
    return merkle.document_manifest(table("documents"))


@query("op13_token_files")
def op13(table) -> DataFrame:
    return tokenfiles.round_trip(table("documents"))
