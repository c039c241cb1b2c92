"""The registered ``opN_<name>`` queries over the driver's tables, and their DuckDB SQL.

Each query applies one operator with production parameters to its whole table. SQL is given
where SQL can express the result; the others are tested in ``tests/llm`` against brute force,
exact round trips or held-out figures.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontaminate, fill_middle, html_text, jaccard_join, merkle, piece_codec, pitman_yor, projection_forest, substring_dedup, token_files, topk, toxicity, warc
from quayside.llm.shipping import ship
from quayside.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


@query(
    "op1_substring_dedup",
    r"""
    WITH words AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), windows AS (
      SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS key
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)
    ), firsts AS (
      SELECT key, min(doc_id) AS low FROM windows GROUP BY key
    ), covered AS (
      SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
      FROM windows JOIN firsts USING (key) WHERE doc_id > low
    ), removed AS (
      SELECT doc_id, list(i) AS gone, count(*) AS n FROM covered GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
             list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]), ' ') END) AS kept_sha256
    FROM words LEFT JOIN removed USING (doc_id)
    """,
)
def op1(spark, table):
    return substring_dedup.digest(table("documents"))


@query("op5_jaccard_join")
def op5(spark, table):
    return jaccard_join.similar_components(table("documents")).withColumnRenamed("id", "doc_id")


@query("op8_toxicity")
def op8(spark, table):
    return toxicity.digest(table("documents"), table("labels"))


@query("op6_sentencepiece")
def op6(spark, table):
    return piece_codec.digest(table("documents"), piece_codec.default_model())


@query(
    "op7_decontaminate",
    r"""
    WITH doc AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    ), item AS (
      SELECT item_id, w, least(13, len(w)) AS n FROM (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
      WHERE len(w) > 0
    ), record AS (
      SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS key
      FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM item)
    ), place AS (
      SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS key
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM item) WHERE len(w) >= n)
    ), hit AS (
      SELECT doc_id, item_id, i, n FROM place JOIN record USING (n, key)
    ), covered AS (
      SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
    ), found AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
    """,
)
def op7(spark, table):
    return decontaminate.digest(table("documents"), table("benchmark"))


@query("op9_token_files")
def op9(spark, table):
    return token_files.digest(table("documents"), scratch_path(spark, "op9_ids"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query(
    "op2_topk",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
    )
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
    """,
)
def op2(spark, table):
    return topk.top_k(table("embeddings"), F.col("id") % 50 == 0)


@query(
    "op4_warc",
    """
    WITH p AS (
      SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha256(coalesce(html, '')) AS digest FROM pages
    ), marked AS (
      SELECT *, min(page_id) OVER (PARTITION BY digest) AS low FROM p
    )
    SELECT page_id, n AS payload_bytes, digest AS payload_digest,
           CASE WHEN n >= 100 AND page_id > low THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 100 AND page_id > low THEN low END AS refers_to
    FROM marked
    """,
)
def op4(spark, table):
    return warc.digest(table("pages"), scratch_path(spark, "op4_warc"))


@query("op10_html_text")
def op10(spark, table):
    return html_text.extract(table("pages"))


@query("op3_pitman_yor")
def op3(spark, table):
    return pitman_yor.digest(table("documents"))


@query(
    "op11_merkle",
    """
    WITH RECURSIVE leaves AS (
      SELECT coalesce('=' || source, '') AS tree, doc_id,
             sha256(list_aggregate([coalesce(octet_length(encode(x)) || ':' || x, '-') FOR x IN [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text]], 'string_agg', '')) AS leaf,
             sha256(list_aggregate([coalesce(octet_length(encode(x)) || ':' || x, '-') FOR x IN [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')]], 'string_agg', '')) AS other
      FROM documents
    ), placed AS (
      SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n, 
             xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
               lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
               4294967295) % 5 = 0 AS changed
      FROM leaves WINDOW w AS (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf)
    ), nodes AS (
      SELECT tree, 0 AS level, pos, n, leaf AS h FROM placed
      UNION ALL
      SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY tree, level, n, pos // 16
    ), tops AS (
      SELECT 0 AS level, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n, h FROM nodes WHERE n = 1
      UNION ALL
      SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, n, pos // 16
    ), subroots AS (
      SELECT tree, h AS subroot, level AS height, row_number() OVER (ORDER BY encode(tree)) - 1 AS place FROM nodes WHERE n = 1
    ), runs AS (
      SELECT tree, level, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY ALL
    ), top_runs AS (
      SELECT level, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM tops WHERE n > 1 GROUP BY ALL
    ), fold AS (
      SELECT row_number() OVER () AS k, tree, doc_id, leaf, 0 AS level, pos, CASE WHEN changed THEN other ELSE leaf END AS h, '' AS proof, height, place
      FROM placed JOIN subroots USING (tree)
      UNION ALL
      SELECT k, f.tree, doc_id, leaf, f.level + 1, pos // 16,
             sha256(array_to_string(list_slice(hs, 1, pos % 16), '') || h || array_to_string(list_slice(hs, pos % 16 + 2, len(hs)), '')),
             proof || array_to_string(list_slice(hs, 1, pos % 16), '') || array_to_string(list_slice(hs, pos % 16 + 2, len(hs)), ''), height, place
      FROM fold f JOIN runs r ON f.tree = r.tree AND f.level = r.level AND f.pos // 16 = r.run
    ), top_fold AS (
      SELECT k, tree, doc_id, leaf, 0 AS level, place AS pos, h, proof FROM fold WHERE level = height
      UNION ALL
      SELECT k, tree, doc_id, leaf, f.level + 1, pos // 16,
             sha256(array_to_string(list_slice(hs, 1, pos % 16), '') || h || array_to_string(list_slice(hs, pos % 16 + 2, len(hs)), '')),
             proof || array_to_string(list_slice(hs, 1, pos % 16), '') || array_to_string(list_slice(hs, pos % 16 + 2, len(hs)), '')
      FROM top_fold f JOIN top_runs r ON f.level = r.level AND f.pos // 16 = r.run
    )
    SELECT f.doc_id, f.leaf, s.subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
    FROM top_fold f JOIN subroots s USING (tree) JOIN tops t ON t.n = 1 AND f.level = t.level
    """,
)
def op11(spark, table):
    return merkle.digest(table("documents"))


@query(
    "op12_fill_middle",
    r"""
    WITH cut AS (
      SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
             regexp_extract_all(coalesce(text, ''), '[ 	-
]*[^ 	-
]+|[ 	-
]+') AS w
      FROM documents
    ), drawn AS (
      SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (len(w) + 1) AS h1, CAST('0x' || h[9:16] AS BIGINT) % (len(w) + 1) AS h2,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
                  WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
      FROM cut
    ), parts AS (
      SELECT *, array_to_string(list_slice(w, 1, least(h1, h2)), '') AS prefix, array_to_string(list_slice(w, least(h1, h2) + 1, greatest(h1, h2)), '') AS middle,
             array_to_string(list_slice(w, greatest(h1, h2) + 1, len(w)), '') AS suffix
      FROM drawn
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n, form,
           CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parts
    """,
)
def op12(spark, table):
    return fill_middle.digest(table("documents"))


@query(
    "op13_embedding_dedup",
    """
    WITH RECURSIVE v AS (
      SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
      WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0
    ), unit AS (
      SELECT vec_id, list_transform(x, lambda e: e / sqrt(list_dot_product(x, x))) AS u FROM v
    ), link AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND list_dot_product(a.u, b.u) >= 0.9
    ), reach AS (
      SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
    ), counted AS (
      SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a
    ), lows AS (
      SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
    )
    SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(e.vec_id = component_id, false) AS kept
    FROM embeddings e LEFT JOIN counted USING (vec_id) LEFT JOIN lows USING (vec_id)
    """,
)
def op13(spark, table):
    return projection_forest.near_duplicates(table("embeddings"))
