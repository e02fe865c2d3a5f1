"""The operators as queries over the test tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from signalwatch.llm import (
    bpe, dual_tree, line_dedup, minhash, mixing, secret_scan, simhash, subspace_join, token_files, toxicity, tree_bpe,
    turn_repair, url_templates,
)
from signalwatch.llm.common import table


def op1_url_templates(spark, sf_dir):
    return url_templates.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


def op2_bpe(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, path, keep=["doc_id"]).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_scores(docs, model, keep=["doc_id"]).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_line_dedup(spark, sf_dir):
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_simhash(spark, sf_dir):
    return simhash.fingerprint_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_subspace_join(spark, sf_dir):
    return subspace_join.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op8_mixing(spark, sf_dir):
    plan = mixing.plan_mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    # rows that agree in doc_id, source and size each give a row
    return plan.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op9_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    root, shards, keys = token_files.write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_files.read_ids(root, shards, keys, digest=True)


def op10_secret_scan(spark, sf_dir):
    rows = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x.rank < len(secret_scan.BASE))
    return rows.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secret_scan.as_text(base), 256).alias("base_sha256"),
        secret_scan.as_text(F.col("spans")).alias("spans"),
    )


def op11_turn_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turn_repair.repaired(rows, turn_repair.damage(rows))


def op12_dual_tree(spark, sf_dir):
    return dual_tree.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op13_tree_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tree_bpe.round_trip(docs, path, public_tokenizers.PATTERN, keep=["doc_id"]).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_url_templates, op2_bpe, op3_toxicity, op4_line_dedup, op5_minhash, op6_simhash, op7_subspace_join, op8_mixing,
        op9_token_files, op10_secret_scan, op11_turn_repair, op12_dual_tree, op13_tree_bpe,
    )
}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

ORACLES = {
    "op11_turn_repair": r"""
        WITH RECURSIVE drawn AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
            FROM conversations),
        checked AS (
            SELECT *, xor(list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda ch: ascii(ch)::BIGINT)),
                lambda c, b: list_reduce(
                    [xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))
                ), 4294967295) % 20 AS draw
            FROM drawn),
        damaged AS (
            SELECT conv_id, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE draw WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM checked),
        numbered AS (
            SELECT *, row_number() OVER w AS i, lag(role) OVER w AS role_before,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
                   rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
            FROM damaged
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
        faulty AS (
            SELECT *, bare = '' AS blank, bare <> '' AND seen > 1 AS duplicate,
                   bare <> '' AND seen = 1 AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated, left(role, 1) AS own,
                   i > 1 AND left(role_before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal
            FROM numbered),
        inserts(q, q2, cost, audit, lines) AS (VALUES
            (0, 0, 0, '', []::VARCHAR[]), (0, 2, 5, 'I', ['user:']), (0, 3, 10, 'II', ['user:', 'assistant:']),
            (1, 1, 0, '', []), (1, 2, 5, 'I', ['user:']), (1, 3, 10, 'II', ['user:', 'assistant:']),
            (2, 2, 0, '', []), (2, 3, 5, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 5, 'I', ['user:'])),
        arcs(q, q2, letter, own, cost) AS (VALUES
            (0, 0, 'D', NULL, 2), (1, 1, 'D', NULL, 2), (2, 2, 'D', NULL, 2), (3, 3, 'D', NULL, 2),
            (0, 2, 'R', NULL, 1), (1, 2, 'R', NULL, 1), (2, 3, 'R', NULL, 1), (3, 2, 'R', NULL, 1),
            (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0), (2, 3, 'K', 'a', 0), (3, 2, 'K', 'u', 0)),
        walk(conv_id, i, q, best) AS (
            SELECT DISTINCT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} FROM faulty
            UNION ALL
            SELECT w.conv_id, w.i + 1, a.q2, min({
                'cost': w.best.cost + n.cost + a.cost + CASE WHEN a.letter <> 'D' AND f.truncated THEN 5 ELSE 0 END,
                'audit': w.best.audit || n.audit || a.letter,
                'lines': list_concat(list_concat(w.best.lines, n.lines), CASE a.letter WHEN 'D' THEN []
                    WHEN 'K' THEN [f.role || ':' || f.text]
                    ELSE [CASE a.q2 WHEN 2 THEN 'user:' ELSE 'assistant:' END || f.text] END)})
            FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
            JOIN inserts n ON n.q = w.q
            JOIN arcs a ON a.q = n.q2 AND (a.own IS NULL OR a.own = f.own)
                AND (a.letter = 'D' OR NOT (f.blank OR f.duplicate))
            GROUP BY w.conv_id, w.i, a.q2),
        faults AS (
            SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
                   count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE illegal) AS illegal
            FROM faulty GROUP BY conv_id),
        ends AS (
            SELECT w.conv_id, min({'cost': w.best.cost + n.cost, 'audit': w.best.audit || n.audit,
                                   'lines': list_concat(w.best.lines, n.lines)}) AS best
            FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.i
            JOIN inserts n ON n.q = w.q AND n.q2 IN (0, 3) GROUP BY w.conv_id)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
               coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c
        LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
    "op12_dual_tree": f"""
        WITH terms_of AS (SELECT row_number() OVER () AS place, doc_id, {_TERMS} AS terms FROM documents),
        known AS (SELECT * FROM terms_of WHERE len(terms) > 0),
        totals AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM known),
        counts AS (
            SELECT place, doc_id, n, term, count(*) AS tf
            FROM (SELECT place, doc_id, len(terms) AS n, unnest(terms) AS term FROM known) GROUP BY ALL),
        held AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
        asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
        weights AS (
            SELECT item_id, term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
            FROM asked JOIN held USING (term), totals),
        scores AS (
            SELECT item_id, place, doc_id, sum(
                w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM counts JOIN weights USING (term), totals GROUP BY ALL),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
    "op7_subspace_join": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
        fit AS (
            SELECT vec_id, v FROM vectors
            WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND list_dot_product(v, v) > 0),
        links AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM fit a JOIN fit b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
        counts AS (SELECT x, count(*) AS n FROM links GROUP BY x),
        reach AS (
            SELECT vec_id AS x, vec_id AS y FROM vectors
            UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
        least_of AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM vectors LEFT JOIN counts ON counts.x = vec_id JOIN least_of ON least_of.x = vec_id
    """,
    "op5_minhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
            SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)),
        reach AS (
            SELECT doc_id AS x, doc_id AS y FROM documents
            UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
        least_of AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM documents LEFT JOIN sizes USING (doc_id) JOIN least_of ON x = doc_id
    """,
    "op4_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        keys AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM lines),
        firsts AS (
            SELECT k, min(doc_id) AS first_doc FROM keys WHERE length(k) >= 10
            GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
        marked AS (
            SELECT keys.*, first_doc IS NOT NULL AND keys.doc_id > first_doc AS gone
            FROM keys LEFT JOIN firsts ON keys.k = firsts.k)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
}
