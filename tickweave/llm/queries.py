"""The registered queries ``opN_*`` over ``documents`` and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.common import documents
from tickweave.llm.exact_dedup import exact_duplicates
from tickweave.llm.jaccard import similar_documents
from tickweave.llm.lexical import build_index, search
from tickweave.llm.license_scan import notice_templates, scan
from tickweave.llm.line_templates import drop_recurring_lines
from tickweave.llm.merkle import siblings, tamper_check
from tickweave.llm.packing import pack_documents
from tickweave.llm.quality_net import classify
from tickweave.llm.repetition import repetition
from tickweave.llm.secret_ledger import scan_history
from tickweave.llm.simhash import near_duplicates
from tickweave.llm.token_files import token_files_of
from tickweave.llm.word_bpe import decode, encode
from tickweave.sources.tables import read_table

JSON_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _joined(findings: Column) -> Column:
    return F.concat_ws(",", F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))))


def op1_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, each distinct text scanned once."""
    rows = scan_history(documents(spark, sf_dir))
    kinds = F.transform("findings", lambda f: f["kind"])
    counts = [F.size(F.array_remove(kinds, k)) for k in ("assign", "access", "hex")]
    counts = [(F.size("findings") - n).cast("long").alias(f"n_{k}") for k, n in zip(("assign", "access", "hex"), counts)]
    base = F.filter("findings", lambda f: f["kind"].isin("assign", "access", "hex"))
    return rows.select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("findings")).alias("spans"))


def op2_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of all documents, learnt from the labels outside the held-out rows."""
    return classify(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices and the passages of table ``benchmark`` in all documents."""
    passages = read_table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("benchmark:"), F.col("item_id").cast("string")).alias("template_id"), "text")
    return scan(documents(spark, sf_dir), notice_templates(spark).unionByName(passages))


def op4_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, symbol, line and repetition counts of all documents, and the verdict."""
    return repetition(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered_chars", "longest_repeat", F.size("spans").alias("n_spans"), F.size("repeats").alias("n_repeats"))


def op5_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the component of each."""
    return near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines of recurring templates."""
    return drop_recurring_lines(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", "text")


def op7_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, each distinct word once, and decode the ids again."""
    encoded = encode(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)
    return decode(encoded, RANKS).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents with end id 2, write token files and read them back."""
    rows = token_files_of(spark, documents(spark, sf_dir), JSON_VOCABULARY, 2)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts of all documents and the row of each that stays."""
    return exact_duplicates(documents(spark, sf_dir))


def op10_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 2048 ids, end id 0."""
    return pack_documents(documents(spark, sf_dir), JSON_VOCABULARY, 0)


def op11_merkle_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, proofs and roots of all documents, and the check of a tampered copy."""
    return tamper_check(documents(spark, sf_dir)).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root", "verified")


def op12_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all documents for each text of ``benchmark``."""
    return search(build_index(documents(spark, sf_dir)), read_table(spark, sf_dir, "benchmark"), 50)


def op13_token_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of like sets of 4-word shingles, by component."""
    return similar_documents(documents(spark, sf_dir))


QUERIES = {q.__name__: q for q in (
    op1_blob_ledger, op2_byte_cnn, op3_license_scan, op4_suffix_repetition, op5_simhash_golay,
    op6_line_templates, op7_word_bpe, op8_token_files, op9_exact_dedup, op10_bin_slack_packing,
    op11_merkle_forward, op12_block_max_search, op13_token_group_join)}

ORACLE_SQL = {
    "op9_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents),
        g AS (
            SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g""",
    "op6_line_templates": r"""
        WITH lines AS (
            SELECT doc_id, text, place, list_extract(parts, place) AS body, len(parts) AS n_lines
            FROM (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) AS s,
                 unnest(range(1, len(parts) + 1)) AS u(place)),
        plain AS (SELECT *, trim(regexp_replace(body, '[ \t\x0B\f\r]+', ' ', 'g'), ' ') AS line FROM lines),
        masked AS (
            SELECT doc_id, text, place, masked, tokens, len(tokens) AS n_tokens, array_to_string(tokens[1:3], ' ') AS lead
            FROM (SELECT *, string_split(masked, ' ') AS tokens
                  FROM (SELECT *, regexp_replace(line, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS masked FROM plain WHERE line <> ''))
            WHERE len(tokens) >= 5 OR NOT list_contains(tokens, '<*>')),
        leaves AS (
            SELECT n_tokens, lead FROM (SELECT DISTINCT n_tokens, lead, doc_id, text FROM masked) GROUP BY ALL HAVING count(*) >= 5),
        chosen AS (SELECT m.*, hash(doc_id, text) AS doc FROM masked m JOIN leaves USING (n_tokens, lead)),
        places AS (
            SELECT DISTINCT masked, n_tokens, lead, doc, place, list_extract(tokens, place) AS token
            FROM (SELECT DISTINCT masked, tokens, n_tokens, lead, doc FROM chosen WHERE n_tokens >= 5), unnest(range(4, n_tokens + 1)) AS u(place)),
        constant AS (
            SELECT n_tokens, lead, place, token FROM places WHERE token <> '<*>' GROUP BY ALL HAVING count(DISTINCT doc) >= 5),
        fields AS (
            SELECT masked, p.n_tokens, p.lead, doc, count(c.token) AS n_constant,
                   p.lead || ' ' || string_agg(coalesce(c.token, '<*>'), ' ' ORDER BY p.place) AS template
            FROM places p LEFT JOIN constant c
                 ON p.n_tokens = c.n_tokens AND p.lead = c.lead AND p.place = c.place AND p.token = c.token
            GROUP BY masked, p.n_tokens, p.lead, doc),
        shared AS (
            SELECT template FROM fields WHERE n_constant > 0 AND 2 * n_constant >= n_tokens - 3 GROUP BY template HAVING count(DISTINCT doc) >= 5),
        recurring AS (
            SELECT DISTINCT masked FROM fields JOIN shared USING (template) WHERE n_constant > 0 AND 2 * n_constant >= n_tokens - 3
            UNION SELECT masked FROM chosen WHERE n_tokens < 5 GROUP BY masked HAVING count(DISTINCT doc) >= 5),
        gone AS (SELECT DISTINCT doc_id, text, place FROM chosen JOIN recurring USING (masked))
        SELECT doc_id, any_value(n_lines) AS n_lines, count(g.place) AS n_dropped,
               coalesce(string_agg(l.body, chr(10) ORDER BY l.place) FILTER (WHERE g.place IS NULL), '') AS text
        FROM lines l LEFT JOIN gone g USING (doc_id, text, place) GROUP BY doc_id, l.text""",
    "op11_merkle_forward": r"""
        WITH RECURSIVE crc_table AS (
            SELECT list(c ORDER BY i) AS steps FROM (
                SELECT i, list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c
                FROM range(0, 256) AS r(i))),
        fields AS (
            SELECT doc_id, lang, n_chars, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail,
                   xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
                       lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS crc
            FROM documents, crc_table),
        leaves AS (
            SELECT doc_id, coalesce('+' || lang, '') AS tree, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
                   CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL
                        THEN sha256(head || strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1) || tail) END AS tampered
            FROM fields),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
        lower_nodes(tree, level, pos, n, node) AS (
            SELECT tree, 0::BIGINT, pos, n, leaf FROM placed
            UNION ALL
            SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos))
            FROM lower_nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n),
        subroots AS (SELECT tree, level, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS trees FROM lower_nodes WHERE n = 1),
        upper_nodes(level, pos, n, node) AS (
            SELECT 0::BIGINT, place, trees, subroot FROM subroots
            UNION ALL
            SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY pos)) FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 2, n),
        top AS (SELECT level, node AS root FROM upper_nodes WHERE n = 1),
        steps AS (
            SELECT p.tree, p.pos, l AS rung, xor(p.pos >> l, 1) < (p.pos >> l) AS is_left, s.node AS sibling
            FROM placed p JOIN subroots r USING (tree), unnest(range(0, r.level)) AS u(l)
                 LEFT JOIN lower_nodes s ON s.tree = p.tree AND s.level = l AND s.pos = xor(p.pos >> l, 1)
            UNION ALL
            SELECT p.tree, p.pos, 1000 + l, xor(r.place >> l, 1) < (r.place >> l), s.node
            FROM placed p JOIN subroots r USING (tree), top t, unnest(range(0, t.level)) AS u(l)
                 LEFT JOIN upper_nodes s ON s.level = l AND s.pos = xor(r.place >> l, 1)),
        proofs AS (
            SELECT tree, pos, list(CASE WHEN sibling IS NULL THEN '=' WHEN is_left THEN 'L' || sibling ELSE 'R' || sibling END ORDER BY rung) AS proof
            FROM steps GROUP BY tree, pos),
        done AS (
            SELECT doc_id, leaf, subroot, root, sha256(coalesce(translate(array_to_string(proof, ''), 'LR=', ''), '')) AS proof_sha256,
                   list_reduce(coalesce(proof, []), lambda node, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || node WHEN 'R' THEN node || s[2:] ELSE node END),
                               coalesce(tampered, leaf)) AS folded_root
            FROM placed JOIN subroots USING (tree) LEFT JOIN proofs USING (tree, pos), top)
        SELECT *, folded_root = root AS verified FROM done""",
    "op12_block_max_search": r"""
        WITH tokens AS (
            SELECT doc_id, pos, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT doc_id, text, row_number() OVER () AS pos FROM documents)),
        postings AS (SELECT pos, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM tokens GROUP BY pos, term),
        sizes AS (SELECT pos, sum(tf)::BIGINT AS n FROM postings GROUP BY pos),
        corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
        weights AS (
            SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM postings, corpus GROUP BY term),
        queries AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        scored AS (
            SELECT item_id, pos, any_value(doc_id) AS doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM queries JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (pos), corpus GROUP BY item_id, pos)
        SELECT * FROM (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
            FROM scored WHERE score > 0)
        WHERE rank <= 50""",
}
