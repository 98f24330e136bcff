"""The operators of this package on the test tables, and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import (
    dynamic_itemsets,
    fragment_join,
    latent_search,
    license_scan,
    odd_sketches,
    packing,
    page_templates,
    permutation_index,
    prefix_trie,
    rule_ensemble,
    secret_scan,
    sharding,
    zip_archives,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_sampled_splitters(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, folder, "documents"))


def op2_license_windows(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.find_notices(_table(spark, folder, "documents"))


def op3_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    return permutation_index.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_page_templates(spark: SparkSession, folder: str) -> DataFrame:
    return page_templates.extract_articles(_table(spark, folder, "pages"))


def op5_latent_search(spark: SparkSession, folder: str) -> DataFrame:
    return latent_search.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op6_odd_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return odd_sketches.near_duplicates(_table(spark, folder, "documents"), words=4)


def op7_rule_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    return rule_ensemble.score_documents(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op8_guess_cost(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan_documents(_table(spark, folder, "documents"))


def op9_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"))


def op10_zip_archives(spark: SparkSession, folder: str) -> DataFrame:
    return zip_archives.archive_pages(spark, _table(spark, folder, "pages"))


def op11_dynamic_itemsets(spark: SparkSession, folder: str) -> DataFrame:
    return dynamic_itemsets.collocations(_table(spark, folder, "documents"))


def op12_vertical_fragments(spark: SparkSession, folder: str) -> DataFrame:
    return fragment_join.similar_documents(_table(spark, folder, "documents"))


def op13_splitter_skeleton(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, folder, "conversations"))


QUERIES = {
    "op1_sampled_splitters": op1_sampled_splitters,
    "op2_license_windows": op2_license_windows,
    "op3_permutation_index": op3_permutation_index,
    "op4_page_templates": op4_page_templates,
    "op5_latent_search": op5_latent_search,
    "op6_odd_sketches": op6_odd_sketches,
    "op7_rule_ensemble": op7_rule_ensemble,
    "op8_guess_cost": op8_guess_cost,
    "op9_vector_packing": op9_vector_packing,
    "op10_zip_archives": op10_zip_archives,
    "op11_dynamic_itemsets": op11_dynamic_itemsets,
    "op12_vertical_fragments": op12_vertical_fragments,
    "op13_splitter_skeleton": op13_splitter_skeleton,
}

_NOTICES = ", ".join(f"('{name}', '{notice}')" for name, notice in license_scan.NOTICES)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _component_sql(percent: int, columns: str) -> str:
    """Components of documents whose sets of four-word shingles are similar enough, by comparing all that share one."""
    return f"""
        WITH RECURSIVE cut AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS words
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
                ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle
            FROM cut),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM shingles AS a JOIN shingles AS b USING (shingle)
            JOIN sizes AS x ON x.doc_id = a.doc_id JOIN sizes AS y ON y.doc_id = b.doc_id
            WHERE a.doc_id <> b.doc_id AND least(x.n, y.n) * 100 >= {percent} * greatest(x.n, y.n)
            GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= {percent} * (x.n + y.n - count(*))),
        reached AS (SELECT doc_id AS node, doc_id AS other FROM documents
                    UNION SELECT node, links.b FROM reached JOIN links ON links.a = other)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, {columns}
        FROM documents AS d LEFT JOIN sizes USING (doc_id)
        JOIN (SELECT node AS doc_id, min(other) AS component_id FROM reached GROUP BY node) USING (doc_id)"""


ORACLES: dict[str, str] = {
    "op2_license_windows": f"""
        WITH cut AS (
            SELECT * FROM (
                SELECT doc_id, NULL AS license, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS words
                FROM documents
                UNION ALL
                SELECT NULL, license, list_filter(regexp_split_to_array(lower(notice), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')
                FROM (VALUES {_NOTICES}) AS given(license, notice))
            WHERE len(words) >= 3),
        shingled AS (
            SELECT doc_id, license, len(words) AS length,
                list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) AS shingles
            FROM cut),
        notices AS (
            SELECT license, list_distinct(shingles) AS needed, CAST(2 ** greatest(1, ceil(log2(length))) AS BIGINT) AS longest
            FROM shingled WHERE license IS NOT NULL),
        windows AS (
            SELECT doc_id, notices.license, begin_at, len(list_intersect(needed, list_distinct(
                shingles[begin_at + 1:begin_at + 2 * longest - 2]))) / len(needed) AS share
            FROM (SELECT s.doc_id, s.shingles, n.license, n.needed, n.longest, unnest(range(0, len(s.shingles), n.longest)) AS begin_at
                  FROM shingled AS s, notices AS n WHERE s.license IS NULL) AS notices)
        SELECT doc_id, license, CAST(min(begin_at) AS INTEGER) AS first_word, count(*) AS n_windows, max(share) AS containment
        FROM windows WHERE share >= 0.8 GROUP BY doc_id, license""",
    "op6_odd_sketches": _component_sql(80, "component_id, component_id = d.doc_id AS kept"),
    "op10_zip_archives": """
        WITH payloads AS (SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM pages),
        firsts AS (SELECT digest, min(page_id) AS first_id FROM payloads GROUP BY digest)
        SELECT page_id, payload_bytes, url,
            array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST(1 + (CAST('0x' || substr(digest, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) % 32 AS BIGINT), 1)), '') AS payload_digest,
            CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id > first_id THEN first_id END AS refers_to
        FROM payloads JOIN firsts USING (digest)""",
    "op11_dynamic_itemsets": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
        runs AS (SELECT lang, words, length, unnest(range(1, len(words) - length + 2)) AS first FROM cut, (VALUES (1), (2), (3)) AS lengths(length)),
        found AS (SELECT lang, length, array_to_string(words[first:first + length - 1], ' ') AS phrase, count(*) AS f FROM runs GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM found WHERE length = 1 GROUP BY lang),
        candidates AS (SELECT lang, phrase, length, f, string_split(phrase, ' ') AS words FROM found WHERE length > 1 AND f >= 10),
        cuts AS (
            SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, CAST(1000000::HUGEINT * c.f * c.f // (l.f::HUGEINT * r.f) AS BIGINT) AS score
            FROM (SELECT *, unnest(range(1, length)) AS k FROM candidates) AS c
            JOIN found AS l ON l.lang = c.lang AND l.phrase = array_to_string(words[1:k], ' ')
            JOIN found AS r ON r.lang = c.lang AND r.phrase = array_to_string(words[k + 1:], ' ')),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        longer AS (
            SELECT lang, phrase, max(f) AS f
            FROM (SELECT lang, f, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase FROM candidates WHERE length = 3)
            GROUP BY lang, phrase)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM lowest LEFT JOIN longer USING (lang, phrase) JOIN totals USING (lang)
        WHERE longer.f IS NULL OR 100 * longer.f < 50 * a
        QUALIFY rank <= 2000""",
    "op12_vertical_fragments": _component_sql(85, "component_id"),
    "op13_splitter_skeleton": """
        WITH paths AS (
            SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS path
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        heads AS (
            SELECT conv_id, path, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce([4294967295::BIGINT]
                    || list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT),
                lambda crc, byte: list_reduce([xor(crc, byte)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
                    lambda x, skip: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 9 AS h
            FROM paths),
        rebuilt AS (
            SELECT own.conv_id, coalesce(list_slice(first.path, 1, h), []) || list_slice(own.path, h + 1, len(own.path)) AS path
            FROM heads AS own LEFT JOIN paths AS first ON first.conv_id = base),
        nodes AS (
            SELECT depth, list_slice(path, 1, depth) AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
                coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), '') AS ends
            FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM rebuilt) GROUP BY ALL),
        children AS (SELECT depth - 1 AS depth, list_slice(prefix, 1, depth - 1) AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
        own AS (
            SELECT nodes.*, coalesce(n, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(prefix[depth].text) ELSE 0 END AS saved
            FROM nodes LEFT JOIN children USING (depth, prefix)),
        subtrees AS (
            SELECT upto AS depth, list_slice(prefix, 1, upto) AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved
            FROM (SELECT prefix, n_children, saved, unnest(range(0, depth + 1)) AS upto FROM own) GROUP BY ALL)
        SELECT own.conv_id, own.depth, parent.conv_id AS parent_conv_id, own.n_convs, own.n_children,
            CAST(subtrees.n_leaves AS BIGINT) AS n_leaves, CAST(subtrees.saved AS BIGINT) AS saved_tokens, sha256(own.ends) AS ends_sha256
        FROM own JOIN subtrees USING (depth, prefix)
        LEFT JOIN own AS parent ON parent.depth = own.depth - 1 AND parent.prefix = list_slice(own.prefix, 1, own.depth - 1)""",
}
