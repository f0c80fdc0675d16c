"""One query per operator, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poseval.llm.burst_trie import conversation_paths, prefix_trie
from poseval.llm.chaining import fuzzy_passages
from poseval.llm.common import crc_of_id, load
from poseval.llm.decontaminate import contaminated
from poseval.llm.exact_dedup import exact_duplicates
from poseval.llm.katz import score_documents
from poseval.llm.packing import Limits, pack_documents
from poseval.llm.preference import format_preferences, mask_text
from poseval.llm.quality import quality_scores
from poseval.llm.simhash import near_duplicates
from poseval.llm.suffix_dedup import repeated_strings
from poseval.llm.token_files import read_documents, write_token_files
from poseval.llm.url_filter import RULES, judge_pages
from poseval.llm.whitening import fit_whitening, whiten
from poseval.session import new_folder

#: Fixed values: the rules of op5.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, come in as three batches: who stays in each group of equal texts."""
    found = exact_duplicates(load(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op2_katz(spark: SparkSession, folder: str) -> DataFrame:
    """Log probability of every document under a bigram model with backoff."""
    return score_documents(load(spark, folder, "documents"))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the 100-byte strings that start earlier, too."""
    found = repeated_strings(load(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    kept = F.coalesce(F.sha2("kept", 256), F.lower(F.hex("sha")))
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), kept.alias("kept_sha256")
    )


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """A quality score for every document."""
    return quality_scores(load(spark, folder, "documents"), load(spark, folder, "labels"))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict for every page, by rules and aliases."""
    return judge_pages(load(spark, folder, "pages"), spark.createDataFrame(URL_RULES, RULES))


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with passages of benchmark items, edited ones included."""
    return contaminated(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


def op7_fuzzy_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 40 words and more that an earlier document has alike."""
    return fuzzy_passages(load(spark, folder, "documents"))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(load(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_preferences(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations as pairs: an even one is chosen over the one that follows it."""
    turns = load(spark, folder, "conversations")
    pairs = format_preferences(turns, F.shiftright("conv_id", 1), F.pmod("conv_id", F.lit(2)) == 0)
    return pairs.withColumns({c: mask_text(c) for c in ("chosen_mask", "rejected_mask")})


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens and 128 pieces."""
    pieces = pack_documents(
        load(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), limits=Limits(2048, 128, 2048)
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable vector on the 32 leading components of all of them."""
    table = load(spark, folder, "embeddings")
    fit = fit_whitening(table)
    if fit is None or not len(fit.values):
        kind = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], kind)
    found = whiten(table, fit, deviations=True).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(x)) for x in fit.explained])
    return found.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(fit.identity_error).alias("identity_error"),
    )


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """All nodes of the trie over conversations that share beginnings with every twentieth."""
    base = F.col("conv_id") - F.col("conv_id") % 20
    return prefix_trie(conversation_paths(load(spark, folder, "conversations"), base, crc_of_id("conv_id") % 4))


def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents, written to grammar-compressed files and read back."""
    files = new_folder(spark, "token-files")
    write_token_files(load(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), files)
    return read_documents(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_katz,
        op3_suffix_dedup,
        op4_quality,
        op5_url_filter,
        op6_decontaminate,
        op7_fuzzy_passages,
        op8_simhash,
        op9_preferences,
        op10_packing,
        op11_whitening,
        op12_prefix_trie,
        op13_token_files,
    )
}
ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id)""",
    "op5_url_filter": r"""
        WITH RECURSIVE rules(host, path, verdict) AS (VALUES
            ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
            ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        tag AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS t FROM pages),
        href AS (
            SELECT url, CASE WHEN regexp_matches(t, '(?is)rel\s*=\s*.?canonical') THEN regexp_extract(t, '(?is)href\s*=\s*"([^"]*)"', 1)
                             WHEN regexp_matches(t, '(?is)http-equiv\s*=\s*.?refresh') THEN regexp_extract(t, '(?is)url\s*=\s*([^"]*)"', 1) END AS h
            FROM tag),
        edge AS (
            SELECT split_part(url, '#', 1) AS a,
                   split_part(CASE WHEN contains(h, '://') THEN h ELSE regexp_extract(url, '^[^:]*://[^/?#]*') || h END, '#', 1) AS b
            FROM href WHERE h <> ''),
        pair AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
        reach AS (SELECT a, b FROM pair UNION SELECT r.a, e.b FROM reach r JOIN pair e ON r.b = e.a),
        url AS (SELECT url AS u FROM pages UNION SELECT b FROM reach),
        part AS (SELECT u, CASE WHEN strpos(u, '://') > 0 THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS rest FROM url),
        place AS (
            SELECT u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM part),
        fit AS (
            SELECT u, r.host || r.path AS rule, verdict,
                   row_number() OVER (PARTITION BY u ORDER BY length(r.host || r.path) DESC, r.host || r.path DESC) AS k
            FROM place p JOIN rules r
              ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)),
        handed AS (SELECT DISTINCT r.a FROM reach r JOIN fit f ON f.u = r.b AND f.k = 1 AND f.verdict = 'block')
        SELECT page_id, coalesce(l.host, '') AS host, coalesce(l.path, '') AS path, f.rule,
               coalesce(f.verdict, CASE WHEN h.a IS NOT NULL THEN 'block' END, 'allow') AS verdict
        FROM pages p LEFT JOIN place l ON l.u = p.url LEFT JOIN fit f ON f.u = p.url AND f.k = 1
        LEFT JOIN handed h ON h.a = split_part(p.url, '#', 1)""",
    "op9_preferences": r"""
        WITH t AS (
            SELECT DISTINCT conv_id, turn, replace(coalesce(role, ''), '<|', '< |') AS role,
                   replace(coalesce(text, ''), '<|', '< |') AS body
            FROM conversations WHERE conv_id IS NOT NULL),
        o AS (
            SELECT conv_id >> 1 AS pair_id, conv_id & 1 AS side, role, body,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body) AS k
            FROM t),
        differs AS (
            SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, min(coalesce(a.k, b.k)) AS k
            FROM (SELECT * FROM o WHERE side = 0) a FULL JOIN (SELECT * FROM o WHERE side = 1) b
              ON a.pair_id = b.pair_id AND a.k = b.k AND a.role = b.role AND a.body = b.body
            WHERE a.k IS NULL OR b.k IS NULL GROUP BY 1),
        p AS (
            SELECT o.pair_id, CAST(coalesce(min(d.k) - 1, max(o.k)) AS INTEGER) AS n
            FROM o LEFT JOIN differs d USING (pair_id) GROUP BY 1),
        r AS (
            SELECT p.pair_id, n, side, k, role, '<|im_start|>' || role || chr(10) || body || '<|im_end|>' || chr(10) AS shown,
                   (13 + length(role)) || ':0,' || (length(body) + 10) || ':' || CAST(role = 'assistant' AS INT) || ',1:0' AS mask
            FROM p JOIN o USING (pair_id))
        SELECT pair_id, any_value(n) AS prefix_turns,
               coalesce(string_agg(shown, '' ORDER BY k) FILTER (side = 0 AND k <= n), '') AS prompt,
               coalesce(string_agg(shown, '' ORDER BY k) FILTER (side = 0 AND k > n), '') AS chosen,
               coalesce(string_agg(shown, '' ORDER BY k) FILTER (side = 1 AND k > n), '') AS rejected,
               coalesce(string_agg(mask, ',' ORDER BY k) FILTER (side = 0 AND k > n), '') AS chosen_mask,
               coalesce(string_agg(mask, ',' ORDER BY k) FILTER (side = 1 AND k > n), '') AS rejected_mask,
               count(*) FILTER (side = 0 AND k > n AND role = 'assistant') > 0
                   AND count(*) FILTER (side = 1 AND k > n AND role = 'assistant') > 0 AS usable
        FROM r GROUP BY pair_id""",
    "op12_prefix_trie": r"""
        WITH own AS (
            SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
        crc AS (
            SELECT c, xor(list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                lambda a, b: list_reduce(
                    list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                    lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 4 AS h
            FROM own),
        seq AS (
            SELECT o.c, coalesce(b.turns, [])[1:h] || o.turns[h + 1:] AS s
            FROM own o JOIN crc USING (c) LEFT JOIN own b ON b.c = o.c - o.c % 20),
        pre AS (
            SELECT c, d, len(s) = d AS ends, s[1:d] AS p, s[1:d - 1] AS up, coalesce(s[d].t, '') AS t
            FROM seq, unnest(range(len(s) + 1)) AS u(d)),
        node AS (
            SELECT p, d, any_value(CASE WHEN d > 0 THEN up END) AS up, min(c) AS conv_id, count(*) AS n,
                   (count(*) - 1) * any_value(len(list_filter(regexp_split_to_array(t, '[ 	-]+'), lambda w: w <> ''))) AS saved,
                   sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends
            FROM pre GROUP BY p, d),
        kids AS (SELECT up, count(*) AS k FROM node WHERE d > 0 GROUP BY up),
        flat AS (SELECT n.*, coalesce(k, 0) AS k FROM node n LEFT JOIN kids ON kids.up = n.p),
        spread AS (SELECT p[1:a] AS p, k, saved FROM flat, unnest(range(d + 1)) AS u(a)),
        below AS (SELECT p, count(*) FILTER (k = 0) AS leaves, sum(saved) AS saved FROM spread GROUP BY p)
        SELECT f.conv_id, f.d AS depth, u.conv_id AS parent_conv_id, f.n AS n_convs, f.k AS n_children, b.leaves AS n_leaves,
               CAST(b.saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
        FROM flat f JOIN below b USING (p) LEFT JOIN node u ON u.p = f.up""",
}
