"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontam, exact_dedup, html_text, jaccard_join, langid, merkle, packing, quality, substring_dedup, suffix_dedup, token_counts, toxicity
from .common import fold_mod, table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids."""
    return (packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
            .select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without 13-word windows of earlier documents."""
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents of equal text."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; folds 1 to 4 of 5 train."""
    docs = table(spark, sf_dir, "documents")
    fold = fold_mod("doc_id", 5)
    found = langid.identify(docs, docs.where(fold != 0), spans=False)
    return found.select("doc_id", (fold == 0).alias("held_out"), "lang_pred", "score")


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside windows of benchmark items."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; folds 0, 1 and 3 of 4 train."""
    fold = fold_mod("doc_id", 4)
    known = table(spark, sf_dir, "labels").where(fold != 2).select("doc_id", F.col("toxic").alias("label"))
    found = toxicity.score(table(spark, sf_dir, "documents"), known)
    return found.select("doc_id", (fold == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without 100-byte strings that start earlier."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def trusted_positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of good labelled documents in folds 0 and 2 of 3."""
    return table(spark, sf_dir, "labels").where((F.col("quality") == 1) & (fold_mod("doc_id", 3) != 1)).select("doc_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; positives of folds 0 and 2 of 3 are trusted."""
    fold = fold_mod("doc_id", 3)
    found = quality.score(table(spark, sf_dir, "documents"), trusted_positives(spark, sf_dir))
    return found.select("doc_id", (fold == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers in every document."""
    found = alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    spelt = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    return found.withColumn("groups_sha256", spelt).drop("groups")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, through a new cache."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path()).drop("digest")


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of all documents, one tree a language; every row whose id's crc32 is divisible by 7 is tampered with."""
    docs = table(spark, sf_dir, "documents")
    fields = lambda n: merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang")], n, F.col("text"))
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaves = docs.select("doc_id", "lang", fields(F.col("n_chars")).alias("leaf"),
                         F.when(changed, fields(F.col("n_chars") + 1)).alias("claimed"))
    found = merkle.manifest(leaves, tree="lang", order="doc_id", claimed="claimed")
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


QUERIES = {
    "op1_packing": op1_packing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_langid": op4_langid,
    "op5_decontam": op5_decontam,
    "op6_toxicity": op6_toxicity,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_html": op9_html,
    "op10_quality": op10_quality,
    "op11_alignment": op11_alignment,
    "op12_token_counts": op12_token_counts,
    "op13_manifest": op13_manifest,
}

ORACLE_SQL = {
    "op2_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS a FROM documents),
        pos AS (SELECT doc_id, a, unnest(range(1, len(a) - 11)) AS i FROM w WHERE len(a) >= 13),
        g AS (SELECT doc_id, i, array_to_string(a[i:i + 12], ' ') AS g FROM pos),
        f AS (SELECT g, min(doc_id) AS m FROM g GROUP BY g),
        c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM g JOIN f USING (g) WHERE m < doc_id),
        x AS (SELECT doc_id, unnest(a) AS word, unnest(range(1, len(a) + 1)) AS k FROM w),
        kept AS (
          SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS t FROM x ANTI JOIN c USING (doc_id, k) GROUP BY doc_id)
        SELECT w.doc_id, len(a) AS n_words, len(a) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op8_jaccard_join": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS a FROM documents),
        pos AS (
          SELECT doc_id, a, unnest(range(1, greatest(len(a) - 4, 1) + 1)) AS i FROM w WHERE len(a) > 0),
        s AS (SELECT DISTINCT doc_id, array_to_string(a[i:i + 4], ' ') || CASE WHEN len(a) < 5 THEN ' ' ELSE '' END AS g FROM pos),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g) GROUP BY ALL),
        links AS (
          SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
        reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(r.m, w.doc_id) AS component_id
        FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = w.doc_id""",
    "op3_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g') AS t FROM documents),
        g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)""",
    "op5_decontam": r"""
        WITH low AS (
          SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        ben AS (
          SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        cut AS (
          SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
          FROM ben WHERE len(w) > 0),
        win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM cut),
        lens AS (SELECT DISTINCT n FROM win),
        pos AS (
          SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM low, lens WHERE len(w) >= n),
        hit AS (
          SELECT DISTINCT doc_id, i, p.n, item_id FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM pos) p
          JOIN win ON win.g = p.g AND win.n = p.n),
        covered AS (
          SELECT doc_id, count(*) AS n_hit FROM (
            SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
        its AS (
          SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
        SELECT low.doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
          sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM low LEFT JOIN covered USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op13_manifest": r"""
        WITH RECURSIVE crc AS (
          SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM documents
          UNION ALL
          SELECT doc_id, s, k + 1, xor(b >> 1, CASE WHEN b % 2 = 1 THEN 3988292384 ELSE 0 END)
          FROM (SELECT doc_id, s, k, CASE WHEN k % 8 = 0 THEN xor(c, ascii(s[k // 8 + 1])) ELSE c END AS b FROM crc WHERE k < 8 * len(s))),
        hit AS (SELECT doc_id, xor(c, 4294967295) % 7 = 0 AS changed FROM crc WHERE k = 8 * len(s)),
        f AS (
          SELECT doc_id, lang, n_chars, changed,
            coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
              || coalesce(strlen(lang) || ':' || lang, '-') AS a,
            coalesce(strlen(text) || ':' || text, '-') AS z
          FROM documents JOIN hit USING (doc_id)),
        leaves AS (
          SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i,
            sha256(a || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || z) AS leaf,
            CASE WHEN changed THEN sha256(a || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || z) END AS claimed
          FROM f),
        t AS (
          SELECT lang, 0 AS level, list(leaf ORDER BY i) AS ns FROM leaves GROUP BY lang
          UNION ALL
          SELECT lang, level + 1, [sha256(ns[2 * j + 1] || coalesce(ns[2 * j + 2], '')) for j in range((len(ns) + 1) // 2)]
          FROM t WHERE len(ns) > 1),
        subs AS (SELECT lang, ns[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM t WHERE len(ns) = 1),
        u AS (
          SELECT 0 AS level, list(subroot ORDER BY i) AS ns FROM subs
          UNION ALL
          SELECT level + 1, [sha256(ns[2 * j + 1] || coalesce(ns[2 * j + 2], '')) for j in range((len(ns) + 1) // 2)]
          FROM u WHERE len(ns) > 1),
        steps AS (
          SELECT doc_id, level, (l.i >> level) % 2 = 1 AS after, coalesce(ns[xor(l.i >> level, 1) + 1], '') AS s
          FROM leaves l JOIN t ON l.lang IS NOT DISTINCT FROM t.lang AND len(ns) > 1
          UNION ALL
          SELECT doc_id, 1000 + level, (b.i >> level) % 2 = 1, coalesce(ns[xor(b.i >> level, 1) + 1], '')
          FROM leaves l JOIN subs b ON l.lang IS NOT DISTINCT FROM b.lang JOIN u ON len(ns) > 1),
        p AS (
          SELECT doc_id, list(after ORDER BY level) AS af, list(s ORDER BY level) AS ss FROM steps GROUP BY doc_id),
        fold AS (
          SELECT doc_id, coalesce(claimed, leaf) AS h, coalesce(af, []) AS af, coalesce(ss, []) AS ss, 0 AS k FROM leaves LEFT JOIN p USING (doc_id)
          UNION ALL
          SELECT doc_id, CASE WHEN af[k + 1] THEN sha256(ss[k + 1] || h) ELSE sha256(h || ss[k + 1]) END, af, ss, k + 1
          FROM fold WHERE k < len(ss))
        SELECT l.doc_id, leaf, subroot, r.ns[1] AS root, sha256(array_to_string(ss, '')) AS proof_sha256, h AS folded_root, h = r.ns[1] AS verified
        FROM leaves l JOIN fold USING (doc_id) JOIN subs b ON l.lang IS NOT DISTINCT FROM b.lang JOIN u r ON len(r.ns) = 1
        WHERE fold.k = len(fold.ss)""",
}
