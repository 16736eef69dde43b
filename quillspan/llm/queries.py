"""Registered queries of this package, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship, spread

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; a small one is dealt out to all cores, its documents then in order, so that a task that runs again has them alike."""
    ship(spark)
    stored = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    dealt = spread(stored)
    return dealt if dealt is stored or name != "documents" else dealt.sortWithinPartitions("doc_id", "text")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_model import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .quality_rules import quality_rules

    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


def op3_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import lm_scores

    return lm_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 1"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .mixing import mix, turn
    from .runtime import cut, word_count

    docs = table(spark, sf_dir, "documents")
    sized = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    places = F.transform("draws", lambda d: F.struct(d["shard"].alias("shard"), turn(d["place"], F.col("doc_id")).alias("turn")))
    return mix(sized).select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"), places.alias("places"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import digest, remove_repeats

    return digest(remove_repeats(table(spark, sf_dir, "documents")))


OP5_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda v: v <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM win) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS j FROM hit, range(0, 13) r(k)),
each AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS j FROM w),
kept AS (SELECT doc_id, string_agg(ws[j], ' ' ORDER BY j) AS rest, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, j) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import cut_pieces, pack

    return pack(cut_pieces(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0, capacity=2048), 2048)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS s
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY s) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       s AS text_sha256
FROM t WINDOW w AS (PARTITION BY s ORDER BY n DESC, doc_id)
"""


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import license_scan

    return license_scan(table(spark, sf_dir, "documents"))


def op8_sql() -> str:
    """The same canonical form in SQL."""
    from .known_licenses import LINE_WORD, NOTICE_LINE, OWN_NOTICE, SPELLINGS, TEXTS

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def canonical(text: str) -> str:
        x = f"lower(coalesce({text}, ''))"
        x = rf"regexp_replace({x}, '{OWN_NOTICE}', 'xcopyright\1\2', 'g')"
        x = f"regexp_replace({x}, '(?m){NOTICE_LINE}', '', 'g')"
        x = f"' ' || trim(regexp_replace({x}, '[^a-z0-9]+', ' ', 'g')) || ' '"
        for found, common in SPELLINGS:
            x = f"replace({x}, {quoted(f' {found} ')}, {quoted(f' {common} ')})"
        return f"sha256(trim(regexp_replace({x}, ' +', ' ', 'g')))"

    rows = ", ".join(f"({i}, {quoted(k)}, {quoted(v)})" for i, (k, v) in enumerate(TEXTS.items()))
    return (
        f"WITH known AS (SELECT {canonical('t')} AS s, arg_min(k, i) AS license_id FROM (VALUES {rows}) v(i, k, t) GROUP BY 1), "
        f"lines AS (SELECT doc_id, row, {canonical('line')} AS s FROM (SELECT doc_id, row, unnest(string_split(text, chr(10))) AS line "
        f"FROM (SELECT *, row_number() OVER () AS row FROM documents) WHERE contains(lower(text), '{LINE_WORD}')) WHERE contains(lower(line), '{LINE_WORD}')), "
        "named AS (SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS line_licenses FROM lines JOIN known USING (s) GROUP BY doc_id) "
        "SELECT d.doc_id, d.s AS text_sha256, known.license_id, coalesce(line_licenses, '') AS line_licenses "
        f"FROM (SELECT doc_id, {canonical('text')} AS s FROM documents) d LEFT JOIN known ON d.s = known.s LEFT JOIN named ON d.doc_id = named.doc_id"
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import similar_documents

    return similar_documents(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda v: v <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, CASE WHEN len(ws) > 0 THEN 1 ELSE 0 END) + 1)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (
  SELECT x.a, x.b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY ALL) x
  JOIN n na ON na.doc_id = x.a JOIN n nb ON nb.doc_id = x.b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(w.doc_id, coalesce(min(reach.b), w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.a = w.doc_id GROUP BY w.doc_id
"""


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .wavelet import token_table

    return token_table(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """deviation is null where it is beyond a long; exact_deviation has up to 38 digits."""
    from pyspark.sql import functions as F

    from .whitening import whiten

    out = whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumns({"exact_deviation": F.col("deviation"), "deviation": F.col("deviation").try_cast("long")})


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_classifier": op1_quality_classifier,
        "op2_divergence_rules": op2_divergence_rules,
        "op3_cross_entropy_difference": op3_cross_entropy_difference,
        "op4_source_mix": op4_source_mix,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_license_scan": op8_license_scan,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_token_files": op10_token_files,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_toxicity": op13_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    from .rules_sql import rules_sql
    from .spelling_sql import spelling_sql

    return {"op2_divergence_rules": rules_sql(), "op5_substring_dedup": OP5_SQL, "op7_exact_dedup": OP7_SQL, "op8_license_scan": op8_sql(), "op9_jaccard_join": OP9_SQL, "op12_spelling_variants": spelling_sql()}
