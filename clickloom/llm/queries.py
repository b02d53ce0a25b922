"""The named queries of the operators over the whole given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.bytebpe import round_trips
from clickloom.llm.exact_dedup import exact_dedup
from clickloom.llm.hard_negatives import mine_hard_negatives
from clickloom.llm.language_id import identify_languages, train
from clickloom.llm.license_scan import ANCHORS, LINE_STARTS, RULES, letters, licence_rules, scan_licences
from clickloom.llm.line_dedup import dedup_lines
from clickloom.llm.merkle import edited_rows, map_with_next
from clickloom.llm.packing import pack_documents
from clickloom.llm.quality_rules import (
    DOUBT,
    LEAST_WORDS,
    MOST_REPEATED,
    RISK,
    RULES as QUALITY_RULES,
    with_counts,
    with_verdicts,
)
from clickloom.llm.registry import QUERIES, SQL, query
from clickloom.llm.secret_scan import (
    APART,
    CLASSES,
    FIRST_LOOK,
    KINDS,
    PADDED,
    PATTERNS,
    REACH,
    base_spans,
    listed,
    scan_secrets,
)
from clickloom.llm.simhash import with_components, with_fingerprints
from clickloom.llm.warc import read_archive, write_archive
from clickloom.llm.whitening import component_rows
from clickloom.session import new_work_dir

__all__ = ["QUERIES", "SQL"]


def _documents(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", *more)


@query(
    "op9_exact_dedup",
    """
    SELECT doc_id,
           max(doc_id) OVER same AS keep_id,
           count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(_documents(spark, folder)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


@query(
    "op10_warc",
    """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS html,
               min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id,
               sha1(coalesce(html, '')) AS h
        FROM pages
    )
    SELECT page_id,
           strlen(html) AS payload_bytes,
           array_to_string([
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      (((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT
                         >> ((3 - i % 4) * 5)) & 31) + 1)::INT, 1)
               FOR i IN range(32)], '') AS payload_digest,
           CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first_id THEN first_id END AS refers_to
    FROM p
    """,
)
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = new_work_dir(spark, "warc")
    write_archive(spark.read.parquet(f"{folder}/pages.parquet"), archive)
    return read_archive(spark, archive).select(
        F.col("id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


@query(
    "op1_line_dedup",
    """
    WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
    w AS (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM d),
    k AS (SELECT doc_id, p, [l[p], l[p + 1], l[p + 2]] AS lines FROM w),
    f AS (SELECT lines, min((doc_id, p)) AS first FROM k GROUP BY lines HAVING count(*) > 1),
    late AS (SELECT doc_id, p FROM k JOIN f USING (lines) WHERE (doc_id, p) <> first),
    covered AS (SELECT DISTINCT doc_id, unnest([p, p + 1, p + 2]) AS i FROM late),
    runs AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run
             FROM covered),
    spans AS (SELECT doc_id, min(i) - 1 AS a, max(i) AS b, count(*) AS n
              FROM runs GROUP BY doc_id, run),
    gone AS (SELECT doc_id, string_agg(a || ':' || b, ',' ORDER BY a) AS spans,
                    sum(n)::BIGINT AS n FROM spans GROUP BY doc_id),
    lines AS (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d),
    clean AS (SELECT doc_id, string_agg(l[i], chr(10) ORDER BY i) AS t
              FROM lines ANTI JOIN covered USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, len(l) AS n_lines, coalesce(n, 0) AS n_removed,
           coalesce(spans, '') AS removed_spans, sha256(coalesce(t, '')) AS clean_sha256
    FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN clean USING (doc_id)
    """,
)
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    spans = F.transform("removed_spans", lambda x: F.concat_ws(":", x["start"], x["end"]))
    return dedup_lines(_documents(spark, folder)).select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.array_join(spans, ",").alias("removed_spans"),
        F.sha2("clean", 256).alias("clean_sha256"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _licence_sql() -> str:
    known = ", ".join(f"{_quoted(k)}: {_quoted(v)}" for k, v in letters().items())
    names = ", ".join(f"{_quoted(seq)}: {_quoted(name)}" for name, seq in RULES)
    clean = "trim(regexp_replace({}, '[^a-z0-9]+', ' ', 'g'))"
    bare = "t"
    for start in LINE_STARTS:
        bare = f"regexp_replace({bare}, {_quoted(start)}, '', 'g')"
    return f"""
    WITH m AS (SELECT MAP {{{known}}} AS known, MAP {{{names}}} AS names),
    d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    cut AS (SELECT doc_id, flatten(list_transform(
                regexp_split_to_array(
                    {bare}, '[.!?]+[ \\t\\r\\n]+|[.!?]+\\z|\\n[ \\t\\r]*\\n'),
                lambda s: CASE WHEN known[{clean.format('s')}] IS NOT NULL
                     THEN [{clean.format('s')}]
                     ELSE list_transform(string_split(s, chr(10)), lambda x: {clean.format('x')})
                     END)) AS s
            FROM d, m WHERE regexp_matches(t, {_quoted('|'.join(ANCHORS))})),
    sentences AS (SELECT doc_id, list_filter(s, lambda x: x <> '') AS s FROM cut),
    placed AS (SELECT doc_id, s, unnest(range(len(s))) AS i FROM sentences),
    found AS (SELECT doc_id, i, known[s[i + 1]] AS letter FROM placed, m
              WHERE known[s[i + 1]] IS NOT NULL),
    gaps AS (SELECT doc_id, i, letter,
                    CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 1
                         THEN '-' ELSE '' END AS gap FROM found),
    spelled AS (SELECT doc_id, string_agg(i || ':' || letter, ',' ORDER BY i) AS sentences,
                       string_agg(gap || letter, '' ORDER BY i) AS seq
                FROM gaps GROUP BY doc_id)
    SELECT doc_id, coalesce(sentences, '') AS licence_sentences,
           coalesce(array_to_string(list_transform(
               regexp_extract_all(seq, {_quoted(licence_rules())}), lambda x: names[x]), ','), '')
           AS licences
    FROM documents LEFT JOIN spelled USING (doc_id), m
    """


@query("op4_license_scan", _licence_sql())
def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    sentences = F.transform(
        "licence_sentences", lambda x: F.concat_ws(":", x["position"], x["letter"])
    )
    return scan_licences(_documents(spark, folder)).select(
        "doc_id",
        F.array_join(sentences, ",").alias("licence_sentences"),
        F.array_join("licences", ",").alias("licences"),
    )


def _secret_sql() -> str:
    found = " UNION ALL ".join(
        f"SELECT doc_id, {_quoted(name)} AS name,"
        f" regexp_split_to_array(t, {_quoted(pattern)}) AS gaps,"
        f" regexp_extract_all(t, {_quoted(pattern)}, 0) AS hits,"
        f" regexp_extract_all(t, {_quoted(pattern)}, {group}) AS counted"
        f" FROM (SELECT doc_id, {_quoted(' ') + ' ||' if name == PADDED else ''} t AS t FROM flagged)"
        f" WHERE regexp_matches(t, {_quoted(pattern)})"
        for name, (pattern, group) in PATTERNS.items()
    )
    mixed = " AND ".join(f"regexp_matches(counted[i], {_quoted(c)})" for c in CLASSES)
    apart = ", ".join(map(_quoted, APART))
    kinds = ", ".join(
        f"({_quoted(kind)}, {rank}, {_quoted(name)}, {least}, {most or 2**31 - 1},"
        f" {_quoted(side)}, {weak})"
        for rank, (kind, (name, least, most, side, weak)) in enumerate(KINDS.items())
    )
    return f"""
    WITH flagged AS (SELECT doc_id, coalesce(text, '') AS t FROM documents
                     WHERE regexp_matches(coalesce(text, ''), {_quoted(FIRST_LOOK)})),
    found AS ({found}),
    one AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found),
    told AS (SELECT doc_id, name, length(counted[i]) AS counted, length(hits[i]) AS size,
                    list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                    + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0)
                    AS start FROM one WHERE name <> {_quoted(PADDED)} OR ({mixed})),
    placed AS (SELECT doc_id, name, counted,
                      CASE WHEN name = {_quoted(PADDED)} THEN counted ELSE size END AS size,
                      CASE WHEN name = {_quoted(PADDED)} THEN start + size - counted - 1
                           ELSE start END AS start FROM told),
    kinds(kind, rank, name, least, most, side, weak) AS (VALUES {kinds}),
    parts AS (SELECT doc_id, kind, rank, side, weak, start::BIGINT AS s,
                     (start + size)::BIGINT AS e
              FROM placed JOIN kinds USING (name) WHERE counted BETWEEN least AND most),
    shown AS (SELECT * FROM parts p WHERE NOT weak OR EXISTS (
                  SELECT 1 FROM parts q WHERE q.doc_id = p.doc_id AND q.side <> p.side
                  AND q.s < p.e + {REACH} AND q.e > p.s - {REACH}
                  AND (p.kind NOT IN ({apart}) AND q.kind NOT IN ({apart})
                       OR q.e <= p.s OR q.s >= p.e))),
    listed AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
                      count(*) FILTER (kind = 'access') AS n_access,
                      count(*) FILTER (kind = 'hex') AS n_hex,
                      string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank)
                      FILTER (NOT weak) AS base,
                      string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
               FROM shown GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
           coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
           coalesce(spans, '') AS spans
    FROM documents LEFT JOIN listed USING (doc_id)
    """


@query("op5_secret_scan", _secret_sql())
def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    spans = F.col("secret_spans")

    def count(kind: str):
        return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")

    return scan_secrets(_documents(spark, folder)).select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(base_spans(spans)), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )


@query("op6_simhash_dedup")
def op6_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return with_components(with_fingerprints(_documents(spark, folder)).drop("text"))


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(_documents(spark, folder))


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trips(_documents(spark, folder), path).drop("text")


@query("op8_document_fingerprints")
def op8_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )
    return map_with_next(_documents(spark, folder), edited_rows, schema)


@query("op2_language_id")
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder, "lang").withColumn(
        "held_out", F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    )
    model = train(docs.where(~F.col("held_out")))
    return identify_languages(docs.drop("lang"), model).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def _quality_sql() -> str:
    steps = ", ".join(
        f"({_quoted(rule)}, {i}, {cutoff})"
        for rule, (_, _, _, ladder) in QUALITY_RULES.items()
        for i, cutoff in enumerate(ladder)
    )
    counted = " UNION ALL ".join(
        f"SELECT doc_id, stratum, {_quoted(rule)} AS rule, {unit} * {part} AS part,"
        f" {whole} AS whole FROM base WHERE NOT base_failed"
        for rule, (part, whole, unit, _) in QUALITY_RULES.items()
    )
    risk = RISK / len(QUALITY_RULES)
    return rf"""
    WITH d AS (SELECT doc_id, coalesce('=' || lang, '') AS stratum, coalesce(text, '') AS t
               FROM documents),
    cut AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x09-\x0D ]+'),
                                  lambda x: x <> '') AS w,
                   list_filter(string_split(t, chr(10)),
                               lambda x: regexp_matches(x, '[^\x09-\x0D ]')) AS l FROM d),
    windows AS (SELECT doc_id, p, [w[p], w[p + 1], w[p + 2]] AS g
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM cut)),
    again AS (SELECT doc_id, p FROM windows
              QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
    repeated AS (SELECT doc_id, count(DISTINCT i) AS n
                 FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS i FROM again) GROUP BY doc_id),
    counted AS (SELECT doc_id, stratum, len(w) AS n_words,
                       length(regexp_replace(t, '[\x09-\x0D ]', '', 'g')) AS word_chars,
                       length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                       len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
                       coalesce(n, 0) AS n_repeat_words
                FROM cut LEFT JOIN repeated USING (doc_id)),
    base AS (SELECT *, n_words < {LEAST_WORDS}
                       OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed
             FROM counted),
    long AS ({counted}),
    steps(rule, step, cutoff) AS (VALUES {steps}),
    told AS (SELECT doc_id, min(quality) = 1 AS good FROM labels
             WHERE quality IN (0, 1) GROUP BY doc_id),
    sums AS (SELECT stratum, rule, step, cutoff, count(*) FILTER (good) AS n,
                    count(*) FILTER (good AND part > cutoff * whole) AS k,
                    count(*) FILTER (NOT good AND part > cutoff * whole) AS bad
             FROM long JOIN told USING (doc_id) JOIN steps USING (rule) GROUP BY ALL),
    m AS (SELECT count(DISTINCT stratum) * {len(QUALITY_RULES)} AS tests FROM sums WHERE n > 0),
    certified AS (
        SELECT * FROM sums, m WHERE n > 0 AND k < n * {risk}::DOUBLE AND {DOUBT}::DOUBLE / tests >=
            list_sum(list_transform(range(0, k + 1), lambda i: exp(
                lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                + i * ln({risk}::DOUBLE) + (n - i) * ln(1 - {risk}::DOUBLE))))),
    cutoffs AS (SELECT stratum, rule, cutoff FROM certified
                QUALIFY row_number() OVER (PARTITION BY stratum, rule
                                           ORDER BY bad DESC, step) = 1),
    rejected AS (SELECT DISTINCT doc_id FROM long JOIN cutoffs USING (stratum, rule)
                 WHERE part > cutoff * whole)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines,
           n_repeat_words, base_failed, NOT base_failed AND r.doc_id IS NULL AS kept
    FROM base LEFT JOIN rejected r USING (doc_id)
    """


@query("op11_quality_rules", _quality_sql())
def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    counted = with_counts(_documents(spark, folder, "lang")).drop("text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return with_verdicts(counted, labels).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def _embeddings(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", *more)


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return component_rows(_embeddings(spark, folder)).select(
        "vec_id",
        "component",
        "n",
        F.col("deviation").cast("long"),
        "whitened",
        "explained",
        "identity_error",
    )


@query(
    "op13_hard_negatives",
    """
    WITH v AS (SELECT vec_id,
                      CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
               FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(
                   embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                 list_dot_product(a.q, b.q)::BIGINT AS score
          FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
    n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score,
                 row_number() OVER (PARTITION BY anchor_id, positive_id
                                    ORDER BY s.score DESC, s.id) AS rank
          FROM p JOIN s USING (anchor_id)
          WHERE NOT same AND 80 * positive_score <= 100 * score
            AND 100 * score <= 100 * positive_score)
    SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score
    FROM n WHERE rank <= 5
    """,
)
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _embeddings(spark, folder, "label").withColumn("label", changed)
    return mine_hard_negatives(vectors).drop("positive_rank")
