"""The queries of this subpackage: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    ball_codes,
    compression,
    exact,
    lattice,
    lines,
    mixing,
    packing,
    pages,
    planes,
    secret_scan,
    simhash,
    spelling,
    url_cascade,
)
from strata.llm.common import documents, table
from strata.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bit_planes(spark, sf_dir):
    """Ids of every document, written to files of byte planes and read back."""
    path = scratch_path(spark, "planes")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    planes.write_ids(documents(spark, sf_dir), path, tokenizer, end_id=2)
    stored = planes.read_ids(spark, path)
    return stored.select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op2_simhash_pivots(spark, sf_dir):
    """Fingerprint and group of near-duplicates of every document."""
    return simhash.near_groups(documents(spark, sf_dir))


@query
def op3_exact_refined(spark, sf_dir):
    """Group of exact copies of every document."""
    return exact.exact_groups(documents(spark, sf_dir), digests=True)


@query
def op4_compression_quality(spark, sf_dir):
    """Quality score of every document, learnt from two thirds of the labels."""
    return compression.quality_scores(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op5_line_first(spark, sf_dir):
    """Base rules and verdict of the line rules on every document."""
    return lines.line_first(documents(spark, sf_dir)).drop("cleaned")


@query
def op6_bin_completion(spark, sf_dir):
    """Places of all pieces of documents in sequences of 2048 tokens."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.packed(documents(spark, sf_dir), tokenizer, end_id=0).drop("ids")


@query
def op7_structural_secrets(spark, sf_dir):
    """Secrets of every document: base patterns, and what decoding confirms."""
    found = secret_scan.find_secrets(documents(spark, sf_dir))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def listed(spans):
        named = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(named, ",")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query
def op8_lattice_scores(spark, sf_dir):
    """Log probability of every document by token counts and by the subword lattice."""
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    return lattice.lattice_scores(documents(spark, sf_dir), vocabulary)


@query
def op9_flow_mixing(spark, sf_dir):
    """What the mix of sources takes of every document."""
    return mixing.mix(documents(spark, sf_dir)).drop("copies")


@query
def op10_tree_scoring(spark, sf_dir):
    """Main text of every page."""
    return pages.page_texts(table(spark, sf_dir, "pages"))


@query
def op11_url_cascade(spark, sf_dir):
    """Host, path, rule and verdict of the url of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = url_cascade.judged(pages, url_cascade.default_listing(spark))
    return found.select("row.page_id", "host", "path", "rule", "verdict")


@query
def op12_pivotal_spelling(spark, sf_dir):
    """Frequent words, their near words and the form each is a variant of."""
    found = spelling.runs(documents(spark, sf_dir))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    h, size = F.crc32(F.concat(name, F.lit(":"), "run")), F.char_length("run")
    # One in 199 runs loses a letter.
    slipped = F.concat(F.expr("substring(run, 1, cast(_h % _size as int))"),
                       F.expr("substring(run, cast(_h % _size as int) + 2)"))
    words = found.select("run", h.alias("_h"), size.alias("_size")).select(
        F.when(F.col("_h") % 199 == 0, slipped).otherwise(F.col("run")).alias("word")
    )
    return spelling.variants(spelling.counted(words))


@query
def op13_ball_codes(spark, sf_dir):
    """Codes of all vectors, four parts with 256 entries each."""
    return ball_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


def _code_rounds(parts: int, entries: int, rounds: int) -> str:
    """Common tables of SQL that assign parts and move entries, round by round."""
    tables = []
    for r in range(rounds + 1):
        tables.append(f"""
        d{r} AS MATERIALIZED (
            SELECT v.row_id, v.part, b.entry,
                   list_sum(list_transform(list_zip(v.x, b.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
            FROM pieces v JOIN b{r} b ON v.part = b.part
        ),
        a{r} AS MATERIALIZED (
            SELECT row_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM d{r} GROUP BY ALL
        )""")
        if r < rounds:
            tables.append(f"""
        m{r} AS (
            SELECT part, entry, list(floor_mean ORDER BY place) AS x FROM (
                SELECT a.part, a.entry, place,
                       (sum(v.x[place]) - ((sum(v.x[place]) % count(*)) + count(*)) % count(*)) // count(*) AS floor_mean
                FROM a{r} a JOIN pieces v ON a.row_id = v.row_id AND a.part = v.part,
                     unnest(range(1, len(v.x) + 1)) AS p(place)
                GROUP BY a.part, a.entry, place)
            GROUP BY part, entry
        ),
        b{r + 1} AS MATERIALIZED (
            SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
            FROM b{r} b LEFT JOIN m{r} m ON b.part = m.part AND b.entry = m.entry
        )""")
    return ",".join(tables)


ORACLE = {
    "op13_ball_codes": f"""
        WITH whole AS MATERIALIZED (
            SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS row_id,
                   list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        pieces AS MATERIALIZED (
            SELECT row_id, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS x
            FROM whole, unnest(range(4)) AS p(part)
        ),
        b0 AS MATERIALIZED (
            SELECT part, row_id - 1 AS entry, x FROM pieces WHERE row_id <= 256
        ),
        {_code_rounds(4, 256, 4)},
        coded AS (
            SELECT row_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
            FROM a4 GROUP BY row_id
        )
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM b4) AS codebooks_sha256
        FROM coded JOIN whole USING (row_id)
    """,
    "op11_url_cascade": rf"""
        WITH rules(rule, verdict) AS (VALUES {_values(url_cascade.RULES)}),
        parts(part) AS (VALUES {_values([[p] for p in url_cascade.PARTS])}),
        pieces AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path
            FROM pages
        ),
        cut AS (
            SELECT rule, verdict, split_part(rule, '/', 1) AS name,
                   substr(rule, length(split_part(rule, '/', 1)) + 1) AS start
            FROM rules
        ),
        fits AS (
            SELECT p.*, r.rule, r.verdict,
                   row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC, r.rule) AS place
            FROM pieces p LEFT JOIN cut r
              ON (p.host = r.name OR ends_with(p.host, '.' || r.name)) AND starts_with(p.path, r.start)
        )
        SELECT page_id, host, path, rule,
               coalesce(verdict, CASE WHEN list_has_any(regexp_split_to_array(host, '[.-]'),
                                                        (SELECT list(part) FROM parts))
                                 THEN 'block' ELSE 'allow' END) AS verdict
        FROM fits WHERE place = 1
    """,
    "op3_exact_refined": r"""
        WITH norm AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept,
               text_sha256
        FROM norm WINDOW same AS (PARTITION BY text_sha256)
    """,
}
