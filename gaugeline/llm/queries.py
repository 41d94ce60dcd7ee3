"""One query per corpus operator, over its whole table, and the SQL that must agree with it where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeline.llm import bpe, embed, factor_machine, filter_audit, lines, minhash, packing, pii, quality_rules, token_files, toxicity, vector_codes, warc
from gaugeline.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"))


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages"))


@query
def op4_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.neighbours(table(spark, sf_dir, "embeddings"))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.sequences(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss")


@query
def op6_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents")).drop("mark")


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = lines.remove(docs)
    return kept.select("doc_id", "text", F.char_length("text").alias("kept_chars"))


@query
def op9_factor_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = factor_machine.fit(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 4) != 2, ["n_chars"])
    scored = factor_machine.score(docs, machine, ["n_chars"])
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes(table(spark, sf_dir, "embeddings")).drop("label")


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Every distance of every part to every entry, round by round; distances of integers are exact in doubles."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
     m{n} AS (SELECT r, i, min((list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c))::BIGINT * {entries} + k) AS m
            FROM p JOIN c{n} USING (i) GROUP BY r, i)""")
        if n < rounds:
            steps.append(f"""
     u{n} AS (SELECT i, m % {entries} AS k, j, sum(x[j]::BIGINT) AS s, count(*) AS n FROM m{n} JOIN p USING (r, i), (SELECT unnest(range(1, (SELECT max(len(x)) FROM p) + 1)) AS j) GROUP BY ALL),
     c{n + 1} AS (SELECT i, k, coalesce(w, c) AS c FROM c{n} LEFT JOIN (
            SELECT i, k, list(((s - ((s % n + n) % n)) // n)::DOUBLE ORDER BY j) AS w FROM u{n} GROUP BY i, k) USING (i, k))""")
    return f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding, label) AS r, vec_id, label, list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)) AS v
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     p AS (SELECT r, i, v[i * (len(v) // {parts}) + 1 : (i + 1) * (len(v) // {parts})] AS x FROM v, (SELECT unnest(range({parts})) AS i)),
     c0 AS (SELECT i, r - 1 AS k, x AS c FROM p WHERE r <= {entries}),{",".join(steps)},
     e AS (SELECT r, string_agg(format('{{:02x}}', (m % {entries})::INT), '' ORDER BY i) AS code, sum(m // {entries})::BIGINT AS error FROM m{rounds} GROUP BY r),
     h AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY i, k)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM v JOIN e USING (r), h"""


ORACLES["op11_vector_codes"] = _codes_sql()


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


@query
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.roundtrip(table(spark, sf_dir, "documents"))


#: Orders are five-fold joins of the letters; Shapley sums are taken over all orders as they stand.
ORACLES["op12_filter_audit"] = r"""
WITH w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least
           FROM (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents)),
     l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
     m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                  (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
                  + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
                  + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > least, false)::INT AS mask
           FROM w LEFT JOIN l USING (doc_id)),
     g AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
     f(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
     o AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
           FROM f a JOIN f b ON b.bit <> a.bit JOIN f c ON c.bit NOT IN (a.bit, b.bit)
           JOIN f d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN f e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
     s AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
     r AS (SELECT part, filter_order, step, own,
                  coalesce(sum(n) FILTER (mask & (own | earlier) = 0), 0) AS kept,
                  coalesce(sum(n) FILTER (mask & own <> 0 AND mask & earlier = 0), 0) AS removed,
                  coalesce(sum(n) FILTER (mask & own <> 0 AND mask & earlier <> 0), 0) AS redundant,
                  coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
                  coalesce(sum(good) FILTER (mask & own <> 0 AND mask & earlier = 0), 0) AS good_lost,
                  coalesce(sum(toxic) FILTER (mask & own <> 0 AND mask & earlier = 0), 0) AS toxic_lost
           FROM g, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r"""


def _pii_sql() -> str:
    """The contract's patterns in DuckDB's dialect. Positions are sums of the lengths of pieces and matches.

    IBANs end here where the run of capitals and digits does: the dialect knows no lookahead to stop at their country's length.
    """
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}",
        "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    }
    alone = "NOT regexp_matches(right(p, 1), '^[A-Za-z0-9]$') AND NOT regexp_matches(left(q, 1), '^[A-Za-z0-9]$')"
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = f"list_sum(list_transform(string_split(reverse({digits}), ''), lambda c, i: CASE WHEN i % 2 = 1 THEN c::INT WHEN c::INT > 4 THEN c::INT * 2 - 9 ELSE c::INT * 2 END)) % 10 = 0"
    moved = "concat(substr(replace(m, ' ', ''), 5), left(m, 4))"
    mod97 = f"list_reduce(list_prepend(0, list_transform(string_split({moved}, ''), lambda c: ascii(c))), lambda a, n: CASE WHEN n >= 65 THEN (a * 100 + n - 55) % 97 ELSE (a * 10 + n - 48) % 97 END) = 1"
    near = "lower(concat(substr(t, greatest(s - 39, 1), least(s, 40)), ' ', substr(t, s + length(m) + 1, 40)))"
    good = {
        "email": "true",
        "ip": "len(list_filter(string_split(m, '.'), lambda x: ltrim(x, '0') <> '' AND (length(ltrim(x, '0')) > 3 OR ltrim(x, '0')::INT > 255))) = 0",
        "card": f"CASE WHEN length({digits}) BETWEEN 12 AND 19 THEN {luhn} ELSE false END",
        "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": f"{alone} AND CASE WHEN true THEN {mod97} END",
        "ssn": f"{alone} AND regexp_matches({near}, 'ssn|social|security')",
    }
    parts = []
    for rank, (kind, pattern) in enumerate(patterns.items()):
        parts.append(f"""
        {kind}_ AS (
          SELECT r, {rank} AS k, s, s + length(m) AS e,
                 least(1.0, {pii.SCORES[kind]} + CASE WHEN regexp_matches({near}, '{pii.CONTEXT[kind]}') THEN 0.3 ELSE 0 END)::DOUBLE AS score
          FROM (SELECT r, t, a[i] AS p, m[i] AS m, a[i + 1] AS q,
                       (list_sum(list_transform(a[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
                FROM (SELECT r, t, a, m, unnest(range(1, len(m) + 1)) AS i
                      FROM (SELECT r, t, string_split_regex(t, '{pattern}') AS a, regexp_extract_all(t, '{pattern}') AS m
                            FROM docs WHERE regexp_matches(t, '{pattern}'))))
          WHERE {good[kind]})""")
    return f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), {",".join(parts)},
      spans AS ({" UNION ALL ".join(f"SELECT '{k}' AS kind, * FROM {k}_" for k in patterns)})
      SELECT doc_id, {", ".join(f"count(s) FILTER (k = {i}) AS n_{k}" for i, k in enumerate(pii.BASE))},
             sha256(coalesce(string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, k) FILTER (k < 4), '')) AS base_sha256,
             coalesce(string_agg(concat(kind, ':', s, ':', e), ',' ORDER BY s, k) FILTER (s IS NOT NULL), '') AS spans,
             coalesce(string_agg(format('{{:.1f}}', score), ',' ORDER BY s, k) FILTER (s IS NOT NULL), '') AS scores
      FROM docs LEFT JOIN spans USING (r) GROUP BY r, doc_id"""


ORACLES["op7_pii"] = _pii_sql()

#: Base32 of a SHA-1 has 32 characters of 5 bits, read from its binary form.
ORACLES["op3_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     d AS (SELECT page_id, strlen(h) AS payload_bytes, max(page_id) OVER (PARTITION BY h) AS top,
                  list_aggregate(list_transform(string_split(sha1(h), ''), lambda c: lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0')), 'string_agg', '') AS bits
           FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         list_sum(list_transform(range(0, 5), lambda j: substr(bits, (i * 5 + j + 1)::INT, 1)::INT * (16 // (2 ** j)::INT)))::INT + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d"""
