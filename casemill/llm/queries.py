"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import prepare
from . import chat, collocations, divergence, embedding_dedup, hamming_search, licenses, line_dedup, mixing, ngram_join, sentencepiece, substring_dedup, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, table: str, sql: str | None = None):
    """Register ``fn(rows of the table)`` under a name."""

    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@query("op1_sentencepiece", "documents")
def op1(docs: DataFrame) -> DataFrame:
    told = sentencepiece.decode(sentencepiece.encode(docs.select("doc_id", "text")))
    return told.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), "parity",
                       F.sha2("decoded", 256).alias("decoded_sha256"), F.equal_null("decoded", "text").alias("round_trip"))


@query("op2_license_scan", "documents")
def op2(docs: DataFrame) -> DataFrame:
    return licenses.scan_licenses(docs.select("doc_id", "text")).drop("spans")


@query("op3_ngram_jaccard_join", "documents")
def op3(docs: DataFrame) -> DataFrame:
    return ngram_join.similar(docs, shingle=3, threshold=90)


@query("op7_line_dedup", "documents")
def op7(docs: DataFrame) -> DataFrame:
    cut = line_dedup.remove_lines(docs, run=1)
    return cut.select("doc_id", F.col("n_removed_lines").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


@query("op8_substring_dedup", "documents")
def op8(docs: DataFrame) -> DataFrame:
    return substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_mix_sources", "documents")
def op4(docs: DataFrame) -> DataFrame:
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


_MARKERS = " ".join(f"WHEN '{role}' THEN {len(a) + len(b)}" for role, (a, b, _) in chat.TEMPLATE.items())
_ESCAPED = "replace(t, chr(92), chr(92) || '0')"
for _k, _control in enumerate(chat.CONTROLS, 1):
    _ESCAPED = f"replace({_ESCAPED}, '{_control}', chr(92) || '{_k}')"


@query("op5_chat_format", "conversations", f"""
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_ESCAPED}) + CASE r {_MARKERS} END) AS BIGINT) AS formatted_chars,
  CASE WHEN bool_and(fits) THEN max_by(r, turn) ELSE 'invalid' END AS state
FROM (SELECT *, coalesce((r = 'system' AND n = 1) OR (r = 'user' AND coalesce(last, 'assistant') <> 'user')
        OR (r = 'assistant' AND last = 'user'), false) AS fits
      FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t, row_number() OVER w AS n, lag(role) OVER w AS last
            FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL
                  SELECT -7, * FROM (VALUES (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]')) AS v(a, b, c)) c
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)) d) e
GROUP BY conv_id""")
def op5(conversations: DataFrame) -> DataFrame:
    extra = conversations.sparkSession.sql("""
        SELECT bigint(-7) AS conv_id, * FROM VALUES (bigint(0), 'user', '</s>[INST] ok [/INST]'), (bigint(1), 'assistant', '</s>[INST] ok [/INST]')
        AS v(turn, role, text)""")
    return chat.digests(chat.format_chat(conversations.select("conv_id", "turn", "role", "text").union(extra)))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (prepare(spark).read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    held_out, score = toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxic_score").alias("score")
    return scored.select("doc_id", held_out, score, (score >= toxicity.THRESHOLD).cast("int").alias("predicted"))


QUERIES["op10_toxicity"] = op10


@query("op6_embedding_near_dedup", "embeddings")
def op6(vectors: DataFrame) -> DataFrame:
    return embedding_dedup.near_duplicates(vectors)


@query("op9_exact_top_k", "embeddings", """
WITH codes AS (
  SELECT vec_id, list_aggregate([CASE WHEN embedding[i] > 0 THEN CAST(1 AS UBIGINT) << (i - 1) ELSE 0 END for i in range(1, 65)], 'bit_or') AS code
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) = 64)
SELECT * FROM (
  SELECT q.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY bit_count(xor(q.code, c.code)), c.vec_id) AS rank,
    c.vec_id AS neighbour, CAST(bit_count(xor(q.code, c.code)) AS BIGINT) AS distance
  FROM codes q JOIN codes c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0) r
WHERE rank <= 10""")
def op9(vectors: DataFrame) -> DataFrame:
    return hamming_search.top_k(vectors)


@query("op11_collocations", "documents", r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS i, regexp_extract_all(piece, '[^ \t]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents) d),
places AS (SELECT lang, i, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM pieces),
runs AS (
  SELECT lang, x, x || ' ' || lead(x, 1) OVER o AS x2, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o AS x3,
    x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o AS x4
  FROM places WINDOW o AS (PARTITION BY i ORDER BY k)),
f AS (
  SELECT lang, 1 AS m, x AS phrase, count(*) AS f FROM runs GROUP BY ALL
  UNION ALL SELECT lang, 2, x2, count(*) FROM runs WHERE x2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, 3, x3, count(*) FROM runs WHERE x3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, 4, x4, count(*) FROM runs WHERE x4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE m > 1),
cuts AS (SELECT *, unnest(generate_series(1, m - 1)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.m, c.a, k, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * c.a) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:c.m], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, a, array_to_string(w[s:s + z - 1], ' ') AS phrase
        FROM (SELECT *, unnest(generate_series(1, m - z + 1)) AS s FROM (SELECT *, unnest(generate_series(2, m - 1)) AS z FROM candidates WHERE m > 2) t) u) v
  GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank, s.phrase, a, l, r, n, score
FROM scored s JOIN totals t ON t.lang = s.lang LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
QUALIFY rank <= 2000""")
def op11(docs: DataFrame) -> DataFrame:
    return collocations.collocations(docs)


@query("op12_source_divergence", "documents", r"""
WITH tokens AS (
  SELECT i, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents) d),
kept AS (SELECT lang, term FROM tokens GROUP BY ALL HAVING count(DISTINCT i) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
counts AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM tokens t JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, v, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM groups g JOIN kept k USING (lang) JOIN sizes USING (lang) LEFT JOIN counts c ON (c.lang, c.source, c.term) = (g.lang, g.source, k.term)),
p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS p FROM cells),
q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
  FROM (SELECT lang, term, sum(n) AS n, any_value(v) AS v FROM cells GROUP BY ALL) s),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN p x ON (x.lang, x.source) = (a.lang, a.source)
    LEFT JOIN p y ON (y.lang, y.source, y.term) = (b.lang, b.source, x.term)
  GROUP BY ALL
  UNION ALL
  SELECT p.lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 10""")
def op12(docs: DataFrame) -> DataFrame:
    return divergence.audit(docs)


@query("op13_warc", "pages", """
SELECT page_id, bytes AS payload_bytes, payload_digest, CASE WHEN page_id > least THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > least THEN least END AS refers_to
FROM (SELECT page_id, CAST(strlen(html) AS BIGINT) AS bytes, sha256(html) AS payload_digest, CASE WHEN strlen(html) >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS least
      FROM (SELECT page_id, coalesce(html, '') AS html FROM pages) p) d""")
def op13(pages: DataFrame) -> DataFrame:
    captured = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod("page_id", F.lit(100_000_000)))
    index = warc.merged_index(pages.sparkSession, warc.write_archives(pages, captured))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
