"""Registered queries of this subpackage: name -> fn(spark, sf_dir), and their DuckDB SQL."""

from __future__ import annotations

import functools

import public_tokenizers

from lakekit.llm.common import ready, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            return fn(ready(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@query("op2_quality_classifier")
def op2(spark, sf_dir):
    from lakekit.llm.quality_model import classify_quality
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_bpe_codec")
def op3(spark, sf_dir):
    from lakekit.llm.bpe_codec import bpe_digests
    return bpe_digests(table(spark, sf_dir, "documents"), WORD_BPE)


@query("op5_token_counts")
def op5(spark, sf_dir):
    from lakekit.llm.token_counts import unigram_token_counts
    return unigram_token_counts(table(spark, sf_dir, "documents"), PIECES)


@query("op7_best_fit_packing")
def op7(spark, sf_dir):
    from lakekit.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), WORD_BPE)


@query("op9_language_id")
def op9(spark, sf_dir):
    from lakekit.llm.language_id import identify_languages
    return identify_languages(table(spark, sf_dir, "documents"))


@query("op6_pii")
def op6(spark, sf_dir):
    from lakekit.llm.pii import find_pii
    return find_pii(table(spark, sf_dir, "documents"))


_SQL_WORDS = r"[x FOR x IN regexp_split_to_array({}, '[\x20\x09-\x0D]+') IF x <> '']"


_SQL_RULES = {"short": "n_words < 10", "repeats": "100 * n_repeat_words > 20 * n_words", "symbols": "10 * n_symbols > word_chars",
              "same_lines": "5 * n_dup_lines > n_words", "long_words": "word_chars > 15 * n_words"}


def _sql_host_rules() -> str:
    """The measures by windows over words, the hosts' beta prior by moments."""
    sums = ", ".join(f"sum(({r})::INT) AS {k}" for k, r in _SQL_RULES.items())
    moments = ", ".join(f"sum({k}) / sum(n)::DOUBLE AS m_{k}, sum({k}::DOUBLE * {k} / n / n) / count(*) - (sum({k}::DOUBLE / n) / count(*)) ** 2 "
                        f"- sum({k}) / sum(n)::DOUBLE * (1 - sum({k}) / sum(n)::DOUBLE) * sum(1.0::DOUBLE / n) / count(*) AS s_{k}" for k in _SQL_RULES)
    weights = ", ".join(f"m_{k}, CASE WHEN s_{k} > 0 THEN least(greatest(m_{k} * (1 - m_{k}) / s_{k} - 1, 1), 1e6) ELSE 1e6 END AS w_{k}" for k in _SQL_RULES)
    bad = " OR ".join(f"({k} + m_{k} * w_{k}) / (n + w_{k}) > 0.5" for k in _SQL_RULES)
    blank = r"regexp_matches(x, '[^\x20\x09-\x0D]')"
    return f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {_SQL_WORDS.format("coalesce(text, '')")} AS words,
                  [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF {blank}] AS lines FROM documents),
i AS (SELECT doc_id, unnest(range(1, len(words) - 3)) AS i, words FROM d WHERE len(words) >= 5),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 4], ' ')) AS times FROM i),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM g, range(0, 5) t(k) WHERE times > 1 GROUP BY doc_id),
q AS (SELECT d.doc_id, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
      FROM d LEFT JOIN r USING (doc_id)),
h AS (SELECT source, count(*) AS n, {sums} FROM q WHERE source IS NOT NULL GROUP BY source),
m AS (SELECT {weights} FROM (SELECT {moments} FROM h)),
bad AS (SELECT source FROM h, m WHERE {bad})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {_SQL_RULES["short"]} OR {_SQL_RULES["repeats"]} AS base_failed,
       NOT ({_SQL_RULES["short"]} OR {_SQL_RULES["repeats"]}) AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept
FROM q"""


@query("op8_host_rules", _sql_host_rules())
def op8(spark, sf_dir):
    from lakekit.llm.host_rules import judge_documents
    return judge_documents(table(spark, sf_dir, "documents"))


_SQL_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     f AS (SELECT html, min(page_id) AS first FROM p WHERE octet_length(encode(html)) >= 100 GROUP BY html)
SELECT p.page_id, CAST(octet_length(encode(p.html)) AS BIGINT) AS payload_bytes, sha256(p.html) AS payload_digest,
       CASE WHEN f.first IS NOT NULL AND f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f USING (html)
"""


@query("op4_warc", _SQL_WARC)
def op4(spark, sf_dir):
    from lakekit.llm.warc import round_trip
    return round_trip(table(spark, sf_dir, "pages"))


_SQL_JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_SQL_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_distinct([array_to_string(words[i:i + 2], ' ') FOR i IN range(1, len(words) - 1)]) END AS grams FROM w),
g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) + any_value(b.n) AS sizes, count(*) AS shared
      FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p WHERE 100 * shared >= 90 * (sizes - shared)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, c.component_id FROM s JOIN c ON c.x = s.doc_id
"""


@query("op10_jaccard_join", _SQL_JACCARD)
def op10(spark, sf_dir):
    from lakekit.llm.jaccard_join import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"))


_SQL_EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT e.vec_id, COALESCE(n.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e LEFT JOIN n ON n.x = e.vec_id JOIN c ON c.x = e.vec_id
"""


@query("op1_embedding_dedup", _SQL_EMBEDDINGS)
def op1(spark, sf_dir):
    from lakekit.llm.embedding_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op11_token_files")
def op11(spark, sf_dir):
    from lakekit.llm.token_files import round_trip
    return round_trip(table(spark, sf_dir, "documents"), WORD_BPE)


# crc32 of a string's UTF-8 bytes: the table of all bytes, then one step a byte
_SQL_CRC_TABLE = """crc_steps AS (SELECT i, 0 AS k, i::BIGINT AS c FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM crc_steps WHERE k = 8)"""


def _sql_crc(value: str) -> str:
    """crc32 of the string ``value``, where ``crc_table`` is joined."""
    return (f"xor(list_reduce([('0x' || x)::BIGINT FOR x IN regexp_extract_all(hex(encode({value})), '..')], "
            "lambda c, x: xor(c >> 8, crcs[1 + (xor(c, x) & 255)]), 4294967295::BIGINT), 4294967295)")


# Equal three-word stretches q apart; those at neighbouring places are one run.
_SQL_RUNS = f"""
WITH RECURSIVE {_SQL_CRC_TABLE},
o AS (SELECT doc_id, {_sql_crc("doc_id::VARCHAR")} AS h, {_SQL_WORDS.format("coalesce(text, '')")} AS words FROM documents, crc_table),
c AS (SELECT *, len(words) AS n, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a FROM o),
d AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN words ELSE [words[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) ELSE i END]
             FOR i IN range(0, n)] END AS words FROM c),
p AS (SELECT doc_id, n, words, unnest(range(0, n)) AS i FROM d),
g AS (SELECT doc_id, n, i, array_to_string(words[i + 1:i + 3], ' ') AS gram FROM p WHERE i + 3 <= n),
e AS (SELECT x.doc_id, y.i - x.i AS q, x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS island, x.i
      FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.gram = y.gram AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
r AS (SELECT doc_id, start, length, min(q) AS period FROM (SELECT doc_id, q, min(i) AS start, max(i) - min(i) + 3 + q AS length FROM e GROUP BY doc_id, q, island)
      WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
m AS (SELECT doc_id, count(*) AS n_runs, first(struct_pack(start, length, period) ORDER BY length / period DESC, start, period) AS top,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM r GROUP BY doc_id),
k AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
s AS (SELECT p.doc_id, string_agg(words[p.i + 1], ' ' ORDER BY p.i) AS kept FROM p LEFT JOIN k ON k.doc_id = p.doc_id AND k.i = p.i WHERE k.i IS NULL GROUP BY p.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, top.start::BIGINT AS start, top.length::BIGINT AS length, top.period::BIGINT AS period,
       (1000 * top.length // top.period)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN m USING (doc_id) LEFT JOIN s USING (doc_id)
"""


@query("op12_periodic_runs", _SQL_RUNS)
def op12(spark, sf_dir):
    from lakekit.llm.periodic_runs import run_digests
    return run_digests(table(spark, sf_dir, "documents"))


def _sql_features(table: str, of: str) -> str:
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""{of}_words AS (SELECT *, {words} AS words FROM {table}),
{of} AS (SELECT * EXCLUDE (words), len(words) AS n_words, list_concat(words, [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) AS feats FROM {of}_words)"""


_SQL_RESAMPLING = f"""
WITH RECURSIVE {_SQL_CRC_TABLE},
{_sql_features("documents", "d")},
{_sql_features("benchmark", "b")},
x AS (SELECT doc_id, unnest(feats) AS f FROM d),
y AS (SELECT unnest(feats) AS f FROM b),
h AS (SELECT f, {_sql_crc("f")} % 10000 AS bucket FROM (SELECT f FROM x UNION SELECT f FROM y), crc_table),
s AS (SELECT bucket, count(*)::DOUBLE AS s FROM x JOIN h USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*)::DOUBLE AS t FROM y JOIN h USING (f) GROUP BY bucket),
g AS (SELECT r.bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000) / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))))::BIGINT AS gain
      FROM range(10000) r(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
w AS (SELECT doc_id, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM x JOIN h USING (f) JOIN g USING (bucket) GROUP BY doc_id),
c AS (SELECT doc_id, n_words, len(feats)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN w USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM c WHERE n_words >= 20)
SELECT c.doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank FROM c LEFT JOIN r USING (doc_id)
"""


@query("op13_importance_resampling", _SQL_RESAMPLING)
def op13(spark, sf_dir):
    from lakekit.llm.importance_resampling import resample
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
