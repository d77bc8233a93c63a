"""The corpus operators as queries over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from posttags.llm import (
    collocations,
    decontaminate,
    exact_dedup,
    minhash,
    packing,
    periodic_runs,
    quality,
    quality_rules,
    secrets,
    sharding,
    suffix_dedup,
    toxicity,
    url_filter,
)

TOKENIZER = "byte_bpe_50k.json"
URL_RULES = [
    url_filter.Rule("org", "/", True),
    url_filter.Rule("example.org", "/es/", False),
    url_filter.Rule("example.org", "/en/1", False),
    url_filter.Rule("com", "/fr/", True),
    url_filter.Rule("com", "/de/", False),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate_once(_table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), 16)


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, str(public_tokenizers.path(TOKENIZER)))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def remainder(parts: int, kept: int) -> Column:
    """Whether crc32 of the doc_id as text has this remainder; false for a null doc_id."""
    text = F.col("doc_id").cast("string").cast("binary")
    return F.coalesce(F.crc32(text) % parts == kept, F.lit(False))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    found = quality.classify(docs, labels, remainder(3, 1))
    return found.select("doc_id", remainder(3, 1).alias("held_out"), "score", "predicted")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    found = toxicity.classify(docs, labels, remainder(4, 2))
    return found.select("doc_id", remainder(4, 2).alias("held_out"), "score", "predicted")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.ledger(_table(spark, sf_dir, "documents"))
    return quality_rules.judge(entries, quality_rules.POLICIES[-1]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed",
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    tail = F.floor(number / 10), number % 10 == 0
    found = periodic_runs.find_runs(_table(spark, sf_dir, "documents"), tail)
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256", "n_words",
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_secrets": op2_secrets,
    "op3_decontamination": op3_decontamination,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_sharding": op5_sharding,
    "op6_packing": op6_packing,
    "op7_minhash": op7_minhash,
    "op8_url_filter": op8_url_filter,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_quality_rules": op11_quality_rules,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_collocations": op13_collocations,
}

_LOW = """translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""


def _url_oracle() -> str:
    """Rules, then the two Markov models with their threshold."""
    rules = ", ".join(f"('{r.host}', '{r.path}', {r.allow})" for r in URL_RULES)
    mixed = {"accepted": "1.0 / 33", "rejected": "1.0 / 33"}
    joins = ""
    for size in range(4):
        joins += f"""
            JOIN counts c{size} ON c{size}.size = {size} AND c{size}.context = right(g.context, {size})
                AND c{size}.sign = g.sign
            JOIN contexts h{size} ON h{size}.size = {size} AND h{size}.context = right(g.context, {size})"""
        for side in mixed:
            mixed[side] = f"(c{size}.{side} + 4.0 * ({mixed[side]})) / (h{size}.{side} + 4.0)"
    place = f"least(greatest((score + {url_filter.RANGE}) / {2 * url_filter.RANGE}, 0.0), 1.0)"
    step = 2 * url_filter.RANGE / url_filter.BINS
    return f"""
        WITH urls AS (
            SELECT page_id, url, {_LOW.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
                   regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
            FROM (SELECT page_id, url, CASE WHEN contains(url, '://')
                         THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)),
        rules(rhost, rpath, allow) AS (VALUES {rules}),
        ruled AS (
            SELECT page_id, any_value(url) AS url, any_value(host) AS host, any_value(path) AS path,
                   arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
                   arg_max(allow, length(rhost || rpath)) AS label
            FROM urls LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost))
                 AND starts_with(path, rpath)
            GROUP BY page_id),
        marked AS (
            SELECT *, coalesce(CAST('0x' || substr(md5(url), 1, 8) AS BIGINT) % {url_filter.HOLD} = 0, FALSE) AS held,
                   translate(regexp_replace(regexp_replace({_LOW.format("coalesce(url, '')")}, '^[a-z]*://', ''),
                             '[^a-z0-9/.\\-?=&_#]', '~', 'g'), '123456789=&_#', '000000000????') AS symbols
            FROM ruled),
        spread AS (
            SELECT page_id, label, held, '^^^' || symbols AS s, unnest(generate_series(1, length(symbols))) AS place
            FROM marked WHERE symbols <> ''),
        grams AS (
            SELECT page_id, label, held, substr(s, place, 3) AS context, substr(s, place + 3, 1) AS sign FROM spread),
        counts AS (
            SELECT size, right(context, size) AS context, sign,
                   sum(CASE WHEN label AND NOT held THEN 1 ELSE 0 END) AS accepted,
                   sum(CASE WHEN NOT label AND NOT held THEN 1 ELSE 0 END) AS rejected
            FROM grams, (SELECT unnest([0, 1, 2, 3]) AS size) GROUP BY ALL),
        contexts AS (
            SELECT size, context, sum(accepted) AS accepted, sum(rejected) AS rejected FROM counts GROUP BY ALL),
        model AS (
            SELECT g.context, g.sign, ln(({mixed["accepted"]}) / ({mixed["rejected"]})) AS ratio
            FROM (SELECT DISTINCT context, sign FROM grams) g {joins}),
        scored AS (
            SELECT page_id, round(avg(ratio), 9) AS score FROM grams JOIN model USING (context, sign) GROUP BY page_id),
        judged AS (
            SELECT m.*, coalesce(score, 0.0) AS score FROM marked m LEFT JOIN scored USING (page_id)),
        bins AS (
            SELECT CAST(floor({place} * {url_filter.BINS}) AS INTEGER) AS bin,
                   sum(label::INT) AS good, sum((NOT label)::INT) AS bad
            FROM judged WHERE label IS NOT NULL AND held GROUP BY bin),
        errors AS (
            SELECT bin, 0.5 * (sum(good) OVER (ORDER BY bin) - good) / sum(good) OVER ()
                   + 0.5 * (sum(bad) OVER () - sum(bad) OVER (ORDER BY bin) + bad) / sum(bad) OVER () AS error
            FROM bins),
        best AS (
            SELECT coalesce(arg_min(CAST(bin * {step} - {url_filter.RANGE} AS DOUBLE), (error, bin)), 0.0) AS threshold FROM errors)
        SELECT page_id, host, path, rule,
               CASE WHEN coalesce(label, score >= threshold) THEN 'allow' ELSE 'block' END AS verdict,
               score, threshold FROM judged, best
    """


def _rules_oracle() -> str:
    """Each measure, the failure bits, and the current policy."""
    rules = quality_rules.RULES
    failed = " + ".join(
        f"CASE WHEN {rule.times} * {rule.measure} > {rule.most} * {rule.base or 1} THEN {1 << at} ELSE 0 END"
        for at, rule in enumerate(rules)
    )
    policy = quality_rules.POLICIES[-1]
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        w AS (
            SELECT *, list_filter(string_split_regex(t, '[ \\t-\\r]+'), lambda x: x <> '') AS ws,
                   list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS ls
            FROM d),
        windows AS (
            SELECT r, unnest(generate_series(1, len(ws) - 2)) AS i, ws FROM w WHERE len(ws) > 2),
        again AS (
            SELECT r, i FROM (
                SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(ws[i:i + 2], ' ')) AS n FROM windows)
            WHERE n > 1),
        covered AS (
            SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
        m AS (
            SELECT doc_id, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars,
                   len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                   coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines,
                   len(list_filter(ws, lambda x: NOT regexp_matches(x, '\\p{{L}}'))) AS n_letterless,
                   len(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) AS n_capitals,
                   len(regexp_replace(t, '[^!]', '', 'g')) AS n_exclamations,
                   len(list_filter(ls, lambda x: regexp_matches(x, '^[ \\t]*[-*•]'))) AS n_bullets,
                   len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[ \\t\\r]*$'))) AS n_cut_lines,
                   coalesce(list_max(list_transform(ws, lambda x: len(x))), 0) AS longest_word
            FROM w LEFT JOIN covered USING (r)),
        f AS (SELECT *, CAST({failed} AS BIGINT) AS failed FROM m),
        b AS (SELECT *, failed & {quality_rules.BASE} <> 0 AS base_failed FROM f)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR failed & {policy.fatal} <> 0
                    OR bit_count(failed & {policy.soft}) > {policy.allowed}) AS kept, failed
        FROM b
    """


ORACLE = {
    "op1_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS low
            FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(low) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY low)
    """,
    "op4_suffix_dedup": """
        WITH d AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, encode(coalesce(text, '')) AS raw FROM documents),
        places AS (
            SELECT doc_id, raw, unnest(generate_series(1, octet_length(raw) - 49)) AS i FROM d WHERE octet_length(raw) >= 50),
        runs AS (SELECT doc_id, i, hash(raw[i:i + 49]) AS w FROM places),
        firsts AS (SELECT w, min(doc_id) AS least FROM runs GROUP BY w),
        gone AS (SELECT doc_id, i FROM runs JOIN firsts USING (w) WHERE doc_id > least),
        marked AS (
            SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new
            FROM gone),
        numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
        spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, span),
        pieces AS (
            SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 1) AS f, a AS t FROM spans
            UNION ALL
            SELECT d.doc_id, coalesce(max(b), 1), any_value(length(h)) // 2 + 1
            FROM d LEFT JOIN spans s ON d.doc_id = s.doc_id GROUP BY d.doc_id),
        kept AS (
            SELECT d.doc_id, string_agg(substr(h, 2 * f - 1, 2 * (t - f)), '' ORDER BY f, t) AS k
            FROM d JOIN pieces p ON d.doc_id = p.doc_id GROUP BY d.doc_id),
        sums AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS n FROM spans GROUP BY doc_id)
        SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
               coalesce(n, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
        FROM d JOIN kept ON d.doc_id = kept.doc_id LEFT JOIN sums ON d.doc_id = sums.doc_id
    """,
    "op7_minhash": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex({_LOW.format("coalesce(text, '')")},
                   '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS ws FROM documents),
        s AS (
            SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                   ELSE list_distinct(list_transform(generate_series(1, len(ws) - 4),
                        lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
        e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
            GROUP BY a.doc_id, b.doc_id
            HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
        links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
        reach(doc_id, c) AS (
            SELECT doc_id, doc_id FROM s
            UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.c)
        SELECT s.doc_id, len(any_value(sh)) AS n_shingles, min(c) AS component_id,
               s.doc_id = min(c) AS kept
        FROM s JOIN reach r ON s.doc_id = r.doc_id GROUP BY s.doc_id
    """,
    "op8_url_filter": _url_oracle(),
    "op11_quality_rules": _rules_oracle(),
    "op13_collocations": f"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex({_LOW.format("coalesce(text, '')")}, '[.,;:!?\\n\\x0B\\f\\r]')) AS piece
            FROM documents),
        w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS ws FROM p),
        s AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM w),
        g AS (SELECT lang, ws, i, unnest(generate_series(1, least(5, len(ws) - i + 1))) AS size FROM s),
        f AS (
            SELECT lang, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase, count(*) AS f
            FROM g GROUP BY ALL),
        totals AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
        often AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE f >= 100),
        cuts AS (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM often WHERE size > 1),
        scored AS (
            SELECT c.lang, c.phrase, c.size, c.f AS a, c.k, x.f AS l, y.f AS r, t.n,
                   (1000::HUGEINT * c.f::HUGEINT * t.n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
            FROM cuts c JOIN totals t ON t.lang = c.lang
            JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[:c.k], ' ')
            JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:], ' ')),
        best AS (
            SELECT * FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        longer AS (SELECT lang, size, f, ws, unnest(generate_series(2, size - 1)) AS m FROM often WHERE size > 2),
        inside AS (
            SELECT DISTINCT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, f
            FROM (SELECT *, unnest(generate_series(1, size - m + 1)) AS i FROM longer)),
        kept AS (
            SELECT * FROM best b WHERE NOT EXISTS (
                SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.f >= 100 * b.a)),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score,
               CAST(size AS INTEGER) AS size
        FROM ranked WHERE rank <= 2000
    """,
}
