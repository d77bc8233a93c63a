"""The same queries as plain SQL over the driver tables, for DuckDB."""

from __future__ import annotations

import re

from posttags.functions.text import ENGLISH_STOPWORDS
from posttags.plans.queries import (
    K,
    LIST_ROWS,
    MIN_COSINE,
    NB_TAG,
    TEXT_DIMS,
    TEXT_TAG,
    TOP_PERCENT,
    TOP_TERMS,
)

_STOP = ", ".join("'" + word.replace("'", "''") + "'" for word in ENGLISH_STOPWORDS)

# Named subqueries. Each query lists what it needs; order here is the order of use.
CTES = {
    "posts": """
        SELECT d.doc_id, d.text, [d.lang, d.source,
               CASE WHEN quality = 1 THEN 'quality' END,
               CASE WHEN toxic = 1 THEN 'toxic' END] AS tags
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "post_tags": """
        SELECT doc_id, tag FROM (SELECT doc_id, unnest(tags) AS tag FROM posts)
        WHERE tag IS NOT NULL""",
    "lines": r"""
        SELECT doc_id, regexp_replace(text, '[\r\n]+', ' ', 'g') || '>>>' ||
               array_to_string(list_filter(tags, lambda t: t IS NOT NULL), ' ') AS value
        FROM posts""",
    "raw": r"""
        SELECT doc_id, unnest(string_split_regex(text, '\s+')) AS token,
               generate_subscripts(string_split_regex(text, '\s+'), 1) AS place
        FROM documents""",
    "words": f"SELECT * FROM raw WHERE token <> '' AND token NOT IN ({_STOP})",
    "n": "SELECT count(*) AS n FROM documents",
    "lengths": "SELECT doc_id, count(*) AS n_tokens FROM words GROUP BY doc_id",
    "counts": """
        SELECT doc_id, token AS term, count(*) AS cnt FROM words GROUP BY doc_id, token""",
    "tf": """
        SELECT c.doc_id, term, cnt, cnt / n_tokens AS tf
        FROM counts c JOIN lengths l ON c.doc_id = l.doc_id""",
    "dfs": """
        SELECT term, count(*) AS df, CAST(sum(cnt) AS BIGINT) AS cf FROM counts GROUP BY term""",
    "idf_r": "SELECT term, df, n / df AS idf FROM dfs, n",
    "idf_s": """
        SELECT term, df, cf,
               CASE WHEN df >= 2 THEN ln((n + 1.0) / (df + 1.0)) ELSE 0.0 END AS idf
        FROM dfs, n""",
    "w_r": """
        SELECT doc_id, tf.term, cnt, tf * idf AS weight
        FROM tf JOIN idf_r ON tf.term = idf_r.term""",
    "w_s": """
        SELECT doc_id, c.term, cnt * idf AS weight
        FROM counts c JOIN idf_s i ON c.term = i.term WHERE idf <> 0""",
    "buckets": """
        SELECT doc_id, CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % 1048576 AS bucket,
               count(*) AS cnt
        FROM words GROUP BY ALL""",
    "bucket_idf": """
        SELECT bucket, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS idf
        FROM buckets GROUP BY bucket HAVING count(*) >= 2""",
    "totals": "SELECT term, cf, df, idf, cf * idf AS total FROM idf_s",
    "top": f"""
        SELECT term, idf, total, rank FROM (
            SELECT *, CAST(row_number() OVER (ORDER BY round(total, 9) DESC, term) - 1 AS INTEGER) AS rank
            FROM totals WHERE total <> 0) WHERE rank < {TOP_TERMS}""",
    "reduced": """
        SELECT doc_id, rank, cnt * idf AS value
        FROM counts c JOIN top t ON c.term = t.term WHERE cnt * idf <> 0""",
    "bag_of": """
        SELECT doc_id, string_agg(token, ' ' ORDER BY token) AS bag FROM words GROUP BY doc_id""",
    "bags": """
        SELECT bag, min(doc_id) AS rep_id, max(doc_id) AS last_id, count(*) AS n_posts
        FROM bag_of GROUP BY bag""",
    "unit": """
        SELECT doc_id, last_id, n_posts, term, cnt,
               weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS u
        FROM w_r JOIN bags ON doc_id = rep_id""",
    "unit_all": """
        SELECT doc_id, term, cnt,
               weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS u
        FROM w_r""",
    "cells": """
        SELECT * FROM (SELECT doc_id AS id0, lag(doc_id) OVER (ORDER BY doc_id) AS id1 FROM documents)
        WHERE id1 IS NOT NULL""",
    "slots": """
        SELECT vec_id AS id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS idx,
               CAST(unnest(embedding) AS DOUBLE) AS value
        FROM embeddings""",
    "text_lists": f"""
        SELECT g.doc_id AS id, list(coalesce(r.value, 0.0) ORDER BY g.rank) AS features
        FROM (SELECT doc_id, t.rank FROM documents, top t) g
        LEFT JOIN reduced r ON g.doc_id = r.doc_id AND g.rank = r.rank
        GROUP BY g.doc_id""",
    "points": """
        SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS features,
               ['t' || label, CASE WHEN label % 2 = 0 THEN 'even' ELSE 'odd' END] AS tags
        FROM embeddings""",
    "text_points": """
        SELECT t.id, t.features, list_filter(p.tags, lambda t: t IS NOT NULL) AS tags
        FROM text_lists t JOIN posts p ON t.id = p.doc_id""",
}


def _split(column: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({column} AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 60"


def _knn(points: str, all_tags: bool = True) -> dict[str, str]:
    """Subqueries of the neighbour job over ``points``."""
    tags = "unnest(p.tags)" if all_tags else "p.tags[1]"
    return {
        "near": f"""
            SELECT test_id, train_id, distance, rn FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY test_id ORDER BY distance, train_id) AS rn
                FROM (
                    SELECT a.id AS test_id, b.id AS train_id,
                           round(list_distance(a.features, b.features), 9) AS distance
                    FROM {points} a JOIN {points} b
                      ON NOT ({_split("a.id")}) AND {_split("b.id")}))
            WHERE rn <= {K}""",
        "ballots": f"""
            SELECT test_id, tag, count(*) AS votes FROM (
                SELECT test_id, {tags} AS tag FROM near JOIN {points} p ON train_id = p.id)
            GROUP BY test_id, tag""",
        "predicted": """
            SELECT test_id, tag FROM (
                SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY votes DESC, tag) AS rn,
                       max(votes) OVER (PARTITION BY test_id) AS best
                FROM ballots) WHERE rn <= 3 AND votes = best""",
        "actual": f"""
            SELECT DISTINCT id AS test_id, unnest(tags) AS tag FROM {points}
            WHERE NOT ({_split("id")})""",
        "judged_tags": """
            SELECT tag FROM predicted GROUP BY tag ORDER BY count(*) DESC, tag LIMIT 20""",
        "tested": f"SELECT count(*) AS n FROM {points} WHERE NOT ({_split('id')})",
        "confusion": _CONFUSION.format(keep="WHERE p.tag IN (SELECT tag FROM judged_tags)"),
    }


_CONFUSION = """
    SELECT tag, tp, np - tp AS fp, na - tp AS fn, n - np - na + tp AS tn FROM (
        SELECT p.tag, np, na, coalesce(tp, 0) AS tp
        FROM (SELECT tag, count(*) AS np FROM predicted GROUP BY tag) p
        JOIN (SELECT tag, count(*) AS na FROM actual GROUP BY tag) a ON p.tag = a.tag
        LEFT JOIN (SELECT p.tag, count(*) AS tp FROM predicted p
                   JOIN actual a ON p.test_id = a.test_id AND p.tag = a.tag
                   GROUP BY p.tag) b ON p.tag = b.tag
        {keep}), tested"""

_METRICS = """
    SELECT tag, tp, fp, fn, tn, round(p, 6) AS precision, round(r, 6) AS recall,
           round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
           round(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 6) AS f_score
    FROM (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p,
                 CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r FROM confusion)"""


def _bayes(fitted: str = "TRUE", tested: str = "TRUE") -> dict[str, str]:
    """Subqueries of naive Bayes for all tags: statistics, scores, decisions."""
    return {
        "tag_names": "SELECT DISTINCT unnest(tags) AS tag FROM points",
        "judged": """
            SELECT id, tag, list_contains(tags, tag) AS label FROM points, tag_names""",
        "priors": f"""
            SELECT tag, label AS is_pos, count(*) AS n,
                   count(*) / sum(count(*)) OVER (PARTITION BY tag) AS prior
            FROM judged WHERE {fitted} GROUP BY tag, label""",
        "stats": f"""
            SELECT tag, label AS is_pos, idx AS dim, avg(value) AS mean,
                   var_samp(value) AS variance
            FROM judged JOIN slots USING (id) WHERE {fitted} GROUP BY tag, label, idx""",
        "scores": f"""
            SELECT s.id, t.tag, t.is_pos, CASE WHEN min(variance) > 0 THEN ln(any_value(p.prior)) +
                   sum(-0.5 * ln(2 * pi() * nullif(variance, 0))
                       - (value - mean) * (value - mean) / (2 * nullif(variance, 0))) END AS score
            FROM slots s JOIN stats t ON s.idx = t.dim
            JOIN priors p ON p.tag = t.tag AND p.is_pos = t.is_pos
            WHERE {tested.replace("id", "s.id") if tested != "TRUE" else tested}
            GROUP BY s.id, t.tag, t.is_pos""",
        "decided": """
            SELECT j.id, j.tag, j.label, coalesce(a.score > b.score, FALSE) AS prediction
            FROM judged j
            JOIN scores a ON a.id = j.id AND a.tag = j.tag AND a.is_pos
            JOIN scores b ON b.id = j.id AND b.tag = j.tag AND NOT b.is_pos""",
    }


def _bayes_of_posts(dims: int | None) -> str:
    """Naive Bayes of TEXT_TAG over the selected terms, or the first ``dims`` of them."""
    used = f"features[1:{dims}]" if dims else "features"
    rest = {name: re.sub(r"\b(points|slots)\b", r"nb_\1", sql) for name, sql in _bayes().items()}
    return _sql(
        """SELECT label, CAST(sum(CASE WHEN prediction THEN 0 ELSE 1 END) AS BIGINT) AS predicted_false,
           CAST(sum(CASE WHEN prediction THEN 1 ELSE 0 END) AS BIGINT) AS predicted_true
           FROM decided GROUP BY label""", *_TEXT, extra={
            "nb_points": f"SELECT id, {used} AS features, tags FROM text_points",
            "nb_slots": """SELECT id, CAST(generate_subscripts(features, 1) - 1 AS INTEGER) AS idx,
                           unnest(features) AS value FROM nb_points""",
            **rest, "tag_names": f"SELECT '{TEXT_TAG}' AS tag"})


def _sql(final: str, *names: str, extra: dict[str, str] | None = None) -> str:
    known = {**CTES, **(extra or {})}
    wanted = [n for n in known if n in names or (extra and n in extra)]
    ctes = ",\n".join(f'"{name}" AS ({known[name]})' for name in wanted)
    return f"WITH {ctes}\n{final}" if ctes else final


_WORDS = ("raw", "words")
_COUNTS = (*_WORDS, "counts")
_TF = (*_COUNTS, "lengths", "tf")
_RATIO = (*_TF, "dfs", "n", "idf_r", "w_r")
_SMOOTH = (*_COUNTS, "dfs", "n", "idf_s")
_TOP = (*_SMOOTH, "totals", "top")
_REDUCED = (*_TOP, "reduced")
_TEXT = (*_REDUCED, "posts", "text_lists", "text_points")
_NB_ONE = f"tag = '{NB_TAG}'"


def _pairs(weight: str, condition: str) -> str:
    value = f"round(sum({weight}), 9)"
    return f"""
        SELECT a.doc_id AS id0, b.doc_id AS id1, round({value}, 6) AS cosine,
               any_value(a.n_posts) AS copies0, any_value(b.n_posts) AS copies1
        FROM unit a JOIN unit b ON a.term = b.term AND {condition}
        GROUP BY a.doc_id, b.doc_id HAVING {value} >= {MIN_COSINE}"""


_SIMILAR_IDS = {
    "similar_ids": f"""SELECT id0, id1, cosine FROM ({_pairs("a.u * b.u", "a.doc_id >= b.doc_id")})
                       WHERE id0 <> id1"""
}
_PARTS = "string_split(value, '>>>')"
_TAG_TEXT = (
    f"array_to_string(list_filter(string_split_regex({_PARTS}[2], '\\s+'), "
    "lambda t: t <> ''), ' ')"
)


def oracle() -> dict[str, str]:
    return {
        "parse_posts": _sql(
            f"""SELECT doc_id, {_PARTS}[1] AS text, {_TAG_TEXT} AS tag_text,
                string_split({_TAG_TEXT}, ' ')[1] AS primary_tag FROM lines""",
            "posts", "lines",
        ),
        "text_source": _sql(
            f"SELECT {_PARTS}[1] AS text, {_TAG_TEXT} AS tag_text FROM lines", "posts", "lines"
        ),
        "stage_roundtrip": _sql("SELECT doc_id, tag FROM post_tags", "posts", "post_tags"),
        "peek": """SELECT doc_id, text, (SELECT count(*) FROM documents) AS n_rows
                   FROM documents ORDER BY doc_id LIMIT 3""",
        "tokenize": _sql(
            """SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS INTEGER) AS pos,
               token FROM words""", *_WORDS),
        "inverted_index": _sql("SELECT token, doc_id FROM words", *_WORDS),
        "token_total": _sql("SELECT count(*) AS n_tokens FROM words", *_WORDS),
        "vocabulary": _sql("SELECT DISTINCT token FROM words", *_WORDS),
        "document_frequency": _sql("SELECT term, df FROM dfs", *_COUNTS, "dfs"),
        "tf_normalised": _sql("SELECT doc_id, term, cnt, round(tf, 6) AS tf FROM tf", *_TF),
        "idf_ratio": _sql("SELECT term, df, round(idf, 6) AS idf FROM idf_r", *_COUNTS, "dfs", "n", "idf_r"),
        "idf_smooth": _sql("SELECT term, df, round(idf, 6) AS idf FROM idf_s", *_SMOOTH),
        "tfidf_ratio": _sql("SELECT doc_id, term, round(weight, 6) AS weight FROM w_r", *_RATIO),
        "tfidf_ratio_hot": _sql("SELECT doc_id, term, round(weight, 6) AS weight FROM w_r", *_RATIO),
        "tfidf_smooth": _sql("SELECT doc_id, term, round(weight, 6) AS weight FROM w_s", *_SMOOTH, "w_s"),
        "tf_hashed": _sql("SELECT doc_id, bucket, cnt FROM buckets", *_WORDS, "buckets"),
        "tfidf_hashed": _sql(
            """SELECT doc_id, b.bucket, round(cnt * idf, 6) AS weight
               FROM buckets b JOIN bucket_idf i ON b.bucket = i.bucket WHERE idf <> 0""",
            *_WORDS, "buckets", "bucket_idf"),
        "term_totals": _sql("SELECT term, cf, df, round(total, 6) AS total FROM totals", *_SMOOTH, "totals"),
        "top_terms": _sql("SELECT term, round(total, 6) AS total, rank FROM top", *_TOP),
        "top_terms_collapsed": _sql(
            f"""SELECT term, round(total, 6) AS total, rank FROM (
                SELECT *, CAST(row_number() OVER (ORDER BY round(total, 9) DESC, term) - 1 AS INTEGER) AS rank
                FROM (SELECT min(term) AS term, any_value(total) AS total FROM totals
                      WHERE total <> 0 GROUP BY round(total, 9))) WHERE rank < {TOP_TERMS}""",
            *_SMOOTH, "totals"),
        "top_terms_collapsed_ratio": _sql(
            f"""SELECT term, round(total, 6) AS total, rank FROM (
                SELECT *, CAST(row_number() OVER (ORDER BY round(total, 9) DESC, term) - 1 AS INTEGER) AS rank
                FROM (SELECT min(term) AS term, any_value(total) AS total
                      FROM (SELECT term, sum(weight) AS total FROM w_r GROUP BY term)
                      GROUP BY round(total, 9))) WHERE rank < {TOP_TERMS}""", *_RATIO),
        "vocab_vectors": _sql(
            """SELECT doc_id, term_id, round(weight, 6) AS weight FROM w_r JOIN (
               SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id FROM dfs) v
               ON w_r.term = v.term""", *_RATIO),
        "reduced_vectors": _sql("SELECT doc_id, rank, round(value, 6) AS value FROM reduced", *_REDUCED),
        "reduced_vectors_dense": _sql("SELECT doc_id, rank, round(value, 6) AS value FROM reduced", *_REDUCED),
        "doc_norms": _sql(
            "SELECT doc_id, round(sqrt(sum(weight * weight)), 6) AS norm FROM w_r GROUP BY doc_id", *_RATIO),
        "sparse_from_dense": _sql("SELECT id, idx, round(value, 6) AS value FROM slots WHERE value <> 0", "slots"),
        "vector_sum": _sql("SELECT idx, round(sum(value), 6) AS total FROM slots GROUP BY idx", "slots"),
        "vec_add": _sql(
            "SELECT id, idx, round(2 * value, 6) AS value FROM slots WHERE value <> 0 AND idx % 2 = 0", "slots"),
        "pca_covariance": _sql(
            """SELECT a.idx AS i, b.idx AS j, round(covar_samp(a.value, b.value), 6) AS cov
               FROM slots a JOIN slots b ON a.id = b.id AND a.idx <= b.idx GROUP BY a.idx, b.idx""", "slots"),
        "pca_axes": _sql(
            """SELECT a.idx AS i, b.idx AS j, CASE WHEN a.idx = b.idx THEN 1.0 ELSE 0.0 END::DOUBLE AS dot,
               CASE WHEN a.idx <> b.idx THEN 0.0::DOUBLE END AS off, total, TRUE AS falling
               FROM (SELECT DISTINCT idx FROM slots) a JOIN (SELECT DISTINCT idx FROM slots) b ON a.idx <= b.idx,
               (SELECT round(sum(v), 5) AS total FROM (SELECT var_samp(value) AS v FROM slots GROUP BY idx))""", "slots"),
        "common_tokens": _sql(
            """SELECT id0, id1, a.term AS token, a.cnt AS repeats FROM cells
               JOIN counts a ON a.doc_id = id0 JOIN counts b ON b.doc_id = id1 AND a.term = b.term""",
            *_COUNTS, "cells"),
        "cosine_of_pairs": _sql(
            """SELECT id0, id1, round(sum(a.u * b.u), 6) AS cosine FROM cells
               JOIN unit_all a ON a.doc_id = id0 JOIN unit_all b ON b.doc_id = id1 AND a.term = b.term
               GROUP BY id0, id1""", *_RATIO, "unit_all", "cells"),
        "common_tokens_similar": _sql(
            """SELECT id0, id1, a.term AS token, a.cnt AS repeats FROM similar_ids
               JOIN counts a ON a.doc_id = id0 JOIN counts b ON b.doc_id = id1 AND a.term = b.term""",
            *_RATIO, "bag_of", "bags", "unit", extra=_SIMILAR_IDS),
        "cosine_of_similar": _sql(
            "SELECT id0, id1, cosine FROM similar_ids", *_RATIO, "bag_of", "bags", "unit", extra=_SIMILAR_IDS),
        "post_copies": _sql(
            "SELECT doc_id, rep_id FROM bag_of JOIN bags ON bag_of.bag = bags.bag", *_WORDS, "bag_of", "bags"),
        "cosine_pairs": _sql(_pairs("a.u * b.u", "a.doc_id >= b.doc_id"), *_RATIO, "bag_of", "bags", "unit"),
        "cosine_pairs_grid": _sql(
            _pairs("a.u * b.u", "a.doc_id >= b.doc_id"), *_RATIO, "bag_of", "bags", "unit"),
        "cosine_pairs_repeat": _sql(
            _pairs("a.cnt * a.u * b.u", "a.last_id >= b.doc_id"), *_RATIO, "bag_of", "bags", "unit"),
        "tag_counts": _sql("SELECT tag, count(*) AS n FROM post_tags GROUP BY tag", "posts", "post_tags"),
        "tag_total": _sql("SELECT count(DISTINCT tag) AS n_tags FROM post_tags", "posts", "post_tags"),
        "top_percent_tags": _sql(
            f"""SELECT tag, n, rank FROM (
                SELECT tag, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, tag) - 1 AS rank
                FROM post_tags GROUP BY tag)
                WHERE rank < floor(0.01 * {TOP_PERCENT} * (SELECT count(DISTINCT tag) FROM post_tags))""",
            "posts", "post_tags"),
        "posts_with_tag": _sql(f"SELECT doc_id FROM posts WHERE list_contains(tags, '{TEXT_TAG}')", "posts"),
        "non_tag_anti": _sql(
            f"SELECT doc_id FROM posts WHERE NOT coalesce(list_contains(tags, '{TEXT_TAG}'), FALSE)", "posts"),
        "train_test_split": f"SELECT doc_id, {_split('doc_id')} AS is_train FROM documents",
        "train_semi": _sql(f"SELECT tag, doc_id FROM post_tags WHERE {_split('doc_id')}", "posts", "post_tags"),
        "tag_posting_lists": _sql(
            f"""SELECT tag, part, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS ids FROM (
                SELECT *, (row_number() OVER (PARTITION BY tag ORDER BY doc_id) - 1) // {LIST_ROWS} AS part
                FROM post_tags) GROUP BY tag, part""", "posts", "post_tags"),
        "knn_neighbors_cells": _sql(_NEAR, "points", extra=_knn("points")),
        "knn_neighbors": _sql(_NEAR, "points", extra=_knn("points")),
        "knn_predict_all": _sql("SELECT test_id, tag FROM predicted", "points", extra=_knn("points")),
        "knn_predict_first": _sql(
            "SELECT test_id, tag FROM predicted", "points", extra=_knn("points", all_tags=False)),
        "tag_postings": _sql("SELECT tag, test_id FROM predicted", "points", extra=_knn("points")),
        "top_predicted_tags": _sql(
            "SELECT tag, count(*) AS n FROM predicted GROUP BY tag ORDER BY n DESC, tag LIMIT 20",
            "points", extra=_knn("points")),
        "top_actual_tags": _sql(
            "SELECT tag, count(*) AS n FROM actual GROUP BY tag ORDER BY n DESC, tag LIMIT 50",
            "points", extra=_knn("points")),
        "tag_confusion": _sql("SELECT * FROM confusion", "points", extra=_knn("points")),
        "tag_metrics": _sql(_METRICS, "points", extra=_knn("points")),
        "tag_metrics_all": _sql(_METRICS, "points", extra={
            **_knn("points"), "confusion": _CONFUSION.format(keep="")}),
        "knn_hit_rate": _sql(
            """SELECT count(*) AS n_tested, CAST(sum(hit) AS BIGINT) AS hits, round(avg(hit), 6) AS hit_rate FROM (
               SELECT a.test_id, max(CASE WHEN p.tag IS NULL THEN 0 ELSE 1 END) AS hit
               FROM actual a LEFT JOIN predicted p ON a.test_id = p.test_id AND a.tag = p.tag
               GROUP BY a.test_id)""", "points", extra=_knn("points")),
        "knn_documents": _sql(_NEAR, *_TEXT, extra=_knn("text_points")),
        "knn_documents_metrics": _sql(_METRICS, *_TEXT, extra=_knn("text_points")),
        "class_prior": _sql(
            f"SELECT round(avg(CASE WHEN list_contains(tags, '{NB_TAG}') THEN 1.0 ELSE 0.0 END), 6) AS prior FROM points",
            "points"),
        "column_stats": _sql(
            f"""SELECT is_pos, dim, round(mean, 6) AS mean, round(variance, 6) AS variance
                FROM stats WHERE {_NB_ONE}""", "points", "slots", extra=_bayes()),
        "nb_predict": _sql(
            f"SELECT id, label, prediction FROM decided WHERE {_NB_ONE}", "points", "slots", extra=_bayes()),
        "nb_predict_holdout": _sql(
            f"SELECT id, label, prediction FROM decided WHERE {_NB_ONE} AND NOT ({_split('id')})",
            "points", "slots", extra=_bayes(fitted=_split("id"))),
        "nb_confusion": _sql(
            f"""SELECT label, CAST(sum(CASE WHEN prediction THEN 0 ELSE 1 END) AS BIGINT) AS predicted_false,
                CAST(sum(CASE WHEN prediction THEN 1 ELSE 0 END) AS BIGINT) AS predicted_true
                FROM decided WHERE {_NB_ONE} GROUP BY label""", "points", "slots", extra=_bayes()),
        "nb_documents": _bayes_of_posts(None),
        "nb_documents_numdim": _bayes_of_posts(TEXT_DIMS),
        "nb_predict_all_tags_passes": _sql(
            "SELECT id, tag FROM decided WHERE prediction", "points", "slots", extra=_bayes()),
        "nb_predict_all_tags": _sql(
            "SELECT id, tag FROM decided WHERE prediction", "points", "slots", extra=_bayes()),
        "nb_top_tag_metrics": _sql(_METRICS, "points", "slots", extra={
            **_bayes(),
            "actual": "SELECT id AS test_id, unnest(tags) AS tag FROM points",
            "targets": """
                SELECT tag FROM (SELECT tag, row_number() OVER (ORDER BY count(*) DESC, tag) AS rn
                FROM actual GROUP BY tag)
                WHERE rn <= floor(0.5 * (SELECT count(DISTINCT tag) FROM actual))""",
            "predicted": """
                SELECT id AS test_id, tag FROM decided
                WHERE prediction AND tag IN (SELECT tag FROM targets)""",
            "tested": "SELECT count(*) AS n FROM points",
            "confusion": _CONFUSION.format(keep=""),
        }),
    }


_NEAR = "SELECT test_id, train_id, round(distance, 6) AS distance, CAST(rn AS INTEGER) AS rn FROM near"
