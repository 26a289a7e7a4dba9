"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

# Words are the runs outside [\x20\x09-\x0D]; string_split_regex leaves empty
# strings at the ends, which are no words.
_WORDS = (
    r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
)

# SQL has no crc32: the table of its 256 remainders comes from the rule, eight
# halvings each, and a text's crc32 is a fold over its bytes.
_CRC_TABLE = """
        remainders AS (
            SELECT list(r ORDER BY b) AS t FROM (
                SELECT b, list_reduce(list_prepend(b, range(8)), lambda r, step:
                    CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END) AS r
                FROM (SELECT unnest(range(256)) AS b)
            )
        )"""
_CRC_BYTES = """list_transform(range(1, len(h) + 1, 2), lambda i:
                    CAST(16 * (instr('0123456789ABCDEF', substr(h, i, 1)) - 1)
                        + instr('0123456789ABCDEF', substr(h, i + 1, 1)) - 1 AS BIGINT))"""

_TERMS = r"""list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')"""

ORACLES: dict[str, str] = {
    # near words share a word of one letter less, made at the same place
    "op11_spelling": f"""
        WITH RECURSIVE {_CRC_TABLE.strip()}, runs AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS d, run, count(*) AS n
            FROM (SELECT doc_id, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
            WHERE length(run) >= 7 GROUP BY d, run
        ), hashed AS (
            SELECT run, n, xor(list_reduce(list_prepend(4294967295, {_CRC_BYTES}), lambda c, b:
                xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
            FROM (SELECT run, n, hex(encode(d || ':' || run)) AS h FROM runs), remainders
        ), words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
                SELECT n, CASE WHEN crc % 31 = 0
                    THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2)
                    ELSE run END AS word
                FROM hashed
            ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
        ), shorter AS (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), links AS (
            SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b
                ON a.less = b.less AND a.i = b.i AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.less = b.word
            UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.less = b.word
        ), best AS (
            SELECT word, count(*) AS n_near, max(near_n) AS most,
                arg_min(near, struct_pack(less := -near_n, near := near)) AS near
            FROM links GROUP BY word
        ), forms AS (
            SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
                CASE WHEN most >= 10 * words.n THEN near END AS form,
                CASE WHEN most >= 10 * words.n THEN most END AS form_n
            FROM words LEFT JOIN best ON words.word = best.word
        ), steps(word, root) AS (
            SELECT word, word FROM forms
            UNION ALL SELECT steps.word, forms.form FROM steps JOIN forms ON steps.root = forms.word
            WHERE forms.form IS NOT NULL
        )
        SELECT forms.word, forms.form, ends.root, forms.n, CAST(n_near AS BIGINT) AS n_near, form_n
        FROM forms JOIN (
            SELECT steps.word, steps.root FROM steps JOIN forms ON steps.root = forms.word WHERE forms.form IS NULL
        ) ends ON forms.word = ends.word
    """,
    "op12_lexical_search": f"""
        WITH docs AS (
            SELECT doc_id, {_TERMS} AS w FROM documents
        ), stats AS (
            SELECT count(*) FILTER (len(w) > 0) AS nd, CAST(sum(len(w)) AS BIGINT) AS l FROM docs
        ), tf AS (
            SELECT doc_id, n, w, count(*) AS tf
            FROM (SELECT doc_id, len(w) AS n, unnest(w) AS w FROM docs) GROUP BY doc_id, n, w
        ), weights AS (
            SELECT w, CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT) AS weight
            FROM (SELECT w, count(*) AS df FROM tf GROUP BY w), stats
        ), item_terms AS (
            SELECT DISTINCT item_id, unnest({_TERMS}) AS w FROM benchmark
        ), scores AS (
            SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf)
                // (1000 * tf + 8 * (100 - 90 + ((90 * n * nd) // l))))) AS BIGINT) AS score
            FROM item_terms JOIN tf USING (w) JOIN weights USING (w), stats GROUP BY item_id, doc_id
        ), ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
            FROM scores WHERE score > 0
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
    # all pairs; hashing found every link of the given tables
    # list_reduce adds up the products in order of the components
    "op5_hilbert_search": """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(q.v, c.v),
                lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)), lambda a, x: a + x) AS score
            FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
                AS rank, vec_id, score FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op4_cross_polytope": """
        WITH RECURSIVE usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
            ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
        ), reach(a, b) AS (
            SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        ), per_vector AS (
            SELECT a, min(b) AS least FROM reach GROUP BY a
        ), degree AS (
            SELECT a, count(*) AS n FROM links GROUP BY a
        )
        SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links,
            least(vec_id, coalesce(least, vec_id)) AS component_id,
            vec_id <= coalesce(least, vec_id) AS kept
        FROM embeddings LEFT JOIN per_vector ON vec_id = per_vector.a LEFT JOIN degree ON vec_id = degree.a
        WHERE vec_id IS NOT NULL
    """,
    # bytes as hexadecimal digits, two each
    "op6_run_length": """
        WITH bytes AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents WHERE doc_id IS NOT NULL
        ), strings AS (
            SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS x
            FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM bytes)
        ), later AS (
            SELECT doc_id, i FROM (
                SELECT doc_id, i, row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS r FROM strings
            ) WHERE r > 1
        ), marked AS (
            SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh
            FROM later
        ), spans AS (
            SELECT doc_id, n, min(i) AS lo, max(i) + 100 AS hi
            FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM marked)
            GROUP BY doc_id, n
        ), parts AS (
            SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS since FROM spans
        ), cut AS (
            SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS last,
                string_agg(substr(h, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo) AS kept
            FROM parts JOIN bytes USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes,
            CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
            sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM bytes LEFT JOIN cut USING (doc_id)
    """,
    "op7_substring_dedup": f"""
        WITH words AS (
            SELECT doc_id, {_WORDS} AS w FROM documents WHERE doc_id IS NOT NULL
        ), windows AS (
            SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS x
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)
        ), later AS (
            SELECT doc_id, i FROM (
                SELECT doc_id, i, min(doc_id) OVER (PARTITION BY x) AS first FROM windows
            ) WHERE first < doc_id
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM later
        ), per_doc AS (
            SELECT doc_id, list(i) AS places FROM gone GROUP BY doc_id
        )
        SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words,
            CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
            sha256(array_to_string(list_transform(list_filter(
                list_zip(w, range(1, len(w) + 1)),
                lambda p: NOT list_contains(coalesce(places, []), p[2])), lambda p: p[1]), ' ')) AS kept_sha256
        FROM words LEFT JOIN per_doc USING (doc_id)
    """,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
