"""Oracle SQL (DuckDB dialect) for the query catalogue.

Each string runs on the pre-registered views ``events``, ``documents``, ``embeddings``,
``part`` and must return the same column names and values as the Spark query of the
same key. The iterative algorithms (farthest-first, greedy matching) are unrolled into
CTE chains generated from the catalogue parameters.
"""

from __future__ import annotations

from dispersa.plans.queries import CHUNKS, DIGITS, DRAWS, ROUNDS, K, K_SPREAD, K_SQRT, L, SEED, k

# Text handling, mirroring dispersa.functions.text.
_LINES = r"""
lines AS (
  SELECT doc_id, unnest(arr) AS line, generate_subscripts(arr, 1) - 1 AS line_no
  FROM (
    SELECT doc_id,
           CASE WHEN text IS NULL OR text = '' THEN []::VARCHAR[]
                WHEN parts[-1] = '' THEN parts[1:len(parts) - 1]
                ELSE parts END AS arr
    FROM (SELECT doc_id, text, regexp_split_to_array(text, '\r\n|\r|\n') AS parts FROM documents)
  )
)"""

_TOKENS = _LINES + r""",
tokens AS (
  SELECT doc_id, line_no, unnest(
           CASE WHEN line <> '' AND rtrim(line, ' ') = '' THEN []::VARCHAR[]
                ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines
)"""

_WORD_COUNT = "SELECT word, count(*)::BIGINT AS n FROM tokens GROUP BY word"

_OBJECTS = "objects AS (SELECT event_id AS obj_id, event_type AS class FROM events)"


def _partials(modulus: int) -> str:
    return (
        f"partials AS (SELECT obj_id % {modulus} AS part, class, count(*)::BIGINT AS n "
        f"FROM objects GROUP BY ALL)"
    )


def _class_count(modulus: int) -> str:
    return (
        f"WITH {_OBJECTS}, {_partials(modulus)} "
        "SELECT class, sum(n)::BIGINT AS n FROM partials GROUP BY class ORDER BY class"
    )


ORACLE: dict[str, str] = {
    "parse_object_class": "SELECT event_id AS obj_id, event_type AS class FROM events",
    "class_partials": f"WITH {_OBJECTS}, {_partials(K)} SELECT part, class, n FROM partials",
    "class_count_modulo": _class_count(K),
    "class_count_sqrt": _class_count(int(K_SQRT ** 0.5)),
    "class_count_physical": f"WITH {_OBJECTS} SELECT class, count(*)::BIGINT AS n FROM objects GROUP BY class ORDER BY class",
    "class_partition_stats": (
        f"WITH {_OBJECTS}, {_partials(K)}, "
        "totals AS (SELECT part, sum(n)::BIGINT AS part_total FROM partials GROUP BY part) "
        "SELECT class, sum(n)::BIGINT AS n, max(part_total)::BIGINT AS max_part "
        "FROM partials JOIN totals USING (part) GROUP BY class ORDER BY class"
    ),
    # The sizes of K parts that differ by at most one, from an even cut of the numbered rows.
    "balanced_repartition": (
        f"WITH {_OBJECTS}, cut AS (SELECT (row_number() OVER (ORDER BY obj_id) - 1) * {K_SPREAD} "
        "// count(*) OVER () AS part FROM objects) SELECT part::BIGINT AS part, count(*)::BIGINT AS n FROM cut GROUP BY part"
    ),
    "max_partition_size_physical": (
        f"WITH {_OBJECTS}, cut AS (SELECT (row_number() OVER (ORDER BY obj_id) - 1) * {K} "
        "// count(*) OVER () AS part FROM objects), sizes AS (SELECT part, count(*) AS c FROM cut GROUP BY part) "
        "SELECT count(*)::BIGINT AS parts, sum(c)::BIGINT AS n, max(c)::BIGINT AS max_part FROM sizes"
    ),
    "max_partition_size": (
        f"WITH {_OBJECTS} SELECT max(c)::BIGINT AS max_part FROM "
        f"(SELECT obj_id % {K} AS part, count(*) AS c FROM objects GROUP BY 1)"
    ),
    "most_frequent_class": (
        f"WITH {_OBJECTS} SELECT class, count(*)::BIGINT AS n FROM objects "
        "GROUP BY class ORDER BY n DESC, class LIMIT 1"
    ),
    "text_lines": f"WITH {_LINES} SELECT doc_id, line_no::INTEGER AS line_no, line FROM lines",
    "document_count": f"WITH {_LINES} SELECT count(*)::BIGINT AS n FROM lines",
    "doc_term_frequency": (
        f"WITH {_TOKENS} SELECT doc_id, line_no::INTEGER AS line_no, word, count(*)::BIGINT AS n "
        "FROM tokens GROUP BY ALL"
    ),
    "word_count": f"WITH {_TOKENS} {_WORD_COUNT}",
    "word_count_salted": f"WITH {_TOKENS} {_WORD_COUNT}",
    "word_count_partitioned": f"WITH {_TOKENS} {_WORD_COUNT}",
    "distinct_word_count": f"WITH {_TOKENS} SELECT count(DISTINCT word)::BIGINT AS n FROM tokens",
    "average_word_length": (
        f"WITH {_TOKENS}, wc AS ({_WORD_COUNT}) "
        "SELECT (sum(length(word) + length(regexp_replace(word, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')))"
        " // count(*))::BIGINT AS avg_len FROM wc"
    ),
}


# --- points -------------------------------------------------------------------------------

_PTS = "pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS p FROM embeddings)"
_SAMPLE = (
    f"smp AS (SELECT id, p FROM pts ORDER BY md5(concat('{SEED}:', CAST(id AS VARCHAR))), id LIMIT {k})"
)


def _r(expr: str, name: str) -> str:
    return f"round({expr}, {DIGITS}) AS {name}"


def kcenter_chain(src: str, kk: int, name: str) -> str:
    """CTEs ``{name}0..{name}{kk-1}`` and ``{name}`` = (part, id, p, md, ord) over ``src(part, id, p)``."""
    ctes = [
        f"{name}0 AS (SELECT part, id, p, CAST(NULL AS DOUBLE) AS md, 0 AS ord FROM {src} "
        f"QUALIFY row_number() OVER (PARTITION BY part ORDER BY id) = 1)"
    ]
    prev_state, prev_c = src, f"{name}0"
    for r in range(1, kk):
        d = "list_distance(s.p, c.p)"
        md = d if r == 1 else f"least(s.md, {d})"
        ctes.append(
            f"{name}s{r} AS (SELECT s.part, s.id, s.p, {md} AS md FROM {prev_state} s "
            f"JOIN {prev_c} c ON s.part = c.part AND s.id <> c.id)"
        )
        ctes.append(
            f"{name}{r} AS (SELECT part, id, p, md, {r} AS ord FROM {name}s{r} "
            f"QUALIFY row_number() OVER (PARTITION BY part ORDER BY md DESC, id) = 1)"
        )
        prev_state, prev_c = f"{name}s{r}", f"{name}{r}"
    union = " UNION ALL ".join(f"SELECT * FROM {name}{r}" for r in range(kk))
    ctes.append(f"{name} AS ({union})")
    return ",\n".join(ctes)


def matching_chain(src: str, kk: int, name: str) -> str:
    """CTE ``{name}`` = (round, id) of greedy matching over ``src(id, p)`` (k < n assumed)."""
    ctes = []
    taken = None
    for r in range(1, kk // 2 + 1):
        cond = ""
        if taken:
            cond = f"WHERE a.id NOT IN (SELECT id FROM {taken}) AND b.id NOT IN (SELECT id FROM {taken}) "
        ctes.append(
            f"{name}r{r} AS (SELECT a.id AS i, b.id AS j FROM {src} a JOIN {src} b ON a.id < b.id {cond}"
            f"ORDER BY list_distance(a.p, b.p) DESC, a.id, b.id LIMIT 1)"
        )
        prev = f"SELECT id FROM {taken} UNION ALL " if taken else ""
        ctes.append(f"{name}t{r} AS ({prev}SELECT i AS id FROM {name}r{r} UNION ALL SELECT j FROM {name}r{r})")
        taken = f"{name}t{r}"
    parts = [f"SELECT {r} AS round, i AS id FROM {name}r{r} UNION ALL SELECT {r}, j FROM {name}r{r}"
             for r in range(1, kk // 2 + 1)]
    if kk % 2:
        where = f"WHERE id NOT IN (SELECT id FROM {taken})" if taken else ""
        ctes.append(f"{name}o AS (SELECT min(id) AS id FROM {src} {where})")
        parts.append(f"SELECT {kk // 2 + 1}, id FROM {name}o")
    ctes.append(f"{name} AS ({' UNION ALL '.join(parts)})")
    return ",\n".join(ctes)


_PART = f"('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::BIGINT % {L}"

_CHUNK = f"('0x' || substr(md5(CAST(id AS VARCHAR)), 9, 8))::BIGINT % {CHUNKS}"

_CORE = (
    f"{_PTS},\nparted AS (SELECT {_PART} AS part, id, p FROM pts),\n"
    + kcenter_chain("parted", k, "core")
    + ",\ncorepts AS (SELECT id, p FROM core),\n"
    + matching_chain("corepts", k, "dm")
    + ",\nanswer AS (SELECT dm.round, dm.id, corepts.p FROM dm JOIN corepts USING (id))"
)

# k draws of a row number, over the rows ordered by the first three digits of the id's MD5 and the id.
_DRAWS = (
    f"{_PTS},\nnumbered AS (SELECT id, p, row_number() OVER (ORDER BY substr(md5(CAST(id AS VARCHAR)), 1, 3), id) - 1 AS pos, "
    "count(*) OVER () AS n FROM pts),\n"
    f"asked AS (SELECT d::INTEGER AS draw, ('0x' || substr(md5(concat('{SEED}:', CAST(d AS VARCHAR))), 1, 15))::BIGINT "
    f"% (SELECT count(*) FROM pts) AS pos FROM range({DRAWS}) r(d)),\n"
    "drawn AS (SELECT draw, id, p FROM asked JOIN numbered USING (pos))"
)

ORACLE.update({
    "sample_with_replacement": f"WITH {_DRAWS} SELECT draw, id FROM drawn",
    "replaced_sample_diameter": (
        f"WITH {_DRAWS} SELECT {_r('max(list_distance(s.p, t.p))', 'max_dist')} FROM drawn s, pts t"
    ),
    "estimated_pairwise_distance": (
        f"WITH {_PTS}, keyed AS (SELECT t, id, p, md5(concat('{SEED}:', CAST(t AS VARCHAR), ':', CAST(id AS VARCHAR))) AS key "
        f"FROM pts, range({ROUNDS}) r(t)), "
        "grouped AS (SELECT *, ('0x' || substr(key, 1, 8))::BIGINT % (SELECT (count(*) + 1023) // 1024 FROM pts) AS grp FROM keyed), "
        "ordered AS (SELECT t, p, lead(p) OVER w AS q, row_number() OVER w AS pos FROM grouped "
        "WINDOW w AS (PARTITION BY t, grp ORDER BY key, id)), "
        "rounds AS (SELECT t, avg(list_distance(p, q)) AS mean, count(*) AS m FROM ordered "
        "WHERE pos % 2 = 1 AND q IS NOT NULL GROUP BY t), "
        "reach AS (SELECT 2 * max(list_distance(p, (SELECT p FROM pts ORDER BY id LIMIT 1))) AS r, count(*) AS n FROM pts) "
        f"SELECT {_r('avg(mean)', 'avg_dist')}, "
        f"{_r('any_value(r) * sqrt(8 * any_value(n) * ln(2 / 1e-6)) / min(m)', 'error_bound')}, sum(m)::BIGINT AS n_pairs "
        "FROM rounds, reach"
    ),
})

_PTS2 = "pts2 AS (SELECT p_partkey AS id, [CAST(p_size AS DOUBLE), CAST(p_retailprice AS DOUBLE)] AS p FROM part)"

ORACLE.update({
    "exact_diameter_2d": (
        f"WITH {_PTS2} SELECT {_r('coalesce(max(list_distance(a.p, b.p)), 0)', 'max_dist')} "
        "FROM pts2 a JOIN pts2 b ON a.id < b.id"
    ),
    "farthest_pair_2d": (
        f"WITH {_PTS2} SELECT a.id AS i, b.id AS j, {_r('list_distance(a.p, b.p)', 'dist')} "
        "FROM pts2 a JOIN pts2 b ON a.id < b.id ORDER BY list_distance(a.p, b.p) DESC, a.id, b.id LIMIT 1"
    ),
    "k_center_2d": (
        f"WITH {_PTS2},\nallpts AS (SELECT 0 AS part, id, p FROM pts2),\n{kcenter_chain('allpts', k, 'kc')}\n"
        f"SELECT ord, id, {_r('md', 'min_dist')} FROM kc"
    ),
    "parse_points": (
        "SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS x, CAST(p_retailprice AS DOUBLE) AS y, 2 AS dim FROM part"
    ),
    "point_distances": (
        f"WITH {_PTS}, {_SAMPLE} SELECT s.id AS i, t.id AS j, "
        f"{_r('list_distance(s.p, t.p) * list_distance(s.p, t.p)', 'sqdist')}, "
        f"{_r('list_distance(s.p, t.p)', 'dist')} FROM smp s, pts t"
    ),
    "point_set_summary": (
        f"SELECT count(*)::BIGINT AS n_points, max(len(embedding))::INTEGER AS dim, {k} AS k, {L} AS l FROM embeddings"
    ),
    "exact_diameter": (
        f"WITH {_PTS} SELECT {_r('coalesce(max(list_distance(a.p, b.p)), 0)', 'max_dist')} "
        "FROM pts a JOIN pts b ON a.id < b.id"
    ),
    "sampled_diameter": (
        f"WITH {_PTS}, {_SAMPLE} SELECT {_r('max(list_distance(s.p, t.p))', 'max_dist')} FROM smp s, pts t"
    ),
    "min_distance_to_centers": (
        f"WITH {_PTS}, {_SAMPLE} SELECT t.id, {_r('min(list_distance(s.p, t.p))', 'min_dist')} "
        "FROM smp s, pts t GROUP BY t.id"
    ),
    "k_center": (
        f"WITH {_PTS},\nallpts AS (SELECT 0 AS part, id, p FROM pts),\n{kcenter_chain('allpts', k, 'kc')}\n"
        f"SELECT ord, id, {_r('md', 'min_dist')} FROM kc"
    ),
    "k_center_diameter": (
        f"WITH {_PTS},\nallpts AS (SELECT 0 AS part, id, p FROM pts),\n{kcenter_chain('allpts', k, 'kc')}\n"
        f"SELECT {_r('coalesce(max(list_distance(a.p, b.p)), 0)', 'max_dist')} FROM kc a JOIN kc b ON a.id < b.id"
    ),
    "coreset_k_center": (
        f"WITH {_PTS},\nparted AS (SELECT {_PART} AS part, id, p FROM pts),\n{kcenter_chain('parted', k, 'core')}\n"
        f"SELECT part, ord, id, {_r('md', 'min_dist')} FROM core"
    ),
    "coreset_merged": (
        f"WITH {_PTS},\nchunked AS (SELECT {_PART} * {CHUNKS} + {_CHUNK} AS part, id, p FROM pts),\n"
        + kcenter_chain("chunked", k, "sub") + f",\nmerged AS (SELECT part // {CHUNKS} AS part, id, p FROM sub),\n"
        + kcenter_chain("merged", k, "core") + f"\nSELECT part, ord, id, {_r('md', 'min_dist')} FROM core"
    ),
    "farthest_pair_orders": (
        "WITH op AS (SELECT o_orderkey AS id, o_custkey::DOUBLE AS x, o_totalprice::DOUBLE AS y, "
        "date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::DOUBLE AS z FROM orders), "
        "d AS (SELECT a.id AS i, b.id AS j, (a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z) AS sqd "
        f"FROM op a JOIN op b ON a.id < b.id) SELECT i, j, {_r('sqrt(sqd)', 'dist')} FROM d ORDER BY sqd DESC, i, j LIMIT 1"
    ),
    "farthest_pair": (
        f"WITH {_PTS} SELECT a.id AS i, b.id AS j, {_r('list_distance(a.p, b.p)', 'dist')} "
        "FROM pts a JOIN pts b ON a.id < b.id ORDER BY list_distance(a.p, b.p) DESC, a.id, b.id LIMIT 1"
    ),
    "greedy_matching": f"WITH {_PTS},\n{matching_chain('pts', k, 'gm')}\nSELECT round, id FROM gm",
    "average_pairwise_distance": (
        f"WITH {_PTS} SELECT {_r('avg(list_distance(a.p, b.p))', 'avg_dist')} FROM pts a JOIN pts b ON a.id < b.id"
    ),
    "diversity_maximization": f"WITH {_CORE}\nSELECT round, id FROM answer",
    "diversity_score": (
        f"WITH {_CORE}\nSELECT {_r('avg(list_distance(a.p, b.p))', 'avg_dist')} "
        "FROM answer a JOIN answer b ON a.id < b.id"
    ),
})
