"""DuckDB SQL for the queries of this package that SQL can state."""

WORD = r"[^\x20\x09-\x0D]+"


def crc32(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit: each byte is followed by eight shifts."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (f"xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], {steps}::BIGINT[]), lambda s, x: "
            "CASE WHEN x >= 0 THEN xor(s, x) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384::BIGINT) ELSE s >> 1 END))")


# Two words p apart that begin 16 equal words lie in a run of period p or in one too short: a run has at least 16 words
# equal to those p later. Neighbouring pairs of one period make a stretch; stretches of several periods have the smallest.
OP11 = rf"""
WITH keyed AS (
    SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
           {crc32("doc_id::VARCHAR")} AS h
    FROM documents),
planned AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM keyed),
planted AS (
    SELECT k, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
        CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) ELSE w END AS w
    FROM planned),
spots AS (SELECT k, n, w, unnest(range(n - 15)) AS i FROM planted WHERE n >= 24),
blocks AS (SELECT k, n, i, array_to_string(w[i + 1:i + 16], ' ') AS b FROM spots),
pairs AS (SELECT x.k, x.i, y.i - x.i AS p FROM blocks x JOIN blocks y ON x.k = y.k AND x.b = y.b
          AND x.i < y.i AND 3 * (y.i - x.i) <= x.n),
islands AS (SELECT k, p, i, i - row_number() OVER (PARTITION BY k, p ORDER BY i) AS island FROM pairs),
stretches AS (SELECT k, p, min(i) AS s, max(i) - min(i) + 16 + p AS l FROM islands GROUP BY k, p, island),
runs AS (SELECT k, s, l, min(p) AS p FROM stretches WHERE l >= greatest(24, 3 * p) GROUP BY k, s, l),
best AS (SELECT k, count(*) AS n_runs, max(l::DOUBLE / p) AS top,
                string_agg(s || ',' || l || ',' || p || chr(10), '' ORDER BY s, p) AS listed FROM runs GROUP BY k),
first_best AS (SELECT r.k, min((s, p, l)) AS r FROM runs r JOIN best USING (k) WHERE l::DOUBLE / p = top GROUP BY r.k),
dropped AS (SELECT DISTINCT k, unnest(range(s + p, s + l)) AS i FROM runs),
gone AS (SELECT k, list(i) AS gone FROM dropped GROUP BY k),
kept AS (
    SELECT k, array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(n),
        lambda i: NOT list_contains(gone, i)), lambda i: w[i + 1]) END, ' ') AS collapsed
    FROM planted LEFT JOIN gone USING (k))
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, r[1] AS start, r[3] AS length, r[2] AS period,
       (1000 * r[3]) // r[2] AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(collapsed) AS collapsed_sha256
FROM planted LEFT JOIN best USING (k) LEFT JOIN first_best USING (k) JOIN kept USING (k)
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            f"'abcdefghijklmnopqrstuvwxyz'), '{TERM}')")


OP12 = f"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, {terms("text")} AS t FROM documents),
filled AS (SELECT k, doc_id, t, len(t)::BIGINT AS n FROM docs WHERE len(t) > 0),
total AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM filled),
items AS (SELECT row_number() OVER () AS i, item_id, {terms("text")} AS t FROM benchmark),
asked AS (SELECT i, t, count(*)::BIGINT AS c FROM (SELECT i, unnest(t) AS t FROM items) GROUP BY i, t),
counts AS (SELECT k, t, count(*)::BIGINT AS tf FROM (SELECT k, unnest(t) AS t FROM filled) GROUP BY k, t),
held AS (SELECT t, count(*)::BIGINT AS df FROM counts GROUP BY t),
weights AS (SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM held, total),
sizes AS (SELECT k, doc_id, 100 - 25 + (25 * n * nd) // nt AS m FROM filled, total),
scores AS (
    SELECT i, k, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM asked JOIN counts USING (t) JOIN weights USING (t) JOIN sizes USING (k) GROUP BY i, k, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank
           FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked JOIN items USING (i) WHERE rank <= 20
"""

ORACLE: dict[str, str] = {"op11_periodic_runs": OP11, "op12_dual_tree": OP12}
