"""The operators that SQL can express, as DuckDB SQL over the given tables."""

from __future__ import annotations

from shelfline.llm import licenses, mixing, prefix_trie, ranking, rules, secrets, substrings

_WORD = r"[^\x20\x09-\x0D]+"


def op1() -> str:
    """Every area of the grid against every template by its shingles; no hashing, no bands."""
    known = licenses.templates()
    rows = ", ".join(
        f"('{t.name}', '{t.license}', {t.width}, {t.stride}, {t.area}, {len(t.shingles)}, '{' '.join(s)}')"
        for t in known
        for s in t.shingles
    )
    return rf"""
    WITH template(name, license, width, stride, span, n, shingle) AS (VALUES {rows}),
    words AS (
      SELECT row_number() OVER () AS r, doc_id,
             list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
      FROM documents WHERE text IS NOT NULL),
    widths AS (SELECT DISTINCT width FROM template),
    shingles AS (
      SELECT r, doc_id, width, len(w) - width + 1 AS m, unnest(range(len(w) - width + 1)) AS p, w FROM words, widths
      WHERE len(w) >= width),
    hits AS (
      SELECT s.r, s.doc_id, s.p, s.m, t.* FROM shingles s JOIN template t
      ON t.width = s.width AND t.shingle = array_to_string(s.w[s.p + 1 : s.p + s.width], ' ')),
    windows AS (
      SELECT *, p // stride AS k FROM hits
      UNION ALL SELECT *, p // stride - 1 AS k FROM hits WHERE span > stride
      UNION ALL SELECT *, p // stride - 2 AS k FROM hits WHERE span > stride),
    counted AS (
      SELECT r, doc_id, name, license, k, count(DISTINCT shingle) / n::DOUBLE AS share FROM windows
      WHERE k >= 0 AND k < CASE WHEN span > stride THEN greatest(ceil(m / stride)::BIGINT - 2, 1) ELSE m END
      GROUP BY r, doc_id, name, license, k, n)
    SELECT doc_id, name AS template, license, max(share) AS containment FROM counted
    WHERE share >= {licenses.CONTAINMENT} GROUP BY doc_id, name, license"""


def op4(share: float = 1.5, weights: tuple[int, ...] = (5, 2, 1), seed: str = "mix-1") -> str:
    case = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return rf"""
    WITH sized AS (
      SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
             ('0x' || md5(coalesce(doc_id::VARCHAR, 'null') || '|{seed}')[1:13])::BIGINT AS key
      FROM documents),
    totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    ranked AS (
      SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk, sum(source_size) OVER () AS total FROM totals),
    weighed AS (SELECT *, CASE rk % {len(weights)} {case} END AS w, 2 * source_size AS cap FROM ranked),
    leveled AS (
      SELECT *, row_number() OVER (ORDER BY cap / w, rk) AS place,
        (total * {share}::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, rk
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
          / (sum(w) OVER (ORDER BY cap / w, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
      FROM weighed),
    first AS (SELECT arg_min(level, place) AS level, min(place) AS place FROM leveled WHERE level * w <= cap),
    goals AS (
      SELECT l.source, l.source_size, l.total,
             CASE WHEN l.place >= f.place THEN f.level * l.w ELSE l.cap END::DOUBLE AS target
      FROM leveled l, first f),
    sent AS (
      SELECT d.*, g.source_size, g.target, g.total,
             sum(size) OVER (PARTITION BY d.source ORDER BY key, size, d.doc_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
      FROM sized d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
    times AS (
      SELECT *, CASE WHEN target > 0 THEN c::DOUBLE / target END AS v0,
                CASE WHEN target > 0 THEN (c + source_size)::DOUBLE / target END AS v1 FROM sent),
    turns AS (
      SELECT v0 AS v, size, total FROM times WHERE size > 0 UNION ALL SELECT v1, size, total FROM times WHERE size > 0),
    ends AS (SELECT v, sum(size) OVER (ORDER BY v) AS e, total FROM turns),
    cut AS (SELECT coalesce(min(v), 'infinity'::DOUBLE) AS v FROM ends WHERE e > total * {share}::DOUBLE)
    SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, copies FROM (
      SELECT t.*, CASE WHEN size > 0 THEN (v0 < cut.v)::INT + (v1 < cut.v)::INT ELSE 0 END::INT AS copies
      FROM times t, cut)"""


def op5() -> str:
    current = rules.mask(rules.CURRENT)
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT r, regexp_extract_all(text, '{_WORD}') AS ws FROM d),
    spots AS (SELECT r, ws, unnest(range(len(ws) - 2)) AS p FROM w WHERE len(ws) > 2),
    tri AS (SELECT r, p, count(*) OVER (PARTITION BY r, ws[p + 1], ws[p + 2], ws[p + 3]) AS n FROM spots),
    rep AS (
      SELECT r, count(DISTINCT p) AS n_repeat FROM (
        SELECT r, unnest([p, p + 1, p + 2]) AS p FROM tri WHERE n > 1) GROUP BY r),
    lines AS (
      SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM (
        SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORD}') GROUP BY r),
    m AS (
      SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words,
        coalesce(n_lines, 0) AS n_lines, length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) AS letters,
        length(regexp_replace(text, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) AS capitals
      FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN lines USING (r)),
    f AS (
      SELECT *, ((n_words < 50)::BIGINT | ((100 * n_repeat_words > 50 * n_words)::BIGINT << 1)
        | ((20 * n_symbols > word_chars)::BIGINT << 2) | ((100 * n_dup_lines > 30 * n_lines)::BIGINT << 3)
        | ((word_chars < 2 * n_words OR word_chars > 25 * n_words)::BIGINT << 4)
        | ((2 * letters < word_chars)::BIGINT << 5) | ((2 * capitals > letters)::BIGINT << 6)) AS failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      (failed & {rules.mask("base")}) <> 0 AS base_failed, (failed & {current}) = 0 AS kept, failed FROM f"""


def op10() -> str:
    """Lengths of the pieces between matches and of the matches, added up along the text."""
    parts = []
    for rank, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(
            rf"""SELECT r, {rank} AS rank, '{rule.kind}' AS kind, unnest(range(len(g))) AS i, g, m, j, {rule.shortest} AS shortest
            FROM (SELECT r, list_transform(regexp_split_to_array(text, '{pattern}'), lambda x: length(x)) AS g,
              list_transform(regexp_extract_all(text, '{pattern}'), lambda x: length(x)) AS m,
              list_transform(regexp_extract_all(text, '{pattern}', {rule.measured}), lambda x: length(x)) AS j
              FROM d WHERE regexp_matches(text, '{pattern}'))"""
        )
    counts = ", ".join(
        f"count(s.r) FILTER (s.kind = '{rule.kind}')::BIGINT AS n_{rule.kind}" for rule in secrets.BASE_RULES
    )
    line = "kind || ':' || start || ':' || stop"
    base = len(secrets.BASE_RULES)
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    found AS ({" UNION ALL ".join(parts)}),
    spans AS (
      SELECT r, rank, kind, (list_sum(g[:i + 1]) + coalesce(list_sum(m[:i]), 0))::BIGINT AS start,
        (list_sum(g[:i + 1]) + list_sum(m[:i + 1]))::BIGINT AS stop
      FROM found WHERE i < len(m) AND j[i + 1] >= shortest)
    SELECT d.doc_id, {counts},
      sha256(coalesce(string_agg({line}, ',' ORDER BY start, rank) FILTER (rank < {base}), '')) AS base_sha256,
      coalesce(string_agg({line}, ',' ORDER BY start, rank), '') AS spans
    FROM d LEFT JOIN spans s USING (r) GROUP BY d.r, d.doc_id"""


def op11() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

    def terms(table: str) -> str:
        return f"regexp_extract_all(translate(coalesce({table}.text, ''), '{upper}', '{upper.lower()}'), '{term}')"

    return rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms("documents")} AS w FROM documents),
    corpus AS (SELECT count(*) FILTER (len(w) > 0) AS docs, sum(len(w))::BIGINT AS total FROM d),
    posted AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
    items AS (SELECT row_number() OVER () AS i, item_id, {terms("b")} AS w
      FROM (SELECT DISTINCT item_id, text FROM benchmark) b),
    asked AS (SELECT i, t, count(*) AS times FROM (SELECT i, unnest(w) AS t FROM items) GROUP BY i, t),
    weighed AS (
      SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM posted, corpus WHERE t IN (SELECT t FROM asked) GROUP BY t),
    scored AS (
      SELECT a.i, p.r, sum(a.times * g.w * (({ranking.SCALE} * p.tf) // ({ranking.STEP} * p.tf
          + {ranking.SLOPE} * (100 - {ranking.SHARE} + ({ranking.SHARE} * len(d.w) * docs) // total))))::BIGINT AS score
      FROM asked a JOIN posted p USING (t) JOIN weighed g USING (t) JOIN d ON d.r = p.r, corpus GROUP BY a.i, p.r),
    ranked AS (
      SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
      FROM scored JOIN d USING (r) WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked JOIN items USING (i) WHERE rank <= {ranking.TOP}"""


def _crc32(text: str) -> str:
    """CRC-32 of a text of ASCII characters, bit by bit."""
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce([xor(c, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, y: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda z: ord(z)::BIGINT)"
    return f"xor(4294967295::BIGINT, list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {byte}))"


def op12() -> str:
    role, text = "coalesce(role, '')", "coalesce(text, '')"
    name = f"md5(length({role}) || ':' || {role} || {text})"
    return rf"""
    WITH t AS (
      SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {name}) AS p, {name} AS name,
        len(regexp_extract_all({text}, '{_WORD}'))::BIGINT AS words
      FROM conversations WHERE conv_id IS NOT NULL),
    c AS (
      SELECT conv_id, conv_id - conv_id % {prefix_trie.GROUP} AS base, {_crc32("conv_id::VARCHAR")} % {prefix_trie.HEADS} AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
    pieces AS (
      SELECT c.conv_id, 0 AS own, p, name, words FROM c JOIN t ON t.conv_id = c.base AND p <= h
      UNION ALL SELECT conv_id, 1, p, name, words FROM c JOIN t USING (conv_id) WHERE p > h),
    s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, p) AS d, name, words FROM pieces),
    spots AS (
      SELECT conv_id, d, words,
        md5(string_agg(name, '') OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING)) AS node FROM s
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
    m AS (
      SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY d) AS above,
        d = max(d) OVER (PARTITION BY conv_id) AS last FROM spots),
    nodes AS (
      SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, any_value(above) AS above,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
      FROM m GROUP BY node, d),
    kids AS (SELECT above AS node, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above),
    under AS (
      SELECT m.node, sum((v.n_convs - 1) * v.words)::BIGINT AS saved_tokens,
        count(*) FILTER (k.n IS NULL) AS n_leaves
      FROM nodes v LEFT JOIN kids k USING (node) JOIN m ON m.conv_id = v.conv_id AND m.d <= v.d GROUP BY m.node)
    SELECT n.conv_id, n.d::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
      u.n_leaves, u.saved_tokens, n.ends_sha256
    FROM nodes n JOIN under u USING (node) LEFT JOIN kids k USING (node) LEFT JOIN nodes up ON up.node = n.above"""


def op13() -> str:
    more = substrings.WINDOW - 1
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
    windows AS (
      SELECT r, p, md5(array_to_string(w[p : p + {more}], ' ')) AS h
      FROM (SELECT r, w, unnest(range(1, len(w) - {more} + 1)) AS p FROM d WHERE len(w) > {more})),
    repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
    hits AS (SELECT r, p, p AS start FROM windows SEMI JOIN repeated USING (h)),
    words AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
    judged AS (
      SELECT r, p, word, p - max(start) OVER (PARTITION BY r ORDER BY p ROWS UNBOUNDED PRECEDING) <= {more} AS gone
      FROM words LEFT JOIN hits USING (r, p)),
    kept AS (
      SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (gone IS NOT TRUE) AS text
      FROM judged GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
      sha256(coalesce(text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)"""


ORACLES = {
    "op1_license_scans": op1(),
    "op4_mixing": op4(),
    "op5_quality_rules": op5(),
    "op10_secret_scans": op10(),
    "op11_ranked_search": op11(),
    "op12_prefix_trie": op12(),
    "op13_substring_dedup": op13(),
}
