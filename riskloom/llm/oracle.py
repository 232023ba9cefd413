"""The queries that SQL can express, as DuckDB SQL."""

RULES_SQL = r"""
WITH split AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
windows AS (
    SELECT r, i, list_slice(words, i, i + 4) AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM split)),
repeated AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1),
covered AS (
    SELECT r, sum(step) AS n FROM (
        SELECT r, least(5, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i), 5)) AS step FROM repeated)
    GROUP BY r),
measured AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
        coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words,
        len(lines) AS n_lines,
        len(regexp_extract_all(text, '[A-ZÀ-ÖØ-Þ]')) AS n_upper,
        len(regexp_extract_all(text, '!')) AS n_exclaims
    FROM split LEFT JOIN covered USING (r)),
ledger AS (
    SELECT *,
        (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
        + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 100 * n_symbols > 4 * word_chars THEN 4 ELSE 0 END
        + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
        + CASE WHEN 100 * n_upper > 30 * word_chars THEN 16 ELSE 0 END
        + CASE WHEN 100 * n_exclaims > 20 * n_words THEN 32 ELSE 0 END
        + CASE WHEN word_chars > 30 * n_words THEN 64 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words THEN 128 ELSE 0 END)::BIGINT AS failures
    FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures
FROM ledger
"""


def _codes_sql(rounds: int = 6) -> str:
    """Six rounds of assignment and floored means, one pair of tables after the other."""
    distance = "list_sum(list_transform(range(1, len(q) + 1), lambda i: (q[i] - c[i]) * (q[i] - c[i])))"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
assigned{r} AS MATERIALIZED (
    SELECT vec_id, label, p, any_value(q) AS q, min({distance}::HUGEINT * 16 + book{r}.entry) AS best
    FROM parts JOIN book{r} USING (p) GROUP BY vec_id, label, p)""")
        if r < rounds:
            steps.append(f"""
means{r} AS MATERIALIZED (
    SELECT p, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
        SELECT p, entry, i, sum(v) AS s, count(*) AS n FROM (
            SELECT p, (best % 16)::BIGINT AS entry, unnest(q) AS v, unnest(range(len(q))) AS i FROM assigned{r})
        GROUP BY p, entry, i)
    GROUP BY p, entry),
book{r + 1} AS MATERIALIZED (
    SELECT p, entry, coalesce(means{r}.c, book{r}.c) AS c FROM book{r} LEFT JOIN means{r} USING (p, entry))""")
    return f"""
WITH kept AS (
    SELECT vec_id, label, embedding AS e, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
    SELECT vec_id, label, entry, p, list_transform(
        list_slice(e, p * (len(e) // 8) + 1, (p + 1) * (len(e) // 8)), lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS q
    FROM (SELECT *, unnest(range(8)) AS p FROM kept)),
book0 AS MATERIALIZED (SELECT p, entry, q AS c FROM parts WHERE entry < 16),{",".join(steps)},
coded AS (
    SELECT vec_id, label, string_agg(printf('%02x', (best % 16)::BIGINT), '' ORDER BY p) AS code,
        sum(best // 16)::BIGINT AS error
    FROM assigned{rounds} GROUP BY vec_id, label),
digest AS (
    SELECT sha256(string_agg(list_aggregate(c, 'string_agg', ','), ',' ORDER BY p, entry)) AS codebooks_sha256
    FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded, digest
"""


CODES_SQL = _codes_sql()

AUDIT_SQL = r"""
WITH given AS (
    SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
least AS (SELECT t, min(doc_id) AS least FROM given GROUP BY t),
marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failing AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        (CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
        + CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN doc_id > least THEN 16 ELSE 0 END) AS mask
    FROM given JOIN least USING (t) LEFT JOIN marks USING (doc_id)),
cells AS (
    SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, mask),
letters AS (SELECT unnest(range(5)) AS k, unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.k, b.k, c.k, d.k, e.k] AS ks
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
steps AS (
    SELECT filter_order, step, ks[step] AS k,
        coalesce(list_sum(list_transform(ks[1:step - 1], lambda x: 1 << x)), 0)::BIGINT AS before
    FROM (SELECT *, unnest(range(1, 6)) AS step FROM orders)),
counted AS (
    SELECT part, filter_order, step, k,
        sum(CASE WHEN mask & (before | (1 << k)) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & before = 0 AND mask & (1 << k) <> 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & before <> 0 AND mask & (1 << k) <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = (1 << k) THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & before = 0 AND mask & (1 << k) <> 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & before = 0 AND mask & (1 << k) <> 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, k)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
    redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
    toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley
FROM counted
"""

# Lengths: the marks of a role's turn, and the mark at the start of a conversation.
CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
measured AS (
    SELECT *, length(text) + len(regexp_extract_all(text, '\\|</?s>|\[/?(?:SYS|INST|ROLE)\]|\[ANS\]'))
        + CASE role WHEN 'system' THEN length('[SYS][/SYS]') WHEN 'user' THEN length('[INST][/INST]')
            WHEN 'assistant' THEN length('[ANS]</s>')
            ELSE length('[ROLE][/ROLE]</s>') + length(role)
                + len(regexp_extract_all(role, '\\|</?s>|\[/?(?:SYS|INST|ROLE)\]|\[ANS\]')) END AS chars
    FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), ''))
        AS loss_sha256,
    (length('<s>') + sum(chars))::BIGINT AS formatted_chars
FROM measured GROUP BY conv_id"""

# All pairs of documents with a common shingle are counted: for small tables.
LINKS_SQL = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 2), ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM split WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS one, b.doc_id AS other, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
    SELECT one, other FROM common c JOIN sizes a ON one = a.doc_id JOIN sizes b ON other = b.doc_id
    WHERE 100 * c.n >= 85 * (a.n + b.n - c.n)),
reached AS (
    SELECT doc_id, doc_id AS there FROM split
    UNION SELECT reached.doc_id, other FROM reached JOIN links ON there = one),
components AS (SELECT doc_id, min(there) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM split JOIN components USING (doc_id) LEFT JOIN sizes USING (doc_id)"""

# Two hexadecimal digits a byte; a window for every byte: for small tables.
WINDOWS_SQL = r"""
WITH bytes AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents),
starts AS (
    SELECT r, p, md5(substr(digits, 2 * p + 1, 400)) AS window_md5
    FROM (SELECT r, digits, unnest(range(0, length(digits) // 2 - 199)) AS p FROM bytes)),
repeated AS (
    SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY window_md5) AS n FROM starts) WHERE n > 1),
numbered AS (
    SELECT r, p, sum(opens) OVER (PARTITION BY r ORDER BY p) AS span
    FROM (SELECT r, p, (coalesce(p - lag(p) OVER (PARTITION BY r ORDER BY p), 201) > 200)::INT AS opens FROM repeated)),
spans AS (SELECT r, span, min(p) AS s, max(p) + 200 AS e FROM numbered GROUP BY r, span),
edges AS (
    SELECT r, lag(e, 1, 0) OVER (PARTITION BY r ORDER BY s) AS a, s AS b, e - s AS gone FROM spans
    UNION ALL SELECT bytes.r, coalesce(max(e), 0), any_value(length(digits)) // 2, NULL
    FROM bytes LEFT JOIN spans USING (r) GROUP BY bytes.r)
SELECT doc_id, any_value(length(digits) // 2)::BIGINT AS n_bytes, coalesce(sum(gone), 0)::BIGINT AS n_removed,
    count(gone)::BIGINT AS n_spans,
    sha256(unhex(string_agg(substr(digits, 2 * a + 1, 2 * (b - a)), '' ORDER BY a, b))) AS kept_sha256
FROM bytes JOIN edges USING (r) GROUP BY r, doc_id"""
