"""SQL twins of the queries that SQL can express on whole tables."""

COMPONENTS = """
reach AS (
    SELECT {id} AS id, {id} AS other FROM {nodes}
    UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
),
parts AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
degrees AS (SELECT a AS id, count(*) AS n_links FROM links GROUP BY a)
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def edited(state: str, cost: str, letter: str, written: str = "''") -> str:
    """A survivor (cost, edits, repaired rows) with one more edit; null stays null."""
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {state}.r || {written}}} END"


def with_inserts(s: list[str]) -> list[str]:
    """Survivors of the states nothing, system, user, assistant after one insertion or none."""
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    to_user = ", ".join(edited(s[i], "2", "I", user) for i in (0, 1, 3))
    return [s[0], s[1], f"least({s[2]}, {to_user})", f"least({s[3]}, {edited(s[2], '2', 'I', assistant)})"]


def after_row(s: list[str]) -> list[str]:
    """Survivors after the row x."""
    line = lambda role: f"chr(10) || {role} || ':' || x.text"
    able = lambda test, e: f"CASE WHEN NOT x.must AND {test} THEN {e} END"
    fits = lambda i: f"x.role[1] = '{i}'"
    gone = [edited(e, "3", "D") for e in s]

    def turned(i: int, initial: str, role: str) -> list[str]:
        return [able(fits(initial), edited(s[i], "x.extra", "K", line("x.role"))),
                able(f"NOT {fits(initial)}", edited(s[i], "2 + x.extra", "R", line(f"'{role}'")))]

    users = [e for i in (0, 1, 3) for e in turned(i, "u", "user")]
    return [gone[0], f"least({gone[1]}, {able(fits('s'), edited(s[0], 'x.extra', 'K', line('x.role')))})",
            f"least({', '.join([gone[2], *users])})", f"least({', '.join([gone[3], *turned(2, 'a', 'assistant')])})"]


def survivors(s: list[str]) -> str:
    return ", ".join(f"{e} AS s{i}" for i, e in enumerate(s))


STATES = [f"s{i}" for i in range(4)]

ORACLES: dict[str, str] = {
    "op1_embedding_near_dedup": f"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
),
able AS (
    SELECT vec_id, v FROM vectors
    WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
),
links AS (
    SELECT p.vec_id AS a, q.vec_id AS b FROM able p JOIN able q ON p.vec_id <> q.vec_id
    WHERE list_cosine_similarity(p.v, q.v) >= 0.95
),
{COMPONENTS.format(id="vec_id", nodes="vectors")}
SELECT p.id AS vec_id, coalesce(n_links, 0) AS n_links, component_id, p.id = component_id AS kept
FROM parts p LEFT JOIN degrees d ON d.id = p.id
""",
    "op2_ngram_jaccard_join": f"""
WITH RECURSIVE texts AS (
    SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'), lambda w: translate(w,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM texts WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT x.doc_id AS a, y.doc_id AS b
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
    JOIN sizes p ON p.doc_id = x.doc_id JOIN sizes q ON q.doc_id = y.doc_id
    GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
),
{COMPONENTS.format(id="doc_id", nodes="texts")}
SELECT p.id AS doc_id, coalesce(n, 0) AS n_shingles, coalesce(n_links, 0) AS n_links, component_id
FROM parts p LEFT JOIN degrees d ON d.id = p.id LEFT JOIN sizes s ON s.doc_id = p.id
""",
    "op3_exact_top_k": """
WITH able AS (
    SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(1024 * x)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM able q JOIN able c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scores)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 10
""",
    "op8_substring_dedup": """
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM texts WHERE len(w) >= 50)
),
firsts AS (SELECT s, min(doc_id) AS first_id FROM windows GROUP BY s),
gone AS (
    SELECT doc_id, list(DISTINCT p) AS gone FROM (
        SELECT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (s) WHERE first_id < doc_id
    ) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
    sha256(array_to_string(list_filter(w, lambda x, p: NOT list_contains(coalesce(gone, []), p)), ' ')) AS kept_sha256
FROM texts LEFT JOIN gone USING (doc_id)
""",
    "op11_conversation_repair": f"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
),
lots AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
            || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT))),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS lot
    FROM conversations, crc
),
hurt AS (
    SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
        CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN lot = 3 THEN 2 ELSE 1 END)) AS copy
    FROM lots WHERE lot <> 0
),
placed AS (
    SELECT conv_id, turn, role, text, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
        lag(role[1]) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) || role[1] AS neighbours
    FROM hurt
),
faults AS (
    SELECT *, shown = '' AS blank, shown <> '' AND again AS duplicate,
        shown <> '' AND NOT again AND shown[-1] NOT IN ('.', '!', '?') AS truncated
    FROM placed
),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
        count(*) FILTER (neighbours NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM faults GROUP BY conv_id
),
steps AS (
    SELECT conv_id, n, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 'r': ''}} AS s0, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR)) AS s1,
        CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR)) AS s2, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, r VARCHAR)) AS s3
    FROM counted
    UNION ALL
    SELECT conv_id, n, i, {survivors(after_row(STATES))}
    FROM (
        SELECT conv_id, n, i, x, {survivors(with_inserts(STATES))} FROM (
            SELECT p.conv_id, n, f.i, {{'role': f.role, 'text': f.text, 'must': f.blank OR f.duplicate, 'extra': CAST(f.truncated AS INTEGER)}} AS x,
                {survivors(with_inserts(STATES))}
            FROM steps p JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
        )
    )
),
ends AS (
    SELECT conv_id, least(s0, s3) AS e
    FROM (SELECT conv_id, {survivors(with_inserts(STATES))} FROM (SELECT conv_id, {survivors(with_inserts(STATES))} FROM steps WHERE i = n))
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(e.c, 0) AS BIGINT) AS cost, coalesce(e.a, '') AS audit,
    sha256(coalesce(substr(e.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
""",
    "op12_lexical_search": f"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '{TERM}'), lambda t: {LOWER.format("t")}) AS t
    FROM documents
),
size AS (SELECT count(*) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM texts WHERE len(t) > 0),
postings AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM texts) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, size GROUP BY term, docs
),
asked AS (
    SELECT DISTINCT item_id, {LOWER.format("term")} AS term
    FROM (SELECT item_id, unnest(regexp_extract_all(coalesce(text, ''), '{TERM}')) AS term FROM benchmark)
),
scores AS (
    SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(t) * docs) // terms)))) AS BIGINT) AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN texts USING (r), size GROUP BY item_id, r, doc_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS n FROM scores WHERE score > 0)
SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, score FROM ranked WHERE n <= 10
""",
}
