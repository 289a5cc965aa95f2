"""The same results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents
),
runs AS (
    SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS run
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM split)
),
earliest AS (SELECT run, min(doc_id) AS low FROM runs GROUP BY run),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p
    FROM runs JOIN earliest USING (run) WHERE low < doc_id
),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM split),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
    FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT s.doc_id, len(s.words)::BIGINT AS n_words, (len(s.words) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k USING (doc_id)
"""

OP2 = rf"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents
),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM split),
runs AS (
    SELECT doc_id, n, p, array_to_string(words[p:p + n - 1], ' ') AS run
    FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS p FROM split CROSS JOIN (SELECT unnest(range(5, 11)) AS n))
),
counted AS (
    SELECT doc_id, n, p, count(*) OVER (PARTITION BY doc_id, n, run) AS times,
           row_number() OVER (PARTITION BY doc_id, n, run ORDER BY p) AS turn
    FROM runs
),
later AS (SELECT DISTINCT doc_id, n, unnest(range(p, p + n)) AS p FROM counted WHERE turn > 1),
chars AS (SELECT doc_id, n, sum(length(word))::BIGINT AS chars FROM later JOIN placed USING (doc_id, p) GROUP BY ALL),
wide AS (
    SELECT doc_id, {", ".join(f"max(chars) FILTER (n = {n}) AS dup{n}_chars" for n in range(5, 11))} FROM chars GROUP BY doc_id
),
repeated AS (
    SELECT doc_id, count(*) AS n_repeat_words
    FROM (SELECT DISTINCT doc_id, unnest(range(p, p + 8)) FROM counted WHERE n = 8 AND times > 1) GROUP BY doc_id
),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM split),
again AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS turn FROM lines),
line_sums AS (
    SELECT doc_id, count(*) AS n_dup_lines, sum(length(array_to_string(regexp_extract_all(line, '{WORD}'), '')))::BIGINT AS dup_line_chars
    FROM again WHERE turn > 1 AND regexp_matches(line, '{WORD}') GROUP BY doc_id
),
figures AS (
    SELECT s.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(dup_line_chars, 0) AS dup_line_chars,
           {", ".join(f"coalesce(dup{n}_chars, 0) AS dup{n}_chars" for n in range(5, 11))}
    FROM split s LEFT JOIN line_sums USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN wide USING (doc_id)
),
base AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM figures)
SELECT *, NOT base_failed AND 100 * dup_line_chars <= 20 * word_chars AND 100 * n_symbols <= 10 * n_words
       AND {" AND ".join(f"100 * dup{n}_chars <= {20 - n} * word_chars" for n in range(5, 11))} AS kept
FROM base
"""

LOWER = f"translate(coalesce(text, ''), '{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'}', '{'abcdefghijklmnopqrstuvwxyz'}')"

OP5 = rf"""
WITH texts AS (
    SELECT doc_id, list_append(regexp_extract_all({LOWER}, '{WORD}'), ' end') AS tokens,
           xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
               lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::UBIGINT FOR x IN range(8)]),
                   lambda a, b: xor(a >> 1, 3988292384::UBIGINT * (a & 1)))), 4294967295::UBIGINT) % 10 = 0 AS held_out
    FROM documents
),
steps AS (
    SELECT doc_id, held_out, unnest(tokens) AS token, unnest(list_prepend(' start', tokens[:-2])) AS before FROM texts
),
ones AS (SELECT token, count(*) AS c FROM steps WHERE NOT held_out GROUP BY token),
twos AS (SELECT before, token, count(*) AS c FROM steps WHERE NOT held_out GROUP BY ALL),
states AS (SELECT token AS before, c FROM ones UNION ALL SELECT ' start', c FROM ones WHERE token = ' end'),
whole AS (SELECT sum(c)::BIGINT AS n, count(*) AS v FROM ones),
weighed AS (
    SELECT doc_id, held_out, coalesce(o.c, 0) AS c, coalesce(t.c, 0) AS pair, coalesce(h.c, 0) AS state, n,
           (coalesce(o.c, 0) + 0.1::DOUBLE) / (n + 0.1::DOUBLE * (v + 1)) AS p
    FROM steps s CROSS JOIN whole LEFT JOIN ones o USING (token) LEFT JOIN twos t ON t.before = s.before AND t.token = s.token
    LEFT JOIN states h ON h.before = s.before
)
SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (c > 0) AS n_known, n AS train_tokens,
       round(sum(log10(p)), 6) AS base_score, round(sum(log10((pair + 300 * p) / (state + 300))), 6) AS score
FROM weighed GROUP BY doc_id, held_out, n
"""

def _op9(levels: int = 4) -> str:
    """Sizes, targets and draws, then the splitting tree level by level."""
    tree = "nodes0 AS (SELECT line, 0 AS node, count(*) AS quota FROM draws GROUP BY line)"
    for level in range(levels):
        tree += f""",
units{level} AS (
    SELECT line, node, row_number() OVER (PARTITION BY node ORDER BY md5('mix:{level}:' || node || ':' || line || ':' || unit), line, unit) AS drawn,
           count(*) OVER (PARTITION BY node) AS n
    FROM (SELECT line, node, unnest(range(1, quota + 1)) AS unit FROM nodes{level})
),
nodes{level + 1} AS (
    SELECT line, 2 * node + CASE WHEN drawn <= (n + (node + {level}) % 2) // 2 THEN 0 ELSE 1 END AS node, count(*) AS quota FROM units{level} GROUP BY ALL
)"""
    return rf"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
           md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS key
    FROM documents
),
totals AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS line FROM sized GROUP BY source
),
weighed AS (
    SELECT *, ([3.0, 1.0, 2.0])[(line - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap,
           1.5::DOUBLE * sum(source_size) OVER () AS words
    FROM totals
),
-- the level of water: a source is full when what the emptier ones leave would lift it over its cap
filled AS (
    SELECT *, (words - coalesce(sum(cap) OVER (ORDER BY cap / weight, line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
              >= cap * sum(weight) OVER (ORDER BY cap / weight, line ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS full_up
    FROM weighed
),
targets AS (
    SELECT source, line, source_size,
           CASE WHEN full_up THEN cap
                ELSE (words - sum(CASE WHEN full_up THEN cap ELSE 0 END) OVER ()) * weight / sum(CASE WHEN full_up THEN 0 ELSE weight END) OVER ()
           END AS target
    FROM filled
),
docs AS (
    SELECT d.*, t.line, t.source_size, t.target, left(key, 2) AS block, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS rounds
    FROM sized d JOIN targets t ON t.source IS NOT DISTINCT FROM d.source
),
blocks AS (
    SELECT line, block, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY line ORDER BY md5(line || ':' || block), block) - sum(size) AS before
    FROM docs GROUP BY line, block
),
offers AS (
    SELECT d.*, b.words AS block_words, target - rounds * source_size - before AS rest,
           sum(size) OVER (PARTITION BY d.line, d.block ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS upto
    FROM docs d JOIN blocks b ON b.line = d.line AND b.block = d.block
),
lines AS (
    SELECT DISTINCT b.line, b.block, b.words AS block_words, row_number() OVER (PARTITION BY b.line ORDER BY md5(b.line || ':' || b.block), b.block) AS place,
           target - floor(target / source_size) * source_size - before AS rest, floor(target / source_size)::BIGINT AS rounds
    FROM blocks b JOIN targets t ON t.line = b.line WHERE source_size > 0
),
draws AS (
    SELECT *, row_number() OVER (PARTITION BY line ORDER BY round, place) AS turn
    FROM (SELECT line, block, place, unnest(range(rounds)) AS round, true AS is_whole FROM lines
          UNION ALL SELECT line, block, place, rounds, rest >= block_words FROM lines WHERE rest > 0)
),
{tree},
dealt AS (
    SELECT line, node AS shard, row_number() OVER (PARTITION BY line ORDER BY node, unit) AS turn
    FROM (SELECT line, node, unnest(range(1, quota + 1)) AS unit FROM nodes{levels})
),
homes AS (
    SELECT line, block, coalesce(list(shard ORDER BY round, shard) FILTER (is_whole), []) AS wholes, max(shard) FILTER (NOT is_whole) AS part
    FROM draws JOIN dealt USING (line, turn) GROUP BY ALL
),
taking AS (
    SELECT o.*, coalesce(wholes, []) || CASE WHEN part IS NOT NULL AND 2 * upto - size <= 2 * rest THEN [part] ELSE [] END AS places
    FROM offers o LEFT JOIN homes h ON h.line = o.line AND h.block = o.block
)
SELECT doc_id, size, source_size, target, array_to_string(places, ',') AS shards,
       (size * (rounds + CASE WHEN rest > 0 AND (rest >= block_words OR 2 * upto - size <= 2 * rest) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM taking
"""


OP9 = _op9()

OP10 = rf"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS words FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(words) = 1 THEN words[1] ELSE words[p] || ' ' || words[p + 1] END AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words), least(len(words), 1) + 1))) AS p FROM split)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)
),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, seen) AS (SELECT a, b FROM ways UNION SELECT r.id, b.b FROM reach r JOIN ways b ON b.a = r.seen),
lowest AS (SELECT id AS doc_id, min(seen) AS low FROM reach GROUP BY id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM split LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""

OP11 = """
WITH usable AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, o.vec_id, a.label = o.label AS same, list_inner_product(a.v, o.v)::BIGINT AS score
    FROM usable a JOIN usable o ON a.vec_id <> o.vec_id WHERE a.vec_id % 50 = 0
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER best)::INTEGER AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER best <= 3
"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::UBIGINT FOR x IN range(8)]),
            lambda a, b: xor(a >> 1, 3988292384::UBIGINT * (a & 1)))), 4294967295::UBIGINT)"""


def _op12() -> str:
    """Cost and letters of the rest of a conversation as one text that sorts by cost, then letters; what the rest turns
    into follows behind chr(1).  s0 to s3 are the states: start, after system, after user, after assistant."""
    then, role = (2, 2, 3, 2), ("user", "user", "assistant", "user")
    kept = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}

    def step(letter: str, price: str, state: str, turn: str) -> str:
        return f"""(lpad(((left({state}, 9))::BIGINT + {price})::VARCHAR, 9, '0') || '{letter}' || split_part(substr({state}, 10), chr(1), 1)
            || chr(1) || {turn} || substr({state}, 11 + length(split_part(substr({state}, 10), chr(1), 1))))"""

    def raw(q: int) -> str:
        ways = [step("D", "4", f"s{q}", "''")]
        ways.append(f"CASE WHEN sound THEN {step('R', '3 + late', f's{then[q]}', f'chr(10) || {chr(39)}{role[q]}:{chr(39)} || text')} END")
        ways += [f"CASE WHEN sound AND initial = '{i}' THEN {step('K', 'late', f's{to}', 'chr(10) || role || chr(58) || text')} END" for (i, at), to in kept.items() if at == q]
        return f"least({', '.join(ways)})"

    def inserting(states: str) -> str:
        put = lambda q: step("I", "3", f"s{then[q]}", f"chr(10) || '{role[q]}:'")
        once = f"SELECT * REPLACE (least(s2, {put(2)}) AS s2, least(s3, {put(3)}) AS s3) FROM ({states})"
        return f"SELECT * REPLACE (least(s0, {put(0)}) AS s0, least(s1, {put(1)}) AS s1) FROM ({once})"

    never, done = "'900000000' || chr(1)", "'000000000' || chr(1)"
    return rf"""
WITH RECURSIVE filled AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
    FROM conversations
),
hurt AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) FROM filled WHERE kind <> 0)
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial FROM hurt
),
judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
    FROM placed
),
lines AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS sound, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS late FROM judged),
figures AS (
    SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM lines GROUP BY conv_id
),
rest(conv_id, i, s0, s1, s2, s3) AS (
    {inserting(f"SELECT conv_id, n AS i, {done} AS s0, {never} AS s1, {never} AS s2, {done} AS s3 FROM figures")}
    UNION ALL
    {inserting(f"SELECT r.conv_id, r.i - 1 AS i, {raw(0)} AS s0, {raw(1)} AS s1, {raw(2)} AS s2, {raw(3)} AS s3 FROM rest r JOIN lines USING (conv_id, i)")}
),
best AS (SELECT conv_id, left(s0, 9)::BIGINT AS cost, split_part(substr(s0, 10), chr(1), 1) AS audit, substr(s0, 12 + length(audit)) AS repaired FROM rest WHERE i = 0)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN figures USING (conv_id) LEFT JOIN best USING (conv_id)
"""


OP12 = _op12()

OP13 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, i, ['user', 'assistant'][i + 1], '<|im_end|><|im_start|>assistant ok' FROM range(2) t(i)
),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM turns),
lengths AS (
    SELECT *, length(text) + len(regexp_extract_all(text, '<\\*\|im_(start|end)\|>'))
                + length(role) + len(regexp_extract_all(role, '\\|\n')) + len(regexp_extract_all(role, '<\\*\|im_(start|end)\|>')) AS chars
    FROM placed
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars + length('<|im_start|>') + length('<|im_end|>') + 2)::BIGINT AS formatted_chars
FROM lengths GROUP BY conv_id
"""

ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1,
    "op2_quality_rules": OP2,
    "op5_lm_scoring": OP5,
    "op9_source_mixing": OP9,
    "op10_minhash_near_dedup": OP10,
    "op11_hard_negatives": OP11,
    "op12_conversation_repair": OP12,
    "op13_chat_formatting": OP13,
}
