"""DuckDB SQL for the operators whose results SQL can state.

Each text is written from the operator's contract, not from its method: windows
are compared as joined words instead of hashes or an automaton, repeats are
counted by grouping, and chat lengths follow from the escapes alone.
"""

from __future__ import annotations

from uptake.llm.quality import _NO_FOREIGN, FOREIGN, LANGUAGES, RULES, STOP_WORDS

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_FOLDED = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP3 = r"""
WITH chats AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
placed AS (
  SELECT *, row_number() OVER turns - 1 AS place, coalesce(lag(role) OVER turns, 'start') AS before,
    length(text) + length(regexp_replace(text, '[^\[\]<>\\]+', '', 'g')) AS body,
    CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9
      ELSE 14 + length(role) + length(regexp_replace(role, '[^\[\]<>\\]+', '', 'g')) END AS marks
  FROM chats WINDOW turns AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
judged AS (
  SELECT *, (before, role) NOT IN (('start', 'system'), ('start', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) AS broken
  FROM placed
),
chat AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS loss,
    sum(body + marks)::BIGINT AS formatted_chars,
    min(place) FILTER (broken) AS first_broken, arg_max(role, place) AS last_role
  FROM judged GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars,
  first_broken IS NULL AND last_role = 'assistant' AS valid,
  CASE WHEN first_broken IS NOT NULL THEN first_broken WHEN last_role <> 'assistant' THEN n_turns END AS bad_turn
FROM chat
"""


def _broken(rule) -> str:
    base = rule.per or "1"
    test = f"{rule.measure} > {base} * {rule.above}::DOUBLE" if rule.above is not None else f"{rule.measure} < {base} * {rule.below}::DOUBLE"
    if rule.unless_foreign:
        listed = ", ".join(f"'{x}'" for x in LANGUAGES)
        test += f" AND n_foreign <= word_chars * {FOREIGN}::DOUBLE AND coalesce(lower(lang) IN ({listed}), TRUE)"
    return f"(n_words >= {rule.from_words} AND n_lines >= {rule.from_lines} AND {test})"


OP5 = rf"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS five FROM texts, unnest(range(1, len(w) - 3)) AS places(i)
),
counted AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS times FROM windows),
covered AS (
  SELECT doc_id, count(DISTINCT word) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS word FROM counted WHERE times > 1) GROUP BY doc_id
),
measured AS (
  SELECT texts.doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    length(array_to_string(lines, '')) AS line_chars,
    length(array_to_string(lines, '')) - length(array_to_string(list_distinct(lines), '')) AS dup_line_chars,
    length(regexp_replace(array_to_string(w, ''), '{_NO_FOREIGN}', '', 'g')) AS n_foreign,
    coalesce(covered.n, 0) AS n_repeat_words,
    len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in STOP_WORDS)}))) AS n_stop_words,
    length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS n_upper
  FROM texts LEFT JOIN covered USING (doc_id)
),
failing AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR {" OR ".join(map(_broken, RULES))}) AS kept
FROM failing
"""

OP7 = f"""
WITH texts AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS run FROM texts, unnest(range(1, len(w) - 33)) AS places(i)
),
repeated AS (SELECT run FROM windows GROUP BY run HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS place FROM windows SEMI JOIN repeated USING (run)),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM texts),
left_over AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS kept
  FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN left_over USING (doc_id)
"""

OP10 = f"""
WITH texts AS (SELECT doc_id, {_FOLDED} AS w FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, {_FOLDED} AS w FROM benchmark),
asked AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS run
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS places(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT n FROM asked),
windows AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM texts CROSS JOIN sizes, unnest(range(1, len(w) - n + 2)) AS places(i)
),
hits AS (SELECT doc_id, i, n, item_id FROM windows JOIN asked USING (n, run)),
covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM hits) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

#: The 256 entries of the checksum's table from its polynomial, and a checksum of the bytes that ``hex`` names.
_CRC_TABLE = """
crc_bits(n, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY n) AS t FROM crc_bits WHERE k = 8)"""


def _crc(text: str) -> str:
    digit = lambda i: f"(instr('0123456789ABCDEF', substr(hex(encode({text})), {i}, 1)) - 1)"
    code = f"list_transform(range(0, strlen({text})), lambda i: ({digit('2 * i + 1')} * 16 + {digit('2 * i + 2')})::BIGINT)"
    step = "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({code}, {step}, 4294967295::BIGINT), 4294967295)"


OP11 = f"""
WITH RECURSIVE {_CRC_TABLE},
texts AS (
  SELECT row_number() OVER () AS r, doc_id, {_FOLDED} AS w FROM documents
),
runs AS (SELECT r, array_to_string(w[i:i + k - 1], ' ') AS f FROM texts, unnest(range(1, 4)) AS ks(k), unnest(range(1, len(w) - k + 2)) AS places(i)),
wanted AS (
  SELECT array_to_string(w[i:i + k - 1], ' ') AS f
  FROM (SELECT {_FOLDED} AS w FROM benchmark), unnest(range(1, 4)) AS ks(k), unnest(range(1, len(w) - k + 2)) AS places(i)
),
named AS (SELECT f, {_crc("f")} % 10000 AS bucket FROM (SELECT f FROM runs UNION SELECT f FROM wanted), crc_table),
corpus AS (SELECT bucket, count(*) AS s FROM runs JOIN named USING (f) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM wanted JOIN named USING (f) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM runs)::DOUBLE AS all_s, (SELECT count(*) FROM wanted)::DOUBLE AS all_t),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000) / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain
  FROM corpus LEFT JOIN target USING (bucket), sums
),
weighed AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM runs JOIN named USING (f) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(w) >= 20 AS eligible, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM texts LEFT JOIN weighed USING (r)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, count(*) OVER (PARTITION BY eligible) AS n FROM scored
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN eligible AND place <= 5 * n // 100 THEN place END AS rank FROM ranked
"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
_BEFORE_TEXT = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: One level: runs of eight nodes of a tree become their hash, until a tree has one node.
_UP = """
  SELECT tree, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM {0} WHERE n > 1 GROUP BY tree, level, pos // 8, n
"""

OP12 = f"""
WITH RECURSIVE {_CRC_TABLE},
hashed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({_BEFORE_TEXT} || {_FIELD.format("text")}) AS leaf,
    CASE WHEN {_crc("doc_id::VARCHAR")} % 3 = 0 THEN sha256({_BEFORE_TEXT} || {_FIELD.format(_LOWERED)}) END AS changed
  FROM documents, crc_table
),
leaves AS (
  SELECT *, row_number() OVER by_tree - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n, (row_number() OVER by_tree) || tree AS r
  FROM hashed WINDOW by_tree AS (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf)
),
nodes(tree, level, pos, n, h) AS (SELECT tree, 0, pos, n, leaf FROM leaves UNION ALL {_UP.format("nodes")}),
subroots AS (SELECT tree, level AS height, h AS subroot FROM nodes WHERE n = 1),
tops(tree, level, pos, n, h) AS (
  SELECT '', 0, row_number() OVER (ORDER BY tree) - 1, count(*) OVER (), subroot FROM subroots UNION ALL {_UP.format("tops")}
),
named AS (SELECT *, row_number() OVER (ORDER BY tree) - 1 AS top_pos FROM subroots),
steps AS (
  SELECT tree, 0 AS part, level, pos, h FROM nodes WHERE n > 1
  UNION ALL SELECT '', 1, level, pos, h FROM tops WHERE n > 1
),
runs AS (SELECT tree, part, level, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM steps GROUP BY ALL),
ancestors AS (
  SELECT r, part, level, CASE part WHEN 0 THEN l.pos ELSE top_pos END // (8 ** level)::BIGINT AS spot, runs.hs
  FROM leaves l JOIN named USING (tree)
  JOIN runs ON runs.tree = CASE part WHEN 0 THEN l.tree ELSE '' END
    AND runs.run = CASE part WHEN 0 THEN l.pos ELSE top_pos END // (8 ** (level + 1))::BIGINT
),
sides AS (
  SELECT r, part, level, array_to_string(hs[1:spot % 8], '') AS before, array_to_string(hs[spot % 8 + 2:], '') AS after FROM ancestors
),
paths AS (
  SELECT r, list({{'before': before, 'after': after}} ORDER BY part, level) AS path, string_agg(before || after, '' ORDER BY part, level) AS proof FROM sides GROUP BY r
),
proven AS (
  SELECT l.*, subroot, (SELECT h FROM tops WHERE n = 1) AS root, coalesce(path, []) AS path, sha256(coalesce(proof, '')) AS proof_sha256
  FROM leaves l JOIN subroots USING (tree) LEFT JOIN paths USING (r)
),
folds(r, k, h) AS (
  SELECT r, 0, coalesce(changed, leaf) FROM proven
  UNION ALL SELECT r, k + 1, sha256(path[k + 1].before || h || path[k + 1].after) FROM folds JOIN proven USING (r) WHERE k < len(path)
)
SELECT doc_id, leaf, subroot, root, proof_sha256, h AS folded_root, h = root AS verified FROM proven JOIN folds ON folds.r = proven.r AND k = len(path)
"""

ORACLE: dict[str, str] = {
    "op3_chat_formatting": OP3,
    "op5_quality_rules": OP5,
    "op7_substring_dedup": OP7,
    "op10_decontamination": OP10,
    "op11_importance_resampling": OP11,
    "op12_merkle_manifest": OP12,
}
