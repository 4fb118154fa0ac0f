"""DuckDB SQL for the training-data queries that SQL can express.

Without an oracle: licence scan, quality, language, packing, tokens and files need an
index, a model or a tokenizer; personal data needs lookarounds, which DuckDB's patterns
lack; fingerprints need hashes that it lacks. Tests hold these against brute force.
"""

from pointstream.llm.chat import BEGIN, CONTROL, END
from pointstream.llm.merkle import A_Z, FAN, LOWER
from pointstream.llm.spelling import FORM_TIMES, LETTERS, MIN_CHARS, MIN_COUNT

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_ALNUM} AS w FROM benchmark),
bn AS (SELECT item, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bi AS (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bn),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM bi),
sizes AS (SELECT DISTINCT n FROM bw),
di AS (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM d CROSS JOIN sizes WHERE len(w) >= n),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM di),
h AS (SELECT dw.doc_id, dw.n, dw.i, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
places AS (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM places GROUP BY doc_id),
named AS (SELECT DISTINCT doc_id, item FROM h),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM named GROUP BY doc_id)
SELECT
    d.doc_id,
    CAST(len(d.w) AS BIGINT) AS n_words,
    CAST(coalesce(hit.n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(items.n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(items.items, '')) AS items_sha256,
    hit.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

_JACCARD_JOIN = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dn AS (SELECT doc_id, w, least(len(w), 5) AS n FROM d WHERE len(w) > 0),
di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dn),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + n - 1], ' ') AS shingle FROM di),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
    SELECT one.doc_id AS a, two.doc_id AS b, count(*) AS n
    FROM s AS one JOIN s AS two ON one.shingle = two.shingle AND one.doc_id != two.doc_id
    GROUP BY one.doc_id, two.doc_id),
links AS (
    SELECT c.a, c.b FROM common AS c
    JOIN sizes AS x ON x.doc_id = c.a JOIN sizes AS y ON y.doc_id = c.b
    WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
reached AS (
    SELECT doc_id AS a, doc_id AS b FROM d
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
least_of AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT d.doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles, least_of.component_id
FROM d LEFT JOIN sizes ON sizes.doc_id = d.doc_id JOIN least_of ON least_of.a = d.doc_id
"""


def _control() -> str:
    """Pattern of the control strings, with any number of backslashes behind the first character."""
    rest = "|".join(c[1:].replace("|", r"\|").replace("]", r"\]") for c in CONTROL)
    return rf"[<\[]\\*(?:{rest})"


_CHAT = f"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT
    conv_id,
    count(*) AS n_turns,
    sha256(string_agg(
        r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, r, x)) AS turns_sha256,
    CAST(sum(CASE WHEN r = 'assistant' THEN length(x) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(
        CASE WHEN r = 'assistant' THEN x ELSE '' END, '' ORDER BY turn NULLS FIRST, r, x
    ), '')) AS loss_sha256,
    CAST(sum(
        {len(BEGIN)} + length(r) + len(regexp_extract_all(r, '[\\\\\\n]'))
        + len(regexp_extract_all(r, '{_control()}')) + 1
        + length(x) + len(regexp_extract_all(x, '{_control()}')) + {len(END)}
    ) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

# crc32 by bytes, with the table of its remainders made from its polynomial.
_CRC_TABLE = """(SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, [j FOR j IN range(8)]),
    lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc(text: str) -> str:
    """Unsigned crc32 of a text, where ``t`` is the table."""
    hexed = f"hex({text})"
    bytes_of = f"[CAST('0x' || {hexed}[2 * j + 1:2 * j + 2] AS BIGINT) FOR j IN range(len({hexed}) // 2)]"
    step = "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {bytes_of}), {step}), 4294967295)"


_SPELLING = f"""
WITH RECURSIVE runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[{LETTERS}]+')), '{A_Z}', '{LOWER}') AS run
    FROM documents),
pairs AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= {MIN_CHARS} GROUP BY doc_id, run),
hashed AS (
    SELECT run, k, {_crc("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h
    FROM pairs CROSS JOIN {_CRC_TABLE} AS crc_table),
typed AS (
    SELECT k, CASE WHEN h % 199 = 0
        THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word
    FROM hashed),
words AS (
    SELECT word, CAST(sum(k) AS BIGINT) AS n FROM typed
    WHERE length(word) >= {MIN_CHARS} GROUP BY word HAVING sum(k) >= {MIN_COUNT}),
lost AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
rests AS (SELECT word, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM lost),
near AS (
    SELECT one.word, two.word AS near FROM rests AS one JOIN rests AS two
        ON one.i = two.i AND one.rest = two.rest AND one.word != two.word
    UNION SELECT rests.word, words.word FROM rests JOIN words ON rests.rest = words.word
    UNION SELECT words.word, rests.word FROM rests JOIN words ON rests.rest = words.word),
ordered AS (
    SELECT near.word, near.near, words.n AS near_n, count(*) OVER (PARTITION BY near.word) AS n_near,
        row_number() OVER (PARTITION BY near.word ORDER BY words.n DESC, encode(near.near)) AS place
    FROM near JOIN words ON words.word = near.near),
formed AS (
    SELECT words.word, words.n, coalesce(o.n_near, 0) AS n_near,
        CASE WHEN o.near_n >= {FORM_TIMES} * words.n THEN o.near END AS form,
        CASE WHEN o.near_n >= {FORM_TIMES} * words.n THEN o.near_n END AS form_n
    FROM words LEFT JOIN ordered AS o ON o.word = words.word AND o.place = 1),
followed AS (
    SELECT word, word AS root FROM formed
    UNION ALL
    SELECT followed.word, formed.form FROM followed JOIN formed ON formed.word = followed.root
    WHERE formed.form IS NOT NULL)
SELECT formed.word, formed.form, followed.root, formed.n, CAST(formed.n_near AS BIGINT) AS n_near, formed.form_n
FROM formed JOIN followed ON followed.word = formed.word
JOIN formed AS last ON last.word = followed.root AND last.form IS NULL
"""

# Levels that the SQL of the manifest goes up: enough for a group of FAN ** LEVELS rows.
_SQL_LEVELS = 7


def _merkle() -> str:
    def value(column: str) -> str:
        text = f"CAST({column} AS VARCHAR)"
        return f"coalesce(CAST(octet_length(encode({text})) AS VARCHAR) || ':' || {text}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(value, ["doc_id", "source", "lang", "n_chars", text])) + ")"

    lowered = f"translate(text, '{A_Z}', '{LOWER}')"
    parts = [
        f"""leaves AS (
    SELECT doc_id, lang, {leaf("text")} AS leaf,
        CASE WHEN {_crc("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {leaf(lowered)} END AS changed
    FROM documents CROSS JOIN {_CRC_TABLE} AS crc_table)""",
        """placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        dense_rank() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS tree
    FROM leaves)""",
    ]

    def levels(name: str, lowest: str) -> None:
        """Levels 0 to _SQL_LEVELS of trees of (tree, place, digest); a root goes on as it is."""
        parts.append(f"{name}0 AS ({lowest})")
        for k in range(_SQL_LEVELS):
            parts.append(f"""{name}{k + 1} AS (
    SELECT tree, place // {FAN} AS place,
        CASE WHEN max(size) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY place)) END AS digest,
        any_value((size + {FAN - 1}) // {FAN}) AS size
    FROM {name}{k} GROUP BY tree, place // {FAN})""")

    def climb(start: str, name: str, tree: str, place: str) -> str:
        """Adds the siblings of each level to ``proof`` and goes on with ``folded``."""
        for k in range(_SQL_LEVELS):
            mine = f"(f.{place} // {FAN**k})"
            side = f"SELECT tree, place // {FAN} AS up, list(struct_pack(p := place, d := digest) ORDER BY place) AS kids, max(size) AS size FROM {name}{k} GROUP BY tree, place // {FAN}"
            joined = lambda op: f"array_to_string([x.d FOR x IN kids IF x.p {op} {mine}], '')"
            step = f"{name}_up{k + 1}"
            parts.append(f"""{step} AS (
    SELECT f.* EXCLUDE (proof, folded), proof || {joined("<")} || {joined(">")} AS proof,
        CASE WHEN g.size = 1 THEN folded ELSE sha256({joined("<")} || folded || {joined(">")}) END AS folded
    FROM {start} AS f JOIN ({side}) AS g ON g.tree = f.{tree} AND g.up = f.{place} // {FAN ** (k + 1)})""")
            start = step
        return start

    levels("l", "SELECT tree, place, leaf AS digest, count(*) OVER (PARTITION BY tree) AS size FROM placed")
    levels("t", f"SELECT 0 AS tree, tree AS place, digest, count(*) OVER () AS size FROM l{_SQL_LEVELS}")
    parts.append("begun AS (SELECT *, 0 AS zero, '' AS proof, coalesce(changed, leaf) AS folded FROM placed)")
    last = climb(climb("begun", "l", "tree", "place"), "t", "zero", "tree")
    return f"""
WITH {", ".join(parts)}
SELECT f.doc_id, f.leaf, s.digest AS subroot, r.digest AS root, sha256(f.proof) AS proof_sha256,
    f.folded AS folded_root, f.folded = r.digest AS verified
FROM {last} AS f JOIN l{_SQL_LEVELS} AS s ON s.tree = f.tree CROSS JOIN t{_SQL_LEVELS} AS r
"""


ORACLES: dict[str, str] = {
    "op1_decontamination": _DECONTAMINATION,
    "op3_jaccard_join": _JACCARD_JOIN,
    "op8_chat_formatting": _CHAT,
    "op11_spelling_variants": _SPELLING,
    "op12_merkle_manifest": _merkle(),
}
