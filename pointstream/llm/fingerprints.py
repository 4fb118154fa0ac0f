"""Order MinHash fingerprints of documents: sketches that follow edit distance.

Everything is a DataFrame expression. A text is read as words: runs of anything but white
space, longer runs in pieces of ``PIECE_CHARS``. Its k-mers are ``KMER`` consecutive
words (all words, where there are fewer), each numbered by its occurrence: the second
time that a k-mer comes it is another element than the first. An element's hash deals it
to one of ``PARTS`` parts, which share one hash order in place of an order each. Of each
part the ``TUPLE`` elements of smallest hash are taken and put back into the order in
which they stand in the text, and that tuple is hashed: a component of 32 bits. Two texts
agree in a component where they share the part's smallest elements in the same order, so
that moved text lowers the likeness as edits do, unlike in a set's sketch.

The likeness of two fingerprints is the share of equal components among those that either
has; of two without components it is 1.

A null text counts as empty. A text without words has no component. Texts are read whole,
and their cost grows as n log n, so very long ones take their share; a word's place counts
modulo 2**24. Rows are independent of each other in ``fingerprints``: repeated rows give
repeated results, an empty table an empty one. Other columns stay; one with the name of a
result gives way to it.

``next_documents`` puts documents into descending order of id, null ids last, rows of one
id by a hash of their text; the order of rows equal in both has no meaning. The row after
the last is the first. Rows are dealt to ranges of that order by bounds from a sample of at most about
``SAMPLE`` rows; every range begins with a row of the sample, which also goes to the end
of the range before, so a text moves once and nothing is gathered. A hot id is split by its texts; rows
equal in id and text stay in one range, which spills.
"""

import json

from pyspark.sql import DataFrame, Window, functions as F

from pointstream.llm.frames import free_name, set_aside, without

KMER = 3
PARTS = 64
TUPLE = 2
PIECE_CHARS = 32
# Rows of a range, and the most rows of the sample that bounds them.
RANGE_ROWS = 512
SAMPLE = 1 << 15

_PLACE_BITS = 24
_PLACE = f"{(1 << _PLACE_BITS) - 1}L"
_HASH = f"{-(1 << _PLACE_BITS)}L"
_PART_BITS = PARTS.bit_length() - 1
# What a place holds that has no component, and its text.
_NONE = "-" * 8


def _steps(text: str, names: dict[str, str]) -> list[tuple[str, str]]:
    """Column by column, SQL from a text to its components.

    Each is made in a projection of its own, so that what is mentioned several times is
    made once. An element is one number: its hash, with its place in the low bits.
    """
    words, hashes, placed, elements, least = (
        f"`{names[n]}`" for n in ("words", "hashes", "placed", "elements", "least")
    )
    part = f"shiftright({{}}, {64 - _PART_BITS})"
    kmer = ", ".join(f"get({words}, i + {j})" for j in range(KMER))
    last = f"greatest(0, size({words}) - {KMER})"
    # Runs of equal hashes in the sorted places give the occurrences: 0, 1, 2 ...
    begins = f"""filter(sequence(0, size({placed}) - 1),
        i -> i = 0 OR ({placed}[i] & {_HASH}) != ({placed}[i - 1] & {_HASH}))"""
    numbers = f"""flatten(transform({begins}, (b, j) -> sequence(
        0, coalesce(get({begins}, j + 1), size({placed})) - b - 1)))"""
    return [
        ("words", f"regexp_extract_all(coalesce({text}, ''), r'[^\\x20\\x09-\\x0D]{{1,{PIECE_CHARS}}}', 0)"),
        (
            "hashes",
            f"""IF(size({words}) = 0, CAST(array() AS array<bigint>),
                transform(sequence(0, {last}), i -> xxhash64({kmer}) & {_HASH}))""",
        ),
        ("placed", f"sort_array(transform({hashes}, (h, i) -> h | (CAST(i AS bigint) & {_PLACE})))"),
        # Most texts repeat no k-mer: the first occurrence keeps the k-mer's hash.
        ("begins", f"IF(size(array_distinct({hashes})) = size({hashes}), NULL, {begins})"),
        (
            "elements",
            f"""IF(`{names["begins"]}` IS NULL, {placed}, sort_array(zip_with(
                {placed}, {numbers.replace(begins, f'`{names["begins"]}`')},
                (p, n) -> IF(n = 0, p, (xxhash64(p & {_HASH}, n) & {_HASH}) | (p & {_PLACE})))))""",
        ),
        # The first of each part: what stands TUPLE places before is of another part.
        (
            "least",
            f"""filter({elements}, (e, i) ->
                i < {TUPLE} OR {part.format(f"{elements}[i - {TUPLE}]")} != {part.format("e")})""",
        ),
        (
            "made",
            f"""map_from_entries(transform(
                filter(sequence(0, size({least}) - 1), i -> size({least}) > 0 AND (
                    i = 0 OR {part.format(f"{least}[i]")} != {part.format(f"{least}[i - 1]")})),
                i -> struct({part.format(f"{least}[i]")}, {_tuple_hash(least, part)})))""",
        ),
    ]


def _tuple_hash(least: str, part: str) -> str:
    """SQL: hash of the elements of the part that begins at ``i``, in text order."""
    own = f"""filter(slice({least}, i + 1, {TUPLE}),
        e -> {part.format("e")} = {part.format(f"{least}[i]")})"""
    ordered = f"array_sort({own}, (a, b) -> CAST((a & {_PLACE}) - (b & {_PLACE}) AS int))"
    return f"hash(transform({ordered}, e -> e & {_HASH}))"


def _components(made: str) -> str:
    """SQL: components by part, null where a part has no element."""
    half = PARTS // 2
    # Mentioned twice, so that the optimizer does not move its making into the lambda.
    return f"""IF({made} IS NULL, NULL,
        transform(sequence({-half}, {half - 1}), p -> element_at({made}, CAST(p AS bigint))))"""


def _with_components(frame: DataFrame, text: str, result: str) -> DataFrame:
    """Adds ``result``, the components of the text (SQL), an array of ``PARTS`` ints."""
    names = {}
    for step in ("words", "hashes", "placed", "begins", "elements", "least", "made"):
        names[step] = free_name(frame, f"_omh_{step}")
    made = frame
    for name, sql in _steps(text, names):
        made = made.select("*", F.expr(sql).alias(names[name]))
    kept = [f"`{c}`" for c in frame.columns]
    return made.select(*kept, F.expr(_components(f"`{names['made']}`")).alias(result))


def _text_of(components: str) -> str:
    """SQL: components as fixed-width hexadecimal text."""
    return f"array_join(transform({components}, c -> coalesce(lpad(hex(c & 4294967295L), 8, '0'), '{_NONE}')), '')"


def _likeness(one: str, two: str) -> str:
    """SQL: share of equal components among those that either has."""
    pairs = f"zip_with({one}, {two}, (a, b) -> CASE WHEN a IS NULL AND b IS NULL THEN -1 WHEN a <=> b THEN 1 ELSE 0 END)"
    count = "(n, x) -> struct(n.same + IF(x = 1, 1, 0) AS same, n.either + IF(x < 0, 0, 1) AS either)"
    ratio = "n -> IF(n.either = 0, 1D, CAST(n.same AS double) / n.either)"
    return f"aggregate({pairs}, struct(0 AS same, 0 AS either), {count}, {ratio})"


def fingerprints(docs: DataFrame, text: str = "text", result: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of each text: ``PARTS`` components of 8 hexadecimal digits."""
    given = docs.select(
        *(f"`{c}`" for c in without(docs.columns, [result])),
        F.col(f"`{text}`").alias(whole := free_name(docs, "_omh_text")),
    )
    made = _with_components(given, f"`{whole}`", parts := free_name(given, "_omh_parts"))
    kept = [f"`{c}`" for c in given.columns if c != whole]
    return made.select(*kept, F.expr(_text_of(f"`{parts}`")).alias(result))


def likeness(one: str, two: str):
    """Column: likeness of two columns of fingerprint texts, 0 to 1; null for a null."""

    def parts(column: str) -> str:
        places = f"sequence(1, {8 * PARTS}, 8)"
        return f"transform({places}, i -> nullif(substring(`{column}`, i, 8), '{_NONE}'))"

    return F.when(
        F.col(f"`{one}`").isNotNull() & F.col(f"`{two}`").isNotNull(),
        F.expr(_likeness(parts(one), parts(two))),
    )


# A document's place in descending order of id: null ids last, then by text.
_KEY = "struct(CAST(isnull({id}) AS int) AS n, coalesce(~CAST({id} AS bigint), 0L) AS d, xxhash64({text}) AS h)"
_KEYS = "array<struct<n:int,d:bigint,h:bigint>>"


def _bounds(docs: DataFrame, key: str, range_rows: int, sample: int) -> list:
    """First keys of the ranges, in order: the least key of all, and some of a sample."""
    keys = docs.select(F.expr(key).alias("k"))
    found = keys.agg(F.count("*").alias("rows"), F.min("k").alias("least")).first()
    if not found["rows"]:
        return []
    share = min(1 << 20, -(-(sample << 20) // found["rows"]))
    drawn = keys.filter(f"pmod(xxhash64(k.n, k.d, k.h), {1 << 20}) < {share}").select("k.*").distinct()
    rows = sorted(tuple(r) for r in drawn.limit(2 * sample).collect())
    step = max(1, len(rows) * range_rows // found["rows"])
    first = tuple(found["least"])
    return [first, *(k for k in rows[step::step] if k > first)]


def next_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    carried: tuple[str, ...] = (),
    range_rows: int = RANGE_ROWS,
    sample: int = SAMPLE,
) -> DataFrame:
    """Adds ``next_text`` and, for each carried column, ``next_<column>``: those of the next row."""
    made = ["next_text", *(f"next_{c}" for c in carried)]
    aside, back = set_aside(docs.select(*(f"`{c}`" for c in without(docs.columns, made))), ["_key", "_range", "_copy"])
    key = _KEY.format(id=f"`{id_column}`", text=f"`{text}`")
    bounds = _bounds(docs, key, range_rows, sample)
    if not bounds:
        bounds = [(0, 0, 0)]
    known = f"from_json('{json.dumps([dict(zip('ndh', b)) for b in bounds])}', '{_KEYS}')"
    count = len(bounds)
    halves = [1 << i for i in range(count.bit_length(), -1, -1)]
    steps = ", ".join(map(str, halves))
    place = f"""aggregate(array({steps}), 0,
        (p, s) -> IF(p + s < {count} AND _key >= get({known}, p + s), p + s, p))"""
    ranges = f"""IF(_key = get({known}, _range),
        array(struct(_range, false AS _copy), struct(pmod(_range - 1, {count}) AS _range, true AS _copy)),
        array(struct(_range, false AS _copy)))"""
    dealt = (
        aside.withColumn("_key", F.expr(key))
        .withColumn("_range", F.expr(place))
        .select(*(f"`{c}`" for c in aside.columns), "_key", F.expr(f"inline({ranges})"))
    )
    order = Window.partitionBy("_range").orderBy("_copy", "_key")
    # A row always has a next: the copies end their range, and are not rows of it.
    found = dealt.select(
        *(f"`{c}`" for c in aside.columns),
        "_copy",
        F.lead(f"`{text}`").over(order).alias("next_text"),
        *(F.lead(f"`{c}`").over(order).alias(f"next_{c}") for c in carried),
    )
    return back(found.filter(~F.col("_copy")), *made)


def edited(n_chars: str = "n_chars", text: str = "text", after: str = "next_text"):
    """Column: a text whose last half is replaced by as much of the beginning of another."""
    half = f"CAST(floor(`{n_chars}` / 2) AS int)"
    return F.expr(
        f"concat(left(coalesce(`{text}`, ''), CAST(`{n_chars}` AS int) - {half}), left(coalesce(`{after}`, ''), {half}))"
    )


def edit_likeness(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and its likeness to that
    and to the next document's.

    Columns: the id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``. Other columns are left out. A
    single document is its own next one.
    """
    given = docs.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    own = _with_components(given, "text", "parts")
    after = next_documents(own, "id", "text", carried=("parts",))
    changed = after.withColumn("n_chars", F.length("text").cast("bigint")).select(
        "id", "n_chars", "parts", "next_parts", edited().alias("edited")
    )
    found = _with_components(changed, "edited", "edited_parts")
    return found.select(
        F.col("id").alias(id_column),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.expr(_text_of("parts")).alias("fingerprint"),
        F.expr(_text_of("edited_parts")).alias("edited_fingerprint"),
        F.expr(_likeness("parts", "edited_parts")).alias("near_edited"),
        F.expr(_likeness("parts", "next_parts")).alias("near_next"),
    )
