"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Everything is a DataFrame expression. Offsets are code points, ends exclusive.

A null text counts as empty and has no spans. Very long texts are read whole, and what
stands around a match is taken from chunks of them. Rows are independent of each other, so
repeated rows give repeated results, and an empty table gives an empty one. Other columns
stay; one named ``pii`` gives way to the result of ``pii_spans``, and stays in ``redact``.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pointstream.llm.frames import set_aside, without


@dataclass(frozen=True)
class Kind:
    """One kind of personal data.

    ``pattern`` is a Java expression, ``valid`` a SQL condition on ``m``, the matched
    text. A match that is not valid is dropped, without a retry inside it. ``score`` is
    raised by ``CONTEXT_BONUS`` where one of the ``context`` words stands in the
    ``CONTEXT_CHARS`` before the match or after it, other matches between or not. ``base``
    spans stay whatever their score. ``needs`` is a text, and ``needs_like`` a quicker
    pattern, without which the pattern cannot match.
    """

    name: str
    pattern: str
    valid: str
    score: float
    context: str
    base: bool = True
    needs: str | None = None
    needs_like: str | None = None


CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3
# Score from which a span that is not a base one is reported.
THRESHOLD = 0.5

_OCTET = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_DIGITS = "regexp_replace(m, '[^0-9]', '')"
_PLAIN = "replace(m, ' ', '')"
# Remainder of the account number, letters as 10 to 35 and its first four at the end.
_MOD97 = f"""aggregate(
    sequence(1, length({_PLAIN})),
    named_struct('n', concat(substring({_PLAIN}, 5), substring({_PLAIN}, 1, 4)), 'r', 0),
    (a, i) -> named_struct('n', a.n, 'r', CAST(
        IF(substring(a.n, i, 1) < 'A',
           (a.r * 10 + ascii(substring(a.n, i, 1)) - 48) % 97,
           (a.r * 100 + ascii(substring(a.n, i, 1)) - 55) % 97) AS INT)),
    a -> a.r)"""

# Countries by the length of their account numbers.
_IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FO FI FK GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU",
}


def _iban(length: int, countries: str) -> str:
    """Pattern of account numbers of a length, in groups of four with or without spaces."""
    fours, rest = divmod(length - 4, 4)
    last = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
    return rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{fours}}}{last}"


# The length of a known country ends a match, so that it takes no word after the number.
_ANY_IBAN = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
_IBAN = "|".join([*(_iban(n, c) for n, c in _IBAN_COUNTRIES.items()), _ANY_IBAN])

# A lookbehind lets an attempt begin only where a run of its first class begins, or
# where the match before ended: other starts cannot succeed, and trying them would
# take quadratic time on a long run. Possessive repeats keep the matcher from
# recursing; they change no match, as what follows them is never of their class.
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "true",
        0.7,
        "mail|contact|write|escri|schreib|courriel",
        needs="@",
    ),
    Kind(
        "ip",
        r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        f"m rlike '^{_OCTET}[.]{_OCTET}[.]{_OCTET}[.]{_OCTET}$'",
        0.5,
        "ip|address|host|server|login",
        needs=".",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        f"length({_DIGITS}) BETWEEN 14 AND 19 AND luhn_check({_DIGITS})",
        0.6,
        "card|credit|visa|master|karte|carte|tarjeta",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        f"length({_DIGITS}) BETWEEN 10 AND 15",
        0.5,
        "phone|tel|call|mobile|fax",
        needs="+",
    ),
    Kind(
        "iban",
        rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])",
        f"length({_PLAIN}) BETWEEN 15 AND 34 AND {_MOD97} = 1",
        0.6,
        "iban|account|konto|compte|cuenta|bank",
        base=False,
        needs_like=r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[\x20A-Z0-9]",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "true",
        0.3,
        "ssn|social|security|insurance",
        base=False,
        needs="-",
    ),
)
BASE_KINDS = tuple(kind.name for kind in KINDS if kind.base)

_SPAN = "struct<start:int,rank:int,end:int,kind:string,score:double>"
_NO_SPANS = f"CAST(array() AS array<{_SPAN}>)"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(text: str, kind: Kind) -> str:
    found = f"regexp_extract_all({text}, {_quoted(kind.pattern)}, 0)"
    if kind.needs is not None:
        may = f"contains({text}, {_quoted(kind.needs)})"
    elif kind.needs_like is not None:
        may = f"{text} rlike {_quoted(kind.needs_like)}"
    else:
        return found
    return f"IF({may}, {found}, CAST(array() AS array<string>))"


# Places whose sums or maxima are taken together: what stands before a place is found
# from its block and the blocks before, without a running list.
_BLOCK = 128


def _blocks(array: str, of_slice: str) -> str:
    """SQL: ``of_slice`` of every block of an array; ``s`` stands for the block."""
    block = of_slice.replace("(s,", f"(slice({array}, b * {_BLOCK} + 1, {_BLOCK}),").replace(
        "(s)", f"(slice({array}, b * {_BLOCK} + 1, {_BLOCK}))"
    )
    return f"transform(sequence(0, (size({array}) - 1) div {_BLOCK}), b -> {block})"


def _before(array: str, blocks: str) -> tuple[str, str]:
    """SQL: the blocks before place ``i``, and the places of its own block before it."""
    block = f"CAST(i div {_BLOCK} AS INT)"
    return f"slice({blocks}, 1, {block})", f"slice({array}, {block} * {_BLOCK} + 1, i % {_BLOCK})"


def _sum(array: str) -> str:
    return f"aggregate({array}, 0, (a, n) -> a + n)"


def _pairs(text: str, found: str, kind: Kind) -> str:
    """Each match ``m`` with ``gap``, the text between it and the match before."""
    gaps = f"slice(split({text}, {_quoted(kind.pattern)}, -1), 1, size({found}))"
    pairs = f"zip_with({gaps}, {found}, (gap, m) -> named_struct('gap', gap, 'm', m))"
    return f"IF(size({found}) = 0, NULL, {pairs})"


def _placed(pairs: str, sizes: str, blocks: str, kind: Kind) -> str:
    """Places of the valid matches of one kind: the lengths of what stands before give them."""
    valid = kind.valid.replace("(m,", "(x.m,").replace("m rlike", "x.m rlike")
    start = " + ".join([*map(_sum, _before(sizes, blocks)), "length(x.gap)"])
    place = f"named_struct('start', {start}, 'size', length(x.m))"
    placed = f"transform({pairs}, (x, i) -> IF({valid}, {place}, NULL))"
    # All are mentioned twice, so that the optimizer does not make them anew in the lambda.
    none = " OR ".join(f"{c} IS NULL" for c in (pairs, sizes, blocks))
    return f"IF({none}, NULL, filter({placed}, x -> x IS NOT NULL))"


def _spans(placed: str, length: str, chunks: str, rank: int, kind: Kind) -> str:
    """Spans of one kind, scored by the text around them."""
    end = "(p.start + p.size)"
    before = _piece(chunks, f"greatest(0, p.start - {CONTEXT_CHARS})", "p.start")
    after = _piece(chunks, end, f"least({length}, {end} + {CONTEXT_CHARS})")
    near = f"lower(concat({before}, '\n', {after})) rlike {_quoted(kind.context)}"
    score = f"CAST(least(1D, {kind.score}D + IF({near}, {CONTEXT_BONUS}D, 0D)) AS DOUBLE)"
    span = (
        f"named_struct('start', p.start, 'rank', {rank}, 'end', {end},"
        f" 'kind', '{kind.name}', 'score', {score})"
    )
    spans = f"transform({placed}, p -> {span})"
    if not kind.base:
        spans = f"filter({spans}, s -> s.score >= {THRESHOLD}D)"
    return f"IF({placed} IS NULL, {_NO_SPANS}, {spans})"


def _chunks(text: str) -> str:
    return f"regexp_extract_all({text}, '(?s).{{1,{_CHUNK}}}', 0)"


def pii_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``pii``: spans (start, rank of the kind, end, kind, score) by start, then kind."""
    given = docs.select(*(f"`{c}`" for c in without(docs.columns, ["pii"])))
    steps = ("found", "pairs", "sizes", "blocks", "placed")
    made = {step: [f"_{step}_{kind.name}" for kind in KINDS] for step in steps}
    aside, back = set_aside(given, ["_pii_text", "_pii_length", "_pii_chunks", *sum(made.values(), [])])
    frame = aside.withColumn("_pii_text", F.coalesce(F.col(text), F.lit("")))

    def step(frame: DataFrame, name: str, sql: list[str]) -> DataFrame:
        # A projection of its own: what is used several times is made once.
        return frame.select("*", *(F.expr(e).alias(c) for e, c in zip(sql, made[name])))

    size = "x -> length(x.gap) + length(x.m)"
    frame = step(frame, "found", [_matches("_pii_text", k) for k in KINDS])
    frame = step(frame, "pairs", [_pairs("_pii_text", c, k) for c, k in zip(made["found"], KINDS)])
    frame = step(frame, "sizes", [f"transform({c}, {size})" for c in made["pairs"]])
    total = "aggregate(s, 0, (a, n) -> a + n)"
    frame = step(frame, "blocks", [f"IF({c} IS NULL, NULL, {_blocks(c, total)})" for c in made["sizes"]])
    columns = zip(made["pairs"], made["sizes"], made["blocks"], KINDS)
    frame = step(frame, "placed", [_placed(*c) for c in columns])
    some = " OR ".join(f"size({c}) > 0" for c in made["placed"])
    frame = frame.select(
        "*",
        F.expr(f"IF({some}, {_chunks('_pii_text')}, NULL)").alias("_pii_chunks"),
        F.expr(f"IF({some}, length(_pii_text), 0)").alias("_pii_length"),
    )
    columns = zip(made["placed"], range(len(KINDS)), KINDS)
    each = [_spans(c, "_pii_length", "_pii_chunks", rank, kind) for c, rank, kind in columns]
    spans = F.expr(f"array_sort(concat({', '.join(each)}))")
    return back(frame.withColumn("pii", spans), "pii")


def span_text(kinds: tuple[str, ...] | None = None) -> Column:
    """Spans as ``kind:start:end``, comma-joined; of some kinds only, if given."""
    spans = F.col("pii")
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def count_of(kind: str) -> Column:
    return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("bigint")


# Code points of a chunk: a piece of a long text is found without reading up to it.
_CHUNK = 4096


def _piece(chunks: str, begin: str, end: str) -> str:
    """Code points ``begin`` to ``end`` of a text cut into chunks."""
    first, last = f"CAST({begin} div {_CHUNK} AS INT)", f"CAST(({end} - 1) div {_CHUNK} AS INT)"
    return f"""CASE
        WHEN {begin} >= {end} THEN ''
        WHEN {first} = {last}
            THEN substring({chunks}[{first}], {begin} % {_CHUNK} + 1, {end} - {begin})
        ELSE concat(
            substring({chunks}[{first}], {begin} % {_CHUNK} + 1),
            array_join(slice({chunks}, {first} + 2, {last} - {first} - 1), ''),
            substring({chunks}[{last}], 1, ({end} - 1) % {_CHUNK} + 1)) END"""


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every span replaced by its kind in brackets; spans that overlap become one.

    The one has the kind of the first. The columns stay the same. Texts without spans,
    null ones too, stay as they are.
    """
    aside, back = set_aside(docs, ["pii", "_chunks", "_ends", "_tops"])
    some = F.size("pii") > 0
    found = pii_spans(aside, text).select(
        "*",
        F.when(some, F.expr(_chunks(f"`{text}`"))).alias("_chunks"),
        F.when(some, F.transform("pii", lambda s: s["end"])).alias("_ends"),
    )
    tops = F.when(some, F.expr(_blocks("_ends", "array_max(s)")))
    # How far the spans before a span reach: text goes on from there, and a span that
    # begins before that belongs to an earlier one.
    reached = ", ".join(f"coalesce(array_max({part}), 0)" for part in _before("_ends", "_tops"))
    reached = f"greatest({reached})"
    cut = f"""concat(
        array_join(transform(pii, (s, i) -> IF(s.start < {reached}, '', concat(
            {_piece("_chunks", reached, "s.start")}, '[', upper(s.kind), ']'))), ''),
        {_piece("_chunks", "array_max(_tops)", "length(`" + text + "`)")})"""
    changed = F.when(some, F.expr(cut)).otherwise(F.col(text))
    return back(found.withColumn("_tops", tops).withColumn(text, changed))
