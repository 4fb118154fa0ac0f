"""Elements of large ledger responses, found by many tasks.

A response is one JSON text, and where its elements begin depends on everything before
them: a comma or bracket inside a text is none. The text comes in pieces, cut at every
comma, in blocks that tasks read. Whether a piece begins inside a text is the parity of
the quotation marks before it, and how deep it begins is the sum of the brackets before it
that stand outside texts. Both are prefix sums: each block adds up its own pieces for
either way it may begin, the blocks of a file are put in order by their sums, and that
settles all pieces. A comma outside texts, as deep as the ``result`` array, ends an
element. Pieces of one element meet in a group as large as the element.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from pointstream.functions.times import pull_day, pull_day_of

# How deep the elements of the result array of the outer object are.
_DEPTH = 2
_ESCAPED = r"(?s)\\."
_CLOSED = r'(?s)"[^"]*"'


def _opened(text: Column) -> Column:
    """Brackets opened less brackets closed."""
    size = lambda marks: F.length(F.regexp_replace(text, f"[^{marks}]", ""))
    return size(r"\[{") - size(r"\]}")


def _outside(plain: Column) -> Column:
    """What stands outside texts in a piece that begins outside one."""
    return F.regexp_replace(F.regexp_replace(plain, _CLOSED, ""), '(?s)".*', "")


def _placed(pieces: DataFrame) -> DataFrame:
    """Adds ``inside`` (begins in a text), ``before`` and ``after`` (depths) to pieces."""
    plain = F.regexp_replace("piece", _ESCAPED, "")
    quotes = F.length(F.regexp_replace("plain", '[^"]', ""))
    # A piece that begins in a text is outside from its first quotation mark on.
    from_inside = F.when(F.col("quotes") > 0, F.regexp_replace("plain", '(?s)^[^"]*"', "")).otherwise("")
    counted = (
        pieces.withColumn("plain", plain)
        .withColumn("quotes", quotes)
        .withColumn("out", _opened(_outside(F.col("plain"))))
        .withColumn("ins", _opened(_outside(from_inside)))
        .drop("plain")
    )
    here = Window.partitionBy("file", "block").orderBy("row")
    odd = (F.sum("quotes").over(here) - F.col("quotes")) % 2 == 1
    # If the block begins outside a text, and if it begins inside one.
    either = counted.withColumn("odd", odd).withColumn(
        "one", F.when(F.col("odd"), F.col("ins")).otherwise(F.col("out"))
    ).withColumn("two", F.when(F.col("odd"), F.col("out")).otherwise(F.col("ins")))
    summed = either.withColumn("sum_one", F.sum("one").over(here)).withColumn("sum_two", F.sum("two").over(here))
    blocks = either.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), F.sum("one").alias("one"), F.sum("two").alias("two")
    )
    # One row per block of a file.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = blocks.withColumn("begins_in", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1)
    own = F.when(F.col("begins_in"), F.col("two")).otherwise(F.col("one"))
    offsets = begins.withColumn("own", own).select(
        "file", "block", "begins_in", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("offset")
    )
    found = summed.join(offsets, ["file", "block"])
    mine = F.when(F.col("begins_in"), F.col("two")).otherwise(F.col("one"))
    total = F.when(F.col("begins_in"), F.col("sum_two")).otherwise(F.col("sum_one"))
    return (
        found.withColumn("inside", F.col("odd") != F.col("begins_in"))
        .withColumn("after", F.col("offset") + total)
        .withColumn("ends_in", F.col("inside") != (F.col("quotes") % 2 == 1))
        .withColumn("before", F.col("after") - mine)
        .drop("quotes", "odd", "one", "two", "sum_one", "sum_two", "out", "ins", "begins_in", "offset", "own")
    )


# The name of the array, where a member of the outer object begins.
_NAME = r'(?s)^\s*\{?\s*"result"\s*:\s*\['
_END = r"(?s)\]\s*(\}\s*)?$"


def response_elements(pieces: DataFrame) -> DataFrame:
    """(file, place, element) and the pieces' partition columns: a row per element, as text.

    ``place`` orders the elements of a file. Only an array that is itself the ``result`` of
    the outer object is read; a file without one gives no rows.
    """
    keep = [c for c in pieces.columns if c not in ("file", "block", "row", "piece")]
    named = ~F.col("inside") & (F.col("before") <= 1) & F.col("piece").rlike(_NAME)
    # A piece of the array: it names the array, or begins within.
    placed = _placed(pieces).withColumn("named", named)
    first = F.min(F.when(F.col("named"), F.struct("block", "row")))
    begins = placed.groupBy("file").agg(first.alias("first"))
    at = F.struct("block", "row")
    inside = placed.join(begins, "file").filter(
        (at >= F.col("first")) & ((at == F.col("first")) | (F.col("before") >= _DEPTH))
    )
    # Members after the array are not as deep, but deeper ones in them are: the array
    # ends with the first piece that ends above it.
    last = F.min(F.when(~F.col("ends_in") & (F.col("after") < _DEPTH), at))
    ends = inside.groupBy("file").agg(last.alias("last"))
    own = inside.join(ends, "file").filter(F.col("last").isNull() | (at <= F.col("last")))
    # Each piece after which an element ends; the next piece begins another.
    ended = ~F.col("ends_in") & (F.col("after") == _DEPTH)
    here = Window.partitionBy("file", "block").orderBy("row")
    flagged = own.withColumn("ended", ended.cast("int"))
    counted = flagged.withColumn("nth", F.sum("ended").over(here) - F.col("ended"))
    blocks = flagged.groupBy("file", "block").agg(F.sum("ended").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    text = F.when(at == F.col("first"), F.regexp_replace("piece", _NAME, "")).otherwise(F.col("piece"))
    text = F.when(at == F.col("last"), F.regexp_replace(text, _END, "")).otherwise(text)
    numbered = counted.join(offsets, ["file", "block"]).select(
        *keep, "file", (F.col("offset") + F.col("nth")).alias("place"), "block", "row", text.alias("text")
    )
    parts = F.array_sort(F.collect_list(F.struct("block", "row", "text")))
    gathered = numbered.groupBy(*keep, "file", "place").agg(parts.alias("parts"))
    element = F.array_join(F.transform("parts", lambda p: p["text"]), ",")
    return gathered.select(*keep, "file", "place", element.alias("element")).filter(F.col("element").rlike(r"\S"))


def load_large_ledger(pieces: DataFrame, run_date: str | Column) -> DataFrame:
    """Rows (cm, content) of large responses, as ``load_ledger`` gives them of small ones.

    An element that is no JSON shows that its file is none: it fails the job, as the file
    cannot be set aside once its rows are under way.
    """
    day = F.lit(pull_day(run_date)) if isinstance(run_date, str) else pull_day_of(run_date)
    elements = response_elements(pieces)
    return elements.select(day.alias("cm"), F.to_json(F.parse_json("element")).alias("content"))
