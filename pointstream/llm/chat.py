"""Chat formatting by prefix-target expansion.

A turn is ``<|im_start|>role`` newline ``text<|im_end|>`` newline. Control strings
inside a text get a backslash behind their first character, one more than they have,
so that the text holds no marker and the change can be taken back. A role has its
backslashes and newlines written as ``\\b`` and ``\\n``.

Every assistant turn becomes one example: all turns before it as context, and its text
alone trainable. A conversation that does not end with an assistant turn has one more
example, in which nothing is trainable, so that no turn is lost.

A null role or text is empty. Turns are in order of turn (null first), then role, then
text; a repeated row is a repeated turn. Rows without a conversation id form one
conversation, of id null. An empty table gives an empty one; other columns are ignored.
Everything is a DataFrame expression.
"""

from pyspark.sql import Column, DataFrame, functions as F

BEGIN = "<|im_start|>"
END = "<|im_end|>\n"
TRAINED_ROLE = "assistant"

# Strings that chat templates use as control strings.
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]"]


def _tails() -> str:
    return "|".join(s[1:].replace("|", r"\|").replace("]", r"\]") for s in CONTROL)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)(?=(?:{_tails()}))", r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)(?=(?:{_tails()}))", r"$1$2")


def _role_out(role: Column) -> Column:
    flat = F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n"))
    return escaped(flat)


def _role_in(text: Column) -> Column:
    flat = unescaped(text)
    return F.replace(F.replace(flat, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def transcripts(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its formatted text and where its replies stand.

    ``replies`` holds start and end of each assistant text, as code points.
    """
    empty = F.lit("")
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role"), empty).alias("role"),
        F.coalesce(F.col("text"), empty).alias("text"),
    )
    grouped = conversations.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(BEGIN), _role_out(t["role"]), F.lit("\n")).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == TRAINED_ROLE).alias("trained"),
        ),
    )
    text = F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END)))
    replies = F.expr(
        f"""aggregate(parts,
            named_struct('at', 0, 'spans', CAST(array() AS array<struct<start:int,end:int>>)),
            (a, p) -> named_struct(
                'at', a.at + length(p.head) + length(p.body) + {len(END)},
                'spans', IF(p.trained, concat(a.spans, array(named_struct(
                    'start', a.at + length(p.head),
                    'end', a.at + length(p.head) + length(p.body)))), a.spans)),
            a -> a.spans)"""
    )
    return grouped.select("conv_id", parts.alias("parts")).select(
        "conv_id", F.array_join(text, "").alias("formatted"), replies.alias("replies")
    )


def prefix_examples(formatted: DataFrame) -> DataFrame:
    """One row per example: its text up to the end of its reply's turn, and its mask.

    ``loss_start`` and ``loss_end`` bound the trainable text; ``last`` marks the example
    that holds the whole conversation.
    """
    whole = F.length("formatted")
    last_end = F.coalesce(F.try_element_at("replies", F.lit(-1))["end"] + len(END), F.lit(0))
    rest = F.array(F.struct(whole.alias("start"), whole.alias("end")))
    spans = F.when(last_end < whole, F.concat("replies", rest)).otherwise(F.col("replies"))
    exploded = formatted.select(
        "conv_id", "formatted", whole.alias("whole"), F.posexplode(spans).alias("example", "span")
    )
    until = F.least(F.col("whole"), F.col("span.end") + len(END))
    return exploded.select(
        "conv_id",
        "example",
        F.expr("substring(formatted, 1, least(whole, span.end + %d))" % len(END)).alias("text"),
        F.col("span.start").alias("loss_start"),
        F.col("span.end").alias("loss_end"),
        (until == F.col("whole")).alias("last"),
    )


def read_turns(text: Column) -> Column:
    """Roles and texts read back from a formatted text."""
    marked = F.split(text, r"<\|im_start\|>", -1)
    turns = F.slice(marked, F.lit(2), F.size(marked) - 1)

    def parse(turn: Column) -> Column:
        role = F.substring_index(turn, "\n", 1)
        begin = F.length(role) + 2
        body = F.substr(turn, begin, F.length(turn) - begin + 1 - len(END))
        return F.struct(_role_in(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(turns, parse)


def read_conversations(examples: DataFrame) -> DataFrame:
    """Conversations read back from their examples: turns, and the trainable texts in order."""
    reply = F.substr("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    whole = F.when(F.col("last"), F.col("text"))
    parts = F.collect_list(
        F.struct("example", unescaped(reply).alias("reply"), whole.alias("whole"))
    )
    grouped = examples.groupBy("conv_id").agg(F.sort_array(parts).alias("parts"))
    return grouped.select(
        "conv_id",
        F.element_at("parts", -1)["whole"].alias("formatted"),
        F.array_join(F.transform("parts", lambda p: p["reply"]), "").alias("loss_text"),
    ).withColumn("turns", read_turns(F.col("formatted")))
