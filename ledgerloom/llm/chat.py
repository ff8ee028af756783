"""Chat formatting from turn rows, with Spark expressions only.

One conversation becomes one text: each block of adjacent turns of one role is `<|role|>`, the turns' texts with `<|>`
between them, and `</s>`. Inside texts `<`, any number of backslashes and then `|`, `s>` or `/s>` gets one more
backslash, so a text never holds a control string and can be read back exactly. In role names a backslash becomes
`\\b`, `|` becomes `\\p` and `<` becomes `\\l`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END, NEXT = "</s>", "<|>"
_MANY = 64  # spans that are cut as substrings, each in the time of the text before it
_CHUNK = 128


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(/?s>|\|)", r"<\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(/?s>|\|)", "<$1$2")


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("|"), F.lit("\\p")), F.lit("<"), F.lit("\\l"))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\l"), F.lit("<")), F.lit("\\p"), F.lit("|")), F.lit("\\b"), F.lit("\\"))


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = "assistant"
) -> DataFrame:
    """One row per conversation: conv_id, n_blocks, formatted, loss_spans (array of start, length in code points of formatted).

    The spans hold the texts, without marks, of turns whose role is `learn`. Turns are sorted by turn number, nulls
    first, ties by role and then text; equal rows all stay. Null text or role is read as empty. Rows without conv_id
    form one conversation. Other columns are ignored; an empty table gives an empty result. A conversation is one row
    of the result, so it is collected as a whole; rows meet by conv_id after map-side collection.
    """
    empty = F.lit("")
    entry = F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), empty).alias("role"), F.coalesce(F.col(text), empty).alias("text")
    )
    sorted_turns = turns.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(entry)).alias("turns"))

    def piece(x: Column, i: Column) -> Column:
        before = F.get(F.col("turns"), i - 1)
        after = F.get(F.col("turns"), i + 1)
        first = before.isNull() | (before["role"] != x["role"])
        last = after.isNull() | (after["role"] != x["role"])
        return F.struct(
            F.when(first, F.concat(F.lit("<|"), _escape_role(x["role"]), F.lit("|>"))).otherwise(F.lit(NEXT)).alias("open"),
            escape(x["text"]).alias("body"),
            F.when(last, F.lit(END)).otherwise(empty).alias("close"),
            (x["role"] == F.lit(learn)).alias("learn"),
        )

    pieces = sorted_turns.select("conv_id", F.transform("turns", piece).alias("pieces"))
    return pieces.select(
        "conv_id",
        F.size(F.filter("pieces", lambda p: p["close"] != empty)).alias("n_blocks"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["open"], p["body"], p["close"])), "").alias("formatted"),
        _spans(F.col("pieces")).alias("loss_spans"),
    )


def _spans(pieces: Column) -> Column:
    """Running offsets, kept for the learnt pieces only; by chunks of pieces, as a list that grows piece by piece is copied each time."""

    def length(p: Column) -> Column:
        return F.length(p["open"]) + F.length(p["body"]) + F.length(p["close"])

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda at, p: at + length(p))

    def spans(part: Column, begin: Column) -> Column:
        start = F.struct(begin.alias("at"), F.from_json(F.lit("[]"), "array<struct<start:int,length:int>>").alias("spans"))

        def step(acc: Column, p: Column) -> Column:
            span = F.struct((acc["at"] + F.length(p["open"])).alias("start"), F.length(p["body"]).alias("length"))
            kept = F.when(p["learn"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
            return F.struct((acc["at"] + length(p)).alias("at"), kept.alias("spans"))

        return F.aggregate(part, start, step, lambda acc: acc["spans"])

    def of_chunks(chunks: Column, sums: Column) -> Column:
        before = lambda c: F.aggregate(F.slice(sums, F.lit(1), c), F.lit(0), lambda at, n: at + n)
        return F.flatten(F.transform(chunks, lambda part, c: spans(part, before(c))))

    def bound(value: Column, use) -> Column:
        """An expression computed once for all its uses in lambdas."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def cut(all_pieces: Column) -> Column:
        last = F.floor((F.size(all_pieces) - 1) / F.lit(_CHUNK)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(all_pieces, c * _CHUNK + 1, F.lit(_CHUNK)))

    return bound(pieces, lambda p: bound(cut(p), lambda chunks: bound(F.transform(chunks, total), lambda sums: of_chunks(chunks, sums))))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation: the inverse of the template, parts of merged blocks apart again."""
    blocks = F.filter(F.split(formatted, END), lambda b: b != F.lit(""))

    def parts(block: Column) -> Column:
        name = _unescape_role(F.regexp_extract(block, r"(?s)\A<\|([^|]*)\|>", 1))
        body = F.regexp_replace(block, r"(?s)\A<\|[^|]*\|>", "")
        return F.transform(
            F.split(body, r"<\|>"), lambda t: F.struct(name.alias("role"), unescape(t).alias("text"))
        )

    return F.flatten(F.transform(blocks, parts))


def read_learnt(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order.

    Few spans are cut as substrings; many by slicing the code points, split once for all spans, so that the work stays in
    proportion to the conversation.
    """
    direct = F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))
    # bound by a lambda of its own, as an expression inside the inner one would be evaluated for each span
    sliced = F.transform(
        F.array(F.split(formatted, "")),
        lambda points: F.transform(spans, lambda s: unescape(F.array_join(F.slice(points, s["start"] + 1, s["length"]), ""))),
    )
    return F.when(F.size(spans) <= _MANY, direct).otherwise(F.get(sliced, F.lit(0)))
