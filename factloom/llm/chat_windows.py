"""Chat formatting in budgeted windows, with DataFrame functions alone.

Prefix sums of turn tokens place each turn of a conversation in a span, a turn-aligned
run. A span and what is put before it make a window: the leading system turn, which
every window retains, and the last turns of the span before, as far as history goes.
Repeated turns are masked: the loss covers each assistant turn once, where it is new.

The budget: let room be BUDGET less the system turn's tokens. History takes a quarter
of the room and HISTORY at most. The rest is two strides. Turns of a stride or less
that start within one stride of the prefix sum are a span, so a span has two strides at
most; a longer turn is a span of its own, and history gives way to it. So a window
exceeds BUDGET only where the system turn and its one new turn exceed it together.

A turn is written `### role: text</turn>` and a line break. In texts and roles the
characters of the markers are escaped (backslash, `#`, `<`, and in roles `:` and line
break, too), so no text can imitate a marker; unescaping is exact. Tokens are estimated
without a vocabulary: one for every four code points of a written turn, rounded up;
another estimate may be given.

The windows' rows hold `formatted`, `loss_spans` (start and length in code points of
the assistant texts under the loss) and `n_repeated` (turns at the front that an
earlier window has). `read_back` parses them.

Order in a conversation: turn, then role, then text. Defined results: a null role or
text is empty; a null turn sorts first; a null conv_id is a conversation of its own;
repeated rows are turns each; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 256
OPEN, CLOSE = "### ", "</turn>\n"


def escape(text: Column, role: bool = False) -> Column:
    """Each special character becomes a backslash and a letter of its own."""
    pairs = [("\\", "\\b"), ("#", "\\h"), ("<", "\\l")] + [(":", "\\c"), ("\n", "\\n")] * role
    for raw, safe in pairs:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column, role: bool = False) -> Column:
    """The inverse: a backslash in escaped text always starts a pair, and the pair for the backslash is replaced last."""
    pairs = [(":", "\\c"), ("\n", "\\n")] * role + [("<", "\\l"), ("#", "\\h"), ("\\", "\\b")]
    for raw, safe in pairs:
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def estimated_tokens(written: Column) -> Column:
    """An estimate of tokens without a vocabulary: one for every four code points, rounded up."""
    return F.ceil(F.char_length(written) / 4).cast("long")


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens=estimated_tokens) -> DataFrame:
    """conv_id, window, formatted, loss_spans, n_repeated, n_turns (in the window), n_tokens."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    whole = Window.partitionBy("conv_id")
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumn("head", F.concat(F.lit(OPEN), escape(F.col("role"), role=True), F.lit(": "))).withColumn("body", escape(F.col("text")))
    rows = rows.withColumn("tokens", tokens(F.concat("head", "body", F.lit(CLOSE)))).withColumn("at", F.row_number().over(in_order))
    rows = rows.select("conv_id", "role", "head", "body", "tokens", "at", ((F.col("at") == 1) & (F.col("role") == "system")).alias("pinned"))
    rows = rows.withColumn("system", F.max(F.when(F.col("pinned"), F.col("tokens")).otherwise(0)).over(whole)).withColumn("room", F.greatest(F.lit(0).cast("long"), F.lit(budget) - F.col("system")))
    rows = rows.withColumn("past", F.expr(f"least({history}L, room div 4)")).withColumn("stride", F.expr("greatest(1L, (room - past) div 2)"))
    in_order = whole.orderBy("at")
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("own", F.when(F.col("pinned"), 0).otherwise(F.col("tokens"))).withColumn("end", F.sum("own").over(upto))
    rows = rows.withColumn("cell", F.expr("(end - own) div stride")).withColumn("long", F.col("own") > F.col("stride"))
    before = lambda c: F.lag(c).over(in_order)
    new_span = F.when(F.col("at") == 1, 1).when(before("pinned"), 0).when(F.col("long") | before("long") | (F.col("cell") != before("cell")), 1).otherwise(0)
    rows = rows.withColumn("new_span", new_span).withColumn("window", F.sum("new_span").over(upto))
    span = Window.partitionBy("conv_id", "window")
    rows = rows.withColumn("fresh", F.sum("own").over(span)).withColumn("span_end", F.max("end").over(span)).withColumn("last", F.max("window").over(whole))
    after = lambda c: F.lead(c).over(in_order)
    rows = rows.withColumn("next", F.when(after("window") > F.col("window"), after("fresh"))).withColumn("next", F.max("next").over(span))
    allowed = F.least(F.col("past"), F.col("room") - F.col("next"))
    place = lambda w, kind: F.struct(w.cast("long").alias("window"), F.lit(kind).alias("kind"))
    new = F.array(place(F.col("window"), 2))
    again = F.when((F.col("window") < F.col("last")) & ~F.col("pinned") & (F.col("span_end") - F.col("end") + F.col("own") <= allowed), F.array(place(F.col("window") + 1, 1)))
    pinned = F.when(F.col("pinned") & (F.col("window") < F.col("last")), F.transform(F.sequence(F.col("window") + 1, F.col("last")), lambda w: place(w, 0)))
    none = F.array().cast("array<struct<window:bigint,kind:int>>")
    placed = rows.withColumn("place", F.explode(F.concat(new, F.coalesce(again, none), F.coalesce(pinned, none))))
    turns = placed.select("conv_id", F.col("place.window").alias("window"), "at", (F.col("place.kind") < 2).alias("repeated"), (F.col("role") == "assistant").alias("target"), "head", "body", "tokens")
    grouped = turns.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(F.struct("at", "repeated", "target", "head", "body"))).alias("turns"), F.sum("tokens").alias("n_tokens"))
    # the repeated turns stand first: a window's new turns follow those of the span before
    size = lambda t: F.char_length(t["head"]) + F.char_length(t["body"]) + len(CLOSE)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    walked = F.aggregate(
        "turns", start,
        lambda a, t: F.struct((a["at"] + size(t)).alias("at"), F.when(t["target"] & ~t["repeated"], F.array_append(a["spans"], F.struct((a["at"] + F.char_length(t["head"])).alias("start"), F.char_length(t["body"]).alias("length")))).otherwise(a["spans"]).alias("spans")),
        lambda a: a["spans"],
    )
    written = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    return grouped.select("conv_id", "window", written.alias("formatted"), walked.alias("loss_spans"), F.size(F.filter("turns", lambda t: t["repeated"])).alias("n_repeated"), F.size("turns").alias("n_turns"), "n_tokens")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, window, turns (role and text of those that are new in it, unescaped), losses (the unescaped texts under its mask)."""
    written = F.split(F.expr(f"left(formatted, char_length(formatted) - {len(CLOSE)})"), CLOSE, -1)
    new = F.slice(written, F.col("n_repeated") + 1, F.size(written))

    def turn(part: Column) -> Column:
        colon = F.position(F.lit(": "), part)  # a role has no colon of its own, so the first one ends it
        role = F.substr(part, F.lit(len(OPEN) + 1), colon - len(OPEN) - 1)
        return F.struct(unescape(role, role=True).alias("role"), unescape(F.substr(part, colon + 2)).alias("text"))

    losses = F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["length"])))
    return formatted.select("conv_id", "window", F.transform(new, turn).alias("turns"), losses.alias("losses"), F.char_length("formatted").cast("long").alias("n_chars"))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows, as read back from the windows.

    A digest needs its conversation as one string; a conversation is the one thing that is gathered here.
    """
    back = read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = back.select("conv_id", "window", F.size("turns").alias("n"), said.alias("said"), F.array_join("losses", "").alias("loss"), "n_chars")
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("window", "said", "loss"))).alias("parts"), F.sum("n").cast("long").alias("n_turns"), F.sum("n_chars").alias("formatted_chars"), F.count("*").alias("n_windows"))
    joined = lambda field: F.array_join(F.transform("parts", lambda p: p[field]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(joined("said"), 256).alias("turns_sha256"), F.char_length(joined("loss")).cast("long").alias("loss_chars"),
        F.sha2(joined("loss"), 256).alias("loss_sha256"), "formatted_chars", "n_windows",
    )
