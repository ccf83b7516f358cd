"""Quotation linking: reply-ordered conversations without quotes, in DataFrame functions only.

A line's quote level is its number of leading ``>``.  Neighbouring lines of one level form a quoted
passage; passages, their paragraphs and their lines are normalised (lower case, white space squeezed)
and hashed, as are the unquoted texts, paragraphs and lines of every message.  A quoted unit belongs to
the first message of its conversation that holds the unit, if that is an earlier one.  A message replies
to the original of its shallowest linked passage (then the largest unit, then the latest original).
Following replies by pointer doubling gives each message its thread (the first message) and depth.

Null texts count as empty.  Null conversations and turns are keys like any other and come first.
Rows that share a conversation and turn are one message with the smallest role and text.  Messages that
quote nothing known start their own thread.  Order within a conversation: thread, depth, turn.  No
conversation is collected into one row, so it may be of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import common

QUOTE = r"^(?:[ \t]*>)+"
#: The size of units, the larger the better: line, paragraph, whole.
LINE, PARAGRAPH, WHOLE = 0, 1, 2


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_substr(line, F.lit(QUOTE)), "[^>]", ""))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def units(passages: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, size, x, y) of every passage, paragraph and line that holds visible text; ``body`` is the passage."""
    lines = F.transform(F.split("body", "\n", -1), lambda x: F.struct(F.lit(LINE).alias("size"), normalised(x).alias("u")))
    paragraphs = F.transform(F.split("body", r"\n[ \t]*\n", -1), lambda x: F.struct(F.lit(PARAGRAPH).alias("size"), normalised(x).alias("u")))
    whole = F.array(F.struct(F.lit(WHOLE).alias("size"), normalised(F.col("body")).alias("u")))
    each = passages.select(*keys, F.explode(F.concat(whole, paragraphs, lines)).alias("n")).where("n.u <> ''")
    return each.groupBy(*keys, F.xxhash64("n.u").alias("x"), F.xxhash64("n.u", F.lit(1)).alias("y")).agg(F.max("n.size").alias("size"))


def messages(conversations: DataFrame) -> DataFrame:
    """One row for each (conv, turn) with null keys replaced."""
    d = conversations.select(*[F.coalesce(F.col(f"`{c}`").cast("long"), F.lit(common.NO_ID)).alias(a) for c, a in (("conv_id", "conv"), ("turn", "turn"))], F.col("`role`").alias("role"), F.coalesce(F.col("`text`"), F.lit("")).alias("text"))
    return d.groupBy("conv", "turn").agg(F.min(F.struct("role", "text")).alias("m")).select("conv", "turn", "m.role", "m.text")


def quoted_passages(m: DataFrame) -> DataFrame:
    """(conv, turn, passage, depth, body): runs of lines of one quote level, without their marks."""
    lines = m.where(F.col("text").rlike(r"(?m)" + QUOTE)).select("conv", "turn", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.withColumn("depth", F.coalesce(level(F.col("line")), F.lit(0)))
    w = Window.partitionBy("conv", "turn").orderBy("pos")
    new = F.coalesce((F.col("depth") != F.lag("depth").over(w)).cast("int"), F.lit(1))
    runs = lines.withColumn("new", new).withColumn("passage", F.sum("new").over(w)).where("depth > 0")
    body = F.regexp_replace("line", QUOTE + " ?", "")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", body.alias("b")))), lambda r: r["b"]), "\n")
    return runs.groupBy("conv", "turn", "passage", "depth").agg(joined.alias("body"))


def own_text(text: Column) -> Column:
    """The text without quoted lines and without the line that announces a quote (ending in ``wrote:``)."""
    lines = F.split(text, "\n", -1)
    follows = F.concat(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), F.array(F.lit("")))
    kept = F.filter(F.arrays_zip(lines.alias("l"), follows.alias("n")), lambda z: ~z["l"].rlike(QUOTE) & ~(z["l"].rlike(r"wrote:[ \t]*$") & z["n"].rlike(QUOTE)))
    return F.regexp_replace(F.regexp_replace(F.array_join(F.transform(kept, lambda z: z["l"]), "\n"), r"^\n+", ""), r"\n+$", "")


def threads(links: DataFrame) -> DataFrame:
    """(conv, turn, thread, depth) for linked messages, by pointer doubling along ``reply_to``."""
    up = common.cut(links.select("conv", "turn", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        above = up.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("t2"), F.col("depth").alias("d2"))
        moved = up.join(above, ["conv", "thread"], "left")
        up = common.cut(moved.select("conv", "turn", F.coalesce("t2", "thread").alias("thread"), (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"), F.col("t2").isNotNull().alias("moved")), "threads")
        if up.where("moved").limit(1).count() == 0:
            return up.drop("moved")
        up = up.drop("moved")


def link_quotations(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (without quotes), reply_to, thread, depth, n_quotes, n_linked for every message."""
    m = common.cut(messages(conversations), "messages")
    passages = quoted_passages(m)
    quoted = common.cut(passages.select("conv", "turn", "passage", "depth", "body"), "passages")
    asked = quoted.select("conv").distinct()
    said = units(m.join(asked, "conv", "left_semi").select("conv", "turn", own_text(F.col("text")).alias("body")), ["conv", "turn"])
    original = said.groupBy("conv", "x", "y").agg(F.min("turn").alias("origin"))
    found = units(quoted, ["conv", "turn", "passage", "depth"]).join(original, ["conv", "x", "y"]).where("origin < turn")
    best = F.min(F.struct("depth", (-F.col("size")).alias("size"), (-F.col("origin")).alias("origin"))).alias("b")
    links = common.cut(found.groupBy("conv", "turn").agg(best, F.countDistinct("passage").alias("n_linked")).select("conv", "turn", (-F.col("b.origin")).alias("reply_to"), "n_linked"), "replies")
    n = quoted.groupBy("conv", "turn").agg(F.count("*").alias("n_quotes"))
    out = m.join(links, ["conv", "turn"], "left").join(threads(links), ["conv", "turn"], "left").join(n, ["conv", "turn"], "left")
    zero = F.lit(0).cast("long")
    out = out.select(F.col("conv").alias("conv_id"), "turn", "role", own_text(F.col("text")).alias("text"), "reply_to", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", zero).alias("depth"), F.coalesce("n_quotes", zero).alias("n_quotes"), F.coalesce("n_linked", zero).alias("n_linked"))
    return common.restored(out, "conv_id", "turn", "thread", "reply_to")
