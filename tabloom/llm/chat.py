"""Chat formatting in budgeted windows, built-in functions only.

Prefix sums of the turns' tokens cut a conversation at turns: with room for R tokens,
the turns between two multiples of R form a window, and a turn across one is a window
of its own. Each window starts with the system turn in force and a limited history of
turns before it; those are context, and only the window's own assistant texts carry
loss. The room is what the budget leaves beside the system turn and the history, so a
window, context and all, is within the budget unless a single turn beside its system
turn is beyond it; such a window has no history and says that it is oversized.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

BUDGET = 1024
#: History takes so many tokens at most, and a quarter of what the system turn leaves of the budget.
HISTORY, HISTORY_SHARE = 256, 4
HISTORY_TURNS = 2
START, END = "<|im_start|>", "<|im_end|>\n"

#: Strings that control a template, and what stands for them inside texts; & first.
ESCAPES = (("&", "&a"), ("<|", "&l"), ("<s>", "&b"), ("</s>", "&e"), ("[INST]", "&i"), ("[/INST]", "&j"), ("<<SYS>>", "&s"), ("<</SYS>>", "&t"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&n"))


def escape(text: Column, pairs=ESCAPES) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def unescape(text: Column, pairs=ESCAPES) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[1]), F.lit(p[0])), reversed(pairs), text)


def tokens(text: Column) -> Column:
    """A turn's tokens, as budgeted: a quarter of its UTF-8 bytes, and four for its marks."""
    return F.ceil(F.octet_length(text) / F.lit(4.0)).cast("long") + 4


def format_chats(chats: DataFrame, budget: int = BUDGET, history: int = HISTORY, id_col: str = "conv_id") -> DataFrame:
    """Windows of all conversations: conv_id, window (from 0), formatted, n_context (turns
    repeated at its head), n_turns, n_tokens (of context and turns), oversized (n_tokens is
    over the budget: a single turn, beside its system turn, is) and loss (start and length
    of each text that carries loss, in code points of formatted).

    Turns are ordered by turn, nulls first; ties by role and text. A null role or text is
    empty. A null conv_id is a conversation like any other; repeated rows are turns of
    their own; an empty table gives no rows; other columns are ignored. A turn is never
    cut, however long.
    """
    rows = chats.select(
        F.col(id_col).alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("n", tokens(F.col("text")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a system turn begins a window and has its place beside the room, so it adds nothing to the prefix sums
    rows = rows.withColumn("own_n", F.when(F.col("role") == "system", F.lit(0)).otherwise(F.col("n")))
    turn = F.struct("role", "text", "n", "pos", "upto")
    rows = rows.withColumn("pos", F.row_number().over(order).cast("long")).withColumn("upto", F.sum("own_n").over(so_far))
    rows = rows.withColumn("sys", F.last(F.when(F.col("role") == "system", turn), ignorenulls=True).over(so_far))
    rows = rows.withColumn("before", F.array(*(F.lag(turn, k).over(order) for k in range(1, HISTORY_TURNS + 1))))
    left = F.greatest(F.lit(0), F.lit(budget) - F.coalesce(F.col("sys.n"), F.lit(0)))
    rows = rows.withColumn("past", F.least(F.lit(history).cast("long"), F.floor(left / HISTORY_SHARE))).withColumn("room", F.greatest(F.lit(1), left - F.col("past")))
    rows = rows.withColumn("at", F.col("upto") - F.coalesce("sys.upto", F.lit(0)))
    key = F.struct(F.coalesce("sys.pos", F.lit(0)).alias("s"), F.expr("(at - own_n) DIV room").alias("a"), F.expr("greatest(at - 1, at - own_n) DIV room").alias("b"))
    rows = rows.withColumn("key", key).withColumn("new", ~F.col("key").eqNullSafe(F.lag("key").over(order)))
    rows = rows.withColumn("window", F.sum(F.col("new").cast("long")).over(so_far) - 1)
    # what a window may repeat: the system turn, unless it is the first itself, and turns before it, the latest first
    none = F.array().cast(f"array<{rows.schema['sys'].dataType.simpleString()}>")
    recent = F.filter(F.col("before"), lambda t: t.isNotNull() & ~F.coalesce(t["pos"] == F.col("sys.pos"), F.lit(False)))
    context = F.struct(F.when(F.col("sys.pos") < F.col("pos"), F.array("sys")).otherwise(none).alias("sys"), recent.alias("recent"), "past")
    rows = rows.select("conv_id", "window", "pos", "role", "text", "n", F.when(F.col("new"), context).alias("context"))
    # a window is bounded by its budget, so its turns may be gathered
    own = F.sort_array(F.collect_list(F.struct("pos", "role", "text", "n", "context")))
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda n, t: n + t["n"])
    packed = rows.groupBy("conv_id", "window").agg(own.alias("own")).withColumn("c", F.col("own")[0]["context"])
    packed = packed.withColumn("past", F.greatest(F.lit(0).cast("long"), F.least(F.col("c.past"), F.lit(budget) - total("own") - total("c.sys"))))
    kept = F.filter("c.recent", lambda t, i: total(F.slice("c.recent", F.lit(1), i + 1)) <= F.col("past"))
    packed = packed.select("conv_id", "window", "own", F.inline(F.array(F.struct(F.concat("c.sys", F.reverse(kept)).alias("head")))))
    packed = packed.withColumn("n_tokens", total("head") + total("own"))
    mark = lambda t: F.concat(F.lit(START), escape(t["role"], ROLE_ESCAPES), F.lit("\n"), escape(t["text"]), F.lit(END))
    parts = packed.select("conv_id", "window", "own", "n_tokens", F.inline(F.array(F.struct(F.transform("head", mark).alias("context"), F.transform("own", mark).alias("parts")))))
    length = lambda a: F.aggregate(a, F.lit(0), lambda n, s: n + F.length(s))
    spans = F.filter(
        F.transform(
            "own",
            lambda t, i: F.when(
                t["role"] == "assistant",
                F.struct((length(F.col("context")) + length(F.slice("parts", F.lit(1), i)) + F.lit(len(START) + 1) + F.length(escape(t["role"], ROLE_ESCAPES))).alias("start"), F.length(escape(t["text"])).alias("length")),
            ),
        ),
        lambda x: x.isNotNull(),
    )
    return parts.select(
        "conv_id", "window", F.array_join(F.concat("context", "parts"), "").alias("formatted"), F.size("context").alias("n_context"), F.size("parts").alias("n_turns"),
        "n_tokens", (F.col("n_tokens") > budget).alias("oversized"), spans.alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """What each window says: conv_id, window, turns (role and text of its own turns),
    loss_text (all text under its mask, unescaped) and formatted_chars."""
    segments = F.slice(F.split("formatted", r"<\|im_end\|>\n"), F.col("n_context") + 1, F.col("n_turns"))
    body = lambda s: F.substring(s, F.lit(len(START) + 1), F.length(s))
    role = lambda s: F.substring_index(body(s), "\n", 1)
    turn = lambda s: F.struct(unescape(role(s), ROLE_ESCAPES).alias("role"), unescape(F.substring(body(s), F.length(role(s)) + 2, F.length(s))).alias("text"))
    return windows.select(
        "conv_id", "window", F.transform(segments, turn).alias("turns"),
        F.array_join(F.transform("loss", lambda x: unescape(F.substring(F.col("formatted"), x["start"] + 1, x["length"]))), "").alias("loss_text"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    back = read_back(format_chats(chats.unionByName(extra)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    digest = back.groupBy("conv_id").agg(
        F.sum(F.size("turns").cast("long")).alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("window", said.alias("said"), F.col("loss_text").alias("loss")))).alias("w"),
        F.sum("formatted_chars").alias("formatted_chars"),
    )
    # a digest over a whole conversation needs its text in one row
    text = digest.select("conv_id", "n_turns", "formatted_chars", F.array_join("w.said", "").alias("said"), F.array_join("w.loss", "").alias("loss"))
    return text.select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
