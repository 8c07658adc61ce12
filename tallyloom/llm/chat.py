"""Chat formatting in budgeted windows, with DataFrame functions only.

Prefix sums of turn tokens choose where a conversation's windows begin, always at a turn. Each window after the first repeats the system
turn and a limited history, and the repeated turns are outside its loss mask, so every assistant text is learnt from once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import stored, table

# The template's control strings.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Tokens of a window, of repeated history in it, and characters a token.
BUDGET, HISTORY, CHARS = 512, 128, 4
#: Windows that are filled one after another before the next turn begins a new one in any case: what one row gathers.
SEGMENT = 8


def escape(text: Column) -> Column:
    """Backslashes are doubled and `<|` gets one inside, so that no control string is left and one lone backslash marks it."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, learn: str = "assistant", conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", tokens_col: str | None = None) -> DataFrame:
    """(conv_col, window, text, loss, repeated): the windows of every conversation.

    loss holds the (start, end) code points, end exclusive, of the texts of new turns with role `learn`; repeated is the number of turns
    before the first new one. A first turn with role system is repeated in every window, and of the window before as many last turns as
    fit `history`. New turns fill what the budget leaves beside them, turn by turn, by the prefix sums of their tokens; a turn longer
    than that is a window of its own, whole. tokens_col names the tokens of each text; without it a token is CHARS characters. Null
    roles and texts count as empty, null tokens as none. After SEGMENT windows' worth of tokens a new window begins, so that no row
    gathers more than that. Turns go by turn number
    (null first), ties by role and text, and repeated rows are turns of their own; a null conversation id is one conversation. An empty
    table gives no windows. Only prefix sums are taken over a whole conversation, in rows that can spill; a window's rows then meet.
    """
    w = Window.partitionBy("conv").orderBy("turn", "role", "body")
    before, upto, whole = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("conv")
    role = F.coalesce(F.col(role_col), F.lit(""))
    tokens = F.lit(None).cast("long") if tokens_col is None else F.coalesce(F.col(tokens_col).cast("long"), F.lit(0))
    t = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), escape(F.coalesce(F.col(text_col), F.lit(""))).alias("body"), tokens.alias("tokens"))
    t = t.withColumn("head", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)))
    plain = F.length("head") + len(END)
    t = t.withColumn("cost", F.coalesce(F.col("tokens") + F.ceil(plain / CHARS), F.ceil((plain + F.length("body")) / CHARS)).cast("long")).drop("tokens")
    t = t.withColumns({"pos": F.row_number().over(w), "led": F.first("role").over(upto) == "system", "lead_cost": F.first("cost").over(upto)})
    t = t.withColumn("fixed", F.col("led") & (F.col("pos") == 1)).withColumn("new_cost", F.when(F.col("fixed"), 0).otherwise(F.col("cost")))
    room = F.greatest(F.lit(1).cast("long"), F.lit(budget - history) - F.when(F.col("led"), F.col("lead_cost")).otherwise(0))
    t = t.withColumns({"room": room, "sum": F.coalesce(F.sum("new_cost").over(before), F.lit(0))})
    t = t.withColumn("segment", F.floor(F.col("sum") / (F.col("room") * SEGMENT)))
    so_far = F.collect_list("new_cost").over(Window.partitionBy("conv", "segment").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    full = lambda a, c: (a["used"] > 0) & (a["used"] + c > F.col("room"))
    fill = lambda a, c: F.struct(F.when(full(a, c), c).otherwise(a["used"] + c).alias("used"), (a["n"] + full(a, c).cast("int")).alias("n"))
    t = t.withColumn("part", F.struct("segment", F.aggregate(so_far, F.struct(F.lit(0).cast("long").alias("used"), F.lit(0).alias("n")), fill)["n"]))
    t = t.withColumn("begins", ~F.col("fixed") & ((F.col("pos") == 1 + F.col("led").cast("int")) | (F.col("part") != F.lag("part").over(w))))
    t = t.withColumn("window", F.greatest(F.lit(0), F.sum(F.col("begins").cast("int")).over(upto) - 1).cast("int"))
    t = t.withColumns({"end": F.max(F.col("sum") + F.col("new_cost")).over(Window.partitionBy("conv", "window")), "last": F.max("window").over(whole)})
    again = (F.col("window") < F.col("last")) & (F.col("end") - F.col("sum") <= history)
    own, other = F.array("window"), F.array(F.col("window") + 1)
    t = t.withColumn("at", F.explode(F.when(F.col("fixed"), F.expr("sequence(0, last)")).when(again, F.concat(own, other)).otherwise(own)))
    row = F.struct("pos", (F.col("at") > F.col("window")).alias("again"), "role", "head", "body")
    t = t.groupBy("conv", F.col("at").alias("window")).agg(F.sort_array(F.collect_list(row)).alias("rows")).withColumn("repeated", F.size(F.filter("rows", lambda x: x["again"])))
    spans = F.array().cast("array<struct<start:int,end:int>>")

    def place(a, x):
        at = a["at"] + F.length(x["head"])
        end = at + F.length(x["body"])
        new = ~x["again"] & (x["role"] == learn)
        return F.struct((end + len(END)).alias("at"), F.when(new, F.concat(a["loss"], F.array(F.struct(at.alias("start"), end.alias("end"))))).otherwise(a["loss"]).alias("loss"))

    loss = F.aggregate("rows", F.struct(F.lit(0).alias("at"), spans.alias("loss")), place, lambda a: a["loss"])
    text = F.array_join(F.transform("rows", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "")
    return t.select(F.col("conv").alias(conv_col), "window", text.alias("text"), loss.alias("loss"), "repeated")


def read_turns(text: Column, repeated: Column) -> Column:
    """The new turns (role, text) of a window's text."""
    parts = F.split(text, r"\Q" + END + r"\E")
    pair = F.transform(F.slice(parts, repeated + 1, F.size(parts) - 1 - repeated), lambda p: F.split(F.substring(p, len(TURN) + 1, F.length(p)), r"\Q" + TEXT + r"\E"))
    return F.transform(pair, lambda p: F.struct(unescape(p[0]).alias("role"), unescape(p[1]).alias("text")))


def read_loss(text: Column, loss: Column) -> Column:
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), "")


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row a conversation, from its windows alone: turns counted once, their digest, the text under the loss mask, characters formatted."""
    turns = read_turns(F.col("text"), F.col("repeated"))
    parts = formatted.select(conv_col, "window", F.size(turns).alias("n"), F.array_join(F.transform(turns, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").alias("turns"), read_loss(F.col("text"), F.col("loss")).alias("loss"), F.length("text").alias("chars"))
    out = parts.groupBy(conv_col).agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows"), F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"))
    whole = lambda c: F.array_join(F.col(f"w.{c}"), "")
    return out.select(conv_col, "n_turns", F.sha2(whole("turns"), 256).alias("turns_sha256"), F.length(whole("loss")).cast("long").alias("loss_chars"), F.sha2(whole("loss"), 256).alias("loss_sha256"), "formatted_chars", "n_windows")


def op9_chat_formatting(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast(turns.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(turns.schema["turn"].dataType).alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return read_back(stored(windows(turns.unionByName(more)), "chats"))


QUERIES = {"op9_chat_formatting": op9_chat_formatting}
ORACLE: dict[str, str] = {}
