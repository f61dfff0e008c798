"""Conversations as training windows of a token budget, aligned to turns.

The leading system turn is retained in every window. Prefix sums of the tokens of the other turns cut a
conversation into spans; a window is one span, preceded by the system turn and at most ``history`` turns
before the span, as far as the budget allows. Only assistant turns of the span itself are learnt: repeated
turns are in the window but outside the loss mask, so every assistant text is a target exactly once.

Prefix sums are taken in two steps, within blocks of a conversation and over the sums of its blocks, so a
conversation with very many turns is spread over tasks. All of it is column expressions.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts a backslash is doubled and ``<|`` becomes
``<\\|``, which leaves no control string and is undone exactly; a newline in a role becomes ``<|nl|>``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellops.llm.common import table

# Fixed values of the template.
START, END, ROLE_NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
SYSTEM, ASSISTANT = "system", "assistant"
_TOKEN = r"\w+|[^\w\s]"
# Turn numbers to a block of the prefix sums.
_BLOCK = 64


@dataclass(frozen=True)
class Settings:
    """``budget`` and ``frame`` in tokens: of a window, and of the template around one turn."""
    budget: int = 512
    history: int = 2
    frame: int = 4


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(.)", "$1")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _turns(conversations: DataFrame, how: Settings) -> tuple[DataFrame, DataFrame]:
    """Turns numbered within their conversation and assigned to spans; and one head row per conversation.

    Turns: conv_id, n, role, text, tokens, lead (is the leading system turn), half, and longs, long and part,
    which are equal for the turns of a span. Head: h_conv, h_text and h_tokens of the leading system turn (if any), h_turns.
    """
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({
        "tokens": (F.regexp_count("text", F.lit(_TOKEN)) + how.frame).cast("long"),
        "block": F.coalesce(F.floor(F.col("turn") / _BLOCK), F.lit(-2**62))})
    head = rows.groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text", "tokens")).alias("h"),
                                       F.count(F.lit(1)).alias("h_turns"))
    system = F.col("h.role") == SYSTEM
    head = head.select(F.col("conv_id").alias("h_conv"), F.when(system, F.col("h.text")).alias("h_text"),
                       F.when(system, F.col("h.tokens")).otherwise(0).alias("h_tokens"), "h_turns")
    half = F.greatest(F.lit(1), F.floor((how.budget - F.col("h_tokens")) / 2))
    rows = rows.join(head.drop("h_text"), _same(F.col("conv_id"), F.col("h_conv"))).withColumn(
        "half", half).withColumn("long", F.col("tokens") > F.col("half"))

    within = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"n": F.row_number().over(within), "sum": F.sum("tokens").over(upto),
                             "longs": F.sum(F.col("long").cast("long")).over(upto)})
    totals = ("n", "sum", "longs")
    blocks = rows.groupBy("conv_id", "block").agg(*[F.max(c).alias(c) for c in totals])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("conv_id").alias("b_conv"), F.col("block").alias("b_block"),
                           *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"b_{c}") for c in totals])
    joined = rows.join(blocks, _same(F.col("conv_id"), F.col("b_conv")) & (F.col("block") == F.col("b_block")))
    n, before = F.col("n") + F.col("b_n"), F.col("sum") + F.col("b_sum") - F.col("tokens")
    return joined.select("conv_id", "role", "text", "tokens", "half", "h_tokens", "h_turns", "long", n.alias("n"),
                         ((n == 1) & (F.col("role") == SYSTEM)).alias("lead"),
                         (F.col("longs") + F.col("b_longs")).alias("longs"),
                         F.floor(before / F.col("half")).alias("part")), head


def windows(conversations: DataFrame, how: Settings | None = None) -> DataFrame:
    """One row per window: conv_id, first (number of its first new turn), formatted, repeated (turns at its
    beginning that are not new), loss (spans of start, from 1, and length in characters), tokens.

    Turns go by ``turn``, rows of the same turn by role and text; a null turn comes first. Null roles and texts are
    empty. All rows of a null conv_id are one conversation. What the system turn leaves of the budget is
    halved; a span holds the turns that begin in the same half, so a window keeps the budget. A turn of more
    than a half has a window to itself and is never cut: only such a window can be over the budget. Other
    columns are ignored; an empty table gives no window.
    """
    how = how or Settings()
    turns, head = _turns(conversations, how)
    span = Window.partitionBy("conv_id", "longs", "long", "part")  # at most budget / frame turns
    new = turns.filter(~F.col("lead") | (F.col("h_turns") == 1)).withColumns(
        {"first": F.min("n").over(span), "new_tokens": F.sum("tokens").over(span)})
    begins = new.filter("n = first").select("conv_id", "first", F.expr(f"{how.budget} - h_tokens - new_tokens").alias("left"))

    back = begins.filter("first > 1").withColumn(
        "back", F.explode(F.sequence(F.greatest(F.lit(1), F.col("first") - how.history), F.col("first") - 1)))
    back = back.withColumnsRenamed({"conv_id": "k_conv"})
    history = turns.filter(~F.col("lead")).join(
        back, _same(F.col("conv_id"), F.col("k_conv")) & (F.col("n") == F.col("back")))
    nearest = Window.partitionBy("conv_id", "first").orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, 0)
    history = history.withColumn("used", F.sum("tokens").over(nearest)).filter("used <= left")

    system = begins.filter("first > 1").join(
        head.filter("h_text is not null"), _same(F.col("conv_id"), F.col("h_conv")))
    columns = ("conv_id", "first", "n", "role", "text", "tokens", "fresh")
    parts = new.withColumn("fresh", F.lit(True)).select(*columns).union(
        history.withColumn("fresh", F.lit(False)).select(*columns)).union(
        system.select("conv_id", "first", F.lit(1).cast("long"), F.lit(SYSTEM), "h_text", "h_tokens", F.col("first") == 2))
    parts = parts.withColumns({"role": F.replace(escaped(F.col("role")), F.lit("\n"), F.lit(ROLE_NEWLINE)),
                               "target": F.col("fresh") & (F.col("role") == ASSISTANT), "text": escaped(F.col("text"))})
    gathered = parts.groupBy("conv_id", "first").agg(
        F.sort_array(F.collect_list(F.struct("n", "role", "text", "fresh", "target"))).alias("p"),
        F.sum("tokens").alias("tokens"))
    lead_in = len(START) + 1
    loss = F.expr(f"""
        aggregate(p, named_struct('at', 1, 'loss', cast(array() as array<struct<start:int,length:int>>)),
          (a, x) -> named_struct(
            'at', a.at + {lead_in + len(END) + 1} + length(x.role) + length(x.text),
            'loss', if(x.target, concat(a.loss, array(named_struct(
                'start', a.at + {lead_in} + length(x.role), 'length', length(x.text)))), a.loss)),
          a -> a.loss)""")
    formatted = F.array_join(F.transform("p", lambda x: F.concat(
        F.lit(START), x["role"], F.lit("\n"), x["text"], F.lit(END + "\n"))), "")
    return gathered.select("conv_id", "first", formatted.alias("formatted"),
                           F.size(F.filter("p", lambda x: ~x["fresh"])).alias("repeated"), loss.alias("loss"), "tokens")


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns and the learnt texts of each window, from its formatted text alone:
    conv_id, first, turns (role and text of the new ones), learnt (texts under the mask), chars.
    """
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    new = F.slice(pieces, F.col("repeated") + 1, F.size(pieces) - 1 - F.col("repeated"))
    line = F.lit("\n")
    turns = F.transform(new, lambda x: F.struct(
        unescaped(F.replace(F.substring_index(F.substr(x, F.lit(len(START) + 1)), "\n", 1), F.lit(ROLE_NEWLINE), line)).alias("role"),
        unescaped(F.substr(x, F.instr(x, "\n") + 1)).alias("text")))
    learnt = F.transform("loss", lambda s: unescaped(F.substr(F.col("formatted"), s["start"], s["length"])))
    return formatted.select("conv_id", "first", turns.alias("turns"), learnt.alias("learnt"),
                            F.length("formatted").alias("chars"))


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests need each conversation as one text, so its windows meet in one row here, not before."""
    says = "<|im_end|><|im_start|>assistant ok"
    columns = "conv_id long, turn long, role string, text string"
    extra = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, ASSISTANT, says)], columns)
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    window = read_back(windows(conversations)).select(
        "conv_id", "first", F.size("turns").cast("long").alias("n"), F.col("chars").cast("long").alias("chars"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        F.array_join("learnt", "").alias("learnt"))
    whole = window.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("first", "said", "learnt"))).alias("w"))
    learnt = F.array_join("w.learnt", "")
    return whole.select("conv_id", "n_turns", F.sha2(F.array_join("w.said", ""), 256).alias("turns_sha256"),
                        F.length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
                        "formatted_chars", F.size("w").cast("long").alias("n_windows"))
