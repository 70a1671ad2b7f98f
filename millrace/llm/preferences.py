"""Preference formatting: one prompt, two masked completions, from a chosen and a rejected conversation.

A conversation is an array of turns (role, text). The longest common turn prefix of both is rendered
once, as the prompt; what follows in each is its completion, with the character ranges that training
should score: the texts of the assistant's turns with the mark that ends them. Everything is built-in
array expressions on the columns of one row, so a pair costs no shuffle.

Edge cases: a null array is an empty conversation, a null role reads ``unknown``, a null text is
empty. At least the last turn of either stays out of the prompt, so that both completions exist where
both conversations have turns; ``usable`` says whether both have something to score and differ. Text
that looks like a mark of the template is broken up by a blank, so it cannot end or begin a turn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import column

TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Template:
    """A turn is ``opening`` role ``middle`` text ``closing``."""

    opening: str = "<|im_start|>"
    middle: str = "\n"
    closing: str = "<|im_end|>\n"
    scored_role: str = "assistant"

    def marks(self) -> list[str]:
        return [m for m in (self.opening.strip(), self.closing.strip()) if len(m) > 1]


def _plain(text: Column, template: Template) -> Column:
    for mark in template.marks():
        text = F.replace(text, F.lit(mark), F.lit(mark[0] + " " + mark[1:]))
    return text


def _head(turn: Column, template: Template) -> Column:
    return F.concat(F.lit(template.opening), _plain(F.coalesce(turn["role"], F.lit("unknown")), template), F.lit(template.middle))


def _tail(turn: Column, template: Template) -> Column:
    return F.concat(_plain(F.coalesce(turn["text"], F.lit("")), template), F.lit(template.closing))


def rendered(turns: Column, template: Template) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t, template), _tail(t, template))), "")


def scored_ranges(turns: Column, template: Template) -> Column:
    """Ranges of the rendered turns that belong to the scored role, as ``start`` and ``stop`` in characters."""
    sizes = F.transform(turns, lambda t: F.struct(
        F.length(_head(t, template)).alias("head"), F.length(_tail(t, template)).alias("tail"),
        F.coalesce(t["role"] == template.scored_role, F.lit(False)).alias("scored")))
    empty = F.struct(F.lit(0).alias("at"), F.lit(None).cast("array<struct<start: int, stop: int>>").alias("ranges"))

    def add(state: Column, size: Column) -> Column:
        start = state["at"] + size["head"]
        stop = start + size["tail"]
        one = F.array(F.struct(start.alias("start"), stop.alias("stop")))
        before = F.coalesce(state["ranges"], F.array().cast("array<struct<start: int, stop: int>>"))
        return F.struct(stop.alias("at"), F.when(size["scored"], F.concat(before, one)).otherwise(before).alias("ranges"))

    return F.aggregate(sizes, empty, add, lambda s: F.coalesce(s["ranges"], F.array().cast("array<struct<start: int, stop: int>>")))


def common_prefix(chosen: Column, rejected: Column) -> Column:
    """Number of leading turns in which both agree, the last turn of either aside."""
    most = F.greatest(F.least(F.size(chosen), F.size(rejected)) - 1, F.lit(0))
    same = F.transform(F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>")),
                       lambda i: F.get(chosen, i - 1).eqNullSafe(F.get(rejected, i - 1)))
    differs = F.array_position(same, False)
    return F.when(differs > 0, differs - 1).otherwise(most).cast("int")


RESULTS = ("prompt_turns", "prompt", "chosen_completion", "chosen_ranges", "rejected_completion", "rejected_ranges", "usable")


def format_pairs(df: DataFrame, chosen: str, rejected: str, template: Template = Template()) -> DataFrame:
    """The frame without the two arrays of turns and with ``RESULTS``; columns of these names are replaced."""
    good = F.coalesce(column(df, chosen).cast(TURNS), F.array().cast(TURNS))
    bad = F.coalesce(column(df, rejected).cast(TURNS), F.array().cast(TURNS))
    gone = {chosen.lower(), rejected.lower(), *RESULTS}
    kept = [c for c in df.columns if c.lower() not in gone]
    # All other columns travel as one, so that none can clash with a name used here.
    rest = [F.struct(*[column(df, c) for c in kept]).alias("rest")] if kept else []
    parts = df.select(*rest, good.alias("good"), bad.alias("bad"), common_prefix(good, bad).alias("prompt_turns"))
    after = [F.slice(c, F.col("prompt_turns") + 1, F.size(c)).alias(c) for c in ("good", "bad")]
    own = ["rest"] if kept else []
    cut = parts.select(*own, "prompt_turns", rendered(F.slice("good", 1, F.col("prompt_turns")), template).alias("prompt"), *after)
    shown = cut.select(*own, "prompt_turns", "prompt",
                       *[f(F.col(c), template).alias(f"{name}_{what}")
                         for c, name in (("good", "chosen"), ("bad", "rejected"))
                         for f, what in ((rendered, "completion"), (scored_ranges, "ranges"))])
    usable = (F.size("chosen_ranges") > 0) & (F.size("rejected_ranges") > 0) & (F.col("chosen_completion") != F.col("rejected_completion"))
    return shown.select(*[F.col("rest")[c].alias(c) for c in kept], *RESULTS[:-1], usable.alias("usable"))


def conversations(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """``conversation`` and ``turns`` in order of turn, role and text; repeated rows count once.

    Rows of no conversation (null) are left out. A conversation becomes one row, as an example must;
    equal rows are folded before the shuffle.
    """
    rows = turns.where(column(turns, conversation).isNotNull())
    one = F.struct(column(rows, turn).alias("turn"), column(rows, role).alias("role"), column(rows, text).alias("text"))
    grouped = rows.groupBy(column(rows, conversation).alias("conversation")).agg(F.sort_array(F.collect_set(one)).alias("turns"))
    return grouped.select("conversation", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def sibling_and_echo_pairs(whole: DataFrame, scored_role: str = "assistant") -> DataFrame:
    """Preference pairs for conversations that carry no preferences.

    Conversations that open with the same turn are siblings: the one with the smallest id is chosen
    over each other one that goes on differently. Any other conversation is chosen over a copy of itself
    whose last turn of the scored role only echoes the turn before it. Conversations that have no such
    turn behind another one give no pair. Returns conversation, kind, chosen and rejected.
    """
    keyed = whole.withColumn("opening", F.sha2(F.to_json(F.get("turns", F.lit(0)), {"ignoreNullFields": "false"}), 256))
    heads = keyed.groupBy("opening").agg(F.min("conversation").alias("first"), F.max("conversation").alias("last")).where("first <> last")
    lead = keyed.join(heads.select(F.col("first").alias("conversation")), "conversation").select(
        "opening", F.col("turns").alias("lead"))
    both = keyed.join(lead, "opening", "left")
    sibling = F.col("lead").isNotNull() & (F.col("lead") != F.col("turns"))
    place = F.size("turns") - F.array_position(F.reverse(F.transform("turns", lambda t: F.coalesce(t["role"] == scored_role, F.lit(False)))), True) + 1
    last = F.when(place <= F.size("turns"), place).otherwise(0).cast("int")  # 0: no such turn
    echo = F.transform("turns", lambda t, i: F.when(i == F.col("place") - 1, F.struct(
        t["role"].alias("role"), F.get("turns", i - 1)["text"].alias("text"))).otherwise(t))
    pairs = both.withColumn("place", last).withColumn("sibling", sibling).where(F.col("sibling") | (F.col("place") > 1))
    return pairs.select("conversation", F.when(F.col("sibling"), "sibling").otherwise("echo").alias("kind"),
                        F.when(F.col("sibling"), F.col("lead")).otherwise(F.col("turns")).alias("chosen"),
                        F.when(F.col("sibling"), F.col("turns")).otherwise(echo).alias("rejected"))
