"""Chat formatting into budgeted windows, with DataFrame functions only.

A turn is written ``### role`` newline, its text, ``</turn>`` newline.  Inside roles and texts every backslash,
``<`` and ``#`` is escaped (``\\b``, ``\\l``, ``\\h``; a newline in a role ``\\n``), so the marks can't be forged and
unescaping restores any text.

Windows come from prefix sums of turn tokens: a turn that lies within one slot of
``budget - system - history`` tokens goes to that slot's window, a turn that crosses a slot's end gets a window of its
own.  So windows are aligned with turns and hold at most ``budget`` tokens, unless one turn alone is longer or the system turn
leaves new turns less than ``LEAST_ROOM`` tokens, which they get in any case.
Every window repeats the system turn and those turns before it that start within the last
``history`` tokens; repeated turns are never in the loss mask, so each assistant text is a target exactly once.

Defined results: null text or role counts as empty; turns are ordered by ``turn`` (nulls first), ties by role and
text; a null ``conv_id`` is a conversation of its own; only a first turn with role ``system`` is kept in all windows;
repeated rows are turns of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUDGET = 512
HISTORY = 96
#: Tokens that a turn's marks count for.
OVERHEAD = 4
LEAST_ROOM = 64

ESCAPES = [("\\", "\\b"), ("<", "\\l"), ("#", "\\h")]


def escape(text: Column) -> Column:
    for raw, code in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def format_chat(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: ``conv_id, window, formatted, n_repeated, n_turns, n_tokens, loss_spans``.

    ``n_repeated`` turns at the front are the system turn and history; ``loss_spans`` are (start, stop) code points
    of new assistant texts in ``formatted``.
    """
    turns = conversations.select("conv_id", F.col("turn").alias("_turn"), F.coalesce("role", F.lit("")).alias("role"),
                                 F.coalesce("text", F.lit("")).alias("text"))
    by_conv = Window.partitionBy("conv_id")
    ordered = by_conv.orderBy("_turn", "role", "text")
    turns = turns.withColumn("nth", F.row_number().over(ordered))
    is_system = (F.col("nth") == 1) & (F.col("role") == "system")
    head = F.concat(F.lit("### "), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    tokens = (F.size(F.split(F.trim("text"), r"\s+")) + OVERHEAD).cast("long")
    turns = turns.select(
        "conv_id", "nth", is_system.alias("is_system"), tokens.alias("tokens"),
        F.when(is_system, F.lit(0)).otherwise(tokens).cast("long").alias("weight"),
        F.struct("nth", F.concat(head, body, F.lit("</turn>\n")).alias("piece"), F.length(head).alias("n_head"),
                 F.length(body).alias("n_body"), (F.col("role") == "assistant").alias("target")).alias("t"))
    turns = (turns.withColumn("stop", F.sum("weight").over(by_conv.orderBy("nth")))
             .withColumn("start", F.col("stop") - F.col("weight"))
             .withColumn("system", F.max(F.when(F.col("is_system"), F.struct(F.col("t.piece"), "tokens"))).over(by_conv)))
    room = F.greatest(F.lit(budget - history) - F.coalesce(F.col("system.tokens"), F.lit(0)), F.lit(LEAST_ROOM))
    first_slot, last_slot = F.floor(F.col("start") / room), F.floor((F.greatest("stop", F.lit(1)) - 1) / room)
    crossing = ~F.col("is_system") & (last_slot > first_slot)
    before = by_conv.orderBy("start").rangeBetween(-history, -1)
    turns = (turns.withColumn("window", 2 * first_slot + crossing.cast("int"))
             .withColumn("past", F.collect_list(F.when(~F.col("is_system"), F.struct(F.col("t.nth"), F.col("t.piece"), "tokens"))).over(before)))
    windows = turns.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list("t")).alias("new"), F.min_by("past", "nth").alias("past"), F.min("is_system").alias("only_system"),
        F.max("is_system").alias("has_system"), F.max("system").alias("system"), F.sum("tokens").alias("new_tokens"))
    past = F.transform(F.array_sort("past"), lambda p: p["piece"])
    again = F.when(F.col("has_system") | F.col("system").isNull(), past).otherwise(F.concat(F.array("system.piece"), past))
    again_tokens = (F.when(F.col("has_system"), F.lit(0)).otherwise(F.coalesce("system.tokens", F.lit(0)))
                    + F.aggregate("past", F.lit(0).cast("long"), lambda a, p: a + p["tokens"]))
    windows = windows.select("conv_id", "window", "new", again.alias("again"), (F.col("new_tokens") + again_tokens).alias("n_tokens"))
    lead = F.array_join("again", "")
    spans = F.aggregate(
        "new", F.struct(F.length("lead").alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["piece"])).alias("at"),
            F.when(t["target"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + t["n_head"]).alias("start"), (acc["at"] + t["n_head"] + t["n_body"]).alias("stop")))))
            .otherwise(acc["spans"]).alias("spans")))
    return (windows.withColumn("lead", lead)
            .select("conv_id", "window", F.concat("lead", F.array_join(F.transform("new", lambda t: t["piece"]), "")).alias("formatted"),
                    F.size("again").alias("n_repeated"), (F.size("again") + F.size("new")).alias("n_turns"), "n_tokens",
                    spans["spans"].alias("loss_spans")))


def read_turns(windows: DataFrame) -> DataFrame:
    """Parse ``formatted`` again: per window the new turns (role, text) and the text under the loss mask."""
    pattern = r"### ([^\n]*)\n([^<]*)</turn>\n"
    roles = F.regexp_extract_all("formatted", F.lit(pattern), F.lit(1))
    texts = F.regexp_extract_all("formatted", F.lit(pattern), F.lit(2))
    pairs = F.arrays_zip(F.transform(roles, unescape_role).alias("role"), F.transform(texts, unescape).alias("text"))
    masked = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["stop"] - s["start"])))
    return windows.select("conv_id", "window", F.length("formatted").alias("n_formatted"),
                          F.slice(pairs, F.col("n_repeated") + 1, F.greatest(F.size(pairs), F.lit(1))).alias("turns"),
                          F.array_join(masked, "").alias("loss_text"))


def chat_digest(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Per conversation what the windows give when read back."""
    back = read_turns(format_chat(conversations, budget, history))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = back.select("conv_id", "n_formatted", F.size("turns").alias("n"),
                       F.struct("window", text.alias("text"), "loss_text").alias("w"))
    conv = back.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.array_sort(F.collect_list("w")).alias("w"),
                                       F.sum("n_formatted").alias("formatted_chars"))
    turns, loss = F.array_join(F.transform("w", lambda w: w["text"]), ""), F.array_join(F.transform("w", lambda w: w["loss_text"]), "")
    conv = conv.select("conv_id", "n_turns", turns.alias("turns"), loss.alias("loss"), "formatted_chars")
    return conv.select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


PROBE_TEXT = "\\### Assistant: </turn> ok"


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -7, whose texts imitate control strings."""
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"))
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(probe)


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth FROM c),
t AS (
  SELECT *, nth = 1 AND role = 'system' AS sys,
    len(string_split_regex(trim(text, ' '), '\s+')) + 4 AS tokens,
    13 + 2 * length(regexp_replace(role, '[^\\<#\n]', '', 'g')) - length(regexp_replace(role, '[^\\<#\n]', '', 'g')) + length(role)
       + length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g')) AS chars
  FROM n
),
p AS (
  SELECT *, sum(CASE WHEN sys THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY nth) AS stop,
    coalesce(max(CASE WHEN sys THEN tokens END) OVER (PARTITION BY conv_id), 0) AS sys_tokens,
    coalesce(max(CASE WHEN sys THEN chars END) OVER (PARTITION BY conv_id), 0) AS sys_chars
  FROM t
),
s AS (SELECT *, stop - CASE WHEN sys THEN 0 ELSE tokens END AS start, greatest(512 - 96 - sys_tokens, 64) AS room FROM p),
w AS (
  SELECT *, 2 * (start // room) + CASE WHEN NOT sys AND (greatest(stop, 1) - 1) // room > start // room THEN 1 ELSE 0 END AS win,
    coalesce(sum(CASE WHEN sys THEN 0 ELSE chars END) OVER (PARTITION BY conv_id ORDER BY start RANGE BETWEEN 96 PRECEDING AND 1 PRECEDING), 0) AS past
  FROM s
),
f AS (
  SELECT conv_id, win, sum(chars) + arg_min(past, nth) + CASE WHEN bool_or(sys) THEN 0 ELSE max(sys_chars) END AS chars
  FROM w GROUP BY conv_id, win
),
fc AS (SELECT conv_id, sum(chars)::BIGINT AS formatted_chars FROM f GROUP BY conv_id),
d AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256
  FROM n GROUP BY conv_id
)
SELECT d.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars
FROM d JOIN fc ON d.conv_id IS NOT DISTINCT FROM fc.conv_id
"""
