"""Preference formatting: one prompt, two masked completions.

A pair has a chosen and a rejected conversation. Their longest common prefix
of turns (same role and text) is rendered once, as the prompt; what follows
in each is its completion. A completion comes with a mask: the spans of its
characters that the loss covers, which are the assistant turns' texts and end
marks, never headers or other roles' turns.

A turn renders as ``<|role|>\\ntext<|end|>\\n``. No text can forge a marker: a
``<|`` inside a text or role is written with a backslash between its two signs,
one that has backslashes there already gets one more, and ``|>`` in a role
likewise, so one backslash less gives the original back. A pair's turns are
ordered by turn number, then role and text; no turn is dropped. All is built-in
expressions over one row per pair; the unit gathered is one conversation.

Defined results: a NULL role is ``unknown``, a NULL text empty, a NULL turn
number comes first; a side without turns has an empty completion; equal
conversations have all turns in the prompt and two empty completions; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from argent.llm.common import table
from argent.llm.fingerprints import with_next

END = "<|end|>\n"
#: Role whose turns the loss covers.
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    """``text`` with a backslash more between ``<`` and ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def conversations_of(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(``id``, ``turns``): each conversation's turns in order, as
    ``array<struct<turn, role, text>>``, markers in them escaped."""
    role = F.regexp_replace(escaped(F.coalesce("role", F.lit("unknown"))), r"\|(\\*)>", r"|\\$1>")
    turn = F.struct(F.col("turn"), role.alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("text"))
    return turns.groupBy(F.col(id_col).alias("id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    n = F.least(F.size(chosen), F.size(rejected))
    same = F.aggregate(
        F.zip_with(F.slice(chosen, F.lit(1), n), F.slice(rejected, F.lit(1), n),
                   lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"])),
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("open")),
        lambda s, e: F.struct(F.when(s["open"] & e, s["n"] + 1).otherwise(s["n"]).alias("n"), (s["open"] & e).alias("open")),
        lambda s: s["n"])
    return F.when(n > 0, same).otherwise(0)


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit(END))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def mask(turns: Column) -> Column:
    """Spans ``start-end`` (code points of the rendered turns, end excluded)
    that the loss covers, joined by commas."""
    step = lambda s, t: F.struct(
        (s["at"] + F.char_length(_rendered(t))).alias("at"),
        F.when(t["role"] == TRAINED, F.concat(s["spans"], F.array(F.concat(
            (s["at"] + F.char_length(t["role"]) + 5).cast("string"), F.lit("-"),
            (s["at"] + F.char_length(_rendered(t)) - 1).cast("string"))))).otherwise(s["spans"]).alias("spans"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.aggregate(turns, start, step, lambda s: F.array_join(s["spans"], ","))


def formatted(pairs: DataFrame) -> DataFrame:
    """``id``, ``prompt_turns``, ``prompt`` and per side ``<side>`` (the
    completion) and ``<side>_mask``, from (``id``, ``chosen``, ``rejected``)."""
    empty = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    sides = pairs.select("id", F.coalesce("chosen", empty).alias("c"), F.coalesce("rejected", empty).alias("r")) \
        .withColumn("n", common_turns(F.col("c"), F.col("r")))
    after = lambda side: F.slice(F.col(side), F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))
    return sides.select("id", F.col("n").alias("prompt_turns"), render(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
                        render(after("c")).alias("chosen"), mask(after("c")).alias("chosen_mask"),
                        render(after("r")).alias("rejected"), mask(after("r")).alias("rejected_mask"))


def derived_pairs(turns: DataFrame) -> DataFrame:
    """Pairs from plain conversations: the chosen side is the conversation, the
    rejected one follows it up to an answer (the first one for odd ids, else
    the last) and answers with the last answer of the next conversation
    (descending id; after the last, the first). Without an answer the rejected
    side has all turns and that answer."""
    chats = conversations_of(turns).withColumn(
        "answers", F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED, i)), lambda i: i.isNotNull()))
    last = F.element_at("turns", F.try_element_at("answers", F.lit(-1)) + 1)["text"]
    chats = chats.withColumn("text", F.when(F.size("answers") > 0, last).otherwise(""))
    rows = with_next(chats, "id", "text").filter("guest = 0")
    until = F.when(F.size("answers") == 0, F.size("turns")) \
        .when(F.pmod("id", F.lit(2)) == 1, F.element_at("answers", 1)).otherwise(F.element_at("answers", -1))
    answer = F.array(F.struct(F.lit(None).cast("long").alias("turn"), F.lit(TRAINED).alias("role"),
                              F.coalesce("next_text", F.lit("")).alias("text")))
    rows = rows.withColumn("until", until)
    return rows.select("id", F.col("turns").alias("chosen"),
                       F.concat(F.slice("turns", F.lit(1), F.col("until")), answer).alias("rejected"))


def op8_preferences(spark, sf_dir: str) -> DataFrame:
    return formatted(derived_pairs(table(spark, sf_dir, "conversations"))).withColumnRenamed("id", "conv_id")


ORACLE = r"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i
  FROM (SELECT conv_id, turn,
               regexp_replace(regexp_replace(coalesce(role, 'unknown'), '<(\\*)\|', '<\\\1|', 'g'), '\|(\\*)>', '|\\\1>', 'g') AS role,
               regexp_replace(coalesce(text, ''), '<(\\*)\|', '<\\\1|', 'g') AS text
        FROM conversations)),
a AS (
  SELECT conv_id, count(*) AS n, min(CASE WHEN role = 'assistant' THEN i END) AS first_answer,
         max(CASE WHEN role = 'assistant' THEN i END) AS last_answer FROM t GROUP BY 1),
l AS (
  SELECT a.*, coalesce(t.text, '') AS answer FROM a LEFT JOIN t ON t.conv_id = a.conv_id AND t.i = a.last_answer),
x AS (
  SELECT conv_id, CASE WHEN last_answer IS NULL THEN n WHEN conv_id % 2 = 1 THEN first_answer ELSE last_answer END AS until, n,
         coalesce(lead(answer) OVER (ORDER BY conv_id DESC), first_value(answer) OVER (ORDER BY conv_id DESC)) AS answer
  FROM l),
own AS (
  SELECT x.*, x.until < x.n AND t.role = 'assistant' AND t.text = x.answer AS same
  FROM x LEFT JOIN t ON t.conv_id = x.conv_id AND t.i = x.until),
p AS (SELECT conv_id, until + CASE WHEN same THEN 1 ELSE 0 END AS k, coalesce(same, FALSE) AS same, answer FROM own),
r AS (
  SELECT t.conv_id, t.i, t.role, t.i < p.k AS prompt, '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10) AS shown
  FROM t JOIN p ON t.conv_id = p.conv_id),
o AS (
  SELECT *, sum(length(shown)) OVER (PARTITION BY conv_id, prompt ORDER BY i) - length(shown) AS place FROM r),
g AS (
  SELECT conv_id, coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE prompt), '') AS prompt,
         coalesce(string_agg(shown, '' ORDER BY i) FILTER (WHERE NOT prompt), '') AS chosen,
         coalesce(string_agg(CAST(CAST(place + length(role) + 5 AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(place + length(shown) - 1 AS BIGINT) AS VARCHAR), ',' ORDER BY i)
                  FILTER (WHERE NOT prompt AND role = 'assistant'), '') AS chosen_mask
  FROM o GROUP BY 1)
SELECT g.conv_id, CAST(p.k AS INTEGER) AS prompt_turns, g.prompt, g.chosen, g.chosen_mask,
       CASE WHEN same THEN '' ELSE '<|assistant|>' || chr(10) || p.answer || '<|end|>' || chr(10) END AS rejected,
       CASE WHEN same THEN '' ELSE '14-' || CAST(14 + length(p.answer) + 7 AS VARCHAR) END AS rejected_mask
FROM g JOIN p ON g.conv_id = p.conv_id
"""
