"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns of the two conversations is rendered once, as the prompt; what
follows in either is its completion. The result has one row for each rendered turn of each part
(``prompt``, ``chosen``, ``rejected``), with the pieces of its rendering: a header, which is never
learned, and a body (text and end mark), learned in assistant turns of completions alone. So a
conversation of any length stays spread over rows and tasks; ``assemble`` joins the rows of a pair to
strings with mask spans, for a writer that wants whole records.

The prefix is found without gathering a conversation: turns of the two sides are aligned by place,
and the least place at which they differ is a minimum for each pair. Rows that repeat a turn exactly
are one turn; differing rows of one turn number stand in the order of role and text. Null roles are
rendered and compared as ``user``, null texts as empty. A pair whose conversations are equal has empty
completions, and no row for them; one without a common first turn has no prompt row. Empty tables give
an empty result, and further columns are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.common import only

#: The rendering of a turn: header, text, end (placeholders: role).
HEADER, END = "<|{role}|>\n", "<|end|>\n"
ASSISTANT = "assistant"


def turns(rows: DataFrame, key: str) -> DataFrame:
    """``(key, turn, k, role, text)``, once for each distinct turn; k orders rows of one turn number."""
    types = {key: "bigint", "turn": "bigint", "role": "string", "text": "string"}
    t = only(rows, **types).select(key, "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.where(f"`{key}` is not null and turn is not null").distinct()
    return t.withColumn("k", F.row_number().over(Window.partitionBy(key, "turn").orderBy("role", "text")))


def header(role: Column) -> Column:
    before, after = HEADER.split("{role}")
    return F.concat(F.lit(before), role, F.lit(after))


def preference(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``(pair_id, part, turn, k, role, header, body, learned)`` from the turns ``(pair_id, turn, role,
    text)`` of the chosen and rejected conversations of each pair."""
    a, b = (turns(x, "pair_id").select("pair_id", "turn", "k", F.struct("role", "text").alias(n))
            for x, n in ((chosen, "a"), (rejected, "b")))
    both = a.join(b, ["pair_id", "turn", "k"], "full_outer")
    place = F.struct("turn", "k")
    differs = ~F.col("a").eqNullSafe(F.col("b"))
    first = both.where(differs).groupBy("pair_id").agg(F.min(place).alias("first"))
    rows = both.join(first, "pair_id", "left").withColumn("common", F.col("first").isNull() | (place < F.col("first")))
    rendered = F.when(F.col("common"), F.array(F.struct(F.lit("prompt").alias("part"), F.col("a").alias("t")))).otherwise(
        F.filter(F.array(F.struct(F.lit("chosen").alias("part"), F.col("a").alias("t")),
                         F.struct(F.lit("rejected").alias("part"), F.col("b").alias("t"))), lambda x: x["t"].isNotNull()))
    out = rows.select("pair_id", "turn", "k", F.explode(rendered).alias("x"))
    return out.select("pair_id", "x.part", "turn", "k", "x.t.role", header(F.col("x.t.role")).alias("header"),
                      F.concat("x.t.text", F.lit(END)).alias("body"),
                      ((F.col("x.part") != "prompt") & (F.col("x.t.role") == ASSISTANT)).alias("learned"))


def assemble(rows: DataFrame) -> DataFrame:
    """``(pair_id, prompt, chosen, rejected, chosen_spans, rejected_spans)``: the strings, and the
    [begin, end) code point spans of each completion that are learned. A pair must fit in a task."""
    ordered = rows.groupBy("pair_id").pivot("part", ["prompt", "chosen", "rejected"]).agg(
        F.sort_array(F.collect_list(F.struct("turn", "k", "header", "body", "learned"))))

    def text(c: str) -> Column:
        return F.coalesce(F.array_join(F.transform(c, lambda x: F.concat(x["header"], x["body"])), ""), F.lit(""))

    def spans(c: str) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))

        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + F.length(x["header"])
            end = begin + F.length(x["body"])
            span = F.array(F.struct(begin.alias("begin"), end.alias("end")))
            return F.struct(end.alias("at"), F.when(x["learned"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

        return F.coalesce(F.aggregate(c, start, step, lambda acc: acc["spans"]), F.array().cast("array<struct<begin:int,end:int>>"))

    return ordered.select("pair_id", *[text(c).alias(c) for c in ("prompt", "chosen", "rejected")],
                          *[spans(c).alias(f"{c}_spans") for c in ("chosen", "rejected")])


def swapped_replies(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs from plain conversations: chosen is a conversation up to its last assistant turn;
    rejected has in place of that turn the last assistant turn of the neighbouring conversation (ids 2n
    and 2n + 1 are neighbours). Conversations without such a turn, or whose neighbour has none, have no
    rejected reply: they are chosen alone, up to their last assistant turn or whole."""
    t = turns(conversations, "conv_id").drop("k")
    last = t.where(F.col("role") == ASSISTANT).groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("reply"))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("reply.text").alias("wrong"))
    t = t.join(last.join(other, "conv_id", "left"), "conv_id", "left")
    t = t.where("reply is null or turn <= reply.turn")
    chosen = t.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    is_reply = (F.col("role") == ASSISTANT) & (F.col("turn") == F.col("reply.turn")) & (F.col("text") == F.col("reply.text"))
    rejected = t.where("wrong is not null").select(
        F.col("conv_id").alias("pair_id"), "turn", "role", F.when(is_reply, F.col("wrong")).otherwise(F.col("text")).alias("text"))
    return chosen, rejected


def pairs(conversations: DataFrame) -> DataFrame:
    """The query's rows: every rendered turn of the pairs made of all conversations."""
    return preference(*swapped_replies(conversations))


ORACLE = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
l AS (SELECT conv_id, turn AS rt, text AS rx FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) AS r
  FROM t WHERE role = '{ASSISTANT}') WHERE r = 1),
j AS (SELECT t.*, l.rt, l.rx, o.rx AS wrong FROM t LEFT JOIN l USING (conv_id)
  LEFT JOIN l AS o ON l.conv_id IS NOT NULL AND o.conv_id = xor(t.conv_id, 1) WHERE l.rt IS NULL OR t.turn <= l.rt),
a AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id, turn ORDER BY role, text) AS k FROM j),
b AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id, turn ORDER BY role, text) AS k FROM (
  SELECT DISTINCT conv_id, turn, role, CASE WHEN role = '{ASSISTANT}' AND turn = rt AND text = rx THEN wrong ELSE text END AS text
  FROM j WHERE wrong IS NOT NULL)),
f AS (SELECT coalesce(a.conv_id, b.conv_id) AS pair_id, coalesce(a.turn, b.turn) AS turn, coalesce(a.k, b.k) AS k,
    a.role AS ar, a.text AS ax, b.role AS br, b.text AS bx FROM a FULL JOIN b ON a.conv_id = b.conv_id AND a.turn = b.turn AND a.k = b.k),
d AS (SELECT pair_id, min(turn * 1000000 + k) AS first FROM f WHERE ar IS DISTINCT FROM br OR ax IS DISTINCT FROM bx GROUP BY pair_id),
p AS (SELECT f.*, d.first IS NULL OR f.turn * 1000000 + f.k < d.first AS common FROM f LEFT JOIN d USING (pair_id)),
r AS (SELECT pair_id, CASE WHEN common THEN 'prompt' ELSE 'chosen' END AS part, turn, k, ar AS role, ax AS text FROM p WHERE ar IS NOT NULL
  UNION ALL SELECT pair_id, 'rejected', turn, k, br, bx FROM p WHERE NOT common AND br IS NOT NULL)
SELECT pair_id, part, turn, CAST(k AS INTEGER) AS k, role, '<|' || role || '|>' || chr(10) AS header, text || '<|end|>' || chr(10) AS body,
  part != 'prompt' AND role = '{ASSISTANT}' AS learned FROM r
"""
