"""Quality rules, line first: every line is judged by punctuation, navigation and boilerplate rules,
failing lines are removed, and documents that lose too much of their text are rejected.

All of it is array and string functions of one row: no shuffle, no Python, and nothing depends on
other documents. Null text counts as the empty text: no words, base failed, not kept; its cleaned
text is null. Texts are judged whole; repeated rows give repeated results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import only

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: A line of text ends with one of these (closing quotes and brackets may follow a stop).
ENDED = r"[.!?:;…。！？][\x22\x27’”»)\]\x20\x09-\x0D]*\z"
#: Separators of menus and paths; a line with this many is navigation.
SEPARATORS, MANY_SEPARATORS = r"[|»›•·]", 3
#: A line with more than so many symbols for a hundred words is no prose.
MOST_SYMBOLS = 50
#: English words of menus (lines of other languages are judged by the other rules); they count in lines of up to so many words.
MENU, MENU_WORDS = (r"(?i)\b(?:home|menu|sitemap|log ?in|log ?out|sign ?in|sign ?up|register|subscribe|next page|previous page|"
                    r"back to top|read more|click here|share this|contact us|about us|skip to content)\b"), 10
BOILERPLATE = (r"(?i)\b(?:lorem ipsum|javascript|cookie policy|uses? cookies|accept cookies|privacy policy|terms of (?:use|service)|"
               r"all rights reserved|powered by|newsletter)\b|[{}]|©")
#: Least words of a text, and the most in per cent that repeated windows may hold.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Most in per cent of the words that failing lines may hold.
MOST_LOST = 50
WINDOW = 3


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def line_fails(line: Column) -> Column:
    """Whether a line is no running text; lines without a word do not fail."""
    n = F.size(words(line))
    return line.rlike(r"[^\x20\x09-\x0D]") & (
        ~line.rlike(ENDED)
        | (F.regexp_count(line, F.lit(SEPARATORS)) >= MANY_SEPARATORS)
        | (100 * F.regexp_count(line, F.lit(SYMBOLS)) > MOST_SYMBOLS * n)
        | (line.rlike(MENU) & (n <= MENU_WORDS))
        | line.rlike(BOILERPLATE))


def judge(docs: DataFrame, text: str = "text", out: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``out``: the base counts, ``lost_words`` (words in failing lines),
    ``cleaned`` (the text without failing lines), ``base_failed`` and ``kept``.

    Counts: n_words; word_chars (code points in words); n_symbols; n_dup_lines (lines with a word equal
    to an earlier line); n_repeat_words (words within a window of three words that the text holds
    twice or more). Windows are compared as 64-bit hashes, sorted with their positions, so that equal
    ones are neighbours: the work of a text of n words is n log n however often a window repeats."""
    t, w, ls, win, pos = (f"`__{out}_{x}`" for x in ("text", "words", "lines", "windows", "places"))
    name = lambda c: c.strip("`")
    d = docs.withColumn(name(t), F.coalesce(F.col(text), F.lit("")))
    d = d.withColumn(name(w), words(F.col(t))).withColumn(
        name(ls), F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    hashes = F.when(F.size(w) < WINDOW, F.array().cast("array<struct<h:bigint,p:int>>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW),
        lambda i: F.struct(F.xxhash64(*[F.get(F.col(w), i + k) for k in range(WINDOW)]).alias("h"), i.alias("p"))))
    d = d.withColumn(name(win), F.sort_array(hashes))
    twice = F.filter(F.col(win), lambda x, i: (F.get(F.col(win), i - 1)["h"] == x["h"]) | (F.get(F.col(win), i + 1)["h"] == x["h"]))
    d = d.withColumn(name(pos), F.sort_array(F.transform(twice, lambda x: x["p"])))
    covered = F.aggregate(
        F.transform(F.col(pos), lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col(pos), i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    lost = F.aggregate(F.filter(F.col(ls), line_fails), F.lit(0), lambda a, x: a + F.size(words(x)))
    long = lambda c: c.cast("bigint")
    counts = F.struct(
        long(F.size(w)).alias("n_words"), long(F.length(F.array_join(w, ""))).alias("word_chars"),
        long(F.regexp_count(F.col(t), F.lit(SYMBOLS))).alias("n_symbols"),
        long(F.size(ls) - F.size(F.array_distinct(ls))).alias("n_dup_lines"),
        long(covered).alias("n_repeat_words"), long(lost).alias("lost_words"))
    # The counts go through explode of a one-element array: a later filter on them would otherwise be
    # pushed below these projections and copy their expressions into one another, over and over.
    d = d.select(*[F.col(f"`{c}`") for c in docs.columns if c != out], F.explode(F.array(counts)).alias(out))
    q = lambda c: F.col(f"`{out}`.{c}")
    failed = (q("n_words") < LEAST_WORDS) | (100 * q("n_repeat_words") > MOST_REPEATED * q("n_words"))
    cleaned = F.array_join(F.filter(F.split(F.col(text), "\n"), lambda x: ~line_fails(x)), "\n")
    return d.withColumn(out, F.col(out).withField("base_failed", failed)
                        .withField("kept", ~failed & (100 * q("lost_words") <= MOST_LOST * q("n_words")))
                        .withField("cleaned", cleaned))


def keep(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, with their columns alone."""
    return judge(docs, text, "__quality").where("`__quality`.kept").select(*[F.col(f"`{c}`") for c in docs.columns])


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words", "base_failed", "kept"]


def verdicts(docs: DataFrame) -> DataFrame:
    """The query's rows: the counts and the verdict of every document."""
    return judge(only(docs, doc_id="bigint", text="string")).select("doc_id", *[f"quality.{c}" for c in COUNTS])


def _duck(pattern: str) -> str:
    """A pattern of this module as a DuckDB string: its escapes for characters become the characters."""
    import re

    out = re.sub(r"\\u([0-9A-F]{4})", lambda m: chr(int(m[1], 16)), pattern)
    return "'" + out.replace("'", "''") + "'"


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
tok AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
tri AS (SELECT doc_id, p, x, lead(x, 1) OVER q AS y, lead(x, 2) OVER q AS z FROM tok WINDOW q AS (PARTITION BY doc_id ORDER BY p)),
g AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, x, y, z) AS c FROM tri WHERE z IS NOT NULL),
cov AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM g, (SELECT unnest([0, 1, 2]) AS k) WHERE c >= 2 GROUP BY doc_id),
l AS (SELECT doc_id, unnest(ls) AS line FROM w),
bad AS (SELECT doc_id, CAST(sum(len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'))) AS BIGINT) AS n FROM l
  WHERE NOT regexp_matches(line, {_duck(ENDED)}) OR len(regexp_extract_all(line, {_duck(SEPARATORS)})) >= {MANY_SEPARATORS}
    OR 100 * len(regexp_extract_all(line, '{SYMBOLS}')) > {MOST_SYMBOLS} * len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'))
    OR (regexp_matches(line, {_duck(MENU)}) AND len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) <= {MENU_WORDS})
    OR regexp_matches(line, {_duck(BOILERPLATE)}) GROUP BY doc_id),
c AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '{SYMBOLS}')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, coalesce(bad.n, 0) AS lost_words
  FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN bad USING (doc_id))
SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words)
    AND 100 * lost_words <= {MOST_LOST} * n_words AS kept FROM c
"""
