"""Stupid-backoff language-model scores of documents, from counts of all other documents.

The score of a word after another is the bigram's relative frequency, or ``BACKOFF`` times the word's
own relative frequency where no other document has the bigram (for a word that no other document has,
its count is taken as ``UNSEEN``). Counts leave the document itself out, so that a text is judged by
what the rest of the corpus says; the first word follows a mark for the beginning.

Documents are dealt into blocks of bounded size. A block's distinct n-grams, as sorted 64-bit hashes
with their counts, go to the partition of the count table that their leading bits name; there the
table's rows are formed (one for each n-gram, the counts of all blocks summed) and joined to the n-grams
asked for, and the totals go back to the block in the order asked, without the hashes. The block scores
its documents' n-grams with them and sums per document. An n-gram occurs once for each block at most,
so a frequent one makes no task large; blocks and table partitions grow in number with the input, not
in size (a single text is never split: it must fit in a task).

Null texts and texts without words have no words, score 0 and a null mean. Repeated rows are documents
of their own; an empty table gives an empty result."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import only
from riskspark.llm.text_hashes import mix, word_hashes

BACKOFF, UNSEEN = 0.4, 0.5
#: Bytes of text in a block, and in a partition of the count table the n-grams of so many bytes.
BLOCK_BYTES, TABLE_BYTES = 8_000_000, 8_000_000
#: Keys beside those of n-grams: the mark before a text, and the number of all words.
BEGIN, ALL = np.uint64(0x0B1A7E5EED), np.uint64(0x5EA15EA15EA1)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each word, and of each word with the one (or the mark) before it."""
    words = word_hashes(text)
    before = np.concatenate([[BEGIN], words[:-1]]) if len(words) else words
    return words, mix(before * np.uint64(3) + mix(words + np.uint64(1)))


class Block:
    """The documents of a block: sorted distinct ``keys`` with their ``counts`` (a text counts one mark, its
    words count for ALL), and each text's places of its words and pairs among the keys."""

    def __init__(self, texts: list[str | None]) -> None:
        found = [grams(t) for t in texts]
        words, pairs = [w for w, _ in found], [p for _, p in found]
        self.sizes = np.array([len(w) for w in words], np.int64)
        marks = np.array([BEGIN, ALL])
        self.keys, place, counts = np.unique(np.concatenate([marks, *words, *pairs]), return_inverse=True, return_counts=True)
        n = int(self.sizes.sum())
        self.begin, self.all = place[:2]
        self.words, self.pairs = place[2:2 + n], place[2 + n:]
        self.counts = counts
        self.counts[self.begin] = (self.sizes > 0).sum()
        self.counts[self.all] = n

    def scores(self, totals: np.ndarray) -> list[float]:
        """Sum of log scores of each text, given the corpus totals of the keys."""
        out, end = [], 0
        for n in self.sizes.tolist():
            word, pair = self.words[end:end + n], self.pairs[end:end + n]
            end += n
            out.append(log_score(word, pair, totals, self.begin, self.all) if n else 0.0)
        return out


def log_score(word: np.ndarray, pair: np.ndarray, totals: np.ndarray, begin: int, everything: int) -> float:
    """Sum of the log scores of one text's words, given as places among the keys."""

    def others(x: np.ndarray) -> np.ndarray:
        """Counts of x in all other documents."""
        _, back, times = np.unique(x, return_inverse=True, return_counts=True)
        return totals[x] - times[back]

    pairs, words = others(pair), others(word)
    context = np.concatenate([[totals[begin] - 1], words[:-1]])
    low = BACKOFF * np.where(words > 0, words, UNSEEN) / max(totals[everything] - len(word), 1)
    return float(np.log(np.where(pairs > 0, pairs / np.maximum(context, 1), low)).sum())


def packed(x: np.ndarray) -> bytes:
    """Integers as planes of bytes, which compress well where the high bytes are equal."""
    return np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).reshape(-1)


def scores(docs: DataFrame, block_bytes: int = BLOCK_BYTES, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``(doc_id, n_words, log_score, mean_log_score)`` of every document."""
    rows = only(docs, doc_id="bigint", text="string")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block_bytes + 1
    bits = max(0, int(size // table_bytes).bit_length())
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    def ask(block: pd.DataFrame) -> pd.DataFrame:
        b = Block(block["text"].tolist())
        keys, counts = b.keys, b.counts
        part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        spans = list(zip(edges[:-1], edges[1:]))
        return pd.DataFrame({"part": part[edges[:-1]], "block": block["block"].iloc[0],
                             "keys": [packed(np.diff(keys[i:j], prepend=np.uint64(0))) for i, j in spans],
                             "counts": [packed(counts[i:j]) for i, j in spans]})

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(unpacked(x), dtype=np.uint64) for x in part["keys"]]  # sent as differences
        counts = np.concatenate([unpacked(x) for x in part["counts"]])
        _, row = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(row, weights=counts).astype(np.int64)[row]
        ends = np.cumsum([len(k) for k in keys])[:-1]
        return pd.DataFrame({"block": part["block"], "part": part["part"], "totals": [packed(t) for t in np.split(totals, ends)]})

    def judge(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        b = Block(block["text"].tolist())
        totals = np.concatenate([unpacked(x) for x in answers.sort_values("part")["totals"]]).astype(np.int64)
        return pd.DataFrame({"doc_id": block["doc_id"].astype("Int64"), "n_words": b.sizes, "log_score": b.scores(totals)})

    requests = rows.groupBy("block").applyInPandas(ask, "part bigint, block bigint, keys binary, counts binary")
    replies = requests.groupBy("part").applyInPandas(answer, "block bigint, part bigint, totals binary")
    judged = rows.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(judge, "doc_id bigint, n_words bigint, log_score double")
    return judged.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))


def rounded(docs: DataFrame) -> DataFrame:
    """The query's rows: the scores with six decimals."""
    return scores(docs).select("doc_id", "n_words", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("log_score", "mean_log_score")])


ORACLE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS w FROM documents),
o AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, w FROM d),
g AS (SELECT doc_id, w[i] AS x, CASE WHEN i > 1 THEN w[i - 1] ELSE '' END AS b FROM o),
u AS (SELECT x, count(*) AS c FROM g GROUP BY x UNION ALL SELECT '', count(DISTINCT doc_id) FROM g),
ud AS (SELECT doc_id, x, count(*) AS c FROM g GROUP BY ALL UNION ALL SELECT DISTINCT doc_id, '', 1 FROM g),
p AS (SELECT b, x, count(*) AS c FROM g GROUP BY b, x),
pd AS (SELECT doc_id, b, x, count(*) AS c FROM g GROUP BY ALL),
n AS (SELECT count(*) AS n FROM g), nd AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
s AS (SELECT pd.doc_id, pd.c AS m, p.c - pd.c AS pair, u1.c - coalesce(d1.c, 0) AS context, u2.c - d2.c AS word, n.n - nd.n AS others
  FROM pd JOIN p USING (b, x) JOIN u AS u1 ON u1.x = pd.b JOIN ud AS d1 ON d1.doc_id = pd.doc_id AND d1.x = pd.b
  JOIN u AS u2 ON u2.x = pd.x JOIN ud AS d2 ON d2.doc_id = pd.doc_id AND d2.x = pd.x JOIN nd ON nd.doc_id = pd.doc_id, n),
t AS (SELECT doc_id, sum(m * ln(CASE WHEN pair > 0 THEN pair / greatest(context, 1)
  ELSE {BACKOFF} * (CASE WHEN word > 0 THEN word ELSE {UNSEEN} END) / greatest(others, 1) END)) AS l FROM s GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(l, 0.0), 6) AS log_score,
  CASE WHEN len(w) > 0 THEN round(l / len(w), 6) END AS mean_log_score FROM d LEFT JOIN t ON t.doc_id = d.doc_id
"""
