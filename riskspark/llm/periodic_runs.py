"""Periodic runs of words: maximal stretches with period q of at least max(12, 2 q) words.

Per document, texts are arrays of word numbers. Longest common extensions come from a difference
cover: a set of residues such that for any two places there is a shift below ``MODULUS`` that brings
both onto sampled places. Only sampled suffixes are sorted (first word by word, then by doubling, as far
as they still tie); the common prefixes of neighbours in that order stand in a sparse table. An
extension compares fewer than ``MODULUS`` words until both places are sampled, and takes the rest as one
range minimum. Extensions to the left use the same structure of the reversed words.

Runs are listed on a harmonic grid: a run with period p has at least max(12 - p, p) places that equal the
place p further on, so for every p it is enough to look at the places that are multiples of that number,
n / p for each p. A place whose word equals that p further on is extended in both directions; what is long
enough is a stretch with period p. A stretch found with several periods has the smallest as its own (the
others are multiples of it, and its ends are the same).

Documents of a batch are laid end to end, with a word of its own between two, and handled side by side
in arrays; a batch is cut into portions of about ``PORTION`` words, so memory follows the longest text.

Null and empty texts have no words, no runs and an empty collapsed text; repeated rows give repeated results;
further columns are ignored; an empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import WORD, only

#: A perfect difference set: each residue but 0 is the difference of one pair of its members (fixed values).
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)
#: Words of a run at least.
LEAST = 12
#: Words of a portion and grid places looked at together.
PORTION, PLACES = 250_000, 500_000

_SLOT = np.full(MODULUS, -1, np.int64)
_SLOT[list(COVER)] = np.arange(len(COVER))


def _shifts() -> np.ndarray:
    """shift[x, y]: the least d for which x + d and y + d are both in the cover."""
    covered = _SLOT >= 0
    d = np.arange(MODULUS)
    both = covered[(d[:, None, None] + d[None, None, :]) % MODULUS] & covered[(d[None, :, None] + d[None, None, :]) % MODULUS]
    return both.argmax(2)


_SHIFT = _shifts()


class Extensions:
    """Longest common extensions to the right between places of one document.

    ``words`` holds the documents end to end, each followed by a number that occurs nowhere else."""

    def __init__(self, words: np.ndarray, doc: np.ndarray, longest: int) -> None:
        self.words = words
        places = np.arange(len(words))
        places = places[_SLOT[places % MODULUS] >= 0]
        self.places = places
        index = np.full(-(-len(words) // MODULUS) * len(COVER) + len(COVER), -1, np.int64)
        index[places // MODULUS * len(COVER) + _SLOT[places % MODULUS]] = np.arange(len(places))
        self.index = index
        self._sort(doc, longest)

    def sample(self, at: np.ndarray) -> np.ndarray:
        """Number of the sampled place ``at`` among the sampled places."""
        return self.index[at // MODULUS * len(COVER) + _SLOT[at % MODULUS]]

    def _sort(self, doc: np.ndarray, longest: int) -> None:
        words, places = self.words.astype(np.int64), self.places
        n = len(places)
        span = int(words.max()) + 1 if n else 1
        rank = np.zeros(n, np.int64)  # of a suffix: how many are smaller than all that tie with it
        common = np.zeros(n + 1, np.int64)  # by rank: words shared with the suffix before
        tied = np.arange(n)

        def refine(key: np.ndarray, shared: int | None) -> np.ndarray:
            """Split the ties by a further key; returns those that are left."""
            nonlocal tied
            by = np.lexsort((key, rank[tied]))
            old, new, who = rank[tied][by], key[by], tied[by]
            start = np.ones(len(by), bool)
            start[1:] = old[1:] != old[:-1]
            cut = start.copy()
            cut[1:] |= new[1:] != new[:-1]
            at = np.arange(len(by))
            moved = old + at[cut][np.cumsum(cut) - 1] - at[start][np.cumsum(start) - 1]
            if shared is not None:
                common[moved[cut & ~start]] = shared
            rank[who] = moved
            size = np.diff(np.append(at[cut], len(by)))
            return who[np.repeat(size > 1, size)]

        if n:
            tied = refine(doc[places] * span + words[places], 0)
        step = 1
        while len(tied) and step < MODULUS:
            tied = refine(words[places[tied] + step], step)
            step += 1
        levels, open_ = [], tied
        while len(tied):  # ties share all words so far, so the place that many words on is in the same document
            levels.append(rank.copy())
            on = (MODULUS << (len(levels) - 1)) // MODULUS * MODULUS
            tied = refine(rank[self.sample(places[tied] + on)], None)
        self.rank = rank
        if len(open_):
            self._neighbours(common, open_, levels)
        # minima of 2 ** k neighbours, up to the samples of one document
        self.table = [common]
        k = 1
        while k <= longest // MODULUS * len(COVER) + 2 * len(COVER) and k < len(common):
            last = self.table[-1]
            nxt = last.copy()
            nxt[:-k] = np.minimum(last[:-k], last[k:])
            self.table.append(nxt)
            k *= 2
        self.table = np.stack(self.table)

    def _neighbours(self, common: np.ndarray, who: np.ndarray, levels: list[np.ndarray]) -> None:
        """Shared words of neighbours that tied on the first MODULUS words, by the ranks of each doubling."""
        order = np.empty(len(self.rank), np.int64)
        order[self.rank] = np.arange(len(self.rank))
        b = who[self.rank[who] > 0]
        a = order[self.rank[b] - 1]
        same = levels[0][a] == levels[0][b]
        a, b = self.places[a[same]], self.places[b[same]]
        at, got = self.rank[self.sample(b)], np.zeros(len(b), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            while True:
                x, y = self.sample(a + got), self.sample(b + got)
                equal = levels[k][x] == levels[k][y]
                if not equal.any():
                    break
                got[equal] += MODULUS << k
        left = np.arange(len(b))
        while len(left):
            left = left[self.words[a[left] + got[left]] == self.words[b[left] + got[left]]]
            got[left] += 1
        common[at] = got

    def between(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the suffixes at the places i and j (of one document, i != j) share."""
        out = np.zeros(len(i), np.int64)
        need = _SHIFT[i % MODULUS, j % MODULUS]
        left = np.arange(len(i))
        for k in range(MODULUS):
            if not len(left):
                break
            ready = need[left] == k
            if ready.any():
                at = left[ready]
                out[at] = k + self._minimum(self.rank[self.sample(i[at] + k)], self.rank[self.sample(j[at] + k)])
                left = left[~ready]
            left = left[self.words[i[left] + k] == self.words[j[left] + k]]
            out[left] = k + 1
        return out

    def _minimum(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        k = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        return np.minimum(self.table[k, low], self.table[k, high - (1 << k) + 1])


def runs(documents: list[np.ndarray], least: int = LEAST) -> list[np.ndarray]:
    """For each array of word numbers its runs, rows (start, length, period) by start, then period."""
    sizes = np.array([len(x) for x in documents], np.int64)
    none = np.zeros((0, 3), np.int64)
    if not len(sizes) or sizes.max() < least:
        return [none] * len(documents)
    top = max(int(x.max()) for x in documents if len(x)) + 1
    # a number of its own before, between and after the documents
    joined = np.concatenate([p for d, x in enumerate(documents) for p in (np.array([top + d]), x)] + [np.array([top + len(documents)])])
    first = np.cumsum(sizes + 1) - sizes  # place of each document's first word
    doc = np.append(np.repeat(np.arange(len(documents)), sizes + 1), len(documents))
    longest, n = int(sizes.max()), len(joined)
    right = Extensions(joined, doc, longest)
    leftward = Extensions(joined[::-1].copy(), doc[::-1].copy(), longest)
    # (document, period) pairs and the grid places of each
    periods = np.where(sizes >= least, sizes // 2, 0)
    of = np.repeat(np.arange(len(documents)), periods)
    period = np.arange(len(of)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = np.maximum(least - period, period)
    count = -(-(sizes[of] - period) // step)
    upto = np.cumsum(count)
    found = []
    at = 0
    while at < len(of):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PLACES, "right")))
        c = count[at:end]
        pair = np.repeat(np.arange(at, end), c)
        i = first[of[pair]] + (np.arange(len(pair)) - np.repeat(np.cumsum(c) - c, c)) * step[pair]
        hit = joined[i] == joined[i + period[pair]]
        pair, i = pair[hit], i[hit]
        j = i + period[pair]
        ahead, back = right.between(i, j), leftward.between(n - i, n - j)
        ok = ahead + back >= step[pair]
        pair, i = pair[ok], i[ok]
        found.append(np.stack([of[pair], i - back[ok] - first[of[pair]], ahead[ok] + back[ok] + period[pair], period[pair]]))
        at = end
    d, start, length, p = np.concatenate(found, axis=1)
    by = np.lexsort((p, length, start, d))
    d, start, length, p = d[by], start[by], length[by], p[by]
    new = np.ones(len(d), bool)  # the smallest period of each stretch
    new[1:] = (d[1:] != d[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    d, rows = d[new], np.stack([start, length, p], axis=1)[new]
    by = np.lexsort((rows[:, 2], rows[:, 0], d))
    d, rows = d[by], rows[by]
    edge = np.searchsorted(d, np.arange(len(documents) + 1))
    return [rows[edge[k]:edge[k + 1]] for k in range(len(documents))]


def collapsed(n: int, found: np.ndarray) -> np.ndarray | None:
    """Places that no run drops (None: all); a run drops what follows its first period."""
    if not len(found):
        return None
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, found[:, 0] + found[:, 2], 1)
    np.add.at(depth, found[:, 0] + found[:, 1], -1)
    return np.flatnonzero(np.cumsum(depth[:n]) == 0)


def portions(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Slices (from, to) of the rows of a batch with about PORTION words (a word has two bytes at least)."""
    begin = total = 0
    for k, x in enumerate(batch.column("text")):
        size = len(x.as_buffer() or b"") if x.is_valid else 0
        if k > begin and total + size > 6 * PORTION:
            yield begin, k
            begin, total = k, 0
        total += size
    if batch.num_rows > begin:
        yield begin, batch.num_rows


RESULT = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs(doc_id, text, offset, cycle)`` with ``n_words``, ``runs`` and the ``collapsed`` text (kept words joined by
    one space). Where ``cycle`` is not null, word i from ``offset`` on is first replaced by word
    offset + (i - offset) % cycle."""
    rows = only(docs, doc_id="bigint", text="string", offset="bigint", cycle="bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            for begin, end in portions(batch):
                part = batch.slice(begin, end - begin)
                number: dict[bytes, int] = {}
                words, documents = [], []
                for text, offset, cycle in zip(part.column("text"), part.column("offset").to_pylist(), part.column("cycle").to_pylist()):
                    w = text.as_buffer().to_pybytes().split() if text.is_valid else []
                    if cycle is not None and len(w):
                        w = w[:offset] + [w[offset + k % cycle] for k in range(len(w) - offset)]
                    words.append(w)
                    documents.append(np.array([number.setdefault(x, len(number)) for x in w], np.int64))
                found = runs(documents, least)
                texts = []
                for w, r in zip(words, found):
                    keep = collapsed(len(w), r)
                    texts.append(b" ".join(w if keep is None else [w[k] for k in keep.tolist()]))
                flat = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
                edge = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edge), pa.StructArray.from_arrays(
                    [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], fields=list(run_type)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(w) for w in words], pa.int64()), lists, pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, "doc_id bigint, " + RESULT)


def planted(docs: DataFrame) -> DataFrame:
    """The query's input: documents whose crc32 of the decimal doc_id is a multiple of 10 repeat a stretch of their
    words (rows without doc_id do not)."""
    rows = only(docs, doc_id="bigint", text="string")
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    n = F.when(h % 10 == 0, F.regexp_count("text", F.lit(WORD)).cast("bigint"))
    offset = F.when(n > 0, F.pmod(g, n))
    return rows.select("doc_id", "text", offset.alias("offset"), g.alias("g"), n.alias("n")).select(
        "doc_id", "text", "offset", (1 + F.floor((F.col("n") - F.col("offset")) / (3 + F.col("g") % 8))).alias("cycle"))


def digests(docs: DataFrame) -> DataFrame:
    """Columns of the query: number of runs, the longest one, digests of all runs and of the collapsed text."""
    found = periodic_runs(planted(docs))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return found.select("doc_id", "n_words", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256")).select(
        "doc_id", "n_words", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
