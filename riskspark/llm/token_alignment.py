"""Alignment of two tokenizers' ids over a corpus, each distinct text once.

Texts are shuffled by their full content and grouped with their multiplicity; a distinct text is
tokenised and aligned once, in Arrow batches. The byte offsets at which a token of either side ends cut
its tokens into groups, and a pair of tokens that end together is a link. Links are counted for the whole
corpus as (text, id pair) rows weighted by the multiplicity, pre-aggregated before the shuffle; each text then gets
the counts of its links by a join, and each document the measures of its text by another.

Both joins have hot keys (frequent pairs, frequent texts). Keys above a share of 1 / HOT of all rows are fewer than
HOT, whatever the corpus, so these are broadcast; no other key holds more than that share, so the rest is
shuffled. The highest count of each id of the second side is a table as long as its vocabulary.

Neither tokenizer joins across a single space between two characters that are no white space (the first takes the
space into the next token; the second marks it, and no piece holds a mark after another character, which is checked
when it is loaded). So texts are cut there, and the distinct cuts of a portion of texts are encoded once, because words repeat. A cut
whose token bytes differ from its own sends the whole text through both tokenizers uncut, so the verdict on a text is
always the tokenizers' own.

Null and empty texts, and texts whose joined token bytes on either side differ from a space and the text, have no
tokens: zeros and an empty digest. Repeated rows count as often as they stand in the table and get equal rows; so do
rows without doc_id. Further columns are ignored; an empty table gives an empty result."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import Stash, only

MARK = "▁"
#: White space here is a superset of what the first tokenizer takes for white space.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Cuts joined for one call, texts aligned together by their bytes, and broadcast keys at most.
CUTS_AT_ONCE, BYTES_AT_ONCE, HOT = 2_000, 5_000_000, 100_000
#: An id pair as one number: a * ID_SPAN + b.
ID_SPAN = 1 << 32


def byte_alphabet() -> dict[str, int]:
    """Character to byte of byte-level vocabularies (fixed values: printable characters stand for themselves, the
    others follow from U+0100 on in byte order)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """The two tokenizers with the bytes of their entries."""

    def __init__(self, first: str, second: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        self.a_bytes = {i: bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode()
                        for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.b = lib = sentencepiece.SentencePieceProcessor(model_file=second)
        self.b_bytes = {}
        for i in range(lib.vocab_size()):
            piece = lib.id_to_piece(i)
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} joins words")
            self.b_bytes[i] = bytes([int(piece[3:5], 16)]) if lib.is_byte(i) else piece.replace(MARK, " ").encode()
        if b"" in self.a_bytes.values() or b"" in self.b_bytes.values():
            raise ValueError("an entry without bytes")
        self.a_sizes, self.b_sizes = (np.array([len(x[i]) for i in range(max(x) + 1)], np.int64) for x in (self.a_bytes, self.b_bytes))
        # ids as text with what follows: 2 * id in its group, 2 * id + 1 at the end of its side; B after A
        self.written = [t for k, x in enumerate((self.a_sizes, self.b_sizes)) for i in range(len(x)) for t in (f"{i},", f"{i}{'|;'[k]}")]
        self.written_sizes = np.array([len(t) for t in self.written], np.int64)

    def align(self, texts: list[str]) -> list[tuple | None]:
        """For each text (n_a, n_b, groups as text, id pairs of the links), None if its bytes differ."""
        first = self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        second = self.b.encode(texts, num_threads=1)
        return [self._one(t, x.ids, y) for t, x, y in zip(texts, first, second)]

    def _one(self, text: str, a: list[int], b: list[int]) -> tuple | None:
        whole = b" " + text.encode()
        x, y = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if b"".join(x) != whole or b"".join(y) != whole:
            return None
        groups, links = [], []
        at_a = at_b = begin_a = begin_b = i = j = 0
        while i < len(a):
            at_a += len(x[i])
            i += 1
            while at_b < at_a:
                at_b += len(y[j])
                j += 1
            if at_a == at_b:
                groups.append(",".join(map(str, a[begin_a:i])) + "|" + ",".join(map(str, b[begin_b:j])))
                links.append(a[i - 1] * ID_SPAN + b[j - 1])
                begin_a, begin_b = i, j
        return len(a), len(b), ";".join(groups), links

    def cuts(self, cuts: list[str]) -> Aligned:
        """Alignment of distinct cuts, many in one call of each tokenizer: joined by single spaces they are a text that falls
        into them again. If the bytes of a call differ from its text, its cuts are taken one by one."""
        out = [self._joined(cuts[at:at + CUTS_AT_ONCE]) for at in range(0, len(cuts), CUTS_AT_ONCE)]
        return Aligned(*(np.concatenate([getattr(x, f) for x in out]) for f in ("valid", "n_a", "n_b", "n_links", "links")),
                       [t for x in out for t in x.groups])

    def _joined(self, cuts: list[str]) -> Aligned:
        text = " ".join(cuts)
        whole = b" " + text.encode()
        a = np.array(self.a.encode_batch([" " + text], add_special_tokens=False)[0].ids, np.int64)
        b = np.array(self.b.encode(text), np.int64)
        if b"".join([self.a_bytes[i] for i in a.tolist()]) != whole or b"".join([self.b_bytes[i] for i in b.tolist()]) != whole:
            return self._singly(cuts)
        end_a, end_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        cut_end = np.cumsum([len(c.encode()) + 1 for c in cuts])
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        last_a, last_b = np.searchsorted(end_a, both), np.searchsorted(end_b, both)
        if not np.array_equal(both[np.searchsorted(both, cut_end)], cut_end):
            raise AssertionError("a token reaches over the end of a cut")
        # texts of the tokens in the order A and B of each group, with what follows each
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        ends_a, ends_b = np.isin(end_a, both, assume_unique=True), np.isin(end_b, both, assume_unique=True)
        before_b = np.concatenate([[0], last_b + 1])[group_a]
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + before_b] = 2 * a + ends_a
        order[np.arange(len(b)) + last_a[group_b] + 1] = 2 * (len(self.a_sizes) + b) + ends_b
        large = "".join([self.written[k] for k in order.tolist()])
        upto = np.cumsum(self.written_sizes[order])
        first, after = np.searchsorted(end_a, cut_end), np.searchsorted(end_b, cut_end)
        stop = upto[first + after + 1].tolist()
        groups = [large[x:y] for x, y in zip([0, *stop], stop)]
        per = np.searchsorted(both, cut_end, "right")
        return Aligned(np.ones(len(cuts), bool), np.diff(first + 1, prepend=0), np.diff(after + 1, prepend=0), np.diff(per, prepend=0),
                       a[last_a] * ID_SPAN + b[last_b], groups)

    def _singly(self, cuts: list[str]) -> Aligned:
        found = self.align(cuts)
        got = [r or (0, 0, "", []) for r in found]
        return Aligned(np.array([r is not None for r in found]), *(np.array(x, np.int64) for x in (
            [r[0] for r in got], [r[1] for r in got], [len(r[3]) for r in got], [p for r in got for p in r[3]])), [r[2] + ";" for r in got])

    def texts(self, texts: list[str]) -> Aligned:
        """Alignment of texts by their cuts; a text with a cut that is not valid goes through both tokenizers whole."""
        parts = [CUT.split(t) for t in texts]
        number: dict[str, int] = {}
        index = np.array([number.setdefault(c, len(number)) for p in parts for c in p], np.int64)
        # white space at an end of a text, or the mark, changes what such a cut would be joined to
        odd = [c for c in number if MARK in c or c[0].isspace() or c[-1].isspace()]
        apart = set(odd)
        plain = [c for c in number if c not in apart]
        found = self.cuts(plain) if plain else None
        if odd:
            alone = self._singly(odd)
            found = alone if found is None else Aligned(*(np.concatenate([getattr(found, f), getattr(alone, f)]) for f in (
                "valid", "n_a", "n_b", "n_links", "links")), found.groups + alone.groups)
            place = np.empty(len(number), np.int64)
            place[[number[c] for c in (*plain, *odd)]] = np.arange(len(number))
            index = place[index]
        many = np.array([len(p) for p in parts], np.int64)
        begin = np.cumsum(many) - many
        n_a, n_b, valid = (np.add.reduceat(x[index], begin) for x in (found.n_a, found.n_b, found.valid.astype(np.int64)))
        of = np.repeat(np.arange(len(texts)), many)
        start = np.cumsum(found.n_links) - found.n_links
        n = found.n_links[index]
        links = found.links[np.repeat(start[index] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        n_links = np.bincount(of, weights=n, minlength=len(texts)).astype(np.int64)
        at = index.tolist()
        groups = ["".join([found.groups[k] for k in at[x:x + m]])[:-1] for x, m in zip(begin.tolist(), many.tolist())]
        out = Aligned(valid == many, n_a, n_b, n_links, links, groups)
        return out if out.valid.all() else self._whole(out, texts)

    def _whole(self, found: Aligned, texts: list[str]) -> Aligned:
        bad = np.flatnonzero(~found.valid)
        again = self._singly([texts[i] for i in bad])
        links = np.split(found.links, np.cumsum(found.n_links)[:-1])
        for k, (i, own) in enumerate(zip(bad, np.split(again.links, np.cumsum(again.n_links)[:-1]))):
            for f in ("valid", "n_a", "n_b", "n_links"):
                getattr(found, f)[i] = getattr(again, f)[k]
            links[i], found.groups[i] = own, again.groups[k][:-1]
        return Aligned(found.valid, found.n_a, found.n_b, found.n_links, np.concatenate(links), found.groups)


@dataclass
class Aligned:
    """Of cuts or texts: whether their bytes are their own, numbers of tokens and links, the id pairs of all links one after
    the other, and the groups as text."""

    valid: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_links: np.ndarray
    links: np.ndarray
    groups: list[str]


@lru_cache(maxsize=2)
def loaded(first: str, second: str) -> Pair:
    return Pair(first, second)


ALIGNED = ("key binary, times bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
           "pairs array<bigint>, counts array<int>")


def aligned_texts(texts: DataFrame, first: str, second: str) -> DataFrame:
    """``texts(key, text, times)``, distinct, with counts, digest of the groups, and the distinct id pairs of the links with
    how many links each has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = loaded(first, second)
        for batch in batches:
            size = np.array([len(x.as_buffer()) for x in batch.column(1)], np.int64)
            portion = (np.cumsum(size) - size) // BYTES_AT_ONCE
            edge = [*np.flatnonzero(np.diff(portion, prepend=-1)).tolist(), batch.num_rows]
            for begin, end in zip(edge, edge[1:]):
                part = batch.slice(begin, end - begin)
                got = pair.texts(part.column(1).to_pylist())
                ids, place = np.unique(got.links, return_inverse=True)
                # a text's pairs with how often it has each: one sort of all (text, pair) of the portion
                of = np.repeat(np.arange(part.num_rows), got.n_links)
                held, counts = np.unique(of * max(1, len(ids)) + place, return_counts=True)
                edge_of = np.searchsorted(held, np.arange(part.num_rows + 1) * max(1, len(ids)))
                lists = pa.array(edge_of.astype(np.int32))
                digest = [hashlib.sha256(g.encode()).hexdigest() if ok else "" for g, ok in zip(got.groups, got.valid.tolist())]
                n = [np.where(got.valid, x, 0) for x in (got.n_a, got.n_b, got.n_links, got.n_links)]
                # ends of two rising rows of places meet at most once, so groups and links are as many
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), *map(pa.array, n), pa.array(digest, pa.string()),
                     pa.ListArray.from_arrays(lists, pa.array(ids[held % max(1, len(ids))] if len(ids) else ids)),
                     pa.ListArray.from_arrays(lists, pa.array(counts.astype(np.int32)))],
                    names=["key", "times", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "counts"])

    return texts.select("key", "text", "times").mapInArrow(run, ALIGNED)


def join_hot(rows: DataFrame, table: DataFrame, on: str, weight: str, stash: Stash, hot: int = HOT) -> DataFrame:
    """Inner join of ``rows`` with ``table``, whose ``on`` is distinct and whose ``weight`` says how many rows a key has. Keys
    with more than 1 / hot of all rows (fewer than ``hot`` keys) are broadcast, the others shuffled."""
    total = table.agg(F.sum(weight)).first()[0] or 0
    often = F.broadcast(table.where(F.col(weight) * hot > total))
    seldom = table.where(F.col(weight) * hot <= total)
    rest = rows.join(often.select(on), on, "left_anti").join(seldom, on)
    return rows.join(often, on).unionByName(rest)


def alignment(docs: DataFrame, first: str, second: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, texts, pairs): ``documents(doc_id, key)`` with a digest of the text (null without one);
    ``texts`` with the measures of each distinct text; ``pairs(pair, a, b, links, best)`` of the corpus."""
    stash = Stash(docs.sparkSession, "align")
    rows = only(docs, doc_id="bigint", text="string")
    text = F.when(F.col("text") != "", F.col("text"))
    keyed = stash.put(rows.select("doc_id", F.unhex(F.sha2(text, 256)).alias("key")))
    distinct = rows.where("text != ''").groupBy("text").agg(F.count("*").alias("times")).select(
        F.unhex(F.sha2("text", 256)).alias("key"), "text", "times")
    aligned = stash.put(aligned_texts(distinct, first, second))
    flat = aligned.select("key", "times", F.inline(F.arrays_zip("pairs", "counts"))).withColumnRenamed("pairs", "pair")
    links = stash.put(flat.groupBy("pair").agg(F.sum(F.col("counts") * F.col("times")).alias("links"), F.count("*").alias("rows")))
    b = F.pmod(F.col("pair"), F.lit(ID_SPAN))
    highest = links.groupBy(b.alias("b")).agg(F.max("links").alias("highest"))  # as long as a vocabulary
    pairs = stash.put(links.withColumn("b", b).join(F.broadcast(highest), "b").select(
        "pair", F.floor(F.col("pair") / ID_SPAN).alias("a"), "b", "links", "rows", (F.col("links") == F.col("highest")).alias("best")))
    met = join_hot(flat.select("key", "pair", "counts"), pairs.select("pair", "links", "best", "rows"), "pair", "rows", stash)
    sums = met.groupBy("key").agg(F.sum(F.col("counts") * F.col("links")).alias("count_sum"),
                                  F.sum(F.when(F.col("best"), F.col("counts")).otherwise(0)).alias("n_best"))
    texts = stash.put(aligned.drop("pairs", "counts").join(sums, "key", "left"))
    stash.drop(aligned)
    stash.drop(links)
    return keyed, texts, pairs


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def digests(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Measures of every document (columns of the query)."""
    keyed, texts, _ = alignment(docs, first, second)
    with_text = join_hot(keyed.where("key is not null"), texts, "key", "times", Stash(docs.sparkSession, "align"))
    measured = with_text.select("doc_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in MEASURES], "groups_sha256")
    without = keyed.where("key is null").select("doc_id", *[F.lit(0).cast("bigint").alias(c) for c in MEASURES], F.lit("").alias("groups_sha256"))
    return measured.unionByName(without)
