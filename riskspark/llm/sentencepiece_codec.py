"""SentencePiece encoding and decoding (merge-type vocabularies).

Encoding keeps an agenda of adjacent symbol pairs ordered by piece score, then by position: the best
pair is merged, pairs made stale by it are skipped, and its two new neighbour pairs enter the
agenda, until no pair is a piece. Symbols that are no piece fall back to their bytes.

No merge can span two characters that stand side by side in no piece, so a text is first cut
between such characters (for the usual vocabularies: before each word, at line ends and before some
marks). Each part is encoded on its own and kept in a bounded store, because words repeat (in Arrow
arrays: workers outlive the stage, and as many Python objects would take hundreds of MB of each); the
agendas of many short parts run side by side in arrays, a long part's agenda is a heap. Every
part that is encoded anew is checked against the sentencepiece library, a batch of parts at a time,
within the same Arrow batch; a difference raises an error. Decoding is the library's.

Null text is encoded as the empty text: no ids, empty decoded text. Texts are taken whole, one after
the other, so memory follows the longest text of a batch rather than the batch. Repeated rows give
repeated results; an empty table gives an empty result."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import only

SPACE = "▁"
#: Parts kept by a worker in each of two stores; a full store becomes the older one, from which used
#: parts are taken over again (results do not depend on it). Long parts fill a store at so many bytes of text.
PARTS_KEPT, BYTES_KEPT = 400_000, 1 << 25
#: Characters up to which a part is encoded together with others.
SHORT = 24
NEVER = float("inf")
#: Rows handed back at a time.
ROWS_OUT = 256


def proto_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a serialised protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at:at + size]
            at += size


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            parts = dict((n, dict(proto_fields(v))) for n, v in proto_fields(f.read()) if n in (2, 3))
        trainer, norm = parts.get(2, {}), parts.get(3, {})
        # fixed values of the model format: 2 is the merge type; flags default to true
        if trainer.get(3, 1) != 2 or trainer.get(24, 0):
            raise ValueError("only merge-type vocabularies with spaces before words are supported")
        if norm.get(1, b"identity") != b"identity" and norm.get(2):
            raise ValueError("only identity normalisation is supported")
        if norm.get(4, 1):
            raise ValueError("models that remove spaces are not supported")
        self.prefix = SPACE if norm.get(3, 1) else ""
        plain = [i for i in range(lib.vocab_size())
                 if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.ids = {lib.id_to_piece(i): i for i in plain}
        self.cost = {p: -lib.get_score(i) for p, i in self.ids.items() if len(p) > 1}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(lib.is_unknown(i) for i in self.bytes):
            raise ValueError("the vocabulary has no byte pieces to fall back to")
        beside = {p[i:i + 2] for p in self.cost for i in range(len(p) - 1)}
        self.beside = beside
        # a space mark follows nothing but space marks: then a text can be cut before each word
        words = all(set(p[:p.rindex(SPACE) + 1]) == {SPACE} for p in self.cost if SPACE in p)
        alone = "" if any("\n" in p for p in self.cost) else "\n"
        rest = f"[^{SPACE}{alone}]"
        # marks that follow no letter or digit inside a piece: a text can be cut before them too
        after = {b[1] for b in beside if re.match(r"\w", b[0]) and b[0] != SPACE}
        marks = "".join(re.escape(m) for m in ".,;:!?|)" if m not in after)
        stop = f"(?=[{marks}])" if marks else "(?!)"
        self.cut = re.compile(
            rf"{alone or '(?!)'}|{SPACE}+(?:[^\W_]+{stop}|{rest}*)|[^\W_]+{stop}|{rest}+" if words else "(?s).+")
        # the same as numbers: a symbol is a piece or a single character of one
        self.symbols = sorted({*self.ids, *chain.from_iterable(self.cost)})
        number = {p: i for i, p in enumerate(self.symbols)}
        self.n_symbols = len(self.symbols)
        self.symbol_ids = np.array([self.ids.get(p, -1) for p in self.symbols])
        chars = [p for p in self.symbols if len(p) == 1]
        self.char_codes, self.char_symbols = np.array([ord(p) for p in chars]), np.array([number[p] for p in chars])
        splits = sorted((number[p[:i]] * self.n_symbols + number[p[i:]], c, number[p]) for p, c in self.cost.items()
                        for i in range(1, len(p)) if p[:i] in number and p[i:] in number)
        self.pair_keys, self.pair_costs, self.pair_symbols = (np.array(x) for x in zip(*splits))
        self.kept: dict[str, tuple[int, ...]] = {}  # parts just encoded, until they are checked
        self.newer = self.older = self.nothing = pa.array([], pa.string()), pa.array([], pa.list_(pa.int32()))

    def subparts(self, part: str) -> list[str]:
        """The part, cut where no piece has the two characters side by side."""
        begin, out = 0, []
        for i, pair in enumerate(map(str.__add__, part, part[1:]), 1):
            if pair not in self.beside:
                out.append(part[begin:i])
                begin = i
        out.append(part[begin:])
        return out

    def agenda(self, text: str) -> list[int]:
        """Symbols of one long part: the agenda is a heap of (cost, position, size)."""
        cost, symbols, n = self.cost, list(text), len(text)
        todo = [(c, i, 2) for i in range(n - 1) if (c := cost.get(text[i:i + 2])) is not None]
        heapq.heapify(todo)
        ends = list(range(1, n + 1))  # where the symbol that begins here ends
        begins = list(range(n))  # where the symbol that ends with this character begins
        while todo:
            _, at, size = heapq.heappop(todo)
            mid = ends[at]
            if not symbols[at] or mid >= n or len(symbols[at]) + len(symbols[mid]) != size:
                continue  # stale: one of the two has been merged meanwhile
            end = at + size
            symbols[at], symbols[mid] = text[at:end], ""
            ends[at], begins[end - 1] = end, at
            if end < n and (c := cost.get(text[at:end + len(symbols[end])])) is not None:
                heapq.heappush(todo, (c, at, size + len(symbols[end])))
            if at and (c := cost.get(text[(b := begins[at - 1]):end])) is not None:
                heapq.heappush(todo, (c, b, end - b))
        return [i for s in symbols if s for i in self.named(s)]

    def named(self, symbol: str) -> list[int]:
        i = self.ids.get(symbol)
        return [self.bytes[b] for b in symbol.encode()] if i is None else [i]

    def agendas(self, parts: list[str]) -> list[list[int]]:
        """Ids of many short parts at once: one agenda each, held as the costs of its adjacent pairs
        in text order. Every round merges each agenda's first least pair and renews the two pairs
        beside it; a part without a pair left is done."""
        lens = np.fromiter(map(len, parts), np.int64, len(parts))
        code = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.char_codes, code), len(self.char_codes) - 1)
        sym = np.where(self.char_codes[at] == code, self.char_symbols[at], -1 - code)  # below 0: no piece has it
        owner = np.repeat(np.arange(len(parts)), lens)
        done: list[tuple[np.ndarray, np.ndarray]] = []

        def pair(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            key = np.where((left < 0) | (right < 0), -1, left * self.n_symbols + right)
            k = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            hit = self.pair_keys[k] == key
            return np.where(hit, self.pair_costs[k], NEVER), self.pair_symbols[k]

        n = len(sym)
        cost, to = np.full(n, NEVER), np.zeros(n, np.int64)  # of the pair that begins here
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        cost[inside], to[inside] = pair(sym[inside], sym[inside + 1])
        while len(sym):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.minimum.reduceat(cost, first)
            sizes = np.diff(np.r_[first, len(sym)])
            live = least < NEVER
            if not live.all():
                keep = np.repeat(live, sizes)
                done.append((owner[~keep], sym[~keep]))
                sym, owner, cost, to = sym[keep], owner[keep], cost[keep], to[keep]
                least, sizes = least[live], sizes[live]
                if not len(sym):
                    break
            best = np.flatnonzero(cost == np.repeat(least, sizes))
            best = best[np.r_[True, owner[best[1:]] != owner[best[:-1]]]]  # the first of each agenda
            sym[best] = to[best]
            keep = np.ones(len(sym), bool)
            keep[best + 1] = False
            spot = (np.cumsum(keep) - 1)[best]
            sym, owner, cost, to = sym[keep], owner[keep], cost[keep], to[keep]
            cost[spot] = NEVER
            for left in (spot, spot - 1):
                ok = left[(left >= 0) & (left + 1 < len(sym))]
                ok = ok[owner[ok] == owner[ok + 1]]
                cost[ok], to[ok] = pair(sym[ok], sym[ok + 1])
        owner, sym = np.concatenate([o for o, _ in done]), np.concatenate([s for _, s in done])
        order = np.argsort(owner, kind="stable")
        flat, bounds = sym[order], np.searchsorted(owner[order], np.arange(len(parts) + 1)).tolist()
        ids = np.where(flat >= 0, self.symbol_ids[np.maximum(flat, 0)], flat).tolist()
        out = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
        odd = np.zeros(len(parts), bool)
        odd[owner[(sym < 0) | (self.symbol_ids[np.maximum(sym, 0)] < 0)]] = True
        for k in np.flatnonzero(odd).tolist():  # with characters that are no piece: name them by their bytes
            symbols = flat[bounds[k]:bounds[k + 1]].tolist()
            out[k] = [i for s in symbols for i in self.named(self.symbols[s] if s >= 0 else chr(-1 - s))]
        return out

    def encode_parts(self, parts: list[str]) -> list[tuple[int, ...]]:
        short = [p for p in parts if len(p) <= SHORT]
        known = dict(zip(short, self.agendas(short))) if short else {}
        for p in parts:
            if len(p) > SHORT:
                known[p] = [i for s in self.subparts(p) for i in self.agenda(s)]
        return [tuple(known[p]) for p in parts]

    def check(self, parts: list[str]) -> None:
        """Raise unless the library gives the same ids for these parts.

        The library puts its prefix before a text: a part that begins with it is given without it,
        any other part after a line end, whose ids are known."""
        after = [not self.prefix or p[0] != SPACE or p == SPACE for p in parts]
        bare = [("\n" + p if a else p[1:]).replace(SPACE, " ") for p, a in zip(parts, after)]
        lead = len(self.library.encode("\n"))
        for p, a, ids in zip(parts, after, self.library.encode(bare, num_threads=1)):
            if tuple(ids[lead:] if a else ids) != self.kept[p]:
                raise AssertionError(f"ids differ from the library's: {p[:80]!r}")

    def ids_of(self, parts: pa.StringArray, check: bool) -> pa.ListArray:
        """Ids of distinct parts, from the stores or else encoded anew; they are in the newer store then."""
        if len(self.newer[0]) > PARTS_KEPT or self.newer[0].nbytes > BYTES_KEPT:
            self.newer, self.older = self.nothing, self.newer
        at = pc.index_in(parts, value_set=self.newer[0])
        lacking = pc.is_null(at)
        rest = parts.filter(lacking)
        if not len(rest):
            return self.newer[1].take(at)
        before = pc.index_in(rest, value_set=self.older[0])
        unseen = pc.is_null(before)
        if new := rest.filter(unseen).to_pylist():
            self.kept.update(zip(new, self.encode_parts(new)))
            if check:
                self.check(new)
        anew = pa.array([self.kept.pop(p) for p in new], pa.list_(pa.int32()))
        # rows of rest, of which some are in the older store and the others follow one another in anew
        place = pc.replace_with_mask(before, unseen, pa.array(np.arange(len(new), dtype=np.int32) + len(self.older[0])))
        ids = pa.concat_arrays([self.older[1], anew]).take(place)
        at = pc.replace_with_mask(at, lacking, pa.array(np.arange(len(rest), dtype=np.int32) + len(self.newer[0])))
        self.newer = pa.concat_arrays([self.newer[0], rest]), pa.concat_arrays([self.newer[1], ids])
        return self.newer[1].take(at)

    def encode_arrow(self, texts: list[str | None], check: bool = True) -> pa.ListArray:
        found = [self.cut.findall(self.prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        parts = pa.array(chain.from_iterable(found), pa.string()).dictionary_encode()
        ids = self.ids_of(parts.dictionary, check).take(parts.indices)
        edges = ids.offsets.take(pa.array(np.cumsum([0, *map(len, found)])))
        return pa.ListArray.from_arrays(edges, ids.values)

    def encode(self, texts: list[str | None], check: bool = True) -> list[list[int]]:
        return self.encode_arrow(texts, check).to_pylist()

    def decode(self, ids: list[list[int]]) -> list[str]:
        return [self.library.decode(i) if i else "" for i in ids]


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_decode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids array<int>, decoded string)`` of every row: the text's ids, and their decoding.

    ``model`` is a path that every executor has (an installed package's file). Rows are independent,
    so the work follows the input partitions and is repeated for a lost executor's rows alone."""
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                rows = batch.slice(at, ROWS_OUT)
                ids = c.encode_arrow(rows.column(1).to_pylist())
                decoded = pa.array((c.decode([i.values.to_numpy().tolist()])[0] for i in ids), pa.string())
                yield pa.RecordBatch.from_arrays([rows.column(0), ids, decoded], names=["key", "ids", "decoded"])
                del rows, ids, decoded
            del batch
            pa.default_memory_pool().release_unused()  # else a worker keeps the pages of its largest batches

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind.simpleString()}, ids array<int>, decoded string").withColumnRenamed("key", key)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """The query's rows: token count and digests of ids and decoded text."""
    out = encode_decode(only(docs, doc_id="bigint", text="string"), model)
    return out.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
