"""Benchmark decontamination: CGK walks and bit-sampling LSH find the items of a window, the edit distance confirms.

Texts are compared with A-Z in lower case and white space runs as one space. An item of L bytes leaks into a document
if some part of it is within ``rate * L`` edits of the whole item.

* *Windows.* Of the L // 8 eight-byte pieces of an item, all but one an edit survive, on diagonals that differ by the
  edits at most. A position of a document is the start of a window if any item at all has enough of its pieces on the
  diagonals from there on; this count loses no window within the radius, and doesn't say which item it holds. Items too
  short for that have shorter pieces, one more than edits.
* *Parts.* An item is cut, from its first byte to its last, into parts of about ``PART`` bytes. Edits may crowd anywhere,
  but not in all parts: some part has no more than its share of them. So every part of an item is embedded, and every
  part of a window: where its own pieces, or the ones before it, say that it begins, and a byte aside.
* *Embedding.* A CGK walk reads a part byte by byte, and at each step stays or goes on, as a random bit for step and
  byte says. Walks over strings within few edits fall into step again, so that most of what they read agrees: edit
  distance becomes Hamming distance. Over long strings with edits by the hundred walks lose each other, which is why
  items are cut; ``STEPS`` steps go through a part.
* *Tables.* Each of ``TABLES`` tables of each of ``WALKS`` walks samples ``SAMPLED`` steps; a part of a window is looked
  up in all of them, among the parts of the items of all lengths. The numbers were measured: at the radius, with
  insertions, deletions, substitutions or all of them, and no window filter before, the first part alone finds 0.97 at
  least of the items of 10 to 2500 bytes (``tests/llm/test_operators.py``, where others have all edits at one end).
* *Verification.* The least edit distance of an item to any stretch of the windows in which one of its parts was found,
  by bit-parallel dynamic programming over the whole item, unless more of its pieces are gone than edits could take.
"""

from __future__ import annotations

import bisect
import functools
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import U64, bytes_of, chunks, hand_back, mix64, table
from graphloom.llm.packed import loads

RATE, PIECE = 0.1, 8
#: Bytes of items that one pass over the documents takes.
ITEM_BLOCK = 8 << 20
_TABLE_BITS = 22
#: Walks, tables of a walk, steps that a table samples, and steps of a walk.
WALKS, TABLES, SAMPLED, STEPS = 32, 16, 7, 120
#: Bytes of a part of an item, which the steps of a walk go through.
PART = 64
#: Bytes beside the start of a part where it is looked up, too.
ASIDE = 1
#: Parts that are embedded together.
EMBEDDED = 4096


def plain(text: bytes | None) -> bytes:
    return b" ".join((text or b"").lower().split())


def infix_distance(item: bytes, text: bytes) -> tuple[int, int]:
    """Least edit distance of the whole item to a part of the text, and the end of the first such part."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[int, int] = {}
    for k, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << k
    plus, minus, score, best, end = full, 0, m, m, 0
    for k, c in enumerate(text):
        eq = where.get(c, 0)
        x = eq | minus
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        score += bool(up & top) - bool(down & top)
        up = up << 1 & full  # no 1 enters below: a match may begin anywhere
        down = down << 1 & full
        plus = (down | ~(x | up)) & full
        minus = up & x
        if score < best:
            best, end = score, k + 1
    return best, end


def cuts(size: int) -> list[int]:
    """Where the parts of an item begin: of like lengths, on whole pieces."""
    n = max(1, -(-size // PART))
    return [k * (size // PIECE) // n * PIECE for k in range(n)]


class Index:
    """Pieces of a block of items, sorted, with tables of bits that turn most positions down at once.

    Pieces have eight bytes, but those of an item too short for one of them to survive all edits are shorter, and one
    more than edits. Items are searched by width of their pieces.
    """

    def __init__(self, items: list[tuple[int, bytes]], rate: float) -> None:
        self.items = [(i, t) for i, t in items if t]
        self.edits = np.array([int(rate * len(t)) for _, t in self.items], np.int64)
        sizes = np.array([len(t) for _, t in self.items], np.int64)
        width = np.where(sizes // PIECE > self.edits, PIECE, np.maximum(sizes // (self.edits + 1), 1))
        self.need = np.maximum(sizes // width - self.edits, 1)
        self.cuts = [cuts(n) for n in sizes.tolist()]
        self.pieces = [[t[o : o + w] for o in range(0, len(t) - w + 1, w)] for (_, t), w in zip(self.items, width.tolist(), strict=True)]
        self.parts = [self._pieces(w, np.flatnonzero(width == w).tolist()) for w in sorted(set(width.tolist()))]

    def _pieces(self, width: int, chosen: list[int]) -> tuple:
        entries = [(int.from_bytes(self.items[k][1][o : o + width], "little"), k, o) for k in chosen for o in range(0, len(self.items[k][1]) - width + 1, width)]
        entries.sort()
        value = np.array([e[0] for e in entries], U64)
        bits = np.zeros(1 << _TABLE_BITS, bool)
        bits[self.slot(value)] = True
        part = [bisect.bisect_right(self.cuts[k], o) for _, k, o in entries]
        own = np.array([self.cuts[k][p - 1] for (_, k, _), p in zip(entries, part, strict=True)], np.int64)
        behind = np.array([self.cuts[k][min(p, len(self.cuts[k]) - 1)] for (_, k, _), p in zip(entries, part, strict=True)], np.int64)
        return width, value, np.array([e[1] for e in entries], np.int64), np.array([e[2] for e in entries], np.int64), own, behind, bits

    def may_hold(self, text: bytes, item: int) -> bool:
        """Are no more of the item's pieces gone than edits could take? If not, the text can't hold the item."""
        gone = int(self.edits[item])
        for piece in self.pieces[item]:
            if piece not in text:
                gone -= 1
                if gone < 0:
                    return False
        return True

    @staticmethod
    def slot(x: np.ndarray) -> np.ndarray:
        return (x * U64(0x9E3779B97F4A7C15)) >> U64(64 - _TABLE_BITS)

    def starts(self, packed: bytes, begins: np.ndarray) -> np.ndarray:
        """Where parts of windows begin that may hold an item, ``ASIDE`` bytes more or less, in ascending order."""
        if not len(packed) or not self.items:
            return np.zeros(0, np.int64)
        whole = loads(packed + bytes(PIECE - 1))
        found = np.unique(np.concatenate([self._starts(whole, begins, *part) for part in self.parts]))
        doc = np.searchsorted(begins, found, "right") - 1
        ends = np.append(begins[1:] - 1, len(packed))
        places = np.clip(found[:, None] + np.arange(-ASIDE, ASIDE + 1), begins[doc][:, None], (ends[doc] - 1)[:, None])
        return np.unique(places)

    def _starts(self, whole: np.ndarray, begins: np.ndarray, width: int, value: np.ndarray, owner: np.ndarray, offset: np.ndarray, own_cut: np.ndarray, next_cut: np.ndarray, bits: np.ndarray) -> np.ndarray:
        own = whole & U64((1 << 8 * width) - 1) if width < PIECE else whole
        hits = np.flatnonzero(bits[self.slot(own)])
        low, high = np.searchsorted(value, own[hits]), np.searchsorted(value, own[hits], "right")
        n = high - low
        at = np.repeat(hits, n)
        entry = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if not len(at):
            return at
        doc, item = np.searchsorted(begins, at, "right") - 1, owner[entry]
        diagonal = at - offset[entry]
        order = np.lexsort((diagonal, item, doc))
        doc, item, diagonal, entry = doc[order], item[order], diagonal[order], entry[order]
        wide = 4 * len(whole) + 4 * int(self.edits.max()) + 4 * max(len(t) for _, t in self.items)
        group = np.cumsum(np.append(False, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])))
        line = group * wide + diagonal
        behind = np.searchsorted(line, line + self.edits[item], "right")
        good = np.flatnonzero(behind - np.arange(len(line)) >= self.need[item])
        edge = np.bincount(good, minlength=len(line) + 1) - np.bincount(behind[good], minlength=len(line) + 1)
        good = np.cumsum(edge[:-1]) > 0  # all that such a count counted: the first piece left may be on any diagonal
        doc, diagonal, entry = doc[good], diagonal[good], entry[good]
        ends = np.append(begins[1:] - 1, len(whole))
        places = np.concatenate([diagonal + own_cut[entry], diagonal + next_cut[entry]])
        return np.clip(places, np.tile(begins[doc], 2), np.tile(ends[doc] - 1, 2))


_STAY_OR_GO = (mix64(np.arange(WALKS * STEPS * 256, dtype=U64) + U64(0x632BE59BD9B4E019)) >> U64(63)).astype(np.uint8).reshape(WALKS, STEPS, 256)


def embed(strings: np.ndarray) -> np.ndarray:
    """What the walks read of strings, given as rows of ``STEPS`` bytes: (step, walk, string)."""
    n = len(strings)
    at = np.tile(np.arange(n, dtype=np.int64) * STEPS, (WALKS, 1))
    flat, walk = strings.reshape(-1), np.arange(WALKS)[:, None] * (STEPS * 256)
    moves = _STAY_OR_GO.reshape(-1)
    out = np.empty((STEPS, WALKS, n), np.uint8)
    for k in range(STEPS):
        c = flat[at]
        out[k] = c
        at += moves[walk + (k * 256 + c.astype(np.int64))]
    return out


class Tables:
    """Bit-sampling tables of the walks over all parts of items. Parts of like lengths sample the same steps, within
    their reach."""

    def __init__(self, items: list[bytes]) -> None:
        parts = [(k, a, b) for k, t in enumerate(items) for a, b in itertools.pairwise([*cuts(len(t)), len(t)])]
        self.item, self.cut = np.array([p[:2] for p in parts], np.int64).reshape(-1, 2).T
        reach = np.array([min(b - a, STEPS) if b - a < 16 else min((b - a) * 9 // 5, STEPS) for _, a, b in parts], np.int64)
        grid = np.unique(np.minimum(np.geomspace(1, STEPS, 26).round().astype(np.int64), STEPS))
        reach = grid[np.searchsorted(grid, reach, "right") - 1]
        rows = np.array([list(items[k][a : a + STEPS].ljust(STEPS, b"\0")) for k, a, _ in parts], np.uint8).reshape(len(parts), STEPS)
        self.classes = []
        for r in sorted(set(reach.tolist())):
            own = np.flatnonzero(reach == r)
            steps = np.random.default_rng(r).integers(0, r, (WALKS, TABLES, SAMPLED))
            keys = np.concatenate([self.keys(embed(rows[own[a : a + EMBEDDED]]), steps) for a in range(0, len(own), EMBEDDED)], axis=1)
            order = np.argsort(keys, axis=1, kind="stable")
            self.classes.append((steps, np.take_along_axis(keys, order, axis=1), own[order]))

    @staticmethod
    def keys(read: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """(table, string): the sampled bytes of each string as one number, which has room for eight."""
        out = np.zeros((WALKS, steps.shape[1], read.shape[2]), U64)
        walk = np.arange(WALKS)[:, None]
        for k in range(steps.shape[2]):
            out = out << U64(8) | read[steps[:, :, k], walk]
        return out.reshape(-1, read.shape[2])

    def find(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(string, part) where some table has both."""
        found = []
        read = embed(strings)
        for steps, known, owner in self.classes:
            for at, (mine, keys) in enumerate(zip(self.keys(read, steps), known, strict=True)):
                low, high = np.searchsorted(keys, mine), np.searchsorted(keys, mine, "right")
                hit = np.flatnonzero(high > low)
                if len(hit):
                    n = high[hit] - low[hit]
                    place = np.repeat(low[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    found.append(np.unique(np.repeat(hit, n) << 32 | owner[at, place]))
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return pairs >> 32, pairs & 0xFFFFFFFF


_ONE_TEXT = np.zeros(1, np.int64)


def retrieve(tables: Tables, packed: bytes, starts: np.ndarray, begins: np.ndarray = _ONE_TEXT) -> tuple[np.ndarray, np.ndarray]:
    """(start, item) for the items with a part that is found at one of ``starts``, which are places of any of their parts;
    an item begins as far before its part as the part lies in it, but not before the text does. Places that read the
    same are looked up once."""
    padded = np.frombuffer(packed + bytes(STEPS), np.uint8)
    view = np.lib.stride_tricks.sliding_window_view(padded, STEPS)
    where, items = [], []
    for a in range(0, len(starts), 16 * EMBEDDED):
        own = starts[a : a + 16 * EMBEDDED]
        rows = np.ascontiguousarray(view[own])
        distinct, inverse = np.unique(rows.view(f"V{STEPS}").reshape(-1), return_inverse=True)
        distinct = distinct.view(np.uint8).reshape(-1, STEPS)
        order = np.argsort(inverse, kind="stable")
        counts = np.bincount(inverse, minlength=len(distinct))
        first = np.cumsum(counts) - counts
        for b in range(0, len(distinct), EMBEDDED):
            string, part = tables.find(distinct[b : b + EMBEDDED])
            n = counts[b + string]
            place = np.repeat(first[b + string], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = own[order[place]]
            where.append(np.maximum(at - np.repeat(tables.cut[part], n), begins[np.searchsorted(begins, at, "right") - 1]))
            items.append(np.repeat(tables.item[part], n))
    return (np.concatenate(where), np.concatenate(items)) if where else (np.zeros(0, np.int64),) * 2


def spans(index: Index, begins: np.ndarray, where: np.ndarray, item: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, from, to) of the text around windows; overlapping ones of one item are one."""
    order = np.lexsort((where, item))
    where, item = where[order], item[order]
    doc = np.searchsorted(begins, where, "right") - 1
    edits, sizes = index.edits[item], np.array([len(t) for _, t in index.items], np.int64)[item]
    low, high = where - edits - ASIDE, where + sizes + 2 * edits + ASIDE
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (low[1:] > high[:-1]))) if len(where) else where
    for a, b in zip(new.tolist(), np.append(new[1:], len(where)).tolist(), strict=False):
        yield int(doc[a]), int(item[a]), int(low[a]), int(high[b - 1])


def _found(block: Broadcast, rate: float):
    """A function from texts to {(text, item): (distance, end)}, and the index it uses."""
    index = Index(block.value, rate)
    tables = Tables([t for _, t in index.items])

    def search(raw: list[bytes | None]) -> dict[tuple[int, int], tuple[int, int]]:
        texts = [plain(t) for t in raw]
        packed = b"\0".join(texts)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        found: dict[tuple[int, int], tuple[int, int]] = {}
        for d, i, low, high in spans(index, begins, *retrieve(tables, packed, index.starts(packed, begins), begins)):
            first = max(0, low - int(begins[d]))
            text = texts[d][first : high - int(begins[d])]
            if not index.may_hold(text, i):
                continue
            distance, end = infix_distance(index.items[i][1], text)
            if distance <= index.edits[i]:
                found[d, i] = min(found.get((d, i), (distance, first + end)), (distance, first + end))
        return found

    return search, index


def _search(block: Broadcast, rate: float, key: str, text: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, index = _found(block, rate)
        for part in chunks(batches, text, 4 << 20):
            ids = part.column(key).to_pylist()
            found = search(bytes_of(part.column(text).combine_chunks()))
            rows = [(ids[d], index.items[i][0], distance, len(index.items[i][1]), end) for (d, i), (distance, end) in sorted(found.items())]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [key, "item_id", "distance", "item_bytes", "end"])

    return run


def _clean(block: Broadcast, rate: float, text: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, _ = _found(block, rate)
        for part in chunks(batches, text, 4 << 20):
            leaky = {d for d, _ in search(bytes_of(part.column(text).combine_chunks()))}
            yield from part.filter(pa.array([d not in leaky for d in range(part.num_rows)], pa.bool_())).combine_chunks().to_batches()
        hand_back()

    return run


def blocks(items: DataFrame, item: str | None = "item_id", text: str = "text") -> Iterator[Broadcast]:
    """The items, normalised, as broadcasts of at most about ``ITEM_BLOCK`` bytes each; at least one, which may be empty."""
    items = items.select((F.col(item) if item else F.lit(None)).cast("long").alias("item_id"), F.col(text).alias("item_text")).where("item_text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("item_text")), F.lit(0))).first()[0]
    count = max(1, -(-size // ITEM_BLOCK))
    for k in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "item_text"), F.lit(count)) == k).collect()
        yield items.sparkSession.sparkContext.broadcast(sorted(((i, plain(t.encode())) for i, t in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1])))


def leaks(docs: DataFrame, items: DataFrame, rate: float = RATE, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each document and item that leaks into it: ``key``, ``item_id``, ``distance`` (least number of
    edits), ``item_bytes`` and ``end`` (of the part found, in the normalised text).

    Null or empty texts leak nothing, null or empty items leak nowhere; items of one byte and more take part, those
    under ten bytes without an edit. Keys and item ids may be null, and stay so in the result; they are whole numbers, and
    what cannot be cast to one raises an error. Repeated rows and items are reported each; of parts with the same
    distance the first found counts. Other columns are ignored; an empty table on either side gives an empty result.
    Items are a query set that goes to the tasks in blocks of bounded size, one pass over the documents a block.
    """
    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias("__gl_text"))
    found = [rows.mapInArrow(_search(block, rate, key, "__gl_text"), f"{key} long, item_id long, distance long, item_bytes long, end long") for block in blocks(items, item, item_text)]
    return functools.reduce(DataFrame.union, found)


def without_leaks(docs: DataFrame, items: DataFrame, rate: float = RATE, text: str = "text", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no item leaks into, as they are; each row is judged by its own text, whatever its key.

    Nothing is shuffled. Nulls, short items and empty tables: see :func:`leaks`.
    """
    for block in blocks(items, None, item_text):
        docs = docs.mapInArrow(_clean(block, rate, text), docs.schema)
    return docs


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op6_decontamination": op6_decontamination}
ORACLES: dict[str, str] = {}
