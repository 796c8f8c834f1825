"""Exact removal of passages that repeat an earlier document, by super-k-mer partitioning.

A *window* is ``width`` consecutive units (words or bytes) of one document. Each window has a minimiser, the rarest of
its m-grams; consecutive windows that share one form a super-k-mer, which travels as one packed string to the bucket of
its minimiser. Equal windows have equal minimisers, so a bucket sees every copy of each of its windows and decides
exactly, on the units themselves, in which document a window starts first.

0. ``_sketch`` (by scan): m-grams of all texts are counted in a table of fixed size. Its logarithms, a byte a counter,
   are broadcast, and minimisers are least by (logarithm, hash). A passage that many documents share has frequent grams,
   so a window that holds anything else has a rarer minimiser of its own: at the edges of the passage, where strings
   differ in each document, they go to as many buckets. What stays with the passage's grams is equal everywhere.

Texts are dealt once into groups of a few MB by their key; every step below reads that one exchange.

1. ``_census`` (by group): the distinct minimisers of the group, four bytes each, go to their buckets.
2. ``_answer`` (by bucket): a bit a minimiser comes back: does another group have it? All others need not travel.
3. ``_pack`` (by group): super-k-mers whose minimiser is shared travel to its bucket. Equal packed strings of a group
   are combined before: the group's first document travels, later ones are marked at once, so a passage that a third of
   all rows share costs one string a group.
4. ``_settle`` (by bucket): equal strings are combined across groups; what is left is compared window by window through
   the ``rank`` function given (sorted names for words, a suffix array for bytes).
5. ``_apply`` (by group): marks meet their texts, and the uncovered units are kept.

Groups and buckets number as the bytes of text demand, whatever the session's shuffle width, so a Python worker holds a
few MB at a time, or the longest text where that is longer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.common import U64, bytes_of, chunks, hand_back, mix64, partitions, release, sliding_min

#: Units of an m-gram.
WORD_GRAM, BYTE_GRAM = 4, 16
#: Bytes of text that are cut at a time, and that are counted together.
CHUNK, COUNTED = 1 << 20, 2 << 20
#: Bytes of text of a group, and for which there is one bucket.
GROUP, BUCKET = 4 << 20, 12 << 20
#: Windows of a super-k-mer, which else can be as long as its text.
LONGEST = 1 << 12
#: Bytes of packed strings, of whole minimisers, that are ranked together.
RANKED = 1 << 17
#: Counters of the sketch are 2 ** SKETCH_BITS, and are merged in SLICES parts. A byte of each is broadcast: 1 MB.
SKETCH_BITS, SLICES = 20, 64
OUTPUTS = ("kept", "n_units", "n_removed", "n_spans")
_PLACE, _BLOB = "__gl_place", "__gl_blob"


class Vocabulary(dict):
    """Dense numbers of the words of a chunk, in the order of their first appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def word_numbers(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    vocabulary = Vocabulary()
    return np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)), list(vocabulary)


def word_units(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed text, units a document, first and last byte of each unit, and the hash of each unit.

    Words are parted by ASCII white space, as the contract has it, and packed with one space between them.
    """
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff(space, prepend=True))
    a, b = edge[::2], edge[1::2]
    bounds = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    counts = np.diff(np.searchsorted(a, bounds), prepend=0)
    keep = ~space
    keep[b] = True  # one space behind each word
    packed = raw[keep]
    ends = np.cumsum(b - a + 1) - 1
    begins = ends - (b - a)
    packed[ends] = 32
    # a polynomial in each word's bytes; the space behind it adds nothing
    inside = np.arange(len(packed)) - np.repeat(begins, ends + 1 - begins)
    power = np.cumprod(np.concatenate([[U64(1)], np.full(int(inside.max(initial=0)), U64(0x9E3779B97F4A7C15))]), dtype=U64)
    terms = power[inside]
    terms *= packed + U64(1)
    terms[ends] = 0
    hashes = mix64(np.add.reduceat(terms, begins)) if len(begins) else np.zeros(0, U64)
    return packed.tobytes(), counts, begins, ends, hashes


def byte_units(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, None]:
    packed = b"".join(texts)
    at = np.arange(len(packed), dtype=np.int64)
    return packed, np.fromiter(map(len, texts), np.int64, len(texts)), at, at + 1, None


def gram_hashes(packed: bytes, hashes: np.ndarray | None, width: int) -> tuple[np.ndarray, int]:
    """Hashes of the m-grams from each unit on, and m."""
    if hashes is not None:
        gram = min(WORD_GRAM, width)
        n = max(0, len(hashes) - gram + 1)
        mixed = np.zeros(n, U64)
        for k in range(gram):
            mixed = mixed * U64(0x9E3779B97F4A7C15) + hashes[k : n + k]
        return mix64(mixed), gram
    gram = min(BYTE_GRAM, width)
    if gram < 8:
        return mix64(np.frombuffer(packed, np.uint8).astype(U64) + U64(1)), 1
    eight = loads(packed)
    n = max(0, len(packed) - gram + 1)
    return mix64(eight[:n] * U64(0x9E3779B97F4A7C15) + eight[gram - 8 : gram - 8 + n]), gram


def _cuts(texts: list[bytes], limit: int) -> list[tuple[int, int]]:
    """Runs of texts of about ``limit`` bytes, as slices (from, to)."""
    sizes = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    at = np.unique(np.append(np.flatnonzero(np.diff(sizes // limit, prepend=0)), [0, len(texts)]))
    return list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))


def _sketch(text: str, width: int, units: Callable, bits: int) -> Callable:
    """Counts of m-grams by the first bits of their hashes, in slices, and at slice -1 the bytes of text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, size = np.zeros(1 << bits, np.int64), 0
        for part in chunks(batches, text, COUNTED):
            texts = [t for t in bytes_of(part.column(text).combine_chunks()) if t]
            size += sum(map(len, texts))
            packed, *_, hashes = units(texts)
            hashed, _ = gram_hashes(packed, hashes, width)
            count += np.bincount((hashed >> U64(64 - bits)).astype(np.int64), minlength=1 << bits)
        if size:
            blobs = [zstandard.compress(part.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1) for part in np.split(count, SLICES)]
            hand_back()
            yield pa.RecordBatch.from_arrays([pa.array([*range(SLICES), -1], pa.int32()), pa.array([*blobs, np.array([size], "<i8").tobytes()], pa.binary())], ["slice", _BLOB])

    return run


def _merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, total = key[0].as_py(), 0
    for batch in batches:
        for blob in batch.column(_BLOB).to_pylist():
            if at < 0:
                total = total + np.frombuffer(blob, "<i8")
            else:
                raw = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
                total = total + np.ascontiguousarray(raw.T).reshape(-1).view("<u8")
    made = total.tobytes() if at < 0 else np.frexp(total.astype(np.float64))[1].astype(np.uint8).tobytes()
    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([made], pa.binary())], ["slice", _BLOB])


def gram_classes(docs: DataFrame, text: str, width: int, units: Callable, bits: int) -> tuple[np.ndarray, int]:
    """The logarithm of each counter of the sketch, and the bytes of all texts. A table of fixed size reaches the driver."""
    rows = docs.select(text).where(F.col(text).isNotNull()).mapInArrow(_sketch(text, width, units, bits), f"slice int, {_BLOB} binary")
    found = {r[0]: r[1] for r in rows.groupBy("slice").applyInArrow(_merge, f"slice int, {_BLOB} binary").collect()}
    if -1 not in found:
        return np.zeros(1 << bits, np.uint8), 0
    return np.concatenate([np.frombuffer(found[k], np.uint8) for k in range(SLICES)]), int(np.frombuffer(found[-1], "<i8")[0])


def loads(packed: bytes) -> np.ndarray:
    """The eight bytes from each position on, as one number."""
    return np.ndarray((len(packed) - 7,), np.dtype("<u8"), packed, strides=(1,)).astype(U64) if len(packed) > 7 else np.zeros(0, U64)


def _blob(*arrays: np.ndarray, tail: bytes = b"") -> bytes:
    return zstandard.compress(np.array([len(arrays[0])], "<i8").tobytes() + b"".join(a.tobytes() for a in arrays) + tail, 3)


def _unblob(blob: bytes, kinds: tuple[str, ...]) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.decompress(blob)
    n, at, out = int(np.frombuffer(raw, "<i8", 1)[0]), 8, []
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    return out, raw[at:]


_MARK, _STRING = ("<i8", "<i4", "<i4"), ("<i8", "<i4", "<i4", "<u4", "<i4")


def _runs(doc: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Join marks that touch: at is sorted within a document's rows."""
    if not len(doc):
        return doc, at, n
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + n[:-1])
    first = np.flatnonzero(new)
    return doc[first], at[first], np.add.reduceat(n, first)


def _pieces(ids: np.ndarray, texts: list[bytes], width: int, units: Callable, classes: np.ndarray) -> Iterator[tuple]:
    """The super-k-mers of texts sorted by id, a few MB of text at a time.

    Yields the packed text, and for each super-k-mer its document's id, first unit, number of windows, minimiser, and
    first and last byte. A minimiser is a number: the class of the gram's counter, then bits of its hash.
    """
    shift = U64(64 - (len(classes).bit_length() - 1))
    for a, b in _cuts(texts, CHUNK):
        packed, counts, first, last, hashes = units(texts[a:b])
        hashed, gram = gram_hashes(packed, hashes, width)
        doc = np.repeat(np.arange(b - a, dtype=np.int32), counts)
        starts = np.flatnonzero(doc[: max(0, len(doc) - width + 1)] == doc[width - 1 :])
        if not len(starts):
            continue
        low = sliding_min(classes[(hashed >> shift).astype(np.int64)].astype(U64) << U64(56) | hashed >> U64(8), width - gram + 1)[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (starts[1:] != starts[:-1] + 1) | (low[1:] != low[:-1])
        head = np.flatnonzero(new)
        n = np.diff(np.append(head, len(starts)))
        if n.max() > LONGEST:
            parts = -(-n // LONGEST)
            inside = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            head = np.repeat(head, parts) + inside * LONGEST
            n = np.diff(np.append(head, len(starts)))
        head, low = starts[head], low[head]
        of = doc[head]
        at = head - (np.cumsum(counts) - counts)[of]
        yield packed, ids[a:b][of], at.astype("<i4"), n.astype("<i4"), low, first[head], last[head + n + width - 2]


def _sorted_texts(docs: pa.Table, key: str, text: str) -> tuple[np.ndarray, list[bytes]]:
    """The rows that take part, by key."""
    rows = sorted((i, k) for k, (i, t) in enumerate(zip(docs.column(key).to_pylist(), docs.column(text).is_valid().to_pylist(), strict=True)) if i is not None and t)
    texts = bytes_of(docs.column(text).combine_chunks())
    return np.array([i for i, _ in rows], np.int64), [texts[k] for _, k in rows]


def _spans(cuts: np.ndarray, n: int) -> list[tuple[int, int]]:
    """From each place of ``cuts`` to the next, the last to n; nothing if there are none."""
    return list(zip(cuts.tolist(), np.append(cuts[1:], n).tolist(), strict=False))


def _tags(low: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and tag of minimisers. Two of a bucket may share a tag; that only keeps strings that have no partner."""
    low = mix64(low)
    return (low % U64(buckets)).astype(np.int64), (low >> U64(32)).astype("<u4")


def _distinct_tags(low: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted bucket-and-tag values, each value's place among them, and where each bucket begins."""
    place, tag = _tags(low, buckets)
    distinct, inverse = np.unique(place.astype(U64) << U64(32) | tag, return_inverse=True)
    return distinct, inverse, np.flatnonzero(np.diff((distinct >> U64(32)).astype(np.int64), prepend=-1))


def _census(key: str, text: str, width: int, units: Callable, classes: Broadcast, buckets: int) -> Callable:
    @release
    def run(docs: pa.Table) -> pa.Table:
        at = docs.column(_PLACE)[0].as_py()
        low = [x[4] for x in _pieces(*_sorted_texts(docs, key, text), width, units, np.frombuffer(classes.value, np.uint8))]
        places, blobs = [], []
        if low:
            distinct, _, cuts = _distinct_tags(np.concatenate(low), buckets)
            for a, b in _spans(cuts, len(distinct)):
                places.append(int(distinct[a] >> U64(32)))
                blobs.append((distinct[a:b] & U64(0xFFFFFFFF)).astype("<u4").tobytes())
        return pa.table([pa.array(places, pa.int32()), pa.array([at] * len(places), pa.int32()), pa.array(blobs, pa.binary())], ["bucket", _PLACE, _BLOB])

    return run


@release
def _answer(table: pa.Table) -> pa.Table:
    """For each group of texts, a bit for each of its tags: does another group have it?"""
    blobs = table.column(_BLOB).to_pylist()
    tags = np.concatenate([np.frombuffer(x, "<u4") for x in blobs])
    _, inverse, count = np.unique(tags, return_inverse=True, return_counts=True)  # a group names a tag once
    shared = np.split(count[inverse] > 1, np.cumsum([len(x) // 4 for x in blobs])[:-1])
    return pa.table([table.column(_PLACE), table.column("bucket"), pa.array([np.packbits(x).tobytes() for x in shared], pa.binary())], [_PLACE, "bucket", _BLOB])


def _pack(key: str, text: str, width: int, units: Callable, classes: Broadcast, buckets: int) -> Callable:
    @release
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts = _sorted_texts(docs, key, text) if docs.num_rows else (np.zeros(0, np.int64), [])
        parts, pieces = [], []
        for packed, *arrays, a, b in _pieces(ids, texts, width, units, np.frombuffer(classes.value, np.uint8)):
            parts.append(arrays)
            pieces.append((packed, a, b))
        places, blobs, marks = [], [], []
        if parts:
            doc, at, n, low = (np.concatenate(x) for x in zip(*parts, strict=True))
            distinct, inverse, cuts = _distinct_tags(low, buckets)
            shared = np.zeros(len(distinct), bool)
            bits = dict(zip(answers.column("bucket").to_pylist(), answers.column(_BLOB).to_pylist(), strict=True))
            for a, b in _spans(cuts, len(distinct)):
                shared[a:b] = np.unpackbits(np.frombuffer(bits[int(distinct[a] >> U64(32))], np.uint8), count=b - a)
            least, most = np.full(len(distinct), np.iinfo(np.int64).max), np.full(len(distinct), np.iinfo(np.int64).min)
            np.minimum.at(least, inverse, doc)
            np.maximum.at(most, inverse, doc)
            use = (shared | (least < most))[inverse]
            strings: list[bytes] = []
            base = 0
            for packed, a, b in pieces:
                mine = np.flatnonzero(use[base : base + len(a)])
                strings += [packed[x:y] for x, y in zip(a[mine].tolist(), b[mine].tolist(), strict=True)]
                base += len(a)
            doc, at, n, low = doc[use], at[use], n[use], low[use]
            place, tag = _tags(low, buckets)
            seen: dict[bytes, int] = {}
            earliest = np.fromiter(map(seen.setdefault, strings, doc.tolist()), np.int64, len(strings))
            later = earliest < doc
            if later.any():
                d, a, m = _runs(doc[later], at[later], n[later])
                places, blobs, marks = [int(d[0]) % buckets], [_blob(d.astype("<i8"), a.astype("<i4"), m.astype("<i4"))], [True]
            rest = np.flatnonzero(~later)
            rest = rest[np.argsort(place[rest], kind="stable")]
            cuts = np.flatnonzero(np.diff(place[rest], prepend=-1))
            for a, b in _spans(cuts, len(rest)):
                own = rest[a:b]
                mine = [strings[k] for k in own.tolist()]
                places.append(int(place[own[0]]))
                blobs.append(_blob(np.diff(doc[own], prepend=0).astype("<i8"), at[own], n[own], tag[own], np.fromiter(map(len, mine), "<i4", len(mine)), tail=b"".join(mine)))
                marks.append(False)
        return pa.table([pa.array(places, pa.int32()), pa.array(blobs, pa.binary()), pa.array(marks, pa.bool_())], ["bucket", _BLOB, "marks"])

    return run


def _by_document(doc: np.ndarray, at: np.ndarray, n: np.ndarray, buckets: int) -> tuple[list[int], list[bytes]]:
    place = doc % buckets
    order = np.argsort(place, kind="stable")
    cuts = np.flatnonzero(np.diff(place[order], prepend=-1))
    places, blobs = [], []
    for a, b in _spans(cuts, len(order)):
        own = order[a:b]
        places.append(int(place[own[0]]))
        blobs.append(_blob(doc[own].astype("<i8"), at[own].astype("<i4"), n[own].astype("<i4")))
    return places, blobs


def _settle(rank: Callable, buckets: int) -> Callable:
    @release
    def run(table: pa.Table) -> pa.Table:
        marks = table.column("marks").to_pylist()
        blobs = table.column(_BLOB).to_pylist()
        found = [_unblob(b, _MARK)[0] for b, m in zip(blobs, marks, strict=True) if m]
        docs, ats, ns, tags, strings = [], [], [], [], []
        for b in (b for b, m in zip(blobs, marks, strict=True) if not m):
            (d, a, n, t, size), tail = _unblob(b, _STRING)
            docs.append(np.cumsum(d))
            ats.append(a)
            ns.append(n)
            tags.append(t)
            ends = np.cumsum(size)
            strings.append((tail, ends - size, ends))
        if docs:
            doc, at, n, tag = map(np.concatenate, (docs, ats, ns, tags))
            order = np.lexsort((doc, tag))
            head = np.flatnonzero(np.diff(tag[order].astype(np.int64), prepend=-1))
            tail_ = np.append(head[1:], len(order)) - 1
            shared = np.repeat(doc[order[head]] != doc[order[tail_]], tail_ - head + 1)
            use = np.zeros(len(doc), bool)
            use[order[shared]] = True
            texts: list[bytes] = []
            base = 0
            for tail, a, b in strings:
                mine = np.flatnonzero(use[base : base + len(a)])
                texts += [tail[x:y] for x, y in zip(a[mine].tolist(), b[mine].tolist(), strict=True)]
                base += len(a)
            doc, at, n, tag = doc[use], at[use], n[use], tag[use]
            numbers: dict[bytes, int] = Vocabulary()
            sid = np.fromiter(map(numbers.__getitem__, texts), np.int64, len(texts))
            least = np.full(len(numbers), np.iinfo(np.int64).max)
            np.minimum.at(least, sid, doc)
            of = np.zeros(len(numbers), tag.dtype)  # equal strings have equal minimisers
            of[sid] = tag
            _, inverse, count = np.unique(of, return_inverse=True, return_counts=True)
            several = count[inverse] > 1
            whole = ~several[sid] & (doc > least[sid])
            found.append([doc[whole], at[whole], n[whole]])
            if several.any():
                chosen = np.flatnonzero(several)
                listed = list(numbers)
                chosen = chosen[np.argsort(of[chosen], kind="stable")]
                size = np.cumsum([len(listed[k]) for k in chosen.tolist()])
                new = np.flatnonzero(np.diff(of[chosen].astype(np.int64), prepend=-1))  # equal windows have equal minimisers
                cuts = [0, *new[1:][np.diff(size[new] // RANKED) > 0].tolist(), len(chosen)]
                first = np.concatenate([rank([listed[k] for k in chosen[a:b].tolist()], least[chosen[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])  # by window, string after string
                rows = np.flatnonzero(several[sid])
                length = np.zeros(len(numbers), np.int64)
                length[sid] = n
                begin = np.zeros(len(numbers), np.int64)
                begin[chosen] = np.cumsum(length[chosen]) - length[chosen]
                many = n[rows].astype(np.int64)
                of = np.repeat(np.arange(len(rows)), many)
                place = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
                hit = np.flatnonzero(first[begin[sid[rows]][of] + place] < doc[rows][of])
                found.append(_runs(doc[rows][of[hit]], at[rows][of[hit]].astype(np.int64) + place[hit], np.ones(len(hit), np.int64)))
        places: list[int] = []
        out: list[bytes] = []
        if found:
            places, out = _by_document(*(np.concatenate([np.asarray(f[k], np.int64) for f in found]) for k in range(3)), buckets)
        return pa.table([pa.array(places, pa.int32()), pa.array(out, pa.binary())], [_PLACE, _BLOB])

    return run


def _cover(n: int, at: np.ndarray, m: np.ndarray, width: int) -> np.ndarray:
    """Which of n units a marked window covers."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, np.minimum(at, n), 1)
    np.add.at(edge, np.minimum(at + m + width - 1, n), -1)
    return np.cumsum(edge[:n]) > 0


def _apply(key: str, text: str, width: int, words: bool) -> Callable:
    @release
    def run(docs: pa.Table, marks: pa.Table) -> pa.Table:
        found = [_unblob(b, _MARK)[0] for b in marks.column(_BLOB).to_pylist()] if marks.num_rows else []
        doc, at, n = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))
        order = np.argsort(doc, kind="stable")
        doc, at, n = doc[order], at[order].astype(np.int64), n[order].astype(np.int64)
        ids = docs.column(key).to_pylist()
        kept, units, removed, spans = [], [], [], []
        for i, t in zip(ids, bytes_of(docs.column(text).combine_chunks()), strict=True):
            own = (t or b"").split() if words else (t or b"")
            a, b = (0, 0) if i is None else np.searchsorted(doc, (i, i + 1)).tolist()
            units.append(len(own))
            if a == b or not len(own):
                kept.append(b" ".join(own) if words else own)
                removed.append(0)
                spans.append(0)
                continue
            gone = _cover(len(own), at[a:b], n[a:b], width)
            left = np.flatnonzero(~gone)
            kept.append(b" ".join([own[k] for k in left.tolist()]) if words else np.frombuffer(own, np.uint8)[left].tobytes())
            removed.append(len(own) - len(left))
            spans.append(int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)))
        docs = docs.drop_columns([_PLACE])
        for name, values, kind in zip(OUTPUTS, (kept, units, removed, spans), (pa.binary(), pa.int64(), pa.int64(), pa.int64()), strict=True):
            docs = docs.append_column(name, pa.array(values, pa.binary()).cast(pa.string()) if name == "kept" and words else pa.array(values, kind))
        return docs

    return run


def prime_above(n: int) -> int:
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def remove_repeats(docs: DataFrame, *, width: int, words: bool, rank: Callable, key: str = "doc_id", text: str = "text", group: int = GROUP, bits: int = SKETCH_BITS) -> DataFrame:
    """Every row of ``docs`` with ``kept`` (what is left of its text), ``n_units``, ``n_removed`` and ``n_spans``.

    A unit goes if a window of ``width`` units that covers it also starts in a row with a smaller ``key``; windows are
    judged on the input. Null text counts as empty. A row whose key is null is neither compared nor changed. Rows that
    repeat a key are one document for comparison: they never remove each other, and marks found in one hold for all.
    Columns named as an output are replaced; all others are kept. Keys are whole numbers; a key that cannot be cast to
    one raises an error. Memory of a worker follows ``group``, the bytes of text it holds, and the longest text.
    """
    spark = docs.sparkSession
    docs = docs.drop(*OUTPUTS, _PLACE, _BLOB)
    units = word_units if words else byte_units
    classes, size = gram_classes(docs, text, width, units, bits)
    groups, buckets = prime_above(max(2 * partitions(spark), size // group)), max(partitions(spark), size // BUCKET)
    place = F.coalesce(F.pmod(F.col(key).cast("long"), F.lit(groups)), F.pmod(F.xxhash64(text), F.lit(groups)))
    placed = docs.withColumn(key, F.col(key).cast("long")).withColumn(_PLACE, place.cast("int"))
    how = (key, text, width, units, spark.sparkContext.broadcast(classes.tobytes()), buckets)
    census = placed.groupBy(_PLACE).applyInArrow(_census(*how), f"bucket int, {_PLACE} int, {_BLOB} binary")
    answers = census.groupBy("bucket").applyInArrow(_answer, f"{_PLACE} int, bucket int, {_BLOB} binary")
    strings = placed.groupBy(_PLACE).cogroup(answers.groupBy(_PLACE)).applyInArrow(_pack(*how), f"bucket int, {_BLOB} binary, marks boolean")
    marks = strings.groupBy("bucket").applyInArrow(_settle(rank, groups), f"{_PLACE} int, {_BLOB} binary")
    fields = [f for f in placed.schema.fields if f.name != _PLACE]
    schema = T.StructType([*fields, T.StructField("kept", T.StringType() if words else T.BinaryType()), *(T.StructField(x, T.LongType()) for x in OUTPUTS[1:])])
    return placed.groupBy(_PLACE).cogroup(marks.groupBy(_PLACE)).applyInArrow(_apply(key, text, width, words), schema)
