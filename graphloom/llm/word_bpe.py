"""Ids of many texts at once by a byte-level word vocabulary: lower case, letters, digits and marks apart, merges by rank.

Texts are parted by array operations and each different part of a chunk is merged once, all of them side by side. What
array operations don't cover goes to the tokenizer itself: words with letters behind the Latin blocks, words with
``<|`` (special tokens are found as they are written, before lower case) and very long parts.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text taken at once, the longest part merged side by side, parts merged at once, words whose ids a tokenizer's worker remembers.
CHUNK, LONGEST, BLOCK, REMEMBERED = 2 << 20, 32, 32768, 250_000
#: The first letter behind the Latin blocks, whose letters are in composed form.
_BEYOND = 0x250
_SPACE, _LETTER, _NUMBER, _MARK, _HIGH, _ALONE = range(6)
_NONE = 1 << 25
_WHITE = re.compile(rb"[\x20\x09-\x0D]")
_SEPARATOR = "<|startoftext|>"
_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _class(code: int) -> int:
    if code in (0x20, 0x85, 0xA0) or 9 <= code <= 13:
        return _SPACE
    return {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(code))[0], _MARK)


_CLASSES = bytes(_class(b) if b < 128 else _HIGH for b in range(256))
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Of two-byte letters below ``_BEYOND``: class, and the two bytes of the lower-case letter; _HIGH where it has not two bytes.
_LOWERED = [chr(c).lower().encode() for c in range(_BEYOND)]
_CLASSES_2 = np.array([_class(c) if len(_LOWERED[c]) == 2 else _HIGH for c in range(_BEYOND)], np.uint8)
_LOWER_2 = np.array([tuple(w) if len(w) == 2 else (0, 0) for w in _LOWERED], np.uint8)


def _letters() -> list[str]:
    """The letters by which byte-level vocabularies write bytes."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
    return [hidden.get(b, chr(b)) for b in range(256)]


@functools.lru_cache(maxsize=1)
def merges(vocabulary: str) -> dict[str, np.ndarray]:
    """The merges of a vocabulary (the text of its file) as arrays; an error if it parts texts in another way.

    Ranks of pairs are in one row in which the rows of all left ids lie over one another without touching: that of ids a
    and b is ``rank[base[a] + b]`` if ``owner`` there is a.
    """
    read = json.loads(vocabulary)
    parts = read["pre_tokenizer"]["pretokenizers"]
    model = read["model"]
    plain = [n["type"] for n in read["normalizer"]["normalizers"]] == _NORMALIZER and [p["type"] for p in parts] == ["Split", "ByteLevel"]
    plain = plain and parts[0]["pattern"] == {"Regex": _PATTERN} and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"]
    if not plain or model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or model["dropout"] or model["ignore_merges"]:
        raise ValueError("not a byte-level vocabulary of lower-case words")
    ids = model["vocab"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else m for m in model["merges"]]
    left, right = (np.array([ids[p[k]] for p in pairs], np.int64) for k in (0, 1))
    order = np.lexsort((right, left))
    lefts, at, counts = np.unique(left[order], return_index=True, return_counts=True)
    top = max(ids.values()) + 1
    base, owner, rank, tried = np.zeros(top, np.int32), np.full(4 * top, -1, np.int32), np.zeros(4 * top, np.int32), 0
    for k in np.argsort(-counts, kind="stable").tolist():
        own = order[at[k] : at[k] + counts[k]]
        columns, free = right[own], []
        while not len(free):  # from the last row's place on, which is quicker than from the first gap and leaves more of them
            if tried + 64 + top > len(owner):
                owner, rank = np.append(owner, np.full(top, -1, np.int32)), np.append(rank, np.zeros(top, np.int32))
            bases = np.arange(tried, tried + 64)
            free, tried = bases[(owner[bases[:, None] + columns] < 0).all(axis=1)], tried + 64
        base[lefts[k]] = tried = int(free[0])
        owner[tried + columns], rank[tried + columns] = lefts[k], own
    used = int(base.max()) + top
    letters = _letters()
    return {
        "base": base,
        "owner": owner[:used],
        "rank": rank[:used],
        "made": np.array([ids[a + b] for a, b in pairs], np.int32),
        "inner": np.array([ids[c] for c in letters], np.int32),
        "last": np.array([ids[c + "</w>"] for c in letters], np.int32),
    }


@functools.lru_cache(maxsize=1)
def _tokenizer(vocabulary: str):
    """The tokenizer, and the ids of words it was asked for."""
    from tokenizers import Tokenizer

    return Tokenizer.from_str(vocabulary), {}


def _asked(words: list[bytes], vocabulary: str) -> list[np.ndarray]:
    """Ids of words by the tokenizer: in one string, parted by a special token; one that may contain it goes alone."""
    tokenizer, known = _tokenizer(vocabulary)
    missing = [w for w in words if w not in known]
    if len(known) + len(missing) > REMEMBERED:
        known.clear()
        missing = words
    joined, separator = [w for w in missing if b"<|" not in w], tokenizer.token_to_id(_SEPARATOR)
    for at in range(0, len(joined), 2048):
        part = joined[at : at + 2048]
        ids = np.array(tokenizer.encode_batch_fast([_SEPARATOR.join(w.decode() for w in part)], add_special_tokens=False)[0].ids, np.int32)
        cuts = np.flatnonzero(ids == separator)
        known.update((w, ids[a:b].copy()) for w, a, b in zip(part, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)], strict=True))
    for w in missing:
        if b"<|" in w:
            known[w] = np.array(tokenizer.encode(w.decode(), add_special_tokens=False).ids, np.int32)
    return [known[w] for w in words]


def _parts(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the parts of a text that ends with white space; the text in lower case without white space, and the
    places of the parts there; which of them are whole words for the tokenizer."""
    raw = np.frombuffer(text, np.uint8)
    kind = np.frombuffer(bytearray(text.translate(_CLASSES)), np.uint8)
    low = np.frombuffer(bytearray(text.translate(_LOWER)), np.uint8)
    odd = [np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))] if b"<|" in text else []
    high = not text.isascii()
    if high:
        at = np.flatnonzero((raw >= 0xC2) & (raw <= 0xC9))
        at = at[raw[at + 1] & 0xC0 == 0x80]
        code = (raw[at] & 0x1F).astype(np.int32) << 6 | raw[at + 1] & 0x3F
        known = code < _BEYOND
        known[known] = _CLASSES_2[code[known]] != _HIGH
        at, code = at[known], code[known]
        kind[at] = kind[at + 1] = _CLASSES_2[code]
        low[at], low[at + 1] = _LOWER_2[code, 0], _LOWER_2[code, 1]
        odd.append(np.flatnonzero(kind == _HIGH))
    odd = np.concatenate(odd) if odd else np.zeros(0, np.int64)
    kept = kind != _SPACE
    if len(odd):
        edges = np.flatnonzero(np.diff(kept, prepend=False))
        words = np.unique(np.searchsorted(edges[::2], odd, "right") - 1)
        change = np.zeros(len(raw) + 1, np.int8)
        change[edges[::2][words]] = 1
        change[edges[1::2][words]] = -1
        alone = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
        kind[alone] = _ALONE
        low[alone] = raw[alone]
    starts = kept.copy()
    starts[1:] &= kind[1:] != kind[:-1]
    number = kind == _NUMBER
    if high:
        number &= raw & 0xC0 != 0x80
    starts |= number
    at = np.flatnonzero((raw == ord("'")) & starts & (kind == _MARK))
    at = at[kind[at + 1] == _LETTER]
    one, two = low[at + 1], low[at + 2]
    short = (one == ord("s")) | (one == ord("t")) | (one == ord("m")) | (one == ord("d"))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    starts[at[short | long] + 1] = False
    ends = np.concatenate([at[short] + 2, at[long] + 3])
    starts[ends] = kept[ends]
    places = np.flatnonzero(starts)
    return places, low[kept], np.flatnonzero(starts[kept]), kind[places] == _ALONE


def _ranks(table: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    at = table["base"][a] + b
    return np.where(table["owner"][at] == a, table["rank"][at], _NONE)


def _merged(data: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, table: dict[str, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of numbers of parts and the matrix of their ids, a column a part.

    Every part that has ids left to merge loses one by a step, so those of one length stay side by side, and those that
    begin at that length join them. The pair of least rank goes first, the leftmost among equals.
    """
    out = []
    ids, ranks, who = np.zeros((LONGEST + 1, 0), np.int32), np.zeros((LONGEST, 0), np.int32), np.zeros(0, np.int64)
    for n in range(int(lengths.max(initial=0)), 0, -1):
        new = np.flatnonzero(lengths == n)
        fresh = data[offsets[new] + np.arange(n)[:, None]]
        fresh = np.concatenate([table["inner"][fresh[:-1]], table["last"][fresh[-1:]]])
        ids = np.concatenate([ids[:n], fresh], axis=1)
        ranks = np.concatenate([ranks[: n - 1], _ranks(table, fresh[:-1], fresh[1:])], axis=1)
        who = np.concatenate([who, new])
        if n == 1:
            out.append((who, ids))
            break
        best = (ranks * 32 + np.arange(n - 1, dtype=np.int32)[:, None]).min(axis=0)
        more = best < _NONE * 32
        if not more.all():
            out.append((who[~more], ids[:, ~more]))
            ids, ranks, who, best = ids[:, more], ranks[:, more], who[more], best[more]
        place, made = best & 31, table["made"][best >> 5]
        cells = np.arange(len(who))
        before = np.arange(n - 1, dtype=np.int32)[:, None] < place
        ids = np.where(before, ids[:-1], ids[1:])
        ids[place, cells] = made
        ranks = np.where(before[:-1], ranks[:-1], ranks[1:])
        k = np.flatnonzero(place > 0)
        ranks[place[k] - 1, k] = _ranks(table, ids[place[k] - 1, k], made[k])
        k = np.flatnonzero(place < n - 2)
        ranks[place[k], k] = _ranks(table, made[k], ids[place[k] + 1, k])
    return out


def _chunk_ids(texts: list[bytes], table: dict[str, np.ndarray], vocabulary: Callable[[], str]) -> list[np.ndarray]:
    text = b"\n".join([*texts, b"   "])
    places, data, starts, alone = _parts(text)
    offsets = np.append(starts, len(data)).astype(np.int32)
    parts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    which, found = parts.indices.to_numpy(), parts.dictionary
    n = len(found)
    offsets = np.frombuffer(found.buffers()[1], np.int32)[: n + 1] if n else np.zeros(1, np.int32)
    data = np.frombuffer(found.buffers()[2], np.uint8) if n else data
    lengths = np.diff(offsets)
    asked = lengths > LONGEST
    asked[which[alone]] = True
    done = []
    own = np.flatnonzero(~asked)
    for at in range(0, len(own), BLOCK):
        block = own[at : at + BLOCK]
        done += [(block[who], ids) for who, ids in _merged(data, offsets[block], lengths[block], table)]
    rest = np.flatnonzero(asked)
    given = _asked(found.take(pa.array(rest)).to_pylist(), vocabulary()) if len(rest) else []
    counts = np.zeros(n, np.int64)
    for who, ids in done:
        counts[who] = len(ids)
    counts[rest] = [len(g) for g in given]
    first = np.cumsum(counts) - counts
    flat = np.zeros(int(counts.sum()), "<u4")
    for who, ids in done:
        flat[first[who] + np.arange(len(ids))[:, None]] = ids
    for k, g in zip(rest.tolist(), given, strict=True):
        flat[first[k] : first[k] + len(g)] = g
    counts = counts[which]
    ends = np.append(0, np.cumsum(counts))
    out = flat[np.repeat(first[which] - ends[:-1], counts) + np.arange(ends[-1])]
    cuts = ends[np.searchsorted(places, np.cumsum([0, *(len(t) + 1 for t in texts)]))].tolist()
    return [out[a:b] for a, b in zip(cuts, cuts[1:])]


def _slices(text: bytes) -> list[bytes]:
    """A text in slices of about ``CHUNK`` bytes that end at white space, which no id reaches across."""
    out, at = [], 0
    while found := _WHITE.search(text, at + CHUNK):
        out.append(text[at : found.start()])
        at = found.start()
    return [*out, text[at:]]


def text_ids(texts: Iterable[bytes | None], table: dict[str, np.ndarray], vocabulary: Callable[[], str]) -> Iterator[np.ndarray]:
    """The ids of each text, in order, as arrays of little-endian 32-bit numbers; a null text has none. ``table`` is what
    :func:`merges` returns, ``vocabulary()`` the text of the vocabulary's file, called only if the tokenizer is needed."""
    held, size = [], 0
    for t in texts:
        t = t or b""
        if held and size + len(t) > CHUNK:
            yield from _chunk_ids(held, table, vocabulary)
            held, size = [], 0
        if len(t) > CHUNK:
            yield np.concatenate([_chunk_ids([s], table, vocabulary)[0] for s in _slices(t)])
        else:
            held.append(t)
            size += len(t)
    if held:
        yield from _chunk_ids(held, table, vocabulary)
