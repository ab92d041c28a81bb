"""Suffix-array deduplication: every byte of a 50-byte string that an earlier document holds too is removed.

Sorting a suffix for each byte would move a text dozens of times, so the array is sparse: it holds the suffixes that
begin at *anchors*. The anchor of a 50-byte string is the leftmost of its 20-byte pieces with the smallest hash, which
is the same place in each occurrence of the string, so equal strings meet at equal anchors; there is one suffix for
about 15 bytes of text.

1. *Filter.* Each task sorts the hashes of its anchors' pieces and sends each once to a range of hashes, with the
   document it is in, or a mark that several of the task's documents hold it. What only one document holds can't repeat.
   Ranges are of the hash's lower bits, which are spread evenly; the high bits of anchors are small by choice.
2. *Sort.* Groups of documents (texts packed and compressed) send the suffixes left, with as many bytes before and
   after the anchor as strings have it as theirs. Splitters sampled from anchors cut the leading pieces into ranges. A
   bucket sorts by multikey quicksort: one word of eight bytes after the other, and only among suffixes still equal.
   Equal suffixes are one entry with their smallest document; suffixes with equal pieces but different surroundings are
   cut into their 50-byte strings, which are sorted in the same way. A splitter stands between two different pieces,
   so no pair of strings lies across a boundary, with one exception: a piece that a stated share of sampled documents
   holds would fill a bucket. Its strings are dealt over all buckets one by one, by their own hash.
3. *Answer.* For each suffix of a group the smallest document of each of its strings, where that lies outside the group.
   Groups read their texts again, take for each string the smaller of its own and the answered document, and cut.

A repeated suffix leaves a task or group once, so a passage in a third of all documents costs one entry per group and
not one per document. Groups and hash ranges grow in number with the bytes of text, so a task's memory does not.
Byte strings are compared whole; hashes only choose anchors and throw out what can't match.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.llm.common import materialise, ship_package

LENGTH = 50
PIECE = 20
# Bytes of text that a task works through at once, and that a group of documents holds.
RUN_BYTES = 16 << 20
GROUP_BYTES = 24 << 20
# Documents whose anchors give splitters, at most pieces of each, and the share of them that makes a piece frequent.
SAMPLE_DOCS = 2_048
SAMPLE_PIECES = 16
FREQUENT = 1 / 128
# Strings of a bucket that are sorted at once, but for one piece with more.
STRINGS = 1 << 20
# Rows whose bytes are gathered at once.
_ROWS = 1 << 14
# Positions hashed at once; they have to fit the low bits of a sliding minimum.
_STRIP = 1 << 18
_LOW = np.uint64((1 << 21) - 1)
_HASH_BITS = 48
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                               0xBF58476D1CE4E5B9)]
_NO_ID = np.int64((1 << 63) - 1)  # a null id: larger than all


class Geometry:
    """Lengths that belong together: strings of ``length`` bytes hold ``width`` pieces of ``piece`` bytes each."""

    def __init__(self, length: int = LENGTH, piece: int = PIECE):
        if not 16 <= piece <= length or length - piece > 31:
            raise ValueError("a piece has 16 bytes or more and at most 31 less than the string")
        self.length, self.piece, self.side = length, piece, length - piece
        self.width = self.side + 1
        self.span = self.side + length  # bytes around an anchor that matter: side before, length from it on
        self.padded = -(-(self.span + 2) // 8) * 8  # the last two bytes say which strings a row has

    def piece_hashes(self, buf: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the piece at each position."""
        n = len(buf) - self.piece + 1
        x = np.lib.stride_tricks.as_strided(buf[:8].view("<u8"), (len(buf) - 7,), (1,))
        y = x * _MIX[0]
        y ^= y >> np.uint64(32)
        h = y[:n] * _MIX[1]
        for o in sorted({*range(8, self.piece - 7, 8), self.piece - 8}):
            h += y[o:o + n] * _MIX[2 + o % 2]
            h ^= h >> np.uint64(29)
        h *= _MIX[4]
        h ^= h >> np.uint64(32)
        return h

    def anchors(self, buf: np.ndarray, starts: np.ndarray):
        """Anchors of the strings of several texts that lie one after the other in ``buf`` (``starts`` has their
        beginnings and the end): (position, its text, first string, last string, hash of the piece). The strings with
        one anchor follow each other, as the anchor of the next string is never further left."""
        out = []
        ends = starts[1:]
        for s in range(0, max(len(buf) - self.length + 1, 0), _STRIP):
            strip = buf[s:s + _STRIP + self.length - 1]
            h = self.piece_hashes(strip)
            m = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
            size = 1
            while size * 2 <= self.width:
                m = np.minimum(m[:-size], m[size:])
                size *= 2
            if size < self.width:
                m = np.minimum(m[:size - self.width], m[self.width - size:])
            p = np.arange(s, s + len(m))
            near = slice(np.searchsorted(ends, s, "right"), np.searchsorted(ends, s + len(m) - 1, "right") + 1)
            doc = np.repeat(np.arange(near.start, near.stop), np.diff(np.clip(ends[near], s, s + len(m)), prepend=s))
            fit = p + self.length <= ends[doc]
            if not fit.any():
                continue
            p, doc, a = p[fit], doc[fit], (m & _LOW).astype(np.int64)[fit] + s
            new = np.ones(len(p), bool)
            new[1:] = (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(p)) - 1
            out.append((a[first], doc[first], p[first], p[last], h[a[first] - s]))
        if not out:
            return (*(np.zeros(0, np.int64),) * 4, np.zeros(0, np.uint64))
        a, doc, lo, hi, h = (np.concatenate(x) for x in zip(*out))
        # A strip's last and the next one's first may be the same anchor.
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        return a[first], doc[first], lo[first], hi[np.append(first[1:], len(a)) - 1], h[first]

    def surroundings(self, buf: np.ndarray, a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The bytes of each anchor's strings, the anchor always in the same column, zero elsewhere, and how far
        before the anchor its first and last string begin: (n, padded)."""
        cols = np.arange(self.padded) - self.side
        out = np.empty((len(a), self.padded), np.uint8)
        for s in range(0, len(a), _ROWS):
            part = slice(s, s + _ROWS)
            at = a[part, None] + cols
            own = (at >= lo[part, None]) & (at < hi[part, None] + self.length)
            out[part] = np.where(own, buf[np.clip(at, 0, len(buf) - 1)], np.uint8(0))
        out[:, -2], out[:, -1] = a - lo, a - hi
        return out


def ranks(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of equally long byte rows, a word of eight bytes at a time: their sorted order and, for each
    row, the number of its group of equal rows. Only rows that are equal so far are looked at for the next word."""
    n = len(rows)
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    group, order = np.zeros(n, np.int64), np.arange(n)
    open_ = order
    for k in range(words.shape[1]):
        w = words[open_, k]
        o = np.lexsort((w, group[open_]))
        at, w = open_[o], w[o]
        new = np.ones(len(at), bool)
        new[1:] = (w[1:] != w[:-1]) | (group[at[1:]] != group[at[:-1]])
        begin = np.flatnonzero(new)
        # A group's number is the place of its first row, so numbers keep the order when groups split.
        head = np.zeros(len(at), bool)
        head[0:1] = True
        head[1:] = group[at[1:]] != group[at[:-1]]
        base = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
        inner = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0)) - base
        group[at] += inner
        sizes = np.diff(np.append(begin, len(at)))
        open_ = at[np.repeat(sizes > 1, sizes)]
        if not len(open_):
            break
    return np.argsort(group, kind="stable"), group


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, each stored by byte planes (high bytes of sorted numbers are alike)."""
    import zstandard

    parts = [np.array([len(arrays)], "<i8").tobytes()]
    for x in arrays:
        x = np.ascontiguousarray(x)
        raw = x.view(np.uint8).reshape(len(x), -1).T.tobytes() if x.dtype.itemsize > 1 and len(x) else x.tobytes()
        parts += [np.array([len(raw)], "<i8").tobytes(), x.dtype.str.encode().ljust(8), raw]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpack(blob: bytes) -> list[np.ndarray]:
    import zstandard

    raw, out, at = zstandard.ZstdDecompressor().decompress(blob), [], 8
    for _ in range(int(np.frombuffer(raw, "<i8", 1)[0])):
        size, kind = int(np.frombuffer(raw, "<i8", 1, at)[0]), np.dtype(raw[at + 8:at + 16].decode().strip())
        x = np.frombuffer(raw, np.uint8, size, at + 16)
        out.append(np.ascontiguousarray(x.reshape(kind.itemsize, -1).T).view(kind).ravel()
                   if kind.itemsize > 1 and size else x.view(kind))
        at += 16 + size
    return out


def _runs(batches, run_bytes: int):
    """(ids, texts as bytes) of about ``run_bytes`` together."""
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            t = (t or "").encode("utf-8", "surrogatepass")
            ids.append(_NO_ID if i is None else i)
            texts.append(t)
            size += len(t)
            if size >= run_bytes:
                yield np.array(ids, np.int64), texts
                ids, texts, size = [], [], 0
    if ids:
        yield np.array(ids, np.int64), texts


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    return np.frombuffer(b"".join(texts), np.uint8), starts


def _group_of(ids: np.ndarray, texts: list[bytes], groups: int) -> np.ndarray:
    """The group of each document, by id and text, so that a repeated id is no hot group."""
    crc = np.fromiter((zlib.crc32(t) for t in texts), np.uint64, len(texts))
    x = (ids.astype(np.uint64) ^ (crc << np.uint64(20))) * _MIX[0]
    return ((x >> np.uint64(33)) % np.uint64(groups)).astype(np.int32)


def _by(key: np.ndarray):
    """(value, places that have it) for each value of a key, ascending."""
    o = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.diff(key[o])) + 1
    for part in np.split(o, cuts):
        if len(part):
            yield key[part[0]], part


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, blob = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()),
                                       pa.array(blob, pa.large_binary() if sum(map(len, blob)) > 1 << 30 else pa.binary())],
                                      names=["part", "kind", "blob"])


_ROW = "part int, kind int, blob binary"
_HASHES, _REPLY, _TEXT, _ITEMS = 0, 1, 2, 3


def _dealt(h: np.ndarray) -> np.ndarray:
    """The bits of a hash that are kept, the highest ones last. An anchor has the smallest hash around it, so its highest
    bits are mostly zero: ranges of plain hashes would give a quarter of all anchors to the lowest sixtieth."""
    high = np.uint64(_HASH_BITS - 32)
    h = h >> np.uint64(64 - _HASH_BITS)
    return ((h & np.uint64(0xFFFFFFFF)) << high) | (h >> np.uint64(32))


def _low(dealt: np.ndarray) -> np.ndarray:
    """The 32 of these bits that are spread evenly."""
    return (dealt >> np.uint64(_HASH_BITS - 32)).astype("<u4")


def _suspects(batches, geo: Geometry, groups: int, ranges: int):
    """Hashes of a task's anchors to their range, and what several of its documents hold straight to their groups."""
    for ids, texts in _runs(batches, RUN_BYTES):
        buf, starts = _joined(texts)
        _, doc, _, _, h = geo.anchors(buf, starts)
        h48 = _dealt(h)
        g = _group_of(ids, texts, groups)
        o = np.lexsort((doc, h48))
        h48, doc = h48[o], doc[o]
        keep = np.ones(len(h48), bool)
        keep[1:] = (h48[1:] != h48[:-1]) | (doc[1:] != doc[:-1])
        h48, doc = h48[keep], doc[keep]
        begin = np.flatnonzero(np.append(True, h48[1:] != h48[:-1])) if len(h48) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(begin, len(h48)))
        shared = np.repeat(sizes > 1, sizes)
        out = []
        for k, at in _by(g[doc[shared]]):
            out.append((0, int(k), _reply(ids[doc[shared][at]], h48[shared][at])))
        one, where = h48[begin], np.where(sizes > 1, -1, doc[begin])
        home = (_low(one).astype(np.uint64) * np.uint64(ranges)) >> np.uint64(32)
        for k, at in _by(home.astype(np.int64)):
            used, place = np.unique(where[at], return_inverse=True)  # -1 first where some hash is shared
            if len(used) and used[0] < 0:
                used, place = used[1:], place - 1
            blob = _pack(np.diff(one[at], prepend=np.uint64(0)), place.astype("<i4"), ids[used], g[used])
            out.append((int(k), -1, blob))
        if out:
            # Rows for groups only pass through this exchange; they are dealt over it.
            yield _batch([(p if k < 0 else (k * 7919) % ranges, k, b) for p, k, b in out])


def _reply(ids: np.ndarray, h48: np.ndarray) -> bytes:
    o = np.lexsort((h48, ids))
    return _pack(ids[o], _low(h48[o]))


def _repeated(batches):
    """For a range of hashes: those that documents of several tasks hold, as rows for the documents' groups."""
    hs, docs, gs = [], [], []
    for b in batches:
        through = []
        for kind, blob in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            if kind >= 0:
                through.append((kind, _REPLY, blob))
                continue
            delta, place, ids, g = _unpack(blob)
            hs.append(np.cumsum(delta, dtype=np.uint64))
            known = np.append(ids, _NO_ID)
            docs.append(known[place])
            gs.append(np.append(g, -1)[place])
        if through:
            yield _batch(through)
    if not hs:
        return
    h, doc, g = np.concatenate(hs), np.concatenate(docs), np.concatenate(gs)
    o = np.argsort(h, kind="stable")
    h, doc, g = h[o], doc[o], g[o]
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    same[:-1] |= same[1:]
    same &= g >= 0
    h, doc, g = h[same], doc[same], g[same]
    rows = [(int(k), _REPLY, _reply(doc[at], h[at])) for k, at in _by(g)]
    if rows:
        yield _batch(rows)


def _texts(batches, groups: int):
    """Whole texts to their groups, packed."""
    for ids, texts in _runs(batches, RUN_BYTES):
        g = _group_of(ids, texts, groups)
        rows = []
        for k, at in _by(g):
            mine = [texts[i] for i in at]
            rows.append((int(k), _TEXT, _pack(ids[at], np.array([len(t) for t in mine], "<i8"),
                                              np.frombuffer(b"".join(mine), np.uint8))))
        yield _batch(rows)


def _group(batches):
    """(ids, texts joined, starts, blobs of the other kinds) of a group, documents by id and text."""
    ids, texts, rest, parts = [], [], [], set()
    for b in batches:
        for part, kind, blob in zip(*(b.column(i).to_pylist() for i in range(3))):
            parts.add(part)
            if kind != _TEXT:
                rest.append(blob)
                continue
            i, n, raw = _unpack(blob)
            ids.append(i)
            cut = np.concatenate([[0], np.cumsum(n)])
            raw = raw.tobytes()
            texts += [raw[s:e] for s, e in zip(cut[:-1].tolist(), cut[1:].tolist())]
    if len(parts) > 1:
        raise ValueError("a task got more than one group")
    if not ids:
        return None
    ids = np.concatenate(ids)
    order = sorted(range(len(texts)), key=lambda j: (ids[j], texts[j]))
    buf, starts = _joined([texts[j] for j in order])
    return next(iter(parts)), ids[order], buf, starts, rest


def _first_of(group: np.ndarray, order: np.ndarray, size: int) -> np.ndarray:
    """For each row the first row (in the given order of rows) of its group."""
    first = np.full(size, size, np.int64)
    np.minimum.at(first, group, order)
    return first[group]


def _items(batches, geo: Geometry, buckets: int, splitters: np.ndarray, frequent: set[bytes]):
    """The suffixes of a group that may repeat, each distinct one once with its smallest document, to their buckets."""
    got = _group(batches)
    if got is None:
        return
    me, ids, buf, starts, replies = got
    a, doc, lo, hi, h = geo.anchors(buf, starts)
    if not replies or not len(a):
        return
    rid, rh = (np.concatenate(x) for x in zip(*(_unpack(b) for b in replies)))
    held = np.unique(_pair(rid, rh))
    mine = _pair(ids[doc], _low(_dealt(h)))
    at = np.minimum(np.searchsorted(held, mine), len(held) - 1)
    left = np.flatnonzero(held[at] == mine)
    if not len(left):
        return
    rows = geo.surroundings(buf, a[left], lo[left], hi[left])
    order, group = ranks(rows)
    lead = np.ones(len(left), bool)  # in sorted order; documents ascend within a group, as the sort is stable
    lead[1:] = group[order[1:]] != group[order[:-1]]
    one = order[lead]
    rows, number, first = rows[one], left[one], ids[doc[left[one]]]
    begin, stop = (a - lo)[left[one]], (a - hi)[left[one]]  # strings begin that many bytes before the anchor
    piece = np.ascontiguousarray(rows[:, geo.side:geo.side + geo.piece]).view(f"S{geo.piece}").ravel()
    home = np.searchsorted(splitters, piece, "right") if len(splitters) else np.zeros(len(piece), np.int64)
    often = np.array([p in frequent for p in piece.tolist()], bool) if frequent else np.zeros(len(piece), bool)
    parts = [(rows[~often], begin[~often], stop[~often], first[~often], number[~often], home[~often])]
    if often.any():
        parts.append(_single_strings(geo, rows[often], begin[often], stop[often], first[often], number[often], buckets))
    rows, begin, stop, first, number, home = (np.concatenate(x) for x in zip(*parts))
    out = []
    for k, at in _by(home):
        out.append((int(k), me, _pack(rows[at].ravel(), begin[at].astype("u1"), stop[at].astype("u1"), first[at],
                                      number[at].astype("<u4"))))
    yield _batch(out)


def _pair(ids: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A number for a document of a group and a hash; two that agree by chance only let a suffix through in vain."""
    return (ids.astype(np.uint64) * _MIX[0]) ^ (h.astype(np.uint64) * _MIX[1])


def _single_strings(geo: Geometry, rows, begin, stop, first, number, buckets: int):
    """One entry per string instead of one per anchor, dealt by the string's own hash."""
    n = begin - stop + 1
    row = np.repeat(np.arange(len(rows)), n)
    off = np.repeat(begin, n) - (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    cols = np.arange(geo.padded)
    cut = np.empty((len(row), geo.padded), np.uint8)
    for s in range(0, len(row), _ROWS):
        begins = geo.side - off[s:s + _ROWS, None]
        cut[s:s + _ROWS] = np.where((cols >= begins) & (cols < begins + geo.length), rows[row[s:s + _ROWS]], np.uint8(0))
    cut[:, -2] = cut[:, -1] = off
    mixed = (np.ascontiguousarray(cut).view("<u8") * _MIX[0]) >> np.uint64(17)
    weights = np.array([pow(0x9E3779B1, k + 1, 1 << 61) | 1 for k in range(mixed.shape[1])], np.uint64)
    home = ((mixed * weights).sum(1, dtype=np.uint64) >> np.uint64(24)) % np.uint64(buckets)
    return cut, off, off, first[row], number[row], home.astype(np.int64)


def _answers(batches, geo: Geometry, groups: int):
    """A bucket of suffixes: the smallest document of each string, to the groups whose own is larger."""
    cols, origin = [], []
    for b in batches:
        for g, blob in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            rows, begin, stop, first, number = _unpack(blob)
            cols.append((rows.reshape(-1, geo.padded), begin, stop, first, number))
            origin.append(np.full(len(begin), g, np.int32))
    if not cols:
        return
    rows, begin, stop, first, number = (np.concatenate(x) for x in zip(*cols))
    origin = np.concatenate(origin)
    # Equal suffixes: one entry, its smallest document.
    order, same = ranks(rows)
    least = np.full(len(rows), _NO_ID)
    np.minimum.at(least, same, first)
    heads = np.flatnonzero(_first_of(same, np.arange(len(rows)), len(rows)) == np.arange(len(rows)))
    # Suffixes that share the piece but not all around it: their strings are sorted too.
    piece = np.zeros((len(heads), -(-geo.piece // 8) * 8), np.uint8)
    piece[:, :geo.piece] = rows[heads, geo.side:geo.side + geo.piece]
    _, kin = ranks(piece)
    several = np.bincount(kin, minlength=len(heads))[kin] > 1
    out = [_tuples(origin, number, first, least[same], _masks(begin, stop))]
    cut, kin = heads[several], kin[several]
    o = np.argsort(kin, kind="stable")
    cut, kin = cut[o], kin[o]
    # Some pieces at a time, so that their strings fit in memory.
    strings = np.cumsum(begin[cut].astype(np.int64) - stop[cut] + 1)
    at = 0
    while at < len(cut):
        stop_at = np.searchsorted(strings, (strings[at - 1] if at else 0) + STRINGS, "right")
        stop_at = np.searchsorted(kin, kin[min(max(stop_at, at + 1), len(cut)) - 1], "right")
        out.append(_within(geo, rows, begin, stop, first, number, origin, same, least, cut[at:stop_at], kin[at:stop_at]))
        at = stop_at
    g, number, best, mask = (np.concatenate(x) for x in zip(*out))
    found = []
    for k, at in _by(g):
        o = at[np.argsort(number[at], kind="stable")]
        found.append((int(k), _ITEMS, _pack(number[o], best[o], mask[o])))
    if found:
        yield _batch(found)


def _masks(begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A bit for each string from ``stop`` to ``begin`` bytes before the anchor."""
    b, s = begin.astype(np.uint64), stop.astype(np.uint64)
    return ((np.uint64(1) << (b + np.uint64(1))) - (np.uint64(1) << s)).astype("<u4")


def _tuples(origin, number, first, best, mask):
    less = best < first
    return origin[less], number[less], best[less], mask[less]


def _within(geo, rows, begin, stop, first, number, origin, same, least, cut, kin):
    """Answers string by string for distinct suffixes ``cut`` that share a piece with others."""
    n = begin[cut].astype(np.int64) - stop[cut] + 1
    row = np.repeat(np.arange(len(cut)), n)
    off = np.repeat(begin[cut].astype(np.int64), n) - (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    # A string is told by the piece, its place in the string, and the bytes before and after the piece.
    side = np.concatenate([np.arange(geo.side), np.arange(geo.side + geo.piece, geo.span)])
    width = -(-geo.side // 8) * 8
    keys = np.zeros((len(row), 8 + width), np.uint8)
    keys[:, :8] = ((kin[row] << 8) | off).astype(">u8").view(np.uint8).reshape(-1, 8)
    around = rows[cut][:, side]
    for s in range(0, len(row), _ROWS):
        r, o = row[s:s + _ROWS], off[s:s + _ROWS]
        at = np.arange(geo.side)[None, :] + geo.side - o[:, None]
        keys[s:s + _ROWS, 8:8 + geo.side] = np.take_along_axis(around[r], at, 1)
    _, group = ranks(keys)
    best = np.full(len(row), _NO_ID)
    np.minimum.at(best, group, least[same[cut]][row])
    best = best[group]
    better = best < least[same[cut]][row]  # else the suffix's own answer says it
    row, off, best = row[better], off[better], best[better]
    # One bit mask per suffix and answer.
    o = np.lexsort((best, row))
    row, off, best = row[o], off[o], best[o]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (best[1:] != best[:-1])
    begin_ = np.flatnonzero(new)
    if not len(begin_):
        return origin[:0], number[:0], first[:0], np.zeros(0, "<u4")
    mask = np.bitwise_or.reduceat(np.uint64(1) << off.astype(np.uint64), begin_).astype("<u4")
    row, best = row[begin_], best[begin_]
    # To every group that sent the suffix.
    of = same[cut][row]
    members = np.argsort(same, kind="stable")
    lo, hi = np.searchsorted(same[members], of, "left"), np.searchsorted(same[members], of, "right")
    times = hi - lo
    src = np.repeat(np.arange(len(row)), times)
    who = members[np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
    return _tuples(origin[who], number[who], first[who], best[src], mask[src])


def _cut(batches, geo: Geometry):
    """The documents of a group without the repeated bytes: (id, kept, n_bytes, spans)."""
    got = _group(batches)
    if got is None:
        return
    _, ids, buf, starts, answers = got
    a, doc, lo, hi, h = geo.anchors(buf, starts)
    gone = np.zeros(len(buf) + 1, np.int8)
    if len(a):
        number, best, mask = ((np.concatenate(x) for x in zip(*(_unpack(b) for b in answers))) if answers
                              else (np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.uint32)))
        number = number.astype(np.int64)
        order = np.argsort(h, kind="stable")
        twin = np.zeros(len(h), bool)
        twin[order[1:]] = h[order[1:]] == h[order[:-1]]
        twin[order[:-1]] |= h[order[1:]] == h[order[:-1]]
        twin[number] = True
        left = np.flatnonzero(twin)
        if len(left):
            _, same = ranks(geo.surroundings(buf, a[left], lo[left], hi[left]))
            # Documents ascend with their anchors, so a group's first anchor is in its smallest document.
            lead = _first_of(same, np.arange(len(left)), len(left))
            first, own = ids[doc[left[lead]]], ids[doc[left]]
            # Answers by the first anchor of their suffix; the row after them stands for suffixes without any.
            answered, row = np.unique(np.searchsorted(left, number), return_inverse=True)
            table = np.full((len(answered) + 1, geo.width), _NO_ID)
            slot = np.full(len(left), len(answered))
            slot[answered] = np.arange(len(answered))
            off = np.arange(geo.width)
            for k in off:
                on = (mask >> np.uint32(k)) & 1 == 1
                np.minimum.at(table[:, k], row[on], best[on])
            for s in range(0, len(left), _ROWS):
                part = slice(s, s + _ROWS)
                at = a[left[part]]
                inside = (off <= (at - lo[left[part]])[:, None]) & (off >= (at - hi[left[part]])[:, None])
                least = np.minimum(first[part, None], table[slot[lead[part]]])
                r, o = np.nonzero(inside & (least < own[part, None]))
                gone[at[r] - o] += 1
                gone[at[r] - o + geo.length] -= 1
    gone = np.cumsum(gone[:-1], dtype=np.int8) > 0
    kept = buf[~gone]
    ends = np.zeros(len(buf) + 1, np.int32)
    np.cumsum(~gone, out=ends[1:])
    ends = ends[starts]
    # Runs of removed bytes; one that goes on over a document's end is two.
    edge = np.zeros(len(buf) + 1, bool)
    edge[starts] = True
    before = np.concatenate([[False], gone])
    after = np.concatenate([gone, [False]])
    span_lo = np.flatnonzero(after & (~before | edge))
    span_hi = np.flatnonzero(before & (~after | edge))
    owner = np.searchsorted(starts, span_lo, "right") - 1
    counts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(ids)))])
    spans = pa.StructArray.from_arrays([pa.array(span_lo - starts[owner]), pa.array(span_hi - starts[owner])],
                                       names=["start", "stop"])
    out = pa.RecordBatch.from_arrays(
        [pa.array(ids, mask=ids == _NO_ID),
         pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends.astype("<i4").tobytes()),
                                                       pa.py_buffer(kept.tobytes())]),
         pa.array(np.diff(starts)), pa.ListArray.from_arrays(pa.array(counts.astype("<i4")), spans)],
        names=["id", "kept", "n_bytes", "spans"])
    for s in range(0, out.num_rows, 1_000):
        yield out.slice(s, 1_000)


def _sample(rows: DataFrame, geo: Geometry, n_docs: int, buckets: int) -> tuple[np.ndarray, set[bytes]]:
    """Splitters of the leading pieces, and the frequent pieces, from a bounded number of documents."""
    every = max(1, n_docs // SAMPLE_DOCS)

    def run(batches):
        for ids, texts in _runs(batches, RUN_BYTES):
            buf, starts = _joined(texts)
            a, doc, _, _, h = geo.anchors(buf, starts)
            # The smallest hashes of a document: a piece that two documents share is then likely taken from both.
            o = np.lexsort((h, doc))
            nth = np.arange(len(o)) - np.searchsorted(doc[o], doc[o], "left")
            a = a[o[nth < SAMPLE_PIECES]]
            if len(a):
                raw = [buf[i:i + geo.piece].tobytes() for i in a.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], names=["piece"])

    some = rows.where(F.expr(f"pmod(xxhash64(id, 'sample'), {every}) = 0")).mapInArrow(run, "piece binary")
    counts = {bytes(r["piece"]): r["n"] for r in some.groupBy("piece").agg(F.count("*").alias("n")).collect()}
    sampled = max(1, n_docs // every)
    frequent = {p.rstrip(b"\0") for p, n in counts.items() if n >= max(8, sampled * FREQUENT)}  # as numpy reads them
    pieces = np.sort(np.array([p for p in counts if p.rstrip(b"\0") not in frequent], f"S{geo.piece}"))
    if not len(pieces):
        return pieces, frequent
    return np.unique(pieces[(np.arange(1, buckets) * len(pieces)) // buckets]), frequent


def remove_repeats(docs: DataFrame, length: int = LENGTH, piece: int = PIECE, id_col: str = "doc_id",
                   text_col: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(id, kept, n_bytes, spans), a row per input row: the text's UTF-8 bytes that are left, the number of bytes it
    had, and the removed runs as half-open intervals of byte positions in ascending order.

    A byte is removed if a string of ``length`` bytes that covers it also starts in a document with a smaller id;
    strings are judged on the input, never cross documents, and may overlap. Null text: no bytes. Ids are integers;
    a null id counts as larger than every other. Rows with the same id do not remove each other's bytes, so repeated
    rows have equal results. Texts shorter than ``length`` are kept whole; a very long text is one row of its group.
    An empty table gives an empty one; other columns are not read. ``piece`` is the length of the hashed pieces:
    longer ones let fewer chance matches through the filter and mean more anchors; results are the same.
    """
    spark = docs.sparkSession
    ship_package(spark)
    geo = Geometry(length, piece)
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"ids are integers, not {kind}")
    n_docs, n_bytes = rows.agg(F.count("*"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (n_bytes or 0) // group_bytes + 1)
    splitters, frequent = _sample(rows, geo, n_docs, groups)

    def suspects(batches):
        return _suspects(batches, geo, groups, groups)

    def items(batches):
        return _items(batches, geo, groups, splitters, frequent)

    def answers(batches):
        return _answers(batches, geo, groups)

    def cut(batches):
        return _cut(batches, geo)

    def texts(batches):
        return _texts(batches, groups)

    replies = materialise(rows.mapInArrow(suspects, _ROW).repartitionById(groups, F.col("part"))
                          .mapInArrow(_repeated, _ROW), "suffix-suspects")
    found = materialise(rows.mapInArrow(texts, _ROW).union(replies).repartitionById(groups, F.col("part"))
                        .mapInArrow(items, _ROW).repartitionById(groups, F.col("part"))
                        .mapInArrow(answers, _ROW), "suffix-answers")
    out = (rows.mapInArrow(texts, _ROW).union(found).repartitionById(groups, F.col("part"))
           .mapInArrow(cut, "id bigint, kept binary, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>"))
    return out.select(F.col("id").cast(kind).alias(id_col), "kept", "n_bytes", "spans")


def digests(removed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What is removed and left of each document in numbers."""
    return removed.selectExpr(
        f"`{id_col}`", "n_bytes", "n_bytes - octet_length(kept) as n_removed", "cast(size(spans) as bigint) as n_spans",
        "sha2(kept, 256) as kept_sha256")
