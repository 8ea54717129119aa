"""Removal of passages that an earlier document has: every byte covered by a string of `length` bytes that also starts
in a document with a smaller id.

Not all suffixes are sorted, only sampled ones. Of the k-byte strings within a window of `length` bytes the one of least
hash is the window's anchor; equal windows have equal anchors at equal places, so only windows of equal anchors need
comparing. Neighbouring windows of one anchor make a cell. A suffix that occurs again with all of its cell needs no place
of its own in the sorted order: cells of equal anchor whose bytes have equal BLAKE2b digests count as one, which the
smallest id keeps. Where different cells of one anchor may share a window, as they do at the edges of what is shared,
their suffixes from the anchor on are sorted by merging, two suffixes being compared through the longest common
extension, which binary search over prefix polynomial hashes finds in logarithmic time. Neighbours' common prefixes then
tell which windows agree to the right of the anchor, hashes which agree to the left, and the bytes are compared before
anything is removed. So no polynomial hash removes a byte by itself.
"""

from __future__ import annotations

import hashlib
from functools import cmp_to_key
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import hot_join
from .common import map_batches, row_number, steady, whole_text, written

LENGTH, K = 50, 16
SPAN = LENGTH - K + 1  # k-byte strings in a window
HALF = (LENGTH - K) // 2  # a window reaches so far to the left of its anchor, or further than that to its right
#: Text that a map task samples at once, and cells that a task compares at once.
AT_ONCE, CELLS_AT_ONCE = 2 << 20, 20_000
#: Text whose cells one task settles, about; and open cells that one compares.
TASK_BYTES, TASK_CELLS = 16 << 20, 100_000
#: Open cells of one place that are sorted in one task, at some 2.5 KB each with the hashes of their prefixes; of larger
#: places, windows are compared by their digests, spread over tasks.
LARGE_GROUP = 4096
#: Bytes of a digest that tells cells apart.
DIGEST = 12

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype="u8") * _U(2) + _U(1)
_powers: list[np.ndarray] = [np.ones(1, dtype="u8"), np.ones(1, dtype="u8")]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        for k, x in enumerate((_BASE, _INVERSE)):
            step = np.full(n, x, dtype="u8")
            step[0] = 1
            _powers[k] = np.multiply.accumulate(step)
    return _powers[0][:n], _powers[1][:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(29))


class Hashed:
    """Prefix polynomial hashes of a buffer: the hash of any stretch in constant time, wherever it stands."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _power(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, dtype="u8")
        np.cumsum(_VALUE[data] * up[:-1], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.prefix[end] - self.prefix[start]) * self.down[start])


def digests(data: bytes, starts: list[int], ends: list[int]) -> np.ndarray:
    """BLAKE2b of each stretch, as d0 (8 bytes) and d1 (4)."""
    view, one = memoryview(data), hashlib.blake2b
    return np.frombuffer(b"".join([one(view[s:e], digest_size=DIGEST).digest() for s, e in zip(starts, ends)]), dtype=[("d0", "<u8"), ("d1", "<u4")])


def cells(data: np.ndarray, edges: np.ndarray) -> dict[str, np.ndarray]:
    """The cells of documents that stand one after another in data, from edges[i] to edges[i + 1].

    doc, a, b (first and last window), p (anchor), key (its hash), d0 and d1 (digest of the bytes), left and right (hashes
    of what surrounds the anchor by HALF bytes on one side; 0 where no window reaches that far).
    """
    n = len(data) - LENGTH + 1
    none = {k: np.zeros(0, dtype="u8") for k in ("doc", "a", "b", "p", "key", "d0", "d1", "left", "right")}
    if n <= 0:
        return none
    hashed = Hashed(data)
    starts = np.arange(len(data) - K + 1)
    grams = hashed.of(starts, starts + K)
    # High bits of the hash, then the place: of equal ones the leftmost is the least.
    bits = _U(len(data).bit_length())
    least = (grams >> bits << bits) | starts.astype("u8")
    for step in (1, 2, 4, 8, 16, SPAN - 32):
        least = np.minimum(least[step:], least[:-step])
    where = (least & ((_U(1) << bits) - _U(1))).astype("i4")
    doc = np.repeat(np.arange(len(edges) - 1), np.diff(edges))[:n]
    whole = np.arange(n) + LENGTH <= edges[doc + 1]
    window = np.flatnonzero(whole)
    if not len(window):
        return none
    anchor, owner = where[window], doc[window]
    new = np.ones(len(window), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    a, b, p = window[first], window[np.append(first[1:], len(window)) - 1], anchor[first].astype("i8")
    left, right = np.zeros(len(a), dtype="u8"), np.zeros(len(a), dtype="u8")
    far = a <= p - HALF
    left[far] = hashed.of(p[far] - HALF, p[far] + K) | _U(1)
    far = b + LENGTH >= p + K + HALF
    right[far] = hashed.of(p[far], p[far] + K + HALF) | _U(1)
    told = digests(data.tobytes(), a.tolist(), (b + LENGTH).tolist())
    return {"doc": owner[first], "a": a, "b": b, "p": p, "key": grams[p], "d0": told["d0"].astype("u8"), "d1": told["d1"].astype("u8"), "left": left, "right": right}


_PARTS = (("high", "u4"), ("low", "u2"), ("d0", "u8"), ("d1", "u4"), ("left", "u1"), ("right", "u1"), ("doc", "u2"), ("p", "u4"), ("before", "u1"), ("after", "u1"))


def _short(x: np.ndarray) -> tuple[int, int, bytes]:
    """Base, width and bytes of whole numbers, in four bytes each above their least where that is enough."""
    base = int(x.min())
    width = 4 if int(x.max()) - base < 1 << 32 else 8
    return (base, 4, (x - base).astype("u4").tobytes()) if width == 4 else (0, 8, x.astype("i8").tobytes())


def _packed(rows: dict[str, np.ndarray], ords: np.ndarray, keys: np.ndarray) -> bytes:
    (a, m, o), (b, n, k) = _short(ords), _short(keys)
    return b"".join([np.array([len(rows["p"]), len(ords), a, m, b, n], dtype="i8").tobytes(), o, k, *(rows[n].astype(t).tobytes() for n, t in _PARTS)])


def _unpacked(blob: bytes) -> dict[str, np.ndarray]:
    n, docs, a, m, b, w = np.frombuffer(blob, dtype="i8", count=6).tolist()
    at, out, ends = 48, {}, []
    for base, width in ((a, m), (b, w)):
        ends.append(np.frombuffer(blob, dtype=f"u{width}" if width == 4 else "i8", count=docs, offset=at).astype("i8") + base)
        at += width * docs
    for name, kind in _PARTS:
        out[name] = np.frombuffer(blob, dtype=kind, count=n, offset=at)
        at += out[name].nbytes
    return out | {"ord": ends[0][out["doc"]], "row": ends[1][out["doc"]]}


def _stretches(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of each row that touch or overlap, merged."""
    order = np.lexsort((starts, rows))
    rows, starts, ends = rows[order], starts[order], ends[order]
    if not len(rows):
        return rows, starts, ends
    # Rows are set apart by an offset, so that one running maximum serves all.
    number = np.cumsum(np.append(True, rows[1:] != rows[:-1])) - 1
    apart = int(ends.max()) + 2
    reach = np.maximum.accumulate(ends + number * apart)
    new = np.append(True, starts[1:] + number[1:] * apart > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1
    return rows[first], starts[first], reach[last] - number[last] * apart


_SETTLED = "bucket int, blob binary"


def _sampled(batches, buckets: int):
    """Cells as blobs by bucket. Of cells with equal anchor and content only the one of the smallest id is sent on; the
    others are settled here, and sent as stretches with the bucket's number below zero."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def sent():
        data = np.frombuffer(b"".join(t for *_, t in held), dtype="u1")
        edges = np.concatenate([[0], np.cumsum([len(t) for *_, t in held])])
        ords, keys = (np.array([h[k] for h in held], dtype="i8") for k in (0, 1))
        starts = np.array([h[3] for h in begins], dtype="i8")
        found = cells(data, edges)
        doc = found["doc"].astype("i8")
        ord_of = ords[doc]
        order = np.lexsort((ord_of, found["d1"], found["d0"], found["key"]))
        same = np.zeros(len(order), dtype=bool)
        k, c, d = (found[n][order] for n in ("key", "d0", "d1"))
        same[1:] = (k[1:] == k[:-1]) & (c[1:] == c[:-1]) & (d[1:] == d[:-1])
        group = np.cumsum(~same) - 1
        least = ord_of[order][~same][group] if len(order) else ord_of
        later = order[ord_of[order] > least]
        shift = edges[doc] - starts[doc]  # a text's place in the buffer, less that of the buffer's part in the text
        if len(later):
            rows, s, e = _stretches(keys[doc[later]], found["a"][later] - shift[later], found["b"][later] + LENGTH - shift[later])
            yield -1 - int(keys[0] % buckets), np.stack([rows, s, e]).astype("i8").tobytes()
        keep = np.sort(order[ord_of[order] == least])
        rows = {n: x[keep] for n, x in found.items()}
        p = rows["p"].astype("i8")
        rows |= {"high": rows["key"] >> _U(16) & _U(0xFFFFFFFF), "low": rows["key"] & _U(0xFFFF), "left": rows["left"] >> _U(56) | (rows["left"] > 0), "right": rows["right"] >> _U(56) | (rows["right"] > 0), "before": p - rows["a"].astype("i8"), "after": rows["b"].astype("i8") + LENGTH - p - K, "p": p - shift[keep]}
        bucket = (rows["key"] >> _U(48)).astype("i8") % buckets
        by = np.argsort(bucket, kind="stable")
        for part in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1) if len(by) else ():
            used, at = np.unique(rows["doc"][part], return_inverse=True)
            used = used.astype("i8")
            yield int(bucket[part[0]]), _packed({n: rows[n][part] for n, _ in _PARTS} | {"doc": at.reshape(-1)}, ords[used], keys[used])

    begins: list = []

    def flushed():
        nonlocal held, begins, size
        out = list(sent()) if held else []
        held, begins, size = [], [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["bucket", "blob"])

    for batch in batches:
        for ord_, key, text in zip(batch.column("ord").to_pylist(), batch.column("row").to_pylist(), batch.column("text")):
            data = text.as_py()
            # A very long text is sampled in parts; each part has the windows that start in it.
            for start in range(0, max(1, len(data) - LENGTH + 1), AT_ONCE):
                part = data[start : start + AT_ONCE + LENGTH - 1]
                held.append((ord_, key, part))
                begins.append((0, 0, 0, start))
                size += len(part)
                if size >= AT_ONCE or len(held) >= 60_000:
                    yield from flushed()
    yield from flushed()


_STATE = "kind int, row long, ord long, a long, p long, e long, place long"


def _settled(batches):
    """kind 0: stretches to remove. kind 1 and 2: cells that agree with a different cell on HALF bytes to the left (1) or
    right (2) of an anchor; place is the same for cells that agree so."""
    from collections import defaultdict

    blobs: dict[int, list[dict]] = defaultdict(list)
    names = [x.split()[0] for x in _STATE.split(", ")]

    def rows(kind, row, ord_, a, p, e, place):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(row), kind, dtype="i4")), *(pa.array(np.asarray(x).astype("i8")) for x in (row, ord_, a, p, e, place))], names)

    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist()):
            if bucket >= 0:
                blobs[bucket].append(_unpacked(blob))
            else:
                row, s, e = np.frombuffer(blob, dtype="i8").reshape(3, -1)
                zero = np.zeros(len(row), dtype="i8")
                yield rows(0, row, zero, s, zero, e, zero)
    for bucket in list(blobs):
        parts = blobs.pop(bucket)
        x = {n: np.concatenate([q[n] for q in parts]) for n in ("high", "low", "d0", "d1", "left", "right", "p", "before", "after", "ord", "row")}
        del parts
        anchor = (x.pop("high").astype("u8") << _U(16)) | x.pop("low")
        order = np.lexsort((x["ord"], x["d1"], x["d0"], anchor))
        anchor, x = anchor[order], {n: v[order] for n, v in x.items()}
        head = np.append(True, anchor[1:] != anchor[:-1])
        group = np.cumsum(head) - 1
        first = np.flatnonzero(head)
        mixed_docs = np.maximum.reduceat(x["ord"], first) > np.minimum.reduceat(x["ord"], first)
        if not mixed_docs.any():
            continue
        sub = head | np.append(True, (x["d0"][1:] != x["d0"][:-1]) | (x["d1"][1:] != x["d1"][:-1]))
        least = x["ord"][sub][np.cumsum(sub) - 1]
        a, e = x["p"].astype("i8") - x["before"], x["p"].astype("i8") + K + x["after"]
        later = x["ord"] > least
        if later.any():
            row, s, t = _stretches(x["row"][later], a[later], e[later])
            zero = np.zeros(len(row), dtype="i8")
            yield rows(0, row, zero, s, zero, t, zero)
        # Different cells can share a window only if they agree in HALF bytes on one side of the anchor.
        cell = np.cumsum(sub) - 1
        for kind, side in ((1, "left"), (2, "right")):
            some = np.flatnonzero((x[side] > 0) & mixed_docs[group] & ~later)
            some = some[np.lexsort((cell[some], x[side][some], anchor[some]))]
            if len(some) < 2:
                continue
            g, h, c, o = anchor[some], x[side][some], cell[some], x["ord"][some]
            start = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (h[1:] != h[:-1])))
            several = (np.maximum.reduceat(c, start) > np.minimum.reduceat(c, start)) & (np.maximum.reduceat(o, start) > np.minimum.reduceat(o, start))
            at = some[np.repeat(several, np.diff(np.append(start, len(some))))]
            if len(at):
                place = _mixed(anchor[at] << _U(16) | _U(bucket % 65536)) ^ (x[side][at].astype("u8") * _U(2) + _U(kind - 1))
                yield rows(kind, x["row"][at], x["ord"][at], a[at], x["p"][at], e[at], place.view("i8"))


# --- cells that differ: sorted suffixes ----------------------------------------------------------------------------

_PRIME, _FACTOR = (1 << 61) - 1, 0x1F3D5B79
_FACTORS = [pow(_FACTOR, k, _PRIME) for k in range(2 * LENGTH + 1)]


class Suffix:
    """What a cell has from its anchor on, with the hashes of its prefixes."""

    __slots__ = ("data", "hashes", "place")

    def __init__(self, data: bytes, place: int) -> None:
        self.data, self.place = data, place
        self.hashes = list(accumulate(data, lambda h, c: (h * _FACTOR + c + 1) % _PRIME, initial=0))


def common_extension(x: Suffix, y: Suffix) -> int:
    """Length of the longest common prefix, by binary search over the hashes of prefixes; checked on the bytes."""
    low, high = 0, min(len(x.data), len(y.data))
    while low < high:
        middle = (low + high + 1) // 2
        if x.hashes[middle] == y.hashes[middle]:
            low = middle
        else:
            high = middle - 1
    while x.data[:low] != y.data[:low]:  # equal hashes of different bytes
        low -= 1
    return low


def _compared(x: Suffix, y: Suffix) -> int:
    n = common_extension(x, y)
    return (x.data[n] if n < len(x.data) else -1) - (y.data[n] if n < len(y.data) else -1)


def sorted_suffixes(suffixes: list[Suffix]) -> tuple[list[Suffix], list[int]]:
    """In order, by merge sort, and each one's common prefix with the one before it (0 for the first)."""
    order = sorted(suffixes, key=cmp_to_key(_compared))
    return order, [0, *(common_extension(x, y) for x, y in zip(order, order[1:]))]


#: The windows, by their bytes before the anchor, that two cells can share if they agree on the left (1) or right (2).
_OFFSETS = {1: (HALF, SPAN - 1), 2: (0, HALF)}


def shared_windows(anchors: np.ndarray, ords: np.ndarray, before: np.ndarray, contents: list[bytes], low: np.ndarray | int = 0, high: np.ndarray | int = SPAN - 1) -> np.ndarray:
    """cells x SPAN: whether the window that starts o bytes before the anchor is also in a cell of a smaller id.

    anchors are equal for cells that are to be compared, for o from low to high.
    """
    low, high = np.broadcast_to(low, len(contents)), np.broadcast_to(high, len(contents))
    n = len(contents)
    out = np.zeros((n, SPAN), dtype=bool)
    by = np.argsort(anchors, kind="stable")
    order, common = [], []
    for part in np.split(by, np.flatnonzero(np.diff(anchors[by])) + 1) if n else ():
        suffixes, lcp = sorted_suffixes([Suffix(contents[i][before[i] :], i) for i in part.tolist()])
        order += [s.place for s in suffixes]
        common += lcp  # 0 at the start of each anchor's suffixes: no class goes across
    order, common = np.array(order, dtype=np.intp), np.array(common)
    data = np.frombuffer(b"".join(contents), dtype="u1")
    base = np.concatenate([[0], np.cumsum([len(c) for c in contents])])[:-1].astype("i8")
    hashed = Hashed(data)
    anchor_at, length = base + before, np.array([len(c) for c in contents], dtype="i8")
    for o in range(SPAN):
        right = LENGTH - o  # from the anchor on
        fits = (before[order] >= o) & (length[order] - before[order] >= right) & (low[order] <= o) & (o <= high[order])
        if not fits.any():
            continue
        klass = np.cumsum(common < right)[fits]
        some = order[fits]
        left = hashed.of(anchor_at[some] - o, anchor_at[some])
        rank = np.lexsort((ords[some], left, klass))
        some, klass, left = some[rank], klass[rank], left[rank]
        head = np.append(True, (klass[1:] != klass[:-1]) | (left[1:] != left[:-1]))
        source = some[head][np.cumsum(head) - 1]
        later = ords[some] > ords[source]
        some, source = some[later], source[later]
        if not len(some):
            continue
        reach = np.arange(LENGTH) - o
        equal = (data[anchor_at[some][:, None] + reach] == data[anchor_at[source][:, None] + reach]).all(axis=1)
        out[some[equal], o] = True
        if not equal.all():  # equal hashes of different bytes: this place is settled by the bytes
            least: dict[bytes, int] = {}
            for i in order[fits].tolist():
                w = data[anchor_at[i] - o : anchor_at[i] - o + LENGTH].tobytes()
                least[w] = min(least.get(w, ords[i]), ords[i])
            for i in order[fits].tolist():
                out[i, o] = least[data[anchor_at[i] - o : anchor_at[i] - o + LENGTH].tobytes()] < ords[i]
    return out


_CONTENTS = "kind int, row long, ord long, a long, before long, place long, content binary, h binary"


def _cut_out(batches):
    """The content of each open cell, as far as the windows reach that it may share; of a large place's cells instead a
    row for each of these windows, with its digest (h)."""
    names = [x.split()[0] for x in _CONTENTS.split(", ")]
    for batch in batches:
        out: list[tuple] = []
        for row, text, asked in zip(batch.column("row").to_pylist(), batch.column("text"), batch.column("asked")):
            data = text.as_py()
            for q in asked.as_py():
                low, high = _OFFSETS[q["kind"]]
                a, e = max(q["a"], q["p"] - high), min(q["e"], q["p"] - low + LENGTH)
                if q["large"]:
                    out += [(q["kind"], row, q["ord"], w, 0, q["place"], None, hashlib.blake2b(data[w : w + LENGTH], digest_size=16).digest()) for w in range(a, e - LENGTH + 1)]
                else:
                    out.append((q["kind"], row, q["ord"], a, q["p"] - a, q["place"], data[a:e], None))
        columns = list(zip(*out)) or [()] * 8
        yield pa.RecordBatch.from_arrays([pa.array(list(columns[0]), pa.int32()), *(pa.array(list(c), pa.int64()) for c in columns[1:6]), *(pa.array(list(c), pa.binary()) for c in columns[6:])], names)


def _removed(table: pa.Table) -> pa.RecordBatch:
    kind, row, ord_, a, before, place = (table.column(c).to_numpy() for c in ("kind", "row", "ord", "a", "before", "place"))
    low, high = (np.where(kind == 1, _OFFSETS[1][k], _OFFSETS[2][k]) for k in (0, 1))
    i, o = np.nonzero(shared_windows(place, ord_, before, table.column("content").to_pylist(), low, high))
    start = a[i] + before[i] - o
    rows, s, e = _stretches(row[i], start, start + LENGTH)
    return pa.RecordBatch.from_arrays([pa.array(x.astype("i8")) for x in (rows, s, e)], ["row", "a", "e"])


def _compared_cells(batches):
    """Cells come in the order of their place, and are compared when all of a place are there."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < CELLS_AT_ONCE:
            continue
        place = batch.column("place").to_numpy()
        ends = np.flatnonzero(place[1:] != place[:-1])
        before = [x for x in held[:-1] if len(x)]
        if len(ends):
            whole, held = [*held[:-1], batch.slice(0, ends[-1] + 1)], [batch.slice(ends[-1] + 1)]
        elif before and before[-1].column("place")[-1] != batch.column("place")[0]:
            whole, held = held[:-1], [batch]
        else:
            continue
        yield _removed(pa.Table.from_batches(whole))
    if held:
        yield _removed(pa.Table.from_batches(held))


def _stripped(batches, keep_text: bool):
    for batch in batches:
        out: list[tuple] = []
        for text, cut in zip(batch.column("text"), batch.column("cut").to_pylist()):
            data, at, kept, spans = text.as_py(), 0, [], 0
            merged: list[list[int]] = []
            for s, e in sorted((x["a"], x["e"]) for x in cut or ()):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            for s, e in merged:
                kept.append(data[at:s])
                at, spans = e, spans + 1
            rest = b"".join([*kept, data[at:]])
            out.append((len(data), len(data) - len(rest), spans, hashlib.sha256(rest).hexdigest(), rest if keep_text else None))
        columns = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(list(c), pa.int64()) for c in columns[:3]), pa.array(list(columns[3]), pa.string()), pa.array(list(columns[4]), pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """One row per input row: id_col, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left).

    id_col must be of a whole-number type: ids of other types have no order that is told here, and are refused. Texts
    are UTF-8 bytes, null counting as empty; texts of under LENGTH bytes lose nothing. Rows of equal id never take from
    each other, so repeated rows fare alike; a null id comes after all others. An empty table gives none. A very long
    text is sampled AT_ONCE bytes at a time. Cells of one anchor that differ meet in one task as some 50 bytes each; of
    those that agree around it more than LARGE_GROUP are compared by the digests of their windows, in many tasks.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_col} is {kind}; which document is earlier is told by a whole number")
    last = F.lit((1 << 63) - 1)
    rows = steady(docs).select(row_number().alias("row"), F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), last).alias("ord"), whole_text(text_col).cast("binary").alias("text"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(width, -(-total // TASK_BYTES))

    sampled = map_batches(rows.select("row", "ord", "text"), lambda batches: _sampled(batches, 2 * parts), _SETTLED).repartition(parts, "bucket")
    state = written(map_batches(sampled, _settled, _STATE), "suffix-cells")

    opened = state.where("kind > 0")
    sizes = written(opened.groupBy("place").agg(F.count(F.lit(1)).alias("n")), "suffix-places")
    n_opened = sizes.agg(F.sum("n")).first()[0] or 0
    tagged = hot_join(opened, sizes.where(F.col("n") > LARGE_GROUP), ["place"], "n", "left").withColumn("large", F.col("n").isNotNull())
    asked = tagged.groupBy("row").agg(F.collect_list(F.struct("kind", "ord", "a", "p", "e", "place", "large")).alias("asked"))
    texts = rows.select("row", "id", "text")
    contents = written(map_batches(texts.select("row", "text").join(asked.hint("shuffle_hash"), "row").select("row", "text", "asked"), _cut_out, _CONTENTS), "suffix-contents")

    by_place = contents.where("h is null").drop("h").repartition(max(width, -(-n_opened // TASK_CELLS)), "place").sortWithinPartitions("place")
    windows = contents.where("h is not null").select("place", "h", "row", "ord", "a")
    first = windows.groupBy("place", "h").agg(F.min("ord").alias("least"), F.max("ord").alias("most"), F.count(F.lit(1)).alias("n")).where("most > least").drop("most")
    gone = hot_join(windows, written(first, "suffix-firsts"), ["place", "h"], "n").where("ord > least").select("row", "a", (F.col("a") + LENGTH).alias("e"))
    cut = state.where("kind = 0").select("row", "a", "e").union(map_batches(by_place, _compared_cells, "row long, a long, e long")).union(gone)
    cuts = cut.groupBy("row").agg(F.collect_list(F.struct("a", "e")).alias("cut"))
    whole = texts.join(cuts.hint("shuffle_hash"), "row", "left").select("id", "text", "cut")
    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    found = map_batches(whole, lambda batches: _stripped(batches, keep_text), schema).withColumnRenamed("id", id_col)
    return found if keep_text else found.drop("kept")
