"""Exact removal of long repeated byte strings by a hash-compared suffix sort.

Every window of ``length`` bytes holds one anchor: the place of its smallest
64-byte gram, the leftmost of equal ones. The choice depends on the window alone,
so equal windows have equal anchors, and only anchored suffixes need sorting:

1. Anchors of all texts, with a 128-bit hash of their context (all bytes of all
   windows that hold the anchor).
2. Anchors whose gram occurs once cover nothing. Equal contexts are repeated
   as a whole. Both follow from counts that Spark pre-aggregates.
3. Anchors that share a gram but not the context are sorted as suffixes, forwards
   and backwards, by a mergesort that compares two suffixes by binary search over
   polynomial prefix hashes. Neighbours give the longest extensions of each anchor
   on either side. Where the two sides come from different partners, the hashes of
   the windows themselves decide. What hashes call equal here is compared byte by
   byte; equal contexts (2) and hot grams (4) are judged by their hashes alone.
4. A gram with very many different contexts is not gathered: hashes of its windows
   are counted by Spark, in ranges first, then singly where a range is undecided.
5. Spans are merged per document and cut out.

Texts are bytes of UTF-8; null and empty texts have none. Strings are judged on
the input, overlaps count, and a repeat may lie in the same text. Rows with equal
id and text are separate texts and cover each other, also where the id is null. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from . import ragged
from .pieces import added

GRAM = 64
U64 = np.uint64
PLACE = 22  # bits for a position within a segment
#: Different contexts of one gram that a task sorts; grams with more are counted by Spark instead.
SORTED = 8_000
#: Bytes of contexts that a task sorts together.
TOGETHER = 2 << 20
#: Texts whose contexts a task cuts at once.
CUT_ROWS = 256


def _anchors(data: np.ndarray, bounds: np.ndarray, length: int) -> np.ndarray:
    """Anchor positions in ``data``; ``bounds`` are n + 1 offsets that windows may not cross."""
    if len(data) < length:
        return np.zeros(0, np.int64)
    h, size, power = ragged.BYTE_VALUE[data], 1, ragged._BASE
    while size < GRAM:
        h = h[:-size] * power + h[size:]
        size, power = 2 * size, U64(int(power) ** 2 % (1 << 64))
    low = ragged.mix(h) & ~U64((1 << PLACE) - 1) | np.arange(len(h), dtype=U64)
    span, size = length - GRAM + 1, 1
    while 2 * size <= span:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    low = np.minimum(low[: len(low) - span + size], low[span - size :]) if span > size else low
    step = np.zeros(len(low) + 1, np.int64)
    for at, count in ((bounds[:-1], 1), (bounds[1:] - length + 1, -1)):
        fits = np.diff(bounds) >= length
        np.add.at(step, at[fits], count)
    low = low[np.cumsum(step[:-1]) > 0]
    at = (low & U64((1 << PLACE) - 1)).astype(np.int64)
    return at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and positions in their row of all anchors of a ragged array of texts."""
    rows, places = [], []
    for low, high in ragged.slices(offsets):
        start, end = int(offsets[low]), int(offsets[high])
        if high - low == 1 and end - start > ragged.SLICE:
            at = [s + _anchors(data[start + s : min(end, start + s + ragged.SLICE + length - 1)], np.array([0, min(end - start - s, ragged.SLICE + length - 1)]), length) for s in range(0, end - start, ragged.SLICE)]
            at = np.unique(np.concatenate(at))
            rows.append(np.full(len(at), low))
            places.append(at)
        else:
            at = _anchors(data[start:end], offsets[low : high + 1] - start, length)
            row = np.searchsorted(offsets[low : high + 1] - start, at, "right") - 1
            rows.append(row + low)
            places.append(at + start - offsets[row + low])
    return np.concatenate(rows), np.concatenate(places)


class Suffixes:
    """Suffixes of a byte array that start at given places, compared by prefix hashes."""

    def __init__(self, data: np.ndarray, at: np.ndarray, size: np.ndarray):
        self.data, self.at, self.size = data, at, size
        self.down = ragged.powers(len(data) + 1)[1]
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(ragged.BYTE_VALUE[data] * ragged.powers(len(data) + 1)[0][:-1], out=self.sums[1:])

    def hashes(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (self.sums[high] - self.sums[low]) * self.down[low]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common start of suffixes i and j, by binary search."""
        a, b = self.at[i], self.at[j]
        low, high = np.zeros(len(i), np.int64), np.minimum(self.size[i], self.size[j])
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = self.hashes(a, a + mid) == self.hashes(b, b + mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def order(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as suffix i sorts before, with or after suffix j."""
        n = self.common(i, j)
        ends = (n == self.size[i]) | (n == self.size[j])
        x = np.where(ends, self.size[i], self.data[np.minimum(self.at[i] + n, len(self.data) - 1)])
        y = np.where(ends, self.size[j], self.data[np.minimum(self.at[j] + n, len(self.data) - 1)])
        return np.sign(x.astype(np.int64) - y.astype(np.int64))

    def sorted(self, counts: np.ndarray) -> np.ndarray:
        """Suffix numbers sorted within groups of the given sizes: a merge sort of all groups together."""
        base = np.repeat(np.cumsum(counts) - counts, counts)
        size = np.repeat(counts, counts)
        out, place = np.arange(len(base)), np.arange(len(base)) - base
        run = 1
        while run < counts.max(initial=0):
            number = place // run
            low = np.minimum((number ^ 1) * run, size)
            high = np.minimum(low + run, size)
            first, start = number % 2 == 0, low.copy()
            while (low < high).any():
                todo = np.flatnonzero(low < high)
                mid = (low[todo] + high[todo]) >> 1
                sign = self.order(out[base[todo] + mid], out[todo])
                less = np.where(first[todo], sign < 0, sign <= 0)
                low[todo] = np.where(less, mid + 1, low[todo])
                high[todo] = np.where(less, high[todo], mid)
            to = base + np.minimum(number, number ^ 1) * run + (place - number * run) + (low - start)
            out[to] = out.copy()
            run *= 2
        return out


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether data[a : a + size] equals data[b : b + size], pair by pair."""
    out = np.zeros(len(size), bool)
    for low, high in ragged.slices(ragged.starts_of(size)):
        n = size[low:high]
        row = ragged.row_of(n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        out[low:high] = np.bincount(row, data[a[low:high][row] + step] != data[b[low:high][row] + step], len(n)) == 0
    return out


def _by_bytes(data: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, members: np.ndarray, one: int, length: int) -> tuple[int, int]:
    """Extents of one context by comparing windows of its group as bytes."""

    def window(i: int, shift: int) -> bytes:
        fits = length - right[i] <= shift <= left[i]
        return data[at[i] - shift : at[i] - shift + length].tobytes() if fits else b""

    hits = [s for s in range(max(0, length - right[one]), min(left[one], length - GRAM) + 1) if any(window(i, s) == window(one, s) for i in members if i != one)]
    return (max(hits), length - min(hits)) if hits else (0, 0)


def extents(data: np.ndarray, ends: np.ndarray, left: np.ndarray, copies: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """How far repeats reach to the left and right of each anchor; 0, 0 if no window is repeated.

    Context i is data[ends[i] : ends[i + 1]], with its anchor ``left[i]`` bytes in. ``counts``
    are the sizes of the groups that share a gram; contexts with several copies are only partners.
    """
    n = len(left)
    at, right = ends[:-1] + left, np.diff(ends) - left
    forward = Suffixes(data, at, right)
    backward = Suffixes(data[::-1], len(data) - at, left)
    group = ragged.row_of(counts)
    best_l, best_r = np.zeros(n, np.int64), np.zeros(n, np.int64)  # longest extension on one side
    got_l, got_r = np.zeros(n, np.int64), np.zeros(n, np.int64)  # longest in a whole window
    partner = np.zeros((2, n), np.int64)
    for suffixes, best in ((forward, best_r), (backward, best_l)):
        order = suffixes.sorted(counts)
        i, j = order[:-1], order[1:]
        same = group[i] == group[j]
        i, j = i[same], j[same]
        for x, y in ((i, j), (j, i)):
            r, l = forward.common(x, y), backward.common(x, y)
            np.maximum.at(best, x, r if best is best_r else l)
            whole = l + r >= length
            for side, got, reach in ((0, got_l, l), (1, got_r, r)):
                more = whole & (reach > got[x])
                got[x[more]] = reach[more]
                partner[side, x[more]] = y[more]
    bad = np.zeros(n, bool)
    for side, got in ((0, got_l), (1, got_r)):
        x = np.flatnonzero(got > 0)
        y = partner[side, x]
        low = np.where(side == 0, got[x], 0)
        bad[x] |= ~_same_bytes(data, at[x] - low, at[y] - low, got[x])
    single = copies == 1
    open_ = single & (best_l + best_r >= length) & ((got_l < best_l) | (got_r < best_r)) | bad
    if open_.any():
        some = np.zeros(len(counts), bool)
        some[group[open_]] = True
        for i in np.flatnonzero(open_):
            got_l[i] = got_r[i] = 0
        members = np.flatnonzero(some[group])
        lo, hi = np.maximum(length - right[members], 0), np.minimum(left[members], length - GRAM)
        size = np.maximum(hi - lo + 1, 0)
        owner = np.repeat(members, size)
        shift = np.repeat(lo, size) + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        key = ragged.mix(forward.hashes(at[owner] - shift, at[owner] - shift + length) + ragged.mix((group[owner] * 1024 + shift).astype(U64)))
        order = np.argsort(key, kind="stable")
        i, j = order[:-1], order[1:]
        same = key[i] == key[j]
        other = np.full(len(owner), -1)  # a window of equal hash
        other[i[same]], other[j[same]] = j[same], i[same]
        hit = np.flatnonzero((other >= 0) & open_[owner])
        np.maximum.at(got_l, owner[hit], shift[hit])
        np.maximum.at(got_r, owner[hit], length - shift[hit])
        ends_ = hit[(shift[hit] == got_l[owner[hit]]) | (length - shift[hit] == got_r[owner[hit]])]
        x, y = owner[ends_], owner[other[ends_]]
        fine = _same_bytes(data, at[x] - shift[ends_], at[y] - shift[ends_], np.full(len(x), length))
        for i in np.unique(x[~fine]):  # a collision of hashes: compare the windows themselves
            got_l[i], got_r[i] = _by_bytes(data, at, left, right, np.flatnonzero(group == group[i]), i, length)
    return got_l, got_r


RANGES = 16


def _contexts(length: int):
    """Cut the contexts of each text's listed anchors; those of hot grams as hashes of ranges and windows."""
    import xxhash

    wide = -(-(length - GRAM + 1) // RANGES)

    def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in ("gram", "id", "text_hash", "pos", "copies", "left", "bytes", "ranges", "windows")}
        for row in range(batch.num_rows):
            text = batch.column(2)[row].as_buffer()
            view = memoryview(text)
            for x in batch.column(3)[row].as_py():
                low, high = max(0, x["pos"] - length + GRAM), min(len(view), x["pos"] + length)
                values = {"gram": x["gram"], "id": batch.column(0)[row].as_py(), "text_hash": batch.column(1)[row].as_py(), "pos": x["pos"], "copies": x["copies"], "left": x["pos"] - low, "bytes": None, "ranges": None, "windows": None}
                if not x["hot"]:
                    values["bytes"] = bytes(view[low:high])
                else:
                    p, first, last = x["pos"], max(0, x["pos"] + length - high), min(x["pos"] - low, length - GRAM)
                    values["windows"] = [xxhash.xxh3_64_intdigest(view[p - o : p - o + length], seed=o) - (1 << 63) for o in range(first, last + 1)]
                    values["ranges"] = [
                        {"range": k, "low": lo, "core": xxhash.xxh3_64_intdigest(view[p - k * wide : p + length - (k + 1) * wide + 1], seed=k) - (1 << 63),
                         "hull": xxhash.xxh3_64_intdigest(view[max(low, p - (k + 1) * wide + 1) : min(high, p + length - k * wide)], seed=lo * 1024 + hi) - (1 << 63), "size": hi - lo + 1, "skip": lo - first}
                        for k in range(RANGES)
                        if (lo := max(k * wide, first)) <= (hi := min((k + 1) * wide - 1, last))
                    ]
                for name, value in values.items():
                    out[name].append(value)
        return pa.RecordBatch.from_pydict(out, schema=handle.schema)

    return handle


def _sorting(length: int):
    """Extents of the contexts of whole grams; rows arrive sorted by gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(table: pa.Table) -> pa.RecordBatch:
            grams = table["gram"].to_numpy()
            data, ends = ragged.packed(table["bytes"].combine_chunks())
            counts = np.diff(np.concatenate((np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))), [len(grams)])))
            copies, pos = table["copies"].to_numpy(), table["pos"].to_numpy()
            left, right = extents(data, ends, table["left"].to_numpy(), copies, counts, length)
            keep = np.flatnonzero((copies == 1) & (left + right >= length))
            take = pa.array(keep)
            return pa.RecordBatch.from_arrays(
                [table["id"].combine_chunks().take(take), table["text_hash"].combine_chunks().take(take), pa.array((pos - left)[keep]), pa.array((pos + right)[keep])],
                ["id", "text_hash", "start", "end"],
            )

        for batch in batches:
            held.append(batch)
            if sum(b.column(6).nbytes for b in held) < TOGETHER:
                continue
            table = pa.Table.from_batches(held)
            grams = table["gram"].to_numpy()
            others = np.flatnonzero(grams != grams[-1])
            if len(others):
                cut = int(others[-1]) + 1
                yield solve(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held and sum(b.num_rows for b in held):
            yield solve(pa.Table.from_batches(held))

    return run


def repeated_spans(texts: DataFrame, length: int) -> DataFrame:
    """id, text_hash, start, end: spans of texts that are covered by repeats; they may overlap."""
    import xxhash

    id_kind = texts.schema["id"].dataType.simpleString()
    reach = length - GRAM

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = ragged.packed(batch.column(2))
        rows, pos = anchors(data, offsets, length)
        at, view = offsets[rows] + pos, memoryview(data)
        low, high = np.maximum(at - reach, offsets[rows]), np.minimum(at + length, offsets[rows + 1])
        spans = list(zip(at.tolist(), low.tolist(), high.tolist(), strict=True))
        gram = np.frombuffer(b"".join(xxhash.xxh3_64_digest(view[a : a + GRAM]) for a, _, _ in spans), np.int64)
        ctx = np.frombuffer(b"".join(xxhash.xxh3_128_digest(view[lo:hi], seed=a - lo) for a, lo, hi in spans), np.int64).reshape(-1, 2)
        take = pa.array(rows)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), pa.array(pos), pa.array(gram), pa.array(ctx[:, 0].copy()), pa.array(ctx[:, 1].copy()), pa.array((at - low).astype(np.int32)), pa.array((high - at).astype(np.int32))],
            ["id", "text_hash", "pos", "gram", "ctx_a", "ctx_b", "left", "right"],
        )

    long = texts.where(F.octet_length("text") >= length)
    found = written(ragged.map_batches(long, lambda: find, f"id {id_kind}, text_hash long, pos long, gram long, ctx_a long, ctx_b long, left int, right int"), "anchors")
    grams = written(found.groupBy("gram").agg(F.count("*").alias("n"), F.min("ctx_a").alias("low"), F.max("ctx_a").alias("high")).where("n > 1").select("gram", (F.col("low") != F.col("high")).alias("mixed")), "grams")
    shared = written(found.join(grams, "gram"), "shared")
    span = [F.col("id"), F.col("text_hash"), (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") + F.col("right")).alias("end")]
    whole = F.col("left") + F.col("right") >= length
    equal = shared.where(~F.col("mixed") & whole).select(*span)
    mixed = shared.where("mixed")
    contexts = mixed.groupBy("gram", "ctx_a", "ctx_b").agg(F.count("*").alias("copies"), F.min(F.struct("pos", "text_hash", "id")).alias("first"))
    contexts = written(contexts, "contexts")
    copied = mixed.join(contexts.where("copies > 1").select("gram", "ctx_a", "ctx_b"), ["gram", "ctx_a", "ctx_b"]).where(whole).select(*span)
    hot = contexts.groupBy("gram").count().where(F.col("count") > SORTED).select("gram", F.lit(True).alias("hot"))
    wanted = contexts.join(hot, "gram", "left").select("first.id", "first.text_hash", F.struct("gram", F.col("first.pos").alias("pos"), F.least("copies", F.lit(2)).cast("int").alias("copies"), F.coalesce("hot", F.lit(False)).alias("hot")).alias("x"))
    wanted = written(wanted.groupBy("id", "text_hash").agg(F.collect_list("x").alias("at")), "wanted")  # anchors of one text
    wanted = wanted.withColumnsRenamed({"id": "_id", "text_hash": "_hash"})
    parts = long.join(wanted, F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))).select("id", "text_hash", F.col("text").cast("binary").alias("text"), "at")
    cut = _contexts(length)
    schema = f"gram long, id {id_kind}, text_hash long, pos long, copies int, left int, bytes binary, ranges array<struct<range:int,low:int,core:long,hull:long,size:int,skip:int>>, windows array<long>"
    cut.schema = _arrow_schema(texts, schema)
    cuts = written(ragged.map_batches(parts, lambda: cut, schema, CUT_ROWS), "cuts")

    in_order = cuts.where("bytes IS NOT NULL").drop("ranges", "windows").repartition("gram").sortWithinPartitions("gram", "pos")
    tied = in_order.mapInArrow(ragged.per_task(_sorting(length)), f"id {id_kind}, text_hash long, start long, end long")
    return equal.union(copied).union(tied).union(_hot_spans(cuts.where("windows IS NOT NULL"), length))


def _arrow_schema(texts: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(texts.sparkSession.createDataFrame([], schema).schema)


def _hot_spans(cuts: DataFrame, length: int) -> DataFrame:
    """Spans of contexts of hot grams, by counts of hashes: of ranges of windows, and of single windows where these differ."""
    key = ["gram", "id", "text_hash", "pos", "copies"]
    ranges = cuts.select(*key, F.explode("ranges").alias("r"), "windows").select(
        *key, "r.range", "r.low", "r.core", "r.hull", "r.size", F.slice("windows", F.col("r.skip") + 1, F.col("r.size")).alias("own")
    )
    on = ["gram", "range", "core"]
    cores = written(ranges.groupBy(*on).agg(F.sum("copies").alias("n"), F.min("hull").alias("a"), F.max("hull").alias("b")).where("n > 1").select(*on, (F.col("a") != F.col("b")).alias("open")), "cores")
    joined = ranges.join(cores, on)
    sure = joined.where("NOT open AND copies = 1").select(*key, F.col("low").alias("first"), (F.col("low") + F.col("size") - 1).alias("last"))
    single = joined.where("open").select(*key, "low", F.posexplode("own").alias("i", "window")).select(*key, (F.col("low") + F.col("i")).alias("shift"), "window")
    again = written(single.groupBy("gram", "shift", "window").agg(F.sum("copies").alias("n")).where("n > 1").drop("n"), "windows")
    hits = single.where("copies = 1").join(again, ["gram", "shift", "window"]).select(*key, F.col("shift").alias("first"), F.col("shift").alias("last"))
    out = sure.union(hits).groupBy("id", "text_hash", "pos").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return out.select("id", "text_hash", (F.col("pos") - F.col("last")).alias("start"), (F.col("pos") - F.col("first") + length).alias("end"))


def remove_repeats(df: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """The frame's rows with ``spans`` (removed runs, as byte ranges) and ``kept`` (remaining bytes).

    With ``as_text`` kept is a string, without the parts of characters that a cut may leave.
    Columns of the input named spans, kept or text_hash are replaced or dropped.
    """
    base = df.drop("spans", "kept", "text_hash").withColumn("text_hash", F.xxhash64(F.coalesce(text_col, F.lit(""))))
    texts = base.select(F.col(id_col).alias("id"), "text_hash", F.coalesce(text_col, F.lit("")).alias("text"))
    found = written(repeated_spans(texts, length).groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    base, found = base.alias("base"), found.alias("found")
    same = F.col(f"base.{id_col}").eqNullSafe(F.col("found.id")) & (F.col("base.text_hash") == F.col("found.text_hash"))
    joined = base.join(found, same, "left").select(*[F.col(f"base.{c}") for c in df.drop("spans", "kept", "text_hash").columns], "found.spans")
    joined = joined.withColumn("kept", F.col(text_col).cast("binary"))
    names, n = joined.columns, len(joined.columns)
    schema = added(joined, "kept", T.StringType() if as_text else T.BinaryType())

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans, kept = [], []
        for span, text in zip(batch.column(n - 2), batch.column(n - 1), strict=True):
            raw = text.as_py() or b""
            merged: list[list[int]] = []
            for x in sorted(((s["start"], s["end"]) for s in span.as_py() or ())):
                if merged and x[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x[1])
                else:
                    merged.append([*x])
            at, parts = 0, []
            for s, e in merged:
                parts.append(raw[at:s])
                at = e
            rest = b"".join([*parts, raw[at:]])
            kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
            spans.append([{"start": s, "end": e} for s, e in merged])
        kind = pa.list_(pa.struct([pa.field("start", pa.int64()), pa.field("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([*batch.columns[: n - 2], pa.array(spans, kind), pa.array(kept, pa.string() if as_text else pa.binary())], names)

    return ragged.map_batches(joined, lambda: cut, schema)


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and a hash of what was kept."""
    size = F.octet_length(F.coalesce(text_col, F.lit(""))).cast("long")
    return df.select(
        id_col,
        size.alias("n_bytes"),
        (size - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def brute_force(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    """The digest by comparing all windows; for tests."""
    raw = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for r in raw:
        for i in range(len(r) - length + 1):
            seen[r[i : i + length]] = seen.get(r[i : i + length], 0) + 1
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out
