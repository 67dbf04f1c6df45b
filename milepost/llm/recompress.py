"""Removal of word passages that an earlier document has, found by recompression.

Recompression replaces runs and pairs of symbols by new symbols, round after round. A symbol's
name is a hash of what it replaces, so every task gives equal runs and pairs the same name all over
the corpus, and whether a pair is replaced depends on the names of its two symbols alone. Hence equal
word sequences have equal symbols inside, whatever stands around them; only some words at either end,
``MARGIN`` after all rounds, can be parsed otherwise.

1. A round names runs of two equal words, then pairs whose first symbol is of the left class and whose
   second is of the right (a bit of the name decides). Longer runs stay as they are: how long they are
   can't be seen from inside a window. After ``ROUNDS`` rounds a symbol covers 8 words at most, so every
   window holds whole symbols that all of its copies have too.
2. The smallest of them (by a hash of its name, the leftmost of equal ones) is the window's anchor, and
   windows with equal words have equal anchors. Going on with pairs, now of blocks of 2, 4, 8 ... words at
   every place, names what surrounds an anchor: its words and ``MARGIN`` on either side (its key), and all
   words of all windows that chose it (its context).
3. Spark counts keys: one that is in no two documents covers nothing, and most fall out here. Equal
   contexts are settled as a whole by the smallest id that has them.
4. One document of each context is left, that with the smallest id. Where a key has several contexts,
   their windows are named and Spark finds the smallest id of each.
5. Windows that an earlier document has are cut out of the texts.

Names that decide about removal have 128 bits; all counts are partial aggregations, and nothing is gathered but
what belongs to one document.

Words are runs of bytes that aren't white space, compared unchanged. Null and empty texts have none. A
document with a null id counts as the last one: it loses what others have, and takes nothing from anyone. Rows
with equal ids take nothing from each other. Windows are judged on the input. Other columns are not read. Ids are integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import ragged

ROUNDS = 2
#: Words at either end of a window whose parse depends on what stands outside: 2 for the runs of a round, and the longest symbol for its pairs.
MARGIN = sum(2 + 2 * 2**r for r in range(ROUNDS))
LONGEST = 2 * 2**ROUNDS
#: Texts are looked up by this many hash slots at most, whose list is broadcast.
SLOTS = 1 << 20
LAST = (1 << 63) - 1
U64 = np.uint64
OTHER_VALUE = ragged.mix(ragged.BYTE_VALUE + U64(0xA0761D6478BD642F))


def pair(a: np.ndarray, b: np.ndarray, salt: int = 0) -> np.ndarray:
    """The name of a symbol that stands for two."""
    return ragged.mix(ragged.mix(a + U64(2 * salt + 1)) * U64(0xD6E8FEB86659FD93) + b)


def recompressed(names: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the symbols after all rounds, and the word each begins with.

    ``edge`` marks the words that begin a document; no symbol goes across.
    """
    start, first = np.arange(len(names)), edge.copy()
    for r in range(ROUNDS):
        size = np.diff(np.append(start, len(edge)))
        like = np.zeros(len(names) + 1, bool)  # symbol i and the one before it: the same word
        like[1:-1] = (names[1:] == names[:-1]) & ~first[1:] & (size[1:] == 1) & (size[:-1] == 1)
        two = like[1:-1] & ~like[:-2] & ~like[2:]  # a run of exactly two
        names, start, first = _merged(names, start, first, two, 4 * r)
        left = ragged.mix(names + U64(r + 101)) >> U64(63) == 0
        names, start, first = _merged(names, start, first, left[:-1] & ~left[1:] & ~first[1:], 4 * r + 1)
    return names, start


def _merged(names, start, first, at: np.ndarray, salt: int):
    """Symbols i and i + 1 become one wherever ``at[i]``; no two places touch."""
    if not len(names):
        return names, start, first
    where = np.flatnonzero(at)
    out = names.copy()
    out[where] = pair(names[where], names[where + 1], salt)
    keep = np.ones(len(names), bool)
    keep[where + 1] = False
    return out[keep], start[keep], first[keep]


class Words:
    """Words of a batch of texts with their names; blocks of 2 ** k words are named by pairs of blocks."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, self.counts = ragged.spans(data, offsets, ragged.NOT_SPACE)
        self.offsets = ragged.starts_of(self.counts)
        self.halves = [ragged.span_hashes(data, starts, ends, v) for v in (ragged.BYTE_VALUE, OTHER_VALUE)]
        self.blocks = [self.halves]

    def block(self, k: int) -> list[np.ndarray]:
        """Both halves of the names of 2 ** k words from every place that has as many after it."""
        while len(self.blocks) <= k:
            step = 1 << (len(self.blocks) - 1)
            self.blocks.append([pair(x[:-step], x[step:], i) if len(x) > step else x[:0] for i, x in enumerate(self.blocks[-1])])
        return self.blocks[k]

    def ranges(self, first: np.ndarray, last: np.ndarray, k: int, pieces: int, half: int) -> np.ndarray:
        """Names of the words first .. last - 1, from their length and evenly spread blocks of 2 ** k words that cover them."""
        block, size = self.block(k)[half], last - first
        out = ragged.mix(size.astype(U64) + U64(half + 11))
        for i in range(pieces):
            out = pair(out, block[first + i * (size - (1 << k)) // (pieces - 1)], half) if len(first) else out
        return out


def anchors(words: Words, length: int) -> tuple[np.ndarray, ...]:
    """Row, first and last word of the windows (up to the end of the last one), and the first and last word of the anchor itself."""
    total = int(words.offsets[-1])
    none = np.zeros(0, np.int64)
    has = np.maximum(words.counts - length + 1, 0)
    if not has.any():
        return none, none, none, none, none
    edge = np.zeros(total, bool)
    edge[words.offsets[:-1][words.counts > 0]] = True
    names, start = recompressed(words.halves[0], edge)
    rank = ragged.mix(names + U64(77))
    begins = np.zeros(total + 1, np.int64)
    begins[start] = 1
    before = np.cumsum(begins) - begins  # symbols that begin before a word
    step = np.arange(int(has.sum()))
    windows = step - np.repeat(np.cumsum(has) - has, has) + np.repeat(words.offsets[:-1], has)
    low = before[windows + MARGIN]
    # Those that end by then: all that begin before it, but for the one that goes on.
    stop = windows + length - MARGIN
    high = before[stop] - (begins[stop] == 0)
    least, chosen, size = np.arange(len(rank)), np.zeros(len(windows), np.int64), 1
    while True:
        todo = np.flatnonzero((high - low >= size) & (high - low < 2 * size))
        a, b = least[low[todo]], least[high[todo] - size]
        chosen[todo] = np.where(rank[a] <= rank[b], a, b)
        if 2 * size > length:
            break
        a, b = least[:-size], least[size:]
        least, size = np.where(rank[a] <= rank[b], a, b), 2 * size
    new = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (windows[1:] != windows[:-1] + 1))))
    end = np.append(new[1:], len(windows)) - 1
    symbol = chosen[new]
    stops = np.append(start[1:], total)
    return np.searchsorted(words.offsets, windows[new], "right") - 1, windows[new], windows[end] + length, start[symbol], stops[symbol]


def _blocks(length: int) -> int:
    return length.bit_length() - 1


def parsed(docs: DataFrame, length: int) -> DataFrame:
    """ord, th, anchors (first and last word, key, context as two halves) of every text that has windows."""

    def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns, counts = [[] for _ in range(5)], []
        data, offsets = ragged.packed(batch.column(2))
        for low, high in ragged.slices(offsets):
            words = Words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            row, first, last, start, stop = anchors(words, length)
            k = _blocks(2 * MARGIN)
            found = (first, last, words.ranges(start - MARGIN, stop + MARGIN, k, 3, 0), *(words.ranges(first, last, _blocks(length), 4, h) for h in (0, 1)))
            found = (first - words.offsets[row], last - words.offsets[row], *found[2:])
            counts.append(np.bincount(row, minlength=high - low))
            for c, x in zip(columns, found, strict=True):
                c.append(x)
        first, last, key, a, b = (np.concatenate(c) for c in columns)
        values = [pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), *[pa.array(x.view(np.int64)) for x in (key, a, b)]]
        ends = pa.array(ragged.starts_of(np.concatenate(counts)).astype(np.int32))
        lists = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(values, ["first", "last", "key", "a", "b"]))
        full = pa.array(np.concatenate(counts) > 0)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["ord", "th", "anchors"]).filter(full)

    return ragged.map_batches(docs, lambda: handle, "ord long, th long, anchors array<struct<first:int,last:int,key:long,a:long,b:long>>")


def named_windows(docs: DataFrame, ranges: DataFrame, length: int) -> DataFrame:
    """ord, th, at, a, b: windows within the ranges (ord, th, first, last) of the texts, with both halves of their names."""
    by_text = ranges.groupBy("ord", "th").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))  # of one text
    by_text = written(by_text, "ranges")
    slot = F.pmod(F.xxhash64("ord", "th"), F.lit(SLOTS)).cast("int")
    slots = by_text.select(slot.alias("slot")).distinct()  # at most SLOTS rows
    own = docs.join(F.broadcast(slots), slot == slots["slot"], "left_semi").dropDuplicates(["ord", "th"])

    def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        data, offsets = ragged.packed(batch.column(2))
        lists = batch.column(3)
        flat, ends = lists.flatten(), ragged.starts_of(lists.value_lengths().to_numpy().astype(np.int64))
        first, last = (flat.field(i).to_numpy().astype(np.int64) for i in (0, 1))
        for low, high in ragged.slices(offsets):
            words = Words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            part = slice(int(ends[low]), int(ends[high]))
            row = ragged.row_of(np.diff(ends[low : high + 1]))
            n = last[part] - first[part] - length + 1
            of = ragged.row_of(n)
            at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + first[part][of]
            place = at + words.offsets[row[of]]
            halves = [words.ranges(place, place + length, _blocks(length), 2, h).view(np.int64) for h in (0, 1)]
            out.append((row[of] + low, at, *halves))
        row, at, a, b = (np.concatenate(x) for x in zip(*out, strict=True))
        ids = [batch.column(i).take(pa.array(row)) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*ids, pa.array(at.astype(np.int32)), pa.array(a), pa.array(b)], ["ord", "th", "at", "a", "b"])

    return ragged.map_batches(own.join(by_text, ["ord", "th"]).select("ord", "th", "text", "ranges"), lambda: handle, "ord long, th long, at int, a long, b long")


def _rows(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    text = F.coalesce(text_col, F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("ord"), F.xxhash64(text).alias("th"), text.alias("text"), *more)


def repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """ord, th, spans (arrays of first and last word) of the texts that have windows of documents with a smaller id.

    ``ord`` is the id, or the largest long for null; ``th`` the xxhash64 of the text.
    """
    if length < 2 * MARGIN + 2 * LONGEST:
        raise ValueError(f"a window of {length} words may hold no whole symbol")
    texts = _rows(docs, id_col, text_col)
    found = written(parsed(texts, length), "anchors").select("ord", "th", F.inline("anchors"))
    keys = found.groupBy("key").agg(F.min("ord").alias("low"), F.max("ord").alias("high")).where("low < high").select("key")
    live = written(found.join(written(keys, "keys"), "key"), "live")
    contexts = written(live.groupBy("key", "a", "b").agg(F.min("ord").alias("least")), "contexts")
    several = written(contexts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "several")
    placed = written(live.join(contexts, ["key", "a", "b"]), "placed")
    whole = placed.where("ord > least").select("ord", "th", "first", "last")
    open_ = placed.where("ord = least").join(several, "key", "left_semi").select("ord", "th", "first", "last")
    windows = written(named_windows(texts, open_, length), "windows")
    least = windows.groupBy("a", "b").agg(F.min("ord").alias("least"), F.max("ord").alias("high")).where("least < high").select("a", "b", "least")
    hits = windows.join(least, ["a", "b"]).where("ord > least").select("ord", "th", F.col("at").alias("first"), (F.col("at") + length).alias("last"))
    return whole.union(hits).groupBy("ord", "th").agg(F.collect_set(F.struct("first", "last")).alias("spans"))  # of one text


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id column, n_words, n_removed, kept (the words that stay, joined by one space) and spans (first and last word of maximal removed passages)."""
    found = written(repeats(docs, length, id_col, text_col), "spans")
    texts = _rows(docs, id_col, text_col, F.col(id_col).alias("id"))
    both = texts.join(found, ["ord", "th"], "left").select("id", "text", "spans")
    kind = docs.schema[id_col].dataType

    def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, kept, spans = [], [], []
        for text, own in zip(batch.column(1), batch.column(2), strict=True):
            words = text.as_py().encode().split()  # on ASCII white space
            merged: list[list[int]] = []
            for low, high in sorted((x["first"], x["last"]) for x in own.as_py() or ()):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            sizes.append(len(words))
            for low, high in reversed(merged):
                del words[low:high]
            kept.append(b" ".join(words).decode())
            spans.append([{"first": low, "last": high} for low, high in merged])
        removed = [sum(x["last"] - x["first"] for x in s) for s in spans]
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))]
        return pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "kept", "spans"])

    out = ragged.map_batches(both, lambda: handle, f"id {kind.simpleString()}, n_words long, n_removed long, kept string, spans array<struct<first:int,last:int>>")
    return out.withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The counts, and the SHA-256 of what is kept."""
    return found.select(id_col, "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
