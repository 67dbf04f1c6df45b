"""Token counts by rank-synchronous merging of ragged arrays.

A text is cut into pre-tokens; the distinct new ones of a slice of texts are held
together in one flat array of symbols. In every round each pre-token finds its
lowest-rank pair and applies it at all its places at once; a pre-token with no
pair left is done, and its surviving symbols are its count. In a byte-pair
vocabulary a pair that holds a symbol ranks after the pair that made the symbol,
so merging all places of the lowest pair at once equals merging them one by one.

Nulls and empty texts have no bytes and no tokens. Repeated rows give repeated
results, and only the id and text columns are read, so other columns can't clash.
The special strings of the file count as one token each and are never merged.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ragged

#: Fixed value: the pre-token pattern of byte-level BPE files with ``use_regex``.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.int32(2**31 - 1)
#: Distinct pre-tokens remembered by a worker; beyond it the memory starts anew, results stay.
REMEMBERED = 400_000


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """Pair ranks of a byte-level BPE file as sorted arrays. Its size is that of the vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, before = spec["model"]["vocab"], spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
            raise ValueError("only byte-level BPE files without normaliser and prefix space are supported")
        self.first = np.zeros(256, np.int32)
        for char, byte in byte_symbols().items():
            self.first[byte] = vocab[char]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.special = [x["content"] for x in spec.get("added_tokens", [])]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank[at], NONE)

    def symbols(self, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Symbols that survive in each pre-token of a ragged byte array with no empty rows."""
        done = np.zeros(len(counts), np.int64)
        rows, sizes, sym = np.arange(len(counts)), counts.astype(np.int64), self.first[data]
        ranks = np.full(len(sym), NONE, np.int32)
        if len(sym):
            ranks[:-1] = self.ranks(sym[:-1], sym[1:])
            ranks[np.cumsum(sizes) - 1] = NONE
        while len(rows):
            low = np.minimum.reduceat(ranks, np.cumsum(sizes) - sizes)
            open_ = low < NONE
            if not open_.all():
                done[rows[~open_]] = sizes[~open_]
                keep = np.repeat(open_, sizes)
                sym, ranks, rows, sizes, low = sym[keep], ranks[keep], rows[open_], sizes[open_], low[open_]
                if not len(rows):
                    break
            hit = ranks == np.repeat(low, sizes)
            at = np.flatnonzero(hit)
            run = np.concatenate(([True], np.diff(at) > 1))  # pairs that overlap: every second one merges
            begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
            sym[at] = self.made[ranks[at]]
            gone = np.zeros(len(sym), bool)
            gone[at + 1] = True
            last = np.zeros(len(sym), bool)
            ends = np.cumsum(sizes) - 1
            last[ends] = True
            last[at] |= last[at + 1]
            changed = np.zeros(len(sym), bool)
            changed[at] = True
            sizes = sizes - np.add.reduceat(gone.astype(np.int64), ends - sizes + 1)
            keep = ~gone
            sym, ranks, last, changed = sym[keep], ranks[keep], last[keep], changed[keep]
            again = changed.copy()
            again[:-1] |= changed[1:]
            again &= ~last
            ranks[changed & last] = NONE
            at = np.flatnonzero(again)
            ranks[at] = self.ranks(sym[at], sym[at + 1])
        return done


def counter(merges: Merges):
    """A function from texts to their numbers of tokens; it remembers pre-tokens."""
    import regex

    split = regex.compile("|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True)))).split if merges.special else lambda t: [t]
    pieces, known = regex.compile(PATTERN).findall, {}

    def learn(new: list[str]) -> None:
        if len(known) + len(new) > REMEMBERED:
            known.clear()
        data, offsets = ragged.packed(pa.array(new, pa.large_string()))
        known.update(zip(new, merges.symbols(data, np.diff(offsets)).tolist(), strict=True))

    def count(texts: list[str]) -> list[int]:
        found, extra = [], []
        for text in texts:
            parts = split(text)
            found.append(pieces(text) if len(parts) == 1 else [p for part in parts for p in pieces(part)])
            extra.append(len(parts) - 1)
        words = set().union(*found)
        new = list(words - known.keys())
        if len(known) + len(new) > REMEMBERED:
            new = list(words)
            known.clear()
        learn(new)
        get = known.__getitem__
        return [sum(map(get, f)) + e for f, e in zip(found, extra, strict=True)]

    return count


def token_counts(df: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text, and whether the tokens exceed ``limit``.

    ``tokenizer`` is the path of a byte-level BPE file; the driver reads it and
    sends its tables to the workers, so executors need not see the file. Returns
    the id column, n_bytes, n_tokens, over_limit.
    """
    shared = df.sparkSession.sparkContext.broadcast(Merges(tokenizer))

    def make():
        count = counter(shared.value)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).fill_null("")
            _, offsets = ragged.packed(texts)
            n: list[int] = []
            for low, high in ragged.slices(offsets):
                n += count(texts.slice(low, high - low).to_pylist())
            tokens = np.array(n, np.int64)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)], ["id", "n_bytes", "n_tokens", "over_limit"]
            )

        return handle

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = ragged.map_batches(rows, make, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)
