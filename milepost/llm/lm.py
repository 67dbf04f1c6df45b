"""Document log-likelihood by a gated recurrent language model, and by unigram counts.

Tokens are words with A-Z lower-cased, then one end. Spark counts all training
tokens. The ``HEAD`` most frequent ones travel to the tasks (a fixed number); counts
of rarer words meet the documents in a join, after each document has summed them.

The model predicts one of 4096 entries: the most frequent words, the end, and one
entry for all other words, which are then drawn by their smoothed counts, so the
probabilities of all texts sum to one. It is a GRU in numpy with a softmax factored
in 64 classes of 64 entries in order of frequency. Its output biases start at the
smoothed counts, where its score equals the base score. It is trained by truncated
backpropagation: a warm-up over ``WARM_ROWS`` documents gives common weights, then
the training documents, dealt by a hash of id and text into groups of about
``GROUP_TOKENS`` tokens, are passed once, each group from there, and the weights
are averaged by tokens. Groups and the order within them follow from the rows alone, so
scores don't depend on how rows are partitioned. Hidden states are carried from window to
window, in training without their gradients, so a score covers the complete document.

Texts are read once for counts and once for their entries in the model, two bytes a
token, which training and scoring use.

A null or empty text is one end. Rows with equal id and text get equal scores.
Rows that repeat id and text are counted first and dealt into groups copy by copy, so
no group grows with them. Words are told apart by 64-bit hashes. Other columns are not read. With no
training rows every word is unknown and the score equals the base score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import ragged
from .langid import held_out

ENTRIES, CLASSES = 4096, 64
PER_CLASS = ENTRIES // CLASSES
HIDDEN, STEPS = 24, 32
HEAD = 1 << 18
WARM_ROWS = 512
#: Documents that advance together in training and in scoring, and tokens that a task gathers before.
LANES, SCORE_LANES, GATHERED = 320, 1024, 3_000_000
#: Tokens of a training group; from ``MOST_GROUPS`` groups on, which bounds the averaging, groups get larger, in chunks of ``GATHERED``.
GROUP_TOKENS, MOST_GROUPS = 2_000_000, 8192
#: Groups are first averaged in this many parts.
PARTS = 64
ADD = 0.1
#: Logits above it count as it, so that float32 exponentials and their sums stay finite.
LARGEST = np.float32(60)
END = ragged.mix(np.array([1], np.uint64))[0]
BLOCK = 4096


@dataclass
class Vocabulary:
    """The head of the counted words: sorted hashes, their counts, and their entries in the model."""

    hashes: np.ndarray
    counts: np.ndarray
    entry: np.ndarray
    total: int  # training tokens
    distinct: int  # distinct training tokens
    other_total: int  # of words outside the entries
    other_distinct: int

    @classmethod
    def of(cls, hashes: np.ndarray, counts: np.ndarray, total: int, distinct: int) -> Vocabulary:
        """From the head in order of frequency."""
        entry = np.full(len(hashes), ENTRIES - 1, np.int64)
        n = min(len(hashes), ENTRIES - 1)
        entry[:n] = np.arange(n)
        order = np.argsort(hashes)
        inside = int(counts[:n].sum())
        return cls(hashes[order], counts[order], entry[order], total, distinct, total - inside, distinct - n)

    def slots(self) -> np.ndarray:
        """Open-addressed slots with the place of each word, or -1; made by each task."""
        if "_slots" not in self.__dict__:
            table = np.full(max(1024, 1 << (4 * len(self.hashes) - 1).bit_length() if len(self.hashes) else 0), -1, np.int64)
            left, mask, step = np.arange(len(self.hashes)), np.uint64(len(table) - 1), np.uint64(0)
            while len(left):
                at = (self.hashes[left] + step) & mask
                free = table[at] < 0
                table[at[free]] = left[free]
                left, step = left[table[at] != left], step + np.uint64(1)
            self._slots = table
        return self._slots

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and head count of words; the count of a word outside the head is -1."""
        if not len(self.hashes):
            return np.full(len(words), ENTRIES - 1), np.full(len(words), -1)
        table = self.slots()
        found, left = np.full(len(words), -1), np.arange(len(words))
        mask, step = np.uint64(len(table) - 1), np.uint64(0)
        while len(left):
            own = words[left]
            place = table[(own + step) & mask]
            hit = (place >= 0) & (self.hashes[place] == own)
            found[left[hit]] = place[hit]
            left, step = left[(place >= 0) & ~hit], step + np.uint64(1)
        hit = found >= 0
        return np.where(hit, self.entry[found], ENTRIES - 1), np.where(hit, self.counts[found], -1)

    @property
    def base_mass(self) -> float:
        return self.total + ADD * (self.distinct + 1)

    @property
    def other_mass(self) -> float:
        return self.other_total + ADD * (self.other_distinct + 1)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of each row, each row followed by the end; and tokens per row."""
    words, counts = [], []
    for low, high in ragged.slices(offsets):
        part, ends = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        starts, stops, n = ragged.spans(part, ends, ragged.NOT_SPACE)
        h = ragged.span_hashes(part, starts, stops, ragged.LOWER_VALUE)
        words.append(np.insert(h, np.cumsum(n), END))
        counts.append(n + 1)
    return np.concatenate(words), np.concatenate(counts)


def word_counts(train: DataFrame) -> DataFrame:
    """word, n over all training tokens, summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["word", "n"])

        for batch in batches:
            k, c = np.unique(tokens(*ragged.packed(batch.column(0)))[0], return_counts=True)
            both, where = np.unique(np.concatenate((keys, k)), return_inverse=True)
            keys, counts = both, np.bincount(where, np.concatenate((counts, c)), len(both)).astype(np.int64)
            if len(keys) > 4_000_000:
                yield out()
                keys, counts = keys[:0], counts[:0]
        yield out()

    return train.select("text").mapInArrow(ragged.per_task(run), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Gru:
    """Weights in one flat array, with named views."""

    SHAPES = {"inp": (ENTRIES, 3 * HIDDEN), "rec": (HIDDEN, 3 * HIDDEN), "wc": (HIDDEN, CLASSES), "bc": (CLASSES,), "wo": (CLASSES, HIDDEN, PER_CLASS), "bo": (CLASSES, PER_CLASS)}
    SIZE = sum(int(np.prod(s)) for s in SHAPES.values())

    def __init__(self, flat: np.ndarray):
        self.flat, self.used, at = flat, None, 0  # used: of gradients, the rows of ``inp`` that a window has touched
        for name, shape in self.SHAPES.items():
            n = int(np.prod(shape))
            setattr(self, name, flat[at : at + n].reshape(shape))
            at += n

    @classmethod
    def start(cls, vocabulary: Vocabulary) -> Gru:
        """Small random weights; output biases that give the smoothed counts."""
        rng = np.random.default_rng(8)
        out = cls((rng.standard_normal(cls.SIZE) * 0.05).astype(np.float32))
        p = np.full(ENTRIES, 1e-9)
        inside = vocabulary.entry < ENTRIES - 1
        p[vocabulary.entry[inside]] = (vocabulary.counts[inside] + ADD) / vocabulary.base_mass
        p[-1] = vocabulary.other_mass / vocabulary.base_mass
        p = p.reshape(CLASSES, PER_CLASS)
        out.bc[:] = np.log(p.sum(1))
        out.bo[:] = np.log(p / p.sum(1, keepdims=True))
        out.wc[:] = out.wo[:] = 0
        return out

    def steps(self, x: np.ndarray, h: np.ndarray, keep: bool):
        """Hidden states before each step of a window (x: steps by lanes) and after the last, and the gates if kept.

        Both have features before lanes, so that every gate is one block of memory.
        """
        H, (n_steps, lanes) = HIDDEN, x.shape
        kind, rec = self.flat.dtype, np.ascontiguousarray(self.rec.T)
        states = np.empty((n_steps + 1, H, lanes), kind)
        gates = np.empty((n_steps if keep else 1, 4 * H, lanes), kind)  # r, z, n, and the recurrent part of n
        u = np.empty((3 * H, lanes), kind)
        states[0] = h.T
        for t in range(n_steps):
            g, gate = np.take(self.inp, x[t], axis=0).T, gates[t if keep else 0]
            np.matmul(rec, states[t], out=u)
            rz, n = gate[: 2 * H], gate[2 * H : 3 * H]
            np.add(g[: 2 * H], u[: 2 * H], out=rz)
            np.negative(rz, out=rz)
            np.exp(rz, out=rz)
            rz += 1
            np.reciprocal(rz, out=rz)
            gate[3 * H :] = u[2 * H :]
            np.multiply(rz[:H], u[2 * H :], out=n)
            n += g[2 * H :]
            np.tanh(n, out=n)
            new = states[t + 1]
            np.subtract(states[t], n, out=new)
            new *= rz[H:]
            new += n
        return states, gates

    def log_probs(self, h: np.ndarray, y: np.ndarray, grads: Gru | None = None):
        """Natural log of the probability of entries y after states h; with grads, also their gradient to h."""
        cls = (y // PER_CLASS).astype(np.uint8)
        order = np.argsort(cls, kind="stable")
        h, cls, word = h[order], cls[order], (y % PER_CLASS)[order]
        ends, rows = np.searchsorted(cls, np.arange(CLASSES + 1)), np.arange(len(y))
        used = [(c, slice(ends[c], ends[c + 1])) for c in np.flatnonzero(np.diff(ends))]
        # A last feature of one carries the biases; logits are cut only where weights let them pass the limit, as |h| <= 1.
        h = np.concatenate((h, np.ones((len(h), 1), h.dtype)), 1)
        wc = np.concatenate((self.wc, self.bc[None]))
        wo = np.concatenate((self.wo, self.bo[:, None]), 1)
        logits, learn = h @ wc, grads is not None
        out, off = _softmax(logits, rows, cls, np.abs(wc).sum(0).max() > LARGEST, learn)
        back = None
        if grads is not None:
            g = h.T @ off
            grads.wc += g[:-1]
            grads.bc += g[-1]
            back = off @ self.wc.T
        for c, i in used:
            np.matmul(h[i], wo[c], out=logits[i])
        logp, off = _softmax(logits, rows, word, np.abs(wo).sum(1).max() > LARGEST, learn)
        out += logp
        unsorted = np.empty_like(out)
        unsorted[order] = out
        if grads is None:
            return unsorted, None
        for c, i in used:
            g = h[i].T @ off[i]
            grads.wo[c] += g[:-1]
            grads.bo[c] += g[-1]
            back[i] += off[i] @ self.wo[c].T
        dh = np.empty_like(back)
        dh[order] = back
        return unsorted, dh

    def window(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray, h: np.ndarray, grads: Gru | None):
        """One window: log probabilities of the unmasked targets and the state after it.

        A target is predicted from the state after its predecessor went in, so step t
        feeds x[t] (what came before) and the state after it predicts y[t].
        """
        states, gates = self.steps(x, h, grads is not None)
        by_lane = np.ascontiguousarray(states.transpose(0, 2, 1))
        after = by_lane[1:]
        logp, back = self.log_probs(after[mask], y[mask], grads)
        if grads is not None:
            H, before, dafter = HIDDEN, states[:-1], np.zeros_like(after)
            dafter[mask] = back
            r, z, n, un = (gates[:, i * H : (i + 1) * H] for i in range(4))
            rest = 1 - z
            by_n, by_z, by_r = rest * (1 - n * n), (before - n) * z * rest, un * r * (1 - r)
            recs = np.empty((len(x), 3 * H, x.shape[1]), self.flat.dtype)
            dns = np.empty_like(before)
            dh, du_h = np.zeros((H, x.shape[1]), self.flat.dtype), np.empty((H, x.shape[1]), self.flat.dtype)
            for t in range(len(x) - 1, -1, -1):
                dh += dafter[t].T
                du, dn = recs[t], dns[t]
                np.multiply(dh, by_n[t], out=dn)
                np.multiply(dn, by_r[t], out=du[:H])
                np.multiply(dh, by_z[t], out=du[H : 2 * H])
                np.multiply(dn, r[t], out=du[2 * H :])
                dh *= z[t]
                np.matmul(self.rec, du, out=du_h)
                dh += du_h
            recs = np.ascontiguousarray(recs.transpose(0, 2, 1))
            grads.rec += by_lane[:-1].reshape(-1, H).T @ recs.reshape(-1, 3 * H)
            recs[:, :, 2 * H :] = dns.transpose(0, 2, 1)
            recs = recs.reshape(-1, 3 * H)
            flat = x.ravel().astype(np.uint16)
            order = np.argsort(flat, kind="stable")
            flat = flat[order]
            first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
            grads.used = flat[first]
            grads.inp[grads.used] += np.add.reduceat(recs[order], first, axis=0)
        return logp, np.ascontiguousarray(states[-1].T)


def _softmax(logits: np.ndarray, rows: np.ndarray, chosen: np.ndarray, cut: bool, learn: bool) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities of the chosen columns, and to learn from probabilities less one at the chosen ones; the latter in place of the logits."""
    if cut:
        np.minimum(logits, LARGEST, out=logits)
    out = logits[rows, chosen]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    out -= np.log(total)
    if learn:
        logits *= (1 / total)[:, None]
        logits[rows, chosen] -= 1
    return out, logits


def groups(entries: np.ndarray, counts: np.ndarray, lanes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents of like length together, longest first: their rows, targets (steps by lanes) and lengths."""
    order, starts = np.argsort(-counts, kind="stable"), ragged.starts_of(counts)
    for i in range(0, len(order), lanes):
        rows = order[i : i + lanes]
        yield rows, starts[rows], counts[rows]


def windows(entries: np.ndarray, starts: np.ndarray, sizes: np.ndarray, end: int):
    """Windows of a group: inputs, targets, mask, lanes still open. The input before the first token is the end."""
    for at in range(0, int(sizes.max(initial=0)), STEPS):
        open_ = int(np.searchsorted(-sizes, -at, "left"))
        step = at + np.arange(min(STEPS, int(sizes[0]) - at))[:, None]
        mask = step < sizes[:open_]
        place = starts[:open_] + np.minimum(step, sizes[:open_] - 1)
        y = entries[place]
        x = np.where(step > 0, entries[np.maximum(place - 1, starts[:open_])], end)
        yield x, y, mask, open_


class Trainer:
    """Adagrad over windows."""

    RATE = 0.05

    def __init__(self, model: Gru, end: int):
        self.model, self.end, self.seen = model, end, 0
        self.grads, self.sums = Gru(np.zeros(Gru.SIZE, np.float32)), Gru(np.full(Gru.SIZE, 1e-8, np.float32))

    def step(self, n: int) -> None:
        """Move the weights by the gradients of n targets. Rows of ``inp`` without a token in the window have none and stay."""
        rows, rest = self.grads.used, slice(self.grads.inp.size, None)
        g = self.grads.inp[rows] / n
        sums = self.sums.inp[rows] + g * g
        self.sums.inp[rows] = sums
        self.model.inp[rows] -= self.RATE * g / np.sqrt(sums)
        self.grads.inp[rows] = 0
        g = self.grads.flat[rest]
        g /= n
        self.sums.flat[rest] += g * g
        self.model.flat[rest] -= self.RATE * g / np.sqrt(self.sums.flat[rest])
        g[:] = 0

    def fit(self, entries: np.ndarray, counts: np.ndarray) -> None:
        for _, starts, sizes in groups(entries, counts, LANES):
            h = np.zeros((len(sizes), HIDDEN), np.float32)
            for x, y, mask, open_ in windows(entries, starts, sizes, self.end):
                _, h = self.model.window(x, y, mask, h[:open_], self.grads)
                n = int(mask.sum())
                self.step(n)
                self.seen += n


def log_likelihood(model: Gru, entries: np.ndarray, counts: np.ndarray, end: int) -> np.ndarray:
    """log10 probability of the entries of each document."""
    out = np.zeros(len(counts))
    for rows, starts, sizes in groups(entries, counts, SCORE_LANES):
        h = np.zeros((len(sizes), HIDDEN), np.float32)
        for x, y, mask, open_ in windows(entries, starts, sizes, end):
            logp, h = model.window(x, y, mask, h[:open_], None)
            out[rows[:open_]] += np.bincount(np.nonzero(mask)[1], logp, open_)
    return out / np.log(10)


def entries_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Entries of a binary column, joined, and their number in each row."""
    data, offsets = ragged.packed(column)
    return data.view(np.uint16).astype(np.int64), np.diff(offsets) // 2


def _gathered(batches: Iterator[pa.RecordBatch], place: int):
    """Rows with their entries, put together until there are ``GATHERED`` tokens, however they came in batches."""
    held, size = [], 0
    for batch in batches:
        counts = entries_of(batch.column(place))[1]
        at = 0
        while at < len(counts):
            sums = np.cumsum(counts[at:])
            end = at + min(int(np.searchsorted(sums, GATHERED - size)) + 1, len(sums))
            held.append(batch.slice(at, end - at))
            size += int(sums[end - at - 1])
            if size >= GATHERED:
                yield held
                held, size = [], 0
            at = end
    if held:
        yield held


def _joined(held: list[pa.RecordBatch], place: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries and counts of the rows that were put together."""
    found = [entries_of(b.column(place)) for b in held]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def read_entries(docs: DataFrame, vocabulary) -> DataFrame:
    """Of every text: its tokens, the known ones, the base score as far as the head knows, and its entries in the model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary.value
        for batch in batches:
            words, n = tokens(*ragged.packed(batch.column(1)))
            entry, count = own.find(words)
            row, inside = ragged.row_of(n), count >= 0
            add = lambda values, row=row, n=n: np.bincount(row, values, len(n))
            logs = np.where(inside, np.log10(np.maximum(count, 0) + ADD), 0.0)
            # A word of the last entry is drawn by its count; that of a word outside the head is added after the join.
            drawn = add(np.where(entry == ENTRIES - 1, logs - np.log10(own.other_mass), 0.0))
            base = add(logs) - n * np.log10(own.base_mass)
            rest = words[~inside].view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ragged.starts_of(add(~inside).astype(np.int64)).astype(np.int32)), pa.array(rest))
            ends = ragged.starts_of(2 * n).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(entry.astype(np.uint16))])
            known = pa.array(add(count > 0).astype(np.int64))
            columns = [batch.column(0), batch.column(2), batch.column(3), pa.array(n), known, pa.array(base), pa.array(drawn), lists, packed]
            yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "text_hash", "n_tokens", "n_known", "base", "drawn", "rest", "entries"])

    kind = docs.schema["id"].dataType.simpleString()
    rows = docs.select("id", "text", "held_out", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(
        ragged.per_task(run),
        f"id {kind}, held_out boolean, text_hash long, n_tokens long, n_known long, base double, drawn double, rest array<long>, entries binary",
    )


def dealt(train: DataFrame, total: int) -> tuple[DataFrame, int]:
    """Every training row with its group and its place there, and the number of groups; both follow from the rows alone."""
    n = min(MOST_GROUPS, max(1, -(-total // GROUP_TOKENS)))
    texts = train.groupBy("id", "text_hash").agg(F.any_value("entries").alias("entries"), F.count("*").alias("n"))
    copies = texts.select("id", "text_hash", "entries", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    place = F.xxhash64("id", "text_hash", "copy")
    return copies.select("id", "text_hash", "copy", "entries", place.alias("place"), F.pmod(place, F.lit(n)).cast("int").alias("group")), n


def train_pass(rows: DataFrame, n_groups: int, vocabulary, weights) -> np.ndarray | None:
    """One pass over all rows, each group from common weights; the weights averaged by tokens, in two levels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = int(vocabulary.value.find(np.array([END]))[0][0])
        trainer, group = Trainer(Gru(weights.value.copy()), end), None
        for held in _gathered(batches, 1):
            group = held[0].column(0)[0].as_py()
            trainer.fit(*_joined(held, 1))
        if trainer.seen:
            for i in range(0, Gru.SIZE, BLOCK):
                part = trainer.model.flat[i : i + BLOCK].astype(np.float64) * trainer.seen
                columns = [pa.array([x]) for x in (i, group % PARTS, group, trainer.seen)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([part], pa.list_(pa.float64()))], ["at", "lane", "group", "n", "part"])

    def total(key: str):
        """Sums of a group's rows, added in the order of ``key``, so that they come out the same each time."""

        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by(key)
            parts = np.sum(np.stack([np.asarray(x.values) for x in table["part"]]), axis=0)
            return pa.table({"at": table["at"][:1], "lane": table["lane"][:1], "n": [table["n"].to_numpy().sum()], "part": pa.array([parts], pa.list_(pa.float64()))})

        return run

    # One group is one partition; its rows are trained in the order of their places.
    groups_ = rows.repartitionById(n_groups, F.col("group")).sortWithinPartitions("place", "id", "text_hash", "copy").select("group", "entries")
    parts = groups_.mapInArrow(ragged.per_task(run), "at long, lane long, group long, n long, part array<double>")
    parts = parts.groupBy("at", "lane").applyInArrow(total("group"), "at long, lane long, n long, part array<double>")
    found = parts.groupBy("at").applyInArrow(total("lane"), "at long, lane long, n long, part array<double>").collect()  # the weights
    if not found:
        return None
    return np.concatenate([(np.array(r["part"]) / r["n"]).astype(np.float32) for r in sorted(found, key=lambda r: r["at"])])


def log_likelihoods(df: DataFrame, folds: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id column, held_out, n_tokens, n_known, train_tokens, base_score, score of every text; learned from rows not held out."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("held_out", held_out("id", folds))
    counts = written(word_counts(docs.where(~F.col("held_out"))), "counts")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    head = counts.orderBy(F.desc("n"), "word").limit(HEAD).toArrow()
    vocab = Vocabulary.of(head["word"].to_numpy().view(np.uint64), head["n"].to_numpy(), sums["n"], sums["v"])
    vocabulary = spark.sparkContext.broadcast(vocab)
    read = written(read_entries(docs, vocabulary), "entries")
    train = read.where(~F.col("held_out")).select("id", "text_hash", "entries")
    first = train.orderBy(F.xxhash64("id", "text_hash"), "id", "text_hash").limit(WARM_ROWS)
    weights = Gru.start(vocab).flat
    for part in (dealt(first, 1), dealt(train, vocab.total)):
        weights = w if (w := train_pass(*part, vocabulary, spark.sparkContext.broadcast(weights))) is not None else weights
    shared = spark.sparkContext.broadcast(weights)
    names = read.columns[:-1]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, model = vocabulary.value, Gru(shared.value)
        end = int(own.find(np.array([END]))[0][0])
        for held in _gathered(batches, names.index("rest") + 1):
            scores, at = log_likelihood(model, *_joined(held, len(names)), end), 0
            for batch in held:
                drawn = batch.column(names.index("drawn")).to_numpy() + scores[at : at + batch.num_rows]
                at += batch.num_rows
                columns = {name: batch.column(i) for i, name in enumerate(names)} | {"drawn": pa.array(drawn)}
                yield pa.RecordBatch.from_arrays(list(columns.values()), [("score" if n == "drawn" else n) for n in names])

    kind = docs.schema["id"].dataType.simpleString()
    scored = written(read.mapInArrow(ragged.per_task(score), f"id {kind}, held_out boolean, text_hash long, n_tokens long, n_known long, base double, score double, rest array<long>"), "scored")
    rare = scored.where(F.size("rest") > 0).dropDuplicates(["id", "text_hash"]).select("id", "text_hash", F.explode("rest").alias("word"))
    known = rare.join(counts, "word", "left").groupBy("id", "text_hash").agg(F.count("n").alias("more"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADD))).alias("logs"))
    same = [F.col("id").eqNullSafe(F.col("_id")), F.col("text_hash") == F.col("_hash")]
    out = scored.drop("rest").join(known.withColumnsRenamed({"id": "_id", "text_hash": "_hash"}), same[0] & same[1], "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return out.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )
