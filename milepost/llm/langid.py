"""Language identification by bit-sliced Bloom filters over byte n-grams.

A text is lower-cased (A-Z) and every ASCII byte that is no letter becomes a
space; its n-grams are the four-byte windows that hold a letter and no double
space. Training counts n-grams per language over all training rows. A language
contains an n-gram if it is common enough there, alone and against the language
where it is most common. The filters of all languages share their slots: a slot
holds one bit for each language, so one probe of k slots and an AND return all
languages that contain an n-gram. The bits are counted per language over the
whole text, corrected for each language's rate of false positives, and the
largest share decides; ties go to the language with more training rows, then to
the smaller name.

A text that is null, empty or without any letter is ``und`` with score 0. With no
training rows every text is ``und``. Repeated rows count as often as they occur.
Training reads text and language only; prediction reads the text only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ragged

U64 = np.uint64
HASHES = 4
UND = "und"
#: Rows of counts a training task holds before it passes them on.
HELD = 1 << 20
_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x80:] = np.arange(0x80, 0x100)
_LETTER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte n-grams of each row as numbers, and their count per row; a row is framed by spaces."""
    n = len(offsets) - 1
    framed = np.full(len(data) + 2 * n, 0x20, np.uint8)
    shift = np.repeat(2 * np.arange(n) + 1, np.diff(offsets))
    framed[np.arange(len(data)) + shift] = _LETTER[data]
    if len(framed) < 4:
        return np.zeros(0, np.uint32), np.zeros(n, np.int64)
    b = framed.astype(np.uint32)
    out = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
    blank = framed == 0x20
    double = blank[:-1] & blank[1:]
    good = ~(double[:-2] | double[1:-1] | double[2:])  # windows across two rows hold a double space
    return out[good], np.diff(np.concatenate(([0], np.cumsum(good), [0] * 3))[np.minimum(offsets + 2 * np.arange(n + 1), len(good))])


def slots(gram: np.ndarray, size: int) -> np.ndarray:
    """The k slots of each n-gram."""
    h = ragged.mix((gram.astype(U64) + U64(1)) * ragged._BASE)
    step = (h >> U64(32)) | U64(1)
    return np.stack([((h + U64(i) * step) & U64(size - 1)).astype(np.int64) for i in range(HASHES)])


def gram_counts(train: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """lang, gram, n over all training rows; counts are summed in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts):
            keys = np.concatenate([k for k, _ in parts])
            counts = np.concatenate([c for _, c in parts])
            keys, where = np.unique(keys, return_inverse=True)
            return keys, np.bincount(where, counts, len(keys)).astype(np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                keys, counts = merged(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(counts)], ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            langs, texts = batch.column(0), batch.column(1)
            for lang in langs.unique().to_pylist():
                own = texts.filter(pa.compute.equal(langs, lang))
                data, offsets = ragged.packed(own)
                for low, high in ragged.slices(offsets):
                    g, _ = grams(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                    held.setdefault(lang, []).append(np.unique(g, return_counts=True))
                held[lang] = [merged(held[lang])]
            if sum(len(k) for parts in held.values() for k, _ in parts) > HELD:
                yield from flush()
        yield from flush()

    rows = train.select(F.col(lang_col).cast("string").alias("lang"), F.coalesce(text_col, F.lit("")).alias("text"))
    return rows.mapInArrow(ragged.per_task(run), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """Bit-sliced Bloom filters of all languages in one table of fixed size."""

    def __init__(self, langs: list[str], table: np.ndarray):
        self.langs, self.table = langs, table  # table: words x slots
        fill = np.array([((table[i // 64] >> U64(i % 64)) & U64(1)).mean() for i in range(len(langs))])
        self.false = np.minimum(fill**HASHES, 0.99)

    def shares(self, gram: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """For each row and language, the corrected share of the row's n-grams that the language contains."""
        out = np.zeros((len(counts), len(self.langs)))
        if not len(gram) or not self.langs:
            return out
        at, full = slots(gram, self.table.shape[1]), counts > 0
        first = (np.cumsum(counts) - counts)[full]
        for w in range(len(self.table)):
            mask = self.table[w][at[0]]
            for a in at[1:]:
                mask &= self.table[w][a]
            for i in range(64 * w, min(64 * w + 64, len(self.langs))):
                hits = np.add.reduceat(((mask >> U64(i % 64)) & U64(1)).astype(np.int32), first)
                out[full, i] = np.clip((hits / counts[full] - self.false[i]) / (1 - self.false[i]), 0, 1)
        return out


def fit(train: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = 1 << 18, least: float = 2e-6, against: float = 0.2) -> Filters:
    """Build the filters from all rows of ``train``.

    A language contains an n-gram whose share of the language's n-grams is at
    least ``least`` and at least ``against`` times the largest share any language
    has. ``size`` (a power of two) is the number of slots: it bounds the table
    that the driver gathers and sends out.
    """
    train = train.where(F.col(lang_col).isNotNull())
    langs = [r["lang"] for r in train.groupBy(F.col(lang_col).cast("string").alias("lang")).count().orderBy(F.desc("count"), "lang").collect()]
    words = max(1, -(-len(langs) // 64))
    table = np.zeros((words, size), U64)
    if not langs:
        return Filters(langs, table)
    counts = gram_counts(train, lang_col, text_col)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("n") / F.col("total"))  # one row for each language
    best = shares.groupBy("gram").agg(F.max("share").alias("best"), F.collect_list(F.struct("lang", "share")).alias("in"))
    kept = best.select("gram", F.filter("in", lambda x: (x["share"] >= least) & (x["share"] >= against * F.col("best")))["lang"].alias("langs")).where(F.size("langs") > 0)
    place = {lang: i for i, lang in enumerate(langs)}

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((words, size), U64)
        for batch in batches:
            at = slots(batch.column(0).to_numpy(), size)
            for row, names in enumerate(batch.column(1).to_pylist()):
                for name in names:
                    own[place[name] // 64, at[:, row]] |= U64(1) << U64(place[name] % 64)
        for w in range(words):
            used = np.flatnonzero(own[w])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), w, np.int32)), pa.array(used), pa.array(own[w][used].view(np.int64))], ["word", "slot", "bits"])

    bits = kept.mapInArrow(ragged.per_task(set_bits), "word int, slot long, bits long").groupBy("word", "slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    table[bits["word"].to_numpy(), bits["slot"].to_numpy()] = bits["bits"].to_numpy().view(U64)
    return Filters(langs, table)


def predict(df: DataFrame, filters: Filters, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """The frame with the predicted language and its corrected share (0 to 1)."""
    from .pieces import added

    shared = df.sparkSession.sparkContext.broadcast(filters)
    schema = added(df.drop(lang_col, score_col), lang_col, T.StringType()).add(score_col, "double")
    base = df.drop(lang_col, score_col)
    place = base.columns.index(text_col)

    def make():
        own = shared.value
        names = np.array([*own.langs, UND], object)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(place)
            data, offsets = ragged.packed(texts)
            langs, scores = [], []
            for low, high in ragged.slices(offsets):
                part = data[offsets[low] : offsets[high]]
                g, counts = grams(part, offsets[low : high + 1] - offsets[low])
                shares = own.shares(g, counts)
                if own.langs:
                    pick = shares.argmax(axis=1)
                    score = shares[np.arange(len(pick)), pick]
                else:
                    pick, score = np.zeros(high - low, np.int64), np.zeros(high - low)
                ascii_ = (_LETTER[part] != 0x20) & (part < 0x80)
                sums = np.concatenate(([0], np.cumsum(ascii_)))
                bare = np.flatnonzero(np.diff(sums[offsets[low : high + 1] - offsets[low]]) == 0)
                for row in bare.tolist():
                    text = texts[low + row].as_py()
                    if not text or not any(map(str.isalpha, text)):
                        pick[row], score[row] = len(own.langs), 0.0
                langs.append(names[pick])
                scores.append(score)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(langs), pa.string()), pa.array(np.concatenate(scores))], schema.names)

        return handle

    return ragged.map_batches(base, make, schema)


def least_score(train: DataFrame, filters: Filters, lang_col: str = "lang", text_col: str = "text", percent: int = 1, part: float = 0.5) -> float:
    """The score below which a text is in no learned language: ``part`` of the score that all but ``percent`` of the training rows reach.

    Fitted on all training rows with a language and a letter; 0 where there are none.
    Scores are counted in thousandths, so at most 1001 rows are gathered.
    """
    found = predict(train.where(F.col(lang_col).isNotNull()).select(text_col), filters, text_col).where(F.col("lang_pred") != UND)
    counts = found.groupBy(F.floor(F.col("score") * 1000).cast("int").alias("at")).count().orderBy("at").collect()
    total, seen = sum(r["count"] for r in counts), 0
    for r in counts:
        seen += r["count"]
        if 100 * seen > percent * total:
            return part * r["at"] / 1000
    return 0.0


def held_out(id_col: str, folds: int = 5):
    """Whether the CRC of the id as text is 0 modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == 0
