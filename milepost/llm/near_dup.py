"""Near-duplicates by b-bit MinHash over word shingles, with exact confirmation.

Texts of equal shingle sets form one class, and only its smallest id goes on. The
minima of 336 hash functions are taken in 48 bands of 7; of each minimum the low
two bits are kept, packed into 64-bit words. Documents that share a band are
candidates. Their similarity is estimated from the equal two-bit fields, corrected
for the quarter that agrees by chance, and only candidates far below the threshold
are dropped before the full sets decide.

A bucket of m documents is not compared in m * m / 2 pairs. Links are found in four
rounds, and what an earlier round has joined is not compared again:

1. every document with the most central document of its buckets (the one whose
   buckets are largest: the text that the others were made from is most like all);
2. in buckets with several components, every document outside the largest one with
   the most central member of that one;
3. documents that buckets with several components connect form a family; every member outside
   the component of its most central one, c, is compared with c;
4. what is left are pairs x, y of a family of which one isn't linked with c. Their sets are written as
   differences from c: Dx = x ^ c. A link allows few elements in x ^ y = Dx ^ Dy, while Dx has more than a
   link with c allows, so Dx and Dy must share elements: at least (|Dx| + |Dy| - most elements of x ^ y) / 2,
   which is one or more, and much for members that differ from c in ways of their own. A prefix filter
   finds the pairs that can: elements are ordered by rarity in the family, and the first one that is shared must
   come early enough on both sides for the rest of them to follow.

The fourth round makes the result independent of the choice of centres, and is exact but for the
estimate. A pair at the threshold itself shares no band with a chance of 1 in 80,000; the estimate of
the fourth round drops it with a chance of 1 in 10,000, that of the first three with none to speak of.

Null and empty texts have no shingles and are linked with nothing. Rows with the
same id and text give equal results; an id with several texts is a vertex that all
of them share. The input's other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import ragged
from .components import components

BANDS, ROWS = 48, 7
FIELDS = BANDS * ROWS
WORDS = -(-FIELDS * 2 // 64)
#: Estimates may fall short of the threshold by this much (standard deviation: 0.026), in the first rounds and in the last.
MARGIN, LAST_MARGIN = 0.2, 0.1
#: Texts are looked up by this many hash slots at most, whose list is broadcast.
SLOTS = 1 << 20
U64 = np.uint64
_MULT = (ragged.mix(np.arange(FIELDS, dtype=U64) + U64(7001)) >> U64(32)).astype(np.uint32) | np.uint32(1)
_FLIP = (ragged.mix(np.arange(FIELDS, dtype=U64) + U64(9001)) >> U64(32)).astype(np.uint32)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row: ``width`` words, or the whole sequence if it is shorter."""
    out = []
    for low, high in ragged.slices(offsets):
        part, ends = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        starts, stops, counts = ragged.spans(part, ends, ragged.NOT_SPACE)
        words = ragged.span_hashes(part, starts, stops, ragged.LOWER_VALUE)
        grams = words.copy()
        for i in range(1, width):
            grams[: len(words) - i] = ragged.mix(grams[: len(words) - i] * U64(0xD6E8FEB86659FD93) + words[i:])
        at = ragged.starts_of(counts)
        for row in range(high - low):
            n = int(counts[row])
            if n >= width:
                out.append(np.unique(grams[at[row] : at[row + 1] - width + 1]))
            elif n:
                short = np.array([n], U64)
                for i in range(at[row], at[row + 1]):
                    short = ragged.mix(short * U64(0xA0761D6478BD642F) + words[i])
                out.append(short)
            else:
                out.append(np.zeros(0, U64))
    return out


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (rows x bands) and packed two-bit fields (rows x words) of sets that aren't empty."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    minima = np.zeros((FIELDS, len(sets)), np.uint32)
    at = 0
    for low, high in ragged.slices(ragged.starts_of(sizes * 8)):
        x = (np.concatenate(sets[low:high]) >> U64(32)).astype(np.uint32)
        first = ragged.starts_of(sizes[low:high])[:-1]
        for k in range(FIELDS):
            minima[k, low:high] = np.minimum.reduceat((x ^ _FLIP[k]) * _MULT[k], first)
        at = high
    assert at == len(sets)
    keys = np.zeros((len(sets), BANDS), U64)
    for band in range(BANDS):
        h = np.full(len(sets), band + 1, U64)
        for k in range(band * ROWS, band * ROWS + ROWS):
            h = ragged.mix(h * U64(0x9FB21C651E98DF25) + minima[k])
        keys[:, band] = h
    bits = np.zeros((len(sets), WORDS), U64)
    for k in range(FIELDS):
        bits[:, k // 32] |= (minima[k].astype(U64) & U64(3)) << U64(2 * (k % 32))
    return keys, bits


def sketches(df: DataFrame, width: int) -> DataFrame:
    """id, n_shingles, set_a, set_b (a 128-bit hash of the set), bands, bits; arrays are null for empty sets."""
    import xxhash

    def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(*ragged.packed(batch.column(1)), width)
        full = [s for s in sets if len(s)]
        keys, bits = signatures(full) if full else (np.zeros((0, BANDS), U64), np.zeros((0, WORDS), U64))
        has = np.fromiter((len(s) > 0 for s in sets), bool, len(sets))
        digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)

        def lists(values: np.ndarray) -> pa.Array:
            ends = ragged.starts_of(has * values.shape[1]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends, mask=np.append(~has, False)), pa.array(values.ravel().view(np.int64)))

        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()), lists(keys), lists(bits)],
            ["id", "n_shingles", "set_a", "set_b", "bands", "bits"],
        )

    kind = df.schema["id"].dataType.simpleString()
    return ragged.map_batches(df, lambda: handle, f"id {kind}, n_shingles long, set_a long, set_b long, bands array<long>, bits array<long>")


def estimate(a: str, b: str):
    """Similarity from two packed columns: equal fields, corrected for the quarter that agrees by chance."""
    low = F.lit(0x5555555555555555)
    differ = None
    for i in range(WORDS):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        n = F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(low))
        differ = n if differ is None else differ + n
    return ((1 - differ / F.lit(FIELDS)) - 0.25) / 0.75


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, text_a, text_b of the pairs."""
    slot = F.pmod(F.xxhash64("id"), F.lit(SLOTS)).cast("int").alias("slot")
    sides = [pairs.select(F.col(c).alias("id")).select(slot).distinct() for c in ("a", "b")]
    needed = sides[0].union(sides[1]).distinct()  # at most SLOTS rows
    own = texts.join(F.broadcast(needed), slot == needed["slot"], "left_semi")
    own = written(own, "texts")
    both = pairs.join(own.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(own.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b")


def set_pairs(batch: pa.RecordBatch, width: int):
    """The two sorted shingle sets of each row of ``with_texts``; a right text that follows itself is split once."""
    last = (None, None)
    for x, right in zip(shingle_sets(*ragged.packed(batch.column(2)), width), batch.column(3), strict=True):
        text = right.as_py()
        if text != last[0]:
            last = text, shingle_sets(*ragged.packed(pa.array([text], pa.large_string())), width)[0]
        yield x, last[1]


def differences(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """a, size (of its set), elements: those of the set of a or of the set of b, but not of both. Ids with several texts have rows for each."""
    kind = pairs.schema["a"].dataType.simpleString()

    def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, parts = [], []
        for x, y in set_pairs(batch, width):
            sizes.append(len(x))
            parts.append(np.setxor1d(x, y, assume_unique=True))
        ends = pa.array(ragged.starts_of(np.fromiter(map(len, parts), np.int64, len(parts))).astype(np.int32))
        values = pa.array(np.concatenate(parts).view(np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, values)], ["a", "size", "elements"])

    both = with_texts(pairs, texts).sortWithinPartitions("b")
    return ragged.map_batches(both, lambda: handle, f"a {kind}, size long, elements array<long>")


def sharing(members: DataFrame, percent: int) -> DataFrame:
    """Pairs a < b of one family and different components whose differences from its centre share enough to be linked.

    ``members`` has family, id, version (of the id's texts), component, size and elements. If x and y are linked, the first element that
    their differences share (in an order common to the family) has as many after it on both sides as must be shared.
    """
    most, far = 100 - percent, 100 + percent  # linked sets differ in most / far of their sizes' sum, at the most
    each = members.select("family", "id", "version", F.explode("elements").alias("element"))
    rare = written(each.groupBy("family", "element").agg(F.count("*").alias("n")), "rarity")
    ranked = each.join(rare, ["family", "element"]).groupBy("family", "id", "version").agg(F.array_sort(F.collect_list(F.struct("n", "element"))).alias("ranked"))  # of one document
    places = ranked.join(members.select("family", "id", "version", "component", "size"), ["family", "id", "version"])
    places = places.select("family", "id", "component", "size", F.size("ranked").alias("all"), F.posexplode("ranked").alias("place", "x"))
    # No partner is larger than 100 / percent of the size, and its difference is not shorter by more than a link allows.
    furthest = F.floor(most * F.col("size") / F.lit(percent))
    entries = written(places.where((F.col("x.n") > 1) & (F.col("place") <= furthest)).select("family", "id", "component", "size", "all", "place", F.col("x.element").alias("element")), "prefixes")
    x, y = (entries.select("family", "element", *[F.col(c).alias(f"{c}_{k}") for c in ("id", "component", "size", "all", "place")]) for k in ("a", "b"))
    must = F.ceil((far * (F.col("all_a") + F.col("all_b")) - most * (F.col("size_a") + F.col("size_b"))) / F.lit(2 * far))
    fits = 100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b")
    early = (F.col("place_a") <= F.col("all_a") - must) & (F.col("place_b") <= F.col("all_b") - must)
    pairs = x.join(y.withColumnsRenamed({"family": "family_b", "element": "element_b"}), (F.col("family") == F.col("family_b")) & (F.col("element") == F.col("element_b")) & (F.col("component_a") < F.col("component_b")) & fits & early)
    return pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    kind = pairs.schema["a"].dataType.simpleString()

    def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in set_pairs(batch, width):
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(bool(shared) and 100 * shared >= percent * (len(x) + len(y) - shared))
        keep = pa.array(keep)
        return pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return ragged.map_batches(with_texts(pairs, texts), lambda: handle, f"a {kind}, b {kind}").distinct()


def near_duplicates(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id column, n_shingles, component_id (smallest id reachable by links) and kept (id = component_id) for every row."""
    texts = df.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    sketch = written(sketches(texts, width), "sketches")
    full = sketch.where("n_shingles > 0 AND id IS NOT NULL")
    classes = written(full.groupBy("set_a", "set_b").agg(F.min("id").alias("rep")), "classes")
    member = written(
        full.join(classes, ["set_a", "set_b"]).select("id", "rep", F.when(F.col("id") == F.col("rep"), F.col("bands")).alias("bands"), F.when(F.col("id") == F.col("rep"), F.col("bits")).alias("bits")),
        "members",
    )
    several = member.select("id", "rep").where("id != rep")  # copies of one set
    reps = member.where("bands IS NOT NULL")
    facts = written(reps.join(full.select("id", F.col("n_shingles").alias("size")).dropDuplicates(["id"]), "id").select("id", "bits", "size"), "facts")
    in_band = reps.select("id", F.explode("bands").alias("band"))
    buckets = written(in_band.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    shared = in_band.join(buckets, "band").groupBy("id").agg(F.sum("n").alias("central"), F.collect_list("band").alias("bands"))  # bands of one document
    shared = written(shared, "shared")
    member_of = written(shared.select(F.explode("bands").alias("band"), "id", "central"), "member-of")

    def centre(frame: DataFrame, *key: str) -> DataFrame:
        """The most central id of each group, the smaller one of equals."""
        return frame.groupBy(*key).agg(F.max_by("id", F.struct("central", F.negative("id"))).alias("centre"), F.count("*").alias("n"))

    def likely(pairs: DataFrame, margin: float = MARGIN) -> DataFrame:
        """Pairs (a, b) whose estimate is not far below the threshold."""
        out = pairs.join(facts.select(F.col("id").alias("a"), F.col("bits").alias("bits_a")), "a")
        out = out.join(facts.select(F.col("id").alias("b"), F.col("bits").alias("bits_b")), "b")
        return written(out.where(estimate("bits_a", "bits_b") >= percent / 100 - margin).select("a", "b"), "likely")

    def merged(found: DataFrame, links: DataFrame) -> DataFrame:
        """Components joined by more links between documents."""
        name = [found.select(F.col("id").alias(k), F.col("component").alias(f"c_{k}")) for k in ("a", "b")]
        links = links.join(name[0], "a", "left").join(name[1], "b", "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
        joined = components(links).select(F.col("id").alias("component"), F.col("component").alias("joined"))
        old = found.join(joined, "component", "left").select("id", F.coalesce("joined", "component").alias("component"))
        alone = joined.join(found.select(F.col("id").alias("component")), "component", "left_anti").select(F.col("component").alias("id"), F.col("joined").alias("component"))
        return written(old.union(alone), "found")

    def open_buckets(found: DataFrame) -> DataFrame:
        """band, id, central, component in buckets with several components."""
        labelled = written(member_of.join(found, "id", "left").withColumn("component", F.coalesce("component", "id")), "labelled")
        split = written(labelled.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("band"), "split")
        return written(labelled.join(split, "band"), "open")

    centres = written(centre(member_of, "band").select("band", "centre"), "centres")
    asked = member_of.join(centres, "band").where("id != centre").groupBy("id", "centre").agg(F.count("*").alias("n"))
    first = asked.groupBy(F.col("id").alias("a")).agg(F.max_by("centre", F.struct("n", F.negative("centre"))).alias("b"))
    found = components(confirmed(likely(first), texts, width, percent))

    split = open_buckets(found)
    parts = centre(split, "band", "component")
    main = written(parts.groupBy("band").agg(F.max(F.struct("n", F.negative("component").alias("c"), "centre")).alias("m")).select("band", F.negative("m.c").alias("main"), F.col("m.centre").alias("b")), "main")
    second = split.join(main, "band").where("component != main").select(F.col("id").alias("a"), "b").distinct()
    found = merged(found, confirmed(likely(second), texts, width, percent))

    split = open_buckets(found)
    lowest = written(split.groupBy("band").agg(F.min("id").alias("b")), "lowest")
    family = components(split.join(lowest, "band").select(F.col("id").alias("a"), "b")).select("id", F.col("component").alias("family"))
    member = written(split.select("id", "central", "component").distinct().join(family, "id"), "families")
    middle = member.groupBy("family").agg(F.max_by(F.struct("id", "component"), F.struct("central", F.negative("id"))).alias("c"))
    middle = written(middle.select("family", F.col("c.id").alias("b"), F.col("c.component").alias("main")), "middles")
    around = written(member.join(middle, "family"), "around")
    third = around.where("component != main").select(F.col("id").alias("a"), "b")
    found = merged(found, confirmed(likely(third), texts, width, percent))

    around = around.drop("component", "main").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    around = written(around, "around")
    apart = written(around.groupBy("family").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("family"), "apart")
    left = written(around.join(apart, "family").select("family", "id", "component", "b"), "left")
    parts = differences(left.select(F.col("id").alias("a"), "b"), texts, width).withColumnRenamed("a", "id")
    parts = parts.withColumn("version", F.xxhash64("size", "elements")).dropDuplicates(["id", "version"])
    parts = written(parts.join(left.select("family", "id", "component"), "id"), "differences")
    fourth = likely(written(sharing(parts, percent), "fourth"), LAST_MARGIN)
    final = merged(found, confirmed(fourth, texts, width, percent))

    named = final.select(F.col("id").alias("rep"), "component")
    of = several.union(reps.select("id", "id")).toDF("id", "rep").join(named, "rep", "left").select("id", F.coalesce("component", "rep").alias("component"))
    of = of.groupBy("id").agg(F.min("component").alias("component"))
    out = sketch.select("id", "n_shingles").join(of, "id", "left").withColumn("component_id", F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
