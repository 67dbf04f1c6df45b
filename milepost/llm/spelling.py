"""Spelling variants of a corpus vocabulary by finite-state composition.

Two words are near if one inserted, deleted or replaced code point turns one into the other. The
near pairs are what the composition V o E o V accepts: V is the minimised acceptor of the vocabulary,
E the transducer that copies code points and edits exactly one. A state of the composition is a pair of
states of V and whether the edit has been used; until then both are the same state of V, so the
composition falls apart by the state of V that a prefix leads to. Each such initial state is a group of
words that share the prefix, and tasks enumerate the pairs accepted from theirs:

1. V runs forwards from the states after ``HEAD`` code points, which gives the pairs whose edit comes
   later, and backwards (words reversed, a shared ending of ``least - HEAD``) for those with an earlier edit.
2. A state with more than ``LIMIT`` words behind it is not handed to a task. Its own edit arcs are
   equijoins on what remains of the words (a group of them has a word for each letter at most), and its
   copying arcs lead to the states one code point further on, which are counted and split in turn.
3. A task reads its groups in order, a bounded number of words at once, builds their acceptor as numpy
   arrays and minimises it from the longest-lived states down (states are merged if their arcs are
   equal, which is compared, not only hashed). Arcs carry how many words are passed over, so a path
   through the minimised acceptor still tells its word's number.
4. The composition is expanded breadth first, all its states of a depth at once.

A word's form is its near word of largest count (ties: smallest in code-point order) if that is at least
``ratio`` times as frequent; roots follow forms to the end by doubling, since counts rise along them.

Words are maximal runs of letters, A-Z lower-cased; a text is split whole, and a null text has none. The
typing errors that ``vocabulary`` makes depend on id and run alone; a null id makes none. Repeated rows
count again. Other columns are not read. Empty tables give no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import ragged

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Code points that lead to the initial states of the forward acceptor.
HEAD = 3
#: Words of one initial state that a task takes; a state with more is split.
LIMIT = 20_000
#: Words whose acceptor a task builds at once (whole groups, so up to LIMIT more).
TOGETHER = 40_000


def vocabulary(docs: DataFrame, least: int = 7, times: int = 2, id_col: str = "doc_id", text_col: str = "text", every: int = 31) -> DataFrame:
    """word, n: lower-cased runs of letters, every ``every``-th one (by the hash of id and run) without one code point."""
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(text_col, F.lit(f"({LETTERS})"))).alias("run"))
    runs = runs.where(F.length("run") >= least).select("id", F.translate("run", UPPER, UPPER.lower()).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = runs.select(F.when(h % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


class Acceptor:
    """Minimised acceptor of sorted, distinct words below roots; word numbers are kept as sums along paths.

    ``points`` are the code points of all words, ``ends`` their n + 1 offsets, ``group`` the
    root of each word (ascending).
    """

    def __init__(self, points: np.ndarray, ends: np.ndarray, group: np.ndarray):
        size, count = np.diff(ends), len(group)
        roots = int(group[-1]) + 1 if count else 0
        node, alive, made = group.astype(np.int64), np.arange(count), roots
        sources, letters, targets, final = [], [], [], [node[size == 0]]
        depth = 0
        while len(alive := alive[size[alive] > depth]):
            own, letter = node[alive], points[ends[alive] + depth]
            new = np.concatenate(([True], (own[1:] != own[:-1]) | (letter[1:] != letter[:-1])))
            child = made + np.cumsum(new) - 1
            sources.append(own[new])
            letters.append(letter[new])
            targets.append(child[new])
            node[alive] = child
            made = int(child[-1]) + 1
            depth += 1
            final.append(child[size[alive] == depth])
        self.final = np.zeros(made, bool)
        self.final[np.concatenate(final)] = True
        empty = [np.zeros(0, np.int64)]
        self._minimise(np.concatenate(sources or empty), np.concatenate(letters or empty), np.concatenate(targets or empty), made)
        self.roots = self.classes[:roots]
        self.base = np.searchsorted(group, np.arange(roots))

    def _minimise(self, source: np.ndarray, letter: np.ndarray, target: np.ndarray, states: int) -> None:
        """Merge states whose arcs are equal, lowest first; sources ascend, and letters within them."""
        first = np.searchsorted(source, np.arange(states + 1))
        degree = np.diff(first)
        height = np.zeros(states, np.int64)
        # A target's number is larger than its source's, and levels are numbered one after the other.
        for low, high in reversed(list(_levels(source, target))):
            np.maximum.at(height, source[low:high], height[target[low:high]] + 1)
        classes, words = np.full(states, -1, np.int64), np.zeros(states, np.int64)
        order = np.argsort(height, kind="stable")
        cut = np.searchsorted(height[order], np.arange(height.max(initial=-1) + 2))
        for low, high in zip(cut[:-1], cut[1:], strict=True):
            own = order[low:high]
            arcs, of = _arcs(first, degree, own)
            code = ragged.mix(classes[target[arcs]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + letter[arcs].astype(np.uint64))
            code = ragged.mix(code + (arcs - first[own][of]).astype(np.uint64))
            key = np.zeros(len(own), np.uint64)
            np.add.at(key, of, code)
            key = ragged.mix(key + self.final[own])
            _, at, inverse = np.unique(key, return_index=True, return_inverse=True)
            head = own[at[inverse]]
            same = (degree[own] == degree[head]) & (self.final[own] == self.final[head])
            there = np.minimum(arcs - first[own][of] + first[head][of], max(len(source) - 1, 0))
            differ = (letter[arcs] != letter[there]) | (classes[target[arcs]] != classes[target[there]])
            same &= np.bincount(of, differ, len(own)) == 0
            classes[own] = np.where(same, head, own)
            words[own] = self.final[own] + np.bincount(of, words[target[arcs]], len(own)).astype(np.int64)
        self.classes = classes
        kept = classes[source] == source
        passed = np.cumsum(words[target]) - words[target]
        passed -= (passed[first[source]] if len(source) else 0) - self.final[source]
        self.letter, self.to, self.passed = letter[kept], classes[target[kept]], passed[kept]
        self.first = np.searchsorted(source[kept], np.arange(states + 1))
        self.degree = np.diff(self.first)
        self.key = source[kept] << 32 | self.letter.astype(np.int64)

    def arcs(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Arcs out of each state, and which of the given states each belongs to."""
        return _arcs(self.first, self.degree, state)

    def one_edit(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of word numbers, one edit apart, that the composition accepts from the roots."""
        q, at = self.roots, self.base.astype(np.int64)
        none = np.zeros(0, np.int64)
        edited = (none, none, none, none)
        out = []
        while len(q) or len(edited[0]):
            arc, of = self.arcs(q)
            to, number = self.to[arc], at[of] + self.passed[arc]
            one, two = _pairs_within(np.bincount(of, minlength=len(q)).astype(np.int64))
            edited = self._copied(*edited)
            edited = tuple(
                np.concatenate(x)
                for x in zip(edited, (to, number, q[of], at[of]), (to[one], number[one], to[two], number[two]), strict=True)  # copied on; inserted; replaced
            )
            both = self.final[edited[0]] & self.final[edited[2]]
            out.append(np.stack([edited[1][both], edited[3][both]]))
            q, at = to, number
        found = np.concatenate(out, 1) if out else np.zeros((2, 0), np.int64)
        found = np.unique(found.min(0) << 32 | found.max(0))  # an insertion into a run of one letter is accepted at every place of it
        return found >> 32, found & 0xFFFFFFFF

    def _copied(self, q1: np.ndarray, n1: np.ndarray, q2: np.ndarray, n2: np.ndarray):
        """States after one copied code point from states whose edit is used."""
        swap = self.degree[q1] > self.degree[q2]
        q1, q2, n1, n2 = np.where(swap, q2, q1), np.where(swap, q1, q2), np.where(swap, n2, n1), np.where(swap, n1, n2)
        arc, of = self.arcs(q1)
        if not len(arc):
            none = np.zeros(0, np.int64)
            return none, none, none, none
        want = q2[of] << 32 | self.letter[arc].astype(np.int64)
        other = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        hit = self.key[other] == want
        arc, of, other = arc[hit], of[hit], other[hit]
        return self.to[arc], n1[of] + self.passed[arc], self.to[other], n2[of] + self.passed[other]


def _levels(source: np.ndarray, target: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of arcs, one for each depth: the sources of a depth are the targets of the one before."""
    at = 0
    while at < len(source):
        end = int(np.searchsorted(source, target[at])) if at < len(source) else at
        yield at, end
        at = end


def _arcs(first: np.ndarray, degree: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = degree[state]
    of = ragged.row_of(n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[state], n), of


def _pairs_within(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j within consecutive groups of the given sizes."""
    start = np.cumsum(counts) - counts
    total = int(counts.sum())
    later = np.repeat(start + counts, counts) - np.arange(total) - 1
    one = np.repeat(np.arange(total), later)
    return one, one + 1 + np.arange(len(one)) - np.repeat(np.cumsum(later) - later, later)


def accepted(groups: pa.Table) -> pa.RecordBatch:
    """Near pairs of rows (key, rest, word, n) that are sorted by key and rest."""
    rest = groups["rest"].combine_chunks()
    points = np.frombuffer("".join(rest.to_pylist()).encode("utf-32-le"), np.uint32)
    ends = ragged.starts_of(pc.utf8_length(rest).to_numpy(zero_copy_only=False).astype(np.int64))
    keys = groups["key"].combine_chunks()
    new = np.concatenate(([0], pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False))).astype(np.int64)
    a, b = Acceptor(points, ends, np.cumsum(new)).one_edit()
    of = groups.select(["word", "n"])
    a, b = of.take(pa.array(a)), of.take(pa.array(b))
    columns = [t[c].combine_chunks() for t in (a, b) for c in ("word", "n")]
    return pa.RecordBatch.from_arrays(columns, ["a", "a_n", "b", "b_n"])


def _enumerate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs within the groups of a task, whose rows are sorted; some groups at once."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(x.num_rows for x in held) >= TOGETHER:
            rows = pa.Table.from_batches(held)
            last = pc.index(rows["key"], rows["key"][-1]).as_py()  # its group may go on
            if last:
                yield accepted(rows[:last])
                held = rows[last:].combine_chunks().to_batches()
    if held:
        yield accepted(pa.Table.from_batches(held))


def near_pairs(words: DataFrame, head: int, limit: int = LIMIT) -> DataFrame:
    """a, a_n, b, b_n: pairs of rows (form, word, n) whose forms are one edit apart after the first ``head`` code points; pairs may repeat."""
    spark = words.sparkSession
    cut = lambda c, low: F.substring(F.col(c), low, 1 << 30)
    at = words.select(F.substring("form", 1, head).alias("key"), cut("form", head + 1).alias("rest"), "word", "n")
    closed, pairs = [], []
    while True:
        hot = written(at.groupBy("key").agg(F.count("*").alias("words")).where(F.col("words") > limit).select("key"), "hot-states")
        if hot.isEmpty():
            break
        closed.append(at.join(hot, "key", "left_anti"))
        at = written(at.join(hot, "key", "left_semi"), "split-states")
        longer = at.where("rest != ''")
        less = longer.select("key", cut("rest", 2).alias("rest"), F.col("word").alias("a"), F.col("n").alias("a_n"))
        others = less.select("key", "rest", F.col("a").alias("b"), F.col("a_n").alias("b_n"))
        whole = at.select("key", "rest", F.col("word").alias("b"), F.col("n").alias("b_n"))
        pairs.append(less.join(others, ["key", "rest"]).where("a < b").select("a", "a_n", "b", "b_n"))
        pairs.append(less.join(whole, ["key", "rest"]).select("a", "a_n", "b", "b_n"))
        at = longer.select(F.concat("key", F.substring("rest", 1, 1)).alias("key"), cut("rest", 2).alias("rest"), "word", "n")
    for rows in closed:
        at = at.unionByName(rows)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = at.repartition(parts, "key").sortWithinPartitions("key", "rest").mapInArrow(ragged.per_task(_enumerate), "a string, a_n long, b string, b_n long")
    for rows in pairs:
        out = out.union(rows)
    return out


def variants(docs: DataFrame, least: int = 7, times: int = 2, ratio: int = 10, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``vocabulary``."""
    words = written(vocabulary(docs, least, times, id_col, text_col), "vocabulary")
    head = min(HEAD, least - 1)
    late = near_pairs(words.withColumn("form", F.col("word")), head, limit)
    early = near_pairs(words.withColumn("form", F.reverse("word")), least - head, limit)
    # An edit within the first code points leaves all but ``head`` of the longer word as a common ending.
    early = early.where(F.substring("a", 1, head) != F.substring("b", 1, head))
    pairs = late.union(early)
    near = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))).alias("x"))
    near = near.select("x.*").groupBy("word").agg(F.count_distinct("near").alias("n_near"), F.min(F.struct(F.negative("near_n").alias("less"), "near")).alias("best"))
    found = words.join(near, "word", "left")
    best_n = F.negative("best.less")
    found = found.withColumns({"form": F.when(best_n >= ratio * F.col("n"), F.col("best.near")), "form_n": F.when(best_n >= ratio * F.col("n"), best_n)})
    found = written(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form", "form_n"), "forms")
    roots = written(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        step = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if roots.join(step, "root", "left_semi").isEmpty():
            break
        roots = written(roots.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle(least: int = 7, times: int = 2, ratio: int = 10, every: int = 31) -> str:
    """``variants`` of ``documents`` in DuckDB SQL."""
    return rf"""
WITH RECURSIVE o AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), '{UPPER}', '{UPPER.lower()}') AS run FROM documents),
r AS (SELECT doc_id, run, count(*) AS n, hex(encode(doc_id::VARCHAR || ':' || run)) AS x FROM o WHERE length(run) >= {least} GROUP BY ALL),
c AS (SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT], flatten([[('0x' || x[2 * i + 1:2 * i + 2])::BIGINT, 0, 0, 0, 0, 0, 0, 0] for i in range(length(x) // 2)])),
  lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384::BIGINT)), 4294967295) AS h FROM r),
w AS (SELECT CASE WHEN h % {every} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM c),
v AS (SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= {least} GROUP BY word HAVING sum(n) >= {times}),
d AS (SELECT word, i, word[:i] || word[i + 2:] AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM v)),
p AS (SELECT a.word AS a, b.word AS b FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT d.word, v.word FROM d JOIN v ON d.rest = v.word UNION SELECT v.word, d.word FROM d JOIN v ON d.rest = v.word),
f AS (SELECT a AS word, count(*) AS n_near, arg_min(b, (-v.n, encode(b))) AS near, max(v.n) AS near_n FROM p JOIN v ON v.word = b GROUP BY a),
k AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {ratio} * v.n THEN near END AS form, CASE WHEN near_n >= {ratio} * v.n THEN near_n END AS form_n FROM v LEFT JOIN f USING (word)),
t(word, last, further) AS (SELECT word, word, form FROM k UNION ALL SELECT t.word, k.word, k.form FROM t JOIN k ON t.further = k.word)
SELECT k.word, k.form, t.last AS root, k.n, k.n_near, k.form_n FROM k JOIN t ON t.word = k.word AND t.further IS NULL
"""
