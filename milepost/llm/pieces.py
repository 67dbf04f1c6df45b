"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

Words (a run of spaces and what follows it) of equal length advance together: at
each end position the polynomial hashes of all substrings that end there probe
the sorted hashes of the pieces, and a vectorised maximum over the pieces stores
the back pointer. For a unigram model the best sum of scores wins. In a BPE model
the score only orders merges, so the best sum is not the library's answer; there
a step is admitted only if the piece and the one before it stay apart when the
two are merged by rank (a memory of judged pairs keeps this cheap). Exactly one
path of admitted steps exists, the one that merging in rank order gives, and the
maximum picks it. Characters without a piece become byte pieces (or the unknown
piece where the model has none).

Nulls and empty texts have no ids and decode to the empty string. Texts are
taken whole, whatever their length. Repeated rows give repeated results. New
columns that would clash with columns of the input replace them.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ragged

SPACE = "▁"
WORDS = re.compile(" +[^ ]*|^[^ ]+")
#: Words remembered by a worker; beyond it the memory starts anew, results stay.
REMEMBERED = 400_000
U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
FAR = np.int64(1 << 40)
#: Characters of the words that advance together.
TOGETHER = 400_000


class Pieces:
    """Tables of a SentencePiece model; their size is that of the vocabulary."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kinds = model.normalizer_spec, pb.ModelProto.SentencePiece
        self.bpe = model.trainer_spec.model_type == pb.TrainerSpec.BPE
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models with the identity normaliser are supported")
        if not self.bpe and model.trainer_spec.model_type != pb.TrainerSpec.UNIGRAM:
            raise ValueError("only BPE and unigram models are supported")
        if any(p.type == kinds.USER_DEFINED for p in model.pieces):
            raise ValueError("models with user-defined pieces are not supported")
        self.prefix = norm.add_dummy_prefix
        self.size = len(model.pieces)
        own = {p.piece.replace(SPACE, " "): i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        scores = np.array([p.score for p in model.pieces], np.float64)
        if any(" " in s.lstrip(" ") for s in own):
            raise ValueError("models with pieces across word borders are not supported")
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        self.bytes = np.full(256, -1, np.int64)
        self.out = [b""] * self.size
        for i, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
                self.out[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == kinds.UNKNOWN:
                self.out[i] = (model.trainer_spec.unk_surface or " ⁇ ").encode()
            elif p.type == kinds.NORMAL:
                self.out[i] = p.piece.replace(SPACE, " ").encode()
        self.fallback = bool((self.bytes >= 0).all())
        self.score = np.append(scores, min((scores[i] for i in own.values()), default=0.0) - 10.0)  # the last: unknown
        # Merge trees: what the last merge of a piece joins, and when that happens.
        self.left, self.right = np.full(self.size + 1, -1, np.int64), np.full(self.size + 1, -1, np.int64)
        self.when = np.full(self.size + 1, -1, np.int64)
        if self.bpe:
            own = self._trees(own, scores)
        text, ids = [*own], np.fromiter(own.values(), np.int64, len(own))
        self.longest = max(map(len, text), default=1)
        hashes = np.array([self.hash_text(s) for s in text], U64)
        order = np.argsort(hashes)
        self.keys, self.ids = hashes[order], ids[order]
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces share a hash")
        self.hash, self.length = np.zeros(self.size + 1, U64), np.ones(self.size + 1, np.int64)
        self.hash[ids], self.length[ids] = hashes, [len(s) for s in text]
        self.maybe = np.zeros(1 << 19, bool)  # turns away most substrings that are no pieces
        self.maybe[(self.keys & U64((1 << 19) - 1)).astype(np.int64)] = True
        self.power = np.multiply.accumulate(np.concatenate(([U64(1)], np.full(2 * self.longest + 1, BASE, U64))))

    def _trees(self, own: dict[str, int], scores: np.ndarray) -> dict[str, int]:
        """Run the merges of every piece; one that its own merges don't give can't occur."""
        rank = {i: r for r, i in enumerate(sorted(own.values(), key=lambda i: -scores[i]))}
        singles = {c for s in own for c in s}
        if not singles <= own.keys():
            raise ValueError("models with pieces of characters that are no pieces are not supported")
        good = {}
        for s, i in sorted(own.items(), key=lambda x: len(x[0])):
            parts, pair = [*s], None
            while len(parts) > 1:
                found = [(rank[own[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in own]
                if not found:
                    break
                k = min(found)[1]
                pair = parts[k], parts[k + 1]
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            if len(parts) == 1:
                good[s] = i
                if pair:
                    self.left[i], self.right[i] = own[pair[0]], own[pair[1]]
                    self.when[i] = max(rank[i], self.when[self.left[i]], self.when[self.right[i]])
        self.merge = np.full(self.size + 1, FAR, np.int64)
        self.merge[[*rank]] = [*rank.values()]
        return good

    @staticmethod
    def values(codes: np.ndarray) -> np.ndarray:
        return ragged.mix((codes.astype(U64) + U64(1)) * BASE)

    def hash_text(self, text: str) -> np.uint64:
        out = U64(0)
        with np.errstate(over="ignore"):
            for v in self.values(np.frombuffer(text.encode("utf-32-le"), np.uint32)):
                out = out * BASE + v
        return out

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids of hashes, -1 where there is none."""
        out = np.full(hashes.shape, -1, np.int64)
        some = np.nonzero(self.maybe[(hashes & U64((1 << 19) - 1)).astype(np.int64)])
        probe = hashes[some]
        at = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
        out[some] = np.where(self.keys[at] == probe, self.ids[at], -1)
        return out

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of a and b by rank leaves the two pieces apart.

        The merges are undone from the last one back. The pair that meets at the
        border must never be the next merge; of equal merges the left one is first.
        """
        ok, a, b = np.ones(len(a), bool), a.copy(), b.copy()
        at, until = np.arange(len(a)), np.full(len(a), FAR, np.int64)
        while len(at):
            both = self.find(self.hash[a] * self.power[self.length[b]] + self.hash[b])
            first = np.where(both >= 0, self.merge[both], FAR)
            first = np.where(first < FAR, np.maximum(first, np.maximum(self.when[a], self.when[b])), FAR)
            bad = first < until
            ok[at[bad]] = False
            wa, wb = self.when[a], self.when[b]
            go = ~bad & ((wa >= 0) | (wb >= 0))
            at, a, b, wa, wb = at[go], a[go], b[go], wa[go], wb[go]
            undo = wa > wb
            until = np.where(undo, wa, wb + 1)
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return ok


class Encoder:
    """Encodes texts; remembers words and judged pairs of pieces."""

    PAIRS = 1 << 20

    def __init__(self, pieces: Pieces):
        self.p, self.known = pieces, {}
        self.pair, self.verdict = np.full(self.PAIRS, -1, np.int64), np.zeros(self.PAIRS, bool)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * (self.p.size + 1) + b
        slot = (ragged.mix(key.astype(U64)) & U64(self.PAIRS - 1)).astype(np.int64)
        out = self.verdict[slot]
        new = np.flatnonzero(self.pair[slot] != key)
        if len(new):
            some, first, where = np.unique(key[new], return_index=True, return_inverse=True)
            judged = self.p.apart(some // (self.p.size + 1), some % (self.p.size + 1))
            out[new] = judged[where]
            slots, one = np.unique(slot[new][first], return_index=True)  # one key for each slot
            self.pair[slots], self.verdict[slots] = some[one], judged[one]
        return out

    def equal_length(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi over a matrix of words by characters: ids in one run, ids per word."""
        p, (n, size) = self.p, codes.shape
        value = p.values(codes)
        prefix = np.zeros((n, size + 1), U64)
        for i in range(size):
            prefix[:, i + 1] = prefix[:, i] * BASE + value[:, i]
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        last, back = np.full((n, size + 1), -1, np.int64), np.zeros((n, size + 1), np.int32)
        all_ = np.arange(n)
        for end in range(1, size + 1):
            k = np.arange(1, min(end, p.longest) + 1)
            piece = p.find(prefix[:, end, None] - prefix[:, end - k] * p.power[k])
            piece[:, 0] = np.where(piece[:, 0] < 0, p.size, piece[:, 0])
            if p.bpe:
                pick = self.admitted(piece, last[:, end - k])
            else:
                total = best[:, end - k] + np.where(piece < 0, -np.inf, p.score[piece])
                pick = total.argmax(axis=1)
                best[:, end] = total[all_, pick]
            last[:, end], back[:, end] = piece[all_, pick], pick + 1
        ids, at = [], np.full(n, size)
        while (at > 0).any():
            ids.append(np.where(at > 0, last[np.arange(n), at], -1))
            at = at - back[np.arange(n), at]
        ids = np.stack(ids[::-1], axis=1)
        return ids[ids >= 0], (ids >= 0).sum(axis=1)

    def admitted(self, piece: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Column of the one piece of each row that stays apart from the piece before it.

        The longest are judged first; a row's last candidate needs no judgement.
        """
        size, width = self.p.size, piece.shape[1]
        rows, cols = np.nonzero(piece[:, ::-1] >= 0)
        cols = width - 1 - cols
        at = np.searchsorted(rows, np.arange(len(piece)))
        end = np.append(at[1:], len(rows))
        a, b = before[rows, cols], piece[rows, cols]
        free = (a < 0) | (a == size) | (b == size)
        open_ = np.flatnonzero((end - at > 1) & ~free[at])
        while len(open_):
            i = at[open_]
            bad = open_[~self.apart(a[i], b[i])]
            at[bad] += 1
            open_ = bad[(end[bad] - at[bad] > 1) & ~free[at[bad]]]
        return cols[at]

    def learn(self, words: list[str]) -> None:
        by_size: dict[int, list[str]] = {}
        for w in words:
            by_size.setdefault(len(w), []).append(w)
        for size, same in by_size.items():
            step = max(1, TOGETHER // size)
            for i in range(0, len(same), step):
                some = same[i : i + step]
                codes = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32).reshape(len(some), size)
                ids, counts = self.equal_length(codes)
                ends = np.cumsum(counts)
                odd = set(ragged.row_of(counts)[ids == self.p.size].tolist())
                raw, from_ = ids.astype("<i4").tobytes(), (ends - counts).tolist()
                for r, (w, low, high) in enumerate(zip(some, from_, ends.tolist(), strict=True)):
                    self.known[w] = raw[4 * low : 4 * high] if r not in odd else self.spelled(w, ids[low:high])

    def spelled(self, word: str, ids: np.ndarray) -> bytes:
        """Ids of a word with unknown characters: byte pieces, or one unknown for a run of them."""
        out, at = [], 0
        for i in ids.tolist():
            if i != self.p.size:
                out.append(i)
                at += int(self.p.length[i])
                continue
            if self.p.fallback:
                out += self.p.bytes[[*word[at].encode()]].tolist()
            elif not out or out[-1] != self.p.unknown:
                out.append(self.p.unknown)
            at += 1
        return np.array(out, "<i4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        front = " " if self.p.prefix else ""
        found = [WORDS.findall(front + t.replace(SPACE, " ")) if t else [] for t in texts]
        words = set(chain.from_iterable(found))
        new = words - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = words
        self.learn([*new])
        return [b"".join(map(self.known.__getitem__, f)) for f in found]


def added(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    """The schema of a frame with a column put last."""
    return T.StructType([f for f in df.schema if f.name != name] + [T.StructField(name, kind)])


def decoded(pieces: Pieces, raw: list[bytes]) -> pa.Array:
    """Texts of little-endian 32-bit ids."""
    get, texts = pieces.out.__getitem__, []
    for ids in raw:
        text = b"".join(map(get, np.frombuffer(ids, "<i4").tolist())).decode("utf-8", "replace")
        texts.append(text[1:] if pieces.prefix and text[:1] == " " else text)
    return pa.array(texts, pa.string())


def encode(df: DataFrame, model: str, text_col: str = "text", ids_col: str = "piece_ids", decoded_col: str | None = None) -> DataFrame:
    """The frame with the piece ids of each whole text, without begin and end.

    ``model`` is the path of a SentencePiece file, read by the driver only. With
    ``decoded_col`` the ids are decoded again in the same pass.
    """
    shared = df.sparkSession.sparkContext.broadcast(Pieces(model))
    new = [ids_col, decoded_col] if decoded_col else [ids_col]
    base = df.drop(*new)
    schema = added(base, ids_col, T.ArrayType(T.IntegerType()))
    if decoded_col:
        schema = schema.add(decoded_col, T.StringType())
    place = base.columns.index(text_col)

    def make():
        encoder = Encoder(shared.value)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(place).fill_null("")
            _, offsets = ragged.packed(texts)
            raw: list[bytes] = []
            for low, high in ragged.slices(offsets):
                raw += encoder.encode(texts.slice(low, high - low).to_pylist())
            ends = ragged.starts_of(np.fromiter(map(len, raw), np.int64, len(raw)) // 4)
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(raw), "<i4")))
            out = [ids, decoded(encoder.p, raw)] if decoded_col else [ids]
            return pa.RecordBatch.from_arrays([*batch.columns, *out], schema.names)

        return handle

    return ragged.map_batches(base, make, schema)


def decode(df: DataFrame, model: str, ids_col: str = "piece_ids", text_col: str = "decoded") -> DataFrame:
    """The frame with the text of each row's piece ids; null ids give the empty text."""
    shared = df.sparkSession.sparkContext.broadcast(Pieces(model))
    schema, base = added(df, text_col, T.StringType()), df.drop(text_col)
    place = base.columns.index(ids_col)

    def make():
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = (x.values for x in batch.column(place))
            raw = [b"" if ids is None else ids.to_numpy(zero_copy_only=False).astype("<i4").tobytes() for ids in rows]
            return pa.RecordBatch.from_arrays([*batch.columns, decoded(shared.value, raw)], schema.names)

        return handle

    return ragged.map_batches(base, make, schema)


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ids_col: str = "piece_ids", decoded_col: str = "decoded") -> DataFrame:
    """Ids and texts as counts, a hash of the comma-joined ids, and whether the text came back."""
    return df.select(
        id_col,
        F.size(ids_col).cast("long").alias("n_pieces"),
        F.sha2(F.concat_ws(",", F.col(ids_col).cast("array<string>")), 256).alias("ids_sha256"),
        (F.col(decoded_col) == F.coalesce(text_col, F.lit(""))).alias("round_trip"),
    )
