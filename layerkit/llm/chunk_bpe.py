"""Byte-level BPE by overlapping chunks: encoding and decoding.

A text is cut into chunks of ``CHUNK`` characters, each of which also holds the
first ``OVERLAP`` characters of the next one. Chunks are pre-tokenised apart from
each other, as rows of their own. Where a chunk begins in the middle of a
pre-token its first boundaries are wrong, but a boundary that two neighbours
share puts them in step for good: a match depends on nothing before it, and on at
most ``AHEAD`` characters behind it. Stitching walks over a text's chunks, takes
each one's boundaries from the first shared one on, and where an overlap holds
none (a pre-token longer than the overlap) goes on matching by itself until it
meets a boundary of a later chunk. The stitched pieces are dealt out again and
encoded by the ranks of a vocabulary; a text's ids are then put together.
A text of one chunk has nothing to stitch and needs no shuffle.

A piece that is no token is merged from its bytes, always the neighbours whose
union has the lowest rank, the leftmost first; a heap keeps that near-linear in
the length of the piece. Decoding concatenates the raw bytes of the tokens.

Defined results: null and empty texts have no tokens and decode to no bytes;
a very long text is worked on in chunks, and only its ids, as the result asks,
meet in one row; a pre-token of any length is one piece and one task's work, in
n log n time; repeated rows and repeated ids give one result each; an empty table
gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerkit.llm.tables import read_table, ship
from layerkit.llm.words import slices

CHUNK = 1 << 16
OVERLAP = 1 << 9
#: Characters behind a match that can have a say in it: a contraction has three.
AHEAD = 4
PIECES_KEPT = 400_000
SHORT_PIECE = 24
ENCODED = "n_tokens bigint, token_ids binary, ids_sha256 string, decoded_sha256 string"


def load_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks; each line has a token in base64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merges by looking at all neighbours each time."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges from a heap of (rank, place), over linked parts."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins here; 0: no part begins here
    before = list(range(-1, n - 1))
    pair = [-1] * n  # rank of the part that begins here with the next one
    heap = []
    for i in range(n - 1):
        r = ranks.get(piece[i:i + 2])
        if r is not None:
            pair[i] = r
            heap.append((r, i))
    heapq.heapify(heap)

    def look(i: int) -> None:
        j = end[i]
        r = ranks.get(piece[i:end[j]]) if j < n else None
        pair[i] = -1 if r is None else r
        if r is not None:
            heapq.heappush(heap, (r, i))

    while heap:
        r, i = heapq.heappop(heap)
        if not end[i] or pair[i] != r:
            continue
        j = end[i]
        end[i], end[j] = end[j], 0
        if end[i] < n:
            before[end[i]] = i
        look(i)
        if before[i] >= 0:
            look(before[i])
    return [ranks[piece[i:e]] for i, e in enumerate(end) if e]


class _Kept(dict):
    """Packed ids of pieces by text; starts anew when full."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8")
        whole = self.ranks.get(raw)
        if whole is not None:
            ids = [whole]
        else:
            ids = (merge_short if len(raw) <= SHORT_PIECE else merge_long)(raw, self.ranks)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self) >= PIECES_KEPT:
                self.clear()
            self[piece] = packed
        return packed


class RankCoder:
    """Encodes pieces by ranks and decodes ids, packed as little-endian unsigned 32-bit numbers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pieces = _Kept(ranks)
        self.match = regex.compile(pattern)
        self.tokens = {r: t for t, r in ranks.items()}

    def encode_pieces(self, text: str, ends: np.ndarray) -> bytes:
        begins = [0, *ends[:-1].tolist()]
        return b"".join([self.pieces[text[a:z]] for a, z in zip(begins, ends.tolist())])

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.match.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


def cut(text: str, chunk: int, overlap: int) -> list[str]:
    """Chunks; each but the last goes ``overlap`` characters into the next."""
    return [text[at:at + chunk + overlap] for at in range(0, max(len(text), 1), chunk)]


def boundaries(match: regex.Pattern, chunk: str, last: bool) -> np.ndarray:
    """Ends of the matches in a chunk, without those that what follows the
    chunk could still change."""
    ends = np.fromiter((m.end() for m in match.finditer(chunk)), dtype=np.int64)
    if not last:
        ends = ends[: int(np.searchsorted(ends, len(chunk) - AHEAD, side="right"))]
    return ends


def stitch(match: regex.Pattern, texts: list[str], ends: list[np.ndarray], chunk: int) -> np.ndarray:
    """Ends of a text's pre-tokens, from its chunks and each one's boundaries
    (counted from the chunk's beginning)."""
    n = len(texts)
    total = (n - 1) * chunk + len(texts[-1])
    known = [e + k * chunk for k, e in enumerate(ends)]
    out, own, at = [], [], 0

    def one() -> int:
        """The end of the match at ``at``, over as many chunks as it takes."""
        k = at // chunk
        more = 1
        while True:
            last = min(k + more, n)
            text = "".join([*(t[:chunk] for t in texts[k:last - 1]), texts[last - 1]])
            m = match.match(text, at - k * chunk)
            if not m or m.end() == m.start():
                raise ValueError("the pattern leaves characters out")
            if last == n or m.end() <= len(text) - AHEAD:
                return k * chunk + m.end()
            more *= 2

    while at < total:
        k = min(at // chunk, n - 1)
        here = known[k]
        i = int(np.searchsorted(here, at, side="right"))
        if i < len(here) and (at == k * chunk or i and here[i - 1] == at):
            take = here[i:]
            if k + 1 < n:  # up to the first boundary that the next chunk shares
                seam = take[take >= (k + 1) * chunk]
                shared = seam[(seam == (k + 1) * chunk) | np.isin(seam, known[k + 1], assume_unique=True)]
                if len(shared):
                    take = take[take <= shared[0]]
            if own:
                out.append(np.array(own))
                own = []
            out.append(take)
            at = int(take[-1])
        else:
            at = one()
            own.append(at)
    return np.concatenate([*out, np.array(own, dtype=np.int64)])


_KEPT: list = [None, None, None]


def _coder(shared, pattern: str) -> RankCoder:
    """This worker's coder for broadcast ranks."""
    if _KEPT[0] is not shared or _KEPT[1] != pattern:
        _KEPT[:] = shared, pattern, RankCoder(shared.value, pattern)
    return _KEPT[2]


def _digests(kept: pa.Array, ids: list[bytes], coder: RankCoder) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        kept,
        pa.array([len(x) // 4 for x in ids], pa.int64()),
        pa.array(ids, pa.binary()),
        pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
        pa.array([hashlib.sha256(coder.decode(x)).hexdigest() for x in ids], pa.string()),
    ], names=["kept", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256"])


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str], text: str = "text", chunk: int = CHUNK,
           overlap: int = OVERLAP) -> DataFrame:
    """``keep`` columns, ``n_tokens``, ``token_ids`` (little-endian unsigned
    32-bit), ``ids_sha256`` and ``decoded_sha256`` (digest of the bytes that the
    ids decode to) of whole texts."""
    if not AHEAD < overlap <= chunk:
        raise ValueError(f"an overlap of {overlap} characters doesn't suit chunks of {chunk}")
    spark = docs.sparkSession
    ship(spark)
    # Its size is that of a vocabulary, whatever the corpus.
    shared = spark.sparkContext.broadcast(load_ranks(path))
    rows = docs.select(F.struct(*keep).alias("kept"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kept = StructType([rows.schema["kept"]])
    result = StructType([*kept, *StructType.fromDDL(ENCODED)])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, pattern)
        for b in slices(batches, "text"):
            yield _digests(b.column(0), [coder.encode(t) for t in b.column(1).to_pylist()], coder)

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            for r, t in enumerate(b.column(1).to_pylist()):
                parts = cut(t, chunk, overlap)
                same = pa.array([r] * len(parts))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(same), b.column(2).take(same), pa.array(range(len(parts)), pa.int32()),
                     pa.array([k + 1 == len(parts) for k in range(len(parts))]), pa.array(parts, pa.string())],
                    names=["kept", "row", "k", "last", "text"])

    def pre_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, pattern)
        for b in slices(batches, "text"):
            found = [boundaries(coder.match, t, z).tobytes() for t, z in zip(b.column("text").to_pylist(), b.column("last").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.binary())], names=[*b.schema.names, "ends"])

    def stretches(group: pa.Table) -> pa.Table:
        t = group.combine_chunks().sort_by("k")
        texts = t.column("text").to_pylist()
        ends = stitch(_coder(shared, pattern).match, texts, [np.frombuffer(e, dtype=np.int64) for e in t.column("ends").to_pylist()], chunk)
        text = "".join([*(x[:chunk] for x in texts[:-1]), texts[-1]])
        out, i = [], 0
        while i < len(ends):  # at least one piece, then as many as a chunk takes
            begin = int(ends[i - 1]) if i else 0
            j = max(i + 1, int(np.searchsorted(ends, begin + chunk, side="right")))
            out.append((text[begin:int(ends[j - 1])], (ends[i:j] - begin).tobytes()))
            i = j
        same = pa.array([0] * len(out))
        return pa.table([t.column("kept").take(same), t.column("row").take(same), pa.array(range(len(out)), pa.int32()),
                         pa.array([x for x, _ in out], pa.string()), pa.array([e for _, e in out], pa.binary())],
                        names=["kept", "row", "k", "text", "ends"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, pattern)
        for b in slices(batches, "text"):
            ids = [coder.encode_pieces(t, np.frombuffer(e, dtype=np.int64)) for t, e in zip(b.column("text").to_pylist(), b.column("ends").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("kept"), b.column("row"), b.column("k"), pa.array(ids, pa.binary())], names=["kept", "row", "k", "ids"])

    def together(group: pa.Table) -> pa.Table:
        t = group.combine_chunks().sort_by("k")
        return pa.Table.from_batches([_digests(t.column("kept").combine_chunks().slice(0, 1), [b"".join(t.column("ids").to_pylist())], _coder(shared, pattern))])

    short = F.length("text") <= chunk
    by_chunk = StructType([*kept, *StructType.fromDDL("row bigint, k int, last boolean, text string")])
    by_stretch = StructType([*kept, *StructType.fromDDL("row bigint, k int, text string, ends binary")])
    chunks = rows.where(~short).withColumn("row", F.monotonically_increasing_id()).mapInArrow(cuts, by_chunk).repartition("row", "k")
    bounded = chunks.mapInArrow(pre_tokens, StructType([*by_chunk, *StructType.fromDDL("ends binary")]))
    stitched = bounded.groupBy("row").applyInArrow(stretches, by_stretch).repartition("row", "k")
    coded = stitched.mapInArrow(pieces, StructType([*kept, *StructType.fromDDL("row bigint, k int, ids binary")]))
    long = coded.groupBy("row").applyInArrow(together, result)
    return rows.where(short).mapInArrow(whole, result).unionByName(long).select("kept.*", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256")


def decode(encoded: DataFrame, path: str, pattern: str, keep: list[str], ids: str = "token_ids") -> DataFrame:
    """``keep`` columns and ``bytes``, the raw bytes of the ids (null: none)."""
    spark = encoded.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(load_ranks(path))
    rows = encoded.select(F.struct(*keep).alias("kept"), F.col(ids).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([coder.decode(x or b"") for x in b.column(1).to_pylist()], pa.binary())],
                                             names=["kept", "bytes"])

    return rows.mapInArrow(run, StructType([rows.schema["kept"], *StructType.fromDDL("bytes binary")])).select("kept.*", "bytes")


def op13_chunk_bpe(spark: SparkSession, sf_dir: str, path: str | None = None, pattern: str | None = None) -> DataFrame:
    import public_tokenizers

    out = encode(read_table(spark, sf_dir, "documents"), path or public_tokenizers.path("byte_bpe_50k.tiktoken"),
                 pattern or public_tokenizers.PATTERN, ["doc_id"])
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
