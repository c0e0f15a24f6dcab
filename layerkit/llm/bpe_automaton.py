"""Byte-level BPE as an automaton over tokens: encoding and decoding.

The merges are compiled, one gadget after the other, into a deterministic
automaton whose states are "the last token was x" and whose arcs say which token
may come next in a correct tokenisation of a word:

* at first there are the 256 byte tokens and every arc between them;
* the gadget of a merge (a, b -> c) removes the arc a -> b; c may come wherever a
  may come, and what may come after c is what may come after b.

So an arc between two tokens is settled by the arcs between their parts at the
time the newer one was made, and ``BpeAutomaton.arc`` follows the gadgets back
to bytes. Arcs are filled in when first asked for and kept in a table; the full
table of 50,000 x 50,000 is never written out. A merge whose arc is already gone
when its gadget comes makes a token that no text reaches.

Encoding a word follows arcs from token to token, longest first, by a byte trie;
as exactly one path of arcs spells a word, and each prefix of it has exactly one
last token, a position that leads nowhere is never tried twice. Decoding emits
the byte labels of the arcs.

Defined results: null and empty texts have no tokens and decode to the empty
text; the strings of added tokens inside a text become those tokens, as the
library does; very long texts are encoded whole, in time proportional to their
length even if they are one word; repeated rows and repeated ids give one result
each; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerkit.llm.tables import read_table, ship
from layerkit.llm.words import slices

#: Fixed value: the public pre-splitting pattern of this kind of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What a worker keeps of its work, some 100 to 200 bytes each.
WORDS_KEPT = 400_000
ARCS_KEPT = 400_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files of this kind:
    printable Latin-1 stands for itself, the rest for code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + k): b for k, b in enumerate(rest)}


class BpeAutomaton:
    """Compiled merges: token labels and gadgets."""

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]], added: dict[str, int]):
        size = max([*vocab.values(), *added.values()]) + 1
        self.labels: list[bytes] = [b""] * size
        for label, i in vocab.items():
            self.labels[i] = label
        for text, i in added.items():
            self.labels[i] = text.encode()
        self.added = added
        self.first = [0] * size
        self.second = [0] * size
        self.made = [-1] * size
        self.rank: dict[int, int] = {}
        self.shift = size.bit_length()
        reached = {i for label, i in vocab.items() if len(label) == 1}
        for r, (a, b) in enumerate(merges):
            x, y, c = vocab[a], vocab[b], vocab[a + b]
            if x in reached and y in reached and self.arc(x, y):
                if c in reached:
                    raise ValueError(f"token {c} is made by two merges")
                self.first[c], self.second[c], self.made[c] = x, y, r
                self.rank[x << self.shift | y] = r
                reached.add(c)
        self.reached = reached

    def arc(self, x: int, y: int) -> bool:
        """May token ``y`` follow token ``x`` inside a word?"""
        rank, made, shift = self.rank, self.made, self.shift
        until = 1 << 62  # after all merges
        while True:
            r = rank.get(x << shift | y)
            if r is not None and r < until:
                return False
            if made[x] > made[y]:
                until = made[x]
                x = self.second[x]
            elif made[y] >= 0:
                until = made[y] + 1
                y = self.first[y]
            else:
                return True


def load_automaton(path: str) -> BpeAutomaton:
    """Compile a tokenizer file (JSON, byte-level BPE without a normaliser)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]:
        raise ValueError(f"{path}: only byte-level BPE without normaliser and prefix space is supported")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError(f"{path}: added tokens that take in their surroundings aren't supported")
    letters = byte_letters()
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}

    def raw(token: str) -> bytes:
        return bytes(letters[ch] for ch in token)

    vocab = {raw(t): i for t, i in model["vocab"].items() if t not in added}
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    return BpeAutomaton(vocab, [(raw(a), raw(b)) for a, b in pairs], added)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Kept(dict):
    """Encoded words by text: at most ``WORDS_KEPT``, half of them as ``older``,
    which go when the newer half is full, but for those met again meanwhile."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = _packed(self.encode(word.encode("utf-8", "surrogatepass")))
        if len(self) >= WORDS_KEPT // 2:
            self.older = dict(self)
            self.clear()
        if len(word) <= 64:
            self[word] = ids
        return ids


class Coder:
    """Encodes and decodes texts; ids are little-endian unsigned 32-bit numbers."""

    def __init__(self, automaton: BpeAutomaton, split: str = SPLIT):
        self.automaton = automaton
        self.split = regex.compile(split)
        marks = sorted(automaton.added, key=lambda t: (-len(t), t))
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.arcs: dict[int, bool] = {}
        self.words = _Kept(self.encode_word)
        labels = automaton.labels
        self.width = [len(label) for label in labels]
        #: Byte trie: each node is (children by byte, token that ends here or -1).
        self.trie: tuple[dict, int] = ({}, -1)
        #: The longest token that a token begins with, other than itself; -1: none.
        self.shorter = [-1] * len(labels)
        for i in sorted(automaton.reached, key=lambda i: (self.width[i], i)):  # shorter labels first
            node = self.trie
            for byte in labels[i][:-1]:
                node = node[0].setdefault(byte, ({}, -1))
                if node[1] >= 0:
                    self.shorter[i] = node[1]
            children = node[0].get(labels[i][-1], ({}, -1))[0]
            node[0][labels[i][-1]] = (children, i)

    def arc(self, x: int, y: int) -> bool:
        key = x << self.automaton.shift | y
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= ARCS_KEPT:
                self.arcs.clear()
            known = self.arcs[key] = self.automaton.arc(x, y)
        return known

    def encode_word(self, word: bytes) -> list[int]:
        """The only path of arcs that spells ``word``. Longer tokens are tried
        first; a position from which no arc leads on is given up for good, as
        there is but one way to reach it."""
        arcs, shift, shorter, width, begin = self.arcs, self.automaton.shift, self.shorter, self.width, self.trie[0]
        n, at, path, dead, before = len(word), 0, [], set(), -1
        view = memoryview(word)
        while at < n:
            children, token = begin, -1
            for byte in view[at:]:
                node = children.get(byte)
                if node is None:
                    break
                children, here = node
                if here >= 0:
                    token = here
            while True:
                while token >= 0:
                    if not dead or at + width[token] not in dead:
                        if before < 0:
                            break
                        known = arcs.get(before << shift | token)
                        if known or known is None and self.arc(before, token):
                            break
                    token = shorter[token]
                if token >= 0:
                    break
                dead.add(at)
                token = path.pop()
                before = path[-1] if path else -1
                at -= width[token]
                token = shorter[token]
            path.append(token)
            before = token
            at += width[token]
        return path

    def encode(self, text: str) -> bytes:
        if not self.marks or not self.marks.search(text):
            return b"".join(map(self.words.__getitem__, self.split.findall(text)))
        out = []
        for k, piece in enumerate(self.marks.split(text)):
            if k % 2:
                out.append(self.automaton.added[piece].to_bytes(4, "little"))
            else:
                out.extend(map(self.words.__getitem__, self.split.findall(piece)))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the text; bytes that aren't UTF-8 become U+FFFD."""
        raw = b"".join(map(self.automaton.labels.__getitem__, memoryview(ids).cast("I")))
        try:
            raw.decode()
        except UnicodeDecodeError:
            raw = raw.decode(errors="replace").encode()
        return raw


_KEPT: list = [None, None, None]


def _coder(shared, split: str) -> Coder:
    """This worker's coder for a broadcast automaton."""
    if _KEPT[0] is not shared or _KEPT[1] != split:
        _KEPT[:] = shared, split, Coder(shared.value, split)
    return _KEPT[2]


def _share(spark: SparkSession, path: str):
    """Broadcast the compiled file: its size is that of a vocabulary, whatever the corpus."""
    ship(spark)
    return spark.sparkContext.broadcast(load_automaton(path))


def _keep(df: DataFrame, keep: list[str], extra: str, value: str) -> tuple[DataFrame, StructType]:
    rows = df.select(*keep, F.col(value).alias("_value"))
    return rows, StructType([*rows.schema.fields[:-1], *StructType.fromDDL(extra).fields])


def encode(docs: DataFrame, path: str, keep: list[str], text: str = "text", split: str = SPLIT) -> DataFrame:
    """``keep`` columns, ``n_tokens``, ``token_ids`` (little-endian unsigned
    32-bit), ``ids_sha256`` and ``decoded_sha256`` (digest of the UTF-8 text that
    the ids decode to), in one narrow pass over whole texts."""
    shared = _share(docs.sparkSession, path)
    rows, kinds = _keep(docs, keep, "n_tokens bigint, token_ids binary, ids_sha256 string, decoded_sha256 string", text)
    rows = rows.withColumn("_value", F.col("_value").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, split)
        for b in slices(batches, "_value"):
            ids = [coder.encode(t or "") for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                *b.columns[:-1],
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array(ids, pa.binary()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(coder.decode(x)).hexdigest() for x in ids], pa.string()),
            ], names=[*b.schema.names[:-1], "n_tokens", "token_ids", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, kinds)


def decode(encoded: DataFrame, path: str, keep: list[str], ids: str = "token_ids") -> DataFrame:
    """``keep`` columns and ``text``, decoded from the ids (null: no tokens)."""
    shared = _share(encoded.sparkSession, path)
    rows, kinds = _keep(encoded, keep, "text string", ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared, SPLIT)
        for b in slices(batches, "_value"):
            texts = [coder.decode(x or b"").decode() for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())],
                                             names=[*b.schema.names[:-1], "text"])

    return rows.mapInArrow(run, kinds)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_bpe_automaton(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    out = encode(read_table(spark, sf_dir, "documents"), path or tokenizer_path(), ["doc_id"])
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
