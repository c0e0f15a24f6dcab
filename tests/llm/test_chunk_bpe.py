import base64
import hashlib
import random
import struct

import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from layerkit.llm import chunk_bpe as cb

from .small import LONG, ODD_ROWS, SF01, empty, odd

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return cb.RankCoder(cb.load_ranks(PATH), PATTERN)


def digest(ids):
    return hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def random_text(rng, size):
    parts = [" ", "  ", "\n", "\t ", "'s", "'", "'re", "''ll", "a", "Word", "é", "漢字", "😀", "12", "!?", "<|endoftext|>", " ", "　", "\x1c", "́"]
    return "".join(rng.choice(parts) * rng.choice([1, 1, 1, 2, 9]) for _ in range(size))


def test_whole_table_equals_the_library(spark, library):
    got = {r["doc_id"]: r for r in cb.op13_chunk_bpe(spark, SF01).collect()}
    rows = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        text = r["text"] or ""
        ids = library.encode_ordinary(text)
        assert got[r["doc_id"]][1:] == (len(ids), digest(ids), hashlib.sha256(text.encode()).hexdigest())


def test_every_code_point(library, coder):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 4096):
        for text in ("".join(points[i:i + 4096]), " a".join(points[i:i + 4096])):
            ids = library.encode_ordinary(text)
            if coder.encode(text) != struct.pack(f"<{len(ids)}I", *ids):
                odd_ones = [hex(ord(c)) for c in points[i:i + 4096] if coder.encode(f"a{c}b {c}") != struct.pack(f"<{len(x := library.encode_ordinary(f'a{c}b {c}'))}I", *x)]
                assert not odd_ones, odd_ones


def test_both_mergers(library, coder):
    rng = random.Random(7)
    for size in (1, 2, 5, 24, 25, 200, 3000):
        for letters in ("ab", "abcdefgh", "aé漢", "etaoin", "=-"):
            piece = "".join(rng.choice(letters) for _ in range(size)).encode()
            ids = cb.merge_long(piece, coder.pieces.ranks)
            assert b"".join(map(coder.tokens.get, ids)) == piece
            if size <= 200:
                assert ids == cb.merge_short(piece, coder.pieces.ranks)
            text = piece.decode()
            assert struct.pack(f"<{len(x := library.encode_ordinary(text))}I", *x) == coder.encode(text)


def test_a_run_of_letters_takes_no_square_of_its_length(library, coder):
    text = "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz", k=400_000))
    ids = library.encode_ordinary(text)
    assert coder.encode(text) == struct.pack(f"<{len(ids)}I", *ids)


@pytest.mark.parametrize("pattern", [PATTERN, r"\s+|[^\s]{1,3}", r"\p{L}+\s*|(?s:.)"])
def test_stitched_boundaries_are_those_of_the_whole_text(pattern):
    match, rng = regex.compile(pattern), random.Random(3)
    for trial in range(600):
        text = random_text(rng, rng.choice([1, 5, 40, 200]))
        chunk = rng.choice([8, 9, 16, 33])
        texts = cb.cut(text, chunk, rng.choice([5, 6, 8]))
        ends = [cb.boundaries(match, t, k + 1 == len(texts)) for k, t in enumerate(texts)]
        assert cb.stitch(match, texts, ends, chunk).tolist() == [m.end() for m in match.finditer(text)], (trial, text)


def test_long_texts_in_small_chunks(spark, library):
    rng = random.Random(5)
    rows = list(enumerate([random_text(rng, 300) for _ in range(20)] + ["x" * 5000, " " * 3000, "\n" * 2000 + "a", "", None, LONG, "it's " * 500]))
    df = spark.createDataFrame(rows * 2, "doc_id long, text string")
    out = cb.encode(df, PATH, PATTERN, ["doc_id"], chunk=64, overlap=8)
    back = {r["doc_id"]: r["bytes"].decode() for r in cb.decode(out, PATH, PATTERN, ["doc_id"]).collect()}
    got = out.select("doc_id", "n_tokens", "ids_sha256").collect()
    assert len(got) == 2 * len(rows)
    for i, n, ids in got:
        text = dict(rows)[i] or ""
        assert (n, ids) == (len(x := library.encode_ordinary(text)), digest(x)) and back[i] == text


def test_odd_rows(spark, library):
    got = cb.encode(odd(spark).withColumn("k", F.lit("clash")), PATH, PATTERN, ["doc_id", "row", "kept", "k"], chunk=4096, overlap=64).collect()
    want = sorted((str(i), len(library.encode_ordinary(t or "")), "clash") for i, t, *_ in ODD_ROWS)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["kept"]) for r in got) == want
    assert cb.encode(empty(spark), PATH, PATTERN, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        cb.encode(empty(spark), PATH, PATTERN, ["doc_id"], chunk=10, overlap=11)
