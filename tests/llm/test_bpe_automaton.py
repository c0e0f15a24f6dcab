import hashlib
import random
import struct

import pytest

from layerkit.llm import bpe_automaton as ba

from .small import LONG, ODD_ROWS, SF001, empty, odd

Tokenizer = pytest.importorskip("tokenizers").Tokenizer


@pytest.fixture(scope="module")
def coder():
    return ba.Coder(ba.load_automaton(ba.tokenizer_path()))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(ba.tokenizer_path())


def same(coder, library, text):
    ids = coder.encode(text)
    want = library.encode(text, add_special_tokens=False).ids
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want, text[:80]
    assert coder.decode(ids).decode() == library.decode(want, skip_special_tokens=False)


def test_like_the_library_on_characters(coder, library):
    for cp in range(0, 0x110000):
        if not 0xD800 <= cp < 0xE000 and (cp < 0x800 or cp % 97 == 0):
            same(coder, library, f"a{chr(cp)} {chr(cp)}{chr(cp)}b\n{chr(cp)} ")


def test_like_the_library_on_random_and_long_texts(coder, library):
    rng = random.Random(3)
    bits = list("aaabeinorst  '\n\t.,!012") + ["é", "ß", "漢", "😀", "<|endoftext|>", "<|", " ", " ", "'re", "\x1c", "\x85"]
    for _ in range(3000):
        same(coder, library, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40))))
    for text in (LONG, "a" * 3000, "ab" * 2000, " " * 2000, "é" * 500):
        same(coder, library, text)


def test_one_word_of_any_length(coder, library):
    rng = random.Random(8)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "ab", "é漢a"):
        same(coder, library, "".join(rng.choice(letters) for _ in range(400_000)))


def test_arcs_are_those_of_correct_tokenisations(library):
    """Two tokens have an arc exactly if their bytes are encoded to just them."""
    small = ba.BpeAutomaton({bytes([b]): b for b in range(97, 100)} | {b"aa": 200, b"ab": 201, b"aab": 202, b"bc": 203, b"aabc": 204}, [
        (b"a", b"a"), (b"a", b"b"), (b"aa", b"b"), (b"b", b"c"), (b"aa", b"bc")], {})
    merges = [(b"a", b"a"), (b"a", b"b"), (b"aa", b"b"), (b"b", b"c"), (b"aa", b"bc")]

    def plain(word):
        out = [bytes([b]) for b in word]
        for a, b in merges:
            k = 0
            while k < len(out) - 1:
                if out[k] == a and out[k + 1] == b:
                    out[k:k + 2] = [a + b]
                k += 1
        return out

    labels = {i: small.labels[i] for i in small.reached}
    for x, a in labels.items():
        for y, b in labels.items():
            if plain(a) == [a] and plain(b) == [b]:
                assert small.arc(x, y) == (plain(a + b) == [a, b]), (a, b)
    coder = ba.Coder(small)
    rng = random.Random(1)
    for _ in range(500):
        word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12)))
        assert [small.labels[i] for i in coder.encode_word(word)] == plain(word)


def test_query(spark, library):
    got = {r["doc_id"]: r for r in ba.op7_bpe_automaton(spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows_round_trip(spark):
    encoded = ba.encode(odd(spark), ba.tokenizer_path(), ["doc_id", "row"])
    got = ba.decode(encoded, ba.tokenizer_path(), ["doc_id"]).collect()
    key = lambda r: (str(r[0]), r[1])
    assert sorted(map(key, got)) == sorted((str(r[0]), r[1] or "") for r in ODD_ROWS)
    assert ba.encode(empty(spark), ba.tokenizer_path(), ["doc_id"]).count() == 0
    null_ids = spark.createDataFrame([(1, None)], "doc_id long, token_ids binary")
    assert ba.decode(null_ids, ba.tokenizer_path(), ["doc_id"]).collect()[0]["text"] == ""


def test_words_kept_are_bounded_and_frequent_ones_stay(coder, library, monkeypatch):
    monkeypatch.setattr(ba, "WORDS_KEPT", 20)
    asked = []
    mine = ba.Coder(coder.automaton)
    plain = mine.words.encode
    mine.words.encode = lambda w: asked.append(w) or plain(w)
    for k in range(200):
        same(mine, library, f" often w{k} x{k}")
        assert len(mine.words) + len(mine.words.older) <= 20
    assert asked.count(b" often") == 1
