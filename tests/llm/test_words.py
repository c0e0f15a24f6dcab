import collections
import random
import re

import pyarrow as pa

from layerkit.llm import text_stats, words

from .small import WORD


def texts(seed, letters, most):
    rng = random.Random(seed)
    return [None if rng.random() < 0.1 else "".join(rng.choice(letters) for _ in range(rng.randint(0, most))) for _ in range(rng.randint(0, 8))]


def test_words_and_runs_match_plain_python(monkeypatch):
    for seed in range(120):
        monkeypatch.setattr(words, "SEGMENT_BYTES", (3, 7, 1 << 20)[seed % 3])
        ts = texts(seed, "ab é\n\t  Zß漢x\x0b", 12)
        w = words.split_words(pa.array(ts, pa.string()))
        hashes = words.word_hashes(w)
        want = [WORD.findall(t or "") for t in ts]
        assert want == [[bytes(w.data[w.start[k]:w.end[k]]).decode() for k in range(w.first[d], w.first[d + 1])] for d in range(len(ts))]
        for size in (1, 2, 4):
            runs, first = words.windows(w, hashes, size, short=True)
            named = {}
            for d, e in enumerate(want):
                r = [tuple(e[i:i + size]) for i in range(len(e) - size + 1)] or ([tuple(e)] if e else [])
                assert len(r) == first[d + 1] - first[d]
                for x, y in zip(r, runs[first[d]:first[d + 1]]):
                    assert named.setdefault(x, y) == y
            assert len(set(named.values())) == len(named)


def test_slices_hold_whole_texts_once():
    b = pa.record_batch([pa.array(["x" * n for n in (0, 5, 3_000_000, 10, 900_000, 900_000)])], names=["t"])
    cut = list(words.slices([b], "t"))
    assert pa.Table.from_batches(cut) == pa.Table.from_batches([b])
    assert max(c.num_rows for c in cut) < 6


def plain_counts(x):
    x = x or ""
    w = WORD.findall(x)
    lines = [one for one in x.split("\n") if WORD.search(one)]
    seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    return [len(w), sum(map(len, w)), sum(x.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(lines), len(set(w)),
            sum(a == b for a, b in zip(w, w[1:])), len(re.findall("[A-Z]", x)), len(re.findall("[0-9]", x)), x.count("!") + x.count("?")]


def test_counts_match_plain_python():
    for seed in range(200):
        ts = texts(seed, "ab é\n\n |!A1", 60)
        got = text_stats.text_counts(pa.array(ts, pa.string()))
        assert [[int(got[c][i]) for c in text_stats.COUNTS] for i in range(len(ts))] == [plain_counts(t) for t in ts]
