import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cartspark.llm.periodic_runs import Catchers, find_runs
from cartspark.llm.queries import op11_periodic_runs

FOLDER = "/root/testdata/sf0.001"


def plain_runs(words, least=12):
    """[(start, length, period)], by comparing the words at every distance."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        x, n = 0, len(words) - q
        while x < n:
            first = x
            while x < n and words[x] == words[x + q]:
                x += 1
            if x - first + q >= max(least, 2 * q):
                found.setdefault((first, x - first + q), q)
            x += 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {x for s, n, q in runs for x in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sequences(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        n, letters = rng.randint(0, 120), rng.choice([1, 2, 2, 3])
        words = []
        while len(words) < n:
            unit = [rng.randrange(letters + 1) for _ in range(rng.randint(1, 20))]
            words += unit * rng.randint(1, 5) + unit[: rng.randint(0, len(unit))]
        yield rng, words[:n]


@pytest.mark.parametrize("least", [2, 4, 5, 12, 30])
def test_runs_of_words_appended_in_any_pieces(least):
    for rng, words in sequences(least, 40):
        want = plain_runs(words, least)
        for piece in (lambda: len(words) + 1, lambda: 1, lambda: rng.randint(1, 30)):  # noqa: B023
            catchers, at = Catchers(least), 0
            while at < len(words):
                size = piece()
                catchers.append(np.array(words[at : at + size], np.int64))
                at += size
            assert list(zip(*(x.tolist() for x in catchers.runs()), strict=True)) == want


def test_long_periodic_words_cost_little():
    catchers = Catchers()
    catchers.append(np.concatenate((np.zeros(300_000, np.int64), np.arange(300_000) % 977)))
    assert [tuple(map(int, r)) for r in zip(*catchers.runs(), strict=True)] == [(0, 300_001, 1), (300_000, 300_000, 977)]


def test_open_stretches_are_few_and_levels_are_cut():
    catchers = Catchers()
    for _ in range(40):
        catchers.append(np.arange(64) % 7)
        assert len(catchers.period) - len(catchers.runs()[0]) < 60
    assert all(len(hashes) <= 5 * (1 << level) for level, (_, hashes) in enumerate(catchers.levels))


def test_texts(spark):
    line = "one two three four "
    texts = [
        None, "", " \t\n\x0b\x0c\r ", line * 3, line * 2 + "one", "a " * 12, "a " * 11, "x" * 300_000,
        "é é " * 15, "a\u0085b " * 14, "no space" + "\x1f" * 3, (line * 40) + "tail " + (line * 40), "z" + " z" * 70_000,
    ]
    rows = [(i, t, "mine", 7) for i, t in enumerate(texts)] + [(3, line * 3, "mine", 7), (None, line * 3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, extra int")
    got = find_runs(df).collect()
    assert len(got) == len(rows) and {r.extra for r in got} == {7, None}
    for row in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        want = plain_runs(words) if len(words) < 1000 else [(0, len(words), 1)]
        assert [tuple(r) for r in row.runs] == want and row.n_words == len(words)
        assert row.collapsed == collapsed(words, want)
    assert find_runs(df.limit(0)).count() == 0


def test_query_equals_plain_version(spark):
    want = {}
    for doc_id, text in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect():
        words, h = re.findall(r"[^\x20\x09-\x0D]+", text or ""), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        if len(words) > 1_500:
            continue
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        digests = ("".join(f"{s},{n},{q}\n" for s, n, q in runs), collapsed(words, runs))
        want[doc_id] = (len(runs), *longest, *(hashlib.sha256(d.encode()).hexdigest() for d in digests))
    got = {r.doc_id: tuple(r)[1:] for r in op11_periodic_runs(spark, FOLDER).collect()}
    assert want and {i: got[i] for i in want} == want
