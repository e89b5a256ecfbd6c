"""Importance resampling and collocations against plain versions; both also have SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from skytally.llm import collocations as cl
from skytally.llm.resampling import crc32_of, resample
from tests.llm.test_operators import FOLD, SCHEMA, fixture_rows


def test_crc_matrices_equal_the_library():
    r = random.Random(1)
    values = [b"", b"a"] + [r.randbytes(r.randrange(40)) for _ in range(500)]
    assert crc32_of(pa.array(values, pa.binary())).tolist() == [zlib.crc32(v) for v in values]
    assert crc32_of(pa.array(values, pa.binary())[7:90]).tolist() == [zlib.crc32(v) for v in values[7:90]]
    assert len(crc32_of(pa.array([], pa.binary()))) == 0


def features(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def test_resampling(spark):
    rows = fixture_rows()
    bench = [(1, rows[7][1]), (2, None), (3, "Two words, é!")]
    bucket = lambda w: zlib.crc32(w.encode()) % 10000
    s, t = (Counter(bucket(w) for x in found for w in features(x[1])) for found in (rows, bench))
    s_all, t_all = sum(s.values()) + 10000.0, sum(t.values()) + 10000.0
    expected = []
    for d, text, *_ in rows:
        w = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * s_all / ((s[b] + 1.0) * t_all))) for b in map(bucket, w))
        h = int(hashlib.sha256(f"2024:{'null' if d is None else d}".encode()).hexdigest()[:8], 16)
        expected.append((d, len(w), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((x for x in expected if x[1] >= 20), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    ranks = {x: i for i, x in reversed(list(enumerate(able[: 10 * len(able) // 100], 1)))}
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    target = spark.createDataFrame(bench, "item_id long, text string")
    found = [tuple(x) for x in resample(table, target).collect()]
    assert Counter(x[:4] for x in found) == Counter(expected)
    assert sorted(x[4] for x in found if x[4]) == list(range(1, 10 * len(able) // 100 + 1))
    assert all(able[x[4] - 1] == x[:4] for x in found if x[4]) and ranks
    assert resample(table.limit(0), target).count() == 0
    assert resample(table, target.limit(0)).where("rank IS NOT NULL").count() == len(ranks)


def plain_collocations(rows, min_count):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(FOLD)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    key = lang, tuple(w[i : i + m])
                    f[key] = f.get(key, 0) + 1
    f = {k: a for k, a in f.items() if a >= min_count}
    scored = []
    for (lang, w), a in f.items():
        if len(w) < 2:
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        inside = lambda x: len(x) > len(w) and any(x[i : i + len(w)] == w for i in range(len(x)))
        if not any(lg == lang and inside(x) and 100 * b >= 80 * a for (lg, x), b in f.items()):
            scored.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    out, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(scored):
        rank[lang] += 1
        out.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_collocations(spark, monkeypatch, small):
    if small:  # bursts, spills, new word ids and chunks all happen
        for name, value in (("BURST", 5), ("SPILL", 40), ("_CHUNK_WORDS", 50), ("_CHUNK_BYTES", 300), ("_SLICE_BYTES", 9000)):
            monkeypatch.setattr(cl, name, value)
    r = random.Random(4)
    usual = ["The", "of", "é", "new", "york", "city", "Hall", "a-b", "$x", "the"]
    prose = lambda k: "".join(r.choice(usual) + r.choice([" ", " ", "  ", "\t", ", ", ".", "\r\n"]) for _ in range(k))
    rows = [(x[2], x[1]) for x in fixture_rows()]
    rows += [(r.choice(["en", "und", None, "", "x y"]), prose(120) + "new york city hall " * r.randrange(9)) for _ in range(40)]
    table = spark.createDataFrame(
        [(i, t, lang, "s", 1, 7, "s", "z") for i, (lang, t) in enumerate(rows)], SCHEMA).repartition(3)
    expected = plain_collocations(rows, 6)
    found = cl.collocations(table, min_count=6, filter_bits=1 << 15 if small else 1 << 20)
    assert sorted(map(tuple, found.collect())) == sorted(expected) and len(expected) > 300
    three = cl.collocations(table, min_count=6, top=3).collect()
    assert sorted(map(tuple, three)) == sorted(x for x in expected if x[1] <= 3)
    assert cl.collocations(table.limit(0)).count() == 0


def test_trie_counts_through_bursts_and_spills(monkeypatch):
    monkeypatch.setattr(cl, "BURST", 3)
    trie, expected, out, r = cl.PhraseTrie(4), Counter(), Counter(), random.Random(7)
    for _ in range(400):
        key = 0
        for _ in range(4):
            key = key << cl._ID_BITS | r.randrange(3)
        trie.add([key], [2], [5, 6, 6])
        expected[key] += 2
        if r.random() < 0.02:
            out.update(trie.take(trie.largest()))
    for p in range(cl.PREFIXES):
        out.update(trie.take(p))
    assert out == expected and len(trie) == 0


def test_runs_of_phrases_are_packed(spark):
    """A task hands over a packed row for each subtree and number of words, not a row for each phrase."""
    r = random.Random(3)
    texts = [" ".join(f"w{r.randrange(3000)}" for _ in range(400)) for _ in range(100)]
    table = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").coalesce(1)
    for slices in (1, 3):
        runs = cl._runs(table, (1, 2), slices, False).collect()
        found = Counter()
        for row in runs:
            found.update(dict(zip(cl.unpack_lines(row.phrases), cl.unpack_numbers(row.known, row.at).tolist())))
        w = [t.split(" ") for t in texts]
        expected = Counter(x.encode() for t in w for x in t) + Counter(" ".join(x).encode() for t in w for x in zip(t, t[1:]))
        assert found.pop(b"") == 40_000 and found == expected
        assert len(runs) <= 2 * cl.PREFIXES * slices + 1 < len(expected) / 10
        assert sum(len(x.phrases) + len(x.known) + len(x.at) for x in runs) < 9 * len(expected)
