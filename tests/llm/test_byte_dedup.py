"""Suffix order by linear grouping, and the removal of repeated byte strings, against plain versions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from skytally.llm import byte_dedup
from skytally.llm.byte_dedup import remove_repeated_bytes, window_anchors
from skytally.llm.suffixes import suffix_order, window_classes
from tests.llm.test_operators import SCHEMA, fixture_rows


@pytest.mark.parametrize("letters", [b"ab", b"abcde", b"a\x00\xff"])
def test_suffixes_are_in_order(letters):
    r = random.Random(1)
    for _ in range(120):
        sets, strings = [], []
        for s in range(r.randint(1, 6)):
            for _ in range(r.randint(1, 4)):
                sets.append(s)
                strings.append(bytes(r.choices(letters, k=r.randint(0, 12))))
        suffixes, at = {}, 0
        for s, x in zip(sets, strings):
            suffixes |= {at + i: (s, x[i:]) for i in range(len(x) + 1)}
            at += len(x) + 1
        found = suffix_order(strings, np.array(sets))
        assert [suffixes[i] for i in found.order.tolist()] == sorted(suffixes.values())
        assert (found.order[found.slot] == np.arange(at)).all()


def test_pointers_and_groups_are_those_of_the_definition():
    text = b"banana bandana cabana"
    found = suffix_order([text], np.zeros(1, int))
    suffixes = [text[i:] for i in range(len(text))]
    for i, x in enumerate(suffixes):
        smaller = [j for j in range(i + 1, len(text)) if suffixes[j] < x]
        assert found.end[i] == (smaller[0] if smaller else len(text))
        before = [j for j in range(i) if suffixes[j] < x]
        if before and text[before[-1] : found.end[before[-1]]] < text[i : found.end[i]]:
            assert found.previous[i] == before[-1]
    prefixes = {i: text[i : found.end[i]] for i in range(len(text))}
    for i in prefixes:
        for j in prefixes:
            assert (found.group[i] == found.group[j]) == (prefixes[i] == prefixes[j])
            assert (found.group[i] < found.group[j]) == (prefixes[i] < prefixes[j])


def test_windows_of_one_class_are_equal():
    r = random.Random(2)
    strings = [bytes(r.choices(b"abc", k=r.randint(0, 30))) for _ in range(80)]
    sets = np.sort(np.array([r.randrange(9) for _ in strings]))
    classes = window_classes(strings, sets, 3).tolist()
    windows = [(s, x[i : i + 3]) for s, x in zip(sets.tolist(), strings) for i in range(len(x) - 2)]
    assert len(classes) == len(windows)
    named = dict(zip(classes, windows))
    assert [named[c] for c in classes] == windows and len(set(named.values())) == len(named)
    assert len(window_classes([], np.empty(0, int), 3)) == 0


def test_equal_windows_have_equal_anchors():
    text = np.random.default_rng(4).integers(0, 3, 70_000, dtype=np.uint8)
    anchors = window_anchors(text, 9, 4)
    seen = {}
    for i, a in enumerate(anchors.tolist()):
        assert seen.setdefault(text[i : i + 9].tobytes(), a) == a
    assert len(anchors) == 70_000 - 8 and len(window_anchors(text[:8], 9, 4)) == 0


def plain(rows, window):
    last, first, out = float("inf"), {}, Counter()
    rows = [(last if d is None else d, (t or "").encode()) for d, t in rows]
    for d, b in sorted(rows, key=lambda r: r[0]):
        for i in range(len(b) - window + 1):
            first.setdefault(b[i : i + window], d)
    for d, b in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if first[b[i : i + window]] < d:
                gone[i : i + window] = b"\1" * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()
        out[None if d == last else d, len(b), sum(gone), spans, kept] += 1
    return out


@pytest.mark.parametrize("spread", [byte_dedup.SPREAD, 3])
def test_repeated_bytes(spark, monkeypatch, spread):
    monkeypatch.setattr(byte_dedup, "SPREAD", spread)
    r = random.Random(3)
    rows = [(x[0], x[1]) for x in fixture_rows()]
    rows += [(500 + i, "ab" * r.randint(10, 200) + "é" * r.randint(0, 30)) for i in range(8)]
    rows += [(600 + i, "\x00" * r.randint(0, 90)) for i in range(4)] + [(700, "a" * 5000), (701, "b" + "a" * 4000)]
    rows += [(700, "other text of an id that occurs before " * 3), (None, "a" * 200)]
    table = spark.createDataFrame([(*x, *fixture_rows()[0][2:]) for x in rows], SCHEMA).repartition(3)
    found = remove_repeated_bytes(table).collect()
    assert Counter(tuple(x)[:5] for x in found) == plain(rows, 50)
    assert all(sum(x.end - x.start for x in f.removed) == f.n_removed and len(f.removed) == f.n_spans for f in found)
    assert remove_repeated_bytes(table.limit(0)).count() == 0
