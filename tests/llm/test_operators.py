"""The text operators against plain versions, on a fixture of nulls, empty, long, repeated and clashing rows."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skytally.llm import decontam, token_files as tf
from skytally.llm.decontam import clean_documents, contaminated_words
from skytally.llm.encoding import END_ID, PATH, Encoder, encoder
from skytally.llm.labelled import fold
from skytally.llm.mixing import mix_sources, mixed_documents
from skytally.llm.near import Bands, jaccard_groups, one_of_each_group, shingle_set, sketch
from skytally.llm.quality import fit_ordinal, score_quality, select_quality, train_quality
from skytally.llm.queries import document_edits, grade
from skytally.llm.rules import distance, quality_rules
from skytally.llm.secrets import scan_secrets
from skytally.llm.substrings import remove_repeated_windows
from skytally.llm.token_counts import build, count_tokens, edit, recount_edited
from skytally.llm.toxicity import fit_cnn, score_toxicity
from skytally.plans.durable import scratch_path
from tests.conftest import TABLES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, batch long, signature string, size string"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fixture_rows():
    r = random.Random(5)
    word = [f"w{i}" for i in range(300)]
    passage = " ".join(r.choice(word) for _ in range(60))
    base = [r.choice(word) for _ in range(120)]
    texts = [None, "", " \t\n ", "one", "Two words", "a b c", "A B C", passage, f"x {passage} y", passage.upper(),
             "tokén = \"abcdefghij1234567890\" AKIA" + "Q7" * 10 + " " + "0a" * 14,
             'secret=token : abcdefgh PASSWORD:"hunter2hunter2hunter2"', " ".join(["same same same"] * 30) + "\nx\nx\n\n\n",
             " ".join(r.choice(word) for _ in range(6000)), "$$$ %% ## <a> " * 40]
    for i in range(25):  # near copies
        copy = list(base)
        for _ in range(i % 6):
            copy[r.randrange(len(copy))] = "edit" + str(r.randrange(10**6))
        texts.append(" ".join(copy))
    texts += [texts[-1]] * 5
    rows = [(i, t, ["en", "fr", None][i % 3], ["a", "b", None, "c"][i % 4], 1, 7, "s", "z") for i, t in enumerate(texts)]
    return rows + [rows[8], rows[8], (None, passage, "en", "a", None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture_rows(), SCHEMA).repartition(3).cache()


def words(text):
    return (text or "").encode().split()


def plain_shingles(text, n):
    w = (text or "").translate(FOLD).encode().split()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def plain_groups(rows, n, num, den):
    group = {d: d for d, _ in rows}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    sets = [(d, plain_shingles(t, n)) for d, t in rows]
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and den * len(s & t) >= num * len(s | t):
                x, y = top(a), top(b)
                group[max(x, y)] = min(x, y)
    return {d: top(d) for d, _ in rows}


@pytest.mark.parametrize("n, num, den", [(4, 85, 100), (5, 4, 5), (2, 1, 2)])
def test_groups_equal_all_pairs(docs, n, num, den):
    rows = [(r[0], r[1]) for r in fixture_rows() if r[0] is not None]
    expected = plain_groups(rows, n, num, den)
    found = jaccard_groups(docs, n, num, den).collect()
    assert len(found) == len(fixture_rows())
    text_of = dict(rows)
    for r in found:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == (len(plain_shingles(text_of[r.doc_id], n)), expected[r.doc_id])
    assert [r.component_id for r in found if r.doc_id is None] == [None]
    kept = one_of_each_group(docs, n, num, den)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(expected.values()))


def test_every_link_is_counted(spark, docs):
    rows = [(r[0], r[1]) for r in fixture_rows() if r[0] is not None]
    alike = [(i, " ".join(f"u{k}" for k in range(100) if k != 20 * i)) for i in range(4)]  # each linked with each
    for given, table in ((rows, docs), (alike, spark.createDataFrame(alike, "doc_id long, text string"))):
        sets = {d: plain_shingles(t, 4) for d, t in given}
        linked = {d: {t for t in sets.values() if s and t and s != t and 100 * len(s & t) >= 85 * len(s | t)}
                  for d, s in sets.items()}
        found = jaccard_groups(table, 4, 85, 100).where("doc_id IS NOT NULL").collect()
        assert {r.doc_id: r.n_links for r in found} == {d: len(x) for d, x in linked.items()}
        assert max(r.n_links for r in found) > 2
        plain = jaccard_groups(table, 4, 85, 100, count_links=False).collect()
        assert {(r.doc_id, r.component_id) for r in plain if r.doc_id is not None} == {(r.doc_id, r.component_id) for r in found}


def test_bands_cover_every_linked_pair_and_sketches_never_exceed():
    bands = Bands(85, 100)
    for s in range(1, 400):
        for t in range(s, s * 100 // 85 + 1):
            most = max((s + t - 2 * c for c in range(s + 1) if 100 * c >= 85 * (s + t - c)), default=None)
            if most:
                shared = set(bands.of(s)) & set(bands.of(t))
                assert any(bands.differences(k) >= most for k in shared), (s, t)
    a, b = (shingle_set(" ".join(f"v{i}" for i in x).encode(), 1) for x in (range(300), range(40, 330)))
    assert sum((x ^ y) & (2**64 - 1) and bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(sketch(a), sketch(b))) <= 70


def test_repeated_windows(docs):
    rows = [(r[0] if r[0] is not None else float("inf"), r[1]) for r in fixture_rows()]
    first = {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = words(t)
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i : i + 13]), d)
    expected = Counter()
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < d:
                gone[i : i + 13] = [True] * 13
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        expected[None if d == float("inf") else d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    found = remove_repeated_windows(docs).collect()
    assert Counter(tuple(r)[:4] for r in found) == expected
    assert all(sum(x.end - x.start for x in r.removed) == r.n_removed for r in found)


def test_secrets(docs):
    assign = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    expected = Counter()
    for d, t, *_ in fixture_rows():
        t = t or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        expected[(d, *(sum(k == s[1] for s in spans) for k in range(3)), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:5] for r in scan_secrets(docs).collect()) == expected


def test_secrets_of_a_text_that_is_all_matches(spark):
    text = " ".join(f"token=qwerty{i:012d} {i:024x} AKIA{i:020d}" for i in range(20_000))
    kinds = {"assign": r"token=[A-Za-z0-9]+", "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]{24,}"}
    expected = sorted((m.start(), m.end(), k) for k, p in kinds.items() for m in re.finditer(p, text))
    begin = time.time()
    [row] = scan_secrets(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")).collect()
    assert time.time() - begin < 60  # a square of the matches takes minutes
    found = [span.split(":") for span in row.spans.split(",")]
    assert sorted((int(s), int(e), k) for k, s, e in found if k != "live") == expected
    live = [(int(s), int(e)) for k, s, e in found if k == "live"]
    assert len(live) == len(set(live)) == row.n_live > 0


def test_secrets_by_owner(spark):
    shared, own = "token = Zx81kQpLm27RtYv0", "token = Qw93mNbVc48HgTy5"
    rows = [(i, shared, f"o{i}", 1) for i in range(3)] + [(9, f"{own} {own}", "o9", 1), (10, "token = aaaaaaaaaaaaaaaaaaaa", "o", 1)]
    found = {r.doc_id: r for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string, row int")).collect()}
    assert found[0].spans == "assign:0:24" and (found[0].n_live, found[0].n_copied) == (0, 1)
    assert found[9].spans == "assign:0:24,live:8:24,assign:25:49,live:33:49" and found[9].secrets[0].owners == 1
    assert found[10].n_live == 0


def test_secrets_copied_within_one_owner(spark):
    example, own = "token = Zx81kQpLm27RtYv0", "token = Qw93mNbVc48HgTy5"
    rows = [(i, f"{example} {i}", "o") for i in range(12)] + [(20 + i, own, "o") for i in range(12)]  # many texts; one text
    rows += [(40 + i, f"secret = Jd64sFgKx19PzWb2 {i}", "o") for i in range(9)]
    found = {r.doc_id: r for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all((found[i].n_live, found[i].n_copied, found[i].secrets[0].repositories) == (0, 1, 12) for i in range(12))
    assert all((found[i].n_live, found[i].n_copied, found[i].secrets[0].repositories) == (1, 0, 1) for i in range(20, 32))
    assert all((found[i].n_live, found[i].secrets[0].repositories) == (1, 9) for i in range(40, 49))


def plain_contamination(rows, items):
    pattern = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in items:
        w = pattern.findall((t or "").translate(FOLD))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)
    out = Counter()
    for d, t in rows:
        w = pattern.findall((t or "").translate(FOLD))
        hit, found = [0] * len(w), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if here := windows.get(tuple(w[k : k + n])):
                    found |= here
                    hit[k : k + n] = [1] * n
        names = sorted(str(i) for i in found if i is not None)
        out[d, len(w), sum(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), sum(hit) > 0] += 1
    return out


@pytest.mark.parametrize("broadcast", [decontam.BROADCAST_BYTES, 0])
def test_contamination(spark, docs, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", broadcast)
    passage = fixture_rows()[7][1]
    items = [(1, passage), (2, "Two, WORDS!"), (3, None), (4, "..."), (5, "one"), (10, " ".join(passage.split()[5:20])),
             (None, "same same same same same same same same same same same"), (5, "one"), (6, "edit nowhere to be found")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = plain_contamination([(r[0], r[1]) for r in fixture_rows()], items)
    found = contaminated_words(docs, bench).drop("text_key", "hit_spans").collect()
    assert Counter(map(tuple, found)) == expected
    clean = clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(k[0] for k in expected.elements() if not k[5])
    assert not any(r.contaminated for r in contaminated_words(docs, bench.limit(0)).collect())


def test_mix(docs):
    rows = [(r[0], r[3], len(words(r[1]))) for r in fixture_rows()]
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 2 * sizes[s]}
        target |= {s: 2 * sizes[s] for s in full} if full else share
        left -= sum(2 * sizes[s] for s in full)
        free = free - full if full else set()
    found = mix_sources(docs).collect()
    taken = Counter()
    source = {r[0]: r[1] for r in rows}
    for r in found:
        s = source[r.doc_id]
        assert r.target == pytest.approx(target[s]) and r.source_size == sizes[s] and r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 + sum(x[1] == s for x in rows) for s in names)
    again = mix_sources(docs).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns and sum(len(words(r.text)) for r in mixed.collect()) == sum(taken.values())


def test_rules(docs):
    for r in quality_rules(docs).collect():
        text = next(t for d, t, *_ in fixture_rows() if d == r.doc_id) or ""
        w, lines, seen, again = text.encode().split(), text.split("\n"), set(), 0
        for line in lines:
            again += line in seen
            seen |= {line} if line.split() else set()
        windows = Counter(zip(w, w[1:], w[2:]))
        hit = {i + j for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for j in range(3)}
        symbols = sum(text.count(c) for c in "#*$%&|<>")
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        expected = (len(w), sum(len(x.decode()) for x in w), symbols, again, len(hit), failed)
        assert tuple(r)[1:7] == expected and (not r.kept or not failed)
    assert distance(np.array([1, 0]), np.array([0, 3])) == 1 and distance(np.array([2, 2]), np.array([1, 1])) == 0


def test_rules_judge_short_texts(spark):
    r = random.Random(3)
    usual = [f"{a}{b}" for a in "bdfgkl" for b in ("a", "en", "or", "is")]

    def prose(n):
        return " ".join(r.choices(usual, range(len(usual), 0, -1), k=n))

    rows = [(i, prose(400), "en") for i in range(40)]
    rows += [(100 + n, prose(n), "en") for n in (50, 60, 80, 110, 150, 199)]
    rows += [(1000 + n, " ".join(f"x{r.randrange(10**4)}q" for _ in range(n)), "en") for n in (50, 60, 80, 110, 150, 199)]
    rows += [(2000 + n, " ".join(f"{i}" for i in range(n)), "en") for n in (50, 99, 199)]  # 139 characters the shortest
    found = {x.doc_id: x for x in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(x.kept == (d < 1000) for d, x in found.items())
    assert all(x.char_distance is not None and x.word_distance is not None for x in found.values())


def test_codec_round_trip():
    rng = np.random.default_rng(3)
    for _ in range(40):
        n = int(rng.integers(0, 3000))
        bits = rng.choice([0, 1, 2, 4, 8, 12, 16, 20, 30, 60, 63], n)
        ids = np.array([int(rng.integers(0, 1 << int(b))) if b else 0 for b in bits], np.uint64)
        if n > 9:
            ids[[0, 7, n - 1]] = (2**60 - 1, 2**64 - 1, 2**64 - 1)
        packed, offsets = tf.encode_blocks(ids)
        assert (tf.decode_blocks(packed, offsets.astype(np.int64), n) == ids).all()


ODD = ["a\n \nb", "a   b", "a  b", " \nb", "a\n ", "", "  ", " ", "don't 's <|endoftext|> x", "a   b", "x <|endoftext|>"]


def test_encoder_equals_the_library():
    coder = Encoder(PATH)
    texts = ODD + [r[1] or "" for r in fixture_rows()]
    expected = [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [np.frombuffer(x, np.uint32).tolist() for x in coder.encode(texts)] == expected


def test_new_words_are_encoded_in_short_texts(monkeypatch):
    """The library takes less time for many short texts than for a few long ones."""
    coder, given = Encoder(PATH), []
    whole = coder._whole
    monkeypatch.setattr(coder, "_whole", lambda texts: given.extend(texts) or whole(texts))
    text = " ".join("ab" + "".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(3000))
    found = np.frombuffer(coder.encode([text])[0], np.uint32).tolist()
    assert found == coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert 10 < len(given) and max(len(t.split()) for t in given) <= 200


def test_encoder_on_odd_joints():
    """Marks behind words, white space at the ends of chunks, special tokens: one at a time and all at once."""
    parts = ["a", "B", "\u00e9", "\n", "\t", " ", "  ", ".", "'s", "12", "#", "\u00a0", "\x85", "\u3000", "\u65e5\u672c",
             "<|endoftext|>", "?!", "|>", "word", ".,", " the"]
    rng = random.Random(5)
    texts = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(4000)]
    coder = Encoder(PATH)
    expected = [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, np.uint32).tolist() for x in coder.encode(texts)] == expected
    assert [np.frombuffer(coder.encode([t])[0], np.uint32).tolist() for t in texts[:300]] == expected[:300]


def test_a_word_is_remembered_once_whatever_marks_follow():
    coder = Encoder(PATH)
    text = "a " + " ".join(f"word{end} \u00e9t\u00e9{end}" for end in ["", ",", ".", "?!", ";;;"])
    found = coder.encode([text, text + " word:"])
    assert [x.tolist() for x in found] == [
        coder.tokenizer.encode(t, add_special_tokens=False).ids for t in (text, text + " word:")]
    assert set(coder.of_chunk.young) == {"word", "\u00e9t\u00e9"}


@pytest.mark.parametrize("remembered", [400_000, 7])
def test_encoder_on_words_of_many_scripts(remembered):
    """Words of letters are cut at spaces only; letters beyond the old scripts, digits and joints are not."""
    rng = random.Random(6)
    letters = "abcxyzABC\u00e9\u00df\u0153\u02bc\u03b1\u03a9\u0416\u044f\u0587\u05d0\u0639\u0915\u093f\u65e5\ud55c\u1e9e\U0001d5ba\U00016e40"
    ends = ["", "", "", ",", ".", "!?", "'s", "1", "-x", "\u00a0", "\u0301", "\n", "|", "\u2019"]
    words = ["".join(rng.choices(letters[: rng.choice([9, 16, len(letters)])], k=rng.randrange(1, 9))) + rng.choice(ends)
             for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(30))) for _ in range(900)]
    coder = Encoder(PATH, remembered)
    expected = [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    found = [x.tolist() for i in range(0, len(texts), 100) for x in coder.encode(texts[i : i + 100])]
    assert found == expected
    assert [x.tolist() for x in coder.encode(texts)] == expected  # old and new generation


def test_texts_are_taken_in_runs_of_bytes(monkeypatch):
    monkeypatch.setattr(tf, "BYTES_AT_ONCE", 10)
    texts = ["abcd", None, "x" * 25, "", "\u00e9\u00e9\u00e9", "ab", "cdefghijkl", None]
    for column in (pa.array(texts), pa.array(["zz", *texts])[1:], pa.array([], pa.string())):
        runs = [run.to_pylist() for run in tf._runs(column)]
        assert sum(runs, []) == column.to_pylist()
        assert all(len("".join(t or "" for t in run[:-1]).encode()) < 20 for run in runs)
    assert len([*tf._runs(pa.array(texts))]) > 2


@pytest.mark.parametrize("remembered", [400_000, 5])
def test_token_pages(spark, docs, remembered):
    path = scratch_path(spark, "pages")
    tf.write_token_pages(docs, path, remembered=remembered)
    rows = sorted(((r[0], r[1] or "") for r in fixture_rows()), key=lambda r: (r[0] is None, r[0] or 0))
    start, expected = 0, []
    for d, t in rows:
        ids = [*encoder().tokenizer.encode(t, add_special_tokens=False).ids, END_ID]
        expected.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert Counter(map(tuple, tf.read_token_pages(spark, path).collect())) == Counter(expected)


def test_edited_counts(spark, docs):
    coder, r = Encoder(PATH), random.Random(2)
    for text in ODD + [x[1] or "" for x in fixture_rows()[:20]]:
        tree = build(coder, text)
        for _ in range(6):
            at = r.randint(0, len(text) + 1)
            new = r.choice(["", " ", "\n", "'s", "hello world,", "   \n ", " " * 20, "<|endoftext|>"])
            tree, text, _ = edit(coder, tree, text, at, at + r.choice([0, 1, 40]), new)
            assert tree.tokens[1] == len(coder.tokenizer.encode(text, add_special_tokens=False).ids)
            assert tree.chars[1] == len(text)
    edited = recount_edited(count_tokens(docs).withColumn("edits", document_edits()))
    for row in edited.collect():
        assert row.n_tokens == len(coder.tokenizer.encode(row.text or "", add_special_tokens=False).ids)


def test_models_learn_from_text_alone(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    model = train_quality(docs, labels, grade())
    assert (np.diff(model.thresholds) > 0).all()
    scored = score_quality(docs, model).join(labels, "doc_id").where(fold() != 0).collect()
    assert np.mean([r.selected == (r.quality == 1) for r in scored]) > 0.95
    kept = select_quality(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    r = random.Random(1)
    plain = [" ".join(r.choice("abcdefghijk") * 3 + str(r.randrange(40)) for _ in range(60)) for _ in range(400)]
    toxic = [i % 4 == 0 for i in range(400)]
    texts = [f"{t} scum{r.randrange(9)}, {t[:40]}" if bad else t for t, bad in zip(plain, toxic)]
    net = fit_cnn(texts[:300], [int(b) for b in toxic[:300]])
    assert np.mean((net.scores(texts[300:]) >= 0.5) == np.array(toxic[300:])) > 0.97
    odd = score_toxicity(spark.createDataFrame([(None, None, None), (1, "", "xx"), (1, "", "xx")], "doc_id long, text string, lang string"), net)
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in odd.collect()) and odd.count() == 3
    assert len(fit_ordinal([], []).thresholds) == 1 and fit_cnn([], []).scores(["a"]).tolist() == [0.5]


def test_empty_tables(spark, docs, tmp_path):
    none = docs.limit(0)
    for found in (jaccard_groups(none), remove_repeated_windows(none), scan_secrets(none), mix_sources(none),
                  mixed_documents(none), quality_rules(none), contaminated_words(none, docs.selectExpr("doc_id item_id", "text")),
                  count_tokens(none), one_of_each_group(none), select_quality(none, fit_ordinal([], []))):
        assert found.count() == 0
    path = scratch_path(spark, "empty")
    tf.write_token_pages(none, path)
    assert tf.read_token_pages(spark, path).count() == 0
