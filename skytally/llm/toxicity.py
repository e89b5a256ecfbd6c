"""Toxicity of whole texts: a convolutional classifier over hashed word embeddings, trained in shards on all labels."""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skytally.llm.labelled import agreed_labels, fold, word_hashes
from skytally.llm.packing import bitmap, in_bitmap
from skytally.plans.durable import stored

CELLS = 1 << 16  # of hashed words, and as many of hashed stems; cell 0 is the padding behind a text
STEM = 4  # leading characters of a word, which inflected forms share
DEPTH = 8
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
EPOCHS, BATCH, RATE = 6, 32, 0.01
RARE = 15  # texts that a word needs for half of its log odds to count
LEAST_LABELLED = 20
LEAST_PER_LANG = 10  # toxic documents that a language needs for a threshold of its own
AT_ONCE = 400_000  # words convolved together
SHARD_DOCS = 4096  # labelled documents that a task trains on before models are averaged
SHARD_BYTES = 32 << 20  # of their text
LABEL_BITS = 1 << 26  # of the bitmap of labelled ids, 8 MB; a power of two
UNIT = float(1 << 40)  # changes of a model are summed as whole numbers of 1 / UNIT, so that no order matters
BINS, BIN = 5120, 1 / 64  # of logits, in which thresholds are looked for

RESULT = "doc_id long, held_out boolean, score double, predicted int, flagged boolean"
_CELLS = "shard long, h long, doc_id long, lang string, cells binary"
_SHARDS = "shard long, labels binary, folds binary, langs array<string>, sizes binary, cells binary"
_VALUES = [f"v{i}" for i in range(DEPTH)]


def _cells(text: str) -> np.ndarray:
    """Cells of each word and of its stem, in two columns."""
    cells = (word_hashes(text, STEM) % np.uint64(CELLS - 1)).astype(np.int64) + 1
    cells[:, 1] += CELLS
    return cells


@dataclass
class TextCnn:
    """Embeddings, one filter bank per width, ReLU, maximum over the text, and a logistic layer.

    ``thresholds`` hold, by language, where a score is flagged; the score itself knows nothing of languages.
    """

    embedding: np.ndarray
    banks: list[np.ndarray]  # width x depth x filters
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)

    def pooled(self, cells: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text: pooled features, the word at which each has its maximum, and the padded words."""
        pad = max(WIDTHS) - 1
        sizes = np.array([len(c) + pad for c in cells])
        flat = np.concatenate([np.r_[c, np.zeros((pad, 2), np.int64)] for c in cells] + [np.zeros((pad, 2), np.int64)])
        long = len(flat) - pad
        starts = np.cumsum(sizes) - sizes
        values = self.embedding[flat[:, 0]] + self.embedding[flat[:, 1]]
        best, where = [], []
        for bank, bias in zip(self.banks, self.biases):
            total = sum(values[j : j + long] @ bank[j] for j in range(len(bank))) + bias
            top = np.maximum.reduceat(total, starts)
            best.append(top)
            if self.training:
                owner = np.repeat(np.arange(len(sizes)), sizes)
                at = np.empty(top.shape, np.int64)
                for f in range(top.shape[1]):
                    hit = np.flatnonzero(total[:, f] == top[owner, f])
                    at[owner[hit][::-1], f] = hit[::-1]
                where.append(at)
        return np.maximum(np.hstack(best), 0), np.hstack(where) if where else np.empty(0), flat

    training = False

    def logits(self, cells: Iterable[np.ndarray]) -> np.ndarray:
        """Logit of label 1 of each text. Texts are convolved together up to a bounded number of words."""
        out, held, words = [], [], 0
        for one in [*cells, None]:
            if held and (one is None or words > AT_ONCE):
                out.append(np.clip(self.pooled(held)[0] @ self.out + self.bias, -40, 40))
                held, words = [], 0
            if one is not None:
                held.append(one)
                words += len(one)
        return np.concatenate(out) if out else np.empty(0)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 of each text."""
        return 1 / (1 + np.exp(-self.logits(_cells(t) for t in texts)))


def _seen(cells: list[np.ndarray], y: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
    """By label: texts that hold each cell, and texts."""
    held = [[np.unique(c) for c, k in zip(cells, y) if k == label] for label in (0, 1)]
    return ([np.bincount(np.concatenate([*h, np.empty(0, np.int64)]), minlength=2 * CELLS) for h in held],
            [len(h) for h in held])


def _initial(seen: list[np.ndarray], n: list[int], rng: np.random.Generator) -> TextCnn:
    """Small random weights; two channels start as the log odds of label 1 of words and stems,
    shrunk for rare ones. Without enough texts of both labels, a model that scores all texts alike."""
    odds = np.log((seen[1] + 0.5) / (max(1, n[1]) + 1)) - np.log((seen[0] + 0.5) / (max(1, n[0]) + 1))
    total = seen[0] + seen[1]
    odds *= total / (total + RARE)
    embedding = rng.normal(0, 0.05, (2 * CELLS, DEPTH)).astype(np.float32)
    embedding[:CELLS, 0] = odds[:CELLS]
    embedding[CELLS:, 1] = odds[CELLS:]
    embedding[0] = 0
    banks = [rng.normal(0, 0.1, (w, DEPTH, FILTERS)).astype(np.float32) for w in WIDTHS]
    for bank in banks:
        bank[:, 0, : FILTERS // 4] = 1 / len(bank)
        bank[:, 1, FILTERS // 4 : FILTERS // 2] = 1 / len(bank)
    biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    out = rng.normal(0, 0.05, FILTERS * len(WIDTHS)).astype(np.float32)
    if not _enough(n):
        out[:] = 0
    share = float(np.clip(n[1] / sum(n), 1e-3, 1 - 1e-3)) if sum(n) else 0.5
    return TextCnn(embedding, banks, biases, out, float(np.log(share / (1 - share))))


def _enough(n: list[int]) -> bool:
    return sum(n) >= LEAST_LABELLED and min(n) > 0


class Training:
    """A model and the moments of its dense weights (Adam); the gradient of a maximum flows to the words at which it is
    taken."""

    def __init__(self, model: TextCnn):
        self.model = model
        self.dense = [*model.banks, *model.biases, model.out]
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.dense]
        self.step = 0

    def epoch(self, cells: list[np.ndarray], y: np.ndarray, rng: np.random.Generator) -> None:
        """One pass over the texts in batches."""
        model, dense = self.model, self.dense
        model.training = True
        order = rng.permutation(len(y))
        for begin in range(0, len(y), BATCH):
            rows = order[begin : begin + BATCH]
            self.step += 1
            features, where, flat = model.pooled([cells[i] for i in rows])
            chance = 1 / (1 + np.exp(-np.clip(features @ model.out + model.bias, -40, 40)))
            error = (chance - y[rows]) / len(rows)
            to_features = (error[:, None] * model.out) * (features > 0)
            gradients = [np.zeros_like(p) for p in dense]
            gradients[-1][:] = features.T @ error + 1e-4 * model.out
            words, to_words = [], []
            for k, width in enumerate(WIDTHS):
                part = slice(k * FILTERS, (k + 1) * FILTERS)
                gradients[len(WIDTHS) + k][:] = to_features[:, part].sum(axis=0)
                for j in range(width):
                    at = flat[where[:, part] + j]
                    at_word, at_stem = at[..., 0], at[..., 1]
                    gradients[k][j] = np.einsum(
                        "nfd,nf->df", model.embedding[at_word] + model.embedding[at_stem], to_features[:, part])
                    words += [at_word.ravel(), at_stem.ravel()]
                    to_words += 2 * [(to_features[:, part, None] * model.banks[k][j].T[None]).reshape(-1, DEPTH)]
            for p, g, (m, v) in zip(dense, gradients, self.moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)
            model.bias -= RATE * float(np.sign(error.sum())) * min(1.0, abs(error.sum()) * 10)
            np.add.at(model.embedding, np.concatenate(words), -0.05 * np.concatenate(to_words).astype(np.float32))
            model.embedding[0] = 0
        model.training = False

    def rows(self) -> np.ndarray:
        """All numbers that training changes, in rows of ``DEPTH``: embeddings, then dense weights, moments and bias."""
        rest = np.concatenate([*(p.ravel() for p in self.dense), *(x.ravel() for m in self.moments for x in m),
                               [self.model.bias, self.step]])
        return np.vstack([self.model.embedding, np.r_[rest, np.zeros(-len(rest) % DEPTH)].reshape(-1, DEPTH)])

    def set_rows(self, rows: np.ndarray) -> None:
        """Take the numbers of :meth:`rows`."""
        self.model.embedding[:] = rows[: 2 * CELLS]
        rest, at = rows[2 * CELLS :].ravel(), 0
        for x in [*self.dense, *(x for m in self.moments for x in m)]:
            x[...] = rest[at : at + x.size].reshape(x.shape)
            at += x.size
        self.model.bias, self.step = float(rest[at]), int(round(rest[at + 1]))


def fit_cnn(texts: list[str], labels: list[int], seed: int = 11) -> TextCnn:
    """Train on texts in memory, as one shard."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, np.float64)
    cells = [_cells(t) for t in texts]
    seen, n = _seen(cells, y)
    training = Training(_initial(seen, n, rng))
    for _ in range(EPOCHS if _enough(n) else 0):
        training.epoch(cells, y, rng)
    return training.model


def labelled_shards(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document outside fold 0 whose id has a label, as cells; one row is a shard of about ``SHARD_DOCS``.

    Tasks hash the words of documents whose id is set in a bitmap of fixed size; ids set by chance meet no label in
    their shard. Labels of one id that disagree, null labels and null ids are left out; repeated rows are all kept.
    """
    key = F.xxhash64(F.lit("sample"), "doc_id")
    one = agreed_labels(labels, F.col("toxic")).withColumn("h", key)
    bits = documents.sparkSession.sparkContext.broadcast(bitmap(one.select("h"), LABEL_BITS))
    row = documents.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    n = one.count()
    shards = max(1, n // SHARD_DOCS, int((row.b or 0) * n / max(1, row.n)) // SHARD_BYTES)

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = np.flatnonzero(in_bitmap(bits.value, batch["h"].to_numpy().view(np.uint64)))
            if not len(mine):
                continue
            batch = batch.take(pa.array(mine))
            cells = [(_cells(t or "") - [0, CELLS]).astype("<u2").tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["shard"], batch["h"], batch["doc_id"], batch["lang"], pa.array(cells, pa.binary())],
                names=["shard", "h", "doc_id", "lang", "cells"])

    def pack(docs: pa.Table, names: pa.Table) -> pa.Table:
        label = dict(zip(names["doc_id"].to_pylist(), zip(names["label"].to_pylist(), names["fold"].to_pylist())))
        rows = sorted(
            ((h, c, x or "", *label[d]) for h, d, x, c in zip(*(docs[k].to_pylist() for k in ("h", "doc_id", "lang", "cells")))
             if d in label), key=lambda r: r[:3])
        columns = [[(docs if len(docs) else names)["shard"][0].as_py()], [bytes(r[3] for r in rows)], [bytes(r[4] for r in rows)],
                   [[r[2] for r in rows]], [np.array([len(r[1]) // 4 for r in rows], "<u4").tobytes()],
                   [b"".join(r[1] for r in rows)]]
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)],
                        names=["shard", "labels", "folds", "langs", "sizes", "cells"])

    shard = F.pmod("h", F.lit(shards)).alias("shard")
    kept = documents.where("doc_id IS NOT NULL").where(fold() != 0).select(
        F.col("doc_id").cast("long").alias("doc_id"), key.alias("h"), "text", "lang").select(shard, "*")
    named = one.select(shard, F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"),
                       fold().cast("int").alias("fold"))
    return stored(kept.mapInArrow(to_cells, _CELLS).groupBy("shard").cogroup(named.groupBy("shard")).applyInArrow(pack, _SHARDS))


def _each_shard(shards: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run(shard, cells, labels, folds, langs)`` of each shard, which yields batches."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, labels, folds, langs, sizes, cells = (c[i].as_py() for c in batch.columns)
                flat = np.frombuffer(cells, "<u2").reshape(-1, 2).astype(np.int64) + [0, CELLS]
                ends = np.cumsum(np.frombuffer(sizes, "<u4").astype(np.int64))
                yield from run(shard, np.split(flat, ends[:-1]) if len(ends) else [], np.frombuffer(labels, np.uint8),
                               np.frombuffer(folds, np.uint8), langs)

    return shards.mapInArrow(read, schema)


def _told(folds: np.ndarray) -> list[np.ndarray]:
    """Which texts each model learns from: the one that is calibrated leaves out fold 1, the other takes all."""
    return [np.flatnonzero(folds != 1), np.arange(len(folds))]


def fit_shards(shards: DataFrame, seed: int = 11) -> list[TextCnn]:
    """The models of folds 2 to 4 and of folds 1 to 4, fitted on every row of the shards.

    Counts of cells by label are summed over all shards for the first weights. In an epoch every shard trains on from the
    models of the epoch before; each row of weights is then moved by the mean change of the shards that changed it.
    Tasks exchange changed rows only, and only the sums come to the driver: as many as a model has rows.
    """
    spark = shards.sparkSession

    def count(shard, cells, labels, folds, langs):
        for k, rows in enumerate(_told(folds)):
            seen, n = _seen([cells[i] for i in rows], labels[rows])
            both = np.vstack([np.r_[s, m] for s, m in zip(seen, n)])  # the last cell is the number of texts
            held = np.flatnonzero(both.any(axis=0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(held), k)), pa.array(held), *(pa.array(b[held].astype(np.int64)) for b in both)],
                names=["model", "cell", "n0", "n1"])

    counted = _each_shard(shards, count, "model long, cell long, n0 long, n1 long").groupBy("model", "cell").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect()
    numbers = np.zeros((2, 2, 2 * CELLS + 1), np.int64)
    for k, cell, n0, n1 in counted:
        numbers[k, :, cell] = n0, n1
    texts = numbers[:, :, -1].tolist()
    trainings = [Training(_initial(list(x[:, :-1]), n, np.random.default_rng(seed))) for x, n in zip(numbers, texts)]
    begun = [_enough(n) for n in texts]
    for epoch in range(EPOCHS if any(begun) else 0):
        shared = spark.sparkContext.broadcast(trainings)

        def train(shard, cells, labels, folds, langs):
            for k, rows in enumerate(_told(folds)):
                if not begun[k] or not len(rows):
                    continue
                mine = copy.deepcopy(shared.value[k])
                before = mine.rows()
                mine.epoch([cells[i] for i in rows], labels[rows].astype(np.float64), np.random.default_rng([seed, epoch, shard]))
                change = np.rint(np.nan_to_num(mine.rows() - before) * UNIT).astype(np.int64)
                held = np.flatnonzero(change.any(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(held), k)), pa.array(held), *map(pa.array, np.ascontiguousarray(change[held].T))],
                    names=["model", "row", *_VALUES])

        changes = _each_shard(shards, train, "model long, row long, " + ", ".join(f"{v} long" for v in _VALUES))
        sums = changes.groupBy("model", "row").agg(F.count(F.lit(1)), *map(F.sum, _VALUES)).toArrow()
        sums = np.column_stack([c.to_numpy() for c in sums.columns])
        for k, training in enumerate(trainings):
            of = sums[sums[:, 0] == k]
            rows = training.rows()
            rows[of[:, 1]] += of[:, 3:] / (of[:, 2:3] * UNIT)
            training.set_rows(rows)
        shared.destroy()
    return [t.model for t in trainings]


def calibrate(shards: DataFrame, model: TextCnn) -> dict[str, float]:
    """By language, the threshold of the best F1 over all texts of fold 1; ``""`` has that of all languages, for
    those with few toxic ones. Texts are counted by bins of their logits; thresholds lie between bins."""
    shared = shards.sparkSession.sparkContext.broadcast(model)

    def count(shard, cells, labels, folds, langs):
        mine = np.flatnonzero(folds == 1)
        if len(mine):
            bins = np.clip(shared.value.logits(cells[i] for i in mine) / BIN + BINS // 2, 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[i] for i in mine], pa.string()), pa.array(bins), pa.array(labels[mine].astype(np.int64))],
                names=["lang", "bin", "label"])

    numbers = F.count(F.lit(1)).alias("n"), F.sum("label").alias("k")
    by_bin = stored(_each_shard(shards, count, "lang string, bin long, label long").groupBy("lang", "bin").agg(*numbers))
    sums = F.sum("n").alias("n"), F.sum("k").alias("k")
    enough = by_bin.where("lang <> ''").groupBy("lang").agg(F.sum("k").alias("_k")).where(F.col("_k") >= LEAST_PER_LANG)
    every = by_bin.groupBy("bin").agg(*sums).select(F.lit("").alias("lang"), "bin", "n", "k")
    found: dict[str, np.ndarray] = {}
    for lang, at, n, k in every.unionByName(by_bin.join(enough, "lang").select("lang", "bin", "n", "k")).collect():
        found.setdefault(lang, np.zeros((BINS, 2), np.int64))[at] = n, k
    thresholds = {}
    for lang, counts in found.items():
        if counts[:, 1].sum() >= LEAST_PER_LANG:
            n, k = np.cumsum(counts[::-1], axis=0).T
            best = BINS - 1 - int(np.argmax(2 * k / np.maximum(1, n + k[-1])))
            thresholds[lang] = float(1 / (1 + np.exp((BINS // 2 - best) * BIN)))
    return thresholds


def train_toxicity(documents: DataFrame, labels: DataFrame) -> TextCnn:
    """Fit on every labelled document outside fold 0, in shards.

    A model of folds 2 to 4 finds the thresholds on fold 1; the one that is returned is fitted on folds 1 to 4.
    """
    shards = labelled_shards(documents, labels)
    checked, model = fit_shards(shards)
    model.thresholds = calibrate(shards, checked)
    return model


def score_toxicity(documents: DataFrame, model: TextCnn) -> DataFrame:
    """``(doc_id, held_out, score, predicted, flagged)`` of every whole text.

    Only the text enters the score. ``predicted`` is 1 from 0.5 on; ``flagged`` asks the threshold of the document's
    ``lang``, or the common one where the language has none. Null text is empty text, which has a score too. Rows are
    scored one by one; ids may be null (held out or not by the crc32 of the empty string) or repeat.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores([t or "" for t in batch["text"].to_pylist()])
            common = model.thresholds.get("", 0.5)
            bars = np.array([model.thresholds.get(x or "", common) for x in batch["lang"].to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(scores, pa.float64()),
                 pa.array((scores >= 0.5).astype(np.int32)), pa.array(scores >= bars)],
                names=["doc_id", "held_out", "score", "predicted", "flagged"])

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold() == 0).alias("held_out"), "text", "lang")
    return rows.mapInArrow(score, RESULT)
