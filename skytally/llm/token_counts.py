"""Token counts that follow edits: a segment tree of pre-tokens per document."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from skytally.llm.encoding import PATH, PRE_TOKEN, Encoder, encoder

LEAF = 32  # pre-tokens of a leaf when the tree is built

_TREE = "n_tokens long, chars array<long>, tokens array<long>"


class CountTree:
    """Characters and tokens of consecutive leaves, with the sums of all subtrees (heap order, leaves last)."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.chars, self.tokens = chars, tokens
        self.leaves = len(chars) // 2

    @classmethod
    def of(cls, leaf_chars: list[int], leaf_tokens: list[int]) -> CountTree:
        leaves = 1
        while leaves < len(leaf_chars):
            leaves *= 2
        sums = []
        for values in (leaf_chars, leaf_tokens):
            heap = [0] * leaves + values + [0] * (leaves - len(values))
            for i in range(leaves - 1, 0, -1):
                heap[i] = heap[2 * i] + heap[2 * i + 1]
            sums.append(heap)
        return cls(*sums)

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf begins. Past the end: the last leaf with characters."""
        char = min(char, self.chars[1] - 1)
        node, begin = 1, 0
        while node < self.leaves:
            node *= 2
            if char - begin >= self.chars[node]:
                begin += self.chars[node]
                node += 1
        return node - self.leaves, begin

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        """Replace a leaf and update the sums above it."""
        node = leaf + self.leaves
        more = chars - self.chars[node], tokens - self.tokens[node]
        while node and more != (0, 0):
            self.chars[node] += more[0]
            self.tokens[node] += more[1]
            node //= 2


def _count(coder: Encoder, pre_tokens: list[str]) -> list[int]:
    known = coder.learn(set(pre_tokens))
    return [len(known[p]) // 4 for p in pre_tokens]


def _special(coder: Encoder, text: str) -> bool:
    return any(s in text for s in coder.special)


def build(coder: Encoder, text: str) -> CountTree:
    pieces = coder.pre_tokens(text)
    counts = ([1 if p in coder.special else n for p, n in zip(pieces, _count(coder, pieces))]
              if _special(coder, text) else _count(coder, pieces))
    starts = range(0, len(pieces), LEAF)
    return CountTree.of([sum(map(len, pieces[i : i + LEAF])) for i in starts],
                        [sum(counts[i : i + LEAF]) for i in starts])


def edit(coder: Encoder, tree: CountTree, text: str, start: int, end: int, new: str) -> tuple[CountTree, str, int]:
    """Replace ``text[start:end]`` by ``new``: the tree, the text, and how many pre-tokens were encoded again.

    A pre-token depends on its own characters and on few behind it. So encoding starts at the leaf before the one that
    the edit begins in, and stops at the first old leaf boundary behind the edit where a new pre-token also ends:
    from there on, everything is as it was.
    """
    start = max(0, min(start, len(text)))
    end = max(start, min(end, len(text)))
    after = text[:start] + new + text[end:]
    if not text or not after or _special(coder, after) or _special(coder, text):
        tree = build(coder, after)
        return tree, after, len(coder.pre_tokens(after))
    first, begin = tree.leaf_at(start)
    back = 0
    while begin and back < 2:  # leaves that edits have emptied are no context
        first, begin = tree.leaf_at(begin - 1)
        back += start - begin >= LEAF
    shift = len(new) - (end - start)
    last, last_end = first, begin + tree.chars[tree.leaves + first]
    fresh: list[str] = []
    at = begin
    for match in PRE_TOKEN.finditer(after, begin):
        fresh.append(match.group())
        at = match.end()
        while last_end + shift < at or last_end < end:
            if last + 1 >= tree.leaves:
                break
            last += 1
            last_end += tree.chars[tree.leaves + last]
        if at == last_end + shift and last_end >= end and at < len(after):
            break
    if at == len(after):
        last = tree.leaves - 1
    tree.put(first, sum(map(len, fresh)), sum(_count(coder, fresh)))
    for leaf in range(first + 1, last + 1):
        tree.put(leaf, 0, 0)
    return tree, after, len(fresh)


def count_tokens(documents: DataFrame, tokenizer: str = PATH) -> DataFrame:
    """Add ``n_tokens`` and the segment tree (``chars``, ``tokens``) of each whole text to ``documents``.

    The count is that of the library without special tokens around the text. Null text counts as empty and stays null.
    Columns named like the added ones are replaced. Rows are counted one by one, whatever their ids.
    """
    kept = [c for c in documents.columns if c not in ("n_tokens", "chars", "tokens")]
    rows = documents.select(*kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", " + _TREE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in batches:
            trees = [build(coder, t or "") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([t.tokens[1] for t in trees], pa.int64()),
                 pa.array([t.chars for t in trees], pa.list_(pa.int64())),
                 pa.array([t.tokens for t in trees], pa.list_(pa.int64()))],
                names=[*batch.schema.names, "n_tokens", "chars", "tokens"])

    return rows.mapInArrow(count, schema)


def recount_edited(counted: DataFrame, edits: str = "edits", tokenizer: str = PATH) -> DataFrame:
    """Apply the edits of each row of :func:`count_tokens` to its text, tree and count.

    ``edits`` is a column of arrays of (start, end, text): characters ``[start, end)`` of the text as the edits before
    left it are replaced. Places beyond the text are moved to its end; null edits, or null texts in them, change
    nothing or insert nothing. A text that holds a special token before or after an edit is counted as a whole. Adds
    ``n_reencoded``, the pre-tokens that were encoded again, and drops ``edits``.
    """
    rows = counted.withColumn(edits, counted[edits].cast("array<struct<start: long, end: long, text: string>>"))
    kept = [f for f in rows.schema if f.name not in (edits, "n_reencoded")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", n_reencoded long"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in batches:
            texts, trees, again = [], [], []
            columns = (batch[c].to_pylist() for c in ("text", "chars", "tokens", edits))
            for text, chars, tokens, changes in zip(*columns):
                tree, done = CountTree(chars, tokens), 0
                for change in changes or ():
                    if change is not None:
                        start, end = change["start"] or 0, change["end"] or 0
                        tree, text, n = edit(coder, tree, text or "", start, end, change["text"] or "")
                        done += n
                texts.append(text)
                trees.append(tree)
                again.append(done)
            new = {
                "text": pa.array(texts, pa.string()), "n_tokens": pa.array([t.tokens[1] for t in trees], pa.int64()),
                "chars": pa.array([t.chars for t in trees], pa.list_(pa.int64())),
                "tokens": pa.array([t.tokens for t in trees], pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_arrays(
                [*(new.get(f.name, batch[f.name] if f.name not in new else None) for f in kept),
                 pa.array(again, pa.int64())], names=[*(f.name for f in kept), "n_reencoded"])

    return rows.mapInArrow(apply, schema)
