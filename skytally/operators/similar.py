"""The most similar movies of every movie: an exact top-k self-join of sparse rating vectors with pruning bounds.

All pairs of movies that share a rater would be as many rows as the sum of the squares of all users' ratings. Here
users are ordered by how many movies they rated, in levels of powers of two, rarest first:

* Users of at most ``light`` ratings are joined outright: at most ``light`` sums for each rating. Movies are cut into
  blocks, ranges of ids; every block gets the vectors of the users that rated something in it, sums its pairs up there,
  movie by movie, and hands on only those that can still be among the best: the sums of all pairs are never stored.
  A movie whose raters' vectors alone fill a block is joined row by row.
* A vector goes to as many blocks as it has movies in, at most ``light``. Blocks are taken in rounds, so that what is on
  its way to them is never more than ``ROUND`` times the vectors; a round's exchange is removed before the next.
* What they find, and the largest weights of the heavy users, bound the k-th best score of each movie from below.
* A movie looks through heavy users, rarest first, only as long as the norm of its weights on the others could reach
  that bound (by Cauchy and Schwarz the rest of any pair is no more than the product of both rests).
* Pairs whose sum so far and both rests still reach the bound are completed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from skytally.plans.durable import stored
from skytally.plans.joins import fits_broadcast, lookup_join, restrict_to
from skytally.plans.ranking import top_k_per_group

LIGHT = 512
PER_BLOCK = 8_000_000  # entries of light users' vectors that the movies of a block ask for
AT_ONCE = 1_000_000  # of them summed up together, or those of one movie
ROUND, LEAST_ROUND = 8, 32_000_000  # entries sent to blocks in a round: a multiple of all, or this many
ROWS_PER_VECTORS = 500_000  # ratings that a task makes vectors of
LEVELS = 64  # the level of a user is the number of bits of its count of ratings
ROWS_PER_CHUNK = 4096  # of one heavy user's ratings that meet in a join key
SLACK = 2e-9  # bounds are compared with this much room, more than rounding of sums and of the result


class Parts(NamedTuple):
    norms: DataFrame  # (movie_id, squares)
    vectors: DataFrame  # (user_id, entries) of the light users
    few: DataFrame  # their ratings
    heavy: DataFrame  # the others'


def _weighted(ratings: DataFrame, light: int = LIGHT) -> tuple[DataFrame, Parts]:
    """``(user_id, movie_id, rating, degree, level, squares, weight)`` of the users with several ratings; their parts.

    The weight is the rating by the norm of all ratings of the movie. A user of one rating joins no two movies. Light
    users are exchanged once, to become vectors; their rows are read off these.
    """
    own = stored(
        ratings.where("rating > 0").select("user_id", "movie_id", F.col("rating").cast("bigint").alias("rating")), free=True)
    total = own.count()
    raters = stored(own.groupBy("movie_id").agg(
        F.sum(F.col("rating") * F.col("rating")).alias("squares"), F.count(F.lit(1)).alias("count")), free=True)
    norms = raters.drop("count")
    known = own.where("user_id IS NOT NULL")
    degrees = stored(known.groupBy("user_id").agg(F.count(F.lit(1)).alias("degree")), free=True)
    many = degrees.where((F.col("degree") > light) & (F.col("degree") > 1))
    if fits_broadcast(many):
        theirs = known.join(F.broadcast(many), "user_id")
    else:
        theirs = lookup_join(known, many, "user_id", total, counts=degrees.withColumnRenamed("degree", "count"))
    columns = ["user_id", "movie_id", "rating", "degree", "squares"]
    measures = {"level": F.length(F.bin("degree")), "weight": F.col("rating") / F.sqrt("squares")}
    heavy = stored(lookup_join(theirs, norms, "movie_id", total, counts=raters).select(columns), free=True).withColumns(measures)
    others = lookup_join(restrict_to(known, many, ["user_id"], anti=True), _held(norms, heavy), "movie_id", total, counts=raters)
    tasks = max(own.sparkSession.sparkContext.defaultParallelism, -(-total // ROWS_PER_VECTORS))
    vectors = stored(_vectors(others.repartition(tasks, "user_id")).where(F.size("entries") > 1), free=True)
    entries = vectors.select("user_id", F.size("entries").cast("bigint").alias("degree"), F.explode("entries").alias("_entry"))
    movie = F.col("_entry.movie_id").cast(own.schema["movie_id"].dataType).alias("movie_id")
    few = entries.select("user_id", movie, "_entry.rating", "degree", "_entry.squares").withColumns(measures)
    return few.unionByName(heavy), Parts(norms, vectors, few, heavy)


def _held(movies: DataFrame, heavy: DataFrame) -> DataFrame:
    """Rows of movies with ``held``: the squared norm of the movie's weights on the heavy users, if there are any."""
    if heavy.isEmpty():
        return movies
    parts = heavy.groupBy("movie_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("held"))
    return lookup_join(movies, parts, "movie_id", how="left").withColumn("held", F.coalesce("held", F.lit(0.0)))


def _vectors(rows: DataFrame) -> DataFrame:
    """``(user_id, entries)``: the ratings of each user in order of their movies."""
    held = F.col("held") if "held" in rows.columns else F.lit(0.0)
    entry = F.struct(F.col("movie_id").cast("bigint").alias("movie_id"), "rating", "squares", held.alias("held"))
    return rows.groupBy("user_id").agg(F.sort_array(F.collect_list(entry)).alias("entries"))


def _rests(heavy: DataFrame) -> DataFrame:
    """``(movie_id, rests)``: for each level, the squared norm of the weights on heavy users of higher levels."""
    parts = heavy.groupBy("movie_id", "level").agg(F.sum(F.col("weight") * F.col("weight")).alias("part"))
    held = parts.groupBy("movie_id").agg(F.collect_list(F.struct("level", "part")).alias("_parts"))  # LEVELS at most
    above = lambda level: F.aggregate(
        F.filter("_parts", lambda p: p["level"] > level), F.lit(0.0), lambda total, p: total + p["part"])
    return held.select("movie_id", F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), above).alias("rests"))


def _pair_sums(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """``(movie_id, other_id, dot, part)``: sums over the users that both movies of a pair share here."""
    other = right.select(*on, F.col("movie_id").alias("other_id"), F.col("rating").alias("_r"), F.col("weight").alias("_w"))
    return left.join(other, on).where("movie_id <> other_id").groupBy("movie_id", "other_id").agg(
        F.sum(F.col("rating") * F.col("_r")).alias("dot"), F.sum(F.col("weight") * F.col("_w")).alias("part"))


def _bounds(near: DataFrame, heavy: DataFrame, k: int) -> DataFrame:
    """``(movie_id, bound)``: no more than the k-th best score of the movie.

    The k-th best of the sums found so far, as ratings are positive; and for each heavy user the movie's weight times
    the (k+1)-th largest weight, which k other movies reach.
    """
    found = top_k_per_group(near, ["movie_id"], k, F.desc("part")).where(F.col("rank") == k).select("movie_id", "part")
    champion = top_k_per_group(heavy, ["user_id"], k + 1, F.desc("weight")).where(F.col("rank") == k + 1)
    reached = lookup_join(heavy, champion.select("user_id", F.col("weight").alias("_w")), "user_id").select(
        "movie_id", (F.col("weight") * F.col("_w")).alias("part"))
    return found.unionByName(reached).groupBy("movie_id").agg((F.max("part") - SLACK).alias("bound"))


def _packed(values: np.ndarray) -> bytes:
    """Values from 0 in the fewest bytes each, behind that number; all lowest bytes first, as the higher ones compress."""
    size = np.min_scalar_type(int(values.max(initial=0))).itemsize
    return bytes([size]) + values.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T.tobytes()


def _unpacked(texts: list[bytes]) -> np.ndarray:
    """The values of all texts, in as many bytes each as the largest needs."""
    planes = [(t[0], np.frombuffer(t, np.uint8, offset=1).reshape(t[0], -1)) for t in texts]
    return np.concatenate([np.ascontiguousarray(p.T).view(f"<u{size}").ravel() for size, p in planes])


_ROUTED = "block int, sizes binary, firsts binary, steps binary, ratings binary, squares binary, held binary"
_ASKED = "block int, entries long"


def _spread(index: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The positions of the entries of the listed vectors, one after the other."""
    chosen = sizes[index]
    return np.repeat(starts[index] - (np.cumsum(chosen) - chosen), chosen) + np.arange(chosen.sum())


def _blocks_of(ids: np.ndarray, sizes: np.ndarray, lows: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each block that a vector has movies in, and the vector, in order of blocks.

    ``lows`` are the blocks' smallest movie ids, ``apart`` the movies that are in no block.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    asks = ~np.isin(ids, apart)
    blocks, users = np.searchsorted(lows, ids[asks], "right") - 1, owner[asks]
    new = np.ones(len(users), bool)  # a vector is in order of its movies
    new[1:] = (blocks[1:] != blocks[:-1]) | (users[1:] != users[:-1])
    blocks, users = blocks[new], users[new]
    order = np.argsort(blocks, kind="stable")
    return blocks[order], users[order]


def _sizes(entries: pa.ListArray) -> np.ndarray:
    return entries.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _ask(lows: np.ndarray, apart: np.ndarray):
    """How many entries go to each block; those of all vectors as block -1."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = _sizes(batch["entries"])
            blocks, users = _blocks_of(batch["entries"].flatten().field(0).to_numpy(), sizes, lows, apart)
            sums = np.bincount(blocks, sizes[users], len(lows)).astype(np.int64)
            found = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[-1, found], pa.int32()), pa.array(np.r_[sizes.sum(), sums[found]], pa.int64())],
                names=["block", "entries"])
    return ask


def _route(lows: np.ndarray, apart: np.ndarray, low: int, high: int):
    """Send each vector to those blocks from ``low`` to ``high`` - 1 that it has movies in.

    The vectors of a batch and block are one row. What is known of a movie is in a row once, in order of movies.
    """
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = batch["entries"].flatten()
            ids, ratings, squares, held = (entries.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            sizes = _sizes(batch["entries"])
            starts = np.cumsum(sizes) - sizes
            blocks, users = _blocks_of(ids, sizes, lows, apart)
            mine = slice(*np.searchsorted(blocks, [low, high]))
            blocks, users = blocks[mine], users[mine]
            movies, first, code = np.unique(ids, return_index=True, return_inverse=True)
            squares, held = squares[first], held[first]
            steps = np.diff(ids, prepend=ids[:1])
            steps[starts] = 0
            ends = np.flatnonzero(np.diff(blocks, append=-1)) + 1
            out: list[tuple] = []
            for begin, end in zip(np.r_[0, ends[:-1]], ends):
                mine = users[begin:end]
                at = _spread(mine, sizes, starts)
                there = np.zeros(len(movies), bool)
                there[code[at]] = True
                out.append((int(blocks[begin]), _packed(sizes[mine]), ids[starts[mine]].tobytes(), _packed(steps[at]),
                            _packed(ratings[at]), _packed(squares[there]), held[there].tobytes() if held.any() else b""))
            names = [field.split()[0] for field in _ROUTED.split(", ")]
            columns = list(zip(*out)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names=names)
    return route


def _best_of_block(lows: np.ndarray, apart: np.ndarray, k: int):
    """Sum the pairs of a block's movies up, and keep those that may be among the ``k`` best of their movie.

    What heavy users can add to a pair is no more than the product of both norms on them. Where they add nothing, of
    pairs of equal scores those of the ``k`` smallest ids are enough.
    """
    def best(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        sizes = _unpacked(table["sizes"].to_pylist()).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        firsts = np.frombuffer(b"".join(table["firsts"].to_pylist()), np.int64)
        ids = np.cumsum(_unpacked(table["steps"].to_pylist()), dtype=np.int64)
        ids += np.repeat(firsts - ids[starts], sizes)
        ratings = _unpacked(table["ratings"].to_pylist())
        movies, code = np.unique(ids, return_inverse=True)
        code = code.astype(np.int32)
        del ids
        norms, heavy = np.zeros(len(movies)), np.zeros(len(movies))
        end = 0
        for text, squares, held in zip(*(table[name].to_pylist() for name in ("ratings", "squares", "held"))):
            begin, end = end, end + (len(text) - 1) // text[0]
            there = np.zeros(len(movies), bool)
            there[code[begin:end]] = True
            norms[there] = np.sqrt(_unpacked([squares]), dtype=float)
            if held:  # a batch without any says nothing of it
                heavy[there] = np.sqrt(np.frombuffer(held))
        inside = movies >= lows[block]
        if block + 1 < len(lows):
            inside &= movies < lows[block + 1]
        mine = np.flatnonzero((inside & ~np.isin(movies, apart))[code])
        mine = mine[np.argsort(code[mine], kind="stable")]
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[mine]
        asked = sizes[owner]
        changes = np.flatnonzero(np.diff(code[mine], prepend=-1))
        load = np.add.reduceat(asked, changes)
        group = (np.cumsum(load) - load) // AT_ONCE
        cuts = changes[np.flatnonzero(np.diff(group, prepend=-1))]
        found = []
        for begin, end in zip(cuts, np.r_[cuts[1:], len(mine)]):
            chunk, theirs = mine[begin:end], owner[begin:end]
            at = _spread(theirs, sizes, starts)
            times = sizes[theirs]
            left = np.repeat(code[chunk], times)
            keep = left != code[at]
            key = (left.astype(np.int64) * len(movies) + code[at])[keep]
            if not len(key):
                continue
            product = (np.repeat(ratings[chunk].astype(np.int64), times) * ratings[at].astype(np.int64))[keep]
            order = np.argsort(key)
            key = key[order]
            runs = np.flatnonzero(np.diff(key, prepend=-1))
            dot, (a, b) = np.add.reduceat(product[order], runs), np.divmod(key[runs], len(movies))
            part = dot / (norms[a] * norms[b])
            order = np.lexsort((b, -part, a))
            a, b, dot, part = a[order], b[order], dot[order], part[order]
            place = np.arange(len(a))
            head = np.flatnonzero(np.diff(a, prepend=-1))
            count = np.diff(head, append=len(a))
            kth = np.where(count >= k, part[np.minimum(head + k - 1, len(a) - 1)], -np.inf)
            equal = np.flatnonzero(np.diff(a, prepend=-1).astype(bool) | np.diff(part, prepend=-1.0).astype(bool))
            within = place - np.repeat(equal, np.diff(equal, append=len(a)))
            stay = (part + heavy[a] * heavy[b] >= np.repeat(kth, count) - SLACK) & ((heavy[a] > 0) | (within < k))
            found.append((movies[a[stay]], movies[b[stay]], dot[stay], part[stay]))
        names = ["movie_id", "other_id", "dot", "part"]
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 3 + [np.empty(0)]
        return pa.table(columns, names=names)
    return best


def _near(few: DataFrame, heavy: DataFrame, k: int, vectors: DataFrame | None = None) -> DataFrame:
    """The pairs of the light users, as of :func:`_pair_sums`, without those that cannot be among the ``k`` best.

    ``vectors`` are those of the light users, where they are stored.
    """
    kind = few.schema["movie_id"].dataType
    vectors = _vectors(_held(few, heavy)) if vectors is None else vectors
    loads = few.groupBy("movie_id").agg(F.sum("degree").alias("load"))
    placed = stored(loads.orderBy("movie_id").withColumn("_part", F.spark_partition_id()), free=True)
    inside = placed.where(F.col("load") <= PER_BLOCK)
    within = Window.partitionBy("_part").orderBy("movie_id").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = inside.groupBy("_part").agg(F.sum("load").alias("_size")).select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    summed = inside.withColumn("_within", F.coalesce(F.sum("load").over(within), F.lit(0))).join(F.broadcast(offsets), "_part")
    # Where there are few, smaller blocks occupy all cores.
    cores = few.sparkSession.sparkContext.defaultParallelism
    load = inside.agg(F.sum("load").alias("load")).first().load or 0
    block = F.floor((F.col("_before") + F.col("_within")) / max(PER_BLOCK // 4, min(PER_BLOCK, load // cores)))
    # One row a block, and the movies that are as large as one, come to the driver.
    lows = np.array(sorted(r.low for r in summed.groupBy(block.alias("block")).agg(F.min("movie_id").alias("low")).collect()), np.int64)
    large = placed.where(F.col("load") > PER_BLOCK).select("movie_id")
    apart = np.array(sorted(r.movie_id for r in large.collect()), np.int64)
    found = []
    if len(apart) or not len(lows):
        found.append(stored(_pair_sums(few.join(F.broadcast(large), "movie_id"), few, ["user_id"]), free=True))
    entries = vectors.select("entries")
    asked = {r.block: r.entries for r in entries.mapInArrow(_ask(lows, apart), _ASKED).groupBy("block").agg(
        F.sum("entries").alias("entries")).collect()} if len(lows) else {}
    sent = np.cumsum([asked.get(i, 0) for i in range(len(lows))])
    rounds = sent // max(LEAST_ROUND, ROUND * asked.get(-1, 0))
    for number in np.unique(rounds):
        low, high = (int(i) for i in np.searchsorted(rounds, [number, number + 1]))
        routed = entries.mapInArrow(_route(lows, apart, low, high), _ROUTED).repartition(high - low, "block")
        best = routed.groupBy("block").applyInArrow(
            _best_of_block(lows, apart, k), "movie_id long, other_id long, dot long, part double")
        found.append(stored(best.withColumns({n: F.col(n).cast(kind) for n in ("movie_id", "other_id")}), free=True))
    return reduce(DataFrame.unionByName, found)


def candidate_pairs(ratings: DataFrame, k: int, light: int = LIGHT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The pairs that may be among the k best of their ``movie_id``, with what is summed up of them; heavy rows; facts."""
    _, (norms, vectors, few, heavy) = _weighted(ratings, light)
    near = _near(few, heavy, k, vectors)
    if heavy.isEmpty():  # all sums are whole, and nobody is to be looked through
        facts = norms.withColumns({"bound": F.lit(0.0), "cut": F.lit(0)})
        theirs = norms.select(F.col("movie_id").alias("other_id"), F.col("squares").alias("_squares"))
        whole = near.join(norms, "movie_id").join(theirs, "other_id").withColumns({"cut": F.lit(0), "rest": F.lit(0.0)})
        return whole.select("movie_id", "other_id", "dot", "squares", "_squares", "cut", "rest"), heavy, facts
    bound = F.coalesce("bound", F.lit(0.0))
    enough = F.array_position(F.transform("rests", lambda rest: F.sqrt(rest) < F.col("bound")), True)
    known = norms.join(_rests(heavy), "movie_id", "left").join(_bounds(near, heavy, k), "movie_id", "left")
    # A movie without heavy raters has no rests, and looks through nobody.
    facts = stored(known.withColumn("bound", bound).withColumn(
        "cut", F.when(F.col("bound") > 0, F.coalesce(enough - 1, F.lit(0))).otherwise(F.lit(LEVELS)).cast("int")), free=True)

    # A heavy user's ratings are dealt into chunks; each movie that looks through the user asks every chunk.
    chunks = F.ceil(F.col("degree") / ROWS_PER_CHUNK).cast("int")
    index = heavy.withColumn("_chunk", F.pmod(F.xxhash64("movie_id"), chunks).cast("int"))
    asking = heavy.join(facts.select("movie_id", "cut"), "movie_id").where("level <= cut").drop("cut").withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    far = _pair_sums(asking, index, ["user_id", "_chunk"])
    summed = stored(near.unionByName(far).groupBy("movie_id", "other_id").agg(
        F.sum("dot").alias("dot"), F.sum("part").alias("part")), free=True)

    own = facts.select("movie_id", "squares", "rests", "bound", "cut")
    others = facts.select(F.col("movie_id").alias("other_id"), F.col("squares").alias("_squares"), F.col("rests").alias("_rests"))
    rest = F.sqrt(F.coalesce(F.get("rests", F.col("cut")) * F.get("_rests", F.col("cut")), F.lit(0.0)))
    paired = summed.join(own, "movie_id").join(others, "other_id").withColumn("rest", rest)
    open_ = paired.where(F.col("part") + F.col("rest") >= F.col("bound"))
    return open_.select("movie_id", "other_id", "dot", "squares", "_squares", "cut", "rest"), heavy, facts


def similar_movies(ratings: DataFrame, k: int = 10, digits: int = 9, light: int = LIGHT) -> DataFrame:
    """``(movie_id, rank, other_id, score)``: the ``k`` movies of highest cosine similarity to each movie.

    ``ratings`` has one row per user and movie with a rating above 0 (others do not count); unrated is 0. Ties go to the
    smaller id, after rounding to ``digits``. A movie without any common rater with others has no row, and one with
    fewer such others than ``k`` has fewer rows.
    """
    pairs, heavy, facts = candidate_pairs(ratings, k, max(light, k + 1))
    dot = F.col("dot")
    if not heavy.isEmpty():
        # Heavy users above the cut were not looked through; what is left of the pairs that stay is added now.
        pairs = stored(pairs, free=True)
        tail = heavy.join(facts.select("movie_id", "cut"), "movie_id").where("level > cut").select("movie_id", "user_id", "rating")
        unfinished = pairs.where("rest > 0").select("movie_id", "other_id")
        theirs = heavy.select(F.col("movie_id").alias("other_id"), "user_id", F.col("rating").alias("_r"))
        more = unfinished.join(tail, "movie_id").join(theirs, ["other_id", "user_id"]).groupBy("movie_id", "other_id").agg(
            F.sum(F.col("rating") * F.col("_r")).alias("_more"))
        pairs, dot = pairs.join(more, ["movie_id", "other_id"], "left"), dot + F.coalesce("_more", F.lit(0))
    score = F.round(dot / (F.sqrt("squares") * F.sqrt("_squares")), digits)
    scored = pairs.select("movie_id", "other_id", score.alias("score"))
    return top_k_per_group(scored, ["movie_id"], k, F.desc("score"), F.asc("other_id")).select(
        "movie_id", "rank", "other_id", "score")
