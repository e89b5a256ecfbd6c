"""Secrets in whole texts, and how far their values are copied across owners."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skytally.plans.durable import durable

# Kind, pattern, and the group that holds the value.
_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]+"
_HEX = r"[0-9a-f]{24,}"  # runs are maximal, so shorter ones need not be matched first
_LEAST_ASSIGN, _LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex")

# A value that so many owners or so many repositories hold is a widely copied example.
COPIED_OWNERS, COPIED_REPOSITORIES = 3, 10
# Shorter values, and values of fewer different characters, are too plain for a credential.
LIVE_CHARS, LIVE_DISTINCT = 16, 8

_SPAN = "struct<start: int, end: int, kind: int, value_start: int, value_hash: binary, strong: boolean>"


_BLOCK_BITS = 6  # sums are run in blocks of 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running_sums(numbers: Column) -> Column:
    """The sum of an array of integers up to each of them.

    Sums of whole blocks come first, then those within a block, so a long array costs little more than its length.
    """
    def total(of: Column) -> Column:
        return F.aggregate(of, F.lit(0), lambda total, x: total + x)

    def summed(numbers: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.shiftright(F.size(numbers) - 1, _BLOCK_BITS))
        start = lambda block: F.shiftleft(block, _BLOCK_BITS) + 1
        before = F.aggregate(blocks, F.array(F.lit(0)), lambda sums, block: F.concat(sums, F.array(
            F.element_at(sums, -1) + total(F.slice(numbers, start(block), F.lit(1 << _BLOCK_BITS))))))
        return _let(before, lambda before: F.transform(numbers, lambda _, i: F.get(before, F.shiftright(i, _BLOCK_BITS)) + total(
            F.slice(numbers, start(F.shiftright(i, _BLOCK_BITS)), i % (1 << _BLOCK_BITS) + 1))))

    return _let(numbers, summed)


def _matches(kind: int, pattern: str, value: Column | None, least: int) -> Column:
    """The spans of a kind: leftmost matches, located by the lengths of the pieces between them.

    ``value`` is the array of the matches' values; null takes the whole match.
    """
    text = F.col("text")
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = whole if value is None else value
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    empty = F.array().cast(f"array<{_SPAN}>")
    found, secrets = F.col(f"_whole{kind}"), F.col(f"_values{kind}")
    indexes = F.sequence(F.lit(0), F.size(found) - 1)
    steps = F.transform(found, lambda match, i: F.length(match) + F.get(F.col(f"_pieces{kind}"), i))

    def span(end: Column, match: Column, secret: Column) -> Column:
        chars = F.array_size(F.array_distinct(F.split(secret, "")))
        return F.struct(
            (end - F.length(match)).alias("start"), end.alias("end"), F.lit(kind).alias("kind"),
            (end - F.length(secret)).alias("value_start"), F.unhex(F.sha2(secret, 256)).alias("value_hash"),
            ((F.length(secret) >= LIVE_CHARS) & (chars >= LIVE_DISTINCT)).alias("strong"))

    located = _let(_running_sums(steps), lambda ends: F.transform(
        indexes, lambda i: span(F.get(ends, i), F.get(found, i), F.get(secrets, i))))
    long_enough = F.filter(located, lambda s: s["end"] - s["value_start"] >= least)
    return whole, values, pieces, F.when(F.size(found) > 0, long_enough).otherwise(empty)


def _joined(spans: Column, names: Column) -> Column:
    parts = F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def _by_place(spans: Column) -> Column:
    """Spans by start, then kind."""
    return F.array_sort(spans, lambda a, b: F.when(
        (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["kind"] < b["kind"])), -1).when(
        (a["start"] == b["start"]) & (a["kind"] == b["kind"]), 0).otherwise(1))


def secret_spans(documents: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """``(doc_id, repository, owner, spans)``: the base spans of each text by start and kind. Built-in functions only."""
    rows = documents.select(
        "doc_id", repository.alias("repository"), owner.alias("owner"), F.coalesce("text", F.lit("")).alias("text"))
    groups = F.regexp_extract_all("text", F.lit(_ASSIGN), F.lit(2))
    kinds = [_matches(0, _ASSIGN, groups, _LEAST_ASSIGN), _matches(1, _ACCESS, None, _LEAST_ACCESS),
             _matches(2, _HEX, None, 0)]
    for k, (whole, *_) in enumerate(kinds):
        rows = rows.withColumn(f"_whole{k}", whole)
    none = F.array().cast("array<string>")
    for k, (_, values, pieces, _) in enumerate(kinds):
        held = F.size(f"_whole{k}") > 0  # texts without a match are not searched again
        rows = rows.withColumn(f"_values{k}", F.when(held, values).otherwise(none)).withColumn(
            f"_pieces{k}", F.when(held, pieces).otherwise(F.array().cast("array<int>")))
    spans = reduce(lambda a, b: F.concat(a, b), [k[3] for k in kinds])
    return rows.select("doc_id", "repository", "owner", _by_place(spans).alias("spans"))


def scan_secrets(
    documents: DataFrame,
    repository: Column | None = None,
    owner: Column | None = None,
    copied_owners: int = COPIED_OWNERS,
    copied_repositories: int = COPIED_REPOSITORIES,
) -> DataFrame:
    """Secret spans of each text, with the values that look live: strong and not copied among owners.

    Base spans are the leftmost non-overlapping matches of each kind (assign, access, hex) with the asked-for lengths,
    in code points, end exclusive. The SHA-256 of every candidate value is counted over the corpus by distinct
    repositories and distinct owners: a value that ``copied_owners`` owners or ``copied_repositories`` repositories hold
    is a copied example, a strong value of fewer is owner-specific and looks live, and adds a span ``live`` over the
    value. A value under several
    kinds counts as one. (hash, repository, owner) are made distinct before they are counted, so a value in a third
    of all texts is a few rows.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, and secrets: the spans as structs
    with the value's repositories, owners and class. ``repository`` defaults to the distinct text, so that exact copies of a
    document are one, and ``owner`` to ``source``; null ones are one repository and one owner.

    Null text: no spans. Rows with equal ids and rows that repeat are scanned one by one and get one row each. Other
    columns are ignored. An empty table gives an empty table.
    """
    source = F.col("source") if "source" in documents.columns else F.lit(None).cast("string")
    found = durable(secret_spans(
        documents, F.xxhash64("text").cast("string") if repository is None else repository, source if owner is None else owner,
    ).withColumn("row", F.monotonically_increasing_id()))
    candidates = durable(found.where(F.size("spans") > 0).select(
        "row", "repository", "owner", F.posexplode("spans").alias("at", "span")))
    held = candidates.select(
        F.col("span.value_hash").alias("value_hash"),
        F.coalesce("repository", F.lit("")).alias("repository"), F.coalesce("owner", F.lit("")).alias("owner")).distinct()
    owners = held.select("value_hash", "owner").distinct().groupBy("value_hash").agg(F.count(F.lit(1)).alias("owners"))
    repositories = held.select("value_hash", "repository").distinct().groupBy("value_hash").agg(
        F.count(F.lit(1)).alias("repositories"))
    spread = durable(owners.join(repositories, "value_hash"))
    rated = candidates.withColumn("value_hash", F.col("span.value_hash")).join(spread, "value_hash").select(
        "row", F.struct(
            "span.start", "span.end", "span.kind", "span.value_start", "repositories", "owners",
            F.when((F.col("owners") >= copied_owners) | (F.col("repositories") >= copied_repositories), "copied").when(F.col("span.strong"), "live").otherwise("weak")
            .alias("class")).alias("secret"))
    by_row = durable(rated.groupBy("row").agg(F.collect_list("secret").alias("secrets")))  # of one text
    rows = found.join(by_row, "row", "left").withColumn(
        "secrets", _by_place(F.coalesce("secrets", F.array().cast(by_row.schema["secrets"].dataType))))
    names = F.array(*map(F.lit, (*KINDS, "live")))
    live = _let(F.array_sort(F.transform(  # a value under several kinds is one span; equal ones are neighbours
        F.filter("secrets", lambda s: s["class"] == "live"),
        lambda s: F.struct(s["value_start"].alias("start"), s["end"].alias("end"), F.lit(3).alias("kind")))),
        lambda spans: F.filter(spans, lambda span, i: (i == 0) | (F.get(spans, i - 1) != span)))
    base = F.transform("secrets", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))

    def count(of: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == of)).cast("long").alias(f"n_{KINDS[of]}")

    return rows.select(
        "doc_id", count(0), count(1), count(2),
        F.sha2(_joined(base, names), 256).alias("base_sha256"),
        _joined(_by_place(F.concat(base, live)), names).alias("spans"),
        F.size(live).cast("long").alias("n_live"),
        F.size(F.filter("secrets", lambda s: s["class"] == "copied")).cast("long").alias("n_copied"),
        "secrets")


def secrets_sql(copied_owners: int = COPIED_OWNERS, copied_repositories: int = COPIED_REPOSITORIES) -> str:
    """DuckDB SQL for the rows of :func:`scan_secrets` over ``documents``, without the column ``secrets``."""
    any_case = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
                        for word in ("password", "passwd", "secret", "token", "api_?key"))
    assign = f"({any_case})" + _ASSIGN[_ASSIGN.index("))") + 2:]

    def matches(kind: int, pattern: str, group: int) -> str:
        quoted = "'" + pattern.replace("'", "''") + "'"
        return f"""SELECT doc_id, text, source, {kind} AS kind, unnest(range(len(regexp_extract_all(text, {quoted})))) AS i,
         unnest(regexp_extract_all(text, {quoted})) AS whole, unnest(regexp_extract_all(text, {quoted}, {group})) AS value,
         unnest(string_split_regex(text, {quoted})) AS piece FROM docs"""

    return f"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS source FROM documents),
    matches AS ({matches(0, assign, 2)} UNION ALL {matches(1, _ACCESS, 0)} UNION ALL {matches(2, _HEX, 0)}),
    ended AS (SELECT *, CAST(sum(length(piece) + length(whole)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS BIGINT) AS stop
     FROM matches WHERE whole IS NOT NULL),
    base AS (SELECT *, stop - length(whole) AS start FROM ended
     WHERE length(value) >= CASE kind WHEN 0 THEN {_LEAST_ASSIGN} WHEN 1 THEN {_LEAST_ACCESS} ELSE 0 END),
    spread AS (SELECT value, count(DISTINCT source) >= {copied_owners} OR count(DISTINCT text) >= {copied_repositories} AS copied
     FROM base GROUP BY value),
    rated AS (SELECT base.*, copied, NOT copied AND length(value) >= {LIVE_CHARS}
      AND len(list_distinct(string_split(value, ''))) >= {LIVE_DISTINCT} AS live FROM base JOIN spread USING (value)),
    spans AS (SELECT doc_id, kind, start, stop, copied FROM rated
     UNION ALL SELECT DISTINCT doc_id, 3, stop - length(value), stop, false FROM rated WHERE live),
    named AS (SELECT *, ['{"', '".join((*KINDS, "live"))}'][kind + 1] || ':' || start || ':' || stop AS name FROM spans),
    per_doc AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
      count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (kind = 3) AS n_live, count(*) FILTER (copied) AS n_copied,
      string_agg(name, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(name, ',' ORDER BY start, kind, stop) AS spans
     FROM named GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
     sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
     coalesce(n_copied, 0) AS n_copied FROM docs LEFT JOIN per_doc USING (doc_id)"""
