"""Divergence of the sources of a language, by three-dimensional cube partitioning.

Terms are runs of letters, which are ASCII letters and all other characters
beyond ASCII; only A-Z are lower-cased. Each language keeps the terms that
enough of its documents hold. A group is one source of a language; a kept
term's share in a group, smoothed and scaled to an integer, is
``1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V))``.

* Term counts are summed inside each task before they are shuffled, so a hot
  source sends one row for a term and task.
* Groups and terms of a language are dealt to blocks by a hash and numbered
  within their block. A slice is the counts of a group block in a term block.
* Each cell (group block, group block, term block) is a task of its own: its
  two slices, replicated to the cells that need them, become dense matrices,
  and the cell gives the partial divergence of every pair of its groups.
* The partial divergences are summed along the term axis.

No task holds more than two slices and no pair of groups meets more than once
in a term block. The result's pairs grow with the square of a language's
sources, as the report lists them all.

Defined results: null text, language or source count as empty strings; a
document without terms still makes its group occur; repeated rows are counted
one by one; ties rank by name in UTF-8 order; a language without kept terms
has divergence 0 for each pair; a language of one source has no pairs; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import map_arrow, slices
from quarry.session import materialize, ship_package

MIN_DOCS = 30            # documents of a language that hold a kept term
SCALE = 1_000_000_000
SMOOTH = 5
TOP = 50                 # ranks of the terms that a group is known by
GROUP_BLOCK = 64         # groups in a block, about
TERM_BLOCK = 4096        # terms in a block, about
HELD = 400_000           # term counts that a task holds before it sends them on

LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text in order."""
    return text.translate(LETTERS).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group; the row
    without a term says that the group occurs."""
    names = ["lang", "source", "term", "n", "docs"]

    def run(batches):
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def emit():
            for (lang, source), (n, holding) in held.items():
                words = list(n)
                for at in range(0, len(words) + 1, HELD):
                    part = words[at:at + HELD]
                    some = [None, *part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some), pa.string()), pa.array([source] * len(some), pa.string()),
                         pa.array(some, pa.binary()).cast(pa.string()), pa.array([0, *map(n.__getitem__, part)], pa.int64()),
                         pa.array([0, *map(holding.__getitem__, part)], pa.int64())], names=names)
            held.clear()

        size = 0
        for b in slices(batches):
            texts = b.column(2).cast(pa.binary()).to_pylist()
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts):
                n, holding = held.setdefault((lang, source), (Counter(), Counter()))
                words, before = terms(text), len(n)
                n.update(words)
                holding.update(set(words))
                size += len(n) - before
            if size > HELD:
                yield from emit()
                size = 0
        yield from emit()

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    counted = map_arrow(docs.select(*text), run, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str, kept: str = "v") -> F.Column:
    """The scaled share of a count; null for a language without kept terms."""
    return F.expr(f"1 + {SCALE}BD * cast({n} + {SMOOTH} as decimal(20,0)) "
                  f"div nullif(cast({total} + {SMOOTH} * {kept} as decimal(20,0)), 0)").cast("bigint")


def _dealt(rows: DataFrame, name: str, sizes: DataFrame, blocks: str, block: str, place: str) -> DataFrame:
    """``rows`` of a language dealt to blocks by a hash of ``name`` and numbered from 0 within their block."""
    out = rows.join(sizes, "lang").withColumn(block, F.pmod(F.xxhash64(name), F.col(blocks)).cast("int"))
    return out.withColumn(place, F.row_number().over(Window.partitionBy("lang", block).orderBy(name)) - 1)


def _blocks(n: str, size: int) -> F.Column:
    return F.greatest(F.lit(1), F.ceil(F.col(n) / size)).cast("int")


class Tables:
    """What both parts are computed from: groups, kept terms, and the shares of terms in groups."""

    def __init__(self, docs: DataFrame, min_docs: int):
        counted = materialize(term_counts(docs), "term-counts")
        of_terms = counted.filter("term is not null")
        kept = materialize(of_terms.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                           .filter(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
        here = of_terms.join(kept, ["lang", "term"])
        totals = here.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = counted.filter("term is null").select("lang", "source").distinct() \
            .join(totals, ["lang", "source"], "left").fillna(0, ["total"])
        langs = groups.groupBy("lang").agg(F.count("*").alias("n_groups"), F.sum("total").alias("lang_total")) \
            .join(kept.groupBy("lang").agg(F.count("*").alias("v")), "lang", "left").fillna(0, ["v"]) \
            .withColumn("group_blocks", _blocks("n_groups", GROUP_BLOCK)) \
            .withColumn("term_blocks", _blocks("v", TERM_BLOCK))
        langs = materialize(langs, "langs")
        self.groups = materialize(
            _dealt(groups, "source", langs, "group_blocks", "g", "row")
            .withColumn("zero", F.coalesce(share("0", "total"), F.lit(0))), "groups")
        self.terms = materialize(
            _dealt(kept, "term", langs.select("lang", "v", "lang_total", "term_blocks"), "term_blocks", "t", "col")
            .withColumn("q", share("lang_n", "lang_total")).select("lang", "term", "q", "t", "col"), "terms")
        self.shares = materialize(
            of_terms.filter("n > 0").select("lang", "source", "term", "n").join(self.terms, ["lang", "term"])
            .join(self.groups.select("lang", "source", "total", "v", "g", "row"), ["lang", "source"])
            .withColumn("p", share("n", "total")).select("lang", "source", "term", "g", "row", "t", "col", "p", "q"),
            "shares")


def _slices(tables: Tables) -> DataFrame:
    """(lang, g, t, group_blocks, width, zeros, entries): each group block in each term block of its language."""
    blocks = tables.groups.groupBy("lang", "g", "group_blocks", "term_blocks") \
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("row", "zero"))), lambda x: x["zero"]).alias("zeros"))
    width = tables.terms.groupBy("lang", "t").agg(F.count("*").alias("width"))
    entries = tables.shares.groupBy("lang", "g", "t").agg(
        F.collect_list(F.struct("row", "col", "p")).alias("entries"))   # at most a block of groups by a block of terms
    return blocks.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1))) \
        .join(width, ["lang", "t"], "left").fillna(0, ["width"]).join(entries, ["lang", "g", "t"], "left") \
        .select("lang", "g", "t", "group_blocks", "width", "zeros", "entries")


def dense(zeros: np.ndarray, width: int, entries: pa.Array) -> np.ndarray:
    """Shares of a slice: a row for each group, a column for each term."""
    out = np.repeat(zeros[:, None], width, axis=1)
    if len(entries):
        row, col, p = (np.asarray(entries.field(k)) for k in ("row", "col", "p"))
        out[row, col] = p
    return out


def _partial(table: pa.Table) -> pa.Table:
    """Partial divergences of the pairs of a cell."""
    lang, i, j = (table[k][0].as_py() for k in ("lang", "i", "j"))
    made = {}
    for k in range(table.num_rows):
        listed = table["entries"].combine_chunks()[k]
        entries = listed.values if listed.is_valid else []
        made[table["g"][k].as_py()] = dense(np.array(table["zeros"][k].as_py(), np.int64), table["width"][k].as_py(), entries)
    first, second, value = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    none = np.zeros((0, table["width"][0].as_py()), np.int64)
    left, right = made.get(i, none), made.get(j, none)       # no group may fall in a block
    for a in range(len(left)):
        b = np.arange(a + 1 if i == j else 0, len(right))
        first.append(np.full(len(b), a))
        second.append(b)
        value.append(np.abs(right[b] - left[a]).sum(axis=1))
    n = sum(map(len, first))
    return pa.table({"lang": pa.array([lang] * n, pa.string()), "i": pa.array(np.full(n, i, np.int32)),
                     "a": pa.array(np.concatenate(first).astype(np.int32)), "j": pa.array(np.full(n, j, np.int32)),
                     "b": pa.array(np.concatenate(second).astype(np.int32)), "value": pa.array(np.concatenate(value))})


def pair_divergences(tables: Tables) -> DataFrame:
    """(lang, source, item, value): summed differences of each ordered pair of a language's sources."""
    other = F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1))
    dealt = _slices(tables).withColumn("other", other).select(
        "lang", F.least("g", "other").alias("i"), F.greatest("g", "other").alias("j"), "t", "g", "width", "zeros", "entries")
    ship_package()
    partial = dealt.groupBy("lang", "i", "j", "t").applyInArrow(
        _partial, "lang string, i int, a int, j int, b int, value bigint")
    summed = partial.groupBy("lang", "i", "a", "j", "b").agg(F.sum("value").alias("value"))
    name = lambda block, place, out: tables.groups.select(
        "lang", F.col("g").alias(block), F.col("row").alias(place), F.col("source").alias(out))
    named = materialize(summed.join(name("i", "a", "source"), ["lang", "i", "a"]).join(name("j", "b", "item"), ["lang", "j", "b"])
                        .select("lang", "source", "item", "value"), "pairs")
    return named.unionByName(named.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def characteristic_terms(tables: Tables) -> DataFrame:
    """(lang, source, item, value): terms whose share in the group is above their share in the language."""
    return tables.shares.filter("p > q").select("lang", "source", F.col("term").alias("item"),
                                                (F.col("p") - F.col("q")).alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """op13: (lang, source, part, item, value, rank) of every group of (text, lang, source)."""
    tables = Tables(docs, min_docs)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_divergences(tables).withColumn("part", F.lit("pair")).withColumn("rank", rank)
    named = characteristic_terms(tables).withColumn("part", F.lit("term")).withColumn("rank", rank) \
        .filter(F.col("rank") <= top)
    return pairs.unionByName(named).select("lang", "source", "part", "item", "value", "rank")


ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
words AS (
  SELECT rid, lang, source, translate(unnest(words), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM docs),
kept AS (
  SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang),
counts AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts c USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (g.total + 5 * l.v) AS p,
         1 + 1000000000::HUGEINT * (k.lang_n + 5) // (l.lang_total + 5 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c
    ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
divergence AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN divergence d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
