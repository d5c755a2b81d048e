"""Source divergence audit (operator 11): smoothed term shares of sources compared on run-length columns.

Terms are runs of letters (A-Z lower-cased) and characters beyond ASCII.  A language keeps the terms of at least
``min_docs`` of its documents, V of them.  With N occurrences of kept terms in a (lang, source) group or a language, a kept
term of count c has the share p = 1 + floor(1e9 (c + 1) / (N + V)); two shares differ by floor((p - q)^2 / q).

Method.  Kept terms with the same counts in all sources are one *pattern*; patterns are ordered by their counts, first
source first, so that equal counts of a column stand together, and cut into blocks.  Inside a block every source's
column is a list of runs (first position, count).  A pair of sources is compared on the union of their run boundaries,
once per stretch, times the stretch's number of terms; blocks are added up.  No column is ever whole in one place.

Arithmetic is exact: integers of 64 bits, wider ones where a count passes 9e9.

Defined results: null text, lang and source are ''; repeated rows are documents of their own; a group or language
without terms has V or N of 0 and differences of 0 to the sources of a language without kept terms; a language with one
source has no ``pair`` rows; ties go by UTF-8 order of the item; an empty table gives no rows.  Other columns are ignored.
A text is split whole; memory is about 40 bytes a byte of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .textvec import Words, slices

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
BLOCK = 4096  # patterns of a block
WAITING = 1 << 20  # rows of a task's counts that wait to be added up
SALTS = 32  # parts into which a group's terms are dealt when its totals are joined to them

# Word bytes of [^\x00-\x40\x5B-\x60\x7B-\x7F]+ after lower-casing A-Z.
LETTERS = np.zeros(256, bool)
LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


def _slice_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term) of a slice of texts."""
    for batch in batches:
        for low, high in slices(batch["text"], 1 << 20):
            part = batch.slice(low, high - low)
            words = Words(part["text"], LETTERS, lower=True)
            if not len(words.start):
                continue
            coded = words.strings(np.arange(len(words.start))).dictionary_encode()
            term, n_terms = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
            lang, source = (pc.dictionary_encode(part[c]) for c in ("lang", "source"))
            width = len(source.dictionary)
            group = lang.indices.to_numpy().astype(np.int64) * width + source.indices.to_numpy()
            key, total = np.unique(group[words.doc] * n_terms + term, return_counts=True)
            once = np.unique(words.doc * n_terms + term)
            docs = np.unique(group[once // n_terms] * n_terms + once % n_terms, return_counts=True)[1]
            owner = key // n_terms
            yield pa.RecordBatch.from_arrays(
                [
                    lang.dictionary.take(pa.array(owner // width)),
                    source.dictionary.take(pa.array(owner % width)),
                    coded.dictionary.take(pa.array(key % n_terms)).cast(pa.string()),
                    pa.array(total),
                    pa.array(docs),
                ],
                names=["lang", "source", "term", "count", "docs"],
            )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term), added up over as many slices as ``WAITING`` rows hold."""

    def added(parts: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(parts)
        sums = table.group_by(["lang", "source", "term"], use_threads=False).aggregate([("count", "sum"), ("docs", "sum")])
        return sums.select(["lang", "source", "term", "count_sum", "docs_sum"]).rename_columns(table.column_names)

    waiting, n = [], 0
    for part in _slice_counts(batches):
        waiting.append(part)
        n += len(part)
        if n >= WAITING:
            table = added(waiting)
            waiting, n = table.to_batches(), len(table)
            if n >= WAITING // 2:
                yield from table.to_batches(max_chunksize=1 << 16)
                waiting, n = [], 0
    if waiting:
        yield from added(waiting).to_batches(max_chunksize=1 << 16)


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 1) / total)`` for ``total`` = N + V."""
    if len(counts) and int(counts.max()) >= (1 << 63) // SCALE - 1:
        return np.array([1 + SCALE * (int(c) + 1) // total for c in counts], np.int64)
    return 1 + SCALE * (counts.astype(np.int64) + 1) // total


def _starts(first: np.ndarray, n: int) -> np.ndarray:
    """Where runs start, as flags."""
    flags = np.zeros(n, bool)
    flags[first] = True
    return flags


def _compare(key, patterns: pa.Table, groups: pa.Table) -> pa.Table:
    """Ordered pairs of sources with their differences summed over the terms of a block."""
    out = {"lang": [], "source": [], "item": [], "value": []}
    if len(patterns) and len(groups) > 1:
        lang = groups["of_lang"][0].as_py()
        order = pc.sort_indices(groups["source"].combine_chunks())
        names = groups["source"].take(order).to_pylist()
        totals = [n + v for n, v in zip(groups["n"].take(order).to_pylist(), groups["v"].take(order).to_pylist())]
        lists = patterns["pattern"].combine_chunks()
        entry = lists.flatten()
        place, counts = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()), entry.field("count").to_numpy()
        owner = pc.index_in(entry.field("source"), value_set=pa.array(names, pa.string())).to_numpy()
        by_source = np.argsort(owner, kind="stable")
        parts = np.split(by_source, np.searchsorted(owner[by_source], np.arange(1, len(names))))

        def column(part: np.ndarray) -> np.ndarray:
            values = np.zeros(len(lists), np.int64)
            values[place[part]] = counts[part]
            return values

        rows = np.arange(len(lists))
        for part in reversed(parts):
            rows = rows[np.argsort(column(part)[rows], kind="stable")]
        upto = np.concatenate([[0], np.cumsum(patterns["n_terms"].to_numpy()[rows])])
        runs = []
        for part, total in zip(parts, totals):
            values = column(part)[rows]
            first = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
            runs.append((first, shares(values[first], total)))
        for a, (first_a, share_a) in enumerate(runs):
            starts_a = _starts(first_a, len(rows))
            run_a = np.cumsum(starts_a) - 1
            for b in range(a + 1, len(runs)):
                first_b, share_b = runs[b]
                starts_b = _starts(first_b, len(rows))
                cut = np.flatnonzero(starts_a | starts_b)
                p, q = share_a[run_a[cut]], share_b[(np.cumsum(starts_b) - 1)[cut]]
                length = np.diff(upto[np.append(cut, len(rows))])
                square = (p - q) * (p - q)
                for x, y, base in ((a, b, q), (b, a, p)):
                    out["lang"].append(lang)
                    out["source"].append(names[x])
                    out["item"].append(names[y])
                    out["value"].append(int(np.sum(square // base * length)))
    return pa.table(out, schema=pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())]))


def _share(count: str, total: str) -> str:
    """The share as SQL, in decimals of 38 digits: ``count`` times SCALE may not fit a long."""
    return f"1 + (cast({SCALE} as decimal(10,0)) * cast({count} + 1 as decimal(19,0))) div cast({total} as decimal(19,0))"


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Kept terms: ``(lang, term, total, pattern)``, pattern the counts by source in order of the source."""
    # Dealt by term once, for both groupings.
    found = (
        docs.mapInArrow(_count, "lang string, source string, term string, count long, docs long").repartition("lang", "term")
        .groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("count").alias("total"), F.sort_array(F.collect_list(F.struct("source", "count"))).alias("pattern"))
    )
    return found.where(F.col("docs") >= min_docs).select("lang", "term", "total", "pattern")


def audit(documents: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``; see the module's notes.

    Part ``pair`` compares a source with each other source of its language, over all kept terms; part ``term`` lists the
    ``top_terms`` terms whose share in the source is furthest above the language's.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = documents.select(text("lang"), text("source"), text("text"))
    terms = cut_lineage(term_counts(docs, min_docs), "terms")
    entries = terms.select("lang", "term", "total", F.explode("pattern").alias("e")).select("lang", "term", "total", "e.source", "e.count")

    languages = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    in_group = entries.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    zero = F.lit(0).cast("long")
    groups = cut_lineage(
        docs.select("lang", "source").distinct()
        .join(in_group, ["lang", "source"], "left").join(languages, "lang", "left")
        .select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("n", "v", "lang_n"))),
        "groups",
    )

    # Vocabulary in order of its counts, in blocks of about BLOCK patterns.
    patterns = cut_lineage(terms.groupBy("lang", "pattern").agg(F.count("*").alias("n_terms")), "patterns")
    parts = max(1, -(-patterns.count() // BLOCK))
    # Blocks go by the first counts, then by hash: whole patterns would make the sample of the ranges large.
    place = [F.col("lang"), F.slice("pattern", 1, 2), F.xxhash64("pattern")]
    blocks = cut_lineage(patterns.repartitionByRange(parts, *place).withColumn("block", F.spark_partition_id()), "blocks")
    columns = blocks.select("lang", "block").distinct().join(groups, "lang").select("lang", "block", "source", "n", "v").toDF("of_lang", "of_block", "source", "n", "v")
    sums = (
        blocks.groupBy("lang", "block").cogroup(columns.groupBy("of_lang", "of_block"))
        .applyInArrow(_compare, "lang string, source string, item string, value long")
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    )
    others = groups.select("lang", F.col("source").alias("item"))
    pairs = (
        groups.select("lang", "source").join(others, "lang").where(F.col("source") != F.col("item"))
        .join(sums, ["lang", "source", "item"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", zero).alias("value"))
    )

    # A hot group's terms are dealt over SALTS parts; what ranks too low in a part goes no further.
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    above = (
        entries.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int")).join(salted, ["lang", "source", "salt"])
        .select("lang", "source", "term", F.expr(_share("count", "n + v")).alias("p"), F.expr(_share("total", "lang_n + v")).alias("q"))
        .where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(above).where(F.col("rank") <= top_terms))


AUDIT_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
w AS (SELECT row_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM w GROUP BY ALL),
k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT row_id) >= 3),
l AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY ALL),
g AS (SELECT d.lang, d.source, coalesce(max(l.v), 0) AS v, coalesce(max(l.n), 0) AS lang_n, coalesce(max(t.n), 0) AS n
      FROM (SELECT DISTINCT lang, source FROM d) d LEFT JOIN l USING (lang)
      LEFT JOIN (SELECT c.lang, c.source, sum(c.c) AS n FROM c JOIN k USING (lang, term) GROUP BY ALL) t
        ON t.lang = d.lang AND t.source = d.source
      GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
             1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (g.n + g.v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (k.total + 1)) // (g.lang_n + g.v)::HUGEINT AS lang_p
      FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - lang_p) * (p - lang_p) // lang_p FROM p WHERE c > 0 AND p > lang_p),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM o WHERE part = 'pair' OR rank <= 200
"""
