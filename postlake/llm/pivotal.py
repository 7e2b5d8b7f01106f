"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is to be copied target / size times, at most
``max_copies``: the whole part is sure, the rest is a probability.  The
pivotal method pairs two documents of the source and moves word mass from
one to the other, at random but so that neither expectation changes, until
one probability is 0 or 1; the other meets the next document.  At first all
documents of a source have one probability, and a document can meet all that
follow it as one unit.  Word mass is conserved by every move.  The last open
document of a source is settled by distance to the target, in or out, and what
it then misses by is made up by documents of the last stream that fit.  So a
source's total misses its target by half the size of its last open document at
most, and by less than any document of that stream that could still come in.

Plan: documents fold to narrow rows first (id, hash, words).  They are dealt
by source and a hash cell of about ``stream_docs`` documents, so a source
with a third of all rows has that many more streams.  A stream takes large
documents first and keeps one open document, its smallest as a rule.  The
open documents of that many cells meet on the next level of a tree, down to
one stream a source, which closes it.  Draws are hashes of the document and the level, so reruns agree
whatever the partitions are.  Totals and targets are aggregates with one row
per source.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import WORD, mix64, numbered, parts, table, without, written

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
ADDED = ("size", "source_size", "target", "copies")


def targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, source_docs, target) from rows (source, size).

    Sources by code point, null last, weigh ``weights`` in turn and share
    the total of all sizes; a target stops at ``max_copies`` times its
    source's size and the excess is shared again by weight.  Taking sources
    by cap / weight upwards, the capped ones come first, so one running sum
    finds them.  One row per source.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(every) - 1) % len(weights) + 1).cast("int"))
    totals = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_docs"))
              .withColumn("w", w))
    totals = totals.withColumn("cap", F.col("source_size") * float(max_copies))
    up = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    whole = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    rate = left / F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing))
    rated = totals.withColumn("rate", rate).withColumn("free", F.col("rate") <= F.col("cap") / F.col("w"))
    level = F.first(F.when(F.col("free"), F.col("rate")), ignorenulls=True).over(whole)
    return rated.select("source", "source_size", "source_docs",
                        F.when(F.col("free"), F.least(F.col("w") * level, F.col("cap"))).otherwise(F.col("cap")).alias("target"))


def _settle(a: float, s: float, b: float, t: float, draw: float) -> tuple[float, float]:
    """Move mass between probability a of s words and b of t until one is integral."""
    up, down = min((1 - a) * s, b * t), min(a * s, (1 - b) * t)  # words that may go to a, and from a
    if draw * (up + down) < down:
        return (1.0, max(0.0, b - (1 - a) * s / t)) if (1 - a) * s <= b * t else (min(1.0, a + b * t / s), 0.0)
    return (0.0, min(1.0, b + a * s / t)) if a * s <= (1 - b) * t else (max(0.0, a - (1 - b) * t / s), 1.0)


def _at(row: tuple, p: float) -> tuple:
    return *row[:5], p, *row[6:]


def _against_rest(rows, draws):
    """Documents of one probability, each paired with all that follow it as one unit.

    The unit's documents share its probability.  Large documents come first,
    so what is left open is the smallest one, unless a document outweighs
    the rest.
    """
    rest = sum(r[4] for r in rows)
    p, out, held = rows[0][5], [], None
    for row, draw in zip(rows, draws, strict=True):
        rest -= row[4]
        if held is not None or p in (0.0, 1.0):
            out.append(_at(row, p))
        elif rest <= 0:
            held = _at(row, p)
        else:
            a, b = _settle(p, row[4], p, rest, draw)
            if 0 < a < 1:
                held, p = _at(row, a), b
            else:
                out.append(_at(row, a))
                p = b
    return out, held


def _one_by_one(rows, draws):
    """Documents of various probabilities; the open one meets the next."""
    out, held = [], None
    for row, draw in zip(rows, draws, strict=True):
        if held is None:
            held = row
            continue
        a, b = _settle(held[5], held[4], row[5], row[4], draw)
        done, held = (_at(row, b), _at(held, a)) if 0 < a < 1 else (_at(held, a), _at(row, b))
        out.append(done)
        if not 0 < held[5] < 1:
            out.append(held)
            held = None
    return out, held


def _close(out, held):
    """Take the last open document or leave it, whichever ends nearer to its mass.

    Left out, its mass goes to the largest documents left out that fit;
    taken, the words too many come off the largest documents taken that fit.
    """
    order = sorted(range(len(out)), key=lambda k: (-out[k][4], out[k][2]))

    def fill(gap, state):
        some = []
        for k in order:
            if out[k][5] == state and 0 < out[k][4] <= gap + 1e-6:
                some.append(k)
                gap -= out[k][4]
        return gap, some

    short, added = fill(held[5] * held[4], 0.0)
    over, dropped = fill((1 - held[5]) * held[4], 1.0)
    take = over < short
    turned = set(dropped if take else added)
    return [_at(row, 1.0 - row[5]) if k in turned else row for k, row in enumerate(out)] + [_at(held, float(take))]


def _round(level: int, seed: int):
    """Settle streams, rows sorted by (source, cell); all but one document of each end at 0 or 1.

    In a source's only stream all do.
    """
    names = ("source", "cell", "unit", "id", "words", "p", "cells")
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32())
    salt = (seed * 0x9E3779B97F4A7C15 + level * 0xBF58476D1CE4E5B9) % 2**64

    def draws(rows, salt):
        units = mix64(np.array([r[2] % 2**64 for r in rows], np.uint64) ^ np.uint64(salt))
        return ((units >> np.uint64(11)).astype(np.float64) / 2**53).tolist()

    def settled(rows):
        out, held = (_one_by_one if level else _against_rest)(rows, draws(rows, salt))
        if held is not None and rows[0][6] == 1 and 0 < held[5] < 1:
            out = _close(out, held)
        elif held is not None:
            out.append(held)
        return pa.record_batch({n: pa.array(list(c), k) for n, c, k in zip(names, zip(*out, strict=True), kinds, strict=True)})

    def run(batches):
        stream = []
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if stream and stream[0][:2] != row[:2]:
                    yield settled(stream)
                    stream = []
                stream.append(row)
        if stream:
            yield settled(stream)
    return run


_ROW = "source string, cell int, unit long, id long, words double, p double, cells int"


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        max_copies: int = MAX_COPIES, seed: int = 0, stream_docs: int = 1024) -> DataFrame:
    """``docs`` with size, source_size (long), target (double) and copies (int): how often the mix takes a row.

    Size is the number of words; targets are those of ``targets``.  Copies
    are 0 to ``max_copies``.  Their expectation is target / source_size but
    for the documents that close a source (see the module): its taken words
    miss its target by half its largest document at most (by half the summed
    size of equal rows, where rows repeat).

    Null or empty text: size 0, copies 0.  Null source: a source of its own,
    last.  Rows that agree in id, source and text are decided together, so a
    null id is no hot key.  Empty table: no rows.  Other columns may have any
    names; those of the added ones are replaced.
    """
    docs, given, named = numbered(without(docs, *ADDED), id_col, text_col, source_col)
    doc_id, text, name = map(F.col, named)
    key = {"id": doc_id.cast("long"), "source": name.cast("string"), "unit": F.xxhash64(F.lit(seed), doc_id, name, text),
           "size": F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")}
    narrow = written(docs.select(*[c.alias(n) for n, c in key.items()]), "sizes")
    goal = written(targets(narrow, weights, max_copies), "targets")
    units = (narrow.where("size > 0").groupBy("id", "source", "unit", "size").agg(F.count("*").alias("n"))
             .join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
             .withColumn("cells", F.ceil(F.col("source_docs") / stream_docs).cast("int"))
             .withColumn("each", F.least(F.col("target") / F.col("source_size"), F.lit(float(max_copies)))))
    whole = F.floor("each")
    units = written(units.select("id", "source", "unit", "cells", whole.alias("sure"), (F.col("each") - whole).alias("p"),
                                 (F.col("size") * F.col("n")).cast("double").alias("words")), "units")
    open_rows = units.where("p > 0").select("source", F.pmod(F.hash("unit"), F.col("cells")).alias("cell"), "unit", "id",
                                            "words", "p", "cells")
    decided = []
    level, width = 0, units.agg(F.max("cells")).first()[0] or 1
    while True:
        done = written(open_rows.repartition(parts(docs.sparkSession), "source", "cell")
                       .sortWithinPartitions("source", "cell", F.desc("words"), "unit", "id")
                       .mapInArrow(_round(level, seed), _ROW), f"pivot-{level}")
        decided.append(done.where("p = 1").select("id", "unit"))
        if width == 1:
            break
        width, level = math.ceil(width / stream_docs), level + 1
        open_rows = done.where("p > 0 AND p < 1").withColumns({"cell": (F.col("cell") / stream_docs).cast("int"),
                                                               "cells": F.ceil(F.col("cells") / stream_docs).cast("int")})
    taken = decided[0]
    for more in decided[1:]:
        taken = taken.unionByName(more)
    copies = (units.join(taken.withColumn("more", F.lit(1)).withColumnsRenamed({"id": "i", "unit": "u"}),
                         F.col("id").eqNullSafe(F.col("i")) & (F.col("unit") == F.col("u")), "left")
              .select(F.col("id").alias("_id"), F.col("unit").alias("_unit"),
                      (F.col("sure") + F.coalesce("more", F.lit(0))).cast("int").alias("copies")))
    rows = docs.withColumns({"_row_id": key["id"], "_row_unit": key["unit"], "_source": key["source"], "size": key["size"]})
    joined = (rows.join(copies, F.col("_row_id").eqNullSafe(F.col("_id")) & (F.col("_row_unit") == F.col("_unit")), "left")
              .join(goal.withColumnRenamed("source", "_goal"),
                    F.col("_source").eqNullSafe(F.col("_goal")), "left"))
    return joined.select(*given, "size", "source_size", "target",
                         F.coalesce("copies", F.lit(0)).alias("copies"))


def repeat(mixed: DataFrame) -> DataFrame:
    """Every row as often as ``copies`` says, without the added columns."""
    return (mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1))))).where("copies > 0")
            .drop("_copy", *ADDED))


def op2(spark, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
