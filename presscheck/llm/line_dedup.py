"""Removal of runs of lines that an earlier document, or an earlier place, has too.

Winnowing: of every window of ``RUN`` lines the line of the smallest hash (the last of equals)
is selected as its fingerprint, and only selected lines are stored, once each, with the hashes
of the lines around them. A repeated run of ``RUN`` lines holds a whole window, so the same line
of it is selected in both places. Selected lines are joined on their hash; those that occur
once drop out. From each of the others the match is extended up and down over the lines
around it: every run through it that is long enough is known by 128 bits of the hashes of its lines, and all but its first
place are matches. Matches that overlap or adjoin grow into one run, and the runs so found are
deleted.

A line of ``LONG`` bytes or more is a run by itself, and so are one line or fewer than ``RUN``
lines with ``WORDS`` words or more in all; such windows select a line as well. Words end at
white space. Runs of lines that all are runs by themselves are left out, as their lines match
whenever they do.

Order is that of the key, then of the line. Windows are judged on the input, so what is
deleted in one place still counts for another. Null and empty texts have one empty line
and keep it; a null text stays null. Rows with the same key are one document, of which
none is the later. Rows with a null key come first and keep their lines. Other columns
pass through. DataFrame operations only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from presscheck.llm.tables import free_name, materialise
from presscheck.operators.once import compute_once

RUN = 3
LONG = 200
WORDS = 50
WORD = r"[^ \t-\r]+"


def _windows(lines: Column, run: int, long: int, words: int) -> Column:
    """An array with a struct for each run of ``run`` lines, and of fewer lines with enough bytes or words."""

    def window(start: Column, count: int) -> Column:
        own = [F.get(lines, start + i) for i in range(count)]
        # The smallest hash; of equals the last line, whose negative number is smallest.
        least = F.array_min(F.array(*[F.struct(x["a"].alias("hash"), (-(start + i)).alias("back")) for i, x in enumerate(own)]))
        return F.struct(
            start.alias("line"),
            F.lit(count).alias("lines"),
            F.xxhash64(F.lit(count), *[x["a"] for x in own]).alias("key1"),
            F.xxhash64(F.lit(count), *[x["b"] for x in own]).alias("key2"),
            (-least["back"]).alias("print_line"),
        )

    count = F.size(lines)

    def alone(x: Column) -> Column:
        return (x["bytes"] >= long) | (x["words"] >= words)

    def is_run(start: Column, size: int) -> Column:
        own = [F.get(lines, start + i) for i in range(size)]
        if size == 1:
            return alone(own[0]) if run > 1 else F.lit(True)
        apart = ~reduce(Column.__and__, map(alone, own))
        return apart if size == run else apart & (reduce(Column.__add__, [x["words"] for x in own]) >= words)

    def runs(size: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(count - size, F.lit(0)))
        return F.transform(F.filter(starts, lambda s: (count >= size) & is_run(s, size)), lambda s: window(s, size))

    return F.concat(*[runs(size) for size in range(1, run + 1)])


def _selected(lines: Column, run: int, long: int, words: int) -> Column:
    """The lines that a window selects, each with the lines around it that share a window with it."""
    chosen = F.array_distinct(F.transform(_windows(lines, run, long, words), lambda w: w["print_line"]))

    def position(line: Column) -> Column:
        first = F.greatest(line - (run - 1), F.lit(0))
        around = F.slice(lines, first + 1, line - first + run)
        return F.struct(line.alias("at"), F.get(lines, line)["a"].alias("print"), first.alias("first"), around.alias("around"))

    return F.transform(chosen, position)


def _extended(run: int, long: int, words: int) -> Column:
    """The runs through a selected line for which it is the fingerprint, as far as the lines around it go."""
    through = F.filter(
        _windows(F.col("around"), run, long, words), lambda w: w["print_line"] + F.col("first") == F.col("at")
    )
    return F.transform(through, lambda w: w.withField("line", w["line"] + F.col("first")))


def repeated_runs(
    documents: DataFrame, key: str = "doc_id", text: str = "text", run: int = RUN, long: int = LONG, words: int = WORDS
) -> DataFrame:
    """``(key, runs)``: the runs to delete, as structs of first line and line after the last."""
    line = lambda x: F.struct(
        F.xxhash64(x).alias("a"),
        F.xxhash64(F.lit(1), x).alias("b"),
        F.octet_length(x).alias("bytes"),
        F.regexp_count(x, F.lit(WORD)).alias("words"),
    )
    hashed = documents.where(F.col(text).isNotNull()).select(F.col(key).alias("doc"), F.col(text).alias("text"))
    hashed = compute_once(hashed, {"lines": F.transform(F.split("text", "\n", -1), line)})
    selected = materialise(hashed.select("doc", F.inline(_selected(F.col("lines"), run, long, words))), "selected")

    # A fingerprint in one place has no match.
    prints = selected.groupBy("print").agg(
        F.min(F.struct("doc", "at")).alias("low"), F.max(F.struct("doc", "at")).alias("high")
    )
    shared = prints.where("low != high").select("print")
    joined = compute_once(selected.join(shared, "print"), {"runs": _extended(run, long, words)})
    likely = joined.select("doc", F.inline("runs")).select("doc", "line", "lines", "key1", "key2")
    likely = materialise(likely, "runs")
    place = F.struct("doc", "line")
    firsts = likely.groupBy("key1", "key2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    matches = likely.join(firsts.where("first != last"), ["key1", "key2"]).where(place != F.col("first"))

    # Overlapping and adjoining matches of a document grow into one run.
    in_order = W.partitionBy("doc").orderBy("line", "lines")
    reach = F.max(F.col("line") + F.col("lines")).over(in_order.rowsBetween(W.unboundedPreceding, -1))
    starts = F.when(F.col("line") <= F.col("reach"), 0).otherwise(1)
    return (
        matches.where("doc is not null")
        .select("doc", "line", "lines")
        .distinct()
        .withColumn("reach", reach)
        .withColumn("run", F.sum(starts).over(in_order.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("doc", "run")
        .agg(F.min("line").alias("start"), F.max(F.col("line") + F.col("lines")).alias("end"))
        .groupBy(F.col("doc").alias(key))
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))
    )


def _without(text: Column, runs: Column) -> Column:
    """The text without the lines of the runs."""
    lines = F.split(text, "\n", -1)

    def gap(i: Column) -> Column:
        begin = F.coalesce(F.get(runs, i - 1)["end"], F.lit(0))
        end = F.coalesce(F.get(runs, i)["start"], F.size(lines))
        return F.slice(lines, begin + 1, end - begin)

    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size(runs)), gap))
    return F.array_join(kept, "\n")


def remove_repeats(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    run: int = RUN,
    long: int = LONG,
    runs: str | None = None,
    drop_emptied: bool = False,
    words: int = WORDS,
) -> DataFrame:
    """The documents with the lines of later repeated runs cut out of their texts.

    With ``runs``, a column of that name tells which lines went. With ``drop_emptied``,
    documents of which nothing but line ends is left go altogether.
    """
    own_key, own_runs = free_name("_key", documents), free_name("_runs", documents)
    found = repeated_runs(documents, key, text, run, long, words)
    found = found.select(F.col(key).alias(own_key), F.col("runs").alias(own_runs))
    joined = documents.join(found, documents[key] == F.col(own_key), "left")
    cut = F.when(F.col(own_runs).isNull(), F.col(text)).otherwise(_without(F.col(text), F.col(own_runs)))
    columns = [cut.alias(text) if c == text else F.col(c) for c in documents.columns if c != runs]
    done = joined.select(*columns, F.col(own_runs))
    if drop_emptied:
        done = done.where(F.col(own_runs).isNull() | (F.ltrim(F.col(text), F.lit("\n")) != ""))
    return done.withColumnRenamed(own_runs, runs) if runs else done.drop(own_runs)
