"""Repeated passages, as content-defined chunks of lines.

A line is hashed, and a chunk starts where a rolling hash over the two lines
before has a certain remainder: boundaries depend on nearby lines only, so
the same passage is cut alike wherever it stands and whatever comes before it.
A line of `LONG_LINE` characters or more (about 40 words) is a passage by
itself: boundaries stand on both of its sides.

A passage of two or three short lines seldom holds a whole chunk, since the
lines around it decide where its first and last chunk end. So every line also
starts a run, whose end depends on its content alone: it is the line at which
the run holds over `MASS` words. Runs go through long lines too, and another
goes backwards from each line.
Whatever stands around a passage of more words than that, its runs are the
same everywhere, and together they hold all of its lines: a line after which the
passage ends too soon for a run forwards, and before which it starts too late for
one backwards, lies in the run from the passage's first line.

Chunks of several lines, long lines and runs that occur more than once in all
documents are removed but for the first (the smallest id, then the first
place); that they are equal is decided on their bytes, after their hashes have
met. Single short lines stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD, let, stored

LONG_LINE = 200
BACK, EVERY = 2, 2
#: A run of lines ends where it holds more words than this.
MASS = 50
#: Lines of a run that are summed first; most runs are shorter.
STEP = 4
#: A span is one number, its first line times this plus its lines: sets of numbers are hashed, sets of structs compared pair by pair.
SPAN = 1 << 31


def chunk_starts(lines: Column) -> Column:
    """The line numbers, from 0, at which chunks start."""
    def starts(h: Column, long: Column) -> Column:
        rolled = lambda i: F.pmod(F.xxhash64(F.slice(h, i - BACK + 1, BACK)), F.lit(EVERY)) == 0
        edge = lambda i: F.when(i == 0, True).when(F.get(long, i) | F.get(long, i - 1), True).when(i >= BACK, rolled(i)).otherwise(False)
        return F.filter(F.sequence(F.lit(0), F.size(h) - 1), edge)

    hashes = F.transform(lines, lambda line: F.xxhash64(line))
    return let(hashes, lambda h: let(F.transform(lines, lambda line: F.length(line) >= LONG_LINE), lambda long: starts(h, long)))


def _span(first: Column, n_lines: Column) -> Column:
    return first.cast("long") * SPAN + n_lines


def _spans(lines: Column) -> Column:
    """The chunks of a text, as spans."""
    def between(s: Column) -> Column:
        return F.transform(s, lambda first, j: _span(first, F.coalesce(F.get(s, j + 1), F.size(lines)) - first))

    return let(chunk_starts(lines), between)


def heavy_runs(lines: Column, mixed: bool = True) -> Column:
    """The spans of the runs that hold over `MASS` words: one each way from each line with a word, if it gets there.

    Without `mixed`, runs are of short lines only and go forwards.
    """
    too_many = 1_000_000  # what a long line counts, so that no run goes through it unless mixed

    def fold(words: Column) -> Column:
        add = lambda run, w: F.when(run["words"] > MASS, run).otherwise(F.struct((run["words"] + w).alias("words"), (run["n"] + 1).alias("n")))
        return F.aggregate(words, F.struct(F.lit(0).alias("words"), F.lit(0).alias("n")), add)

    def runs(filled: Column) -> Column:
        """`filled`: the lines that hold words, as (at, words), ascending or descending."""
        def of(words: Column) -> Column:
            # Each of these lines holds a word, so that no run has more than MASS + 1 of them.
            longer = lambda j, few: F.when(few["words"] > MASS, few).otherwise(fold(F.slice(words, j + 1, MASS + 1)))
            run = lambda j: let(fold(F.slice(words, j + 1, STEP)), lambda few: longer(j, few))
            ended = F.transform(filled, lambda line, j: F.struct(line["at"].alias("from"), j.alias("j"), run(j).alias("run")))
            heavy = F.filter(ended, lambda e: (e["run"]["words"] > MASS) & (F.lit(mixed) | (e["run"]["words"] < too_many)))
            to = lambda e: F.get(filled, e["j"] + e["run"]["n"] - 1)["at"]
            return F.transform(heavy, lambda e: _span(F.least(e["from"], to(e)), F.abs(to(e) - e["from"]) + 1))

        return let(F.transform(filled, lambda line: line["words"]), of)

    short = lambda line: F.regexp_count(line, F.lit(WORD))
    weight = short if mixed else lambda line: F.when(F.length(line) >= LONG_LINE, too_many).otherwise(short(line))
    counted = F.transform(lines, lambda line, at: F.struct(at.alias("at"), weight(line).alias("words")))
    both_ways = lambda filled: F.array_union(runs(filled), let(F.reverse(filled), runs))
    return let(F.filter(counted, lambda line: line["words"] > 0), both_ways if mixed else runs)


def _body(lines: Column, span: Column) -> Column:
    return F.array_join(F.slice(lines, span["first"] + 1, span["n_lines"]), "\n")


def chunks(docs: DataFrame, mixed: bool = True) -> DataFrame:
    """(doc_id, version, first, n_lines, hash): every chunk and run that may be removed, of rows (doc_id, version, text)."""
    lined = docs.select("doc_id", "version", F.split("text", "\n").alias("lines"))
    may = lambda n, body: ((n > 1) | (F.length(body) >= LONG_LINE) | (F.regexp_count(body, F.lit(WORD)) > MASS)) & (F.trim(F.translate(body, "\n\t\r", "   ")) != "")

    def cut(lines: Column) -> Column:
        spans = F.array_union(_spans(lines), heavy_runs(lines, mixed))
        parted = F.transform(spans, lambda s: F.struct(F.call_function("shiftright", s, F.lit(31)).cast("int").alias("first"), s.bitwiseAND(F.lit(SPAN - 1)).cast("int").alias("n_lines")))
        hashed = lambda s: let(_body(lines, s), lambda body: F.when(may(s["n_lines"], body), F.xxhash64(body)))
        return F.transform(parted, lambda s: F.struct(s["first"].alias("first"), s["n_lines"].alias("n_lines"), hashed(s).alias("hash")))

    flat = lined.select("doc_id", "version", F.explode(let(F.col("lines"), cut)).alias("c")).select("doc_id", "version", "c.*")
    return flat.where("hash IS NOT NULL")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, version, text): `version` tells texts apart that share an id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("version", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull(), "text"))


def repeated_chunks(rows: DataFrame, mixed: bool = True) -> DataFrame:
    """(version, first, n_lines): the chunks to remove, all but the first of each and what overlaps it.

    Occurrences are aggregated by hash before the shuffle; only chunks whose
    hash occurs twice are cut from their texts again, compared by their bytes, and
    marked. Joins are sorted ones at every size, since what repeats grows with the documents.
    """
    place = F.struct("doc_id", "version", "first").alias("place")
    every = stored(chunks(rows, mixed), "spans")
    twice = every.select("hash", place).groupBy("hash").agg(F.min("place").alias("_a"), F.max("place").alias("_b")).where("_a != _b")
    met = every.join(twice.select("hash").hint("merge"), "hash").groupBy("version").agg(F.collect_set(F.struct("first", "n_lines", "hash")).alias("spans"))
    texts = rows.join(met.hint("merge"), "version").select("doc_id", "version", "spans", F.split("text", "\n").alias("lines"))
    bodies = let(F.col("lines"), lambda lines: F.transform("spans", lambda s: F.struct(s["hash"].alias("hash"), _body(lines, s).alias("body"), s["n_lines"].alias("n_lines"), s["first"].alias("first"))))
    some = stored(texts.select("doc_id", "version", F.explode(bodies).alias("c")).select("doc_id", "version", "c.*").select("hash", "body", "n_lines", place), "chunks")
    firsts = some.groupBy("hash", "body").agg(F.min("place").alias("kept"))
    again = some.join(firsts, ["hash", "body"]).where("place.version != kept.version OR place.first >= kept.first + n_lines")
    return again.select("place.version", "place.first", "n_lines").distinct()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mixed: bool = True) -> DataFrame:
    """Per row of `docs`: doc_id, text without repeated chunks, n_lines, removed (the numbers of removed lines, ascending).

    Null and empty texts come back empty, with one empty line. Rows alike in id
    and text are one document and lose nothing to each other. Null ids come first.
    Every repeated passage of over `MASS` words goes whole, in time that grows with the
    lines of a text, however many; without `mixed`, a short line beside a long one stays.
    """
    rows = _rows(docs, id_col, text_col)
    gone = repeated_chunks(rows, mixed).select("version", F.sequence(F.col("first"), F.col("first") + F.col("n_lines") - 1).alias("numbers"))
    gone = stored(gone.groupBy("version").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("numbers")))).alias("removed")), "removed")
    both = rows.join(gone.hint("merge"), "version", "left").withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))

    def rest(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed"))
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    lines = F.split("text", "\n")
    return both.select(
        "doc_id", F.when(F.size("removed") > 0, let(lines, rest)).otherwise(F.col("text")).alias("text"),
        F.size(lines).cast("long").alias("n_lines"), "removed",
    )
