"""Words of scripts that are written without spaces, found along the best path through a word table.

A term is cut where its script changes. A run of an unspaced script is then cut into words of the table so that as few
characters as can be are left over, then into as few pieces as can be; of equal ways the one with the longest last word
is taken, from the end. A character that no word covers is a piece by itself.

A word table that each worker can hold is searched in the row, in time that grows with the text and not with its square.
With a larger one, which parts of a run are words is found by a join, so the table may have any size; different runs are
cut once each then. Places, paths and pieces are as many as the text is long, whatever their size is taken for
beforehand: they are joined by shuffle and never sent whole, and a place carries its run's digest, not the run.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelens.operators.explode import unfold
from quirelens.operators.lookup import fits_broadcast

#: Scripts without spaces; what is written in Han and kana together is one run.
UNSPACED = [r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー", r"\p{IsThai}", r"\p{IsLao}", r"\p{IsKhmer}", r"\p{IsMyanmar}"]
ANY_UNSPACED = "[" + "".join(UNSPACED) + "]"
RUNS = "|".join([f"[{s}]+" for s in UNSPACED] + ["[^" + "".join(UNSPACED) + "]+"])
LEFT_OVER = 1_000_000  # what a character without a word costs; a piece costs one
#: A word table up to these is held by every worker, as a tree of characters.
HELD_MAX_ROWS, HELD_MAX_BYTES = 50_000, 4 << 20
ENDS = ""  # marks a node of the tree that a word ends at
SENT_CHARS = 1 << 20  # of terms whose pieces are handed on at a time
TAKEN_ROWS = 64  # of a batch that become objects at a time


def is_unspaced(text: Column) -> Column:
    return F.rlike(text, F.lit(ANY_UNSPACED))


def script_runs(term: Column) -> Column:
    """A term cut where an unspaced script begins or ends."""
    return F.regexp_extract_all(term, F.lit(RUNS), F.lit(0))


def unspaced_words(words: DataFrame) -> DataFrame:
    return words.select("word").filter(is_unspaced(F.col("word"))).distinct()


def parts_that_are_words(runs: DataFrame, words: DataFrame) -> DataFrame:
    """(run, ends): for each place in a run, counted from 1, the lengths of the words that end there."""
    known = unspaced_words(words)
    lengths = sorted(r["n"] for r in known.select(F.length("word").alias("n")).distinct().collect())
    keyed = runs.withColumn("_run", F.unhex(F.md5("run")))
    stops = keyed.select("_run", "run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("stop"))
    tried = F.filter(F.lit(lengths).cast("array<int>"), lambda n: n <= F.col("stop"))
    parts = stops.select("_run", "run", "stop", F.explode(tried).alias("length"))
    cut = parts.select("_run", "stop", "length", F.substr("run", F.col("stop") - F.col("length") + 1, F.col("length")).alias("word"))
    side = F.broadcast(known) if fits_broadcast(known) else known.hint("merge")
    found = cut.join(side, "word", "left_semi").groupBy("_run", "stop").agg(F.collect_list("length").alias("lengths"))
    ends = found.groupBy("_run").agg(F.map_from_entries(F.collect_list(F.struct("stop", "lengths"))).alias("ends"))
    return keyed.join(ends.hint("merge"), "_run", "left").select("run", "ends")


def word_tree(words: list[str]) -> dict:
    """Words as nested dictionaries by character."""
    root: dict = {}
    for word in words:
        node = root
        for c in word:
            node = node.setdefault(c, {})
        node[ENDS] = {}
    return root


def cut_run(run: str, tree: dict) -> list[str]:
    """The pieces of a run along ``best_path``, in order; no place is looked at further than words reach from it."""
    n = len(run)
    chars = list(run)  # each character becomes an object once, not at every look
    costs = [(LEFT_OVER + 1) * k for k in range(n + 1)]
    back = [1] * (n + 1)
    first = tree.get
    for start in range(n):
        cost = costs[start] + 1
        node, stop = first(chars[start]), start
        while node is not None:
            stop += 1
            # of equal costs the earlier start stays: the longer last piece
            if ENDS in node and cost < costs[stop]:
                costs[stop], back[stop] = cost, stop - start
            if stop == n:
                break
            node = node.get(chars[stop])
        if cost + LEFT_OVER < costs[start + 1]:
            costs[start + 1], back[start + 1] = cost + LEFT_OVER, 1
    pieces = []
    while n:
        pieces.append(run[n - back[n]:n])
        n -= back[n]
    return pieces[::-1]


def pieces_in_row(terms: DataFrame, words: list[str]) -> DataFrame:
    """(_term, _pieces) out of (_term), by workers that hold the words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = word_tree(words)

        def made(held: list[tuple[str, list[str]]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([t for t, _ in held], pa.string()), pa.array([p for _, p in held], pa.list_(pa.string()))], ["_term", "_pieces"])

        held: list[tuple[str, list[str]]] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, TAKEN_ROWS):
                part = batch.slice(at, TAKEN_ROWS)
                for term, runs, unspaced in zip(*(part.column(c).to_pylist() for c in ("_term", "runs", "unspaced"))):
                    own: list[str] = []
                    for run, is_run in zip(runs, unspaced):
                        own.extend(cut_run(run, tree) if is_run else [run])
                    held.append((term, own))
                    size += len(term)
                if size >= SENT_CHARS:
                    yield made(held)
                    held, size = [], 0
        if held:
            yield made(held)

    runs = terms.select("_term", script_runs(F.col("_term")).alias("runs"))
    return runs.select("_term", "runs", F.transform("runs", is_unspaced).alias("unspaced")).mapInArrow(cut, "_term string, _pieces array<string>")


def pieces_by_join(terms: DataFrame, words: DataFrame) -> DataFrame:
    """(_term, _pieces) out of (_term), by a join of parts and words; each different run is cut once."""
    runs = unfold(terms, script_runs(F.col("_term")), "run", "_term")
    unspaced = runs.filter(is_unspaced(F.col("run"))).select("run").distinct()
    cut = parts_that_are_words(unspaced, words).select("run", best_path(F.col("run"), F.col("ends")).alias("_own"))
    known = runs.join(cut.hint("merge"), "run", "left").select("_term", F.coalesce("_own", F.array("run")).alias("_own"))
    return known.groupBy("_term").agg(F.flatten(F.collect_list("_own")).alias("_pieces"))  # no more than the term is long


def best_path(run: Column, ends: Column) -> Column:
    """The pieces of a run, in order."""
    first = F.array(F.struct(F.lit(0).cast("bigint").alias("cost"), F.lit(0).alias("length")))

    def reached(best: Column, stop: Column) -> Column:
        """The least cost up to ``stop`` and the length of the last piece."""

        def by(length: Column, extra: int) -> Column:
            before = F.get(best, stop - length)["cost"]
            return F.struct((before + 1 + extra).alias("cost"), (-length).alias("back"))

        lengths = F.coalesce(F.try_element_at(ends, stop), F.array().cast("array<int>"))
        ways = F.concat(F.transform(lengths, lambda length: by(length, 0)), F.array(by(F.lit(1), LEFT_OVER)))
        # bound once: both parts of the least way are asked for
        return F.get(F.transform(F.array(F.array_min(ways)), lambda w: F.struct(w["cost"].alias("cost"), (-w["back"]).alias("length"))), F.lit(0))

    n = F.length(run)
    best = F.aggregate(F.sequence(F.lit(1), n), first, lambda acc, stop: F.concat(acc, F.array(reached(acc, stop))))

    def backwards(best: Column) -> Column:
        start = F.struct(n.alias("at"), F.array().cast("array<string>").alias("pieces"))

        def step(acc: Column, at: Column) -> Column:
            length = F.get(best, at)["length"]
            taken = F.struct((at - length).alias("at"), F.concat(F.array(F.substr(run, at - length + 1, length)), acc["pieces"]).alias("pieces"))
            return F.when(acc["at"] == at, taken).otherwise(acc)

        return F.aggregate(F.sequence(n, F.lit(1), F.lit(-1)), start, step, lambda acc: acc["pieces"])

    # bound once: the path is looked at in every step backwards
    return F.get(F.transform(F.array(best), backwards), F.lit(0))


def segment_terms(rows: DataFrame, words: DataFrame, column: str = "term", held_rows: int = HELD_MAX_ROWS) -> DataFrame:
    """One row for each piece of a term, in place of the term; a term without unspaced scripts stays one row.

    ``words`` is a table (word); one of up to ``held_rows`` words is held by the workers. Each different term is cut once.
    Order among the pieces of a term is not kept.
    """
    terms = rows.select(F.col(column).alias("_term")).filter(is_unspaced(F.col(column))).distinct()
    known = unspaced_words(words)
    if fits_broadcast(known, held_rows, HELD_MAX_BYTES):
        pieces = pieces_in_row(terms, [r["word"] for r in known.collect()])
    else:
        pieces = pieces_by_join(terms, words)
    others = [c for c in rows.columns if c != column]
    found = rows.join(pieces.hint("merge"), F.col(column) == F.col("_term"), "left")
    made = F.explode(F.coalesce("_pieces", F.array(column))).alias(column)
    return found.select(*others, made).select(*rows.columns)
