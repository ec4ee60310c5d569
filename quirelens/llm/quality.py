"""Quality rules: fixed limits, then robust multivariate outliers within each language and source.

Built-in functions only. Each document's statistics become a vector of four transformed rates. For each language and
source the minimum covariance determinant estimate is sought among the shares of rows that concentration steps lead
to: from medians and median deviations, and from the means and covariances of several drawn subsets, each start goes
again and again to the mean and covariance of the share of rows that lie nearest. After a few steps the start whose
covariance has the least determinant goes on, until its determinant falls no further. A pair of language and source
with few rows is judged by the estimate of its language, and a language with few rows by that of the whole table.

Every step is two aggregates over a small table of statistics, so a source with a third of all rows is summed before
it is shuffled; what is joined to the rows is a written table of estimates, one row a group. Vectors are whole
numbers, so sums do not depend on their order and a retried task gives the same verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from quirelens.llm.common import Scratch, query, table

BLANKS = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

SCALE = 1024  # a vector's unit is 1/SCALE
FEATURES = ("length_log", "symbol_root", "line_root", "repeat_root")
DIM = len(FEATURES)
CORE_SHARE = 0.75  # of a group's rows make its estimate
CORE_FACTOR = 1.49  # makes the core's covariance that of all rows, for DIM normal variables
FLOOR = (0.02, 0.05, 0.1, 0.1)  # least standard deviations
CUTOFF = 33.4  # of the squared distance: chi-squared with DIM degrees of freedom, one in a million
MIN_GROUP = 60  # fitting rows of an estimate of its own; else the language's is used, then the whole table's
STARTS = 4  # for each group: medians, and the others from subsets drawn by a hash
FIRST_STEPS = 2  # of every start
LAST_STEPS = 20  # at most, of the start with the least determinant; in practice it is stable after a few
STABLE = 1e-4  # a determinant that falls by less, relatively, is stable


def _let(value: Column, body) -> Column:
    """``body`` of a value computed once in the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")


def repeated_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the text.

    Windows are compared by a 64-bit hash. Where none repeats, nothing is sorted.
    """
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def places(s: Column) -> Column:
        def place(k: Column) -> Column:
            own = F.element_at(s, k)["hash"]
            before = (k > 1) & (F.element_at(s, F.greatest(k - 1, F.lit(1)))["hash"] == own)
            after = (k < F.size(s)) & (F.element_at(s, F.least(k + 1, F.size(s)))["hash"] == own)
            return F.when(before | after, F.element_at(s, k)["place"])

        return F.sort_array(F.filter(F.transform(F.sequence(F.lit(1), F.size(s)), place), lambda p: p.isNotNull()))

    def covered(p: Column) -> Column:
        steps = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda n, x: n + x)

    def count(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("hash"), i.alias("place"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(
            _let(_let(ordered, places), covered)
        )

    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("bigint")).otherwise(_let(hashes, count))


def statistics(docs: DataFrame) -> DataFrame:
    """Counts of every whole text (null: no words), by row: repeated rows are counted each for itself."""
    has_word = lambda line: F.translate(line, BLANKS, "") != ""
    rows = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"words": words_of(F.col("text")), "lines": F.filter(F.split("text", "\n"), has_word)})
    n = lambda c: c.cast("bigint")
    rows = rows.select(
        "doc_id", "lang", "source",
        n(F.size("words")).alias("n_words"),
        n(F.length(F.array_join("words", ""))).alias("word_chars"),
        n(F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        n(F.size("lines")).alias("n_lines"),
        n(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def vectors(rows: DataFrame) -> DataFrame:
    """The transformed rates in whole units of 1/SCALE; null without words."""
    share = lambda a, b: F.sqrt(F.col(a) / F.col(b))
    values = (
        F.log(F.col("word_chars") / F.col("n_words")), share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"),
    )
    return rows.withColumns({
        f: F.when(F.col("n_words") > 0, F.round(v * SCALE)).cast("bigint") for f, v in zip(FEATURES, values)
    })


GROUP = ["g_lang", "g_source"]
KEY = [*GROUP, "start"]
ALL = "*"


def with_groups(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds ``g_lang`` and ``g_source``, the group whose estimate judges the row, and ``shapes``, the groups whose estimate it shapes.

    A pair with MIN_GROUP fitting rows has its own estimate. The rows of smaller ones are judged by their language's,
    which all its rows shape, if those are MIN_GROUP, and else by the whole table's, however few rows that has.
    """
    lang, source = F.coalesce("lang", F.lit("")).alias("k_lang"), F.coalesce("source", F.lit("")).alias("k_source")
    rows = rows.select("*", lang, source)
    fits = F.col("n_words") >= MIN_WORDS
    counts = rows.groupBy("k_lang", "k_source").agg(F.sum(F.when(fits, 1).otherwise(0)).alias("n"))
    small = F.col("n") < MIN_GROUP
    by_lang = counts.groupBy("k_lang").agg(F.sum("n").alias("n_lang"), F.max(small).alias("any_small"))
    by_lang = by_lang.withColumn("own_lang", F.col("any_small") & (F.col("n_lang") >= MIN_GROUP))
    any_left = by_lang.agg(F.coalesce(F.max(F.col("any_small") & ~F.col("own_lang")), F.lit(False)).alias("for_all")).first()["for_all"]
    named = counts.join(by_lang, "k_lang")
    group = lambda l, s: F.struct(l.alias("g_lang"), s.alias("g_source"))
    pair = group(F.concat(F.lit("="), "k_lang"), F.concat(F.lit("="), "k_source"))
    language, whole = group(F.concat(F.lit("="), "k_lang"), F.lit(ALL)), group(F.lit(ALL), F.lit(ALL))
    judge = F.when(~small, pair).when(F.col("own_lang"), language).otherwise(whole)
    shapes = F.filter(F.array(F.when(~small, pair), F.when(F.col("own_lang"), language), F.when(F.lit(any_left), whole)), lambda g: g.isNotNull())
    # written, so that its size is known when it meets the rows
    names = scratch.write(named.select("k_lang", "k_source", judge.alias("g"), shapes.alias("shapes")), "groups")
    return rows.join(names, ["k_lang", "k_source"]).select("*", "g.g_lang", "g.g_source").drop("k_lang", "k_source", "g")


PAIRS = [(i, j) for i in range(DIM) for j in range(i + 1)]


def moments(rows: DataFrame, factor: float) -> DataFrame:
    """The mean and ``factor`` times the covariance of the rows of each key, and the logarithm of its determinant.

    To the variances the floors are added where the determinant is taken, as some features do not vary at all.
    """
    sums = rows.groupBy(*KEY).agg(
        F.count("*").alias("n"), *[F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)],
        *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"q{i}{j}") for i, j in PAIRS],
    )
    mean = lambda i: F.col(f"s{i}") / F.col("n")
    made = sums.select(
        *KEY, *[mean(i).alias(f"m{i}") for i in range(DIM)],
        *[(factor * (F.col(f"q{i}{j}") / F.col("n") - mean(i) * mean(j))).alias(f"c{i}{j}") for i, j in PAIRS],
    )
    return with_determinant(made)


def with_determinant(estimate: DataFrame) -> DataFrame:
    """Adds ``log_det``, by the pivots of an unrolled Cholesky factor."""
    kept, rows = estimate.columns, estimate
    for i in range(DIM):
        for j in range(i):
            value = F.col(f"c{i}{j}")
            for k in range(j):
                value = value - F.col(f"_u{i}{k}") * F.col(f"_u{j}{k}") / F.col(f"_d{k}")
            rows = rows.withColumns({f"_u{i}{j}": value})
        pivot = F.col(f"c{i}{i}") + (FLOOR[i] * SCALE) ** 2
        for j in range(i):
            pivot = pivot - F.col(f"_u{i}{j}") * F.col(f"_u{i}{j}") / F.col(f"_d{j}")
        rows = rows.withColumns({f"_d{i}": F.greatest(pivot, F.lit(1e-6))})
    total = sum((F.log(f"_d{i}") for i in range(1, DIM)), F.log("_d0"))
    return rows.select(*[c for c in kept if c != "log_det"], total.alias("log_det"))


def starting_points(rows: DataFrame) -> DataFrame:
    """Centre and diagonal covariance of each group from medians and median deviations, counted exactly."""
    listed = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f).alias("x")) for i, f in enumerate(FEATURES)]))
    counts = rows.select(*GROUP, listed.alias("v")).groupBy(*GROUP, "v.f", "v.x").agg(F.count("*").alias("n"))

    def median(frame: DataFrame, value: str, name: str) -> DataFrame:
        w = Window.partitionBy(*GROUP, "f")
        ranked = frame.select("*", F.sum("n").over(w.orderBy(value)).alias("upto"), F.sum("n").over(w).alias("total"))
        return ranked.filter(2 * F.col("upto") >= F.col("total")).groupBy(*GROUP, "f").agg(F.min(value).alias(name))

    middle = median(counts, "x", "med")
    away = counts.join(middle, [*GROUP, "f"]).select(*GROUP, "f", F.abs(F.col("x") - F.col("med")).alias("dev"), "n")
    away = away.groupBy(*GROUP, "f", "dev").agg(F.sum("n").alias("n"))
    both = middle.join(median(away, "dev", "mad"), [*GROUP, "f"])
    of = lambda i, c: F.max(F.when(F.col("f") == i, F.col(c)))
    made = both.groupBy(*GROUP).agg(
        *[of(i, "med").cast("double").alias(f"m{i}") for i in range(DIM)],
        *[(F.pow(1.4826 * of(i, "mad"), 2) if i == j else F.lit(0.0)).cast("double").alias(f"c{i}{j}") for i, j in PAIRS],
    )
    return with_determinant(made.select(*GROUP, F.lit(0).alias("start"), *[c for c in made.columns if c not in GROUP]))


def drawn_starts(rows: DataFrame) -> DataFrame:
    """Mean and covariance of STARTS - 1 subsets of each group, in which rows fall by a hash of their own values."""
    drawn = F.pmod(F.xxhash64("doc_id", *FEATURES, "n_words", "word_chars"), F.lit(STARTS - 1)).cast("int") + 1
    return moments(rows.withColumn("start", drawn), 1.0)


def distance(rows: DataFrame, name: str) -> DataFrame:
    """Adds the squared Mahalanobis distance of each row from its group's centre.

    To the group's covariance come, on the diagonal, the floors and what chance alone gives in a text of this
    length, so that short texts are not odd for being short. Solved by an unrolled Cholesky factor.
    """
    words = F.greatest("n_words", F.lit(1))  # rows without words have no vector
    chance = (F.lit(0.5) / words, F.lit(0.25) / words, F.lit(0.25) / F.greatest("n_lines", F.lit(1)), F.lit(0.25) / words)
    kept = rows.columns
    own = [F.col(f"c{i}{i}") + (chance[i] + FLOOR[i] ** 2) * SCALE**2 for i in range(DIM)]
    for i in range(DIM):
        made = {}
        for j in range(i):
            value = F.col(f"c{i}{j}")
            for k in range(j):
                value = value - F.col(f"_u{i}{k}") * F.col(f"_l{j}{k}")
            rows = rows.withColumns({f"_u{i}{j}": value})
            made[f"_l{i}{j}"] = F.col(f"_u{i}{j}") / F.col(f"_d{j}")
        rows = rows.withColumns(made) if made else rows
        pivot, shift = own[i], F.col(FEATURES[i]) - F.col(f"m{i}")
        for j in range(i):
            pivot = pivot - F.col(f"_u{i}{j}") * F.col(f"_l{i}{j}")
            shift = shift - F.col(f"_l{i}{j}") * F.col(f"_z{j}")
        rows = rows.withColumns({f"_d{i}": pivot, f"_z{i}": shift})
    total = sum((F.col(f"_z{i}") * F.col(f"_z{i}") / F.col(f"_d{i}") for i in range(1, DIM)), F.col("_z0") * F.col("_z0") / F.col("_d0"))
    return rows.select(*kept, total.alias(name))


def concentrate(rows: DataFrame, estimate: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """One step: the mean and covariance of each key's CORE_SHARE of rows nearest to its present estimate."""
    near = distance(rows.join(estimate, GROUP), "d2").select(*KEY, *FEATURES, F.floor(16 * F.log2(1 + F.col("d2"))).alias("bin"))
    counts = near.groupBy(*KEY, "bin").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*KEY)
    counts = counts.select(*KEY, "bin", F.sum("n").over(w.orderBy("bin")).alias("upto"), F.sum("n").over(w).alias("total"))
    edges = counts.filter(F.col("upto") >= CORE_SHARE * F.col("total")).groupBy(*KEY).agg(F.min("bin").alias("edge"))
    # written, so that its size is known when it meets the rows
    edges = scratch.write(edges, f"{name}-edges")
    found = scratch.write(moments(near.join(edges, KEY).filter(F.col("bin") <= F.col("edge")), CORE_FACTOR), name)
    scratch.drop(f"{name}-edges")
    return found


def least_determinant(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The estimate of each group of fitting rows whose core's covariance has the least determinant of those reached."""
    estimate = scratch.write(starting_points(rows).unionByName(drawn_starts(rows)), "starts")
    for k in range(FIRST_STEPS):
        estimate = concentrate(rows, estimate, scratch, f"first{k}")
    first = F.row_number().over(Window.partitionBy(*GROUP).orderBy("log_det", "start"))
    best = scratch.write(estimate.withColumn("_r", first).filter("_r = 1").drop("_r"), "best")
    for k in range(LAST_STEPS):
        going = best if k == 0 else moved
        step = concentrate(rows, going, scratch, f"last{k}")
        before = going.select(*KEY, F.col("log_det").alias("_before"))
        moved = scratch.write(step.join(before, KEY).filter(F.col("log_det") < F.col("_before") - STABLE).drop("_before"), f"moved{k}")
        if moved.isEmpty():
            break
        best = scratch.write(best.join(moved.select(*KEY), KEY, "left_anti").unionByName(moved), f"best{k}")
    return best.drop("start", "log_det")


def judge_quality(docs: DataFrame) -> DataFrame:
    """Each row's counts, ``base_failed``, squared ``distance`` and ``kept``.

    Only rows with MIN_WORDS words shape the estimates, and every row with a word is judged by one, as long as the table
    has any such row. Null texts have no words and fail. Null languages and sources count as one language or source
    each. Only ``doc_id``, ``text``, ``lang`` and ``source`` are read, whatever else there is.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    rows = scratch.write(statistics(docs), "statistics")
    rows = scratch.write(with_groups(vectors(rows), scratch), "vectors")
    scratch.drop("statistics")
    fitting = rows.filter(F.col("n_words") >= MIN_WORDS).drop(*GROUP)
    fitting = fitting.select("*", F.explode("shapes").alias("g")).select(*[c for c in fitting.columns if c != "shapes"], "g.*")
    judged = distance(rows.join(least_determinant(fitting, scratch), GROUP, "left"), "distance")
    odd = F.coalesce(F.col("distance") > CUTOFF, F.lit(False))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~odd).alias("kept"), F.round("distance", 3).alias("distance"),
    )


@query("op4_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's statistics and verdict."""
    return judge_quality(table(spark, sf_dir, "documents"))
