"""Quality rules and robust multivariate outliers, in DataFrame operations only.

Base rules: a document fails with under 10 words, or if more than 20 % of its words
stand in five-word windows found twice or more in it.

The method: each document gets a vector of transformed statistics (``FEATURES``).
Per language and source a minimum-covariance-determinant (MCD) estimate gives
location and scatter, and documents beyond ``CUTOFF`` in squared Mahalanobis
distance are rejected.

* An estimate has several starts: the medians and median absolute deviations, and means
  and covariances of small subsets drawn by a hash of the features.  Each start takes
  ``TRIALS`` concentration steps: of the rows at hand, the ``CORE`` share with the least
  distance gives the next mean and covariance (rows in the distance bin in which
  the share ends all count, so ties stand together).  The start whose core has the least
  determinant goes on for the other steps.
* Rows are summed per group, start and distance bin (map-side combined; at most ``BINS``
  rows a group, start and task), so a source with a third of all rows is no larger in the
  shuffle than any other.
* Distances are scaled so that their median is that of chi-square where it is larger,
  never smaller: a core that is too tight must not reject its own group.
* Features are whole numbers (thousandths), so all sums are exact and results do
  not hang on the order of rows.
* ``FLOOR`` is added to every standard deviation: differences below it mean
  nothing, and a group whose rows are all alike has a usable scatter.
* A covariance needs rows.  Groups under ``least_group`` sound rows are pooled by language,
  then together; a pool still smaller is held against all sound rows.  With fewer sound
  rows than that in all, the verdict is that of the base rules, and ``distance`` is null.
* Estimates are one row a group.  They are broadcast up to ``BROADCAST_GROUPS``
  groups, counted first; beyond that they are joined by shuffle.

Defined cases: a null text has no words (and fails the base rules); null lang and
null source are groups of their own; a null doc_id passes through; each of
several rows with one doc_id is judged by its own text; rows with equal features have
equal distances, and a distance of exactly ``CUTOFF`` is kept; an empty table gives an
empty result; texts of any length are read whole; extra columns are ignored by ``judge``
and kept by ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scratch

LEAST_WORDS = 10
REPEAT_PERCENT = 20
#: Share of a group's rows that the estimate concentrates on.
CORE = 0.75
#: Starts, concentration steps of each, and steps in all of the best one.
STARTS, TRIALS, STEPS = 4, 2, 5
#: Rows that a subset start is drawn from, on average.
SUBSET = 30
#: Squared distance beyond which a document is rejected; chi-square(5) reaches it with 1e-8.
CUTOFF = 45.0
LEAST_GROUP = 100
BROADCAST_GROUPS = 20_000
BINS = 240
#: Words that each document is credited with at usual values, so short texts vary less.
CREDIT = 40.0

#: name: (floor of the standard deviation in thousandths, expression in thousandths)
FEATURES = {
    "symbols": (25, f"1000 * sqrt(n_symbols / (n_words + {CREDIT}))"),
    "marks": (35, f"1000 * sqrt((n_marks + 0.1 * {CREDIT}) / (n_words + {CREDIT}))"),
    "capitals": (35, f"1000 * sqrt((n_capitals + 0.1 * {CREDIT}) / (n_words + {CREDIT}))"),
    "length": (60, f"1000 * ln((word_chars + 5.0 * {CREDIT}) / (n_words + {CREDIT}))"),
    "repeats": (60, f"1000 * sqrt(n_repeat_words / (n_words + {CREDIT}))"),
}
#: Median of chi-square with five degrees of freedom.
_MEDIAN_D2 = 4.351
_P = len(FEATURES)
_SPACE = r"[\\x20\\x09-\\x0D]+"


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, fp (of the text), the base statistics, n_marks and n_capitals of every row."""
    words = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .withColumn("fp", F.xxhash64("text"))
        .withColumn("words", F.expr(f"filter(split(text, '{_SPACE}'), w -> w <> '')"))
        .withColumn("lines", F.expr(f"filter(split(text, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"))
        .withColumn("hashes", F.expr("transform(words, w -> xxhash64(w))"))
    )
    windows = words.withColumn(
        "windows",
        F.expr(
            "if(size(hashes) < 5, array(), transform(sequence(0, size(hashes) - 5),"
            " i -> xxhash64(hashes[i], hashes[i + 1], hashes[i + 2], hashes[i + 3], hashes[i + 4])))"
        ),
    )
    # Only documents that do repeat a window are sorted.
    placed = windows.withColumn(
        "placed",
        F.expr(
            "if(size(array_distinct(windows)) = size(windows), array(),"
            " sort_array(transform(windows, (h, i) -> named_struct('h', h, 'i', i))))"
        ),
    ).withColumn(
        "starts",
        F.expr(
            "sort_array(filter(transform(placed, (x, j) -> if(get(placed, j - 1).h = x.h or get(placed, j + 1).h = x.h, x.i, -1)), i -> i >= 0))"
        ),
    )
    return placed.select(
        "doc_id",
        "lang",
        "source",
        "fp",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.expr("cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '')) as bigint)").alias("n_symbols"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) as bigint)").alias("n_dup_lines"),
        F.expr(
            "aggregate(starts, named_struct('n', 0L, 'last', -5), (a, i) ->"
            " named_struct('n', a.n + least(5, i - a.last), 'last', i), a -> a.n)"
        ).alias("n_repeat_words"),
        F.expr(r"cast(length(text) - length(regexp_replace(text, '[!-/:-@\\[-`{-~]+', '')) as bigint)").alias("n_marks"),
        F.expr(r"cast(length(text) - length(regexp_replace(text, '\\p{Lu}+', '')) as bigint)").alias("n_capitals"),
    )


def _features(stats: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    out = stats.withColumn("base_failed", failed)
    return out.withColumns({f"x{i}": F.expr(f"cast(round({e}) as bigint)") for i, (_, e) in enumerate(FEATURES.values())})


def _groups(stats: DataFrame, least: int) -> tuple[DataFrame, bool]:
    """(lang, source) to grp: the pair itself, its language, all that is left, or null for no estimate.

    Besides, whether what is left is too little, so that its estimate is that of all sound
    rows; there is no estimate only if those are too few as well.
    """
    sizes = stats.where("not base_failed").groupBy("lang", "source").agg(F.count("*").alias("n"))
    pairs = stats.groupBy("lang", "source").agg(F.lit(1).alias("one")).drop("one")
    n = pairs.alias("p").join(sizes.alias("s"), F.expr("p.lang <=> s.lang and p.source <=> s.source"), "left").select("p.lang", "p.source", F.coalesce("n", F.lit(0)).alias("n"))
    small = n.where(F.col("n") < least)
    by_lang = small.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    left = n.alias("p").join(by_lang.alias("b"), F.expr("p.lang <=> b.lang"), "left").select("p.lang", "p.source", "n", "n_lang")
    n_rest = by_lang.where(F.col("n_lang") < least).agg(F.sum("n_lang").alias("n")).first()["n"] or 0
    whole = 0 < n_rest < least and (sizes.agg(F.sum("n").alias("n")).first()["n"] or 0) >= least
    pooled = whole or n_rest >= least
    groups = left.select(
        "lang",
        "source",
        F.expr(
            f"case when n >= {least} then to_json(array(lang, source))"
            f" when n_lang >= {least} then to_json(array(lang)) when {str(pooled).lower()} then '*' end"
        ).alias("grp"),
    )
    return groups, whole


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    """Count, sums and sums of products of the features."""
    out = [F.count("*").alias("n")]
    out += [F.sum(f"x{i}").alias(f"s{i}") for i in range(_P)]
    out += [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i in range(_P) for j in range(i + 1)]
    return rows.groupBy(*keys).agg(*out)


def _whitened(moments: DataFrame) -> DataFrame:
    """Per group: centre m and W with W C W' = 1, by a Cholesky factorisation of C."""
    out = moments.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(_P)})
    floors = [f for f, _ in FEATURES.values()]
    cov = {(i, j): F.col("scale") * (F.col(f"q{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) + (float(floors[i] ** 2) if i == j else 0.0) for i in range(_P) for j in range(i + 1)}
    return _factor(out, cov)


def _factor(out: DataFrame, cov: dict[tuple[int, int], Column]) -> DataFrame:
    out = out.withColumns({f"c{i}{j}": c for (i, j), c in cov.items()})
    for j in range(_P):
        left = lambda i, j=j: sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - left(j), F.lit(1.0))))
        if j + 1 < _P:
            out = out.withColumns({f"l{i}{j}": (F.col(f"c{i}{j}") - left(i)) / F.col(f"l{j}{j}") for i in range(j + 1, _P)})
    for i in range(_P):
        out = out.withColumns(
            {f"w{i}{j}": (F.lit(1.0) if i == j else -sum((F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)), F.lit(0.0))) / F.col(f"l{i}{i}") for j in range(i + 1)}
        )
    # Logarithm of the determinant of the core's covariance, without the scale.
    goal = sum((2 * F.log(f"l{i}{i}") for i in range(_P)), F.lit(0.0)) - _P * F.log("scale")
    return out.select("grp", "start", goal.alias("goal"), *[f"m{i}" for i in range(_P)], *[f"w{i}{j}" for i in range(_P) for j in range(i + 1)])


def _distance() -> Column:
    gap = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(_P)]
    z = [sum((F.col(f"w{i}{j}") * gap[j] for j in range(i + 1)), F.lit(0.0)) for i in range(_P)]
    return sum((v * v for v in z), F.lit(0.0))


def judge(docs: DataFrame, least_group: int = LEAST_GROUP) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance.

    ``distance`` is the squared robust distance (null without an estimate).
    """
    return _judged(docs, least_group).drop("lang", "source", "fp")


def keep(docs: DataFrame, least_group: int = LEAST_GROUP) -> DataFrame:
    """The rows of ``docs``, all columns, that are kept."""
    kept = _judged(docs, least_group).where("kept").select("doc_id", "lang", "source", "fp").distinct()
    same = F.expr("d.doc_id <=> k.doc_id and d.lang <=> k.lang and d.source <=> k.source and xxhash64(coalesce(d.text, '')) = k.fp")
    return docs.alias("d").join(kept.alias("k"), same, "left_semi")


def _best(estimate: DataFrame) -> DataFrame:
    """Of each group the start with the least determinant; ties go to the first."""
    names = [c for c in estimate.columns if c != "grp"]
    return estimate.groupBy("grp").agg(F.min_by(F.struct(*names), F.struct("goal", "start")).alias("best")).select("grp", "best.*")


def _judged(docs: DataFrame, least_group: int) -> DataFrame:
    spark = docs.sparkSession
    rows = scratch.table(spark, _features(statistics(docs)), "quality")
    groups, whole = _groups(rows, least_group)
    groups = scratch.table(spark, groups, "groups")
    # What an estimate is drawn from: a group's own rows, for what is left maybe all.
    drawn = groups.where("grp is not null")
    if whole:
        drawn = drawn.unionAll(drawn.where("grp <> '*'").withColumn("grp", F.lit("*")))
        drawn = scratch.table(spark, drawn.distinct(), "drawn")
    few = groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    small = F.broadcast if few else (lambda df: df)
    same = F.expr("r.lang <=> g.lang and r.source <=> g.source")

    def measured(estimate: DataFrame, of: DataFrame, how: str, pairs: DataFrame) -> DataFrame:
        by_pair = pairs.join(small(estimate), "grp")
        return of.alias("r").join(small(by_pair).alias("g"), same, how).drop(F.col("g.lang"), F.col("g.source")).withColumn("d2", _distance())

    sound = rows.where("not base_failed")
    grouped = sound.alias("r").join(small(drawn).alias("g"), same).select("grp", *[f"x{i}" for i in range(_P)])
    middle = grouped.groupBy("grp").agg(F.count("*").alias("n"), *[F.percentile(f"x{i}", F.lit(0.5)).alias(f"m{i}") for i in range(_P)])
    around = grouped.join(small(middle), "grp").groupBy("grp").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(_P)],
        *[F.percentile(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), F.lit(0.5)).alias(f"d{i}") for i in range(_P)],
    )
    floors = [f for f, _ in FEATURES.values()]
    diagonal = {(i, j): (F.pow(1.4826 * F.col(f"d{i}"), 2) + float(floors[i] ** 2) if i == j else F.lit(0.0)) for i in range(_P) for j in range(i + 1)}
    medians = _factor(around.withColumns({"start": F.lit(0), "scale": F.lit(1.0)}), diagonal)
    tried = grouped.join(small(middle.select("grp", "n")), "grp").withColumn("start", F.explode(F.sequence(F.lit(1), F.lit(STARTS - 1))))
    drawn_by = F.xxhash64(*[f"x{i}" for i in range(_P)], "start")
    subsets = _sums(tried.where(F.pmod(drawn_by, F.greatest(F.lit(1), F.floor(F.col("n") / SUBSET))) == 0), "grp", "start")
    estimate = scratch.table(spark, medians.unionByName(_whitened(subsets.withColumn("scale", F.lit(1.5)))), "estimate")
    for step in range(STEPS):
        bins = F.least(F.lit(BINS - 1), F.floor(F.lit(20.0) * F.log1p("d2")).cast("int")).alias("bin")
        if step == TRIALS:
            estimate = scratch.table(spark, _best(estimate), "estimate")
        near = measured(estimate, sound, "inner", drawn).select("grp", "start", bins, *[f"x{i}" for i in range(_P)])
        summed = _sums(near, "grp", "start", "bin")
        # At most BINS rows a group and start from here on.
        upto = summed.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("grp", "start").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        upto = upto.withColumn("total", F.sum("n").over(Window.partitionBy("grp", "start")))
        half = upto.where(F.col("before") < F.lit(0.5) * F.col("total")).groupBy("grp", "start").agg(F.max("bin").alias("mid"))
        core = upto.where(F.col("before") < F.lit(CORE) * F.col("total"))
        names = ["n", *[f"s{i}" for i in range(_P)], *[f"q{i}{j}" for i in range(_P) for j in range(i + 1)]]
        moments = core.groupBy("grp", "start").agg(*[F.sum(c).alias(c) for c in names]).join(half, ["grp", "start"])
        # The median distance should be that of chi-square; the scatter only ever widens.
        moments = moments.withColumn("scale", F.greatest(F.lit(1.0), (F.exp((F.col("mid") + 1) / 20.0) - 1) / _MEDIAN_D2) if step else F.lit(1.5))
        estimate = scratch.table(spark, _whitened(moments), "estimate")
    out = measured(estimate, rows, "left", groups)
    return out.select(
        "doc_id", "lang", "source", "fp", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= CUTOFF)).alias("kept"),
        F.col("d2").alias("distance"),
    )
