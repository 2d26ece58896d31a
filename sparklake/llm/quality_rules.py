"""Quality rules: robust multivariate outliers by minimum covariance determinant (MCD).

Per language and source, statistic vectors of the documents get a robust centre and
scatter from concentration steps, begun at medians and median absolute deviations (the
``COVERED`` share of documents nearest to the centre define the next centre and scatter);
a document whose Mahalanobis distance is beyond the cutoff is rejected.  Everything is
DataFrame functions.

* Vectors are fixed-point integers (1/256), so sums are exact and reruns agree.
* A concentration step is one pass: documents are summed per group and distance bin
  (map-side), and a window over a group's bins, whose number is bounded, picks the
  nearest ones.
* Groups below ``MIN_GROUP`` documents are pooled per language; documents of pools that are still too
  small are held against the estimate over all documents.  If these are too few as well, they are held
  against their medians with ``LEAST_SD`` as scatter.

Defined results: null text has no words; empty and short texts fail the base rule; null
language or source is a value of its own; repeated rows are scored alike; an empty
table gives an empty result; extra columns are carried under their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparklake.llm.common import KEY, SPACE_CHARS, content_key, field, save, small, unpacked, with_key, word_array

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Share of a group's documents that define its centre and scatter.
COVERED = 0.5
STEPS = 4
MIN_GROUP = 50
#: Label of the last pool; other labels are JSON objects.
LAST = "last"
UNIT = 256
#: Least standard deviation of each statistic, in its own unit (log2): mean word length,
#: and the percentages of symbols, repeated lines, repeated words and capitals.
LEAST_SD = (0.15, 0.5, 1.1, 1.0, 0.5)
#: Added to the lines and words that repeats are measured against: one repeated line in a
#: short document is weak evidence.
PRIOR_LINES, PRIOR_WORDS = 10, 100
P = len(LEAST_SD)
#: Chi-square with 5 degrees of freedom: the median and the quantile at 1 - 1e-6.
CHI2_MEDIAN, CHI2_CUTOFF = 4.3515, 36.5
#: A normal standard deviation over its median absolute deviation.
MAD_SCALE = 1.4826
BINS_PER_OCTAVE = 8

Z = [f"z{j}" for j in range(P)]
PAIRS = [(j, k) for j in range(P) for k in range(j + 1)]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def with_counts(df: DataFrame, text: str) -> DataFrame:
    """Adds COUNTS, n_upper and n_lines of the column ``text`` (longs)."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn("__w", word_array(t))
    df = df.withColumn("__lines", F.filter(F.split(t, "\n"), lambda x: _without(x, SPACE_CHARS) > 0))
    w = F.col("__w")
    # 3-word windows with their positions, sorted: equal windows become neighbours
    windows = F.transform(
        F.when(F.size(w) >= 3, F.slice(w, F.lit(1), F.size(w) - 2)).otherwise(F.array().cast("array<string>")),
        lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")))
    df = df.withColumn("__s", F.sort_array(windows))
    s = F.col("__s")
    twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
    covered = F.flatten(F.transform(twice, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
    return (df.select("*",
                      F.size(w).cast("long").alias("n_words"),
                      _without(t, SPACE_CHARS).cast("long").alias("word_chars"),
                      (F.length(t) - _without(t, SYMBOLS)).cast("long").alias("n_symbols"),
                      (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
                      F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"),
                      (F.length(t) - _without(t, UPPER)).cast("long").alias("n_upper"),
                      F.size("__lines").cast("long").alias("n_lines"))
            .drop("__w", "__lines", "__s"))


def _vector() -> list[Column]:
    def fixed(x: Column) -> Column:
        return F.round(x * UNIT).cast("long")

    def percent(part: str, of: str, prior: int = 0) -> Column:
        return F.log2(F.lit(1.0) + 100.0 * F.col(part) / F.greatest(F.col(of) + prior, F.lit(1)))

    length = F.log2(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1)))
    stats = [length, percent("n_symbols", "word_chars"), percent("n_dup_lines", "n_lines", PRIOR_LINES),
             percent("n_repeat_words", "n_words", PRIOR_WORDS), percent("n_upper", "word_chars")]
    return [fixed(x).alias(z) for x, z in zip(stats, Z)]


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _groups(rows: DataFrame) -> DataFrame:
    """(gkey, label): the group itself, the pool of its language's small groups, or LAST, the pool of all documents."""
    counted = rows.groupBy("gkey", "lkey").agg(F.count("*").alias("n"))
    few = F.col("n") < MIN_GROUP
    pools = (counted.where(few).groupBy(F.col("lkey").alias("pkey"))
             .agg(F.sum("n").alias("pool")).where(F.col("pool") >= MIN_GROUP))
    joined = counted.join(pools, F.col("lkey") == F.col("pkey"), "left")
    return joined.select("gkey", F.when(~few, F.col("gkey")).otherwise(F.coalesce("pkey", F.lit(LAST))).alias("label"))


def _factor(df: DataFrame, cov) -> DataFrame:
    """Adds the lower Cholesky factor l_j_k of the scatter given by ``cov(j, k)``."""
    for j, k in PAIRS:
        s = cov(j, k)
        for i in range(k):
            s = s - F.col(f"l_{j}_{i}") * F.col(f"l_{k}_{i}")
        # the ridge keeps every pivot at or above its least variance
        s = F.sqrt(F.greatest(s, F.lit((LEAST_SD[j] * UNIT) ** 2))) if j == k else s / F.col(f"l_{k}_{k}")
        df = df.withColumn(f"l_{j}_{k}", s)
    return df.select("label", *[f"m{j}" for j in range(P)], *[f"l_{j}_{k}" for j, k in PAIRS],
                     *[c for c in ("cutoff",) if c in df.columns])


def _start(rows: DataFrame) -> DataFrame:
    """Coordinatewise medians and median absolute deviations: the first centre and scatter."""
    half = F.lit(0.5)
    middle = save(rows.groupBy("label").agg(*[F.percentile(z, half).alias(f"m{j}") for j, z in enumerate(Z)]), "mcd_middle")
    off = rows.join(small(middle), "label").select("label", *[F.abs(F.col(z) - F.col(f"m{j}")).alias(z) for j, z in enumerate(Z)])
    spread = off.groupBy("label").agg(*[(F.percentile(z, half) * MAD_SCALE).alias(f"s{j}") for j, z in enumerate(Z)])
    return _factor(middle.join(spread, "label"), lambda j, k: F.col(f"s{j}") ** 2 if j == k else F.lit(0.0))


def _distance(rows: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance, by forward substitution."""
    for j in range(P):
        y = F.col(f"z{j}") - F.col(f"m{j}")
        for k in range(j):
            y = y - F.col(f"l_{j}_{k}") * F.col(f"y{k}")
        rows = rows.withColumn(f"y{j}", y / F.col(f"l_{j}_{j}"))
    return rows.withColumn("d2", sum((F.col(f"y{j}") * F.col(f"y{j}") for j in range(1, P)), F.col("y0") * F.col("y0")))


def _bins(rows: DataFrame, model: DataFrame, sums: list[Column]) -> DataFrame:
    """Counts and sums per label and distance bin, with the running count and total."""
    d = _distance(rows.join(small(model), "label"))
    b = F.floor(F.log2(F.col("d2") + 2.0 ** -10) * BINS_PER_OCTAVE).cast("int")
    cells = d.groupBy("label", b.alias("bin")).agg(F.count("*").alias("n"), *sums)
    w = Window.partitionBy("label").orderBy("bin")
    return cells.withColumn("below", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy("label")))


def _step(rows: DataFrame, model: DataFrame) -> DataFrame:
    """One concentration step: centre and scatter of the nearest COVERED share."""
    sums = ([F.sum(z).alias(z) for z in Z]
            + [F.sum(F.col(Z[j]) * F.col(Z[k])).alias(f"c_{j}_{k}") for j, k in PAIRS])
    cells = _bins(rows, model, sums)
    near = cells.where(F.col("below") - F.col("n") < F.ceil(F.col("total") * COVERED))
    got = near.groupBy("label").agg(F.sum("n").alias("n"), *[F.sum(z).alias(z) for z in Z],
                                    *[F.sum(f"c_{j}_{k}").alias(f"c_{j}_{k}") for j, k in PAIRS])
    got = got.select("label", "n", *[(F.col(z) / F.col("n")).alias(f"m{j}") for j, z in enumerate(Z)],
                     *[(F.col(f"c_{j}_{k}") / F.col("n")).alias(f"c_{j}_{k}") for j, k in PAIRS])
    return _factor(got, lambda j, k: F.col(f"c_{j}_{k}") - F.col(f"m{j}") * F.col(f"m{k}"))


def _fit(rows: DataFrame) -> DataFrame:
    """(label, centre, factor, cutoff) of every group of ``rows`` (label and vectors)."""
    start = model = save(_start(rows), "mcd")
    for _ in range(STEPS):
        model = save(_step(rows, model), "mcd")
    # the scatter of the nearest share is too narrow: stretch it to the median distance
    cells = _bins(rows, model, [])
    middle = (cells.where(F.col("below") * 2 >= F.col("total")).groupBy("label").agg(F.min("bin").alias("bin"), F.max("total").alias("total"))
              .select("label", "total", F.greatest(F.lit(1.0), F.pow(F.lit(2.0), (F.col("bin") + 1) / BINS_PER_OCTAVE)
                                                   / CHI2_MEDIAN).alias("stretch")))
    middle = small(save(middle, "mcd"))
    fitted = model.join(middle.where(F.col("total") >= MIN_GROUP), "label").withColumn("cutoff", F.col("stretch") * CHI2_CUTOFF)
    # too few for a scatter of their own: the least one, uncorrelated
    few = start.join(middle.where(F.col("total") < MIN_GROUP), "label").withColumn("cutoff", F.lit(CHI2_CUTOFF))
    return save(fitted.drop("stretch", "total").unionByName(_factor(few, lambda j, k: F.lit(0.0))), "mcd")


READ = ["doc_id", "text", "lang", "source"]


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, content key, COUNTS, base_failed, d2, cutoff, kept) of every row; no texts."""
    base = docs.select(field(docs, "doc_id", "long").alias("doc_id"), *content_key(docs, READ), field(docs, "text").alias("__text"),
                       F.to_json(F.struct(field(docs, "lang").alias("l"))).alias("lkey"),
                       F.to_json(F.struct(field(docs, "lang").alias("l"), field(docs, "source").alias("s"))).alias("gkey"))
    counted = with_counts(base, "__text").drop("__text")
    stats = save(counted.select("doc_id", *KEY, "lkey", "gkey", *COUNTS, _base_failed().alias("base_failed"), *_vector()), "quality")
    passing = stats.where(~F.col("base_failed"))
    groups = save(_groups(passing.select("gkey", "lkey")), "mcd_groups")
    members = groups
    if not groups.where(F.col("label") == LAST).isEmpty():  # what is left is held against all documents
        members = groups.unionByName(groups.where(F.col("label") != LAST).withColumn("label", F.lit(LAST)))
    labelled = save(passing.select("gkey", *Z).join(small(members), "gkey")
                    .select("label", *Z), "mcd_rows")
    model = groups.join(_fit(labelled), "label").drop("label")
    judged = _distance(stats.join(small(save(model, "mcd")), "gkey", "left"))
    kept = ~F.col("base_failed") & (F.col("d2") <= F.col("cutoff"))
    return judged.select("doc_id", *KEY, *COUNTS, "base_failed", F.when(~F.col("base_failed"), F.col("d2")).alias("d2"),
                         F.col("cutoff"), kept.alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    rejected = save(score(docs).where(~F.col("kept")).select(*KEY).distinct(), "quality_rejected")
    return with_key(docs, READ).join(small(rejected), KEY, "left_anti").select(*unpacked(docs, docs.columns))


def digest(docs: DataFrame) -> DataFrame:
    return score(docs).select("doc_id", *COUNTS, "base_failed", "kept", "d2")
