"""Scores of generated against reference texts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalise
from ..functions.tokens import whitespace_tokens


def matches(pairs: DataFrame) -> DataFrame:
    """Adds exact and prefixed: equality, and whether the generated text begins with the reference, normalised."""
    ref, gen = normalise(F.col("reference")), normalise(F.col("generated"))
    return pairs.withColumn("exact", F.equal_null(ref, gen)).withColumn("prefixed", F.coalesce(F.startswith(gen, ref), F.lit(False)))


def percentage(flag: str) -> Column:
    return F.avg(F.col(flag).cast("int")) * 100


def match_report(pairs: DataFrame) -> DataFrame:
    """One row: n, exact_match_pct, prefix_match_pct (null without rows)."""
    return matches(pairs).agg(F.count("*").alias("n"), percentage("exact").alias("exact_match_pct"), percentage("prefixed").alias("prefix_match_pct"))


def error_slices(pairs: DataFrame, key: str, k: int = 3) -> DataFrame:
    """The first k rows by key of `close` (begins with the reference, not equal) and of `wrong` ones."""
    marked = matches(pairs).withColumn("slice", F.when(~F.col("prefixed"), "wrong").when(~F.col("exact"), "close"))
    first = [marked.filter(F.col("slice") == s).orderBy(key).limit(k) for s in ("close", "wrong")]
    return first[0].unionByName(first[1])


def tokens_13a(text: Column) -> Column:
    """The usual tokenization of machine-translation scores, from its published rules."""
    t = F.regexp_replace(text, r"\s+\z", "")
    for old, new in (("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        t = F.replace(t, F.lit(old), F.lit(new))
    t = F.concat(F.lit(" "), t, F.lit(" "))
    for rule, by in ((r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "), (r"([^0-9])([\.,])", "$1 $2 "), (r"([\.,])([^0-9])", " $1 $2"), (r"([0-9])(-)", "$1 $2 ")):
        t = F.regexp_replace(t, rule, by)
    return whitespace_tokens(t)


def _ngrams(tokens: Column, side: str, n: int) -> Column:
    """Structs of side, n and gram; none if there are fewer than n tokens."""
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.size(tokens) - (n - 1), F.lit(1))), lambda i: i + (n - 1) <= F.size(tokens))
    return F.transform(places, lambda i: F.struct(F.lit(side).alias("side"), F.lit(n).alias("n"), F.array_join(F.slice(tokens, i, n), " ").alias("gram")))


def bleu_counts(pairs: DataFrame, key: str, tokens: object = whitespace_tokens, longest: int = 4) -> DataFrame:
    """One row: sums over all pairs of matched_n and total_n, and lengths ref_len, hyp_len.

    Pairs are read and tokenized once. n-grams of a pair are counted and clipped within the pair; a shuffle by
    (pair, n, gram) spreads long pairs.
    """
    rows = pairs.select(F.col(key).alias("_key"), tokens(F.coalesce(F.col("reference"), F.lit(""))).alias("_r"), tokens(F.coalesce(F.col("generated"), F.lit(""))).alias("_h"))
    grams = F.concat(*[_ngrams(F.col(c), side, n) for side, c in (("r", "_r"), ("h", "_h")) for n in range(1, longest + 1)])
    each = rows.select("_key", F.explode(grams).alias("_g")).select("_key", "_g.*")
    counted = each.groupBy("_key", "n", "gram").agg(F.count_if(F.col("side") == "r").alias("r"), F.count_if(F.col("side") == "h").alias("h"))
    return counted.agg(
        *[F.coalesce(F.sum(F.when(F.col("n") == n, F.least("r", "h"))), F.lit(0)).alias(f"matched_{n}") for n in range(1, longest + 1)],
        *[F.coalesce(F.sum(F.when(F.col("n") == n, F.col("h"))), F.lit(0)).alias(f"total_{n}") for n in range(1, longest + 1)],
        F.coalesce(F.sum(F.when(F.col("n") == 1, F.col("r"))), F.lit(0)).alias("ref_len"),
        F.coalesce(F.sum(F.when(F.col("n") == 1, F.col("h"))), F.lit(0)).alias("hyp_len"),
    )


def bleu(counts: DataFrame, longest: int = 4) -> DataFrame:
    """Adds bleu (0 to 100): the geometric mean of the corpus' precisions times the brevity penalty.

    The k-th precision without a match counts as 1 / (2 ** k * total); no match at all, or an order without any
    n-gram, gives 0.
    """
    logs, zeros = F.lit(0.0), F.lit(0)
    for n in range(1, longest + 1):
        m, t = F.col(f"matched_{n}").cast("double"), F.col(f"total_{n}").cast("double")
        zeros = zeros + F.when((m == 0) & (t > 0), 1).otherwise(0)
        logs = logs + F.when(t == 0, F.lit(None)).when(m == 0, -F.log(F.pow(F.lit(2.0), zeros) * t)).otherwise(F.log(m / F.nullif(t, F.lit(0.0))))
    brevity = F.when((F.col("hyp_len") > 0) & (F.col("hyp_len") < F.col("ref_len")), F.exp(1 - F.col("ref_len") / F.col("hyp_len"))).otherwise(1.0)
    return counts.withColumn("bleu", F.when(F.col("matched_1") == 0, 0.0).otherwise(F.coalesce(100 * brevity * F.exp(logs / longest), F.lit(0.0))))


def reference_length(prompt_ids: Column, full_ids: Column, window: int = 512) -> Column:
    """Reference tokens that a model sees: the full text is cut to the window, the prompt alone is not."""
    return F.least(F.size(full_ids), F.lit(window)) - F.size(prompt_ids)


def metric_row(loss: Column, runtime: Column, rows: Column, steps: Column, epoch: Column) -> Column:
    """The evaluation's metrics as one struct: loss, runtime in seconds, rows and steps a second, epoch."""
    rate = lambda n: F.round(F.try_divide(n, runtime), 3)
    return F.struct(loss.alias("eval_loss"), runtime.alias("eval_runtime"), rate(rows).alias("eval_samples_per_second"), rate(steps).alias("eval_steps_per_second"), epoch.alias("epoch"))


def perplexity(loss: Column) -> Column:
    """exp(loss); null where that is not finite."""
    p = F.exp(loss)
    return F.when(~F.isnan(p) & (p < float("inf")), p)


def perplexity_report(rows: DataFrame, loss: str = "loss", reference_length: str = "ref_len") -> DataFrame:
    """One row: avg_perplexity (mean of the rows' own), used, skipped (no reference tokens, or not finite)."""
    p = F.when(F.col(reference_length) > 0, perplexity(F.col(loss)))
    return rows.withColumn("_p", p).agg(F.avg("_p").alias("avg_perplexity"), F.count("_p").alias("used"), F.count_if(F.col("_p").isNull()).alias("skipped"))
