"""Context of a cursor in a document's lines, and what kind of suggestion is asked for."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import JS_SPACE, starts_with_any, strip, strip_end, strip_start


def context_windows(rows: DataFrame, cursor: Column, before: int = 40, after: int = 20, id_col: str = "doc_id") -> DataFrame:
    """Adds prefix and suffix of the cursor (characters left of it in its line).

    prefix: up to `before` earlier lines and the line's left part, start trimmed; suffix: the line's right part
    and up to `after` later lines, end trimmed. A window over a document's lines holds so many lines at most.
    """
    order = Window.partitionBy(id_col).orderBy("line_no")
    left, right = F.substring("line", F.lit(1), cursor), F.substring(F.col("line"), cursor + 1, F.length("line"))
    above = F.collect_list("line").over(order.rowsBetween(-before, -1))
    below = F.collect_list("line").over(order.rowsBetween(1, after))
    return rows.select(
        "*",
        strip_start(F.array_join(F.concat(above, F.array(left)), "\n")).alias("prefix"),
        strip_end(F.array_join(F.concat(F.array(right), below), "\n")).alias("suffix"),
    )


def previous_line(id_col: str = "doc_id") -> Column:
    """The line above, trimmed; empty for the first line."""
    return F.coalesce(strip(F.lag("line").over(Window.partitionBy(id_col).orderBy("line_no")), JS_SPACE), F.lit(""))


def suggestion_type(previous: Column) -> Column:
    return F.when(F.startswith(previous, F.lit("#")) & (F.length(previous) > 1), "comment-to-code").otherwise("realtime")


def token_budget(kind: Column) -> Column:
    return F.when(kind == "comment-to-code", 150).otherwise(50)


def suppressed(line: Column) -> Column:
    """Whether a line asks for no suggestion: comments and directives."""
    return starts_with_any(strip_start(line), ("#", "."))


def asks(line: Column, prefix: Column) -> Column:
    """Whether a suggestion is asked for: the line is not suppressed and the prefix, its start trimmed, is not empty."""
    return ~suppressed(line) & (strip_start(prefix) != "")


def shown(suggestion: Column, request: Column, newest: Column) -> Column:
    """Whether a suggestion is shown: its request is still the newest one, and there is something to show."""
    return F.coalesce((request == newest) & (strip(suggestion, JS_SPACE) != ""), F.lit(False))


def feedback(choice: Column) -> Column:
    """1 for helpful, 0 for not helpful, null if dismissed."""
    return F.when(choice == "helpful", 1).when(choice == "not helpful", 0)


def latest(rows: DataFrame, key: str, request: str) -> DataFrame:
    """The row with the largest request number of each key: partial maxima are shuffled, not rows."""
    rest = [c for c in rows.columns if c not in (key, request)]
    best = rows.groupBy(key).agg(F.max(F.struct(request, *rest)).alias("_best"))
    return best.select(key, "_best.*")


def debounce(rows: DataFrame, key: str, ts: str, request: str, gap: str) -> DataFrame:
    """The last request of each burst: (key, fires_at, request, n); a pause of more than gap ends a burst."""
    burst = F.session_window(F.col(ts).cast("timestamp"), gap)
    out = rows.groupBy(key, burst.alias("burst")).agg(F.max(F.struct(F.col(ts), F.col(request))).alias("_last"), F.count("*").alias("n"))
    return out.select(key, F.col("burst.end").alias("fires_at"), F.col(f"_last.{request}").alias(request), "n")
