"""Chat formatting of reply trees with a reversible template and a loss mask."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import longs, materialise, numbered

#: A turn is HEAD + role + SEP + text + END.
HEAD, SEP, END = "### ", ": ", "</turn>\n"
#: Control characters and what stands for them after a backslash; the first is the backslash itself.
ESCAPES = (("\\", "\\\\"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))


def escape(text: Column, role: bool = False) -> Column:
    """The text without '<' and '#' (a role also without ':'), so that no control string is left in it."""
    for plain, coded in ESCAPES if role else ESCAPES[:3]:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    """The inverse of escape: pairs of backslashes are taken apart first, from the left."""
    pieces = F.split(text, r"\\\\", -1)

    def plain_piece(piece: Column) -> Column:
        for plain, coded in ESCAPES[1:]:
            piece = F.replace(piece, F.lit(coded), F.lit(plain))
        return piece

    return F.array_join(F.transform(pieces, plain_piece), "\\")


def climbs(spark: SparkSession, messages: DataFrame) -> list[DataFrame]:
    """Tables (tree, msg, up, n, score) by doubling self-joins: in table k, up is the message 2^k steps above, null
    beyond the root; n and score are the number and summed scores of the messages from msg to below up.

    The last table has the depth and score of every message's path from the root. Rounds end when every path has
    reached a root, or when they have covered all messages of the largest tree. A message whose parent is null or
    not there is a root. Messages on a cycle, or below one, never reach one. Only ids and numbers are joined; a
    message with very many replies is a skewed key of an inner or left join, which adaptive execution splits.
    """
    nodes = messages.select("tree", "msg", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    parents = nodes.select("tree", F.col("msg").alias("parent"), F.lit(True).alias("_is"))
    known = nodes.join(parents, ["tree", "parent"], "left")
    tables = [materialise(spark, known.select("tree", "msg", F.when(F.col("_is"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("n"), "score"), "climbs")]
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    for _ in range(largest.bit_length()):
        now = tables[-1]
        if now.filter("up is not null").isEmpty():
            break
        above = now.select("tree", F.col("msg").alias("up"), F.col("up").alias("_up"), F.col("n").alias("_n"), F.col("score").alias("_score"))
        longer = now.filter("up is not null").join(above, ["tree", "up"]).select("tree", "msg", F.col("_up").alias("up"), (F.col("n") + F.col("_n")).alias("n"), (F.col("score") + F.col("_score")).alias("score"))
        tables.append(materialise(spark, now.filter("up is null").unionByName(longer), "climbs"))
    return tables


def best_paths(spark: SparkSession, messages: DataFrame, best: int | None = 1) -> DataFrame:
    """(tree, branch, leaf, score, msg, place) of each message on the best root-to-leaf paths of each tree, all paths
    if best is None; place counts from the root.

    Paths are ranked by the sum of their scores (null: 0), then by length, longer first, then by their leaves. Their
    messages come from the leaves alone, by joins with the tables of doubled steps: paths of others are never rows.
    """
    tables = climbs(spark, messages)
    ended = tables[-1].filter("up is null").select("tree", "msg", "n", "score")
    replied = tables[0].filter("up is not null").select("tree", F.col("up").alias("msg")).distinct()
    leaves = ended.join(replied, ["tree", "msg"], "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("n"), "msg")
    ranked = leaves.withColumn("branch", F.row_number().over(order))
    chosen = ranked.filter(F.col("branch") <= best) if best else ranked
    rows = materialise(spark, chosen.select("tree", "branch", F.col("msg").alias("leaf"), "score", "msg", (F.col("n") - 1).alias("place")), "paths")
    for steps in tables[:-1]:
        up = steps.filter("up is not null").select("tree", "msg", "up", F.col("n").alias("_n"))
        above = rows.join(up, ["tree", "msg"]).select("tree", "branch", "leaf", "score", F.col("up").alias("msg"), (F.col("place") - F.col("_n")).alias("place"))
        rows = materialise(spark, rows.unionByName(above), "paths")
    return rows


def format_trees(spark: SparkSession, messages: DataFrame, best: int | None = 1, loss_role: str = "assistant") -> DataFrame:
    """Formats the best root-to-leaf paths of each tree (see best_paths) as one conversation each.

    messages has tree (any type but null), msg (unique in its tree), parent, role, text and score. Returns tree,
    branch (1 is best), leaf, score, path, formatted, and loss_spans: [start, length] in code points of the texts
    of loss_role in formatted.

    Null roles and texts are empty. Repeated messages must have been told apart before (see from_turns).
    An empty table gives an empty one; other columns are not read.
    """
    paths = best_paths(spark, messages, best)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = paths.join(messages.select("tree", "msg", "role", "text"), ["tree", "msg"])
    turns = turns.select("tree", "branch", "leaf", "score", "place", "msg", (role == loss_role).alias("_loss"), F.concat(F.lit(HEAD), escape(role, True), F.lit(SEP)).alias("_head"), escape(text).alias("_body"))
    # The end of each turn is a running sum of lengths.
    so_far = Window.partitionBy("tree", "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.length("_head") + F.length("_body") + len(END)).over(so_far)
    span = F.array(end - len(END) - F.length("_body"), F.length("_body").cast("long"))
    turn = F.struct("place", "msg", F.concat("_head", "_body", F.lit(END)).alias("written"), F.when(F.col("_loss"), F.col("_span")).alias("span"))
    rows = turns.withColumn("_span", span).groupBy("tree", "branch", "leaf", "score").agg(F.array_sort(F.collect_list(turn)).alias("_turns"))
    return rows.select(
        "tree", "branch", "leaf", "score",
        F.transform("_turns", lambda t: t["msg"]).alias("path"),
        F.array_join(F.transform("_turns", lambda t: t["written"]), "").alias("formatted"),
        F.filter(F.transform("_turns", lambda t: t["span"]), lambda x: x.isNotNull()).alias("loss_spans"),
    )


def parse(formatted: Column) -> Column:
    """Turns (role, text) read back from a formatted conversation."""
    turns = F.filter(F.split(formatted, END, -1), lambda x: x != "")
    return F.transform(
        turns,
        lambda x: F.struct(
            unescape(F.substring_index(F.substring(x, len(HEAD) + 1, 1 << 30), SEP, 1)).alias("role"),
            unescape(F.substring(x, F.instr(x, F.lit(SEP)) + len(SEP), F.lit(1 << 30))).alias("text"),
        ),
    )


def masked(formatted: Column, spans: Column, chunk: int = 4096) -> Column:
    """All text under the loss mask, unescaped and put together.

    Spans are cut from chunks of the text, as finding a place in a text means counting from its beginning.
    """
    chunks = F.transform(F.sequence(F.lit(0), F.floor(F.length(formatted) / chunk).cast("int")), lambda i: F.substring(formatted, i * chunk + 1, F.lit(chunk)))

    def cut(pieces: Column) -> Column:
        def one(s: Column) -> Column:
            first, last = F.floor(s[0] / chunk).cast("int"), F.floor((s[0] + s[1]) / chunk).cast("int")
            return unescape(F.substring(F.array_join(F.slice(pieces, first + 1, last - first + 1), ""), (s[0] % chunk + 1).cast("int"), s[1].cast("int")))

        return F.array_join(F.transform(spans, one), "")

    # The lambda holds the chunks, so that they are made once for all spans.
    return F.transform(F.array(chunks), cut)[0]


def from_turns(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Flat conversations as trees: rows of a conversation by turn, each a reply to the one before.

    Rows with the same turn, or none (first), follow each other by role, then text; a null conv_id is one
    conversation of its own. tree is a text, so that null can be told from any id. All rows are sorted by range, a
    long conversation over several tasks, and numbered; a reply's parent is the number before, which is not in the
    tree if the message is its first.
    """
    tree = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("null"))
    rows = conversations.select(tree.alias("tree"), "conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("_scan"))
    placed = numbered(spark, rows, [F.col(c) for c in ("tree", "turn", "role", "text", "_scan")], "turns")
    before, offsets = 0, []
    for pid, n in sorted(tuple(r) for r in placed.groupBy("_pid").count().collect()):
        offsets.append((pid, before))
        before += n
    at = longs(spark, offsets or [(0, 0)], "_pid", "_before")
    msg = F.col("_before") + F.col("_at")
    return placed.join(F.broadcast(at), "_pid").select("tree", "conv_id", msg.alias("msg"), (msg - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))
