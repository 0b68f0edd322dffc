"""Feedback: requests, validation, defaults, the rating table and the retry queue."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..config import DEFAULT
from ..functions.text import iso_timestamp

#: Words for true and false in requests, and the message that a rating was stored.
YES, NO = ("true", "t", "yes", "y", "on", "1"), ("false", "f", "no", "n", "off", "0")
SAVED = "Rating saved"


def _typed(body: Column, name: str, kind: T.DataType) -> tuple[Column, Column, Column]:
    """(value, whether the field is there, whether its JSON type is right) by the usual lax rules of web requests:
    texts are texts only; whole numbers, also as 1.0, true or "1", are integers; 0, 1 and words for yes and no are booleans."""
    part = F.try_variant_get(body, f"$.{name}", "variant")
    found, text = F.coalesce(F.schema_of_variant(part), F.lit("")), F.try_variant_get(body, f"$.{name}", "string")
    if isinstance(kind, T.StringType):
        return text, part.isNotNull(), found == "STRING"
    word = F.lower(F.trim(text))
    if isinstance(kind, T.BooleanType):
        value = F.when(word.isin(*YES) | (F.try_to_number(word, F.lit("9D9")) == 1), True).when(word.isin(*NO) | (F.try_to_number(word, F.lit("9D9")) == 0), False)
    else:
        number = F.when(found == "BOOLEAN", F.when(word == "true", 1).otherwise(0)).otherwise(F.when(word.rlike(r"^[+-]?[0-9]+(\.0*)?$"), F.substring_index(word, ".", 1)).try_cast("decimal(38,0)"))
        value = F.when(number.isNotNull(), F.least(F.greatest(number, F.lit(-(1 << 31))), F.lit((1 << 31) - 1))).cast(kind)
    return value, part.isNotNull(), value.isNotNull() & ~found.rlike("^(OBJECT|ARRAY)")


def parse_requests(body: Column, schema: T.StructType, defaults: dict, required: tuple[str, ...]) -> tuple[Column, Column]:
    """(record, status) of JSON bodies: missing fields get defaults; 422 if the body is no JSON object, a required
    field is missing, or a field has a wrong type (null is one but for fields that may be null), else 200."""
    parsed = F.try_parse_json(body)
    fields, bad = [], ~F.coalesce(F.schema_of_variant(parsed), F.lit("")).startswith("OBJECT")
    for f in schema.fields:
        value, there, right = _typed(parsed, f.name, f.dataType)
        void = F.coalesce(F.schema_of_variant(F.try_variant_get(parsed, f"$.{f.name}", "variant")) == "VOID", F.lit(False))
        optional = f.name not in defaults and f.name not in required
        bad = bad | F.when(there, ~(right | void if optional else right)).otherwise(F.lit(f.name in required))
        fields.append((F.when(there, value).otherwise(F.lit(defaults[f.name])) if f.name in defaults else value).alias(f.name))
    bad = F.coalesce(bad, F.lit(True))
    return F.when(~bad, F.struct(*fields)), F.when(bad, 422).otherwise(200)


def response(status: Column, detail: Column, success: Column) -> Column:
    """The JSON body of an answer: success (a struct) for 200, else the reason."""
    return F.when(status == 200, F.to_json(success)).otherwise(F.to_json(F.struct(detail.alias("detail"))))


def saved() -> Column:
    return F.struct(F.lit(SAVED).alias("message"))


def generated(code: Column) -> Column:
    return F.struct(code.alias("generated_code"))


# Fixed values in the next two functions: the reasons that clients are told.


def generate_detail(prefix: Column, max_new_tokens: Column, longest: int = DEFAULT.max_input_length) -> Column:
    """Why a prompt is refused, the first reason; null if it is fine. Lengths are in code points."""
    return (
        F.when(F.coalesce(prefix, F.lit("")) == "", "Prefix is required")
        .when(max_new_tokens <= 0, "max_new_tokens must be greater than 0")
        .when(F.length(prefix) > longest, f"Prefix exceeds {longest} characters")
    )


def rating_detail(suggestion: Column, rating: Column, kind: Column) -> Column:
    """Why a rating is refused, the first reason; null if it is fine. A null rating is fine, and so is any prefix."""
    return (
        F.when(F.coalesce(suggestion, F.lit("")) == "", "Suggestion is required")
        .when(rating.isNotNull() & ~rating.isin(0, 1), "Rating must be 0 or 1")
        .when(~F.coalesce(kind, F.lit("")).isin("realtime", "comment-to-code"), "suggestion_type must be 'realtime' or 'comment-to-code'")
    )


def status(detail: Column) -> Column:
    return F.when(detail.isNull(), 200).otherwise(400)


def with_defaults(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Stored form: a missing or empty timestamp becomes now, accepted a number; ts is the parsed time."""
    now = iso_timestamp(F.current_timestamp()) if now is None else now
    out = rows.withColumn("timestamp", F.coalesce(F.nullif(F.col("timestamp"), F.lit("")), now)).withColumn("accepted", F.col("accepted").cast("int"))
    return out.withColumn("ts", F.try_to_timestamp("timestamp"))


def evolved(rows: DataFrame) -> DataFrame:
    """Rows of an older table with the columns that it lacks, at their defaults."""
    for name, (kind, default) in schemas.RATING_ADDED.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.expr(default).cast(kind))
    return rows.select(*schemas.RATING_TABLE.names)


def init_table(spark: SparkSession, table: str) -> None:
    """Creates the table if it is missing, else adds the columns that it lacks; may be repeated.

    Beside the columns of a rating it has request_key, which makes repeated writes of a request idempotent.
    """
    if not spark.catalog.tableExists(table):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" default {schemas.RATING_ADDED[f.name][1]}" if f.name in schemas.RATING_ADDED else "") for f in schemas.RATING_TABLE)
        spark.sql(f"create table {table} ({fields}, request_key string) using parquet")
        return
    have = {c.name for c in spark.catalog.listColumns(table)}
    for name, (kind, default) in schemas.RATING_ADDED.items():
        if name not in have:
            spark.sql(f"alter table {table} add column `{name}` {kind} default {default}")
    if "request_key" not in have:
        spark.sql(f"alter table {table} add column request_key string")


def save(spark: SparkSession, rows: DataFrame, table: str) -> None:
    """Appends valid rows with consecutive ids in the order of ts that follow the largest one; one writer at a time.

    Refused ratings are an error: the table has no constraint of its own. Rows are range partitioned and numbered
    there, the counts of the partitions give the offsets. The partitions are kept until the end, as another reading
    would sample other bounds. Rows may have a request_key.
    """
    spark.catalog.refreshTable(table)
    last = spark.table(table).agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    order = ["ts", *schemas.RATING_COLUMNS]
    detail = rating_detail(F.col("suggestion"), F.col("rating"), F.col("suggestion_type"))
    checked = with_defaults(rows).withColumn("rating", F.when(detail.isNull(), F.col("rating")).otherwise(F.raise_error(detail).cast("int")))
    if "request_key" not in rows.columns:
        checked = checked.withColumn("request_key", F.lit(None).cast("string"))
    placed = checked.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()).persist()
    try:
        pid = F.shiftright("_mid", 33)
        offsets, before = [], last
        for p, n in sorted(tuple(r) for r in placed.groupBy(pid.alias("p")).count().collect()):
            offsets.append((p, before))
            before += n
        at = spark.createDataFrame(offsets, "_pid long, _before long")
        numbered = placed.withColumn("_pid", pid).join(F.broadcast(at), "_pid").withColumn("id", F.col("_mid").bitwiseAND((1 << 33) - 1) + F.col("_before") + 1)
        have = [c.name for c in spark.catalog.listColumns(table)]
        kinds = {f.name: f.dataType for f in schemas.RATING_TABLE} | {"request_key": T.StringType()}
        numbered.select(*[F.col(c).cast(kinds[c]).alias(c) for c in have]).write.insertInto(table)
    finally:
        placed.unpersist()


def find_all(spark: SparkSession, table: str) -> DataFrame:
    """All rows without their ids, also those that a stream's own session has stored since."""
    spark.catalog.refreshTable(table)
    return spark.table(table).select(*schemas.RATING_COLUMNS).withColumn("accepted", F.col("accepted") == 1)


def flush(queue: DataFrame, stored_keys: DataFrame, key: str) -> DataFrame:
    """Retries a queue: adds state `delivered`, `duplicate` (its key is stored already, or an earlier valid row of the
    queue has it) or `parked` (refused).

    Rows come from one reading of the queue; what arrives meanwhile is not touched. Earlier is what comes first in
    that reading. The valid rows of a key are numbered within each partition of the queue, then the first ones of
    the partitions, and only those look for their key among the stored ones: no task gets all rows of a key. A null
    key is no duplicate of any.
    """
    detail = rating_detail(F.col("suggestion"), F.col("rating"), F.col("suggestion_type"))
    rows = queue.withColumn("detail", detail).withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id())
    valid = F.col("detail").isNull()
    nth = F.row_number().over(Window.partitionBy(key, "_part", valid).orderBy("_at"))
    rows = rows.withColumn("_part", F.when(valid & (nth == 1), -1).otherwise(F.col("_part")))
    first = (F.col("_part") == -1) & (F.row_number().over(Window.partitionBy(key, "_part").orderBy("_at")) == 1)
    rows = rows.withColumn("_first", F.col(key).isNull() | first)
    # An aggregate, as a constant would not be a key of the join, whose rows are dealt by key and _part already.
    known = stored_keys.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.lit(-1)).alias("_part")).withColumn("_known", F.lit(True))
    again = F.coalesce(F.col("_known"), F.lit(False)) | ~F.col("_first")
    state = F.when(F.col("detail").isNotNull(), "parked").when(again, "duplicate").otherwise("delivered")
    return rows.join(known, [key, "_part"], "left").withColumn("state", state).drop("_at", "_part", "_first", "_known")


def init_queue(spark: SparkSession, queue: str) -> None:
    """Creates the table of ratings that wait to be delivered; generations tell what a retry has left."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.RATING_REQUEST)
    spark.sql(f"create table if not exists {queue} (request_key string, {fields}, generation int) using parquet partitioned by (generation)")


def enqueue(spark: SparkSession, rows: DataFrame, queue: str) -> None:
    """Appends rows (request_key and the fields of a request) to the current generation of the queue."""
    now = spark.table(queue).agg(F.coalesce(F.max("generation"), F.lit(0))).first()[0]
    rows.select("request_key", *schemas.RATING_REQUEST.names, F.lit(now).alias("generation")).write.insertInto(queue)
    spark.catalog.refreshTable(queue)


def drain(spark: SparkSession, queue: str, table: str) -> dict[str, int]:
    """Retries the queue: stores what is valid and new, drops duplicates, keeps refused rows; counts by state.

    The refused rows become the next generation before the old ones are dropped, and stored rows have their keys,
    so that a repetition after a failure at any point stores nothing twice and loses nothing. Rows that are queued
    meanwhile belong to a generation that is not dropped. An empty queue is left as it is.
    """
    spark.catalog.refreshTable(queue)
    spark.catalog.refreshTable(table)
    old = [r[0] for r in spark.table(queue).select("generation").distinct().collect()]
    if not old:
        return {}
    spark.sql(f"alter table {queue} add if not exists partition (generation = {max(old) + 1})")
    rows = flush(spark.table(queue).filter(F.col("generation").isin(old)), spark.table(table).select("request_key"), "request_key").persist()
    try:
        counts = dict(tuple(r) for r in rows.groupBy("state").count().collect())
        save(spark, rows.filter("state = 'delivered'").select("request_key", *schemas.RATING_COLUMNS), table)
        parked = rows.filter("state = 'parked'").select("request_key", *schemas.RATING_REQUEST.names, F.lit(max(old) + 1).alias("generation"))
        parked.write.insertInto(queue)
    finally:
        rows.unpersist()
    for generation in old:
        spark.sql(f"alter table {queue} drop if exists partition (generation = {generation})")
    spark.catalog.refreshTable(queue)
    return counts
