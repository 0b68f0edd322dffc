"""Schemas of requests, stored rows and results."""

from pyspark.sql import types as T

from .config import DEFAULT

_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def _fields(text: str) -> T.StructType:
    """A flat schema from `name kind, ...`; needs no session."""
    pairs = (x.split() for x in text.split(","))
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in pairs])


# Names, types and defaults of the fields of requests, of the rating table and of results.
PROMPT_REQUEST = _fields("prefix string, suffix string, max_new_tokens int")
RATING_REQUEST = _fields("prefix string, suffix string, suggestion string, rating int, suggestion_type string, accepted boolean, timestamp string")
#: Defaults of missing fields; fields without one are required.
PROMPT_DEFAULTS = {"suffix": "", "max_new_tokens": DEFAULT.default_max_new_tokens}
RATING_DEFAULTS = {"suffix": "", "suggestion_type": "realtime", "accepted": True, "timestamp": ""}
PROMPT_REQUIRED, RATING_REQUIRED = ("prefix",), ("prefix", "suggestion")

RATING_COLUMNS = ("prefix", "suffix", "suggestion", "rating", "suggestion_type", "accepted", "timestamp")
RATING_TABLE = _fields("id long, prefix string, suffix string, suggestion string, rating int, suggestion_type string, accepted int, timestamp string")
#: Columns that older tables may lack, with what their rows get.
RATING_ADDED = {"suffix": ("string", "''"), "suggestion_type": ("string", "'realtime'"), "accepted": ("int", "1"), "timestamp": ("string", "''")}

EXAMPLE = T.StructType([T.StructField("text", T.StringType())])
RUN_RESULT = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("eval_results", _fields("eval_loss double, eval_runtime double, eval_samples_per_second double, eval_steps_per_second double, epoch double")),
    T.StructField("perplexity", T.DoubleType()),
])
