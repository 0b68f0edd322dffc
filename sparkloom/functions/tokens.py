"""Token arrays: pluggable tokenizers, truncation, padding, labels and masks."""

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .models import by_batch

IGNORED = -100


def whitespace_tokens(text: Column) -> Column:
    """Runs of non-blank characters, as an array; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda x: x != "")


def hash_ids(tokens: Column) -> Column:
    """Ids of 24 bits from each token's md5: a vocabulary that needs no file."""
    return F.transform(tokens, lambda x: F.conv(F.substring(F.md5(x), 1, 6), 16, 10).cast("int"))


def tokenizer_udf(make: Callable[[], Callable[[list[str]], list[list[int]]]]) -> Callable[[Column], Column]:
    """A tokenizer of batches as an Arrow-batched function STRING -> ARRAY<INT>; `make` runs once in each task."""

    @F.pandas_udf("array<int>")
    def tokenize(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = make()
        for texts in batches:
            yield by_batch(encode, texts)

    return tokenize


def truncate(ids: Column, length: int = 512) -> Column:
    return F.slice(ids, 1, length)


def pad(ids: Column, length: Column | int = 512, value: Column | int = 0) -> Column:
    """At least `length` ids."""
    return F.concat(ids, F.array_repeat(F.lit(value) if isinstance(value, int) else value, F.greatest(F.lit(0), (F.lit(length) if isinstance(length, int) else length) - F.size(ids))))


def mask_prompt(ids: Column, prompt_length: Column) -> Column:
    """Labels: the ids, with the prompt's ignored."""
    return F.transform(ids, lambda x, i: F.when(i < prompt_length, F.lit(IGNORED)).otherwise(x))


def special_tokens(text: Column, markers: tuple[str, ...], first_id: int, tokens: object = whitespace_tokens) -> Column:
    """Ids of a text in which markers have ids of their own, first_id and so on in their order; what stands between
    them is tokenized by itself."""
    ids = F.create_map(*[x for i, m in enumerate(markers) for x in (F.lit(m), F.lit(first_id + i))])
    pattern = "|".join(re.escape(m) for m in markers)
    pieces = F.split(F.coalesce(text, F.lit("")), f"(?<={pattern})|(?={pattern})", -1)
    return F.flatten(F.transform(pieces, lambda p: F.when(p.isin(*markers), F.array(F.try_element_at(ids, p))).otherwise(hash_ids(tokens(p)))))


def collate(df: DataFrame, batch: str, ids: str, pad_id: int) -> DataFrame:
    """Pads the ids of each batch to its longest row: adds input_ids, attention_mask and labels.

    Labels are the ids with IGNORED for every pad id, also where it stands within a row. The batches' lengths are
    partial maxima; rows are joined with them.
    """
    longest = df.groupBy(batch).agg(F.max(F.size(ids)).alias("_longest"))
    rows = df.join(longest, batch)
    padded = pad(F.col(ids), F.col("_longest"), pad_id)
    mask = F.concat(F.transform(ids, lambda x: F.lit(1)), F.array_repeat(F.lit(0), F.col("_longest") - F.size(ids)))
    labels = F.transform(padded, lambda x: F.when(x == pad_id, F.lit(IGNORED)).otherwise(x))
    return rows.select(*df.columns, padded.alias("input_ids"), mask.alias("attention_mask"), labels.alias("labels"))


def pad_token(pad_value: Column, end_value: Column) -> Column:
    return F.coalesce(pad_value, end_value)


def id_to_token(ids: Column, vocabulary: Column) -> Column:
    """Tokens by a map of ids; unknown ids are null."""
    return F.transform(ids, lambda x: F.try_element_at(vocabulary, x))
