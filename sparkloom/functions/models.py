"""Models as functions: completion and scoring by batches, loaded once in each task."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def stub_completer() -> Callable[[list[str], list[int]], list[str]]:
    """The completer of tests: always the same instruction."""
    return lambda prompts, max_new_tokens: ["addi t0, t0, 1"] * len(prompts)


def by_batch(f: Callable[..., list], first: pd.Series, *others: pd.Series) -> pd.Series:
    """f over the rows whose first value is not null, all at once; null for the others."""
    there = first.notna()
    out = pd.Series([None] * len(first), dtype=object)
    if there.any():
        out[there.to_numpy()] = pd.Series(f(*(list(x[there]) for x in (first, *others))), dtype=object).to_numpy()
    return out


def complete_udf(load: Callable[[], Callable[[list[str], list[int]], list[str]]] = stub_completer) -> Callable[[Column, Column], Column]:
    """complete(prompt, max_new_tokens) -> text; the model gets batches."""

    @F.pandas_udf("string")
    def complete(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = load()
        for prompts, budgets in batches:
            yield by_batch(model, prompts, budgets)

    return complete


def token_losses_udf(load: Callable[[], Callable[[list[list[int]]], list[list[float]]]]) -> Callable[[Column], Column]:
    """token_losses(ids) -> losses, one for each id; the model gets batches."""

    @F.pandas_udf("array<double>")
    def losses(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for ids in batches:
            yield by_batch(lambda rows: [list(x) for x in model([list(x) for x in rows])], ids)

    return losses


def mean_loss(losses: Column, labels: Column) -> Column:
    """Mean loss over labels that are not ignored; null if there is none."""
    kept = F.filter(F.zip_with(losses, labels, lambda x, y: F.when(y != -100, x)), lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.aggregate(kept, F.lit(0.0), lambda a, x: a + x) / F.size(kept))
