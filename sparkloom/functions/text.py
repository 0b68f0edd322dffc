"""Text functions as Column expressions: all run inside the JVM."""

import functools
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT

#: The characters that Python's str.strip and JavaScript's trim take for white space (the latter has
#: U+FEFF as well, but not U+001C to U+001F and U+0085).
_BOTH = "\t\n\x0b\x0c\r \xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
PY_SPACE = _BOTH + "\x1c\x1d\x1e\x1f\x85"
JS_SPACE = _BOTH + "\ufeff"


def strip(text: Column, space: str = PY_SPACE) -> Column:
    return F.btrim(text, F.lit(space))


def strip_start(text: Column, space: str = JS_SPACE) -> Column:
    return F.ltrim(text, F.lit(space))


def strip_end(text: Column, space: str = JS_SPACE) -> Column:
    return F.rtrim(text, F.lit(space))


def normalise(text: Column) -> Column:
    """Comments cut at '#' up to the line feed, runs of blanks and tabs as one space, stripped, lower case."""
    uncommented = F.when(F.contains(text, F.lit("#")), F.regexp_replace(text, "(?d)#.*", "")).otherwise(text)
    # A lone space stays as it is; only other runs are replaced.
    return F.lower(strip(F.regexp_replace(uncommented, "\t[ \t]*| [ \t]+", " ")))


def cut_comment(line: Column) -> Column:
    """The line before its first '#', stripped."""
    return strip(F.substring_index(line, "#", 1))


def first_token(line: Column) -> Column:
    """The first run of non-blank characters; empty if there is none."""
    return F.regexp_extract(line, r"^\s*(\S+)", 1)


def fim_prompt(prefix: Column, suffix: Column, tokens: tuple[str, str, str] = DEFAULT.markers) -> Column:
    """Prompt that asks for what stands between prefix and suffix; null parts are empty."""
    p, s, m = tokens
    empty = F.lit("")
    return F.concat(F.lit(p), F.coalesce(prefix, empty), F.lit(s), F.coalesce(suffix, empty), F.lit(m))


def parse_fim(text: Column, strict: bool = False, tokens: tuple[str, str, str] = DEFAULT.markers) -> Column:
    """struct(prefix, suffix, reference, valid) of an example.

    prefix is what stands before the first suffix marker, without any prefix marker; suffix stands between it
    and the next marker; reference is the piece after the first middle marker. A text without both markers is not
    valid and has nulls, or raises an error if strict.
    """
    p, s, m = (F.lit(t) for t in tokens)
    valid = F.coalesce(F.contains(text, s) & F.contains(text, m), F.lit(False))
    bad = F.raise_error(F.lit("example without markers")).cast("string") if strict else F.lit(None).cast("string")
    part = lambda c: F.when(valid, c).otherwise(bad)
    return F.struct(
        part(F.replace(F.split_part(text, s, F.lit(1)), p, F.lit(""))).alias("prefix"),
        part(F.split_part(F.split_part(text, s, F.lit(2)), m, F.lit(1))).alias("suffix"),
        part(F.split_part(text, m, F.lit(2))).alias("reference"),
        valid.alias("valid"),
    )


def after_prompt(generated: Column, prompt: Column) -> Column:
    """What a model wrote after its prompt, stripped; a text that does not start with the prompt is only stripped."""
    return strip(F.when(F.startswith(generated, prompt), F.substring(generated, F.length(prompt) + 1, F.length(generated))).otherwise(generated))


def after_prefix(generated: Column, prefix: Column) -> Column:
    """The client's form: trimmed first, then cut after the prefix and trimmed again."""
    got = strip(generated, JS_SPACE)
    return F.when(F.startswith(got, prefix), strip(F.substring(got, F.length(prefix) + 1, F.length(got)), JS_SPACE)).otherwise(got)


def starts_with_any(text: Column, heads: tuple[str, ...]) -> Column:
    return functools.reduce(or_, (F.startswith(text, F.lit(h)) for h in heads))


def preview(text: Column, n: int) -> Column:
    return strip(F.substring(text, 1, n))


def js_timestamp(ts: Column) -> Column:
    """A UTC time as clients write it, to milliseconds and with a Z."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def iso_timestamp(ts: Column) -> Column:
    """A UTC time as the server writes it, to microseconds and with an offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def run_stamp(ts: Column) -> Column:
    """A time as names of runs have it."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def architecture_targets(model_name: Column, rules: list[tuple[str, list[str]]], default: list[str]) -> Column:
    """Modules to adapt: those of the first rule whose key is in the lower-cased name, else the default."""
    arr = lambda xs: F.array(*[F.lit(x) for x in xs])
    chain = None
    for key, modules in rules:
        hit = F.contains(F.lower(model_name), F.lit(key))
        chain = F.when(hit, arr(modules)) if chain is None else chain.when(hit, arr(modules))
    return arr(default) if chain is None else chain.otherwise(arr(default))
