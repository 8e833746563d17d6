"""Prompt rendering and response extraction as column expressions."""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import constants as C


def render(template: str, fields: Mapping[str, Column]) -> Column:
    """Fill a named-field template; a field without a column is an error."""
    parts: list[Column] = []
    for literal, name, spec, conversion in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is None:
            continue
        if spec or conversion:
            raise ValueError(f"only plain fields are supported, got {{{name}}} with a format")
        if name not in fields:
            raise KeyError(f"template field {name!r} is not a column")
        parts.append(fields[name].cast("string"))
    return F.concat(*parts) if parts else F.lit("")


def render_template(df: DataFrame, template: str, out: str = "prompt") -> DataFrame:
    """Render a template from the columns of ``df``."""
    return df.withColumn(out, render(template, {name: F.col(name) for name in df.columns}))


def prompt_sql(question: Column, context: Column, output: Column | None = None) -> Column:
    """Instruction with input, context and response sections; no output gives an open response."""
    answer = F.lit("") if output is None else F.coalesce(output, F.lit(""))
    fields = {"question": question, "context": F.coalesce(context, F.lit("")), "output": answer}
    return render(C.SQL_TEMPLATE, fields)


def prompt_by_context(question: Column, context: Column) -> Column:
    """Question prompt, with the context section only when there is a context."""
    blank = context.isNull() | (strip(context) == "")
    with_context = render(C.WITH_CONTEXT_TEMPLATE, {"question": question, "context": context})
    return F.when(blank, render(C.WITHOUT_CONTEXT_TEMPLATE, {"question": question})).otherwise(with_context)


def prompt_support(query: Column) -> Column:
    return render(C.SUPPORT_TEMPLATE, {"query": query})


def prompt_turns(turns: Column) -> Column:
    """Text of the first two items of a turn list; fewer than two items give NULL."""
    return render(C.TURNS_TEMPLATE, {"user": F.get(turns, F.lit(0)), "assistant": F.get(turns, F.lit(1))})


def strip(text: Column) -> Column:
    """Remove white space of every kind, no-break and wide blanks too, from both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def extract_response(output: Column, marker: str = C.RESPONSE_MARKER) -> Column:
    """Text after the first marker, up to the next one, stripped; NULL without a marker."""
    piece = F.split_part(output, F.lit(marker), F.lit(2))
    return F.when(F.contains(output, F.lit(marker)), strip(piece))


def strip_prompt(output: Column, prompt: Column) -> Column:
    """Output without its leading prompt; NULL when it does not start with the prompt."""
    rest = F.substring(output, F.char_length(prompt) + F.lit(1), F.char_length(output))
    return F.when(F.startswith(output, prompt), rest)
