"""Chat requests, answers and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.operators.numbering import sequence

ROUTES = {1: "answer_1", 2: "answer_2", 3: "answer_3", 4: "answer_4"}


def chat(system: str, user: Column, assistant: Column | None = None) -> Column:
    """Array of (role, content) messages."""
    turns = [("system", F.lit(system)), ("user", user)] + ([("assistant", assistant)] if assistant is not None else [])
    return F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in turns])


def batch_request(df: DataFrame, custom_id: Column, messages: Column, model: str, temperature: float = 0.0) -> DataFrame:
    """One JSON line for each row of df."""
    body = F.struct(F.lit(model).alias("model"), messages.alias("messages"), F.lit(temperature).alias("temperature"))
    line = F.struct(custom_id.cast("string").alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v1/chat/completions").alias("url"), body.alias("body"))
    return df.select(F.to_json(line).alias("value"))


def few_shot(df: DataFrame, order: str, system: str, shots: list[tuple[str, str]], user: Column, model: str) -> DataFrame:
    """Requests with worked examples before the question, one JSON line for each
    row; the custom_id is the row's place by a unique integer order, from 1."""
    turns = [("system", F.lit(system)), *[(role, F.lit(text)) for shot in shots for role, text in zip(("user", "assistant"), shot, strict=True)], ("user", user)]
    messages = F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in turns])
    return batch_request(sequence(df, order, "_place"), F.col("_place"), messages, model)


def answer(content: Column) -> Column:
    """The digit behind "answer" in either quoting; anything else is null.
    White space around the colon is allowed."""
    return F.nullif(F.regexp_extract(F.coalesce(content, F.lit("")), r"""answer[\\"']+\s*:\s*[\\"']*(\d)""", 1), F.lit("")).try_cast("int")


def route(number: Column) -> Column:
    out = F.when(number == 1, ROUTES[1])
    for n in (2, 3, 4):
        out = out.when(number == n, ROUTES[n])
    return out.otherwise("invalid")


def verdict(content: Column, yes: str = "YES", no: str = "NO") -> Column:
    """True, false, or null where the answer is neither word exactly."""
    said = F.trim(content)
    return F.when(said == yes, True).when(said == no, False)
