"""Prompts, model requests, and applying a responder with per-row failure isolation."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.functions.strings import col
from evidentia.operators.context import separator
from evidentia.schema import (COMPLETION_CAP_MODELS, DEFAULT_MAX_TOKENS, DEFAULT_MODEL,
                              DEFAULT_TEMPERATURE, NO_TEMPERATURE_MODELS, SYSTEM_MESSAGE)

PAPER_LABEL = "RESEARCH PAPER:"

REQUEST_TYPE = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("messages", T.ArrayType(T.StructType([
        T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))),
    T.StructField("max_completion_tokens", T.IntegerType()),
    T.StructField("max_tokens", T.IntegerType()),
    T.StructField("temperature", T.DoubleType()),
])


def prompt_text(template: str, text, mode: str = "compat") -> Column:
    """template + blank line + 'RESEARCH PAPER:' + line break + text.

    In ``compat`` mode the breaks are the literal two characters backslash-n,
    as the original tool sends them."""
    sep = separator(mode)
    return F.concat(F.lit(template + sep + sep + PAPER_LABEL + sep), col(text))


def build_prompt(docs: DataFrame, template: str, text="text", mode: str = "compat") -> DataFrame:
    return docs.withColumn("prompt", prompt_text(template, text, mode))


def request_struct(prompt, model=DEFAULT_MODEL, max_tokens: int = DEFAULT_MAX_TOKENS,
                   temperature: float = DEFAULT_TEMPERATURE) -> Column:
    """The chat request; the cap goes to ``max_completion_tokens`` for newer
    model families, else ``max_tokens``; no temperature for models that only
    take the default."""
    m = col(model) if isinstance(model, Column) else F.lit(model)
    new_cap = None
    for name in COMPLETION_CAP_MODELS:
        hit = F.instr(m, name) > 0
        new_cap = hit if new_cap is None else new_cap | hit
    no_temp = None
    for name in NO_TEMPERATURE_MODELS:
        hit = F.instr(m, name) > 0
        no_temp = hit if no_temp is None else no_temp | hit
    cap = F.lit(max_tokens).cast("int")
    return F.struct(
        m.alias("model"),
        F.array(F.struct(F.lit("system").alias("role"), F.lit(SYSTEM_MESSAGE).alias("content")),
                F.struct(F.lit("user").alias("role"), col(prompt).alias("content")))
         .alias("messages"),
        F.when(new_cap, cap).alias("max_completion_tokens"),
        F.when(~new_cap, cap).alias("max_tokens"),
        F.when(~no_temp, F.lit(float(temperature))).alias("temperature"),
    )


def build_requests(df: DataFrame, prompt="prompt", model=DEFAULT_MODEL,
                   max_tokens: int = DEFAULT_MAX_TOKENS, temperature: float = DEFAULT_TEMPERATURE,
                   key: str = "doc_id") -> DataFrame:
    """``(key, request struct, request_json)``; ``to_json`` drops null fields."""
    r = request_struct(prompt, model, max_tokens, temperature)
    return (df.select(key, r.alias("request"))
              .withColumn("request_json", F.to_json("request")))


RESPONSE_SCHEMA = "response string, error string"


def _to_plain(v):
    if isinstance(v, dict):
        return {k: _to_plain(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [_to_plain(x) for x in v]
    if hasattr(v, "tolist"):
        return _to_plain(v.tolist())
    return v


def apply_responder(requests: DataFrame, fn, key: str = "doc_id",
                    request: str = "request_json") -> DataFrame:
    """``(key, response, error)``: ``fn(request_dict) -> str`` on every row.

    The request reaches ``fn`` as the dict a chat API takes: decoded from
    ``request_json`` (fields that are not set are absent, as ``to_json``
    drops nulls), or from a request struct with its null fields removed.
    Arrow batches through ``mapInPandas``; an exception becomes that row's
    ``error`` and never fails the task, so one bad paper cannot abort the
    batch. Stage retries call ``fn`` again: persist the result (Parquet in the
    shared folder) before joining, so each reply is paid for once.
    """
    key_type = requests.schema[key].dataType.simpleString()
    as_json = requests.schema[request].dataType.simpleString() == "string"

    def decode(raw):
        if as_json:
            return json.loads(raw)
        return {k: v for k, v in _to_plain(raw).items() if v is not None}

    def run(batches):
        for pdf in batches:
            replies, errors = [], []
            for raw in pdf[request]:
                try:
                    out = fn(decode(raw))
                    replies.append(None if out is None else str(out))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - failure isolation is the point
                    replies.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({key: pdf[key], "response": replies, "error": errors})

    return requests.select(key, request).mapInPandas(
        run, f"{key} {key_type}, {RESPONSE_SCHEMA}")


def persist_responses(responses: DataFrame, path: str) -> DataFrame:
    """Write replies once (Parquet) and read them back: later stages and
    retries reuse the stored replies instead of calling the responder again."""
    responses.write.mode("overwrite").parquet(path)
    return responses.sparkSession.read.parquet(path)
