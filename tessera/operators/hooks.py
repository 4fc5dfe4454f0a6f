"""User-model hooks: a text encoder and a text generator supplied by the
caller, run batch-wise over Arrow (``mapInPandas``) so the model is loaded
once per task and applied to whole batches, never row by row.

The library ships no model; embeddings and answers otherwise arrive as
columns of the input tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Encoder = Callable[[list[str]], np.ndarray]      # texts -> (n, dim) matrix
Generator = Callable[[list[str]], list[str]]     # prompts -> answers


def encode(df: DataFrame, text: str, encoder_factory: Callable[[], Encoder], out: str = "embedding") -> DataFrame:
    """Append ``out`` = encoder(text) as ARRAY<FLOAT>.  ``encoder_factory`` is
    called once per task (model loading), then every Arrow batch is encoded
    in one call."""
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder_factory()
        for pdf in batches:
            texts = pdf[text].fillna("").tolist()
            vecs = np.asarray(enc(texts), dtype=np.float32) if texts else np.zeros((0, 0), np.float32)
            pdf[out] = list(vecs)
            yield pdf

    return df.mapInPandas(run, schema)


def generate(df: DataFrame, prompt: str, generator_factory: Callable[[], Generator], out: str = "generated") -> DataFrame:
    """Append ``out`` = generator(prompt) (STRING).  A failing batch falls back
    to one call per prompt, and a failing prompt yields NULL, so one bad input
    does not stop the others."""
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gen = generator_factory()
        for pdf in batches:
            prompts = pdf[prompt].fillna("").tolist()
            try:
                answers = list(gen(prompts)) if prompts else []
            except Exception:  # noqa: BLE001 - isolate the failing prompt
                answers = []
                for p in prompts:
                    try:
                        answers.append(gen([p])[0])
                    except Exception:  # noqa: BLE001
                        answers.append(None)
            pdf[out] = answers
            yield pdf

    return df.mapInPandas(run, schema)
