"""Calls out of the pipeline: text -> vector and prompt -> response.

The functions a user supplies run in Arrow batches on the executors; only the
text column crosses to Python and all bookkeeping stays in column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundglean.functions.binding import let
from fundglean.functions.responses import (
    DUMMY_RESPONSE,
    PROMPT,
    fill_prompt,
    trustee_count,
    unwrap_json,
)
from fundglean.operators import batches
from fundglean.operators.relevance import METHODS
from fundglean.schemas import FILING_KEYS

Embed = Callable[[list[str]], Sequence[Sequence[float]]]
Ask = Callable[[list[str]], Sequence[str | None]]


class RequestLimits(NamedTuple):
    tokens: int
    chunks: int


# Limits of one request, for models that limit tokens alone or also texts.
TOKEN_LIMITED = RequestLimits(8_191, 99_999)
COUNT_LIMITED = RequestLimits(12_000, 250)
PROMPTS_PER_CALL = 16
REQUESTS_HELD = 16


def word_count(text: Column) -> Column:
    """Words apart from white space: the token counter where there is no other."""
    words = F.split(F.trim(text), r"\s+")
    return F.when(F.trim(text) == "", 0).otherwise(F.size(words))


def embedded(texts: Column, embed: Embed) -> Column:
    """Vectors of each row's array of texts, which make one request of a user's function."""

    kind = pa.list_(pa.list_(pa.float32()))

    def answered(request: list[str]) -> list[list[float]]:
        answer = list(embed(request))
        if len(answer) != len(request):
            raise ValueError("the embedding function must return one vector a text")
        return [list(v) for v in answer]

    @F.arrow_udf("array<array<float>>")
    def vectors(rows: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in rows:
            # Texts and vectors of few requests stand as Python values at a time.
            parts = (batch.slice(i, REQUESTS_HELD) for i in range(0, len(batch), REQUESTS_HELD))
            made = [pa.array([answered(r) for r in part.to_pylist()], kind, from_pandas=True) for part in parts]
            yield pa.concat_arrays(made) if made else pa.array([], kind)

    return vectors.asNondeterministic()(texts)


def embedded_chunks(
    chunks: DataFrame,
    text: str,
    embed: Embed,
    limits: RequestLimits = COUNT_LIMITED,
    count_tokens: Callable[[Column], Column] = word_count,
) -> DataFrame:
    """Keys, ``chunk_num`` and ``embedding`` of every chunk; batches of a filing are requests."""
    asked_for = batches.requests(chunks, text, count_tokens(F.col(text)), *limits)
    answered = asked_for.select(
        *FILING_KEYS, "items", embedded(F.col("items.text"), embed).alias("vectors")
    )
    zipped = F.arrays_zip(F.col("items.chunk_num").alias("chunk_num"), F.col("vectors").alias("embedding"))
    return answered.select(*FILING_KEYS, F.inline(zipped))


def skip_model(prompts: list[str]) -> list[str]:
    """Stands in for a model where calls are to be skipped."""
    return [DUMMY_RESPONSE] * len(prompts)


def tried(ask: Ask, prompts: list[str]) -> list[tuple[str | None, str | None]]:
    """An answer or an error for each prompt; a call that fails is repeated prompt by prompt."""
    try:
        answers = list(ask(prompts))
        if len(answers) != len(prompts):
            raise ValueError("the model function must return one answer a prompt")
        return [(a, None) for a in answers]
    except Exception as error:  # a failed call counts as no response
        if len(prompts) == 1:
            return [(None, f"{type(error).__name__}: {error}")]
        return [tried(ask, [p])[0] for p in prompts]


def asked(prompt: Column, ask: Ask, prompts_per_call: int = PROMPTS_PER_CALL) -> Column:
    """``response`` and ``error`` of each prompt; a NULL prompt is not sent."""

    @F.pandas_udf("response string, error string")
    def responses(rows: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in rows:
            out: list[tuple] = [(None, None)] * len(series)
            sent = [i for i, p in enumerate(series) if p is not None]
            for first in range(0, len(sent), prompts_per_call):
                some = sent[first : first + prompts_per_call]
                for i, got in zip(some, tried(ask, [series.iloc[i] for i in some])):
                    out[i] = got
            yield pd.DataFrame(out, columns=["response", "error"], dtype=object)

    return responses.asNondeterministic()(prompt)


def answer(candidate: Column, response: Column, error: Column | None = None) -> Column:
    """What is kept of one try."""
    error = F.lit(None).cast("string") if error is None else error
    return let(
        response,
        lambda r: F.struct(
            candidate["ordinal"].alias("ordinal"),
            candidate["chunks"].alias("chunks"),
            candidate["text"].alias("text"),
            r.alias("response"),
            trustee_count(r).alias("n_trustee"),
            error.alias("error"),
        ),
    )


ANSWERS_TYPE = (
    "array<struct<ordinal:int,chunks:array<int>,text:string,response:string,n_trustee:int,"
    "error:string>>"
)


def ask_in_turn(
    candidates: DataFrame,
    ask: Ask,
    template: str = PROMPT,
    parallelism: int | None = None,
    prompts_per_call: int = PROMPTS_PER_CALL,
) -> DataFrame:
    """``answers`` of each filing's candidates, in order, up to the first accepted one.

    One narrow step per rule. A filing whose earlier candidate gave more than one
    trustee has no prompt in later steps, so nothing more is sent for it. A call
    that fails leaves no response and its error; the other answers stay.
    ``parallelism`` is the number of tasks that call; without it, those of the input.
    """
    if parallelism:
        candidates = candidates.repartition(parallelism, *FILING_KEYS)
    df = candidates.withColumn("answers", F.array().cast(ANSWERS_TYPE))
    for turn in range(len(METHODS)):
        candidate = F.get("candidates", F.lit(turn))
        unanswered = ~F.exists(
            "answers", lambda a: F.coalesce(a["n_trustee"] > 1, F.lit(False))
        )
        df = df.withColumn(
            "_prompt",
            F.when(unanswered & candidate.isNotNull(), fill_prompt(candidate["text"], template)),
        )
        df = df.withColumn("_raw", asked(F.col("_prompt"), ask, prompts_per_call))
        df = df.withColumn("_response", unwrap_json(F.col("_raw.response")))
        df = df.withColumn(
            "answers",
            F.when(
                F.col("_prompt").isNotNull(),
                F.array_append(
                    "answers", answer(candidate, F.col("_response"), F.col("_raw.error"))
                ),
            ).otherwise(F.col("answers")),
        ).drop("_prompt", "_raw", "_response")
    return df.select(*FILING_KEYS, "answers")


def answer_all(candidates: DataFrame, response: Callable[[Column], Column]) -> DataFrame:
    """``answers`` from a column expression of the candidate text (recorded or computed)."""
    return candidates.select(
        *FILING_KEYS,
        F.transform(
            "candidates", lambda c: answer(c, unwrap_json(response(c["text"])))
        ).alias("answers"),
    )
