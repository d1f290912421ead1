"""Model calls whose answers are kept, so that none is paid for twice.

Answers stand in a journal: a table laid out by run, a row for each prompt, known by the
hash of its text and the model. Prompts of each turn that have an answer there, from
any run, are not sent; the same prompt of several filings is sent once. Those sent are
dealt out so many to a task, and a task's answers are there for good as soon as it ends,
whatever becomes of the others and of the job. A task that is lost half-way sends
again only what it had been given, and with one call a task nothing that was answered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from fundglean import schemas
from fundglean.functions.responses import PROMPT, fill_prompt, trustee_count, unwrap_json
from fundglean.operators.calls import PROMPTS_PER_CALL, Ask, answer, asked
from fundglean.operators.lineage import cut_lineage
from fundglean.operators.relevance import METHODS
from fundglean.schemas import FILING_KEYS

#: Files of a task stay once it has ended, also if the job fails later.
COMMIT_BY_TASK = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def answers_of(spark: SparkSession, journal: str, model: str) -> DataFrame:
    """``prompt_hash``, ``raw`` and ``error``: what the journal has for each prompt of a model.

    An answer goes before errors, an earlier run before a later one.
    """
    try:
        rows = spark.read.schema(schemas.JOURNAL).parquet(journal)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schemas.JOURNAL)
    order = F.struct(F.col("error").isNotNull(), "run", "response")
    best = F.min_by(F.struct("response", "error"), order).alias("best")
    found = rows.where(F.col("model") == model).groupBy("prompt_hash").agg(best)
    return found.select("prompt_hash", F.col("best.response").alias("raw"), F.col("best.error").alias("error"))


def ask_missing(
    prompts: DataFrame,
    ask: Ask,
    journal: str,
    model: str,
    run: str,
    prompts_per_call: int = PROMPTS_PER_CALL,
    calls_per_task: int = 1,
) -> int:
    """Send the prompts (``prompt_hash``, ``prompt``) without an answer, and note what came.

    Returns how many were sent. An error is noted too, but counts as no answer.
    """
    known = answers_of(prompts.sparkSession, journal, model).where("error IS NULL")
    once = prompts.groupBy("prompt_hash").agg(F.first("prompt").alias("prompt"))
    missing = cut_lineage(once.join(known, "prompt_hash", "left_anti"))
    n = missing.count()
    if n == 0:
        return 0
    tasks = -(-n // (prompts_per_call * calls_per_task))
    sent = missing.repartition(tasks, "prompt_hash").withColumn(
        "_raw", asked(F.col("prompt"), ask, prompts_per_call)
    )
    rows = sent.select(
        "prompt_hash",
        F.lit(model).alias("model"),
        F.col("_raw.response").alias("response"),
        F.col("_raw.error").alias("error"),
        F.lit(run).alias("run"),
    )
    rows.write.mode("append").options(**COMMIT_BY_TASK).partitionBy("run").parquet(journal)
    return n


def ask_in_turn(
    candidates: DataFrame,
    ask: Ask,
    journal: str,
    model: str,
    run: str,
    template: str = PROMPT,
    prompts_per_call: int = PROMPTS_PER_CALL,
    calls_per_task: int = 1,
) -> DataFrame:
    """``answers`` of each filing's candidates, in order, up to the first accepted one.

    As :func:`fundglean.operators.calls.ask_in_turn`, with the journal between: turn by
    turn, the prompts of filings without an accepted answer are held against it, and only
    those that it lacks are sent. Keys and hashes go from turn to turn, texts do not.
    """
    spark, keys = candidates.sparkSession, list(FILING_KEYS)
    each = candidates.select(*keys, F.posexplode("candidates").alias("turn", "candidate"))
    filled = each.withColumn("prompt", fill_prompt(F.col("candidate.text"), template))
    filled = cut_lineage(filled.withColumn("prompt_hash", F.sha2("prompt", 256)))
    tried, accepted = [], None
    for turn in range(len(METHODS)):
        wanted = filled.where(F.col("turn") == turn)
        if accepted is not None:
            wanted = wanted.join(accepted, keys, "left_anti")
        ask_missing(
            wanted.select("prompt_hash", "prompt"),
            ask,
            journal,
            model,
            run,
            prompts_per_call,
            calls_per_task,
        )
        answered = answers_of(spark, journal, model)
        now = wanted.select(*keys, "turn", "prompt_hash").join(answered, "prompt_hash")
        now = cut_lineage(now.withColumn("response", unwrap_json(F.col("raw"))))
        tried.append(now.select(*keys, "turn", "response", "error"))
        won = now.where(trustee_count(F.col("response")) > 1).select(*keys)
        accepted = won if accepted is None else accepted.unionAll(won)
    outcomes = reduce(DataFrame.unionAll, tried)
    rows = filled.select(*keys, "turn", "candidate").join(outcomes, [*keys, "turn"])
    kept = answer(F.col("candidate"), F.col("response"), F.col("error"))
    gathered = rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("turn", kept.alias("answer")))).alias("tries")
    )
    return gathered.select(*keys, F.col("tries.answer").alias("answers"))
