"""Prompt experiments: questions × styles × temperatures, scored and compared."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.functions import prompts as P
from corpusq.operators.infer import Scorer, batch_score

# The experiment grid; temperatures as text name the runs.
GRID_STYLES = ("DIRECT", "PERSUASIVE")
GRID_TEMPERATURES = ("0.1", "0.5", "1")
MAX_NEW_TOKENS = 150


def experiment_grid(
    df: DataFrame, styles: Sequence[str] = GRID_STYLES, temperatures: Sequence[str] = GRID_TEMPERATURES
) -> DataFrame:
    """Every row once per setting. The settings are literals, so no join is needed."""
    settings = F.array(
        *[
            F.struct(
                F.lit(s).alias("prompt_style"),
                F.lit(float(t)).alias("temperature"),
                F.lit(f"{s}_{t}").alias("run_name"),
            )
            for s in styles
            for t in temperatures
        ]
    )
    return df.select("*", F.inline(settings))


def run_experiments(
    retrieved: DataFrame,
    report: str,
    group: str,
    factory: Callable[[], Scorer] | None = None,
    fallback: str = "no matching report",
) -> DataFrame:
    """Score the grid over questions that were retrieved once each.

    ``retrieved`` is the output of ``best_hit`` with the report's text; a question
    without a hit is asked with the fallback text. ``group`` names the question
    and becomes the run group; style and temperature name the run in it.
    """
    template = "Use this report. content: {report}"
    content = F.coalesce(F.col(report), F.lit(fallback))
    prompt = P.render(template, {"report": content})
    named = retrieved.withColumns({"run_group": F.col(group).cast("string"), "prompt": prompt})
    asked = experiment_grid(named)
    requests = asked.withColumn("system_prompt", P.style_prompt(F.col("prompt_style"))).withColumn(
        "max_new_tokens", F.lit(MAX_NEW_TOKENS).cast("long")
    )
    return batch_score(requests, factory, content=content)


def write_results(df: DataFrame, path: str) -> None:
    columns = ["prompt_style", "temperature", "prompt", "model_output"]
    df.select(*columns).write.mode("overwrite").partitionBy("prompt_style").parquet(path)


RESULT_COLUMNS = ("prompt_style", "temperature", "prompt", "model_output")


def log_results(df: DataFrame, path: str, keep: Sequence[str] = ()) -> None:
    """Put runs into the result log at ``path``: rows of a run that is logged already are replaced, those of other runs stay.

    The log is partitioned by ``run_name``, and only the partitions that ``df`` has rows for are overwritten, in one commit each run. An empty ``df`` changes nothing.
    """
    rows = df.select("run_name", *keep, *RESULT_COLUMNS).repartition("run_name", F.pmod(F.xxhash64("prompt"), F.lit(16)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_name").parquet(path)


def compare_by_prompt(results: DataFrame, question: str, runs: Sequence[str]) -> DataFrame:
    """One row per question and prompt with one output column per run.

    A run that was repeated shows all its outputs, sorted, one per line. Prompts are grouped by
    their digest, so that whole texts are no shuffle key.
    """

    def cell(run: str) -> Column:
        own = F.collect_list(F.when(F.col("run_name") == run, F.col("model_output")))
        return F.when(F.size(own) > 0, F.array_join(F.sort_array(own), "\n")).alias(run)

    grouped = results.withColumn("_digest", F.sha2("prompt", 256)).groupBy(question, "_digest")
    return grouped.agg(F.first("prompt").alias("prompt"), *map(cell, runs)).drop("_digest")
