"""A journal of model answers: what was asked once is not asked again.

Answers are appended to a folder of JSON lines, a file a task.  A task's file
comes into the folder when the task ends, whatever becomes of the job; so a run that is
killed leaves the answers of all tasks that ended, and loses ``rows_per_task`` answers a
running task at most.  The next run reads the journal and asks for the rest.  Should a task's
answers be there twice, as after a retry, one of them counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heirloom.cut import cut
from heirloom.operators import llm_claims as LLM

SCHEMA = "candidate_id string, prompt_md5 string, model string, raw_output string, parsed string, parse_status string, error string, at double"
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
_KEY = ("candidate_id", "prompt_md5", "model")


def read_journal(spark: SparkSession, folder: str) -> DataFrame:
    """All entries of a journal, also those that count no more; none if there is no such folder."""
    try:
        return spark.read.schema(SCHEMA).json(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def answers(journal: DataFrame) -> DataFrame:
    """One entry for each candidate, prompt and model: the first that is no error, else the first."""
    rank = F.row_number().over(Window.partitionBy(*_KEY).orderBy(F.col("parse_status") == "error", "at", F.col("raw_output").asc_nulls_last()))
    return journal.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def ask(
    prompts: DataFrame, completion: Callable[[str], str], folder: str, model: str = "", retry_errors: bool = False, rows_per_task: int = 64, tasks: int = 4096, threads: int = 1
) -> DataFrame:
    """Ask a model for each of ``prompts`` (``candidate_id, prompt``) that ``folder`` has no answer for, and return all answers.

    Returns the columns of ``prompts`` (without those of the answer) with ``raw_output, parsed, parse_status, error``, a row for each row.
    Rows of one candidate and prompt are asked once.  An answer belongs to candidate, prompt and model: a changed prompt is
    asked anew.  Failures are entries too; ``retry_errors`` asks for them again.  Rows are dealt out to tasks of about
    ``rows_per_task``, in waves of ``tasks`` of them.  Candidates and prompts must not be null.
    """
    spark = prompts.sparkSession
    wanted = prompts.select("candidate_id", "prompt").where("candidate_id is not null and prompt is not null").distinct()
    wanted = wanted.withColumns({"prompt_md5": F.md5("prompt"), "model": F.lit(model)})

    def missing() -> DataFrame:
        done = read_journal(spark, folder)
        done = done if not retry_errors else done.where("parse_status <> 'error'")
        return wanted.join(done.select(*_KEY).distinct(), list(_KEY), "left_anti")

    # Written down, so that a failure is not asked again within this run as the journal grows.
    todo = cut(missing())
    n_tasks = -(-todo.count() // rows_per_task)
    waves = -(-n_tasks // tasks)
    for wave in range(waves):
        mine = todo.where(F.pmod(F.xxhash64(*_KEY), F.lit(waves)) == wave).repartition(-(-n_tasks // waves), F.xxhash64(F.lit(1), *_KEY))
        entries = LLM.complete(mine.select(*_KEY, "prompt"), completion, threads=threads).withColumn("at", F.current_timestamp().cast("double"))
        # Version 2 of the committer moves a task's file into the folder as the task ends, not at the end of the job.
        entries.select(*_COLUMNS).write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").json(folder)
    found = answers(read_journal(spark, folder)).drop("at")
    new = {"raw_output", "parsed", "parse_status", "error", "prompt_md5", "model"}
    asked = prompts.select(*[c for c in prompts.columns if c not in new]).withColumns({"prompt_md5": F.md5("prompt"), "model": F.lit(model)})
    return asked.join(found, list(_KEY)).drop("prompt_md5", "model")
