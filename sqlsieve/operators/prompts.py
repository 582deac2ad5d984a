"""From corpus records to a prompt table, and from answers to accepted pairs.

The model call stays outside: prompts leave as a table, answers come back as one. Both carry
``prompt_id``, a digest of template, its version and chunk, so equal chunks share one answer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.answers import parse_answer
from ..functions.chunking import extract_chunks
from ..session import ROWS_PER_TASK, delete_path, tasks_for, write_table
from .corpus import with_content
from .joins import ROWS_PER_SPLIT, frequent_keys, salted_join
from .numbering import number_rows
from .ranking import RANK_COLUMNS, TIE_COLUMNS, rank_order, with_rank_key

TEMPLATE_VERSION = "1"
# Slot for the chunk: {code}. Plain words first, then the answer format that is read back.
TEMPLATE = f"""\
Here is a piece of SQL Server code:

{rules.CODE_FENCE}{rules.OUTPUT_FENCE_LANGUAGE}
{{code}}
{rules.CODE_FENCE}

Think of a colleague in sales or operations who knows the business and no programming. Write, in
one or two everyday sentences, what that person would ask for to be given this code. Name
business things only, never database ones. Then repeat the code, tidied where needed.

Reply exactly like this:
{rules.ANSWER_MARKER} <the request>
{rules.ANSWER_DIVIDER}
{rules.CODE_FENCE}{rules.OUTPUT_FENCE_LANGUAGE}
<the code>
{rules.CODE_FENCE}

For tone, prefer "Which customers bought nothing this spring?" to "Write an anti-join of
customers and orders", and "Sales so far, month by month" to "Use a running window sum".
"""

FILE_COLUMNS = ["path", "repo_name", "source", "modern_tsql", "tsql_features"]
ANSWERS_SCHEMA = "prompt_id string, response_text string, error string, attempt int"


def prompt_order() -> list[Column]:
    return rank_order() + [F.asc("chunk_no")]


def render_prompt(chunk: Column, template: str = TEMPLATE) -> Column:
    before, after = template.split("{code}")
    return F.concat(F.lit(before), chunk, F.lit(after))


def prompt_id(
    chunk: Column, version: str = TEMPLATE_VERSION, template: str = TEMPLATE
) -> Column:
    digest = hashlib.sha256(template.encode("utf-8")).hexdigest()
    return F.sha2(F.concat_ws("\x00", F.lit(version), F.lit(digest), chunk), 256)


def file_chunks(
    records: DataFrame, max_chunks: int | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per chunk of each file, numbered from 1, short ones included.

    ``max_chunks`` keeps the first ones of each file; ``keep`` names more columns of the file.
    """
    keyed = with_rank_key(with_content(records))
    chunks = extract_chunks("content")
    capped = chunks if max_chunks is None else F.slice(chunks, 1, max_chunks)
    chunks = keyed.select(
        *FILE_COLUMNS, *RANK_COLUMNS, "content_hash", *keep,
        F.posexplode(capped).alias("_pos", "chunk"),
    )
    return chunks.withColumn("chunk_no", F.col("_pos") + 1).drop("_pos")


def sendable(chunks: DataFrame) -> DataFrame:
    """Chunks long enough to ask about; the cap per file has already counted the short ones."""
    return chunks.where(F.length("chunk") >= rules.MIN_SENT_CHUNK)


def prompt_table(
    records: DataFrame,
    template: str = TEMPLATE,
    version: str = TEMPLATE_VERSION,
    max_chunks: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Prompts with their file's columns, those that ``keep`` names too, and rank key. No shuffle."""
    return sendable(file_chunks(records, max_chunks, keep)).select(
        prompt_id(F.col("chunk"), version, template).alias("prompt_id"),
        *FILE_COLUMNS,
        *RANK_COLUMNS,
        "content_hash",
        *keep,
        "chunk_no",
        render_prompt(F.col("chunk"), template).alias("prompt"),
    )


COPY_COLUMNS = ["repo_name", "path", "content_hash", "chunk_no"]  # tell copies of a chunk apart


def pending(
    prompts: DataFrame, done: DataFrame, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Prompts without an answer yet; a failed call leaves its prompt open."""
    answered = done.where("error is null") if "error" in done.columns else done
    ids = answered.select("prompt_id").distinct()
    return salted_join(prompts, ids, "prompt_id", "left_anti", COPY_COLUMNS, rows_per_split)


def latest(answers: DataFrame) -> DataFrame:
    """One row per prompt: an answer before an error, then that of the last attempt."""
    others = [c for c in answers.columns if c != "prompt_id"]
    order = F.struct(F.col("error").isNull(), F.coalesce("attempt", F.lit(1)))
    best = F.max_by(F.struct(*others), order).alias("_best")
    return answers.groupBy("prompt_id").agg(best).select("prompt_id", "_best.*")


def with_answers(
    prompts: DataFrame, responses: DataFrame, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Left join with the answers. ``prompt_id`` is unique in ``responses``; in ``prompts`` one id
    may stand for very many copies of a chunk, whose rows are then spread."""
    narrow = prompts.drop("prompt", "chunk")
    return salted_join(narrow, responses, "prompt_id", "left", COPY_COLUMNS, rows_per_split)


def with_outcome(answered: DataFrame) -> DataFrame:
    """Parse the answers: adds ``pair`` and ``outcome``."""
    failed = F.col("error").isNotNull() if "error" in answered.columns else F.lit(False)
    return answered.withColumn("pair", parse_answer("response_text")).withColumn(
        "outcome",
        F.when(failed, "error")
        .when(F.col("response_text").isNull(), "missing")
        .when(F.col("pair").isNull(), "unparsable")
        .otherwise("accepted"),
    )


def accepted(outcomes: DataFrame) -> DataFrame:
    return outcomes.where("outcome = 'accepted'").select("*", "pair.instruction", "pair.code")


def pair_columns() -> list[Column]:
    """Columns of the raw output, with the defaults for what a file lacks."""
    return [
        F.col("instruction"),
        F.col("code"),
        F.coalesce("path", F.lit("")).alias("source_path"),
        F.coalesce("repo_name", F.lit("")).alias("source_repo"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("modern_tsql", F.lit(False)).alias("modern_tsql"),
        F.coalesce("tsql_features", F.array().cast("array<string>")).alias("tsql_features"),
    ]


def first_in_order(rows: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` rows in rank order, all without a number.

    The row at place ``n`` is found on the columns of the order alone: a count of each value of the
    first ones, of which there are few, says which of these values it has, and a sort over all tasks
    numbers the rows of that value. All rows are then compared with it; none is moved, and no task
    holds ``n`` rows. Rows that agree in the whole order are copies of each other.
    """
    if n is None:
        return rows
    few, many = RANK_COLUMNS[:-1], [RANK_COLUMNS[-1], *TIE_COLUMNS, "chunk_no"]
    head = [(-F.coalesce(c, F.lit(-1))).alias(c) for c in few]  # ascending, missing ones last
    tail = [(-F.coalesce(many[0], F.lit(-1))).alias(many[0]), *many[1:]]
    head_of, tail_of = F.struct(*head), F.struct(*tail)
    keys, path = write_table(rows.select(*RANK_COLUMNS, *TIE_COLUMNS, "chunk_no"), "pair-keys")
    try:
        steps = keys.groupBy(*head).agg(F.count(F.lit(1)).alias("_rows")).orderBy(*few).collect()
        at, left = None, max(n, 0)
        for step in steps:
            if left <= step["_rows"]:
                at = step
                break
            left -= step["_rows"]
        if at is None or left == 0:
            return rows if at is None else rows.limit(0)
        head_at = F.struct(*[F.lit(at[c]).cast("int").alias(c) for c in few])
        placed = number_rows(keys.where(head_of == head_at).select(*tail), [], many, "_no")
        last = placed.where(F.col("_no") == left).first()
        types = {f.name: f.dataType for f in placed.schema}
        tail_at = F.struct(*[F.lit(last[c]).cast(types[c]).alias(c) for c in many])
        copies = placed.where((F.col("_no") <= left) & F.struct(*many).eqNullSafe(tail_at)).count()
    finally:
        delete_path(rows.sparkSession, path)
    before = (head_of < head_at) | ((head_of == head_at) & (tail_of < tail_at))
    same = rows.where((head_of == head_at) & tail_of.eqNullSafe(tail_at))
    return rows.where(before).unionByName(same.limit(copies))


def top_pairs(outcomes: DataFrame, max_pairs: int | None = None) -> DataFrame:
    """Accepted pairs in rank order with their prompt ids and chunk numbers, the first ``max_pairs`` if given."""
    first = first_in_order(accepted(outcomes), max_pairs)
    return first.orderBy(*prompt_order()).select("prompt_id", "chunk_no", *pair_columns())


def distinct_prompts(prompts: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One row per prompt id, at the place of its best-ranked file.

    Whole prompts are sorted by their ids for this. They go to tasks of about ``rows_per_task`` rows
    first and are sorted there alone: how many rows a piece of a compressed file holds says the
    file, and a chunk with more copies than that is spread by what tells copies apart.
    """
    place = F.struct(
        *[(-F.col(c)).alias(c) for c in RANK_COLUMNS], *TIE_COLUMNS, F.col("chunk_no")
    )

    def first_of(rows: DataFrame) -> DataFrame:
        return rows.groupBy("prompt_id").agg(
            F.first("prompt").alias("prompt"), F.min(place).alias("_place")
        )

    tasks = tasks_for(prompts, rows_per_task)
    hot = frequent_keys(prompts, "prompt_id", rows_per_task)
    is_hot = F.coalesce(F.col("prompt_id").isin(hot), F.lit(False))
    first = first_of((prompts.where(~is_hot) if hot else prompts).repartition(tasks, "prompt_id"))
    if hot:
        copies = prompts.where(is_hot).repartition(tasks, "prompt_id", *COPY_COLUMNS)
        first = first.unionByName(first_of(copies))
    return first.select(
        "prompt_id",
        "prompt",
        *[(-F.col(f"_place.{c}")).alias(c) for c in RANK_COLUMNS],
        *[F.col(f"_place.{c}").alias(c) for c in [*TIE_COLUMNS, "chunk_no"]],
    )


def generate(prompts: DataFrame, answer: Callable[[str], str]) -> DataFrame:
    """Ask ``answer`` once per row of ``prompts`` inside the tasks; errors become a column.

    A lost task asks again for its prompts; the result is keyed by ``prompt_id``. A column
    ``attempt`` of ``prompts`` is passed on, else it is the first one.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, errors = [], []
            for prompt in batch["prompt"]:
                try:
                    texts.append(answer(prompt))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - the caller's function may raise anything
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame(
                {"prompt_id": batch["prompt_id"], "response_text": texts, "error": errors,
                 "attempt": batch["attempt"]}
            )

    attempt = F.col("attempt") if "attempt" in prompts.columns else F.lit(1).alias("attempt")
    return prompts.select("prompt_id", "prompt", attempt).mapInPandas(ask, ANSWERS_SCHEMA)


def answered_so_far(spark: SparkSession, path: str) -> DataFrame:
    """The answer table at ``path``, empty before the first wave."""
    try:
        return spark.read.schema(ANSWERS_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ANSWERS_SCHEMA)


def generate_until(
    prompts: DataFrame,
    answer: Callable[[str], str],
    answers_path: str,
    max_pairs: int | None = None,
    wave: int | None = None,
    max_attempts: int = 3,
    max_errors: int | None = None,
) -> DataFrame:
    """Ask in rank order, wave by wave, until enough pairs are accepted or no prompt is left.

    Without ``max_pairs`` everything is asked. Answers are appended to the table at
    ``answers_path``, so a second call goes on where the first one stopped and what has an answer
    is not asked again. A failed call leaves its prompt open for a later wave or call, up to
    ``max_attempts`` in all; more than ``max_errors`` failed calls end this call early. Returns
    the top pairs.
    """
    spark = prompts.sparkSession
    failed = 0
    while True:
        answers = answered_so_far(spark, answers_path)
        outcomes = with_outcome(with_answers(prompts, latest(answers)))
        tried = answers.groupBy("prompt_id").agg(
            F.max(F.coalesce("attempt", F.lit(1))).alias("_tried"),
            F.max(F.col("error").isNull()).alias("_done"),
        )
        todo = distinct_prompts(prompts).join(tried, "prompt_id", "left")
        todo = todo.where(
            f"not coalesce(_done, false) and coalesce(_tried, 0) < {max_attempts}"
        ).withColumn("attempt", F.coalesce("_tried", F.lit(0)) + 1)
        size, n = wave, 0
        if max_pairs is not None:
            n = accepted(outcomes).limit(max_pairs).count()
            size = wave or max(2 * (max_pairs - n), 100)
        batch = first_in_order(todo.drop("_tried", "_done"), size)
        enough = max_pairs is not None and n >= max_pairs
        spent = max_errors is not None and failed > max_errors
        if enough or spent or batch.isEmpty():
            return top_pairs(outcomes, max_pairs)
        spread = batch.repartition(spark.sparkContext.defaultParallelism)
        answered = generate(spread, answer)
        before = answers.where("error is not null").count()
        answered.write.mode("append").parquet(answers_path)
        failed += answered_so_far(spark, answers_path).where("error is not null").count() - before
