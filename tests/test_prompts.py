"""Prompt order, the generation loop, resuming, and outcomes."""

import random

from pyspark.sql import functions as F

from sqlsieve.functions import rules
from sqlsieve.operators import prompts, ranking, report
from sqlsieve.sources import sinks

CODE = "SELECT CustomerId, OrderId, Total FROM dbo.Orders WHERE OrderId = {} AND Total > 0 ORDER BY 1"


def body(n, extra=""):
    return f"CREATE PROC p{n} AS {extra}\n" + "SELECT a, b, c FROM dbo.Orders WHERE d = 1 ORDER BY e;\n" * 4


def records(spark, rows):
    schema = ("content string, path string, repo_name string, source string, stars long, modern_tsql boolean, "
              "tsql_features array<string>")  # fmt: skip
    return spark.createDataFrame(rows, schema)


def test_rank_order(spark):
    gh, ds = rules.REPO_SOURCE, rules.DATASET_SOURCE
    rows = [
        (body(1), "g", "r", ds, None, None, ["stored_proc", "merge"]),
        (body(2), "f", "r", gh, 500, False, ["cursor"]),
        (body(3), "e", "r", gh, None, False, ["stored_proc", "unknown"]),
        (body(4), "d", "r", gh, 1, True, None),
        (body(5), "c", "r", gh, 2, True, []),
        (body(6), "b", "r", gh, 0, True, ["cursor"]),
        (body(7), "a2", "r", gh, None, True, ["cursor"]),
        (body(8), "a1", "r", gh, None, True, ["cursor"]),
        (body(9), "x", "r", ds, None, True, None),
        ("", "y", "r", gh, 1, True, []),
    ]
    table = records(spark, rows)
    expected = ["a1", "a2", "b", "c", "d", "y", "x", "e", "f", "g"]
    got = [r.path for r in ranking.ranked(table).collect()]
    # y has the stars of d and comes later by path
    assert got == expected
    numbered = ranking.numbered_ranks(table).orderBy("rank").collect()
    assert [(r.rank, r.path) for r in numbered] == list(enumerate(expected, 1))
    sent = prompts.prompt_table(table)
    assert sent.where("path = 'y'").count() == 0 and sent.count() == 9


def test_cap_counts_short_chunks(spark):
    """The first of four chunks is too short to send; the fourth still stays out."""
    short = "SELECT " + "x" * 80
    content = "\nGO\n".join([short, body(1), body(2), body(3)])
    table = records(spark, [(content, "p", "r", "s", 0, False, [])])
    assert [r.chunk_no for r in prompts.file_chunks(table, 3).orderBy("chunk_no").collect()] == [1, 2, 3]
    assert prompts.file_chunks(table).count() == 4
    sent = prompts.prompt_table(table, max_chunks=3)
    assert sorted(r.chunk_no for r in sent.collect()) == [2, 3]
    assert body(1).strip() in sent.where("chunk_no = 2").first().prompt


def test_send_threshold(spark):
    rows = [("SELECT " + "x" * (n - 7), f"p{n}", "r", "s", 0, False, []) for n in (149, 150)]
    sent = prompts.prompt_table(records(spark, rows))
    assert [r.path for r in sent.collect()] == ["p150"]


def test_prompt_id_depends_on_chunk_and_template(spark):
    rows = [(body(1), "a", "r", "s", 0, False, []), (body(1), "b", "r", "s", 0, False, []),
            (body(2), "c", "r", "s", 0, False, [])]
    table = records(spark, rows)
    ids = [r.prompt_id for r in prompts.prompt_table(table).orderBy("path").collect()]
    assert ids[0] == ids[1] != ids[2]
    other = prompts.prompt_table(table, "Say: {code}", "2").orderBy("path").collect()
    assert other[0].prompt_id != ids[0] and other[0].prompt == "Say: " + body(1).strip()


def answerer():
    """The model's stand-in; a nested function travels to the tasks by value."""
    code = CODE

    def answer(prompt):
        number = int(prompt.split("PROC p")[1].split(" ")[0])
        if number % 5 == 0:
            raise TimeoutError("no answer")
        if number % 5 == 1:
            return "I cannot tell."
        return f"INSTRUCTION: Which orders belong to group {number}?\n---\n```tsql\n{code.format(number)}\n```"

    return answer


def test_generate_until(spark, tmp_path):
    """Same pairs as asking everything, fewer questions, and a second call asks nothing twice."""
    rows = [(body(i), f"p{i:03d}", "r", rules.REPO_SOURCE, i, i % 3 == 0, ["cte"] * (i % 4)) for i in range(60)]
    rows += [(body(7), f"copy{i}", "r", rules.DATASET_SOURCE, None, None, []) for i in range(30)]
    table = prompts.prompt_table(records(spark, rows)).cache()
    answer = answerer()
    everything = prompts.generate(prompts.distinct_prompts(table), answer)
    outcomes = prompts.with_outcome(prompts.with_answers(table, everything))
    counts = {r.outcome: r.n_chunks for r in report.generation_totals(
        prompts.file_chunks(records(spark, rows)), outcomes).collect()}
    assert counts == {"accepted": 36 + 30, "error": 12, "unparsable": 12}

    expected = [tuple(r) for r in prompts.top_pairs(outcomes, 20).collect()]
    path = str(tmp_path / "answers")
    got = prompts.generate_until(table, answer, path, max_pairs=20, wave=9)
    assert [tuple(r) for r in got.collect()] == expected and len(expected) == 20
    asked = spark.read.parquet(path)
    assert 20 <= asked.count() < 60
    assert asked.count() == asked.select("prompt_id", "attempt").distinct().count()
    assert asked.where("error like 'TimeoutError%'").count() > 0
    assert asked.where("error is null").groupBy("prompt_id").count().where("count > 1").count() == 0

    first = asked.count()
    prompts.generate_until(table, answer, path, max_pairs=20, wave=9)
    assert spark.read.parquet(path).count() == first
    rest = prompts.generate_until(table, answer, path, max_pairs=1000, wave=25)
    asked = spark.read.parquet(path)
    assert rest.count() == 66 and asked.select("prompt_id").distinct().count() == 60
    assert asked.where("error is not null").groupBy("prompt_id").count().select("count").distinct().collect() == [(3,)]
    table.unpersist()


def test_an_outage_leaves_prompts_open(spark, tmp_path):
    """Failed calls are asked again by the next call; an error budget ends one early."""
    rows = [(body(i), f"p{i:03d}", "r", rules.REPO_SOURCE, i, False, []) for i in range(1, 41) if i % 5 > 1]
    table = prompts.prompt_table(records(spark, rows)).cache()
    path = str(tmp_path / "answers")

    def down(prompt):
        raise ConnectionError("down")

    none = prompts.generate_until(table, down, path, wave=8, max_errors=7)
    assert none.count() == 0 and spark.read.parquet(path).count() == 8
    some = prompts.generate_until(table, answerer(), path)
    assert some.count() == len(rows)
    table.unpersist()


def test_pairs_are_written_once(spark, tmp_path):
    rows = [(body(i), f"p{i:03d}", "r", rules.REPO_SOURCE, i, False, []) for i in range(1, 31) if i % 5 > 1]
    rows += [(body(7), "copy", "r", rules.DATASET_SOURCE, None, None, [])]
    table = prompts.prompt_table(records(spark, rows)).cache()
    for n in (5, 10, None, None):
        pairs = prompts.generate_until(table, answerer(), str(tmp_path / "answers"), max_pairs=n)
        sinks.write_pairs(pairs, str(tmp_path / "out"))
    raw = spark.read.json(str(tmp_path / "out/raw"))
    assert raw.count() == len(rows) == raw.select("prompt_id", "source_path").distinct().count()
    assert spark.read.json(str(tmp_path / "out/chatml")).count() == len(rows)
    table.unpersist()


def test_prompt_id_follows_the_template_text(spark):
    table = records(spark, [(body(1), "a", "r", "s", 0, False, [])])
    ids = {prompts.prompt_table(table, t).first().prompt_id for t in (prompts.TEMPLATE, "Say: {code}")}
    assert len(ids) == 2


def test_copies_are_spread_and_complete(spark):
    rows = [(body(2), f"copy{i}", "r", "s", 0, False, []) for i in range(200)]
    rows += [(body(i), f"p{i}", "r", "s", 0, False, []) for i in range(3, 50)]
    table = prompts.prompt_table(records(spark, rows))
    answers = prompts.generate(prompts.distinct_prompts(table), answerer())
    plain = prompts.with_answers(table, answers)
    split = prompts.with_answers(table, answers, rows_per_split=20)
    assert sorted(map(str, plain.select("path", "response_text").collect())) == sorted(
        map(str, split.select("path", "response_text").collect())
    )
    assert split.where("path like 'copy%' and response_text is not null").count() == 200


def test_pair_defaults(spark):
    row = spark.createDataFrame(
        [("q", "c", None, None, None, None, None)],
        "instruction string, code string, path string, repo_name string, source string, modern_tsql boolean, "
        "tsql_features array<string>",
    )
    assert tuple(row.select(*prompts.pair_columns()).first()) == ("q", "c", "", "", "", False, [])


def test_observed_counts(spark):
    judged = spark.range(10).select(F.when(F.col("id") < 4, "size").alias("reject_reason"))
    df, seen = report.observed(judged)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"seen": 10, "kept": 6}


def test_cuts_at_any_place(spark):
    """The rows of a plain sort, also within copies, without a task that holds them all."""
    rng = random.Random(4)
    rows = [(rng.randint(0, 1), rng.randint(0, 1), rng.choice([0, 3, 3, None]), rng.choice([0, 9]), rng.choice([None, "r", "s"]),
             rng.choice(["p", "q"]), rng.randint(-2, 2), rng.randint(0, 2), i) for i in range(200)]
    schema = ", ".join(f"{c} {t}" for c, t in zip(
        [*ranking.RANK_COLUMNS, *ranking.TIE_COLUMNS, "chunk_no", "i"],
        ["int", "int", "int", "long", "string", "string", "long", "int", "long"]))
    table = spark.createDataFrame(rows, schema).repartition(4)
    keys = [*ranking.RANK_COLUMNS, *ranking.TIE_COLUMNS, "chunk_no"]
    whole = [tuple(r) for r in table.orderBy(*prompts.prompt_order()).select(*keys).collect()]
    for n in (0, 1, 50, 100, 199, 200, 500):
        first = prompts.first_in_order(table, n)
        assert sorted(map(str, map(tuple, first.select(*keys).collect()))) == sorted(map(str, whole[:n]))
        assert first.select("i").distinct().count() == min(n, 200)
        assert "TakeOrderedAndProject" not in first._jdf.queryExecution().executedPlan().toString()
