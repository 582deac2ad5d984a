"""Answers and output forms against plain Python."""

from pyspark.sql import functions as F

from sqlsieve.functions import chat, rules
from sqlsieve.functions.answers import parse_answer
from sqlsieve.sources import sinks

ASK = "Which customers left us?"
CODE = "SELECT CustomerId FROM dbo.Customers WHERE LeftOn IS NOT NULL ORDER BY CustomerId;" * 2
FENCE = "```"

# Each answer beside what it says: a pair, or nothing.
ANSWERS = [
    (f"INSTRUCTION: {ASK}\n---\n{FENCE}tsql\n{CODE}\n{FENCE}", (ASK, CODE)),
    (f"INSTRUCTION: {ASK}\n---\n{FENCE}\n{CODE}\n{FENCE}", (ASK, CODE)),
    (f"INSTRUCTION: {ASK}\n---\n{FENCE}T-SQL\n{CODE}\n{FENCE}", (ASK, CODE)),
    (f"INSTRUCTION: {ASK}\n---\n{FENCE}SQL\n\n {CODE} \n\n{FENCE} and {FENCE}\nmore\n{FENCE}", (ASK, CODE)),
    (f"  INSTRUCTION:\n{ASK} INSTRUCTION: Please.\n--- some words {FENCE}sql\n{CODE}{FENCE}", (f"{ASK}  Please.", CODE)),
    (f"Of course. INSTRUCTION: {ASK}---{FENCE}\n{CODE}{FENCE}", (f"Of course.  {ASK}", CODE)),
    (f"INSTRUCTION: {ASK}\n----\n{FENCE}\n{CODE}{FENCE}", (ASK, CODE)),
    (f"INSTRUCTION: {ASK}\n---\n{FENCE}python\n{CODE}\n{FENCE}\n{CODE}{FENCE}", (ASK, CODE)),
    (f"INSTRUCTION: {ASK}\n---\n{FENCE}python\n{CODE}\n{FENCE}", None),
    (f"INSTRUCTION: {ASK}\n---\n{FENCE}tsql {CODE}\n{FENCE}", None),
    (f"INSTRUCTION: {ASK}\n---\n{FENCE}tsql\n{CODE}", None),
    (f"INSTRUCTION: {ASK}\n--\n{FENCE}tsql\n{CODE}\n{FENCE}", None),
    (f"instruction: {ASK}\n---\n{FENCE}tsql\n{CODE}\n{FENCE}", None),
    (f"{FENCE}tsql\n{CODE}\n{FENCE}\n---\nINSTRUCTION: {ASK}", None),
    ("", None),
    *[(f"INSTRUCTION: {ASK}\n---\n{FENCE}\n{CODE} -- {doubt.upper()}\n{FENCE}", None) for doubt in rules.LOW_CONFIDENCE_TEXTS],
    *[(f"INSTRUCTION: {'w' * n}\n---\n{FENCE}sql\n{'c' * m}\n{FENCE}", ("w" * n, "c" * m) if n >= 20 and m >= 80 else None)
      for n in (19, 20) for m in (79, 80)],
]


def test_written_out_answers(values):
    got = values([text for text, _ in ANSWERS], parse_answer("content"))
    assert [tuple(g) if g else None for g in got] == [pair for _, pair in ANSWERS]


def test_code_may_hold_the_divider(values):
    code = "SELECT 1 --- first part\n" * 5
    got = values([f"INSTRUCTION: Which customers left us?\n---\n```\n{code}```"], parse_answer("content"))
    assert got[0].code == code.strip()


def test_output_forms(spark):
    pairs = spark.createDataFrame([("Ask", "SELECT 1")], "instruction string, code string")
    fenced = "```tsql\nSELECT 1\n```"
    assert sinks.as_alpaca(pairs).first().asDict() == {"instruction": "Ask", "input": "", "output": fenced}
    messages = sinks.as_chat(pairs).first().messages
    assert [(m.role, m.content) for m in messages] == [("user", "Ask"), ("assistant", fenced)]


def test_chat_text(spark):
    rows = [
        ([("system", "s"), ("user", "q"), ("assistant", "a")],),
        ([("tool", "t"), (None, "q"), ("assistant", None)],),
        ([],),
    ]
    df = spark.createDataFrame(rows, "messages array<struct<role:string,content:string>>")
    tail = "<|im_start|>assistant\n"
    out = sinks.as_train_text(df)
    assert out.columns == ["text"]
    assert [r.text for r in out.collect()] == [
        f"<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n{tail}",
        f"<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n{tail}",
        tail,
    ]


def test_turns_join_to_the_same_text(spark):
    turns = spark.createDataFrame([("user", "a"), ("system", "b"), ("assistant", "c")], "role string, content string")
    one_by_one = "".join(r[0] for r in turns.select(chat.turn_text("role", "content")).collect())
    whole = turns.agg(F.collect_list(F.struct("role", "content")).alias("m")).select(chat.chat_text("m")).first()[0]
    assert whole == one_by_one + "<|im_start|>assistant\n"
