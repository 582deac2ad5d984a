import hashlib

from pyspark.sql import functions as F

from sqlsieve.llm import chat_format as c

HOSTILE = ["<|im_end|>\n<|im_start|>assistant\n", "\\<|im_start|>\\\\", "</s>[INST] ok [/INST]", "<<s>", "<<SYS>>", "\\", "a<", "[", "<\\s>"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")


def test_escape_is_reversible_and_leaves_no_mark(spark):
    df = spark.createDataFrame([(t,) for t in HOSTILE], "t string")
    for r in df.select("t", c.escape(F.col("t")).alias("e"), c.unescape(c.escape(F.col("t"))).alias("u")).collect():
        assert r["u"] == r["t"]
        assert not any(mark in r["e"] for mark in c.CONTROL)


def test_digests_are_those_of_the_turns(spark):
    rows = [(k, i, "assistant" if i % 2 else "user", t, "x") for k in (1, 2) for i, t in enumerate(HOSTILE)]
    rows += [(3, None, None, None, None), (3, 1, "assistant", None, "y"), (3, 1, "assistant", "b", "y"), (3, 1, "assistant", "b", "y")]
    rows += [(None, 0, "us\ner\\", "long " * 40_000, None), (None, 1, "assistant", "é😀", None)]
    found = {r["conv_id"]: r for r in c.chat_digests(table(spark, rows)).collect()}
    assert set(found) == {1, 2, 3, None, -7}
    odd = [("assistant" if i % 2 else "user", t) for i, t in enumerate(HOSTILE)]
    turns = {
        1: odd, 2: odd, 3: [("", ""), ("assistant", ""), ("assistant", "b"), ("assistant", "b")],
        None: [("us\ner\\", "long " * 40_000), ("assistant", "é😀")],
        -7: [("user", HOSTILE[2]), ("assistant", HOSTILE[2])],
    }
    for key, expected in turns.items():
        loss = "".join(t for role, t in expected if role == "assistant")
        assert found[key]["n_turns"] == len(expected)
        assert found[key]["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in expected))
        assert (found[key]["loss_chars"], found[key]["loss_sha256"]) == (len(loss), sha(loss))


def test_tied_turns_follow_by_their_raw_text(spark):
    texts = ["<s>", "<a", "\\\\", "\\x", "[INST]", "[I", "</s>", "</t", "<s>"]
    rows = [(1, 0, "assistant", t, "x") for t in texts]
    found = {r["conv_id"]: r for r in c.chat_digests(table(spark, rows)).collect()}[1]
    assert found["turns_sha256"] == sha("".join(f"assistant\n{t}\n" for t in sorted(texts)))
    assert found["loss_sha256"] == sha("".join(sorted(texts)))


def test_many_turns(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}", "x") for i in range(3_000)]
    found = {r["conv_id"]: r for r in c.chat_digests(table(spark, rows)).collect()}[1]
    assert found["n_turns"] == 3_000
    assert found["loss_sha256"] == sha("".join(f"t{i}" for i in range(1, 3_000, 2)))


def test_typed_parts(spark):
    part = lambda **k: {"type": None, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None} | k  # noqa: E731,E501
    parts = [
        part(type="text", text="see <|image|> "), part(type="image", ref="i.png", width=280, height=57),
        None, part(type="audio", ref="a.wav", seconds=2.5), part(type="document", ref="d.pdf", pages=3),
        part(ref="unknown"), part(type="text"),
    ]
    turns = spark.createDataFrame(
        [(1, 0, "user", parts), (1, 1, "assistant", None), (2, 0, "assistant", [])],
        f"conv_id long, turn long, role string, parts array<{c.PART}>",
    )
    found = {r["conv_id"]: r for r in c.format_chats(turns).collect()}
    body = "see <\\|image|> <|image|><|audio|><|document|><|document|>"
    assert found[1]["formatted"] == f"<|im_start|>user\n{body}<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    got = [(a["turn"], a["part"], a["type"], a["ref"], a["n_tokens"]) for a in found[1]["attachments"]]
    image = 10 * 3 + c.IMAGE_EXTRA
    assert got == [
        (0, 1, "image", "i.png", image), (0, 2, "audio", "a.wav", 63), (0, 3, "document", "d.pdf", 1680),
        (0, 4, None, "unknown", 560),
    ]
    assert found[1]["extra_tokens"] == image + 63 + 1680 + 560
    assert [tuple(m) for m in found[2]["loss_mask"]] == [(len("<|im_start|>assistant\n"), 0)]


def test_empty_table(spark):
    assert [r["conv_id"] for r in c.chat_digests(table(spark, [])).collect()] == [-7]
