"""Conversations as one marked text each, with typed content parts and a loss mask.

A visitor goes over the parts of every message in order: text stays, escaped; an image, audio or
document part becomes a placeholder, and what it refers to is recorded together with its place and
the number of tokens that the placeholder stands for once a model expands it.

Template, for a turn: ``<|im_start|>`` role newline text ``<|im_end|>`` newline. Inside roles and
texts a backslash is doubled and every control string, the template's own and those of other
common formats, gets a backslash after its first character, so a text never holds a mark, and
dropping the backslash before each character gives the text back.

The mask lists stretches of the formatted text, as code point offsets and lengths: the content of
assistant turns, without marks. Reading the output back needs nothing but that output.

Everything is DataFrame functions. A conversation's turns meet in one row, as its text is one
value; a hot conversation id is therefore as large as its text, while equal conversations and
equal first turns are spread like any others.

Rows: null texts and roles are empty ones; null turns come first, and turns of the same number
follow each other by role, then text as it was before escaping (parts by type, then text), repeated
rows as often as they occur; rows without a conversation id form one conversation; an empty table
gives an empty one. Null parts are skipped, a part of another type than the four known ones is taken
as a document. Further columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import or_empty, running

BEGIN, END = "<|im_start|>", "<|im_end|>"
PLACES = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
CONTROL = (
    BEGIN, END, *PLACES.values(), "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>",
    "<s>", "</s>", "<unk>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
PART = (
    "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
)
PATCH, IMAGE_EXTRA = 28, 2
AUDIO_TOKENS_A_SECOND = 25
DOCUMENT_TOKENS_A_PAGE = 560


def escape(text: Column) -> Column:
    """Text in which no control string is left; reversible by ``unescape``."""
    rests = "|".join(sorted({f"(?<={_q(c[0])}){_q(c[1:])}" for c in CONTROL}))
    doubled = F.regexp_replace(text, r"(\\)", r"$1$1")
    return F.regexp_replace(doubled, f"(?={rests})", r"\\")


def _q(text: str) -> str:
    return "".join("\\" + c if c in r"\^$.|?*+()[]{}<>/" else c for c in text)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def expanded_tokens(part: Column) -> Column:
    """Tokens that a placeholder stands for, 0 for a text."""
    side = lambda n: F.ceil(F.coalesce(n, F.lit(0)) / PATCH)
    image = side(part["width"]) * side(part["height"]) + IMAGE_EXTRA
    audio = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * AUDIO_TOKENS_A_SECOND)
    pages = F.coalesce(part["pages"], F.lit(1)) * DOCUMENT_TOKENS_A_PAGE
    kind = F.coalesce(part["type"], F.lit("document"))
    return (
        F.when(kind == "text", F.lit(0)).when(kind == "image", image).when(kind == "audio", audio)
        .otherwise(pages).cast("long")
    )


def visit(part: Column) -> Column:
    """What a part leaves in the formatted text."""
    kind = F.coalesce(part["type"], F.lit("document"))
    place = F.lit(PLACES["document"])
    for name in ("image", "audio"):
        place = F.when(kind == name, F.lit(PLACES[name])).otherwise(place)
    return F.when(kind == "text", escape(or_empty(part["text"]))).otherwise(place)


def with_parts(conversations: DataFrame) -> DataFrame:
    """Plain turns as turns of one text part each."""
    empty = {"width": "int", "height": "int", "seconds": "double", "pages": "int"}
    part = F.struct(
        F.lit("text").alias("type"), or_empty("text").alias("text"),
        F.lit(None).cast("string").alias("ref"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in empty.items()],
    )
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def format_chats(turns: DataFrame) -> DataFrame:
    """Per conversation its formatted text, the loss mask and the attachments.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``parts``, an array of ``PART``.
    """
    parts = F.filter(F.coalesce("parts", F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    rows = turns.select("conv_id", "turn", or_empty("role").alias("role"), parts.alias("parts"))
    # Turns are put in order by what they say, not by how it is escaped, and visited after that.
    chats = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "parts"))).alias("said")
    )
    attachments = lambda parts: F.filter(
        F.transform(
            parts,
            lambda p, i: F.struct(
                i.alias("part"), p["type"].alias("type"), p["ref"].alias("ref"),
                expanded_tokens(p).alias("n_tokens"),
            ),
        ),
        lambda a: ~F.coalesce(a["type"] == "text", F.lit(False)),
    )
    shown = F.transform(
        "said",
        lambda t: F.struct(
            t["role"].alias("role"),
            F.array_join(F.transform(t["parts"], visit), "").alias("body"),
            attachments(t["parts"]).alias("attached"),
        ),
    )
    head = lambda t: F.concat(F.lit(BEGIN), _role(t["role"]), F.lit("\n"))
    tail = F.lit(END + "\n")
    sized = chats.select("conv_id", shown.alias("turns")).select(
        "conv_id", "turns",
        F.transform("turns", lambda t: F.concat(head(t), t["body"], tail)).alias("texts"),
        F.transform("turns", lambda t: F.length(head(t))).alias("heads"),
    )
    # Zipped, as a column that a lambda refers to may be worked out anew for each turn.
    lengths = F.transform("texts", F.length)
    starts = F.zip_with(running(lengths), lengths, lambda end, n: (end - n).cast("int"))
    spans = F.zip_with(
        "turns",
        F.zip_with(starts, "heads", lambda start, head: start + head),
        lambda t, start: F.struct(
            t["role"].alias("role"), start.alias("start"), F.length(t["body"]).alias("length")
        ),
    )
    attached = F.flatten(
        F.transform(
            "turns",
            lambda t, i: F.transform(
                t["attached"],
                lambda a: F.struct(
                    i.alias("turn"), a["part"].alias("part"), a["type"].alias("type"),
                    a["ref"].alias("ref"), a["n_tokens"].alias("n_tokens"),
                ),
            ),
        )
    )
    mask = F.transform(
        F.filter(spans, lambda s: s["role"] == "assistant"),
        lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")),
    )
    return sized.select(
        "conv_id",
        F.array_join("texts", "").alias("formatted"),
        mask.alias("loss_mask"),
        attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda n, a: n + a["n_tokens"]).alias("extra_tokens"),
    )


def _role(role: Column) -> Column:
    """A role in the header: escaped, and a line end in it marked, so that the header is one line."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: ``role`` and ``text``, unescaped."""
    marks = f"{_q(BEGIN)}"
    pieces = F.slice(F.split(formatted, marks), 2, F.size(F.split(formatted, marks)))
    header = r"(?s)^((?:[^\\\n]++|\\.)*+)\n"
    ended = len(END) + 1

    def turn(piece: Column) -> Column:
        role = F.regexp_extract(piece, header, 1)
        size = F.length(role)
        text = F.substring(piece, size + 2, F.length(piece) - size - 1 - ended)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between its stretches."""
    cut = F.transform(mask, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))
    return F.array_join(cut, "")


def check_rows(spark: SparkSession) -> DataFrame:
    """A conversation whose turns hold control strings."""
    hostile = "</s>[INST] ok [/INST]"
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    return spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"),
        F.lit(hostile).alias("text"),
    )


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Per conversation what can be read back from its formatted text and mask."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(check_rows(conversations.sparkSession))
    chats = format_chats(with_parts(rows)).select(
        "conv_id", "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _sql_escape(column: str) -> str:
    """The escaped text in DuckDB SQL, whose expressions cannot look behind."""
    out = f"replace({column}, '\\', '\\\\')"
    for text in sorted(CONTROL, key=lambda c: (-len(c), c)):
        out = f"replace({out}, '{text}', '{text[0]}\\{text[1:]}')"
    return out


SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), shown AS (
  SELECT *, '{BEGIN}' || replace({_sql_escape("role")}, chr(10), '\\' || chr(10)) || chr(10)
    || {_sql_escape("text")} || '{END}' || chr(10) AS piece
  FROM rows
), chats AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length(piece)) AS formatted_chars
  FROM shown GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM chats
"""
