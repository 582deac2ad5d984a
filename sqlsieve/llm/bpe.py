"""Byte-level BPE encoding and decoding by tree concatenation.

Texts of up to ``leaf_chars`` code points are encoded in one go. A longer one is cut into leaves,
which become rows of their own and are encoded side by side on all executors; then neighbouring
nodes are joined pair by pair, up a binary tree. A join keeps the tokens of both sides except near
the cut: the text of a few tokens on either side is encoded again, and the window doubles until
its first tokens are those the left side has there and one of its later tokens is one that the
right side has at the same place.

Why the result is exact: a sequence of BPE tokens is the encoding of its text if and only if every
two neighbours are the encoding of their own concatenation, and all neighbours in the joined
sequence are neighbours in the encoding of one of the three texts. The pattern that splits text
before the merges looks at most three characters ahead, a special token's text has no more than
``MARGIN`` bytes, and a token that begins with an apostrophe is never taken as a meeting point;
so further than ``MARGIN`` bytes from its cut each side splits its text as the whole text does.

Rows: a null text is an empty one and has no tokens; repeated rows give repeated results; an empty
table gives an empty one. A column of the input that has the name of a new one is replaced.
"""

from __future__ import annotations

import json

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_chars, or_empty, others, vocabulary_path

LEAF_CHARS = 32_768
FIRST_WINDOW = 32
MARGIN = 16
VOCABULARY = "byte_bpe_50k.json"


def load(path: str):
    """A tokenizers file of kind byte-level BPE as a tiktoken encoding.

    Only files whose ids follow the order of the merges are taken: there both libraries agree.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pre, model = spec["pre_tokenizer"], spec["model"]
    if (spec.get("normalizer"), pre["type"], pre["add_prefix_space"]) != (None, "ByteLevel", False):
        raise ValueError(f"{path}: not plain byte-level BPE")
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    ranks = {
        bytes(byte_of[c] for c in piece): i
        for piece, i in model["vocab"].items()
        if piece not in special
    }
    made = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    ids = [model["vocab"][m.replace(" ", "")] for m in made]
    if ids != sorted(set(ids)):
        raise ValueError(f"{path}: ids do not follow the order of the merges")
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )


def _starts(coder, ids: list[int], at: int) -> list[int]:
    """Byte offsets of the tokens from ``at`` on, and that of the end."""
    out = [at]
    for piece in coder.decode_tokens_bytes(ids):
        out.append(out[-1] + len(piece))
    return out


def _clean(text: bytes, at: int) -> bool:
    """Whether a window may begin or meet here: at a character, and not at an apostrophe."""
    return at >= len(text) or (text[at] & 0xC0 != 0x80 and text[at] != 0x27)


def join_nodes(coder, left: list[int], right: list[int], first_window: int = FIRST_WINDOW):
    """The encoding of the concatenated texts of two encodings."""
    window = first_window
    while True:
        tail, head = left[-window:], right[:window]
        head_text = b"".join(coder.decode_tokens_bytes(head))
        tail_text = b"".join(coder.decode_tokens_bytes(tail))
        text, cut = tail_text + head_text, len(tail_text)
        whole_left, whole_right = len(tail) == len(left), len(head) == len(right)
        ends_well = whole_right or coder_clean_end(coder, right, window)
        if (whole_left or _clean(text, 0)) and ends_well:
            new = coder.encode(text.decode("utf-8"), allowed_special="all")
            new_at, tail_at = _starts(coder, new, 0), _starts(coder, tail, 0)
            same = 0
            while (
                same < min(len(new), len(tail))
                and new[same] == tail[same]
                and tail_at[same + 1] <= cut - MARGIN
            ):
                same += 1
            if whole_left or same:
                if whole_right:
                    return left[: len(left) - len(tail)] + new
                there = dict(zip(_starts(coder, head, cut), enumerate(head)))
                for k, token in enumerate(new):
                    at, end = new_at[k], new_at[k + 1]
                    if (
                        at >= cut
                        and end <= len(text) - MARGIN
                        and there.get(at, (0, -1))[1] == token
                        and _clean(text, at)
                    ):
                        kept = right[there[at][0] + 1 :]
                        return left[: len(left) - len(tail)] + new[: k + 1] + kept
        if whole_left and whole_right:
            return coder.encode(text.decode("utf-8"), allowed_special="all")
        window *= 2


def coder_clean_end(coder, right: list[int], window: int) -> bool:
    """Whether the window's end lies between two characters."""
    return coder.decode_tokens_bytes(right[window : window + 1])[0][0] & 0xC0 != 0x80


def join_tree(coder, nodes: list[list[int]]) -> list[int]:
    """Joins neighbours, level by level, until one node is left."""
    while len(nodes) > 1:
        pairs = [nodes[i : i + 2] for i in range(0, len(nodes), 2)]
        nodes = [join_nodes(coder, *p) if len(p) == 2 else p[0] for p in pairs]
    return nodes[0] if nodes else []


def _result(coder, ids: list[np.ndarray], decoded: bool) -> pd.DataFrame:
    """Ids, and the texts decoded from them where asked for."""
    texts = [coder.decode(i.tolist()) if decoded else None for i in ids]
    return pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded": pd.Series(texts, dtype=object)})


def _encoder(path: str, decoded: bool):
    @F.pandas_udf("ids array<int>, decoded string")
    def encode_texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = load(path)
        for batch in batches:
            for texts in by_chars(batch):
                ids = [coder.encode_to_numpy(t, allowed_special="all") for t in texts]
                yield _result(coder, ids, decoded)

    return encode_texts.asNondeterministic()


def _joiner(path: str, decoded: bool):
    @F.pandas_udf("ids array<int>, decoded string")
    def join_leaves(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = load(path)
        for batch in batches:
            for rows in by_chars(batch, 32):
                trees = (join_tree(coder, [n.tolist() for n in nodes]) for nodes in rows)
                yield _result(coder, [np.array(t, dtype=np.int32) for t in trees], decoded)

    return join_leaves.asNondeterministic()


def encode(
    docs: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None,
    leaf_chars: int = LEAF_CHARS, decoded: str | None = None,
) -> DataFrame:
    """The columns of ``docs`` but the text, and in its place the token ids.

    ``decoded`` names a further column for the text that the ids decode to.

    A special token's text is that token. Only long texts are shuffled, as leaves; equal rows are
    combined before that, counted, and given back as often.
    """
    path = path or vocabulary_path(VOCABULARY)
    kept = others(docs, ids, text, *([decoded] if decoded else [])) or [F.lit(None).cast("int").alias("_nothing")]
    plain = F.coalesce(docs[f"`{text}`"], F.lit(""))
    rows = docs.select(F.struct(*kept).alias("row"), plain.alias("body"))
    short = rows.where(F.length("body") <= leaf_chars)
    long = rows.where(F.length("body") > leaf_chars)
    short = short.select("row", _encoder(path, bool(decoded))("body").alias("found"))

    cut = F.expr(f"explode(sequence(0, int((length(body) - 1) div {leaf_chars})))")
    part = F.expr(f"substring(body, 1 + leaf * {leaf_chars}, {leaf_chars})")
    leaves = (
        long.select(F.sha2(F.to_json(F.struct("row", "body")), 256).alias("key"), "row", "body")
        .select("key", "row", "body", cut.alias("leaf"))
        .select("key", "leaf", part.alias("part"), F.when(F.expr("leaf = 0"), F.col("row")).alias("row"))
        .groupBy("key", "leaf")
        .agg(F.first("part").alias("part"), F.first("row").alias("row"), F.count("*").alias("n"))
        .select("key", "leaf", "row", "n", _encoder(path, False)("part").alias("found"))
    )
    trees = (
        leaves.groupBy("key")
        .agg(
            F.sort_array(F.collect_list(F.struct("leaf", "found.ids"))).alias("nodes"),
            F.first("row", ignorenulls=True).alias("row"),
            F.max("n").alias("n"),
        )
        .select("row", "n", _joiner(path, bool(decoded))(F.col("nodes.ids")).alias("found"))
        .select("row", "found", F.expr("explode(sequence(1, int(n)))").alias("copy"))
        .select("row", "found")
    )
    new = [F.col("found.ids").alias(ids)]
    if decoded:
        new.append(F.col("found.decoded").alias(decoded))
    return short.unionByName(trees).select("row.*", *new).drop("_nothing")


def decode(ids: Column | str, path: str | None = None) -> Column:
    """The text of token ids, special tokens as their texts; null ids give an empty text."""
    path = path or vocabulary_path(VOCABULARY)

    @F.pandas_udf("string")
    def decode_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = load(path)
        for rows in batches:
            yield pd.Series(
                [coder.decode(r.tolist()) if r is not None else "" for r in rows],
                index=rows.index,
            )

    return decode_ids.asNondeterministic()(ids)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document the digests of its ids and of the text decoded from them."""
    both = encode(docs.select("doc_id", "text"), path=path, decoded="decoded")
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2(or_empty("decoded"), 256).alias("decoded_sha256"),
    )
