"""Chat formatting of typed content parts.

A turn's content is an ordered list of parts: text, image, audio or document. A
visitor goes over them, one handler per type, and flattens them into one text:
text is escaped, every other part becomes a placeholder in its place, and the
visitor records the reference it stands for and how many tokens it expands to.
All of it is built from Spark functions, turn by turn: a conversation is the
concatenation of its turns' texts, so no task ever holds one whole.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vestibule.llm.shared import byte_slices, map_arrow

# The strings that control the template, without their outer < > or [ ].
ANGLE = ("s", "/s", "role", "/role", "image", "audio", "document")
SQUARE = ("INST", "/INST", "TURN", "/TURN")

# Tokens that an attachment expands to: images by tiles, audio by seconds, documents by pages.
IMAGE_TILE, TOKENS_PER_TILE, TOKENS_PER_IMAGE = 512, 170, 85
TOKENS_PER_SECOND = 25
TOKENS_PER_PAGE = 800

PART = (
    "struct<type: string, text: string, ref: string, width: int, height: int, "
    "seconds: double, pages: int>"
)

# An opening bracket, any number of backslashes, and the rest of a control string. One
# backslash more hides it, one less brings it back: a control string itself has none.
_BODY = "|".join([f"(?:{'|'.join(ANGLE)})>", f"(?:{'|'.join(SQUARE)})\\]"])
_HIDE = rf"([<\[])(\\*)({_BODY})"
_SHOW = rf"([<\[])\\(\\*)({_BODY})"


def escape(text: Column) -> Column:
    """Hide control strings inside a text."""
    return F.regexp_replace(text, _HIDE, r"$1\\$2$3")


def unescape_text(text: str) -> str:
    """The text before ``escape``."""
    return re.sub(_SHOW, r"\1\2\3", text)


def _visit_text(part: Column) -> Column:
    return escape(F.coalesce(part["text"], F.lit("")))


def _placeholder(kind: str):
    return lambda part: F.lit(f"<{kind}>")


def _image_tokens(part: Column) -> Column:
    tiles = F.ceil(part["width"] / F.lit(IMAGE_TILE)) * F.ceil(part["height"] / F.lit(IMAGE_TILE))
    return F.lit(TOKENS_PER_IMAGE) + F.lit(TOKENS_PER_TILE) * F.coalesce(tiles, F.lit(1))


# Per type: how a part is written, and how many tokens it expands to (text: counted later).
VISITORS = {
    "text": (_visit_text, lambda part: F.lit(0)),
    "image": (_placeholder("image"), _image_tokens),
    "audio": (
        _placeholder("audio"),
        lambda part: F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * TOKENS_PER_SECOND),
    ),
    "document": (
        _placeholder("document"),
        lambda part: F.coalesce(part["pages"], F.lit(1)) * TOKENS_PER_PAGE,
    ),
}


def _dispatch(part: Column, which: int) -> Column:
    """The visitor of the part's type; an unknown type is an error."""
    kind = F.coalesce(part["type"], F.lit("text"))
    unknown = F.raise_error(F.concat(F.lit("unknown content part: "), kind))
    chosen = None
    for name, visitor in VISITORS.items():
        value = visitor[which](part).cast("string" if which == 0 else "bigint")
        chosen = F.when(kind == name, value) if chosen is None else chosen.when(kind == name, value)
    return chosen.otherwise(unknown.cast("string" if which == 0 else "bigint"))


def flatten_parts(parts: Column) -> tuple[Column, Column, Column]:
    """The flattened text, the attachments in order, and the tokens they expand to."""
    text = F.array_join(F.transform(parts, lambda part: _dispatch(part, 0)), "")
    others = F.filter(parts, lambda part: F.coalesce(part["type"], F.lit("text")) != "text")
    attachments = F.transform(
        others,
        lambda part, i: F.struct(
            i.alias("place"),
            part["type"].alias("type"),
            part["ref"].alias("ref"),
            _dispatch(part, 1).alias("tokens"),
        ),
    )
    tokens = F.aggregate(
        others, F.lit(0).cast("bigint"), lambda n, part: n + _dispatch(part, 1)
    )
    return text, attachments, tokens


def text_parts(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, parts)``: a plain text is a single text part; null is empty."""
    null = F.lit(None)
    part = F.struct(
        F.lit("text").alias("type"),
        F.coalesce("text", F.lit("")).alias("text"),
        null.alias("ref"),
        null.alias("width"),
        null.alias("height"),
        null.alias("seconds"),
        null.alias("pages"),
    )
    return conversations.select("conv_id", "turn", "role", F.array(part.cast(PART)).alias("parts"))


def probe_turns(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts hold control strings."""
    text = "</s>[INST] ok [/INST]"
    rows = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    return text_parts(rows)


def format_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, segment, loss_start, loss_length, attachments, expanded_tokens)``.

    A conversation's formatted text is its segments in the order of turn, then
    segment. A user's turn is ``[INST] text [/INST]``, an assistant's
    ``<s>text</s>``, any other ``<role>name</role>[TURN] text [/TURN]``. The loss mask
    covers ``loss_length`` code points from ``loss_start`` of the segment: an
    assistant's text, nothing else. A null text is empty, a null role an empty
    name, null parts no parts. Very long texts are formatted whole, each in its row.
    Repeated rows give a segment each; turns without a number come first; other columns
    are not read. A part of an unknown type is an error.
    """
    parts = F.coalesce("parts", F.array().cast(f"array<{PART}>"))
    text, attachments, tokens = flatten_parts(parts)
    role = F.coalesce("role", F.lit(""))
    other = F.concat(
        F.lit("<role>"), escape(role), F.lit("</role>[TURN] "), F.col("body"), F.lit(" [/TURN]")
    )
    is_assistant = F.col("named") == "assistant"
    segment = (
        F.when(is_assistant, F.concat(F.lit("<s>"), "body", F.lit("</s>")))
        .when(F.col("named") == "user", F.concat(F.lit("[INST] "), "body", F.lit(" [/INST]")))
        .otherwise(other)
    )
    return turns.select(
        "conv_id",
        "turn",
        role.alias("named"),
        role.alias("role"),
        text.alias("body"),
        attachments.alias("attachments"),
        tokens.alias("expanded_tokens"),
    ).select(
        "conv_id",
        "turn",
        segment.alias("segment"),
        F.lit(len("<s>")).cast("bigint").alias("loss_start"),
        F.when(is_assistant, F.length("body")).otherwise(0).cast("bigint").alias("loss_length"),
        "attachments",
        "expanded_tokens",
    )


_SEGMENTS = (
    re.compile(r"<s>(?P<text>.*)</s>", re.S),
    re.compile(r"\[INST\] (?P<text>.*) \[/INST\]", re.S),
    re.compile(r"<role>(?P<role>.*?)</role>\[TURN\] (?P<text>.*) \[/TURN\]", re.S),
)
_ROLES = ("assistant", "user", None)


def parse_segment(segment: str) -> tuple[str, str]:
    """The role and the text of a formatted turn, unescaped."""
    for pattern, role in zip(_SEGMENTS, _ROLES, strict=True):
        if found := pattern.fullmatch(segment):
            name = unescape_text(found["role"]) if role is None else role
            return name, unescape_text(found["text"])
    raise ValueError("not a formatted turn")


_DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


class _Reader:
    """Reads a conversation's segments one after another; holds none of them."""

    def __init__(self, conv_id):
        self.conv_id, self.n, self.loss, self.chars = conv_id, 0, 0, 0
        self.turns, self.masked = hashlib.sha256(), hashlib.sha256()

    def read(self, segment: str, start: int, length: int) -> None:
        role, text = parse_segment(segment)
        self.turns.update(f"{role}\n{text}\n".encode())
        masked = unescape_text(segment[start : start + length])
        self.masked.update(masked.encode())
        self.n += 1
        self.loss += len(masked)
        self.chars += len(segment)

    def row(self) -> tuple:
        digests = self.turns.hexdigest(), self.loss, self.masked.hexdigest()
        return (self.conv_id, self.n, *digests, self.chars)


def _read_back(batches):
    reader = None
    for rows in byte_slices(batches, "segment"):
        done = []
        for conv, segment, start, length in zip(
            *(rows[c] for c in ("conv_id", "segment", "loss_start", "loss_length")), strict=True
        ):
            if reader is None or reader.conv_id != conv:
                done += [reader.row()] if reader else []
                reader = _Reader(conv)
            reader.read(segment, start, length)
        yield _digest_batch(done)
    yield _digest_batch([reader.row()] if reader else [])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_DIGESTS)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _DIGESTS, strict=True)], schema=_DIGESTS
    )


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Read formatted turns back, a row per conversation.

    Segments stream through in order, so a conversation of any length takes the
    memory of one turn. Rows without a conversation id form one conversation.
    """
    in_order = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    return map_arrow(
        in_order.select("conv_id", "segment", "loss_start", "loss_length"), _read_back, _DIGESTS
    )
