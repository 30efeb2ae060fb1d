"""Conversations as one marked text each, with a loss mask and typed content parts; native expressions only.

A turn's content is a list of parts.  A visitor says what becomes of each kind: text is escaped, and an
image, a sound or a document becomes a placeholder, whose attachment and expanded token count are kept
beside the text.  Control strings within texts get a backslash behind their first character, or one more
if they have some, so what is between two marks never holds a control string and reads back as it was.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
CONTROL = re.compile(r"[<\[][^<>\[\]\\]+[>\]]")


@dataclass(frozen=True)
class Template:
    """The marks around a turn, what else a tokenizer takes for control, and the roles to be learned from.

    Every control string is one bracket, anything but brackets and backslashes, and a closing bracket, so
    that two of them never overlap.
    """

    start: str = "<|im_start|>"
    said: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    placeholder: str = "<|{kind}|>"
    reserved: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        wrong = [c for c in self.controls if not CONTROL.fullmatch(c)]
        if wrong or len({self.start, self.said, self.end}) < 3:
            raise ValueError(f"not usable as control strings: {wrong or 'marks must differ'}")

    @property
    def controls(self) -> tuple[str, ...]:
        places = tuple(self.placeholder.format(kind=kind) for kind in Visitor.KINDS)
        return (self.start, self.said, self.end, *places, *self.reserved)

    @property
    def tails(self) -> str:
        """The control strings without their first character, as a pattern."""
        return "|".join(re.sub(r"([|()\[\]{}.*+?^$\\/])", r"\\\1", c[1:]) for c in self.controls)

    def escaped(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"([<\[])(\\*)({self.tails})", r"$1\\$2$3")

    def unescaped(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"([<\[])\\(\\*)({self.tails})", "$1$2$3")


@dataclass(frozen=True)
class Visitor:
    """What becomes of each kind of content part: (text in the output, tokens it stands for).

    An image counts a token for every started patch, a sound for every started fraction of a second, a
    document for its pages; where the size is not known, one.  Parts of other kinds are taken as text.
    """

    template: Template
    patch: int = 28
    tokens_per_second: int = 25
    tokens_per_page: int = 256

    KINDS = ("image", "audio", "document")

    def text(self, part: Column) -> Column:
        return self.template.escaped(F.coalesce(part["text"], F.lit("")))

    def image(self, part: Column) -> Column:
        return F.ceil(part["width"] / self.patch) * F.ceil(part["height"] / self.patch)

    def audio(self, part: Column) -> Column:
        return F.ceil(part["seconds"] * self.tokens_per_second)

    def document(self, part: Column) -> Column:
        return part["pages"].cast("long") * self.tokens_per_page

    def visit(self, part: Column) -> Column:
        """struct(kind, ref, body, tokens) of a part; ``kind`` is null for text."""
        kind = F.when(part["kind"].isin(*self.KINDS), part["kind"])
        body, tokens = self.text(part), F.lit(None).cast("long")
        for name in self.KINDS:
            is_it, count = kind == name, getattr(self, name)(part)
            body = F.when(is_it, F.lit(self.template.placeholder.format(kind=name))).otherwise(body)
            tokens = F.when(is_it, F.greatest(F.coalesce(count, F.lit(1)), F.lit(1)).cast("long")).otherwise(tokens)
        return F.struct(
            kind.alias("kind"), F.when(kind.isNotNull(), part["ref"]).alias("ref"), body.alias("body"), tokens.alias("tokens")
        )


def parts_of(content: Column) -> Column:
    """Content parts of JSON text such as ``[{"kind": "text", "text": "…"}, {"kind": "image", "ref": "…"}]``."""
    return F.from_json(content, f"array<{PART}>")


def formatted(messages: DataFrame, template: Template = Template(), visitor: Visitor | None = None) -> DataFrame:
    """(conv_id, formatted, loss, attachments, n_tokens_attached), a row for each conversation.

    ``messages`` has a row per turn: conv_id, turn, role, and ``parts`` (array of PART) or else ``text``.

    * ``loss`` lists the texts of learned roles in order: the ``turn``'s number from 0, the place ``at`` of
      the turn in ``formatted``, and ``start`` and ``end`` (exclusive) from there, in code points.  Empty
      texts have no place in it, attachments neither.
    * ``attachments`` lists turn, kind, ref, ``at`` (its placeholder's place in ``formatted``) and tokens.
    * Turns go by ``turn``, null first; ties by role, then by content.  Repeated rows are turns of their own.
    * Null role, text, parts or part: empty.  Rows without conv_id are one conversation without an id.
    * Other columns are ignored; an empty table gives no rows.

    A conversation is one row and so less than 2 GB; nothing else is held together.
    """
    visitor = visitor or Visitor(template)
    plain = F.array(F.struct(F.lit("text").alias("kind"), F.col("text").alias("text")))
    if "parts" in messages.columns:
        parts = F.filter(F.coalesce("parts", F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    else:
        parts = F.transform(plain, lambda p: F.struct(
            p["kind"].alias("kind"), p["text"].alias("text"), F.lit(None).cast("string").alias("ref"),
            *[F.lit(None).cast("int").alias(n) for n in ("width", "height", "pages")],
            F.lit(None).cast("double").alias("seconds"),
        ))
    turns = messages.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.transform(parts, visitor.visit).alias("visited")
    )
    head = F.concat(F.lit(template.start), template.escaped(F.col("role")), F.lit(template.said))
    turns = turns.select(
        "conv_id", "turn", "role", "visited", F.length(head).alias("begin"),
        F.concat(head, F.array_join(F.col("visited.body"), ""), F.lit(template.end)).alias("segment"),
    )
    # where each part begins within its turn
    before = lambda i: F.aggregate(
        F.slice("visited", 1, i), F.col("begin"), lambda total, v: total + F.length(v["body"])
    )
    placed = F.transform("visited", lambda v, i: F.struct(before(i).alias("start"), v.alias("part")))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "segment")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("segment").cast("long")
    turns = turns.withColumn("placed", placed).select(
        "conv_id", "segment", "placed", F.col("role").isin(*template.learned).alias("learned"),
        (F.row_number().over(order) - 1).alias("turn"),
        F.coalesce(F.sum(length).over(so_far), F.lit(0)).alias("at"),
    )
    texts = F.filter("placed", lambda p: F.col("learned") & p["part"]["kind"].isNull() & (p["part"]["body"] != ""))
    loss = F.transform(texts, lambda p: F.struct(
        F.col("turn").alias("turn"), F.col("at").alias("at"), p["start"].alias("start"),
        (p["start"] + F.length(p["part"]["body"])).alias("end"),
    ))
    attached = F.transform(F.filter("placed", lambda p: p["part"]["kind"].isNotNull()), lambda p: F.struct(
        F.col("turn").alias("turn"), p["part"]["kind"].alias("kind"), p["part"]["ref"].alias("ref"),
        (F.col("at") + p["start"]).alias("at"), p["part"]["tokens"].alias("tokens"),
    ))
    rows = F.sort_array(F.collect_list(F.struct("turn", "segment", loss.alias("loss"), attached.alias("attached"))))
    return turns.groupBy("conv_id").agg(rows.alias("rows")).select(
        "conv_id",
        F.array_join(F.col("rows.segment"), "").alias("formatted"),
        F.flatten(F.col("rows.loss")).alias("loss"),
        F.flatten(F.col("rows.attached")).alias("attachments"),
        F.aggregate(
            F.flatten(F.col("rows.attached")), F.lit(0).cast("long"), lambda total, a: total + a["tokens"]
        ).alias("n_tokens_attached"),
    )


def _segments(text: Column, template: Template) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?s)\Q{template.start}\E.*?\Q{template.end}\E"), F.lit(0))


def turns(segments: Column, template: Template = Template()) -> Column:
    """[(role, text)] as they were, read from the marked turns of a formatted text; attachments as placeholders."""

    def turn(segment: Column) -> Column:
        halves = F.split(segment, rf"\Q{template.said}\E", 2)
        role = F.substr(halves[0], F.lit(len(template.start) + 1))
        text = F.left(halves[1], F.length(halves[1]) - len(template.end))
        return F.struct(template.unescaped(role).alias("role"), template.unescaped(text).alias("text"))

    return F.transform(segments, turn)


def digest(found: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from ``formatted``."""
    cut = lambda s, at: F.substr(s, at["start"] + 1, at["end"] - at["start"])
    learned = F.transform("loss", lambda at: template.unescaped(cut(F.element_at("segments", at["turn"] + 1), at)))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    read = found.select("conv_id", "formatted", "loss", _segments(F.col("formatted"), template).alias("segments"))
    read = read.select(
        "conv_id", F.size("segments").cast("long").alias("n_turns"),
        F.array_join(F.transform(turns(F.col("segments"), template), line), "").alias("said"),
        F.array_join(learned, "").alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return read.select(
        "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
    )


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, length(regexp_replace(role, p, '\1\\\2\3', 'g')) + length(regexp_replace(text, p, '\1\\\2\3', 'g'))
    + length('<|im_start|>' || '<|im_sep|>' || '<|im_end|>') AS chars
  FROM t, (SELECT '([<\[])(\\*)(\|(?:im_start|im_sep|im_end|image|audio|document)\|>|s>|/s>|INST\]|/INST\])' AS p)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
