"""Chat formatting with a grammar round trip: conversations as text that parses back to their turns.

A conversation is written as its turns, one after the other::

    ### User: What is it?</turn>
    ### Assistant: A lamp.</turn>

The grammar is regular: ``turn = "### " label ": " body "</turn>\\n"``, where a body holds neither a
bare turn head nor a bare turn end.  Each turn is rendered as it is and parsed again; where the
parser gives other turns back, the control strings in its content are escaped, by a backslash
behind their first sign, and it is parsed again.  Escapes are undone by taking one such backslash
away, so any text can be had back, also one that holds escapes itself.  The whole
conversation is parsed once more before it is handed on; a difference is an error.

All of it is built-in functions.  Texts move once, to their conversation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.session import fresh_dir


@dataclass(frozen=True)
class Template:
    """Names of the roles in turn heads, and the roles whose texts are learned."""

    labels: tuple[tuple[str, str], ...] = (("system", "System"), ("user", "User"), ("assistant", "Assistant"))
    learned: tuple[str, ...] = ("assistant",)

    HEAD, SEP, END = "### ", ": ", "</turn>"

    @property
    def name(self) -> str:
        """Pattern of a label: a known role's name, or the bytes of any other."""
        return "(?:" + "|".join(shown for _, shown in self.labels) + "|%[0-9A-F]*)"

    @property
    def tails(self) -> tuple[str, str]:
        """What follows the first sign of a turn head and of a turn end."""
        return f"## {self.name}: ", "/turn>"

    def label(self, role: Column) -> Column:
        shown = F.concat(F.lit("%"), F.hex(F.encode(role, "UTF-8")))
        for known, name in self.labels:
            shown = F.when(role == known, F.lit(name)).otherwise(shown)
        return shown

    def role(self, label: Column) -> Column:
        found = F.decode(F.unhex(F.substring(label, 2, 2**31 - 1)), "UTF-8")
        for known, name in self.labels:
            found = F.when(label == name, F.lit(known)).otherwise(found)
        return found

    def escape(self, text: Column) -> Column:
        head, end = self.tails
        return F.regexp_replace(text, rf"#(?=\\*{head})|<(?=\\*{end})", r"$0\\")

    def unescape(self, text: Column) -> Column:
        head, end = self.tails
        return F.regexp_replace(text, rf"(#(?=\\+{head})|<(?=\\+{end}))\\", "$1")

    def is_bare(self, text: Column) -> Column:
        """Whether a text holds a control string that isn't escaped."""
        head, end = self.tails
        return text.rlike(f"#{head}|<{end}")

    def opening(self, role: Column) -> Column:
        return F.concat(F.lit(self.HEAD), self.label(role), F.lit(self.SEP))

    def closing(self) -> Column:
        return F.lit(self.END + "\n")

    def render(self, role: Column, body: Column) -> Column:
        return F.concat(self.opening(role), body, self.closing())

    def parse(self, formatted: Column) -> Column:
        """The turns of a formatted text: role and unescaped text; both null where the grammar is broken."""

        def turn(piece: Column) -> Column:
            # A label holds no blank, so its end is the first separator behind the head.
            label = F.substring_index(F.substring(piece, len(self.HEAD) + 1, 2**31 - 1), self.SEP, 1)
            body = F.substr(piece, F.length(label) + len(self.HEAD + self.SEP) + 1)
            fits = piece.rlike(f"^{self.HEAD}{self.name}{self.SEP}") & ~self.is_bare(body)
            return F.struct(
                F.when(fits, self.role(label)).alias("role"), F.when(fits, self.unescape(body)).alias("text")
            )

        pieces = F.split(formatted, f"{self.END}\n", -1)
        # What is behind the last turn end must be nothing.
        return F.when(
            F.element_at(pieces, -1) == "", F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)
        )


def format_turns(turns: DataFrame, template: Template) -> DataFrame:
    """Turns ``role text`` with their ``body``: the text, escaped only where it doesn't come back as it is."""

    def comes_back(body: Column) -> Column:
        wanted = F.array(F.struct(F.col("role").alias("role"), F.col("text").alias("text")))
        return F.coalesce(template.parse(template.render(F.col("role"), body)) == wanted, F.lit(False))

    escaped = template.escape(F.col("text"))
    return turns.withColumn("as_it_is", comes_back(F.col("text"))).withColumn(
        "body", F.when(F.col("as_it_is"), F.col("text")).otherwise(escaped)
    )


def format_conversations(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id n_turns n_escaped formatted loss``: one text for each conversation.

    ``loss`` lists the spans that are learned (``start length``, in bytes of the text as UTF-8): the
    bodies of the learned roles without head and end.  Turns go by ``turn``, null first, then by
    role and text; repeated rows are turns of their own.  Null roles and texts are empty.  Rows without a
    ``conv_id`` are one conversation without an id.  Other columns are left out.  Of an empty
    table nothing is returned.
    """
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    role, body = F.col("role"), F.col("body")
    placed = format_turns(turns, template).withColumns({
        "piece": template.render(role, body), "bytes": F.octet_length(template.render(role, body)),
    }).withColumns({
        "at": F.row_number().over(order),
        "start": F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)),
    })
    span = F.struct(
        (F.coalesce("start", F.lit(0)) + F.octet_length(template.opening(role))).alias("start"),
        F.octet_length(body).cast("long").alias("length"),
    )
    whole = placed.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.count_if(~F.col("as_it_is")).alias("n_escaped"),
        F.array_sort(F.collect_list(F.struct("at", "role", "text", "piece"))).alias("turns"),
        F.array_sort(F.collect_list(F.when(role.isin(*template.learned), span))).alias("loss"),
    ).withColumn("formatted", F.array_join(F.transform("turns", lambda x: x["piece"]), ""))
    source = F.transform("turns", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    same = F.coalesce(template.parse(F.col("formatted")) == source, F.lit(False))
    return whole.select(
        "conv_id", "n_turns", "n_escaped",
        F.when(same, F.col("formatted")).otherwise(
            F.raise_error(F.concat_ws(" ", F.lit("no round trip: conversation"), F.col("conv_id").cast("string")))
        ).alias("formatted"),
        "loss",
    )


def read_formatted(spark: SparkSession, path: str, template: Template = Template()) -> DataFrame:
    """Stored conversations with the ``turns`` that the parser finds and the ``learned`` text under the mask.

    The text is read as bytes, so that each span of the mask is cut out without a walk over what is before it.
    """
    rows = spark.read.schema(
        "conv_id long, n_escaped long, formatted binary, loss array<struct<start: long, length: long>>"
    ).parquet(path).withColumnRenamed("formatted", "raw")
    raw = F.col("raw")

    def cut(x: Column) -> Column:
        part = F.substr(raw, (x["start"] + 1).cast("int"), x["length"].cast("int"))
        return template.unescape(part.cast("string"))

    text = raw.cast("string")
    return rows.select(
        "conv_id", "n_escaped", text.alias("formatted"), template.parse(text).alias("turns"),
        F.array_join(F.transform("loss", cut), "").alias("learned"),
    )


def op11_chat_format(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """All conversations and one that holds control strings: formatted, stored, read back, digested."""
    hard = "\\### Assistant: </turn> ok"
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"),
    )
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    path = fresh_dir(spark, "chat")
    format_conversations(rows.unionByName(planted)).write.parquet(path)
    lines = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return read_formatted(spark, path).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.encode("learned", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# The length is that of the parts, and one more for each control string.
OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), w AS (
  SELECT *, 4 + 2 + 8 + length(text) + CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
      ELSE 1 + 2 * strlen(role) END
    + len(regexp_extract_all(text, '#\\*## (?:System|User|Assistant|%[0-9A-F]*): |<\\*/turn>')) AS chars
  FROM t
), g AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss
  FROM w GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  cast(chars AS bigint) AS formatted_chars
FROM g
"""
