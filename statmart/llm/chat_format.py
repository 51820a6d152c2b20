"""Chat formatting from every speaker's side (operator 10).

For each participant of a conversation the dialogue is rendered once, with
that speaker as the assistant and all others as named users. The result has a
row per conversation, perspective and turn: its place, its text and the span of
it that is trained on. Segments in order of ``seq`` make up the rendered
dialogue; offsets count its code points.

    <|system|>\\n{text}<|end|>\\n
    <|user name={speaker}|>\\n{text}<|end|>\\n
    <|assistant|>\\n{text}<|end|>\\n        trained on: {text}<|end|>

Participants are the distinct roles but ``system``, whose turns stay system
turns in every perspective. "<|" in a text or name becomes "<||", so no text
can forge a marker, and the text can be restored.

Rows instead of one long string per perspective keep a conversation of any
length within bounded memory; running sums are taken over chunks of the
ordered turns, so one conversation with a third of all rows is spread out.

Defined results: turns are ordered by turn (null first), then role, then text;
equal rows follow each other; a null text is empty; a turn without a role is
of a nameless user and has no perspective of its own; turns without conv_id
are one conversation; a conversation of system turns only has no rows; an
empty table gives no rows; extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.llm.common import table
from statmart.operators.prefix import chunked, sums_before

SYSTEM = "system"
END = "<|end|>"


def escaped(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("<||"))


def header(role: Column) -> Column:
    """The marker of a turn that is not the assistant's."""
    return F.when(role == SYSTEM, "<|system|>\n").when(role.isNull(), "<|user|>\n").otherwise(
        F.concat(F.lit("<|user name="), escaped(role), F.lit("|>\n"))
    )


def perspectives(turns: DataFrame) -> DataFrame:
    """conv_id, participant, seq, turn, speaker, is_assistant, segment, start, end, train_start, train_end.

    ``train_start`` and ``train_end`` are null where nothing is trained on.
    """
    ordered = chunked(turns.select("conv_id", "turn", "role", "text"), ["conv_id", "turn", "role", "text"])
    # Places and lengths are worked out on slim rows; texts are joined to them at the end.
    slim = ordered.select(
        "conv_id", "turn", "role", "chunk", "place", (F.length(escaped(F.col("text"))) + len(END) + 1).alias("length")
    )
    numbered = sums_before(slim, ["conv_id"], {"seq": F.lit(1)})
    speakers = (
        turns.where(F.col("role").isNotNull() & (F.col("role") != SYSTEM))
        .select(F.col("conv_id").alias("conv"), F.col("role").alias("participant")).distinct()
    )
    seen = numbered.join(speakers, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv")
    is_assistant = F.coalesce(F.col("role") == F.col("participant"), F.lit(False))
    marked = seen.withColumn("is_assistant", is_assistant).withColumn(
        "marker", F.when(F.col("is_assistant"), "<|assistant|>\n").otherwise(header(F.col("role")))
    ).withColumn("length", F.col("length") + F.length("marker"))
    located = sums_before(marked, ["conv_id", "participant"], {"start": F.col("length").cast("long")})
    end = F.col("start") + F.col("length")
    return located.join(ordered.select("place", "text"), "place").select(
        "conv_id", "participant", F.col("seq").cast("long"), "turn", F.col("role").alias("speaker"), "is_assistant",
        F.concat("marker", escaped(F.col("text")), F.lit(END + "\n")).alias("segment"),
        "start", end.alias("end"),
        F.when(F.col("is_assistant"), F.col("start") + F.length("marker")).alias("train_start"),
        F.when(F.col("is_assistant"), end - 1).alias("train_end"),
    )


def op10_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives(table(spark, sf_dir, "conversations"))
