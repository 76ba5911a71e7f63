"""Conversations: roles, turns, pairs of a question and its answer, and what a turn may see."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The roles that other vocabularies name.
ROLES = {"system": "system", "human": "user", "user": "user", "gpt": "assistant", "assistant": "assistant"}


def role_of(role: Column) -> Column:
    """The role in our vocabulary; null for roles it doesn't know, and for null."""
    out = F.lit(None).cast("string")
    for name, mapped in ROLES.items():
        out = F.when(role == name, F.lit(mapped)).otherwise(out)
    return out


def first_filled(*columns: Column) -> Column:
    """The first column that is neither null nor empty, else an empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def to_messages(conversations: Column) -> Column:
    """Turns {from, value} as {role, content}: turns of unknown roles drop out, null values are empty. Null for a null list."""
    turns = F.transform(conversations, lambda t: F.struct(role_of(t["from"]).alias("role"), F.coalesce(t["value"], F.lit("")).alias("content")))
    return F.filter(turns, lambda m: m["role"].isNotNull())


def has_answer(messages: Column) -> Column:
    """Whether some assistant turn has a content; false for null."""
    return F.coalesce(F.exists(messages, lambda m: F.coalesce((m["role"] == "assistant") & (m["content"] != ""), F.lit(False))), F.lit(False))


def list_size(df: DataFrame, name: str) -> Column:
    """The length of a list column, null for a null list. Of a list of structs only one small field is read, so counting images doesn't read their bytes."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        small = [f.name for f in kind.elementType.fields if not isinstance(f.dataType, (T.BinaryType, T.ArrayType, T.MapType, T.StructType))]
        if small:
            inner = F.col(name)[small[0]]
            return F.when(inner.isNotNull(), F.size(inner))
    return F.when(F.col(name).isNotNull(), F.size(name))


def convert(raw: DataFrame, images: str = "images", conversations: str = "conversations") -> DataFrame:
    """Rows with images and turns of which some answer isn't empty, with their `messages`."""
    kept = raw.where((list_size(raw, images) > 0) & (F.size(conversations) > 0))
    return kept.withColumn("messages", to_messages(F.col(conversations))).where(has_answer(F.col("messages")))


def turns(rows: DataFrame, key: str, messages: str = "messages") -> DataFrame:
    """(key, turn from 0, role, content) of every turn; null and empty lists have none."""
    t = rows.select(key, F.posexplode(messages).alias("turn", "m"))
    return t.select(key, "turn", F.col("m")["role"].alias("role"), F.col("m")["content"].alias("content"))


def lower_roles(messages: Column) -> Column:
    """The same turns with roles in our vocabulary, whatever their case; unknown roles become null."""
    return F.transform(messages, lambda m: F.struct(role_of(F.lower(F.trim(m["role"]))).alias("role"), m["content"].alias("content")))


def answered_in(messages: Column, texts: bool = True) -> Column:
    """Of a list of turns, the user turns directly followed by an assistant turn: structs of turn (from 0), users_so_far and, with `texts`, question and answer.

    Null for a null list. It works in the row, in one pass over its turns.
    """
    asked = F.filter(F.transform(messages, lambda m, i: F.when(m["role"] == "user", i)), lambda i: i.isNotNull())
    word = lambda t: [F.get(messages, t)["content"].alias("question"), F.get(messages, t + 1)["content"].alias("answer")] if texts else []
    each = F.transform(asked, lambda t, k: F.struct(t.alias("turn"), (k + 1).cast("bigint").alias("users_so_far"), F.get(messages, t + 1)["role"].alias("next"), *word(t)))
    return F.filter(each, lambda p: F.coalesce(p["next"] == "assistant", F.lit(False)))


def answered(rows: DataFrame, *keep: str, messages: str = "messages", texts: bool = True) -> DataFrame:
    """The columns `keep` with each pair of `answered_in`: turn, pair (from 0), users_so_far, question and answer. Rows aren't moved."""
    p = rows.select(*keep, F.posexplode(answered_in(F.col(messages), texts)).alias("pair", "_p"))
    return p.select(*keep, F.col("_p.turn").alias("turn"), "pair", F.col("_p.users_so_far").alias("users_so_far"), *([F.col("_p.question").alias("question"), F.col("_p.answer").alias("answer")] if texts else []))


#: The marks of a chat template around a turn.
TURN_BEGIN, TURN_END = "<|im_start|>", "<|im_end|>"


def rendered(messages: Column) -> Column:
    """The turns as one text in the chat template's form: the role in the first line, then the content; null roles and contents are empty. Empty for a null list."""
    one = lambda m: F.concat(F.lit(TURN_BEGIN), F.coalesce(m["role"], F.lit("")), F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit(TURN_END + "\n"))
    return F.coalesce(F.array_join(F.transform(messages, one), ""), F.lit(""))


def context(messages: Column, turn: Column) -> Column:
    """The turns up to and with `turn`."""
    return F.slice(messages, F.lit(1), turn + 1)
