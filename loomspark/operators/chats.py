"""Messages, conversations and the chat table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.text import media_type
from loomspark.session import lookup

_CONTENT = "struct<type:string,text:string,hash:string>"
_MESSAGE = f"struct<role:string,content:array<{_CONTENT}>,text:{_CONTENT},tool_calls:array<struct<name:string,arguments:string>>>"


def text_content(text: Column) -> Column:
    return F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("hash"))


def media_content(kind: Column, digest: Column) -> Column:
    return F.struct(kind.alias("type"), F.lit(None).cast("string").alias("text"), digest.alias("hash"))


def message(role: str | Column, *content: Column) -> Column:
    """A system, user or tool message."""
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), F.array(*content).alias("content"), F.lit(None).cast(_CONTENT).alias("text"), F.lit(None).cast("array<struct<name:string,arguments:string>>").alias("tool_calls")).cast(_MESSAGE)


def assistant(text: Column, calls: Column | None = None) -> Column:
    """An assistant message; its tool calls are an empty list rather than null."""
    none = F.array().cast("array<struct<name:string,arguments:string>>")
    return F.struct(F.lit("assistant").alias("role"), F.lit(None).cast(f"array<{_CONTENT}>").alias("content"), text_content(text).alias("text"), (none if calls is None else F.coalesce(calls, none)).alias("tool_calls")).cast(_MESSAGE)


def chat_json(messages: Column) -> Column:
    """{"messages": [...]} with absent fields left out; arguments of tool calls as JSON, not as quoted text."""
    calls = lambda m: F.transform(m["tool_calls"], lambda c: F.struct(c["name"].alias("name"), F.try_parse_json(c["arguments"]).alias("arguments")))
    shaped = F.transform(messages, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), m["text"].alias("text"), calls(m).alias("tool_calls")))
    return F.to_json(F.struct(shaped.alias("messages")))


def ordered(order: Column, value: Column) -> Column:
    """Aggregate: the values of a group as an array in an order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"])


def chat_rows(turns: DataFrame, ai_enhanced: bool = False, roles: tuple[str, ...] = ("user", "assistant", "system", "tool")) -> DataFrame:
    """Turns (conv_id, turn, role, text) to conversations: conv_id, messages. Other roles are dropped."""
    kept = turns.filter(F.col("role").isin(*roles))
    text = F.coalesce("text", F.lit(""))
    made = F.when(F.col("role") == "assistant", assistant(text)).otherwise(message(F.col("role"), text_content(text)))
    return kept.groupBy("conv_id").agg(ordered(F.col("turn"), made).alias("messages")).withColumn("ai_enhanced", F.lit(ai_enhanced))


def translation_chats(pairs: DataFrame, prompt: str, least: int = 3, allow: DataFrame | None = None) -> DataFrame:
    """Pairs (source, question, answer), each of at least ``least`` characters, to system, user and assistant messages.

    allow: the sources whose pairs are translations; all of them without it."""
    if allow is not None:
        pairs = pairs.join(lookup(allow.select("source").distinct()), "source", "left_semi")
    kept = pairs.filter((F.length("question") >= least) & (F.length("answer") >= least))
    return kept.select("source", F.array(message("system", text_content(F.lit(prompt))), message("user", text_content(F.col("question"))), assistant(F.col("answer"))).alias("messages"))


def tool_calls(attachments: Column) -> Column:
    """Attachments (type, value) that hold a tool call."""
    held = F.filter(attachments, lambda a: a["type"] == "application/json/tool_call")
    return F.transform(held, lambda a: F.struct(F.get_json_object(a["value"], "$.function.name").alias("name"), F.get_json_object(a["value"], "$.function.arguments").alias("arguments")))


def media_refs(attachments: Column) -> Column:
    """Digests that attachments (type, value) refer to."""
    held = F.filter(attachments, lambda a: (a["type"] == "application/pdf/sha256sum") | F.startswith(a["value"], F.lit("sha256sum:")))
    return F.transform(held, lambda a: F.replace(a["value"], F.lit("sha256sum:"), F.lit("")))


def instruct_chats(chats: DataFrame, attachments: DataFrame) -> DataFrame:
    """Published chats (conv_id, messages array<struct<role, content, attachments>>, mistakes) to the chat form.

    attachments: hash, content. A reference without an attachment drops out; media follow the user's text, which is left out when
    empty; assistants keep empty text; unknown roles are dropped. Chats without references take part in no join.
    """
    one = chats.withColumn("has", F.exists("messages", lambda m: (m["role"] == "user") & (F.size(media_refs(m["attachments"])) > 0)))
    known = attachments.groupBy("hash").agg(F.first(media_type(F.col("content"))).alias("kind"))
    refs = one.filter("has").select("conv_id", F.posexplode("messages").alias("at", "m")).filter("m.role = 'user'")
    refs = refs.select("conv_id", "at", F.posexplode(media_refs(F.col("m.attachments"))).alias("i", "hash"))
    kinds = refs.join(known, "hash").groupBy("conv_id").agg(F.collect_list(F.struct("at", "i", "kind", "hash")).alias("media"))
    both = one.filter("has").join(kinds, "conv_id", "left").unionByName(one.filter(~F.coalesce("has", F.lit(False))).withColumn("media", F.lit(None).cast("array<struct<at:int,i:int,kind:string,hash:string>>")))

    def made(m: Column, at: Column) -> Column:
        text = F.coalesce(m["content"], F.lit(""))
        own = F.array_sort(F.filter(F.coalesce("media", F.array().cast("array<struct<at:int,i:int,kind:string,hash:string>>")), lambda x: x["at"] == at))
        media = F.transform(own, lambda x: media_content(x["kind"], x["hash"]).cast(_CONTENT))
        written = F.when((m["role"] == "user") & (text == ""), F.array().cast(f"array<{_CONTENT}>")).otherwise(F.array(text_content(text).cast(_CONTENT)))
        content = F.when(m["role"] == "user", F.concat(written, media)).otherwise(written)
        other = F.struct(m["role"].alias("role"), content.alias("content"), F.lit(None).cast(_CONTENT).alias("text"), F.lit(None).cast("array<struct<name:string,arguments:string>>").alias("tool_calls")).cast(_MESSAGE)
        return F.when(m["role"] == "assistant", assistant(text, tool_calls(m["attachments"]))).otherwise(other)

    messages = F.filter(F.transform("messages", made), lambda m: m["role"].isin("user", "assistant", "system", "tool"))
    return both.select("conv_id", messages.alias("messages"), F.coalesce("mistakes", F.lit(False)).alias("ai_enhanced"))
