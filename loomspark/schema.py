"""The two output tables, text and chats, and the types they are made of."""

from pyspark.sql import types as T

CONTENT = T.StructType([T.StructField("type", T.StringType()), T.StructField("text", T.StringType()), T.StructField("hash", T.StringType())])
TOOLCALL = T.StructType([T.StructField("name", T.StringType()), T.StructField("arguments", T.StringType())])
MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.ArrayType(CONTENT)), T.StructField("text", CONTENT), T.StructField("tool_calls", T.ArrayType(TOOLCALL))]
)
TEXT = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("source", T.StringType()), T.StructField("collected_at", T.TimestampType()), T.StructField("ai_enhanced", T.BooleanType())]
)
CHAT = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE)), *TEXT.fields[1:]])
