"""Ways to get turn rows: Parquet turns, single messages, nested chat documents."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from talkweave.schema import CHAT_DOCUMENT_SCHEMA, TURN_SCHEMA, conform
from talkweave.staging import materialise

BLOCK = 4096
POSITION = ["turn", "role", "text"]


def scan_turns(spark: SparkSession, path: str) -> DataFrame:
    """Turn rows of the Parquet files directly below ``path``; ``_`` files are skipped."""
    return (
        spark.read.schema(TURN_SCHEMA)
        .option("pathGlobFilter", "*.parquet")
        .parquet(path)
        .select(*TURN_SCHEMA.names)
    )


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the file a row was read from; call it directly on a scan."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file"))


def run_date(path: Column, default: Column | None = None) -> Column:
    """Date in ``dt_YYYYMMDD`` or ``run-date_YYYYMMDD`` of a path, else ``default`` (today)."""
    digits = F.regexp_extract(path, r"(?:dt_|run-date_)(\d{8})", 1)
    return F.coalesce(
        F.concat_ws(
            "-",
            F.nullif(F.substring(digits, 1, 4), F.lit("")),
            F.nullif(F.substring(digits, 5, 2), F.lit("")),
            F.nullif(F.substring(digits, 7, 2), F.lit("")),
        ).try_cast("date"),
        default if default is not None else F.current_date(),
    )


def output_folder(base: str, path: Column, default: Column | None = None) -> Column:
    return F.concat(
        F.lit(base.rstrip("/") + "/dt_"), run_date(path, default).cast("string"), F.lit("/")
    )


def chat_documents(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """JSON chat documents, one per file or one per line (splittable), with ``source_file``, ``unreadable`` (the text of one that does not parse or
    has a field of another type, else null) and ``reason`` (why it gives no turns, else null)."""
    unreadable = "unreadable"
    reader = spark.read.schema(StructType([*CHAT_DOCUMENT_SCHEMA, StructField(unreadable, StringType())]))
    found = reader.option("multiLine", one_per_file).option("columnNameOfCorruptRecord", unreadable).json(path)
    reason = (
        F.when(F.col(unreadable).isNotNull(), "unreadable")
        .when(F.trim(F.coalesce("chat_id", F.lit(""))) == "", "no chat_id")
        .when(F.coalesce(F.size("turns"), F.lit(0)) < 1, "no turns")
    )
    return with_source_file(found).withColumn("reason", reason)


def explode_chat_json(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Turn rows of the readable JSON chat documents; ``rejected_documents`` has the others."""
    return explode_chats(chat_documents(spark, path, one_per_file).filter("unreadable IS NULL"))


def rejected_documents(documents: DataFrame) -> DataFrame:
    """(source_file, chat_id, reason, document) of the ``chat_documents`` that give no turn of a known chat: their text, or what was read of them."""
    document = F.coalesce("unreadable", F.to_json(F.struct(*CHAT_DOCUMENT_SCHEMA.names)))
    return documents.filter(F.col("reason").isNotNull()).select("source_file", "chat_id", "reason", document.alias("document"))


def rejected_turns(turns: DataFrame) -> DataFrame:
    """The turns that no later step can use, with the reason."""
    reason = F.when(F.trim(F.coalesce("chat_id", F.lit(""))) == "", "no chat_id").when(
        F.coalesce("question", "response", "question_raw", "response_raw").isNull(), "no text"
    )
    return turns.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def reject_report(rejected: DataFrame) -> DataFrame:
    """(reason, rejected): how many were rejected for each reason."""
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("rejected"))


def explode_chats(documents: DataFrame) -> DataFrame:
    flat = documents.select("chat_id", "chat_date", F.inline("turns"))
    return conform(flat, TURN_SCHEMA)


def pair_messages(messages: DataFrame) -> DataFrame:
    """Question/response pairs from single messages (conv_id, turn, role, text).

    Each user message opens a turn, ranked from 1; the next message answers it if
    it is the assistant's. System messages are ignored; messages at one position follow role and text.

    Blocks of at most BLOCK consecutive messages are paired on their own, so no task holds a long conversation, however its
    turn numbers lie; one row per block then carries what crosses its border: the next block's first message and the
    number of user messages before it. Only messages equal in conversation, turn and role must share a partition before that.
    """
    return _pairs_in_blocks(in_blocks(messages))


def in_blocks(messages: DataFrame) -> DataFrame:
    """Messages of known conversations with their ``block``: a number that rises in the order of all messages, BLOCK of a partition's each.

    Written once, because both readers of the blocks must see the same borders.
    """
    said = messages.filter(F.col("conv_id").isNotNull() & (F.col("role") != "system")).select("conv_id", *POSITION)
    in_order = said.repartitionByRange("conv_id", "turn", "role").sortWithinPartitions("conv_id", *POSITION)
    return materialise(in_order.withColumn("block", F.floor(F.monotonically_increasing_id() / BLOCK)), "messages")


def _next_message(keys: list[str]) -> Column:
    return F.lead(F.struct("role", "text")).over(Window.partitionBy(*keys).orderBy(*POSITION))


def _users_so_far(keys: list[str]) -> Column:
    running = Window.partitionBy(*keys).orderBy(*POSITION)
    return F.count(F.when(F.col("role") == "user", 1)).over(
        running.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _to_pairs(df: DataFrame) -> DataFrame:
    answer = F.when(F.col("next.role") == "assistant", F.col("next.text"))
    return df.filter(F.col("role") == "user").select(
        "conv_id", "turn_rank", F.col("text").alias("question"), answer.alias("response")
    )


def _pairs_in_blocks(blocked: DataFrame) -> DataFrame:
    keys = ["conv_id", "block"]
    inside = blocked.withColumn("next", _next_message(keys)).withColumn(
        "turn_rank", _users_so_far(keys)
    )
    in_order = Window.partitionBy("conv_id").orderBy("block")
    borders = (
        blocked.groupBy(*keys)
        .agg(
            F.min_by(F.struct("role", "text"), F.struct(*POSITION)).alias("opening"),
            F.count(F.when(F.col("role") == "user", 1)).alias("users"),
        )
        .select(
            F.col("conv_id").alias("b_conv"),
            F.col("block").alias("b_block"),
            F.lead("opening").over(in_order).alias("following"),
            (F.sum("users").over(in_order) - F.col("users")).alias("users_before"),
        )
        .withColumnsRenamed({"b_conv": "conv_id", "b_block": "block"})
    )
    joined = inside.join(borders, keys)
    return _to_pairs(
        joined.withColumn("next", F.coalesce("next", "following")).withColumn(
            "turn_rank", F.col("turn_rank") + F.col("users_before")
        )
    )
