"""Ad-click wire format: one CSV line ``timestamp,area,city,userid,adid`` per record
(S4, S5, K11), plain as the reference's or quoted. Decoding is JVM-side (``split`` + ``try_cast``): a malformed line
never fails the batch (defect D17) -- it goes to the rejects output instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.schemas import AD_LINE_FIELDS

#: Plausible click times: not before 2000, and not more than a day after the
#: batch arrives (a phone's clock may be ahead; one click dated years ahead must not steer the windows).
EARLIEST_MS = 946_684_800_000
MAX_AHEAD = "1 day"


#: The quoted format: every field in double quotes, a double quote inside as two; a backslash, line feed or
#: carriage return inside is written as a backslash and a backslash, n or r, so that a record is one line in text files too.
_CSV = {"sep": ",", "quote": '"', "escape": '"', "quoteAll": "true", "nullValue": "", "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: Room for lines with more fields than the five, which are ignored.
_CSV_FIELDS = ", ".join(f"_{i} STRING" for i in range(len(AD_LINE_FIELDS) + 1))


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _unescaped(field: str) -> str:
    """SQL text: pieces between written backslashes, in which a backslash with n or r can only be a line break."""
    pieces = f"split({field}, '\\\\\\\\\\\\\\\\', -1)"
    return f"array_join(transform({pieces}, p -> replace(replace(p, '\\\\n', '\n'), '\\\\r', '\r')), '\\\\')"


def encode_ad_log(clicks: DataFrame, keep: tuple[str, ...] = (), quoted: bool = False) -> DataFrame:
    """Clicks -> ``value`` text lines (the producer half of the message bus).

    A null keeps its place as an empty field. The plain format has no quoting: a field
    that holds the delimiter or a line break can't be written, so ``value`` is null for such a row
    (a reader would take its pieces for other fields); ``write_ad_log`` keeps those rows apart. The ``quoted``
    format writes every text."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in AD_LINE_FIELDS]
    if quoted:
        return clicks.select(*keep, F.to_csv(F.struct(*(_escaped(f).alias(f"_{i}") for i, f in enumerate(fields))), _CSV).alias("value"))
    sound = ~F.concat(*fields).rlike("[,\\r\\n]")
    return clicks.select(*keep, F.when(sound, F.concat_ws(",", *fields)).alias("value"))


def judge_ad_log(lines: DataFrame, keep: tuple[str, ...] = (), latest: Column | None = None, quoted: bool = False) -> DataFrame:
    """``value`` lines with their fields and ``reason``, the first reason to reject a line (null: none).

    A line is accepted when its first five fields are there and not blank, and
    the first is a plausible time in epoch ms: from ``EARLIEST_MS`` to
    ``latest`` (a timestamp; default: ``MAX_AHEAD`` after now, when the batch is
    read: in a stream, the time that its checkpoint holds for the batch, also when it is replayed). Fields
    are trimmed; extra ones are ignored, as in the reference. In ``quoted`` lines (unquoted fields are read too) texts
    stay as they are, with their spaces.
    """
    if quoted:
        return _judge(_quoted_fields(lines, keep), latest).select(*keep, "value", *AD_LINE_FIELDS, "reason")
    # The fields once as a column: an expression used for every field would be evaluated for each.
    parts = F.expr("transform(split(coalesce(value, ''), ','), x -> nullif(trim(x), ''))")
    split = lines.select(*keep, "value", parts.alias("_parts"))
    text = lambda i: F.get("_parts", i)
    fields = [text(0).try_cast("long").alias("ts")] + [
        text(i).alias(name) for i, name in enumerate(AD_LINE_FIELDS[1:], start=1)]
    parsed = split.select(*keep, "value", F.size("_parts").alias("_fields"), *fields)
    return _judge(parsed, latest).select(*keep, "value", *AD_LINE_FIELDS, "reason")


def _quoted_fields(lines: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    read = lines.select(*keep, "value", F.from_csv("value", _CSV_FIELDS, {**_CSV, "mode": "PERMISSIVE"}).alias("_csv"))
    # Fields are filled from the left, so the first that is missing tells how many there are (an empty one is empty, not missing).
    found = F.expr("size(split(regexp_replace(coalesce(value, ''), '\"([^\"]|\"\")*\"', ''), ',', -1))")
    text = lambda i: F.expr(f"IF(trim(_csv._{i}) = '', NULL, {_unescaped(f'_csv._{i}')})")
    fields = [F.trim(text(0)).try_cast("long").alias("ts")] + [text(i).alias(name) for i, name in enumerate(AD_LINE_FIELDS[1:], start=1)]
    return read.select(*keep, "value", found.alias("_fields"), *fields)


def _judge(parsed: DataFrame, latest: Column | None) -> DataFrame:
    latest = F.current_timestamp() + F.expr(f"INTERVAL {MAX_AHEAD}") if latest is None else latest
    blank = F.lit(False)
    for name in AD_LINE_FIELDS[1:]:
        blank = blank | F.col(name).isNull()
    return parsed.withColumn("reason", F.when(F.col("ts").isNull(), F.lit("bad timestamp"))
                             .when(F.col("_fields") < len(AD_LINE_FIELDS), F.lit("too few fields"))
                             .when(F.col("ts") < EARLIEST_MS, F.lit("timestamp too early"))
                             .when(F.col("ts") > F.unix_millis(latest), F.lit("timestamp too late"))
                             .when(blank, F.lit("blank field")))


def _parted(judged: DataFrame, keep: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    return judged.where("reason IS NULL").select(*keep, *AD_LINE_FIELDS), judged.where("reason IS NOT NULL").select(*keep, "value", "reason")


def decode_ad_log(lines: DataFrame, keep: tuple[str, ...] = (), latest: Column | None = None, quoted: bool = False) -> tuple[DataFrame, DataFrame]:
    """``value`` lines -> (clicks, rejects), as ``judge_ad_log`` says. Rejects keep the raw line and the reason."""
    return _parted(judge_ad_log(lines, keep, latest, quoted), keep)


def event_time(ts_millis: str | Column = "ts") -> Column:
    """Epoch ms -> UTC wall-clock timestamp (TIMESTAMP_NTZ), independent of the session zone."""
    c = F.col(ts_millis) if isinstance(ts_millis, str) else ts_millis
    return F.timestamp_add("MILLISECOND", c, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def read_ad_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of ad-log text files (one record per line) -> ``value``."""
    return spark.read.text(path)


def read_ad_stream(spark: SparkSession, path: str | None = None, kafka: dict | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source with the ``value STRING`` contract.

    ``kafka``: options for the Kafka source (``kafka.bootstrap.servers``,
    ``subscribe``, ...; ``startingOffsets`` defaults to ``latest`` as in the
    reference). Offsets then live in the query checkpoint, not in a consumer
    group. Without Kafka options a directory of text files is read instead.
    """
    if kafka:
        opts = {"startingOffsets": "latest", **kafka}
        return (spark.readStream.format("kafka").options(**opts).load()
                .select(F.col("value").cast("string").alias("value")))
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)
