"""Operator 12: mixing sources to target weights by a low-discrepancy schedule.

Every source gets a target number of words: its weight's share of all words, at
most ``most_repeats`` times its own words, what lies above reshared by weight. A
source's documents are shuffled, laid end to end and cut into blocks of
``block_words`` words (the last is shorter); the stream of its blocks is
repeated until the target is reached, the last block taken cut to the word.

The schedule deals slots to sources: slot ``t`` has the ``t``-th van der Corput
point, which is mapped through the sources' cumulative numbers of slots. Points
are dyadic and the cumulative weights whole slots, so slot ``t`` falls on place
``reverse(t)`` of the cumulative weights and each place is met once: a source
gets exactly its slots, evenly spread. Its slots are ranked in the order of the
schedule, by counting the points before a slot digit by digit (no window over a
source), and rank ``r`` takes block ``r mod blocks`` in epoch ``r div blocks``.

Sums along a source run in two steps, inside buckets of about ``BUCKET_DOCS``
documents and over the buckets' totals, so no task sees a whole source. All
tables but the texts' are narrow; sources are ranked by a range sort.

Defined cases: a null or empty text has 0 words and takes no part in a block; a
null source is a source of its own, the last; a null id is a document like any
other, shuffled by its text; equal rows are interchangeable and each is mixed;
a source without words has target 0; an empty table gives empty results; a very
long text is cut over as many blocks as it fills. Only the named columns are read,
so others may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.packing import word_count
from clickpulse.plans import write_and_reread

WEIGHTS, MOST_REPEATS, BLOCK_WORDS, SEED = (1, 2, 3), 3, 4096, 0
#: Documents of one bucket of the shuffle order, on average; tickets made from one row.
BUCKET_DOCS, TICKETS = 1024, 1 << 14
_WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mixture:
    """``sources``: source, ``sid`` (its rank), size, weight, target, ``want`` (target in whole words), blocks, slots.
    ``documents``: ``sid``, ``bucket`` and ``pos`` (together a row's key), id, source, size, ``start`` in the source's stream.
    ``pieces``: ``slot``, ``at`` (words before it in the slot), ``sid``, ``epoch``, ``block``, the row's key, id, ``first`` (word), ``words``."""

    sources: DataFrame
    documents: DataFrame
    pieces: DataFrame

    def taken(self) -> DataFrame:
        """``documents`` with ``target`` and ``source_size`` of its source, and ``taken``: the words the mix takes of it."""
        key = ["sid", "bucket", "pos"]
        words = self.pieces.groupBy(*key).agg(F.sum("words").alias("taken"))
        named = self.sources.select("sid", F.col("size").alias("source_size"), "target")
        return self.documents.join(named, "sid").join(words, key, "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))

    def texts(self) -> DataFrame:
        """The mix itself, of a mixture made with ``texts``: ``slot``, ``at``, id, and the piece's words, a space between."""
        key = ["sid", "bucket", "pos"]
        cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)), (F.col("first") + 1).cast("int"), F.col("words").cast("int")), " ")
        return self.pieces.join(self.documents.select(*key, "text"), key).select("slot", "at", "id", cut.alias("text"))


def _place(df: DataFrame, column: str, value: Column, name: str) -> DataFrame:
    """``df``, a written table whose ``place`` ascends (partition in the high bits), with the sum of ``value`` over the rows before."""
    df = df.withColumn("_part", F.shiftright("place", 33)).withColumn("_value", value)
    parts = df.groupBy("_part").agg(F.sum("_value").alias("_sum")).select("_part", F.expr("coalesce(sum(_sum) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("_earlier"))
    own = F.expr("coalesce(sum(_value) OVER (PARTITION BY _part ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    return df.withColumn(name, own).join(parts, "_part").withColumn(name, (F.col(name) + F.col("_earlier")).cast("long")).drop("_part", "_value", "_earlier")


def _levels(sources: DataFrame, most_repeats: int) -> tuple[int, int]:
    """(words, weights) left to the sources below their most: a source's share is words * weight / weights.

    Each round fixes the sources whose share lies above their most and reshares the rest; shares only
    grow, so a fixed source stays fixed."""
    row = sources.agg(F.sum("size"), F.sum("weight")).first()
    total = words = row[0] or 0
    weights = row[1] or 0
    fixed = 0
    while weights:
        above = _above(words, weights, most_repeats)
        count, most, rest = sources.agg(F.count_if(above), F.sum(F.when(above, most_repeats * F.col("size"))), F.sum(F.when(~above, F.col("weight")))).first()
        if count == fixed:
            break
        fixed, words, weights = count, total - (most or 0), rest or 0
    return words, weights


def _above(words: int, weights: int, most_repeats: int) -> Column:
    """words * weight / weights > most_repeats * size, in whole numbers."""
    big = lambda n: F.lit(str(n)).cast("decimal(20,0)")
    return big(words) * F.col("weight").cast("decimal(9,0)") > (F.col("size") * most_repeats).cast("decimal(20,0)") * F.lit(str(weights)).cast("decimal(12,0)")


def _sources(rows: DataFrame, weights: tuple[int, ...], most_repeats: int, block: int) -> DataFrame:
    """One row a source, in code-point order (null last), with its target, blocks and slots."""
    order = F.col("source").asc_nulls_last()
    sized = rows.groupBy("source").agg(F.sum("size").cast("long").alias("size"))
    placed = write_and_reread(sized.repartitionByRange(order).sortWithinPartitions(order).withColumn("place", F.monotonically_increasing_id()), "mix-sources")
    ranked = _place(placed, "place", F.lit(1), "sid")
    cycle = F.element_at(F.array(*(F.lit(w).cast("long") for w in weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    weighted = write_and_reread(ranked.withColumn("weight", cycle), "mix-weights")
    words, shares = _levels(weighted, most_repeats)
    most = (F.col("size") * most_repeats).cast("double")
    share = F.lit(float(words)) * F.col("weight").cast("double") / F.lit(float(max(shares, 1)))
    target = F.when(_above(words, max(shares, 1), most_repeats), most).otherwise(share)
    counted = weighted.withColumn("target", target).withColumn("want", F.floor(F.col("target") + 0.5).cast("long")).selectExpr(
        "*", f"CAST(ceil(size / {block}) AS LONG) AS blocks", "want % greatest(size, 1) AS rest", "want div greatest(size, 1) AS epochs").selectExpr(
        "*", f"epochs * blocks + CAST(ceil(rest / {block}) AS LONG) AS slots")
    return write_and_reread(_place(counted, "place", F.col("slots"), "first_slot"), "mix-targets")


#: Points before ticket j's among the places below x: for each digit p that is set in j, the points that
#: share j's digits below p and have 0 at p lie at j mod 2^p, then every 2^(p+1).
_BEFORE = ("aggregate(sequence(0, {bits} - 1), 0L, (n, p) -> n + IF(shiftright(ticket, p) % 2 = 1, least(greatest("
           "shiftright({x} - ticket % shiftleft(1L, p) + shiftleft(1L, p + 1) - 1, p + 1), 0L), shiftleft(1L, {bits} - 1 - p)), 0L))")


def schedule(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """``slot`` (time), ``sid``, ``rank`` among the source's slots, ``epoch``, ``block`` and ``room`` (words) of each slot."""
    places = sources.agg(F.sum("slots")).first()[0] or 0
    bits = max(1, (places - 1).bit_length())
    chunks = sources.where("slots > 0").select("sid", "first_slot", "slots", "blocks", "rest", F.explode(F.expr(f"sequence(0L, (slots - 1) div {TICKETS})")).alias("chunk"))
    tickets = chunks.repartition("sid", "chunk").select("*", F.explode(F.expr(f"sequence(first_slot + chunk * {TICKETS}, first_slot + least(slots, (chunk + 1) * {TICKETS}) - 1)")).alias("ticket"))
    upto = lambda x: _BEFORE.format(bits=bits, x=x)
    return tickets.selectExpr(
        "sid", "blocks", "slots", "rest", f"CAST(conv(reverse(lpad(bin(ticket), {bits}, '0')), 2, 10) AS LONG) AS slot",
        f"{upto('(first_slot + slots)')} - {upto('first_slot')} AS rank").selectExpr(
        "slot", "sid", "rank", "rank div blocks AS epoch", "rank % blocks AS block",
        f"IF(rank = slots - 1 AND rest % {block} > 0, rest % {block}, {block}L) AS room")


def _documents(rows: DataFrame, sources: DataFrame, keep: list[str]) -> DataFrame:
    """The rows in the shuffled order of their source, each with the words before it."""
    total = rows.count()
    bits = min(24, max(0, (total // BUCKET_DOCS).bit_length()))
    bucket = F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), 32 - bits)
    of_source = sources.select("sid", F.col("source").alias("_source"))
    named = rows.join(of_source, rows["source"].eqNullSafe(of_source["_source"])).drop("_source").withColumn("bucket", bucket)
    earlier = named.groupBy("sid", "bucket").agg(F.sum("size").alias("_sum")).select("sid", "bucket", F.expr("coalesce(sum(_sum) OVER (PARTITION BY sid ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("_earlier"))
    inside = "OVER (PARTITION BY sid, bucket ORDER BY key, id, size"
    ranked = named.withColumn("pos", F.expr(f"row_number() {inside})")).withColumn("_own", F.expr(f"coalesce(sum(size) {inside} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"))
    placed = ranked.join(earlier, ["sid", "bucket"]).select("sid", "bucket", "pos", "id", "source", "size", (F.col("_own") + F.col("_earlier")).cast("long").alias("start"), *keep)
    return write_and_reread(placed, "mix-documents")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS,
        most_repeats: int = MOST_REPEATS, block_words: int = BLOCK_WORDS, seed: int = SEED, texts: bool = False) -> Mixture:
    """The mix of ``docs``, as many words as they have; ``weights`` go round the sources in code-point order. With
    ``texts`` the documents' table holds the texts too. The same rows and ``seed`` give the same mix."""
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    keep = ["text"] if texts else []
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"),
                       F.md5(F.concat(name, F.lit(f":{seed}"))).alias("key"), *(F.col(text_col).alias("text") for _ in keep))
    rows = write_and_reread(rows, "mix-rows")
    sources = _sources(rows, weights, most_repeats, block_words)
    documents = _documents(rows, sources, keep)
    inner = documents.where("size > 0").select("sid", "bucket", "pos", "id", "size", "start", F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")).alias("block"))
    parts = inner.selectExpr("sid", "bucket", "pos", "id", "block", f"greatest(block * {block_words} - start, 0L) AS first", f"greatest(start - block * {block_words}, 0L) AS at",
                             f"least(start + size, (block + 1) * {block_words}) - greatest(start, block * {block_words}) AS whole")
    pieces = (schedule(sources, block_words).join(parts, ["sid", "block"]).withColumn("words", F.least("whole", F.col("room") - F.col("at")))
              .where("words > 0").select("slot", "at", "sid", "epoch", "block", "bucket", "pos", "id", "first", "words"))
    return Mixture(sources, documents, pieces)
