"""Quotation linking: replies find the messages they quote.

Lines that begin with ``>`` are quoted; the number of ``>`` is the nesting level. Lines of one level
that follow each other without a blank line are a passage. Its lines are joined, normalised and cut into
sentences, so where a mail program wraps it does not matter; single lines are pieces too, for quotations
that cut a sentence. The pieces are hashed and meet the unquoted pieces of earlier messages of the same
conversation. For each quoted piece only the latest earlier message that has it counts, found as an
as-of match in turn buckets, so a piece that thousands of messages share gives one row per quoting
piece. The longest piece found on a quoted line gives the line's source; a message replies to the message
that most characters of its level-1 lines come from. Threads follow from pointer doubling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage
from .common import let

#: turns of a bucket of the as-of match
BUCKET = 256
QUOTED = r"^\s?((?:>\s?)+)"
#: fixed value: the line that mail programs put before a quotation
ATTRIBUTION = r"(?i)^on .{1,200} wrote:\s*$"


#: where a sentence ends, and the marks around the line number that starts each part of a line in a joined passage
SENTENCE_END = r"(?<=[.!?\u2026\u3002\uff01\uff1f]) "
OPEN, CLOSE = "\x02", "\x03"


def normalised(line: Column) -> Column:
    """Lower-case, each run of white space (and of the two marks) one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(line), rf"[\s{OPEN}{CLOSE}]+", " "))


def passages(lines: Column) -> Column:
    """Arrays of (number, level, line) structs: runs of lines of one level without a blank line, normalised."""
    lines = F.transform(lines, lambda x, i: F.struct(i.alias("number"), x["level"].alias("level"), normalised(x["line"]).alias("line")))

    def cut(lines: Column) -> Column:
        starts = F.transform(F.filter(lines, lambda x, i: (x["line"] != "") & (
            (i == 0) | (F.get(lines, i - 1)["line"] == "") | (F.get(lines, i - 1)["level"] != x["level"]))), lambda x: x["number"])
        return let(starts, lambda at: F.transform(at, lambda s, k: F.filter(
            F.slice(lines, s + 1, F.coalesce(F.get(at, k + 1), F.size(lines)) - s), lambda x: x["line"] != "")))

    return let(lines, cut)


def pieces(passage: Column) -> Column:
    """(hash, chars, lines) structs of a passage: its sentences, whichever lines they run over, and its lines."""
    def mark(x: Column) -> Column:
        number = F.concat(F.lit(OPEN), x["number"].cast("string"), F.lit(CLOSE))
        return F.array_join(F.transform(F.split(x["line"], SENTENCE_END), lambda t: F.concat(number, t)), " ")

    def piece(text: Column, lines: Column) -> Column:
        return F.struct(F.xxhash64(text).alias("hash"), F.length(text).alias("chars"), lines.alias("lines"))

    sentences = F.split(F.array_join(F.transform(passage, mark), " "), rf"(?<=[.!?\u2026\u3002\uff01\uff1f]) (?={OPEN})")
    numbers = rf"{OPEN}(\d+){CLOSE}"
    lines = F.transform(passage, lambda x: piece(x["line"], F.array(x["number"])))
    whole = F.transform(sentences, lambda t: piece(F.regexp_replace(t, numbers, ""), F.transform(
        F.regexp_extract_all(t, F.lit(numbers), F.lit(1)), lambda n: n.cast("int"))))
    return let(whole, lambda found: F.when((F.size(found) == 1) & (F.size(passage) == 1), found).otherwise(F.concat(found, lines)))


def lines_of(text: Column) -> Column:
    """Array of (level, line) structs: nesting level and the line without its quote marks, in order."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, QUOTED, 1), r"\s", "")).alias("level"),
        F.regexp_replace(x, QUOTED, "").alias("line")))


def own_text(lines: Column) -> Column:
    """The unquoted lines, without attribution lines that stand before a quotation."""
    def keep(x: Column, i: Column) -> Column:
        following = F.coalesce(F.get(lines, i + 1)["level"], F.lit(0))
        return (x["level"] == 0) & ~((following > 0) & x["line"].rlike(ATTRIBUTION))

    return F.array_join(F.transform(F.filter(lines, keep), lambda x: x["line"]), "\n")


def latest_before(asked: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """``asked`` with ``source``: the largest turn of ``known`` with the same keys below the own turn, if any.

    Within a bucket of turns a window looks back; from earlier buckets only their largest turn comes in.
    """
    both = known.select(*keys, F.col("turn").alias("at"), F.col("turn").alias("has"), *[F.lit(None).cast(t).alias(c) for c, t in asked.dtypes if c not in keys]) \
        .union(asked.select(*keys, F.col("turn").alias("at"), F.lit(None).cast("long").alias("has"), *[c for c in asked.columns if c not in keys]))
    both = both.withColumn("bucket", F.floor(F.col("at") / BUCKET))
    inside = F.max("has").over(W.partitionBy(*keys, "bucket").orderBy("at").rangeBetween(W.unboundedPreceding, -1))
    tops = known.groupBy(*keys, F.floor(F.col("turn") / BUCKET).alias("bucket")).agg(F.max("turn").alias("top"))
    tops = both.select(*keys, "bucket").distinct().join(tops, [*keys, "bucket"], "left")
    carried = tops.withColumn("carried", F.max("top").over(W.partitionBy(*keys).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)))
    return (both.withColumn("inside", inside).where(F.col("turn").isNotNull())
            .join(carried.select(*keys, "bucket", "carried"), [*keys, "bucket"], "left")
            .select(*asked.columns, F.coalesce("inside", "carried").alias("source")))


def number_in_order(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Add ``position``: 0, 1, ... within ``key`` by ``order``; range partitions get offsets, so no key is sorted in one task."""
    laid = stage(rows.repartitionByRange(key, *order).withColumn("_part", F.spark_partition_id()), name)
    sizes = laid.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("_key").orderBy("_of").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("_key", "_of", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(W.partitionBy(key, "_part").orderBy(*order))
    return (laid.withColumn("_own", own).join(offsets, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_of")))
            .withColumn("position", (F.col("_before") + F.col("_own") - 1).cast("long")).drop("_part", "_key", "_of", "_before", "_own"))


def link(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, text (unquoted lines), reply_to, thread, position, quote_levels,
    quoted_lines, linked_lines.

    ``reply_to`` is the turn whose lines make up most of the level-1 quotation, ties to the later turn;
    null if nothing is quoted or found. ``thread`` is the turn at the root of the replies and
    ``position`` numbers the turns of a conversation from 0 thread by thread, so parents precede
    replies. Rows repeated whole are one message; messages of one turn share its links and position.
    Null texts have no lines; rows with a null conversation or turn link to nothing and have no
    position. Lines that are empty once normalised are not linked. ``quoted_lines`` counts the other quoted
    lines, ``linked_lines`` those on which a piece was found. Pieces of equal 64-bit hash count as one.
    """
    m = messages.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"),
                        F.col(text).cast("string").alias("raw")).distinct()
    m = stage(m.select("conv_id", "turn", "role", F.xxhash64("role", "raw").alias("message"), lines_of(F.col("raw")).alias("lines")), "quote-lines")
    placed = m.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    passage = placed.select("conv_id", "turn", "message", F.explode(passages(F.col("lines"))).alias("passage"))
    piece = passage.select("conv_id", "turn", "message", F.col("passage")[0]["level"].alias("level"), F.explode(pieces(F.col("passage"))).alias("x"))
    piece = piece.select("conv_id", "turn", "message", "level", "x.*")
    own = piece.where("level = 0").select("conv_id", "hash", "turn").distinct()
    quoted = piece.where("level > 0").select("conv_id", "hash", "turn", "message", "level", "chars", "lines")
    found = latest_before(quoted, own, ["conv_id", "hash"])
    found = found.select("conv_id", "turn", "message", F.explode("lines").alias("line"), "level", "chars", "source", (F.size("lines") == 1).alias("alone"))
    found = stage(found.groupBy("conv_id", "turn", "message", "line").agg(
        F.max("level").alias("level"), F.max(F.when(F.col("alone"), F.col("chars"))).alias("chars"),
        F.max(F.when(F.col("source").isNotNull(), F.struct("chars", "source")))["source"].alias("source")), "quote-sources")
    weigh = found.where("level = 1 AND source IS NOT NULL").groupBy("conv_id", "turn", "source").agg(F.sum("chars").alias("chars"))
    parents = weigh.groupBy("conv_id", "turn").agg(F.max(F.struct("chars", "source")).alias("best")).select("conv_id", "turn", F.col("best.source").alias("reply_to"))
    counts = found.groupBy("conv_id", "turn").agg(F.max("level").cast("int").alias("quote_levels"), F.count(F.lit(1)).alias("quoted_lines"),
                                                  F.count("source").alias("linked_lines"))
    turns = placed.select("conv_id", "turn").distinct().join(parents, ["conv_id", "turn"], "left")
    turns = turns.withColumn("thread", F.coalesce("reply_to", "turn"))
    turns = stage(turns.withColumn("moved", F.col("thread") != F.col("turn")), "quote-threads-0")
    rounds = 0
    while not turns.where("moved").isEmpty():  # every round doubles the distance that a pointer spans; those at their root rest
        rounds += 1
        up = turns.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("thread").alias("next"))
        stepped = turns.where("moved").join(up, (F.col("conv_id") == F.col("c")) & (F.col("thread") == F.col("t"))).select(
            "conv_id", "turn", "reply_to", F.col("next").alias("thread"), (F.col("next") != F.col("thread")).alias("moved"))
        turns = stage(turns.where("NOT moved").union(stepped), f"quote-threads-{rounds}")
    turns = number_in_order(turns.drop("moved"), "conv_id", ["thread", "turn"], "quote-positions")
    return (m.select("conv_id", "turn", "role", own_text(F.col("lines")).alias("text"))
            .join(turns, ["conv_id", "turn"], "left").join(counts, ["conv_id", "turn"], "left")
            .select("conv_id", "turn", "role", "text", "reply_to", "thread", "position", F.coalesce("quote_levels", F.lit(0)).alias("quote_levels"),
                    F.coalesce("quoted_lines", F.lit(0).cast("long")).alias("quoted_lines"), F.coalesce("linked_lines", F.lit(0).cast("long")).alias("linked_lines")))
