"""Chat formatting by quotation linking.

1. *Parse.*  Leading ``>`` signs give the nesting level of each line.  Level 0
   is the message's own reply; runs of lines of one deeper level are its quoted
   passages.  A line that only introduces a quote ("... wrote:") goes with it.
2. *Hash.*  Passages and their lines are normalised (letters and digits, lower
   case) and hashed.  The index holds the same hashes of each message's own
   reply: whole, by paragraph and by line, so parts of a message are found, too.
3. *Join.*  A passage is linked to the first message of its own conversation
   that has it, if that is an earlier turn; else, if it has ``FAR_WORDS`` words
   or more, to the first one of the smallest other conversation.  Index sides are
   aggregated to one row per hash before the join (the first messages of its two
   smallest conversations), so a passage that many messages share makes no pairs.  Of several
   candidates the one that matches the whole passage wins, then one of the same
   conversation, then the one with the most lines, then the earliest.
4. *Order.*  The parent of a message is the latest message of its conversation
   that it quotes at level 1 (or at the lowest level linked).  Chains of parents
   are closed by pointer doubling; ``path`` (turn numbers from the root down)
   sorts a conversation so that each reply follows the message it answers.

Defined cases: repeated rows (equal conversation, turn, role and text) are one
message; null and empty texts are messages with an empty reply; rows with a null
conversation or turn are all kept, repeated ones too, link to nothing and are no
one's parent; quotes whose source is not there stay unlinked; of two messages of
one turn the link goes to the one with the smaller hash of role and text.
"""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import map_texts, stored

_QUOTE = re.compile(r"^((?:[ \t]{0,3}>)+)[ \t]?")
_INTRO = re.compile(r"^[^\n]{0,200}\b(wrote|schrieb|écrit|escribió)\b[^\n]{0,80}:\s*$", re.I)
_NOT_WORD = re.compile(r"[\W_]+")
ID = ["conv_id", "turn", "text_hash"]
#: Words that a quoted passage or line needs to be linked to another conversation.
FAR_WORDS = 4


def parse_lines(text: str | None) -> list[tuple[int, str]]:
    """``(level, line without quote signs)`` of every line."""
    out = []
    for line in (text or "").split("\n"):
        m = _QUOTE.match(line)
        out.append((m[1].count(">"), line[m.end():]) if m else (0, line))
    return out


def parse(text: str | None) -> tuple[str, list[tuple[int, list[str]]]]:
    """The reply and the quoted passages ``(level, lines)`` of a message."""
    lines = parse_lines(text)
    reply: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    last = 0
    for k, (level, line) in enumerate(lines):
        follows = next((lv for lv, x in lines[k + 1:k + 3] if x.strip()), 0)
        if follows > level and _INTRO.match(line):
            last = -1  # an introduction ends the passage before it
            continue
        if level == 0:
            reply.append(line)
        elif passages and last == level:
            passages[-1][1].append(line)
        else:
            passages.append((level, [line]))
        last = level
    return "\n".join(reply).strip("\n"), passages


def normal(text: str) -> str:
    return _NOT_WORD.sub(" ", text.lower()).strip()


def key(text: str) -> int | None:
    """Hash of a normalised passage; None if nothing is left of it."""
    import xxhash

    n = normal(text)
    return xxhash.xxh3_64_intdigest(n.encode("utf-8", "surrogatepass")) - (1 << 63) if n else None


def own_keys(reply: str) -> list[int]:
    parts = [reply, *reply.split("\n\n"), *reply.split("\n")]
    return sorted({k for k in map(key, parts) if k is not None})


def _parsed(messages: DataFrame) -> DataFrame:
    """``row``, ``reply``, ``own`` (keys) and ``quotes`` of each message."""
    unit = pa.struct([("q", pa.int64()), ("level", pa.int64()), ("whole", pa.bool_()),
                      ("wide", pa.bool_()), ("key", pa.int64())])
    quotes = T.ArrayType(T.StructType([T.StructField("q", T.LongType()),
                                       T.StructField("level", T.LongType()),
                                       T.StructField("whole", T.BooleanType()),
                                       T.StructField("wide", T.BooleanType()),
                                       T.StructField("key", T.LongType())]))

    def make():
        def run(texts: list) -> tuple:
            replies, own, units = [], [], []
            for t in texts:
                reply, passages = parse(t)
                replies.append(reply)
                own.append(own_keys(reply))
                found = []
                for q, (level, lines) in enumerate(passages):
                    parts = [("\n".join(lines), True), *((x, False) for x in lines)]
                    found += [{"q": q, "level": level, "whole": whole,
                               "wide": len(normal(x).split()) >= FAR_WORDS, "key": key(x)}
                              for x, whole in parts]
                units.append(found)
            return (pa.array(replies, pa.string()), pa.array(own, pa.list_(pa.int64())),
                    pa.array(units, pa.list_(unit)))

        return run

    return map_texts(messages, make, [T.StructField("reply", T.StringType()),
                                      T.StructField("own", T.ArrayType(T.LongType())),
                                      T.StructField("quotes", quotes)])


def _links(parsed: DataFrame) -> DataFrame:
    """One row per linked passage: ``conv_id, turn, text_hash, q, level, src``
    (struct of the source's id) and ``same`` (source in the conversation)."""
    index = parsed.select("conv_id", "turn", "text_hash", F.explode("own").alias("key"))
    inside = index.groupBy("conv_id", "key").agg(
        F.min(F.struct("turn", "text_hash")).alias("near"))
    # two rows a key at most leave a task
    place = F.row_number().over(Window.partitionBy("key").orderBy("conv_id"))
    anywhere = (inside.withColumn("place", place).where("place <= 2").groupBy("key").agg(*[
        F.min(F.when(F.col("place") == k, F.struct("conv_id", "near.turn", "near.text_hash")))
        .alias(name) for k, name in ((1, "far"), (2, "far2"))]))
    units = parsed.select(*ID, F.inline("quotes")).where(F.col("key").isNotNull())
    other = F.when(F.col("far.conv_id") != F.col("conv_id"), F.col("far")).otherwise(F.col("far2"))
    found = (units.join(inside, ["conv_id", "key"], "left").join(anywhere, "key", "left")
             .withColumn("same", F.coalesce(F.col("near.turn") < F.col("turn"), F.lit(False)))
             .withColumn("src", F.when(F.col("same"), F.struct(
                 F.col("conv_id"), F.col("near.turn").alias("turn"),
                 F.col("near.text_hash").alias("text_hash")))
                 .when(F.col("wide"), other))
             .where(F.col("src").isNotNull()))
    votes = found.groupBy(*ID, "q", "level", "src", "same").agg(
        F.max("whole").alias("whole"), F.count("*").alias("n"))
    best = F.struct("whole", "same", "n", (-F.col("src.turn")).alias("early"), "src")
    return votes.groupBy(*ID, "q", "level").agg(F.max(best).alias("b")) \
        .select(*ID, "q", "level", "b.src", "b.same")


def _paths(spark: SparkSession, parents: DataFrame) -> DataFrame:
    """``id``, ``path``, ``depth`` from ``(id, parent)``: each round joins every
    chain to that of its top, so rounds grow with the logarithm of the depth.
    Parents are earlier turns, so there is no cycle."""
    state = stored(spark, parents.select(
        "id", F.col("parent").alias("top"), F.array(F.col("id.turn")).alias("path")), "paths")
    while not state.where(F.col("top").isNotNull()).isEmpty():
        up = state.select(F.col("id").alias("up_id"), F.col("top").alias("up_top"),
                          F.col("path").alias("up_path"))
        state = stored(spark, state.join(up, F.col("top") == F.col("up_id"), "left").select(
            "id", F.col("up_top").alias("top"),
            F.concat(F.coalesce("up_path", F.array().cast("array<bigint>")), "path")
            .alias("path")), "paths")
    return state.select("id", "path", (F.size("path") - 1).cast("long").alias("depth"))


def conversations(messages: DataFrame) -> DataFrame:
    """One row per message, in reply order within each conversation: ``conv_id,
    turn, role, text`` (the reply without quotes), ``n_quotes``, ``n_linked``,
    ``parent_turn``, ``source_conv`` and ``source_turn`` (a quoted message of
    another conversation), ``depth``, ``path``."""
    spark = messages.sparkSession
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"),
                           F.col("turn").cast("long").alias("turn"), "role",
                           F.col("text").cast("string").alias("text"))
    named = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    # a hash of null skips the value: nulls are told from empty texts and roles by flags
    hashed = rows.withColumn("text_hash", F.xxhash64(
        "text", F.lit("|"), "role", F.isnull("text"), F.isnull("role")))
    unique = hashed.where(named).dropDuplicates(ID).unionByName(hashed.where(~named))
    kept = stored(spark, _parsed(unique).select(
        "row.conv_id", "row.turn", "row.text_hash", "row.role", "reply", "own", "quotes"),
        "messages")
    parsed, loose = kept.where(named), kept.where(~named)
    links = _links(parsed)
    here = F.when(F.col("same"), F.struct((-F.col("level")).alias("l"),
                                          F.col("src.turn").alias("t"),
                                          F.col("src").alias("src")))
    far = F.when(~F.col("same"), F.struct("level", "q", "src"))
    per_message = stored(spark, links.groupBy(*ID).agg(
        F.count("*").alias("n_linked"), F.max(here).getField("src").alias("parent"),
        F.min(far).getField("src").alias("source")), "links")
    same_id = reduce(lambda a, b: a & b, [F.col(f"m.{c}") == F.col(f"l.{c}") for c in ID])
    n_quotes = F.when(F.size("quotes") > 0, F.array_max("quotes.q") + 1).otherwise(0).cast("long")
    joined = parsed.alias("m").join(per_message.alias("l"), same_id, "left").select(
        F.struct(*[F.col(f"m.{c}") for c in ID]).alias("id"), "role", "reply",
        n_quotes.alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "parent", "source")
    paths = _paths(spark, joined.select("id", "parent")).select(
        F.col("id").alias("p_id"), "path", "depth")
    linked = joined.join(paths, F.col("id") == F.col("p_id"), "left").select(
        "id.conv_id", "id.turn", "role", F.col("reply").alias("text"), "n_quotes", "n_linked",
        F.col("parent.turn").alias("parent_turn"), F.col("source.conv_id").alias("source_conv"),
        F.col("source.turn").alias("source_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.coalesce("path", F.array("id.turn")).alias("path"))
    null = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    alone = loose.select(
        "conv_id", "turn", "role", F.col("reply").alias("text"), n_quotes.alias("n_quotes"),
        zero.alias("n_linked"), null.alias("parent_turn"), null.alias("source_conv"),
        null.alias("source_turn"), zero.alias("depth"), F.array("turn").alias("path"))
    return linked.unionByName(alone).orderBy("conv_id", "path", "text")
