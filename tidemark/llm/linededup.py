"""Line dedup with a log-template tree, in DataFrame operations only.

A line is a sequence of tokens (parts between single spaces) in which tokens
with a digit are masked as variable.  The tree has a fixed
depth: token count, then the first ``depth`` masked tokens; a leaf is one such
path.  The lines of a leaf are clustered in rounds: the line that agrees best with
the commonest token of every place collects the lines that agree with it in at
least ``min_fixed`` of the places; the tokens that more than ``fixed_share`` of
these have are the template's fixed ones, and every line of the leaf that has
``min_fixed`` of its places in common with them belongs to the template, wherever
it deviates.  Lines left over go on to the next round.  A group goes on as long as
its rounds yield templates of several lines; after ``leaf_rounds`` rounds in a row
without one it is split on a path twice as long, and again after each further round
without one, until no two lines share a path.  Lines that the rounds and the splits
have left alone are then compared across all groups of their leaf: a prefix join
(``_buckets``) meets every two of them that agree in ``min_fixed`` of the places, and a
line and those that agree with it are one template, until no two lines left over agree.
A leaf of two lines, the usual one, needs none of this: its lines are one template if
they agree in ``min_fixed`` of the places (``_pairs``).
A template recurs if lines of ``min_docs`` documents have it.  It counts if it has ``min_tokens`` tokens.  Lines that
agree after masking are one template in any case, so a rare template in a crowded
leaf is found, too.  Lines with too few fixed tokens (tables of numbers) are not
masked: only equal ones are one template.  Lines of fewer than ``min_tokens`` tokens
recur by themselves only, if ``short_docs`` documents for each token that they lack
have them.

Every line of a recurring template is dropped from all documents but the one
with the smallest ``doc_id``, so nothing is lost from the table as a whole.

Lines are read once, as numbers (hashes and places); texts are read again only
for the lines in leaves that hold several, whose tokens are compared, and for the
result.  Counts are combined before the shuffle, and the places of the lines that
hold a 1 / ``HOT`` share of all are found by broadcast, so a line that a third of all
documents hold makes no large task.

Defined cases: null texts stay null, empty texts stay empty; blank lines are
always kept; rows that share a ``doc_id`` count as
one document, and those that share the text, too, are treated alike; rows with a
null ``doc_id`` are returned unchanged and not counted; a text whose lines are all dropped becomes empty.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .textmap import stored


@dataclass(frozen=True)
class Params:
    min_docs: int = 2         # documents in which a masked line recurs
    min_tokens: int = 6
    depth: int = 3            # leading tokens on a path of the tree
    leaf_lines: int = 2       # distinct lines of a leaf that is generalised
    fixed_share: float = 0.5
    min_fixed: float = 0.7
    leaf_rounds: int = 8      # rounds in a row without a template before a leaf is split
    short_docs: int = 10      # documents in which a line recurs, for each token it lacks


#: Lines with this share of all (line, document) pairs are joined by broadcast: there
#: are at most so many.
HOT = 1 << 14
#: Lines of up to so many tokens meet by two tokens of their prefixes, longer ones by one.
PAIRED = 32
#: A token with a digit is a variable form.  It is sought from the starts of tokens and
#: read once, however long it is.
MASK = "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"
#: Blank signs of a line (those of the pattern language's white space).
BLANK = " \t\n\x0b\f\r"


def _parts(line: Column) -> Column:
    """Number of parts between single spaces."""
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _masked(lines: DataFrame, p: Params) -> DataFrame:
    """``lines`` with a column ``masked``: the variable forms of ``line`` written as one
    sign, if enough of its tokens are fixed; a line without a digit is not searched."""
    line, found = F.col("line"), F.col("found")
    signs = (F.octet_length(found) - F.octet_length(F.replace(found, F.lit("<*>"), F.lit("")))) / 3
    # a column of its own, or each of its uses would search the line again
    return (lines.withColumn("found", F.when(line.rlike("[0-9]"),
                                             F.regexp_replace(line, MASK, "<*>")))
            .withColumn("masked", F.when(signs <= _parts(line) * (1 - p.min_fixed), found)
                        .otherwise(line)).drop("found"))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def _lines(docs: DataFrame, p: Params) -> DataFrame:
    """Every line that is counted, as numbers only: ``doc_id``, ``text_hash``,
    ``pos``, ``parts`` (tokens), ``key`` (of the masked line), ``leaf`` (of the token
    count and the leading tokens)."""
    text = F.col("text").cast("string")
    line = F.col("line")
    # the hash before the lines are dealt out, or it would be made for each line
    lines = (docs.where(F.col("doc_id").isNotNull() & text.isNotNull())
             .select("doc_id", _text_hash(text).alias("text_hash"),
                     F.split(text, "\n", -1).alias("lines"))
             .select("doc_id", "text_hash", F.posexplode("lines").alias("pos", "line"))
             .where(F.ltrim(line, F.lit(BLANK)) != "")
             .withColumn("parts", _parts(line)))
    return _masked(lines, p).select(
        "doc_id", "text_hash", "pos", "parts", F.xxhash64("masked").alias("key"),
        F.xxhash64("parts", F.substring_index("masked", " ", p.depth)).alias("leaf"))


def _crowded_lines(docs: DataFrame, counts: DataFrame, p: Params) -> DataFrame:
    """``leaf, key, n_lines, masked`` of distinct masked lines in leaves that hold several.
    Only these lines' texts are read, each at one of its places."""
    long = counts.where(F.col("parts") >= p.min_tokens)
    crowded = (long.groupBy("leaf").agg(F.count("*").alias("n_lines"))
               .where(F.col("n_lines") >= p.leaf_lines))
    wanted = (long.join(crowded, "leaf")
              .groupBy("first_doc", "text_hash")  # no more than a text's own lines
              .agg(F.collect_list(F.struct("pos", "key", "leaf", "n_lines")).alias("wanted"))
              .select(F.col("first_doc").alias("id"), F.col("text_hash").alias("hash"), "wanted"))
    text = F.col("text").cast("string")
    # texts are not sorted: the smaller side is looked up
    found = (docs.select("doc_id", "text").join(
        wanted.hint("shuffle_hash"),
        (F.col("doc_id") == F.col("id")) & (_text_hash(text) == F.col("hash")))
        .select(F.split(text, "\n", -1).alias("lines"), "wanted")
        .select("lines", F.explode("wanted").alias("w"))
        .select("w.leaf", "w.key", "w.n_lines", F.get("lines", F.col("w.pos")).alias("line")))
    once = found.groupBy("leaf", "key", "n_lines").agg(F.first("line").alias("line"))
    return _masked(once, p).select("leaf", "key", "n_lines", "masked")


def _tokens(masked: str | Column) -> Column:
    return F.split(masked, " ", -1)


def _common(rows: DataFrame, share: float, name: str) -> DataFrame:
    """``grp`` and, as an array under ``name``, the commonest token of each place of
    a group's lines; null where not more than ``share`` of the lines have it."""
    return (rows.select("grp", F.posexplode("tokens").alias("place", "token"))
            .groupBy("grp", "place", "token").agg(F.count("*").alias("n"))
            .groupBy("grp", "place").agg(F.max(F.struct("n", "token")).alias("top"),
                                         F.sum("n").alias("n_lines"))
            .select("grp", F.struct("place", F.when(
                F.col("top.n") > F.col("n_lines") * share, F.col("top.token"))
                .alias("token")).alias("at"))
            .groupBy("grp").agg(F.array_sort(F.collect_list("at")).getField("token").alias(name)))


def _agreement(other: str) -> Column:
    """Places at which ``tokens`` and ``other`` have the same fixed token."""
    same = F.zip_with("tokens", other, lambda a, b: (a == b) & (a != "<*>"))
    return F.size(F.filter(same, lambda x: F.coalesce(x, F.lit(False))))


def _pairs(crowded: DataFrame, p: Params) -> DataFrame:
    """``(key, template)`` of the lines of leaves that hold two.  Whichever of them the
    rounds took as seed, the other one would fit if they agree with each other, and
    else stay alone, so one comparison does for the rounds, the splits and the rest."""
    two = crowded.where("n_lines = 2").groupBy("leaf").agg(
        F.collect_list(F.struct("key", "masked")).alias("two")).where(F.size("two") == 2)
    return (two.select("leaf", F.col("two.key").alias("keys"),
                       _tokens(F.col("two")[0]["masked"]).alias("tokens"),
                       _tokens(F.col("two")[1]["masked"]).alias("other"))
            .where(_agreement("other") >= F.size("tokens") * p.min_fixed)
            .select(F.explode("keys").alias("key"),
                    F.xxhash64("leaf", F.lit("two")).alias("template")))


def _clusters(spark: SparkSession, distinct: DataFrame, p: Params) -> DataFrame:
    """``(key, template)`` of the lines that fit a template of their leaf.  The number
    of rounds is that of the templates of a leaf, and grows with the logarithm of the
    tokens of a line."""
    enough = F.size("tokens") * p.min_fixed
    left = distinct.select("leaf", "key", "tokens", F.col("leaf").alias("grp"),
                           F.lit(p.depth).alias("depth"), F.lit(0).alias("dry"))
    done, turn = [spark.createDataFrame([], "key long, template long")], 0
    while not left.isEmpty():
        best = F.max(F.struct(_agreement("common").alias("n"), "key", "tokens"))
        seed = (left.join(_common(left, 0.0, "common"), "grp")
                .groupBy("grp").agg(best.getField("tokens").alias("seed")))
        near = left.join(seed, "grp").where(_agreement("seed") >= enough)
        fixed = _common(near, p.fixed_share, "fixed")
        # one row per group on the right; a group whose seed fits nothing has none
        tried = stored(spark, left.join(fixed, "grp", "left").withColumn(
            "fits", F.coalesce(_agreement("fixed") >= enough, F.lit(False))).drop("fixed"),
            "clusters")
        done.append(tried.where("fits").select(
            "key", F.xxhash64("grp", F.lit(turn)).alias("template")))
        turn += 1
        yields = tried.groupBy("grp").agg(F.count(F.when(F.col("fits"), 1)).alias("found"))
        # a round that removes no line would be the same again
        dry = F.when(F.col("found") > 1, 0).when(F.col("found") == 1, F.col("dry") + 1) \
            .otherwise(p.leaf_rounds)
        split = F.col("dry") >= F.when(F.col("depth") == p.depth, p.leaf_rounds).otherwise(1)
        deeper = F.col("depth") * 2
        rest = (tried.where("NOT fits").join(yields, "grp").withColumn("dry", dry)
                .withColumn("split", split)
                .withColumn("grp", F.when(F.col("split"), F.xxhash64(
                    "leaf", deeper, F.slice("tokens", F.lit(1), deeper))).otherwise(F.col("grp")))
                .withColumn("depth", F.when(F.col("split"), deeper).otherwise(F.col("depth")))
                .withColumn("dry", F.when(F.col("split"), 0).otherwise(F.col("dry"))))
        several = rest.groupBy("grp").agg(F.count("*").alias("n")).where("n > 1").select("grp")
        left = stored(spark, rest.join(several, "grp").select(*left.columns), "clusters")
    return reduce(DataFrame.unionByName, done)


def _buckets(rest: DataFrame, p: Params) -> DataFrame:
    """``(bucket, key)``: lines of one leaf that agree in ``min_fixed`` of the places
    share a bucket.  They have the leading tokens in common, so they share ``need`` of
    the other fixed tokens (with their places), and ``shared`` of the first
    ``n - need + shared`` of these by rarity in the leaf, ``n`` being the line's own.
    Tokens that only one line has come first and meet nothing."""
    def fixed(tokens: Column) -> Column:
        return F.size(F.filter(tokens, lambda t: t != "<*>"))

    tail = F.slice("tokens", F.lit(p.depth + 1), F.size("tokens"))
    # counted here once for each line, not again for each of its tokens
    lines = rest.select(
        "leaf", "key", "tokens", fixed(tail).alias("n"),
        (F.ceil(F.size("tokens") * p.min_fixed) - fixed(F.slice("tokens", F.lit(1), F.lit(p.depth))))
        .cast("int").alias("need"))
    # the leading tokens are enough: all lines of the leaf agree
    alike = lines.where("need < 1").select(F.col("leaf").alias("bucket"), "key")
    shared = F.when((F.size("tokens") <= PAIRED) & (F.col("need") > 1), 2).otherwise(1)
    tokens = (lines.where("need > 0").withColumn("shared", shared)
              .select("leaf", "key", "need", "shared", "n",
                      F.posexplode("tokens").alias("place", "token"))
              .where((F.col("place") >= p.depth) & (F.col("token") != "<*>"))
              .select("key", "need", "shared", "n",
                      F.xxhash64("leaf", "place", "token").alias("token")))
    often = tokens.groupBy("token").agg(F.count("*").alias("often")).where("often > 1")
    # no more than the line's own tokens
    prefix = (tokens.join(often, "token").groupBy("key", "need", "shared", "n")
              .agg(F.array_sort(F.collect_list(F.struct("often", "token"))).alias("common"))
              .withColumn("room", F.col("shared") - F.col("need") + F.size("common"))
              .where(F.col("room") >= F.col("shared"))
              .select("key", "shared", F.slice("common", F.lit(1), F.col("room"))
                      .getField("token").alias("prefix")))
    first = prefix.select("key", "shared", "prefix",
                          F.posexplode("prefix").alias("at", "token"))
    one = first.where("shared = 1").select(F.col("token").alias("bucket"), "key")
    two = (first.where("shared = 2")
           .select("key", "token", F.explode(F.slice(
               "prefix", F.col("at") + 2, F.size("prefix"))).alias("other"))
           .select(F.xxhash64("token", "other").alias("bucket"), "key"))
    every = alike.unionByName(one).unionByName(two)
    several = every.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return every.join(several.select("bucket"), "bucket")


def _agreeing(pairs: DataFrame, rest: DataFrame, p: Params) -> DataFrame:
    """The pairs ``(key, other)`` of lines that agree in ``min_fixed`` of the places."""
    other = rest.select(F.col("key").alias("other"), F.col("tokens").alias("seed"))
    return (pairs.distinct().join(rest.select("key", "tokens"), "key").join(other, "other")
            .where(_agreement("seed") >= F.size("tokens") * p.min_fixed).select("key", "other"))


def _stars(links: DataFrame) -> DataFrame:
    """``(key, center)`` of lines linked to a center, centers included.  ``links`` go
    from a ``key`` to an ``other`` that precedes it in one order of all lines; a center is
    linked to nothing before it."""
    centers = links.select(F.col("other").alias("center")).distinct().join(
        links.select(F.col("key").alias("center")).distinct(), "center", "left_anti")
    members = (links.join(centers, F.col("other") == F.col("center"))
               .groupBy("key").agg(F.min("center").alias("center")))
    # a center whose lines all went to others is left over again
    own = members.select("center").distinct().select(F.col("center").alias("key"), "center")
    return members.unionByName(own)


def _rest_clusters(spark: SparkSession, distinct: DataFrame, keyed: DataFrame,
                   p: Params) -> DataFrame:
    """``(key, template)`` of lines that are alone in ``keyed``, or not in it, and agree
    with another such line of their leaf.  Each line of a bucket is compared with one
    line, the bucket's first in the order of the round, so many lines of one template
    make no pairs among each other; once that links nothing, all pairs of what is left
    in a bucket are compared."""
    several = keyed.groupBy("template").agg(F.count("*").alias("n")).where("n > 1")
    rest = stored(spark, distinct.select("leaf", "key", "tokens").join(
        keyed.join(several, "template").select("key"), "key", "left_anti"), "rest")
    buckets = stored(spark, _buckets(rest, p), "buckets")
    done, turn = [spark.createDataFrame([], "key long, center long")], 0
    while not buckets.isEmpty():
        ranked = F.struct(F.xxhash64("key", F.lit(turn)).alias("rank"), "key")
        first = buckets.groupBy("bucket").agg(F.min(ranked).getField("key").alias("other"))
        links = stored(spark, _agreeing(buckets.join(first, "bucket").where(
            F.col("key") != F.col("other")).select("key", "other"), rest, p), "links")
        if links.isEmpty():
            break
        done.append(stored(spark, _stars(links), "stars"))
        buckets = stored(spark, buckets.join(done[-1].select("key"), "key", "left_anti"),
                         "buckets")
        turn += 1
    else:
        return _star_templates(done)
    links = stored(spark, _agreeing(buckets.join(
        buckets.select("bucket", F.col("key").alias("other")), "bucket").where("other < key")
        .select("key", "other"), rest, p), "links")
    while not links.isEmpty():
        done.append(stored(spark, _stars(links), "stars"))
        gone = done[-1].select(F.col("key").alias("gone"))
        links = stored(spark, links.join(gone, F.col("key") == F.col("gone"), "left_anti").join(
            gone, F.col("other") == F.col("gone"), "left_anti"), "links")
    return _star_templates(done)


def _star_templates(done: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, done).select(
        "key", F.xxhash64("center", F.lit("rest")).alias("template"))


def _places(lines: DataFrame, counts: DataFrame, drop: DataFrame) -> DataFrame:
    """Lines of the keys of ``drop`` in all documents but the first.  The hottest keys
    are joined by broadcast (they hold a 1 / ``HOT`` share of all pairs of line and
    document each, so they are at most ``HOT``); no other key has many rows."""
    total = F.col("total")
    pairs = counts.agg(F.sum("n_docs").alias("total"))  # one row
    hot = (counts.join(F.broadcast(pairs)).where(F.col("n_docs") * HOT >= total)
           .select(F.col("key").alias("hot")))
    rest = lines.join(F.broadcast(hot), F.col("key") == F.col("hot"), "left_anti")
    hot_drop = drop.join(F.broadcast(hot), F.col("key") == F.col("hot"), "left_semi")
    found = lines.join(F.broadcast(hot_drop), "key").unionByName(
        rest.join(drop.hint("shuffle_hash"), "key"))
    return found.where(F.col("doc_id") != F.col("first_doc")).select("doc_id", "text_hash", "pos")


def recurring(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``(doc_id, text_hash, pos)`` of the lines to drop: lines of recurring
    templates in all documents but the first that has the template."""
    spark = docs.sparkSession
    lines = stored(spark, _lines(docs, p), "lines")
    # one place of each line, in its first document; numbers only, so nothing is sorted
    in_doc = lines.groupBy("key", "leaf", "parts", "doc_id").agg(
        F.min("text_hash").alias("text_hash"), F.min_by("pos", "text_hash").alias("pos"))
    counts = stored(spark, in_doc.groupBy("key", "leaf", "parts").agg(
        F.min("doc_id").alias("first_doc"), F.count("*").alias("n_docs"),
        F.min_by("text_hash", "doc_id").alias("text_hash"),
        F.min_by("pos", "doc_id").alias("pos")), "counts")
    crowded = stored(spark, _crowded_lines(docs, counts, p), "crowded")
    distinct = crowded.where("n_lines > 2").select("leaf", "key", _tokens("masked").alias("tokens"))
    keyed = stored(spark, _clusters(spark, distinct, p).unionByName(_pairs(crowded, p)), "templates")
    keyed = keyed.unionByName(_rest_clusters(spark, distinct, keyed, p))
    templates = (keyed.join(counts, "key").groupBy("template")
                 .agg(F.min("first_doc").alias("first_doc"), F.max("first_doc").alias("last"),
                      F.count("*").alias("n_lines"), F.max("n_docs").alias("n_docs"))
                 # lines of one document only don't recur across documents
                 .where((F.col("n_lines") > 1)
                        & ((F.col("first_doc") != F.col("last"))
                           | (F.col("n_docs") >= p.min_docs)))
                 .select("template", "first_doc"))
    general = keyed.join(templates, "template").groupBy("key").agg(
        F.min("first_doc").alias("first_doc"))
    need = F.when(F.col("parts") >= p.min_tokens, p.min_docs).otherwise(
        (p.min_tokens - F.col("parts")) * p.short_docs)
    exact = counts.where(F.col("n_docs") >= need).select("key", "first_doc")
    drop = stored(spark, exact.unionByName(general).groupBy("key").agg(
        F.min("first_doc").alias("first_doc")), "drop")
    return _places(lines, counts, drop)


def drop_lines(docs: DataFrame, p: Params = Params(), removed: str | None = None) -> DataFrame:
    """``docs`` with ``text`` freed of recurring lines; with ``removed``, also
    the number of lines dropped under that name."""
    # the places of one text: no more than its own lines
    doomed = (recurring(docs, p).groupBy("doc_id", "text_hash")
              .agg(F.collect_list("pos").alias("places")))
    text = F.col("row.text").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")) \
        .withColumn("hash", _text_hash(text))
    changed = F.col("places").isNotNull()
    # texts are not sorted: the places are looked up.  The lines are a column of their own,
    # or the text would be split again for each line that is kept
    joined = rows.join(doomed.hint("shuffle_hash"), (F.col("row.doc_id") == F.col("doc_id"))
                       & (F.col("hash") == F.col("text_hash")), "left") \
        .withColumn("lines", F.when(changed, F.split(text, "\n", -1)))
    # set difference of places, so long texts take linear time
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(F.array_except(every, "places"), lambda i: F.get("lines", i))
    out = joined.withColumn("_tm_text", F.when(changed, F.array_join(kept, "\n"))
                            .otherwise(F.col("row.text")))
    dropped = F.coalesce(F.size(F.array_distinct("places")), F.lit(0)).cast("long")
    dropped = F.when(changed, dropped).otherwise(F.lit(0))
    cols = [F.col("_tm_text").alias(c) if c == "text" else F.col(f"row.`{c}`")
            for c in docs.columns]
    return out.select(*cols, *([dropped.alias(removed)] if removed else []))

