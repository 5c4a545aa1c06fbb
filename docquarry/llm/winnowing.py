"""Document fingerprints by winnowing, in DataFrame functions only (9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.common import NO_ID, keyed, partitions, stored

#: Words of a gram, and grams of a window: texts that share GRAM + WINDOW - 1 words in a
#: row share a mark.
GRAM, WINDOW = 3, 8

_PLACE = (1 << 31) - 1
_SPACES = " \t\n\x0b\x0c\r"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where it is used inside a lambda."""
    return F.transform(F.array(value), use)[0]


def marks(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Marks of a text: the smallest gram hash of every window, the rightmost of equal ones.

    A gram is ``gram`` words in a row (all words, if fewer), a window ``window`` grams in a
    row (all grams, if fewer).  A mark holds 32 bits of hash above the place of its gram,
    counted down from 2^31 - 1 so that the minimum is the rightmost; see ``mark_hash`` and
    ``mark_place``.  A text without words has no marks.
    """
    trimmed = F.btrim(text, F.lit(_SPACES))
    words = F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))

    def mark(hashed: Column, place: Column) -> Column:
        low = F.shiftleft(hashed.bitwiseAND(F.lit(0xFFFFFFFF)), 31)
        return low.bitwiseOR(F.lit(_PLACE).cast("long") - place)

    def grams(h: Column) -> Column:
        own = lambda i: mark(F.xxhash64(*[F.get(h, i + j) for j in range(gram)]), i)
        return (F.when(F.size(h) >= gram, F.transform(F.sequence(F.lit(0), F.size(h) - gram), own))
                .when(F.size(h) > 0, F.array(mark(F.xxhash64(F.concat_ws(" ", h.cast("array<string>"))), F.lit(0))))
                .otherwise(F.array().cast("array<bigint>")))

    def least(v: Column) -> Column:
        of = lambda i: F.array_min(F.slice(v, i, window))
        return F.when(F.size(v) > window, F.array_distinct(
            F.transform(F.sequence(F.lit(1), F.size(v) - window + 1), of))).when(
            F.size(v) > 0, F.array(F.array_min(v))).otherwise(v)

    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: _let(grams(h), least))


def mark_hash(mark: Column) -> Column:
    return F.shiftright(mark, 31).cast("long")


def mark_place(mark: Column) -> Column:
    """Number of the gram's first word, from 0."""
    return F.lit(_PLACE).cast("long") - mark.bitwiseAND(F.lit(_PLACE).cast("long"))


def hashes(found: Column) -> Column:
    """The distinct hashes of marks."""
    return F.array_distinct(F.transform(found, mark_hash))


def likeness(one: Column, two: Column) -> Column:
    """Share of common hashes in all hashes of two sets of them; of two empty sets, 1."""
    common = F.size(F.array_intersect(one, two))
    return _let(common, lambda n: F.when(F.size(one) + F.size(two) == 0, F.lit(1.0)).otherwise(
        n / (F.size(one) + F.size(two) - n)))


def printed(found: Column) -> Column:
    """A fingerprint as text: a digest of all marks with their places."""
    return F.md5(F.array_join(found.cast("array<string>"), " ").cast("binary"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``id_col``, ``fingerprint`` and ``marks`` (``hash`` and ``place`` of each) of each row."""
    return docs.select(F.col(id_col), marks(F.col(text_col), gram, window).alias("found")).select(
        id_col, printed(F.col("found")).alias("fingerprint"),
        F.transform("found", lambda m: F.struct(mark_hash(m).alias("hash"), mark_place(m).alias("place")))
        .alias("marks"))


def followers(keys: DataFrame) -> DataFrame:
    """``k``, ``th`` and the key of the next row, ``nk`` and ``nth``, by descending ``k``; the
    first comes after the last.

    Rows are cut into ranges; inside a range the next row is a window away, and one row a
    range is joined to the first of the range behind.
    """
    order = [F.desc("k"), F.asc("th")]
    ranged = stored(keys.repartitionByRange(partitions(keys.sparkSession), *order)
                    .withColumn("range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("range").orderBy(*order)
    near = (ranged.withColumn("nk", F.lead("k").over(inside)).withColumn("nth", F.lead("th").over(inside))
            .withColumn("place", F.row_number().over(inside)))
    # One row a range from here on.
    firsts = near.where("place = 1").select("range", F.struct("k", "th").alias("first"))
    behind, all_ = Window.orderBy("range"), Window.partitionBy(F.lit(1))
    firsts = firsts.select("range", F.coalesce(
        F.lead("first").over(behind), F.min_by("first", "range").over(all_)).alias("next"))
    return near.join(firsts, "range").select(
        "k", "th", F.coalesce("nk", F.col("next.k")).alias("nk"),
        F.when(F.col("nk").isNull(), F.col("next.th")).otherwise(F.col("nth")).alias("nth"))


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every whole text and of its edited text: the last third of its code
    points replaced by as many from the start of the next document, by descending id.

    Returns, for each row, ``id_col``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next`` (share of common hashes with
    the edited text and the next document).

    Null text is empty.  Rows without id come last in order.  Rows that share an id follow
    each other by text; repeated rows count once in the order and are all returned.  A
    text's next may be itself, if there is no other.  Other columns play no part.
    """
    frame = keyed(docs, id_col, text_col)
    # Ids from high to low, missing ones after them: below every id.
    frame = frame.select(F.coalesce("id", F.lit(-NO_ID - 1)).alias("k"), "th", F.col("id").isNull().alias("none"),
                         F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "th", F.xxhash64("text", "none")).drop("none")
    size = F.length("text").cast("long")
    keys = stored(frame.select("k", "th", size.alias("n")).distinct(), "keys")
    next_ = stored(followers(keys.select("k", "th")).join(keys, ["k", "th"]), "next")
    # Both sides of the join below need the same columns of the texts, so that one exchange
    # serves both; marks are made after it, on each side, rather than shuffled.
    whole = frame.groupBy("k", "th").agg(F.first("text").alias("text"), F.count("*").alias("rows")).where("rows > 0")
    own = marks(F.col("text"), gram, window)
    sent = whole.join(next_.select(F.col("k").alias("pk"), F.col("th").alias("pth"), F.col("n").alias("pn"),
                                   F.col("nk").alias("k"), F.col("nth").alias("th")), ["k", "th"]).select(
        F.col("pk").alias("k"), F.col("pth").alias("th"),
        F.substring("text", F.lit(1), F.floor(F.col("pn") / 3).cast("int")).alias("head"), own.alias("found")).select(
        "k", "th", "head", F.transform(hashes(F.col("found")), lambda h: (h - (1 << 31)).cast("int")).alias("next"))
    both = whole.join(sent, ["k", "th"]).withColumn("n", size).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), (F.col("n") - F.floor(F.col("n") / 3)).cast("int")), "head"))
    both = both.select("k", "rows", "n", own.alias("found"), "next", F.sha2(F.col("edited").cast("binary"), 256).alias("sha"),
                       marks(F.col("edited"), gram, window).alias("changed"))
    both = both.select("*", hashes(F.col("found")).alias("own"), hashes(F.col("changed")).alias("other"))
    out = both.select(
        F.when(F.col("k") > -NO_ID - 1, F.col("k")).alias(id_col), F.col("n").alias("n_chars"),
        F.col("sha").alias("edited_sha256"), printed(F.col("found")).alias("fingerprint"),
        printed(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.transform("own", lambda h: (h - (1 << 31)).cast("int")), F.col("next")).alias("near_next"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy"))
    return out.drop("copy")
