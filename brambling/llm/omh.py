"""Order MinHash fingerprints, sensitive to edit distance, from Spark expressions alone.

A text's k-mers (k words in a row) are numbered by occurrence, so a repeated k-mer is a new element each
time.  One hash of (k-mer, number) orders them and deals them into ``BINS`` bins by its leading bits, which
stands for as many permutations; in each bin the ``PICK`` smallest are kept, put back into text order, and
hashed as a tuple.  Two texts agree in a bin when they hold the same elements there in the same order.

All steps are array expressions inside the row: k-mers are sorted as pairs of a 64-bit hash and a position, and
runs of equal hashes give the occurrence numbers.

Defined cases: a null text is an empty one; a text without words has no bins, is like another such text
(1.0) and unlike any other (0.0); a text with fewer than k words has one k-mer; the next of the last document is the first; a null id comes first; rows that share an id have the
same next document, and where that id is repeated its smallest text counts; one document is its own next; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from brambling.llm.common import col, settle
from brambling.llm.rules import words
from brambling.operators.ordering import sorted_blocks

K, BINS, PICK = 2, 32, 2
_PAIRS = "array<struct<h:bigint,at:int>>"
_NO_ID = -(1 << 63)


def _starts(array: Column, key) -> Column:
    """Places at which the key of a sorted array changes."""
    return F.filter(F.sequence(F.lit(0), F.size(array) - 1), lambda i: (i == 0) | (key(F.get(array, i)) != key(F.get(array, i - 1))))


def fingerprints(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: one long per filled bin, the bin above a 32-bit hash, sorted.

    Every intermediate array is a column of its own, used more than once, so that it is computed once.
    """
    keep = df.columns
    c = lambda x: F.col(f"_{x}")
    some = F.size(c("w")) > 0
    none = F.array().cast(_PAIRS)
    gram = lambda i: F.xxhash64(*[F.get(c("w"), i + k) for k in range(K)])
    pair = lambda h, at: F.struct(h.alias("h"), at.alias("at"))
    out = df.withColumn("_w", words(col(text)))
    order = F.transform(F.sequence(F.lit(0), F.greatest(F.size(c("w")) - K, F.lit(0))), lambda i: pair(gram(i), i))
    out = out.withColumn("_p", F.when(some, F.sort_array(order)).otherwise(none))
    out = out.withColumn("_r", F.when(some, _starts(c("p"), lambda x: x["h"])).otherwise(F.array().cast("array<int>")))
    runs = F.transform(c("r"), lambda at, j: F.sequence(F.lit(1), F.coalesce(F.get(c("r"), j + 1), F.size(c("p"))) - at))
    alone = F.size(c("r")) == F.size(c("p"))
    out = out.withColumn("_o", F.when(alone, F.array_repeat(F.lit(1), F.size(c("p")))).otherwise(F.flatten(runs)))
    number = F.transform(c("p"), lambda x, i: pair(F.xxhash64(x["h"], F.get(c("o"), i)), x["at"]))
    out = out.withColumn("_q", F.when(F.size(c("o")) == F.size(c("p")), F.sort_array(number)).otherwise(none))
    bin_of = lambda x: F.shiftrightunsigned(x["h"], 64 - (BINS - 1).bit_length())
    out = out.withColumn("_b", F.when(some, _starts(c("q"), bin_of)).otherwise(F.array().cast("array<int>")))

    def signature(at: Column) -> Column:
        first = F.get(c("q"), at)
        taken = F.filter(F.slice(c("q"), at + 1, F.lit(PICK)), lambda x: bin_of(x) == bin_of(first))
        in_order = F.array_sort(F.transform(taken, lambda x: x["at"]))
        tuple_hash = F.aggregate(in_order, F.lit(17).cast("long"), lambda acc, x: F.xxhash64(acc, gram(x)))
        return F.shiftleft(bin_of(first), 32).bitwiseOR(tuple_hash.bitwiseAND(F.lit(0xFFFFFFFF)))

    # a 5-bit bin above 32 bits is never negative
    return out.select(*[col(k) for k in keep], F.array_sort(F.transform(c("b"), signature)).alias(name))


def likeness(a: Column, b: Column) -> Column:
    """Share of the bins filled in either text in which both agree."""
    bins = lambda f: F.transform(f, lambda x: F.shiftright(x, 32))
    filled = F.size(F.array_union(bins(a), bins(b)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled).cast("double")


def shown(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 10, "0"))), "")


def next_ids(keys: DataFrame) -> DataFrame:
    """Add ``next``: the next greater ``key``, after the greatest the smallest; keys are distinct.

    Keys are sorted by range; a block's last key takes the first of the next block.
    """
    blocks = sorted_blocks(keys, ["key"])
    firsts = blocks.groupBy("_block").agg(F.min("key").alias("first"))      # one row per sort range
    over = Window.orderBy("_block")
    edge = firsts.select(F.col("_block").alias("_b"), F.coalesce(F.lead("first").over(over), F.min("first").over(Window.partitionBy())).alias("after"))
    inside = F.lead("key").over(Window.partitionBy("_block").orderBy("_place"))
    return (blocks.withColumn("inside", inside).join(F.broadcast(edge), F.col("_block") == F.col("_b"))
            .select(*keys.columns, F.coalesce("inside", "after").alias("next")))


def edited_pairs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, next, text, edited): the second half of each text replaced by the head of the next document's."""
    given = docs.select(F.coalesce(col(id).cast("long"), F.lit(_NO_ID)).alias("key"), F.coalesce(col(text), F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    keys = settle(next_ids(given.groupBy("key").agg(F.max(half).alias("half"))))
    wanted = keys.select(F.col("key").alias("to"), "next", "half")
    heads = (given.join(wanted, F.col("key") == F.col("next")).select("to", F.left("text", F.col("half")).alias("head"))
             .groupBy("to").agg(F.min("head").alias("head")))
    met = given.join(heads, F.col("key") == F.col("to")).join(keys.select(F.col("key").alias("k"), "next"), F.col("key") == F.col("k"))
    edited = F.concat(F.left("text", F.length("text") - half), F.left("head", half))
    return met.select("key", "next", "text", edited.alias("edited"))


def compare(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that of the next document."""
    pairs = edited_pairs(docs, id, text)
    signed = fingerprints(fingerprints(pairs, "text", "f"), "edited", "e")
    done = settle(signed.select("key", "next", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "f", "e"))
    after = done.groupBy(F.col("key").alias("k")).agg(F.min("f").alias("g"))
    met = done.join(after, F.col("next") == F.col("k"))
    return met.select(F.when(F.col("key") != _NO_ID, F.col("key")).alias("doc_id"), "n_chars", "edited_sha256", shown(F.col("f")).alias("fingerprint"),
                      shown(F.col("e")).alias("edited_fingerprint"), likeness(F.col("f"), F.col("e")).alias("near_edited"), likeness(F.col("f"), F.col("g")).alias("near_next"))
