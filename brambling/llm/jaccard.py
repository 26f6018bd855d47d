"""Exact n-gram Jaccard join by vertical partitioning.

Texts become sets of word n-grams; equal word sequences form one class, so copies are compared once.  Two
classes link when 100 * intersection >= threshold * union.

1. *Lonely n-grams.*  A linked text shares at least threshold percent of its n-grams, so it has few that
   nobody else has.  Over one slice of the hash range, classes are counted per n-gram (a minimum and a
   maximum, combined before the shuffle); classes with too many lonely n-grams in the slice alone can link
   to nothing and go.  The texts of the rest are picked where they are read, by a bitmap of hashed ids, and
   what comes along by chance goes when their sets meet the classes; no text is shuffled.
2. *Global order and fragments.*  The rest is ordered by the number of classes that hold an n-gram, rare
   first, and the order is cut into fragments of equal load: each set becomes one segment per fragment.
3. *Candidates.*  Two linked sets share one of their first |x| - ceil(t|x|) + 1 n-grams in that order.
   Every bucket of such an n-gram has a hub, another in each round, and every set is compared with one hub of
   its buckets a round; what links is contracted to components, and buckets whose members are in one component
   are done.  After the hub rounds, the members outside the largest component of a bucket are compared with those
   of other components in it, in cells of bounded size whose pairs never become rows.
   A pair is taken up at its first common n-gram only as far as that can be told: what either set has left from there
   on bounds the overlap, and where that is too little the pair either cannot link or has met before.
4. *Bitmaps.*  A set has a bitmap of ``BITS`` parities of its n-grams' hashes.  Two sets differ in at least as many
   n-grams as their bitmaps differ in bits, so a candidate whose bitmaps differ too much cannot link; only what
   this bound leaves goes on.  Nothing that links is lost.
5. *Partial overlaps.*  Each fragment counts the overlap of its segments of a pair; the sum over fragments
   is the exact intersection.

Defined cases: null, empty and blank texts have no set, link with nothing and form components of their own
(of their id); rows that repeat an id are rows of their own, but share the component id if their texts link;
a null id never becomes a component's name unless all ids of the component are null; an empty table gives
no rows; extra columns are ignored.  N-grams and word sequences are told apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from brambling.llm.cells import deal, pairs_of, parts, whole_runs
from brambling.llm.common import col, discard, settle
from brambling.llm.components import components
from brambling.llm.shingles import shingles

THRESHOLD = 75      # percent
SLICE = 0.35        # share of the hash range in which lonely n-grams are counted
FRAGMENTS = 4
HUB_ROUNDS = 4
BITS = 1_024        # of a set's bitmap
CELL = 2_048        # members of a bucket compared in one cell
ID_BITS = 1 << 26   # of the bitmap of ids by which texts are picked, at most: 8 MB, sent to every executor
_DF_CAP, _FP_BITS = (1 << 20) - 1, 43


def _least_shared(n: Column, threshold: int) -> Column:
    """ceil(threshold% of n): n-grams that a set of n must share with any set it links to."""
    return F.floor((n * threshold + 99) / 100).cast("long")


def signatures(docs: DataFrame, n: int = 5, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, cls) per row; ``cls`` is null for a text without words."""
    given = docs.select(col(id).alias("doc_id"), col(text).alias("text"))
    schema = T.StructType([given.schema["doc_id"], *T.StructType.fromDDL("n_shingles long, cls long")])

    def sign(batches):
        for b in batches:
            size, cls, there = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for i, grams, whole in shingles(b.column(1), n):
                size[i], cls[i], there[i] = len(grams), np.uint64(whole).astype(np.int64), 1
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(cls, mask=there == 0)], names=["doc_id", "n_shingles", "cls"])

    return given.mapInArrow(sign, schema)


def _sliced(docs: DataFrame, n: int, text: str, share: float) -> DataFrame:
    """(gram, cls) for the n-grams in the first ``share`` of the hash range."""
    top = np.uint64(int(share * 2**64))

    def cut(batches):
        for b in batches:
            found, owner = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for _, grams, whole in shingles(b.column(0), n):
                part = grams[:np.searchsorted(grams, top)]
                found.append(part)
                owner.append(np.full(len(part), np.uint64(whole).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(owner))], names=["gram", "cls"])

    return docs.select(col(text).alias("text")).mapInArrow(cut, "gram long, cls long")


def bitmap(grams: np.ndarray) -> np.ndarray:
    """How many of the hashes fall on each of ``BITS`` places, odd or even."""
    place = ((grams >> np.uint64(20)) & np.uint64(BITS - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=BITS) & 1).astype(np.uint8), bitorder="little").view("<i8").astype(np.int64)


def _sets(docs: DataFrame, n: int, text: str) -> DataFrame:
    """(cls, n, grams, bits) per row with a word; ``bits`` are parities, 64 in a number."""

    def cut(batches):
        for b in batches:
            cls, size, sets, bits = [], [], [], [np.empty(0, np.int64)]
            for _, grams, whole in shingles(b.column(0), n):
                cls.append(np.uint64(whole).astype(np.int64))
                size.append(len(grams))
                sets.append(grams.view(np.int64))
                bits.append(bitmap(grams))
            flat = np.concatenate([np.empty(0, np.int64), *sets])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(flat))
            maps = pa.ListArray.from_arrays(pa.array(np.arange(len(cls) + 1) * (BITS // 64), pa.int32()), pa.array(np.concatenate(bits)))
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(size, pa.int64()), lists, maps], names=["cls", "n", "grams", "bits"])

    return docs.select(col(text).alias("text")).mapInArrow(cut, "cls long, n long, grams array<long>, bits array<long>")


def _survivors(docs: DataFrame, classes: DataFrame, n: int, text: str, threshold: int) -> DataFrame:
    """Classes (cls, n, rep) that may link to another: few of their n-grams are theirs alone."""
    grams = _sliced(docs, n, text, SLICE)
    lonely = (grams.groupBy("gram").agg(F.min("cls").alias("cls"), F.max("cls").alias("last"))
              .filter(F.col("cls") == F.col("last")).groupBy("cls").agg(F.count(F.lit(1)).alias("alone")))
    met = classes.join(lonely, "cls", "left")
    return met.filter(F.coalesce("alone", F.lit(0)) <= F.col("n") - _least_shared(F.col("n"), threshold)).select("cls", "n", "rep")


def _picked(docs: DataFrame, alive: DataFrame, id: str, text: str) -> DataFrame:
    """(text) of every row whose id names a class of ``alive``, and of the few others whose ids share its bit.

    The bitmap is broadcast in parts of 32,768 bits, so the texts stay in their partitions.
    """
    size = min(max(1 << (8 * alive.count()).bit_length(), 1 << 15), ID_BITS)
    bit = lambda c: F.xxhash64(c).bitwiseAND(F.lit(size - 1))
    marks = (alive.select(bit("rep").alias("_bit")).groupBy(F.shiftright("_bit", 15).alias("_part"))
             .agg(F.bitmap_construct_agg(F.col("_bit").bitwiseAND(F.lit((1 << 15) - 1))).alias("_marks")))
    met = docs.select(col(text).alias("text"), bit(col(id)).alias("_bit")).join(F.broadcast(marks), F.shiftright("_bit", 15) == F.col("_part"))
    byte = "conv(hex(substring(_marks, cast((_bit & 32767) div 8 as int) + 1, 1)), 16, 10)"
    return met.filter(F.expr(f"shiftright(cast({byte} as int), cast(_bit & 7 as int)) & 1 = 1")).select("text")


def _ordered(sets: DataFrame, threshold: int) -> DataFrame:
    """(cls, n, toks), written: the n-grams of each set that another set holds too, in global order, rare first."""
    posts = sets.select("cls", F.explode("grams").alias("gram"))
    # written, so that the shuffle behind the counts is gone before the next one
    df = settle(posts.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") > 1))
    # a frequency and a hash: the frequencies of a sorted set are runs, which take hardly any room
    met = posts.join(df, "gram").select("cls", F.struct(F.least(F.col("df"), F.lit(_DF_CAP)).cast("int").alias("df"), "gram").alias("tok"))
    ordered = settle(met.groupBy("cls").agg(F.sort_array(F.collect_list("tok")).alias("toks")).join(sets.select("cls", "n"), "cls")
                     .filter(F.size("toks") >= _least_shared(F.col("n"), threshold)))
    discard(df)
    return ordered


def _place(tok: Column) -> Column:
    """The place of an n-gram in the global order, to 2**-43 of the hash range."""
    return F.shiftleft(tok["df"].cast("long"), _FP_BITS) + F.shiftright(tok["gram"], 64 - _FP_BITS)


def _fragments(ordered: DataFrame, fragments: int) -> DataFrame:
    """(cls, frag, grams): the global order cut at equal loads, one segment per set and fragment."""
    shares = [k / fragments for k in range(1, fragments)]
    cuts = ordered.select(F.explode(F.transform("toks", _place)).alias("place")).agg(F.percentile_approx("place", shares, 1000)).first()[0] or []
    bounds = [None, *cuts, None]
    inside = lambda lo, hi: lambda t: (F.lit(True) if lo is None else _place(t) >= lo) & (F.lit(True) if hi is None else _place(t) < hi)
    segments = F.array(*[F.transform(F.filter("toks", inside(lo, hi)), lambda t: t["gram"]) for lo, hi in zip(bounds[:-1], bounds[1:])])
    return (ordered.select("cls", F.posexplode(segments).alias("frag", "grams")).filter(F.size("grams") > 0))


def _possible(pairs: DataFrame, bits: DataFrame, threshold: int) -> DataFrame:
    """Candidates whose bitmaps differ in no more bits than linked sets may differ in n-grams."""
    a, b = (bits.select(F.col("cls").alias(side), F.col("bits").alias(f"x{side}")) for side in "ab")
    differ = F.aggregate(F.zip_with("xa", "xb", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, x: s + x)
    return pairs.join(a, "a").join(b, "b").filter((100 + threshold) * differ <= (100 - threshold) * (F.col("na") + F.col("nb"))).select(*pairs.columns)


def verify(pairs: DataFrame, segments: DataFrame, threshold: int = THRESHOLD, fragments: int = FRAGMENTS) -> DataFrame:
    """Pairs (a, b) that link: partial overlaps are counted fragment by fragment and summed per pair."""
    pairs = pairs.withColumn("frag", F.explode(F.array(*[F.lit(k) for k in range(fragments)])))
    left = segments.select(F.col("cls").alias("a"), "frag", F.col("grams").alias("left"))
    right = segments.select(F.col("cls").alias("b"), "frag", F.col("grams").alias("right"))
    part = F.size(F.array_intersect("left", "right"))
    shared = (pairs.join(left, ["a", "frag"]).join(right, ["b", "frag"]).select("a", "b", "na", "nb", part.cast("long").alias("part"))
              .groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("shared")))
    union = F.col("na") + F.col("nb") - F.col("shared")
    return shared.filter(100 * F.col("shared") >= threshold * union).select("a", "b")


def _enough(left: Column, n: Column, threshold: int) -> Column:
    """Whether ``left`` n-grams from the first common one on can make two sets of ``n`` together link."""
    return (100 + threshold) * left >= threshold * n


def _as_pair(threshold: int) -> tuple[Column, list[Column]]:
    """Whether two members' sizes allow a link, and the pair in order of class."""
    fits = (100 * F.least("n", "hn") >= threshold * F.greatest("n", "hn")) & _enough(F.least("ahead", "hahead"), F.col("n") + F.col("hn"), threshold)
    first = F.col("cls") < F.col("hcls")
    return fits, [F.least("cls", "hcls").alias("a"), F.greatest("cls", "hcls").alias("b"),
                  F.when(first, F.col("n")).otherwise(F.col("hn")).alias("na"), F.when(first, F.col("hn")).otherwise(F.col("n")).alias("nb")]


def _hub_pairs(members: DataFrame, turn: int, threshold: int) -> DataFrame:
    """Each set against one hub: the first, in this turn's order, of its buckets' hubs in another component."""
    hub = F.min(F.struct(F.xxhash64("cls", F.lit(turn)).alias("h"), F.col("cls").alias("hcls"), F.col("n").alias("hn"), F.col("ahead").alias("hahead"), F.col("comp").alias("hcomp")))
    hubs = (members.groupBy("gram").agg(hub.alias("hub"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            .filter(F.col("lo") != F.col("hi")).select("gram", "hub"))
    fits, pair = _as_pair(threshold)
    met = members.join(hubs, "gram").select("cls", "n", "ahead", "comp", "hub", "hub.*").filter((F.col("comp") != F.col("hcomp")) & fits)
    return met.groupBy("cls", "n").agg(F.min("hub").alias("hub")).select("cls", "n", "hub.*").select(*pair).distinct()


def _rest_pairs(members: DataFrame, bits: DataFrame, threshold: int, cell: int) -> DataFrame:
    """Members outside a bucket's largest component against those of other components in the bucket, if their bitmaps allow a link."""
    sizes = members.groupBy("gram", "comp").agg(F.count(F.lit(1)).alias("k"))
    most = (sizes.groupBy("gram").agg(F.max(F.struct("k", F.col("comp").alias("main"))).alias("m"), F.count(F.lit(1)).alias("comps"))
            .filter(F.col("comps") > 1).select("gram", "m.main"))
    split = settle(members.join(most, "gram").select(F.lit(0).alias("dim"), F.lit(0).alias("tab"), F.col("gram").alias("code"), (F.col("comp") != F.col("main")).alias("home"), "cls", "n", "ahead", "comp"))
    heavy = settle(split.groupBy("dim", "tab", "code").agg(F.count_if("home").alias("h"), F.count(F.lit(1)).alias("r")).filter(F.col("r") > cell)
                   .select("dim", "tab", "code", parts("h", cell).alias("nl"), parts("r", cell).alias("nr")))
    keys = ["code", "lp", "rp"]

    def compare(batches):
        for b in whole_runs(batches, keys):
            get = lambda c: b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
            cls, n, ahead, comp, home = (get(c) for c in ("cls", "n", "ahead", "comp", "home"))
            x = b.column(b.schema.get_field_index("bits")).flatten().to_numpy().view(np.uint64).reshape(b.num_rows, -1)
            start = np.ones(b.num_rows, bool)
            start[1:] = np.any([get(k)[1:] != get(k)[:-1] for k in keys], 0)
            for i, j in pairs_of(start, get("left"), get("right"), 50_000):
                fits = (comp[i] != comp[j]) & (~home[j] | (cls[i] < cls[j])) & (100 * np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]))
                fits &= (100 + threshold) * np.minimum(ahead[i], ahead[j]).astype(np.int64) >= threshold * (n[i] + n[j])
                i, j = i[fits], j[fits]
                differ = np.bitwise_count(x[i] ^ x[j]).sum(1, dtype=np.int64)
                near = (100 + threshold) * differ <= (100 - threshold) * (n[i] + n[j])
                i, j = i[near], j[near]
                i, j = np.where(cls[i] < cls[j], i, j), np.where(cls[i] < cls[j], j, i)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (cls[i], cls[j], n[i], n[j])], names=["a", "b", "na", "nb"])

    dealt = deal(split.join(bits, "cls"), None if heavy.isEmpty() else heavy).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.select(*keys, "left", "right", "home", "cls", "n", "ahead", "comp", "bits").mapInArrow(compare, "a long, b long, na long, nb long").distinct()


def link_classes(sets: DataFrame, threshold: int = THRESHOLD, fragments: int = FRAGMENTS, cell: int = CELL) -> DataFrame:
    """(node, component) of the classes that link to another; ``sets`` are (cls, n, grams, bits), each class once,
    in a settled table that is removed when the ordered sets are written."""
    ordered = _ordered(sets, threshold)
    bits = settle(sets.select("cls", "bits").join(ordered.select("cls"), "cls", "left_semi"))
    discard(sets)
    segments = settle(_fragments(ordered, fragments))
    first = F.col("n") - _least_shared(F.col("n"), threshold) + 1 - (F.col("n") - F.size("toks"))
    prefix = (ordered.withColumn("first", first.cast("int")).filter(F.col("first") > 0)
              .select("cls", "n", F.size("toks").alias("shared"), F.posexplode(F.slice("toks", F.lit(1), F.col("first"))["gram"]).alias("at", "gram"))
              .select("cls", "n", "gram", (F.col("shared") - F.col("at")).alias("ahead")))
    prefix = settle(prefix)
    discard(ordered)
    edges, found = None, None
    for turn in range(HUB_ROUNDS + 1):
        members = prefix.withColumn("comp", F.col("cls"))
        if found is not None:
            members = prefix.join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("component", "cls")).drop("component")
        pairs = settle(_possible(_hub_pairs(members, turn, threshold), bits, threshold) if turn < HUB_ROUNDS else _rest_pairs(members, bits, threshold, cell))
        if pairs.isEmpty():
            if turn < HUB_ROUNDS:
                continue
            break
        ends = settle(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct())
        linked = settle(verify(pairs, segments if turn == 0 else segments.join(ends, "cls", "left_semi"), threshold, fragments))
        edges = linked if edges is None else edges.union(linked)
        if not linked.isEmpty():
            found = settle(components(edges if found is None else linked.union(found.select(F.col("node").alias("a"), F.col("component").alias("b")))))
    if found is None:
        return prefix.select(F.col("cls").alias("node"), F.col("cls").alias("component")).limit(0)
    for spent in (prefix, segments, bits):
        discard(spent)
    return found


def _resolve(docs: DataFrame, n: int, threshold: int, id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Signatures of all rows, and (cls, component, component_id) of every class."""
    signed = settle(signatures(docs, n, id, text))
    classes = settle(signed.filter(F.col("cls").isNotNull()).groupBy("cls").agg(F.max("n_shingles").alias("n"), F.min("doc_id").alias("rep")))
    alive = settle(_survivors(docs, classes, n, text, threshold))
    found = _sets(_picked(docs, alive, id, text), n, "text").join(alive.select("cls"), "cls", "left_semi")
    sets = settle(found.groupBy("cls", "n").agg(F.first("grams").alias("grams"), F.first("bits").alias("bits")))
    linked = link_classes(sets, threshold)
    named = classes.join(linked.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    return signed, settle(named.join(smallest, "component").select("cls", "component", "component_id"))


def near_duplicates(docs: DataFrame, n: int = 5, threshold: int = THRESHOLD, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id that links reach from the row's text, its own included.
    """
    signed, of_class = _resolve(docs, n, threshold, id, text)
    out = signed.join(of_class, "cls", "left")
    return out.select("doc_id", "n_shingles", F.coalesce(F.when(F.col("cls").isNotNull(), F.col("component_id")), "doc_id").alias("component_id"))


def deduplicate(docs: DataFrame, n: int = 5, threshold: int = THRESHOLD, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one of each component: its smallest id.  Texts without words all stay.

    Rows whose id is null or repeated cannot be named by it; these few are told apart by their texts.
    """
    signed, of_class = _resolve(docs, n, threshold, id, text)
    many = signed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).filter((F.col("k") > 1) | F.col("doc_id").isNull()).select(F.col("doc_id").alias("_many"))
    many = settle(many)
    beaten = (signed.join(of_class, "cls").filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_many")))
    rows = docs.select(F.struct("*").alias("row"), col(id).alias("_id"), col(text).alias("_text"))
    plain = rows.join(beaten.union(many), F.col("_id").eqNullSafe(F.col("_many")), "left_anti").select("row.*")
    shared = rows.join(many, F.col("_id").eqNullSafe(F.col("_many")), "left_semi")
    named = signatures(shared, n, "row", "_text").withColumnRenamed("doc_id", "row").withColumn("_id", F.col("row")[id])
    met = named.join(of_class, "cls", "left").filter(F.col("cls").isNull() | F.col("_id").eqNullSafe(F.col("component_id")))
    alone = met.filter(F.col("cls").isNull()).select("row.*")
    one = met.filter(F.col("cls").isNotNull()).groupBy("component").agg(F.first("row").alias("row")).select("row.*")
    return plain.unionByName(alone).unionByName(one)
