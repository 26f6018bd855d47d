"""Ranked lexical search: the items' terms are counted straight from the texts by an Aho-Corasick automaton.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.  Texts are read as
UTF-8 bytes, with every byte outside a term turned into a space, so " term " finds whole terms only, and two
neighbours share the space between them.

1. *Items* become (item, term) rows and are cut into groups of at most ``GROUP_BYTES`` of terms and ``ITEM_PAIRS``
   rows (and one item more), so what is sent to a task is bounded however many items there are.  A group has one
   automaton and one scan of the texts; an item's terms stay in one group, so its scores are whole.
2. *Scan.*  Each text is run through the automaton once: its number of terms, and how often it holds each item term.
3. *Statistics* N, L and the document frequencies are sums over all rows of the scan.
4. *Scores.*  The automaton's outputs map to the items that hold the term: a task adds up their contributions and
   keeps the ``k`` best documents of every item it has seen; these are ranked in Spark.

Scores are 64-bit integers: w * ((10^9 * tf) div (1000 * tf + 8 * m)) with w = floor(1000 ln((2N + 2) / (2 df + 1)))
and m = 10 + (90 n N) div L.

Defined cases: null and empty texts have no terms and are not counted in N; items without terms, and items that
nothing scores for, give no rows; rows that repeat an item id are one item with the terms of all; documents that
repeat an id are documents of their own; documents without an id count in the statistics but are not ranked; empty
tables give no rows; extra columns are ignored.  Ids of documents are whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from brambling.llm.common import col, discard, settle
from brambling.operators.ordering import running_sums

GROUP_BYTES = 4_000_000      # terms of the items of one automaton
ITEM_PAIRS = 4_000_000       # (term, item) pairs that go to a task with one automaton
SLICE_BYTES = 4_000_000      # text a task reads at a time


def _fold() -> bytes:
    """Bytes of terms as they are, A-Z in lower case; every other byte a space."""
    out = bytearray(b" " * 128 + bytes(range(128, 256)))
    for letters in (range(48, 58), range(97, 123)):
        out[letters.start:letters.stop] = bytes(letters)
    out[65:91] = bytes(range(97, 123))
    return bytes(out)


FOLD = _fold()


def spaced(text: bytes) -> bytes:
    """A text's terms between single or several spaces, with one at each end."""
    return b" " + text.translate(FOLD) + b" "


class Automaton:
    """Counts whole terms; terms are UTF-8 bytes, read as characters of one byte each."""

    def __init__(self, terms: list[bytes]):
        import ahocorasick
        self.found = ahocorasick.Automaton()
        for number, term in enumerate(terms):
            self.found.add_word(f" {term.decode('latin-1')} ", number)
        if terms:
            self.found.make_automaton()

    def count(self, text: bytes) -> Counter:
        """How often each term, by its number, occurs in a text made ready by ``spaced``."""
        if not len(self.found):
            return Counter()
        return Counter(map(itemgetter(1), self.found.iter(text.decode("latin-1"))))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, texts as bytes) of about ``limit`` bytes each."""
    texts = texts.cast(pa.large_string()).cast(pa.large_binary())
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        upto = int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, "right"))
        upto = min(max(upto, at + 1), len(texts))
        yield at, texts.slice(at, upto - at).to_pylist()
        at = upto


def item_terms(items: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term) once each; the term as UTF-8 bytes."""
    kind = items.select(col(id).alias("item_id")).schema[0].dataType.simpleString()

    def cut(batches):
        for b in batches:
            for at, texts in slices(b.column(1)):
                for i, raw in enumerate(texts):
                    terms = sorted(set(spaced(raw).split())) if raw else []
                    if terms:
                        owner = b.column(0).take(pa.array(np.full(len(terms), at + i)))
                        yield pa.RecordBatch.from_arrays([owner, pa.array(terms, pa.binary())], names=["item_id", "term"])

    return items.select(col(id).alias("item_id"), col(text).alias("text")).mapInArrow(cut, f"item_id {kind}, term binary").distinct()


def _item_groups(terms: DataFrame, group_bytes: int, item_pairs: int) -> DataFrame:
    """(item_id, grp): items in order of their ids, cut wherever a bound is full; an item's terms stay together."""
    size = terms.groupBy("item_id").agg(F.sum(F.length("term")).alias("bytes"), F.count(F.lit(1)).alias("terms"))
    sums = running_sums(size, ["item_id"], {"all_bytes": F.col("bytes"), "all_terms": F.col("terms")})
    full = lambda upto, own, most: F.floor((F.col(upto) - F.col(own)) / most)
    cut = F.struct(full("all_bytes", "bytes", group_bytes).alias("x"), full("all_terms", "terms", item_pairs).alias("y"))
    return sums.select("item_id", cut.alias("grp"))


def scan(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, term, tf) of every text that holds a term at all: its number of terms, and arrays of the given terms' numbers and counts."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        automaton = Automaton(shared.value)
        for b in batches:
            for at, texts in slices(b.column(1)):
                rows, size, ends, term, tf = [], [], [0], [], []
                for i, raw in enumerate(texts):
                    ready = spaced(raw) if raw else b""
                    n = len(ready.split())
                    if not n:
                        continue
                    found = automaton.count(ready)
                    rows.append(at + i)
                    size.append(n)
                    term.extend(found.keys())
                    tf.extend(found.values())
                    ends.append(len(term))
                ends = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(v, kind)) for v, kind in ((term, pa.int32()), (tf, pa.int64()))]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(size, pa.int64()), *lists], names=["doc_id", "n", "term", "tf"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, term array<int>, tf array<long>")


class _Best:
    """The k best documents of each item: greatest score first, then least id."""

    def __init__(self, k: int, items: int):
        self.k, self.items = k, items
        self.item, self.score, self.doc = (np.empty(0, np.int64) for _ in range(3))
        self.floor = np.ones(items, np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        keep = score >= self.floor[item]
        item, score, doc = (np.concatenate([a, b[keep]]) for a, b in ((self.item, item), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        first = np.searchsorted(item, item)
        place = np.arange(len(item)) - first
        top = place < self.k
        self.item, self.score, self.doc = item[top], score[top], doc[top]
        last = place[top] == self.k - 1
        self.floor[self.item[last]] = self.score[last]


def _scored(scanned: DataFrame, weight: np.ndarray, holders: tuple[np.ndarray, np.ndarray], items: int, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score) of the documents with an id; the ``k`` best of every item in each task.

    ``holders`` are the bounds and item numbers of each term's list of items.
    """
    shared = scanned.sparkSession.sparkContext.broadcast((weight, *holders))

    def run(batches):
        weight, bounds, item_of = shared.value
        best = _Best(k, items)
        for b in batches:
            doc = b.column(0).to_numpy(zero_copy_only=False)
            n = b.column(1).to_numpy()
            ends = b.column(2).offsets.to_numpy().astype(np.int64)
            term, tf = b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy()
            ends -= ends[0]
            m = 10 + (90 * n * n_docs) // n_terms
            load = np.concatenate([[0], np.cumsum(np.diff(bounds)[term])])[ends]      # (document, item) additions before each document
            at = 0
            while at < len(doc):
                upto = max(int(np.searchsorted(load, load[at] + 2_000_000, "right")) - 1, at + 1)
                upto = min(upto, len(doc))
                part = slice(int(ends[at]), int(ends[upto]))
                owner = np.repeat(np.arange(upto - at), np.diff(ends[at:upto + 1]))
                t, f = term[part], tf[part]
                gain = weight[t] * ((1_000_000_000 * f) // (1000 * f + 8 * m[at:upto][owner]))
                many = bounds[t + 1] - bounds[t]
                spot = np.repeat(bounds[t], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                cell, gain = np.repeat(owner, many) * items + item_of[spot], np.repeat(gain, many)
                if (upto - at) * items <= 4 * len(cell):
                    total = np.zeros((upto - at) * items, np.int64)
                    np.add.at(total, cell, gain)
                    some = np.flatnonzero(total > 0)
                    total = total[some]
                else:
                    some, which = np.unique(cell, return_inverse=True)
                    total = np.zeros(len(some), np.int64)
                    np.add.at(total, which, gain)
                    some, total = some[total > 0], total[total > 0]
                d, item, score = doc[at:upto][some // items], some % items, total
                best.add(item, score, d)
                at = upto
        yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array(best.doc), pa.array(best.score)], names=["item", "doc_id", "score"])

    return scanned.filter(F.col("doc_id").isNotNull()).mapInArrow(run, "item long, doc_id long, score long")


def _group(docs: DataFrame, pairs: list, kind: str, k: int) -> DataFrame:
    """(item_id, doc_id, score): the best of every task for the items of one group; ``pairs`` are its (item_id, term) rows."""
    spark = docs.sparkSession
    words = sorted({bytes(row["term"]) for row in pairs})
    known = sorted({row["item_id"] for row in pairs}, key=lambda v: (v is None, v))
    scanned = settle(scan(docs, words))
    n_docs, n_terms = scanned.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = scanned.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = np.zeros(len(words), np.int64)
    for term, w in df.select("term", F.floor(1000 * F.log((2.0 * n_docs + 2) / (2 * F.col("df") + 1)))).collect():
        weight[term] = w
    number, place = {w: i for i, w in enumerate(words)}, {v: i for i, v in enumerate(known)}
    owner = np.array([number[bytes(row["term"])] for row in pairs], np.int64)
    order = np.argsort(owner, kind="stable")
    holders = np.searchsorted(owner[order], np.arange(len(words) + 1)), np.array([place[row["item_id"]] for row in pairs], np.int64)[order]
    found = settle(_scored(scanned, weight, holders, len(known), n_docs, max(n_terms, 1), k))
    discard(scanned)
    return found.join(spark.createDataFrame(list(enumerate(known)), f"item long, item_id {kind}"), "item").select("item_id", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
           group_bytes: int = GROUP_BYTES, item_pairs: int = ITEM_PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item with a score above 0."""
    given = docs.select(col(id).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    terms = settle(item_terms(items, item_id, item_text))
    kind = terms.schema["item_id"].dataType.simpleString()
    groups = settle(_item_groups(terms, group_bytes, item_pairs))
    best = None
    for row in groups.select("grp").distinct().orderBy("grp").collect():
        held = groups.filter(F.col("grp") == F.struct(F.lit(row["grp"]["x"]).alias("x"), F.lit(row["grp"]["y"]).alias("y"))).select(F.col("item_id").alias("held"))
        pairs = terms.join(held, F.col("item_id").eqNullSafe(F.col("held")), "left_semi").collect()
        part = _group(given, pairs, kind, k)
        best = part if best is None else best.union(part)
    if best is None:
        best = terms.select("item_id", F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
