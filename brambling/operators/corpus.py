"""Corpus building: words in long form, lemmas, language, sentences, clauses, embeddings."""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from brambling.functions import text as T
from brambling.operators import skipgram
from brambling.operators.lookup import sized
from brambling.operators.ordering import number_rows, top_k
from brambling.operators.stem import stem_words
from brambling.session import remove, settings, settle


MARK = "\x1f"                                # between two words of a row
_LOWER = [ord(chr(i).lower()) if i != 0xb5 else i for i in range(256)]
_BLANKS = b"\t\n\x0b\f\r \x85\xa0"
# (table, deleted) for bytes of Latin-1: ``T.words`` deletes what is neither letter of ASCII nor blank, ``_letters`` cuts there
WORDS = (bytes(32 if i in _BLANKS else c for i, c in enumerate(_LOWER)), bytes(i for i in range(256) if i not in _BLANKS and not (i < 128 and chr(i).isalpha())))
LETTERS = (bytes(c if chr(i).isalpha() else 32 for i, c in enumerate(_LOWER)), b"")


def _cut(df: DataFrame, keys: list[str], text: str, rule) -> DataFrame:
    """(keys, _plain, _words): the text itself if it is Latin-1, else its words by the column rule, marked off."""
    wide = F.col(text).rlike(r"[^\x00-\xFF]")
    return df.select(*keys, F.when(~wide, F.col(text)).alias("_plain"), F.when(wide, F.array_join(rule(F.col(text)), MARK)).alias("_words"))


def _tokens(batch: pa.RecordBatch, kept: tuple[bytes, bytes]):
    """The words of each row of ``_cut``; none for null.  Latin-1 is cut here, byte by byte, in a fraction of the
    regular expressions' time."""
    plain, words = (batch.column(c).to_pylist() for c in ("_plain", "_words"))
    for p, w in zip(plain, words):
        yield p.encode("latin-1").translate(*kept).decode("latin-1").split() if p is not None else w.split(MARK) if w else []


def _fields(df: DataFrame, keys: list[str]) -> str:
    return "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)


def marked_words(df: DataFrame, keys: list[str], text: str, rule=T.words, kept: tuple[bytes, bytes] = WORDS) -> DataFrame:
    """(keys, _words): each text's words by the column rule ``rule``, which on Latin-1 text gives what ``kept`` leaves."""
    def cut(batches):
        for b in batches:
            words = pa.array([MARK.join(t) for t in _tokens(b, kept)], pa.string())
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], words], names=[*keys, "_words"])

    return _cut(df, keys, text, rule).mapInArrow(cut, _fields(df, keys) + "_words string")


def word_totals(df: DataFrame, by: list[str], text: str, rule=T.words, kept: tuple[bytes, bytes] = WORDS) -> DataFrame:
    """(by, word, n): how often each word stands in the texts; counted by batch before the shuffle."""
    kinds = _fields(df, by)

    def count(batches):
        for b in batches:
            groups: dict[tuple, Counter] = {}
            for key, tokens in zip(zip(*[b.column(k).to_pylist() for k in by]) if by else repeat(()), _tokens(b, kept)):
                groups.setdefault(key, Counter()).update(tokens)
            for key, counts in groups.items():
                n = len(counts)
                yield pa.RecordBatch.from_arrays([*[pa.repeat(pa.scalar(v, b.schema.field(k).type), n) for k, v in zip(by, key)],
                                                  pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=[*by, "word", "n"])

    return _cut(df, by, text, rule).mapInArrow(count, kinds + "word string, n long").groupBy(*by, "word").agg(F.sum("n").alias("n"))


def word_counts(df: DataFrame, key: str, text: str, extra: list[str] | None = None) -> DataFrame:
    """One row per document and distinct word: the pre-aggregated form every word job starts from."""
    return (df.select(key, *(extra or []), F.explode(T.words(F.col(text))).alias("word"))
            .groupBy(key, *(extra or []), "word").agg(F.count(F.lit(1)).alias("n")))


def vocabulary(df: DataFrame, text: str) -> DataFrame:
    """Distinct words with their total frequency."""
    return word_totals(df, [], text)


GROUP, CHUNK = 16_000_000, 2_000_000        # characters of words in a group of rows, and looked at together


def grouped_words(df: DataFrame, keys: list[str], words: Column | None, together: bool = False, size: int | None = None, least: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows dealt into groups, (keys, _words, _g), and the distinct words of each group, (_g, word).

    A table of words is then met once per group and distinct word (``looked_up``), not once per token: neither
    a frequent word's rows nor what the table holds for every token cross a shuffle.  ``together``: rows with equal
    keys come into one group.  A group holds about ``size`` characters (``GROUP``), and there are ``least`` groups or more (one a core).
    ``words``: an array; None for the rows of ``marked_words``.
    """
    # tokens are cut once and written; the groups follow what was written
    cut = df.select(*keys, "_words" if words is None else F.array_join(words, MARK).alias("_words"))
    rows = settle(cut).filter(F.col("_words") != "")
    length = rows.agg(F.sum(F.length("_words"))).first()[0] or 0
    groups = max(math.ceil(length / (size or GROUP)), least or df.sparkSession.sparkContext.defaultParallelism)
    grouped = rows.withColumn("_g", F.pmod(F.xxhash64(*keys, *([] if together else ["_words"])), F.lit(groups)).cast("int"))
    return grouped, settle(grouped.select("_g", F.explode(F.split("_words", MARK)).alias("word")).distinct())


def runs(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """The number of each row's run of equal keys, from 0."""
    codes = [pc.fill_null(rows.column(k).combine_chunks().dictionary_encode().indices, -1).to_numpy() for k in keys]
    return np.cumsum(np.any([np.diff(c, prepend=c[:1]) != 0 for c in codes], axis=0))


def looked_up(grouped: DataFrame, needed: DataFrame, table: DataFrame, fn, schema: str, together: list[str] | None = None, chunk: int | None = None) -> DataFrame:
    """``fn(rows, cut, found, codes)`` per slice of a group: ``found`` holds the rows of ``table`` for the group's words,
    ``codes`` the number of each one's word, and ``cut`` is the slice's tokens (coded), their rows, and the numbers of their words
    (-1: not in the table).  Rows with equal keys of ``together`` stand behind one another in one slice."""
    found = needed.join(table, "word")

    def per_group(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        words = (right.column("word").combine_chunks() if right.num_rows else pa.array([], pa.string())).dictionary_encode()
        known, codes = words.dictionary, words.indices.to_numpy()
        if together:
            left = left.sort_by([(k, "ascending") for k in together]).combine_chunks()
        upto = np.cumsum(pc.binary_length(left.column("_words")).to_numpy().astype(np.int64)) // (chunk or CHUNK)
        if together:
            run = runs(left, together)
            upto = upto[np.searchsorted(run, run)]
        out = []
        for at in np.split(np.arange(left.num_rows), np.flatnonzero(np.diff(upto)) + 1):
            if len(at):
                rows = left.slice(int(at[0]), len(at))
                lists = pc.split_pattern(rows.column("_words").combine_chunks(), MARK)
                tokens = lists.flatten().dictionary_encode()
                places = pc.fill_null(pc.index_in(tokens.dictionary, value_set=known), -1).to_numpy().astype(np.int64)[tokens.indices.to_numpy()]
                out.append(fn(rows, (tokens, np.repeat(np.arange(len(at)), pc.list_value_length(lists).to_numpy()), places), right, codes))
        return pa.concat_tables(out)

    return grouped.groupBy("_g").cogroup(found.groupBy("_g")).applyInArrow(per_group, schema)


def summed_words(grouped: DataFrame, needed: DataFrame, key: str, table: DataFrame, width: int) -> DataFrame:
    """(key, _n, _d0, _d1, ...): number of known tokens of each key, and the sums of their ``vector`` (word, vector)."""
    kind = grouped.schema[key].dataType.simpleString()

    def sums(rows, cut, found, codes):
        _, row, place = cut
        known = place >= 0
        row, place = row[known], place[known]
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        if not len(starts):
            return pa.table({key: rows.column(key).slice(0, 0), "_n": pa.array([], pa.int64()), "_s": pa.array([], pa.list_(pa.float64()))})
        # a word may come several times, and its vector hold nulls: they count as words but add nothing
        cells = found.column("vector").combine_chunks().flatten()
        words = codes.max() + 1
        total, there = np.zeros((words, width)), np.zeros((words, width))
        np.add.at(total, codes, pc.fill_null(cells.cast(pa.float64()), 0.0).to_numpy().reshape(-1, width))
        np.add.at(there, codes, cells.is_valid().to_numpy(zero_copy_only=False).reshape(-1, width))
        added = np.add.reduceat(total[place], starts)
        n = np.add.reduceat(np.bincount(codes)[place], starts)
        none = np.add.reduceat(there[place], starts) == 0 if cells.null_count else np.zeros(added.shape, bool)
        edges = np.arange(len(starts) + 1, dtype=np.int32) * width
        return pa.table({key: rows.column(key).take(pa.array(row[starts])), "_n": pa.array(n.astype(np.int64)),
                         "_s": pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(added.ravel(), mask=none.ravel()))})

    table = table.select("word", F.array(*[F.get("vector", F.lit(i)) for i in range(width)]).alias("vector"))
    parts = looked_up(grouped, needed, table, sums, f"`{key}` {kind}, _n long, _s array<double>")
    return parts.groupBy(key).agg(F.sum("_n").alias("_n"), *[F.sum(F.col("_s")[i]).alias(f"_d{i}") for i in range(width)])


def _mapped(df: DataFrame, key: str, tokens: str, mapping: DataFrame, target: str) -> DataFrame:
    """Replace each token through a (word, target) table and put the documents together again."""
    placed = df.select(key, F.posexplode(tokens).alias("_i", "word"))
    joined = placed.join(mapping, "word", "left").select(key, "_i", F.coalesce(F.col(target), F.col("word")).alias("_w"))
    glued = joined.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_w"))), lambda x: x["_w"]).alias(tokens))
    return df.drop(tokens).join(glued, key, "left").withColumn(tokens, F.coalesce(tokens, F.array().cast("array<string>")))


def stem(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """Stem an array column; each distinct word is stemmed once."""
    stems = stem_words(df.select(F.explode(tokens).alias("word")).distinct())
    return _mapped(df, key, tokens, sized(stems), "stem")


def lemmatize(df: DataFrame, key: str, tokens: str, lemmas: DataFrame) -> DataFrame:
    """Replace tokens that the (word, lemma) table knows."""
    return _mapped(df, key, tokens, sized(lemmas), "lemma")


# --- language ------------------------------------------------------------------------------------

def _letters(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def _trigrams(words: DataFrame) -> DataFrame:
    """Each row once per character trigram (gram) of `` word ``, repeats included."""
    chars = F.split(F.concat(F.lit(" "), F.col("word"), F.lit(" ")), "")
    grams = F.transform(F.sequence(F.lit(0), F.length("word") - 1),
                        lambda i: F.concat(F.get("_ch", i), F.get("_ch", i + 1), F.get("_ch", i + 2)))
    return words.withColumn("_ch", chars).select(*words.columns, F.explode(grams).alias("gram"))


def letter_words(df: DataFrame, key: str, text: str, extra: list[str] | None = None) -> DataFrame:
    return (df.select(key, *(extra or []), F.explode(_letters(F.col(text))).alias("word"))
            .groupBy(key, *(extra or []), "word").agg(F.count(F.lit(1)).alias("n")))


def fit_language(train: DataFrame, key: str, text: str, lang: str, languages: list[str]) -> DataFrame:
    """Log probability of each trigram per language (add-one smoothing); the row with a null gram is for unseen ones."""
    by_lang = word_totals(train, [lang], text, _letters, LETTERS)
    counts = _trigrams(by_lang).groupBy("gram").agg(*[
        F.sum(F.when(F.col(lang) == l, F.col("n")).otherwise(0)).alias(f"c_{l}") for l in languages])
    counts = settle(counts)
    totals = counts.agg(F.count(F.lit(1)).alias("_v"), *[F.sum(f"c_{l}").alias(f"t_{l}") for l in languages])
    known = counts.join(F.broadcast(totals))
    logs = [F.ln((F.col(f"c_{l}") + 1) / (F.col(f"t_{l}") + F.col("_v") + 1)).alias(l) for l in languages]
    unseen = totals.select(F.lit(None).cast("string").alias("gram"),
                           *[F.ln(1 / (F.col(f"t_{l}") + F.col("_v") + 1)).alias(l) for l in languages])
    return known.select("gram", *logs).unionByName(unseen)


def detect_language(df: DataFrame, key: str, text: str, model: DataFrame, languages: list[str], name: str = "detected") -> DataFrame:
    """Most likely language per document; null for text without letters.

    Trigrams are scored once per distinct word; documents then only add up word scores.
    """
    grouped, needed = grouped_words(marked_words(df, [key], text, _letters, LETTERS), [key], None)
    grams = _trigrams(needed.select("word").distinct())
    base = F.broadcast(model.filter(F.col("gram").isNull()).select(*[F.col(l).alias(f"u_{l}") for l in languages]))
    known = sized(model.filter(F.col("gram").isNotNull()))
    scores = (grams.join(known, "gram", "left").join(base).groupBy("word").agg(*[
        F.sum(F.coalesce(F.col(l), F.col(f"u_{l}"))).alias(l) for l in languages]))
    vectors = scores.select("word", F.array(*languages).alias("vector"))
    summed = summed_words(grouped, needed, key, vectors, len(languages)).withColumnsRenamed({f"_d{i}": l for i, l in enumerate(languages)})
    best = F.array_max(F.array(*[F.struct(F.round(l, 6).alias("s"), F.lit(l).alias("l")) for l in languages]))["l"]
    return df.join(summed.select(key, best.alias(name)), key, "left")


# --- sentences and clauses -------------------------------------------------------------------------

def split_sentences(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    return df.select(*keys, F.posexplode(T.sentences(F.col(text))).alias("sentence_no", "sentence"))


def split_clauses(sentences: DataFrame, keys: list[str], min_words: int = 7) -> DataFrame:
    """Clauses with more than ``min_words`` words."""
    cut = sentences.select(*keys, "sentence_no", F.posexplode(T.clauses(F.col("sentence"))).alias("clause_no", "clause"))
    return cut.withColumn("word_count", T.word_count(F.col("clause"))).filter(F.col("word_count") > min_words)


_SENTENCE = r"[.!?]+[ \t-\r]+|\n+"
_CLAUSE = rf"[,;][ \t-\r]*| (?:{'|'.join(T.CONJUNCTIONS)}) "
_WIDE_WORD = re.compile("[^a-zA-Z\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_RULES = {str: [re.compile(r) for r in (_SENTENCE, _CLAUSE, r"[^ \t-\r]+")], bytes: [re.compile(r.encode()) for r in (_SENTENCE, _CLAUSE, r"[^ \t-\r]+")]}
_LOWERED = bytes(_LOWER)


def _clauses(text: str, min_words: int):
    """(sentence_no, clause_no, words) of the clauses of more than ``min_words`` words; Latin-1 goes byte by byte."""
    try:
        low, blank = text.encode("latin-1").translate(_LOWERED), b" "
    except UnicodeEncodeError:
        low, blank = text.lower(), " "
    sentence, clause, word = _RULES[type(low)]
    for i, s in enumerate(filter(None, (s.strip(blank) for s in sentence.split(low)))):
        for j, c in enumerate(filter(None, (c.strip(blank) for c in clause.split(s)))):
            if len(c.split() if blank == b" " else word.findall(c)) > min_words:
                yield i, j, c.translate(*WORDS).decode("ascii").split() if blank == b" " else _WIDE_WORD.sub("", c).split()


def clause_words(df: DataFrame, keys: list[str], text: str, min_words: int = 7) -> DataFrame:
    """(keys, sentence_no, clause_no, _words): the words (``T.words``) of ``split_clauses`` of ``split_sentences``, cut in one pass."""
    def cut(batches):
        for b in batches:
            found = [(row, *c) for row, t in enumerate(b.column("_text").to_pylist()) if t is not None for c in _clauses(t, min_words)]
            row, i, j, words = zip(*found) if found else ((), (), (), ())
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([*[b.column(k).take(at) for k in keys], pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array([MARK.join(w) for w in words], pa.string())], names=[*keys, "sentence_no", "clause_no", "_words"])

    return df.select(*keys, F.col(text).alias("_text")).mapInArrow(cut, _fields(df, keys) + "sentence_no int, clause_no int, _words string")


# --- embeddings ------------------------------------------------------------------------------------

def ranked_vectors(words: DataFrame, vectors: DataFrame) -> DataFrame:
    """Give the most frequent words the given vectors by rank: (word, vector)."""
    ranked = number_rows(words, [F.desc("n"), "word"], "_r")
    return ranked.join(vectors.select((F.col("vec_id") + 1).alias("_r"), F.col("embedding").alias("vector")), "_r").select("word", "vector")


def doc_embedding(df: DataFrame, key: str, text: str, vectors: DataFrame) -> DataFrame:
    """Mean vector of the known words of each document, null if it has none."""
    known = sized(vectors)
    head = known.select(F.size("vector")).first()
    if head is None:
        return df.select(key, F.lit(None).cast("array<double>").alias("embedding"))
    grouped, needed = grouped_words(marked_words(df, [key], text), [key], None)
    added = summed_words(grouped, needed, key, known, head[0])
    mean = F.array(*[F.col(f"_d{i}") / F.col("_n") for i in range(head[0])])
    return df.select(key).join(added.select(key, mean.alias("embedding")), key, "left")


TRAINED, RATE = 4_000_000, 0.025             # characters of words that one task trains over, and the first rate
PART = 16_000_000                            # bytes of the vectors that lie together


def _start(hashed: np.ndarray, size: int) -> np.ndarray:
    """The first vectors of words: ``(pmod(xxhash64(word, i), 1000003) / 1000003 - 0.5) / size``, from ``xxhash64(word)``."""
    u = lambda x: np.uint64(x)
    with np.errstate(over="ignore"):
        h = (hashed.view(np.uint64) + u(0x27D4EB2F165667C5) + u(4))[:, None] ^ (np.arange(size, dtype=np.uint64) * u(0x9E3779B185EBCA87))
        h = ((h << u(23)) | (h >> u(41))) * u(0xC2B2AE3D27D4EB4F) + u(0x165667B19E3779F9)
        h = (h ^ (h >> u(33))) * u(0xC2B2AE3D27D4EB4F)
        h = (h ^ (h >> u(29))) * u(0x165667B19E3779F9)
        h ^= h >> u(32)
    return ((np.mod(h.view(np.int64), 1_000_003) / 1_000_003 - 0.5) / size).astype(np.float32)


def train_word_vectors(df: DataFrame, text: str, size: int = 300, window: int = 30, min_count: int = 1, epochs: int = 5) -> DataFrame:
    """(word, vector): skip-gram vectors with negative samples of all words met ``min_count`` times or more.

    The vectors lie in parts of about ``PART`` bytes, by hash of the word.  In every epoch each group of texts gets the vectors
    of its own words, trains over its texts, and a word's new vectors are the mean of what its groups made of them,
    weighted by how often it stands there.  Which words a part and a group share is worked out once, so what goes to and fro
    is one block of numbers for each part and group.  Neither the driver nor a task ever holds the whole vocabulary.
    """
    spark = df.sparkSession
    cores, empty = spark.sparkContext.defaultParallelism, spark.createDataFrame([], "word string, vector array<double>")
    numbered = df.select(F.monotonically_increasing_id().alias("_at"), F.col(text).alias("_text"))
    rows = settle(marked_words(numbered, ["_at"], "_text")).filter(F.col("_words") != "")
    length = rows.agg(F.sum(F.length("_words"))).first()[0] or 0
    groups = math.ceil(length / TRAINED)
    if groups > 1:                          # every core trains over as many groups
        groups = math.ceil(groups / (1.25 * cores)) * cores
    if not groups:
        return empty
    grouped = rows.withColumn("_g", F.pmod(F.xxhash64("_at", "_words"), F.lit(groups)).cast("int"))
    pairs = settle(grouped.select("_g", F.explode(F.split("_words", MARK)).alias("word")).groupBy("_g", "word").agg(F.count(F.lit(1)).alias("n")))
    parts = max(math.ceil(pairs.agg(F.approx_count_distinct("word")).first()[0] * 8 * size / PART), cores if groups > 1 else 1)
    route = "to int, frm int, blob binary"

    def route_batch(to: int, frm: int, blob: bytes):
        return pa.RecordBatch.from_arrays([pa.array([to], pa.int32()), pa.array([frm], pa.int32()), pa.array([blob], pa.binary())], names=["to", "frm", "blob"])

    def routed(batches):
        for b in batches:
            yield from zip(b.column("to").to_pylist(), b.column("frm").to_pylist(), b.column("blob").to_pylist())

    def shared(batches):
        """What a part knows: its words in order, and for each group their places and counts; and for the groups, their words."""
        seen = [b for b in batches if b.num_rows]
        if not seen:
            return
        t = pa.Table.from_batches(seen).combine_chunks()
        coded = t.column("word").combine_chunks().dictionary_encode()
        n, g, part = t.column("n").to_numpy(), t.column("_g").to_numpy(), t.column("p")[0].as_py()
        code = coded.indices.to_numpy()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        order = order[np.bincount(code, n, len(order))[order] >= min_count]
        place = np.full(len(coded.dictionary), -1)
        place[order] = np.arange(len(order))
        words, hashed = coded.dictionary.take(pa.array(order)), np.empty(len(coded.dictionary), np.int64)
        hashed[code] = t.column("h").to_numpy()
        links, at = {}, place[code]
        for one in np.unique(g):
            mine = np.flatnonzero((g == one) & (at >= 0))
            mine = mine[np.argsort(at[mine])]
            if len(mine):
                links[int(one)] = at[mine].astype(np.int32), n[mine]
                yield route_batch(int(one), part, MARK.join(words.take(pa.array(at[mine])).to_pylist()).encode())
        if len(order):
            yield route_batch(-1, part, pickle.dumps((MARK.join(words.to_pylist()), links, hashed[order])))

    known = pairs.withColumn("h", F.xxhash64("word")).withColumn("p", F.pmod("h", F.lit(parts)).cast("int"))
    made = settle(known.repartitionById(parts, F.col("p")).mapInArrow(shared, route))

    def coded(batches):
        """What a group knows: its tokens by number, their texts, and for each part the numbers of its words."""
        held, texts = [], []
        for b in batches:
            for to, frm, blob, at, words in zip(*(b.column(c).to_pylist() for c in ("to", "frm", "blob", "_at", "_words"))):
                if blob is None:
                    texts.append((at, words))
                else:
                    held.append((frm, blob.decode().split(MARK)))
        if not held:
            return
        names = pa.array([w for _, some in held for w in some], pa.string())
        order = pc.sort_indices(names).to_numpy()
        nth = np.empty(len(order), np.int64)
        nth[order] = np.arange(len(order))
        edges = np.cumsum([0, *(len(some) for _, some in held)])
        places = {part: nth[lo:hi].astype(np.int32) for (part, _), lo, hi in zip(held, edges, edges[1:])}
        lists = pc.split_pattern(pa.array([w for _, w in sorted(texts)], pa.string()), MARK)
        tokens = lists.flatten().dictionary_encode()
        code = pc.fill_null(pc.index_in(tokens.dictionary, value_set=names.take(pa.array(order))), -1).to_numpy()[tokens.indices.to_numpy()]
        row = np.repeat(np.arange(len(texts), dtype=np.int32), pc.list_value_length(lists).to_numpy())
        yield route_batch(to, -1, pickle.dumps((code[code >= 0].astype(np.int32), row[code >= 0], places)))

    blank = lambda name, kind: F.lit(None).cast(kind).alias(name)
    sent = made.filter(F.col("to") >= 0).select("to", "frm", "blob", blank("_at", "long"), blank("_words", "string"))
    told = sent.unionByName(grouped.select(F.col("_g").alias("to"), F.lit(-1).alias("frm"), blank("blob", "binary"), "_at", "_words"))
    texts = settle(told.repartitionById(groups, F.col("to")).mapInArrow(coded, route))
    links = made.filter(F.col("to") < 0).select(F.col("frm").alias("to"), F.lit(-1).alias("frm"), "blob")

    def out(part: int, known: bytes, vectors: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([known], pa.binary()), pa.array([vectors.tobytes()], pa.binary())], names=["p", "known", "vectors"])

    def first(batches):
        for part, _, known in routed(batches):
            start = _start(pickle.loads(known)[2], size)
            yield out(part, known, np.concatenate([start, np.zeros_like(start)], 1))

    def given(batches):
        """The vectors of a part's words, to each group that has them."""
        for b in batches:
            for part, known, vectors in zip(*(b.column(c).to_pylist() for c in ("p", "known", "vectors"))):
                table = np.frombuffer(vectors, np.float32).reshape(-1, 2 * size)
                for g, (at, _) in pickle.loads(known)[1].items():
                    yield route_batch(g, part, table[at].tobytes())

    def trained(epoch: int):
        rates = RATE * (1 - epoch / epochs), RATE * (1 - (epoch + 1) / epochs) + RATE / 250

        def fn(batches):
            held, mine = [], None
            for g, part, blob in routed(batches):
                if part < 0:
                    mine = g, *pickle.loads(blob)
                else:
                    held.append((part, blob))
            if mine is None:
                return
            g, words, row, places = mine
            inner, outer = (np.empty((sum(map(len, places.values())), size), np.float32) for _ in range(2))
            while held:
                part, blob = held.pop()
                both = np.frombuffer(blob, np.float32).reshape(-1, 2 * size)
                inner[places[part]], outer[places[part]] = both[:, :size], both[:, size:]
            if len(words):
                skipgram.train(words.astype(np.int64), row, inner, outer, window, rates, np.random.default_rng([42, epoch, g]))
            for part, at in places.items():
                yield route_batch(part, g, np.concatenate([inner[at], outer[at]], 1).tobytes())

        return fn

    def mean(batches):
        """The mean of what the groups made of a part's words, weighted by their tokens."""
        held, known = {}, None
        for part, g, blob in routed(batches):
            if g < 0:
                known = blob
            else:
                held[g] = blob
        if known is None:
            return
        words, links, hashed = pickle.loads(known)
        total, weight = np.zeros((len(hashed), 2 * size)), np.zeros(len(hashed))
        for g in sorted(held):
            at, n = links[g]
            total[at] += n[:, None] * np.frombuffer(held.pop(g), np.float32).reshape(-1, 2 * size)
            weight[at] += n
        yield out(part, known, (total / weight[:, None]).astype(np.float32))

    def listed(batches):
        for b in batches:
            for known, vectors in zip(b.column("known").to_pylist(), b.column("vectors").to_pylist()):
                words, table = pickle.loads(known)[0].split(MARK), np.frombuffer(vectors, np.float32).reshape(-1, 2 * size)[:, :size]
                for lo in range(0, len(words), 2_000):
                    some = np.ascontiguousarray(table[lo:lo + 2_000])
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * size), pa.array(some.ravel(), pa.float32()))
                    yield pa.RecordBatch.from_arrays([pa.array(words[lo:lo + 2_000], pa.string()), lists], names=["word", "vector"])

    state = "p int, known binary, vectors binary"
    # blocks are large, so few are looked at together; an epoch's shuffles and the table before it are not needed again
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "4", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        before, table = None, settle(links.mapInArrow(first, state))
        for epoch in range(epochs):
            given_out = table.mapInArrow(given, route).unionByName(texts).repartitionById(groups, F.col("to"))
            made_of = given_out.mapInArrow(trained(epoch), route).unionByName(links).repartitionById(parts, F.col("to"))
            before, table = table, settle(made_of.mapInArrow(mean, state))
            for file in before.inputFiles()[:1]:
                remove(spark, file.rsplit("/", 1)[0])
    return table.mapInArrow(listed, "word string, vector array<float>").select("word", F.col("vector").cast("array<double>").alias("vector"))


def word_similarity(vectors: DataFrame, a: str, b: str) -> DataFrame:
    both = vectors.filter(F.col("word").isin(a, b)).groupBy().agg(
        F.max(F.when(F.col("word") == a, F.col("vector"))).alias("va"), F.max(F.when(F.col("word") == b, F.col("vector"))).alias("vb"))
    return both.select(F.lit(a).alias("a"), F.lit(b).alias("b"), T.cosine(F.col("va"), F.col("vb")).alias("similarity"))


def count_vectorize(df: DataFrame, key: str, text: str, size: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Vocabulary by total frequency and the binary bag of words in long form; ``size`` keeps the most frequent words only."""
    words = vocabulary(df, text)
    if size is None:
        return words, word_counts(df, key, text).select(key, "word")
    vocab = top_k(words, [F.desc("n"), "word"], size)
    return vocab, word_counts(df, key, text).select(key, "word").join(sized(vocab.select("word")), "word", "left_semi")
