"""Packing by power-of-two decomposition.

A document of L tokens (its ids and one end token) is cut into pieces whose lengths are powers of two:
as many of the greatest length as fit, then the binary digits of the rest.  Every piece is a sequence of
its own, bucketed with the pieces of its length, so no sequence crosses documents and none is padded.

Defined cases: a null text is an empty one and gives the end token alone; copies of a document are packed
each on its own; an empty table gives no rows; extra columns are ignored; long texts are encoded run by
run between white space, which gives the ids of the whole text.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from brambling.llm.common import col, settle
from brambling.operators.ordering import running_sums

MAX_LENGTH = 4096
END_ID = 2
SLICE_BYTES = 2_000_000    # text encoded at a time
MEMORY = 32_000_000        # bytes a worker keeps of what it has encoded
_ENTRY = 16                # bytes of a remembered text besides its letters and ids
_KEPT: dict[int, "Encoder"] = {}


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte as itself if printable, else as the next letter from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in table]
    return table | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _gather(flat: np.ndarray, size: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """The lists numbered ``pick``, one behind the other; list i has ``size[i]`` elements of ``flat``."""
    many, last = size[pick], np.cumsum(size)
    upto = np.cumsum(many)
    return flat[np.repeat((last - size)[pick] - (upto - many), many) + np.arange(upto[-1] if len(upto) else 0)]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(size, elements) of several lists."""
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    return size, np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum()))


class _Memory:
    """Ids of texts met lately in Arrow and numpy arrays of at most ``limit`` bytes; what was met longest ago goes first."""

    def __init__(self, limit: int):
        self.limit = limit
        self.texts, self.size, self.flat = pa.array([], pa.large_string()), np.empty(0, np.int64), np.empty(0, np.uint32)

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of the distinct ``texts``, -1 where one is not known, and the places of the other texts held.

        The texts held are looked up among the few that are asked for, so that no table of all held is made.
        """
        asked = pc.fill_null(pc.index_in(self.texts, value_set=texts), -1).to_numpy(zero_copy_only=False)
        held, at = asked >= 0, np.full(len(texts), -1, np.int64)
        at[asked[held]] = np.flatnonzero(held)
        return at, np.flatnonzero(~held)

    def renew(self, texts: pa.Array, size: np.ndarray, flat: np.ndarray, rest: np.ndarray) -> None:
        """Put these in front of the ``rest``."""
        all_ = pa.concat_arrays([texts, self.texts.take(pa.array(rest))])
        sizes, ids = np.concatenate([size, self.size[rest]]), np.concatenate([flat, _gather(self.flat, self.size, rest)])
        held = np.cumsum(pc.binary_length(all_).to_numpy(zero_copy_only=False) + 4 * sizes + _ENTRY)
        keep = int(np.searchsorted(held, self.limit, "right"))
        # copied, so that nothing of what goes is held on to
        self.texts, self.size = pa.concat_arrays([all_.slice(0, keep)]), sizes[:keep].copy()
        self.flat = ids[:int(self.size.sum())].copy()


class Encoder:
    """Ids of many texts, with a memory of the runs between white space.

    The vocabularies meant here drop white space and never join across it, so the ids of a text are the ids
    of its runs in a row.  A run is normalized by the tokenizer, cut by the pattern that the tokenizer's file
    states, and each part is encoded once by its model.  Runs with an added token or with other white space,
    and all runs of a tokenizer of another make, go through the whole tokenizer.
    """

    def __init__(self, spec: str, memory: int = MEMORY):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pattern = self._pattern(json.loads(spec))
        self.letters = _byte_letters()
        self.runs, self.parts = _Memory(memory // 2), _Memory(memory // 2)

    @classmethod
    def of_worker(cls, spec: str) -> "Encoder":
        """The one encoder that a Python worker keeps over its tasks."""
        key = hash(spec)
        if key not in _KEPT:
            _KEPT.clear()
            _KEPT[key] = cls(spec)
        return _KEPT[key]

    @staticmethod
    def _pattern(spec: dict):
        """The cutting pattern, if the file holds one pattern whose matches are kept, and byte letters."""
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        if len(steps) != 2 or not {"Regex"} == set(steps[0].get("pattern", {})):
            return None
        cut = steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        level = steps[1]["type"] == "ByteLevel" and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
        return regex.compile(steps[0]["pattern"]["Regex"]) if cut and level else None

    def _part(self, part: str) -> list[int]:
        shown = part if part.isascii() and part.isprintable() else "".join(map(self.letters.__getitem__, part.encode()))
        return [t.id for t in self.model.tokenize(shown)]

    def _encoded(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(size, ids) of parts that come out of the pattern."""
        words = pa.array(parts, pa.large_string()).dictionary_encode()
        return self._known(self.parts, words, lambda new: _flat(list(map(self._part, new))))

    def _known(self, memory: _Memory, words: pa.DictionaryArray, make) -> tuple[np.ndarray, np.ndarray]:
        """(size, ids) of every word; those that the memory does not hold are made."""
        distinct, codes = words.dictionary, words.indices.to_numpy(zero_copy_only=False)
        at, rest = memory.find(distinct)
        new = np.flatnonzero(at < 0)
        made = make(distinct.take(pa.array(new)).to_pylist()) if len(new) else _flat([])
        size, flat = (np.concatenate(pair) for pair in zip((memory.size, memory.flat), made))
        at[new] = len(memory.size) + np.arange(len(new))
        size, flat = size[at], _gather(flat, size, at)
        memory.renew(distinct, size, flat, rest)
        return size[codes], _gather(flat, size, codes)

    def _whole(self, run: str) -> list[int]:
        return self.tokenizer.encode(run, add_special_tokens=False).ids

    def _cut(self, runs: list[str]) -> tuple[list[str], np.ndarray] | None:
        """The parts of many runs in a row and how many each run has; None if they cannot be cut together."""
        joined = " ".join(runs)
        if self.pattern is None or any(a in joined for a in self.added):
            return None
        norm = self.tokenizer.normalizer
        shown = norm.normalize_str(joined) if norm else joined
        pieces = shown.split(" ")
        if len(pieces) != len(runs) or len(joined.split()) != len(runs) or len(shown.split()) != len(runs):
            return None
        parts = self.pattern.findall(shown)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        edges = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        # the parts make up the runs to the last letter, and none reaches over an edge
        upto = np.searchsorted(ends, edges)
        if not len(parts) or ends[-1] != edges[-1] or not np.array_equal(ends[upto], edges):
            return None
        return parts, np.diff(upto + 1, prepend=0)

    def _learn(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(size, ids) of the runs."""
        parts, count, odd = [], [], {}
        waiting = [(at, runs[at:at + 4_096]) for at in range(0, len(runs), 4_096)][::-1]
        while waiting:
            at, group = waiting.pop()
            cut = self._cut(group)
            if cut is not None:
                parts += cut[0]
                count.append(cut[1])
            elif len(group) > 1:
                half = len(group) // 2
                waiting += [(at + half, group[half:]), (at, group[:half])]
            else:
                odd[at] = self._whole(group[0]) if group[0] else []
                count.append(np.zeros(1, np.int64))
        size, ids = self._encoded(parts) if parts else (np.empty(0, np.int64), np.empty(0, np.uint32))
        upto = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(np.concatenate(count))])]
        if not odd:
            return np.diff(upto), ids
        return _flat([odd[i] if i in odd else ids[lo:hi].tolist() for i, (lo, hi) in enumerate(zip(upto[:-1].tolist(), upto[1:].tolist()))])

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the number of ids of each text."""
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        size, ids = self._known(self.runs, lists.flatten().dictionary_encode(), self._learn)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        return ids, np.diff(np.concatenate([[0], np.cumsum(size)])[bounds - bounds[0]])

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, four bytes each."""
        ids, count = self.encode_all(texts)
        upto = np.concatenate([[0], np.cumsum(count)]).tolist()
        for lo, hi in zip(upto[:-1], upto[1:]):
            yield ids[lo:hi].tobytes()


def binary_lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Powers of two that sum to ``n``, greatest first, none above ``longest``."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(longest.bit_length() - 2, -1, -1) if rest >> k & 1]


def _slices(batch: pa.RecordBatch, limit: int) -> Iterable[pa.RecordBatch]:
    """Rows of about ``limit`` bytes of text each."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + limit, "right"))
        upto = min(max(upto, at + 1), batch.num_rows)
        yield batch.slice(at, upto - at)
        at = upto


def _with_end(ids: np.ndarray, count: np.ndarray, end_id: int) -> np.ndarray:
    """The ids of several texts with an end token behind each."""
    out = np.full(len(ids) + len(count), end_id, "<u4")
    out[np.arange(len(ids)) + np.repeat(np.arange(len(count)), count)] = ids
    return out


def decompose(docs: DataFrame, tokenizer: str, longest: int = MAX_LENGTH, end_id: int = END_ID, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, ids, part, rank) of every document; ``tokenizer`` is the file's text.

    ``longest`` is a power of two.  ``ids_crc32`` is over the little-endian 32-bit ids.  ``part`` is the task that cut a
    piece and ``rank`` the piece's number, from 0, among those of its length there.
    """
    if longest & (longest - 1):
        raise ValueError("the greatest length is a power of two")
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    kind = docs.select(col(id).alias("doc_id")).schema[0].dataType
    given = docs.select(col(id).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))
    names = ["start", "length", "ids_crc32", "doc_tokens"]

    def cut(batches):
        encoder, here, ranks = Encoder.of_worker(shared.value), TaskContext.get().partitionId(), {}
        for batch in batches:
            for part in _slices(batch, SLICE_BYTES):
                ids, count = encoder.encode_all(part.column(1))
                ids = _with_end(ids, count, end_id)
                owner, rows, raw, first = [], [], memoryview(ids.tobytes()), 0
                for i, n_ids in enumerate((count + 1).tolist()):
                    at = 0
                    for n in binary_lengths(n_ids, longest):
                        rank = ranks[n] = ranks.get(n, -1) + 1
                        owner.append(i)
                        rows.append((at, n, zlib.crc32(raw[4 * (first + at):4 * (first + at + n)]), n_ids, rank))
                        at += n
                    first += n_ids
                numbers = np.array(rows, np.int64).reshape(-1, 5)
                ends = pa.array(np.concatenate([[0], np.cumsum(numbers[:, 1])]).astype(np.int32))
                columns = [part.column(0).take(pa.array(owner, pa.int64())), *[pa.array(numbers[:, k]) for k in range(4)],
                           pa.ListArray.from_arrays(ends, pa.array(ids.view("<i4"))), pa.array(np.full(len(numbers), here, np.int32)), pa.array(numbers[:, 4])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names, "ids", "part", "rank"])
        pa.default_memory_pool().release_unused()       # the worker may stand idle while later steps need its memory

    schema = f"doc_id {kind.simpleString()}, " + ", ".join(f"{n} long" for n in names) + ", ids array<int>, part int, rank long"
    return given.mapInArrow(cut, schema)


def pack(pieces: DataFrame) -> DataFrame:
    """Give every piece of ``decompose`` its sequence: numbers from 0, pieces of one length together, longest first.

    A sequence is one piece, so ``offset`` is 0 and no place is padded.  The pieces are written once, with their ids,
    and moved nowhere: how many of each length a task has cut, a few numbers a task, gives the number at which its
    pieces of that length begin, and a piece's rank does the rest.
    """
    written = settle(pieces)
    counts = written.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    begins = settle(running_sums(counts, [F.desc("length"), "part"], {"upto": F.col("n")}).select("length", "part", (F.col("upto") - F.col("n")).alias("begin")))
    kept = [c for c in written.columns if c not in ("part", "rank")]
    return written.join(begins, ["length", "part"]).select(*kept, (F.col("begin") + F.col("rank")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def digest(packed: DataFrame) -> DataFrame:
    """``ids_crc32`` anew from the ids of each sequence, without the ids."""
    names = [c for c in packed.columns if c != "ids"]

    def sums(batches):
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            values, ends = memoryview(lists.flatten().to_numpy().astype("<u4").tobytes()), lists.offsets.to_numpy().astype(np.int64)
            ends = (4 * (ends - ends[0])).tolist()
            crc = pa.array([zlib.crc32(values[lo:hi]) for lo, hi in zip(ends[:-1], ends[1:])], pa.int64())
            yield pa.RecordBatch.from_arrays([crc if c == "ids_crc32" else batch.column(batch.schema.get_field_index(c)) for c in names], names=names)

    return packed.mapInArrow(sums, packed.select(*names).schema)
