"""A compiler for chat templates: text -> syntax tree -> folded tree -> Python closures.

The language has text, ``{{ expression }}``, ``{% for x in y %}``, ``{% if %}``/``elif``/``else``, ``{% set x = e %}``
and ``{% generation %}`` ... ``{% endgeneration %}``, which marks what a model is to learn.  Expressions are literals,
names, ``a.b`` on mappings, ``==  !=  and  or  not  ~`` (joining texts) and the filters of ``FILTERS``.  Nothing else can be
reached: no calls, no attributes of Python objects, no subscripts.  Constant parts are folded before closures are made.
A closure yields (text, marked) pieces and reads a loop's values one at a time, so a conversation is never held whole.

Conversations are sorted within partitions and rendered turn by turn into chunks of about ``CHUNK`` characters; a chunk
carries the marked spans.  ``parse`` undoes it from the text alone: unescaped control strings part the turns, escaped ones
belong to the texts.

Defined cases: null roles and texts are empty; turns are in order of turn (null first), role and text, repeated
rows are turns of their own; rows with a null id form one conversation; an empty table gives no rows; extra columns are
ignored; a conversation of any length passes through one task as a stream.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from brambling.llm.common import col

OPEN, MIDDLE, CLOSE = "### ", ":\n", "</turn>\n"
#: Marks turns; what a control string begins with is escaped in texts and roles.
CHAT = ("{% for turn in turns %}{{ '### ' ~ turn.role | escape }}{{ ':' }}\n"
        "{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}{% else %}{{ turn.text | escape }}{% endif %}"
        "{{ '</turn>' ~ '\n' }}{% endfor %}")
CHUNK = 1_000_000
MAX_TEMPLATE, MAX_DEPTH = 65_536, 40
_ESCAPED = str.maketrans({c: "\\" + c for c in "\\#<:"})
FILTERS: dict[str, Callable[[str], str]] = {
    "escape": lambda s: s.translate(_ESCAPED), "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    pass


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


# ---- syntax tree ----

@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    path: tuple[str, ...]


@dataclass(frozen=True)
class Apply:
    """An operator or filter over expressions."""
    op: str
    args: tuple


@dataclass(frozen=True)
class Out:
    value: object


@dataclass(frozen=True)
class Loop:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Branch:
    cases: tuple     # of (condition, body)


@dataclass(frozen=True)
class Assign:
    name: str
    value: object


@dataclass(frozen=True)
class Marked:
    body: tuple


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z][A-Za-z0-9_]*)|(==|!=|[.|~()]))""", re.S)


class _Expression:
    """Precedence climbing over the tokens of one expression."""

    LEVELS = (("or",), ("and",), ("not",), ("==", "!="), ("~",))

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            self.tokens.append(m.group(m.lastindex) if m.lastindex != 1 else ("text", re.sub(r"\\(.)", r"\1", m.group(1)[1:-1], flags=re.S)))
            at = m.end()
        self.at = 0

    def peek(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def take(self):
        token = self.peek()
        self.at += 1
        return token

    def whole(self):
        tree = self.level(0, 0)
        if self.peek() is not None:
            raise TemplateError(f"unexpected {self.peek()!r}")
        return tree

    def level(self, k: int, depth: int):
        if depth > MAX_DEPTH:
            raise TemplateError("nested too deeply")
        if k == len(self.LEVELS):
            return self.filtered(depth)
        if self.LEVELS[k] == ("not",):
            if self.peek() == "not":
                self.take()
                return Apply("not", (self.level(k, depth + 1),))
            return self.level(k + 1, depth)
        left = self.level(k + 1, depth)
        while self.peek() in self.LEVELS[k]:
            op = self.take()
            left = Apply(op, (left, self.level(k + 1, depth)))
        return left

    def filtered(self, depth: int):
        tree = self.atom(depth)
        while self.peek() == "|":
            self.take()
            name = self.take()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = Apply(name, (tree,))
        return tree

    def atom(self, depth: int):
        token = self.take()
        if isinstance(token, tuple):
            return Const(token[1])
        if token == "(":
            tree = self.level(0, depth + 1)
            if self.take() != ")":
                raise TemplateError("a bracket is not closed")
            return tree
        if token is None or not re.match(r"\w", token):
            raise TemplateError(f"unexpected {token!r}")
        if token.isdigit():
            return Const(int(token))
        if token in ("true", "false"):
            return Const(token == "true")
        path = [token]
        while self.peek() == ".":
            self.take()
            path.append(self.take())
            if not isinstance(path[-1], str) or not re.match(r"[A-Za-z]", path[-1]):
                raise TemplateError("a field name is missing")
        return Name(tuple(path))


def parse_template(source: str) -> tuple:
    """The tree of a template."""
    if len(source) > MAX_TEMPLATE:
        raise TemplateError("the template is too long")
    pieces, at = [], 0
    for m in _TAG.finditer(source):
        if m.start() > at:
            pieces.append(("text", source[at:m.start()]))
        if m.group(1) is not None:
            pieces.append(("out", m.group(1)))
        elif m.group(2) is not None:
            pieces.append(("tag", m.group(2).strip()))
        at = m.end()
    if at < len(source):
        pieces.append(("text", source[at:]))
    place = 0

    def body(stops: tuple[str, ...], depth: int) -> tuple[tuple, str]:
        nonlocal place
        if depth > MAX_DEPTH:
            raise TemplateError("nested too deeply")
        out = []
        while place < len(pieces):
            kind, value = pieces[place]
            place += 1
            if kind == "text":
                out.append(Out(Const(value)))
                continue
            if kind == "out":
                out.append(Out(_Expression(value).whole()))
                continue
            word, _, rest = value.partition(" ")
            if word in stops:
                return tuple(out), value
            if word == "for":
                m = re.fullmatch(r"\s*([A-Za-z]\w*)\s+in\s+(.+)", rest, re.S)
                if not m:
                    raise TemplateError("for NAME in VALUE is expected")
                inner, _ = body(("endfor",), depth + 1)
                out.append(Loop(m.group(1), _Expression(m.group(2)).whole(), inner))
            elif word == "if":
                cases, condition = [], _Expression(rest).whole()
                while True:
                    inner, stop = body(("elif", "else", "endif"), depth + 1)
                    cases.append((condition, inner))
                    if stop == "endif":
                        break
                    condition = Const(True) if stop == "else" else _Expression(stop.partition(" ")[2]).whole()
                out.append(Branch(tuple(cases)))
            elif word == "set":
                m = re.fullmatch(r"\s*([A-Za-z]\w*)\s*=\s*(.+)", rest, re.S)
                if not m:
                    raise TemplateError("set NAME = VALUE is expected")
                out.append(Assign(m.group(1), _Expression(m.group(2)).whole()))
            elif word == "generation":
                inner, _ = body(("endgeneration",), depth + 1)
                out.append(Marked(inner))
            else:
                raise TemplateError(f"no tag {word!r}")
        if stops:
            raise TemplateError(f"{stops[-1]} is missing")
        return tuple(out), ""

    return body((), 0)[0]


# ---- folding ----

def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


_APPLY: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "~": lambda a, b: _text(a) + _text(b),
    "and": lambda a, b: b if a else a, "or": lambda a, b: a if a else b, "not": lambda a: not a,
    **{name: (lambda f: lambda a: f(_text(a)))(f) for name, f in FILTERS.items()}}


def _fold_value(e):
    if not isinstance(e, Apply):
        return e
    args = tuple(map(_fold_value, e.args))
    return Const(_APPLY[e.op](*(a.value for a in args))) if all(isinstance(a, Const) for a in args) else Apply(e.op, args)


def fold(body: tuple) -> tuple:
    """Compute what is constant, drop branches that cannot be taken, join neighbouring texts."""
    out: list = []
    for node in body:
        if isinstance(node, Out):
            value = _fold_value(node.value)
            if isinstance(value, Const):
                value = Const(_text(value.value))
                if out and isinstance(out[-1], Out) and isinstance(out[-1].value, Const):
                    out[-1] = Out(Const(out[-1].value.value + value.value))
                    continue
            out.append(Out(value))
        elif isinstance(node, Loop):
            out.append(Loop(node.name, _fold_value(node.over), fold(node.body)))
        elif isinstance(node, Marked):
            out.append(Marked(fold(node.body)))
        elif isinstance(node, Assign):
            out.append(Assign(node.name, _fold_value(node.value)))
        else:
            cases = []
            for condition, inner in node.cases:
                condition = _fold_value(condition)
                if isinstance(condition, Const) and not condition.value:
                    continue
                cases.append((condition, fold(inner)))
                if isinstance(condition, Const):
                    break
            if cases and isinstance(cases[0][0], Const):
                out.extend(cases[0][1])
            elif cases:
                out.append(Branch(tuple(cases)))
    return tuple(out)


# ---- closures ----

Piece = tuple[str, bool]


def _value(e) -> Callable[[dict], object]:
    if isinstance(e, Const):
        constant = e.value
        return lambda env: constant
    if isinstance(e, Name):
        head, rest = e.path[0], e.path[1:]

        def look(env):
            at = env.get(head)
            for field in rest:
                at = at.get(field) if isinstance(at, dict) else None
            return at
        return look
    args = [_value(a) for a in e.args]
    if e.op in ("and", "or"):
        left, right, stop = *args, e.op == "or"

        def lazy(env):
            a = left(env)
            return a if bool(a) == stop else right(env)
        return lazy
    f = _APPLY[e.op]
    if len(args) == 1:
        only, = args
        return lambda env: f(only(env))
    left, right = args
    return lambda env: f(left(env), right(env))


def _closure(body: tuple, marked: bool = False) -> Callable[[dict], Iterator[Piece]]:
    parts = [_node(n, marked) for n in body]

    def run(env):
        for part in parts:
            yield from part(env)
    return run


def _node(node, marked: bool) -> Callable[[dict], Iterator[Piece]]:
    if isinstance(node, Out):
        value = _value(node.value)
        return lambda env: iter(((_text(value(env)), marked),))
    if isinstance(node, Marked):
        return _closure(node.body, True)
    if isinstance(node, Assign):
        name, value = node.name, _value(node.value)

        def assign(env):
            env[name] = value(env)
            return iter(())
        return assign
    if isinstance(node, Loop):
        name, over, inner = node.name, _value(node.over), _closure(node.body, marked)

        def loop(env):
            for item in over(env) or ():
                yield from inner(env | {name: item})
        return loop
    cases = [(_value(c), _closure(b, marked)) for c, b in node.cases]

    def branch(env):
        for condition, inner in cases:
            if condition(env):
                return inner(env)
        return iter(())
    return branch


def compile_template(source: str = CHAT) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from turns (mappings with role and text) to pieces (text, marked)."""
    run = _closure(fold(parse_template(source)))
    return lambda turns: run({"turns": turns})


# ---- tables ----

FORMATTED = "conv_id {id}, chunk long, text string, spans array<array<long>>"


def render(conversations: DataFrame, source: str = CHAT, chunk: int = CHUNK, id: str = "conv_id") -> DataFrame:
    """(conv_id, chunk, text, spans): the formatted conversations, long ones in several chunks in order.

    ``spans`` are the marked places [start, end) in the chunk.  Chunks end between pieces, and the chunks of a
    conversation stay in one partition, in order.
    """
    parse_template(source)   # complain here, not in a task
    given = conversations.select(col(id).alias("conv_id"), col("turn").alias("turn"), F.coalesce(col("role"), F.lit("")).alias("role"),
                                 F.coalesce(col("text"), F.lit("")).alias("text"))
    kind = given.schema["conv_id"].dataType.simpleString()
    placed = given.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def write(batches):
        run = compile_template(source)
        for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
            text, spans, size, k = [], [], 0, 0
            for piece, marked in run({"role": r, "text": t} for _, r, t in rows):
                if marked and piece:
                    if spans and spans[-1][1] == size:
                        spans[-1][1] = size + len(piece)
                    else:
                        spans.append([size, size + len(piece)])
                text.append(piece)
                size += len(piece)
                if size >= chunk:
                    yield conv, k, "".join(text), spans
                    text, spans, size, k = [], [], 0, k + 1
            if text or not k:
                yield conv, k, "".join(text), spans

    arrow = to_arrow_schema(T.StructType([given.schema["conv_id"], *T.StructType.fromDDL("chunk long, text string, spans array<array<long>>")]))

    def gathered(batches):
        """One batch for many small conversations."""
        held, size = [], 0
        for row in write(batches):
            held.append(row)
            size += len(row[2])
            if size >= chunk:
                yield _batch(held, arrow)
                held, size = [], 0
        if held:
            yield _batch(held, arrow)

    return placed.mapInArrow(gathered, FORMATTED.format(id=kind))


def _rows(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], names=schema.names)


_CONTROL = re.compile(r"\\.|(### )|(:\n)|(</turn>\n)", re.S)


def parse(chunks: Iterable[str]) -> Iterator[tuple[str, str]]:
    """The (role, text) of every turn, read from a formatted conversation that comes in pieces."""
    held = ""
    for piece in chunks:
        held += piece
        begin, role, role_at = 0, None, 0
        for m in _CONTROL.finditer(held):
            if m.group(1) and role is None:
                role_at = m.end()
            elif m.group(2) and role is None:
                role, text_at = unescape(held[role_at:m.start()]), m.end()
            elif m.group(3) and role is not None:
                yield role, unescape(held[text_at:m.start()])
                begin, role = m.end(), None
        held = held[begin:]
    if held:
        raise ValueError("a turn is not closed")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of the turns and of the marked text, from the formatted text and its spans alone."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def digest(batches):
        out = []
        for conv, group in groupby(_rows(batches), key=lambda r: r[0]):
            n, loss_chars, chars = 0, 0, 0
            turns, loss = hashlib.sha256(), hashlib.sha256()

            def pieces():
                nonlocal loss_chars, chars
                for _, _, text, spans in group:
                    chars += len(text)
                    for lo, hi in spans:
                        plain = unescape(text[lo:hi])
                        loss_chars += len(plain)
                        loss.update(plain.encode("utf-8", "surrogatepass"))
                    yield text

            for role, text in parse(pieces()):
                n += 1
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(out) == 5000:
                yield _batch(out, arrow)
                out = []
        if out:
            yield _batch(out, arrow)

    return formatted.mapInArrow(digest, schema)
