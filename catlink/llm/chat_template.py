"""Chat formatting by a compiled, sandboxed template language (operator 1).

The language has text, ``{{ expression }}``, ``{% for x in path %}``, ``{% if %} {% elif %}
{% else %} {% endif %}`` and ``{% generation %} ... {% endgeneration %}``, which marks what a model
is trained on.  Expressions: string and integer literals, dotted paths into the given values,
``==  !=  and  or  not``, ``+`` and ``~`` (joining), parentheses, and filters ``| name`` from a
fixed table.  There are no calls, no attributes of Python objects (a path is looked up in mappings
only) and no loops but over given rows, so a template can neither reach the interpreter nor run
for ever.

``compile_template`` parses a syntax tree, folds constant expressions, conditions and adjacent
text, and generates nested Python closures.  Rendering is a generator of (text, is generation), so
a conversation of any length streams through one turn at a time.

The default template marks turns by ``### role: text </turn>``.  Text and role pass the
``escape`` filter, which puts a backslash before ``\\``, ``#``, ``<`` and ``:``; so control
strings inside a text never stand unescaped, and ``read_back`` recovers roles and texts exactly.

Cases: null roles and texts are empty ones; rows go by turn (nulls first), equal turns by role and
text, repeated rows stay repeated turns; conversations without an id form one conversation with a
null id; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catlink.functions.runtime import ship

DEFAULT_TEMPLATE = (
    "{% for message in messages %}{{ '### ' }}{{ message.role | escape }}{{ ': ' }}"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
    "{% else %}{{ message.text | escape }}{% endif %}{{ ' </turn>' + '\\n' }}{% endfor %}"
)
OPEN, CLOSE = "### ", " </turn>\n"
_ESCAPE = re.compile(r"[\\#<:]")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    pass


# --- syntax tree -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Path:
    names: tuple[str, ...]


@dataclass(frozen=True)
class Op:
    name: str
    args: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    arg: object


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class For:
    name: str
    over: Path
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class Generation:
    body: tuple


_PIECE = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[+~().|]))""", re.DOTALL)
_BACKSLASH = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if m is None:
                raise TemplateError(f"not understood: {source[at:at + 20]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else (None, None)

    def take(self, value=None):
        token = self.peek()
        if token[0] is None or value is not None and token[1] != value:
            raise TemplateError(f"expected {value or 'more'}, found {token[1]!r}")
        self.at += 1
        return token

    def whole(self):
        tree = self.either()
        if self.peek()[0] is not None:
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return tree

    def _chain(self, part, names):
        tree = part()
        while self.peek() in [("name", n) for n in names] or self.peek() in [("op", n) for n in names]:
            tree = Op(self.take()[1], (tree, part()))
        return tree

    def either(self):
        return self._chain(self.both, ("or",))

    def both(self):
        return self._chain(self.negated, ("and",))

    def negated(self):
        if self.peek() == ("name", "not"):
            self.take()
            return Op("not", (self.negated(),))
        return self._chain(self.joined, ("==", "!="))

    def joined(self):
        return self._chain(self.filtered, ("+", "~"))

    def filtered(self):
        tree = self.single()
        while self.peek() == ("op", "|"):
            self.take()
            name = self.take()[1]
            if name not in FILTERS:
                raise TemplateError(f"no such filter: {name}")
            tree = Filter(name, tree)
        return tree

    def single(self):
        kind, value = self.take()
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _BACKSLASH.get(m[1], m[1]), value[1:-1], flags=re.DOTALL))
        if kind == "int":
            return Const(int(value))
        if value == "(":
            tree = self.either()
            self.take(")")
            return tree
        if kind != "name" or value in ("and", "or", "not", "in"):
            raise TemplateError(f"unexpected {value!r}")
        names = [value]
        while self.peek() == ("op", "."):
            self.take()
            names.append(self.take()[1])
        return Path(tuple(names))


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    items, at = [], 0
    for m in _PIECE.finditer(source):
        if m.start() > at:
            items.append(("text", source[at : m.start()]))
        items.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        items.append(("text", source[at:]))
    tree, rest, ended = _block(items, 0, ())
    assert rest == len(items) and ended is None
    return tree


def _block(items, at: int, until: tuple[str, ...]):
    body = []
    while at < len(items):
        kind, value = items[at]
        at += 1
        if kind == "text":
            body.append(Text(value))
        elif kind == "out":
            body.append(Output(_Expression(value).whole()))
        else:
            word, _, rest = value.partition(" ")
            if word in until:
                return tuple(body), at, (word, rest)
            if word == "for":
                m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest)
                over = _Expression(m[2]).whole() if m else None
                if not isinstance(over, Path):
                    raise TemplateError(f"for: {rest!r}")
                inner, at, _ = _block(items, at, ("endfor",))
                body.append(For(m[1], over, inner))
            elif word == "if":
                branches, condition = [], _Expression(rest).whole()
                while True:
                    inner, at, (word, rest) = _block(items, at, ("elif", "else", "endif") if condition is not None else ("endif",))
                    branches.append((Const(True) if condition is None else condition, inner))
                    if word == "endif":
                        break
                    condition = _Expression(rest).whole() if word == "elif" else None
                body.append(If(tuple(branches)))
            elif word == "generation":
                inner, at, _ = _block(items, at, ("endgeneration",))
                body.append(Generation(inner))
            else:
                raise TemplateError(f"unexpected tag: {value!r}")
    if until:
        raise TemplateError(f"missing {until[-1]}")
    return tuple(body), at, None


# --- constant folding ------------------------------------------------------------------------


def _as_text(value) -> str:
    return "" if value is None else str(value)


_OPS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "and": lambda a, b: a and b, "or": lambda a, b: a or b, "not": lambda a: not a,
    "~": lambda a, b: _as_text(a) + _as_text(b), "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _as_text(a) + _as_text(b),
}


def fold_expression(tree):
    if isinstance(tree, Op):
        args = tuple(map(fold_expression, tree.args))
        return Const(_OPS[tree.name](*[a.value for a in args])) if all(isinstance(a, Const) for a in args) else Op(tree.name, args)
    if isinstance(tree, Filter):
        arg = fold_expression(tree.arg)
        return Const(FILTERS[tree.name](_as_text(arg.value))) if isinstance(arg, Const) else Filter(tree.name, arg)
    return tree


def fold(body: tuple) -> tuple:
    """Constants evaluated, dead branches dropped, adjacent text joined."""
    out: list = []
    for node in body:
        if isinstance(node, Output):
            value = fold_expression(node.value)
            made = [Text(_as_text(value.value))] if isinstance(value, Const) else [Output(value)]
        elif isinstance(node, If):
            branches, made = [], []
            for condition, inner in node.branches:
                condition = fold_expression(condition)
                if isinstance(condition, Const) and not condition.value:
                    continue
                branches.append((condition, fold(inner)))
                if isinstance(condition, Const):
                    break
            made = list(branches[0][1]) if branches and isinstance(branches[0][0], Const) else [If(tuple(branches))] if branches else []
        elif isinstance(node, For):
            made = [For(node.name, node.over, fold(node.body))]
        elif isinstance(node, Generation):
            made = [Generation(fold(node.body))]
        else:
            made = [node]
        for x in made:
            if isinstance(x, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].value + x.value)
            elif not (isinstance(x, Text) and not x.value):
                out.append(x)
    return tuple(out)


# --- closures --------------------------------------------------------------------------------


def _value(tree) -> Callable:
    if isinstance(tree, Const):
        return lambda scope, v=tree.value: v
    if isinstance(tree, Path):

        def look(scope, names=tree.names):
            for name in names:
                scope = scope.get(name) if isinstance(scope, dict) else None
            return scope

        return look
    if isinstance(tree, Filter):
        return lambda scope, f=FILTERS[tree.name], a=_value(tree.arg): f(_as_text(a(scope)))
    args = [_value(a) for a in tree.args]
    if tree.name == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if tree.name == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    return lambda scope, f=_OPS[tree.name]: f(*[a(scope) for a in args])


Piece = tuple[str, bool]


def _closure(body: tuple) -> Callable[[dict, bool], Iterator[Piece]]:
    steps = []
    for node in body:
        if isinstance(node, Text):
            steps.append(lambda scope, g, t=node.value: iter(((t, g),)))
        elif isinstance(node, Output):
            steps.append(lambda scope, g, v=_value(node.value): iter(((_as_text(v(scope)), g),)))
        elif isinstance(node, Generation):
            steps.append(lambda scope, g, inner=_closure(node.body): inner(scope, True))
        elif isinstance(node, For):

            def loop(scope, g, name=node.name, over=_value(node.over), inner=_closure(node.body)):
                for item in over(scope) or ():
                    yield from inner(scope | {name: item}, g)

            steps.append(loop)
        else:

            def choose(scope, g, branches=[(_value(c), _closure(b)) for c, b in node.branches]):
                for condition, inner in branches:
                    if condition(scope):
                        return inner(scope, g)
                return iter(())

            steps.append(choose)

    def run(scope: dict, generation: bool) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope, generation)

    return run


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages to (text, is generation) pieces."""
    run = _closure(fold(parse(source)))
    return lambda messages: run({"messages": messages}, False)


# --- reading back ----------------------------------------------------------------------------

_TURN = re.compile(r"### ((?:\\.|[^\\:#<])*): ((?:\\.|[^\\:#<])*) </turn>\n", re.DOTALL)


def read_back(rendered: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a rendering by the default template."""
    out, at = [], 0
    while at < len(rendered):
        m = _TURN.match(rendered, at)
        if m is None:
            raise ValueError(f"no turn at {at}: {rendered[at:at + 40]!r}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


class _Open:
    """A conversation on its way: digests and counts, and the turn being read."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss = conv_id, 0, 0, 0
        self.all, self.trained = hashlib.sha256(), hashlib.sha256()

    def add(self, pieces: list[Piece]) -> None:
        rendered = "".join([t for t, _ in pieces])
        self.chars += len(rendered)
        for role, text in read_back(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        # a mask's escapes never straddle its ends, as whole outputs are marked
        loss = unescape("".join([t for t, g in pieces if g]))
        self.loss += len(loss)
        self.trained.update(loss.encode("utf-8", "surrogatepass"))

    def row(self):
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss, self.trained.hexdigest(), self.chars


SUMMARY = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _summaries(template: str):
    """Streams rows sorted by conversation and turn; holds one turn at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        now: _Open | None = None
        done: list[tuple] = []

        def out():
            columns = list(zip(*done, strict=True))
            done.clear()
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["_i", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for conv_id, role, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Open(conv_id)
                now.add(list(render([{"role": role or "", "text": text or ""}])))
            if done:
                yield out()
        if now is not None:
            done.append(now.row())
            yield out()

    return run


def _pieces(template: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        for batch in batches:
            texts, masks = [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                made = list(render([{"role": role or "", "text": text or ""}]))
                spans, at = [], 0
                for t, g in made:
                    if g:
                        spans.append({"start": at, "end": at + len(t)})
                    at += len(t)
                texts.append("".join([t for t, _ in made]))
                masks.append(spans)
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), pa.array(texts, pa.string()), pa.array(masks, span)], names=["conv_id", "turn", "formatted", "loss_spans"])

    return run


def format_turns(conversations: DataFrame, template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """(conv_id, turn, formatted, loss_spans) of each row: no exchange, for templates that are one loop over messages."""
    ship(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return rows.mapInArrow(_pieces(template), "conv_id long, turn long, formatted string, loss_spans array<struct<start:int,end:int>>")


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """Formats by the default template and reads back: conv_id with counts and digests of turns and of the loss mask.

    A digest of a sequence needs the sequence in order, so each conversation streams through one
    task, sorted by an external sort and held one turn at a time, however long it is.
    """
    ship(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("_i"), F.col("role").alias("_role"), F.col("text").alias("_text"), F.col("turn").cast("long").alias("_turn"))
    rows = rows.repartition("_i").sortWithinPartitions("_i", "_turn", "_role", "_text").select("_i", "_role", "_text")
    return rows.mapInArrow(_summaries(DEFAULT_TEMPLATE), f"_i long, {SUMMARY}").withColumnRenamed("_i", "conv_id")
