"""A small template language for conversations, compiled to Python closures.

``{{ expression }}`` writes a value, ``{% ... %}`` holds a statement, ``{# ... #}`` a comment;
a ``-`` inside a mark strips white space on its side. Statements: ``for name in expression``,
``if`` / ``elif`` / ``else``, ``set name = expression``, and ``generation`` around what a model
is to learn. Expressions: strings, whole numbers, ``true``, ``false``, ``none``, names, ``a.key``,
``a['key']``, comparisons, ``and``, ``or``, ``not``, ``~`` (joined text), ``a if test else b``
and filters behind ``|``. In a loop ``loop`` has ``index``, ``first``, ``last`` and ``previous``.

The language is closed: only keys of mappings are looked up, never attributes of Python
objects, nothing can be called but the filters handed to ``compile_template``, and
there are no unbounded loops. What is missing is empty and false. Source length, nesting and
the length of a mark are bounded. ``messages`` is read as a stream, once and in order, so it may only be
the source of one loop that is not inside another.

Text is parsed into a tree, constants are folded (expressions, filters of constants,
branches that cannot be taken, neighbouring texts), and every node becomes a closure.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any, NamedTuple

LONGEST_SOURCE = 1 << 16
DEEPEST = 40
MOST_TOKENS = 200  # of one mark
STREAM = "messages"

# What a rendering yields besides text.
START, STOP, TURN = object(), object(), object()


class TemplateError(ValueError):
    pass


class Const(NamedTuple):
    value: Any


class Name(NamedTuple):
    name: str


class Get(NamedTuple):
    of: Any
    key: Any


class Op(NamedTuple):
    """An operator or filter applied to values; all of them are pure."""

    name: str
    args: tuple


class Choice(NamedTuple):
    """``kind`` is ``and``, ``or`` or ``if``; sides are evaluated only when needed. ``and`` has no
    ``b`` and ``or`` no ``a``: there the value of ``test`` stands."""

    kind: str
    test: Any
    a: Any
    b: Any


class Text(NamedTuple):
    text: str


class Out(NamedTuple):
    value: Any


class Set(NamedTuple):
    name: str
    value: Any


class If(NamedTuple):
    test: Any
    then: list
    other: list


class For(NamedTuple):
    name: str
    source: Any
    body: list


class Generation(NamedTuple):
    body: list


_MARK = re.compile(r"\{(?:\{|%|#)-?")
_CLOSING = {"{{": "}}", "{%": "%}", "{#": "#}"}
_TOKEN = re.compile(r"""\s*(?:(?P<str>'[^'\\]*(?:\\.[^'\\]*)*'|"[^"\\]*(?:\\.[^"\\]*)*")|(?P<int>\d{1,18})"""
                    r"""|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>|.~()\[\],=]))""", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None}
_COMPARE: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b, ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b,
}


def shown(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _ordered(name: str) -> Callable:
    """A comparison; values of different kinds differ and have no order."""
    compare = _COMPARE[name]

    def run(a: Any, b: Any) -> bool:
        if name in ("==", "!=") or type(a) is type(b) and isinstance(a, (str, int)):
            return compare(a, b)
        return False

    return run


_OPERATORS = {name: _ordered(name) for name in _COMPARE} | {
    "not": lambda a: not a, "~": lambda a, b: shown(a) + shown(b),
}


def _pieces(source: str) -> Iterator[tuple[str, str]]:
    """Text and marks: (kind, content), kind ``text``, ``{{`` or ``{%``."""
    at, strip = 0, False
    while True:
        mark = _MARK.search(source, at)
        text = source[at : mark.start()] if mark else source[at:]
        if strip:
            text = text.lstrip()
        if mark and mark.group().endswith("-"):
            text = text.rstrip()
        if text:
            yield "text", text
        if not mark:
            return
        kind = mark.group()[:2]
        stop = _end(source, mark.end(), _CLOSING[kind])
        inner = source[mark.end() : stop]
        strip = inner.endswith("-")
        if kind != "{#":
            yield kind, inner[:-1] if strip else inner
        at = stop + 2


def _end(source: str, at: int, closing: str) -> int:
    """Where a mark closes; a comment's quotes mean nothing, others may quote the closing."""
    quoted = r"'[^'\\]*(?:\\.[^'\\]*)*'|\"[^\"\\]*(?:\\.[^\"\\]*)*\"|" if closing != "#}" else ""
    for found in re.compile(quoted + re.escape(closing), re.S).finditer(source, at):
        if found.group() == closing:
            return found.start()
    raise TemplateError(f"mark at {at} is not closed by {closing}")


class _Expression:
    """Recursive descent over one mark's tokens."""

    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.filters, self.tokens, self.at, self.depth = filters, [], 0, 0
        place, source = 0, source.strip()
        while place < len(source):
            found = _TOKEN.match(source, place)
            if not found:
                raise TemplateError(f"not understood: {source[place:place + 20]!r}")
            self.tokens.append((found.lastgroup, found.group(found.lastgroup)))
            place = found.end()
        if len(self.tokens) > MOST_TOKENS:
            raise TemplateError("expression too long")

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "str" else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, *wanted: str) -> str:
        found = self.take(*wanted)
        if found is None:
            raise TemplateError(f"expected {' or '.join(wanted)}")
        return found

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("expected a name")

    def done(self, value):
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return value

    def whole(self):
        self.depth += 1
        if self.depth > DEEPEST:
            raise TemplateError("nested too deeply")
        value = self.any_of()
        if self.take("if"):
            test = self.any_of()
            value = Choice("if", test, value, self.whole() if self.take("else") else Const(None))
        self.depth -= 1
        return value

    def any_of(self):
        value = self.all_of()
        while self.take("or"):
            value = Choice("or", value, None, self.all_of())
        return value

    def all_of(self):
        value = self.negated()
        while self.take("and"):
            value = Choice("and", value, self.negated(), None)
        return value

    def negated(self):
        turns = 0
        while self.take("not"):
            turns += 1
        value = self.compared()
        if turns:
            value = Op("not", (value,))
            if turns % 2 == 0:
                value = Op("not", (value,))
        return value

    def compared(self):
        value = self.joined()
        while (op := self.take(*_COMPARE)) is not None:
            value = Op(op, (value, self.joined()))
        return value

    def joined(self):
        value = self.filtered()
        while self.take("~"):
            value = Op("~", (value, self.filtered()))
        return value

    def filtered(self):
        value = self.reached()
        while self.take("|"):
            name = self.name()
            if name not in self.filters:
                raise TemplateError(f"no filter named {name}")
            args = [value]
            if self.take("("):
                while not self.take(")"):
                    args.append(self.whole())
                    if self.need(",", ")") == ")":
                        break
            value = Op(f"|{name}", tuple(args))
        return value

    def reached(self):
        value = self.atom()
        while (op := self.take(".", "[")) is not None:
            if op == ".":
                value = Get(value, Const(self.name()))
            else:
                value = Get(value, self.whole())
                self.need("]")
        return value

    def atom(self):
        if self.take("("):
            value = self.whole()
            self.need(")")
            return value
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends too early")
        kind, token = self.tokens[self.at]
        self.at += 1
        if kind == "str":
            return Const(_ESCAPE.sub(lambda m: _ESCAPES.get(m[1], m[1]), token[1:-1]))
        if kind == "int":
            return Const(int(token))
        if kind == "name":
            return Const(_WORDS[token]) if token in _WORDS else Name(token)
        raise TemplateError(f"unexpected {token!r}")


def parse(source: str, filters: Mapping[str, Callable]) -> list:
    """The syntax tree of a template."""
    if len(source) > LONGEST_SOURCE:
        raise TemplateError("template too long")
    pieces = _pieces(source)

    def body(depth: int, *ends: str) -> tuple[list, str, _Expression | None]:
        if depth > DEEPEST:
            raise TemplateError("nested too deeply")
        found: list = []
        for kind, content in pieces:
            if kind == "text":
                found.append(Text(content))
                continue
            rest = _Expression(content, filters)
            if kind == "{{":
                found.append(Out(rest.done(rest.whole())))
                continue
            word = rest.name()
            if word in ends:
                return found, word, rest
            if word == "for":
                name = rest.name()
                rest.need("in")
                source_of = rest.done(rest.whole())
                found.append(For(name, source_of, body(depth + 1, "endfor")[0]))
            elif word == "if":
                found.append(branch(depth, rest.done(rest.whole())))
            elif word == "set":
                name = rest.name()
                rest.need("=")
                found.append(Set(name, rest.done(rest.whole())))
            elif word == "generation":
                found.append(Generation(body(depth + 1, "endgeneration")[0]))
            else:
                raise TemplateError(f"unexpected statement {word}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return found, "", None

    def branch(depth: int, test) -> If:
        then, word, rest = body(depth + 1, "elif", "else", "endif")
        other: list = []
        if word == "elif":
            other = [branch(depth + 1, rest.done(rest.whole()))]
        elif word == "else":
            other = body(depth + 1, "endif")[0]
        return If(test, then, other)

    return body(0)[0]


def _applied(name: str, filters: Mapping[str, Callable]) -> Callable:
    return filters[name[1:]] if name.startswith("|") else _OPERATORS[name]


def fold(node, filters: Mapping[str, Callable]):
    """An expression with its constant parts evaluated."""
    if isinstance(node, Op):
        args = tuple(fold(a, filters) for a in node.args)
        if all(isinstance(a, Const) for a in args):
            return Const(_applied(node.name, filters)(*(a.value for a in args)))
        return Op(node.name, args)
    if isinstance(node, Get):
        return Get(fold(node.of, filters), fold(node.key, filters))
    if isinstance(node, Choice):
        test, a, b = (fold(x, filters) for x in node[1:])
        if isinstance(test, Const):
            return (a if test.value else b) or test
        return Choice(node.kind, test, a, b)
    return node


def folded(body: list, filters: Mapping[str, Callable]) -> list:
    """Statements with constants folded: fixed branches chosen, neighbouring texts joined."""
    made: list = []
    for node in body:
        if isinstance(node, (Out, Set)):
            value = fold(node[-1], filters)
            fixed = isinstance(node, Out) and isinstance(value, Const)
            new = [Text(shown(value.value))] if fixed else [node._replace(value=value)]
        elif isinstance(node, If):
            test = fold(node.test, filters)
            then, other = folded(node.then, filters), folded(node.other, filters)
            new = (then if test.value else other) if isinstance(test, Const) else [If(test, then, other)]
        elif isinstance(node, For):
            new = [For(node.name, fold(node.source, filters), folded(node.body, filters))]
        elif isinstance(node, Generation):
            new = [Generation(folded(node.body, filters))]
        else:
            new = [node]
        for n in new:
            if isinstance(n, Text) and made and isinstance(made[-1], Text):
                made[-1] = Text(made[-1].text + n.text)
            elif n != Text(""):
                made.append(n)
    return made


def _check_stream(body: list) -> None:
    """``messages`` is the source of one outer loop and nothing else."""
    uses: list[bool] = []

    def expression(node) -> None:
        if isinstance(node, Name) and node.name == STREAM:
            uses.append(False)
        for child in node if isinstance(node, (Op, Get, Choice)) else ():
            for part in child if isinstance(child, tuple) and not hasattr(child, "_fields") else (child,):
                expression(part)

    def walk(nodes: list, outer: bool) -> None:
        for n in nodes:
            if isinstance(n, For):
                if n.source == Name(STREAM):
                    uses.append(outer)
                else:
                    expression(n.source)
                walk(n.body, False)
            elif isinstance(n, If):
                expression(n.test)
                walk(n.then, outer)
                walk(n.other, outer)
            elif isinstance(n, Generation):
                walk(n.body, outer)
            elif isinstance(n, (Out, Set)):
                expression(n.value)

    walk(body, True)
    if len(uses) > 1 or not all(uses):
        raise TemplateError(f"{STREAM} may only be the source of one outer loop")


def _value(node, filters: Mapping[str, Callable]) -> Callable[[dict], Any]:
    """The closure of an expression."""
    if isinstance(node, Const):
        fixed = node.value
        return lambda scope: fixed
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    if isinstance(node, Get):
        of, key = _value(node.of, filters), _value(node.key, filters)

        def get(scope: dict) -> Any:
            holder, at = of(scope), key(scope)
            return holder.get(at) if isinstance(holder, dict) and isinstance(at, str) else None

        return get
    if isinstance(node, Op):
        run = _applied(node.name, filters)
        args = [_value(a, filters) for a in node.args]
        if len(args) == 1:
            only = args[0]
            return lambda scope: run(only(scope))
        return lambda scope: run(*[a(scope) for a in args])
    test, a, b = (x and _value(x, filters) for x in node[1:])
    if node.kind == "if":
        return lambda scope: a(scope) if test(scope) else b(scope)
    if node.kind == "and":
        return lambda scope: a(scope) if (first := test(scope)) else first
    return lambda scope: first if (first := test(scope)) else b(scope)


Run = Callable[[dict], Iterator[Any]]


def _statements(body: list, filters: Mapping[str, Callable], outer: bool) -> Run:
    """The closure of a sequence of statements: a generator of text and marks."""
    runs = [_statement(n, filters, outer) for n in body]

    def run(scope: dict) -> Iterator[Any]:
        for one in runs:
            yield from one(scope)

    return runs[0] if len(runs) == 1 else run


def _statement(node, filters: Mapping[str, Callable], outer: bool) -> Run:
    if isinstance(node, Text):
        fixed = (node.text,)
        return lambda scope: fixed
    if isinstance(node, Out):
        value = _value(node.value, filters)
        return lambda scope: (shown(value(scope)),)
    if isinstance(node, Set):
        name, value = node.name, _value(node.value, filters)

        def put(scope: dict) -> tuple:
            scope[name] = value(scope)
            return ()

        return put
    if isinstance(node, If):
        test = _value(node.test, filters)
        then, other = _statements(node.then, filters, outer), _statements(node.other, filters, outer)
        return lambda scope: then(scope) if test(scope) else other(scope)
    if isinstance(node, Generation):
        inner = _statements(node.body, filters, outer)

        def marked(scope: dict) -> Iterator[Any]:
            yield START
            yield from inner(scope)
            yield STOP

        return marked
    name, source, inner = node.name, _value(node.source, filters), _statements(node.body, filters, False)
    turn = outer and node.source == Name(STREAM)

    def loop(scope: dict) -> Iterator[Any]:
        items = source(scope)
        if turn or isinstance(items, (list, tuple)):
            previous, index, items, none = None, 0, iter(items or ()), object()
            item = next(items, none)
            while item is not none:
                index += 1
                after = next(items, none)
                state = {"index": index, "first": index == 1, "last": after is none, "previous": previous}
                yield from inner({**scope, name: item, "loop": state})
                if turn:
                    yield TURN
                previous, item = item, after

    return loop


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Callable[[Iterable, Mapping], Iterator[Any]]:
    """A function of a conversation's messages (an iterable of mappings) and further names.

    It yields text, ``START`` and ``STOP`` of generation, and ``TURN`` behind each message's
    text. Messages are taken as they are needed, one ahead.
    """
    filters = dict(filters or {})
    tree = folded(parse(source, filters), filters)
    _check_stream(tree)
    run = _statements(tree, filters, True)

    def render(messages: Iterable, names: Mapping = {}) -> Iterator[Any]:
        return iter(run({**names, STREAM: messages}))

    return render
