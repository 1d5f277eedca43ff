"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}                         output
    {% for x in messages %} ... {% endfor %}
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}  marks what a model is trained to write

Expressions: strings, integers, true/false, names, ``x.field``, ``loop.index``,
``loop.first``, ``loop.last``; ``~`` joins texts; ``== !=``, ``not``, ``and``,
``or``; filters ``| trim``, ``| upper``, ``| lower`` and those given by the caller.
There are no calls, no Python attributes and no way to reach other objects.

A template is parsed into a tree of tuples, constant parts are folded, and each
node becomes a closure; rendering streams (text, is_generation) pieces, so a loop
over a long conversation holds one message at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

Scope = dict[str, Any]
Pieces = Iterator[tuple[str, bool]]

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"""\s*(?:("(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[~|.()]))""")
_UNQUOTE = {"n": "\n", "t": "\t"}

FILTERS: dict[str, Callable[[str], str]] = {"trim": str.strip, "upper": str.upper, "lower": str.lower}


class TemplateError(ValueError):
    pass


# ------------------------------------------------------------- expressions
class _Expression:
    """Precedence climbing: or < and < not < comparison < ~ < filter < field."""

    def __init__(self, source: str, filters: dict):
        self.filters, self.tokens, at = filters, [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastindex, m.group(m.lastindex)))
            at = m.end()
            while at < len(source) and source[at].isspace():
                at += 1

    def parse(self) -> tuple:
        node = self.either()
        if self.tokens:
            raise TemplateError(f"unexpected {self.tokens[0][1]!r}")
        return node

    def take(self, *words: str) -> str | None:
        if self.tokens and self.tokens[0][0] != 1 and self.tokens[0][1] in words:
            return self.tokens.pop(0)[1]
        return None

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.joined()
        while op := self.take("==", "!="):
            node = (op, node, self.joined())
        return node

    def joined(self) -> tuple:
        node = self.filtered()
        while self.take("~"):
            node = ("~", node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.field()
        while self.take("|"):
            name = self.word("a filter")
            if name not in self.filters:
                raise TemplateError(f"unknown filter {name!r}")
            node = ("filter", name, node)
        return node

    def field(self) -> tuple:
        node = self.atom()
        while self.take("."):
            node = ("field", node, self.word("a field"))
        return node

    def word(self, what: str) -> str:
        if not self.tokens or self.tokens[0][0] != 3:
            raise TemplateError(f"{what} expected")
        return self.tokens.pop(0)[1]

    def atom(self) -> tuple:
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError(") expected")
            return node
        if not self.tokens:
            raise TemplateError("expression ends early")
        kind, text = self.tokens.pop(0)
        if kind == 1:
            return ("const", re.sub(r"\\(.)", lambda m: _UNQUOTE.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == 2:
            return ("const", int(text))
        if kind == 3 and text in ("true", "false"):
            return ("const", text == "true")
        if kind == 3:
            return ("name", text)
        raise TemplateError(f"unexpected {text!r}")


# ------------------------------------------------------------- syntax tree
def parse(source: str, filters: dict | None = None) -> tuple:
    """The template's tree: ("block", nodes) of text, out, for, if and generation nodes."""
    filters = {**FILTERS, **(filters or {})}
    items: list[tuple[str, str]] = []
    at = 0
    for m in _TAG.finditer(source):
        if m.start() > at:
            items.append(("text", source[at:m.start()]))
        items.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        items.append(("text", source[at:]))
    expression = lambda s: _Expression(s, filters).parse()

    def block(*ends: str) -> tuple[tuple, str]:
        nodes = []
        while items:
            kind, value = items.pop(0)
            if kind == "text":
                nodes.append(("text", value))
            elif kind == "out":
                nodes.append(("out", expression(value)))
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return ("block", nodes), value
                if word == "for":
                    m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
                    if not m:
                        raise TemplateError(f"bad loop {value!r}")
                    nodes.append(("for", m[1], expression(m[2]), block("endfor")[0]))
                elif word == "if":
                    nodes.append(branch(rest))
                elif word == "generation":
                    nodes.append(("generation", block("endgeneration")[0]))
                else:
                    raise TemplateError(f"unknown tag {value!r}")
        if ends:
            raise TemplateError(f"{ends[0]} expected")
        return ("block", nodes), ""

    def branch(test: str) -> tuple:
        body, end = block("elif", "else", "endif")
        word, _, rest = end.partition(" ")
        other = branch(rest) if word == "elif" else block("endif")[0] if word == "else" else ("block", [])
        return ("if", expression(test), body, other)

    return block()[0]


# ------------------------------------------------------------- folding
def fold(node: tuple, filters: dict | None = None) -> tuple:
    """The same tree with constant expressions, branches and texts worked out."""
    filters = {**FILTERS, **(filters or {})}

    def go(n: tuple) -> tuple:
        kind = n[0]
        if kind in ("const", "name", "text"):
            return n
        if kind == "field":
            return (kind, go(n[1]), n[2])
        if kind in ("or", "and", "==", "!=", "~"):
            a, b = go(n[1]), go(n[2])
            if a[0] == "const" and kind in ("or", "and"):
                return b if bool(a[1]) == (kind == "and") else a
            if a[0] == b[0] == "const":
                return ("const", expression((kind, a, b), filters)({}))
            return (kind, a, b)
        if kind == "not":
            a = go(n[1])
            return ("const", not a[1]) if a[0] == "const" else (kind, a)
        if kind == "filter":
            a = go(n[2])
            return ("const", filters[n[1]](text_of(a[1]))) if a[0] == "const" else (kind, n[1], a)
        if kind == "out":
            a = go(n[1])
            return ("text", text_of(a[1])) if a[0] == "const" else (kind, a)
        if kind == "for":
            return (kind, n[1], go(n[2]), go(n[3]))
        if kind == "generation":
            return (kind, go(n[1]))
        if kind == "if":
            test = go(n[1])
            return go(n[2] if test[1] else n[3]) if test[0] == "const" else (kind, test, go(n[2]), go(n[3]))
        flat: list[tuple] = []
        for x in map(go, n[1]):
            for y in (x[1] if x[0] == "block" else [x]):
                if y[0] == "text" and flat and flat[-1][0] == "text":
                    flat[-1] = ("text", flat[-1][1] + y[1])
                elif y != ("text", ""):
                    flat.append(y)
        return ("block", flat)
    return go(node)


# ------------------------------------------------------------- closures
def text_of(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


def expression(n: tuple, filters: dict) -> Callable[[Scope], Any]:
    kind = n[0]
    if kind == "const":
        return lambda s, v=n[1]: v
    if kind == "name":
        return lambda s, k=n[1]: s.get(k)
    if kind == "field":
        of = expression(n[1], filters)

        def field(s: Scope, k: str = n[2]) -> Any:
            v = of(s)
            return v.get(k) if isinstance(v, dict) else None
        return field
    if kind == "not":
        a = expression(n[1], filters)
        return lambda s: not a(s)
    if kind == "filter":
        f, a = filters[n[1]], expression(n[2], filters)
        return lambda s: f(text_of(a(s)))
    a, b = expression(n[1], filters), expression(n[2], filters)
    return {"or": lambda s: a(s) or b(s), "and": lambda s: a(s) and b(s), "==": lambda s: a(s) == b(s),
            "!=": lambda s: a(s) != b(s), "~": lambda s: text_of(a(s)) + text_of(b(s))}[kind]


def statement(n: tuple, filters: dict, marked: bool) -> Callable[[Scope], Pieces]:
    kind = n[0]
    if kind == "text":
        return lambda s, v=n[1]: iter(((v, marked),))
    if kind == "out":
        e = expression(n[1], filters)
        return lambda s: iter(((text_of(e(s)), marked),))
    if kind == "generation":
        return statement(n[1], filters, True)
    if kind == "if":
        test, yes, no = expression(n[1], filters), statement(n[2], filters, marked), statement(n[3], filters, marked)
        return lambda s: yes(s) if test(s) else no(s)
    if kind == "for":
        name, over, body = n[1], expression(n[2], filters), statement(n[3], filters, marked)

        def loop(s: Scope) -> Pieces:
            items: Iterable = over(s) or ()
            rest, index = iter(items), 0
            item = next(rest, loop)                             # ``loop`` itself marks the end
            while item is not loop:
                ahead = next(rest, loop)
                index += 1
                yield from body({**s, name: item, "loop": {"index": index, "first": index == 1, "last": ahead is loop}})
                item = ahead
        return loop
    parts = [statement(x, filters, marked) for x in n[1]]

    def block(s: Scope) -> Pieces:
        for p in parts:
            yield from p(s)
    return block


def compile_template(source: str, filters: dict | None = None) -> Callable[[Scope], Pieces]:
    """``render(scope)``: the (text, is_generation) pieces of the template."""
    every = {**FILTERS, **(filters or {})}
    return statement(fold(parse(source, filters), filters), every, False)
