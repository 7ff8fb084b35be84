"""Chat formatting with a compiled template language.

A template is parsed into a syntax tree, constants are folded, and the tree becomes
Python closures that yield the rendering piece by piece.  The language is sandboxed:
names look up the values given to it, dots and brackets look up keys of mappings,
filters come from a fixed table, and nothing is called or imported.

    {{ expression }}                      output
    {% if a %} .. {% elif b %} .. {% else %} .. {% endif %}
    {% for x in xs %} .. {% endfor %}     with loop.index, loop.first, loop.last
    {% set name = expression %}
    {% generation %} .. {% endgeneration %}   marks the text that a model is to write
    expressions: 'text', 12, true, false, none, names, a.b, a['b'], a | filter,
                 ~ (joins text), + - * / %, == != < <= > >=, in, and, or, not, x if c else y

Conversations are rendered as streams: rows come ordered by conversation and turn,
every turn becomes a row of the output, and one task holds one turn and the finished
rows of a bounded batch, however long the conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.llm.common import partitions, slices, stored

FLUSH_CHARS, FLUSH_ROWS = 4 << 20, 5000  # finished rows that a rendering task holds, about

# ---- control strings ---------------------------------------------------------------


class Escape:
    """Reversible removal of control strings: a backslash goes behind the first character
    of each, and before each backslash of the text itself."""

    def __init__(self, controls: tuple[str, ...]):
        if any(len(c) < 2 or "\\" in c for c in controls):
            raise ValueError("control strings have two characters or more and no backslash")
        any_of = "|".join(map(re.escape, controls))
        self.find = re.compile(rf"\\|(?=(?:{any_of}))(.)", re.S) if controls else re.compile(r"\\")

    def escape(self, text: str) -> str:
        return self.find.sub(lambda m: m[0] + "\\", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\\\|\\", lambda m: "\\" if len(m[0]) == 2 else "", text)


# ---- the template language -----------------------------------------------------------

TOKEN = re.compile(r"""\s*(?:(?P<num>\d+(?:\.\d+)?)|(?P<name>[A-Za-z_]\w*)
    |(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<op>==|!=|<=|>=|[-+*/%~<>|.\[\]()=]))""", re.X)
TAG = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
CONSTANTS = {"true": True, "false": False, "none": None}
COMPARE = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b,
           "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
           "in": lambda a, b: a in b}
ARITHMETIC = {"+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b,
              "/": lambda a, b: a / b, "%": lambda a, b: a % b}


class TemplateError(ValueError):
    pass


def _shown(v) -> str:
    return "" if v is None else v if isinstance(v, str) else str(v)


class Parser:
    """Recursive descent over the tags of a template; nodes are tuples (kind, ...)."""

    def __init__(self, source: str):
        parts = TAG.split(source)
        self.items: list[tuple[str, str]] = []
        strip = False
        for i, part in enumerate(parts):
            if i % 2 == 0:
                nxt = parts[i + 1] if i + 1 < len(parts) else ""
                part = part.lstrip() if strip else part
                part = part.rstrip() if nxt[2:3] == "-" and nxt[:2] != "{#" else part
                if part:
                    self.items.append(("text", part))
            else:
                strip = part[-3:-2] == "-" and part[:2] != "{#"
                if part[:2] != "{#":
                    body = part[2:-2].strip("-").strip() if part[1] == "%" else \
                        part[2:-2].removeprefix("-").removesuffix("-")
                    self.items.append(("out" if part[1] == "{" else "tag", body))
        self.at = 0

    def block(self, *ends: str) -> tuple[list, str]:
        nodes = []
        while self.at < len(self.items):
            kind, body = self.items[self.at]
            self.at += 1
            if kind == "text":
                nodes.append(("const", body))
            elif kind == "out":
                nodes.append(("out", Expression(body).whole()))
            else:
                word = body.split(None, 1)[0] if body else ""
                if word in ends:
                    return nodes, body
                nodes.append(self.statement(word, body))
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return nodes, ""

    def statement(self, word: str, body: str) -> tuple:
        rest = body[len(word):]
        if word == "generation":
            return ("generation", self.block("endgeneration")[0])
        if word == "set":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(?!=)(.*)", rest, re.S)
            if not m:
                raise TemplateError(f"bad set: {body}")
            return ("set", m[1], Expression(m[2]).whole())
        if word == "for":
            m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
            if not m:
                raise TemplateError(f"bad for: {body}")
            return ("for", m[1], Expression(m[2]).whole(), self.block("endfor")[0])
        if word == "if":
            arms, otherwise, cond = [], [], Expression(rest).whole()
            while True:
                nodes, end = self.block("elif", "else", "endif")
                arms.append((cond, nodes))
                if end.startswith("elif"):
                    cond = Expression(end[4:]).whole()
                    continue
                if end == "else":
                    otherwise = self.block("endif")[0]
                return ("if", arms, otherwise)
        raise TemplateError(f"unknown tag: {body}")


class Expression:
    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read: {source[at:]}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> str | None:
        if self.at < len(self.tokens):
            kind, v = self.tokens[self.at]
            if kind in ("op", "name") and v in values:
                return v
        return None

    def take(self, *values: str) -> str | None:
        v = self.peek(*values)
        self.at += v is not None
        return v

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value}")

    def whole(self) -> tuple:
        node = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]}")
        return node

    def choice(self) -> tuple:
        node = self.either()
        if self.take("if"):
            cond = self.either()
            self.need("else")
            return ("choose", cond, node, self.choice())
        return node

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
        while op := self.take(*COMPARE):
            node = ("compare", op, node, self.joined())
        return node

    def joined(self) -> tuple:
        node = self.sum()
        while self.take("~"):
            node = ("join", node, self.sum())
        return node

    def sum(self) -> tuple:
        node = self.product()
        while op := self.take("+", "-"):
            node = ("arith", op, node, self.product())
        return node

    def product(self) -> tuple:
        node = self.piped()
        while op := self.take("*", "/", "%"):
            node = ("arith", op, node, self.piped())
        return node

    def piped(self) -> tuple:
        node = self.single()
        while True:
            if self.take("|"):
                node = ("filter", self.name(), node)
            elif self.take("."):
                node = ("get", node, ("const", self.name()))
            elif self.take("["):
                node = ("get", node, self.choice())
                self.need("]")
            else:
                return node

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("expected a name")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def single(self) -> tuple:
        if self.take("("):
            node = self.choice()
            self.need(")")
            return node
        if self.at >= len(self.tokens):
            raise TemplateError("the expression ends too early")
        kind, v = self.tokens[self.at]
        self.at += 1
        if kind == "num":
            return ("const", float(v) if "." in v else int(v))
        if kind == "text":
            escapes = {"n": "\n", "t": "\t"}
            return ("const", re.sub(r"\\(.)", lambda m: escapes.get(m[1], m[1]), v[1:-1], flags=re.S))
        if kind == "name":
            return ("const", CONSTANTS[v]) if v in CONSTANTS else ("name", v)
        raise TemplateError(f"unexpected {v}")


def fold(node: tuple) -> tuple:
    """Evaluate what is constant in an expression."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    parts = tuple(fold(x) if isinstance(x, tuple) else x for x in node[1:])
    node = (kind, *parts)
    inner = [x for x in parts if isinstance(x, tuple)]
    if kind == "choose" and inner[0][0] == "const":
        return inner[1] if inner[0][1] else inner[2]
    if kind != "filter" and all(x[0] == "const" for x in inner):
        return ("const", expression(node, {})({}))
    return node


def fold_block(nodes: list) -> list:
    """Fold expressions, choose constant branches, and merge neighbouring texts."""
    out: list = []

    def add(node):
        if node[0] == "const" and out and out[-1][0] == "const":
            out[-1] = ("const", out[-1][1] + node[1])
        elif node != ("const", ""):
            out.append(node)

    for node in nodes:
        kind = node[0]
        if kind == "out":
            e = fold(node[1])
            add(("const", _shown(e[1])) if e[0] == "const" else ("out", e))
        elif kind == "if":
            arms, otherwise = [], fold_block(node[2])
            for cond, body in node[1]:
                cond = fold(cond)
                if cond[0] == "const" and not cond[1]:
                    continue
                if cond[0] == "const":
                    otherwise = fold_block(body)
                    break
                arms.append((cond, fold_block(body)))
            if arms:
                add(("if", arms, otherwise))
            else:
                for inner in otherwise:
                    add(inner)
        elif kind == "for":
            add(("for", node[1], fold(node[2]), fold_block(node[3])))
        elif kind == "generation":
            add(("generation", fold_block(node[1])))
        elif kind == "set":
            add(("set", node[1], fold(node[2])))
        else:
            add(node)
    return out


def _lookup(value, key):
    if isinstance(value, dict):
        return value.get(key)
    raise TemplateError(f"{key!r} is looked up in something that is no mapping")


def expression(node: tuple, filters: dict[str, Callable]) -> Callable[[dict], object]:
    """A closure from names to the expression's value."""
    kind, *x = node
    if kind == "const":
        value = x[0]
        return lambda names: value
    if kind == "name":
        key = x[0]
        return lambda names: names.get(key)
    if kind == "filter":
        if x[0] not in filters:
            raise TemplateError(f"unknown filter: {x[0]}")
        f, inner = filters[x[0]], expression(x[1], filters)
        return lambda names: f(_shown(inner(names)))
    if kind in ("compare", "arith"):
        f = (COMPARE if kind == "compare" else ARITHMETIC)[x[0]]
        a, b = expression(x[1], filters), expression(x[2], filters)
        return lambda names: f(a(names), b(names))
    inner = [expression(n, filters) for n in x]
    if kind == "not":
        return lambda names: not inner[0](names)
    a, b = inner[:2]
    if kind == "choose":
        c = inner[2]
        return lambda names: b(names) if a(names) else c(names)
    return {"and": lambda names: a(names) and b(names), "or": lambda names: a(names) or b(names),
            "join": lambda names: _shown(a(names)) + _shown(b(names)),
            "get": lambda names: _lookup(a(names), b(names))}[kind]


Render = Callable[[dict, bool], Iterator[tuple[str, bool]]]


def statement(node: tuple, filters: dict[str, Callable]) -> Render:
    """A closure that yields (text, whether it is under a generation mark)."""
    kind, *x = node
    if kind == "const":
        def const(names, marked, text=x[0]):
            yield text, marked
        return const
    if kind == "out":
        value = expression(x[0], filters)

        def out(names, marked):
            yield _shown(value(names)), marked
        return out
    if kind == "set":
        value = expression(x[1], filters)

        def assign(names, marked, key=x[0]):
            names[key] = value(names)
            return iter(())
        return lambda names, marked: assign(names, marked)
    if kind == "generation":
        body = block(x[0], filters)
        return lambda names, marked: body(names, True)
    if kind == "if":
        arms = [(expression(c, filters), block(b, filters)) for c, b in x[0]]
        otherwise = block(x[1], filters)

        def choose(names, marked):
            for cond, body in arms:
                if cond(names):
                    return body(names, marked)
            return otherwise(names, marked)
        return choose
    values, body, var = expression(x[1], filters), block(x[2], filters), x[0]

    def loop(names, marked):
        # one value is read ahead, so that the last one is known in a stream
        source = iter(values(names) or ())
        held, i = next(source, loop), 0
        while held is not loop:
            following = next(source, loop)
            i += 1
            inner = names | {var: held, "loop": {"index": i, "first": i == 1,
                                                 "last": following is loop}}
            yield from body(inner, marked)
            held = following
    return loop


def block(nodes: list, filters: dict[str, Callable]) -> Render:
    steps = [statement(n, filters) for n in nodes]

    def run(names, marked):
        for step in steps:
            yield from step(names, marked)
    return run


class Template:
    """``render(names)`` yields (text, generated) pieces.  Filters: trim, upper, lower,
    and escape over the template's control strings."""

    def __init__(self, source: str, controls: tuple[str, ...] = ()):
        parser = Parser(source)
        nodes, _ = parser.block()
        filters = {"trim": str.strip, "upper": str.upper, "lower": str.lower,
                   "escape": Escape(controls).escape}
        self.nodes = fold_block(nodes)
        self._run = block(self.nodes, filters)

    def render(self, names: dict) -> Iterator[tuple[str, bool]]:
        return self._run(dict(names), False)


# ---- conversations ---------------------------------------------------------------------

CONTROLS = ("<turn>", "<says>", "</turn>", "### Assistant:")
TURN = """\
{% for turn in turns -%}
<turn>{{ turn.role | escape }}<says>
{%- if turn.role == 'assistant' -%}
{% generation %}{{ turn.text | escape }}{% endgeneration %}
{%- else -%}
{{ turn.text | escape }}
{%- endif -%}
</turn>{{ '\\n' }}
{%- endfor %}"""


def _ordered(convs: DataFrame) -> DataFrame:
    rows = convs.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                        F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    return rows.repartition(partitions(convs.sparkSession), "conv_id").sortWithinPartitions(*order)


def format_conversations(convs: DataFrame, template: str = TURN,
                         controls: tuple[str, ...] = CONTROLS) -> DataFrame:
    """Render each conversation; one row per turn: conv_id, seq, formatted, spans.

    The rows of a conversation, joined by ``seq``, are its whole text; ``spans`` lists
    [begin, end) code points of this row that are under the loss mask.  Turns go by
    ``turn`` (null first), then role and text; null role and text are empty; rows
    with a null ``conv_id`` are one conversation; an empty table gives no rows.  The
    template is rendered as a stream: each pass of its loop is a row.
    """
    out = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("formatted", pa.string()),
                     ("spans", pa.list_(pa.list_(pa.int64())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template, controls)
        rows = (r for b in slices(batches, "text") for r in zip(*(c.to_pylist() for c in b.columns)))
        ahead = next(rows, None)
        done: list[tuple] = []
        size = 0

        def emitted():
            nonlocal done, size
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*done), out)], schema=out)
            done, size = [], 0
            return batch

        while ahead is not None:
            conv, asked, begun = ahead[0], 0, 0

            def turns():
                nonlocal ahead, asked
                while ahead is not None and ahead[0] == conv:
                    _, turn, role, text = ahead
                    ahead = next(rows, None)
                    asked += 1
                    yield {"turn": turn, "role": role, "text": text}
                asked += 1

            # the loop asks for one turn ahead, then renders: a new request, a new row
            seq, text, spans, n = 0, [], [], 0
            for piece, marked in compiled.render({"turns": turns()}):
                if asked != begun and n:
                    done.append((conv, seq, "".join(text), spans))
                    size += n
                    seq, text, spans, n = seq + 1, [], [], 0
                    if size > FLUSH_CHARS or len(done) >= FLUSH_ROWS:
                        yield emitted()
                begun = asked
                if marked:
                    spans.append([n, n + len(piece)])
                text.append(piece)
                n += len(piece)
            done.append((conv, seq, "".join(text), spans))
            size += n
            if size > FLUSH_CHARS or len(done) >= FLUSH_ROWS:
                yield emitted()
        if done:
            yield emitted()

    return _ordered(convs).mapInArrow(
        run, "conv_id long, seq long, formatted string, spans array<array<long>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest formatted conversations: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars.

    Turns are found by the marks of :data:`TURN` and unescaped; hashes run on from
    row to row, so a conversation of any length needs the memory of one turn.
    """
    out = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()),
                     ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    turn = re.compile(r"<turn>(.*?)<says>(.*?)</turn>\n", re.S)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state, done = None, None, []

        def closed():
            n, turns, chars, loss, size = state
            return (here[0], n, turns.hexdigest(), chars, loss.hexdigest(), size)

        def emit(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

        for b in slices(batches, "formatted"):
            for conv, text, spans in zip(*(c.to_pylist() for c in b.columns)):
                if here != (conv,):
                    if here:
                        done.append(closed())
                    here, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                at = 0
                for m in turn.finditer(text):
                    if m.start() != at:
                        raise ValueError(f"conversation {conv}: text outside of turns")
                    at = m.end()
                    role, said = Escape.unescape(m[1]), Escape.unescape(m[2])
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                if at != len(text):
                    raise ValueError(f"conversation {conv}: an open turn")
                for a, z in spans:
                    own = Escape.unescape(text[a:z])
                    state[2] += len(own)
                    state[3].update(own.encode())
                state[4] += len(text)
            if done:
                yield emit(done)
                done = []
        if here:
            yield emit([closed()])

    rows = formatted.repartition(partitions(formatted.sparkSession), "conv_id")
    return rows.sortWithinPartitions("conv_id", "seq").select("conv_id", "formatted", "spans").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long")


def format_and_read(convs: DataFrame) -> DataFrame:
    """Write the formatted conversations to the shared folder and read them back."""
    return read_back(stored(format_conversations(convs), "chat"))
