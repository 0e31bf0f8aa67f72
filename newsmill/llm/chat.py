"""Chat formatting with a compiled template.

A small sandboxed template language is parsed into a syntax tree, constant parts are folded, and the tree is turned into
nested Python closures.  Rendering pushes pieces of text, each marked as generated (under the loss mask) or not.

    {{ expr }}                              output
    {% for x in expr %} .. {% endfor %}     loop.index, loop.index0, loop.first, loop.last inside
    {% if e %} .. {% elif e %} .. {% else %} .. {% endif %}
    {% set name = expr %}                   in the current scope
    {% generation %} .. {% endgeneration %} marks output as generated
    {# comment #}                           nothing

Expressions: strings, integers, true/false/none, names, ``a.b`` and ``a['b']`` on mappings, ``not and or``, comparisons,
``in``, ``+``, ``~`` and the filters ``escape header trim upper lower length``.  Sandbox: names and keys are looked up in
mappings only; there are no calls, no attributes of Python objects and no loops over anything but sequences given to it."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

CHATML = ("{% for message in messages %}<|im_start|>{{ message.role | header }}\n"
          "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}"
          "{% else %}{{ message.text | escape }}{% endif %}<|im_end|>\n{% endfor %}")

# ------------------------------------------------------------------------------------------------- escaping
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """Make every control opener ``<|`` unreadable by one more backslash; undone by :func:`unescape`."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def header(role: str) -> str:
    """A role on one line: per cent signs and line breaks are written as %25 and %0A, then escaped."""
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unheader(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


FILTERS: dict[str, Callable] = {"escape": escape, "header": header, "trim": str.strip, "upper": str.upper,
                                "lower": str.lower, "length": len}

# ------------------------------------------------------------------------------------------------- parsing
_PARTS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|"""
                    r"""(?P<op>==|!=|<=|>=|[<>.\[\]()|+~]))""")
_CONSTANTS = {"true": True, "false": False, "none": None}
_WORDS = {"and", "or", "not", "in"}


class TemplateError(ValueError):
    """The template does not follow the language."""


class _Expr:
    """Precedence climbing over the tokens of one expression; gives tuples (kind, ...)."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m or m.end() == at:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return None if kind == "str" else value

    def take(self, value: str | None = None) -> tuple[str, str]:
        if self.at >= len(self.tokens) or value is not None and self.peek() != value:
            raise TemplateError(f"expected {value or 'more'} at token {self.at} of {self.tokens}")
        self.at += 1
        return self.tokens[self.at - 1]

    def whole(self):
        tree = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def either(self):
        tree = self.both()
        while self.peek() == "or":
            self.take()
            tree = ("or", tree, self.both())
        return tree

    def both(self):
        tree = self.negated()
        while self.peek() == "and":
            self.take()
            tree = ("and", tree, self.negated())
        return tree

    def negated(self):
        if self.peek() == "not":
            self.take()
            return ("not", self.negated())
        return self.compared()

    def compared(self):
        tree = self.joined()
        while self.peek() in ("==", "!=", "<", ">", "<=", ">=", "in"):
            tree = (self.take()[1], tree, self.joined())
        return tree

    def joined(self):
        tree = self.filtered()
        while self.peek() in ("+", "~"):
            tree = (self.take()[1], tree, self.filtered())
        return tree

    def filtered(self):
        tree = self.primary()
        while self.peek() == "|":
            self.take()
            name = self.take()[1]
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = ("filter", name, tree)
        return tree

    def primary(self):
        kind, value = self.take()
        if kind == "str":
            tree = ("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1], flags=re.S))
        elif kind == "int":
            tree = ("const", int(value))
        elif value == "(":
            tree = self.either()
            self.take(")")
        elif kind == "name" and value not in _WORDS:
            tree = ("const", _CONSTANTS[value]) if value in _CONSTANTS else ("name", value)
        else:
            raise TemplateError(f"unexpected {value!r}")
        while self.peek() in (".", "["):
            if self.take()[1] == ".":
                tree = ("item", tree, ("const", self.take()[1]))
            else:
                tree = ("item", tree, self.either())
                self.take("]")
        return tree


def parse(source: str) -> list[tuple]:
    """Statements of a template as nested tuples."""
    parts = [p for p in _PARTS.split(source) if p and not p.startswith("{#")]
    tree, rest, end = _block(parts, 0, ())
    assert rest == len(parts) and end is None
    return tree


def _block(parts: list[str], at: int, ends: tuple[str, ...]) -> tuple[list[tuple], int, str | None]:
    out: list[tuple] = []
    while at < len(parts):
        part = parts[at]
        at += 1
        if part.startswith("{{"):
            out.append(("out", _Expr(part[2:-2]).whole()))
            continue
        if not part.startswith("{%"):
            out.append(("out", ("const", part)))
            continue
        word, _, rest = part[2:-2].strip().partition(" ")
        if word in ends:
            return out, at, part[2:-2].strip()
        if word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
            if not m:
                raise TemplateError(f"for: {rest!r}")
            body, at, _ = _block(parts, at, ("endfor",))
            out.append(("for", m[1], _Expr(m[2]).whole(), body))
        elif word == "if":
            branches, test, end = [], rest, ""
            while end != "endif":
                body, at, end = _block(parts, at, ("elif", "else", "endif") if test is not None else ("endif",))
                branches.append((("const", True) if test is None else _Expr(test).whole(), body))
                test = end.partition(" ")[2] if end.startswith("elif") else None
            out.append(("if", branches))
        elif word == "set":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s*=\s*(.+)", rest.strip(), re.S)
            if not m:
                raise TemplateError(f"set: {rest!r}")
            out.append(("set", m[1], _Expr(m[2]).whole()))
        elif word == "generation":
            body, at, _ = _block(parts, at, ("endgeneration",))
            out.append(("generation", body))
        else:
            raise TemplateError(f"unknown or misplaced statement {word!r}")
    if ends:
        raise TemplateError(f"missing {' or '.join(ends)}")
    return out, at, None


# ------------------------------------------------------------------------------------------------- folding
def _fold_expr(e: tuple) -> tuple:
    if e[0] in ("const", "name"):
        return e
    if e[0] == "filter":
        inner = _fold_expr(e[2])
        return ("const", FILTERS[e[1]](inner[1])) if inner[0] == "const" and isinstance(inner[1], str) else ("filter", e[1], inner)
    parts = [_fold_expr(x) for x in e[1:]]
    if all(p[0] == "const" for p in parts) and e[0] != "item":
        return ("const", _eval((e[0], *parts))({}))
    return (e[0], *parts)


def fold(tree: list[tuple]) -> list[tuple]:
    """Evaluate constant expressions, drop branches that cannot run, join neighbouring constant output."""
    out: list[tuple] = []
    for s in tree:
        if s[0] == "out":
            s = ("out", _fold_expr(s[1]))
            if s[1][0] == "const":
                s = ("out", ("const", _text(s[1][1])))
                if s[1][1] == "":
                    continue
                if out and out[-1][0] == "out" and out[-1][1][0] == "const":
                    s = ("out", ("const", out.pop()[1][1] + s[1][1]))
        elif s[0] == "for":
            s = ("for", s[1], _fold_expr(s[2]), fold(s[3]))
        elif s[0] == "set":
            s = ("set", s[1], _fold_expr(s[2]))
        elif s[0] == "generation":
            s = ("generation", fold(s[1]))
        elif s[0] == "if":
            branches = []
            for test, body in s[1]:
                test = _fold_expr(test)
                if test[0] == "const" and not test[1]:
                    continue
                branches.append((test, fold(body)))
                if test[0] == "const":
                    break
            if not branches:
                continue
            s = ("if", branches)
        out.append(s)
    return out


# ------------------------------------------------------------------------------------------------- closures
def _text(v: Any) -> str:
    return "" if v is None else v if isinstance(v, str) else str(v)


_BINARY: dict[str, Callable] = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b,
                                ">": lambda a, b: a > b, "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b,
                                "in": lambda a, b: a in b, "+": lambda a, b: a + b, "~": lambda a, b: _text(a) + _text(b)}


def _eval(e: tuple) -> Callable[[dict], Any]:
    kind = e[0]
    if kind == "const":
        return lambda scope, v=e[1]: v
    if kind == "name":
        return lambda scope, n=e[1]: scope.get(n)
    if kind == "filter":
        f, inner = FILTERS[e[1]], _eval(e[2])
        return (lambda scope: f(inner(scope))) if e[1] == "length" else (lambda scope: f(_text(inner(scope))))
    a = _eval(e[1])
    if kind == "not":
        return lambda scope: not a(scope)
    b = _eval(e[2])
    if kind == "item":
        def item(scope):
            box = a(scope)
            return box.get(b(scope)) if isinstance(box, dict) else None
        return item
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        return lambda scope: a(scope) or b(scope)
    op = _BINARY[kind]
    return lambda scope: op(a(scope), b(scope))


Emit = Callable[[str, bool], None]


def _run(tree: list[tuple], generated: bool) -> Callable[[dict, Emit], None]:
    steps: list[Callable] = []
    for s in tree:
        if s[0] == "out" and s[1][0] == "const":
            steps.append(lambda scope, emit, v=s[1][1]: emit(v, generated))
        elif s[0] == "out":
            steps.append(lambda scope, emit, f=_eval(s[1]): emit(_text(f(scope)), generated))
        elif s[0] == "set":
            def assign(scope, emit, n=s[1], f=_eval(s[2])):
                scope[n] = f(scope)
            steps.append(assign)
        elif s[0] == "generation":
            steps.append(_run(s[1], True))
        elif s[0] == "if":
            def choose(scope, emit, branches=[(_eval(t), _run(b, generated)) for t, b in s[1]]):
                for test, body in branches:
                    if test(scope):
                        return body(scope, emit)
            steps.append(choose)
        else:
            def loop(scope, emit, n=s[1], f=_eval(s[2]), body=_run(s[3], generated)):
                rows = f(scope) or ()
                if isinstance(rows, (str, dict)):
                    raise TemplateError("for needs a sequence")
                rows = iter(rows)
                row, index, end = next(rows, _END), 0, False
                while row is not _END:
                    after = next(rows, _END)
                    body(scope | {n: row, "loop": {"index0": index, "index": index + 1, "first": index == 0, "last": after is _END}}, emit)
                    row, index = after, index + 1
            steps.append(loop)

    def run(scope: dict, emit: Emit) -> None:
        for step in steps:
            step(scope, emit)
    return run


_END = object()


def compile_template(source: str) -> Callable[[dict, Emit], None]:
    """Parse, fold and compile; the result renders a scope by calling ``emit(text, generated)``."""
    return _run(fold(parse(source)), False)


def render(template: Callable[[dict, Emit], None], messages: Iterable[dict]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans under the loss mask, in code points."""
    parts: list[str] = []
    spans: list[tuple[int, int]] = []
    length = 0

    def emit(text: str, generated: bool) -> None:
        nonlocal length
        parts.append(text)
        if generated:
            spans.append((length, length + len(text)))
        length += len(text)

    template({"messages": messages}, emit)
    return "".join(parts), spans


_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a ChatML string; raises if anything is left between turns."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"not a turn at {at}")
        turns.append((unheader(m[1]), unescape(m[2])))
        at = m.end()
    return turns


# ------------------------------------------------------------------------------------------------- on Spark
FORMATTED = "conv_id {key}, formatted string, loss_spans array<struct<start:long,end:long>>"


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, list[dict]]]:
    """Consecutive rows of one conversation; at most one conversation is held."""
    key, turns = _END, []
    for b in batches:
        for k, role, text in zip(*(b.column(i).to_pylist() for i in range(3))):
            if key is not _END and k != key:
                yield key, turns
                turns = []
            key = k
            turns.append({"role": role, "text": text})
    if key is not _END:
        yield key, turns


def format_conversations(rows: DataFrame, template: str = CHATML, key: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, formatted, loss_spans): each conversation rendered by the compiled template.

    Rows of a conversation are brought together by its id and ordered by turn, then role and text where turns tie;
    repeated rows are repeated turns.  Null roles and texts are empty, a null turn comes first, rows with a null id form
    one conversation.  A task streams its sorted rows and holds one conversation at a time.  Other columns are ignored;
    an empty table gives an empty result."""
    compile_template(template)  # errors show on the driver
    kind = rows.schema[key].dataType.simpleString()
    sorted_rows = (rows.select(F.col(key).alias("conv_id"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                               F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(turn).alias("turn"))
                   .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
                   .select("conv_id", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = compile_template(template)
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            spans = pa.array([[{"start": a, "end": b} for a, b in s] for _, _, s in held],
                             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            return pa.RecordBatch.from_arrays([pa.array([k for k, _, _ in held], ids), pa.array([f for _, f, _ in held], pa.string()), spans],
                                              ["conv_id", "formatted", "loss_spans"])

        ids = None
        source = iter(batches)
        first = next(source, None)
        if first is None:
            return
        ids = first.schema.field(0).type
        for k, turns in _conversations(b for part in ((first,), source) for b in part):
            formatted, spans = render(compiled, turns)
            held.append((k, formatted, spans))
            size += len(formatted)
            if size > 4_000_000:
                yield flush()
                held.clear()
                size = 0
        if held:
            yield flush()

    return sorted_rows.mapInArrow(run, FORMATTED.format(key=kind))


DIGEST = "conv_id {key}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[list] = [[], [], [], [], []]
        for formatted, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            turns = read_back(formatted)
            loss = [unescape(formatted[s["start"]:s["end"]]) for s in spans]
            row = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                   sum(map(len, loss)), hashlib.sha256("".join(loss).encode()).hexdigest(), len(formatted))
            for column, v in zip(out, row):
                column.append(v)
        yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, out)], ["conv_id", "n_turns", "turns_sha256",
                                                                             "loss_chars", "loss_sha256", "formatted_chars"])


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digests read back from the formatted text and its loss spans."""
    return formatted.mapInArrow(_digests, DIGEST.format(key=formatted.schema["conv_id"].dataType.simpleString()))


CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"

# a turn's length: markers, role, line breaks and one backslash for every control opener in its text
CHAT_SQL = r"""
WITH c AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
           UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
t AS (SELECT *, 12 + length(role) + 1 + length(text) + len(regexp_extract_all(text, '<\\*\|')) + 10 + 1 AS chars FROM c)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(COALESCE(SUM(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(SUM(chars) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
